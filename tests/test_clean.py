"""Cleaning on hand-made rows."""

import tempfile

from shelfrank.operators import clean
from shelfrank.sources import files

CSV = """user_id,product_id,interaction_type,interaction_score,rating,review_sentiment,timestamp,session_id
1,10,view,1,,,2024-01-01 10:00:00,s1
1,10,view,1,,,2024-01-01 09:00:00,s1
2,11,purchase,5,4,positive,2024-01-02 10:00:00,s2
2,11,purchase,5,2,negative,2024-01-02 11:00:00,s2
3,12,click,2,abc,,not a time,s3
,13,view,1,,,2024-01-03 10:00:00,s4
x,14,view,1,,,2024-01-03 10:00:00,s5
4,,view,1,,,2024-01-03 10:00:00,s6
"""


def write(text):
    d = tempfile.mkdtemp(prefix="csv-", dir="/tmp")
    with open(f"{d}/data.csv", "w") as f:
        f.write(text)
    return d


def test_dirty_interactions(spark):
    raw = files.read_interactions(spark, write(CSV))
    got = {(r.user_id, r.product_id): r for r in clean.clean_interactions(raw).collect()}
    assert set(got) == {(1, 10), (2, 11), (3, 12)}          # missing / non-numeric ids dropped
    assert str(got[(1, 10)].ts) == "2024-01-01 09:00:00"    # earliest duplicate kept
    assert got[(2, 11)].rating == 4.0                        # earliest wins, not an arbitrary row
    assert got[(3, 12)].rating is None and got[(3, 12)].ts is None   # bad values -> null, no error
    assert got[(1, 10)].review_sentiment is None


def test_dirty_products(spark):
    rows = [(1, "a", -1.0, 5.7), (2, "b", None, -0.2), (3, "c", 10.0, None), (4, None, 1.0, 1.0), (None, "e", 1.0, 1.0)]
    df = spark.createDataFrame(rows, "product_id long, product_name string, price double, avg_rating double")
    got = {r.product_id: (r.price, r.avg_rating) for r in clean.clean_products(df).collect()}
    assert got == {1: (0.0, 5.0), 2: (None, 0.0), 3: (10.0, None)}


def test_clean_users(spark):
    df = spark.createDataFrame([(1, "Gold"), (None, "Free")], "user_id long, membership_type string")
    assert [r.user_id for r in clean.clean_users(df).collect()] == [1]


def test_csv_round_trip(spark):
    raw = files.read_interactions(spark, write(CSV))
    out = tempfile.mkdtemp(prefix="csv-out-", dir="/tmp") + "/x"
    files.write_csv(raw, out)
    back = files.read_interactions(spark, out)
    assert back.exceptAll(raw).count() == 0 and raw.exceptAll(back).count() == 0


def test_users_and_products_csv(spark):
    users = files.read_users(spark, write("user_id,age_group,location,preferred_category,membership_type,signup_date\n"
                                          "1,18-24,X,Books,Gold,2024-01-01\n,25-34,Y,Books,Free,2024-01-02\n"))
    assert [r.user_id for r in clean.clean_users(users).collect()] == [1]
    prods = files.read_products(spark, write(
        "product_id,product_name,category,sub_category,brand,price,price_range,avg_rating,rating_count,stock\n"
        "1,A Pro Laptop,Electronics,Laptops,A,3.3,Budget,4.5,100,5\n2,,Books,Fiction,B,1.0,Budget,4.0,10,1\n"))
    got = clean.clean_products(prods).collect()
    assert len(got) == 1 and got[0].price == 3.3          # read as double: no float widening (T6)
