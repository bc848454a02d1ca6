"""DuckDB twins of the registered queries (the correctness oracle).

The adapter CTEs restate ``shelfrank.sources.testdata`` in SQL. Rules shared with the Spark side:
rankings end with product_id ascending, decimals are rounded half up with floor (trap T7), integer
sums are cast to BIGINT and literals to DOUBLE (trap T8), ranks are INTEGER as in Spark.
"""

from __future__ import annotations

ADAPTERS = """
products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
    p_type || ' ' || split_part(p_name, ' ', 2) AS sub_category, p_brand AS brand, p_retailprice AS price,
    CASE WHEN p_retailprice IS NULL THEN NULL WHEN p_retailprice < 925 THEN 'Budget'
         WHEN p_retailprice < 950 THEN 'Mid-Range' WHEN p_retailprice < 975 THEN 'Premium' ELSE 'Luxury' END AS price_range,
    CAST(25 + (p_partkey * 7 + p_size) % 26 AS DOUBLE) / 10 AS avg_rating,
    (p_partkey * 37 + p_size * 11) % 500 AS rating_count, (p_partkey * 13) % 501 AS stock
  FROM part),
users AS (
  SELECT c_custkey AS user_id,
    CASE c_custkey % 5 WHEN 0 THEN '18-24' WHEN 1 THEN '25-34' WHEN 2 THEN '35-44' WHEN 3 THEN '45-54' ELSE '55+' END AS age_group,
    n_name AS location,
    CASE c_custkey % 6 WHEN 0 THEN 'ECONOMY' WHEN 1 THEN 'LARGE' WHEN 2 THEN 'MEDIUM' WHEN 3 THEN 'PROMO'
         WHEN 4 THEN 'SMALL' ELSE 'STANDARD' END AS preferred_category,
    CASE WHEN c_acctbal < 0 THEN 'Free' WHEN c_acctbal < 3000 THEN 'Silver' WHEN c_acctbal < 7000 THEN 'Gold'
         ELSE 'Platinum' END AS membership_type
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
interactions_r0 AS (
  SELECT event_id, user_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id,
    CASE event_type WHEN 'signup' THEN 'add_to_cart' ELSE event_type END AS interaction_type,
    CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 3 ELSE 5 END AS interaction_score,
    CASE WHEN event_type = 'purchase' OR (event_type = 'signup' AND event_id % 10 < 3)
         THEN CAST(1 + event_id % 5 AS DOUBLE) END AS rating,
    ts, substr(md5(CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR)), 1, 12) AS session_id
  FROM events WHERE event_type IN ('view', 'click', 'signup', 'purchase')),
interactions_raw AS (
  SELECT event_id, user_id, product_id, interaction_type, interaction_score, rating,
    CASE WHEN rating IS NULL THEN NULL WHEN rating >= 4 THEN 'positive' WHEN rating = 3 THEN 'neutral'
         ELSE 'negative' END AS review_sentiment, ts, session_id
  FROM interactions_r0),
interactions AS (
  SELECT event_id, user_id, product_id, interaction_type, interaction_score, rating, review_sentiment, ts, session_id
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id, product_id, interaction_type, session_id
                                     ORDER BY ts ASC NULLS LAST, event_id ASC NULLS LAST, rating DESC NULLS LAST) AS rn_
        FROM interactions_raw WHERE user_id IS NOT NULL AND product_id IS NOT NULL) d
  WHERE rn_ = 1)
"""


def with_adapters(body: str) -> str:
    """Prefix a query (``<more ctes> SELECT ...``) with the adapter CTEs."""
    body = body.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return "WITH RECURSIVE " + ADAPTERS.strip() + ",\n" + body[15:]
    if body.upper().startswith("WITH "):
        return "WITH " + ADAPTERS.strip() + ",\n" + body[5:]
    return "WITH " + ADAPTERS.strip() + "\n" + body


POPULARITY_CTE = """
pop AS (
  SELECT product_id, CAST(sum(interaction_score) AS BIGINT) AS popularity_score, count(*) AS total_interactions,
    count(DISTINCT user_id) AS unique_users
  FROM interactions GROUP BY product_id),
popular AS (
  SELECT * FROM (
    SELECT pop.product_id, p.product_name, p.category, p.brand, p.price, p.avg_rating,
      pop.popularity_score, pop.total_interactions, pop.unique_users,
      CAST(row_number() OVER (PARTITION BY p.category ORDER BY pop.popularity_score DESC, pop.product_id) AS INTEGER) AS rank
    FROM pop LEFT JOIN products p ON pop.product_id = p.product_id) x
  WHERE rank <= 8)
"""

ORACLE: dict[str, str] = {}

ORACLE["popular_by_category"] = with_adapters(f"""
WITH {POPULARITY_CTE.strip()}
SELECT category, rank, product_id, product_name, brand, price, avg_rating, popularity_score,
  total_interactions, unique_users
FROM popular
""")


def R2(x: str) -> str:
    return f"floor(({x}) * 100 + 0.5) / 100"


MATRIX_CTE = """
matrix AS (
  SELECT user_id, product_id, CAST(sum(interaction_score) AS BIGINT) AS total_score, count(*) AS interaction_count,
    max(rating) AS max_rating, list_sort(list(DISTINCT interaction_type)) AS interaction_types
  FROM interactions GROUP BY user_id, product_id),
matrix_f AS (
  SELECT *, CASE WHEN max_rating IS NOT NULL THEN total_score * CAST(0.7 AS DOUBLE) + max_rating * CAST(0.3 AS DOUBLE)
                 ELSE CAST(total_score AS DOUBLE) END AS final_score
  FROM matrix),
entries AS (SELECT user_id, product_id, final_score FROM matrix_f
            WHERE user_id IS NOT NULL AND product_id IS NOT NULL AND final_score IS NOT NULL),
split AS (
  SELECT *, (CAST(('0x' || substr(md5(CAST(user_id AS VARCHAR) || '|' || CAST(product_id AS VARCHAR) || '|42'), 1, 8)) AS BIGINT) % 100) < 80 AS is_train
  FROM entries)
"""

STATS_CTE = """
eng AS (SELECT product_id, CAST(sum(interaction_score) AS BIGINT) AS total_engagement FROM interactions GROUP BY product_id),
prod_stats AS (
  SELECT p.*, coalesce(e.total_engagement, 0) AS total_engagement FROM products p LEFT JOIN eng e USING (product_id))
"""

COMP_MAP_CTE = """
cm_p AS (SELECT DISTINCT p_type AS category, split_part(p_name, ' ', 2) AS noun FROM part),
cm_cat AS (SELECT category, row_number() OVER (ORDER BY category) - 1 AS ci, count(*) OVER () AS nc
           FROM (SELECT DISTINCT category FROM cm_p) x),
cm_noun AS (SELECT noun, row_number() OVER (ORDER BY noun) - 1 AS ni, count(*) OVER () AS nn
            FROM (SELECT DISTINCT noun FROM cm_p) y),
cm_off AS (SELECT 0 AS dc, 1 AS dn UNION ALL SELECT 0, 2 UNION ALL SELECT 1, 0),
comp_map AS (
  SELECT c1.category || ' ' || n1.noun AS source_sub_category, c2.category || ' ' || n2.noun AS target_sub_category
  FROM cm_p s JOIN cm_cat c1 ON s.category = c1.category JOIN cm_noun n1 ON s.noun = n1.noun CROSS JOIN cm_off o
  JOIN cm_cat c2 ON c2.ci = (c1.ci + o.dc) % c1.nc JOIN cm_noun n2 ON n2.ni = (n1.ni + o.dn) % n1.nn)
"""

SIMILAR_CTE = """
sim_list AS (
  SELECT * FROM (
    SELECT a.product_id AS source_product_id, a.product_name AS source_product_name,
      b.product_id AS similar_product_id, b.product_name AS similar_product_name, b.category, b.brand, b.price,
      b.avg_rating, b.total_engagement AS engagement,
      CAST(row_number() OVER (PARTITION BY a.product_id
                              ORDER BY b.avg_rating DESC, b.total_engagement DESC, b.product_id) AS INTEGER) AS sim_rank
    FROM prod_stats a JOIN prod_stats b ON a.sub_category = b.sub_category AND a.product_id <> b.product_id) s
  WHERE sim_rank <= 5)
"""

COMPLEMENTARY_CTE = """
complementary AS (
  SELECT * FROM (
    SELECT a.product_id AS source_product_id, a.product_name AS source_product_name,
      b.product_id AS comp_product_id, b.product_name AS comp_product_name, b.category, b.sub_category, b.brand,
      b.price, b.avg_rating, b.total_engagement AS engagement,
      CAST(row_number() OVER (PARTITION BY a.product_id
                              ORDER BY b.avg_rating DESC, b.total_engagement DESC, b.product_id) AS INTEGER) AS comp_rank
    FROM prod_stats a JOIN (SELECT DISTINCT source_sub_category, target_sub_category FROM comp_map) m
      ON a.sub_category = m.source_sub_category
    JOIN prod_stats b ON b.sub_category = m.target_sub_category AND b.product_id <> a.product_id) c
  WHERE comp_rank <= 5)
"""


def ctes(*blocks: str) -> str:
    return ",\n".join(b.strip() for b in blocks)


ORACLE.update({
    "clean_interactions": with_adapters("SELECT * FROM interactions"),
    "clean_products": with_adapters("""
SELECT product_id, product_name, category, sub_category, brand,
  CASE WHEN price < 0 THEN 0.0 ELSE price END AS price, price_range,
  CASE WHEN avg_rating > 5 THEN 5.0 WHEN avg_rating < 0 THEN 0.0 ELSE avg_rating END AS avg_rating,
  rating_count, stock
FROM products WHERE product_id IS NOT NULL AND product_name IS NOT NULL"""),
    "clean_users": with_adapters("SELECT * FROM users WHERE user_id IS NOT NULL"),
    "interaction_distribution": with_adapters(
        "SELECT interaction_type, count(*) AS count FROM interactions GROUP BY interaction_type"),
    "category_counts": with_adapters("SELECT category, count(*) AS count FROM products GROUP BY category"),
    "membership_distribution": with_adapters(
        "SELECT membership_type, count(*) AS count FROM users GROUP BY membership_type"),
    "category_profile": with_adapters(f"""
SELECT category, {R2('avg(price)')} AS avg_price, {R2('avg(avg_rating)')} AS avg_rating, count(*) AS product_count
FROM products GROUP BY category"""),
    "user_product_matrix": with_adapters(f"""
WITH {ctes(MATRIX_CTE)}
SELECT user_id, product_id, total_score, interaction_count, max_rating,
  array_to_string(interaction_types, ',') AS interaction_types, final_score
FROM matrix_f"""),
    "matrix_input": with_adapters(f"WITH {ctes(MATRIX_CTE)} SELECT * FROM entries"),
    "score_stats": with_adapters(f"""
WITH {ctes(MATRIX_CTE)}
SELECT min(final_score) AS min_score, max(final_score) AS max_score, {R2('avg(final_score)')} AS mean_score,
  {R2('stddev_samp(final_score)')} AS stddev_score
FROM matrix_f"""),
    "product_popularity": with_adapters(f"WITH {ctes(POPULARITY_CTE)} SELECT * FROM pop"),
    "product_engagement": with_adapters(f"WITH {ctes(STATS_CTE)} SELECT * FROM prod_stats"),
    "run_summary": with_adapters(f"""
WITH {ctes(MATRIX_CTE)}
SELECT 'users' AS metric, count(*) AS value FROM users
UNION ALL SELECT 'products', count(*) FROM products WHERE product_id IS NOT NULL AND product_name IS NOT NULL
UNION ALL SELECT 'raw_interactions', count(*) FROM interactions_raw
UNION ALL SELECT 'interactions', count(*) FROM interactions
UNION ALL SELECT 'matrix_pairs', count(*) FROM matrix_f
UNION ALL SELECT 'matrix_users', count(DISTINCT user_id) FROM matrix_f"""),
    "matrix_shape": with_adapters(f"""
WITH {ctes(MATRIX_CTE)}
SELECT count(DISTINCT user_id) AS n_users, count(DISTINCT product_id) AS n_products, count(*) AS n_entries
FROM matrix_f"""),
    "interaction_pivot": with_adapters("""
SELECT user_id,
  CAST(coalesce(sum(CASE WHEN interaction_type = 'view' THEN interaction_score END), 0) AS BIGINT) AS "view",
  CAST(coalesce(sum(CASE WHEN interaction_type = 'click' THEN interaction_score END), 0) AS BIGINT) AS "click",
  CAST(coalesce(sum(CASE WHEN interaction_type = 'add_to_cart' THEN interaction_score END), 0) AS BIGINT) AS "add_to_cart",
  CAST(coalesce(sum(CASE WHEN interaction_type = 'purchase' THEN interaction_score END), 0) AS BIGINT) AS "purchase"
FROM interactions GROUP BY user_id"""),
    "train_test_split": with_adapters(f"WITH {ctes(MATRIX_CTE)} SELECT * FROM split"),
    "split_counts": with_adapters(f"""
WITH {ctes(MATRIX_CTE)}
SELECT count(*) FILTER (WHERE is_train) AS train_entries, count(*) FILTER (WHERE NOT is_train) AS test_entries
FROM split"""),
    "top_rated": with_adapters("""
SELECT product_id, product_name, category, brand, price, avg_rating, rating_count,
  CAST(row_number() OVER (ORDER BY avg_rating DESC, rating_count DESC, product_id) AS INTEGER) AS rank
FROM products WHERE rating_count >= 50
ORDER BY avg_rating DESC, rating_count DESC, product_id LIMIT 20"""),
    "product_search": with_adapters("""
SELECT product_id, product_name, category, sub_category, brand FROM products
WHERE (coalesce(contains(lower(product_name), 'bolt'), false) OR coalesce(contains(lower(brand), 'bolt'), false)
       OR coalesce(contains(lower(category), 'bolt'), false) OR coalesce(contains(lower(sub_category), 'bolt'), false))
  AND category IN ('ECONOMY', 'SMALL')"""),
    "product_search_table": with_adapters("""
WITH queries AS (
  SELECT s_suppkey AS query_id, lower(trim(substr(product_name, 1 + s_suppkey % 9, 1 + s_suppkey % 11))) AS q,
    CASE WHEN s_suppkey % 2 = 0 THEN category END AS only_category
  FROM supplier JOIN products ON product_id = s_suppkey)
SELECT query_id, product_id FROM queries JOIN products ON (
    contains(lower(coalesce(product_name, '')), q) OR contains(lower(coalesce(brand, '')), q)
    OR contains(lower(coalesce(category, '')), q) OR contains(lower(coalesce(sub_category, '')), q))
  AND (only_category IS NULL OR category = only_category)
WHERE q <> ''"""),
    "category_listing": with_adapters("""
SELECT p.category, product_id, product_name, price, avg_rating, c.category_count
FROM products p JOIN (SELECT category, count(*) AS category_count FROM products GROUP BY category) c
  ON p.category = c.category"""),
    "interaction_weights": with_adapters("""
SELECT interaction_type, count(*) AS n_events,
  CASE interaction_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'add_to_cart' THEN 3 WHEN 'purchase' THEN 5 END AS weight
FROM interactions_raw GROUP BY interaction_type"""),
    "price_buckets": with_adapters("""
SELECT product_id, price,
  CASE WHEN price IS NULL THEN NULL WHEN price < 500 THEN 'Budget' WHEN price < 2000 THEN 'Mid-Range'
       WHEN price < 10000 THEN 'Premium' ELSE 'Luxury' END AS price_bucket
FROM products"""),
    "rating_sentiment": with_adapters("""
SELECT rating, CASE WHEN rating IS NULL THEN NULL WHEN rating >= 4 THEN 'positive' WHEN rating = 3 THEN 'neutral'
                    ELSE 'negative' END AS review_sentiment, count(*) AS n_events
FROM interactions_raw GROUP BY 1, 2"""),
    "session_keys": with_adapters("""
SELECT event_id, user_id, ts,
  substr(md5(CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y-%m-%d-%H')), 1, 12) AS hour_session_id
FROM interactions"""),
    "product_names": with_adapters("""
SELECT product_id, brand || ' ' || split_part(product_name, ' ', 1) || ' ' || regexp_replace(sub_category, 's$', '')
  AS display_name
FROM products"""),
    "complementary_map": with_adapters(f"WITH {ctes(COMP_MAP_CTE)} SELECT * FROM comp_map"),
    "similar_products": with_adapters(f"WITH {ctes(STATS_CTE, SIMILAR_CTE)} SELECT * FROM sim_list"),
    "complementary_products": with_adapters(
        f"WITH {ctes(STATS_CTE, COMP_MAP_CTE, COMPLEMENTARY_CTE)} SELECT * FROM complementary"),
})


def R6(x: str) -> str:
    return f"floor(({x}) * 1000000 + 0.5) / 1000000"


HISTORY_CTE = """
resets AS (SELECT user_id, max(event_id) AS reset_event_id FROM events
           WHERE event_type = 'error' AND event_id % 50 = 0 GROUP BY user_id),
hist_ev AS (SELECT i.* FROM interactions i LEFT JOIN resets r ON i.user_id = r.user_id
            WHERE r.reset_event_id IS NULL OR i.event_id > r.reset_event_id),
history AS (
  SELECT * FROM (
    SELECT user_id, event_id, product_id, interaction_type, ts,
      CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS INTEGER) AS recency_rank
    FROM hist_ev) h
  WHERE recency_rank <= 50),
rf AS (SELECT user_id, product_id, max(ts) AS last_ts, count(*) AS event_count FROM history GROUP BY user_id, product_id),
nowt AS (SELECT max(ts) AS now_ts FROM interactions),
weights AS (
  SELECT rf.*, greatest(CAST(0 AS DOUBLE), (epoch_us(nowt.now_ts) - epoch_us(rf.last_ts)) / CAST(3600000000 AS DOUBLE)) AS hours_ago
  FROM rf CROSS JOIN nowt),
weights2 AS (
  SELECT *, pow(CAST(0.5 AS DOUBLE), hours_ago / CAST(48 AS DOUBLE)) * (1 + log2(1 + event_count)) AS weight FROM weights),
slots1 AS (
  SELECT *, sum(weight) OVER (PARTITION BY user_id) AS total_weight,
    CAST(row_number() OVER (PARTITION BY user_id ORDER BY weight DESC, product_id) AS INTEGER) AS weight_rank
  FROM weights2),
slots2 AS (SELECT *, CAST(greatest(1, floor(weight / total_weight * 14 + 0.5)) AS INTEGER) AS slots FROM slots1),
slots AS (SELECT *, CAST((slots * 3 + 4) // 5 AS INTEGER) AS sim_slots, CAST(slots - (slots * 3 + 4) // 5 AS INTEGER) AS comp_slots
          FROM slots2)
"""

CATEGORY_CTE = """
cat_idx AS (SELECT category, row_number() OVER (ORDER BY category) - 1 AS ci
            FROM (SELECT DISTINCT category FROM products WHERE category IS NOT NULL) c),
n_cat AS (SELECT count(*) AS n FROM cat_idx),
pref_upd AS (
  SELECT event_id, user_id, ts, event_id % 6 AS c1, (event_id + 1 + event_id % 2) % 6 AS c2, 1 + event_id % 3 AS n_categories
  FROM events WHERE event_type = 'error'),
pref_valid AS (
  SELECT p.* FROM pref_upd p LEFT JOIN resets r ON p.user_id = r.user_id
  WHERE (r.reset_event_id IS NULL OR p.event_id > r.reset_event_id) AND p.n_categories >= 2),
pref_last AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn_ FROM pref_valid) x
  WHERE rn_ = 1),
pref_slots AS (
  SELECT user_id, event_id, 0 AS cat_order, c1 AS ci FROM pref_last
  UNION ALL SELECT user_id, event_id, 1, c2 FROM pref_last
  UNION ALL SELECT user_id, event_id, 2, (c2 + 1) % (SELECT n FROM n_cat) FROM pref_last WHERE n_categories >= 3),
pref_rows AS (SELECT s.user_id, s.event_id, s.cat_order, c.category FROM pref_slots s JOIN cat_idx c ON s.ci = c.ci),
prefs AS (SELECT user_id, event_id, string_agg(category, ',' ORDER BY cat_order) AS categories FROM pref_rows GROUP BY 1, 2),
ucat_rows AS (
  SELECT user_id, cat_order, category FROM pref_rows
  UNION ALL
  SELECT u.user_id, 0, u.preferred_category FROM users u
  WHERE u.user_id NOT IN (SELECT user_id FROM prefs) AND u.preferred_category IS NOT NULL
  UNION ALL
  SELECT u.user_id, 1, nx.category FROM users u JOIN cat_idx c ON u.preferred_category = c.category
    JOIN cat_idx nx ON nx.ci = (c.ci + 1) % (SELECT n FROM n_cat)
  WHERE u.user_id NOT IN (SELECT user_id FROM prefs))
"""

TOGGLE_CTE = """
toggles AS (
  SELECT event_id, user_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id,
    CASE event_type WHEN 'click' THEN 'like_toggle' ELSE 'cart_toggle' END AS action, ts
  FROM events WHERE event_type IN ('click', 'signup')),
tog_valid AS (SELECT t.* FROM toggles t LEFT JOIN resets r ON t.user_id = r.user_id
              WHERE r.reset_event_id IS NULL OR t.event_id > r.reset_event_id),
tog_last AS (
  SELECT user_id, product_id, action, event_id, ts,
    count(*) OVER (PARTITION BY user_id, product_id, action) AS n_toggles,
    row_number() OVER (PARTITION BY user_id, product_id, action ORDER BY ts DESC, event_id DESC) AS rn_
  FROM tog_valid),
tog_state AS (
  SELECT user_id, product_id, action, event_id AS added_event_id, ts AS added_ts,
    CAST(row_number() OVER (PARTITION BY user_id, action ORDER BY ts, event_id) AS INTEGER) AS position
  FROM tog_last WHERE rn_ = 1 AND n_toggles % 2 = 1),
pcounts AS (
  SELECT user_id, CAST(sum(w) AS BIGINT) AS wishlist_count, CAST(sum(c) AS BIGINT) AS cart_count,
    CAST(sum(h) AS BIGINT) AS interaction_count
  FROM (SELECT user_id, CASE WHEN action = 'like_toggle' THEN 1 ELSE 0 END AS w,
               CASE WHEN action = 'cart_toggle' THEN 1 ELSE 0 END AS c, 0 AS h FROM tog_state
        UNION ALL SELECT user_id, 0, 0, 1 FROM history) u
  GROUP BY user_id)
"""

DETAIL_CTE = """
sim_ids AS (SELECT source_product_id AS product_id, string_agg(CAST(similar_product_id AS VARCHAR), ',' ORDER BY sim_rank) AS similar_ids
            FROM sim_list GROUP BY 1),
comp_ids AS (SELECT source_product_id AS product_id, string_agg(CAST(comp_product_id AS VARCHAR), ',' ORDER BY comp_rank) AS complementary_ids
             FROM complementary GROUP BY 1)
"""

ORACLE.update({
    "recent_interactions": with_adapters(f"WITH {ctes(HISTORY_CTE)} SELECT * FROM history"),
    "recency_frequency": with_adapters(f"WITH {ctes(HISTORY_CTE)} SELECT * FROM rf"),
    "time_decay_weights": with_adapters(f"""
WITH {ctes(HISTORY_CTE)}
SELECT user_id, product_id, last_ts, event_count, {R6('hours_ago')} AS hours_ago, {R6('weight')} AS weight FROM weights2"""),
    "feed_slots": with_adapters(f"""
WITH {ctes(HISTORY_CTE)}
SELECT user_id, product_id, weight_rank, {R6('weight')} AS weight, slots, sim_slots, comp_slots FROM slots"""),
    "top_influencers": with_adapters(f"""
WITH {ctes(HISTORY_CTE)}
SELECT s.product_id, s.user_id, s.weight_rank AS influence_rank, p.product_name
FROM slots s JOIN products p ON s.product_id = p.product_id WHERE s.weight_rank <= 3"""),
    "profile_history": with_adapters(f"""
WITH {ctes(HISTORY_CTE)}
SELECT h.user_id, h.recency_rank, h.event_id, h.product_id, h.interaction_type, h.ts,
  coalesce(p.product_name, 'Product #' || CAST(h.product_id AS VARCHAR)) AS label
FROM history h LEFT JOIN products p ON h.product_id = p.product_id WHERE h.recency_rank <= 15"""),
    "user_top_products": with_adapters("""
SELECT * FROM (
  SELECT user_id, product_id, score,
    CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, product_id) AS INTEGER) AS top_rank
  FROM (SELECT user_id, product_id, CAST(sum(interaction_score) AS BIGINT) AS score FROM interactions GROUP BY 1, 2) s) t
WHERE top_rank <= 15"""),
    "user_top_category": with_adapters("""
WITH top15 AS (
  SELECT * FROM (
    SELECT user_id, product_id, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, product_id) AS top_rank
    FROM (SELECT user_id, product_id, sum(interaction_score) AS score FROM interactions GROUP BY 1, 2) s) t
  WHERE top_rank <= 15),
cc AS (SELECT t.user_id, p.category, count(*) AS category_count, min(t.top_rank) AS first_rank
       FROM top15 t JOIN products p ON t.product_id = p.product_id GROUP BY 1, 2)
SELECT user_id, category AS top_category, category_count FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY category_count DESC, first_rank) AS r FROM cc) x
WHERE r = 1"""),
    "latest_preferences": with_adapters(f"WITH {ctes(HISTORY_CTE, CATEGORY_CTE)} SELECT * FROM prefs"),
    "user_categories": with_adapters(f"""
WITH {ctes(HISTORY_CTE, CATEGORY_CTE)}
SELECT user_id, string_agg(category, ',' ORDER BY cat_order) AS categories FROM ucat_rows GROUP BY user_id"""),
    "cold_start_feed": with_adapters(f"""
WITH {ctes(HISTORY_CTE, CATEGORY_CTE, POPULARITY_CTE)},
cs_cand AS (
  SELECT c.user_id, p.product_id FROM ucat_rows c JOIN popular p ON p.category = c.category AND p.rank <= 3
  WHERE c.user_id NOT IN (SELECT user_id FROM history))
SELECT * FROM (
  SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id
           ORDER BY md5(CAST(user_id AS VARCHAR) || '|' || CAST(product_id AS VARCHAR)), product_id) AS INTEGER) AS position,
    product_id
  FROM cs_cand) x
WHERE position <= 10"""),
    "category_sections": with_adapters(f"""
WITH {ctes(HISTORY_CTE, CATEGORY_CTE)},
pos AS (
  SELECT category, product_id, row_number() OVER (PARTITION BY category ORDER BY md5(CAST(product_id AS VARCHAR))) - 1 AS pos,
    count(*) OVER (PARTITION BY category) AS category_count
  FROM products WHERE category IS NOT NULL),
sizes AS (SELECT DISTINCT category, category_count FROM pos),
req AS (
  SELECT r.user_id, r.cat_order, r.category, s.category_count,
    CAST(('0x' || substr(md5(CAST(r.user_id AS VARCHAR) || '|' || r.category), 1, 8)) AS BIGINT) % s.category_count AS start_
  FROM ucat_rows r JOIN sizes s ON r.category = s.category),
steps AS (SELECT req.*, st.step FROM req CROSS JOIN generate_series(0, 3) AS st(step) WHERE st.step < req.category_count),
got AS (SELECT s.*, p.product_id FROM steps s JOIN pos p
          ON p.category = s.category AND p.pos = (s.start_ + s.step) % s.category_count)
SELECT user_id, cat_order, category, category_count,
  string_agg(CAST(product_id AS VARCHAR), ',' ORDER BY step) AS picks
FROM got GROUP BY user_id, cat_order, category, category_count"""),
    "product_detail": with_adapters(f"""
WITH {ctes(STATS_CTE, SIMILAR_CTE, COMP_MAP_CTE, COMPLEMENTARY_CTE, DETAIL_CTE)}
SELECT p.product_id, p.product_name, p.category, p.sub_category, p.brand, p.price, p.avg_rating,
  coalesce(s.similar_ids, '') AS similar_ids, coalesce(c.complementary_ids, '') AS complementary_ids
FROM products p LEFT JOIN sim_ids s ON p.product_id = s.product_id LEFT JOIN comp_ids c ON p.product_id = c.product_id"""),
    "wishlist_state": with_adapters(f"""
WITH {ctes(HISTORY_CTE, TOGGLE_CTE)}
SELECT user_id, product_id, added_event_id, added_ts, position FROM tog_state WHERE action = 'like_toggle'"""),
    "cart_state": with_adapters(f"""
WITH {ctes(HISTORY_CTE, TOGGLE_CTE)}
SELECT user_id, product_id, added_event_id, added_ts, position FROM tog_state WHERE action = 'cart_toggle'"""),
    "profile_counts": with_adapters(f"WITH {ctes(HISTORY_CTE, TOGGLE_CTE)} SELECT * FROM pcounts"),
    "state_after_reset": with_adapters(f"""
WITH {ctes(HISTORY_CTE, TOGGLE_CTE)}
SELECT r.user_id, r.reset_event_id, coalesce(c.wishlist_count, 0) AS wishlist_count,
  coalesce(c.cart_count, 0) AS cart_count, coalesce(c.interaction_count, 0) AS interaction_count
FROM resets r LEFT JOIN pcounts c ON r.user_id = c.user_id"""),
    "hourly_sessions": with_adapters("""
SELECT user_id, date_trunc('hour', ts) AS window_start, count(*) AS n_events,
  substr(md5(CAST(user_id AS VARCHAR) || '-' || strftime(date_trunc('hour', ts), '%Y-%m-%d-%H')), 1, 12) AS hour_session_id
FROM interactions GROUP BY user_id, date_trunc('hour', ts)"""),
})

ORACLE.update({
    "error_metrics": with_adapters(f"""
WITH {ctes(MATRIX_CTE)},
means AS (SELECT user_id, avg(final_score) AS user_mean FROM split WHERE is_train GROUP BY user_id),
pairs AS (SELECT s.final_score AS actual, coalesce(m.user_mean, CAST(0 AS DOUBLE)) AS predicted
          FROM split s LEFT JOIN means m ON s.user_id = m.user_id WHERE NOT s.is_train)
SELECT {R6('sqrt(avg((actual - predicted) * (actual - predicted)))')} AS rmse, {R6('avg(abs(actual - predicted))')} AS mae,
  count(*) AS n_test
FROM pairs"""),
    "unseen_pairs": with_adapters(f"""
WITH {ctes(HISTORY_CTE, CATEGORY_CTE, POPULARITY_CTE, MATRIX_CTE)}
SELECT c.category, c.user_id, p.product_id
FROM ucat_rows c JOIN popular p ON p.category = c.category
WHERE c.user_id IN (SELECT user_id FROM matrix_f)
  AND NOT EXISTS (SELECT 1 FROM matrix_f m WHERE m.user_id = c.user_id AND m.product_id = p.product_id)"""),
})

BASELINE_CTE = """
b_scores AS (SELECT user_id, product_id, sum(interaction_score) AS score FROM interactions GROUP BY 1, 2),
b_top AS (SELECT * FROM (SELECT user_id, product_id,
            row_number() OVER (PARTITION BY user_id ORDER BY score DESC, product_id) AS top_rank FROM b_scores) t
          WHERE top_rank <= 15),
b_cc AS (SELECT t.user_id, p.category, count(*) AS category_count, min(t.top_rank) AS first_rank
         FROM b_top t JOIN products p ON t.product_id = p.product_id GROUP BY 1, 2),
b_topcat AS (SELECT user_id, category FROM (
               SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY category_count DESC, first_rank) AS r FROM b_cc) x
             WHERE r = 1),
b_users AS (SELECT DISTINCT user_id FROM b_top),
b_ucat AS (
  SELECT u.user_id, coalesce(t.category, ci.category) AS category FROM b_users u
  LEFT JOIN b_topcat t ON u.user_id = t.user_id
  LEFT JOIN cat_idx ci ON ci.ci = CAST(('0x' || substr(md5(CAST(u.user_id AS VARCHAR)), 1, 8)) AS BIGINT) % (SELECT n FROM n_cat)),
b_best AS (SELECT * FROM (SELECT category, product_id, avg_rating,
             row_number() OVER (PARTITION BY category ORDER BY avg_rating DESC, product_id) AS r
           FROM products WHERE category IS NOT NULL) x),
b_picks AS (SELECT user_id, product_id, 0 AS src, pos FROM (
              SELECT u.user_id, b.product_id, row_number() OVER (PARTITION BY u.user_id ORDER BY b.avg_rating DESC, b.product_id) AS pos
              FROM b_ucat u JOIN b_best b ON b.category = u.category
              WHERE NOT EXISTS (SELECT 1 FROM b_top t WHERE t.user_id = u.user_id AND t.product_id = b.product_id)) x
            WHERE pos <= 2),
b_gpos AS (SELECT product_id, row_number() OVER (ORDER BY md5(CAST(product_id AS VARCHAR))) - 1 AS pos,
             count(*) OVER () AS n FROM products),
b_walk0 AS (
  SELECT u.user_id, st.step, (CAST(('0x' || substr(md5(CAST(u.user_id AS VARCHAR)), 1, 8)) AS BIGINT) % g.n + st.step) % g.n AS pos
  FROM b_users u CROSS JOIN (SELECT DISTINCT n FROM b_gpos) g CROSS JOIN LATERAL (SELECT unnest(range(g.n)) AS step) st),
b_walk AS (SELECT w.user_id, w.step, g.product_id FROM b_walk0 w JOIN b_gpos g ON g.pos = w.pos),
b_others AS (SELECT user_id, product_id, 1 AS src, step AS pos FROM (
               SELECT w.*, row_number() OVER (PARTITION BY w.user_id ORDER BY w.step) AS k FROM b_walk w
               WHERE NOT EXISTS (SELECT 1 FROM b_top t WHERE t.user_id = w.user_id AND t.product_id = w.product_id)
                 AND NOT EXISTS (SELECT 1 FROM b_picks p WHERE p.user_id = w.user_id AND p.product_id = w.product_id)) x
             WHERE k <= 3),
b_chosen AS (SELECT * FROM b_picks UNION ALL SELECT * FROM b_others),
b_pad AS (SELECT user_id, product_id, 2 AS src, step AS pos FROM b_walk w
          WHERE NOT EXISTS (SELECT 1 FROM b_chosen c WHERE c.user_id = w.user_id AND c.product_id = w.product_id)),
b_all AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY src, pos) AS INTEGER) AS rec_rank
                         FROM (SELECT * FROM b_chosen UNION ALL SELECT * FROM b_pad) u) x
          WHERE rec_rank <= 5)
"""

ORACLE["baseline_recommender"] = with_adapters(f"""
WITH {ctes(HISTORY_CTE, CATEGORY_CTE, BASELINE_CTE)}
SELECT a.user_id, a.rec_rank, a.product_id, CASE a.src WHEN 0 THEN 'category' WHEN 1 THEN 'random' ELSE 'pad' END AS source,
  p.product_name, p.category, p.sub_category, p.brand, p.price, p.avg_rating, p.rating_count, p.price_range
FROM b_all a LEFT JOIN products p ON a.product_id = p.product_id""")

EXPORT_CTE = """
sim_items AS (SELECT source_product_id, string_agg(CAST(similar_product_id AS VARCHAR), ',' ORDER BY sim_rank) AS item_ids
              FROM sim_list GROUP BY 1),
comp_items AS (SELECT source_product_id, string_agg(CAST(comp_product_id AS VARCHAR), ',' ORDER BY comp_rank) AS item_ids
               FROM complementary GROUP BY 1),
asked_keys AS (SELECT product_id AS source_product_id FROM products
                UNION ALL SELECT product_id + 1000000000 FROM products)
"""

ORACLE.update({
    "export_popular": with_adapters(f"""
WITH {ctes(POPULARITY_CTE)}
SELECT category, string_agg(CAST(product_id AS VARCHAR), ',' ORDER BY rank) AS item_ids
FROM popular WHERE category IS NOT NULL GROUP BY category"""),
    "export_similar": with_adapters(f"""
WITH {ctes(STATS_CTE, SIMILAR_CTE, COMP_MAP_CTE, COMPLEMENTARY_CTE, EXPORT_CTE)} SELECT * FROM sim_items"""),
    "export_complementary": with_adapters(f"""
WITH {ctes(STATS_CTE, SIMILAR_CTE, COMP_MAP_CTE, COMPLEMENTARY_CTE, EXPORT_CTE)} SELECT * FROM comp_items"""),
    "export_top_rated": with_adapters("""
SELECT CAST(row_number() OVER (ORDER BY avg_rating DESC, rating_count DESC, product_id) AS INTEGER) AS rank,
  product_id, product_name, category, brand, coalesce(price, CAST(0 AS DOUBLE)) AS price,
  coalesce(avg_rating, CAST(0 AS DOUBLE)) AS avg_rating, CAST(coalesce(rating_count, 0) AS BIGINT) AS rating_count
FROM products WHERE rating_count >= 50
ORDER BY avg_rating DESC, rating_count DESC, product_id LIMIT 20"""),
    "catalog_export": with_adapters("""
SELECT product_id, product_name, category, sub_category, brand, price, price_range, avg_rating, rating_count
FROM products"""),
    "lookup_similar": with_adapters(f"""
WITH {ctes(STATS_CTE, SIMILAR_CTE, COMP_MAP_CTE, COMPLEMENTARY_CTE, EXPORT_CTE)}
SELECT k.source_product_id, coalesce(s.item_ids, '') AS item_ids
FROM asked_keys k LEFT JOIN sim_items s ON k.source_product_id = s.source_product_id"""),
    "lookup_complementary": with_adapters(f"""
WITH {ctes(STATS_CTE, SIMILAR_CTE, COMP_MAP_CTE, COMPLEMENTARY_CTE, EXPORT_CTE)}
SELECT k.source_product_id, coalesce(c.item_ids, '') AS item_ids
FROM asked_keys k LEFT JOIN comp_items c ON k.source_product_id = c.source_product_id"""),
})

# The streams process the events in order, so their final state equals the batch results.
ORACLE.update({
    "stream_recent_interactions": ORACLE["recent_interactions"],
    "stream_wishlist_state": ORACLE["wishlist_state"],
    "stream_cart_state": ORACLE["cart_state"],
    "stream_latest_preferences": ORACLE["latest_preferences"],
    "stream_popular_by_category": ORACLE["popular_by_category"],
    "stream_hourly_sessions": ORACLE["hourly_sessions"],
})

ORDER_LOG_CTE = """
order_raw AS (
  SELECT l_orderkey * 16 + l_linenumber AS event_id, o_custkey AS user_id, l_partkey AS product_id,
    'purchase' AS interaction_type, 5 AS interaction_score, CAST(1 + (l_orderkey + l_linenumber) % 5 AS DOUBLE) AS rating,
    o_orderdate AS ts, CAST(l_orderkey AS VARCHAR) AS session_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
order_log AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, product_id, interaction_type, session_id
                                              ORDER BY ts ASC NULLS LAST, event_id ASC NULLS LAST, rating DESC NULLS LAST) AS rn_
                 FROM order_raw WHERE user_id IS NOT NULL AND product_id IS NOT NULL) x WHERE rn_ = 1),
o_pop AS (SELECT product_id, CAST(sum(interaction_score) AS BIGINT) AS popularity_score, count(*) AS total_interactions,
            count(DISTINCT user_id) AS unique_users FROM order_log GROUP BY product_id),
o_matrix AS (SELECT user_id, product_id, CAST(sum(interaction_score) AS BIGINT) AS total_score, max(rating) AS max_rating
             FROM order_log GROUP BY 1, 2),
o_scores AS (SELECT CASE WHEN max_rating IS NOT NULL THEN total_score * CAST(0.7 AS DOUBLE) + max_rating * CAST(0.3 AS DOUBLE)
                         ELSE CAST(total_score AS DOUBLE) END AS final_score FROM o_matrix)
"""

ORACLE.update({
    "order_log_popular": with_adapters(f"""
WITH {ctes(ORDER_LOG_CTE)}
SELECT * FROM (
  SELECT p.category, CAST(row_number() OVER (PARTITION BY p.category ORDER BY o.popularity_score DESC, o.product_id) AS INTEGER) AS rank,
    o.product_id, p.product_name, p.brand, p.price, p.avg_rating, o.popularity_score, o.total_interactions, o.unique_users
  FROM o_pop o LEFT JOIN products p ON o.product_id = p.product_id) x
WHERE rank <= 8"""),
    "order_log_matrix_stats": with_adapters(f"""
WITH {ctes(ORDER_LOG_CTE)}
SELECT min(final_score) AS min_score, max(final_score) AS max_score, {R2('avg(final_score)')} AS mean_score,
  {R2('stddev_samp(final_score)')} AS stddev_score
FROM o_scores"""),
})

ORACLE.update({
    "feed_candidates": with_adapters(f"""
WITH {ctes(HISTORY_CTE, CATEGORY_CTE, POPULARITY_CTE, STATS_CTE, SIMILAR_CTE, COMP_MAP_CTE, COMPLEMENTARY_CTE)},
anchors AS (SELECT user_id, product_id AS anchor_id, weight_rank FROM slots),
u AS (
  SELECT a.user_id, s.similar_product_id AS product_id, 0 AS source, a.weight_rank, s.sim_rank AS cand_rank
  FROM anchors a JOIN sim_list s ON s.source_product_id = a.anchor_id
  UNION ALL
  SELECT a.user_id, c.comp_product_id, 1, a.weight_rank, c.comp_rank
  FROM anchors a JOIN complementary c ON c.source_product_id = a.anchor_id
  UNION ALL
  SELECT r.user_id, p.product_id, 2, r.cat_order, p.rank
  FROM ucat_rows r JOIN popular p ON p.category = r.category
  WHERE r.user_id IN (SELECT user_id FROM anchors) AND p.category IS NOT NULL),
u2 AS (SELECT * FROM u WHERE NOT EXISTS (SELECT 1 FROM anchors a WHERE a.user_id = u.user_id AND a.anchor_id = u.product_id))
SELECT user_id, product_id, source, weight_rank, cand_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, product_id ORDER BY source, weight_rank, cand_rank) AS f FROM u2) x
WHERE f = 1"""),
    "feed_explanation": with_adapters(f"""
WITH {ctes(HISTORY_CTE)}
SELECT s.user_id, string_agg(p.product_name, ', ' ORDER BY s.weight_rank) AS influenced_by
FROM slots s JOIN products p ON s.product_id = p.product_id WHERE s.weight_rank <= 3 GROUP BY s.user_id"""),
    "user_product_detail": with_adapters(f"""
WITH {ctes(HISTORY_CTE, TOGGLE_CTE, STATS_CTE, SIMILAR_CTE, COMP_MAP_CTE, COMPLEMENTARY_CTE, DETAIL_CTE)},
req AS (SELECT DISTINCT user_id, product_id FROM history)
SELECT r.user_id, r.product_id, p.product_name, coalesce(s.similar_ids, '') AS similar_ids,
  coalesce(c.complementary_ids, '') AS complementary_ids,
  EXISTS (SELECT 1 FROM tog_state t WHERE t.action = 'like_toggle' AND t.user_id = r.user_id AND t.product_id = r.product_id) AS in_wishlist,
  EXISTS (SELECT 1 FROM tog_state t WHERE t.action = 'cart_toggle' AND t.user_id = r.user_id AND t.product_id = r.product_id) AS in_cart
FROM req r JOIN products p ON r.product_id = p.product_id
LEFT JOIN sim_ids s ON r.product_id = s.product_id LEFT JOIN comp_ids c ON r.product_id = c.product_id"""),
})

# The greedy fill (F3) and the popular pad (F4) as recursive CTEs: one step per candidate, one
# row per user (USING KEY keeps only each user's latest state; candidates are read by position).
FEED_CTE = """
anchors_l AS (SELECT user_id, list(product_id) AS anchors FROM slots GROUP BY user_id),
cand0 AS (
  SELECT s.user_id, s.weight_rank * 2 + 0 AS key, l.sim_rank AS cand_rank, l.similar_product_id AS pid, s.sim_slots AS quota
  FROM slots s JOIN sim_list l ON l.source_product_id = s.product_id
  UNION ALL
  SELECT s.user_id, s.weight_rank * 2 + 1, l.comp_rank, l.comp_product_id, s.comp_slots
  FROM slots s JOIN complementary l ON l.source_product_id = s.product_id),
cand1 AS (
  SELECT c.*, EXISTS (SELECT 1 FROM products p JOIN ucat_rows r ON r.category = p.category
                      WHERE p.product_id = c.pid AND r.user_id = c.user_id) AS ok
  FROM cand0 c),
cand_l AS (
  SELECT user_id, list(struct_pack(key := key, pid := pid, quota := quota, ok := ok) ORDER BY key, cand_rank) AS cands
  FROM cand1 GROUP BY user_id),
fold(user_id, idx, picked, cur_key, used, anchors, cands) USING KEY (user_id) AS (
  SELECT a.user_id, 0, CAST([] AS BIGINT[]), -1, 0, a.anchors, c.cands
  FROM anchors_l a JOIN cand_l c ON a.user_id = c.user_id
  UNION ALL
  SELECT user_id, idx + 1,
    CASE WHEN (CASE WHEN struct_extract(cands[idx + 1], 'key') <> cur_key THEN 0 ELSE used END)
                < struct_extract(cands[idx + 1], 'quota')
              AND struct_extract(cands[idx + 1], 'ok')
              AND NOT list_contains(anchors, struct_extract(cands[idx + 1], 'pid'))
              AND NOT list_contains(picked, struct_extract(cands[idx + 1], 'pid'))
         THEN list_append(picked, struct_extract(cands[idx + 1], 'pid')) ELSE picked END,
    struct_extract(cands[idx + 1], 'key'),
    CASE WHEN (CASE WHEN struct_extract(cands[idx + 1], 'key') <> cur_key THEN 0 ELSE used END)
                < struct_extract(cands[idx + 1], 'quota')
              AND struct_extract(cands[idx + 1], 'ok')
              AND NOT list_contains(anchors, struct_extract(cands[idx + 1], 'pid'))
              AND NOT list_contains(picked, struct_extract(cands[idx + 1], 'pid'))
         THEN (CASE WHEN struct_extract(cands[idx + 1], 'key') <> cur_key THEN 0 ELSE used END) + 1
         ELSE (CASE WHEN struct_extract(cands[idx + 1], 'key') <> cur_key THEN 0 ELSE used END) END,
    anchors, cands
  FROM fold WHERE idx < len(cands)),
filled AS (
  SELECT user_id, picked, anchors FROM fold
  UNION ALL
  SELECT user_id, CAST([] AS BIGINT[]), anchors FROM anchors_l WHERE user_id NOT IN (SELECT user_id FROM cand_l)),
pops_l AS (
  SELECT r.user_id, list(p.product_id ORDER BY r.cat_order, p.rank) AS pops
  FROM ucat_rows r JOIN popular p ON p.category = r.category
  WHERE p.category IS NOT NULL GROUP BY r.user_id),
padf(user_id, idx, picked, anchors, pops) USING KEY (user_id) AS (
  SELECT f.user_id, 0, f.picked, f.anchors, l.pops
  FROM filled f JOIN pops_l l ON f.user_id = l.user_id WHERE len(f.picked) < 6
  UNION ALL
  SELECT user_id, idx + 1,
    CASE WHEN len(picked) < 14 AND NOT list_contains(anchors, pops[idx + 1]) AND NOT list_contains(picked, pops[idx + 1])
         THEN list_append(picked, pops[idx + 1]) ELSE picked END,
    anchors, pops
  FROM padf WHERE idx < len(pops)),
final_feed AS (
  SELECT user_id, picked FROM filled WHERE len(picked) >= 6 OR user_id NOT IN (SELECT user_id FROM pops_l)
  UNION ALL SELECT user_id, picked FROM padf)
"""

ORACLE["personal_feed"] = with_adapters(f"""
WITH RECURSIVE {ctes(HISTORY_CTE, CATEGORY_CTE, POPULARITY_CTE, STATS_CTE, SIMILAR_CTE, COMP_MAP_CTE, COMPLEMENTARY_CTE, FEED_CTE)}
SELECT user_id, CAST(position AS INTEGER) AS position, product_id FROM (
  SELECT user_id, unnest(generate_series(1, len(picked))) AS position, unnest(picked) AS product_id
  FROM (SELECT user_id, picked[1:14] AS picked FROM final_feed) z) y""")
ORACLE["stream_personal_feed"] = ORACLE["personal_feed"]


# Fixed factors: md5 text, the same numbers as ``factor.hashed_start`` with 20 factors and seed 42.
def _fixed(ids: str, key: str) -> str:
    value = f"CAST(('0x' || substr(md5(CAST({key} AS VARCHAR) || '|' || CAST(f AS VARCHAR) || '|42'), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE"
    return f"(SELECT {key}, list({value} ORDER BY f) AS factors FROM {ids}, range(20) r(f) GROUP BY {key})"


FIXED_CTE = f"""
uf AS {_fixed("(SELECT DISTINCT user_id FROM split)", "user_id")},
pf AS {_fixed("(SELECT DISTINCT product_id FROM split)", "product_id")},
fixed_all AS (
  SELECT uf.user_id, pf.product_id, list_dot_product(uf.factors, pf.factors) AS score FROM uf, pf
  WHERE NOT EXISTS (SELECT 1 FROM split s WHERE s.user_id = uf.user_id AND s.product_id = pf.product_id)),
fixed_top AS (
  SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, product_id) AS INTEGER) AS rec_rank
                 FROM fixed_all) x WHERE rec_rank <= 5),
fixed_test AS (
  SELECT s.final_score AS actual, list_dot_product(uf.factors, pf.factors) AS predicted
  FROM split s JOIN uf ON uf.user_id = s.user_id JOIN pf ON pf.product_id = s.product_id WHERE NOT s.is_train),
fixed_items AS (SELECT user_id, string_agg(CAST(product_id AS VARCHAR), ',' ORDER BY rec_rank) AS item_ids FROM fixed_top GROUP BY user_id)
"""

ORACLE.update({
    "fixed_factor_top_n": with_adapters(f"""
WITH {ctes(MATRIX_CTE, FIXED_CTE)}
SELECT t.user_id, t.rec_rank, t.product_id, p.product_name, p.category, p.sub_category, p.brand, p.price, p.avg_rating,
  floor(t.score * 1000 + 0.5) / 1000 AS predicted_score
FROM fixed_top t LEFT JOIN products p ON p.product_id = t.product_id"""),
    "fixed_factor_metrics": with_adapters(f"""
WITH {ctes(MATRIX_CTE, FIXED_CTE)}
SELECT {R6('sqrt(avg((actual - predicted) * (actual - predicted)))')} AS rmse, {R6('avg(abs(actual - predicted))')} AS mae, count(*) AS n_test
FROM fixed_test"""),
    "nmf_half_step": with_adapters(f"""
WITH {ctes(MATRIX_CTE, FIXED_CTE)},
dims AS (SELECT i, j FROM range(20) a(i), range(20) b(j))
SELECT s.product_id, CAST(d.i AS INTEGER) AS f, {R6('sum(s.final_score * uf.factors[d.i + 1])')} AS value
FROM split s JOIN uf ON uf.user_id = s.user_id CROSS JOIN (SELECT DISTINCT i FROM dims) d WHERE s.is_train GROUP BY s.product_id, d.i
UNION ALL
SELECT NULL, CAST(d.i * 20 + d.j AS INTEGER), {R6('sum(uf.factors[d.i + 1] * uf.factors[d.j + 1])')} FROM uf, dims d GROUP BY d.i, d.j"""),
    "reconstruction_error": with_adapters(f"""
WITH {ctes(MATRIX_CTE, FIXED_CTE)}
SELECT {R6('sqrt(sum((coalesce(s.final_score, 0) - list_dot_product(uf.factors, pf.factors)) ** 2))')} AS reconstruction_error
FROM uf CROSS JOIN pf LEFT JOIN (SELECT * FROM split WHERE is_train) s ON s.user_id = uf.user_id AND s.product_id = pf.product_id"""),
    "export_fixed_recommendations": with_adapters(f"WITH {ctes(MATRIX_CTE, FIXED_CTE)} SELECT * FROM fixed_items"),
    "lookup_fixed_recommendations": with_adapters(f"""
WITH {ctes(MATRIX_CTE, FIXED_CTE)}
SELECT u.user_id, coalesce(i.item_ids, '') AS item_ids FROM users u LEFT JOIN fixed_items i ON i.user_id = u.user_id"""),
    "run_summary_model": with_adapters(f"""
WITH {ctes(MATRIX_CTE, FIXED_CTE)}
SELECT 'rmse' AS metric, {R6('sqrt(avg((actual - predicted) * (actual - predicted)))')} AS value FROM fixed_test
UNION ALL SELECT 'mae', {R6('avg(abs(actual - predicted))')} FROM fixed_test
UNION ALL SELECT 'users_served', CAST(count(DISTINCT user_id) AS DOUBLE) FROM fixed_top"""),
    "order_log_recommend": with_adapters(f"""
WITH log AS (
  SELECT DISTINCT o_custkey AS user_id, l_partkey AS product_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE o_custkey IS NOT NULL AND l_partkey IS NOT NULL),
uf AS {_fixed("(SELECT DISTINCT user_id FROM log)", "user_id")},
pf AS {_fixed("products", "product_id")},
scores AS (
  SELECT uf.user_id, pf.product_id, list_dot_product(uf.factors, pf.factors) AS score FROM uf, pf
  WHERE NOT EXISTS (SELECT 1 FROM log WHERE log.user_id = uf.user_id AND log.product_id = pf.product_id)),
top AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, product_id) AS INTEGER) AS rec_rank
                       FROM scores) x WHERE rec_rank <= 5)
SELECT t.user_id, t.rec_rank, t.product_id, p.product_name, floor(t.score * 1000 + 0.5) / 1000 AS predicted_score
FROM top t JOIN products p ON p.product_id = t.product_id"""),
    "rejected_rows": with_adapters("""
WITH marks AS (
  SELECT event_id, unnest(['any row', CASE WHEN event_id % 13 = 0 OR user_id IS NULL THEN 'user_id: missing' END,
      CASE WHEN product_id IS NULL THEN 'product_id: missing' WHEN event_id % 5 = 0 THEN 'product_id: not a number' END,
      CASE WHEN event_id % 7 = 0 THEN 'rating: not a number' END,
      CASE WHEN event_id % 11 = 0 THEN 'timestamp: not a time' WHEN ts IS NULL THEN 'timestamp: missing' END]) AS reason,
    event_id % 13 = 0 OR event_id % 5 = 0 OR user_id IS NULL OR product_id IS NULL AS refused
  FROM interactions_raw)
SELECT reason, count(*) AS rows, count(*) FILTER (WHERE refused) AS dropped FROM marks WHERE reason IS NOT NULL GROUP BY reason"""),
    "clean_text_interactions": with_adapters("""
WITH texts AS (
  SELECT event_id, CASE WHEN event_id % 13 <> 0 THEN user_id END AS user_id, product_id, interaction_type, interaction_score,
    CASE WHEN event_id % 7 <> 0 THEN rating END AS rating, review_sentiment,
    CASE WHEN event_id % 11 <> 0 THEN date_trunc('second', ts) END AS ts, session_id
  FROM interactions_raw)
SELECT event_id, user_id, product_id, interaction_type, interaction_score, rating, review_sentiment, ts, session_id
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, product_id, interaction_type, session_id
                                   ORDER BY ts ASC NULLS LAST, event_id ASC NULLS LAST, rating DESC NULLS LAST) AS rn_
      FROM texts WHERE user_id IS NOT NULL AND product_id IS NOT NULL) x
WHERE rn_ = 1"""),
    "clean_odd_products": with_adapters("""
SELECT product_id, product_name, category, sub_category, brand,
  CASE WHEN product_id % 5 = 0 THEN CAST(0 AS DOUBLE) WHEN product_id % 7 <> 0 THEN price END AS price, price_range,
  CASE WHEN product_id % 3 = 0 THEN least(CAST(5 AS DOUBLE), avg_rating * 2) WHEN product_id % 4 = 0 THEN CAST(0 AS DOUBLE)
       WHEN product_id % 11 <> 0 THEN avg_rating END AS avg_rating, rating_count, stock
FROM products WHERE product_id % 13 <> 0 AND product_id % 17 <> 0"""),
    "clean_odd_users": with_adapters("SELECT * FROM users WHERE user_id % 4 <> 0"),
    "similar_for_ids": with_adapters(f"""
WITH {ctes(HISTORY_CTE, TOGGLE_CTE, STATS_CTE, SIMILAR_CTE)}
SELECT * FROM sim_list WHERE source_product_id IN (SELECT product_id FROM tog_state WHERE action = 'like_toggle')"""),
})

ADDITIONS_CTE = """
additions AS (
  SELECT event_id, user_id, product_id, CASE action WHEN 'like_toggle' THEN 'like' ELSE 'add_to_cart' END AS interaction_type, ts
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id, product_id, action ORDER BY ts, event_id) AS n FROM tog_valid) x
  WHERE n % 2 = 1 AND product_id IS NOT NULL),
full_log AS (
  SELECT event_id, user_id, product_id, interaction_type, ts FROM interactions WHERE interaction_type IN ('view', 'purchase')
  UNION ALL SELECT * FROM additions),
full_history AS (
  SELECT * FROM (
    SELECT l.user_id, l.event_id, l.product_id, l.interaction_type, l.ts,
      CAST(row_number() OVER (PARTITION BY l.user_id ORDER BY l.ts DESC, l.event_id DESC) AS INTEGER) AS recency_rank
    FROM full_log l LEFT JOIN resets r ON r.user_id = l.user_id WHERE r.reset_event_id IS NULL OR l.event_id > r.reset_event_id) x
  WHERE recency_rank <= 50)
"""

ORACLE.update({
    "toggle_history": with_adapters(f"WITH {ctes(HISTORY_CTE, TOGGLE_CTE, ADDITIONS_CTE)} SELECT * FROM full_history"),
    "toggle_feed_weights": with_adapters(f"""
WITH {ctes(HISTORY_CTE, TOGGLE_CTE, ADDITIONS_CTE)},
w AS (
  SELECT user_id, product_id, max(ts) AS last_ts, count(*) AS event_count FROM full_history GROUP BY user_id, product_id),
h AS (SELECT *, greatest(CAST(0 AS DOUBLE), (epoch_us((SELECT max(ts) FROM full_log)) - epoch_us(last_ts)) / CAST(3600000000 AS DOUBLE)) AS hours FROM w)
SELECT user_id, product_id, last_ts, event_count, {R6('hours')} AS hours_ago,
  {R6('pow(CAST(0.5 AS DOUBLE), hours / CAST(48 AS DOUBLE)) * (1 + log2(1 + event_count))')} AS weight
FROM h"""),
})

ORACLE["latest_preference_lists"] = ORACLE["latest_preferences"]
ORACLE["stream_toggle_history"] = ORACLE["toggle_history"]
ORACLE["stream_preference_lists"] = ORACLE["latest_preference_lists"]
