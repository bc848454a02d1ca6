"""Repeatable pseudo-random orders without all-pairs work.

``md5_positions`` numbers the rows of each group 0..n-1 in md5 order. The numbering runs per
(group, first hex digits of the md5) -- 16 ** DIGITS sub-buckets of even size, because md5 is uniform --
and a small per-group table of bucket sizes turns the local numbers into global ones. So a group
holding a third of all rows is still numbered by as many tasks, never by one.

``walk`` gives a row (user) ``steps`` consecutive positions of a group, starting at an offset
derived from md5(user|group), wrapping around: a per-user shuffle of a group read by an equi-join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


#: Hex digits of the md5 that choose a sub-bucket: 4,096 sub-buckets, and rows in the table of their sizes.
DIGITS = 3


def md5_positions(df: DataFrame, group_cols: list[str], id_col: str, pos_col: str = "pos",
                  size_col: str = "group_size") -> DataFrame:
    """Number the rows of each group (of the whole table when ``group_cols`` is empty) 0..n-1 in
    md5 order of ``id_col``; ``size_col`` is the group's row count."""
    key = F.md5(F.col(id_col).cast("string"))
    keyed = df.withColumn("_k", key).withColumn("_b", F.substring("_k", 1, DIGITS))
    local = keyed.withColumn("_lr", F.row_number().over(Window.partitionBy(*group_cols, "_b").orderBy("_k")) - 1)
    sizes = keyed.groupBy(*group_cols, "_b").agg(F.count("*").alias("_bn"))
    # At most 16 ** DIGITS rows per group: the running sum of bucket sizes gives each bucket's first position.
    wb = Window.partitionBy(*group_cols).orderBy("_b")
    offsets = (sizes.withColumn("_off", F.coalesce(F.sum("_bn").over(wb.rowsBetween(Window.unboundedPreceding, -1)),
                                                   F.lit(0)))
               .withColumn(size_col, F.sum("_bn").over(Window.partitionBy(*group_cols)))
               .drop("_bn"))
    return (local.join(offsets, [*group_cols, "_b"])
            .withColumn(pos_col, (F.col("_off") + F.col("_lr")).cast("bigint"))
            .drop("_k", "_b", "_lr", "_off"))


def hashed_offset(seed_cols: list, modulus) -> F.Column:
    """0..modulus-1 from md5 of the '|'-joined seed columns (the same value in DuckDB)."""
    h = F.md5(F.concat_ws("|", *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in seed_cols]))
    return F.pmod(F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint"), modulus)


def walk(requests: DataFrame, positioned: DataFrame, group_cols: list[str], seed_cols: list, steps: int,
         size_col: str = "group_size", pos_col: str = "pos", step_col: str = "step") -> DataFrame:
    """Join each request row to ``steps`` consecutive positions of its group (fewer if the group is
    smaller), starting at hashed_offset(seed_cols, group size). ``step_col`` is 0..steps-1. With no
    group columns the whole table is one group and its size is a scalar subquery, so the requests
    meet the positions through an equi-join on the position only."""
    if group_cols:
        sizes = positioned.select(*group_cols, size_col).distinct()
        r = requests.join(sizes, group_cols)
    else:
        r = requests.withColumn(size_col, positioned.select(F.max(size_col)).scalar())
    r = (r.withColumn("_start", hashed_offset(seed_cols, F.col(size_col)))
         .withColumn(step_col, F.explode(F.sequence(F.lit(0), F.least(F.lit(steps), F.col(size_col)) - 1)))
         .withColumn(pos_col, F.pmod(F.col("_start") + F.col(step_col), F.col(size_col)))
         .drop("_start", size_col))
    return r.join(positioned.drop(size_col), [*group_cols, pos_col])
