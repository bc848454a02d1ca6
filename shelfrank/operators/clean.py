"""Cleaning: type repair (ANSI safe), null drops, deduplication with a total order, value clamps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from shelfrank.functions import constants as C
from shelfrank.functions.columns import ntz_micros

DEDUP_KEY = ("user_id", "product_id", "interaction_type", "session_id")


def _as_double(df: DataFrame, name: str) -> F.Column:
    """'' -> null, text that is no number -> null, else double (``cast`` would throw under ANSI)."""
    if isinstance(df.schema[name].dataType, StringType):
        return F.expr(f"try_cast(nullif(trim({name}), '') AS DOUBLE)")
    return F.col(name).cast("double")


def _as_timestamp(df: DataFrame, name: str, fmt: str) -> F.Column:
    if isinstance(df.schema[name].dataType, StringType):
        return F.expr(f"try_to_timestamp({name}, '{fmt}')")
    return F.col(name)


def clean_interactions(df: DataFrame, ts_format: str = C.INTERACTION_TS_FORMAT) -> DataFrame:
    """Repair rating, sentiment and timestamp, drop rows without user or product, and keep one
    row per (user, product, type, session): the earliest by (ts, event_id), nulls last.

    A CSV log names its time column ``timestamp``; the result always calls it ``ts``.
    """
    if "timestamp" in df.columns and "ts" not in df.columns:
        df = df.withColumnRenamed("timestamp", "ts")
    cols = {
        "rating": _as_double(df, "rating"),
        "ts": _as_timestamp(df, "ts", ts_format),
    }
    if "review_sentiment" in df.columns:
        cols["review_sentiment"] = F.expr("nullif(review_sentiment, '')")
    df = df.withColumns(cols).dropna(subset=["user_id", "product_id"])
    order = [F.col("ts").asc_nulls_last()]
    if "event_id" in df.columns:
        order.append(F.col("event_id").asc_nulls_last())
    order += [F.col("rating").desc_nulls_last()]
    w = Window.partitionBy(*DEDUP_KEY).orderBy(*order)
    # row_number() = 1 is planned as a WindowGroupLimit: each map task keeps one row per key before
    # the shuffle, so a hot key costs one row per task, not all of its rows.
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


#: Event ids of one second that ``with_event_ids`` tells apart by hash.
_IDS_PER_SECOND = 1 << 20


def with_event_ids(log: DataFrame) -> DataFrame:
    """A clean log in a total order: unchanged if it has ``event_id``; else with one made of the second of
    ``ts`` and a hash of the row's key, so ids increase with time and do not depend on partitioning.
    Rows without ``ts`` come first."""
    if "event_id" in log.columns:
        return log
    second = F.floor(ntz_micros(F.col("ts").cast("timestamp_ntz")) / 1_000_000)
    place = F.pmod(F.xxhash64(*DEDUP_KEY), F.lit(_IDS_PER_SECOND))
    return log.withColumn("event_id", (F.coalesce(second, F.lit(0)) * _IDS_PER_SECOND + place).cast("long"))


def clean_products(df: DataFrame) -> DataFrame:
    """Drop rows without id or name; negative price -> 0; rating clamped to 0..5.
    Nulls stay null (``greatest`` would turn them into 0)."""
    price = F.col("price").cast("double")
    rating = F.col("avg_rating").cast("double")
    return (df.dropna(subset=["product_id", "product_name"])
            .withColumns({
                "price": F.when(price < 0, F.lit(0.0)).otherwise(price),
                "avg_rating": F.when(rating > 5, F.lit(5.0)).when(rating < 0, F.lit(0.0)).otherwise(rating),
            }))


def clean_users(df: DataFrame) -> DataFrame:
    """Drop rows without a user id."""
    return df.dropna(subset=["user_id"])
