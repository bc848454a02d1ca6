"""File sources and sinks: CSV with explicit schemas (S1-S3, S13), JSON (S14), streams of CSV.

Nothing is inferred. Ids are LongType; price and avg_rating are read as double (a float schema would
widen 3.3 to 3.299999952 later, trap T6). rating and timestamp stay text until cleaning, where
``try_cast`` / ``try_to_timestamp`` turn bad values into nulls instead of failing under ANSI.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from shelfrank.functions import constants as C
from shelfrank.functions.columns import event_time, ntz_micros
from shelfrank.operators.clean import with_event_ids

USERS_SCHEMA = StructType([
    StructField("user_id", LongType()),
    StructField("age_group", StringType()),
    StructField("location", StringType()),
    StructField("preferred_category", StringType()),
    StructField("membership_type", StringType()),
    StructField("signup_date", StringType()),
])

PRODUCTS_SCHEMA = StructType([
    StructField("product_id", LongType()),
    StructField("product_name", StringType()),
    StructField("category", StringType()),
    StructField("sub_category", StringType()),
    StructField("brand", StringType()),
    StructField("price", DoubleType()),
    StructField("price_range", StringType()),
    StructField("avg_rating", DoubleType()),
    StructField("rating_count", IntegerType()),
    StructField("stock", IntegerType()),
])

INTERACTIONS_SCHEMA = StructType([
    StructField("user_id", LongType()),
    StructField("product_id", LongType()),
    StructField("interaction_type", StringType()),
    StructField("interaction_score", IntegerType()),
    StructField("rating", StringType()),
    StructField("review_sentiment", StringType()),
    StructField("timestamp", StringType()),
    StructField("session_id", StringType()),
])


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Header CSV with a fixed schema. A field that does not parse as its type becomes null (PERMISSIVE)."""
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)


def read_users(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, USERS_SCHEMA)


def read_products(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, PRODUCTS_SCHEMA)


def read_interactions(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, INTERACTIONS_SCHEMA)


def read_interactions_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The interaction log as a stream of CSV files in ``folder`` (same schema as the batch reader)."""
    r = spark.readStream.schema(INTERACTIONS_SCHEMA).option("header", True)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.csv(folder)


def state_events(log: DataFrame, ts_format: str = C.INTERACTION_TS_FORMAT) -> DataFrame:
    """The interaction log, batch or stream, as the typed events of ``streaming.user_state``: every row
    with a user, a product and a time is an interaction. Event ids are made as for the batch feed."""
    ts = F.try_to_timestamp(F.col("timestamp"), F.lit(ts_format)).cast("timestamp_ntz")
    rows = with_event_ids(log.withColumn("ts", ts).dropna(subset=["user_id", "product_id", "ts"]))
    none = F.lit(None).cast("long")
    return rows.select("event_id", "user_id", event_time("ts").alias("ts"), ntz_micros("ts").alias("ts_us"),
                       F.lit("interaction").alias("kind"), "product_id", "interaction_type", "session_id",
                       none.alias("c1"), none.alias("c2"), none.alias("n_categories"))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header CSV, one file per task (a distributed write; nothing passes through the driver)."""
    df.write.mode(mode).option("header", True).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines, overwrite by default."""
    df.write.mode(mode).json(path)
