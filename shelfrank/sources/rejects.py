"""What the CSV readers refuse (S1-S3): every row is kept or rejected, and says why, in one pass over the text.

``read_text`` reads every field as text, so nothing is lost in reading; ``checked`` makes the typed columns of the table and the
reasons. A refused id or name drops the row, as cleaning does (P4, P8); another refused field is null in a row that is kept. A
row of too few or too many fields is kept if its ids are there, with the reason ``row``. Batches and streams go through the
same expressions. Interactions without a readable time are kept in the log, which cleaning sorts last; as state events
they can't be ordered, and ``untimed`` counts them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shelfrank.functions import constants as C
from shelfrank.sources import files

SCHEMAS = {"users": files.USERS_SCHEMA, "products": files.PRODUCTS_SCHEMA, "interactions": files.INTERACTIONS_SCHEMA}
#: Fields without which cleaning drops a row.
REQUIRED = {"users": ["user_id"], "products": ["product_id", "product_name"], "interactions": ["user_id", "product_id"]}
#: The line of a row that has not the table's number of fields.
MALFORMED = "_malformed"


def _text_schema(table: str) -> StructType:
    return StructType([StructField(f.name, StringType()) for f in SCHEMAS[table].fields] + [StructField(MALFORMED, StringType())])


def read_text(spark: SparkSession, path: str, table: str, stream: bool = False) -> DataFrame:
    """The fields of header CSV files as text, and ``_malformed``."""
    reader = spark.readStream if stream else spark.read
    return reader.schema(_text_schema(table)).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", MALFORMED).csv(path)


def checked(rows: DataFrame, table: str, ts_format: str = C.INTERACTION_TS_FORMAT) -> DataFrame:
    """Rows of text fields (named as the table's, in any order, other columns pass through) as typed columns, with ``reasons`` (an array, empty for a sound row)
    and ``kept``. An empty or blank field is missing, which only the required ones mind."""
    fields = SCHEMAS[table].fields
    typed: dict[str, Column] = {}
    reasons: list[Column] = []
    for f in fields:
        if f.name not in rows.columns:
            continue
        text = F.col(f.name).cast("string")
        given = F.coalesce(F.trim(text), F.lit("")) != ""
        if not isinstance(f.dataType, StringType):
            value = F.expr(f"try_cast(nullif(trim(CAST(`{f.name}` AS STRING)), '') AS {f.dataType.simpleString()})")
            typed[f.name] = value
            reasons.append(F.when(given & value.isNull(), f"{f.name}: not a number"))
        elif table == "interactions" and f.name == "rating":
            reasons.append(F.when(given & F.expr("try_cast(nullif(trim(rating), '') AS DOUBLE)").isNull(), "rating: not a number"))
        elif table == "interactions" and f.name == "timestamp":
            reasons.append(F.when(given & F.try_to_timestamp(text, F.lit(ts_format)).isNull(), "timestamp: not a time").when(~given, "timestamp: missing"))
        if f.name in REQUIRED[table]:
            reasons.append(F.when(~given, f"{f.name}: missing"))
    if MALFORMED in rows.columns:
        reasons.append(F.when(F.col(MALFORMED).isNotNull(), "row: not the table's number of fields"))
    kept = F.lit(True)
    for name in REQUIRED[table]:
        kept = kept & typed.get(name, F.col(name)).isNotNull()
    found = F.filter(F.array(*reasons), lambda r: r.isNotNull())
    others = [c for c in rows.columns if c not in typed and c not in ("reasons", "kept")]
    return rows.select(*[typed[c].alias(c) if c in typed else F.col(c) for c in rows.columns if c in typed or c in others], found.alias("reasons"), kept.alias("kept"))


def kept(rows: DataFrame) -> DataFrame:
    """The rows that go on to cleaning, without the marks."""
    return rows.filter("kept").drop("reasons", "kept", MALFORMED)


def rejected(rows: DataFrame) -> DataFrame:
    """The side output: the rows that are dropped, with their reasons."""
    return rows.filter("NOT kept").drop("kept")


def counts(rows: DataFrame) -> DataFrame:
    """(reason, rows, dropped): rows with each reason and how many of them are dropped; all rows as reason ``any row``. One aggregate, whatever
    the number of reasons."""
    each = F.explode(F.concat(F.array(F.lit("any row")), "reasons"))
    dropped = F.sum(F.when(F.col("kept"), 0).otherwise(1)).cast("bigint")
    return rows.select(each.alias("reason"), "kept").groupBy("reason").agg(F.count("*").alias("rows"), dropped.alias("dropped"))


def untimed(rows: DataFrame) -> DataFrame:
    """Interactions that are kept in the log but are no state events, as they have no readable time."""
    return rows.filter(F.col("kept") & F.exists("reasons", lambda r: r.startswith("timestamp:")))
