"""Column expressions shared by the operators. All are built-in functions (JVM side, codegen)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfrank.functions import constants as C


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c, digits: int) -> Column:
    """Decimal rounding half up, identical in Spark and DuckDB (their ``round`` differ, trap T7)."""
    scale = float(10 ** digits)
    return F.floor(col_(c) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def interaction_weight(type_col="interaction_type", weights: Mapping[str, int] = C.INTERACTION_WEIGHTS) -> Column:
    """Weight of an interaction type; an unknown type gives null."""
    t = col_(type_col)
    out = None
    for name, w in weights.items():
        out = F.when(t == F.lit(name), F.lit(int(w))) if out is None else out.when(t == F.lit(name), F.lit(int(w)))
    return out


def price_bucket(price="price", bounds: Sequence[float] = C.PRICE_BOUNDS,
                 labels: Sequence[str] = C.PRICE_LABELS) -> Column:
    """Bucket label: below bounds[0] -> labels[0] ... at or above the last bound -> labels[-1]."""
    if len(labels) != len(bounds) + 1:
        raise ValueError("need one label more than bounds")
    p = col_(price)
    out = F.when(p < F.lit(float(bounds[0])), F.lit(labels[0]))
    for b, label in zip(bounds[1:], labels[1:-1]):
        out = out.when(p < F.lit(float(b)), F.lit(label))
    return F.when(p.isNull(), F.lit(None).cast("string")).otherwise(out.otherwise(F.lit(labels[-1])))


def sentiment_from_rating(rating="rating") -> Column:
    r = col_(rating)
    pos, neu, neg = C.SENTIMENT_LABELS
    return (F.when(r.isNull(), F.lit(None).cast("string"))
            .when(r >= 4, F.lit(pos)).when(r == 3, F.lit(neu)).otherwise(F.lit(neg)))


def session_key(user="user_id", ts="ts", fmt: str = C.SESSION_HOUR_FORMAT,
                length: int = C.SESSION_ID_LENGTH) -> Column:
    """First ``length`` hex digits of md5("<user>-<formatted ts>")."""
    seed = F.concat_ws("-", col_(user).cast("string"), F.date_format(col_(ts), fmt))
    return F.substring(F.md5(seed), 1, length)


def display_name(brand="brand", prefix="prefix", sub_category="sub_category") -> Column:
    """"<brand> <prefix> <sub_category without a final s>"."""
    return F.concat_ws(" ", col_(brand), col_(prefix), F.regexp_replace(col_(sub_category), "s$", ""))


def hours_between(later, earlier) -> Column:
    """Hours from ``earlier`` to ``later`` as a double; works on TIMESTAMP and TIMESTAMP_NTZ."""
    return F.timestamp_diff("MICROSECOND", col_(earlier), col_(later)).cast("double") / F.lit(3.6e9)


def decay_weight(hours, count, half_life: float = C.DECAY_HALF_LIFE_HOURS) -> Column:
    """0.5 ^ (max(0, hours) / half_life) * (1 + log2(1 + count))."""
    h = F.greatest(F.lit(0.0), col_(hours))
    return F.pow(F.lit(0.5), h / F.lit(float(half_life))) * (F.lit(1.0) + F.log2(F.lit(1.0) + col_(count)))


def md5_order(*cols) -> Column:
    """Repeatable pseudo-random order key: md5 of the '|'-joined text of the columns."""
    return F.md5(F.concat_ws("|", *[col_(c).cast("string") for c in cols]))


_EPOCH_NTZ = "1970-01-01 00:00:00"


def ntz_micros(c) -> Column:
    """Microseconds of a TIMESTAMP_NTZ wall-clock time since 1970-01-01 00:00 (no time zone involved)."""
    return F.timestamp_diff("MICROSECOND", F.lit(_EPOCH_NTZ).cast("timestamp_ntz"), col_(c))


def ntz_from_micros(c) -> Column:
    """Inverse of ``ntz_micros``: a TIMESTAMP_NTZ, whatever the session time zone."""
    return F.timestamp_add("MICROSECOND", col_(c), F.lit(_EPOCH_NTZ).cast("timestamp_ntz"))


def event_time(c) -> Column:
    """A TIMESTAMP for watermarks and windows from a TIMESTAMP_NTZ, reading the wall-clock time as
    UTC: hour windows then align to wall-clock hours in every session time zone."""
    return F.timestamp_micros(ntz_micros(c))
