"""Document fingerprints: one-permutation MinHash with optimal densification and packed low bits.

Every shingle of a text is hashed once. The top bits of the hash choose a bin, the rest is the value,
and a bin keeps its smallest value (Li, Owen and Zhang, 2012). An empty bin takes the value of the first
non-empty bin on a probe sequence that depends on the bin and the attempt only, the same for every
document (Shrivastava, "Optimal Densification for Fast and Accurate Minwise Hashing", 2017). Of each
bin the low ``BITS`` bits are stored (Li and Koenig, 2010), and likeness corrects the agreement of the
packed bins for the chance that unequal values have equal low bits, 2 ** -BITS.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.llm import words as W
from shelfrank.llm.tables import shuffle_partitions

SHINGLE = 5
BINS = 256
BITS = 4
#: Ranges of doc_id that are sorted on their own: RANGES_PER_PARTITION for each shuffle partition, at
#: most MAX_RANGES, which bounds the range bounds that reach the driver.
RANGES_PER_PARTITION = 4
MAX_RANGES = 16384

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def bins(hashes: np.ndarray, rows: np.ndarray, n_bins: int = BINS) -> np.ndarray:
    """Smallest hash of every bin, one row for each text; empty bins hold the largest uint64.

    The bin is the hash's top bits, so the smallest hash of a bin has the smallest value."""
    out = np.full((len(rows) - 1) * n_bins, _EMPTY, np.uint64)
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    shift = np.uint64(64 - (n_bins.bit_length() - 1))
    np.minimum.at(out, row * n_bins + (hashes >> shift).astype(np.int64), hashes)
    return out.reshape(-1, n_bins)


def probe(bin_no: np.ndarray, attempt: int, n_bins: int) -> np.ndarray:
    """The bin that an empty bin looks at in this attempt. After 64 * n_bins random attempts the
    neighbours follow in order, so a row with a non-empty bin always ends."""
    if attempt >= 64 * n_bins:
        return (bin_no + attempt) % n_bins
    x = bin_no.astype(np.uint64) + np.uint64(1) + np.uint64((attempt + 1) << 32)
    return (W.mix(x * W.GOLDEN) % np.uint64(n_bins)).astype(np.int64)


def densify(table: np.ndarray) -> np.ndarray:
    """Fill the empty bins of every row that has a non-empty one."""
    out, n_bins = table.copy(), table.shape[1]
    empty = table == _EMPTY
    filled = n_bins - empty.sum(axis=1)
    for r in np.flatnonzero(filled == 1):  # every probe sequence ends at the only value
        out[r] = table[r][~empty[r]][0]
    r, b = np.nonzero(empty & (filled > 1)[:, None])
    attempt = 0
    while len(r):
        at = probe(b, attempt, n_bins)
        found = ~empty[r, at]
        out[r[found], b[found]] = table[r[found], at[found]]
        r, b = r[~found], b[~found]
        attempt += 1
    return out


def pack(table: np.ndarray, bits: int = BITS) -> list[str]:
    """Lower-case hex of the low bits of every row's bins, bin 0 first; "" for a row without values.

    A value is mixed with its bin's number first: else the copies of one value, which short texts
    have in many bins, would agree with another value's copies by one chance for all."""
    mixed = W.mix(table + np.arange(1, table.shape[1] + 1, dtype=np.uint64) * W.GOLDEN)
    low = (mixed & np.uint64((1 << bits) - 1)).astype(np.uint8)
    planes = (low[:, :, None] >> np.arange(bits - 1, -1, -1, dtype=np.uint8)) & 1
    packed = np.packbits(planes.reshape(len(table), -1), axis=1)
    blank = table[:, 0] == _EMPTY
    return ["" if e else row.tobytes().hex() for row, e in zip(packed, blank.tolist())]


def fingerprints(column: pa.Array, size: int = SHINGLE, n_bins: int = BINS, bits: int = BITS) -> list[str]:
    """Fingerprint of every text over its distinct ``size``-word shingles (white space separates words,
    A-Z lower-cased; a shorter text is one shingle). Null and wordless texts give ""."""
    out: list[str] = []
    for a, b in W.slices(column):
        w = W.words(column.slice(a, b - a))
        out += pack(densify(bins(*W.shingles(w.hashes, w.rows, size), n_bins)), bits)
    return out


def likeness(a: str, b: str, n_bins: int = BINS, bits: int = BITS) -> float:
    """Estimated Jaccard similarity, 0 to 1: (agreement - C) / (1 - C) with C = 2 ** -bits.
    Two wordless texts are alike (1), a wordless and another are not (0)."""
    if not a or not b:
        return float(a == b)
    x = np.frombuffer(bytes.fromhex(a), np.uint8) ^ np.frombuffer(bytes.fromhex(b), np.uint8)
    differ = np.unpackbits(x).reshape(n_bins, bits).any(axis=1)
    agree = 1 - float(differ.mean())
    chance = 2.0 ** -bits
    return max(0.0, (agree - chance) / (1 - chance))


def edited(text: str, following: str) -> str:
    """``text`` with its last floor(n / 3) code points replaced by the first as many (or all) of the
    following text."""
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
       "near_edited double, near_next double")


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (part, place): every row meets the next one of its part. The last row of a part
    is a copy of the next part's first row and gives no output."""
    held: tuple[int, int | None, str, str] | None = None
    for whole in batches:
        for lo, hi in W.slices(whole.column("text")):
            batch = whole.slice(lo, hi - lo)
            parts, ids = batch.column("part").to_pylist(), batch.column("doc_id").to_pylist()
            texts, tails = batch.column("text").to_pylist(), batch.column("tail").to_pylist()
            marks = fingerprints(batch.column("text"))
            rows: list[tuple] = []
            for part, doc_id, text, tail, mark in zip(parts, ids, texts, tails, marks):
                if held is not None and held[0] == part:
                    rows.append((held[1], len(held[2]), edited(held[2], text), held[3], likeness(held[3], mark)))
                held = None if tail else (part, doc_id, text, mark)
            if rows:
                after = fingerprints(pa.array([r[2] for r in rows], pa.large_string()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                     pa.array([_sha(r[2]) for r in rows]), pa.array([r[3] for r in rows]), pa.array(after),
                     pa.array([likeness(r[3], f) for r, f in zip(rows, after)], pa.float64()),
                     pa.array([r[4] for r in rows], pa.float64())],
                    names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def with_next(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness to each other and to the
    next document's (descending doc_id; after the last comes the first).

    ``docs`` has doc_id and text; other columns are ignored. A null text is empty. Rows with equal
    doc_id follow each other by text; rows without doc_id come last. A single row is its own next.

    The order is global without a global sort task: some of the doc_ids themselves (quantiles) cut the
    order into ranges, every range is sorted on its own, and the first row of a range is copied to the
    end of the range before it.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = shuffle_partitions(spark)
    want = min(MAX_RANGES, RANGES_PER_PARTITION * n)
    steps = [i / want for i in range(1, want)]
    got = base.agg(F.percentile_approx("doc_id", steps or [0.5], 10 * want).alias("cuts"), F.max("doc_id").alias("top"),
                   F.count_if(F.col("doc_id").isNull()).alias("nulls")).first()
    cuts = sorted({x for x in (got["cuts"] or []) if x < got["top"]}, reverse=True)
    # First doc_id of every range, descending; range p holds doc_ids from starts[p] down to starts[p + 1] + 1.
    starts = ([got["top"]] if got["top"] is not None else []) + cuts
    ranges = len(starts) + bool(got["nulls"])
    below = np.array([~x for x in starts], np.int64)  # ascending: ~ turns the order round

    @F.arrow_udf("array<int>")
    def places(ids: pa.Array, known: pa.Array) -> pa.Array:
        """The range of a row, then the range before it where the row is the first of its range (every
        row without doc_id may be the first of the last range; the sort picks one)."""
        turned, has = ~ids.to_numpy(), known.to_numpy(zero_copy_only=False)
        at = np.where(has, np.searchsorted(below, turned, side="right") - 1, len(below))
        first = ~has | np.isin(turned, below)
        return pa.array([[p, (p - 1) % ranges] if f else [p] for p, f in zip(at.tolist(), first.tolist())], pa.list_(pa.int32()))

    # A copy in the range before (or, for a single range, in the same one) is marked as tail.
    spread = base.withColumn(
        "places", places(F.coalesce("doc_id", F.lit(0)), F.col("doc_id").isNotNull())).select(
        "doc_id", "text", F.posexplode("places").alias("copy", "part")).withColumn("tail", F.col("copy") == 1)
    order = [F.asc("part"), F.asc("tail"), F.desc_nulls_last("doc_id"), F.asc("text")]
    return spread.repartition(n, "part").sortWithinPartitions(*order).select(
        "part", "doc_id", "text", "tail").mapInArrow(_walk, OUT)
