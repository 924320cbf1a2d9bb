"""Helpers shared by the text operators: whole-buffer access to text columns
inside Arrow tasks, 64-bit hashes over byte and word ranges, fixed-size bit
filters, and connected components as Spark joins."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from restock.session import drop_tables, materialize, written_at

U = np.uint64
CHUNK_BYTES = 1 << 20          # text handled by one numpy step
_BASE = 0x9E3779B97F4A7C15     # odd, so invertible modulo 2**64
FILTER_BITS = 26               # a bit filter holds 2**26 bits (8 MB) at any size of data


def whole_rows(docs: DataFrame, text: str, columns: list[str] | None = None) -> DataFrame:
    """(text, row): the text column as a string and ``columns`` (all by default)
    as one struct, so that no column name can clash with those of an operator."""
    named = [F.col("`" + c.replace("`", "``") + "`") for c in columns or docs.columns]
    return docs.select(F.col(f"`{text}`").cast("string").alias("text"), F.struct(*named).alias("row"))


def with_row(ddl: str, rows: DataFrame) -> StructType:
    """The schema ``ddl`` with the ``row`` column of ``rows`` after it."""
    return StructType.fromDDL(ddl).add("row", rows.schema["row"].dataType)


def text_chunks(column, limit: int = CHUNK_BYTES) -> Iterator[tuple]:
    """(first row, last row + 1, bytes, offsets) of runs of consecutive rows
    with about ``limit`` bytes in all; a longer row stands alone. Null is empty."""
    arr = column.cast(pa.large_binary())
    if arr.null_count:
        arr = pc.fill_null(arr, b"")
    n = len(arr)
    if not n:
        return
    offs = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset:arr.offset + n + 1]
    raw = arr.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1)
        yield lo, hi, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (xor-shift and multiply)."""
    h = (h ^ (h >> U(32))) * U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> U(32))) * U(0xD6E8FEB86659FD93)
    return h ^ (h >> U(32))


class Powers:
    """Powers of the hash base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self):
        self.up = np.ones(1, U)
        self.down = np.ones(1, U)

    def need(self, n: int) -> None:
        if len(self.up) <= n:
            size = max(n + 1, 2 * CHUNK_BYTES)
            inv = pow(_BASE, -1, 1 << 64)
            for name, b in (("up", _BASE), ("down", inv)):
                a = np.full(size, b, U)
                a[0] = 1
                setattr(self, name, np.cumprod(a, dtype=U))


POWERS = Powers()


def range_hashes(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``codes[start:end]`` for many ranges at once."""
    n = len(codes)
    POWERS.need(n)
    acc = np.empty(n + 1, U)
    acc[0] = 0
    np.cumsum((codes.astype(U) + U(1)) * POWERS.up[:n], dtype=U, out=acc[1:])
    return mix((acc[end] - acc[start]) * POWERS.down[start] + (end - start).astype(U))


def sliding_hash(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every ``k`` consecutive values of ``h`` (len(h) - k + 1 of them)."""
    m = len(h) - k + 1
    if m <= 0:
        return np.zeros(0, U)
    acc = np.zeros(m, U)
    c = 1
    for j in range(k):
        c = c * 0xBF58476D1CE4E5B9 % (1 << 64)
        acc += h[j:j + m] * U(c)
    return mix(acc)


def sliding_min(h: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values, by doubling."""
    m = len(h) - w + 1
    if m <= 0:
        return h[:0]
    span, cur = 1, h
    while span * 2 <= w:
        cur = np.minimum(cur[:-span], cur[span:])
        span *= 2
    return np.minimum(cur[:m], cur[w - span:w - span + m])


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


# ------------------------------------------------------------ bit filter ----
def bit_filter(hashes: DataFrame, column: str, bits: int = FILTER_BITS) -> np.ndarray:
    """A filter of ``2**bits`` bits over a hash column, as bytes.

    Its size is fixed whatever the table holds (a fuller filter only lets
    more candidates through to the exact join that follows).
    """
    x = F.col(column).bitwiseAND(F.lit((1 << bits) - 1)) + 1
    chunks = (hashes.where(F.col(column).isNotNull())
              .groupBy(F.bitmap_bucket_number(x).alias("b"))
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position(x)).alias("m")))
    out = np.zeros(1 << (bits - 3), np.uint8)
    for row in chunks.toLocalIterator():        # at most 2**(bits - 15) rows of 4 KB
        part = np.frombuffer(row["m"], np.uint8)
        at = (row["b"] - 1) * 4096
        out[at:at + len(part)] = part
    return out


def in_filter(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    x = (h & U(len(bitmap) * 8 - 1)).astype(np.int64)
    return (bitmap[x >> 3] >> (x & 7).astype(np.uint8)) & 1 == 1


# ------------------------------------------------------------ components ----
def components(edges: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """Connected components of an edge list, as (node, root): root is the
    least node of the component. Alternates large-star and small-star steps
    (each a grouped minimum and a join), written to the checkpoint folder
    once a round, until nothing changes."""
    cur = materialize(edges.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u"))
                      .where("u < v").distinct(), f"{name}-edges")
    while True:
        # large star: every neighbour above a node points to the least of its neighbourhood
        both = cur.unionByName(cur.select(F.col("u").alias("v"), F.col("v").alias("u")))
        low = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"))
        large = (both.join(low, "v").where(F.col("u") > F.col("v"))
                 .select(F.col("u").alias("v"), F.col("m").alias("u")).where("u < v").distinct())
        # small star: a node and its lower neighbours point to the least of them
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = (large.join(low, "v")
                 .select(F.when(F.col("u") == F.col("m"), F.col("v")).otherwise(F.col("u")).alias("v"),
                         F.col("m").alias("u")).where("u < v").distinct())
        new = materialize(small, f"{name}-edges")
        same = (cur.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
                == new.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())
        drop_tables(cur)
        cur = new
        if same:
            break
    return written_at(cur.select(F.col("v").alias("node"), F.col("u").alias("root")), cur._written_at)
