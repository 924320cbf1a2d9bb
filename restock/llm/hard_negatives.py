"""Hard-negative mining with exact integer scores from float32 products.

Scores are inner products of integer vectors. A residue number system makes
them exact on float32 matrix units: both matrices are taken modulo a few
primes (residues around zero), each pair of residue matrices is multiplied in
float32 over at most ``DEPTH`` columns at a time, where no partial sum reaches
2**24, and the signed scores are put together by Chinese remaindering with
digits around zero. The primes are as many as the largest possible score needs
(twice its size below their product), so no score is ever rounded.

Anchors are a stated set of rows; every anchor is scored against every row, in
blocks. Rows and anchors are dealt out on a grid: a task holds one part of at
most ``PART`` rows and one of as many anchors, so what is shuffled is
rows x anchor parts + anchors x row parts. A first pass keeps each anchor's
best ``positives`` rows of its label, a second one takes, for each of them, the
best rows of other labels whose score lies in the window. Only those few leave
a task; a ranked window over (anchor) or (anchor, positive) picks the result.

Defined results: rows with a null label, a null vector, or any null or
non-finite component take no part, nor do rows whose id is null or no whole
number, or whose components are too large for an exact 64-bit score
(components squared times length up to 2**58). Components beyond the end of a
shorter vector count as zero; an empty vector scores zero with all. "Other"
rows are rows of another id. Repeated rows are rows of their own as positives
and negatives; repeated anchors are mined once. An anchor without positives, or
a positive without a negative in its window, gives no row; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from restock.session import drop_tables, materialize

POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95         # a negative's score in hundredths of the positive's
SCALE = 256
PART = 1 << 16             # rows, or anchors, of a part at most
LEAST = 1 << 9             # rows of a part below which more parts are no use
DEPTH = 64                 # columns of one float32 product
HALF = 510                 # residues lie within +-HALF: DEPTH * HALF**2 < 2**24
EXACT = float(1 << 58)     # scores stay below; 20 of them fit 64 bits
TILE_A, TILE_R = 128, 8192
NONE = np.iinfo(np.int64).min


# ------------------------------------------------------------- arithmetic ----
def primes_for(bound: int) -> list[int]:
    """The largest odd primes up to ``2 * HALF + 1`` whose product exceeds twice ``bound``."""
    out, product, p = [], 1, 2 * HALF + 1
    while product <= 2 * bound or not out:
        if all(p % d for d in range(3, int(p ** 0.5) + 1, 2)):
            out.append(p)
            product *= p
        p -= 2
    return out


def centred(x: np.ndarray, p: int) -> np.ndarray:
    return (x + p // 2) % p - p // 2


def residues(q: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    return [centred(q, p).astype(np.float32) for p in primes]


def scores(a: list[np.ndarray], r: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact inner products of the rows of two residue matrices."""
    out, weight = None, 1
    for x, y, p in zip(a, r, primes):
        part = np.zeros((len(x), len(y)), np.int64)
        for c in range(0, x.shape[1], DEPTH):
            part += (x[:, c:c + DEPTH] @ y[:, c:c + DEPTH].T).astype(np.int64)
        if out is None:
            out = centred(part, p)
        else:                                # the digit that turns the score so far into one right modulo p too
            out += weight * centred((part - out) % p * pow(weight, -1, p), p)
        weight *= p
    return out


def best(score: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(line, column) of each line's ``k`` highest allowed scores, earlier columns first at ties."""
    x = np.where(allowed, score, NONE)
    n = x.shape[1]
    floor = np.partition(x, n - k, axis=1)[:, n - k] if n > k else np.full(len(x), NONE)
    i, j = np.nonzero(x >= np.maximum(floor, NONE + 1)[:, None])
    return _first(i, -x[i, j], j, k, i, j)


def _first(group, high, low, k: int, *cols) -> tuple:
    """``cols`` of the first ``k`` of each group by (high, low)."""
    order = np.lexsort((low, high, group))
    g = group[order]
    start = np.flatnonzero(np.diff(g, prepend=-1))
    rank = np.arange(len(g)) - np.repeat(start, np.diff(start, append=len(g)))
    return tuple(c[order[rank < k]] for c in cols)


def _matrix(lists: pa.ListArray) -> np.ndarray:
    offsets = np.asarray(lists.offsets, np.int64)
    values = np.asarray(lists.values)[offsets[0]:offsets[-1]].astype(np.int64)
    n = np.diff(offsets)
    out = np.zeros((len(n), int(n.max(initial=0))), np.int64)
    at = np.repeat(offsets[:-1] - offsets[0], n)
    out[np.repeat(np.arange(len(n)), n), np.arange(len(values)) - at] = values
    return out


def _part(table: pa.Table):
    """One part in id order: the table, places of anchors and of rows, ids, anchors' marks, label codes, vectors."""
    table = table.sort_by("id").combine_chunks()
    label = np.asarray(table["label"].combine_chunks().dictionary_encode().indices)
    q = _matrix(table["q"].combine_chunks())
    ids = np.asarray(table["id"])
    anchors, rows = (np.flatnonzero(np.asarray(table["is_anchor"]) == x) for x in (True, False))
    mark = np.asarray(table["mark"].combine_chunks().fill_null(0))
    return table, anchors, rows, ids, mark, label, q


def _tiles(anchors: np.ndarray, rows: np.ndarray, q: np.ndarray, primes: list[int]):
    """(anchors' places, (rows' places, scores) tile by tile) of each tile of anchors."""
    res = residues(q, primes)
    for lo in range(0, len(anchors), TILE_A):
        a = anchors[lo:lo + TILE_A]
        left = [x[a] for x in res]
        yield a, ((rows[r:r + TILE_R], scores(left, [x[rows[r:r + TILE_R]] for x in res], primes))
                  for r in range(0, len(rows), TILE_R))


FOUND = "anchor_id long, mark long, id long, score long"


def _positives(primes: list[int], k: int):
    def run(table: pa.Table) -> pa.Table:
        table, anchors, rows, ids, mark, label, q = _part(table)
        out = []
        for a, tiles in _tiles(anchors, rows, q, primes):
            found = [(a[i], r[j], s[i, j]) for r, s in tiles
                     for i, j in [best(s, (label[a][:, None] == label[r]) & (ids[a][:, None] != ids[r]), k)]]
            if found:
                i, j, s = map(np.concatenate, zip(*found))
                out.append(_first(i, -s, j, k, i, j, s))
        i, j, s = map(np.concatenate, zip(*out)) if out else (np.zeros(0, np.int64),) * 3
        return pa.table({"anchor_id": ids[i], "mark": mark[i], "id": ids[j], "score": s})
    return run


MINED = "anchor_id long, mark long, place int, positive_id long, positive_score long, id long, score long"


def _negatives(primes: list[int], k: int, low: int, high: int):
    def run(table: pa.Table) -> pa.Table:
        table, anchors, rows, ids, mark, label, q = _part(table)
        pos_id, pos_score = _matrix(table["pos_ids"].combine_chunks()), _matrix(table["pos_scores"].combine_chunks())
        count = np.asarray(table["pos_ids"].combine_chunks().value_lengths().fill_null(0))
        out = []
        for a, tiles in _tiles(anchors, rows, q, primes):
            found = []
            for r, s in tiles:
                other = label[a][:, None] != label[r]
                for place in range(pos_score.shape[1]):
                    p = pos_score[a, place][:, None]
                    # low * p <= 100 * s <= high * p in whole numbers that fit 64 bits
                    inside = other & (count[a] > place)[:, None] & (s >= -(-low * p // 100)) & (s <= high * p // 100)
                    i, j = best(s, inside, k)
                    found.append((a[i], np.full(len(i), place), r[j], s[i, j]))
            if found:
                i, place, j, s = map(np.concatenate, zip(*found))
                out.append(_first(i * pos_score.shape[1] + place, -s, j, k, i, place, j, s))
        i, place, j, s = map(np.concatenate, zip(*out)) if out else (np.zeros(0, np.int64),) * 4
        at = (i, place) if len(i) else (i, i)
        return pa.table({"anchor_id": ids[i], "mark": mark[i], "place": place.astype(np.int32),
                         "positive_id": pos_id[at] if len(i) else i, "positive_score": pos_score[at] if len(i) else i,
                         "id": ids[j], "score": s})
    return run


# ------------------------------------------------------------------ Spark ----
def integer_rows(rows: DataFrame, id: str, label: Column, vector: str, scale: int = SCALE) -> DataFrame:
    """(id long, label string, q array<int>) of the rows that take part."""
    finite = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    src = rows.select(F.col(f"`{id}`").try_cast("long").alias("id"), label.cast("string").alias("label"),
                      F.col(f"`{vector}`").cast("array<double>").alias("v"))
    src = src.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()).where(finite)
    q = src.select("id", "label", F.transform("v", lambda x: F.floor(x * scale).cast("double")).alias("q"))
    most = F.coalesce(F.array_max(F.transform("q", F.abs)), F.lit(0.0))
    return (q.where(F.size("q") * most * most < EXACT)
            .select("id", "label", F.col("q").cast("array<int>").alias("q")))


def _dealt(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int) -> DataFrame:
    """Anchors and rows on the grid of parts, in one frame grouped by (g, h).

    Tasks take about four parts each, so that chance evens their sizes out."""
    spark = rows.sparkSession
    tasks = 2 * spark.sparkContext.defaultParallelism
    down = -(-n_anchors // PART)
    across = max(-(-n_rows // PART), min(-(-n_rows // LEAST), 4 * tasks))
    # a row's own part is drawn before its copies are made, so that all copies agree on it
    a = (anchors.withColumn("g", F.pmod(F.xxhash64("id", "mark"), F.lit(down))).withColumn("is_anchor", F.lit(True))
         .withColumn("h", F.explode(F.expr(f"sequence(0L, {across - 1}L)"))))
    none = F.lit(None)
    given = {"mark": none.cast("long"), "pos_ids": none.cast("array<long>"), "pos_scores": none.cast("array<long>")}
    r = (rows.withColumn("h", F.pmod(F.xxhash64(F.monotonically_increasing_id(), "id"), F.lit(across))).withColumn("is_anchor", F.lit(False))
         .withColumn("g", F.explode(F.expr(f"sequence(0L, {down - 1}L)")))
         .withColumns({k: v for k, v in given.items() if k in anchors.columns}))
    return a.unionByName(r).repartition(max(1, down * across // 4), "g", "h").groupBy("g", "h")


def mine(rows: DataFrame, anchor: Column, id: str = "vec_id", label: Column | str = "label", vector: str = "embedding",
         positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchor`` is a condition on a column named ``id``; ``label`` may be an
    expression over the input's columns."""
    spark = rows.sparkSession
    label = F.col(f"`{label}`") if isinstance(label, str) else label
    # written once: the two passes deal the same rows, and rows are numbered by their place in the files
    table = materialize(integer_rows(rows, id, label, vector, scale), "negatives-rows")
    chosen = table.where(anchor).select("*", F.xxhash64("label", "q").alias("mark")).dropDuplicates(["id", "mark"])
    size = F.size("q") * F.pow(F.coalesce(F.array_max(F.transform("q", F.abs)), F.lit(0)), 2)
    n_rows, bound = table.agg(F.count("*"), F.coalesce(F.max(size), F.lit(0.0))).first()
    n_anchors = chosen.count()
    empty = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    if not n_anchors:
        drop_tables(table)
        return empty
    primes = primes_for(int(bound))
    one = Window.partitionBy("anchor_id", "mark").orderBy(F.col("score").desc(), "id")
    found = _dealt(chosen, table, n_anchors, n_rows).applyInArrow(_positives(primes, positives), FOUND)
    found = found.withColumn("place", F.row_number().over(one)).where(F.col("place") <= positives)
    found = found.groupBy("anchor_id", "mark").agg(F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("p"))
    found = found.select(F.col("anchor_id").alias("id"), "mark", F.col("p.id").alias("pos_ids"), F.col("p.score").alias("pos_scores"))
    # written, so that the second pass deals out the same rows if a task runs again
    paired = materialize(chosen.join(found, ["id", "mark"]), "negatives-anchors")
    mined = _dealt(paired, table, n_anchors, n_rows).applyInArrow(_negatives(primes, negatives, low, high), MINED)
    lane = Window.partitionBy("anchor_id", "mark", "place").orderBy(F.col("score").desc(), "id")
    mined = mined.withColumn("rank", F.row_number().over(lane)).where(F.col("rank") <= negatives)
    out = materialize(mined.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                                   F.col("score").alias("negative_score")), "negatives")
    drop_tables(table, paired)
    return out


SQL = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
           FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, r.vec_id AS id, r.label = a.label AS same,
             list_inner_product(a.v, r.v)::BIGINT AS score
      FROM e a JOIN e r ON a.vec_id % 50 = 0 AND r.vec_id <> a.vec_id),
p AS (SELECT anchor_id, id, score, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS place
      FROM s WHERE same QUALIFY place <= 5)
SELECT p.anchor_id, p.id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.place ORDER BY s.score DESC, s.id) AS INTEGER) AS rank,
       s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
     AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
QUALIFY rank <= 3
"""


def query(spark, sf_dir: str) -> DataFrame:
    """op11: hard negatives of every fiftieth embedding against all, with a seventh of the labels shifted."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows, F.col("id") % 50 == 0, label=label)
