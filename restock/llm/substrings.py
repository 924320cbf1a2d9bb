"""Removal of repeated substrings with suffix arrays sorted in two stages.

Every byte covered by a string of ``SPAN`` bytes that also starts earlier (in
a smaller document, or earlier in the same one) is removed; matches stay
inside a document and are judged on the input.

1. Equal texts are put together; the row with the smallest id owns the text,
   and every other copy of ``SPAN`` bytes or more goes whole.
2. Each window of ``SPAN`` bytes of an owned text gets a fingerprint: the least
   hash of its ``GRAM``-byte strings. Equal windows have equal fingerprints, so
   windows need be compared only within one fingerprint. A run of windows with
   one fingerprint is a fragment (about 30 windows; a few percent of the bytes
   travel as hashes, no text).
3. Fragments equal to an earlier one of their fingerprint repeat it whole. Only
   fingerprints seen with different fragments, or holding an inner repeat, go
   on: the bytes of one fragment of each kind are fetched and sorted by suffix.
4. Suffix sorting in two stages: suffixes smaller than their successors are
   sorted directly, the rest follow by scanning the buckets of first bytes in
   order (suffix i goes right after suffix i + 1 decides its place). Neighbours
   whose common prefix has ``SPAN`` bytes are equal windows; all but the first
   of them in document order are repeats.

A task sorts about ``CHUNK`` bytes of whole fingerprints at a time; a
fingerprint with more than ``MANY`` kinds of fragments is instead cut into
single windows that a window function compares, so no group is collected.

Defined results: null is an empty text; texts under ``SPAN`` bytes lose
nothing; rows that repeat both id and text are one document and get the same
result; of rows with one id and different texts the one with the smaller text
hash counts as earlier; rows without an id come last; empty tables give empty
results; other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from restock.llm import common as C
from restock.session import drop_tables, materialize, scratch_table_path, written_at

SPAN = 100
GRAM = 32
RUN = 256              # most windows of one fragment (longer runs are cut)
CHUNK = 1 << 20        # bytes sorted at a time
MANY = 50_000          # kinds of fragments of one fingerprint that are sorted together
_LAST = (1 << 63) - 1  # order of rows without an id


# --------------------------------------------------------------- windows ----
def fragments(data: np.ndarray, offs: np.ndarray, span: int, gram: int) -> tuple:
    """(row, first window, windows, fingerprint, content hash, inner repeat?) of
    every run of windows with one fingerprint."""
    n, w = len(data), span - gram + 1
    wide = n - span + 1
    if wide <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(C.U), none.astype(C.U), none.astype(bool)
    C.POWERS.need(n)
    acc = np.empty(n + 1, C.U)
    acc[0] = 0
    np.cumsum((data.astype(C.U) + C.U(1)) * C.POWERS.up[:n], dtype=C.U, out=acc[1:])
    grams = C.mix((acc[gram:] - acc[:n + 1 - gram]) * C.POWERS.down[:n + 1 - gram])
    least = C.sliding_min(grams, w)
    # windows stay in a row: the starts from a row's first byte to its end - span
    last = offs[1:] - span
    rows = np.flatnonzero(last >= offs[:-1])
    valid = np.zeros(wide + 1, np.int8)
    valid[offs[rows]] = 1
    valid[last[rows] + 1] -= 1
    valid = np.cumsum(valid[:wide], dtype=np.int8).astype(bool)
    change = np.ones(wide, bool)
    change[1:] = least[1:] != least[:-1]
    change[offs[rows]] = True
    at = np.flatnonzero(change & valid)
    row = np.searchsorted(offs, at, side="right") - 1
    end = np.minimum(np.append(at[1:], wide), last[row] + 1)
    size = end - at
    # cut long runs
    parts = -(-size // RUN)
    if len(parts) and parts.max() > 1:
        i = np.repeat(np.arange(len(at)), parts)
        step = np.arange(len(i)) - np.repeat(np.cumsum(parts) - parts, parts)
        at, row, size = at[i] + step * RUN, row[i], np.minimum(size[i] - step * RUN, RUN)
    print_ = least[at]
    stop = at + size + span - 1
    content = C.mix(((acc[stop] - acc[at]) * C.POWERS.down[at]) ^ (size.astype(C.U) * C.U(0x94D049BB133111EB)))
    # grams that are least in some window; the same value twice close by: an inner repeat may be there
    top = np.zeros(len(grams) + w - 1, C.U)
    top[w - 1:w - 1 + wide] = np.where(valid, least, C.U(0))
    top = ~C.sliding_min(~top, w)
    low = np.flatnonzero(grams == top)
    value = grams[low]
    order = np.lexsort((low, value))
    value, low = value[order], low[order]
    twice = np.unique(value[1:][(value[1:] == value[:-1]) & (low[1:] - low[:-1] <= RUN + w)])
    inner = np.isin(print_, twice) if len(twice) else np.zeros(len(at), bool)
    return row, at - offs[row], size, print_, content, inner


def _fragment_batches(span: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ord_ = batch.column(1).to_numpy(zero_copy_only=False)
            key = batch.column(2).to_numpy(zero_copy_only=False)
            for lo, _, data, offs in C.text_chunks(batch.column(0)):
                row, at, size, p, content, inner = fragments(data, offs, span, gram)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(C.signed(p)), pa.array(C.signed(content)), pa.array(ord_[lo + row]),
                     pa.array(key[lo + row]), pa.array((at << 16) | (size << 1) | inner)],
                    names=["print", "content", "ord", "key", "loc"])
    return run


# --------------------------------------------------------- suffix sorting ----
def words8(text: np.ndarray) -> np.ndarray:
    """The eight bytes from every place as one number (zeros after the end)."""
    t = np.concatenate((text, np.zeros(8, np.uint8))).astype(C.U)
    t = t[:-1] << C.U(8) | t[1:]
    t = t[:-2] << C.U(16) | t[2:]
    t = t[:-4] << C.U(32) | t[4:]
    return t[:len(text)]


def suffix_order(text: np.ndarray, w8: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``text`` in the order of the ``depth`` bytes from there (at
    least), by two-stage sorting. Both arrays end in ``depth`` + 8 or more zeros."""
    n = len(text)
    # a suffix is smaller than its successor if its first byte is, or, among equal bytes, the next suffix is
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(text[1:].astype(np.int16) - text[:-1])
    nonzero = np.flatnonzero(step)
    nearest = np.searchsorted(nonzero, np.arange(n))
    small = np.zeros(n, bool)
    has = nearest < len(nonzero)
    small[has] = step[nonzero[nearest[has]]] > 0
    # stage 1: sort the smaller ones directly, eight bytes at a time within ties
    own = np.flatnonzero(small)
    own = own[np.argsort(w8[own], kind="stable")]
    group = np.zeros(len(own), np.int64)
    word = w8[own]
    group[1:] = np.cumsum(word[1:] != word[:-1])
    for d in range(8, depth, 8):
        same = np.zeros(len(own) + 1, bool)
        same[1:-1] = group[1:] == group[:-1]
        tied = np.flatnonzero(same[1:] | same[:-1])
        if not len(tied):
            break
        word = w8[np.minimum(own[tied] + d, n - 1)]
        order = np.lexsort((word, group[tied]))
        own[tied], word = own[tied][order], word[order]
        first = np.ones(len(own), bool)
        first[1:] = group[1:] != group[:-1]
        differs = np.zeros(len(tied), bool)
        differs[1:] = word[1:] != word[:-1]
        first[tied] |= differs
        group = np.cumsum(first) - 1
    # stage 2: scan the buckets; a larger suffix takes its place after its successor's
    own_cut = np.searchsorted(text[own], np.arange(257))       # own is in order of first bytes
    queues: list[list[np.ndarray]] = [[] for _ in range(256)]

    def induce(found: np.ndarray, c: int) -> np.ndarray:
        """Queue the larger predecessors of ``found``; return those of bucket ``c``."""
        before = found[found > 0] - 1
        before = before[~small[before]]
        first = text[before]
        order = np.argsort(first, kind="stable")
        before, first = before[order], first[order]
        cut = np.flatnonzero(np.diff(first)) + 1
        here = before[:0]
        for part in np.split(before, cut) if len(before) else ():
            f = int(text[part[0]])
            if f == c:
                here = part
            else:
                queues[f].append(part)
        return here

    out = []
    for c in range(256):
        wave = np.concatenate(queues[c]) if queues[c] else own[:0]
        if c == 0:
            wave = np.concatenate((wave, [n - 1]))      # the empty end: larger than nothing
        while len(wave):
            out.append(wave)
            wave = induce(wave, c)
        mine = own[own_cut[c]:own_cut[c + 1]]
        if len(mine):
            out.append(mine)
            induce(mine, c)
    return np.concatenate(out)


def common_prefix(w8: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Length of the common prefix of the suffixes at ``a`` and ``b``, up to ``most``."""
    out = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    for d in range(0, most, 8):
        x = w8[a[live] + d] ^ w8[b[live] + d]
        equal = x == 0
        if not equal.all():      # whole bytes that agree before the first difference
            out[live[~equal]] = d + sum((x[~equal] < C.U(1 << k)).astype(np.int64) for k in range(56, 0, -8))
        live = live[equal]
        out[live] = min(d + 8, most)
    return np.minimum(out, most)


def repeats(texts: list[bytes], windows: np.ndarray, rank: np.ndarray, span: int) -> list[np.ndarray]:
    """For each text, its windows (the first ``windows[i]`` places) that equal a
    window of a text of lower rank, or an earlier one of the same text."""
    size = np.array([len(t) for t in texts], np.int64)
    base = np.cumsum(size + 1) - (size + 1)
    pad = span + 16
    text = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8) if texts else np.zeros(0, np.uint8)
    joined = np.zeros(len(text) + pad, np.uint8)
    joined[:len(text)] = text + 1               # UTF-8 has no byte 255: 0 is left for the ends
    joined[base + size] = 0
    w8 = words8(joined)
    which = np.full(len(joined), -1, np.int64)
    for i, (b, w) in enumerate(zip(base.tolist(), windows.tolist())):
        which[b:b + w] = i
    order = suffix_order(joined, w8, span)
    order = order[which[order] >= 0]
    same = common_prefix(w8, order[:-1], order[1:], span) >= span
    group = np.zeros(len(order), np.int64)
    group[1:] = np.cumsum(~same)
    place = order - base[which[order]]
    by = np.lexsort((place, rank[which[order]], group))
    later = np.zeros(len(order), bool)
    later[1:] = group[by][1:] == group[by][:-1]
    hit = order[by][later]
    out: list[list] = [[] for _ in texts]
    hit.sort()
    owner = which[hit]
    for i in np.unique(owner).tolist():
        out[i] = hit[owner == i] - base[i]
    return [np.asarray(x, np.int64) for x in out]


def runs_of(places: np.ndarray) -> list[tuple[int, int]]:
    """(first, number) of the runs of consecutive places."""
    if not len(places):
        return []
    cut = np.flatnonzero(np.diff(places) != 1) + 1
    return [(int(p[0]), len(p)) for p in np.split(places, cut)]


def _sort_batches(span: int):
    """Task over rows (print, ord, key, at, size, bytes) sorted by print."""
    def solve(rows: list[list]) -> pa.RecordBatch:
        _, ord_, key, at, size, texts = rows
        order = sorted(range(len(ord_)), key=lambda i: (ord_[i], key[i], at[i]))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        out: list[tuple] = []
        for i, places in enumerate(repeats(texts, np.array(size, np.int64), rank, span)):
            out += [(ord_[i], key[i], at[i] + a, n) for a, n in runs_of(places)]
        cols = list(zip(*out)) or [(), (), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                          names=["ord", "key", "at", "size"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[list] = [[] for _ in range(6)]
        held = 0
        for batch in batches:
            cols = [c.to_pylist() for c in batch.columns]
            for row in zip(*cols):
                if held >= CHUNK and row[0] != rows[0][-1]:
                    yield solve(rows)
                    rows, held = [[] for _ in range(6)], 0
                for store, x in zip(rows, row):
                    store.append(x)
                held += len(row[5])
        if rows[0]:
            yield solve(rows)
    return run


# ----------------------------------------------------------------- Spark ----
def _hashes(text):
    return [F.xxhash64(text).alias("key"), F.xxhash64(F.lit("2"), text).alias("key2")]


def owned_texts(docs: DataFrame, id_column: str, text: str, span: int) -> DataFrame:
    """Written table (key, key2, ord, body): each text of ``span`` bytes or more
    once, with its smallest id; bucketed by key, so that joins with it move only
    the other side."""
    spark = docs.sparkSession
    t = F.col(text).cast("string")
    body = docs.select(*_hashes(t), F.coalesce(F.col(id_column).cast("long"), F.lit(_LAST)).alias("ord"),
                       t.alias("body")).where(F.octet_length("body") >= span)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = (body.repartition(buckets, "key").groupBy("key", "key2")
             .agg(F.min("ord").alias("ord"), F.first("body").alias("body")))
    name = f"owned_texts_{uuid.uuid4().hex[:12]}"
    path = scratch_table_path(spark, name)
    texts.write.bucketBy(buckets, "key").option("path", path).saveAsTable(name)
    out = written_at(spark.table(name), path)
    out._table = name
    return out


def repeated_windows(texts: DataFrame, span: int = SPAN, gram: int = GRAM, many: int = MANY) -> tuple[DataFrame, list[DataFrame]]:
    """(ord, key, at, size): windows of ``span`` bytes that also start earlier, as
    runs of ``size`` starts from ``at`` in the text ``(ord, key)``; and the written
    tables that this reads."""
    if not 8 <= gram <= span:
        raise ValueError("gram must be 8 to span")
    rows = texts.select("body", "ord", "key").mapInArrow(
        _fragment_batches(span, gram), "print long, content long, ord long, key long, loc long")
    one = Window.partitionBy("print")
    line = one.orderBy("content", "ord", "key", "loc")
    inner = F.col("loc").bitwiseAND(F.lit(1)) == 1
    seen = (rows.withColumn("n", F.count("*").over(one))
            .withColumn("low", F.min("content").over(one)).withColumn("high", F.max("content").over(one))
            .withColumn("again", F.lag("content").over(line).eqNullSafe(F.col("content")))
            .withColumn("kinds", F.dense_rank().over(one.orderBy("content")))
            .where((F.col("n") > 1) | inner)
            .withColumn("open", ~F.col("again") & ((F.col("low") != F.col("high")) | inner))
            .where("again or open"))
    seen = materialize(seen.select(
        "ord", "key", "open", "kinds", F.when(F.col("open"), F.col("print")).alias("print"),
        F.shiftright("loc", 16).alias("at"),
        F.shiftright("loc", 1).bitwiseAND(F.lit(32767)).alias("size")), "fragments")
    opened = seen.where("open")
    large = opened.groupBy("print").agg(F.max("kinds").alias("kinds")).where(F.col("kinds") > many).select("print")
    wanted = (opened.groupBy("key", "ord")
              .agg(F.collect_list(F.struct("print", "at", "size")).alias("want")))
    # joined on the bucketed key alone; the id settles equal keys of different texts
    found = (wanted.withColumnRenamed("ord", "o").join(texts.select("key", "ord", "body"), "key")
             .where(F.col("o") - F.col("ord") == 0)
             .select("ord", "key", F.col("body").cast("binary").alias("body"), F.explode("want").alias("f"))
             .select("f.print", "ord", "key", "f.at", "f.size",
                     F.expr(f"substring(body, cast(f.at + 1 as int), cast(f.size + {span - 1} as int))").alias("bytes")))
    found = materialize(found, "fragment-bytes")
    cols = "ord long, key long, at long, size long"
    done = (found.join(large, "print", "left_anti")
            .repartition("print").sortWithinPartitions("print").mapInArrow(_sort_batches(span), cols))
    each = (found.join(large, "print")
            .select("ord", "key", "at", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1)).alias("i"))
            .select("ord", "key", (F.col("at") + F.col("i")).alias("at"),
                    F.expr(f"substring(bytes, cast(i + 1 as int), {span})").alias("window")))
    each = (each.withColumn("nth", F.row_number().over(
                Window.partitionBy("window").orderBy("ord", "key", "at")))
            .where("nth > 1").select("ord", "key", "at", F.lit(1).cast("long").alias("size")))
    return seen.where("not open").select("ord", "key", "at", "size").unionByName(done).unionByName(each), [seen, found]


def _keep_batches(span: int, with_bytes: bool):
    """Task over (body, spans): what is removed and what stays."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for body, spans in zip(batch.column(0).cast(pa.large_binary()), batch.column(1)):
                raw = body.as_buffer().to_pybytes()
                merged: list[list[int]] = []
                for a, b in sorted((s["at"], s["at"] + s["size"] + span - 1) for s in spans.as_py() or ()):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b)
                    else:
                        merged.append([a, b])
                edge = [0, *(x for m in merged for x in m), len(raw)]
                kept = b"".join(raw[edge[i]:edge[i + 1]] for i in range(0, len(edge), 2))
                for store, x in zip(out, (len(raw) - len(kept), len(merged), hashlib.sha256(kept).hexdigest(),
                                          kept if with_bytes else None)):
                    store.append(x)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string()),
                 pa.array(out[3], pa.binary()), *batch.columns[2:]],
                names=["n_removed", "n_spans", "kept_sha256", "kept", "ord", "key", "key2"])
    return run


def deduplicate(docs: DataFrame, id_column: str = "doc_id", text: str = "text", span: int = SPAN,
                gram: int = GRAM, many: int = MANY, with_bytes: bool = True) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, kept) for every row; ``kept``
    are the bytes that stay (null unless ``with_bytes``)."""
    texts = owned_texts(docs, id_column, text, span)
    windows, tables = repeated_windows(texts, span, gram, many)
    spans = (windows.groupBy("key", "ord")
             .agg(F.collect_list(F.struct("at", "size")).alias("spans"))
             .withColumnRenamed("key", "k").withColumnRenamed("ord", "o"))
    kept = (texts.join(spans, (F.col("key") == F.col("k")) & (F.col("o") - F.col("ord") == 0), "left")
            .select("body", "spans", "ord", "key", "key2")
            .mapInArrow(_keep_batches(span, with_bytes),
                        "n_removed long, n_spans long, kept_sha256 string, kept binary, ord long, key long, key2 long"))
    kept = materialize(kept, "kept")
    drop_tables(texts, *tables)
    docs.sparkSession.sql(f"DROP TABLE IF EXISTS {texts._table}")
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_column), *_hashes(t), F.octet_length(t).cast("long").alias("n_bytes"),
                       F.when(F.octet_length(t) < span, t.cast("binary")).alias("short"))
    own = F.coalesce(F.col(id_column).cast("long"), F.lit(_LAST)) == F.col("ord")
    long_ = F.col("n_bytes") >= span
    none = F.expr("X''")
    return (rows.join(kept, ["key", "key2"], "left").select(
        id_column, "n_bytes",
        F.when(~long_, F.lit(0).cast("long")).when(own, F.col("n_removed")).otherwise(F.col("n_bytes")).alias("n_removed"),
        F.when(~long_, F.lit(0).cast("long")).when(own, F.col("n_spans")).otherwise(F.lit(1).cast("long")).alias("n_spans"),
        F.when(~long_, F.sha2("short", 256)).when(own, F.col("kept_sha256")).otherwise(F.sha2(none, 256)).alias("kept_sha256"),
        F.when(~long_, F.col("short")).when(own, F.col("kept")).otherwise(none).alias("kept")))


def query(spark, sf_dir: str) -> DataFrame:
    """op10: what is left of every document."""
    return deduplicate(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_bytes=False).drop("kept")
