"""Benchmark decontamination by winnowing over word k-grams.

Both sides lower-case A-Z and take words of ASCII letters, digits and every
character beyond ASCII. A benchmark item gives windows of ``SPAN`` = 10
consecutive words; an item with fewer words is one window. In every window
the least hash of its ``SPAN - GUARD + 1`` word 5-grams is the window's
fingerprint, so equal windows have equal fingerprints: no shared span of 10
words can be missed. Document fingerprints meet those of the benchmark
through a bit filter sized by the benchmark's windows (2**30 bits, 128 MB, at
most; a fuller one only lets more through to the exact join); a hit is extended to the ten-word window
around it, which passes a second filter of window hashes, and the words of
the few windows left are joined with the benchmark's exactly. For an item of
m < 10 words the whole item is the fingerprint (a window of one m-gram).

Defined results: a null or empty text (or one without words) has no words and
no hits; a null item text gives no window; an item without an id counts as no
item but its words still hit; repeated rows each get their own result; empty
tables give empty or clean results; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from restock.llm import common as C
from restock.session import drop_tables, materialize

SPAN = 10
GRAM = 5

_CODE = np.zeros(256, np.uint8)     # lower-cased word bytes; 0 parts words
for _b in range(256):
    if 0x30 <= _b <= 0x39 or 0x61 <= _b <= 0x7A or _b >= 0x80:
        _CODE[_b] = _b
    elif 0x41 <= _b <= 0x5A:
        _CODE[_b] = _b + 32


def words_of(data: np.ndarray, offs: np.ndarray) -> tuple:
    """(codes, word starts, word ends, first word of each row + total)."""
    codes = _CODE[data]
    word = codes != 0
    first = np.zeros(len(data) + 1, bool)
    first[offs] = True                      # a row's end parts words too
    start = word.copy()
    start[1:] &= ~word[:-1] | first[1:-1]
    end = word.copy()
    end[:-1] &= ~word[1:] | first[1:-1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return codes, starts, ends, np.searchsorted(starts, offs)


def _windows(wh: np.ndarray, wrow: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint of every window of SPAN words, and whether it stays in one row."""
    prints = C.sliding_min(C.sliding_hash(wh, GRAM), SPAN - GRAM + 1)
    whole = wrow[:len(prints)] == wrow[SPAN - 1:SPAN - 1 + len(prints)]
    return prints, whole


def _text(codes: np.ndarray, starts, ends, i: int, m: int) -> bytes:
    raw = codes[starts[i]:ends[i + m - 1]].tobytes()
    return b" ".join(x for x in raw.split(b"\0") if x)


def _benchmark_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for lo, _, data, offs in C.text_chunks(batch.column(1)):
            codes, starts, ends, first = words_of(data, offs)
            wh = C.range_hashes(codes, starts, ends)
            out: dict[str, list] = {k: [] for k in ("item_id", "m", "print", "hash", "words")}
            for r in range(len(offs) - 1):
                a, n = first[r], first[r + 1] - first[r]
                m = min(n, SPAN)
                if not n:
                    continue
                h = C.sliding_hash(wh[a:a + n], int(m))
                p = C.sliding_min(C.sliding_hash(wh[a:a + n], GRAM), SPAN - GRAM + 1) if m == SPAN else h
                out["item_id"] += [ids[lo + r].as_py()] * len(h)
                out["m"] += [int(m)] * len(h)
                out["print"] += C.signed(p).tolist()
                out["hash"] += C.signed(h).tolist()
                out["words"] += [_text(codes, starts, ends, a + i, int(m)) for i in range(len(h))]
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                ("item_id", ids.type), ("m", pa.int32()), ("print", pa.int64()),
                ("hash", pa.int64()), ("words", pa.binary())]))


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, m, print, hash, words): every window of every item."""
    src = benchmark.select("item_id", "text")
    kind = src.schema["item_id"].dataType.simpleString()
    return src.mapInArrow(_benchmark_batches,
                          f"item_id {kind}, m int, print long, hash long, words binary")


_HITS = pa.list_(pa.struct([("at", pa.int32()), ("m", pa.int32()), ("words", pa.binary())]))


def _document_batches(lengths: list[int], prints, hashes):
    """Task over (text, row): number of words and the windows that pass both filters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        print_bits, hash_bits = prints.value, hashes.value
        for batch in batches:
            for lo, hi, data, offs in C.text_chunks(batch.column(0)):
                codes, starts, ends, first = words_of(data, offs)
                n_words = np.diff(first)
                wh = C.range_hashes(codes, starts, ends)
                wrow = np.repeat(np.arange(len(n_words)), n_words)
                found: list[list] = [[] for _ in range(len(n_words))]
                for m in lengths:
                    if m == SPAN:
                        p, whole = _windows(wh, wrow)
                    else:
                        p = C.sliding_hash(wh, m)
                        whole = wrow[:len(p)] == wrow[m - 1:m - 1 + len(p)]
                    at = np.flatnonzero(whole & C.in_filter(print_bits, p)) if len(p) else p
                    if not len(at):
                        continue
                    # extend each hit to its window: the words from at to at + m
                    h = np.zeros(len(at), np.uint64)
                    c = 1
                    for j in range(m):
                        c = c * 0xBF58476D1CE4E5B9 % (1 << 64)
                        h += wh[at + j] * np.uint64(c)
                    at = at[C.in_filter(hash_bits, C.mix(h))]
                    for i in at.tolist():
                        r = int(wrow[i])
                        found[r].append({"at": i - int(first[r]), "m": m,
                                         "words": _text(codes, starts, ends, i, m)})
                yield pa.RecordBatch.from_arrays(
                    [pa.array(n_words, pa.int64()), pa.array(found, _HITS),
                     batch.column(1).slice(lo, hi - lo)], names=["n_words", "hits", "row"])
    return run


class Matches(NamedTuple):
    """``rows`` (uid, at, m, list): document windows that equal a benchmark window
    word for word; ``lists`` (list, items): each different list of the items that
    share a window once, by its SHA-256, however many windows and hits have it."""
    rows: DataFrame
    lists: DataFrame


def filter_bits(windows: int) -> int:
    """Bits (as a power of two) for about a thousand a window, 2**16 to 2**30."""
    return min(30, max(16, (1024 * windows).bit_length()))


def mark(docs: DataFrame, benchmark: DataFrame, text: str = "text",
         columns: list[str] | None = None) -> tuple[DataFrame, Matches]:
    """Written tables (documents, matches): each document row as struct ``row``
    (of ``columns``) with ``uid``, ``n_words`` and candidate ``hits``; and the
    matches with the benchmark. A hit carries the name of an item list, not the list."""
    spark = docs.sparkSession
    bench = materialize(benchmark_windows(benchmark), "benchmark-windows")
    sizes = {r["m"]: r["count"] for r in bench.groupBy("m").count().collect()}   # m is 1 to SPAN
    share, bits = spark.sparkContext.broadcast, filter_bits(sum(sizes.values()))
    task = _document_batches(sorted(sizes), share(C.bit_filter(bench, "print", bits)),
                             share(C.bit_filter(bench, "hash", bits)))
    src = C.whole_rows(docs, text, columns)
    marked = src.mapInArrow(task, C.with_row("n_words long, hits array<struct<at: int, m: int, words: binary>>", src))
    marked = materialize(marked.withColumn("uid", F.monotonically_increasing_id()), "marked")
    hits = (marked.where(F.size("hits") > 0).select("uid", F.explode("hits").alias("h"))
            .select("uid", "h.at", "h.m", "h.words"))
    known = bench.groupBy("words", "m").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    known = materialize(known.withColumn("list", F.sha2(F.to_json("items"), 256)), "benchmark-known")
    lists = materialize(known.groupBy("list").agg(F.first("items").alias("items")), "benchmark-lists")
    matches = materialize(hits.join(known.select("words", "m", "list"), ["words", "m"]).select("uid", "at", "m", "list"), "matches")
    drop_tables(bench, known)
    return marked, Matches(matches, lists)


def report(marked: DataFrame, matches: Matches) -> DataFrame:
    """Per document: ``row``, n_words, n_hit, spans (word intervals) and items.
    Items are put together once for all documents that hit the same lists."""
    per = (matches.rows.groupBy("uid")
           .agg(F.array_sort(F.collect_set(F.struct("at", (F.col("at") + F.col("m")).alias("to")))).alias("spans"),
                F.array_sort(F.collect_set("list")).alias("_lists")))
    per = materialize(per.withColumn("_set", F.sha2(F.array_join("_lists", ""), 256)), "matched")
    sets = per.groupBy("_set").agg(F.first("_lists").alias("_lists")).select("_set", F.explode("_lists").alias("list"))
    sets = (sets.join(matches.lists, "list").groupBy("_set")
            .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("to")),
        lambda a, s: F.struct((a["n"] + F.greatest(F.lit(0), s["to"] - F.greatest(s["at"], a["to"]))).alias("n"),
                              F.greatest(a["to"], s["to"]).alias("to")), lambda a: a["n"])
    per = per.select("uid", "spans", covered.alias("n_hit"), "_set").join(sets, "_set").select("uid", "spans", "items", "n_hit")
    return (marked.drop("hits").join(per, "uid", "left")
            .withColumn("n_hit", F.coalesce("n_hit", F.lit(0).cast("long"))))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a benchmark window (all columns kept)."""
    marked, matches = mark(docs, benchmark)
    leaked = matches.rows.select("uid").distinct()
    clean = (marked.where(F.size("hits") == 0).select("row")
             .unionByName(marked.where(F.size("hits") > 0).join(leaked, "uid", "left_anti").select("row")))
    return clean.select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    """op9: hits of every benchmark item in every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    marked, matches = mark(docs, bench, columns=["doc_id"])
    ids = F.coalesce(F.array_sort(F.transform("items", lambda x: x.cast("string"))),
                     F.array().cast("array<string>"))
    return report(marked, matches).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit", F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS u, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT m FROM bw),
dw AS (SELECT u, i, m, array_to_string(w[i:i + m - 1], ' ') AS s
       FROM (SELECT u, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, lens WHERE len(w) >= m)),
hit AS (SELECT u, i, dw.m AS m, item_id FROM dw JOIN bw ON dw.s = bw.s AND dw.m = bw.m),
pos AS (SELECT u, count(DISTINCT p) AS n_hit FROM (SELECT u, unnest(range(i, i + m)) AS p FROM hit) GROUP BY u),
it AS (SELECT u, count(DISTINCT item_id) AS n_items,
              string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS l FROM hit GROUP BY u)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(l, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (u) LEFT JOIN it USING (u)
"""
