"""Line deduplication by winnowing over line hashes, in DataFrame functions only.

The lines of a text that hold a word form a sequence. A window is ``run`` (3)
consecutive lines of it, or fewer that have ``words`` (50) words or more together.
The line with the least hash in a window (the rightmost of equals) is its
fingerprint, so equal windows share a fingerprint. Fingerprints seen at one
place only are dropped; the others are extended both ways, to the windows around
them that they stand for, and those windows are joined on the hashes of all
their lines (128 bits) with the first place where they occur: the smallest
document id, then the earliest line. Every later window is deleted, so
overlapping windows delete whole repeated runs. Repeated runs that are shorter
in lines and in words stay.

Equal texts are put together first: the row with the smallest id owns the
text, its copies are later repeats of all their lines, however few.
Nothing is ever paired with all its copies: hashes are grouped with partial
aggregation, and later places meet only the first one.

Defined results: null and empty texts have no lines and stay as they are;
lines without a word are never deleted, but a text that loses all its other
lines becomes empty; rows that repeat id and text are one document and are
treated alike; of rows with one id and different texts the one with the
smaller hash comes first; ids are ordered as their type is (numbers, strings),
rows without an id come last; empty tables give empty results; other columns
pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from restock.session import drop_tables, materialize

RUN = 3
WORDS = 50
_WORD = r"[^\\x20\\x09-\\x0D]"


def _hashes(text: str) -> list:
    return [F.xxhash64(text).alias("_k"), F.xxhash64(F.lit("2"), F.col(text)).alias("_k2")]


def _order(id_column: str):
    return F.struct(F.col(id_column).isNull().alias("none"), F.col(id_column).alias("id")).alias("_ord")


def _windows_of(lines: int, run: int, words: int) -> str:
    """SQL for the windows of ``lines`` lines by their first line s: place of the
    fingerprint p (-1: too few words) and the hashes of all lines."""
    at = [f"_h[s + {j}]" for j in range(lines)]
    least = f"least({', '.join(at)})" if lines > 1 else at[0]
    place = "case " + " ".join(f"when _h[s + {j}] = {least} then s + {j}" for j in reversed(range(lines))) + " end"
    if lines < run:
        place = f"case when {' + '.join(f'_n[s + {j}]' for j in range(lines))} < {words} then -1 else {place} end"
    both = ", ".join(at), ", ".join(f"_g[s + {j}]" for j in range(lines))
    return (f"if(size(_h) < {lines}, array(), transform(sequence(0, size(_h) - {lines}), s -> "
            f"struct({place} as p, s as s, {lines} as k, xxhash64({both[0]}) as w, xxhash64({both[1]}) as w2)))")


def windows(docs: DataFrame, id_column: str, text: str, run: int, words: int) -> DataFrame:
    """Written table (print, _k, _k2, _ord, copies, windows): each selected
    fingerprint of each distinct text with the windows (s, k, w, w2) it stands for;
    texts with copies have a row even without a window (print null)."""
    lines = (docs.select(_order(id_column), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_t"))
             .select("_ord", *_hashes("_t"), F.expr(rf"filter(split(_t, '\n'), l -> l rlike '{_WORD}')").alias("_l"))
             .select("_ord", "_k", "_k2", F.expr("transform(_l, l -> xxhash64(l))").alias("_h"),
                     F.expr("transform(_l, l -> xxhash64('2', l))").alias("_g"),
                     F.expr(f"transform(_l, l -> regexp_count(l, '{_WORD}+'))").alias("_n")))
    texts = (lines.groupBy("_k", "_k2")
             .agg(F.min("_ord").alias("_ord"), F.count("*").alias("copies"),
                  F.first("_h").alias("_h"), F.first("_g").alias("_g"), F.first("_n").alias("_n")))
    sizes = range(1, run + 1)
    for k in sizes:
        texts = texts.withColumn(f"_v{k}", F.expr(_windows_of(k, run, words)))
    # the windows that have their fingerprint at p start at most k - 1 lines before it
    near = ", ".join(f"filter(slice(_v{k}, greatest(p - {k - 1}, 0) + 1, {k}), x -> x.p = p)" for k in sizes)
    every = ", ".join(f"transform(_v{k}, x -> x.p)" for k in sizes)
    found = (texts
             .withColumn("_p", F.expr(f"array_distinct(filter(concat({every}), p -> p >= 0))"))
             .select("_k", "_k2", "_ord", "copies", F.expr(
                 f"transform(_p, p -> struct(_h[p] as print, transform(concat({near}), "
                 "x -> struct(x.s as s, x.k as k, x.w as w, x.w2 as w2)) as windows))").alias("_f"))
             .select("_k", "_k2", "_ord", "copies", F.explode_outer("_f").alias("_f"))
             .select("_k", "_k2", "_ord", "copies", "_f.print", "_f.windows")
             .where("print is not null or copies > 1"))
    return materialize(found, "line-prints")


def repeats(prints: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(_k, _k2, _own, gone): numbers of the repeated lines of each distinct text
    and the order of the row that owns it; and the written table that it reads."""
    often = (prints.where("print is not null").groupBy("print").agg(F.count("*").alias("m"))
             .where("m > 1").select("print"))
    shared = (prints.join(often, "print").select("_k", "_k2", "_ord", F.explode("windows").alias("x"))
              .select("_k", "_k2", "_ord", "x.s", "x.k", "x.w", "x.w2"))
    shared = materialize(shared, "line-windows")
    first = (shared.groupBy("w", "w2").agg(F.min(F.struct("_ord", "_k", "_k2", "s")).alias("first"), F.count("*").alias("m"))
             .where("m > 1").select("w", "w2", "first"))
    later = shared.join(first, ["w", "w2"]).where(F.struct("_ord", "_k", "_k2", "s") != F.col("first"))
    gone = (later.groupBy("_k", "_k2").agg(F.first("_ord").alias("_own"), F.collect_set(F.struct("s", "k")).alias("_s"))
            .select("_k", "_k2", "_own", F.expr(
                "array_sort(array_distinct(flatten(transform(_s, x -> sequence(x.s, x.s + x.k - 1)))))").alias("gone")))
    return gone, shared


def mark(docs: DataFrame, id_column: str = "doc_id", text: str = "text", run: int = RUN, words: int = WORDS) -> DataFrame:
    """(row, n_lines, n_removed, n_runs, kept): every row as a struct and what is left of its text."""
    if run < 1:
        raise ValueError("run must be 1 or more")
    prints = windows(docs, id_column, text, run, words)
    gone, shared = repeats(prints)
    copied = prints.where("copies > 1").groupBy("_k", "_k2").agg(F.first("_ord").alias("_first"))
    touched = materialize(
        gone.join(copied, ["_k", "_k2"], "full")
        .select("_k", "_k2", F.coalesce("_own", "_first").alias("_own"), F.coalesce("gone", F.expr("array()")).alias("_gone")),
        "line-repeats")
    drop_tables(prints, shared)
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    # a sort-merge join whatever the size of the repeats, so that small and large inputs run the same plan
    rows = (docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), _order(id_column), t.alias("_t"))
            .select("row", "_ord", *_hashes("_t"), "_t")
            .drop("_t").join(touched.hint("merge"), ["_k", "_k2"], "left"))
    lines = rows.withColumn("_l", F.expr(rf"split(coalesce(cast(row.`{text}` as string), ''), '\n')"))
    worded = lines.withColumn("_i", F.expr(
        f"filter(transform(_l, (l, i) -> if(l rlike '{_WORD}', i, -1)), i -> i >= 0)"))
    numbers = worded.withColumn("_d", F.expr(
        "case when _own is null or size(_i) = 0 then array() when _own <> _ord then sequence(0, size(_i) - 1) else _gone end"))
    kept = F.expr(
        "case when size(_d) = 0 then cast(row.`{0}` as string) when size(_d) = size(_i) then '' else array_join("
        "transform(array_except(sequence(0, size(_l) - 1), transform(_d, d -> _i[d])), i -> _l[i]), '\n') end".format(text))
    return numbers.select("row", F.size("_i").cast("long").alias("n_lines"), F.size("_d").cast("long").alias("n_removed"),
                          F.expr("size(filter(_d, (d, i) -> i = 0 or _d[i - 1] <> d - 1))").cast("long").alias("n_runs"),
                          kept.alias("kept"))


def deduplicate(docs: DataFrame, id_column: str = "doc_id", text: str = "text", run: int = RUN,
                words: int = WORDS) -> DataFrame:
    """The rows with repeated lines deleted from the text, all columns kept
    (``n_chars`` is counted anew where it is a column)."""
    done = mark(docs, id_column, text, run, words)
    out = []
    for c in docs.columns:
        col = F.col("kept") if c == text else F.col("row").getField(c)
        if c == "n_chars":
            col = F.when(F.col("n_removed") > 0, F.length("kept").cast(docs.schema[c].dataType)).otherwise(col)
        out.append(col.alias(c))
    return done.select(*out)


def query(spark, sf_dir: str) -> DataFrame:
    """op4: lines deleted from every document, and a digest of what is left."""
    done = mark(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return done.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_removed", "n_runs",
                       F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))


SQL = rf"""
WITH l AS (SELECT doc_id, g, line, row_number() OVER (PARTITION BY doc_id ORDER BY g) AS p, 1 AS one
           FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS g FROM documents)
           WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
w AS (SELECT doc_id, p, k, list_aggregate(list_slice(ls, 1, k), 'string_agg', chr(10)) AS s FROM
        (SELECT doc_id, p, list(line) OVER z AS ls, list(len(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))) OVER z AS ns
         FROM l WINDOW z AS (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND {RUN - 1} FOLLOWING)),
        range(1, {RUN + 1}) t(k) WHERE k <= len(ls) AND (k = {RUN} OR list_sum(list_slice(ns, 1, k)) >= {WORDS})),
r AS (SELECT doc_id, p, k FROM (SELECT doc_id, p, k, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS nth FROM w)
      WHERE nth > 1),
copies AS (SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id) AS nth
           FROM documents) WHERE nth > 1),
gone AS (SELECT doc_id, unnest(range(p, p + k)) AS p FROM r UNION SELECT doc_id, p FROM l SEMI JOIN copies USING (doc_id)),
runs AS (SELECT doc_id, count(*) AS n_removed, count(*) FILTER (prev IS NULL OR prev <> p - 1) AS n_runs
         FROM (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS prev FROM gone) GROUP BY doc_id),
tot AS (SELECT doc_id, count(*) AS n_lines FROM l GROUP BY doc_id),
alll AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS g FROM documents),
kept AS (SELECT a.doc_id, string_agg(a.line, chr(10) ORDER BY a.g) AS t FROM alll a
         LEFT JOIN l ON l.doc_id = a.doc_id AND l.g = a.g LEFT JOIN gone ON gone.doc_id = l.doc_id AND gone.p = l.p
         WHERE gone.p IS NULL GROUP BY a.doc_id)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_runs, 0)::BIGINT AS n_runs,
       sha256(CASE WHEN n_removed = n_lines THEN '' ELSE coalesce(t, '') END) AS kept_sha256
FROM documents d LEFT JOIN tot USING (doc_id) LEFT JOIN runs USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
