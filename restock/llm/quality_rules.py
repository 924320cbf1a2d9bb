"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Every text gets plain counts, two fixed base rules, and ``RULES``: ratios that
are high in poor texts. Cutoffs of the rules are not guessed but certified, per
stratum (language), on labelled rows: for every rule and every cutoff of its
grid, the number of good rows it would reject is tested against the exact
binomial tail. A cutoff is certified if, were its true rate of false
rejections above ``risk / number of rules``, so few rejections would have a
probability of at most ``delta / number of tests`` (Bonferroni over strata,
rules and cutoffs). Among a rule's certified cutoffs the one that rejects most
poor rows is used; a rule without one, or that rejects no poor row, is off in
that stratum. So with probability 1 - delta, in every stratum at once, at most
a share ``risk`` of the good texts that pass the base rules is rejected.

Labels are read from the rows whose crc32(id as text) modulo 5 is not 0; the
other fold is left to check the promise on.

Defined results: null and empty texts have no words and fail the base rules; a
null language is a stratum of its own; rows of strata without labels, and all
rows when nothing can be certified, are judged by the base rules alone; of
several labels of one id the lowest counts; repeated rows are judged alike;
empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from restock.session import drop_tables, materialize

# Fixed values of the base rules.
MIN_WORDS, WINDOW, REPEAT_PERCENT = 20, 8, 30
RISK, DELTA = 0.05, 0.05
# Each rule's ratio and the cutoffs that are tried (reject above).
RULES = {
    "symbols": ("n_symbols / word_chars", [0.01, 0.02, 0.03, 0.05, 0.08, 0.12, 0.2, 0.3]),
    "dup_lines": ("n_dup_lines / n_lines", [0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.8]),
    "repeats": ("n_repeat_words / n_words", [0.05, 0.08, 0.1, 0.12, 0.15, 0.2, 0.25, 0.28]),
    "capitals": ("n_capitals / word_chars", [0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.7]),
    "word_length": ("word_chars / n_words", [7, 8, 9, 10, 12, 14, 17, 20]),
}
_SPACE = r"[\\x20\\x09-\\x0D]"


def counts(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id", "lang")) -> DataFrame:
    """The kept columns with the counts of every whole text."""
    at = ", ".join(f"_h[i + {j}]" if j else "_h[i]" for j in range(WINDOW))
    return (docs.select(*keep, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_t"))
            .withColumn("_w", F.expr(f"filter(split(_t, '{_SPACE}+'), w -> w != '')"))
            .withColumn("_l", F.expr(rf"filter(split(_t, '\n'), l -> l rlike '[^\\x20\\x09-\\x0D]')"))
            .select(*keep, F.expr("size(_w)").cast("long").alias("n_words"),
                    F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
                    F.expr("length(_t) - length(regexp_replace(_t, '[#*$%&|<>]', ''))").cast("long").alias("n_symbols"),
                    F.expr("length(_t) - length(regexp_replace(_t, '[A-Z]+', ''))").cast("long").alias("n_capitals"),
                    F.expr("size(_l)").cast("long").alias("n_lines"),
                    F.expr("size(_l) - size(array_distinct(_l))").cast("long").alias("n_dup_lines"),
                    F.expr("transform(_w, w -> xxhash64(w))").alias("_h"))
            # hashes of all windows; only texts that repeat one sort them by place
            .withColumn("_v", F.expr(f"if(size(_h) < {WINDOW}, array(), "
                                     f"transform(sequence(0, size(_h) - {WINDOW}), i -> xxhash64({at})))"))
            .withColumn("_s", F.expr("if(size(array_distinct(_v)) = size(_v), array(), "
                                     "array_sort(transform(_v, (v, i) -> struct(v as v, i as i))))"))
            .withColumn("_p", F.expr("array_sort(transform(filter(_s, (x, i) -> "
                                     "(i > 0 and get(_s, i - 1).v = x.v) or (i + 1 < size(_s) and get(_s, i + 1).v = x.v)), x -> x.i))"))
            .withColumn("n_repeat_words", F.expr(
                "aggregate(_p, struct(0L as n, 0 as until), (a, p) -> struct("
                f"a.n + p + {WINDOW} - greatest(p, a.until) as n, p + {WINDOW} as until), a -> a.n)"))
            .drop("_h", "_v", "_s", "_p"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


# -------------------------------------------------------- binomial bound ----
def log_gamma(x: Column) -> Column:
    """ln Gamma(x) for x >= 1 (Stirling's series eight steps up)."""
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * F.pow(y, F.lit(5)))
    steps = F.lit(0.0)
    for i in range(8):
        steps = steps + F.log(x + i)
    return (y - 0.5) * F.log(y) - y + F.lit(0.9189385332046727) + series - steps


def binomial_tail(k: Column, n: Column, rate: float) -> Column:
    """P(X <= k) for X of n trials with ``rate``, where k < n * rate (else 1):
    the terms from k down, and a bound from above for those past the 400th."""
    k, n = k.cast("double"), n.cast("double")
    top = F.exp(log_gamma(n + 1) - log_gamma(k + 1) - log_gamma(n - k + 1)
                + k * F.log(F.lit(rate)) + (n - k) * F.log(F.lit(1 - rate)))
    odds = (1 - rate) / rate
    ratio = lambda i: i * odds / (n - i + 1)  # noqa: E731  term i - 1 over term i
    last = F.greatest(k - 400, F.lit(0.0))
    fold = F.aggregate(
        F.when(k > last, F.sequence(k.cast("long"), (last + 1).cast("long"), F.lit(-1).cast("long")))
         .otherwise(F.array().cast("array<bigint>")),
        F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")),
        lambda a, i: F.struct((a["term"] * ratio(i.cast("double"))).alias("term"),
                              (a["sum"] + a["term"] * ratio(i.cast("double"))).alias("sum")))
    rest = F.when(last > 0, fold["term"] * ratio(last) / (1 - ratio(last))).otherwise(0.0)
    return F.when(k < n * rate, F.least(F.lit(1.0), top * (fold["sum"] + rest))).otherwise(1.0)


# ------------------------------------------------------------ thresholds ----
def cutoffs(counted: DataFrame, labels: DataFrame, id_column: str = "doc_id", stratum: str = "lang",
            risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """Written table (stratum, one cutoff a rule or null) from labelled rows."""
    known = (labels.select(F.col(id_column).alias("_id"), F.col("quality").cast("int").alias("_q"))
             .where(F.col("_id").isNotNull() & F.col("_q").isin(0, 1)
                    & (F.crc32(F.col("_id").cast("string")) % 5 != 0))
             .groupBy("_id").agg(F.min("_q").alias("_q")))
    rows = counted.where(~base_failed()).join(known, F.col(id_column) == F.col("_id"))
    sums = [F.sum("_q").alias("n")]
    for name, (ratio, grid) in RULES.items():
        over = [F.expr(f"{ratio} > {c}") for c in grid]
        sums.append(F.array(*[F.struct(F.lit(float(c)).alias("cut"), F.count_if(o & (F.col("_q") == 1)).alias("good"),
                                       F.count_if(o & (F.col("_q") == 0)).alias("poor"))
                              for c, o in zip(grid, over)]).alias(name))
    table = materialize(rows.groupBy(F.col(stratum).alias("stratum")).agg(*sums), "rule-counts")
    tests = max(1, table.count() * sum(len(g) for _, g in RULES.values()))
    rate = risk / len(RULES)
    def tagged(name: str) -> Column:
        return F.transform(name, lambda c: F.struct(F.lit(name).alias("rule"), c["cut"].alias("cut"),
                                                    c["good"].alias("good"), c["poor"].alias("poor")))

    tried = (table.select("stratum", "n", F.explode(F.concat(*[tagged(name) for name in RULES])).alias("c"))
             .where("c.poor > 0"))
    certified = tried.where(binomial_tail(F.col("c.good"), F.col("n"), rate) <= delta / tests)
    best = [F.max(F.when(F.col("c.rule") == name, F.struct("c.poor", "c.cut")))["cut"].alias(f"cut_{name}") for name in RULES]
    cuts = materialize(certified.groupBy("stratum").agg(*best), "rule-cutoffs")
    drop_tables(table)
    return cuts


def judge(counted: DataFrame, cuts: DataFrame, stratum: str = "lang") -> DataFrame:
    """The counts with base_failed and kept."""
    passed = F.lit(True)
    for name, (ratio, _) in RULES.items():
        passed = passed & F.coalesce(F.expr(f"{ratio} <= cut_{name}"), F.lit(True))
    rows = counted.withColumn("base_failed", base_failed())
    return (rows.join(cuts.withColumnRenamed("stratum", "_s"), F.col(stratum).eqNullSafe(F.col("_s")), "left")
            .withColumn("kept", ~F.col("base_failed") & passed))


def filter_quality(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", stratum: str = "lang",
                   text: str = "text", risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """(id, stratum, counts, base_failed, kept, cutoffs) for every row."""
    counted = materialize(counts(docs, text, (id_column, stratum)), "rule-features")
    return judge(counted, cutoffs(counted, labels, id_column, stratum, risk, delta), stratum)


def query(spark, sf_dir: str) -> DataFrame:
    """op2: counts and verdict of every document."""
    return filter_quality(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                          spark.read.parquet(f"{sf_dir}/labels.parquet")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_GRID = ",\n".join(f"('{n}', {i}, {float(c)}::DOUBLE)" for n, (_, g) in RULES.items() for i, c in enumerate(g))
_RATIO = " ".join(f"WHEN '{n}' THEN {r}" for n, (r, _) in RULES.items())
SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS u, doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
        list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l FROM d),
g AS (SELECT u, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS s
      FROM (SELECT u, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM w WHERE len(w) >= {WINDOW})),
r AS (SELECT u, count(DISTINCT p) AS n FROM
        (SELECT u, unnest(range(i, i + {WINDOW})) AS p
         FROM (SELECT u, i, count(*) OVER (PARTITION BY u, s) AS k FROM g) WHERE k > 1) GROUP BY u),
c AS (SELECT u, doc_id, lang, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')))::BIGINT AS n_capitals,
        len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
        coalesce(r.n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN r USING (u)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed FROM c),
lab AS (SELECT doc_id, min(quality) AS q FROM labels WHERE quality IN (0, 1) GROUP BY doc_id),
tab AS (SELECT list(list_reduce([i] || range(8), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
                ORDER BY i) AS t FROM range(256) r(i)),
crc AS (SELECT doc_id AS id, xor(list_reduce([4294967295] || list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT),
                lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 5 AS fold FROM lab, tab),
grid(rule, i, cut) AS (VALUES {_GRID}),
known AS (SELECT b.*, q FROM b JOIN lab USING (doc_id) JOIN crc ON crc.id = doc_id WHERE NOT base_failed AND fold <> 0),
tot AS (SELECT lang, sum(q) AS n FROM known GROUP BY lang),
k AS (SELECT lang, rule, cut, count(*) FILTER (q = 1) AS good, count(*) FILTER (q = 0) AS poor
      FROM known, grid WHERE CASE rule {_RATIO} END > cut GROUP BY lang, rule, cut),
p AS (SELECT k.lang, rule, cut, poor, CASE WHEN good >= n * {RISK / len(RULES)} THEN 1 ELSE
        list_sum(list_transform(range(0, good + 1), lambda x: exp(lgamma(n + 1) - lgamma(x + 1) - lgamma(n - x + 1)
          + x * ln({RISK / len(RULES)}) + (n - x) * ln(1 - {RISK / len(RULES)})))) END AS tail
      FROM k JOIN tot ON k.lang IS NOT DISTINCT FROM tot.lang),
best AS (SELECT lang, rule, arg_max(cut, poor * 1000 + cut) AS cut FROM p
         WHERE poor > 0 AND tail <= {DELTA} / ((SELECT count(*) FROM tot) * {sum(len(g) for _, g in RULES.values())})
         GROUP BY lang, rule),
bad AS (SELECT DISTINCT u FROM b JOIN best ON b.lang IS NOT DISTINCT FROM best.lang
        WHERE NOT base_failed AND CASE rule {_RATIO} END > cut)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND bad.u IS NULL AS kept
FROM b LEFT JOIN bad USING (u)
"""
