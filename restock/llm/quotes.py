"""Chat formatting by quotation linking.

Messages are rows (conversation, turn, role, text). A text's lines are parsed
into quote levels (the number of leading ``>`` marks); runs of lines of one
level are quoted passages, the lines of level 0 are the message's own words. An
attribution line ("On ..., X wrote:") right before a quote is dropped with it.

Quoted passages, and their paragraphs and lines, are normalised (lower case,
white space collapsed) and hashed (128 bits). They are linked with the latest
earlier message of the conversation whose own text, paragraph or line has the
hash. A window carries the last seen original forward over (conversation,
hash), so no quote is paired with all messages that say the same. A message replies to the link of its shallowest level, among those the
one of most words, then the latest; without a link it replies to the message
before it.

Replies to the message before continue a thread; any other reply starts one.
Rows come with ``thread`` (the turn it starts with) and ``position``: ordered by
these, every message follows the one it replies to.

Messages are dealt out by ranges of (conversation, turn), so a range holds its
share of the rows however long a conversation is and however far apart its turns
are. The part of a conversation in one range is a block. Running values, those
over (conversation, hash) included, are computed within blocks and carried from
block to block by a table of one row a block.

Defined results: null texts are empty; rows that share conversation and turn
are one message, the first by role and text; a null conversation id is one
conversation, a null turn comes before all others; messages that only quote have
empty own words; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from restock.session import drop_tables, materialize

_MARKS = r"^(?:[ \\t]{0,3}>)+"


def parse(messages: DataFrame, parts: int) -> DataFrame:
    """(conv_id, turn, block, role, own, quotes): one row a message; quotes are
    (level, text) runs in order, blocks the numbers of ``parts`` ranges."""
    rows = (messages.select("conv_id", F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"),
                            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
            .groupBy("conv_id", "turn").agg(F.min(F.struct("role", "t")).alias("m"))
            .select("conv_id", "turn", "m.role", "m.t")
            .repartitionByRange(parts, "conv_id", "turn").withColumn("block", F.spark_partition_id()))
    lines = rows.withColumn("l", F.expr(
        rf"transform(split(t, '\r?\n'), x -> struct(length(regexp_replace(regexp_extract(x, '{_MARKS}', 0), '[^>]', '')) as level, "
        rf"regexp_replace(x, '{_MARKS} ?', '') as body))"))
    # a line's run: how many changes of level come before it
    marked = lines.withColumn("l", F.expr(
        "transform(l, (x, i) -> struct(if(x.level = 0 and x.body rlike '(?i)^on .{1,200} wrote:[ \\\\t]*$' "
        "and coalesce(get(l, i + 1).level, 0) > 0, -1, x.level) as level, x.body as body))"))
    starts = marked.withColumn("s", F.expr("filter(transform(l, (x, i) -> if(i = 0 or l[i - 1].level <> x.level, i, -1)), i -> i >= 0)"))
    return starts.select(
        "conv_id", "turn", "block", "role",
        F.expr(r"regexp_replace(array_join(transform(filter(l, x -> x.level = 0), x -> x.body), '\n'), '^\\s+|\\s+$', '')").alias("own"),
        F.expr(r"filter(transform(s, (a, j) -> struct(l[a].level as level, array_join(transform(slice(l, a + 1, "
               r"coalesce(get(s, j + 1), size(l)) - a), x -> x.body), '\n') as text)), q -> q.level > 0 and q.text rlike '\\S')").alias("quotes"))


def _units(text: str) -> str:
    """SQL for the normalised whole, paragraphs and lines of a text (distinct, non-empty)."""
    norm = r"lower(trim(regexp_replace(u, '\\s+', ' ')))"
    return (rf"array_distinct(filter(transform(concat(array({text}), split({text}, '\n[ \t\r]*(?:\n[ \t\r]*)+'), "
            rf"split({text}, '\n')), u -> {norm}), u -> u <> ''))")


_KEY = "struct(xxhash64(u) as h, xxhash64('2', u) as g, size(split(u, ' ')) as words)"


def _carried(rows: DataFrame, keys: list[str], at_end: str, name: str, over: str = "max(e)") -> DataFrame:
    """Join to every row, as ``name``, what the blocks before its own say of its
    ``keys``: ``at_end`` by block, then ``over`` all earlier ones, one row a block."""
    ends = rows.groupBy(*keys, "block").agg(F.expr(at_end).alias("e"))
    before = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ends = (ends.select(*[F.col(k).alias(f"_{k}") for k in [*keys, "block"]], F.expr(over).over(before).alias(name))
            .where(F.col(name).isNotNull()))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in [*keys, "block"]]
    return rows.join(ends, reduce(lambda x, y: x & y, same), "left").drop(*[f"_{k}" for k in [*keys, "block"]])


def link(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, turn, level, words, source): the latest earlier message that a
    quoted unit comes from; and the written table that this reads."""
    own = (parsed.select("conv_id", "turn", "block", F.explode(F.expr(f"transform({_units('own')}, u -> {_KEY})")).alias("k"))
           .select("conv_id", "turn", "block", "k.h", "k.g", "k.words", F.lit(0).alias("level")))
    quoted = (parsed.select("conv_id", "turn", "block", F.explode("quotes").alias("q"))
              .select("conv_id", "turn", "block", "q.level", F.explode(F.expr(f"transform({_units('q.text')}, u -> {_KEY})")).alias("k"))
              .select("conv_id", "turn", "block", "k.h", "k.g", "k.words", "level"))
    units = materialize(own.unionByName(quoted), "quote-units")
    # quotes stand before the own words of their turn, so a message is not its own source
    seen = Window.partitionBy("conv_id", "h", "g", "block").orderBy("turn", F.desc("level")).rowsBetween(Window.unboundedPreceding, 0)
    here = units.withColumn("here", F.last(F.when(F.col("level") == 0, F.struct("turn")), ignorenulls=True).over(seen))
    linked = (_carried(here, ["conv_id", "h", "g"], "max(case when level = 0 then struct(turn) end)", "earlier")
              .withColumn("source", F.coalesce("here", "earlier"))
              .where("level > 0 and source is not null")
              .select("conv_id", "turn", "level", "words", "source"))
    return linked, units


def arrange(messages: DataFrame, parts: int | None = None) -> DataFrame:
    """(conv_id, turn, role, own, n_quotes, n_linked, parent, thread, position,
    formatted) of every message, worked on in ``parts`` ranges (as many as shuffle
    partitions by default)."""
    parts = parts or int(messages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parsed = materialize(parse(messages, parts), "messages")
    linked, units = link(parsed)
    best = (linked.groupBy("conv_id", "turn")
            .agg(F.max_by("source", F.struct(-F.col("level"), "words", "source")).alias("source"),
                 F.countDistinct("level", "source").alias("n_linked"))
            .withColumnRenamed("conv_id", "_c").withColumnRenamed("turn", "_t"))
    rows = (parsed.join(best, F.col("conv_id").eqNullSafe(F.col("_c")) & F.col("turn").eqNullSafe(F.col("_t")), "left")
            .drop("_c", "_t").withColumn("me", F.struct("turn")))
    rows = materialize(rows, "linked-messages")     # every step below reads it twice
    drop_tables(parsed, units)
    line = Window.partitionBy("conv_id", "block").orderBy("turn")
    upto = line.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("prev", F.lag("me").over(line)).withColumn("nth", F.row_number().over(line))
    rows = _carried(rows, ["conv_id"], "max(me)", "prev_end")
    rows = _carried(rows, ["conv_id"], "count(1)", "nth_before", "sum(e)")
    rows = (rows.withColumn("prev", F.coalesce("prev", "prev_end"))
            .withColumn("nth", F.col("nth") + F.coalesce("nth_before", F.lit(0)))
            .withColumn("parent", F.coalesce("source", "prev"))
            .withColumn("start", F.when(F.col("prev").isNull() | ~F.col("parent").eqNullSafe(F.col("prev")), F.struct("nth", "turn"))))
    rows = rows.withColumn("start_here", F.last("start", ignorenulls=True).over(upto))
    rows = _carried(rows, ["conv_id"], "max(start)", "start_before").withColumn("start", F.coalesce("start_here", "start_before"))
    return rows.select(
        "conv_id", "turn", "role", "own", F.size("quotes").cast("long").alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), F.col("parent.turn").alias("parent"),
        F.col("start.turn").alias("thread"), (F.col("nth") - F.col("start.nth") + 1).cast("long").alias("position"),
        F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), F.col("own"), F.lit("\n")).alias("formatted"))


def query(spark, sf_dir: str) -> DataFrame:
    """op7: every message in reply order, with a digest of its formatted words."""
    rows = arrange(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return rows.select("conv_id", "turn", "role", "n_quotes", "n_linked", "parent", "thread", "position",
                       F.sha2("formatted", 256).alias("formatted_sha256"))


SQL = r"""
WITH m AS (SELECT conv_id, turn, min(struct_pack(role := role, t := coalesce(text, ''))) AS m FROM conversations GROUP BY ALL),
r AS (SELECT conv_id, turn, m.role AS role, m.t AS t FROM m),
l0 AS (SELECT conv_id, turn, unnest(regexp_split_to_array(t, '\r?\n')) AS x,
              generate_subscripts(regexp_split_to_array(t, '\r?\n'), 1) AS i FROM r),
l1 AS (SELECT *, length(regexp_replace(regexp_extract(x, '^(?:[ \t]{0,3}>)+'), '[^>]', '', 'g')) AS level,
              regexp_replace(x, '^(?:[ \t]{0,3}>)+ ?', '') AS body FROM l0),
l2 AS (SELECT *, CASE WHEN level = 0 AND regexp_matches(body, '(?i)^on .{1,200} wrote:[ \t]*$')
                       AND coalesce(lead(level) OVER w, 0) > 0 THEN -1 ELSE level END AS lv
       FROM l1 WINDOW w AS (PARTITION BY conv_id, turn ORDER BY i)),
l3 AS (SELECT *, CASE WHEN lag(lv) OVER w IS DISTINCT FROM lv THEN 1 ELSE 0 END AS new
       FROM l2 WINDOW w AS (PARTITION BY conv_id, turn ORDER BY i)),
l4 AS (SELECT *, sum(new) OVER (PARTITION BY conv_id, turn ORDER BY i) AS run FROM l3),
own AS (SELECT conv_id, turn, regexp_replace(string_agg(body, chr(10) ORDER BY i) FILTER (lv = 0), '^\s+|\s+$', '', 'g') AS own
        FROM l4 GROUP BY conv_id, turn),
q AS (SELECT conv_id, turn, run, any_value(lv) AS level, string_agg(body, chr(10) ORDER BY i) AS text FROM l4 WHERE lv > 0
      GROUP BY conv_id, turn, run HAVING regexp_matches(string_agg(body, chr(10) ORDER BY i), '\S')),
u0 AS (SELECT conv_id, turn, level, text FROM q UNION ALL SELECT conv_id, turn, 0, coalesce(own, '') FROM own),
u AS (SELECT DISTINCT conv_id, turn, level, lower(trim(regexp_replace(x, '\s+', ' ', 'g'))) AS s
      FROM (SELECT conv_id, turn, level, unnest([text] || regexp_split_to_array(text, '\n[ \t\r]*(?:\n[ \t\r]*)+')
                                               || string_split(text, chr(10))) AS x FROM u0)),
k AS (SELECT a.conv_id, a.turn, a.level, a.s, max(b.turn) AS source FROM u a
      JOIN u b ON a.conv_id = b.conv_id AND a.s = b.s AND a.level > 0 AND b.level = 0 AND b.turn < a.turn
      WHERE a.s <> '' GROUP BY ALL),
best AS (SELECT conv_id, turn, arg_max(source, struct_pack(l := -level, w := len(string_split(s, ' ')), s := source)) AS source,
                count(DISTINCT struct_pack(l := level, s := source)) AS n_linked FROM k GROUP BY conv_id, turn),
p AS (SELECT r.*, own, n_linked, lag(turn) OVER w AS prev, row_number() OVER w AS nth, best.source FROM r
      LEFT JOIN own USING (conv_id, turn) LEFT JOIN best USING (conv_id, turn) WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
s AS (SELECT *, coalesce(source, prev) AS parent,
        CASE WHEN prev IS NULL OR coalesce(source, prev) <> prev THEN nth END AS start FROM p),
f AS (SELECT *, max(start) OVER (PARTITION BY conv_id ORDER BY turn) AS st FROM s)
SELECT f.conv_id, f.turn, f.role, (SELECT count(*) FROM q WHERE q.conv_id = f.conv_id AND q.turn = f.turn)::BIGINT AS n_quotes,
       coalesce(f.n_linked, 0)::BIGINT AS n_linked, f.parent, b.turn AS thread, (f.nth - f.st + 1)::BIGINT AS position,
       sha256('<|' || coalesce(f.role, '') || '|>' || chr(10) || coalesce(f.own, '') || chr(10)) AS formatted_sha256
FROM f JOIN f b ON b.conv_id = f.conv_id AND b.nth = f.st
"""
