"""Token alignment between two tokenizers, each distinct text once.

Documents are shuffled by their full text: equal texts become one row with the
number of copies. Each distinct text is encoded by a byte-level BPE (A, with a
space before the text) and by a piece BPE (B, which adds that space itself),
and cut into groups at the byte offsets where tokens of both end. Every A token
of a group links to every B token of it. How many documents hold a pair linked
is the sum of the copies of the texts that hold it; the measures of a text go
back to its documents by the text's SHA-256.

Scale: a text leaves its task with its distinct pairs and how often each links,
never as single links. Pair counts are a partial aggregate. The counts come
back in two ways that share no pair: the most frequent pairs (at most
``FREQUENT``, a fixed bound, chosen by a histogram of counts) by a broadcast,
all others by a shuffled join, so the pairs that half the texts hold are never
shuffled and the rare ones never broadcast. The highest count of an A id is a
table of at most one row a vocabulary entry.

Defined results: null and empty texts, and texts whose tokens do not spell the
space and the text (a normalising piece model), have no tokens: zeros and an
empty digest. Repeated rows are documents of their own and count as such; rows
with a null id count and are returned; an empty table gives an empty result;
other columns are not read or travel in one struct. Groups of any size are
linked whole: a large one by its distinct ids. Ties at an A id's highest count
are all best.
"""

from __future__ import annotations

import hashlib
import itertools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from restock.llm.bpe import PATTERN
from restock.llm.common import whole_rows
from restock.session import drop_tables, materialize

CHUNK = 1 << 20            # bytes of text aligned at a time
LARGE_GROUP = 1 << 16      # links of a group from which its distinct ids are linked instead
FREQUENT = 1 << 16         # pairs whose counts are broadcast, at most (2 MB)
ROWS_OUT = 64              # texts of a result batch


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable
    bytes are themselves, the others take the code points from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def byte_bpe_ranks(text: str) -> dict[bytes, int]:
    """Ranks of a byte-level BPE file's vocabulary, without its added tokens.

    The encoder merges by rank, so the merges must be listed in the order of
    the ids they make; any other file is refused."""
    spec = json.loads(text)
    letters = byte_letters()
    added = {t["content"] for t in spec["added_tokens"]}
    vocab = spec["model"]["vocab"]
    made = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in spec["model"]["merges"]]
    if made != sorted(made) or spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel":
        raise ValueError("not a plain byte-level BPE whose merges are in the order of their ids")
    return {bytes(map(letters.__getitem__, t)): i for t, i in vocab.items() if t not in added}


def piece_bytes(piece: str, is_byte: bool) -> bytes:
    return bytes([int(piece[3:5], 16)]) if is_byte else piece.replace("▁", " ").encode()


class Pair:
    """Both tokenizers, built once in a worker from the contents of their files."""

    def __init__(self, byte_bpe: str, piece_model: bytes):
        import sentencepiece
        self.files = byte_bpe, piece_model
        ranks = byte_bpe_ranks(byte_bpe)
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        self.bytes_a = [b""] * (max(ranks.values()) + 1)
        for t, i in ranks.items():
            self.bytes_a[i] = t
        self.bytes_b = [piece_bytes(self.b.id_to_piece(i), self.b.is_byte(i)) for i in range(self.b.get_piece_size())]
        self.size_a, self.size_b = (np.array([len(t) for t in x], np.int64) for x in (self.bytes_a, self.bytes_b))
        n, m = len(self.bytes_a), len(self.bytes_b)
        # the digest's pieces: an id of A inside or at the end of its side, then of B
        self.written = ([f"{i}," for i in range(n)] + [f"{i}|" for i in range(n)]
                        + [f"{i}," for i in range(m)] + [f"{i};" for i in range(m)])

    def __reduce__(self):
        return Pair, self.files

    def encode(self, texts: list[bytes]) -> tuple[list[int], list, list]:
        """(numbers of the texts that both spell, their A ids, their B ids)."""
        plain = [t.decode("utf-8", "replace") for t in texts]
        sides_b = self.b.encode(plain, num_threads=1)
        kept, out_a, out_b = [], [], []
        for i, (t, s, b) in enumerate(zip(texts, plain, sides_b)):
            a = self.a.encode_ordinary(" " + s)
            t = b" " + t
            if b"".join(map(self.bytes_b.__getitem__, b)) == t and b"".join(map(self.bytes_a.__getitem__, a)) == t:
                kept.append(i)
                out_a.append(a)
                out_b.append(b)
        return kept, out_a, out_b


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    n = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(itertools.chain.from_iterable(ids), np.int64, int(n.sum())), n


def align(pair: Pair, texts: list[bytes]) -> Iterator[tuple]:
    """(number, n_a, n_b, n_groups, n_links, digest, pairs, times) of every text
    that both tokenizers spell; a pair is ``a * len(B) + b``, each once a text
    with the number of its links."""
    kept, ids_a, ids_b = pair.encode(texts)
    if not kept:
        return
    a, n_a = _flat(ids_a)
    b, n_b = _flat(ids_b)
    end_a, end_b = np.cumsum(pair.size_a[a]), np.cumsum(pair.size_b[b])
    at = np.searchsorted(end_b, end_a)
    closes = end_b[at] == end_a              # both end at the last byte, so ``at`` stays inside
    last_a, last_b = np.flatnonzero(closes), at[closes]
    g_a, g_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)     # tokens of a group
    links = g_a * g_b
    until_a, until_b = np.cumsum(n_a), np.cumsum(n_b)
    text_of = np.searchsorted(until_a, last_a, side="right")
    n_groups = np.bincount(text_of, minlength=len(kept))
    first_group = np.concatenate(([0], np.cumsum(n_groups)))
    n_links = np.add.reduceat(links, first_group[:-1])

    # tokens in the order of the digest: a group's A ids, then its B ids
    group_a, group_b = np.repeat(np.arange(len(g_a)), g_a), np.repeat(np.arange(len(g_b)), g_b)
    order = np.empty(len(a) + len(b), np.int64)
    ends = np.zeros(len(a), np.int64)
    ends[last_a] = 1
    order[np.arange(len(a)) + (last_b - g_b + 1)[group_a]] = a + len(pair.bytes_a) * ends
    ends = np.zeros(len(b), np.int64)
    ends[last_b] = 1
    order[np.arange(len(b)) + (last_a + 1)[group_b]] = b + 2 * len(pair.bytes_a) + len(pair.bytes_b) * ends

    # links of ordinary groups one by one, those of large groups by distinct ids
    big = links > LARGE_GROUP
    g = np.repeat(np.flatnonzero(~big), links[~big])
    k = np.arange(len(g)) - np.repeat(np.cumsum(links[~big]) - links[~big], links[~big])
    over = k // g_b[g]
    width = len(pair.bytes_b)
    codes = a[(last_a - g_a + 1)[g] + over] * width + b[(last_b - g_b + 1)[g] + k - over * g_b[g]]
    texts_of, codes, weights = [text_of[g]], [codes], [np.ones(len(g), np.int64)]
    for i in np.flatnonzero(big):
        x, n = np.unique(a[last_a[i] - g_a[i] + 1:last_a[i] + 1], return_counts=True)
        y, m = np.unique(b[last_b[i] - g_b[i] + 1:last_b[i] + 1], return_counts=True)
        codes.append((x[:, None] * width + y).ravel())
        weights.append((n[:, None] * m).ravel())
        texts_of.append(np.full(len(codes[-1]), text_of[i]))
    space = len(pair.bytes_a) * width
    key = np.concatenate(texts_of) * space + np.concatenate(codes)
    weights = np.concatenate(weights)
    rank = np.argsort(key)
    key = key[rank]
    new = np.flatnonzero(np.diff(key, prepend=-1))
    times = np.add.reduceat(weights[rank], new)
    key = key[new]
    cut = np.searchsorted(key, np.arange(len(kept) + 1) * space)
    key %= space

    begin = 0
    for i, number in enumerate(kept):
        end = int(until_a[i] + until_b[i])
        written = "".join(map(pair.written.__getitem__, order[begin:end].tolist()))[:-1]
        begin = end
        lo, hi = cut[i], cut[i + 1]
        yield (number, int(n_a[i]), int(n_b[i]), int(n_groups[i]), int(n_links[i]),
               hashlib.sha256(written.encode()).hexdigest(), key[lo:hi], times[lo:hi])


_ALIGNED = pa.schema([("key", pa.binary()), ("copies", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
                      ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()),
                      ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))])
ALIGNED = ("key binary, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "pairs array<long>, times array<long>")


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows))
    off = np.concatenate(([0], np.cumsum([len(x) for x in cols[7]]))).astype(np.int32)
    lists = [pa.ListArray.from_arrays(pa.array(off), pa.array(np.concatenate(x))) for x in cols[7:9]]
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(cols[:7], _ALIGNED)] + lists, schema=_ALIGNED)


def _align_batches(shared):
    """Task over (text, copies)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, out, held = shared.value, [], 0
        for batch in batches:
            texts = batch.column(0).cast(pa.large_binary())
            copies = batch.column(1)
            lo = 0
            while lo < len(texts):
                hi, size, part = lo, 0, []
                while hi < len(texts) and (not part or size < CHUNK):
                    part.append(texts[hi].as_py())
                    size += len(part[-1])
                    hi += 1
                for number, *measures in align(pair, part):
                    out.append((hashlib.sha256(part[number]).digest(), copies[lo + number].as_py(), *measures))
                    held += len(measures[-1])
                    if len(out) >= ROWS_OUT or held > CHUNK // 8:
                        yield _packed(out)
                        out, held = [], 0
                lo = hi
        if out:
            yield _packed(out)
    return run


def align_texts(docs: DataFrame, byte_bpe: str, piece_model: bytes, text: str = "text") -> DataFrame:
    """One row a distinct text that both tokenizers spell: its SHA-256 (``key``),
    copies, measures and distinct pairs. The arguments are the files' contents."""
    src = docs.select(F.col(f"`{text}`").cast("string").alias("text")).where(F.col("text") != "")
    distinct = src.groupBy("text").agg(F.count("*").alias("copies"))
    shared = docs.sparkSession.sparkContext.broadcast(Pair(byte_bpe, piece_model))
    return distinct.mapInArrow(_align_batches(shared), ALIGNED)


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """(pair, n_docs, best): documents that hold each pair linked, and whether
    no pair of its A id has more."""
    counts = aligned.select("copies", F.explode("pairs").alias("pair")).groupBy("pair").agg(F.sum("copies").alias("n_docs"))
    counts = materialize(counts.withColumn("a", F.expr(f"cast(pair div {width} as int)")), "alignment-counts")
    # one row a vocabulary entry at most: small at any size of the data
    top = counts.groupBy("a").agg(F.max("n_docs").alias("top"))
    out = counts.join(F.broadcast(top), "a").select("pair", "n_docs", (F.col("n_docs") == F.col("top")).alias("best"))
    out._written_at = counts._written_at
    return out


def frequent_from(counts: DataFrame, most: int = FREQUENT) -> int:
    """The least count from which on there are at most ``most`` pairs, by a
    histogram with eight steps a power of two."""
    step = F.floor(F.log2("n_docs") * 8)
    sizes = counts.groupBy(step.alias("s")).agg(F.count("*").alias("n"), F.min("n_docs").alias("least"))
    total, least = 0, None
    for r in sizes.orderBy(F.col("s").desc()).toLocalIterator():      # at most 8 * 63 rows
        total += r["n"]
        if total > most:
            return r["least"] + 1 if least is None else least
        least = r["least"]
    return 0


def measures(aligned: DataFrame, counts: DataFrame, most: int = FREQUENT) -> DataFrame:
    """(key, n_best, count_sum) of every distinct text."""
    least = frequent_from(counts, most)
    links = aligned.select("key", F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    links = links.select("key", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    best, total = F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)), F.sum(F.col("times") * F.col("n_docs"))
    often = F.broadcast(counts.where(F.col("n_docs") >= least))       # at most ``most`` rows
    both = links.join(often, "pair", "left")
    known = both.where("n_docs is not null").groupBy("key").agg(best.alias("n_best"), total.alias("count_sum"))
    rare = (both.where("n_docs is null").select("key", "pair", "times")
            .join(counts.where(F.col("n_docs") < least), "pair")
            .groupBy("key").agg(best.alias("n_best"), total.alias("count_sum")))
    return known.unionByName(rare).groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


MEASURES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def alignment(docs: DataFrame, byte_bpe: str, piece_model: bytes, text: str = "text",
              columns: list[str] | None = None, most: int = FREQUENT) -> DataFrame:
    """(measures, groups_sha256, row): what ``docs`` holds a document, with
    ``columns`` of it (all by default) as a struct."""
    aligned = materialize(align_texts(docs, byte_bpe, piece_model, text), "alignment-texts")
    width = len(Pair(byte_bpe, piece_model).bytes_b)
    counts = pair_counts(aligned, width)
    done = aligned.drop("pairs", "times", "copies").join(measures(aligned, counts, most), "key")
    done = materialize(done, "alignment-measures")
    drop_tables(aligned, counts)
    rows = whole_rows(docs, text, columns).select(F.unhex(F.sha2("text", 256)).alias("key"), "row")
    return (rows.join(done, "key", "left")
            .select(*[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in MEASURES],
                    F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"), "row"))


def query(spark, sf_dir: str) -> DataFrame:
    """op12: how the tokens of two public tokenizers align in every document."""
    import public_tokenizers
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        byte_bpe = f.read()
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        piece_model = f.read()
    done = alignment(spark.read.parquet(f"{sf_dir}/documents.parquet"), byte_bpe, piece_model, columns=["doc_id"])
    return done.select(F.col("row.doc_id").alias("doc_id"), *MEASURES, "groups_sha256")
