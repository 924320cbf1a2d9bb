"""Language-model scores: masked pseudo-likelihood of a bidirectional network.

Tokens are the words of a text: the ``WORDS`` most frequent of the corpus
(exact counts over all texts) have ids of their own, the others share
``OTHERS`` ids by a checksum. A small network sees the two tokens on either
side of a masked one (embeddings, one hidden layer) and gives the probability
of every token in two softmax steps: the token's class of 64 ids, then the id
in its class. A word that shares its id has that probability times its share of
all occurrences of the id, by the exact counts of all words, so the
probabilities of all words of the corpus sum to 1 and none are confused as
targets (as neighbours, words of one id are alike). A text's score is the sum of
the log-probabilities of all its tokens, each given its neighbours on both sides.

The counts are a table that grows with the corpus. The shares of a fixed number
of frequent words (``WORDS`` of each of ``SHARES`` parts) travel to the tasks,
the other words are joined with the table.

Training is data-parallel: in each round every task starts from the same
weights, masks positions of every text it holds, and runs numpy SGD over them;
the weights are then averaged by number of tokens in a grouped aggregate. A hash
of a token and its place in the text deals all positions into ``MASK`` parts and
each round takes its share of the parts, so that the rounds together (up to
``MASK`` of them) have every token of every text as a target once. What reaches
the driver is one model, whatever the size of the corpus.

Defined results: null, empty and word-free texts have no tokens, log-likelihood
0 and mean 0; repeated rows get equal scores; an empty table gives an empty
result (and an untrained model); other columns pass through or are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from restock.llm.common import whole_rows, with_row
from restock.session import drop_tables, materialize

CLASS, CLASSES = 64, 32
SIZE = CLASS * CLASSES                 # ids
OTHERS = 62                            # ids shared by the words beyond the vocabulary
EDGE = SIZE - 1                        # stands for what is before and after a text
WORDS = SIZE - OTHERS - 1
SIDE, DIM, HIDDEN = 2, 16, 24
MASK, ROUNDS, BATCH, RATE = 8, 2, 1024, 0.1
CACHE = 1 << 18
LIMIT = 40                             # logits up to which exponentials need no shift
CUT = 1 << 24                          # bytes of text whose words are held at once
SHARES = 32                            # parts of the words, when the most frequent are sought


class Ids(dict):
    """Word to id; remembers a bounded number of words beyond the vocabulary."""

    def __init__(self, words: list[bytes]):
        super().__init__((w, i) for i, w in enumerate(words))
        self.most = len(self) + CACHE

    def __missing__(self, word: bytes) -> int:
        i = WORDS + zlib.crc32(word) % OTHERS
        if len(self) < self.most:
            self[word] = i
        return i

    def of(self, text: bytes) -> np.ndarray:
        return self.of_words(text.split())

    def of_words(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))


def initial(seed: int = 11) -> dict[str, np.ndarray]:
    r, f = np.random.default_rng(seed), np.float32
    return {"embed": (r.normal(size=(SIZE, DIM)) * 0.3).astype(f),
            "hidden": (r.normal(size=(2 * SIDE * DIM, HIDDEN)) / np.sqrt(2 * SIDE * DIM)).astype(f),
            "hidden_bias": np.zeros(HIDDEN, f),
            "class": np.zeros((HIDDEN, CLASSES), f), "class_bias": np.zeros(CLASSES, f),
            "word": np.zeros((CLASSES, HIDDEN, CLASS), f), "word_bias": np.zeros((CLASSES, CLASS), f)}


def _contexts(ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Ids of the neighbours of places ``at`` (ids already carry SIDE edges between texts)."""
    steps = [d for d in range(-SIDE, SIDE + 1) if d]
    return np.stack([ids[at + d] for d in steps], axis=1)


def _in_range(x: np.ndarray) -> np.ndarray:
    """``x``, in place, less the largest of its row where exponentials would leave the range of float32."""
    if len(x) and not (x.max() < LIMIT and x.min() > -LIMIT):
        x -= x.max(axis=1, keepdims=True)
    return x


def _exp(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(exponentials of ``x``, in place, their sum in each row)."""
    np.exp(x, out=x)
    return x, x @ np.ones(x.shape[1], x.dtype)


def _flat_at(x: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    return np.arange(0, x.size, x.shape[1]) + chosen


def _softmax_less_chosen(x: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """(softmax of each row - 1 at its chosen column) / number of rows, in place."""
    x, total = _exp(_in_range(x))
    total *= len(x)
    x *= np.reciprocal(total, out=total)[:, None]
    x.reshape(-1)[_flat_at(x, chosen)] -= 1 / len(x)
    return x


def _log_chosen(x: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """ln of the softmax of each row at its chosen column; ``x`` is used up."""
    own = _in_range(x).take(_flat_at(x, chosen))
    return own - np.log(_exp(x)[1])


def _hidden(p: dict, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = p["embed"].take(context, axis=0).reshape(len(context), -1)
    z = x @ p["hidden"]
    z += p["hidden_bias"]
    return x, np.tanh(z, out=z)


def _by_class(target: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """(order of the targets by class, for each class that occurs its first and past-the-last place in it)."""
    group = (target // CLASS).astype(np.uint8)                       # CLASSES fits a byte
    cut = np.cumsum(np.bincount(group, minlength=CLASSES)).tolist()
    return np.argsort(group, kind="stable"), [(c, a, b) for c, (a, b) in enumerate(zip([0, *cut], cut)) if a < b]


def _logits(p: dict, h: np.ndarray, group: np.ndarray, classes: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Logits of the classes, and of the ids within their class, of rows in the order of classes:
    one table each, as the steps after it cost by the call where classes have few rows."""
    first, second = h @ p["class"], np.empty((len(h), CLASS), h.dtype)
    first += p["class_bias"]
    for c, a, b in classes:
        np.dot(h[a:b], p["word"][c], out=second[a:b])
    second += p["word_bias"].take(group, axis=0)
    return first, second


def log_probabilities(p: dict, context: np.ndarray, target: np.ndarray) -> np.ndarray:
    """ln P(target | context) for many places."""
    order, classes = _by_class(target)
    target = target.take(order)
    group = target // CLASS
    _, h = _hidden(p, context.take(order, axis=0))
    first, second = _logits(p, h, group, classes)
    out = np.empty(len(target), h.dtype)
    out[order] = _log_chosen(first, group) + _log_chosen(second, target % CLASS)
    return out


def _descend(v: np.ndarray, total: np.ndarray, g: np.ndarray) -> None:
    """AdaGrad on the values ``v`` with their sums of squares; ``g`` is used up."""
    rate = g * g
    total += rate
    np.sqrt(total, out=rate)
    rate += 1e-6
    g *= RATE
    g /= rate
    v -= g


def step(p: dict, sums: dict, context: np.ndarray, target: np.ndarray) -> None:
    """One step of AdaGrad on the mean negative log-probability; rows are put in the order of
    classes first, and only the embeddings of ids that occur are touched (others have no slope)."""
    order, classes = _by_class(target)
    context, target = context.take(order, axis=0), target.take(order)
    group = target // CLASS
    x, h = _hidden(p, context)
    first, second = _logits(p, h, group, classes)
    d, w = _softmax_less_chosen(first, group), _softmax_less_chosen(second, target % CLASS)
    one = np.ones(len(h), h.dtype)
    g = {"class": h.T @ d, "class_bias": one @ d, "word": np.empty_like(p["word"]), "word_bias": np.empty_like(p["word_bias"])}
    if len(classes) < CLASSES:
        g["word"][:], g["word_bias"][:] = 0, 0
    back = np.empty_like(h)
    for c, a, b in classes:
        own, part = h[a:b], w[a:b]
        np.dot(own.T, part, out=g["word"][c])
        np.dot(one[a:b], part, out=g["word_bias"][c])
        np.dot(part, p["word"][c].T, out=back[a:b])
    back += d @ p["class"].T
    h *= h
    dz = np.subtract(1, h, out=h)
    dz *= back
    g["hidden"], g["hidden_bias"] = x.T @ dz, one @ dz
    dx = (p["hidden"] @ dz.T).reshape(2 * SIDE, DIM, -1).transpose(1, 0, 2).astype(np.float64).reshape(DIM, -1)
    flat = context.T.ravel()
    seen = np.flatnonzero(np.bincount(flat, minlength=SIZE))
    place = np.empty(SIZE, np.intp)
    place[seen] = np.arange(len(seen))
    place = place.take(flat)
    embed = np.empty((len(seen), DIM), h.dtype)
    for i in range(DIM):
        embed[:, i] = np.bincount(place, dx[i], len(seen))
    v, total = p["embed"].take(seen, axis=0), sums["embed"].take(seen, axis=0)
    _descend(v, total, embed)
    p["embed"][seen], sums["embed"][seen] = v, total
    for k, own in g.items():
        _descend(p[k], sums[k], own)


def _flat(p: dict) -> np.ndarray:
    return np.concatenate([v.ravel() for v in p.values()])


def _shaped(values: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, v in initial().items():
        out[k] = values[at:at + v.size].reshape(v.shape).astype(np.float32)
        at += v.size
    return out


def _joined(texts, ids: Ids | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids with SIDE edges before and after every text, places of its tokens, tokens of each text);
    without ``ids`` the texts are written ids."""
    of = ids.of if ids is not None else lambda t: np.frombuffer(t, np.uint16).astype(np.int32)
    edge = np.full(SIDE, EDGE, np.int32)
    parts, sizes = [edge], []
    for t in texts:
        own = of(t.as_buffer().to_pybytes()) if t.is_valid else edge[:0]
        parts += [own, edge]
        sizes.append(len(own))
    sizes = np.array(sizes, np.int64)
    start = SIDE + np.cumsum(sizes + SIDE) - (sizes + SIDE)
    at = np.arange(sizes.sum()) + np.repeat(start - (np.cumsum(sizes) - sizes), sizes)
    return np.concatenate(parts), at, sizes


def masked(stream: np.ndarray, at: np.ndarray, sizes: np.ndarray, turn: int, rounds: int) -> np.ndarray:
    """Those of the places ``at`` that are masked in a round: by the token and its place
    in its text alone, so however the texts are dealt into batches."""
    place = np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    part = (place * 2654435761 + stream[at].astype(np.int64) * 40503 >> 7) % MASK
    share = max(1, min(rounds, MASK))
    return at[part % share == turn % share]


def _train_batches(weights, turn: int, rounds: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, trained = _shaped(weights.value), 0
        sums = {k: np.full_like(v, 1e-3) for k, v in p.items()}
        wait: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0
        for batch in batches:
            stream, at, sizes = _joined(batch.column(0).cast(pa.large_binary()), None)
            at = masked(stream, at, sizes, turn, rounds)
            wait.append((_contexts(stream, at), stream[at]))
            held += len(at)
            if held >= BATCH:
                context, target = (np.concatenate(x) for x in zip(*wait))
                for lo in range(0, len(target) - BATCH + 1, BATCH):
                    step(p, sums, context[lo:lo + BATCH], target[lo:lo + BATCH])
                    trained += BATCH
                left = len(target) % BATCH
                wait, held = [(context[len(target) - left:], target[len(target) - left:])], left
        if held:
            context, target = (np.concatenate(x) for x in zip(*wait))
            step(p, sums, context, target)
            trained += held
        if trained:
            flat = _flat(p)
            for lo in range(0, len(flat), 10_000):
                part = flat[lo:lo + 10_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(lo, lo + len(part), dtype=np.int32)), pa.array(part),
                     pa.array(np.full(len(part), float(trained)))], names=["i", "w", "n"])
    return run


def _cut(column) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(words, number of words of each text) of runs of consecutive texts with about ``CUT``
    bytes in all; a longer text stands alone. Words are cut like ``bytes.split`` does."""
    texts = pc.fill_null(column.cast(pa.large_binary()), b"")
    end, lo = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)), 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(end, (end[lo - 1] if lo else 0) + CUT, side="right")))
        cut = pc.ascii_split_whitespace(texts[lo:hi].view(pa.large_string()))
        sizes, words = np.array(pc.list_value_length(cut), np.int64), cut.flatten().view(pa.large_binary())
        full = pc.greater(pc.binary_length(words), 0)                # space at either end cuts off an empty word
        sizes -= np.bincount(pc.list_parent_indices(cut).filter(pc.invert(full)), minlength=hi - lo)
        yield words.filter(full), sizes
        lo = hi


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for words, _ in _cut(batch.column(0)):
            w, n = words.value_counts().flatten()
            yield pa.RecordBatch.from_arrays([w.cast(pa.binary()), n], names=["w", "n"])


def count_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """Written table (w, n): every word of all texts, as bytes, and how often it occurs. Tasks
    count a bounded number of texts at a time, Spark adds up."""
    words = docs.select(F.col(text).cast("string").alias("t")).mapInArrow(_count_batches, "w binary, n long")
    return materialize(words.groupBy("w").agg(F.sum("n").alias("n")), "word-counts")


def frequent(counts: DataFrame) -> tuple[list[bytes], dict[bytes, int]]:
    """The vocabulary, and the counts of it and of other frequent words: the first of
    each of a fixed number of parts, so that what the driver holds does not grow. Only words
    that can be among them, by the bits of their counts, are ranked."""
    part, bits = F.pmod(F.xxhash64("w"), F.lit(SHARES)).cast("int"), F.length(F.bin("n"))
    least, above = [0] * SHARES, [0] * SHARES
    for r in sorted(counts.groupBy(part.alias("p"), bits.alias("b")).count().collect(), key=lambda r: -r["b"]):    # 64 rows a part at most
        if above[r["p"]] < WORDS:
            least[r["p"]] = r["b"]
        above[r["p"]] += r["count"]
    rank = F.row_number().over(Window.partitionBy(part).orderBy(F.desc("n"), "w"))
    rows = (counts.where(bits >= F.get(F.array(*map(F.lit, least)), part)).withColumn("r", rank)
            .where(F.col("r") <= WORDS).select("w", "n").collect())
    known = {bytes(r["w"]): r["n"] for r in rows}
    return sorted(known, key=lambda w: (-known[w], w))[:WORDS], known


def shares(counts: DataFrame, vocabulary: list[bytes], known: dict[bytes, int]) -> tuple[Column, dict[bytes, float]]:
    """ln of the share of a word (``w``, ``n``) in the occurrences of its shared id, as an
    expression; and the shares of the known words beyond the vocabulary."""
    slot = F.pmod(F.crc32("w"), F.lit(OTHERS)).cast("int")
    total = {r["s"]: r["n"] for r in counts.groupBy(slot.alias("s")).agg(F.sum("n").alias("n")).collect()}    # OTHERS rows
    for w in vocabulary:
        total[zlib.crc32(w) % OTHERS] -= known[w]
    mass = F.array(*[F.lit(float(total.get(i, 0))) for i in range(OTHERS)])
    own = set(vocabulary)
    return (F.log(F.col("n") / F.nullif(F.get(mass, slot), F.lit(0.0))),
            {w: float(np.log(n / total[zlib.crc32(w) % OTHERS])) for w, n in known.items() if w not in own})


class Places:
    """Word to its place in a table of ids and shares: the vocabulary, the shared ids, then the
    other words whose share is known."""

    def __init__(self, words: list[bytes], near: dict[bytes, float]):
        self.own, own = len(words), set(words)
        other = [w for w in near if w not in own]
        self.words = pa.array([*words, *other], pa.large_binary())
        shared = [WORDS + zlib.crc32(w) % OTHERS for w in other]
        self.ids = np.array([*range(SIZE), *shared], np.uint16)
        self.shares = np.array([0.0] * SIZE + [near[w] for w in other])

    def of(self, words: pa.Array | list[bytes]) -> np.ndarray:
        if not isinstance(words, pa.Array):
            words = pa.array(words, pa.large_binary())
        found = pc.index_in(words, value_set=self.words)
        out = found.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        out[out >= self.own] += SIZE - self.own
        if found.null_count:
            far = words.filter(pc.is_null(found))
            edge, raw = np.frombuffer(far.buffers()[1], np.int64)[far.offset:far.offset + len(far) + 1].tolist(), far.buffers()[2].to_pybytes()
            out[out < 0] = WORDS + np.array([zlib.crc32(raw[a:b]) for a, b in zip(edge, edge[1:])]) % OTHERS
        return out


def _offsets(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)


def _encode_batches(words, near):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, number = Places(words.value, near.value if near else {}), TaskContext.get().partitionId() << 40
        for batch in batches:
            codes, tokens, share, far, beyond = [np.zeros(0, np.uint16)], [], [], [pa.array([], pa.large_binary())], []
            for cut, sizes in _cut(batch.column(0)):
                place, n = places.of(cut), len(sizes)
                codes.append(places.ids[place])
                tokens.append(sizes)
                row = np.repeat(np.arange(n), sizes)
                at = np.flatnonzero((place >= WORDS) & (place < SIZE)) if near else np.zeros(0, np.int64)
                share.append(np.bincount(row, places.shares[place], n))
                far.append(cut.take(pa.array(at)))
                beyond.append(np.bincount(row[at], minlength=n))
            if not tokens:
                continue
            n, data = batch.num_rows, np.concatenate(codes)
            yield pa.RecordBatch.from_arrays(
                [pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(_offsets(2 * np.concatenate(tokens))), pa.py_buffer(data)]),
                 pa.array(np.arange(number, number + n)), pa.array(np.concatenate(share)),
                 pa.ListArray.from_arrays(pa.array(_offsets(np.concatenate(beyond))), pa.concat_arrays(far).cast(pa.binary())),
                 batch.column(1)], names=["codes", "number", "share", "far", "row"])
            number += n
    return run


def encode(docs: DataFrame, vocabulary: list[bytes], near: dict[bytes, float] | None = None, text: str = "text",
           columns: list[str] | None = None) -> DataFrame:
    """Written table (codes, number, share, far, row): the ids of every text, two bytes each, so
    that texts are cut once; a number of its own; and, with ``near``, the sum of the shares of its
    words that are in it, and its words that are neither there nor in the vocabulary."""
    src = whole_rows(docs, text, columns)
    sc = docs.sparkSession.sparkContext
    task = _encode_batches(sc.broadcast(vocabulary), None if near is None else sc.broadcast(near))
    return materialize(src.mapInArrow(task, with_row("codes binary, number long, share double, far array<binary>", src)), "word-ids")


def fit(codes: DataFrame, rounds: int = ROUNDS) -> np.ndarray:
    """Weights trained on all texts of a table of ``encode``."""
    sc = codes.sparkSession.sparkContext
    weights = _flat(initial())
    for turn in range(rounds):
        task = _train_batches(sc.broadcast(weights), turn, rounds)
        mean = (codes.select("codes").mapInArrow(task, "i int, w float, n double").groupBy("i")
                .agg((F.sum(F.col("w") * F.col("n")) / F.sum("n")).alias("w")).collect())    # one model
        if mean:
            weights = np.zeros(len(weights), np.float32)
            weights[[r["i"] for r in mean]] = [r["w"] for r in mean]
    return weights


def train(docs: DataFrame, text: str = "text", rounds: int = ROUNDS) -> tuple[list[bytes], np.ndarray]:
    """(vocabulary, weights): counts and training cover all texts."""
    counts = count_words(docs, text)
    vocabulary, _ = frequent(counts)
    codes = encode(docs.select(F.col(text).alias("text"), F.lit(0).alias("none")), vocabulary, columns=["none"])
    weights = fit(codes, rounds)
    drop_tables(counts, codes)
    return vocabulary, weights


def _score_batches(words, weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, p = words and Ids(words.value), _shaped(weights.value)
        for batch in batches:
            texts = batch.column(0).cast(pa.large_binary())
            total, count = [], []
            for lo in range(0, len(texts), 256):
                stream, at, sizes = _joined(texts[lo:lo + 256], ids)
                value = np.concatenate([np.zeros(0)] + [
                    log_probabilities(p, _contexts(stream, at[a:a + 4096]), stream[at[a:a + 4096]])
                    for a in range(0, len(at), 4096)])
                edge = np.concatenate(([0.0], np.cumsum(value, dtype=np.float64)))
                last = np.cumsum(sizes)
                total.append(edge[last] - edge[last - sizes])
                count.append(sizes)
            cat = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cat(count, np.int64)), pa.array(cat(total, np.float64)), batch.column(1)],
                names=["n_tokens", "log_likelihood", "row"])
    return run


def score(docs: DataFrame, vocabulary: list[bytes], weights: np.ndarray, text: str = "text",
          columns: list[str] | None = None) -> DataFrame:
    """(n_tokens, log_likelihood, row): pseudo-log-likelihood of every text."""
    sc = docs.sparkSession.sparkContext
    src = whole_rows(docs, text, columns)
    return src.mapInArrow(_score_batches(sc.broadcast(vocabulary), sc.broadcast(weights)),
                          with_row("n_tokens long, log_likelihood double", src))


def likelihoods(docs: DataFrame, text: str = "text", columns: list[str] | None = None, rounds: int = ROUNDS) -> DataFrame:
    """(n_tokens, log_likelihood, row): every text under a model of all texts, with the exact
    shares of the words that share ids."""
    counts = count_words(docs, text)
    vocabulary, known = frequent(counts)
    share, near = shares(counts, vocabulary, known)
    codes = encode(docs, vocabulary, near, text, columns)
    # sort-merge joins whatever the sizes, so that small and large inputs run the same plan; words
    # that occur once need no row
    often = counts.where("n > 1").select("w", F.col("n").alias("often"))
    far = materialize(codes.select("number", F.explode("far").alias("w")).join(often.hint("merge"), "w", "left")
                      .withColumn("n", F.coalesce("often", F.lit(1)))
                      .groupBy("number").agg(F.sum(share).alias("far")), "word-shares")
    drop_tables(counts)
    weights = docs.sparkSession.sparkContext.broadcast(fit(codes, rounds))
    src = codes.select("codes", F.struct("number", "share", "row").alias("row"))
    scored = src.mapInArrow(_score_batches(None, weights), with_row("n_tokens long, log_likelihood double", src))
    return (scored.select("n_tokens", "log_likelihood", F.col("row.number").alias("number"), F.col("row.share").alias("share"),
                          F.col("row.row").alias("row"))
            .join(far.hint("merge"), "number", "left")
            .select("n_tokens", (F.col("log_likelihood") + F.col("share") + F.coalesce("far", F.lit(0.0))).alias("log_likelihood"), "row"))


def query(spark, sf_dir: str) -> DataFrame:
    """op5: score of every document under a model of all documents."""
    scored = likelihoods(spark.read.parquet(f"{sf_dir}/documents.parquet"), columns=["doc_id"])
    return scored.select(F.col("row.doc_id").alias("doc_id"), "n_tokens", "log_likelihood",
                         F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens"))
                          .otherwise(0.0).alias("mean_log_probability"))
