"""Quality classifier: a byte-level convolutional network in numpy.

A text's bytes become learned vectors (with a second vector where the bytes
echo what stood up to 24 bytes before). Learned filters of 8 bytes run over
every fourth byte; their positive answers are averaged in overlapping chunks
of 128 bytes every 64 bytes, a second layer of learned filters judges each
chunk, and the largest answer of each filter over all chunks of the whole
text gives one probability. A text of any length is covered from end to end.

The network is fitted on the driver on a bounded sample: at most
``SAMPLE`` labelled rows of each class outside the held-out fold, in the order
of a hash of their ids, of texts up to ``SAMPLE_BYTES`` bytes (longer ones are
only scored). Scores see nothing but the text.

Defined results: a null or empty text is scored as two empty blocks; without
labels of both classes the score is the share of good labels (0.5 without
any); rows without an id are not held out; repeated rows get equal scores; an
empty table gives an empty result; other columns are passed through or not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from restock.llm import common as C

SAMPLE = 1500
SAMPLE_BYTES = 16_384
THRESHOLD = 0.3
BLOCK, STRIDE, DIM, FILTERS, JUDGES = 64, 4, 6, 16, 12
ECHO = range(2, 25)
STEPS, BATCH, RATE = 420, 48, 0.01


def layout(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes + 256 where they echo, first block of each text and the total):
    each text in whole blocks of its own, two at least."""
    size = np.diff(offs)
    blocks = np.maximum(2, -(-size // BLOCK))
    first = np.concatenate(([0], np.cumsum(blocks)))
    padded = np.zeros(int(first[-1]) * BLOCK, np.uint8)
    padded[np.arange(len(data)) + np.repeat(first[:-1] * BLOCK - offs[:-1], size)] = data
    echo = np.zeros(len(padded), bool)
    for lag in ECHO:                        # eight bytes in a row equal to those ``lag`` before
        same = padded[lag:] == padded[:-lag]
        same &= padded[lag:] != 0
        for step in (1, 2, 4):
            same[:-step] &= same[step:]
        echo[lag:] |= same
    return padded.astype(np.uint16) + (echo.astype(np.uint16) << 8), first


class Network:
    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        f = np.float32
        self.p = {
            "table": (r.normal(size=(512, DIM)) * 0.5).astype(f),
            "near": (r.normal(size=(STRIDE * DIM, FILTERS)) * 0.2).astype(f),
            "next": (r.normal(size=(STRIDE * DIM, FILTERS)) * 0.2).astype(f),
            "bias": np.zeros(FILTERS, f),
            "judge": (r.normal(size=(FILTERS, JUDGES)) * 0.5).astype(f),
            "judge_bias": np.full(JUDGES, 0.05, f),
            "out": (r.normal(size=JUDGES) * 0.3).astype(f),
            "out_bias": np.zeros(1, f)}
        self.p["table"][[0, 256]] = 0

    def _forward(self, codes: np.ndarray, first: np.ndarray) -> dict:
        p = self.p
        x = p["table"][codes].reshape(-1, STRIDE * DIM)
        y = x @ p["near"]
        y[:-1] += (x @ p["next"])[1:]
        y += p["bias"]
        ends = first[1:] * (BLOCK // STRIDE) - 1
        y[ends] = 0                         # the last filter would reach into the next text
        np.maximum(y, 0, out=y)
        block = y.reshape(-1, BLOCK // STRIDE, FILTERS).sum(axis=1)
        chunk = (block[:-1] + block[1:]) / (2 * BLOCK // STRIDE)
        inside = np.ones(len(chunk), bool)
        inside[first[1:-1] - 1] = False     # not across two texts
        chunk = chunk[inside]
        z = chunk @ p["judge"] + p["judge_bias"]
        np.maximum(z, 0, out=z)
        start = first[:-1] - np.arange(len(first) - 1)
        pooled = np.maximum.reduceat(z, start, axis=0)
        logit = pooled @ p["out"] + p["out_bias"][0]
        return {"x": x, "y": y, "inside": inside, "chunk": chunk, "z": z, "start": start,
                "pooled": pooled, "logit": logit}

    def score(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        logit = self._forward(*layout(data, offs))["logit"].astype(np.float64)
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))

    def _gradients(self, codes, first, label, weight) -> dict:
        p, f = self.p, self._forward(codes, first)
        d = ((1 / (1 + np.exp(-f["logit"])) - label) * weight / weight.sum()).astype(np.float32)
        g = {"out": f["pooled"].T @ d, "out_bias": d.sum(keepdims=True)}
        # the pooled answer's gradient goes to the first chunk that gave it
        n = np.diff(np.append(f["start"], len(f["z"])))
        hit = f["z"] == np.repeat(f["pooled"], n, axis=0)
        at = np.where(hit, np.arange(len(hit))[:, None], len(hit))
        at = np.minimum.reduceat(at, f["start"], axis=0)
        dz = np.zeros_like(f["z"])
        dz[at, np.arange(JUDGES)] = d[:, None] * p["out"]
        dz *= f["z"] > 0
        g["judge"], g["judge_bias"] = f["chunk"].T @ dz, dz.sum(axis=0)
        dchunk = np.zeros((len(f["inside"]), FILTERS), np.float32)
        dchunk[f["inside"]] = dz @ p["judge"].T / (2 * BLOCK // STRIDE)
        dblock = np.zeros((len(dchunk) + 1, FILTERS), np.float32)
        dblock[:-1] += dchunk
        dblock[1:] += dchunk
        dy = np.repeat(dblock, BLOCK // STRIDE, axis=0) * (f["y"] > 0)
        g["bias"] = dy.sum(axis=0)
        g["near"] = f["x"].T @ dy
        g["next"] = f["x"][1:].T @ dy[:-1]
        dx = dy @ p["near"].T
        dx[1:] += dy[:-1] @ p["next"].T
        dx = dx.reshape(-1, DIM)
        g["table"] = np.stack([np.bincount(codes, dx[:, i], 512) for i in range(DIM)], axis=1)
        g["table"][[0, 256]] = 0
        return g

    def fit(self, texts: list[bytes], labels: np.ndarray, seed: int = 7) -> "Network":
        """Adam on class-balanced batches of whole texts."""
        good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
        if not len(good) or not len(bad):
            share = len(good) / len(labels) if len(labels) else 0.5
            self.p["out"][:] = 0
            self.p["out_bias"][0] = np.log((share + 1e-9) / (1 - share + 1e-9))
            return self
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        for step in range(1, STEPS + 1):
            pick = np.concatenate((r.choice(good, BATCH // 2), r.choice(bad, BATCH // 2)))
            size = np.array([len(texts[i]) for i in pick])
            offs = np.concatenate(([0], np.cumsum(size)))
            codes, first = layout(np.frombuffer(b"".join(texts[i] for i in pick), np.uint8), offs)
            g = self._gradients(codes, first, labels[pick], np.ones(len(pick)))
            rate = RATE * (1 - step / (STEPS + 1))
            for k, v in self.p.items():
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                s[k] = 0.99 * s[k] + 0.01 * g[k] ** 2
                v -= (rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.99 ** step)) + 1e-7)).astype(np.float32)
        return self


def held_out(id_column: str):
    """The fold that is never learned from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text",
        sample: int = SAMPLE) -> Network:
    """Fit on at most ``sample`` labelled rows a class (see the module's text)."""
    known = (labels.select(F.col(id_column).alias("id"), F.col("quality").cast("int").alias("label"))
             .where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out("id")))
    order = [F.xxhash64(F.col("id").cast("string")), "id"]
    chosen = None
    for c in (0, 1):
        part = known.where(F.col("label") == c).orderBy(*order).limit(sample)
        chosen = part if chosen is None else chosen.unionByName(part)
    # at most 2 * sample ids: a bounded side
    rows = (docs.select(F.col(id_column).alias("id"), F.col(text).cast("string").alias("body"))
            .where(F.octet_length("body") <= SAMPLE_BYTES)
            .join(F.broadcast(chosen), "id").select("body", "label").distinct().collect())
    rows = sorted((r["body"].encode(), r["label"]) for r in rows)[:2 * sample]
    return Network().fit([t for t, _ in rows], np.array([y for _, y in rows], np.int64))


def _score_batches(shared, least: float | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            parts = [net.score(data, offs) for _, _, data, offs in C.text_chunks(batch.column(0), 1 << 18)]
            score = np.concatenate(parts) if parts else np.zeros(0)
            out = pa.RecordBatch.from_arrays([pa.array(score), batch.column(1)], names=["score", "row"])
            yield out if least is None else out.filter(pa.array(score >= least))
    return run


def score(docs: DataFrame, net: Network, text: str = "text", columns: list[str] | None = None,
          least: float | None = None) -> DataFrame:
    """(score, row) of every row; with ``least`` only of rows scored that high."""
    src = C.whole_rows(docs, text, columns)
    shared = docs.sparkSession.sparkContext.broadcast(net)
    return src.mapInArrow(_score_batches(shared, least), C.with_row("score double", src))


def query(spark, sf_dir: str) -> DataFrame:
    """op1: quality of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    net = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, net, columns=["doc_id"]).select(
        F.col("row.doc_id").alias("doc_id"), held_out("row.doc_id").alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
