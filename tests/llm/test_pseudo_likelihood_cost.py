"""CPU seconds of op5 (F1 of round 3): one exponential a logit, words cut, counted and looked up by column."""
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("restock.llm")
from restock.llm import pseudo_likelihood as P  # noqa: E402

TEXTS = [b"a b a", None, b"", b" \t ", bytes(range(256)), b" c\x0bd\x1ce \xc3\xa9\xe2\x80\x83f\n", b"a", b"  a b\r\n"]


def split(t):
    return (t or b"").split()


def parameters(scale=1.0):
    r = np.random.default_rng(5)
    return {k: (v + r.normal(size=v.shape) * 0.1).astype(np.float32) * np.float32(scale) for k, v in P.initial().items()}


def places(n=500):
    r = np.random.default_rng(4)
    return r.integers(0, P.SIZE, (n, 2 * P.SIDE)).astype(np.int32), r.integers(0, P.SIZE, n).astype(np.int32)


def plain(p, context, target):
    p = {k: v.astype(np.float64) for k, v in p.items()}
    h = np.tanh(p["embed"][context].reshape(len(context), -1) @ p["hidden"] + p["hidden_bias"])
    out = np.zeros(len(target))
    for i, t in enumerate(target):
        c, m = divmod(int(t), P.CLASS)
        for logits, k in ((h[i] @ p["class"] + p["class_bias"], c), (h[i] @ p["word"][c] + p["word_bias"][c], m)):
            out[i] += logits[k] - logits.max() - np.log(np.exp(logits - logits.max()).sum())
    return out


def test_a_step_and_a_score_take_one_exponential_a_logit(monkeypatch):
    numbers, exp = [], np.exp
    monkeypatch.setattr(np, "exp", lambda x, *a, **k: numbers.append(np.size(x)) or exp(x, *a, **k))
    p = parameters()
    P.step(p, {k: np.full_like(v, 1e-3) for k, v in p.items()}, *places())
    assert sum(numbers) <= 500 * (P.CLASS + P.CLASSES)
    numbers.clear()
    P.log_probabilities(p, *places())
    assert len(numbers) <= 2


@pytest.mark.parametrize("scale", [1, 30, 300])
def test_logits_beyond_the_range_of_exponentials(scale):
    p = parameters(scale)
    context, target = places()
    want = plain(p, context, target)
    assert scale < 300 or want.min() < -100
    got = P.log_probabilities(p, context, target)
    assert np.allclose(got, want, rtol=2e-3, atol=2e-3 * max(1, scale / 30))
    P.step(p, {k: np.full_like(v, 1e-3) for k, v in p.items()}, context, target)
    assert all(np.isfinite(v).all() for v in p.values())


@pytest.mark.parametrize("size", [1, 8, 1 << 24])
def test_words_are_cut_as_bytes_split_does(monkeypatch, size):
    monkeypatch.setattr(P, "CUT", size)
    got = [x for x in P._cut(pa.array(TEXTS, pa.binary()))]
    assert [w for words, _ in got for w in words.to_pylist()] == [w for t in TEXTS for w in split(t)]
    assert [n for _, sizes in got for n in sizes.tolist()] == [len(split(t)) for t in TEXTS]
    part = pa.array(TEXTS, pa.binary())[2:6]
    assert [w for words, _ in P._cut(part) for w in words.to_pylist()] == [w for t in TEXTS[2:6] for w in split(t)]
    assert not list(P._cut(pa.array([], pa.binary())))


def test_counts_are_exact_without_a_row_a_word(monkeypatch):
    monkeypatch.setattr(P, "CUT", 8)
    batch = pa.RecordBatch.from_arrays([pa.array(TEXTS * 3, pa.binary())], names=["t"])
    total = Counter()
    for x in P._count_batches(iter([batch])):
        for w, n in zip(x.column(0).to_pylist(), x.column(1).to_pylist()):
            total[w] += n
    assert total == Counter(w for t in TEXTS * 3 for w in split(t))
    monkeypatch.setattr(P, "CUT", 1 << 24)
    assert sum(x.num_rows for x in P._count_batches(iter([batch]))) == len(total)


def test_frequent_words_are_the_first_of_each_part(spark, monkeypatch):
    monkeypatch.setattr(P, "WORDS", 7)
    monkeypatch.setattr(P, "SHARES", 3)
    rows = [(f"w{i}".encode(), n) for i, n in enumerate([1] * 30 + [2] * 9 + [3] * 4 + [5, 6, 7, 8, 9, 1000, 5_000_000_000])]
    counts = spark.createDataFrame(rows, "w binary, n long")
    words, known = P.frequent(counts)
    part = {r["w"].encode(): r["p"] for r in counts.selectExpr("cast(w as string) w", "pmod(xxhash64(cast(w as string)), 3) p").collect()}
    want = {}
    for p in range(3):
        want |= dict(sorted(((w, n) for w, n in rows if part[w] == p), key=lambda x: (-x[1], x[0]))[:7])
    assert known == want
    assert words == sorted(want, key=lambda w: (-want[w], w))[:7]
    assert P.frequent(counts.where("n > 4 and n < 9"))[1] == dict(rows[43:47])
    assert P.frequent(counts.where("false")) == ([], {})


def test_places_without_words_and_with_unknown_ones():
    some = [b"", b"x", b"yy" * 5000, b"x"]
    shared = [P.WORDS + zlib.crc32(w) % P.OTHERS for w in some]
    assert P.Places([], {}).of(some).tolist() == shared
    assert P.Places([b"x"], {b"z": -1.0}).of(pa.array(some, pa.large_binary())[1:]).tolist() == [0, shared[2], 0]
    assert P.Places([b"x"], {b"z": -1.0}).of([b"z"]).tolist() == [P.SIZE]
