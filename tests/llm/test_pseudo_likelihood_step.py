"""Cost and results of a training step and of encoding (op5 in round 3)."""
import numpy as np
import pytest

pytest.importorskip("restock.llm")
from restock.llm import pseudo_likelihood as P  # noqa: E402


def batch(n=700):
    r = np.random.default_rng(3)
    return r.integers(0, P.SIZE, (n, 2 * P.SIDE)).astype(np.int32), (r.integers(0, P.SIZE, n) // 3 * 2).astype(np.int32)


def trained(steps=3):
    p = P.initial()
    sums = {k: np.full_like(v, 1e-3) for k, v in p.items()}
    for _ in range(steps):
        P.step(p, sums, *batch())
    return p


def plain_log(p, context, target):
    h = np.tanh(p["embed"][context].reshape(len(context), -1) @ p["hidden"] + p["hidden_bias"])
    out = np.zeros(len(target))
    for i, t in enumerate(target):
        c, m = divmod(int(t), P.CLASS)
        for logits, k in ((h[i] @ p["class"] + p["class_bias"], c), (h[i] @ p["word"][c] + p["word_bias"][c], m)):
            logits = logits.astype(np.float64)
            out[i] += logits[k] - logits.max() - np.log(np.exp(logits - logits.max()).sum())
    return out


def test_a_step_takes_softmaxes_over_the_batch_not_by_class(monkeypatch):
    calls, exp = [], np.exp
    monkeypatch.setattr(np, "exp", lambda *a, **k: calls.append(1) or exp(*a, **k))
    trained(1)
    assert len(calls) <= 4, len(calls)


def test_a_step_follows_the_slope():
    context, target = batch(200)
    p = {k: v.astype(np.float64) for k, v in trained().items()}
    sums = {k: np.zeros_like(v) for k, v in p.items()}
    after = {k: v.copy() for k, v in p.items()}
    P.step(after, sums, context, target)
    r = np.random.default_rng(9)
    for k, v in p.items():
        for at in r.choice(v.size, 6, replace=False):
            i, d, got = np.unravel_index(at, v.shape), 1e-5, {}
            for sign in (1, -1):
                moved = {**p, k: v.copy()}
                moved[k][i] += sign * d
                got[sign] = -plain_log(moved, context, target).mean()
            slope = (got[1] - got[-1]) / (2 * d)
            assert abs(np.sqrt(sums[k][i]) - abs(slope)) < 1e-6, (k, i)
            assert abs(slope) < 1e-5 or (after[k][i] - v[i]) * slope < 0, (k, i)


def test_log_probabilities_match_a_plain_sum():
    context, target = batch(300)
    p = trained()
    assert np.allclose(P.log_probabilities(p, context, target), plain_log(p, context, target), atol=1e-4)


def test_places_give_ids_and_shares():
    words, near = [b"a", b"b"], {b"c": -1.5, b"d": -2.25}
    places, ids = P.Places(words, near), P.Ids(words)
    text = [b"a", b"c", b"x", b"d", b"c", b"b"]
    got = places.of(text)
    assert places.ids[got].tolist() == ids.of_words(text).tolist()
    assert places.shares[got].sum() == -5.25
    assert [w for w, i in zip(text, got) if P.WORDS <= i < P.SIZE] == [b"x"]
