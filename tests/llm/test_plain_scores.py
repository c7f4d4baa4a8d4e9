"""Scores of the quality network and of the language model, against plain loops over whole texts."""

from __future__ import annotations

import math

import numpy as np
import pytest
from llm_support import docs_of, shipped  # noqa: F401

from tallystone.llm import lm_score, quality

TEXTS = ["", "a", "Plain words, é and more. " * 40, "x" * 1030, "0123456789" * 103]


def plain_quality(net, text):
    raw = text.encode()
    count = max(1, math.ceil(len(raw) / quality.CHUNK))
    padded = raw + bytes(count * quality.CHUNK + quality.WIDTH - len(raw))
    logit = float(net.constant[0])
    sizes = [max(1, min(quality.CHUNK, len(raw) - i * quality.CHUNK)) for i in range(count)]
    for i in range(count):
        chunk = padded[i * quality.CHUNK : (i + 1) * quality.CHUNK + quality.WIDTH]
        for f in range(quality.FILTERS):
            best = max(
                sum(float(net.vectors[chunk[at + w], v]) * float(net.filters[w * quality.VECTOR + v, f]) for w in range(quality.WIDTH) for v in range(quality.VECTOR))
                for at in range(0, len(chunk) - quality.WIDTH + 1, quality.STRIDE)
            )
            logit += max(best + float(net.shift[f]), 0) * float(net.out[f]) * sizes[i] / sum(sizes)
    return 1 / (1 + math.exp(-logit))


def test_quality_scores_equal_plain_loops(shipped):  # noqa: F811
    net = quality.Network.fresh(3)
    net.shift += np.linspace(-0.5, 0.5, quality.FILTERS).astype(np.float32)
    net.constant += np.float32(0.3)
    rows = quality.scored(docs_of(shipped, TEXTS), net).collect()
    for r in rows:
        assert r.score == pytest.approx(plain_quality(net, r.row.text), rel=1e-3)


def test_long_texts_give_the_same_gradient_part_by_part(monkeypatch):
    net = quality.Network.fresh(1)
    chunks, share = quality.chunks_of(b"some words of a text " * 500)
    args = chunks, np.zeros(len(chunks), int), share.astype(np.float32), np.array([1.0])
    whole = net.gradient(*args)
    monkeypatch.setattr(quality, "_AT_ONCE", 3)
    for a, b in zip(whole, net.gradient(*args), strict=True):
        assert np.allclose(a, b, atol=1e-5)


def plain_lm(model, ids):
    """log10 probability of ids[1:], each from its block's ids so far and the QUERY ids before the block."""
    w = {k: v.astype(float) for k, v in model.weights.items()}
    total, size = 0.0, lm_score.QUERY
    for at in range(len(ids) - 1):
        start = at // size * size
        seen = range(max(0, start - size), at + 1)
        x = {i: w["ids"][ids[i]] + w["places"][i - start + size] for i in seen}
        q = x[at] @ w["q"] / math.sqrt(lm_score.WIDTH)
        s = np.array([q @ (x[i] @ w["k"]) for i in seen])
        a = np.exp(s - s.max())
        a /= a.sum()
        h = x[at] + sum(p * (x[i] @ w["v"]) for p, i in zip(a, seen, strict=True)) @ w["o"]
        logits = h @ w["classes"] + w["shift"] + model.prior.classes
        logits -= logits.max()
        target = ids[at + 1]
        total += logits[model.prior.of[target]] - math.log(np.exp(logits).sum()) + model.prior.within[target]
    return total / math.log(10)


def test_language_model_scores_equal_plain_loops(shipped, monkeypatch):  # noqa: F811
    texts = ["one two three four five six seven eight nine ten eleven. " * 3, "", "Word", "ünï cödé 12,5 word " * 9, "the same the same " * 20]
    trained, real = [], lm_score.train
    monkeypatch.setattr(lm_score, "train", lambda *a, **b: (trained.append(real(*a, **b)), trained[0])[1])
    rows = lm_score.score(docs_of(shipped, texts), warm_ids=400).collect()
    subwords = lm_score.Subwords(lm_score.VOCABULARY)
    for r in rows:
        words = lm_score.words_of(texts[r.doc_id].encode())
        ids = [lm_score.END, *(subwords.of_words(words).tolist() if words else []), lm_score.END]
        assert r.score == pytest.approx(plain_lm(trained[0], ids), rel=1e-3)


def test_ids_of_words_are_those_of_the_text():
    subwords = lm_score.Subwords(lm_score.VOCABULARY)
    words = [f"w{i}é,{i % 7}" for i in range(3000)] * 2 + ["a" * 5000]
    raw = [w.encode() for w in words]
    want = [lm_score.END, *subwords.of_words(raw).tolist(), lm_score.END]
    assert subwords.of_text(raw).tolist() == want
    odd = ["　", "x", "a　", "b", "　c", "\u2003\u2003", "d", "e"]
    each = [i for w in odd for i in subwords.of_words([w.encode()]).tolist()]
    assert subwords.of_text([w.encode() for w in odd]).tolist() == [lm_score.END, *each, lm_score.END]
    subwords._forget()
    assert subwords.of_text(raw[:10]).tolist() == lm_score.Subwords(lm_score.VOCABULARY).of_text(raw[:10]).tolist()
