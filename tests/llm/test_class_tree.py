"""The language model of op8_lm_score: classes told in two steps, words taken apart in columns."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pytest
from llm_support import docs_of, shipped  # noqa: F401

from tallystone.llm import lm_score

ODD = [" Ab  cd ", "", None, "   ", "x", "a\x1cb\x00c\tÀB\u0085z　 e\r\nf\x0bg\x0ch", "one two one ONE\n" * 40, "last"]


def tree_of(counts):
    return lm_score.ClassTree(lm_score.GroupedPrior(counts.astype(float)))


def test_tree_gradients():
    rng = np.random.default_rng(1)
    model = tree_of(rng.integers(0, 9, lm_score.IDS))
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    inputs, targets = lm_score.blocks_of(rng.integers(0, 400, 75).astype(np.int32))
    loss, grads = model.gradients(inputs, targets)
    n = (targets >= 0).sum()

    def mean_loss():
        return -(model.log_likelihood(inputs, targets).sum() - model.prior.within[np.maximum(targets, 0)][targets >= 0].sum()) / n

    assert loss == pytest.approx(mean_loss(), rel=1e-4) and set(grads) == set(model.weights)
    for name, grad in grads.items():
        rows, grad = grad if name == "ids" else (np.arange(len(model.weights[name])), grad)
        moved = np.argwhere(np.abs(grad) > np.abs(grad).max() / 4)
        for at in map(tuple, [*moved[:4], *moved[-2:]]):
            where = (rows[at[0]], *at[1:])
            kept, step = model.weights[name][where], 1e-4
            model.weights[name][where] = kept + step
            more = mean_loss()
            model.weights[name][where] = kept - step
            less = mean_loss()
            model.weights[name][where] = kept
            assert grad[at] == pytest.approx((more - less) / (2 * step), abs=3e-5, rel=1e-2)


def test_tree_probabilities_sum_to_one():
    rng = np.random.default_rng(2)
    for counts in (rng.integers(0, 9, lm_score.IDS), rng.zipf(1.2, lm_score.IDS) % 10**6, np.zeros(lm_score.IDS)):
        model = tree_of(counts)
        inputs = np.repeat(lm_score.blocks_of(np.array([lm_score.END, 5, 9, 5], np.int32))[0], 2_000, axis=0)
        total = 0.0
        for at in range(0, lm_score.IDS, len(inputs)):
            ids = np.arange(at, min(at + len(inputs), lm_score.IDS), dtype=np.int32)
            targets = np.full((len(ids), lm_score.QUERY), -1, np.int32)
            targets[:, 2] = ids
            total += np.exp(model.log_likelihood(inputs[: len(ids)], targets)).sum()
        assert total == pytest.approx(1, abs=1e-3)
        logits = model.forward(inputs[:1])["logits"][2]
        assert np.exp(logits).sum() == pytest.approx(1, abs=1e-4)


def test_a_tree_weighs_few_masses_and_tells_more_than_flat_classes(monkeypatch):
    rng = np.random.default_rng(3)
    ids = np.array([lm_score.END, *np.tile(rng.permutation(400), 8)], np.int32)
    counts = np.bincount(ids, minlength=lm_score.IDS)
    inputs, targets = lm_score.blocks_of(ids)
    model = tree_of(counts)
    model.learn(((inputs[a : a + 8], targets[a : a + 8]) for _ in range(12) for a in range(0, len(inputs), 8)), 0.05)
    assert model.log_likelihood(inputs, targets).sum() > -2 * (targets >= 0).sum()
    # Masses weighed for ids as frequent as words are: many times fewer than a flat model's classes.
    model = tree_of(10**6 / np.arange(1, lm_score.IDS + 1))
    some = lm_score.blocks_of((rng.zipf(1.3, 40_000) % lm_score.IDS).astype(np.int32))
    weighed, real = [0], np.exp
    monkeypatch.setattr(np, "exp", lambda x, **more: (weighed.__setitem__(0, weighed[0] + np.size(x)), real(x, **more))[1])
    model.log_likelihood(*some)
    assert weighed[0] / 40_000 < 2 * lm_score.QUERY + 64 < lm_score.CLASSES / 6


def plain_tree(model, ids):
    """log10 probability of ids[1:], with plain loops."""
    w, prior, size = {k: v.astype(float) for k, v in model.weights.items()}, model.prior, lm_score.QUERY
    total = 0.0
    for at in range(len(ids) - 1):
        start = at // size * size
        seen = range(max(0, start - size), at + 1)
        x = {i: w["ids"][ids[i]] + w["places"][i - start + size] for i in seen}
        s = np.array([(x[at] @ w["q"]) @ (x[i] @ w["k"]) / math.sqrt(lm_score.WIDTH) for i in seen])
        a = np.exp(s - s.max())
        h = x[at] + sum(p * (x[i] @ w["v"]) for p, i in zip(a / a.sum(), seen, strict=True)) @ w["o"]
        target = prior.of[ids[at + 1]]
        group = prior.group[target]
        top = h @ w["groups"] + w["lean"] + prior.groups
        some = np.flatnonzero(prior.group == group)
        low = (h @ w["classes"] + w["shift"] + prior.classes)[some]
        total += top[group] - np.log(np.exp(top).sum()) + low[some == target][0] - np.log(np.exp(low).sum()) + prior.within[ids[at + 1]]
    return total / math.log(10)


def test_scores_of_the_query_equal_plain_loops(shipped, monkeypatch, tmp_path):  # noqa: F811
    texts = ["one two three four five six seven eight nine ten eleven. " * 30, "", "Word", "ünï cödé 12,5 word " * 9, "the same the same " * 20, *[t for t in ODD if t]]
    docs_of(shipped, texts).write.parquet(str(tmp_path / "documents.parquet"))
    trained, real = [], lm_score.train
    monkeypatch.setattr(lm_score, "train", lambda *a, **b: (trained.append(real(*a, **b)), trained[0])[1])
    rows = lm_score.op8_lm_score(shipped, str(tmp_path)).collect()
    subwords = lm_score.Subwords(lm_score.VOCABULARY)
    assert len(rows) == len(texts) and isinstance(trained[0], lm_score.ClassTree)
    for r in rows:
        ids = subwords.of_text(lm_score.words_of(texts[r.doc_id].encode())).tolist()
        assert r.score == pytest.approx(plain_tree(trained[0], ids), rel=1e-3)


def test_words_in_columns_are_those_of_the_text(monkeypatch):
    subwords = lm_score.Subwords(lm_score.VOCABULARY)
    want = [lm_score.words_of((t or "").encode()) for t in ODD]
    for size, at_once in ((1 << 22, 100_000), (20, 100_000), (1, 3)):
        monkeypatch.setattr(lm_score, "_BYTES_AT_ONCE", size)
        monkeypatch.setattr(lm_score, "_WORDS_AT_ONCE", at_once)
        for column in (pa.array(ODD), pa.array([t and t.encode() for t in ODD], pa.binary())):
            found, ids = [], []
            for texts, owner, codes, words in lm_score._worded(column):
                distinct = words.to_pylist()
                assert len(set(distinct)) == len(distinct)
                found += [[distinct[c] for c in codes[owner == i]] for i in range(texts)]
                all_ids, edges = subwords.of_texts(owner, codes, distinct, texts)
                ids += [all_ids[a:b].tolist() for a, b in zip(edges[:-1], edges[1:], strict=True)]
            assert found == want
            assert ids == [subwords.of_text(w).tolist() for w in want]
    counted = {}
    for batch in lm_score._count_words([pa.RecordBatch.from_arrays([pa.array(ODD)], names=["text"])]):
        for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counted[word] = counted.get(word, 0) + n
    assert counted == {w: sum(x.count(w) for x in want) for x in want for w in x}
