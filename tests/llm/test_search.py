"""Ranked search by ball trees."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
from llm_support import SF, clashing, docs_of, same_as_sql, shipped  # noqa: F401

from tallystone.llm import ball_search

ITEMS = "item_id long, text string"


def terms_of(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def plain_search(docs, items, k=20):
    """docs: (id, text); items: (id, text). Every document against every item."""
    counted = [(key, Counter(terms_of(text))) for key, text in docs]
    counted = [(key, c) for key, c in counted if c]
    n_docs, n_terms = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = {}
    for key, text in items:
        asked.setdefault(key, Counter()).update(terms_of(text))
    out = set()
    for item, q in asked.items():
        hits = []
        for key, c in counted:
            m = 100 - 25 + (25 * c.total() * n_docs) // n_terms
            score = sum(
                times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                for t, times in q.items() if t in c
            )
            if score > 0:
                hits.append((-score, key is None, key or 0))
        out |= {(item, rank, None if null else key, -s) for rank, (s, null, key) in enumerate(sorted(hits)[:k], 1)}
    return out


def found(frame):
    return {(r.item_id, r.rank, r.doc_id, r.score) for r in frame.collect()}


def test_search_equals_its_sql(shipped):  # noqa: F811
    same_as_sql(ball_search.op11_ball_search(shipped, SF), ball_search.OP11_SQL)


def random_docs(n, seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    odds = [1 / (i + 1) for i in range(300)]
    texts = [" ".join(rng.choices(words, odds, k=rng.randint(0, 60))) for _ in range(n)]
    return [(i, t) for i, t in enumerate([*texts, *texts[:40], *["w7 W7, w9é"] * 60])], rng, words


def test_search_equals_brute_force(shipped):  # noqa: F811
    docs, rng, words = random_docs(700)
    docs += [(9000, "w1 " * 400_000 + "w299"), (9001, "x" * 1_500_000 + " w299 w7"), (9002, None), (9003, ""), (9004, " .,"), (None, "w7 w9é"), (5, "w7 w9é")]
    items = [(i, " ".join(rng.choices(words, k=12))) for i in range(12)]
    items += [(50, "w7 w9é w7"), (51, None), (52, "nowhere"), (None, "w299"), (53, "w1"), (53, "w2 w3"), (54, "W299 w299")]
    frame = clashing(docs_of(shipped, docs)).repartition(5)
    asked = shipped.createDataFrame(items, ITEMS)
    assert found(ball_search.search(frame, asked)) == plain_search(docs, items)
    # In several blocks of queries, for another k, and with text ids.
    assert found(ball_search.search(frame, asked, k=3, max_query_bytes=60)) == plain_search(docs, items, 3)
    named = frame.selectExpr("cast(doc_id as string) as doc_id", "text")
    names = [(None if key is None else str(key), text) for key, text in docs]
    assert found(ball_search.search(named, asked)) == {(i, r, k, s) for i, r, k, s in plain_search_by_text(names, items)}


def plain_search_by_text(docs, items):
    place = {key: i for i, key in enumerate(sorted({k for k, _ in docs if k is not None}))}
    back = {i: key for key, i in place.items()}
    return {(i, r, back.get(k), s) for i, r, k, s in plain_search([(place.get(key), text) for key, text in docs], items)}


def test_empty_tables(shipped):  # noqa: F811
    asked = shipped.createDataFrame([(1, "w1")], ITEMS)
    assert ball_search.search(docs_of(shipped, []), asked).collect() == []
    nothing = ball_search.search(docs_of(shipped, ["w1"]), asked.limit(0))
    assert nothing.collect() == [] and nothing.columns == ["item_id", "rank", "doc_id", "score"]
    assert found(ball_search.search(docs_of(shipped, ["w1", "w2", "w2"]), asked)) == plain_search([(0, "w1"), (1, "w2"), (2, "w2")], [(1, "w1")])


def test_bounds_hold_and_cut():
    """No ball's bound is below a score inside it, and most documents of other languages are never scored."""
    rng = random.Random(1)
    langs = [[f"{p}{i}" for i in range(200)] for p in "abcd"]
    docs = [Counter(rng.choices(langs[i % 4], [1 / (j + 1) for j in range(200)], k=80)) for i in range(2000)]
    asked = [Counter(rng.choices(langs[i % 4], k=15)) for i in range(8)]
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*asked)))}
    rows = [sorted((vocabulary[t], c) for t, c in d.items() if t in vocabulary) for d in docs]
    starts = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    terms, tfs = (np.array([x[j] for r in rows for x in r], np.int64) for j in (0, 1))
    df = np.bincount(terms, minlength=len(vocabulary))
    queries = ball_search.Queries(asked, vocabulary, df, len(docs))
    impact = ball_search.impacts(tfs, np.full(len(terms), 80), len(docs), 80 * len(docs))
    tree = ball_search.BallTree(starts, terms, impact, queries)
    assert sorted(tree.order.tolist()) == list(range(len(docs)))
    for i in range(len(queries)):
        weights, x = np.zeros(len(vocabulary), np.int64), np.zeros(len(vocabulary))
        weights[queries.ids[i]], x[queries.ids[i]] = queries.weights[i], queries.scaled(i)
        by_group = np.sqrt(np.bincount(queries.group, x * x, tree.groups))
        scores = np.array([sum(weights[t] * v for t, v in zip(terms[a:b], impact[a:b], strict=True)) for a, b in zip(starts, starts[1:], strict=False)])
        for lo, hi, of, center, radius, _ in tree.balls:
            assert float(x[of] @ center) + float(by_group @ radius) + 1 >= scores[tree.order[lo:hi]].max()
        best = ball_search.Best(20)
        scored = tree.search(i, best, list(range(len(docs))))
        assert best.rows == sorted((-int(s), False, k) for k, s in enumerate(scores) if s > 0)[:20]
        assert scored < len(docs) / 2
