"""Collocations by branch and bound."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_support import SF, clashing, docs_of, same_as_sql, shipped  # noqa: F401

from tallystone.llm import collocations
from tallystone.llm.words import named


def plain_collocations(rows, top, min_count=10, share=50):
    """rows: (lang, text). Every phrase of one to three words, counted."""
    counts, out = {}, set()
    for lang, text in rows:
        of = counts.setdefault("und" if lang is None else lang, Counter())
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                of.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        often = {p: c for p, c in f.items() if len(p) > 1 and c >= min_count}
        kept = []
        for p, a in often.items():
            longer = [c for q, c in often.items() if len(q) > len(p) and p in (q[:2], q[1:])]
            if any(100 * c >= share * a for c in longer):
                continue
            score, cut = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:cut]], f[p[cut:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return out


def found(frame):
    return {(r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in frame.collect()}


def test_collocations_equal_their_sql(shipped):  # noqa: F811
    same_as_sql(collocations.op12_collocations(shipped, SF), collocations.OP12_SQL)


def corpus(seed=2):
    rng = random.Random(seed)
    rows = []
    for lang in ("en", "de", None, "und"):
        words = [f"{(lang or 'u')[0]}{i}é" for i in range(40)]
        odds = [1 / (i + 1) for i in range(40)]
        fixed = ["new york city", "New York", "ad hoc", "of the x", "hot\tdog  stand"]
        for _ in range(120):
            text = " ".join(rng.choice([*rng.choices(words, odds, k=3), rng.choice(fixed)]) + rng.choice(["", "", "", ".", ",\n"]) for _ in range(60))
            rows.append((lang, text))
    return rows


EDGES = [("en", None), ("en", ""), ("en", " \t"), ("en", "..;"), ("xx", "a b c"), ("yy", "a b c " * 12), ("yy", "z" * 1_200_000 + " a b"), ("zz", ("w" * 70 + " " + "v" * 1_100_000 + " ") * 11), ("aa", "p q " * 100_000)]


@pytest.mark.parametrize("top", [1, 5, 40, 2000])
def test_collocations_equal_brute_force(shipped, top):  # noqa: F811
    rows = corpus() + (EDGES if top == 40 else [])
    frame = shipped.createDataFrame([(i, t, x, None, 0) for i, (x, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    frame = clashing(frame.repartition(4)).selectExpr("*", "1 as x", "2 as y", "3 as f")
    assert found(collocations.collocations(frame, top=top)) == plain_collocations(rows, top)


def test_ties_and_other_limits(shipped):  # noqa: F811
    rows = [("en", f"a{i} b{i} c{i % 3}.") for i in range(30)] * 4
    frame = shipped.createDataFrame([(t, x) for x, t in rows], "text string, lang string")
    for top, least, share in ((7, 4, 50), (3, 2, 100), (100, 4, 10)):
        assert found(collocations.collocations(frame, top=top, min_count=least, share=share)) == plain_collocations(rows, top, least, share)


def test_full_filters_change_nothing(shipped, monkeypatch):  # noqa: F811
    rows = corpus(9)
    frame = shipped.createDataFrame([(t, x) for x, t in rows], "text string, lang string")
    monkeypatch.setattr(collocations, "_filter", lambda marked: np.full(1 << (collocations.SLOT_BITS - 4), -1, np.int64).view(np.uint64))
    assert found(collocations.collocations(frame, top=5)) == plain_collocations(rows, 5)


def test_a_clash_of_names_takes_another_seed(shipped, monkeypatch):  # noqa: F811
    rows = corpus(4)
    frame = shipped.createDataFrame([(t, x) for x, t in rows], "text string, lang string")
    real = collocations._word_counts

    def clashing_at_first(docs, seed, min_count):
        from pyspark.sql import functions as F

        words = real(docs, seed, min_count)
        return words if seed else words.withColumn("clash", F.col("word") == "new")

    monkeypatch.setattr(collocations, "_word_counts", clashing_at_first)
    assert found(collocations.collocations(frame, top=9)) == plain_collocations(rows, 9)


def test_empty(shipped):  # noqa: F811
    assert collocations.collocations(docs_of(shipped, [])).collect() == []
    assert collocations.collocations(docs_of(shipped, ["a b", None])).collect() == []


def test_names_tell_words_apart():
    text = b"one two\none " + b"x" * 70 + b" " + b"y" * 1_100_000 + b" " + b"x" * 70 + b" two"
    names, lines, starts, ends = named(text, 10, 32, 0, b"en")
    words = [text[a:b] for a, b in zip(starts, ends, strict=True)]
    assert words == text.split() and lines.tolist() == [0, 0, 1, 1, 1, 1, 1]
    for i, w in enumerate(words):
        assert [v == w for v in words] == (names == names[i]).tolist()
    other, *_ = named(text, 10, 32, 1, b"en")
    third, *_ = named(text, 10, 32, 0, b"de")
    assert len({*names.tolist(), *other.tolist(), *third.tolist()}) == 3 * len(set(words))
