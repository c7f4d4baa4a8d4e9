"""License templates as token automata."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from llm_support import SF, clashing, docs_of, same_as_sql, shipped  # noqa: F401

from tallystone.llm import license_scan
from tallystone.llm.license_scan import Automaton, Scanner, parsed


def words_of(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def ends(items, words, at):
    """All places where the items can end, if they begin at a place: tried one after the other."""
    if not items:
        return {at}
    head, rest = items[0], items[1:]
    if isinstance(head, bytes):
        return ends(rest, words, at + 1) if at < len(words) and words[at] == head.decode() else set()
    if isinstance(head, list):
        return ends(head + rest, words, at) | ends(rest, words, at)
    return set().union(*(ends(rest, words, at + n) for n in range(head.least, head.most + 1) if at + n <= len(words)))


def plain_matches(templates, words):
    best = {}
    for at in range(len(words)):
        longest = {}
        for label, t in templates:
            for end in ends(parsed(t), words, at):
                longest[label] = max(longest.get(label, 0), end)
        for label, end in longest.items():
            spans = best.setdefault(label, [])
            if not spans or spans[-1][1] <= at:
                spans.append((at, end))
    return sorted(((x, a, b) for x, spans in best.items() for a, b in spans), key=lambda x: (x[1], x[2], x[0]))


def test_licenses_equal_their_sql(shipped):  # noqa: F811
    same_as_sql(license_scan.op13_license_scan(shipped, SF), license_scan.OP13_SQL)


TOY = [
    ("a", "x y [[z]] w"),
    ("a", "x y z z"),
    ("b", "{{n:1-2}} x [[y [[z {{n:0-3}}]]]] w"),
    ("c", "[[x]] [[y]] z [[x]]"),
    ("d", "x {{n:0-4}} x"),
    ("e", "w [[{{n:2-3}}]]"),
]


def test_automaton_equals_trying_out_all_ways():
    rng = random.Random(5)
    machine = Automaton(TOY)
    for _ in range(400):
        words = rng.choices("xyzwq", k=rng.randint(0, 25))
        ids = np.array([machine.tokens.get(w.encode(), 0) for w in words], np.int32)
        assert machine.matches(ids) == plain_matches(TOY, words), words


def test_forgotten_states_are_found_again(monkeypatch):
    monkeypatch.setattr(license_scan, "MAX_STATES", 3)
    test_automaton_equals_trying_out_all_ways()


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
// of this software and associated documentation files (the "Tool"), to deal in the
// Tool without restriction, including without limitation the rights to use, copy, modify,
// merge, publish, distribute, sublicense, and/or sell copies of the Tool, and to permit
// persons to whom the Tool is furnished to do so, subject to the following conditions:
* The above copyright notice and this permission notice shall be included in all copies
or substantial portions of the Tool."""


@pytest.mark.parametrize(
    ("text", "base", "accepted"),
    [
        (MIT, [], [("mit-text", 0, len(words_of(MIT)))]),
        (MIT.replace("free of charge", "for a small charge"), [], []),
        (MIT.replace("shall be", "(including the next paragraph) shall be"), [], [("mit-text", 0, len(words_of(MIT)) + 4)]),
        ("Licensed under CC BY-NC 4.0.", [("cc-by", 2, 4)], [("cc-by", 0, 4), ("cc-by-nc", 0, 7)]),
        ("This work is licensed under the GNU\nGeneral Public  LICENSE, version 3.", [("gpl", 6, 10)], [("gpl-declared", 0, 12)]),
        ("Licensed under the Apache License, Version 2.0", [("apache", 3, 5)], [("apache-2.0", 0, 8)]),
        ("the Apache Licenses", [], []),
        ("Released under the MIT License. The mit license!", [("mit", 3, 5), ("mit", 6, 8)], [("mit-declared", 0, 5)]),
    ],
)
def test_spans(text, base, accepted):
    n, phrases, spans = Scanner(license_scan.TEMPLATES, license_scan.PHRASES).scan(text.encode())
    assert n == len(words_of(text)) and phrases == base and spans == accepted


def test_edges(shipped):  # noqa: F811
    texts = [None, "", " .,;", "é MIT License", "mit " * 300_000 + "license", "x" * 1_500_000 + " cc by", "cc by cc by", "cc by cc by", "THE LAW: gnu general public license" * 3]
    frame = clashing(docs_of(shipped, [*texts, (None, "mit license")]))
    rows = license_scan.scan(frame).collect()
    assert [f for f in rows[0].row.asDict()] == frame.columns
    found = {r.doc_id: r for r in license_scan.report(frame).collect()}
    for i, t in enumerate(texts):
        words = words_of(t)
        places = [(at, label) for p, label in license_scan.PHRASES.items() for at in range(len(words)) if words[at : at + len(p.split())] == p.split()]
        r = found[i]
        assert (r.n_words, r.n_base) == (len(words), len(places))
        assert (r.first_word, r.last_word) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in places})) and r.score == (0.5 if places else 0.0)
    assert found[None].labels == "mit"
    assert license_scan.report(docs_of(shipped, [])).collect() == []


@pytest.mark.parametrize("bad", ["[[x]]", "x [[y", "x ]] y", "x {{n:3-2}}", "{{n:1-2}}"])
def test_bad_templates_are_refused(bad):
    with pytest.raises(ValueError):
        Automaton([("a", bad)])
