"""License notices, found by templates that are compiled to a token automaton.

A template is wording with two kinds of markup: [[...]] is an optional region, which may hold any markup
again, and {{name:0-20}} a replaceable region of that many words. Everything else is mandatory wording
and must match word for word; case, punctuation and line breaks don't count. All templates become one
nondeterministic automaton over words, with a state before each word and empty steps around optional
regions; it is made deterministic while it runs, state by state, as far as the texts at hand need. A
template is accepted over a span of words when the automaton gets from its start to its end over them.
Per label the leftmost, longest, non-overlapping spans are reported.

Beside the templates there are phrases: plain places where some words stand one after the other.

Documents are judged one by one in their own tasks, and nothing is shuffled. A text is only taken apart
if it holds, as plain bytes, the rarest-looking mandatory word of some template or phrase; that is a
necessary condition of every finding. Memory: a text and its words as numbers; the automaton's
remembered states are dropped when there are more than MAX_STATES.

Defined cases: words are maximal runs of 0-9, a-z (A-Z lower-cased) and non-ASCII characters. Null or
wordless texts have no words and no findings, repeated rows are judged alike, an empty table gives an
empty result, other columns are carried along under any name, and a template without mandatory words
is refused.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystone.llm.common import WORD_TABLE, lean, packed, read, text_of, with_columns_of
from tallystone.llm.words import pieces

MAX_STATES = 20_000

#: Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: (label, template). Names of the replaceable regions are free; the wording is that of the licenses.
TEMPLATES = [
    ("mit-declared", "[[this {{work:0-2}} is]] {{how:1-1}} under [[the terms of]] the mit license"),
    ("mit-text", """
        permission is hereby granted free of charge to any person obtaining a copy of this software and
        associated documentation files the {{what:1-2}} to deal in the {{what:1-2}} without restriction
        including without limitation the rights to use copy modify merge publish distribute sublicense and
        or sell copies of the {{what:1-2}} and to permit persons to whom the {{what:1-2}} is furnished to do
        so subject to the following conditions
        the above copyright notice and this permission notice [[including the next paragraph]] shall be
        included in all copies or substantial portions of the {{what:1-2}}
        [[the {{what:1-2}} is provided as is without warranty of any kind express or implied including but
        not limited to the warranties of merchantability fitness for a particular purpose and noninfringement
        in no event shall the {{who:1-20}} be liable for any claim damages or other liability whether in an
        action of contract tort or otherwise arising from out of or in connection with the {{what:1-2}} or
        the use or other dealings in the {{what:1-2}}]]"""),
    ("isc-text", """
        permission to use copy modify and [[or]] distribute this software for any purpose with or without fee
        is hereby granted provided that the above copyright notice and this permission notice appear in all
        copies"""),
    ("bsd-text", """
        redistribution and use in source and binary forms with or without modification are permitted provided
        that the following conditions are met [[1]] redistributions of source code must retain the above
        copyright notice this list of conditions and the following disclaimer [[2]] redistributions in binary
        form must reproduce the above copyright notice this list of conditions and the following disclaimer in
        the documentation and or other materials provided with the distribution
        [[ [[3]] neither the name of {{who:1-20}} nor the names of its contributors may be used to endorse or
        promote products derived from this software without specific prior written permission]]"""),
    ("zlib-text", """
        permission is granted to anyone to use this software for any purpose including commercial applications
        and to alter it and redistribute it freely subject to the following restrictions"""),
    ("unlicense-text", "this is free and unencumbered software released into the public domain"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0-notice", """
        licensed under the apache license version 2 0 [[the license]] you may not use this file except in
        compliance with the license you may obtain a copy of the license at [[{{where:1-8}}]]
        [[unless required by applicable law or agreed to in writing software distributed under the license is
        distributed on an as is basis without warranties or conditions of any kind either express or implied]]"""),
    ("gpl-declared", """
        [[this {{work:0-2}} is]] {{how:1-1}} under [[the terms of]] the gnu general public license
        [[version {{version:1-2}}]]"""),
    ("gpl-notice", """
        is free software you can redistribute it and or modify it under the terms of the gnu
        [[{{kind:1-1}}]] general public license as published by the free software foundation either version
        {{version:1-2}} of the license or [[at your option]] any later version"""),
    ("lgpl-declared", "{{how:1-1}} under [[the terms of]] the gnu lesser general public license"),
    ("mpl-2.0-notice", """
        this source code form is subject to the terms of the mozilla public license v 2 0 [[if a copy of the
        mpl was not distributed with this file you can obtain one at {{where:1-6}}]]"""),
    ("cc-by", "{{how:1-1}} under [[a]] [[the]] [[creative commons]] cc by [[{{version:1-1}} 0]]"),
    ("cc-by-nc", "{{how:1-1}} under [[a]] [[the]] [[creative commons]] cc by nc [[{{version:1-1}} 0]]"),
    ("cc-by-nc-sa", "{{how:1-1}} under [[a]] [[the]] [[creative commons]] cc by nc sa [[{{version:1-1}} 0]]"),
    ("cc-by-nc-nd", "{{how:1-1}} under [[a]] [[the]] [[creative commons]] cc by nc nd [[{{version:1-1}} 0]]"),
    ("cc-by-sa", "{{how:1-1}} under [[a]] [[the]] [[creative commons]] cc by sa [[{{version:1-1}} 0]]"),
    ("cc-by-nd", "{{how:1-1}} under [[a]] [[the]] [[creative commons]] cc by nd [[{{version:1-1}} 0]]"),
    ("cc0", "to the extent possible under law {{who:1-12}} has waived all copyright and related or neighboring rights to"),
]


@dataclass(frozen=True)
class Words:
    """Between least and most words of any kind."""

    name: str
    least: int
    most: int


def parsed(template: str) -> list:
    """Words as bytes, replaceable regions as Words, optional regions as lists."""
    stack: list[list] = [[]]
    for mark, region, plain in re.findall(r"(\[\[|\]\])|\{\{([^{}]*)\}\}|((?:(?!\[\[|\]\]|\{\{).)+)", template, re.DOTALL):
        if mark == "[[":
            stack.append([])
        elif mark == "]]":
            if len(stack) == 1:
                raise ValueError("an optional region ends that has not begun")
            inner = stack.pop()
            stack[-1].append(inner)
        elif region:
            name, span = region.split(":")
            least, most = map(int, span.split("-"))
            if not 0 <= least <= most:
                raise ValueError(f"a region of {span} words")
            stack[-1].append(Words(name, least, most))
        else:
            stack[-1] += plain.encode().translate(WORD_TABLE).split()
    if len(stack) > 1:
        raise ValueError("an optional region does not end")
    return stack[0]


def _key(items: list) -> str:
    """The longest mandatory word of a parsed template."""
    mandatory = [x for x in items if isinstance(x, bytes)]
    if not mandatory:
        raise ValueError("a template without mandatory words")
    return max(mandatory, key=len).decode()


class Automaton:
    """All templates at once. States are numbers; a set of them is a state of the deterministic one."""

    OTHER = 0

    def __init__(self, templates: list[tuple[str, str]]):
        self.labels = [label for label, _ in templates]
        self.tokens: dict[bytes, int] = {}
        self.empty: list[list[int]] = []
        self.word: list[tuple[int, int] | None] = []  # (token, next)
        self.any: list[int | None] = []
        self.accepts: dict[int, int] = {}
        self.keys: list[bytes] = []  # one mandatory word of each template
        starts = []
        for i, (label, template) in enumerate(templates):
            items = parsed(template)
            self.keys.append(_key(items).encode())
            start = self._state()
            starts.append(start)
            self.accepts[self._sequence(start, items)] = i
        self._forget()
        self.first = self._closed(starts)

    def _state(self) -> int:
        self.empty.append([])
        self.word.append(None)
        self.any.append(None)
        return len(self.empty) - 1

    def _sequence(self, at: int, items: list) -> int:
        for item in items:
            if isinstance(item, bytes):
                after = self._state()
                self.word[at] = (self.tokens.setdefault(item, len(self.tokens) + 1), after)
                at = after
            elif isinstance(item, Words):
                skips = []
                for i in range(item.most):
                    if i >= item.least:
                        skips.append(at)
                    after = self._state()
                    self.any[at] = after
                    at = after
                for s in skips:
                    self.empty[s].append(at)
            else:
                # A state of its own behind the region, so that what follows cannot be entered twice.
                inside, after = self._state(), self._state()
                self.empty[at] += [inside, after]
                self.empty[self._sequence(inside, item)].append(after)
                at = after
            if self.word[at] or self.any[at] is not None:
                raise AssertionError("a state is used twice")
        return at

    def _forget(self) -> None:
        self.sets: list[frozenset[int]] = []
        self.number: dict[frozenset[int], int] = {}
        self.accepted: list[tuple[int, ...]] = []
        self.steps: list[dict[int, int]] = []

    def _closed(self, states) -> int:
        """The deterministic state of these states and all that empty steps reach; -1 for none."""
        seen, todo = set(states), list(states)
        while todo:
            for s in self.empty[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        if not seen:
            return -1
        key = frozenset(seen)
        if key not in self.number:
            self.number[key] = len(self.sets)
            self.sets.append(key)
            self.accepted.append(tuple(sorted(self.accepts[s] for s in key if s in self.accepts)))
            self.steps.append({})
        return self.number[key]

    def step(self, state: int, token: int) -> int:
        known = self.steps[state].get(token)
        if known is None:
            after = []
            for s in self.sets[state]:
                if self.word[s] and self.word[s][0] == token:
                    after.append(self.word[s][1])
                if self.any[s] is not None:
                    after.append(self.any[s])
            known = self.steps[state][token] = self._closed(after)
        return known

    def _leads(self) -> set[tuple[int, int]]:
        """(token, place): the first plain words of each way into a template, with how many words before."""
        out, seen = set(), set()
        todo = [(s, 0) for s in self.sets[self.first]]
        while todo:
            s, place = todo.pop()
            if (s, place) in seen:
                continue
            seen.add((s, place))
            if self.word[s]:
                out.add((self.word[s][0], place))
            todo += [(x, place) for x in self.empty[s]]
            if self.any[s] is not None:
                todo.append((self.any[s], place + 1))
        return out

    def starts(self, ids: np.ndarray) -> list[int]:
        """Places where a span can begin: a first plain word of a template stands at its distance."""
        found = [np.flatnonzero(ids == t) - place for t, place in self._leads()]
        found = np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)
        return found[found >= 0].tolist()

    def matches(self, ids: np.ndarray) -> list[tuple[str, int, int]]:
        """(label, first word, end) of the accepted spans, by place."""
        best: dict[str, list[tuple[int, int]]] = {}
        n = len(ids)
        for at in self.starts(ids):
            if len(self.sets) > MAX_STATES:
                first = self.sets[self.first]
                self._forget()
                self.first = self._closed(first)
            state, j = self.first, at
            last: dict[str, int] = {}
            while True:
                for t in self.accepted[state]:
                    last[self.labels[t]] = j
                if j == n:
                    break
                state = self.step(state, int(ids[j]))
                if state < 0:
                    break
                j += 1
            for label, end in last.items():
                spans = best.setdefault(label, [])
                if not spans or spans[-1][1] <= at:
                    spans.append((at, end))
        return sorted(((label, a, b) for label, spans in best.items() for a, b in spans), key=lambda x: (x[1], x[2], x[0]))


class Scanner:
    def __init__(self, templates: list[tuple[str, str]], phrases: dict[str, str]):
        self.automaton = Automaton(templates)
        self.phrases = [(tuple(p.encode().translate(WORD_TABLE).split()), label) for p, label in phrases.items()]
        if not all(words for words, _ in self.phrases):
            raise ValueError("a phrase without words")
        self.tokens = dict(self.automaton.tokens)
        for words, _ in self.phrases:
            for w in words:
                self.tokens.setdefault(w, len(self.tokens) + 1)
        self.keys = sorted({*self.automaton.keys, *(max(words, key=len) for words, _ in self.phrases)})

    def scan(self, text: bytes) -> tuple[int, list[tuple[str, int, int]], list[tuple[str, int, int]]]:
        """Words; places of phrases and accepted templates as (label, first word, end)."""
        flat = text.translate(WORD_TABLE)
        if not any(k in flat for k in self.keys):
            inside = np.frombuffer(flat, np.uint8) != 32
            return int(np.count_nonzero(inside[1:] & ~inside[:-1]) + (len(inside) > 0 and inside[0])), [], []
        get = self.tokens.get
        ids = np.concatenate([np.array([get(w, 0) for w in piece.split()], np.int32) for piece in pieces(flat, b" ")])
        base = []
        for words, label in self.phrases:
            wanted = [self.tokens[w] for w in words]
            at = np.flatnonzero(ids[: len(ids) - len(wanted) + 1] == wanted[0]) if len(ids) >= len(wanted) else np.empty(0, np.int64)
            for i, t in enumerate(wanted[1:], 1):
                at = at[ids[at + i] == t]
            base += [(label, int(a), int(a) + len(words)) for a in at]
        return len(ids), sorted(base, key=lambda x: x[1:]), self.automaton.matches(ids)


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, phrases: dict[str, str] | None = None, text_column: str = "text") -> DataFrame:
    """(row, n_words, base, accepted): all columns of docs in row, places of phrases and spans of
    accepted templates as arrays of (label, first, end), in words."""
    templates = TEMPLATES if templates is None else templates
    phrases = PHRASES if phrases is None else phrases
    Scanner(templates, phrases)  # what can't be compiled fails here
    places = "array<struct<label:string,first:long,end:long>>"
    schema = with_columns_of(docs, ("n_words", "long"), ("base", places), ("accepted", places))

    def run(batches):
        import pyarrow as pa

        scanner = Scanner(templates, phrases)
        kind = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            rows = [scanner.scan(text) for text in text_of(batch.column(0), text_column)]
            spans = [[[{"label": x, "first": a, "end": b} for x, a, b in r[i]] for r in rows] for i in (1, 2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r[0] for r in rows], pa.int64()), pa.array(spans[0], kind), pa.array(spans[1], kind)],
                names=["row", "n_words", "base", "accepted"],
            )

    return packed(docs).mapInArrow(lean(run), schema)


def report(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """Per document: words, places of phrases, labels; score 1 if a template is accepted, 0.5 if there
    are phrases only, else 0."""
    found = scan(docs.select(id_column, text_column), text_column=text_column, **options)
    labels = F.array_join(F.array_sort(F.array_distinct(F.concat("base.label", "accepted.label"))), ",")
    return found.select(
        F.col(f"row.`{id_column}`").alias(id_column),
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.first").alias("first_word"),
        F.array_max("base.first").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base.label")), ",").alias("base_labels"),
        labels.alias("labels"),
        F.when(F.size("accepted") > 0, 1.0).when(F.size("base") > 0, 0.5).otherwise(0.0).alias("score"),
    )


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(read(spark, sf_dir, "documents", "doc_id", "text"))


def as_pattern(items: list) -> str:
    """The regular expression of a parsed template, over words that each follow a blank."""
    out = ""
    for item in items:
        if isinstance(item, bytes):
            out += " " + re.escape(item.decode())
        elif isinstance(item, Words):
            out += f"(?: [^ ]+){{{item.least},{item.most}}}"
        else:
            out += f"(?:{as_pattern(item)})?"
    return out


def sql_of(templates: list[tuple[str, str]], phrases: dict[str, str]) -> str:
    """The report in SQL: words by pattern, phrases by place, templates as regular expressions."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    base = " UNION ALL ".join(
        f"SELECT rid, '{label}' AS label, unnest(list_filter(range(0, len(w)), lambda i: list_slice(w, i + 1, i + {len(p.split())}) = {p.split()!r})) AS pos FROM d WHERE contains(flat, ' {p}')"
        for p, label in phrases.items()
    )
    accepted = " UNION ALL ".join(f"SELECT rid, '{label}' AS label FROM d WHERE contains(flat, '{_key(parsed(t))}') AND regexp_matches(flat, '{as_pattern(parsed(t))}(?: |$)')" for label, t in templates)
    return rf"""
WITH w AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
d AS (SELECT *, CASE WHEN len(w) > 0 THEN ' ' || array_to_string(w, ' ') ELSE '' END AS flat FROM w),
base AS ({base}),
accepted AS ({accepted}),
places AS (SELECT rid, count(*) AS n, min(pos) AS a, max(pos) AS z, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM base GROUP BY rid),
found AS (SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT rid, label FROM base UNION ALL SELECT * FROM accepted) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, a::BIGINT AS first_word, z::BIGINT AS last_word,
       coalesce(places.labels, '') AS base_labels, coalesce(found.labels, '') AS labels,
       CASE WHEN rid IN (SELECT rid FROM accepted) THEN 1.0 WHEN n > 0 THEN 0.5 ELSE 0.0 END::DOUBLE AS score
FROM d LEFT JOIN places USING (rid) LEFT JOIN found USING (rid)
"""


OP13_SQL = sql_of(TEMPLATES, PHRASES)
