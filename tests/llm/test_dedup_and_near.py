"""Exact dedup and the similarity join."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

from llm_support import SF, clashing, docs_of, same_as_sql, shipped  # noqa: F401

from tallystone.llm import exact_dedup, near_join
from tallystone.llm.common import WORD_TABLE, components, word_hashes

SPACE = re.compile(r"[\x20\x09-\x0D]")


def brute_exact(texts):
    groups = defaultdict(list)
    for i, t in texts:
        groups[SPACE.sub("", t or "")].append((-len(t or ""), i is None, i))
    return {k: sorted(v, key=lambda x: (x[0], x[1], x[2] or 0)) for k, v in groups.items()}


def test_exact_groups_equal_brute_force(shipped):  # noqa: F811
    rng = random.Random(1)
    parts = ["ab", "cde", "é", "f g", "\t", "hhhh", ""]
    texts = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(12)))) for i in range(150)]
    texts += [(200, None), (201, ""), (202, " \n"), (203, "x" * 5000), (204, "x" * 5000 + " "), (205, "x" * 4999), (206, " x"), (207, "x")]
    docs = docs_of(shipped, texts).repartition(4)
    want = brute_exact(texts)
    got = {r.doc_id: r for r in exact_dedup.exact_groups(docs, block_bytes=4).collect()}
    assert len(got) == len(texts)
    for i, t in texts:
        flat = SPACE.sub("", t or "")
        group = want[flat]
        row = got[i]
        assert (row.keep_id, row.group_size, row.kept) == (group[0][2], len(group), group[0][2] == i)
        assert row.text_sha256 == hashlib.sha256(flat.encode()).hexdigest()


def test_exact_repeated_rows_null_ids_and_clashes(shipped):  # noqa: F811
    texts = [(1, "a b"), (1, "a b"), (None, "ab "), (2, "q"), (1, "z"), (None, "z")]
    docs = clashing(docs_of(shipped, texts))
    rows = exact_dedup.exact_groups(docs).collect()
    assert len(rows) == 6 and sum(r.kept for r in rows) == 3
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1, r.text, r.rid, r.name) for r in kept.collect()) == [(1, "a b", 7, "n"), (1, "z", 7, "n"), (2, "q", 7, "n")]


def test_exact_empty_table(shipped):  # noqa: F811
    docs = docs_of(shipped, [])
    assert exact_dedup.exact_groups(docs).count() == 0
    assert exact_dedup.drop_copies(docs).count() == 0


def test_exact_query_equals_its_sql(shipped):  # noqa: F811
    same_as_sql(exact_dedup.op2_exact_dedup(shipped, SF), exact_dedup.OP2_SQL)


def test_word_hashes_follow_the_words():
    text = "Ab, cd\nAB ab é9x É".encode()
    h = word_hashes(text).tolist()
    words = text.translate(WORD_TABLE).split()
    assert len(h) == len(words) and (h[0] == h[2] == h[3]) and len(set(h)) == len(set(words))
    long = b"word " * 500_000
    assert len(word_hashes(long)) == 500_000 and len(set(word_hashes(long).tolist())) == 1
    endless = b"x" * 3_000_000
    assert len(word_hashes(endless + b" y " + endless)) == 3


def test_components(shipped):  # noqa: F811
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 50), (51, 100), (7, 7)]
    found = {r.id: r.root for r in components(shipped.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert all(found[i] == 0 for i in range(41)) and found[50] == found[51] == found[100] == 50


def words_of(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute_near(texts, threshold=0.8):
    sets = []
    for _, t in texts:
        w = words_of(t)
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    n = len(texts)
    linked = [[j for j in range(n) if j != i and sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-9] for i in range(n)]
    out = {}
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for k in linked[todo.pop()]:
                if k not in seen:
                    seen.add(k)
                    todo.append(k)
        out[texts[i][0]] = (min(texts[k][0] for k in seen), len(linked[i]))
    return out


def near_texts():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(6):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(30, 120))]
        for _ in range(12):
            copy = list(base)
            for _ in range(rng.randrange(0, 5)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    texts += ["a b c", "A, b; c!", "a b", "", None, "  ", "one", texts[0].upper(), texts[0]]
    texts += ["very " * 3000 + " ".join(vocabulary), " ".join(vocabulary) * 40]
    return list(enumerate(texts))


def test_near_classes_equal_brute_force(shipped):  # noqa: F811
    texts = near_texts()
    want = brute_near(texts)
    got = {r.doc_id: (r.class_id, r.n_links) for r in near_join.near_classes(docs_of(shipped, texts).repartition(3), chunk=200).collect()}
    assert got == want


def test_near_copies_leave_one_of_each_class(shipped):  # noqa: F811
    texts = near_texts()
    want = brute_near(texts)
    docs = clashing(docs_of(shipped, texts))
    kept = near_join.drop_near_copies(docs)
    assert kept.columns == docs.columns
    classes = [want[r.doc_id][0] for r in kept.collect()]
    assert sorted(classes) == sorted({c for c, _ in want.values()})


def test_near_repeated_rows_null_ids_and_empty_table(shipped):  # noqa: F811
    docs = docs_of(shipped, [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, "x"), (2, "y z")])
    rows = near_join.near_classes(docs).collect()
    assert sorted((r.class_id or -1, r.n_links) for r in rows) == [(-1, 0), (1, 2), (1, 2), (1, 2), (2, 0)]
    assert near_join.drop_near_copies(docs).count() == 3
    assert near_join.near_classes(docs_of(shipped, [])).count() == 0


def test_near_query_equals_its_sql(shipped):  # noqa: F811
    same_as_sql(near_join.op4_near_join(shipped, SF), near_join.OP4_SQL)


def test_prefix_is_shortened_to_the_target():
    n = near_join.prefix_length(0.8, 40, 8, 0.99999)
    assert 1 - (1 - 0.8**n) ** 40 >= 0.99999 > 1 - (1 - 0.8 ** (n + 1)) ** 40
    assert near_join.prefix_length(0.99, 40, 8, 0.99999) == 8


def test_large_components_are_cut_into_chunks(shipped):  # noqa: F811
    rng = random.Random(9)
    base = [f"v{i}" for i in range(60)]
    texts = []
    for i in range(120):
        copy = list(base)
        copy[rng.randrange(60)] = f"x{i}"
        texts.append((i, " ".join(copy)))
    want = brute_near(texts)
    rows = near_join.near_classes(docs_of(shipped, texts), chunk=500).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in rows} == want
