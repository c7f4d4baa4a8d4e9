"""The archive, the mix of sources, and decontamination."""

from __future__ import annotations

import base64
import hashlib
import random
import re
from collections import Counter

import pytest
from llm_support import SF, clashing, docs_of, same_as_sql, shipped  # noqa: F401
from pyspark.sql import functions as F

from tallystone.llm import decontaminate, mixing, warc

PAGES = "page_id long, url string, html string"


def test_archive_equals_its_sql(shipped):  # noqa: F811
    same_as_sql(warc.op3_warc(shipped, SF), warc.OP3_SQL)


def test_archive_round_trip_and_edges(shipped, tmp_path):  # noqa: F811
    pages = [(3, "http://a/\r\nWARC-Type: response", "<p>é</p>"), (1, "http://b/", "<p>é</p>"), (2, None, None), (5, "http://c/", ""), (None, "http://d/", "<p>é</p>"), (9, "u", "z" * 200_000), (9, "u", "z" * 200_000)]
    frame = shipped.createDataFrame(pages, PAGES).withColumn("digest", F.lit("clash"))
    warc.write_archive(frame, str(tmp_path / "a"))
    rows = warc.read_archive(shipped, str(tmp_path / "a")).collect()
    assert len(rows) == len(pages)
    by = {(r.page_id, r.record_type): r for r in rows}
    assert by[1, "response"].refers_to is None and by[3, "revisit"].refers_to == 1 and by[None, "revisit"].refers_to == 1
    assert by[2, "response"].payload_bytes == 0 and by[5, "revisit"].refers_to == 2
    assert {(9, "response"), (9, "revisit")} <= set(by)
    digest = base64.b32encode(hashlib.sha1("<p>é</p>".encode()).digest()).decode()
    assert by[3, "revisit"].payload_digest == digest and by[3, "revisit"].payload_bytes == 9
    assert shipped.read.parquet(str(tmp_path / "a/payloads")).count() == 3
    whole = warc.reconstruct(shipped, str(tmp_path / "a")).collect()
    assert Counter(bytes(r.payload).decode() for r in whole) == Counter(p[2] or "" for p in pages)
    for r in whole:
        assert bytes(r.bytes) == bytes(r.header) + bytes(r.payload) + b"\r\n\r\n"
        assert bytes(r.header).count(b"\r\nWARC-Type: ") == 1 and bytes(r.header).endswith(b"\r\n\r\n")


def test_small_payloads_are_responses(shipped, tmp_path):  # noqa: F811
    frame = shipped.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "long"), (4, "u", "long")], PAGES)
    warc.write_archive(frame, str(tmp_path / "a"), min_payload=3)
    rows = {r.page_id: r.record_type for r in warc.read_archive(shipped, str(tmp_path / "a")).collect()}
    assert rows == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_a_damaged_payload_is_no_record(shipped, tmp_path):  # noqa: F811
    frame = shipped.createDataFrame([(1, "u", "ab")], PAGES)
    warc.write_archive(frame, str(tmp_path / "a"))
    stored = shipped.read.parquet(str(tmp_path / "a/payloads")).withColumn("payload", F.lit("xx").cast("binary"))
    stored.write.parquet(str(tmp_path / "b/payloads"))
    shipped.read.parquet(str(tmp_path / "a/headers")).write.parquet(str(tmp_path / "b/headers"))
    with pytest.raises(Exception, match="does not match its digest"):
        warc.read_archive(shipped, str(tmp_path / "b")).collect()


def test_archive_of_no_pages(shipped, tmp_path):  # noqa: F811
    warc.write_archive(shipped.createDataFrame([], PAGES), str(tmp_path / "a"))
    assert warc.read_archive(shipped, str(tmp_path / "a")).count() == 0


def sources(spark, sizes):
    rows, i = [], 0
    for name, n in sizes.items():
        for _ in range(n):
            rows.append((i * 3, f"t{i}", "en", name, 2))
            i += 1
    random.Random(2).shuffle(rows)
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_mix_equals_its_sql(shipped):  # noqa: F811
    same_as_sql(mixing.op7_pfair_mix(shipped, SF), mixing.OP7_SQL)


def test_deviation_stays_under_one_block(shipped):  # noqa: F811
    sizes, weights = {"a": 200, "b": 90, "c": 64, None: 33}, {"a": 5, "b": 3, "c": 2}
    rows = mixing.mixed(sources(shipped, sizes), weights, block_rows=2, rows_per_range=7).collect()
    assert sorted(r.position for r in rows) == list(range(sum(sizes.values())))
    assert {r.row.source for r in rows} == set(sizes)
    total = 11
    slots = {r.slot: r.row.source for r in rows if r.on_target}
    assert sorted(slots) == list(range(len(slots))) and len(slots) % total == 0
    had = Counter()
    for slot in range(len(slots)):
        had[slots[slot]] += 1
        for name, q in {**weights, None: 1}.items():
            assert abs(had[name] - q * (slot + 1) / total) < 1
    assert all(r.release <= r.slot < r.deadline for r in rows)
    in_source = sorted(((r.row.source or "", r.position, r.row.doc_id) for r in rows))
    for (s, _, a), (t, _, b) in zip(in_source, in_source[1:], strict=False):
        assert s != t or a < b


def test_mix_edges(shipped):  # noqa: F811
    docs = clashing(docs_of(shipped, [(None, None), (None, "a"), (5, ""), (5, "b"), (-(2**62), "c"), (2**62, "d")]))
    rows = mixing.mixed(docs).collect()
    assert sorted(r.position for r in rows) == list(range(6))
    assert rows[0].row.name == "n"
    assert mixing.mixed(docs_of(shipped, [])).count() == 0


def test_mix_of_other_ids_and_of_an_outlier(shipped):  # noqa: F811
    """Ids of any type are numbered in their order; one far-off id, equal and null ids are spread."""
    plain = docs_of(shipped, [*[(i, "t") for i in range(300)], (2**60, "far"), *[(7, f"t{i}") for i in range(100)], *[(None, f"n{i}") for i in range(50)]])
    rows = mixing.mixed(plain, rows_per_range=40).collect()
    ids = [r.row.doc_id for r in sorted(rows, key=lambda r: r.position)]
    assert ids == [None] * 50 + sorted(i for i in ids if i is not None) and len(ids) == 451
    named = plain.selectExpr("concat('id-', lpad(cast(doc_id as string), 20, '0')) as doc_id", "text", "source")
    rows = mixing.mixed(named, rows_per_range=40).collect()
    ids = [r.row.doc_id for r in sorted(rows, key=lambda r: r.position)]
    assert ids == [None] * 50 + sorted(i for i in ids if i is not None) and sorted(r.position for r in rows) == list(range(451))
    clash = mixing.with_places(plain.selectExpr("*", "1 as position", "2 as Slot"))
    assert clash.columns == [*plain.columns, *mixing.MIX_COLUMNS] and clash.count() == 451


def test_mix_is_dataframe_functions_only(shipped):  # noqa: F811
    plan = mixing.mixed(sources(shipped, {"a": 5, "b": 4}))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian", plan)


ITEMS = [(1, "The quick brown fox jumps over the lazy dog and then sleeps."), (2, "Short one"), (3, None), (4, "..."), (5, "alpha beta gamma delta epsilon zeta eta theta iota kappa"), (2, "other short words"), (None, "null item here")]


def brute_hits(text, items):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    w, hit, found = words(text), set(), set()
    for item, t in items:
        v = words(t)
        n = min(10, len(v))
        for i in range(len(v) - n + 1 if n else 0):
            for j in range(len(w) - n + 1):
                if w[j : j + n] == v[i : i + n]:
                    hit.update(range(j, j + n))
                    found.add("" if item is None else str(item))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


TEXTS = [
    "x the QUICK brown fox, jumps over the lazy dog and! y",
    "brown fox jumps over the lazy dog and then sleeps short one short one",
    "short  ONE",
    "alpha beta gamma delta epsilon zeta eta theta iota",
    None,
    "",
    "... --- !!!",
    "other short words null item here" + " filler" * 30_000 + " short one",
    "short two",
]


def benchmark(spark, items=ITEMS):
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("size", [decontaminate.MAX_SLICE_BYTES, 40])
def test_decontamination_equals_brute_force(shipped, size):  # noqa: F811
    rows = decontaminate.report(docs_of(shipped, TEXTS), benchmark(shipped), max_slice_bytes=size).collect()
    for r in rows:
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == brute_hits(TEXTS[r.doc_id], ITEMS)


def test_decontamination_equals_its_sql(shipped):  # noqa: F811
    same_as_sql(decontaminate.op10_decontaminate(shipped, SF), decontaminate.OP10_SQL)


def test_removal_of_documents_and_spans(shipped):  # noqa: F811
    docs = clashing(docs_of(shipped, TEXTS))
    kept = decontaminate.drop_contaminated(docs, benchmark(shipped))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, t in enumerate(TEXTS) if not brute_hits(t, ITEMS)[4]]
    cut = {r.doc_id: r.text for r in decontaminate.cut_contaminated(docs, benchmark(shipped)).collect()}
    assert cut[0] == "x ! y" and cut[2] == "" and cut[4] is None and cut[8] == "short two"
    assert not any(brute_hits(t, ITEMS)[4] for t in cut.values())


def test_nothing_to_compare(shipped):  # noqa: F811
    assert decontaminate.report(docs_of(shipped, []), benchmark(shipped)).count() == 0
    rows = decontaminate.report(docs_of(shipped, TEXTS), benchmark(shipped, [])).collect()
    assert len(rows) == len(TEXTS) and not any(r.contaminated for r in rows)
