"""Quality rules, quarantine and promotion: truth table, brute force, skewed inputs."""

from __future__ import annotations

import random
from dataclasses import replace
from datetime import date, timedelta
from decimal import ROUND_HALF_UP, Decimal, InvalidOperation

import pytest
from conftest import CODES, NOW
from pyspark.sql import functions as F

from tallystone.operators.accounts import first_seen, latest_accounts
from tallystone.operators.classify import (
    REASON,
    SHIELDED,
    classify_accounts,
    classify_transactions,
    id_flags,
    repeat_rows,
)
from tallystone.operators.codes import require_codes, silver_codes
from tallystone.operators.promote import accepted, not_quarantined, promote_transactions
from tallystone.operators.quarantine import build_quarantine
from tallystone.schemas import bronze_schema
from tallystone.settings import COMMON_NULL_TOKENS, Settings

CFG = Settings(resolvable="latest")
FORCED = [
    CFG,
    replace(CFG, hot_rows=1, broadcast_rows=0),
    replace(CFG, hot_rows=3, broadcast_rows=0),
    replace(CFG, hot_rows=10**9, broadcast_rows=0),
]
DAY1, DAY2 = date(2024, 1, 1), date(2024, 1, 2)


@pytest.fixture(scope="module")
def codes(spark):
    rows = [(*c, "r", NOW, "transaction_codes.csv", DAY1) for c in CODES]
    return silver_codes(spark.createDataFrame(rows, bronze_schema("transaction_codes"))).cache()


def txn(id, account="A1", day="2024-01-01", amount="10", code="PURCH01", merchant="m", channel="ONLINE", on=DAY1):
    return (id, account, day, amount, code, merchant, channel, "r", NOW, f"transactions_{on}.csv", on)


def frame(spark, rows):
    return spark.createDataFrame(rows, bronze_schema("transactions"))


# case, rows as (row, reason, shielded)
NULL, AMOUNT, DUP, CODE, CHANNEL = (
    "NULL_REQUIRED_FIELD", "INVALID_AMOUNT", "DUPLICATE_TRANSACTION_ID",
    "INVALID_TRANSACTION_CODE", "INVALID_CHANNEL",
)
TRUTH = [
    (txn(None), NULL, False), (txn(None), NULL, False), (txn(""), NULL, False),
    (txn("N1", account=None), NULL, False), (txn("N2", account=""), NULL, False),
    (txn("N3", day=None), NULL, False), (txn("N4", day=""), NULL, False),
    (txn("N5", code=None), NULL, False), (txn("N6", code=""), NULL, False),
    (txn("N7", channel=None), NULL, False), (txn("N8", channel=""), NULL, False),
    (txn("N9", amount=None), NULL, False),
    (txn("M1", merchant=None), None, False),
    (txn("A1", amount="0"), AMOUNT, False), (txn("A2", amount="-3"), AMOUNT, False),
    (txn("A3", amount="abc"), AMOUNT, False), (txn("A4", amount="0.0004"), AMOUNT, False),
    (txn("A5", amount="1e3"), None, False), (txn("A6", amount=" 5 "), None, False),
    (txn("A7", amount="0.0005"), None, False), (txn("A8", amount="NaN"), AMOUNT, False),
    (txn("D1"), DUP, False), (txn("D1"), DUP, False),
    (txn("D2"), DUP, False), (txn("D2", on=DAY2), DUP, False),
    (txn("D3"), DUP, False), (txn("D3", amount="0"), AMOUNT, False),
    (txn("D4"), None, True), (txn("D4", channel=None), NULL, False),
    (txn("D5", code="NOPE"), DUP, False), (txn("D5", code="NOPE"), DUP, False),
    (txn("C1", code="NOPE"), CODE, False), (txn("C2", code="NOPE", channel="X"), CODE, False),
    (txn("H1", channel="DRIVE_THRU"), CHANNEL, False), (txn("H2", channel="online"), CHANNEL, False),
    (txn("U1", account="ghost"), None, False),
    (txn("S1", code="PAY01"), None, False), (txn("S2", code="PURCH01"), None, False),
]


def judged(df):
    names = bronze_schema("transactions").fieldNames()
    return sorted(repr((tuple(r[c] for c in names if c != "_ingested_at"), r[REASON], r[SHIELDED])) for r in df.collect())


def expected(cases):
    names = bronze_schema("transactions").fieldNames()
    skip = names.index("_ingested_at")
    return sorted(repr((row[:skip] + row[skip + 1:], reason, shield)) for row, reason, shield in cases)


@pytest.mark.parametrize("cfg", FORCED)
def test_truth_table(spark, codes, cfg):
    got = classify_transactions(frame(spark, [r for r, _, _ in TRUTH]), codes, cfg)
    assert judged(got) == expected(TRUTH)


def test_quarantine_and_promotion_of_the_truth_table(spark, codes):
    bronze = frame(spark, [r for r, _, _ in TRUTH])
    classified = classify_transactions(bronze, codes, CFG)
    accounts = account_frame(spark, [acct("A1"), acct("A2", status="PENDING")])
    judged_accounts = classify_accounts(accounts, CFG)
    per_row = build_quarantine(classified, judged_accounts, NOW, CFG)
    rejected = per_row.where("record_type = 'TRANSACTION'")
    silver = promote_transactions(accepted(classified), codes, first_seen(accounts), NOW, CFG)
    assert rejected.count() + silver.count() == len(TRUTH)
    shield = rejected.where(SHIELDED).collect()
    assert [(r["transaction_id"], r[REASON]) for r in shield] == [("D4", NULL)]
    assert per_row.where("record_type = 'ACCOUNT'").count() == 1

    per_id = build_quarantine(classified, judged_accounts, NOW, replace(CFG, quarantine="per_id"))
    reasons = {r["transaction_id"]: r[REASON] for r in per_id.where("record_type = 'TRANSACTION'").collect()}
    want = {}
    for row, reason, _ in TRUTH:
        if reason:
            want[row[0]] = min(reason, want.get(row[0], "~"))
    assert reasons == want and reasons["D3"] == DUP
    assert per_id.where("record_type = 'TRANSACTION'").count() == len(want)

    rows = {r["transaction_id"]: r for r in silver.collect()}
    assert set(rows) == {"M1", "A5", "A6", "A7", "U1", "S1", "S2"}
    assert rows["S1"]["_signed_amount"] == -10 and rows["S2"]["_signed_amount"] == 10
    assert not rows["U1"]["_is_resolvable"] and rows["S1"]["_is_resolvable"]
    assert [rows[i]["amount"] for i in ("A5", "A6", "A7")] == [1000, 5, Decimal("0.001")]
    by_table = not_quarantined(bronze, per_id, CFG)
    assert {r["transaction_id"] for r in by_table.collect()} == set(rows)


def test_rows_without_id_and_an_empty_quarantine(spark, codes):
    bronze = frame(spark, [txn(None), txn("G1")])
    classified = classify_transactions(bronze, codes, CFG)
    none = classify_accounts(account_frame(spark, [acct("A1")]), CFG)
    table = build_quarantine(classified, none, NOW, replace(CFG, quarantine="per_id"))
    strict = not_quarantined(bronze, table, CFG).collect()
    assert [r["transaction_id"] for r in strict] == ["G1"]
    lenient = not_quarantined(bronze, table, replace(CFG, null_ids="promote_if_clean")).collect()
    assert sorted(str(r["transaction_id"]) for r in lenient) == ["G1", "None"]
    more = frame(spark, [txn(None), txn("G1"), txn("B1", amount="0")])
    dirty = build_quarantine(classify_transactions(more, codes, CFG), none, NOW, CFG)
    kept = not_quarantined(more, dirty, replace(CFG, null_ids="promote_if_clean")).collect()
    assert [r["transaction_id"] for r in kept] == ["G1"]


# Plain-Python model: one set per rule, rows tested against the sets.


def money(text):
    try:
        value = Decimal(text.strip())
    except InvalidOperation:
        return None
    return value.quantize(Decimal("0.001"), ROUND_HALF_UP) if value.is_finite() else None


def model(rows):
    known = {c[0] for c in CODES}
    blank = [any(r[i] in (None, "") for i in (0, 1, 2, 4, 6)) or r[3] is None for r in rows]
    shield_ids = {r[0] or "" for r, b in zip(rows, blank) if b}
    ids = [r[0] for r in rows if r[0]]
    repeated = {i for i in set(ids) if ids.count(i) > 1}
    out = []
    for r, b in zip(rows, blank):
        branches = []
        if b:
            branches.append(NULL)
        open_ = r[0] is not None and r[0] not in shield_ids
        value = money(r[3]) if r[3] is not None else None
        good = value is not None and value > 0
        if open_ and r[3] is not None and not good:
            branches.append(AMOUNT)
        if open_ and good and r[0] in repeated:
            branches.append(DUP)
        if open_ and good and r[0] not in repeated and r[4] not in known:
            branches.append(CODE)
        if open_ and good and r[0] not in repeated and r[4] in known and r[6] not in ("ONLINE", "IN_STORE"):
            branches.append(CHANNEL)
        assert len(branches) <= 1
        out.append((r, branches[0] if branches else None, not b and r[0] in shield_ids))
    return out


def random_rows(seed, n, ids):
    pick = random.Random(seed)
    rows = []
    for _ in range(n):
        on = pick.choice([DAY1, DAY2])
        id = "HOT" if pick.random() < 0.33 else pick.choice([None, "", *[f"I{i}" for i in range(ids)]])
        rows.append(
            txn(
                id, pick.choice(["A1", "A2", "A1", ""]) if pick.random() < 0.2 else "A1", "2024-01-01",
                pick.choice(["1", "2.50", "0", "x", "-1", "3", "4", None if pick.random() < 0.1 else "5"]),
                pick.choice(["PURCH01", "PAY01", "PURCH01", "NOPE"]), None,
                pick.choice(["ONLINE", "IN_STORE", "ONLINE", "X"]) if pick.random() < 0.97 else None, on,
            )
        )
    return rows


@pytest.mark.parametrize("seed,ids,cfg", [(1, 500, FORCED[0]), (2, 300, FORCED[1]), (3, 700, FORCED[2]), (4, 60, FORCED[3])])
def test_rules_equal_the_plain_model(spark, codes, seed, ids, cfg):
    rows = random_rows(seed, 900, ids)
    got = classify_transactions(frame(spark, rows), codes, cfg)
    assert judged(got) == expected(model(rows))


def keep_first_model(rows):
    names = bronze_schema("transactions").fieldNames()
    rest = [i for i, c in enumerate(names) if c not in ("transaction_id", "_ingested_at", "_source_file")]
    known = {c[0] for c in CODES}

    def rank(r):
        return (r[8], r[9], *[(r[i] is not None, str(r[i]) if r[i] is not None else "") for i in rest])

    base = model(rows)
    ids = [r[0] for r in rows if r[0]]
    own = []
    for (r, reason, shield) in base:
        if reason in (NULL, AMOUNT) or shield:
            own.append(reason)
        elif r[4] not in known:
            own.append(CODE)
        elif r[6] not in ("ONLINE", "IN_STORE"):
            own.append(CHANNEL)
        else:
            own.append(None)
    out, taken = [], {}
    order = sorted(range(len(rows)), key=lambda i: rank(rows[i]))
    for i in order:
        r, _, shield = base[i]
        early = own[i] in (NULL, AMOUNT) or shield
        if not early and r[0] in taken:
            out.append((r, DUP, shield))
        else:
            if own[i] is None and not shield:
                taken[r[0]] = True
            out.append((r, own[i], shield))
    return out


@pytest.mark.parametrize("seed,cfg", [(5, FORCED[0]), (6, FORCED[1]), (7, FORCED[3])])
def test_keep_first_equals_the_plain_model(spark, codes, seed, cfg):
    rows = random_rows(seed, 700, 200)
    rows += [txn("SAME")] * 40
    got = classify_transactions(frame(spark, rows), codes, replace(cfg, duplicates="keep_first"))
    assert judged(got) == expected(keep_first_model(rows))
    assert got.where(f"transaction_id = 'SAME' and {REASON} is null").count() == 1


@pytest.mark.parametrize("hot_rows", [10**9, 5])
def test_keep_first_shuffles_rows_once(spark, codes, hot_rows):
    rows = random_rows(5, 700, 200) + [txn("SAME")] * 40
    name, before = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(name, "-1")
    try:
        got = classify_transactions(frame(spark, rows), codes, replace(CFG, duplicates="keep_first", hot_rows=hot_rows))
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert judged(got) == expected(keep_first_model(rows))
    finally:
        spark.conf.set(name, before)
    # The rows and what is known of their ids, once each; hot ids give their first rows besides.
    assert plan.count("Exchange hashpartitioning(transaction_id#") <= (2 if hot_rows > 5 else 3)


def test_repeat_rows_in_blocks(spark):
    df = spark.createDataFrame([("a", 1), ("b", 25), ("c", 10), ("d", 11)], "k string, n long")
    counts = {r["k"]: r["count"] for r in repeat_rows(df, "n", block=10).groupBy("k").count().collect()}
    assert counts == {"a": 1, "b": 25, "c": 10, "d": 11}


def acct(id, name="n", status="ACTIVE", balance="1", opened="2020-01-01", on=DAY1, at=NOW, limit="5"):
    return (id, name, status, limit, balance, opened, "1", "28", "r", at, f"accounts_{on}.csv", on)


def account_frame(spark, rows):
    return spark.createDataFrame(rows, bronze_schema("accounts"))


@pytest.mark.parametrize("cfg", FORCED)
def test_account_rules(spark, cfg):
    rows = [
        (acct("A1"), None), (acct("A2", name=None), None), (acct("A3", status=None), NULL),
        (acct("A4", status="PENDING"), "INVALID_ACCOUNT_STATUS"), (acct("A5", balance=None), NULL),
        (acct(None), NULL), (acct("", status="PENDING"), NULL), (acct("A6", opened=""), NULL),
        (acct("A6", status="PENDING"), None),  # shielded by its incomplete copy
        (acct("A7", status="active"), "INVALID_ACCOUNT_STATUS"), (acct("A7", status="active", on=DAY2), "INVALID_ACCOUNT_STATUS"),
        (acct("A8", limit=""), None),
    ]
    got = classify_accounts(account_frame(spark, [r for r, _ in rows]), cfg).collect()
    pairs = sorted((str(r["account_id"]), str(r["account_status"]), str(r[REASON])) for r in got)
    assert pairs == sorted((str(r[0]), str(r[2]), str(reason)) for r, reason in rows)


def test_latest_account_and_ties(spark):
    rows = [
        acct("A1", balance="1", at=NOW), acct("A1", balance="2", at=NOW + timedelta(hours=1)),
        acct("A2", balance="3", on=DAY1), acct("A2", balance="4", on=DAY2),
        acct("A3", balance="7.125", status="PENDING"), acct(None, balance="9"), acct(None, balance="8"),
    ]
    got = {r["account_id"]: r["current_balance"] for r in latest_accounts(account_frame(spark, rows), NOW).collect()}
    assert got == {"A1": 2, "A2": 4, "A3": Decimal("7.125"), None: 9}


def test_codes_latest_and_guard(spark):
    schema = bronze_schema("transaction_codes")
    later = NOW + timedelta(days=1)
    rows = [("P", "old", "DR", "PURCHASE", "true", "r1", NOW, "f", DAY1), ("P", "new", "DR", "PURCHASE", "true", "r2", later, "f", DAY2)]
    df = spark.createDataFrame(rows, schema)
    assert [r["description"] for r in silver_codes(df).collect()] == ["new"]
    assert require_codes(silver_codes(df)) == 1
    for bad in (df, df.limit(0), df.withColumn("transaction_code", F.lit(None).cast("string"))):
        with pytest.raises(ValueError):
            require_codes(silver_codes(bad, "distinct"))


def test_resolvable_by_date_and_latest(spark, codes):
    bronze = frame(spark, [txn("T1", account="L", on=DAY1), txn("T2", account="L", on=DAY2)])
    seen = first_seen(account_frame(spark, [acct("L", on=DAY2)]))
    rows = accepted(classify_transactions(bronze, codes, CFG))
    for base in FORCED[:2]:
        for mode, want in (("as_of_date", {"T1": False, "T2": True}), ("latest", {"T1": True, "T2": True})):
            got = promote_transactions(rows, codes, seen, NOW, replace(base, resolvable=mode)).collect()
            assert {r["transaction_id"]: r["_is_resolvable"] for r in got} == want


def test_null_tokens_are_opt_in(spark, codes):
    bronze = frame(spark, [txn("T1", channel="N/A"), txn("T2", amount="null")])
    plain = {r["transaction_id"]: r[REASON] for r in classify_transactions(bronze, codes, CFG).collect()}
    assert plain == {"T1": CHANNEL, "T2": AMOUNT}
    cfg = replace(CFG, null_tokens=COMMON_NULL_TOKENS)
    mapped = {r["transaction_id"]: r[REASON] for r in classify_transactions(bronze, codes, cfg).collect()}
    assert mapped == {"T1": NULL, "T2": NULL}


# Plans


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_keep_rows_in_place(spark, codes):
    df = classify_transactions(frame(spark, [r for r, _, _ in TRUTH]), codes, CFG)
    silver = promote_transactions(accepted(df), codes, first_seen(account_frame(spark, [acct("A1")])), NOW, CFG)
    plan = plan_of(silver)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


def test_hot_and_unmatched_rows_get_their_own_lane(spark, codes):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = frame(spark, [txn("HOT")] * 400 + [txn(None)] * 400 + [txn(f"T{i}") for i in range(20)])
        df = classify_transactions(rows, codes, replace(CFG, hot_rows=100))
        plan = plan_of(df)
        assert "SortMergeJoin" in plan
        assert "hashpartitioning(transaction_id" in plan and "_lane" in plan.split("hashpartitioning(transaction_id")[1][:60]
        sizes = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert max(r["count"] for r in sizes) < 300
        assert {r[0]: r[1] for r in df.groupBy(REASON).count().collect()} == {DUP: 400, NULL: 400, None: 20}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_id_flags_hold_only_repeated_ids(spark):
    rows = frame(spark, [txn("A"), txn("A"), txn("B"), txn(None), txn(None), txn("")])
    assert [r["transaction_id"] for r in id_flags(rows).collect()] == ["A"]


def test_shuffles_start_with_enough_partitions(spark):
    from tallystone.session import INITIAL_PARTITIONS, sized_shuffles

    for size, want in ((0, 8), (10 * 2**30, 160), (100 * 2**40, 1_638_400)):
        with sized_shuffles(spark, size) as got:
            assert got == want == int(spark.conf.get(INITIAL_PARTITIONS))
    assert spark.conf.get(INITIAL_PARTITIONS, None) is None


def test_an_id_with_a_third_of_the_rows_is_hot(spark):
    from tallystone.operators.promote import not_quarantined
    from tallystone.operators.skew import COPIES, hot_from

    rows = frame(spark, [txn("H")] * 300 + [txn(f"T{i}") for i in range(600)])
    flags = rows.groupBy("transaction_id").agg(F.count(F.lit(1)).alias(COPIES))
    assert hot_from(flags, CFG) <= 300
    assert flags.where(F.col(COPIES) >= hot_from(flags, CFG)).count() < int(spark.conf.get("spark.sql.shuffle.partitions"))
    # A quarantine with one row per id still shows how many rows the id has in Bronze.
    table = frame(spark, [txn("H"), txn("T5")]).withColumn("record_type", F.lit("TRANSACTION"))
    kept = not_quarantined(rows, table, replace(CFG, quarantine="per_id", broadcast_rows=0))
    assert kept.count() == 599
