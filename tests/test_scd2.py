import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows_of, same_rows
from strata.operators import scd2

COLUMNS = "k string, v string, w string, effective_from date, effective_to date, is_active boolean"
D1, D2, D3 = date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1)


@pytest.fixture(scope="module")
def current(spark):
    return spark.createDataFrame([
        ("same", "a", None, D1, None, True),
        ("changed", "a", "x", D1, None, True),
        ("to_null", "a", "x", D1, None, True),
        ("absent", "a", "x", D1, None, True),
        ("old", "z", "x", date(2023, 1, 1), D1, False),
        ("old", "a", "x", D1, None, True),
    ], COLUMNS)


@pytest.fixture(scope="module")
def incoming(spark):
    return spark.createDataFrame(
        [("same", "a", None), ("changed", "b", "x"), ("to_null", None, "x"), ("new", "n", None), ("old", "a", "x")],
        "k string, v string, w string")


def merge(current, incoming, day=D2):
    return scd2.scd2_merge(current, incoming, ["k"], ["v", "w"], day)


def test_merge(current, incoming):
    assert rows_of(merge(current, incoming)) == sorted([
        ("same", "a", None, D1, None, True),
        ("changed", "a", "x", D1, D2, False),
        ("changed", "b", "x", D2, None, True),
        ("to_null", "a", "x", D1, D2, False),
        ("to_null", None, "x", D2, None, True),
        ("absent", "a", "x", D1, None, True),
        ("new", "n", None, D2, None, True),
        ("old", "z", "x", date(2023, 1, 1), D1, False),
        ("old", "a", "x", D1, None, True),
    ], key=repr)


def test_merging_again_changes_nothing(current, incoming):
    once = merge(current, incoming)
    assert same_rows(once, merge(once, incoming, D3))
    assert same_rows(once, merge(once, incoming, D2))


def test_second_change_on_a_day_replaces_the_open_version(spark, current, incoming):
    once = merge(current, incoming)
    again = spark.createDataFrame([("changed", "c", "x")], "k string, v string, w string")
    rows = rows_of(merge(once, again).filter("k = 'changed'"))
    assert rows == [("changed", "a", "x", D1, D2, False), ("changed", "c", "x", D2, None, True)]


def test_actions(current, incoming):
    got = {r.action: r.n for r in scd2.scd2_actions(current, incoming, ["k"], ["v", "w"]).collect()}
    assert got == {"SAME": 2, "CHANGED": 2, "NEW": 1, "ABSENT": 1}


def test_random_batches_keep_the_invariants_and_match_brute_force(spark):
    rng = random.Random(3)
    state, history = {}, spark.createDataFrame([], COLUMNS)
    expected = []
    for step in range(4):
        day = D1 + timedelta(days=step)
        batch = {f"k{i}": rng.choice("ab") for i in rng.sample(range(30), 18)}
        for k, v in batch.items():
            if k in state and state[k][0] == v:
                continue
            if k in state:
                expected.append((k, state[k][0], None, state[k][1], day, False))
            state[k] = (v, day)
        df = spark.createDataFrame([(k, v, None) for k, v in batch.items()], "k string, v string, w string")
        merged = merge(history, df, day)
        history = spark.createDataFrame(merged.collect(), merged.schema)
    expected += [(k, v, None, since, None, True) for k, (v, since) in state.items()]
    assert rows_of(history) == sorted(expected, key=repr)
    assert scd2.scd2_violations(history, ["k"]).isEmpty()


def test_violations_are_found(spark):
    df = spark.createDataFrame([
        ("two_open", "a", None, D1, None, True), ("two_open", "b", None, D2, None, True),
        ("overlap", "a", None, D1, D3, False), ("overlap", "b", None, D2, None, True),
        ("none_open", "a", None, D1, D2, False),
        ("same_start", "a", None, D1, D2, False), ("same_start", "b", None, D1, None, True),
        ("empty", "a", None, D1, D1, False), ("empty", "b", None, D2, None, True),
        ("label", "a", None, D1, D2, True),
        ("fine", "a", None, D1, D2, False), ("fine", "b", None, D2, None, True),
    ], COLUMNS)
    got = {}
    for r in scd2.scd2_violations(df, ["k"]).collect():
        got.setdefault(r.k, set()).add(r.problem)
    assert got["two_open"] == {"NOT_ONE_ACTIVE", "OVERLAP"}
    assert got["overlap"] == {"OVERLAP"}
    assert got["none_open"] == {"NOT_ONE_ACTIVE"}
    assert got["same_start"] == {"SAME_START"}
    assert got["empty"] == {"EMPTY_SPAN"}
    assert got["label"] == {"FLAG_MISMATCH"}
    assert "fine" not in got


def test_as_of_lookup(spark):
    facts = spark.createDataFrame(
        [(1, "p", date(2023, 12, 31)), (2, "p", D1), (3, "p", D2), (4, "p", D3), (5, "q", D1)],
        "id int, p string, d date")
    versions = spark.createDataFrame(
        [("p", "one", D1, D2), ("p", "two", D2, None)],
        "p string, name string, effective_from date, effective_to date")
    got = {r.id: r.name for r in scd2.lookup_as_of(facts, versions, "p", "d", ["name"]).collect()}
    assert got == {1: None, 2: "one", 3: "two", 4: "two", 5: None}


@pytest.mark.parametrize("how", ["left", "inner"])
def test_as_of_lookup_against_a_range_join(spark, how):
    """A hot key, gaps, closed and open versions, months without a fact, NULL keys and days, repeated facts."""
    rng = random.Random(3)
    day = lambda: date(2023, 1, 1) + timedelta(days=rng.randint(0, 900))
    facts = [(k, rng.choice(["hot"] * 6 + ["a", "b", "none", None]), rng.choice([day(), day(), day(), None])) for k in range(800)]
    rows = []
    for key in ("hot", "a", "b", "unused"):
        cuts = sorted({day() - timedelta(days=200) for _ in range(12)})
        rows += [(key, f"{key}{i}", a, b) for i, (a, b) in enumerate(zip(cuts, [*cuts[1:], None])) if i % 5 != 2]
    facts = spark.createDataFrame(facts + facts[:30], "id int, p string, d date").repartition(5)
    versions = spark.createDataFrame(rows + [(None, "lost", D1, None)], "p string, name string, effective_from date, effective_to date")
    want = facts.alias("f").join(versions.alias("v"), F.expr(
        "f.p = v.p AND v.effective_from <= f.d AND (v.effective_to IS NULL OR f.d < v.effective_to)"), how).select("f.*", "name")
    got = scd2.lookup_as_of(facts, versions, "p", "d", ["name"], how)
    plan = plan_of(got)
    assert got.columns == ["id", "p", "d", "name"] and rows_of(got) == rows_of(want)
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    empty = facts.limit(0)
    assert scd2.lookup_as_of(empty, versions, "p", "d", ["name"], how).isEmpty()


def test_batches_in_any_order_give_one_history(spark):
    """Days out of order, against a replay of all values in order of their days."""
    rng = random.Random(11)
    days = [D1 + timedelta(days=i) for i in range(6)]
    batches = {day: {f"k{i}": rng.choice("ab") for i in rng.sample(range(12), 8)} for day in days}
    order = rng.sample(days, len(days))
    history = spark.createDataFrame([], COLUMNS)
    for day in order:
        df = spark.createDataFrame([(k, v, None) for k, v in batches[day].items()], "k string, v string, w string")
        merged = merge(history, df, day)
        history = spark.createDataFrame(merged.collect(), merged.schema)
        assert scd2.scd2_violations(history, ["k"]).isEmpty(), day
    rows = history.collect()
    for day in days:  # each batch's own value is valid on its day
        for k, v in batches[day].items():
            valid = [r.v for r in rows if r.k == k and r.effective_from <= day and (r.effective_to is None or day < r.effective_to)]
            assert valid == [v], (k, day)


def test_a_back_dated_change_keeps_the_newer_version(spark):
    def one(v):
        return spark.createDataFrame([("k", v, None)], "k string, v string, w string")

    history = spark.createDataFrame([], COLUMNS)
    for v, day in (("march", D3), ("january", D1), ("february", D2)):
        history = merge(history, one(v), day)
    assert rows_of(history) == sorted([
        ("k", "january", None, D1, D2, False), ("k", "february", None, D2, D3, False), ("k", "march", None, D3, None, True)], key=repr)
