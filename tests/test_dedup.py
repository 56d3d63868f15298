import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, same_rows
from strata.operators import dedup

KEYS = ["k", "f"]


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key, and a third of those are copies of one row."""
    rng = random.Random(7)
    rows = [("hot", "d", 5, "copy")] * 400
    rows += [("hot", "d", rng.randrange(50), f"v{rng.randrange(30)}") for _ in range(800)]
    rows += [(f"k{rng.randrange(900)}", "d", rng.randrange(5), f"v{rng.randrange(3)}") for _ in range(2400)]
    rows += [("nulls", "d", None, None), ("nulls", "d", None, "v"), ("nulls", "d", 1, None)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "k string, f string, ts int, v string").repartition(6)


def brute_force(rows, latest):
    """The winner per key under (ts, k, f, v); NULL is lowest in both directions."""
    def rank(r):
        return tuple((x is not None, x) if x is not None else (False, 0 if i == 0 else "")
                     for i, x in enumerate((r[2], r[0], r[1], r[3])))

    best = {}
    for r in rows:
        key = r[:2]
        if key not in best or (rank(r) > rank(best[key]) if latest else rank(r) < rank(best[key])):
            best[key] = r
    return Counter(best.values())


@pytest.mark.parametrize("keep", ["first", "latest"])
def test_split_is_whole_and_matches_brute_force(skewed, keep):
    rows = [tuple(r) for r in skewed.collect()]
    kept, rest = dedup.validate_duplicates(skewed, KEYS, ["ts"], keep)
    winners = Counter(tuple(r) for r in kept.collect())
    assert winners == brute_force(rows, keep == "latest")
    assert winners + Counter(tuple(r) for r in rest.collect()) == Counter(rows)


def test_many_copies_are_written_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(dedup, "COPIES_PER_CHUNK", 7)
    whole = spark.createDataFrame([("a", 1)] * 50 + [("b", 2)] * 8 + [("c", 3)], "k string, n int")
    part = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, n int")
    left = dedup.bag_difference(whole, part)
    assert Counter(r.k for r in left.collect()) == {"a": 49, "b": 7}
    assert same_rows(left, whole.exceptAll(part))
    assert left.filter("k = 'a'").select(F.spark_partition_id()).distinct().count() > 1


def test_rank_is_limited_before_the_shuffle(skewed):
    plan = plan_of(dedup.dedup_latest(skewed, KEYS, ["ts"]))
    assert plan.count("WindowGroupLimit") == 2


def test_rejects_are_counted_not_ranked(skewed):
    """The survivors' ranking is the only window, and it is limited before the shuffle."""
    _, rest = dedup.validate_duplicates(skewed, KEYS, ["ts"])
    plan = plan_of(rest)
    assert plan.count("- Window [") == 1 and plan.count("WindowGroupLimit") == 2


def test_rejects_without_many_copies_are_shuffled_once(skewed, monkeypatch):
    """Counting them is the only shuffle beside the ranking; rows that may have many copies are still shuffled apart."""
    plan = plan_of(dedup.validate_duplicates(skewed, KEYS, ["ts"])[1])
    assert plan.count("Exchange hashpartitioning") == 2 and "partial_sum" not in plan[plan.index("REPARTITION_BY_COL"):]
    monkeypatch.setattr(dedup, "COPIES_PER_CHUNK", 1100)  # the hot key has more rows, but no row has as many copies
    assert plan_of(dedup.validate_duplicates(skewed, KEYS, ["ts"])[1]).count("Exchange hashpartitioning") == 2
    monkeypatch.setattr(dedup, "COPIES_PER_CHUNK", 100)
    assert plan_of(dedup.validate_duplicates(skewed, KEYS, ["ts"])[1]).count("Exchange hashpartitioning") == 3


def test_few_copies_are_written_where_they_are_counted(spark):
    whole = spark.createDataFrame([("a", 1)] * 50 + [(None, 2)] * 8 + [("c", None)] * 2, "k string, n int")
    part = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), ("c", None)], "k string, n int")
    left = dedup.bag_difference(whole, part)
    assert Counter(tuple(r) for r in left.collect()) == {("a", 1): 48, (None, 2): 7, ("c", None): 1}


def test_unknown_keep(skewed):
    with pytest.raises(ValueError):
        dedup.validate_duplicates(skewed, KEYS, keep="any")


def test_unique_rows_stay(spark):
    df = spark.range(100).withColumn("f", F.lit("d"))
    kept, rest = dedup.validate_duplicates(df, ["id", "f"])
    assert (kept.count(), rest.count()) == (100, 0)
