"""Windows in pieces against a plain Python computation."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from samples import rows

from leaguelake.operators import ordered
from leaguelake.operators.latest import latest_per_key
from leaguelake.operators.ordered import month_of, range_of, rank_descending, rolling, running_totals

KEYS = ["a", "b"]
WIDTHS = [1, 3, 100]


def order():
    return [F.col("t").asc_nulls_last(), F.col("id").asc_nulls_last()]


def skewed(seed: int, count: int = 240):
    """A third of the rows in one key, a null key, ties in time and missing values."""
    dice = random.Random(seed)
    data = []
    for number in range(count):
        a = "hot" if number % 3 == 0 else dice.choice(["x", "y", None])
        b = 1 if a == "hot" else dice.choice([1, 2, None])
        t = dice.choice([None, *range(12)])
        data.append((a, b, t, str(number), dice.choice([None, 0, 1, 3]), dice.choice([0, 1, 2])))
    return data


SCHEMA = "a string, b int, t int, id string, v int, w int"


def groups(data):
    found = {}
    for row in sorted(data, key=lambda r: (r[2] is None, r[2] or 0, r[3])):
        found.setdefault(row[:2], []).append(row)
    return found


@pytest.mark.parametrize("width", WIDTHS)
def test_running_totals(spark, width):
    data = skewed(1)
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    expected = set()
    for group in groups(data).values():
        total = None
        for place, row in enumerate(group, 1):
            total = total if row[4] is None else (total or 0) + row[4]
            expected.add((*row, place, total))
    found = running_totals(df, KEYS, order(), range_of("t", width), {"place": F.lit(1), "total": F.col("v")})
    assert {tuple(r) for r in found.collect()} == expected
    assert found.columns == [*df.columns, "place", "total"]


@pytest.mark.parametrize("width", WIDTHS)
def test_rolling_frames_and_lag(spark, monkeypatch, width):
    monkeypatch.setattr(ordered, "BLOCK_ROWS", 2 * width)
    data = skewed(2)
    expected = set()
    for group in groups(data).values():
        for place, row in enumerate(group):
            frame = group[max(0, place - 4): place + 1]
            known = [r[4] for r in frame if r[4] is not None]
            before = group[place - 1][5] if place else None
            expected.add((*row, len(frame), sum(known) if known else None, tuple(r[3] for r in frame), before))
    found = rolling(
        spark.createDataFrame(data, SCHEMA).repartition(3), KEYS, order(), range_of("t", width), 4,
        {
            "n": lambda w: F.count(F.lit(1)).over(w.rowsBetween(-4, 0)),
            "s": lambda w: F.sum("v").over(w.rowsBetween(-4, 0)),
            "ids": lambda w: F.collect_list("id").over(w.rowsBetween(-4, 0)),
            "before": lambda w: F.lag("w").over(w),
        },
    )
    assert {(*r[:8], tuple(r[8]), r[9]) for r in found.collect()} == expected


@pytest.mark.parametrize("width", WIDTHS)
def test_rank_descending(spark, monkeypatch, width):
    monkeypatch.setattr(ordered, "SCORES_OF_PIECE", width)
    data = skewed(3)
    found = rank_descending(spark.createDataFrame(data, SCHEMA).repartition(3), KEYS, ["v", "w"], "place")

    def score(row):
        return (row[4] is None, row[4] or 0, row[5])

    expected = {
        (*row, 1 + sum(score(other) > score(row) for other in group)) for group in groups(data).values() for row in group
    }
    assert {tuple(r) for r in found.collect()} == expected


def test_equal_rank_leaves_a_gap(spark):
    df = spark.createDataFrame([("a", 5), ("b", 5), ("c", 4)], "id string, v int").withColumn("k", F.lit(1))
    assert rows(rank_descending(df, ["k"], ["v"], "place"), "id", "place") == [("a", 1), ("b", 1), ("c", 3)]


def test_latest_per_key_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    latest = latest_per_key(df, ["k"], [F.col("id").desc()])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert rows(latest) == [(0, 999), (1, 997), (2, 998)]


def test_months_order_and_missing_ones_come_last(spark):
    days = ["2023-12-31", "2024-01-01", "2024-01-31", None]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(F.col("d").cast("timestamp_ntz").alias("d"))
    found = [r.m for r in df.select(month_of("d").alias("m")).collect()]
    assert found[0] + 1 == found[1] == found[2] < found[3]


def test_one_key_with_most_rows_is_spread_over_tasks(spark):
    moment = F.expr("timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(cast(id % 1500 as int))")
    df = spark.range(20000).select(F.lit("k").alias("k"), moment.alias("t"), "id")
    order = [F.col("t"), F.col("id")]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        totals = running_totals(df, ["k"], order, month_of("t"), {"place": F.lit(1)})
        held = totals.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(held) > 1 and max(r["count"] for r in held) < 12000
    assert totals.agg(F.countDistinct("place"), F.max("place")).first() == (20000, 20000)
