from __future__ import annotations

import hashlib
from collections import Counter

from helpers import az_lower, odd_documents
from leaguelake.llm import exact_dedup, near_dedup
from leaguelake.llm.common import ascii_lower
from pyspark.sql import functions as F


def test_lower_cases_a_to_z_only(spark):
    points = [c for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    rows = spark.createDataFrame([(chr(c),) for c in points if c < 0x3000 or c >= 0x1F000][:70000], "t string")
    wrong = [r.t for r in rows.withColumn("low", ascii_lower(F.col("t"))).collect() if r.low != az_lower(r.t)]
    assert not wrong


def test_odd_rows_against_brute_force(spark):
    docs = odd_documents(spark)
    rows = docs.select("doc_id", "text").collect()
    best: dict[str, int | None] = {}
    for i, text in rows:
        key = az_lower(text)
        best[key] = max((x for x in (best.get(key), i) if x is not None), default=None)
    sizes = Counter(az_lower(text) for _, text in rows)
    expected = Counter(
        (i, best[az_lower(t)], sizes[az_lower(t)], i == best[az_lower(t)], hashlib.sha256(az_lower(t).encode()).hexdigest())
        for i, t in rows
    )
    assert Counter(map(tuple, exact_dedup.exact_groups(docs, keep="largest").collect())) == expected


def test_a_repeated_row_stays_once_with_all_columns(spark):
    docs = odd_documents(spark, [(5, "one two"), (5, "one two"), (4, "ONE two"), (None, "z"), (None, "Z"), (6, None)])
    kept = exact_dedup.kept_documents(docs, keep="largest")
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, az_lower(r.text), r.id) for r in kept.collect()) == [(0, "z", "i"), (5, "one two", "i"), (6, "", "i")]


def test_smallest_stays_by_default_and_runs_do_not_matter(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), (F.col("id") % 7).cast("string").alias("text"))
    for runs, fan_in in ((1, 2), (5, 2), (64, 8)):
        kept = exact_dedup.exact_groups(docs, runs=runs, fan_in=fan_in).where("kept")
        assert sorted(r.id for r in kept.collect()) == list(range(7))


def test_empty(spark):
    assert exact_dedup.exact_groups(odd_documents(spark, [])).count() == 0


def test_no_column_is_lost_whatever_its_name(spark):
    names = "_id _sha _nth _a _b _row_key _way row row_key a b nth n node label bucket u v key".split()
    docs = spark.createDataFrame(
        [(i, text, *[f"{name}{i}" for name in names]) for i, text in [(1, "one two"), (2, "One two"), (3, "six")]],
        "doc_id long, text string, " + ", ".join(f"{name} string" for name in names),
    )
    for kept, ids in ((exact_dedup.kept_documents(docs, keep="largest"), [2, 3]), (near_dedup.kept_documents(docs), [1, 3])):
        assert kept.columns == docs.columns
        assert sorted(map(tuple, kept.collect())) == sorted(tuple(r) for r in docs.collect() if r.doc_id in ids)
