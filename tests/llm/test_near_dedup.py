from __future__ import annotations

import random

import numpy as np
from helpers import components, odd_documents, shingles
from leaguelake.llm import components as components_module
from leaguelake.llm import near_dedup
from leaguelake.llm.components import components as connected
from leaguelake.llm.shingles import BLOCK, shingle_set, word_hashes
from leaguelake.sources.store import cut


def _text(rng: random.Random, n: int) -> list[str]:
    return [f"w{rng.randrange(400)}" for _ in range(n)]


def _edited(rng: random.Random, words: list[str], share: float) -> list[str]:
    return [f"e{rng.randrange(10**6)}" if rng.random() < share else w for w in words]


def test_groups_equal_brute_force(spark):
    rng = random.Random(3)
    passage = _text(rng, 70)
    rows: list[list[str]] = []
    for _ in range(25):
        base = _text(rng, rng.randrange(6, 300))
        rows.append(base)
        rows += [_edited(rng, base, rng.choice([0.0, 0.01, 0.03, 0.05, 0.08])) for _ in range(rng.randrange(0, 6))]
    for _ in range(60):  # many documents around one shared passage, most of them no links
        rows.append(_text(rng, rng.randrange(2, 60)) + passage)
    chain = _text(rng, 200)
    for _ in range(12):  # neighbours are alike, the ends are not
        rows.append(chain)
        chain = _edited(rng, chain, 0.02)
    rng.shuffle(rows)
    texts = {100 + i: " ".join(words) for i, words in enumerate(rows)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    found = near_dedup.near_groups(docs).collect()
    expected = components(texts)
    assert {r.id: r.component_id for r in found} == expected
    assert {r.id: r.n_shingles for r in found} == {i: len(shingles(t)) for i, t in texts.items()}
    assert all(r.kept == (r.id == r.component_id) for r in found)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    found = near_dedup.near_groups(docs).collect()
    assert len(found) == docs.count()
    by = {}
    for r in found:
        by.setdefault(r.id, set()).add((r.component_id, r.kept))
    assert by[1] == {(1, True)} and by[2] == {(2, True)} and by[3] == {(3, True)}  # no words: no links
    assert by[4] == {(4, True)} and by[5] == by[7] == {(4, False)}
    assert by[None] == {(4, False), (None, True)}  # the null id joins its group; without words it is alone
    kept = near_dedup.kept_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 8, 9, 10, 11, 12]


def test_empty(spark):
    assert near_dedup.near_groups(odd_documents(spark, [])).count() == 0


def test_word_hashes_do_not_depend_on_blocks_or_spacing():
    text = " ".join(f"wörd{i}" for i in range(BLOCK // 4))
    assert len(text) > BLOCK
    whole = word_hashes(text)
    pieces = np.concatenate([word_hashes(w) for w in text.split(" ")[:500]])
    assert (whole[:500] == pieces).all()
    assert (word_hashes("A b\tC\n d") == word_hashes(" a  B\x0bc\r\fD ")).all()
    assert len(word_hashes("x" * (3 * BLOCK) + " y")) == 2


def test_sketches_bound_the_difference_of_small_sets():
    rng = np.random.default_rng(5)
    for _ in range(50):
        common = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
        a = np.unique(np.concatenate([common, rng.integers(0, 1 << 63, 40, dtype=np.uint64)]))
        b = np.unique(np.concatenate([common, rng.integers(0, 1 << 63, 55, dtype=np.uint64)]))
        differing = near_dedup.odd_sketch(a) ^ near_dedup.odd_sketch(b)
        assert sum(int(x).bit_count() for x in differing.view(np.uint64)) <= 95


def test_the_limit_lets_pairs_at_the_threshold_pass(spark):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(8)
    rows = []
    for size in (20, 200, 700, 3000, 20000):
        for ratio in (1.0, 0.9, 0.78):
            for _ in range(20):
                a, b = size, int(size * ratio)
                shared = int(np.ceil(0.75 / 1.75 * (a + b)))
                pool = rng.integers(0, 1 << 63, a + b - shared, dtype=np.uint64)
                first, second = np.sort(pool[:a]), np.sort(pool[a - shared :])
                odd = near_dedup.odd_sketch(first) ^ near_dedup.odd_sketch(second)
                rows.append((a, b, sum(int(x).bit_count() for x in odd.view(np.uint64))))
    pairs = spark.createDataFrame(rows, "a long, b long, odd long")
    assert not pairs.where(F.col("odd") > near_dedup.sketch_limit(F.col("a"), F.col("b"))).collect()


def test_shingles_of_few_words():
    assert len(shingle_set(word_hashes("a b c"), 5)) == 1
    assert len(shingle_set(word_hashes(""), 5)) == 0
    assert (shingle_set(word_hashes("a b"), 5) != shingle_set(word_hashes("b a"), 5)).all()


def test_components_of_a_path_a_star_and_a_ring(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101 + i) for i in range(30)] + [(200, 201), (201, 202), (202, 200)]
    found = connected(spark.createDataFrame(links, "u long, v long")).collect()
    expected = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(31)} | {200 + i: 200 for i in range(3)}
    assert {r.node: r.root for r in found} == expected and len(found) == len(expected)
    assert connected(spark.createDataFrame([], "u long, v long")).count() == 0


def test_no_table_that_grows_with_the_corpus_is_broadcast(spark, monkeypatch):
    """Even tiny ones are not: at any size Spark may take what an explode makes for as small."""
    rng = random.Random(12)
    bases = [_text(rng, 120) for _ in range(8)]
    texts = [" ".join(_edited(rng, base, 0.02)) for base in bases for _ in range(5)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    plans = []

    def planned(df, label, *more):
        plans.append((label, df._jdf.queryExecution().executedPlan().toString()))
        return cut(df, label, *more)

    for module in (near_dedup, components_module):
        monkeypatch.setattr(module, "cut", planned)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    try:
        kept = near_dedup.kept_documents(docs)
        plans.append(("kept", kept._jdf.queryExecution().executedPlan().toString()))
        assert {r.doc_id for r in kept.collect()} == set(components(dict(enumerate(texts))).values())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert {"buckets", "spots", "open", "links", "texts", "kept"} <= {label for label, _ in plans}
    assert [label for label, plan in plans if "Broadcast" in plan] == []
