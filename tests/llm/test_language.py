from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import odd_documents
from leaguelake.llm import language
from leaguelake.llm.common import in_fold
from pyspark.sql import functions as F

TEXTS = [
    ("xx", "aba bab abba"), ("xx", "abab ba! ABBA"), ("yy", "cdc dcd ccd"), ("yy", "dcdc 77 cd"), ("yy", "ddc"),
]


def brute_model(order: int):
    """Interpolated Kneser-Ney by dictionaries: probability of each gram for each language."""
    def clean(text: str) -> str:
        out = ""
        for c in text.lower():
            c = c if c.isalpha() else " "
            if c != " " or (out and out[-1] != " "):
                out += c
        return out

    counts: dict[str, list[Counter]] = {}
    for lang, text in TEXTS:
        padded = " " * (order - 1) + clean(text)
        top = counts.setdefault(lang, [Counter() for _ in range(order + 1)])[order]
        top.update(padded[i : i + order] for i in range(len(padded) - order + 1))
    for levels in counts.values():
        for o in range(order - 1, 0, -1):
            levels[o].update(g[1:] for g in levels[o + 1])
    alphabet = {g for levels in counts.values() for g in levels[1]}

    def probability(lang: str, gram: str) -> float:
        if not gram:
            return 1 / (len(alphabet) + 1)
        level = counts[lang][len(gram)]
        once = sum(n == 1 for n in level.values())
        twice = sum(n == 2 for n in level.values())
        discount = min(max(once / max(once + 2 * twice, 1) if once else 0.5, 0.05), 0.95)
        after = {g: n for g, n in level.items() if g[:-1] == gram[:-1]}
        total = sum(after.values())
        if not total:
            return probability(lang, gram[1:])
        below = discount * len(after) / total * probability(lang, gram[1:])
        return max(after.get(gram, 0) - discount, 0) / total + below

    return probability


def test_probabilities_equal_brute_force(spark):
    model = language.train(spark.createDataFrame(TEXTS, "lang string, text string"))
    probability = brute_model(language.ORDER)
    for text in ("abba", "dc ab", "zzz", "cdcd"):
        (keys, _), = language.grams(text)
        found = model.probabilities(keys)
        padded = " " * (language.ORDER - 1) + text
        for i in range(len(text)):
            gram = padded[i : i + language.ORDER]
            for k, lang in enumerate(model.languages):
                assert found[i, k] == pytest.approx(probability(lang, gram), rel=1e-4)


def test_grams_of_blocks_and_rare_letters():
    text = "ab 𝒜! " * (language.BLOCK // 4)
    parts = [keys for keys, _ in language.grams(text)]
    assert len(parts) > 1
    whole = np.concatenate([np.full(language.ORDER - 1, 32, np.uint64), language.symbols(text).astype(np.uint64)])
    assert abs(sum(map(len, parts)) - (len(whole) - language.ORDER + 1)) <= len(parts)
    assert (language.symbols("a1 2b") == [97, 32, 98]).all()
    assert language.symbols("𝒜")[0] != 32 and len(language.symbols("12 !")) == 0


@pytest.fixture(scope="module")
def trained(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return docs, language.train(docs.where(~in_fold("doc_id", 3, 1)))


def test_held_out_accuracy(trained):
    docs, model = trained
    found = language.identify(docs, model).join(docs.select(F.col("doc_id").alias("id"), "lang"), "id")
    held = found.where(in_fold("id", 3, 1)).agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right"), F.min("score").alias("lo"), F.max("score").alias("hi")
    ).first()
    assert held.right > 0.98 and 0 <= held.lo <= held.hi <= 1


def test_rejects_what_is_no_language_and_nothing_else(trained):
    docs, model = trained
    kept = language.accepted_documents(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == docs.where("text is not null").count()
    assert model.verdict("xqzj wvkk jjxq xkcd zzzx pwqq qqvx vvxh hhjj jjkq kklx xllq bbxb zxcq" * 3)[3]
    assert not model.verdict("the thing of the")[3]


def test_odd_rows(spark, trained):
    _, model = trained
    docs = odd_documents(spark)
    found = defaultdict(set)
    for r in language.identify(docs, model).collect():
        found[r.id].add((r.lang_pred, r.rejected))
        assert 0 <= r.score <= 1
    for i in (1, 2, 3, 8):
        assert found[i] == {("und", True)}
    assert found[4] == found[5] and not any(rejected for _, rejected in found[4])


def test_nothing_learned(spark):
    empty = spark.createDataFrame([(None, "text"), ("en", None)], "lang string, text string")
    model = language.train(empty)
    rows = language.identify(odd_documents(spark), model).collect()
    assert {(r.lang_pred, r.score, r.rejected) for r in rows} == {("und", 0.0, True)}
    assert language.identify(odd_documents(spark, []), model).count() == 0


def test_fold_is_crc32_of_the_id_as_text(spark):
    import zlib

    rows = spark.range(200).select("id", in_fold("id", 3, 1).alias("f")).collect()
    assert all(r.f == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in rows)
    assert math.isclose(sum(r.f for r in rows) / 200, 1 / 3, abs_tol=0.1)


def test_calibration_counts_every_row(spark):
    long = [("yy", f"dcd ccd d{'cd'[i % 2]}c dd " * 20 + "cdd " * i) for i in range(24)]
    rows = long + [("xx", "aba bab"[: 3 + i % 5]) for i in range(60_000)] + [("xx", " 7"), ("yy", None)]
    model = language.train(spark.createDataFrame(rows, "lang string, text string").repartition(5))
    entropies = np.array([model.score(text)[0].min() for _, text in long])
    assert [model.verdict(text)[0] for _, text in long] == ["yy"] * 24
    assert model.usual[1] == pytest.approx(entropies.mean(), abs=1e-9)
    assert model.spread[1] == pytest.approx(max(entropies.var(), 1e-4), abs=1e-9)
    assert model.usual[0] == math.inf
    short = [model.score("aba bab"[: 3 + i])[0] for i in range(5)] * 12_000 + [model.score(text)[0] for _, text in long]
    own = np.array([0] * 60_000 + [1] * 24)
    above = np.array(short) - np.array(short).min(axis=1, keepdims=True)

    def loss(s: float) -> float:
        return float((s * above[np.arange(len(own)), own] + np.log(np.exp(-s * above).sum(axis=1))).mean())

    assert loss(model.sharpness) == pytest.approx(min(map(loss, language.SHARPNESSES)), abs=1e-12)
