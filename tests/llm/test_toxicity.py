from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pytest
from helpers import odd_documents
from leaguelake.llm import crf, toxicity
from leaguelake.llm.common import in_fold


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(4)
    lengths = np.array([6, 4, 1])
    scores, between = rng.normal(0, 2, 11), rng.normal(0, 1, (2, 2))
    found = crf.marginals(scores, between, crf.Chains(lengths))
    start = 0
    for n in lengths:
        total, ones = 0.0, np.zeros(n)
        for labels in itertools.product((0, 1), repeat=int(n)):
            weight = np.exp(
                sum(scores[start + i] * y for i, y in enumerate(labels))
                + sum(between[a, b] for a, b in zip(labels, labels[1:]))
            )
            total += weight
            ones += weight * np.array(labels)
        assert found[start : start + n] == pytest.approx(ones / total)
        start += n


def test_fitting_learns_words_and_neighbours():
    rng = np.random.default_rng(6)
    size, features = 64, np.arange(10)[:, None]
    words = rng.integers(0, 10, 4000)
    labels = (words == 3).astype(np.int64)  # one word, and word 5 right after word 7
    labels[1:] |= (words[1:] == 5) & (words[:-1] == 7)
    chains = crf.Chains(np.full(40, 100))
    labels[chains.starts] = words[chains.starts] == 3
    field = crf.fit(features, words, labels, chains, size)
    scores = field.own[features[words, 0]] + field.bias
    inner = np.setdiff1d(np.arange(1, 4000), chains.starts)
    scores[inner] += field.before[features[words[inner - 1], 0]]
    scores[inner - 1] += field.after[features[words[inner], 0]]
    found = crf.marginals(scores, field.between, chains) >= 0.5
    assert (found == labels.astype(bool)).mean() > 0.97


@pytest.fixture(scope="module")
def trained(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    return docs, labels, toxicity.train(docs.where(~in_fold("doc_id", 5, 0)), labels)


def test_held_out_documents(trained):
    docs, labels, model = trained
    rows = toxicity.scored(docs, model, spans=False).join(labels.withColumnRenamed("doc_id", "id"), "id").where(in_fold("id", 5, 0)).collect()
    toxic = [r.score for r in rows if r.toxic]
    clean = [r.score for r in rows if not r.toxic]
    assert max(clean) < 0.5
    pairs = [(a > b) + 0.5 * (a == b) for a in toxic for b in clean]
    assert np.mean(pairs) > 0.8  # few documents of each language are labelled at this size


def test_spans_are_offending_words(trained):
    docs, labels, model = trained
    rows = toxicity.scored(docs, model).join(docs.withColumnRenamed("doc_id", "id"), "id").where("size(spans) > 0").collect()
    assert rows
    found = [r.text[s.start : s.end] for r in rows for s in r.spans]
    assert all(w.isalnum() for w in found)
    clean = labels.where("toxic = 0").withColumnRenamed("doc_id", "id")
    assert toxicity.scored(docs, model).join(clean, "id").where("size(spans) > 0").count() == 0


def test_clean_documents_keep_their_columns(trained):
    docs, labels, model = trained
    kept = toxicity.clean_documents(docs, model)
    assert kept.columns == docs.columns
    lost = docs.select("doc_id").subtract(kept.select("doc_id"))
    assert lost.join(labels.where("toxic = 0"), "doc_id").count() == 0 and lost.count() > 0


def test_odd_rows(spark, trained):
    model = trained[2]
    docs = odd_documents(spark)
    rows = toxicity.scored(docs, model).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r.score < 0.5 and r.spans == [] for r in rows)
    assert len({r.score for r in rows if r.id in (1, 2, 3)}) == 1
    assert toxicity.scored(odd_documents(spark, []), model).count() == 0


def test_labels_missing_or_of_one_kind(spark):
    docs = odd_documents(spark)
    for rows, share in (([], 0.0), ([(4, None), (None, 1)], 0.0), ([(4, 0), (12, 0)], 0.0), ([(4, 1)], 1.0)):
        labels = spark.createDataFrame(rows, "doc_id long, toxic int")
        model = toxicity.train(docs, labels)
        assert {r.score for r in toxicity.scored(docs, model, spans=False).collect()} == {share}


def test_each_distinct_text_counts_once_with_its_highest_label(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "a b"), (3, "c"), (3, "c"), (4, "d")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, 0), (3, 0)], "doc_id long, toxic int")
    rows = toxicity.labelled_texts(docs, labels, "doc_id", "text", "toxic").distinct().collect()
    assert sorted(map(tuple, rows)) == [("a b", 1), ("c", 0)]


def test_chance_marks_are_few():
    rng = np.random.default_rng(9)
    held = rng.integers(1, 30, 20000)
    toxic = rng.binomial(held, 0.12)
    marked = toxicity.toxic_slots(toxic.astype(float), (held - toxic).astype(float), 1200, 8800)
    assert marked.sum() < toxicity.CHANCE_MARKS * 3
    toxic[0], held[0] = 40, 40
    assert toxicity.toxic_slots(toxic.astype(float), (held - toxic).astype(float), 1200, 8800)[0]


def test_remembered_words_take_little_memory():
    import tracemalloc

    words = 60_000
    texts = pa.array([" ".join(f"w{i}x{j}" for j in range(500)) for i in range(words // 500)])
    labelled = pa.RecordBatch.from_arrays([texts, pa.array([i % 2 for i in range(len(texts))], pa.int32())], ["text", "toxic"])
    tracemalloc.start()
    assert sum(out.num_rows for out in toxicity._feature_counts(iter([labelled]))) > 0
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (peak - 2 * 8 * toxicity.SLOTS) / words < 300  # bytes a word; lists of numbers took 383
