"""Every query with a DuckDB counterpart gives its rows; the pipeline gives those of plain Python."""

from __future__ import annotations

import re
from collections import Counter

import corpus_pipeline
import duckdb
import public_tokenizers
import pytest
from helpers import UPPER, az_lower, components, odd_documents
from leaguelake.llm import packing
from leaguelake.llm.oracles import ORACLE_SQL
from leaguelake.llm.queries import QUERIES
from tokenizers import Tokenizer

FOLDER = "/root/testdata/sf0.001"


def _frame(df):
    columns = sorted(df.columns)
    df = df[columns].astype(object).where(df[columns].notna(), None)
    return columns, Counter(map(tuple, df.itertuples(index=False)))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "conversations", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    expected = connection.execute(ORACLE_SQL[name]).fetchdf()
    assert _frame(QUERIES[name](spark, FOLDER).toPandas()) == _frame(expected)


def test_op1_returns_every_document_edited(spark):
    import hashlib

    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id", ascending=False).collect()
    found = {r.doc_id: r for r in QUERIES["op1_imatch_fingerprints"](spark, FOLDER).collect()}
    assert len(found) == len(rows)
    for i, row in enumerate(rows):
        text, after = row.text or "", rows[(i + 1) % len(rows)].text or ""
        third = len(text) // 3
        changed = text[: len(text) - third] + after[:third]
        r = found[row.doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
    mean = lambda c: sum(r[c] for r in found.values()) / len(found)
    assert mean("near_edited") > 5 * mean("near_next")


def _run_stages(spark, folder, docs, path):
    kept = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, kept[-1], folder).write.parquet(f"{path}/{i}")
        kept.append(spark.read.parquet(f"{path}/{i}"))
    return kept


def test_pipeline_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = _run_stages(spark, FOLDER, docs, tmp_path)
    tables = [dict(k.select("doc_id", "text").collect()) for k in kept[:5]]
    assert all(k.columns == docs.columns for k in kept[:5])
    assert set(tables[1]) == {i for i, t in tables[0].items() if re.search(r"[^\W\d_]", t)}
    toxic = {r.doc_id for r in spark.read.parquet(f"{FOLDER}/labels.parquet").where("toxic = 0").collect()}
    assert not toxic & (set(tables[1]) - set(tables[2]))  # clean documents stay
    largest: dict[str, int] = {}
    for i, t in tables[2].items():
        largest[az_lower(t)] = max(i, largest.get(az_lower(t), i))
    assert set(tables[3]) == set(largest.values())
    assert set(tables[4]) == {i for i, c in components(tables[3]).items() if i == c}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    places = kept[5].collect()
    total = Counter()
    for r in places:
        total[r.doc_id] += r.length
    assert total == {i: len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in tables[4].items()}
    used = Counter()
    for r in sorted(places, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == used[r.sequence_id]
        used[r.sequence_id] += r.length
    assert max(used.values()) <= packing.CAPACITY


def test_pipeline_on_odd_rows(spark, tmp_path):
    docs = odd_documents(spark).withColumnRenamed("id", "lang").withColumnRenamed("score", "source")
    kept = _run_stages(spark, FOLDER, docs, tmp_path)
    assert all(k.columns == docs.columns for k in kept[:5])
    texts = [az_lower(r.text) for r in kept[3].collect()]
    assert len(texts) == len(set(texts)) and not any(c in UPPER for t in texts for c in t)
    empty = _run_stages(spark, FOLDER, docs.limit(0), tmp_path / "empty")
    assert [k.count() for k in empty] == [0] * 6


def test_run_equals_the_stages(spark):
    assert corpus_pipeline.run(spark, FOLDER).count() > 0
