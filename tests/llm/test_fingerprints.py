from __future__ import annotations

import math
import re
import struct
from collections import Counter

import xxhash
from helpers import az_lower, odd_documents
from leaguelake.llm import fingerprints
from pyspark.sql import functions as F


def _hash(value: bytes, seed: int = 42) -> int:
    return xxhash.xxh64(value, seed=seed).intdigest()


def brute(texts: list[str | None]) -> list[str]:
    """Fingerprints by plain Python over the same hash function."""
    every = [
        {_hash(w.encode()) for w in re.findall(r"[^\W_]+", az_lower(t))} for t in texts
    ]
    slots = Counter(t % (1 << fingerprints.SLOT_BITS) for terms in every for t in terms)
    most = max(len(texts) * math.exp(-fingerprints.LOWEST_IDF), fingerprints.FEWEST_DOCUMENTS)
    signed = lambda x: struct.unpack("<q", struct.pack("<Q", x))[0]

    def digest(terms) -> int:
        h = 42
        for t in sorted(terms, key=signed):
            h = _hash(struct.pack("<Q", t), h)
        return h

    found = []
    for terms in every:
        kept = {t for t in terms if 2 <= slots[t % (1 << fingerprints.SLOT_BITS)] <= most} or terms
        level = math.floor(math.log(len(kept), 4) + 1e-9) if kept else -1
        codes = ["", ""]
        for j in range(fingerprints.SUBSETS):
            seed = _hash(struct.pack("<i", j))
            for deeper in (0, 1):
                mask = 4 ** (max(level, 0) + deeper) - 1
                chosen = [t for t in kept if _hash(struct.pack("<Q", t), seed) & mask == 0]
                codes[deeper] += f"{digest(chosen) & 0xFFFFFFFF:08x}" if chosen else fingerprints.NONE
        whole = f"{digest(kept):x}" if kept else ""
        found.append(":".join([whole, str(level), *codes]))
    return found


def test_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(900, None), (901, ""), (902, "the"), (903, "the")], docs.schema))
    rows = docs.collect()
    docs = spark.createDataFrame(rows, docs.schema)
    found = fingerprints.with_fingerprint(docs, "text", fingerprints.lexicon(docs)).select(
        "doc_id", fingerprints.as_text("fingerprint").alias("f")
    ).collect()
    expected = dict(zip([r.doc_id for r in rows], brute([r.text for r in rows]), strict=True))
    assert {r.doc_id: r.f for r in found} == expected


def _likenesses(spark, texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = fingerprints.with_fingerprint(docs, "text", [-1] * (1 << (fingerprints.SLOT_BITS - 6)))
    a = rows.select(F.col("doc_id").alias("i"), F.col("fingerprint").alias("a"))
    b = rows.select(F.col("doc_id").alias("j"), F.col("fingerprint").alias("b"))
    pairs = a.join(b, F.col("i") <= F.col("j")).select("i", "j", fingerprints.likeness("a", "b").alias("like"))
    return {(r.i, r.j): r.like for r in pairs.collect()}


def test_likeness(spark):
    words = [f"w{i}" for i in range(600)]
    like = _likenesses(spark, [
        " ".join(words), " ".join(reversed(words)), " ".join(words[:560] + ["x"] * 40), " ".join(f"v{i}" for i in range(600)),
        " ".join(words[:20]), "", None,
    ])
    assert like[0, 1] == like[0, 0] == 1.0
    assert 0.3 < like[0, 2] < 1.0
    assert like[0, 3] < 0.1
    assert like[0, 4] == 0.0 and like[5, 6] == 1.0 and like[0, 5] == 0.0
    assert all(0 <= v <= 1 for v in like.values())


def _next_by_brute_force(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), [-ord(c) for c in r[1]] + [math.inf]))
    return Counter((*r, ordered[(i + 1) % len(ordered)][1]) for i, r in enumerate(ordered))


def test_next_row_by_descending_id(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "ROWS_OF_PART", 1)
    odd = [(10**9, "far"), (5, "tie b"), (5, "tie a"), (None, "none a"), (None, "none b"), (-7, "low")]
    for rows in ([(i * 3, f"t{i}") for i in range(700)], odd, odd[:1], odd[3:5]):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        found = fingerprints.with_next(docs, "doc_id", ["text"]).collect()
        assert Counter(map(tuple, found)) == _next_by_brute_force(rows)


def test_edited_text(spark):
    rows = [("abcdefg", "XYZ"), ("ab", "XYZ"), ("", "X"), ("a😀cdef", "é"), ("abcdef", "")]
    found = spark.createDataFrame(rows, "text string, nxt string").select(fingerprints.edited("text", "nxt").alias("e"))
    assert [r.e for r in found.collect()] == ["abcdeXY", "ab", "", "a😀cdé", "abcd"]


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = fingerprints.with_fingerprint(docs, "text", fingerprints.lexicon(docs))
    assert rows.columns == [*docs.columns, "fingerprint"]
    by_text = {}
    for r in rows.select("text", fingerprints.as_text("fingerprint").alias("f")).collect():
        by_text.setdefault(r.text or "", set()).add(r.f)
    assert all(len(f) == 1 for f in by_text.values())
    empty = odd_documents(spark, [])
    assert fingerprints.with_next(empty, "doc_id", ["text"]).count() == 0
    assert fingerprints.with_fingerprint(empty, "text", fingerprints.lexicon(empty)).count() == 0


def _exact(corpus: list[str], texts: list[str]) -> list[str]:
    """whole and level of texts over the terms of at least two and at most a tenth of the documents of a corpus."""
    every = [{_hash(w.encode()) for w in re.findall(r"[^\W_]+", az_lower(t))} for t in corpus]
    documents = Counter(t for found in every for t in found)
    found = []
    for text in texts:
        own = {_hash(w.encode()) for w in re.findall(r"[^\W_]+", az_lower(text))}
        kept = {t for t in own if 2 <= documents[t] <= max(len(corpus) / 10, 2)} or own
        h = 42
        for t in sorted(struct.unpack("<q", struct.pack("<Q", t))[0] for t in kept):
            h = _hash(struct.pack("<q", t), h)
        found.append(f"{h:x}:{math.floor(math.log(len(kept), 4) + 1e-9)}" if kept else ":-1")
    return found


def test_query_counts_documents_of_exact_terms(spark, tmp_path):
    from leaguelake.llm.queries import op1_imatch_fingerprints

    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).select("doc_id", "text").collect()
    texts = {r.doc_id: r.text or "" for r in rows} | {10**6: "", 10**6 + 1: "same words", 10**6 + 2: "same words"}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r for r in op1_imatch_fingerprints(spark, str(tmp_path)).collect()}
    order = sorted(texts, reverse=True)
    changed = {}
    for i, doc in enumerate(order):
        text, after = texts[doc], texts[order[(i + 1) % len(order)]]
        third = len(text) // 3
        changed[doc] = text[: len(text) - third] + after[:third]
    corpus = list(texts.values())
    for column, made in (("fingerprint", texts), ("edited_fingerprint", changed)):
        expected = dict(zip(made, _exact(corpus, list(made.values())), strict=True))
        assert {i: ":".join(r[column].split(":")[:2]) for i, r in found.items()} == expected


def test_samples_of_a_text_serve_the_edited_one(spark):
    """Only terms that the text lacks are sampled again, unless the edited text's level is lower."""
    pairs = [(range(200), range(70, 270)), (range(60), range(300)), (range(300), range(10)), ([], range(20)),
             (range(20), []), ([], []), (range(2), range(1, 3))]
    rows = spark.createDataFrame(
        [(i, [7919 * t for t in a], [7919 * t for t in b]) for i, (a, b) in enumerate(pairs)],
        "doc_id long, a array<bigint>, b array<bigint>",
    ).withColumns({"_every": F.col("a"), "_band": F.array().cast("array<bigint>")})
    sized = fingerprints._sized(rows)
    near = F.array(*[fingerprints._sampled(F.col("_kept"), F.col("_mask"), j) for j in range(fingerprints.SUBSETS)])
    own = fingerprints._digested(sized.withColumn("_near", near), "own")
    again = own.withColumnsRenamed({"_kept": "_own_kept", "_near": "_own_near"}).withColumns(
        {"_every": F.col("b"), "_band": F.array().cast("array<bigint>")}
    )
    beside = {r.doc_id: r.edited for r in fingerprints._described_beside(again, "edited", "own").collect()}
    alone = rows.withColumn("_every", F.col("b"))
    alone = {r.doc_id: r.edited for r in fingerprints._described(alone, "edited").collect()}
    assert beside == alone and len({r.level for r in alone.values()}) > 2
