"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leaguelake.llm import (
    bpe, chat, exact_dedup, fingerprints, hard_negatives, language, licenses, near_dedup, packing, token_files, toxicity,
    urls, whitening,
)
from leaguelake.llm.common import in_fold
from leaguelake.sources.store import session_folder

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """The public tokenizer file that the queries use."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_imatch_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = fingerprints.with_edited_fingerprints(docs)
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("changed", 256).alias("edited_sha256"),
        fingerprints.as_text("own").alias("fingerprint"),
        fingerprints.as_text("edited").alias("edited_fingerprint"),
        fingerprints.likeness("own", "edited").alias("near_edited"),
        "near_next",
    )


def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = packing.packed(table(spark, folder, "documents"), vocabulary_path())
    return packed.withColumnRenamed("id", "doc_id")


def op3_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    groups = near_dedup.near_groups(table(spark, folder, "documents"))
    return groups.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


def op4_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(table(spark, folder, "documents"), vocabulary_path()).withColumnRenamed("id", "doc_id")


def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan(table(spark, folder, "documents"))
    best = F.get("matches", F.lit(0))
    return found.select(
        F.col("id").alias("doc_id"), best["licence"].alias("licence"), best["dice"].alias("dice"),
        F.size("matches").cast("long").alias("n_matches"),
    )


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = in_fold("doc_id", 3, 1)
    found = language.identify(docs, language.train(docs.where(~held_out)))
    return found.select(F.col("id").alias("doc_id"), "lang_pred", "score").withColumn("held_out", held_out)


#: The rules that the query is to apply.
URL_RULES = [
    urls.Rule("net", "/", "block"),
    urls.Rule("example.net", "/en/", "allow"),
    urls.Rule("example.com", "/de/", "block"),
    urls.Rule("org", "/fr/", "allow"),
]


def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    found = urls.judged(table(spark, folder, "pages"), URL_RULES)
    return found.withColumnRenamed("id", "page_id").select("page_id", "host", "path", "rule", "verdict", "template")


def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    groups = exact_dedup.exact_groups(table(spark, folder, "documents"), keep="largest")
    return groups.withColumnRenamed("id", "doc_id")


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held_out = in_fold("doc_id", 5, 0)
    model = toxicity.train(docs.where(~held_out), labels)
    found = toxicity.scored(docs, model, spans=False)
    return found.select(
        F.col("id").alias("doc_id"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    ).withColumn("held_out", held_out)


def op10_preference_format(spark: SparkSession, folder: str) -> DataFrame:
    turns = chat.reply_pairs(table(spark, folder, "conversations"))
    records = chat.preference_records(turns)

    def trained(side: str) -> Column:
        lengths = F.transform(f"{side}_spans", lambda s: (s["end"] - s["start"]).cast("long"))
        return F.aggregate(lengths, F.lit(0).cast("long"), lambda total, n: total + n).alias(f"{side}_trained")

    return records.select(
        F.col("pair_id").alias("conv_id"), F.col("prompt_turns").cast("long").alias("prompt_turns"),
        *[F.sha2(part, 256).alias(f"{part}_sha256") for part in ("prompt", *chat.SIDES)],
        *[trained(side) for side in chat.SIDES],
    )


def op11_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    model = whitening.fit(rows)
    error = whitening.identity_error(rows, model) if model else 0.0
    found = whitening.whitened(rows, model).withColumnRenamed("id", "vec_id")
    return found.withColumn("identity_error", F.lit(error))


#: Fixed value: the id that ends each document in the files.
END_ID = 2


def op12_token_files(spark: SparkSession, folder: str) -> DataFrame:
    tokens = token_files.encoded(table(spark, folder, "documents"), vocabulary_path("word_bpe_49k.json"), END_ID)
    path = f"{session_folder(spark)}/token-files-{uuid.uuid4().hex}"
    token_files.write_files(tokens, path)
    found = token_files.read_files(spark.read.parquet(path))
    return found.select(F.col("id").alias("doc_id"), "start", F.col("n").alias("n_tokens"), F.col("crc32").alias("ids_crc32"))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    # Which labels are moved on, and which rows are anchors.
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.vectors(table(spark, folder, "embeddings"), "vec_id", "embedding", label)
    return hard_negatives.mined(rows, F.col("id") % 100 == 0)


QUERIES: dict[str, Query] = {
    "op1_imatch_fingerprints": op1_imatch_fingerprints,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
    "op4_bpe_round_trip": op4_bpe_round_trip,
    "op5_license_scan": op5_license_scan,
    "op6_language_id": op6_language_id,
    "op7_url_filter": op7_url_filter,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_preference_format": op10_preference_format,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_token_files": op12_token_files,
    "op13_hard_negatives": op13_hard_negatives,
}
