"""Exact duplicates by a tree merge of digest runs.

Every row is hashed once and the digests are dealt into runs. A run holds one entry for each
digest: the id that stays and the number of rows. Runs are merged `fan_in` at a time, round after
round, until one logical run, spread over the cluster by digest, is left. A group of copies enters
the first exchange as one row for each task and run, whatever its size. The result of the last round is
joined to the entries of the first runs, and these to their rows, so that no task gets all rows of a group.

Runs are sets of entries, not files in order: a merge is a hash aggregate by (run, digest). Spark drops sorts whose
order nothing after them uses, and an aggregate of smallest ids and counts needs none, so the runs are not sorted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaguelake.llm.common import ascii_lower, keep_rows, row_key
from leaguelake.sources.store import cut

#: What says that two texts are the same: SHA-256, length and an independent 64-bit hash.
VERIFIED = ["digest", "n_bytes", "check"]


def digest_runs(docs: DataFrame, id_col: str, text_col: str, runs: int) -> DataFrame:
    text = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    return docs.select(F.col(id_col).alias("id"), text.alias("t")).select(
        "id",
        F.unhex(F.sha2("t", 256)).alias("digest"),
        F.octet_length("t").alias("n_bytes"),
        F.xxhash64("t").alias("check"),
        F.pmod(F.xxhash64("id"), F.lit(runs)).cast("int").alias("run"),
    )


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    keep: str = "smallest", runs: int = 64, fan_in: int = 8,
) -> DataFrame:
    """One row for each row of docs: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; a null text is empty. Of a group the row
    with the `keep` ("smallest" or "largest") non-null id stays; without any id, keep_id is null.
    Rows that repeat an id within a group get the same decision (`kept_documents` leaves one). Other
    columns are not read, whatever their names. An empty table gives an empty result.
    """
    best = {"smallest": F.min, "largest": F.max}[keep]
    rows = cut(digest_runs(docs, id_col, text_col, runs), "digests")

    def merged(entries: DataFrame) -> DataFrame:
        return entries.groupBy("run", *VERIFIED).agg(
            best("id").alias("id"), F.sum("n").alias("n")
        )

    first = merged(rows.withColumn("n", F.lit(1)))
    level, left = first, runs
    while left > 1:
        level = merged(level.withColumn("run", F.expr(f"cast(run div {fan_in} as int)")))
        left = -(-left // fan_in)
    root = level.select(*VERIFIED, F.col("id").alias("keep_id"), F.col("n").alias("group_size"))
    decided = first.select("run", *VERIFIED).join(root, VERIFIED)
    return rows.join(decided, ["run", *VERIFIED]).select(
        "id", "keep_id", "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def kept_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest"
) -> DataFrame:
    """The documents that stay, with all their columns; a row repeated with its id stays once."""
    groups = exact_groups(docs, id_col, text_col, keep).where("kept").select("id", "text_sha256")
    text = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    keys = groups.select(row_key("id", "text_sha256").alias("row_key"))
    return keep_rows(docs, keys, F.col(id_col), F.sha2(text, 256))
