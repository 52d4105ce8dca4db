"""I-Match document fingerprints over randomised subsets of the lexicon.

The lexicon is the terms whose inverse document frequency lies in a band: words of every other text say
nothing, words of one text match nothing. `with_edited_fingerprints`, which the query uses, counts the documents of
every term. `lexicon` counts them in 2 ** SLOT_BITS hashed slots, a bitmap of fixed size that holds only
for vocabularies much smaller than that. Of a text's distinct
terms in the lexicon, each of SUBSETS random subsets is sorted and hashed. A subset holds a term with a
chance of 4 ** -level; the level follows from the number of terms, so that a subset holds one to four of
them whatever the length of the text, and the next level is kept as well, so that texts of somewhat
different lengths share one. The likeness of two fingerprints is the share of equal hashes.

Everything is built-in functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leaguelake.llm.common import ascii_lower, attach
from leaguelake.sources.store import cut, let_go

SLOT_BITS = 20
SUBSETS = 16
#: The band: terms of more than a tenth of the documents, and of one document only, are left out.
LOWEST_IDF = math.log(10)
FEWEST_DOCUMENTS = 2
#: Ranges of ids for ordering documents: quantiles, and equal parts of each.
QUANTILES = 256
MOST_PARTS = 256
ROWS_OF_PART = 20_000
NONE = "--------"
WORD_AT_START = r"^[\p{L}\p{N}]+"


def terms(text: Column) -> Column:
    """Distinct 64-bit hashes of the words of a text, null counting as empty."""
    words = F.split(ascii_lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.array_distinct(F.transform(F.array_remove(words, ""), lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, text_col: str = "text") -> list[int]:
    """The bitmap of slots in the band, as 64-bit words; counted over all documents."""
    n = docs.count()
    slot = F.col("term").bitwiseAND(F.lit((1 << SLOT_BITS) - 1))
    held = docs.select(F.explode(terms(F.col(text_col))).alias("term")).groupBy(slot.alias("slot")).agg(
        F.count("*").alias("documents")
    )
    most = n * math.exp(-LOWEST_IDF)
    band = held.where((F.col("documents") >= FEWEST_DOCUMENTS) & (F.col("documents") <= max(most, FEWEST_DOCUMENTS)))
    bit = F.expr("shiftleft(1L, cast(slot & 63 as int))")
    found = band.groupBy(F.expr("cast(slot >> 6 as int)").alias("word")).agg(F.bit_or(bit).alias("bits"))
    bitmap = [0] * (1 << (SLOT_BITS - 6))
    for row in found.collect():  # at most 2 ** (SLOT_BITS - 6) rows
        bitmap[row.word] = row.bits
    return bitmap


def _in_lexicon(term: Column, bitmap: Column) -> Column:
    slot = term.bitwiseAND(F.lit((1 << SLOT_BITS) - 1))
    word = F.get(bitmap, F.shiftrightunsigned(slot, 6).cast("int"))
    return F.bit_get(word, slot.bitwiseAND(F.lit(63)).cast("int")) == 1


def _digest(chosen: Column) -> Column:
    code = F.lpad(F.lower(F.hex(F.xxhash64(F.array_sort(chosen)).bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")
    return F.when(F.size(chosen) > 0, code).otherwise(NONE)


def _sampled(kept: Column, mask: Column, seed: int | Column) -> Column:
    """The terms in subset `seed`, one of mask + 1 (a power of two): those bits of a hash of theirs are zero."""
    seed = F.lit(seed) if isinstance(seed, int) else seed
    return F.filter(kept, lambda t: F.xxhash64(seed, t).bitwiseAND(mask) == 0)


def with_fingerprint(rows: DataFrame, text_col: str, bitmap: list[int], name: str = "fingerprint") -> DataFrame:
    """Adds `name`: struct of whole (hash of all kept terms), level, near and far (hashes by subset).

    A text without any term in the lexicon is described by all its terms; a text without words, a null one
    included, has level -1 and no hashes. Equal texts get equal fingerprints.
    """
    # One literal, folded to an array when the query is planned.
    bits = F.split(F.lit(",".join(map(str, bitmap))), ",").cast("array<bigint>")
    every = rows.withColumn("_every", terms(F.col(text_col)))
    return _described(every.withColumn("_band", F.filter("_every", lambda t: _in_lexicon(t, bits))), name)


def _described(banded: DataFrame, name: str) -> DataFrame:
    """Adds the fingerprint of rows with _every, their terms, and _band, those in the lexicon; drops both."""
    sized = _sized(banded)
    near = F.array(*[_sampled(F.col("_kept"), F.col("_mask"), j) for j in range(SUBSETS)])
    return _digested(sized.withColumn("_near", near), name).drop("_kept", "_near")


def _sized(banded: DataFrame) -> DataFrame:
    """_every and _band become _kept, the terms that describe the text, with their _level and _mask."""
    kept = F.when(F.size("_band") > 0, F.col("_band")).otherwise(F.col("_every"))
    sized = banded.withColumn("_kept", kept).withColumn(
        "_level", F.when(F.size("_kept") > 0, F.floor(F.log(4.0, F.size("_kept").cast("double")) + 1e-9)).otherwise(-1).cast("int")
    )
    mask = F.pow(F.lit(4.0), F.greatest("_level", F.lit(0))).cast("long") - 1
    return sized.withColumn("_mask", mask).drop("_every", "_band")


def _digested(sampled: DataFrame, name: str) -> DataFrame:
    """Adds the fingerprint of rows sized and sampled; drops _level and _mask."""
    sampled = sampled.withColumn("_far_mask", 4 * F.col("_mask") + 3)
    far = F.transform("_near", lambda chosen, j: _sampled(chosen, F.col("_far_mask"), j))
    found = F.struct(
        F.when(F.size("_kept") > 0, F.lower(F.hex(F.xxhash64(F.array_sort("_kept"))))).otherwise("").alias("whole"),
        F.col("_level").alias("level"),
        F.transform("_near", _digest).alias("near"),
        F.transform(far, _digest).alias("far"),
    )
    return sampled.withColumn(name, found).drop("_level", "_mask", "_far_mask")


def _described_beside(banded: DataFrame, name: str, own: str) -> DataFrame:
    """As _described, for a text much like the one whose fingerprint is `own`, of terms _own_kept sampled in _own_near.

    What a text's level samples holds all that a higher level does. So terms of both texts are taken from the
    other's samples, and only the others are sampled, unless the level is lower.
    """
    sized = _sized(banded)
    finer = F.col("_level") >= F.col(own)["level"]
    none = F.array().cast("array<bigint>")
    sized = sized.withColumns({
        "_new": F.when(finer, F.array_except("_kept", "_own_kept")).otherwise(F.col("_kept")),
        "_alive": F.when(finer, F.array_intersect(F.flatten("_own_near"), "_kept")).otherwise(none),
    })
    mask = F.col("_mask")

    def sample(j: int) -> Column:
        alive = F.filter(F.get("_own_near", F.lit(j)), lambda t: F.array_contains("_alive", t))
        return F.concat(_sampled(alive, mask, j), _sampled(F.col("_new"), mask, j))

    sampled = sized.withColumn("_near", F.array(*[sample(j) for j in range(SUBSETS)]))
    return _digested(sampled, name).drop("_kept", "_near", "_new", "_alive", "_own_kept", "_own_near")


#: What tells a row apart from others of its id: a 64-bit hash of id and text.
_ROW = ["doc_id", "k"]


def term_counts(docs: DataFrame) -> DataFrame:
    """term, documents, doc_id, k: every 64-bit term, how many documents hold it, and the row that does if it is one."""
    held = docs.select(*_ROW, F.explode(terms(F.col("text"))).alias("term"))
    counts = held.groupBy("term").agg(F.count("*").alias("documents"), *[F.min(c).alias(c) for c in _ROW])
    return cut(counts, "terms")


def _word_at_end(text: Column) -> Column:
    """The word, if any, that a text ends in. Looked for from the end, so that its length does not matter."""
    return F.reverse(F.regexp_extract(F.reverse(text), WORD_AT_START, 0))


def _cut_words(text: str, following: str) -> Column:
    """The two words that the edit can make: at the seam, and at its end."""
    third = _third(F.col(text))
    kept = F.substr(F.col(text), F.lit(1), F.char_length(text) - third)
    head = F.substr(F.col(following), F.lit(1), third)
    seam = F.concat(_word_at_end(kept), F.regexp_extract(head, WORD_AT_START, 0))
    # A head that is one word is part of the seam; its own end is then no word of the text, and harmless.
    return F.array_distinct(F.concat(terms(seam), terms(_word_at_end(head))))


def _neighbours(docs: DataFrame, aside: list[DataFrame]) -> DataFrame:
    """p, again, doc_id, k, text, single, known: the rows dealt and marked as in with_next, ready for its order.

    What was found about rows, tables of (doc_id, k) and a list, is sent to the ranges of ids that the rows go to and
    handed over there: the texts are moved once.
    """
    nothing = F.lit(None).cast("array<bigint>")
    rows = docs.select(*_ROW, "text", nothing.alias("single"), nothing.alias("known"), F.lit(1).alias("kind"))
    for found in aside:
        lists = [(F.col(c) if c in found.columns else nothing).alias(c) for c in ("single", "known")]
        rows = rows.unionByName(found.select(*_ROW, F.lit(None).cast("string").alias("text"), *lists, F.lit(0).alias("kind")))
    sent = _dealt(rows, docs, "doc_id").select(*rows.columns, F.col("_place.p").alias("p"), F.col("_place.again").alias("again"))
    own = Window.partitionBy("p", "again", *_ROW).orderBy("kind")
    empty = F.array().cast("array<bigint>")
    handed = {c: F.coalesce(F.last(c, ignorenulls=True).over(own), empty) for c in ("single", "known")}
    return sent.repartition("p").withColumns(handed).where("kind = 1").drop("kind")


def _leading(rows: DataFrame, carried: list[str]) -> DataFrame:
    order = Window.partitionBy("p").orderBy("again", F.col("doc_id").desc_nulls_last(), F.col("text").desc_nulls_last())
    return rows.withColumns({f"next_{c}": F.lead(c).over(order) for c in carried}).where("not again").drop("p", "again")


def with_edited_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, own, near_next, changed, edited of rows of doc_id and text, over the exact lexicon of all of them.

    `changed` is the text with its end replaced by the beginning of the next row's, `edited` its fingerprint;
    near_next is the likeness to the next row.
    A term of one document is held by that row alone, so what its text lacks is sent to the row. Terms of too
    many documents are few, at most LOWEST_IDF's ten times the terms of an average text: one row of a table holds them.
    A first pass over neighbours finds the words that the cuts make, which are looked up among all terms.
    """
    docs = docs.withColumn("k", F.xxhash64("doc_id", "text"))
    most = max(docs.count() * math.exp(-LOWEST_IDF), FEWEST_DOCUMENTS)
    counts = term_counts(docs)
    often = counts.where(F.col("documents") > most).agg(F.collect_list("term").alias("often"))
    single = counts.where(F.col("documents") < FEWEST_DOCUMENTS).groupBy(*_ROW).agg(F.collect_list("term").alias("single"))
    band = counts.where((F.col("documents") >= FEWEST_DOCUMENTS) & (F.col("documents") <= most)).select("term")

    beside = _leading(_neighbours(docs, []), ["text"])
    made = cut(beside.select(*_ROW, F.explode(_cut_words("text", "next_text")).alias("term")).distinct(), "made")
    known = attach(made, band, ["term"], F.col("k"), "inner").groupBy(*_ROW).agg(F.collect_set("term").alias("known"))
    known = cut(known, "known")
    del beside, made
    let_go(docs.sparkSession)

    rows = _neighbours(docs, [single, known]).crossJoin(F.broadcast(often))
    rows = rows.withColumn("_every", terms(F.col("text")))
    rows = _sized(rows.withColumn("_band", F.array_except(F.array_except("_every", "often"), "single")))
    near = F.array(*[_sampled(F.col("_kept"), F.col("_mask"), j) for j in range(SUBSETS)])
    rows = _digested(rows.withColumn("_near", near), "own")
    rows = rows.withColumnsRenamed({"_kept": "_own_kept", "_near": "_own_near"})
    rows = _leading(rows, ["text", "own", "single"])
    rows = rows.withColumn("cut_words", _cut_words("text", "next_text"))
    rows = rows.withColumn("changed", edited("text", "next_text")).withColumn("_every", terms(F.col("changed")))
    of_texts = F.array_except(F.array_except("_every", "cut_words"), "often")
    of_texts = F.array_except(of_texts, F.concat("single", "next_single"))
    of_cuts = F.array_intersect(F.array_intersect("_every", "cut_words"), "known")
    rows = rows.withColumn("_band", F.concat(of_texts, of_cuts)).withColumn("near_next", likeness("own", "next_own"))
    return _described_beside(rows, "edited", "own").select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), "own", "near_next", "changed", "edited"
    )


def as_text(fingerprint: str) -> Column:
    """The fingerprint as one string: whole hash, level, hashes by subset of two levels."""
    f = F.col(fingerprint)
    return F.concat_ws(
        ":", f["whole"], f["level"].cast("string"), F.array_join(f["near"], ""), F.array_join(f["far"], "")
    )


def _share(a: Column, b: Column) -> Column:
    both = F.zip_with(a, b, lambda x, y: F.when((x == NONE) & (y == NONE), 0).when(x == y, 2).otherwise(1))
    used = F.size(F.filter(both, lambda v: v > 0))
    return F.when(used > 0, F.size(F.filter(both, lambda v: v == 2)) / used).otherwise(F.lit(0.0))


def likeness(left: str, right: str) -> Column:
    """Share of subsets that agree, of those not empty in both, at the better of the common levels.

    Equal whole hashes are 1, two texts without words as well. Without a common level, a text having
    sixteen times the terms of the other, it is 0.
    """
    a, b = F.col(left), F.col(right)
    gap = a["level"] - b["level"]
    share = (
        F.when(gap == 0, F.greatest(_share(a["near"], b["near"]), _share(a["far"], b["far"])))
        .when(gap == 1, _share(a["near"], b["far"]))
        .when(gap == -1, _share(a["far"], b["near"]))
        .otherwise(F.lit(0.0))
    )
    return F.when(a["whole"] == b["whole"], F.lit(1.0)).when((a["level"] < 0) | (b["level"] < 0), F.lit(0.0)).otherwise(share)


def _part_of(docs: DataFrame, id_col: str) -> Column:
    """A number that grows with the id, dealing rows into parts of like sizes; null ids come lowest."""
    at = [(i + 1) / QUANTILES for i in range(QUANTILES - 1)]
    row = docs.agg(
        F.percentile_approx(id_col, at, 10_000).alias("bounds"), F.count(id_col).alias("n"),
        F.min(id_col).alias("lowest"), F.max(id_col).alias("highest"),
    ).first()
    if not row.n:
        return F.lit(-1)
    bounds = sorted(set(row.bounds) - {row.highest})
    parts = min(MOST_PARTS, max(1, math.ceil(row.n / QUANTILES / ROWS_OF_PART)))
    lows, highs = F.lit([row.lowest - 1, *bounds]), F.lit([*bounds, row.highest])
    x = F.col(id_col)
    q = F.size(F.filter(F.lit([*bounds, row.highest]), lambda b: b < x))
    low, high = F.get(lows, q).cast("double"), F.get(highs, q).cast("double")
    inner = F.floor((x - low - 1) * parts / F.greatest(high - low, F.lit(1.0)))
    return F.when(x.isNull(), -1).otherwise(q * parts + F.least(F.greatest(inner, F.lit(0)), F.lit(parts - 1))).cast("int")


def _dealt(rows: DataFrame, docs: DataFrame, id_col: str) -> DataFrame:
    """rows with `_place`: the range of ids (p) of docs that each goes to; first ids of a range also go to the one before (again)."""
    part = _part_of(docs, id_col)
    heads = docs.select(id_col, part.alias("_part")).groupBy("_part").agg(F.max(id_col).alias("head")).collect()
    heads = sorted(((r["_part"], r["head"]) for r in heads), reverse=True)  # as many as there are parts
    to = [(part, heads[i - 1][0]) for i, (part, _) in enumerate(heads)]  # the first part's goes to the last
    lookup = rows.sparkSession.createDataFrame(
        [(part, head, target) for (part, head), (_, target) in zip(heads, to, strict=True)],
        f"_part int, _head {dict(rows.dtypes)[id_col]}, _to int",
    )
    marked = rows.withColumn("_part", part).join(F.broadcast(lookup), "_part")  # at most QUANTILES * MOST_PARTS + 1 rows
    first = F.col(id_col).eqNullSafe(F.col("_head"))
    places = F.array(F.struct(F.col("_part").alias("p"), F.lit(False).alias("again")))
    again = F.array(F.struct(F.col("_to").alias("p"), F.lit(True).alias("again")))
    return marked.withColumn("_place", F.explode(F.when(first, F.concat(places, again)).otherwise(places)))


def with_next(rows: DataFrame, id_col: str, carried: list[str]) -> DataFrame:
    """Adds next_<c> for each carried column: that of the next row by descending id; of the first after the last.

    Rows are dealt by ranges of ids and ordered within them. The first row of each range is also sent to
    the range before it. Rows that repeat an id follow each other by descending first carried column; null ids
    come last.
    """
    sent = _dealt(rows, rows, id_col)
    order = Window.partitionBy("_place.p").orderBy(
        F.col("_place.again"), F.col(id_col).desc_nulls_last(), F.col(carried[0]).desc_nulls_last()
    )
    ahead = sent.withColumns({f"next_{c}": F.lead(c).over(order) for c in carried})
    return ahead.where("not _place.again").drop("_part", "_head", "_to", "_place")


def _third(text: Column) -> Column:
    return F.floor(F.char_length(text) / 3).cast("int")


def edited(text: str, following: str) -> Column:
    """The text with its last third of code points replaced by as many of the beginning of another."""
    n, third = F.char_length(text), _third(F.col(text))
    return F.concat(F.substr(F.col(text), F.lit(1), (n - third)), F.substr(F.col(following), F.lit(1), third))
