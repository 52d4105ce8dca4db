"""Near duplicates: MinHash samples folded into odd sketches, banded candidates, exact confirmation.

A text's set holds the distinct shingles of WIDTH words. MinHash samples of the set serve twice. Those of
many hash functions, cut into bands, name the buckets in which candidates meet. Those of one
function, the SAMPLES smallest values, are folded into a bitmap, each value toggling one bit: the odd
sketch. The differing bits of two sketches, counted with XOR and a population count, tell how many
samples differ, and for texts of up to SAMPLES shingles, where the sample is the set, never exceed the
true difference. Pairs whose sketches are too far apart for the wanted similarity are left; all others are
confirmed on the full sets, made anew from the whole texts.

Work is kept below all pairs of a group. Rows with the same words are one node. In a round every bucket that
holds nodes not yet known to be connected names as its centre the node that meets the most others in all its
buckets, as an original does among its edited copies; each node of the bucket outside the centre's component is
compared with it. After ROUNDS rounds few buckets are left. Among their nodes an exact filter takes over: sets this similar share
one of the rarest shingles of each, a prefix of each set in order of frequency. No pair that may link is left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leaguelake.llm.common import attach, grown, in_tasks, keep_rows, row_key
from leaguelake.llm.components import components
from leaguelake.llm.shingles import mix, shingle_set, word_hashes
from leaguelake.sources.store import cut, let_go

WIDTH = 5
#: Similarity from which texts are linked, in hundredths.
PERCENT = 75
#: 45 bands of 5 samples: a pair at 0.75 shares no bucket with a chance of (1 - 0.75**5) ** 45 = 5e-6.
BANDS = 45
BAND_ROWS = 5
SAMPLES = 512
SKETCH_BITS = 2048
#: Rounds of comparing with centres, before the rest is compared by rare shingles.
ROUNDS = 2
WORDS_OF_SKETCH = [f"s{i}" for i in range(SKETCH_BITS // 64)]

_SEED = np.random.default_rng(7)
_FACTORS = _SEED.integers(1, 1 << 63, (BANDS * BAND_ROWS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _SEED.integers(1, 1 << 63, (BANDS * BAND_ROWS, 1), dtype=np.uint64)
_BAND_INDEX = mix(np.arange(1, BANDS + 1, dtype=np.uint64) << np.uint64(32))
#: Shingles hashed at a time: the work area stays in cache and is the same for any text.
_CHUNK = 2048


def minhash(shingles: np.ndarray) -> np.ndarray:
    lowest = np.full(len(_FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), _CHUNK):
        np.minimum(lowest, (shingles[i : i + _CHUNK] * _FACTORS + _OFFSETS).min(axis=1), out=lowest)
    return lowest


def band_keys(samples: np.ndarray) -> np.ndarray:
    """One 64-bit bucket for each band."""
    keys = _BAND_INDEX.copy()
    for column in samples.reshape(BANDS, BAND_ROWS).T:
        keys = mix(keys ^ column)
    return keys.view(np.int64)


def odd_sketch(shingles: np.ndarray) -> np.ndarray:
    """The parity bitmap of the smallest of the sorted hashes, as 64-bit words."""
    bits = mix(shingles[:SAMPLES]) % np.uint64(SKETCH_BITS)
    odd = np.bincount(bits.astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def sketch_limit(a: Column, b: Column, sigmas: float = 5.5) -> Column:
    """Differing sketch bits up to which sets of a and b shingles may reach the similarity.

    At the threshold J the sets share J / (1 + J) (a + b). Of set sizes beyond SAMPLES only the part of
    the hash range below SAMPLES / size is sampled, so that the shared values between the two limits
    differ as well; the sampled number strays. D differing values leave m / 2 (1 - exp(-2 D / m)) odd
    bits on average, and never more than D.
    """
    j, m = PERCENT / 100, float(SKETCH_BITS)
    shared = (a + b) * (j / (1 + j))
    part_a, part_b = F.least(F.lit(1.0), SAMPLES / a), F.least(F.lit(1.0), SAMPLES / b)
    differ = (a - shared) * part_a + (b - shared) * part_b + shared * F.abs(part_a - part_b)
    differ = differ + sigmas * F.sqrt(2 * differ * (1 - F.least(part_a, part_b)))
    odd = m / 2 * (1 - F.exp(-2 * differ / m)) + sigmas * F.sqrt(F.least(2 * differ * differ / m, F.lit(m / 4))) + 1
    return F.least(differ, odd) + 1e-6


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sequences, sizes, bands, sketches = [], [], [], []
        for text in batch.column("text"):
            words = word_hashes(text.as_py() or "")
            shingles = shingle_set(words, WIDTH)
            sequences.append(hashlib.blake2b(words.tobytes(), digest_size=16).digest())
            sizes.append(len(shingles))
            if len(shingles):
                bands.append(band_keys(minhash(shingles)))
                sketches.append(odd_sketch(shingles))
            else:
                bands.append(np.empty(0, np.int64))
                sketches.append(np.zeros(len(WORDS_OF_SKETCH), np.int64))
        parts = np.cumsum([0, *map(len, bands)]).astype(np.int32)
        flat = np.concatenate(bands) if bands else np.empty(0, np.int64)
        columns = [
            batch.column("id"), batch.column("row_key"),
            pa.array(sequences, pa.binary()), pa.array(sizes, pa.int64()),
            pa.ListArray.from_arrays(pa.array(parts), pa.array(flat)),
        ]
        words_of = np.array(sketches, np.int64).reshape(-1, len(WORDS_OF_SKETCH))
        columns += [pa.array(words_of[:, i]) for i in range(len(WORDS_OF_SKETCH))]
        yield pa.RecordBatch.from_arrays(columns, ["id", "row_key", "sequence", "n", "bands", *WORDS_OF_SKETCH])


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keeps the pairs whose full sets reach the similarity; they come sorted by v."""
    for batch in batches:
        keep, last, second = [], None, np.empty(0, np.uint64)
        for i, centre in enumerate(batch.column("v").to_pylist()):
            if centre != last:
                last, second = centre, shingle_set(word_hashes(batch.column("text_v")[i].as_py()), WIDTH)
            first = shingle_set(word_hashes(batch.column("text_u")[i].as_py()), WIDTH)
            shared = len(np.intersect1d(first, second, assume_unique=True))
            if 100 * shared >= PERCENT * (len(first) + len(second) - shared):
                keep.append(i)
        yield pa.RecordBatch.from_arrays(
            [batch.column("u").take(pa.array(keep, pa.int64())), batch.column("v").take(pa.array(keep, pa.int64()))],
            ["u", "v"],
        )


ABOUT = ["n", *WORDS_OF_SKETCH]


def _differing() -> Column:
    return sum((F.bit_count(F.col(f"a.{s}").bitwiseXOR(F.col(f"b.{s}"))) for s in WORDS_OF_SKETCH), F.lit(0))


def _may_link() -> Column:
    """Size bounds and the sketch: what a linked pair satisfies."""
    sizes = (100 * F.col("a.n") >= PERCENT * F.col("b.n")) & (100 * F.col("b.n") >= PERCENT * F.col("a.n"))
    return sizes & (_differing() <= sketch_limit(F.col("a.n"), F.col("b.n")))


def _about(nodes: DataFrame, node: str, side: str) -> DataFrame:
    """What is known of a node, as the struct `side`."""
    return nodes.select(F.col("node").alias(node), F.struct(*ABOUT).alias(side))


def _texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node and text of the given nodes, each by the row that stands for it. Read and moved once."""
    keyed = docs.select("text", F.col("row_key.a").alias("ka"), F.col("row_key.b").alias("kb"))
    wanted = nodes.select("node", F.col("row_key.a").alias("ka"), F.col("row_key.b").alias("kb"))
    found = keyed.join(grown(wanted), ["ka", "kb"]).dropDuplicates(["ka", "kb"])
    return cut(found.select("node", "text"), "texts")


def _confirm(pairs: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (u, v) that are links by their whole texts; size and sketch are looked at first.

    The pairs of one v, which may be the centre of a large group, are dealt into parts.
    """
    known = pairs.join(grown(_about(nodes, "u", "a")), "u")
    known = attach(known, _about(nodes, "v", "b"), ["v"], F.col("u"), "inner", both_grow=True).where(_may_link())
    near = cut(known.select("u", "v"), "pairs")
    both = near.join(grown(texts.select(F.col("node").alias("u"), F.col("text").alias("text_u"))), "u")
    of_v = texts.select(F.col("node").alias("v"), F.col("text").alias("text_v"))
    both = attach(both, of_v, ["v"], F.col("u"), "inner", both_grow=True)
    return cut(in_tasks(both.select("u", "v", "text_u", "text_v"), _confirmed, "u bigint, v bigint"), "links")


def _labels(links: DataFrame) -> DataFrame:
    """node, label: the smallest node within three links. Nodes of one label are connected for certain."""
    ways = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    label = ways.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("label"))
    for _ in range(2):
        of = label.select(F.col("node").alias("v"), F.col("label").alias("m"))
        step = ways.join(grown(of), "v").groupBy("u").agg(F.min("m").alias("m")).withColumnRenamed("u", "node")
        label = cut(label.join(grown(step), "node").select("node", F.least("label", "m").alias("label")), "labels")
    return label


def _labelled(rows: DataFrame, links: DataFrame | None) -> DataFrame:
    if links is None:
        return rows.withColumn("label", F.col("node"))
    return rows.join(grown(_labels(links)), "node", "left").withColumn("label", F.coalesce("label", "node"))


def _open(rows: DataFrame) -> DataFrame:
    """The rows of buckets that hold more than one label."""
    mixed = rows.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi")
    return attach(rows, mixed.select("bucket"), ["bucket"], F.col("node"), "inner", both_grow=True)


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node and shingle of every text."""
    for batch in batches:
        for node, text in zip(batch.column("node"), batch.column("text"), strict=True):
            shingles = shingle_set(word_hashes(text.as_py()), WIDTH).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(shingles), node.as_py())), pa.array(shingles)], ["node", "shingle"]
            )


def _by_rare_shingles(rows: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs of nodes of different labels that share a shingle of their prefixes.

    Linked sets of n <= m shingles share at least J / (1 + J) (n + m), which is no less than 2 J / (1 + J) n and J m.
    Taken in one order, here the rarest first, their first common shingle is then among the first n - 2 J / (1 + J) n + 1
    of the smaller and m - J m + 1 of the larger set, and enough shingles follow it in both.
    """
    left = cut(rows.select("node", "label").distinct(), "left")
    wanted = texts.join(grown(left.select("node")), "node").select("node", "text")
    held = cut(in_tasks(wanted, _prefixes, "node bigint, shingle bigint"), "shingles")
    often = held.groupBy("shingle").agg(F.count("*").alias("often")).where("often > 1")
    # A shingle that one node holds is rarer than any other: it takes a place but is compared with nothing.
    placed = attach(held, often, ["shingle"], F.col("node"), both_grow=True).withColumn("often", F.coalesce("often", F.lit(1)))
    order = F.row_number().over(Window.partitionBy("node").orderBy("often", "shingle"))
    sized = placed.withColumn("place", order).where("often > 1")
    sized = sized.join(grown(nodes.select("node", "n")), "node").join(grown(left), "node")
    sized = sized.select("shingle", "node", "label", "n", "place")
    probe = cut(sized.where(f"place <= n - ({PERCENT} * n + 99) div 100 + 1"), "prefixes")
    index = probe.where(f"place <= n - ({2 * PERCENT} * n + {99 + PERCENT}) div {100 + PERCENT} + 1")
    ordered = "a.shingle = b.shingle AND a.label <> b.label AND (a.n < b.n OR (a.n = b.n AND a.node < b.node))"
    enough = f"{100 + PERCENT} * (1 + least(a.n - a.place, b.n - b.place)) >= {PERCENT} * (a.n + b.n)"
    pairs = index.alias("a").join(grown(probe).alias("b"), F.expr(f"{ordered} AND {enough}"))
    return pairs.select(F.col("a.node").alias("u"), F.col("b.node").alias("v")).distinct()


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: id, row_key, n_shingles, component_id, kept.

    component_id is the smallest id that links reach, the row's own included; kept marks the row with
    that id. Texts without words (null, empty, white space) link with nothing, not even each other.
    Rows with the same words are one node; rows that repeat an id and text get the same decision. Null
    ids count only where a group has no other. Other columns are not read, whatever their names.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("row_key", row_key("id", "text"))
    id_type = dict(rows.dtypes)["id"]
    schema = (
        f"id {id_type}, row_key struct<a:bigint,b:bigint>, sequence binary, n bigint, bands array<bigint>, "
        + ", ".join(f"{s} bigint" for s in WORDS_OF_SKETCH)
    )
    signed = cut(in_tasks(rows, _signatures, schema), "signatures")

    # Rows with the same words are one node, numbered when the table is written.
    by_words = signed.where("n > 0").groupBy("sequence").agg(
        F.min("id").alias("id"), F.min("row_key").alias("row_key"), F.min("n").alias("n"),
        F.min("bands").alias("bands"), *[F.min(s).alias(s) for s in WORDS_OF_SKETCH],
    )
    nodes = cut(by_words.withColumn("node", F.monotonically_increasing_id()), "nodes")
    spots = nodes.select(F.explode("bands").alias("bucket"), "node")
    crowds = spots.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    shared = cut(attach(spots, crowds, ["bucket"], F.col("node"), "inner", both_grow=True), "buckets")
    meets = shared.groupBy("node").agg(F.sum("members").alias("meets"))
    left = cut(shared.select("bucket", "node").join(grown(meets), "node"), "spots")
    texts = _texts(rows, nodes.join(grown(meets.select("node")), "node", "left_semi"))

    links: DataFrame | None = None
    for _ in range(ROUNDS):
        still = cut(_open(_labelled(left, links)), "open")
        if still.isEmpty():
            break
        centres = still.groupBy("bucket").agg(F.max(F.struct("meets", "node", "label")).alias("centre"))
        met = attach(still, centres, ["bucket"], F.col("node"), "inner", both_grow=True)
        pairs = met.where("label <> centre.label").select(F.col("node").alias("u"), F.col("centre.node").alias("v")).distinct()
        found = _confirm(pairs, nodes, texts)
        links = found if links is None else links.unionByName(found)
        # A centre has now been compared with all of its bucket.
        left = met.where("node <> centre.node").select("bucket", "node", "meets")
        let_go(docs.sparkSession)
    else:
        still = cut(_open(_labelled(left, links)), "open")
        if not still.isEmpty():
            links = links.unionByName(_confirm(_by_rare_shingles(still, nodes, texts), nodes, texts))
    let_go(docs.sparkSession)
    first = components(links if links is not None else nodes.select(F.col("node").alias("u"), F.col("node").alias("v")).limit(0))

    grouped = nodes.select("node", "id").join(grown(first), "node", "left").withColumn("root", F.coalesce("root", "node"))
    lowest = grouped.groupBy("root").agg(F.min("id").alias("component_id"))
    of_node = attach(grouped.select("node", "root"), lowest, ["root"], F.col("node"), both_grow=True)
    of_words = nodes.select("sequence", "node").join(grown(of_node.select("node", "component_id")), "node").drop("node")
    rows = signed.select("id", "row_key", "sequence", "n")
    members = attach(rows, of_words, ["sequence"], F.col("row_key"), both_grow=True)
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return members.select(
        "id", "row_key", F.col("n").alias("n_shingles"), own.alias("component_id"),
        F.col("id").eqNullSafe(own).alias("kept"),
    )


def kept_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with the smallest id of their group, with all columns; a repeated row stays once."""
    kept = near_groups(docs, id_col, text_col).where("kept").select("row_key")
    return keep_rows(docs, kept, id_col, text_col)
