"""Token ids of a corpus as compressed, checksummed files, and reading them back.

Texts are encoded where they lie and their ids are stored once. Documents are then numbered through in order of
their id by prefix sums of lengths over ranges of ids, a table of a fixed number of rows, and cut into files of
about FILE_IDS ids. A task sorts and packs one file after the other; documents are never cut. Reading is a map over the files.

A file is: its magic, how many ids lie before it, the number of documents, their lengths as packed ids,
their ids of all documents as packed ids (`range_coder`). Files are the rows of a Parquet table, so that every
file system Spark reaches can hold them, and a task that is repeated replaces its own files alone.
"""

from __future__ import annotations

import json
import os
import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leaguelake.llm import range_coder
from leaguelake.llm.common import in_tasks
from leaguelake.sources.store import cut

#: Ids of one file, up to the end of the document that reaches them.
FILE_IDS = 6 << 20
#: Ranges of ids; where an id fills one, ranges of its texts; where a text fills one, parts by row.
ID_RANGES = 256
TEXT_RANGES = 32
ROW_WAYS = 64
#: Words whose ids a worker remembers, the bound of its memory (some 250 MB).
CACHE_WORDS = 1_000_000
#: Bytes of text looked up together.
GROUP_BYTES = 10 << 20

_MAGIC = b"TOKF"
_HEAD = struct.Struct("<4sQQI")
# Fixed value: the split pattern of tokenizers that drop white space, as written in their files.
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Characters that the tokenizer lower-cases one by one, as Python does, and composes with nothing: printable ASCII
#: and the Latin letters up to U+017F but one, whose lower case is two characters.
_PLAIN = re.compile("[\x21-\x7e\xa1-\u012f\u0131-\u017f]*").fullmatch
_PLAIN_PARTS = re.compile("[\x20-\x7e\xa1-\u012f\u0131-\u017f]*").fullmatch


def _plain_split(pattern: str) -> str:
    """A split pattern for plain text alone: its classes of Unicode written out, which takes half the time."""
    plain = [c for c in map(chr, range(0x180)) if _PLAIN(c)]
    for name in "LN":
        of_class = "".join(re.escape(c) for c in plain if unicodedata.category(c)[0] == name)
        pattern = pattern.replace(f"[\\p{{{name}}}]", f"[{of_class}]").replace(f"\\p{{{name}}}", of_class)
    return pattern


class WordEncoder:
    """Ids by the tokenizers library, remembered by word where blanks separate parts of a text for certain.

    That is so for files that drop white space by WORD_SPLIT and mark the last token of every word; other
    tokenizers get every text whole. Of many texts together every part is looked at once. Parts of plain letters
    are encoded word by word, so that a word is encoded once however it is written and whatever follows it.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        # Pieces of plain parts that blanks separate; the blanks are kept.
        self.pieces = re.compile(_plain_split(WORD_SPLIT) + "| ").findall

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self.in_parts = self._separable(described)
        # Words are split, lower-cased and composed already: what is left of the tokenizer.
        self.bare = Tokenizer(self.tokenizer.model)
        self.bare.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        special = [re.escape(t["content"]) for t in described["added_tokens"]]
        self.is_special = re.compile("|".join(special)).search if special else lambda part: None
        self.closing = closing_ids(path)
        self._forget()

    def _forget(self) -> None:
        """Nothing is known but the blank, which has no ids."""
        self.words: dict[str, int] = {" ": 0}
        self.starts, self.sizes, self.ids = np.zeros(1, np.int64), np.zeros(1, np.int64), np.empty(0, np.uint32)

    @staticmethod
    def _separable(described: dict) -> bool:
        split, *rest = (described.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        steps = [n["type"] for n in (described.get("normalizer") or {}).get("normalizers", [])]
        plain = all(not t["lstrip"] and not t["rstrip"] and not t["single_word"] and not re.search(r"\s", t["content"])
                    for t in described["added_tokens"])
        return (
            split.get("type") == "Split" and split.get("behavior") == "Removed" and split.get("invert") is True
            and split.get("pattern", {}).get("Regex") == WORD_SPLIT and steps == ["NFC", "Replace", "Lowercase"]
            and [(s["type"], s.get("add_prefix_space"), s.get("use_regex")) for s in rest] == [("ByteLevel", False, False)]
            and bool(described["model"].get("end_of_word_suffix")) and plain
        )

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes

    def _remember(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.words.update(zip(words, range(len(self.starts), len(self.starts) + len(words)), strict=True))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.ids = np.concatenate([self.ids, ids])

    def _learn_words(self, words: list[str]) -> None:
        """Encodes words many at a time; each ends with the token that closes it."""
        many = 400
        for i in range(0, len(words), 64 * many):
            some = words[i : i + 64 * many]
            joined = [" ".join(some[j : j + many]) for j in range(0, len(some), many)]
            found = [e.ids for e in self.bare.encode_batch_fast(joined, add_special_tokens=False)]
            ids = np.fromiter(chain.from_iterable(found), np.uint32, sum(map(len, found)))
            sizes = np.diff(np.flatnonzero(self.closing[ids]), prepend=-1)
            if len(sizes) != len(some) or sizes.sum() != len(ids):
                ids, sizes = self._whole(some)
            self._remember(some, ids, sizes)

    def _parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """ids of all parts one after the other, and how many each has."""
        if len(self.words) > CACHE_WORDS:
            self._forget()
        text, odd = " ".join(parts), []
        # Special strings are found before anything is lower-cased.
        special = self.is_special(text)
        if special or not _PLAIN_PARTS(text):
            plain = [bool(_PLAIN(p)) and not (special and self.is_special(p)) for p in parts]
            odd = [p for p, is_plain in zip(parts, plain, strict=True) if not is_plain]
            new = list(set(odd) - self.words.keys())
            for i in range(0, len(new), 4096):
                self._remember(new[i : i + 4096], *self._whole(new[i : i + 4096]))
            # Of an odd part only the place is kept.
            text = " ".join([p if is_plain else "" for p, is_plain in zip(parts, plain, strict=True)])
        pieces = self.pieces(text.lower())
        self._learn_words(list(set(pieces) - self.words.keys()))
        known = self.words.__getitem__
        numbers = np.fromiter(map(known, pieces), np.int64, len(pieces))
        blanks = numbers == 0
        sizes = np.bincount(np.cumsum(blanks), self.sizes[numbers], len(parts)).astype(np.int64)
        if odd:
            at = np.flatnonzero(~np.array(plain))
            of_odd = np.fromiter(map(known, odd), np.int64, len(odd))
            sizes[at] = self.sizes[of_odd]
            # An odd part comes behind the blank before it; the first part has none.
            numbers = np.insert(numbers, np.concatenate([[0], np.flatnonzero(blanks) + 1])[at], of_odd)
        return self.ids[_stretches(self.starts[numbers], self.sizes[numbers])], sizes

    def encode_column(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """ids of all texts one after the other, each with `end` behind it, and how many each has; null is empty."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        behind = np.array([] if end is None else [end], np.uint32)
        if not self.in_parts:
            ids, sizes = self._whole(texts.to_pylist())
            at = np.cumsum(sizes)
            return np.insert(ids, np.repeat(at, len(behind)), np.tile(behind, len(at))), sizes + len(behind)
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        edges = split.offsets.to_numpy().astype(np.int64)
        coded = split.values.slice(edges[0], edges[-1] - edges[0]).dictionary_encode()
        edges -= edges[0]
        ids, sizes = self._parts(coded.dictionary.to_pylist())
        starts = np.append(np.cumsum(sizes) - sizes, len(ids))
        sizes, ids = np.append(sizes, len(behind)), np.concatenate([ids, behind])
        # What ends a text counts as a part of its own.
        of = np.insert(coded.indices.to_numpy(), edges[1:], len(sizes) - 1)
        long = sizes[of]
        total = np.concatenate([[0], np.cumsum(long)])
        return ids[_stretches(starts[of], long)], np.diff(total[edges + np.arange(len(edges))])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each whole text."""
        ids, sizes = self.encode_column(pa.array(texts, pa.string()))
        raw, ends = ids.astype("<u4").tobytes(), 4 * np.cumsum(sizes)
        return [raw[e - 4 * n : e] for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]


def _stretches(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all stretches, one after the other."""
    total = int(sizes.sum())
    places = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    places += np.arange(total)
    return places


@cache
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


@cache
def closing_ids(path: str) -> np.ndarray:
    """By id: whether its token closes a word; never where the tokenizer does not mark that."""
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    suffix = described["model"].get("end_of_word_suffix")
    vocabulary = described["model"]["vocab"]
    last = max([*vocabulary.values(), *(t["id"] for t in described["added_tokens"])], default=0)
    closing = np.zeros(1 + last, bool)
    closing[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
    return closing


# ---- encoding -------------------------------------------------------------------------------


def encoded(docs: DataFrame, path: str, end_id: int | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, h, way, n, ids of every row: its ids with end_id behind them, and what orders rows of one id.

    Null texts are empty. Ids of rows are whole numbers or null; the share of one beyond 2 ** 53 is not spread. h is a
    hash of the text that doubles, in which quantiles are taken, hold exactly; way, a number of the row, tells
    equal rows apart. ids is stored in 16 bits each where those of its group all fit.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_encoder(path).encode_column
        for batch in batches:
            for some in _groups(batch):
                ids, sizes = encode(some.column("text"), end_id)
                stored = ids.astype("<u2" if not len(ids) or ids.max() < 1 << 16 else "<u4")
                edges = np.concatenate([[0], np.cumsum(sizes)]) * stored.itemsize
                binary = pa.Array.from_buffers(
                    pa.large_binary(), len(sizes), [None, pa.py_buffer(edges), pa.py_buffer(stored)]
                ).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [some.column("id"), some.column("h"), some.column("way"), pa.array(sizes, pa.int64()), binary],
                    ["id", "h", "way", "n", "ids"],
                )

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).select(
        "id", "text", F.shiftright(F.xxhash64("text"), 16).alias("h"), F.xxhash64(F.monotonically_increasing_id()).alias("way")
    )
    schema = f"id {dict(rows.dtypes)['id']}, h bigint, way bigint, n bigint, ids binary"
    return cut(in_tasks(rows, run, schema), "tokens")


def _groups(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, so many at a time that their texts have some GROUP_BYTES bytes."""
    if not batch.num_rows:
        return
    size = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64))
    opens = np.flatnonzero(np.diff(size // GROUP_BYTES, prepend=-1))
    for a, b in zip(opens, [*opens[1:], batch.num_rows], strict=True):
        yield batch.slice(a, b - a)


def _loaded(stored: bytes, n: int) -> np.ndarray:
    return np.frombuffer(stored, "<u2" if len(stored) == 2 * n else "<u4")


# ---- order ----------------------------------------------------------------------------------


def _bounds(rows: DataFrame, column: str, ranges: int) -> list[int]:
    at = [(i + 1) / ranges for i in range(ranges - 1)]
    return sorted(set(rows.agg(F.percentile_approx(column, at, 10_000).alias("b")).first()["b"] or []))


def _span(column: str, bounds: list[int]) -> tuple[Column, Column]:
    """A number that grows with the column, and whether the value is a bound and has that number for itself."""
    if not bounds:
        return F.lit(0), F.lit(False)
    on = F.coalesce(F.array_contains(F.lit(bounds), F.col(column)), F.lit(False))
    return 2 * F.size(F.filter(F.lit(bounds), lambda b: b < F.col(column))) + on.cast("int"), on


def _stretch(tokens: DataFrame) -> Column:
    """The stretch of a row: a number that grows with (id, h, way). Null ids come first.

    Ranges are cut at quantiles. An id that many rows share is a quantile and is cut by its texts, a text that
    many of these share by row; so no stretch holds more than a small share of the rows.
    """
    of_id, shared = _span("id", _bounds(tokens, "id", ID_RANGES))
    crowded = shared | F.col("id").isNull()
    of_text, repeated = _span("h", _bounds(tokens.where(crowded), "h", TEXT_RANGES))
    way = F.when(repeated, F.shiftrightunsigned("way", 65 - ROW_WAYS.bit_length())).otherwise(0)
    within = F.when(crowded, of_text * ROW_WAYS + way).otherwise(0)
    of_id = F.when(F.col("id").isNull(), 0).otherwise(of_id + 1).cast("long")
    return of_id * (2 * TEXT_RANGES * ROW_WAYS) + within


def placed(tokens: DataFrame) -> DataFrame:
    """tokens with `stretch`, `before`, the ids before its stretch, and `file`, the file it goes to."""
    dealt = tokens.withColumn("stretch", _stretch(tokens))
    # At most 4 * ID_RANGES * TEXT_RANGES * ROW_WAYS rows (two million) whatever the corpus, as a rule 2 * ID_RANGES:
    # they are numbered in one task and broadcast.
    sizes = dealt.groupBy("stretch").agg(F.sum("n").alias("size"))
    before = F.sum("size").over(Window.orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1))
    stretches = sizes.select("stretch", F.coalesce(before, F.lit(0)).alias("before"))
    stretches = cut(stretches.withColumn("file", F.expr(f"before div {FILE_IDS}")), "stretches")
    return dealt.join(F.broadcast(stretches), "stretch")


# ---- files ----------------------------------------------------------------------------------


def pack_file(before: int, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    sizes = range_coder.pack(lengths)
    return b"".join([_HEAD.pack(_MAGIC, before, len(lengths), len(sizes)), sizes, range_coder.pack(ids)])


def unpack_file(data: bytes) -> tuple[int, np.ndarray, np.ndarray]:
    """How many ids lie before the file, the lengths of its documents, and their ids."""
    if len(data) < _HEAD.size or data[:4] != _MAGIC:
        raise range_coder.CorruptBlock("not a token file")
    _, before, count, size = _HEAD.unpack_from(data)
    edge = _HEAD.size + size
    lengths, ids = range_coder.unpack(data[_HEAD.size : edge]), range_coder.unpack(data[edge:])
    if len(lengths) != count or int(lengths.sum()) != len(ids):
        raise range_coder.CorruptBlock("the lengths of the documents do not fit their ids")
    return before, lengths.astype(np.int64), ids


def write_files(tokens: DataFrame, path: str) -> None:
    """Writes rows of `encoded` as files below path: `before`, the ids of its documents, and `data`.

    Documents of one file lie side by side in one task, which closes a file at FILE_IDS ids.
    """
    rows = placed(tokens)
    files = 1 + (rows.agg(F.max("file")).first()[0] or 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_encoder.cache_clear()  # texts are all encoded by now; a worker may have been one that did
        names: list = []
        id_type = None
        held: list[np.ndarray] = []
        size, file, stretch, after = 0, None, None, 0

        def closed() -> pa.RecordBatch:
            lengths = np.array([len(a) for a in held], np.int64)
            ids = np.concatenate(held) if held else np.empty(0, np.uint16)
            data = pack_file(after - size, lengths, ids)
            ids_of = pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), pa.array(names, id_type))
            return pa.RecordBatch.from_arrays(
                [pa.array([after - size], pa.int64()), ids_of, pa.array([data], pa.large_binary()).cast(pa.binary())],
                ["before", "doc_ids", "data"],
            )

        for batch in batches:
            id_type = batch.schema.field("id").type
            columns = zip(*(batch.column(c).to_pylist() for c in ("file", "stretch", "before", "id", "n", "ids")), strict=True)
            for its_file, its_stretch, before, name, n, stored in columns:
                if names and (its_file != file or size >= FILE_IDS):
                    yield closed()
                    names, held, size = [], [], 0
                if its_stretch != stretch:
                    after = before
                file, stretch = its_file, its_stretch
                ids = _loaded(stored, n)
                names.append(name)
                held.append(ids)
                size += len(ids)
                after += len(ids)
        if names:
            yield closed()

    ordered = rows.repartition(files, "file").sortWithinPartitions("file", "stretch", "id", "h", "way")
    schema = f"before bigint, doc_ids array<{dict(tokens.dtypes)['id']}>, data binary"
    columns = ordered.select("file", "stretch", "before", "id", "n", "ids")
    # One row each, so that a reading task holds no more than the bytes Spark gives it.
    in_tasks(columns, run, schema).write.options(compression="uncompressed", maxRecordsPerFile=1).parquet(path)


def read_files(files: DataFrame, ids: bool = False) -> DataFrame:
    """id, start, n, crc32 of every document in the files, and with `ids` its ids as well.

    Raises CorruptBlock if a block does not give the ids whose checksum it carries.
    """
    id_type = next(f.dataType.elementType for f in files.schema if f.name == "doc_ids").simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                names = batch.column("doc_ids")[i].values
                before, lengths, found = unpack_file(batch.column("data")[i].as_py())
                ends = np.cumsum(lengths)
                raw = found.astype("<u4")
                for a in range(0, len(lengths), 8192):
                    b = min(a + 8192, len(lengths))
                    pieces = [raw[e - n : e] for e, n in zip(ends[a:b], lengths[a:b], strict=True)]
                    columns = [
                        names.slice(a, b - a),
                        pa.array(before + ends[a:b] - lengths[a:b], pa.int64()),
                        pa.array(lengths[a:b], pa.int64()),
                        pa.array([zlib.crc32(p.tobytes()) for p in pieces], pa.int64()),
                    ]
                    labels = ["id", "start", "n", "crc32"]
                    if ids:
                        columns.append(pa.array([p.astype(np.int64) for p in pieces], pa.list_(pa.int64())))
                        labels.append("ids")
                    yield pa.RecordBatch.from_arrays(columns, labels)

    schema = f"id {id_type}, start bigint, n bigint, crc32 bigint" + (", ids array<bigint>" if ids else "")
    return in_tasks(files.select("doc_ids", "data"), run, schema)
