"""Range coder: exact round trips and damaged blocks. Token files against the tokenizers library."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from helpers import odd_documents
from hypothesis import given, settings
from hypothesis import strategies as st
from leaguelake.llm import range_coder, token_files
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")
FOLDER = "/root/testdata/sf0.001"


def _ids(text: str | None, path: str = PATH) -> list[int]:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.integers(0, 12) | st.integers(0, range_coder.MAX_ID), max_size=700),
    st.sampled_from([1, 7, 64, 65, 200, 8192]),
)
def test_ids_come_back(ids, block):
    ids = np.array(ids, np.uint32)
    assert range_coder.unpack(range_coder.pack(ids, block)).tolist() == ids.tolist()


@pytest.mark.parametrize("block", [512, 5000])
@pytest.mark.parametrize("most", [1, 2, 300, 65535, 65536, range_coder.MAX_ID])
def test_skewed_ids_come_back_smaller(block, most):
    random = np.random.default_rng(most)
    ids = (random.zipf(1.4, 30_000).astype(np.uint64) % most).astype(np.uint32)
    ids[5000:15000] = ids[15000:25000]
    packed = range_coder.pack(ids, block)
    assert range_coder.unpack(packed).tolist() == ids.tolist()
    assert len(packed) < len(ids) * 4


def test_repeated_phrases_cost_little():
    phrase = np.random.default_rng(1).integers(0, 50_000, 40)
    packed = range_coder.pack(np.tile(phrase, 400))
    assert len(packed) < 400 * 40 * 2 / 20


def test_blocks_do_not_need_each_other():
    ids = np.random.default_rng(3).integers(0, 900, 4000).astype(np.uint32)
    alone = [range_coder.pack(ids[i : i + 1000], 1000) for i in range(0, 4000, 1000)]
    together = range_coder.pack(ids, 1000)
    head = 24
    for i, one in enumerate(alone):
        table = np.frombuffer(together, "<u4", 8, head).reshape(4, 2)
        start = head + 32 + int(table[:i, 0].sum())
        assert together[start : start + table[i, 0]] == one[head + 8 :]


def test_ids_too_large_are_refused():
    with pytest.raises(ValueError):
        range_coder.pack(np.array([range_coder.MAX_ID + 1], np.uint32))


def test_damage_is_found():
    ids = np.random.default_rng(5).integers(0, 70_000, 3000).astype(np.uint32)
    good = range_coder.pack(ids, 1000)
    for place in range(0, len(good), 97):
        bad = bytearray(good)
        bad[place] ^= 0x10
        try:
            # The last bits of a block may not matter: then the ids are still right.
            assert range_coder.unpack(bytes(bad)).tolist() == ids.tolist()
        except range_coder.CorruptBlock:
            pass
    for cut_short in (b"", good[:10], good[:-1], good + b"x"):
        with pytest.raises(range_coder.CorruptBlock):
            range_coder.unpack(cut_short)


def test_files_hold_their_documents():
    lengths = np.array([0, 3, 1, 0, 2])
    ids = np.array([5, 5, 7, 9, 1, 1], np.uint16)
    data = token_files.pack_file(11, lengths, ids)
    before, found, back = token_files.unpack_file(data)
    assert (before, found.tolist(), back.tolist()) == (11, lengths.tolist(), ids.tolist())
    with pytest.raises(range_coder.CorruptBlock):
        token_files.unpack_file(b"JUNK" + data[4:])


TEXTS = [
    "", " ", "\n\n\t", "Hello World", "it's WE'LL 'Tis don't", "a.b,c!!!  d", "ÀÉ é ñ ß İ ΣΑΣ", "日本語 テスト", "é ̸x",
    "<|endoftext|>", "x<|startoftext|>y <|ENDOFTEXT|> <| endoftext|>", "tab\tand\rreturn\x0bx\x1cy\x85z q w",
    "12 345 6a7", "😀😀 ok", "word\nword\nWord.", "x" * 5000, "\x00\x01 \x7f", "’s ‘quoted’", "a \n b",
]


def test_encoder_equals_the_library():
    encode = token_files.WordEncoder(PATH).encode
    for _ in range(2):  # once to learn, once from memory
        assert [np.frombuffer(raw, "<u4").tolist() for raw in encode(TEXTS)] == [_ids(t) for t in TEXTS]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_encoder_equals_the_library_on_any_text(texts):
    encode = token_files.word_encoder(PATH).encode
    assert [np.frombuffer(raw, "<u4").tolist() for raw in encode(texts)] == [_ids(t) for t in texts]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
@pytest.mark.parametrize("end", [None, 2])
def test_a_column_is_encoded_at_once(name, end):
    path = public_tokenizers.path(name)
    column = pa.array([*TEXTS, None, "Hello hello, HELLO"], pa.string()).slice(3)
    ids, sizes = token_files.WordEncoder(path).encode_column(column, end)
    expected = [_ids(t, path) + ([] if end is None else [end]) for t in column.to_pylist()]
    assert sizes.tolist() == [len(e) for e in expected]
    assert ids.tolist() == [i for e in expected for i in e]


def test_the_library_gets_every_word_once_in_lower_case(monkeypatch):
    encoder = token_files.WordEncoder(PATH)
    given_out: list[str] = []
    learn = encoder._learn_words
    monkeypatch.setattr(encoder, "_learn_words", lambda words: (given_out.extend(words), learn(words))[1])
    for text in ("Hello, hello. HELLO!", "hello (Hello) ÀÉ", "àé hello," * 3):
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == _ids(text)
    assert sorted(given_out) == sorted(set(given_out))
    assert given_out.count("hello") == given_out.count("àé") == 1


def test_more_words_than_are_remembered(monkeypatch):
    monkeypatch.setattr(token_files, "CACHE_WORDS", 3)
    encode = token_files.WordEncoder(PATH).encode
    for text in TEXTS:
        assert np.frombuffer(encode([text, "one two"])[0], "<u4").tolist() == _ids(text)


def test_groups_hold_all_rows_in_order(monkeypatch):
    monkeypatch.setattr(token_files, "GROUP_BYTES", 10)
    for texts in ([], [""], ["a" * 35, "", "b", "", "c" * 9, "d" * 25]):
        batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
        groups = [g.column("text").to_pylist() for g in token_files._groups(batch)]
        assert [t for g in groups for t in g] == texts
        assert len(groups) == (0 if not texts else 1 if len(texts) == 1 else 3)


@pytest.mark.parametrize("many", [1, 2, 129, 300])
def test_many_blocks_side_by_side_with_a_short_last_one(many):
    """Lanes fall out at any place of the mix and of the chunks; wide ids take one more step."""
    random = np.random.default_rng(many)
    for most in (300, 70_000, range_coder.MAX_ID):
        for short in (1, 63, 64, 65, 127, 128, 200):
            ids = (random.zipf(1.3, 200 * (many - 1) + short).astype(np.uint64) % most).astype(np.uint32)
            assert range_coder.unpack(range_coder.pack(ids, 200)).tolist() == ids.tolist()


def test_other_tokenizers_get_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    found = token_files.WordEncoder(path).encode(["two  words", " x\n y "])
    assert [np.frombuffer(raw, "<u4").tolist() for raw in found] == [_ids("two  words", path), _ids(" x\n y ", path)]


def _written(spark, docs, folder, end_id=2):
    token_files.write_files(token_files.encoded(docs, PATH, end_id), str(folder))
    return token_files.read_files(spark.read.parquet(str(folder)), ids=True).collect()


def _expected(rows):
    found, start = [], 0
    for doc_id, text in rows:
        ids = [*_ids(text), 2]
        found.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return found


def test_files_of_a_table(spark, tmp_path, monkeypatch):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    monkeypatch.setattr(token_files, "FILE_IDS", 5000)
    found = sorted(tuple(r) for r in _written(spark, docs, tmp_path / "f"))
    assert found == _expected(rows)
    files = spark.read.parquet(str(tmp_path / "f")).select("before").orderBy("before").collect()
    assert len(files) > 10 and files[0].before == 0


def test_odd_rows(spark, tmp_path):
    """Null ids come first, rows that share an id follow each other, equal rows are interchangeable."""
    docs = odd_documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = sorted(((r.id, r.start, r.n, tuple(r.ids)) for r in _written(spark, docs, tmp_path / "f")), key=lambda r: r[1])
    assert [r[0] for r in found] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i))
    assert sorted((r[0] or 0, r[3]) for r in found) == sorted((i or 0, (*_ids(t), 2)) for i, t in rows)
    ends = np.cumsum([r[2] for r in found])
    assert [r[1] for r in found] == [0, *ends[:-1].tolist()]


def test_an_id_that_most_rows_share(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_IDS", 300)
    rows = [(5, f"text {i % 7}") for i in range(600)] + [(i, "one two") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    found = sorted(((r.id, r.start, r.n) for r in _written(spark, docs, tmp_path / "f")), key=lambda r: r[1])
    assert [r[0] for r in found] == sorted(i for i, _ in rows)
    assert [r[1] for r in found] == [0, *np.cumsum([r[2] for r in found])[:-1].tolist()]
    # Equal rows lie side by side whatever the task that read them.
    again = sorted(((r.id, r.start, r.n) for r in _written(spark, docs.coalesce(1), tmp_path / "g")), key=lambda r: r[1])
    assert again == found
    assert token_files.placed(token_files.encoded(docs, PATH, 2)).where("id = 5").select("stretch").distinct().count() > 5


def test_no_documents(spark, tmp_path):
    assert _written(spark, odd_documents(spark, []), tmp_path / "f") == []
    assert _written(spark, odd_documents(spark, [(1, None)]), tmp_path / "g", None)[0].n == 0
