"""Token files: exact round trips, the tokenizers library as the yardstick, broken blocks."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import token_coder, token_files
from millrace.sources.paths import scratch_folder

PATH = public_tokenizers.path("byte_bpe_50k.json")
SIZE = 50_257
ODD = [
    "", " ", "  a", "a ", "a  b", "it's they'll 'S, 'sa", "x × y ×, ÷. ÷ ,", "a\n\nb", "a\nb", "a \n b", "é, è. Ñ! ñ\nà à", "!!! a", "<|endoftext|>",
    "a <|endoftext|> b<|endoftext|>.", "tab\tand\r\nbreak", "no break space", "日本 語。 ok", "🙂 🙂. a", "a.b,c;d:e!f?g", "1 2.3 ,4", "word." * 3000,
    "À ×a ÷b", "x" * 9000, "á. ́.", "! !\n!\n?", ".\n.\n", "\n", "a\n", "\na",
]


def library(text):
    return token_files.tokenizer(PATH).encode(text or "", add_special_tokens=False).ids + [0]


def both(texts):
    ids, counts = token_files.Encoder(PATH).encode(pa.array(texts, pa.string()))
    return np.split(ids, np.cumsum(counts)[:-1])


def test_ids_are_the_librarys():
    for text, mine in zip(ODD, both(ODD)):
        assert mine.tolist() == library(text), text


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aB1 é×÷,.;'\n\t!ñ <|", max_size=30), min_size=1, max_size=6))
def test_any_text_has_the_librarys_ids(texts):
    assert [m.tolist() for m in both(texts)] == [library(t) for t in texts]


def test_a_full_table_of_stretches_is_forgotten(monkeypatch):
    monkeypatch.setattr(token_files, "KEPT", 3)
    encoder = token_files.Encoder(PATH)
    for _ in range(3):
        for text in ODD:
            assert encoder.encode(pa.array([text]))[0].tolist() == library(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="aZ1é×÷'#$(_-|<>/\\.,s\n\r\t \u00a0\u0085\u2028ß語\x00", max_size=24), min_size=1, max_size=8))
def test_signs_and_odd_blanks_have_the_librarys_ids(texts):
    assert [m.tolist() for m in both(texts)] == [library(t) for t in texts]


def test_a_word_is_learned_apart_from_the_sign_after_it():
    encoder = token_files.Encoder(PATH)
    encoder.encode(pa.array(["A word### word$$$ word- word.", "A word"]))
    assert set(encoder.known) == {"A", " word", "###", "$$$", "-", "."}


def test_a_tokenizer_that_swallows_line_breaks_is_refused(monkeypatch):
    from tokenizers import AddedToken, Tokenizer

    swallowing = Tokenizer.from_file(PATH)
    swallowing.add_special_tokens([AddedToken("<end>", rstrip=True)])
    monkeypatch.setattr(token_files, "tokenizer", lambda path: swallowing)
    with pytest.raises(ValueError, match="line breaks"):
        token_files.Encoder(PATH).encode(pa.array(["a <end> b"]))


def test_small_batches_are_looked_up_together(monkeypatch):
    monkeypatch.setattr(token_files, "SLICE_BYTES", 10)
    batches = [pa.RecordBatch.from_pydict({"doc_id": [i], "text": ["x" * n]}) for i, n in enumerate((4, 4, 0, 4, 30, 1, 2))]
    assert [b["doc_id"].to_pylist() for b in token_files._gathered(iter(batches))] == [[0, 1, 2], [3], [4], [5, 6]]
    assert list(token_files._gathered(iter([]))) == []


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 60_000), st.lists(st.integers(0, 59_999), max_size=400), st.integers(0, 6))
def test_coder_round_trip(size, ids, repeats):
    ids = np.array(ids, np.int64) % size
    ids = np.tile(ids, repeats)
    assert (token_coder.decode(token_coder.encode(ids, size), len(ids), size) == ids).all()


def test_coder_learns_what_comes_next():
    rng = np.random.default_rng(2)
    loop, noise = np.tile(rng.integers(0, SIZE, 500), 400), rng.integers(0, SIZE, 200_000)
    for ids, least, most in ((loop, 0, 1.5), (noise, 15.6, 17.5), (np.zeros(200_000, np.int64), 0, 0.5)):
        code = token_coder.encode(ids, SIZE)
        assert least <= 8 * len(code) / len(ids) <= most
        assert (token_coder.decode(code, len(ids), SIZE) == ids).all()


def test_narrow_tables_give_the_code_of_earlier_files():
    ids = np.arange(60_000) ** 2 % 7919 // np.where(np.arange(60_000) % 3, 1, 97)
    code = token_coder.encode(ids, SIZE)
    assert zlib.crc32(code) == 1060154578
    assert (token_coder.decode(code, len(ids), SIZE) == ids).all()
    assert all(table.itemsize == 4 for table in token_coder.Model(SIZE, 1).guesses) and token_coder.decode(code, len(ids), SIZE).itemsize == 4


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(3 * i, t, "given") for i, t in enumerate(ODD)] + [(None, "null id", "given"), (None, None, "given"), (5, None, "given"), (6, "a  b", "x"), (6, "again", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, crc string")


@pytest.mark.parametrize("block_ids", [1, 7, 1000, 1 << 21])
def test_files_hold_every_document_in_order(spark, docs, block_ids):
    folder = scratch_folder(spark, "test-files")
    token_files.write(docs, folder, PATH, block_ids)
    want = sorted(((r.doc_id is None, r.doc_id, library(r.text)) for r in docs.collect()), key=lambda r: (r[0], r[1] or 0))
    read = sorted(token_files.read(spark, folder).collect(), key=lambda r: r.start)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.ids) for r in read) == sorted((a, b or 0, c) for a, b, c in want)
    assert [(r.doc_id is None, r.doc_id or 0) for r in read] == [(a, b or 0) for a, b, _ in want]
    starts = np.cumsum([0] + [len(r.ids) for r in read])
    assert [r.start for r in read] == starts[:-1].tolist()
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    got = sorted(tuple(r) for r in token_files.digests(spark, folder).select("start", "n_tokens", "ids_crc32").collect())
    assert got == [(r.start, len(r.ids), crc(r.ids)) for r in read]


def test_a_changed_byte_is_noticed():
    ids, table = np.arange(50), np.array([[4, 50, 0]])
    body = token_files.pack(ids, table, 0, 0, SIZE)
    assert (token_files.unpack(body)[0] == ids).all()
    for place in (0, token_files._HEADER.size, len(body) - 1):
        broken = bytearray(body)
        broken[place] ^= 1
        with pytest.raises(token_files.BrokenBlock):
            token_files.unpack(bytes(broken))
    with pytest.raises(token_files.BrokenBlock):
        token_files.unpack(body[:10])


def test_no_documents(spark, docs):
    assert token_files.encoded(docs.limit(0), PATH).count() == 0
