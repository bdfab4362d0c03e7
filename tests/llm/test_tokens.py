"""Tokens against the library, packing, record files."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F
import pytest
import public_tokenizers

from shelfscan.llm import packing, records, tokens
from shelfscan.llm.common import prepare
from shelfscan.llm.token_counts import count_texts, token_counts
from shelfscan.session import fresh_folder

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

PARTS = ["the", "Straße", " ", "  ", "\n", "\n\n", " \n ", "\t", "don't", "'s", "x" * 90, "12345", "é",
         "é", " ", "　", "\x1c", "\x85", "日本語", "🙂", "<|endoftext|>", "<|ENDOFTEXT|>",
         "ΟΔΟΣ", "!?.", "a_b", "\r\n", "<|", "İ"]


def texts():
    rng = random.Random(3)
    made = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25))) for _ in range(1500)]
    made += [" ".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25))) for _ in range(1500)]
    return [None, "", " ", *made]


@pytest.fixture()
def docs(spark):
    prepare(spark)
    rows = [(1, "one two three"), (1, "one two three"), (None, "no id"), (3, None), (4, ""),
            (5, "word " * 5000), (6, "<|endoftext|> x"), (-7, "ä\nö")]
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"length": F.lit("x"), "start": F.lit(1), "block": F.lit(None).cast("int")})


def ids_of(text):
    return tokens.tokenizer(BYTE_BPE).encode(text or "", add_special_tokens=False).ids


def test_ids_equal_those_of_the_library():
    made = texts()
    for text, ids in zip(made, tokens.encode_ids(BYTE_BPE, made)):
        assert np.frombuffer(ids, "<u4").tolist() == ids_of(text), repr(text)


def test_line_ends_and_signs_between_words():
    rng = random.Random(9)
    parts = ["a", "ç", "Ɏ", "ɐ", " b", "\n", "\n\n", "c,", " ", "é.", " 9", "'s", " d'", " e%%%", "²", "ªº", "×"]
    made = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(5000)]
    for text, ids in zip(made, tokens.encode_ids(BYTE_BPE, made)):
        assert np.frombuffer(ids, "<u4").tolist() == ids_of(text), repr(text)


def test_words_are_learned_once_and_many_at_a_time(monkeypatch):
    """At line starts and before signs, too."""
    memo = tokens.Memo(tokens.id_memo(BYTE_BPE).work)
    alone, bulk = [], []
    work, library = memo.work, tokens.word_tokenizer(BYTE_BPE)
    memo.work = lambda unit: alone.append(unit) or work(unit)
    monkeypatch.setattr(tokens, "id_memo", lambda path: memo)

    class Library:
        def encode_batch_fast(self, given, **options):
            bulk.extend(given)
            return library.encode_batch_fast(given, **options)

    monkeypatch.setattr(tokens, "word_tokenizer", lambda path: Library())
    text = "\n".join(f"Wort{a}{b}, wort{a}{b}. wort{a}{b}!" for a in "abcdefgh" for b in "abcdefgh")
    assert np.frombuffer(tokens.encode_ids(BYTE_BPE, [text])[0], "<u4").tolist() == ids_of(text)
    assert sorted(alone) == ["\n", "!", ",", "."]
    assert len(bulk) == 1 and len(bulk[0].split()) == 128


def test_counts_equal_those_of_the_library():
    made = texts()
    library = tokens.tokenizer(WORD_BPE)
    for text, n in zip(made, count_texts(WORD_BPE, made)):
        assert n == len(library.encode(text or "", add_special_tokens=False)), repr(text)


def test_memo_forgets_and_stays_right(monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_SIZE", 3)
    memo = tokens.Memo(len)
    for n in range(20):
        assert memo.trim()["x" * n] == n
        assert len(memo) + len(memo.old) <= 8


def test_token_counts_of_odd_rows(docs):
    found = token_counts(docs, WORD_BPE).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, r.over_limit) for r in found) == [
        (-7, 5, False), (0, 5, False), (1, 13, False), (1, 13, False), (3, 0, False),
        (4, 0, False), (5, 25000, True), (6, 15, False)]
    assert token_counts(docs.limit(0), WORD_BPE).count() == 0


def check_packing(found, docs, capacity):
    whole = {}
    for row in docs.collect():
        whole.setdefault(row.doc_id, []).append(ids_of(row.text) + [0])
    by_sequence, pieces = {}, {}
    for row in found:
        by_sequence.setdefault(row.sequence_id, []).append((row.offset, row.length))
        pieces.setdefault(row.doc_id, []).append(row)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    assert pieces.keys() == whole.keys()
    for doc_id, rows in pieces.items():
        wanted = sorted(
            (at, n, zlib.crc32(np.array(ids[at:at + n], "<u4").tobytes()), len(ids))
            for ids in whole[doc_id] for at, n in packing.cuts(len(ids), capacity))
        assert wanted == sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows)
    return by_sequence


def test_packing_of_odd_rows(docs):
    found = packing.pack_documents(docs, BYTE_BPE, 1024).collect()
    check_packing(found, docs, 1024)
    assert packing.pack_documents(docs.limit(0), BYTE_BPE).count() == 0


def test_packing_wastes_little(spark, sf_dir):
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sequences = check_packing(packing.pack_documents(docs, BYTE_BPE).collect(), docs, 1024)
    used = sum(n for parts in sequences.values() for _, n in parts)
    assert used / (1024 * len(sequences)) > 0.97


def test_cuts_cover_every_token():
    for n in (1, 15, 16, 17, 1023, 1024, 1025, 5000):
        at = 0
        for start, length in packing.cuts(n, 1024):
            assert start == at and 0 < length <= 1024
            at += length
        assert at == n


def test_windows_are_added_when_one_is_too_full():
    window, offset = packing.pack_block(np.array([60] * 5), 100)
    assert len(set(window.tolist())) == 5 and offset.tolist() == [0] * 5


def test_records_of_odd_rows(spark, docs):
    folder = fresh_folder(spark, "records")
    found = records.token_records(docs, BYTE_BPE, folder).orderBy("start").collect()
    ordered = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    at = 0
    for row, doc in zip(found, ordered, strict=True):
        ids = ids_of(doc.text) + [2]
        assert (row.doc_id, row.start, row.n_tokens) == (doc.doc_id, at, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    assert records.token_records(docs.limit(0), BYTE_BPE, folder).count() == 0


@pytest.mark.parametrize("width", [2, 4])
def test_records_by_index_and_damage(tmp_path, width):
    made = [(n if n else None, np.arange(n, dtype="<u4").tobytes()) for n in range(6)]
    path = str(tmp_path / "x")
    assert records.write_file(path, made, width) == (6, 15)
    assert list(records.read_file(path)) == made
    assert list(records.read_file(path, [4, 0, 5])) == [made[4], made[0], made[5]]
    data = bytearray((tmp_path / "x.rec").read_bytes())
    data[-6] ^= 1
    (tmp_path / "x.rec").write_bytes(data)
    with pytest.raises(ValueError, match="damaged"):
        list(records.read_file(path))
