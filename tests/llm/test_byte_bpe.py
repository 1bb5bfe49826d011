"""Ids against the library on whole texts, exact round trips, long texts and long white space."""

import hashlib
import random

import public_tokenizers
import pytest

from citybeat.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def encoding():
    return byte_bpe.load_encoding(PATH, public_tokenizers.PATTERN)


def test_chunks_do_not_change_ids(encoding, monkeypatch):
    monkeypatch.setattr(byte_bpe, "LONG_SPACE", 6)
    monkeypatch.setattr(byte_bpe, "_LONG_SPACE", byte_bpe.re.compile(r"\s{6,}"))
    monkeypatch.setattr(byte_bpe, "CHUNK_CHARS", 9)
    monkeypatch.setattr(byte_bpe.safe_chunks, "__defaults__", (9,))
    rnd = random.Random(1)
    parts = ["a", "don't", "日本", " ", "  ", "\n", "\t\t", " ", "  ", "!?", "12", "\x1c", "\x0b", "é", " " * 9, "\n" * 8, "\u0085"]
    for _ in range(4000):
        text = "".join(rnd.choices(parts, k=rnd.randint(1, 30)))
        assert byte_bpe.encode_text(encoding, text) == encoding.encode_ordinary(text), repr(text)


def test_long_runs(encoding):
    for text in ("a" * 200_000, " " * 300_000 + "x", "x" + "\n" * 200_000, "word " * 60_000, "\x1c" * 9000 + " a"):
        ids = byte_bpe.encode_text(encoding, text)
        assert encoding.decode_bytes(ids).decode() == text


def test_documents_round_trip(spark, encoding):
    import duckdb

    docs = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall() + [(None, None), (-1, ""), (-1, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = sorted((str(r[0]), *r[1:]) for r in byte_bpe.encode(df, PATH, public_tokenizers.PATTERN, finish=byte_bpe.digests, finish_schema="i string, d string").collect())
    want = []
    for k, t in docs:
        ids = encoding.encode_ordinary(t or "")
        want.append((str(k), len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want)
    coded = byte_bpe.encode(df, PATH, public_tokenizers.PATTERN)
    assert all(bytes(r.decoded).decode() == (dict(docs)[r.doc_id] or "") for r in byte_bpe.decode(coded, PATH, public_tokenizers.PATTERN).collect() if r.doc_id != -1)
    assert byte_bpe.encode(df.limit(0), PATH, public_tokenizers.PATTERN).count() == 0
