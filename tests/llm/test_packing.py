"""Ids against tokenizers on whole texts, pieces against the contract, limits, padding."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from citybeat.llm import packing
from citybeat.llm.word_bpe import WordEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def odd_texts():
    rnd = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFZéèüößñÄÉ0123456789.,!?'-_%$#@&*()[]{}:;/\\\"<|>ªµ×÷ŒŠž"
    texts = ["", " ", "\n", "a  b\t c d\x0be\x1ff", "don't I'LL we've 's", "Σας ΑΣ", "İstanbul ǅ", "é ́x", "日本 語😀", "<|endoftext|> x", " a\u0085b"]
    texts += [" ".join("".join(rnd.choices(letters, k=rnd.randint(1, 25))) for _ in range(rnd.randint(1, 60))) for _ in range(300)]
    texts += ["".join(chr(rnd.choice((rnd.randint(32, 0x24F), rnd.randint(0x300, 0x2FFF)))) for _ in range(60)) for _ in range(100)]
    return texts


def test_ids_match_the_library(whole):
    encoder = WordEncoder(PATH)
    for text in odd_texts():
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == whole(text), text


def test_ids_match_on_driver_documents(whole):
    import duckdb

    encoder = WordEncoder(PATH)
    for (text,) in duckdb.sql("SELECT text FROM '/root/testdata/sf0.01/documents.parquet'").fetchall():
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == whole(text)


def check(rows, docs, limits, whole):
    """``rows`` are pieces; docs: {id: (text, prompt)}."""
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
        assert len(r.ids) == 4 * r.length and r.length > 0
    assert by_doc.keys() == docs.keys()
    for k, pieces in by_doc.items():
        text, prompt = docs[k]
        want = whole(text or "") + [1]
        pieces.sort(key=lambda r: r.start)
        assert [i for r in pieces for i in np.frombuffer(r.ids, "<u4").tolist()] == want
        assert np.cumsum([0, *(r.length for r in pieces)])[:-1].tolist() == [r.start for r in pieces]
        assert all(r.doc_tokens == len(want) for r in pieces)
        assert all(r.n_loss == max(0, r.start + r.length - max(r.start, prompt or 0)) for r in pieces)
    for pieces in by_seq.values():
        pieces.sort(key=lambda r: r.offset)
        assert np.cumsum([0, *(r.length for r in pieces)])[:-1].tolist() == [r.offset for r in pieces]
        total = sum(r.length for r in pieces)
        assert total == pieces[0].sequence_tokens <= limits.tokens
        assert len(pieces) <= limits.segments and sum(r.n_loss for r in pieces) <= limits.loss
    return by_seq


def test_documents(spark, whole):
    rnd = random.Random(1)
    docs = {i: (" ".join(rnd.choices(["the", "of", "x1", "end."], k=rnd.choice((0, 1, 30, 900, 7000)))), 0) for i in range(150)}
    docs[500] = (None, 0)
    df = spark.createDataFrame([(k, t) for k, (t, _) in docs.items()], "doc_id long, text string").repartition(3)
    rows = packing.pack(df, PATH).collect()
    by_seq = check(rows, docs, packing.Limits(), whole)
    totals = [sum(r.length for r in p) for p in by_seq.values()]
    padding = sum(2048 - n for n in totals if n & (n - 1))
    assert padding < 0.01 * sum(totals)


@pytest.mark.parametrize("words", [2, 10])
def test_short_texts_need_no_padding(spark, whole, words):
    """Sequences that the limit on segments closes are split to lengths that need no padding."""
    docs = {i: (" ".join(["the"] * words), 0) for i in range(3000)}
    df = spark.createDataFrame([(k, t) for k, (t, _) in docs.items()], "doc_id long, text string").repartition(2)
    by_seq = check(packing.pack(df, PATH).collect(), docs, packing.Limits(), whole)
    totals = [sum(r.length for r in p) for p in by_seq.values()]
    assert sum(2048 - n for n in totals if n & (n - 1)) < 0.01 * sum(totals)


def test_simultaneous_limits(spark, whole):
    rnd = random.Random(2)
    limits = packing.Limits(tokens=128, segments=4, loss=60, min_cut=4, pool=32)
    docs = {i: (" ".join(rnd.choices(["the", "of"], k=rnd.randint(0, 300))), rnd.choice((None, 0, 5, 200))) for i in range(120)}
    df = spark.createDataFrame([(k, t, p) for k, (t, p) in docs.items()], "doc_id long, text string, prompt long").repartition(2)
    check(packing.pack(df, PATH, prompt_tokens="prompt", limits=limits).collect(), docs, limits, whole)


def test_heuristic_balances_the_dimensions():
    limits = packing.Limits(tokens=100, segments=10, loss=50, min_cut=200)
    pool = packing.Pool(limits)
    for i in range(10):
        pool.add((i, 0, 50, 50, 50, 0, b""))  # all loss-bearing
        pool.add((100 + i, 0, 50, 0, 50, 50, b""))  # prompt only
    sequences = list(pool.sequences(0))
    assert len(sequences) == 10 and all({p[0] >= 100 for p in s} == {True, False} for s in sequences)


def test_query_digest_and_empty(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, "hello")], "doc_id long, text string")
    row = packing.pack(df, PATH).withColumn("crc", F.crc32("ids")).first()
    assert row.crc == zlib.crc32(bytes(row.ids))
    assert packing.pack(df, PATH, digest=True).first().ids_crc32 == row.crc
    assert packing.pack(df.limit(0), PATH).count() == 0
