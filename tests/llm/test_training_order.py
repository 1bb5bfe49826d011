"""The permutation is one to one; shards hold every id of every document; reading resumes anywhere."""

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from citybeat.llm import training_order as order
from citybeat.llm.word_bpe import WordEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 4097, 70001])
def test_permutation(n):
    got = order.slots(np.arange(n), n, 99)
    assert sorted(got.tolist()) == list(range(n))
    assert (order.slots(np.arange(n), n, 99) == got).all()
    if n > 100:
        assert (order.slots(np.arange(n), n, 100) != got).mean() > 0.9
        assert abs(np.corrcoef(np.arange(n), got)[0, 1]) < 0.2


@pytest.fixture(scope="module")
def written(spark):
    rnd = random.Random(8)
    docs = [(i, " ".join(rnd.choices(["the", "word", "x7", "end."], k=rnd.choice((0, 3, 60, 700))))) for i in range(90)]
    docs.append((200, None))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    return docs, order.write_shards(df, PATH, seq_len=64, per_shard=7)


def test_shards_hold_every_document(written):
    docs, shards = written
    rows = order.read_from(shards).orderBy("slot").collect()
    n = len(rows)
    assert [r.slot for r in rows] == list(range(n))
    assert all(len(r.ids) == 128 and r.shard == r.slot // 7 and r.byte_offset == r.slot % 7 * 128 for r in rows)
    assert [r.slot for r in rows] == order.slots(np.array([r.number for r in rows]), n, 20240229).tolist()
    by_number = sorted(rows, key=lambda r: r.number)
    encoder = WordEncoder(PATH)
    stream = [int(i) for r in by_number for i in np.frombuffer(r.ids, "<u2")[: r.n_tokens]]
    pieces, now = [], []
    for i in stream:
        now.append(i)
        if i == 1:
            pieces.append(tuple(now))
            now = []
    want = [tuple(np.frombuffer(encoder.encode(t or ""), "<u4").tolist()) + (1,) for _, t in docs]
    assert not now and sorted(pieces) == sorted(want)
    owner = dict(docs)
    for r in rows:
        ids = np.frombuffer(encoder.encode(owner[r.doc_id] or "") + b"\x01\0\0\0", "<u4")[r.start :]
        m = min(len(ids), r.n_tokens)
        assert np.frombuffer(r.ids, "<u2")[:m].tolist() == ids[:m].tolist()


def test_records_name_all_their_documents(written):
    docs, shards = written
    encoder, got = WordEncoder(PATH), {}
    for r in order.read_from(shards).collect():
        ids, at = np.frombuffer(r.ids, "<u2"), 0
        assert (r.docs[0].doc_id, r.docs[0].start) == (r.doc_id, r.start)
        for d in r.docs:
            got.setdefault(d.doc_id, {})[d.start] = ids[at : at + d.length].tolist()
            at += d.length
        assert at == r.n_tokens
    for k, t in docs:
        whole = [i for _, part in sorted(got[k].items()) for i in part]
        assert whole == [*np.frombuffer(encoder.encode(t or ""), "<u4").tolist(), 1]


def test_resume(written):
    _, shards = written
    every = [tuple(r) for r in order.read_from(shards).orderBy("slot").collect()]
    assert [tuple(r) for r in order.read_from(shards, 10).orderBy("slot").collect()] == every[10:]
    assert [tuple(r) for r in order.read_from(shards, 10, 5).orderBy("slot").collect()] == every[10:15]
    assert order.read_from(shards, len(every)).count() == 0


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert order.read_from(order.write_shards(df, PATH)).agg(F.count(F.lit(1))).first()[0] == 0
