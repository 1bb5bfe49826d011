"""Repeated windows against a brute-force count of every window."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from citybeat.llm import radix_dedup


def brute(texts, depth):
    seen = Counter()
    raws = [(t or "").encode() for t in texts]
    for raw in raws:
        seen.update(raw[i : i + depth] for i in range(len(raw) - depth + 1))
    out = []
    for raw in raws:
        gone = [False] * len(raw)
        for i in range(len(raw) - depth + 1):
            if seen[raw[i : i + depth]] > 1:
                gone[i : i + depth] = [True] * depth
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def compare(spark, texts, depth=400, gram=128):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, raw string").repartition(3)
    got = radix_dedup.remove_repeated(df, depth=depth, gram=gram, digest=True)
    rows = {r.doc_id: tuple(r)[1:] for r in got.collect()}
    want = dict(enumerate(brute(texts, depth)))
    assert rows == want


def words(rnd, n, alphabet="abcdefgh é"):
    return "".join(rnd.choice(alphabet) for _ in range(n))


def test_planted_passages(spark):
    rnd = random.Random(3)
    shared = words(rnd, 900)
    texts = [None, "", "a" * 399, words(rnd, 500)]
    for i in range(12):
        cut = shared[rnd.randint(0, 300) : rnd.randint(500, 900)]
        texts.append(words(rnd, rnd.randint(0, 300)) + cut + words(rnd, rnd.randint(0, 300)))
    texts += [texts[5], texts[5], shared + "!" + shared[1:], "ab" * 700, "a" * 1000, "a" * 405]
    compare(spark, texts)


def test_near_copies_with_small_windows(spark):
    rnd = random.Random(5)
    base = words(rnd, 400, "ab ")
    texts = []
    for _ in range(25):
        t = list(base)
        for _ in range(rnd.randint(0, 12)):
            t[rnd.randrange(len(t))] = rnd.choice("abc")
        texts.append("".join(t))
    compare(spark, texts, depth=60, gram=20)


def test_long_text_over_chunks(spark, monkeypatch):
    rnd = random.Random(9)
    piece = words(rnd, 1000)
    text = words(rnd, 3000) + piece + words(rnd, 2500) + piece + words(rnd, 10)
    monkeypatch.setattr(radix_dedup, "CHUNK", 700)
    raw = text.encode()
    parts = []
    for lo in range(0, len(raw) - 399, 700):
        part = raw[lo : lo + 700 + 399]
        _, first, size, _ = radix_dedup.runs(np.frombuffer(part, dtype=np.uint8))
        parts += [(int(f) + lo, int(s)) for f, s in zip(first, size)]
    assert [f for f, _ in parts] == [0, *np.cumsum([s for _, s in parts])[:-1].tolist()]
    assert sum(s for _, s in parts) == len(raw) - 399


@pytest.mark.parametrize("n", [0, 1])
def test_empty_and_single(spark, n):
    df = spark.createDataFrame([(None, "x" * 500)][:n], "doc_id long, text string")
    got = radix_dedup.remove_repeated(df, digest=True).collect()
    assert len(got) == n
    if n:
        assert (got[0].n_removed, got[0].n_spans) == (500, 1)  # its windows repeat one another


def test_passages_of_51_words_are_told(spark, tmp_path):
    from citybeat.llm.queries import op9_radix_dedup

    rnd = random.Random(11)
    text = lambda n: " ".join(words(rnd, rnd.randint(4, 7), "abcdefgh") for _ in range(n))
    passage, twice = text(51), text(51)
    assert 224 <= len(passage) < 400
    texts = [f"{text(80)} {passage} {text(80)}" for _ in range(6)]
    texts += [text(200), text(40), "", None, f"{text(60)} {twice} {text(60)} {twice}", "é" * 20, text(300), passage]
    want = [True] * 6 + [False] * 7 + [True]
    rows = [*enumerate(texts), (None, f"{passage} {text(90)}"), (7, texts[7])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = op9_radix_dedup(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    told = {r.doc_id: r.shares_passage for r in got}
    # a repeated row shares its text with the other one
    assert told == dict(enumerate(want)) | {None: True, 7: len(texts[7]) >= 224}
    assert all((r.n_shared > 0) == r.shares_passage for r in got)
    assert not any(r.changed for r in got)


def test_shared_passages_against_brute_force(spark):
    rnd = random.Random(13)
    base = [words(rnd, 400, "abcdefgh é") for _ in range(4)]
    texts = [None, "", base[0][:50]]
    for _ in range(60):
        source, lo = rnd.choice(base), rnd.randint(0, 300)
        texts.append(words(rnd, rnd.randint(0, 90)) + source[lo : lo + rnd.randint(20, 90)] + words(rnd, rnd.randint(0, 90)))
    raws = [(t or "").encode() for t in texts]
    holders = {}
    for size in (30, 50):
        for d, raw in enumerate(raws):
            for i in range(len(raw) - size + 1):
                holders.setdefault(raw[i : i + size], set()).add(d)
    in_two = lambda raw, size: any(len(holders[raw[i : i + size]]) > 1 for i in range(len(raw) - size + 1))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = radix_dedup.shared_passages(radix_dedup._texts(df, "doc_id", "text"), depth=50, gram=30)
    found = {r.doc_id for r in got.collect()}
    must, may = ({d for d, raw in enumerate(raws) if in_two(raw, size)} for size in (50, 30))
    assert must <= found <= may and must < may


def test_driver_documents(spark):
    import duckdb

    texts = [r[0] for r in duckdb.sql("SELECT text FROM '/root/testdata/sf0.001/documents.parquet' ORDER BY doc_id").fetchall()]
    compare(spark, texts)
