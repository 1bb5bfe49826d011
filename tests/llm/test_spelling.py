"""Variants against brute force: every pair of words, every text; scans against full edit matrices."""

import random
import re
import zlib
from collections import Counter

import pytest

from citybeat.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def distance_one(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_words(docs, every=199):
    out = Counter()
    for k, t in docs:
        for run in RUN.findall(t or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if k is None else k}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 6 and n >= 5}


def brute(words):
    """Rows of the contract; pairs by common deletions and substitutions over all words."""
    alphabet = sorted({c for w in words for c in w})
    rows, form = {}, {}
    for w, n in words.items():
        near = {w[:i] + w[i + 1 :] for i in range(len(w))}
        near |= {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in alphabet}
        near |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in alphabet}
        near = [x for x in near if x in words and x != w]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= 5 * n:
            form[w] = best
        rows[w] = (n, len(near), words[form[w]] if w in form else None)
    out = []
    for w, (n, n_near, form_n) in rows.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, n_near, form_n))
    return sorted(out, key=str)


def test_scan():
    rnd = random.Random(1)
    for _ in range(400):
        letters = "ab" if rnd.random() < 0.5 else "abcdé"
        words = sorted({"".join(rnd.choices(letters, k=rnd.randint(0, 6))) for _ in range(rnd.randint(1, 60))})
        for q in rnd.sample(words, min(8, len(words))) + ["", "abab"]:
            assert [words[i] for i in spelling.scan(q, words)] == [w for w in words if distance_one(q, w)]


@pytest.mark.parametrize("block", [256, 2])
def test_blocks_hold_every_pair_once(spark, monkeypatch, block):
    """Small blocks, so that crowded ones are dealt again down to single letters."""
    monkeypatch.setattr(spelling, "BLOCK", block)
    rnd = random.Random(block)
    words = {}
    for _ in range(500):
        base = "hotpre" if rnd.random() < 0.5 else "".join(rnd.choices("abc", k=6))
        words[base + "".join(rnd.choices("abcé", k=rnd.randint(0, 5)))] = rnd.choice([5, 6, 30, 200, 1000])
    words |= {"aaaaaa": 5, "aaaaaaa": 25, "aaaaaaaa": 125, "baaaaaaaa": 625, "x" * 70: 9, "x" * 71: 90}
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    got = {r.word: (r.n_near, r.near_n, r.near) for r in spelling.near_words(df).collect()}
    for w in words:
        near = [x for x in words if distance_one(w, x)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        assert got.get(w) == (best and (len(near), words[best], best)), w


def test_variants(spark):
    import duckdb

    docs = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.01/documents.parquet'").fetchall()
    docs += [(None, None), (-1, ""), (None, "Straße straße STRASSE " * 30), (-2, "colour " * 9 + "color1color " * 50 + "coloour " * 5)]
    docs += [(-2, "colours " * 50)] * 2 + [(-3, "×÷×÷×÷ " * 6 + "abcdef" * 20_000)]
    df = spark.createDataFrame([(k, t, "x", 3) for k, t in docs], "doc_id long, text string, word string, n int").repartition(5)
    got = sorted((tuple(r) for r in spelling.variants(df, every=199).collect()), key=str)
    want = brute(brute_words(docs))
    assert got == want
    assert sum(r[1] is not None for r in want) > 20


def test_roots_follow_forms_to_the_last(spark):
    chain = [(f"w{i:02d}", f"w{i + 1:02d}") for i in range(11)]
    rows = spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect()
    assert {r.root for r in rows} == {"w11"} and len(rows) == 11


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(df, every=199).collect() == []
    assert spelling.variants(spark.createDataFrame([(1, "short only")] * 9, "doc_id long, text string")).collect() == []
