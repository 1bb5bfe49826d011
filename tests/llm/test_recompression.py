"""Runs by recompression against brute force over all periods, and extensions against symbol by symbol comparison."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from citybeat.llm import recompression as rc

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words):
    """Every period's maximal stretches; the smallest period of a stretch counts."""
    n, out = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                out.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in out.items())


def brute(doc_id, text):
    words = WORDS.findall(text or "")
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    drop = {i for s, size, q in runs for i in range(s + q, s + size)}
    kept = " ".join(w for i, w in enumerate(words) if i not in drop)
    best = [None] * 4
    for s, size, q in sorted(runs, key=lambda r: (r[0], r[2])):
        if best[0] is None or size * best[2] > best[1] * q:
            best = [s, size, q, 1000 * size // q]
    listed = "".join(f"{s},{size},{q}\n" for s, size, q in sorted(runs, key=lambda r: (r[0], r[2])))
    return (doc_id, len(runs), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def periodic(rnd, n, letters):
    out = []
    while len(out) < n:
        base = [rnd.randrange(letters) for _ in range(rnd.randint(1, 9))]
        out += (base * rnd.randint(1, 9))[: rnd.randint(1, 60)]
        if rnd.random() < 0.3:
            out += out[-rnd.randint(1, 20) :]
    return out[:n]


def test_extensions():
    rnd = random.Random(1)
    for letters in (1, 2, 3, 30):
        for _ in range(25):
            n = rnd.randint(2, 300)
            text = np.array([1000, *periodic(rnd, n, letters), 1001])
            i = np.array([rnd.randint(1, n) for _ in range(60)])
            j = np.array([rnd.randint(1, n) for _ in range(60)])
            i, j = i[i != j], j[i != j]
            grammar = rc.Grammar(text)
            for step in (1, -1):
                for a, b, got in zip(i, j, grammar.extend(i, j, step), strict=True):
                    want = 0
                    while text[a + step * want] == text[b + step * want]:
                        want += 1
                    assert got == want


def test_grammar_shrinks():
    """A repeated stretch is named within a logarithmic number of levels."""
    rnd = random.Random(2)
    base = [rnd.randrange(1000) for _ in range(20_000)]
    assert len(rc.Grammar(np.array([2000, *base, *base, 2001])).parent) < 80
    assert len(rc.Grammar(np.array([2000, *[1] * 100_000, 2001])).parent) == 1


@pytest.mark.parametrize("step", [1 << 20, 24])
def test_runs(monkeypatch, step):
    monkeypatch.setattr(rc, "GRID_STEP", step)
    rnd = random.Random(3)
    texts = [[], [1], [1] * 5, [1] * 6, [1, 2] * 4, [1, 2] * 3, [1, 1, 2] * 5] + [
        periodic(rnd, rnd.randint(0, 120), rnd.choice([1, 2, 3, 20])) for _ in range(300)
    ]
    got = rc.find_runs([np.array(t, np.int64) for t in texts])
    for t, runs in zip(texts, got, strict=True):
        assert [tuple(r) for r in runs.tolist()] == brute_runs(t)
    assert rc.find_runs([]) == []


def test_documents(spark, monkeypatch):
    import duckdb

    monkeypatch.setattr(rc, "BATCH_WORDS", 4000)
    rnd = random.Random(4)
    docs = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()
    docs = [(k, t if t is None or len(t) < 12_000 else t[:12_000]) for k, t in docs]
    docs += [(None, None), (-1, ""), (-1, ""), (-2, " \n\t"), (None, "a b " * 40), (7, "é à  é à " * 9), (7, "é à  é à " * 9)]
    docs += [(10_000 + i, " ".join(f"w{x}" for x in periodic(rnd, rnd.randint(0, 300), 4))) for i in range(60)]
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in docs], "doc_id long, text string, runs string, start int").repartition(3)
    whole = rc.periodic_runs(df, plant=True)
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    rows = whole.collect()
    assert sorted((tuple(r[c] for c in columns) for r in rows), key=str) == sorted((brute(k, t) for k, t in docs), key=str)
    assert sum(r.n_runs for r in rows) > 100
    for r in rows:
        assert hashlib.sha256(r.collapsed.encode()).hexdigest() == r.collapsed_sha256
        assert hashlib.sha256("".join(f"{x.start},{x.length},{x.period}\n" for x in r.runs).encode()).hexdigest() == r.runs_sha256
    short = rc.periodic_runs(df, plant=True, whole=False)
    assert sorted(short.select(*columns).collect(), key=str) == sorted(whole.select(*columns).collect(), key=str)
    assert rc.periodic_runs(df.limit(0)).count() == 0


def test_long_text():
    """A text of one repeated word and one whose second half repeats its first."""
    rnd = random.Random(5)
    base = [rnd.randrange(50_000) for _ in range(30_000)]
    for text, want in (([7] * 120_000, [(0, 120_000, 1)]), (base * 4, [(0, 120_000, 30_000)]), (base * 3, [])):
        runs = rc.find_runs([np.array(text, np.int64)])[0]
        assert [r for r in map(tuple, runs.tolist()) if r[1] > 1000] == want
