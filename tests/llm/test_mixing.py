"""The mix against a sort of every whole source, targets against exact resharing."""

import math
import random
import re
from collections import defaultdict
from fractions import Fraction

import pytest

from citybeat.llm import mixing

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def exact_targets(sizes, pattern=(5, 2, 1), share=Fraction(3, 2), most=2):
    """Targets by resharing the excess, in fractions; sources by code point, None last."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: pattern[i % len(pattern)] for i, s in enumerate(order)}
    total, capped = share * sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        w = sum(weight[s] for s in free)
        left = total - sum(most * sizes[s] for s in capped)
        out = {s: Fraction(most * sizes[s]) if s in capped else left * weight[s] / w for s in order}
        over = {s for s in free if out[s] > most * sizes[s]}
        if not over:
            return out
        capped |= over


def make(rnd, n, sources):
    texts = ["", None, " \n", "a", "é\x0bé x", "w " * 40]
    docs = []
    for i in range(n):
        text = rnd.choice(texts) if rnd.random() < 0.2 else " ".join("v%d" % rnd.randrange(99) for _ in range(rnd.randint(1, 60)))
        docs.append((i if rnd.random() < 0.95 else None, text, rnd.choice(sources)))
    return docs + docs[:5]


def frame(spark, docs):
    return spark.createDataFrame([(*d, 1, "y") for d in docs], "doc_id long, text string, source string, size int, w string").repartition(4)


@pytest.mark.parametrize("seed", [1, 2])
def test_mix(spark, seed):
    rnd = random.Random(seed)
    docs = make(rnd, 400, ["b", "a", None, "Z", "é", "tiny", "", "b", "b"])
    docs.append((9000, "only one row", "rare"))
    quality = spark.createDataFrame([(i, w) for i, w in zip(range(0, 400, 3), [2.0, 0.5, None, -1.0, 100.0, float("nan")] * 99)], "doc_id long, weight double")
    out = mixing.mix(frame(spark, docs), quality)
    rows = out.collect()
    assert sorted(rows, key=str) == sorted(mixing.mix(frame(spark, docs[::-1]), quality).collect(), key=str)
    assert sorted(((r.doc_id, r.source, r.size) for r in rows), key=str) == sorted(
        ((k, s, len(WORDS.findall(t or ""))) for k, t, s in docs), key=str
    )
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += r.size
    want = exact_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert math.isclose(r.target, want[r.source], rel_tol=1e-12)
        assert r.epochs * r.size <= r.taken <= (r.epochs + 1) * r.size and r.taken <= 2 * r.size
    for s in sizes:
        own = [r for r in rows if r.source == s]
        assert sum(r.taken for r in own) == round(want[s])
        assert sum(0 < r.taken - r.epochs * r.size < r.size for r in own) <= 1  # one document on the line


def test_taken_in_key_order(spark, monkeypatch):
    """The fraction holds the smallest keys of the whole source."""
    docs = [(i, "w " * (1 + i % 7), "ab"[i % 2]) for i in range(300)]
    keys = {}
    real = mixing.materialise

    def spy(df, name):
        out = real(df, name)
        if name == "mix-rows":
            keys.update({r.doc_id: r.key for r in out.collect()})
        return out

    monkeypatch.setattr(mixing, "materialise", spy)
    rows = mixing.mix(frame(spark, docs)).collect()
    for s in "ab":
        own = sorted((r for r in rows if r.source == s), key=lambda r: keys[r.doc_id])
        extra = [(r.taken - r.epochs * r.size) / r.size for r in own]
        assert extra == sorted(extra, reverse=True)


def test_quality_weights_favour(spark):
    docs = [(i, "one two three", "s%d" % (i % 2)) for i in range(4000)]
    quality = spark.createDataFrame([(i, 4.0 if i % 4 < 2 else 1.0) for i in range(4000)], "doc_id long, weight double")
    rows = mixing.mix(frame(spark, docs), quality, pattern=(1, 3), share=0.5).collect()
    good = sum(r.taken for r in rows if r.doc_id % 4 < 2 and r.source == "s0")
    bad = sum(r.taken for r in rows if r.doc_id % 4 >= 2 and r.source == "s0")
    assert good > 2.5 * bad


def test_edges(spark):
    assert mixing.mix(frame(spark, [(1, "x", "s")]).limit(0)).collect() == []
    rows = mixing.mix(frame(spark, [(1, None, None), (2, "", "s"), (2, "", "s")])).collect()
    assert [(r.target, r.taken) for r in rows] == [(0.0, 0)] * 3
    (row,) = mixing.mix(frame(spark, [(1, "a b c", "s")])).collect()
    assert (row.target, row.taken) == (4.5, 4)
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 0, 0), (None, 1, 1), (3, None, 0)], "doc_id long, quality int, toxic int")
    assert dict(map(tuple, mixing.label_weights(labels).collect())) == {1: 2.0, 2: 0.5, 3: 0.5}


def test_no_python_in_the_plan(spark):
    plan = mixing.mix(frame(spark, make(random.Random(1), 50, ["a", "b"])))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
