"""Exact groups against brute force, hot texts salted and not."""

import hashlib
import random
import re

from citybeat.llm import content_sort as cs

SPACE = re.compile(r"[\x20\x09-\x0D]")


def brute(docs):
    groups = {}
    for k, t in docs:
        groups.setdefault(SPACE.sub("", t or ""), []).append((-len(t or ""), k is None, k if k is not None else 0))
    out = []
    for k, t in docs:
        norm = SPACE.sub("", t or "")
        best = min(groups[norm])
        out.append((k, None if best[1] else best[2], len(groups[norm]), hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


def check(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    rows = cs.exact_groups(df).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows), key=str) == brute(docs)
    kept = [r for r in rows if r.kept]
    assert len({r.text_sha256 for r in kept}) == len(kept) == len({r.text_sha256 for r in rows})
    assert all(r.doc_id == r.keep_id for r in kept)


def docs_of(rnd, n, hot):
    texts = ["", None, " \n", "a b", "ab", "a\tb  ", "a b", "é é", "éé"] + [f"t {i}" for i in range(20)]
    docs = [(i, rnd.choice(texts)) for i in range(n)]
    docs += [(1000 + i, "hot text" + " " * rnd.randint(0, 3)) for i in range(hot)]
    docs += [(5, "ab"), (5, "ab"), (None, "ab"), (None, "only null id"), (None, "only null id")]
    rnd.shuffle(docs)
    return docs


def test_small(spark):
    check(spark, docs_of(random.Random(1), 80, 10))


def test_hot_text_is_salted(spark, monkeypatch):
    monkeypatch.setattr(cs, "MIN_RUN", 4)
    check(spark, docs_of(random.Random(2), 120, 150))


def test_keep_first_carries_every_column(spark, monkeypatch):
    monkeypatch.setattr(cs, "MIN_RUN", 4)
    docs = docs_of(random.Random(3), 60, 40)
    df = spark.createDataFrame([(k, t, i, "n") for i, (k, t) in enumerate(docs)], "doc_id long, text string, place int, norm string")
    kept = cs.keep_first(df)
    assert kept.columns == df.columns
    rows = kept.collect()
    best = {}
    for k, t in docs:
        norm = SPACE.sub("", t or "")
        best[norm] = min(best.get(norm, (1, True, 0)), (-len(t or ""), k is None, k or 0))
    got = {SPACE.sub("", r.text or ""): (-len(r.text or ""), r.doc_id is None, r.doc_id or 0) for r in rows}
    assert len(rows) == len(best) and got == best
    assert all(docs[r.place] == (r.doc_id, r.text) for r in rows)


def test_native_plan_and_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    out = cs.exact_groups(df)
    assert out.count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "rangepartitioning" in plan
