"""Base counts against brute force, Viterbi against all paths, held-out accuracy, filtering."""

import itertools
import math
import random
import re

import numpy as np
import pytest

from citybeat.llm import line_crf as crf

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.1"


def base(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    dup, seen = 0, set()
    for x in lines:
        dup += x in seen
        seen.add(x)
    where = {}
    for i in range(len(words) - 4):
        where.setdefault(tuple(words[i : i + 5]), []).append(i)
    hit = {j for at in where.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    n = len(words)
    failed = n < 10 or 100 * len(hit) > 20 * n
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit), failed


TEXTS = [None, "", " \n\t", "a", "one two three four five six seven eight nine ten", "a b c d e " * 6, "x " * 50,
         "l1 a b\nl1 a b\n\n \nl2\x0bl2", "é ü é ü é ü é ü é ü\r\né ü", "##|| <a> $%&*\n" * 3, "w" * 5000, "a b c d"]


@pytest.fixture(scope="module")
def field(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    return crf.train(docs.filter("doc_id % 2 = 0"), labels)


def test_base_counts(spark, field):
    rnd = random.Random(3)
    texts = TEXTS + [" ".join(rnd.choices("ab cd\nef |# ég".split(" "), k=rnd.randint(1, 80))) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in crf.judge_documents(df, field).collect()}
    for k, t in enumerate(texts):
        r = got[k]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(t), t
        assert not (r.base_failed and r.kept)


def test_viterbi_is_the_best_path(field):
    rnd = random.Random(5)
    for _ in range(20):
        lines = ["".join(rnd.choices("abc DEF|#$!. ", k=rnd.randint(1, 40))) + "x" for _ in range(rnd.randint(1, 8))]
        of = crf.Lines.of("\n".join(lines))
        score = crf.line_features(of) @ field.emit

        def total(path):
            return sum(s for s, y in zip(score, path) if y) + sum(field.move[a, b] for a, b in zip(path, path[1:]))

        best = max(total(p) for p in itertools.product((0, 1), repeat=len(lines)))
        assert math.isclose(total(field.label(of).tolist()), best, rel_tol=1e-9, abs_tol=1e-9)


def test_marginals_match_enumeration():
    rnd = np.random.default_rng(2)
    e, m = rnd.normal(size=(1, 4, 2)), rnd.normal(size=(2, 2))
    node, moves = crf._marginals(e, m, np.ones((1, 4)))
    paths = list(itertools.product((0, 1), repeat=4))
    weight = np.array([math.exp(sum(e[0, t, s] for t, s in enumerate(p)) + sum(m[a, b] for a, b in zip(p, p[1:]))) for p in paths])
    weight /= weight.sum()
    assert node[0] == pytest.approx([sum(w for w, p in zip(weight, paths) if p[t]) for t in range(4)])
    assert moves[0, 1] == pytest.approx(sum(w * sum((a, b) == (0, 1) for a, b in zip(p, p[1:])) for w, p in zip(weight, paths)))


def test_held_out_accuracy(spark, field):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = crf.judge_documents(docs.filter("doc_id % 2 = 1"), field).join(labels, "doc_id").filter("NOT base_failed").collect()
    clean, junk = [r for r in rows if r.quality == 1], [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in clean) >= 0.995 * len(clean)
    assert sum(not r.kept for r in junk) >= 0.95 * len(junk)


def test_keep_content_and_lines(spark, field):
    df = spark.createDataFrame(
        [(1, None, "x", None), (2, "plain words in a clean line of prose that goes on for a while.", "y", 7), (None, "a", "z", 1)],
        "doc_id long, text string, quality string, line_no int",
    )
    assert crf.keep_content(df, field).schema == df.schema
    assert [r.doc_id for r in crf.keep_content(df, field).collect()] == [2]
    assert [(r.doc_id, r.line_no, r.content) for r in crf.mark_lines(df, field).collect()][0] == (2, 0, True)
    assert crf.judge_documents(df.limit(0), field).count() == 0


def test_without_labels(spark):
    df = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "doc_id long, text string")
    field = crf.train(df, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert crf.judge_documents(df, field).first().kept
