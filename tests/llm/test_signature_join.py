"""Jaccard components against brute force over all pairs."""

import random
import re

import numpy as np

from citybeat.llm import signature_join as sj

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    w = SPACE.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(docs):
    """docs: list of (doc_id, text) -> list of (doc_id, n, component)."""
    sets = [shingle_set(t) for _, t in docs]
    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    up = list(range(len(docs)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, s in enumerate(sets):
        share = {}
        for x in s:
            for j in holders[x]:
                if j < i:
                    share[j] = share.get(j, 0) + 1
        for j, o in share.items():
            if 100 * o >= 75 * (len(s) + len(sets[j]) - o):
                up[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(docs):
        least[find(i)] = min(least.get(find(i), k), k)
    return sorted((k, len(sets[i]), least[find(i)] if sets[i] else k) for i, (k, _) in enumerate(docs))


def compare(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = sorted(tuple(r) for r in sj.link_documents(df).collect())
    assert got == brute(docs)


def test_near_copies_and_edges(spark):
    rnd = random.Random(2)
    vocab = [f"w{i}" for i in range(60)]
    docs, k = [(0, None), (1, ""), (2, "  \n"), (3, "One two"), (4, "one  TWO"), (5, "one two three")], 6
    for _ in range(12):
        base = rnd.choices(vocab, k=rnd.randint(5, 120))
        for _ in range(rnd.randint(1, 9)):
            t = list(base)
            for _ in range(rnd.randint(0, 4)):
                t[rnd.randrange(len(t))] = rnd.choice(vocab)
            docs.append((k, " ".join(t[: len(t) - rnd.randint(0, 4)])))
            k += 1
    docs += [(k, docs[9][1]), (k + 1, docs[9][1])]
    compare(spark, docs)


def test_chains_at_the_threshold(spark):
    # windows over one long text: neighbours link, distant ones do not
    words = [f"u{i}" for i in range(400)]
    docs = [(i, " ".join(words[7 * i : 7 * i + 60])) for i in range(40)]
    docs += [(100 + i, " ".join(words[9 * i : 9 * i + 60])) for i in range(30)]
    random.Random(1).shuffle(docs)
    compare(spark, docs)


def test_exact_rest_alone(spark, monkeypatch):
    """Without the early rounds the prefix buckets find every link; small blocks make pairs of blocks meet."""
    monkeypatch.setattr(sj, "_bucket_links", lambda members: members.sparkSession.createDataFrame([], "a long, b long"))
    monkeypatch.setattr(sj, "CHUNK", 2)
    rnd = random.Random(4)
    base = [f"v{i}" for i in range(50)]
    docs = []
    for i in range(30):
        t = list(base)
        for _ in range(rnd.randint(0, 3)):
            t[rnd.randrange(50)] = f"x{rnd.randrange(20)}"
        docs.append((i, " ".join(t)))
    compare(spark, docs)


def test_tree_loses_no_link():
    rnd = np.random.default_rng(0)
    sets = []
    for _ in range(20):
        base = rnd.integers(0, 2**63, rnd.integers(1, 80), dtype=np.uint64)
        for _ in range(10):
            keep = base[rnd.random(len(base)) > rnd.random() * 0.3]
            sets.append(np.unique(np.concatenate([keep, rnd.integers(0, 2**63, rnd.integers(0, 6), dtype=np.uint64)])))
    sets = [s for s in sets if len(s)]
    tree = sj.SignatureTree(np.array([len(s) for s in sets]), np.stack([sj.bitmap(s, 256) for s in sets]))
    got = {tuple(sorted(p)) for p in tree.candidates(lambda *_: False)}
    want = {
        (i, j)
        for i in range(len(sets))
        for j in range(i + 1, len(sets))
        if sj.linked(len(np.intersect1d(sets[i], sets[j])), len(sets[i]), len(sets[j]))
    }
    assert want and want <= got
    assert len(got) < len(sets) * (len(sets) - 1) / 2


def test_empty_table(spark):
    assert sj.link_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_driver_documents(spark):
    import duckdb

    compare(spark, duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.01/documents.parquet'").fetchall())


def bucket(key, left, before):
    """Two equal sets of 100 tokens, of different components, in one bucket."""
    import pyarrow as pa

    tokens = sj.bitmap(np.arange(100, dtype=np.uint64) << np.uint64(7)).tobytes()
    rows = {"key": [key] * 2, "part": [0] * 2, "cid": [1, 2], "n": [100] * 2, "place": [0] * 2, "comp": [1, 2], "end": [9] * 2}
    rows |= {"left": [left] * 2, "map": [tokens] * 2}
    rows |= {f"before{k}": before if k == 1 else [1, 2] for k in range(sj.BEFORE)}
    return sj.Members(pa.table(rows)).pairs()


def test_a_pair_is_left_to_the_first_bucket_it_meets_in():
    assert [k.tolist() for k in bucket(7, 26, [1, 2])] == [[1], [2]]
    assert bucket(8, 26, [7, 7])[0].tolist() == []


def test_prefix_tokens_no_other_component_holds_are_not_shared():
    # 26 tokens of the prefix and 74 after it; a link needs 86 in common
    assert bucket(7, 12, [1, 2])[0].tolist() == [1]
    assert bucket(7, 11, [1, 2])[0].tolist() == []
