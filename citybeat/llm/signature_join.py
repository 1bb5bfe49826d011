"""N-gram Jaccard join with signature trees.

A document's set holds its distinct five-word shingles (64-bit names).  Two
documents link when their sets' Jaccard similarity is at least ``THRESHOLD``.

A *signature tree* holds the sets of one bucket: leaves of a few sets, each
node with the OR (and AND) of its members' token bitmaps and the range of set
sizes.  A dual traversal walks pairs of nodes and drops a pair when the largest
overlap any two members could have - the sizes' bound, and the size less the
bits one side has and the other lacks - cannot reach the threshold, or when
all members already are in one component.  Leaf pairs are bounded set by set,
what is left is compared exactly.

Which sets meet in a bucket, so that no link is lost:

1. Equal sets are one class (partial aggregation), represented by one row.
2. Two rounds of buckets keyed by the smallest shingle under two hash orders
   join most near copies early; a bucket is dealt to chunks of ``CHUNK`` sets
   at random, so a copy group in a third of all rows spreads over many tasks
   and its chunks merge in the other round.
3. Exact rest: linked sets share a token among the first
   ``n - ceil(t n) + 1`` of any common token order.  Tokens seen often (a
   bounded list, ``FREQUENT``) come last in the order, so a widespread passage
   rarely is in a prefix.  Prefix tokens that join two components of step 2
   form the last buckets; their trees give candidate pairs of different
   components (what two sets can share from the bucket's token on bounds the
   overlap as well, and of a prefix only the tokens count that another
   component's prefix holds), which are compared on whole sets.  A pair that
   surely met in an earlier bucket is left to that one.

Edge cases: null or empty texts have the empty set and link with nothing;
texts under five words have one shingle, the whole sequence; null ids take the
component of their class; repeated rows fall into one class; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citybeat.llm.common import discard, list_column, map_rows, materialise, numbered
from citybeat.llm.components import components

#: Similarity as a fraction, 75 / 100.
NUM, DEN = 75, 100
WORDS = 5
CHUNK = 512
#: Bound of the list of tokens that come last in the order.
FREQUENT = 1 << 16
BITS = 1024
#: Slices of the token space that are counted one after the other (each needs its share of shuffle space).
SLICES = 4
LEAF, FANOUT = 16, 4
#: Shared tokens before its own that a member names, to know pairs that met before.
BEFORE = 4
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def _mix(x: np.ndarray, k: int = 0) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX[k]
    return x ^ (x >> np.uint64(29))


class Shingler:
    """Names of a text's distinct shingles, sorted."""

    def __init__(self, size: int = WORDS):
        self.size = size
        self._names: dict[bytes, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode("utf-8", "replace").lower().split()
        if not words:
            return np.empty(0, dtype=np.uint64)
        names = self._names
        if len(names) > 200_000:
            names.clear()
        for w in set(words).difference(names):
            names[w] = xxhash.xxh3_64_intdigest(w)
        ids = np.fromiter(map(names.__getitem__, words), np.uint64, len(words))
        n = max(1, len(ids) - self.size + 1)
        total = np.full(n, min(len(ids), self.size), dtype=np.uint64)
        for i in range(min(self.size, len(ids))):
            total = _mix(total) + ids[i : i + n]
        return np.unique(_mix(total, 1))


def prefix_length(n: int) -> int:
    """Tokens of a set that any linked set must share one of."""
    return n - -(-NUM * n // DEN) + 1 if n else 0


def prefix_lengths(n: np.ndarray) -> np.ndarray:
    return n - -(-NUM * n // DEN) + 1


def linked(overlap: int, a: int, b: int) -> bool:
    return DEN * overlap >= NUM * (a + b - overlap)


def bitmap(tokens: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Token bitmap as 64-bit words."""
    flags = np.zeros(bits, dtype=np.uint8)
    flags[(tokens >> np.uint64(7)) & np.uint64(bits - 1)] = 1
    return np.packbits(flags).view(np.uint64)


class SignatureTree:
    """Nodes over sets sorted by size; arrays per level, leaves first."""

    def __init__(self, sizes: np.ndarray, maps: np.ndarray):
        self.order = np.lexsort((maps[:, 0], sizes))
        self.sizes, self.maps = sizes[self.order], maps[self.order]
        self.levels = []
        any_, all_, low, high = self.maps, self.maps, self.sizes, self.sizes
        step = LEAF
        while True:
            cuts = np.arange(0, len(low), step)
            any_, all_ = np.bitwise_or.reduceat(any_, cuts), np.bitwise_and.reduceat(all_, cuts)
            low, high = np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts)
            self.levels.append((any_, all_, low, high))
            if len(cuts) == 1:
                break
            step = FANOUT

    @staticmethod
    def possible(a, b) -> np.ndarray:
        """Whether members of the nodes (any, all, low, high) of ``a`` and ``b`` could link."""
        any_a, all_a, low_a, high_a = a
        any_b, all_b, low_b, high_b = b
        most = np.minimum(
            high_a - np.bitwise_count(all_a & ~any_b).sum(axis=-1, dtype=np.int64),
            high_b - np.bitwise_count(all_b & ~any_a).sum(axis=-1, dtype=np.int64),
        )
        least = np.maximum(low_a, low_b)
        # overlap / (a + b - overlap) is largest for the smallest sizes that hold the overlap
        union = np.maximum(low_a, most) + np.maximum(low_b, most) - most
        return (most > 0) & (DEN * most >= NUM * union) & (DEN * np.minimum(high_a, high_b) >= NUM * least)

    def pairs(self, settled):
        """Pairs of leaf positions (ranges) that could hold a link; ``settled(lo, hi, lo2, hi2)`` drops more."""
        top = len(self.levels) - 1
        stack = [(top, 0, 0)]
        spans = [LEAF * FANOUT**k for k in range(top + 1)]
        n = len(self.sizes)
        while stack:
            level, i, j = stack.pop()
            span = spans[level]
            lo, hi, lo2, hi2 = i * span, min(n, (i + 1) * span), j * span, min(n, (j + 1) * span)
            if settled(lo, hi, lo2, hi2):
                continue
            if level == 0:
                yield lo, hi, lo2, hi2
                continue
            nodes = self.levels[level - 1]
            left = np.arange(i * FANOUT, min(len(nodes[2]), (i + 1) * FANOUT))
            right = np.arange(j * FANOUT, min(len(nodes[2]), (j + 1) * FANOUT))
            ii, jj = (x.ravel() for x in np.meshgrid(left, right, indexing="ij"))
            keep = ii <= jj
            ii, jj = ii[keep], jj[keep]
            fine = self.possible(tuple(x[ii] for x in nodes), tuple(x[jj] for x in nodes)) | (ii == jj)
            stack += [(level - 1, int(x), int(y)) for x, y in zip(ii[fine], jj[fine])]

    def candidates(self, settled):
        """Pairs of positions (in the caller's numbering) within a leaf pair that could link."""
        for lo, hi, lo2, hi2 in self.pairs(settled):
            a = (self.maps[lo:hi, None], self.maps[lo:hi, None], self.sizes[lo:hi, None], self.sizes[lo:hi, None])
            b = (self.maps[None, lo2:hi2], self.maps[None, lo2:hi2], self.sizes[None, lo2:hi2], self.sizes[None, lo2:hi2])
            x, y = np.nonzero(self.possible(a, b))
            for i, j in zip((x + lo).tolist(), (y + lo2).tolist()):
                if i < j:
                    yield int(self.order[i]), int(self.order[j])


class Forest:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> None:
        self.up[self.find(j)] = self.find(i)


def _one_group(tree: SignatureTree, forest: Forest):
    def settled(lo, hi, lo2, hi2) -> bool:
        first = forest.find(int(tree.order[lo]))
        return all(forest.find(int(tree.order[k])) == first for r in (range(lo, hi), range(lo2, hi2)) for k in r)

    return settled


def link_sets(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links (positions) that span the components of the bucket's sets."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    bits = 256
    while bits < 4 * np.median(sizes) and bits < 1 << 16:
        bits *= 2
    tree = SignatureTree(sizes, np.stack([bitmap(s, bits) for s in sets]))
    forest, links = Forest(len(sets)), []
    for i, j in tree.candidates(_one_group(tree, forest)):
        if forest.find(i) == forest.find(j):
            continue
        overlap = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        if linked(overlap, len(sets[i]), len(sets[j])):
            forest.join(i, j)
            links.append((i, j))
    return links


def _frequent(rows: DataFrame) -> np.ndarray:
    """At most ``FREQUENT`` tokens that stand out inside a task's share, rarest first."""

    def process(batches):
        shingles = Shingler()
        held: list[np.ndarray] = []

        def counted() -> dict[str, list]:
            tokens, n = np.unique(np.concatenate(held), return_counts=True) if held else (np.empty(0, np.uint64), np.empty(0, int))
            held.clear()
            often = n >= 8
            return {"token": tokens[often].view(np.int64).tolist(), "n": n[often].tolist()}

        for batch in batches:
            held += [shingles(t) for t in batch["text"]]
            if sum(map(len, held)) > 2_000_000:
                yield counted()
        yield counted()

    counts = map_rows(rows, ["text"], process, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    top = counts.orderBy(F.desc("n"), "token").limit(FREQUENT).collect()
    return np.array([r.token for r in reversed(top)], dtype=np.int64).view(np.uint64)


def _signatures(rows: DataFrame, frequent: np.ndarray) -> DataFrame:
    """Per document: class name, set size, two bucket keys, bitmap, prefix tokens and the last one's place in the order."""
    by_token = np.argsort(frequent)
    known = frequent[by_token]

    def last_place(token: np.ndarray) -> int:
        if len(known):
            at = min(int(np.searchsorted(known, token)), len(known) - 1)
            if known[at] == token:
                return (1 << 62) + int(by_token[at])
        return int(token) >> 2

    def prefix(tokens: np.ndarray) -> np.ndarray:
        want = prefix_length(len(tokens))
        if not len(known):
            return tokens[:want]
        at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
        often = known[at] == tokens
        rare = tokens[~often]
        if len(rare) >= want:
            return rare[:want]
        last = tokens[often][np.argsort(by_token[at[often]], kind="stable")]
        return np.concatenate([rare, last])[:want]

    def process(batches):
        shingles = Shingler()
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("doc_id", "th", "cid", "n", "k1", "k2", "map", "prefix", "end")}
            for k, th, text in zip(batch["doc_id"], batch["th"], batch["text"]):
                tokens = shingles(text)
                some = len(tokens) > 0
                out["doc_id"].append(k)
                out["th"].append(th)
                out["n"].append(len(tokens))
                digest = xxhash.xxh3_64_intdigest(tokens.tobytes())
                out["cid"].append(digest - (1 << 64) if digest >> 63 else digest)
                out["k1"].append(int(tokens[0].view(np.int64)) if some else None)
                out["k2"].append(int(_mix(tokens, 2).min().view(np.int64)) if some else None)
                out["map"].append(bitmap(tokens).tobytes())
                first = prefix(tokens)
                out["prefix"].append(first.view(np.int64))
                out["end"].append(last_place(first[-1]) if some else None)
            out["prefix"] = list_column(out["prefix"], pa.int64())
            yield out

    schema = "doc_id long, th long, cid long, n long, k1 long, k2 long, map binary, prefix array<long>, end long"
    return map_rows(rows, ["doc_id", "th", "text"], process, schema)


def _sets(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cid, tokens) of the wanted classes, from the text of one row each."""
    joined = rows.join(
        wanted.select("cid", F.col("doc_id").alias("_d"), F.col("th").alias("_t")),
        F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_t")),
    )

    def process(batches):
        shingles, last = Shingler(), None
        for batch in batches:
            cids, tokens = [], []
            for cid, text in zip(batch["cid"], batch["text"]):
                # The join leaves rows that repeat id and text side by side; should one slip
                # through, its class meets itself, which adds no link.
                if cid != last:
                    cids.append(cid)
                    tokens.append(shingles(text).view(np.int64))
                last = cid
            yield {"cid": cids, "tokens": list_column(tokens, pa.int64())}

    return map_rows(joined, ["cid", "text"], process, "cid long, tokens array<long>")


def _bucket_links(members: DataFrame) -> DataFrame:
    """Links inside every (round, key, chunk) bucket of (cid, tokens) rows."""
    keys = ["round", "key", "chunk"]
    dealt = members.repartition(*keys).sortWithinPartitions(*keys)

    def process(batches):
        now, cids, sets = None, [], []

        def flush() -> dict[str, list]:
            found = link_sets(sets) if len(sets) > 1 else []
            return {"a": [cids[i] for i, _ in found], "b": [cids[j] for _, j in found]}

        for batch in batches:
            for bucket, cid, tokens in zip(zip(*(batch[k] for k in keys)), batch["cid"], batch["tokens"]):
                if bucket != now:
                    if now is not None:
                        yield flush()
                    now, cids, sets = bucket, [], []
                cids.append(cid)
                sets.append(np.array(tokens, dtype=np.int64).view(np.uint64))
        if now is not None:
            yield flush()

    return map_rows(dealt, [*keys, "cid", "tokens"], process, "a long, b long")


def _within(n_a, n_b, most) -> np.ndarray:
    """Whether sets of these sizes that share at most ``most`` tokens could link."""
    return DEN * most >= NUM * (n_a + n_b - most)


class Members:
    """Columns of whole buckets: size, place of the bucket's token in the set's order, component, bitmap,
    where the prefix ends in the common order, shared tokens from the bucket's on, and shared ones before it."""

    def __init__(self, batch: pa.Table):
        column = lambda c: batch.column(c).to_numpy()
        self.cid, self.n, self.place, self.comp, self.end, shared = (column(c) for c in ("cid", "n", "place", "comp", "end", "left"))
        self.most = shared + self.n - prefix_lengths(self.n)
        self.before = [column(f"before{k}") for k in range(BEFORE)]
        self.maps = np.frombuffer(b"".join(batch.column("map").to_pylist()), np.uint64).reshape(len(self.cid), -1)
        changed = (np.diff(column("key")) != 0) | (np.diff(column("part")) != 0)
        self.starts = np.concatenate([[0], np.flatnonzero(changed) + 1])
        self.sizes = np.diff(np.concatenate([self.starts, [len(self.cid)]]))

    def open(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Pairs of different components that may link.

        In the bucket of the first token two sets share, neither holds an
        earlier one of the other's: what is shared lies from that place on.
        The prefix that ends first in the common order shares of its tokens
        only those that are in the other's prefix too, and what is after it.
        """
        n_a, n_b = self.n[i], self.n[j]
        most = np.minimum(n_a - self.place[i], n_b - self.place[j])
        first, second = self.end[i] <= self.end[j], self.end[j] <= self.end[i]
        most = np.minimum(most, np.where(first, self.most[i], most))
        most = np.minimum(most, np.where(second, self.most[j], most))
        fine = np.flatnonzero((self.comp[i] != self.comp[j]) & _within(n_a, n_b, most))
        a, b = (self.maps[k[fine]] for k in (i, j))
        fine = fine[SignatureTree.possible((a, a, n_a[fine], n_a[fine]), (b, b, n_b[fine], n_b[fine]))]
        met = np.zeros(len(fine), bool)
        for x in self.before:
            for y in self.before:
                met |= x[i[fine]] == y[j[fine]]
        return fine[~met]

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Candidate pairs of all buckets; a bucket that fills one leaf has no tree above it."""
        found = []
        for m in np.unique(self.sizes):
            at = self.starts[self.sizes == m]
            if 1 < m <= LEAF:
                x, y = np.triu_indices(m, 1)
                step = max(1, 100_000 // len(x))
                for lo in range(0, len(at), step):
                    i, j = ((at[lo : lo + step, None] + k).ravel() for k in (x, y))
                    keep = self.open(i, j)
                    found.append((i[keep], j[keep]))
            elif m > LEAF:
                for start in at.tolist():
                    if len(np.unique(self.comp[start : start + m])) > 1:
                        found += self._walk(start, int(m))
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        i, j = (np.concatenate(k) for k in zip(*found))
        a, b = np.minimum(self.cid[i], self.cid[j]), np.maximum(self.cid[i], self.cid[j])
        return np.unique(np.stack([a, b], axis=1), axis=0).T

    def _walk(self, start: int, m: int):
        """Dual traversal of one bucket's tree."""
        span = np.s_[start : start + m]
        tree = SignatureTree(self.n[span], self.maps[span])
        rows = tree.order + start
        group = self.comp[rows]
        settled = lambda lo, hi, lo2, hi2: (group[lo:hi] == group[lo]).all() and (group[lo2:hi2] == group[lo]).all()
        for lo, hi, lo2, hi2 in tree.pairs(settled):
            x, y = (k.ravel() for k in np.meshgrid(np.arange(lo, hi), np.arange(lo2, hi2), indexing="ij"))
            x, y = x[x < y], y[x < y]
            i, j = rows[x], rows[y]
            keep = self.open(i, j)
            if len(keep):
                yield i[keep], j[keep]


def _candidate_pairs(members: DataFrame) -> DataFrame:
    """Pairs of classes of different components that a bucket's tree cannot rule out."""
    keys = ["key", "part"]
    dealt = members.repartition(*keys).sortWithinPartitions(*keys).select(*keys, *(c for c in members.columns if c not in keys))

    def found(table: pa.Table) -> pa.RecordBatch:
        a, b = Members(table).pairs()
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def run(batches):
        rest: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            rest = pa.concat_tables([rest, table]).combine_chunks() if rest is not None else table
            if not rest.num_rows:
                rest = None
                continue
            cut = int(Members(rest).starts[-1])  # the last bucket may go on
            if cut:
                yield found(rest.slice(0, cut).combine_chunks())
                rest = rest.slice(cut).combine_chunks()
        if rest is not None and rest.num_rows:
            yield found(rest)

    return dealt.mapInArrow(run, "a long, b long").distinct()


def _parts(rows: DataFrame, size: str, most: int) -> DataFrame:
    """Deal a bucket of more than ``most`` members to pairs of blocks, so that every two members meet."""
    blocks = F.ceil(F.col(size) / F.lit(most)).cast("int")
    mine = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    other = F.sequence(F.lit(0), F.col("blocks") - 1)
    pair = F.transform(other, lambda o: F.least(o, F.col("mine")) * F.col("blocks") + F.greatest(o, F.col("mine")))
    return (
        rows.withColumn("blocks", blocks)
        .withColumn("mine", mine)
        .withColumn("part", F.explode(F.when(F.col("blocks") > 1, pair).otherwise(F.array(F.lit(0)))))
        .drop("blocks", "mine", size)
    )


def _fold(map_: np.ndarray, words: int) -> np.ndarray:
    """A bitmap of a smaller power of two of words."""
    return np.bitwise_or.reduce(map_.reshape(-1, words), axis=0)


def _wide_map(tokens: np.ndarray) -> bytes:
    """Bitmap of eight bits or more per token, in words by the low bits of the token (so that it folds)."""
    bits = 1 << max(9, int(8 * max(1, len(tokens)) - 1).bit_length())
    flags = np.zeros(bits, dtype=np.uint8)
    flags[(tokens >> np.uint64(7)) & np.uint64(bits - 1)] = 1
    return np.packbits(flags).tobytes()


def _exact_links(rows: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The candidate pairs whose whole sets reach the threshold; wide bitmaps rule most of the others out first."""
    members = pairs.select(F.col("a").alias("cid")).unionByName(pairs.select(F.col("b").alias("cid"))).distinct()
    sets = materialise(_sets(rows, classes.join(members, "cid", "left_semi")), "jaccard-pair-sets")

    def wide(batches):
        for batch in batches:
            maps = [_wide_map(np.array(t, dtype=np.int64).view(np.uint64)) for t in batch["tokens"]]
            yield {"cid": batch["cid"], "n": [len(t) for t in batch["tokens"]], "wide": maps}

    maps = materialise(map_rows(sets, ["cid", "tokens"], wide, "cid long, n long, wide binary"), "jaccard-wide")

    def test(batches):
        for batch in batches:
            out: dict[str, list] = {"a": [], "b": []}
            for a, b, n_a, n_b, w_a, w_b in zip(*(batch[c] for c in ("a", "b", "na", "nb", "wa", "wb"))):
                x, y = (np.frombuffer(w, np.uint64) for w in (w_a, w_b))
                words = min(len(x), len(y))
                x, y = _fold(x, words), _fold(y, words)
                most = min(n_a - int(np.bitwise_count(x & ~y).sum()), n_b - int(np.bitwise_count(y & ~x).sum()))
                if _within(n_a, n_b, most):
                    out["a"].append(a)
                    out["b"].append(b)
            yield out

    side = lambda k: maps.select(F.col("cid").alias(k), F.col("n").alias(f"n{k}"), F.col("wide").alias(f"w{k}"))
    tested = pairs.join(side("a"), "a").join(side("b"), "b")
    close = materialise(map_rows(tested, ["a", "b", "na", "nb", "wa", "wb"], test, "a long, b long"), "jaccard-close")
    a = sets.select(F.col("cid").alias("a"), F.col("tokens").alias("ta"))
    b = sets.select(F.col("cid").alias("b"), F.col("tokens").alias("tb"))
    overlap = F.size(F.array_intersect("ta", "tb")).cast("long")
    both = close.join(a, "a").join(b, "b").select("a", "b", overlap.alias("x"), (F.size("ta") + F.size("tb")).alias("s"))
    return both.filter(F.lit(DEN) * F.col("x") >= F.lit(NUM) * (F.col("s") - F.col("x"))).select("a", "b")


def _linked_rows(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row per document: doc_id, th (64-bit text hash), n, comp (label), component_id."""
    rows = df.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("th", F.xxhash64("text"))
    signed = materialise(_signatures(rows, _frequent(rows)), "jaccard-signatures")

    full = signed.filter("n > 0")
    classes = materialise(
        full.groupBy("cid")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "th")).alias("r"), F.min("n").alias("n"), F.min("k1").alias("k1"), F.min("k2").alias("k2"))
        .select("cid", "n", "k1", "k2", "r.doc_id", "r.th"),
        "jaccard-classes",
    )

    # Early rounds.
    keyed = classes.select("cid", F.lit(1).alias("round"), F.col("k1").alias("key")).unionByName(
        classes.select("cid", F.lit(2).alias("round"), F.col("k2").alias("key"))
    )
    crowded = keyed.groupBy("round", "key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    chunk = F.pmod(F.xxhash64("cid", "round"), F.ceil(F.col("c") / F.lit(CHUNK))).cast("int")
    dealt = materialise(keyed.join(crowded, ["round", "key"]).select("cid", "round", "key", chunk.alias("chunk")), "jaccard-buckets")
    sets = materialise(_sets(rows, classes.join(dealt.select("cid").distinct(), "cid", "left_semi")), "jaccard-sets")
    early = materialise(_bucket_links(dealt.join(sets, "cid")), "jaccard-early")
    joined = components(early)
    discard(dealt, sets)

    # Exact rest: one row per class, tokens that two components share.
    grouped = classes.join(joined, F.col("cid") == F.col("node"), "left").select(
        "cid", F.col("doc_id").alias("_d"), F.col("th").alias("_t"), F.coalesce("label", "cid").alias("comp")
    )
    of_class = materialise(
        full.select("cid", "doc_id", "th", "n", "map", "prefix", "end")
        .join(
            grouped.withColumnRenamed("cid", "_c"),
            (F.col("cid") == F.col("_c")) & F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_t")),
        )
        .select("cid", "n", "comp", "map", "prefix", "end"),
        "jaccard-prefixes",
        "zstd",
    )
    members: DataFrame | None = None
    slices: list[DataFrame] = []
    for turn in range(SLICES):
        mine = F.pmod("key", F.lit(SLICES)) == turn
        tokens = of_class.select("comp", F.explode("prefix").alias("key")).filter(mine)
        shared = tokens.groupBy("key").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).filter("c0 < c1")
        shared = materialise(shared.select("key"), "jaccard-shared")
        places = of_class.select("cid", F.posexplode("prefix").alias("place", "key")).filter(mine)
        found = materialise(places.join(shared, "key", "left_semi"), "jaccard-members")
        members = found if members is None else members.unionByName(found)
        slices += [shared, found]
    crowds = members.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > 2 * CHUNK)
    crowds = materialise(crowds, "jaccard-crowds")
    members = (
        members.join(crowds, "key", "left")
        .withColumn("c", F.coalesce("c", F.lit(1)))
        .join(of_class.select("cid", "n", "comp", "map", "end"), "cid")
    )
    # a set's shared tokens in the common order: how many come from here on, and which ones just before
    order = Window.partitionBy("cid").orderBy("place")
    members = members.withColumns(
        {"left": F.count(F.lit(1)).over(order.rowsBetween(0, Window.unboundedFollowing))}
        | {f"before{k}": F.coalesce(F.lag("key", k + 1).over(order), "cid") for k in range(BEFORE)}
    )
    pairs = materialise(_candidate_pairs(_parts(members, "c", 2 * CHUNK)), "jaccard-pairs")
    discard(of_class, crowds, *slices)
    late = _exact_links(rows, classes, pairs)
    linked_classes = components(early.unionByName(late))

    # The smallest document of every component.
    named = materialise(
        classes.join(linked_classes, F.col("cid") == F.col("node"), "left").select(
            "cid", "doc_id", F.coalesce("label", "cid").alias("comp")
        ),
        "jaccard-named",
    )
    least = named.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    of = named.join(least, "comp").select(F.col("cid").alias("_c"), "comp", "component_id")
    return signed.join(of, (F.col("cid") == F.col("_c")) & (F.col("n") > 0), "left").select(
        "doc_id", "th", "n", "comp", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def link_documents(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    return _linked_rows(df, key, text).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The document with the smallest id of every component, and documents without words, every column as it was.

    Rows that repeat both id and text are one document and stay together.
    """
    rows, names = numbered(df)
    key, text = names[key], names[text]
    found = materialise(_linked_rows(rows, key, text).select("doc_id", "th", "n", "comp"), "jaccard-rows")
    first = (
        found.filter("n > 0")
        .groupBy("comp")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "th")).alias("r"))
        .select("r.doc_id", "r.th")
    )
    stay = first.unionByName(found.filter("n = 0").select("doc_id", "th")).distinct()
    stay = stay.select(F.col("doc_id").alias("_d"), F.col("th").alias("_t"))
    th = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    kept = rows.join(stay, F.col(key).cast("long").eqNullSafe(F.col("_d")) & (th == F.col("_t")), "left_semi")
    return kept.toDF(*df.columns)
