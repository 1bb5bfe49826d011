"""Periodic runs of words, by recompression.

The words of a task's documents are joined in batches, a symbol of its own
between any two documents.  ``Grammar`` compresses a batch by turns: blocks of
one repeated symbol become one symbol, then pairs of neighbours, one from each
half of an alphabet split by hash.  Equal stretches are parsed alike up to
their ends, so the common extension of two places is read off the levels: up
while both stand at the edge of a rule, down from the first unequal symbols,
at most one rule's children passed on each level.  No suffix array is built.

A run of period q and at least ``4 * q`` words covers four successive
multiples of q.  These harmonic-grid places are compared first (three
equalities), what is left is extended exactly both ways by the grammar, and
the run is kept when its length suffices.  The smallest period of an interval
is among those found (every period up to a quarter of its length is).

Edge cases: null and empty texts have no words, no run and the digests of
empty strings; a null id counts as the empty string in ``planted_words``;
repeated rows give repeated results; extra columns are ignored; an empty table
gives an empty result.  A text is handled whole, in one step, however long it is.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from citybeat.llm.common import map_rows

#: Words joined to one batch; a longer text is a batch of its own.
BATCH_WORDS = 1 << 17
#: Grid places looked at together.
GRID_STEP = 1 << 20
#: A run has at least so many words, and so many times its period.
MIN_LENGTH, MIN_PERIODS = 6, 4

_ODD = np.uint64(0x9E3779B97F4A7C15)


class Grammar:
    """Run-length grammar of ``symbols``, whose first and last symbol occur only once.

    Level 0 is the input.  ``sym[k]`` are the symbols of level k; ``parent[k]``
    names for each the place of its rule on level k + 1, and ``first[k]`` for
    each place of level k + 1 (and one past the end) its first child on level k.
    ``block[k]`` tells whether level k + 1 was made by blocks or by pairs.
    """

    def __init__(self, symbols: np.ndarray) -> None:
        self.sym: list[np.ndarray] = [symbols.astype(np.int64)]
        self.parent: list[np.ndarray] = []
        self.first: list[np.ndarray] = []
        self.block: list[bool] = []
        self._names = int(symbols.max()) + 1
        turn = 0
        while np.bincount(self.sym[-1]).max() > 1:
            self._blocks()
            self._pairs(turn)
            turn += 1

    def _add(self, starts: np.ndarray, sym: np.ndarray, block: bool) -> None:
        below = len(self.sym[-1])
        mark = np.zeros(below, np.int64)
        mark[starts[1:]] = 1
        self.parent.append(np.cumsum(mark))
        self.first.append(np.append(starts, below))
        self.sym.append(sym)
        self.block.append(block)

    def _name(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """One new symbol for every distinct (a, b)."""
        width = int(b.max()) + 1
        keys, which = np.unique(a * width + b, return_inverse=True)
        self._names += len(keys)
        return which + (self._names - len(keys))

    def _blocks(self) -> None:
        sym = self.sym[-1]
        starts = np.flatnonzero(np.append(True, sym[1:] != sym[:-1]))
        if len(starts) == len(sym):
            return
        counts = np.diff(np.append(starts, len(sym)))
        out, many = sym[starts], counts > 1
        out[many] = self._name(out[many], counts[many])
        self._add(starts, out, True)

    def _pairs(self, turn: int) -> None:
        sym = self.sym[-1]
        mixed = (sym.astype(np.uint64) + np.uint64(turn)) * _ODD
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _ODD
        left = (mixed >> np.uint64(40)) & np.uint64(1) == 0
        heads = left[:-1] & ~left[1:]
        if not heads.any():
            return
        tails = np.append(False, heads)
        starts = np.flatnonzero(~tails)
        out, paired = sym[starts], np.append(heads, False)[starts]
        at = starts[paired]
        out[paired] = self._name(sym[at], sym[at + 1])
        self._add(starts, out, False)

    def extend(self, i: np.ndarray, j: np.ndarray, step: int) -> np.ndarray:
        """Number of equal symbols from places i and j on (i != j), forward (step 1) or backward (-1)."""
        a, b = i.copy(), j.copy()
        stop = np.full(len(i), -1, np.int64)
        live = np.arange(len(i))
        for k in range(len(self.parent)):
            if not len(live):
                break
            sym, parent, first = self.sym[k], self.parent[k], self.first[k]
            same = sym[a[live]] == sym[b[live]]
            stop[live[~same]] = k
            live = live[same]
            x, y = a[live], b[live]
            px, py = parent[x], parent[y]
            # symbols up to the rule's end in the direction, this one included
            rx = first[px + 1] - x if step > 0 else x - first[px] + 1
            ry = first[py + 1] - y if step > 0 else y - first[py] + 1
            whole = (rx == first[px + 1] - first[px]) & (ry == first[py + 1] - first[py])
            if self.block[k]:
                ends = ~whole & (rx != ry)
                m = np.minimum(rx, ry)
                a[live] = np.where(ends, x + step * m, np.where(whole, px, px + step))
                b[live] = np.where(ends, y + step * m, np.where(whole, py, py + step))
                stop[live[ends]] = k
                live = live[~ends]
            else:
                a[live] = np.where(whole, px, px + step)
                b[live] = np.where(whole, py, py + step)
        stop[live] = len(self.parent)
        for k in range(len(self.parent) - 1, -1, -1):
            down = np.flatnonzero(stop > k)
            if not len(down):
                continue
            sym, first = self.sym[k], self.first[k]
            pa, pb = a[down], b[down]
            x = first[pa] if step > 0 else first[pa + 1] - 1
            y = first[pb] if step > 0 else first[pb + 1] - 1
            same = sym[x] == sym[y]
            m = same.astype(np.int64)
            if self.block[k]:
                m *= np.minimum(first[pa + 1] - first[pa], first[pb + 1] - first[pb])
            a[down] = x + step * m
            b[down] = y + step * m
        return (a - i) * step


def find_runs(ids: list[np.ndarray]) -> list[np.ndarray]:
    """Per sequence its runs as rows (start, length, period), by start, then period."""
    lengths = np.array([len(x) for x in ids], np.int64)
    runs: list[np.ndarray] = [np.empty((0, 3), np.int64)] * len(ids)
    if not len(ids) or lengths.max() < MIN_LENGTH:
        return runs
    top = max(int(x.max()) for x in ids if len(x)) + 1
    at = np.cumsum(lengths + 1) - lengths  # place of every sequence's first word
    text = np.empty(int(lengths.sum()) + len(ids) + 1, np.int64)
    text[at - 1] = top + np.arange(len(ids))
    text[-1] = top + len(ids)
    for x, lo in zip(ids, at, strict=True):
        text[lo : lo + len(x)] = x
    text = np.unique(text, return_inverse=True)[1]
    places = _grid(text, lengths, at)
    if not len(places):
        return runs
    grammar = Grammar(text)
    seq, i, q = places.T
    ahead = grammar.extend(i, i + q, 1)
    back = grammar.extend(i - 1, i + q - 1, -1)
    size = ahead + back + q
    keep = size >= np.maximum(MIN_LENGTH, MIN_PERIODS * q)
    rows = np.stack([seq, i - back - at[seq], size, q], axis=1)[keep]
    # of one interval the smallest period; equal starts with another end are other runs
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
    rows = rows[fresh]
    rows = rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]
    bounds = np.searchsorted(rows[:, 0], np.arange(len(ids) + 1))
    return [rows[lo:hi, 1:] for lo, hi in zip(bounds[:-1], bounds[1:], strict=True)]


def _grid(text: np.ndarray, lengths: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(sequence, place, period) of grid places equal to the next three of their period's grid."""
    periods = lengths // MIN_PERIODS
    found = []
    ends = np.cumsum(periods)
    total = int(ends[-1])
    lo = 0
    while lo < total:
        # a slice of (sequence, period) pairs with at most about GRID_STEP places
        hi = min(total, lo + GRID_STEP // 8)
        pair = np.arange(lo, hi)
        seq = np.searchsorted(ends, pair, side="right")
        q = pair - (ends[seq] - periods[seq]) + 1
        count = (lengths[seq] - 1) // q - (MIN_PERIODS - 2)
        sums = np.cumsum(count)
        cut = max(1, int(np.searchsorted(sums, GRID_STEP, side="right")))
        seq, q, count = seq[:cut], q[:cut], count[:cut]
        lo += cut
        each = np.repeat(np.arange(cut), count)
        k = np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count)
        q = q[each]
        i = at[seq][each] + k * q
        hit = np.flatnonzero(text[i] == text[i + q])
        for step in range(1, MIN_PERIODS - 1):
            a = i[hit] + step * q[hit]
            hit = hit[text[a] == text[a + q[hit]]]
        if len(hit):
            found.append(np.stack([seq[each[hit]], i[hit], q[hit]], axis=1))
    return np.concatenate(found) if found else np.empty((0, 3), np.int64)


def planted_words(doc_id, ids: np.ndarray) -> np.ndarray | None:
    """Places whose words replace a text's words, or None where it stays as it is.

    With h the crc32 of the id's text, h divisible by ten and g = h // 10, the
    words from a = g % n on repeat with period 1 + (n - a) // (3 + g % 8).
    """
    h, n = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()), len(ids)
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % p
    return places


def collapse(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words joined by one space, without those that lie behind the first period of any run."""
    if not len(runs):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    return b" ".join([words[i] for i in kept.tolist()])


def highest(runs: np.ndarray) -> tuple[int, int, int] | None:
    """The run of greatest length / period, compared exactly; ties by start, then period."""
    best = None
    for start, length, period in runs.tolist():
        if best is None or length * best[2] > best[1] * period:
            best = (start, length, period)
    return best


def periodic_runs(
    df: DataFrame, key: str = "doc_id", text: str = "text", plant: bool = False, whole: bool = True
) -> DataFrame:
    """One row per text: its runs, the highest of them, the collapsed text and the digests of both.

    ``plant`` first lets some texts repeat (``planted_words``), so that long
    runs with known places are there.  ``whole=False`` leaves the list of runs
    and the collapsed text out and keeps their digests.
    """

    def process(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            keys, ids, words, names, held = [], [], [], _namer(), 0
            for doc_id, content in zip(batch[key], batch[text], strict=True):
                own = (content or "").encode().split()
                if held and held + len(own) > BATCH_WORDS:
                    yield _result(key, keys, ids, words, whole)
                    keys, ids, words, names, held = [], [], [], _namer(), 0
                numbers = np.array(list(map(names.__getitem__, own)), np.int64)
                if plant and (places := planted_words(doc_id, numbers)) is not None:
                    numbers = numbers[places]
                    own = [own[i] for i in places.tolist()]
                keys.append(doc_id)
                ids.append(numbers)
                words.append(own)
                held += len(own)
            if keys:
                yield _result(key, keys, ids, words, whole)

    kind = df.schema[key].dataType.simpleString()
    schema = (
        f"`{key}` {kind}, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
        "runs_sha256 string, collapsed_sha256 string"
    )
    if whole:
        schema += ", runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return map_rows(df, [key, text], process, schema)


def _namer() -> defaultdict:
    """Consecutive numbers for what it is asked for."""
    names: defaultdict = defaultdict()
    names.default_factory = names.__len__
    return names


def _result(key: str, keys: list, ids: list[np.ndarray], words: list[list[bytes]], whole: bool) -> dict[str, list]:
    runs = find_runs(ids)
    best = [highest(r) for r in runs]
    texts = [collapse(w, r) for w, r in zip(words, runs, strict=True)]
    listed = ["".join(f"{s},{n},{q}\n" for s, n, q in r.tolist()) for r in runs]
    out = {
        key: keys,
        "n_words": [len(x) for x in ids],
        "n_runs": [len(r) for r in runs],
        "start": [b and b[0] for b in best],
        "length": [b and b[1] for b in best],
        "period": [b and b[2] for b in best],
        "exponent_milli": [b and 1000 * b[1] // b[2] for b in best],
        "runs_sha256": [hashlib.sha256(x.encode()).hexdigest() for x in listed],
        "collapsed_sha256": [hashlib.sha256(x).hexdigest() for x in texts],
    }
    if whole:
        out["runs"] = [[{"start": s, "length": n, "period": q} for s, n, q in r.tolist()] for r in runs]
        out["collapsed"] = [x.decode() for x in texts]
    return out
