"""Spelling variants: words one edit apart, grouped under their common form.

Words are counted over all texts.  Two words one edit apart agree on all that
lies before and behind the edit, so the vocabulary is dealt into blocks of
words that share such a context: (size of the shorter word, segment that the
edit may lie in, the letters before and behind the segment).  The first
segments are the two halves of a word.  A block of more than ``BLOCK`` words is
dealt again by the halves of its segment, down to segments of one letter, so no
block grows with the vocabulary and no word is left out.  A pair belongs to the
one segment that holds its first unequal letter.

Inside a block the words' middles form a sorted list, and every word scans it
with one edit matrix: rows are three cells wide (one edit either way), the rows
of the prefix that a middle shares with the one before stay, and when a row has
no cell under two edits all middles with that prefix are skipped.

A word's form is its near word of largest count, if that is ``ratio`` times its
own; following forms raises the count each time, so it ends, and roots are
found by pointer jumping.

Edge cases: null and empty texts have no words; a null id counts as the empty
string in ``misspelt``; repeated rows count again; equal counts are told apart
by code-point order; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citybeat.llm.common import map_rows, materialise

#: Words of a block that is scanned as it is.
BLOCK = 256
#: Distinct words that a counting task holds before it hands their counts on.
HELD = 1 << 18
#: Rows handed back by a task at once.
ROWS = 1 << 14

# Fixed value: the letters of a word; only A-Z are lower-cased.
RUN = re.compile("[a-zÀ-ÿ]+")

KEY = ["size", "lo", "hi", "context"]


def misspelt(run: str, id_crc: int, every: int) -> str:
    """The run without one code point where ``every`` divides the crc32 of ``<id>:<run>``."""
    h = zlib.crc32(run.encode(), id_crc)
    return run if h % every else run[: (at := h % len(run))] + run[at + 1 :]


def count_words(
    df: DataFrame, key: str, text: str, min_length: int = 6, min_count: int = 5, every: int | None = None
) -> DataFrame:
    """(word, n): words of at least ``min_length`` letters seen ``min_count`` times; ``every`` as in ``misspelt``."""

    def process(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        held: Counter = Counter()
        for batch in batches:
            for doc_id, content in zip(batch[key], batch[text], strict=True):
                if not content:
                    continue
                # bytes.lower() changes A-Z only
                runs = Counter(RUN.findall(content.encode().lower().decode()))
                id_crc = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for run, n in runs.items():
                    if len(run) >= min_length:
                        if every:
                            run = misspelt(run, id_crc, every)
                        if len(run) >= min_length:
                            held[run] += n
            if len(held) > HELD:
                yield {"word": list(held), "n": list(held.values())}
                held.clear()
        yield {"word": list(held), "n": list(held.values())}

    counted = map_rows(df, [key, text], process, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows (word, n, size, lo, hi) once for either half of their segment, with the context of the half."""
    middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    halves = F.array(F.struct(F.col("lo").alias("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), F.col("hi").alias("hi")))
    rows = rows.select("word", "n", "size", F.inline(halves))
    before = F.substr("word", F.lit(1), F.col("lo"))
    behind = F.right(F.col("word"), F.col("size") - F.col("hi"))
    return rows.withColumn("context", F.concat(before, F.lit("|"), behind))


def blocks(vocabulary: DataFrame, min_length: int = 6) -> DataFrame:
    """(word, n, size, lo, hi, context): every word in the blocks in which its near words lie.

    A word of L letters is in blocks of size L (edits that keep or add a
    letter) and of size L - 1 (as the longer of two words).
    """
    length = F.length("word")
    sizes = F.when(length > min_length, F.array(length - 1, length)).otherwise(F.array(length))
    rows = vocabulary.select("word", "n", F.explode(sizes).alias("size")).withColumns({"lo": F.lit(0), "hi": F.col("size")})
    done = None
    while True:
        rows = materialise(_dealt(rows), "spelling-blocks")
        crowded = rows.filter("hi - lo > 1").groupBy(*KEY).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > BLOCK)
        crowded = materialise(crowded.drop("rows"), "spelling-crowded")
        kept = rows.join(crowded, KEY, "left_anti").select("word", "n", *KEY)
        done = kept if done is None else done.unionByName(kept)
        if crowded.isEmpty():
            return done
        rows = rows.join(crowded, KEY, "left_semi")


def scan(query: str, middles: list[str]) -> list[int]:
    """Places in the sorted list ``middles`` exactly one edit from ``query`` (two cells of a row count as too many)."""
    m, n = len(query), len(middles)
    rows = [(2, 0, 1 if m else 2)]
    found = []
    i = kept = 0
    while i < n:
        word = middles[i]
        size = len(word)
        del rows[kept + 1 :]
        x, y, z = rows[kept]
        d = kept
        while d < size:
            c = word[d]
            d += 1
            # cells of row d for d - 1, d and d + 1 letters of the query
            x, y, z = (
                min(x + (query[d - 2] != c) if 2 <= d <= m + 1 else 2, y + 1) if d <= m + 1 else 2,
                min(y + (query[d - 1] != c), z + 1) if d <= m else 2,
                z + (query[d] != c) if d < m else 2,
            )
            if y > x + 1 and d <= m:
                y = x + 1
            if z > y + 1 and d < m:
                z = y + 1
            rows.append((x, y, z))
            if x > 1 and y > 1 and z > 1:
                break
        if x > 1 and y > 1 and z > 1:
            # no middle with these d letters is near
            j = bisect_left(middles, word[:d] + "\U0010ffff", i + 1)
            d -= 1
        else:
            if abs(m - size) <= 1 and (x, y, z)[m - size + 1] == 1:
                found.append(i)
            j = i + 1
        if j < n:
            following = middles[j]
            limit = min(d, len(following))
            kept = 0
            while kept < limit and following[kept] == word[kept]:
                kept += 1
        i = j
    return found


def _common(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def near_in_block(size: int, lo: int, hi: int, words: list[tuple[str, int]]) -> Iterator[tuple[str, int, int, str]]:
    """(word, number of near words, largest count among them, that word) for the words with any in this block."""
    listed = sorted((w[lo : len(w) - (size - hi)], w, n) for w, n in words)
    middles = [x[0] for x in listed]
    # equal middles of equal contexts are the same word of a size, so the list has no ties to lose
    for middle, word, _ in listed:
        near = []
        for i in scan(middle, middles):
            _, other, n = listed[i]
            if len(word) > size and len(other) > size:
                continue  # two longer words meet in the blocks of their own size
            if lo <= min(_common(word, other), size - 1) < hi:
                near.append((-n, other))
        if near:
            best = min(near)
            yield word, len(near), -best[0], best[1]


def near_words(vocabulary: DataFrame, min_length: int = 6) -> DataFrame:
    """(word, n_near, near_n, near) for the words with a near word: how many, the largest count, the word that has it."""

    def process(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        rows = (row for batch in batches for row in zip(*(batch[c] for c in [*KEY, "word", "n"]), strict=True))
        out: list[tuple] = []
        for key, group in groupby(rows, lambda r: r[:4]):
            words = [(r[4], r[5]) for r in group]
            if len(words) > 1:
                out += near_in_block(*key[:3], words)
            if len(out) >= ROWS:
                yield dict(zip(names, map(list, zip(*out, strict=True)), strict=True))
                out = []
        if out:
            yield dict(zip(names, map(list, zip(*out, strict=True)), strict=True))

    names = ["word", "n_near", "near_n", "near"]
    placed = blocks(vocabulary, min_length).repartition(*KEY).sortWithinPartitions(*KEY)
    found = map_rows(placed, [*KEY, "word", "n"], process, "word string, n_near long, near_n long, near string")
    best = F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("best.m")).alias("near_n"), "best.near"
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last of the forms that follow each word of ``forms`` (word, form)."""
    links = materialise(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        jump = links.select(F.col("word").alias("via"), F.col("root").alias("far"))
        stepped = materialise(
            links.join(jump, F.col("root") == F.col("via"), "left").select(
                "word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")
            ),
            "spelling-roots",
        )
        links = stepped.select("word", "root")
        if stepped.filter("moved").isEmpty():
            return links


def variants(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_length: int = 6,
    min_count: int = 5,
    ratio: int = 5,
    every: int | None = None,
) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    vocabulary = materialise(count_words(df, key, text, min_length, min_count, every), "spelling-words")
    near = near_words(vocabulary, min_length)
    has_form = F.col("near_n") >= ratio * F.col("n")
    words = materialise(
        vocabulary.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(has_form, F.col("near")).alias("form"),
            F.when(has_form, F.col("near_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    last = roots(words.filter("form IS NOT NULL"))
    return words.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
