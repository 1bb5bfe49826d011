"""Exact repeated-substring removal by depth-limited radix passes.

A *suffix* is ordered only through ``depth`` bytes, so it is a window of that
many bytes.  Most-significant-digit passes split all windows into groups of
equal leading digits; a group of one can hold no repeated window and drops
out, and the groups left at full depth are exactly the repeated windows.

The first digit is a content-defined one: the gram of ``GRAM`` bytes inside the
window with the smallest hash.  Equal windows hold the same gram at the same
offset, and neighbouring windows share it, so the windows of one gram
occurrence are one *run* (about a hundred windows) and one row instead of a
hundred.  Later digits widen what windows must share around that gram:

1. the gram (runs whose gram occurs once drop out);
2. the bytes of the whole run (equal runs: every window of them is repeated);
3. - 5. for what is left, blocks of 36, 6 and 1 neighbouring offsets: the
   *core* common to the block's windows is the next digit, the *slice* they
   cover decides the block at once when it is repeated.  Blocks with a single
   core drop out, equal slices are done, the rest go on to the next pass.  At
   width 1 core, slice and window are the same bytes.

Digits are named by 64-bit hashes together with the digits before them.  All
grouping is by partial counts (a passage in a third of all rows costs one row
per task), and what comes back to a row is joined by name.  Whole texts are
read, texts longer than ``CHUNK`` in overlapping chunks.

Passages shorter than ``depth`` are not removed, but the first digit finds
them: two documents that share ``PASSAGE`` bytes hold the same gram of
``PASSAGE_GRAM`` bytes out of those bytes.  ``shared_passages`` counts the
grams of a document that another row holds as well.

Edge cases: null text is empty; texts shorter than ``depth`` have no window;
repeated rows repeat each other; null ids stay; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citybeat.llm.common import discard, list_column, map_rows, materialise

DEPTH = 400
GRAM = 128
#: Bytes that two rows share at least for a gram of theirs to be found, and bytes of such a gram; 98 % of 51 words
#: side by side in check_s have the first or more.
PASSAGE = 224
PASSAGE_GRAM = 160
#: Windows handled at once in a task.
CHUNK = 1 << 19
#: Offsets per block of the later passes.
WIDTHS = (36, 6, 1)
_PLACE = np.uint64((1 << 20) - 1)


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte values, powers of an odd base and of its inverse modulo 2^64."""
    base, size = 0x9E3779B97F4A7C15, CHUNK + DEPTH * 4
    values = np.random.default_rng(400).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def powers(b: int) -> np.ndarray:
        steps = np.full(size, b, dtype=np.uint64)
        steps[0] = 1
        return np.cumprod(steps, dtype=np.uint64)

    return values, powers(base), powers(pow(base, -1, 2**64))


def _gram_names(data: np.ndarray, gram: int) -> np.ndarray:
    """Rolling hash of every ``gram`` bytes."""
    values, up, down = _powers()
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(values[data] * up[: len(data)], out=total[1:])
    h = (total[gram:] - total[:-gram]) * down[: len(data) - gram + 1]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def runs(data: np.ndarray, depth: int = DEPTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Runs of windows with the same smallest gram: (name, first window, windows, gram's place)."""
    n, width = len(data) - depth + 1, depth - gram + 1
    h = _gram_names(data, gram)
    ranked = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)  # of equal hashes the leftmost
    blocks = np.full(-(-len(h) // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    blocks[: len(h)] = ranked
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])
    place = (least & _PLACE).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(np.diff(place)) + 1])
    size = np.diff(np.concatenate([first, [n]]))
    at = place[first]
    return h[at].view(np.int64), first, size, at


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _run_table(rows: DataFrame, depth: int, gram: int) -> DataFrame:
    """Per document the arrays of its runs: gram name g, run name s, place p.

    A place packs the first window (32 bits), the number of windows and the
    gram's offset from the first window (16 bits each, both under ``depth``).
    """
    names = ("g", "s", "p")

    def process(batches):
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("doc_id", "th", *names)}
            for k, th, text in zip(batch["doc_id"], batch["th"], batch["text"]):
                raw = text.encode("utf-8", "replace")
                got: dict[str, list[int]] = {c: [] for c in names}
                for lo in range(0, len(raw) - depth + 1, CHUNK):
                    part = raw[lo : lo + CHUNK + depth - 1]
                    g, first, size, at = runs(np.frombuffer(part, dtype=np.uint8), depth, gram)
                    spans = zip(first.tolist(), (first + size + depth - 1).tolist())
                    got["g"] += g.tolist()
                    got["s"] += [_signed(xxhash.xxh3_64_intdigest(part[a:b])) for a, b in spans]
                    got["p"] += (((first + lo) << 32) | (size << 16) | (at - first)).tolist()
                out["doc_id"].append(k)
                out["th"].append(th)
                for c in names:
                    out[c].append(np.array(got[c], dtype=np.int64))
            yield out | {c: list_column(out[c], pa.int64()) for c in names}

    schema = "doc_id long, th long, g array<long>, s array<long>, p array<long>"
    return map_rows(rows, ["doc_id", "th", "text"], process, schema).withColumn("rid", F.monotonically_increasing_id())


def _texts(df: DataFrame, key: str, text: str) -> DataFrame:
    rows = df.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.withColumn("th", F.xxhash64("text"))


def shared_passages(rows: DataFrame, depth: int = PASSAGE, gram: int = PASSAGE_GRAM) -> DataFrame:
    """Documents (doc_id, th) with ``n_shared``, the number of their grams that another row holds too.

    It is 1 or more where ``depth`` bytes are shared with another row, and only where ``gram`` bytes are.
    """

    def process(batches):
        for batch in batches:
            found = []
            for text in batch["text"]:
                raw = text.encode("utf-8", "replace")
                parts = [raw[lo : lo + CHUNK + depth - 1] for lo in range(0, len(raw) - depth + 1, CHUNK)]
                names = [runs(np.frombuffer(part, dtype=np.uint8), depth, gram)[0] for part in parts]
                found.append(np.unique(np.concatenate(names)) if names else np.empty(0, np.int64))
            yield {"doc_id": batch["doc_id"], "th": batch["th"], "g": list_column(found, pa.int64())}

    table = map_rows(rows, ["doc_id", "th", "text"], process, "doc_id long, th long, g array<long>")
    table = materialise(table.withColumn("rid", F.monotonically_increasing_id()), "radix-passages")
    each = table.select("rid", F.explode("g").alias("g"))
    shared = each.groupBy("g").agg(F.min("rid").alias("first"), F.max("rid").alias("last")).filter("first < last")
    shared = materialise(shared.select("g"), "radix-shared")
    held = each.join(shared, "g", "left_semi").groupBy("rid").agg(F.count(F.lit(1)).alias("n_shared"))
    # a repeated row (same id, same text) has the same grams
    named = held.join(table.select("rid", "doc_id", "th"), "rid").groupBy("doc_id", "th").agg(F.max("n_shared").alias("n_shared"))
    found = materialise(named, "radix-held")
    discard(table, shared)
    return found


def _blocks(spans: DataFrame, width: int, depth: int) -> DataFrame:
    """Blocks of ``width`` neighbouring offsets of every span's open windows.

    ``lo``/``hi`` are the span's open windows (inclusive); a window ``i`` has
    the gram at offset ``o - i``.  Returns the block's windows and the names of
    its core and its slice; both names start from the gram and the block.
    """
    columns = ["sid", "single", "g", "o", "raw", "opened"]

    def process(batches):
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("sid", "single", "lo", "hi", "core", "slice")}
            for sid, single, g, o, raw, opened in zip(*(batch[c] for c in columns)):
                for lo, hi in ((x["lo"], x["hi"]) for x in opened):
                    for j in range((o - hi) // width, (o - lo) // width + 1):
                        first, last = max(lo, o - width * j - width + 1), min(hi, o - width * j)
                        seed = (g ^ (j * 0x9E3779B97F4A7C15)) & 0xFFFFFFFFFFFFFFFF
                        begin = o - width * j
                        core = raw[begin : begin + depth - width + 1]
                        out["sid"].append(sid)
                        out["single"].append(single)
                        out["lo"].append(first)
                        out["hi"].append(last)
                        out["core"].append(_signed(xxhash.xxh3_64_intdigest(core, seed)))
                        out["slice"].append(
                            _signed(xxhash.xxh3_64_intdigest(raw[first : last + depth], seed ^ (begin - first + 1) ^ (last - first) << 20))
                        )
            yield out

    schema = "sid long, single boolean, lo int, hi int, core long, slice long"
    return map_rows(spans, columns, process, schema)


def _open(lo: Column, hi: Column) -> Column:
    return F.struct(lo.cast("int").alias("lo"), hi.cast("int").alias("hi"))


def _fetch(rows: DataFrame, wanted: DataFrame, depth: int) -> DataFrame:
    """Bytes of the wanted runs: one row per run with its open windows."""
    by_doc = wanted.groupBy("doc_id", "th").agg(F.collect_list(F.struct("g", "s", "p", "single")).alias("runs"))
    joined = rows.join(
        by_doc.withColumnRenamed("doc_id", "_d").withColumnRenamed("th", "_t"),
        F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_t")),
    )

    def process(batches):
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("g", "s", "single", "o", "raw", "opened")}
            for text, found in zip(batch["text"], batch["runs"]):
                raw = text.encode("utf-8", "replace")
                for r in found:
                    first, size, offset = r["p"] >> 32, (r["p"] >> 16) & 0xFFFF, r["p"] & 0xFFFF
                    out["g"].append(r["g"])
                    out["s"].append(r["s"])
                    out["single"].append(r["single"])
                    out["o"].append(offset)
                    out["raw"].append(raw[first : first + size + depth - 1])
                    out["opened"].append([{"lo": 0, "hi": size - 1}])
            yield out

    schema = "g long, s long, single boolean, o int, raw binary, opened array<struct<lo:int,hi:int>>"
    got = map_rows(joined, ["text", "runs"], process, schema)
    return got.withColumn("sid", F.monotonically_increasing_id())


def repeated_windows(df: DataFrame, key: str = "doc_id", text: str = "text", depth: int = DEPTH, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """(documents with their key columns, repeated windows).

    The second has one row per document with such windows: ``doc_id, th,
    windows`` (array of first and last window, inclusive, byte offsets).
    """
    rows = _texts(df, key, text)
    table = materialise(_run_table(rows, depth, gram), "radix-runs")
    each = table.select("rid", F.explode(F.arrays_zip("g", "s", "p")).alias("r")).select("rid", "r.*")

    # Pass 1: grams that occur in two runs or more.
    # Every table of names that rows are joined to is written first: both sides of such a join are then plain
    # shuffles, whose large partitions (one hot name) the engine can split.
    grams = each.groupBy("g").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("g")
    grams = materialise(grams, "radix-grams")
    live = materialise(each.join(grams, "g", "left_semi"), "radix-live")

    # Pass 2: equal runs; grams with several different runs go on, one run of each kind.
    kinds = materialise(
        live.groupBy("g", "s").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("rid", "p")).alias("r")), "radix-kinds"
    )
    mixed = kinds.groupBy("g").agg(F.count(F.lit(1)).alias("k"), F.min("c").alias("least")).filter("k > 1 AND least = 1")
    mixed = materialise(mixed.select("g"), "radix-mixed")
    wanted = kinds.join(mixed, "g", "left_semi").select(
        "g", "s", (F.col("c") == 1).alias("single"), "r.rid", "r.p"
    )
    placed = wanted.join(table.select("rid", "doc_id", "th"), "rid")
    spans = materialise(_fetch(rows, placed, depth), "radix-spans")

    # Passes 3 to 5.
    found: DataFrame | None = None
    opened = spans
    for width in WIDTHS:
        blocks = materialise(_blocks(opened, width, depth), f"radix-blocks{width}")
        slices = blocks.groupBy("slice").agg(F.count(F.lit(1)).alias("nz"), F.min("sid").alias("first"))
        slices = materialise(slices.filter("nz > 1"), f"radix-slices{width}")
        judged = materialise(blocks.join(slices, "slice", "left"), f"radix-judged{width}")
        done = judged.filter("single AND nz > 1").select("sid", "lo", "hi")
        found = done if found is None else found.unionByName(done)
        if width == 1:
            break
        # Of equal slices one goes on, and only to meet a block that is still open.
        going = judged.filter("nz IS NULL OR sid = first")
        cores = (
            going.groupBy("core")
            .agg(F.count(F.lit(1)).alias("nc"), F.max(F.col("single") & F.col("nz").isNull()).alias("open"))
            .filter("nc > 1 AND open")
        )
        cores = materialise(cores.select("core"), f"radix-cores{width}")
        rest = (
            going.join(cores, "core", "left_semi")
            .groupBy("sid")
            .agg(F.collect_list(_open(F.col("lo"), F.col("hi"))).alias("opened"))
        )
        opened = materialise(spans.drop("opened").join(rest, "sid"), f"radix-open{width}")

    partial = (
        found.join(spans.select("sid", "g", "s"), "sid")
        .groupBy("g", "s")
        .agg(F.collect_list(_open(F.col("lo"), F.col("hi"))).alias("parts"))
    )
    size = F.shiftright(F.col("r.p"), 16).bitwiseAND(F.lit(0xFFFF))
    whole = kinds.filter("c > 1").select("g", "s", F.array(_open(F.lit(0), size - 1)).alias("parts"))
    verdict = materialise(whole.unionByName(partial), "radix-verdict")
    first = F.shiftright(F.col("p"), 32)
    windows = (
        live.join(verdict, ["g", "s"])
        .select("rid", F.transform("parts", lambda x: _open(x["lo"] + first, x["hi"] + first)).alias("parts"))
        .groupBy("rid")
        .agg(F.flatten(F.collect_list("parts")).alias("windows"))
    )
    # A repeated row (same id, same text) has the same windows: one of them is joined to all.
    named = windows.join(table.select("rid", "doc_id", "th"), "rid").groupBy("doc_id", "th")
    return rows, materialise(named.agg(F.first("windows").alias("windows")), "radix-windows")


def cut_out(raw: bytes, windows: list[dict], depth: int) -> tuple[bytes, list[tuple[int, int]]]:
    """Bytes that stay and the maximal removed runs [start, end)."""
    merged: list[list[int]] = []
    for lo, hi in sorted((w["lo"], w["hi"] + depth) for w in windows):
        if merged and lo <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], hi)
        else:
            merged.append([lo, hi])
    kept, at = [], 0
    for lo, hi in merged:
        kept.append(raw[at:lo])
        at = hi
    kept.append(raw[at:])
    return b"".join(kept), [(a, b) for a, b in merged]


def remove_repeated(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    depth: int = DEPTH,
    gram: int = GRAM,
    digest: bool = False,
    passages: bool = False,
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans and the bytes that stay.

    ``kept`` is binary (a cut may split a character); with ``digest`` its
    SHA-256 in ``kept_sha256`` takes its place.  With ``passages`` ``n_shared``
    follows, see ``shared_passages``.
    """
    shared = shared_passages(_texts(df, key, text)) if passages else None
    rows, windows = repeated_windows(df, key, text, depth, gram)
    if shared is not None:
        windows = windows.withColumn("n_shared", F.lit(0).cast("long")).unionByName(
            shared.select("doc_id", "th", F.lit(None).cast(windows.schema["windows"].dataType).alias("windows"), "n_shared")
        )
        windows = windows.groupBy("doc_id", "th").agg(
            F.first("windows", ignorenulls=True).alias("windows"), F.max("n_shared").alias("n_shared")
        )
    joined = rows.join(
        windows.withColumnRenamed("doc_id", "_d").withColumnRenamed("th", "_t"),
        F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_t")),
        "left",
    )
    last = "kept_sha256 string" if digest else "kept binary"
    more = ["n_shared"] if passages else []

    def process(batches):
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", last.split(" ")[0])}
            for k, t, w in zip(batch["doc_id"], batch["text"], batch["windows"]):
                raw = t.encode("utf-8", "replace")
                kept, cuts = cut_out(raw, w or [], depth)
                stay = hashlib.sha256(kept).hexdigest() if digest else kept
                for name, value in zip(out, (k, len(raw), len(raw) - len(kept), len(cuts), stay)):
                    out[name].append(value)
            yield out | {c: [n or 0 for n in batch[c]] for c in more}

    schema = f"doc_id long, n_bytes long, n_removed long, n_spans long, {last}" + "".join(f", {c} long" for c in more)
    return map_rows(joined, ["doc_id", "text", "windows", *more], process, schema)
