"""Quality rules by line sequence labelling.

A linear-chain conditional random field with two states, content and
boilerplate, reads the lines of a document (lines with at least one word);
Viterbi decoding marks each line and the share of words on content lines
decides whether the document stays.  Line features are byte-class shares, so
they cost the same in every language.

The field is trained here: labelled documents give runs of lines whose state
is the document's quality label, and runs of different documents are strung
together so that the field also learns when a state changes.  Training uses at
most ``max_runs`` runs (default 4,000) of at most ``RUN_LINES`` lines, taken in
the order of a hash over (doc_id, run): a documented bound that holds at every
size.  Labelling itself covers every line of every text.

Edge cases: null text has no words and fails the base rules; texts without
labels are labelled all the same; without any labelled document of one state
the field has no weights and every line counts as content; repeated rows are
judged each; extra columns are kept by ``keep_content``.
"""

from __future__ import annotations

from itertools import chain, compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citybeat.llm.common import map_rows, numbered

#: Fixed value: the symbols of the base rules.
SYMBOLS = "#*$%&|<>"
#: Lines of one training run, and runs strung to one training sequence.
RUN_LINES = 16
RUNS_JOINED = 4
MIN_CONTENT_SHARE = 0.5

_CLASSES = {
    "upper": bytes(range(65, 91)),
    "lower": bytes(range(97, 123)),
    "digit": bytes(range(48, 58)),
    "symbol": SYMBOLS.encode() + b"~^_=+\\{}@",
    "shout": b"!?",
    "stop": b".,;:",
    "space": b"\x20\x09\x0a\x0b\x0c\x0d",
    "wide": bytes(range(128, 256)),
}
_CLASS_OF = np.full(256, len(_CLASSES), dtype=np.uint8)
for _i, _chars in enumerate(_CLASSES.values()):
    _CLASS_OF[list(_chars)] = _i
N_FEATURES = len(_CLASSES) + 5


class Lines:
    """The lines of a text that hold a word, its words, and word numbers by first use."""

    def __init__(self, lines: list[bytes]):
        split = [x.split() for x in lines]
        self.lines = list(compress(lines, map(bool, split)))
        self.sizes = np.fromiter((len(x) for x in split if x), np.int64, len(self.lines))
        self.words = list(chain.from_iterable(split))
        seen: dict[bytes, int] = {}
        self.ids = np.fromiter(map(seen.setdefault, self.words, count()), np.int64, len(self.words))

    @classmethod
    def of(cls, text: str) -> Lines:
        return cls(text.encode("utf-8", "replace").split(b"\n"))


def line_features(of: Lines) -> np.ndarray:
    """Feature rows: bias, log words, log word length, repeats an earlier line, share of
    words equal to the one before, byte-class shares."""
    lines = of.lines
    out = np.zeros((len(lines), N_FEATURES))
    if not lines:
        return out
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    classes = _CLASS_OF[np.frombuffer(b"\n".join(lines) + b"\n", dtype=np.uint8)]
    seen: dict[bytes, int] = {}
    first = np.fromiter(map(seen.setdefault, lines, count()), np.int64, len(lines))
    word_starts = np.cumsum(of.sizes) - of.sizes
    again = np.zeros(len(of.ids), dtype=np.int64)
    again[1:] = of.ids[1:] == of.ids[:-1]
    again[word_starts] = 0
    out[:, 0] = 1
    out[:, 1] = np.log(of.sizes)
    out[:, 2] = np.log(sizes / of.sizes)
    out[:, 3] = first != np.arange(len(lines))
    out[:, 4] = np.add.reduceat(again, word_starts) / of.sizes
    kinds = len(_CLASSES) + 1
    line_of = np.repeat(np.arange(len(lines)) * kinds, sizes + 1)
    counts = np.bincount(line_of + classes, minlength=len(lines) * kinds)
    out[:, 5:] = counts.reshape(len(lines), -1)[:, : len(_CLASSES)] / sizes[:, None]
    return out


class LineField:
    """Weights of the field; ``emit`` scores content against boilerplate."""

    def __init__(self, emit: np.ndarray | None = None, move: np.ndarray | None = None):
        self.emit = emit
        self.move = np.zeros((2, 2)) if move is None else move

    def label(self, of: Lines) -> np.ndarray:
        """Viterbi path: 1 content, 0 boilerplate; ties go to content."""
        if self.emit is None or not of.lines:
            return np.ones(len(of.lines), dtype=np.int64)
        score = (line_features(of) @ self.emit).tolist()
        (m00, m01), (m10, m11) = self.move.tolist()
        back0, back1 = [], []
        a, b = 0.0, score[0]
        for s in score[1:]:
            from1 = b + m10 >= a + m00
            to1 = b + m11 >= a + m01
            back0.append(from1)
            back1.append(to1)
            a, b = (b + m10 if from1 else a + m00), (b + m11 if to1 else a + m01) + s
        state = b >= a
        path = [state]
        for f0, f1 in zip(reversed(back0), reversed(back1)):
            state = f1 if state else f0
            path.append(state)
        return np.array(path[::-1], dtype=np.int64)


def fit(runs: list[tuple[int, np.ndarray]], steps: int = 100, rate: float = 0.2, penalty: float = 1e-4) -> LineField:
    """Maximum likelihood by gradient ascent (Adam) over strung runs of (state, features)."""
    if not runs or len({s for s, _ in runs}) < 2:
        return LineField()
    # Alternate the states as far as they go, so that strung runs hold changes.
    by = [[f for s, f in runs if s == k] for k in (0, 1)]
    n = max(map(len, by))
    mixed = [(k, by[k][i % len(by[k])]) for i in range(n) for k in ((0, 1) if i % 2 else (1, 0))]
    strung = [mixed[i : i + RUNS_JOINED] for i in range(0, len(mixed), RUNS_JOINED)]
    length = max(sum(len(f) for _, f in seq) for seq in strung)
    x = np.zeros((len(strung), length, N_FEATURES))
    y = np.zeros((len(strung), length), dtype=np.int64)
    mask = np.zeros((len(strung), length))
    for i, seq in enumerate(strung):
        at = 0
        for s, f in seq:
            x[i, at : at + len(f)], y[i, at : at + len(f)], mask[i, at : at + len(f)] = f, s, 1
            at += len(f)
    total = mask.sum()
    # Standardised features; the scale is folded into the weights at the end.
    rows = x[mask > 0][:, 1:]
    mean, spread = rows.mean(axis=0), rows.std(axis=0) + 1e-6
    x[:, :, 1:] = (x[:, :, 1:] - mean) / spread * mask[:, :, None]
    w, m = np.zeros(N_FEATURES), np.zeros((2, 2))
    g1, g2 = np.zeros(N_FEATURES + 4), np.zeros(N_FEATURES + 4)
    pair = np.zeros((2, 2))
    np.add.at(pair, (y[:, :-1].ravel(), y[:, 1:].ravel()), mask[:, 1:].ravel())
    for step in range(1, steps + 1):
        e = np.stack([np.zeros_like(mask), x @ w], axis=2)
        node, moves = _marginals(e, m, mask)
        grad = np.concatenate([
            np.einsum("nt,ntf->f", (y - node) * mask, x) / total - penalty * w,
            ((pair - moves) / total - penalty * m).ravel(),
        ])
        g1, g2 = 0.9 * g1 + 0.1 * grad, 0.99 * g2 + 0.01 * grad**2
        move = rate * (g1 / (1 - 0.9**step)) / (np.sqrt(g2 / (1 - 0.99**step)) + 1e-8)
        w, m = w + move[:N_FEATURES], m + move[N_FEATURES:].reshape(2, 2)
    scaled = np.concatenate([[w[0] - (w[1:] * mean / spread).sum()], w[1:] / spread])
    return LineField(scaled, m)


def _marginals(e: np.ndarray, m: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(state 1) of every line and expected moves, by forward-backward."""
    n, length, _ = e.shape
    alpha, beta = np.empty_like(e), np.zeros_like(e)
    alpha[:, 0] = e[:, 0]
    for t in range(1, length):
        step = np.logaddexp(alpha[:, t - 1, :1] + m[0], alpha[:, t - 1, 1:] + m[1]) + e[:, t]
        alpha[:, t] = np.where(mask[:, t, None] > 0, step, alpha[:, t - 1])
    for t in range(length - 2, -1, -1):
        ahead = e[:, t + 1] + beta[:, t + 1]
        step = np.logaddexp(m[:, 0] + ahead[:, :1], m[:, 1] + ahead[:, 1:])
        beta[:, t] = np.where(mask[:, t + 1, None] > 0, step, beta[:, t + 1])
    z = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])
    node = np.exp(np.minimum(alpha[:, :, 1] + beta[:, :, 1] - z[:, None], 0)) * mask
    ahead = (e + beta)[:, 1:]
    both = np.exp(np.minimum(alpha[:, :-1, :, None] + m + ahead[:, :, None, :] - z[:, None, None, None], 0))
    return node, np.einsum("ntij,nt->ij", both, mask[:, 1:])


def train(
    docs: DataFrame,
    labels: DataFrame,
    max_docs: int = 4000,
    max_runs: int = 8000,
    key: str = "doc_id",
    text: str = "text",
) -> LineField:
    """Fit the field on labelled documents: at most ``max_docs``, half of each state, and ``max_runs`` runs of them."""
    states = (
        labels.filter("quality IN (0, 1)")
        .groupBy(F.col(key).cast("long").alias("_k"))
        .agg(F.max("quality").alias("quality"))
        .withColumn("h", F.xxhash64("_k"))
    )
    picked = [states.filter(F.col("quality") == s).orderBy("h", "_k").limit(max_docs // 2) for s in (0, 1)]
    # max_docs rows of two numbers: small by construction
    few = F.broadcast(picked[0].unionByName(picked[1]).drop("h"))
    lines = F.filter(F.split(F.col(text), "\n"), lambda x: F.trim(x) != "")
    starts = F.sequence(F.lit(0), F.greatest(F.size("lines") - 1, F.lit(0)), F.lit(RUN_LINES))
    runs = (
        docs.select(F.col(key).cast("long").alias("_d"), F.col(text).alias(text))
        .join(few, F.col("_d") == F.col("_k"))
        .select("_k", "quality", lines.alias("lines"))
        .select("_k", "quality", "lines", F.explode(starts).alias("at"))
        .select("quality", F.slice("lines", F.col("at") + 1, F.lit(RUN_LINES)).alias("lines"), F.xxhash64("_k", "at").alias("h"), "_k", "at")
        .orderBy("h", "_k", "at")
        .limit(max_runs)
    )
    got = [(r.quality, [x.encode("utf-8", "replace") for x in r.lines]) for r in runs.select("quality", "lines").collect()]
    return fit([(state, f) for state, lines in got if len(f := line_features(Lines(lines)))])


def repeated_window_words(ids: np.ndarray, size: int = 5) -> int:
    """Words that lie in ``size``-word windows found twice or more, first ones included."""
    n = len(ids) - size + 1
    if n < 2:
        return 0
    mixed = np.zeros(n, dtype=np.uint64)
    for i in range(size):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + ids[i : i + n].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    ordered = np.sort(mixed)
    if not (ordered[1:] == ordered[:-1]).any():
        return 0  # unequal hashes: no window repeats
    name = ids
    for i in range(1, size):  # exact names of growing windows
        pairs = name[: len(ids) - i] * len(ids) + ids[i:]
        _, name = np.unique(pairs, return_inverse=True)
    repeated = np.bincount(name)[name] > 1
    covered = np.zeros(len(ids) + 1, dtype=np.int64)
    at = np.flatnonzero(repeated)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + size, -1)
    return int((np.cumsum(covered[:-1]) > 0).sum())


def judge(text: str, field: LineField, min_share: float = MIN_CONTENT_SHARE) -> tuple:
    """Base counts, verdicts and line figures of one text."""
    of = Lines.of(text)
    n_words, n_repeat = len(of.words), repeated_window_words(of.ids)
    failed = n_words < 10 or 100 * n_repeat > 20 * n_words
    path = field.label(of)
    share = float((of.sizes * path).sum() / n_words) if n_words else 0.0
    return (
        n_words,
        len(text) - sum(text.count(c) for c in " \t\n\x0b\x0c\r"),
        sum(text.count(c) for c in SYMBOLS),
        len(of.lines) - len(set(of.lines)),
        n_repeat,
        failed,
        not failed and share >= min_share,
        share,
        len(of.lines),
        int(len(of.lines) - path.sum()),
    )


SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, content_share double, n_lines long, n_boilerplate_lines long"
)


def judge_documents(docs: DataFrame, field: LineField, key: str = "doc_id", text: str = "text", min_share: float = MIN_CONTENT_SHARE) -> DataFrame:
    """One verdict row per document."""
    names = [part.strip().split(" ")[0] for part in SCHEMA.split(",")]

    def process(batches):
        for batch in batches:
            rows = [(k, *judge(t or "", field, min_share)) for k, t in zip(batch[key], batch[text])]
            yield dict(zip(names, map(list, zip(*rows)))) if rows else {n: [] for n in names}

    return map_rows(docs, [key, text], process, SCHEMA)


def mark_lines(docs: DataFrame, field: LineField, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per line that holds a word: doc_id, number among them, line, content."""
    schema = "doc_id long, line_no long, line string, content boolean"

    def process(batches):
        for batch in batches:
            out: dict[str, list] = {"doc_id": [], "line_no": [], "line": [], "content": []}
            for k, t in zip(batch[key], batch[text]):
                of = Lines.of(t or "")
                for i, (line, state) in enumerate(zip(of.lines, field.label(of))):
                    for name, value in zip(out, (k, i, line.decode("utf-8", "replace"), bool(state))):
                        out[name].append(value)
            yield out

    return map_rows(docs, [key, text], process, schema)


def keep_content(docs: DataFrame, field: LineField, text: str = "text", min_share: float = MIN_CONTENT_SHARE) -> DataFrame:
    """The documents that pass, every column as it was."""

    rows, _ = numbered(docs)
    place = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            texts = batch.column(place)
            yield batch.filter(pa.array([judge(t.as_py() or "", field, min_share)[6] for t in texts], pa.bool_()))

    return rows.mapInArrow(run, rows.schema).toDF(*docs.columns)
