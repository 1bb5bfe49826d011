"""Vector bin packing of token sequences (dot-product heuristic).

A sequence has three limits at once: tokens, segments (pieces) and
loss-bearing tokens.  Examples are cut to pieces that respect the limits;
pieces that fill a sequence alone are placed at once, the remainders are
packed by the dot-product heuristic: the open sequence takes, of all pieces
that fit, the one whose demand vector has the largest weighted dot product
with the sequence's remaining capacity, each dimension weighted by its average
demand.  When nothing fits and room is left, the piece with the largest dot
product is cut to fit (training sequences may be cut anywhere).  A sequence that
keeps more than ``MAX_PADDING`` of its tokens free all the same (the limit on
segments or loss closed it, or nothing was left) is split into power-of-two
sequences, which need no padding.

Every task packs its own rows from a pool of bounded size; no row is shuffled
and no sequence spans two tasks.  Sequence ids are the task's partition number
times 2^33 plus a running number, as monotonically increasing ids are.

Edge cases: null text is empty and still has its end id; null prompt lengths
are zero; repeated rows are packed each; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame

from citybeat.llm.common import map_rows
from citybeat.llm.word_bpe import word_encoder


@dataclass(frozen=True)
class Limits:
    """Capacity vector of a sequence; ``min_cut``: least room worth a cut."""

    tokens: int = 2048
    segments: int = 64
    loss: int = 2048
    min_cut: int = 8
    pool: int = 4096


#: Largest share of a sequence that is padded.
MAX_PADDING = 0.01

#: A piece: key, start in its example, length, loss-bearing tokens, tokens of the example, ids.
Piece = tuple


def cut(key, ids: bytes, prompt: int, limits: Limits) -> Iterator[Piece]:
    """Pieces of one example that respect the limits on tokens and loss."""
    n = len(ids) // 4
    at = 0
    while at < n:
        size = min(limits.tokens, n - at, max(prompt - at, 0) + limits.loss)
        yield _piece(key, ids, at, size, prompt, n)
        at += size


def _piece(key, ids: bytes, at: int, size: int, prompt: int, n: int) -> Piece:
    return key, at, size, max(0, at + size - max(at, prompt)), n, prompt, ids[4 * at : 4 * (at + size)]


def _split(piece: Piece, size: int) -> tuple[Piece, Piece]:
    key, at, length, _, n, prompt, ids = piece
    loss = lambda lo, hi: max(0, hi - max(lo, prompt))
    return (
        (key, at, size, loss(at, at + size), n, prompt, ids[: 4 * size]),
        (key, at + size, length - size, loss(at + size, at + length), n, prompt, ids[4 * size :]),
    )


class Pool:
    """Pieces waiting for a sequence, with their demand vectors."""

    def __init__(self, limits: Limits):
        self.limits = limits
        self.caps = np.array([limits.tokens, limits.segments, limits.loss], dtype=np.float64)
        self.items: list[Piece] = []

    def add(self, piece: Piece) -> None:
        self.items.append(piece)

    def sequences(self, keep: int) -> Iterator[list[Piece]]:
        """Fill sequences until at most ``keep`` pieces wait.

        Pieces of equal demand are one row of the scored table.
        """
        if len(self.items) <= keep:
            return
        rows: dict[tuple[int, int], int] = {}
        stacks: list[list[Piece]] = []
        # every cut, at most one a sequence, may add a demand
        demand = np.empty((2 * len(self.items) + 8, 3))
        waiting = np.zeros(len(demand), dtype=bool)

        def wait(piece: Piece) -> None:
            row = rows.setdefault((piece[2], piece[3]), len(stacks))
            if row == len(stacks):
                stacks.append([])
                demand[row] = piece[2], 1, piece[3]
            stacks[row].append(piece)
            waiting[row] = True

        def take(row: int) -> Piece:
            piece = stacks[row].pop()
            waiting[row] = bool(stacks[row])
            return piece

        left = len(self.items)
        mean = np.mean([(p[2], 1, p[3]) for p in self.items], axis=0)
        weight = mean / self.caps**3  # average demand share, for shares of demand and room
        for piece in reversed(self.items):
            wait(piece)
        while left > keep:
            room = self.caps.copy()
            sequence: list[Piece] = []
            while True:
                used = len(stacks)
                d, here = demand[:used], waiting[:used]
                worth = d @ (weight * room)
                score = np.where(here & (d <= room).all(axis=1), worth, -1.0)
                best = int(score.argmax())
                if score[best] >= 0:
                    sequence.append(take(best))
                    room -= d[best]
                    left -= 1
                else:
                    if left and room[0] >= self.limits.min_cut and room[1] >= 1:
                        best = int(np.where(here, worth, -1.0).argmax())
                        size = self._fits(stacks[best][-1], room)
                        if size >= self.limits.min_cut:
                            head, rest = _split(take(best), size)
                            wait(rest)
                            sequence.append(head)
                    break
                if not left or not room[0]:
                    break
            yield sequence
        self.items = [piece for stack in stacks for piece in stack]

    @staticmethod
    def _fits(piece: Piece, room: np.ndarray) -> int:
        """Largest head of ``piece`` within the room for tokens and loss, leaving a rest."""
        _, at, length, _, _, prompt, _ = piece
        return int(min(room[0], length - 1, max(prompt - at, 0) + room[2]))


def power_parts(sequence: list[Piece]) -> Iterator[list[Piece]]:
    """Split a sequence into sequences of power-of-two length, longest first."""
    rest = list(sequence)
    total = sum(p[2] for p in rest)
    while total:
        want = 1 << (total.bit_length() - 1)
        total -= want
        part = []
        while want:
            piece = rest.pop(0)
            if piece[2] > want:
                piece, tail = _split(piece, want)
                rest.insert(0, tail)
            part.append(piece)
            want -= piece[2]
        yield part


SCHEMA = (
    "doc_id long, start long, length long, n_loss long, doc_tokens long, sequence_id long, offset long, sequence_tokens long"
)


def pack(
    df: DataFrame,
    tokenizer_path: str,
    key: str = "doc_id",
    text: str = "text",
    prompt_tokens: str | None = None,
    end_id: int = 1,
    limits: Limits | None = None,
    digest: bool = False,
) -> DataFrame:
    """Tokenise every text, append ``end_id`` and pack; one row per piece.

    ``prompt_tokens`` names a column with the number of leading ids that bear
    no loss (none by default).  ``ids`` holds the piece's ids as little-endian
    unsigned 32-bit integers (with ``digest`` their crc32, ``ids_crc32``);
    ``sequence_tokens`` is the sequence's length before padding.
    """
    limits = limits or Limits()
    end = int(end_id).to_bytes(4, "little")
    columns = [key, text] + ([prompt_tokens] if prompt_tokens else [])
    schema = SCHEMA + (", ids_crc32 long" if digest else ", ids binary")
    names = [part.strip().split(" ")[0] for part in schema.split(",")]

    def process(batches):
        encoder, pool = word_encoder(tokenizer_path), Pool(limits)
        number = TaskContext.get().partitionId() << 33
        out: dict[str, list] = {n: [] for n in names}

        def place(sequence: list[Piece]) -> None:
            total = sum(p[2] for p in sequence)
            padded = limits.tokens - total > MAX_PADDING * limits.tokens and total & (total - 1)
            for part in power_parts(sequence) if padded else [sequence]:
                write(part)

        def write(sequence: list[Piece]) -> None:
            nonlocal number
            at, total = 0, sum(p[2] for p in sequence)
            for k, start, length, loss, n, _, ids in sequence:
                for name, value in zip(names, (k, start, length, loss, n, number, at, total, zlib.crc32(ids) if digest else ids)):
                    out[name].append(value)
                at += length
            number += 1

        for batch in batches:
            prompts = batch[prompt_tokens] if prompt_tokens else [0] * len(batch[key])
            for k, t, prompt in zip(batch[key], batch[text], prompts):
                for piece in cut(k, encoder.encode(t or "") + end, prompt or 0, limits):
                    if piece[2] == limits.tokens:
                        place([piece])
                    else:
                        pool.add(piece)
                if len(pool.items) >= limits.pool:
                    for sequence in pool.sequences(limits.pool // 4):
                        place(sequence)
            yield out
            out = {n: [] for n in names}
        for sequence in pool.sequences(0):
            place(sequence)
        yield out

    return map_rows(df, columns, process, schema)
