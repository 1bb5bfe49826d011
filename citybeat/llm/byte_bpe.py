"""Byte-level BPE encoding and decoding with a local rank file.

Every task builds one ``tiktoken`` encoding from the rank file and encodes
whole texts.  Long texts are cut before the library sees them, only at places
where the split pattern always ends a match: in front of an ASCII space or
line feed that follows a character that is not white space.  No alternative of
the pattern joins such a character to white space behind it, and the look-ahead
of the white-space alternatives only looks forward from white space.  Very long
white-space runs (which the pattern's look-ahead walks back over) are encoded
piece by piece by the rule of the pattern itself.

Edge cases: null text is the empty text (no ids, empty bytes); repeated rows
give repeated results; rows with a null key stay; extra columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

from pyspark.sql import DataFrame

from citybeat.llm.common import map_rows

#: Characters handed to the library at once.
CHUNK_CHARS = 1 << 16
#: White-space runs longer than this are encoded by rule instead of by the pattern.
LONG_SPACE = 1 << 12

_LONG_SPACE = re.compile(r"\s{%d,}" % LONG_SPACE)
_BOUNDARY = re.compile(r"(?<=\S)[ \n]")


@lru_cache(maxsize=2)
def load_encoding(path: str, pattern: str):
    """The tiktoken encoding of a rank file (``base64-token rank`` lines)."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_chunks(text: str, size: int = CHUNK_CHARS) -> Iterator[str]:
    """Cut ``text`` at safe boundaries, each chunk about ``size`` characters.

    A text without a safe boundary stays whole: a longer chunk is slower, never wrong.
    """
    lo = 0
    while len(text) - lo > size:
        m = _BOUNDARY.search(text, lo + size)
        if not m:
            break
        yield text[lo : m.start()]
        lo = m.start()
    yield text[lo:] if lo else text


def encode_text(encoding, text: str) -> list[int]:
    """Ids of one text, as the library gives them for the whole text."""
    if len(text) <= LONG_SPACE:
        return encoding.encode_ordinary(text)
    ids: list[int] = []
    for start, end, kind in _segments(text):
        if kind:
            ids += encoding._encode_single_piece(text[start:end])
        else:
            for chunk in safe_chunks(text[start:end]):
                ids += encoding.encode_ordinary(chunk)
    return ids


def _segments(text: str) -> Iterator[tuple[int, int, bool]]:
    """(start, end, is one white-space match) over the text.

    The pattern takes a white-space run up to its last character when text
    follows (that character starts the next match), and whole at the end.
    The part in front of such a run ends with a non-space, a safe boundary.
    """
    lo = 0
    for m in _LONG_SPACE.finditer(text):
        # Python's \s has four control characters that the pattern's has not: leave those to the library.
        if any("\x1c" <= c <= "\x1f" for c in set(m.group())):
            continue
        end = m.end() if m.end() == len(text) else m.end() - 1
        if m.start() > lo:
            yield lo, m.start(), False
        yield m.start(), end, True
        lo = end
    if lo < len(text):
        yield lo, len(text), False


def encode(
    df: DataFrame,
    ranks_path: str,
    pattern: str,
    key: str = "doc_id",
    text: str = "text",
    key_type: str = "long",
    finish: Callable[[list[int], bytes], tuple] | None = None,
    finish_schema: str = "",
) -> DataFrame:
    """Encode every text and decode the ids again.

    Returns the key, ``n_tokens``, ``ids`` (array of int) and ``decoded``
    (binary).  With ``finish`` the two large columns stay in the task: it maps
    (ids, decoded bytes) to the columns of ``finish_schema``.
    """
    schema = f"{key} {key_type}, n_tokens long, " + (finish_schema if finish else "ids array<int>, decoded binary")
    names = [part.strip().split(" ")[0] for part in schema.split(",")]

    def process(batches):
        encoding = load_encoding(ranks_path, pattern)
        for batch in batches:
            rows = []
            for k, t in zip(batch[key], batch[text]):
                ids = encode_text(encoding, t or "")
                decoded = encoding.decode_bytes(ids)
                rows.append((k, len(ids), *(finish(ids, decoded) if finish else (ids, decoded))))
            yield dict(zip(names, map(list, zip(*rows)))) if rows else {n: [] for n in names}

    return map_rows(df, [key, text], process, schema)


def decode(df: DataFrame, ranks_path: str, pattern: str, ids: str = "ids", key: str = "doc_id") -> DataFrame:
    """Raw bytes of an id column; null ids are the empty list."""

    def process(batches):
        encoding = load_encoding(ranks_path, pattern)
        for batch in batches:
            yield {key: batch[key], "decoded": [encoding.decode_bytes(x or []) for x in batch[ids]]}

    return map_rows(df, [key, ids], process, f"{key} long, decoded binary")


def digests(ids: list[int], decoded: bytes) -> tuple[str, str]:
    """SHA-256 of the decimal ids joined by one space, and of the decoded bytes."""
    return hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded).hexdigest()
