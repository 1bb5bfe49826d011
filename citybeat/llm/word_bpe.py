"""Ids of the public word-end BPE vocabulary, word by word.

The vocabulary's splitter never joins text across white space, so a text's
ids are those of its space-separated words in order, and a task only encodes
words it has not met before.  Words of ASCII and Latin letters take a fast
path: the merge list is handed to ``tiktoken`` with the word-end mark written
as one byte (0xFF, never part of UTF-8) in front of a piece's last byte; that
pair is merged first, then the merges follow in their listed order.  Every
other word goes to ``tokenizers``.  ``tests/llm`` holds both paths to the ids
``tokenizers`` gives for whole texts.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np

#: Words kept per task, twice: a full store is kept as the one before (about 60 MB).
CACHE_WORDS = 125_000
_MARK = b"\xff"
# Fixed value: the splitter of the public vocabulary file.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
FAST = r"[!-~À-ÖØ-öø-ÿŒœŠšŽž]*"


class WordEncoder:
    """Encodes texts to little-endian unsigned 32-bit ids."""

    def __init__(self, path: str):
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self._whole = Tokenizer.from_file(path)
        self._whole.encode_special_tokens = True  # their strings in a text are ordinary text
        self._pieces = regex.compile(PIECES).findall
        self._fast = regex.compile(FAST).fullmatch
        vocab, byte_of = model["vocab"], _byte_alphabet()
        char_of = {b: c for c, b in byte_of.items()}

        def raw(token: str) -> bytes:
            ends = token.endswith("</w>") and token != "</w>"
            body = bytes(byte_of[c] for c in (token[:-4] if ends else token))
            return body[:-1] + _MARK + body[-1:] if ends else body

        ranks = {_MARK + bytes([b]): b for b in range(255)}
        ids = {_MARK + bytes([b]): vocab[char_of[b] + "</w>"] for b in range(255)}
        for b in range(256):
            ranks[bytes([b])] = 256 + b
            ids[bytes([b])] = vocab[char_of[b]]
        for i, merge in enumerate(model["merges"]):
            token = "".join(merge) if isinstance(merge, list) else merge.replace(" ", "")
            ranks[raw(token)] = 1000 + i
            ids[raw(token)] = vocab[token]
        merge = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        self._merge = merge._core_bpe.encode_single_piece
        self._id = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self._id[rank] = ids[token].to_bytes(4, "little")
        self._seen: dict[str, bytes] = {}
        self._before: dict[str, bytes] = {}

    def _encode_word(self, word: str) -> bytes:
        # The letters of the fast path are composed already: normalising would change nothing.
        if not (word.isascii() and word.isprintable() or self._fast(word)):
            return np.array(self._whole.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()
        low = word.lower()
        ranks: list[int] = []
        for piece in (low,) if low.isalpha() else self._pieces(low):
            b = piece.encode()
            ranks += self._merge(b[:-1] + _MARK + b[-1:])
        return b"".join(map(self._id.__getitem__, ranks))

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, four bytes each."""
        words = text.replace("\n", " ").split(" ")
        seen = self._seen
        new = set(words).difference(seen)
        if new:
            if len(seen) > CACHE_WORDS:
                self._before, self._seen = seen, {}
                seen, new = self._seen, set(words)
            before, encode_word, merge, id_of = self._before.get, self._encode_word, self._merge, self._id.__getitem__
            for w in new:
                ids = before(w)
                if ids is None:
                    if w.isascii() and w.isalpha():
                        # the common case of _encode_word
                        b = w.lower().encode()
                        ids = b"".join(map(id_of, merge(b[:-1] + _MARK + b[-1:])))
                    else:
                        ids = encode_word(w) if w else b""
                seen[w] = ids
        return b"".join(map(seen.__getitem__, words))


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _byte_alphabet() -> dict[str, int]:
    """Printable stand-in character -> byte, by the public byte-level rule."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
