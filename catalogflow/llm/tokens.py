"""Whole texts to token ids and token spans, with the byte-level vocabulary ``byte_bpe_50k``."""

from __future__ import annotations

import base64
import re
import sys
from array import array

import numpy as np
import tiktoken
from tokenizers import Tokenizer

_PLAIN = re.compile(r"[\x00-ɏ]*")
_LOOSE_SPACE = re.compile(r" (?!\S)")
_WORD_SPACE = re.compile(r" (?=\S)")


class _Cache(dict):
    """Value per piece, made when first asked for; pieces not asked for lately are dropped beyond ``limit``."""

    def __init__(self, prefix: str, make, limit: int):
        super().__init__()
        self._prefix, self._make, self._half, self._older = prefix, make, limit // 2, {}

    def __missing__(self, piece: str):
        value = self._older.get(piece)
        if value is None:
            value = self._make(self._prefix + piece)
        self[piece] = value
        return value

    def trim(self) -> None:
        if len(self) > self._half:
            self._older = dict(self)
            self.clear()


class Encoder:
    """Encodes whole texts; the ids are those of ``tokenizers`` with the JSON file, no special tokens added. Where the text itself has the string of a
    special token, that is one id, as there.

    The vocabulary never joins a space and a word after it with what comes before, so a text is
    cut at such spaces, and each different piece is encoded once while it is in the cache. Pieces
    of Latin script use the same vocabulary as ranks, which is faster; the others use the JSON file.
    ``limit`` bounds the cache.
    """

    def __init__(self, vocabulary: str | None = None, ranks: str | None = None, limit: int = 300_000):
        import public_tokenizers as public

        self._slow = Tokenizer.from_file(vocabulary or public.path("byte_bpe_50k.json"))
        self._special = {token.content: number for number, token in self._slow.get_added_tokens_decoder().items()}
        self._marks = re.compile("|".join(map(re.escape, sorted(self._special, key=len, reverse=True)))) if self._special else None
        with open(ranks or public.path("byte_bpe_50k.tiktoken"), "rb") as lines:
            known = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self._fast = tiktoken.Encoding("byte_bpe_50k", pat_str=public.PATTERN, mergeable_ranks=known, special_tokens={})
        self._first, self._next = _Cache("", self._packed, limit // 8), _Cache(" ", self._packed, limit)
        self._sizes = np.zeros(max([*known.values(), *self._special.values()]) + 1, np.int64)
        for token, rank in [*known.items(), *((t.encode(), n) for t, n in self._special.items())]:
            self._sizes[rank] = len(token)

    def _piece_ids(self, piece: str) -> list[int]:
        if piece.isascii() or _PLAIN.fullmatch(piece):
            return self._fast.encode_ordinary(piece)
        return self._slow.encode(piece, add_special_tokens=False).ids

    def _packed(self, piece: str) -> bytes:
        ids = array("I", self._piece_ids(piece))
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def _cut(self, text: str) -> list[str]:
        self._first.trim()
        self._next.trim()
        return _WORD_SPACE.split(text) if _LOOSE_SPACE.search(text) else text.split(" ")

    def ids(self, text: str) -> bytes:
        """All ids of the text as little-endian unsigned 32-bit numbers."""
        if self._marks is None or not (found := self._marks.search(text)):
            return self._plain_ids(text)
        out, at = [], 0
        while found:
            out += [self._plain_ids(text[at : found.start()]), self._special[found[0]].to_bytes(4, "little")]
            at = found.end()
            found = self._marks.search(text, at)
        return b"".join([*out, self._plain_ids(text[at:])])

    def _plain_ids(self, text: str) -> bytes:
        first, *rest = self._cut(text)
        return self._first[first] + b"".join(map(self._next.__getitem__, rest))

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each token in characters; a token that holds part of a character spans it whole."""
        ends = np.cumsum(self._sizes[np.frombuffer(self.ids(text), "<u4")], dtype=np.int64)
        starts = np.concatenate([ends[:0], [0], ends[:-1]]) if len(ends) else ends
        if not text.isascii():
            raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
            begun = np.cumsum((raw & 0xC0) != 0x80)  # characters that have begun by each byte
            starts, ends = begun[starts] - 1, begun[ends - 1]
        return starts, ends


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(vocabulary: str | None = None, ranks: str | None = None) -> Encoder:
    """One encoder per worker process and vocabulary."""
    if (vocabulary, ranks) not in _ENCODERS:
        _ENCODERS[vocabulary, ranks] = Encoder(vocabulary, ranks)
    return _ENCODERS[vocabulary, ranks]
