"""Byte-level BPE by dynamic programming over prefixes.

The encoding of every prefix of a word ends in one well-defined token. A vocabulary token that
is a suffix of the prefix is that last token exactly when the encoding of what precedes it may
stand beside it, that is when merging the two by rank would keep their boundary. So one pass
stores the last token of every prefix, and the back-pointers spell the encoding.
"""

from __future__ import annotations

import json
import re
import struct
from functools import lru_cache

import ahocorasick
import regex

# The white space and the word pattern of byte-level BPE; the space is spelled
# out, as the libraries differ in what \s holds.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORDS = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + SPACE + r"\p{L}\p{N}]+"
         r"|[" + SPACE + r"]+(?![^" + SPACE + r"])|[" + SPACE + r"]+")
AT_EDGE = re.compile(rf"\A[{SPACE}]|[{SPACE}]\Z")

GENERATION = 100_000  # entries; two generations of two caches take up to 100 MB while a worker encodes
PAIRS = 300_000  # tested pairs that are remembered


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte in the vocabulary file, and back."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Cache(dict):
    """Packed ids by text; a missing entry is computed on access. Very long texts are not kept.

    A full cache becomes the old generation, from which entries in use are taken over again.
    """

    def __init__(self, compute):
        self.compute = compute
        self.old: dict[str, bytes] = {}

    def __missing__(self, text: str) -> bytes:
        packed = self.old.get(text)
        if packed is None:
            packed = self.compute(text)
        if len(text) <= 64:
            if len(self) >= GENERATION:
                self.old = dict(self)
                self.clear()
            self[text] = packed
        return packed


class Loose(Exception):
    """White space at the edge of a piece."""


class Encoder:
    """Ids and bytes of a byte-level BPE vocabulary, given as the content of its JSON file."""

    def __init__(self, raw: bytes):
        spec = json.loads(raw)
        table = byte_characters()
        vocab = spec["model"]["vocab"]
        self.token_bytes = {i: bytes(table[c] for c in token) for token, i in vocab.items()}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, (left, right) in enumerate(pairs):
            whole = vocab[left + right]
            self.rank[vocab[left], vocab[right]] = rank
            self.parts.setdefault(whole, (rank, vocab[left], vocab[right]))
        self.matcher = ahocorasick.Automaton()
        for i, token in self.token_bytes.items():
            if len(token) == 1 or i in self.parts:  # others cannot result from merges
                self.matcher.add_word(token.decode("latin-1"), (len(token), i))
        self.matcher.make_automaton()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for content, i in self.special.items():
            self.token_bytes[i] = content.encode()
        self.splitter = re.compile("|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)))
        self.find_words = regex.compile(WORDS).findall
        self.known: dict[tuple[int, int], bool] = {}
        self.words = Cache(self._packed)
        self.pieces = Cache(self._piece)

    def _boundary_holds(self, left: int, right: int) -> bool:
        """Whether merging the two tokens' text by rank leaves the boundary between them."""
        # Undo merges from the latest on. Tokens beside the boundary at any moment must not merge
        # before the merge that was undone last; of equal merges the left one comes first.
        latest, strict = len(self.rank), True
        while True:
            rank = self.rank.get((left, right))
            if rank is not None and (rank < latest or (rank == latest and not strict)):
                return False
            a, b = self.parts.get(left), self.parts.get(right)
            if a is None and b is None:
                return True
            if b is None or (a is not None and a[0] > b[0]):
                latest, strict, left = a[0], True, a[2]
            else:
                latest, strict, right = b[0], False, b[1]

    def encode_word(self, text: bytes) -> list[int]:
        size = len(text)
        last: list[int] = [-1] * (size + 1)
        start: list[int] = [0] * (size + 1)
        known = self.known
        for end, (length, token) in self.matcher.iter(text.decode("latin-1")):  # longest first at each end
            end += 1
            if last[end] >= 0:
                continue
            begin = end - length
            if begin:
                pair = last[begin], token
                try:
                    holds = known[pair]
                except KeyError:
                    if len(known) >= PAIRS:
                        known.clear()
                    holds = known[pair] = self._boundary_holds(*pair)
                if not holds:
                    continue
            last[end], start[end] = token, begin
        ids = []
        at = size
        while at:
            ids.append(last[at])
            at = start[at]
        return ids[::-1]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; special strings are their own ids."""
        plain, pieces, at = self._plain, [], 0
        for hit in self.splitter.finditer(text) if self.special else ():
            pieces.append(plain(text[at:hit.start()]))
            pieces.append(struct.pack("<I", self.special[hit.group()]))
            at = hit.end()
        pieces.append(plain(text[at:] if at else text))
        return b"".join(pieces)

    def _packed(self, word: str) -> bytes:
        ids = self.encode_word(word.encode())
        return struct.pack(f"<{len(ids)}I", *ids)

    def _loose(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, self.find_words(text)))

    def _piece(self, piece: str) -> bytes:
        if not piece or AT_EDGE.search(piece):
            raise Loose
        words = self.find_words(" " + piece)
        # most pieces are one word and need no second entry
        return self._packed(words[0]) if len(words) == 1 else b"".join(map(self.words.__getitem__, words))

    def _plain(self, text: str) -> bytes:
        # A space with no other white space beside it always starts a word, so the text may be
        # cut there and its pieces looked up. Other texts go through the pattern as a whole.
        first, *inner = text.split(" ")
        if not inner or AT_EDGE.search(first):
            return self._loose(text)
        try:
            return self._loose(first) + b"".join(map(self.pieces.__getitem__, inner))
        except Loose:
            return self._loose(text)

    def decode(self, ids: bytes) -> str:
        found = map(self.token_bytes.__getitem__, memoryview(ids).cast("I"))
        return b"".join(found).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def encoder(raw: bytes) -> Encoder:
    """One encoder per vocabulary and worker process."""
    return Encoder(raw)
