"""Count-only Viterbi segmentation of a unigram vocabulary.

An Aho-Corasick automaton names all vocabulary entries that end at a character, longest first.
Dynamic programming keeps the best score up to each character and how many tokens it takes; no
path is stored. Scores are added from the left in double precision. An entry replaces what is
known for its end only with a higher score, so of equal scores the entry that starts first wins. A
character without an entry of its own counts as unknown, scored 10 below the lowest score of the
vocabulary, and is spelled in its UTF-8 bytes.
"""

from __future__ import annotations

from functools import lru_cache

import ahocorasick

UNKNOWN_PENALTY = 10.0
MARK = "▁"  # stands for a space before a word
GENERATION = 250_000


class Counter(dict):
    """Score and number of tokens of each word, computed on access."""

    def __init__(self, pieces: list[tuple[str, float]]):
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        self.single = {p for p, _ in pieces if len(p) == 1}
        self.matcher = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self.matcher.add_word(piece, (len(piece), score))
        self.matcher.make_automaton()

    def __missing__(self, word: str) -> tuple[float, int]:
        found = self.segment(word)
        if len(word) <= 64:
            if len(self) >= GENERATION:
                self.clear()
            self[word] = found
        return found

    def segment(self, word: str) -> tuple[float, int]:
        best, tokens = [0.0], [0]
        matches = iter(self.matcher.iter(word))
        upcoming = next(matches, None)
        for end, character in enumerate(word):
            top = count = None
            while upcoming is not None and upcoming[0] == end:
                length, score = upcoming[1]
                start = end + 1 - length
                score += best[start]
                if top is None or score > top:
                    top, count = score, tokens[start] + 1
                upcoming = next(matches, None)
            if character not in self.single:
                score = best[end] + self.unknown
                if top is None or score > top:
                    top, count = score, tokens[end] + len(character.encode("utf-8", "replace"))
            best.append(top)
            tokens.append(count)
        return best[-1], tokens[-1]

    def count(self, text: str) -> tuple[int, float]:
        """Tokens of a text and the sum of its words' scores; every space starts a word."""
        if not text:
            return 0, 0.0
        if not text.startswith((" ", MARK)):
            text = " " + text
        first, *words = text.replace(" ", MARK).split(MARK)
        found = [self[MARK + w] for w in words]
        return sum(n for _, n in found), sum(s for s, _ in found)


@lru_cache(maxsize=2)
def counter(pieces: tuple[tuple[str, float], ...]) -> Counter:
    return Counter(list(pieces))
