"""Which tokens may stand side by side in a byte-pair encoding.

The merges of a trained vocabulary happen in the order of their ranks, so a
sequence of tokens is the encoding of its text exactly if every two neighbours
are the encoding of theirs.  ``Merges.fits`` answers that for two tokens from
the merges along their facing edges; a left-to-right scan over a text then
needs only the last token of every prefix.
"""

from __future__ import annotations

import json
from collections.abc import Callable

END = "</w>"
# Pairs of tokens whose fit is remembered before the memory starts anew.
REMEMBERED = 300_000


class Merges:
    """``rank(a, b)``: when two neighbouring symbols merge, or None.  Symbols are strings."""

    def __init__(self, rank: Callable[[str, str], int | None], split: Callable[[str], list[str]], join: Callable[[str, str], str]) -> None:
        self.rank, self.split, self.join = rank, split, join
        self._edges: dict[str, tuple] = {}
        self._fits: dict[tuple[str, str], bool] = {}

    def encode(self, symbols: list[str], watch: Callable[[int, list[str], int], None] | None = None) -> list[str]:
        """Merge the pair of least rank, the leftmost first, until none is left.  For short sequences."""
        s = list(symbols)
        while len(s) > 1:
            best, at = None, -1
            for i in range(len(s) - 1):
                r = self.rank(s[i], s[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            if watch:
                watch(best, s, at)
            s[at : at + 2] = [self.join(s[at], s[at + 1])]
        return s

    def edges(self, token: str) -> tuple[list, list, bool]:
        """How the first and the last symbol of a token grow: [(symbol, rank it merges at)], and whether the text encodes to it."""
        known = self._edges.get(token)
        if known is None:
            first: list = []
            last: list = []

            def watch(r: int, s: list[str], at: int) -> None:
                if at == 0:
                    first.append((s[0], r))
                if at == len(s) - 2:
                    last.append((s[-1], r))

            ends = self.encode(self.split(token), watch)
            known = self._edges[token] = ([*first, (ends[0], None)], [*last, (ends[-1], None)], ends == [token])
        return known

    def is_token(self, token: str) -> bool:
        return self.edges(token)[2]

    def fits(self, a: str, b: str) -> bool:
        """True if the text of ``a + b`` encodes to these two tokens (both encode to themselves)."""
        known = self._fits.get((a, b))
        if known is None:
            if len(self._fits) > REMEMBERED:
                self._fits.clear()
            known = self._fits[a, b] = self._apart(self.edges(a)[1], self.edges(b)[0])
        return known

    def _apart(self, left: list, right: list) -> bool:
        i = j = 0
        while True:
            (x, rx), (y, ry) = left[i], right[j]
            r = self.rank(x, y)
            if r is not None and (rx is None or r < rx) and (ry is None or r <= ry):
                return False  # the two merge across the border first
            if rx is None and ry is None:
                return True
            if ry is None or (rx is not None and rx <= ry):
                i += 1
            else:
                j += 1


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: itself where printable, else one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


def word_merges(path: str) -> tuple[Merges, list[str], list[str]]:
    """Merges, vocabulary and special strings of a ``tokenizers`` file whose tokens end words with ``</w>``."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    order = {(a, b): i for i, (a, b) in enumerate(x if isinstance(x, list) else x.split(" ") for x in model["merges"])}
    rank = lambda a, b: order.get((a, b))

    def split(token: str) -> list[str]:
        if token.endswith(END) and len(token) > len(END):
            body = token[: -len(END)]
            return [*body[:-1], body[-1] + END]
        return list(token)

    special = [t["content"] for t in spec["added_tokens"]]
    return Merges(rank, split, lambda a, b: a + b), list(model["vocab"]), special
