"""Token counts by a compiled finite-state tokenizer.

Within a word the tokenizer is a deterministic transducer over bytes.  Its state
is what the last token of every coming prefix can depend on: the longest suffix
read so far that some token begins with, and the last token and token count at
each position of that suffix.  Every transition, and the end of a word from
every state, carries the change of the token count.  States are compiled when
a text first reaches them.

A text is cut into chunks.  A chunk's state map sends whatever comes in (the
unfinished stretch before it) to a count and the unfinished stretch it leaves;
white space resets the transducer, so a map is a head, a count and a tail.
Maps compose associatively, and a parallel prefix scan composes them.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.llm.bpe import END, byte_characters, word_merges
from gridlens.llm.common import prepare, text_or_empty

TOKENIZER = "word_bpe_49k.json"
LIMIT = 2048
# Characters in a chunk of a text.
CHUNK = 65_536
# Word counts that are remembered in a worker before it starts anew.
REMEMBERED = 300_000
# States that are kept between words; beyond these the transducer is compiled anew.
STATES = 250_000
# Fixed values of this tokenizer kind: its word pattern.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
_WORDS = regex.compile(WORD)
_SPACES = regex.compile(r"\s+")


class Transducer:
    """``count(word)``: the number of tokens of one word, by transitions."""

    def __init__(self, path: str) -> None:
        self.merges, vocab, self.special = word_merges(path)
        inner = {t for t in vocab if not t.endswith(END) or t == END}
        self.begins = {t[:i] for t in vocab for i in range(1, len(t.removesuffix(END)) + 1)}
        self.inner = inner
        self.final = {t.removesuffix(END) for t in vocab if t.endswith(END)}
        self.letters = byte_characters()
        self._restart()

    def _restart(self) -> None:
        """State 0: nothing read.  A state: (suffix, last token and relative count at each of its positions)."""
        self.states: list[tuple] = [("", ((None, 0),))]
        self.known: dict[tuple, int] = {self.states[0]: 0}
        self.arcs: list[dict[int, tuple[int, int]]] = [{}]
        self.ends: list[int | None] = [0]

    def _step(self, state: int, byte: int) -> tuple[int, int]:
        suffix, places = self.states[state]
        text = suffix + self.letters[byte]
        token, count = None, 0
        for at, (last, n) in enumerate(places):
            t = text[at:]
            if t in self.inner and self.merges.is_token(t) and (last is None or self.merges.fits(last, t)):
                token, count = t, n + 1
                break
        if token is None:
            raise ValueError(f"no token ends after {text!r}")
        cut = next((i for i in range(len(text)) if text[i:] in self.begins), len(text))
        new = (text[cut:], (*((last, n - count) for last, n in places[cut:]), (token, 0)))
        to = self.known.get(new)
        if to is None:
            to = self.known[new] = len(self.states)
            self.states.append(new)
            self.arcs.append({})
            self.ends.append(None)
        arc = self.arcs[state][byte] = (to, count)
        return arc

    def _end(self, state: int) -> int:
        suffix, places = self.states[state]
        for at, (last, n) in enumerate(places[:-1]):
            t = suffix[at:]
            if t in self.final:
                t += END
                if self.merges.is_token(t) and (last is None or self.merges.fits(last, t)):
                    self.ends[state] = n + 1
                    return n + 1
        raise ValueError(f"no token ends a word after {suffix!r}")

    def count(self, word: str) -> int:
        if len(self.states) > STATES:
            self._restart()
        state, total, arcs = 0, 0, self.arcs
        for byte in word.encode("utf-8"):
            arc = arcs[state].get(byte)
            if arc is None:
                arc = self._step(state, byte)
            state, more = arc
            total += more
        end = self.ends[state]
        return total + (self._end(state) if end is None else end)


class WordCounts(dict):
    """Word -> tokens; words met for the first time run through the transducer."""

    def __init__(self, machine: Transducer) -> None:
        super().__init__()
        self.machine = machine

    def __missing__(self, word: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        n = self[word] = self.machine.count(word)
        return n


@dataclass(frozen=True)
class ChunkMap:
    """A chunk between white space resets; ``tail`` is None if it has none and is all head."""

    head: str
    count: int
    tail: str | None


class Tokenizer:
    def __init__(self, path: str) -> None:
        self.machine = Transducer(path)
        self.words = WordCounts(self.machine)
        marks = sorted(self.machine.special, key=len, reverse=True)
        self.marks = regex.compile("|".join(map(regex.escape, marks))) if marks else None

    def stretch(self, text: str) -> int:
        """Tokens of a normalised text that white space, or an end of the text, bounds."""
        return sum(map(self.words.__getitem__, _WORDS.findall(text)))

    def chunk(self, text: str) -> ChunkMap:
        first = text.find(" ")
        if first < 0:
            return ChunkMap(text, 0, None)
        last = text.rfind(" ")
        return ChunkMap(text[:first], self.stretch(text[first:last]), text[last + 1 :])

    def compose(self, a: ChunkMap, b: ChunkMap) -> ChunkMap:
        if a.tail is None:
            return ChunkMap(a.head + b.head, b.count, b.tail)
        if b.tail is None:
            return ChunkMap(a.head, a.count, a.tail + b.head)
        return ChunkMap(a.head, a.count + self.stretch(a.tail + b.head) + b.count, b.tail)

    def scan(self, maps: list[ChunkMap]) -> list[ChunkMap]:
        """Inclusive prefix compositions: compose neighbours, scan the half, fill in the others."""
        if len(maps) < 2:
            return maps
        pairs = [self.compose(a, b) for a, b in zip(maps[::2], maps[1::2])]
        half = self.scan(pairs)
        out = [maps[0]]
        for i in range(1, len(maps)):
            out.append(half[i // 2] if i % 2 else self.compose(half[i // 2 - 1], maps[i]))
        return out

    def part(self, text: str, size: int = CHUNK) -> int:
        """Tokens of a text without special strings."""
        norm = unicodedata.normalize("NFC", text)
        norm = _SPACES.sub(" ", norm)
        # each character by itself: a capital sigma does not look at what follows
        norm = norm.lower() if "Σ" not in norm else "".join(c.lower() for c in norm)
        if len(norm) <= size:
            return self.stretch(norm)
        whole = self.scan([self.chunk(norm[i : i + size]) for i in range(0, len(norm), size)])[-1]
        return whole.count + self.stretch(whole.head) + (self.stretch(whole.tail) if whole.tail else 0)

    def count(self, text: str, size: int = CHUNK) -> int:
        if self.marks is None or not self.marks.search(text):
            return self.part(text, size)
        return len(self.marks.findall(text)) + sum(self.part(t, size) for t in self.marks.split(text))


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    """One compiled tokenizer per worker and file."""
    return Tokenizer(path)


def token_counts(docs: DataFrame, name: str = TOKENIZER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_tokens)`` per row; ``name`` is a vocabulary that every executor has installed.

    Null and empty texts have none.  Strings of special tokens inside a text
    count as one token, as the vocabulary's library takes them by default.
    Repeated rows each get their row; other columns are not read.
    """
    prepare(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    src = src.select("doc_id", "text", F.octet_length("text").cast("long").alias("n_bytes"))
    id_type = src.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        t = tokenizer(public_tokenizers.path(name))
        for b in batches:
            n = pa.array([t.count(x.as_py()) for x in b.column(1)], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), n], ["doc_id", "n_bytes", "n_tokens"])

    return src.mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_tokens long")


def query(docs: DataFrame) -> DataFrame:
    return token_counts(docs).withColumn("over_limit", F.col("n_tokens") > LIMIT)
