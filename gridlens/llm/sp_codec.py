"""SentencePiece encoding and decoding by suffix-array matching.

The distinct words of a batch (no piece reaches over a space into the next word)
are concatenated and indexed by a suffix array.  Every piece of the vocabulary
is looked up in it by binary search; its range gives all its occurrences, which
are the edges of a lattice over the text.  The edges are sorted by position and
relaxed from left to right: each place keeps the one last piece of the encoding
of the text up to it.  For a merge vocabulary, an edge is that piece if it and
the last piece where the edge begins fit together (see ``bpe``).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.llm.bpe import Merges
from gridlens.llm.common import prepare, text_blocks, text_or_empty
from gridlens.llm.suffix_array import Patterns, suffix_array

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
# In the indexed text a space mark is one byte, and one byte ends each word; neither occurs in UTF-8.
MARK, STOP = b"\xff", b"\xfe"
# Bytes of distinct words that are indexed at once.
INDEX_BYTES = 1_000_000
# Words that a worker remembers before it starts anew.
REMEMBERED = 400_000
# Longer words are relaxed one at a time.
LONG_WORD = 200
# Pieces whose fitting pairs are kept in one square table.
TABLE = 8192


class Pairs:
    """Which pieces may follow which: a square table over the pieces met so far, filled when first asked.

    ``places`` gives the pieces' places in the table.  Text with more different
    pieces than the table holds asks by the pieces themselves instead.
    """

    def __init__(self, fits) -> None:
        self.fits, self.place, self.pieces, self.wide = fits, {}, [], False
        self.known = np.full((TABLE, TABLE), -1, np.int8)
        self.one = lru_cache(maxsize=REMEMBERED)(fits)

    def places(self, tokens: np.ndarray) -> np.ndarray:
        distinct, back = np.unique(tokens, return_inverse=True)
        self.wide = len(distinct) > TABLE
        if self.wide:
            return tokens.astype(np.int32)
        new = [t for t in distinct.tolist() if t not in self.place]
        if len(self.pieces) + len(new) > TABLE:  # start anew
            self.place, self.pieces, new = {}, [], distinct.tolist()
            self.known.fill(-1)
        for t in new:
            self.place[t] = len(self.pieces)
            self.pieces.append(t)
        return np.array([self.place[t] for t in distinct.tolist()], np.int32)[back]

    def ask(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """For places from the last call of ``places``: whether the right one may follow the left one."""
        if self.wide:
            return np.array([self.one(x, y) for x, y in zip(left.tolist(), right.tolist())], bool)
        out = self.known[left, right]
        missing = np.flatnonzero(out < 0)
        if len(missing):
            code = np.unique(left[missing].astype(np.int64) * TABLE + right[missing])
            for x, y in zip((code // TABLE).tolist(), (code % TABLE).tolist()):
                self.known[x, y] = self.fits(self.pieces[x], self.pieces[y])
            out = self.known[left, right]
        return out > 0


class Codec:
    """Vocabulary tables of one model; encodes distinct words, decodes ids."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(sp.vocab_size())
        self.byte_id = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        normal = [i for i in ids if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.piece = {i: sp.id_to_piece(i) for i in normal}
        self.id = {p: i for i, p in self.piece.items()}
        score = {p: sp.get_score(i) for i, p in self.piece.items()}
        # merges of higher score come first; the runs of spaces, which share the least score, are left out of them
        order = {s: n for n, s in enumerate(sorted(set(score.values()), reverse=True))}
        rank = {p: order[s] for p, s in score.items()}
        self.merges = Merges(lambda a, b: rank.get(a + b), list, lambda a, b: a + b)
        self.pairs = Pairs(self._fit)
        self._forget()
        self.runs = {p for p in self.id if len(p) > 1 and set(p) == {SPACE}}
        if any(SPACE in p[1:] and p not in self.runs for p in self.id):
            raise ValueError("a piece holds a space mark inside")
        if sp.encode("a")[:1] != sp.encode(SPACE + "a")[:1] and sp.encode("a") != [self.id.get(SPACE + "a")]:
            raise ValueError("the model does not put a space before a text")
        searched = [i for i in normal if self.piece[i] not in self.runs and self.merges.is_token(self.piece[i])]
        self.searched = np.array(searched, np.int64)
        self.patterns = Patterns([self.piece[i].replace(SPACE, "\0").encode().replace(b"\0", MARK) if SPACE in self.piece[i] else self.piece[i].encode() for i in searched])
        single = [len(self.piece[i]) == 1 for i in searched]
        self.single = np.array(single, bool)
        self.name = [self.piece.get(i, "") for i in ids]
        # what each id adds to a decoded text; a space mark is a space
        raw = [bytes([self.byte_id.index(i)]) if i in set(self.byte_id) else self.name[i].replace(SPACE, " ").encode() for i in ids]
        self.raw_start = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        self.raw = np.frombuffer(b"".join(raw), np.uint8)

    def space_run(self, n: int) -> list[int]:
        """Ids of ``n`` spaces that nothing else joins: the longest run of the vocabulary, again and again."""
        out: list[int] = []
        for size in sorted([1, *map(len, self.runs)], reverse=True):
            out += [self.id[SPACE * size]] * (n // size)
            n %= size
        return out

    def _forget(self) -> None:
        """Words that have been encoded: their numbers, and where in ``flat`` their ids are."""
        self.memory: dict[str, int] = {}
        self.flat = np.empty(0, np.int32)
        self.size = np.empty(0, np.int64)

    def _fit(self, a: int, b: int) -> bool:
        """Bytes of characters without a piece stand beside anything."""
        return not (self.name[a] and self.name[b]) or self.merges.fits(self.name[a], self.name[b])

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words one after the other, and each word's number of ids.

        A word is one space mark and what follows up to the next.
        """
        long = [i for i, w in enumerate(words) if len(w) > LONG_WORD]
        if long:
            ids = [np.empty(0, np.int32)] * len(words)
            for relax, part in ((self._relax, sorted(set(range(len(words))) - set(long))), (self._relax_long, long)):
                flat, size = self._blocks([words[i] for i in part], relax)
                for i, own in zip(part, np.split(flat, np.cumsum(size)[:-1])):
                    ids[i] = own
            return np.concatenate(ids), np.array([len(x) for x in ids], np.int64)
        return self._blocks(words, self._relax)

    def _blocks(self, words: list[str], relax) -> tuple[np.ndarray, np.ndarray]:
        parts, start, size = [], 0, 0
        for i, w in enumerate(words):
            size += len(w.encode()) + 1
            if size > INDEX_BYTES or i == len(words) - 1:
                parts.append(relax(*self._indexed(words[start : i + 1])))
                start, size = i + 1, 0
        if not parts:
            return np.empty(0, np.int32), np.empty(0, np.int64)
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def _indexed(self, words: list[str]) -> tuple[np.ndarray, ...]:
        """The lattice of the words: where each ends, and the edges (source, target, piece) by position, the longest first."""
        blob = MARK + (STOP + MARK).join(w[1:].encode() for w in words) + STOP
        data = np.frombuffer(blob, np.uint8)
        order, first = suffix_array(data, int(self.patterns.size.max()))
        begin, end = self.patterns.ranges(data, order, first)
        times = end - begin
        which = np.repeat(np.arange(len(times)), times)
        at = np.arange(len(which)) - np.repeat(np.cumsum(times) - times - begin, times)
        source = order[at].astype(np.int64)
        target = source + self.patterns.size[which]
        # a character without a piece of its own is written as bytes, and no piece joins it
        starts = np.flatnonzero(((data & 0xC0) != 0x80) & (data != STOP[0]))
        covered = np.zeros(len(data), bool)
        covered[source[self.single[which]]] = True
        bare = starts[~covered[starts]]
        width = np.where(data[bare] >= 0xF0, 4, np.where(data[bare] >= 0xE0, 3, np.where(data[bare] >= 0xC0, 2, 1)))
        bare = np.repeat(bare, width) + np.arange(int(width.sum())) - np.repeat(np.cumsum(width) - width, width)
        source = np.concatenate([source, bare])
        target = np.concatenate([target, bare + 1])
        token = np.concatenate([self.searched[which], np.array(self.byte_id)[data[bare]]]).astype(np.int64)
        order = np.argsort((target << 8) | (source - target + 255))
        return np.flatnonzero(data == STOP[0]), source[order], target[order], token[order]

    def _relax_long(self, stops: np.ndarray, source: np.ndarray, target: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``_relax``, edge by edge: few long words give little to do side by side."""
        n = int(stops[-1]) + 1
        last, back = [-1] * n, [-1] * n
        begins = {0, *(stops[:-1] + 1).tolist()}
        fits = self.pairs.one
        for s, e, t in zip(source.tolist(), target.tolist(), token.tolist()):
            if back[e] < 0 and (s in begins or (back[s] >= 0 and fits(last[s], t))):
                last[e], back[e] = t, s
        out, sizes = [], []
        for at in stops.tolist():
            if back[at] < 0:
                raise ValueError("a word has no encoding")
            ids = []
            while True:
                ids.append(last[at])
                at = back[at]
                if at in begins:
                    break
            out += reversed(ids)
            sizes.append(len(ids))
        return np.array(out, np.int32), np.array(sizes, np.int64)

    def _relax(self, stops: np.ndarray, source: np.ndarray, target: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keep at each place the edge that fits the edge kept where it begins; then read the words backwards.

        Edges are sorted by their end within the word, and among those that end
        together by length; all words of the batch are relaxed side by side.
        """
        begins = np.append(0, stops[:-1] + 1)
        fresh = np.append(True, target[1:] != target[:-1])
        turn = np.arange(len(target)) - np.maximum.accumulate(np.where(fresh, np.arange(len(target)), 0))
        within = target - begins[np.searchsorted(stops, target)]
        key = within * 256 + np.minimum(turn, 255)
        order = np.argsort(key, kind="stable")
        source, target, token, key = source[order], target[order], token[order], key[order]
        cut = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        place = self.pairs.places(token)
        n = int(stops[-1]) + 1
        back = np.full(n, -1, np.int64)
        last = np.full(n, -1, np.int32)
        kept = np.full(n, -1, np.int64)
        back[begins] = begins
        for lo, hi in zip(cut.tolist(), [*cut[1:].tolist(), len(key)]):
            s, e = source[lo:hi], target[lo:hi]
            open_ = np.flatnonzero((back[e] < 0) & (back[s] >= 0))
            if not len(open_):
                continue
            s, e, mine = s[open_], e[open_], place[lo:hi][open_]
            ok = last[s] < 0  # the edge begins the word
            after = np.flatnonzero(~ok)
            ok[after] = self.pairs.ask(last[s[after]], mine[after])
            back[e[ok]], last[e[ok]], kept[e[ok]] = s[ok], mine[ok], token[lo:hi][open_][ok]
        if (back[stops] < 0).any():
            raise ValueError("a word has no encoding")
        word, at = np.arange(len(stops)), stops
        steps: list[tuple] = []
        while len(word):
            steps.append((word, kept[at]))
            at = back[at]
            going = at > begins[word]
            word, at = word[going], at[going]
        owner = np.concatenate([w for w, _ in steps])
        ids = np.concatenate([k for _, k in steps])
        # the steps of a word run from its end to its begin
        order = np.argsort(owner[::-1], kind="stable")
        return ids[::-1][order].astype(np.int32), np.bincount(owner, minlength=len(stops))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a batch one after the other, and where each text's begin (and the last end)."""
        if len(self.memory) > REMEMBERED:
            self._forget()
        memory, seen, counts = self.memory, [], [0]
        known = len(memory)
        number = memory.setdefault
        for t in texts:
            if t:
                seen += [number(w, len(memory)) for w in _units(t)]
            counts.append(len(seen))
        if len(memory) > known:
            self._learn(list(islice(memory, known, None)))
        seen_ = np.array(seen, np.int64)
        size = self.size[seen_]
        start = (np.cumsum(self.size) - self.size)[seen_]
        bounds = np.append(0, np.cumsum(size))
        return gather(self.flat, start, size), bounds[counts]

    def _learn(self, units: list[str]) -> None:
        """Encode new units: runs of space marks and the word after them; the last mark belongs to the word."""
        body = [u.lstrip(SPACE) for u in units]
        words = dict.fromkeys(SPACE + w for w in body if w)
        ids, size = self.words(list(words))
        if len(words) < len(units) or any(len(u) - len(w) != 1 for u, w in zip(units, body)):
            cut = np.split(ids, np.cumsum(size)[:-1]) if len(size) else []
            of = dict(zip(words, cut))
            rows, lone = [], self.id[SPACE]
            for u, w in zip(units, body):
                run = len(u) - len(w) - bool(w)
                own = of[SPACE + w].tolist() if w else []
                if run and own and own[0] == lone:  # the word's mark merged with nothing: it is one of the run
                    run, own = run + 1, own[1:]
                rows.append(self.space_run(run) + own if run else own)
            size = np.array([len(r) for r in rows], np.int64)
            ids = np.array([i for r in rows for i in r], np.int32)
        self.flat = np.concatenate([self.flat, ids])
        self.size = np.concatenate([self.size, size])

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """The texts of a batch of ids: pieces and bytes joined, without the space put before the text."""
        start, size = self.raw_start[ids], self.raw_start[ids + 1] - self.raw_start[ids]
        data = gather(self.raw, start, size).tobytes()
        ends = np.concatenate([[0], np.cumsum(size)])
        cut = ends[bounds].tolist()
        out = []
        for a, b in zip(cut, cut[1:]):
            t = data[a:b]
            out.append((t[1:] if t[:1] == b" " else t).decode("utf-8", "replace"))
        return out


_UNIT = re.compile(f"{SPACE}+[^{SPACE}]*")


def _units(text: str) -> list[str]:
    """A text, with a space put before it, as runs of space marks with the word after each."""
    marked = SPACE + text.replace(" ", SPACE)
    if SPACE + SPACE in marked or marked.endswith(SPACE):
        return _UNIT.findall(marked)
    return [SPACE + w for w in marked[1:].split(SPACE)]


def gather(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The slices ``values[start:start + size]`` one after the other."""
    total = int(size.sum())
    step = np.ones(total, np.int64)
    full = size > 0
    s, n = start[full], size[full]
    if not total:
        return values[:0]
    head = np.cumsum(n) - n
    step[0] = s[0]
    step[head[1:]] = s[1:] - (s[:-1] + n[:-1] - 1)
    return values[np.cumsum(step)]


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec per worker and model."""
    return Codec(path)


def encoded(docs: DataFrame, name: str = MODEL, text_col: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (array of int) and ``decoded`` (the text the ids give back) added.

    ``name`` is a model that every executor has installed.  A null text counts
    as empty and has no ids.  The space mark ``▁`` inside a text is a space to
    the model and comes back as one; any other text comes back unchanged.
    Repeated rows each get their row; a column that is named like a new one is
    replaced.
    """
    prepare(docs.sparkSession)
    keep = [c for c in docs.columns if c not in ("ids", "decoded")]
    src = docs.select(*[F.col(f"`{c}`") for c in keep])
    at = keep.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        c = codec(public_tokenizers.path(name))
        for whole in batches:
            for b in text_blocks(whole, text_col):
                ids, bounds = c.encode([t or "" for t in b.column(at).to_pylist()])
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, lists, pa.array(c.decode(ids, bounds), pa.string())], [*keep, "ids", "decoded"]
                )

    from pyspark.sql import types as T

    schema = T.StructType([*src.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])
    return src.mapInArrow(run, schema)


def query(docs: DataFrame) -> DataFrame:
    """Counts and digests of the ids and of the text they decode to, per document."""
    out = encoded(docs.select("doc_id", text_or_empty().alias("text")))
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == F.col("text")).alias("round_trip"),
    )
