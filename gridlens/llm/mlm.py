"""Masked pseudo-likelihood: a bidirectional window network scores every word from both its sides.

The network sums position-wise embeddings of the words around a masked one, and
predicts it by the yes-or-no choices on its way down a Huffman tree of all words
(frequent words have short ways, and the words' probabilities sum to one).  The
vocabulary are the words over a count threshold in the
whole corpus; rarer words fall into buckets by their ending, and a word's share
of its bucket is its part of the bucket's occurrences, joined from the table of
all words.  Texts are turned into word numbers once.  A bounded sample starts
the network; then the texts are dealt by a hash of themselves and their id to
groups of about ``GROUP_WORDS`` words, every group trains a copy on all of its
texts in the order of the hash, and the copies are averaged, part by part: how
rows lie in files and partitions does not show.  A document's score is the sum
of its words' conditional log-probabilities.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.llm.common import prepare, shuffle_width, stored, text_blocks, text_or_empty

# Words with a place of their own: seen so often, and one in so many of the corpus (so many words at most).
LEAST, ONE_IN = 5, 65_000  # a number fits 16 bits
BUCKETS = 256  # of all other words; the number 0 stands for what lies outside the text
UNIT = 2.0**30  # logarithms are summed in whole parts of this, alike in any order
WIDTH = 16
OFFSETS = (-2, -1, 1, 2)
STEP_WORDS = 16_384
# Pulls that are summed at a time: few enough to stay in a core's cache.
PULLS = 4096
# Words that a trained copy sees, about.
GROUP_WORDS = 4_000_000
RATE = 0.08
# Bound of the sample that starts the network: texts, and bytes in a text.
SAMPLE_ROWS, SAMPLE_BYTES, SAMPLE_ROUNDS = 300, 16_384, 3
# Parts of so many numbers of so many trained copies are averaged at a time.
FAN_IN, CHUNK = 32, 65_536
# Bytes of words that a task holds before it counts them; endings that it remembers.
HELD, ENDINGS = 36_000_000, 100_000


def split(text: str) -> list[str]:
    return text.lower().split()


def bucket(word: str) -> int:
    return crc32(word[-3:].encode("utf-8")) % BUCKETS


class Ids(dict):
    """Word -> number for the vocabulary; the other words' numbers go by their ending."""

    def __init__(self, words: list[str]) -> None:
        super().__init__((w, i) for i, w in enumerate(words, 1))
        self.endings: dict[str, int] = {}

    def of(self, words: list[str]) -> tuple[np.ndarray, list[str]]:
        """The words' numbers, and the words out of the vocabulary, in their order."""
        out = np.fromiter(map(self.get, words, repeat(0)), np.uint16, len(words))
        at = np.flatnonzero(out == 0)
        others = [words[i] for i in at.tolist()]
        ends = [w[-3:] for w in others]
        if len(self.endings) > ENDINGS:
            self.endings.clear()
        self.endings.update((e, 1 + len(self) + bucket(e)) for e in set(ends).difference(self.endings))
        out[at] = [self.endings[e] for e in ends]
        return out, others


class Code:
    """A Huffman tree: of word ``i`` the choices ``start[i]`` to ``start[i + 1]``, each a node and a sign."""

    def __init__(self, weights: Sequence[int]) -> None:
        n = len(weights)
        heap = [(int(w), i) for i, w in enumerate(weights)]
        heapq.heapify(heap)
        up, sign = [0] * (2 * n - 1), [1] * (2 * n - 1)
        for new in range(n, 2 * n - 1):
            (a, i), (b, j) = heapq.heappop(heap), heapq.heappop(heap)
            up[i], up[j], sign[j] = new, new, -1
            heapq.heappush(heap, (a + b, new))
        start, node, signs = [0], [], []
        for i in range(n):
            while i != 2 * n - 2:
                node.append(up[i] - n)
                signs.append(sign[i])
                i = up[i]
            start.append(len(node))
        self.start, self.node, self.sign = np.array(start), np.array(node, np.int32), np.array(signs, np.float32)


@dataclass(frozen=True)
class Vocabulary:
    words: list[str]
    share: np.ndarray  # minus the log of the occurrences in a word's bucket, by number; 0 for frequent words
    code: Code = field(compare=False)

    @property
    def size(self) -> int:
        return 1 + len(self.words) + BUCKETS


def word_counts(src: DataFrame) -> DataFrame:
    """``(word, n)`` over all texts of ``src`` (``text``), counted within each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(held: list[pa.Array]) -> pa.RecordBatch:
            c = pa.chunked_array(held, pa.string()).value_counts()
            return pa.RecordBatch.from_arrays([c.field("values"), c.field("counts")], ["word", "n"])

        held, size = [], 0
        for b in batches:
            for t in b.column(0):
                held.append(pa.array(split(t.as_py()), pa.string()))
                size += held[-1].nbytes
                if size > HELD:
                    yield counted(held)
                    held, size = [], 0
        yield counted(held)

    return src.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame) -> Vocabulary:
    """The words over the threshold, the most frequent first, and how often each bucket's other words occur."""
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    often = (F.col("n") >= LEAST) & (F.col("n") * ONE_IN >= total)
    known = counts.where(often).orderBy(F.desc("n"), "word").collect()  # ONE_IN rows at most
    words = [r["word"] for r in known]
    weights = [0, *(r["n"] for r in known), *[0] * BUCKETS]
    ending = F.crc32(F.expr("right(word, 3)").cast("binary"))
    rest = counts.where(~often).groupBy((ending % BUCKETS).cast("int").alias("b")).agg(F.sum("n").alias("n"))
    share = np.zeros(1 + len(words) + BUCKETS)
    for r in rest.collect():  # BUCKETS rows at most
        share[1 + len(words) + r["b"]] = -np.log(r["n"])
        weights[1 + len(words) + r["b"]] = r["n"]
    return Vocabulary(words, share, Code(weights))


class Network:
    """Parameters in one flat array: ``E`` (offset, word, width) and ``U`` (tree node, width and bias)."""

    def __init__(self, code: Code, flat: np.ndarray | None = None) -> None:
        self.code, self.size = code, len(code.start) - 1
        self.steps = np.diff(code.start).astype(np.uint16)
        self.shapes = {"E": (len(OFFSETS), self.size, WIDTH), "U": (self.size - 1, WIDTH + 1)}
        self.length = sum(int(np.prod(s)) for s in self.shapes.values())
        if flat is None:
            flat = np.random.default_rng(11).normal(0, 0.1, self.length).astype(np.float32)
        self.flat = flat
        self.parts, self.grown = self._views(flat), self._views(np.full(self.length, 1e-6, np.float32))

    def _views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        e, u = (int(np.prod(s)) for s in self.shapes.values())
        return {"E": flat[:e].reshape(self.shapes["E"]), "U": flat[e : e + u].reshape(self.shapes["U"])}

    def pass_(self, around: np.ndarray, target: np.ndarray, learn: bool) -> np.ndarray:
        """Log-probability of each target; with ``learn``, one step of gradient descent as well."""
        code, n = self.code, len(target)
        steps = np.take(self.steps, target)
        order = np.argsort(steps, kind="stable")  # words with equally long ways together
        first, steps = np.take(code.start, np.take(target, order)), np.take(steps, order)
        around = [np.take(around[:, o], order) for o in range(len(OFFSETS))]
        h = np.empty((n, WIDTH + 1), np.float32)
        h[:, WIDTH] = 1
        np.tanh(sum(np.take(self.parts["E"][o], a, axis=0) for o, a in enumerate(around)), out=h[:, :WIDTH])
        logs, back = np.empty(n, np.float32), np.empty((n, WIDTH), np.float32)
        nodes, pulls, rows = [], [], []
        cuts = np.flatnonzero(np.append(True, steps[1:] != steps[:-1])) if n else []
        for i, j in zip(cuts, [*cuts[1:], n], strict=True):
            at = first[i:j, None] + np.arange(steps[i])
            node, sign, x = np.take(code.node, at), np.take(code.sign, at), h[i:j]
            u = np.take(self.parts["U"], node, axis=0)
            p = np.einsum("mld,md->ml", u, x)
            p *= -sign
            np.clip(p, -60, 60, out=p)
            np.exp(p, out=p)
            p += 1
            logs[i:j] = -np.log(p).sum(1)
            if learn:
                pull = sign * (1 / p - 1)
                back[i:j] = np.einsum("ml,mld->md", pull, u[:, :, :WIDTH])
                nodes.append(node.ravel())
                pulls.append(pull.ravel())
                rows.append(np.repeat(np.arange(i, j, dtype=np.int32), steps[i]))
        if learn and n:
            self._descend("U", np.s_[:], np.concatenate(nodes), h, n, np.concatenate(rows), np.concatenate(pulls))
            back *= 1 - h[:, :WIDTH] ** 2
            for o, a in enumerate(around):
                self._descend("E", o, a, back, n)
        out = np.empty_like(logs)
        out[order] = logs
        return out

    def _descend(self, name: str, part, row: np.ndarray, pull: np.ndarray, n: int, of: np.ndarray | None = None, by: np.ndarray | None = None) -> None:
        """One step on the rows of a table that have a pull; repeated rows are summed.

        With ``of`` and ``by``, the pulls are the rows ``of`` of ``pull``, each ``by`` times.
        """
        row = row.astype(np.uint16)
        order = np.argsort(row, kind="stable")
        row = np.take(row, order)
        first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        at, ends = row[first], np.append(first[1:], len(row))
        g = np.empty((len(at), pull.shape[1]), np.float32)
        i = 0
        while i < len(at):
            j = max(i + 1, int(np.searchsorted(ends, first[i] + PULLS, "right")))
            some = order[first[i] : ends[j - 1]]
            x = np.take(pull, some if of is None else np.take(of, some), axis=0)
            if by is not None:
                x *= np.take(by, some)[:, None]
            np.add.reduceat(x, first[i:j] - first[i], axis=0, out=g[i:j])
            i = j
        g /= np.float32(n)
        table, grown = self.parts[name][part], self.grown[name][part]
        more = np.take(grown, at, axis=0) + g * g
        grown[at] = more
        g *= np.float32(RATE)
        g /= np.sqrt(more, out=more)
        table[at] = np.take(table, at, axis=0) - g


def numbers_of(ids: Ids, text: str) -> np.ndarray:
    return ids.of(split(text))[0]


def windows(numbers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words around, word, words per text) of all texts' word numbers; texts do not see each other."""
    gap = np.zeros(max(OFFSETS), np.uint16)
    x = np.concatenate([gap, *(part for own in numbers for part in (own, gap))])
    at = np.flatnonzero(x)
    around = np.empty((len(at), len(OFFSETS)), np.uint16, "F")
    for k, o in enumerate(OFFSETS):
        np.take(x, at + o, out=around[:, k], mode="clip")
    return around, np.take(x, at), np.array([len(own) for own in numbers], np.int64)


def _steps(around: np.ndarray, target: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for i in range(0, len(target), STEP_WORDS):
        yield around[i : i + STEP_WORDS], target[i : i + STEP_WORDS]


def started(src: DataFrame, vocab: Vocabulary) -> np.ndarray:
    """The network after a few rounds over a bounded sample of texts, in the order of a hash."""
    rows = src.where(F.octet_length("text").between(1, SAMPLE_BYTES)).select(F.xxhash64("text").alias("h"), "text")
    # the least hashes first: only the chosen texts come to the driver, not some of every task
    least = [r["h"] for r in rows.select("h").distinct().orderBy("h").limit(SAMPLE_ROWS).collect()]
    chosen = rows.where(F.col("h") <= F.lit(least[-1])).dropDuplicates(["h"]).collect() if least else []
    texts = [r["text"] for r in sorted(chosen, key=lambda r: r["h"])]
    net = Network(vocab.code)
    ids = Ids(vocab.words)
    around, target, _ = windows([numbers_of(ids, t) for t in texts])
    for _ in range(SAMPLE_ROUNDS):
        for a, t in _steps(around, target):
            net.pass_(a, t, True)
    return net.flat


def encoded(src: DataFrame, vocab: Vocabulary) -> DataFrame:
    """``(rid, doc_id, key, n_words, ids, words, times)``: the word numbers of every row as bytes, and its rarer words.

    ``key`` hashes the id and the text; rows alike in both have the same.
    """
    known = src.sparkSession.sparkContext.broadcast(vocab)  # of bounded size
    id_type = src.schema["doc_id"].dataType.simpleString()
    schema = f"rid long, doc_id {id_type}, key long, n_words long, ids binary, words array<string>, times array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = known.value
        ids = Ids(vocab.words)
        rid = TaskContext.get().partitionId() << 40  # numbers the rows
        for whole in batches:
            for b in text_blocks(whole, "text"):
                numbers, others = zip(*(ids.of(split(t.as_py())) for t in b.column(2)))
                rare = [Counter(words) for words in others]
                at = pa.array(np.cumsum([0, *map(len, rare)]), pa.int32())
                words = pa.ListArray.from_arrays(at, pa.array([w for c in rare for w in c], pa.string()))
                times = pa.ListArray.from_arrays(at, pa.array([n for c in rare for n in c.values()], pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(rid, rid + len(numbers)), pa.int64()), b.column(0), b.column(1), pa.array([len(x) for x in numbers], pa.int64()),
                     pa.array([x.tobytes() for x in numbers], pa.binary()), words, times],
                    ["rid", "doc_id", "key", "n_words", "ids", "words", "times"])
                rid += len(numbers)

    return src.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), "text").mapInArrow(run, schema)


def _averaged(copies: DataFrame, groups: int) -> DataFrame:
    """The mean of the copies' parts ``(g, chunk, n, part)``, weighted by ``n``, a few copies of a part at a time."""

    def mean(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["g"].to_pylist(), table["n"].to_pylist(), table["part"].to_pylist(), strict=True))
        n = sum(k for _, k, _ in rows)
        total = sum(np.frombuffer(x, np.float32).astype(np.float64) * (k / n) for _, k, x in rows)
        return pa.table({"g": [rows[0][0] // FAN_IN], "chunk": table["chunk"][:1], "n": [n], "part": pa.array([total.astype(np.float32).tobytes()], pa.binary())})

    while groups > 1:
        groups = -(-groups // FAN_IN)
        up = F.floor(F.col("g") / FAN_IN)
        copies = stored(copies.groupBy("chunk", up.alias("up")).applyInArrow(mean, "g long, chunk long, n long, part binary"), "copies")
    return copies


def trained(rows: DataFrame, total: int, vocab: Vocabulary, start: np.ndarray) -> np.ndarray:
    """The mean of the copies that all groups of texts train, weighted by their words."""
    spark = rows.sparkSession
    first = spark.sparkContext.broadcast((vocab.code, start))  # of bounded size
    groups = max(1, -(-total // GROUP_WORDS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def copy(g: int, net: Network, seen: int):
            parts = [net.flat[i : i + CHUNK].tobytes() for i in range(0, net.length, CHUNK)]
            return pa.RecordBatch.from_arrays(
                [pa.array([g] * len(parts), pa.int64()), pa.array(range(len(parts)), pa.int64()), pa.array([seen] * len(parts), pa.int64()), pa.array(parts, pa.binary())],
                ["g", "chunk", "n", "part"])

        at, net, seen, held, words = None, None, 0, [], 0

        def learn():
            around, target, _ = windows(held)
            for a, t in _steps(around, target):
                net.pass_(a, t, True)

        for b in batches:
            for g, raw in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if g != at:
                    if net is not None:
                        learn()
                        yield copy(at, net, seen)
                    at, net, seen, held, words = g, Network(first.value[0], first.value[1].copy()), 0, [], 0
                own = np.frombuffer(raw.as_py(), np.uint16)
                held.append(own)
                words, seen = words + len(own), seen + len(own)
                if words >= 16 * STEP_WORDS:
                    learn()
                    held, words = [], 0
        if net is not None:
            learn()
            yield copy(at, net, seen)

    dealt = rows.where("n_words > 0").select(F.pmod(F.xxhash64("key"), F.lit(groups)).alias("g"), "key", "ids")
    dealt = dealt.repartition(min(groups, shuffle_width(spark)), "g").sortWithinPartitions("g", "key").select("g", "ids")
    copies = stored(dealt.mapInArrow(run, "g long, chunk long, n long, part binary"), "copies")
    parts = {r["chunk"]: r["part"] for r in _averaged(copies, groups).select("chunk", "part").collect()}  # one network
    return np.frombuffer(b"".join(parts[i] for i in sorted(parts)), np.float32).copy() if parts else start


def pseudo_likelihood(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, log_prob)`` per row: the summed conditional log-probabilities of its words.

    Words are split at white space, in lower case.  A null text counts as empty;
    a text without words has the log-probability 0.  Repeated rows get equal
    scores; other columns are not read.  The scores do not depend on how the
    rows are dealt to files and partitions (up to rounding in the last digits).
    """
    spark = docs.sparkSession
    prepare(spark)
    src = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    counts = stored(word_counts(src), "words")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    vocab = vocabulary(counts)
    rows = stored(encoded(src, vocab), "encoded")
    flat = trained(rows, total, vocab, started(src.select("text"), vocab))
    model = spark.sparkContext.broadcast((vocab.code, vocab.share, flat))  # of bounded size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, share, flat = model.value
        net = Network(code, flat)
        for b in batches:
            held, words, scores = [], 0, []

            def scored():
                around, target, counts = windows(held)
                logs = [net.pass_(a, t, False) + share[t] for a, t in _steps(around, target)]
                logs = np.concatenate([*logs, [0.0]])
                ends = np.cumsum(counts)
                return np.where(counts > 0, np.add.reduceat(logs, ends - counts), 0.0)

            for raw in b.column(1):
                held.append(np.frombuffer(raw.as_py(), np.uint16))
                words += len(held[-1])
                if words >= 16 * STEP_WORDS:
                    scores.append(scored())
                    held, words = [], 0
            if held:
                scores.append(scored())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.concatenate([np.empty(0), *scores]))], ["_rid", "log_prob"])

    # the rarer words' own counts; a word seen once has the log 0
    rare = rows.select("rid", F.explode(F.arrays_zip("words", "times")).alias("w")).select("rid", "w.words", "w.times")
    again = counts.where("n > 1").select("word", F.round(F.log("n") * UNIT).cast("long").alias("log_n"))
    shares = rare.join(again, F.col("words") == F.col("word")).groupBy(F.col("rid").alias("_rid")).agg(F.sum(F.col("times") * F.col("log_n")).alias("s"))
    scored = rows.select("rid", "ids").mapInArrow(run, "_rid long, log_prob double")
    whole = F.sum("log_prob") + F.coalesce(F.sum("s"), F.lit(0)) / F.lit(UNIT)
    none = F.lit(None)
    parts = scored.select("_rid", "log_prob", none.cast("long").alias("s")).unionByName(shares.select("_rid", none.cast("double").alias("log_prob"), "s"))
    each = parts.groupBy("_rid").agg(whole.alias("log_prob"))
    return rows.select("rid", "doc_id", "n_words").join(each, F.col("rid") == F.col("_rid")).select("doc_id", "n_words", "log_prob")


def query(docs: DataFrame) -> DataFrame:
    per_word = F.when(F.col("n_words") > 0, F.col("log_prob") / F.col("n_words"))
    return pseudo_likelihood(docs).withColumn("log_prob_per_word", per_word)
