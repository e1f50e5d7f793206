"""Compression classifier: which of two zstandard dictionaries fits a text better.

One dictionary is built from text labelled good, one from text labelled bad.
A text is compressed block by block with both; the difference of the two
compressed sizes, normalised by the text's size, is calibrated to a score by a
logistic curve on labelled texts that the dictionaries have not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard as zs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlens.llm.common import prepare, text_or_empty

BLOCK = 1024
DICT_BYTES = 65_536
LEVEL = 3
# Bounds of the labelled sample that the classifier is fitted on: rows of each
# class for the dictionaries, as many again for the calibration, and the length
# of a text that is taken into the sample.
SAMPLE_ROWS = 1500
SAMPLE_BYTES = 65_536
# Blocks of the sample that a dictionary is trained on at most, spread evenly over its texts.
DICT_BLOCKS = 6000
# A short text is taken as if this many bytes of typically good text stood before it.
PRIOR_BYTES = 128
PRIOR_DIFFERENCE = 0.05


@dataclass(frozen=True)
class Model:
    """Dictionary contents of the two classes, and the logistic curve: slope, offset."""

    good: bytes
    bad: bytes
    slope: float
    offset: float


def _blocks(data: bytes) -> list[bytes]:
    return [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]


def _dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary, or the plain text where there is too little to train on."""
    blocks = [b for t in texts for b in _blocks(t)]
    n = min(len(blocks), DICT_BLOCKS)
    samples = [blocks[i * len(blocks) // n] for i in range(n)]  # evenly over all texts
    try:
        return zs.train_dictionary(DICT_BYTES, samples).as_bytes()
    except (zs.ZstdError, ValueError):
        return b"".join(samples)[:DICT_BYTES]


def _compressor(content: bytes) -> zs.ZstdCompressor:
    options = {"level": LEVEL, "write_checksum": False, "write_content_size": False, "write_dict_id": False}
    if not content:
        return zs.ZstdCompressor(**options)
    d = zs.ZstdCompressionDict(content)
    d.precompute_compress(level=LEVEL)
    return zs.ZstdCompressor(dict_data=d, **options)


class Scorer:
    def __init__(self, model: Model) -> None:
        self.model, self.good, self.bad = model, _compressor(model.good), _compressor(model.bad)

    def difference(self, text: str) -> float:
        """(size by the bad dictionary - size by the good one) / size, shrunk for short texts."""
        data = text.encode("utf-8")
        more = 0
        for b in _blocks(data):
            more += len(self.bad.compress(b)) - len(self.good.compress(b))
        return (more + PRIOR_DIFFERENCE * PRIOR_BYTES) / (len(data) + PRIOR_BYTES)

    def score(self, text: str) -> float:
        z = self.model.slope * self.difference(text) + self.model.offset
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton's method, lightly regularised; constant labels give a flat curve."""
    scale = float(x.std()) or 1.0
    a = np.stack([x / scale, np.ones_like(x)], 1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (p - y) + 1e-2 * w
        hess = (a * (p * (1 - p))[:, None]).T @ a + 1e-2 * np.eye(2)
        w = w - np.linalg.solve(hess, grad)
    return float(w[0] / scale), float(w[1])


def fit(rows: list[tuple[str, int]]) -> Model:
    """``rows``: (text, label) in an order that does not depend on the label; even ones make the dictionaries."""
    of = {q: [t.encode("utf-8") for t, label in rows if label == q] for q in (0, 1)}
    good, bad = (_dictionary(of[q][::2]) for q in (1, 0))
    raw = Scorer(Model(good, bad, 0.0, 0.0))
    pairs = [(raw.difference(t.decode("utf-8")), q) for q in (0, 1) for t in of[q][1::2]]
    if not pairs:
        return Model(good, bad, 0.0, 0.0)
    x, y = np.array(pairs, float).T
    # values beyond a few block lengths of either class's bulk say no more: keep them from bending the curve
    x = np.clip(x, -PRIOR_DIFFERENCE, 2 * PRIOR_DIFFERENCE)
    return Model(good, bad, *_logistic(x, y))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels are never learned from: CRC-32 of the id's text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> list[tuple[str, int]]:
    """A bounded sample of each class outside the held-out rows, in the order of a hash of the id."""
    key = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_q")).where(~held_out("_id"))
    src = docs.select(F.col(id_col).alias("_id"), text_or_empty().alias("_text")).where(F.octet_length("_text") <= SAMPLE_BYTES)
    out: list[tuple] = []
    for q in (0, 1):
        order = F.xxhash64("_id", F.lit(17))
        # ids first: the texts are read for the chosen rows only
        ids = key.where(F.col("_q") == q).join(src.select("_id"), "_id", "left_semi").select("_id", order.alias("_h")).distinct()
        ids = ids.orderBy("_h", "_id").limit(2 * SAMPLE_ROWS)
        chosen = src.join(F.broadcast(ids), "_id").select("_h", "_id", "_text").distinct()
        out += [(r["_h"], str(r["_id"]), r["_text"], q) for r in chosen.collect()]
    return [(t, q) for _, _, t, q in sorted(out)]


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score, sha)`` per row.

    A null text counts as empty; the score of the empty text is that of the
    prior alone.  Repeated rows get equal scores.  Other columns are not read.
    """
    spark = docs.sparkSession
    prepare(spark)
    src = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text")).withColumn("sha", F.sha2("text", 256))
    id_type = src.schema["doc_id"].dataType.simpleString()
    shared = spark.sparkContext.broadcast(model)  # two dictionaries of DICT_BYTES at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for b in batches:
            s = pa.array([scorer.score(t.as_py()) for t in b.column(1)], pa.float64())
            yield pa.RecordBatch.from_arrays([b.column(0), s, b.column(2)], ["doc_id", "score", "sha"])

    return src.mapInArrow(run, f"doc_id {id_type}, score double, sha string")


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit(labelled_sample(docs, labels))
    s = score(docs, model)
    return s.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, each as often as it occurs."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(fit(labelled_sample(docs, labels)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for b in batches:
            texts = b.column(b.schema.get_field_index("text"))
            yield b.filter(pa.array([scorer.score(t.as_py() or "") >= 0.5 for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
