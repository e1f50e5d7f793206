"""What the training-data operators share: inputs, stored intermediate tables, batches, row selection."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlens.session import scratch_path

# Rows per Arrow batch handed to Python: whole documents are long, and one
# batch must fit a worker beside its working arrays.
BATCH_ROWS = 256
# Texts are worked on in pieces of about this many characters at a time.
BATCH_CHARS = 4_000_000
# Applications whose executors have this package.
_SHIPPED: set[str] = set()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def prepare(spark: SparkSession) -> None:
    """Before Python runs in tasks: ship this package to the executors, hand rows over in small Arrow batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        root = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="gridlens-ship-")) / "gridlens-package.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(archive))
        _SHIPPED.add(app)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared scratch folder and read it back.

    Cuts the lineage with files every executor can read, so later passes do not
    repeat the work and survive the loss of the executors that did it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, row_bytes: int, most: int = 32 << 20) -> DataFrame:
    """A stored table, marked for broadcast if its counted rows are proven to fit ``most`` bytes.

    A larger one is joined by a shuffle like any other.
    """
    return F.broadcast(df) if df.count() * row_bytes <= most else df


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of Arrow batches, one after the other, across batch borders."""
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns), strict=True)


def text_blocks(batch: pa.RecordBatch, col: str, chars: int = BATCH_CHARS) -> Iterator[pa.RecordBatch]:
    """Split a batch so that each part holds about ``chars`` characters (one row at least)."""
    import pyarrow.compute as pc

    size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(col))), 0).to_pylist()
    start = total = 0
    for i, n in enumerate(size):
        if total and total + n > chars:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < len(size):
        yield batch.slice(start)


def keep_rows(docs: DataFrame, keys: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose (id, text digest) is in ``keys`` (``_id``, ``_sha``), one of each.

    Nulls compare as equal.  Only rows whose key occurs more than once are
    shuffled with their text, to drop the repeats.
    """
    cols = docs.columns
    names = [f"_c{i}" for i in range(len(cols))]
    marked = docs.toDF(*names)
    id_c, text_c = names[cols.index(id_col)], names[cols.index(text_col)]
    marked = marked.withColumns({"_id": F.col(id_c), "_sha": F.sha2(text_or_empty(text_c), 256)})
    # a text may be null in one row and empty in another: both are the empty text
    times = marked.select("_id", "_sha").groupBy("_id", "_sha").count().withColumnRenamed("count", "_n")
    k = (
        keys.select(F.col("_id").alias("_kid"), F.col("_sha").alias("_ksha"))
        .distinct()
        .join(times, F.col("_kid").eqNullSafe(F.col("_id")) & (F.col("_ksha") == F.col("_sha")))
        .select("_kid", "_ksha", "_n")
        .hint("shuffle_hash")  # the rows are dealt out alike at any size
    )
    hit = marked.join(k, F.col("_kid").eqNullSafe(F.col("_id")) & (F.col("_ksha") == F.col("_sha")))
    once = hit.where("_n = 1").select(*names)
    again = hit.where("_n > 1").dropDuplicates(["_kid", "_ksha"]).select(*names)
    return once.unionByName(again).toDF(*cols)
