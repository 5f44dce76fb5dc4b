"""Helpers shared by the training-data operators: stored steps, samples, table access."""

from __future__ import annotations

import ctypes
import io
import zipfile
from collections.abc import Callable, Iterator
from functools import reduce
from pathlib import Path
from uuid import uuid4

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir, shuffles_dropped

# Text handed to one vectorised step at a time, in bytes; a longer text goes alone.
BLOCK_BYTES = 1_000_000
# Rows per Arrow batch where the session leaves Spark's default, which is meant for
# narrow rows: ten thousand texts at a time would fill a Python worker.
TEXTS_PER_BATCH = 500
_ARROW_ROWS, _ARROW_DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


_shipped: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Make a session ready for the Python steps of this folder: batches of texts that
    fit a worker, and this package on the executors, as with ``--py-files``."""
    if spark.conf.get(_ARROW_ROWS) == _ARROW_DEFAULT:
        spark.conf.set(_ARROW_ROWS, str(TEXTS_PER_BATCH))
    package = Path(__file__).parents[1]
    application = spark.sparkContext.applicationId
    if application not in _shipped and package.is_dir():
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w") as target:
            for file in sorted(package.rglob("*.py")):
                target.write(file, file.relative_to(package.parent))
        path = spark._jvm.org.apache.hadoop.fs.Path(
            shared_dir(spark, "code", uuid4().hex, f"{package.name}.zip")
        )
        stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True)
        stream.write(bytearray(packed.getvalue()))
        stream.close()
        spark.sparkContext.addPyFile(path.toString())
        _shipped.add(application)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared work folder and read again.

    Later steps start from the files, so that a lost executor costs one step and
    nothing is computed twice. The shuffle files of the step go when it is stored.
    """
    path = shared_dir(df.sparkSession, "llm", f"{name}-{uuid4().hex}")
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release() -> None:
    """Give memory that is free in this Python worker back to the system.

    Workers outlive their tasks and serve one stage after another; without this each
    would keep the most that any stage needed.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def texts_of(batch: pa.RecordBatch, column: str = "text", lower: bool = False) -> list[bytes]:
    """UTF-8 bytes of a text column; NULL is the empty text."""
    values = pc.fill_null(batch.column(column), "")
    if lower:
        values = pc.utf8_lower(values)
    return values.cast(pa.binary()).to_pylist()


def blocks(texts: list[bytes], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive texts of about ``limit`` bytes together."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


def by_block(
    df: DataFrame,
    work: Callable[[list[bytes]], dict[str, object]],
    schema: str,
    lower: bool = False,
) -> DataFrame:
    """``doc_id`` and the columns that ``work`` returns for a list of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch, lower=lower)
            for start, end in blocks(texts):
                found = work(texts[start:end])
                ids = batch.column("doc_id").slice(start, end - start)
                yield pa.RecordBatch.from_arrays(
                    [ids, *(pa.array(v) for v in found.values())], names=["doc_id", *found]
                )

    prepare(df.sparkSession)
    id_type = df.schema["doc_id"].dataType.simpleString()
    return df.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, {schema}")


def is_held_out(parts: int, part: int) -> Column:
    """Whether crc32 of the document's id, as text, leaves ``part``."""
    text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.crc32(F.encode(text, "UTF-8")) % parts == part


def stratified_ids(rows: DataFrame, label: str, per_class: int) -> DataFrame:
    """(doc_id, label) of about ``per_class`` rows of each label, by a hash of the id.

    The size is bounded by the number of labels, not by the input: each label keeps
    the share of the hash range that holds ``per_class`` of its rows. Contradictory
    and NULL labels are left out.
    """
    clean = (
        rows.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy("doc_id")
        .agg(F.min(label).alias("label"), F.max(label).alias("_other"))
        .filter("label = _other")
        .select("doc_id", "label")
    )
    shares = {r[0]: per_class / r[1] for r in clean.groupBy("label").count().collect()}
    place = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30))
    keep = [
        (F.col("label") == value) & (place < int(min(share, 1.0) * (1 << 30)))
        for value, share in shares.items()
    ]
    return clean.filter(reduce(Column.__or__, keep, F.lit(False)))


def sampled_texts(docs: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """(doc_id, text, label) of the documents of a bounded set of ids, stored.

    The ids are a bounded sample, so they are broadcast and the texts stay in place.
    """
    prepare(docs.sparkSession)
    texts = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    return stored(texts.repartition(24), name)
