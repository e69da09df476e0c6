"""Shared pieces: words, Arrow batches, bounded labelled samples."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# A word is a run of anything but ASCII white space. On UTF-8 bytes,
# bytes.split() cuts at exactly these characters.
WORD = r"[^\x20\x09-\x0D]+"
BATCH_BYTES = 4 << 20  # of an Arrow batch, at a time

_sent: set[str] = set()


def send_package(spark: SparkSession) -> None:
    """Sends this package's code to the executors, once per application.

    Python functions travel by name, so workers must be able to import them; they need not
    have the package installed, nor the driver's working folder.
    """
    sc = spark.sparkContext
    if sc.applicationId in _sent:
        return
    package = Path(__file__).resolve().parent.parent
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="code-")), f"{package.name}.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(archive)
    _sent.add(sc.applicationId)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The column's texts, null as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def bytes_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The column's texts as UTF-8, null as empty."""
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of equal numbers of rows, of about BATCH_BYTES each, one row at least."""
    parts = max(1, -(-batch.nbytes // BATCH_BYTES))
    step = max(1, -(-batch.num_rows // parts))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def map_batches(
    df: DataFrame, schema: str | T.StructType, run: Callable[[pa.RecordBatch], dict[str, object]]
) -> DataFrame:
    """One output column set per Arrow batch; `run` returns columns by name.

    Batches without rows are skipped, so `run` never sees one. A batch of many bytes is passed on
    in slices of some BATCH_BYTES, which bounds the Python objects that `run` holds; no row is cut.
    """
    send_package(df.sparkSession)
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(schema)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in it for part in slices(whole)):
            if batch.num_rows:
                out = run(batch)
                yield pa.RecordBatch.from_arrays(
                    [
                        c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type)
                        for f, c in ((f, out[f.name]) for f in arrow)
                    ],
                    schema=arrow,
                )
        batch = out = None
        pa.default_memory_pool().release_unused()  # workers live on and would keep a task's peak

    return df.mapInArrow(batches, schema)


def bounded_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """At most `rows` rows, the same ones in every run: those with the smallest hash of the key.

    For fitting a model only. Hashes above a cut that about twice as many rows pass are
    left out first, so the ordering sees few rows however large the table. Pass narrow rows
    and join the rest to the keys. Runs a count.
    """
    n, order = df.count(), F.xxhash64(key)
    if n > 2 * rows:
        df = df.filter(order < int(2 * rows / n * 2**64) - 2**63)
    return df.orderBy(order, key).limit(rows)


def crc32_mod(column: str, n: int):
    """crc32 of the column as text, modulo n; a missing key counts as empty text."""
    return F.crc32(F.encode(F.coalesce(F.col(column).cast("string"), F.lit("")), "UTF-8")) % n


def fresh(name: str, columns: list[str]) -> str:
    """A column name that none of `columns` has, in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def by_size(texts: list, limit: int = 2 << 20) -> Iterator[slice]:
    """Consecutive slices of a batch of about `limit` characters, one text at least.

    Bounds what a task holds beside the batch; no text is cut.
    """
    start, held = 0, 0
    for i, t in enumerate(texts):
        if i > start and held + len(t) > limit:
            yield slice(start, i)
            start, held = i, 0
        held += len(t)
    if texts:
        yield slice(start, len(texts))
