"""What the operators on text share: shared-folder tables, Arrow functions over a text column, splits by document id."""

from __future__ import annotations

import ctypes
import gc
import os
import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts that are handled at a time inside an Arrow batch.
SLICE = 256
_SHIPPED: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; only a session without one (tests, local mode) gets its own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="cif_lake_checkpoint_"))
    return context.getCheckpointDir()


def checkpointed(frame: DataFrame) -> DataFrame:
    """The frame, written once to the shared folder: later steps see the same rows even when executors are lost."""
    shared_folder(frame.sparkSession)
    return frame.checkpoint()


def written(frame: DataFrame, name: str) -> DataFrame:
    """As ``checkpointed``, but as a Parquet table: compressed and with pruning of columns, for frames that carry texts."""
    path = f"{shared_folder(frame.sparkSession).rstrip('/')}/{name}-{os.urandom(6).hex()}"
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % n


def aside(documents: DataFrame, *internal: str) -> tuple[DataFrame, Callable[[str], str], Callable[[DataFrame], DataFrame]]:
    """The documents with columns out of the way whose names a step uses itself; the new name of a column; and the way back."""
    used = {n.lower() for n in internal}
    moved = {c: f"_kept{k}_{c}" for k, c in enumerate(documents.columns) if c.lower() in used}
    back = {new: old for old, new in moved.items()}
    return documents.withColumnsRenamed(moved), lambda name: moved.get(name, name), lambda frame: frame.withColumnsRenamed(back)


def batches(texts: pa.Array) -> Iterator[list[bytes | None]]:
    """UTF-8 bytes of the texts, a bounded number of them at a time."""
    raw = texts.cast(pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()) if not pa.types.is_binary(texts.type) else texts
    for start in range(0, len(raw), SLICE):
        yield raw.slice(start, SLICE).to_pylist()


def ship() -> None:
    """Give the executors' Python this package, where their PYTHONPATH does not have it already."""
    context = SparkSession.active().sparkContext
    package = Path(__file__).resolve().parents[1]
    known = [os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if str(package.parent) not in known and context.applicationId not in _SHIPPED:
        _SHIPPED.add(context.applicationId)
        base = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="cif_lake_code_")), package.name)
        context.addPyFile(shutil.make_archive(base, "zip", package.parent, package.name))


def arrow_function(run: Callable, schema: str) -> Callable[..., Column]:
    """An Arrow function of columns whose code the executors can import."""
    ship()
    return F.arrow_udf(run, schema)


def arrow_type(schema: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import DataType

    return to_arrow_type(DataType.fromDDL(schema))


def release() -> None:
    """At the end of a task: give memory back to the system, as the Python worker lives on for other tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def text_function(make: Callable[[], Callable[[list[bytes | None]], list]], schema: str) -> Callable[[str | Column], Column]:
    """A column function over texts. ``make`` is called once per task and gives a function from a list of UTF-8 texts to results.

    The results follow ``schema``; only the text goes to Python, the other columns of a row stay in the JVM.
    """
    to = arrow_type(schema)

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        function = make()
        for texts in columns:
            yield pa.concat_arrays([pa.array([], to), *(pa.array(function(part), to) for part in batches(texts))])
        del function
        release()

    return arrow_function(run, schema)


def with_columns_from_text(frame: DataFrame, text: str, make: Callable[[], Callable[[list[bytes | None]], list[tuple]]], schema: str, done: Callable[[], None] = lambda: None) -> DataFrame:
    """As ``text_function``, for large results: what Python gives back comes in small batches, along with the other columns.

    The function gives a tuple of the columns of ``schema`` for each text. ``done`` is called at the end of a task.
    """
    from pyspark.sql.types import StructType

    new = StructType.fromDDL(schema)
    kept = [c for c in frame.columns if c not in new.names]
    out = StructType([frame.schema[c] for c in kept] + new.fields)
    at, types = (kept.index(text) if text in kept else len(kept)), [f.type for f in arrow_type(f"struct<{schema}>")]
    ship()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for part in parts:
            start = 0
            for texts in batches(part.column(at)):
                columns = [part.column(k).slice(start, len(texts)) for k in range(len(kept))]
                results = function(texts)
                columns += [pa.array([r[k] for r in results], to) for k, to in enumerate(types)]
                start += len(texts)
                yield pa.RecordBatch.from_arrays(columns, names=out.names)
        done()
        del function
        release()

    quoted = [F.col(f"`{c}`") for c in kept]
    return frame.select(*quoted, *([] if text in kept else [F.col(f"`{text}`")])).mapInArrow(run, out)
