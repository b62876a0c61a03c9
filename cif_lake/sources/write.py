"""Write CIF files and exports to a new directory."""

from __future__ import annotations

import gzip
import os
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cif_lake.functions import render
from cif_lake.operators.relational import work_folder

#: How many lines of a part are held while they are copied to their place.
COPY_LINES = 1_000
#: What the name of a file ends in until it is complete.
TEMPORARY = re.compile(r"\.[0-9a-f]{8}\.tmp$")


def qualified(spark: SparkSession, directory: str) -> str:
    """The directory with its scheme: what has none belongs to the default file system, for executors too."""
    path = spark._jvm.org.apache.hadoop.fs.Path(directory)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def uri(path: str) -> str:
    """A qualified path as Arrow names it."""
    return re.sub("^s3a://", "s3://", re.sub("^file:/+", "file:///", path))


def save_table(frame: DataFrame, folder: str) -> None:
    """Write a table that is read again soon, small: compressed by zstd, and without the shuffle files that made it."""
    conf, key = frame.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, None)
    conf.set(key, "true")
    try:
        # The setting is read when a frame is made.
        frame.select("*").write.option("compression", "zstd").parquet(folder)
    finally:
        conf.unset(key) if before is None else conf.set(key, before)


def drop_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def write_files(files: DataFrame, directory: str, folders: int | None = None) -> int:
    """Write one file per row of ``path, content`` below ``directory``, gzip when the name ends in ``.gz``; gives their number.

    ``folders`` deals the paths by hash over so many folders: tasks that write to one folder wait for each other, and one task lists it
    (``read.dealt_files``).

    Each file is written by the task that holds it, under a temporary name that is renamed when complete, so a retried or
    speculative task leaves whole files only. ``path`` is used below the directory, without its scheme.
    """
    name = F.regexp_replace("path", r"^[a-z0-9]+:/*|^/+", "")
    if folders is not None:
        name = F.concat(F.pmod(F.hash(name), F.lit(folders)).cast("string"), F.lit("/"), name)
    rows = files.select(name.alias("name"), F.col("content").cast("binary").alias("content"))
    target_folder = uri(qualified(files.sparkSession, directory))

    def save(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, root = fs.FileSystem.from_uri(target_folder)
        for part in parts:
            for row in range(part.num_rows):
                target = f"{root}/{part.column(0)[row].as_py()}"
                content = part.column(1)[row].as_py()
                if target.endswith(".gz"):
                    content = gzip.compress(content, mtime=0)
                base.create_dir(target.rsplit("/", 1)[0], recursive=True)
                temporary = f"{target}.{os.urandom(4).hex()}.tmp"
                with base.open_output_stream(temporary) as out:
                    out.write(content)
                base.move(temporary, target)
            yield pa.RecordBatch.from_pydict({"n": pa.array([part.num_rows], pa.int64())})

    return rows.mapInArrow(save, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def write_lines(lines: DataFrame, directory: str, name: str) -> None:
    """Write sorted lines, a frame of one column, as one file ``directory/name``; many tasks write it, each a range of its bytes.

    The partitions are written as compressed parts first, and their shuffle is dropped; the lengths of their lines give the place of each
    part, and a task puts lines there, some MB at a time. A retried or speculative task puts the same bytes at the same place. Only a
    ``file:`` system takes bytes at a place; in any other one task appends the parts in their order.
    """
    spark = lines.sparkSession
    folder = work_folder(spark)
    lines = lines.select(F.coalesce(F.col(lines.columns[0]).cast("binary"), F.lit(b"")).alias("line"))
    save_table(lines, folder)
    number = F.regexp_extract("path", r"/part-(\d+)-[^/]*$", 1).cast("long")
    held = spark.read.schema("line binary").parquet(folder).groupBy(F.col("_metadata.file_path").alias("path")).agg(F.sum(F.octet_length("line") + F.lit(1).cast("long")).alias("length"))
    places, end = [], 0
    # As many rows as there are partitions.
    for part in sorted(held.select("path", "length", number.alias("number")).collect(), key=lambda r: (r["number"], r["path"])):
        places.append((uri(part["path"]), end))
        end += part["length"]
    target_folder = uri(qualified(spark, directory))
    local = target_folder.startswith("file:")

    def copy(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, root = fs.FileSystem.from_uri(target_folder)
        base.create_dir(root, recursive=True)
        out = os.fdopen(os.open(f"{root}/{name}", os.O_WRONLY | os.O_CREAT, 0o644), "wb") if local else base.open_output_stream(f"{root}/{name}", compression=None)
        with out:
            for batch in rows:
                for source, at in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    system, part = fs.FileSystem.from_uri(source)
                    if local:
                        out.seek(at)
                    with system.open_input_file(part) as held:
                        for piece in pq.ParquetFile(held).iter_batches(COPY_LINES):
                            out.write(b"".join(line + b"\n" for line in piece.column(0).to_pylist()))
        yield pa.RecordBatch.from_pydict({"n": pa.array([1], pa.int64())})

    todo = spark.createDataFrame(places, "path string, at long").coalesce(1)
    if local:
        todo = todo.repartition(max(len(places), 1))
    todo.mapInArrow(copy, "n long").count()
    drop_folder(spark, folder)


def write_block(
    tables: dict[str, tuple[DataFrame, list[str]]], directory: str, block: str, keys: str = "filename", folders: int | None = None
) -> None:
    """Write the edited categories of each file as one new file: all of them, or none of that file; ``folders`` as in ``write_files``."""
    texts = render.categories(tables, [keys])
    head = F.concat(F.lit(f"data_{block}\n#\n"), F.col("text"), F.lit("#\n"))
    write_files(texts.select(F.col(keys).alias("path"), head.alias("content")), directory, folders)


def export_csv(frame: DataFrame, directory: str) -> None:
    """Every column of a category as CSV with a header."""
    frame.write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"').csv(directory)
