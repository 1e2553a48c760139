"""Helpers that the operators of this package share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from packetlens.session import work_dir

# Bytes of text that a task handles at a time; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20
# Rows of an Arrow batch that Spark hands to a task.
BATCH_ROWS = 1000
# Python workers are reused; these let them give freed arrays back to the machine.
WORKER_MEMORY = {
    "MALLOC_ARENA_MAX": "1", "MALLOC_MMAP_THRESHOLD_": "524288", "MALLOC_TRIM_THRESHOLD_": "524288",
    "ARROW_DEFAULT_MEMORY_POOL": "system",
}
CODE = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Local workers find this code where the driver does; on a cluster give it by --py-files.
    for key, value in {"PYTHONPATH": CODE, **WORKER_MEMORY}.items():
        spark.sparkContext.environment.setdefault(key, value)
    # Rows hold whole texts, so batches of the default number of rows would be large.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(taken: Iterable[str], name: str) -> str:
    """``name``, or a longer one if a column has it already (names ignore case)."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name += "_"
    return name


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared working folder and read back: later reads neither repeat
    its work nor depend on executors that held its shuffle files."""
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def files_in(path: str, columns: list[str]) -> pa.Table | None:
    """The rows of a folder of Parquet files in the shared folder, read by a task; None if
    there is no such folder."""
    fs, where = pafs.FileSystem.from_uri(path) if ":/" in path else (pafs.LocalFileSystem(), path)
    if fs.get_file_info(where).type == pafs.FileType.NotFound:
        return None
    return pq.read_table(where, columns=columns, filesystem=fs, partitioning=None)


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about equal bytes in ``column``."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch[column]), 0), "i8")
    start, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and total + n > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if len(sizes) > start:
        yield batch.slice(start)


def gathered(batches: Iterable[pa.RecordBatch], column: str, least: int) -> Iterator[pa.RecordBatch]:
    """Put batches together until ``column`` has ``least`` bytes."""
    held, total = [], 0
    for batch in batches:
        held.append(batch)
        total += pc.sum(pc.binary_length(batch[column])).as_py() or 0
        if total >= least:
            yield pa.concat_batches(held)
            held, total = [], 0
    if held:
        yield pa.concat_batches(held)


def map_texts(
    df: DataFrame,
    column: str,
    make: Callable[[], Callable[[list], dict]],
    schema: str,
    keep: list[str] | None = None,
    most: int = SLICE_BYTES,
) -> DataFrame:
    """Add columns computed from ``column`` by Arrow batches.

    ``make()`` runs once per task and returns a function from a list of texts (None for null)
    to a dict of columns. ``keep`` names the columns passed through (default: all); an added
    column whose name one of them has gets a longer name (``fresh``). With ``most`` above
    ``SLICE_BYTES`` texts of several batches are handed over together.
    """
    keep = df.columns if keep is None else keep
    made = StructType.fromDDL(schema)
    fields = to_arrow_schema(made)
    added = [fresh(keep, n) for n in fields.names]
    rows = df.select(*[f"`{c}`" for c in dict.fromkeys([*keep, column])])
    result = StructType([rows.schema[c] for c in keep])
    for name, field in zip(added, made.fields, strict=True):
        result = result.add(name, field.dataType)

    def run(batches):
        work = make()
        for batch in gathered(batches, column, most) if most > SLICE_BYTES else batches:
            for part in slices(batch, column, most):
                got = work(part[column].to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part[c] for c in keep] + [pa.array(got[f.name], f.type) for f in fields],
                    [*keep, *added],
                )

    return rows.mapInArrow(run, result)
