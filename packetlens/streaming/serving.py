"""Keyed serving tables on parquet.

A batch of changes is written to a folder named after its epoch, and never anywhere else,
so applying an epoch again replaces its own earlier write and cannot count twice. Writing
reads nothing. A read folds the changes per key: "replace" keeps the newest row, "add" sums
the values, and "append" has nothing to fold because no key comes twice. ``compact`` folds
old epochs into one snapshot and keeps reads short.

A table has one writer at a time. A stream's epochs count from the number it claimed at its
first write, which lies above all that was there, so a stream that starts anew without its
checkpoint adds to the table and neither replaces nor hides what an earlier one wrote.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Table:
    name: str
    keys: dict[str, str]
    values: dict[str, str] = field(default_factory=dict)
    upsert: str = "replace"
    # A key column that numbers the pieces of one long row; pieces are replaced together.
    piece: str | None = None
    # Rows are dealt by the hash of their key over so many folders, of which a lookup reads one.
    buckets: int | None = None

    def bucket_of(self, *values: Column) -> Column:
        """The bucket of a whole key; of literals it is a constant, which prunes folders."""
        typed = [v.cast(t) for v, t in zip(values, self.keys.values(), strict=True)]
        return F.pmod(F.xxhash64(*typed), F.lit(self.buckets)).cast("int")

    @property
    def columns(self) -> dict[str, str]:
        return {**self.keys, **self.values}

    @property
    def schema(self) -> str:
        return ", ".join(f"`{c}` {t}" for c, t in self.columns.items())


_WINDOW = {"start": "timestamp", "end": "timestamp"}
_COUNT = "bigint"

SERVING = {
    t.name: t
    for t in (
        # Evidence adds up across batches; the nameservers view is computed from it.
        Table(
            "nameserver_evidence",
            {"address": "string"},
            {c: _COUNT for c in ("known_sent", "known_received", "possible_sent",
                                 "possible_received", "certain")},
            "add",
        ),
        Table("nameservers", {"address": "string"},
              {"packets_sent": _COUNT, "packets_received": _COUNT}),
        Table("searched_categories", {"category": "string"}, {"requests": _COUNT}, "add"),
        Table("message_types", {"type": "string"}, {"packets": _COUNT}, "add"),
        # One row per message; conversations are put together when read.
        Table(
            "conversation_messages",
            {"query_id": "string", "client": "string", "server": "string", "seq": "bigint"},
            {"ts": "timestamp", "message": "string"},
            "append",
        ),
        Table(
            "conversations",
            {"query_id": "string", "client": "string", "server": "string", "part": "bigint"},
            {"n_messages": _COUNT, "messages": "array<string>"},
            piece="part",
        ),
        # Given out once each, when the watermark has closed them.
        Table(
            "closed_conversations",
            {"query_id": "string", "client": "string", "server": "string", "start": "timestamp"},
            {"n_messages": _COUNT, "messages": "array<string>"},
            "append",
        ),
        Table("domain_requests_and_responses", {"request_response": "string", "type": "string"},
              {"requests": _COUNT}, "add", buckets=8),
        Table("errors", {"address": "string"}, {"errors": _COUNT}, "add"),
        Table("window_domain_requests_and_responses",
              {**_WINDOW, "type": "string", "request_response": "string"}, {"requests": _COUNT}),
        Table("window_exchanged_packets", {**_WINDOW, "address": "string"},
              {"packets_sent": _COUNT, "packets_received": _COUNT}),
        Table("window_bytes_packets", _WINDOW, {"bytes": _COUNT, "packets": _COUNT}),
        Table("window_message_types", {**_WINDOW, "type": "string"}, {"count": _COUNT}),
        Table("hosts", {"host": "string"}),
        Table("requests_responses_uniquehosts",
              {"type": "string", "request_response": "string", "part": "bigint"},
              {"count": _COUNT, "hosts": "array<string>"}, piece="part"),
        Table("total_avg_bytes", {"address_a": "string", "address_b": "string"},
              {"total": _COUNT, "avg": "double", "count": _COUNT}),
    )
}


def upsert_replace(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``new`` rows, and the ``old`` rows whose key ``new`` lacks."""
    return new.unionByName(old.join(new.select(*keys), keys, "left_anti"))


def upsert_add(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Values summed per key over both."""
    values = [c for c in old.columns if c not in keys]
    return old.unionByName(new).groupBy(*keys).agg(*[F.sum(v).alias(v) for v in values])


def _names(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that match."""
    glob = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = glob.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(glob)
    return [s.getPath().toString() for s in found or []]


def _numbered_folders(
    spark: SparkSession, path: str, prefix: str, above: int | None = None
) -> list[int]:
    """Numbers N, greater than ``above``, of the folders ``prefix=N`` below ``path`` whose
    write has finished."""
    done = _names(spark, f"{path}/{prefix}=*/_SUCCESS")
    numbers = [int(n.split("/")[-2].split("=", 1)[1]) for n in done]
    return sorted(n for n in numbers if above is None or n > above)


def _finished_epochs(spark: SparkSession, path: str, above: int | None = None) -> list[int]:
    """Epochs with a finished write. Only the newest can be without its mark, cut short and
    waiting for its replay; others without one mean a store that writes no marks."""
    done = _numbered_folders(spark, path, "epoch")
    every = [int(n.rsplit("=", 1)[1]) for n in _names(spark, f"{path}/epoch=*")]
    lost = sorted(set(every) - set(done))
    if lost and lost != [max(every)]:
        raise RuntimeError(f"epochs {lost[:5]} of {path} have no _SUCCESS mark")
    return [n for n in done if above is None or n > above]


class Serving:
    """The tables below one root folder, which all executors must reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _changes(self, table: Table) -> str:
        return f"{self.root}/{table.name}/changes"

    def _snapshots(self, table: Table) -> str:
        return f"{self.root}/{table.name}/snapshots"

    def _claims(self, table: Table) -> str:
        return f"{self.root}/{table.name}/writers"

    def _first_number(self, table: Table, writer: str) -> int:
        """The number that stands for epoch 0 of ``writer``, claimed at its first write."""
        path = f"{self._claims(table)}/{writer}"
        if not _names(self.spark, f"{path}/_SUCCESS"):
            claim = self.spark.range(1).select(F.lit(self.next_epoch(table)).cast("bigint").alias("first"))
            claim.write.mode("overwrite").parquet(path)
        return self.spark.read.schema("first bigint").parquet(path).first()[0]

    def _folder(self, table: Table, epoch: int, writer: str | None) -> str:
        if writer is not None:
            epoch += self._first_number(table, writer)
        return f"{self._changes(table)}/epoch={epoch}"

    def apply(
        self, table: Table, changes: DataFrame, epoch: int, writer: str | None = None
    ) -> None:
        """Write one epoch, counted from the first number of ``writer`` if one is named.

        Aggregated changes may be few rows in many partitions, which ``rebalance`` gathers
        into files of a good size, sorted so that a lookup can skip within them; appended rows
        go out as they are."""
        shaped = changes.select(*[F.col(c).cast(t).alias(c) for c, t in table.columns.items()])
        if table.upsert != "append":
            dealt = _dealt(table, shaped)
            by = ["bucket"] if table.buckets else []
            shaped = dealt.hint("rebalance", *by).sortWithinPartitions(*by, *table.keys)
        _written(table, shaped, self._folder(table, epoch, writer))

    def written(self, table: Table, epoch: int, writer: str | None = None) -> DataFrame:
        """The changes of one epoch as they were written."""
        path = self._folder(table, epoch, writer)
        return self.spark.read.schema(_stored_schema(table)).parquet(path).select(*table.columns)

    def next_epoch(self, table: Table) -> int:
        """For a batch job, which has no epoch of its own."""
        taken = _numbered_folders(self.spark, self._changes(table), "epoch")
        taken += _numbered_folders(self.spark, self._snapshots(table), "upto")
        return max(taken, default=-1) + 1

    def create(self, table: Table) -> None:
        """Make the table exist and empty."""
        empty = self.spark.createDataFrame([], table.schema)
        for path in (self._snapshots(table), self._changes(table), self._claims(table)):
            empty.write.mode("overwrite").parquet(path)

    def read(
        self, table: Table, upto: int | None = None, bucket: Column | None = None
    ) -> DataFrame:
        """Current rows, or those of one bucket. A filter on key columns reaches the parquet
        scan, one on the bucket leaves out folders."""
        snapshots = _numbered_folders(self.spark, self._snapshots(table), "upto")
        base = max(snapshots, default=None)
        epochs = [
            e
            for e in _finished_epochs(self.spark, self._changes(table), base)
            if upto is None or e <= upto
        ]
        parts = []
        if base is not None:
            snapshot = self.spark.read.schema(_stored_schema(table)).parquet(
                f"{self._snapshots(table)}/upto={base}"
            )
            parts.append(snapshot.withColumn("epoch", F.lit(base).cast("bigint")))
        if epochs:
            root = self._changes(table)
            parts.append(
                self.spark.read.option("basePath", root)
                .schema(f"{_stored_schema(table)}, epoch bigint")
                .parquet(*[f"{root}/epoch={e}" for e in epochs])
            )
        if not parts:
            return self.spark.createDataFrame([], table.schema)
        if bucket is not None:
            parts = [p.where(F.col("bucket") == bucket) for p in parts]
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return _fold(table, rows)

    def compact(self, table: Table) -> None:
        """Fold every finished epoch into a new snapshot. Older files stay, for readers
        that still use them, until the storage's own retention removes them."""
        snapshots = _numbered_folders(self.spark, self._snapshots(table), "upto")
        base = max(snapshots, default=None)
        epochs = _finished_epochs(self.spark, self._changes(table), base)
        if not epochs:
            return
        path = f"{self._snapshots(table)}/upto={epochs[-1]}"
        by = ["bucket"] if table.buckets else []
        ordered = _dealt(table, self.read(table, epochs[-1])).repartitionByRange(*by, *table.keys)
        _written(table, ordered.sortWithinPartitions(*by, *table.keys), path)

    def lookup(self, table: Table, **key: object) -> DataFrame:
        """The rows of a key or of a part of it. A whole key of a table with buckets opens the
        files of one bucket only."""
        bucket = None
        if table.buckets and set(key) >= set(table.keys):
            bucket = table.bucket_of(*[F.lit(key[k]) for k in table.keys])
        rows = self.read(table, bucket=bucket)
        for column, value in key.items():
            rows = rows.where(F.col(column) == F.lit(value))
        return rows


def _stored_schema(table: Table) -> str:
    return f"{table.schema}, bucket int" if table.buckets else table.schema


def _dealt(table: Table, rows: DataFrame) -> DataFrame:
    return rows.withColumn("bucket", table.bucket_of(*map(F.col, table.keys))) if table.buckets else rows


def _written(table: Table, rows: DataFrame, path: str) -> None:
    writer = rows.write.mode("overwrite")
    if table.buckets:
        # Of the files of its bucket, a lookup opens the pages of those that may hold the key.
        writer = writer.partitionBy("bucket").option("parquet.bloom.filter.adaptive.enabled", "true")
        for key in table.keys:
            writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
    writer.parquet(path)


def _fold(table: Table, rows: DataFrame) -> DataFrame:
    if table.upsert == "append":
        return rows.drop("epoch")
    grouped = rows.groupBy(*table.keys)
    if table.upsert == "add":
        return grouped.agg(*[F.sum(v).alias(v) for v in table.values])
    if not table.values:
        return rows.select(*table.keys).distinct()
    if table.piece:
        return _newest_pieces(table, rows)
    newest = grouped.agg(F.max_by(F.struct(*table.values), "epoch").alias("v"))
    return newest.select(*table.keys, "v.*")


def _newest_pieces(table: Table, rows: DataFrame) -> DataFrame:
    """The pieces of each row's newest epoch. The newest epoch is found among keys alone;
    the long rows are then met piece by piece, so those of one key stay spread."""
    whole = [k for k in table.keys if k != table.piece]
    latest = F.max("epoch").over(Window.partitionBy(*whole))
    keys = rows.select(*table.keys, "epoch").withColumn("latest", latest)
    keep = keys.where(F.col("epoch") == F.col("latest")).drop("latest")
    return rows.join(keep, [*table.keys, "epoch"]).drop("epoch")
