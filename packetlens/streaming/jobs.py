"""The streaming jobs.

Counting jobs keep no state: each micro-batch is reduced to its own counts, which are added
to the table under the batch's epoch. Stateful jobs keep running totals in the state store and
replace the rows they change; windows are bounded by a watermark, and jobs in append mode give
out what it has closed, once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from packetlens.operators import conversations as C
from packetlens.operators import messages, names, nameservers, windows
from packetlens.streaming.serving import SERVING, Serving, Table

# How late a packet may arrive before its window is closed and its state freed.
WATERMARK = "10 minutes"


@dataclass(frozen=True)
class StreamJob:
    """``transform`` maps packets to changes of ``table``. A stateful one runs on the
    stream itself, in output mode ``mode``, any other on each micro-batch. ``view`` maps rows of the table to those of
    the table ``viewed``, which is kept up to date for the keys that a batch has changed."""

    table: str
    transform: Callable[..., DataFrame]
    stateful: bool = False
    viewed: str | None = None
    view: Callable[[DataFrame], DataFrame] | None = None
    mode: str = "update"

    @property
    def target(self) -> Table:
        return SERVING[self.table]

    def serve(self, serving: Serving, changes: DataFrame, epoch: int) -> None:
        # The id lives in the checkpoint: a stream started without one is a new writer.
        writer = changes.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        serving.apply(self.target, changes, epoch, writer)
        if self.viewed:
            keys = list(self.target.keys)
            changed = serving.written(self.target, epoch, writer).select(*keys)
            rows = serving.read(self.target).join(changed, keys, "left_semi")
            serving.apply(SERVING[self.viewed], self.view(rows), epoch, writer)


JOBS = {
    "message_types": StreamJob("message_types", messages.message_types),
    "errors": StreamJob("errors", messages.error_sources),
    # Evidence adds up in keyed state, so a batch touches only the addresses it names.
    "nameservers": StreamJob(
        "nameservers",
        lambda packets, duration, watermark: nameservers.nameserver_activity(packets), True,
    ),
    # The same without state, for streams that share a read: it reads the evidence so far.
    "nameservers_from_evidence": StreamJob(
        "nameserver_evidence", nameservers.evidence,
        viewed="nameservers", view=nameservers.activity,
    ),
    "names": StreamJob("domain_requests_and_responses", names.name_counts),
    "categories": StreamJob("searched_categories", names.category_counts),
    "conversations": StreamJob(
        "conversation_messages", lambda packets: C.messages(packets, "seq", "ts")
    ),
    "conversations_per_batch": StreamJob(
        "conversations", lambda packets: C.conversations(C.messages(packets, "seq", "ts"))
    ),
    "window_bytes_packets": StreamJob(
        "window_bytes_packets", windows.window_bytes_packets, True
    ),
    "window_exchanged_packets": StreamJob(
        "window_exchanged_packets", windows.window_exchanged_packets, True
    ),
    "window_message_types": StreamJob(
        "window_message_types", windows.window_message_types, True
    ),
    "window_names": StreamJob(
        "window_domain_requests_and_responses", windows.window_names, True
    ),
    # The duration of this job is the pause that ends a conversation.
    "closed_conversations": StreamJob(
        "closed_conversations", C.closed_conversations, True, mode="append"
    ),
    "window_bytes_packets_distinct": StreamJob(
        "window_bytes_packets", windows.window_bytes_packets_distinct, True, mode="append"
    ),
    "window_message_types_distinct": StreamJob(
        "window_message_types", windows.window_message_types_distinct, True, mode="append"
    ),
    "window_names_distinct": StreamJob(
        "window_domain_requests_and_responses", windows.window_names_distinct, True, mode="append"
    ),
}


def writer(
    job: StreamJob,
    packets: DataFrame,
    serving: Serving,
    checkpoint: str,
    duration: str = windows.DURATION,
    watermark: str | None = WATERMARK,
) -> DataStreamWriter:
    """The stream ready to be triggered and started. Restarting on the same checkpoint
    goes on where it stopped; an epoch that was cut short is written again in full.
    Without a watermark (None) no row is ever late and state is kept for good."""
    if job.stateful:
        rows = job.transform(packets, duration, watermark)

        def change(batch: DataFrame, epoch: int) -> None:
            job.serve(serving, batch, epoch)

        return _to_batches(rows, job.mode, change, checkpoint)
    return shared_writer([job], packets, serving, checkpoint)


def shared_writer(
    counting: list[StreamJob], packets: DataFrame, serving: Serving, checkpoint: str
) -> DataStreamWriter:
    """Several counting jobs on one stream: the topic is read and parsed once for all."""
    if any(job.stateful for job in counting):
        raise ValueError("stateful jobs need a stream each")

    def change(batch: DataFrame, epoch: int) -> None:
        shared = len(counting) > 1
        if shared:
            batch.persist()
        try:
            for job in counting:
                job.serve(serving, job.transform(batch), epoch)
        finally:
            if shared:
                batch.unpersist()

    return _to_batches(packets, "append", change, checkpoint)


def totals_writer(
    packets: DataFrame,
    serving: Serving,
    checkpoint: str,
    duration: str = windows.DURATION,
    watermark: str | None = WATERMARK,
) -> DataStreamWriter:
    """The four window jobs as one stream: one read of the topic, one state, four tables."""
    totals = windows.window_totals(packets, duration, watermark)

    def change(batch: DataFrame, epoch: int) -> None:
        # Each table is an action of its own; the state is updated once for all.
        batch.persist()
        try:
            for kind in windows.TOTALS:
                JOBS[kind].serve(serving, windows.total_of(batch, kind), epoch)
        finally:
            batch.unpersist()

    return _to_batches(totals, "update", change, checkpoint)


def _to_batches(
    rows: DataFrame, mode: str, change: Callable[[DataFrame, int], None], checkpoint: str
) -> DataStreamWriter:
    return (
        rows.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(change)
    )


def run_available(stream: DataStreamWriter) -> StreamingQuery:
    """Work through everything the source has now, then stop."""
    query = stream.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def read_nameservers(serving: Serving) -> DataFrame:
    return serving.read(SERVING["nameservers"])


def read_conversations(serving: Serving, gap_seconds: int | None = None) -> DataFrame:
    """Conversations over all batches so far, wherever a query and its response fell; with a
    gap, those that no longer pause divides."""
    rows = serving.read(SERVING["conversation_messages"])
    return C.conversations(rows) if gap_seconds is None else C.gap_conversations(rows, gap_seconds)


def read_result(name: str, serving: Serving) -> DataFrame:
    """What the job called ``name`` has served so far."""
    if name.startswith("nameservers"):
        return read_nameservers(serving)
    if name == "conversations":
        return read_conversations(serving)
    return serving.read(JOBS[name].target)
