"""The gold tables fed by a stream: the batch transforms, applied to every micro-batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from lodgeframe.operators.quality import Rule, dead_letters, evaluate
from lodgeframe.sources.sinks import write_records
from lodgeframe.sources.tables import read_stage, write_stage


def publish_stream(
    source: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    rules: Sequence[Rule],
    gold_path: str,
    errors_path: str,
    progress_path: str,
    records_target: str | None = None,
    sink: str = "json",
    servers: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Start a query that writes gold rows, dead letters and (if asked) records per micro-batch.

    Each batch overwrites its own ``batch_id=N`` folder, so a batch that is run again after a
    failure leaves no duplicates in the files. A topic gets at least one copy of every record.
    """

    def publish(batch: DataFrame, number: int) -> None:
        own = f"batch_id={number}"
        # Rules and records read the written rows instead of computing the batch again.
        gold = read_stage(batch.sparkSession, write_stage(transform(batch), f"{gold_path}/{own}"))
        errors = dead_letters(evaluate(gold, rules))
        write_records(errors, f"{errors_path}/{own}", "json", mode="overwrite")
        if records_target:
            target = records_target if sink == "kafka" else f"{records_target}/{own}"
            write_records(gold, target, sink, servers=servers, mode="overwrite")

    writer = source.writeStream.foreachBatch(publish).option("checkpointLocation", progress_path)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
