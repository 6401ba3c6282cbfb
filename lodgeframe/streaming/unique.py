"""The ``unique`` rule over a whole stream: keyed state with a watermark instead of a look inside each micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lodgeframe.operators.quality import dead_letters
from lodgeframe.sources.sinks import write_records


def unique_stream(
    source: DataFrame,
    key: str,
    time: str,
    delay_seconds: int,
    errors_path: str,
    progress_path: str,
    message: str = "Duplicate {} found in the stream",
    available_now: bool = True,
) -> StreamingQuery:
    """A query that writes a dead letter for each key that comes again; it reports, as the rule does, and drops no row.

    Rows of a key are found if their event times are at most ``delay_seconds`` apart, in whichever batches they
    come, and never if they are twice that apart or more. State older than the watermark goes, so it does not grow with
    the stream. Two null keys are equal. Rows later than the watermark and rows without an event time take no part.
    A key is reported by each batch in which it came again. Letters stand in a folder for each batch, which is
    overwritten if the batch runs again: started again on the same progress, the query loses and repeats nothing.

    The counts are combined before the shuffle, so a key that very many rows have is no hot task there. Run it beside
    ``publish_stream``, whose own ``unique`` rule sees one micro-batch at a time.
    """
    timed = source.withColumn(time, F.col(time).cast("timestamp")).where(F.col(time).isNotNull())
    marked = timed.withWatermark(time, f"{delay_seconds} seconds")
    # Any two events within the delay share one of these windows, wherever its border falls.
    near = F.window(time, f"{2 * delay_seconds} seconds", f"{delay_seconds} seconds")
    counted = marked.groupBy(near.alias("_window"), F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))

    def report(batch: DataFrame, number: int) -> None:
        found = batch.where("_n > 1").groupBy("_key").agg((F.max("_n") - 1).alias("n_violations"))
        named = found.select(
            F.concat_ws("=", F.lit(key), F.coalesce(F.col("_key").cast("string"), F.lit("null"))).alias("variable"),
            F.lit(message.format(key)).alias("message"),
            "n_violations",
        )
        write_records(dead_letters(named), f"{errors_path}/batch_id={number}", "json", mode="overwrite")

    writer = counted.writeStream.foreachBatch(report).outputMode("update").option("checkpointLocation", progress_path)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
