"""Incremental landing of a raw Ctrl-A feed (Structured Streaming file source)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import FIELD_SEP
from ..sources.text import LAYOUTS, Layout, split_fields


def _land_batch(layout: Layout, target: str, sep: str):
    cols = layout.columns()

    def run(batch: DataFrame, epoch: int) -> None:
        parts = batch.select(F.col("value"), split_fields(batch, sep).alias("__f"))
        ok = F.size("__f") == len(cols)
        good = parts.filter(ok).select([F.col("__f").getItem(i).alias(c) for i, c in enumerate(cols)])
        # one folder per epoch written in overwrite mode: a replayed batch
        # replaces its own output instead of appending duplicates
        good.write.mode("overwrite").parquet(f"{target}/good/epoch={epoch}")
        parts.filter(~ok).select("value").write.mode("overwrite").parquet(f"{target}/rejects/epoch={epoch}")

    return run


def land_feed(
    spark: SparkSession,
    source_dir: str,
    feed: str | Layout,
    target: str,
    checkpoint: str,
    sep: str = FIELD_SEP,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Watch ``source_dir`` for new text files of ``feed`` and land them under
    ``target/good`` (named positional columns, exact width) and
    ``target/rejects`` (lines of any other width).  Progress is kept in
    ``checkpoint``, which the caller names: a restart with the same folder
    resumes with the next unseen file and writes no row twice.
    ``available_now`` processes what is there and stops."""
    layout = LAYOUTS[feed] if isinstance(feed, str) else feed
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.load(source_dir)
    writer = (
        lines.writeStream.foreachBatch(_land_batch(layout, target, sep))
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
