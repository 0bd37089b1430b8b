"""St1 + St2 (S10, S15): application log lines -> rating messages.

A stateless stream: text source -> keep lines with the rating prefix -> parse
the payload -> sink. Exactly-once comes from the file sink's log plus the
checkpoint (S11/St7: restart resumes from the checkpoint, no offsets kept by hand).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recolib import config as C
from recolib.sources import text


def log_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None,
               source_format: str = "text", options: dict | None = None) -> DataFrame:
    """Streaming log lines (``value``) from files; ``source_format='kafka'`` with
    ``options`` (``kafka.bootstrap.servers``, ``subscribe``, ``startingOffsets``)
    reads a topic instead when the Kafka connector is on the classpath."""
    r = spark.readStream.format(source_format)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    if max_files_per_trigger and source_format == "text":
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.load(source_dir) if source_format == "text" else r.load()
    if source_format == "kafka":
        df = df.selectExpr("CAST(value AS STRING) AS value")
    return df


def rating_messages(lines: DataFrame) -> DataFrame:
    """The filter (P5, P6) then the parse (P7); same functions as the batch path."""
    return text.log_filter_parse(lines)


def start_log_filter(spark: SparkSession, source_dir: str | None, sink_dir: str | None, checkpoint: str,
                     available_now: bool = True, max_files_per_trigger: int | None = None,
                     sink_format: str = "parquet", payload_only: bool = False,
                     sink_options: dict | None = None, source_format: str = "text",
                     source_options: dict | None = None):
    """Run the log filter stream; returns the StreamingQuery.

    ``payload_only`` forwards the trimmed ``user|item|score|ts`` text as a single
    ``value`` column (the topic-to-topic form, for a ``text`` or ``kafka`` sink,
    the latter with ``sink_options`` such as ``kafka.bootstrap.servers`` and
    ``topic``); otherwise the parsed, typed columns are written. The source is a
    folder of text files, or with ``source_format='kafka'`` and ``source_options``
    a topic.
    """
    lines = log_stream(spark, source_dir, max_files_per_trigger, source_format, source_options)
    msgs = text.filter_log(lines) if payload_only else rating_messages(lines)
    w = msgs.writeStream.format(sink_format).option("checkpointLocation", checkpoint)
    if sink_dir:
        w = w.option("path", sink_dir)
    for k, v in (sink_options or {}).items():
        w = w.option(k, v)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=C.STREAM_TRIGGER)
    return w.start()
