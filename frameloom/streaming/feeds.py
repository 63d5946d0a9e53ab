"""Sources and sinks of streams: telemetry and commands from files, the latest value of each key, publishing, periodic status."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from frameloom.operators.episodes import latest_per_key

TELEMETRY = "key string, name string, ts timestamp_ntz, value array<float>"
COMMANDS = "key string, ts timestamp_ntz, code int, prompt string, episode_id string"


def telemetry(spark: SparkSession, folder: str, files_per_trigger: int = 0, schema: str = TELEMETRY) -> DataFrame:
    """Samples of all streams in long form, as files arrive; ``files_per_trigger`` bounds what one batch takes."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).parquet(folder)


def commands(spark: SparkSession, folder: str, files_per_trigger: int = 0) -> DataFrame:
    """Start, stop and discard commands, as files arrive."""
    return telemetry(spark, folder, files_per_trigger, COMMANDS)


def _run(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, every: str | None) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def keep_latest(stream: DataFrame, keys: Sequence[str], ts: str, values: Sequence[str], folder: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Writes after each batch the latest row of each key so far to ``folder``/batch=N; what came between is dropped.

    Each batch reads only the table that the batch before wrote, so one that runs again writes the same. Without
    ``every`` all that is there now is taken and the query ends.
    """
    spark = stream.sparkSession

    def handle(batch: DataFrame, number: int) -> None:
        new = batch.select(*keys, ts, *values)
        if number and _exists(spark, f"{folder}/batch={number - 1}"):
            new = new.unionByName(spark.read.schema(new.schema).parquet(f"{folder}/batch={number - 1}"))
        latest_per_key(new, keys, ts, values).write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return _run(stream, handle, checkpoint, every)


def publish(stream: DataFrame, folder: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Rows as Parquet files, each once: the file sink commits by batch."""
    writer = stream.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def status_rows(samples: DataFrame, keys: Sequence[str], level: str, message: str, settings: dict[str, str] | None = None) -> DataFrame:
    """(keys, level, message, n, values): the worst level of a key, the least message at it, and a map of settings and counts by level."""
    worst = samples.groupBy(*keys).agg(F.max(level).alias("level"), F.max_by(F.col(message), F.struct(level, message)).alias("message"), F.count("*").alias("n"), *(F.count_if(F.col(level) == k).cast("string").alias(f"_n{k}") for k in range(3)))
    pairs = [x for k, v in (settings or {}).items() for x in (F.lit(k), F.lit(str(v)))] + [x for k in range(3) for x in (F.lit(f"level_{k}"), F.col(f"_n{k}"))]
    return worst.select(*keys, "level", "message", "n", F.create_map(*pairs).alias("values"))


def report_status(stream: DataFrame, keys: Sequence[str], level: str, message: str, folder: str, checkpoint: str, settings: dict[str, str] | None = None, every: str | None = None) -> StreamingQuery:
    """Writes ``status_rows`` of each batch to ``folder``/batch=N; a batch that runs again replaces its own."""

    def handle(batch: DataFrame, number: int) -> None:
        status_rows(batch, keys, level, message, settings).write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return _run(stream, handle, checkpoint, every)


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
