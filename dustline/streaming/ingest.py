"""Incremental ingest: file streams, watermarked windows, deduplication, keep-last upserts."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dustline.operators import tables
from dustline.session import fresh_path

#: How late a reading may arrive; older days are final.
LATENESS = "7 days"


def file_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def hourly_means(readings: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Site-hour means as a stateful aggregation; state older than the lateness is dropped."""
    return (readings.withWatermark("time", lateness)
            .groupBy("site_id", F.window("time", "1 hour").alias("w"))
            .agg(F.avg("value").alias("pm25"), F.count(F.lit(1)).alias("n"))
            .select("site_id", F.col("w.start").alias("hour"), "pm25", "n"))


def deduplicated(readings: DataFrame, keys: Sequence[str], lateness: str = LATENESS) -> DataFrame:
    return readings.withWatermark("time", lateness).dropDuplicatesWithinWatermark(list(keys))


class UpsertLog:
    """Keep-last table fed by micro-batches.

    A batch is written to its own folder, named by the run's number and the batch id, so a replay
    rewrites the same folder and changes nothing. A run is one stream checkpoint (``run``); where
    the checkpoint is replaced, ids restart at 0, but the new run's number is higher, so its rows
    are later. Reading keeps, per key, the row of the latest batch. After every ``compact_every``
    batches the log is folded into a base: a folder of its own that counts only once its success
    mark is there, so a reader sees the old state or the new.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], schema: str | StructType | None = None, run: str = "run",
                 compact_every: int = 20):
        self.spark, self.path, self.keys, self.schema, self.run, self.compact_every = spark, path, list(keys), schema, run, compact_every

    def _path(self, *names: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *names]))

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, kind: str, mark: str = "") -> list[str]:
        """What follows ``<kind>=`` in the names of the folders that hold ``mark``."""
        fs = self._fs()
        if not fs.exists(self._path()):
            return []
        names = [x.getPath().getName() for x in fs.listStatus(self._path())]
        return [n.split("=", 1)[1] for n in names if n.startswith(f"{kind}=") and (not mark or fs.exists(self._path(n, mark)))]

    def _number(self) -> int:
        """Number of this run: that of its mark, or one above all others."""
        runs = {name.split("-", 1)[1]: int(name.split("-", 1)[0]) for name in self._names("run")}
        if self.run not in runs:
            runs[self.run] = max(runs.values(), default=-1) + 1
            self._fs().mkdirs(self._path(f"run={runs[self.run]}-{self.run}"))
        return runs[self.run]

    def _finished(self, kind: str) -> list[tuple[int, int]]:
        """(run, batch id) of the finished folders, in order."""
        return sorted(tuple(int(x) for x in name.split("-")) for name in self._names(kind, "_SUCCESS"))

    def _pending(self) -> tuple[tuple[int, int] | None, list[tuple[int, int]]]:
        base = max(self._finished("base"), default=None)
        return base, [i for i in self._finished("batch_id") if base is None or i > base]

    def write(self, batch: DataFrame, batch_id: int) -> None:
        number = self._number()
        if (number, batch_id) <= max(self._finished("base"), default=(-1, -1)):
            return  # a replay of a batch that the base holds already
        batch.write.mode("overwrite").parquet(f"{self.path}/batch_id={number}-{batch_id}")
        if len(self._pending()[1]) >= self.compact_every:
            self.compact()

    def _log(self) -> DataFrame | None:
        base, pending = self._pending()
        folders = ([("base", base)] if base is not None else []) + [("batch_id", i) for i in pending]
        parts = [self.spark.read.parquet(f"{self.path}/{kind}={number}-{i}").withColumn("__order", F.struct(F.lit(number).alias("run"), F.lit(i).alias("batch")))
                 for kind, (number, i) in folders]
        return reduce(DataFrame.unionByName, parts) if parts else None

    def read(self) -> DataFrame:
        log = self._log()
        if log is None:
            if self.schema is None:
                raise ValueError(f"nothing was written to {self.path}, and no schema was given")
            return self.spark.createDataFrame([], self.schema)
        return tables.keep_last(log, self.keys, F.col("__order")).drop("__order")

    def compact(self) -> None:
        """Folds all finished batches into a new base and removes what the base before it had replaced; the folders that this one
        replaces stay for readers that still hold them."""
        base, pending = self._pending()
        if not pending:
            return
        number, batch = max(pending)
        self.read().write.mode("overwrite").parquet(f"{self.path}/base={number}-{batch}")
        if base is not None:
            fs = self._fs()
            for kind in ("base", "batch_id"):
                for old in self._finished(kind):
                    if old < base or (kind == "batch_id" and old == base):
                        fs.delete(self._path(f"{kind}={old[0]}-{old[1]}"), True)


def run_available(stream: DataFrame, sink: Callable[[DataFrame, int], None] | str, mode: str, checkpoint: str) -> None:
    """Processes everything available now, batch by batch, then stops."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query = (writer.format("parquet").option("path", sink).start() if isinstance(sink, str)
             else writer.foreachBatch(sink).start())
    query.awaitTermination()


def ingest_hours(spark: SparkSession, readings: DataFrame, label: str = "hours") -> DataFrame:
    """Runs the hourly aggregation into an upsert log and returns its current rows."""
    hours = hourly_means(readings)
    log = UpsertLog(spark, fresh_path(spark, label), ["site_id", "hour"], hours.schema)
    run_available(hours, log.write, "update", fresh_path(spark, f"{label}-state"))
    return log.read()


# ---------------------------------------------------------------- late data and tiers
def open_days(df: DataFrame, today: Column, back: int = 7, ahead: int = 1) -> DataFrame:
    """Days recomputed by a run; everything before is frozen."""
    return df.where(F.col("date").between(F.date_sub(today, back), F.date_add(today, ahead)))


def merge_run(frozen: DataFrame, recomputed: DataFrame, today: Column, back: int = 7) -> DataFrame:
    """Frozen days stay as they are, open days come from the run where it has them."""
    late = F.col("date") >= F.date_sub(today, back)
    return tables.replace_dates(frozen, recomputed.where(late))


def guarded(name: str, refresh: Callable[[], DataFrame], fallback: Callable[[], DataFrame], freshness: dict) -> DataFrame:
    """The refreshed input, or the last good snapshot with the error noted."""
    try:
        df = refresh()
        df.schema  # resolve now, so a missing file shows here
        df.limit(1).count()
        return df
    except Exception as error:  # noqa: BLE001 - one failed input must not stop the run
        freshness[f"{name}_error"] = str(error)[:200]
        return fallback()
