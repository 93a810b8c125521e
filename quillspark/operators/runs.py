"""The ledger of runs: one row when a job starts and one when it ends, with counters seen by the job's own plan."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.sources.tables import schema


class JobRun:
    """What a running job writes through, so that rows are counted while they are written."""

    def __init__(self) -> None:
        self.counters: dict[str, int] = {}

    def write(self, df: DataFrame, path: str, mode: str = "append", total: str = "rows", **counted: Column) -> None:
        """Append ``df`` to a Parquet table; count its rows and those that meet each condition in the same pass.

        Nothing is read a second time.  Counters of runs that lose executors may count
        rows of a task that ran twice; what is written may not.
        """
        seen = Observation()
        observed = df.observe(seen, F.count(F.lit(1)).alias(total), *[F.count_if(c).alias(n) for n, c in counted.items()])
        observed.write.mode(mode).parquet(path)
        for name, n in seen.get.items():
            self.counters[name] = self.counters.get(name, 0) + n


@contextmanager
def job_run(spark: SparkSession, ledger: str, job: str, run_id: str, started: Column, finished: Column | None = None) -> Iterator[JobRun]:
    """A run in the ledger at a path: ``running`` at once, ``done`` or ``failed`` at the end.

    A failure is recorded with its text (500 characters) and what was counted before it,
    and goes on to the caller.
    """
    kind = schema("job_runs")

    def note(status: str, run: JobRun, error: str | None = None) -> None:
        row = spark.createDataFrame([(job, run_id, None, None, status, run.counters, error and error[:500])], kind)
        row = row.withColumns({"started_at": started, "finished_at": F.lit(None).cast("timestamp") if status == "running" else started if finished is None else finished})
        row.coalesce(1).write.mode("append").parquet(ledger)

    run = JobRun()
    note("running", run)
    try:
        yield run
    except Exception as e:
        note("failed", run, str(e))
        raise
    note("done", run)


def latest_runs(ledger: DataFrame) -> DataFrame:
    """One row per run: its end where it has one, else its start."""
    last = Window.partitionBy("job", "run_id").orderBy((F.col("status") == "running").cast("int"), F.desc("finished_at"))
    return ledger.withColumn("_k", F.row_number().over(last)).where("_k = 1").drop("_k")
