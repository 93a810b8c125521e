import datetime as dt

import pytest
from pyspark.sql import functions as F

from quillspark.operators import runs
from quillspark.sources import adapters as A

NOW = dt.datetime(2024, 1, 31)


def test_a_run_leaves_its_end(spark, tmp_path):
    rows = spark.createDataFrame([("x", 1), ("x", 2), ("y", 3)], "outcome string, n int")
    ledger = f"{tmp_path}/ledger"
    with runs.job_run(spark, ledger, "job", "r1", A.at()) as run:
        assert [r.status for r in spark.read.parquet(ledger).collect()] == ["running"]
        run.write(rows, f"{tmp_path}/out", x=F.col("outcome") == "x")
        run.write(rows.where("n > 2"), f"{tmp_path}/out", x=F.col("outcome") == "x")
    with pytest.raises(ValueError), runs.job_run(spark, ledger, "job", "r2", A.at()) as run:
        run.write(rows, f"{tmp_path}/more", total="seen")
        raise ValueError("e" * 600)
    got = {r.run_id: r for r in runs.latest_runs(spark.read.parquet(ledger)).collect()}
    assert (got["r1"].status, got["r1"].counters, got["r1"].finished_at) == ("done", {"rows": 4, "x": 2}, NOW) and spark.read.parquet(f"{tmp_path}/out").count() == 4
    assert (got["r2"].status, got["r2"].counters, len(got["r2"].error)) == ("failed", {"seen": 3}, 500)
