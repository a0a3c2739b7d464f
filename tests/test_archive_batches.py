"""Members of an archive are the same however small the session's batches are."""

import pytest
from pyspark.sql import functions as F

from gaugeworks.plans import loads
from gaugeworks.sources import archives


@pytest.mark.parametrize("rows_per_batch", ["1000", "10000"])
def test_members_do_not_hang_on_the_sessions_batches(spark, tmp_path, rows_per_batch):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows_per_batch)
    try:
        lines = spark.range(0, 25_000, 1, 1).select(F.concat(F.lit("x"), F.col("id").cast("string")).alias("line"))
        loads._zip(lines, str(tmp_path / "zips"))
        got = archives.scan_members(spark, str(tmp_path / "zips")).groupBy("member").count().collect()
    finally:
        spark.conf.set(name, before)
    assert len(got) == 9 and sorted(r["count"] for r in got) == [1666, 1667, 1667, *[3333] * 4, *[3334] * 2]
