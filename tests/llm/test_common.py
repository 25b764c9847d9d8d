from pathlib import Path

from pyspark.sql import functions as F

from tessera.llm.common import CLEANUP, written


def test_working_tables_leave_no_shuffle_files(spark):
    """What a working table shuffled goes with its query; the session's own setting stays as it was."""
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {p.name for d in manager.localDirs() for p in Path(d.getPath()).rglob("shuffle_*") if p.stat().st_size}
    before, set_before = files(), spark.conf.get(CLEANUP, None)
    table = written(spark.range(1000).groupBy(F.col("id") % 10).count(), "counts")
    assert not files() - before
    assert table.count() == 10 and table.agg(F.sum("count")).first()[0] == 1000
    assert spark.conf.get(CLEANUP, None) == set_before
