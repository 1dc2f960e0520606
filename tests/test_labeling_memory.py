"""What a task's Python holds while it labels long texts."""

import os

import pytest
from pyspark.sql import functions as F

from stillhouse.operators.labeling import label_to_table


@pytest.mark.skipif(not os.path.exists("/proc/self/statm"), reason="needs /proc")
def test_memory_does_not_grow_with_the_rows_of_a_batch(spark, tmp_path):
    def make_gauge():
        """Answers with the MB that the worker has taken since before its first batch."""
        def resident():
            with open("/proc/self/statm") as f:
                return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE")

        before = resident()
        return lambda prompt: str((resident() - before) >> 20)

    text = F.concat(F.col("id").cast("string"), F.expr("repeat(' long text', 2000)"))
    rows = spark.range(0, 3000, 1, 1).select(
        F.col("id").cast("string").alias("record_id"), F.lit("t").alias("task"), text.alias("input"), text.alias("prompt"),
    )
    answers = label_to_table(rows, make_gauge, str(tmp_path / "out"))
    assert answers.count() == 3000 and answers.select("record_id").distinct().count() == 3000
    assert answers.filter("input = concat(record_id, repeat(' long text', 2000))").count() == 3000
    assert answers.agg(F.max(F.col("response").cast("int"))).first()[0] < 100
