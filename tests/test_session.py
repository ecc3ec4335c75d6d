"""Scratch folders: from the session's settings only, and removable."""
import os
import time
from pathlib import Path

from pyspark.sql import functions as F

from ratewise import session


def test_scratch_is_under_the_checkpoint_folder_and_goes(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    path = session.scratch_path(spark, "unit")
    assert path.startswith(root)
    spark.range(3).write.parquet(path)
    assert os.path.exists(path)
    assert session.clear_scratch(spark) >= 1
    assert not os.path.exists(path)


def test_without_a_checkpoint_folder_the_warehouse_is_used(spark, monkeypatch):
    real = session._setting
    monkeypatch.setattr(session, "_setting", lambda s, k: None if k == "spark.checkpoint.dir" else real(s, k))
    assert session.checkpoint_dir(spark).startswith(real(spark, "spark.sql.warehouse.dir").rstrip("/"))


def test_library_makes_no_folder_of_its_own():
    for file in Path(session.__file__).parent.rglob("*.py"):
        text = file.read_text()
        assert "tempfile" not in text and "localCheckpoint" not in text and "/tmp" not in text, file


def test_a_stored_table_leaves_no_shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        blocks = disk.getAllBlocks()
        return {n for n in (blocks.apply(i).name() for i in range(blocks.size())) if n.startswith("shuffle_")}

    before, was = shuffles(), spark.conf.get(session.FREE_SHUFFLES)
    out = session.stored(spark.range(1000).repartition(5, "id").groupBy((F.col("id") % 7).alias("k")).count(), "unit")
    for _ in range(100):  # Spark deletes them beside the query
        if shuffles() <= before:
            break
        time.sleep(0.1)
    assert shuffles() <= before and out.count() == 7 and spark.conf.get(session.FREE_SHUFFLES) == was


def test_a_finished_table_stands_alone(spark):
    made = []

    def make():
        made.append(session.stored(spark.range(9), "inner"))
        return made[0].where("id > 3")

    out = session.finished(make, "outer")
    assert out.count() == 5
    assert not os.path.exists(made[0].inputFiles()[0].removeprefix("file:"))
