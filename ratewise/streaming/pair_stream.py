"""Score pair files as they arrive, with the item-kNN plan of Q1.

The reference is batch-only; this is the same operator fed by a Structured Streaming file
source. Each micro-batch of new pair rows is joined against the static training ratings inside
``foreachBatch`` and appended to a parquet sink. Progress (which files were consumed) lives in the
checkpoint location under the session's ``spark.checkpoint.dir``, so a restarted query resumes
where it stopped; the sink path is keyed by batch id so a replayed batch overwrites its own
output instead of duplicating it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ratewise.operators import neighbours
from ratewise.session import cut_lineage, scratch_path
from ratewise.sources import schemas


def score_pair_stream(spark: SparkSession, train: DataFrame, source_dir: str, sink_dir: str,
                      min_overlap: int = 75, checkpoint_location: str | None = None,
                      available_now: bool = True, max_files_per_trigger: int | None = None,
                      processing_time: str = "10 seconds"):
    """Start the streaming query and return its handle. The ratings are written once to the shared
    scratch folder, so that every batch reads the same table; a batch computes the similarities that
    its own pairs need, which stays safe for users of any degree."""
    train = cut_lineage(train.select("user_id", "business_id", "stars"))
    reader = spark.readStream.schema(schemas.PAIRS).option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    pairs = reader.csv(source_dir)

    def score(batch: DataFrame, batch_id: int) -> None:
        pred = neighbours.knn_predict(train, batch, min_overlap=min_overlap)
        pred.write.mode("overwrite").parquet(f"{sink_dir.rstrip('/')}/batch={batch_id}")

    writer = (pairs.writeStream.foreachBatch(score)
              .option("checkpointLocation", checkpoint_location or scratch_path(spark, "stream-ckpt")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
