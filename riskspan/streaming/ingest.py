"""File-stream ingestion of CVE documents (S3 -> Q2, incrementally)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _write(batch: DataFrame, batch_id: int, out_path: str, rejects_path: str, clean) -> None:
    """A batch owns the folder of its number, so a replayed batch writes the
    same folder again instead of a second copy."""
    docs = batch.select(F.col("value").alias("doc"))
    good = F.try_parse_json("doc").isNotNull()
    clean(docs.where(good)).write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")
    docs.where(~good).write.mode("overwrite").parquet(f"{rejects_path}/batch={batch_id}")


def start_cve_ingest(spark: SparkSession, in_path: str, out_path: str, clean, checkpoint: str,
                     rejects_path: str | None = None, glob: str = "CVE-*.json",
                     max_files_per_trigger: int = 10000, available_now: bool = True):
    """Watch ``in_path`` for new JSON documents and write ``clean(docs)``
    (a DataFrame -> DataFrame function over a ``doc`` text column) to
    ``out_path`` as Parquet, one folder per batch; documents that are not JSON
    go to ``rejects_path`` (default: ``out_path`` with ``-rejects``).

    ``checkpoint`` names the folder that keeps the progress: a restart with
    the same folder goes on where the last run stopped.  ``available_now``
    processes the backlog in bounded batches and stops (a scheduled catch-up
    job); pass False for a continuously running query.
    """
    rejects = rejects_path or f"{out_path.rstrip('/')}-rejects"
    stream = (spark.readStream.format("text").option("wholetext", "true")
              .option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
              .option("maxFilesPerTrigger", max_files_per_trigger).load(in_path))
    w = (stream.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda b, n: _write(b, n, out_path, rejects, clean)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
