"""Size of the batches in which rows go to Python."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: A batch is copied several times on its way (vectors, stream, Python), in every task.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Let the session send rows to Python in batches of about ``BATCH_BYTES``.

    Spark's own limit is 64 MB of rows. A longer row is a batch of its own. Operators that
    pass whole texts call this first; it holds for the session, as plans run later.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
