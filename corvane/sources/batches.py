"""Arrow batches on their way to Python workers, bounded by bytes as well as by rows."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Rows and bytes of a batch at most.
ROWS, BYTES = 4096, 8 << 20
_ROWS_KEY, _BYTES_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded(spark: SparkSession | None = None) -> None:
    """Lowers the session's bounds of Arrow batches to these, where they are higher, so that a worker holds a few batches of long texts and not ten thousand of them."""
    spark = spark or SparkSession.getActiveSession()
    if spark is None:
        return
    if not 0 < int(spark.conf.get(_ROWS_KEY)) <= ROWS:
        spark.conf.set(_ROWS_KEY, str(ROWS))
    if not spark.conf.get(_BYTES_KEY).rstrip("b").isdigit() or not 0 < int(spark.conf.get(_BYTES_KEY).rstrip("b")) <= BYTES:
        spark.conf.set(_BYTES_KEY, str(BYTES))
