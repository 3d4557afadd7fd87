"""Arrow batches for tables of long texts."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Rows of an Arrow batch between Spark and its Python workers. Spark's default of 10,000 suits numbers;
# that many texts take tens of megabytes in each task of the executor and again in its worker.
BATCH_ROWS = 256

_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def short_batches(texts: DataFrame) -> DataFrame:
    """``texts``, with its session's batches held to BATCH_ROWS; a smaller setting stays."""
    conf = texts.sparkSession.conf
    if not 0 < int(conf.get(_SETTING)) <= BATCH_ROWS:
        conf.set(_SETTING, str(BATCH_ROWS))
    return texts
