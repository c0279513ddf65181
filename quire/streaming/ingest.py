"""Incremental ingest (an extension: the document model itself has no streams).

New document files are read as a stream, turned into entries document by document, and appended to a Parquet table, a
partition a batch, in foreachBatch. A batch that runs twice replaces its own partition, so it gives the same table; readers
take each document's last batch, and no batch rewrites what is there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quire.operators.adapters import line_blocks
from quire.operators.segment import entries
from quire.plans.publish import exists


def documents_stream(spark: SparkSession, path: str, schema: str = "doc_id long, text string, lang string, source string, n_chars long", files_per_batch: int = 8) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def entries_of(docs: DataFrame) -> DataFrame:
    from pyspark.sql import functions as F

    blocks = line_blocks(docs).select("document_id", "page_number", "reading_order", F.concat(F.lit("b"), F.col("reading_order").cast("string")).alias("id"), F.lit("body").alias("role"), "text")
    return entries(blocks, "page")


def ingest(docs: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Runs over what there is and stops. Each batch's entries go to a partition of its own; the latest batch of a
    document wins when the table is read by latest()."""
    def store(batch: DataFrame, number: int) -> None:
        entries_of(batch).write.mode("overwrite").parquet(f"{table}/batch={number}")

    return docs.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(spark: SparkSession, table: str) -> DataFrame:
    """The entries of each document's last batch."""
    from pyspark.sql import functions as F

    if not exists(spark, table):
        raise FileNotFoundError(table)
    every = spark.read.parquet(table)
    last = every.groupBy("document_id").agg(F.max("batch").alias("batch"))
    return every.join(last, ["document_id", "batch"], "left_semi").drop("batch")
