"""Sinks: staged publication with a commit point, content-addressed assets, upserts, page caches, audits."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def publish(outputs: dict[str, DataFrame], target: str, commit: str) -> None:
    """Outputs as JSON below `target`: all are staged first, then renamed, `commit` last: a reader that finds it
    finds the rest. Nothing is overwritten; if a step fails, what was renamed and staged is taken back. Renames are atomic
    on file systems, not on object stores, where the commit output's marker file is the commit point."""
    spark = next(iter(outputs.values())).sparkSession
    order = [n for n in outputs if n != commit] + [commit]
    if taken := [n for n in order if exists(spark, f"{target}/{n}")]:
        raise FileExistsError(f"published already: {', '.join(taken)}")
    stage, moved = f"{target}/.staged-{uuid.uuid4().hex}", []
    fs, root = _fs(spark, target)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    try:
        for n in order:
            outputs[n].write.json(f"{stage}/{n}")
        fs.mkdirs(root)
        for n in order:
            if not fs.rename(path(f"{stage}/{n}"), path(f"{target}/{n}")):
                raise OSError(f"can't move {n}")
            moved.append(n)
    except Exception:
        for n in moved:
            fs.delete(path(f"{target}/{n}"), True)
        raise
    finally:
        fs.delete(path(stage), True)


def kb_export(entries: DataFrame, blocks: DataFrame, metadata: DataFrame) -> DataFrame:
    """One nested row a document: fileMetadata and entries with their blocks, in order."""
    b = blocks.groupBy("document_id", "entryId").agg(F.transform(F.array_sort(F.collect_list(F.struct("block_seq", F.struct(*[c for c in blocks.columns if c not in ("document_id", "entryId", "block_seq")]).alias("b")))), lambda x: x["b"]).alias("blocks"))
    e = entries.join(b, ["document_id", "entryId"], "left")
    own = e.groupBy("document_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("position", "entryId", F.struct(*[c for c in e.columns if c != "document_id"]).alias("e")))), lambda x: x["e"]).alias("entries"))
    return metadata.withColumnRenamed("fileId", "document_id").join(own, "document_id", "left").select(F.struct(F.col("document_id").alias("fileId"), *[c for c in metadata.columns if c != "fileId"]).alias("fileMetadata"), "entries")


def assets(rows: DataFrame, content: str = "content", ext: str = "ext") -> DataFrame:
    """Each distinct content once, with its name img_{sha256[:32]}.{ext}."""
    own = rows.withColumn("sha256", F.sha2(F.col(content), 256)).dropDuplicates(["sha256"])
    return own.withColumn("name", F.concat(F.lit("img_"), F.substring("sha256", 1, 32), F.lit("."), F.col(ext)))


def upsert(current: DataFrame, changes: DataFrame, key: str = "entry_id", rising: tuple[str, ...] = ("images_count",)) -> DataFrame:
    """Changes win, column by column where they aren't null; `rising` columns never fall."""
    other = [c for c in current.columns if c != key]
    both = current.alias("a").join(changes.alias("b"), key, "full_outer")
    pick = lambda c: F.greatest(f"a.{c}", f"b.{c}") if c in rising else F.coalesce(f"b.{c}", f"a.{c}")
    return both.select(key, *[pick(c).alias(c) for c in other])


def store_pages(pages: DataFrame, path: str) -> None:
    """A page cache, partitioned by input and strategy; only partitions that are written are replaced."""
    pages.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("input_sha256", "strategy").parquet(path)


def audit(rows: DataFrame, path: str) -> None:
    """A CSV with a header line."""
    rows.write.option("header", True).option("escape", '"').csv(path)


def without_audit(rows: DataFrame, fields: tuple[str, ...] = ("semanticAudit", "qualityMetrics")) -> DataFrame:
    """K07."""
    return rows.drop(*fields)


def unreferenced_files(files: DataFrame, referenced: DataFrame) -> DataFrame:
    """Files whose base name nothing refers to: listed, never deleted here."""
    name = lambda c: F.lower(F.element_at(F.split(c, "/"), -1))
    return files.withColumn("__n", name(F.col("path"))).join(referenced.select(name(F.col("uri")).alias("__n")).distinct(), "__n", "left_anti").drop("__n")


def manifest(items: DataFrame) -> DataFrame:
    """Items numbered by (kind, page), with the file name that gives."""
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy("document_id", "kind", "page_number").orderBy("seq"))
    return items.withColumn("out_file", F.concat("kind", F.lit("_p"), F.lpad(F.col("page_number").cast("string"), 3, "0"), F.lit("_"), n.cast("string"), F.lit(".png")))


def without_inline_payloads(rows: DataFrame, uri: str = "uri") -> DataFrame:
    """Pictures that were put into a field as data: addresses are taken out."""
    return rows.withColumn(uri, F.when(~F.lower(F.col(uri)).startswith("data:"), F.col(uri)))
