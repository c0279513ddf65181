"""Deterministic views that give the driver's tables the shapes of the document model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.operators.groups import dealt


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def line_blocks(documents: DataFrame) -> DataFrame:
    """Lines as text blocks, eight to a page; empty ones are left out."""
    lines = documents.select(F.col("doc_id").alias("document_id"), "source", F.posexplode(F.split("text", "\n")).alias("pos", "raw"))
    out = lines.select("document_id", "source", (F.col("pos") + 1).cast("long").alias("reading_order"), F.floor(F.col("pos") / 8).cast("long").alias("p"), F.btrim("raw", F.lit(" \t\n\x0b\f\r")).alias("text"))
    return out.where("text <> ''").withColumn("page_number", F.col("p") + 1).drop("p")


def turn_blocks(conversations: DataFrame) -> DataFrame:
    """Turns as blocks on one page: what the user says is a heading."""
    return conversations.select(
        F.col("conv_id").alias("document_id"), F.lit(1).cast("long").alias("page_number"), F.col("turn").cast("long").alias("reading_order"),
        F.concat(F.lit("b"), F.col("turn").cast("string")).alias("id"), F.when(F.col("role") == "user", "heading").otherwise("body").alias("role"), "text",
    )


def boxes(lineitem: DataFrame) -> DataFrame:
    """Line items as a synthetic layout: figures, captions and texts on two pages an order."""
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")
    return lineitem.withColumn("seq", F.row_number().over(order)).select(
        F.col("l_orderkey").alias("document_id"), (F.col("l_linenumber") % 2 + 1).cast("long").alias("page_number"), F.col("seq").cast("long").alias("seq"),
        F.when(F.col("l_returnflag") == "R", "figure").when(F.col("l_returnflag") == "A", "caption").otherwise("text").alias("kind"),
        (F.col("l_partkey") % 500).cast("long").alias("x"), (F.col("l_suppkey") % 700).cast("long").alias("y"),
        (F.col("l_quantity") + 20).cast("long").alias("w"), (F.col("l_linenumber") * 7 + 10).cast("long").alias("h"),
        F.col("l_extendedprice").alias("score"),
    )


def mixed_blocks(lineitem: DataFrame) -> DataFrame:
    """Line items as blocks of all kinds: document is the supplier; texts of each role, tables with and without cells, pictures with and without files."""
    order = Window.partitionBy("l_suppkey").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate")
    k = F.col("l_partkey") % 10
    return dealt(lineitem, "l_suppkey").withColumn("n", F.row_number().over(order)).select(
        F.col("l_suppkey").alias("document_id"), (F.col("l_orderkey") % 97 + 1).cast("long").alias("page_number"), F.col("n").cast("long").alias("reading_order"), F.concat(F.lit("b"), F.col("n").cast("string")).alias("id"),
        F.when(k <= 1, "heading").when(k <= 4, "legend").when(k == 5, "artifact").otherwise("body").alias("role"), F.when(F.col("l_quantity") == 7, "").otherwise(F.concat(F.lit("p"), F.col("l_partkey").cast("string"))).alias("text"),
        F.when(F.col("l_linenumber") == 3, "table").when(F.col("l_linenumber") >= 5, "figure").otherwise("text").alias("type"), F.when(F.col("l_suppkey") % 2 == F.col("l_linenumber") % 2, F.lit("uri")).alias("image_uri"),
        F.when(F.col("l_quantity") > 40, "missing").alias("asset_status"), F.when(k < 7, F.lit("|t|")).alias("markdown"),
    )


def references(lineitem: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Figures with a label, and blocks that refer to one: document is the supplier, label the part modulo 40."""
    order = Window.partitionBy("l_suppkey").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate")
    own = dealt(lineitem, "l_suppkey").withColumn("seq", F.row_number().over(order)).select(
        F.col("l_suppkey").alias("document_id"), (F.col("l_orderkey") % 30).cast("long").alias("page_number"), F.col("seq").cast("long").alias("block_id"),
        F.concat(F.lit("F"), (F.col("l_partkey") % 40).cast("string")).alias("label"), (F.col("l_linenumber") == 1).alias("is_figure"),
        (F.col("l_partkey") % 500).cast("double").alias("cx"), F.col("l_quantity").alias("cy"),
    )
    return own.where("is_figure").drop("is_figure"), own.where("not is_figure").drop("is_figure")


def cells(lineitem: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two versions of a table for each order: cells by line number; the second moves, changes and drops some."""
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")
    own = lineitem.withColumn("n", F.row_number().over(order).cast("long")).select(
        F.col("l_orderkey").alias("table_id"), (F.col("n") - 1).alias("row"), F.lit(0).cast("long").alias("col"), F.lit(1).cast("long").alias("row_span"), F.lit(1).cast("long").alias("col_span"), F.col("l_partkey").cast("string").alias("text"), "l_quantity",
    )
    q = F.col("l_quantity").cast("long")
    other = own.where(q % 7 != 0).withColumns({"text": F.when(q % 5 == 0, F.concat("text", F.lit("x"))).otherwise(F.col("text")), "col_span": F.when(q % 11 == 0, 2).otherwise(1).cast("long"), "row": F.when(q % 13 == 0, F.col("row") + 100).otherwise(F.col("row"))})
    return own.drop("l_quantity"), other.drop("l_quantity")


def html_blocks(pages: DataFrame) -> DataFrame:
    """Headings, paragraphs, navigation and footers of raw pages, in the order they stand in."""
    found = F.regexp_extract_all("html", F.lit(r"(?s)<(h1|p|nav|footer)[ >].*?</(?:h1|p|nav|footer)>"), 0)
    rows = pages.select(F.col("page_id").alias("document_id"), F.posexplode(found).alias("pos", "raw"))
    tag = F.regexp_extract("raw", r"^<([a-z0-9]+)", 1)
    text = F.regexp_replace(F.regexp_replace(F.regexp_replace("raw", r"(?s)<[^>]*>", " "), r"\s+", " "), r"^ | $", "")
    return rows.select("document_id", F.lit(1).cast("long").alias("page_number"), (F.col("pos") + 1).cast("long").alias("reading_order"), F.when(tag == "h1", "heading").when(tag == "p", "body").otherwise("artifact").alias("role"), text.alias("text"))
