"""What repeats over a document's pages: printed page watermarks, running headers and footers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.geometry import Box
from quire.functions.roles import page_marker
from quire.functions.text import WATERMARK_GAP, compact, strip, watermark_compact, watermark_like, watermark_plausible


def page_counts(lines: DataFrame) -> DataFrame:
    return lines.groupBy("document_id").agg(F.countDistinct("page_number").alias("pages"))


def watermark_threshold(pages: Column) -> Column:
    return F.greatest(F.lit(3), F.least(F.lit(12), F.floor((pages + 9) / 10)))


def signature_threshold(pages: Column) -> Column:
    return F.greatest(F.lit(3), F.least(F.lit(40), F.floor((pages + 4) / 5)))


def watermarks(lines: DataFrame, plausible_only: bool = True) -> DataFrame:
    """Normalised lines on max(3, min(12, ceil(pages / 10))) pages at least. lines: document_id, page_number, text.

    Distinct (line, page) pairs are found before they are counted, so a line on every page is summed map-side.
    """
    # any other character: what is left is no empty line, and that needs no second normalisation
    own = lines.where(watermark_plausible(F.col("text")) if plausible_only else F.col("text").rlike(f"[^{WATERMARK_GAP}]"))
    own = own.select("document_id", "page_number", watermark_compact(F.col("text")).alias("line")).distinct()
    hits = own.groupBy("document_id", "line").agg(F.count("*").alias("n_pages"))
    joined = hits.join(page_counts(lines), "document_id")
    return joined.where(F.col("n_pages") >= watermark_threshold(F.col("pages"))).select("document_id", "line", "n_pages")


def zone(top: Column, bottom: Column, page_height: Column) -> Column:
    return F.when(bottom <= page_height * 0.06, "top").when(top >= page_height * 0.94, "bottom")


def signature(text: Column) -> Column:
    return F.regexp_replace(compact(text), r"\p{Nd}+", "#")


def dynamic_signatures(lines: DataFrame) -> DataFrame:
    """Texts of the page's edges, digits as #, on max(3, min(40, (pages + 4) // 5)) pages; documents of 3 pages or more.

    lines: document_id, page_number, zone (null: not at an edge), text.
    """
    own = lines.where("zone is not null").withColumn("sig", signature(F.col("text")))
    own = own.where(F.length(compact(F.col("text"))).between(1, 40))
    own = own.select("document_id", "page_number", F.concat("zone", F.lit("|"), "sig").alias("signature")).distinct()
    hits = own.groupBy("document_id", "signature").agg(F.count("*").alias("n_pages"))
    joined = hits.join(page_counts(lines), "document_id").where("pages > 2")
    return joined.where(F.col("n_pages") >= signature_threshold(F.col("pages"))).select("document_id", "signature", "n_pages")


def artifacts(lines: DataFrame) -> DataFrame:
    """A01 and A02 in one pass: document_id, kind (watermark or signature) and key of what repeats on pages enough.

    A line gives up to three facts, its page among them; they are made distinct and counted once, and each document's number
    of pages is one of the counts.
    """
    packed, zoned = F.length(compact(F.col("text"))), F.col("zone").isNotNull()
    fact = lambda kind, key: F.struct(F.lit(kind).alias("kind"), key.alias("key"))
    facts = F.array_compact(F.array(
        fact("page", F.lit("")), F.when(watermark_plausible(F.col("text")), fact("watermark", watermark_compact(F.col("text")))),
        F.when(zoned & packed.between(1, 40), fact("signature", F.concat("zone", F.lit("|"), signature(F.col("text"))))),
    ))
    hits = lines.select("document_id", "page_number", F.explode(facts).alias("f")).select("document_id", "page_number", "f.*").distinct().groupBy("document_id", "kind", "key").agg(F.count("*").alias("n"))
    pages = F.max(F.when(F.col("kind") == "page", F.col("n"))).over(Window.partitionBy("document_id"))
    enough = (F.col("kind") == "watermark") & (F.col("n") >= watermark_threshold(F.col("pages"))) | (F.col("kind") == "signature") & (F.col("pages") > 2) & (F.col("n") >= signature_threshold(F.col("pages")))
    return hits.withColumn("pages", pages).where(enough).select("document_id", "kind", "key")


def without_artifacts(lines: DataFrame) -> DataFrame:
    """Lines that are neither like a watermark of their document, nor page numbers (where lines have y, h and page_height),
    nor its running headers or footers. A document's watermarks are few, as each is on a share of its pages."""
    found = artifacts(lines)
    marks = found.where("kind = 'watermark'").groupBy("document_id").agg(F.collect_list("key").alias("__marks"))
    running = found.where("kind = 'signature'").select("document_id", F.col("key").alias("__sig"))
    own = lines.where(strip(F.col("text")) != "")
    if {"y", "h", "page_height"} <= set(lines.columns):
        own = own.where(~page_marker(F.col("text"), Box(F.lit(0), F.col("y"), F.lit(0), F.col("h")), F.col("page_height")))
    own = own.join(marks, "document_id", "left").where(F.col("__marks").isNull() | ~watermark_like(watermark_compact(F.col("text")), F.col("__marks"))).drop("__marks")
    edge = own.withColumn("__sig", F.when(F.col("zone").isNotNull(), F.concat("zone", F.lit("|"), signature(F.col("text")))))
    return edge.join(running, ["document_id", "__sig"], "left_anti").drop("__sig")
