"""Entries of DOCX blocks, as a running group instead of a state machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.roles import anchor, heading
from quire.functions.text import strip
from quire.operators.tables import markdown


def style(blocks: DataFrame) -> DataFrame:
    """table_appended_regulatory, rule_provisions or standard_text, by a document's anchors and headings."""
    h, a = heading(F.col("text")), anchor(F.col("text"))
    numbered = h["number"].rlike(r"^[0-9]+\.[0-9]+$")
    n = {"articles": F.count_if(a["kind"] == "article"), "appendices": F.count_if(a["kind"] == "appendix"), "chapters": F.count_if(F.col("text").rlike(r"^第\s*[0-9一二三四五六七八九十百千〇零两]+\s*[章节]")), "sections": F.count_if(numbered)}
    own = blocks.where("kind = 'paragraph'").groupBy("path").agg(*[c.alias(k) for k, c in n.items()])
    provisions = (F.col("articles") >= 3) | (F.col("chapters") >= 1) | (F.col("sections") >= 2)
    return own.withColumn("style", F.when((F.col("articles") >= 3) & (F.col("appendices") >= 1), "table_appended_regulatory").when(provisions, "rule_provisions").otherwise("standard_text"))


def entries(blocks: DataFrame) -> DataFrame:
    """path, position, page_number, kind, title, content of the entries of read_blocks()'s rows.

    A page break begins a page and an entry; a chapter or section heading is an entry of its own and the title of those
    after it; a table is one, as Markdown; other paragraphs that follow each other are one, joined by empty lines.
    """
    order = Window.partitionBy("path").orderBy("seq")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    h = heading(F.col("text"))
    own = blocks.withColumn("page_number", F.sum("page_breaks").over(so_far) + 1)
    own = own.where((F.col("kind") == "table") | (strip(F.col("text")) != ""))
    alone = F.when(F.col("kind") == "table", "table").when(h["level"].isin("chapter", "section"), "heading").otherwise("text")
    own = own.withColumns({"part": alone, "told": F.when(alone == "heading", F.col("text"))})
    new = (F.col("part") != "text") | F.coalesce(F.lag("part").over(order) != "text", F.lit(True)) | (F.lag("page_number").over(order) != F.col("page_number"))
    own = own.withColumn("new", new).withColumns({"position": F.sum(F.col("new").cast("long")).over(so_far) - 1, "above": F.last("told", ignorenulls=True).over(before)})
    item = F.array_sort(F.collect_list(F.struct("seq", F.when(F.col("kind") == "table", markdown(F.coalesce("rows", F.array().cast("array<array<string>>")))).otherwise(F.col("text")).alias("t"))))
    out = own.groupBy("path", "position").agg(F.min("page_number").alias("page_number"), F.min("part").alias("part"), F.min("told").alias("told"), F.min_by("above", "seq").alias("above"), item.alias("items"))
    title = F.when(F.col("part") == "table", "").otherwise(F.coalesce("told", "above", F.lit("")))
    return out.select("path", "position", "page_number", F.when(F.col("part") == "table", "table").otherwise("text").alias("kind"), title.alias("title"), F.array_join(F.transform("items", lambda i: i["t"]), "\n\n").alias("content"))
