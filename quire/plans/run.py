"""python -m quire.plans.run --input DIR --out DIR [--mode v2|legacy|shadow --profile full|smoke --start-page N --max-pages N]

DOCX files to a published knowledge base. Mode legacy has one entry a paragraph style finds (docx_entries), v2 has headings
open entries (segment.entries), shadow builds both, publishes legacy's, and reports where their figures differ. Profile smoke
takes two pages, unless --max-pages says otherwise.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions.captions import cluster_key, content_type, document_role
from quire.functions.text import strip
from quire.operators import docx_entries, metrics, segment
from quire.operators.tables import markdown
from quire.plans import publish
from quire.sources import docx


def pages_between(rows: DataFrame, start: int | None = None, most: int | None = None) -> DataFrame:
    """S18."""
    first = start or 1
    rows = rows.where(F.col("page_number") >= first)
    return rows if most is None else rows.where(F.col("page_number") < first + most)


Transform = Callable[[DataFrame], DataFrame]
STYLES: dict[str, Transform] = {}


def style(tag: str) -> Callable[[Transform], Transform]:
    """Names a transform from blocks to entries (document_id, entry_id, position, page_number, kind, job_title, content, n_blocks)."""
    def add(f: Transform) -> Transform:
        STYLES[tag] = f
        return f

    return add


def parser(tag: str) -> Transform:
    if tag not in STYLES:
        raise KeyError(f"no parser for {tag!r}; there are {', '.join(sorted(STYLES))}")
    return STYLES[tag]


@style("legacy")
def by_paragraphs(blocks: DataFrame) -> DataFrame:
    own = docx_entries.entries(blocks)
    return own.withColumns({"document_id": F.col("path"), "job_title": F.col("title"), "n_blocks": F.lit(1).cast("long")}).drop("path", "title")


@style("v2")
def by_headings(blocks: DataFrame) -> DataFrame:
    table = F.col("kind") == "table"
    pages = F.sum("page_breaks").over(Window.partitionBy("path").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)) + 1
    own = blocks.withColumn("page_number", pages.cast("long")).where(table | (strip(F.col("text")) != ""))
    grid = markdown(F.coalesce("rows", F.array().cast("array<array<string>>")))
    rows = own.select(
        F.col("path").alias("document_id"), "page_number", F.col("seq").cast("long").alias("reading_order"), F.concat(F.lit("b"), F.col("seq").cast("string")).alias("id"),
        F.when(~table, document_role(F.col("text"))).alias("role"), "text", F.when(table, "table").otherwise("text").alias("type"), F.when(table, grid).alias("markdown"),
    )
    return segment.entries(rows, "heading").drop("block_ids")


def finished(own: DataFrame) -> dict[str, DataFrame]:
    scored = metrics.entry_quality(own.withColumns({"content_type": content_type(F.col("kind")), "cluster": cluster_key(F.col("job_title"))}))
    return {"report": metrics.structure_confidence(scored), "kb": scored}


def build(spark: SparkSession, folder: str, start: int | None = None, most: int | None = None, mode: str = "legacy") -> dict[str, DataFrame]:
    """ir: blocks as read. kb: entries with their quality and kind. report: entries by file, and their structure's confidence.
    shadow (of that mode): figures of both ways, and how far apart they are."""
    blocks = docx.read_blocks(spark, folder)
    made = finished(pages_between(parser("v2" if mode == "v2" else "legacy")(blocks), start, most))
    if mode == "shadow":
        other = pages_between(parser("v2")(blocks), start, most)
        figures = lambda own: metrics.named_values(own, {"entries": F.count("*"), "documents": F.countDistinct("document_id"), "characters": F.coalesce(F.sum(F.length("content")), F.lit(0))})
        made["shadow"] = metrics.shadow_diff(figures(made["kb"]), figures(other))
    return {"ir": blocks, **made}


def main(argv: list[str] | None = None) -> None:
    parser_ = argparse.ArgumentParser(description=__doc__)
    for name in ("--input", "--out"):
        parser_.add_argument(name, required=True)
    parser_.add_argument("--mode", choices=("legacy", "v2", "shadow"), default="legacy")
    parser_.add_argument("--profile", choices=("full", "smoke"), default="full")
    parser_.add_argument("--start-page", type=int)
    parser_.add_argument("--max-pages", type=int)
    args = parser_.parse_args(argv)
    most = args.max_pages if args.max_pages is not None else 2 if args.profile == "smoke" else None
    spark = SparkSession.builder.appName("quire").getOrCreate()
    publish.publish(build(spark, args.input, args.start_page, most, args.mode), args.out, "kb")


if __name__ == "__main__":
    main()
