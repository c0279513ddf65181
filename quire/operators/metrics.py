"""Counts, quality figures, diffs between runs, contract checks, adjudication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import compact, squeeze, strip, text_or_empty


def page_route(pages: DataFrame, text: str = "text") -> DataFrame:
    """Characters that aren't white space, and native or ocr by 32 of them."""
    n = F.coalesce(F.length(compact(F.col(text))), F.lit(0)).cast("long")
    return pages.withColumns({"native_chars": n, "route": F.when(n >= 32, "native").otherwise("ocr")})


def coverage(pages: DataFrame, by: str, text: str = "text") -> DataFrame:
    """Share of a group's pages that have text."""
    n = F.coalesce(F.length(compact(F.col(text))), F.lit(0))
    return pages.groupBy(by).agg(F.count("*").alias("pages"), F.round(F.avg((n > 0).cast("int")), 9).alias("coverage"))


def kb_metrics(entries: DataFrame, blocks: DataFrame, assets: DataFrame) -> DataFrame:
    """Name, value: entries, pages, blocks by role, distinct and repeated assets, characters. Entries, blocks and assets
    are aggregated each by itself, so nothing is joined."""
    part = lambda d, pairs: d.agg(*[c.cast("double").alias(n) for n, c in pairs]).select(F.explode(F.create_map(*[x for n, _ in pairs for x in (F.lit(n), F.col(n))])).alias("name", "value"))
    one = part(entries, [("entries", F.count("*")), ("pages", F.countDistinct("page_number")), ("text_chars", F.coalesce(F.sum(F.length(squeeze(strip(text_or_empty(F.col("content")))))), F.lit(0))), ("empty_entries", F.count_if(strip(text_or_empty(F.col("content"))) == ""))])
    two = part(blocks, [("blocks", F.count("*")), ("headings", F.count_if(F.col("role") == "heading")), ("bodies", F.count_if(F.col("role") == "body"))])
    three = part(assets, [("assets", F.count("uri")), ("distinct_assets", F.countDistinct("uri")), ("repeated_assets", F.count("uri") - F.countDistinct("uri"))])
    return one.union(two).union(three)


def named_values(rows: DataFrame, values: dict[str, Column]) -> DataFrame:
    """One aggregate as rows name, value."""
    own = rows.agg(*[c.cast("double").alias(n) for n, c in values.items()])
    return own.select(F.explode(F.create_map(*[x for n in values for x in (F.lit(n), F.col(n))])).alias("name", "value"))


def block_counters(blocks: DataFrame, associations: DataFrame | None = None, references: DataFrame | None = None) -> DataFrame:
    """A03, the counters of blocks: tables by structure, cells, pictures by where they came from, missing and repeated assets;
    of links between figures and texts, and of references, where there are any: a count that wasn't made is no zero.

    blocks: type, image_uri, asset_status, asset_source, structured, cells (filled ones). associations: figure_id, kind,
    source. references: status, target_id. Each is aggregated by itself.
    """
    table, picture = F.col("type") == "table", F.col("type").isin("image", "figure")
    uri = F.coalesce("image_uri", F.lit(""))
    structured, gone = F.coalesce("structured", F.lit(False)), (F.coalesce("asset_status", F.lit("")) == "missing") | (uri == "")
    there = F.when(picture & ~gone, uri)
    out = named_values(blocks, {
        "tables": F.count_if(table), "tables_structured": F.count_if(table & structured), "tables_image_only": F.count_if(table & ~structured), "table_cells": F.coalesce(F.sum(F.when(table & structured, F.col("cells"))), F.lit(0)),
        "table_assets_missing": F.count_if(table & (uri == "")), "images": F.count_if(picture), "images_missing": F.count_if(picture & gone), "images_embedded": F.count_if(there.isNotNull() & (F.col("asset_source") == "embedded")),
        "images_cropped": F.count_if(there.isNotNull() & (F.col("asset_source") == "page_crop")), "image_uris": F.countDistinct(there), "image_uris_repeated": F.count(there) - F.countDistinct(there),
    })
    if associations is not None:
        read, kind = F.coalesce("source", F.lit("")) == "ocr", F.col("kind")
        of = lambda test: (F.countDistinct(F.when(test, F.col("figure_id"))), F.count_if(test))
        caption, legend, seen = of((kind == "caption") & ~read), of((kind == "legend") & ~read), of((kind == "caption") & read)
        out = out.union(named_values(associations, {"figures_with_native_caption": caption[0], "native_captions_linked": caption[1], "figures_with_native_legend": legend[0], "native_legends_linked": legend[1], "figures_with_ocr_caption": seen[0], "ocr_captions_linked": seen[1]}))
    if references is not None:
        is_ = lambda name: F.col("status") == name
        out = out.union(named_values(references, {"references": F.count("*"), "references_resolved": F.count_if(is_("resolved")), "references_unresolved": F.count_if(is_("unresolved")), "references_ambiguous": F.count_if(is_("ambiguous")), "referenced_figures": F.countDistinct(F.when(is_("resolved"), F.col("target_id")))}))
    return out


def entry_quality(entries: DataFrame) -> DataFrame:
    """0.35, +0.30 with a title, +0.25 with 8 characters or more, +0.10 with blocks; 0.98 at most."""
    titled, long = strip(text_or_empty(F.col("job_title"))) != "", F.length(strip(text_or_empty(F.col("content")))) >= 8
    score = F.lit(0.35) + titled.cast("int") * 0.30 + long.cast("int") * 0.25 + (F.col("n_blocks") > 0).cast("int") * 0.10
    return entries.withColumn("quality", F.bround(F.least(F.lit(0.98), score), 3))


def structure_confidence(entries: DataFrame, by: str = "document_id") -> DataFrame:
    """min(0.99, 0.1 + 0.55 * share with a title of their own + 0.35 * share with text)."""
    titled, texted = (~F.startswith("job_title", F.lit("Page "))).cast("int"), (F.length(strip(text_or_empty(F.col("content")))) >= 8).cast("int")
    return entries.groupBy(by).agg(F.round(F.least(F.lit(0.99), 0.1 + 0.55 * F.avg(titled) + 0.35 * F.avg(texted)), 6).alias("confidence"), F.count("*").alias("entries"))


def document_style(paragraphs: DataFrame, article: str, appendix: str, chapter: str, section: str) -> DataFrame:
    """A14, by patterns of one's own: how many paragraphs match each, and the style that gives."""
    n = {k: F.count_if(F.col("text").rlike(p)) for k, p in (("articles", article), ("appendices", appendix), ("chapters", chapter), ("sections", section))}
    own = paragraphs.groupBy("document_id").agg(*[c.alias(k) for k, c in n.items()])
    provisions = (F.col("articles") >= 3) | (F.col("chapters") >= 1) | (F.col("sections") >= 2)
    style = F.when((F.col("articles") >= 3) & (F.col("appendices") >= 1), "table_appended_regulatory").when(provisions, "rule_provisions").otherwise("standard_text")
    return own.withColumn("style", style)


def lines_of_words(words: DataFrame) -> DataFrame:
    """Recognised words as lines: text by x, mean confidence of known ones, and the union of boxes."""
    item = F.array_sort(F.collect_list(F.struct("x", "y", "text")))
    own = words.groupBy("figure_id", "block_num", "par_num", "line_num").agg(
        item.alias("items"), F.round(F.avg(F.when(F.col("conf") >= 0, F.col("conf"))), 6).alias("mean_confidence"),
        F.min("x").alias("x"), F.min("y").alias("y"), (F.max(F.col("x") + F.col("w")) - F.min("x")).alias("w"), (F.max(F.col("y") + F.col("h")) - F.min("y")).alias("h"),
    )
    return own.withColumn("text", F.array_join(F.transform("items", lambda i: i["text"]), " ")).drop("items")


def adjudicated(attempts: DataFrame, least: float = 60.0) -> DataFrame:
    """Of a figure's recognition attempts: reliable ones that name several labels make it ambiguous; else the best by
    confidence, then region, then segmentation mode. attempts: figure_id, label, confidence, roi, psm."""
    reliable = (F.col("confidence") >= least) & (F.col("label") != "")
    best = F.max_by(F.struct("label", "confidence"), F.struct("confidence", (-F.col("roi")).alias("r"), (-F.col("psm")).alias("p")))
    own = attempts.groupBy("figure_id").agg(F.countDistinct(F.when(reliable, F.col("label"))).alias("labels"), best.alias("best"), F.count("*").alias("attempts"))
    status = F.when(F.col("labels") > 1, "ambiguous_multiple_labels").when(F.col("best.label") == "", "empty").when(F.col("labels") == 1, "linked").otherwise("rejected")
    return own.select("figure_id", status.alias("status"), F.when(status == "linked", F.col("best.label")).alias("label"), "attempts")


def shadow_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Name, old, new, delta, compared: metrics of both sides are compared, those of one side listed as skipped."""
    both = old.select("name", F.col("value").alias("old")).join(new.select("name", F.col("value").alias("new")), "name", "full_outer")
    known = F.col("old").isNotNull() & F.col("new").isNotNull()
    return both.withColumns({"delta": F.when(known, F.col("new") - F.col("old")), "compared": known})


def mismatches(report: DataFrame, data: DataFrame) -> DataFrame:
    """Counters that a report and the data don't agree on; missing ones count."""
    both = report.select("name", F.col("value").alias("reported")).join(data.select("name", F.col("value").alias("counted")), "name", "full_outer")
    return both.where(~F.col("reported").eqNullSafe(F.col("counted")))


def violations(rows: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """Key and rule of each row that breaks a rule; a rule that is null counts as broken. One pass for all rules."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in rules.items()]))
    return rows.select(F.col(key), F.explode(broken).alias("rule"))


def outcome_counts(rows: DataFrame, outcome: str = "outcome") -> DataFrame:
    """A18."""
    return rows.groupBy(outcome).agg(F.count("*").alias("n"))


def overall_status(sides: DataFrame) -> DataFrame:
    """Ok if all sides are, failed if none is, else partial."""
    return sides.groupBy("run_id").agg(F.when(F.every(F.col("status") == "ok"), "ok").when(F.some(F.col("status") == "ok"), "partial").otherwise("failed").alias("status"))


def first_by_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """A10: the first row of each key in a given order."""
    return rows.withColumn("__r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__r = 1").drop("__r")


def within_budget(rows: DataFrame, by: str, order: list[Column], budget: int) -> DataFrame:
    """The first `budget` candidates of each group."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order)).cast("long")).where(F.col("rank") <= budget)


def digest(entries: DataFrame, by: str = "document_id") -> DataFrame:
    """sha256 of a group's normalised texts in order of position; the same for any order of the input."""
    item = F.array_sort(F.collect_list(F.struct("position", squeeze(strip(text_or_empty(F.col("content")))).alias("t"))))
    return entries.groupBy(by).agg(item.alias("i")).select(by, F.sha2(F.array_join(F.transform("i", lambda x: x["t"]), "\n"), 256).alias("sha256"))


def compared(old: DataFrame, new: DataFrame) -> DataFrame:
    """Documents of two snapshots (digest()'s rows, or any with document_id and sha256): same, changed, only_old, only_new."""
    both = old.select("document_id", F.col("sha256").alias("before")).join(new.select("document_id", F.col("sha256").alias("after")), "document_id", "full_outer")
    return both.select("document_id", F.when(F.col("after").isNull(), "only_old").when(F.col("before").isNull(), "only_new").when(F.col("before") == F.col("after"), "same").otherwise("changed").alias("status"))


def preliminary(entries: DataFrame) -> DataFrame:
    """Covers and tables of contents are kept out of search; weights 0, 0.15 and 1.

    A page is preliminary if none of its blocks is numbered and it looks like a table of contents (three dotted leaders) or
    is one of the first three pages with two lines of text at most.
    """
    leaders = F.regexp_count(F.col("content"), F.lit(r"[.·…]{4,}\s*[0-9]+"))
    lines = F.size(F.filter(F.split("content", "\n"), lambda x: strip(x) != ""))
    numbered = F.col("content").rlike(r"(?m)^[0-9]{1,3}[.、)]")
    toc = leaders >= 3
    cover = (F.col("page_number") <= 3) & (lines <= 2)
    pre = ~numbered & (toc | cover)
    return entries.withColumns({"preliminary": pre, "search_weight": F.when(pre & toc, 0.0).when(pre, 0.15).otherwise(1.0)})


def semantic_audit(blocks: DataFrame) -> DataFrame:
    """Of each document: blocks, those without a role, headings, artifacts, captions, and suspicious texts."""
    from quire.functions.text import suspicion

    role = text_or_empty(F.col("role"))
    counts = {"blocks": F.count("*"), "without_role": F.count_if(role == ""), "headings": F.count_if(role == "heading"), "artifacts": F.count_if(role == "artifact"), "captions": F.count_if(role == "caption"), "suspicious": F.count_if(suspicion(F.col("text"))["score"] >= 4.0)}
    return blocks.groupBy("document_id").agg(*[c.alias(n) for n, c in counts.items()])


def category_index(entries: DataFrame, category: str = "category") -> DataFrame:
    """Entries, documents and characters of each category; a blank one counts as none."""
    name = F.coalesce(F.nullif(strip(text_or_empty(F.col(category))), F.lit("")), F.lit("none"))
    return entries.groupBy(name.alias("category")).agg(F.count("*").alias("entries"), F.countDistinct("document_id").alias("documents"), F.coalesce(F.sum(F.length("content")), F.lit(0)).alias("chars"))


def visual_documents(blocks: DataFrame) -> DataFrame:
    """Whether a document has a block with a picture or a table."""
    seen = (strip(text_or_empty(F.col("uri"))) != "") | F.lower(text_or_empty(F.col("kind"))).isin("image", "figure", "table")
    return blocks.groupBy("document_id").agg(F.some(seen).alias("has_visuals"))
