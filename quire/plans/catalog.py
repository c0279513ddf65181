"""The registered queries of the document operators, each over its whole table, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions import captions, roles
from quire.functions import geometry as geo
from quire.functions import text as tx
from quire.operators import adapters as ad
from quire.operators import align, kb, layout, metrics, references, repetition, retrieve, segment, tables
from quire.operators.groups import dealt
from quire.plans import sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}
FLAGSHIP = "w01_entries_heading"


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if oracle:
            ORACLE_SQL[name] = oracle
        return f

    return add


def lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines with their source as the document and their document as the page."""
    own = ad.line_blocks(ad.table(spark, d, "documents"))
    return own.select(F.col("source").alias("document_id"), F.col("document_id").alias("page_number"), "reading_order", "text")


def turns(spark: SparkSession, d: str) -> DataFrame:
    return ad.turn_blocks(ad.table(spark, d, "conversations"))


def line_blocks(spark: SparkSession, d: str) -> DataFrame:
    own = ad.line_blocks(ad.table(spark, d, "documents"))
    return own.withColumns({"id": F.concat(F.lit("b"), F.col("reading_order").cast("string")), "role": F.lit("body")})


def boxes(spark: SparkSession, d: str, kind: str | None = None) -> DataFrame:
    own = ad.boxes(ad.table(spark, d, "lineitem"))
    return own if kind is None else own.where(F.col("kind") == kind)


def docs(spark: SparkSession, d: str) -> DataFrame:
    return ad.table(spark, d, "documents")


def turn_entries(spark: SparkSession, d: str) -> DataFrame:
    return segment.entries(turns(spark, d), "heading")


# entries and order


def listed(own: DataFrame) -> DataFrame:
    return own.withColumn("block_ids", F.array_join("block_ids", ","))


@query("w01_entries_heading", sql.ENTRIES_HEADING)
def _(spark, d):
    return listed(turn_entries(spark, d))


@query("w01_entries_page", sql.ENTRIES_PAGE)
def _(spark, d):
    return listed(segment.entries(line_blocks(spark, d), "page"))


@query("w01_mixed_heading", sql.MIXED_HEADING)
def _(spark, d):
    return listed(segment.entries(ad.mixed_blocks(ad.table(spark, d, "lineitem")), "heading"))


@query("w01_mixed_page", sql.MIXED_PAGE)
def _(spark, d):
    return listed(segment.entries(ad.mixed_blocks(ad.table(spark, d, "lineitem")), "page"))


@query("p02_projection_class", sql.PROJECTION)
def _(spark, d):
    role = F.when(F.col("role") == "system", " Legend ").when(F.col("role") == "user", "ARTIFACT").otherwise("odd role")
    return ad.table(spark, d, "conversations").select("conv_id", "turn", roles.projection_class(role).alias("projection"))


@query("w02_reading_order", sql.READING_ORDER)
def _(spark, d):
    return segment.reading_order(boxes(spark, d)).select("document_id", "page_number", "seq", "reading_order")


@query("w03_document_order", sql.DOCUMENT_ORDER)
def _(spark, d):
    banded = boxes(spark, d).withColumn("band", F.when(F.col("x") < 250, 0).otherwise(1))
    return segment.document_order(banded).select("document_id", "page_number", "seq", "document_order")


@query("w04_gutters", sql.GUTTERS)
def _(spark, d):
    # ten orders make a page, so that there are boxes enough for two columns
    own = boxes(spark, d).withColumns({"seq": F.col("document_id") * 100 + F.col("seq"), "document_id": F.floor(F.col("document_id") / 10).cast("long")})
    return segment.gutters(own).select("document_id", "page_number", F.col("gap").cast("long").alias("gap"), "gutter_x")


@query("w05_heading_context", sql.HEADING_CONTEXT)
def _(spark, d):
    level = F.when(F.col("role") == "heading", F.element_at(F.array(F.lit("unit"), F.lit("section"), F.lit("subsection")), (F.col("reading_order") % 3 + 1).cast("int")))
    own = segment.heading_context(turns(spark, d).withColumns({"level": level, "text": F.col("id")}))
    return own.select("document_id", "reading_order", "path")


@query("w06_numbered_splits", sql.NUMBERED_SPLITS)
def _(spark, d):
    own = boxes(spark, d).select(F.col("document_id").alias("entry_id"), "seq", F.when(F.col("kind") != "text", F.col("x")).alias("number"))
    return segment.numbered_splits(own).select("entry_id", "seq", "part")


@query("w07_coalesce_pages", sql.COALESCE_PAGES)
def _(spark, d):
    return segment.coalesce_pages(turn_entries(spark, d).select("document_id", F.lit(1).cast("long").alias("page_number"), "position", "n_blocks", "content"))


@query("w08_continuations", sql.CONTINUATIONS)
def _(spark, d):
    own = boxes(spark, d).select("document_id", F.col("seq").alias("page_number"), F.col("seq").alias("position"), (F.col("x") % 3 + F.col("seq")).alias("first_number"), (F.col("x") % 3 + F.col("seq")).alias("last_number"))
    return segment.continuations(own).select("document_id", "position", "merged_into")


@query("w09_soft_wrapped", sql.SOFT_WRAPPED)
def _(spark, d):
    own = segment.soft_wrapped(F.split(F.coalesce("text", F.lit("")), "\n"))
    return docs(spark, d).select("doc_id", F.size(own).cast("long").alias("n_lines"), F.array_join(own, "\n").alias("text"))


@query("w12_rank_consistency", sql.RANK_CONSISTENCY)
def _(spark, d):
    own = segment.rank_consistency(boxes(spark, d).withColumn("key2", F.col("score") * 1000 + F.col("seq")), "document_id", "seq", "key2")
    return own.select("document_id", "seq", F.round("order_score", 6).alias("order_score"))


@query("w13_insertion_slots", sql.INSERTION)
def _(spark, d):
    own = segment.insertion_slots(boxes(spark, d).withColumn("slots", F.lit(5)), "document_id", "seq", "slots")
    return own.select("document_id", "seq", "slot")


@query("w16_next_indexes", sql.NEXT_INDEXES)
def _(spark, d):
    own = boxes(spark, d).withColumnRenamed("document_id", "entry_id")
    known = own.where("kind = 'figure'").groupBy("entry_id", "page_number").agg(F.count("*").alias("idx"))
    return segment.next_indexes(own.where("kind = 'caption'"), known).select("entry_id", "page_number", "seq", F.col("idx").cast("long").alias("idx"))


# repetition


@query("a01_repeated_lines", sql.REPEATED_LINES)
def _(spark, d):
    return repetition.watermarks(lines(spark, d), plausible_only=False)


@query("a01_watermarks", sql.WATERMARKS)
def _(spark, d):
    own = ad.table(spark, d, "events").select(F.col("event_type").alias("document_id"), (F.col("event_id") % 50).alias("page_number"), F.concat(F.lit("No. "), F.lpad((F.col("user_id") % 400).cast("string"), 4, "0"), F.lit(" - copy")).alias("text"))
    return repetition.watermarks(own)


def zoned(spark: SparkSession, d: str) -> DataFrame:
    zone = F.when(F.col("reading_order") == 1, "top").when(F.col("reading_order") % 7 == 0, "bottom")
    return lines(spark, d).withColumns({"zone": zone, "y": F.when(zone == "top", 20).when(zone == "bottom", 960).otherwise(500), "h": F.lit(12), "page_height": F.lit(1000)})


@query("a02_dynamic_signatures", sql.SIGNATURES)
def _(spark, d):
    return repetition.dynamic_signatures(zoned(spark, d))


@query("a02_running_heads", sql.RUNNING_HEADS)
def _(spark, d):
    own = ad.table(spark, d, "events").select(F.col("event_type").alias("document_id"), (F.col("event_id") % 50).alias("page_number"), F.when(F.col("event_id") % 3 == 0, "top").when(F.col("event_id") % 3 == 1, "bottom").alias("zone"), F.concat(F.lit("Part "), F.col("event_id").cast("string"), F.lit(" of "), F.substring(F.lit("abcdefghij"), (F.col("user_id") % 10 + 1).cast("int"), F.lit(1)), F.col("user_id").cast("string")).alias("text"))
    return repetition.dynamic_signatures(own)


@query("p03_without_artifacts", sql.WITHOUT_ARTIFACTS)
def _(spark, d):
    return repetition.without_artifacts(zoned(spark, d)).groupBy("document_id").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))


# text


@query("sf01_search_normal", sql.SEARCH_NORMAL)
def _(spark, d):
    return docs(spark, d).select("doc_id", F.md5(tx.search_normal(F.col("text"))).alias("digest"), F.length(tx.search_normal(F.col("text"))).cast("long").alias("n"))


@query("sf04_fingerprint", sql.FINGERPRINT)
def _(spark, d):
    return docs(spark, d).select("doc_id", tx.fingerprint(F.concat(F.lit("说明 图3-2 "), F.coalesce("text", F.lit("")))).alias("fingerprint"), tx.anchor_key(F.lit("图1-1")).alias("anchor"))


@query("sf08_path_safe", sql.PATH_SAFE)
def _(spark, d):
    return ad.table(spark, d, "pages").select("page_id", tx.path_safe(F.col("url")).alias("path"), tx.base_name(F.col("url")).alias("base"))


@query("sf21_similarity", sql.SIMILARITY)
def _(spark, d):
    part = ad.table(spark, d, "part")
    own = part.select("p_partkey", "p_name", F.lag("p_name").over(Window.partitionBy("p_brand").orderBy("p_partkey")).alias("other"))
    return own.select("p_partkey", F.round(tx.levenshtein_similarity(F.col("p_name"), F.col("other"), 0.4), 6).alias("similarity"))


@query("sf24_tokens", sql.TOKENS)
def _(spark, d):
    return docs(spark, d).select("doc_id", F.size(tx.match_tokens(F.col("text"))).cast("long").alias("n"), F.size(F.array_distinct(tx.match_tokens(F.col("text")))).cast("long").alias("n_distinct"))


@query("sf30_numeral", sql.NUMERAL)
def _(spark, d):
    n = (F.col("p_size") % 9 + 1).cast("int")
    digit = lambda x: F.substring(F.lit("一二三四五六七八九"), x, F.lit(1))
    written = F.concat(digit(n), F.lit("百"), digit((F.col("p_partkey") % 9 + 1).cast("int")), F.lit("十"), digit(n))
    return ad.table(spark, d, "part").select("p_partkey", tx.numeral(written).cast("long").alias("value"), tx.numeral(F.col("p_size").cast("string")).cast("long").alias("size"))


@query("sf32_headings", sql.HEADINGS)
def _(spark, d):
    made = F.concat((F.col("p_size") % 20).cast("string"), F.lit("."), (F.col("p_partkey") % 30).cast("string"), F.lit(" "), F.col("p_name"))
    h = roles.heading(made)
    return ad.table(spark, d, "part").select("p_partkey", h["level"].alias("level"), h["number"].alias("number"), h["title"].alias("title"), tx.item_number(made).cast("long").alias("item"))


@query("sf40_suspicion", sql.SUSPICION)
def _(spark, d):
    r = tx.suspicion(F.col("text"))
    own = docs(spark, d).select("doc_id", r.alias("r"))
    return own.select("doc_id", F.col("r.score").alias("score"), F.concat_ws(",", "r.reasons").alias("reasons"), F.col("r.compact_length").cast("long").alias("n"), tx.needs_correction(F.col("r")).alias("needs_correction"))


def literal_rows(spark: SparkSession, d: str, *lists: tuple) -> DataFrame:
    """Parts, each with one of some fixed texts (and what belongs to it), in turn: c0, c1, ... Dealt, as a rule costs more than
    reading a part: by the file's bytes alone, one or two tasks would do all."""
    at = (F.col("p_partkey") % len(lists[0]) + 1).cast("int")
    return dealt(ad.table(spark, d, "part").select("p_partkey"), "p_partkey", mb=0.5).select("p_partkey", *[F.element_at(F.array(*map(F.lit, values)), at).alias(f"c{i}") for i, values in enumerate(lists)])


@query("sf01_chinese", sql.CHINESE_NORMAL)
def _(spark, d):
    own = literal_rows(spark, d, sql.TEXTS)
    return own.select("p_partkey", tx.search_normal(F.col("c0")).alias("normal"), tx.anchor_key(F.col("c0")).alias("anchor"), F.array_join(tx.labels(F.col("c0")), ",").alias("labels"), F.array_join(tx.match_tokens(F.col("c0")), ",").alias("tokens"))


@query("sf33_anchors", sql.ANCHORS)
def _(spark, d):
    n, k = (F.col("p_size") % 20 + 1).cast("string"), F.col("p_partkey") % 4
    text = F.when(k == 0, F.concat(F.lit("第"), n, F.lit("条规定"))).when(k == 1, F.concat(F.lit("第 "), n, F.lit(" 条 规定"))).when(k == 2, F.concat(F.lit("附录"), n, F.lit("：说明"))).otherwise(F.concat(F.lit("附表"), n, F.lit("明细")))
    a = roles.anchor(text)
    return ad.table(spark, d, "part").select("p_partkey", F.coalesce(a["kind"], F.lit("none")).alias("kind"), F.coalesce(a["value"], F.lit(0)).cast("long").alias("value"), F.coalesce(a["rest"], F.lit("")).alias("rest"))


@query("sf37_page_roles", sql.PAGE_ROLES)
def _(spark, d):
    own = literal_rows(spark, d, sql.BLOCK_TEXTS, sql.BLOCK_SIZES)
    text, width = F.col("c0"), F.lit(300)
    shown = roles.display_heading(text, geo.Box(F.lit(34.0), F.lit(64.0), F.lit(175.0), F.lit(22.0)), F.lit(360.0), F.col("c1"), F.lit(False))
    role = lambda display: roles.page_role(text, F.lit(1), F.length(text).cast("double"), width, F.lit(False), display)
    return own.select("p_partkey", role(shown).alias("role"), role(None).alias("plain_role"), captions.document_role(text).alias("document_role"))


@query("sf38_page_markers", sql.PAGE_MARKERS)
def _(spark, d):
    own = literal_rows(spark, d, sql.MARK_TEXTS, sql.MARK_PLACES)
    marker = roles.page_marker(F.col("c0"), geo.Box(F.lit(216.0), F.col("c1"), F.lit(5.0), F.lit(12.0)), F.lit(360.0))
    return own.select("p_partkey", marker.alias("marker"), roles.loose_page_marker(F.col("c0")).alias("loose"))


@query("sf42_captions", sql.CAPTIONS)
def _(spark, d):
    own = literal_rows(spark, d, sql.CAPTION_TEXTS)
    return own.select("p_partkey", captions.caption_candidate(F.col("c0")).alias("figure"), captions.caption_candidate(F.col("c0"), "table").alias("table"))


@query("j19_approved", sql.APPROVED)
def _(spark, d):
    part = ad.table(spark, d, "part")
    fixes = [part.select(F.col("p_partkey").alias("entry_id"), F.lit(i).alias("seq"), before.alias("before"), F.lit(after).alias("after"), (F.col("p_size") % 3 + i % 2).cast("double").alias("confidence")) for i, (before, after) in enumerate([(F.element_at(F.split("p_name", " "), 1), "FIRST"), (F.lit("FIRST"), "once"), (F.lit("e"), "E")])]
    return align.approved(part.select(F.col("p_partkey").alias("entry_id"), F.col("p_name").alias("content")), fixes[0].unionByName(fixes[1]).unionByName(fixes[2])).select("entry_id", "content", "fixed")


@query("p01_page_route", sql.PAGE_ROUTE)
def _(spark, d):
    return metrics.page_route(docs(spark, d)).select("doc_id", "native_chars", "route")


@query("s03_coverage", sql.COVERAGE)
def _(spark, d):
    return metrics.coverage(docs(spark, d), "source")


# boxes


@query("sf62_overlap_pairs", sql.OVERLAP_PAIRS)
def _(spark, d):
    own = layout.overlaps(boxes(spark, d, "figure"), boxes(spark, d, "text"), 0.1)
    return own.select("document_id", "page_number", "a_seq", "b_seq", F.round("a_ratio", 6).alias("a_ratio"), F.round("b_ratio", 6).alias("b_ratio"))


@query("j05_best_overlap", sql.BEST_OVERLAP)
def _(spark, d):
    return layout.best_overlap(boxes(spark, d, "figure"), boxes(spark, d, "text")).withColumn("ratio", F.round("ratio", 6))


@query("p05_suppressed_text", sql.SUPPRESSED)
def _(spark, d):
    wide = boxes(spark, d, "figure").withColumns({"w": F.col("w") * 4, "h": F.col("h") * 4})
    return layout.suppressed_text(boxes(spark, d, "text"), wide, 0.5).select("document_id", "page_number", "seq")


@query("p04_figure_exclusion", sql.EXCLUSION)
def _(spark, d):
    own = boxes(spark, d)
    e = [F.col(c).cast("double") for c in "xywh"]
    reason = roles.figure_exclusion(e[0], e[1], e[0] + e[2] / 8, e[1] + e[3], F.lit(550.0), F.lit(120.0), F.col("w") - 22, F.col("h"), F.col("seq") % 5 == 0)
    return own.select("document_id", "seq", F.coalesce(reason, F.lit("kept")).alias("reason"))


@query("j02_association_pairs", sql.ASSOCIATION)
def _(spark, d):
    own = layout.association_pairs(boxes(spark, d, "figure"), boxes(spark, d).where("kind <> 'figure'"), "text")
    return own.select("document_id", "page_number", "a_seq", "b_seq", "kind_rank", "gap", F.round("center", 6).alias("center"))


@query("j02_associate", sql.ASSOCIATE)
def _(spark, d):
    return layout.associate(boxes(spark, d, "figure"), boxes(spark, d).where("kind <> 'figure'"), "text")


@query("j03_merged_tables", sql.MERGED_TABLES)
def _(spark, d):
    return layout.merged_tables(boxes(spark, d, "figure").drop("score", "kind"), boxes(spark, d, "caption").drop("score", "kind"), 0.1)


@query("j06_matched_versions", sql.VERSIONS)
def _(spark, d):
    own = layout.matched_versions(boxes(spark, d, "figure").drop("score", "kind"), boxes(spark, d, "text").drop("score", "kind"))
    return own.withColumns({c: F.coalesce(c, F.lit(-1)) for c in ("old_seq", "new_seq")})


@query("o03_nms", sql.NMS)
def _(spark, d):
    return layout.nms(boxes(spark, d), 0.2)


@query("o04_pruned", sql.PRUNED)
def _(spark, d):
    return layout.pruned(boxes(spark, d))


@query("o05_without_nested", sql.NESTED)
def _(spark, d):
    return layout.without_nested(boxes(spark, d))


@query("o06_without_containers", sql.CONTAINERS)
def _(spark, d):
    page = boxes(spark, d).withColumns({"seq": F.col("document_id") * 100 + F.col("seq"), "document_id": F.floor(F.col("document_id") / 10).cast("long"), "w": F.col("w") * F.when(F.col("seq") % 4 == 0, 5).otherwise(2), "h": F.col("h") * F.when(F.col("seq") % 4 == 0, 6).otherwise(2)})
    return layout.without_containers(page).select("document_id", "page_number", "seq")


@query("o07_fragments", sql.FRAGMENTS)
def _(spark, d):
    return layout.fragments(boxes(spark, d))


@query("j25_nearest_caption", sql.NEAREST_CAPTION)
def _(spark, d):
    # every third caption block holds none
    text = F.when(F.col("x") % 3 == 0, "no label").otherwise(F.concat(F.lit("图"), (F.col("x") % 9).cast("string"), F.lit(" name")))
    return layout.nearest_caption(boxes(spark, d).select(F.col("document_id").alias("entry_id"), "seq", F.col("kind").alias("type"), F.col("kind").alias("role"), text.alias("text")))


@query("sf61_edges", sql.EDGES)
def _(spark, d):
    own = boxes(spark, d)
    b = geo.clip_to_page(geo.from_edges(F.col("x") / 2, F.col("y") / 4, (F.col("x") + F.col("w")) / 2, (F.col("y") + F.col("h")) / 4), F.lit(200), F.lit(25))
    return own.select("document_id", "seq", *[c.cast("long").alias(n) for n, c in (("x", b.x), ("y", b.y), ("w", b.w), ("h", b.h))])


# references


@query("j01_resolve", sql.RESOLVE)
def _(spark, d):
    figures, refs = ad.references(ad.table(spark, d, "lineitem"))
    own = references.resolve(refs, figures)
    # without nulls, which other engines' frames turn into floats
    return own.select("document_id", "block_id", "label", "status", F.coalesce("target_id", F.lit(-1)).alias("target_id"), "reason", F.coalesce("page_delta", F.lit(0)).alias("page_delta"))


@query("j01_referenced_by", sql.REFERENCED_BY)
def _(spark, d):
    figures, refs = ad.references(ad.table(spark, d, "lineitem"))
    return references.referenced_by(references.resolve(refs, figures))


@query("j11_unreferenced", sql.UNREFERENCED)
def _(spark, d):
    figures, refs = ad.references(ad.table(spark, d, "lineitem"))
    return references.unreferenced(figures, references.resolve(refs, figures)).select("document_id", "block_id", "label", "page_number")


@query("a11_merged_labels", sql.MERGED_LABELS)
def _(spark, d):
    own = ad.table(spark, d, "events").select(F.col("user_id").alias("document_id"), (F.col("event_id") % 5).alias("block_id"), F.col("event_type").alias("key"), F.col("event_id").cast("string").alias("raw"), F.when(F.col("event_id") % 3 == 0, "native").otherwise("ocr").alias("source"), F.col("event_id").alias("seq"))
    return references.merged_labels(own)


@query("a09_clusters", sql.CLUSTERS)
def _(spark, d):
    own = ad.table(spark, d, "lineitem").groupBy((F.col("l_suppkey") % 50).alias("title"), F.concat(F.lit("F"), (F.col("l_partkey") % 40).cast("string")).alias("label"), (F.col("l_orderkey") % 97).alias("page_number")).agg(F.min("l_orderkey").alias("entry_no"), F.count("*").alias("n_images"), F.count_if(F.col("l_returnflag") == "A").alias("n_captions"))
    return references.clusters(own).select("title", "label", "cluster", "members", "first_page", "last_page", "anchor_entry")


# alignment and retrieval


@query("j08_page_window", sql.PAGE_WINDOW)
def _(spark, d):
    own = boxes(spark, d).select(F.floor(F.col("document_id") / 100).cast("long").alias("document_id"), (F.col("document_id") % 100 + 1).alias("page_number"), (F.col("document_id") * 100 + F.col("seq")).alias("item_id"), "kind")
    pairs = align.page_window(own.where("kind = 'figure'"), own.where("kind = 'text'").withColumnRenamed("item_id", "entry_id"))
    return pairs.groupBy(F.col("i_item_id").alias("item_id")).agg(F.count("*").alias("candidates"), F.sum(align.page_bonus(F.col("i_page_number"), F.col("e_page_number"))).alias("bonus"))


@query("j08_align_items")
def _(spark, d):
    items = ad.table(spark, d, "benchmark").select((F.col("item_id") % 25).alias("document_id"), "item_id", (F.col("item_id") % 40 + 1).cast("long").alias("page_number"), F.when(F.col("item_id") % 2 == 0, "table").otherwise("legend").alias("kind"), F.col("text").alias("signal"))
    entries = docs(spark, d).select(F.floor(F.col("doc_id") / 40).cast("long").alias("document_id"), F.col("doc_id").alias("entry_id"), (F.col("doc_id") % 40 + 1).cast("long").alias("page_number"), F.element_at(F.split("text", "\n"), 1).alias("title"), F.col("text").alias("content"), (F.col("doc_id") % 3 == 0).alias("has_table"))
    return align.align_items(items, entries)


@query("j13_fragment_matches", sql.FRAGMENT_MATCHES)
def _(spark, d):
    e = ad.table(spark, d, "conversations")
    f = e.where("role = 'user'").select(F.col("conv_id").alias("document_id"), F.col("turn").alias("fragment_id"), F.col("turn").alias("page_number"), "text")
    t = e.where("role <> 'user'").select(F.col("conv_id").alias("document_id"), F.col("turn").alias("entry_id"), F.col("turn").alias("page_number"), "text")
    return align.fragment_matches(f, t).select("document_id", "fragment_id", "entry_id", F.col("score").cast("long").alias("score"), F.col("hits").cast("long").alias("hits"))


@query("a05_dominant_page", sql.DOMINANT_PAGE)
def _(spark, d):
    return align.dominant_pages(ad.table(spark, d, "lineitem").select(F.col("l_suppkey").alias("entry_id"), (F.col("l_orderkey") % 30).alias("page_number")))


@query("j20_filled_anchors", sql.FILLED_ANCHORS)
def _(spark, d):
    own = boxes(spark, d).withColumn("anchor", F.when(F.col("seq") % 2 == 0, F.concat(F.lit("a"), (F.col("x") % 2).cast("string"))))
    return align.filled_anchors(own).select("document_id", "seq", "anchor")


@query("j16_linked_titles", sql.LINKED_TITLES)
def _(spark, d):
    part = ad.table(spark, d, "part")
    toc = part.select(F.col("p_type").alias("title"), F.col("p_partkey").alias("entry_id"), F.col("p_partkey").alias("seq"))
    return align.linked_titles(part.select("p_partkey", F.col("p_type").alias("title")), toc)


@query("o01_top_k", sql.TOP_K)
def _(spark, d):
    nation = ad.table(spark, d, "nation")
    part = ad.table(spark, d, "part")
    return retrieve.top_k(nation, "n_nationkey", "n_name", part, "p_partkey", "p_name", 20).select("query", "key", F.round("score", 6).alias("score"))


@query("a20_tfidf_index", sql.TFIDF)
def _(spark, d):
    vectors, idf = retrieve.index(ad.table(spark, d, "part"), "p_partkey", "p_name")
    own = vectors.groupBy("key").agg(F.count("*").alias("grams"), F.round(F.max("x"), 6).alias("top"))
    return own


# figures and diffs


@query("a03_kb_metrics", sql.KB_METRICS)
def _(spark, d):
    uris = ad.table(spark, d, "events").select(F.col("event_type").alias("uri"))
    return metrics.kb_metrics(turn_entries(spark, d), turns(spark, d), uris)


@query("a03_block_counters", sql.BLOCK_COUNTERS)
def _(spark, d):
    item = ad.table(spark, d, "lineitem")
    blocks = ad.mixed_blocks(item).withColumns({"asset_source": F.when(F.col("reading_order") % 3 == 0, "embedded").when(F.col("reading_order") % 3 == 1, "page_crop"), "structured": F.col("markdown").isNotNull(), "cells": F.col("reading_order") % 5})
    links = item.select(F.col("l_partkey").alias("figure_id"), F.when(F.col("l_linenumber") % 2 == 0, "caption").otherwise("legend").alias("kind"), F.when(F.col("l_quantity") % 3 == 0, "ocr").alias("source"))
    figures, refs = ad.references(item)
    resolved = references.resolve(refs, figures).withColumn("target_id", F.concat_ws("-", "document_id", "target_id"))
    return metrics.block_counters(blocks, links, resolved)


@query("a06_entry_quality", sql.ENTRY_QUALITY)
def _(spark, d):
    return metrics.entry_quality(turn_entries(spark, d)).select("document_id", "position", "quality")


@query("a07_structure_confidence", sql.STRUCTURE)
def _(spark, d):
    return metrics.structure_confidence(turn_entries(spark, d))


@query("a03_text_digest", sql.DIGEST)
def _(spark, d):
    return metrics.digest(turn_entries(spark, d))


@query("a04_table_geometry", sql.TABLE_GEOMETRY)
def _(spark, d):
    return tables.geometry(ad.cells(ad.table(spark, d, "lineitem"))[1])


@query("j07_keyed_diff", sql.KEYED_DIFF)
def _(spark, d):
    return tables.keyed_diff(*ad.cells(ad.table(spark, d, "lineitem")))


@query("j07_cell_diff", sql.CELL_DIFF)
def _(spark, d):
    return tables.cell_diff(*ad.cells(ad.table(spark, d, "lineitem")))


@query("sf64_markdown", sql.MARKDOWN)
def _(spark, d):
    own = tables.rows_of(ad.cells(ad.table(spark, d, "lineitem"))[0])
    return own.select("table_id", tables.markdown(F.col("rows")).alias("markdown"), F.size(tables.parsed(tables.markdown(F.col("rows")))).cast("long").alias("n_rows"))


@query("a12_lines_of_words", sql.WORD_LINES)
def _(spark, d):
    own = boxes(spark, d).select(F.col("document_id").alias("figure_id"), F.lit(0).alias("block_num"), F.lit(0).alias("par_num"), F.col("page_number").alias("line_num"), F.concat(F.lit("w"), F.col("seq").cast("string")).alias("text"), (F.col("score") % 100 - 5).alias("conf"), "x", "y", "w", "h")
    return metrics.lines_of_words(own).select("figure_id", "line_num", "text", "mean_confidence", "x", "y", "w", "h")


@query("a13_adjudicated", sql.ADJUDICATED)
def _(spark, d):
    own = ad.table(spark, d, "events").select(F.col("user_id").alias("figure_id"), F.when(F.col("event_type") == "view", "").otherwise(F.col("event_type")).alias("label"), (F.col("event_id") % 101).cast("double").alias("confidence"), (F.col("event_id") % 7).cast("double").alias("roi"), F.col("event_id").alias("psm"))
    return metrics.adjudicated(own)


@query("j22_shadow_diff", sql.SHADOW)
def _(spark, d):
    own = ad.table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("name"))
    old = own.agg(F.count("*").cast("double").alias("value")).where("name not like '1%'")
    new = own.agg(F.count_if(F.col("o_orderstatus") == "O").cast("double").alias("value")).where("name not like '5%'")
    return metrics.shadow_diff(old, new)


@query("j23_mismatches", sql.MISMATCHES)
def _(spark, d):
    own = ad.table(spark, d, "lineitem").groupBy(F.col("l_suppkey").cast("string").alias("name")).agg(F.count("*").alias("value"))
    return metrics.mismatches(own.withColumn("value", F.when(F.col("value") % 3 == 0, F.col("value") + 1).otherwise(F.col("value"))), own)


@query("p17_violations", sql.VIOLATIONS)
def _(spark, d):
    rules: dict[str, Column] = {"balance": F.col("c_acctbal") >= 0, "name": F.length("c_name") > 0, "segment": F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "nation": F.col("c_nationkey") < 20}
    return metrics.violations(ad.table(spark, d, "customer"), "c_custkey", rules)


@query("a10_first_by_key", sql.FIRST_BY_KEY)
def _(spark, d):
    return metrics.first_by_key(boxes(spark, d), ["document_id", "kind"], ["page_number", "seq"]).select("document_id", "kind", "seq")


@query("o13_within_budget", sql.BUDGET)
def _(spark, d):
    own = ad.table(spark, d, "part")
    return metrics.within_budget(own, "p_brand", [F.desc("p_retailprice"), F.col("p_partkey")], 5).select("p_brand", "p_partkey", "rank")


@query("p14_preliminary", sql.PRELIMINARY)
def _(spark, d):
    own = docs(spark, d).select("doc_id", (F.col("doc_id") % 6 + 1).alias("page_number"), F.col("text").alias("content"))
    return metrics.preliminary(own).select("doc_id", "preliminary", "search_weight")


@query("html_blocks", sql.HTML_BLOCKS)
def _(spark, d):
    return ad.html_blocks(ad.table(spark, d, "pages"))


# entries and assets


@query("p06_in_scope", sql.IN_SCOPE)
def _(spark, d):
    return ad.table(spark, d, "part").where(kb.in_scope(F.col("p_brand"), F.col("p_name"), F.col("p_partkey").cast("string"), ("1", "2"), ("a", "e"), ("1", "3"))).select("p_partkey")


@query("p07_effective_candidate", sql.EFFECTIVE)
def _(spark, d):
    own = ad.line_blocks(docs(spark, d)).withColumn("ok", kb.effective_candidate(F.col("text")))
    return own.select("document_id", "reading_order", "ok")


@query("j09_fallback_entries", sql.FALLBACK)
def _(spark, d):
    part = ad.table(spark, d, "part")
    # three entries a page, however large the table
    items = part.select(F.floor(F.col("p_partkey") / 90).alias("document_id"), F.col("p_partkey").alias("item_id"), (F.col("p_partkey") % 30).alias("page_number"), F.element_at(F.split("p_name", " "), 1).alias("heading"))
    entries = part.select(F.floor(F.col("p_partkey") / 90).alias("document_id"), F.col("p_partkey").alias("entry_id"), (F.col("p_partkey") % 30).alias("page_number"), F.col("p_name").alias("title"), F.col("p_type").alias("content"), (F.col("p_size") % 30).cast("long").alias("dominant_page"), F.col("p_size").alias("position"))
    return kb.fallback_entries(items, entries).select("item_id", "entry_id", "method")


@query("j26_page_owners", sql.PAGE_OWNERS)
def _(spark, d):
    own = boxes(spark, d)
    blocks = own.select((F.col("document_id") % 500).alias("document_id"), F.col("document_id").alias("entry_id"), "seq", (F.col("x") % 9).alias("block_page"), (F.col("document_id") % 7).alias("entry_page"))
    entries = ad.table(spark, d, "orders").select((F.col("o_orderkey") % 500).alias("document_id"), F.col("o_orderkey").alias("entry_id"), (F.col("o_orderkey") % 7).alias("page_number"), F.col("o_orderkey").alias("position"))
    return kb.page_owners(blocks, entries).groupBy("entry_id").agg(F.count("*").alias("n"), F.count_if("moved").alias("n_moved"))


@query("j27_attached_snapshots", sql.ATTACHED)
def _(spark, d):
    own = boxes(spark, d).withColumnRenamed("document_id", "entry_id")
    blocks = own.where("kind = 'text'").select("entry_id", "seq", F.when(F.col("x") % 3 == 0, "uri").alias("uri"))
    return kb.attached_snapshots(blocks, own.where("kind = 'figure'").select("entry_id", "seq", F.col("x").cast("string").alias("uri"))).withColumn("block_seq", F.coalesce("block_seq", F.lit(-1)))


@query("a21_weighted_index", sql.WEIGHTED)
def _(spark, d):
    part = ad.table(spark, d, "part").withColumn("role", F.when(F.col("p_size") % 4 == 0, "heading").when(F.col("p_size") % 4 == 1, "body").when(F.col("p_size") % 4 == 2, "artifact").otherwise("caption"))
    return retrieve.counts(kb.ranking_rows(part), "p_brand", "p_name", "weight").groupBy("key").agg(F.count("*").alias("grams"), F.sum("tf").alias("weight"))


@query("w15_next_numbers", sql.NEXT_NUMBERS)
def _(spark, d):
    chapter, current = F.col("p_size").cast("string"), F.concat((F.col("p_size") + F.col("p_partkey") % 2).cast("string"), F.lit("."), (F.col("p_partkey") % 30).cast("string"))
    return ad.table(spark, d, "part").select("p_partkey", tx.next_section_number(chapter, current).alias("next"), kb.full_clause(F.concat(F.lit("."), F.col("p_partkey") % 9, F.lit(".2 x")), chapter, current).alias("clause"))


@query("j21_heading_hints", sql.HEADING_HINTS)
def _(spark, d):
    own = boxes(spark, d).withColumn("page_number", F.col("seq"))
    return kb.heading_hints(own.where("kind <> 'text'"), own.where("kind = 'text'").withColumn("text", F.concat(F.lit("t"), F.col("seq").cast("string"))))


@query("o08_merged_to_fixpoint")
def _(spark, d):
    return kb.merged_to_fixpoint(boxes(spark, d).drop("score"), gap=40, align=0.3)


@query("j12_overlaid")
def _(spark, d):
    own = ad.line_blocks(docs(spark, d)).select("document_id", "page_number", F.col("reading_order").alias("seq"), "text")
    return kb.overlaid(own, own.withColumn("text", F.upper("text")))


# documents


@query("a14_document_style", sql.STYLE)
def _(spark, d):
    # English lines stand in for articles and chapters
    own = ad.line_blocks(docs(spark, d))
    return metrics.document_style(own, "^[AT]", "^[EO]n", "(?i)^the ", "[0-9]").select("document_id", "articles", "appendices", "chapters", "sections", "style")


@query("sf11_cluster_keys", sql.CLUSTER_KEYS)
def _(spark, d):
    title = F.concat(F.col("p_type"), F.lit(" / "), F.col("p_name"))
    return ad.table(spark, d, "part").select("p_partkey", captions.cluster_key(title).alias("key"))


@query("sf06_clean_text", sql.CLEAN_TEXT)
def _(spark, d):
    return ad.table(spark, d, "pages").select("page_id", captions.clean_text(F.concat(F.col("url"), F.lit(" a\nb c\n"), F.col("html"))).alias("text"))


@query("sf23_difflib_ratio")
def _(spark, d):
    part = ad.table(spark, d, "part").select("p_partkey", "p_name", F.lag("p_name").over(Window.partitionBy("p_brand").orderBy("p_partkey")).alias("other"))
    return part.select("p_partkey", F.round(captions.difflib_ratio(F.col("p_name"), F.col("other")), 6).alias("ratio"))
