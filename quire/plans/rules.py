"""Queries of rules on single texts, and of small operators on entries and assets, with their SQL.

A rule's query gives each part one of some fixed texts in turn; its SQL holds what the document model makes of each.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import captions, geometry, roles
from quire.functions import text as tx
from quire.operators import adapters as ad
from quire.operators import align, kb, layout, metrics, segment, tables
from quire.plans import publish, run, sql
from quire.plans.catalog import Query, boxes, docs, literal_rows, turns
from quire.sources import readers

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, oracle: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        ORACLE_SQL[name] = oracle
        return f

    return add


def rule(name: str, *texts: tuple, **columns: tuple[Callable[..., Column], tuple]) -> None:
    """texts: lists of equal length, each a column of the fixed texts. columns: an expression of them, and what it gives."""
    def rows(spark: SparkSession, d: str) -> DataFrame:
        own = literal_rows(spark, d, *texts)
        return own.select("p_partkey", *[f(*[F.col(f"c{i}") for i in range(len(texts))]).alias(n) for n, (f, _) in columns.items()])

    QUERIES[name] = rows
    named = ", ".join(f"c{i} AS {n}" for i, n in enumerate(columns))
    ORACLE_SQL[name] = f"SELECT p_partkey, {named} FROM ({sql.picked(*[expected for _, expected in columns.values()])})"


def whole(c: Column) -> Column:
    return F.coalesce(c.cast("long"), F.lit(-1).cast("long"))


def named(c: Column) -> Column:
    return F.coalesce(c, F.lit("none"))


rule("sf10_first_text", ("", " a ", "　", "x"), ("b", "c", "d ", ""), first=(tx.first_of, ("b", "a", "d", "x")))
rule(
    "sf22_semantic", ("图1 系统图", "附件二 规定", "abcdef", "", "第三条 总则"), ("系统图", "规定", "abcxyz", "a", "第三条总则说明"),
    score=(lambda a, b: F.round(tx.semantic_similarity(a, b, 0.4), 6), (0.333333, 1.0, 0.5, 0.0, 0.5)),
)
rule(
    "sf25_covered", ("变压器 巡视 检查 周期 一览表", "变压器 巡视 检查", "甲乙丙丁戊己庚辛壬癸", "短"), ("变压器巡视检查", "变压器 巡视", "甲乙丙丁戊己庚辛 子丑寅卯", "短"),
    covered=(kb.covers_fragment, (True, False, True, False)),
)
rule(
    "sf31_numbers", ("3.1 x", "第二 x", "3.9.2", ""), ("3", "4", "3.9", ""),
    chain=(lambda a, b: tx.number_chain(a), ("3.1 x", "第二 x", "3.9.2", "")), following=(lambda a, b: tx.next_section_number(b, a), ("3.1", "4.1", "3.9.3", "")),
)
rule(
    "sf34_clauses", ("3. 检查设备，记录结果。", "3. 总则", "．检查", "（1）x", "一、x", "文字"),
    number=(lambda c: whole(kb.sequential_clause(c)["number"]), (3, -1, -1, -1, -1, -1)), text=(lambda c: named(kb.sequential_clause(c)["text"]), ("检查设备，记录结果。", "none", "检查", "none", "none", "none")),
)
rule(
    "sf35_titles", ("一般规定", "H/500", "零件 3", "这是一句话。", "1.7mO", "电力设备 管理", "QP6Z", "5.1 规定", "图2-4接线图", "３ｍ０"),
    title=(roles.likely_title, (True, False, False, False, False, True, False, True, True, False)), plain=(roles.plain_section, (True, False, False, False, False, True, False, False, False, False)),
    noise=(roles.heading_noise, (False, True, False, False, True, False, False, False, False, True)), artifact=(roles.heading_artifact, (False, True, True, False, False, False, False, False, False, False)),
    weak=(roles.weak_heading, (False, True, True, False, True, False, True, False, False, True)),
)
rule(
    "sf36_captions", ("图4 人工呼吸", "某某示意图", "正文内容", "(a)", "200mm", "中心线", "第三章 总则", "人工呼吸方法"), ("", "", "图4", "图4", "", "", "图4", "图4 人工"),
    caption=(lambda a, b: captions.caption(a), (True, True, False, False, False, False, False, False)), callout=(lambda a, b: captions.callout(a), (False, False, False, True, True, True, False, False)),
    fragment=(captions.caption_fragment, (False, False, True, False, False, False, False, True)),
)
rule(
    "sf39_texts", ("5变、配电所", "5用于配电", "5.1一般规定", "12:30", "电力变压器运行检修", "abc电力变压器运行", "（1）x", "3. x", "正文"),
    heading=(roles.numbered_heading, (True, False, True, False, False, False, False, False, False)), body=(roles.numbered_body, (False, True, False, False, False, False, False, False, False)),
    prose=(roles.prose_continuation, (False, False, False, False, True, False, False, False, False)), listed=(roles.list_item, (False, False, False, False, False, False, True, True, False)),
    attached=(roles.attached_number, (True, True, False, False, False, False, False, False, False)),
)
rule(
    "sf41_references", ("见图1-2", "图1.2所示内容", "图1-2 示意图", "图12", "无"),
    score=(lambda c: whole(tx.reference_score(c, F.lit("图1-2"))), (3, 3, 1, 0, 0)), labels=(lambda c: F.array_join(tx.reference_labels(c), ","), ("图12", "图12", "", "", "")),
)
rule(
    "sf43_recognised", ("", "图3 隔离开关", "图3", "图3 图4 甲乙", "没有标签", "图3 a", "见图3 隔离开关"), (90.0, 90.0, 90.0, 90.0, 90.0, 90.0, 90.0),
    status=(kb.caption_status, ("empty", "linked", "label_only", "ambiguous_multiple_labels", "rejected", "rejected", "rejected")),
)
rule(
    "sf44_pages", ("目录\n第一章", "第一章 3\n第二章 5\n第三章 9\n第四章 12\n第五章 15", "正文。", "第一章 总则\n12", "12", "第一章 总则\n正文说明，内容。"),
    contents=(captions.table_of_contents, (True, True, False, False, False, False)), opener=(lambda c: captions.chapter_opener(F.split(c, "\n")), (False, False, False, True, False, False)),
)
rule(
    "sf45_numbers", ("4.2.13 x", "4.2 x", "3、 x", "第十二条 x", "12 x", "（三） x", "x"),
    item=(lambda c: whole(tx.item_number(c)), (40213, 40200, 3, 12, -1, -1, -1)), continued=(lambda c: whole(tx.continuation_number(c)), (-1, -1, -1, -1, 12, -1, -1)), sub=(lambda c: whole(tx.subitem_number(c)), (-1, -1, -1, -1, -1, 3, -1)),
)
rule(
    "sf46_kinds", ("Table", "figure", "equation", "Table 3", "text", ""),
    visual=(lambda c: named(captions.visual_kind(c)), ("table", "legend", "legend", "none", "none", "none")), content=(captions.content_type, ("table", "figure", "figure", "narrative", "narrative", "narrative")), generic=(captions.generic_caption, (True, True, True, True, False, True)),
)
rule(
    "sf47_fixes", ("原来的文字", "原来的文字", "a[IMAGE_REF:x]b", "短", "第三条 甲"), ("修改的文字", "", "ab", "很长很长很长很长很长很长很长很长很长很长很长", "甲乙"),
    reason=(lambda a, b: named(kb.rejected_fix(a, b, F.lit("paragraph"))), ("none", "empty_result", "image_placeholder_changed", "length_delta_too_large", "anchor_lost")),
)
rule(
    "sf09_names", ("a/visual_p12_3.png?x", "k/page_012.png", "x_p7_y.png", "12", "p5", "none"),
    page=(lambda c: whole(tx.snapshot_index(c)["page"]), (12, -1, -1, -1, -1, -1)), idx=(lambda c: whole(tx.snapshot_index(c)["idx"]), (3, -1, -1, -1, -1, -1)), physical=(lambda c: whole(tx.physical_page(c)), (12, -1, 7, -1, -1, -1)),
    number=(lambda c: whole(tx.page_number(c)), (-1, -1, -1, 12, 5, -1)), of_uri=(lambda c: whole(tx.page_of_uri(c)), (12, 12, 7, -1, 5, -1)),
)
rule("p10_cached", ("linked", "empty", "linked", "failed", "rejected"), ("", "no text", "engine timeout", "", "Tesseract not installed"), cached=(kb.cacheable, (True, True, False, False, False)))
rule("p12_panels", ("(a) 甲 (b) 乙", "（A）甲", "(1) (2)", "无", "(a) (a)"), marks=(lambda c: whole(kb.panel_markers(c)), (2, 1, 0, 0, 1)))
rule("p19_skips", ("figure", "table", "legend", "figure"), ("图3", "图3", "图3", "图3 甲"), ("图 3", "图3", "乙", "图3 甲"), skips=(lambda k, a, b: kb.skips_alignment(k, F.array(a, b)), (False, False, False, True)))
rule("w15_clause_texts", ("．3.2 甲", "3.2 乙", "丙"), text=(lambda c: kb.clause_text(c, F.lit("9.3.2")), ("9.3.2 甲", "9.3.2 乙", "丙")))


@query("sf63_boxes", "SELECT l_orderkey AS document_id, l_linenumber AS n, (l_partkey % 50) / 4.0 + 0.25 * l_quantity AS x, greatest(1.0, 0.5 * l_quantity) AS w, l_suppkey % 100 / 2.0 AS px FROM lineitem")
def _(spark, d):
    item = ad.table(spark, d, "lineitem")
    figure = geometry.Box((F.col("l_partkey") % 50) / 4.0, F.lit(0.0), F.col("l_quantity").cast("double"), F.lit(10.0))
    inner = geometry.within_figure(F.lit(0.25), F.lit(0.0), F.lit(0.75), F.lit(1.0), figure)
    points = geometry.points_of_pixels(geometry.Box(*[F.col("l_suppkey") % 100] * 4))
    return item.select(F.col("l_orderkey").alias("document_id"), F.col("l_linenumber").alias("n"), inner.x.alias("x"), inner.w.alias("w"), points.x.alias("px"))


@query("sf60_grid", "SELECT p_partkey, p_size % 3 AS \"row\", p_size % 4 AS \"col\", CAST(1 AS BIGINT) AS row_span, CAST(CASE WHEN p_size % 4 < 3 THEN 2 ELSE 1 END AS BIGINT) AS col_span FROM part")
def _(spark, d):
    # a grid of lines every 10 points, each drawn twice, and rectangles two columns wide
    xs, ys = (tables.merged_coordinates(F.array(*[F.lit(v) for i in range(n) for v in (10.0 * i, 10.0 * i + 0.4)])) for n in (6, 5))
    x, y = (F.col("p_size") % 4) * 10.0, (F.col("p_size") % 3) * 10.0
    cell = tables.grid_cell(xs, ys, x + 0.2, y, F.when(F.col("p_size") % 4 < 3, x + 20.1).otherwise(x + 9.0), y + 10.0)
    return ad.table(spark, d, "part").select("p_partkey", *[cell[c].cast("long").alias(c) for c in ("row", "col", "row_span", "col_span")])


SKIPS = """SELECT CASE WHEN l_linestatus <> 'O' THEN 'not_ready' WHEN l_returnflag <> 'N' THEN 'not_embedded' WHEN l_partkey % 5 <= 2 THEN 'unsafe_uri' WHEN l_linenumber = 1 THEN 'has_caption' ELSE 'none' END AS reason, count(*) AS n FROM lineitem GROUP BY 1"""


@query("p09_skip_reasons", SKIPS)
def _(spark, d):
    uri = F.element_at(F.array(*map(F.lit, ("", "/etc/x.png", "a/../b.png", "img/x.png", "x.png"))), (F.col("l_partkey") % 5 + 1).cast("int"))
    reason = kb.ocr_skip_reason(F.when(F.col("l_linestatus") == "O", "ready"), F.when(F.col("l_returnflag") == "N", "embedded"), uri, F.col("l_linenumber") == 1)
    return ad.table(spark, d, "lineitem").groupBy(named(reason).alias("reason")).agg(F.count("*").alias("n"))


@query("p11_sources", "SELECT count(*) FILTER (l_linenumber <> 3 AND l_linenumber < 5 AND l_partkey % 10 NOT IN (2, 3, 4, 5) AND l_quantity <> 9) AS n FROM lineitem")
def _(spark, d):
    own = ad.mixed_blocks(ad.table(spark, d, "lineitem").withColumn("l_partkey", F.when(F.col("l_quantity") == 9, 5).otherwise(F.col("l_partkey"))))
    return own.agg(F.count_if(kb.reference_source(F.col("type"), F.col("role"), F.lit("native"))).alias("n"))


@query("p13_entries", "SELECT p_partkey FROM part WHERE NOT (p_size % 3 = 0 AND p_partkey % 5 <> 0 AND p_partkey % 7 <> 0)")
def _(spark, d):
    part = ad.table(spark, d, "part").select(F.lit(1).alias("document_id"), F.col("p_partkey").alias("entry_id"), F.when(F.col("p_size") % 3 == 0, F.concat("p_name", F.lit(" [SPLIT]"))).otherwise(F.col("p_name")).alias("job_title"))
    blocks = part.select("document_id", "entry_id", F.when(F.col("entry_id") % 5 == 0, "text").otherwise(" ").alias("text"), F.when(F.col("entry_id") % 7 == 0, "uri").alias("image_uri"))
    return kb.without_empty_splits(part, blocks).select(F.col("entry_id").alias("p_partkey"))


@query("p15_blocks", "SELECT count(*) AS n, CAST(sum(p_partkey) AS BIGINT) AS total FROM part WHERE p_partkey % 4 NOT IN (0, 1)")
def _(spark, d):
    text = F.element_at(F.array(*map(F.lit, ("第二篇", "- 12 -", "第二篇 说明", "12"))), (F.col("p_partkey") % 4 + 1).cast("int"))
    own = ad.table(spark, d, "part").select(F.lit(1).alias("document_id"), F.col("p_partkey").alias("entry_id"), text.alias("text"))
    return kb.without_part_labels(own).agg(F.count("*").alias("n"), F.sum("entry_id").alias("total"))


OUTSIDE = f"""WITH {sql.BOXES} SELECT t.document_id, t.page_number, t.seq FROM boxes t WHERE kind = 'text' AND (seq % 5 = 0 OR NOT EXISTS (SELECT 1 FROM boxes r WHERE r.kind = 'figure' AND r.document_id = t.document_id AND r.page_number = t.page_number
  AND t.x >= r.x - 60 AND t.y >= r.y - 60 AND t.x + t.w <= r.x + r.w + 60 AND t.y + t.h <= r.y + r.h + 60))"""


@query("p16_outside", OUTSIDE)
def _(spark, d):
    return layout.outside_regions(boxes(spark, d, "text"), boxes(spark, d, "figure"), F.col("seq") % 5 == 0, 60).select("document_id", "page_number", "seq")


@query("p18_visuals", "SELECT l_suppkey AS document_id, bool_or(l_linenumber = 3 OR l_linenumber >= 5) AS has_visuals FROM lineitem GROUP BY 1")
def _(spark, d):
    own = ad.mixed_blocks(ad.table(spark, d, "lineitem")).withColumn("kind", F.col("type")).withColumn("uri", F.lit(""))
    return metrics.visual_documents(own)


@query("j14_rebound", "SELECT p_partkey AS fragment_id, p_size AS old_entry, p_size + 1 AS entry_id FROM part WHERE p_partkey % 11 >= p_size % 5 + 6 OR p_partkey % 4 >= p_size % 2 + 2")
def _(spark, d):
    part = ad.table(spark, d, "part")
    found = part.select(F.col("p_partkey").alias("fragment_id"), (F.col("p_size") + 1).alias("entry_id"), (F.col("p_partkey") % 11).alias("score"), (F.col("p_partkey") % 4).alias("hits"))
    return kb.rebound(found, part.select(F.col("p_partkey").alias("fragment_id"), F.col("p_size").alias("entry_id"), (F.col("p_size") % 5).alias("score"), (F.col("p_size") % 2).alias("hits")))


LINKED = """WITH own AS (SELECT p_partkey AS e, p_partkey // 60 AS d, p_partkey % 50 + 1 AS k, p_size AS n FROM part), i AS (SELECT d, k, max(e) AS target FROM own GROUP BY 1, 2)
SELECT e AS entry_id, '按' || CASE WHEN target IS NULL THEN '第 ' || n || ' 条' ELSE '[第 ' || n || ' 条](#' || target || ')' END || '执行' AS content FROM own LEFT JOIN i ON i.d = own.d AND i.k = own.n"""


@query("j16_cross_references", LINKED)
def _(spark, d):
    part = ad.table(spark, d, "part")
    own = part.select(F.floor(F.col("p_partkey") / 60).alias("document_id"), F.col("p_partkey").alias("entry_id"), F.col("p_partkey").alias("position"), F.concat(F.lit("总则 / 第 "), (F.col("p_partkey") % 50 + 1).cast("string"), F.lit(" 条")).alias("title"), F.concat(F.lit("按第 "), F.col("p_size").cast("string"), F.lit(" 条执行")).alias("content"))
    none = own.where("false").select("document_id", "entry_id", F.lit(0).alias("seq"), F.lit("").alias("id"), F.lit("").alias("role"), F.lit("").alias("text"), F.lit("").alias("caption"))
    return align.cross_references(own, none).select("entry_id", "content")


BORROWED = f"""WITH {sql.BOXES}, o AS (SELECT *, lead(page_number) OVER w AS p, lead(kind) OVER w AS k FROM boxes WINDOW w AS (PARTITION BY document_id ORDER BY seq))
SELECT document_id, seq, kind <> 'figure' AND coalesce(p = page_number + 1 AND k = 'figure', FALSE) AS borrowed FROM o"""


@query("j17_borrowed", BORROWED)
def _(spark, d):
    own = boxes(spark, d).withColumns({"position": F.col("seq"), "labels": F.array("kind"), "wanted": F.lit("figure")})
    return align.borrowed_captions(own).select("document_id", "seq", "borrowed")


@query("j18_synced", "SELECT p_partkey, CASE WHEN length(p_type) > length(p_name) * 1.2 THEN p_type ELSE p_name END AS text, length(p_type) > length(p_name) * 1.2 AS synced FROM part")
def _(spark, d):
    part = ad.table(spark, d, "part").withColumns({"title": F.col("p_brand"), "clause": F.col("p_partkey")})
    return align.synced_clauses(part.select("p_partkey", "title", "clause", F.col("p_name").alias("text")), part.select("title", "clause", F.col("p_type").alias("text"))).select("p_partkey", "text", "synced")


@query("a18_outcomes", "SELECT event_type AS outcome, count(*) AS n FROM events GROUP BY 1")
def _(spark, d):
    return metrics.outcome_counts(ad.table(spark, d, "events").select(F.col("event_type").alias("outcome")))


@query("a19_status", "SELECT l_orderkey AS run_id, CASE WHEN bool_and(l_returnflag = 'N') THEN 'ok' WHEN bool_or(l_returnflag = 'N') THEN 'partial' ELSE 'failed' END AS status FROM lineitem GROUP BY 1")
def _(spark, d):
    return metrics.overall_status(ad.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("run_id"), F.when(F.col("l_returnflag") == "N", "ok").otherwise("error").alias("status")))


SEARCHED = f"""WITH {sql.LINES}, t AS (SELECT doc_id, reading_order, text FROM lines), f AS (SELECT doc_id, text, min(reading_order) AS i FROM t GROUP BY 1, 2), n AS (SELECT *, lead(text) OVER (PARTITION BY doc_id ORDER BY i) AS following FROM f)
SELECT doc_id AS document_id, coalesce(string_agg(text, chr(10) ORDER BY i), '') AS search_text FROM n WHERE NOT coalesce(starts_with(following, text), FALSE) GROUP BY doc_id"""


@query("w17_search_text", SEARCHED)
def _(spark, d):
    return segment.search_text(ad.line_blocks(docs(spark, d)).withColumn("role", F.lit("body")))


SNAPSHOTS = f"""WITH {sql.BOXES}, o AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY CASE kind WHEN 'figure' THEN 0 WHEN 'caption' THEN 1 ELSE 2 END, page_number, x, seq) AS rank FROM boxes)
SELECT document_id AS entry_id, seq, rank, rank = 1 AS is_main FROM o"""


@query("w14_snapshots", SNAPSHOTS)
def _(spark, d):
    kind = F.when(F.col("kind") == "figure", "legend").when(F.col("kind") == "caption", "table").otherwise("other")
    own = boxes(spark, d).select(F.col("document_id").alias("entry_id"), "seq", "page_number", F.col("x").alias("idx"), F.lpad(F.col("seq").cast("string"), 9, "0").alias("name"), kind.alias("kind"))
    return segment.snapshots_first(own).select("entry_id", "seq", "rank", "is_main")


MARKERS = f"""WITH {sql.BOXES}, o AS (SELECT document_id, page_number, seq, seq % 3 = 1 AS marks, CASE WHEN seq % 3 = 1 THEN seq || '.' ELSE 't' || seq END AS t FROM boxes),
n AS (SELECT *, lag(marks) OVER w AS lead, lag(t) OVER w AS before, lead(t) OVER w AS following FROM o WINDOW w AS (PARTITION BY document_id ORDER BY page_number, seq))
SELECT document_id, seq, CASE WHEN lead THEN before || ' ' || t ELSE t END AS text FROM n WHERE NOT marks OR following IS NULL"""


@query("w10_markers", MARKERS)
def _(spark, d):
    own = boxes(spark, d).select("document_id", "page_number", F.col("seq").alias("reading_order"), "seq", F.when(F.col("seq") % 3 == 1, F.concat(F.col("seq").cast("string"), F.lit("."))).otherwise(F.concat(F.lit("t"), F.col("seq").cast("string"))).alias("text"))
    return segment.marker_merges(own).select("document_id", "seq", "text")


@query("w10_clauses", "SELECT p_partkey, part, CASE part WHEN 1 THEN p_name WHEN 2 THEN p_size || '.1 first' ELSE p_size || '.2 second' END AS text FROM part, (SELECT unnest([1, 2, 3]) AS part)")
def _(spark, d):
    size = F.col("p_size").cast("string")
    own = ad.table(spark, d, "part").select("p_partkey", F.concat("p_name", F.lit(" "), size, F.lit(".1 first "), size, F.lit(".2 second")).alias("text"))
    return segment.inline_clauses(own)


INSERTED = f"""WITH {sql.BOXES}, b AS (SELECT document_id, page_number, seq, 'b' || seq AS id, row_number() OVER (PARTITION BY document_id, page_number ORDER BY seq) - 1 AS slot, count(*) OVER (PARTITION BY document_id, page_number) AS slots FROM boxes WHERE kind <> 'figure'),
i AS (SELECT document_id, page_number, 'i' || seq AS id, seq, row_number() OVER (PARTITION BY document_id, page_number ORDER BY seq) - 1 AS rank, count(*) OVER (PARTITION BY document_id, page_number) AS total FROM boxes WHERE kind = 'figure'),
p AS (SELECT i.*, (SELECT max(b.seq) FROM b WHERE b.document_id = i.document_id AND b.page_number = i.page_number AND b.slot = greatest(0, least(b.slots - 1, CAST(floor(((i.rank + 1) * b.slots - 1) / CAST(i.total AS DOUBLE)) AS BIGINT)))) AS anchor FROM i),
r AS (SELECT document_id, id, seq AS anchor, 0 AS behind, 0 AS rank FROM b UNION ALL SELECT document_id, id, coalesce(anchor, 1000000000), 1, rank FROM p)
SELECT document_id AS entry_id, row_number() OVER (PARTITION BY document_id ORDER BY anchor, behind, rank, id) AS position, id FROM r"""


@query("w13_inserted", INSERTED)
def _(spark, d):
    from pyspark.sql import Window

    page = Window.partitionBy("document_id", "page_number")
    own = boxes(spark, d)
    name = lambda p: F.concat(F.lit(p), F.col("seq").cast("string"))
    blocks = own.where("kind <> 'figure'").select(F.col("document_id").alias("entry_id"), "seq", "page_number", F.lit("code").alias("type"), name("b").alias("id"))
    items = own.where("kind = 'figure'").select(F.col("document_id").alias("entry_id"), name("i").alias("id"), "page_number", (F.row_number().over(page.orderBy("seq")) - 1).alias("rank"), F.count("*").over(page).alias("total"))
    return segment.inserted(blocks, items).select("entry_id", F.col("position").cast("long").alias("position"), "id")


@query("k08_metadata", "SELECT l_suppkey AS document_id, count(*) AS entries_count, count(*) FILTER (l_linenumber = 3) AS tables_count, count(DISTINCT CASE WHEN l_partkey % 3 <> 0 THEN l_partkey END) AS images_count FROM lineitem GROUP BY 1")
def _(spark, d):
    item = ad.table(spark, d, "lineitem")
    entries = item.select(F.col("l_suppkey").alias("document_id"), F.lit("e").alias("entry_id"), F.when(F.col("l_linenumber") == 3, "table").otherwise("text").alias("kind"))
    return kb.file_metadata(entries, item.select(F.col("l_suppkey").alias("document_id"), F.when(F.col("l_partkey") % 3 != 0, F.col("l_partkey").cast("string")).otherwise(" ").alias("image_uri")))


@query("k03_assets", "SELECT DISTINCT sha256(p_type) AS sha256, 'img_' || substr(sha256(p_type), 1, 32) || '.png' AS name FROM part")
def _(spark, d):
    return publish.assets(ad.table(spark, d, "part").select(F.col("p_type").cast("binary").alias("content"), F.lit("png").alias("ext"))).select("sha256", "name")


UPSERTED = """SELECT coalesce(a.k, b.k) AS entry_id, coalesce(b.t, a.t) AS title, greatest(coalesce(a.n, b.n), coalesce(b.n, a.n)) AS images_count
FROM (SELECT p_partkey AS k, p_name AS t, p_size AS n FROM part WHERE p_partkey % 3 <> 0) a FULL JOIN (SELECT p_partkey AS k, CASE WHEN p_size % 2 = 0 THEN p_type END AS t, p_partkey % 50 AS n FROM part WHERE p_partkey % 5 <> 0) b ON a.k = b.k"""


@query("k04_upserted", UPSERTED + " WHERE coalesce(b.t, a.t) IS NOT NULL")
def _(spark, d):
    part = ad.table(spark, d, "part")
    current = part.where("p_partkey % 3 <> 0").select(F.col("p_partkey").alias("entry_id"), F.col("p_name").alias("title"), F.col("p_size").cast("long").alias("images_count"))
    changes = part.where("p_partkey % 5 <> 0").select(F.col("p_partkey").alias("entry_id"), F.when(F.col("p_size") % 2 == 0, F.col("p_type")).alias("title"), (F.col("p_partkey") % 50).alias("images_count"))
    return publish.upsert(current, changes).where("title is not null")


@query("k09_manifest", f"WITH {sql.BOXES} SELECT document_id, seq, kind || '_p' || lpad(CAST(page_number AS VARCHAR), 3, '0') || '_' || row_number() OVER (PARTITION BY document_id, kind, page_number ORDER BY seq) || '.png' AS out_file FROM boxes")
def _(spark, d):
    return publish.manifest(boxes(spark, d)).select("document_id", "seq", "out_file")


@query("k10_unreferenced", "SELECT 'a/' || p_partkey || '.PNG' AS path FROM part WHERE p_partkey % 4 <> 0")
def _(spark, d):
    part = ad.table(spark, d, "part")
    return publish.unreferenced_files(part.select(F.concat(F.lit("a/"), F.col("p_partkey").cast("string"), F.lit(".PNG")).alias("path")), part.where("p_partkey % 4 = 0").select(F.concat(F.lit("b/c/"), F.col("p_partkey").cast("string"), F.lit(".png")).alias("uri")))


@query("k11_categories", "SELECT CASE WHEN p_size % 4 = 0 THEN 'none' ELSE p_brand END AS category, count(*) AS entries, count(DISTINCT p_partkey % 9) AS documents, CAST(sum(length(p_name)) AS BIGINT) AS chars FROM part GROUP BY 1")
def _(spark, d):
    own = ad.table(spark, d, "part").select((F.col("p_partkey") % 9).alias("document_id"), F.when(F.col("p_size") % 4 == 0, " ").otherwise(F.col("p_brand")).alias("category"), F.col("p_name").alias("content"))
    return metrics.category_index(own)


@query("s18_pages", f"WITH {sql.BOXES} SELECT document_id, seq FROM boxes WHERE page_number >= 2 AND page_number < 3")
def _(spark, d):
    return run.pages_between(boxes(spark, d), 2, 1).select("document_id", "seq")


PICTURES = """WITH t AS (SELECT p_partkey AS k, p_partkey // 20 AS d, p_partkey % 5 AS page, p_partkey % 20 AS pos FROM part)
SELECT k AS p_partkey, coalesce(CASE WHEN k % 3 = 0 THEN 'x/table_p' || page || '_pos' || pos || '.png' WHEN k % 3 = 1 THEN 'x/table_pos' || pos || '.jpg' END, 'none') AS path FROM t"""


@query("s16_table_pictures", PICTURES)
def _(spark, d):
    k = F.col("p_partkey")
    own = ad.table(spark, d, "part").select("p_partkey", F.floor(k / 20).alias("document_id"), (k % 5).alias("page_number"), (k % 20).alias("position"), F.lit(-1).alias("idx"))
    page, pos = (F.col(c).cast("string") for c in ("page_number", "position"))
    name = F.when(k % 3 == 0, F.concat(F.lit("x/table_p"), page, F.lit("_pos"), pos, F.lit(".png"))).when(k % 3 == 1, F.concat(F.lit("x/table_pos"), pos, F.lit(".jpg"))).otherwise("x/other.png")
    return readers.table_picture_of(own, own.select("document_id", name.alias("path"))).select("p_partkey", named(F.col("path")).alias("path"))


@query("o09_streams", "SELECT CASE WHEN l_linenumber = 3 THEN 'table' ELSE 'legend' END AS stream, count(*) AS n, count(*) FILTER (l_linenumber = 3) AS cells FROM lineitem WHERE l_linenumber >= 3 GROUP BY 1")
def _(spark, d):
    item = ad.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    both = kb.visual_streams(item.where("l_linenumber = 3").withColumn("cells", F.lit(1)), item.where("l_linenumber > 3"))
    return both.groupBy("stream").agg(F.count("*").alias("n"), F.count("cells").alias("cells"))


DISTINCT = """WITH w AS (SELECT p_partkey, string_split(p_name || ' ' || p_type, ' ') AS w FROM part), u AS (SELECT p_partkey, unnest(w) AS x, unnest(range(len(w))) AS i FROM w), f AS (SELECT p_partkey, x, min(i) AS i FROM u WHERE x <> '' GROUP BY 1, 2)
SELECT p_partkey, string_agg(x, ',' ORDER BY i) AS words FROM f GROUP BY p_partkey"""


@query("o11_distinct", DISTINCT)
def _(spark, d):
    return ad.table(spark, d, "part").select("p_partkey", F.array_join(kb.first_of_each(F.split(F.concat_ws(" ", "p_name", "p_type"), " ")), ",").alias("words"))


NEAREST = """WITH e AS (SELECT o_custkey % 20 AS d, o_orderkey AS entry_id, o_orderkey % 300 AS page FROM orders), r AS (SELECT d, entry_id, abs(page - 100) AS apart, row_number() OVER (PARTITION BY d ORDER BY abs(page - 100), page, entry_id) AS rank FROM e)
SELECT d AS document_id, entry_id, apart, rank FROM r WHERE rank <= 6"""


@query("o12_nearest", NEAREST)
def _(spark, d):
    entries = ad.table(spark, d, "orders").select((F.col("o_custkey") % 20).alias("document_id"), F.col("o_orderkey").alias("entry_id"), (F.col("o_orderkey") % 300).alias("page_number"))
    targets = entries.select("document_id").distinct().withColumn("target_page", F.lit(100))
    return kb.nearest_pages(entries, targets).select("document_id", "entry_id", "apart", F.col("rank").cast("long").alias("rank"))


TURN_AUDIT = """SELECT conv_id AS document_id, count(*) AS blocks, count(*) FILTER (role = 'user') AS headings FROM conversations GROUP BY 1"""


@query("a08_audit", TURN_AUDIT)
def _(spark, d):
    return metrics.semantic_audit(turns(spark, d)).select("document_id", "blocks", "headings")


OVERLAID = f"""WITH {sql.BOXES}, o AS (SELECT document_id, page_number, seq, kind, 'img_' || (x % 4) AS name FROM boxes), f AS (SELECT document_id, page_number, name, min(seq) AS source_seq FROM o WHERE kind = 'figure' GROUP BY 1, 2, 3)
SELECT o.document_id, o.page_number, o.seq, source_seq FROM o JOIN f USING (document_id, page_number, name) WHERE o.kind <> 'figure'"""


@query("j12_pictures", OVERLAID)
def _(spark, d):
    name = F.concat(F.lit("img_"), (F.col("x") % 4).cast("string"), F.lit(".png"))
    own = boxes(spark, d)
    return kb.overlaid_pictures(own.where("kind <> 'figure'").withColumn("uri", F.concat(F.lit("a/"), name)), own.where("kind = 'figure'").withColumn("uri", F.concat(F.lit("file:///b/"), F.upper(name), F.lit("?v=1"))))


COVERING = sql.OVERLAPPING.replace("(kind)", "caption").replace(f" OR {sql.SHARED} >= (least) * greatest(1, b.w * b.h)", "").replace("(least)", "0.1")
CROPS = f"""WITH RECURSIVE {sql.BOXES}, {COVERING},
{sql.FIRST_FIT.replace("(order)", "a_seq, b_seq").replace("(counts)", "TRUE")}
SELECT a.document_id, a.page_number, a.seq, a.x, a.y, a.w, a.h, coalesce(l.b_seq, -1) AS right_seq, 'embedded' AS asset_source FROM boxes a LEFT JOIN link l ON l.document_id = a.document_id AND l.page_number = a.page_number AND l.a_seq = a.seq WHERE a.kind = 'figure'
UNION ALL SELECT b.document_id, b.page_number, b.seq, b.x, b.y, b.w, b.h, -1, 'page_crop' FROM boxes b LEFT JOIN link l ON l.document_id = b.document_id AND l.page_number = b.page_number AND l.b_seq = b.seq WHERE b.kind = 'caption' AND l.b_seq IS NULL"""


@query("j04_pictures", CROPS)
def _(spark, d):
    own = layout.figure_pictures(boxes(spark, d, "figure").drop("score", "kind"), boxes(spark, d, "caption").drop("score", "kind"), 0.1)
    return own.withColumn("right_seq", F.coalesce("right_seq", F.lit(-1)))


SNAPSHOT_DIFF = """SELECT conv_id AS document_id, CASE WHEN conv_id % 5 = 0 THEN 'only_old' WHEN conv_id % 7 = 0 THEN 'only_new' WHEN conv_id % 3 = 0 THEN 'changed' ELSE 'same' END AS status FROM (SELECT DISTINCT conv_id FROM conversations) WHERE conv_id % 35 <> 0"""


@query("a16_snapshots", SNAPSHOT_DIFF)
def _(spark, d):
    own = segment.entries(turns(spark, d), "heading")
    other = own.where("document_id % 5 <> 0").withColumn("content", F.when(F.col("document_id") % 3 == 0, F.concat("content", F.lit(" more"))).otherwise(F.col("content")))
    return metrics.compared(metrics.digest(own.where("document_id % 7 <> 0")), metrics.digest(other))


BRIDGES = f"""WITH {sql.BOXES}, t AS (SELECT document_id, seq AS e, page_number + seq AS page, x, w FROM boxes WHERE kind = 'figure'), p AS (SELECT document_id, seq AS e, page_number + seq AS page, x, w, x % 2 = 0 AS own FROM boxes WHERE kind <> 'figure'),
f AS (SELECT t.document_id, t.e AS source, p.e, count(*) AS hits, sum(CASE WHEN abs(t.w - p.w) / CAST(greatest(t.w, p.w) AS DOUBLE) <= 0.06 THEN 6 WHEN abs(t.w - p.w) / CAST(greatest(t.w, p.w) AS DOUBLE) <= 0.12 THEN 4 WHEN abs(t.w - p.w) / CAST(greatest(t.w, p.w) AS DOUBLE) <= 0.2 THEN 2 ELSE 0 END
  + CASE WHEN t.x <= 0 OR p.x <= 0 THEN 0 WHEN abs(t.x - p.x) <= 30 THEN 4 WHEN abs(t.x - p.x) <= 80 THEN 2 ELSE 0 END) AS m, bool_or(own) AS own FROM t JOIN p ON p.document_id = t.document_id AND p.page = t.page - 1 AND t.page > 1 GROUP BY 1, 2, 3),
g AS (SELECT *, m + CASE WHEN own THEN 5 ELSE 0 END + CASE WHEN hits = 1 THEN 2 ELSE 0 END + CASE e % 3 WHEN 0 THEN 10 WHEN 1 THEN 2 ELSE 0 END - least(6, (source - e) // 15) AS score FROM f WHERE e < source),
r AS (SELECT *, row_number() OVER w AS r, lead(score) OVER w AS second FROM g WINDOW w AS (PARTITION BY document_id, source ORDER BY score DESC, e))
SELECT document_id, source AS entry_id, e AS target_id, CAST(score AS BIGINT) AS score FROM r WHERE r = 1 AND score >= 10 AND (second IS NULL OR score - second >= 3)"""


@query("j15_snapshot_bridges", BRIDGES)
def _(spark, d):
    own = boxes(spark, d).withColumns({"entry_id": F.col("seq"), "position": F.col("seq"), "page_number": F.col("page_number") + F.col("seq")})
    prefix = F.when(F.col("x") % 2 == 0, "a/Visual_p").otherwise("a/other_p")
    said = F.when(F.col("seq") % 3 == 0, "见图1的明细表").when(F.col("seq") % 3 == 1, "如图2").otherwise("无")
    return kb.snapshot_bridges(own.where("kind = 'figure'"), own.where("kind <> 'figure'").withColumn("uri", F.concat(prefix, F.col("page_number").cast("string"), F.lit("_1.png"))), own.where("kind <> 'figure'").withColumn("content", said))


LEGENDS = f"""WITH {sql.BOXES}, o AS (SELECT document_id, seq AS e, kind = 'figure' AS t, seq + page_number AS page, seq FROM boxes),
f AS (SELECT document_id, e, min(page) - 1 AS page FROM o WHERE t GROUP BY 1, 2), w AS (SELECT * FROM f WHERE page > 0 AND NOT EXISTS (SELECT 1 FROM o WHERE o.t AND o.document_id = f.document_id AND o.page = f.page)),
p AS (SELECT w.document_id, w.page, w.e, count(*) AS n, min(o.e) AS source, min(o.seq) AS seq FROM w JOIN o ON o.document_id = w.document_id AND o.page = w.page AND o.e <> w.e GROUP BY 1, 2, 3),
r AS (SELECT *, row_number() OVER (PARTITION BY document_id, page ORDER BY e) AS r FROM p WHERE n = 1)
SELECT document_id, e AS entry_id, source AS source_id, 'x/legend_p' || page || '_idx' || seq || '.png' AS uri FROM r WHERE r = 1"""


@query("j15_legend_bridges", LEGENDS)
def _(spark, d):
    uri = F.concat(F.lit("x/legend_p"), (F.col("seq") + F.col("page_number")).cast("string"), F.lit("_idx"), F.col("seq").cast("string"), F.lit(".png"))
    return kb.legend_bridges(boxes(spark, d).select("document_id", F.col("seq").alias("entry_id"), F.col("seq").alias("position"), (F.col("kind") == "figure").alias("is_table"), uri.alias("uri")))
