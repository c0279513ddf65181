"""Text, role and box expressions on small inline tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quire.functions import geometry as geo
from quire.functions import roles
from quire.functions import text as tx
from quire.functions.geometry import Box
from quire.operators import tables


def values(spark, rows, column):
    """The column's value for each of the texts."""
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, t string")
    return [r[0] for r in frame.orderBy("i").select(column(F.col("t"))).collect()]


def test_search_normal(spark):
    assert values(spark, ["a,b  c\n d!", None, "  ", "图 1-1：说明", "x_y"], tx.search_normal) == ["a b c\nd", "", "", "图 1 1 说明", "x y"]


def test_composition(spark):
    assert values(spark, ["e\u0301", "abc", "Å", None], tx.normal_form) == ["\u00e9", "abc", "Å", ""]
    assert values(spark, ["ｈ５００", "①"], lambda c: tx.normal_form(c, True)) == ["h500", "1"]


def test_labels_of_different_writing_share_a_key(spark):
    assert values(spark, ["图1-1", "图1.1", "图11"], tx.anchor_key) == ["图11"] * 3
    assert values(spark, ["图1-1", "图1.1", "图11"], lambda c: tx.anchor_key(c, strict_labels=True)) == ["图1-1", "图1-1", "图11"]


def test_labels_in_order_once(spark):
    assert values(spark, ["见图2和参见图3以及图2", "no label", None], tx.labels) == [["图2", "图3"], [], []]
    (pairs, *_) = values(spark, ["图 2 与 图2"], tx.label_pairs)
    assert [(p.raw, p.key) for p in pairs] == [("图 2", "图2")]


def test_fingerprint(spark):
    assert values(spark, ["说明 图3 总体布置", "第12条 范围 (一)", "附表2：名称"], tx.fingerprint) == ["总体布置", "范围一", "名称"]


def test_numerals(spark):
    assert values(spark, ["十二", "一百零三", "二十", "7", "两千", "x", "", "〇"], tx.numeral) == [12, 103, 20, 7, 2000, None, None, 0]


def test_number_chains(spark):
    assert values(spark, ["1 . 2．3", None], tx.number_chain) == ["1.2.3", ""]
    assert values(spark, [".3 title", "4.1 x"], lambda c: tx.replace_leading_number(c, F.lit("2.3"))) == ["2.3 title", "2.3 x"]
    assert values(spark, ["3.4", "2.9", ""], lambda c: tx.next_section_number(F.lit("3"), c)) == ["3.5", "3.1", "3.1"]
    assert values(spark, ["3.2.1 a", "12 b", "none"], tx.item_number) == [30201, None, None]


def test_similarity(spark):
    frame = spark.createDataFrame([("abcd", "abcx"), ("abc", ""), ("abc", "xyz"), ("abc", "abc"), (None, "a")], "a string, b string")
    got = [r[0] for r in frame.select(tx.levenshtein_similarity(F.col("a"), F.col("b"), 0.9)).collect()]
    assert got == [0.75, 0.0, 0.0, 1.0, 0.0]


def test_tokens_without_generic_terms(spark):
    assert values(spark, ["检查 电缆 a bb 设备"], tx.match_tokens) == [["电缆", "bb"]]


def test_suspicion(spark):
    got = values(spark, ["电力管理规则", "电力�管理", "电a力b管c理", "电 力 管 理", "!!!! ----", None, "[IMAGE_REF:x]"], tx.suspicion)
    assert [r.score for r in got] == [0.0, 9.6, 5.0, 2.5, 3.5, 0.0, 0.0]
    assert got[1].reasons == ["replacement_char", "garbled_symbol_cluster", "unexpected_symbol_ratio"] and got[2].reasons == ["cjk_inline_latin_fragment", "lowercase_inline_latin"]
    assert got[5].reasons == [] and got[5].compact_length == 0


def test_correction_gate(spark):
    gate = lambda relaxed: lambda c: tx.needs_correction(tx.suspicion(c), relaxed)
    texts = ["电力�管理", "电 力 管 理", "�"]
    assert values(spark, texts, gate(False)) == [True, False, False]
    assert values(spark, texts, gate(True)) == [True, True, False]


def test_paths(spark):
    assert values(spark, ["A b\\C-d//é", None], tx.path_safe) == ["a_b/c_d/é", ""]
    assert values(spark, ["x/page_012_3.png?q=1", "p7.jpg", "none"], tx.page_of_uri) == [12, 7, None]
    assert values(spark, ["", "b"], lambda c: tx.first_of(F.lit(None), F.lit(" "), c, F.lit("z"))) == ["z", "b"]


def test_watermarks(spark):
    assert values(spark, ["编号 2024-001", "12345", "第三章 123", "a123", "abc 123 456", "图1 234 a"], tx.watermark_plausible) == [True, False, False, False, True, False]


def test_projection(spark):
    assert values(spark, ["heading", "legend", "figure_callout", "artifact", "new role", None, " ARTIFACT "], roles.projection_class) == ["searchable", "supporting", "supporting", "excluded", "searchable", "searchable", "excluded"]


def test_headings(spark):
    got = values(spark, ["第三章 总则", "第2节 范围", "一、目的", "5.1一般规定", "5.1.2 检查内容。", "3 范围", "2）项目", "正文。", None], roles.heading)
    assert [(r.level, r.number, r.value) if r else None for r in got] == [("chapter", "三", 3), ("section", "2", 2), ("subsection", "一", 1), ("section", "5.1", None), ("clause", "5.1.2", None), ("chapter", "3", 3), None, None, None]


def test_anchors(spark):
    got = values(spark, ["第十二条 应当", "附录2：表", "附表三 名", "条"], roles.anchor)
    assert [(r.kind, r.value) if r else None for r in got] == [("article", 12), ("appendix", 2), ("appendix_table", 3), None]


@pytest.mark.parametrize(("text", "y", "h", "want"), [("2", 320.34, 12.11, True), ("2", 120.0, 74.0, False), ("·2·", 150, 10, True), ("第2页", 150, 10, True), ("Page 2", 150, 10, True), ("-2-", 150, 10, True), ("", 5, 5, False), ("text", 5, 5, False)])
def test_page_markers(spark, text, y, h, want):
    row = spark.range(1).select(roles.page_marker(F.lit(text), Box(*map(F.lit, (216.6, y, 4.5, h))), F.lit(360.05))).first()
    assert row[0] is want


def test_display_headings(spark):
    b = Box(*map(F.lit, (34.32, 63.98, 175.55, 21.95)))
    shown = lambda t, size, page: spark.range(1).select(roles.display_heading(F.lit(t), b, F.lit(page), F.lit(size), F.lit(False))).first()[0]
    assert shown("铁路电力管理规则", 21.95, 360.05) and not shown("铁路电力管理规则", 9.0, 360.05) and not shown("2用于变电所倒闸作业", 21.95, 360.05) and not shown("铁路电力管理规则", 21.95, 100.0)


def test_figure_exclusion(spark):
    rows = [(0, 0, 200, 300, 500, 500, False), (10, 10, 14, 14, 4, 4, False), (20, 40, 80, 100, 60, 60, False), (10, 2, 30, 14, 40, 40, False), (0, 0, 200, 300, 500, 500, True), (5, 5, 5, 9, 50, 50, False), (0, 0, 9, 9, 0, 5, True)]
    frame = spark.createDataFrame([tuple(map(float, r[:6])) + (r[6],) for r in rows], "a double, b double, c double, d double, pw double, ph double, m boolean")
    reason = roles.figure_exclusion(*map(F.col, "abcd"), F.lit(200.0), F.lit(300.0), F.col("pw"), F.col("ph"), F.col("m"))
    assert [r[0] for r in frame.select(reason).collect()] == ["full_page_background", "tiny_decoration", None, "edge_icon", None, "empty_bbox", "invalid_pixel_size"]


def test_boxes(spark):
    a, b = Box(*map(F.lit, (0, 0, 10, 10))), Box(*map(F.lit, (5, 5, 10, 10)))
    got = spark.range(1).select(geo.intersection(a, b), geo.overlap_ratio(a, b), F.round(geo.iou(a, b), 6), geo.inside(a, b, 4), geo.inside(a, b, 5), geo.center_inside(a, b), geo.center_distance(a, b), geo.gap_1d(F.lit(0), F.lit(3), F.lit(7), F.lit(9))).first()
    assert tuple(got)[:6] == (25, 0.25, 0.142857, False, True, False) and round(got[6], 4) == 7.0711 and got[7] == 4
    e = geo.from_edges(F.lit(0.5), F.lit(1.5), F.lit(2.5), F.lit(2.5))
    assert tuple(spark.range(1).select(e.x, e.y, e.w, e.h).first()) == (0, 2, 2, 1)


@pytest.mark.parametrize(("xs", "ys", "rect", "want"), [([0, 10, 20, 30], [0, 10, 20], (10, 0, 30, 20), (0, 1, 2, 2)), ([0, 10, 20, 30], [0, 10, 20], (0, 0, 10, 10), (0, 0, 1, 1)), ([0, 50, 100], list(range(0, 121, 20)), (50, 20, 100, 120), (1, 1, 5, 1))])
def test_grid(spark, xs, ys, rect, want):
    lists = [F.array(*[F.lit(float(v)) for v in c]) for c in (xs, ys)]
    got = spark.range(1).select(tables.grid_cell(*lists, *[F.lit(float(v)) for v in rect]).alias("c")).first().c
    assert (got.row, got.col, got.row_span, got.col_span) == want


def test_merged_coordinates(spark):
    got = spark.range(1).select(tables.merged_coordinates(F.array(*[F.lit(v) for v in (1.0, 0.0, 0.4, 0.6, 1.2)]))).first()[0]
    assert got == [0.0, 0.6, 1.2]


def test_markdown_round_trip(spark):
    rows = [["a", "b|c"], ["1", "x\ny"], ["", " z "]]
    frame = spark.createDataFrame([(rows,)], "r array<array<string>>")
    text = frame.select(tables.markdown(F.col("r"))).first()[0]
    assert text == "| a | b\\|c |\n| --- | --- |\n| 1 | x y |\n|  | z |"
    assert spark.createDataFrame([(text,)], "t string").select(tables.parsed(F.col("t"))).first()[0] == [["a", "b|c"], ["1", "x y"], ["", "z"]]
