"""Operators on entries, manifest items and assets."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.operators import kb
from tests.test_expressions import values
from tests.test_operators import BOXES, both_orders, box


def test_candidates(spark):
    assert values(spark, ["电缆", "a", "[]", "abc", "a.b.", "ab1 !!!!!!", None, "null"], kb.effective_candidate) == [True, False, False, True, False, False, False, False]


def test_pure_captions_are_skipped(spark):
    frame = spark.createDataFrame([("legend", ["图3 布置", "图3  布置", ""]), ("legend", ["图3 布置", "其他"]), ("table", ["图3 布置"]), (None, ["布置"])], "kind string, signals array<string>")
    assert [r[0] for r in frame.select(kb.skips_alignment(F.col("kind"), F.col("signals"))).collect()] == [True, False, False, False]


def test_ocr_eligibility(spark):
    frame = spark.createDataFrame([("ready", "embedded", "a/b.png", False), ("missing", "embedded", "a", False), ("ready", "page_crop", "a", False), ("ready", "embedded", "../a", False), ("ready", "embedded", "/a", False), ("ready", "embedded", "a", True), ("ready", "embedded", None, False)], "s string, o string, u string, c boolean")
    assert [r[0] for r in frame.select(kb.ocr_skip_reason(*map(F.col, "souc"))).collect()] == [None, "not_ready", "not_embedded", "unsafe_uri", "unsafe_uri", "has_caption", "unsafe_uri"]


def test_covering_snapshots(spark):
    frame = spark.createDataFrame([("变电所 倒闸 作业 流程 记录", "倒闸 作业 流程"), ("变电所倒闸作业流程记录表", "变电所倒闸作业 其他"), ("变电所倒闸作业流程记录表", "完全不同的内容文字"), ("short", "x")], "a string, b string")
    assert [r[0] for r in frame.select(kb.covers_fragment(F.col("a"), F.col("b"))).collect()] == [True, False, False, False]


def test_rejected_fixes(spark):
    rows = [("原文内容", "原文内容。", "paragraph"), ("原文", "", "cell"), ("原文", "x" * 40, "cell"), ("a", "a\n\n\nb", "cell"), ("[IMAGE_REF:1] a", "a [IMAGE_REF:2]", "cell"), ("第3条 应当", "应当检查", "paragraph")]
    frame = spark.createDataFrame(rows, "o string, f string, k string")
    assert [r[0] for r in frame.select(kb.rejected_fix(*map(F.col, "ofk"))).collect()] == [None, "empty_result", "length_delta_too_large", "unexpected_multiline", "image_placeholder_changed", "anchor_lost"]


def test_recognised_captions(spark):
    texts = ["图4 人工呼吸示意", "图4", "图4 与 图5 对照", "没有标签", "", "见图4 所示位置", "图4 HOTxyz"]
    assert values(spark, texts, lambda c: kb.caption_status(c, F.lit(90.0))) == ["linked", "label_only", "ambiguous_multiple_labels", "rejected", "empty", "rejected", "rejected"]
    assert values(spark, texts[:1], lambda c: kb.caption_status(c, F.lit(20.0))) == ["rejected"]


def test_clauses(spark):
    rows = [(".0.1 应", "3", "3.2"), (".4 应", "3", "3.2"), ("2.5 应", "3", "3.2"), ("4.1 应", "3", "3.2"), ("1.1 应", "3", ""), ("应", "3", "3.2")]
    frame = spark.createDataFrame(rows, "t string, c string, s string")
    assert [r[0] for r in frame.select(kb.full_clause(*map(F.col, "tcs"))).collect()] == ["3.0.1", "3.2.4", "3.2.5", "3.4.1", "3.1.1", None]
    got = values(spark, ["8. 配电装置应当符合下列各项规定，并定期检查。", ".配电装置应检查", "（1）项", "一、目的", "正文"], kb.sequential_clause)
    assert [(r.number, r.text) if r else None for r in got] == [(8, "配电装置应当符合下列各项规定，并定期检查。"), (None, "配电装置应检查"), None, None, None]


def test_fallbacks(spark):
    entries = spark.createDataFrame([(1, "a", 3, "总则", "布置 说明", 3, 2), (1, "b", 3, "检修 作业", "x", 9, 1)], "document_id int, entry_id string, page_number int, title string, content string, dominant_page int, position int")
    items = [(1, "i1", 3, "检修"), (1, "i2", 3, "布置 说明"), (1, "i3", 3, "none"), (1, "i4", 8, "检修")]
    got = {r.item_id: (r.entry_id, r.method) for r in both_orders(spark, items, "document_id int, item_id string, page_number int, heading string", lambda d: kb.fallback_entries(d, entries))}
    assert got == {"i1": ("b", "heading"), "i2": ("a", "heading"), "i3": ("a", "dominant_page")}


def test_heading_hints_are_used_once(spark):
    hints = spark.createDataFrame([(1, 4, 1, "table", "T4"), (1, 5, 1, "legend", "L5"), (1, 5, 2, "table", "T5")], "document_id int, page_number long, seq long, kind string, text string")
    crops = [(1, 5, 1, "table"), (1, 5, 2, "table"), (1, 6, 1, "table"), (1, 9, 1, "table")]
    got = {(r.page_number, r.seq): r.heading for r in both_orders(spark, crops, "document_id int, page_number long, seq long, kind string", lambda d: kb.heading_hints(d, hints))}
    assert got == {(5, 1): "T5", (5, 2): "T4", (6, 1): "L5"}


def test_overlay_and_anchor(spark):
    schema = "document_id int, page_number int, seq long, text string"
    source = spark.createDataFrame([(1, 1, 7, "变电所倒闸作业"), (1, 1, 8, "检修记录")], schema)
    got = {r.seq: r.source_seq for r in both_orders(spark, [(1, 1, 1, "倒闸作业"), (1, 1, 2, "变电所 倒闸"), (1, 1, 3, "检修 记录"), (1, 2, 4, "检修记录")], schema, lambda d: kb.overlaid(d, source))}
    assert got == {1: 7, 3: 8}
    score = lambda text, kind, target: spark.range(1).select(kb.anchor_score(F.lit(text), F.lit(True), F.lit(False), F.lit(10), F.lit(0.5), F.lit(kind), F.lit(target))).first()[0]
    assert score("图3 接线图", "legend", "图3") == 120 - 10 + 45 + 260 + 150 + 80
    assert score("一般说明文字", "table", "") == 120 - 10 + 45 - 180


def test_texts_that_name_a_visual(spark):
    box = "x int, y int, w int, h int"
    texts = spark.createDataFrame([(1, "e", 1, 1, "一般说明", 0, 0, 100, 10), (1, "e", 1, 2, "系统构成见", 0, 100, 100, 10), (1, "e", 1, 3, "图3 接线图", 0, 120, 100, 10), (1, "e", 1, 4, "正文内容很长很长很长很长很长很长很长很长", 0, 400, 100, 10), (1, "e", 1, 5, " ", 0, 410, 100, 10)], f"document_id int, entry_id string, page_number int, seq int, text string, {box}")
    visuals = spark.createDataFrame([(1, "e", 1, 9, "legend", "图3", 0, 140, 100, 200), (1, "e", 2, 10, "table", "", 0, 0, 10, 10), (1, "f", 1, 11, "table", "", 0, 0, 10, 10)], f"document_id int, entry_id string, page_number int, seq int, kind string, caption string, {box}")
    entries = spark.createDataFrame([(1, "e", "第一章")], "document_id int, entry_id string, title string")
    got = {r.seq: (r.anchor_text, r.heading_text) for r in kb.visual_anchors(visuals, texts, entries).collect()}
    assert got == {9: ("系统构成见 图3 接线图", "系统构成见 图3 接线图"), 10: ("第一章", "第一章"), 11: ("", "")}


def test_moves(spark):
    blocks = spark.createDataFrame([(1, "a", 9, 2), (1, "a", 3, 2), (1, "a", 8, 2)], "document_id int, entry_id string, block_page int, entry_page int")
    entries = spark.createDataFrame([(1, "b", 9, 1), (1, "c", 9, 2), (1, "d", 3, 3)], "document_id int, entry_id string, page_number int, position int")
    assert {r.block_page: r.entry_id for r in kb.page_owners(blocks, entries).collect()} == {9: "c", 3: "a", 8: "a"}
    tables_ = spark.createDataFrame([(1, 1, "u"), (1, 2, None), (1, 3, None)], "entry_id int, seq int, uri string")
    shots = spark.createDataFrame([(1, 1, "s1"), (1, 2, "s2"), (1, 3, "s3")], "entry_id int, seq int, uri string")
    assert {r.uri: r.block_seq for r in kb.attached_snapshots(tables_, shots).collect()} == {"s1": 2, "s2": 3, "s3": None}


def test_stacked_boxes_merge_until_none_is_left(spark):
    rows = [box(1, 1, 0, 0, 100, 20), box(1, 2, 0, 25, 100, 20), box(1, 3, 5, 50, 90, 20), box(1, 4, 300, 0, 50, 20), box(1, 5, 0, 75, 100, 20, kind="text")]
    got = {r.seq: (r.x, r.y, r.w, r.h) for r in both_orders(spark, rows, BOXES, lambda d: kb.merged_to_fixpoint(d.drop("score")))}
    assert got == {1: (0, 0, 100, 70), 4: (300, 0, 50, 20), 5: (0, 75, 100, 20)}


def test_marks_and_caches(spark):
    assert values(spark, ["(a)", "1)", "图注", None], kb.label_only) == [True, True, False, False]
    assert values(spark, ["(a)气道通畅(b) 气道阻塞", "（A） (a)", "none"], kb.panel_markers) == [2, 1, 0]
    frame = spark.createDataFrame([("linked", None), ("error", None), ("rejected", "OCR timeout"), ("rejected", "low_confidence")], "s string, r string")
    assert [r[0] for r in frame.select(kb.cacheable(F.col("s"), F.col("r"))).collect()] == [True, False, False, True]


def test_audits(spark):
    from quire.operators import metrics
    from quire.plans import publish

    blocks = spark.createDataFrame([(1, "heading", "总则", "text", None), (1, None, "电力�管理", "text", "data:image/png;base64,xx"), (2, "caption", "图1", "text", None)], "document_id int, role string, text string, kind string, uri string")
    assert sorted(map(tuple, metrics.semantic_audit(blocks).collect())) == [(1, 2, 1, 1, 0, 0, 1), (2, 1, 0, 0, 0, 1, 0)]
    assert sorted(map(tuple, metrics.visual_documents(blocks).collect())) == [(1, True), (2, False)]
    assert publish.without_inline_payloads(blocks).where("uri is not null").count() == 0
    entries = spark.createDataFrame([(1, "a", "xy"), (2, " ", "z"), (2, None, None)], "document_id int, category string, content string")
    assert sorted(map(tuple, metrics.category_index(entries).collect())) == [("a", 1, 1, 2), ("none", 2, 1, 1)]
