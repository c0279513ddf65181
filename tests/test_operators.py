"""Operators on small tables; results don't depend on input order or partitions."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from quire.operators import align, layout, metrics, references, repetition, retrieve, segment, tables

BLOCKS = "document_id long, page_number long, reading_order long, id string, role string, text string"
BOXES = "document_id long, page_number long, seq long, kind string, x long, y long, w long, h long, score double"


def both_orders(spark, rows, schema, run):
    """run() of the rows as they are and shuffled over other partitions gives the same."""
    shuffled = rows[:]
    random.Random(1).shuffle(shuffled)
    a = sorted(map(repr, run(spark.createDataFrame(rows, schema).coalesce(1)).collect()))
    b = sorted(map(repr, run(spark.createDataFrame(shuffled, schema).repartition(3)).collect()))
    assert a == b
    return run(spark.createDataFrame(rows, schema)).collect()


def test_entries_by_heading(spark):
    rows = [(1, 1, 1, "a", "body", "one"), (1, 1, 2, "b", "heading", "H"), (1, 1, 3, "c", "legend", "callout"), (1, 2, 1, "d", "body", "two"), (1, 2, 2, "e", "artifact", "x"), (2, 1, 1, "f", "legend", "only")]
    got = {r.entry_id: r for r in both_orders(spark, rows, BLOCKS, segment.entries)}
    assert set(got) == {"1_a", "1_b"}
    assert (got["1_a"].job_title, got["1_a"].content, got["1_a"].n_blocks) == ("Page 1", "one", 1)
    assert (got["1_b"].job_title, got["1_b"].content, got["1_b"].n_blocks) == ("H", "H\n\ntwo", 3)


FULL = BLOCKS + ", type string, image_uri string, asset_status string, markdown string"


def text_block(i, page, role, text, kind="text"):
    return (1, page, int(i[1:]), i, role, text, kind, None, None, None)


def entry_rows(spark, rows, strategy="heading"):
    got = both_orders(spark, rows, FULL, lambda d: segment.entries(d, strategy))
    return sorted((r.page_number, r.position, r.kind, r.job_title, r.content, ",".join(r.block_ids)) for r in got)


def test_supporting_blocks_join_their_pages_host(spark):
    rows = [text_block("c1", 1, "figure_callout", "c"), text_block("b2", 1, "heading", "H1"), text_block("c1", 2, "legend", "d"), text_block("b2", 2, "heading", "H2"), text_block("c1", 3, "legend", "e"), text_block("d1", 4, "body", "")]
    rows = [(*r[:3], f"{r[1]}{r[3]}", *r[4:]) for r in rows]
    assert entry_rows(spark, rows) == [(1, 1, "text", "H1", "H1", "1c1,1b2"), (2, 2, "text", "H2", "H2\n\n", "2c1,2b2,4d1")]
    # a text that goes on from the page before hosts what waits on its page, but not what follows it
    later = [text_block("b1", 1, "body", "one"), text_block("c1", 2, "legend", "x"), text_block("b2", 2, "body", "two"), text_block("c3", 2, "legend", "y")]
    later = [(*r[:3], f"{r[1]}{r[3]}", *r[4:]) for r in later]
    assert entry_rows(spark, later) == [(1, 1, "text", "Page 1", "one\n\ntwo", "1b1,2c1,2b2")]
    assert [r[-1] for r in entry_rows(spark, later, "page")] == ["1b1", "2c1,2b2,2c3"]
    assert entry_rows(spark, [text_block("c1", 1, "legend", "only"), text_block("x2", 1, "artifact", "noise")]) == []


def test_tables_and_figures(spark):
    picture = lambda i, page, uri="u", status=None: (1, page, int(i[1:]), f"{page}{i}", None, None, "figure", uri, status, None)
    table = lambda i, page, md: (1, page, int(i[1:]), f"{page}{i}", None, None, "table", None, None, md)
    text = lambda i, page, role, t: (1, page, int(i[1:]), f"{page}{i}", role, t, "text", None, None, None)
    assert entry_rows(spark, [picture("f1", 3)]) == [(3, 1, "figure", "Page 3", "", "3f1")]
    assert entry_rows(spark, [picture("f1", 3, ""), picture("f2", 3, "u", "missing")]) == []
    rows = [picture("f1", 1), text("c2", 1, "legend", "l"), text("b3", 1, "body", "one"), picture("f4", 1, ""), picture("f1", 2), picture("f2", 2, ""), table("t1", 3, "|a|"), text("b2", 3, "body", "three"), table("t3", 3, ""), text("b1", 4, "body", "four"), picture("f2", 4)]
    # the table of page 3 opens an entry, as that page has none; the picture after page 4's text has no host left
    assert entry_rows(spark, rows) == [(1, 1, "text", "Page 1", "one", "1c2,1f1,1b3,1f4"), (2, 1, "figure", "Page 2", "", "2f1"), (3, 3, "table", "Page 3", "|a|\n\nthree\n\nfour", "3t1,3b2,3t3,4b1")]
    assert [r[-1] for r in entry_rows(spark, rows, "page")] == ["1c2,1f1,1b3,1f4", "2f1", "3t1,3b2,3t3", "4b1,4f2"]


def test_entries_by_page(spark):
    rows = [(1, p, o, f"{p}{o}", "body", f"t{p}{o}") for p in (1, 2) for o in (1, 2)]
    got = sorted((r.position, r.page_number, r.job_title, r.content) for r in both_orders(spark, rows, BLOCKS, lambda d: segment.entries(d, "page")))
    assert got == [(1, 1, "Page 1", "t11\n\nt12"), (2, 2, "Page 2", "t21\n\nt22")]
    with pytest.raises(ValueError, match="strategy"):
        segment.entries(spark.createDataFrame(rows, BLOCKS), "other")


def box(doc, seq, x, y, w, h, kind="figure", page=1, score=0.0):
    return (doc, page, seq, kind, x, y, w, h, score)


def test_reading_order_and_gutter(spark):
    rows = [box(1, 1, 300, 10, 100, 10), box(1, 2, 10, 11, 100, 10), box(1, 3, 10, 30, 100, 10)]
    assert {r.seq: r.reading_order for r in both_orders(spark, rows, BOXES, segment.reading_order)} == {2: 1, 1: 2, 3: 3}
    two = [box(1, i, 20 if i < 3 else 300, 10 * (i % 3), 200, 8) for i in range(6)]
    (g,) = both_orders(spark, two, BOXES, segment.gutters)
    assert (g.gap, g.gutter_x) == (80, 260.0)
    assert both_orders(spark, two[:5], BOXES, segment.gutters) == []


def test_heading_context(spark):
    rows = [(1, 1, i, f"b{i:02}", r, t) for i, (r, t) in enumerate([("unit", "U"), ("section", "S"), (None, "x"), ("subsection", "T"), (None, "y"), ("section", "S2"), (None, "z"), ("unit", "V"), (None, "w")])]
    got = {r.id: r.path for r in both_orders(spark, rows, BLOCKS, lambda d: segment.heading_context(d, "role"))}
    assert [got[f"b{i:02}"] for i in (2, 4, 6, 8)] == ["U / S", "U / S / T", "U / S2", "V"]


def test_splits_merges_and_wraps(spark):
    rows = [(1, 0, None), (1, 1, 1), (1, 2, None), (1, 3, 2), (2, 0, 2), (2, 1, 1)]
    got = {(r.entry_id, r.seq): r.part for r in both_orders(spark, rows, "entry_id int, seq int, number int", segment.numbered_splits)}
    assert [got[1, i] for i in range(4)] == [0, 1, 1, 2] and got[2, 1] == 0
    chain = [(1, 1, 1, 1, 3), (1, 2, 2, 4, 5), (1, 3, 3, 6, 6), (1, 5, 4, 7, 8)]
    got = {r.position: r.merged_into for r in both_orders(spark, chain, "document_id int, page_number int, position int, first_number int, last_number int", segment.continuations)}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4}
    wrapped = spark.range(1).select(segment.soft_wrapped(F.array(*map(F.lit, ["a long", "line.", "next", "1. item", " ", "more"])))).first()[0]
    assert wrapped == ["a long line.", "next", "1. item more"]
    marks = [(1, 1, 1, "a", "body", "1."), (1, 1, 2, "b", "body", "text"), (1, 1, 3, "c", "body", "rest 5.1 first 5.2 second")]
    merged = segment.marker_merges(spark.createDataFrame(marks, BLOCKS))
    assert sorted(r.text for r in merged.collect()) == ["1. text", "rest 5.1 first 5.2 second"]
    assert sorted((r.part, r.text) for r in segment.inline_clauses(merged.where("id = 'c'")).collect()) == [(1, "rest"), (2, "5.1 first"), (3, "5.2 second")]


def test_search_text(spark):
    rows = [(1, 1, 1, "a", "body", "Intro"), (1, 1, 2, "b", "body", "Intro and more"), (1, 1, 3, "c", "figure", "pic"), (1, 2, 1, "d", "body", "end"), (1, 2, 2, "e", "body", "end")]
    assert [r.search_text for r in both_orders(spark, rows, BLOCKS, segment.search_text)] == ["Intro and more\nend"]


def test_snapshots_and_indexes(spark):
    rows = [(1, "table", 1, 1, "a"), (1, "legend", 2, 1, "b"), (1, "other", 1, 0, "c")]
    got = segment.snapshots_first(spark.createDataFrame(rows, "entry_id int, kind string, page_number int, idx int, name string")).collect()
    assert [r.name for r in sorted(got, key=lambda r: r.rank)] == ["b", "a", "c"] and [r.name for r in got if r.is_main] == ["b"]


def test_watermarks_and_signatures(spark):
    lines = [(1, p, "top" if k == 0 else "bottom" if k == 1 else None, ["Report 2024-117", f"Page {p} of 20", f"text {p}"][k]) for p in range(1, 21) for k in range(3)]
    schema = "document_id int, page_number int, zone string, text string"
    assert [(r.line, r.n_pages) for r in both_orders(spark, lines, schema, repetition.watermarks)] == [("Report2024117", 20)]
    assert sorted(r.signature for r in both_orders(spark, lines, schema, repetition.dynamic_signatures)) == ["bottom|Page#of#", "top|Report#-#"]
    assert len(both_orders(spark, lines, schema, repetition.without_artifacts)) == 20
    assert repetition.dynamic_signatures(spark.createDataFrame(lines[:6], schema)).count() == 0


REF = "document_id int, label string, page_number int, block_id string, cx double, cy double"


def resolved(spark, figures, refs):
    frame = spark.createDataFrame([(1, *f) for f in figures], REF)
    return both_orders(spark, [(1, *r) for r in refs], REF, lambda d: references.resolve(d, frame))


def test_unique_targets(spark):
    got = {(r.label, r.page_number): (r.status, r.target_id, r.page_delta) for r in resolved(spark, [("图1", 1, "f1", 0.0, 0.0), ("图2", 152, "f2", 0.0, 0.0)], [("图1", 1, "b1", 0.0, 0.0), ("图2", 151, "b2", 0.0, 0.0), ("图2", 153, "b3", 0.0, 0.0), ("图9", 3, "b4", 0.0, 0.0)])}
    assert got == {("图1", 1): ("resolved", "f1", 0), ("图2", 151): ("resolved", "f2", 1), ("图2", 153): ("resolved", "f2", -1), ("图9", 3): ("unresolved", None, None)}


def test_nearest_and_ties(spark):
    (near,) = resolved(spark, [("图10", 151, "fa", 70.0, 80.0), ("图10", 151, "fb", 140.0, 240.0)], [("图10", 151, "b", 130.0, 310.0)])
    assert (near.status, near.target_id, near.reason) == ("resolved", "fb", "nearest_same_page")
    (tie,) = resolved(spark, [("图5", 10, "f1", 0.0, 0.0), ("图5", 12, "f2", 0.0, 0.0)], [("图5", 11, "b", 0.0, 0.0)])
    assert (tie.status, tie.target_id, tie.reason) == ("ambiguous", None, "tied_page_distance:2")
    back = references.referenced_by(spark.createDataFrame([tie, near]))
    assert [(r.target_id, r.n_refs) for r in back.collect()] == [("fb", 1)]


def test_labels_and_clusters(spark):
    rows = [(1, "b", "图1", "ocr form", "ocr", 1), (1, "b", "图1", "native form", "native", 2), (1, "b", "图2", "x", "ocr", 3)]
    got = {r.key: r.raw for r in both_orders(spark, rows, "document_id int, block_id string, key string, raw string, source string, seq int", references.merged_labels)}
    assert got == {"图1": "native form", "图2": "x"}
    nodes = [("t", "图1", p, e, n, 0) for p, e, n in ((1, 1, 1), (3, 2, 5), (6, 3, 1), (8, 4, 1))]
    got = sorted(tuple(r)[2:] for r in both_orders(spark, nodes, "title string, label string, page_number int, entry_no int, n_images int, n_captions int", references.clusters))
    assert got == [(1, 2, 1, 3, 2), (2, 2, 6, 8, 3)]


def test_captions_are_linked_once(spark):
    figures = spark.createDataFrame([box(1, 1, 30, 40, 180, 160), box(1, 2, 230, 40, 180, 160)], BOXES)
    texts = [box(1, 3, 40, 210, 160, 16, "caption"), box(1, 4, 240, 215, 160, 16, "caption"), box(1, 5, 35, 212, 170, 10, "legend"), box(1, 6, 40, 500, 100, 10, "caption"), box(1, 7, 40, 230, 150, 10, "caption")]
    got = sorted((r.figure_seq, r.text_seq, r.kind) for r in both_orders(spark, texts, BOXES, lambda d: layout.associate(figures, d)))
    assert got == [(1, 3, "caption"), (1, 5, "legend"), (2, 4, "caption")]


def test_native_and_visual_tables(spark):
    visual = spark.createDataFrame([box(1, 9, 25, 205, 190, 70, "v"), box(1, 8, 500, 500, 20, 20, "v")], BOXES).drop("score", "kind")
    got = {r.seq: r for r in both_orders(spark, [box(1, 1, 20, 200, 200, 80, "n")], BOXES, lambda d: layout.merged_tables(d.drop("score", "kind"), visual))}
    assert (got[1].x, got[1].w, got[1].status, got[1].visual_matched) == (20, 200, "structured", True)
    assert got[8].status == "image_only" and set(got) == {1, 8}


def versions(spark, old, new):
    schema = "document_id int, page_number int, seq long, x double, y double, w double, h double"
    return [(r.old_seq, r.new_seq, r.method) for r in both_orders(spark, old, schema, lambda d: layout.matched_versions(d, spark.createDataFrame(new, schema)))]


def test_versions_of_tables(spark):
    assert versions(spark, [(1, 29, 1, 20.0, 200.0, 200.0, 80.0)], [(1, 29, 5, 22.0, 206.0, 199.0, 86.0)]) == [(1, 5, "page+bbox")]
    none = (None,) * 4
    assert sorted(versions(spark, [(1, 29, 1, *none), (1, 29, 2, *none)], [(1, 29, 5, *none), (1, 29, 6, *none), (1, 29, 7, *none)]), key=str) == [(1, 5, "page+order"), (2, 6, "page+order"), (None, 7, "unmatched")]


def test_suppression(spark):
    rows = [box(1, 1, 0, 0, 100, 100, score=0.9), box(1, 2, 5, 5, 100, 100, score=0.8), box(1, 3, 300, 0, 50, 50, score=0.1), box(1, 4, 10, 10, 30, 30, score=0.5), box(1, 5, 0, 0, 100, 100, page=2, score=0.2)]
    seqs = lambda run: sorted(r.seq for r in both_orders(spark, rows, BOXES, run))
    assert seqs(lambda d: layout.nms(d, 0.5)) == [1, 3, 4, 5]
    assert seqs(layout.pruned) == [1, 3, 5]
    assert seqs(layout.without_nested) == [1, 2, 3, 5]
    parent = [box(1, 1, 0, 0, 200, 400), box(1, 2, 0, 0, 200, 190), box(1, 3, 0, 200, 200, 200), box(1, 4, 500, 0, 200, 400)]
    assert sorted(r.seq for r in both_orders(spark, parent, BOXES, layout.without_containers)) == [2, 3, 4]
    texts = [box(1, 10, 0, 0, 10, 10), box(1, 11, 95, 0, 10, 10)]
    assert [r.seq for r in both_orders(spark, texts, BOXES, lambda d: layout.suppressed_text(d, spark.createDataFrame(rows[:1], BOXES)))] == [11]


def test_fragments(spark):
    rows = [box(1, 1, 0, 0, 50, 50), box(1, 2, 60, 0, 50, 50), box(1, 3, 115, 5, 50, 50), box(1, 4, 400, 400, 10, 10)]
    got = {r.group_seq: tuple(r)[3:] for r in both_orders(spark, rows, BOXES, layout.fragments)}
    assert got == {1: (3, -6, -6, 177, 67), 4: (1, 394, 394, 22, 22)}


CELL = "table_id int, row long, col long, row_span long, col_span long, text string"


def test_cell_diff(spark):
    cells = lambda rows: [(1, r, c, 1, 1, t) for r, line in enumerate(rows) for c, t in enumerate(line)]
    new = spark.createDataFrame(cells([["a", "b"], ["c", "X"]]), CELL)
    got = both_orders(spark, cells([["a", "b"], ["c", "d"]]), CELL, lambda d: tables.cell_diff(d, new))
    assert sorted((r.row, r.col, r.status, r.fields) for r in got if r.status != "same") == [(1, 1, "changed", "text")]
    moved = spark.createDataFrame([(1, 0, 0, 1, 1, "a"), (1, 7, 0, 1, 1, "d")], CELL)
    got = {(r.row, r.col): (r.status, r.moved_to) for r in both_orders(spark, cells([["a"], ["d"], ["e"]]), CELL, lambda d: tables.cell_diff(d, moved))}
    assert got == {(0, 0): ("same", None), (1, 0): ("moved", "7,0"), (2, 0): ("only_old", None), (7, 0): ("taken", None)}


def test_rows_and_geometry(spark):
    rows = [(1, 0, 0, 1, 2, "head"), (1, 1, 0, 1, 1, "a"), (1, 1, 1, 1, 1, "")]
    frame = spark.createDataFrame(rows, CELL)
    assert tables.rows_of(frame).first().rows == [["head", ""], ["a", ""]]
    assert tuple(tables.geometry(frame).first()) == (1, 2, 2, 3, 1, 2)


def test_align_items(spark):
    entries = spark.createDataFrame([(1, "e1", 3, "图3 变电所布置", "变电所布置说明", False), (1, "e2", 5, "检修", "电缆 检修 记录", True), (1, "e3", 40, "图3 变电所布置", "", False)], "document_id int, entry_id string, page_number long, title string, content string, has_table boolean")
    items = [(1, "i1", 4, "legend", "图3 变电所布置"), (1, "i2", 5, "table", "电缆 记录"), (1, "i3", 20, "table", "none")]
    got = {r.item_id: (r.entry_id, r.match_method) for r in both_orders(spark, items, "document_id int, item_id string, page_number long, kind string, signal string", lambda d: align.align_items(d, entries))}
    assert got == {"i1": ("e1", "accepted"), "i2": ("e2", "accepted")}


def test_small_alignments(spark):
    assert {r.entry_id: r.page_number for r in align.dominant_pages(spark.createDataFrame([(1, 3), (1, 3), (1, 2), (2, 9), (2, 4), (3, 0)], "entry_id int, page_number int")).collect()} == {1: 3, 2: 4}
    items = [(1, 1, "t", 1, None), (1, 1, "t", 2, "A"), (1, 2, "t", 3, "A"), (1, 2, "t", 4, "B"), (1, 2, "t", 5, "")]
    got = {r.seq: r.anchor for r in align.filled_anchors(spark.createDataFrame(items, "document_id int, page_number int, kind string, seq int, anchor string")).collect()}
    assert got == {1: "A", 2: "A", 3: "A", 4: "B", 5: None}
    clauses = spark.createDataFrame([("t", 1, "short"), ("t", 2, "long enough")], "title string, clause int, text string")
    source = spark.createDataFrame([("t", 1, "much longer text"), ("t", 2, "long enough.")], "title string, clause int, text string")
    assert {r.clause: (r.text, r.synced) for r in align.synced_clauses(clauses, source).collect()} == {1: ("much longer text", True), 2: ("long enough", False)}
    kb = spark.createDataFrame([("e1", "a b a"), ("e2", "x"), ("e3", "y")], "entry_id string, content string")
    fixes = spark.createDataFrame([("e1", "a", "Z", 90.0), ("e2", "x", "W", 0.5), ("e3", "q", "W", 90.0)], "entry_id string, before string, after string, confidence double")
    assert {r.entry_id: (r.content, r.fixed) for r in align.approved(kb, fixes).collect()} == {"e1": ("Z b a", True), "e2": ("x", False), "e3": ("y", False)}
    book = spark.createDataFrame([(1, 1, 1, "图2", ["图1"]), (1, 2, 2, "图9", ["图2"]), (1, 3, 4, "图3", ["图3"])], "document_id int, position int, page_number int, wanted string, labels array<string>")
    assert {r.position: r.borrowed for r in align.borrowed_captions(book).collect()} == {1: True, 2: False, 3: False}


def test_top_k_prefers_shared_grams(spark):
    rows = spark.createDataFrame([(1, "red apple"), (2, "green apple"), (3, "blue sky"), (4, "red apple")], "id int, text string")
    got = retrieve.top_k(spark.createDataFrame([(9, "red apple pie"), (8, "zzz")], "q int, text string"), "q", "text", rows, "id", "text", 2).collect()
    assert sorted((r["query"], r["key"], r["rank"]) for r in got) == [(9, 1, 1), (9, 4, 2)] and len({r.score for r in got}) == 1


METRIC = "name string, value double"


def test_shadow_diff_and_gate(spark):
    old = spark.createDataFrame([("pages", 2.0), ("entries", 2.0), ("tables", 0.0), ("chars", 100.0)], METRIC)
    new = spark.createDataFrame([("pages", 2.0), ("entries", 1.0), ("chars", 120.0)], METRIC)
    got = {r.name: (r.delta, r.compared) for r in metrics.shadow_diff(old, new).collect()}
    assert got == {"pages": (0.0, True), "entries": (-1.0, True), "chars": (20.0, True), "tables": (None, False)}
    assert {r.name for r in metrics.mismatches(old, new).collect()} == {"entries", "tables", "chars"}


def test_quality_and_status(spark):
    e = spark.createDataFrame([(1, "H", "long enough text", 2, 1), (1, "", "", 0, 2), (1, "Page 1", "x", 1, 3)], "document_id int, job_title string, content string, n_blocks long, position int")
    assert sorted(r.quality for r in metrics.entry_quality(e).collect()) == [0.35, 0.75, 0.98]
    assert metrics.structure_confidence(e).first().confidence == round(0.1 + 0.55 * 2 / 3 + 0.35 / 3, 6)
    runs = spark.createDataFrame([(1, "ok"), (1, "ok"), (2, "ok"), (2, "bad"), (3, "bad")], "run_id int, status string")
    assert {r.run_id: r.status for r in metrics.overall_status(runs).collect()} == {1: "ok", 2: "partial", 3: "failed"}
    rules = {"title": F.col("job_title") != "", "text": F.length("content") > 1}
    assert sorted((r.position, r.rule) for r in metrics.violations(e, "position", rules).collect()) == [(2, "text"), (2, "title"), (3, "text")]


def test_adjudication(spark):
    rows = [(1, "图1", 90.0, 0.5, 6), (1, "图2", 80.0, 0.5, 7), (2, "图1", 70.0, 0.5, 6), (2, "", 95.0, 0.6, 6), (3, "图4", 50.0, 0.5, 6), (4, "图5", 90.0, 0.5, 7), (4, "图5", 90.0, 0.5, 6)]
    got = {r.figure_id: (r.status, r.label) for r in both_orders(spark, rows, "figure_id int, label string, confidence double, roi double, psm int", metrics.adjudicated)}
    assert got == {1: ("ambiguous_multiple_labels", None), 2: ("empty", None), 3: ("rejected", None), 4: ("linked", "图5")}


def test_word_lines(spark):
    rows = [(1, 0, 0, 1, "b", 80.0, 50, 10, 20, 10), (1, 0, 0, 1, "a", -1.0, 10, 12, 20, 10), (1, 0, 0, 2, "c", 60.0, 10, 40, 5, 5)]
    got = {r.line_num: (r.text, r.mean_confidence, r.x, r.y, r.w, r.h) for r in both_orders(spark, rows, "figure_id int, block_num int, par_num int, line_num int, text string, conf double, x int, y int, w int, h int", metrics.lines_of_words)}
    assert got == {1: ("a b", 80.0, 10, 10, 60, 12), 2: ("c", 60.0, 10, 40, 5, 5)}


def test_fragments_meet_entries_by_what_their_text_holds(spark):
    entries = [(1, 1, 5, "变压器巡视检查内容一览"), (1, 2, 9, "其他 abcdef 事项"), (1, 3, 9, "abcdef 事项")]
    frags = [(1, 1, 6, "变压器巡视"), (1, 2, 9, "abcd ef 事项"), (1, 3, 5, "一 览 变 压 器 巡 视 检 查"), (1, 4, 9, "qq"), (1, 5, 30, "巡视 检查")]
    schema = "document_id int, fragment_id int, page_number int, text string"
    right = spark.createDataFrame(entries, "document_id int, entry_id int, page_number int, text string")
    got = {r.fragment_id: (r.entry_id, r.score, r.hits) for r in both_orders(spark, frags, schema, lambda d: align.fragment_matches(d, right))}
    # 1: five characters and the next page; 2: three tokens, in both entries, so the first; 3: no token, and not as a whole
    assert got == {1: (1, 11, 1), 2: (2, 4 + 2 + 2 + 6, 3)}


def test_captions_stand_before_or_after_their_visual(spark):
    rows = [(1, 1, "code", "caption", "表1 甲"), (1, 2, "table", "table", ""), (1, 3, "image", "body", "图9 正文"), (1, 4, "figure", "figure", ""), (1, 5, "code", "caption", "图2 乙"), (1, 6, "figure", "figure", ""), (1, 7, "code", "artifact", "图3 丙"), (1, 8, "table", "table", "")]
    got = both_orders(spark, rows, "entry_id int, seq int, type string, role string, text string", layout.nearest_caption)
    assert {(r.seq, r.caption_seq, r.caption) for r in got} == {(2, 1, "表1 甲"), (4, 5, "图2 乙"), (6, 5, "图2 乙")}


def test_fixes_of_an_entry_are_folded(spark):
    entries = spark.createDataFrame([(1, "a b a"), (2, "x"), (3, None)], "entry_id int, content string")
    fixes = spark.createDataFrame([(1, 2, "b", "c", 2.0), (1, 1, "a", "bb", 1.5), (1, 3, "zz", "y", 3.0), (2, 1, "x", "y", 1.0), (2, 2, "", "y", 9.0)], "entry_id int, seq int, before string, after string, confidence double")
    got = {r.entry_id: (r.content, r.fixed) for r in align.approved(entries, fixes).collect()}
    assert got == {1: ("cb b a", True), 2: ("x", False), 3: (None, False)}


def test_cross_references(spark):
    entries = spark.createDataFrame([(1, "e1", 1, "总则 / 第三条", "见图1-2，按第 2 章与第三条、第9条，图7"), (1, "e2", 2, "第二章", "无"), (1, "e3", 3, "x", "第三条")], "document_id int, entry_id string, position int, title string, content string")
    blocks = spark.createDataFrame([(1, "e1", 1, "b1", "figure", "", "图1-2 系统"), (1, "e2", 1, "b2", "heading", "第 2 章", None), (1, "e3", 1, "b3", "body", "", "")], "document_id int, entry_id string, seq int, id string, role string, text string, caption string")
    got = {r.entry_id: r.content for r in align.cross_references(entries, blocks).collect()}
    assert got == {"e1": "[见图1-2](#b1)，按[第 2 章](#e2)与[第三条](#e1)、第9条，图7", "e2": "无", "e3": "[第三条](#e1)"}


def test_prose_goes_on_over_a_page(spark):
    chain = [(1, 1, 1, None, None, "开头。", "没有句号"), (1, 2, 2, None, None, "接着写", "完了。"), (1, 3, 3, None, None, "新段", "x"), (1, 4, 4, None, None, "一、列表", "y"), (1, 6, 5, None, None, "远", "z")]
    schema = "document_id int, page_number int, position int, first_number int, last_number int, first_text string, last_text string"
    assert {r.position: r.merged_into for r in both_orders(spark, chain, schema, segment.continuations)} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5}


def test_watermarks_with_a_little_more_or_less(spark):
    from quire.functions import text as tx

    known = ["安全工程网20230815"]
    texts = {"安全工程网20230815": True, "程网20230815": True, "安全工程网": True, "安全工程网2023081599": True, "页0815": True, "0815": False, "安全": False, "正文内容没有它": False}
    frame = spark.createDataFrame([(t, known) for t in texts], "t string, known array<string>")
    assert {r[0]: r[1] for r in frame.select("t", tx.watermark_like(F.col("t"), F.col("known"))).collect()} == texts


def test_alignment_falls_back_and_weighs_order_and_references(spark):
    entries = spark.createDataFrame([(1, "a", 5, "alpha beta gamma", "x", False), (1, "b", 5, "delta", "见图2-1 布置", False), (1, "c", 7, "other", "y", True)], "document_id int, entry_id string, page_number long, title string, content string, has_table boolean")
    items = [(1, "i1", 5, "legend", "图2-1"), (1, "i2", 5, "table", "qqqqqqqqq"), (1, "i3", 8, "legend", "zzzzzzzz"), (1, "i4", 50, "legend", "alpha")]
    got = {r.item_id: (r.entry_id, r.match_method) for r in both_orders(spark, items, "document_id int, item_id string, page_number long, kind string, signal string", lambda d: align.align_items(d, entries))}
    assert got == {"i1": ("b", "accepted"), "i2": ("a", "page"), "i3": ("a", "first_candidate")}
    from quire.operators import kb

    again = {r.item_id: r.entry_id for r in kb.reattached(spark.createDataFrame([(1, "i4", 500, "legend", "alpha beta gamma"), (1, "i5", 500, "table", "zzzz")], "document_id int, item_id string, page_number long, kind string, signal string"), entries).collect()}
    assert again == {"i4": "a"}


def test_small_operators_on_entries_and_files(spark):
    from quire.operators import kb
    from quire.sources import readers

    blocks = spark.createDataFrame([(1, "a", "第二篇", None), (1, "b", "第二篇", None), (1, "b", "text", "u"), (1, "b", "- 12 -", "u"), (1, "c", "", None)], "document_id int, entry_id string, text string, image_uri string")
    assert sorted((r.entry_id, r.text) for r in kb.without_part_labels(blocks).collect()) == [("b", "text"), ("b", "第二篇"), ("c", "")]
    entries = spark.createDataFrame([(1, "a", "t [SPLIT]", "text", 3), (1, "c", "t [SPLIT 2]", "text", 9), (1, "d", "t", "table", 5)], "document_id int, entry_id string, job_title string, kind string, page_number int")
    assert sorted(r.entry_id for r in kb.without_empty_splits(entries, blocks).collect()) == ["a", "d"]
    assert [tuple(r) for r in kb.file_metadata(entries, blocks).collect()] == [(1, 3, 1, 1)]
    assert sorted((r.stream, r.entry_id or "") for r in kb.visual_streams(entries.limit(1), blocks.drop("entry_id").limit(1)).collect()) == [("legend", ""), ("table", "a")]
    assert spark.range(1).select(kb.first_of_each(F.array(*map(F.lit, ["b ", "a", "", "b"])))).first()[0] == ["b", "a"]
    assert [r.entry_id for r in sorted(kb.nearest_pages(entries, spark.createDataFrame([(1, 6)], "document_id int, target_page int"), 2).collect(), key=lambda r: r.rank)] == ["d", "a"]
    files = spark.createDataFrame([(1, "k/table_p3_pos1.jpg"), (1, "k/table_p3_pos1.png"), (1, "k/table_pos1.png"), (1, "k/table_p31_idx2.PNG"), (1, "k/other.png")], "document_id int, path string")
    tables_ = spark.createDataFrame([(1, 3, 1, None), (1, 4, 1, None), (1, 31, 9, 2), (1, 5, 7, None)], "document_id int, page_number long, position long, idx long")
    got = {r.page_number: r.path for r in readers.table_picture_of(tables_.fillna({"idx": -1}), files).collect()}
    assert got == {3: "k/table_p3_pos1.png", 4: "k/table_pos1.png", 31: "k/table_p31_idx2.PNG", 5: None}


def test_columns_stand_beside_each_other(spark):
    two = [box(1, i, 20 if i < 3 else 300, 10 * (i % 3), 200, 8) for i in range(6)]
    (g,) = both_orders(spark, two, BOXES, segment.gutters)
    assert (g.gap, g.gutter_x) == (80, 260.0)
    # one above the other: no columns
    assert both_orders(spark, [box(1, i, 20 if i < 3 else 300, 10 * i, 200, 8) for i in range(6)], BOXES, segment.gutters) == []


def test_items_are_put_in_by_mode(spark):
    blocks = spark.createDataFrame([(1, 1, 1, "code", "a"), (1, 2, 1, "table", "b"), (1, 3, 2, "code", "c")], "entry_id int, seq long, page_number int, type string, id string")
    items = spark.createDataFrame([(1, "x", 1, 0, 2), (1, "y", 1, 1, 2), (1, "z", 9, 0, 1)], "entry_id int, id string, page_number int, rank int, total int")
    order = lambda mode: "".join(r.id for r in sorted(segment.inserted(blocks, items, mode).collect(), key=lambda r: r.position))
    assert (order("append"), order("after-page"), order("after-page-text")) == ("abcxzy", "axbycz", "axybcz")


def test_heading_signals_and_small_expressions(spark):
    from quire.functions import captions, geometry
    from quire.functions import text as tx
    from tests.test_expressions import values

    rows = [("第一章 总则", "heading", 1, 150, 22, False), ("正文", "body", 9, 10, 10, False), ("图1", "caption", 2, 150, 10, True)]
    frame = spark.createDataFrame(rows, "t string, r string, o int, w int, h int, c boolean")
    assert [r[0] for r in frame.select(segment.heading_signal(*[F.col(x) for x in "trowhc"])).collect()] == [12, 0, -8]
    assert values(spark, ["4.2.13 x", "4.2 x", "3、 x", "第十二条 x", "12 x", "4.2.1345"], tx.item_number) == [40213, 40200, 3, 12, None, 40200]
    assert values(spark, ["07 x", "3. x", "x", "0 x"], tx.continuation_number) == [7, None, None, None]
    assert values(spark, ["（三） x", "(12) y", "三、x"], tx.subitem_number) == [3, 12, None]
    assert values(spark, ["a/visual_p12_3.png?x", "b"], lambda c: tx.snapshot_index(c)["idx"]) == [3, None]
    assert values(spark, ["x_p7_y", "p7"], tx.physical_page) == [7, None] and values(spark, ["p7", " 12 ", "x7", None], tx.page_number) == [7, 12, None, None]
    assert values(spark, ["见图1-2", "图1.2所示内容", "图1-2 示意图", "图12", "无"], lambda c: tx.reference_score(c, F.lit("图1-2"))) == [3, 3, 1, 0, 0]
    assert values(spark, ["如图1和图2", "图3"], lambda c: F.array_join(tx.reference_labels(c), ",")) == ["图1,图2", ""]
    assert values(spark, ["Figure", "x", None], captions.visual_kind) == ["legend", None, None] and values(spark, ["Table 3", "", "Table 3 of x"], captions.generic_caption) == [True, True, False]
    assert values(spark, ["第一章 总则\n12", "12", "第一章 总则\n正文说明，内容。"], lambda c: captions.chapter_opener(F.split(c, "\n"))) == [True, False, False]
    b = geometry.within_figure(F.lit(0.5), F.lit(0.2), F.lit(0.4), F.lit(0.6), geometry.Box(*map(F.lit, (10.0, 20.0, 100.0, 50.0))))
    assert tuple(spark.range(1).select(b.x, b.y, b.w, b.h).first()) == (10.0, 30.0, 100.0, 20.0)
