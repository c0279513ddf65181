"""Captions, cleaning, DOCX entries, the command."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import captions
from quire.operators import docx_entries
from quire.plans import run
from quire.sources import docx
from tests.test_expressions import values
from tests.test_io import container


def test_captions(spark):
    assert values(spark, ["图4 人工呼吸", "某某示意图", "正文", None], captions.caption) == [True, True, False, False]
    assert values(spark, ["(a)", "200mm", "中心线", "这是一个完整的句子。", "图4 说明", "第三章 总则"], captions.callout) == [True, True, True, False, False, False]
    assert values(spark, ["图 4 人工呼吸示意", "图4", "图4 布置如图所示", "说明文字在前 图4", "图4 " + "长" * 40, "正文"], captions.caption_candidate) == ["图 4 人工呼吸示意", "图4", "图4 布置如图所示", "", "图4", ""]


def test_cleaning(spark):
    assert values(spark, ["学兔兔 a http://x.y/z\n\n b \n第一。\n2. c", None], captions.clean_text) == ["a b 第一。\n2. c", ""]
    assert values(spark, ["章 / 节 / 图3 布置", "节 图3 布置", "图3", ""], captions.cluster_key) == ["章/节", "节", "图3", ""]
    assert values(spark, ["目 录", "第一章 a 1 第二章 b 2 第三章 c 3 第四章 d 4", "正文。"], captions.table_of_contents) == [True, True, False]


def test_kinds(spark):
    frame = spark.createDataFrame([(["text", "TABLE"], "x"), (["image"], " "), (["figure"], "x"), ([], None)], "t array<string>, c string")
    assert [r[0] for r in frame.select(captions.entry_kind(F.col("t"), F.col("c"))).collect()] == ["table", "image", "text", "text"]
    assert values(spark, ["table", "Figure", None], captions.content_type) == ["table", "figure", "narrative"]


def test_difflib(spark):
    frame = spark.createDataFrame([("abcd", "bcde"), (None, "a"), ("", "")], "a string, b string")
    assert [r[0] for r in frame.select(captions.difflib_ratio(F.col("a"), F.col("b"))).collect()] == [0.75, 0.0, 1.0]


def paragraph(text, breaks=False):
    return f"<w:p><w:r><w:t>{text}</w:t>{'<w:br w:type=\"page\"/>' if breaks else ''}</w:r></w:p>"


def test_docx_entries_and_command(spark, tmp_path):
    table = "<w:tbl><w:tr><w:tc><w:p><w:r><w:t>x</w:t></w:r></w:p></w:tc></w:tr></w:tbl>"
    body = paragraph("前文") + paragraph("第一章 总则") + paragraph("a") + paragraph("b") + table + paragraph("c") + paragraph("d", True) + paragraph("") + paragraph("第二章 范围")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.docx").write_bytes(container(body))
    (tmp_path / "in" / "bad.docx").write_bytes(b"x")
    blocks = docx.read_blocks(spark, str(tmp_path / "in"))
    got = sorted(docx_entries.entries(blocks).collect(), key=lambda r: r.position)
    assert [(r.page_number, r.kind, r.title, r.content) for r in got] == [
        (1, "text", "", "前文"), (1, "text", "第一章 总则", "第一章 总则"), (1, "text", "第一章 总则", "a\n\nb"), (1, "table", "", "| x |\n| --- |"), (1, "text", "第一章 总则", "c"), (2, "text", "第一章 总则", "d"), (2, "text", "第二章 范围", "第二章 范围"),
    ]
    assert docx_entries.style(blocks).first().style == "rule_provisions"
    run.main(["--input", str(tmp_path / "in"), "--out", str(tmp_path / "out"), "--max-pages", "1"])
    kb = spark.read.json(str(tmp_path / "out" / "kb"))
    assert kb.count() == 5 and {r.content_type for r in kb.collect()} == {"table", "narrative"}
    assert spark.read.json(str(tmp_path / "out" / "report")).first().entries == 5


def test_modes_and_styles(spark, tmp_path):
    import pytest

    body = paragraph("第一章 总则") + paragraph("正文内容说明如下所述。") + paragraph("第二章 范围", True) + paragraph("x")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.docx").write_bytes(container(body))
    v2 = run.build(spark, str(tmp_path / "in"), mode="v2")["kb"].collect()
    assert sorted((r.page_number, r.job_title, r.content) for r in v2) == [(1, "第一章 总则", "第一章 总则\n\n正文内容说明如下所述。"), (1, "第二章 范围", "第二章 范围\n\nx")] or len(v2) == 2
    shadow = run.build(spark, str(tmp_path / "in"), mode="shadow")
    assert {r.name for r in shadow["shadow"].collect()} == {"entries", "documents", "characters"} and shadow["kb"].count() == 4
    with pytest.raises(KeyError, match="no parser"):
        run.parser("other")


def test_services_are_asked_for_some_rows_only(spark):
    from quire.plans import services

    rows = spark.createDataFrame([(1, "a\ufffdb"), (2, "c\ufffd"), (3, None), (4, "plain")], "id int, text string")
    got = {r.id: (r.text, r.corrected) for r in services.corrected(rows, F.col("id") != 2).collect()}
    assert got == {1: ("ab", True), 2: ("c\ufffd", False), 3: (None, False), 4: ("plain", False)}
    pictures = spark.createDataFrame([(1, bytearray(b"abc")), (2, None), (3, bytearray(b""))], "id int, content binary")
    assert {r.id: None if r.words is None else [(w.text, w.conf, w.w) for w in r.words] for r in services.recognised(pictures).collect()} == {1: [("bytes 3", 100.0, 10)], 2: None, 3: []}
