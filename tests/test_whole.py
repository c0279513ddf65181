"""Queries read whole texts: what decides each result stands where a prefix wouldn't reach."""

from __future__ import annotations

from quire.plans import catalog


def test_clean_text_reads_whole_html(spark, tmp_path):
    html = "x" * 300 + " http://a.b/c\n\n  学兔兔 second。\nlast"
    spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    text = catalog.QUERIES["sf06_clean_text"](spark, str(tmp_path)).first().text
    assert "last" in text and "second" in text and "http" not in text and "学兔兔" not in text


def test_align_items_reads_whole_texts_and_neighbouring_pages(spark, tmp_path):
    signal = "quay " * 14 + "lantern harbour winter"
    rows = [(25, "first line\nplain words"), (27, "first line\n" + "filler " * 60 + "\n" + signal)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(25, signal)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = catalog.QUERIES["j08_align_items"](spark, str(tmp_path)).collect()
    assert [(r.item_id, r.entry_id) for r in got] == [(25, 27)]
