"""Readers, sinks, streaming, the driver contract."""

from __future__ import annotations

import io
import json
import subprocess
import sys
import zipfile
from pathlib import Path

import pytest

from quire.plans import publish
from quire.sources import docx, readers
from quire.streaming import ingest

ROOT = Path(__file__).parent.parent


def container(body: str, rels: str = "", files: dict[str, bytes] | None = None) -> bytes:
    w, r, a = (x[1:-1] for x in (docx.W, docx.R, docx.A))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="{w}" xmlns:r="{r}" xmlns:a="{a}"><w:body>{body}</w:body></w:document>')
        z.writestr("word/styles.xml", f'<w:styles xmlns:w="{w}"><w:style w:styleId="1"><w:name w:val="heading 1"/></w:style></w:styles>')
        z.writestr("word/_rels/document.xml.rels", f"<Relationships>{rels}</Relationships>")
        for name, content in (files or {}).items():
            z.writestr(name, content)
    return out.getvalue()


def test_docx(spark, tmp_path):
    body = (
        '<w:p><w:pPr><w:pStyle w:val="1"/></w:pPr><w:r><w:t>Title</w:t></w:r></w:p><w:p><w:r><w:t>a</w:t><w:tab/><w:t>b</w:t><w:br w:type="page"/></w:r><a:blip r:embed="r1"/></w:p>'
        "<w:tbl><w:tr><w:tc><w:p><w:r><w:t>x</w:t></w:r></w:p></w:tc><w:tc><w:p/></w:tc></w:tr></w:tbl>"
    )
    rels = '<Relationship Id="r1" Type="t/image" Target="media/i.png"/><Relationship Id="r2" Type="t/image" Target="media/none.png"/>'
    (tmp_path / "good.docx").write_bytes(container(body, rels, {"word/media/i.png": b"PNG"}))
    (tmp_path / "bad.docx").write_bytes(b"no zip")
    got = sorted(docx.read_blocks(spark, str(tmp_path)).collect(), key=lambda r: r.seq)
    assert [(r.kind, r.style, r.text, r.rows, r.images, r.page_breaks) for r in got] == [("paragraph", "heading 1", "Title", None, [], 0), ("paragraph", "", "a\tb", None, ["r1"], 1), ("table", None, "", [["x", ""]], [], 0)]
    (image,) = docx.read_images(spark, str(tmp_path)).collect()
    assert (image.rid, image.name, bytes(image.content)) == ("r1", "i.png", b"PNG")
    assert docx.problem(b"no zip") == "no zip container" and docx.problem(container("")) is None


def test_knowledge_base_round_trip(spark, tmp_path):
    kb = {"fileMetadata": {"fileId": "d", "pageSizes": {"1": [10, 20]}}, "entries": [{"entryId": "e", "position": 1, "blocks": [{"id": "b", "type": "code", "text": "t", "extra": 1}]}, {"entryId": "f", "position": 2, "blocks": []}]}
    (tmp_path / "kb.json").write_text("﻿" + json.dumps(kb), encoding="utf-8")
    own = readers.knowledge_bases(spark, str(tmp_path / "kb.json"))
    entries, blocks = readers.kb_entries(own), readers.kb_blocks(own)
    assert [(r.document_id, r.entryId) for r in entries.orderBy("seq").collect()] == [("d", "e"), ("d", "f")]
    assert [(r.entryId, r.id, r.text) for r in blocks.collect()] == [("e", "b", "t")]
    meta = own.select("fileMetadata.fileId", "fileMetadata.pageSizes")
    out = publish.kb_export(entries.drop("blocks", "seq"), blocks.drop("position"), meta)
    publish.publish({"ir": blocks, "kb": out}, str(tmp_path / "out"), "kb")
    again = readers.kb_blocks(readers.knowledge_bases(spark, str(tmp_path / "out" / "kb")))
    assert [(r.document_id, r.entryId, r.id) for r in again.collect()] == [("d", "e", "b")]
    with pytest.raises(FileExistsError):
        publish.publish({"ir": blocks, "kb": out}, str(tmp_path / "out"), "kb")


def test_failed_publication_leaves_nothing(spark, tmp_path):
    good = spark.range(3)
    bad = spark.range(3).selectExpr("raise_error('no') as x")
    with pytest.raises(Exception, match="no"):
        publish.publish({"ir": good, "kb": bad}, str(tmp_path / "out"), "kb")
    assert not [p for p in (tmp_path / "out").rglob("*") if p.is_file()]


def test_cache_upsert_assets(spark, tmp_path):
    rows = [("s", 1, "native", "f", "a"), ("s", 2, "native", "f", "b")]
    schema = "input_sha256 string, page_number int, strategy string, fingerprint string, page string"
    path = str(tmp_path / "cache")
    publish.store_pages(spark.createDataFrame(rows, schema), path)
    publish.store_pages(spark.createDataFrame([("t", 1, "ocr", "f", "c")], schema), path)
    cache = spark.read.parquet(path)
    assert cache.count() == 3
    wanted = spark.createDataFrame([("s", 1, "native", "f"), ("s", 2, "native", "other"), ("s", 2, "ocr", "f")], schema.rsplit(",", 1)[0])
    hits, misses = readers.cached_pages(cache, wanted)
    assert [r.page for r in hits.collect()] == ["a"] and misses.count() == 2
    current = spark.createDataFrame([(1, "a", 5), (2, "b", 1)], "entry_id int, title string, images_count int")
    changes = spark.createDataFrame([(1, "A", 3), (3, "c", 2), (2, None, 4)], "entry_id int, title string, images_count int")
    assert sorted(map(tuple, publish.upsert(current, changes).collect())) == [(1, "A", 5), (2, "b", 4), (3, "c", 2)]
    pics = spark.createDataFrame([(bytearray(b"x"), "png"), (bytearray(b"x"), "png"), (bytearray(b"y"), "jpg")], "content binary, ext string")
    names = [r.name for r in publish.assets(pics).collect()]
    assert len(names) == 2 and all(n.startswith("img_") and len(n) == 40 for n in names)
    files = spark.createDataFrame([("a/X.png",), ("a/y.png",)], "path string")
    assert [r.path for r in publish.unreferenced_files(files, spark.createDataFrame([("b/x.png",)], "uri string")).collect()] == ["a/y.png"]


def test_csv_and_checkpoints(spark, tmp_path):
    publish.audit(spark.createDataFrame([("e", 'say "x"\nnow', "b", 2.5)], "entry_id string, before string, after string, confidence double"), str(tmp_path / "a"))
    assert tuple(readers.approvals(spark, str(tmp_path / "a")).first()) == ("e", 'say "x"\nnow', "b", 2.5)
    (tmp_path / "p.json").write_text(json.dumps({"entries": [{"entryId": "b", "position": "2"}, {"entryId": "a", "position": "x"}, {"position": 1}, {"entryId": "c", "position": 1, "pageNumber": 7}]}))
    assert {(r.entryId, r.position, r.pageNumber) for r in readers.checkpoints(spark, str(tmp_path / "p.json")).collect()} == {("a", None, None), ("c", 1, 7), ("b", 2, None)}


def test_page_images(spark, tmp_path):
    for n in ("page_010.png", "page_2.jpg", "notes.txt", "cover.png"):
        (tmp_path / n).write_bytes(b"x")
    assert sorted(r.page_number for r in readers.page_images(spark, str(tmp_path)).collect()) == [2, 10]


def test_stream(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    where, table, checkpoint = (str(tmp_path / n) for n in ("in", "table", "ckpt"))
    spark.createDataFrame([(1, "a\nb", "en", "s", 3), (2, "c", "en", "s", 1)], schema).coalesce(1).write.parquet(where)
    ingest.ingest(ingest.documents_stream(spark, where), table, checkpoint).awaitTermination()
    spark.createDataFrame([(2, "new", "en", "s", 3)], schema).coalesce(1).write.mode("append").parquet(where)
    ingest.ingest(ingest.documents_stream(spark, where), table, checkpoint).awaitTermination()
    assert sorted((r.document_id, r.content) for r in ingest.latest(spark, table).collect()) == [(1, "a\n\nb"), (2, "new")]


def test_entry_without_the_training_data_part(tmp_path):
    """__spark_entry__ imports, and has the other queries, where quire.llm and the pipeline are deleted."""
    import shutil

    shutil.copytree(ROOT / "quire", tmp_path / "quire", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 50 and 'pipeline' not in q and not [n for n in q if n.startswith('op')]; assert set(e.oracle_sql()) < set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)
