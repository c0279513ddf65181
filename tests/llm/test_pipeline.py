"""The corpus pipeline against brute-force versions of its stages."""

from __future__ import annotations

import hashlib

import pytest

from quire.llm.queries import QUERIES
from tests.llm.test_exact import WORD, components, corpus, first_places, shingles, tokenizer

corpus_pipeline = pytest.importorskip("corpus_pipeline")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, bits string, cuts int"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    texts = [t.lower() if t and t.isupper() else t for t in corpus(seed=3, n=40)]
    item = "ach jede kleine frage hat eine antwort die man erst am ende der langen reise findet und dann vergisst"
    texts += [f"{texts[0]} {item.title()} {texts[1]}", item + "!", "2024 - 11", None, "щука жёлтый фюзеляж " * 9, "日本語の文章です"]
    rows = [(i, t, "en" if t and i % 4 and "щ" not in t else None, "s", None if t is None else len(t), 1.0, "x", 3) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), {r[0]: r for r in rows}, item


def test_stages(spark, folder, tmp_path):
    path, rows, item = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    steps = {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, path)
        if i < 4:
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        steps[i] = {r.doc_id: r for r in docs.collect()}
        assert len(steps[i]) == docs.count()
    assert set(steps[0]) == {i for i, r in rows.items() if r[1] and any(c.isalpha() for c in r[1])} and {max(rows), max(rows) - 1} <= set(steps[0])
    sets = {i: shingles(r.text) for i, r in steps[0].items()}
    group = components(sets)
    assert set(steps[1]) == {i for i in sets if group[i] == i} and len(steps[1]) < len(steps[0])
    words = {i: WORD.findall(r.text) for i, r in steps[1].items()}
    first = first_places(words, 50)
    gone = {(i, k + d) for i, w in words.items() for k in range(len(w) - 49) if first[tuple(w[k : k + 50])] != (i, k) for d in range(50)}
    assert gone and set(steps[2]) == set(steps[1])
    for i, r in steps[2].items():
        assert WORD.findall(r.text) == [w for k, w in enumerate(words[i]) if (i, k) not in gone] and r.n_chars == len(r.text)
        assert (r.lang, r.source, r.score, r.bits, r.cuts) == (steps[1][i].lang, "s", 1.0, "x", 3)
    held = {i for i, r in steps[2].items() if item in r.text.lower()}
    assert held and set(steps[3]) == set(steps[2]) - held
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(tokenizer())
    assert set(steps[4]) == set(steps[3])
    for i, r in steps[4].items():
        ids = lib.encode(steps[3][i].text, add_special_tokens=False).ids
        assert r.token_ids == ids and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    whole = {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, path).collect()}
    assert whole == {i: r.ids_sha256 for i, r in steps[4].items()}


def test_rows_without_ids_and_repeated_rows(spark, folder, tmp_path):
    """Null ids are judged each by its own text, copies give way, and of repeated rows one stays."""
    path, rows, item = folder
    text = lambda k: " ".join(f"wort{k}x{i}" for i in range(30))
    own = [(None, text(1)), (None, text(1)), (None, text(2)), (2, text(2)), (3, text(3)), (3, text(3)), (4, text(4)), (4, text(5)), (None, item), (None, f"{text(6)} {item}")]
    docs = spark.createDataFrame([(i, t, "de", "s", len(t), 1.0, "x", 3) for i, t in own], SCHEMA)
    for _, stage in corpus_pipeline.STAGES[:2]:
        docs = stage(spark, docs, path)
    assert sorted((r.doc_id or 0, r.text) for r in docs.collect()) == sorted([(0, text(1)), (2, text(2)), (3, text(3)), (4, text(4)), (4, text(5)), (0, item), (0, f"{text(6)} {item}")])
    for _, stage in corpus_pipeline.STAGES[2:4]:
        docs = stage(spark, docs, path)
    assert sorted((r.doc_id or 0, r.text) for r in docs.collect()) == sorted([(0, text(1)), (2, text(2)), (3, text(3)), (4, text(4)), (4, text(5))])


def test_empty_table(spark, folder, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder[0]}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))
    assert len(corpus_pipeline.STAGES) == 5
