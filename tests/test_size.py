"""What a query holds at once: nothing that was exploded is broadcast, and no step compares more than it must."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from quire.operators import align, kb, references, retrieve


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored(spark, tmp_path):
    """Rows as a small file, which Spark takes for small however many rows are made of them."""

    def of(rows, schema):
        folder = f"{tmp_path}/{len(list(tmp_path.iterdir()))}"
        spark.createDataFrame(rows, schema).write.parquet(folder)
        return spark.read.parquet(folder)

    return of


def test_no_gram_is_broadcast(stored):
    rows = stored([(1, "large ring"), (2, "hot bolt"), (3, "large bolt")], "id long, name string")
    asked = stored([(7, "ring")], "id long, name string")
    for df in (retrieve.index(rows, "id", "name")[0], retrieve.top_k(asked, "id", "name", rows, "id", "name", 2)):
        assert "BroadcastHashJoin" not in plan(df)
    assert [(r.query, r.key) for r in retrieve.top_k(asked, "id", "name", rows, "id", "name", 1).collect()] == [(7, 1)]


def test_fragments_meet_entries_without_grams(stored):
    fragments = stored([(1, i, i, "alpha beta") for i in range(1, 8)], "document_id long, fragment_id long, page_number long, text string")
    entries = stored([(1, 1, 1, "alpha gamma"), (1, 2, 9, "alpha beta")], "document_id long, entry_id long, page_number long, text string")
    found = align.fragment_matches(fragments, entries)
    assert "BroadcastHashJoin" not in plan(found)
    got = {r.fragment_id: (r.entry_id, r.score, r.hits) for r in found.collect()}
    assert got[1] == (1, 11, 1) and got[7] == (2, 12, 2)
    # a document dealt over shards gives the same
    assert {r.fragment_id: (r.entry_id, r.score, r.hits) for r in align.fragment_matches(fragments, entries, most=2).collect()} == got


def test_repeated_entry_rows_count_once_each(spark):
    entries = spark.createDataFrame([(1, 5, 1, "gammadelta")] * 2, "document_id long, entry_id long, page_number long, text string")
    fragments = spark.createDataFrame([(1, 1, 1, "gammadelta")], "document_id long, fragment_id long, page_number long, text string")
    assert [(r.hits, r.score) for r in align.fragment_matches(fragments, entries).collect()] == [(2, 26)]


def test_distance_is_that_of_spark(spark):
    draw = random.Random(3)
    word = lambda: "".join(draw.choice("ab c文") for _ in range(draw.randrange(9)))
    rows = [(word(), word()) for _ in range(300)]
    for a, b, d in spark.createDataFrame(rows, "a string, b string").select("a", "b", F.levenshtein("a", "b")).collect():
        assert kb.distance(a, b) == d
        assert kb.Compared(a).like(kb.Compared(b), 0.35, False) >= kb.Compared(a).like(kb.Compared(b), 0.35, True)


def test_long_lines_are_overlaid_without_a_distance_for_each_pair(spark, monkeypatch):
    counted = []
    monkeypatch.setattr(kb, "distance", lambda a, b, own=kb.distance: counted.append(1) or own(a, b))
    lines = [kb.Structured(i, "lorem ipsum dolor " * 300, "loremipsumdolor" * 300, []) for i in range(3)]
    shouted = [kb.Structured(i, x.line.text.upper(), x.mark.text.upper(), []) for i, x in enumerate(lines)]
    assert [a.base(b) + a.similar(b, True) for a in lines for b in shouted] == [0] * 9 and not counted


def test_references_meet_a_list_of_targets(spark):
    schema = "document_id long, label string, page_number long, block_id long, cx double, cy double"
    draw = random.Random(5)
    row = lambda i: (1, draw.choice("ab"), draw.choice([None, 1, 2, 3, 9]), i, float(draw.randrange(4)), float(draw.randrange(4)))
    figures, refs = [row(i) for i in range(12)], [row(i) for i in range(100, 160)]
    refs += refs[:9]  # repeated rows are one
    found = references.resolve(spark.createDataFrame(refs, schema), spark.createDataFrame(figures, schema))
    shown = plan(found)
    assert "REPARTITION_BY_NUM" in shown and "SortAggregate" not in shown
    got = {r.block_id: (r.status, r.target_id, r.reason) for r in found.collect()}
    assert len(got) == 60 and found.count() == 60
    for _, label, page, i, x, y in refs:
        if page is None:
            continue
        near = lambda f: (0, ((x - f[4]) ** 2 + (y - f[5]) ** 2) ** 0.5) if f[2] == page else (1, -1.0 if f[2] is None else float(abs(f[2] - page)))  # noqa: E731, B023
        targets = sorted((near(f), f[3]) for f in figures if f[1] == label)
        tied = [t for s, t in targets if s == targets[0][0]]
        name = "same_page" if targets[0][0][0] == 0 else "page"
        assert got[i] == (("resolved", tied[0], f"nearest_{name}") if len(tied) == 1 else ("ambiguous", None, f"tied_{name}_distance:{len(tied)}"))


def test_rules_are_dealt_over_tasks(spark):
    from quire.plans import catalog, rules

    for name in ("sf35_titles", "sf37_page_roles"):
        assert (catalog.QUERIES | rules.QUERIES)[name](spark, "/root/testdata/sf0.001").rdd.getNumPartitions() >= 4
