"""Alignment of manifest items and assets with entries: page windows, scores, one best entry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import compact, fingerprint, labels, let, levenshtein_similarity, match_tokens, single_line, strip, text_or_empty


def page_window(items: DataFrame, entries: DataFrame, radius: int = 3) -> DataFrame:
    """Pairs of an item and the entries within `radius` pages: an equi-join, as each item is sent to the pages of its window."""
    pages = F.explode(F.sequence(F.greatest(F.least(F.lit(1).cast("long"), F.col("page_number")), F.col("page_number") - radius), F.col("page_number") + radius))
    sent = items.select(*[F.col(c).alias(f"i_{c}") for c in items.columns], pages.alias("e_page_number"), F.col("document_id").alias("e_document_id"))
    return sent.join(entries.select(*[F.col(c).alias(f"e_{c}") for c in entries.columns]), ["e_document_id", "e_page_number"])


def page_bonus(a: Column, b: Column) -> Column:
    far = F.abs(a - b)
    return F.when((a > 0) & (b > 0), F.when(far == 0, 90).when(far <= 2, 40).when(far <= 6, 15).otherwise(0)).otherwise(0)


# Words before and after the label of a figure or table that a text refers to.
CUES_BEFORE, CUES_AFTER = "见|如|按|所示|示例图|示意图|接线图|布置图", "所示|示例图|示意图|接线图|布置图|明细表"


def signal_profile(signal: Column) -> Column:
    """What a signal is compared by; computed once an item, before the join."""
    return F.struct(single_line(signal).alias("norm"), fingerprint(signal).alias("mark"), F.slice(match_tokens(signal), 1, 12).alias("tokens"), labels(signal).alias("labels"), (strip(text_or_empty(signal)) != "").alias("given"))


def entry_profile(title: Column, content: Column) -> Column:
    """What an entry is compared by. The long side of a similarity is its first 2400 characters, as the score is defined."""
    short, long = single_line(title), single_line(content)
    cut = F.substring(long, 1, 2400)
    return F.struct(
        short.alias("short"), fingerprint(title).alias("short_mark"), long.alias("long"), fingerprint(content).alias("long_mark"), compact(short).alias("key"),
        compact(long).alias("compact"), strip(cut).alias("cut"), fingerprint(cut).alias("cut_mark"), F.contains(text_or_empty(content), F.lit("[IMAGE_REF:")).alias("images"),
    )


def referred(text: Column, label: Column) -> Column:
    """How a text (without spaces) refers to a label: 280 after a cue, 240 before one, 120 at all."""
    after = F.substring(text, F.instr(text, label) + F.length(label), F.length(text))
    last = F.length(text) - F.length(F.call_function("substring_index", text, label, F.lit(-1))) - F.length(label)
    return F.when(~F.contains(text, label), 0).when(F.substring(text, F.lit(1), last).rlike(CUES_BEFORE), 280).when(after.rlike(CUES_AFTER), 240).otherwise(120)


def signal_score(signal: Column, entry: Column, item_kind: Column, has_table: Column, item_page: Column, entry_page: Column, cutoff: float = 0.5) -> Column:
    """SF50: score and evidence of a signal's profile for an entry's: the best containment, token hits, similarity, page, kind
    and the best reference to one of the signal's labels."""
    norm, mark = signal["norm"], signal["mark"]
    within = lambda a, b: (a != "") & F.contains(b, a)
    contained = F.greatest(
        F.when((mark != "") & (entry["short_mark"] != "") & (F.contains(entry["short_mark"], mark) | F.contains(mark, entry["short_mark"])), 980).otherwise(0),
        F.when(within(norm, entry["short"]), 900).otherwise(0), F.when(within(mark, entry["long_mark"]), 760).otherwise(0), F.when(within(norm, entry["long"]), 620).otherwise(0),
    )
    hits = F.size(F.filter(signal["tokens"], lambda t: F.contains(entry["short"], t) | F.contains(entry["compact"], t)))

    def like(other_mark: Column, other: Column) -> Column:
        by_mark = levenshtein_similarity(mark, other_mark, cutoff)
        return let(by_mark, lambda m: F.when(m > 0, m).otherwise(levenshtein_similarity(norm, other, cutoff)))

    kind = F.when(item_kind == "table", F.when(has_table, 220).otherwise(-80)).when(item_kind == "legend", F.when(has_table, -90).otherwise(40) + F.when(entry["images"], 95).otherwise(0)).otherwise(0)
    reference = F.coalesce(F.array_max(F.transform(signal["labels"], lambda x: F.greatest(referred(entry["key"], x), referred(entry["compact"], x)))), F.lit(0))
    parts = F.struct(contained.alias("contained"), hits.alias("hits"), F.greatest(like(entry["short_mark"], entry["short"]), like(entry["cut_mark"], entry["cut"])).alias("like"), reference.alias("reference"))

    def total(p: Column) -> Column:
        score = p["contained"] + p["hits"] * 55 + F.floor(p["like"] * 220).cast("int") + page_bonus(item_page, entry_page) + kind + p["reference"]
        evidence = (p["contained"] > 0).cast("int") + (p["hits"] > 0).cast("int") + (p["like"] > 0).cast("int") + (p["reference"] >= 240).cast("int")
        return F.struct(score.alias("score"), evidence.alias("evidence"), p["like"].alias("similarity"))

    none = F.struct(F.lit(0).alias("score"), F.lit(0).alias("evidence"), F.lit(0.0).alias("similarity"))
    return F.when(signal["given"], let(parts, total)).otherwise(none)


def page_rank(rows: DataFrame, order: str) -> DataFrame:
    """rank: a row's place on its page from 0 to 1; null on pages of one row, or without a page."""
    page = Window.partitionBy("document_id", "page_number")
    rank = F.percent_rank().over(page.orderBy(order))
    return rows.withColumn("rank", F.when((F.count("*").over(page) > 1) & (F.col("page_number") > 0), rank))


def align_items(items: DataFrame, entries: DataFrame, radius: int = 3, cutoff: float = 0.5) -> DataFrame:
    """The best entry of each item within its page window, with score, evidence and how it was accepted.

    items: document_id, item_id, page_number, kind, signal. entries: document_id, entry_id, page_number, title, content,
    has_table. Both may have seq, their order on a page (else their ids). To the score comes 75 times how well the item's
    place on its page fits the entry's on its own. Entries without evidence and below the cutoff don't count. Order: total,
    evidence, similarity, then the entry's id. Where the best is too weak, or none counts, the item goes to an entry of its
    page (`page`: the one whose title or content holds the signal, else the first), else to the first candidate
    (`first_candidate`); one without entries in the window has none.
    """
    ordered = lambda rows, key: page_rank(rows if "seq" in rows.columns else rows.withColumn("seq", F.col(key)), "seq")
    left = ordered(items, "item_id").select("document_id", "item_id", "page_number", "kind", "rank", signal_profile(F.col("signal")).alias("profile"))
    right = ordered(entries, "entry_id").select("document_id", "entry_id", "page_number", "has_table", "rank", "seq", entry_profile(F.col("title"), F.col("content")).alias("profile"))
    pairs = page_window(left, right, radius)
    scored = pairs.withColumn("s", signal_score(F.col("i_profile"), F.col("e_profile"), F.col("i_kind"), F.col("e_has_table"), F.col("i_page_number"), F.col("e_page_number"), cutoff))
    fit = F.coalesce(F.greatest(F.lit(0.0), 1.0 - F.abs(F.col("i_rank") - F.col("e_rank"))), F.lit(0.0))
    key = F.col("i_profile.norm")
    half = F.when(F.length(key) < 3, 0.5).otherwise(1.0)
    named = F.when((key != "") & F.contains("e_profile.short", key), 120).otherwise(0) + F.when((key != "") & F.contains("e_profile.long", key), 60).otherwise(0)
    own = scored.select(
        "i_document_id", "i_item_id", "e_entry_id", "s", (F.col("s.score") + fit * 75.0).alias("total"), ((F.col("s.evidence") > 0) | (F.col("s.similarity") >= cutoff)).alias("counts"),
        (F.col("e_page_number") == F.col("i_page_number")).alias("here"), F.floor(named * half).alias("named"), "e_page_number", "e_seq",
    )
    shown = [F.col("e_entry_id").alias("entry_id"), F.col("s").alias("s"), F.col("total").alias("total"), F.col("counts").alias("counts")]
    best = F.min(F.struct((~F.col("counts")).alias("k0"), (-F.col("total")).alias("k1"), (-F.col("s.evidence")).alias("k2"), (-F.col("s.similarity")).alias("k3"), *shown)).alias("best")
    first = F.min(F.struct((~F.col("here")).alias("k0"), F.when(F.col("here"), -F.col("named")).otherwise(0).alias("k1"), F.col("e_page_number").alias("k2"), F.col("e_seq").alias("k3"), *shown)).alias("first")
    found = own.groupBy("i_document_id", "i_item_id").agg(best, first)
    strong = F.col("best.counts") & ((F.col("best.total") >= max(120.0, 220.0 * cutoff)) | (F.col("best.s.evidence") >= 2) | (F.col("best.s.similarity") >= cutoff))
    pick = found.select(F.col("i_document_id").alias("document_id"), F.col("i_item_id").alias("item_id"), F.when(strong, "accepted").when(F.col("first.k0"), "first_candidate").otherwise("page").alias("match_method"), F.when(strong, F.struct("best.entry_id", "best.s", "best.total")).otherwise(F.struct("first.entry_id", "first.s", "first.total")).alias("p"))
    return pick.select("document_id", "item_id", F.col("p.entry_id").alias("entry_id"), F.floor("p.total").cast("long").alias("score"), F.col("p.s.evidence").cast("long").alias("evidence"), F.round("p.s.similarity", 6).alias("similarity"), "match_method")


def dominant_pages(block_pages: DataFrame) -> DataFrame:
    """The page with most blocks of an entry; the smallest of equals."""
    own = block_pages.where(F.col("page_number") > 0).groupBy("entry_id", "page_number").agg(F.count("*").alias("n"))
    return own.groupBy("entry_id").agg(F.max_by("page_number", F.struct("n", -F.col("page_number"))).alias("page_number"))


def fragment_matches(fragments: DataFrame, entries: DataFrame, most: int = 256) -> DataFrame:
    """The table entry whose text, without spaces, holds most of a fragment's tokens: min(length, 12) points a token, and
    6, 3 or 1 for pages at most 1, 3 or 6 apart; of equal points the one with more hits, then the first. It is accepted from
    two hits or ten points on. A fragment without tokens is looked for as a whole, if it has six characters.

    Fragments with all their tokens meet the entries of their document; a document's fragments are dealt over shards of about
    `most`, and its entries go to each. Merged by a hint: Spark takes either side for small, as it counts compressed bytes.
    """
    own = fragments.select("document_id", "fragment_id", F.col("page_number").alias("f_page"), match_tokens(F.col("text")).alias("tokens"), F.regexp_replace(single_line(F.col("text")), " ", "").alias("whole"))
    tokens = F.when(F.size("tokens") > 0, F.col("tokens")).when(F.length("whole") >= 6, F.array("whole"))
    shards = fragments.groupBy("document_id").agg(F.ceil(F.count("*") / most).alias("shards")).hint("merge")
    own = own.select("document_id", "fragment_id", "f_page", tokens.alias("tokens")).where("tokens is not null").join(shards, "document_id").withColumn("shard", F.pmod(F.xxhash64("fragment_id"), "shards")).drop("shards")
    texts = entries.select("document_id", "entry_id", F.col("page_number").alias("e_page"), F.regexp_replace(single_line(F.col("text")), " ", "").alias("whole"))
    texts = texts.join(shards, "document_id").withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1))).drop("shards")
    held = F.filter("tokens", lambda t: F.contains("whole", t))
    points = lambda found: F.aggregate(found, F.lit(0).cast("long"), lambda n, t: n + F.least(F.length(t), F.lit(12)))
    key = ["document_id", "shard", "fragment_id", "f_page", "entry_id", "e_page"]
    met = own.join(texts.hint("merge"), ["document_id", "shard"]).select(*key, let(held, lambda found: F.struct(F.size(found).alias("hits"), points(found).alias("points"))).alias("m"))
    hits = met.where("m.hits > 0").groupBy(*key).agg(F.sum("m.hits").alias("hits"), F.sum("m.points").alias("points"))
    far = F.abs(F.col("f_page") - F.col("e_page"))
    near = F.when((F.col("f_page") > 0) & (F.col("e_page") > 0), F.when(far <= 1, 6).when(far <= 3, 3).when(far <= 6, 1).otherwise(0)).otherwise(0)
    best = F.max(F.struct((F.col("points") + near).alias("score"), "hits", (-F.col("entry_id")).alias("neg"))).alias("best")
    found = hits.groupBy("document_id", "shard", "fragment_id").agg(best).where("best.hits >= 2 or best.score >= 10")
    return found.select("document_id", "fragment_id", (-F.col("best.neg")).alias("entry_id"), F.col("best.score").alias("score"), F.col("best.hits").alias("hits"))


def filled_anchors(items: DataFrame) -> DataFrame:
    """A missing anchor text is that of its (page, kind) if they have exactly one."""
    page = Window.partitionBy("document_id", "page_number", "kind")
    known = F.when(strip(text_or_empty(F.col("anchor"))) != "", F.col("anchor"))
    one = F.when(F.min(known).over(page) == F.max(known).over(page), F.min(known).over(page))
    return items.withColumn("anchor", F.coalesce(known, one))


def synced_clauses(clauses: DataFrame, sources: DataFrame, factor: float = 1.2) -> DataFrame:
    """A clause takes its source's text, by (title, clause), if that is longer than `factor` times its own."""
    own = clauses.join(sources.select("title", "clause", F.col("text").alias("source")), ["title", "clause"], "left")
    longer = F.coalesce(F.length("source") > F.length("text") * factor, F.lit(False))
    return own.withColumns({"text": F.when(longer, F.col("source")).otherwise(F.col("text")), "synced": longer}).drop("source")


def approved(entries: DataFrame, fixes: DataFrame, least: float = 1.0) -> DataFrame:
    """For each fix of an entry whose confidence is above least, in order of seq (or of before, without one), the first
    occurrence of `before` in the content so far becomes `after`. One row an entry."""
    seq = F.col("seq") if "seq" in fixes.columns else F.lit(0)
    listed = fixes.where((F.col("confidence") > least) & (F.col("before") != "")).groupBy("entry_id").agg(F.array_sort(F.collect_list(F.struct(seq.alias("seq"), "before", F.coalesce("after", F.lit("")).alias("after")))).alias("__fixes"))

    def fold(acc: Column, x: Column) -> Column:
        at = F.instr(acc["content"], x["before"])
        changed = F.concat(F.substring(acc["content"], F.lit(1), at - 1), x["after"], F.substring(acc["content"], at + F.length(x["before"]), F.length(acc["content"])))
        return F.when(at > 0, F.struct(changed.alias("content"), F.lit(True).alias("fixed"))).otherwise(acc)

    start = F.struct(F.col("content").alias("content"), F.lit(False).alias("fixed"))
    own = entries.join(listed, "entry_id", "left").withColumn("__new", F.when(F.col("__fixes").isNull(), start).otherwise(F.aggregate("__fixes", start, fold)))
    return own.withColumns({"content": F.col("__new.content"), "fixed": F.col("__new.fixed")}).drop("__fixes", "__new")


def linked_titles(refs: DataFrame, toc: DataFrame) -> DataFrame:
    """Text references to titles, by an index in which the last entry of a title wins."""
    last = toc.groupBy("title").agg(F.max_by("entry_id", "seq").alias("entry_id"))
    return refs.join(last, "title", "left")


# References to figures and tables, and to chapters, sections and articles.
FIGURE_LINK = r"([见详见]?[图表]\s*(\d+[-—.]\d+|\d+))"
CLAUSE_LINK = r"([见详见]?(第\s*(\d+(\.\d+)*|[0-9一二三四五六七八九十百]+)\s*[章节条款]))"


def linked_by(text: Column, pattern: str, target: Callable[[Column, Column], Column]) -> Column:
    """A text in which each match of a pattern is a link to target(group 2, group 3), where that isn't null."""
    pattern = f"(?U){pattern}"
    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), 1), lambda m: F.struct(m.alias("m"), F.regexp_extract(m, f"^{pattern}$", 2).alias("a"), F.regexp_extract(m, f"^{pattern}$", 3).alias("b") if pattern.count("(") > 4 else F.lit("").alias("b")))
    shown = F.transform(found, lambda m: let(target(m["a"], m["b"]), lambda t: F.when(t.isNull(), m["m"]).otherwise(F.concat(F.lit("["), m["m"], F.lit("](#"), t, F.lit(")")))))
    pairs = F.zip_with(F.split(text, pattern, -1), shown, lambda part, link: F.concat(part, F.coalesce(link, F.lit(""))))
    return F.when(text.rlike(pattern), F.array_join(pairs, "")).otherwise(text)


def cross_references(entries: DataFrame, blocks: DataFrame) -> DataFrame:
    """Links in the contents of entries: 图 and 表 with a number to the first block of the entry whose caption holds the
    number; chapters, sections and articles to the entry of the document that is named so: by its title, the title's last
    part, or a heading's text, each with or without 条 at its end; of several the last.

    entries: document_id, entry_id, position, title, content. blocks: document_id, entry_id, seq, id, role, text, caption.
    """
    key = ["document_id", "entry_id"]
    parts = F.filter(F.transform(F.split("title", "/"), strip), lambda x: x != "")
    leaf = F.try_element_at(parts, F.lit(-1))
    short = lambda c: F.when(c.endswith("条"), strip(F.regexp_replace(c, "条$", "")))
    named = entries.select("document_id", "entry_id", "position", F.posexplode(F.array(strip(text_or_empty(F.col("title"))), leaf, short(leaf))).alias("n", "name"))
    heads = blocks.where("role = 'heading'").join(entries.select(*key, "position"), key).withColumn("t", strip(text_or_empty(F.col("text"))))
    heads = heads.select("document_id", "entry_id", "position", "seq", F.posexplode(F.array("t", short(F.col("t")))).alias("k", "name")).select("document_id", "entry_id", "position", (F.col("seq") * 2 + 3 + F.col("k")).alias("n"), "name")
    index = named.unionByName(heads).where("name <> ''").groupBy("document_id", "name").agg(F.max_by("entry_id", F.struct("position", "n")).cast("string").alias("target"))
    asked = F.transform(F.regexp_extract_all("content", F.lit(f"(?U){CLAUSE_LINK}"), 1), lambda m: F.array(F.regexp_extract(m, f"(?U){CLAUSE_LINK}", 2), F.regexp_extract(m, f"(?U){CLAUSE_LINK}", 3)))
    names = entries.select(*key, F.explode(F.array_distinct(F.flatten(asked))).alias("name")).join(index, ["document_id", "name"])
    names = names.groupBy(*key).agg(F.map_from_entries(F.collect_list(F.struct("name", "target"))).alias("__names"))
    shown = blocks.where(strip(text_or_empty(F.col("caption"))) != "").groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("seq", F.col("id").cast("string").alias("id"), "caption"))).alias("__captions"))
    own = entries.join(names, key, "left").join(shown, key, "left")
    captioned = lambda a, _: F.try_element_at(F.filter("__captions", lambda b: F.contains(b["caption"], a)), F.lit(1))["id"]
    own = own.withColumn("content", linked_by(text_or_empty(F.col("content")), FIGURE_LINK, captioned))
    own = own.withColumn("content", linked_by(F.col("content"), CLAUSE_LINK, lambda a, b: F.coalesce(F.try_element_at("__names", a), F.try_element_at("__names", b))))
    return own.drop("__names", "__captions")


def borrowed_captions(entries: DataFrame) -> DataFrame:
    """A label that an entry wants and lacks is taken from the next entry, if that is on the next page and has it."""
    order = Window.partitionBy("document_id").orderBy("position")
    fits = (F.lead("page_number").over(order) == F.col("page_number") + 1) & F.array_contains(F.lead("labels").over(order), F.col("wanted"))
    has = F.array_contains("labels", F.col("wanted"))
    return entries.withColumn("borrowed", F.coalesce(~has & fits, F.lit(False)))
