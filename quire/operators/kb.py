"""Operators on entries, manifest items and assets: filters with reasons, fallbacks, anchors, moves between entries."""

from __future__ import annotations

import math
from collections import Counter
from itertools import groupby

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.roles import anchor, loose_page_marker
from quire.functions.text import CJK, FIGURE_LABEL, LABEL, base_name, compact, fingerprint, labels, match_tokens, matches_of, number_chain, reference_labels, replace_leading_number, single_line, squeeze, strip, text_or_empty
from quire.operators.align import align_items
from quire.operators.groups import by_group

# Placeholders, weights of roles in ranking, words that hint at tables and figures.
PLACEHOLDERS = ("[]", "{}", "null", "None", "nan", "N/A")
ROLE_WEIGHTS = {"heading": 3, "body": 2, "table": 2, "table_note": 1, "caption": 1, "artifact": 0, "figure": 0}
FIGURE_WORDS, TABLE_WORDS = ("示例图", "示意图", "接线图", "布置图"), ("明细表", "附表", "表")


def any_of(c: Column, words: tuple[str, ...]) -> Column:
    return c.rlike("|".join(words))


def in_scope(unit: Column, title: Column, entry_id: Column, units: tuple[str, ...] = (), titles: tuple[str, ...] = (), prefixes: tuple[str, ...] = ()) -> Column:
    """One of each list that isn't empty; lists are joined by and."""
    out = F.lit(True)
    for c, words, test in ((unit, units, F.contains), (title, titles, F.contains), (entry_id, prefixes, F.startswith)):
        if words:
            own = F.lit(False)
            for w in words:
                own = own | test(text_or_empty(c), F.lit(w))
            out = out & own
    return out


def effective_candidate(c: Column) -> Column:
    """Worth a correction: no placeholder, two characters or more; without CJK, three alphanumerics and little punctuation."""
    own = strip(text_or_empty(c))
    odd = matches_of(own, rf"[^\p{{L}}\p{{N}}_{CJK}]")
    plain = (matches_of(own, "[0-9A-Za-z]") >= 3) & (odd <= F.greatest(F.lit(2), F.floor(F.length(own) / 2)))
    return ~own.isin(*PLACEHOLDERS) & (F.length(own) > 1) & (own.rlike(f"[{CJK}]") | plain)


def ocr_skip_reason(status: Column, source: Column, uri: Column, has_caption: Column) -> Column:
    """Why a figure's caption isn't recognised; null if it may be."""
    unsafe = (strip(text_or_empty(uri)) == "") | uri.rlike(r"^([/\\]|[A-Za-z]:|[a-z]+://)|(^|[/\\])\.\.([/\\]|$)")
    return F.when(~status.eqNullSafe(F.lit("ready")), "not_ready").when(~source.eqNullSafe(F.lit("embedded")), "not_embedded").when(unsafe, "unsafe_uri").when(F.coalesce(has_caption, F.lit(False)), "has_caption")


def reference_source(kind: Column, role: Column, source: Column) -> Column:
    """Text that may refer to figures: no caption, legend, callout, artifact, nor recognised text."""
    return kind.isin("text", "heading") & ~text_or_empty(role).isin("caption", "legend", "figure_callout", "artifact") & ~text_or_empty(source).isin("ocr", "ocr_caption")


def without_empty(entries: DataFrame) -> DataFrame:
    """Entries with text, or with a block that isn't text."""
    return entries.where((strip(text_or_empty(F.col("content"))) != "") | (F.coalesce(F.col("n_visual"), F.lit(0)) > 0))


def pure_caption(c: Column) -> Column:
    return compact(text_or_empty(c)).rlike(r"^(?:[0-9]+)?[图表][0-9一二三四五六七八九十百千万—\-~～]+")


def skips_alignment(kind: Column, signals: Column) -> Column:
    """A figure's record all of whose signals are the same text, which is a caption alone."""
    norms = F.array_distinct(F.filter(F.transform(signals, single_line), lambda x: x != ""))
    return (F.lower(text_or_empty(kind)) != "table") & (F.size(norms) == 1) & F.exists(signals, pure_caption)


def covers_fragment(snapshot: Column, fragment: Column) -> Column:
    """SF25: a recognised snapshot holds a fragment whole, or enough of its tokens' characters."""
    held, own, tokens = compact(single_line(snapshot)), compact(single_line(fragment)), match_tokens(fragment)
    total = F.aggregate(tokens, F.lit(0), lambda acc, t: acc + F.length(t))
    matched = F.aggregate(tokens, F.lit(0), lambda acc, t: acc + F.when(F.contains(held, t), F.length(t)).otherwise(0))
    ratio = F.when(total > 0, matched / total).otherwise(0.0)
    enough = (matched >= 8) & (ratio >= 0.45) | (F.size(tokens) >= 3) & (matched >= 12) & (ratio >= 0.40)
    return (F.length(held) >= 8) & (F.length(own) >= 6) & (F.contains(held, own) | enough)


def rejected_fix(original: Column, fixed: Column, kind: Column) -> Column:
    """SF47: why a corrected text isn't taken; null if it is."""
    own, new = text_or_empty(original), strip(F.regexp_replace(text_or_empty(fixed), "```", ""))
    grown = F.abs(F.length(new) - F.length(own)) > F.greatest(F.lit(18), F.floor(F.length(own) * 0.6))
    marks = lambda c: F.regexp_extract_all(c, F.lit(r"(\[IMAGE_REF:[^\]]+\])"), 1)
    return (
        F.when(new == "", "empty_result").when(grown, "length_delta_too_large")
        .when((kind != "paragraph") & (matches_of(new, "\n") > matches_of(own, "\n") + 2), "unexpected_multiline")
        .when(marks(own) != marks(new), "image_placeholder_changed").when(anchor(own).isNotNull() & anchor(new).isNull(), "anchor_lost")
    )


def caption_status(c: Column, confidence: Column, least: float = 60.0, longest: int = 40) -> Column:
    """SF43: empty, label_only, ambiguous_multiple_labels, rejected or linked, of a text recognised below a figure."""
    own = strip(text_or_empty(c))
    keys = labels(own, FIGURE_LABEL)
    title = F.regexp_replace(F.regexp_extract(own, rf"(?s){FIGURE_LABEL}(.*)$", 1), r"[。；;！？!?].*$", "")
    title = F.regexp_replace(compact(title), r"^[\p{P}]+|[\p{P}]+$", "")
    cjk = matches_of(title, f"[{CJK}]")
    bad = (F.length(title) > longest) | (cjk < 2) | title.rlike(r"[A-Za-z\\]{3,}") | own.rlike(r"见|如图|参见") | (cjk / F.greatest(F.length(title), F.lit(1)) < 0.5) | (confidence < least)
    return F.when(own == "", "empty").when(F.size(keys) == 0, "rejected").when(F.size(keys) > 1, "ambiguous_multiple_labels").when(title == "", "label_only").when(bad, "rejected").otherwise("linked")


def full_clause(c: Column, chapter: Column, section: Column) -> Column:
    """The full number of a clause whose first parts were lost, from the chapter and section it stands in; null if it can't be told."""
    own, chapter, section = strip(text_or_empty(c)), strip(text_or_empty(chapter)), strip(text_or_empty(section))
    dotted = own.rlike("^[.．]")
    chain = number_chain(F.regexp_extract(own, r"^[.．]?\s*([0-9]{1,3}(?:\s*[.．]\s*[0-9]{1,3})*)", 1))
    parts, above = F.split(chain, r"\."), F.split(section, r"\.")
    joined = lambda *x: F.concat_ws(".", *x)
    lost = F.when((F.size(parts) >= 2) & (chapter != ""), joined(chapter, chain)).when(section != "", joined(section, chain))
    follows = (F.size(parts) >= 2) & (F.element_at(parts, 1) == F.element_at(above, -1))
    within = F.when(follows & (F.size(above) >= 2), joined(F.array_join(F.slice(above, 1, F.greatest(F.size(above) - 1, F.lit(1))), "."), chain)).when(follows & (chapter != ""), joined(chapter, chain)).when(~follows & (chapter != "") & (F.element_at(parts, 1) != chapter), joined(chapter, chain))
    told = F.when(section != "", within).when((chapter != "") & (F.size(parts) >= 2), joined(chapter, chain))
    return F.when(chain != "", F.when(dotted, lost).when(F.size(parts) >= 2, told))


def clause_text(c: Column, number: Column) -> Column:
    return replace_leading_number(c, number)


def sequential_clause(c: Column) -> Column:
    """SF34: struct of number (null: it was lost) and text of a paragraph that begins a clause; null if it doesn't."""
    own = strip(text_or_empty(c))
    numbered, lost = r"^([0-9]{1,3})\s*[-—.．、]\s*(.+)$", r"^[.．]\s*(.+)$"
    no = own.rlike(r"^[（(]?[0-9]+[）)]|^[一二三四五六七八九十百千]+\s*[、,，.]|^\[IMAGE_REF:")
    rest = strip(F.regexp_extract(own, numbered, 2))
    title = (F.length(compact(rest)) <= 20) & ~rest.rlike("[。；;！？!?，,]")
    row = lambda n, t: F.struct(n.cast("int").alias("number"), t.alias("text"))
    return F.when(no, None).when(own.rlike(numbered) & ~title, row(F.regexp_extract(own, numbered, 1), rest)).when(own.rlike(lost), row(F.lit(None), strip(F.regexp_extract(own, lost, 1))))


def fallback_entries(items: DataFrame, entries: DataFrame) -> DataFrame:
    """Of the entries on an item's page: the one that holds its heading (120 a title, 60 the content, half for headings
    of less than 3 characters), else one whose dominant page it is, else the first by position."""
    pairs = items.select("document_id", "item_id", "page_number", "heading").join(entries, ["document_id", "page_number"])
    key = single_line(F.col("heading"))
    hit = lambda c, points: F.when((key != "") & F.contains(single_line(F.col(c)), key), points).otherwise(0)
    score = F.floor((hit("title", 120) + hit("content", 60)) * F.when(F.length(key) < 3, 0.5).otherwise(1.0))
    order = Window.partitionBy("document_id", "item_id").orderBy(F.desc("score"), F.desc((F.col("dominant_page") == F.col("page_number")).cast("int")), "position", "entry_id")
    best = pairs.withColumn("score", score).withColumn("r", F.row_number().over(order)).where("r = 1")
    how = F.when(F.col("score") > 0, "heading").when(F.col("dominant_page") == F.col("page_number"), "dominant_page").otherwise("position")
    return best.select("document_id", "item_id", "entry_id", "score", how.alias("method"))


def reattached(orphans: DataFrame, entries: DataFrame, radius: int = 8) -> DataFrame:
    """Orphan assets to the best entry within `radius` pages (of all the document's, where none is so near), from a score of
    220 (tables) or 180 on."""
    near = align_items(orphans, entries, radius)
    far = orphans.join(near.select("document_id", "item_id"), ["document_id", "item_id"], "left_anti")
    # all entries are candidates where every one stands on the orphan's page; scores of place don't count there
    none = F.lit(0).cast("long")
    wide = align_items(far.withColumn("page_number", none), entries.withColumn("page_number", none), 0)
    found = near.unionByName(wide).drop("match_method")
    kinds = orphans.select("document_id", "item_id", "kind")
    return found.join(kinds, ["document_id", "item_id"]).where(F.col("score") >= F.when(F.col("kind") == "table", 220).otherwise(180))


def distance(a: str, b: str) -> int:
    """The Levenshtein distance of two texts; a column of its table is two whole numbers with a bit a character (Myers, Hyyrö)."""
    if len(a) < len(b):
        a, b = b, a
    n = 0
    while n < len(b) and a[n] == b[n]:
        n += 1
    a, b = a[n:], b[n:]
    while b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    if not b:
        return len(a)
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    every, last, score = (1 << len(a)) - 1, 1 << len(a) - 1, len(a)
    up, down = every, 0
    for c in b:
        same = places.get(c, 0)
        level = (((same & up) + up) ^ up) | same
        more, less = down | every & ~(level | up), up & level
        score += bool(more & last) - bool(less & last)
        more, kept = (more << 1 | 1) & every, same | down
        up, down = (less << 1) & every | every & ~(kept | more), more & kept
    return score


class Compared:
    """A text and its bag of characters, for the similarity of text.levenshtein_similarity() and an upper bound of it."""

    def __init__(self, text: str):
        self.text, self.bag = text, Counter(text)

    def like(self, other: Compared, cutoff: float, exact: bool) -> float:
        longer = max(len(self.text), len(other.text))
        most = math.floor(longer * (1.0 - cutoff)) + 1
        if not self.text or not other.text or abs(len(self.text) - len(other.text)) > most:
            return 0.0
        # what two bags don't share has to be put in, taken out or changed
        few, many = sorted((self.bag, other.bag), key=len)
        least = longer - sum(min(n, many[c]) for c, n in few.items() if c in many)
        d = distance(self.text, other.text) if exact and least <= most else least
        return 0.0 if d > most else 1.0 - d / longer


class Structured:
    """How well a text of a page fits another: containment 900 (760 without spaces), marks 950, 55 a token, similarity."""

    def __init__(self, seq: int, line: str, mark: str, tokens: list[str]):
        self.seq, self.line, self.mark, self.compact, self.tokens = seq, Compared(line), Compared(mark), line.replace(" ", ""), tokens

    def base(self, other: Structured) -> int:
        within = lambda x, y: x != "" and y != "" and (x in y or y in x)
        score = 900 if within(self.line.text, other.line.text) else 760 if within(self.compact, other.compact) else 0
        hits = sum(t in other.compact or t in other.mark.text for t in self.tokens)
        return score + 950 * within(self.mark.text, other.mark.text) + hits * 55

    def similar(self, other: Structured, exact: bool) -> int:
        marks = self.mark.like(other.mark, 0.35, exact)
        if exact and marks > 0:
            return math.floor(marks * 220)
        return math.floor(max(marks, self.line.like(other.line, 0.35, exact)) * 220)


def overlaid(blocks: DataFrame, source: DataFrame, least: int = 180) -> DataFrame:
    """Each block of a page takes, in order, the free source block of the best score (the first of equals).

    A block's sources are tried from the highest bound of their score down, until none can be better: so most pairs need no distance.
    """
    side = lambda rows, given: rows.select("document_id", "page_number", F.lit(given).alias("given"), F.col("seq").cast("long").alias("seq"), single_line(F.col("text")).alias("line"), fingerprint(F.col("text")).alias("mark"), F.slice(match_tokens(F.col("text")), 1, 12).alias("tokens"))
    rows = side(blocks, False).unionByName(side(source, True)).where("document_id is not null and page_number is not null")

    def run(page: list) -> list[tuple]:
        made = lambda given: [Structured(r.seq, r.line, r.mark, r.tokens) for r in page if r.given == given]
        free, out = made(True), []
        for seq, same in groupby(made(False), key=lambda a: a.seq):
            tried = []
            for a in same:
                for b in free:
                    base = a.base(b)
                    if (most := base + a.similar(b, False)) >= least:
                        tried.append((most, base, a, b))
            best = None
            for most, base, a, b in sorted(tried, key=lambda x: -x[0]):
                if best and most < best[0]:
                    break
                score = base + a.similar(b, True)
                if score >= least and (best is None or (score, -b.seq) > best):
                    best = (score, -b.seq)
            if best:
                free = [b for b in free if b.seq != -best[1]]
                out.append((seq, -best[1], best[0]))
        return out

    keys = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("document_id", "page_number"))
    return by_group(rows, ["document_id", "page_number"], ["given", "seq"], run, f"{keys}, seq long, source_seq long, score long")


def overlaid_pictures(blocks: DataFrame, source: DataFrame) -> DataFrame:
    """J12, pictures: each block takes the first source block of its page whose picture has the same file name, whatever the case.

    Both: document_id, page_number, seq, uri. Rows document_id, page_number, seq, source_seq.
    """
    key = ["document_id", "page_number", "name"]
    side = lambda rows: rows.withColumn("name", F.lower(base_name(F.col("uri")))).where("name <> ''")
    first = side(source).groupBy(*key).agg(F.min("seq").alias("source_seq"))
    return side(blocks).join(first, key).select("document_id", "page_number", "seq", "source_seq")


def rebound(matches: DataFrame, current: DataFrame, score: int = 6, hits: int = 2) -> DataFrame:
    """Snapshots whose best entry beats the one they have by `score` points or `hits` hits, and isn't it."""
    own = current.select("fragment_id", F.col("entry_id").alias("old_entry"), F.col("score").alias("old_score"), F.col("hits").alias("old_hits"))
    better = (F.col("score") >= F.col("old_score") + score) | (F.col("hits") >= F.col("old_hits") + hits)
    return matches.join(own, "fragment_id").where((F.col("entry_id") != F.col("old_entry")) & better).select("fragment_id", "old_entry", "entry_id")


def heading_hints(crops: DataFrame, hints: DataFrame, radius: int = 2) -> DataFrame:
    """Each crop, in order, takes the next unused heading of the nearest page within `radius` (earlier pages first of
    equals), of its own kind if there is one. crops and hints: document_id, page_number, seq, kind; hints: text."""
    sides = crops.select("document_id", "page_number", "seq", "kind", F.lit(None).cast("string").alias("text"), F.lit(0).alias("side"))
    sides = sides.unionByName(hints.select("document_id", "page_number", "seq", "kind", "text", F.lit(1).alias("side")))

    def run(doc: list) -> list[tuple]:
        free: dict[int, list] = {}
        for r in doc:
            if r.side:
                free.setdefault(r.page_number, []).append(r)
        out = []
        for r in doc:
            if r.side:
                continue
            pages = sorted((p for p in range(r.page_number - radius, r.page_number + radius + 1) if free.get(p)), key=lambda p: (abs(p - r.page_number), p))
            pick = next((h for p in pages for h in free[p] if h.kind == r.kind), None) or next((h for p in pages for h in free[p]), None)
            if pick:
                free[pick.page_number].remove(pick)
                out.append((r.page_number, r.seq, pick.page_number, pick.text))
        return out

    kind = sides.schema["document_id"].dataType.simpleString()
    return by_group(sides, ["document_id"], ["page_number", "seq", "side"], run, f"document_id {kind}, page_number long, seq long, hint_page long, heading string")


# Words of a reference, and words of captions that may stand in a line of their own.
REFERENCE_HINT, FRAGMENT_NAMES = "见|如|参见|所示|示例图|示意图|接线图|布置图|明细表", "示例图|示意图|接线图|布置图|明细表"


def anchor_score(text: Column, above: Column, below: Column, gap: Column, overlap: Column, kind: Column, target: Column, reference: bool = False) -> Column:
    """How well a text block of a page names a picture (or, if reference, refers to it): where it stands, its label, and words
    of its kind."""
    own = F.try_element_at(labels(text, LABEL), F.lit(1))
    score = F.when(above, 120).when(below, 85).otherwise(70) - F.least(F.lit(260), gap.cast("int")) + F.floor(overlap * 90).cast("int")
    known, asked = own.isNotNull(), text_or_empty(target) != ""
    within = F.contains(target, own) | F.contains(compact(text), target)
    score = score + F.when(known & asked, F.when(own == target, 260).when(within, 170).otherwise(0)).when(known, 140).otherwise(0)
    table, legend = kind == "table", kind == "legend"
    if reference:
        words = F.when(table & any_of(text, ("明细表",)), 80).when(legend & any_of(text, FIGURE_WORDS), 70).otherwise(0)
        score = score + F.when(any_of(text, (REFERENCE_HINT,)), 180).otherwise(0) + words
    else:
        figure = any_of(text, (*FIGURE_WORDS, "图"))
        score = score + F.when(known, 150).otherwise(0) + F.when(table & any_of(text, TABLE_WORDS), 90).when(legend & figure, 80).otherwise(0)
        score = score - F.when(legend & ~known & ~any_of(text, (*FIGURE_WORDS, "明细表")), 220).otherwise(0) - F.when(table & ~known & ~any_of(text, ("表",)), 180).otherwise(0)
    return score - F.when(F.length(text) <= 2, 180).otherwise(0)


def with_context(texts: DataFrame) -> DataFrame:
    """Texts of a page with what belongs to them: the block before, if it ends in 见 or 如 or is a caption's rest, and a short
    one after that refers or has a label. Adds context."""
    order = Window.partitionBy("document_id", "entry_id", "page_number").orderBy("seq")
    text = strip(text_or_empty(F.col("text")))
    own = texts.withColumns({"__t": text, "__p": F.lag(text).over(order), "__n": F.lead(text).over(order), "__up": F.col("y") - F.lag(F.col("y") + F.col("h")).over(order), "__down": F.lead("y").over(order) - F.col("y") - F.col("h")})
    named = lambda c: F.size(labels(c, LABEL)) > 0
    rest = named(F.col("__t")) & (F.length("__p") <= 24) & F.col("__p").rlike(FRAGMENT_NAMES)
    before = F.when((F.greatest(F.lit(0), "__up") <= 60) & (F.col("__p").rlike("(见|如|参见)$") | rest), F.col("__p"))
    after = F.when((F.greatest(F.lit(0), "__down") <= 42) & (F.length("__n") <= 32) & (F.col("__n").rlike(REFERENCE_HINT) | named(F.col("__n")) | (F.length("__t") <= 16)), F.col("__n"))
    merged = single_spaced(F.concat_ws(" ", F.nullif(before, F.lit("")), "__t", F.nullif(after, F.lit(""))))
    return own.withColumn("context", F.when(F.col("__t") != "", merged)).drop("__t", "__p", "__n", "__up", "__down")


def single_spaced(c: Column) -> Column:
    return strip(squeeze(c))


def visual_anchors(visuals: DataFrame, texts: DataFrame, entries: DataFrame) -> DataFrame:
    """For each visual the text of its page that best refers to it and the one that best names it, the first of equals; where
    the page has none, the entry's title.

    visuals: document_id, entry_id, page_number, seq, kind, caption, x, y, w, h. texts: those but kind and caption, and text.
    entries: document_id, entry_id, title. Rows document_id, entry_id, seq, anchor_text, heading_text.
    """
    page = ["document_id", "entry_id", "page_number"]
    side = lambda rows, p, more: rows.select(*page, *[F.col(c).alias(f"{p}_{c}") for c in ("seq", *more, "x", "y", "w", "h")])
    pairs = side(visuals, "v", ("kind", "caption")).join(side(with_context(texts).where("context is not null"), "t", ("context",)), page)
    above, below = F.col("t_y") + F.col("t_h") <= F.col("v_y"), F.col("t_y") >= F.col("v_y") + F.col("v_h")
    gap = F.greatest(F.lit(0), F.col("v_y") - F.col("t_y") - F.col("t_h"), F.col("t_y") - F.col("v_y") - F.col("v_h"))
    shared = F.greatest(F.lit(0), F.least(F.col("t_x") + F.col("t_w"), F.col("v_x") + F.col("v_w")) - F.greatest("t_x", "v_x"))
    base = F.least("t_w", "v_w")
    label = F.coalesce(F.try_element_at(labels(F.col("v_caption"), LABEL), F.lit(1)), F.lit(""))
    score = lambda reference: anchor_score(F.col("t_context"), above, below, gap, F.when(base > 0, shared / base).otherwise(0.0), F.col("v_kind"), label, reference)
    scored = pairs.withColumns({"reference": -score(True), "name": -score(False)})
    best = lambda c: F.min(F.struct(c, "t_seq", "t_context"))["t_context"]
    found = scored.groupBy("document_id", "entry_id", F.col("v_seq").alias("seq")).agg(best("reference").alias("anchor"), best("name").alias("heading"))
    own = visuals.select("document_id", "entry_id", "seq").join(found, ["document_id", "entry_id", "seq"], "left").join(entries.select("document_id", "entry_id", F.substring("title", 1, 120).alias("title")), ["document_id", "entry_id"], "left")
    return own.select("document_id", "entry_id", "seq", F.substring(F.coalesce("anchor", "title", F.lit("")), 1, 160).alias("anchor_text"), F.substring(F.coalesce("heading", "title", F.lit("")), 1, 160).alias("heading_text"))


def page_owners(blocks: DataFrame, entries: DataFrame) -> DataFrame:
    """Blocks that stand more than one page from their entry go to the last entry of their own page, if it has one."""
    owner = entries.groupBy("document_id", F.col("page_number").alias("block_page")).agg(F.max_by("entry_id", "position").alias("owner"))
    own = blocks.join(owner, ["document_id", "block_page"], "left")
    moved = (F.abs(F.col("block_page") - F.col("entry_page")) > 1) & F.col("owner").isNotNull() & (F.col("owner") != F.col("entry_id"))
    return own.withColumns({"moved": moved, "entry_id": F.when(moved, F.col("owner")).otherwise(F.col("entry_id"))}).drop("owner")


def attached_snapshots(blocks: DataFrame, snapshots: DataFrame) -> DataFrame:
    """An entry's i-th snapshot goes to its i-th table block without one; those left over have no block."""
    n = lambda: F.row_number().over(Window.partitionBy("entry_id").orderBy("seq"))
    missing = blocks.where("uri is null").select("entry_id", F.col("seq").alias("block_seq"), n().alias("n"))
    return snapshots.select("entry_id", "seq", "uri", n().alias("n")).join(missing, ["entry_id", "n"], "left").drop("n")


def merged_to_fixpoint(boxes: DataFrame, gap: float = 12, align: float = 0.7) -> DataFrame:
    """Stacked boxes of one kind, `gap` apart at most and `align` of the narrower one's width in common, become one, again
    until none is left to merge. Rows keep the smallest seq."""
    def near(a: list, b: list) -> bool:
        width = min(a[0] + a[2], b[0] + b[2]) - max(a[0], b[0])
        apart = max(a[1], b[1]) - min(a[1] + a[3], b[1] + b[3])
        return a[5] == b[5] and apart <= gap and width >= align * min(a[2], b[2])

    def run(page: list) -> list[tuple]:
        own = [[r.x, r.y, r.w, r.h, r.seq, r.kind] for r in page]
        i = 0
        while i < len(own):
            j = next((j for j in range(len(own)) if j != i and near(own[i], own[j])), None)
            if j is None:
                i += 1
                continue
            a, b = own[i], own[j]
            x, y = min(a[0], b[0]), min(a[1], b[1])
            both = [x, y, max(a[0] + a[2], b[0] + b[2]) - x, max(a[1] + a[3], b[1] + b[3]) - y, min(a[4], b[4]), a[5]]
            own = sorted([o for k, o in enumerate(own) if k not in (i, j)] + [both], key=lambda o: o[4])
            i = 0
        return [(o[4], o[5], *o[:4]) for o in own]

    keys = ", ".join(f"{c} {boxes.schema[c].dataType.simpleString()}" for c in ("document_id", "page_number"))
    return by_group(boxes, ["document_id", "page_number"], ["seq"], run, f"{keys}, seq long, kind string, x long, y long, w long, h long")


def ranking_rows(blocks: DataFrame) -> DataFrame:
    """Blocks with the weight that their role has in ranking; weight 0 is left out. For retrieve.index(weight=...)."""
    weight = F.element_at(F.create_map(*[F.lit(x) for kv in ROLE_WEIGHTS.items() for x in kv]), F.col("role"))
    return blocks.withColumn("weight", F.coalesce(weight, F.lit(1))).where("weight > 0")


def cacheable(status: Column, reason: Column) -> Column:
    """P10: results that another run would give again; none that a missing engine, a time limit or an error made."""
    passing = F.lower(text_or_empty(reason)).rlike("timeout|timed out|unavailable|not installed|exception|error")
    return text_or_empty(status).isin("linked", "label_only", "empty", "rejected", "ambiguous_multiple_labels") & ~passing


def label_only(c: Column) -> Column:
    """A text that is a part's label alone, as (a) or 1)."""
    return compact(text_or_empty(c)).rlike("^[（(]?[0-9A-Za-z一二三四五六七八九十]{1,3}[)）.、]?$")


def panel_markers(c: Column) -> Column:
    """How many different panel marks, as (a) and (b), a text has; a callout of two or more is a legend."""
    return F.size(F.array_distinct(F.regexp_extract_all(F.lower(text_or_empty(c)), F.lit("[（(]([a-z])[）)]"), 1)))


def without_part_labels(blocks: DataFrame) -> DataFrame:
    """Blocks without page numbers, and without the only block of an entry that is a part's name alone, as 第二篇.

    blocks: document_id, entry_id, text, other columns.
    """
    kept = blocks.where(~loose_page_marker(F.col("text")) | (compact(text_or_empty(F.col("text"))) == ""))
    alone = F.count("*").over(Window.partitionBy("document_id", "entry_id")) == 1
    part = compact(text_or_empty(F.col("text"))).rlike("^第[一二三四五六七八九十百0-9]+篇$")
    return kept.withColumn("__gone", alone & part).where("not __gone").drop("__gone")


def without_empty_splits(entries: DataFrame, blocks: DataFrame) -> DataFrame:
    """Entries whose title says [SPLIT], and which have neither a text in their blocks nor a picture, go.

    entries: document_id, entry_id, job_title. blocks: document_id, entry_id, text, image_uri.
    """
    key = ["document_id", "entry_id"]
    filled = blocks.where((strip(text_or_empty(F.col("text"))) != "") | (strip(text_or_empty(F.col("image_uri"))) != "")).select(*key).distinct().withColumn("__filled", F.lit(True))
    title = strip(text_or_empty(F.col("job_title")))
    split = F.contains(title, F.lit(" [SPLIT ")) | title.endswith(" [SPLIT]")
    return entries.join(filled, key, "left").where(~split | F.coalesce("__filled", F.lit(False))).drop("__filled")


def file_metadata(entries: DataFrame, blocks: DataFrame) -> DataFrame:
    """A document's entries and tables, and its different pictures. entries: document_id, entry_id, kind. blocks:
    document_id, image_uri."""
    counts = entries.groupBy("document_id").agg(F.count("*").alias("entries_count"), F.count_if(F.col("kind") == "table").alias("tables_count"))
    uri = strip(text_or_empty(F.col("image_uri")))
    pictures = blocks.where(uri != "").groupBy("document_id").agg(F.countDistinct(uri).alias("images_count"))
    return counts.join(pictures, "document_id", "left").withColumn("images_count", F.coalesce("images_count", F.lit(0).cast("long")))


def visual_streams(tables: DataFrame, legends: DataFrame) -> DataFrame:
    """The candidates of both kinds as one stream; a column that one of them lacks is null there."""
    return tables.withColumn("stream", F.lit("table")).unionByName(legends.withColumn("stream", F.lit("legend")), allowMissingColumns=True)


def first_of_each(texts: Column) -> Column:
    """Different texts of a list that aren't blank, in order of first appearance."""
    return F.array_distinct(F.filter(F.transform(texts, lambda t: strip(text_or_empty(t))), lambda t: t != ""))


def nearest_pages(entries: DataFrame, targets: DataFrame, limit: int = 6) -> DataFrame:
    """For a report, the `limit` entries of a document whose pages are nearest to a target's; the smaller page of equals.

    targets: document_id, target_page, few rows. Keeping k rows a task, no document's entries are sorted as a whole.
    """
    pairs = entries.join(targets, "document_id").withColumn("apart", F.abs(F.col("page_number") - F.col("target_page")))
    order = Window.partitionBy("document_id", "target_page").orderBy("apart", "page_number", "entry_id")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)


def snapshot_bridges(tables: DataFrame, pictures: DataFrame, entries: DataFrame) -> DataFrame:
    """Snapshots of tables that go on from pictures of the page before: each moves to the earlier entry without a table whose
    pictures there fit best, from 10 points on and 3 ahead of the next; the first of equals.

    Points: 6, 4 or 2 for widths within 6, 12 or 20 %, 4 or 2 for left edges within 30 or 80 points, each picture; 5 for one that is
    named as that page's, 2 for the only one, 2 for an entry that refers to labels, 8 for one that speaks of 明细表; less 1 for every
    15 entries between, 6 at most. Judged on the input, each table by itself.

    tables: document_id, entry_id, position, page_number, x, w. pictures: document_id, entry_id, page_number, x, w, uri. entries
    (without tables): document_id, entry_id, position, content. Rows document_id, entry_id, target_id, score.
    """
    left = tables.select("document_id", F.col("entry_id").alias("source"), F.col("position").alias("at"), F.col("page_number").alias("page"), F.col("x").alias("tx"), F.col("w").alias("tw"))
    right = pictures.select("document_id", "entry_id", (F.col("page_number") + 1).alias("page"), F.col("x").alias("px"), F.col("w").alias("pw"), base_name(F.col("uri")).alias("name"))
    apart = F.abs(F.col("tw") - F.col("pw")) / F.greatest("tw", "pw")
    edge = F.abs(F.col("tx") - F.col("px"))
    width = F.when((F.col("tw") > 0) & (F.col("pw") > 0), F.when(apart <= 0.06, 6).when(apart <= 0.12, 4).when(apart <= 0.2, 2).otherwise(0)).otherwise(0)
    match = width + F.when((F.col("tx") > 0) & (F.col("px") > 0), F.when(edge <= 30, 4).when(edge <= 80, 2).otherwise(0)).otherwise(0)
    own = F.startswith(F.lower("name"), F.concat(F.lit("visual_p"), (F.col("page") - 1).cast("string"), F.lit("_")))
    fits = left.where("page > 1").join(right, ["document_id", "page"]).groupBy("document_id", "source", "at", "entry_id").agg(F.count("*").alias("hits"), F.sum(match).alias("match"), F.max(own).alias("own"))
    refers, listed = F.size(reference_labels(F.col("content"))) > 0, F.contains(compact(single_line(F.col("content"))), F.lit("明细表"))
    known = entries.select("document_id", "entry_id", "position", (F.when(refers, 2).otherwise(0) + F.when(listed, 8).otherwise(0)).alias("said"))
    pairs = fits.join(known, ["document_id", "entry_id"]).where(F.col("position") < F.col("at"))
    score = F.col("match") + F.when(F.col("own"), 5).otherwise(0) + F.when(F.col("hits") == 1, 2).otherwise(0) + F.col("said") - F.least(F.lit(6), F.floor((F.col("at") - F.col("position")) / 15))
    order = Window.partitionBy("document_id", "source").orderBy(F.desc("score"), "position", "entry_id")
    ranked = pairs.withColumn("score", score).withColumns({"r": F.row_number().over(order), "second": F.lead("score").over(order)})
    clear = (F.col("score") >= 10) & (F.col("second").isNull() | (F.col("score") - F.col("second") >= 3))
    return ranked.where((F.col("r") == 1) & clear).select("document_id", F.col("source").alias("entry_id"), F.col("entry_id").alias("target_id"), F.col("score").cast("long").alias("score"))


def legend_bridges(pictures: DataFrame) -> DataFrame:
    """A table's entry whose first picture is legend_p{n}_... takes the one such picture of page n - 1 that stands in another
    entry, if there is exactly one and no table's entry has any of that page; of entries that want the same page the first.

    pictures: document_id, entry_id, position, is_table, uri. Rows document_id, entry_id, source_id, uri.
    """
    name = base_name(F.col("uri"))
    page = F.regexp_extract(F.lower(name), r"legend_p(\d+)_idx\d+", 1)
    own = pictures.withColumns({"page": F.when(page != "", page.try_cast("int")), "name": name}).where("page is not null")
    first = own.where("is_table").groupBy("document_id", "entry_id", "position").agg((F.min(F.struct("page", "name"))["page"] - 1).alias("page"))
    used = own.where("is_table").select("document_id", "page").distinct()
    wanted = first.where("page > 0").join(used, ["document_id", "page"], "left_anti")
    donors = own.select("document_id", "page", F.col("entry_id").alias("source_id"), "uri")
    pairs = wanted.join(donors, ["document_id", "page"]).where(F.col("source_id") != F.col("entry_id"))
    single = pairs.groupBy("document_id", "page", "entry_id", "position").agg(F.count("*").alias("n"), F.first("source_id").alias("source_id"), F.first("uri").alias("uri")).where("n = 1")
    order = Window.partitionBy("document_id", "page").orderBy("position", "entry_id")
    return single.withColumn("r", F.row_number().over(order)).where("r = 1").select("document_id", "entry_id", "source_id", "uri")
