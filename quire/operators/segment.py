"""Order-dependent operators: entries, reading order, splits, merges, contexts, ranks.

Blocks: document_id, page_number, reading_order, id, role, text. Ties in order are broken by id, so results don't depend
on input order or partitions. Windows are by document (or page), whose size the input bounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.roles import heading, projection_class
from quire.functions.text import compact, let, strip, text_or_empty


def entries(blocks: DataFrame, strategy: str = "heading") -> DataFrame:
    """Blocks become entries. Searchable texts open one at headings, or at each page; tables open one on a page that
    has none yet; what only supports them joins its page's host.

    blocks may also have type (text where missing), image_uri, asset_status and markdown (of tables that have cells). A
    supporting text or a figure joins the current entry if that began on its page, else the next searchable text or table
    of its page, before whose block it then stands (texts first). Where the page has none, supporting texts are left out,
    and ready figures become an entry of kind `figure`, if no other entry touches the page. Excluded texts are always left
    out. Content is the searchable texts and the tables' Markdown, joined by an empty line, from the first that isn't empty.

    position counts the entries that were complete when an entry began, so an entry of figures between two pages of
    another shares that one's number.
    """
    if strategy not in ("heading", "page"):
        raise ValueError(f"no such strategy: {strategy}")
    given = set(blocks.columns)
    own = blocks.withColumns({c: F.lit(None).cast("string") for c in ("type", "image_uri", "asset_status", "markdown") if c not in given})
    kind = F.lower(F.coalesce("type", F.lit("text")))
    textual, figure = kind.isin("text", "heading", "caption"), kind.isin("image", "figure")
    own = own.withColumn("class", F.when(textual, projection_class(F.col("role"))).when(figure, "figure").otherwise("table")).where("class <> 'excluded'")
    uri = F.coalesce("image_uri", F.lit(""))
    own = own.withColumns({
        "text": F.coalesce("text", F.lit("")), "head": (F.col("class") == "searchable") & ((F.col("role") == "heading") | (kind == "heading")),
        "host": F.col("class").isin("searchable", "table"), "ready": (figure & (uri != "") & (F.coalesce(F.nullif("asset_status", F.lit("")), F.lit("ready")) == "ready")),
    }).fillna({"head": False})
    order = Window.partitionBy("document_id").orderBy("page_number", "reading_order", "id")
    page = Window.partitionBy("document_id", "page_number").orderBy("reading_order", "id")
    before = lambda c, w: F.coalesce(F.count_if(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) > 0
    if strategy == "heading":
        own = own.withColumn("opens", F.col("head") | (F.col("class") == "searchable") & ~before(F.col("host"), order))
        start = F.col("opens") | (F.col("class") == "table") & ~before(F.col("opens") | (F.col("class") == "table"), page)
    else:
        start = F.col("host") & ~before(F.col("host"), page)
    whole = page.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = page.rowsBetween(1, Window.unboundedFollowing)
    own = own.withColumn("start", start).withColumns({"at": F.row_number().over(order), "entry_no": F.count_if("start").over(order), "here": before(F.col("start"), page), "hosted": F.max("host").over(whole)})
    alone = F.col("ready") & ~F.col("hosted")
    own = own.withColumns({"next": F.first(F.when(F.col("host"), F.struct("at", "entry_no")), ignorenulls=True).over(after), "alone": alone, "opens_page": alone & ~before(alone, page)})
    own = own.withColumn("figure_no", F.count_if("opens_page").over(order))
    stays = F.col("host") | F.col("here")
    own = own.withColumns({
        "joined": F.when(stays, F.col("entry_no")).otherwise(F.col("next.entry_no")), "figure_page": F.when(F.col("alone"), F.col("page_number")),
        "spot": F.when(stays, F.col("at")).otherwise(F.coalesce("next.at", "at")), "tier": F.when(stays, 2).when(F.col("class") == "figure", 1).otherwise(0),
    }).where("joined is not null or alone")
    position = F.when(F.col("alone"), F.greatest(F.col("entry_no") - 1, F.lit(0)) + F.col("figure_no")).otherwise(F.col("entry_no") + F.col("figure_no"))
    shown = F.when(F.col("class") == "searchable", F.col("text")).when(F.col("class") == "table", F.nullif("markdown", F.lit("")))
    item = F.struct("spot", "tier", "at", "id", "page_number", position.alias("position"), (F.col("start") | F.col("opens_page")).alias("start"), F.when(F.col("head"), F.col("text")).alias("title"), shown.alias("shown"), F.col("class"))
    grouped = own.groupBy("document_id", "joined", "figure_page").agg(F.array_sort(F.collect_list(item)).alias("items"))
    first = F.element_at(F.filter("items", lambda i: i["start"]), 1)
    texts = F.filter(F.transform("items", lambda i: i["shown"]), lambda t: t.isNotNull())
    filled = F.array_position(F.transform(texts, lambda t: t != ""), True)
    return grouped.withColumn("first", first).select(
        "document_id", F.concat(F.col("document_id").cast("string"), F.lit("_"), F.col("first.id")).alias("entry_id"), F.col("first.position").cast("long").alias("position"), F.col("first.page_number").alias("page_number"),
        F.when(F.col("figure_page").isNotNull(), "figure").when(F.exists("items", lambda i: i["class"] == "table"), "table").otherwise("text").alias("kind"),
        F.coalesce("first.title", F.concat(F.lit("Page "), F.col("first.page_number").cast("string"))).alias("job_title"),
        F.when(filled > 0, F.array_join(F.slice(texts, filled.cast("int"), F.size(texts)), "\n\n")).otherwise("").alias("content"),
        F.size("items").cast("long").alias("n_blocks"), F.transform("items", lambda i: i["id"]).alias("block_ids"),
    )


def reading_order(boxes: DataFrame) -> DataFrame:
    """Rows of four points, then from the left; numbered from 1 on each page."""
    band = F.floor(F.col("y") / 4) * 4
    order = Window.partitionBy("document_id", "page_number").orderBy(band, "x", "seq")
    return boxes.withColumn("reading_order", F.row_number().over(order).cast("long"))


def document_order(blocks: DataFrame) -> DataFrame:
    """Headings, body, callouts, then captions and pictures; within each by column band, row and left edge."""
    tier = F.when(F.col("kind") == "heading", 0).when(F.col("kind") == "text", 2).when(F.col("kind") == "callout", 3).otherwise(4)
    order = Window.partitionBy("document_id", "page_number").orderBy(tier, "band", "y", "x", "seq")
    return blocks.withColumn("document_order", F.row_number().over(order).cast("long"))


def gutters(boxes: DataFrame) -> DataFrame:
    """The widest gap between merged x-intervals of a page's narrow boxes, if it parts two columns.

    The page is as wide as its boxes reach, 200 points or more. Six narrow boxes (up to 62 % of that), merged where less than
    1 % parts them; a gap of 12 points and 3 % at least, with three boxes on either side that stand beside each other.
    """
    page = ["document_id", "page_number"]
    whole = Window.partitionBy(*page)
    own = boxes.where("w > 0 and h > 0").withColumns({"width": F.max(F.col("x") + F.col("w")).over(whole) - F.min("x").over(whole), "all": F.count("*").over(whole)})
    narrow = own.where((F.col("all") >= 6) & (F.col("width") >= 200) & (F.col("w") <= F.col("width") * 0.62))
    order = whole.orderBy("x", "seq")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    bottom = F.col("y") + F.col("h")
    own = narrow.withColumns({
        "reach": F.max(F.col("x") + F.col("w")).over(before), "n": F.count("*").over(whole), "left": F.row_number().over(order) - 1,
        "beside": F.least(F.max(bottom).over(before), F.max(bottom).over(after)) - F.greatest(F.min("y").over(before), F.min("y").over(after)),
    })
    gap = F.col("x") - F.col("reach")
    gaps = own.where((F.col("n") >= 6) & (gap > F.col("width") * 0.01))
    best = gaps.groupBy(*page).agg(F.max(F.struct(gap.alias("gap"), (-F.col("x")).alias("neg"), "width", "left", "n", "beside")).alias("g"))
    fits = (F.col("g.gap") >= F.greatest(F.lit(12.0), F.col("g.width") * 0.03)) & (F.col("g.left") >= 3) & (F.col("g.n") - F.col("g.left") >= 3) & (F.col("g.beside") > 0)
    return best.where(fits).select(*page, F.col("g.gap").alias("gap"), (-F.col("g.neg") - F.col("g.gap") / 2.0).alias("gutter_x"))


def heading_context(blocks: DataFrame, level: str = "level") -> DataFrame:
    """Unit, section and subsection carried on from the last headings; a higher heading resets the lower ones. Where blocks
    have signal (heading_signal()) or contents (whether their page is a table of contents), headings count from a signal of 4 on,
    and none of contents does."""
    order = Window.partitionBy("document_id").orderBy("page_number", "reading_order", "id")
    counts = (F.col("signal") >= 4 if "signal" in blocks.columns else F.lit(True)) & (~F.col("contents") if "contents" in blocks.columns else F.lit(True))
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rank = {"unit": 1, "section": 2, "subsection": 3}
    place = F.row_number().over(order)
    own = blocks.withColumn("__at", place)
    last = {name: F.last(F.when((F.col(level) == name) & counts, F.struct("__at", "text")), ignorenulls=True).over(so_far) for name in rank}
    own = own.withColumns({f"__{n}": c for n, c in last.items()})
    unit_at = F.coalesce(F.col("__unit.__at"), F.lit(0))
    section_ok = F.col("__section.__at") > unit_at
    sub_ok = (F.col("__subsection.__at") > unit_at) & (F.col("__subsection.__at") > F.coalesce(F.col("__section.__at"), F.lit(0)))
    own = own.withColumns({"unit": F.col("__unit.text"), "section": F.when(section_ok, F.col("__section.text")), "subsection": F.when(sub_ok, F.col("__subsection.text"))})
    return own.withColumn("path", F.concat_ws(" / ", "unit", "section", "subsection")).drop("__at", *[f"__{n}" for n in rank])


def heading_signal(text: Column, role: Column, reading_order: Column, w: Column, h: Column, callout: Column) -> Column:
    """How much speaks for a heading: its role and form (4 each), a place among the first six (2), its size (1 each), less 5
    for the roles of visuals, and 6 for a callout."""
    named = F.lower(strip(text_or_empty(role)))
    visual = named.isin("caption", "table_note", "artifact", "figure_callout", "annotation", "ocr_annotation", "legend")
    score = F.when(named == "heading", 4).when(visual, -5).otherwise(0) + F.when(heading(text).isNotNull(), 4).otherwise(0)
    return score + F.when(reading_order.between(1, 6), 2).otherwise(0) + F.when(w >= 140, 1).otherwise(0) + F.when(h >= 20, 1).otherwise(0) - F.when(callout, 6).otherwise(0)


def numbered_splits(items: DataFrame) -> DataFrame:
    """An entry whose numbered blocks rise strictly (two at least) is split at each; others stay whole.

    items: entry_id, seq, number (null: a block without one). Adds part: 0 before the first number.
    """
    order = Window.partitionBy("entry_id").orderBy("seq")
    before = F.max("number").over(order.rowsBetween(Window.unboundedPreceding, -1))
    own = items.withColumn("__rises", F.col("number").isNull() | before.isNull() | (F.col("number") > before))
    whole = Window.partitionBy("entry_id")
    split = F.min("__rises").over(whole) & (F.count("number").over(whole) >= 2)
    return own.withColumn("part", F.when(split, F.count("number").over(order)).otherwise(0)).drop("__rises")


def coalesce_pages(own: DataFrame) -> DataFrame:
    """Entries of one page become one: texts in order of position, blocks added up."""
    item = F.array_sort(F.collect_list(F.struct("position", "content")))
    grouped = own.groupBy("document_id", "page_number").agg(F.min("position").alias("position"), F.sum("n_blocks").alias("n_blocks"), item.alias("items"))
    return grouped.select("document_id", "page_number", "position", "n_blocks", F.array_join(F.transform("items", lambda i: i["content"]), "\n").alias("content"))


def continuations(own: DataFrame) -> DataFrame:
    """An entry whose first number follows the last of the entry on the page before is merged into it; so is one whose
    prose goes on from the entry before, where own has first_text and last_text.

    own: document_id, page_number, position, first_number, last_number. Adds merged_into: the position of the chain's first.
    """
    order = Window.partitionBy("document_id").orderBy("page_number", "position")
    follows = (F.col("page_number") == F.lag("page_number").over(order) + 1) & (F.col("first_number") == F.lag("last_number").over(order) + 1)
    if {"first_text", "last_text"} <= set(own.columns):
        follows = F.coalesce(follows, F.lit(False)) | prose_continues(F.lag("last_text").over(order), F.col("first_text"), F.col("page_number"), F.lag("page_number").over(order))
    chain = F.sum((~F.coalesce(F.col("__follows"), F.lit(False))).cast("long")).over(order)
    own = own.withColumn("__follows", follows).withColumn("__chain", chain)
    return own.withColumn("merged_into", F.first("position").over(Window.partitionBy("document_id", "__chain").orderBy("page_number", "position"))).drop("__follows", "__chain")


def prose_continues(before: Column, first: Column, page: Column, page_before: Column) -> Column:
    """W08, the rule on prose: does an entry's first body text go on from the last of the entry before: that ends no sentence, and
    this stands on the next page at most and begins neither a list nor a caption."""
    own, last = strip(text_or_empty(first)), strip(text_or_empty(before))
    listed = compact(own).rlike("^[一二三四五六七八九十]+、") | own.rlike(r"^(图|表)\s*[0-9]")
    return (own != "") & (last != "") & (page <= page_before + 1) & ~listed & ~last.rlike("[。！？!?；;]$")


#: A character that no text has, as Unicode sets it aside for use within programs.
BREAK = "\uffff"


def soft_wrapped(lines: Column, sentence_end: str = r"[。！？!?；;：:.]$") -> Column:
    """Lines are joined to the line so far unless it ends a sentence or the next begins a list item.

    A joined line ends as its last part does, so each line is compared to the one before it alone.
    """
    clean = F.filter(F.transform(lines, strip), lambda x: x != "")

    def joined(own: Column) -> Column:
        broken = lambda before, line: before.rlike(sentence_end) | line.rlike(r"^([0-9]+[.、)）]|[-•·])")
        parts = F.transform(own, lambda line, i: F.when(i == 0, line).otherwise(F.concat(F.when(broken(F.get(own, i - 1), line), F.lit(BREAK)).otherwise(F.lit(" ")), line)))
        return F.when(F.size(own) > 0, F.split(F.array_join(parts, ""), BREAK)).otherwise(own)

    return let(clean, joined)


def marker_merges(blocks: DataFrame, marker: str = r"^([0-9]{1,3}[.)、]?|[-•·])$") -> DataFrame:
    """A block that is a list marker alone is put before the next block's text."""
    order = Window.partitionBy("document_id").orderBy("page_number", "reading_order")
    own = blocks.withColumns({"__marks": F.col("text").rlike(marker), "__next": F.lead("text").over(order)})
    own = own.withColumn("__lead", F.when(F.lag("__marks").over(order), F.lag("text").over(order)))
    text = F.when(F.col("__lead").isNotNull(), F.concat("__lead", F.lit(" "), "text")).otherwise(F.col("text"))
    return own.withColumn("text", text).where(~F.col("__marks") | F.col("__next").isNull()).drop("__marks", "__next", "__lead")


def inline_clauses(blocks: DataFrame, clause: str = r"(?<=\S)\s+(?=[0-9]{1,2}\.[0-9]{1,3}\s)") -> DataFrame:
    """A block with decimal clauses in its middle becomes one block a clause, numbered by part."""
    parts = F.posexplode(F.split("text", clause))
    return blocks.select(*[c for c in blocks.columns if c != "text"], parts.alias("part", "text")).withColumn("part", (F.col("part") + 1).cast("long"))


def rank_consistency(rows: DataFrame, group: str, item_order: str, entry_order: str) -> DataFrame:
    """1 - |relative rank as an item - relative rank as an entry|; 0 in groups of one."""
    n = F.count("*").over(Window.partitionBy(group))
    ranks = [F.percent_rank().over(Window.partitionBy(group).orderBy(c)) for c in (item_order, entry_order)]
    return rows.withColumn("order_score", F.when(n <= 1, 0.0).otherwise(F.greatest(F.lit(0.0), 1.0 - F.abs(ranks[0] - ranks[1]))))


def insertion_slots(items: DataFrame, group: str, order: str, slots: str) -> DataFrame:
    """Items spread evenly over a group's slots: floor(((rank + 1) * slots - 1) / total), within 0 and slots."""
    rank, total = F.row_number().over(Window.partitionBy(group).orderBy(order)), F.count("*").over(Window.partitionBy(group))
    return items.withColumn("slot", F.greatest(F.lit(0), F.least(F.col(slots), F.floor((rank * F.col(slots) - 1) / total))).cast("long"))


TEXT_TYPES = ("text", "p", "paragraph", "h1", "h2", "h3", "heading1", "heading2", "heading3", "quote", "blockquote", "code")


def inserted(blocks: DataFrame, items: DataFrame, mode: str = "after-page") -> DataFrame:
    """An entry's blocks with items put in: at the end (append), or behind a block of the item's page (after-page; of its texts
    alone, after-page-text), the one whose place fits the item's rank among `total`; at the end if the page has none.

    blocks: entry_id, seq, page_number, type, id. items: entry_id, id, page_number, rank (from 0), total. Rows entry_id, position,
    id. Items behind one block stand in order of rank.
    """
    if mode not in ("append", "after-page", "after-page-text"):
        raise ValueError(f"no such mode: {mode}")
    own = blocks.where(F.lower("type").isin(*TEXT_TYPES)) if mode == "after-page-text" else blocks
    page = Window.partitionBy("entry_id", "page_number")
    slots = own.select("entry_id", "page_number", "seq", (F.row_number().over(page.orderBy("seq")) - 1).alias("slot"), F.count("*").over(page).alias("slots"))
    anchors = slots.select("entry_id", "page_number", "slot", "slots", F.col("seq").alias("anchor"))
    if mode == "append":
        placed = items.withColumn("anchor", F.lit(None).cast("long"))
    else:
        sizes = anchors.groupBy("entry_id", "page_number").agg(F.first("slots").alias("slots"))
        mapped = F.greatest(F.lit(0), F.least(F.col("slots") - 1, F.floor(((F.col("rank") + 1) * F.col("slots") - 1) / F.greatest(F.lit(1), F.col("total")))))
        placed = items.join(sizes, ["entry_id", "page_number"], "left").withColumn("slot", mapped).drop("slots").join(anchors.drop("slots"), ["entry_id", "page_number", "slot"], "left")
    rows = blocks.select("entry_id", "id", F.col("seq").alias("anchor"), F.lit(0).alias("behind"), F.lit(0).alias("rank")).unionByName(placed.select("entry_id", "id", "anchor", F.lit(1).alias("behind"), "rank"))
    order = Window.partitionBy("entry_id").orderBy(F.asc_nulls_last("anchor"), "behind", "rank", "id")
    return rows.select("entry_id", F.row_number().over(order).alias("position"), "id")


def snapshots_first(images: DataFrame) -> DataFrame:
    """An entry's pictures by page, index, name; legends before tables before others. Adds rank and is_main."""
    family = F.when(F.col("kind") == "legend", 0).when(F.col("kind") == "table", 1).otherwise(2)
    order = Window.partitionBy("entry_id").orderBy(family, "page_number", "idx", "name")
    return images.withColumn("rank", F.row_number().over(order).cast("long")).withColumn("is_main", F.col("rank") == 1)


def next_indexes(rows: DataFrame, known: DataFrame) -> DataFrame:
    """New continuations of (entry, page) are numbered on from the largest index known."""
    top = known.groupBy("entry_id", "page_number").agg(F.max("idx").alias("top"))
    order = Window.partitionBy("entry_id", "page_number").orderBy("seq")
    return rows.join(top, ["entry_id", "page_number"], "left").withColumn("idx", F.coalesce("top", F.lit(0)) + F.row_number().over(order)).drop("top")


def search_text(blocks: DataFrame) -> DataFrame:
    """An entry's text for search: no visual roles, in reading order, equal segments once, those within the next one absorbed."""
    item = F.array_sort(F.collect_list(F.struct("page_number", "reading_order", strip(F.col("text")).alias("text"))))
    shown = blocks.where(~F.col("role").isin("figure", "image", "artifact") & (strip(F.col("text")) != ""))
    texts = F.array_distinct(F.transform("items", lambda i: i["text"]))
    absorbed = F.filter(texts, lambda t, i: ~F.coalesce(F.startswith(F.try_element_at(texts, (i + 2).cast("int")), t), F.lit(False)))
    return shown.groupBy("document_id").agg(item.alias("items")).select("document_id", F.array_join(absorbed, "\n").alias("search_text"))
