"""Captions, cleaning, kinds: SF06, SF11, SF23, SF36, SF42, SF44, SF46."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.roles import DRAWING_NAMES, DRAWING_WORDS, anchor, any_word, heading, heading_artifact, heading_noise, likely_title, plain_section, weak_heading
from quire.functions.text import CJK, FIGURE_LABEL, chars_of, compact, let, matches_of, squeeze, strip, text_or_empty
from quire.operators.segment import soft_wrapped

# Names of sites printed on pages, words of captions and of drawings.
SITE_NAMES = ("学兔兔", r"www\.bzfxw\.com", "标准分享网", "建设工程教育网", "建筑标准库", "工标网")
CAPTION_WORDS = (*DRAWING_NAMES, "明细表")
BODY_CUES = ("截止", "其中", "由于", "为保证", "通过", "沿线", "共有", "说明", "检查", "普速", "高铁", "当", "传统", "一般应用", "其特点", "特点是", "需要强调", "当电力", "系指")
CAPTION_SPLIT = r"([①②③④⑤⑥⑦⑧⑨⑩]\s*[一-鿿]|（[一二三四五六七八九十]+）\s*[一-鿿]|[一二三四五六七八九十]+\s*[、,，.．]\s*[一-鿿]|(?<![\d-])[0-9]{1,2}\.\s*[一-鿿]|第\s*[0-9一二三四五六七八九十百千〇零两]+\s*[篇章节])"
URL = r"(https?://\S+)|(www\.\S+\.\S+)"


def clean_text(c: Column) -> Column:
    """SF06: without site names and addresses; lines stripped, empty ones dropped, soft-wrapped ones joined."""
    own = F.regexp_replace(F.regexp_replace(text_or_empty(c), f"(?i){'|'.join(SITE_NAMES)}", ""), f"(?i){URL}", "")
    return F.array_join(soft_wrapped(F.split(own, "\n")), "\n")


def cluster_key(title: Column) -> Column:
    """SF11: a title without its last path part and without a label's end; the title itself if nothing is left."""
    own = strip(text_or_empty(title))
    parts = F.filter(F.transform(F.split(own, r"[/\\>|]+"), strip), lambda p: p != "")
    own = F.when(F.size(parts) >= 2, F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(1))), " / ")).otherwise(own)
    key = F.regexp_replace(compact(own), r"(图|表)[0-9一二三四五六七八九十零〇\-—_.．]+.*$", "")
    return F.when(key != "", key).otherwise(own)


def difflib_ratio(a: Column, b: Column) -> Column:
    """SF23: the ratio of matching blocks of two texts; sequential by definition, so an Arrow batch at a time in Python."""
    @F.pandas_udf("double")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([SequenceMatcher(None, s or "", t or "").ratio() for s, t in zip(x, y, strict=True)], dtype=float)

    return run(a, b)


def caption(c: Column) -> Column:
    """SF36: begins with a label of a figure or table, or names a kind of drawing."""
    own = compact(text_or_empty(c))
    return own.rlike(r"^[图表][0-9一二三四五六七八九十零〇\-—_.．]+") | own.rlike("|".join(CAPTION_WORDS)) & own.rlike("[图表]")


def callout(c: Column) -> Column:
    """SF36: short text of a drawing: a mark, a measure, few characters with digits; no heading, anchor, caption or sentence."""
    own = compact(text_or_empty(c))
    cjk, digits, symbols = chars_of(own, f"[{CJK}]"), chars_of(own, r"\p{Nd}"), chars_of(own, r"[A-Za-z()（）/\\_+=:;,%~〜×xX.-]")
    like = (
        own.rlike("^[（(]?[A-Za-z0-9一二三四五六七八九十]+[)）]?$") | own.rlike("[0-9]+(?:mm|MM|cm|CM|kv|kV|V|A|m)") | own.rlike("[×xX~〜－-]") & (cjk <= 10)
        | own.rlike("|".join(DRAWING_WORDS)) | (F.length(own) <= 12) & (cjk <= 10) & ((digits > 0) | (symbols >= 2))
    )
    return F.length(own).between(1, 24) & heading(c).isNull() & anchor(c).isNull() & ~caption(c) & ~own.rlike("[。；;！？!?：:]") & like


def caption_fragment(c: Column, previous: Column) -> Column:
    """SF36: a short title that goes on from the caption (or the bare label) before it."""
    own, before = compact(text_or_empty(c)), text_or_empty(previous)
    after = compact(before).rlike(r"^[图表]\s*[0-9一二三四五六七八九十零〇\-—_.．]+$") | caption(before)
    fits = F.length(own).between(2, 24) & ~own.rlike(r"[。；;！？!?：:，,（）()\[\]【】]") & ~own.rlike("[第章节条]")
    return (compact(before) != "") & fits & after & heading(c).isNull() & anchor(c).isNull() & likely_title(c, 24)


def styled_heading(c: Column, most: int = 32) -> Column:
    """SF35: could a text that is set as a heading be one."""
    return (strip(text_or_empty(c)) != "") & ~caption(c) & ~callout(c) & ~heading_artifact(c) & (heading(c).isNotNull() | plain_section(c) | likely_title(c, most))


def document_role(c: Column) -> Column:
    """SF37: the role of a paragraph of a text document; the first rule that fits decides."""
    own = compact(text_or_empty(c))
    return (
        F.when(own == "", "artifact").when(caption(c), "caption").when(callout(c), "figure_callout").when(any_word(own, ("明细表", "附注", "注：", "注:")), "table_note")
        .when(heading(c)["level"].isin("chapter", "section", "subsection"), "heading").when(heading_noise(c) | heading_artifact(c), "artifact")
        .when(weak_heading(c) & (F.length(own) <= 24), "artifact").otherwise("body")
    )


def caption_candidate(c: Column, kind: str = "figure") -> Column:
    """SF42: label and title of a figure's (or table's) caption: the label within the first five characters, the title up to a
    cue of prose or a mark of a list; a short text without sentence marks is taken whole; else the label alone."""
    own = strip(squeeze(text_or_empty(c)))
    pattern = FIGURE_LABEL if kind == "figure" else FIGURE_LABEL.replace("附图|图", "附表|表")
    found = rf"(?U)^.{{0,4}}?({pattern})(.*)$"
    label, tail = compact(F.regexp_extract(own, found, 1)), strip(F.regexp_extract(own, found, 2))

    def cut(v: Column) -> Column:
        places = [F.instr(v["tail"], F.lit(cue)) for cue in BODY_CUES] + [F.when(matches_mark(v["tail"]), F.length(F.regexp_extract(v["tail"], rf"(?Us)^(.*?){CAPTION_SPLIT}", 1)) + 1).otherwise(0)]
        first = F.array_min(F.filter(F.array(*[p.cast("int") for p in places]), lambda p: p > 1))
        title = F.btrim(F.substring(v["tail"], F.lit(1), first - 1), F.lit(" ，,；;：:"))
        short = (F.length(compact(v["own"])) <= 36) & ~v["own"].rlike("[。；;！？!?]")
        whole = F.when(short, v["own"]).otherwise(v["label"])
        return F.when(v["label"] == "", "").when(v["tail"] == "", v["label"]).when(first.isNotNull(), strip(F.concat_ws(" ", v["label"], F.nullif(title, F.lit(""))))).otherwise(whole)

    return let(F.struct(own.alias("own"), label.alias("label"), tail.alias("tail")), cut)


def matches_mark(c: Column) -> Column:
    return c.rlike(f"(?U){CAPTION_SPLIT}")


def table_of_contents(c: Column) -> Column:
    """SF44: named so, or headings and page numbers without sentences, or dotted leaders to page numbers."""
    own = strip(text_or_empty(c))
    marks, numbers = matches_of(own, r"第\s*[0-9一二三四五六七八九十百零〇]+\s*[章节条]"), matches_of(own, "(?<![0-9])[0-9]{1,4}(?![0-9])")
    leaders, ends = matches_of(own, "[.．…·]{4,}"), matches_of(own, r"(?m)[.．…]{4,}\s*[0-9]{1,4}\s*$")
    return compact(own).rlike("目录|目次") | (marks >= 4) & (numbers >= 4) & ~own.rlike("[。；;！？!?]") | (leaders >= 2) & (marks >= 3) & (ends >= 2)


def entry_kind(block_types: Column, content: Column) -> Column:
    """SF46: table, image or text, from the types of an entry's blocks."""
    own = F.transform(block_types, lambda t: F.lower(text_or_empty(t)))
    visual = F.arrays_overlap(own, F.array(*map(F.lit, ("figure", "equation", "image"))))
    return F.when(F.array_contains(own, "table"), "table").when(visual & (strip(text_or_empty(content)) == ""), "image").otherwise("text")


def content_type(kind: Column) -> Column:
    own = F.lower(strip(text_or_empty(kind)))
    return F.when(own == "table", "table").when(own.isin("image", "figure", "equation"), "figure").otherwise("narrative")


def visual_kind(block_type: Column) -> Column:
    """SF46: the manifest's kind of a block: table, legend (figures, equations, pictures), or null."""
    own = F.lower(strip(text_or_empty(block_type)))
    return F.when(own == "table", "table").when(own.isin("figure", "equation", "image"), "legend")


def generic_caption(c: Column) -> Column:
    """SF46: a caption that says no more than what it stands at, or nothing."""
    own = F.lower(strip(text_or_empty(c)))
    return (own == "") | own.rlike(r"^(table|figure|equation)\s*\d+$") | own.isin("table", "figure", "equation", "image")


def chapter_opener(lines: Column) -> Column:
    """SF44: a page of up to four lines and 80 characters that are headings, one at least, or page numbers."""
    own = F.filter(F.transform(lines, lambda x: strip(text_or_empty(x))), lambda x: x != "")
    number = lambda x: compact(x).rlike(r"^\d{1,4}$")
    named = lambda x: heading(compact(x)).isNotNull() | heading(x).isNotNull()
    return (F.size(own) > 0) & (F.size(own) <= 4) & F.forall(own, lambda x: number(x) | named(x)) & F.exists(own, lambda x: ~number(x)) & (F.length(compact(F.array_join(own, ""))) <= 80)
