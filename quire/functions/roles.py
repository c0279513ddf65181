"""Roles of blocks: projection classes, headings, anchors, page markers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.geometry import Box
from quire.functions.text import CJK, chars_of, compact, normal_form, numeral, strip, text_or_empty

# Roles by projection class; patterns and words of headings, anchors, captions, callouts and page markers.
SUPPORTING_ROLES = ("figure_callout", "legend", "annotation", "ocr_annotation")
EXCLUDED_ROLES = ("artifact",)
CHAPTER = r"^第\s*([0-9一二三四五六七八九十百千〇零两]+)\s*章(?:\s+|[：:])?(.*)$"
SECTION = r"^第\s*([0-9一二三四五六七八九十百千〇零两]+)\s*节(?:\s+|[：:])?(.*)$"
SUBSECTION = r"^([一二三四五六七八九十百千]+)\s*[、,，.]\s*(.+)$"
CLAUSE = r"^([0-9]{1,2}(?:\.[0-9]{1,3}){2,})(?:[、，,．.]?\s*(.*))?$"
NUMBERED_SECTION = r"^([0-9]{1,2}(?:\.[0-9]{1,3}){1})(?:[、，,．.]\s*|\s+)?([^\s0-9）\)].+)$"
NUMBERED_CHAPTER = r"^([0-9]{1,2})(?![）\)])(?:[、，,．.]\s*|\s+)?([^\s0-9）\)].+)$"
ARTICLE = r"^第\s*([0-9一二三四五六七八九十百千〇零两]+)\s*条\b(.*)$"
APPENDIX = r"^(附录|附件)\s*([0-9一二三四五六七八九十百千〇零两]+)\b[：:]?(.*)$"
APPENDIX_TABLE = r"^附表\s*([0-9一二三四五六七八九十百千〇零两]+)\b[：:]?(.*)$"
TITLE_ENDS = r"(规则|规程|办法|条例|标准|规范|导则|细则|总则|规定|制度|职责|预案|方案)$"
TITLES = ("总则", "目录", "附录", "前言", "引言", "范围")
CAPTION_START = r"^(图|表)\s*[0-9一二三四五六七八九十零〇\-—_.．]+"
CAPTION_PROSE = r"(如图所示|一般应用|其特点|特点是|传统的|需要强调|当电力|系指)"
DRAWING_NAMES = ("示例图", "示意图", "安装图", "布置图", "接线图")
DRAWING_WORDS = ("中心线", "尺寸", "推荐", "最小布置", "侧视图", "平面图", "屏前通道")
CHAPTER_START = r"^第[一二三四五六七八九十百零〇0-9]+[章节]"
LISTED_START = r"^[一二三四五六七八九十]+、"
ARTICLE_ALONE = r"^(?:第?[一二三四五六七八九十百零〇0-9]*)?条[）)]?$"
ARTICLE_END = r"第[一二三四五六七八九十百零〇0-9]+条[）)]?$"
FIGURE_LEGEND_ONLY = r"^(?:不接地系统\s*){1,2}(?:经消弧线圈接地系统|经小电阻接地系统|直接接地系统)\s*$"
CABLE_LEGEND_ONLY = r"^(?:单端接地|双端接地)(?:\s+(?:单端接地|双端接地))*\s*$"
BODY_AFTER_NUMBER = r"^\d{1,2}(用于|使用|应|必须|须|要|可|的|在|是|有|包括|按照|根据|遇|当|对|由|为|和|与|或|不|未|已)"
MARK_DOTTED, MARK_DASHED, MARK_PAGE_CN, MARK_PAGE, MARK_OF = r"[·•∙⋅・]\d{1,4}[·•∙⋅・]", r"[-—–_]+\d{1,4}[-—–_]+", r"第\s*\d{1,4}\s*页", r"^(?:p\.|page)\s*\d{1,4}$", r"\d{1,4}/\d{1,4}"
LOOSE_DASHED, LOOSE_PAGE, LOOSE_OF = r"[-—–_]*\d{1,4}[-—–_]*", r"(?:Page|第)?\d{1,4}(?:页|/\d{1,4})?", r"^(?:Page|第)\s*\d+\s*(?:of|/|页)\s*\d*$"
NOISE_EXACT = ("3m0", "h500", "1.7mo", "1.7m0")
NOISE_PATTERNS = (r"^[hH]\s*/?\s*\d{2,4}$", r"(?i)^\d+(?:\.\d+)?\s*m\s*[o0]$")
ARTIFACT_PATTERNS = (r"(?i)^零件\s*[0-9A-Za-z一二三四五六七八九十]+$", r"^[0-9一二三四五六七八九十]+\s*[（(]\s*[0-9Oo口]{2,}\s*[）)]")


def matches(c: Column, pattern: str, whole: bool = False) -> Column:
    """A pattern with the meaning that it has for Unicode texts: digits, white space and word borders of all scripts."""
    return c.rlike(f"(?U)^(?:{pattern})$" if whole else f"(?U){pattern}")


def projection_class(role: Column) -> Column:
    """searchable, supporting or excluded; unknown roles are searchable."""
    role = F.lower(strip(text_or_empty(role)))
    return F.when(role.isin(*SUPPORTING_ROLES), "supporting").when(role.isin(*EXCLUDED_ROLES), "excluded").otherwise("searchable")


def plausible_title(title: Column, most: int = 36) -> Column:
    own = compact(text_or_empty(title))
    return F.length(own).between(1, most) & ~own.rlike(r"^[\p{P}\p{S}]") & ~own.rlike(r"[/\\]|[0-9]\s*[×xX]\s*[0-9]") & ~own.rlike("[。；;！？!?]")


def heading(c: Column) -> Column:
    """Struct of level, number (as an int if it can be) and title of a structured heading; null if it is none. First rule wins."""
    own = strip(text_or_empty(c))
    out = F.lit(None).cast("struct<level:string,number:string,value:int,title:string>")
    rules = [("chapter", NUMBERED_CHAPTER, True), ("section", NUMBERED_SECTION, True), ("clause", CLAUSE, False), ("subsection", SUBSECTION, True), ("section", SECTION, True), ("chapter", CHAPTER, False)]
    for level, pattern, titled in rules:  # the last one tested first
        number, title = F.regexp_extract(own, pattern, 1), strip(F.regexp_extract(own, pattern, 2))
        test = own.rlike(pattern) & (plausible_title(title) if titled else F.lit(True))
        out = F.when(test, F.struct(F.lit(level).alias("level"), number.alias("number"), numeral(number).alias("value"), title.alias("title"))).otherwise(out)
    return out


def anchor(c: Column) -> Column:
    """article, appendix_table or appendix with its number; null if the text begins with none. A word border ends the number."""
    own = strip(text_or_empty(c))
    out = F.lit(None).cast("struct<kind:string,value:int,rest:string>")
    for kind, pattern, at in (("appendix", APPENDIX, 2), ("appendix_table", APPENDIX_TABLE, 1), ("article", ARTICLE, 1)):
        number, rest = F.regexp_extract(own, f"(?U){pattern}", at), strip(F.regexp_extract(own, f"(?U){pattern}", at + 1))
        out = F.when(matches(own, pattern), F.struct(F.lit(kind).alias("kind"), numeral(number).alias("value"), rest.alias("rest"))).otherwise(out)
    return out


def page_marker(c: Column, box: Box, page_h: Column) -> Column:
    """SF38: decorated page numbers anywhere; bare digits in the top 12 % or the bottom 15 % of the page only."""
    own = compact(text_or_empty(c))
    middle = box.y + box.h / 2.0
    decorated = matches(own, MARK_DOTTED, True) | matches(own, MARK_DASHED, True) | matches(own, MARK_PAGE_CN, True) | matches(own, f"(?i){MARK_PAGE}") | matches(own, MARK_OF, True)
    bare = matches(own, r"\d{1,4}", True) & ((middle <= page_h * 0.12) | (middle >= page_h * 0.85))
    return F.length(own).between(1, 24) & (page_h > 0) & F.coalesce(decorated | bare, F.lit(False))


def loose_page_marker(c: Column) -> Column:
    """SF38, without a place: page numbers by their looks; one or two bare digits are none, as they may be list marks."""
    raw = strip(text_or_empty(c))
    own = compact(raw)
    dashed = matches(own, LOOSE_DASHED, True)
    return F.when(own == "", False).when(matches(own, MARK_DOTTED, True), True).when(dashed, ~matches(own, r"\d{1,2}", True)).otherwise(matches(own, f"(?i){LOOSE_PAGE}", True) | matches(raw, f"(?i){LOOSE_OF}"))


def numbered_heading(c: Column) -> Column:
    """SF39: 5.1一般规定 or 5变、配电所: a number right before a short title without sentence marks; no body that begins with a verb."""
    own = compact(text_or_empty(c))
    single = matches(own, rf"^\d{{1,2}}[{CJK}]") & ~matches(own, BODY_AFTER_NUMBER)
    return F.length(own).between(1, 24) & ~own.rlike("[。；;！？!?：:]|如图|如表") & (matches(own, rf"^\d{{1,2}}\.\d{{1,2}}[{CJK}]") | single)


def numbered_body(c: Column) -> Column:
    """SF39: 2用于变电所: a number right before a text that is no heading."""
    return ~numbered_heading(c) & attached_number(compact(text_or_empty(c)))


def attached_number(c: Column) -> Column:
    return matches(strip(text_or_empty(c)), rf"^\d{{1,2}}[{CJK}]")


def list_item(c: Column) -> Column:
    return matches(strip(text_or_empty(c)), r"^\s*[（(]?\d+[）)]|^\s*•|^\s*\d+\.\s")


def prose_continuation(c: Column) -> Column:
    """SF39: up to 36 characters, six of them Chinese, without letters, digits and symbols."""
    own = compact(text_or_empty(c))
    no = loose_page_marker(c) | matches(own, f"(?i){CAPTION_START}") | own.rlike(FIGURE_LEGEND_ONLY) | own.rlike(CABLE_LEGEND_ONLY)
    return F.length(own).between(1, 36) & ~no & (chars_of(own, f"[{CJK}]") >= 6) & ~own.rlike(r"[A-Za-z0-9()（）/\\_+=:;,%~〜×xX.-]")


def display_heading(c: Column, box: Box, page_h: Column, font_size: Column, bold: Column) -> Column:
    """SF39: a short title without a number in the upper half of a page, large or bold, that ends as titles do."""
    text = strip(text_or_empty(c))
    own = compact(text)
    titled = own.rlike(TITLE_ENDS)
    no = (
        matches(own, f"(?i){CAPTION_START}") | matches(own, r"\d{1,4}", True) | matches(own, rf"^\d{{1,2}}[{CJK}]") & ~titled
        | matches(text, r"^\s*[（(]?\d+[）)]") | matches(text, r"^\s*[•·]") | own.rlike("[。；;！？!?]") | numbered_heading(own)
    )
    shown = (F.coalesce(font_size, F.lit(0.0)) >= 14.0) | F.coalesce(bold, F.lit(False))
    return F.length(own).between(1, 24) & ~no & (page_h > 0) & (box.y + box.h / 2.0 <= page_h * 0.5) & shown & (titled | own.isin(*TITLES))


def any_word(c: Column, words: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(c, F.lit(w))
    return out


def page_callout(c: Column, line_count: Column, avg_line_len: Column, width: Column) -> Column:
    """SF36, on a page: page numbers and short texts of drawings, by their characters, lines and width."""
    own = compact(text_or_empty(c))
    cjk, symbols = chars_of(own, f"[{CJK}]"), chars_of(own, r"[A-Za-z0-9()（）/\\_+=:;,%~〜×xX.-]")
    no = matches(own, f"(?i){CAPTION_START}") | own.rlike(CHAPTER_START) | own.rlike(ARTICLE_ALONE) | own.rlike(ARTICLE_END) | own.rlike(LISTED_START)
    like = (
        own.rlike("^[（(]?[A-Za-z0-9一二三四五六七八九十]+[)）]?$") | matches(own, r"\d+(?:mm|MM|cm|CM|kv|kV|V|A|m)") | any_word(own, DRAWING_WORDS) | own.rlike("[×xX~〜－-]") & (F.length(own) <= 18)
        | (line_count <= 2) & (avg_line_len <= 10.0) & (cjk <= 10) & (symbols >= 1) | (width > 0) & (width <= 240) & (F.length(own) <= 14) & (cjk <= 10)
    )
    sentence = own.rlike("[。；;！？!?：:]") | (cjk >= 4) & own.rlike("[》）)]$")
    return F.when(own == "", False).when(loose_page_marker(c), True).when((F.length(own) > 24) | no, False).when(own.rlike(FIGURE_LEGEND_ONLY) | own.rlike(CABLE_LEGEND_ONLY), True).otherwise(~sentence & F.coalesce(like, F.lit(False)))


def page_role(c: Column, line_count: Column, avg_line_len: Column, width: Column, bold: Column, display: Column | None = None) -> Column:
    """SF37: the role of a text block of a page; the first rule that fits decides. display: whether it is a display_heading(), where
    the page is known; without it the older rules decide alone."""
    own = compact(text_or_empty(c))
    cjk, bold = chars_of(own, f"[{CJK}]"), F.coalesce(bold, F.lit(False))
    callout = page_callout(c, line_count, avg_line_len, width)
    heavy = bold & (F.length(own) <= 32) & ~own.rlike("[。；;！？!?]") & ~matches(own, r"^\d+\s*$") & ~callout
    coded = own.rlike("[A-Za-z0-9]") & (cjk == 0) | own.rlike(r"^[A-Za-z0-9./\\_+=:;,%()\[\]×x-]+$") & (cjk < 2)
    return (
        F.when(own == "", "artifact")
        .when(matches(own, f"(?i){CAPTION_START}"), F.when((F.length(own) >= 48) & own.rlike(CAPTION_PROSE), "body").otherwise("caption"))
        .when(any_word(own, DRAWING_NAMES), "caption")
        .when(numbered_heading(own), "heading")
        .when(numbered_body(own), "body")
        .when(list_item(c), "body")
        .when(F.lit(False) if display is None else F.coalesce(display, F.lit(False)), "heading")
        .when(prose_continuation(c), "body")
        .when(callout, "figure_callout")
        .when(F.contains(own, F.lit("明细表")) | own.isin("附注", "注", "注：", "注:"), "table_note")
        .when(own.rlike(CHAPTER_START) | own.rlike(LISTED_START) | heavy, "heading")
        .when(coded, "artifact")
        .otherwise("body")
    )


def heading_noise(c: Column) -> Column:
    """SF35: misread marks of drawings that look like headings."""
    raw = normal_form(strip(text_or_empty(c)), True)
    key = F.regexp_replace(compact(F.lower(raw)), r"[_/\\-]+", "")
    return (key != "") & (key.isin(*NOISE_EXACT) | matches(raw, NOISE_PATTERNS[0]) | matches(raw, NOISE_PATTERNS[1]))


def heading_artifact(c: Column) -> Column:
    """SF35: names of parts, measures and number groups that stand for no section."""
    own = compact(normal_form(strip(text_or_empty(c)), True))
    digits, cjk, latin = chars_of(own, r"\p{Nd}"), chars_of(own, f"[{CJK}]"), chars_of(own, "[A-Za-z]")
    measures = (digits >= 3) & (cjk <= 1) & own.rlike(r"[~〜\-—()（）_/\\]") | (digits >= 2) & (latin == 0) & (cjk <= 1) & own.rlike(r"^[0-9Oo口~〜\-—()（）_/\\.]+$")
    part = F.startswith(own, F.lit("零件")) & (F.length(own) <= 8)
    layout = F.contains(own, F.lit("布置尺寸")) & own.rlike("^[0-9一二三四五六七八九十（(]")
    return (own != "") & (matches(own, ARTIFACT_PATTERNS[0]) | matches(own, ARTIFACT_PATTERNS[1]) | part | layout | measures)


def weak_heading(c: Column) -> Column:
    """SF35: a text that recognition may have made up: noise, short codes, letters with digits, or suspicious."""
    from quire.functions.text import suspicion

    raw = normal_form(strip(text_or_empty(c)), True)
    own, report = compact(raw), suspicion(raw)
    cjk = chars_of(own, f"[{CJK}]")
    code = own.rlike(r"^[A-Za-z0-9./\\_+=:;,%()\[\]×x-]+$") & (cjk < 2) & (report["compact_length"] <= 20)
    odd = (report["score"] >= 2.5) & (report["compact_length"] <= 20) & (cjk < 3)
    return (own == "") | heading_noise(raw) | heading_artifact(raw) | code | (cjk == 0) & own.rlike("[A-Za-z]") & own.rlike(r"\p{Nd}") | odd


def likely_title(c: Column, most: int = 36) -> Column:
    """SF35: could a text be a heading's title."""
    own = compact(text_or_empty(c))
    cjk = chars_of(own, f"[{CJK}]")
    no = own.rlike(r"^[-—,.，;；:：]") | own.rlike(r"[/\\=|~]") | matches(own, r"\d\s*[xX×]\s*\d") | own.rlike("[A-Za-z]{3,}|[A-Za-z]{2,}[0-9]|[0-9][A-Za-z]{2,}") & (cjk < 2) | own.rlike("[。；;！？!?：:]")
    return F.length(own).between(1, most) & ~no & ~heading_artifact(c) & ~weak_heading(c)


def plain_section(c: Column) -> Column:
    """SF35: a short heading without a number, that is no caption and no list."""
    own = compact(text_or_empty(c))
    cjk = chars_of(own, f"[{CJK}]")
    no = own.rlike(r"[/\\=|~]") | matches(own, r"\d\s*[xX×]\s*\d") | own.rlike("[A-Za-z]{3,}|[A-Za-z]{2,}[0-9]|[0-9][A-Za-z]{2,}") & (cjk < 2) | own.rlike("^[0-9.．]") | own.rlike(r"^[图表][0-9一二三四五六七八九十零〇\-—_.．]+")
    no = no | any_word(own, (*DRAWING_NAMES, "明细表")) | own.rlike(r"[：:。；;，,（）()\[\]【】]")
    return F.length(own).between(2, 24) & (cjk > 0) & ~no & ~heading_artifact(c) & ~weak_heading(c)


def figure_exclusion(x0: Column, y0: Column, x1: Column, y1: Column, page_w: Column, page_h: Column, pixel_w: Column, pixel_h: Column, matched: Column) -> Column:
    """Why an embedded picture is no figure; null if it may be one."""
    w, h = F.greatest(F.lit(0.0), x1 - x0), F.greatest(F.lit(0.0), y1 - y0)
    share, edge = w * h / (page_w * page_h), page_h * 0.08
    return (
        F.when((page_w <= 0) | (page_h <= 0), "invalid_page_size")
        .when((pixel_w <= 0) | (pixel_h <= 0), "invalid_pixel_size")
        .when(((pixel_w < 8) | (pixel_h < 8)) & ~matched, "tiny_decoration")
        .when((w <= 0) | (h <= 0), "empty_bbox")
        .when((share >= 0.9) & ~matched, "full_page_background")
        .when((w * h < 120) & ~matched, "tiny_decoration")
        .when(((y1 <= edge) | (y0 >= page_h - edge)) & ~matched & (share < 0.05), "edge_icon")
    )
