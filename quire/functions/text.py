"""Text expressions: normalisation, labels, similarity, suspicion. All run in the JVM."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters, words and patterns that decide results.
CN_DIGITS = {"零": 0, "〇": 0, "一": 1, "二": 2, "两": 2, "三": 3, "四": 4, "五": 5, "六": 6, "七": 7, "八": 8, "九": 9}
CN_UNITS = {"十": 10, "百": 100, "千": 1000}
GENERIC_TOKENS = ("检查", "要求", "内容", "项目", "备注", "规定", "单位", "名称", "标准", "周期", "范围", "应当", "必须", "可以", "进行", "作业", "设备", "附件", "附表", "表格", "图例")
LABEL = r"(?:附图|附表|图|表)\s*[0-9一二三四五六七八九十零〇O口]+(?:\s*[-—~〜\.．]\s*[0-9一二三四五六七八九十零〇O口]+)*"
FIGURE_LABEL = r"(?:附图|图)\s*[0-9一二三四五六七八九十零〇O口]+(?:\s*[-—~〜\.．]\s*[0-9一二三四五六七八九十零〇O口]+)*"
FIRST_MARK = r"附件|附表|表|图|第\s*[0-9一二三四五六七八九十百千]+\s*条"
LEADING_LABELS = (r"^(?:附件|附表|表|图)\s*[0-9一二三四五六七八九十百千]+(?:[-._][0-9]+)?\s*", r"^第\s*[0-9一二三四五六七八九十百千]+\s*条\s*", r"^[：:、.\-]+\s*")
ALLOWED_PUNCTUATION = "，。；：？！、,.:;!?%（）()[]【】<>《》“”‘’+-—_/\\|=~*&@#·…'\""
SUSPICIOUS = "�□■▢◻◼◾◽¦¤§"
CJK = "一-鿿"
#: White space, as the inside of a regex class. Single Latin characters are one table look-up there, and one range keeps most
#: others from being compared to what follows it.
LATIN_WHITE, OTHER_WHITE = r"\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x20\x85\xa0", r"\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WHITE = rf"{LATIN_WHITE}[\u1680-\u3000&&[{OTHER_WHITE}]]"
WHITE_CHARS = "".join(map(chr, [*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def in_class(chars: str) -> str:
    """The characters as the inside of a regex class."""
    return "".join("\\" + c if c in "\\[]^-&" else c for c in chars)


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITE_CHARS))


def squeeze(c: Column) -> Column:
    return F.regexp_replace(c, f"[{WHITE}]+", " ")


def compact(c: Column) -> Column:
    return F.regexp_replace(c, f"[{WHITE}]+", "")


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def matches_of(c: Column, pattern: str) -> Column:
    """How often a pattern occurs."""
    return F.regexp_count(c, F.lit(pattern))


def chars_of(c: Column, chars: str) -> Column:
    """How many characters are of a class, given as a regex of one character."""
    return F.length(c) - F.length(F.regexp_replace(c, f"{chars}+", ""))


def normal_form(c: Column, compatible: bool = False) -> Column:
    """Unicode's composed form (NFC, or NFKC if compatible), by the library that Spark's collations use.

    Only texts with characters that it may change are handed over. Reflection makes the expression one that Spark won't
    move, so it can't stand in a join's condition or an aggregate.
    """
    own = text_or_empty(c)
    made = F.java_method(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), own, F.lit(compatible))
    return F.when(own.rlike(r"[^\x00-\x9f]" if compatible else r"[^\x00-\u02ff]"), made).otherwise(own)


def search_normal(c: Column) -> Column:
    """Composed letters, digits and line breaks stay, all else is a space; spaces are squeezed and dropped around line breaks."""
    c = F.regexp_replace(normal_form(c), r"[^a-zA-Z0-9\n\p{L}\p{N}]+", " ")
    return strip(F.regexp_replace(c, r" *\n *", "\n"))


def single_line(c: Column) -> Column:
    return strip(squeeze(search_normal(c)))


def anchor_key(c: Column, strict_labels: bool = False) -> Column:
    """Key of a label. Punctuation goes first, so 图1-1, 图1.1 and 图11 share a key, unless strict_labels keeps one dash."""
    if strict_labels:
        c = F.regexp_replace(text_or_empty(c), r"(?U)\s*[-—－.．~～〜]\s*", "-")
        return F.regexp_replace(c, r"[^\p{L}\p{N}-]", "")
    return compact(single_line(c))


def fingerprint(c: Column) -> Column:
    """What is left of a title for matching: cut to its first mark, without leading labels and white space."""
    c = let(single_line(c), lambda t: F.when(t.rlike(FIRST_MARK), strip(F.regexp_extract(t, f"((?:{FIRST_MARK}).*)$", 1))).otherwise(t))
    for _ in range(3):  # a round that changes nothing is the same as none
        c = reduce(lambda x, p: F.regexp_replace(x, p, ""), LEADING_LABELS, strip(c))
    return compact(c)


#: What parts the characters of a printed watermark, as the inside of a regex class.
WATERMARK_GAP = rf"{LATIN_WHITE}\-_~·,.:;|/\\()[\u1680-\uff1b&&[{OTHER_WHITE}—–〜•，。：；（）]]"


def watermark_compact(c: Column) -> Column:
    return F.regexp_replace(text_or_empty(c), f"[{WATERMARK_GAP}]+", "")


def watermark_plausible(c: Column) -> Column:
    """Could a line be a printed page watermark: 5 to 24 characters, three digits at least, a letter, not a heading."""
    heading = r"(?i)^(图|表)\s*[0-9一二三四五六七八九十零〇\-—_.．]+|^第[一二三四五六七八九十百零〇0-9]+[章节]|^[一二三四五六七八九十]+、"

    def judged(own: Column) -> Column:
        cjk = chars_of(own, f"[{CJK}]")
        fits = F.length(own).between(5, 24) & (chars_of(own, r"\p{Nd}") >= 3) & (chars_of(own, "[A-Za-z]") + cjk >= 1) & (cjk <= 10)
        return fits & ~own.rlike(heading) & ~text_or_empty(c).rlike("[。！？!?；;]")

    return let(watermark_compact(c), judged)


def watermark_like(c: Column, known: Column) -> Column:
    """SF07: is a line, of watermark_compact()'s form, one of a document's watermarks, a part of one, or one with a little more."""
    digits = lambda x: F.regexp_replace(x, r"[^\p{Nd}]+", "")
    lettered, word = c.rlike(f"[{CJK}A-Za-z]"), c.rlike(f"^[{CJK}A-Za-z]+$")

    def same(k: Column) -> Column:
        part = F.contains(k, c) & (F.length(c) >= F.greatest(F.lit(5), F.floor(F.length(k) * 0.45)))
        begins = word & F.startswith(k, c) & (F.length(c) >= 3)
        more = F.contains(c, k) & (F.length(k) >= 5) & (F.length(c) - F.length(k) <= 2)
        number = (F.length(digits(c)) >= 3) & F.contains(digits(k), digits(c)) & (F.length(c) <= 8) & lettered
        return (c == k) | part | begins | more | number

    return F.exists(known, same)


def levenshtein_similarity(a: Column, b: Column, cutoff: float = 0.0) -> Column:
    """1 - distance / longer length; 0 if a text is empty or the distance is over the cutoff's bound."""

    def ratio(v: Column) -> Column:
        longer = F.greatest(F.length(v["a"]), F.length(v["b"]))
        bound = F.floor(longer * (1.0 - cutoff)).cast("int") + 1
        # the distance is the length difference at least, so most pairs of a short and a long text need none
        hopeless = (v["a"] == "") | (v["b"] == "") | (F.abs(F.length(v["a"]) - F.length(v["b"])) > bound)
        return F.when(hopeless, 0.0).otherwise(let(F.levenshtein(v["a"], v["b"]), lambda d: F.when(d > bound, 0.0).otherwise(1.0 - d / longer)))

    return let(F.struct(text_or_empty(a).alias("a"), text_or_empty(b).alias("b")), ratio)


def semantic_similarity(a: Column, b: Column, cutoff: float = 0.0) -> Column:
    marks = levenshtein_similarity(fingerprint(a), fingerprint(b), cutoff)
    lines = F.struct(marks.alias("marks"), single_line(a).alias("a"), single_line(b).alias("b"))
    return let(lines, lambda v: F.when(v["marks"] > 0, v["marks"]).otherwise(levenshtein_similarity(v["a"], v["b"], cutoff)))


def match_tokens(c: Column) -> Column:
    """Words of two characters or more that are no generic terms."""
    return F.filter(F.split(single_line(c), " "), lambda t: (F.length(t) >= 2) & ~t.isin(*GENERIC_TOKENS))


def numeral(c: Column) -> Column:
    """Arabic or Chinese numeral as an int; null if it is neither."""
    own = strip(text_or_empty(c))
    digits = F.create_map(*[F.lit(x) for kv in CN_DIGITS.items() for x in kv])
    units = F.create_map(*[F.lit(x) for kv in CN_UNITS.items() for x in kv])
    zero = F.struct(F.lit(0).alias("total"), F.lit(0).alias("num"))

    def step(acc: Column, ch: Column) -> Column:
        digit, unit = F.element_at(digits, ch), F.element_at(units, ch)
        grown = acc["total"] + F.when(acc["num"] == 0, 1).otherwise(acc["num"]) * unit
        return F.struct(F.when(unit.isNotNull(), grown).otherwise(acc["total"]).alias("total"), F.when(unit.isNotNull(), 0).otherwise(digit).alias("num"))

    chinese = F.aggregate(F.split(own, ""), zero, step, lambda acc: acc["total"] + acc["num"])
    return F.when(own.rlike(r"^[0-9]+$"), own.try_cast("int")).when(own.rlike(f"^[{''.join([*CN_DIGITS, *CN_UNITS])}]+$"), chinese)


def number_chain(c: Column) -> Column:
    return F.regexp_replace(strip(text_or_empty(c)), r"(?U)\s*[.．]\s*", ".")


def replace_leading_number(c: Column, number: Column) -> Column:
    own = strip(text_or_empty(c))
    lead = r"(?U)^(?:[.．]\s*)?[0-9]{1,3}(?:\s*[.．]\s*[0-9]{1,3})*"
    return F.when(own.rlike(lead), strip(F.concat(number, F.regexp_replace(own, lead, "")))).otherwise(own)


def next_section_number(chapter: Column, current: Column) -> Column:
    """The number after `current` within the chapter, or its first."""
    chapter, last = strip(text_or_empty(chapter)), F.element_at(F.split(strip(text_or_empty(current)), r"\."), -1)
    inside = F.startswith(strip(text_or_empty(current)), F.concat(chapter, F.lit("."))) & last.rlike("^[0-9]+$")
    return F.when(chapter == "", "").when(inside, F.concat(chapter, F.lit("."), (last.try_cast("int") + 1).cast("string"))).otherwise(F.concat(chapter, F.lit(".1")))


def labels(c: Column, pattern: str = LABEL) -> Column:
    """Keys of the labels in a text, in order of first appearance."""
    found = F.regexp_extract_all(text_or_empty(c), F.lit(f"(?U)({pattern})"), 1)
    return F.array_distinct(F.transform(found, lambda x: anchor_key(x)))


def label_pairs(c: Column) -> Column:
    """(raw, key) of figure labels, the first raw form of each key."""
    found = F.regexp_extract_all(text_or_empty(c), F.lit(f"(?U)({FIGURE_LABEL})"), 1)
    pairs = F.transform(found, lambda x: F.struct(strip(x).alias("raw"), anchor_key(x).alias("key")))
    return F.aggregate(pairs, F.slice(pairs, 1, 0), lambda acc, x: F.when(F.exists(acc, lambda y: y["key"] == x["key"]), acc).otherwise(F.concat(acc, F.array(x))))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with the value computed once, however often the body names it."""
    return F.transform(F.array(value), lambda v: body(v))[0]


def suspicion(c: Column) -> Column:
    """How much a text looks like garbled recognition: struct of score, reasons and counts.

    Letters and digits are most of a text, and no count needs them: symbols are taken out once, and counted in turn in what
    the count before left. Runs of symbols in the text are runs among them too, so they are looked for there first.
    """
    own = text_or_empty(c)
    raw = F.when(F.contains(own, F.lit("[IMAGE_REF:")), F.regexp_replace(own, r"\[IMAGE_REF:[^\]]+\]", "")).otherwise(own)
    symbols = lambda v: F.struct(v["raw"].alias("raw"), v["own"].alias("own"), F.regexp_replace(v["own"], rf"[a-zA-Z0-9\p{{L}}\p{{N}}{CJK}]+", "").alias("symbols"))
    weird = lambda v: F.struct(v["raw"].alias("raw"), v["own"].alias("own"), v["symbols"].alias("symbols"), F.regexp_replace(v["symbols"], f"[{in_class(ALLOWED_PUNCTUATION)}]+", "").alias("weird"))
    parts = let(let(let(raw, lambda r: F.struct(r.alias("raw"), compact(r).alias("own"))), symbols), weird)
    return let(parts, lambda v: let(_counts(v["raw"], v["own"], v["symbols"], v["weird"]), lambda n: _judged(v["own"], n)))


def _counts(raw: Column, own: Column, symbols: Column, weird: Column) -> Column:
    replaced, private = chars_of(weird, "�"), chars_of(weird, r"\p{Co}")
    chinese = own.rlike(f"[{CJK}]")
    cluster, run = "[:：；;]{2,}|[·•]{2,}|-{3,}", rf"([^\p{{L}}\p{{N}}_{CJK}])\1{{2,}}"
    latin = F.regexp_extract_all(own, F.lit(f"([{CJK}][A-Za-z]{{1,4}}[{CJK}])"), 1)
    return F.struct(
        F.length(own).alias("length"), replaced.alias("replaced"), private.alias("private"), chars_of(weird, r"\p{C}").alias("control"),
        (replaced + private + chars_of(weird, f"[{in_class(SUSPICIOUS)}]")).alias("odd"), F.length(weird).alias("weird"), F.length(symbols).alias("symbols"),
        F.when(chinese, latin).otherwise(F.array().cast("array<string>")).alias("latin"), (symbols.rlike(cluster) & own.rlike(cluster)).alias("cluster"),
        (symbols.rlike("[）)]") & raw.rlike(rf"(?:^|[{WHITE}（(])[A-Za-z][）)]")).alias("marker"), (chinese & raw.rlike(rf"(?:[{CJK}][{WHITE}]+){{3,}}[{CJK}]")).alias("spaced"),
        (symbols.rlike(run) & own.rlike(run)).alias("run"), chinese.alias("chinese"),
    )


def _judged(own: Column, n: Column) -> Column:
    size, latin, odd = F.greatest(n["length"], F.lit(1)), F.size(n["latin"]), n["odd"]
    rules = [
        ("replacement_char", n["replaced"] > 0, F.lit(6.0)),
        ("private_use_char", n["private"] > 0, F.least(F.lit(6.0), n["private"] * 2.5)),
        ("control_char", n["control"] > 0, F.least(F.lit(4.0), n["control"] * 2.0)),
        ("garbled_symbol_cluster", odd >= 2, F.least(F.lit(4.0), odd * 0.8)),
        ("unexpected_symbol_ratio", n["weird"] / size >= 0.08, F.lit(2.0)),
        ("symbol_heavy", (n["symbols"] / size >= 0.35) & (n["length"] >= 10), F.lit(1.5)),
        ("cjk_inline_latin_fragment", latin > 0, F.lit(3.5) + F.when(latin >= 2, F.least(F.lit(4), latin - 1) * 0.5).otherwise(0.0)),
        ("lowercase_inline_latin", F.exists(n["latin"], lambda x: x.rlike("[a-z]")), F.lit(1.0)),
        ("abnormal_punctuation_cluster", n["cluster"], F.lit(2.0)),
        ("single_letter_subfigure_marker", n["marker"], F.lit(1.5)),
        ("spaced_cjk", n["spaced"], F.lit(2.5)),
        ("repeated_symbol_run", n["run"], F.lit(1.5)),
    ]
    score = reduce(lambda a, b: a + b, [F.when(test, points).otherwise(0.0) for _, test, points in rules])
    reasons = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test, _ in rules]))
    some = n["length"] > 0
    return F.struct(
        n["length"].alias("compact_length"),
        F.when(some, F.bround(score, 3)).otherwise(0.0).alias("score"),
        F.when(some, reasons).otherwise(F.array().cast("array<string>")).alias("reasons"),
        F.when(some, odd).otherwise(0).alias("suspicious_chars"),
        F.when(some, F.bround(odd / size, 4)).otherwise(0.0).alias("suspicious_ratio"),
        n["chinese"].alias("contains_cjk"),
    )


def needs_correction(report: Column, relaxed: bool = False) -> Column:
    """Gate before a correction service: four characters or more, and a high score (lower for short texts if relaxed)."""
    high = report["score"] >= 4.0
    if relaxed:
        high = high | (report["compact_length"] <= 48) & (report["score"] >= 2.5)
    return (report["compact_length"] >= 4) & high


def path_safe(c: Column) -> Column:
    """A file id as a path: letters, digits and underscores of each segment, lower case."""
    parts = F.split(F.regexp_replace(text_or_empty(c), r"\\", "/"), "/")
    parts = F.transform(parts, lambda p: F.lower(F.regexp_replace(F.regexp_replace(p, r"[^\p{L}\p{N}_]+", "_"), "^_+|_+$", "")))
    return F.array_join(F.filter(parts, lambda p: p != ""), "/")


def base_name(c: Column) -> Column:
    return F.element_at(F.split(F.regexp_replace(F.regexp_replace(text_or_empty(c), r"[?#].*$", ""), r"\\", "/"), "/"), -1)


def page_of_uri(c: Column) -> Column:
    """The page that an asset's file name tells: page_012, p12 and the like."""
    found = F.regexp_extract(F.lower(base_name(c)), r"(?:page|p)[_-]?0*([0-9]{1,5})", 1)
    return F.when(found != "", found.cast("int"))


def snapshot_index(c: Column) -> Column:
    """SF09: struct of page and idx that a snapshot's name tells, as visual_p12_3.png; null if it is named otherwise."""
    name = base_name(c)
    page, idx = (F.regexp_extract(name, r"(?i)visual_p(\d+)_(\d+)", i) for i in (1, 2))
    return F.when(page != "", F.struct(page.try_cast("int").alias("page"), idx.try_cast("int").alias("idx")))


def physical_page(c: Column) -> Column:
    """SF09: the page of a name part _p12_."""
    found = F.regexp_extract(text_or_empty(c), r"(?i)_p(\d+)_", 1)
    return F.when(found != "", found.try_cast("int"))


def page_number(c: Column) -> Column:
    """SF09: 12 or p12 as an int; null if it is neither."""
    found = F.regexp_extract(strip(text_or_empty(c)), r"(?i)^p?(\d+)$", 1)
    return F.when(found != "", found.try_cast("int"))


def reference_score(c: Column, label: Column) -> Column:
    """SF41: how likely a text refers to a label: 3 after 见, 如, 按 or before a verb, 1 before the name of a drawing, else 0."""
    own, key = anchor_key(c), anchor_key(label)

    def scored(v: Column) -> Column:
        at = F.instr(v["own"], v["key"])
        last = F.length(v["own"]) - F.length(F.call_function("substring_index", v["own"], v["key"], F.lit(-1))) - F.length(v["key"])
        after = F.substring(v["own"], at + F.length(v["key"]), F.length(v["own"]))
        held = (v["key"] != "") & (at > 0)
        return F.when(~held, 0).when(F.substring(v["own"], F.lit(1), last).rlike("见|如|按") | after.rlike("所示|规定|要求|安装|采用"), 3).when(after.rlike("示例图|示意图|接线图|布置图|安装图|尺寸图"), 1).otherwise(0)

    return let(F.struct(own.alias("own"), key.alias("key")), scored)


def reference_labels(c: Column) -> Column:
    """SF41: the labels of a text that it refers to."""
    return F.filter(labels(c), lambda x: reference_score(c, x) >= 2)


def first_of(*cols: Column) -> Column:
    """The first text that isn't blank."""
    return F.coalesce(*[F.when(strip(text_or_empty(c)) != "", strip(text_or_empty(c))) for c in cols], F.lit(""))


def item_number(c: Column) -> Column:
    """SF45: the number that begins an item, as one sortable int: 3.2.1 and 3.2 as a * 10000 + b * 100 + c; 3. or 3、 and 第三条 as
    they are; null if none begins it."""
    own = strip(text_or_empty(c))
    part = lambda pattern, i: F.regexp_extract(own, pattern, i).try_cast("int")
    three, two, one, article = r"^(\d{1,2})\.(\d{1,2})\.(\d{1,3})(?!\d)", r"^(\d{1,2})\.(\d{1,2})(?!\d)", r"^(\d{1,3})\s*[\.．、]", r"^第\s*([0-9一二三四五六七八九十百千零〇两]+)\s*条"
    return (
        F.when(own.rlike(three), part(three, 1) * 10000 + part(three, 2) * 100 + part(three, 3)).when(own.rlike(two), part(two, 1) * 10000 + part(two, 2) * 100)
        .when(own.rlike(one), part(one, 1)).when(own.rlike(article), numeral(F.regexp_extract(own, article, 1)))
    )


def continuation_number(c: Column) -> Column:
    """SF45: a number and a space, as of a list that goes on; null if it is an item's number, or none."""
    own = strip(text_or_empty(c))
    pattern = r"^0?(\d{1,2})(?!\s*[\.．、])\s+\S"
    found = F.regexp_extract(own, pattern, 1).try_cast("int")
    return F.when(item_number(own).isNull() & own.rlike(pattern) & (found > 0), found)


def subitem_number(c: Column) -> Column:
    """SF45: a number in brackets, as （三）; null if there is none."""
    own = strip(text_or_empty(c))
    pattern = r"^[（(]\s*([0-9一二三四五六七八九十百千零〇两]+)\s*[）)]"
    return F.when(item_number(own).isNull() & own.rlike(pattern), numeral(F.regexp_extract(own, pattern, 1)))
