"""Box operators: spatial joins, first-fit and greedy matching, suppression, connected fragments.

Boxes: document_id, page_number, seq, kind, x, y, w, h (and score). Joins are by page, so both sides are dealt by it.
Operators whose steps depend on what was kept before run as one small group a page; everything else is built-in.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.captions import caption_candidate
from quire.functions.geometry import Box, center_distance, inside, intersection, overlap_ratio
from quire.operators.groups import by_group

PAGE = ["document_id", "page_number"]


def prefixed(boxes: DataFrame, prefix: str) -> DataFrame:
    return boxes.select(*PAGE, *[F.col(c).alias(f"{prefix}{c}") for c in boxes.columns if c not in PAGE])


def page_pairs(a: DataFrame, b: DataFrame) -> DataFrame:
    """All pairs of a page, a_ and b_ columns; a page is small, and pairs never leave it."""
    return prefixed(a, "a_").join(prefixed(b, "b_"), PAGE)


def overlaps(a: DataFrame, b: DataFrame, least: float = 0.3) -> DataFrame:
    """Pairs where the intersection covers `least` of either box, with both ratios."""
    x, y = Box.of("a_"), Box.of("b_")
    pairs = page_pairs(a, b).withColumns({"a_ratio": overlap_ratio(x, y), "b_ratio": overlap_ratio(y, x)})
    return pairs.where((F.col("a_ratio") >= least) | (F.col("b_ratio") >= least))


def best_overlap(a: DataFrame, b: DataFrame) -> DataFrame:
    """For each box of a the box of b that covers most of b's own area; the first of equals."""
    pairs = page_pairs(a, b).withColumn("ratio", overlap_ratio(Box.of("b_"), Box.of("a_"))).where("ratio > 0")
    best = F.max(F.struct("ratio", (-F.col("b_seq")).alias("neg"))).alias("best")
    return pairs.groupBy(*PAGE, "a_seq").agg(best).select(*PAGE, F.col("a_seq").alias("seq"), (-F.col("best.neg")).alias("match_seq"), F.col("best.ratio").alias("ratio"))


def suppressed_text(texts: DataFrame, tables: DataFrame, least: float = 0.8) -> DataFrame:
    """Texts that keep more than 1 - least of their area outside every structured table."""
    hit = page_pairs(texts, tables).where(overlap_ratio(Box.of("a_"), Box.of("b_")) >= least).select(*PAGE, F.col("a_seq").alias("seq")).distinct()
    return texts.join(hit, [*PAGE, "seq"], "left_anti")


def association_pairs(figures: DataFrame, texts: DataFrame, legend_kind: str = "legend") -> DataFrame:
    """Captions and legends below a figure of their page, with the order in which they are linked.

    Gap from -4 to 48 points (legends 40); not above the figure's middle; overlap of 20 % of either width, or centres
    within 35 % of the figure's width.
    """
    f, t = Box.of("a_"), Box.of("b_")
    fw, tw = F.greatest(F.lit(1e-6), f.w.cast("double")), F.greatest(F.lit(1e-6), t.w.cast("double"))
    inter = F.greatest(F.lit(0), F.least(f.right, t.right) - F.greatest(f.x, t.x))
    center = F.abs((f.x + f.w / 2.0) - (t.x + t.w / 2.0))
    gap = t.y - f.bottom
    legend = F.col("b_kind") == legend_kind
    near = (gap >= -4) & (gap <= F.when(legend, 40).otherwise(48)) & (t.y >= f.y + f.h * 0.5)
    beside = (inter / fw >= 0.2) | (inter / tw >= 0.2) | (center <= 0.35 * fw)
    own = page_pairs(figures, texts).where(near & beside)
    return own.withColumns({"kind_rank": F.when(legend, 1).otherwise(0), "gap": F.greatest(F.lit(0), gap).cast("double"), "center": center.cast("double")})


def key_types(rows: DataFrame) -> str:
    return ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in PAGE)


def associate(figures: DataFrame, texts: DataFrame, legend_kind: str = "legend") -> DataFrame:
    """Links figure_seq, text_seq, kind. Pairs in order of kind, gap, centre distance, ids; a text is linked once, a
    figure has one caption and any number of legends."""
    pairs = association_pairs(figures, texts, legend_kind).select(*PAGE, "a_seq", "b_seq", "kind_rank", "gap", "center")

    def run(page: list) -> list[tuple]:
        texts_used, captioned, out = set(), set(), []
        for row in page:
            if row.b_seq in texts_used or row.kind_rank == 0 and row.a_seq in captioned:
                continue
            texts_used.add(row.b_seq)
            if row.kind_rank == 0:
                captioned.add(row.a_seq)
            out.append((row.a_seq, row.b_seq, "legend" if row.kind_rank else "caption"))
        return out

    return by_group(pairs, PAGE, ["kind_rank", "gap", "center", "a_seq", "b_seq"], run, f"{key_types(pairs)}, figure_seq long, text_seq long, kind string")


def first_fit(left: DataFrame, right: DataFrame, test: Callable[[Box, Box], Column]) -> DataFrame:
    """Each left box, in order of seq, takes the first right box that passes and is still free."""
    pairs = page_pairs(left, right).where(test(Box.of("a_"), Box.of("b_"))).select(*PAGE, "a_seq", "b_seq")

    def run(page: list) -> list[tuple]:
        taken, used = {}, set()
        for row in page:
            if row.a_seq not in taken and row.b_seq not in used:
                taken[row.a_seq] = row.b_seq
                used.add(row.b_seq)
        return [*taken.items()]

    return by_group(pairs, PAGE, ["a_seq", "b_seq"], run, f"{key_types(pairs)}, left_seq long, right_seq long")


def either_overlap(least: float = 0.3) -> Callable[[Box, Box], Column]:
    return lambda a, b: (overlap_ratio(a, b) >= least) | (overlap_ratio(b, a) >= least)


def merged_tables(native: DataFrame, visual: DataFrame, least: float = 0.3) -> DataFrame:
    """Native tables with the larger of their own and their visual match's box; unmatched visual ones as image_only."""
    links = first_fit(native, visual, either_overlap(least))
    v = visual.select(*PAGE, F.col("seq").alias("right_seq"), *[F.col(c).alias(f"v_{c}") for c in "xywh"])
    own = native.join(links.withColumnRenamed("left_seq", "seq"), [*PAGE, "seq"], "left").join(v, [*PAGE, "right_seq"], "left")
    larger = F.coalesce(F.col("v_w") * F.col("v_h") > F.col("w") * F.col("h"), F.lit(False))
    kept = own.select(*PAGE, "seq", *[F.when(larger, F.col(f"v_{c}")).otherwise(F.col(c)).alias(c) for c in "xywh"], F.lit("structured").alias("status"), F.col("right_seq").isNotNull().alias("visual_matched"))
    alone = visual.join(links.withColumnRenamed("right_seq", "seq"), [*PAGE, "seq"], "left_anti")
    return kept.unionByName(alone.select(*PAGE, "seq", *"xywh", F.lit("image_only").alias("status"), F.lit(True).alias("visual_matched")))


def figure_pictures(embedded: DataFrame, visual: DataFrame, least: float = 0.35) -> DataFrame:
    """Embedded pictures, with the visual figure that each takes (the first free one that covers 35 % of it); visual
    figures that none took are to be cropped from the page."""
    links = first_fit(embedded, visual, lambda a, b: overlap_ratio(a, b) >= least)
    own = embedded.join(links.withColumnRenamed("left_seq", "seq"), [*PAGE, "seq"], "left")
    alone = visual.join(links.withColumnRenamed("right_seq", "seq"), [*PAGE, "seq"], "left_anti")
    return own.select(*PAGE, "seq", *"xywh", "right_seq", F.lit("embedded").alias("asset_source")).unionByName(alone.select(*PAGE, "seq", *"xywh", F.lit(None).cast("long").alias("right_seq"), F.lit("page_crop").alias("asset_source")))


def matched_versions(old: DataFrame, new: DataFrame, least: float = 0.3) -> DataFrame:
    """Tables of two versions of a page: by overlap first-fit, then the i-th with the i-th if that is free; leftovers of both."""
    tagged = old.withColumn("side", F.lit(0)).unionByName(new.withColumn("side", F.lit(1)))

    def run(page: list) -> list[tuple]:
        a, b = ([r for r in page if r.side == side] for side in (0, 1))
        used, out = set(), []
        for i, r in enumerate(a):
            match, how = None, "unmatched"
            if r.w is not None:
                for j, t in enumerate(b):
                    if j not in used and t.w is not None:
                        p, q = whole(r), whole(t)
                        inter = shared(p, q)
                        if inter >= least * max(1, p[2] * p[3]) or inter >= least * max(1, q[2] * q[3]):
                            match, how = j, "page+bbox"
                            break
            if match is None and i < len(b) and i not in used:
                match, how = i, "page+order"
            if match is not None:
                used.add(match)
            out.append((r.seq, None if match is None else b[match].seq, how))
        return out + [(None, t.seq, "unmatched") for j, t in enumerate(b) if j not in used]

    return by_group(tagged, PAGE, ["seq"], run, f"{key_types(tagged)}, old_seq long, new_seq long, method string")


def whole(r) -> tuple[int, int, int, int]:
    return int(r.x), int(r.y), int(r.w), int(r.h)


def shared(p: tuple, q: tuple) -> int:
    w, h = min(p[0] + p[2], q[0] + q[2]) - max(p[0], q[0]), min(p[1] + p[3], q[1] + q[3]) - max(p[1], q[1])
    return w * h if w > 0 and h > 0 else 0


def kept_greedily(boxes: DataFrame, order: Callable[[object], tuple], drops: Callable[[object, object], bool]) -> DataFrame:
    """A page's boxes in order; one goes if drops(it, k) for any k kept before."""
    own = boxes.select(*PAGE, *[c for c in boxes.columns if c not in PAGE])

    def run(page: list) -> list[tuple]:
        kept: list = []
        for r in sorted(page, key=order):
            if not any(drops(r, k) for k in kept):
                kept.append(r)
        return [r[len(PAGE) :] for r in kept]

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields)
    return by_group(own, PAGE, ["seq"], run, fields)


def overlap_of_union(r, k) -> float:
    inter = shared(whole(r), whole(k))
    union = r.w * r.h + k.w * k.h - inter
    return inter / union if union > 0 else 0.0


def lies_within(r, k, margin: float) -> bool:
    return r.x >= k.x - margin and r.y >= k.y - margin and r.x + r.w <= k.x + k.w + margin and r.y + r.h <= k.y + k.h + margin


def nms(boxes: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Best score first; a box goes if its IoU with a kept one reaches the threshold. Equal scores: by seq."""
    return kept_greedily(boxes, lambda r: (-r.score, r.seq), lambda r, k: overlap_of_union(r, k) >= threshold)


def largest_first(r) -> tuple:
    return -r.w * r.h, r.y, r.x, r.seq


def pruned(boxes: DataFrame) -> DataFrame:
    """Largest first; a box goes if its IoU with a kept one is 0.82, or it lies within one by 8 points."""
    return kept_greedily(boxes, largest_first, lambda r, k: overlap_of_union(r, k) >= 0.82 or lies_within(r, k, 8))


def without_nested(boxes: DataFrame) -> DataFrame:
    """Largest first; a box goes if it lies within a kept one by 18 points and has 80 % of its area at most."""
    return kept_greedily(boxes, largest_first, lambda r, k: lies_within(r, k, 18) and r.w * r.h <= 0.8 * max(1, k.w * k.h))


def without_containers(boxes: DataFrame) -> DataFrame:
    """Large boxes that are covered by smaller ones go: two at least, each under 90 % of its area and with 18 % of it
    in common, 88 % together, and spread over it. Judged on the input, so it is one self-join."""
    a, b = Box.of("a_"), Box.of("b_")
    area = F.greatest(F.lit(1), a.area)
    inter = intersection(a, b)
    pairs = page_pairs(boxes, boxes).where((F.col("a_seq") != F.col("b_seq")) & (F.greatest(F.lit(1), b.area) < area * 0.9) & (inter >= area * 0.18))
    own = pairs.groupBy(*PAGE, F.col("a_seq").alias("seq")).agg(
        F.count("*").alias("n"), F.sum(inter).alias("covered"), F.max(area).alias("area"), F.max("a_w").alias("aw"), F.max("a_h").alias("ah"),
        (F.max(b.x + b.w * 0.5) - F.min(b.x + b.w * 0.5)).alias("dx"), (F.max(b.y + b.h * 0.5) - F.min(b.y + b.h * 0.5)).alias("dy"),
    )
    spread = (F.col("dy") >= F.greatest(F.lit(90.0), F.col("ah") * 0.18)) | (F.col("dx") >= F.greatest(F.lit(90.0), F.col("aw") * 0.18))
    gone = own.where((F.col("n") >= 2) & (F.col("covered") >= F.col("area") * 0.88) & spread)
    return boxes.join(gone, [*PAGE, "seq"], "left_anti")


def fragments(boxes: DataFrame, pad: int = 6, gap: int = 18) -> DataFrame:
    """Boxes that overlap by 30 %, or stand side by side or in a column within `gap`, are one group; its padded union."""
    a, b = Box.of("a_"), Box.of("b_")
    rows = F.greatest(F.lit(0), F.least(a.bottom, b.bottom) - F.greatest(a.y, b.y)) / F.greatest(F.lit(1), F.least(a.h, b.h))
    cols = F.greatest(F.lit(0), F.least(a.right, b.right) - F.greatest(a.x, b.x)) / F.greatest(F.lit(1), F.least(a.w, b.w))
    gap_x, gap_y = F.greatest(a.x, b.x) - F.least(a.right, b.right), F.greatest(a.y, b.y) - F.least(a.bottom, b.bottom)
    near = (overlap_ratio(a, b) >= 0.3) | (overlap_ratio(b, a) >= 0.3) | ((rows >= 0.28) & (gap_x <= gap)) | ((cols >= 0.38) & (gap_y <= gap))
    edges = page_pairs(boxes, boxes).where((F.col("a_seq") <= F.col("b_seq")) & ((F.col("a_seq") == F.col("b_seq")) | near)).select(*PAGE, "a_seq", "b_seq", *[f"a_{c}" for c in "xywh"])

    def run(page: list) -> list[tuple]:
        up = {r.a_seq: r.a_seq for r in page}

        def root(i: int) -> int:
            while up[i] != i:
                up[i] = up[up[i]]
                i = up[i]
            return i

        for r in page:
            i, j = root(r.a_seq), root(r.b_seq)
            up[max(i, j)] = min(i, j)
        groups: dict[int, list] = {}
        for r in page:
            if r.a_seq == r.b_seq:
                groups.setdefault(root(r.a_seq), []).append(r)
        out = []
        for g, own in groups.items():
            x, y = min(r.a_x for r in own) - pad, min(r.a_y for r in own) - pad
            out.append((g, len(own), x, y, max(r.a_x + r.a_w for r in own) + pad - x, max(r.a_y + r.a_h for r in own) + pad - y))
        return out

    return by_group(edges, PAGE, ["a_seq", "b_seq"], run, f"{key_types(edges)}, group_seq long, members long, x long, y long, w long, h long")


def nearest_caption(blocks: DataFrame, allowed: tuple[str, ...] = ("caption",)) -> DataFrame:
    """The caption of each table and figure of an entry: the nearest block before it that can be one, up to the visual of
    the same type before; else the nearest after it, up to the next one. blocks: entry_id, seq, type, role, text.

    Rows entry_id, seq, caption_seq, caption; visuals without a caption are left out.
    """
    order = Window.partitionBy("entry_id").orderBy("seq")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)
    type_, role = F.lower(F.coalesce("type", F.lit(""))), F.lower(F.coalesce("role", F.lit("")))
    out = []
    for kind in ("table", "figure"):
        text = F.when(role.isin(*[r for r in allowed if r != "artifact"]), caption_candidate(F.col("text"), kind))
        own = blocks.select("entry_id", "seq", (type_ == kind).alias("visual"), text.alias("text"))
        candidate = F.when((F.col("text") != "") & ~F.col("visual"), F.struct(F.col("seq").alias("caption_seq"), F.col("text").alias("caption")))
        same = F.when(F.col("visual"), F.col("seq"))
        own = own.withColumns({"up": F.last(candidate, ignorenulls=True).over(before), "down": F.first(candidate, ignorenulls=True).over(after), "above": F.max(same).over(before), "below": F.min(same).over(after)}).where("visual")
        up = F.when(F.col("above").isNull() | (F.col("up.caption_seq") > F.col("above")), F.col("up"))
        down = F.when(F.col("below").isNull() | (F.col("down.caption_seq") < F.col("below")), F.col("down"))
        out.append(own.withColumn("c", F.coalesce(up, down)).where("c is not null").select("entry_id", "seq", "c.caption_seq", "c.caption"))
    return out[0].unionByName(out[1])


def outside_regions(texts: DataFrame, regions: DataFrame, keep: Column | None = None, margin: float = 0) -> DataFrame:
    """Texts that lie in no region; those that `keep` (over the texts' columns) names stay anyway."""
    hit = page_pairs(texts, regions).where(inside(Box.of("a_"), Box.of("b_"), margin)).select(*PAGE, F.col("a_seq").alias("seq")).distinct()
    out = texts.join(hit, [*PAGE, "seq"], "left_anti")
    return out if keep is None else out.unionByName(texts.where(keep).join(hit, [*PAGE, "seq"], "left_semi"))
