"""Labels and references: an index of figure labels, resolution with explicit ties, back-edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import let
from quire.operators.groups import dealt


def merged_labels(labels: DataFrame) -> DataFrame:
    """One label a (block, key): native before recognised, then the first. labels: document_id, block_id, key, raw, source, seq."""
    rank = F.when(F.col("source") == "native", 0).otherwise(1)
    best = F.min(F.struct(rank.alias("rank"), "seq", "raw", "source")).alias("best")
    return labels.groupBy("document_id", "block_id", "key").agg(best).select("document_id", "block_id", "key", "best.raw", "best.source")


def resolve(refs: DataFrame, figures: DataFrame) -> DataFrame:
    """The figure that a reference means. Both: document_id, label, page_number, block_id, cx, cy (centre).

    No figure with the label: unresolved. One: it. Several: the nearest centre on the same page, else the smallest page
    distance; an exact tie is ambiguous, never the first. Targets and references meet by (document, label): a reference is
    judged against the list of its label's targets, so no pair is sorted or sent.
    """
    key = ["document_id", "label"]
    # + 0.0, as a set tells -0.0 from 0.0
    target = F.struct(F.col("block_id").alias("t_id"), F.col("page_number").alias("t_page"), (F.col("cx") + 0.0).alias("cx"), (F.col("cy") + 0.0).alias("cy"))
    targets = dealt(figures.select(*key, target.alias("t")), *key).groupBy(*key).agg(F.collect_set("t").alias("targets"))
    ref = ["document_id", "block_id", "label", "page_number"]
    places = dealt(refs.select(*ref, F.struct((F.col("cx") + 0.0).alias("cx"), (F.col("cy") + 0.0).alias("cy")).alias("at")), *key).groupBy(*ref).agg(F.collect_set("at").alias("at"))
    pairs = places.join(targets.hint("merge"), key, "left")

    def score(a: Column, t: Column) -> Column:
        """Same-page targets come first, by centre distance; then others, by pages between."""
        dx, dy, same = a["cx"] - t["cx"], a["cy"] - t["cy"], t["t_page"] == F.col("page_number")
        far = F.when(F.size("targets") == 1, 0.0).when(same, F.sqrt(dx * dx + dy * dy)).otherwise(F.abs(t["t_page"] - F.col("page_number")).cast("double"))
        return F.struct(F.when(same, 0).otherwise(1).alias("other"), far.alias("far"), t["t_id"].alias("t_id"), t["t_page"].alias("t_page"))

    scored = F.flatten(F.transform("at", lambda a: F.transform("targets", lambda t: score(a, t))))
    least = lambda rows: F.array_min(F.transform(rows, lambda x: F.struct(x["other"].alias("other"), x["far"].alias("far"))))
    tied = let(scored, lambda rows: let(least(rows), lambda m: F.filter(rows, lambda x: x["other"].eqNullSafe(m["other"]) & x["far"].eqNullSafe(m["far"]))))
    best = let(tied, lambda rows: F.struct(
        F.coalesce(rows[0]["other"], F.lit(1)).alias("other"), F.coalesce(F.size(F.filter(rows, lambda x: x["t_id"].isNotNull())), F.lit(0)).alias("ties"),
        F.array_min(F.transform(rows, lambda x: x["t_id"])).alias("t_id"), F.array_min(F.transform(rows, lambda x: x["t_page"])).alias("t_page"),
    ))
    found = pairs.select(*ref, F.size("targets").alias("n_targets"), F.when(F.col("targets").isNotNull(), best).alias("best")).select(*ref, "n_targets", "best.other", F.coalesce("best.ties", F.lit(0)).alias("ties"), "best.t_id", "best.t_page")
    clear = F.col("ties") == 1
    near = F.when(F.col("other") == 0, "same_page").otherwise("page")
    none = F.col("ties") == 0
    reason = F.when(none, "no_label_in_index").when(F.col("n_targets") == 1, "unique_target").when(clear, F.concat(F.lit("nearest_"), near)).otherwise(F.concat(F.lit("tied_"), near, F.lit("_distance:"), F.col("ties").cast("string")))
    status = F.when(none, "unresolved").when(clear, "resolved").otherwise("ambiguous")
    return found.select(*ref, status.alias("status"), F.when(clear, F.col("t_id")).alias("target_id"), reason.alias("reason"), F.when(clear, F.col("t_page") - F.col("page_number")).alias("page_delta"))


def referenced_by(resolved: DataFrame) -> DataFrame:
    """Back-edges: who refers to a figure."""
    own = dealt(resolved.where("status = 'resolved'").select("document_id", "target_id", "block_id"), "document_id", "target_id").groupBy("document_id", "target_id")
    return own.agg(F.count("*").alias("n_refs"), F.countDistinct("block_id").alias("n_blocks"), F.min("block_id").alias("first_block"))


def unreferenced(figures: DataFrame, resolved: DataFrame) -> DataFrame:
    """Figures that nothing refers to."""
    used = resolved.where("status = 'resolved'").select("document_id", F.col("target_id").alias("block_id"))
    key = ["document_id", "block_id"]
    return dealt(figures, *key).join(dealt(used, *key).hint("merge"), key, "left_anti")


def clusters(nodes: DataFrame, gap: int = 2) -> DataFrame:
    """Figure nodes of one (title, label) in islands whose pages lie at most `gap` apart; the anchor has the most pictures.

    nodes: title, label, page_number, entry_no, n_images, n_captions.
    """
    order = Window.partitionBy("title", "label").orderBy("page_number", "entry_no")
    new = F.coalesce((F.col("page_number") - F.lag("page_number").over(order) > gap).cast("long"), F.lit(0))
    own = nodes.withColumn("__new", new).withColumn("cluster", F.sum("__new").over(order) + 1)
    anchor = F.max(F.struct("n_images", "n_captions", (-F.col("page_number")).alias("p"), (-F.col("entry_no")).alias("e"))).alias("a")
    out = own.groupBy("title", "label", "cluster").agg(F.count("*").alias("members"), F.min("page_number").alias("first_page"), F.max("page_number").alias("last_page"), anchor)
    return out.select("title", "label", "cluster", "members", "first_page", "last_page", (-F.col("a.e")).alias("anchor_entry"))
