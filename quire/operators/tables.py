"""Tables: grids from rectangles, rows and Markdown from cells, geometry figures, diffs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import squeeze, strip, text_or_empty
from quire.operators.groups import by_group


def merged_coordinates(values: Column, tolerance: float = 0.5) -> Column:
    """SF60: ascending coordinates without those within the tolerance of the last one kept."""
    step = lambda acc, v: F.when((F.size(acc) > 0) & (v - F.element_at(acc, -1) <= tolerance), acc).otherwise(F.concat(acc, F.array(v)))
    return F.aggregate(F.array_sort(values.cast("array<double>")), F.array().cast("array<double>"), step)


def nearest_index(values: Column, at: Column) -> Column:
    """Position of the coordinate nearest to `at`, from 0; the first of equals."""
    far = F.transform(values, lambda v, i: F.struct(F.abs(v - at).alias("d"), i.alias("i")))
    return F.array_min(far)["i"]


def grid_cell(xs: Column, ys: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """SF60: row, column and spans of a rectangle in a grid of coordinates."""
    col, row = nearest_index(xs, x0), nearest_index(ys, y0)
    return F.struct(row.alias("row"), col.alias("col"), F.greatest(F.lit(1), nearest_index(ys, y1) - row).alias("row_span"), F.greatest(F.lit(1), nearest_index(xs, x1) - col).alias("col_span"))


def escaped(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(strip(text_or_empty(c)), r"\|", r"\\|"), r"\s*\n\s*", " ")


def rows_of(cells: DataFrame) -> DataFrame:
    """SF64: table_id, rows (array of arrays of texts) over the whole rectangle; cells that span stand at their anchor only."""
    own = cells.groupBy("table_id").agg(
        F.max(F.col("row") + F.col("row_span")).cast("int").alias("n_rows"), F.max(F.col("col") + F.col("col_span")).cast("int").alias("n_cols"),
        F.map_from_entries(F.collect_list(F.struct(F.concat_ws(",", "row", "col"), "text"))).alias("at"),
    )
    cell = lambda r, c: F.coalesce(F.element_at("at", F.concat_ws(",", r, c)), F.lit(""))
    rows = F.transform(F.sequence(F.lit(0), F.col("n_rows") - 1), lambda r: F.transform(F.sequence(F.lit(0), F.col("n_cols") - 1), lambda c: cell(r, c)))
    return own.select("table_id", rows.alias("rows"))


def markdown(rows: Column) -> Column:
    """SF64: rows as a Markdown table; the first is the head."""
    line = lambda r: F.concat(F.lit("| "), F.array_join(F.transform(r, escaped), " | "), F.lit(" |"))
    rule = F.concat(F.lit("| "), F.array_join(F.transform(F.element_at(rows, 1), lambda _: F.lit("---")), " | "), F.lit(" |"))
    return F.when(F.size(rows) > 0, F.array_join(F.concat(F.array(line(F.element_at(rows, 1)), rule), F.transform(F.slice(rows, 2, F.greatest(F.size(rows), F.lit(1))), line)), "\n")).otherwise("")


def parsed(text: Column) -> Column:
    """SF65: rows of a Markdown table, without its rule."""
    lines = F.filter(F.transform(F.split(text_or_empty(text), "\n"), strip), lambda s: F.startswith(s, F.lit("|")) & ~s.rlike(r"^\|[\s:|-]+\|$"))
    return F.transform(lines, lambda s: F.transform(F.split(F.regexp_replace(s, r"^\|\s*|\s*\|$", ""), r"\s*(?<!\\)\|\s*"), lambda c: F.regexp_replace(c, r"\\\|", "|")))


def geometry(cells: DataFrame) -> DataFrame:
    """Logical size, physical cells, cells that span, cells with text."""
    return cells.groupBy("table_id").agg(
        F.max(F.col("row") + F.col("row_span")).alias("rows"), F.max(F.col("col") + F.col("col_span")).alias("cols"), F.count("*").alias("physical"),
        F.count_if((F.col("row_span") > 1) | (F.col("col_span") > 1)).alias("spanned"), F.count_if(strip(text_or_empty(F.col("text"))) != "").alias("nonempty"),
    )


def keyed_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """J07, the part by key: table_id, row, col, status (same, changed, only_old, only_new), fields that differ, both texts."""
    key = ["table_id", "row", "col"]
    side = lambda d, p: d.select(*key, *[(squeeze(strip(text_or_empty(F.col(c)))) if c == "text" else F.col(c)).alias(f"{p}_{c}") for c in ("row_span", "col_span", "text")])
    both = side(old, "old").join(side(new, "new"), key, "full_outer")
    fields = F.concat_ws(",", *[F.when(F.col(f"old_{c}") != F.col(f"new_{c}"), c) for c in ("row_span", "col_span", "text")])
    status = F.when(F.col("new_text").isNull(), "only_old").when(F.col("old_text").isNull(), "only_new").when(fields == "", "same").otherwise("changed")
    return both.select(*key, status.alias("status"), F.when(status == "changed", fields).alias("fields"), "old_text", "new_text")


def cell_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """keyed_diff(), then cells of one side take, in order of (row, col), the first free cell of the other side with
    the same text as moved. Cells with a partner by key are free until their own turn, as the walk has them."""
    keyed = keyed_diff(old, new)
    kind = keyed.schema["table_id"].dataType.simpleString()

    def run(rows: list) -> list[tuple]:
        places: dict[str, dict[str, list[int]]] = {"old": {}, "new": {}}
        for i, r in enumerate(rows):
            for side, text in (("old", r.old_text), ("new", r.new_text)):
                if text is not None:
                    places[side].setdefault(text, []).append(i)
        used: dict[str, set[int]] = {"old": set(), "new": set()}
        out = []
        for i, r in enumerate(rows):
            status, fields, moved = r.status, r.fields, None
            if status in ("same", "changed"):
                used["old"].add(i)
                used["new"].add(i)
            else:
                mine, other, text = ("old", "new", r.old_text) if status == "only_old" else ("new", "old", r.new_text)
                free = [j for j in places[other].get(text, []) if j not in used[other]]
                if i in used[mine]:
                    status = "taken"
                elif free:
                    used[other].add(free[0])
                    status, fields, moved = "moved", "position", f"{rows[free[0]].row},{rows[free[0]].col}"
                used[mine].add(i)
            out.append((r.row, r.col, status, fields, r.old_text, r.new_text, moved))
        return out

    return by_group(keyed, ["table_id"], ["row", "col"], run, f"table_id {kind}, row long, col long, status string, fields string, old_text string, new_text string, moved_to string")


def ordinal_pairs(old: DataFrame, new: DataFrame) -> DataFrame:
    """J06, the part by order: the i-th table of a page with the i-th."""
    order = Window.partitionBy("document_id", "page_number").orderBy("seq")
    a = old.select("document_id", "page_number", F.col("seq").alias("old_seq"), F.row_number().over(order).alias("i"))
    b = new.select("document_id", "page_number", F.col("seq").alias("new_seq"), F.row_number().over(order).alias("i"))
    return a.join(b, ["document_id", "page_number", "i"], "full_outer").drop("i")
