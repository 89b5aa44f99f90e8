"""Tables found by the places of text boxes: rows by bands, cells by gaps, columns by alignment.

All steps are windows over a page's boxes in sorted order; a page is sorted
some times, and nothing is compared in pairs:

* boxes in the order of their tops begin a new band where one lies below
  everything before it,
* within a band, boxes in the order of their left sides begin a new cell where the
  gap to what is left of them is wide,
* bands of several cells that follow each other closely are a region, if there are enough of them,
* a region's columns are what remains of its fullest bands between the gaps that no cell crosses;
  a cell belongs to the first column that it touches, and a wide one spans several,
* a band without anything in the first column goes on with the row above, cell by cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .layout import BOX

#: Points between cells, and bands of a region at the least; how many band heights may lie between two of its bands.
GAP, LEAST_BANDS, APART = 8.0, 3, 1.5
PAGE = ["doc_id", "page"]


def _runs(begins: Column, window) -> Column:
    """Numbers from 0 of the runs that begin where a condition holds, in the window's order."""
    return (F.sum(F.when(begins, 1).otherwise(0)).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - 1).cast("int")


def _until_now(column: str, window) -> Column:
    return F.max(column).over(window.rowsBetween(Window.unboundedPreceding, -1))


def cells(boxes: DataFrame, gap: float = GAP) -> DataFrame:
    """doc_id, page, band, cell, box and text of the cells that text boxes (doc_id, page, id, box, text) make up; ids are their boxes' ids."""
    whole = boxes.where(" AND ".join(f"{k} IS NOT NULL" for k in BOX)).where("trim(coalesce(text, '')) <> ''")
    down = Window.partitionBy(*PAGE).orderBy("y0", "x0", "id")
    bands = whole.withColumn("below", _until_now("y1", down)).withColumn("band", _runs(F.col("below").isNull() | (F.col("y0") >= F.col("below")), down))
    across = Window.partitionBy(*PAGE, "band").orderBy("x0", "y0", "id")
    named = bands.withColumn("right", _until_now("x1", across)).withColumn("cell", _runs(F.col("right").isNull() | (F.col("x0") - F.col("right") > gap), across))
    parts = F.sort_array(F.collect_list(F.struct("x0", "y0", "id", "text")))
    sides = [F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1")]
    return named.groupBy(*PAGE, "band", "cell").agg(*sides, F.array_join(F.transform(parts, lambda p: F.trim(p["text"])), " ").alias("text"), F.array_sort(F.collect_list("id")).alias("ids"))


def regions(found: DataFrame, least: int = LEAST_BANDS, apart: float = APART) -> DataFrame:
    """The cells with their region, the number of cells in their band and in its fullest one; cells of no region are left out."""
    band, down = Window.partitionBy(*PAGE, "band"), Window.partitionBy(*PAGE).orderBy("band", "cell")
    rows = found.withColumns({"n": F.count(F.lit(1)).over(band), "top": F.min("y0").over(band), "bottom": F.max("y1").over(band)})
    rows = rows.withColumn("above", F.lag(F.struct("top", "bottom")).over(down))
    near = F.col("top") - F.col("above.bottom") <= apart * (F.col("above.bottom") - F.col("above.top"))
    runs = rows.withColumn("region", _runs((F.col("cell") == 0) & (F.col("above").isNull() | ~near), down))
    inside = Window.partitionBy(*PAGE, "region")
    # a band of one cell may go on with the row above; it does not begin a region
    runs = runs.withColumns({"first": F.min(F.when(F.col("n") > 1, F.col("band"))).over(inside), "several": F.count_if((F.col("n") > 1) & (F.col("cell") == 0)).over(inside), "most": F.max("n").over(inside)})
    return runs.where((F.col("band") >= F.col("first")) & (F.col("several") >= least)).drop("top", "bottom", "above", "first", "several")


def with_columns(inside: DataFrame) -> DataFrame:
    """Adds columns (left and right ends of the region's columns, from the left): what the cells of its fullest bands leave."""
    key = [*PAGE, "region"]
    across, full = Window.partitionBy(*key).orderBy("x0", "band", "cell"), F.col("n") == F.col("most")
    rows = inside.withColumn("end", F.when(full, F.col("x1"))).withColumn("right", _until_now("end", across))
    rows = rows.withColumn("run", _runs(full & (F.col("right").isNull() | (F.col("x0") > F.col("right"))), across))
    of_run = Window.partitionBy(*key, "run")
    rows = rows.withColumn("ends", F.struct(F.min(F.when(full, F.col("x0"))).over(of_run).alias("left"), F.max("end").over(of_run).alias("right")))
    named = F.sort_array(F.collect_set(F.when(full, F.col("ends"))).over(Window.partitionBy(*key)))
    return rows.withColumn("columns", named).drop("end", "right", "run", "ends")


def table_cells(boxes: DataFrame, gap: float = GAP, least: int = LEAST_BANDS, apart: float = APART) -> DataFrame:
    """doc_id, page, region, row, column, span, text and ids of the cells of all tables, from text boxes."""
    key = [*PAGE, "region"]
    placed = with_columns(regions(cells(boxes, gap), least, apart))
    places = F.sequence(F.lit(0), F.size("columns") - 1)
    touched = F.filter(places, lambda i: (F.get("columns", i)["left"] <= F.col("x1")) & (F.get("columns", i)["right"] >= F.col("x0")))
    nearest = F.array_min(F.transform(places, lambda i: F.struct(F.abs(F.get("columns", i)["left"] - F.col("x0")).alias("d"), i.alias("i"))))["i"]
    placed = placed.withColumn("touched", touched).withColumn("column", F.coalesce(F.get("touched", F.lit(0)), nearest)).withColumn("span", F.greatest(F.size("touched"), F.lit(1)))
    begins = (F.col("cell") == 0) & F.col("from_left")
    placed = placed.withColumn("from_left", F.min("column").over(Window.partitionBy(*key, "band")) == 0)
    rows = placed.withColumn("row", F.greatest(_runs(begins, Window.partitionBy(*key).orderBy("band", "cell")), F.lit(0)))
    parts = F.sort_array(F.collect_list(F.struct("band", "cell", "text", "ids")))
    sides = [f(k).alias(k) for k, f in zip(BOX, (F.min, F.min, F.max, F.max), strict=True)]
    out = rows.groupBy(*key, "row", "column").agg(F.max("span").alias("span"), parts.alias("p"), F.max(F.size("columns")).alias("width"), *sides)
    return out.select(*key, "row", "column", "span", F.array_join(F.transform("p", lambda p: p["text"]), " ").alias("text"), F.flatten(F.transform("p", lambda p: p["ids"])).alias("ids"), "width", *BOX)


def tables(found: DataFrame) -> DataFrame:
    """doc_id, page, region, box, ids and cells (rows of texts, blank where there is nothing) of table_cells."""
    key = [*PAGE, "region"]
    rows = found.groupBy(*key, "row").agg(F.map_from_entries(F.collect_list(F.struct("column", "text"))).alias("m"), F.max("width").alias("width"), F.flatten(F.collect_list("ids")).alias("ids"), *[f(k).alias(k) for k, f in zip(BOX, (F.min, F.min, F.max, F.max), strict=True)])
    line = F.transform(F.sequence(F.lit(0), F.col("width") - 1), lambda i: F.coalesce(F.element_at("m", i), F.lit("")))
    listed = rows.withColumn("line", line).groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("row", "line"))).alias("lines"), F.flatten(F.collect_list("ids")).alias("ids"), *[f(k).alias(k) for k, f in zip(BOX, (F.min, F.min, F.max, F.max), strict=True)])
    return listed.select(*key, *BOX, "ids", F.transform("lines", lambda x: x["line"]).alias("cells"))


def into_elements(elements: DataFrame, gap: float = GAP) -> DataFrame:
    """Elements (doc_id, page, ordinal, kind, box, text, cells, ...) where text boxes that make up a table are one table element."""
    texts = elements.where("kind = 'text'").select(*PAGE, F.col("ordinal").alias("id"), *BOX, "text")
    made = tables(table_cells(texts, gap))
    taken = made.select(*PAGE, F.explode("ids").alias("ordinal"))
    rest = elements.join(taken, [*PAGE, "ordinal"], "left_anti")
    given = {"ordinal": F.array_min("ids"), "kind": F.lit("table"), "cells": F.col("cells")} | {k: F.col(k) for k in (*PAGE, *BOX)}
    return rest.unionByName(made.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in elements.schema.fields]))
