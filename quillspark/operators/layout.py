"""Places of elements on a page: overlap, charts, scanned pages and reading order."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BOX = ("x0", "y0", "x1", "y1")
#: Square points that an image must have to count.
SMALL = 2500.0


def area(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.greatest(F.lit(0.0), x1 - x0) * F.greatest(F.lit(0.0), y1 - y0)


def overlap_share(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Common area over the smaller area; 0 if a box has none."""
    common = area(F.greatest(a["x0"], b["x0"]), F.greatest(a["y0"], b["y0"]), F.least(a["x1"], b["x1"]), F.least(a["y1"], b["y1"]))
    return F.coalesce(F.try_divide(common, F.least(area(*(a[k] for k in BOX)), area(*(b[k] for k in BOX)))), F.lit(0.0))


#: Side of a cell of the grid that boxes meet in, in points.
CELL = 64.0


def in_cells(rows: DataFrame, name: str, cell: float = CELL) -> DataFrame:
    """A row for each cell (cx, cy) of the grid that a box touches, from its column ``name`` (x0, y0, x1, y1)."""
    box = F.col(name)
    at = lambda v, size: F.floor(v / size).cast("long")
    span = lambda low, high: F.sequence(at(low, F.lit(cell)), F.greatest(at(low, F.lit(cell)), at(high, F.lit(cell))))
    return rows.withColumn("cx", F.explode(span(box["x0"], box["x1"]))).withColumn("cy", F.explode(span(box["y0"], box["y1"])))


def candidates(left: DataFrame, right: DataFrame, key: list[str], margin: float = 0.0, cell: float = CELL) -> DataFrame:
    """Pairs (l and r, structs of id and box) whose boxes, the left one grown, have a cell in common, each once.

    Pairs meet in a join by key and cell. A pair with several common cells is
    kept in the one where its common part begins. A page in points has some
    hundred cells; for other units give another ``cell``.
    """
    box = lambda grow: F.struct("id", *((F.col(k) + (g * grow)).alias(k) for k, g in zip(BOX, (-1, -1, 1, 1), strict=True)))
    whole = F.col("x0").isNotNull() & F.col("y0").isNotNull() & F.col("x1").isNotNull() & F.col("y1").isNotNull()
    a = in_cells(left.where(whole).select(*key, box(margin).alias("l")), "l", cell)
    b = in_cells(right.where(whole).select(*key, box(0.0).alias("r")), "r", cell)
    begins = lambda k: F.floor(F.greatest(F.col("l")[k], F.col("r")[k]) / cell).cast("long")
    return a.join(b, [*key, "cx", "cy"]).where((F.col("cx") == begins("x0")) & (F.col("cy") == begins("y0"))).drop("cx", "cy")


def overlapping(left: DataFrame, right: DataFrame, key: list[str], margin: float = 0.0, least: float = 0.01, cell: float = CELL) -> DataFrame:
    """Pairs of elements of one page that overlap, the left one grown by a margin.

    ``left`` and ``right`` have the key columns, an id and a box. Only boxes
    with a cell of the page's grid in common are compared, so a page of
    thousands of boxes costs about as many pairs as overlap.
    """
    sides = [{k: F.col(s)[k] for k in BOX} for s in ("l", "r")]
    pairs = candidates(left, right, key, margin, cell).withColumn("share", overlap_share(*sides))
    return pairs.where(F.col("share") > least).select(*key, F.col("l.id").alias("left_id"), F.col("r.id").alias("right_id"), "share")


def charts(images: DataFrame, texts: DataFrame, key: list[str], margin: float = 20.0, numbers: int = 3) -> DataFrame:
    """Images with whether the text around them has the numbers of a chart's axes."""
    near = overlapping(images, texts, key, margin).join(texts.select(*key, F.col("id").alias("right_id"), "text"), [*key, "right_id"])
    said = near.groupBy(*key, "left_id").agg(F.array_join(F.sort_array(F.collect_list("text")), " ").alias("around"))
    joined = images.join(said.withColumnRenamed("left_id", "id"), [*key, "id"], "left")
    found = F.size(F.regexp_extract_all(F.coalesce("around", F.lit("")), F.lit(r"\b\d+(?:\.\d+)?%?"), F.lit(0)))
    return joined.withColumn("is_chart", found >= numbers).drop("around")


def is_small_image(kind: Column) -> Column:
    """Icons, rules and bullets; an image without a box is none."""
    return F.coalesce((kind == "image") & ((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")) < SMALL), F.lit(False))


def page_kind(native_chars: Column, images: Column) -> Column:
    """A page with little text of its own and images is read as one scanned image."""
    return F.when((native_chars < 100) & (images > 0), "scanned").when((native_chars == 0) & (images == 0), "blank").otherwise("native")


def median_size(sizes: Column) -> Column:
    """Upper median of the positive sizes; 12 without any."""
    ordered = F.sort_array(F.filter(sizes, lambda s: s > 0))
    return F.coalesce(F.get(ordered, F.floor(F.size(ordered) / 2).cast("int")), F.lit(12.0))


def _order(boxes: list[dict], width: float) -> list[int]:
    """Places of boxes in reading order; ties go by place. With two columns, boxes of both that
    start within 10 of each other are one row, read from the left."""
    n, left = len(boxes), {i for i, b in enumerate(boxes) if b["x0"] + b["x1"] < width}
    if n < 4 or not n < 4 * len(left) < 3 * n:
        return sorted(range(n), key=lambda i: (round(boxes[i]["y0"] / 5) * 5, boxes[i]["x0"]))
    columns = [[], []]
    for i in sorted(range(n), key=lambda i: (boxes[i]["y0"], boxes[i]["x0"])):
        columns[i not in left].append(i)
    out, at = [], [0, 0]
    while all(k < len(c) for k, c in zip(at, columns, strict=True)):
        gap = boxes[columns[0][at[0]]]["y0"] - boxes[columns[1][at[1]]]["y0"]
        for side in (0, 1) if abs(gap) < 10 else (int(gap > 0),):
            out.append(columns[side][at[side]])
            at[side] += 1
    return out + columns[0][at[0] :] + columns[1][at[1] :]


def reading_order(boxes: Column, width: Column) -> Column:
    """For a page's boxes (x0, y0, x1, y1): their places in reading order. A merge of two
    columns is a fold over the page, so an Arrow function does it for a batch of pages."""

    @F.arrow_udf("array<int>")
    def run(listed: pa.Array, widths: pa.Array) -> pa.Array:
        return pa.array([None if b is None else _order(b, w or 0.0) for b, w in zip(listed.to_pylist(), widths.to_pylist(), strict=True)], pa.list_(pa.int32()))

    return run(boxes, width.cast("double"))


def ocr_result(words: DataFrame, key: list[str], least: float = 0.60, few: int = 5) -> DataFrame:
    """Recognised words (text, confidence, language, at) joined; kept if sure enough or very short."""
    rows = words.groupBy(*key).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "text"))), lambda w: w["text"]), " ").alias("text"), F.avg("confidence").alias("confidence"), F.count(F.lit(1)).alias("word_count"), F.min_by("language", "at").alias("language"))
    return rows.withColumn("accepted", ~((F.col("confidence") < least) & (F.col("word_count") > few)))


def with_ocr(pages: DataFrame, results: DataFrame) -> DataFrame:
    """Pages with the recognised text where there is one."""
    found = results.where("accepted").select("doc_id", "page", F.col("text").alias("ocr"))
    return pages.join(found, ["doc_id", "page"], "left").withColumn("text", F.coalesce("ocr", "text")).drop("ocr")
