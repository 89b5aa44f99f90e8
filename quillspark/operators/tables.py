"""Tables that were found on pages: rows of cells to Markdown and plain text.
Cells are array<array<string>>; all steps are higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clean_cell, let

#: Words that headers of tables use.
HEADER_WORDS = r"(?i)\b(id|no|name|date|type|code|status|value|total|count|description|category|item|ref|result|unit|parameter|subject|dose|group|visit|day|week|month|year)\b"
LEAST_CHARS, SUMMARY_CHARS = 150, 50


def clean_rows(cells: Column) -> Column:
    """Cleaned cells, without rows that are empty."""
    cleaned = F.transform(cells, lambda row: F.transform(row, lambda c: clean_cell(c)))
    return F.filter(cleaned, lambda row: F.exists(row, lambda c: c != ""))


def _cell(row: Column, i: Column) -> Column:
    return F.coalesce(F.get(row, i), F.lit(""))


def _width(rows: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(rows, lambda r: F.size(r))), F.lit(0))


def fill_merged(rows: Column) -> Column:
    """Empty cells take the last value above them in their column. This also fills cells
    that are really empty, on purpose, as merged ones cannot be told apart."""

    def column(rows: Column, i: Column) -> Column:
        """A column's cells, made of runs that start with each of its values, so that a cell is looked at once."""
        starts = F.filter(F.sequence(F.lit(0), F.size(rows) - 1), lambda n: (n == 0) | (_cell(F.get(rows, n), i) != ""))
        length = lambda s, n, k: F.coalesce(F.get(s, k + 1), F.size(rows)) - n
        return let(starts, lambda s: F.flatten(F.transform(s, lambda n, k: F.array_repeat(_cell(F.get(rows, n), i), length(s, n, k)))))

    def filled(rows: Column) -> Column:
        columns = F.transform(F.sequence(F.lit(0), _width(rows) - 1), lambda i: column(rows, i))
        return let(columns, lambda c: F.transform(rows, lambda row, n: F.transform(c, lambda column: F.get(column, n))))

    return let(rows, lambda r: F.when(_width(r) > 0, filled(r)).otherwise(r))


def forward_fill(df: DataFrame, partition: str, order: str, columns: list[str]) -> DataFrame:
    """The same over rows of a table: the last value that is not blank, by column."""
    w = Window.partitionBy(partition).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.coalesce(F.last(F.nullif(F.col(c), F.lit("")), ignorenulls=True).over(w), F.lit("")) for c in columns})


def _average(values: Column) -> Column:
    total = F.aggregate(values, F.lit(0.0), lambda s, x: s + x)
    return total / F.greatest(F.size(values), F.lit(1))


def _cell_length(row: Column) -> Column:
    return _average(F.transform(row, lambda c: F.length(c).cast("double")))


def has_header(rows: Column) -> Column:
    """The first row has no blank and is short beside the body, or uses words of headers.
    With one column no such word is needed, on purpose."""

    def test(rows: Column) -> Column:
        first = F.element_at(rows, 1)
        body = _average(F.transform(_rest(rows), _cell_length))
        own = _cell_length(first)
        words = F.size(F.filter(first, lambda c: c.rlike(HEADER_WORDS)))
        signs = ((own < body * 1.5) & (own < 60)) | (words >= F.floor(F.size(first) / 2))
        return F.when(F.size(rows) < 2, False).otherwise(~F.exists(first, lambda c: c == "") & signs)

    return let(rows, test)


def _rest(rows: Column) -> Column:
    return F.slice(rows, F.lit(2), F.greatest(F.size(rows) - 1, F.lit(0)))


def to_markdown(rows: Column, header: Column) -> Column:
    """Padded columns; pipes in cells stay as they are. Without a header the columns are numbered."""

    def shown(rows: Column) -> Column:
        names = F.transform(F.sequence(F.lit(1), _width(rows)), lambda i: F.concat(F.lit("Col"), i.cast("string")))
        return let(F.when(header, rows).otherwise(F.concat(F.array(names), rows)), lambda all_: let(_widths(all_), lambda widths: lines(all_, widths)))

    def _widths(all_: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), _width(all_) - 1), lambda i: F.greatest(F.lit(3), F.array_max(F.transform(all_, lambda r: F.length(_cell(r, i))))))

    def lines(all_: Column, widths: Column) -> Column:
        line = lambda row: F.concat(F.lit("| "), F.array_join(F.transform(widths, lambda w, i: F.rpad(_cell(row, i), w, F.lit(" "))), " | "), F.lit(" |"))
        rule = F.concat(F.lit("|"), F.array_join(F.transform(widths, lambda w: F.repeat(F.lit("-"), w + 2)), "|"), F.lit("|"))
        return let(F.transform(all_, line), lambda x: F.array_join(F.concat(F.slice(x, 1, 1), F.array(rule), _rest(x)), "\n"))

    return let(rows, lambda r: F.when(F.size(r) > 0, shown(r)).otherwise(""))


def to_plain(rows: Column, header: Column) -> Column:
    """A line for each row with its cells behind their headers; blank cells are left out."""

    def shown(rows: Column) -> Column:
        head = F.when(header, F.element_at(rows, 1)).otherwise(F.array().cast("array<string>"))
        return let(head, lambda h: lines(F.when(header, _rest(rows)).otherwise(rows), h))

    def lines(body: Column, head: Column) -> Column:
        name = lambda i: F.coalesce(F.nullif(F.get(head, i), F.lit("")), F.concat(F.lit("Col"), (i + 1).cast("string")))
        line = lambda row: F.array_join(F.filter(F.transform(row, lambda c, i: F.when(c != "", F.concat(name(i), F.lit(": "), c))), lambda x: x.isNotNull()), " | ")
        return F.array_join(F.filter(F.transform(body, line), lambda x: x != ""), "\n")

    return let(rows, lambda r: F.when(F.size(r) > 0, shown(r)).otherwise(""))


def best_text(markdown: Column, summary: Column, plain: Column) -> Column:
    with_summary = F.when(F.coalesce(summary, F.lit("")) != "", F.concat(markdown, F.lit("\n\n[TABLE SUMMARY]\n"), summary)).otherwise(markdown)
    return F.when(F.coalesce(markdown, F.lit("")) != "", with_summary).otherwise(plain)


def process_tables(tables: DataFrame) -> DataFrame:
    """Tables (cells) with their texts; those with little text are dropped."""
    rows = tables.withColumn("rows", fill_merged(clean_rows(F.col("cells")))).where(F.size("rows") > 0)
    rows = rows.withColumn("has_header", has_header(F.col("rows")))
    rows = rows.withColumns({"markdown": to_markdown(F.col("rows"), F.col("has_header")), "plain_text": to_plain(F.col("rows"), F.col("has_header"))})
    return rows.where((F.length("markdown") >= LEAST_CHARS) | (F.length("plain_text") >= LEAST_CHARS)).withColumns({"row_count": F.size("rows"), "col_count": F.array_max(F.transform("rows", lambda r: F.size(r)))})


def into_elements(elements: DataFrame, tables: DataFrame) -> DataFrame:
    """Table elements of a page take the texts of its tables in order; those left over become empty."""
    w = Window.partitionBy("doc_id", "page").orderBy("ordinal")
    own = elements.withColumn("nth", F.when(F.col("kind") == "table", F.sum((F.col("kind") == "table").cast("int")).over(w) - 1))
    texts = tables.select("doc_id", "page", F.col("table_index").alias("nth"), F.col("best_text").alias("t"))
    joined = own.join(texts, ["doc_id", "page", "nth"], "left")
    return joined.withColumn("text", F.when(F.col("kind") == "table", F.coalesce("t", F.lit(""))).otherwise(F.col("text"))).select(elements.columns)
