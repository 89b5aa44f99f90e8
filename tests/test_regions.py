"""Tables from boxes: cells of words, wrapped lines, spans, text around, several tables on a page."""

from quillspark.operators import regions
from quillspark.sources import pdf

SCHEMA = "doc_id string, page int, id int, x0 double, y0 double, x1 double, y1 double, text string"


def words(rows, top, lefts, step=20.0, page=1, doc="d"):
    """Boxes of the words of cells at the left sides of their columns."""
    out, top = [], float(top)
    for i, row in enumerate(rows):
        for left, cell in zip(lefts, row, strict=True):
            x = float(left)
            for word in (cell or "").split():
                out.append((doc, page, x, top + step * i, x + 5.0 * len(word), top + step * i + 9, word))
                x += 5.0 * len(word) + 4
    return out


def frame(spark, boxes):
    return spark.createDataFrame([(d, p, i, x0, y0, x1, y1, t) for i, (d, p, x0, y0, x1, y1, t) in enumerate(boxes)], SCHEMA)


CELLS = [["Name", "Dose", "Note"], ["alpha one", "5 mg", "first"], ["beta", "", "second word"], ["gamma", "7 mg", ""]]


def found(df):
    return {(r["doc_id"], r["page"], r["region"]): r["cells"] for r in df.collect()}


def test_cells_of_a_made_table(spark):
    boxes = words(CELLS, 100, (10, 120, 200), step=18)
    boxes += words([["A", "title", "here"]], 20, (10, 20, 50)) + words([["text"], ["of"], ["one"], ["column"]], 400, (10,), step=14)
    boxes += words([["1", "2"], ["3", "4"], ["5", "6"]], 600, (10, 90), step=15)
    boxes += [("d", 2, None, 1.0, 2.0, 3.0, "no box"), ("d", 2, 0.0, 0.0, 5.0, 9.0, " ")]
    got = found(regions.tables(regions.table_cells(frame(spark, boxes))))
    assert sorted(got.values(), key=len) == [[["1", "2"], ["3", "4"], ["5", "6"]], CELLS]


def test_wrapped_lines_and_spans(spark):
    boxes = words([["Name", "Dose", "Note"], ["alpha", "5 mg", "starts"]], 100, (10, 120, 200), step=14)
    boxes += words([["", "", "and goes on"]], 126, (10, 120, 200)) + words([["beta", "6 mg", "ends"]], 140, (10, 120, 200))
    boxes += [("d", 1, 120.0, 86.0, 240.0, 95.0, "both columns"), ("d", 1, 10.0, 86.0, 30.0, 95.0, "all")]
    cells = regions.table_cells(frame(spark, boxes))
    assert list(found(regions.tables(cells)).values()) == [[["all", "both columns", ""], ["Name", "Dose", "Note"], ["alpha", "5 mg", "starts and goes on"], ["beta", "6 mg", "ends"]]]
    assert {(r["row"], r["column"]): r["span"] for r in cells.collect() if r["span"] > 1} == {(0, 1): 2}


def test_boxes_become_table_elements(spark):
    boxes = words(CELLS, 100, (10, 120, 200), step=18) + words([["a", "plain", "line"]], 300, (10, 20, 50))
    rows = [(d, p, i, "text", x0, y0, x1, y1, t, None, None, None) for i, (d, p, x0, y0, x1, y1, t) in enumerate(boxes)] + [("d", 1, 99, "image", 0.0, 0.0, 9.0, 9.0, None, None, None, None)]
    got = regions.into_elements(spark.createDataFrame(rows, pdf.SCHEMA)).collect()
    tables = [r for r in got if r["kind"] == "table"]
    assert len(tables) == 1 and tables[0]["cells"] == CELLS and tables[0]["x0"] == 10.0
    assert sorted(r["text"] for r in got if r["kind"] == "text") == ["a", "line", "plain"] and sum(r["kind"] == "image" for r in got) == 1
    assert regions.into_elements(spark.createDataFrame([], pdf.SCHEMA)).collect() == []
