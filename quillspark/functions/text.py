"""Cleaning, trimming and measuring text. All JVM-side; white space is Unicode's
where Python's would be, which Java asks for by ``(?U)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"


def strip(c: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def clean_text(c: Column) -> Column:
    """Text of a page: pilcrows and control characters to spaces, soft hyphens out,
    at most one blank line in a row, single spaces."""
    c = F.regexp_replace(F.regexp_replace(c, "¶", " "), "­", "")
    c = F.regexp_replace(F.regexp_replace(c, r"\n{3,}", "\n\n"), CONTROL, " ")
    return strip(F.regexp_replace(c, r"[ \t]+", " "))


def clean_cell(c: Column, most: int | None = 500) -> Column:
    """Text of a table cell on one line, cut with an ellipsis beyond ``most`` characters (None: whole)."""
    c = F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), "¶", " "), "­", "")
    c = F.regexp_replace(F.regexp_replace(c, r"[\r\n\t]+", " "), r" {2,}", " ")
    c = strip(F.regexp_replace(c, CONTROL, ""))
    if most is None:
        return c
    return let(c, lambda x: F.when(F.length(x) > most, F.concat(F.substring(x, 1, most - 3), F.lit("…"))).otherwise(x))


def clean_ocr(c: Column) -> Column:
    """Recognised text without lines of noise: a line of three characters or more needs two letters."""
    lines = F.transform(F.split(c, "\n"), strip)
    letters = lambda x: F.length(F.regexp_replace(x, r"[^\p{L}]", ""))
    kept = F.filter(lines, lambda x: (F.length(x) < 3) | (letters(x) >= 2))
    joined = F.regexp_replace(F.array_join(kept, "\n"), CONTROL, "")
    return strip(F.regexp_replace(F.regexp_replace(joined, r"[ \t]{2,}", " "), r"\n{3,}", "\n\n"))


def paragraph_key(c: Column) -> Column:
    return F.lower(strip(F.regexp_replace(c, r"(?U)\s+", " ")))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body with the value bound to a name, so that it is computed once, also within lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def dedup_paragraphs(c: Column, separator: str = r"\n{2,}", joiner: str = "\n\n") -> Column:
    """First occurrence of each paragraph, compared without case and spacing, as written.

    Keys are sorted with their places, so a text costs n log n of its paragraphs.
    """
    keyed = F.transform(F.split(c, separator), lambda p, i: F.struct(paragraph_key(p).alias("k"), i.alias("i"), p.alias("p")))
    ordered = F.sort_array(F.filter(keyed, lambda x: x["k"] != ""))
    firsts = let(ordered, lambda s: F.filter(s, lambda x, i: (i == 0) | (x["k"] != F.get(s, i - 1)["k"])))
    in_place = F.sort_array(F.transform(firsts, lambda x: F.struct(x["i"], x["p"])))
    return F.array_join(F.transform(in_place, lambda x: x["p"]), joiner)


def with_section(text: Column, title: Column) -> Column:
    """The title and a blank line before the text, unless it already starts with the title."""
    plain = lambda x: F.lower(strip(x))
    has = F.coalesce(title, F.lit("")) == ""
    return F.when(has | F.startswith(plain(text), plain(title)), text).otherwise(F.concat(title, F.lit("\n\n"), text))


def estimate_tokens(c: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(F.length(c) / 4).cast("int"))


def _last(c: Column, what: str) -> Column:
    """0-based place of the last occurrence, or -1."""
    back = F.instr(F.reverse(c), what[::-1])
    return F.when(back > 0, F.length(c) - back - len(what) + 1).otherwise(F.lit(-1))


def truncate_tokens(c: Column, most_tokens: int = 6000) -> Column:
    """Cut to about so many tokens, at a paragraph or a sentence if one ends late enough."""
    most = most_tokens * 4
    head = F.substring(c, 1, most)
    blank = _last(head, "\n\n")
    dot = F.greatest(_last(head, ". "), _last(head, ".\n"))
    cut = F.when(blank > most * 0.7, F.substring(head, F.lit(1), blank)).when(dot > most * 0.5, F.substring(head, F.lit(1), dot + 1)).otherwise(head)
    return F.when(estimate_tokens(c) <= most_tokens, c).otherwise(strip(cut))


def path_slashes(c: Column) -> Column:
    return F.replace(c, F.lit("\\"), F.lit("/"))


def file_url(c: Column) -> Column:
    """A file URL for a network share or a drive path; other paths stay, blanks become empty."""
    c = strip(F.coalesce(c, F.lit("")))
    slashed = path_slashes(c)
    return F.when(c == "", "").when(F.startswith(slashed, F.lit("//")), F.concat(F.lit("file://"), slashed)).when(slashed.rlike(r"^[A-Za-z]:/"), F.concat(F.lit("file:///"), slashed)).otherwise(c)


def path_id(c: Column) -> Column:
    return F.sha2(c, 256)


def chunk_id(doc_id: Column, index: Column) -> Column:
    return F.sha2(F.concat(doc_id, F.lit("::chunk::"), F.format_string("%06d", index)), 256)


def csv_guard(c: Column) -> Column:
    """A cell that no spreadsheet reads as a formula; nulls become empty."""
    c = F.coalesce(c, F.lit(""))
    return F.when(F.regexp_replace(c, r"(?U)^\s+", "").rlike(r"^[=+\-@]"), F.concat(F.lit("'"), c)).otherwise(c)


#: Fixed value: what a line is that may be a heading.
HEADING = (
    r"(?im)\A\s*(\d+(\.\d+){0,3}\s+[A-Z][^\n]{0,100}|[A-Z][A-Z\s\-]{3,50}|(SECTION|CHAPTER|ANNEX|APPENDIX|PART|SCHEDULE)\s+\w[^\n]{0,80}"
    r"|(Executive Summary|Introduction|Conclusion|References|Background|Objectives?|Methods?|Results?|Discussion|Summary|Overview"
    r"|Efficacy|Safety|Pharmacokinetics|Pharmacodynamics|Clinical|Preclinical|Regulatory|Administrative)[^\n]{0,80})\s*$"
)


def is_page_heading(c: Column) -> Column:
    """A short element that reads as a heading. Case is ignored, on purpose: any short
    line of letters counts, as it does for the documents chunked before."""
    t = strip(F.coalesce(c, F.lit("")))
    return (t != "") & (F.length(t) <= 150) & t.rlike(HEADING)
