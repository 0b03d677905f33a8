"""Course attributes from a table of HTML pages, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# --- fixed values: element ids and markers of a course page --------------------------
YEAR_ID = "ctl00_ctl00_cphGeneral_cphMain_lblAcademiejaarOmschrijving"
TITLE_ID = "ctl00_ctl00_cphGeneral_cphMain_dStudiegidsTitle"
CREDITS_ID = "ctl00_ctl00_cphGeneral_cphMain_lblInhoudStudieomvang"
FACULTY_MARKER = "Komt voor in"
EVALUATION_MARKER = "Evaluatie"
SECOND_CHANCE_MARKER = "Tweede examenkans: "
CODE_PATTERN = r"a=(\d+)&"
# -------------------------------------------------------------------------------------


def _found(text: Column) -> Column:
    return F.when(text != "", text)


def plain(c: Column) -> Column:
    """Text of a fragment: tags out, the common entities decoded, white space trimmed."""
    out = F.regexp_replace(c, r"(?s)<[^>]*>", "")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return F.trim(out)


def element(html: str, tag: str, element_id: str | None = None) -> Column:
    """Text of the first element with the tag, and id if given; null when absent."""
    attrs = rf'[^>]*\bid="{element_id}"[^>]*' if element_id else r"[^>]*"
    return _found(plain(F.regexp_extract(html, rf"(?is)<{tag}\b{attrs}>(.*?)</{tag}>", 1)))


def list_items(fragment: Column) -> Column:
    """Texts of the list items, nested blocks left out."""
    without_blocks = F.regexp_replace(fragment, r"(?is)<div\b.*?</div>", "")
    return F.transform(F.regexp_extract_all(without_blocks, F.lit(r"(?is)<li\b[^>]*>(.*?)</li>"), 1), plain)


def items_after(html: str, marker: str | None) -> Column:
    """Items of the first list after a marker (or of the page's first list)."""
    lead = rf".*?{marker}" if marker else ""
    return list_items(F.regexp_extract(html, rf"(?is)^{lead}.*?<ul\b[^>]*>(.*?)</ul>", 1))


def table_rows(html: str, marker: str) -> Column:
    """Cells of all rows with three cells or more in the tables after a marker."""
    after = F.regexp_extract(html, rf"(?is){marker}(.*)$", 1)
    rows = F.regexp_extract_all(after, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), 1)
    cells = F.transform(
        rows, lambda r: F.transform(F.regexp_extract_all(r, F.lit(r"(?is)<td\b[^>]*>(.*?)</td>"), 1), plain)
    )
    return F.transform(
        F.filter(cells, lambda c: F.size(c) >= 3),
        lambda c: F.struct(
            F.get(c, F.lit(0)).alias("moment"), F.get(c, F.lit(1)).alias("format"), F.get(c, F.lit(2)).alias("percentage")
        ),
    )


def page_code(url: str, pattern: str = CODE_PATTERN) -> Column:
    return _found(F.regexp_extract(url, pattern, 1))


def course_pages(pages: DataFrame, url: str = "url", html: str = "html", code: str = CODE_PATTERN, keep: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """One row per course page; ``code`` is the pattern of the course code in the address, ``keep`` names columns to pass on."""
    second = F.regexp_extract(html, rf"(?is){SECOND_CHANCE_MARKER}\s*</span>.*?<span\b[^>]*>(.*?)</span>", 1)
    return pages.select(
        *keep,
        element(html, "span", YEAR_ID).alias("year"),
        items_after(html, FACULTY_MARKER).alias("faculties"),
        element(html, "h2", TITLE_ID).alias("title"),
        page_code(url, code).alias("code"),
        element(html, "span", CREDITS_ID).alias("credits"),
        table_rows(html, EVALUATION_MARKER).alias("evaluation_methods"),
        _found(plain(second)).alias("second_chance"),
    )
