"""Text expressions, all native columns."""

from __future__ import annotations

import re
import string
import sys
import unicodedata
from collections.abc import Iterable
from functools import lru_cache

from pyspark.sql import Column, functions as F

# --- fixed values: words that mean "no value" -----------------------------------
NULL_WORDS = ["", "nan", "None", "<NA>"]
NULL_WORDS_ANY_CASE = ["", "nan", "none", "<na>"]
NULL_TOKENS_CSV = ["NULL", "", "nan"]
# --------------------------------------------------------------------------------


# every white-space character, for the native trim (a pattern would cost far more per row)
WHITE_SPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: str | Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.btrim(_col(c), F.lit(WHITE_SPACE))


def squish(c: str | Column) -> Column:
    """Trim and make every run of white space one blank."""
    return F.regexp_replace(strip(c), r"(?U)\s+", " ")


def drop_float_suffix(c: str | Column) -> Column:
    """Ids that went through a float column end in ``.0``."""
    return F.regexp_replace(strip(c), r"\.0$", "")


def null_words(c: str | Column, words: list[str] | None = None, any_case: bool = False) -> Column:
    """Trimmed text; null where it only spells a missing value."""
    text = strip(c)
    probe = F.lower(text) if any_case else text
    words = words if words is not None else (NULL_WORDS_ANY_CASE if any_case else NULL_WORDS)
    return F.when(~probe.isin(words), text)


def clean_identifier(c: str | Column) -> Column:
    return null_words(drop_float_suffix(c))


def clean_program_name(c: str | Column) -> Column:
    return null_words(squish(c))


def _literal_pattern(sep: str) -> str:
    return re.escape(sep)


def items(c: str | Column, sep: str = "|") -> Column:
    """Trimmed, non-empty parts of a delimited cell; null stays null."""
    parts = F.transform(F.split(_col(c), _literal_pattern(sep)), strip)
    return F.filter(parts, lambda x: x != "")


def first_item(c: str | Column, sep: str = "|") -> Column:
    """The text before the first separator, empty or not."""
    return strip(F.get(F.split(_col(c), _literal_pattern(sep)), F.lit(0)))


def first_filled_item(c: str | Column, sep: str = "|") -> Column:
    return F.get(items(c, sep), F.lit(0))


def explode_items(df, source: str, target: str, sep: str = "|", keep_empty: bool = True):
    """One row per part.  ``keep_empty`` leaves one null row for a cell without parts."""
    parts = items(source, sep)
    if keep_empty:
        return df.withColumn(target, F.explode_outer(F.when(F.size(parts) > 0, parts)))
    return df.withColumn(target, F.explode(parts))


def split_pair(df, source: str, left: str, right: str, sep: str):
    """Two columns from ``left<sep>right``; the second is null without the separator."""
    parts = F.split(_col(source), _literal_pattern(sep), 2)
    return df.withColumns({left: F.get(parts, F.lit(0)), right: F.get(parts, F.lit(1))})


def first_number(c: str | Column) -> Column:
    """First run of digits as an integer, null when there is none."""
    return F.regexp_extract(_col(c), r"(\d+)", 1).try_cast("int")


def whole_word(c: str | Column, word: str) -> Column:
    return F.lower(_col(c)).rlike(rf"\b{word}\b")


def plain_text(c: str | Column, *drop: str) -> Column:
    """The cell without the given literal fragments."""
    out = _col(c)
    for fragment in drop:
        out = F.replace(out, F.lit(fragment), F.lit(""))
    return out


def truncate(c: str | Column, width: int) -> Column:
    return F.substring(_col(c), 1, width)


def value_map(c: str | Column, mapping: dict, default=None) -> Column:
    out = F.lit(default)
    for key, value in reversed(list(mapping.items())):
        out = F.when(_col(c) == F.lit(key), F.lit(value)).otherwise(out)
    return out


_NOT_ALNUM = r"[^a-z0-9]+"


@lru_cache(maxsize=1)
def _folding() -> tuple[str, str, dict[str, str]]:
    """What compatibility decomposition makes of single characters, without accents and case.

    Characters and what ``translate`` puts for them, those without one go; and the characters that become
    several.  Characters without a letter or digit of the alphabet in them are in neither.
    """
    one, none, several = {c: c.lower() for c in string.ascii_uppercase}, [], {}
    for c in map(chr, (*range(0x80, 0xD800), *range(0xE000, sys.maxunicode + 1))):
        plain = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x)).lower()
        folded = re.sub(_NOT_ALNUM, " ", plain)
        if not plain:
            none.append(c)
        elif len(folded) > 1:
            several[c] = folded
        elif folded != " ":
            one[c] = folded
    return "".join([*one, *none]), "".join(one.values()), several


def _ranges(characters: Iterable[str]) -> str:
    """Runs of neighbours for a character class, which takes far longer over single characters."""
    codes = sorted(map(ord, characters))
    firsts = [i for i in codes if i - 1 not in codes]
    lasts = [i for i in codes if i + 1 not in codes]
    return "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in zip(firsts, lasts))


def normalise_title(c: str | Column) -> Column:
    """Fold accents and case, keep letters and digits, one blank between words; null is empty.

    Compatibility decomposition works on single characters but for the order of accents, which go, so a
    native translation does it, and no text passes through Python.
    """
    source, target, several = _folding()
    marked = "[" + "".join(several) + "]"  # one by one: a look behind at ranges splits characters beyond 16 bits
    table = F.create_map(*[F.lit(x) for pair in several.items() for x in pair])
    pieces = F.split(F.coalesce(_col(c), F.lit("")), f"(?<={marked})|(?={marked})")
    spelt = F.array_join(F.transform(pieces, lambda p: F.coalesce(F.try_element_at(table, p), p)), "")
    text = F.when(_col(c).rlike(rf"[\x{{80}}-\x{{10ffff}}&&[{_ranges(several)}]]"), spelt).otherwise(F.coalesce(_col(c), F.lit("")))
    return F.btrim(F.regexp_replace(F.translate(text, source, target), _NOT_ALNUM, " "), F.lit(" "))


def with_normalised(df, source: str, target: str):
    """Add the normalised title, computed once per distinct value.

    Only distinct titles are normalised; the join back is null-safe and leaves the
    choice of broadcast or shuffle to the measured size of the title table.
    """
    titles = df.select(F.col(source).alias("_title")).distinct()
    titles = titles.withColumn(target, normalise_title("_title"))
    return df.join(titles, df[source].eqNullSafe(titles["_title"]), "left").drop("_title")


# --- fixed values: programme codes, tried in this order -------------------------
PROGRAM_PREFIXES = {
    "PBA-TIN": "Toegepaste Informatica",
    "PBA-SO": "Sociaal Werk",
    "PBA-VPK": "Verpleegkunde",
    "PBA-VOE": "Voedings- en Dieetkunde",
    "PBA-ERGO": "Ergotherapie",
    "PBA-LO": "Lager Onderwijs",
    "PBA-KO": "Kleuteronderwijs",
    "PBA-SOLO": "Secundair Onderwijs",
}
IT_PATTERNS = ["PBA-TIN", "TOEGEPASTE INFORMATICA", "APPLIED COMPUTER SCIENCE", "IC IT"]
IT_PROGRAM = "Toegepaste Informatica"
IT_FACULTY_PHRASES = ["toegepaste informatica", "ic it"]
# --------------------------------------------------------------------------------


def program_family(c: str | Column, upper: bool = False) -> Column:
    """The part of a programme name before the first slash."""
    family = strip(F.get(F.split(strip(c), "/"), F.lit(0)))
    return F.upper(family) if upper else family


def contains_any(c: str | Column, phrases: list[str]) -> Column:
    out = F.lit(False)
    for phrase in phrases:
        out = out | _col(c).contains(phrase)
    return out


def study_program(
    c: str | Column,
    prefixes: dict[str, str] | None = None,
    it_patterns: list[str] | None = None,
    longest_first: bool = False,
) -> Column:
    """Readable programme of a code: first matching prefix, else an IT phrase, else null.

    The default order is the fixed one above, in which a short prefix can hide a longer
    one; ``longest_first`` tries long prefixes first.
    """
    prefixes = prefixes or PROGRAM_PREFIXES
    order = sorted(prefixes, key=len, reverse=True) if longest_first else list(prefixes)
    code = F.upper(_col(c))
    out = F.when(contains_any(code, it_patterns or IT_PATTERNS), F.lit(IT_PROGRAM))
    for prefix in reversed(order):
        out = F.when(code.startswith(prefix), F.lit(prefixes[prefix])).otherwise(out)
    return out


def is_it_faculty(c: str | Column) -> Column:
    """True where a faculty text names the IT programme; null counts as no."""
    return F.coalesce(contains_any(F.lower(strip(c)), IT_FACULTY_PHRASES), F.lit(False))
