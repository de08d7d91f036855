"""Text cleaning as Column expressions; nothing here leaves the JVM."""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space when text is stripped.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)

# Texts that a spreadsheet reader treats as "no value".
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def canonical_name(label: object) -> str:
    """UPPER_SNAKE_CASE form of one header or sheet name (schema metadata only).

    The same rule as :func:`canonical_label`, for the few labels the driver or a
    reader task holds as Python strings.
    """
    decomposed = unicodedata.normalize("NFKD", "" if label is None else str(label))
    plain = "".join(ch for ch in decomposed if not unicodedata.combining(ch))
    return "_".join(re.findall("[A-Z0-9]+", plain.upper()))


_ASCII = r"\A\p{ASCII}*\z"


@lru_cache(maxsize=1)
def _accent_tables() -> tuple[str, str, str, dict[str, str]]:
    """Compatibility foldings into ASCII, derived from the Unicode database.

    Returns the single-letter sources and targets, the combining marks, and the
    characters that unfold into several letters (ligatures, fractions, units).
    """
    sources, targets, marks, unfolded = [], [], [], {}
    for point in range(0x80, sys.maxunicode + 1):
        char = chr(point)
        if unicodedata.combining(char):
            marks.append(char)
            continue
        plain = "".join(
            ch for ch in unicodedata.normalize("NFKD", char) if not unicodedata.combining(ch)
        )
        if not re.search("[A-Za-z0-9]", plain):
            continue  # ends up as a separator either way
        if len(plain) == 1:
            sources.append(char)
            targets.append(plain)
        else:
            unfolded[char] = plain
    return "".join(sources), "".join(targets), "".join(marks), unfolded


def canonical_label(label: Column) -> Column:
    """UPPER_SNAKE_CASE label: accents folded, other runs become one underscore.

    ASCII labels skip the folding branch; null becomes the empty label.
    """
    sources, targets, marks, unfolded = _accent_tables()
    text = F.coalesce(label, F.lit(""))
    table = F.create_map(*[F.lit(part) for pair in unfolded.items() for part in pair])
    folded = F.translate(text, sources + marks, targets)
    spread = F.array_join(
        F.transform(F.split(folded, ""), lambda ch: F.coalesce(F.try_element_at(table, ch), ch)), ""
    )
    plain = (
        F.when(text.rlike(_ASCII), text)
        .when(folded.rlike(_ASCII), folded)
        .otherwise(spread)
    )
    return F.trim(F.regexp_replace(F.upper(plain), "[^A-Z0-9]+", "_"), F.lit("_"))


def trim_text(text: Column) -> Column:
    """Strip Unicode white space from both ends (Spark's ``trim`` strips spaces only)."""
    return F.trim(text, F.lit(WHITESPACE))


def blank_to_null(text: Column) -> Column:
    """Null for text that holds nothing but white space; other text unchanged."""
    return F.when(trim_text(text) != "", text)


def clean_text(text: Column) -> Column:
    """Trim, then turn blank text into null."""
    return F.nullif(trim_text(text), F.lit(""))


def missing_to_null(text: Column) -> Column:
    """Null for the texts a spreadsheet reader treats as "no value" (exact match)."""
    return F.when(~text.isin(*MISSING_TOKENS), text)


def whole_identifier(text: Column) -> Column:
    """Identifier text without the decimals a spreadsheet adds: ``219175.0`` is ``219175``."""
    decimal = text.rlike(r"^-?[0-9\p{Nd}]+\.0+\z")
    return F.when(decimal, F.substring_index(text, ".", 1)).otherwise(text)


def identifier(value: Column) -> Column:
    """Identifier text of any value: trimmed, blank to null, added decimals dropped."""
    return whole_identifier(clean_text(value.cast("string")))


def lower_columns(frame):
    """Lower-case every column name, as the published SQL table has them."""
    return frame.toDF(*[name.lower() for name in frame.columns])
