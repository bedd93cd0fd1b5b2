"""Text clean-up expressions (built-in functions, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.functions.util import as_column

# --- fixed values: clean-up steps, applied in this order --------------------
#: Runs of what ends up as blanks: blanks, tags, hard spaces. The class in front
#: turns away every other position at once; a run of one kind stays in its inner loop.
GAPS = r"(?=[\s<&])(?:\s+|(?:<[^>]*>)++|(?:&nbsp;)++|(?:&#160;)++)++"
BLANKS = r"\s+"
ENTITIES = (("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&"))
# ---------------------------------------------------------------------------


def clean_text(text: Column | str) -> Column:
    """Strip tags, decode a few entities, collapse whitespace and trim.

    Null becomes ``''``. Each step runs once, so ``&amp;quot;`` ends up as
    ``&quot;`` and ``&lt;`` stays. ``trim`` removes spaces only.

    Tags, hard spaces and blanks all end up as one space, so a run of them is
    one match of one pass, however they are mixed: none of them can come out of
    the others' removal. The possessive groups are loops of the regex engine,
    where plain ones recurse once per repetition and overflow the task's stack
    on a text with some thousands of tags in a row. The other entities are fixed
    texts and take no pattern. Without ``<`` and ``&`` all gaps are blanks.
    """
    value = F.coalesce(as_column(text), F.lit(""))
    marked = F.contains(value, F.lit("<")) | F.contains(value, F.lit("&"))
    value = F.when(marked, F.regexp_replace(value, GAPS, " ")).otherwise(F.regexp_replace(value, BLANKS, " "))
    for entity, plain in ENTITIES:
        value = F.replace(value, F.lit(entity), F.lit(plain))
    return F.trim(value)


def blank_to_null(text: Column | str) -> Column:
    """``clean_text`` that turns an empty result into null.

    ``nullif`` evaluates the cleaned text once (a ``when(length(x) > 0, x)``
    would run the regex chain twice per row).
    """
    return F.nullif(clean_text(text), F.lit(""))


def normalise(text: Column | str) -> Column:
    """Lower case after trimming spaces (grouping labels)."""
    return F.lower(F.trim(as_column(text)))


def is_blank(text: Column | str) -> Column:
    """True when null or empty after trimming spaces."""
    column = as_column(text)
    return column.isNull() | (F.length(F.trim(column.cast("string"))) == 0)
