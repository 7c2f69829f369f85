"""Text functions: keys, extraction, remapping, tagging, parsing, coercion."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.columns import any_of, as_col


def concat_key(cols: list[str], sep: str = "_") -> Column:
    """Columns joined as text; a null is written 'nan' so that key positions stay fixed."""
    return F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("nan")) for c in cols])


def extract(c: str | Column, pattern: str, group: int = 1) -> Column:
    """Regular-expression group, null when there is no match."""
    return F.nullif(F.regexp_extract(as_col(c), pattern, group), F.lit(""))


def split_part(c: str | Column, sep: str, index: int) -> Column:
    """Part of a split text; index counts from 1, or from the end when negative."""
    return F.try_element_at(F.split(as_col(c), sep), F.lit(index))


def cut_suffix(c: str | Column, suffix_pattern: str) -> Column:
    """Remove a suffix where it is present, keep the text otherwise."""
    return F.regexp_replace(as_col(c), f"{suffix_pattern}$", "")


def remap(c: str | Column, mapping: dict[str, str]) -> Column:
    """Replace values found in a small fixed mapping, keep the others."""
    pairs = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.coalesce(F.try_element_at(pairs, as_col(c)), as_col(c))


def keyword_tag(c: str | Column, keywords: list[str]) -> Column:
    """The last keyword of the list contained in the text, ignoring case; null if none is."""
    text = F.lower(as_col(c))
    tag = F.lit(None).cast("string")
    for word in keywords:
        tag = F.when(text.contains(word.lower()), F.lit(word)).otherwise(tag)
    return tag


def matches_any_column(cols: list[str], pattern: str) -> Column:
    """Regular expression found in at least one column."""
    return any_of(F.coalesce(F.col(c).rlike(pattern), F.lit(False)) for c in cols)


def contains_any_column(cols: list[str], text: str) -> Column:
    """Text found in at least one column, ignoring case."""
    needle = text.strip().lower()
    return any_of(
        F.coalesce(F.lower(F.col(c).cast("string")).contains(needle), F.lit(False)) for c in cols
    )


def clean_list(c: str | Column) -> Column:
    """Text list without blanks, empty members and 'nan', members trimmed."""
    parts = F.transform(F.split(as_col(c), ","), lambda x: F.trim(x))
    return F.concat_ws(",", F.filter(parts, lambda x: (x != "") & (x != "nan")))


def name_value(line: str | Column) -> tuple[Column, Column]:
    """A line split at its last blank into a name and a value (currency sign dropped)."""
    text = F.trim(as_col(line))
    name = F.nullif(F.regexp_extract(text, r"^(.*) (\S+)$", 1), F.lit(""))
    value = F.nullif(F.regexp_extract(text, r"^(.*) (\S+)$", 2), F.lit(""))
    return name, F.regexp_replace(value, r"^\$", "")


def to_number(c: str | Column) -> Column:
    return as_col(c).try_cast("double")


def to_integer(c: str | Column) -> Column:
    return as_col(c).try_cast("bigint")


def is_integer_text(c: str | Column) -> Column:
    return as_col(c).try_cast("bigint").isNotNull()
