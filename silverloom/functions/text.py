"""Text clean-up, typed parsing, JSON picks, slugs."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import as_column


def blank_to_null(c) -> Column:
    """Text form without outer blanks; null when nothing is left."""
    return F.nullif(F.trim(as_column(c).cast("string")), F.lit(""))


def typed(c, data_type: str, strict: bool = False) -> Column:
    """:func:`blank_to_null`, then a cast: bad text is null, or an error when ``strict``."""
    text = blank_to_null(c)
    return text.cast(data_type) if strict else text.try_cast(data_type)


def grouped_number(c, data_type: str = "decimal(38,6)", strict: bool = False) -> Column:
    """``1,234.5`` -> 1234.5"""
    text = F.replace(as_column(c).cast("string"), F.lit(","), F.lit(""))
    return text.cast(data_type) if strict else text.try_cast(data_type)


def digits_number(c, data_type: str = "decimal(38,0)") -> Column:
    """Only the digits count; sign and point are lost; null when there is no digit."""
    return F.nullif(F.regexp_replace(as_column(c), "[^0-9]", ""), F.lit("")).cast(data_type)


def capture(c, pattern: str, group: int = 1) -> Column:
    """First regex match, null when there is none."""
    return F.nullif(F.regexp_extract(as_column(c), pattern, group), F.lit(""))


def capture_all(c, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(as_column(c), F.lit(pattern), F.lit(group))


def prefer_unlike(c, pattern: str) -> Column:
    """0 when the text does not match the pattern (any case), else 1; null counts as 1."""
    return F.when(~as_column(c).ilike(pattern), 0).otherwise(1)


def localised(c, *languages: str) -> Column:
    """First filled language of a JSON object ``{"vi_VN": ..., "en_US": ...}``."""
    return F.coalesce(*[F.get_json_object(as_column(c), f"$.{lang}") for lang in languages])


def json_or_text(c, key: str) -> Column:
    """A field of the JSON object when the text starts with ``{``, else the text."""
    text = as_column(c)
    return F.when(text.startswith("{"), F.get_json_object(text, f"$.{key}")).otherwise(text)


def slug(c) -> Column:
    """Lower case; runs of blanks and dashes to ``_``; other signs dropped; no leading digit."""
    text = F.regexp_replace(F.lower(as_column(c)), "[ -]+", "_")
    text = F.regexp_replace(text, "[^a-z0-9_]+", "")
    return F.regexp_replace(text, "^([0-9])", "_$1")


def slug_name(name: str) -> str:
    """:func:`slug` for one name, used for column aliases."""
    name = re.sub("[^a-z0-9_]+", "", re.sub("[ -]+", "_", name.lower()))
    return "_" + name if name[:1].isdigit() else name
