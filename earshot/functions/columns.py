"""Column expressions. All are built-in Spark expressions, so they stay in the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def scale_rating(count: Column, scale: str = "log2") -> Column:
    """Play count to rating: ``min(5, log2(count) + 1)``, or the count itself with ``raw``."""
    if scale == "log2":
        return F.least(F.lit(5.0), F.log2(count.cast("double")) + F.lit(1.0))
    if scale == "raw":
        return count.cast("double")
    raise ValueError(f"unknown scale {scale!r}; use 'log2' or 'raw'")


def strip_commas(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit(""))


def nan_to_null(text: Column) -> Column:
    """The text ``nan`` (any case) and the empty text become NULL."""
    trimmed = F.trim(text)
    return F.when(~F.lower(trimmed).isin("nan", ""), trimmed)


def nan_number_to_null(number: Column) -> Column:
    return F.when(~F.isnan(number), number)


def to_number(text: Column, type_name: str = "double") -> Column:
    """Text to number; ``nan``, empty and malformed text become NULL."""
    return nan_to_null(text).try_cast(type_name)


def unwrap_bytes(text: Column) -> Column:
    """``b'name'`` or ``b"name"`` becomes ``name``; other text is left alone."""
    pattern = r"""(?s)^b(['"])(.*)\1$"""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, 2)).otherwise(text)


def file_stem(path: Column) -> Column:
    """File name up to its first dot, without the folders."""
    return F.substring_index(F.substring_index(path, "/", -1), ".", 1)


def words(text: Column) -> Column:
    """Lower-case words of letters, marks, digits and ``_`` in any script; the ends may be empty."""
    return F.split(F.lower(text), r"[^\p{L}\p{M}\p{N}_]+")


def canonical(items: Column) -> Column:
    """An itemset in its one sorted order."""
    return F.array_sort(items)


def dot(weights: Column, features: list[Column]) -> Column:
    """Weights array times feature columns, unrolled so that it is compiled."""
    total = weights[0] * features[0]
    for position, feature in enumerate(features[1:], start=1):
        total = total + weights[position] * feature
    return total


def parse_attrs(attributes: str) -> list[str]:
    """``"Title, Tempo"`` to ``["title", "tempo"]``."""
    return [name for name in re.split(r"\W+", attributes.lower()) if name]
