"""Statistics of a text as column expressions, for rules to stand on."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pondside.llm.common import WORD


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0).cast("double")


def statistics(text: Column) -> dict[str, Column]:
    """Name and expression of each statistic; 0 where there is nothing to count. Every one reads the whole text."""
    text = F.coalesce(text, F.lit(""))
    chars = F.length(text)
    kept = {
        "letters": r"[^\p{L}]+",
        "capitals": r"[^\p{Lu}]+",
        "digits": r"[^\p{N}]+",
        "blanks": r"[^\s]+",
        "marks": r"[\p{L}\p{N}\s]+",
        "odd_marks": r"[\p{L}\p{N}\s.,;:?'\-]+",
    }
    parts = F.split(F.trim(F.lower(text)), r"[\x20\x09-\x0D]+")
    words = F.size(F.filter(parts, lambda w: w != ""))
    lines = F.split(text, "\n")
    found = {name: F.length(F.regexp_replace(text, F.lit(other), F.lit(""))) for name, other in kept.items()}
    return {
        "chars": F.log1p(chars.cast("double")),
        "words": F.log1p(words.cast("double")),
        "lines": F.log1p(F.size(lines).cast("double")),
        "word_length": _share(chars, words),
        "distinct_words": _share(F.size(F.array_distinct(parts)), words),
        "line_length": _share(chars, F.size(lines)),
        "distinct_lines": _share(F.size(F.array_distinct(lines)), F.size(lines)),
        "repeats": _share(F.regexp_count(text, F.lit(r"(?<!\S)(\S+)\s+\1(?!\S)")), words),
        "stops": _share(F.regexp_count(text, F.lit(r"[.!?](?=\s|$)")), words),
        **{name: _share(n, chars) for name, n in found.items()},
    }
