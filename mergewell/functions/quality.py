"""How good a label is as the name of its group; native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocabulary as V
from .text import matches, strip


def type_bonus(source_type: Column) -> Column:
    out = F.lit(0)
    for name, bonus in V.TYPE_BONUS.items():
        out = F.when(source_type == name, bonus).otherwise(out)
    return out


def _case(label: Column, first_upper: Column) -> Column:
    return F.when(label == F.upper(label), -1).when(label == F.lower(label), -1).when(first_upper, 2).otherwise(0)


def _length(stripped: Column) -> Column:
    n = F.char_length(stripped)
    return F.when(n >= 5, F.least(n / F.lit(30.0), F.lit(1.0))).otherwise(F.lit(0.0))


def primary_score(label: Column, source_type: Column | None = None, strict: bool = False) -> Column:
    """Points for case, a legal form, length and tidiness; ``strict`` also takes odd signs and junk."""
    stripped = strip(label)
    points = _case(label, matches(label, r"^\p{Lu}")) + matches(label, rf"\b(?:{V.LEGAL_WORD})\b", "iU").cast("int") + _length(stripped)
    points = points - (label.contains("  ") | (label != stripped)).cast("int")
    if strict:
        points = points - matches(label, r"[^\w\s.,&()\-/']").cast("int") - 5 * matches(stripped, r"^(?:test|unknown|company\s*\d*|n/?a|none|--|-)$", "iU").cast("int")
    if source_type is not None:
        points = points + type_bonus(F.coalesce(source_type, F.lit("Unknown")))
    return F.when(label.isNull() | (F.char_length(stripped) < 2), F.lit(-10.0)).otherwise(points.cast("double"))


def election_score(name: Column, source_type: Column) -> Column:
    """The score of the signature pass: a legal form counts inside words, a capital is ASCII."""
    trimmed = F.trim(name)
    points = type_bonus(F.coalesce(source_type, F.lit(""))) + _case(name, F.substring(name, 1, 1).rlike("[A-Z]")) + name.rlike(f"(?i)(?:{V.LEGAL_WORD})").cast("int")
    return (points + _length(trimmed) - (name.contains("  ") | (name != trimmed)).cast("int")).cast("double")
