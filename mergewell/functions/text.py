"""Cleaning, normalisation and token expressions; all native, so they stay inside code generation.

Patterns carry ``(?U)``: ``\\w``, ``\\s`` and ``\\b`` then follow Unicode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocabulary as V


def sub(c: Column, pattern: str, by: str, flags: str = "U") -> Column:
    return F.regexp_replace(c, f"(?{flags})" + pattern, by)


def matches(c: Column, pattern: str, flags: str = "U") -> Column:
    return c.rlike(f"(?{flags})" + pattern)


def strip(c: Column) -> Column:
    """Without Unicode white space at either end (``trim`` knows the space alone)."""
    return sub(c, r"^\s+|\s+$", "")


def collapse(c: Column) -> Column:
    return sub(c, r"\s+", " ")


def join_ampersand(c: Column) -> Column:
    return sub(c, r"(\w)\s+&(\w)", "$1&$2")


def clean_simple(label: Column, mojibake: bool = False) -> Column:
    """Ends without dots, brackets and the like; one space between words; ``AT &T`` as ``AT&T``.

    ``mojibake`` also takes a stray U+00C2 before a middle dot.
    """
    dot = "Â?·" if mojibake else "·"
    s = strip(F.coalesce(label, F.lit("")))
    s = sub(s, rf"\s*{dot}\s*$", "")
    s = sub(s, rf"^\s*{dot}\s*", "")
    s = sub(sub(s, V.LEADING_JUNK_SIMPLE, ""), V.TRAILING_JUNK_SIMPLE, "")
    s = join_ampersand(collapse(s))
    if not mojibake:
        s = sub(s, r"(\w)&\s+(\w)", "$1& $2")
    return strip(s)


def clean_deep(label: Column, curly_quotes: bool = True) -> Column:
    """Also without employment suffixes, parentheses, and up to three trailing places."""
    lead, trail = (V.LEADING_JUNK, V.TRAILING_JUNK) if curly_quotes else (V.LEADING_JUNK_STRAIGHT, V.TRAILING_JUNK_STRAIGHT)
    s = sub(strip(F.coalesce(label, F.lit(""))), V.EMPLOYMENT_SUFFIX, "", "iU")
    s = sub(s, V.PARENTHESES, " ")
    s = sub(sub(s, lead, ""), trail, "")
    for _ in range(3):
        s = sub(sub(s, V.TRAILING_LOCATION, "", "iU"), trail, "")
    return strip(join_ampersand(collapse(s)))


def garbage_reason(cleaned: Column, long_placeholders: bool, titles: bool, roles: bool) -> Column:
    """The first rule that a cleaned label breaks, or null."""
    n = F.char_length(cleaned)
    placeholder = V.PLACEHOLDER_LONG if long_placeholders else V.PLACEHOLDER_SHORT
    rules = [
        (cleaned == "", F.lit("empty")),
        (n <= 2, F.concat(F.lit("too_short ("), n.cast("string"), F.lit(" chars)"))),
        (~matches(cleaned, V.HAS_LETTER_OR_DIGIT), F.lit("special_chars_only")),
        (matches(cleaned, "^[0-9]+$"), F.lit("numeric_only")),
        (matches(cleaned, f"^(?:{placeholder})$", "iU"), F.lit("placeholder")),
    ]
    if titles:
        rules.append((matches(cleaned, f"^(?:{V.JOB_TITLE})s?$", "iU"), F.lit("job_title_not_company")))
    if roles:
        rules.append((matches(cleaned, V.JOB_ROLE, "iU"), F.lit("job_role_not_company")))
        rules.append((matches(cleaned, V.INDEPENDENT, "iU"), F.lit("independent_not_company")))
    rules.append((matches(cleaned, V.NON_COMPANY, "iU"), F.lit("non_company (freelance/self-employed/student/etc)")))
    out = F.lit(None).cast("string")
    for test, reason in reversed(rules):
        out = F.when(test, reason).otherwise(out)
    return out


def normalise(label: Column, suffixes: tuple[str, ...], acronyms: bool = False) -> Column:
    """The form that names are compared in; ``acronyms`` joins ``A & B`` of up to three letters first."""
    s = strip(F.lower(F.coalesce(label, F.lit(""))))
    if acronyms:
        s = sub(s, r"\b([A-Za-z]{1,3})\s*&\s*([A-Za-z]{1,3})\b", "$1$2")
    s = F.replace(s, F.lit("&"), F.lit(" and "))
    s = strip(collapse(sub(s, r"[^\w\s]", " ")))
    s = sub(s, "(?:" + "|".join(suffixes) + ")", "", "iU")
    s = sub(sub(s, r"^the\s+", ""), r"\s+the$", "")
    return strip(collapse(s))


def words(norm: Column) -> Column:
    return F.filter(F.split(norm, " "), lambda w: w != "")


def significant(norm: Column, stopwords: tuple[str, ...], longer_than: int = 1) -> Column:
    """Words that are no stopwords and longer than ``longer_than``, in order."""
    stop = F.array(*[F.lit(w) for w in stopwords])
    return F.filter(words(norm), lambda w: ~F.array_contains(stop, w) & (F.char_length(w) > longer_than))


def token_signature(norm: Column, stopwords: tuple[str, ...]) -> Column:
    """Significant words in order of the alphabet; repeated words stay."""
    return F.array_join(F.array_sort(significant(norm, stopwords)), " ")


def distinctive(norm: Column) -> Column:
    generic = F.array(*[F.lit(w) for w in sorted(V.GENERIC_SIGNATURE)])
    return F.filter(significant(norm, V.STOPWORDS), lambda w: ~F.array_contains(generic, w))


def compact_signature(norm: Column) -> Column:
    return F.array_join(distinctive(norm), "")


def initials(label: Column) -> Column:
    first = F.transform(words(collapse(strip(label))), lambda w: F.substring(w, 1, 1))
    return F.upper(F.array_join(F.filter(first, lambda c: matches(c, r"\p{L}")), ""))


def title_case(label: Column) -> Column:
    """Upper case after anything that is no letter, lower case otherwise (``initcap`` splits at spaces only)."""
    chars = F.split(F.lower(label), "")
    return F.array_join(F.transform(chars, lambda c, i: F.when((i == 0) | ~matches(F.element_at(chars, i), r"\p{L}"), F.upper(c)).otherwise(c)), "")
