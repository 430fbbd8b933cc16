"""The seven profiles, as parameters of one set of stages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column

from ..functions import text as T
from ..functions import vocabulary as V


@dataclass(frozen=True)
class Profile:
    """How one profile cleans, blocks, scores, decides and elects."""

    name: str
    cleaner: str = "deep"  # none, simple, simple_mojibake, deep, deep_straight
    long_placeholders: bool = True
    titles: bool = True
    roles: bool = False
    suffixes: tuple[str, ...] = V.SUFFIXES_MINIMAL
    acronyms: bool = False
    stopwords: tuple[str, ...] = V.STOPWORDS
    prefixes: tuple[int, ...] = (3,)
    word_blocks: bool = False
    strict_signature: bool = False
    max_block: int = 500
    weights: tuple[float, float, float, float] = (0.30, 0.30, 0.20, 0.20)
    threshold: float = 0.70
    rule: str = "threshold"
    companies_only: bool = False
    typed_primary: bool = True
    split_over: int | None = None
    split_score: float = 0.90

    def clean(self, label: Column) -> Column:
        if self.cleaner.startswith("simple"):
            return T.clean_simple(label, mojibake=self.cleaner == "simple_mojibake")
        return T.clean_deep(label, curly_quotes=self.cleaner != "deep_straight")

    def garbage(self, cleaned: Column) -> Column:
        return T.garbage_reason(cleaned, self.long_placeholders, self.titles, self.roles)

    def normalise(self, cleaned: Column) -> Column:
        return T.normalise(cleaned, self.suffixes, self.acronyms)


DEDUP = Profile("dedup", cleaner="none", suffixes=V.SUFFIXES_BROAD, strict_signature=True, threshold=0.75, companies_only=True, typed_primary=False)
AGGRESSIVE = Profile("aggressive", cleaner="simple", long_placeholders=False, titles=False, suffixes=V.SUFFIXES_BROAD, companies_only=True, typed_primary=False)
AGGRESSIVE_ALL = Profile("aggressive_all", cleaner="simple_mojibake", long_placeholders=False, titles=False, suffixes=V.SUFFIXES_BROAD)
ULTRA = Profile("ultra", cleaner="deep_straight", suffixes=V.SUFFIXES_BUSINESS, stopwords=V.STOPWORDS_WIDE, prefixes=(3, 4, 5), max_block=1000, threshold=0.60)
IMPROVED = Profile("improved", prefixes=(3, 4), word_blocks=True, weights=(0.30, 0.30, 0.25, 0.15), threshold=0.80, rule="core_tokens")
BALANCED = Profile(
    "balanced", roles=True, acronyms=True, prefixes=(3, 4), word_blocks=True, max_block=350, weights=(0.30, 0.25, 0.30, 0.15), threshold=0.80, rule="guarded", split_over=50
)
PROFILES = {p.name: p for p in (DEDUP, AGGRESSIVE, AGGRESSIVE_ALL, ULTRA, IMPROVED, BALANCED)}

# Bands of the ``dedup`` profile.
AUTO_DUPLICATE = 0.92
ACCEPT_CONFIDENCE = 0.7
LEAST_PRIMARY_SCORE = 1.0
LEAST_COHERENCE = 0.60
