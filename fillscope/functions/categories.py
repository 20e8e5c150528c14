"""Keyword categories of market questions, and their one-hot form."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from fillscope.schemas import CATEGORIES, DEFAULT_CATEGORY, FLAG_COLUMNS

Rules = Mapping[str, Sequence[str]]

# Keyword lists, first matching category wins, case ignored.
MARKET_RULES: Rules = {
    "Crypto": ("crypto", "bitcoin", "eth", "solana"),
    "Politics": ("US", "election", "trump", "poll", "biden", "harris", "netanyahu"),
    "Sports": (
        "arsenal", "goals", "nhl", "nfl", "nba", "mlb", "championship", "win", "close", "points", "lose",
    ),
    "Economics": ("fed", "rate", "inflation", "recession", "$"),
    "Pop Culture": (
        "oscars", "grammys", "movie", "album", "music", "netflix", "divorce", "Zendaya", "Coachella",
        "sstreams", "Kardashian",
    ),
}

# The older keyword lists, used by the market and trade histograms.
HISTOGRAM_RULES: Rules = {
    "Crypto": ("crypto", "bitcoin", "eth", "solana"),
    "Politics": ("election", "trump", "poll", "biden", "harris", "netanyahu"),
    "Sports": ("nfl", "nba", "mlb", "championship", "win", "close", "points", "lose"),
    "Economics": ("fed", "rate", "inflation", "recession", "$"),
    "Pop Culture": (
        "oscars", "grammys", "movie", "album", "music", "netflix", "divorce", "Zendaya", "Coachella",
        "sstreams", "Kardashian",
    ),
}


def categorize(question: Column, rules: Rules = MARKET_RULES, default: str = DEFAULT_CATEGORY) -> Column:
    """The first category with a keyword contained in the question."""
    folded = F.lower(question)
    result = F.lit(default)
    for name, words in reversed(list(rules.items())):
        hit = F.lit(False)
        for word in words:
            hit = hit | folded.contains(word.lower())
        result = F.when(hit, F.lit(name)).otherwise(result)
    return result


def one_hot(category: Column) -> list[Column]:
    """Six flag columns; a missing category sets no flag and leaves them NULL."""
    return [(category == name).alias(flag) for name, flag in zip(CATEGORIES, FLAG_COLUMNS)]


def decode_one_hot(present: Sequence[str] = FLAG_COLUMNS) -> Column:
    """The category of the first flag that is true, the default without one."""
    result = F.lit(DEFAULT_CATEGORY)
    for name, flag in reversed(list(zip(CATEGORIES, FLAG_COLUMNS))):
        if flag in present:
            result = F.when(F.col(f"`{flag}`"), F.lit(name)).otherwise(result)
    return result
