"""Markets: expansion of the JSON columns, token outcomes, token categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fillscope.functions.categories import MARKET_RULES, HISTOGRAM_RULES, Rules, categorize

DEFAULT_THRESHOLD = 0.5


def expand_markets(markets: DataFrame) -> DataFrame:
    """Yes and no token with their prices, next to the other columns."""
    return markets.select(
        *[c for c in markets.columns if c not in ("clob_token_ids", "outcome_prices")],
        F.get_json_object("clob_token_ids", "$[0]").alias("yes_token"),
        F.get_json_object("clob_token_ids", "$[1]").alias("no_token"),
        F.get_json_object("outcome_prices", "$[0]").cast("float").alias("yes_price"),
        F.get_json_object("outcome_prices", "$[1]").cast("float").alias("no_price"),
    )


def _yes_outcome(threshold: float) -> Column:
    """Outcome of the yes token, NULL while the prices are not extreme.

    The limits are FLOAT like the prices, so a price equal to a limit is not past it.
    """
    high = F.lit((100 - threshold) / 100.0).cast("float")
    low = F.lit(threshold / 100.0).cast("float")
    yes, no = F.col("yes_price"), F.col("no_price")
    return F.when((yes > high) & (no < low), True).when((yes < low) & (no > high), False)


def token_rows(markets: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Two rows per market, one per token, with the market's question.

    One pass over the markets; a union would scan them twice.
    """
    outcome = _yes_outcome(threshold)

    def side(token: str, pays: Column, is_yes: bool) -> Column:
        return F.struct(
            F.col(token).alias("token"),
            pays.alias("implied_outcome"),
            pays.isNotNull().alias("resolved"),
            F.lit(is_yes).alias("token_type"),
        )

    sides = F.array(side("yes_token", outcome, True), side("no_token", ~outcome, False))
    return expand_markets(markets).select("question", "condition_id", F.inline(sides))


def tokens(markets: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    return token_rows(markets, threshold).select("token", "implied_outcome", "resolved", "token_type")


def token_outcome_counts(tokens_: DataFrame) -> DataFrame:
    return tokens_.groupBy("token_type", "implied_outcome").agg(F.count(F.lit(1)).alias("n"))


def token_dimension(markets: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """One row per token for lookups: question, side and outcome.

    For a token listed by several markets the last market by ``condition_id`` wins.
    A token on both sides counts as a yes token but takes the outcome of its no row.
    """
    key = F.coalesce(F.col("condition_id"), F.lit(""))
    yes_first = F.struct(F.col("token_type"), key)
    no_first = F.struct(~F.col("token_type"), key)
    return (
        token_rows(markets, threshold)
        .filter(F.col("token").isNotNull())
        .groupBy("token")
        .agg(
            F.max_by("question", yes_first).alias("question"),
            F.max("token_type").alias("is_yes_token"),
            F.max_by("implied_outcome", no_first).alias("implied_outcome"),
        )
    )


def market_tokens(markets: DataFrame, rules: Rules = MARKET_RULES) -> DataFrame:
    """One row per market and token with the category of the question."""
    return markets.select(
        F.explode(F.from_json("clob_token_ids", "array<string>")).alias("token_id"),
        "question",
        "market_maker_address",
        categorize(F.col("question"), rules).alias("category"),
        *[c for c in ("condition_id",) if c in markets.columns],
    )


def token_categories(markets: DataFrame, rules: Rules = MARKET_RULES) -> DataFrame:
    """Category per lower-case token id, one row each (last market wins)."""
    return (
        market_tokens(markets, rules)
        .filter(F.col("token_id").isNotNull())
        .groupBy(F.lower("token_id").alias("token_key"))
        .agg(
            F.max_by("category", F.struct(F.coalesce("condition_id", F.lit("")), "category")).alias(
                "category"
            )
        )
    )


def categorized_markets(markets: DataFrame, rules: Rules = HISTOGRAM_RULES) -> DataFrame:
    return markets.select(
        "market_maker_address",
        "condition_id",
        "question",
        F.col("volume").alias("market_total_volume"),
        categorize(F.col("question"), rules).alias("category"),
    )
