"""Token costs: price lookup, formula, and usage of a request with repair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.functions.text import round4

#: USD per million tokens (provider, model, input, output).
PRICES = (
    ("claude", "claude-opus-4-8", 5.0, 25.0),
    ("claude", "claude-opus-4-7", 5.0, 25.0),
    ("claude", "claude-opus-4-6", 5.0, 25.0),
    ("claude", "claude-sonnet-4-6", 3.0, 15.0),
    ("claude", "claude-haiku-4-5", 1.0, 5.0),
    ("claude", "claude-haiku-4-5-20251001", 1.0, 5.0),
    ("claude", "claude-sonnet-4-5", 3.0, 15.0),
    ("claude", "claude-opus-4-5", 5.0, 25.0),
    ("claude", "claude-opus-4-1", 15.0, 75.0),
    ("openai", "gpt-5.5", 5.0, 30.0),
    ("openai", "gpt-5.4", 2.5, 15.0),
    ("openai", "gpt-5.4-mini", 0.75, 4.5),
    ("openai", "gpt-5.4-nano", 0.2, 1.25),
    ("openai", "gpt-5-mini", 0.25, 2.0),
    ("openai", "gpt-5.3-codex", 4.0, 12.0),
    ("openai", "gpt-5.3-codex-mini", 1.2, 3.6),
)
#: Fixed value: discount of the batch route.
BATCH_DISCOUNT = 0.5


def price_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PRICES, "provider string, model string, price_in double, price_out double")


def cost_columns(tokens_in: Column, tokens_out: Column, price_in: Column, price_out: Column, is_batch: Column) -> dict[str, Column]:
    """Standard, effective and saved USD; each rounded by itself. A missing
    price costs nothing."""
    standard = tokens_in / 1e6 * F.coalesce(price_in, F.lit(0.0)) + tokens_out / 1e6 * F.coalesce(price_out, F.lit(0.0))
    effective = standard * (1 - F.when(is_batch, BATCH_DISCOUNT).otherwise(0.0))
    return {"standard_cost_usd": round4(standard), "batch_cost_usd": round4(effective), "saving_usd": round4(standard - effective)}


def with_cost(usage: DataFrame, is_batch: Column | None = None) -> DataFrame:
    """Adds the cost columns to rows of ``provider, model, input_tokens,
    output_tokens``. The price table is a fixed list, so it is broadcast."""
    prices = F.broadcast(price_table(usage.sparkSession))
    joined = usage.join(prices, ["provider", "model"], "left")
    costs = cost_columns(F.col("input_tokens"), F.col("output_tokens"), F.col("price_in"), F.col("price_out"), F.lit(True) if is_batch is None else is_batch)
    return joined.withColumns(costs).drop("price_in", "price_out")


def merge_usage(base: dict[str, Column], repair: dict[str, Column]) -> dict[str, Column]:
    """Usage of a request and its repair; the saving is a difference of sums."""
    none = F.lit(0)
    add = lambda k: base[k] + F.coalesce(repair[k], none)
    standard, effective = add("standard_cost_usd"), add("batch_cost_usd")
    return {"input_tokens": add("input_tokens"), "output_tokens": add("output_tokens"), "standard_cost_usd": standard, "batch_cost_usd": effective, "saving_usd": standard - effective}


def tier_check(config: DataFrame) -> DataFrame:
    """One row: checks made and failed for rows ``provider, tier, model``: every
    tier names a model, and every named model has a price."""
    prices = F.broadcast(price_table(config.sparkSession))
    joined = config.join(prices, ["provider", "model"], "left")
    named = F.length("model") > 0
    models = F.count_distinct(F.when(named, F.concat_ws(":", "provider", "model")))
    priced = F.count_distinct(F.when(named & (F.col("price_in") + F.col("price_out") > 0), F.concat_ws(":", "provider", "model")))
    return joined.agg((F.count("*") + models).alias("n_checks"), (F.count_if(~F.coalesce(named, F.lit(False))) + models - priced).alias("n_failed"))
