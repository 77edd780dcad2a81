"""Costs of embedding and completion calls."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# USD per 1,000 tokens.
EMBEDDING_PRICES = {"openai": 0.0004, "e5": 0.0}
COMPLETION_PRICES = {
    "gpt-3.5-turbo": (0.0015, 0.002),
    "gpt-3.5-turbo-16k": (0.003, 0.004),
}

_SPLITTER = 134217729.0  # 2**27 + 1, splits a double into two half-width parts


def round_binary(value: Column, digits: int) -> Column:
    """Round a non-negative double as ``round()`` in Python does.

    Spark rounds the shortest decimal text half up, so 0.0045 becomes 0.005 although the
    stored number lies below that tie. Here ``value * 10**digits`` is formed without
    error as ``product + rest``, and a tie is decided by the sign of ``rest``, or goes to
    the even neighbour when ``rest`` is zero.
    """
    scale = float(10 ** digits)
    scale_high = scale * _SPLITTER - (scale * _SPLITTER - scale)
    scale_low = scale - scale_high
    product = value * scale
    high = value * _SPLITTER - (value * _SPLITTER - value)
    low = value - high
    rest = ((high * scale_high - product) + high * scale_low + low * scale_high) + low * scale_low
    whole = F.floor(product)
    excess = product - whole
    up = (excess > 0.5) | ((excess == 0.5) & ((rest > 0) | ((rest == 0) & (whole % 2 == 1))))
    return (whole + up.cast("long")).cast("double") / scale


def embedding_cost(total_tokens, model: str) -> Column:
    if model not in EMBEDDING_PRICES:
        raise ValueError(f"no embedding price for model {model!r}")
    price = EMBEDDING_PRICES[model]
    total = F.col(total_tokens) if isinstance(total_tokens, str) else total_tokens
    return round_binary(total / 1000 * price, 4) if price else F.lit(0.0)


def completion_cost(prompt_tokens, completion_tokens, model) -> Column:
    """Cost of one call: both parts are rounded to 3 digits before they are added.

    ``model`` is a column or the name of one; models without a price cost 0. The price
    table has a handful of rows, so it is folded into the expression instead of joined.
    """
    prompt = F.col(prompt_tokens) if isinstance(prompt_tokens, str) else prompt_tokens
    completion = F.col(completion_tokens) if isinstance(completion_tokens, str) else completion_tokens
    name = F.col(model) if isinstance(model, str) else model

    def price(part: int) -> Column:
        (first, prices), *others = COMPLETION_PRICES.items()
        chosen = F.when(name == first, prices[part])
        for model_name, prices in others:
            chosen = chosen.when(name == model_name, prices[part])
        return chosen.otherwise(0.0)

    return round_binary(prompt / 1000 * price(0), 3) + round_binary(completion / 1000 * price(1), 3)
