"""Token counts and token budgets.

The built-in token is a word with the whitespace before it, so any number of leading
tokens is an exact prefix of the text. A model tokenizer plugs in through
``postloom.hooks``.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from postloom import hooks

TOKEN_PATTERN = r"\s*\S+"


def _col(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def token_count(col, tokenizer: hooks.TokenizerFactory | None = None) -> Column:
    if tokenizer is not None:
        return hooks.token_count_udf(tokenizer)(_col(col))
    return F.regexp_count(_col(col), F.lit(r"\S+"))


def leading_tokens(col, n: int) -> Column:
    """The first ``n`` built-in tokens as one string."""
    return F.array_join(F.slice(F.regexp_extract_all(_col(col), F.lit(TOKEN_PATTERN), F.lit(0)), 1, n), "")


def truncate_tokens(col, max_tokens: int, n_tokens=None, tokenizer: hooks.TokenizerFactory | None = None) -> Column:
    """The text itself within the budget, else its first ``max_tokens`` tokens.

    Only texts over the budget are tokenised; pass a precomputed count column as
    ``n_tokens`` to count each text once.
    """
    text = _col(col)
    if tokenizer is not None:
        return hooks.truncate_udf(tokenizer, max_tokens)(text)
    counted = _col(n_tokens) if n_tokens is not None else token_count(text)
    return F.when(counted <= max_tokens, text).otherwise(leading_tokens(text, max_tokens))
