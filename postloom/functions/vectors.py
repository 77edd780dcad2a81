"""The built-in hashing encoder as a column expression."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_BLANKS = "\t\n\x0b\f\r"


def hashed_vector(text: Column, dim: int = 64, max_words: int | None = None) -> Column:
    """Word counts per hash bucket, scaled to unit length; a text without words gives zeros.

    A deterministic stand-in for a model, without weights to load. The bucket of a word is
    the leading 32 bits of its MD5 modulo ``dim``. Only the first ``max_words`` words count.
    """
    words = F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _BLANKS, " " * len(_BLANKS)), " "), "")
    if max_words is not None:
        words = F.slice(words, 1, max_words)
    buckets = F.transform(words, lambda w: (F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("long") % dim).cast("int"))

    # A value in an array of one element has a name in the lambda, so it is computed once.
    def counted(found: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda d: F.size(F.filter(found, lambda b: b == d)).cast("double"))

    def scaled(counts: Column) -> Column:
        length = F.sqrt(F.aggregate(counts, F.lit(0.0), lambda total, c: total + c * c))
        return F.get(F.transform(F.array(length), lambda size: F.transform(counts, lambda c: F.when(size > 0, c / size).otherwise(0.0).cast("float"))), 0)

    return F.get(F.transform(F.transform(F.array(buckets), counted), scaled), 0)
