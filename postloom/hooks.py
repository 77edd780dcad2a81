"""Places where a model, tokenizer or remote call is plugged in.

Every hook takes a factory, not an object: the factory is shipped to the workers and
called once per task, so a model is loaded where it is used and never per row. The column
hooks are marked non-deterministic: the optimizer would otherwise copy a call into filters
that it derives from the result, and run a model twice.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F, types as T


class Tokenizer(Protocol):
    def encode(self, text: str) -> list[int]: ...

    def decode(self, tokens: list[int]) -> str: ...


TokenizerFactory = Callable[[], Tokenizer]
EncoderFactory = Callable[[], Callable[[list[str]], "list[list[float]]"]]
CompletionFactory = Callable[[], Callable[[str], "str | dict"]]
StemmerFactory = Callable[[], Callable[[str], str]]

# Rows that a hook holds as Python objects at a time, whatever the size of an Arrow batch.
SLICE_ROWS = 256


def _slices(batch: pa.Array) -> Iterator[pa.Array]:
    for start in range(0, len(batch), SLICE_ROWS):
        yield batch.slice(start, SLICE_ROWS)


def tiktoken_tokenizer(model: str = "gpt-3.5-turbo") -> TokenizerFactory:
    """The byte-pair tokenizer of a model; the package fetches its vocabulary once per host."""
    def factory() -> Tokenizer:
        import tiktoken

        return tiktoken.encoding_for_model(model)

    return factory


def token_count_udf(factory: TokenizerFactory):
    @F.pandas_udf(T.IntegerType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokenizer = factory()
        for texts in batches:
            yield texts.map(lambda t: None if t is None else len(tokenizer.encode(t)))

    return count.asNondeterministic()


def truncate_udf(factory: TokenizerFactory, max_tokens: int):
    @F.pandas_udf(T.StringType())
    def truncate(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokenizer = factory()

        def cut(text):
            if text is None:
                return None
            tokens = tokenizer.encode(text)
            return text if len(tokens) <= max_tokens else tokenizer.decode(tokens[:max_tokens])

        for texts in batches:
            yield texts.map(cut)

    return truncate.asNondeterministic()


_BUDGET = T.StructType([T.StructField("n_tokens", T.IntegerType()), T.StructField("text", T.StringType())])
_BUDGET_ARROW = pa.struct([("n_tokens", pa.int32()), ("text", pa.string())])


def budget_udf(factory: TokenizerFactory, max_tokens: int):
    """``struct(n_tokens, text)``: the tokens of a text before truncation, and the text cut to ``max_tokens``.

    Each text is encoded once, in one Python worker per task, and a few rows at a time.
    """
    @F.arrow_udf(_BUDGET)
    def budget(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokenizer = factory()

        def cut(text):
            if text is None:
                return {"n_tokens": None, "text": None}
            tokens = tokenizer.encode(text)
            return {"n_tokens": len(tokens), "text": text if len(tokens) <= max_tokens else tokenizer.decode(tokens[:max_tokens])}

        for batch in batches:
            for texts in _slices(batch):
                yield pa.array([cut(text.as_py()) for text in texts], _BUDGET_ARROW)

    return budget.asNondeterministic()


def stem_udf(factories: dict[str, StemmerFactory]):
    """The stems of the token lists whose language has a stemmer, as a function of language and tokens; else NULL.

    All stemmers share one Python worker per task. Tokens stay in Arrow: a stemmer is
    called once for each different token of a language in a slice of rows.
    """
    @F.arrow_udf(T.ArrayType(T.StringType()))
    def stem(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        stemmers: dict[str, Callable[[str], str]] = {}

        def stemmed(words: pa.Array, code: str) -> pa.Array:
            if code not in stemmers:
                stemmers[code] = factories[code]()
            different = words.flatten().dictionary_encode(null_encoding="encode")
            stems = pa.array([stemmers[code](w) for w in different.dictionary.to_pylist()], pa.string()).take(different.indices)
            offsets = np.concatenate([[0], np.cumsum(pc.list_value_length(words).to_numpy(zero_copy_only=False))])
            return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), stems)

        for langs, tokens in batches:
            for lang, words in zip(_slices(langs), _slices(tokens), strict=True):
                order, parts = [], []
                for code in factories:
                    chosen = np.flatnonzero(pc.and_(pc.fill_null(pc.equal(lang, code), False), words.is_valid()).to_numpy(zero_copy_only=False))
                    if len(chosen):
                        order.append(chosen)
                        parts.append(stemmed(words.take(pa.array(chosen)), code))
                left = np.setdiff1d(np.arange(len(words)), np.concatenate(order) if order else [])
                order.append(left)
                parts.append(pa.nulls(len(left), pa.list_(pa.string())))
                yield pa.concat_arrays(parts).take(pa.array(np.argsort(np.concatenate(order))))

    return stem.asNondeterministic()


def encode_udf(factory: EncoderFactory, chunk: int):
    """Vectors from the encoder, which sees at most ``chunk`` texts per call.

    As a column function it moves only the text to Python and the vector back; the other
    columns of the row stay where they are.
    """
    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = factory()
        for texts in batches:
            vectors: list = []
            for start in range(0, len(texts), chunk):
                part = texts.iloc[start:start + chunk].tolist()
                encoded = encoder(part)
                if len(encoded) != len(part):
                    raise ValueError("the encoder must return one vector per text")
                vectors.extend(np.asarray(vector, dtype=np.float32) for vector in encoded)
            yield pd.Series(vectors, index=texts.index, dtype=object)

    return encode.asNondeterministic()


_COMPLETION = T.StructType([T.StructField("attempts", T.IntegerType()), T.StructField("response", T.StringType())])


def complete_udf(factory: CompletionFactory, attempts: int = 5, backoff: float = 5.0, pause: float = 0.5, concurrency: int = 8):
    """``struct(attempts, response)`` from a completion call per request text.

    Every call waits ``pause`` seconds first. A failed call is repeated up to ``attempts``
    times in all, waiting ``backoff ** n`` seconds after the n-th failure; the response is
    NULL when all of them failed. Calls of one task overlap in ``concurrency`` threads.
    Write the result to a table before using it (``plans.summaries``): recomputing it would
    call the service again. A request that keeps failing holds one of the threads for the
    sum of the waits.
    """
    @F.pandas_udf(_COMPLETION)
    def complete(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        call = factory()

        def ask(request):
            for attempt in range(1, attempts + 1):
                try:
                    time.sleep(pause)
                    answer = call(request)
                    return attempt, answer if isinstance(answer, str) else json.dumps(answer)
                except Exception:
                    if attempt < attempts:
                        time.sleep(backoff ** attempt)
            return attempts, None

        with ThreadPoolExecutor(max_workers=concurrency) as pool:
            for requests in batches:
                yield pd.DataFrame(list(pool.map(ask, requests)), columns=_COMPLETION.names)

    return complete.asNondeterministic()
