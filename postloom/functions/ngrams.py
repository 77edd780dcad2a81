"""Language detection by character trigrams: a likelihood table from an aggregate, scored by a column expression.

The table is learned from labelled rows. Trigrams fall into a fixed number of buckets, so
its size depends on the number of languages only and it travels as literals: scoring needs
no join and no Python, and a text is scored where it is read. Counting takes one Arrow pass.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

# Buckets of the table; a prime, so that the sums below spread.
BUCKETS = 4093
# A row's label may be one of this many languages; the driver gets BUCKETS counts of each.
MOST_LANGUAGES = 200
# Runs of anything but letters of the basic plane, which become one blank.
OTHER = r"[\P{L}\x{10000}-\x{10FFFF}]+"
# Characters that a counting task spreads out as numbers at a time.
PART = 1 << 20


def _letters(text: Column) -> Column:
    """The lower-cased letters, words set apart by blanks, with a blank before and behind."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), F.lit(OTHER), F.lit(" "))), F.lit(" "))


def trigrams(text: Column, buckets: int = BUCKETS) -> Column:
    """Buckets of all three-character windows of the lower-cased letters, words set apart by blanks.

    NULL for a null text and one without letters.
    """
    codes = F.transform(F.filter(F.split(_letters(text), ""), lambda c: c != ""), lambda c: F.ascii(c))

    def windows(cs: Column) -> Column:
        bucket = lambda i: (F.get(cs, i) * 961 + F.get(cs, i + 1) * 31 + F.get(cs, i + 2)) % buckets
        return F.when(F.size(cs) > 2, F.transform(F.sequence(F.lit(0), F.size(cs) - 3), bucket))

    # Wrapping the codes in an array names them, so that they are computed once.
    return F.transform(F.array(codes), windows)[0]


@dataclass(frozen=True)
class NgramLanguages:
    """Per language one weight for each bucket: the trigram's log-likelihood in thousandths, rounded down."""

    weights: dict[str, tuple[int, ...]]


def count_trigrams(texts: Iterable[str], buckets: int = BUCKETS) -> np.ndarray:
    """How many three-character windows of the ``texts`` fall into each bucket; none spans two texts.

    The texts are letters and blanks, as ``_letters`` makes them.
    """
    counts = np.zeros(buckets, np.int64)

    def add(joined: str) -> None:
        codes = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        for start in range(0, len(codes) - 2, PART):
            part = codes[start:start + PART + 2].astype(np.int64)
            whole = (part[:-2] != 0) & (part[1:-1] != 0) & (part[2:] != 0)
            counts[:] += np.bincount(((part[:-2] * 961 + part[1:-1] * 31 + part[2:]) % buckets)[whole], minlength=buckets)

    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= PART:
            add("\0".join(held))
            held, size = [], 0
    add("\0".join(held))
    return counts


def learn_languages(df: DataFrame, text: str = "text", lang: str = "lang", buckets: int = BUCKETS, most_languages: int = MOST_LANGUAGES) -> NgramLanguages:
    """Count the trigrams of all rows with text and language, whole texts; each trigram starts at one.

    Counts are summed up in the tasks, so at most ``buckets`` rows a language leave each of
    them. Repeated rows count as often as they stand. More than ``most_languages`` labels
    are an error; no labelled rows give a table without languages.
    """
    # Spread out as rows, the trigrams would take several times longer than the letters.
    # Filtered by the text: a filter on its letters would compute them a second time.
    letters = df.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), _letters(F.col(text)).alias("letters"))
    schema = StructType([letters.schema["lang"], StructField("bucket", IntegerType()), StructField("n", LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict = {}

        def counted(kind: pa.DataType) -> Iterator[pa.RecordBatch]:
            for code, counts in found.items():
                places = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([code] * len(places), kind), pa.array(places, pa.int32()), pa.array(counts[places], pa.int64())], ["lang", "bucket", "n"])
            found.clear()

        kind = None
        for batch in batches:
            kind = batch.column("lang").type
            rows: dict[object, list[int]] = {}
            for place, code in enumerate(batch.column("lang").to_pylist()):
                rows.setdefault(code, []).append(place)
            for code, places in rows.items():
                counts = count_trigrams((batch.column("letters")[place].as_py() for place in places), buckets)
                found[code] = found[code] + counts if code in found else counts
                if len(found) > most_languages:  # an error later on, but not one of memory
                    yield from counted(kind)
        yield from counted(kind)

    rows = letters.mapInArrow(count, schema)
    counts = rows.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).limit(most_languages * buckets + 1).collect()
    seen: dict[str, dict[int, int]] = {}
    for row in counts:
        seen.setdefault(row["lang"], {})[row["bucket"]] = row["n"]
    if len(seen) > most_languages or len(counts) > most_languages * buckets:
        raise ValueError(f"more than {most_languages} languages; raise most_languages")
    weights = {}
    for code in sorted(seen):
        total = sum(seen[code].values()) + buckets
        weights[code] = tuple(math.floor(1000 * math.log((seen[code].get(b, 0) + 1) / total)) for b in range(buckets))
    return NgramLanguages(weights)


def ngram_language(text, languages: NgramLanguages) -> Column:
    """The language under which a text's trigrams are most likely; ties go to the first by name.

    NULL for a null text, one without letters, and if no language was learned.
    """
    if not languages.weights:
        return F.lit(None).cast("string")
    buckets = len(next(iter(languages.weights.values())))

    def score(found: Column, weights: tuple[int, ...]) -> Column:
        # One string becomes an array when the plan is optimised; thousands of literals made
        # one by one from Python would take seconds.
        table = F.split(F.lit(",".join(map(str, weights))), ",").cast("array<bigint>")
        return F.aggregate(found, F.lit(0).cast("long"), lambda total, bucket: total + F.get(table, bucket))

    def best(found: Column) -> Column:
        scores = [
            F.struct(score(found, weights).alias("score"), F.lit(-position).alias("priority"), F.lit(code).alias("lang"))
            for position, (code, weights) in enumerate(languages.weights.items())]
        return F.when(found.isNotNull(), F.array_max(F.array(*scores))["lang"])

    column = F.col(text) if isinstance(text, str) else text
    return F.transform(F.array(trigrams(column, buckets)), best)[0]
