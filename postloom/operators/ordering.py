"""Global positions and consecutive chunks of an ordered table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

# Rows that are looked at to cut a table into ranges, per range.
SAMPLED_ROWS = 32


def global_rank(df: DataFrame, order_by, rank_col: str = "rank", ranges: int | None = None) -> DataFrame:
    """Number the rows 1..n in the given order without gathering them in one task.

    The table is cut into ``ranges`` (by default the number of shuffle partitions) at fixed
    bounds from a small sample, the rows with the smallest hashes. A row's rank is its
    position in its range plus the rows of all earlier ranges; both scans that find the
    bounds and the counts read the key columns only where the source allows it. The bounds
    are literals, so every evaluation cuts alike and nothing has to be written. Rows with
    equal keys are told apart by a hash of the whole row, so they spread over ranges; rows
    that are equal in all columns take their ranks in any order.
    """
    names = [order_by] if isinstance(order_by, str) else list(order_by)
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.withColumn("_tie", F.xxhash64(*df.columns))
    place = F.struct(*names, "_tie")
    sample = keyed.select(place.alias("p")).orderBy("p._tie").limit(SAMPLED_ROWS * ranges).orderBy("p").collect()
    bounds = [sample[i * len(sample) // ranges]["p"] for i in range(1, ranges)] if sample else []
    ranged = keyed.withColumn("_range", _range_of(place, bounds, keyed.select(*names, "_tie").schema))
    sizes = {row["_range"]: row["count"] for row in ranged.groupBy("_range").count().collect()}  # one row per range
    before = [0]
    for number in range(len(bounds)):
        before.append(before[-1] + sizes.get(number, 0))
    position = F.row_number().over(Window.partitionBy("_range").orderBy(*names, "_tie"))
    earlier = F.get(F.lit(before).cast("array<bigint>"), F.col("_range"))
    return ranged.withColumn(rank_col, earlier + position).select(*df.columns, rank_col)


def _range_of(place: Column, bounds: list, schema: T.StructType) -> Column:
    """How many of the sorted bounds lie at or below a place, by halving: a row compares itself with the logarithm of their number."""
    if not bounds:
        return F.lit(0)
    literals = F.array(*[F.struct(*[F.lit(value).cast(f.dataType).alias(f.name) for value, f in zip(bound, schema)]) for bound in bounds])
    steps = F.lit([1 << k for k in reversed(range(len(bounds).bit_length()))])
    # Beyond the last bound there is null, which no place is above.
    return F.aggregate(steps, F.lit(0), lambda below, step: F.when(F.get(literals, below + step - 1) <= place, below + step).otherwise(below))


def chunk_rows(df: DataFrame, order_by, n: int, ranges: int | None = None) -> DataFrame:
    """Add ``chunk`` (0, 1, ...) and ``idx`` (position in the chunk) for chunks of ``n`` rows.

    Needed where the chunk number itself matters; encoder hooks cut their own chunks.
    """
    if n < 1:
        raise ValueError("the chunk size must be positive")
    return (
        global_rank(df, order_by, "_rank", ranges)
        .withColumn("chunk", F.expr(f"(_rank - 1) div {n}"))
        .withColumn("idx", F.expr(f"cast((_rank - 1) % {n} AS int)"))
        .drop("_rank")
    )


def restore_order(df: DataFrame, key: str = "id") -> DataFrame:
    """Results in input order; the key travels with each row, so this is a plain sort."""
    return df.orderBy(key)


def order_check(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """Positions ``(chunk, idx)`` at which request and response do not pair up.

    Each side has one row per position and the join is on that pair, so no key is hot.
    """
    asked = requests.select("chunk", "idx", F.lit(True).alias("asked"))
    answered = responses.groupBy("chunk", "idx").agg(F.count(F.lit(1)).alias("answers"))
    paired = asked.join(answered, ["chunk", "idx"], "full_outer")
    problem = (
        F.when(F.col("asked").isNull(), "unexpected")
        .when(F.col("answers").isNull(), "missing")
        .when(F.col("answers") > 1, "repeated")
    )
    return paired.withColumn("problem", problem).filter("problem IS NOT NULL").select("chunk", "idx", "problem")


def assert_order(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """Strict form: the plan fails on the first mismatch and returns no rows otherwise."""
    mismatch = F.concat(F.col("problem"), F.lit(" response in chunk "), F.col("chunk").cast("string"))
    checked = order_check(requests, responses).select(F.raise_error(mismatch).cast("string").alias("problem"))
    return checked
