"""Reports and aggregates over texts, tables and locations."""

from __future__ import annotations

from math import ceil, floor

from pyspark.sql import DataFrame, Window, functions as F, types as T

from postloom import hooks
from postloom.functions.money import embedding_cost
from postloom.functions.tokens import token_count, truncate_tokens

MAX_TOKENS = 1000


def budget_tokens(df: DataFrame, max_tokens: int = MAX_TOKENS, text_col: str = "text", tokenizer=None) -> DataFrame:
    """Add ``n_tokens`` (before truncation) and ``truncated``; cut the text to the budget.

    A tokenizer hook encodes each text once for all three.
    """
    if tokenizer is not None:
        budget = df.withColumn("_budget", hooks.budget_udf(tokenizer, max_tokens)(F.col(text_col)))
        counted = budget.withColumn("n_tokens", F.col("_budget.n_tokens")).withColumn("truncated", F.col("n_tokens") > max_tokens)
        return counted.withColumn(text_col, F.col("_budget.text")).drop("_budget")
    counted = df.withColumn("n_tokens", token_count(text_col))
    return counted.withColumn("truncated", F.col("n_tokens") > max_tokens).withColumn(
        text_col, truncate_tokens(text_col, max_tokens, "n_tokens")
    )


def batch_stats(budgeted: DataFrame, model: str = "e5") -> DataFrame:
    """One row: texts, tokens before truncation, truncations, mean tokens, embedding cost.

    An empty input gives zero counts and a NULL mean.
    """
    totals = budgeted.agg(
        F.count(F.lit(1)).alias("batches"),
        F.coalesce(F.sum("n_tokens"), F.lit(0)).cast("long").alias("tokens"),
        F.count_if("truncated").alias("truncations"),
    )
    return totals.withColumn("mean_tokens", F.when(F.col("batches") > 0, F.col("tokens") / F.col("batches"))).withColumn(
        "cost", embedding_cost("tokens", model)
    )


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def cost_total(costs: DataFrame, cost_col: str = "cost") -> DataFrame:
    """Number of calls and their total. A cost has three digits, so it is added as a decimal:
    the sum does not depend on the order of the rows."""
    total = F.sum(F.col(cost_col).cast("decimal(20,3)")).cast("double")
    return costs.agg(F.count(F.lit(1)).alias("calls"), F.coalesce(total, F.lit(0.0)).alias("total_cost"))


def distinct_locations(df: DataFrame, column: str = "location") -> DataFrame:
    return df.select(column).distinct()


def location_token_counts(df: DataFrame, column: str = "location") -> DataFrame:
    """``(token, n)`` over whitespace-separated tokens, most frequent first.

    Counts are combined inside each task before the shuffle, so frequent tokens are cheap.
    """
    # The outer form spares a derived filter that would split every location a second time.
    tokens = df.select(F.explode_outer(F.split(column, r"\s+")).alias("token")).filter("token <> ''")
    return tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "token")


# 3 scans leave about a 30,000th of the rows around a rank.
NARROWINGS = 2
_QUARTILES = {"25%": 0.25, "50%": 0.5, "75%": 0.75}


def describe_table(df: DataFrame, columns=None, accuracy: int = 1000) -> DataFrame:
    """``(column, stat, value)`` with count, mean, std, min, exact quartiles and max.

    NULL and NaN are skipped; a quartile between two values is interpolated linearly.
    The wanted ranks are found by narrowing, in NARROWINGS rounds for any size: a mergeable
    sketch proposes a value interval around each rank, and one scan counts the rows below
    and inside it, of which there are about six in ``accuracy``. The rows inside the last
    intervals are counted per value and ranked. Every pass aggregates inside the tasks; no
    column is sorted whole or collected in one task. The first sketch comes with the other
    statistics. The result is a small report made from the final counts.
    """
    spark = df.sparkSession
    names = list(columns) if columns else [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    if not names:
        raise ValueError("no numeric column to describe")

    def clean(name):
        value = F.col(f"`{name}`").cast("double")
        return F.when(~F.isnan(value), value)

    values = df.select(*[clean(name).alias(f"v{i}") for i, name in enumerate(names)])
    quartile_ends = [end for p in _QUARTILES.values() for end in _ends(p, accuracy)]
    facts = values.agg(*[
        F.struct(F.count(v), F.avg(v), F.stddev_samp(v), F.min(v), F.max(v), F.percentile_approx(v, quartile_ends, accuracy)).alias(v)
        for v in values.columns
    ]).first()

    targets, proposals = {}, []
    for v in values.columns:
        n, sketch = facts[v][0], facts[v][5]
        for i, p in enumerate(_QUARTILES.values()) if n else ():
            for rank in {floor(p * (n - 1)), ceil(p * (n - 1))}:
                targets[v, rank] = _RankTarget(v, rank, n)
                proposals.append((targets[v, rank], sketch[2 * i], sketch[2 * i + 1]))
    _count_around(values, proposals)
    for _ in range(NARROWINGS - 1):
        # A target with one row left has nothing to narrow.
        _count_around(values, _propose(values, [t for t in targets.values() if t.value is None and t.inside > 1], accuracy))
    _select(values, [t for t in targets.values() if t.value is None])

    rows = []
    for name, v in zip(names, values.columns):
        n, mean, std, low, high, _ = facts[v]
        found = {"count": float(n), "mean": mean, "std": std, "min": low, "max": high}
        for stat, p in _QUARTILES.items():
            position = p * (n - 1)
            if n:
                left, right = targets[v, floor(position)].value, targets[v, ceil(position)].value
                found[stat] = left + (right - left) * (position - floor(position))
        rows.extend((name, stat, found.get(stat)) for stat in ("count", "mean", "std", "min", *_QUARTILES, "max"))
    return spark.createDataFrame(rows, "column string, stat string, value double")


class _RankTarget:
    """A rank of one column and the open value interval known to hold it."""

    def __init__(self, column: str, rank: int, inside: int):
        self.column, self.rank, self.inside = column, rank, inside
        self.low = self.high = self.value = None
        self.below = 0

    def interval(self):
        return self.column, self.low, self.high, self.below

    def split(self, low, high, under_low, upto_low, under_high, upto_high) -> None:
        """Continue on the side of the proposed values ``low`` and ``high`` with the rank."""
        end = self.below + self.inside
        if under_low <= self.rank < upto_low:
            self.value = low
        elif under_high <= self.rank < upto_high:
            self.value = high
        elif self.rank < under_low:
            self.high, self.inside = low, under_low - self.below
        elif self.rank >= upto_high:
            self.low, self.below, self.inside = high, upto_high, end - upto_high
        else:
            self.low, self.high, self.below, self.inside = low, high, upto_low, under_high - upto_low


def _inside(column: str, low, high):
    condition = F.col(column).isNotNull()
    if low is not None:
        condition &= F.col(column) > F.lit(low)
    if high is not None:
        condition &= F.col(column) < F.lit(high)
    return condition


def _ends(share: float, accuracy: int) -> list[float]:
    return [max(share - 2.0 / accuracy, 0.0), min(share + 2.0 / accuracy, 1.0)]


def _propose(values: DataFrame, wide: list[_RankTarget], accuracy: int) -> list[tuple]:
    """One scan: for each target, values shortly before and after its rank."""
    groups: dict[tuple, list[_RankTarget]] = {}
    for target in wide:
        groups.setdefault(target.interval(), []).append(target)
    if not groups:
        return []
    sketches = []
    for (column, low, high, below), members in groups.items():
        ends = [end for t in members for end in _ends((t.rank - below) / (t.inside - 1), accuracy)]
        sketches.append(F.percentile_approx(F.when(_inside(column, low, high), F.col(column)), ends, accuracy))
    found = values.agg(*[s.alias(f"s{i}") for i, s in enumerate(sketches)]).first()
    return [
        (t, ends[2 * i], ends[2 * i + 1])
        for ends, members in zip(found, groups.values()) for i, t in enumerate(members)
    ]


def _count_around(values: DataFrame, proposals: list[tuple]) -> None:
    """One scan that counts the rows around the proposed values and narrows the targets.

    The proposed values leave the interval, so even a value that fills most rows is passed
    in one step and the interval always shrinks.
    """
    if not proposals:
        return
    counts = []
    for t, low, high in proposals:
        v = F.col(t.column)
        counts += [F.count_if(v < low), F.count_if(v <= low), F.count_if(v < high), F.count_if(v <= high)]
    counted = values.agg(*[c.alias(f"c{i}") for i, c in enumerate(counts)]).first()
    for i, (t, low, high) in enumerate(proposals):
        t.split(low, high, *counted[4 * i:4 * i + 4])


def _select(values: DataFrame, open_targets: list[_RankTarget]) -> None:
    """Read the values at the remaining ranks from the few rows inside their intervals."""
    groups: dict[tuple, list[_RankTarget]] = {}
    for target in open_targets:
        groups.setdefault(target.interval(), []).append(target)
    if not groups:
        return
    entries, hit = [], F.lit(False)
    for number, ((column, low, high, below), members) in enumerate(groups.items()):
        inside = F.when(_inside(column, low, high), F.col(column))
        entries.append(F.struct(F.lit(number).alias("r"), inside.alias("v")))
        for t in members:
            at = t.rank - below
            hit = hit | ((F.col("r") == number) & (F.col("upto") > at) & (F.col("upto") - F.col("c") <= at))
    counted = (
        values.select(F.inline(F.array(*entries))).filter("v IS NOT NULL").groupBy("r", "v").agg(F.count(F.lit(1)).alias("c"))
    )
    ranked = counted.withColumn("upto", F.sum("c").over(Window.partitionBy("r").orderBy("v")))
    rows = ranked.filter(hit).collect()  # one row per wanted rank at most
    for number, ((_, _, _, below), members) in enumerate(groups.items()):
        for t in members:
            t.value = next(
                r["v"] for r in rows if r["r"] == number and r["upto"] - r["c"] <= t.rank - below < r["upto"]
            )
