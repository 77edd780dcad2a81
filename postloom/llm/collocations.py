"""Phrase collocations: padded windows of the longest order are counted, ROLLUP gives all shorter counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from postloom.llm.common import Sieve, pick
from postloom.session import materialise

# Characters that end a piece, and letters that are lower-cased.
BREAKS = ".,;:!?\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Parts that the look-up of a frequent word's count is spread over.
SALTS = 16


def _lead_columns(df: DataFrame, text: str, lang: str, order: int) -> DataFrame:
    """``(lang, w1 .. w_order)``: every word of every piece with those that follow it there, null beyond the end.

    A piece is a row before it is cut into words, so no array is longer than a piece. The
    lead columns are the piece's word array shifted against itself.
    """
    rows = pick(df, text=text, lang=lang)
    marked = F.translate(F.coalesce("text", F.lit("")), UPPER + BREAKS + "\t", LOWER + "\n" * len(BREAKS) + " ")
    pieces = rows.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.explode(F.split(marked, "\n")).alias("piece"))
    trimmed = pieces.select("lang", F.trim("piece").alias("piece")).filter("piece <> ''")
    cut = F.split("piece", " ")
    words = trimmed.select("lang", F.when(F.instr("piece", "  ") == 0, cut).otherwise(F.array_remove(cut, "")).alias("words"))
    shifted = [F.col("words"), *[F.slice("words", k + 1, F.size("words")) for k in range(1, order)]]
    zipped = F.arrays_zip(*[column.alias(f"w{k}") for k, column in enumerate(shifted, 1)])
    return words.select("lang", F.inline(zipped)).toDF("lang", *[f"w{k}" for k in range(1, order + 1)])


def _pair(lang: Column, one: Column, two: Column) -> Column:
    return F.xxhash64(lang, one, two)


def phrase_counts(df: DataFrame, text: str = "text", lang: str = "lang", order: int = 3, least: int = 10) -> DataFrame:
    """``(lang, phrase, size, c)`` of all phrases of 1 to ``order`` words that occur ``least`` times or more,
    and each language's number of words as the row of size 0.

    Only windows of the longest order are counted; ROLLUP sums them over their last words,
    so the count of a shorter phrase is that of all windows that begin with it. Windows end
    where the next word makes a pair of fewer than ``least`` occurrences, since no longer
    phrase can then have enough: pairs are counted by hash first and a sieve of the
    frequent ones pads windows, which leaves few different ones. What the sieve passes
    wrongly it passes at every place, so all counts are exact.
    """
    if order < 2:
        raise ValueError("phrases have two words or more")
    pairs = _lead_columns(df, text, lang, 2).filter("w2 IS NOT NULL")
    frequent = pairs.groupBy(_pair(F.col("lang"), F.col("w1"), F.col("w2")).alias("pair")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
    sieve = Sieve.of(materialise(frequent.select("pair"), "frequent-pairs"), F.col("pair"))
    windows = _lead_columns(df, text, lang, order)
    goes_on = F.lit(True)
    names = [f"w{k}" for k in range(1, order + 1)]
    for k in range(2, order + 1):
        # A missing word hashes like none, and is padded in any case.
        windows = sieve.mark(windows, _pair(F.col("lang"), F.col(f"w{k - 1}"), F.col(f"w{k}")), f"_met{k}")
    for k in range(2, order + 1):
        goes_on = goes_on & F.col(f"_met{k}") & F.col(f"w{k}").isNotNull()
        windows = windows.withColumn(f"_p{k}", F.when(goes_on, F.col(f"w{k}")).otherwise(""))
    padded = windows.select("lang", "w1", *[F.col(f"_p{k}").alias(f"w{k}") for k in range(2, order + 1)])
    # Written, because two plans read it; its own rows are the longest phrases, so they need no second shuffle.
    longest = materialise(padded.groupBy("lang", *names).agg(F.count(F.lit(1)).alias("c")), "longest-windows")
    # Bit k of the grouping number tells that the k-th column from the right was summed over.
    sums = longest.rollup("lang", *names[:-1]).agg(F.sum("c").alias("c"), F.grouping_id().alias("level"))
    shorter = sums.select("lang", *names[:-1], F.lit("").alias(names[-1]), "c", (F.lit(order - 1) - F.bit_count("level")).cast("int").alias("size"))
    levels = longest.select("lang", *names, "c", F.lit(order).alias("size")).unionAll(shorter)
    # A window that was padded counts for its words only; '' stands for no word.
    last = F.get(F.array(*names), F.col("size") - 1)
    whole = levels.filter((F.col("size") == 0) | ((F.col("size") > 0) & (F.col("c") >= least) & (last != ""))).select(
        "lang", F.array_join(F.slice(F.array(*names), 1, F.col("size")), " ").alias("phrase"), "size", "c")
    return materialise(whole, "phrase-counts")


def _with_count(cuts: DataFrame, counts: DataFrame, part: str, name: str) -> DataFrame:
    """``cuts`` with the count of a part. A word may begin or end very many phrases; it is looked up once per salt."""
    needed = cuts.select("lang", part, "salt").distinct()
    found = needed.join(counts.select("lang", F.col("phrase").alias(part), F.col("c").alias(name)), ["lang", part])
    return cuts.join(found, ["lang", part, "salt"])


def collocations(
    df: DataFrame, text: str = "text", lang: str = "lang", order: int = 3, least: int = 10, inside_percent: int = 50, top: int = 2_000
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``top`` phrases of 2 to ``order`` words of each language.

    Texts, A-Z in lower case, are cut into pieces at sentence marks and line breaks and
    pieces into words at spaces and tabs. ``a`` counts the phrase, at least ``least``
    times; a cut after ``k`` words gives the counts ``l`` and ``r`` of both parts and the
    score ``floor(1000000 a a / (l r))``; the cut of the lowest score counts, of equal
    ones the first. ``n`` is the language's number of words. Products are 38-digit
    decimals. A phrase inside a longer one that occurs ``inside_percent`` of its times or
    more is dropped. Order: score, then ``a``, both descending, then phrase by bytes; the
    best of each task only are gathered, so a language may be most of the table.

    A null text is empty, a null language ``und``. Rows are documents however often they
    repeat. Other columns are left out. No phrases give no rows.
    """
    counts = phrase_counts(df, text, lang, order, least)
    candidates = counts.filter("size > 1").select("lang", "phrase", "size", F.col("c").alias("a"), F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).alias("salt"))
    words = F.split("phrase", " ")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).withColumn(
        "head", F.array_join(F.slice(words, F.lit(1), F.col("k")), " ")).withColumn("rest", F.array_join(F.slice(words, F.col("k") + 1, F.col("size")), " "))

    parts = counts.filter((F.col("size") > 0) & (F.col("size") < order))
    counted = _with_count(_with_count(cuts, parts, "head", "l"), parts, "rest", "r")
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r")}
    scored = counted.withColumn("score", F.call_function("div", (wide["a"] * wide["a"]) * F.lit(1_000_000).cast("decimal(7,0)"), wide["l"] * wide["r"]))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    # Contiguous parts of two words or more of the longer candidates, each with its most frequent holder.
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda size: F.transform(
        F.sequence(F.lit(1), F.col("size") - size + 1), lambda start: F.array_join(F.slice(words, start, size), " "))))
    inside = candidates.filter("size > 2").select("lang", F.explode(spans).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("held"))
    free = best.join(inside, ["lang", "phrase"], "left").filter(F.col("held").isNull() | (100 * F.col("held") < inside_percent * F.col("a")))

    # Salted parts are ranked first, so the last task of a language gets ``SALTS * top`` rows at most.
    order_by = (F.desc("cut.score"), F.desc("a"), "phrase")
    part = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    near = free.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order_by))).filter(F.col("rank") <= top)
    listed = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order_by))).filter(F.col("rank") <= top)
    # One row per language.
    totals = counts.filter("size = 0").select("lang", F.col("c").alias("n"))
    return listed.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
