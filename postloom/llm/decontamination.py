"""Benchmark decontamination by templates: typed placeholders, hashed windows, aligned tokens, slot consistency."""

from __future__ import annotations

import re
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from postloom.llm.common import Sieve, bitmap_of, in_bitmap, mixed, pick, released
from postloom.session import materialise

# Tokens of a window: of items of LONG_ITEM tokens or more, one changed token anywhere leaves
# a whole window of WINDOW; of shorter ones, from twice SHORT_WINDOW on, one of SHORT_WINDOW.
WINDOW, LONG_ITEM, SHORT_WINDOW = 5, 10, 4
# A place in a document is compared with an item token by token if windows cover this share
# of the item or as many tokens as make a verbatim run.
LEAST_SEEDED, VERBATIM_RUN = 0.4, 13
# Characters that are split into tokens at once.
BLOCK_CHARS = 1 << 20
TOKEN = re.compile(r"[^\W_]+(?:[.,]\d+)*|[.!?]")
BREAK = re.compile(r"\s")
FOLD = np.uint64(0x9E3779B97F4A7C15)

# Units that become placeholders when they follow a number.
UNITS = frozenset(
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg t ton tons oz lb lbs pound pounds ml l liter liters litre litres "
    "gallon gallons s sec second seconds min minute minutes h hour hours day days week weeks month months year years "
    "usd eur dollar dollars euro euros cent cents percent mph kmh degree degrees c f k w kw v a hz".split())

# The kind of a token is in the low bits of its hash.
WORD, CAPITAL, NUMBER, END = range(4)
UNIT_BIT = np.uint64(4)
KIND = np.uint64(7)
PLACE = {kind: np.uint64(xxhash.xxh3_64_intdigest(name) & ~7) for kind, name in ((NUMBER, b"<number>"), (CAPITAL, b"<name>"), ("unit", b"<unit>"))}


class TypedTokens(dict):
    """Hashes of lower-cased tokens with their kind, remembered for a bounded number of tokens."""

    def __init__(self, limit: int = 100_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, token: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        lower = token.lower()
        kind = END if token in ".!?" else NUMBER if token[0].isdigit() else CAPITAL if token[0] != lower[0] else WORD
        value = (xxhash.xxh3_64_intdigest(lower.encode("utf-8", "surrogatepass")) & ~7) | kind | (4 if lower in UNITS else 0)
        self[token] = value
        return value


def _blocks(text: str) -> Iterator[str]:
    start = 0
    while start < len(text):
        cut = BREAK.search(text, start + BLOCK_CHARS) if start + BLOCK_CHARS < len(text) else None
        end = cut.start() if cut else len(text)
        yield text[start:end]
        start = end


def canonical(text: str, known: TypedTokens) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(template, caseless, literal, slot)`` per token, without punctuation.

    ``template`` has a placeholder's hash for a number, for a unit after a number and for
    a name (a capitalised token that does not begin a sentence). ``caseless`` has none for
    names: a text in capitals, or without any, matches by that reading. ``literal`` is the
    hash of the lower-cased token; ``slot`` tells where ``template`` differs from it.
    """
    values = np.concatenate([np.zeros(0, np.uint64), *(np.fromiter(map(known.__getitem__, TOKEN.findall(part)), np.uint64) for part in _blocks(text))])
    kind = values & np.uint64(3)
    literal = values & ~KIND
    template = literal.copy()
    begins = np.ones(len(values), dtype=bool)
    begins[1:] = kind[:-1] == END
    number = kind == NUMBER
    after_number = np.zeros(len(values), dtype=bool)
    after_number[1:] = number[:-1]
    name = (kind == CAPITAL) & ~begins
    unit = after_number & ((values & UNIT_BIT) != 0)
    template[number], template[unit] = PLACE[NUMBER], PLACE["unit"]
    caseless = template.copy()
    template[name] = PLACE[CAPITAL]
    words = kind != END
    return template[words], caseless[words], literal[words], (number | name | unit)[words]


def windows(template: np.ndarray, size: int = WINDOW) -> np.ndarray:
    """Hashes of all runs of ``size`` tokens; fewer tokens are one run, none is no run."""
    if not len(template):
        return template
    width = min(size, len(template))
    last = len(template) - width + 1
    h = template[:last].copy()
    for k in range(1, width):
        h *= FOLD
        h += template[k:last + k]
    return mixed(h + np.uint64(width))


def window_size(tokens: int) -> int:
    return WINDOW if tokens >= LONG_ITEM else min(SHORT_WINDOW, tokens)


# Windows of literal tokens are no windows of templates.
LITERAL = np.uint64(0xA0761D6478BD642F)


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens and windows of the items; an item without words is left out.

    Windows of placeholders only would meet every table of numbers. They are left out, and
    an item that has no others, or fewer than SHORT_WINDOW tokens, is known by its literal tokens.
    """
    known = TypedTokens()
    for batch in released(batches):
        rows: list[dict] = []
        for asked, value in zip(batch.column("asked").to_pylist(), batch.column("text")):
            template, caseless, literal, slot = canonical(value.as_py() or "", known)
            n = len(literal)
            if not n:
                continue
            size = window_size(n)
            found: set[tuple[int, int]] = set()
            if n >= SHORT_WINDOW:
                for reading in (template, caseless):
                    filled = np.convolve(reading != literal, np.ones(size, dtype=np.int64), "valid")
                    hashes = windows(reading, size).view(np.int64)
                    found.update((int(hashes[i]), int(i)) for i in np.flatnonzero(filled < size))
            plain = not found
            if plain:
                found = {(int(h), i) for i, h in enumerate((windows(literal, size) ^ LITERAL).view(np.int64))}
            rows.append({
                "asked": asked, "size": size, "plain": plain, "n_tokens": n, "template": template.view(np.int64), "caseless": caseless.view(np.int64),
                "literal": literal.view(np.int64), "slot": slot, "seeds": [{"window": h, "item_pos": i} for h, i in sorted(found)]})
        longs = pa.list_(pa.int64())
        schema = pa.schema([
            ("asked", pa.int64()), ("size", pa.int32()), ("plain", pa.bool_()), ("n_tokens", pa.int64()), ("template", longs), ("caseless", longs), ("literal", longs),
            ("slot", pa.list_(pa.bool_())), ("seeds", pa.list_(pa.struct([("window", pa.int64()), ("item_pos", pa.int64())])))])
        yield pa.RecordBatch.from_pylist(rows, schema)


ITEM_SCHEMA = """asked bigint, size int, plain boolean, n_tokens bigint, template array<bigint>, caseless array<bigint>, literal array<bigint>,
    slot array<boolean>, seeds array<struct<window:bigint,item_pos:bigint>>"""


def _document_windows(docs: DataFrame, bitmap: np.ndarray, kinds: list[tuple[int, bool]]) -> DataFrame:
    """``(key, window, pos)`` of the windows, of the items' sizes and in all readings, that a bitmap may hold."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = TypedTokens()
        for batch in released(batches):
            rows, hashes, places = [], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for number, value in enumerate(batch.column("text")):
                template, caseless, literal, _ = canonical(value.as_py() or "", known)
                for size, plain in kinds:
                    if len(literal) < size:
                        continue
                    found = windows(literal, size) ^ LITERAL if plain else windows(template, size)
                    at = np.flatnonzero(in_bitmap(shared.value, found))
                    if not plain:
                        other = windows(caseless, size)
                        twice = np.flatnonzero((found != other) & in_bitmap(shared.value, other))
                        found, at = np.concatenate([found[at], other[twice]]), np.concatenate([at, twice])
                    else:
                        found = found[at]
                    hashes.append(found)
                    places.append(at)
                    rows.append(np.full(len(at), number))
            taken = batch.column("key").take(pa.array(np.concatenate(rows or [np.zeros(0, np.int64)])))
            yield pa.RecordBatch.from_arrays([taken, pa.array(np.concatenate(hashes).view(np.int64)), pa.array(np.concatenate(places))], ["key", "window", "pos"])

    return docs.mapInArrow(emit, f"key {docs.schema['key'].dataType.simpleString()}, window bigint, pos bigint")


def aligned(item: dict, document: tuple[np.ndarray, ...], diagonal: int) -> dict:
    """An item against the document's tokens near a diagonal, in the reading that aligns more of them.

    Insertions, deletions and changed tokens are left unaligned; a token may be shifted by
    a quarter of the item's length.
    """
    n = item["n_tokens"]
    margin = max(3, n // 4)
    low, high = max(0, diagonal - margin), max(0, diagonal + n + margin)
    literal = document[2][low:high].tolist()
    best: dict = {"n_aligned": -1}
    for name, tokens in (("literal", document[2]),) if item["plain"] else (("template", document[0]), ("caseless", document[1])):
        blocks = SequenceMatcher(None, item[name], tokens[low:high].tolist(), autojunk=False).get_matching_blocks()
        count = sum(block.size for block in blocks)
        if count <= best["n_aligned"]:
            continue
        longest, fillers = 0, {}
        for start, at, size in blocks:
            run = 0
            for i, j in zip(range(start, start + size), range(at, at + size)):
                run = run + 1 if item["literal"][i] == literal[j] else 0
                longest = max(longest, run)
                if item["slot"][i]:
                    fillers.setdefault(item["literal"][i], set()).add(literal[j])
        best = {
            "n_aligned": count, "longest_run": longest, "n_slots": len(fillers), "n_consistent": sum(len(f) == 1 for f in fillers.values()),
            "n_own": sum(f == {own} for own, f in fillers.items())}
    return best


ALIGNED_SCHEMA = "asked bigint, n_tokens bigint, n_aligned bigint, longest_run bigint, n_slots bigint, n_consistent bigint, n_own bigint"


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known, columns = TypedTokens(), [part.split()[0] for part in ALIGNED_SCHEMA.split(", ")]
    for batch in released(batches):
        keys, out = [], []
        for number, (value, places) in enumerate(zip(batch.column("text"), batch.column("places"))):
            # Signed, as the items' tokens are in their table.
            document = tuple(part.view(np.int64) for part in canonical(value.as_py() or "", known)[:3])
            for item in places.as_py():
                out.append({"asked": item["asked"], "n_tokens": item["n_tokens"], **aligned(item, document, item["diagonal"])})
                keys.append(number)
        table = pa.RecordBatch.from_pylist(out, pa.schema([(c, pa.int64()) for c in columns]))
        yield pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(keys, pa.int64())), *table.columns], ["key", *columns])


def contaminated(
    documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
    least_cover: float = 0.8, least_consistent: float = 0.8, verbatim_run: int = VERBATIM_RUN,
) -> DataFrame:
    """``(key, item, n_tokens, n_aligned, longest_run, cover, n_slots, n_consistent, kind)`` of contaminated pairs.

    A document holds an item if at one place at least ``least_cover`` of the item's
    template tokens are aligned with its own, or ``verbatim_run`` tokens in a row are the
    item's own; and at least ``least_consistent`` of the item's aligned slot fillers are
    each replaced by one filler throughout. ``kind`` is ``exact`` if all tokens are the
    item's, ``edited`` if the fillers are but some tokens are not, else
    ``re-parameterised``.

    Places are found by a join of hashed template windows, whose diagonals (place in the
    document less place in the item) are near each other; there the tokens are compared.
    One changed token leaves a window in items of eight tokens and more; items of fewer
    than four tokens must occur literally. Documents are read once for the windows: a
    fixed-size bitmap of the benchmark's drops nearly all of theirs in place. The texts of
    candidates alone are read again, beside all their places.

    An item without words matches nothing. Each different text of a repeated item id is
    looked for. Rows that repeat a key are one document. Null texts are empty; rows without
    key or item id, and other columns, are left out. Empty tables give no rows.
    """
    docs = pick(documents, key=key, text=text).filter("key IS NOT NULL")
    # Each different text of an item id is an item of its own, known by its hash.
    named = pick(benchmark, item=item, text=item_text).filter("item IS NOT NULL").distinct().withColumn("asked", F.xxhash64("item", "text"))
    items = materialise(named.select("asked", "text").mapInArrow(_item_rows, ITEM_SCHEMA), "benchmark-items")
    seeds = materialise(items.select("asked", "size", "n_tokens", F.inline("seeds")), "benchmark-windows")
    kinds = sorted((r["size"], r["plain"]) for r in items.select("size", "plain").distinct().collect())  # ten at most
    found = _document_windows(docs, bitmap_of(F.col("window"), seeds), kinds)
    met = materialise(found.join(seeds, "window").withColumn("diagonal", F.col("pos") - F.col("item_pos")).drop("window", "pos"), "window-matches")

    # A copy lies on diagonals near each other. Every diagonal is in two areas, each twice
    # as wide as the item is long, so that one area has a whole copy.
    first = F.floor(F.col("diagonal") / F.col("n_tokens"))
    pair = ["key", "asked"]
    placed = met.withColumn("area", F.explode(F.array(first, first + 1)))
    steps = placed.select(*pair, "area", "n_tokens", "size", "item_pos").distinct()
    following = F.lead("item_pos").over(Window.partitionBy(*pair, "area").orderBy("item_pos"))
    new = F.coalesce(F.least(F.col("size").cast("long"), following - F.col("item_pos")), F.col("size").cast("long"))
    covered = steps.withColumn("new", new).groupBy(*pair, "area", "n_tokens").agg(F.sum("new").alias("covered"))
    likely = covered.filter(F.col("covered") >= F.least(F.lit(float(verbatim_run)), LEAST_SEEDED * F.col("n_tokens"))).select(*pair, "area")
    # The diagonal of most windows is where the tokens are compared.
    votes = placed.join(likely, [*pair, "area"], "left_semi").groupBy(*pair, "area", "diagonal").agg(F.count(F.lit(1)).alias("n"))
    main = votes.groupBy(*pair, "area").agg(F.max(F.struct("n", (-F.col("diagonal")).alias("back"))).alias("m"))
    places = main.select(*pair, (-F.col("m.back")).alias("diagonal")).distinct().join(items.drop("seeds", "size"), "asked")
    by_document = materialise(places.groupBy("key").agg(F.collect_list(F.struct("asked", "diagonal", "n_tokens", "plain", "template", "caseless", "literal", "slot")).alias("places")), "contaminated-places")

    sieve = Sieve.of(by_document, F.xxhash64("key"))
    reread = sieve.mark(docs, F.xxhash64("key"), "met").filter("met").select("key", "text").join(by_document, "key")
    compared = reread.mapInArrow(_compared, f"key {docs.schema['key'].dataType.simpleString()}, {ALIGNED_SCHEMA}")
    held = (F.col("n_aligned") >= least_cover * F.col("n_tokens")) | (F.col("longest_run") >= verbatim_run)
    judged = compared.filter(held & (F.col("n_consistent") >= least_consistent * F.col("n_slots")))
    values = ["n_aligned", "longest_run", "n_own", "n_consistent", "n_slots", "n_tokens"]
    best = judged.groupBy(*pair).agg(F.max(F.struct(*values)).alias("b")).select(*pair, "b.*")
    kind = F.when(F.col("n_own") < F.col("n_slots"), "re-parameterised").when(F.col("longest_run") == F.col("n_tokens"), "exact").otherwise("edited")
    return best.join(named.select("asked", "item"), "asked").select(
        F.col("key").alias(key), F.col("item").alias(item), "n_tokens", "n_aligned", "longest_run", (F.col("n_aligned") / F.col("n_tokens")).alias("cover"),
        "n_slots", "n_consistent", kind.alias("kind"))
