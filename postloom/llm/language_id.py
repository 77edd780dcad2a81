"""Language identification: the family first, then one-versus-one linear machines within it."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from postloom.llm.common import hashed_sample, pick, released
from postloom.session import materialise

FEATURE_BITS = 11
FEATURES = 1 << FEATURE_BITS
# The machines are fitted on at most this many labelled documents, shared by the languages.
TRAINING_ROWS = 4_000
# Rows that a machine multiplies at once.
BLOCK_ROWS = 512
# Columns of the curvature matrix that are added at once.
BLOCK_FEATURES = 256
UNKNOWN = "und"
# Bytes of lower-cased text that are counted at once.
BLOCK_CHARS = 1 << 20

# Families of common language codes; any other code is a family of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fo", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "rm", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "ky", "tr", "tt", "uz"),
    "indo-aryan": ("bn", "gu", "hi", "mr", "ne", "pa", "si", "ur"),
    "semitic": ("am", "ar", "he", "mt"),
}


def family_of(language: str) -> str:
    return next((family for family, codes in FAMILIES.items() if language in codes), language)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def features(text: str) -> np.ndarray:
    """Square roots of the shares of hashed byte trigrams of the whole lower-cased text."""
    counts = np.zeros(FEATURES, dtype=np.int64)
    for start in range(0, len(text), BLOCK_CHARS):
        part = " " + " ".join(text[start:start + BLOCK_CHARS].lower().split()) + " "
        b = np.frombuffer(part.encode("utf-8", "surrogatepass"), dtype=np.uint8).astype(np.uint32)
        if len(b) >= 3:
            code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
            counts += np.bincount((code * np.uint32(2654435761)) >> np.uint32(32 - FEATURE_BITS), minlength=FEATURES)
    total = counts.sum()
    return np.sqrt(counts / total) if total else np.zeros(FEATURES)


def linear_machine(x: np.ndarray, y: np.ndarray, cost: float = 10.0, steps: int = 20) -> np.ndarray:
    """Weights and bias of a linear support vector machine with squared hinge loss.

    Newton steps on the primal problem; both classes weigh the same in all. ``y`` is +1
    or -1. The arrays are bounded by TRAINING_ROWS and FEATURES; products are taken
    BLOCK_ROWS rows at a time, so that ``x`` is not copied.
    """
    size = x.shape[1] + 1
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * cost * len(y) / 10
    blocks = [slice(i, i + BLOCK_ROWS) for i in range(0, len(x), BLOCK_ROWS)]

    def rows(block: slice) -> np.ndarray:
        return np.hstack([x[block].astype(np.float64), np.ones((len(x[block]), 1))])

    w = np.zeros(size)
    ridge = np.full(size, 1.0)
    ridge[-1] = 1e-3
    active = None
    for _ in range(steps):
        now = np.concatenate([y[block] * (rows(block) @ w) < 1 for block in blocks])
        if active is not None and np.array_equal(now, active):
            break
        active = now
        hessian, right = np.diag(ridge), np.zeros(size)
        for block in blocks:
            chosen = active[block]
            xa, wa = rows(block)[chosen], weight[block][chosen]
            for c in range(0, size, BLOCK_FEATURES):
                hessian[c:c + BLOCK_FEATURES] += (xa[:, c:c + BLOCK_FEATURES] * wa[:, None]).T @ xa
            right += xa.T @ (wa * y[block][chosen])
        w = np.linalg.solve(hessian, right)
    return w


@dataclass
class LanguageModel:
    """One-versus-rest machines for families, one-versus-one machines within each family."""

    families: dict[str, list[str]]
    family_weights: np.ndarray  # (families, FEATURES + 1)
    pair_weights: dict[tuple[str, str], np.ndarray]

    def predict(self, x: np.ndarray) -> tuple[str, float]:
        """The language of a feature vector, and a score: the product of both steps' confidence."""
        if not self.families:
            return UNKNOWN, 0.0
        names = list(self.families)
        margins = self.family_weights[:, :-1] @ x + self.family_weights[:, -1]
        best = int(np.argmax(margins))
        score = 1.0 if len(names) == 1 else _sigmoid(margins[best])
        members = self.families[names[best]]
        votes, strength = dict.fromkeys(members, 0), dict.fromkeys(members, 0.0)
        for a, b in combinations(members, 2):
            w = self.pair_weights[a, b]
            margin = float(w[:-1] @ x + w[-1])
            votes[a if margin >= 0 else b] += 1
            strength[a] += margin
            strength[b] -= margin
        # Most votes; then the larger sum of margins; then the first by name.
        language = min(members, key=lambda m: (-votes[m], -strength[m], m))
        if len(members) > 1:
            score *= _sigmoid(strength[language] / (len(members) - 1))
        return language, score


def _sigmoid(margin: float) -> float:
    return 1 / (1 + math.exp(-max(-50.0, min(50.0, 4 * float(margin)))))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in released(batches):
        vectors = [features(value.as_py()).astype(np.float32).tobytes() for value in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(vectors, pa.binary())], ["lang", "vector"])


def held_out(key: Column, fold: int = 2, folds: int = 4) -> Column:
    """Whether a key is of the fold that nothing is learned from."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == fold, F.lit(False))


def fit_languages(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", training_rows: int = TRAINING_ROWS) -> LanguageModel:
    """Learn from a bounded sample of the labelled rows that are not held out.

    Per language the keys with the smallest hashes are taken, at most ``training_rows``
    divided by the number of languages. The sample's keys are chosen from a narrow scan and
    are broadcast, being bounded. Each machine is fitted by a task of its own, whose group
    is the part of the sample that it separates (8 KB a row); the driver gets the weights. Rows without text, letters or language are not learned from.
    """
    rows = pick(df, key=key, text=text, lang=lang).filter(~held_out(F.col("key")) & F.col("lang").isNotNull())
    narrow = rows.select("key", "lang")
    counts = {r["lang"]: r["count"] for r in narrow.groupBy("lang").count().limit(training_rows + 1).collect()}
    if not counts:
        return LanguageModel({}, np.zeros((0, FEATURES + 1)), {})
    if len(counts) > training_rows:
        raise ValueError(f"more than {training_rows} languages; raise training_rows")
    chosen = hashed_sample(narrow, "lang", "key", training_rows // len(counts), counts).select("key").distinct()
    sample = rows.join(F.broadcast(chosen), "key", "left_semi").filter(F.col("text").rlike(r"\p{L}"))
    vectors = materialise(sample.select("lang", "text").mapInArrow(_features, "lang string, vector binary"), "language-vectors")
    languages = sorted(r["lang"] for r in vectors.select("lang").distinct().collect())
    families: dict[str, list[str]] = {}
    for language in languages:
        families.setdefault(family_of(language), []).append(language)
    # The sides of each machine, by number: a family against the rest, or one language against another.
    machines: list[tuple[list[str], list[str]]] = [(own, [l for l in languages if l not in own]) for own in families.values() if len(families) > 1]
    pairs = [pair for members in families.values() for pair in combinations(members, 2)]
    machines += [([a], [b]) for a, b in pairs]
    sides = [(l, number, side) for number, both in enumerate(machines) for l, side in [*((l, 1.0) for l in both[0]), *((l, -1.0) for l in both[1])]]
    fitted: dict[int, np.ndarray] = {}
    if sides:
        table = df.sparkSession.createDataFrame(sides, "lang string, machine int, side double")  # a few rows per language
        weights = vectors.join(F.broadcast(table), "lang").groupBy("machine").applyInArrow(_fitted, "machine int, weights binary").collect()
        fitted = {r["machine"]: np.frombuffer(bytes(r["weights"])) for r in weights}
    n = len(machines) - len(pairs)
    rest = [fitted[i] for i in range(n)] if n else [np.zeros(FEATURES + 1) for _ in families]
    return LanguageModel(families, np.array(rest).reshape(len(families), FEATURES + 1), {pair: fitted[n + i] for i, pair in enumerate(pairs)})


def _fitted(rows: pa.Table) -> pa.Table:
    """One machine from its rows of the sample, in an order that does not depend on partitions."""
    rows = rows.sort_by([("lang", "ascending"), ("vector", "ascending")])
    x, y = np.empty((rows.num_rows, FEATURES), dtype=np.float32), rows.column("side").to_numpy()
    for i, vector in enumerate(rows.column("vector")):
        x[i] = np.frombuffer(vector.as_buffer(), dtype=np.float32)
    machine = rows.column("machine")[0].as_py()
    del rows
    return pa.table({"machine": pa.array([machine], pa.int32()), "weights": pa.array([linear_machine(x, y).tobytes()], pa.binary())})


def predict_languages(df: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, lang_pred, score)`` from the text alone, one row per input row.

    ``und`` with score 0 for a text that is null or has no letter. Rows are scored where
    they are. Repeated rows and null keys keep their rows.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            found = [shared.value.predict(features(t)) if has_letter(t := value.as_py()) else (UNKNOWN, 0.0) for value in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                ["key", "lang_pred", "score"])

    rows = pick(df, key=key, text=text)
    return rows.mapInArrow(score, f"key {rows.schema['key'].dataType.simpleString()}, lang_pred string, score double").withColumnRenamed("key", key)


def keep_identified(df: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The rows whose text is in a language the model knows; the columns stay.

    Every text with a letter gets one of the learned languages, however unlike them it is:
    what this drops is null and letterless text (and all rows if nothing was learned). A
    threshold on the margin would drop short and mixed documents that are clean. The text passes once through Python beside its row, which stays where it is.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def language(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: shared.value.predict(features(t))[0] if has_letter(t) else UNKNOWN)

    names = df.columns
    rows = df.toDF(*[f"_{i}" for i in range(len(names))])
    found = rows.withColumn("_language", language.asNondeterministic()(F.col(f"_{names.index(text)}")))
    return found.filter(F.col("_language") != UNKNOWN).drop("_language").toDF(*names)
