"""Mixing to target weights: soft domain membership, then rates by projected gradient."""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from postloom.llm.common import Sieve, hashed_sample, pick
from postloom.session import materialise

DOMAINS = ("good", "poor", "toxic")
# The classifier is fitted on at most this many different labelled texts of each domain ...
TRAINING_ROWS = 2_000
# ... by words and beginnings of words (of so many characters, written with a star) that
# are in so many of the texts, so many standard errors and so many times more frequent in
# some domain than elsewhere; of each domain at most this many. For a word of one domain
# only, z depends on the texts that hold it and not on the size of the sample: at the share
# of toxic documents, an eighth, two texts suffice. What a word then weighs is fitted.
BEGINNINGS = (4, 5, 6)
LEAST_TEXTS, LEAST_Z, LEAST_LIFT, TELLING_WORDS = 2, 3.5, 3.0, 2_000
# Penalty of the squared distance of weights from where they start, and gradient steps of the fit.
RIDGE, FIT_STEPS = 0.3, 300
# Penalty of rates that are not 1, against the squared distance from the targets; it makes
# the best rates unique and spreads use over documents.
RATE_RIDGE = 1e-3
NEVER = -1e6
SEPARATORS = ".,;:?()\"\n\t\r\f\x0b"
SYMBOLS = "!%&*#$|"


def bound(value: Column, use) -> Column:
    """``use(value)``, with the value computed once however often ``use`` refers to it."""
    return F.get(F.transform(F.array(value), use), 0)


def word_list(text: Column) -> Column:
    """Lower-case words and runs of symbols of the whole text, in order; none for a null text."""
    spaced = F.translate(F.lower(F.coalesce(text, F.lit(""))), SEPARATORS, " " * len(SEPARATORS))
    return F.array_remove(F.split(F.regexp_replace(spaced, r"([!%&*#$|]+)", " $1 "), " "), "")


def with_beginnings(words: Column) -> Column:
    """The words, and beginnings of those that are longer, each as often as words have it."""
    def starts(n: int) -> Column:
        return F.transform(F.filter(words, lambda w: F.length(w) > n), lambda w: F.concat(F.substring(w, 1, n), F.lit("*")))

    return F.concat(words, *[starts(n) for n in BEGINNINGS])


def looked_up(words: Column, values: Mapping[str, object], kind: str) -> Column:
    """The values of the words and of their beginnings, as often as ``words`` has them, from a literal table.

    The table has a bucket per hash of the first characters, so a word makes one probe and
    most words meet an empty bucket; the forms in the bucket are compared whole.
    """
    head = min(BEGINNINGS)
    size = 1 << (8 * max(1, len(values))).bit_length()
    buckets: list[list] = [[] for _ in range(size)]

    def put(form: str, more: bool, value: object) -> None:
        at = xxhash.xxh64_intdigest(form[:head].encode("utf-8", "surrogatepass"), 42) & (size - 1)
        buckets[at].append({"form": form, "more": more, "value": value})

    for word, value in values.items():
        if not word.endswith("*") or not word.strip(SYMBOLS):
            put(word, False, value)
        if word.endswith("*") and len(word) - 1 in BEGINNINGS:
            put(word[:-1], True, value)
    entry = f"struct<form:string,more:boolean,value:{kind}>"
    table = F.from_json(F.lit(json.dumps([b or None for b in buckets])), f"array<array<{entry}>>")

    def found(w: Column) -> Column:
        bucket = F.get(table, F.xxhash64(F.substring(w, 1, head)).bitwiseAND(F.lit(size - 1)).cast("int"))
        return F.filter(bucket, lambda e: F.startswith(w, e["form"]) & ((w == e["form"]) != e["more"]))

    hits = F.filter(F.transform(words, found), lambda b: F.size(b) > 0)
    return F.transform(F.flatten(hits), lambda e: e["value"])


def text_digest(text: Column) -> Column:
    """A hash that texts share if they differ in case, separators and spaces only; null texts count as empty."""
    return F.xxhash64(F.translate(F.lower(F.coalesce(text, F.lit(""))), SEPARATORS + " ", ""))


def label_domain(quality: Column, toxic: Column) -> Column:
    """The domain that a row of the labelled table stands for; null if a label is missing."""
    return F.when(toxic == 1, "toxic").when((toxic == 0) & (quality == 1), "good").when((toxic == 0) & (quality == 0), "poor")


@dataclass(frozen=True)
class DomainModel:
    """A log-linear model of telling words and beginnings; its size is bounded by TELLING_WORDS of each domain.

    ``priors`` are the log scores of a text without any of the words; ``weights`` what each
    adds each time that it occurs.
    """

    domains: Sequence[str]
    priors: Sequence[float]
    words: Sequence[str] = field(default_factory=list)
    weights: Sequence[Sequence[float]] = field(default_factory=list)

    def posteriors(self, words: Column) -> Column:
        """``array<double>``, one probability per domain, from a list of words."""
        scores = F.lit([float(p) for p in self.priors])
        if self.words:
            rows = looked_up(words, dict(zip(self.words, self.weights)), "array<double>")
            scores = F.aggregate(rows, scores, lambda sums, row: F.zip_with(sums, row, lambda a, b: a + b))

        def softmax(s):
            return bound(F.array_max(s), lambda top: bound(F.transform(s, lambda x: F.exp(x - top)), shares))

        def shares(powers):
            return bound(F.aggregate(powers, F.lit(0.0), lambda a, b: a + b), lambda total: F.transform(powers, lambda x: x / total))

        return bound(scores, softmax)


def fit_weights(at: np.ndarray, row: np.ndarray, domain: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and intercepts of a ridge-penalised log-linear model, by accelerated gradient steps.

    ``at`` and ``row`` are the words and texts of the occurrences, ``domain`` the domain of
    each text. Weights are held near ``start``, so that a word of few texts keeps what is
    known of it alone. A step is divided by a diagonal bound of the curvature, so it never overshoots.
    """
    n, (n_words, n_domains) = len(domain), start.shape
    own = np.eye(n_domains)[domain]
    reach = (np.bincount(row, minlength=n) + 1.0) / 2
    bound_w, bound_b = np.bincount(at, reach[row], minlength=n_words)[:, None] + RIDGE, reach.sum()
    w, b = start, np.log(np.maximum(own.mean(axis=0), 1e-12))
    ahead_w, ahead_b, t = w, b, 1.0
    for _ in range(FIT_STEPS):
        scores = np.stack([np.bincount(row, ahead_w[at, d], minlength=n) for d in range(n_domains)], axis=1) + ahead_b
        p = np.exp(scores - scores.max(axis=1, keepdims=True))
        rest = p / p.sum(axis=1, keepdims=True) - own
        gradient = np.stack([np.bincount(at, rest[row, d], minlength=n_words) for d in range(n_domains)], axis=1) + RIDGE * (ahead_w - start)
        new_w, new_b, new_t = ahead_w - gradient / bound_w, ahead_b - rest.sum(axis=0) / bound_b, (1 + math.sqrt(1 + 4 * t * t)) / 2
        ahead_w, ahead_b = new_w + (t - 1) / new_t * (new_w - w), new_b + (t - 1) / new_t * (new_b - b)
        w, b, t = new_w, new_b, new_t
    return w, b


def fit_domains(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", quality: str = "quality", toxic: str = "toxic", training_rows: int = TRAINING_ROWS) -> DomainModel:
    """Fit the domain classifier on a bounded sample of different labelled texts.

    A text counts once in a domain, however many labelled rows are copies of it. The sample
    holds, per domain, the ``training_rows`` texts whose digests have the smallest hashes,
    and being bounded it is broadcast to the scan of the documents. The driver gets the
    places of the telling words in the sample, not the texts. Priors count all
    different labelled texts. Without labelled documents every domain is equally likely,
    and a domain without any has no documents otherwise. Labels that are null, or of a null
    key, are left out.
    """
    marked = pick(labels, key=key, quality=quality, toxic=toxic).select("key", label_domain(F.col("quality"), F.col("toxic")).alias("domain")).dropna()
    # The digests only are shuffled to the labels; of the copies of a text the least key stands for all.
    rows = pick(documents, key=key, text=text)
    # A sieve of the labelled keys decides which texts are hashed at all.
    sieve = Sieve.of(marked, F.xxhash64("key"), at_most=marked.count())
    labelled = sieve.mark(rows, F.xxhash64("key"), "met").filter("met").select("key", text_digest(F.col("text")).alias("digest"))
    different = materialise(labelled.join(marked, "key").groupBy("domain", "digest").agg(F.min("key").alias("key")), "labelled-texts")
    counts = {r["domain"]: r["n"] for r in different.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    if not total:
        return DomainModel(DOMAINS, [0.0] * len(DOMAINS))
    # A domain without labelled documents has no posterior, so no targets are sought through it.
    priors = [math.log(counts[d] / total) if d in counts else NEVER for d in DOMAINS]
    sample = hashed_sample(different, "domain", "digest", training_rows, counts)
    # The join is by key alone, so that the texts of the sample only are hashed; a key may stand on several rows.
    texts = rows.join(F.broadcast(sample), "key").filter(text_digest(F.col("text")) == F.col("digest")).dropDuplicates(["domain", "digest"])
    seen = materialise(texts.select("domain", word_list(F.col("text")).alias("words")), "training-words")
    sizes = {r["domain"]: r["n"] for r in seen.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = sum(sizes.values())
    per_word = seen.select("domain", F.explode(F.array_distinct(with_beginnings(F.col("words")))).alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("df"), *[F.sum(F.when(F.col("domain") == d, 1).otherwise(0)).alias(f"df_{d}") for d in DOMAINS]).filter(F.col("df") >= LEAST_TEXTS)
    per_word = materialise(per_word, "word-counts")

    def z(domain: str) -> Column:
        own, rest = sizes.get(domain, 0), n - sizes.get(domain, 0)
        if not own or not rest:
            return F.lit(0.0)
        share, inside, outside = F.col("df") / n, F.col(f"df_{domain}") / own, (F.col("df") - F.col(f"df_{domain}")) / rest
        spread = F.sqrt(share * (1 - share) * (1 / own + 1 / rest))
        return F.when((spread > 0) & (inside >= LEAST_LIFT * outside), (inside - outside) / spread).otherwise(0.0)

    chosen: dict[str, dict] = {}
    for d in DOMAINS:
        best = per_word.withColumn("z", z(d)).filter(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "word").limit(TELLING_WORDS)
        for r in best.collect():
            chosen.setdefault(r["word"], {})[d] = math.log((r[f"df_{d}"] + 0.5) / (sizes[d] + 1) * (n - sizes[d] + 1) / (r["df"] - r[f"df_{d}"] + 0.5))
    telling = sorted(chosen)
    if not telling:
        return DomainModel(DOMAINS, priors)
    places = seen.select("domain", looked_up(F.col("words"), {w: i for i, w in enumerate(telling)}, "int").alias("at")).toPandas()
    # One order of the rows, so that sums of floats do not depend on partitions.
    places = sorted((d, sorted(at)) for d, at in zip(places["domain"], places["at"]))
    present = [d for d in DOMAINS if sizes.get(d)]
    at = np.array([i for _, words in places for i in words], dtype=np.int64)
    row = np.repeat(np.arange(len(places)), [len(words) for _, words in places])
    # Whole words start at their smoothed log ratios; beginnings stand for words too, and start at 0.
    start = np.array([[0.0 if w[1:].endswith("*") and w.strip(SYMBOLS) else chosen[w].get(d, 0.0) for d in present] for w in telling])
    weights, intercepts = fit_weights(at, row, np.array([present.index(d) for d, _ in places]), start)
    # The sample has its own shares of the domains; the intercepts go back to those of all texts.
    base, rows_of = list(priors), np.zeros((len(telling), len(DOMAINS)))
    for i, d in enumerate(present):
        base[DOMAINS.index(d)] += float(intercepts[i]) - math.log(sizes[d] / n)
        rows_of[:, DOMAINS.index(d)] = weights[:, i]
    return DomainModel(DOMAINS, base, telling, rows_of.round(6).tolist())


def _product(p: Column, y: Column) -> Column:
    return F.aggregate(F.zip_with(p, y, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)


@dataclass(frozen=True)
class Mixture:
    """Fitted rates: a document's is ``max(0, 1 - p . shift)``, ``shift`` being the projected steps so far.

    ``distances`` tell how far each domain's total is from its target, as a share of the
    domain's tokens. ``converged`` tells that the rates are the best ones; targets that no
    rates reach have distances all the same.
    """

    model: DomainModel
    shift: Sequence[float]
    available: Sequence[float]
    targets: Sequence[float]
    reached: Sequence[float]
    distances: Sequence[float]
    converged: bool
    steps: int

    def rate(self, posteriors: Column) -> Column:
        return F.greatest(F.lit(0.0), F.lit(1.0) - _product(posteriors, F.lit([float(y) for y in self.shift])))


def fit_rates(members: DataFrame, weights: Mapping[str, float], model: DomainModel, epochs: float = 1.0, ridge: float = RATE_RIDGE, tolerance: float = 1e-6) -> Mixture:
    """Nonnegative rates per document whose expected domain token totals match targets.

    ``members`` has ``n_tokens`` and ``p`` (posteriors). Targets divide a total by
    ``weights``; the total is such that the domain of the largest weight, of those that
    have tokens, is used ``epochs`` times. Minimises over rates ``r >= 0``

        sum_d (s_d - T_d)^2 / A_d  +  ridge sum_i n_i (r_i - 1)^2

    where ``s_d`` is the expected total ``sum_i r_i n_i p_id`` and ``A_d`` the total at
    rates 1. The penalty makes the minimum unique: of all rates that serve the targets
    alike, those nearest to 1. Steps start at 1 and are projected as a whole, so the rate
    is ``max(0, 1 - p . y)`` for the sum ``y`` of the steps, one number per domain. A step
    is one aggregate over the narrow table: the gradient, and the products of posteriors
    over the rows whose rate is not 0, which scale it (scaled gradient projection). It is
    halved until the dual objective, which is concave, rises enough. The fit ends when the
    gradient is within ``tolerance`` of ``A_d`` in every domain, which is where the rates
    are best, or when no step raises the objective in floating point; no number of steps
    ends it. Domains without tokens take no part.
    """
    if not weights or any(w < 0 for w in weights.values()) or set(weights) - set(model.domains) or not any(weights.values()):
        raise ValueError(f"weights must be nonnegative, not all 0, for domains of {model.domains}")
    size = len(model.domains)
    pairs = [(a, b) for a in range(size) for b in range(a, size)]

    def evaluate(y: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Value, totals and products of posteriors at a sum of steps."""
        u, n = F.col("u"), F.col("n_tokens")
        value = F.when(u < 1, 2 * u - u * u).otherwise(1.0)
        active = F.when(u < 1, n).otherwise(0)
        rows = members.withColumn("u", _product(F.col("p"), F.lit([float(x) for x in y])))
        row = rows.agg(
            F.sum(n * value), *[F.sum(active * (1 - u) * F.get("p", d)) for d in range(size)],
            *[F.sum(active * F.get("p", a) * F.get("p", b)) for a, b in pairs]).first()
        found = [float(x or 0.0) for x in row]
        gram = np.zeros((size, size))
        for (a, b), x in zip(pairs, found[size + 1:]):
            gram[a, b] = gram[b, a] = x
        return found[0], np.array(found[1:size + 1]), gram

    y = np.zeros(size)
    value, reached, gram = evaluate(y)
    available = reached
    own = available > 0
    share = np.array([weights.get(d, 0.0) for d in model.domains]) / sum(weights.values())
    lead = max(range(size), key=lambda d: (share[d] * own[d], -d))
    targets = share * (epochs * available[lead] / share[lead] if share[lead] else 0.0)
    scale = np.where(own, available, 1.0)

    def objective(value: float, y: np.ndarray) -> float:
        return 0.5 * value - y @ targets - 0.5 * ridge * (scale * y) @ y

    steps, converged = 0, False
    while True:
        slope = np.where(own, reached - targets - ridge * scale * y, 0.0)
        converged = bool(np.all(np.abs(slope) <= tolerance * scale))
        if converged:
            break
        # Scaled by the tokens of the domains, so that small domains count as much as large ones.
        root = np.sqrt(scale)
        step = np.linalg.solve(gram / np.outer(root, root) + ridge * np.eye(size), slope / root) / root
        length, before, rise = 1.0, objective(value, y), slope @ step
        while length > 1e-12:
            after = evaluate(y + length * step)
            if objective(after[0], y + length * step) >= before + 1e-4 * length * rise:
                break
            length /= 2
        else:
            break
        y, (value, reached, gram), steps = y + length * step, after, steps + 1
    distances = np.where(own, (reached - targets) / scale, 0.0)
    return Mixture(model, y.round(9).tolist(), available.tolist(), targets.tolist(), reached.tolist(), distances.tolist(), converged, steps)


def memberships(documents: DataFrame, model: DomainModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_tokens, p)``: whitespace words of the whole text and domain posteriors."""
    words = pick(documents, key=key, text=text).select("key", word_list(F.col("text")).alias("words"))
    return words.select("key", F.size("words").cast("long").alias("n_tokens"), model.posteriors(F.col("words")).alias("p"))


def mix(documents: DataFrame, labels: DataFrame, weights: Mapping[str, float], epochs: float = 1.0, key: str = "doc_id", text: str = "text", **fit) -> tuple[DataFrame, Mixture]:
    """``(key, n_tokens, p, rate)`` of every row, and the fitted mixture.

    Null texts have no words, so the priors as posteriors and no tokens. Rows that repeat
    are rows of their own. Only the narrow membership table is written and read again.
    An empty table gives an empty result.
    """
    model = fit_domains(documents, labels, key=key, text=text, **fit)
    members = materialise(memberships(documents, model, key=key, text=text), "memberships")
    mixture = fit_rates(members, weights, model, epochs)
    return members.withColumn("rate", mixture.rate(F.col("p"))), mixture


def drawn_copies(rate: Column, key: Column) -> Column:
    """How often a row is taken: the whole part of its rate, and once more by a hash draw."""
    draw = F.shiftrightunsigned(F.xxhash64(F.lit("mix"), key), 11) / float(1 << 53)
    return bound(rate, lambda r: (F.floor(r) + (draw < r - F.floor(r)).cast("int")).cast("int"))


def resample(documents: DataFrame, mixture: Mixture, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, each as often as its rate says; the columns stay.

    The rate is a function of the text and the fitted residuals, so it is computed where
    the row is: wide rows are not shuffled to a table of rates.
    """
    names = documents.columns
    rows = documents.toDF(*[f"_{i}" for i in range(len(names))])
    words = word_list(F.col(f"_{names.index(text)}"))
    copies = drawn_copies(mixture.rate(mixture.model.posteriors(words)), F.col(f"_{names.index(key)}"))
    repeated = rows.withColumn("_copies", copies).filter("_copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return repeated.drop("_copies", "_copy").toDF(*names)
