"""Soft-membership mixing: rates for documents so that expected domain totals meet target weights.

Columns and SQL functions only. Domains come from the labels: `toxic` (toxic = 1), `low` (quality = 0) and `clean`.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .common import stored, unused

DOMAINS = ("clean", "low", "toxic")
TARGETS = {"clean": 0.95, "low": 0.04, "toxic": 0.01}
#: For rows that are kept once at most. Two fifths of the toxic labels have no mark in their texts, so that expected toxic
#: tokens are some 5 % of all however clean the rows look; to ask for less would throw clean documents away.
KEPT_TARGETS = {"clean": 0.93, "low": 0.01, "toxic": 0.06}
PER_DOMAIN = 3000  # labelled documents of a domain that the classifier learns from at most
VOCABULARY = 400  # marks that it keeps: the bound on what is broadcast
LEAST_GAIN = 10.0  # below it a mark's difference between domains may be chance
ROUNDS, TOLERANCE, PATIENCE = 60, 1e-6, 5  # rounds without progress after which the best so far is taken
STORE_EVERY = 10  # steps after which rates are written, so that no round goes through all steps before it
LOWERED = 6  # times that a goal beyond the bounds of rates is lowered at most
PLAIN = r"[\p{L}\p{N}\s.,;:?'\"()-]"  # what prose is written with; the share of other signs is a mark
BUCKETS = 128  # of words by hash: the words of a bucket share a shift that sends all words to places of their own


def _marks(text: Column) -> tuple[Column, Column]:
    """(number of words, marks): marks are the lower-case words and two buckets, of distinct words and of odd signs."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[ \n\t\r]+"), lambda w: w != "")
    n = F.size(words)
    odd = F.length(F.regexp_replace(F.coalesce(text, F.lit("")), PLAIN, ""))
    share = lambda x, most: F.least(F.floor(10 * x / F.greatest(n, F.lit(1))), F.lit(most)).cast("string")
    varied = F.concat(F.lit("\tdistinct "), share(F.size(F.array_distinct(words)), 10))
    return n.cast("long"), F.concat(words, F.array(varied, F.concat(F.lit("\tsigns "), share(odd, 20))))


def _literal(values: list, kind: str) -> Column:
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>")  # folded to a constant


@dataclass
class Classifier:
    """Words and their weights, laid out so that a word's weights are found by bits of its hash."""

    vocabulary: list[str]
    shifts: list[int]  # of each bucket
    places: int  # a power of two
    weights: dict[str, list[float]]  # by domain, by place: what the mark adds to the log odds of the domain against the first
    base: dict[str, float]  # the log odds without any mark

    def place(self, word: Column) -> Column:
        h = F.xxhash64(word)
        shift = F.get(_literal(self.shifts, "int"), h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int"))
        return F.call_function("shiftrightunsigned", h, shift).bitwiseAND(F.lit(self.places - 1)).cast("int")


def _laid_out(hashes: list[int]) -> tuple[list[int], int, list[int]]:
    """(shift of each bucket, number of places, place of each hash): every hash gets a place of its own by its bucket's shift."""
    buckets: list[list[int]] = [[] for _ in range(BUCKETS)]
    for i, h in enumerate(hashes):
        buckets[h & (BUCKETS - 1)].append(i)
    places = 1024
    while True:
        shifts, at, taken = [0] * BUCKETS, [0] * len(hashes), set()
        for b in sorted(range(BUCKETS), key=lambda b: -len(buckets[b])):
            for shift in range(7, 64 - places.bit_length()):
                spots = {(hashes[i] % (1 << 64)) >> shift & (places - 1) for i in buckets[b]}
                if len(spots) == len(buckets[b]) and not spots & taken:
                    break
            else:
                break
            shifts[b] = shift
            taken |= spots
            for i in buckets[b]:
                at[i] = (hashes[i] % (1 << 64)) >> shift & (places - 1)
        else:
            return shifts, places, at
        places *= 2
        if places > 1 << 24:
            raise ValueError("two words of the vocabulary have one hash")


def domain_of(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of labelled rows; a document with several labels takes the worst."""
    worst = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").when(F.col("quality") == 1, "clean")
    return worst.select("doc_id", domain.alias("domain")).filter("domain IS NOT NULL")


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Weights and intercept (last) of a logistic regression, by Newton's method; the intercept is not held back."""
    x = np.c_[x, np.ones(len(x))]
    hold = np.r_[np.full(x.shape[1] - 1, ridge), 1e-6]
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(hold), x.T @ (y - p) - hold * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit_classifier(docs: DataFrame, labels: DataFrame, per_domain: int = PER_DOMAIN, vocabulary: int = VOCABULARY) -> Classifier:
    """Log odds of each domain against the first, by logistic regression on which marks a document holds.

    Learnt from a bounded sample of labelled documents chosen by a hash of doc_id, and shifted to the domains' shares
    among all labelled documents that `docs` has. The marks that tell domains apart most surely are used; those of equal
    gain rank by their letters. Without labels nothing is known and all domains are equally likely.
    """
    known = stored(domain_of(labels).join(docs.select("doc_id"), "doc_id", "left_semi"), "mix-labels")
    counts = {r["domain"]: r["count"] for r in known.groupBy("domain").count().collect()}
    sample = None
    for d in DOMAINS:
        part = known.filter(F.col("domain") == d).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_domain)
        sample = part if sample is None else sample.unionByName(part)
    texts = docs.select("doc_id", "text").join(F.broadcast(stored(sample, "mix-sample")), "doc_id")  # 3 * per_domain rows
    texts = stored(texts.groupBy("doc_id", "domain").agg(F.min("text").alias("text")).select("domain", "doc_id", _marks(F.col("text"))[1].alias("marks")), "mix-marks")
    per_word = texts.select("domain", F.explode(F.array_distinct("marks")).alias("word"))
    per_word = per_word.groupBy("word").agg(*[F.count_if(F.col("domain") == d).alias(d) for d in DOMAINS]).filter(sum(F.col(d) for d in DOMAINS) >= 5)
    sizes = {r["domain"]: r["count"] for r in texts.groupBy("domain").count().collect()}
    share = sum(F.col(d) for d in DOMAINS) / max(sum(sizes.values()), 1)
    gain = sum(F.col(d) * (F.log((F.col(d) + 0.5) / (sizes.get(d, 0) + 1.0)) - F.log(share)) for d in DOMAINS)  # log-likelihood ratio
    best = per_word.withColumn("gain", F.round(gain, 6)).filter(F.col("gain") > LEAST_GAIN).orderBy(F.desc("gain"), "word").limit(vocabulary)
    rows = best.select("word", F.xxhash64("word").alias("hash")).collect()  # `vocabulary` rows
    words = [r["word"] for r in rows]
    shifts, places, at = _laid_out([r["hash"] for r in rows])
    model = Classifier(words, shifts, places, {d: [0.0] * places for d in DOMAINS}, {d: math.log((counts.get(d, 0) + 1) / (counts.get(DOMAINS[0], 0) + 1)) for d in DOMAINS})
    held = texts.select("domain", F.transform(F.array_intersect("marks", F.lit(words or [""])), model.place).alias("places")).collect()
    column = {place: i for i, place in enumerate(at)}
    sides = {}
    for d in DOMAINS:
        lists = sorted(sorted(column[p] for p in r["places"]) for r in held if r["domain"] == d)
        sides[d] = np.zeros((len(lists), len(words)))
        for i, marks in enumerate(lists):
            sides[d][i, marks] = 1
    for d in DOMAINS[1:]:
        own, first = sides[d], sides[DOMAINS[0]]
        if not len(own) or not len(first):
            continue
        w = _logistic(np.vstack([own, first]), np.r_[np.ones(len(own)), np.zeros(len(first))])
        for i, place in enumerate(at):
            model.weights[d][place] = float(w[i])
        model.base[d] += float(w[-1]) - math.log(len(own) / len(first))
    return model


def posteriors(docs: DataFrame, model: Classifier) -> DataFrame:
    """(doc_id, row, n_tokens, p_clean, p_low, p_toxic) for every row; words are the tokens.

    Null and empty texts have none, only their two buckets. Texts are gone through whole. One
    narrow pass: words of the vocabulary are picked out of a text, and their weights are found by their hashes.
    """
    n, marks = _marks(F.col("text"))
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), n.alias("n_tokens"), F.array_intersect(marks, F.lit(model.vocabulary or [""])).alias("held"))

    rows = rows.select("doc_id", "row", "n_tokens", F.transform("held", model.place).alias("places"))
    odds = lambda d: F.aggregate("places", F.lit(model.base[d]), lambda s, i: s + F.get(_literal(model.weights[d], "double"), i))
    sums = rows.select("doc_id", "row", "n_tokens", *[(F.lit(0.0) if d == DOMAINS[0] else odds(d)).alias(f"log_{d}") for d in DOMAINS])
    top = F.greatest(*[F.col(f"log_{d}") for d in DOMAINS])
    raised = sums.select("doc_id", "row", "n_tokens", *[F.exp(F.col(f"log_{d}") - top).alias(f"e_{d}") for d in DOMAINS])
    total = sum(F.col(f"e_{d}") for d in DOMAINS)
    return raised.select("doc_id", "row", "n_tokens", *[(F.col(f"e_{d}") / total).alias(f"p_{d}") for d in DOMAINS])


def _rate(start: Column, steps: list[dict[str, float]], most: float | None) -> Column:
    """A document's rate after these steps: each takes its posteriors' share of the totals' excess, then projects."""
    rate = start
    for excess in steps:
        rate = F.greatest(rate - sum(F.col(f"p_{d}") * F.lit(excess[d]) for d in DOMAINS), F.lit(0.0))
        rate = rate if most is None else F.least(rate, F.lit(float(most)))
    return rate


def fit_rates(rows: DataFrame, targets: dict[str, float] | None = None, anchor: str = "clean", most: float | None = None) -> tuple[DataFrame, float]:
    """`rows` (of `posteriors`, stored) with `rate`, from 0 to `most`, and the largest miss of a domain as a share of all tokens asked for.

    Targets: the anchor's tokens all count, other domains get their weights in proportion, and no domain is asked for
    more tokens than it has. Minimised is (S - t)' W (S - t) over rates in their bounds, where S are the expected domain
    tokens, t the targets and W the inverse of the Gram matrix of the documents' token posteriors. In the metric that
    weighs a document by its tokens the largest curvature is then 1, so projected gradient may take steps of 1 without a
    line search. Documents whose rate is at a bound do not move, so steps use the Gram matrix of those above 0, which is
    shorter-sighted but converges sooner; after a step that did not help, the next uses that of all. Where the bounds
    keep rates from the goal, it is lowered for all domains alike to the anchor's tokens reached, and the fit goes on.
    A step is one small vector; rates follow from all vectors in one expression, and every round is one narrow aggregate
    of twelve sums.
    """
    targets = targets or TARGETS
    p = {d: F.col(f"p_{d}") for d in DOMAINS}
    begin = unused("__from", rows)
    base, steps = rows.withColumn(begin, F.lit(1.0)), []
    goal = every = None
    best, since, lowered = math.inf, 0, 0
    best_base, best_steps = base, []
    for _ in range(ROUNDS):
        if len(steps) == STORE_EVERY:
            base, steps = stored(base.withColumn(begin, _rate(F.col(begin), steps, most)), "mix-rates"), []
        rate = F.col("rate")
        rated = base.withColumn("rate", _rate(F.col(begin), steps, most))
        sums = [F.sum(F.col("n_tokens") * rate * p[d]) for d in DOMAINS]
        gram = [F.sum(F.when(rate > 0, F.col("n_tokens") * p[a] * p[b])) for a in DOMAINS for b in DOMAINS]
        got = np.array([x or 0.0 for x in rated.agg(*[x.alias(f"s{i}") for i, x in enumerate(sums + gram)]).first()])
        s, g = got[: len(DOMAINS)], got[len(DOMAINS) :].reshape(len(DOMAINS), -1)
        at = DOMAINS.index(anchor)
        wanted = lambda tokens: np.minimum(have, [targets[d] * tokens / targets[anchor] for d in DOMAINS])
        if every is None:
            every = g
            have = g.sum(axis=1)  # posteriors sum to 1
            goal = wanted(have[at])
        off = float(np.abs(s - goal).max() / max(goal.sum(), 1e-300))
        helped = off < best
        if helped:
            best, since, best_base, best_steps = off, 0, base, list(steps)
        else:
            since += 1
        if off <= TOLERANCE:
            break
        if since >= PATIENCE or most is not None and helped and since == 0 and _ >= 1 and s[at] < goal[at] and lowered < LOWERED:
            if most is None or lowered == LOWERED:
                break
            lowered += 1
            goal = wanted(s[at])
            best, since = math.inf, 0
        weigh = np.linalg.pinv(g if helped else every, rcond=1e-9, hermitian=True)
        steps.append(dict(zip(DOMAINS, (weigh @ (s - goal)).tolist())))
    return best_base.withColumn("rate", _rate(F.col(begin), best_steps, most)).drop(begin), best


def copies(rate: Column, *key: Column) -> Column:
    """How often a document is taken: its rate rounded up or down by a hash of `key`, so that the mean is the rate."""
    uniform = F.shiftrightunsigned(F.xxhash64(*key), 11) / F.lit(float(1 << 53))
    return F.floor(rate + uniform).cast("int")


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, most: float | None = None) -> DataFrame:
    """(doc_id, n_tokens, p_clean, p_low, p_toxic, rate, copies, residual) for every row; an empty table gives an empty result.

    `residual` is the same on every row: the largest miss of a domain's expected tokens, as a share of all asked for.
    `most` bounds rates from above. Repeated rows each get a rate. Rows with a null doc_id take part and are rounded by
    their position. Other columns are not read. A domain that has fewer tokens than its weight asks for is asked for
    those it has: its rates may still exceed 1, but are not driven to make a scarce domain up by repeating it.
    """
    rows = stored(posteriors(docs, fit_classifier(docs, labels)), "mix-posteriors")
    rated, residual = fit_rates(rows, targets, most=most)
    return rated.withColumns({"copies": copies(F.col("rate"), F.coalesce("doc_id", "row")), "residual": F.lit(residual if math.isfinite(residual) else None).cast("double")}).drop("row")


def keep_mixed(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """The rows of `docs` that the mixture takes, columns unchanged; none twice, as rates stay from 0 to 1.

    Expected token totals of the rows kept are in the proportion of the targets, but for domains that have fewer tokens
    than that. Rows that repeat a doc_id stay or go together; rows with a null doc_id stay. Null and empty texts have
    rates like any other.
    """
    gone = mix(docs, labels, targets or KEPT_TARGETS, most=1.0).groupBy("doc_id").agg(F.max("copies").alias("n")).filter("n < 1 AND doc_id IS NOT NULL")
    return docs.join(stored(gone.select("doc_id"), "mix-gone"), "doc_id", "left_anti").select(*docs.columns)
