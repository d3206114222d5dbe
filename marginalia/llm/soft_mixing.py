"""Mixing to target weights by soft membership, in DataFrame functions only.

A naive Bayes classifier, trained on a bounded sample of labelled documents,
gives each document a posterior over domains. Nonnegative rates per document
are fitted by projected gradient least squares so that the expected tokens of
each domain (rate x tokens x posterior, summed over documents) match targets.
A step needs only the domain totals: one aggregate of a few numbers. A
document's rate is a fold over the totals of all steps, so no state moves
between steps.
"""

from __future__ import annotations

import math
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import constant, materialize

# Labelled documents used for the fit, taken in the order of a hash of the id.
SAMPLE = 20_000
SMOOTHING = 1.0
# Marks of style count one by one if presence and a domain correlate at least so much over all languages (phi). Words
# don't: where domains have other shares in each language, all words of a language would tell the domain.
CORRELATION = 0.25
# Markers are words and word beginnings sought in each language on its own: their log odds of a domain are up by this
# much, by a likelihood-ratio statistic that chance reaches about once in 100,000 words. Their number in a document
# counts, not each by itself: one word is enough, and a few wrong markers do no harm.
MARKER_ODDS, MARKER_SURE = 2.0, 20.0
BEGINNING, MOST_MARKERS = 4, 3
# At most so many markers, the surest first: bounds the model.
MAX_MARKERS = 2000
STEPS, TOLERANCE, CUT = 40, 1e-4, 20


_STYLES = ("1 ", "2 ", "3 ")


def _featured(texts: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and f: hashes of the distinct words of the whole text ``t``, of their beginnings, of marks of style."""
    words = F.filter(F.array_distinct(F.split(F.lower("t"), r"[^\p{L}]+")), lambda w: w != "")
    chars = F.greatest(F.length("t"), F.lit(1))
    shares = (F.regexp_count("t", F.lit(r"[!#*$%&|<>]")) / chars, F.regexp_count("t", F.lit(r"\p{Lu}")) / chars,
              F.size("w") / chars)
    style = F.array(*[F.concat(F.lit(s), F.floor(F.log2(1 + 1000 * x))) for s, x in zip(_STYLES, shares)])
    # hashed with a second value: the beginning "this" isn't the word
    starts = F.transform(F.array_distinct(F.transform("w", lambda w: F.substring(w, 1, BEGINNING))),
                         lambda w: F.xxhash64(w, F.lit(BEGINNING)))
    hashes = F.transform(F.concat("w", style), lambda w: F.xxhash64(w))
    return texts.select("t", *keep, words.alias("w")).select(*keep, F.concat(hashes, starts).alias("f"))


def _with_copy_key(texts: DataFrame) -> DataFrame:
    """With ``copy``, equal for copies and mostly for near copies: the least hash of three words in a row of ``t``."""
    threes = F.transform("all", lambda w, i: F.xxhash64(w, F.get("all", i + 1), F.get("all", i + 2)))
    least = F.array_min(F.slice(threes, 1, F.greatest(F.size("all") - 2, F.lit(1))))
    return texts.withColumn("all", F.split(F.lower("t"), r"[^\p{L}]+")).withColumn("copy", least).drop("all")


class Model(NamedTuple):
    """A Bernoulli naive Bayes model: the score of a document without features, the features that count, what the
    presence of each adds to the score of each domain, and the groups of markers: features up to which position, and
    what 0, 1, ... markers of the group add to the score of each domain. Features in a group weigh 0 by themselves."""

    base: list[float]
    features: list[int]
    weights: list[list[float]]
    groups: list[tuple[int, int, list[list[float]]]]


def _log(x: Column) -> Column:
    """0 for what has no logarithm, an undefined quotient included."""
    return F.coalesce(F.when(x > 0, F.log(x)), F.lit(0.0))


def _odds(a: Column, total: Column, size: Column, everyone: Column) -> Column:
    """How much the log odds of a feature are up in a domain of ``size`` of ``everyone``, smoothed."""
    p, q = (a + 0.5) / (size + 1), (total - a + 0.5) / (everyone - size + 1)
    return F.log(p * (1 - q) / (q * (1 - p)))


def _sure(a: Column, total: Column, size: Column, everyone: Column) -> Column:
    """Likelihood-ratio statistic of presence and domain."""
    cells = ((a, total, size), (total - a, total, everyone - size), (size - a, everyone - total, size),
             (everyone - total - size + a, everyone - total, everyone - size))
    return 2 * reduce(Column.__add__, [x * _log(F.try_divide(x * everyone, r * c)) for x, r, c in cells])


def _is_style() -> Column:
    return F.col("i").isin([F.xxhash64(F.lit(f"{s}{v}")) for s in _STYLES for v in range(11)])


def _markers(counts: DataFrame, pool: DataFrame, size: list[float]) -> list[tuple[int, int]]:
    """(feature, domain), the surest first: telling within one language, and not contradicted by the others."""
    n = range(len(size))
    within = counts.where("i is null").select("lang", *[F.col(f"n_{j}").alias(f"b_{j}") for j in n])
    words = counts.where(F.col("i").isNotNull() & ~_is_style()).join(within, "lang")
    total, everyone = (reduce(Column.__add__, [F.col(f"{x}_{j}") for j in n]) for x in "nb")
    tests = []
    for j in n:
        a, b = F.col(f"n_{j}"), F.col(f"b_{j}")
        sure = _sure(a, total, b, everyone)
        tests.append(F.when((_odds(a, total, b, everyone) >= MARKER_ODDS) & (sure >= MARKER_SURE),
                            F.struct(sure.alias("sure"), F.lit(j).alias("j"))))
    told = words.select("i", F.explode(F.array_compact(F.array(*tests))).alias("x")).select("i", "x.*")
    over_all = [_odds(F.col(f"n_{j}"), total, F.lit(size[j]), F.lit(sum(size))) >= MARKER_ODDS for j in n]
    agreed = told.join(pool, "i").where(F.element_at(F.array(*over_all), F.col("j") + 1))
    best = agreed.groupBy("i").agg(F.max(F.struct("sure", "j")).alias("x"))
    rows = best.orderBy(F.desc("x.sure"), "i").limit(MAX_MARKERS).collect()
    return [(r["i"], r["x"]["j"]) for r in rows]


def train(docs: DataFrame, labelled: DataFrame, domains: list[str], sample: int = SAMPLE) -> Model:
    """Naive Bayes over the features that tell domains apart.

    ``labelled`` has doc_id and domain; labels of other domains, null ids and
    ids without a document are left out. Markers are sought in each language of
    ``docs.lang``, if there is one. Copies and near copies with the same label
    count once. Without labels all domains are alike.
    """
    labels = (labelled.select("doc_id", F.array_position(
        F.array(*[F.lit(d) for d in domains]), F.col("domain")).alias("k")).where("k > 0 and doc_id is not null")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "k").limit(sample))
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("")) if "lang" in docs.columns else F.lit("")
    texts = docs.select("doc_id", lang.alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    # at most ``sample`` slim rows: the texts stay where they are
    rows = _with_copy_key(texts.join(F.broadcast(labels), "doc_id"))
    rows = _featured(rows.withColumn("key", F.xxhash64("doc_id", "t")), "k", "lang", "copy", "key")
    one = rows.groupBy("k", "lang", "copy").agg(F.min(F.struct("key", "f")).alias("x"))
    rows = materialize(one.select("k", "lang", "x.f"), "mixing-labelled")
    of = [F.sum((F.col("k") == j + 1).cast("double")).alias(f"n_{j}") for j in range(len(domains))]
    # a null feature counts the documents of a domain
    counts = rows.select("k", "lang", F.explode(F.array_append("f", F.lit(None).cast("long"))).alias("i"))
    counts = materialize(counts.groupBy("lang", "i").agg(*of), "mixing-counts")
    pool = counts.groupBy("i").agg(*[F.sum(f"n_{j}").alias(f"n_{j}") for j in range(len(domains))])
    whole = pool.where("i is null").first()
    if not whole:
        return Model([0.0] * len(domains), [], [[] for _ in domains], [])
    size = [float(x) for x in whole[1:]]
    everyone = sum(size)
    markers = _markers(counts, pool, size)
    n = [F.col(f"n_{j}") for j in range(len(domains))]
    total = reduce(Column.__add__, n)
    phi = []
    for a, b in zip(n, size):
        spread = F.sqrt(total * (everyone - total) * b * (everyone - b))
        phi.append(F.when(spread > 0, F.try_divide(F.abs(a * (everyone - b) - (total - a) * b), spread)).otherwise(F.lit(0.0)))
    told = pool.where(_is_style()).withColumn("phi", F.greatest(*phi)).where(F.col("phi") >= CORRELATION)
    single = told.orderBy(F.desc("phi"), "i").collect()
    base, weights = [], []
    for j, b in enumerate(size):
        share = [(r[f"n_{j}"] + SMOOTHING) / (b + 2 * SMOOTHING) for r in single]
        base.append(round(math.log(b + 1.0) + sum(math.log(1 - q) for q in share), 6))
        weights.append([round(math.log(q / (1 - q)), 6) for q in share])
    features, spans = [r["i"] for r in single], []
    for j in range(len(domains)):
        own = [i for i, k in markers if k == j]
        if own:
            spans.append((len(features), len(features) + len(own)))
            features = features + own
    return Model(base, features, weights, _levels(rows, features, spans, size))


def _hits(features: list[int]) -> Column:
    """Positions, from 1, of the features of a row."""
    known = constant(features, "bigint")
    return F.transform(F.array_intersect("f", known), lambda x: F.array_position(known, x).cast("int"))


def _level(after: int, upto: int) -> Column:
    """Markers of a group in the row, MOST_MARKERS or more as one."""
    return F.least(F.size(F.filter("hits", lambda i: (i > after) & (i <= upto))), F.lit(MOST_MARKERS))


def _levels(rows: DataFrame, features: list[int], spans: list[tuple[int, int]],
            size: list[float]) -> list[tuple[int, int, list[list[float]]]]:
    """The groups of markers with what 0, 1, ... of them say about a domain, from the labelled documents."""
    if not spans:
        return []
    found = rows.select("k", _hits(features).alias("hits")).select(
        "k", *[_level(*s).alias(f"l_{g}") for g, s in enumerate(spans)])
    seen = found.groupBy("k", *[f"l_{g}" for g in range(len(spans))]).count().collect()
    out = []
    for g, (after, upto) in enumerate(spans):
        says = []
        for j, b in enumerate(size):
            n = [sum(r["count"] for r in seen if r["k"] == j + 1 and r[f"l_{g}"] == v) for v in range(MOST_MARKERS + 1)]
            says.append([round(math.log((x + SMOOTHING) / (b + len(n) * SMOOTHING)), 6) for x in n])
        out.append((after, upto, says))
    return out


def posteriors(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, key, n_tokens, p array) of every row, read from the whole text."""
    n = len(model.base)
    single = len(model.weights[0])
    hits = _hits(model.features) if model.features else F.array().cast("array<int>")

    def score(j: int) -> Column:
        total = F.lit(model.base[j])
        if single:
            weights = constant(model.weights[j], "double")
            total = F.aggregate(F.filter("hits", lambda i: i <= single), total,
                                lambda s, i: s + F.element_at(weights, i))
        for g, (_, _, says) in enumerate(model.groups):
            total = total + F.element_at(constant(says[j], "double"), F.col(f"l_{g}") + 1)
        return total

    texts = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t")).withColumn(
        "n_tokens", F.regexp_count("t", F.lit(r"[^\x20\x09-\x0D]+")).cast("long"))
    kept = ("doc_id", "key", "n_tokens")
    found = _featured(texts, *kept).select(*kept, hits.alias("hits"))
    found = found.select(*kept, "hits", *[_level(a, b).alias(f"l_{g}") for g, (a, b, _) in enumerate(model.groups)])
    scored = found.select(*kept, F.array(*[score(j) for j in range(n)]).alias("s"))
    raised = F.transform("s", lambda v: F.exp(v - F.array_max("s")))
    sums = F.aggregate("e", F.lit(0.0), lambda a, v: a + v)
    return scored.select(*kept, raised.alias("e")).select(*kept, F.transform("e", lambda v: v / sums).alias("p"))


def _rate(history: list[list[float]], start: Column) -> Column:
    """Fold of the steps: r = max(0, r - p . v) for the vector v of each step."""
    if not history:
        return start
    steps = F.transform(F.split(F.lit(";".join(",".join(repr(float(x)) for x in v) for v in history)), ";"),
                        lambda v: F.split(v, ",").cast("array<double>"))
    dot = lambda v: F.aggregate(F.zip_with("p", v, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    return F.aggregate(steps, start, lambda r, v: F.greatest(F.lit(0.0), r - dot(v)))


def fit_rates(members: DataFrame, weights: list[float], budget: float | None = None, steps: int = STEPS,
              tolerance: float = TOLERANCE) -> DataFrame:
    """``members`` (p, n_tokens, ...) with ``rate``.

    The target of domain k is ``weights[k] / sum(weights) * budget`` tokens, the
    budget being all tokens of the input unless given. Minimises
    sum_k (total_k - target_k)^2 / first_total_k over rates >= 0 from rate 1;
    in the metric of the documents' tokens the gradient of a document is the
    mean of its domains' relative gaps, and steps of 1 can't overshoot.
    """
    n, table, start, history = len(weights), members, F.lit(1.0), []
    target: list[float] = []
    scale: list[float] = []
    last: list[float] = []
    for _ in range(steps):
        mass = _rate(history, start) * F.col("n_tokens")
        row = table.agg(*[F.coalesce(F.sum(mass * F.col("p")[k]), F.lit(0.0)) for k in range(n)]).first()
        totals = [float(x) for x in row]
        if not target:
            whole = budget if budget is not None else sum(totals)
            target = [w / sum(weights) * whole for w in weights]
            scale = [max(t, 1e-9 * max(1.0, sum(totals))) for t in totals]
        gap = [t - b for t, b in zip(totals, target)]
        # met, or as near as rates >= 0 and these posteriors allow: a further step changes nothing
        least = tolerance * max(1.0, sum(target))
        if max(map(abs, gap)) <= least or last and max(abs(g - h) for g, h in zip(gap, last)) <= least:
            break
        last = gap
        history.append([g / s for g, s in zip(gap, scale)])
        if len(history) == CUT:
            table = materialize(table.withColumn("__r", _rate(history, start)).drop(
                *[c for c in ("__start",) if c in table.columns]).withColumnRenamed("__r", "__start"), "mixing-rates")
            start, history = F.col("__start"), []
    return table.withColumn("rate", _rate(history, start)).drop("__start")


def own_totals(members: DataFrame, n_domains: int) -> list[float]:
    """Expected tokens of each domain at rate 1."""
    return [float(x) for x in members.agg(*[
        F.coalesce(F.sum(F.col("n_tokens") * F.col("p")[k]), F.lit(0.0)) for k in range(n_domains)]).first()]


def memberships(docs: DataFrame, labelled: DataFrame, domains: list[str], sample: int = SAMPLE) -> DataFrame:
    """Posteriors of every row, as a table in the shared folder."""
    return materialize(posteriors(docs, train(docs, labelled, domains, sample)), "mixing-posteriors")


def mix(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], budget: float | None = None,
        sample: int = SAMPLE) -> DataFrame:
    """(doc_id, key, n_tokens, p, rate) of every row of ``docs`` (doc_id, text).

    ``weights`` names the domains and their target shares; ``key`` hashes
    doc_id and text. Markers are sought by ``lang`` where there is one. Null and empty texts have no tokens and move no total; their
    rate follows their posterior. Repeated rows get equal rates; other columns
    aren't read; an empty table gives no rows.
    """
    domains = list(weights)
    members = memberships(docs, labelled, domains, sample)
    return fit_rates(members, list(weights.values()), budget)


def quality_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) from the labelled table: toxic, low or clean; unlabelled rows are left out."""
    domain = (F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low")
              .when(F.col("quality") == 1, "clean"))
    return labels.select("doc_id", domain.alias("domain")).where("domain is not null")


def apply_rates(docs: DataFrame, rates: DataFrame, most: int | None = None, seed: int = 1) -> DataFrame:
    """``docs`` with each row repeated floor(rate + u) times, u a hash of its key in [0, 1); columns as they are.

    With ``most`` = 1 (mixing without repetition) rates above one keep a row once.
    """
    u = F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    copies = F.floor(F.col("rate") + u)
    if most is not None:
        copies = F.least(copies, F.lit(most))
    wanted = rates.select(F.col("key").alias("__key"), copies.cast("int").alias("__copies")).distinct().where("__copies > 0")
    keyed = docs.withColumn("__key", F.xxhash64("doc_id", "text")).join(wanted, "__key")
    if most != 1:
        keyed = keyed.withColumn("__n", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    return keyed.select(*[keyed[c] for c in docs.columns])
