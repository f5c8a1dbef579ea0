"""Mixing to target weights with soft domain membership.

A classifier learnt from a labelled table gives every document its domain
posteriors. Document rates ``r >= 0`` are then fitted so that the expected token
totals ``sum(r * tokens * posterior)`` of the domains meet their targets in the
least-squares sense, by projected gradient steps. A rate is a function of the
posteriors alone, so documents are first summed up by their (rounded) posteriors;
each step is one aggregation of that table to one number per domain.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from fieldlake.llm.common import let, numbers, unit, words
from fieldlake.session import stored

#: Labelled documents read for training, at most.
TRAIN_ROWS = 20_000
#: Features kept, at most.
FEATURES = 1024
#: Slots of the features' hash table; of two features in one slot the weaker is left out.
SLOTS = 1 << 16
#: Posteriors are rounded to this many decimals.
DECIMALS = 4


@dataclass(frozen=True)
class Classifier:
    """Naive Bayes over the features that tell domains apart: log prior and log shares by domain.

    ``places`` is a hash table: the number of the feature (in their order) in each slot.
    """

    domains: tuple[str, ...]
    priors: tuple[float, ...]
    weights: dict[str, tuple[float, ...]]
    places: tuple[int, ...] = ()


def _slot(feature: Column) -> Column:
    return F.pmod(F.xxhash64(feature), F.lit(SLOTS)).cast("int")


def features(text: Column, among: list[str] | None = None) -> Column:
    """The distinct features of a text, all or those ``among`` a list: its words, and its runs of signs."""
    signs = F.split(F.coalesce(text, F.lit("")), r"[\p{L}\p{N}\s]+")
    parts = [F.filter(x, lambda f: f.isin(*among) if among else f != "") for x in (words(text), signs)]
    return F.array_distinct(F.concat(*parts))


def train(docs: DataFrame, labelled: DataFrame, domain: str, rows: int = TRAIN_ROWS, least: int = 20) -> Classifier:
    """Learn domains from ``labelled`` (doc_id, domain name) and the texts of ``docs``.

    At most ``rows`` labelled documents take part, those with the smallest hash, and
    at most ``FEATURES`` features, those that tell most; both lists are bounded, all
    counting is done by Spark.
    """
    known = labelled.filter(F.col("doc_id").isNotNull() & F.col(domain).isNotNull()).select("doc_id", F.col(domain).cast("string").alias("_domain"))
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id", "_domain").limit(rows)
    read = stored(docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("_domain", features(F.col("text")).alias("f")), "mix-train")
    sizes = dict(sorted(read.groupBy("_domain").count().collect()))
    names, total = tuple(sizes), sum(sizes.values())
    if len(names) < 2:
        return Classifier(names or ("all",), (0.0,), {})
    per = read.select("_domain", F.explode("f").alias("f")).groupBy("f").agg(
        F.count(F.lit(1)).alias("n"), *[F.count(F.when(F.col("_domain") == d, 1)).alias(f"n{i}") for i, d in enumerate(names)])
    inside = [(F.col(f"n{i}") + 0.5) / (sizes[d] + 1.0) for i, d in enumerate(names)]
    # how far a domain's share of documents with the feature lies from that of the others, in standard errors
    share = F.col("n") / F.lit(total)
    tells = F.greatest(*[
        F.abs(F.col(f"n{i}") / sizes[d] - (F.col("n") - F.col(f"n{i}")) / (total - sizes[d])) / F.sqrt(share * (1 - share) * (1.0 / sizes[d] + 1.0 / (total - sizes[d])) + 1e-12)
        for i, d in enumerate(names)])
    strong = per.filter(F.col("n") >= least).select("f", tells.alias("t"), *[F.log(a).alias(f"l{i}") for i, a in enumerate(inside)])
    kept = strong.filter("t >= 4").orderBy(F.desc("t"), "f").limit(FEATURES).withColumn("slot", _slot(F.col("f"))).collect()
    slots: dict[int, str] = {}
    for r in kept:
        slots.setdefault(r["slot"], r["f"])
    weights = {r["f"]: tuple(r[f"l{i}"] for i in range(len(names))) for r in kept if slots[r["slot"]] == r["f"]}
    order = {f: i for i, f in enumerate(sorted(weights))}
    places = [0] * SLOTS
    for slot, f in slots.items():
        places[slot] = order[f]
    return Classifier(names, tuple(math.log(sizes[d] / total) for d in names), weights, tuple(places))


def posteriors(text: Column, model: Classifier) -> Column:
    """The chance of each domain, in their order, rounded; the prior for texts without features.

    Log ratios are divided by the root of their number, because the features of a
    text depend on each other.
    """
    if len(model.domains) == 1:
        return F.array(F.lit(1.0))
    names = sorted(model.weights)
    places = F.transform(features(text, names), lambda f: F.get(numbers(model.places, "int"), _slot(f))) if names else F.array().cast("array<int>")
    return let(places, lambda at: let(_logs(at, names, model), _shares))


def _logs(places: Column, names: list[str], model: Classifier) -> Column:
    scale = F.sqrt(F.greatest(F.size(places), F.lit(1)).cast("double"))
    return F.array(*[F.lit(prior) + _total(places, [model.weights[n][i] for n in names]) / scale for i, prior in enumerate(model.priors)])


def _shares(logs: Column) -> Column:
    total = lambda parts: F.aggregate(parts, F.lit(0.0), lambda a, b: a + b)
    top = F.array_max(logs)
    return let(F.transform(logs, lambda x: F.exp(x - top)), lambda parts: let(total(parts), lambda t: F.transform(parts, lambda p: F.round(p / t, DECIMALS))))


def _total(places: Column, values: list[float]) -> Column:
    if not values:
        return F.lit(0.0)
    return F.aggregate(places, F.lit(0.0), lambda a, i: a + F.get(numbers(values, "double"), i))


def targets(totals: list[float], shares: list[float]) -> list[float]:
    """Domain totals in the wanted shares of which none is below today's: rates then only grow, no document goes."""
    most = max((t / s for t, s in zip(totals, shares, strict=True) if s > 0), default=0.0)
    return [s * most for s in shares]


def rate_of(p: Column, history: list[list[float]], step: float, pull: float) -> Column:
    """The rate after the steps whose domain residuals are ``history``; starts at 1, never negative."""
    if not history:
        return F.lit(1.0)
    k = len(history[0])
    flat = numbers([x for row in history for x in row], "double")
    at = lambda i, j: F.get(flat, i * k + j)

    def after(r: Column, i: Column) -> Column:
        slope = sum((at(i, F.lit(j)) * F.get(p, F.lit(j)) for j in range(k)), F.lit(0.0))
        return F.greatest(F.lit(0.0), r - F.lit(step) * (slope + F.lit(pull) * (r - F.lit(1.0))))

    return F.aggregate(F.sequence(F.lit(0), F.lit(len(history) - 1)), F.lit(1.0), after)


def fit(groups: DataFrame, shares: list[float], pull: float = 1e-3, steps: int = 60, near: float = 1e-3) -> tuple[list[list[float]], float, float]:
    """Residuals per step, step size and pull towards rate 1, for ``groups`` (p, tokens).

    Minimises ``1/2 sum_k ((A_k(r) - T_k) / S_k)^2`` over the rates, where ``A_k`` is a
    domain's expected token total and ``S_k`` the root of (today's total x all tokens).
    The step size is one over the largest eigenvalue of the k x k matrix of the
    problem, which is summed up once. Ends when all totals are within ``near`` of
    their targets, or after ``steps`` steps.
    """
    k = len(shares)
    p = [F.get("p", F.lit(i)) for i in range(k)]
    sums = [F.coalesce(F.sum(F.col("tokens") * x), F.lit(0.0)) for x in p]
    gram = [F.coalesce(F.sum(F.col("tokens") * p[i] * p[j]), F.lit(0.0)) for i in range(k) for j in range(k)]
    first = list(groups.agg(*[x.alias(f"x{i}") for i, x in enumerate(sums + gram)]).first())
    totals, gram = first[:k], first[k:]
    every = sum(totals)
    if not every:
        return [], 1.0, pull
    aims = targets(totals, shares)
    scale = [max(t, 1e-9 * every) for t in totals]  # S_k squared over all tokens
    top = max(sum(abs(gram[i * k + j]) / math.sqrt(scale[i] * scale[j]) for j in range(k)) for i in range(k))
    step = 1.0 / (top + pull)
    history: list[list[float]] = []
    for _ in range(steps):
        rated = groups.select(rate_of(F.col("p"), history, step, pull).alias("r"), "p", "tokens")
        now = list(rated.agg(*[F.sum(F.col("r") * F.col("tokens") * x).alias(f"x{i}") for i, x in enumerate(p)]).first())
        if all(abs(a - t) <= near * max(t, 1.0) for a, t in zip(now, aims, strict=True)):
            break
        history.append([(a - t) / s for a, t, s in zip(now, aims, scale, strict=True)])
    return history, step, pull


def rates(docs: DataFrame, model: Classifier, shares: dict[str, float]) -> DataFrame:
    """doc_id, n_tokens (words), the posteriors, the rate and the whole number of copies, one row per row.

    ``shares`` names the wanted share of each domain (missing ones: 0). Null and empty
    texts have no tokens and the prior's rate. Copies are the rate rounded up or down
    by a draw that depends on doc_id alone. Other columns are ignored.
    """
    seen = stored(docs.select("doc_id", _membership(F.col("text"), model).alias("m")), "mix-posteriors")
    rate = _rate(seen, "m", model, shares)
    return seen.select(
        "doc_id", F.col("m.n").alias("n_tokens"), *[F.get("m.p", F.lit(i)).alias(f"p_{d}") for i, d in enumerate(model.domains)],
        rate.alias("rate"), copies(rate).alias("copies"))


def copies(rate: Column, least: int = 1) -> Column:
    """The rate as a whole number: rounded up or down by a draw, and at least ``least``, so that by default no document is lost."""
    return F.greatest(F.floor(rate + unit(F.lit("copies"), F.col("doc_id"))).cast("int"), F.lit(least))


def resample(docs: DataFrame, model: Classifier, shares: dict[str, float]) -> DataFrame:
    """``docs`` with each row as often as its copies say; the same columns, whatever their names."""
    own = "_mix"
    while own in docs.columns:
        own += "_"
    seen = stored(docs.withColumn(own, _membership(F.col("text"), model)), "mix-documents")
    rate = _rate(seen, own, model, shares)
    return seen.withColumn(own, F.explode(F.array_repeat(F.lit(1), copies(rate)))).drop(own)


def _membership(text: Column, model: Classifier) -> Column:
    return F.struct(posteriors(text, model).alias("p"), F.size(words(text)).cast("long").alias("n"))


def _rate(seen: DataFrame, name: str, model: Classifier, shares: dict[str, float]) -> Column:
    groups = seen.groupBy(F.col(f"{name}.p").alias("p")).agg(F.sum(f"{name}.n").alias("tokens"))
    total = sum(shares.get(d, 0.0) for d in model.domains)
    if not total:  # no share is asked for: nothing to move
        return F.lit(1.0)
    history, step, pull = fit(stored(groups.filter("tokens > 0"), "mix-groups"), [shares.get(d, 0.0) / total for d in model.domains])
    return rate_of(F.col(f"{name}.p"), history, step, pull)
