"""Mixing to target weights with soft membership.

A classifier learnt from the labelled table gives every document posteriors over the domains plain, poor and toxic. Rates
r >= 0 of documents are fitted by projected-gradient least squares: the expected token totals of the domains, the sums over
documents of rate x tokens x posterior, come to their targets, and of all rates that do so those nearest to 1 are taken.

The state is one multiplier for each domain. A round works out the gradient in them with one distributed sum over all
documents (each document's rate is what the multipliers make of its posteriors, projected on r >= 0), scales it by the
inverse Gram matrix of the documents whose rates are above the bound, and steps as far as the objective falls. Sums are
native; texts go through Python once.
"""

from __future__ import annotations

import logging
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import text_of, written
from feedloom.llm.evidence import fit, probabilities

DOMAINS = ("plain", "poor", "toxic")
TARGETS = {"plain": 0.94, "poor": 0.02, "toxic": 0.04}
#: Weight of the rates' distance from 1 against that of the totals from their targets.
RIDGE = 1e-6
#: A gradient below this, in shares of all tokens, is none; a share further than MISSED from its target is missed.
TOLERANCE, MISSED = 1e-7, 0.01
LOG = logging.getLogger(__name__)


def posteriors(quality: Column, toxic: Column) -> list[Column]:
    return [quality * (1 - toxic), 1 - quality, quality * toxic]


def rate_of(p: list[Column], multipliers: np.ndarray, most: float = np.inf) -> Column:
    """The projection of 1 - posteriors x multipliers on 0 .. most."""
    free = F.lit(1.0) - sum((x * float(m) for x, m in zip(p, multipliers, strict=True)), F.lit(0.0))
    return F.greatest(free, F.lit(0.0)) if np.isinf(most) else F.least(F.greatest(free, F.lit(0.0)), F.lit(float(most)))


class Sums:
    """What one round adds up over all documents, at given multipliers, as shares of all tokens."""

    def __init__(self, compact: DataFrame, most: float):
        self.compact, self.most = compact, most
        self.p = posteriors(F.col("p_quality"), F.col("p_toxic"))
        self.size = float(compact.agg(F.sum("tokens")).first()[0] or 0)

    def at(self, multipliers: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """(totals by domain, Gram matrix of the documents inside the bounds, sum of the rates' conjugate)."""
        k, n = len(self.p), F.col("tokens").cast("double")
        free = F.lit(1.0) - sum((x * float(m) for x, m in zip(self.p, multipliers, strict=True)), F.lit(0.0))
        rate = rate_of(self.p, multipliers, self.most)
        inside = (free > 0) & (free < self.most) if np.isfinite(self.most) else free > 0
        cells = [(i, j) for i in range(k) for j in range(i, k)]
        sums = [F.sum(n * rate * x) for x in self.p]
        sums += [F.sum(F.when(inside, n * self.p[i] * self.p[j]).otherwise(0.0)) for i, j in cells]
        sums.append(F.sum(n * (rate * free - rate * rate / 2)))
        got = np.array([float(x or 0) for x in self.compact.agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()]) / self.size
        gram = np.zeros((k, k))
        for (i, j), x in zip(cells, got[k:], strict=False):
            gram[i, j] = gram[j, i] = x
        return got[:k], gram, float(got[-1])


def solve(compact: DataFrame, targets: dict[str, float], most: float = np.inf) -> tuple[np.ndarray, np.ndarray]:
    """(multipliers, expected totals as shares of the tokens given) for rows of p_quality, p_toxic and tokens.

    The budget is such that the domain with the largest target keeps its present total. Rounds end when
    there is no gradient left, or no step along it betters the objective any more; as that is convex, this is the optimum.
    """
    weights = np.array([max(0.0, float(targets.get(d, 0.0))) for d in DOMAINS])
    if not weights.sum():
        raise ValueError("a target must be positive")
    weights = weights / weights.sum()
    sums, x = Sums(compact, most), np.zeros(len(DOMAINS))
    if not sums.size:
        return x, x
    totals, gram, conjugate = sums.at(x)
    anchor = int(np.argmax(weights))
    target = weights * totals[anchor] / weights[anchor]
    value = lambda at, conj: conj + at @ target + RIDGE / 2 * at @ at
    now, rounds = value(x, conjugate), 0
    while np.abs(gradient := RIDGE * x - (totals - target)).max() > TOLERANCE:
        step = -np.linalg.solve(gram + RIDGE * np.eye(len(x)), gradient)
        scale, better = 1.0, False
        while not better and scale > 1e-6:
            after = sums.at(x + scale * step)
            then, rounds = value(x + scale * step, after[2]), rounds + 1
            better = then < now - 1e-4 * scale * abs(gradient @ step)
            if not better:
                scale /= 4
        if not better:
            break
        x, (totals, gram, conjugate), now = x + scale * step, after, then
    report(weights, totals / max(totals.sum(), 1e-300), float(totals.sum()), rounds)
    return x, totals


def report(weights: np.ndarray, shares: np.ndarray, kept: float, rounds: int) -> None:
    """Logs the expected shares against their targets, as a warning if one is missed."""
    missed = np.abs(shares - weights).max() > MISSED
    told = ", ".join(f"{d} {x:.4f} of {w:.4f}" for d, x, w in zip(DOMAINS, shares, weights, strict=True))
    verb = "misses" if missed else "meets"
    LOG.log(logging.WARNING if missed else logging.INFO, "mixing %s its targets after %d sums: %s; tokens %.4f of the input", verb, rounds, told, kept)


def row_hash(text: str) -> Column:
    return F.xxhash64(F.lit("mix"), F.col("doc_id").cast("long"), text_of(text))


def rated(
    docs: DataFrame,
    labels: DataFrame,
    targets: dict[str, float] | None = None,
    most: float = np.inf,
    text: str = "text",
    learn: DataFrame | None = None,
) -> DataFrame:
    """id, h (a hash of id and text), tokens, p_plain, p_poor, p_toxic, rate and copies of every row.

    Rates are 0 or more and have no upper bound unless `most` is given. A target that no rates reach is missed: by default
    only that of a domain without any document. The expected shares are logged, as a warning if one is missed. The
    classifier learns from the labelled rows of `learn`, by default of docs. copies is the rate rounded up or down at random
    by h, so that its mean is the rate and rows that repeat a document get equal values. Null texts are empty, with no
    tokens and the posteriors of their shape. Without labels all posteriors are the smoothed rates; an empty table gives no
    rows. No column of docs but doc_id and the text is read.
    """
    heads = fit(docs if learn is None else learn, labels, ("quality", "toxic"), text)
    keep = [F.col("doc_id").cast("long").alias("id"), row_hash(text).alias("h")]
    compact = written(probabilities(docs, heads, keep, text), "mixing-posteriors")
    multipliers, _ = solve(compact.select("p_quality", "p_toxic", "tokens"), targets or TARGETS, most)
    p = posteriors(F.col("p_quality"), F.col("p_toxic"))
    u = F.pmod("h", F.lit(1 << 30)) / float(1 << 30)
    out = compact.select("id", "h", "tokens", *[x.alias(f"m_{d}") for x, d in zip(p, DOMAINS, strict=True)], rate_of(p, multipliers, most).alias("rate"), u.alias("u"))
    return out.select("id", "h", "tokens", *[F.col(f"m_{d}").alias(f"p_{d}") for d in DOMAINS], "rate", F.floor(F.col("rate") + F.col("u")).cast("int").alias("copies"))


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, most: float = np.inf, text: str = "text", learn: DataFrame | None = None) -> DataFrame:
    """doc_id, n_tokens, posteriors, rate and copies of every row."""
    rows = rated(docs, labels, targets, most, text, learn)
    return rows.select(F.col("id").alias("doc_id"), F.col("tokens").alias("n_tokens"), *[f"p_{d}" for d in DOMAINS], "rate", "copies")


def sampled(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, most: float = np.inf, text: str = "text", learn: DataFrame | None = None) -> DataFrame:
    """Each row of docs as often as its copies say, with docs' columns, whatever their names."""
    a, b, c, d = (f"{x}_{uuid.uuid4().hex}" for x in "abcd")
    found = rated(docs, labels, targets, most, text, learn).where("copies > 0")
    found = found.groupBy(F.col("id").alias(a), F.col("h").alias(b)).agg(F.max("copies").alias(c))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(a)) & (row_hash(text) == F.col(b))
    rows = docs.join(found, same).withColumn(d, F.explode(F.sequence(F.lit(1), F.col(c))))
    return rows.select(*[F.col(f"`{x}`") for x in docs.columns])
