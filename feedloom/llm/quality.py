"""Quality by hierarchical empirical Bayes.

The document classifier's probability is evidence about one text. Its sums over a site (source) and over a path of it
(source and language) are evidence about what else stands there: a path's rate is shrunk toward its site's and a site's
toward the global one, the more the fewer documents it has and the less such groups differ. The strength of either
shrinking is estimated from the spread of the groups' rates. A document's posterior odds are its own evidence times its
path's prior odds. Texts go through Python once; all that follows reads the table of what was found there.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import files_for, text_of, written
from feedloom.llm.evidence import fit, probabilities

#: Limits of the pseudo-counts of a prior.
LEAST, MOST = 1.0, 1e6
#: Posterior of quality from which a document is kept, and probability of toxicity from which it is not.
GOOD, TOXIC = 0.5, 0.5


def _strength(groups: DataFrame, rate: str, n: str, k: str) -> float:
    """Pseudo-counts by moments: what the groups' rates spread around `rate` beyond chance."""
    p = F.col(rate)
    spread = F.sum(F.col(n) * F.pow(F.col(k) / F.col(n) - p, 2))
    total, spread, chance, count = groups.agg(F.sum(n), spread, F.sum(F.col(n) * p * (1 - p)), F.count("*")).first()
    if not total or not chance or count < 2:
        return LEAST
    between = (spread - chance * count / total) / total  # chance / total is the mean of p(1 - p)
    return min(MOST, max(LEAST, (chance / total) / between - 1)) if between > 0 else MOST


def priors(scored: DataFrame) -> tuple[DataFrame, float]:
    """(source, lang, host_rate, path_rate) of every path, written to the shared folder, and the global rate."""
    paths = written(scored.groupBy("source", "lang").agg(F.count("*").alias("n"), F.sum("p").alias("k")), "paths", files_for(scored.count()))
    n, k = paths.agg(F.sum("n"), F.sum("k")).first()
    rate = ((k or 0) + 1) / ((n or 0) + 2)
    hosts = paths.groupBy("source").agg(F.sum("n").alias("hn"), F.sum("k").alias("hk")).withColumn("rate", F.lit(rate))
    m = _strength(hosts, "rate", "hn", "hk")
    hosts = hosts.select("source", ((F.col("hk") + m * rate) / (F.col("hn") + m)).alias("host_rate"))
    joined = paths.join(hosts, "source")
    m = _strength(joined, "host_rate", "n", "k")
    shrunk = (F.col("k") + m * F.col("host_rate")) / (F.col("n") + m)
    return written(joined.select("source", "lang", "host_rate", shrunk.alias("path_rate")), "priors", files_for(paths.count())), rate


def _logit(x: Column) -> Column:
    x = F.least(F.greatest(x, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(x / (1 - x))


def _site(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def row_hash(text: str) -> Column:
    """Tells the rows of one id apart: a hash of text, source and language."""
    return F.xxhash64(text_of(text), _site("source"), _site("lang"))


def assessed(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """id, h (row_hash), source, lang, p_quality and p_toxic (the classifier's), tokens, host_rate, path_rate, posterior and
    keep of every row, from a table in the shared folder. No other column of docs is read.

    A document is kept if its posterior of quality is at least GOOD and the classifier's probability that it is toxic is
    below TOXIC. Null and empty texts are judged by their shape (no words) like any other; null sources and languages are
    the empty ones. Null labels don't count; without labels (or with one class) the classifier gives the smoothed rate and
    all is kept. Repeated rows are judged alike; an empty table gives no rows. The fit reads at most 8,000 labelled
    documents; rates are sums over all documents.
    """
    heads = fit(docs, labels, ("quality", "toxic"), text)
    keep = [F.col("doc_id").cast("long").alias("id"), row_hash(text).alias("h"), *(_site(c).alias(c) for c in ("source", "lang"))]
    scored = written(probabilities(docs, heads, keep, text), "quality-evidence")
    prior, rate = priors(scored.select("source", "lang", F.col("p_quality").alias("p")))
    odds = _logit(F.col("p_quality")) - _logit(F.lit(rate)) + _logit(F.col("path_rate"))
    toxic = F.col("p_toxic") >= TOXIC if heads["toxic"].learnt else F.lit(False)
    found = scored.join(prior, ["source", "lang"]).withColumn("posterior", 1 / (1 + F.exp(-odds)))
    return found.withColumn("keep", (F.col("posterior") >= GOOD) & ~toxic if heads["quality"].learnt else ~toxic)


def quality(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, source, lang, document and posterior probabilities of quality, that of toxicity, and keep, for every row."""
    found = assessed(docs, labels, text)
    names = {"id": "doc_id", "source": "source", "lang": "lang", "p_quality": "p_document", "host_rate": "host_rate", "path_rate": "path_rate", "posterior": "p_quality", "p_toxic": "p_toxic", "keep": "keep"}
    return found.select(*[F.col(a).alias(b) for a, b in names.items()])


def filtered(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """The rows of docs that are kept, with docs' columns, whatever their names: what is rejected meets them by id and hash."""
    a, b = (f"{x}_{uuid.uuid4().hex}" for x in "ab")
    gone = assessed(docs, labels, text).where("not keep").select(F.col("id").alias(a), F.col("h").alias(b)).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(a)) & (row_hash(text) == F.col(b))
    return docs.join(gone, same, "left_anti")
