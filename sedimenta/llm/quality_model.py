"""Quality classifier with hierarchical empirical Bayes.

A document's own evidence comes from a logistic model on format features,
fitted on a bounded sample of labelled documents (of each class about
``SAMPLE / 2``, those of least hash, weighed back to the classes' true sizes).

Sites are hosts and, within them, paths.  A site's evidence is a number of
documents and how many of them are good: a labelled document counts one and
its label, an unlabelled one counts by what the classifier says of it, at the
share of a label's variance that the classifier explains.  Shares are
beta-binomial on both levels: hosts scatter about the global share, paths about
their host's.  How strongly, the prior counts of both levels, is estimated by
moments from the grouped counts (between-site variance beyond the binomial's),
so sparse sites shrink as far as the corpus itself says they should.

A document's posterior leaves out what the document itself has put into its
host's and path's figures.  Its log odds are the model's plus the path's
difference from the global log odds, so a site moves a document only by what
the others of the site add.

``source`` stands for the host and ``lang`` for the path.  Grouped sums are
combined in each task before the shuffle, so a host of a third of all rows is
one row per task, and its posteriors join as small tables.

Defined cases: a null or empty text has no words and counts by its format; a
null host or path is one of its own; a document with several label rows counts
its first (least quality), and rows that repeat an id share its label; without
labels, or with one class only, every document is kept with the global share
(1 without labels); where sites do not scatter beyond chance they have no say;
rows that repeat each get a row; columns of any other name play no part.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, plain_words

SAMPLE = 20_000
#: Bounds of the estimated prior counts.
LEAST_STRENGTH, MOST_STRENGTH = 0.5, 1e6
KEEP_FROM = 0.5
FEATURES = ("bias", "symbols", "capitals", "bars", "letters", "long_words", "short", "distinct", "digits", "repeats")


def format_features(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns and ``x``, an array of FEATURES in [0, 1] or so."""
    text = F.coalesce("text", F.lit(""))
    cut = docs.select(*keep, text.alias("text"), plain_words(F.col("text")).alias("w")).select(
        *keep, "text", F.size("w").alias("n"), F.size(F.array_distinct("w")).alias("kinds"), F.greatest(F.length("text"), F.lit(1)).alias("chars")
    )

    def share(pattern: str) -> Column:
        return (F.col("chars") - F.length(F.regexp_replace("text", pattern, ""))) / F.col("chars")

    n = F.greatest("n", F.lit(1))
    return cut.select(
        *keep,
        F.array(
            F.lit(1.0),
            F.least(F.lit(1.0), share(r"[#$%&*<>]+") * 10),
            share("[A-Z]+"),
            F.least(F.lit(1.0), share(r"\|+") * 20),
            share(r"\p{L}+"),
            F.least(F.lit(2.0), F.col("chars") / n / 10),
            F.lit(1.0) / F.sqrt(n),
            F.col("kinds") / n,
            F.least(F.lit(1.0), share("[0-9]+") * 10),
            F.when(F.col("kinds") * 2 < n, 1.0).otherwise(0.0),
        ).alias("x"),
    )


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Newton steps on weighed rows with a ridge on all but the bias."""
    beta, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[0] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (weight * (y - p)) - penalty * beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def _logit(p: Column) -> Column:
    return F.log(p / (F.lit(1.0) - p))


def _sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def _strength(excess: float, room: float) -> float:
    """Prior count of an intraclass correlation of ``excess / room``."""
    if room <= 0 or excess <= 0:
        return MOST_STRENGTH
    correlation = min(excess / room, 1.0)
    return min(MOST_STRENGTH, max(LEAST_STRENGTH, (1 - correlation) / correlation)) if correlation > 0 else MOST_STRENGTH


def strengths(sites: DataFrame) -> tuple[float, float, float]:
    """Global share and the prior counts of hosts and of paths, by moments.

    ``sites`` has n and good of each host and path.  For groups of sizes n with
    shares q about m, the sum of n (q - m)^2 expects v (K - 1) under chance
    alone, v = m (1 - m), and v times the correlation times
    (N - K + 1 - sum(n^2) / N) more.  Paths are pooled over their hosts.
    """
    each = sites.groupBy("host").agg(
        F.sum("n").alias("n"), F.sum("good").alias("good"), F.count("*").alias("k"), F.sum(F.col("n") * F.col("n")).alias("nn"), F.sum(F.col("good") * F.col("good") / F.col("n")).alias("ss")
    )
    v = F.col("good") / F.col("n") * (1 - F.col("good") / F.col("n"))
    f = each.agg(
        F.sum("n").alias("n"), F.sum("good").alias("good"), F.count("*").alias("k"), F.sum(F.col("n") * F.col("n")).alias("nn"), F.sum(F.col("good") * F.col("good") / F.col("n")).alias("ss"),
        F.sum(F.col("ss") - F.col("good") * F.col("good") / F.col("n") - v * (F.col("k") - 1)).alias("path_excess"),
        F.sum(v * (F.col("n") - F.col("k") + 1 - F.col("nn") / F.col("n"))).alias("path_room"),
    ).first()
    m = f["good"] / f["n"]
    v = m * (1 - m)
    excess, room = f["ss"] - f["good"] ** 2 / f["n"] - v * (f["k"] - 1), v * (f["n"] - f["k"] + 1 - f["nn"] / f["n"])
    return m, _strength(excess, room), _strength(f["path_excess"], f["path_room"])


def classify(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang") -> DataFrame:
    """doc_id, model_score, host_share, path_share, score and kept."""
    truth = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").cast("int").alias("y"))
    rows = format_features(docs.select("doc_id", F.col(host).alias("host"), F.col(path).alias("path"), "text"), "doc_id", "host", "path")
    rows = durable(rows.join(truth, "doc_id", "left"))  # features without texts
    known = rows.where(F.col("y").isNotNull())
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}  # 0 and 1
    n, good = sum(counts.values()), counts.get(1, 0)
    share = (good + 1) / (n + 2) if n else 1.0
    if not n or good in (0, n):
        return rows.select("doc_id", *[F.lit(share).alias(c) for c in ("model_score", "host_share", "path_share", "score")], F.lit(True).alias("kept"))
    rate = {y: min(1.0, SAMPLE / 2 / c) for y, c in counts.items()}
    chance = F.pmod(F.xxhash64("doc_id", F.hash("x")), F.lit(1_000_003)) / 1_000_003.0
    sample = known.where(chance < F.when(F.col("y") == 1, rate[1]).otherwise(rate[0])).select("y", "x").collect()
    sample.sort()  # sums in one order, whatever the tasks' order
    beta = fit_logistic(np.array([r["x"] for r in sample]), np.array([r["y"] for r in sample], float), np.array([1 / rate[r["y"]] for r in sample]))
    evidence = sum((F.get("x", F.lit(k)) * float(b) for k, b in enumerate(beta)), F.lit(0.0))
    rows = rows.select("doc_id", "host", "path", "y", evidence.alias("evidence"), _sigmoid(evidence).alias("p"))
    # What an unlabelled document is worth: the share of a label's variance that the model explains.
    fit = rows.where(F.col("y").isNotNull()).agg(F.corr("p", F.col("y").cast("double")).alias("r")).first()["r"]
    worth = fit * fit if fit is not None and fit > 0 else 0.0
    own_n = F.when(F.col("y").isNotNull(), 1.0).otherwise(F.lit(worth))
    own_good = F.when(F.col("y").isNotNull(), F.col("y").cast("double")).otherwise(F.col("p") * worth)
    rows = rows.withColumns({"own_n": own_n, "own_good": own_good})
    sites = rows.groupBy("host", "path").agg(F.sum("own_n").alias("n"), F.sum("own_good").alias("good")).where(F.col("n") > 0)
    sites = durable(sites)
    mean, of_hosts, of_paths = strengths(sites)
    hosts = sites.groupBy(F.col("host").alias("of_host")).agg(F.sum("n").alias("host_n"), F.sum("good").alias("host_good"))
    paths = sites.select(F.col("host").alias("at_host"), F.col("path").alias("at_path"), F.col("n").alias("path_n"), F.col("good").alias("path_good"))
    placed = rows.join(hosts, F.col("host").eqNullSafe(F.col("of_host")), "left").join(
        paths, F.col("host").eqNullSafe(F.col("at_host")) & F.col("path").eqNullSafe(F.col("at_path")), "left"
    )

    def others(level: str, prior: Column, strength: float) -> Column:
        left_n = F.greatest(F.coalesce(f"{level}_n", F.lit(0.0)) - F.col("own_n"), F.lit(0.0))
        left_good = F.least(F.greatest(F.coalesce(f"{level}_good", F.lit(0.0)) - F.col("own_good"), F.lit(0.0)), left_n)
        return (left_good + prior * strength) / (left_n + strength)

    placed = placed.withColumn("host_share", others("host", F.lit(mean), of_hosts))
    placed = placed.withColumn("path_share", others("path", F.col("host_share"), of_paths))
    odds = F.col("evidence") + _logit(F.col("path_share")) - _logit(F.lit(mean))
    return placed.select("doc_id", F.col("p").alias("model_score"), "host_share", "path_share", _sigmoid(odds).alias("score"), (_sigmoid(odds) >= KEEP_FROM).alias("kept"))
