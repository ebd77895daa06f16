"""Toxicity by weak supervision.

Voters are lexicon words and word-beginning patterns mined from a bounded sample of labelled rows. A
generative model of their votes, fitted by expectation maximisation without labels, estimates how
often each fires on either class and how far voters fire together within a class; voters that say the
same share one vote. Its posteriors, not the labels, train a linear classifier over a wider set of the
same kind of features, which scores every text.
"""

from __future__ import annotations

import string
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.llm.pieces import small_batches
from postlake.session import cut_lineage

#: Bound of the sample of labelled rows all fitting is done on.
MAX_LABELLED = 20_000
VOTERS = 256
FEATURES = 2048
LEAST_SUPPORT = 3
#: Nats by which a feature must beat chance, the number of candidates counted in.
MARGIN = 2.0
#: Correlation within a class from which two voters are taken to say the same.
TOGETHER = 0.5
_PREFIXES = (4, 5, 6)
_STRIP = string.punctuation + "…“”„«»¿¡"


def text_features(text: str | None) -> set[str]:
    """The distinct words of ``text``, lower-cased and without marks at their ends, and the beginnings
    of the longer ones (``lowei*``)."""
    words = {word.strip(_STRIP) for word in set((text or "").lower().split())}
    found = {word for word in words if 1 < len(word) <= 40}
    for size in _PREFIXES:
        found |= {word[:size] + "*" for word in words if len(word) > size}
    return found


@dataclass(frozen=True)
class Model:
    """Weights of features and a bias; a score is the sigmoid of their sum."""

    weights: dict[str, float]
    bias: float

    def score(self, text: str | None) -> float:
        weights = self.weights
        logit = self.bias + sum(weights[name] for name in text_features(text) if name in weights)
        return 1.0 / (1.0 + np.exp(-np.clip(logit, -60, 60)))


def held_out(doc_id: Column) -> Column:
    """Rows no label is learnt from: crc32 of the id as text, by five."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def labelled_sample(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, text, toxic) of at most ``limit`` labelled rows outside the held-out fifth, chosen by a
    hash of the id. An id labelled more than once is toxic if one label says so; null ids and null
    labels teach nothing."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return cut_lineage(texts.join(F.broadcast(known), "doc_id").dropDuplicates(["doc_id"]))  # at most ``limit`` ids


def mine(sample: DataFrame, limit: int) -> pd.DataFrame:
    """The features that tell the classes of ``sample`` apart best, ``limit`` at most: name, pos, neg, z
    and how far (in nats) chance falls short of such a split among so many candidates."""

    def count(batches):
        found = {0: Counter(), 1: Counter()}
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                found[int(toxic > 0)].update(text_features(text))
        names = list(found[0].keys() | found[1].keys())
        yield pa.record_batch({
            "name": pa.array(names, pa.string()), "pos": pa.array([found[1][n] for n in names], pa.int64()),
            "neg": pa.array([found[0][n] for n in names], pa.int64()),
        })

    sizes = {row["c"]: row["count"] for row in sample.groupBy((F.col("toxic") > 0).cast("int").alias("c")).count().collect()}
    positive, negative = sizes.get(1, 0), sizes.get(0, 0)
    if not positive or not negative:
        return pd.DataFrame({"name": [], "pos": [], "neg": [], "z": [], "beyond_chance": []})
    counts = sample.mapInArrow(count, "name STRING, pos BIGINT, neg BIGINT").groupBy("name").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg")
    ).where(F.col("pos") + F.col("neg") >= LEAST_SUPPORT)
    counts = cut_lineage(counts)
    share, inside = positive / (positive + negative), F.col("pos") / (F.col("pos") + F.col("neg"))
    gain = F.when(F.col("pos") > 0, F.col("pos") * F.log(inside / share)).otherwise(0.0) + F.when(
        F.col("neg") > 0, F.col("neg") * F.log((1 - inside) / (1 - share))
    ).otherwise(0.0)
    counts = counts.withColumn("beyond_chance", gain - float(np.log(max(counts.count(), 1))))
    rate_pos, rate_neg = F.col("pos") / positive, F.col("neg") / negative
    pooled = (F.col("pos") + F.col("neg") + 1.0) / (positive + negative + 2.0)
    z = (rate_pos - rate_neg) / F.sqrt(pooled * (1 - pooled) * (1.0 / positive + 1.0 / negative))
    best = counts.withColumn("z", z).where(F.col("beyond_chance") > MARGIN).orderBy(F.desc(F.abs("z")), "name")
    return _own_patterns(best.limit(4 * limit).toPandas()).head(limit).reset_index(drop=True)


def _own_patterns(mined: pd.DataFrame) -> pd.DataFrame:
    """``mined`` without the patterns that say no more than one word, or one longer pattern, below them:
    a beginning counts as a pattern of its own only if rows beyond those of its commonest word hold it."""
    size = dict(zip(mined["name"], mined["pos"] + mined["neg"]))
    below: dict[str, int] = {}
    for name, rows in size.items():
        stem = name.rstrip("*")
        for cut in _PREFIXES:
            if len(stem) > cut:
                pattern = stem[:cut] + "*"
                below[pattern] = max(below.get(pattern, 0), rows)
    keep = [not name.endswith("*") or rows >= 1.25 * below.get(name, 0) + 2 for name, rows in size.items()]
    return mined[keep]


def presence(sample: DataFrame, names: list[str]) -> tuple[np.ndarray, np.ndarray, int]:
    """(row, feature) of each feature of ``names`` present in a row of the bounded sample, and its rows."""
    place = {name: at for at, name in enumerate(names)}

    def run(batches):
        for batch in batches:
            yield pa.record_batch({"found": pa.array(
                [sorted(place[n] for n in text_features(text) if n in place) for text in batch.column("text").to_pylist()],
                pa.list_(pa.int32()),
            )})

    lists = [row["found"] for row in sample.select("doc_id", "text").orderBy("doc_id").select("text").mapInArrow(run, "found ARRAY<INT>").collect()]
    rows = np.repeat(np.arange(len(lists)), [len(one) for one in lists])
    return rows, np.array([at for one in lists for at in one], np.int64), len(lists)


def label_model(votes: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Posterior of the positive class for each row of ``votes`` (rows by voters, 1 where one fires).

    Starts from the rows in which anything fires and alternates: firing rates per class (the voters'
    accuracies), correlations of the voters within the positive class, posteriors. A voter's evidence
    is divided by the number of voters it moves with, itself included; one that does not fire
    abstains, and a row in which none fires has the evidence of that.
    """
    n, voters = votes.shape
    if not voters:
        return np.zeros(n)
    fired = votes.sum(axis=1)
    posterior = np.where(fired >= 2, 0.95, np.where(fired == 1, 0.5, 0.02))
    for _ in range(rounds):
        mass = posterior.sum()
        prior = np.clip(mass / n, 1e-4, 1 - 1e-4)
        on_positive = (posterior @ votes + 0.5) / (mass + 1.0)
        on_negative = ((1 - posterior) @ votes + 0.05) / (n - mass + 1.0)
        off = votes - on_positive
        spread = (off * posterior[:, None]).T @ off / max(mass, 1.0)
        scale = np.sqrt(np.maximum(np.diag(spread), 1e-6))
        together = spread / np.outer(scale, scale)
        together[together < TOGETHER] = 0.0
        share = 1.0 / np.maximum(together.sum(axis=1), 1.0)
        silent_positive = (posterior[fired == 0].sum() + 0.5) / (mass + 1.0)
        silent_negative = ((1 - posterior)[fired == 0].sum() + 0.5) / (n - mass + 1.0)
        logit = np.log(prior / (1 - prior)) + votes @ (share * np.log(on_positive / on_negative))
        logit += np.where(fired == 0, np.log(silent_positive / silent_negative), 0.0)
        updated = 1.0 / (1.0 + np.exp(-np.clip(logit, -40, 40)))
        if np.abs(updated - posterior).max() < 1e-6:
            break
        posterior = updated
    return posterior


def linear_fit(rows, columns, n: int, width: int, target: np.ndarray, penalty: float = 1e-5, rounds: int = 800):
    """Logistic regression on present features against soft labels: gradient steps scaled by running
    moments of each weight's gradient. The last weight is the bias."""
    weights, mean, square = (np.zeros(width + 1) for _ in range(3))
    weights[-1] = np.log((target.mean() + 1e-3) / (1 - target.mean() + 1e-3))
    for at in range(1, rounds + 1):
        logit = weights[-1] + np.bincount(rows, weights=weights[columns], minlength=n)
        error = 1.0 / (1.0 + np.exp(-np.clip(logit, -40, 40))) - target
        slope = np.append(np.bincount(columns, weights=error[rows], minlength=width), error.sum()) / n
        slope[:-1] += penalty * weights[:-1]
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope ** 2
        weights -= 0.1 * (1 - at / (rounds + 1)) * mean / (1 - 0.9 ** at) / (np.sqrt(square / (1 - 0.99 ** at)) + 1e-8)
    return weights[:-1], weights[-1]


def fit(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> Model:
    """The model learnt from ``labels`` (doc_id, toxic) on at most ``limit`` rows. Without rows of both
    classes every text scores 0.5 less a hair: the model knows nothing."""
    sample = labelled_sample(docs, labels, limit)
    mined = mine(sample, FEATURES)
    if mined.empty:
        return Model({}, -1e-9)
    names = mined["name"].tolist()
    rows, columns, n = presence(sample, names)
    voters = mined[(mined["z"] > 0) & (mined["pos"] > 8 * mined["neg"])].index.to_numpy()[:VOTERS]
    seat = np.full(len(names), -1)
    seat[voters] = np.arange(len(voters))
    votes = np.zeros((n, len(voters)), np.float32)
    chosen = seat[columns] >= 0
    votes[rows[chosen], seat[columns[chosen]]] = 1.0
    posterior = label_model(votes)
    weights, bias = linear_fit(rows, columns, n, len(names), posterior)
    return Model({name: float(w) for name, w in zip(names, weights) if abs(w) > 1e-6}, float(bias))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted) of each row: the whole text is scored, nothing else of the row is used.

    A null or empty text scores the bias alone. Null and repeated ids keep a row each; other columns
    are not carried; an empty table gives none.
    """

    def run(batches):
        for batch in small_batches(batches, "text"):
            found = np.array([model.score(text) for text in batch.column("text").to_pylist()])
            yield pa.record_batch({
                id_col: batch.column("id"), "score": pa.array(found),
                "predicted": pa.array((found >= 0.5).astype(np.int32)),
            })

    rows = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
    return rows.mapInArrow(run, f"{id_col} BIGINT, score DOUBLE, predicted INT")
