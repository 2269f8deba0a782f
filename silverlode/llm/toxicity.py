"""Toxicity classifier whose score must not move when an identity term is swapped for another.

A logistic model over word and word-prefix presence is fitted on a bounded sample of
labelled documents.  For every labelled sentence that names a group, a counterfactual
with another group's name is made; the squared change of the logit between the two is
added to the loss, so neutral mentions of a group do not raise the score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from silverlode.llm.words import PUNCTUATION, Words, mix, slices

#: Identity terms; a term is swapped for others of its own group.
IDENTITIES = (
    "women men girls boys transgender",
    "woman man girl boy",
    "muslims christians jews hindus buddhists atheists",
    "muslim christian jewish hindu buddhist atheist",
    "black white asian latino arab african european",
    "gay lesbian bisexual straight heterosexual homosexual",
    "immigrants refugees foreigners locals",
    "disabled deaf blind autistic",
    "old young elderly teenage",
    "femmes hommes filles garçons",
    "musulmans chrétiens juifs bouddhistes",
    "noirs blancs asiatiques arabes",
    "frauen männer mädchen jungen",
    "muslime christen juden buddhisten",
    "mujeres hombres chicas chicos",
    "musulmanes cristianos judíos budistas",
    "negros blancos asiáticos árabes",
)
SAMPLE = 16_000  # labelled documents that the classifier is fitted on, at most
POSITIVE_SHARE = 0.4  # of the sample, at most
PAIRS_PER_DOC = 8  # counterfactual sentences from one sampled document, at most
FEATURES = 20_000
PREFIXES = (4, 5, 6)
PENALTY = 1.0  # weight of the counterfactual term
RIDGE = 1e-3
STEPS = 200
THRESHOLD = 0.3

_TERM = re.compile(r"\b(" + "|".join(sorted({t for g in IDENTITIES for t in g.split()})) + r")\b")
_SENTENCE = re.compile(r"[^.!?\n]+")


@dataclass(frozen=True)
class Model:
    features: np.ndarray  # sorted 64-bit feature hashes
    weights: np.ndarray
    bias: float


def _features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) pairs, with repeats: word hashes and prefix hashes without punctuation."""
    words = Words(column, lower=True, gaps=PUNCTUATION)
    rows = np.repeat(np.arange(len(column)), words.counts())
    found_rows, found = [rows], [words.hashes()]
    for size in PREFIXES:
        which, hashes = words.prefix_hashes(size)
        found_rows.append(rows[which])
        found.append(mix(hashes))
    return np.concatenate(found_rows), np.concatenate(found)


def _sets(column: pa.Array) -> list[np.ndarray]:
    rows, found = _features(column)
    order = np.argsort(rows, kind="stable")
    cuts = np.searchsorted(rows[order], np.arange(1, len(column)))
    return [np.unique(part) for part in np.split(found[order], cuts)]


def swapped_sentences(text: str) -> list[tuple[str, str]]:
    """Sentences that name a group, each with its counterfactual, at most ``PAIRS_PER_DOC``."""
    pairs = []
    lowered = text.lower()
    if not _TERM.search(lowered):
        return pairs
    other = {}
    for group in IDENTITIES:
        terms = group.split()
        other.update({t: terms[(i + 1) % len(terms)] for i, t in enumerate(terms)})
    for sentence in _SENTENCE.findall(lowered):
        swapped = _TERM.sub(lambda m: other[m.group(1)], sentence)
        if swapped != sentence:
            pairs.append((sentence, swapped))
            if len(pairs) == PAIRS_PER_DOC:
                break
    return pairs


def _training_rows(features: np.ndarray | None = None):
    """Sets of labelled texts, and the two differing sets of each counterfactual pair; of ``features`` only."""

    def kept(found: np.ndarray) -> np.ndarray:
        return (found if features is None else np.intersect1d(found, features)).view(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                texts = piece.column("text")
                sets = _sets(texts)
                pairs = [p for t in texts.to_pylist() for p in swapped_sentences(t or "")]
                before, after = (_sets(pa.array([p[i] for p in pairs], pa.string())) if pairs else [] for i in (0, 1))
                label = piece.column("label").to_pylist() + [None] * len(pairs)
                plus = [kept(s) for s in sets] + [kept(np.setdiff1d(a, b)) for a, b in zip(before, after)]
                minus = [None] * len(sets) + [kept(np.setdiff1d(b, a)) for a, b in zip(before, after)]
                kind = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(label, pa.int32()), pa.array(plus, kind), pa.array(minus, kind)], ["label", "plus", "minus"]
                )

    return run


def remainder(doc_id):
    """crc32 of the id's text modulo 4; documents of remainder 2 are held out (null ids: none)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4, F.lit(-1))


def training_sample(docs: DataFrame, labels: DataFrame) -> pd.DataFrame:
    """At most ``SAMPLE`` labelled documents outside the held-out part, picked by a hash of their id.

    A document with several labels counts as toxic if one of them says so; of repeated
    ids the smallest text is used.
    """
    labelled = (
        labels.where("toxic is not null and doc_id is not null")
        .where(remainder(F.col("doc_id")) != 2)
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("label"))
    )
    order = F.xxhash64("doc_id", F.lit(17))
    positive = int(SAMPLE * POSITIVE_SHARE)
    picked = (
        labelled.where("label = 1").orderBy(order, "doc_id").limit(positive)
        .union(labelled.where("label = 0").orderBy(order, "doc_id").limit(SAMPLE - positive))
    )
    rows = docs.select(F.col("doc_id"), F.col("text").cast("string")).join(F.broadcast(picked), "doc_id")
    # One text per id, so the bound holds for rows as well.
    rows = rows.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("label", "text")
    kind = "label int, plus array<long>, minus array<long>"
    features = telling_features(rows.mapInArrow(_training_rows(), kind))
    return rows.mapInArrow(_training_rows(features), kind).toPandas()


def telling_features(rows: DataFrame) -> np.ndarray:
    """At most ``FEATURES`` features, sorted, that differ far beyond chance between the classes of ``rows``.

    Counted where the rows are, so the driver sees no other feature of the sample; rare
    words of long texts add no noise.
    """
    labelled = rows.where("label is not null")
    n1, n0 = (float(n or 0) for n in labelled.agg(F.sum("label"), F.sum(1 - F.col("label"))).first())
    if not n1 or not n0:
        return np.zeros(0, np.uint64)
    seen = Observation()
    counts = (
        labelled.select("label", F.explode("plus").alias("feature"))
        .groupBy("feature")
        .agg(F.sum("label").alias("pos"), F.count(F.lit(1)).alias("both"))
        .observe(seen, F.count(F.lit(1)).alias("names"))
    )
    rate = f"both / {n1 + n0}D"
    spread = f"sqrt(greatest({rate} * (1 - {rate}), 1e-12D) * {1 / n1 + 1 / n0}D)"
    z = F.expr(f"abs(pos / {n1}D - (both - pos) / {n0}D) / {spread}")
    best = counts.where("both >= 3").select("feature", z.alias("z")).orderBy(F.desc("z"), "feature").limit(FEATURES).toPandas()
    cut = np.sqrt(2 * np.log(max(seen.get["names"], 2)))
    return np.sort(best["feature"][best["z"] > cut].to_numpy(np.int64).view(np.uint64))


class _Rows:
    """Sparse 0/1 rows (or signed ones) over a feature list."""

    def __init__(self, parts: list[np.ndarray], features: np.ndarray):
        lengths = [len(p) for p in parts]
        flat = np.concatenate([*parts, np.zeros(0, np.uint64)]).astype(np.uint64)
        row = np.repeat(np.arange(len(parts)), lengths)
        place = np.searchsorted(features, flat)
        place[place == len(features)] = 0
        hit = features[place] == flat if len(features) else np.zeros(len(flat), bool)
        self.row, self.column, self.n, self.width = row[hit], place[hit], len(parts), len(features)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.column], self.n)

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, g[self.row], self.width)


def fit(sample: pd.DataFrame) -> Model:
    """The regularised logistic model; without labels of both kinds it scores every text alike."""
    labelled = sample[sample["label"].notna()]
    y = labelled["label"].to_numpy(np.float64)
    share = float(y.mean()) if len(y) else 0.1
    if not len(y) or share in (0.0, 1.0):
        share = min(max(share, 0.01), 0.99)
        return Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log(share / (1 - share))))
    sets = [np.asarray(p, np.int64).view(np.uint64) for p in labelled["plus"]]
    flat = np.concatenate([*sets, np.zeros(0, np.uint64)])
    toxic = np.repeat(y > 0, [len(s) for s in sets])
    names, inverse = np.unique(flat, return_inverse=True)
    pos = np.bincount(inverse, toxic, len(names))
    neg = np.bincount(inverse, ~toxic, len(names))
    n1, n0 = y.sum(), len(y) - y.sum()
    rate = (pos + neg) / len(y)
    z = (pos / n1 - neg / n0) / np.sqrt(np.maximum(rate * (1 - rate), 1e-12) * (1 / n1 + 1 / n0))
    # Only features that differ far beyond chance between the classes: rare words of long texts add no noise.
    cut = np.sqrt(2 * np.log(max(len(names), 2)))
    strong = np.flatnonzero((np.abs(z) > cut) & (pos + neg >= 3))
    strong = strong[np.argsort(-np.abs(z[strong]), kind="stable")[:FEATURES]]
    features = np.sort(names[strong])

    x = _Rows(sets, features)
    pairs = sample[sample["label"].isna()]
    plus = _Rows([np.asarray(p, np.int64).view(np.uint64) for p in pairs["plus"]], features)
    minus = _Rows([np.asarray(p, np.int64).view(np.uint64) for p in pairs["minus"]], features)
    weight = np.where(y > 0, 0.5 / n1, 0.5 / n0)
    w, bias = np.zeros(len(features)), 0.0
    m, v = np.zeros(len(features) + 1), np.zeros(len(features) + 1)
    for step in range(1, STEPS + 1):
        error = weight * (1 / (1 + np.exp(-(x.times(w) + bias))) - y)
        grad = x.back(error) + RIDGE * w
        if len(pairs):
            change = plus.times(w) - minus.times(w)
            grad += 2 * PENALTY / len(pairs) * (plus.back(change) - minus.back(change))
        g = np.append(grad, error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
        w, bias = w - move[:-1], bias - move[-1]
    return Model(features, w, float(bias))


def scorer(model: Model):
    """A column function: the probability of label 1 for whole texts (null: empty)."""

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        logits = np.full(len(text), model.bias)
        if len(model.features) and len(text):
            rows, found = _features(text)
            place = np.searchsorted(model.features, found)
            place[place == len(model.features)] = 0
            hit = model.features[place] == found
            once = np.unique(rows[hit] * len(model.features) + place[hit])
            row, column = np.divmod(once, len(model.features))
            logits += np.bincount(row, model.weights[column], len(text))
        return pa.array(1 / (1 + np.exp(-np.clip(logits, -700, 700))), pa.float64())

    return score


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(``doc_id``, ``held_out``, ``score``, ``predicted``) for every row of ``docs``.

    Empty and null texts get the score of no evidence; repeated rows score alike;
    without usable labels every text gets one score; an empty table gives no rows;
    other columns are ignored.
    """
    score = scorer(fit(training_sample(docs, labels)))
    return docs.select(
        F.col("doc_id"), (remainder(F.col("doc_id")) == 2).alias("held_out"), score(F.col("text").cast("string")).alias("score")
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
