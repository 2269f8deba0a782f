"""Quality classifier over passages: attention-based multiple-instance learning.

A document is a bag of passages.  Every passage is encoded to a vector (its surface,
the shapes of its words and hashed words, through a learned layer), a gated attention
gives each passage a weight, and the weighted mean of the vectors is scored.  Only
documents have labels; which passages matter is learned from these.

The model is fitted on a bounded sample of labelled documents.  Scoring reads every
passage of every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.llm.words import Words, slices

PASSAGE_WORDS = 128
SAMPLE = 6000  # labelled documents of each label that the model is fitted on, at most
BAG = 24  # passages of one sampled document used in fitting, at most, evenly spread
WORD_CELLS = 64  # hashed words
SHAPE_CELLS = 64  # word shapes
HIDDEN, GATE = 24, 12  # width of a passage's vector and of the attention
EPOCHS, BATCH, RATE, DECAY = 30, 128, 0.01, 1e-4
THRESHOLD = 0.3

_CLASSES = ("upper", "digit", "symbol", "stop", "wide", "line")
_SURFACE = len(_CLASSES) + 4
FEATURES = _SURFACE + SHAPE_CELLS + WORD_CELLS


def _class_table() -> np.ndarray:
    table = np.full(256, -1, np.int64)
    table[[*range(ord("A"), ord("Z") + 1)]] = 0
    table[[*range(ord("0"), ord("9") + 1)]] = 1
    table[[b for b in range(33, 127) if not chr(b).isalnum()]] = 2
    table[[ord(c) for c in ".,;:'\"()-?"]] = 3
    table[128:] = 4
    table[ord("\n")] = 5
    return table


_CLASS = _class_table()


@dataclass(frozen=True)
class Model:
    """Layers of the encoder, the gated attention and the score; ``bias`` alone scores without labels."""

    parts: dict[str, np.ndarray]
    bias: float

    @property
    def empty(self) -> bool:
        return not self.parts


def passage_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row of each passage, features of each passage); a text without words has one passage of zeros."""
    words = Words(column)
    counts = words.counts()
    per_row = np.maximum((counts + PASSAGE_WORDS - 1) // PASSAGE_WORDS, 1)
    rows = np.repeat(np.arange(len(counts)), per_row)
    first_passage = np.cumsum(per_row) - per_row
    x = np.zeros((len(rows), FEATURES), np.float32)
    if not len(words.starts):
        return rows, x
    word_row = np.repeat(np.arange(len(counts)), counts)
    passage = first_passage[word_row] + (np.arange(len(word_row)) - words.first[:-1][word_row]) // PASSAGE_WORDS
    n = np.bincount(passage, minlength=len(rows))
    some = np.flatnonzero(n)
    last = np.cumsum(n)[some]
    begin, end = words.starts[last - n[some]], words.ends[last - 1]
    size = (end - begin).astype(np.float32)
    classes = _CLASS[words.data]
    of_word = np.zeros((len(_CLASSES), len(word_row)), np.int64)
    for k in range(len(_CLASSES)):
        upto = np.concatenate([[0], np.cumsum(classes == k)])
        x[some, k] = (upto[end] - upto[begin]) / size
        of_word[k] = upto[words.ends] - upto[words.starts]
    lengths = words.ends - words.starts
    hashes = words.hashes()
    x[some, 6] = np.bincount(passage, lengths)[some] / n[some] / 8
    x[some, 7] = np.log1p(n[some]) / np.log1p(PASSAGE_WORDS)
    order = np.lexsort((hashes, passage))
    p, h = passage[order], hashes[order]
    new = np.concatenate([[True], (p[1:] != p[:-1]) | (h[1:] != h[:-1])])
    x[some, 8] = np.bincount(p[new], minlength=len(rows))[some] / n[some]
    runs = np.diff(np.append(np.flatnonzero(new), len(p)))
    most = np.zeros(len(rows), np.int64)
    np.maximum.at(most, p[new], runs)
    x[some, 9] = most[some] / n[some]
    shape = (
        (of_word[0] > 0) + 2 * (of_word[0] > 1) + 4 * (of_word[1] > 0) + 8 * (of_word[2] > 0) + 16 * (of_word[3] > 0)
        + 32 * (lengths > 9)
    )
    share = 1 / n[passage]
    cells = np.bincount(passage * SHAPE_CELLS + shape, share, len(rows) * SHAPE_CELLS)
    x[:, _SURFACE : _SURFACE + SHAPE_CELLS] = cells.reshape(-1, SHAPE_CELLS)
    cells = np.bincount(passage * WORD_CELLS + (hashes % np.uint64(WORD_CELLS)).astype(np.int64), share, len(rows) * WORD_CELLS)
    x[:, _SURFACE + SHAPE_CELLS :] = cells.reshape(-1, WORD_CELLS)
    return rows, x


def remainder(doc_id):
    """crc32 of the id's text modulo 5; documents of remainder 0 are held out (null ids: none)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5, F.lit(-1))


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, "text"):
            rows, x = passage_features(piece.column("text"))
            bags = []
            for a, b in zip(np.searchsorted(rows, np.arange(piece.num_rows)), np.searchsorted(rows, np.arange(piece.num_rows), "right")):
                picked = np.unique(np.linspace(a, b - 1, min(b - a, BAG)).astype(np.int64))
                bags.append(x[picked].ravel())
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("label"), pa.array(bags, pa.list_(pa.float32()))], ["doc_id", "label", "bag"]
            )


def training_bags(docs: DataFrame, labels: DataFrame) -> pd.DataFrame:
    """(label, bag) of at most ``SAMPLE`` documents of each label outside the held-out part.

    Documents are picked by a hash of their id; one with several labels is good only if
    all say so; of repeated ids one text is used, so the bound holds for rows, too.
    """
    kind = labels.schema["doc_id"].dataType
    labelled = (
        labels.where("quality is not null and doc_id is not null")
        .where(remainder(F.col("doc_id")) != 0)
        .groupBy("doc_id").agg(F.min("quality").cast("int").alias("label"))
    )
    order = F.xxhash64("doc_id", F.lit(29))
    picked = labelled.where("label = 1").orderBy(order, "doc_id").limit(SAMPLE).union(
        labelled.where("label = 0").orderBy(order, "doc_id").limit(SAMPLE)
    )
    texts = docs.select(F.col("doc_id").cast(kind), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(picked), "doc_id").select("doc_id", "label", "text")
    bags = rows.mapInArrow(_bags, f"doc_id {kind.simpleString()}, label int, bag array<float>")
    one = bags.groupBy("doc_id").agg(F.min(F.struct("label", "bag")).alias("one")).select("doc_id", "one.*")
    return one.toPandas().sort_values("doc_id", ignore_index=True)


def _weights(x: np.ndarray, seg: np.ndarray, firsts: np.ndarray, w: dict[str, np.ndarray]):
    """The forward pass: vectors, both gates, attention within each bag, and the bags' logits."""
    h = np.tanh(((x - w["mean"]) * w["scale"]) @ w["encode"] + w["encode_bias"])
    t, s = np.tanh(h @ w["tanh"]), 1 / (1 + np.exp(-np.clip(h @ w["gate"], -60, 60)))
    g = (t * s) @ w["attend"]
    e = np.exp(g - np.maximum.reduceat(g, firsts)[seg])
    a = e / np.add.reduceat(e, firsts)[seg]
    z = np.add.reduceat(a[:, None] * h, firsts)
    return h, t, s, a, z, z @ w["score"] + w["bias"]


def _gradients(x, seg, firsts, w, y, weight) -> dict[str, np.ndarray]:
    h, t, s, a, z, logit = _weights(x, seg, firsts, w)
    d = weight * (1 / (1 + np.exp(-np.clip(logit, -60, 60))) - y)
    dz = d[:, None] * w["score"]
    dh = a[:, None] * dz[seg]
    da = (dz[seg] * h).sum(1)
    dg = a * (da - np.add.reduceat(a * da, firsts)[seg])
    dt, ds = dg[:, None] * w["attend"] * s * (1 - t * t), dg[:, None] * w["attend"] * t * s * (1 - s)
    dh = (dh + dt @ w["tanh"].T + ds @ w["gate"].T) * (1 - h * h)
    return {
        "encode": ((x - w["mean"]) * w["scale"]).T @ dh, "encode_bias": dh.sum(0), "tanh": h.T @ dt, "gate": h.T @ ds,
        "attend": (t * s).T @ dg, "score": z.T @ d, "bias": d.sum(keepdims=True),
    }


def fit(sample: pd.DataFrame) -> Model:
    """The fitted model; without labels of both kinds it scores every text alike."""
    y = sample["label"].to_numpy(np.float32)
    share = float(y.mean()) if len(y) else 0.5
    if not len(y) or share in (0.0, 1.0):
        share = min(max(share, 0.01), 0.99)
        return Model({}, float(np.log(share / (1 - share))))
    bags = [np.asarray(b, np.float32).reshape(-1, FEATURES) for b in sample["bag"]]
    everything = np.concatenate(bags)
    rng = np.random.default_rng(13)
    w = {
        "mean": everything.mean(0), "scale": 1 / (everything.std(0) + 1e-3),
        "encode": rng.normal(0, FEATURES**-0.5, (FEATURES, HIDDEN)), "encode_bias": np.zeros(HIDDEN),
        "tanh": rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)), "gate": rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)),
        "attend": rng.normal(0, GATE**-0.5, GATE), "score": rng.normal(0, HIDDEN**-0.5, HIDDEN), "bias": np.zeros(1),
    }
    w = {k: v.astype(np.float32) for k, v in w.items()}
    weight = np.where(y > 0, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    learned = [k for k in w if k not in ("mean", "scale")]
    m, v = ({k: np.zeros_like(w[k]) for k in learned} for _ in range(2))
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            sizes = [len(bags[i]) for i in chosen]
            firsts = np.cumsum([0, *sizes[:-1]])
            seg = np.repeat(np.arange(len(chosen)), sizes)
            grads = _gradients(np.concatenate([bags[i] for i in chosen]), seg, firsts, w, y[chosen], weight[chosen] / len(chosen))
            step += 1
            rate = RATE * 0.5 * (1 + np.cos(np.pi * epoch / EPOCHS))
            for k in learned:
                g = grads[k] + DECAY * w[k] * (k != "bias")
                m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
                w[k] = (w[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return Model(w, 0.0)


def attention_scores(model: Model, column: pa.Array) -> np.ndarray:
    """The probability of label 1 for each whole text."""
    if model.empty or not len(column):
        return np.full(len(column), 1 / (1 + np.exp(-model.bias)))
    rows, x = passage_features(column)
    firsts = np.searchsorted(rows, np.arange(len(column)))
    logit = _weights(x, rows, firsts, model.parts)[-1].astype(np.float64)
    return 1 / (1 + np.exp(-np.clip(logit, -60, 60)))


def scorer(model: Model):
    """A column function: :func:`attention_scores` of whole texts (null: empty)."""

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([text], ["text"])
        parts = [attention_scores(model, piece.column("text")) for piece in slices(batch, "text")]
        return pa.array(np.concatenate([*parts, np.zeros(0)]), pa.float64())

    return score


def passage_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(``doc_id``, ``held_out``, ``score``, ``predicted``) for every row of ``docs``.

    Empty and null texts are one passage without words; repeated rows score alike;
    without labels of both kinds every text gets one score; an empty table gives no
    rows; other columns are ignored.
    """
    score = scorer(fit(training_bags(docs, labels)))
    return docs.select(
        F.col("doc_id"), (remainder(F.col("doc_id")) == 0).alias("held_out"), score(F.col("text").cast("string")).alias("score")
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
