"""Quality rules with thresholds read from quantile sketches per language and source.

The sketch of a ratio is its histogram over logarithmic cells: two sketches merge by
adding counts, so Spark combines them on the map side, and sketches of sources merge
into that of their language and of the corpus.  A quantile is right to half a cell
(0.25 %).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from silverlode.llm.common import quoted, release_memory, store, unused
from silverlode.llm.words import Words, shingles, slices

#: Text bytes whose words are counted together.
PIECE_BYTES = 1_000_000
CELL = math.log(1.005)
#: Fences lie this many spreads outside the quartiles; a spread is the quartile distance,
#: but at least the value given with the ratio.
FENCE = 4.0
#: Groups below this many documents use the sketch of their language, or of all documents.
LEAST_DOCS = 100
#: name: (expression, least spread, low fence too)
RATIOS = {
    "word_length": ("word_chars / n_words", 0.5, True),
    "symbols": ("n_symbols / n_words", 0.05, False),
    "repeated": ("n_repeat_words / n_words", 0.05, False),
    "same_lines": ("n_dup_lines / n_words", 0.02, False),
}
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeat_words(hashes: np.ndarray) -> int:
    """Words inside five-word windows that occur more than once."""
    if len(hashes) < 6:
        return 0
    windows = shingles(hashes, 5)
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(windows), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edges, np.flatnonzero(twice), 1)
    np.add.at(edges, np.flatnonzero(twice) + 5, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def _piece_counts(text: pa.Array) -> pa.StructArray:
    words = Words(text)
    hashes = words.hashes()
    lead = np.concatenate([[0], np.cumsum(words._inside & ((words.data & 0xC0) != 0x80))])
    raw = words.data.tobytes()
    symbols, lines, repeats = [], [], []
    for i, (a, b) in enumerate(zip(words.offsets[:-1], words.offsets[1:])):
        piece = raw[a:b]
        symbols.append(sum(piece.count(c) for c in b"#*$%&|<>"))
        worded = [x for x in piece.split(b"\n") if x.strip()]
        lines.append(len(worded) - len(set(worded)))
        repeats.append(_repeat_words(hashes[words.first[i] : words.first[i + 1]]))
    columns = [words.counts(), np.diff(lead[words.offsets]), symbols, lines, repeats]
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], list(_COUNTS))


def counts(text: pa.Array) -> pa.Array:
    """The base counts of whole texts; null texts have none.

    Texts are counted in small pieces, whose arrays are given back at the end.
    """
    pieces = slices(pa.RecordBatch.from_arrays([text], ["text"]), "text", PIECE_BYTES)
    found = [_piece_counts(piece.column("text")) for piece in pieces]
    release_memory()
    return pa.concat_arrays(found) if found else _piece_counts(text)


text_counts = F.arrow_udf(counts, StructType([StructField(c, LongType()) for c in _COUNTS]))


def _cell(ratio: Column) -> Column:
    """The logarithmic cell of a ratio; zero has a cell of its own, below all others."""
    return F.when(ratio > 0, F.floor(F.ln(ratio) / F.lit(CELL))).otherwise(F.lit(-(10**6))).cast("int")


def _value(cell: Column) -> Column:
    return F.when(cell > -(10**6), F.exp((cell + 0.5) * F.lit(CELL))).otherwise(F.lit(0.0))


def sketches(counted: DataFrame) -> DataFrame:
    """(lang, source, ratio, cell, n): the merged sketches of all documents with ten words or more."""
    long = counted.where("n_words >= 10").select(
        "lang", "source", F.expr("stack({}, {}) as (ratio, value)".format(
            len(RATIOS), ", ".join(f"'{n}', cast({e} as double)" for n, (e, _, _) in RATIOS.items()))),
    )
    return long.groupBy("lang", "source", "ratio", _cell(F.col("value")).alias("cell")).agg(F.count(F.lit(1)).alias("n"))


def quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Per group of ``keys`` and ratio: documents ``docs`` and both quartiles, from merged sketches."""
    merged = sketch.groupBy(*keys, "ratio", "cell").agg(F.sum("n").alias("n"))
    upto = Window.partitionBy(*keys, "ratio").orderBy("cell")
    whole = Window.partitionBy(*keys, "ratio")
    ranked = merged.select(*keys, "ratio", "cell", F.sum("n").over(upto).alias("below"), F.sum("n").over(whole).alias("docs"))
    return ranked.groupBy(*keys, "ratio").agg(
        F.max("docs").alias("docs"),
        _value(F.min(F.when(F.expr("4 * below >= docs"), F.col("cell")))).alias("q1"),
        _value(F.min(F.when(F.expr("4 * below >= 3 * docs"), F.col("cell")))).alias("q3"),
    )


def thresholds(sketch: DataFrame) -> DataFrame:
    """One row per (lang, source): ``<ratio>_low`` and ``<ratio>_high``.

    A group with fewer than ``LEAST_DOCS`` documents takes the fences of its language,
    a language with fewer those of all documents.
    """
    own = quartiles(sketch, ["lang", "source"])
    by_lang = quartiles(sketch, ["lang"]).toDF("l_lang", "l_ratio", "l_docs", "l_q1", "l_q3")
    overall = quartiles(sketch, []).toDF("a_ratio", "a_docs", "a_q1", "a_q3")
    joined = own.join(by_lang, F.expr("lang <=> l_lang and ratio = l_ratio")).join(overall, F.expr("ratio = a_ratio"))

    def pick(q: str) -> Column:
        return F.expr(f"case when docs >= {LEAST_DOCS} then {q} when l_docs >= {LEAST_DOCS} then l_{q} else a_{q} end")

    chosen = joined.select("lang", "source", "ratio", pick("q1").alias("q1"), pick("q3").alias("q3"))
    fences = []
    for name, (_, least, both) in RATIOS.items():
        spread = F.greatest(F.col("q3") - F.col("q1"), F.lit(least)) * FENCE
        low = F.col("q1") - spread if both else F.lit(-1.0)
        fences.append(F.max(F.when(F.col("ratio") == name, low)).alias(f"{name}_low"))
        fences.append(F.max(F.when(F.col("ratio") == name, F.col("q3") + spread)).alias(f"{name}_high"))
    return chosen.groupBy("lang", "source").agg(*fences)


def judge(docs: DataFrame, name: str = "quality") -> DataFrame:
    """``docs`` plus the struct column ``name``: base counts, ``base_failed`` and ``kept``.

    Counts are of whole texts (null: none).  A text of under ten words, or with over a
    fifth of its words in repeated windows, fails the base rules; of the others those
    stay whose ratios lie inside the fences of their language and source.  Null
    languages and sources are groups of their own, repeated rows are judged alike, an
    empty table gives an empty result, and a column called ``name`` is replaced.
    """
    counted = store(docs.withColumn(name, text_counts(F.col("text").cast("string"))), "counted")
    flat = counted.select("lang", "source", f"{name}.*")
    limits = store(thresholds(sketches(flat)), "fences")
    columns = [c for c in counted.columns if c != name]
    fence, d = unused(counted, "_fences", "_d")
    fences = limits.select(F.struct(*limits.columns).alias(fence))
    joined = counted.alias(d).join(
        fences, F.expr(f"{d}.lang <=> {fence}.lang and {d}.source <=> {fence}.source"), "left"
    )
    base_failed = F.expr(f"{name}.n_words < 10 or 100 * {name}.n_repeat_words > 20 * {name}.n_words")
    inside = F.lit(True)
    for ratio, (expression, _, _) in RATIOS.items():
        over = " / ".join(f"{name}.{part}" for part in expression.split(" / "))
        inside = inside & F.expr(
            f"coalesce({name}.n_words > 0 and cast(try_divide({over.replace(' / ', ', ')}) as double) between {fence}.{ratio}_low and {fence}.{ratio}_high, false)"
        )
    verdict = F.struct(f"{name}.*", base_failed.alias("base_failed"), (~base_failed & inside).alias("kept"))
    return joined.select(*(f"{d}.{c}" for c in quoted(columns)), verdict.alias(name))


def reject_low_quality(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns."""
    (name,) = unused(docs, "_quality_verdict")
    return judge(docs, name).where(f"{name}.kept").select(*quoted(docs.columns))
