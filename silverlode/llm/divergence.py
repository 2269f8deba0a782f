"""Divergence between the sources of a language, by its terms.

Terms are grouped into cells of equal counts: the divergence is evaluated once per cell
and weighed by the cell's number of terms, so its cost follows the number of different
counts.  For the most telling terms the cells of a group are ranked by their cumulative
number of terms, and only the cells that reach the wanted ranks are expanded into terms.
All arithmetic is on whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from silverlode.llm.common import store
from silverlode.llm.terms import PIECE_BYTES, letters_and_wide, runs
from silverlode.llm.words import slices

LEAST_DOCS = 3  # documents of a language that a kept term occurs in, at least
SCALE = 1_000_000_000
TOP_TERMS = 200

_COUNTS = "lang string, source string, term string, n long, docs long"


def _codes(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    coded = column.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per piece of a batch: one row per language, source and term."""
    for batch in batches:
        for piece in slices(batch, "text", PIECE_BYTES):
            found = runs(piece.column("text"), letters_and_wide)
            width = max(len(found.names), 1)
            langs, lang_names = _codes(piece.column("lang"))
            sources, source_names = _codes(piece.column("source"))
            rows, codes, counts = found.per_row()
            group = (langs * len(source_names) + sources)[rows] * width + codes
            order = np.argsort(group, kind="stable")
            keys, first = np.unique(group[order], return_index=True)
            occurrences = np.add.reduceat(counts[order], first) if len(keys) else keys
            groups, codes = np.divmod(keys, width)
            langs, sources = np.divmod(groups, max(len(source_names), 1))
            yield pa.RecordBatch.from_arrays(
                [
                    lang_names.take(pa.array(langs)).cast(pa.string()),
                    source_names.take(pa.array(sources)).cast(pa.string()),
                    found.names.take(pa.array(codes)).cast(pa.string()),
                    pa.array(occurrences, pa.int64()),
                    pa.array(np.diff(np.append(first, len(order))), pa.int64()),
                ],
                ["lang", "source", "term", "n", "docs"],
            )


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term; nulls read as ''."""
    return docs.mapInArrow(_count_batches, _COUNTS).groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")
    )


def kept_counts(counts: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, source, term, n, lang_n) of the terms in at least ``least_docs`` documents of the language."""
    kept = (
        counts.groupBy("lang", "term")
        .agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
        .where(F.col("docs") >= least_docs)
        .select("lang", "term", "lang_n")
    )
    return counts.select("lang", "source", "term", "n").join(kept, ["lang", "term"])


def share(count: str, total: str, terms: str) -> str:
    """SQL of 1 + floor(SCALE * (count + 1) / (total + terms)), exact for every long."""
    return (
        f"1L + (cast({SCALE} as decimal(10, 0)) * cast({count} + 1 as decimal(19, 0)))"
        f" div cast(greatest({total} + {terms}, 1L) as decimal(19, 0))"
    )


def gap(p: str, q: str) -> str:
    """SQL of floor((p - q)^2 / q) for shares ``p`` and ``q`` (longs of at most SCALE + 1)."""
    return f"((({p}) - ({q})) * (({p}) - ({q}))) div ({q})"


def _weighed(weight: str, value: str) -> str:
    return f"sum(cast({weight} as decimal(18, 0)) * cast({value} as decimal(20, 0)))"


def pair_values(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for every ordered pair of sources of a language.

    Terms that one source of a pair lacks are evaluated by the other one's cells alone;
    only terms that both have meet in joint cells, as a correction of these sums:
    f(a, b) - f(a, 0) - f(0, b) + f(0, 0).
    """
    own = groups.selectExpr("lang", "source", "n as total", "held", "terms")
    other = groups.selectExpr("lang", "source as item", "n as item_total", "held as item_held")
    pairs = own.join(other, "lang").where("source <> item")
    shares = pairs.selectExpr(
        "*", f"{share('0L', 'total', 'terms')} as p0", f"{share('0L', 'item_total', 'terms')} as q0"
    )
    base = shares.selectExpr(
        "lang", "source", "item",
        f"cast(terms - held - item_held as decimal(18, 0)) * cast({gap('p0', 'q0')} as decimal(20, 0)) as part",
    )
    cells = kept.groupBy("lang", "source", "n").agg(F.count(F.lit(1)).alias("m"))
    of_source = (
        shares.join(cells, ["lang", "source"])
        .selectExpr("lang", "source", "item", "m", f"{share('n', 'total', 'terms')} as p", "q0")
        .groupBy("lang", "source", "item").agg(F.expr(f"{_weighed('m', gap('p', 'q0'))} as part"))
    )
    of_item = (
        shares.join(cells.withColumnRenamed("source", "item"), ["lang", "item"])
        .selectExpr("lang", "source", "item", "m", f"{share('n', 'item_total', 'terms')} as q", "p0")
        .groupBy("lang", "source", "item").agg(F.expr(f"{_weighed('m', gap('p0', 'q'))} as part"))
    )
    left = kept.selectExpr("lang", "term", "source as a", "n as a_n")
    right = kept.selectExpr("lang", "term", "source as b", "n as b_n")
    joint = (
        left.join(right, ["lang", "term"]).where("a < b")
        .groupBy("lang", "a", "b", "a_n", "b_n").agg(F.count(F.lit(1)).alias("m"))
        .selectExpr("lang", "m", "stack(2, a, b, a_n, b_n, b, a, b_n, a_n) as (source, item, n, item_n)")
    )
    both = (
        joint.join(shares, ["lang", "source", "item"])
        .selectExpr(
            "lang", "source", "item", "m", "p0", "q0",
            f"{share('n', 'total', 'terms')} as p", f"{share('item_n', 'item_total', 'terms')} as q",
        )
        .selectExpr(
            "lang", "source", "item", "m",
            f"{gap('p', 'q')} - {gap('p', 'q0')} - {gap('p0', 'q')} + {gap('p0', 'q0')} as change",
        )
        .groupBy("lang", "source", "item").agg(F.expr(f"{_weighed('m', 'change')} as part"))
    )
    parts = base.union(of_source).union(of_item).union(both)
    return parts.groupBy("lang", "source", "item").agg(F.sum("part").cast("long").alias("value"))


def telling_terms(kept: DataFrame, groups: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, item, value, rank): terms a source uses more than its language, the ``top`` first ranks.

    Equal values are merged and ranked by their cumulative number of terms.  A group keeps
    at most ``top`` values, and those are expanded in UTF-8 order; window limits before the
    shuffles keep a group's part of a task to ``top`` rows.
    """
    sizes = groups.selectExpr("lang", "source", "n as total", "lang_total", "terms")
    cells = (
        kept.groupBy("lang", "source", "n", "lang_n").agg(F.count(F.lit(1)).alias("m"))
        .join(sizes, ["lang", "source"])
        .selectExpr(
            "lang", "source", "n", "lang_n", "m",
            f"{share('n', 'total', 'terms')} as p", f"{share('lang_n', 'lang_total', 'terms')} as q",
        )
        .where("p > q")
        .selectExpr("lang", "source", "n", "lang_n", "m", f"{gap('p', 'q')} as value")
    )
    cells = store(cells, "cells")
    falling = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    values = cells.groupBy("lang", "source", "value").agg(F.sum("m").alias("m"))
    values = values.withColumn("place", F.row_number().over(falling)).where(F.col("place") <= top)
    before = F.sum("m").over(falling.rowsBetween(Window.unboundedPreceding, -1))
    reached = values.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < top)
    wanted = store(cells.drop("m").join(reached.select("lang", "source", "value", "before"), ["lang", "source", "value"]), "wanted")
    terms = kept.join(wanted, ["lang", "source", "n", "lang_n"]).select("lang", "source", "term", "value", "before")
    by_name = Window.partitionBy("lang", "source", "value").orderBy("term")
    ranked = terms.withColumn("place", F.row_number().over(by_name)).where(F.col("place") <= top)
    return ranked.select(
        "lang", "source", F.col("term").alias("item"), "value", (F.col("before") + F.col("place")).cast("int").alias("rank")
    ).where(F.col("rank") <= top)


def source_divergence(docs: DataFrame) -> DataFrame:
    """(lang, source, part, item, value, rank): how each source of a language differs from the others.

    Part ``pair`` ranks the other sources of the language, part ``term`` the 200 terms
    that tell the source most.  Null texts, languages and sources read as '', repeated
    rows count each, a language without kept terms has pairs of value 0, an empty table
    gives no rows, and other columns are ignored.
    """
    named = docs.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    )
    kept = store(kept_counts(store(term_counts(named), "term-counts")), "kept-terms")
    in_lang = kept.select("lang", "term", "lang_n").distinct().groupBy("lang").agg(
        F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total")
    )
    in_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("held"))
    groups = store(
        named.select("lang", "source").distinct().join(in_group, ["lang", "source"], "left").join(in_lang, "lang", "left")
        .na.fill(0, ["n", "held", "terms", "lang_total"]),
        "groups",
    )
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pairs = pair_values(kept, groups).withColumn("rank", rank)
    columns = ("lang", "source", "part", "item", "value", "rank")
    return pairs.withColumn("part", F.lit("pair")).select(*columns).union(
        telling_terms(kept, groups).withColumn("part", F.lit("term")).select(*columns)
    )
