"""Mixing sources to target weights through a multivariate-hypergeometric splitting tree.

Every source is cut into ``BLOCKS`` hash blocks.  Its target fixes how often each block
is drawn: whole passes over all blocks, then one partial pass along a permutation of
them that ends inside one block.  The drawn blocks of all sources are the root's quotas;
each node of the tree gives a random half of its blocks to its left child, so the
quotas of the output shards are exact and distributed as in a full shuffle.  A shard
then takes the next blocks of each source's permutation.  All of it is DataFrame and
SQL expressions; only tables of blocks, never of documents, pass through the tree.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverlode.llm.common import quoted, store, unused

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
BLOCKS = 1024
SHARD_BLOCKS = 256
SEED = 20


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sized: DataFrame) -> DataFrame:
    """(source, source_size, weight, target, s): targets share all words by weight.

    A target stops at ``MOST_REPEATS`` times its source; the excess is shared by the
    others.  In the order of (cap / weight) the sources that stop are the first ones:
    the first source whose share of what is left stays below its cap ends them.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = totals.withColumn("s", F.row_number().over(by_name) - 1)
    weights = F.array(*(F.lit(float(w)) for w in WEIGHTS))
    ranked = ranked.withColumn("weight", F.element_at(weights, (F.col("s") % len(WEIGHTS) + 1).cast("int")))
    cap = F.col("source_size") * float(MOST_REPEATS)
    by_cap = Window.orderBy(cap / F.col("weight"), "s")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    onwards = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    shared = ranked.select(
        "*",
        cap.alias("cap"),
        (
            (F.sum("source_size").over(whole) - F.coalesce(F.sum(cap).over(before), F.lit(0.0))) / F.sum("weight").over(onwards)
        ).alias("share"),
    )
    free = F.col("share") * F.col("weight") <= F.col("cap")
    level = shared.withColumn("level", F.min(F.when(free, F.struct(F.col("cap") / F.col("weight"), F.col("s"), F.col("share")))).over(whole)["share"])
    return level.select(
        "source", "source_size", "weight", "s", F.least(F.coalesce(F.col("level") * F.col("weight"), F.col("cap")), F.col("cap")).alias("target")
    )


def _hypergeometric(n_all: str, marked: str, drawn: str, uniform: str) -> str:
    """SQL for the number of marked items among ``drawn`` of ``n_all``, by inversion of ``uniform``.

    Probabilities come from their ratios to the mode's, first upwards, then downwards;
    values 12 deviations and more away lie below double precision and are left out.
    """
    weight = (
        "case when k = p.m then 1D"
        " when k > p.m then a.w * (p.q - k + 1) * (p.d - k + 1) / (k * (p.n - p.q - p.d + k))"
        " else if(k = p.m - 1, 1D, a.w) * (k + 1) * (p.n - p.q - p.d + k + 1) / ((p.q - k) * (p.d - k)) end"
    )
    values = (
        "concat(transform(sequence(0, cast(least(p.q, p.d, p.m + p.r) - p.m as int)), i -> cast(p.m + i as double)),"
        " transform(filter(sequence(0, cast(p.m - greatest(0D, p.q + p.d - p.n, p.m - p.r) as int)), i -> i > 0),"
        " i -> cast(p.m - i as double)))"
    )
    total = (
        f"aggregate({values}, named_struct('w', 0D, 't', 0D), (a, k) -> named_struct('w', {weight}, 't', a.t + {weight}), a -> a.t)"
    )
    pick = (
        f"aggregate({values}, named_struct('w', 0D, 't', 0D, 'k', -1D), (a, k) -> if(a.k >= 0, a,"
        f" named_struct('w', {weight}, 't', a.t + {weight}, 'k', if(a.t + {weight} >= p.u * total, k, -1D))), a -> if(a.k < 0, p.m, a.k))"
    )
    bound = (
        f"named_struct('n', {n_all}, 'q', {marked}, 'd', {drawn}, 'u', {uniform},"
        f" 'm', cast(floor(({drawn} + 1) * ({marked} + 1) / ({n_all} + 2)) as double),"
        f" 'r', cast(ceil(12 * sqrt({drawn} * {marked} / {n_all} * (1 - {marked} / {n_all}) * ({n_all} - {drawn}) / greatest({n_all} - 1, 1D))) + 3 as double))"
    )
    inner = f"transform(array({total}), total -> {pick})[0]"
    return f"if({n_all} <= 0 or {marked} <= 0 or {drawn} <= 0, 0D, transform(array({bound}), p -> {inner})[0])"


def split_quotas(quotas: DataFrame, levels: int) -> DataFrame:
    """(shard, s, quota) from (s, quota): the leaves of ``levels`` random halvings."""
    root = quotas.where("quota > 0").agg(
        F.array_sort(F.collect_list(F.struct("s", F.col("quota").cast("double").alias("q")))).alias("items")
    ).select(F.lit(1).cast("long").alias("node"), "items")
    uniform = f"(pmod(xxhash64(node, x.s, {SEED}), 9007199254740992) + 0.5D) / 9007199254740992D"
    child = "array<struct<s:int,q:double>>"
    draw = _hypergeometric("a.n", "x.q", "a.d", uniform)
    halves = f"""
        aggregate(items,
            named_struct('n', aggregate(items, 0D, (t, x) -> t + x.q), 'd', floor(aggregate(items, 0D, (t, x) -> t + x.q) / 2) * 1D,
                'l', cast(array() as {child}), 'r', cast(array() as {child})),
            (a, x) -> transform(array({draw}), k -> named_struct('n', a.n - x.q, 'd', a.d - k,
                'l', if(k > 0, concat(a.l, array(named_struct('s', x.s, 'q', k))), a.l),
                'r', if(x.q > k, concat(a.r, array(named_struct('s', x.s, 'q', x.q - k))), a.r)))[0])"""
    tree = root
    for _ in range(levels):
        tree = tree.select("node", F.expr(halves).alias("h")).select(
            F.explode(F.array(F.struct((F.col("node") * 2).alias("node"), F.col("h.l").alias("items")),
                              F.struct((F.col("node") * 2 + 1).alias("node"), F.col("h.r").alias("items")))).alias("c")
        ).select("c.node", "c.items")
    return tree.select((F.col("node") - 2**levels).cast("int").alias("shard"), F.explode("items").alias("i")).select(
        "shard", F.col("i.s").alias("s"), F.col("i.q").cast("long").alias("quota")
    )


def _block(doc_id: str = "doc_id") -> Column:
    return F.pmod(F.xxhash64(doc_id, F.lit(SEED)), F.lit(BLOCKS)).cast("int")


def _place(doc_id: str = "doc_id") -> Column:
    """The order of documents within their block."""
    return F.xxhash64(doc_id, F.lit(SEED + 1))


def plan_mix(sized: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(targets, draws) for (doc_id, source, size) rows.

    ``draws`` has per source number ``s`` and block the array ``draws`` of (pass, shard,
    upto); a draw takes the block's documents whose place is at most ``upto`` (null: all).
    """
    targets = store(source_targets(sized), "targets")
    placed = sized.join(targets.select(F.col("source").alias("_source"), "s"), F.expr("source <=> _source"))
    blocks = store(placed.groupBy("s", _block().alias("block")).agg(F.sum("size").alias("words")), "blocks")

    share = targets.select(
        "s",
        F.expr(f"case when source_size = 0 then {MOST_REPEATS} else cast(floor(target / source_size) as int) end").alias("passes"),
        F.expr("greatest(0D, target - floor(try_divide(target, cast(source_size as double))) * source_size)").alias("rest"),
    )
    # The partial pass: blocks in permuted order up to the rest; the last one in part.
    along = Window.partitionBy("s").orderBy(F.xxhash64("s", "block", "passes"), "block")
    partial = blocks.join(share, "s").where("rest > 0").withColumn("end", F.sum("words").over(along)).where("end - words < rest")
    whole_passes = blocks.join(share.where("passes > 0"), "s").select("s", "block", F.explode(F.expr("sequence(0, passes - 1)")).alias("pass"))
    edge = store(partial.where("end > rest").select("s", "block", F.expr("rest - (end - words)").alias("left")), "edges")
    inside = Window.partitionBy("s").orderBy("place")
    cut = (
        placed.select("s", "size", _block().alias("block"), _place().alias("place"))
        .join(edge, ["s", "block"])
        .withColumn("end", F.sum("size").over(inside))
        .where("end - size / 2D <= left")
        .groupBy("s", "block")
        .agg(F.max("place").alias("upto"))
    )
    partial = partial.select("s", "block", F.col("passes").alias("pass"), F.expr("end > rest").alias("cut"))
    partial = partial.join(cut, ["s", "block"], "left").where("not cut or upto is not null").drop("cut")
    drawn = store(whole_passes.withColumn("upto", F.lit(None).cast("long")).unionByName(partial), "drawn")

    quotas = drawn.groupBy("s").agg(F.count(F.lit(1)).alias("quota"))
    total = quotas.agg(F.sum("quota")).first()[0] or 0
    levels = max(0, math.ceil(math.log2(max(1, total / SHARD_BLOCKS))))
    leaves = store(split_quotas(quotas, levels), "leaves")
    before = Window.partitionBy("s").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    taken = leaves.withColumn("begin", F.coalesce(F.sum("quota").over(before), F.lit(0)))
    taken = taken.select("s", "shard", F.explode(F.expr("sequence(begin, begin + quota - 1)")).alias("turn"))
    order = Window.partitionBy("s").orderBy("pass", F.xxhash64("s", "block", "pass"), "block")
    turns = drawn.withColumn("turn", (F.row_number().over(order) - 1).cast("long"))
    draws = turns.join(taken, ["s", "turn"]).groupBy("s", "block").agg(
        F.array_sort(F.collect_list(F.struct("pass", "shard", "upto"))).alias("draws")
    )
    return targets, store(draws, "draws")


def _assigned(rows: DataFrame, targets: DataFrame, draws: DataFrame, name: str) -> DataFrame:
    """``rows`` (with doc_id and source) plus ``name``: target, source size and the shards of its copies."""
    d, t, n, block, found = unused(rows, "_d", "_t", "_s", "_block", "_draws")
    named = targets.select(F.struct("source", "source_size", "target", "s").alias(t))
    drawn = draws.select(F.col("s").alias(n), F.col("block").alias(block), F.col("draws").alias(found))
    joined = rows.alias(d).join(named, F.expr(f"{d}.source <=> {t}.source")).join(
        drawn, (F.col(f"{t}.s") == F.col(n)) & (_block(f"{d}.doc_id") == F.col(block)), "left"
    )
    taken = F.filter(found, lambda x: x["upto"].isNull() | (_place(f"{d}.doc_id") <= x["upto"]))
    shards = F.coalesce(F.transform(taken, lambda x: x["shard"]), F.array().cast("array<int>"))
    mixed = F.struct(f"{t}.source_size", f"{t}.target", shards.alias("shards")).alias(name)
    return joined.select(*(f"{d}.{c}" for c in quoted(rows.columns)), mixed)


def _sizes(docs: DataFrame) -> DataFrame:
    return store(docs.select("doc_id", "source", word_count(F.col("text").cast("string")).alias("size")), "sizes")


def mixing_plan(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target, taken and the shards of its copies.

    Sizes are words (null text: 0).  Null sources are one source, last in order; rows of
    one ``doc_id`` and source are drawn alike; documents without words are drawn with
    their block; an empty table gives no rows; other columns are ignored.
    """
    sized = _sizes(docs)
    planned = _assigned(sized, *plan_mix(sized), "_mix")
    return planned.select(
        "doc_id", "size", "_mix.source_size", "_mix.target", (F.col("size") * F.size("_mix.shards")).alias("taken"), "_mix.shards"
    )


def mix(docs: DataFrame) -> DataFrame:
    """The mixed rows: every drawn copy of a document, by shard and shuffled within its shard.

    Rows are dealt by ranges of (shard, random order), so a shard larger than a task's
    share is spread over several tasks.
    """
    plan, shard, copy, order = unused(docs, "_mix", "_shard", "_copy", "_order")
    planned = _assigned(docs, *plan_mix(_sizes(docs)), plan)
    copies = planned.select(*quoted(docs.columns), F.posexplode(f"{plan}.shards").alias(copy, shard))
    copies = copies.withColumn(order, F.xxhash64("doc_id", copy, F.lit(SEED)))
    shuffled = copies.repartitionByRange(shard, order).sortWithinPartitions(shard, order)
    return shuffled.select(*quoted(docs.columns))
