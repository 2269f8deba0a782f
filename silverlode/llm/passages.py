"""Fuzzy repeated passages by collinear chaining of shared k-mer seeds.

Seeds are word k-mers picked by winnowing, in two lengths.  Short ones find edited copies:
any shared run of ``KMER + WINDOW - 1`` words shares one.  Long ones find copies whose
short seeds all stand somewhere else before: any shared run of 40 words shares one.  Each
place of a seed is joined to the first place in the first document that holds it; matches
with one earlier document are chained by a Fenwick tree with gap costs, and chains are
aligned word by word.  A chain counts by itself: only a stretch of ``LEAST_WORDS`` words
aligned with one earlier document is a passage, never a patchwork of shorter stretches of
several.

The first holder of a long seed may go on otherwise than a later one, so places whose
words around the seed are not those of the first holder are joined further: to the first
place with the same words around it, and, for the first such place, by each run of
``LEAST_WORDS`` words around the seed to the first holder of that run.  So every run of
``LEAST_WORDS`` equal words is found, whoever holds parts of it before, and the work
stays in proportion to the places.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain as chain_of

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from silverlode.llm.common import keyed_groups, quoted, store, tidy, unused
from silverlode.llm.words import Words, mix, shingles, slices

KMER = 5
WINDOW = 12
LONG_KMER, LONG_WINDOW = 20, 21
LEAST_WORDS = 40
# Words beside a long seed that a run of LEAST_WORDS words around it can have on one side.
REACH = LEAST_WORDS - LONG_KMER
MOST_GAP = 40
# Two seeds up to MOST_GAP words apart in both texts still gain by being chained.
GAP_COST = KMER / (2 * MOST_GAP)
# Words read on both sides of a chain, for its extension: no long seed can hide a longer run.
MARGIN = LONG_KMER + LONG_WINDOW
# Words from the first to the last short seed of a passage, at least.
SHORTEST = LEAST_WORDS - KMER - 2 * (WINDOW - 1)
# Alignment bridges a gap if its edits are at most this share of the words on both sides.
EDIT_SHARE = 0.2
# Rows that are joined to the first places of their seeds at once.
MATCHED_AT_ONCE = 32_000
# Chains whose ranges of one text are cut at once.
SLICE = 1 << 16
# Covered stretches at most this far apart are one passage.
SLACK = 3


def least_of_windows(values: np.ndarray, window: int) -> np.ndarray:
    """Position of the first least value of every window; windows double in width, two overlapping ones give the last."""
    least, at, width = values, np.arange(len(values)), 1
    while width < window:
        step = min(width, window - width)
        left, right = least[:-step], least[step:]
        at = np.where(right < left, at[step:], at[:-step])
        least = np.minimum(left, right)
        width += step
    return at


def winnow(kmers: np.ndarray, window: int, begin: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions of the least k-mer of every window of texts that stand in one row.

    The windows of a text start at ``begin`` and the ``counts - 1`` places behind it.
    """
    starts = np.repeat(begin - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
    at = least_of_windows(kmers, window)[starts]
    return at[np.concatenate([[True], at[1:] != at[:-1]])]


def around(padded: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A hash of the words in which runs of ``LEAST_WORDS`` words around long seeds at ``at`` can lie.

    ``padded`` are the long k-mers of texts with ``REACH`` empty words before and behind
    each, so where one begins or ends is part of the hash.
    """
    return mix(mix(mix(padded[at]) + padded[at + REACH]) + padded[at + 2 * REACH])


def _seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, "text"):
            words = Words(piece.column("text"), lower=True)
            counts = words.counts()
            rows = np.flatnonzero(counts >= LEAST_WORDS)
            if not len(rows):
                continue
            counts, before = counts[rows], words.first[rows]
            # All long enough texts in a row, with empty words around each: text i begins at begin[i].
            begin = np.cumsum(counts + 2 * REACH) - counts - REACH
            own = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            padded = np.zeros(begin[-1] + counts[-1] + REACH, np.uint64)
            padded[np.repeat(begin, counts) + own] = words.hashes()[np.repeat(before, counts) + own]
            ids = piece.column("doc_id").to_numpy()[rows]
            for size, window in ((KMER, WINDOW), (LONG_KMER, LONG_WINDOW)):
                kmers = shingles(padded, size)
                at = winnow(kmers, window, begin, counts - size - window + 2)
                text = np.searchsorted(begin, at, "right") - 1
                contexts = pa.array(around(kmers, at - REACH).view(np.int64)) if size == LONG_KMER else pa.nulls(len(at), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[text]), pa.array(kmers[at].view(np.int64)), pa.array((at - begin[text]).astype(np.int32)), contexts],
                    ["doc_id", "seed", "pos", "context"],
                )


def _matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of seeds, sorted by seed, document and place, joined to the seed's first one.

    Kept are the places in later documents and, if a seed has more than two, those that go
    on otherwise than the first one; these keep ``seed`` and ``context``.  Of a seed that
    goes on in the next rows only its first place is held, once it is known to have
    three places and two documents.
    """
    open_seed, held, fresh = None, [], 0
    for batch in chain_of(batches, [None]):
        if batch is not None:
            held.append(batch)
            fresh += batch.num_rows
            if fresh < MATCHED_AT_ONCE:
                continue
        if not held or not sum(b.num_rows for b in held):
            continue
        rows = pa.Table.from_batches(held).combine_chunks()
        doc, seed, pos = (rows.column(c).to_numpy() for c in ("doc_id", "seed", "pos"))
        long = rows.column("context").is_valid().to_numpy()
        context = pc.fill_null(rows.column("context"), 0).to_numpy()
        start = np.flatnonzero(np.concatenate([[True], seed[1:] != seed[:-1]]))
        counts = np.diff(np.append(start, len(seed)))
        other, other_pos, usual, comparable = doc[start], pos[start], context[start], long[start]
        many = counts > 2
        if open_seed is not None and open_seed[0] == seed[0]:
            other[0], other_pos[0], usual[0], comparable[0], many[0] = *open_seed[1:], True
        several = doc[start + counts - 1] > other
        open_seed, held, fresh, groups = None, [], 0, len(start)
        if batch is not None:
            if many[-1] and several[-1]:
                open_seed = seed[-1], other[-1], other_pos[-1], usual[-1], comparable[-1]
            else:
                held, groups = rows.slice(start[-1]).to_batches(), groups - 1
        of = np.repeat(np.arange(groups), counts[:groups])
        doc, seed, pos, long, context = (c[: len(of)] for c in (doc, seed, pos, long, context))
        further = (several & many & comparable)[of] & long & (context != usual[of])
        later = doc > other[of]
        kept = np.flatnonzero(later | further)
        if len(kept):
            of, plain = of[kept], ~further[kept]
            columns = [doc[kept], other[of], pos[kept], other_pos[of], long[kept]]
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, columns), pa.array(seed[kept], mask=plain), pa.array(context[kept], mask=plain)],
                ["doc_id", "other", "pos", "other_pos", "long", "seed", "context"],
            )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every run of ``LEAST_WORDS`` words around the long seeds at ``places``, with the seed's place in it."""
    for batch in batches:
        for piece in slices(batch, "text"):
            words = Words(piece.column("text"), lower=True)
            hashes = words.hashes()
            docs, runs, places, shifts = [], [], [], []
            for doc_id, at, a, b in zip(
                piece.column("doc_id").to_pylist(), piece.column("places").to_pylist(), words.first[:-1], words.first[1:]
            ):
                if b - a < LEAST_WORDS:  # a row of the same id with another text
                    continue
                found = shingles(hashes[a:b], LEAST_WORDS)
                place = np.repeat(np.array(at, np.int64), REACH + 1)
                shift = np.tile(np.arange(REACH + 1), len(at))
                held = (place - shift >= 0) & (place - shift < len(found))
                place, shift = place[held], shift[held]
                docs.append(np.full(len(place), doc_id))
                runs.append(found[place - shift].view(np.int64)), places.append(place), shifts.append(shift)
            if docs:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(docs), pa.int64()),
                        pa.array(np.concatenate(runs)),
                        pa.array(np.concatenate(shifts).astype(np.int32)),
                        pa.array(np.concatenate(places).astype(np.int32)),
                    ],
                    ["doc_id", "run", "shift", "pos"],
                )


def chain(x: np.ndarray, y: np.ndarray) -> list[list[int]]:
    """Chains of matches (``x[i]``, ``y[i]``), as index lists, best first; each match is in one chain.

    The score of a chain is ``KMER`` per match minus ``GAP_COST`` per word stepped in
    either text.  That cost splits into a part of each match, so the best predecessor
    with smaller x and y is a prefix maximum in a Fenwick tree over y.
    """
    order = np.lexsort((-y, x))
    ranks = np.unique(y, return_inverse=True)[1] + 1
    size = int(ranks.max())
    best_value, best_index = [-1e18] * (size + 1), [-1] * (size + 1)
    score, parent = [0.0] * len(x), [-1] * len(x)
    xs, ys, rs = x.tolist(), y.tolist(), ranks.tolist()
    for i in order.tolist():
        value, index, k = -1e18, -1, rs[i] - 1
        while k > 0:
            if best_value[k] > value:
                value, index = best_value[k], best_index[k]
            k -= k & -k
        here = GAP_COST * (xs[i] + ys[i])
        gain = value - here
        score[i] = KMER + max(0.0, gain)
        if gain > 0 and xs[index] < xs[i]:
            parent[i] = index
        else:
            score[i] = float(KMER)
        value, k = score[i] + here, rs[i]
        while k <= size:
            if value > best_value[k]:
                best_value[k], best_index[k] = value, i
            k += k & -k
    used = [False] * len(x)
    chains = []
    for i in sorted(range(len(x)), key=lambda i: (-score[i], i)):
        found = []
        while i >= 0 and not used[i]:
            used[i] = True
            found.append(i)
            i = parent[i]
        if found:
            chains.append(found[::-1])
    return chains


def _split_at_gaps(places: list[int], x: list[int], y: list[int]) -> Iterator[list[int]]:
    """A chain in parts at its wide gaps; equal steps in both texts stay together, as equal runs may fill them."""
    begin = 0
    for k in range(1, len(places)):
        i, j = places[k - 1], places[k]
        step_x, step_y = x[j] - x[i], y[j] - y[i]
        if (step_x > MOST_GAP or step_y > MOST_GAP) and step_x != step_y:
            yield places[begin:k]
            begin = k
    yield places[begin:]


def _merged(spans: list[tuple[int, int]], slack: int) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1] + slack:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _whole_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of rows sorted by document, each with all rows of its documents."""
    held, fresh = [], 0
    for batch in batches:
        held.append(batch)
        fresh += batch.num_rows
        if fresh >= MATCHED_AT_ONCE:
            rows = pa.Table.from_batches(held).combine_chunks()
            ids = rows.column("doc_id").to_numpy()
            cut = int(np.searchsorted(ids, ids[-1]))
            if cut:
                yield rows.slice(0, cut)
            held, fresh = rows.slice(cut).to_batches(), 0
    if any(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks()


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Rows that differ from the one before in some column; the first one too."""
    changed = np.ones(len(columns[0]), bool)
    changed[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(changed)


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "other", "xs", "ys"]
    for table in _whole_documents(batches):
        doc, other, x, y, long = (table.column(c).to_numpy() for c in ("doc_id", "other", "pos", "other_pos", "long"))
        start = _changes(doc, other)
        counts = np.diff(np.append(start, len(doc)))
        # Without a further seed an equal run goes on for WINDOW - 1 words at most, so short
        # seeds closer together cannot be those of a passage, unless a long one is with them.
        hopeful = np.logical_or.reduceat(long, start) | (x[start + counts - 1] - x[start] >= SHORTEST)
        if not hopeful.any():
            continue
        doc, other = doc[start], other[start]
        rows = np.flatnonzero(np.repeat(hopeful, counts))
        group = np.repeat(np.arange(len(start)), counts)[rows]
        x, y, long = x[rows], y[rows], long[rows]
        order = np.lexsort((y, x, group))
        group, x, y, long = group[order], x[order], y[order], long[order]
        place = _changes(group, x, y)
        group, x, y, long = group[place], x[place], y[place], np.logical_or.reduceat(long, place)
        place = _changes(group, x)
        wide = np.repeat(np.logical_or.reduceat(long, place), np.diff(np.append(place, len(x))))
        start = _changes(group)
        counts = np.diff(np.append(start, len(x)))
        # Copies have all matches on one diagonal: their chain is the row of them.
        shift = y - x
        straight = np.logical_and.reduceat(shift == np.repeat(shift[start], counts), start)
        whole = straight & (np.logical_or.reduceat(wide, start) | (x[start + counts - 1] - x[start] >= SHORTEST))
        if whole.any():
            of, rows = group[start[whole]], np.repeat(whole, counts)
            offsets = pa.array(np.append(0, np.cumsum(counts[whole])).astype(np.int32))
            places = (pa.ListArray.from_arrays(offsets, pa.array(c[rows], pa.int32())) for c in (x, y))
            yield pa.RecordBatch.from_arrays([pa.array(doc[of]), pa.array(other[of]), *places], names)
        found: list[tuple] = []
        for first, count in zip(start[~straight].tolist(), counts[~straight].tolist()):
            one = slice(first, first + count)
            xs, ys, long_at, seen = x[one], y[one], wide[one].tolist(), set()
            listed = xs.tolist(), ys.tolist()
            for places in chain(xs, ys):
                for part in _split_at_gaps(places, *listed):
                    if listed[0][part[-1]] - listed[0][part[0]] < SHORTEST and not any(long_at[i] for i in part):
                        continue
                    a, b = xs[part], ys[part]
                    # A text that repeats itself needs one chain per stretch; repeats of what it covers are found in the text.
                    key = b.tobytes(), (a - a[0]).tobytes()
                    if key not in seen:
                        seen.add(key)
                        found.append((int(doc[group[first]]), int(other[group[first]]), a, b))
        if found:
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(map(list, zip(*found)), kinds)], names)


def _cut_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The word hashes (32 bits) of the wanted ranges of each text."""
    for batch in batches:
        for piece in slices(batch, "text"):
            words = Words(piece.column("text"), lower=True)
            hashes = words.hashes().astype(np.uint32)
            wanted = piece.column("wanted")
            of = np.repeat(np.arange(len(wanted)), pc.list_value_length(wanted).to_numpy())
            ranges = pc.list_flatten(wanted)
            begin, end = (pc.struct_field(ranges, c).to_numpy() for c in ("begin", "end"))
            first, last = words.first[:-1][of] + begin, np.minimum(words.first[:-1][of] + end, words.first[1:][of])
            parts = [hashes[a:b].tobytes() for a, b in zip(first.tolist(), last.tolist())]
            yield pa.RecordBatch.from_arrays(
                [*(pc.struct_field(ranges, c) for c in ("chain", "side", "begin")), pa.array(parts, pa.binary())],
                ["chain", "side", "begin", "words"],
            )


def edit_distance(a: np.ndarray, b: np.ndarray) -> int:
    if not len(a) or not len(b):
        return len(a) + len(b) if not (len(a) and len(b)) else 0
    row = list(range(len(b) + 1))
    other = b.tolist()
    for i, x in enumerate(a.tolist(), 1):
        last, row[0] = row[0], i
        for j, y in enumerate(other, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def _run(a: np.ndarray, b: np.ndarray) -> int:
    """The number of equal leading words."""
    n = min(len(a), len(b))
    unequal = np.flatnonzero(a[:n] != b[:n])
    return int(unequal[0]) if len(unequal) else n


def align(a: np.ndarray, b: np.ndarray, xs: np.ndarray, ys: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of ``a`` that agree with ``b``, from seeds at (``xs``, ``ys``).

    Seeds grow to maximal equal runs; the gap between two runs is bridged if its edit
    distance is small beside them.
    """
    runs: list[list[int]] = []  # start and end in a, start and end in b
    for x, y in zip(xs.tolist(), ys.tolist()):
        if runs and x + KMER <= runs[-1][1] and x - y == runs[-1][1] - runs[-1][3]:
            continue
        low_a, low_b = (runs[-1][1], runs[-1][3]) if runs else (0, 0)
        if x < low_a or y < low_b:
            low_a, low_b = min(x, low_a), min(y, low_b)
        back = _run(a[low_a:x][::-1], b[low_b:y][::-1])
        ahead = _run(a[x:], b[y:])
        if ahead:
            runs.append([x - back, x + ahead, y - back, y + ahead])
    out: list[list[int]] = []
    for run in runs:
        if out:
            last = out[-1]
            gaps = run[0] - last[1], run[2] - last[3]
            near = min(gaps) >= 0 and max(gaps) <= MOST_GAP
            edits = edit_distance(a[last[1] : run[0]], b[last[3] : run[2]]) if near else 10**6
            if edits <= EDIT_SHARE * (run[1] - last[0]):
                last[1], last[3] = run[1], run[3]
                continue
        out.append(list(run))
    return [(r[0], r[1]) for r in out]


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for group in keyed_groups(batches, ["chain"]):
        rows = {r["side"]: r for r in group.to_pylist()}
        if len(rows) < 3:
            continue
        x, y, of = rows[0], rows[1], rows[2]
        a, b = (np.frombuffer(r["words"], np.uint32) for r in (x, y))
        found = align(a, b, np.array(of["xs"]) - x["begin"], np.array(of["ys"]) - y["begin"])
        stretches = _merged([(s + x["begin"], e + x["begin"]) for s, e in found if e - s >= KMER], SLACK)
        found = [(s, e) for s, e in stretches if e - s >= LEAST_WORDS]
        if found:
            n = len(found)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([of["doc_id"]] * n, pa.int64()),
                    pa.array([of["other"]] * n, pa.int64()),
                    pa.array([s for s, _ in found], pa.int64()),
                    pa.array([e for _, e in found], pa.int64()),
                ],
                ["doc_id", "other", "begin", "end"],
            )


def covered_ranges(hashes: np.ndarray, spans: list[dict]) -> list[dict]:
    """Passages of one text from aligned spans: their union, and all repeats of it within the text."""
    covered = np.zeros(len(hashes), bool)
    for span in spans:
        covered[span["begin"] : span["end"]] = True
    if len(hashes) >= KMER and not covered.all():
        kmers = shingles(hashes, KMER)
        whole = np.lib.stride_tricks.sliding_window_view(covered, KMER).all(1)
        again = np.zeros(len(hashes), bool)
        for at in np.flatnonzero(np.isin(kmers, kmers[whole])):
            again[at : at + KMER] = True
        again_edges = np.flatnonzero(np.diff(np.concatenate([[0], again.view(np.int8), [0]])))
        for a, b in zip(again_edges[::2].tolist(), again_edges[1::2].tolist()):
            covered[a:b] |= b - a >= LEAST_WORDS
    edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.view(np.int8), [0]])))
    merged = _merged(list(zip(edges[::2].tolist(), edges[1::2].tolist())), SLACK)
    return [
        {"begin": a, "end": b, "others": sorted({s["other"] for s in spans if s["begin"] < b and s["end"] > a})}
        for a, b in merged
        if b - a >= LEAST_WORDS
    ]


_RANGE = StructType([StructField("begin", LongType()), StructField("end", LongType()), StructField("others", ArrayType(LongType()))])


@F.arrow_udf(ArrayType(_RANGE))
def passages_of(text: pa.Array, spans: pa.Array) -> pa.Array:
    found: list = [None] * len(text)
    rows = pc.indices_nonzero(pc.fill_null(pc.list_value_length(spans), 0))
    words = Words(text.take(rows), lower=True)
    hashes = words.hashes()
    for i, a, b, of in zip(rows.to_pylist(), words.first[:-1], words.first[1:], spans.take(rows).to_pylist()):
        found[i] = covered_ranges(hashes[a:b], of)
    kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("others", pa.list_(pa.int64()))]))
    return pa.array([f or None for f in found], kind)


# Document and place as one decimal: a fixed-width minimum, so the aggregates hash and sort nothing.
_PLACE = "cast(doc_id as decimal(20, 0)) * 4294967296 + pos"


def _other_pos() -> str:
    return "cast(first - cast(other as decimal(20, 0)) * 4294967296 as int) as other_pos"


def _further_matches(docs: DataFrame, places: DataFrame) -> DataFrame:
    """Matches of places of long seeds that go on otherwise than the seed's first holder.

    Each place is joined to the first one with the same ``context``.  The first ones of
    a seed are joined by every run of ``LEAST_WORDS`` words around it.
    """
    first = [F.min("doc_id").alias("other"), F.min(F.expr(_PLACE)).alias("first"), F.max("doc_id").alias("last")]
    usual = store(places.groupBy("seed", "context").agg(*first), "contexts").selectExpr("seed", "context", "other", _other_pos(), "last")
    same = places.select("doc_id", "pos", "seed", "context").join(
        usual.where("last > other").hint("merge"), ["seed", "context"]
    ).where("doc_id > other")

    several = usual.groupBy("seed").agg(F.min("other").alias("least"), F.max("other").alias("most")).where("most > least")
    asked = usual.join(several.hint("merge"), "seed", "left_semi").groupBy(F.col("other").alias("doc_id"))
    asked = store(asked.agg(F.sort_array(F.collect_set("other_pos")).alias("places")), "asked")
    runs = store(docs.join(asked, "doc_id").mapInArrow(tidy(_runs), "doc_id long, run long, shift int, pos int"), "runs")
    holders = runs.groupBy("run", "shift").agg(*first).where("last > other").selectExpr("run", "shift", "other", _other_pos())
    equal = runs.join(holders.hint("merge"), ["run", "shift"]).where("doc_id > other")
    columns = ["doc_id", "other", "pos", "other_pos"]
    return same.select(*columns).union(equal.select(*columns).distinct()).withColumn("long", F.lit(True))


def aligned_spans(docs: DataFrame) -> DataFrame:
    """(``doc_id``, ``spans``): word ranges of ``LEAST_WORDS`` or more aligned with one document of smaller id.

    Every run of ``LEAST_WORDS`` equal words is found; edited copies are found by the seeds
    whose first holder they repeat.  Repeats within one document give nothing by
    themselves; repeated rows of one id are not compared with each other.
    """
    docs = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # One shuffle of the seeds: sorted, each finds its first holder in the rows before it.
    matched = store(
        docs.mapInArrow(tidy(_seeds), "doc_id long, seed long, pos int, context long")
        .repartition("seed")
        .sortWithinPartitions("seed", "doc_id", "pos", "context")
        .mapInArrow(tidy(_matched), "doc_id long, other long, pos int, other_pos int, long boolean, seed long, context long"),
        "matched",
    )
    columns = ["doc_id", "other", "pos", "other_pos", "long"]
    matches = matched.where("doc_id > other").select(*columns).union(_further_matches(docs, matched.where("seed is not null")).select(*columns))
    chains = store(
        matches.repartition("doc_id")
        .sortWithinPartitions("doc_id", "other", "pos")
        .mapInArrow(tidy(_chains), "doc_id long, other long, xs array<int>, ys array<int>")
        .withColumn("chain", F.monotonically_increasing_id()),
        "chains",
    )

    def wanted(side: int, doc: str, at: str) -> DataFrame:
        begin = F.greatest(F.lit(0), F.element_at(at, 1) - MARGIN)
        end = F.element_at(at, -1) + KMER + MARGIN
        return chains.select(
            F.col(doc).alias("doc_id"),
            F.struct("chain", F.lit(side).alias("side"), begin.alias("begin"), end.alias("end")).alias("range"),
        )

    # A text is read once for the chains of one slice of them, at most SLICE, so a list of ranges stays small.
    both = wanted(0, "doc_id", "xs").union(wanted(1, "other", "ys"))
    both = both.groupBy("doc_id", F.expr(f"range.chain div {SLICE}").alias("slice")).agg(F.collect_list("range").alias("wanted"))
    cut = docs.join(both.hint("merge"), "doc_id").select("wanted", "text").mapInArrow(
        tidy(_cut_words), "chain long, side int, begin int, words binary"
    )
    heads = chains.select("chain", F.lit(2).alias("side"), "doc_id", "other", "xs", "ys")
    aligned = store(
        cut.unionByName(heads, allowMissingColumns=True)
        .repartition("chain")
        .sortWithinPartitions("chain", "side")
        .mapInArrow(tidy(_aligned), "doc_id long, other long, begin long, end long"),
        "aligned",
    )
    return aligned.groupBy("doc_id").agg(F.collect_set(F.struct("other", "begin", "end")).alias("spans"))


@F.arrow_udf(StringType())
def without_ranges(text: pa.Array, passages: pa.Array) -> pa.Array:
    """``text`` without the given word ranges and the space behind each (null ranges: unchanged)."""
    rows = pc.indices_nonzero(pc.fill_null(pc.list_value_length(passages), 0))
    words = Words(text.take(rows))
    raw, cut = words.data.tobytes(), []
    for i, ranges in enumerate(passages.take(rows).to_pylist()):
        parts, at, end = [], int(words.offsets[i]), int(words.offsets[i + 1])
        first, last = words.first[i], words.first[i + 1]
        for r in ranges:
            parts.append(raw[at : words.starts[first + r["begin"]]])
            at = words.starts[first + r["end"]] if first + r["end"] < last else end
        cut.append(b"".join([*parts, raw[at:end]]).decode())
    out = text.to_pylist()
    for i, changed in zip(rows.to_pylist(), cut):
        out[i] = changed
    return pa.array(out, pa.string())


def repeated_passages(docs: DataFrame, name: str = "passages") -> DataFrame:
    """``docs`` plus the column ``name``: word ranges that repeat documents of smaller id (null: none).

    ``others`` are the documents a range was aligned with.  Whole texts are compared,
    lower-cased; null, empty and short texts and null ids have no ranges; repeated rows
    have the same; an empty table gives no rows; a column called ``name`` is replaced.
    """
    doc, spans, d = unused(docs, "_span_doc", "_spans", "_d")
    found = store(aligned_spans(docs), "spans").select(F.col("doc_id").alias(doc), F.col("spans").alias(spans))
    joined = docs.drop(name).alias(d).join(found.hint("merge"), F.expr(f"{d}.doc_id = {doc}"), "left")
    columns = quoted(c for c in docs.columns if c != name)
    return joined.select(*(f"{d}.{c}" for c in columns), passages_of(F.col(f"{d}.text").cast("string"), F.col(spans)).alias(name))


def cut_passages(docs: DataFrame, name: str = "passages") -> DataFrame:
    """:func:`repeated_passages` with the ranges cut out of ``text``; a text may become empty, every row stays."""
    found = repeated_passages(docs, name)
    text = without_ranges(F.col("text").cast("string"), F.col(name))
    return found.select(*(text.alias("text") if c == "text" else q for c, q in zip(found.columns, quoted(found.columns))))
