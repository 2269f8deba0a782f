"""Near-duplicates by improved consistent weighted sampling of TF-IDF word shingles.

1. The document frequency of every shingle is counted: chunks of documents send their
   distinct shingles by ranges of the hash, and get the totals back in the same order.
2. Every document gets consistent weighted samples, grouped into bands; documents with
   equal shingle counts are one class from here on.
3. Classes that share a band are compared by exact weighted Jaccard similarity, in
   blocks of bounded size.  Large bands are compared with a hub first; only members that
   stay outside the band's largest component are compared with all others, again in
   blocks.
4. Links become components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.llm.common import keyed_groups, store, tidy, unused
from silverlode.llm.graph import components
from silverlode.llm.words import Words, mix, shingles, slices

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 16, 4
#: Most documents compared in one group; a larger band is split.
BLOCK = 256
_CELLS = 1 << 16
#: Text bytes of a chunk of documents whose shingles are counted together.
CHUNK_BYTES = 8_000_000
#: Bytes of a hash sent within its range, which fixes further bits.
_KEY_BYTES = 6
#: Document frequencies whose sampling keys are looked up, not computed.
_TABLES = 16


def inverse_frequency(n: np.ndarray, documents: int) -> np.ndarray:
    return np.log1p(documents / n)


def _documents(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The shingles of each text, repeats included."""
    words = Words(batch.column("text"), lower=True)
    hashes = words.hashes()
    for a, b in zip(words.first[:-1], words.first[1:]):
        yield shingles(hashes[a:b], SHINGLE)


def _distinct(values: np.ndarray) -> np.ndarray:
    """In ascending order; a sort is many times faster than the hash table of ``np.unique``."""
    values = np.sort(values)
    return values[np.concatenate([np.ones(min(len(values), 1), bool), values[1:] != values[:-1]])]


# --- document frequencies ---------------------------------------------------------------


def _rows(group: pa.Table, column: str = "text") -> pa.RecordBatch:
    return group.select([column]).combine_chunks().to_batches()[0]


def _chunk_shingles(ranges: int):
    """The distinct shingles of each chunk by range of their hash, ascending, and how many of its texts have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in keyed_groups(batches, ["chunk"]):
            names, n = np.unique(np.concatenate([_distinct(f) for f in _documents(_rows(group))]), return_counts=True)
            if not len(names):
                continue
            place = ((names >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int32)
            starts = np.append(0, np.flatnonzero(np.diff(place)) + 1)
            ends = np.append(starts[1:], len(place))
            keys = names.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_KEY_BYTES]
            counts = n.astype("<u4")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(place[starts]),
                    pa.array(np.full(len(starts), group.column("chunk")[0].as_py(), np.int32)),
                    pa.array([keys[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                    pa.array([counts[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                ],
                ["range", "chunk", "keys", "counts"],
            )

    return run


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per chunk and range: the document frequencies of its shingles, in their order."""
    for group in keyed_groups(batches, ["range"]):
        counts = [np.frombuffer(c, "<u4") for c in group.column("counts").to_pylist()]
        ends = np.cumsum([len(c) for c in counts])
        keys = np.zeros((int(ends[-1]), 8), np.uint8)
        keys[:, :_KEY_BYTES] = np.frombuffer(b"".join(group.column("keys").to_pylist()), np.uint8).reshape(-1, _KEY_BYTES)
        names, inverse = np.unique(keys.view("<u8").ravel(), return_inverse=True)
        total = np.bincount(inverse, weights=np.concatenate(counts)).astype("<u4")[inverse]
        yield pa.RecordBatch.from_arrays(
            [
                _rows(group, "chunk").column(0),
                _rows(group, "range").column(0),
                pa.array([t.tobytes() for t in np.split(total, ends[:-1])], pa.binary()),
            ],
            ["chunk", "range", "frequencies"],
        )


# --- consistent weighted samples --------------------------------------------------------


def _uniform(stream: int) -> np.ndarray:
    x = mix(np.arange(_CELLS, dtype=np.uint64) + np.uint64(stream << 32))
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53


class Sampler:
    """Ioffe's samples: per feature and sample, r and c from Gamma(2, 1) and b uniform.

    The draws come from a table of 2^16 entries picked by a hash of feature and sample
    number; features that fall on one entry are told apart by their hash.
    """

    def __init__(self, samples: int, documents: int):
        self.r = -np.log(_uniform(1) * _uniform(2))
        self.log_c = np.log(-np.log(_uniform(3) * _uniform(4)))
        self.b = _uniform(5)
        self.odd = mix(np.arange(samples, dtype=np.uint64) + np.uint64(99)) | np.uint64(1)
        self.documents = documents
        weights = inverse_frequency(np.arange(1, _TABLES + 1), documents)
        self.tables = np.concatenate([self._keys(np.arange(_CELLS), np.log(w)) for w in weights])

    def _keys(self, cell: np.ndarray, log_weight) -> np.ndarray:
        r, b = self.r[cell], self.b[cell]
        t = np.floor(log_weight / r + b)
        a = (self.log_c[cell] - r * (t - b + 1)).astype(np.float32)
        bits = a.view(np.uint32)
        # order-preserving: flip all bits of negatives, the sign bit of others
        return np.where(bits >> 31, ~bits, bits | np.uint32(1 << 31))

    def sample(self, found: np.ndarray, count: np.ndarray, n: np.ndarray, first: np.ndarray) -> np.ndarray:
        """One key per text and sample, of shingles with their counts and document frequencies.

        Those of a text begin at ``first``; none of the texts is without.  Equal keys mean
        that the same feature won at the same level.
        """
        best = np.empty((len(first), len(self.odd)), np.uint64)
        listed = (count == 1) & (n <= _TABLES)
        other = np.flatnonzero(~listed)
        log_weight = np.log(inverse_frequency(n[other], self.documents) * (1 + np.log(count[other])))
        table = np.where(listed, (n.astype(np.int64) - 1) * _CELLS, 0)
        low = found & np.uint64(0xFFFFFFFF)
        for i, odd in enumerate(self.odd):
            cell = ((found * odd) >> np.uint64(48)).view(np.int64)
            bits = self.tables.take(table + cell, mode="clip")
            if len(other):
                bits[other] = self._keys(cell[other], log_weight)
            keys = bits.astype(np.uint64) << np.uint64(32)
            keys |= low
            best[:, i] = np.minimum.reduceat(keys, first)
        return best


_SIGNED = "doc_id long, one long, two long, bands array<long>, frequencies binary, text string"


def _in_order(values: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """For each value that of ``totals``, which has one entry per distinct value, ascending."""
    order = np.argsort(values)
    values = values[order]
    found = np.empty(len(values), totals.dtype)
    found[order] = totals[np.cumsum(np.concatenate([np.zeros(min(len(values), 1), bool), values[1:] != values[:-1]]))]
    return found


def _signatures(documents: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(BANDS * ROWS, documents)
        spread = mix(np.arange(ROWS, dtype=np.uint64)) | np.uint64(1)
        for group in keyed_groups(batches, ["chunk"]):
            rows = group.filter(pc.is_null(group.column("frequencies")))
            totals = group.filter(pc.is_valid(group.column("frequencies"))).column("frequencies").to_pylist()
            totals = np.frombuffer(b"".join(totals), "<u4")
            texts = [np.unique(found, return_counts=True) for found in _documents(_rows(rows))]
            ends = np.cumsum([len(unique) for unique, _ in texts])
            frequency = _in_order(np.concatenate([unique for unique, _ in texts]), totals)
            one, two, bands, frequencies = [], [], [], []
            held: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []

            def sample() -> None:
                """Bands of the texts held back."""
                rows, *parts = zip(*held)
                first = np.cumsum([0, *map(len, parts[0])])[:-1]
                keys = sampler.sample(*map(np.concatenate, parts), first).reshape(-1, BANDS, ROWS)
                for row, found in zip(rows, mix((keys * spread).sum(2)).view(np.int64)):
                    bands[row] = found
                held.clear()

            size = 0
            for row, ((unique, count), n) in enumerate(zip(texts, np.split(frequency, ends[:-1]))):
                if not len(unique):
                    one.append(None), two.append(None), bands.append(None), frequencies.append(None)
                    continue
                marked = mix(unique + np.uint64(31) * count.astype(np.uint64))
                one.append(int(np.bitwise_xor.reduce(marked).view(np.int64)))
                two.append(int(marked.sum().view(np.int64)))
                bands.append(None)
                frequencies.append(n.tobytes())
                held.append((row, unique, count, n))
                size += len(unique)
                if size >= _CELLS:
                    sample()
                    size = 0
            if held:
                sample()
            yield pa.RecordBatch.from_arrays(
                [
                    _rows(rows, "doc_id").column(0), pa.array(one, pa.int64()), pa.array(two, pa.int64()),
                    pa.array(bands, pa.list_(pa.int64())), pa.array(frequencies, pa.binary()), _rows(rows).column(0),
                ],
                [c.split()[0] for c in _SIGNED.split(", ")],
            )

    return run


def signatures(docs: DataFrame) -> tuple[DataFrame, int]:
    """The texts of ``docs`` with class, bands and document frequencies of their distinct shingles, and the number of texts with words.

    Texts meet their chunk's frequencies by chunk, so nothing is held beyond a chunk or a
    range, of which there are as many as the texts need.
    """
    size, documents = docs.agg(
        F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count_if(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    ).first()
    chunks = size // CHUNK_BYTES + 1
    placed = docs.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int"))
    sent = (
        placed.select("chunk", "text").repartition("chunk").sortWithinPartitions("chunk")
        .mapInArrow(tidy(_chunk_shingles(chunks)), "range int, chunk int, keys binary, counts binary")
    )
    frequencies = store(
        sent.repartition("range").sortWithinPartitions("range").mapInArrow(tidy(_totals), "chunk int, range int, frequencies binary"),
        "frequencies",
    )
    both = placed.withColumn("range", F.lit(-1)).unionByName(frequencies, allowMissingColumns=True)
    signed = both.repartition("chunk").sortWithinPartitions("chunk", "range").mapInArrow(tidy(_signatures(documents)), _SIGNED)
    return store(signed, "signatures"), documents


# --- verification -----------------------------------------------------------------------


def _expanded(found: np.ndarray, n: np.ndarray, documents: int) -> tuple[np.ndarray, np.ndarray]:
    """A multiset as a set: the j-th occurrence of a shingle is a feature of its own.

    ``n`` are the document frequencies of the distinct shingles, ascending.  A feature's weight is the gain of ``1 + ln(count)`` from count j - 1 to j, so the weight two
    sets share is the sum of the lesser TF-IDF weights.
    """
    found = np.sort(found)
    fresh = np.concatenate([[True], found[1:] != found[:-1]])
    begin = np.flatnonzero(fresh)
    turn = np.arange(len(found)) - np.repeat(begin, np.diff(np.append(begin, len(found))))
    gain = np.where(turn > 0, np.log1p(1 / np.maximum(turn, 1)), 1.0)
    weight = inverse_frequency(n, documents)[np.cumsum(fresh) - 1]
    return mix(found + turn.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), weight * gain


def similar_pairs(sets: list[tuple[np.ndarray, np.ndarray]], least: float = SIMILARITY) -> np.ndarray:
    """A boolean matrix: which weighted sets have Jaccard similarity ``least`` or more."""
    n = len(sets)
    total = np.array([w.sum() for _, w in sets])
    row = np.repeat(np.arange(n), [len(f) for f, _ in sets])
    names, column, count = np.unique(np.concatenate([f for f, _ in sets]), return_inverse=True, return_counts=True)
    weight = np.concatenate([w for _, w in sets])
    shared = count[column] > 1
    row, weight = row[shared], weight[shared]
    column = np.cumsum(count > 1)[column[shared]] - 1
    both = np.zeros((n, n))
    order = np.argsort(column, kind="stable")
    row, column, weight = row[order], column[order], weight[order]
    columns = int(column[-1]) + 1 if len(column) else 0
    width = min(8192, columns)
    for start in range(0, columns, 8192):
        a, b = np.searchsorted(column, [start, start + width])
        dense = np.zeros((n, width))
        dense[row[a:b], column[a:b] - start] = np.sqrt(weight[a:b])
        both += dense @ dense.T
    return both >= (least - 1e-9) * (total[:, None] + total[None, :] - both)


def _links(documents: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in keyed_groups(batches, ["bucket", "block"]):
            nodes, index = np.unique(group.column("node").to_numpy(), return_index=True)
            if len(nodes) < 2:
                continue
            rows = group.select(["text", "frequencies"]).take(pa.array(index)).combine_chunks().to_batches()[0]
            counted = [np.frombuffer(n, "<u4") for n in rows.column("frequencies").to_pylist()]
            sets = [_expanded(found, n, documents) for found, n in zip(_documents(rows), counted)]
            near = similar_pairs(sets)
            root = np.arange(len(nodes))
            while True:  # the smallest similar node, until nothing moves
                lower = np.where(near, root[None, :], len(nodes)).min(1)
                lower = np.minimum(root, lower)
                lower = np.minimum(lower, lower[lower])
                if (lower == root).all():
                    break
                root = lower
            linked = root != np.arange(len(nodes))
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes[linked]), pa.array(nodes[root[linked]])], ["u", "v"]
            )

    return run


def _compare(groups: DataFrame, texts: DataFrame, documents: int, label: str) -> DataFrame:
    """Links within each (bucket, block) of ``groups``: each node to its local component's smallest."""
    return store(
        # Both sides grow with the input: never broadcast, at any size.
        groups.join(texts.hint("merge"), "node")
        .repartition("bucket", "block")
        .sortWithinPartitions("bucket", "block")
        .mapInArrow(tidy(_links(documents)), "u long, v long"),
        label,
    )


def _blocked(size: str) -> str:
    return f"cast(ceil({size} / {BLOCK}) as int)"


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(``doc_id``, ``class_id``, ``kept``): the smallest id of each document's near-duplicate class.

    Classes are the components of links with weighted Jaccard similarity of at least
    ``SIMILARITY`` over lower-case five-word shingles; a text of one to four words is
    one shingle.  Texts without words (null, empty, blank) are alone in their class, and
    so are rows with a null ``doc_id`` (class null, kept).  Repeated rows are in one
    class and all of them are kept or not; an empty table gives no rows; other columns
    are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    signed, documents = signatures(docs)
    worded = signed.where("one is not null and doc_id is not null")
    classes = store(worded.groupBy("one", "two").agg(F.min("doc_id").alias("node")), "classes")
    # The row of the class's smallest id has the bands (equal for all of its members).
    nodes = worded.join(classes.select(F.col("node").alias("doc_id")).hint("merge"), "doc_id", "left_semi").select("doc_id", "bands").distinct()
    banded = store(nodes.select(F.col("doc_id").alias("node"), F.posexplode("bands").alias("band", "key")), "bands")

    buckets = banded.groupBy("band", "key").agg(
        F.count(F.lit(1)).alias("size"),
        F.min("node").alias("low"),
        F.bit_xor(F.xxhash64("node")).alias("print_one"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("print_two"),
    )
    # Buckets of the same members are compared once.
    distinct = buckets.where("size > 1").groupBy("size", "low", "print_one", "print_two").agg(F.min(F.struct("band", "key")).alias("b"))
    chosen = store(distinct.select("b.band", "b.key", "size", F.xxhash64("b.band", "b.key").alias("bucket")), "buckets")
    members = store(banded.join(chosen.hint("merge"), ["band", "key"]).select("bucket", "size", "node"), "members")
    # Only texts that are compared are moved, however often they are.
    texts = worded.select(F.col("doc_id").alias("node"), "text", "frequencies")
    texts = store(texts.join(members.select("node").distinct().hint("merge"), "node", "left_semi"), "texts")

    split = F.expr(f"pmod(xxhash64(node, 5), {_blocked('size')})").cast("int")
    groups = members.select("bucket", split.alias("block"), "node")
    large = members.where(F.col("size") > BLOCK)
    has_large = not large.isEmpty()
    if has_large:
        # The member with the most company is compared with every block of its band.
        company = large.groupBy("node").agg(F.sum("size").alias("company"))
        hubs = large.join(company, "node").groupBy("bucket", "size").agg(F.max(F.struct("company", "node")).alias("hub"))
        groups = groups.union(hubs.select("bucket", F.explode(F.sequence(F.lit(0), F.expr(f"{_blocked('size')} - 1"))), "hub.node"))
    links = _compare(groups, texts, documents, "links")
    if has_large:
        links = links.union(_compare(_outsiders(large, links), texts, documents, "more-links"))
    roots = components(links)
    found = (
        signed.join(classes.hint("merge"), ["one", "two"], "left")
        .join(roots.hint("merge"), "node", "left")
        .select("doc_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "node", "doc_id")).alias("class_id"))
    )
    return found.withColumn("kept", F.expr("doc_id <=> class_id"))


def _outsiders(large: DataFrame, links: DataFrame) -> DataFrame:
    """Groups that compare members outside a large band's largest component with all its members."""
    roots = components(links)
    placed = store(
        large.join(roots, "node", "left").select("bucket", "size", "node", F.coalesce("root", "node").alias("root")), "placed"
    )
    sizes = placed.groupBy("bucket", "size", "root").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("bucket").agg(
        F.max(F.struct("n", "root")).alias("top"), (F.sum("n") - F.max("n")).alias("outside")
    ).where("outside > 0")
    rows = placed.join(largest, "bucket").selectExpr(
        "bucket", "node", "root <> top.root as out", f"{_blocked('size')} as all_blocks", f"{_blocked('outside')} as out_blocks"
    )
    # A group is a block of outsiders beside a block of all members.
    left = rows.where("out").select(
        "bucket", "node", F.expr("pmod(xxhash64(node, 6), out_blocks)").alias("i"), "all_blocks",
        F.explode(F.expr("sequence(0, all_blocks - 1)")).alias("j"),
    )
    right = rows.select(
        "bucket", "node", F.explode(F.expr("sequence(0, out_blocks - 1)")).alias("i"), "all_blocks",
        F.expr("pmod(xxhash64(node, 5), all_blocks)").alias("j"),
    )
    return left.unionByName(right).select("bucket", F.expr("cast(i * all_blocks + j as int)").alias("block"), "node")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their class; repeated rows become one."""
    found = store(near_duplicates(docs).where("kept").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")), "kept")
    kept = docs.join(found.hint("merge"), docs["doc_id"].eqNullSafe(found["doc_id"]), "left_semi")
    if found.where("n > 1 and doc_id is not null").isEmpty():
        return kept
    (text_hash,) = unused(docs, "_text_hash")
    return kept.withColumn(text_hash, F.xxhash64("text")).dropDuplicates(["doc_id", text_hash]).drop(text_hash)
