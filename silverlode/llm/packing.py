"""Packing along a space-filling curve: neighbouring documents share sequences."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from silverlode.llm.common import store, tidy
from silverlode.llm.tokens import encoder, tokenizer_path
from silverlode.llm.words import mix

TOKENIZER = "byte_bpe_50k.json"
END_ID = 1
SEQUENCE = 2048
DIMENSIONS = 3
BITS = 10


def _projection(size: int) -> np.ndarray:
    """A pseudo-random direction per hashed token id."""
    cells = np.arange(size * DIMENSIONS, dtype=np.uint64)
    return (mix(cells + np.uint64(7)) / 2.0**63 - 1).reshape(size, DIMENSIONS).astype(np.float32)


def hilbert_key(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Positions along the Hilbert curve of integer points (rows) with ``bits`` bits a coordinate.

    Undoes the curve's rotations level by level from the coarsest bit, then reads the
    Gray-coded coordinates bit by bit.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    level = 1 << (bits - 1)
    while level > 1:
        lower = level - 1
        for i in range(n):
            high = (x[i] & level) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & lower)
            x[0] = np.where(high, x[0] ^ lower, x[0] ^ swap)
            if i:
                x[i] ^= swap
        level >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    fix = np.zeros_like(x[0])
    level = 1 << (bits - 1)
    while level > 1:
        fix = np.where(x[n - 1] & level, fix ^ (level - 1), fix)
        level >>= 1
    x ^= fix
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def _tokenise(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        directions = _projection(encoder(path).tokenizer.get_vocab_size())
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            ids = [i + end for i in encode(batch.column("text").to_pylist())]
            means = np.array([directions[np.frombuffer(i, "<u4")[:-1]].sum(0) / max(1, len(i) // 4 - 1) for i in ids], np.float64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("doc_id"),
                    pa.array([len(i) // 4 for i in ids], pa.int64()),
                    *(pa.array(means[:, d], pa.float64()) for d in range(DIMENSIONS)),
                    pa.array([np.frombuffer(i, "<u4").astype("<u2").tobytes() for i in ids], pa.binary()),
                ],
                ["row", "doc_id", "doc_tokens", "x", "y", "z", "ids"],
            )

    return run


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The tokens before each document within its partition."""
    from pyspark import TaskContext

    held, part = 0, TaskContext.get().partitionId()
    for batch in batches:
        sizes = batch.column("doc_tokens").to_numpy()
        before = held + np.cumsum(sizes) - sizes
        held += int(sizes.sum())
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(np.full(len(sizes), part), pa.int32()), pa.array(before, pa.int64()), batch.column("doc_tokens")],
            ["row", "part", "before", "doc_tokens"],
        )


def _cut(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(8)]
            rows = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "place", "doc_tokens", "ids")))
            for doc_id, place, tokens, ids in rows:
                wide = np.frombuffer(ids, "<u2").astype("<u4")
                start = 0
                while start < tokens:
                    sequence, offset = divmod(place + start, size)
                    length = min(tokens - start, size - offset)
                    piece = wide[start : start + length].tobytes()
                    for column, value in zip(out, (doc_id, start, length, zlib.crc32(piece), tokens, sequence, offset, piece)):
                        column.append(value)
                    start += length
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in out[:7]), pa.array(out[7], pa.binary())],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"],
            )

    return run


def pack(docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID, size: int = SEQUENCE) -> DataFrame:
    """Pieces of all documents in full sequences of ``size`` tokens; only the last one can be short.

    Documents are laid end to end in Hilbert order of their projected token vectors
    and cut at every multiple of ``size``.  ``ids`` of a piece are its token ids, four
    bytes each (little-endian), ``ids_crc32`` their checksum.  Null and empty texts are the end id
    alone; repeated rows are packed as often as they occur; ties of the curve follow
    the input order; an empty table gives no rows; other columns are ignored.  The
    vocabulary must stay below 65,536 ids.
    """
    path = tokenizer or tokenizer_path(TOKENIZER)
    coded = store(
        docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .mapInArrow(tidy(_tokenise(path, end_id)), "row long, doc_id long, doc_tokens long, x double, y double, z double, ids binary"),
        "coded",
    )
    axes = ["x", "y", "z"]
    stats = coded.agg(*(f(a).alias(f"{a}{n}") for a in axes for n, f in (("m", F.avg), ("s", F.stddev_pop)))).first().asDict()
    centre = np.array([stats[f"{a}m"] or 0.0 for a in axes])
    scale = np.array([stats[f"{a}s"] or 1.0 for a in axes])

    @F.arrow_udf("long")
    def key(x: pa.Array, y: pa.Array, z: pa.Array) -> pa.Array:
        z_scores = (np.column_stack([x.to_numpy(), y.to_numpy(), z.to_numpy()]) - centre) / scale
        # the logistic curve is close to the normal distribution's: cells hold like counts
        cells = np.clip(2**BITS / (1 + np.exp(-1.702 * z_scores)), 0, 2**BITS - 1)
        return pa.array(hilbert_key(cells.astype(np.int64)), pa.int64())

    order = store(
        coded.select("row", "doc_tokens", key(*axes).alias("key")), "curve"
    ).repartitionByRange("key", "row").sortWithinPartitions("key", "row")
    placed = store(order.mapInArrow(tidy(_running), "row long, part int, before long, doc_tokens long"), "placed")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("part").agg(F.sum("doc_tokens").alias("tokens"))
    parts = store(parts.select("part", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("base")), "parts")
    places = placed.join(parts, "part").select("row", (F.col("base") + F.col("before")).alias("place"))
    return coded.select("row", "doc_id", "doc_tokens", "ids").join(places, "row").select(
        "doc_id", "place", "doc_tokens", "ids"
    ).mapInArrow(
        tidy(_cut(size)),
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary",
    )
