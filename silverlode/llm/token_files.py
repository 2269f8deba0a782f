"""Token files in Simple-8b: word-aligned blocks that decode without a loop over ids.

A file row holds consecutive documents: ``doc_ids``, ``lengths`` (ids per document),
``words`` (64-bit little-endian words) and ``blocks`` (the first word of every
``BLOCK`` ids).  A word's top four bits are its selector; a selector fixes how many
ids of how many bits share the other 60.  Selector 0 is the escape: the next word is
one raw 64-bit value.  The last word of a block may hold fewer ids than its selector
allows.  Rows are stored as Parquet, so any Spark file system can hold them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silverlode.llm.common import store, tidy
from silverlode.llm.tokens import encoder, tokenizer_path
from silverlode.session import scratch_path

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
BLOCK = 256
# Ids gathered before a row is written; a longer document is a row by itself.
ROW_IDS = 131_072
#: Fixed values: (ids, bits) of selectors 15, 14, ... 2.
LAYOUT = ((1, 60), (2, 30), (3, 20), (4, 15), (5, 12), (6, 10), (7, 8), (8, 7), (10, 6), (12, 5), (15, 4), (20, 3), (30, 2), (60, 1))
_FILE_ROW = "part int, row int, n_ids long, doc_ids array<long>, lengths array<long>, blocks array<long>, words binary"


_SMALL_BITS = np.array([v.bit_length() for v in range(1 << 16)], np.uint8)


def _bits(values: np.ndarray) -> np.ndarray:
    if values.max() < len(_SMALL_BITS):
        return _SMALL_BITS[values]
    return np.searchsorted(np.uint64(1) << np.arange(64, dtype=np.uint64), values, "right").astype(np.uint8)


def encode(values: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """``values`` as Simple-8b words and the first word of each block of ``block`` values."""
    values = np.asarray(values, np.uint64)
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    index = np.arange(n)
    end = np.minimum((index // block + 1) * block, n)
    bits = _bits(values)
    # A row per block, filled up with zeros, which fit everywhere.
    square = np.zeros((-(-n // block), block), np.uint8)
    square.ravel()[:n] = bits
    choice = np.zeros(square.shape, np.int8)
    most = int(bits.max())
    for k, (count, width) in enumerate(LAYOUT):
        if most <= width:
            choice[:] = k
            continue
        wide = np.zeros((len(square), block + 1), np.int32)
        np.cumsum(square > width, axis=1, out=wide[:, 1:])
        fits = np.empty(square.shape, bool)
        body = max(0, block + 1 - count)
        fits[:, :body] = wide[:, count:][:, :body] == wide[:, :body]
        fits[:, body:] = wide[:, -1:] == wide[:, body:block]
        if not fits.any():
            break
        choice[fits] = k
    choice = choice.ravel()[:n]
    step = np.minimum(np.array([c for c, _ in LAYOUT])[choice], end - index)
    # All blocks advance together, a word each time.
    at, taken = np.arange(0, n, block), []
    stop = end[at]
    while len(at):
        taken.append(at)
        at = at + step[at]
        going = at < stop
        at, stop = at[going], stop[going]
    first = np.sort(np.concatenate(taken))
    escaped = bits[first] > 60
    place = np.cumsum(1 + escaped) - 1 - escaped
    words = np.zeros(len(first) + int(escaped.sum()), np.uint64)
    words[place[escaped] + 1] = values[first[escaped]]
    for k, (count, width) in enumerate(LAYOUT):
        own = (choice[first] == k) & ~escaped
        begin, to = first[own], end[first[own]]
        word = np.full(len(begin), (15 - k) << 60, np.uint64)
        for j in range(count):
            there = begin + j < to
            word[there] |= values[begin[there] + j] << np.uint64(j * width)
        words[place[own]] = word
    return words, place[np.searchsorted(first, np.arange(0, n, block))]


def decode(words: np.ndarray, blocks: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The ``n`` values behind Simple-8b ``words``."""
    out = np.zeros(n, np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    for i in np.flatnonzero(selector == 0):
        if not raw[i]:
            raw[i + 1] = True
    heads = np.flatnonzero(~raw)
    kind = selector[heads]
    counts = np.array([1, 0, *(c for c, _ in LAYOUT[::-1])])[kind]
    block_of = np.searchsorted(blocks, heads, "right") - 1
    before = np.cumsum(counts) - counts
    begin = before - before[np.searchsorted(heads, blocks)][block_of] + block_of * block
    end = np.minimum((block_of + 1) * block, n)
    escaped = kind == 0
    out[begin[escaped]] = words[heads[escaped] + 1]
    for k, (count, width) in enumerate(LAYOUT):
        own = kind == 15 - k
        word, at, to = words[heads[own]], begin[own], end[own]
        for j in range(count):
            there = at + j < to
            out[at[there] + j] = (word[there] >> np.uint64(j * width)) & np.uint64((1 << width) - 1)
    return out


def _write_rows(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, row = TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<u4").tobytes()
        held: list[tuple[int | None, bytes]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(i for _, i in held), "<u4")
            words, blocks = encode(ids)
            columns = [[part], [row], [len(ids)], [[d for d, _ in held]], [[len(i) // 4 for _, i in held]], [blocks], [words.astype("<u8").tobytes()]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), *[pa.list_(pa.int64())] * 3, pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], [c.split()[0] for c in _FILE_ROW.split(", ")]
            )

        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder(path).encode(batch.column("text").to_pylist())):
                held.append((doc_id, ids + end))
                size += len(ids) // 4 + 1
                if size >= ROW_IDS:
                    yield flush()
                    held, size, row = [], 0, row + 1
        if held:
            yield flush()

    return run


def write_token_files(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID) -> None:
    """Write all texts of ``docs`` (null: empty) in ascending ``doc_id`` order, null ids first.

    Repeated rows are written as often as they occur; an empty table gives an empty
    file set; other columns are ignored.
    """
    ordered = (
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.monotonically_increasing_id().alias("n"))
        .repartitionByRange("doc_id", "n")
        .sortWithinPartitions("doc_id", "n")
    )
    ordered.drop("n").mapInArrow(tidy(_write_rows(tokenizer or tokenizer_path(TOKENIZER), end_id)), _FILE_ROW).write.parquet(path)


def _read_rows(digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_ids, lengths, blocks, words, base in zip(
                *(batch.column(c).to_pylist() for c in ("doc_ids", "lengths", "blocks", "words", "base"))
            ):
                ends = np.cumsum(lengths)
                ids = decode(np.frombuffer(words, "<u8"), np.array(blocks, np.int64), int(ends[-1])).astype("<u4")
                starts = ends - lengths
                parts = [ids[a:b] for a, b in zip(starts, ends)]
                last = (
                    pa.array([zlib.crc32(p) for p in parts], pa.int64()) if digests else pa.array([p.tobytes() for p in parts], pa.binary())
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64()), pa.array(starts + base, pa.int64()), pa.array(lengths, pa.int64()), last],
                    ["doc_id", "start", "n_tokens", "ids_crc32" if digests else "ids"],
                )

    return run


def read_token_files(spark: SparkSession, path: str, digests: bool = False) -> DataFrame:
    """(``doc_id``, ``start``, ``n_tokens``, ``ids``) of a file set; ``ids`` are 32-bit little-endian.

    With ``digests`` their ``ids_crc32`` stands in place of ``ids``.
    """
    rows = spark.read.schema(_FILE_ROW).parquet(path)
    parts = rows.groupBy("part", "row").agg(F.sum("n_ids").alias("n"))
    slices = parts.groupBy("part").agg(F.sum("n").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"))
    bases = store(
        parts.select("part", "row", F.coalesce(F.sum("n").over(within), F.lit(0)).alias("inner"))
        .join(slices, "part")
        .select("part", "row", (F.col("inner") + F.col("earlier")).alias("base")),
        "bases",
    )
    return rows.join(bases, ["part", "row"]).select("doc_ids", "lengths", "blocks", "words", "base").mapInArrow(
        tidy(_read_rows(digests)), "doc_id long, start long, n_tokens long, " + ("ids_crc32 long" if digests else "ids binary")
    )


def round_trip(docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID, digests: bool = False) -> DataFrame:
    """Write ``docs`` to new files in the shared folder and read them back."""
    path = scratch_path(docs.sparkSession, "token-files")
    write_token_files(docs, path, tokenizer, end_id)
    return read_token_files(docs.sparkSession, path, digests)
