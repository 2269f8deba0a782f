"""Keyed tables that grow: hash buckets that split, filters of their keys, loads that appear at once.

Rows lie in buckets by the low bits of their key's hash.  A directory lists the buckets
(extendible hashing: a bucket of depth ``d`` holds the hashes that end in its ``d``
bits), and for each of them its fragments, one folder of files per load that wrote to it:

    directory/v<n>/                 one row per fragment, and one per empty bucket
    rows/<load>/_bucket=<d>-<bits>/  the rows of a fragment
    filters/<load>/                 a Bloom filter per fragment, as (_bucket, block, word) rows

An upsert rewrites the buckets that its keys fall into and no others; a bucket above
``bucket_rows`` is split on the way.  An insert adds fragments and reads only those
fragments whose filter knows one of the new keys.  Rows, filters and directory of a load
are written aside and become visible by one rename of the finished directory folder, so
readers see a load as a whole or not at all, and a crash leaves the last version in place.
One writer at a time.

The driver holds one directory row per fragment, as the listing of a folder does.
"""

from __future__ import annotations

import json
import math
import uuid
from collections import Counter
from collections.abc import Collection, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.operators.keyed import absent_from, merge_rows
from silverlode.operators.numbering import pin
from silverlode.session import path_exists

Bucket = tuple[int, int]
DIRECTORY = "depth INT, bits BIGINT, load STRING, rows BIGINT, blocks BIGINT"
MOST_DEPTH = 40
#: A filter has one 64-bit block for so many keys; every key sets five bits of one block.
KEYS_PER_BLOCK = 4

#: Columns of the table while it is placed; no stored column may have such a name.
RESERVED = {"_hash", "_probe", "_slot", "_depth", "_bits", "_bucket"}
_BUCKET = "concat(_depth, '-', _bits) AS _bucket"


@dataclass(frozen=True)
class Fragment:
    """The rows that one load wrote to one bucket; a bucket without rows has one entry without a load."""

    depth: int
    bits: int
    load: str | None = None
    rows: int = 0
    blocks: int = 0

    @property
    def bucket(self) -> Bucket:
        return self.depth, self.bits

    @property
    def name(self) -> str:
        return f"{self.depth}-{self.bits}"


_START = [Fragment(0, 0)]


def key_mask(column: str) -> str:
    """SQL of the bits that a key (its second hash) sets in its block."""
    bits = [f"shiftleft(1L, cast(shiftright({column}, {6 * i}) & 63 AS INT))" for i in range(5)]
    return "(" + " | ".join(bits) + ")"


def key_block(column: str, blocks: str) -> str:
    """SQL of a key's block; ``blocks`` is a power of two, so filters of equal size merge by OR."""
    return f"(shiftrightunsigned({column}, 30) & ({blocks} - 1))"


class GrowingTable:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType,
        keys: Sequence[str],
        bucket_rows: int = 1_000_000,
        most_fragments: int = 8,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema
        self.keys = list(keys)
        self.bucket_rows = bucket_rows
        self.most_fragments = most_fragments
        if clash := RESERVED & set(schema.names):
            raise ValueError(f"reserved column names: {sorted(clash)}")
        self._names = [f"`{c}`" for c in schema.names]
        quoted = ", ".join(f"`{k}`" for k in self.keys)
        self._hashes = {"_hash": F.expr(f"xxhash64({quoted})"), "_probe": F.expr(f"xxhash64({quoted}, 1)")}

    def _hashed(self, rows: DataFrame) -> DataFrame:
        """``rows`` with both hashes of their keys, which are computed where they are read and never stored or shuffled."""
        return rows.withColumns(self._hashes)

    # --- versions ---------------------------------------------------------------
    def _files(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def version(self) -> int:
        """The version readers see; 0 for a table that was never written."""
        if not path_exists(self.spark, f"{self.root}/directory"):
            return 0
        names = [s.getPath().getName() for s in self._files().listStatus(self._path("directory"))]
        return max((int(n[1:]) for n in names if n.startswith("v")), default=0)

    def directory(self, version: int | None = None) -> list[Fragment]:
        version = self.version() if version is None else version
        if not version:
            return list(_START)
        found = self.spark.read.schema(DIRECTORY).parquet(f"{self.root}/directory/v{version}")
        return [Fragment(*row) for row in found.collect()]

    def _publish(self, directory: list[Fragment]) -> None:
        """Write the directory aside, then make it the next version by one rename."""
        aside = f"aside-{uuid.uuid4().hex}"
        entries = [(f.depth, f.bits, f.load, f.rows, f.blocks) for f in directory]
        self._frame(entries, DIRECTORY).coalesce(1).write.parquet(f"{self.root}/directory/{aside}")
        target = self._path("directory", f"v{self.version() + 1}")
        if not self._files().rename(self._path("directory", aside), target):
            raise OSError(f"could not publish {target}")

    def rows_stored(self) -> int:
        return sum(f.rows for f in self.directory())

    # --- reading ----------------------------------------------------------------
    def _read(self, fragments: Collection[Fragment]) -> DataFrame:
        found = [f"{self.root}/rows/{f.load}/_bucket={f.name}" for f in fragments if f.load]
        if not found:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*found)

    def read(self) -> DataFrame:
        return self._read(self.directory())

    # --- placing ----------------------------------------------------------------
    def _frame(self, entries: list[tuple], schema: str) -> DataFrame:
        """Entries of the directory as rows: small ones as a literal, whose size the planner knows, others as a stored copy."""
        if len(entries) > 10_000:
            return pin(self.spark.createDataFrame(entries, schema), "entries")
        names = [field.split()[0] for field in schema.split(", ")]
        text = json.dumps([dict(zip(names, e)) for e in entries])
        parsed = F.from_json(F.lit(text), f"array<struct<{schema.replace(' ', ': ')}>>".replace(",: ", ", "))
        return self.spark.range(1).select(F.inline(parsed))

    def _placed(self, rows: DataFrame, buckets: Collection[Bucket]) -> DataFrame:
        """``rows`` with the bucket (``_depth``, ``_bits``) that each row's hash falls into; rows of no bucket drop out.

        The buckets are widened to one slot per value of the deepest one's bits, so the
        lookup is an equi-join with a small table.
        """
        deepest = max((depth for depth, _ in buckets), default=0)
        known = self._frame(sorted(buckets), "_depth INT, _bits BIGINT")
        slots = known.selectExpr(
            "_depth", "_bits", f"explode(sequence(_bits, {(1 << deepest) - 1}L, shiftleft(1L, _depth))) AS _slot"
        )
        return rows.withColumn("_slot", F.expr(f"_hash & {(1 << deepest) - 1}L")).join(slots, "_slot").drop("_slot")

    def _counts(self, rows: DataFrame, buckets: Collection[Bucket]) -> dict[Bucket, int]:
        counts = self._placed(rows, buckets).groupBy("_depth", "_bits").agg(F.count(F.lit(1)).alias("n"))
        return {(depth, bits): n for depth, bits, n in counts.collect()}

    def _parts(self, bucket: Bucket, rows: int) -> list[Bucket]:
        """The buckets that a bucket of so many rows is split into; itself if it is not too large."""
        depth, bits = bucket
        cut = 0
        while rows > self.bucket_rows << cut and depth + cut < MOST_DEPTH:
            cut += 1
        return [(depth + cut, bits + (i << depth)) for i in range(1 << cut)]

    def _store(
        self, rows: DataFrame, directory: list[Fragment], rewritten: set[Bucket], counts: dict[Bucket, int] | None = None
    ) -> int:
        """Write ``rows`` as one load and publish it; returns the number of rows of the table.

        ``rewritten`` buckets hold nothing else afterwards and are split until none is too
        large; others get a fragment more.  ``rows`` are a stored copy.
        """
        load = f"load-{uuid.uuid4().hex}"
        rows = self._hashed(rows)
        kept = {f.bucket for f in directory} - rewritten
        own = set(rewritten)
        while True:
            counts = counts if counts is not None else self._counts(rows, kept | own)
            split = {b: self._parts(b, counts.get(b, 0)) for b in own}
            if all(len(parts) == 1 for parts in split.values()):
                break
            own, counts = {part for parts in split.values() for part in parts}, None
        new = [
            Fragment(depth, bits, load, n, 1 << max(math.ceil(math.log2(n / KEYS_PER_BLOCK)), 0))
            for (depth, bits), n in counts.items()
        ]
        placed = self._placed(rows, kept | own)
        laid_out = placed.selectExpr(*self._names, _BUCKET).hint("rebalance", "_bucket")
        laid_out.write.option("compression", "zstd").partitionBy("_bucket").parquet(f"{self.root}/rows/{load}")
        self._filters(load, new).write.option("compression", "zstd").parquet(f"{self.root}/filters/{load}")
        old = [f for f in directory if f.load and f.bucket in kept]
        filled = {f.bucket for f in [*old, *new]}
        result = [*old, *new, *[Fragment(*b) for b in (kept | own) - filled]]
        self._publish(result)
        return sum(f.rows for f in result)

    def _filters(self, load: str, fragments: list[Fragment]) -> DataFrame:
        """(_bucket, block, word): the bits of all keys of a fragment, OR-ed per block; sorted within files.

        Keys come from the files that the load has written: they lie together by bucket, so
        most of a block is combined where it is read.
        """
        sizes = self._frame([(f.name, f.blocks) for f in fragments], "_bucket STRING, blocks BIGINT")
        stored = T.StructType([*self.schema.fields, T.StructField("_bucket", T.StringType())])
        written = self._hashed(self.spark.read.schema(stored).parquet(f"{self.root}/rows/{load}"))
        marks = written.join(sizes, "_bucket").selectExpr(
            "_bucket", f"{key_block('_probe', 'blocks')} AS block", f"{key_mask('_probe')} AS mask"
        )
        words = marks.groupBy("_bucket", "block").agg(F.expr("bit_or(mask)").alias("word"))
        return words.sortWithinPartitions("_bucket", "block")

    # --- probing ----------------------------------------------------------------
    def known_fragments(self, rows: DataFrame, directory: list[Fragment] | None = None) -> list[Fragment]:
        """The fragments whose filter may know a key of ``rows``; a filter never misses a key it holds."""
        directory = self.directory() if directory is None else directory
        filled = [f for f in directory if f.load]
        if not filled:
            return []
        placed = self._placed(self._hashed(rows.select(*self.keys)), {f.bucket for f in directory})
        # Keys and filters meet by the number of the fragment, not by names.
        held = self._frame(
            [(f.depth, f.bits, i, f.blocks) for i, f in enumerate(filled)], "_depth INT, _bits BIGINT, fragment INT, blocks BIGINT"
        )
        names = self._frame([(f.load, f.name, i) for i, f in enumerate(filled)], "load STRING, _bucket STRING, fragment INT")
        asked = placed.select("_depth", "_bits", "_probe").join(held, ["_depth", "_bits"]).selectExpr(
            "fragment", f"{key_block('_probe', 'blocks')} AS block", f"{key_mask('_probe')} AS mask"
        )
        words = self.spark.read.schema("_bucket STRING, block BIGINT, word BIGINT").parquet(
            *[f"{self.root}/filters/{load}" for load in sorted({f.load for f in filled})]
        ).withColumn("load", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))
        numbered = words.join(names, ["load", "_bucket"]).select("fragment", "block", "word")
        hits = asked.join(numbered, ["fragment", "block"]).where("word & mask = mask").select("fragment").distinct()
        return [filled[i] for i in sorted(i for (i,) in hits.collect())]

    def absent(self, rows: DataFrame) -> DataFrame:
        """Rows (one per key) whose key is not stored; only fragments that may hold one are read."""
        rows = pin(rows, "offered")  # read several times
        return absent_from(rows, self._read(self.known_fragments(rows)), self.keys)

    def near(self, rows: DataFrame) -> DataFrame:
        """The stored rows of the buckets that the keys of ``rows`` fall into; no other bucket is read."""
        directory = self.directory()
        touched = self._counts(self._hashed(rows.select(*self.keys)), {f.bucket for f in directory})
        return self._read([f for f in directory if f.bucket in touched])

    # --- writing: rows have one row per complete key ---------------------------------
    def insert(self, rows: DataFrame) -> int:
        """Add rows whose keys are not stored yet.

        A bucket that would exceed its size or its number of fragments is written anew.
        """
        fresh = pin(rows.select(*self._names), "fresh")
        directory = self.directory()
        added = self._counts(self._hashed(fresh), {f.bucket for f in directory})
        if not added:
            return 0
        held, fragments = Counter(), Counter()
        for f in directory:
            held[f.bucket] += f.rows
            fragments[f.bucket] += f.load is not None
        crowded = {
            b for b, n in added.items() if held[b] + n > self.bucket_rows or fragments[b] >= self.most_fragments
        }
        current = [f for f in directory if f.load and f.bucket in crowded]
        if current:
            refilled = pin(self._read(current).unionByName(fresh), "refilled")
            self._store(refilled, directory, crowded)
        else:
            self._store(fresh, directory, crowded, added)
        return sum(added.values())

    def upsert(self, rows: DataFrame) -> int:
        """Insert or replace by key; returns the number of keys added."""
        fresh = pin(rows.select(*self._names), "fresh")
        directory = self.directory()
        touched = self._counts(self._hashed(fresh), {f.bucket for f in directory})
        if not touched:
            return 0
        current = [f for f in directory if f.load and f.bucket in touched]
        before = sum(f.rows for f in directory)
        if not current:
            return self._store(fresh, directory, set(touched), touched) - before
        merged = pin(merge_rows(self._read(current), fresh, self.keys), "merged")
        return self._store(merged, directory, set(touched)) - before

    def replace(self, rows: DataFrame) -> None:
        """Truncate and reload; ``rows`` may read the table."""
        written = pin(rows.select(*self._names), "replacement")
        self._store(written, list(_START), {_START[0].bucket})

    def clean_up(self, keep: int = 2) -> int:
        """Delete fragments, filters and directories that the last ``keep`` versions do not name; returns folders deleted."""
        last = self.version()
        files = self._files()
        kept_versions = range(max(last - keep + 1, 1), last + 1)
        live = {(f.load, f.name) for v in kept_versions for f in self.directory(v) if f.load}
        loads = {load for load, _ in live}
        dead = []
        for status in files.listStatus(self._path("rows")):
            load = status.getPath().getName()
            if load not in loads:
                dead += [status.getPath(), self._path("filters", load)]
                continue
            dead += [
                s.getPath() for s in files.listStatus(status.getPath())
                if s.isDirectory() and (load, s.getPath().getName().removeprefix("_bucket=")) not in live
            ]
        for status in files.listStatus(self._path("directory")):
            name = status.getPath().getName()
            if not name.startswith("v") or int(name[1:]) not in kept_versions:
                dead.append(status.getPath())
        for path in dead:
            files.delete(path, True)
        return len(dead)
