"""Exact de-duplication with a sharded cuckoo-filter index of live digests.

Equal texts are those that agree after every run of white space became one space; their identity is the SHA-256 of that
text. A shard of the index is a cuckoo filter of short fingerprints plus the stored keys, bucketed by their home bucket: a
probe that misses is a new digest, a hit is verified against the bucket's stored digests. When an insertion cannot find a
slot the filter is doubled and rebuilt from the stored keys. Digests can be deleted again.

Each task first runs its rows through an index of its own, so of a group of copies at most one entry per task is shuffled,
however large the group is; the entries then meet in the shard of their digest. Only digests and ids move, never texts.

Defined results: NULL text counts as empty; of equal texts the smallest id stays, a NULL id comes last, and of rows that
repeat both id and text one stays; extra columns are ignored.
"""

from __future__ import annotations

import random
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeplan.llm import common

SLOTS = 4
MAX_KICKS = 200
FIRST_BUCKETS = 1 << 10
TASK_DIGESTS = 200_000
LAST_ID = (1 << 63) - 1

ENTRY_SCHEMA = "digest binary, keep_id long, keep_row long, copies long"


class CuckooIndex:
    """One shard: digest -> [smallest (id, row), number of rows], behind a cuckoo filter."""

    def __init__(self, buckets: int = FIRST_BUCKETS):
        self.random = random.Random(buckets)
        self.reset(buckets)
        self.content: dict[int, list[list]] = {}
        self.live = 0

    def reset(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.table = np.zeros((buckets, SLOTS), dtype=np.uint16).tolist()

    @staticmethod
    def home(digest: bytes) -> int:
        return int.from_bytes(digest[:8], "little")

    @staticmethod
    def fingerprint(digest: bytes) -> int:
        return int.from_bytes(digest[8:10], "little") or 1

    def other(self, bucket: int, fingerprint: int) -> int:
        return (bucket ^ (fingerprint * 0x5BD1E995)) & self.mask

    def stored(self, digest: bytes) -> list | None:
        """The entry of a live digest: the filter answers most misses, a hit is verified against the stored keys."""
        fingerprint, first = self.fingerprint(digest), self.home(digest) & self.mask
        if fingerprint in self.table[first] or fingerprint in self.table[self.other(first, fingerprint)]:
            for entry in self.content.get(first, ()):
                if entry[0] == digest:
                    return entry
        return None

    def place(self, digest: bytes) -> bool:
        """Put a fingerprint into the filter; False when it overflows."""
        fingerprint, bucket = self.fingerprint(digest), self.home(digest) & self.mask
        for at in (bucket, self.other(bucket, fingerprint)):
            if 0 in self.table[at]:
                self.table[at][self.table[at].index(0)] = fingerprint
                return True
        for _ in range(MAX_KICKS):
            slot = self.random.randrange(SLOTS)
            row = self.table[bucket]
            row[slot], fingerprint = fingerprint, row[slot]
            bucket = self.other(bucket, fingerprint)
            if 0 in self.table[bucket]:
                self.table[bucket][self.table[bucket].index(0)] = fingerprint
                return True
        return False

    def grow(self) -> None:
        """Double the filter and rebuild it from the stored keys, until all fit."""
        entries = [e for es in self.content.values() for e in es]
        buckets = (self.mask + 1) * 2
        while True:
            self.reset(buckets)
            if all(self.place(e[0]) for e in entries):
                break
            buckets *= 2
        self.content = {}
        for entry in entries:
            self.content.setdefault(self.home(entry[0]) & self.mask, []).append(entry)

    def insert(self, digest: bytes, keep: tuple[int, int], copies: int = 1) -> bool:
        """Add rows of a digest; True if it was not live before."""
        entry = self.stored(digest)
        if entry is not None:
            entry[1] = min(entry[1], keep)
            entry[2] += copies
            return False
        self.content.setdefault(self.home(digest) & self.mask, []).append([digest, keep, copies])
        self.live += 1
        if not self.place(digest):
            self.grow()
        return True

    def delete(self, digest: bytes) -> bool:
        """Take a digest out; False if it is not live."""
        entry = self.stored(digest)
        if entry is None:
            return False
        fingerprint, first = self.fingerprint(digest), self.home(digest) & self.mask
        self.content[first].remove(entry)
        self.live -= 1
        at = first if fingerprint in self.table[first] else self.other(first, fingerprint)
        self.table[at][self.table[at].index(fingerprint)] = 0
        return True

    def entries(self) -> list[list]:
        return [e for es in self.content.values() for e in es]


def as_batch(index: CuckooIndex) -> pa.RecordBatch:
    rows = index.entries()
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1][0] for r in rows], pa.int64()),
         pa.array([r[1][1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64())],
        names=["digest", "keep_id", "keep_row", "copies"])


def normalised(text: str = "text") -> F.Column:
    return F.regexp_replace(common.whole_text(text), common.SPACE, " ")


def through_index(entries: DataFrame, bound: int | None) -> DataFrame:
    """Run each partition's entries through one shard; ``bound`` live digests are handed on early where it is set."""
    def run(batches):
        index = CuckooIndex()
        for batch in batches:
            columns = (batch.column(i).to_pylist() for i in range(4))
            for digest, keep_id, keep_row, copies in zip(*columns, strict=True):
                index.insert(digest, (keep_id, keep_row), copies)
            if bound is not None and index.live > bound:
                yield as_batch(index)
                index = CuckooIndex()
        yield as_batch(index)

    return common.map_arrow(entries, run, ENTRY_SCHEMA)


def groups(rows: DataFrame) -> DataFrame:
    """(digest, keep_id, keep_row, copies) of every distinct digest of ``rows``(row, doc_id, text_sha256)."""
    digest = F.unhex("text_sha256").alias("digest")
    keep = F.coalesce("doc_id", F.lit(LAST_ID)).alias("keep_id")
    entries = rows.select(digest, keep, F.col("row").alias("keep_row"), F.lit(1).cast("long").alias("copies"))
    return through_index(through_index(entries, TASK_DIGESTS).repartition("digest"), None)


def update(stored: DataFrame, changes: DataFrame, shards: int) -> DataFrame:
    """Stored keys after a batch of changes(digest, keep_id, keep_row, copies, live).

    ``live`` false deletes a digest; deletions are applied before insertions. ``stored`` has the columns of ``groups``.
    """
    shard = F.pmod(F.xxhash64("digest"), F.lit(shards)).alias("shard")

    def change(old: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
        index = CuckooIndex()
        for r in old.itertuples():
            index.insert(r.digest, (r.keep_id, r.keep_row), r.copies)
        for r in new[~new.live.astype(bool)].itertuples():
            index.delete(r.digest)
        for r in new[new.live.astype(bool)].itertuples():
            index.insert(r.digest, (r.keep_id, r.keep_row), r.copies)
        return as_batch(index).to_pandas()

    old = stored.select(shard, "digest", "keep_id", "keep_row", "copies").groupBy("shard")
    new = changes.select(shard, "digest", "keep_id", "keep_row", "copies", "live").groupBy("shard")
    return old.cogroup(new).applyInPandas(change, ENTRY_SCHEMA)


def decisions(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for each row of ``docs``."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"),
                       F.sha2(normalised(text), 256).alias("text_sha256"))
    rows = common.written(rows, "digests")
    repeated = (groups(rows).filter("copies > 1")
                .select(F.lower(F.hex("digest")).alias("text_sha256"), "keep_id", "keep_row", "copies"))
    found = rows.join(repeated, "text_sha256", "left")
    keep_id = F.when(F.col("keep_row").isNull(), F.col("doc_id")).otherwise(F.nullif("keep_id", F.lit(LAST_ID)))
    return found.select("doc_id", keep_id.alias("keep_id"), F.coalesce("copies", F.lit(1).cast("long")).alias("group_size"),
                        (F.coalesce("keep_row", "row") == F.col("row")).alias("kept"), "text_sha256")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, with their own columns; digests decide, and only texts whose id may be affected move."""
    own_id = F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST_ID))
    digest = F.sha2(normalised(text), 256)
    marked = common.written(docs.select(F.monotonically_increasing_id().alias("row"), own_id.alias("doc_id"),
                                        digest.alias("text_sha256")), "digests")
    repeated = groups(marked).filter("copies > 1").select(F.lower(F.hex("digest")).alias("text_sha256"), "keep_id")
    known = (marked.join(repeated, "text_sha256").groupBy("doc_id", "text_sha256")
             .agg(F.first(F.col("keep_id") == F.col("doc_id")).alias("__stays"), F.count(F.lit(1)).alias("n"))
             .filter("not __stays or n > 1")
             .select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__digest"), "__stays"))
    known = common.written(known, "affected")
    flagged = common.flagged(docs.withColumn("__id", own_id), known, "__id")
    tagged = flagged.filter("__maybe").withColumn("__digest", digest).join(known, ["__id", "__digest"], "left")
    kept = [flagged.filter("NOT __maybe"), tagged.filter("__stays IS NULL")]
    if not known.filter("__stays").isEmpty():  # rows that repeat both id and text
        kept.append(tagged.filter("__stays").dropDuplicates(["__id", "__digest"]))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return reduce(DataFrame.unionByName, [part.select(*columns) for part in kept])
