"""Similarity join of documents on word n-gram sets by PartEnum signatures.

Two sets of a and b elements have a Jaccard similarity of at least num/den exactly if their symmetric difference D has
(den + num) * D <= (den - num) * (a + b). Sizes are cut into bands; a set takes part in its own band and in smaller ones
whose members it could still match. In a band with at most k differences the hash domain is cut into k + 1 + s partitions
(k + 1 is the case of PartEnum in which a first-level partition must agree as a whole): at least 1 + s of them hold no
difference, so two similar sets share the signature of a partition that is not empty as long as one of them has at most s
empty partitions; sets with more also sign their empty partitions. No similar pair is lost.

Equal sets are one vertex from the start, so copies are never paired. Documents that share a signature form a group. Groups
are reduced to distinct member lists, and within a list a parity sketch (a bit per hash position, whose difference never
exceeds D) rules out most pairs without the sets. A signature of many rows is hot: its rows are counted and dealt by salts
before they meet, ROUNDS times anew, so that no task holds its group. First every list hands on a spanning forest of its
possible pairs; these are verified on the texts. Then the possible pairs that lie in different components, and only these,
are verified as well, so the components are those of all links. For this, members of a hot signature form blocks, of one
component where it is large; a join of block numbers pairs them, but not two blocks of one component.

Defined results: NULL and empty texts and texts without words have no shingles and are their own component; fewer words
than a shingle make one shingle of all; the links join sets, and a component is named by the smallest id of its rows, NULL
if none has one; rows with a repeated id are one document for reachability, rows without an id are not; extra columns are
ignored. Sets are identified by 64-bit hashes.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeplan.llm import common
from lakeplan.llm.components import components

BLOCK_MEMBERS = 512
ROUNDS = 2
PARTS = 16
CACHE_WORDS = 400_000
SEEN_SETS = 1_000_000
LARGEST_SET = 1 << 40

MIX1, MIX2, MIX3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX2
    x = (x ^ (x >> np.uint64(27))) * MIX3
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, kept by the worker up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


WORDS = WordHashes()


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of the n-grams of a text's words, with A-Z in lower case."""
    found = (text or "").encode().lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(WORDS.__getitem__, found), np.uint64, len(found))
    span = min(words, len(found))
    n = len(found) - span + 1
    rolled = np.full(n, span, np.uint64)
    for k in range(span):
        rolled = (rolled ^ (rolled >> np.uint64(32))) * MIX1 + h[k:k + n]
    return np.unique(mixed(rolled))


def set_id(shingles: np.ndarray) -> int:
    return int(np.int64(np.uint64(xxhash.xxh64_intdigest(shingles.tobytes(), 5))))


@dataclass(frozen=True)
class Band:
    """Sets of ``low`` elements or more; ``high`` is the largest set that can match a member."""

    number: int
    low: int
    high: int
    differences: int
    partitions: int
    empty: int


@dataclass(frozen=True)
class Join:
    """Threshold num/den on sets of n-grams of ``words`` words; bands grow by ``growth``."""

    words: int = 3
    num: int = 90
    den: int = 100
    growth: float = 1.5

    def similar(self, difference, total):
        return (self.den + self.num) * difference <= (self.den - self.num) * total


@lru_cache(maxsize=8)
def bands(join: Join) -> list[Band]:
    """Bands from the smallest size up; a band whose members may differ in nothing has no partitions."""
    made, low = [], 1
    while low < LARGEST_SET:
        following = max(low + 1, int(low * join.growth))
        high = (following - 1) * join.den // join.num
        k = (following - 1 + high) * (join.den - join.num) // (join.den + join.num)
        empty = partitions = 0
        if k:
            for _ in range(100):
                partitions = k + 1 + empty
                mean = partitions * np.exp(-low / partitions)
                needed = int(np.ceil(mean + 3 * np.sqrt(mean)))
                if needed <= empty or empty > k:
                    break
                empty += max(1, (needed - empty) // 2)
            partitions = k + 1 + empty
        made.append(Band(len(made), low, high, k, partitions, empty))
        low = following
    return made


def bands_of(size: int, join: Join) -> list[Band]:
    found = []
    for band in bands(join):
        if band.low > size:
            break
        if size <= band.high:
            found.append(band)
    return found


def signatures(shingles: np.ndarray, join: Join) -> np.ndarray:
    """Signatures of a set in all its bands."""
    out = []
    for band in bands_of(len(shingles), join):
        if not band.partitions:
            continue
        part = ((shingles >> np.uint64(32)) * np.uint64(band.partitions)) >> np.uint64(32)
        starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        sums = np.add.reduceat(mixed(shingles + MIX1), starts)
        salt = np.uint64((band.number + 1) * int(MIX2) % (1 << 64))
        out.append(mixed(mixed(sums) + part[starts] * MIX3 + salt))
        if band.partitions - len(starts) > band.empty:
            missing = np.setdiff1d(np.arange(band.partitions, dtype=np.uint64), part[starts], assume_unique=True)
            out.append(mixed(missing * MIX3 + (salt ^ MIX1)))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def sketch(shingles: np.ndarray) -> bytes:
    """Parities of the set's hash positions; twice as many positions as elements at least."""
    positions = 1 << max(8, int(2 * len(shingles) - 1).bit_length())
    odd = np.bincount((shingles & np.uint64(positions - 1)).astype(np.int64), minlength=positions) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(sketches: list[bytes]) -> np.ndarray:
    """Sketches as rows of 64-bit words, all of the shortest length."""
    shortest = min(map(len, sketches)) // 8
    rows = np.empty((len(sketches), shortest), np.uint64)
    for i, s in enumerate(sketches):
        row = np.frombuffer(s, np.uint64)
        while len(row) > shortest:
            row = row[:len(row) // 2] ^ row[len(row) // 2:]
        rows[i] = row
    return rows


def row_key(doc_id: str, text: str) -> Column:
    """64-bit hash of a row's id and text."""
    return F.xxhash64(F.col(doc_id).cast("long"), F.col(text))


def set_table(rows: DataFrame, join: Join) -> DataFrame:
    """(doc_id, key, set_id, n) of every row."""
    def make():
        def score(ids, keys, texts):
            sets = [shingle_set(t, join.words) for t in texts.to_pylist()]
            return {"doc_id": ids, "key": keys, "set_id": [set_id(s) for s in sets], "n": [len(s) for s in sets]}
        return score

    kinds = {"doc_id": pa.int64(), "key": pa.int64(), "set_id": pa.int64(), "n": pa.int64()}
    return common.map_arrow(rows, common.per_row(make, ["doc_id", "key", "text"], kinds), "doc_id long, key long, set_id long, n long")


def signed_sets(docs: DataFrame, join: Join) -> DataFrame:
    """(signature, set_id) rows; a set that a task has signed before is not signed again."""
    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            found, owners = [], []
            for text in batch.column(0).to_pylist():
                shingles = shingle_set(text, join.words)
                own = set_id(shingles)
                if own in seen or not len(shingles):
                    continue
                if len(seen) >= SEEN_SETS:
                    seen.clear()
                seen.add(own)
                signs = signatures(shingles, join)
                found.append(signs)
                owners.append(np.full(len(signs), own, np.int64))
                if sum(map(len, found)) > 1_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64)), pa.array(np.concatenate(owners))], names=["signature", "set_id"])
                    found, owners = [], []
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64)), pa.array(np.concatenate(owners))], names=["signature", "set_id"])

    return common.map_arrow(docs.select("text"), run, "signature long, set_id long")


def blocks_for(n: Column) -> Column:
    """How many blocks hold n rows: a power of two, so that signatures of nearly the same rows are dealt alike."""
    return F.pow(F.lit(2), F.greatest(F.lit(0), F.ceil(F.log2(n / BLOCK_MEMBERS)))).cast("long")


def hot_rows(signed: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Rows of signatures with at most two blocks of rows; distinct (signature, set_id, blocks) of the others, if any.

    A bitmap of the hot signatures keeps all other rows out of the joins.
    """
    counts = signed.groupBy("signature").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 2 * BLOCK_MEMBERS)
    hot = common.written(counts.select("signature", blocks_for(F.col("n")).alias("blocks")), "hot")
    if hot.isEmpty():
        return signed, None
    maybe = common.maybe_in(hot, "signature")
    rows = signed.filter(maybe).join(hot, "signature")
    false_hits = signed.filter(maybe).join(hot.select("signature"), "signature", "left_anti")
    return signed.filter(~maybe).unionByName(false_hits), common.written(rows.select("signature", "set_id", "blocks").distinct(), "hot-rows")


def salted(hot: DataFrame) -> DataFrame:
    """(signature, set_id, block): a signature for each block of a hot one, in each round; ``block`` is that of any signature."""
    made = None
    for r in range(ROUNDS):
        salt = F.pmod(F.xxhash64(F.lit(r), F.col("set_id")), F.col("blocks"))
        dealt = hot.select(F.xxhash64(F.col("signature"), F.lit(r), salt).alias("signature"), "set_id", F.xxhash64(F.lit(r), "blocks", salt).alias("block"))
        made = dealt if made is None else made.unionByName(dealt)
    return made


def block_pairs(hot: DataFrame, labels: DataFrame) -> DataFrame:
    """(group_id, set_id, block): pairs of blocks of a hot signature, without those inside one component of ``labels``(set_id, component)."""
    members = common.written(hot.join(labels, "set_id").select("signature", "set_id", "component"), "hot-members")
    sizes = common.written(members.groupBy("signature", "component").agg(F.count(F.lit(1)).alias("size")), "hot-sizes")
    small = F.sum(F.when(F.col("size") < BLOCK_MEMBERS, F.col("size")).otherwise(0)).alias("small")
    opened = sizes.groupBy("signature").agg(F.count(F.lit(1)).alias("n"), small).filter("n > 1").drop("n")
    dealt = sizes.join(opened, "signature")
    whole = F.col("size") >= BLOCK_MEMBERS
    salt = F.pmod(F.xxhash64("set_id"), blocks_for(F.when(whole, F.col("size")).otherwise(F.col("small"))))
    only = F.when(whole, F.col("component"))
    placed = common.written(members.join(dealt, ["signature", "component"])
                            .select("signature", "set_id", only.alias("only"), F.xxhash64(whole, only, salt).alias("block")), "hot-blocks")
    blocks = common.written(placed.groupBy("signature", "block").agg(F.max("only").alias("only")), "blocks")
    left = blocks.select("signature", F.col("block").alias("a"), F.col("only").alias("a_only"), F.pmod("block", F.lit(PARTS)).cast("int").alias("part"))
    right = blocks.select("signature", F.col("block").alias("b"), F.col("only").alias("b_only"), F.explode(F.array(*[F.lit(i) for i in range(PARTS)])).alias("part"))
    pairs = left.join(right, ["signature", "part"]).filter("a <= b AND (a_only <> b_only OR a_only IS NULL OR b_only IS NULL)")
    sides = pairs.select(F.xxhash64("signature", "a", "b").alias("group_id"), F.xxhash64("a", "b").alias("both"), "signature",
                         F.explode(F.array_distinct(F.array("a", "b"))).alias("block"))
    return sides.join(placed, ["signature", "block"]).select("group_id", "set_id", F.col("both").alias("block"))


def groups(signed: DataFrame) -> DataFrame:
    """(group_id, members, block): distinct lists of sets that share a signature, from signed(signature, set_id, block).

    Without a block column a signature is its own block, and is not shuffled twice.
    """
    sent = [c for c in ("signature", "set_id", "block") if c in signed.columns]

    def run(batches):
        seen: set[int] = set()

        def of(signature: np.ndarray, owner: np.ndarray, block: np.ndarray | None = None) -> pa.RecordBatch:
            new = np.concatenate([[True], (signature[1:] != signature[:-1]) | (owner[1:] != owner[:-1])])
            signature, owner = signature[new], owner[new]
            block = signature if block is None else block[new]
            starts = np.flatnonzero(np.concatenate([[True], signature[1:] != signature[:-1]]))
            ends = np.append(starts[1:], len(signature))
            ids, members, blocks = [], [], []
            for i in np.flatnonzero(ends - starts > 1):
                part = owner[starts[i]:ends[i]]
                key = xxhash.xxh64_intdigest(part.tobytes())
                if key not in seen:
                    if len(seen) >= SEEN_SETS:
                        seen.clear()
                    seen.add(key)
                    ids.append(int(np.int64(np.uint64(key))))
                    members.append(part)
                    blocks.append(int(block[starts[i]]))
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(members, pa.list_(pa.int64())), pa.array(blocks, pa.int64())],
                                              names=["group_id", "members", "block"])

        held: list[list[np.ndarray]] = []
        for batch in batches:
            columns = [c.to_numpy() for c in batch.columns]
            s = columns[0]
            if not len(s):
                continue
            cut = int(np.searchsorted(s, s[-1]))
            if cut or (held and held[-1][0][-1] != s[0]):
                whole = [*held, [c[:cut] for c in columns]]
                yield of(*(np.concatenate(c) for c in zip(*whole, strict=True)))
                held = []
            held.append([c[cut:] for c in columns])
        if held:
            yield of(*(np.concatenate(c) for c in zip(*held, strict=True)))

    dealt = signed.select(*sent).repartition("signature").sortWithinPartitions("signature", "set_id")
    runs = common.map_arrow(dealt, run, "group_id long, members array<long>, block long")
    return runs.groupBy("group_id").agg(F.first("members").alias("members"), F.min("block").alias("block"))


def members_table(rows: DataFrame, needed: DataFrame, join: Join) -> DataFrame:
    """(set_id, n, sketch, text) of the sets of ``needed``(key), one row each."""
    known = common.flagged(rows, needed, "key").filter("__maybe").drop("__maybe")
    picked = known.join(needed.select("key").distinct(), "key", "left_semi").select("text")

    def make():
        def score(texts):
            sets = [shingle_set(t, join.words) for t in texts.to_pylist()]
            return {"set_id": [set_id(s) for s in sets], "n": [len(s) for s in sets], "sketch": [sketch(s) for s in sets], "text": texts}
        return score

    kinds = {"set_id": pa.int64(), "n": pa.int64(), "sketch": pa.binary(), "text": pa.string()}
    return common.map_arrow(picked, common.per_row(make, ["text"], kinds), "set_id long, n long, sketch binary, text string").dropDuplicates(["set_id"])


def possible_pairs(rows: DataFrame, join: Join, all_pairs: bool) -> DataFrame:
    """(a, b) set ids that the sketches cannot rule out, from rows(group_id, set_id, n, sketch, component, block).

    Groups of one block meet in one task, one after the other, and a pair is handed on once a task.

    A spanning forest of each group, nearest pairs first; or, with ``all_pairs``, every pair between two components.
    """
    def pairs_of(ids, sizes, labels, sketches):
        bits = folded(sketches)
        label = np.array(labels)
        for i in range(1, len(ids)):
            distance = np.bitwise_count(bits[:i] ^ bits[i]).sum(1, dtype=np.int64)
            able = join.similar(distance, sizes[:i] + sizes[i]) & (label[:i] != label[i])
            if not able.any():
                continue
            at = np.flatnonzero(able)
            if not all_pairs:
                at = at[np.argsort(distance[at], kind="stable")]
                _, first = np.unique(label[at], return_index=True)
                at = at[first]
                label[np.isin(label, np.append(label[at], label[i]))] = label[i]
            for j in at:
                yield (ids[j], ids[i]) if ids[j] < ids[i] else (ids[i], ids[j])

    def run(batches):
        seen: set[tuple] = set()

        def of(rows):
            ids = [r[1] for r in rows]
            sizes = np.array([r[2] for r in rows], np.int64)
            return [p for p in pairs_of(ids, sizes, [r[4] for r in rows], [r[3] for r in rows]) if p not in seen and not seen.add(p)]

        def batch_of(pairs):
            if len(seen) > SEEN_SETS:
                seen.clear()
            return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], names=["a", "b"])

        held: list[tuple] = []
        for batch in batches:
            pairs = []
            for row in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if held and held[0][0] != row[0]:
                    pairs += of(held)
                    held = []
                held.append(row)
            yield batch_of(pairs)
        yield batch_of(of(held) if held else [])

    dealt = rows.repartition(F.coalesce("block", "group_id")).select("group_id", "set_id", "n", "sketch", "component").sortWithinPartitions("group_id", "set_id")
    return common.map_arrow(dealt, run, "a long, b long").distinct()


def verified(pairs: DataFrame, members: DataFrame, join: Join) -> DataFrame:
    """(a, b, linked): each pair decided on its texts."""
    left = members.select(F.col("set_id").alias("a"), F.col("text").alias("a_text"))
    right = members.select(F.col("set_id").alias("b"), F.col("text").alias("b_text"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "a_text", "b_text")

    def run(batches):
        for batch in batches:
            kept: dict[int, np.ndarray] = {}

            def shingles(own, text, kept=kept):
                if own not in kept:
                    kept[own] = shingle_set(text, join.words)
                return kept[own]

            linked = []
            for a, b, x, y in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                s, t = shingles(a, x), shingles(b, y)
                common_n = len(np.intersect1d(s, t, assume_unique=True))
                linked.append(join.similar(len(s) + len(t) - 2 * common_n, len(s) + len(t)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])

    return common.map_arrow(both, run, "a long, b long, linked boolean")


def id_chains(sets: DataFrame) -> DataFrame:
    """(a, b): the sets of rows with the same id, each with the smallest."""
    known = sets.filter("n > 0 AND doc_id IS NOT NULL").select("doc_id", "set_id")
    span = known.groupBy("doc_id").agg(F.min("set_id").alias("a"), F.max("set_id").alias("last")).filter("a <> last").select("doc_id", "a")
    repeated = common.written(span, "ids")
    chained = common.flagged(known, repeated, "doc_id").filter("__maybe").join(repeated, "doc_id")
    return chained.filter("set_id <> a").select("a", F.col("set_id").alias("b")).distinct()


def row_components(docs: DataFrame, join: Join, doc_id: str, text: str) -> DataFrame:
    """(doc_id, key, n_shingles, component_id) of each row of ``docs``."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), row_key(doc_id, text).alias("key"), F.col(text).alias("text"))
    sets = common.written(set_table(rows, join), "sets")
    classes = sets.filter("n > 0").groupBy("set_id").agg(F.min("key").alias("key"), F.min("doc_id").alias("least"))
    cold, hot = hot_rows(common.written(signed_sets(rows, join), "signed"))

    def listed_of(signed):
        lists = common.written(groups(signed), "groups")
        return lists.select("group_id", F.size("members").alias("size"), F.explode("members").alias("set_id"), "block")

    cold_lists = listed_of(cold)
    listed = cold_lists if hot is None else cold_lists.unionByName(listed_of(salted(hot)))
    needed = common.written(listed.select("set_id").distinct().join(classes, "set_id").select("key"), "needed")
    members = common.written(members_table(rows, needed, join), "members")
    sketched = members.select("set_id", "n", "sketch")

    first = listed.join(sketched, "set_id").withColumn("component", F.col("set_id"))
    tried = common.written(verified(possible_pairs(first, join, False), members, join), "pairs")
    joined = components(tried.filter("linked"))
    labelled = sketched.join(joined.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn("component", F.coalesce("component", "set_id"))
    again = cold_lists.filter("size > 2").select("group_id", "set_id", "block")
    if hot is not None:
        labelled = common.written(labelled, "labelled")
        again = again.unionByName(block_pairs(hot, labelled.select("set_id", "component")))
    second = again.join(labelled, "set_id")
    open_pairs = possible_pairs(second, join, True).join(tried.select("a", "b"), ["a", "b"], "left_anti")
    more = common.written(verified(open_pairs, members, join).filter("linked"), "pairs")
    links = tried.filter("linked").select("a", "b").unionByName(more.select("a", "b")).unionByName(id_chains(sets))
    found = components(links).withColumnRenamed("node", "set_id")
    chained = common.written(classes.join(found, "set_id").select("set_id", "component", "least"), "chained")
    names = chained.groupBy("component").agg(F.min("least").alias("name"))
    renamed = common.written(chained.join(names, "component").select("set_id", F.lit(True).alias("renamed"), "name"), "names")
    named = classes.join(renamed, "set_id", "left").select("set_id", F.when(F.col("renamed"), F.col("name")).otherwise(F.col("least")).alias("component_id"))
    own = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return sets.join(named, "set_id", "left").select("doc_id", "key", F.col("n").alias("n_shingles"), own.alias("component_id"))


def near_components(docs: DataFrame, join: Join = Join(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row of ``docs``."""
    return row_components(docs, join, doc_id, text).drop("key")


def one_per_group(docs: DataFrame, join: Join, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that are the smallest id of their component, with their own columns; rows without an id stay."""
    others = row_components(docs, join, doc_id, text).filter("component_id <> doc_id")
    dropped = common.written(others.select(F.struct("doc_id", "key").alias("__row")), "dropped")
    keyed = docs.withColumn("__row", F.struct(F.col(doc_id).cast("long").alias("doc_id"), row_key(doc_id, text).alias("key")))
    return common.without(keyed, dropped, "__row").drop("__row")
