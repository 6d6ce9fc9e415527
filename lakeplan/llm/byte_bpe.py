"""Byte-level BPE encoding by overlapping chunks, and decoding.

A text of at most ``chunk_chars`` is one chunk and is encoded where it is read. Longer texts are cut into overlapping chunks
that are dealt over the tasks: each is pre-tokenised by itself and reports the boundaries inside the two overlaps it shares.
Neighbours are stitched at the first position where both have a boundary that lies between a visible character and a
space; no match of the pattern can span it, so it is a boundary of the whole text too. The pieces between stitches are
encoded in parallel, each exactly as inside the whole text, and ids and decoded bytes are concatenated per document. Where
an overlap has no such position (one very long run without spaces), the two chunks stay one piece.

Defined results: NULL and empty texts have no ids; repeated ids are kept apart by their row number within the input split;
extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeplan.llm import common

VOCABULARY = "byte_bpe_50k.tiktoken"
CHUNK_CHARS = 32_768
OVERLAP_CHARS = 1_024

DIGESTS = {"doc_id": pa.int64(), "n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
DIGEST_SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


@lru_cache(maxsize=4)
def _encoding(vocabulary: str, specials: tuple):
    import public_tokenizers
    import tiktoken

    with open(common.tokenizer_file(vocabulary), "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=dict(specials))


def rank_encoding(vocabulary: str, specials: dict[str, int] | None = None):
    """The encoder of a rank file, loaded once per process."""
    return _encoding(vocabulary, tuple((specials or {}).items()))


def stitch_points(chunk: str, start: int, split: regex.Pattern) -> list[int]:
    """Positions in the whole text of a chunk's pre-token boundaries between a visible character and a space.

    The first and last position of the chunk are its cut, not boundaries.
    """
    found = []
    for match in split.finditer(chunk):
        at = match.start()
        if at and chunk[at] in " \n" and chunk[at - 1].isprintable() and not chunk[at - 1].isspace():
            found.append(start + at)
    return found


def chunk_bounds(length: F.Column, chunk_chars: int, overlap: int) -> F.Column:
    """Start offsets of the overlapping chunks of a text."""
    return F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0).cast("long"), length - overlap - 1), F.lit(chunk_chars - overlap).cast("long"))


def overlap_boundaries(chunks: DataFrame, overlap: int) -> DataFrame:
    """Pre-tokenise each chunk by itself; keep the boundaries in its first and last ``overlap`` characters."""
    def run(batches):
        import public_tokenizers

        split = regex.compile(public_tokenizers.PATTERN)
        for batch in batches:
            starts = batch.column(2).to_pylist()
            texts = batch.column(3).to_pylist()
            points = [stitch_points(t, s, split) for t, s in zip(texts, starts, strict=True)]
            heads = [[p for p in ps if p < s + overlap] for ps, s in zip(points, starts, strict=True)]
            tails = [[p for p in ps if p >= s + len(t) - overlap] for ps, s, t in zip(points, starts, texts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(heads, pa.list_(pa.int64())),
                 pa.array(tails, pa.list_(pa.int64()))], names=["row", "doc_id", "start", "head", "tail"])

    return common.map_arrow(chunks, run, "row string, doc_id long, start long, head array<long>, tail array<long>")


def encode_pieces(pieces: DataFrame, vocabulary: str) -> DataFrame:
    """Ids (as 32-bit little-endian bytes) and decoded bytes of each piece."""
    def run(batches):
        encoding = rank_encoding(vocabulary)
        for batch in batches:
            ids = [encoding.encode_ordinary(t) for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array([" ".join(map(str, x)).encode() for x in ids], pa.binary()),
                 pa.array([len(x) for x in ids], pa.int64()), pa.array([encoding.decode_bytes(x) for x in ids], pa.binary())],
                names=["row", "doc_id", "start", "ids", "n", "decoded"])

    return common.map_arrow(pieces, run, "row string, doc_id long, start long, ids binary, n long, decoded binary")


def encode_short(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Digests of texts that are one chunk."""
    def make():
        encoding = rank_encoding(vocabulary)

        def score(ids, texts):
            out = {c: [] for c in DIGESTS}
            for i, t in zip(ids.to_pylist(), texts.to_pylist(), strict=True):
                tokens = encoding.encode_ordinary(t or "")
                out["doc_id"].append(i)
                out["n_tokens"].append(len(tokens))
                out["ids_sha256"].append(hashlib.sha256(" ".join(map(str, tokens)).encode()).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(encoding.decode_bytes(tokens)).hexdigest())
            return out
        return score

    return common.map_arrow(docs, common.per_row(make, ["doc_id", "text"], DIGESTS), DIGEST_SCHEMA)


def long_pieces(docs: DataFrame, chunk_chars: int, overlap: int) -> DataFrame:
    """(row, doc_id, start, text): the stitched pieces of long texts, dealt over the tasks."""
    row = F.concat_ws("-", F.spark_partition_id(), F.monotonically_increasing_id())
    long_docs = common.written(docs.withColumn("row", row), "long-texts")
    starts = F.explode(chunk_bounds(F.length("text").cast("long"), chunk_chars, overlap)).alias("start")
    chunks = long_docs.select("row", "doc_id", starts, "text").select(
        "row", "doc_id", "start", F.col("text").substr(F.col("start").cast("int") + 1, F.lit(chunk_chars)).alias("chunk"))
    seen = overlap_boundaries(chunks.repartition("row", "start"), overlap)
    order = Window.partitionBy("row").orderBy("start")
    shared = F.array_intersect(F.lag("tail").over(order), F.col("head"))
    cuts = seen.withColumn("cut", F.when(F.col("start") == 0, F.lit(0)).otherwise(F.array_min(shared)))
    ends = F.lead("cut").over(order)
    spans = (cuts.filter(F.col("cut").isNotNull())
             .select("row", F.col("cut").alias("start"), ends.alias("end")))
    per_row = spans.groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    pieces = long_docs.join(per_row, "row").select("row", "doc_id", "text", F.explode("spans").alias("span"))
    length = F.coalesce(F.col("span.end"), F.length("text")) - F.col("span.start")
    cut = F.col("text").substr((F.col("span.start") + 1).cast("int"), length.cast("int"))
    return pieces.select("row", "doc_id", F.col("span.start").alias("start"), cut.alias("text")).repartition("row", "start")


def concatenate(encoded: DataFrame) -> DataFrame:
    """One row per text from its pieces in order; the group is one document."""
    parts = F.array_sort(F.collect_list(F.struct("start", "ids", "n", "decoded")))
    joined = encoded.groupBy("row", "doc_id").agg(parts.alias("parts"))
    ids = F.array_join(F.transform(F.filter("parts", lambda p: p.n > 0), lambda p: p.ids.cast("string")), " ")
    decoded = F.aggregate("parts", F.lit(b""), lambda acc, p: F.concat(acc, p.decoded))
    total = F.aggregate("parts", F.lit(0).cast("long"), lambda acc, p: acc + p.n)
    return joined.select("doc_id", total.alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2(decoded, 256).alias("decoded_sha256"))


def round_trip(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY,
               chunk_chars: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each row, encoded and decoded."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), common.whole_text(text).alias("text"))
    short = encode_short(rows.filter(F.length("text") <= chunk_chars), vocabulary)
    pieces = long_pieces(rows.filter(F.length("text") > chunk_chars), chunk_chars, overlap)
    return short.unionByName(concatenate(encode_pieces(pieces, vocabulary)))
