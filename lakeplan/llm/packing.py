"""Cost-balanced packing of token sequences.

A document's tokens are cut into full sequences and a rest. Rests meet in groups of bounded token count, inside the task
that encodes them, so no token is shuffled. In a group the estimated cost of a sequence is linear plus quadratic in the
lengths of its pieces (attention stays within a piece); rests go in descending order to the cheapest sequence with room
for them, and one that fits nowhere is cut over the cheapest sequences. A task's last, unfilled tokens become sequences
whose lengths are powers of two, which need no padding.

Defined results: NULL text counts as empty (its only token is the closing id); repeated ids are packed row by row; ties
go by arrival. Sequence ids are unique; they depend on how the input is split, the pieces' coverage does not.
"""

from __future__ import annotations

import heapq
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeplan.llm import common
from lakeplan.llm.byte_bpe import rank_encoding

CAPACITY = 2048
CLOSING_ID = 1
GROUP_TOKENS = 512 * CAPACITY
LINEAR_COST = 1.0
QUADRATIC_COST = 1.0 / 512
VOCABULARY = "byte_bpe_50k.tiktoken"
SPECIALS = {"<|endoftext|>": 50256}

FIELDS = {"doc_id": pa.int64(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(), "doc_tokens": pa.int64(),
          "sequence_id": pa.int64(), "offset": pa.int64()}


@dataclass
class Piece:
    """Tokens ``ids[start:start + len(ids)]`` of a document and the sequence they go to."""

    doc_id: int | None
    start: int
    ids: np.ndarray
    doc_tokens: int
    sequence: int = -1
    offset: int = -1


def piece_cost(n: int, linear: float = LINEAR_COST, quadratic: float = QUADRATIC_COST) -> float:
    return linear * n + quadratic * n * n


def take(piece: Piece, n: int) -> tuple[Piece, Piece]:
    """The first n tokens of a piece, and the others."""
    return (Piece(piece.doc_id, piece.start, piece.ids[:n], piece.doc_tokens),
            Piece(piece.doc_id, piece.start + n, piece.ids[n:], piece.doc_tokens))


@dataclass
class Sequences:
    """Open sequences of one group, cheapest first."""

    capacity: int
    count: int
    heap: list = field(default_factory=list)
    pieces: list = field(default_factory=list)

    def __post_init__(self):
        self.heap = [(0.0, i, 0) for i in range(self.count)]

    def put(self, piece: Piece, at: tuple) -> None:
        cost, i, used = at
        piece.sequence, piece.offset = i, used
        self.pieces.append(piece)
        heapq.heappush(self.heap, (cost + piece_cost(len(piece.ids)), i, used + len(piece.ids)))

    def add(self, piece: Piece) -> None:
        """To the cheapest sequence with room for it; else cut over the cheapest ones with any room."""
        n, passed = len(piece.ids), []
        while self.heap and self.capacity - self.heap[0][2] < n:
            at = heapq.heappop(self.heap)
            if at[2] < self.capacity:
                passed.append(at)
        if self.heap:
            self.put(piece, heapq.heappop(self.heap))
        else:
            taken = 0
            for at in passed:
                if not len(piece.ids):
                    break
                first, piece = take(piece, self.capacity - at[2])
                if len(first.ids):
                    self.put(first, at)
                    taken += 1
            if len(piece.ids):
                raise ValueError("more tokens than the group's sequences hold")
            passed = passed[taken:]
        for at in passed:
            heapq.heappush(self.heap, at)


def pack_group(rests: list[Piece], capacity: int = CAPACITY) -> tuple[list[Piece], int, list[Piece]]:
    """Pack rests into full sequences: (pieces, number of sequences, tokens left over for a later group)."""
    total = sum(len(p.ids) for p in rests)
    count = total // capacity
    order = sorted(rests, key=lambda p: -len(p.ids))
    surplus, left = total - count * capacity, []
    while surplus and order:
        last = order.pop()
        n = len(last.ids)
        if n <= surplus:
            left.append(last)
            surplus -= n
        else:
            first, rest = take(last, n - surplus)
            order.append(first)
            left.append(rest)
            surplus = 0
    order.sort(key=lambda p: -len(p.ids))
    open_ones = Sequences(capacity, count)
    for piece in order:
        open_ones.add(piece)
    return open_ones.pieces, count, left


def powers_of_two(rests: list[Piece]) -> list[list[Piece]]:
    """Sequences whose lengths are the powers of two that make up the total, the longest first."""
    total, made = sum(len(p.ids) for p in rests), []
    todo = list(rests)[::-1]
    for bit in range(total.bit_length() - 1, -1, -1):
        room, here = total & (1 << bit), []
        while room:
            piece = todo.pop()
            if len(piece.ids) > room:
                piece, rest = take(piece, room)
                todo.append(rest)
            piece.offset = (total & (1 << bit)) - room
            here.append(piece)
            room -= len(piece.ids)
        if here:
            made.append(here)
    return made


class Packer:
    """Packs the documents of one task; sequence ids begin at ``first``."""

    def __init__(self, first: int, capacity: int = CAPACITY, group_tokens: int = GROUP_TOKENS):
        self.next, self.capacity, self.group_tokens = first, capacity, group_tokens
        self.rests: list[Piece] = []
        self.waiting = 0

    def document(self, doc_id, ids: np.ndarray) -> list[Piece]:
        """Pieces that are settled by this document."""
        whole, out = Piece(doc_id, 0, ids, len(ids)), []
        while len(whole.ids) >= self.capacity:
            full, whole = take(whole, self.capacity)
            full.sequence, full.offset = self.next, 0
            self.next += 1
            out.append(full)
        if len(whole.ids):
            self.rests.append(whole)
            self.waiting += len(whole.ids)
        if self.waiting >= self.group_tokens:
            out += self.group()
        return out

    def group(self) -> list[Piece]:
        pieces, count, self.rests = pack_group(self.rests, self.capacity)
        for p in pieces:
            p.sequence += self.next
        self.next += count
        self.waiting = sum(len(p.ids) for p in self.rests)
        return pieces

    def close(self) -> list[Piece]:
        out = self.group()
        for sequence in powers_of_two(self.rests):
            for p in sequence:
                p.sequence = self.next
                out.append(p)
            self.next += 1
        self.rests, self.waiting = [], 0
        return out


def as_batch(pieces: list[Piece]) -> pa.RecordBatch:
    columns = {"doc_id": [p.doc_id for p in pieces], "start": [p.start for p in pieces], "length": [len(p.ids) for p in pieces],
               "ids_crc32": [zlib.crc32(p.ids.astype("<u4").tobytes()) for p in pieces],
               "doc_tokens": [p.doc_tokens for p in pieces], "sequence_id": [p.sequence for p in pieces],
               "offset": [p.offset for p in pieces]}
    return pa.RecordBatch.from_arrays([pa.array(columns[c], t) for c, t in FIELDS.items()], schema=pa.schema(list(FIELDS.items())))


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
         group_tokens: int = GROUP_TOKENS, vocabulary: str = VOCABULARY) -> DataFrame:
    """Pieces of all documents: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)."""
    def run(batches):
        encoding = rank_encoding(vocabulary, SPECIALS)
        packer = Packer(TaskContext.get().partitionId() << 33, capacity, group_tokens)
        for batch in batches:
            pieces = []
            for i, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encoding.encode_to_numpy(value or "", allowed_special="all")
                pieces += packer.document(i, np.append(ids, np.uint32(CLOSING_ID)))
            yield as_batch(pieces)
        yield as_batch(packer.close())

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return common.map_arrow(rows, run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
