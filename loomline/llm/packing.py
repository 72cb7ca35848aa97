"""Packing: hierarchical multi-length packing of token sequences.

Each document is tokenised and gets one end id. Its whole windows of 1024 ids stand alone; what is left of it is
routed to the shortest context size (tier: 1024, 512, 256 or 128 ids) that holds it. Every second one of a tier below
1024 is spare: it may fill gaps of longer windows, so that short tiers also keep documents for windows of their own.
Tiers are packed from the longest to the shortest: a window is opened by a document of its tier, its gap takes the
longest spare pieces of shorter tiers that fit, and the next document of its own tier is cut to close it. A window is
opened only when its tier and the shorter ones hold enough to fill it, so every sequence is as long as its tier says
and nothing is padded. What remains at a partition's end, less than 1024 ids, goes to windows of powers of two.

A step group holds step_sequences * 1024 ids in sequences of one length: 64 of 1024 ids, or 128 of 512, and so on. At
a partition's end what the tiers have over is joined to groups of the same size and mixed lengths, longest first;
only the last one may hold less.

Tiers are packed each time FLUSH documents have been read: one pass, no shuffle, memory bounded by that and by a step
group of each tier.

Defined results: a null or empty text is its end id alone; repeated rows are packed as documents of their own; very
long texts are cut like others, into as many windows as they need; an empty table gives no pieces; columns beside the
key and the text are ignored; ties go by arrival.
"""

from __future__ import annotations

import base64
import zlib
from collections import defaultdict, deque
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.llm.textops import pieces, short_batches
from loomline.sources.readers import read_table

WINDOW, SHORTEST, END_ID, FLUSH, STEP_SEQUENCES = 1024, 128, 0, 8192, 64
SPECIAL, SPECIAL_ID = "<|endoftext|>", 50256


@cache
def encoder(vocabulary: str | None = None):
    """text -> ids of the byte-level BPE. Ranks hold the same vocabulary as byte_bpe_50k.json and encode faster; tests compare both."""
    import public_tokenizers as P
    import tiktoken

    with open(vocabulary or P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    plain = tiktoken.Encoding("byte_bpe_50k", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def encode(text: str) -> list[int]:
        if SPECIAL not in text:
            return plain(text)
        out: list[int] = []
        for i, part in enumerate(text.split(SPECIAL)):
            out += ([SPECIAL_ID] if i else []) + plain(part)
        return out

    return encode


class Packer:
    """Packs the documents it is given. rows: finished pieces (doc, start, ids, doc_tokens, sequence, offset, tier, step group)."""

    def __init__(self, window: int = WINDOW, step: int = STEP_SEQUENCES * WINDOW, first: int = 0, shortest: int = SHORTEST):
        self.window, self.step, self.sequence, self.group = window, step, first, first
        self.sizes = window.bit_length()
        self.least = shortest.bit_length() - 1
        # by size (at most 1, 2, 4, ... ids and more than half of that): documents for windows of their tier, and spare ones
        self.own: list[deque] = [deque() for _ in range(self.sizes)]
        self.spare: list[deque] = [deque() for _ in range(self.sizes)]
        self.routed = [0] * self.sizes
        self.waiting = [0] * self.sizes  # ids
        self.ready: defaultdict[int, list] = defaultdict(list)  # tier -> sequences that wait for their step group
        self.rows: list[tuple] = []

    def _route(self, doc, start: int, ids: np.ndarray, total: int) -> None:
        if len(ids):
            size = (len(ids) - 1).bit_length()
            self.routed[size] += 1
            spare = size < self.least or size < self.sizes - 1 and self.routed[size] % 2 == 0
            (self.spare if spare else self.own)[size].append((doc, start, ids, total))
            self.waiting[size] += len(ids)

    def _emit(self, sequences: list[list[tuple]]) -> None:
        self.rows += [(*piece, self.group) for s in sequences for piece in s]
        self.group += 1

    def _finish(self, tier: int, pieces: list[tuple]) -> None:
        """A full sequence of (doc, start, ids, total); a full step group goes out."""
        at, out = 0, []
        for piece in pieces:
            out.append((*piece, self.sequence, at, tier))
            at += len(piece[2])
        self.sequence += 1
        self.ready[tier].append(out)
        if len(self.ready[tier]) * tier >= self.step:
            self._emit(self.ready.pop(tier))

    def add(self, doc, ids: np.ndarray) -> None:
        whole = len(ids) // self.window * self.window
        for at in range(0, whole, self.window):
            self._finish(self.window, [(doc, at, ids[at : at + self.window], len(ids))])
        self._route(doc, whole, ids[whole:], len(ids))

    def _take(self, queues: list[deque], size: int, room: int) -> tuple:
        """The first piece of that queue, cut to the room; its rest waits again."""
        doc, start, ids, total = queues[size].popleft()
        self.waiting[size] -= len(ids)
        self._route(doc, start + room, ids[room:], total)
        return doc, start, ids[:room], total

    def _fill(self, length: int, top: int) -> None:
        """A sequence of that length from the queues up to `top`, which hold enough."""
        pieces, room = [], length
        while room:
            fits = min(room.bit_length() - 1, top)  # the longest queue whose pieces surely fit
            tier = [(self.own, top), (self.spare, top)]
            gap = [(self.spare, k) for k in range(fits, -1, -1)]
            rest = [(q, k) for k in range(top - 1, -1, -1) for q in (self.spare, self.own)]
            queues, size = next((q, k) for q, k in (*(gap if pieces else ()), *tier, *rest) if q[k])
            pieces.append(self._take(queues, size, room))
            room -= len(pieces[-1][2])
        self._finish(length, pieces)

    def pack(self) -> None:
        """Each tier's windows, from the longest tier on, as long as it and the shorter ones fill them."""
        for top in range(self.sizes - 1, self.least - 1, -1):
            while (self.own[top] or self.spare[top] or top == self.least) and sum(self.waiting[: top + 1]) >= 1 << top:
                self._fill(1 << top, top)

    def end(self) -> None:
        """What is left: windows of powers of two, and step groups of the tiers' leftover sequences."""
        self.pack()
        while left := sum(self.waiting):
            self._fill(min(self.window, 1 << (left.bit_length() - 1)), self.sizes - 1)
        sequences = [(tier, s) for tier in sorted(self.ready, reverse=True) for s in self.ready[tier]]
        self.ready.clear()
        group, held = [], 0
        for tier, s in sequences:  # powers of two from the longest on: a group is full before the next is begun
            group.append(s)
            held += tier
            if held == self.step:
                self._emit(group)
                group, held = [], 0
        if group:
            self._emit(group)

    def out(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()), T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()),
    T.StructField("offset", T.LongType()), T.StructField("tier", T.LongType()), T.StructField("step_group", T.LongType()),
])


def pack(df: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, step_sequences: int = STEP_SEQUENCES, with_ids: bool = False, shortest: int = SHORTEST) -> DataFrame:
    """One row a piece; tier is its sequence's length. sequence_id and step_group are partition << 40 | number in it.
    window and shortest are powers of two, step_sequences the number of whole windows whose ids make a step. with_ids adds the ids (array<int>)."""
    schema = T.StructType([*SCHEMA.fields, *([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else [])])
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = encoder(), Packer(window, step_sequences * window, TaskContext.get().partitionId() << 40, shortest)

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            out = []
            for doc, start, ids, total, seq, at, tier, group in rows:
                row = (doc, start, len(ids), zlib.crc32(ids.tobytes()), total, seq, at, tier, group)
                out.append((*row, ids) if with_ids else row)
            cols = list(zip(*out)) if out else [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.list_(pa.int32()) if n == "ids" else pa.int64()) for c, n in zip(cols, names)], names)

        seen = 0
        for piece in pieces(batches):
            for doc, t in zip(piece.column("key").to_pylist(), piece.column("text").to_pylist()):
                packer.add(doc, np.array([*encode(t or ""), END_ID], "<u4"))
                seen += 1
                if seen % FLUSH == 0:
                    packer.pack()
                if len(packer.rows) >= 20_000:
                    yield batch(packer.out())
        packer.end()
        yield batch(packer.out())

    out = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).transform(short_batches).mapInArrow(run, schema)
    return out if key == "doc_id" else out.withColumnRenamed("doc_id", key)


def op8_pack(spark, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, f"{sf_dir}/documents.parquet"))
