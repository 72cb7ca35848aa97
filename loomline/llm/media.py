"""Media columns: 8-bit grey PNG files in a binary column, and low-frequency cosine-transform hashes of them.

A picture is 24 samples wide. Files are written here chunk by chunk (zlib) and read by a decoder that tests
the signature and each chunk's checksum and undoes all five row filters in numpy. Each row is written under the
cheapest of the filters none, left and above.

Defined results: a null or empty text is one 24x24 picture of 255s; a very long one is a picture of as many rows as it
needs; equal texts and repeated rows give equal files and features; an empty table gives no rows; columns beside the key and the text are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.llm.textops import pieces, short_batches
from loomline.sources.readers import read_table

BLOCK, WIDTH, LEVEL = 576, 24, 1
SIGNATURE = b"\x89PNG\r\n\x1a\n"


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(body, zlib.crc32(kind)))


def png_encode(samples: np.ndarray, row_filter: int | None = 0, level: int = LEVEL) -> bytes:
    """A PNG of a (height, width) uint8 array, all rows under filter 0 (none), 1 (left) or 2 (above), or each under the
    one of these with the least sum of absolute signed values, the first of equals (row_filter None)."""
    height, width = samples.shape
    rows = np.empty((height, width + 1), np.uint8)
    made = np.repeat(samples[None], 3, 0)
    made[1, :, 1:] -= samples[:, :-1]
    made[2, 1:] -= samples[:-1]
    rows[:, 0] = np.abs(made.view(np.int8).astype(np.int16)).sum(2).argmin(0) if row_filter is None else row_filter
    rows[:, 1:] = made[rows[:, 0], np.arange(height)]
    head = struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(rows.tobytes(), level)) + _chunk(b"IEND", b"")


def png_chunks(data: bytes) -> Iterator[tuple[bytes, bytes]]:
    if data[:8] != SIGNATURE:
        raise ValueError("not a PNG: wrong signature")
    at = 8
    while at < len(data):
        if at + 12 > len(data):
            raise ValueError("PNG ends within a chunk")
        (n,) = struct.unpack_from(">I", data, at)
        kind, body = data[at + 4 : at + 8], data[at + 8 : at + 8 + n]
        if len(body) < n or at + 12 + n > len(data) or struct.unpack_from(">I", data, at + 8 + n)[0] != zlib.crc32(data[at + 4 : at + 8 + n]):
            raise ValueError(f"PNG chunk {kind!r} fails its checksum")
        yield kind, body
        at += 12 + n


def unfilter(rows: np.ndarray) -> np.ndarray:
    """Undo the row filters of (height, 1 + width) one-byte samples. Equal runs of rows go at once where rows don't depend on each other."""
    kinds, out = rows[:, 0], rows[:, 1:].copy()
    if kinds.max(initial=0) > 4:
        raise ValueError("unknown PNG row filter")
    left = kinds == 1
    if left.any():
        out[left] = np.cumsum(out[left], axis=1, dtype=np.uint8)
    height, width = out.shape
    heads = np.flatnonzero(np.append(True, kinds[1:] != kinds[:-1])[:height])
    later = kinds[heads] >= 2  # the others are done
    for at, end in zip(heads[later].tolist(), np.append(heads[1:], height)[later].tolist()):
        if kinds[at] == 2:
            first = out[at - 1 : at] if at else np.zeros((1, width), np.uint8)
            out[at:end] = np.cumsum(np.concatenate([first, out[at:end]]), axis=0, dtype=np.uint8)[1:]
        elif kinds[at] > 2:
            for y in range(at, end):
                above = [0, *(out[y - 1].tolist() if y else [0] * width)]
                row, a = out[y].tolist(), 0
                for x in range(width):
                    b, c = above[x + 1], above[x]
                    if kinds[at] == 3:
                        guess = (a + b) // 2
                    else:
                        pa_, pb, pc = abs(b - c), abs(a - c), abs(a + b - 2 * c)
                        guess = a if pa_ <= pb and pa_ <= pc else b if pb <= pc else c
                    row[x] = a = (row[x] + guess) & 255
                out[y] = row
    return out


def png_decode(data: bytes) -> np.ndarray:
    """The (height, width) samples of an 8-bit grey, non-interlaced PNG; ValueError for anything damaged."""
    head, body, ended = None, [], False
    for kind, part in png_chunks(data):
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", part)
        elif kind == b"IDAT":
            body.append(part)
        ended |= kind == b"IEND"
    if not head or not ended or head[2:] != (8, 0, 0, 0, 0):
        raise ValueError("not a complete 8-bit grey PNG")
    width, height = head[:2]
    rows = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8)
    if len(rows) != height * (width + 1):
        raise ValueError("PNG holds another number of samples than its header says")
    return unfilter(rows.reshape(height, width + 1))


def _cosines(n: int, keep: int) -> np.ndarray:
    return np.cos(np.pi * np.outer(np.arange(keep), np.arange(n) + 0.5) / n)


GRID, KEEP = 24, 8
_C = _cosines(GRID, KEEP)


def cosine_hash(samples: np.ndarray) -> str:
    """64 bits in hex: the 8x8 lowest cosine frequencies of the picture's 24x24 cell means, each against their median (the constant term left out of the median)."""
    height, width = samples.shape
    ys, xs = (np.arange(GRID) * n // GRID for n in (height, width))
    cells = np.add.reduceat(np.add.reduceat(samples, ys, 0, dtype=np.int64), xs, 1)
    area = np.outer(np.diff(np.append(ys, height)), np.diff(np.append(xs, width)))
    low = np.round(_C @ (cells / np.maximum(area, 1)) @ _C.T, 6).ravel()
    bits = low > np.median(low[1:])
    return np.packbits(bits).tobytes().hex()


def payload(text: bytes) -> bytes:
    return text + b"\xff" * (-len(text) % BLOCK if text else BLOCK)


def encode_media(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, media binary): each text's padded UTF-8 bytes as the samples of a PNG."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            raw = [(t or "").encode() for t in piece.column("text").to_pylist()]
            media = [png_encode(np.frombuffer(payload(x), np.uint8).reshape(-1, WIDTH), None) for x in raw]
            yield pa.RecordBatch.from_arrays([piece.column("key"), pa.array([len(x) for x in raw], pa.int64()), pa.array(media, pa.binary())], ["key", "n_bytes", "media"])

    source = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = T.StructType([source.schema["key"], T.StructField("n_bytes", T.LongType()), T.StructField("media", T.BinaryType())])
    return source.transform(short_batches).mapInArrow(run, schema).withColumnRenamed("key", key)


def media_features(df: DataFrame, key: str = "doc_id", media: str = "media", others: tuple[str, ...] = ()) -> DataFrame:
    """Decode each file and describe its samples and its bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for x in batch.column("media").to_pylist():
                samples = png_decode(x)
                body = samples.tobytes()
                rows.append((len(body), hashlib.sha256(body).hexdigest(), zlib.crc32(body[-32:]), len(x), hashlib.sha256(x).hexdigest(), cosine_hash(samples)))
            cols = list(zip(*rows)) if rows else [()] * 6
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names[:-1]), *map(pa.array, cols, kinds)], [*names[:-1], *out])

    names = ["key", *others, "media"]
    out = ("payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")
    source = df.select(F.col(key).alias("key"), *others, F.col(media).alias("media"))
    fields = [T.StructField(n, T.StringType() if n.endswith("sha256") or n == "feature" else T.LongType()) for n in out]
    return source.transform(short_batches).mapInArrow(run, T.StructType([*source.schema.fields[:-1], *fields])).withColumnRenamed("key", key)


def op5_media(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return media_features(encode_media(docs), others=("n_bytes",))
