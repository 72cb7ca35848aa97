"""Vectorised text primitives over Arrow batches, and the shared scratch folder.

Words are maximal runs of bytes other than space, \\t, \\n, \\v, \\f and \\r. A null text counts as empty.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

PIECE_BYTES, BATCH_BYTES = 1 << 20, 8 << 20
U64 = np.uint64

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def scratch(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, a temporary one if all run on one machine (tests); a cluster has to name it."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError(f"set spark.checkpoint.dir to a folder that the driver and the executors of {master} share")
    path = f"file://{tempfile.gettempdir()}/loomline-checkpoints"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """The session's settings (dots as double underscores) while the block runs; then they are as before."""
    values = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def short_batches(df: DataFrame) -> DataFrame:
    """df, with its session's Arrow batches kept to BATCH_BYTES: texts are long, and workers hold a batch and what they make of it.

    Spark reads the setting when the plan runs, which is after this returns, so a session that uses these operators keeps it.
    """
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    now = re.fullmatch(r"(\d+)b?", conf.get(name))
    if not now or int(now[1]) > BATCH_BYTES:
        conf.set(name, str(BATCH_BYTES))
    return df


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{scratch(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str, by: tuple[str, ...] = (), **options: str) -> DataFrame:
    """df, written under path (in a folder for each value of `by`) and read again. The write's shuffle files go when it has ended."""
    with settings(df.sparkSession, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        df.write.partitionBy(*by).options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a table in the shared folder; forget() drops it."""
    path = fresh_path(df.sparkSession, "cut")
    out = stored(df, path)
    out._cut_at = path
    return out


def forget(*tables: DataFrame) -> None:
    """Drop tables that cut() wrote, once nothing reads them any more."""
    for t in tables:
        drop_path(t.sparkSession, t._cut_at)


def drop_path(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def quoted(name: str) -> str:
    """A column's name as Spark takes it, whatever is in it."""
    return "`" + name.replace("`", "``") + "`"


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes in one array, and offsets of each text in it."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    buf = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, offsets - offsets[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most `limit` bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = utf8(batch.column(column))
        at = 0
        while at < batch.num_rows:
            end = min(at + 50_000, max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1))
            yield batch.slice(at, end - at)
            at = end


def word_spans(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, per-document offsets into them) of all words; no word crosses documents."""
    return marked_spans(~_SPACE[buf], offsets)


def marked_spans(word: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, per-document offsets into them) of all maximal runs of marked bytes; no run crosses documents. `word` is used up."""
    if not len(word):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    edge = np.zeros(len(word) + 1, bool)
    edge[offsets] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | edge[1:-1]
    last = word
    last[:-1] = word[:-1] & (~last[1:] | edge[1:-1])
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def span_codes(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(a number for each of the strings that lie end to end in data, the distinct strings by number); equal numbers are equal bytes."""
    offsets = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    strings = pa.LargeStringArray.from_buffers(len(lengths), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))
    coded = strings.dictionary_encode()
    return np.asarray(coded.indices, np.int64), coded.dictionary


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


_ODD, _STEP = U64(0xD6E8FEB86659FD93), U64(0x9E3779B97F4A7C15)
_LONG, _RUN = 256, 32  # bytes of a word hashed one eight after another; blocks of longer ones


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """A hash of the bytes of each span, eight at a time through mix(): no pattern of bytes makes it collide. Spans longer
    than _LONG are hashed as sequences of their blocks."""
    n = ends - starts
    padded = np.zeros(len(buf) + 8, np.uint8)
    padded[: len(buf)] = buf
    eights = np.ndarray(len(buf) + 1, "<u8", padded, strides=(1,))
    at = np.flatnonzero(n > 0) if (n <= _LONG).all() else np.flatnonzero((n > 0) & (n <= _LONG))
    with np.errstate(over="ignore"):
        out = mix(n.astype(U64) * _STEP + U64(seed))
        for k in range(0, _LONG, 8):
            if k:
                at = at[n[at] > k]
            if not len(at):
                break
            left = np.minimum(n[at] - k, 8)
            out[at] = mix(out[at] ^ (eights[starts[at] + k] & (U64(2**64 - 1) >> (U64(64) - left.astype(U64) * U64(8)))) * _ODD)
        long = np.flatnonzero(n > _LONG)
        if len(long):
            blocks = -(-n[long] // _RUN)
            first = np.cumsum(blocks) - blocks
            a = np.repeat(starts[long], blocks) + (np.arange(blocks.sum()) - np.repeat(first, blocks)) * _RUN
            inner = span_hashes(buf, a, np.minimum(a + _RUN, np.repeat(ends[long], blocks)), seed + 1)
            out[long] = mix(out[long] + sequence_hashes(inner, np.append(first, blocks.sum()), seed + 2))
    return out


def sequence_hashes(symbols: np.ndarray, offsets: np.ndarray, seed: int) -> np.ndarray:
    """A hash of each sequence of hashed symbols, from one of offsets to the next: sums of mixed (symbol, place) pairs."""
    n = np.diff(offsets)
    with np.errstate(over="ignore"):
        place = (np.arange(len(symbols)) - np.repeat(offsets[:-1], n)).astype(U64)
        sums = np.zeros(len(symbols) + 1, U64)
        np.cumsum(mix(symbols ^ mix(place * _STEP + U64(seed))), out=sums[1:])
        return mix(sums[offsets[1:]] - sums[offsets[:-1]] + n.astype(U64) * _STEP)


def window_hashes(symbols: np.ndarray, width: int, seed: int) -> np.ndarray:
    """A hash of each run of `width` hashed symbols, by start, put together from runs of powers of two. Runs may cross documents: mask them."""
    n = len(symbols) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    with np.errstate(over="ignore"):
        run, have, at, out = mix(symbols + U64(seed)), 1, 0, None
        while True:
            if width & have:
                part = run[at : at + n]
                out = part if out is None else mix(out * _ODD + part)
                at += have
            if 2 * have > width:
                return out
            run = mix(run[:-have] * _ODD + run[have:])
            have *= 2


class Rolling:
    """Polynomial hashes modulo 2**64 of any spans of a sequence, from one running sum. Patterns of 1,024 symbols and more
    can make them collide: where equality is decided, use the functions above.

    Symbols go through a seeded random table (bytes) or are random 64-bit values already (word hashes).
    """

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.table = rng.integers(0, 2**64, 256, dtype=U64)
        self.base = U64(int(rng.integers(0, 2**61)) * 8 + 5)
        self.inverse = U64(pow(int(self.base), -1, 2**64))
        self.up, self.down = np.ones(1, U64), np.ones(1, U64)

    def _grow(self, n: int) -> None:
        with np.errstate(over="ignore"):
            while len(self.up) <= n:
                m = len(self.up)
                self.up = np.concatenate([self.up, self.up * (self.up[-1] * self.base)])
                self.down = np.concatenate([self.down, self.down * (self.down[-1] * self.inverse)])
                assert len(self.up) == 2 * m

    def sums(self, symbols: np.ndarray) -> np.ndarray:
        values = self.table[symbols] if symbols.dtype == np.uint8 else symbols
        self._grow(len(values) + 1)
        out = np.zeros(len(values) + 1, U64)
        with np.errstate(over="ignore"):
            np.cumsum(values * self.up[: len(values)], out=out[1:])
        return out

    def spans(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(U64))

    def words(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return self.spans(self.sums(buf), starts, ends)

    def windows(self, symbols: np.ndarray, width: int) -> np.ndarray:
        """The hash of each run of `width` symbols, by start; runs may cross documents: mask them."""
        n = len(symbols) - width + 1
        if n <= 0:
            return np.zeros(0, U64)
        sums = self.sums(symbols)
        with np.errstate(over="ignore"):
            return mix((sums[width:] - sums[:n]) * self.down[:n])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` consecutive values."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def list_array(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
