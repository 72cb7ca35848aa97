"""Chunking: paragraphs (or sentences) packed in order into chunks with overlap.

Chunks are ranges of consecutive parts, their carried overlap included, and follow from the parts' lengths alone. Where a
chunk ends is a pointer found by binary search in the lengths' running sums, and so is where its overlap begins; ranges
come from following these pointers, in batches of lengths, so the work grows with parts and chunks, however many a
text has. Texts stay where they are.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.functions.config import Domain
from loomline.functions.text import col, let, paragraphs, sentences, strip

RANGES = "array<struct<s:int,e:int>>"


def followed(lengths: list[int], fixed: list[bool] | None, size: int, overlap: int, joint: int, carry_alone: bool) -> list[tuple[int, int]]:
    """(first, last) positions, from 1, of each chunk of parts with these lengths."""
    if not lengths:
        return []
    plain = [0, *accumulate(lengths)]
    weights = [0, *accumulate(n + joint for n in lengths)]
    barrier = [0, *accumulate((i + 1 if f else 0 for i, f in enumerate(fixed)), max)] if fixed is not None else None  # past the last fixed part before
    out, first, at, used = [], 0, 0, lengths[0] + joint
    while True:
        # the first part after `at` that the chunk has no room for
        end = bisect_right(weights, size - used + weights[at + 1], at + 2) - 1
        if end >= len(lengths):
            return [*out, (first + 1, len(lengths))]
        out.append((first + 1, end))
        if overlap > 0 and (carry_alone or end - first > 1):
            first = max(first, bisect_left(plain, plain[end] - overlap, 0, end + 1), barrier[end] if barrier else 0)
            used = plain[end + 1] - plain[first] + joint * (end - first)
        else:
            first, used = end, lengths[end] + joint
        at = end


def pack_ranges(lengths: Column, size: int, overlap: int, joint: int = 2, fixed: Column | None = None, carry_alone: bool = True) -> Column:
    """array of (first, last) positions. joint: what joining costs a part; fixed: parts (booleans) that no overlap reaches over;
    carry_alone: whether a chunk of one part may be carried as overlap. Not for use inside lambdas."""
    def ranges(rows: pa.Array, stops: pa.Array | None) -> pa.Array:
        flat, cuts = rows.flatten().to_pylist(), [0, *accumulate(n or 0 for n in rows.value_lengths().to_pylist())]
        halts = stops.flatten().to_pylist() if stops is not None else None
        found = [followed(flat[a:b], halts[a:b] if halts is not None else None, size, overlap, joint, carry_alone) for a, b in zip(cuts, cuts[1:])]
        pairs = np.array([p for f in found for p in f], np.int32).reshape(-1, 2)
        both = pa.StructArray.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["s", "e"])
        return pa.ListArray.from_arrays(pa.array([0, *accumulate(map(len, found))], pa.int32()), both)

    if fixed is None:

        @F.arrow_udf(RANGES)
        def packed(rows: pa.Array) -> pa.Array:
            return ranges(rows, None)

        return packed(lengths)

    @F.arrow_udf(RANGES)
    def packed_between(rows: pa.Array, stops: pa.Array) -> pa.Array:
        return ranges(rows, stops)

    return packed_between(lengths, fixed)


def _joined(parts: Column, ranges: Column, sep: str) -> Column:
    return let(F.struct(parts.alias("p"), ranges.alias("r")), lambda x: F.transform(x["r"], lambda r: F.array_join(F.slice(x["p"], r["s"], r["e"] - r["s"] + 1), sep)))


def _short(text: Column | str, size: int, long: Column) -> Column:
    text = F.coalesce(col(text), F.lit(""))
    return F.when(strip(text) == "", F.array().cast("array<string>")).when(F.length(text) <= size, F.array(strip(text))).otherwise(long)


def _lengths(parts: Column, text: Column | str, size: int) -> Column:
    """Of the parts of a text that has to be cut."""
    return F.when(F.length(col(text)) > size, F.transform(parts, F.length)).otherwise(F.array().cast("array<int>"))


def chunks(text: Column | str, size: int = 1000, overlap: int = 200, separator: str = "\n\n+") -> Column:
    """array of chunks of whole paragraphs; one longer than size stays whole."""
    parts = paragraphs(text, separator)
    return _short(text, size, _joined(parts, pack_ranges(_lengths(parts, text, size), size, overlap), "\n\n"))


def structured_chunks(text: Column | str, size: int = 1000, overlap: int = 200, domain: Domain = Domain(), separator: str = "\n\n+") -> Column:
    """As chunks(), but the overlap stops at structured paragraphs."""
    parts = paragraphs(text, separator)
    fixed = F.when(F.length(col(text)) > size, F.transform(parts, domain.structured)).otherwise(F.array().cast("array<boolean>"))
    return _short(text, size, _joined(parts, pack_ranges(_lengths(parts, text, size), size, overlap, fixed=fixed), "\n\n"))


def sentence_chunks(text: Column | str, size: int = 1000, overlap: int = 200) -> Column:
    """Sentences of over ten characters, packed; without any, the text itself."""
    parts = F.filter(F.transform(sentences(F.coalesce(col(text), F.lit(""))), strip), lambda x: F.length(x) > 10)
    made = _joined(parts, pack_ranges(_lengths(parts, text, size), size, overlap, joint=1, carry_alone=False), " ")
    return _short(text, size, F.when(F.size(made) == 0, F.array(col(text))).otherwise(made))


def exploded(df: DataFrame, made: Column, name: str = "chunk") -> DataFrame:
    """One row a chunk, with its position `seq`."""
    return df.withColumn("_chunks", made).select("*", F.posexplode("_chunks").alias("seq", name)).drop("_chunks")
