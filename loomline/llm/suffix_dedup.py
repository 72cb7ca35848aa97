"""Suffix-array dedup: bytes covered by a 50-byte string that also starts in a document with a smaller doc_id go.

1. Texts are laid out in batches of some MB, one compressed row each, so that every later pass sees the same batch
   and only compressed texts are shuffled.
2. Each batch lists the anchors of its windows (anchors.py: about one in fourteen bytes), 40 bits each, dealt by
   value; a value that two documents share is marked in its batches by one bit. Windows with other anchors can't
   repeat and leave the job here.
3. Runs of windows with a marked anchor are compared by anchor. Runs that are equal throughout need only the least
   doc_id. Runs that share an anchor but differ (a passage's ends) are decided by their suffixes: one run of each
   kind, cut to the bytes around which it may share a window (`narrowed`), goes to a shard, shards' Burrows-Wheeler transforms are merged by interleave refinement to depth 50, and
   the intervals of suffixes with a common prefix of 50 give each window's least doc_id (bwt.py), byte for byte.
4. The removed ranges meet their batches' texts.

Hot values reach a reducer once a batch, not once a document; runs are combined by kind before their texts are
compared; joins on anchors are sort-merge joins that Spark can split. An anchor with more than HOT_KINDS kinds (a
phrase with many surroundings) gives way to finer ones: each run is cut by its windows' places around the anchor, and
a cut's anchor is the 48 bytes that all its windows hold, so that no bucket of transforms grows with one phrase.

Runs' equality is that of two 64-bit hashes, of the anchor and of all their bytes.

Defined results: a null or empty text has no bytes; repeated rows (same doc_id) aren't each other's smaller ids and
get equal results; a null doc_id counts as greater than any; an empty table gives no rows; columns beside those
named are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.llm.anchors import runs
from loomline.llm.bwt import repeats
from loomline.llm.minhash_dedup import by_group
from loomline.llm.textops import U64, drop_path, fresh_path, mix, pieces, short_batches, signed, stored, utf8
from loomline.sources.readers import read_table

WINDOW, GRAM, BATCH_BYTES, PART_BYTES, BUCKET_RUNS = 50, 24, 2 << 20, 32 << 20, 4000
HOT_KINDS, PLACES, MOST_TASKS = 2000, 3, 4000  # a finer anchor is that of PLACES consecutive windows
_BITS = U64(40)  # a value has the lower 40 bits of a hash: the upper ones of least hashes lie close together
_VALUE = U64((1 << 40) - 1)
LAST = (1 << 63) - 1
RUN, RUN_SCHEMA = ["doc", "row", "fp", "words", "start", "n", "at"], "doc long, row long, fp long, words long, start int, n int, at int"


def eights(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as a number, without a copy."""
    return np.ndarray((max(0, len(buf) - 7),), "<u8", np.ascontiguousarray(buf), 0, (1,))


def hashed(words: np.ndarray, *at: np.ndarray) -> np.ndarray:
    """A hash of the eights at these positions."""
    out = np.zeros(len(at[0]), U64)
    with np.errstate(over="ignore"):
        for i in at:
            out = mix(out) + words[i] * U64(0xD6E8FEB86659FD93)
        return mix(out)


def grams_of(buf: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each position: the mixed eights in it, each times an odd number of its own."""
    n = len(buf) - GRAM + 1
    if n <= 0:
        return np.zeros(0, U64)
    with np.errstate(over="ignore"):
        mixed = eights(buf) * U64(0x9E3779B97F4A7C15)
        half = np.empty_like(mixed)
        for right, odd in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, None)):  # mix(), in place
            np.right_shift(mixed, U64(right), out=half)
            np.bitwise_xor(mixed, half, out=mixed)
            if odd:
                np.multiply(mixed, U64(odd), out=mixed)
        out, more = mixed[:n].copy(), half[:n]
        for at, odd in zip(range(8, GRAM, 8), (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)):
            out += np.multiply(mixed[at : at + n], U64(odd), out=more)
        return out


def words_of(buf: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of all bytes from a to b, at least eight and at most a run's."""
    longest = int((b - a).max(initial=0))
    return hashed(eights(buf), *(np.minimum(a + k, b - 8) for k in range(0, longest, 8))) + (b - a).astype(U64) if longest else np.zeros(0, U64)


def lay_out(docs: DataFrame, path: str) -> DataFrame:
    """One row a batch: its number, documents' ids, offsets and compressed bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 20
        for piece in pieces(batches, limit=BATCH_BYTES):
            buf, offsets = utf8(piece.column("text"))
            packed = pa.compress(buf.tobytes(), "zstd", asbytes=True) if len(buf) else b""
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([piece.column("doc").to_pylist()], pa.list_(pa.int64())), pa.array([offsets.tolist()], pa.list_(pa.int64())), pa.array([packed], pa.binary()), pa.array([len(buf)], pa.int64())], ["batch", "docs", "offsets", "packed", "size"])
            number += 1

    return stored(docs.select("doc", "text").transform(short_batches).mapInArrow(run, "batch long, docs array<long>, offsets array<long>, packed binary, size long"), path, compression="none")


def batch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list, np.ndarray, np.ndarray, dict]]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {n: batch.column(n)[i] for n in batch.schema.names}
            size = row["size"].as_py()
            buf = np.frombuffer(pa.decompress(row["packed"].as_py(), size, "zstd", asbytes=True), np.uint8) if size else np.zeros(0, np.uint8)
            yield row["batch"].as_py(), row["docs"].as_py(), np.array(row["offsets"].as_py(), np.int64), buf, row


def batch_runs(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(document, start, windows, anchor hash, distinct values in order, each run's place in them, and the anchor's distance from the start) of a batch, in cache-sized parts."""
    out = []
    at = 0
    while at < len(offsets) - 1:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + (1 << 17), "right")) - 1)
        part = buf[offsets[at] : offsets[end]]
        grams = grams_of(part)
        doc, start, n, anchor = runs(grams, offsets[at : end + 1] - offsets[at], WINDOW, GRAM)
        if len(doc):
            out.append((doc + at, start + offsets[at], n, grams[anchor], anchor - start))
        at = end
    if not out:
        z = np.zeros(0, np.int64)
        return z, z, z, z.view(U64), z.view(U64), z, z
    doc, start, n, h, off = (np.concatenate(x) for x in zip(*out))
    values, place = np.unique(h & _VALUE, return_inverse=True)
    return doc, start, n, h, values, place, off


def dealt(values: np.ndarray, parts: int) -> np.ndarray:
    """Where each part's values begin, and the last one's end: parts are equal ranges of values."""
    return np.searchsorted((values * U64(parts)) >> _BITS, np.arange(parts + 1, dtype=U64))


def _five(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _from_five(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(blob, np.uint8).reshape(-1, 5)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :5] = raw
    return out.view("<u8").ravel()


def _shared_within(doc: np.ndarray, place: np.ndarray, n_values: int) -> np.ndarray:
    """Which values two documents of the batch share."""
    first = np.full(n_values, np.iinfo(np.int64).max)
    last = np.full(n_values, -1)
    np.minimum.at(first, place, doc)
    np.maximum.at(last, place, doc)
    return first < last


def mark(batches: DataFrame, parts: int) -> DataFrame:
    """(batch, part, bits): for each value a batch sent to a part, in its order, whether another batch sent it too."""
    def send(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, _, offsets, buf, _ in batch_rows(rows):
            values = batch_runs(buf, offsets)[4]
            edges = dealt(values, parts)
            used = np.flatnonzero(np.diff(edges))
            blobs = [_five(values[edges[p] : edges[p + 1]]) for p in used]
            yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(np.full(len(used), number)), pa.array(blobs, pa.binary())], ["part", "batch", "sent"])

    def meet(table: pa.Table) -> list[tuple]:
        lists = [_from_five(b) for b in table.column("sent").to_pylist()]
        every = np.sort(np.concatenate(lists))
        twice = every[1:][every[1:] == every[:-1]]
        p = table.column("part")[0].as_py()
        out = []
        for number, x in zip(table.column("batch").to_pylist(), lists):
            bits = twice[np.minimum(np.searchsorted(twice, x), len(twice) - 1)] == x if len(twice) else np.zeros(len(x), bool)
            out.append((number, p, np.packbits(bits).tobytes()))
        return out

    sent = batches.transform(short_batches).mapInArrow(send, "part int, batch long, sent binary")
    return by_group(sent, ["part"], meet, "batch long, part int, bits binary", [pa.int64(), pa.int32(), pa.binary()], parts)


def shared_runs(batches: DataFrame, bits: DataFrame, parts: int) -> DataFrame:
    """(doc, row, fp, words, start, n, at): one row a run with a marked anchor, `at` bytes after its start. row: the batch's number << 16 | the document's place in it."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, docs, offsets, buf, fields in batch_rows(rows):
            doc, start, n, h, values, place, off = batch_runs(buf, offsets)
            marked = _shared_within(doc, place, len(values)) if len(values) else np.zeros(0, bool)
            edges = dealt(values, parts)
            for x in fields["marks"].as_py() or []:
                mine = marked[edges[x["part"]] : edges[x["part"] + 1]]
                mine |= np.unpackbits(np.frombuffer(x["bits"], np.uint8), count=len(mine)).astype(bool)
            use = np.flatnonzero(marked[place]) if len(place) else np.zeros(0, np.int64)
            ids = np.array([LAST if d is None else d for d in docs], np.int64)
            d, words = doc[use], words_of(buf, start[use], start[use] + n[use] + WINDOW - 1)
            yield pa.RecordBatch.from_arrays([pa.array(ids[d]), pa.array((number << 16) + d), pa.array(signed(h[use])), pa.array(signed(words)), pa.array((start[use] - offsets[d]).astype(np.int32)), pa.array(n[use].astype(np.int32)), pa.array(off[use].astype(np.int32))], RUN)

    marks = bits.groupBy("batch").agg(F.collect_list(F.struct("part", "bits")).alias("marks"))  # at most one a part
    return with_lists(batches, marks).transform(short_batches).mapInArrow(run, RUN_SCHEMA)


def with_lists(batches: DataFrame, lists: DataFrame, how: str = "left") -> DataFrame:
    """batches beside what was found for each; a list is bounded by its batch."""
    return batches.join(lists.hint("shuffle_hash"), "batch", how)


def by_batch(found: DataFrame, *fields: str) -> DataFrame:
    """(batch, marks): found's rows by batch, each with its document's place `i`."""
    return found.groupBy(F.shiftright("row", 16).alias("batch")).agg(F.collect_list(F.struct(F.col("row").bitwiseAND(0xFFFF).cast("int").alias("i"), *fields)).alias("marks"))


def finer(batches: DataFrame, found: DataFrame) -> DataFrame:
    """Runs cut by their windows' places around the anchor, PLACES to a cut, which gets the hash of the bytes that all its windows hold for an anchor. Equal windows are in cuts of one anchor."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, docs, offsets, buf, fields in batch_rows(rows):
            i, start, n, at = (np.asarray(fields["marks"].values.field(k), np.int64) for k in range(4))
            base, words8 = offsets[i] + start, eights(buf)
            ids = np.array([LAST if d is None else d for d in docs], np.int64)
            for place in range(0, WINDOW - GRAM + 1, PLACES):
                first, last = np.maximum(0, at - place - PLACES + 1), np.minimum(n - 1, at - place)
                use = np.flatnonzero(first <= last)
                a, b, core = base[use] + first[use], base[use] + last[use] + WINDOW, base[use] + at[use] - place
                fp = hashed(words8, *(core + k for k in range(0, WINDOW - PLACES + 1, 8)))  # 48 bytes
                words = hashed(words8, *(a + k for k in range(0, WINDOW - 8, 8)), b - 8) + (b - a).astype(U64)  # all of its 50 to 52
                yield pa.RecordBatch.from_arrays([pa.array(ids[i[use]]), pa.array((number << 16) + i[use]), pa.array(signed(fp)), pa.array(signed(words)), pa.array((start + first)[use].astype(np.int32)), pa.array((last - first + 1)[use].astype(np.int32)), pa.array((at - first)[use].astype(np.int32))], RUN)

    return with_lists(batches, by_batch(found, "start", "n", "at"), "inner").transform(short_batches).mapInArrow(run, RUN_SCHEMA)


def placed_runs(runs_of: DataFrame, name: str) -> DataFrame:
    """(row, start, n, mixed, doc, fp, words, at) of the runs that may lose windows, or decide on others': those of an anchor that documents share. The last four only where the anchor's runs differ."""
    spark = runs_of.sparkSession
    anchors = runs_of.groupBy("fp").agg(F.min("words").alias("w0"), F.max("words").alias("w1"), F.min("doc").alias("d0"), F.max("doc").alias("d1"))
    # an anchor of one document decides nothing
    path = fresh_path(spark, f"suffix-anchors{name}")
    anchors = stored(anchors.where("d0 <> d1").select("fp", "d0", (F.col("w0") != F.col("w1")).alias("mixed")), path)
    keep = lambda c: F.when(F.col("mixed"), F.col(c)).alias(c)
    met = runs_of.join(anchors, "fp").where("mixed or doc > d0")
    placed = stored(met.select("row", "start", "n", "mixed", *map(keep, ("doc", "fp", "words", "at"))), fresh_path(spark, f"suffix-placed{name}"))
    drop_path(spark, path)
    return placed


def kinds_of(mixed: DataFrame, name: str) -> DataFrame:
    """(fp, words, low, row, start, n, at): each kind of run with its least document and one place."""
    # any place serves, as its bytes are those of all; firsts are of one row, and are hashed where a least struct would be sorted
    made = mixed.groupBy("fp", "words").agg(F.min("doc").alias("low"), *(F.first(c).alias(c) for c in ("row", "start", "n", "at")))
    return stored(made, fresh_path(mixed.sparkSession, f"suffix-kinds{name}"))


def narrowed(runs_of: list[bytes], at: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each run the first and the end of the bytes that may hold a window of another run with the same anchor and another least document; the end is 0 where none may.

    The anchor lies `at` bytes after a run's start. Windows that have it at PLACES consecutive places hold 48 bytes around
    it, the same ones if they are equal. Runs that share these with none have no equal window there.
    """
    size = np.array([len(x) for x in runs_of], np.int64)
    base, n, words8 = np.cumsum(size) - size, size - WINDOW + 1, eights(np.frombuffer(b"".join(runs_of), np.uint8))
    found = []
    for place in range(0, WINDOW - GRAM + 1, PLACES):
        first, last = np.maximum(0, at - place - PLACES + 1), np.minimum(n - 1, at - place)
        use = np.flatnonzero(first <= last)
        core = base[use] + at[use] - place
        found.append((use, first[use], last[use], hashed(words8, *(core + k for k in range(0, WINDOW - PLACES + 1, 8)))))
    run, first, last, key = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(key)
    heads = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1]))[: len(order)]
    own = low[run[order]]
    differ = np.minimum.reduceat(own, heads) < np.maximum.reduceat(own, heads) if len(heads) else np.zeros(0, bool)
    use = order[np.repeat(differ, np.diff(np.append(heads, len(order))))]
    a, b = np.full(len(size), np.iinfo(np.int64).max), np.zeros(len(size), np.int64)
    np.minimum.at(a, run[use], first[use])
    np.maximum.at(b, run[use], last[use] + WINDOW)
    return a, b


def mixed_windows(kinds: DataFrame, batches: DataFrame, buckets: int) -> DataFrame:
    """(fp, words, a, b): the byte ranges of each kind of run that are covered by windows which also start in a run of the same anchor with a lower doc_id. kinds: (fp, words, low, row, start, n, at)."""
    def fetch(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, offsets, buf, fields in batch_rows(rows):
            flat = fields["marks"].values
            i, fp, words, low, start, n, at = (flat.field(k) for k in range(7))
            a = offsets[np.asarray(i)] + np.asarray(start)
            b, text = a + np.asarray(n) + WINDOW - 1, buf.tobytes()
            yield pa.RecordBatch.from_arrays([fp, words, low, at, pa.array([text[x:y] for x, y in zip(a.tolist(), b.tolist())], pa.binary())], ["fp", "words", "low", "at", "run"])

    def decide(table: pa.Table) -> list[tuple]:
        low, texts = np.asarray(table.column("low")), table.column("run").to_pylist()
        first, end = narrowed(texts, np.asarray(table.column("at"), np.int64), low)
        use = np.flatnonzero(end)
        string, at = repeats([texts[i][x:y] for i, x, y in zip(use.tolist(), first[use].tolist(), end[use].tolist())], low[use], WINDOW)
        kind, at = use[string], at + first[use][string]
        heads = np.flatnonzero(np.append(True, (kind[1:] != kind[:-1]) | (at[1:] != at[:-1] + 1)))[: len(at)]  # ranges of consecutive windows
        kind, a, b = kind[heads], at[heads], at[np.append(heads[1:], len(at)) - 1][: len(heads)] + WINDOW
        fp, words = (np.asarray(table.column(c))[kind] for c in ("fp", "words"))
        return list(zip(*(x.tolist() for x in (fp, words, a, b))))

    runs_of = with_lists(batches, by_batch(kinds, "fp", "words", "low", "start", "n", "at"), "inner").transform(short_batches).mapInArrow(fetch, "fp long, words long, low long, at int, run binary")
    runs_of = runs_of.withColumn("bucket", F.pmod(F.xxhash64("fp"), F.lit(buckets)).cast("int"))
    return by_group(runs_of, ["bucket"], decide, "fp long, words long, a long, b long", [pa.int64()] * 4, min(buckets, MOST_TASKS))


def cut_out(batches: DataFrame, gone: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) from batches and removed ranges (row, a, b)."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, docs, offsets, buf, fields in batch_rows(rows):
            step = np.zeros(len(buf) + 1, np.int32)
            if fields["marks"].is_valid:
                i, a, b = (np.asarray(fields["marks"].values.field(k), np.int64) for k in range(3))
                np.add.at(step, offsets[i] + a, 1)
                np.add.at(step, offsets[i] + b, -1)
            kept = np.cumsum(step[:-1], dtype=np.int32) == 0
            gone_at = ~kept
            head = gone_at.copy()
            edge = np.zeros(len(buf) + 1, bool)
            edge[offsets] = True
            head[1:] &= kept[:-1] | edge[1:-1]
            sums = [np.concatenate([np.zeros(1, np.int32), np.cumsum(x, dtype=np.int32)]) for x in (gone_at, head)]
            removed, spans = (x[offsets[1:]] - x[offsets[:-1]] for x in sums)
            left = buf[kept].tobytes()
            at = offsets - sums[0][offsets]
            sha = [hashlib.sha256(left[x:y]).hexdigest() for x, y in zip(at.tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha, pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return with_lists(batches, by_batch(gone, "a", "b")).transform(short_batches).mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def deduplicate(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each row."""
    spark = df.sparkSession
    found_at, decided_at = (fresh_path(spark, f"suffix-{n}") for n in ("runs", "windows"))
    batches = lay_out(df.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text")), fresh_path(spark, "suffix-batches"))
    size = batches.agg(F.sum("size")).first()[0] or 0
    parts = max(8, int(size // PART_BYTES))
    placed = placed_runs(stored(shared_runs(batches, mark(batches, parts), parts), found_at), "")
    drop_path(spark, found_at)
    kinds, mixed, later = kinds_of(placed.where("mixed"), ""), placed.where("mixed"), placed.where("not mixed")
    # tables of their own, so that joins with them are broadcast by their size or split by Spark
    hot = stored(kinds.groupBy("fp").count().where(F.col("count") > HOT_KINDS).select("fp"), fresh_path(spark, "suffix-hot"))
    if not hot.isEmpty():
        cuts = placed_runs(stored(finer(batches, mixed.join(hot, "fp")), found_at), "-finer")
        drop_path(spark, found_at)
        kinds = stored(kinds.join(hot, "fp", "left_anti").union(kinds_of(cuts.where("mixed"), "-finer")), fresh_path(spark, "suffix-all-kinds"))
        mixed = mixed.join(hot, "fp", "left_anti").select(placed.columns).union(cuts.where("mixed"))
        later = later.union(cuts.where("not mixed"))
    decided = stored(mixed_windows(kinds, batches, max(8, kinds.count() // BUCKET_RUNS)), decided_at)
    # windows decide for the least document of a kind; all later ones lose the whole run
    ranges = decided.groupBy("fp", "words").agg(F.collect_list(F.struct(F.col("a").cast("int").alias("a"), F.col("b").cast("int").alias("b"))).alias("ranges"))  # at most a run's length
    whole = F.array(F.struct(F.lit(0).alias("a"), (F.col("n") + WINDOW - 1).cast("int").alias("b")))
    # a table of its own: Spark then splits what a hot kind brings to the join
    lows = stored(kinds.select("fp", "words", "low").join(ranges, ["fp", "words"], "left"), fresh_path(spark, "suffix-lows"))
    drop_path(spark, decided_at)
    known = mixed.join(lows, ["fp", "words"])
    gone = known.select("row", "start", F.explode(F.when(F.col("doc") > F.col("low"), whole).otherwise(F.col("ranges"))).alias("r")).select("row", (F.col("start") + F.col("r.a")).alias("a"), (F.col("start") + F.col("r.b")).alias("b"))
    return cut_out(batches, later.select("row", F.col("start").alias("a"), (F.col("start") + F.col("n") + WINDOW - 1).alias("b")).union(gone))


def op3_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return deduplicate(read_table(spark, f"{sf_dir}/documents.parquet"))


OP3_SQL = """
with t as (select doc_id, hex(encode(coalesce(text, ''))) as x from documents),
s as (select doc_id, i, md5(substr(x, 2 * i + 1, 100)) as h from (select doc_id, x, unnest(range(0, len(x) // 2 - 49)) as i from t where len(x) >= 100)),
m as (select h, min(doc_id) as d from s group by h),
g as (select doc_id, i, case when i - lag(i) over (partition by doc_id order by i) <= 50 then 0 else 1 end as new from s join m using (h) where m.d < doc_id),
r as (select doc_id, min(i) as a, max(i) + 50 as b from (select *, sum(new) over (partition by doc_id order by i) as k from g) group by doc_id, k),
p as (select *, coalesce(lag(b) over (partition by doc_id order by a), 0) as before from r),
q as (select doc_id, count(*) as n_spans, sum(b - a) as n_removed, max(b) as last, string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' order by a) as kept from p join t using (doc_id) group by doc_id)
select t.doc_id, (len(x) // 2)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans,
  sha256(unhex(coalesce(kept, '') || substr(x, 2 * coalesce(last, 0) + 1))) as kept_sha256
from t left join q on q.doc_id = t.doc_id
"""
