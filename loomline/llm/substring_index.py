"""Substring dedup by a log-structured fingerprint index.

A window's fingerprint is its anchor, the least hashed gram of GRAM words in it (anchors.py); consecutive windows with
one anchor occurrence are one entry, with a hash of all its words. FingerprintIndex keeps immutable runs: one row a
fingerprint, with how often it occurs and the least and greatest hash of its entries, bucketed and sorted by
fingerprint. Each new batch of documents becomes a run, which is merge-joined with the runs before it, without a
shuffle or a sort; FANOUT runs are merged into one, two at a time, the same way. What a batch met is then looked
up among all entries of the call, so that earlier copies are found as well. Fingerprints seen once can't be repeated
windows. Where all entries of a fingerprint hold the same words, all their windows are repeated. The rest is verified
window by window, for one entry of each kind, by two 64-bit hashes of the windows' words, each from word hashes of its own, which stand for the words. An
index that outlives the call also holds its entries' kinds and its documents' texts, so that its windows are verified
like the call's own.

Entries are computed once. Hot fingerprints (a line in a third of all documents) are counted with pre-aggregation and
joined by sort-merge joins that Spark can split; no task gathers an unbounded group. Rows are told by 128-bit hashes.

Defined results: null and empty texts have no words; texts under 35 words lose nothing; a row that repeats another
(doc_id and text) has its windows elsewhere, so both lose them; rows that share only a doc_id, or have none, are
apart; very long texts are rows like others; an empty table gives no rows; columns beside those named are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.llm.anchors import runs
from loomline.llm.textops import U64, drop_path, fresh_path, mix, pieces, settings, short_batches, signed, span_hashes, stored, utf8, window_hashes, word_spans
from loomline.sources.readers import read_table

WINDOW, GRAM, FANOUT, BATCHES = 35, 6, 4, 5
ROW = ["r1", "r2"]  # a row's 128-bit hash
_WORDS, _GRAM, _ENTRY, _WINDOWS = (41, 42), 43, 44, (45, 46)  # seeds


def words_of(text: pa.Array, *seeds: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The words' hashes by each seed, and the documents' offsets into them."""
    buf, offsets = utf8(text)
    starts, ends, per = word_spans(buf, offsets)
    return [span_hashes(buf, starts, ends, seed) for seed in seeds], per


def entries(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(r1, r2, fp, words, start, n): each run of windows with its fingerprint, the hash of its words, first word and number of windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            (words,), per = words_of(piece.column("text"), _WORDS[0])
            if len(words) < window:
                continue
            grams, whole = window_hashes(words, GRAM, _GRAM), window_hashes(words, window, _ENTRY)
            doc, start, n, anchor = runs(grams, per, window, GRAM)
            with np.errstate(over="ignore"):  # a run has at most as many windows as one has words, so its first and last hold all of its words
                h = mix(whole[start] + mix(whole[start + n - 1] + n.astype(U64)))
            rows = [piece.column(r).take(pa.array(doc)) for r in ROW]
            yield pa.RecordBatch.from_arrays([*rows, pa.array(signed(grams[anchor])), pa.array(signed(h)), pa.array((start - per[doc]).astype(np.int32)), pa.array(n.astype(np.int32))], [*ROW, "fp", "words", "start", "n"])

    return docs.select(*ROW, "text").transform(short_batches).mapInArrow(run, "r1 long, r2 long, fp long, words long, start int, n int")


class FingerprintIndex:
    """Immutable runs (fp, times, low, high) under one folder, bucketed and sorted by fp: merging runs reads them in order. An
    index for later calls (lasting) also holds the kinds of its entries with a first place, and, where add() or meet() is
    given the documents, their texts, to verify windows against. buckets: by default the session's shuffle partitions."""

    def __init__(self, spark: SparkSession, path: str | None = None, fanout: int = FANOUT, buckets: int | None = None, lasting: bool = True):
        self.spark, self.path, self.fanout, self.lasting = spark, path or fresh_path(spark, "fingerprints"), fanout, lasting
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.runs: list[str] = []
        self.held: list[str] = []  # kinds
        self.texts: list[str] = []
        self.whole = True  # all runs came with their texts
        self._name, self._made = f"fingerprints_{uuid.uuid4().hex}", 0

    def _in_order(self):
        """Settings under which runs are written one file a bucket, and their scans' order is known to Spark."""
        return settings(self.spark, spark__sql__shuffle__partitions=str(self.buckets), spark__sql__legacy__bucketedTableScan__outputOrdering="true", spark__sql__classic__shuffleDependency__fileCleanup__enabled="true")

    def _write(self, run: DataFrame) -> str:
        self._made += 1
        name = f"{self._name}_{self._made:05d}"
        with self._in_order():
            run.write.bucketBy(self.buckets, "fp").sortBy("fp").option("path", f"{self.path}/run-{self._made:05d}").saveAsTable(name)
        return name

    def _drop(self, run: str) -> None:
        self.spark.sql(f"drop table {run}")
        drop_path(self.spark, f"{self.path}/run-{run.rpartition('_')[2]}")

    def _merged(self, runs: list[str], how: str = "left") -> DataFrame:
        """The fingerprints of the first run (left), or of two runs (full), with their sums over all runs, by merge joins of sorted buckets."""
        out = self.spark.table(runs[0])
        for r in runs[1:]:
            other = self.spark.table(r).toDF("fp", "times2", "low2", "high2")
            out = out.join(other, "fp", how).select("fp", (F.coalesce("times", F.lit(0)) + F.coalesce("times2", F.lit(0))).alias("times"), F.least("low", "low2").alias("low"), F.greatest("high", "high2").alias("high"))
        return out

    def _batch(self, found: DataFrame, docs: DataFrame | None) -> str:
        run = self._write(found.groupBy("fp").agg(F.count("*").alias("times"), F.min("words").alias("low"), F.max("words").alias("high")))
        if self.lasting:
            kinds = found.groupBy("fp", "words").agg(F.count("*").alias("times"), F.min(F.struct(*ROW, "start", "n")).alias("one"))
            self.held.append(f"{self.path}/kinds-{self._made:05d}")
            stored(kinds, self.held[-1])
            if docs is not None:
                self.texts.append(f"{self.path}/texts-{self._made:05d}")
                stored(docs.select(*ROW, "text"), self.texts[-1], compression="zstd")
        self.whole = self.whole and self.lasting and docs is not None
        return run

    def _take(self, run: str) -> None:
        self.runs.append(run)
        if len(self.runs) >= self.fanout:
            self.compact()

    def add(self, found: DataFrame, docs: DataFrame | None = None) -> None:
        """A new run of a batch's entries; compacts when there are `fanout` runs."""
        self._take(self._batch(found, docs))

    def meet(self, found: DataFrame, docs: DataFrame | None = None) -> str:
        """add(), after a merge-join of the batch's run with the runs before it. Where (fp, kinds) lies: the batch's
        fingerprints that the index now holds at least twice, with `kinds`, 1 or 2 for more, of their entries."""
        run, path = self._batch(found, docs), fresh_path(self.spark, "met")
        with self._in_order():
            now = self._merged([run, *self.runs])
            stored(now.where("times > 1").select("fp", F.when(F.col("low") == F.col("high"), 1).otherwise(2).alias("kinds")), path)
        self._take(run)
        return path

    def compact(self) -> None:
        """All runs become one, two at a time; so do the tables of kinds."""
        while len(self.runs) > 1:  # a full join of more would deal its second step out again
            pair, self.runs = self.runs[:2], self.runs[2:]
            with self._in_order():
                self.runs.append(self._write(self._merged(pair, "full")))
            for run in pair:
                self._drop(run)
        held = self.held
        if len(held) > 1:
            self.held = [f"{self.path}/kinds-{self._made:05d}-merged"]
            stored(self._kinds(held), self.held[0])
            for path in held:
                drop_path(self.spark, path)

    def _kinds(self, held: list[str]) -> DataFrame:
        return self.spark.read.parquet(*held).groupBy("fp", "words").agg(F.sum("times").alias("times"), F.min("one").alias("one"))

    def kinds(self) -> DataFrame:
        """(fp, words, times, one) of a lasting index: each kind of entry, how often it occurs, and one place."""
        return self._kinds(self.held)

    def close(self) -> None:
        """Forget and delete the runs."""
        for run in self.runs:
            self._drop(run)
        self.runs = []


def wanted_windows(docs: DataFrame, wanted: DataFrame, window: int = WINDOW) -> DataFrame:
    """(r1, r2, at, w1, w2, times) of each window of the wanted entries (r1, r2, start, n, times), from the texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            words, per = words_of(piece.column("text"), *_WORDS)
            lists = piece.column("wanted")
            flat = lists.flatten()
            doc = np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths()))
            start, n, times = (np.asarray(flat.field(i), np.int64) for i in range(3))
            entry = np.repeat(np.arange(len(n)), n)
            at = start[entry] + np.arange(len(entry)) - np.repeat(np.cumsum(n) - n, n)
            place = per[doc[entry]] + at
            a, b = (window_hashes(w, window, seed)[place] for w, seed in zip(words, _WINDOWS))
            rows = [piece.column(r).take(pa.array(doc[entry])) for r in ROW]
            yield pa.RecordBatch.from_arrays([*rows, pa.array(at.astype(np.int32)), pa.array(signed(a)), pa.array(signed(b)), pa.array(times[entry])], [*ROW, "at", "w1", "w2", "times"])

    lists = wanted.groupBy(*ROW).agg(F.collect_list(F.struct("start", "n", "times")).alias("wanted"))
    once = docs.select(*ROW, "text").join(lists, ROW).dropDuplicates(ROW)
    return once.transform(short_batches).mapInArrow(run, "r1 long, r2 long, at int, w1 long, w2 long, times long")


def kept_words(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) from texts and the removed word ranges (r1, r2, a, b)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            rows = []
            for text, ranges in zip(piece.column("text").to_pylist(), piece.column("gone").to_pylist()):
                words = (text or "").encode().split()
                if ranges:
                    step = np.zeros(len(words) + 1, np.int64)
                    np.add.at(step, [r["a"] for r in ranges], 1)
                    np.add.at(step, [r["b"] for r in ranges], -1)
                    left = list(compress(words, (np.cumsum(step[:-1]) == 0).tolist()))
                else:
                    left = words
                rows.append((len(words), len(words) - len(left), hashlib.sha256(b" ".join(left)).hexdigest()))
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    lists = gone.groupBy(*ROW).agg(F.collect_list(F.struct("a", "b")).alias("gone"))
    joined = docs.join(lists, ROW, "left").select("doc_id", "text", "gone")
    return joined.transform(short_batches).mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def deduplicate(df: DataFrame, key: str = "doc_id", text: str = "text", batches: int = BATCHES, window: int = WINDOW, index: FingerprintIndex | None = None) -> DataFrame:
    """Every word covered by a window that also starts anywhere else goes. An index with history counts its windows as elsewhere."""
    spark = df.sparkSession
    own = df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    docs = own.withColumns({"r1": F.xxhash64("doc_id", "text"), "r2": F.xxhash64(F.lit("b"), "doc_id", "text")})
    used = index or FingerprintIndex(spark, lasting=False)
    if used.runs and not used.whole:
        raise ValueError("the index holds runs without their texts: windows can't be verified against them")
    batch = F.pmod("r1", F.lit(batches)).cast("int")
    paths = {n: fresh_path(spark, f"substring-{n}") for n in ("entries", "seen", "matched", "mixed", "windows", "repeated")}
    found = stored(entries(docs, window).withColumn("batch", batch), paths["entries"], ("batch",))
    met = [used.meet(found.where(F.col("batch") == b).drop("batch"), docs.where(batch == b)) for b in range(batches)]
    # later batches meet the earlier copies' fingerprints too: all entries are looked up among what any batch met
    seen = stored(spark.read.parquet(*met).groupBy("fp").agg(F.max("kinds").alias("kinds")), paths["seen"])  # a table of its own: Spark then splits what a hot fingerprint brings to the join
    for path in met:
        drop_path(spark, path)
    matched = stored(found.drop("batch").join(seen, "fp"), paths["matched"])
    drop_path(spark, paths["entries"])
    # several kinds of one fingerprint: one entry of each kind stands for all of its kind, in history too
    if used.lasting:
        mixed = used.kinds().join(seen.where("kinds > 1"), "fp")
    else:
        mixed = matched.where("kinds > 1").groupBy("fp", "words").agg(F.min(F.struct(*ROW, "start", "n")).alias("one"), F.count("*").alias("times"))
    mixed = stored(mixed.select("fp", "words", "times", "one.*"), paths["mixed"])  # tables of their own, as for seen
    hashes = stored(wanted_windows(spark.read.parquet(*used.texts) if used.lasting else docs, mixed, window), paths["windows"])
    often = stored(hashes.groupBy("w1", "w2").agg(F.sum("times").alias("all")).where("all > 1").select("w1", "w2"), paths["repeated"])
    if index is None:
        used.close()
    drop_path(spark, paths["seen"])
    single = hashes.where("times = 1").join(often, ["w1", "w2"]).select(*ROW, F.col("at").alias("a"), (F.col("at") + window).alias("b"))
    whole = matched.where("kinds = 1").select(*ROW, "start", "n")
    same = matched.where("kinds > 1").join(mixed.where("times > 1").select("fp", "words"), ["fp", "words"]).select(*ROW, "start", "n")
    gone = whole.union(same).select(*ROW, F.col("start").alias("a"), (F.col("start") + F.col("n") + window - 1).alias("b")).union(single)
    return kept_words(docs, gone)


def op4_substring_index(spark, sf_dir: str) -> DataFrame:
    return deduplicate(read_table(spark, f"{sf_dir}/documents.parquet"))


OP4_SQL = r"""
with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
s as (select doc_id, w, unnest(range(1, len(w) - 33)) as i from w where len(w) >= 35),
h as (select doc_id, i, md5(array_to_string(w[i:i+34], ' ')) as h from s),
d as (select h from h group by h having count(*) > 1),
c as (select distinct doc_id, unnest(range(i, i + 35)) as k from h join d using (h)),
g as (select doc_id, list(k) as gone from c group by doc_id),
t as (select w.doc_id, w, gone, list_filter(list_zip(w, range(1, len(w) + 1)), lambda x: gone is null or not list_contains(gone, x[2])) as kept from w left join g using (doc_id))
select doc_id, len(w)::bigint as n_words, (len(w) - len(kept))::bigint as n_removed, sha256(array_to_string(list_transform(kept, lambda x: x[1]), ' ')) as kept_sha256 from t
"""
