"""Toxicity: cumulative-link (proportional-odds) ordinal regression on sparse text features.

P(grade <= k) = 1 / (1 + exp(w.x - threshold_k)), one weight vector for all ordered thresholds. x holds 1 for each
hashed lower-case word of a document. Grades: 0 for documents labelled clean; those labelled toxic are graded 1..3
by thirds of their share of words whose log-odds speak for the toxic label. The fit is numpy on the driver, on at
most SAMPLE labelled documents (those with the least hash of their id), with the features that differ surely
between the classes (at most FEATURES of them). Scoring is one pass without a shuffle.

Defined results: null or empty text has no features and gets the thresholds' own probabilities, grade 0; with no
labelled rows, or one class only, nothing is toxic; equal texts score alike, to the last bit, wherever they stand;
ties in the sample go by id; a sampled doc_id's text is the least of the rows that share it; very long texts count
each word once; columns beside those named are ignored, in clean_rows() they are carried, whatever their names;
an empty table gives no rows. All punctuation at a word's ends is left out; of a word of nothing else its last mark stays.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.llm.textops import LOWER, Rolling, list_array, pieces, quoted, short_batches, utf8, word_spans

SAMPLE, BITS, FEATURES, GRADES, SURE, ROUNDS = 6000, 18, 20_000, 3, 3.5, 8
_HASH = Rolling(6)
_PUNCT = np.zeros(256, bool)
_PUNCT[[i for i in range(33, 127) if not chr(i).isalnum()]] = True


def features(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashed words of each document, flat, their per-document offsets, and word counts. Punctuation at a word's ends is left out."""
    buf, offsets = utf8(text)
    starts, ends, per = word_spans(buf, offsets)
    buf = LOWER[buf]
    # a word of marks alone keeps its last; only words that still have a mark at an end are looked at again, those with many one by one
    at = np.arange(len(starts))
    for _ in range(ROUNDS):
        at = at[(starts[at] < ends[at] - 1) & _PUNCT[buf[starts[at]]]]
        starts[at] += 1
    for i in at[(starts[at] < ends[at] - 1) & _PUNCT[buf[starts[at]]]].tolist():
        own = _PUNCT[buf[starts[i] : ends[i] - 1]]
        starts[i] += len(own) if own.all() else int(own.argmin())
    at = np.arange(len(ends))
    for _ in range(ROUNDS):
        at = at[(starts[at] < ends[at] - 1) & _PUNCT[buf[ends[at] - 1]]]
        ends[at] -= 1
    for i in at[(starts[at] < ends[at] - 1) & _PUNCT[buf[ends[at] - 1]]].tolist():
        own = _PUNCT[buf[starts[i] + 1 : ends[i]][::-1]]
        ends[i] -= len(own) if own.all() else int(own.argmin())
    word = _HASH.words(buf, starts, ends) >> np.uint64(64 - BITS)
    doc = np.repeat(np.arange(len(per) - 1, dtype=np.uint64), np.diff(per))
    both = np.unique(doc << np.uint64(BITS) | word)
    at = np.searchsorted(both >> np.uint64(BITS), np.arange(len(per), dtype=np.uint64))
    return (both & np.uint64((1 << BITS) - 1)).astype(np.int64), at, np.diff(per)


@dataclass
class Ordinal:
    weights: np.ndarray = field(default_factory=lambda: np.zeros(1 << BITS))
    thresholds: np.ndarray = field(default_factory=lambda: np.full(GRADES, 50.0))
    cut: float = 0.5  # toxic above: where the sample's labels part best

    def above(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for k = 0..GRADES-1."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -500, 500)))

    def score(self, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Each document's sum of weights, added in the order of its own features alone."""
        return np.bincount(np.repeat(np.arange(len(at) - 1), np.diff(at)), self.weights[ids], len(at) - 1)


def grades(docs: list[np.ndarray], n_words: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Grades of the labelled documents, and the ids of the features whose log-odds differ surely."""
    n1, n0 = toxic.sum(), (~toxic).sum()
    seen1, seen0 = (np.bincount(np.concatenate([d for d, t in zip(docs, toxic) if t == want]), minlength=1 << BITS) for want in (True, False))
    odds = np.log((seen1 + 0.5) / (n1 - seen1 + 0.5)) - np.log((seen0 + 0.5) / (n0 - seen0 + 0.5))
    error = np.sqrt(1 / (seen1 + 0.5) + 1 / (seen0 + 0.5) + 1 / (n1 - seen1 + 0.5) + 1 / (n0 - seen0 + 0.5))
    z = odds / error
    z[(seen1 + seen0) < 5] = 0
    use = np.flatnonzero(np.abs(z) >= SURE)
    use = np.sort(use[np.argsort(-np.abs(z[use]), kind="stable")[:FEATURES]])
    speaks = z >= SURE
    share = np.array([speaks[d].sum() / max(1, n) for d, n in zip(docs, n_words)])
    cuts = np.quantile(share[toxic], np.arange(1, GRADES) / GRADES)
    return np.where(toxic, 1 + np.searchsorted(cuts, share, "left"), 0), use


def likelihood(w: np.ndarray, gaps: np.ndarray, row: np.ndarray, col: np.ndarray, y: np.ndarray, penalty: float) -> tuple[float, np.ndarray]:
    """The penalised log-likelihood of grades y, where document row[i] has feature col[i], and its gradient in (w, gaps)."""
    n = len(y)
    theta = np.concatenate([[gaps[0]], gaps[0] + np.cumsum(np.exp(gaps[1:]))])
    s = np.bincount(row, w[col], n)
    cum = 1 / (1 + np.exp(np.clip(s[:, None] - theta[None, :], -500, 500)))  # P(y <= k)
    full = np.concatenate([np.zeros((n, 1)), cum, np.ones((n, 1))], 1)
    slope = full * (1 - full)
    i = np.arange(n)
    p = np.maximum(full[i, y + 1] - full[i, y], 1e-12)
    ds = -(slope[i, y + 1] - slope[i, y]) / p  # d log p / d s
    dt = np.zeros((n, GRADES + 2))
    dt[i, y + 1] += slope[i, y + 1] / p
    dt[i, y] -= slope[i, y] / p
    dt = dt[:, 1:-1].sum(0)
    g_gap = np.concatenate([[dt.sum()], [dt[k:].sum() * np.exp(gaps[k]) for k in range(1, GRADES)]])
    return float(np.log(p).sum() - penalty / 2 * (w * w).sum()), np.concatenate([np.bincount(col, ds[row], len(w)) - penalty * w, g_gap])


def fit(docs: list[np.ndarray], n_words: np.ndarray, toxic: np.ndarray, steps: int = 400, penalty: float = 0.2) -> Ordinal:
    """Full-batch Adam on the penalised likelihood. thresholds = first + sums of exponentials, so they stay ordered."""
    toxic = np.asarray(toxic, bool)
    if not len(docs) or toxic.all() or not toxic.any():
        return Ordinal()
    y, use = grades(docs, np.asarray(n_words), toxic)
    column = np.full(1 << BITS, -1)
    column[use] = np.arange(len(use))
    cols = [column[d][column[d] >= 0] for d in docs]
    row, col, n = np.repeat(np.arange(len(docs)), [len(c) for c in cols]), np.concatenate(cols), len(docs)
    w, gaps = np.zeros(len(use)), np.concatenate([[np.log((~toxic).sum() / toxic.sum())], np.zeros(GRADES - 1)])
    m, v = np.zeros(len(w) + GRADES), np.zeros(len(w) + GRADES)
    for step in range(1, steps + 1):
        g = likelihood(w, gaps, row, col, y, penalty)[1] / n
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, gaps = w + move[: len(w)], gaps + move[len(w) :]
    model = Ordinal(thresholds=np.concatenate([[gaps[0]], gaps[0] + np.cumsum(np.exp(gaps[1:]))]))
    model.weights[use] = w
    p = model.above(np.bincount(row, w[col], n))[:, 0]
    # between the two neighbouring probabilities that part the labels best (share of toxic above less share of clean above)
    levels = np.unique(np.round(p, 9))
    gain = [(p[toxic] > c).mean() - (p[~toxic] > c).mean() for c in (levels[1:] + levels[:-1]) / 2]
    model.cut = float((levels[np.argmax(gain)] + levels[np.argmax(gain) + 1]) / 2) if gain else 0.5
    return model


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE) -> Ordinal:
    """Fit on at most `sample` labelled documents: at most that many ids, and then sparse rows, reach the driver."""
    some = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.max(label).alias("label"))
    some = some.orderBy(F.xxhash64("key"), "key").limit(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            ids, at, n = features(piece.column("text"))
            yield pa.RecordBatch.from_arrays([piece.column("label"), pa.array(n, pa.int64()), list_array(ids, at, pa.int32())], ["label", "n", "ids"])

    own = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    chosen = own.join(F.broadcast(some), "key").groupBy("key").agg(F.max("label").cast("int").alias("label"), F.min("text").alias("text"))  # at most `sample` narrow rows are broadcast; rows that share an id count once
    rows = chosen.select("label", "text").transform(short_batches).mapInArrow(run, "label int, n long, ids array<int>").toArrow()
    lists = rows.column("ids").combine_chunks()
    flat, off = np.asarray(lists.flatten(), np.int64), np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(lists)))])
    y, n = np.asarray(rows.column("label")) > 0, np.asarray(rows.column("n"))
    order = sorted(range(len(off) - 1), key=lambda i: (off[i + 1] - off[i], flat[off[i] : off[i + 1]].tobytes(), y[i], n[i]))  # the rows' order must not matter
    return fit([flat[off[i] : off[i + 1]] for i in order], n[order], y[order])


def score(df: DataFrame, model: Ordinal, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, p_toxic, expected_severity, grade, toxic) and the columns in keep (which mustn't have these names), for each row. grade: the most probable severity; toxic: p_toxic above the model's cut."""
    sc = df.sparkSession.sparkContext
    shared = sc.broadcast((np.flatnonzero(model.weights), model.weights[np.flatnonzero(model.weights)], model.thresholds, model.cut))  # at most FEATURES weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use, w, thresholds, cut = shared.value
        model = Ordinal(thresholds=thresholds)
        model.weights[use] = w
        for piece in pieces(batches, "_text"):
            ids, at, _ = features(piece.column("_text"))
            above = model.above(model.score(ids, at))
            full = np.concatenate([np.ones((len(above), 1)), above, np.zeros((len(above), 1))], 1)
            out = [pa.array(above[:, 0]), pa.array(above.sum(1)), pa.array(np.argmax(full[:, :-1] - full[:, 1:], 1), pa.int64()), pa.array(above[:, 0] > cut)]
            yield pa.RecordBatch.from_arrays([*(piece.column(n) for n in had), *out], [*had, *found])

    wanted = [key, *(c for c in keep if c != key)]
    had = ["_text" if c == text else f"_{i}" for i, c in enumerate(wanted)]
    found = ["p_toxic", "expected_severity", "grade", "toxic"]
    named = dict(zip([*had, "_text"], [*wanted, text]))
    source = df.select(*(F.col(quoted(c)).alias(n) for n, c in named.items()))
    kinds = [T.StructField(found[0], T.DoubleType()), T.StructField(found[1], T.DoubleType()), T.StructField(found[2], T.LongType()), T.StructField(found[3], T.BooleanType())]
    out = source.transform(short_batches).mapInArrow(run, T.StructType([*(source.schema[n] for n in had), *kinds]))
    return out.select(*(F.col(n).alias(c) for n, c in zip(had, wanted)), *found)


def clean_rows(df: DataFrame, model: Ordinal, text: str = "text") -> DataFrame:
    """The rows of df, whatever its columns are called, whose text isn't toxic."""
    names = [f"c{i}" for i in range(len(df.columns))]
    plain = df.select(*(F.col(quoted(c)).alias(n) for n, c in zip(names, df.columns)))
    kept = score(plain, model, names[0], names[df.columns.index(text)], tuple(names)).where("not toxic")
    return kept.select(*(F.col(n).alias(c) for n, c in zip(names, df.columns)))


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return score(docs, train(docs, labels))
