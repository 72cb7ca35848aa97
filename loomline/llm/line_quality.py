"""Quality rules by line labels: a linear-chain conditional random field marks each line as content or boilerplate.

A chain is a document's lines that hold a word, in order; a line is described by FEATURES, each one of a few levels
(shares of symbols, capitals, repeated and symbol-only words, marks, digits; its length, its last character, whether the
document holds it again). Viterbi decoding labels all chains of a batch at once. A document stays if it passes the base
rules and at least SHARE of its words stand in content lines.

The field is fitted by exact forward-backward on at most SAMPLE labelled documents of at most MOST_LINES lines (those
with the least hash of their id; the bounds hold for the fit alone). Labels are by document, so lines get theirs in two steps: in good documents
all lines are content; in bad ones those are boilerplate that a first fit without the chain's moves takes for it, or
all, if it takes none. Then the chain is fitted on these.

Equal words, windows and lines are told by numbers of equal byte strings, not by hashes.

Defined results: null and empty texts have no words and fail the base rules; lines end at \\n alone; a very long text is
one chain, decoded in blocks; repeated rows and ids are rows of their own, and a labelled doc_id's text in the fit is the
least of the rows that share it; without labelled rows, or with one class only, every line is content; an empty table
gives no rows; columns beside those named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.llm import pii
from loomline.llm.textops import pieces, short_batches, span_codes, utf8, word_spans
from loomline.sources.readers import read_table

WINDOW, LEAST_WORDS, MOST_REPEATED, SHARE = 5, 10, 20, 0.5
SAMPLE, MOST_LINES = 3000, 400
CONTENT, BOILERPLATE = 0, 1
#: Upper ends of each feature's levels (a value above the last is a level of its own).
FEATURES = {
    "symbols": (0, 0.02, 0.05, 0.1, 0.2), "capitals": (0, 0.1, 0.3, 0.6), "words": (1, 2, 4, 8, 16, 40), "same_word": (0, 0.05, 0.2, 0.5), "bare_symbols": (0, 0.1, 0.3), "marks": (0, 0.1, 0.3),
    "digits": (0, 0.1, 0.3), "word_length": (2, 4, 7, 12), "repeated": (0, 0.1, 0.3, 0.6), "again": (0,), "last": (0, 1, 2), "first_line": (0,),
}
LEVELS = [len(v) + 1 for v in FEATURES.values()]
_SYMBOL, _CAPITAL, _LETTER, _DIGIT, _MARK, _NAMED = (np.zeros(256, bool) for _ in range(6))
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_CAPITAL[ord("A") : ord("Z") + 1] = True
_LETTER[[c for c in range(128) if chr(c).isalpha()]] = True
_DIGIT[ord("0") : ord("9") + 1] = True
_MARK[[ord(c) for c in "!?"]] = True
_NAMED[0x80:] = True
_NAMED |= _LETTER | _DIGIT
_LAST = np.zeros(256, np.int64)  # 0: a sentence's end, 1: a pause, 2: a letter or digit, 3: anything else
_LAST[:] = 3
_LAST[_NAMED] = 2
_LAST[[ord(c) for c in ",;:"]] = 1
_LAST[[ord(c) for c in ".!?"]] = 0


def running(flags: np.ndarray) -> np.ndarray:
    """Sums before each place."""
    out = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=out[1:])
    return out


def repeated_windows(code: np.ndarray, doc: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """Which words stand in a window of `width` words that their document holds twice or more. Only windows all of whose word pairs are repeated can be; these are compared as wholes."""
    n = len(code)
    covered = np.zeros(n + 1, np.int64)
    if n < width:
        return covered[:n] > 0
    _, own = np.unique(doc * (int(code.max()) + 1) + code, return_inverse=True)  # equal only for equal words of one document
    pair = own[:-1] * (int(own.max()) + 1) + own[1:]
    _, pair, times = np.unique(pair, return_inverse=True, return_counts=True)
    inside = running((times[pair] > 1) & (doc[1:] == doc[:-1]))
    at = np.flatnonzero(inside[width - 1 :] - inside[: n - width + 1] == width - 1)
    if not len(at):
        return covered[:n] > 0
    key = own[at]
    for k in range(1, width):
        step = own[at + k]
        _, key = np.unique(key * (int(step.max()) + 1) + step, return_inverse=True)
    at = at[np.bincount(key)[key] > 1]
    np.add.at(covered, at, 1)
    np.add.at(covered, at + width, -1)
    return np.cumsum(covered[:n]) > 0


@dataclass
class Lines:
    base: dict[str, np.ndarray]  # of each document
    levels: np.ndarray  # line x feature
    doc: np.ndarray  # of each line
    words: np.ndarray  # in each line

    @property
    def new(self) -> np.ndarray:
        return np.append(True, self.doc[1:] != self.doc[:-1]) if len(self.doc) else np.zeros(0, bool)


def described(text: pa.Array) -> Lines:
    """Base measures of each document, and its lines that hold a word."""
    buf, offsets = utf8(text)
    starts, ends, per = word_spans(buf, offsets)
    n_docs, n = len(per) - 1, len(starts)
    in_word = np.zeros(len(buf) + 1, np.int8)
    in_word[starts] += 1
    in_word[ends] -= 1
    in_word = np.cumsum(in_word[:-1], dtype=np.int8).astype(bool)
    points = running(((buf & 0xC0) != 0x80) & in_word)
    symbols = running(_SYMBOL[buf])
    code, _ = span_codes(buf[in_word], ends - starts)
    doc = np.repeat(np.arange(n_docs), np.diff(per))
    repeated = repeated_windows(code, doc)
    breaks = np.flatnonzero(buf == 10)
    number = np.searchsorted(breaks, starts)  # line breaks before a word
    head = np.flatnonzero(np.append(True, (number[1:] != number[:-1]) | (doc[1:] != doc[:-1]))) if n else np.zeros(0, np.int64)
    tail = np.append(head[1:], n) if n else head
    line_doc, own = doc[head], number[head]
    a = np.maximum(offsets[line_doc], np.concatenate([[0], breaks + 1])[own])
    b = np.minimum(offsets[line_doc + 1], np.append(breaks, len(buf))[own])
    in_line = np.zeros(len(buf) + 1, np.int8)
    np.add.at(in_line, a, 1)
    np.add.at(in_line, b, -1)
    in_line = np.cumsum(in_line[:-1], dtype=np.int8).astype(bool)
    line, _ = span_codes(buf[in_line], b - a)
    _, same, times = np.unique(line_doc * (len(head) + 1) + line, return_inverse=True, return_counts=True)
    base = {
        "n_words": np.diff(per), "word_chars": np.diff(points[offsets]), "n_symbols": np.diff(symbols[offsets]),
        "n_dup_lines": np.bincount(line_doc, minlength=n_docs) - np.round(np.bincount(line_doc, 1 / times[same], n_docs) if len(head) else np.zeros(n_docs)).astype(np.int64),
        "n_repeat_words": np.bincount(doc, repeated, n_docs).astype(np.int64),
    }
    if not n:
        return Lines(base, np.zeros((0, len(LEVELS)), np.int64), line_doc, tail - head)
    count = lambda flags: (lambda r: r[b] - r[a])(running(flags[buf]))
    by_word = lambda flags: (lambda r: r[tail] - r[head])(running(flags))
    named = running(_NAMED[buf])
    again = np.zeros(n, bool)
    again[1:] = code[1:] == code[:-1]
    again[head] = False
    words, chars = tail - head, np.maximum(1, points[b] - points[a])
    values = {
        "symbols": (symbols[b] - symbols[a]) / chars, "capitals": count(_CAPITAL) / np.maximum(1, count(_LETTER)), "words": words, "same_word": by_word(again) / words, "bare_symbols": by_word(named[ends] == named[starts]) / words,
        "marks": count(_MARK) / words, "digits": count(_DIGIT) / chars, "word_length": chars / words, "repeated": by_word(repeated) / words, "again": (times[same] > 1).astype(int), "last": _LAST[buf[ends[tail - 1] - 1]],
        "first_line": np.append(True, line_doc[1:] != line_doc[:-1]).astype(int),
    }
    return Lines(base, np.stack([np.searchsorted(FEATURES[k], values[k], "left") for k in FEATURES], 1), line_doc, words)


@dataclass
class LineField:
    weights: list[np.ndarray]  # level x label, of each feature
    moves: np.ndarray  # label x label
    first: np.ndarray

    def emissions(self, levels: np.ndarray) -> np.ndarray:
        return sum((w[levels[:, k]] for k, w in enumerate(self.weights)), np.zeros((len(levels), 2)))

    def labels(self, levels: np.ndarray, new: np.ndarray) -> np.ndarray:
        """The best labels of all chains."""
        if not len(levels):
            return np.zeros(0, np.uint8)
        none = np.zeros((1, 2))
        return pii.Field(none, none, none, none, none, none, self.moves, self.first).decode(self.emissions(levels), new)


def blank() -> LineField:
    """Every line is content."""
    return LineField([np.zeros((n, 2)) for n in LEVELS], np.zeros((2, 2)), np.array([1.0, 0.0]))


def likelihood(w: np.ndarray, levels: np.ndarray, new: np.ndarray, y: np.ndarray, penalty: float, moving: bool = True) -> tuple[float, np.ndarray]:
    """The penalised log-likelihood of the labels and its gradient. w: emission weights by (feature, level), then moves, then the first label's."""
    at = np.cumsum([0, *LEVELS])
    n, each = len(levels), levels + at[:-1]
    moves, start = w[at[-1] : at[-1] + 2], w[-1]
    e = w[each].sum(1)
    first = np.flatnonzero(new)
    length = np.diff(np.append(first, n))
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    active = [int((length > t).sum()) for t in range(length[0])]
    alpha, beta = np.zeros((n, 2)), np.zeros((n, 2))
    alpha[first] = e[first] + start
    for t in range(1, length[0]):
        i = first[: active[t]] + t
        alpha[i] = np.logaddexp.reduce(alpha[i - 1][:, :, None] + moves, 1) + e[i]
    for t in range(length[0] - 2, -1, -1):
        i = first[: active[t + 1]] + t
        beta[i] = np.logaddexp.reduce(moves + (e[i + 1] + beta[i + 1])[:, None, :], 2)
    z = np.logaddexp.reduce(alpha + beta, 1)
    inside = np.flatnonzero(~new)
    score = e[np.arange(n), y].sum() + start[y[new]].sum() + moves[y[inside - 1], y[inside]].sum() - z[new].sum()
    gap = np.eye(2)[y] - np.exp(alpha + beta - z[:, None])
    g = np.zeros_like(w)
    for k in range(len(LEVELS)):
        np.add.at(g, each[:, k], gap)
    if moving:
        pair = np.exp(alpha[inside - 1][:, :, None] + moves + (e[inside] + beta[inside])[:, None, :] - z[inside][:, None, None]).sum(0)
        seen = np.zeros((2, 2))
        np.add.at(seen, (y[inside - 1], y[inside]), 1)
        g[at[-1] : at[-1] + 2] = seen - pair
        g[-1] = gap[new].sum(0)
    return float(score - penalty / 2 * (w * w).sum()), g - penalty * w * (1 if moving else np.arange(len(w))[:, None] < at[-1])


def ascended(levels: np.ndarray, new: np.ndarray, y: np.ndarray, steps: int, penalty: float, moving: bool) -> LineField:
    w = np.zeros((sum(LEVELS) + 3, 2))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        g = likelihood(w, levels, new, y, penalty, moving)[1] / len(levels)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w + 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    at = np.cumsum([0, *LEVELS])
    return LineField([w[a:b] for a, b in zip(at, at[1:])], w[at[-1] : at[-1] + 2], w[-1])


def fit(docs: list[np.ndarray], good: np.ndarray, steps: int = 120, penalty: float = 0.5) -> LineField:
    """docs: the levels of each document's lines."""
    docs, good = [d for d in docs if len(d)], np.array([g for d, g in zip(docs, good) if len(d)], bool)
    if not len(docs) or good.all() or not good.any():
        return blank()
    levels, size = np.concatenate(docs), np.array([len(d) for d in docs])
    doc, new = np.repeat(np.arange(len(docs)), size), np.concatenate([[True], np.zeros(size.sum() - 1, bool)])
    new[np.cumsum(size)[:-1]] = True
    y = np.repeat(np.where(good, CONTENT, BOILERPLATE), size)
    alone = ascended(levels, new, y, steps, penalty, False)
    e = alone.emissions(levels)
    guess = (e[:, BOILERPLATE] > e[:, CONTENT]) & ~good[doc]
    none = np.bincount(doc, guess, len(docs)) == 0
    y = np.where(~good[doc] & (guess | none[doc]), BOILERPLATE, CONTENT)
    return ascended(levels, new, y, steps, penalty, True)


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE, most_lines: int = MOST_LINES) -> LineField:
    """Fit on at most `sample` labelled documents: their lines' levels reach the driver, some kilobytes each at most."""
    some = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.min(label).alias("label"))
    some = some.orderBy(F.xxhash64("key"), "key").limit(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            found = described(piece.column("text"))
            cut = np.searchsorted(found.doc, np.arange(piece.num_rows + 1))
            made = [found.levels[a:b].astype(np.uint8).tobytes() if b - a <= most_lines else b"" for a, b in zip(cut, cut[1:])]
            yield pa.RecordBatch.from_arrays([piece.column("label"), pa.array(made, pa.binary())], ["label", "levels"])

    own = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    chosen = own.join(F.broadcast(some), "key").groupBy("key").agg(F.min("label").cast("int").alias("label"), F.min("text").alias("text"))  # at most `sample` narrow rows are broadcast
    rows = sorted((r["levels"], r["label"]) for r in chosen.select("label", "text").transform(short_batches).mapInArrow(run, "label int, levels binary").collect())  # the rows' order must not matter
    return fit([np.frombuffer(x, np.uint8).astype(np.int64).reshape(-1, len(LEVELS)) for x, _ in rows], np.array([y > 0 for _, y in rows]))


def judge(df: DataFrame, field: LineField, key: str = "doc_id", text: str = "text", share: float = SHARE) -> DataFrame:
    """(doc_id, base measures, base_failed, kept, n_lines, n_content_lines, content_words) of each row, in one pass without a shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            found = described(piece.column("text"))
            content, n = field.labels(found.levels, found.new) == CONTENT, piece.num_rows
            words = np.bincount(found.doc, found.words * content, n).astype(np.int64)
            b = found.base
            failed = (b["n_words"] < LEAST_WORDS) | (100 * b["n_repeat_words"] > MOST_REPEATED * b["n_words"])
            kept = ~failed & (words >= share * b["n_words"])
            lines = [np.bincount(found.doc, minlength=n), np.bincount(found.doc, content, n)]
            yield pa.RecordBatch.from_arrays([piece.column("key"), *(pa.array(x.astype(np.int64)) for x in b.values()), pa.array(failed), pa.array(kept), *(pa.array(x.astype(np.int64)) for x in (*lines, words))], names)

    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "n_content_lines", "content_words"]
    schema = ", ".join(f"{c} {'boolean' if c in ('base_failed', 'kept') else 'long'}" for c in names)
    return df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).transform(short_batches).mapInArrow(run, schema)


def op13_line_quality(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, f"{sf_dir}/documents.parquet")
    return judge(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
