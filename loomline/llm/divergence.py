"""Source divergence audit: how far each source's smoothed term shares lie from those of other sources of its language.

Counting is prefiltered by a sketch. Each task counts its documents' distinct (lang, term) pairs in a count-min sketch
of two rows; sketches travel as the cells that aren't zero and are merged block by block, each cell up to the least
document frequency and no further. A cell never underestimates, so a term one of whose cells stays below that can't be
kept, and is dropped where it is read: a second pass over the texts sends only the other terms into the shuffle, with
counts added up before. These are counted exactly, as strings, and the kept ones are chosen by their exact counts.
The merged sketch reaches the tasks as one bit a cell, at most 2 * 2**WIDEST bits (8 MB), whatever the corpus; beyond
some million documents it lets more impossible terms pass, which costs a shuffle but changes no row.

A pair's value is a sum over all kept terms, most of which neither source may have. It is put together from sparse
parts: terms that both have, by a join on (lang, term); terms of one source against the other's share of an absent
term, by a histogram of the first one's shares; and what is left as a number of terms times one difference.
Shares are computed in decimals and compared as longs.

Defined results: null text, lang and source are empty strings; rows are documents, whatever their doc_id, so a null or
repeated one changes nothing; a text without terms makes its group occur; very long texts are rows like others; ties
go to the lesser item by bytes; a language without kept terms gives pairs of value 0 and no terms; an empty table
gives no rows; columns beside those named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomline.llm.textops import LOWER, U64, Rolling, cut, forget, marked_spans, mix, pieces, short_batches, span_codes, utf8
from loomline.sources.readers import read_table

LEAST, MOST_TERMS, SMOOTH, SCALE = 30, 50, 5, 1_000_000_000
#: Bits of a row's width: as many cells as 32 a document, within these bounds; a block is what one merging row covers.
NARROWEST, WIDEST, BLOCK = 16, 25, 14
PIECE = 4 << 20
_HASH = Rolling(111)
_TERM = np.zeros(256, bool)
_TERM[0x80:] = True
_TERM[[c for c in range(128) if chr(c).isalpha()]] = True


def coded_terms(text: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(document, term number) of each term's occurrence, and the terms by number."""
    buf, offsets = utf8(text)
    mark = _TERM[buf]
    data = LOWER[buf[mark]]
    starts, ends, per = marked_spans(mark, offsets)
    code, terms = span_codes(data, ends - starts)
    return np.repeat(np.arange(len(per) - 1), np.diff(per)), code, terms


def coded(*columns: pa.Array) -> tuple[np.ndarray, list[tuple[str, ...]]]:
    """A number for each row's values, and the distinct values by number."""
    seen: dict[tuple[str, ...], int] = {}
    number = np.array([seen.setdefault(x, len(seen)) for x in zip(*(c.to_pylist() for c in columns))], np.int64)
    return number, list(seen)


def cells(lang: list[tuple[str]], terms: pa.Array, of_lang: np.ndarray, of_term: np.ndarray, bits: int) -> np.ndarray:
    """The two cells, one in each row of the sketch, of each (lang, term)."""
    def hashes(strings: pa.Array) -> np.ndarray:
        buf, offsets = utf8(strings)
        return _HASH.words(buf, offsets[:-1], offsets[1:])

    with np.errstate(over="ignore"):
        h = mix(hashes(terms)[of_term] + hashes(pa.array([x for (x,) in lang], pa.string()))[of_lang] * U64(0x9E3779B97F4A7C15))
    low = U64((1 << bits) - 1)
    return np.stack([h & low, (h >> U64(32) & low) + (low + U64(1))]).astype(np.int64)


def sketch(docs: DataFrame, bits: int, least: int) -> np.ndarray:
    """One bit for each cell of the merged count-min sketch of document frequencies: whether it reaches `least`."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(2 << bits, np.uint8)
        for piece in pieces(batches, limit=PIECE):
            doc, code, terms = coded_terms(piece.column("text"))
            if not len(code):
                continue
            own, langs = coded(piece.column("lang"))
            once = np.unique(doc * len(terms) + code)
            pair, times = np.unique(own[once // len(terms)] * len(terms) + once % len(terms), return_counts=True)
            at = cells(langs, terms, pair // len(terms), pair % len(terms), bits)
            for row in at:
                cell, where = np.unique(row, return_inverse=True)
                found[cell] = np.minimum(found[cell] + np.bincount(where, np.minimum(times, least)), least).astype(np.uint8)
        at = np.flatnonzero(found)
        edges = np.append(np.flatnonzero(np.append(True, at[1:] >> BLOCK != at[:-1] >> BLOCK)), len(at)) if len(at) else [0]
        for i in range(0, len(edges) - 1, 256):
            some = list(zip(edges[i:-1][:256], edges[i + 1 :][:256]))
            yield pa.RecordBatch.from_arrays([
                pa.array([int(at[a] >> BLOCK) for a, _ in some], pa.int32()), pa.array([(at[a:b] & ((1 << BLOCK) - 1)).astype("<u2").tobytes() for a, b in some]), pa.array([found[at[a:b]].tobytes() for a, b in some]),
            ], ["block", "at", "times"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks one after another, each added up as its rows pass."""
        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([np.packbits(total >= least).tobytes()])], ["block", "bits"])

        now, total = None, np.zeros(1 << BLOCK, np.int64)
        for batch in batches:
            for block, at, times in zip(*(c.to_pylist() for c in batch.columns)):
                if block != now:
                    if now is not None and (total >= least).any():
                        yield out()
                    now, total = block, np.zeros(1 << BLOCK, np.int64)
                at = np.frombuffer(at, "<u2")
                total[at] = np.minimum(total[at] + np.frombuffer(times, np.uint8), least)
        if now is not None and (total >= least).any():
            yield out()

    counted = docs.select("lang", "text").transform(short_batches).mapInArrow(count, "block int, at binary, times binary")
    merged = counted.repartition("block").sortWithinPartitions("block").transform(short_batches).mapInArrow(merge, "block int, bits binary")
    whole = np.zeros((2 << bits) // 8, np.uint8)
    for r in merged.collect():  # at most 2 * 2**WIDEST bits
        whole[r["block"] << BLOCK >> 3 :][: len(r["bits"])] = np.frombuffer(r["bits"], np.uint8)
    return whole


def term_counts(docs: DataFrame, bits: int, possible: np.ndarray) -> DataFrame:
    """(lang, source, term, docs, n): exact document frequencies and occurrences in each group, of the terms that the sketch leaves possible in their language."""
    shared = docs.sparkSession.sparkContext.broadcast(possible)  # at most 8 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, limit=PIECE):
            doc, code, terms = coded_terms(piece.column("text"))
            if not len(code):
                continue
            own, langs = coded(piece.column("lang"))
            pair, of_pair = np.unique(own[doc] * len(terms) + code, return_inverse=True)
            at = cells(langs, terms, pair // len(terms), pair % len(terms), bits)
            fits = (shared.value[at >> 3] >> (7 - (at & 7)) & 1).all(0)[of_pair]
            doc, code = doc[fits], code[fits]
            group, groups = coded(piece.column("lang"), piece.column("source"))
            once, n = np.unique(doc * len(terms) + code, return_counts=True)
            key, where = np.unique(group[once // len(terms)] * len(terms) + once % len(terms), return_inverse=True)
            total = np.bincount(where, n, len(key)).astype(np.int64)
            lang, source = (pa.array([g[i] for g in groups], pa.string()).take(pa.array(key // len(terms))) for i in range(2))
            yield pa.RecordBatch.from_arrays([lang, source, terms.take(pa.array(key % len(terms))).cast(pa.string()), pa.array(np.bincount(where, minlength=len(key)).astype(np.int64)), pa.array(total)], ["lang", "source", "term", "docs", "n"])

    found = docs.transform(short_batches).mapInArrow(run, "lang string, source string, term string, docs long, n long")
    return found.groupBy("lang", "source", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))


def share(count: str, total: str):
    """1 + floor(SCALE * (count + SMOOTH) / total), exact; total counts SMOOTH for each kept term."""
    return F.expr(f"1 + cast({SCALE} as decimal(10, 0)) * cast({count} + {SMOOTH} as decimal(20, 0)) div cast({total} as decimal(20, 0))")


def audit(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST, most_terms: int = MOST_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): part `pair` holds each source's distance to each other source of its language, part `term` its most_terms most over-represented kept terms."""
    docs = df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))))
    bits = min(WIDEST, max(NARROWEST, (32 * docs.count()).bit_length()))
    counts = cut(term_counts(docs, bits, sketch(docs, bits, least)))
    kept = cut(counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("all")).where(F.col("docs") >= least).drop("docs"))
    live = cut(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "all"))
    forget(counts)
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), (F.sum("all") + SMOOTH * F.count("*")).alias("whole"))
    groups = docs.select("lang", "source").distinct().join(live.groupBy("lang", "source").agg(F.sum("n").alias("own"), F.count("*").alias("terms")), ["lang", "source"], "left").join(langs, "lang", "left")
    zero = F.coalesce("v", F.lit(0))
    groups = groups.select("lang", "source", zero.alias("v"), F.coalesce("terms", F.lit(0)).alias("terms"), "whole", (F.coalesce("own", F.lit(0)) + SMOOTH * zero).alias("total"))
    groups = cut(groups.withColumn("none", F.when(F.col("v") > 0, share("0", "total")).otherwise(0)))  # the share of a term that the group doesn't have
    shares = cut(live.join(groups, ["lang", "source"]).select("lang", "source", "term", share("n", "total").alias("p"), share("all", "whole").alias("q"), "none"))

    other = groups.select("lang", F.col("source").alias("item"), F.col("none").alias("none2"), F.col("terms").alias("terms2"))
    left = groups.join(other, "lang").where("source <> item")  # as many rows as the result has
    left = left.select("lang", "source", "item", ((F.col("v") - F.col("terms") - F.col("terms2")) * F.abs(F.col("none") - F.col("none2"))).alias("x"))
    bars = cut(shares.groupBy("lang", "source", "p").agg(F.count("*").alias("m")))
    one = bars.join(other, "lang").where("source <> item").groupBy("lang", "source", "item").agg(F.sum(F.col("m") * F.abs(F.col("p") - F.col("none2"))).alias("x"))
    mine, yours = shares.select("lang", "term", "source", "p", "none"), shares.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("p2"), F.col("none").alias("none2"))
    gap = lambda a, b: F.abs(F.col(a) - F.col(b))
    both = mine.join(yours, ["lang", "term"]).where("source < item").groupBy("lang", "source", "item").agg(F.sum(gap("p", "p2") - gap("p", "none2") - gap("p2", "none") + gap("none", "none2")).alias("x"))
    turned = lambda t: t.union(t.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "x"))
    pairs = left.union(turned(one)).union(turned(both)).groupBy("lang", "source", "item").agg(F.sum("x").alias("value"))
    terms = shares.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda t, part: t.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    return ranked(pairs, "pair").union(ranked(terms, "term").where(F.col("rank") <= most_terms))


def op11_divergence(spark, sf_dir: str) -> DataFrame:
    return audit(read_table(spark, f"{sf_dir}/documents.parquet"))


OP11_SQL = r"""
with d as (select coalesce(lang, '') as lang, coalesce(source, '') as source, row_number() over () as id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
c as (select lang, source, t, count(*) as n, count(distinct id) as docs from (select lang, source, id, unnest(w) as t from d) group by lang, source, t),
k as (select lang, t, sum(n) as n from c group by lang, t having sum(docs) >= 30),
g as (select distinct lang, source from d),
f as (select g.lang, g.source, k.t, coalesce(c.n, 0) as n, k.n as ln from g join k on g.lang = k.lang left join c on c.lang = g.lang and c.source = g.source and c.t = k.t),
s as (select *, sum(n) over (partition by lang, source) + 5 * count(*) over (partition by lang, source) as total, sum(ln) over (partition by lang, source) + 5 * count(*) over (partition by lang, source) as whole from f),
p as (select lang, source, t, n, 1 + (1000000000::hugeint * (n + 5)) // total::hugeint as p, 1 + (1000000000::hugeint * (ln + 5)) // whole::hugeint as q from s),
x as (select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as v from p a join p b on a.lang = b.lang and a.t = b.t and a.source <> b.source group by a.lang, a.source, b.source),
r as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(x.v, 0) as v from g a join g b on a.lang = b.lang and a.source <> b.source left join x on x.lang = a.lang and x.source = a.source and x.item = b.source
  union all select lang, source, 'term', t, p - q from p where n > 0 and p > q),
o as (select *, row_number() over (partition by lang, source, part order by v desc, item) as rank from r)
select lang, source, part, item, v::bigint as value, rank::int as rank from o where part = 'pair' or rank <= 50
"""
