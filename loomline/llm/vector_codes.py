"""Vector code compression: a product code of four parts, its codebooks fitted by Lloyd rounds with Yinyang bounds.

Components become integers, floor(1024 * x), and all distances are exact integers. The first pass measures each part
against its whole codebook. After each update the entries' drifts are known; codebook entries are clustered into GROUPS
groups, and each part of each vector keeps one lower bound a group, for the group's entries other than its own: the
bound less the group's greatest drift. A group is scanned only where that doesn't exceed the exact distance to the
part's present entry; elsewhere none of its entries can be as near, so ties too are met by exact integers, and go to
the lower index. A pass reads the vectors with their bounds and writes them with the new ones, and each task's sums
beside them; codebooks (at most 256 entries a part) are the only thing that the driver holds.

State travels compactly: components as 16-bit integers where a vector's fit, else as doubles; bounds as 16-bit units
of SCALE, rounded down, so a bound may be weaker than it could be, never too strong.

Defined results: rows whose vector is null or holds a null or non-finite component (or one whose product with 1024 no
long holds) are left out; shorter vectors count as filled up with zeros to the longest one's length, and that to a multiple
of 4; fewer than 256 rows make a smaller codebook; rows that share a vec_id are rows of their own, the first codebook
takes them by their components, a null vec_id last; a null label is a label; components beyond 2**23 / 1024 are
measured in Python integers, and an error or a label's sum that no long holds is null; an empty table gives no rows; columns beside
those named are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.llm.textops import cut, drop_path, fresh_path, short_batches, stored

PARTS, ENTRIES, ROUNDS, GROUPS, UNIT = 4, 256, 4, 16, 1024
STATE = "row long, vec_id long, label string, vector binary, code binary, bounds binary"
ROWS = 4096


def floats(column: pa.Array) -> list[np.ndarray]:
    """floor(1024 * x) of each vector, as doubles that hold integers."""
    flat, off = np.asarray(column.flatten(), np.float64), np.concatenate([[0], np.cumsum(np.asarray(column.value_lengths(), np.int64))])
    whole = np.floor(flat * UNIT)
    return [whole[a:b] for a, b in zip(off, off[1:])]


def packed(x: np.ndarray) -> bytes:
    """A whole-numbered vector: 16 bits each where all fit, else doubles, with a leading mark."""
    return b"\0" + x.astype("<i2").tobytes() if not len(x) or (np.abs(x) < 1 << 15).all() else b"\1" + x.astype("<f8").tobytes()


def unpacked(rows: list[bytes], width: int) -> np.ndarray:
    """The vectors as rows of one array of doubles."""
    if all(r[0] == 0 for r in rows):
        return np.frombuffer(b"".join(r[1:] for r in rows), "<i2").reshape(len(rows), width).astype(np.float64)
    return np.stack([np.frombuffer(r[1:], "<f8" if r[0] else "<i2").astype(np.float64) for r in rows])


def exact(*arrays: np.ndarray) -> bool:
    """Whether squared distances among these rows are exact in doubles."""
    most = max(float(np.abs(a).max(initial=0)) for a in arrays)
    return most < 1 << 23 and (2 * most) ** 2 * max(1, arrays[0].shape[1]) < 2.0**53


def whole(a: np.ndarray) -> np.ndarray:
    """The same numbers as Python integers."""
    out = np.empty(a.shape, object)
    out.ravel()[:] = [int(x) for x in a.ravel()]
    return out


def tidy(a: np.ndarray) -> np.ndarray:
    """Whole numbers as doubles, where these hold them exactly."""
    return a.astype(np.float64) if not a.size or np.abs(a).max() < 1 << 53 else a


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances (rows x entries): doubles that hold integers, or Python integers."""
    if exact(x, entries):
        return (x * x).sum(1)[:, None] - 2 * (x @ entries.T) + (entries * entries).sum(1)[None, :]
    a, b = whole(x), whole(entries)
    return np.stack([((a - e) ** 2).sum(1) for e in b], 1)


def roots(squared: np.ndarray) -> np.ndarray:
    return np.sqrt(squared.astype(np.float64))


@dataclass
class Codebook:
    entries: np.ndarray  # k x width, whole numbers
    groups: list[np.ndarray] = field(default_factory=list)  # indexes, ascending
    of: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # the group of each entry
    drift: np.ndarray = field(default_factory=lambda: np.zeros(0))  # the greatest of each group

    def grouped(self, groups: int = GROUPS) -> Codebook:
        """Entries clustered by a few plain rounds from evenly spread ones; any grouping gives the same codes."""
        k, plain = len(self.entries), self.entries.astype(np.float64)
        centers = plain[np.unique(np.linspace(0, k - 1, min(groups, k)).astype(int))] if k else plain
        of = np.zeros(k, np.int64)
        for _ in range(5):
            if k:
                gap = ((plain[:, None] - centers[None]) ** 2).sum(2)
                of = gap.argmin(1)
                centers = np.stack([plain[of == g].mean(0) if (of == g).any() else c for g, c in enumerate(centers)])
        self.groups = [np.flatnonzero(of == g) for g in np.unique(of)]
        self.of = np.unique(of, return_inverse=True)[1] if k else of
        self.drift = np.zeros(len(self.groups))
        return self

    def moved(self, entries: np.ndarray) -> Codebook:
        """The next round's codebook: the same groups, and how far their entries went."""
        step = np.sqrt(((entries - self.entries).astype(np.float64) ** 2).sum(1)) * (1 + 1e-9)
        return Codebook(entries, self.groups, self.of, np.array([step[g].max() for g in self.groups]))


def nearest(x: np.ndarray, book: Codebook, code: np.ndarray | None, bounds: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(index of the nearest entry, its squared distance, a lower bound for each group's other entries, distances computed).

    Without a code all groups are scanned. bounds: those of the round before, in units, for the code's other entries.
    """
    n, scanned = len(x), 0
    each = np.arange(n)
    if code is None:
        best, at = None, np.full(n, -1)
        ready = np.zeros((n, len(book.groups)))
        scan = np.ones((n, len(book.groups)), bool)
    else:
        at = code.astype(np.int64)
        own = book.entries[at]
        best = ((x - own) ** 2).sum(1) if exact(x, own) else ((whole(x) - whole(own)) ** 2).sum(1)
        ready = np.maximum(bounds - book.drift[None, :], 0)
        scan = ready <= (roots(best) * (1 + 1e-9))[:, None]
        scanned += n
    old, old_best = at.copy(), None if best is None else best.copy()
    low = {}
    for g, members in enumerate(book.groups):
        rows = np.flatnonzero(scan[:, g])
        if not len(rows):
            continue
        d = distances(x[rows], book.entries[members])
        scanned += d.size
        first = np.asarray(d.argmin(1), np.int64)
        least = d[np.arange(len(rows)), first]
        second = np.full(len(rows), np.inf)
        if len(members) > 1:
            rest = d.astype(np.float64)
            rest[np.arange(len(rows)), first] = np.inf
            second = rest.min(1)
        low[g] = (rows, members[first], least, second)
        if best is None:
            best, at = least.copy(), members[first]
        else:
            better = (least < best[rows]) | ((least == best[rows]) & (members[first] < at[rows]))
            best[rows[better]], at[rows[better]] = least[better], members[first][better]
    for g, (rows, first, least, second) in low.items():
        ready[rows, g] = np.sqrt(np.where(first == at[rows], second, least.astype(np.float64)))
    if code is not None:
        # an entry given up is one of its group's others now
        left = np.flatnonzero((at != old) & ~scan[each, book.of[old]])
        ready[left, book.of[old[left]]] = np.minimum(ready[left, book.of[old[left]]], roots(old_best[left]))
    return at, best, ready, scanned


SCALE = 8  # units of a bound to a unit of distance


def to_units(bounds: np.ndarray) -> np.ndarray:
    """Bounds rounded down to 16 bits, with room for the roots' rounding."""
    return np.floor(np.minimum(bounds * (1 - 1e-9) * SCALE, 65535)).astype("<u2")


def sums_of(x: np.ndarray, code: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows of each entry, their sums) as Python integers where longs might not do."""
    count = np.bincount(code, minlength=k)
    if not len(x) or float(np.abs(x).max(initial=0)) * len(x) < 2.0**53:
        return count, np.stack([np.bincount(code, x[:, j], k) for j in range(x.shape[1])], 1).astype(np.int64).astype(object) if x.shape[1] else np.zeros((k, 0), object)
    total = np.full((k, x.shape[1]), 0, object)
    np.add.at(total, code, whole(x))
    return count, total


def one_pass(books: list[Codebook], width: int, first: bool, last: bool):
    """A pass over the state: codes and bounds for these codebooks; tagged rows hold each task's sums, or, in the last pass, rows their errors."""
    part = width // PARTS
    kinds = {"row": pa.int64(), "vec_id": pa.int64(), "label": pa.string(), "vector": pa.binary(), "code": pa.binary(), "bounds": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: list[list] = [[np.zeros(len(b.entries), np.int64), np.full((len(b.entries), part), 0, object)] for b in books]
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                some = batch.slice(at, ROWS)
                x = unpacked(some.column("vector").to_pylist(), width)
                n = len(x)
                codes, errors, bounds = [], np.full(n, 0, object) if last else None, []
                if not first:
                    old = np.frombuffer(b"".join(some.column("code").to_pylist()), np.uint8).reshape(n, PARTS)
                    kept = np.frombuffer(b"".join(some.column("bounds").to_pylist()), "<u2").reshape(n, -1) / SCALE
                    cuts = np.cumsum([0, *(len(b.groups) for b in books)])
                for p, book in enumerate(books):
                    own = x[:, p * part : (p + 1) * part]
                    code, best, bound, _ = nearest(own, book, None if first else old[:, p], None if first else kept[:, cuts[p] : cuts[p + 1]])
                    codes.append(code)
                    if last:
                        errors = errors + whole(best)
                        continue
                    bounds.append(to_units(bound))
                    count, sums = sums_of(own, code, len(book.entries))
                    total[p][0] += count
                    total[p][1] += sums
                code = np.stack(codes, 1).astype(np.uint8)
                if last:
                    fits = [int(e) if e < 1 << 63 else None for e in errors]
                    yield pa.RecordBatch.from_arrays([*(some.column(c) for c in ("vec_id", "label")), pa.array([r.tobytes().hex() for r in code]), pa.array(fits, pa.int64())], ["vec_id", "label", "code", "error"])
                else:
                    units = np.concatenate(bounds, 1)
                    made = [pa.array([r.tobytes() for r in code], pa.binary()), pa.array([r.tobytes() for r in units], pa.binary())]
                    none = [pa.nulls(n, k) for k in (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.decimal128(38, 0)))]
                    yield pa.RecordBatch.from_arrays([pa.array(np.zeros(n, np.int32)), *(some.column(c) for c in ("row", "vec_id", "label", "vector")), *made, *none], ["kind", *kinds, "part", "entry", "count", "sums"])
        if not last:
            used = [(p, e, int(c), [Decimal(int(v)) for v in s]) for p, (count, sums) in enumerate(total) for e, (c, s) in enumerate(zip(count, sums)) if c]
            if used:
                cols = list(zip(*used))
                yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(used), np.int32)), *(pa.nulls(len(used), k) for k in kinds.values()), pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.list_(pa.decimal128(38, 0)))], ["kind", *kinds, "part", "entry", "count", "sums"])

    return run


def updated(books: list[Codebook], sums: DataFrame, part: int) -> list[Codebook]:
    """Each used entry becomes floor(sum / count), component by component; at most PARTS * ENTRIES entries reach the driver."""
    counts = {(r["part"], r["entry"]): r["n"] for r in sums.groupBy("part", "entry").agg(F.sum("count").alias("n")).collect()}
    each = sums.select("part", "entry", F.posexplode("sums").alias("at", "v")).groupBy("part", "entry", "at").agg(F.sum("v").alias("v"))
    new = [whole(b.entries) for b in books]
    for r in each.collect():
        new[r["part"]][r["entry"], r["at"]] = int(r["v"]) // counts[r["part"], r["entry"]]
    return [b.moved(tidy(e)) for b, e in zip(books, new)]


def compress(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of each row with a vector of finite components."""
    spark = df.sparkSession
    own = df.select(F.col(key).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(vector).cast("array<double>").alias("v"))
    sound = own.where(F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(2.0**63 / UNIT))))
    width = sound.agg(F.max(F.size("v")).alias("m")).first()["m"] or 0
    width = -(-width // PARTS) * PARTS
    part = width // PARTS
    filled = sound.withColumn("v", F.concat("v", F.array_repeat(F.lit(0.0), F.lit(width) - F.size("v"))))
    start = filled.orderBy(F.col("vec_id").asc_nulls_last(), F.transform("v", lambda x: F.floor(x * UNIT))).limit(ENTRIES).select("v").toArrow()
    seeds = np.array(floats(start.column("v").combine_chunks())).reshape(start.num_rows, width) if start.num_rows else np.zeros((0, width))
    books = [Codebook(seeds[:, p * part : (p + 1) * part]).grouped() for p in range(PARTS)]

    def packing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            none = pa.array([b""] * batch.num_rows, pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("vec_id"), batch.column("label"), pa.array([packed(x) for x in floats(batch.column("v"))], pa.binary()), none, none], STATE.replace(",", "").split()[::2])

    state, before = filled.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", "v").transform(short_batches).mapInArrow(packing, STATE), None
    schema = f"kind int, {STATE}, part int, entry int, count long, sums array<decimal(38,0)>"
    for r in range(rounds):
        path = fresh_path(spark, "codes")
        found = stored(state.transform(short_batches).mapInArrow(one_pass(books, width, r == 0, False), schema), path, ("kind",))
        if before:
            drop_path(spark, before)
        books, before = updated(books, found.where("kind = 1"), part), path
        state = found.where("kind = 0").select("row", "vec_id", "label", "vector", "code", "bounds")
    made = cut(state.transform(short_batches).mapInArrow(one_pass(books, width, rounds == 0, True), "vec_id long, label string, code string, error long"))
    if before:
        drop_path(spark, before)
    digest = hashlib.sha256(",".join(str(int(v)) for b in books for v in b.entries.ravel()).encode()).hexdigest()
    by_label = cut(made.groupBy("label").agg(F.try_sum("error").alias("label_error"))).select(F.col("label").alias("_label"), "label_error")
    out = made.join(by_label, F.col("label").eqNullSafe(F.col("_label")))
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def op12_vector_codes(spark, sf_dir: str) -> DataFrame:
    return compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _round_sql(r: int) -> str:
    """Codes by codebook c{r}: the nearest entry's (distance, index) of each part."""
    gap = "list_sum(list_transform(range(1, len(v.x) + 1), lambda j: (v.x[j] - c.x[j]) * (v.x[j] - c.x[j])))"
    return f"a{r} as materialized (select i, p, v.x, min(row(coalesce({gap}, 0)::bigint, c.e)) as best from v join c{r} c using (p) group by i, p, v.x)"


def _update_sql(r: int) -> str:
    floor = "(s - ((s % n) + n) % n) // n"
    sums = f"select p, e, list(({floor})::bigint order by j) as x from (select p, best[2] as e, j, sum(x[j]::hugeint) as s, count(*)::hugeint as n from a{r}, (select unnest(range(1, (select max(len(x)) from v) + 1)) as j) group by p, best[2], j) group by p, e"
    return f"c{r + 1} as materialized (select c.p, c.e, coalesce(s.x, c.x) as x from c{r} c left join ({sums}) s using (p, e))"


OP12_SQL = f"""
with k as materialized (select row_number() over (order by vec_id) - 1 as i, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as x from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
v as materialized (select i, p, x[p * len(x) // 4 + 1:(p + 1) * len(x) // 4] as x from k, range(4) t(p)),
c0 as (select p, i as e, x from v where i < 256),
{", ".join(f"{_round_sql(r)}, {_update_sql(r)}" for r in range(ROUNDS))}, {_round_sql(ROUNDS)},
h as (select sha256(string_agg(array_to_string(x, ','), ',' order by p, e)) as h from c{ROUNDS}),
o as (select i, string_agg(printf('%02x', best[2]::bigint), '' order by p) as code, sum(best[1])::bigint as error from a{ROUNDS} group by i)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, h as codebooks_sha256 from k join o using (i), h
"""
