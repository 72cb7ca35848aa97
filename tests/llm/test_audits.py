"""Operators 11 to 13: source divergence, vector codes, line quality."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomline.llm import divergence, line_quality, vector_codes
from tests.llm import cases

CLASH = ("term", "n", "docs", "p", "item", "value", "rank", "key", "label", "code", "row", "kept", "a.b")


def made(spark, rows, schema=cases.SCHEMA):
    return spark.createDataFrame(rows, schema).withColumns({c: F.lit(1) for c in CLASH if not re.search(rf"\b{c}\b", schema)})


def audited(rows, least=30, most=50):
    """Everything dense, in Python integers."""
    groups, by, docs = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        terms = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        groups[lang, source].update(terms)
        by[lang].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, c in docs[lang].items() if c >= least]
        share = lambda c: {t: 1 + 1_000_000_000 * (c[t] + 5) // (sum(c[x] for x in kept) + 5 * len(kept)) for t in kept}
        own = {s: share(c) for (k, s), c in groups.items() if k == lang}
        whole = share(by[lang])
        for s, p in own.items():
            pairs = [(x, sum(abs(p[t] - q[t]) for t in kept)) for x, q in own.items() if x != s]
            terms = [(t, p[t] - whole[t]) for t in kept if groups[lang, s][t] and p[t] > whole[t]]
            for part, items, top in (("pair", pairs, len(pairs)), ("term", terms, most)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, x, v, i + 1) for i, (x, v) in enumerate(items[:top])]
    return sorted(out)


def test_divergence_awkward_rows(spark):
    rows = cases.ROWS * 2 + [(None, "É éa bB BB bb a_b1c", None, None, 1), (70, "bb", "", "s", 1), (70, None, "xx", "only", 0), (71, "", "xx", "other", 0)] + [(i, f"the é{i % 3} bb", "en", f"s{i % 2}", 1) for i in range(100, 140)]
    got = divergence.audit(made(spark, rows), least=3).collect()
    assert sorted(map(tuple, got)) == audited(rows, 3)
    assert divergence.audit(made(spark, [])).collect() == []
    assert [r for r in got if r.lang == "xx"] and all(r.value == 0 and r.part == "pair" for r in got if r.lang == "xx")


@pytest.mark.parametrize("bits", [16, 4])
def test_divergence_random(spark, monkeypatch, bits):
    """Also with a sketch so narrow that it discards next to nothing."""
    r = random.Random(bits)
    words = ["".join(r.choice("abcdé") for _ in range(r.randint(1, 4))) for _ in range(400)]
    rows = [(i, " ".join(r.choice(words[: r.choice((20, 400))]) for _ in range(r.randint(0, 40))), r.choice(("en", "en", "fr", None)), r.choice("aaabcd"), 1) for i in range(500)]
    monkeypatch.setattr(divergence, "NARROWEST", bits)
    monkeypatch.setattr(divergence, "WIDEST", bits)
    monkeypatch.setattr(divergence, "BLOCK", 3 if bits == 4 else 14)
    assert sorted(map(tuple, divergence.audit(made(spark, rows).repartition(5)).collect())) == audited(rows)


def test_sketch_never_underestimates_and_discards(spark):
    rows = [(i, f"all w{'abcdefghij'[i % 10]} once{'q' * i}", "en", "s", 1) for i in range(290)]
    docs = made(spark, rows).repartition(4).select("lang", "source", "text")
    bits = 16
    possible = divergence.sketch(docs, bits, 30)
    found = {x["term"]: (x["docs"], x["n"]) for x in divergence.term_counts(docs, bits, possible).collect()}
    counts = Counter(t for x in rows for t in re.findall("[a-z]+", x[1]))
    assert all(found[t] == (n, n) for t, n in counts.items() if n >= 30)
    assert len(found) < 20 < len(counts)


def test_shares_are_exact_beyond_doubles(spark):
    n, total = 9_007_199_254_740_993, 9_007_199_254_740_999
    assert spark.sql(f"select {n}L as n, {total}L as t").select(divergence.share("n", "t").alias("p")).first()["p"] == 1 + 1_000_000_000 * (n + 5) // total


def coded(rows, rounds=4):
    """Plain Lloyd rounds in Python integers."""
    kept = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // 4) * 4
    kept = sorted(((i, v + [0] * (width - len(v)), label) for i, v, label in kept), key=lambda x: (x[0] is None, x[0], x[1]))
    cut = lambda v: [v[p * width // 4 : (p + 1) * width // 4] for p in range(4)]
    books = [[cut(v)[p] for _, v, _ in kept[:256]] for p in range(4)]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    assign = lambda: [[min((gap(x, e), k) for k, e in enumerate(books[p])) for p, x in enumerate(cut(v))] for _, v, _ in kept]
    for _ in range(rounds):
        codes = assign()
        for p in range(4):
            mine = defaultdict(list)
            for (_, v, _), c in zip(kept, codes):
                mine[c[p][1]].append(cut(v)[p])
            for k, members in mine.items():
                books[p][k] = [sum(x) // len(members) for x in zip(*members)]
    codes = assign()
    errors, labels = [sum(d for d, _ in c) for c in codes], Counter()
    for (_, _, label), e in zip(kept, errors):
        labels[label] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted([(i, "".join(f"{k:02x}" for _, k in c), e, labels[label], digest) for (i, _, label), c, e in zip(kept, codes, errors)], key=str)


VECTORS = "vec_id long, embedding array<float>, label int"


def compressed(spark, rows, schema=VECTORS):
    return sorted(map(tuple, vector_codes.compress(made(spark, rows, schema).repartition(3)).collect()), key=str)


def test_vector_codes_random_with_ties(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in rng.integers(-2, 3, 8) / 512], int(i % 4) if i % 7 else None) for i in rng.permutation(900)]
    assert compressed(spark, rows) == coded(rows)


def test_vector_codes_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(5, [1.0, 2.0, 3.0, 4.0], 1), (5, [1.0, 2.0, 3.0, 4.0], 1), (4, [0.5, -0.25, 0.0, 1.0], None), (None, [1.0, 1.0, 1.0, 1.0], None), (3, None, 2), (2, [1.0, None, 1.0, 1.0], 2), (1, [nan, 0.0, 0.0, 0.0], 2), (0, [inf, 0.0, 0.0, 0.0], 2), (9, [1.0, 2.0], 3), (8, [], 3), (7, [-1e-4] * 5, 3)]
    assert compressed(spark, rows) == coded(rows)
    assert compressed(spark, []) == [] == compressed(spark, [(1, None, 1)])
    assert compressed(spark, [(1, [], 1), (2, [], None)]) == coded([(1, [], 1), (2, [], None)])


def test_vector_codes_large_components(spark):
    """Components beyond 16 bits, beyond what doubles square exactly, and beyond longs."""
    rng = np.random.default_rng(4)
    size = lambda i: 10 ** (2 + 3 * (i % 5))
    rows = [(i, [float(x) for x in rng.integers(-size(i), size(i), 4)], i % 5) for i in range(300)]
    long = lambda x: x if x < 1 << 63 else None
    got = compressed(spark, [*rows, (999, [1e300, 0.0, 0.0, 0.0], 0), (998, [2.0**53, 0.0, 0.0, 0.0], 0)], "vec_id long, embedding array<double>, label int")
    want = coded(rows)
    assert [(*x[:2], x[4]) for x in got] == [(*x[:2], x[4]) for x in want] and [x[2] for x in got] == [long(x[2]) for x in want]
    assert {x[0] % 5: x[3] for x in got if x[0] % 5 < 3} == {x[0] % 5: long(x[3]) for x in want if x[0] % 5 < 3}
    assert any(x[2] is None for x in got)


def test_bounds_skip_groups_and_change_nothing():
    rng = np.random.default_rng(5)
    x = np.floor(rng.normal(size=(40, 6))[rng.integers(0, 40, 4000)] * 300 + rng.normal(size=(4000, 6)) * 20)
    book, code, bounds, shares = vector_codes.Codebook(x[:256].copy()).grouped(), None, None, []
    for _ in range(6):
        code, best, low, scanned = vector_codes.nearest(x, book, code, bounds)
        full = ((x[:, None] - book.entries[None]) ** 2).sum(2)
        assert (code == full.argmin(1)).all() and (best == full.min(1)).all()
        bounds = vector_codes.to_units(low) / vector_codes.SCALE
        other = full.copy()
        other[np.arange(len(x)), code] = np.inf
        assert all((bounds[:, g] ** 2 <= other[:, m].min(1)).all() for g, m in enumerate(book.groups))
        shares.append(scanned / full.size)
        count, sums = vector_codes.sums_of(x, code, 256)
        new = book.entries.copy()
        for e in np.flatnonzero(count):
            new[e] = [int(s) // int(count[e]) for s in sums[e]]
        book = book.moved(new)
    assert shares[0] == 1 and shares[-1] < 0.35


def measured(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {k for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for k in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


JUNK = ["a | b | c | d | e | f", "BUY!! NOW!! CHEAP!! DEALS!!", "### *** $$$ ### ***", "go go go go go go go"]
PROSE = ["The river ran slowly past the old mill and its garden.", "Nobody had seen the ferry since early morning, he said.", "Later they walked home along the quiet road together."]


def training(spark, n=120):
    r = random.Random(9)
    docs = [(i, "\n".join(r.choice(PROSE if i % 3 else JUNK) + r.choice(("", " so", " yet")) for _ in range(r.randint(2, 6))), "en", "s", 1) for i in range(n)]
    return made(spark, docs), spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(n)] + [(None, 1), (5, None), (10_000, 0)], "doc_id long, quality int")


def test_line_quality_base_and_verdict(spark):
    field = line_quality.train(*training(spark))
    r = random.Random(10)
    texts = [*(x[1] for x in cases.ROWS), "\n\n \n", "a\r\nb\na\r\n\na", "x" * 200_000, "\n".join(["same line of a few words"] * 3000), " ".join(r.choice("ab") for _ in range(500)), "a b c d e f a b c d e", "é# ü|\n#\n#\n #"]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)] + [(None, "one", "en", "s", 1)] * 2
    got = line_quality.judge(made(spark, rows), field).collect()
    assert len(got) == len(rows)
    for x, (_, text, *_) in zip(sorted(got, key=lambda x: (x.doc_id is None, x.doc_id)), rows):
        want = measured(text)
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == want
        assert x.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0]) and not (x.base_failed and x.kept)
        assert x.kept == (not x.base_failed and 2 * x.content_words >= x.n_words)
    assert line_quality.judge(made(spark, []), field).count() == 0


def test_line_quality_labels_lines(spark):
    field = line_quality.train(*training(spark))
    mixed = [PROSE[0], JUNK[1], JUNK[0], PROSE[1], PROSE[2]]
    x = line_quality.judge(made(spark, [(1, "\n".join(mixed), "en", "s", 1), (2, "\n".join(JUNK[:2] + [JUNK[2] + " one two three four"]), "en", "s", 1), (3, " ".join(PROSE), "en", "s", 1)]), field).orderBy("doc_id").collect()
    assert [r.kept for r in x] == [True, False, True] and x[0].n_content_lines == 3 and x[0].n_lines == 5
    none = line_quality.train(made(spark, []), spark.createDataFrame([], "doc_id long, quality int"))
    assert all(r.n_content_lines == r.n_lines for r in line_quality.judge(made(spark, [(1, "\n".join(JUNK), "en", "s", 1)]), none).collect())


def test_line_quality_on_held_out_documents(spark):
    """Fitted on some labelled documents, judged on others; what the base rules leave."""
    folder = "/root/testdata/sf0.01"
    try:
        docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    except Exception:
        pytest.skip("no test tables")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    field = line_quality.train(docs, labels.where(~held))
    seen = line_quality.judge(docs, field).join(labels.where(held), "doc_id").where("not base_failed").groupBy("quality", "kept").count().collect()
    n = {(r["quality"], r["kept"]): r["count"] for r in seen}
    assert n[1, True] > 100 and n.get((1, False), 0) == 0 and n[0, False] > 5 and n.get((0, True), 0) <= 1


def test_chain_likelihood_and_gradient_by_brute_force():
    from itertools import product

    rng = np.random.default_rng(6)
    size = [3, 1, 4]
    levels = np.stack([rng.integers(0, n, sum(size)) for n in line_quality.LEVELS], 1)
    new = np.zeros(sum(size), bool)
    new[np.cumsum([0, *size[:-1]])] = True
    y, w = rng.integers(0, 2, sum(size)), rng.normal(size=(sum(line_quality.LEVELS) + 3, 2))
    at = np.cumsum([0, *line_quality.LEVELS])

    def score(w, labels):
        total = 0.0
        for i, k in enumerate(labels):
            total += sum(w[at[f] + levels[i, f], k] for f in range(len(line_quality.LEVELS))) + (w[-1, k] if new[i] else w[at[-1] + labels[i - 1], k])
        return total

    def log_likelihood(w):
        return score(w, y) - math.log(sum(math.exp(score(w, k)) for k in product((0, 1), repeat=len(y)))) - 0.25 * (w * w).sum()

    got, slope = line_quality.likelihood(w, levels, new, y, 0.5)
    assert math.isclose(got, log_likelihood(w), rel_tol=1e-9)
    for i, j in [(0, 0), (int(at[-1]), 1), (int(at[-1]) + 1, 0), (len(w) - 1, 1), (int(at[3] + levels[0, 3]), 0)]:
        step = np.zeros_like(w)
        step[i, j] = 1e-6
        assert math.isclose(slope[i, j], (log_likelihood(w + step) - log_likelihood(w - step)) / 2e-6, abs_tol=1e-5)
    field = line_quality.LineField([w[a:b] for a, b in zip(at, at[1:])], w[at[-1] : at[-1] + 2], w[-1])
    best = max(product((0, 1), repeat=len(y)), key=lambda k: score(w, k))
    assert tuple(field.labels(levels, new)) == best


def test_repeated_windows_by_brute_force():
    r = random.Random(12)
    for _ in range(60):
        docs = [[r.choice("abc" if r.random() < 0.5 else "abcdefgh") for _ in range(r.randint(0, 40))] for _ in range(3)]
        found = line_quality.described(pa.array([" ".join(d) for d in docs])).base["n_repeat_words"]
        assert found.tolist() == [measured(" ".join(d))[4] for d in docs]
