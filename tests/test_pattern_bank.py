"""A bank of many patterns against the expressions of single ones, and a large one against plain Python."""

import random
import re

from pyspark.sql import functions as F

from loomline.operators import curation
from loomline.operators.curation import ErrorPattern, PatternBank

TEXTS = [
    None, "", "Overdose of aspirin; do  not\tuse.", "Do not use", "rule\nout", "white coat, whitecoat, white coat", "OFF-LABEL use", "a|b and a.b", "axb", "a\nb", "a\rb", "ÉTÉ été", "Error error ERROR",
    "10 mg", "x1 x_ xé", "Case Sensitive", "case sensitive", "aab ab b", "follow up follow-up followup", "(none)", "😀 error",
]
ODD = [
    ErrorPattern("dot", r"a.b", 0.9), ErrorPattern("escaped", r"a\.b", 0.8), ErrorPattern("pipe", r"a\|b", 0.7), ErrorPattern("digits", r"\d+\s*mg|x\w", 0.9), ErrorPattern("accent", r"été", 0.6), ErrorPattern("capital", r"Case\s+Sens", 0.65),
    ErrorPattern("group", r"(?:rule|white).?(?:out|coat)", 0.5), ErrorPattern("optional", r"a*ab|fol?low", 0.95), ErrorPattern("none", r"\s*\d?", 0.1), ErrorPattern("bracket", r"\(none\)", 0.4), ErrorPattern("word", r"\bmg\b", 0.3),
    ErrorPattern("twice", r"error|error\s+error", 0.2), ErrorPattern("face", r"😀.error", 0.77),
]


def test_equals_single_expressions(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, text string").repartition(3)
    for patterns in (curation.MEDICAL_PATTERNS, [*curation.MEDICAL_PATTERNS, *ODD], ODD[5:7]):
        bank = PatternBank(patterns)
        got = df.select("i", bank.best_match(F.col("text")).alias("b"), bank.all_matches(F.col("text")).alias("a")).orderBy("i").collect()
        want = df.select("i", curation.best_match(F.col("text"), patterns).alias("b"), curation.all_matches(F.col("text"), patterns).alias("a")).orderBy("i").collect()
        assert got == want
    assert any(r["a"] for r in want)
    none = df.select(PatternBank([]).best_match(F.col("text")).alias("b"), PatternBank([]).all_matches(F.col("text")).alias("a")).distinct().collect()
    assert [tuple(r) for r in none] == [(None, [])]


def test_five_thousand_patterns(spark):
    r = random.Random(2)
    word = lambda: "".join(r.choice("abcde") for _ in range(r.randint(3, 7)))
    patterns = [ErrorPattern(f"p{n}", "|".join(r.choice((word(), rf"{word()}\s+{word()}", f"{word()}.?{word()}")) for _ in range(2)), r.randint(1, 99) / 100) for n in range(5000)]
    texts = [" ".join(word().upper() if r.random() < 0.1 else word() for _ in range(60)) for _ in range(300)]
    bank = PatternBank(patterns)
    assert not bank.single
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").repartition(4)
    got = {x["i"]: (x["b"], x["a"]) for x in df.select("i", bank.best_match(F.col("text"))["name"].alias("b"), F.transform(bank.all_matches(F.col("text")), lambda m: m["name"]).alias("a")).collect()}
    tests = [(p.name, re.compile(p.pattern)) for p in sorted(patterns, key=lambda p: -p.confidence)]
    for i, t in enumerate(texts):
        want = [name for name, x in tests if x.search(t.lower())]
        assert got[i] == (want[0] if want else None, want)
