"""Curation: deduplication, shuffle and split, judging, demonstrations, curriculum."""

from __future__ import annotations

import hashlib
import ipaddress
import json
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from urllib.parse import urlparse
from urllib.request import Request, urlopen

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.functions.text import WS, col, fingerprint, has_any, let, n_words, strip, tokens

# Fixed values.
WEIGHTS = {"quality": 0.30, "safety": 0.25, "cost": 0.15, "domain": 0.15, "performance": 0.10, "usability": 0.05}
JUDGE_STOP_WORDS = ("the", "is", "are", "and", "or", "for", "how", "what", "why", "this", "that", "with", "from", "use")
REFUSAL = r"(?i)\b(i (cannot|can't|am unable to|don't know)|as an ai|i do not have|i'm not sure|i apologize|unclear|unknown|n/a)\b"
HARM = r"(?i)\b(ignore (previous|all) instructions?|drop (table|database)|delete (all|from)|rm -rf|format (c:|disk)|shutdown|jailbreak)\b"
CODE_BLOCK = r"(?s)```.*?```"
LIST_ITEM = r"(?m)^\s*[-*\d]+[.)]\s"
ACTION_WORDS = r"(?iU)\b(use|run|execute|call|select|insert|update|delete|create|drop|set|get|return|example|below|following|steps?|first|then|finally)\b"
HEDGE_WORDS = r"(?iU)\b(maybe|perhaps|might|could|possibly|generally|typically|usually|sometimes|often)\b"


def pair_fingerprint(question: str, answer: str) -> Column:
    return fingerprint(F.concat_ws("\n", F.coalesce(question, F.lit("")), F.coalesce(answer, F.lit(""))))


def dedup_first(df: DataFrame, question: str = "question", answer: str = "answer", within: Sequence[str] = ("origin",), order: Sequence[str] = ("seq",)) -> DataFrame:
    """The first row of each fingerprint of question and answer, within each origin."""
    w = Window.partitionBy(*within, "_fp").orderBy(*order)
    return df.withColumn("_fp", pair_fingerprint(question, answer)).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_fp", "_n")


def shuffle_key(seed: int, *columns: str) -> Column:
    return F.md5(F.concat_ws("\x1f", F.lit(str(seed)), *(F.col(c).cast("string") for c in columns)))


def split_train_val(df: DataFrame, ids: Sequence[str], val_ratio: float = 0.15, seed: int = 42) -> DataFrame:
    """df with `split`: the last max(1, floor(n * ratio)) rows of a seeded shuffle are `val`.

    Counts per hash bucket (65,536 of them) tell which bucket holds the last training row; only that bucket is put in
    order, to find this row. All rows are then compared with it where they are, without a shuffle.
    """
    key, bucket = shuffle_key(seed, *ids), lambda k: F.conv(F.substring(k, 1, 4), 16, 10).cast("int")
    keys = df.select(F.struct(key.alias("k"), *(F.col(c).alias(f"i{n}") for n, c in enumerate(ids))).alias("_at")).withColumn("_b", bucket(F.col("_at.k")))
    sizes = keys.groupBy("_b").agg(F.count("*").alias("_n"))
    ahead, total = F.coalesce(F.sum("_n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), F.sum("_n").over(Window.partitionBy())
    sizes = sizes.select("_b", "_n", ahead.alias("_before"), total.alias("_total"))
    need = F.col("_total") - F.greatest(F.lit(1), F.floor(F.col("_total") * val_ratio)) - F.col("_before")
    edge = sizes.withColumn("_need", need).where("_need > 0 and _need <= _n").select("_b", "_need")
    inside = keys.join(F.broadcast(edge), "_b").withColumn("_rank", F.row_number().over(Window.partitionBy("_b").orderBy("_at")))  # one row is broadcast
    last = inside.where("_rank = _need").agg(F.max("_at").alias("_last"))  # null where no row is left for training
    mine = F.struct(key.alias("k"), *(F.col(c).alias(f"i{n}") for n, c in enumerate(ids)))
    out = df.crossJoin(F.broadcast(last)).withColumn("split", F.when(mine <= F.col("_last"), "train").otherwise("val"))
    return out.drop("_last")


# ---- judge


def rounded(c: Column, places: int = 4) -> Column:
    """c at so many places: the product with the power of ten is rounded, as SQL engines do it, where Spark's round() goes by the shortest decimal of c. They differ on ties."""
    return F.round(c * 10**places) / 10**places


def quality(q: Column, a: Column) -> Column:
    stop = F.array(*map(F.lit, JUDGE_STOP_WORDS))
    qs, as_ = (F.array_except(F.array_distinct(tokens(x, "[a-zA-Z]{3,}")), stop) for x in (q, a))
    overlap = F.size(F.array_intersect(qs, as_)) / F.greatest(F.size(qs), F.lit(1))
    overlap = F.when(a.rlike(REFUSAL), F.greatest(F.lit(0.0), overlap - 0.4)).otherwise(overlap)
    ratio = F.least(F.length(a) / F.greatest(F.length(q) * 1.5, F.lit(50.0)), F.lit(1.0))
    return F.when(strip(a) == "", 0.0).otherwise(rounded(F.least(overlap * 0.6 + ratio * 0.4, F.lit(1.0)), 4))


def safety(a: Column) -> Column:
    return F.when(a.rlike(HARM), 0.0).when(a.rlike(REFUSAL), 0.6).otherwise(1.0)


def cost(q: Column, a: Column) -> Column:
    r = n_words(a) / F.greatest(n_words(q), F.lit(1))
    return rounded(F.when(r <= 4, 1.0).when(r <= 8, 1 - (r - 4) / 8).otherwise(F.greatest(F.lit(0.0), 0.5 - (r - 8) / 16)), 4)


def domain_share(a: Column, keywords: Sequence[str]) -> Column:
    if not keywords:
        return F.lit(1.0)
    low = F.lower(a)
    hits = sum((low.contains(k.lower()).cast("int") for k in keywords), F.lit(0))
    return rounded(hits / len(keywords), 4)


def has_code(a: Column) -> Column:
    return a.rlike(CODE_BLOCK)


def has_list(a: Column) -> Column:
    return F.regexp_count(a, F.lit(LIST_ITEM)) >= 2


def performance(a: Column) -> Column:
    plain = ~has_code(a) & ~has_list(a) & (n_words(a) < 20)
    return rounded(F.when(plain, 0.2).otherwise(F.lit(0.5) + F.when(has_code(a), 0.3).otherwise(0.0) + F.when(has_list(a), 0.2).otherwise(0.0)), 4)


def usability(a: Column) -> Column:
    n = F.greatest(n_words(a), F.lit(1))
    action, hedge = F.regexp_count(a, F.lit(ACTION_WORDS)) / n, F.regexp_count(a, F.lit(HEDGE_WORDS)) / n
    return rounded(F.greatest(F.lit(0.0), F.least(F.least(action * 5, F.lit(0.8)) + 0.2 - hedge * 2, F.lit(1.0))), 4)


def combine(scores: dict[str, Column], strategy: str = "weighted_average", weights: dict[str, float] | None = None, threshold: float = 0.6) -> Column:
    """One confidence of the scores: weighted_average, all_must_pass (their least), majority_pass, any_pass, min_score or max_score."""
    vals = list(scores.values())
    if strategy == "weighted_average":
        w = {k: (weights or WEIGHTS).get(k, 1.0) for k in scores}
        total = sum(w.values())
        return rounded(sum((v * w[k] for k, v in scores.items()), F.lit(0.0)) / total, 4) if total else F.lit(0.0)
    passing = sum((F.when(v >= threshold, 1).otherwise(0) for v in vals), F.lit(0))
    return {
        "all_must_pass": rounded(F.least(*vals), 4), "min_score": rounded(F.least(*vals), 4), "max_score": rounded(F.greatest(*vals), 4),
        "majority_pass": rounded(passing / len(vals), 4), "any_pass": F.when(passing > 0, 1.0).otherwise(0.0),
    }[strategy]


def level(confidence: Column) -> Column:
    return F.when(confidence >= 0.8, "HIGH").when(confidence >= 0.5, "MEDIUM").otherwise("LOW")


def judge_action(confidence: Column) -> Column:
    return F.when(confidence >= 0.8, "auto_accept").when(confidence >= 0.5, "monitor").otherwise("escalate")


def flags(q: Column, a: Column, keywords: Sequence[str] = ()) -> Column:
    """What speaks against an answer, in the order of the scores."""
    r = n_words(a) / F.greatest(n_words(q), F.lit(1))
    hedge = F.regexp_count(a, F.lit(HEDGE_WORDS)) / F.greatest(n_words(a), F.lit(1))
    tests = [
        (strip(a) == "", "empty answer"), ((strip(a) != "") & a.rlike(REFUSAL), "refusal detected"), (a.rlike(HARM), "harmful content detected"), (~a.rlike(HARM) & a.rlike(REFUSAL), "refusal / uncertainty"),
        ((r > 4) & (r <= 8), "verbose answer"), (r > 8, "very verbose answer"), (domain_share(a, keywords) < 0.3, "low domain vocabulary coverage"),
        (~has_code(a) & ~has_list(a) & (n_words(a) < 20), "very short / unstructured answer"), (hedge > 0.05, "hedging language detected"),
    ]
    return F.array_compact(F.array(*(F.when(t, F.lit(name)) for t, name in tests)))


def judged(df: DataFrame, question: str = "question", answer: str = "answer", keywords: Sequence[str] = (), strategy: str = "weighted_average", weights: dict[str, float] | None = None, threshold: float = 0.6) -> DataFrame:
    """df with the six scores, flags, confidence, level and action."""
    q, a = (F.coalesce(F.col(c), F.lit("")) for c in (question, answer))
    scores = {"quality": quality(q, a), "safety": safety(a), "cost": cost(q, a), "domain": domain_share(a, keywords), "performance": performance(a), "usability": usability(a)}
    out = df.withColumns(scores).withColumn("flags", flags(q, a, keywords))
    out = out.withColumn("confidence", combine({k: F.col(k) for k in scores}, strategy, weights, threshold))
    return out.withColumn("level", level(F.col("confidence"))).withColumn("action", judge_action(F.col("confidence")))


def gate(confidence: Column, threshold: float = 0.6) -> Column:
    return confidence >= threshold


SCORES = tuple(WEIGHTS)


# Default wording.
JUDGE_TASK = "You are a strict judge of question and answer pairs. Reply with one JSON object that has a number from 0 to 1 for each of: {names}. No other text."
JUDGE_PAIR = "QUESTION: {question}\n\nANSWER: {answer}"


def judge_messages(question: Column, answer: Column, task: str = JUDGE_TASK, pair: str = JUDGE_PAIR) -> Column:
    """The chat that asks a model for the six scores; null where question or answer is blank. task and pair are the caller's wording."""
    q, a = strip(question), strip(answer)
    before, rest = pair.split("{question}")
    between, after = rest.split("{answer}")
    says = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    chat = F.array(says("system", F.lit(task.format(names=", ".join(SCORES)))), says("user", F.concat(F.lit(before), q, F.lit(between), a, F.lit(after))))
    return F.when((q != "") & (a != ""), chat)


def local_backend(complete: Callable[[list[dict]], str]) -> Callable[[Column], Column]:
    """A backend from a function on one chat (a list of role and content): replies by Arrow batches on the executors; a call that fails or a null chat replies null."""
    @F.pandas_udf("string")
    def replies(chats: pd.Series) -> pd.Series:
        def one(chat) -> str | None:
            try:
                return None if chat is None else complete([dict(m) for m in chat])
            except Exception:  # a failed call is a missing reply; the heuristic judge stands in
                return None

        return chats.map(one)

    return replies


def http_backend(url: str, model: str, timeout: float = 30.0) -> Callable[[Column], Column]:
    """A backend that posts chats to a local completion server. Hosts that aren't local are refused."""
    host = urlparse(url).hostname or ""
    if not (host == "localhost" or host.endswith(".local") or _is_private(host)):
        raise ValueError(f"{host or url} isn't a local host")

    def complete(chat: list[dict]) -> str:
        body = json.dumps({"model": model, "messages": chat, "temperature": 0}).encode()
        with urlopen(Request(url, body, {"Content-Type": "application/json"}), timeout=timeout) as got:
            return json.load(got)["choices"][0]["message"]["content"]

    return local_backend(complete)


def _is_private(host: str) -> bool:
    try:
        return ipaddress.ip_address(host).is_private or ipaddress.ip_address(host).is_loopback
    except ValueError:
        return False


def model_judged(df: DataFrame, backend: Callable[[Column], Column], question: str = "question", answer: str = "answer", **options) -> DataFrame:
    """hybrid_judged() with the backend's replies to judge_messages()."""
    asked = df.withColumn("_reply", backend(judge_messages(F.col(question), F.col(answer))))
    return hybrid_judged(asked, "_reply", question=question, answer=answer, **options).drop("_reply")


def parse_model_scores(reply: Column) -> Column:
    """struct of the six scores clamped to 0..1 from a model's reply (fences and text around the object allowed), or null if any is missing."""
    body = F.regexp_replace(F.coalesce(reply, F.lit("")), r"```(?:json)?", "")
    obj = F.from_json(F.regexp_extract(body, r"(?s)(\{[^{}]*\})", 1), ", ".join(f"{k} string" for k in SCORES))
    vals = {k: F.greatest(F.lit(0.0), F.least(F.lit(1.0), obj[k].try_cast("double"))) for k in SCORES}
    complete = F.lit(True)
    for k in SCORES:
        complete = complete & obj[k].try_cast("double").isNotNull()
    return F.when(complete, F.struct(*(v.alias(k) for k, v in vals.items())))


def hybrid_judged(df: DataFrame, reply: str, **options) -> DataFrame:
    """judged(), with a model's scores where its reply parses; the others get the flag heuristic_fallback."""
    out = judged(df, **options).withColumn("_m", parse_model_scores(F.col(reply)))
    out = out.withColumns({k: F.coalesce(F.col("_m")[k], F.col(k)) for k in SCORES})
    out = out.withColumn("flags", F.when(F.col("_m").isNull(), F.array_append("flags", F.lit("heuristic_fallback"))).otherwise(F.array().cast("array<string>")))
    out = out.withColumn("confidence", combine({k: F.col(k) for k in SCORES}, options.get("strategy", "weighted_average"), options.get("weights")))
    return out.withColumn("level", level(F.col("confidence"))).withColumn("action", judge_action(F.col("confidence"))).drop("_m")


# Size classes of a dataset's rows.
SIZE_CLASSES = (50, 200, 1000)


def size_class(n: Column) -> Column:
    """<50, <200, <1000 or >=1000."""
    out = F.lit(f">={SIZE_CLASSES[-1]}")
    for most in reversed(SIZE_CLASSES):
        out = F.when(n < most, f"<{most}").otherwise(out)
    return out


def size_classes(df: DataFrame, n: str = "n_chars") -> DataFrame:
    """(bucket, n, chars): how many rows of each size class, and their total size."""
    return df.groupBy(size_class(F.col(n)).alias("bucket")).agg(F.count("*").alias("n"), F.sum(n).alias("chars"))


def systematic_sample(df: DataFrame, k: int = 15, seq: str = "seq") -> DataFrame:
    """Every max(1, n // k)-th row by its position (from 0)."""
    step = df.agg(F.greatest(F.floor(F.count("*") / k), F.lit(1)).alias("_step"))  # one row
    return df.crossJoin(F.broadcast(step)).where(F.pmod(F.col(seq), F.col("_step")) == 0).drop("_step")


def token_overlap(a: Column, b: Column, pattern: str = "[a-z]{3,}") -> Column:
    """struct of how many different tokens two texts share, have together, and how many only the first has."""
    return let(F.struct(F.array_distinct(tokens(a, pattern)).alias("a"), F.array_distinct(tokens(b, pattern)).alias("b")), lambda s: F.struct(
        F.size(F.array_intersect(s["a"], s["b"])).alias("common"), F.size(F.array_union(s["a"], s["b"])).alias("total"), F.size(F.array_except(s["a"], s["b"])).alias("only_first"),
    ))


def ready(df: DataFrame) -> DataFrame:
    """One row: whether there is anything to train on. Reads one row at most."""
    return df.limit(1).agg((F.count("*") > 0).alias("ready"))


# ---- demonstrations


def candidate_pair(df: DataFrame) -> tuple[Column, Column]:
    """Question and answer of a candidate: the first filled of question, instruction, prompt and of answer, output, response."""
    def first(*names: str) -> Column:
        have = [F.when(F.col(n) != "", F.col(n)) for n in names if n in df.columns]
        return strip(F.coalesce(*have, F.lit("")))

    return first("question", "instruction", "prompt"), first("answer", "output", "response")


def ranked(df: DataFrame, order: Sequence[Column], k: int | None = None, within: Sequence[str] = ()) -> DataFrame:
    """df with `rank` from 1 by order; at most k. Without k and groups one task ranks all rows: such ranks are for reports."""
    if not within and k is not None:
        df = df.orderBy(*order).limit(k)
    out = df.withColumn("rank", F.row_number().over(Window.partitionBy(*within).orderBy(*order)))
    return out if k is None else out.where(F.col("rank") <= k)


def top_demonstrations(scored: DataFrame, k: int = 10, min_confidence: float = 0.0, seq: str = "seq") -> DataFrame:
    return ranked(scored.where(F.col("confidence") >= min_confidence), [F.desc("confidence"), F.asc(seq)], k)


def distilled(teacher: DataFrame, student: DataFrame, k: int = 10, min_confidence: float = 0.0, boost: float = 0.1, seq: str = "seq") -> DataFrame:
    """The best of two scored pools: teachers get a boost and win ties."""
    t = teacher.withColumn("confidence", F.least(F.col("confidence") + boost, F.lit(1.0))).withColumn("is_teacher", F.lit(1))
    both = t.unionByName(student.withColumn("is_teacher", F.lit(0)))
    return ranked(both.where(F.col("confidence") >= min_confidence), [F.desc("confidence"), F.desc("is_teacher"), F.asc(seq)], k)


# ---- curriculum


@dataclass(frozen=True)
class ErrorPattern:
    name: str
    pattern: str
    confidence: float
    phase: str = "unknown"
    fix_hint: str = ""
    error_code: str = ""


# The default bank.
MEDICAL_PATTERNS = (
    ErrorPattern("contraindication", r"contraindic|do\s+not\s+use|avoid\s+in|not\s+recommended\s+for", 0.95, "safety", "Review contraindications and choose an alternative therapy.", "CLIN_CONTRA_001"),
    ErrorPattern("drug_interaction", r"interaction|potentiates|inhibits\s+metabolism|serotonin\s+syndrome", 0.92, "pharmacology", "Check medication list and adjust or monitor interacting agents.", "CLIN_INTERACT_002"),
    ErrorPattern("dosage_error", r"overdose|subtherapeutic|incorrect\s+dose|toxic\s+dose|underdose", 0.90, "prescribing", "Verify weight, renal function, and guideline-recommended dose.", "CLIN_DOSE_003"),
    ErrorPattern("diagnosis_uncertainty", r"differential\s+diagnosis|rule\s+out|confirm\s+with|white.?coat", 0.85, "diagnosis", "Confirm diagnosis with repeated measurements or additional workup.", "CLIN_DX_004"),
    ErrorPattern("monitoring_required", r"monitor|follow.?up|reassess\s+in|surveillance|track\s+blood\s+pressure", 0.82, "follow_up", "Schedule follow-up and document monitoring plan.", "CLIN_MONITOR_005"),
    ErrorPattern("adverse_event", r"adverse|side\s+effect|anaphylaxis|bleeding|hypotension|syncope", 0.80, "safety", "Assess severity, stop offending agent if needed, and treat symptoms.", "CLIN_ADVERSE_006"),
    ErrorPattern("guideline_deviation", r"off.?label|guideline|evidence.?based|standard\s+of\s+care", 0.75, "quality", "Align plan with current clinical guidelines and document rationale.", "CLIN_GUIDE_007"),
    ErrorPattern("missing_history", r"patient\s+history|allergy|pregnancy|comorbid|renal\s+function", 0.72, "assessment", "Collect complete history before finalizing treatment.", "CLIN_HISTORY_008"),
    ErrorPattern("documentation_gap", r"unclear\s+indication|missing\s+documentation|incomplete\s+assessment", 0.65, "quality", "Document indication, shared decision-making, and follow-up plan."),
    ErrorPattern("generic_error", r"error|exception|failed|failure|concern", 0.30, "unknown", "Manual clinical review required."),
)


CLINICAL_WORDS = ("patient", "medication", "treatment", "diagnosis", "protocol", "dosage")


def add_pattern(patterns: Sequence[ErrorPattern], new: ErrorPattern) -> tuple[ErrorPattern, ...]:
    """The bank with one more pattern, by confidence."""
    return tuple(_bank([*patterns, new]))


def _bank(patterns: Sequence[ErrorPattern]) -> list[ErrorPattern]:
    return sorted(patterns, key=lambda p: -p.confidence)


def _match(p: ErrorPattern) -> Column:
    return F.struct(F.lit(p.name).alias("name"), F.lit(p.confidence).alias("confidence"), F.lit(p.phase).alias("phase"), F.lit(p.fix_hint).alias("fix_hint"), F.lit(p.error_code).alias("error_code"))


def _stem(alternative: str) -> str | None:
    """The longest text that each match of a regular expression without alternatives holds, or None where that isn't plain."""
    plain = re.sub(r"\\.[+*?]?|\.[+*?]?|.[?*]", "\0", alternative)
    return None if re.search(r"[\[\](){}^$+|]", plain) else max(plain.split("\0"), key=len) or None


def _hits(p: ErrorPattern, text: Column, low: Column) -> Column:
    """Whether the pattern is found in any case. A pattern without capitals is looked for in the lower-cased text: its
    alternatives' plain texts are searched for first, which is much faster than an expression, and decide alone where
    an alternative is nothing else."""
    if p.pattern != p.pattern.lower():
        return text.rlike("(?iu)" + p.pattern)
    alternatives = p.pattern.split("|")
    stems = [_stem(a) for a in alternatives]
    if r"\|" in p.pattern or any(s is None for s in stems):
        return low.rlike(p.pattern)
    out = F.lit(False)
    for a, s in sorted(zip(alternatives, stems), key=lambda x: x[0] != x[1]):  # plain ones first
        out = out | (low.contains(s) if a == s else low.contains(s) & low.rlike(a))
    return out


_MATCH = "struct<name:string,confidence:double,phase:string,fix_hint:string,error_code:string>"
_PLAIN = re.compile(r"(?:\\[sdwSDW][+*]?|\\[^A-Za-z0-9\s]|[^\\.?*+]|\.|[?*])+")  # alternatives of which Python and Java think alike


class PatternBank:
    """A bank of any number of patterns, looked for at once.

    The plain texts that the patterns' alternatives hold (their stems) make one automaton, which reads each text once; an
    alternative's expression runs only where its stem is found. A pattern that has capitals, or an alternative without a
    stem, is looked for by an expression of its own. The automaton is made once by each Python worker.
    """

    def __init__(self, patterns: Sequence[ErrorPattern]):
        self.patterns = _bank(patterns)
        self.stems: dict[str, list[tuple[int, str | None]]] = {}  # stem: patterns and what they ask for beside it
        self.single = []
        for n, p in enumerate(self.patterns):
            alternatives = p.pattern.split("|")
            stems = [_stem(a) for a in alternatives]
            if p.pattern != p.pattern.lower() or r"\|" in p.pattern or any(s is None or not _PLAIN.fullmatch(a) for a, s in zip(alternatives, stems)):
                self.single.append(n)
                continue
            for a, s in zip(alternatives, stems):
                self.stems.setdefault(s, []).append((n, None if a == s else re.sub(r"(\\.)|\.", lambda m: m[1] or r"[^\n\r\u0085\u2028\u2029]", a)))

    def found(self, text: Column) -> Column:
        """The places in the bank, by confidence, of the patterns that are found; null for a null text."""
        low, parts = F.lower(text), []
        if self.stems:
            parts.append(_automaton_udf(self.stems)(low))
        if self.single:
            parts.append(F.array_compact(F.array(*(F.when(_hits(self.patterns[n], text, low), F.lit(n)) for n in self.single))))
        both = F.array_sort(F.concat(*parts)) if parts else F.array().cast("array<int>")
        return F.when(text.isNotNull(), both)

    def _entries(self) -> Column:
        """The bank as one literal."""
        rows = [{"name": p.name, "confidence": p.confidence, "phase": p.phase, "fix_hint": p.fix_hint, "error_code": p.error_code} for p in self.patterns]
        return F.from_json(F.lit(json.dumps(rows)), f"array<{_MATCH}>")

    def best_match(self, text: Column) -> Column:
        """As best_match() with this bank."""
        return F.try_element_at(self._entries(), F.array_min(self.found(text)) + 1)

    def all_matches(self, text: Column) -> Column:
        """As all_matches() with this bank; a null text has none."""
        bank = self._entries()
        return F.transform(F.coalesce(self.found(text), F.array().cast("array<int>")), lambda n: F.element_at(bank, n + 1))


_AUTOMATA: dict[str, object] = {}  # of this worker


def _automaton_udf(stems: dict[str, list[tuple[int, str | None]]]):
    """array<int> of the patterns found in lower-cased texts, ascending."""
    key = hashlib.md5(repr(stems).encode()).hexdigest()

    def find(low: pd.Series) -> pd.Series:
        import ahocorasick

        from loomline.operators.curation import _AUTOMATA

        if key not in _AUTOMATA:
            made = ahocorasick.Automaton()
            for s, asked in stems.items():
                made.add_word(s, (s, [n for n, x in asked if x is None], [(n, re.compile(x, re.ASCII)) for n, x in asked if x is not None]))
            made.make_automaton()
            _AUTOMATA[key] = made
        words = _AUTOMATA[key]

        def one(text: str | None) -> list[int]:
            got, tried = set(), set()
            for _, (stem, plain, asked) in words.iter(text) if text else ():
                if stem not in tried:
                    tried.add(stem)
                    got.update(plain)
                    got.update(n for n, x in asked if n not in got and x.search(text))
            return sorted(got)

        return pd.Series([one(t) for t in low])

    return F.pandas_udf(find, "array<int>")


def best_match(text: Column, patterns: Sequence[ErrorPattern] = MEDICAL_PATTERNS) -> Column:
    """The pattern of highest confidence that is found, or null."""
    def first(low: Column) -> Column:
        out = F.lit(None).cast("struct<name:string,confidence:double,phase:string,fix_hint:string,error_code:string>")
        for p in reversed(_bank(patterns)):
            out = F.when(_hits(p, text, low), _match(p)).otherwise(out)
        return out

    return let(F.lower(text), first)


def all_matches(text: Column, patterns: Sequence[ErrorPattern] = MEDICAL_PATTERNS) -> Column:
    return let(F.lower(text), lambda low: F.array_compact(F.array(*(F.when(_hits(p, text, low), _match(p)) for p in _bank(patterns)))))


def plain_confidence(text: Column) -> Column:
    """Confidence without a match: long or structured texts are harder."""
    low = F.lower(text)
    hard = has_any(low, CLINICAL_WORDS) & text.rlike(rf"(?iU)\b({'|'.join(CLINICAL_WORDS)})\b") | text.contains("```") | has_any(text, ("def", "class")) & text.rlike(r"(?U)\bdef\b|\bclass\b")
    long = F.size(F.split(strip(text), WS + "+", 101)) > 100  # looks no further than the 101st word
    return F.greatest(F.lit(0.5), F.least(F.lit(0.72) - F.when(long, 0.10).otherwise(0.0) - F.when(hard, 0.05).otherwise(0.0), F.lit(0.75)))


def curriculum(df: DataFrame, text: Column | str | None = None, patterns: Sequence[ErrorPattern] = MEDICAL_PATTERNS) -> DataFrame:
    """df with `match`, `confidence`, `level` and `retry_action`. The text: the first column there is of output, answer, content, text, instruction."""
    if text is None:
        text = next((c for c in ("output", "answer", "content", "text", "instruction") if c in df.columns), None)
        text = F.to_json(F.struct(*df.columns)) if text is None else F.col(text)
    t = F.coalesce(col(text), F.lit(""))
    out = df.withColumn("match", best_match(t, patterns))
    out = out.withColumn("confidence", rounded(F.coalesce(F.col("match")["confidence"], plain_confidence(t)), 4)).withColumn("level", level(F.col("confidence")))
    return out.withColumn("retry_action", F.when(F.col("level") == "HIGH", "auto_retry").when(F.col("level") == "MEDIUM", "retry_with_monitoring").otherwise("escalate_to_human"))
