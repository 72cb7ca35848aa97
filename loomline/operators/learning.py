"""Learning from executions: metrics, recommendations, canaries, proposals, circuit breaker."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Canary:
    fraction: float = 0.10
    min_samples: int = 10
    alpha: float = 0.05
    test: str = "welch"  # or "step": significant above a difference of 5 points


@dataclass(frozen=True)
class Breaker:
    failures: int = 5
    successes: int = 3
    cooldown: float = 1800.0


def metric_confidence(n: Column) -> Column:
    return F.when(n == 0, 0.0).otherwise(1 / (1 + F.exp((n - 20) * -0.15)))


def recommendation(rate: Column, confidence: Column) -> Column:
    return F.when(confidence < 0.3, "INVESTIGATE").when((rate >= 0.85) & (confidence >= 0.6), "PROMOTE").when(rate >= 0.5, "KEEP").when(rate >= 0.2, "DEMOTE").otherwise("REMOVE")


def metrics(events: DataFrame, pattern: str = "pattern") -> DataFrame:
    """Per pattern: uses, successes, rate, mean cost and latency, confidence, recommendation. Works on streams in update mode too."""
    ok = F.count_if(F.col("success"))
    return judged(events.groupBy(pattern).agg(F.count("*").alias("total_uses"), ok.alias("success_count"), F.sum("cost_tokens").alias("total_cost"), F.sum("latency_ms").alias("total_latency")), pattern)


def judged(totals: DataFrame, pattern: str = "pattern") -> DataFrame:
    """metrics() from each pattern's totals."""
    out = totals.select(pattern, "total_uses", "success_count", "total_cost", "total_latency")
    rate = F.col("success_count") / F.col("total_uses")
    out = out.withColumn("success_rate", F.round(rate, 4)).withColumn("avg_cost", F.round(F.col("total_cost") / F.col("total_uses"), 2)).withColumn("avg_latency", F.round(F.col("total_latency") / F.col("total_uses"), 2))
    return out.withColumn("confidence", F.round(metric_confidence(F.col("total_uses")), 4)).withColumn("recommend", recommendation(rate, metric_confidence(F.col("total_uses"))))


def summaries(events: DataFrame, pattern: str = "pattern") -> DataFrame:
    return metrics(events, pattern).orderBy(F.desc("success_rate"), pattern)


def arm(key: Column, fraction: float = 0.10) -> Column:
    """control or treatment, by the key's hash: the same on every run and engine."""
    return F.when(F.conv(F.substring(F.md5(key.cast("string")), 1, 6), 16, 10).cast("double") / 16.0**6 < fraction, "treatment").otherwise("control")


NODES = 40


def t_tail(t: Column, df: Column) -> Column:
    """P(|T| >= t) of Student's t with df degrees of freedom, by Gauss-Legendre sums over the angle atan(t / sqrt(df)), whose density is cos ** (df - 1). Beyond 12 deviations nothing counts."""
    import numpy as np

    x, w = np.polynomial.legendre.leggauss(NODES)
    nodes = F.array(*(F.struct(F.lit(float(a)).alias("x"), F.lit(float(b)).alias("w")) for a, b in zip((x + 1) / 2, w / 2)))

    def integral(a: Column, b: Column) -> Column:
        return (b - a) * F.aggregate(nodes, F.lit(0.0), lambda s, n: s + n["w"] * F.pow(F.greatest(F.lit(0.0), F.cos(a + (b - a) * n["x"])), df - 1))

    most = F.least(F.lit(math.pi / 2), F.lit(12.0) / F.sqrt(df))
    return integral(F.least(F.atan(t / F.sqrt(df)), most), most) / integral(F.lit(0.0), most)


def welch(c: Column, vc: Column, nc: Column, t: Column, vt: Column, nt: Column) -> Column:
    """Two-sided p value of Welch's t test from means, sample variances and counts. Without any variance: 0 for different means, NaN for equal ones."""
    a, b = vc / nc, vt / nt
    df = (a + b) * (a + b) / (a * a / (nc - 1) + b * b / (nt - 1))
    return F.when(a + b > 0, t_tail(F.abs(t - c) / F.sqrt(a + b), df)).when(t != c, 0.0).otherwise(F.lit(float("nan")))


def canaries(events: DataFrame, key: str, cfg: Canary = Canary(), pattern: str = "pattern") -> DataFrame:
    """Per pattern with enough samples in both arms: rates, p value of Welch's t test (or a step at 5 points), recommendation. One aggregate with means, variances and counts."""
    d = events.withColumn("_arm", arm(F.col(key), cfg.fraction)).withColumn("_v", F.col("success").cast("double"))
    def of(name: str, f) -> Column:
        return f(F.when(F.col("_arm") == name, F.col("_v")))

    out = d.groupBy(pattern).agg(of("control", F.avg).alias("c"), of("treatment", F.avg).alias("t"), of("control", F.count).alias("n_control"), of("treatment", F.count).alias("n_treatment"), of("control", F.var_samp).alias("vc"), of("treatment", F.var_samp).alias("vt"))
    return judged_means(out, cfg, pattern)


def arm_totals(events: DataFrame, key: str, cfg: Canary = Canary(), pattern: str = "pattern") -> DataFrame:
    """Per pattern: what metrics and canaries need, as sums that add up over batches."""
    d = events.withColumn("_arm", arm(F.col(key), cfg.fraction))
    mine = [f(F.when(F.col("_arm") == a, c)).cast("long").alias(f"{n}_{a}") for a in ("control", "treatment") for n, f, c in (("n", F.count, F.lit(1)), ("s", F.count_if, F.col("success")))]
    return d.groupBy(pattern).agg(F.count("*").alias("total_uses"), F.count_if("success").alias("success_count"), F.sum("cost_tokens").cast("double").alias("total_cost"), F.sum("latency_ms").cast("double").alias("total_latency"), *mine)


def judged_arms(totals: DataFrame, cfg: Canary = Canary(), pattern: str = "pattern") -> DataFrame:
    """canaries() from arm_totals(): a mean's variance follows from its counts."""
    mean = lambda a: F.col(f"s_{a}") / F.when(F.col(f"n_{a}") > 0, F.col(f"n_{a}"))
    spread = lambda a: mean(a) * (1 - mean(a)) * F.col(f"n_{a}") / F.when(F.col(f"n_{a}") > 1, F.col(f"n_{a}") - 1)
    return judged_means(totals.select(pattern, mean("control").alias("c"), mean("treatment").alias("t"), "n_control", "n_treatment", spread("control").alias("vc"), spread("treatment").alias("vt")), cfg, pattern)


def judged_means(means: DataFrame, cfg: Canary = Canary(), pattern: str = "pattern") -> DataFrame:
    """(pattern, control_sr, treatment_sr, p_value, significant, recommendation, counts) from means c and t, variances and counts."""
    out = means.where((F.col("n_control") >= cfg.min_samples) & (F.col("n_treatment") >= cfg.min_samples))
    step = F.when(F.abs(F.col("t") - F.col("c")) > 0.05, 0.04).otherwise(0.5)
    p = welch(*map(F.col, ("c", "vc", "n_control", "t", "vt", "n_treatment"))) if cfg.test == "welch" else step
    out = out.withColumn("p_value", F.explode(F.array(p))).withColumn("significant", F.col("p_value") < cfg.alpha)  # filters stay above, so the sums are made once
    out = out.withColumn("recommendation", F.when(F.col("significant") & (F.col("t") > F.col("c")), "promote").when(F.col("significant"), "rollback").otherwise("inconclusive"))
    return out.select(pattern, F.round("c", 4).alias("control_sr"), F.round("t", 4).alias("treatment_sr"), F.round("p_value", 4).alias("p_value"), "significant", "recommendation", "n_control", "n_treatment")


def proposals(found: DataFrame, tests: DataFrame, protected: Sequence[str] = (), most: int = 10, pattern: str = "pattern") -> DataFrame:
    """(source, pattern, action, rank): changes that metrics and then canaries speak for, at most `most`; protected patterns' metrics don't count."""
    free = found.where(~F.col(pattern).isin(*protected)) if protected else found
    a = free.where(F.col("recommend").isin("PROMOTE", "DEMOTE", "REMOVE")).select(F.lit(0).alias("o"), F.lit("metrics").alias("source"), pattern, F.col("recommend").alias("action"))
    b = tests.where(F.col("recommendation") != "inconclusive").select(F.lit(1).alias("o"), F.lit("canary").alias("source"), pattern, F.when(F.col("recommendation") == "promote", "PROMOTE").otherwise("ROLLBACK").alias("action"))
    best = a.union(b).orderBy("o", pattern).limit(most)
    return best.withColumn("rank", F.row_number().over(Window.partitionBy().orderBy("o", pattern))).drop("o")


def apply_proposals(found: DataFrame, autonomy: str, breaker_state: str | Column = "CLOSED") -> DataFrame:
    """found with `status`: manual logs, human_approval queues, full applies unless the breaker is open. breaker_state: one for all, or a Column that says each row's."""
    free = F.when((F.lit(breaker_state) if isinstance(breaker_state, str) else breaker_state) == "OPEN", "blocked").otherwise("applied")
    fixed = {"manual": "logged", "human_approval": "pending"}.get(autonomy)
    return found.withColumn("status", F.lit(fixed) if fixed else free)


def approve(proposed: DataFrame, pattern, column: str = "pattern") -> DataFrame:
    """proposed with the pattern's first pending proposal approved. pattern: a value, or a Column that says which rows' pattern is meant."""
    mine = (F.col(column) == pattern) & (F.col("status") == "pending")
    first = F.row_number().over(Window.partitionBy(column, "status").orderBy("rank")) == 1
    return proposed.withColumn("status", F.when(mine & first, "approved").otherwise(F.col("status")))


def pending(proposed: DataFrame) -> DataFrame:
    return proposed.where("status = 'pending'")


def history(proposed: DataFrame) -> DataFrame:
    """Proposals that were applied, approved, logged or blocked, in order."""
    return proposed.where("status <> 'pending'").orderBy("rank")


# ---- training runs


def loss_summary(points: DataFrame, step: str = "step", loss: str = "loss") -> DataFrame:
    """One row: first, last and best loss and the best one's first step."""
    at = F.struct(loss, step)
    return points.where(F.col(loss).isNotNull()).agg(F.min_by(loss, step).alias("first_loss"), F.max_by(loss, step).alias("last_loss"), F.min(loss).alias("best_loss"), F.min_by(step, at).alias("best_step"))


def run_quality(final_loss: Column, eval_loss: Column, first_loss: Column) -> Column:
    """A run's label by its evaluation loss, or else its training loss, and by how many percent the training loss fell; empty without a loss."""
    main = F.coalesce(eval_loss, final_loss)
    fell = F.when(first_loss > 0, (first_loss - final_loss) / first_loss * 100)
    by = lambda most, least: (main < most) & F.coalesce(fell > least, F.lit(True))
    return F.when(final_loss.isNull(), "").when(by(1.2, 40), "Excellent").when(by(1.8, 25), "Good").when(by(2.2, 10), "Okay").when(main < 2.8, "Fair").otherwise("Poor")


def loss_runs(points: DataFrame, run: str = "run", step: str = "step", loss: str = "loss", eval_loss: str = "eval_loss") -> DataFrame:
    """Each run's first, last and best loss, last evaluation loss and quality."""
    had = lambda c, at: F.when(F.col(c).isNotNull(), at)
    ends = lambda c, f, name: f(c, had(c, F.col(step))).alias(name)
    out = points.groupBy(run).agg(ends(loss, F.min_by, "first_loss"), ends(loss, F.max_by, "last_loss"), F.min(loss).alias("best_loss"), ends(eval_loss, F.max_by, "last_eval_loss"))
    return out.withColumn("quality", run_quality(F.col("last_loss"), F.col("last_eval_loss"), F.col("first_loss")))


STATE = "struct<state:string,fails:int,oks:int,opened:double,opens:int>"


def breaker_step(s: Column, ok: Column, at: Column, cfg: Breaker = Breaker()) -> Column:
    """The breaker after one event at `at` (seconds). Open turns half open when an event comes after the cool-down; then the event counts."""
    cooled = (s["state"] == "OPEN") & (at - s["opened"] >= cfg.cooldown)
    state, oks = F.when(cooled, "HALF_OPEN").otherwise(s["state"]), F.when(cooled, 0).otherwise(s["oks"])
    good = F.when(state == "OPEN", oks).otherwise(oks + 1)
    closes = ok & (state == "HALF_OPEN") & (good >= cfg.successes)
    fails = F.when(ok, 0).otherwise(s["fails"] + 1)
    opens = ~ok & (state != "OPEN") & (fails >= cfg.failures)
    return F.struct(
        F.when(closes, "CLOSED").when(opens, "OPEN").otherwise(state).alias("state"), fails.cast("int").alias("fails"), F.when(ok, good).otherwise(0).cast("int").alias("oks"),
        F.when(opens, at).otherwise(s["opened"]).cast("double").alias("opened"), (s["opens"] + opens.cast("int")).cast("int").alias("opens"),
    )


def breaker_runs(events: DataFrame, key: str = "pattern", at: str = "at", tie: str = "seq", cfg: Breaker = Breaker()) -> DataFrame:
    """The breaker of each key after its last event: one ordered fold a key."""
    out = breaker_from(events, None, key, at, tie, cfg)
    return out.select(key, "state", F.col("fails").alias("consec_failures"), F.col("oks").alias("consec_successes"), "opens")


def breaker_from(events: DataFrame, states: DataFrame | None, key: str = "pattern", at: str = "at", tie: str = "seq", cfg: Breaker = Breaker()) -> DataFrame:
    """(key, state, fails, oks, opened, opens) of each key that has events, after them, from where `states` (the same columns) left it."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(at).alias("at"), F.col(tie).alias("tie"), F.col("success").alias("ok"))))
    fresh = F.struct(F.lit("CLOSED").alias("state"), F.lit(0).alias("fails"), F.lit(0).alias("oks"), F.lit(0.0).alias("opened"), F.lit(0).alias("opens")).cast(STATE)
    out = events.groupBy(key).agg(rows.alias("_e"))
    if states is None:
        start = fresh
    else:
        out = out.join(states.select(key, F.struct("state", "fails", "oks", "opened", "opens").cast(STATE).alias("_was")), key, "left")
        start = F.coalesce("_was", fresh)
    return out.withColumn("s", F.aggregate("_e", start, lambda s, x: breaker_step(s, x["ok"], x["at"], cfg).cast(STATE))).select(key, "s.*")


def cooled_down(states: DataFrame, now: Column, cfg: Breaker = Breaker()) -> DataFrame:
    """breaker_from()'s rows as they are at `now` (seconds): open ones whose cool-down has ended are half open, without an event."""
    over = (F.col("state") == "OPEN") & (now - F.col("opened") >= cfg.cooldown)
    return states.withColumn("oks", F.when(over, 0).otherwise(F.col("oks"))).withColumn("state", F.when(over, "HALF_OPEN").otherwise(F.col("state")))
