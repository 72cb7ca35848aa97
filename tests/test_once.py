"""Expressions and tables that several results need are made once."""

from pyspark.sql import functions as F

from loomline.operators import qa
from loomline.plans import prepare


def test_a_section_is_parsed_once_for_its_facts(spark):
    made = str(qa.section_facts(F.col("heading_"), F.col("text_"), F.lit("manual"), p=F.col("parsed_")))
    assert made.count("parsed_") <= 8 and made.count("text_") <= 4


def test_a_report_makes_each_question_and_chunk_once(spark):
    body = "\n".join(f"A line of some words that say number {i} of this page." for i in range(12))
    pages = spark.createDataFrame([("a", i, f"Heading Words\n{body} {i}") for i in range(5)], "doc string, page int, text string")
    plan = prepare.report(pages)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") <= 2 and plan.count("Window [row_number()") <= 1


def test_processors_take_and_give_rows():
    """A data frame a key costs more than the rows of most keys."""
    from pyspark.sql import Row

    from loomline.operators import learning
    from loomline.streaming import stateful

    class Kept:
        def __init__(self):
            self.v = None

        def getValueState(self, *_):
            return self

        def get(self):
            return self.v

        def update(self, v):
            self.v = v

        exists = lambda self: self.v is not None

    log = stateful.FollowedLog("run", None)
    log.handle = log.now = log.timer = Kept()
    lines = [Row(run=1, seq=3, said='{"epoch":2,"initial_loss":0.5,"loss":0.5}'), Row(run=1, seq=2, said='{"phase":"dataset","initial_loss":1.0}')]
    got = list(log.handleInputRows((1,), iter(lines), None))
    assert [(r.run, r.seq, r.idle, r.phase, r.epoch, r.initial_loss, r.loss) for r in got] == [(1, 2, False, "dataset", None, 1.0, None), (1, 3, False, "dataset", 2, 1.0, 0.5)]

    breaker = stateful.BreakerTimers("pattern", learning.Breaker(failures=9))
    breaker.handle = breaker.now = Kept()
    (row,) = breaker.handleInputRows((7,), iter([Row(pattern=7, at=5.0, seq=2, success=False), Row(pattern=7, at=4.0, seq=1, success=True)]), None)
    assert (row.pattern, row.state, row.consec_failures, row.moved_by, row.moved_at) == (7, "CLOSED", 1, "event", 5.0)


def test_keyword_rows_are_dealt_by_library_row_over_bounded_tasks(spark, monkeypatch):
    from loomline.operators import retrieval

    monkeypatch.setattr(retrieval, "PART_CHARS", 50, raising=False)
    library = spark.createDataFrame([(i, "n", "t", f"reindex table_scan {i}") for i in range(20)], "seq long, name string, title string, body string")
    asked = spark.createDataFrame([(0, "reindex table_scan reindex")], "query_id int, question string")
    found = retrieval.keyword_search(asked, library)
    assert "REPARTITION_BY_NUM" in found._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in found.orderBy("rank").collect()] == [(0, 0, 3, 1), (0, 1, 3, 2)]
