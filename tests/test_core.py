import json
import re
import time

import pytest
from pyspark.sql import functions as F

from loomline.functions import text as tx
from loomline.functions.config import Domain, load_config, load_domain, merged
from loomline.operators import chunking, curation, learning, memory, pages, patterns, qa, retrieval
from loomline.plans import prepare
from loomline.sources import readers, sinks
from loomline.streaming import jobs

PROSE = "Hypertension Guide\n\nHigh blood pressure is common. It needs treatment, and the patient needs monitoring.\n\n" + "\n\n".join(f"Paragraph {i} " + "text " * (7 * i % 40) for i in range(25))


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)) if values else spark.range(1)
    return df.select(column.alias("x")).first().x


def plain_chunks(text, size, overlap, structured=None, sep="\n\n", joint=2, parts=None):
    """The packing rule row by row, to hold the fold against."""
    parts = [p.strip() for p in re.split(sep + "+", text) if p.strip()] if parts is None else parts
    out, now, used = [], [], 0
    for p in parts:
        if used + len(p) + joint > size and now:
            out.append(now)
            keep = []
            if overlap:
                for q in reversed(now):
                    if (structured and structured(q)) or sum(map(len, keep)) + len(q) > overlap:
                        break
                    keep.insert(0, q)
                now, used = [*keep, p], sum(map(len, keep)) + len(p) + joint * len(keep)
            else:
                now, used = [p], len(p) + joint
        else:
            now, used = [*now, p], used + len(p) + joint
    return [*out, now] if now else out


@pytest.mark.parametrize("size,overlap", [(100, 0), (300, 60), (300, 150), (500, 500), (50, 10)])
def test_chunks(spark, size, overlap):
    want = ["\n\n".join(c) for c in plain_chunks(PROSE, size, overlap)]
    assert one(spark, chunking.chunks("t", size, overlap), t=PROSE) == want
    hits = lambda p: len(re.findall(r"\b(paragraph|pressure|patient)\b", p, re.I)) >= 2
    domain = Domain(keywords=("paragraph", "pressure", "patient"))
    want = ["\n\n".join(c) for c in plain_chunks(PROSE, size, overlap, hits)]
    assert one(spark, chunking.structured_chunks("t", size, overlap, domain), t=PROSE) == want


def test_chunk_edges(spark):
    assert one(spark, chunking.chunks("t", 10), t=" \n ") == []
    assert one(spark, chunking.chunks("t", 100), t=" short ") == ["short"]
    assert one(spark, chunking.chunks("t", 10), t="x" * 50) == ["x" * 50]
    text = "One sentence is here. Another sentence follows it! Is a third one there? Tiny. The fourth sentence ends it."
    got = one(spark, chunking.sentence_chunks("t", 60, 30), t=text)
    assert got == ["One sentence is here. Another sentence follows it!", "Another sentence follows it! Is a third one there?", "Is a third one there? The fourth sentence ends it."]


def test_text_functions(spark):
    assert one(spark, tx.strip("t"), t="  a b\t\n") == "a b"
    assert one(spark, tx.words("t"), t=" a b  c ") == ["a", "b", "c"]
    assert one(spark, tx.token_estimate("t"), t="a b c") == 3
    assert one(spark, tx.token_estimate("t"), t="") == 0
    assert one(spark, tx.fingerprint("t"), t=" A  b\n") == one(spark, tx.fingerprint("t"), t="a B")
    assert one(spark, tx.render(F.lit("⟦a⟧ and ⟦b⟧"), F.create_map(F.lit("a"), F.lit("{b}"), F.lit("b"), F.lit("2")))) == "{b} and 2"
    assert one(spark, tx.bullets(F.array(F.lit("x"), F.lit(" y ")))) == "\n- x\n- y"


def test_config(tmp_path, monkeypatch):
    f = tmp_path / "c.yaml"
    f.write_text("data_prep:\n  chunk_size: 99\n")
    assert load_config(f)["data_prep"] == {"chunk_size": 99, "chunk_overlap": 150, "val_ratio": 0.15, "seed": 42}
    monkeypatch.setenv("LOOMLINE_CONFIG", str(f))
    assert load_config()["data_prep"]["chunk_size"] == 99
    assert merged({"a": 1, "b": 2}, a=None, b=3) == {"a": 1, "b": 3}
    f.write_text("extraction:\n  content_keywords: [ledger, balance]\n  min_keyword_matches: 1\n  function_pattern: 'call (\\w+)'\n  non_function_suffixes: [_table]\n")
    d = load_domain(f)
    assert d.keywords == ("ledger", "balance") and d.min_matches == 1


def test_named_patterns(spark):
    d = Domain(function_pattern=r"call (\w+)", non_function_suffixes=("_table",))
    assert one(spark, d.named(F.col("t")), t="call x_table then call ab then call Moving") == "Moving"
    assert one(spark, Domain().named(F.col("t")), t="call it") is None
    assert one(spark, Domain().structured(F.col("t")), t="The Patient needs DOSAGE notes") is True
    assert one(spark, Domain(keywords=()).structured(F.col("t")), t="patient dosage") is False


BODY = "This line of a page is long enough to count as real text.\n" * 5


@pytest.mark.parametrize("test,text,want", [
    (pages.is_toc, "Contents\nA one of them\nB two of them\nC three of them all here", True), (pages.is_toc, "Alpha......... 1\nBeta.......... 2\nGamma......... 3\nDelta here at the end of it all", True), (pages.is_toc, BODY, False),
    (pages.is_boilerplate, "short", True), (pages.is_boilerplate, BODY + "Copyright 2020, all rights reserved", True), (pages.is_boilerplate, "See https://example.com/x for more. " + "y" * 90, True), (pages.is_boilerplate, BODY, False),
    (pages.is_index, "A\nApples 1, 2\nB\nBeets 3\nC\nCarrots in the garden are orange 4, 5", True), (pages.is_index, BODY, False), (pages.is_substantive, BODY, True), (pages.is_substantive, "x" * 300, False), (pages.keep_page, BODY, True),
    (pages.is_heading, "MOVING AVERAGE", True), (pages.is_heading, "Ordered Analytical Functions", True), (pages.is_heading, "SUMMARY", False), (pages.is_heading, "This is a sentence.", False), (pages.is_heading, "Column Data Type", False), (pages.is_heading, "1 Intro Chapter", False),
    (pages.valid_text, BODY, True), (pages.valid_text, "12345 " * 40, False),
])
def test_page_tests(spark, test, text, want):
    assert one(spark, test("t"), t=text) is want


def manual(spark):
    rows = []
    for p in range(1, 9):
        head = {1: "FIRST TOPIC", 4: "Second Topic Name"}.get(p)
        rows.append(("/m/My Manual.pdf", p, f"Acme Handbook {p}\n" + (head + "\n" if head else "") + f"Unique {'abcdefgh'[p - 1]}.\n" + BODY + f"{p}\nAll of Acme {p}"))
    rows.append(("/m/My Manual.pdf", 9, "tiny"))
    return spark.createDataFrame(rows, "doc string, page int, text string")


def test_manuals(spark):
    got = pages.extract_manuals(manual(spark))
    assert {(r.side, r.line) for r in got["running"].collect()} >= {("header", "acme handbook"), ("footer", "all of acme")}
    kept = {r.page: r.text for r in got["pages"].collect()}
    assert sorted(kept) == list(range(1, 9)) and "Acme" not in kept[2] and "\n2\n" not in kept[2]
    s = [tuple(r) for r in got["sections"].select("section", "heading", "page_start", "page_end").orderBy("section").collect()]
    assert s == [(0, "FIRST TOPIC", 1, 3), (1, "Second Topic Name", 4, 8)]
    d = got["documents"].first()
    assert (d.num_pages_total, d.num_pages_kept, d.num_sections) == (9, 8, 2)
    assert one(spark, pages.manual_label("t"), t="/m/My Manual.v2.pdf") == "my_manual_v2"
    made = prepare.prepare_manuals(manual(spark))
    assert made["pairs"].where("split = 'val'").count() >= 1 and made["pairs"].select("label").distinct().first().label == "my_manual"
    report = {(r.stage, r.name): r for r in prepare.report(manual(spark)).collect()}
    whole = got["documents"].first().full_text
    assert (report["pages", "all"].n, report["pages", "kept"].n, report["sections", "all"].n) == (9, 8, 2) and report["documents", "all"].max_chars == len(whole)
    typed = qa.section_qa(got["sections"], ["doc", "section"]).collect()
    assert report["questions", "all"].n == len(typed) and report["questions", "different"].n == len({(r.question.lower(), r.answer[:400]) for r in typed})
    kinds = {name: r.n for (stage, name), r in report.items() if stage == "question kinds"}
    assert sum(kinds.values()) == report["questions", "different"].n and kinds["What is / Describe / Purpose"] > 0
    assert report["chunks", "plain"].n == len(plain_chunks(whole, 800, 150)) and report["chunks", "aware"].n >= 1


def test_example_parts(spark):
    text = "before any label\n\nInput:\nfirst\n\nmore input\n\nProtocol\nstep one\n\nOutput:\ndone\n\nInput\nlast"
    p = one(spark, pages.example_parts("t"), t=text)
    assert (p.input, p.structured, p.output) == ("last", "step one", "done")
    p = one(spark, pages.section_parts("t"), t="Intro here.\n\nSyntax:\nf(x)\n\nResult\nx is 1\n\nNotes\n\ncareful\n\nand slow")
    assert (p.description, p.syntax, p.examples, p.notes, p.arguments) == (["Intro here."], ["f(x)"], ["x is 1"], ["careful", "and slow"], [])
    assert one(spark, pages.captions("t"), t="x Figure 1-2: A plot\nFig. 3 - B") == ["Figure 1-2: A plot", "Fig. 3 - B"]


def test_chunk_questions(spark):
    ask = lambda t: [tuple(p) for p in one(spark, qa.chunk_pairs(F.col("t"), "dir/manual.txt"), t=t)]
    assert ask("Dosage Rules\n\n" + "It is a long enough content here.") == [("What is Dosage Rules?", "It is a long enough content here.")]
    t = "The patient has a diagnosis of something."
    assert ask(t) == [("Show me a structured example from manual.", t)]
    t = "Input:\na case\n\nProtocol:\ndo this\n\nOutput:\nfine"
    assert ask(t) == [("Show me a complete structured example from manual.", t)]
    t = "Nothing special is said in this text, but it is long enough to keep."
    assert ask(t) == [("What does the documentation say about the following from manual?", t)]
    assert ask("short") == [] and ask("  ") == []


def test_section_questions(spark):
    text = "A window function. It ranks rows by time within a group.\n\nSyntax:\nrank(x)\n\nArguments\n\nx: a column\n\nNotes:\nslow on big groups\n\nExamples:\nrank(sales) over the months gives places"
    df = spark.createDataFrame([("RANK", text), ("Prose", "It is said that this must be so because of what was said, such as here and there.")], "heading string, text string")
    got = qa.section_qa(df, ["heading"]).collect()
    by = lambda h: [r for r in sorted(got, key=lambda r: (r.block_no, r.item, r.sub, r.pos)) if r.heading == h]
    rank = by("RANK")
    assert len(rank) == 4 + 8 + 8 + 10 + 2 + 3
    assert ("Define RANK in one sentence.", "A window function.") in [(r.question, r.answer) for r in rank]
    assert rank[0].question == "What is RANK?" and "What is the syntax for RANK?" in [r.question for r in rank]
    # prose is description: it asks what and does, and one sentence
    assert [r.question for r in by("Prose")][:2] == ["What is Prose?", "What does Prose do?"]
    turns = one(spark, qa.section_conversation(F.lit("RANK"), pages.section_parts("t")), t=text)
    assert [t.role for t in turns] == ["user", "assistant"] * 3 and turns[1].content.startswith("A window")


PATTERN = {
    "name": "aspirin_dose", "title": "Aspirin Dose", "description": "How much aspirin to give a patient in common cases. It depends.", "category": "dosing", "pattern_alias": "ASA", "use_cases": ["pain relief at home", "fever"],
    "parameters": [{"name": "weight", "type": "float", "required": True, "description": "body weight", "example": 70}, {"name": "age", "required": False, "description": "years", "default": 40}],
    "templates": {"first_line": {"description": "start a course", "content": "give 100mg", "required_parameters": ["weight"]}, "bad": "text"},
    "examples": [{"name": "adult", "description": "dose an adult", "expected_result": "100mg", "parameters": {"pattern": "A+", "n": 1}}, "plain example"],
    "common_errors": [{"error": "too much", "cause": "typing", "solution": "check twice"}], "best_practices": ["start low and go slow, always", "short"],
    "pattern_syntax": {"operators": [{"symbol": "+", "meaning": "one or more", "example": "A+"}, {"symbol": "*", "meaning": "any"}]}, "guardrails": ["not for children"], "related_patterns": ["ibuprofen"],
}


@pytest.fixture
def library(tmp_path):
    import yaml

    (tmp_path / "sub").mkdir()
    (tmp_path / "aspirin.yaml").write_text(yaml.safe_dump(PATTERN, sort_keys=False))
    (tmp_path / "_hidden.yaml").write_text("name: hidden")
    (tmp_path / "broken.yaml").write_text("name: [")
    (tmp_path / "nameless.yaml").write_text("title: x")
    (tmp_path / "sub" / "deep.yaml").write_text("name: deep\ndescription: A deep one.")
    return str(tmp_path)


def test_patterns(spark, library):
    assert {r.name for r in readers.read_patterns(spark, library).collect()} == {"aspirin_dose", "deep"}
    lib = readers.read_library(spark, library)
    assert [r.name for r in lib.collect()] == ["aspirin_dose"]
    got = sorted(patterns.pattern_qa(lib, ["name"]).collect(), key=lambda r: (r.block_no, r.item, r.sub, r.pos))
    pairs = [(r.question, r.answer) for r in got]
    asked = dict(pairs)
    # description 7+4+4+1, uses 9+1, each use (one longer than 10) 2, parameters 5+1+2, per parameter 10+8-1.., pairs 3, templates 7, use x template 4
    assert asked["What is ASA?"] == PATTERN["description"] and asked["What category does Aspirin Dose belong to?"].startswith("Aspirin Dose is a dosing function. How much")
    assert asked["What are the parameters for Aspirin Dose?"] == "**weight** (type: float) — body weight Example: 70\n\n**age** (optional) — years Default: 40"
    assert asked["Is 'age' required or optional in Aspirin Dose?"] == "'age' is optional. years"
    assert asked["Can 'weight' and 'age' be used together in Aspirin Dose?"] == "'weight': body weight (e.g. 70)\n\n'age': years"
    assert asked["Show me how to start a course."] == "give 100mg\n\nRequired parameters: weight"
    assert asked["Adapt the first line template to solve: fever"] == "Base template (first line):\n\ngive 100mg\n\nAdapt it for: fever"
    assert asked["Show me an example of ASA."] == "100mg" and asked["What pattern would I use for 'adult' with Aspirin Dose?"] == "Pattern: A+\n\n100mg"
    assert asked["What causes 'too much' when using Aspirin Dose?"] == "Cause: typing\n\nSolution: check twice"
    assert asked["What are the best practices for Aspirin Dose?"] == "\n- start low and go slow, always\n- short"
    assert asked["What is the difference between '+' and '*' operators in Aspirin Dose?"] == "'+' — one or more Example: A+\n\n'*' — any"
    assert asked["Can ibuprofen replace Aspirin Dose in all use cases?"].startswith("No. Aspirin Dose")
    assert pairs[0] == ("What is Aspirin Dose?", PATTERN["description"]) and pairs[-1][0].startswith("Can ibuprofen")
    talks = lib.select(patterns.pattern_conversations().alias("c")).first().c
    assert [len(c) for c in talks] == [10, 6, 6, 6] and talks[0][1].content == PATTERN["description"]
    form = patterns.pattern_to_form(lib).first()
    assert form.use_cases_text == "pain relief at home\nfever" and form.common_errors_text == "too much: check twice"


def test_capture_form(spark):
    form = {
        "title": "My Rule!", "description": "Does things.", "use_cases_text": "- first use\n* second\nno", "parameters_text": "dose level: how much (10 mg)\nbad line", "worked_example": "do it", "example_summary": "", "example_output": "done",
        "common_errors_text": "Crash: restart it\nno separator\nSlow — wait more", "best_practices": "be kind", "category": "",
    }
    df = spark.createDataFrame([tuple(form.values())], ", ".join(f"{k} string" for k in form))
    p = patterns.form_to_pattern(df)
    r = p.first()
    assert (r.name, r.category, r.use_cases) == ("my_rule", "general", ["first use", "second"])
    assert [(x.name, x.description, x.example) for x in r.parameters] == [("dose_level", "how much", "10 mg")]
    assert [(e.error, e.solution) for e in r.common_errors] == [("Crash", "restart it"), ("Slow", "wait more")]
    assert r.examples[0].expected_result == "done" and r.templates[0].description == "Worked example"
    assert patterns.pattern_qa(p, ["name"]).count() > 30


VOCABULARY = """
metadata: {domain: financial}
topics:
  - {name: Ledger, description: A book of accounts., one_sentence: A book., category: balance_concept, syntax: {form: L(x)}, related: [Journal, ''], examples: [{description: ' one '}, {description: two}], common_errors: [{error: e, cause: c, solution: s}]}
  - {title: nameless}
more:
  sub:
    - {name: Journal, performance_tips: [a, b]}
"""


def test_vocabulary(spark, tmp_path):
    (tmp_path / "x_vocabulary.yaml").write_text(VOCABULARY)
    (tmp_path / "other.yaml").write_text(VOCABULARY)
    e = readers.read_vocabularies(spark, str(tmp_path))
    rows = {r.name: r for r in e.collect()}
    assert set(rows) == {"Ledger", "Journal"} and rows["Ledger"].errors == "error: e; cause: c; solution: s" and rows["Ledger"].first_example == "one" and rows["Journal"].performance_tips == "a\nb"
    got = patterns.vocabulary_qa(e)
    n = {r.source: r["count"] for r in got.groupBy("source").count().collect()}
    # Ledger: description 7, one sentence 4, category 4, use case 9, syntax 8, argument 8, notes 10, example 10, errors 17, account 5, overview 9, comparison 12
    assert n == {"Ledger": 7 + 4 + 4 + 9 + 8 + 8 + 10 + 10 + 17 + 5 + 9 + 12, "Journal": 16}
    first = got.where("question = 'How does Ledger differ from Journal?'").first()
    assert first.answer == "Ledger: A book of accounts.\n\nCompare with Journal for differences in behavior and use cases."


def test_judge(spark):
    long = "Use the following steps: first check the dose. " * 5
    rows = [("What dose is right?", long), ("q", ""), ("Tell me", "I cannot say, it is unclear"), ("x", "rm -rf everything"), ("a b", "```\ncode\n```\n1. one\n2. two")]
    got = curation.judged(spark.createDataFrame(rows, "question string, answer string"), keywords=["dose", "absent"]).collect()
    a, b, c, d, e = got
    assert a.safety == 1.0 and a.domain == 0.5 and a.usability > 0.5 and a.cost == 0.5 - (40 / 4 - 8) / 16
    assert b.quality == 0.0 and "empty answer" in b.flags
    assert c.safety == 0.6 and {"refusal detected", "refusal / uncertainty"} <= set(c.flags)
    assert d.safety == 0.0 and "harmful content detected" in d.flags
    assert e.performance == 1.0
    assert a.confidence == round(sum(a[k] * w for k, w in curation.WEIGHTS.items()), 4) and (a.level == "HIGH") == (a.confidence >= 0.8)


@pytest.mark.parametrize("reply,want", [
    ('{"quality": 1, "safety": 2, "cost": -1, "domain": 0.5, "performance": 0.5, "usability": 0.5}', (1.0, 1.0, 0.0, 0.5, 0.5, 0.5)),
    ('Sure:\n```json\n{"quality": 0.1, "safety": 0.2, "cost": 0.3, "domain": 0.4, "performance": 0.5, "usability": 0.6}\n``` done', (0.1, 0.2, 0.3, 0.4, 0.5, 0.6)), ('{"quality": 1}', None), ("none", None),
])
def test_model_scores(spark, reply, want):
    got = one(spark, curation.parse_model_scores(F.col("t")), t=reply)
    assert (tuple(got) if got else None) == want


def test_strategies(spark):
    s = {k: F.lit(v) for k, v in (("quality", 0.9), ("safety", 0.2), ("cost", 0.7))}
    want = {"all_must_pass": 0.2, "min_score": 0.2, "max_score": 0.9, "majority_pass": 0.6667, "any_pass": 1.0, "weighted_average": round((0.27 + 0.05 + 0.105) / 0.7, 4)}
    for k, v in want.items():
        assert one(spark, curation.combine(s, k)) == v


def test_dedup_split_rank(spark):
    df = spark.createDataFrame([("o", i, q, "a") for i, q in enumerate(["x", "X ", "y", "x"])] + [("p", 0, "x", "a")], "origin string, seq int, question string, answer string")
    assert sorted((r.origin, r.seq) for r in curation.dedup_first(df).collect()) == [("o", 0), ("o", 2), ("p", 0)]
    for n, want in ((1, 1), (10, 1), (100, 15)):
        s = curation.split_train_val(spark.range(n), ["id"])
        assert s.where("split = 'val'").count() == want and s.count() == n
        assert s.orderBy("id").collect() == curation.split_train_val(spark.range(n).repartition(3), ["id"]).orderBy("id").collect()
    scored = spark.createDataFrame([(0, 0.5), (1, 0.9), (2, 0.5), (3, 0.1)], "seq int, confidence double")
    assert [r.seq for r in curation.top_demonstrations(scored, 2, 0.2).orderBy("rank").collect()] == [1, 0]
    assert [(r.seq, r.is_teacher) for r in curation.distilled(scored, scored, 3, 0.2).orderBy("rank").collect()] == [(1, 1), (1, 0), (0, 1)]
    c = spark.createDataFrame([("", "i1", "a1")], "question string, instruction string, output string")
    q, a = curation.candidate_pair(c)
    assert c.select(q.alias("q"), a.alias("a")).first() == ("i1", "a1")


def test_curriculum(spark):
    rows = [("Avoid in pregnancy; contraindicated",), ("Monitor the error",), ("plain words",), ("the patient " * 60,), ("an Error",)]
    got = curation.curriculum(spark.createDataFrame(rows, "text string")).collect()
    assert [r.confidence for r in got] == [0.95, 0.82, 0.72, 0.57, 0.3] and got[0].match.error_code == "CLIN_CONTRA_001" and got[2].match is None
    assert [r.retry_action for r in got] == ["auto_retry", "auto_retry", "retry_with_monitoring", "retry_with_monitoring", "escalate_to_human"]
    names = one(spark, F.transform(curation.all_matches(F.col("t")), lambda m: m["name"]), t="monitor the adverse error")
    assert names == ["monitoring_required", "adverse_event", "generic_error"]


def test_retrieval(spark, library):
    lib = readers.read_patterns(spark, library).withColumn("seq", F.monotonically_increasing_id())
    body = retrieval.searchable(lib)
    q = spark.createDataFrame([(0, "What is the aspirin dose for fever?"), (1, "how is it"), (2, "deep")], "query_id int, question string")
    found = retrieval.keyword_search(q, lib.select("seq", "name", "title", body.alias("body")))
    got = {(r.query_id, r.score) for r in found.collect()}
    assert got == {(0, 11), (2, 10)}
    best = found.join(lib, "seq").withColumn("block", retrieval.context_block())
    context = {r.query_id: r.context for r in retrieval.contexts(best, "query_id").collect()}
    assert context[0].startswith(retrieval.KEYWORD_HEADER + "### Aspirin Dose\nHow much aspirin") and "Parameters: weight, age" in context[0] and "- too much: check twice" in context[0]
    docs = lib.select("seq", retrieval.pattern_text(lib).alias("text"))
    hits = retrieval.tfidf_search(q.withColumnRenamed("question", "query"), docs, "query_id", "query", "seq", "text").collect()
    assert {r.query_id for r in hits} == {0, 1, 2} and all(0.05 <= r.score <= 1 for r in hits)
    assert abs(one(spark, retrieval.dense_cosine(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(1.0), F.lit(1.0)))) - 0.7071) < 1e-4
    shown = best.withColumn("block", retrieval.context_block(F.lit(0.5))).where("query_id = 0").first().block
    assert shown.startswith("### Aspirin Dose  (similarity: 0.50)") and shown.endswith("Example:\n```\ngive 100mg\n```")


def records(spark):
    rows = [(0, "a", "2024-01-01", "s1", "What is the dose?", "Give it daily.", True, "m", True), (1, "b", "2024-01-02", "s1", "what is the dose", "Twice.", False, "m", False), (2, "a", "2024-01-03", "s2", "Other thing entirely", "Yes", None, "m", None)]
    return spark.createDataFrame(rows, "seq long, id string, timestamp string, session_id string, question string, answer string, approved boolean, model_name string, kb_context_used boolean")


def test_memory(spark, tmp_path):
    log = records(spark)
    assert memory.status_counts(log).first() == (3, 1, 1, 1)
    f = memory.frequent_questions(log).collect()
    assert [(r.key, r.n, r.answer) for r in f] == [("what is the dose", 2, "Twice.")]
    assert [r.seq for r in memory.interactions(log, session_id="s1", limit=0).collect()] == [1, 0]
    new = memory.set_approval(log, spark.createDataFrame([("a", False)], "id string, approved boolean")).orderBy("seq").collect()
    assert [r.approved for r in new] == [False, False, None]
    r = {x.seq: x for x in memory.relevance(log).collect()}
    assert [r[i].frequency for i in range(3)] == [0.0, 1.0, 0.0] and [r[i].effectiveness for i in range(3)] == [1.0, 0.0, 0.3] and [r[i].feedback for i in range(3)] == [1.0, 0.0, 0.3]
    scored = memory.relevance(log).withColumn("ingested_at", F.col("seq") * 100.0)
    moved = memory.promote(scored, scored.limit(0), F.lit(3700.0), memory.Promotion(threshold=0.3, archive=0.6))
    assert {x.seq: x.tier for x in moved.collect()} == {0: "mid_term", 1: "mid_term", 2: "short_term"}
    assert {x.seq: x.frequency for x in moved.collect()}[1] == 0.0  # scored anew against an empty mid-term pool
    stats = {x.tier: (x.capacity, x.n, x.avg_relevance) for x in memory.tier_stats(moved).collect()}
    r = {x.seq: x.relevance for x in moved.collect()}
    assert stats == {"short_term": (500, 1, round(r[2], 4)), "mid_term": (10_000, 2, round((r[0] + r[1]) / 2, 4)), "long_term": (None, 0, 0.0)}
    fresh = memory.new_records(log).first()
    assert fresh.approved is None and len(fresh.id) == 32 and fresh.timestamp.endswith("Z")
    assert sinks.export_approved(log, f"{tmp_path}/x") == 1 and sinks.export_approved(log.where("seq > 0"), f"{tmp_path}/none") == 0
    assert not (tmp_path / "none").exists()


def plain_fifo(turns, budget):
    live, used = [], 0
    for i, t in enumerate(turns):
        n = max(1, int(len(t.split()) * 1.3)) if t else 0
        while live and used + n > budget:
            used -= live.pop(0)[1]
        live.append((i, n))
        used += n
    return {i for i, _ in live}


def plain_summary(turns, l1, l2):
    """What is left of the turns that fall out of the live segment, turn by turn; None where none does."""
    size = lambda x: max(1, int(len(x.split()) * 1.3)) if x else 0
    split = lambda x: re.split(r"(?<=[.!?])\s+", x)
    live, out = plain_fifo(turns, l1), None
    for i, turn in enumerate(turns):
        if i in live:
            continue
        parts = split(turn.strip())
        weight = [3 * len(re.findall(r"(?i)\b(?:dose|patient)\b", x)) + len(re.findall(r"\b\d+\b", x)) + len(re.findall(r"\b[A-Z][a-z]{3,}\b", x)) for x in parts]
        kept, used, most = [], 0, max(l2 // 4, 50)
        for k in sorted(range(len(parts)), key=lambda k: (-weight[k], k)):
            if used < most and used + size(parts[k]) <= most:
                kept.append(k)
                used += size(parts[k])
        said = " ".join(parts[k] for k in sorted(kept))
        out = out or ""
        if not said:
            continue
        both = f"{out} {said}".strip()
        if size(both) > l2:
            newest, used = [], 0
            for x in reversed(split(both)):
                if used + size(x) > l2:
                    break
                newest.insert(0, x)
                used += size(x)
            both = " ".join(newest)
        out = both
    return out


def test_segmented(spark):
    import random

    r = random.Random(0)
    data = [(s, i, "user", " ".join("word" for _ in range(r.randint(0, 40)))) for s in range(20) for i in range(r.randint(1, 15))]
    df = spark.createDataFrame(data, "session int, turn int, role string, text string")
    live = {(x.session, x.turn) for x in memory.live_turns(df, budget=60).where("in_l1").collect()}
    for s in range(20):
        assert {t for a, t in live if a == s} == plain_fifo([x[3] for x in data if x[0] == s], 60)
    text = "Nothing here. The patient takes aspirin 100 mg daily. Short one. Dose and dosage matter to Paul."
    assert one(spark, memory.key_sentences(F.col("t"), 16), t=text) == "The patient takes aspirin 100 mg daily. Dose and dosage matter to Paul."
    talk = spark.createDataFrame([(1, i, "user", f"The patient has value {i}. " + "filler " * 20) for i in range(8)], "session int, turn int, role string, text string")
    got = {x.session: x.l2 for x in memory.summaries(talk, budgets=memory.Budgets(l1=60, l2=40)).collect()}
    assert got == {1: plain_summary([f"The patient has value {i}. " + "filler " * 20 for i in range(8)], 60, 40)}
    say = lambda: " ".join(r.choice(("Paul takes 100 mg.", "The dose is 5.", "nothing here!", "why so?", "a b c d e f g h i j.", "Monday")) for _ in range(r.randint(0, 9)))
    many = {k: [say() for _ in range(r.randint(1, 12))] for k in range(25)}
    df = spark.createDataFrame([(k, i, "user", x) for k, v in many.items() for i, x in enumerate(v)], "session int, turn int, role string, text string")
    for l1, l2 in ((30, 40), (10, 220), (25, 12)):
        got = {x.session: x.l2 for x in memory.summaries(df, budgets=memory.Budgets(l1=l1, l2=l2)).collect()}
        want = {k: plain_summary(v, l1, l2) for k, v in many.items()}
        assert got == {k: v for k, v in want.items() if v is not None}
    assert one(spark, memory.rom(F.col("t"), 10), t="a b c d e f g h i j k") == "a b c d e f g"
    assert one(spark, memory.rendered(F.lit("rom"), F.lit("k: v"), F.lit(""), F.lit("USER: hi"))) == "rom\n\n[Session context]\nk: v\n\nUSER: hi"


def test_learning(spark):
    rows = [("good", True)] * 30 + [("bad", False)] * 30 + [("new", True)] * 3
    e = spark.createDataFrame([(i, p, ok, 1.0, 2.0, float(i)) for i, (p, ok) in enumerate(rows)], "seq int, pattern string, success boolean, cost_tokens double, latency_ms double, at double")
    got = {r.pattern: r for r in learning.metrics(e).collect()}
    assert {k: v.recommend for k, v in got.items()} == {"good": "PROMOTE", "bad": "REMOVE", "new": "INVESTIGATE"} and got["good"].confidence == 0.8176
    p = learning.proposals(learning.metrics(e), learning.canaries(e, "seq", learning.Canary(0.4)), ["bad"])
    assert [(r.source, r.pattern, r.action) for r in p.collect()] == [("metrics", "good", "PROMOTE")]
    assert learning.apply_proposals(p, "human_approval").first().status == "pending" and learning.approve(learning.apply_proposals(p, "human_approval"), "good").first().status == "approved"
    assert learning.apply_proposals(p, "full", "OPEN").first().status == "blocked"


def test_breaker_fold_and_stream_agree(spark, tmp_path):
    import random

    r, cfg, rows = random.Random(1), learning.Breaker(3, 2, 50.0), []
    for k in range(8):
        at = 0.0
        for i in range(60):
            at += r.randint(1, 30)
            rows.append((f"p{k}", r.random() < 0.4, at, i))
    df = spark.createDataFrame(rows, "pattern string, success boolean, at double, seq int")
    want = {}
    for k in range(8):
        s = ("CLOSED", 0, 0, 0.0, 0)
        for _, ok, at, _ in [x for x in rows if x[0] == f"p{k}"]:
            s = jobs.next_state(s, ok, at, cfg)
        want[f"p{k}"] = (s[0], s[1], s[2], s[4])
    assert {x[0]: tuple(x)[1:] for x in learning.breaker_runs(df, cfg=cfg).collect()} == want
    df.where("seq < 30").coalesce(1).write.json(f"{tmp_path}/in")
    time.sleep(1.5)  # the stream takes files by their time
    df.where("seq >= 30").coalesce(1).write.mode("append").json(f"{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).option("latestFirst", False).json(f"{tmp_path}/in")
    states, batches = {}, []

    def keep(rows, number):
        batches.append(number)
        states.update({x.pattern: tuple(x)[1:] for x in rows.collect()})

    q = jobs.breaker_stream(stream, cfg=cfg).writeStream.foreachBatch(keep).outputMode("update").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert states == want and len(batches) >= 2


def test_streaming_log_and_metrics(spark, tmp_path):
    records(spark).drop("seq").write.json(f"{tmp_path}/log")
    q = jobs.append_log(readers.read_interactions(spark, f"{tmp_path}/log", stream=True), f"{tmp_path}/out", f"{tmp_path}/c1")
    q.awaitTermination(120)
    assert readers.read_interactions(spark, f"{tmp_path}/out").count() == 3
    spark.createDataFrame([("p", True, 1.0, 2.0)] * 4, "pattern string, success boolean, cost_tokens double, latency_ms double").write.json(f"{tmp_path}/ev")
    s = spark.readStream.schema("pattern string, success boolean, cost_tokens double, latency_ms double").json(f"{tmp_path}/ev")
    jobs.running_metrics(s, "live_metrics", f"{tmp_path}/c2").awaitTermination(120)
    assert spark.table("live_metrics").first().total_uses == 4


@pytest.mark.parametrize("headers,want", [(["Answer", "Question"], ("Question", "Answer")), (["q", "a"], ("q", "a")), (["q", "a", "text"], ("text",)), (["x"], ("x",)), (["x", "y", "z"], ("x", "y"))])
def test_csv_roles(headers, want):
    assert readers.csv_roles(headers) == want


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('question,answer\n"What, now?"," Yes ≥ 1 "\n,\nonly,\n"multi\nline",ok\n', encoding="utf-8")
    assert {tuple(r) for r in readers.read_csv(spark, f"{tmp_path}/a.csv")["qa"].collect()} == {("What, now?", "Yes ≥ 1"), ("multi\nline", "ok")}
    (tmp_path / "b.csv").write_text("text;n\n hello ;1\n")
    assert readers.read_csv(spark, f"{tmp_path}/b.csv", delimiter=";")["texts"].first().text == "hello"
    assert readers.read_csv(spark, f"{tmp_path}/b.csv", delimiter=";", question="text")["texts"].first().text == "hello 1"
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        readers.read_csv(spark, f"{tmp_path}/missing.csv")


def test_jsonl(spark, tmp_path):
    lines = ['{"conversations":[{"role":"system","content":"s"},{"role":"user","content":"q1"},{"role":"assistant","content":"a1"}]}', '{"conversations":[{"from":"human","value":"q2"},{"from":"gpt","value":"a2"}]}', '{"instruction":"q3","input":"","output":"a3"}', '{"question":"q4","answer":"a4"}', "", "not json"]
    (tmp_path / "t.jsonl").write_text("\n".join(lines))
    assert sorted((r.question, r.answer) for r in readers.read_training(spark, f"{tmp_path}/t.jsonl").collect()) == [(f"q{i}", f"a{i}") for i in range(1, 5)]
    (tmp_path / "log.jsonl").write_text('{"id":"1","question":"q"}\n\nbroken {\n')
    assert [r.id for r in readers.read_interactions(spark, f"{tmp_path}/log.jsonl").collect()] == ["1"]
    c = "named_struct('role', '{}', 'content', '{}')"
    talk = F.expr(f"array({c.format('user', ' q ')}, {c.format('assistant', 'a')})")
    assert one(spark, sinks.from_scratch(talk)) == "Question: q Answer: a"
    assert [m.role for m in one(spark, sinks.training_text(F.expr(f"array({c.format('system', 'x')}, {c.format('user', 'y')})")))] == ["assistant", "user"]
    log = spark.createDataFrame([("{'loss': 0.5, 'step': 3}",), ("{'eval_loss': 1.25}",), ("idle",)], "value string")
    assert [(r.step, r.loss, r.eval_loss) for r in readers.log_metrics(log).collect()] == [(None, 0.5, None), (None, None, 1.25), (None, None, None)]


def test_pages_with_parser(spark, tmp_path):
    (tmp_path / "x.pdf").write_bytes(b"one\fpage two")
    got = readers.read_pages(spark, str(tmp_path), lambda b: b.decode().split("\f")).orderBy("page").collect()
    assert [(r.page, r.text) for r in got] == [(1, "one"), (2, "page two")]


def test_library(spark):
    old = spark.createDataFrame([("a", "1", "x", 2), ("b", "1", "", 3)], "slug string, created string, category string, qa_count int")
    new = spark.createDataFrame([("a", "2", "y", 5)], "slug string, created string, category string, qa_count int")
    now = sinks.upsert(old, new, "slug", "created")
    assert {(r.slug, r.qa_count) for r in now.collect()} == {("a", 5), ("b", 3)}
    total, by = sinks.library_stats(now)
    assert total.first() == (2, 8) and {tuple(r) for r in by.collect()} == {("y", 1), ("general", 1)}
    assert [r.slug for r in sinks.delete(now, spark.createDataFrame([("a",)], "slug string"), "slug").collect()] == ["b"]


def test_prepare_end_to_end(spark, library, tmp_path):
    (tmp_path / "v").mkdir()
    (tmp_path / "v" / "x_vocabulary.yaml").write_text(VOCABULARY)
    docs = spark.createDataFrame([(1, "a.txt", PROSE)], "doc_id long, source string, text string")
    qa_rows = {"qa": spark.createDataFrame([("q", "a"), ("q", "a")], "question string, answer string")}
    args = {"documents": docs, "csv": qa_rows, "patterns": readers.read_patterns(spark, library), "vocabularies": readers.read_vocabularies(spark, f"{tmp_path}/v"), "memory": records(spark)}
    made = prepare.prepare(**args)
    n = {r.origin: r["count"] for r in made["pairs"].groupBy("origin").count().collect()}
    assert n["csv"] == 2 and n["memory"] == 1 and n["vocabulary"] <= 119 and set(n) == {"documents", "csv", "patterns", "vocabulary", "memory"}
    total = sum(n.values())
    assert made["pairs"].where("split = 'val'").count() == max(1, int(total * 0.15))
    assert made["pairs"].exceptAll(prepare.prepare(**args)["pairs"]).count() == 0
    prepare.write(made, f"{tmp_path}/out")
    rows = [json.loads(x.value) for x in spark.read.text(f"{tmp_path}/out/alpaca/split=train").collect()]
    assert len(rows) == total - max(1, int(total * 0.15)) and set(rows[0]) == {"instruction", "input", "output"} and all(r["instruction"] and r["output"] for r in rows)
    talk = json.loads(spark.read.text(f"{tmp_path}/out/sharegpt/split=val").first().value)
    assert [m["role"] for m in talk["conversations"]] == ["user", "assistant"]
    assert (tmp_path / "out" / "multiturn").exists()


def test_registered_queries_run(spark):
    import __spark_entry__ as e

    have = e.queries()
    assert set(e.oracle_sql()) <= set(have) and e.entry(spark).count() == 2


def test_welch_and_canaries(spark):
    """Against the t distribution by a fine sum of its density, and cases without variance."""
    import numpy as np

    def tail(t, df):
        u = np.linspace(0, 1 - 1e-9, 400_001)  # t = u / (1 - u)
        x = u / (1 - u)
        f = (1 + x * x / df) ** (-(df + 1) / 2) / (1 - u) ** 2
        return f[x >= t].sum() / f.sum()

    for t, df in ((0.0, 5.0), (1.3, 9.0), (2.1, 18.5), (2.0, 300.0), (3.4, 41.0), (1.96, 20_000.0)):
        assert abs(one(spark, learning.t_tail(F.lit(t), F.lit(df))) - tail(t, df)) < 1e-4
    w = lambda *x: one(spark, learning.welch(*map(F.lit, x)))
    assert w(0.5, 0.0, 10, 0.7, 0.0, 10) == 0.0 and w(0.5, 0.0, 10, 0.5, 0.0, 10) != w(0.5, 0.0, 10, 0.5, 0.0, 10)
    rows = [(i, p, (i // 2) % 10 < k if arm else (i // 2) % 10 < c) for p, c, k in (("up", 4, 9), ("same", 6, 6), ("down", 9, 3)) for i, arm in ((j, j % 2) for j in range(400))]
    e = spark.createDataFrame([(f"{p}{i}", p, ok, 1.0, 1.0) for i, p, ok in rows], "id string, pattern string, success boolean, cost_tokens double, latency_ms double")
    arms = {(r.id): r.a for r in e.select("id", learning.arm(F.col("id"), 0.5).alias("a")).collect()}
    got = {r.pattern: r for r in learning.canaries(e, "id", learning.Canary(0.5)).collect()}
    for p, r in got.items():
        mine = {a: [float(ok) for i, q, ok in rows if q == p and arms[f"{q}{i}"] == a] for a in ("control", "treatment")}
        assert (r.n_control, r.n_treatment) == (len(mine["control"]), len(mine["treatment"])) and r.control_sr == round(np.mean(mine["control"]), 4)
        a, b = (np.var(mine[x], ddof=1) / len(mine[x]) for x in ("control", "treatment"))
        df = (a + b) ** 2 / (a * a / (len(mine["control"]) - 1) + b * b / (len(mine["treatment"]) - 1))
        assert abs(r.p_value - tail(abs(np.mean(mine["treatment"]) - np.mean(mine["control"])) / np.sqrt(a + b), df)) < 2e-4


def test_run_quality_and_loss_runs(spark):
    q = lambda *x: one(spark, learning.run_quality(*(F.lit(v).cast("double") for v in x)))
    assert [q(1.0, None, 3.0), q(1.0, None, 1.2), q(2.0, 1.1, None), q(2.5, None, 2.6), q(3.0, 2.9, 5.0), q(None, 1.0, 1.0)] == ["Excellent", "Okay", "Excellent", "Fair", "Poor", ""]
    d = spark.createDataFrame([("r", 1, 4.0, None), ("r", 3, 1.1, None), ("r", 2, 0.9, 1.15), ("s", 1, None, 1.0)], "run string, step int, loss double, eval_loss double")
    got = {x.run: tuple(x)[1:] for x in learning.loss_runs(d).collect()}
    assert got == {"r": (4.0, 1.1, 0.9, 1.15, "Excellent"), "s": (None, None, None, 1.0, "")}


def test_split_finds_the_last_training_row(spark):
    for n, ratio in ((1, 0.15), (2, 0.5), (50, 0.0), (700, 0.3), (700, 1.0)):
        d = spark.createDataFrame([(i, f"t{i % 7}") for i in range(n)], "id int, t string")
        got = {r.id: r.split for r in curation.split_train_val(d, ["id", "t"], ratio).collect()}
        import hashlib

        order = sorted(range(n), key=lambda i: (hashlib.md5(f"42\x1f{i}\x1ft{i % 7}".encode()).hexdigest(), i))
        val = max(1, int(n * ratio))
        assert got == {i: "val" if place >= n - val else "train" for place, i in enumerate(order)}
    assert curation.split_train_val(spark.range(0), ["id"]).count() == 0


def test_error_stems_decide_like_the_expressions(spark):
    import random
    import re

    r = random.Random(2)
    parts = ["do", "not", "use", " ", "  ", "\n", "white", "coat", "-", "off", "label", "follow", "up", "contraindic", "error", "Monitor", "toxic", "dose", "reassess", "in", "é"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 12))) for _ in range(1500)]
    bank = [*curation.MEDICAL_PATTERNS, curation.ErrorPattern("grouped", r"(follow|white)\s+up", 0.5), curation.ErrorPattern("capital", r"Coat\s+white", 0.4), curation.ErrorPattern("any", r"a.c", 0.2)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", F.transform(curation.all_matches(F.col("t"), bank), lambda m: m["name"]).alias("names")).collect()
    for x in rows:
        assert x.names == [p.name for p in sorted(bank, key=lambda p: -p.confidence) if re.search(p.pattern, texts[x.i], re.I)], texts[x.i]


def test_holding_equals_all_pairs(spark):
    import random

    r = random.Random(3)
    word = lambda n: "".join(r.choice("abc_1") for _ in range(r.randint(1, n)))
    strings, terms = {word(9) for _ in range(200)} | {"", "the sea of abc"}, {w for w in (word(5) for _ in range(60)) if len(w) > 2}
    got = {(x.string, x.term) for x in retrieval.holding(spark.createDataFrame([(s,) for s in strings], "string string"), spark.createDataFrame([(x,) for x in terms], "term string")).collect()}
    assert got == {(s, x) for s in strings for x in terms if x in s}


def test_cached_index_sees_a_new_build_after_reload(spark, tmp_path):
    make = lambda rows: spark.createDataFrame(rows, "doc int, text string")
    q = spark.createDataFrame([(0, "apple pear")], "q int, query string")
    index = retrieval.TfidfIndex.build(make([(1, "apple tree"), (2, "stone wall")]), f"{tmp_path}/index", "doc", "text")
    assert [x.doc for x in index.search(q, "q", "query").collect()] == [1]
    retrieval.TfidfIndex.build(make([(7, "apple pear"), (8, "pear plum")]), f"{tmp_path}/index", "doc", "text")
    index.reload()
    assert [x.doc for x in index.search(q, "q", "query").orderBy("rank").collect()] == [7, 8]
    assert [x.doc for x in retrieval.TfidfIndex(spark, f"{tmp_path}/index").search(q, "q", "query", k=1).collect()] == [7]


def test_backends(spark):
    for url in ("https://example.com/v1", "http://8.8.8.8/v1", "nonsense"):
        with pytest.raises(ValueError):
            curation.http_backend(url, "m")
    assert callable(curation.http_backend("http://127.0.0.1:8080/v1", "m")) and callable(curation.http_backend("http://localhost/v1", "m"))
    df = spark.createDataFrame([(0, "What is it?", "It is the dose."), (1, " ", "x"), (2, "Why?", "bad")], "seq int, question string, answer string")
    reply = lambda chat: '{"quality": 2, "safety": 1, "cost": 1, "domain": 0, "performance": 1, "usability": 1}' if "dose" in chat[1]["content"] else "no"
    got = {x.seq: x for x in curation.model_judged(df, curation.local_backend(reply)).collect()}
    assert got[0].quality == 1.0 and got[0].domain == 0.0 and "heuristic_fallback" not in got[0].flags
    assert "heuristic_fallback" in got[1].flags and "heuristic_fallback" in got[2].flags


def test_scratch_needs_a_shared_folder(spark):
    from types import SimpleNamespace

    from loomline.functions.scratch import scratch_path

    def session(master, folder):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: folder), sparkContext=SimpleNamespace(master=master))

    assert scratch_path(session("yarn", "hdfs:/x"), "n").startswith("hdfs:/x/n-") and scratch_path(session("local[4]", None), "n").startswith("file:///")
    for master in ("yarn", "local-cluster[3,2,3000]", "spark://h:7077"):
        with pytest.raises(ValueError):
            scratch_path(session(master, None), "n")


def test_snapshot_and_listings(spark, tmp_path):
    spark.range(3).write.json(f"{tmp_path}/d")
    sinks.snapshot(spark, f"{tmp_path}/d", f"{tmp_path}/saved")
    spark.range(5).write.mode("overwrite").json(f"{tmp_path}/d")
    sinks.restore(spark, f"{tmp_path}/saved", f"{tmp_path}/d")
    assert spark.read.json(f"{tmp_path}/d").count() == 3
    with pytest.raises(FileNotFoundError):
        sinks.snapshot(spark, f"{tmp_path}/none", f"{tmp_path}/x")
    for name in ("b.csv", "a.pdf", "c.txt"):
        (tmp_path / "up").mkdir(exist_ok=True)
        (tmp_path / "up" / name).write_text("x")
    assert [x.name for x in readers.uploads(spark, f"{tmp_path}/up").collect()] == ["a.pdf", "b.csv"]
    for name in ("m/b", "m/a"):
        (tmp_path / name).mkdir(parents=True)
        (tmp_path / name / "train_alpaca.jsonl").write_text("{}")
    (tmp_path / "m/a/metadata.json").write_text('{"x": 1}')
    assert readers.first_training_file(spark, f"{tmp_path}/m").endswith("/m/a/train_alpaca.jsonl") and readers.first_training_file(spark, f"{tmp_path}/up", "none*") is None
    assert {x.artifact: (x.files, x.metadata) for x in readers.artifacts(spark, f"{tmp_path}/m").collect()} == {"a": (2, '{"x": 1}'), "b": (1, None)}


def test_term_weights_by_one_shuffle(spark):
    """A document's terms are counted where it lies; documents without terms, and a term that all have."""
    from collections import Counter
    from math import log

    said = [(0, "river stone river"), (1, ""), (2, None), (3, "the of"), (4, "river"), (5, "zeta Alpha zeta river alpha zeta")]
    d = spark.createDataFrame(said, "doc long, text string")
    made = retrieval.term_weights(d, 6, "doc", "text")
    counts = {i: Counter(w for w in (t or "").lower().split() if w not in ("the", "of")) for i, t in said}
    df = Counter(w for c in counts.values() for w in c)
    want = {(i, w): (c / sum(counts[i].values()) * (log(7 / (df[w] + 1)) + 1), df[w]) for i in counts for w, c in counts[i].items()}
    got = {(x.doc, x.term): (x.w, x.df) for x in made.collect()}
    assert got.keys() == want.keys() and all(abs(got[k][0] - want[k][0]) < 1e-12 and got[k][1] == want[k][1] for k in want)
    assert made._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange hashpartitioning") == 1


def test_scores_are_rounded_as_in_sql(spark):
    """Ties at the fifth place, whose doubles lie below or above them, decide ranks."""
    import duckdb

    values = [0.68695, 0.67885, 0.68395, 0.65075, 0.48124999999999996, 0.5, 0.12345, 1.0]
    want = [duckdb.execute("select round(?::double, 4)", [v]).fetchone()[0] for v in values]
    d = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = [x.c for x in d.select(curation.combine({"v": F.col("v")}, weights={"v": 1.0}).alias("c")).collect()]
    assert got == want


@pytest.mark.parametrize("earlier", [True, False])
def test_best_overlap_by_brute_force(spark, earlier):
    import random

    r = random.Random(5)
    words = ["the"] * 6 + ["dose", "aspirin", "daily", "risk", "take", "pain", "when", "child", "night", "safe"]
    say = lambda: " ".join(r.choice(words) for _ in range(r.randint(0, 8)))
    rows = [(i, r.choice([None, "a", "b", f"x{i}"]), say()) for i in range(150)] + [(200 + i, f"y{i % 3}", "the same question again") for i in range(6)]
    df = spark.createDataFrame(rows, "seq long, id string, question string")
    targets, pool = (df, df) if earlier else (df.where("seq % 2 = 0"), df.where("seq % 2 = 1"))
    got = {x.seq: x.jaccard for x in memory.best_overlap(targets, pool, earlier).collect()}
    sets = [(s, i or "", set(re.findall("[a-z]{3,}", q))) for s, i, q in rows]
    for s, i, a in sets:
        if not earlier and s % 2:
            continue
        best = max((len(a & b) / len(a | b) for t, j, b in sets if j != i and a & b and (t < s if earlier else t % 2)), default=None)
        assert got.get(s) == best or best >= memory.ENOUGH <= got[s] <= best, (s, best, got.get(s))


@pytest.mark.parametrize("earlier", [True, False])
def test_best_overlap_of_questions_that_share_little(spark, earlier):
    """Most share a frequent word or two and nothing else, so that low similarities decide."""
    import random

    r = random.Random(9)
    often, rare = ["the", "what", "how"], [f"w{a}{b}" for a in "abcdefghijklm" for b in "nopqrstuvwxyz"]
    say = lambda: " ".join(r.sample(often, r.randint(0, 3)) + r.choices(rare, k=r.choice((0, 1, 3, 6, 12))))
    rows = [(i, r.choice([None, "a", f"x{i}"]), say()) for i in range(250)]
    df = spark.createDataFrame(rows, "seq long, id string, question string")
    targets, pool = (df, df) if earlier else (df.where("seq % 2 = 0"), df.where("seq % 2 = 1"))
    got = {x.seq: x.jaccard for x in memory.best_overlap(targets, pool, earlier).collect()}
    sets = [(s, i or "", set(re.findall("[a-z]{3,}", q))) for s, i, q in rows]
    low = 0
    for s, i, a in sets:
        if not earlier and s % 2:
            continue
        best = max((len(a & b) / len(a | b) for t, j, b in sets if j != i and a & b and (t < s if earlier else t % 2)), default=None)
        assert got.get(s) == best or best >= memory.ENOUGH <= got[s] <= best, (s, best, got.get(s))
        low += best is not None and best < memory.ENOUGH / 2
    assert low > 20


@pytest.mark.parametrize("earlier", [True, False])
def test_best_overlap_block_by_block(spark, earlier, monkeypatch):
    """Blocks of a few sets, whose order and edges decide; ids that own many of the sets. No pair of sets is a row."""
    import random

    monkeypatch.setattr(memory, "TARGETS", 7)
    monkeypatch.setattr(memory, "POOL", 16)
    r = random.Random(3)
    rare = [f"w{a}{b}" for a in "abcdefghijklm" for b in "nopqrstuvwxyz"]
    rows = [(i, r.choice([None, "a", "b", f"x{i}"]), " ".join(["the"] * (i % 5 > 0) + r.sample(rare, r.choice((2, 4, 9))))) for i in range(120)] + [(200 + i, f"y{i % 2}", "the " + rare[i // 2]) for i in range(20)]
    df = spark.createDataFrame(rows, "seq long, id string, question string").repartition(5)
    targets, pool = (df, df) if earlier else (df.where("seq % 2 = 0"), df.where("seq % 2 = 1"))
    got = {x.seq: x.jaccard for x in memory.best_overlap(targets, pool, earlier).collect()}
    sets = [(s, i or "", set(q.split())) for s, i, q in rows]
    for s, i, a in sets:
        if not earlier and s % 2:
            continue
        best = max((len(a & b) / len(a | b) for t, j, b in sets if j != i and a & b and (t < s if earlier else t % 2)), default=None)
        assert got.get(s) == best or best >= memory.ENOUGH <= got[s] <= best, (s, best, got.get(s))


def test_small_tables_are_dealt_over_the_cores(spark, tmp_path):
    spark.range(1000).coalesce(1).write.parquet(f"{tmp_path}/t")
    dealt = readers.read_table(spark, f"{tmp_path}/t", least=1000)
    assert dealt.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and sorted(x.id for x in dealt.collect()) == list(range(1000))
    assert "Exchange" not in readers.read_table(spark, f"{tmp_path}/t")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in readers.read_table(spark, f"{tmp_path}/t", least=1)._jdf.queryExecution().executedPlan().toString()  # larger than a split a core
