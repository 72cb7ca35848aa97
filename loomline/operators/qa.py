"""Question-answer generation from text: template tables joined to facts.

A fact is one thing that can be asked about: a block name, positions, variables and flags. A template row names a
block, the flags it needs, and a question and an answer with ⟦variables⟧. Facts meet the templates of their block
in a broadcast join (templates are a fixed table of some hundred rows), and are rendered as Columns.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.functions.config import Domain
from loomline.functions.questions import QUESTIONS
from loomline.functions.text import first_sentence, has_any, let, render, sentences, strip
from loomline.operators.pages import captions, example_parts, is_heading, section_parts

FACT = "struct<block:string,item:int,sub:int,vars:map<string,string>,flags:array<string>>"


def fact(block: str, variables: dict[str, Column], flags: dict[str, Column] | None = None, item: Column | None = None, sub: Column | None = None) -> Column:
    pairs = [x for k, v in variables.items() for x in (F.lit(k), F.coalesce(v.cast("string"), F.lit("")))]
    on = F.array_compact(F.array(*(F.when(c, F.lit(k)) for k, c in (flags or {}).items()))) if flags else F.array()
    return F.struct(
        F.lit(block).alias("block"), (F.lit(0) if item is None else item).cast("int").alias("item"), (F.lit(0) if sub is None else sub).cast("int").alias("sub"),
        F.create_map(*pairs).cast("map<string,string>").alias("vars"), on.cast("array<string>").alias("flags"),
    ).cast(FACT)


def only(gate: Column, facts: Column) -> Column:
    return F.when(gate, facts).otherwise(F.array().cast(f"array<{FACT}>"))


def marked(text: str) -> str:
    return text.replace("{", "⟦").replace("}", "⟧")


def template_table(spark: SparkSession, rows: Iterable[tuple[str, str, str, str]]) -> DataFrame:
    """(block, pos, needs, q, a) from (block, flags it needs, question, answer); a block's place is that of its first row."""
    out, blocks = [], {}
    for i, (block, needs, q, a) in enumerate(rows):
        out.append((block, blocks.setdefault(block, len(blocks)), i, needs.split(), marked(q), marked(a)))
    return spark.createDataFrame(out, "block string, block_no int, pos int, needs array<string>, q string, a string")


def expand(df: DataFrame, facts: Column, templates: DataFrame, keep: list[str]) -> DataFrame:
    """keep + (block_no, item, sub, pos, question, answer): facts (an array Column) rendered with their templates."""
    f = df.select(*keep, F.explode(facts).alias("f")).select(*keep, "f.*")
    t = F.broadcast(templates)  # a fixed table
    met = f.join(t, "block").where(F.size(F.array_except("needs", "flags")) == 0)
    return met.select(*keep, "block_no", "item", "sub", "pos", render(F.col("q"), F.col("vars")).alias("question"), render(F.col("a"), F.col("vars")).alias("answer"))


# ---- chunks


def chunk_pairs(chunk: Column, source: Column | str = "doc", domain: Domain = Domain()) -> Column:
    """array of (question, answer) of a chunk: example blocks, heading and content, structured text, else any text of over 50 characters."""
    src = F.lit(source) if isinstance(source, str) else source
    src = F.regexp_replace(F.regexp_extract(src, r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")
    return let(F.struct(strip(chunk).alias("c"), src.alias("src")), lambda x: _chunk_pairs(x["c"], x["src"], domain))


# The wordings of the questions.
def _chunk_pairs(c: Column, src: Column, domain: Domain) -> Column:
    marker = "|".join(domain.label_regex(k)[len(r"^\s*(?:") : -len(r")\s*:?\s*$")] for k in ("input", "structured", "output"))
    part, name, structured = example_parts(c, domain)["structured"], domain.named(c), domain.structured(c)
    named_part = domain.named(part)
    pair = lambda q, a: F.struct(q.alias("question"), a.alias("answer"))
    say = lambda fmt, x: F.format_string(fmt, x)
    example = F.when(name.isNotNull(), F.array(pair(say("Show me an example using %s.", name), c))).otherwise(F.array(pair(say("Show me a structured example from %s.", src), c)))
    split = F.split(c, "\n\n", 2)
    head, body = strip(split[0]), strip(F.try_element_at(split, F.lit(2)))
    block = c.rlike(rf"(?im)^\s*(?:{marker})\s*:?\s*$")
    return (
        F.when(c == "", F.array().cast("array<struct<question:string,answer:string>>"))
        .when(block & (part != "") & named_part.isNotNull(), F.array(pair(say("Show me a complete example of %s with input and output.", named_part), c), pair(say("Show me a worked example using %s.", named_part), part)))
        .when(block & (part != ""), F.array(pair(say("Show me a complete structured example from %s.", src), c)))
        .when(block & structured, example)
        .when((F.size(split) == 2) & (F.length(head) < 150) & (F.length(body) > 30) & is_heading(head), F.array(pair(F.when(head.endswith("?"), head).otherwise(say("What is %s?", head)), body)))
        .when(structured, example)
        .when(F.length(c) > 50, F.array(pair(say("What does the documentation say about the following from %s?", src), c)))
        .otherwise(F.array().cast("array<struct<question:string,answer:string>>"))
    )


# ---- sections

# Phrases that open further groups of general questions.
SIGNALS = {
    "key_concepts": ("is defined as", "refers to", "means", "is a", "is the"),
    "application": ("for example", "such as", "in practice", "can be used", "is used"),
    "comparison": ("compared to", "unlike", "whereas", "in contrast", "however", "advantage", "disadvantage"),
    "causes_effects": ("because", "therefore", "as a result", "leads to", "causes", "results in"),
    "requirements": ("must", "required", "necessary", "prerequisite", "need to", "in order to"),
}
CATEGORY_WORDS = ("window", "aggregate", "table function", "ordered analytical", "olap", "analytic")


# The wordings beside those of the question file.
def section_templates(questions: dict = QUESTIONS) -> list[tuple[str, str, str, str]]:
    tech, general = questions["technical"], questions["general"]
    use_case_asked = any("use case" in q.lower() for k in ("syntax", "argument", "notes") for q in tech[k])
    rows = [
        ("s_desc", "", "What is {fn}?", "{desc}"), ("s_desc", "", "What does {fn} do?", "{desc}"), ("s_desc", "short", "Define {fn} in one sentence.", "{first}"), ("s_desc", "category", "What category of function or method is {fn}?", "{category}"),
        *(("s_syntax", "", q, "{syntax}") for q in tech["syntax"]),
        ("s_syntax", "structured", "Can {fn} be used in a nested context?", "{syntax}"), ("s_syntax", "structured", "What constraints apply when using {fn}?", "{syntax}"), ("s_syntax", "structured", "What are the key components of the {fn} format?", "{syntax}"),
        *(("s_args", "", q, "{args}") for q in tech["argument"]),
        *(("s_notes", "", q, "{notes}") for q in tech["notes"]),
    ]
    if not use_case_asked:
        rows += [("s_notes", "no_use_case", "When should I use {fn}?", "{notes}"), ("s_notes", "no_use_case", "What problem does {fn} solve?", "{desc_notes}")]
    rows += [
        *(("s_example", "parts fn", q, "{ex}") for q in tech["example"]),
        ("s_example", "parts fn", "What are the key steps in this {fn} example?", "{part}"), ("s_example", "parts", "Show me a worked example using {name}.", "{part}"), ("s_example", "parts output fn", "What does {fn} return in this example?", "{output}"),
        ("s_example", "whole fn", "Show me {which} {fn}.", "{ex}"), ("s_example", "whole fn", "What is the purpose of this {fn} example?", "{ex}"), ("s_example", "whole fn", "How would you modify this {fn} example to change the outcome?", "{ex}"),
        ("s_example", "whole structured named", "What example demonstrates how to use {name}?", "{ex}"), ("s_example", "whole structured fn", "Explain the logic in this {fn} example.", "{ex}"),
        ("s_caption", "", "What does the diagram show in the {fn} section?", "{caption}"),
        *(("s_general", "", q, "{raw}") for q in general["overview"]), *(("s_general", "", q, "{raw}") for q in general["detail"]),
        *(("s_general", k, q, "{raw}") for k in SIGNALS for q in general[k]),
        ("s_bare", "", "What does this section describe?", "{raw}"),
    ]
    return rows


def general_facts(topic: Column, text: Column) -> Column:
    made = lambda x: F.array(fact("s_general", {"fn": topic, "raw": x["raw"]}, {k: has_any(x["low"], v) for k, v in SIGNALS.items()}))
    return let(F.struct(text.alias("raw"), F.lower(text).alias("low")), made)


def section_facts(heading: Column, text: Column, label: Column | None = None, domain: Domain = Domain(), p: Column | None = None) -> Column:
    """Facts of one parsed section; general questions only where nothing else can be asked."""
    p = section_parts(text) if p is None else p
    fn = F.when(strip(heading) != "", strip(heading)).otherwise(F.lit("") if label is None else label)
    joined = lambda k: strip(F.array_join(p[k], "\n\n"))
    examples = F.filter(F.transform(p["examples"], strip), lambda e: e != "")
    section = F.struct(fn.alias("fn"), joined("description").alias("desc"), joined("syntax").alias("syntax"), joined("arguments").alias("args"), joined("notes").alias("notes"), strip(text).alias("raw"), examples.alias("examples"), captions(text).alias("captions"))
    category = lambda said: strip(F.try_element_at(F.filter(said, lambda s: has_any(F.lower(s), CATEGORY_WORDS)), F.lit(1)))
    described = lambda said: F.struct(strip(F.try_element_at(said, F.lit(1))).alias("first"), category(said).alias("category"))
    return let(section, lambda x: let(let(sentences(x["desc"]), described), lambda d: _section_facts(x, d, domain)))


def _section_facts(x: Column, d: Column, domain: Domain) -> Column:
    fn, desc, syntax, args, notes, raw = (x[k] for k in ("fn", "desc", "syntax", "args", "notes", "raw"))
    has_fn, first, category = fn != "", d["first"], d["category"]

    def example(ex: Column, i: Column) -> Column:
        return let(example_parts(ex, domain), lambda parts: example_fact(ex, i, parts))

    def example_fact(ex: Column, i: Column, parts: Column) -> Column:
        whole = parts["structured"] == ""
        found = domain.named(F.when(whole, ex).otherwise(parts["structured"]))
        name = F.coalesce(found, fn)
        return fact("s_example", {"fn": fn, "ex": ex, "part": parts["structured"], "output": parts["output"], "name": name, "which": F.when(i > 0, "another example of").otherwise("an example of")},
                    {"parts": ~whole, "whole": whole, "output": parts["output"] != "", "fn": has_fn, "structured": domain.structured(ex), "named": name != ""}, i)

    facts = F.concat(
        only((desc != "") & has_fn, F.array(fact("s_desc", {"fn": fn, "desc": desc, "first": first, "category": category}, {"short": (first != "") & (F.length(first) < F.length(desc) - 20), "category": category != ""}))),
        only((syntax != "") & has_fn, F.array(fact("s_syntax", {"fn": fn, "syntax": syntax}, {"structured": domain.structured(syntax)}))),
        only((args != "") & has_fn, F.array(fact("s_args", {"fn": fn, "args": args}))),
        only((notes != "") & has_fn, F.array(fact("s_notes", {"fn": fn, "notes": notes, "desc_notes": F.when(desc != "", F.concat_ws("\n\n", desc, notes)).otherwise(notes)}, {"no_use_case": ~F.lower(fn).contains("use case")}))),
        F.filter(F.transform(x["examples"], example), lambda f: F.length(f["vars"]["ex"]) >= 30),
        only(has_fn, F.transform(x["captions"], lambda c, i: fact("s_caption", {"fn": fn, "caption": c}, None, i))),
    )
    long = F.length(raw) > 60
    rest = F.when(has_fn & long, general_facts(fn, raw)).when(long, F.array(fact("s_bare", {"raw": raw}))).otherwise(F.array().cast(f"array<{FACT}>"))
    return let(facts, lambda made: F.when(F.size(made) > 0, made).otherwise(rest))


def section_qa(sections: DataFrame, keep: list[str], heading: str = "heading", text: str = "text", label: str = "", domain: Domain = Domain(), questions: dict = QUESTIONS) -> DataFrame:
    t = template_table(sections.sparkSession, section_templates(questions))
    parsed = sections.withColumn("_p", section_parts(text))
    return expand(parsed, section_facts(F.col(heading), F.coalesce(F.col(text), F.lit("")), F.lit(label), domain, F.col("_p")), t, keep)


def turn(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def asked(question: Column, answer: Column) -> Column:
    return F.array(turn("user", question), turn("assistant", answer))


# The wordings of the turns.
def section_conversation(heading: Column, p: Column) -> Column:
    """description, syntax, first example as turns; null for under four messages."""
    h = strip(heading)
    desc, syntax = strip(F.array_join(p["description"], "\n\n")), strip(F.array_join(p["syntax"], "\n\n"))
    example = F.try_element_at(F.filter(F.transform(p["examples"], strip), lambda e: e != ""), F.lit(1))
    none = F.array().cast("array<struct<role:string,content:string>>")
    turns = F.concat(
        asked(F.format_string("What is %s?", h), desc), F.when(syntax != "", asked(F.format_string("What is the syntax for %s?", h), syntax)).otherwise(none),
        F.when(example.isNotNull(), asked(F.format_string("Can you show me an example of %s?", h), example)).otherwise(none),
    )
    return F.when((h != "") & (desc != "") & (F.size(turns) >= 4), turns)
