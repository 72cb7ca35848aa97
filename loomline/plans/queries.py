"""The registered queries: each operator on the driver's tables, and DuckDB SQL for the same rows where SQL can express it.

Stand-ins: documents are pages of manuals, of at most 500 pages each, named by their source and number; consecutive user and assistant turns are questions
and answers; events are executions of a pattern named by their user; benchmark texts are retrieval queries.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomline.functions import text as tx
from loomline.functions.config import Domain
from loomline.functions.questions import QUESTIONS
from loomline.functions.scratch import scratch_path
from loomline.operators import chunking, curation, learning, memory, pages, patterns, qa, retrieval
from loomline.plans.prepare import document_pairs, write
from loomline.sources import readers, sinks
from loomline.streaming import jobs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
KEYWORDS = ("the", "ing", "ion", "que", "und")
DOMAIN = Domain(keywords=("the", "und", "les", "que"), min_matches=3)


def query(name: str, sql: str | None = None):
    def add(f: Callable[[Callable[[str], DataFrame]], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(lambda t: readers.read_table(spark, f"{sf_dir}/{t}.parquet"))
        QUERIES[name].__name__ = name
        if sql:
            ORACLES[name] = sql
        return f

    return add


# ---- SQL pieces

_SP = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def s_strip(x: str) -> str:
    return f"trim(coalesce({x}, ''), {_SP})"


def s_words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '\\s+'), lambda w: w <> '')"


def s_lines(x: str) -> str:
    return f"list_filter(list_transform(string_split(coalesce({x}, ''), chr(10)), lambda l: trim(l, {_SP})), lambda l: l <> '')"


def s_tokens(x: str, pattern: str) -> str:
    return f"regexp_extract_all(lower({x}), '{pattern}')"


def s_list(values) -> str:
    return "[" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in values) + "]"


def s_round(x: str) -> str:
    return f"round({x}, 4)"


S_QA = """qa as (select conv_id, turn, conv_id * 1000 + turn as seq, text as question, ntext as answer from (
  select *, lead(text) over (partition by conv_id order by turn) as ntext, lead(role) over (partition by conv_id order by turn) as nrole from conversations)
  where role = 'user' and nrole = 'assistant')"""


def pairs(t) -> DataFrame:
    w = Window.partitionBy("conv_id").orderBy("turn")
    c = t("conversations").withColumn("nrole", F.lead("role").over(w)).withColumn("answer", F.lead("text").over(w))
    return c.where("role = 'user' and nrole = 'assistant'").select("conv_id", "turn", (F.col("conv_id") * 1000 + F.col("turn")).alias("seq"), F.col("text").alias("question"), "answer")


# ---- pages

S_LS = f"l as (select doc_id, source, lang, text, {s_lines('text')} as ls, {s_strip('text')} as t from documents)"
S_TOC = r"(len(t) >= 50 and ((len(ls) > 3 and contains(lower(ls[1]), 'contents')) or (len(list_filter(ls, lambda x: regexp_matches(x, '\.\s{0,2}\d+\s*$'))) >= 3 and len(list_filter(ls, lambda x: regexp_matches(x, '\.\s{0,2}\d+\s*$'))) >= len(ls) // 2)))"
S_BOILER = r"(len(t) < 100 or (contains(lower(t), 'copyright') and (contains(lower(t), 'rights reserved') or contains(t, '©'))) or (contains(lower(t), 'trademark') and contains(lower(t), 'safety') and len(t) < 800) or (regexp_matches(lower(t), 'https?://\S+') and len(t) < 300))"
S_INDEX = r"(len(t) >= 50 and (len(list_filter(ls, lambda x: regexp_matches(x, '^[A-Z]$'))) >= 3 or (len(list_filter(ls, lambda x: regexp_matches(x, '\d+(?:,\s*\d+)*\s*$') and len(x) < 80)) >= 5 and len(list_filter(ls, lambda x: regexp_matches(x, '\d+(?:,\s*\d+)*\s*$') and len(x) < 80)) >= len(ls) * 0.5)))"
S_SUBST = f"(len(t) >= 80 and len(list_filter(string_split(t, chr(10)), lambda x: len(trim(x, {_SP})) > 20)) >= 2 and coalesce(list_sum(list_transform(list_filter(string_split(t, chr(10)), lambda x: len(trim(x, {_SP})) > 20), lambda x: len(x))), 0) > 200)"
S_KEEP = f"({S_SUBST} and not {S_BOILER} and not {S_TOC} and not {S_INDEX})"


def s_heading(x: str) -> str:
    return (
        f"(len({x}) between 3 and 80 and not regexp_matches({x}, '[.:,]$') and len({s_words(x)}) <= 10 and not regexp_matches({x}, '^\\d') and not regexp_matches({x}, '\\d{{4}}-\\d{{2}}-\\d{{2}}') "
        f"and len(list_filter(regexp_extract_all({x}, '[\\p{{L}}\\p{{N}}_]+'), lambda k: regexp_full_match(k, '\\d+'))) < 2 and not list_contains({s_list(pages.RESERVED_HEADINGS)}, upper({x})) "
        f"and len(list_intersect({s_words(x)}, {s_list(pages.STRUCTURE_WORDS)})) < 2 and ({' or '.join(f'regexp_matches({x}, $q${p}$q$)' for p in pages.HEADING_SHAPES)}))"
    )


def flag_query(name: str, test: Callable[[str], Column], sql: str) -> None:
    query(name, f"with {S_LS} select doc_id, {sql} as flag from l")(lambda t: t("documents").select("doc_id", test("text").alias("flag")))


flag_query("flt1_toc", pages.is_toc, S_TOC)
flag_query("flt2_boilerplate", pages.is_boilerplate, S_BOILER)
flag_query("flt3_index", pages.is_index, S_INDEX)
flag_query("flt4_substantive", pages.is_substantive, S_SUBST.replace("string_split(t, chr(10))", "string_split(text, chr(10))"))
flag_query("src10_valid_text", pages.valid_text, f"(len(t) >= 50 and len(ls) >= 3 and len({s_words('text')}) >= 10 and len(translate(text, ' ' || chr(10), '')) > 0 and len(regexp_replace(text, '[^\\p{{L}}]+', '', 'g')) / greatest(len(translate(text, ' ' || chr(10), '')), 1) >= 0.4)")
flag_query("flt6_structured", lambda c: DOMAIN.structured(F.col(c)), f"(len(list_filter({s_tokens('text', '[\\p{L}\\p{N}_]+')}, lambda w: list_contains({s_list(DOMAIN.keywords)}, w))) >= 3)")


@query("flt5_page_chain", f"with {S_LS} select doc_id, source, {S_KEEP} as kept from l")
def _(t):
    return t("documents").select("doc_id", "source", pages.keep_page("text").alias("kept"))


@query("flt7_heading_lines", f"with {S_LS} select doc_id, len(ls)::int as n_lines, list_filter(ls, lambda x: {s_heading('x')}) as headings from l")
def _(t):
    return t("documents").select("doc_id", pages.lines("text").alias("l")).select("doc_id", F.size("l").alias("n_lines"), F.filter("l", pages.is_heading).alias("headings"))


@query("chk7_page_heading", f"with {S_LS} select doc_id, list_filter(ls[1:5], lambda x: {s_heading('x')})[1] as heading from l")
def _(t):
    return t("documents").select("doc_id", pages.page_heading("text").alias("heading"))


S_KEY = lambda x: f"trim(lower(regexp_replace(regexp_replace(trim({x}, {_SP}), '^\\d{{1,4}}\\s+', ''), '\\s+\\d{{1,4}}$', '')), {_SP})"
S_RUN = f"""b as (select doc_id, source, list_filter(string_split({s_strip('text')}, chr(10)), lambda l: trim(l, {_SP}) <> '') as ls from documents),
e as (select source, 'header' as side, unnest(ls[1:2]) as x from b union all select source, 'footer', unnest(case when len(ls) >= 2 then ls[-2:] else ls end) from b),
c as (select source, side, {S_KEY('x')} as line, count(*) as n from e group by all having len(line) > 4),
r as (select c.* from c join (select source, count(*) as p from documents group by source having count(*) >= 4) using (source) where n >= greatest(3, floor(p * 0.02)))"""


@query("chk5_running_lines", f"with {S_RUN} select source, side, line, n from r")
def _(t):
    return pages.running_lines(t("documents"), "source", "text", 0.02)


@query("chk6_stripped_pages", f"with {S_RUN}, k as (select source, list(distinct line) as ks from r group by source) select doc_id, md5(case when ks is null then text else array_to_string(list_filter(string_split(text, chr(10)), lambda l: not list_contains(ks, {S_KEY('l')}) and not regexp_matches(l, '^\\s*\\d{{1,4}}\\s*$')), chr(10)) end) as md5 from documents d left join k on k.source = d.source")
def _(t):
    docs = t("documents").select("doc_id", "source", "text")
    return pages.strip_running(docs, pages.running_lines(docs, "source", "text", 0.02), "source").select("doc_id", F.md5("text").alias("md5"))


S_MANUAL = "source || '/' || (doc_id // 500)"


def manuals(t) -> DataFrame:
    return t("documents").select(F.concat_ws("/", "source", F.floor(F.col("doc_id") / 500).cast("string")).alias("doc"), F.col("doc_id").alias("page"), "text")


S_SECT = f"""h as (select doc_id, {S_MANUAL} as source, t, list_filter(ls[1:5], lambda x: {s_heading('x')})[1] as h from l),
n as (select *, coalesce(last_value(h ignore nulls) over (partition by source order by doc_id rows between unbounded preceding and current row), 'Introduction') as now from h),
g as (select *, case when now <> lag(now) over (partition by source order by doc_id) then 1 else 0 end as new from n),
s as (select *, sum(new) over (partition by source order by doc_id rows between unbounded preceding and current row) as section from g)"""


@query("chk8_sections", f"with {S_LS}, {S_SECT} select source as doc, section::bigint as section, now as heading, min(doc_id) as page_start, max(doc_id) as page_end, count(*) as pages, md5(string_agg(t, chr(10) || chr(10) order by doc_id)) as md5 from s group by all")
def _(t):
    return pages.sections(manuals(t)).select("doc", "section", "heading", "page_start", "page_end", "pages", F.md5("text").alias("md5"))


@query("chk8_long_sections", f"with {S_LS}, {S_SECT.replace(S_MANUAL, 'source')} select source as doc, section::bigint as section, now as heading, min(doc_id) as page_start, max(doc_id) as page_end, count(*) as pages, md5(string_agg(t, chr(10) || chr(10) order by doc_id)) as md5 from s group by all")
def _(t):
    """All pages of a source as one document, however many they are."""
    made = pages.long_sections(t("documents").select(F.col("source").alias("doc"), F.col("doc_id").alias("page"), "text"))
    return made.select("doc", "section", "heading", "page_start", "page_end", "pages", F.md5("text").alias("md5"))


@query("chk12_captions", f"select doc_id, list_transform(regexp_extract_all(text, '(?i)(?:Figure|Fig\\.?)\\s+[\\d\\-\\.]+\\s*[:\\-]\\s*(.+)'), lambda x: trim(x, {_SP})) as found from documents")
def _(t):
    return t("documents").select("doc_id", pages.captions("text").alias("found"))


@query("chk13_manual_label", "select distinct source, trim(lower(regexp_replace(source, '[^\\w\\-]', '_', 'g')), '_') as label from documents")
def _(t):
    return t("documents").select("source").distinct().select("source", pages.manual_label(F.concat(F.lit("/x/"), "source", F.lit(".pdf"))).alias("label"))


def s_manuals() -> str:
    """c: the pages that extraction keeps, without running lines."""
    running = S_RUN.replace("from documents)", "from kp)", 1).replace("from documents group by", "from kp group by").replace("floor(p * 0.02)", "floor(p * 0.3)")
    clean = f"case when ks is null then text else array_to_string(list_filter(string_split(text, chr(10)), lambda l: not list_contains(ks, {S_KEY('l')}) and not regexp_matches(l, '^\\s*\\d{{1,4}}\\s*$')), chr(10)) end"
    again = S_SUBST.replace("string_split(t, chr(10))", "string_split(text, chr(10))")
    return f"""{S_LS}, kp as (select doc_id, {S_MANUAL} as source, text from l where {S_KEEP.replace(S_SUBST, again)}), {running}, ks as (select source, list(distinct line) as ks from r group by source),
x as (select doc_id, source, {clean} as text from kp left join ks using (source)), y as (select *, {s_strip('text')} as t from x), cp as (select * from y where {again})"""


@query("chk14_manual_report", f"""with {s_manuals()}, n as (select {S_MANUAL} as source, count(*) as total from documents group by all)
select source as doc, total as num_pages_total, count(doc_id) as num_pages_kept, md5(coalesce(string_agg(t, chr(10) || chr(10) order by doc_id) filter (t <> ''), '')) as md5 from n left join cp using (source) group by all""")
def _(t):
    got = pages.extract_manuals(manuals(t))
    return got["documents"].select("doc", "num_pages_total", "num_pages_kept", F.md5("full_text").alias("md5"))


@query("chk15_diagnostic_report")
def _(t):
    from loomline.plans.prepare import report

    return report(manuals(t), DOMAIN)


@query("chk9_structured_blocks", f"with x as (select doc_id, list_filter(regexp_split_to_array(text, '\\n+'), lambda p: len(list_filter({s_tokens('p', '[\\p{L}\\p{N}_]+')}, lambda w: list_contains({s_list(DOMAIN.keywords)}, w))) >= 3) as ps from documents) select doc_id, len(ps)::int as n, md5(array_to_string(list_transform(ps, lambda p: trim(p, {_SP})), chr(10))) as md5 from x")
def _(t):
    return t("documents").select("doc_id", pages.structured_blocks("text", DOMAIN, "\n+").alias("b")).select("doc_id", F.size("b").alias("n"), F.md5(F.array_join("b", "\n")).alias("md5"))


# ---- chunking

def s_chunks(overlap: int, size: int = 800, parts: str = f"list_filter(list_transform(regexp_split_to_array(text, '\\n+'), lambda x: trim(x, {_SP})), lambda x: x <> '')", joint: int = 2, sep: str = "chr(10) || chr(10)", fixed: str = "false", alone: bool = True) -> str:
    """c: chunks (doc_id, source, seq, chunk) of SQL parts. fixed: SQL that says of a part x whether no overlap reaches over it; alone: whether a chunk of one part may be carried."""
    fits = f"list_filter(range(s, i), lambda q: coalesce(list_sum(ns[q:i - 1]), 0) <= {overlap} and not list_contains(fs[q:i - 1], true))"
    carried = f"case when {'true' if alone else 'i - s > 1'} then len({fits}) else 0 end"
    used = f"ns[i] + {joint}" if not overlap else f"case when {'true' if alone else 'i - s > 1'} then coalesce(list_sum(ns[i - k:i - 1]), 0) + ns[i] + {joint} * k else ns[i] + {joint} end"
    return f"""p as (select doc_id, source, text, len(text) as n_text, {s_strip('text')} as t, {parts} as ps from documents),
m as (select *, list_transform(ps, lambda x: len(x)) as ns, list_transform(ps, lambda x: {fixed}) as fs from p),
r(doc_id, i, s, used, bounds) as (
  select doc_id, 1, 1, 0, []::integer[][] from m where n_text > {size}
  union all
  select doc_id, i + 1, (case when flush then i - k else s end)::integer, (case when flush then {used} else used + ns[i] + {joint} end)::integer, case when flush then list_append(bounds, [s, (i - 1)::integer]) else bounds end
  from (select r.*, ns, fs, used + ns[i] + {joint} > {size} and i > s as flush, {carried if overlap else '0'} as k from r join m using (doc_id) where i <= len(ns))),
f as (select r.doc_id, case when s <= len(ns) then list_append(bounds, [s, len(ns)::integer]) else bounds end as bounds from r join m using (doc_id) where i = len(ns) + 1),
c as (select doc_id, source, generate_subscripts(cs, 1) - 1 as seq, unnest(cs) as chunk from (
  select doc_id, source, case when t = '' then [] when n_text <= {size} then [t] when len(ps) = 0 then [text] else list_transform(bounds, lambda b: array_to_string(ps[b[1]:b[2]], {sep})) end as cs from m left join f using (doc_id)))"""


@query("chk2_chunks", f"with recursive {s_chunks(0)} select doc_id, seq::int as seq, len(chunk)::int as n_chars, md5(chunk) as md5 from c")
def _(t):
    d = chunking.exploded(t("documents").select("doc_id", "text"), chunking.chunks("text", 800, 0, "\n+"))
    return d.select("doc_id", "seq", F.length("chunk").alias("n_chars"), F.md5("chunk").alias("md5"))


@query("chk2_chunks_overlap", f"with recursive {s_chunks(150)} select doc_id, seq::int as seq, len(chunk)::int as n_chars, md5(chunk) as md5 from c")
def _(t):
    d = chunking.exploded(t("documents").select("doc_id", "text"), chunking.chunks("text", 800, 150, "\n+"))
    return d.select("doc_id", "seq", F.length("chunk").alias("n_chars"), F.md5("chunk").alias("md5"))


S_STRUCTURED = f"len(list_filter({s_tokens('x', '[\\p{L}\\p{N}_]+')}, lambda w: list_contains({s_list(DOMAIN.keywords)}, w))) >= 3"
S_SENTENCES = f"list_filter(list_transform(string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda x: trim(x, {_SP})), lambda x: len(x) > 10)"


@query("chk3_structured_chunks", f"with recursive {s_chunks(150, fixed=S_STRUCTURED)} select doc_id, seq::int as seq, len(chunk)::int as n_chars, md5(chunk) as md5 from c")
def _(t):
    d = chunking.exploded(t("documents").select("doc_id", "text"), chunking.structured_chunks("text", 800, 150, DOMAIN, "\n+"))
    return d.select("doc_id", "seq", F.length("chunk").alias("n_chars"), F.md5("chunk").alias("md5"))


@query("chk4_sentence_chunks", f"with recursive {s_chunks(150, parts=S_SENTENCES, joint=1, sep="' '", alone=False)} select doc_id, seq::int as seq, len(chunk)::int as n_chars, md5(chunk) as md5 from c")
def _(t):
    d = chunking.exploded(t("documents").select("doc_id", "text"), chunking.sentence_chunks("text", 800, 150))
    return d.select("doc_id", "seq", F.length("chunk").alias("n_chars"), F.md5("chunk").alias("md5"))


@query("chk10_example_parts", f"with {S_QA} select seq, md5({s_strip('question')}) as input, md5({s_strip('answer')}) as structured, 'Done.' as output from qa")
def _(t):
    text = F.concat(F.lit("Input:\n"), "question", F.lit("\n\nProtocol:\n"), "answer", F.lit("\n\nOutput:\nDone."))
    return pairs(t).select("seq", pages.example_parts(text).alias("p")).select("seq", F.md5("p.input").alias("input"), F.md5("p.structured").alias("structured"), "p.output")


@query("chk11_section_parts", f"with {S_QA} select seq, " + ", ".join(f"md5({ {'description': s_strip('question'), 'syntax': s_strip('answer'), 'notes': "'Take care.'", 'examples': "'One example of it.'"}.get(k, "''") }) as {k}" for k in pages.PART_LABELS) + " from qa")
def _(t):
    text = F.concat("question", F.lit("\n\nSyntax:\n"), "answer", F.lit("\n\nNotes\n\nTake care.\n\nExample:\nOne example of it."))
    return pairs(t).select("seq", pages.section_parts(text).alias("p")).select("seq", *(F.md5(F.array_join(f"p.{k}", "|")).alias(k) for k in pages.PART_LABELS))


# ---- generation

def s_generated(overlap: int) -> str:
    """g: question and answer of each chunk that asks something."""
    return f"""{s_chunks(overlap)}, q as (select doc_id, source, seq, chunk, len(list_filter({s_tokens('chunk', '[\\p{L}\\p{N}_]+')}, lambda w: list_contains({s_list(DOMAIN.keywords)}, w))) >= 3 as st, string_split(chunk, chr(10) || chr(10)) as ps from c),
h as (select *, {s_strip('ps[1]')} as head, {s_strip("array_to_string(ps[2:], chr(10) || chr(10))")} as body from q),
a as (select *, len(ps) >= 2 and len(head) < 150 and len(body) > 30 and {s_heading('head')} as hd from h),
g as (select doc_id, seq, source, case when hd then case when ends_with(head, '?') then head else 'What is ' || head || '?' end when st then 'Show me a structured example from ' || source || '.' else 'What does the documentation say about the following from ' || source || '?' end as question, case when hd then body else chunk end as answer from a where hd or st or len(chunk) > 50)"""


@query("gen1_chunk_questions", f"with recursive {s_generated(0)} select doc_id as doc, seq::int as chunk, md5(question) as question, md5(answer) as answer from g")
def _(t):
    p = document_pairs(t("documents"), size=800, overlap=0, separator="\n+", domain=DOMAIN)
    return p.select("doc", "chunk", F.md5("question").alias("question"), F.md5("answer").alias("answer"))


@query("gen2_section_questions")
def _(t):
    s = pages.sections(manuals(t))
    return qa.section_qa(s, ["doc", "section"], label="manual", domain=DOMAIN).groupBy("doc", "section").agg(F.count("*").alias("n"), F.countDistinct("question").alias("questions"))


def s_general() -> str:
    g = QUESTIONS["general"]
    tests = {"overview": "true", "detail": "true"} | {k: " or ".join(f"contains(lower(text), $q${x}$q$)" for x in sig) for k, sig in qa.SIGNALS.items()}
    asked = " union all ".join(f"select doc_id, source, text, unnest({s_list(g[k])}) as q from documents where {test}" for k, test in tests.items())
    return f"select doc_id, md5(replace(q, '{{fn}}', source)) as question, md5(text) as answer from ({asked})"


@query("gen3_general_questions", s_general())
def _(t):
    d = t("documents")
    made = qa.expand(d, qa.general_facts(F.col("source"), F.col("text")), qa.template_table(d.sparkSession, qa.section_templates()), ["doc_id"])
    return made.select("doc_id", F.md5("question").alias("question"), F.md5("answer").alias("answer"))


@query("gen4_section_conversations", f"""with {S_QA} select seq, 'user|What is Topic ' || conv_id || '?|assistant|' || {s_strip('question')} || '|user|What is the syntax for Topic ' || conv_id || '?|assistant|' || {s_strip('answer')} as talk from qa where {s_strip('question')} <> '' and {s_strip('answer')} <> ''""")
def _(t):
    text = F.concat("question", F.lit("\n\nSyntax:\n"), "answer")
    c = pairs(t).select("seq", qa.section_conversation(F.concat(F.lit("Topic "), "conv_id"), pages.section_parts(text)).alias("c"))
    return c.where("c is not null").select("seq", F.array_join(F.transform("c", lambda m: F.concat_ws("|", m["role"], m["content"])), "|").alias("talk"))


def nations(t) -> DataFrame:
    n = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return n.select(F.col("n_nationkey").cast("int").alias("entry"), F.col("n_name").alias("name"), F.col("r_name").alias("category"), F.concat(F.lit("A nation of "), "r_name", F.lit(". It trades with many others.")).alias("description"))


def s_filled(template: str, values: dict[str, str]) -> str:
    """SQL for a template with {names} whose values are SQL."""
    parts = re.split(r"\{(\w+)\}", template)
    return " || ".join(values[x] if i % 2 else "'" + x.replace("'", "''") + "'" for i, x in enumerate(parts) if x)


def s_pattern_questions() -> str:
    """What the nations ask as patterns with two uses, one limit and their region for a related pattern."""
    uses = ("shipping goods", "counting orders")
    listed = "chr(10) || '- shipping goods' || chr(10) || '- counting orders'"
    first, desc = "'A nation of ' || r_name || '.'", "'A nation of ' || r_name || '. It trades with many others.'"
    own = {"fn": "n_name", "desc": desc, "first": first, "cat": f"n_name || ' is a ' || r_name || ' function. ' || {first}", "uc_text": listed, "gl": "chr(10) || '- no exports'", "rel": "r_name"}
    on = {"desc": ("short", "category"), "uses": ("desc",), "use": ("desc",), "limits": (), "related": ()}
    asked = []
    for block, needs, q, a in patterns.pattern_templates():
        if block in on and set(needs.split()) <= set(on[block]):
            for use in uses if block == "use" else ("",):
                values = own | {"uc": f"'{use}'", "uc_low": f"'{use}'"}
                asked.append(f"select n_name as name, {s_filled(q, values)} as question, {s_filled(a, values)} as answer from e")
    return "with e as (select n_name, r_name from nation join region on n_regionkey = r_regionkey) " + " union all ".join(asked)


@query("gen5_pattern_questions", s_pattern_questions())
def _(t):
    n = nations(t)
    blank = {f: F.lit(None) for f in ("title", "pattern_alias", "source_file")}
    p = n.withColumns(blank).withColumn("use_cases", F.array(F.lit("shipping goods"), F.lit("counting orders"))).withColumn("related_patterns", F.array("category")).withColumn("guardrails", F.array(F.lit("no exports")))
    for c, kind in patterns.PATTERN_TYPES.items():
        if c not in p.columns:
            p = p.withColumn(c, F.lit(None).cast(kind))
    return patterns.pattern_qa(p, ["name"]).select("name", "question", "answer")


def s_vocabulary() -> str:
    """All questions and answers that the nations' entries give: (source, question, answer)."""
    own = lambda g, k: [q for q in QUESTIONS[g][k] if patterns.placeholders(q) == ["fn"]]
    described = own("technical", "description") + own("technical", "use_case") + own("technical", "notes") + own("general", "overview")
    related = [q for q in QUESTIONS["technical"]["comparison"] if set(patterns.placeholders(q)) == {"fn", "related"}]
    alone = own("technical", "comparison")
    ask = lambda qs, answer, extra="": f"select n_name as source, replace(unnest({s_list(qs)}), '{{fn}}', n_name) as question, {answer} as answer from e{extra}"
    parts = [ask(described, "d"), ask(own("technical", "category"), "r_name")]
    parts.append(f"select source, replace(question, '{{related}}', rel) as question, answer || '\n\nCompare with ' || rel || ' for differences in behavior and use cases.' as answer from (select rel, {ask(related, "n_name || ': ' || d")[7:]}, (select unnest([0, 1]) as i) k, lateral (select case when i = 0 then r_name else 'the sea' end as rel))".replace("'\n\n", "chr(10) || chr(10) || '"))
    if alone:
        parts.append(ask(alone, "n_name || ': ' || d", ", (select unnest([0, 1]))"))
    return "with e as (select n_name, r_name, 'A nation of ' || r_name || '. It trades with many others.' as d from nation join region on n_regionkey = r_regionkey) " + " union all ".join(parts)


def vocabulary_entries(t) -> DataFrame:
    n = nations(t).withColumn("domain", F.lit("general")).withColumn("related", F.array("category", F.lit("the sea")))
    for c in ("one_sentence", "syntax", "null_behavior", "performance_tips", "analysis_notes", "errors", "first_example", "source_file"):
        n = n.withColumn(c, F.lit(None).cast("string"))
    return n


def vocabulary(t) -> DataFrame:
    return patterns.vocabulary_qa(vocabulary_entries(t))


@query("gen10_vocabulary_questions", s_vocabulary())
def _(t):
    return vocabulary(t).select("source", "question", "answer")


@query("gen11_comparison_questions", "select n_name as source, 'How does ' || n_name || ' differ from ' || r_name || '?' as question from nation join region on n_regionkey = r_regionkey union all select n_name, 'How does ' || n_name || ' differ from the sea?' from nation")
def _(t):
    return vocabulary(t).where("question like 'How does % differ from %' and question not like '%other approaches%'").select("source", "question")


_TEMPLATES = [(g, k, q) for g, ks in QUESTIONS.items() for k, qs in ks.items() for q in qs]


@query("gen13_placeholders", "select g, k, q, regexp_extract_all(q, '\\{(\\w+)\\}', 1) as names from (values " + ", ".join(f"('{g}', '{k}', {s_list([q])[1:-1]})" for g, k, q in _TEMPLATES) + ") as t(g, k, q)")
def _(t):
    return t("region").sparkSession.createDataFrame([(g, k, q, patterns.placeholders(q)) for g, k, q in _TEMPLATES], "g string, k string, q string, names array<string>")


# ---- dedup, split

S_FP = lambda x: f"md5(substr(regexp_replace(lower({s_strip(x)}), '\\s+', ' ', 'g'), 1, 400))"


@query("ded1_fingerprint_first", f"with f as (select doc_id, lang, {S_FP('source || chr(10) || text')} as fp from documents) select min(doc_id) as doc_id, lang, fp from f group by lang, fp")
def _(t):
    d = curation.dedup_first(t("documents"), "source", "text", ["lang"], ["doc_id"])
    return d.select("doc_id", "lang", tx.fingerprint(F.concat_ws("\n", "source", "text")).alias("fp"))


@query("ded1_duplicate_groups", f"select {S_FP('text')} as fp, count(*) as n, min(doc_id) as first_doc from documents group by 1 having count(*) > 1")
def _(t):
    return t("documents").groupBy(tx.fingerprint("text").alias("fp")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc")).where("n > 1")


S_SPLIT = "select doc_id, case when row_number() over (order by md5('42' || chr(31) || doc_id), doc_id) > count(*) over () - greatest(1, floor(count(*) over () * 0.15)) then 'val' else 'train' end as split from documents"


@query("spl2_train_val", S_SPLIT)
def _(t):
    return curation.split_train_val(t("documents").select("doc_id"), ["doc_id"])


@query("spl1_shuffle", "select doc_id, md5('42' || chr(31) || doc_id) as key from documents")
def _(t):
    return t("documents").select("doc_id", curation.shuffle_key(42, "doc_id").alias("key"))


@query("spl3_arms", "select event_id, case when ('0x' || substr(md5(event_id::varchar), 1, 6))::bigint / pow(16.0, 6) < 0.1 then 'treatment' else 'control' end as arm from events")
def _(t):
    return t("events").select("event_id", learning.arm(F.col("event_id")).alias("arm"))


# ---- judge

S_SC = f"""{S_QA}, w as (select *, {s_words('question')} as qw, {s_words('answer')} as aw, list_distinct(list_filter({s_tokens('question', '[a-zA-Z]{3,}')}, lambda x: not list_contains({s_list(curation.JUDGE_STOP_WORDS)}, x))) as qs,
  list_distinct(list_filter({s_tokens('answer', '[a-zA-Z]{3,}')}, lambda x: not list_contains({s_list(curation.JUDGE_STOP_WORDS)}, x))) as sa, {s_tokens('answer', '[\\p{L}\\p{N}_]+')} as toks,
  regexp_matches(answer, $q${curation.REFUSAL}$q$) as refused, regexp_matches(answer, $q${curation.HARM}$q$) as harmful, len(regexp_extract_all(answer, $q${curation.LIST_ITEM}$q$)) >= 2 as listed, regexp_matches(answer, $q${curation.CODE_BLOCK}$q$) as coded from qa),
o as (select *, len(list_intersect(qs, sa)) / greatest(len(qs), 1) as ov, len(aw) / greatest(len(qw), 1) as ra,
  len(list_filter(toks, lambda x: regexp_full_match(x, 'use|run|execute|call|select|insert|update|delete|create|drop|set|get|return|example|below|following|steps?|first|then|finally'))) / greatest(len(aw), 1) as act,
  len(list_filter(toks, lambda x: list_contains({s_list('maybe perhaps might could possibly generally typically usually sometimes often'.split())}, x))) / greatest(len(aw), 1) as hed from w),
j as (select seq, conv_id, turn, question, answer,
  case when {s_strip('answer')} = '' then 0.0 else round(least((case when refused then greatest(0.0, ov - 0.4) else ov end) * 0.6::double + least(len(answer) / greatest(len(question) * 1.5::double, 50.0::double), 1.0::double) * 0.4::double, 1.0::double), 4) end as quality,
  case when harmful then 0.0 when refused then 0.6 else 1.0 end::double as safety,
  round(case when ra <= 4 then 1.0::double when ra <= 8 then 1 - (ra - 4) / 8 else greatest(0.0::double, 0.5::double - (ra - 8) / 16) end, 4) as cost,
  round(({' + '.join(f"contains(lower(answer), '{k}')::int" for k in KEYWORDS)}) / {len(KEYWORDS)}, 4) as domain,
  round(case when not coded and not listed and len(aw) < 20 then 0.2::double else 0.5::double + case when coded then 0.3::double else 0.0::double end + case when listed then 0.2::double else 0.0::double end end, 4) as performance,
  round(greatest(0.0::double, least(least(act * 5, 0.8::double) + 0.2::double - hed * 2, 1.0::double)), 4) as usability, refused, harmful, coded, listed, ra, hed, len(aw) as na from o)"""
S_CONF = "round(" + " + ".join(f"{k} * {v}::double" for k, v in curation.WEIGHTS.items()) + ", 4)"


def judged(t) -> DataFrame:
    return curation.judged(pairs(t), keywords=KEYWORDS)


for _i, _k in enumerate(curation.SCORES, 1):
    query(f"jdg{_i}_{_k}", f"with {S_SC} select seq, {_k}::double as score from j")(lambda t, k=_k: judged(t).select("seq", F.col(k).cast("double").alias("score")))


S_FLAGS = f"""list_filter([case when {s_strip('answer')} = '' then 'empty answer' end, case when {s_strip('answer')} <> '' and refused then 'refusal detected' end, case when harmful then 'harmful content detected' end,
  case when not harmful and refused then 'refusal / uncertainty' end, case when ra > 4 and ra <= 8 then 'verbose answer' end, case when ra > 8 then 'very verbose answer' end, case when domain < 0.3 then 'low domain vocabulary coverage' end,
  case when not coded and not listed and na < 20 then 'very short / unstructured answer' end, case when hed > 0.05 then 'hedging language detected' end], lambda x: x is not null)"""


@query("jdg7_flags", f"with {S_SC} select seq, {S_FLAGS} as flags from j")
def _(t):
    return judged(t).select("seq", "flags")


@query("jdg8_levels", f"with {S_SC}, c as (select {S_CONF} as c from j) select case when c >= 0.8 then 'HIGH' when c >= 0.5 then 'MEDIUM' else 'LOW' end as level, case when c >= 0.8 then 'auto_accept' when c >= 0.5 then 'monitor' else 'escalate' end as action, count(*) as n from c group by all")
def _(t):
    return judged(t).groupBy("level", "action").agg(F.count("*").alias("n"))


@query("jdg9_evaluate", f"with {S_SC} select seq, {S_CONF} as confidence, {S_CONF} >= 0.6 as passes from j")
def _(t):
    return judged(t).select("seq", "confidence", curation.gate(F.col("confidence")).alias("passes"))


@query("jdg10_model_scores", f"""with {S_SC}, m as (select *, {S_CONF} as c, {S_FLAGS} as fl from j) select seq, case when turn = 0 then 0.5::double else quality end as quality, case when turn = 0 then 0.5::double else c end as confidence,
  case when turn = 0 then []::varchar[] else list_append(fl, 'heuristic_fallback') end as flags from m""")
def _(t):
    import json

    reply = F.concat(F.lit("```json\n" + json.dumps(dict.fromkeys(curation.SCORES, 0.5))[:-1] + ', "note": '), F.col("turn").cast("string"), F.lit("}\n```"))
    p = pairs(t).withColumn("reply", F.when(F.col("turn") == 0, reply).otherwise("no scores"))
    return curation.hybrid_judged(p, "reply", keywords=KEYWORDS).select("seq", "quality", "confidence", "flags")


@query("agg15_strategies", f"""with {S_SC} select seq, round(least(quality, safety, cost, domain, performance, usability), 4) as least, round(greatest(quality, safety, cost, domain, performance, usability), 4) as most,
  round(((quality >= 0.6)::int + (safety >= 0.6)::int + (cost >= 0.6)::int + (domain >= 0.6)::int + (performance >= 0.6)::int + (usability >= 0.6)::int) / 6, 4) as majority,
  case when greatest(quality, safety, cost, domain, performance, usability) >= 0.6 then 1.0 else 0.0 end::double as any_pass from j""")
def _(t):
    s = {k: F.col(k) for k in curation.SCORES}
    names = {"least": "all_must_pass", "most": "max_score", "majority": "majority_pass", "any_pass": "any_pass"}
    return judged(t).select("seq", *(curation.combine(s, v).cast("double").alias(k) for k, v in names.items()))


@query("ord1_rank", f"with {S_SC} select seq, row_number() over (order by {S_CONF} desc, seq)::int as rank from j order by rank limit 100")
def _(t):
    return curation.ranked(judged(t), [F.desc("confidence"), F.asc("seq")], 100).select("seq", "rank")


@query("ord3_top_demonstrations", f"with {S_SC}, c as (select *, {S_CONF} as confidence from j) select seq, confidence, row_number() over (order by confidence desc, seq)::int as rank from c where confidence >= 0.5 order by rank limit 10")
def _(t):
    return curation.top_demonstrations(judged(t), 10, 0.5).select("seq", "confidence", "rank")


@query("ord4_distill", f"""with {S_SC}, c as (select seq, conv_id % 2 as teacher, case when conv_id % 2 = 1 then least({S_CONF} + 0.1::double, 1.0::double) else {S_CONF} end as confidence from j)
select seq, teacher::int as is_teacher, round(confidence, 4) as confidence, row_number() over (order by confidence desc, teacher desc, seq)::int as rank from c where confidence >= 0.5 order by rank limit 10""")
def _(t):
    j = judged(t)
    d = curation.distilled(j.where("conv_id % 2 = 1"), j.where("conv_id % 2 = 0"), 10, 0.5)
    return d.select("seq", "is_teacher", F.round("confidence", 4).alias("confidence"), "rank")


# ---- curriculum

_BANK = sorted(curation.MEDICAL_PATTERNS, key=lambda p: -p.confidence)
S_BEST = "case " + " ".join(f"when regexp_matches(text, $q$(?i){p.pattern}$q$) then '{p.name}'" for p in _BANK) + " end"
S_BEST_C = "case " + " ".join(f"when regexp_matches(text, $q$(?i){p.pattern}$q$) then {p.confidence}::double" for p in _BANK) + " end"
S_PLAIN = f"(0.72::double - case when len({s_words('text')}) > 100 then 0.10::double else 0.0::double end - case when len(list_filter({s_tokens('text', '[\\p{L}\\p{N}_]+')}, lambda w: list_contains(['patient', 'medication', 'treatment', 'diagnosis', 'protocol', 'dosage'], w))) > 0 or contains(text, '```') or len(list_filter(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]+'), lambda w: w = 'def' or w = 'class')) > 0 then 0.05::double else 0.0::double end)"


@query("cur1_best_match", f"select doc_id, {S_BEST} as name from documents")
def _(t):
    return t("documents").select("doc_id", curation.best_match(F.col("text"))["name"].alias("name"))


@query("cur2_all_matches", "select doc_id, list_filter([" + ", ".join(f"case when regexp_matches(text, $q$(?i){p.pattern}$q$) then '{p.name}' end" for p in _BANK) + "], lambda x: x is not null) as names from documents")
def _(t):
    return t("documents").select("doc_id", F.transform(curation.all_matches(F.col("text")), lambda m: m["name"]).alias("names"))


@query("cur2_bank_matches", "select b.doc_id, a.name as best, b.names from (" + ORACLES["cur1_best_match"] + ") a join (" + ORACLES["cur2_all_matches"] + ") b using (doc_id)")
def _(t):
    bank = curation.PatternBank(curation.MEDICAL_PATTERNS)
    return t("documents").select("doc_id", bank.best_match(F.col("text"))["name"].alias("best"), F.transform(bank.all_matches(F.col("text")), lambda m: m["name"]).alias("names"))


S_CUR = f"select doc_id, round(coalesce({S_BEST_C}, greatest(0.5::double, least({S_PLAIN}, 0.75::double))), 4) as confidence from documents"


@query("cur4_confidence", S_CUR)
def _(t):
    return curation.curriculum(t("documents"), "text").select("doc_id", "confidence")


@query("ord2_curriculum_levels", f"with c as ({S_CUR}) select case when confidence >= 0.8 then 'HIGH' when confidence >= 0.5 then 'MEDIUM' else 'LOW' end as level, count(*) as n from c group by level")
def _(t):
    return curation.curriculum(t("documents"), "text").groupBy("level").agg(F.count("*").alias("n"))


@query("cur6_retry_actions", f"with c as ({S_CUR}) select case when confidence >= 0.8 then 'auto_retry' when confidence >= 0.5 then 'retry_with_monitoring' else 'escalate_to_human' end as retry_action, count(*) as n from c group by all")
def _(t):
    return curation.curriculum(t("documents"), "text").groupBy("retry_action").agg(F.count("*").alias("n"))


# ---- memory

S_LOG = f"{S_QA}, log as (select seq, conv_id::varchar as id, seq::varchar as timestamp, question, answer, case conv_id % 3 when 0 then true when 1 then false end as approved, conv_id % 2 = 0 as kb from qa)"


def log(t) -> DataFrame:
    approved = F.when(F.col("conv_id") % 3 == 0, True).when(F.col("conv_id") % 3 == 1, False)
    return pairs(t).select("seq", F.col("conv_id").cast("string").alias("id"), F.col("seq").cast("string").alias("timestamp"), (F.col("conv_id") % 5).cast("string").alias("session_id"), "question", "answer", approved.alias("approved"), (F.col("conv_id") % 2 == 0).alias("kb_context_used"))


@query("agg1_status_counts", f"with {S_LOG} select count(*) as total, count(*) filter (approved) as approved, count(*) filter (not approved) as rejected, count(*) filter (approved is null) as pending from log")
def _(t):
    return memory.status_counts(log(t))


S_KEYQ = f"{S_LOG}, k as (select *, trim(regexp_replace(lower(question), '[^\\p{{L}}\\p{{N}}_\\s]', '', 'g'), {_SP}) as key from log)"


@query("agg2_frequent_questions", f"with {S_KEYQ} select key, count(*) as n, max_by(question, (timestamp, seq)) as question, max_by(answer, (timestamp, seq)) as answer from k group by key having count(*) >= 2")
def _(t):
    return memory.frequent_questions(log(t)).select("key", "n", "question", "answer")


@query("agg12_question_types", "with q as (select lower(text) as q from conversations where role = 'user') select case " + " ".join("when " + " or ".join(f"starts_with(q, '{k[1:]}')" if k[0] == "^" else f"contains(q, '{k}')" for k in ks) + f" then '{n}'" for n, ks in pages.QUESTION_TYPES) + " end as kind, count(*) as n from q group by kind")
def _(t):
    return t("conversations").where("role = 'user'").groupBy(pages.question_type("text").alias("kind")).agg(F.count("*").alias("n"))


S_REL = f"""{S_LOG}, s as (select seq, id, list_distinct({s_tokens('question', '[a-z]{3,}')}) as w from log), x as (select seq, id, len(w) as n, unnest(w) as w from s),
b as (select a.seq, max(c / (a.n + a.m - c)) as jaccard from (select a.seq, a.n, b.n as m, b.seq as o, count(*)::double as c from x a join x b on a.w = b.w and b.seq < a.seq and a.id <> b.id group by all) a group by a.seq),
f as (select log.*, round(least(coalesce(jaccard, 0) * 2, 1.0), 4)::double as frequency,
  round(least(least(ln(1 + len({s_words('answer')})) / ln(201), 1.0) + case when regexp_matches(answer, $q${curation.CODE_BLOCK}$q$) then 0.15::double else 0.0::double end + case when len(regexp_extract_all(answer, $q${curation.LIST_ITEM}$q$)) >= 2 then 0.10::double else 0.0::double end, 1.0), 4)::double as complexity,
  round(least(case when approved then 0.3::double + case when kb then 0.3::double else 0.0::double end + 0.4::double when not approved then greatest(0.0::double, 0.3::double + case when kb then 0.3::double else 0.0::double end - 0.3::double) else 0.3::double + case when kb then 0.3::double else 0.0::double end end, 1.0), 4)::double as effectiveness,
  case when approved then 1.0 when not approved then 0.0 else 0.3 end::double as feedback from log left join b using (seq)),
v as (select *, round(frequency * 0.3::double + complexity * 0.25::double + effectiveness * 0.25::double + feedback * 0.2::double, 4) as relevance from f)"""


@query("rel1_frequency", f"with {S_REL} select seq, frequency from v")
def _(t):
    return memory.relevance(log(t)).select("seq", "frequency")


@query("rel4_relevance", f"with {S_REL} select seq, complexity, effectiveness, feedback, relevance from v")
def _(t):
    return memory.relevance(log(t)).select("seq", "complexity", "effectiveness", "feedback", "relevance")


@query("ord8_eviction", f"with {S_REL} select seq, relevance, row_number() over (order by relevance, seq) <= count(*) over () - 50 as evicted from v")
def _(t):
    return memory.evict(memory.relevance(log(t)).select("seq", "relevance"), 50, ["relevance", "seq"])


@query("ord7_long_term_search", f"with {S_REL} select seq, relevance from v where contains(lower(question || ' ' || answer), 'the') or contains(lower(question || ' ' || answer), 'est') order by relevance desc, seq limit 5")
def _(t):
    return memory.search_long_term(memory.relevance(log(t)), "the est of").select("seq", "relevance")


def tiers(t) -> DataFrame:
    scored = memory.relevance(log(t)).withColumn("ingested_at", F.col("seq").cast("double"))
    return memory.promote(scored.where("seq % 2 = 0"), scored.where("seq % 2 = 1"), F.lit(1e9), memory.Promotion(threshold=0.4, archive=0.6))


S_TIERS = f"""{S_REL}, p as (select a.seq, max(c / (a.n + a.m - c)) as jaccard from (select a.seq, a.n, b.n as m, b.seq as o, count(*)::double as c from (select x.* from x join v using (seq) where x.seq % 2 = 0 and relevance >= 0.4) a join (select * from x where seq % 2 = 1) b on a.w = b.w and a.id <> b.id group by all) a group by a.seq),
u as (select seq, round(round(least(coalesce(jaccard, 0) * 2, 1.0), 4)::double * 0.3::double + complexity * 0.25::double + effectiveness * 0.25::double + feedback * 0.2::double, 4) as relevance from v left join p using (seq) where seq % 2 = 0 and relevance >= 0.4),
mt as (select seq, relevance from v where seq % 2 = 1 union all select * from u), mr as (select *, row_number() over (order by seq desc) > 10000 as evicted from mt),
ti as (select seq, case when evicted or relevance >= 0.6 then 'long_term' else 'mid_term' end as tier, relevance from mr union all select seq, 'short_term', relevance from v where seq % 2 = 0 and relevance < 0.4)"""


@query("str6_promotion", f"with {S_TIERS} select seq, tier, relevance from ti")
def _(t):
    return tiers(t).select("seq", "tier", "relevance")


@query("agg4_tier_stats", f"with {S_TIERS} select t.tier, t.capacity, count(seq) as n, coalesce(round(avg(relevance), 4), 0.0) as avg_relevance from (values ('short_term', 500::bigint), ('mid_term', 10000), ('long_term', null)) as t(tier, capacity) left join ti using (tier) group by all")
def _(t):
    return memory.tier_stats(tiers(t))


@query("flt8_interactions", f"with {S_LOG} select seq, question from log where approved order by seq desc limit 20")
def _(t):
    return memory.interactions(log(t), approved_only=True, limit=20).select("seq", "question")


@query("snk6_set_approval", f"with {S_LOG}, u as (select id, max_by(len(answer) > len(question), seq) as said from log group by id) select seq, case when seq = min(seq) over (partition by id) then coalesce(said, approved) else approved end as approved from log left join u using (id)")
def _(t):
    updates = log(t).groupBy("id").agg(F.max_by(F.length("answer") > F.length("question"), "seq").alias("approved"))  # each conversation's last answer decides
    return memory.set_approval(log(t), updates).select("seq", "approved")


S_TOK = lambda x: f"case when {x} = '' then 0 else greatest(1, floor(len({s_words(x)}) * 1.3::double)::int) end"


@query("str10_token_estimate", f"select conv_id, turn, {S_TOK('text')} as tokens from conversations")
def _(t):
    return t("conversations").select("conv_id", "turn", tx.token_estimate("text").alias("tokens"))


@query("str7_live_turns", f"""with k as (select conv_id, turn, {S_TOK('text')} as tokens from conversations) select conv_id, turn, tokens, (turn = max(turn) over (partition by conv_id)
  or sum(tokens) over (partition by conv_id order by turn rows between current row and unbounded following) <= 120) as in_l1 from k""")
def _(t):
    return memory.live_turns(t("conversations"), "conv_id", budget=120).select("conv_id", "turn", "tokens", "in_l1")


S_WORDS = lambda x: f"regexp_extract_all({x}, '[\\p{{L}}\\p{{M}}\\p{{N}}\\p{{Pc}}]+')"
S_PRIORITY = f"""(3 * (len(list_filter({S_WORDS('lower(s)')}, lambda w: list_contains({s_list(memory.CLINICAL_WORDS)}, w))) + len(list_filter(list_zip({S_WORDS('lower(s)')}[:-2], {S_WORDS('lower(s)')}[2:]), lambda z: z[1] = 'blood' and z[2] = 'pressure' and contains(lower(s), 'blood pressure'))))
  + len(list_filter({S_WORDS('s')}, lambda w: regexp_full_match(w, '\\p{{Nd}}+') or regexp_full_match(w, '[A-Z][a-z]{{3,}}'))))"""


S_BREAKS = "string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1))"


def s_key_sentences(rows: str, keys: str, budget: int) -> str:
    """g: (keys, made) of rows (keys, text): the sentences of highest priority that fit the budget, tried one after another."""
    same = " and ".join(f"o.{k.strip()} = k.{k.strip()}" for k in keys.split(","))
    mine = ", ".join(f"o.{k.strip()}" for k in keys.split(","))
    return f"""a as materialized (select {keys}, {s_strip('text')} as text from {rows}), x as materialized (select {keys}, {S_BREAKS} as ss from a), r as materialized (select {keys}, unnest(range(1, len(ss) + 1)) as i, unnest(ss) as s from x),
o as materialized (select {keys}, i, s, {S_TOK('s')} as t, row_number() over (partition by {keys} order by {S_PRIORITY} desc, i) as n from r),
k as (select {keys}, 0::bigint as n, 0::bigint as i, '' as s, 0::bigint as used, false as got from a union all select {mine}, o.n, o.i, o.s, case when used < {budget} and used + t <= {budget} then used + t else used end, used < {budget} and used + t <= {budget} from k join o on {same} and o.n = k.n + 1),
g as materialized (select {keys}, coalesce(string_agg(s, ' ' order by i) filter (where got), '') as made from k group by {keys})"""


S_SUFFIX = f"array_to_string(ss[coalesce(list_min(list_filter(range(1, len(ss) + 1), lambda q: list_sum(list_transform(ss[q:], lambda z: {S_TOK('z')})) <= 200)), len(ss) + 1):], ' ')"  # the last sentences that fit together


@query("str8_summaries", f"""with recursive w as materialized (select conv_id, turn, text, {S_TOK("coalesce(text, '')")} as tokens from conversations), l as (select *, turn = max(turn) over (partition by conv_id) or sum(tokens) over (partition by conv_id order by turn rows between current row and unbounded following) <= 60 as live from w),
e as materialized (select conv_id, turn, text from l where not live), {s_key_sentences('e', 'conv_id, turn', 50)}, h as materialized (select *, row_number() over (partition by conv_id order by turn) as n from g),
f as (select distinct conv_id, 0::bigint as n, '' as l2 from h union all select conv_id, n, case when made = '' then l2 when {S_TOK('text')} > 200 then {S_SUFFIX} else text end from (select *, {S_BREAKS} as ss from (select h.conv_id, h.n, h.made, f.l2, {s_strip("f.l2 || ' ' || h.made")} as text from f join h on h.conv_id = f.conv_id and h.n = f.n + 1))),
m as (select conv_id, max_by(l2, n) as l2 from f group by conv_id) select conv_id, md5(l2) as md5, {S_TOK('l2')} as tokens from m""")
def _(t):
    return memory.summaries(t("conversations"), "conv_id", budgets=memory.Budgets(l1=60, l2=200)).select("conv_id", F.md5("l2").alias("md5"), tx.token_estimate("l2").alias("tokens"))


@query("str9_key_sentences", f"with recursive {s_key_sentences('documents', 'doc_id', 100)} select doc_id, len(made)::int as n_chars, md5(made) as md5 from g")
def _(t):
    made = memory.key_sentences(F.col("text"), 100)
    return t("documents").select("doc_id", made.alias("made")).select("doc_id", F.length("made").alias("n_chars"), F.md5("made").alias("md5"))


@query("str11_rom_kernel", f"select doc_id, len(array_to_string({s_words('text')}[1:76], ' '))::int as n from documents where floor(len({s_words('text')}) * 1.3::double) > 100")
def _(t):
    return t("documents").where(tx.token_estimate("text") > 100).select("doc_id", F.length(memory.rom(F.col("text"), 100)).alias("n"))


@query("str12_render", f"""with k as (select conv_id, turn, role, text, {S_TOK('text')} as tokens from conversations), l as (select *, (turn = max(turn) over (partition by conv_id) or sum(tokens) over (partition by conv_id order by turn rows between current row and unbounded following) <= 120) as live from k)
select conv_id, md5('Be brief.' || chr(10) || chr(10) || string_agg(upper(role) || ': ' || text, chr(10) order by turn)) as md5 from l where live group by conv_id""")
def _(t):
    l1 = memory.recent_text(t("conversations"), "conv_id", budget=120)
    return l1.select("conv_id", F.md5(memory.rendered(F.lit("Be brief."), F.lit(""), F.lit(""), F.col("l1"))).alias("md5"))


@query("ord9_last_turns", "select conv_id, turn, role from (select *, row_number() over (partition by conv_id order by turn desc) as n from conversations) where n <= 6")
def _(t):
    return memory.last_messages(t("conversations"), 6, "conv_id").select("conv_id", "turn", "role")


@query("msc9_pick_list", f"with {S_LOG} select id || ' | ' || case when approved then 'approved' when not approved then 'rejected' else 'pending' end || ' ' || timestamp || ' ' || substr(question, 1, 60) as label from log order by seq desc limit 100")
def _(t):
    return memory.pick_list(log(t))


# ---- retrieval

S_KT = f"list_filter({s_tokens('text', retrieval.TOKEN)}, lambda x: len(x) > 2 and not list_contains({s_list(retrieval.KEYWORD_STOP)}, x))"


@query("ret1_query_terms", f"select item_id, {S_KT} as terms from benchmark")
def _(t):
    return t("benchmark").select("item_id", retrieval.query_terms("text").alias("terms"))


@query("ret3_keyword_search", f"""with q as (select item_id, {S_KT} as ts from benchmark), p as (select item_id, doc_id, list_sum(list_transform(ts, lambda x: case when x = lower(source) or x = lower(lang) then 10 when contains(lower(source), x) or contains(lower(lang), x) then 5 when contains(lower(text), x) then 1 else 0 end)) as score
  from q cross join documents where len(ts) > 0), r as (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from p) select item_id, doc_id, score::int as score, rank::int as rank from r where rank <= 2 and score >= 3""")
def _(t):
    library = t("documents").select(F.col("doc_id").alias("seq"), F.col("source").alias("name"), F.col("lang").alias("title"), F.col("text").alias("body"))
    found = retrieval.keyword_search(t("benchmark").select("item_id", F.col("text").alias("question")), library, by="item_id")
    return found.select("item_id", F.col("seq").alias("doc_id"), "score", "rank")


S_TT = lambda x: f"list_filter({s_tokens(x, retrieval.TOKEN)}, lambda x: len(x) > 2 and not list_contains({s_list(retrieval.TFIDF_STOP)}, x))"
S_TF = f"""d as (select doc_id, {S_TT('text')} as t from documents), c as (select doc_id, len(t) as n, unnest(t) as term from d), tc as (select doc_id, term, any_value(n) as n, count(*) as c from c group by doc_id, term),
nd as (select count(*) as nd from documents), f as (select term, count(*) as df, ln((any_value(nd) + 1.0) / (count(*) + 1.0)) + 1.0 as idf from tc, nd group by term)"""


@query("tfi3_idf", f"with {S_TF} select term, df, round(idf::double, 6) as idf from f")
def _(t):
    counts = retrieval.term_counts(t("documents"), "doc_id", "text")
    return retrieval.document_frequency(counts, t("documents").count()).select("term", "df", F.round("idf", 6).alias("idf"))


@query("tfi5_search", f"""with {S_TF}, dw as (select doc_id, term, c / n * idf as w from tc join f using (term)), q as (select item_id, {S_TT('text')} as t from benchmark), qc as (select item_id, len(t) as n, unnest(t) as term from q),
qt as (select item_id, term, any_value(n) as n, count(*) as c from qc group by item_id, term), qw as (select item_id, qt.term, c / n * coalesce(idf, ln(nd + 1.0) + 1.0) as w from qt left join f on f.term = qt.term, nd),
dn as (select doc_id, sqrt(sum(w * w)) as dn from dw group by doc_id), qn as (select item_id, sqrt(sum(w * w)) as qn from qw group by item_id), s as (select item_id, doc_id, sum(qw.w * dw.w) as dot from qw join dw on qw.term = dw.term group by item_id, doc_id),
r as (select item_id, doc_id, round(dot / (dn * qn), 4) as score from s join dn using (doc_id) join qn using (item_id)), k as (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from r)
select item_id, doc_id, score::double as score, rank::int as rank from k where rank <= 3 and score >= 0.05""")
def _(t):
    return retrieval.tfidf_search(t("benchmark").select("item_id", F.col("text").alias("query")), t("documents").select("doc_id", "text"), "item_id", "query", "doc_id", "text")


S_DOT = lambda a, b: f"list_sum(list_transform(list_zip({a}, {b}), lambda z: z[1]::double * z[2]::double))"


@query("tfi6_dense_search", f"""with p as (select q.vec_id as query_id, v.vec_id, round({S_DOT('q.embedding', 'v.embedding')} / (sqrt({S_DOT('q.embedding', 'q.embedding')}) * sqrt({S_DOT('v.embedding', 'v.embedding')}) + 1e-9), 4) as score from embeddings q cross join embeddings v where q.vec_id % 100 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from p) select query_id, vec_id, score, rank::int as rank from r where rank <= 3 and score >= 0.05""")
def _(t):
    e = t("embeddings")
    return retrieval.dense_search(e.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("qv")), e)


# ---- learning

S_EV = "ev as (select event_id, user_id as pattern, event_type <> 'error' as success, value as cost_tokens, value as latency_ms, epoch(ts)::double as tm from events)"


def executions(t) -> DataFrame:
    ts = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    return t("events").select("event_id", F.col("user_id").alias("pattern"), (F.col("event_type") != "error").alias("success"), F.col("value").alias("cost_tokens"), F.col("value").alias("latency_ms"), ts.alias("at"), F.col("event_id").alias("seq"))


S_MET = f"""{S_EV}, m as (select pattern, count(*) as total_uses, count(*) filter (success) as success_count, sum(cost_tokens) as cost from ev group by pattern), mm as (select *, success_count / total_uses as sr, 1 / (1 + exp(-0.15::double * (total_uses - 20))) as cf from m),
mr as (select *, case when cf < 0.3 then 'INVESTIGATE' when sr >= 0.85 and cf >= 0.6 then 'PROMOTE' when sr >= 0.5 then 'KEEP' when sr >= 0.2 then 'DEMOTE' else 'REMOVE' end as recommend from mm)"""


@query("agg6_metrics", f"with {S_MET} select pattern, total_uses, success_count, round(sr, 4) as success_rate, round(cost / total_uses, 2) as avg_cost, round(cf, 4) as confidence from mr")
def _(t):
    return learning.metrics(executions(t)).select("pattern", "total_uses", "success_count", "success_rate", "avg_cost", "confidence")


@query("agg8_recommendations", f"with {S_MET} select pattern, recommend from mr")
def _(t):
    return learning.metrics(executions(t)).select("pattern", "recommend")


S_SIMPSON = lambda a: f"list_sum(list_transform(range(0, {401}), lambda i: (case when i = 0 or i = {400} then 1 when i % 2 = 1 then 4 else 2 end) * pow(greatest(0.0, cos({a} + (most - {a}) * i / {400})), df - 1)))"
S_CAN = f"""{S_EV}, ar as (select *, case when ('0x' || substr(md5(event_id::varchar), 1, 6))::bigint / pow(16.0, 6) < 0.3 then 'treatment' else 'control' end as arm from ev),
ca as (select pattern, avg(success::int) filter (arm = 'control') as c, avg(success::int) filter (arm = 'treatment') as t, count(*) filter (arm = 'control') as n_control, count(*) filter (arm = 'treatment') as n_treatment,
  var_samp(success::int) filter (arm = 'control') / count(*) filter (arm = 'control') as va, var_samp(success::int) filter (arm = 'treatment') / count(*) filter (arm = 'treatment') as vb from ar group by pattern having n_control >= 10 and n_treatment >= 10),
cd as (select *, (va + vb) * (va + vb) / (va * va / (n_control - 1) + vb * vb / (n_treatment - 1)) as df from ca),
ce as (select *, least(pi() / 2, 12 / sqrt(df)) as most from cd), cf as (select *, least(atan(abs(t - c) / sqrt(va + vb) / sqrt(df)), most) as lo from ce),
cp as (select *, case when va + vb > 0 then (most - lo) * {S_SIMPSON('lo')} / (most * {S_SIMPSON('0.0::double')}) when t <> c then 0.0 else 'nan'::double end as p from cf),
cr as (select *, case when p < 0.05 then case when t > c then 'promote' else 'rollback' end else 'inconclusive' end as recommendation from cp)"""


@query("agg9_canaries", f"with {S_CAN} select pattern, round(c, 4) as control_sr, round(t, 4) as treatment_sr, case when isnan(p) then p else round(p, 4) end as p_value, coalesce(p < 0.05, false) as significant, recommendation, n_control, n_treatment from cr")
def _(t):
    c = learning.canaries(executions(t), "event_id", learning.Canary(fraction=0.3))
    return c.select("pattern", "control_sr", "treatment_sr", "p_value", "significant", "recommendation", "n_control", "n_treatment")


@query("agg10_proposals", f"""with {S_MET}, {S_CAN.replace(S_EV + ', ', '')}, u as (select 0 as o, 'metrics' as source, pattern, recommend as action from mr where recommend in ('PROMOTE', 'DEMOTE', 'REMOVE') and pattern <> 1
  union all select 1, 'canary', pattern, case recommendation when 'promote' then 'PROMOTE' else 'ROLLBACK' end from cr where recommendation <> 'inconclusive') select source, pattern, action, row_number() over (order by o, pattern)::int as rank from u order by o, pattern limit 10""")
def _(t):
    e = executions(t)
    return learning.proposals(learning.metrics(e), learning.canaries(e, "event_id", learning.Canary(fraction=0.3)), [1])


@query("agg11_summaries", f"with {S_MET} select pattern, round(sr, 4) as success_rate, recommend from mr")
def _(t):
    return learning.summaries(executions(t)).select("pattern", "success_rate", "recommend")


S_BRK = f"""{S_EV}, o as (select pattern, success, tm, row_number() over (partition by pattern order by tm, event_id) as i from ev), r(pattern, i, state, fails, oks, opened, opens) as (
  select distinct pattern, 0::bigint, 'CLOSED', 0, 0, 0.0::double, 0 from o union all
  select pattern, i, case when success and st = 'HALF_OPEN' and (case when st = 'OPEN' then ok0 else ok0 + 1 end) >= 3 then 'CLOSED' when not success and st <> 'OPEN' and fails + 1 >= 2 then 'OPEN' else st end, case when success then 0 else fails + 1 end,
    case when success then case when st = 'OPEN' then ok0 else ok0 + 1 end else 0 end, case when not success and st <> 'OPEN' and fails + 1 >= 2 then tm else opened end, opens + (not success and st <> 'OPEN' and fails + 1 >= 2)::int
  from (select r.pattern, o.i, o.success, o.tm, r.fails, r.opened, r.opens, case when r.state = 'OPEN' and o.tm - r.opened >= 100000 then 'HALF_OPEN' else r.state end as st, case when r.state = 'OPEN' and o.tm - r.opened >= 100000 then 0 else r.oks end as ok0 from r join o on o.pattern = r.pattern and o.i = r.i + 1))"""


@query("str2_breaker", f"with recursive {S_BRK} select pattern, state, fails as consec_failures, oks as consec_successes, opens from r join (select pattern as p, max(i) as n from o group by pattern) on p = pattern and n = i")
def _(t):
    return learning.breaker_runs(executions(t), cfg=learning.Breaker(failures=2, cooldown=100_000))


@query("str5_cycle", f"""with {S_MET}, {S_CAN.replace(S_EV + ', ', '')}, u as (select 0 as o, 'metrics' as source, pattern, recommend as action from mr where recommend in ('PROMOTE', 'DEMOTE', 'REMOVE')
  union all select 1, 'canary', pattern, case recommendation when 'promote' then 'PROMOTE' else 'ROLLBACK' end from cr where recommendation <> 'inconclusive') select source, pattern, action, 'applied' as status from u order by o, pattern limit 10""")
def _(t):
    e = executions(t)
    found = learning.proposals(learning.metrics(e), learning.canaries(e, "event_id", learning.Canary(fraction=0.3)))
    return learning.apply_proposals(found, "full").select("source", "pattern", "action", "status")


# ---- sources and sinks

@query("src7_first_pair", "select conv_id, arg_min(text, turn) filter (role = 'user') as question, arg_min(text, turn) filter (role = 'assistant') as answer from conversations group by conv_id having question is not null or answer is not null")
def _(t):
    rows = F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))))
    talks = t("conversations").groupBy("conv_id").agg(F.to_json(F.struct(F.transform(rows, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("conversations"))).alias("value"))
    blank = lambda c: F.when(F.col(c) != "", F.col(c)).alias(c)
    return readers.normalised_training(talks).select("conv_id", blank("question"), blank("answer"))


@query("snk2_alpaca", f"with {S_QA} select seq, question as instruction, '' as input, answer as output from qa")
def _(t):
    return pairs(t).select("seq", *sinks.alpaca())


@query("snk2_sharegpt", f"with {S_QA} select seq, 'user' as r1, question as c1, 'assistant' as r2, answer as c2 from qa")
def _(t):
    c = pairs(t).select("seq", sinks.sharegpt())
    at = lambda i, f, n: F.col("conversations")[i][f].alias(n)
    return c.select("seq", at(0, "role", "r1"), at(0, "content", "c1"), at(1, "role", "r2"), at(1, "content", "c2"))


def talks(t) -> DataFrame:
    rows = F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))))
    return t("conversations").groupBy("conv_id").agg(F.transform(rows, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("conversations"))


@query("snk12_from_scratch", """with r as (select *, row_number() over (partition by conv_id order by turn) as n from conversations), c as (select conv_id, max(text) filter (n = 1) as q, max(role) filter (n = 1) as r1, max(text) filter (n = 2) as a, max(role) filter (n = 2) as r2, count(*) as k from r group by conv_id)
select conv_id, 'Question: ' || trim(q) || ' Answer: ' || trim(a) as line from c where k >= 2 and r1 = 'user' and r2 = 'assistant' and trim(q) <> '' and trim(a) <> ''""")
def _(t):
    return talks(t).select("conv_id", sinks.from_scratch(F.col("conversations")).alias("line")).where("line is not null")


@query("fmt_training_messages", "select conv_id, md5(string_agg(case when role = 'user' then 'user' else 'assistant' end || ':' || text, chr(10) order by turn)) as md5 from conversations group by conv_id")
def _(t):
    c = talks(t).select("conv_id", sinks.training_text(F.col("conversations")).alias("m"))
    return c.select("conv_id", F.md5(F.array_join(F.transform("m", lambda x: F.concat_ws(":", x["role"], x["content"])), "\n")).alias("md5"))


@query("snk7_export_approved", f"with {S_LOG} select question, answer from log where approved")
def _(t):
    c = lambda i: F.col("conversations")[i]["content"]
    return sinks.approved_rows(log(t)).select(c(0).alias("question"), c(1).alias("answer"))


@query("snk8_upsert_latest", "select o_custkey, max_by(o_orderkey, (o_orderdate, o_orderkey)) as o_orderkey from orders group by o_custkey")
def _(t):
    o = t("orders").select("o_custkey", "o_orderkey", F.concat_ws("/", F.col("o_orderdate").cast("string"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("at"))
    return sinks.upsert(o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 2 = 1"), "o_custkey", "at").select("o_custkey", "o_orderkey")


@query("snk9_delete", "select c_custkey from customer where c_custkey not in (select o_custkey from orders)")
def _(t):
    return sinks.delete(t("customer"), t("orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey").select("c_custkey")


@query("agg3_library_stats", "select source as category, count(*) as n from documents group by source")
def _(t):
    index = t("documents").select(F.col("source").alias("category"), F.lit(1).alias("qa_count"))
    return sinks.library_stats(index)[1]


@query("agg13_size_buckets", "select case when n_chars < 50 then '<50' when n_chars < 200 then '<200' when n_chars < 1000 then '<1000' else '>=1000' end as bucket, count(*) as n, sum(n_chars)::bigint as chars from documents group by bucket")
def _(t):
    return curation.size_classes(t("documents"))


S_LINES = "ln as (select event_id, '{''loss'': ' || round(value, 2)::varchar || '} step: ' || event_id as value from events)"


@query("str13_log_metrics", "select event_id, event_id as step, round(value, 2)::double as loss from events")
def _(t):
    lines = t("events").select("event_id", F.concat(F.lit("{'loss': "), F.format_string("%.2f", F.round("value", 2)), F.lit("} step: "), F.col("event_id").cast("string")).alias("value"))
    return readers.log_metrics(lines).select("event_id", "step", F.round("loss", 2).alias("loss"))


@query("agg14_loss_summary", """with g as (select user_id as run, arg_min(value, event_id) as first_loss, arg_max(value, event_id) as last_loss, min(value) as best_loss, arg_max(value / 100, event_id) filter (event_type = 'view' or event_type = 'error') as last_eval_loss from events group by user_id),
q as (select *, coalesce(last_eval_loss, last_loss) as main, case when first_loss > 0 then (first_loss - last_loss) / first_loss * 100 end as fell from g)
select run, first_loss, last_loss, best_loss, last_eval_loss, case when last_loss is null then '' when main < 1.2 and coalesce(fell > 40, true) then 'Excellent' when main < 1.8 and coalesce(fell > 25, true) then 'Good' when main < 2.2 and coalesce(fell > 10, true) then 'Okay' when main < 2.8 then 'Fair' else 'Poor' end as quality from q""")
def _(t):
    measured = F.when(F.col("event_type").isin("view", "error"), F.col("value") / 100)
    return learning.loss_runs(t("events").select(F.col("user_id").alias("run"), F.col("event_id").alias("step"), F.col("value").alias("loss"), measured.alias("eval_loss")))


@query("agg14_best_step", "select arg_min(value, event_id) as first_loss, arg_max(value, event_id) as last_loss, min(value) as best_loss, arg_min(event_id, (value, event_id)) as best_step from events")
def _(t):
    return learning.loss_summary(t("events").select(F.col("event_id").alias("step"), F.col("value").alias("loss")))


@query("flt13_last_lines", "select event_id from events where event_type = 'error' order by event_id desc limit 15")
def _(t):
    return readers.last_matching(t("events"), "(?i)error", 15, "event_id", "event_type").select("event_id")


@query("ord10_systematic_sample", "select doc_id from documents, (select greatest(count(*) // 15, 1) as step from documents) where doc_id % step = 0")
def _(t):
    return curation.systematic_sample(t("documents").select("doc_id"), 15, "doc_id")


@query("set1_union_sources", "select 'documents' as origin, count(*) as n from documents union all select 'conversations', count(*) from conversations union all select 'pages', count(*) from pages")
def _(t):
    return sinks.union_sources(**{n: t(n) for n in ("documents", "conversations", "pages")}).groupBy("origin").agg(F.count("*").alias("n"))


@query("set3_token_sets", f"with {S_QA}, s as (select seq, list_distinct({s_tokens('question', '[a-z]{3,}')}) as a, list_distinct({s_tokens('answer', '[a-z]{3,}')}) as b from qa) select seq, len(list_intersect(a, b))::int as common, len(list_distinct(list_concat(a, b)))::int as total, (len(a) - len(list_intersect(a, b)))::int as only_question from s")
def _(t):
    return pairs(t).select("seq", curation.token_overlap(F.col("question"), F.col("answer")).alias("o")).select("seq", "o.common", "o.total", F.col("o.only_first").alias("only_question"))


def _again(df: DataFrame, name: str, write: Callable[[DataFrame, str], None]) -> str:
    """Write df under the shared scratch folder; the path."""
    path = scratch_path(df.sparkSession, name)
    write(df, path)
    return path


@query("src1_csv", f"with {S_QA} select {s_strip('question')} as question, {s_strip('answer')} as answer from qa where {s_strip('question')} <> '' and {s_strip('answer')} <> ''")
def _(t):
    p = pairs(t).select(F.concat(F.lit("  "), "question").alias("Question"), F.col("answer").alias("Answer"))
    return readers.read_csv(p.sparkSession, _again(p, "csv", lambda d, at: d.write.csv(at, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)))["qa"]


@query("src2_yaml_patterns", "select r_name as name, 'Entries of ' || r_name || '.' as description, 2::int as uses, 1::int as parameters from region")
def _(t):
    d = t("region")
    y = F.format_string("name: %s\ndescription: Entries of %s.\nuse_cases: [first, second]\nparameters: [{name: size, description: how big, example: 3}]\nbest_practices: {do: it}", "r_name", "r_name")
    path = _again(d.select(y.alias("value")).repartition(5, "value"), "yaml", lambda x, at: x.write.option("maxRecordsPerFile", 1).text(at))
    got = readers.read_yaml(d.sparkSession, path, readers._named, patterns.PATTERN, recursive=True, glob="*.txt")
    return got.select("name", "description", F.size("use_cases").alias("uses"), F.size("parameters").alias("parameters"))


@query("src4_vocabularies", "select r_name as name, 'general' as domain, 'One of ' || r_name || '.' as description, 'first' as first_example from region")
def _(t):
    d = t("region")
    y = F.format_string("metadata: {version: 1}\ntopics:\n  - {name: %s, description: One of %s., examples: [{description: first}, {description: second}]}\n  - {title: nameless}", "r_name", "r_name")
    path = _again(d.select(y.alias("value")).repartition(5, "value"), "yaml", lambda x, at: x.write.option("maxRecordsPerFile", 1).text(at))
    return readers.read_yaml(d.sparkSession, path, readers.vocabulary_records, patterns.ENTRY, glob="*.txt").select("name", "domain", "description", "first_example")


@query("src6_interaction_log", f"with {S_LOG} select id, question, approved from log")
def _(t):
    rows = log(t).drop("seq")
    bad = rows.sparkSession.createDataFrame([("",), ("not json",)], "value string")
    path = _again(rows.select(F.to_json(F.struct("*")).alias("value")).unionByName(bad), "log", lambda d, at: d.write.text(at))
    return readers.read_interactions(rows.sparkSession, path).select("id", "question", "approved")


@query("src12_long_term", f"with {S_REL} select id, relevance, frequency, 'long_term' as tier from v where relevance >= 0.5")
def _(t):
    rows = sinks.long_term_records(memory.relevance(log(t)).where("relevance >= 0.5"))
    return readers.read_long_term(rows.sparkSession, _again(rows, "long-term", sinks.append_records)).select("id", "relevance", F.col("score_detail")["frequency"].alias("frequency"), "tier")


@query("src14_training_rows", "select string_agg(case when role = 'user' then 'user' else 'assistant' end || ': ' || text, chr(10) order by turn) as text from conversations group by conv_id")
def _(t):
    return readers.training_rows(talks(t))


@query("snk1_jsonl", f"with {S_QA} select question, answer from qa")
def _(t):
    p = pairs(t).select("seq", F.col("question").alias("instruction"), F.col("answer").alias("output"))
    path = _again(p, "jsonl", lambda d, at: sinks.write_jsonl(d, at, order=["seq"]))
    return readers.read_training(p.sparkSession, path)


@query("snk3_training_files", f"""with {S_QA}, n as (select count(*) as n from qa), v as (select n, greatest(1, floor(n * 0.15)) as v from n), s as (select 'train' as split, n - v as n from v union all select 'val', v from v)
select format, split, n::bigint as n from s, (values ('alpaca'), ('sharegpt')) as f(format)""")
def _(t):
    p = curation.split_train_val(pairs(t).select("seq", "question", "answer"), ["seq"])
    spark = p.sparkSession
    path = _again(p, "training", sinks.write_training)
    rows = [spark.read.option("basePath", f"{path}/{f}").json(f"{path}/{f}").groupBy("split").agg(F.count("*").alias("n")).select(F.lit(f).alias("format"), "split", "n") for f in ("alpaca", "sharegpt")]
    return rows[0].unionByName(rows[1])


@query("snk5_log_interaction", f"with {S_QA} select {s_strip('question')} as question, true as pending, 32::int as id_length from qa")
def _(t):
    d = pairs(t).withColumns({"session_id": F.lit("s"), "model_name": F.lit(""), "kb_context_used": F.lit(False)})
    return memory.new_records(d).select("question", F.col("approved").isNull().alias("pending"), F.length("id").alias("id_length"))


@query("snk11_demonstrations", f"with {S_SC}, c as (select *, {S_CONF} as confidence from j) select question as instruction, answer as output from c where confidence >= 0.5 order by confidence desc, seq limit 10")
def _(t):
    return curation.top_demonstrations(judged(t), 10, 0.5).select(*sinks.alpaca()).select("instruction", "output")


@query("snk13_concat_jsonl", "select role || ' ' || conv_id as value from conversations where role = 'user' union all select role || ' ' || conv_id from conversations where role = 'assistant'")
def _(t):
    line = t("conversations").select("role", F.concat_ws(" ", "role", F.col("conv_id").cast("string")).alias("value"))
    blank = line.sparkSession.createDataFrame([("",)], "value string")
    return sinks.concat_jsonl(line.where("role = 'user'").select("value"), blank, line.where("role = 'assistant'").select("value"))


@query("snk14_carve_validation", S_SPLIT)
def _(t):
    return sinks.carve_validation(t("documents").select("doc_id"), None, ["doc_id"])


@query("flt9_approved", f"with {S_LOG} select seq from log where approved and trim(question) <> '' and trim(answer) <> ''")
def _(t):
    return memory.usable(log(t)).select("seq")


@query("flt10_harm_refusal", f"select doc_id, regexp_matches(text, $q${curation.HARM}$q$) as harm, regexp_matches(text, $q${curation.REFUSAL}$q$) as refusal from documents")
def _(t):
    return t("documents").select("doc_id", F.col("text").rlike(curation.HARM).alias("harm"), F.col("text").rlike(curation.REFUSAL).alias("refusal"))


@query("flt11_named_pattern", r"select doc_id, list_filter(regexp_extract_all(text, '(?i)the ([a-z]+)', 1), lambda x: len(x) > 2 and not regexp_matches(x, '(?i)(?:th|on)$'))[1] as name from documents")
def _(t):
    named = Domain(function_pattern="the ([a-z]+)", non_function_suffixes=("th", "on"))
    return t("documents").select("doc_id", named.named(F.col("text")).alias("name"))


S_TALKS = (
    ("What is {fn}?", "{desc}", "What are the use cases for {fn}?", "{nl}- shipping goods{nl}- counting orders", "Can you show me the syntax for {fn}?", "show it:{nl}{nl}visit {fn}"),
    ("My {fn} example did not produce the expected outcome. How do I debug it?", "When {fn} fails or looks wrong, check inputs, required parameters, and common pitfalls first.{nl}{nl}Description of {fn}: {desc}", "Can you show me a diagnostic example I can start with?", "Start with this template and verify each step:{nl}{nl}visit {fn}"),
    ("How do I use {fn} more efficiently?", "Efficiency for {fn} depends on scope, data quality, and following recommended practices. {desc}", "Are there any hard limits or restrictions I should know about?", "{nl}- no exports"),
    ("We currently handle this manually with ad hoc steps. Should we adopt {fn}?", "{fn} provides a structured approach that can replace inconsistent manual workflows. {desc}", "What does a basic {fn} example look like?", "visit {fn}", "Are there related functions I should also know about?", "Related patterns to consider alongside {fn}: {rel}"),
)
_NATION = {"fn": "n_name", "desc": "'A nation of ' || r_name || '. It trades with many others.'", "rel": "r_name", "nl": "chr(10)"}


@query("gen6_pattern_conversations", " union all ".join(f"select n_name as name, {s_filled('|'.join(('user', 'assistant')[i % 2] + ':' + x for i, x in enumerate(talk)), _NATION)} as talk from nation join region on n_regionkey = r_regionkey" for talk in S_TALKS))
def _(t):
    talks = library(t).select("name", F.explode(patterns.pattern_conversations()).alias("c"))
    return talks.select("name", F.array_join(F.transform("c", lambda m: F.concat_ws(":", m["role"], m["content"])), "|").alias("talk"))


@query("gen12_vocabulary_conversations", f"select 'user: ' || question || ' assistant: ' || answer as talk from ({s_vocabulary()})")
def _(t):
    return vocabulary(t).select(sinks.sharegpt()).select(F.array_join(F.transform("conversations", lambda m: F.concat(m["role"], F.lit(": "), m["content"])), " ").alias("talk"))


def library(t) -> DataFrame:
    n = nations(t)
    p = n.withColumns({f: F.lit(None).cast("string") for f in ("title", "pattern_alias", "source_file")}).withColumn("use_cases", F.array(F.lit("shipping goods"), F.lit("counting orders")))
    p = p.withColumn("related_patterns", F.array("category")).withColumn("guardrails", F.array(F.lit("no exports")))
    p = p.withColumn("templates", F.array(F.struct(F.lit("basic").alias("key"), F.lit("show it").alias("description"), F.concat(F.lit("visit "), "name").alias("content"), F.array().cast("array<string>").alias("required_parameters"))))
    for c, kind in patterns.PATTERN_TYPES.items():
        p = p if c in p.columns else p.withColumn(c, F.lit(None).cast(kind))
    return p


def forms(t) -> DataFrame:
    f = {"title": F.concat(F.lit("About "), "name"), "use_cases_text": F.lit("- first use\n* second use\nno"), "parameters_text": F.lit("level: how much (10)\nbad"), "worked_example": F.concat(F.lit("see "), "name"), "example_summary": F.lit(""), "example_output": F.lit("seen"), "common_errors_text": F.lit("Lost: ask a friend"), "best_practices": F.lit("Be polite.")}
    return nations(t).withColumns(f)


@query("gen15_form_to_pattern", "select lower('about_' || replace(n_name, ' ', '_')) as name, 'About ' || n_name as title, 2::int as uses, 'level' as parameter, '10' as example, 'Lost' as error from nation")
def _(t):
    p = patterns.form_to_pattern(forms(t))
    return p.select("name", "title", F.size("use_cases").alias("uses"), F.col("parameters")[0]["name"].alias("parameter"), F.col("parameters")[0]["example"].alias("example"), F.col("common_errors")[0]["error"].alias("error"))


@query("gen16_pattern_to_form", "select 'About ' || n_name as title, 'first use' || chr(10) || 'second use' as use_cases_text, 'level: how much (10)' as parameters_text, 'see ' || n_name as worked_example, 'seen' as example_output, 'Lost: ask a friend' as common_errors_text, 'Be polite.' as best_practices from nation")
def _(t):
    return patterns.pattern_to_form(patterns.form_to_pattern(forms(t))).select("title", "use_cases_text", "parameters_text", "worked_example", "example_output", "common_errors_text", "best_practices")


S_BLOCKS = f"""e as (select n_nationkey, n_name, r_name, {_NATION['desc']} as d from nation join region on n_regionkey = r_regionkey),
b as (select *, lower(n_name || ' ' || r_name || ' ' || d || ' shipping goods counting orders') as body, '### ' || n_name || chr(10) || 'A nation of ' || r_name || '.' || chr(10) || 'It trades with many others.' || chr(10) || 'Use cases: shipping goods; counting orders' || chr(10) || 'Worked example:' || chr(10) || 'visit ' || n_name as block from e)"""


@query("ret4_contexts", f"""with {S_BLOCKS}, q as (select n_nationkey as query_id, {s_tokens("'What is ' || n_name || '?'", retrieval.TOKEN)} as all_terms from nation), k as (select query_id, list_filter(all_terms, lambda x: len(x) > 2 and not list_contains({s_list(retrieval.KEYWORD_STOP)}, x)) as ts from q),
p as (select query_id, n_nationkey as seq, block, list_sum(list_transform(ts, lambda x: case when x = lower(n_name) then 10 when contains(lower(n_name), x) then 5 when contains(body, x) then 1 else 0 end)) as score from k cross join b where len(ts) > 0),
r as (select *, row_number() over (partition by query_id order by score desc, seq) as rank from p) select query_id, md5({s_filled(retrieval.KEYWORD_HEADER, {})} || string_agg(block, chr(10) || chr(10) || '---' || chr(10) || chr(10) order by rank)) as md5 from r where rank <= 2 and score >= 3 group by query_id""")
def _(t):
    lib = library(t).withColumn("seq", F.col("entry").cast("long"))
    q = t("nation").select(F.col("n_nationkey").alias("query_id"), F.concat(F.lit("What is "), "n_name", F.lit("?")).alias("question"))
    found = retrieval.keyword_search(q, lib.select("seq", "name", F.coalesce("title", "name").alias("title"), retrieval.searchable(lib).alias("body")))
    best = found.join(lib.drop("entry"), "seq").withColumn("block", retrieval.context_block())
    return retrieval.contexts(best, "query_id").select("query_id", F.md5("context").alias("md5"))


@query("tfi7_contexts", f"""with {S_BLOCKS}, x as (select n_nationkey as doc_id, n_name || ' ' || r_name || ' ' || d || ' shipping goods counting orders ' || r_name || ' no exports visit ' || n_name as text from e),
{S_TF.replace('from documents', 'from x')}, dw as (select doc_id, term, c / n * idf as w from tc join f using (term)), q as (select n_nationkey as item_id, {S_TT("'What is ' || n_name || '?'")} as t from nation), qc as (select item_id, len(t) as n, unnest(t) as term from q),
qt as (select item_id, term, any_value(n) as n, count(*) as c from qc group by item_id, term), qw as (select item_id, qt.term, c / n * coalesce(idf, ln(nd + 1.0) + 1.0) as w from qt left join f on f.term = qt.term, nd),
dn as (select doc_id, sqrt(sum(w * w)) as dn from dw group by doc_id), qn as (select item_id, sqrt(sum(w * w)) as qn from qw group by item_id), s as (select item_id, doc_id, sum(qw.w * dw.w) as dot from qw join dw on qw.term = dw.term group by item_id, doc_id),
r as (select item_id, doc_id, round(dot / (dn * qn), 4) as score from s join dn using (doc_id) join qn using (item_id)), k as (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from r),
o as (select item_id, rank, '### ' || n_name || '  (similarity: ' || printf('%.2f', score) || ')' || chr(10) || d || chr(10) || 'Use cases: shipping goods; counting orders' || chr(10) || 'Example:' || chr(10) || '```' || chr(10) || 'visit ' || n_name || chr(10) || '```' as block from k join e on n_nationkey = doc_id where rank <= 3 and score >= 0.05)
select item_id as query_id, md5({s_filled(retrieval.SIMILARITY_HEADER, {})} || string_agg(block, chr(10) || chr(10) || '---' || chr(10) || chr(10) order by rank)) as md5 from o group by item_id""")
def _(t):
    lib = library(t).withColumn("seq", F.col("entry").cast("long"))
    docs = lib.select("seq", retrieval.pattern_text(lib).alias("text"))
    q = t("nation").select(F.col("n_nationkey").alias("query_id"), F.concat(F.lit("What is "), "n_name", F.lit("?")).alias("query"))
    hits = retrieval.tfidf_search(q, docs, "query_id", "query", "seq", "text").join(lib, "seq").withColumn("block", retrieval.context_block(F.col("score")))
    return retrieval.contexts(hits, "query_id", retrieval.SIMILARITY_HEADER).select("query_id", F.md5("context").alias("md5"))


@query("msc2_candidate_pairs", f"with {S_QA} select seq, case when seq % 2 = 0 then {s_strip('question')} else 'asked' end as q, {s_strip('answer')} as a from qa")
def _(t):
    c = pairs(t).select("seq", F.when(F.col("seq") % 2 == 0, F.col("question")).otherwise("").alias("question"), F.lit(" asked ").alias("instruction"), F.col("answer").alias("output"))
    q, a = curation.candidate_pair(c)
    return c.select("seq", q.alias("q"), a.alias("a"))


@query("msc4_tier", f"with {S_REL} select seq from v where seq % 2 = 0 and relevance < 0.4")
def _(t):
    return tiers(t).where("tier = 'short_term'").select("seq")


@query("msc5_approve", f"""with {S_MET}, u as (select pattern, recommend as action, row_number() over (order by pattern)::int as rank from mr where recommend in ('PROMOTE', 'DEMOTE', 'REMOVE') qualify rank <= 10)
select pattern, action, rank, case when rank = 1 then 'approved' else 'pending' end as status from u""")
def _(t):
    found = learning.metrics(executions(t))
    p = learning.apply_proposals(learning.proposals(found, learning.canaries(executions(t), "event_id").limit(0)), "human_approval")
    first = p.where("rank = 1").select(F.col("pattern").alias("_p"))  # one row
    return learning.approve(p.crossJoin(F.broadcast(first)), F.col("_p")).select("pattern", "action", "rank", "status")


@query("msc6_history", f"""with {S_MET}, u as (select pattern, recommend as action, row_number() over (order by pattern)::int as rank from mr where recommend in ('PROMOTE', 'DEMOTE', 'REMOVE') qualify rank <= 10)
select 'history' as place, pattern, rank from u where rank = 1 union all select 'pending', pattern, rank from u where rank > 1""")
def _(t):
    p = learning.apply_proposals(learning.proposals(learning.metrics(executions(t)), learning.canaries(executions(t), "event_id").limit(0)), "human_approval")
    done = learning.approve(p.crossJoin(F.broadcast(p.where("rank = 1").select(F.col("pattern").alias("_p")))), F.col("_p"))
    row = lambda df, name: df.select(F.lit(name).alias("place"), "pattern", "rank")
    return row(learning.history(done), "history").unionByName(row(learning.pending(done), "pending"))


@query("msc10_frequent_view", f"with {S_KEYQ} select key, count(*) as n, max_by(question, (timestamp, seq)) as question from k group by key having count(*) >= 2 order by n desc, max(seq) desc limit 20")
def _(t):
    return memory.frequent_questions(log(t)).limit(20).select("key", "n", "question")


@query("msc11_approval_gate", "select count(*) > 0 as ready from documents")
def _(t):
    return curation.ready(t("documents"))


# ---- files, streams, listings

@query("src3_library", "select r_name as name, 2::int as uses from region where r_regionkey % 2 = 0")
def _(t):
    """A flat folder: files of its sub-folders aren't entries."""
    d = t("region")
    y = F.when(F.col("r_regionkey") % 2 == 0, F.format_string("name: %s\nuse_cases: [first, second]", "r_name")).otherwise("use_cases: [nameless]")
    path = _again(d.select(y.alias("value")).repartition(5, "value"), "library", lambda x, at: x.write.option("maxRecordsPerFile", 1).text(at))
    _write_under(d.select(y.alias("value")), f"{path}/deeper")
    return readers.read_library(d.sparkSession, path, "*.txt").select("name", F.size("use_cases").alias("uses"))


def _write_under(df: DataFrame, path: str) -> None:
    df.write.option("maxRecordsPerFile", 1).text(path)


S_PAPER = "select n_nationkey as k, case when n_nationkey % 3 = 0 then 'too short' else 'About ' || n_name || chr(10) || 'It is one of many nations that trade with each other.' || chr(10) || 'Goods go by ship, by train and by truck; orders come in every day of the year.' end as body from nation"


def _page_texts(content: bytes) -> list[str]:
    return content.decode().strip().split("\f")


def _no_odd(content: bytes) -> list[str]:
    if b"key 1" in content:
        raise ValueError("damaged")
    return _page_texts(content)


@query("src8_parser_chain", f"with p as ({S_PAPER}) select case when k % 3 = 0 or k % 2 = 1 then 'recognised' else 'standard' end as method, 2::int as num_pages, md5('key ' || k % 2 || chr(10) || chr(10) || body) as md5 from p")
def _(t):
    n = F.col("n_nationkey")
    body = F.when(n % 3 == 0, "too short").otherwise(F.concat(F.lit("About "), "n_name", F.lit("\nIt is one of many nations that trade with each other.\nGoods go by ship, by train and by truck; orders come in every day of the year.")))
    paper = t("nation").select(F.concat(F.lit("key "), (n % 2).cast("string"), F.lit("\f"), body).alias("value"), n.alias("n"))
    path = _again(paper.repartition(25, "n").select("value"), "papers", lambda d, at: d.write.option("maxRecordsPerFile", 1).text(at))
    got = readers.read_documents(paper.sparkSession, path, [("standard", _no_odd), ("recognised", _page_texts)], "*.txt")
    return got.select("method", "num_pages", F.md5("full_text").alias("md5"))


@query("src11_document_folder", f"with p as ({S_PAPER}) select count(*) as n from p where k % 3 <> 0 and k % 2 = 0")
def _(t):
    """With one parser that is a recognition and fails on half of the files: failed documents have no text and go."""
    n = F.col("n_nationkey")
    paper = t("nation").where(n % 3 != 0).select(F.concat(F.lit("key "), (n % 2).cast("string"), F.lit("\f"), F.lit("text")).alias("value"), n.alias("n"))
    path = _again(paper.repartition(25, "n").select("value"), "papers", lambda d, at: d.write.option("maxRecordsPerFile", 1).text(at))
    return readers.read_document_folder(paper.sparkSession, path, [("only", _no_odd)], "*.txt").agg(F.count("*").alias("n"))


@query("src13_config", "select * from (values ('chunk_overlap', '150'), ('chunk_size', '800'), ('seed', '7'), ('val_ratio', '0.15')) as t(key, value)")
def _(t):
    from loomline.functions.config import load_config, merged

    prep = merged(load_config()["data_prep"], seed=7, chunk_size=None)
    return t("region").sparkSession.createDataFrame([(k, str(v)) for k, v in prep.items()], "key string, value string")


@query("src15_follow_lines", "select event_type || ' ' || event_id as value from events")
def _(t):
    lines = t("events").select(F.concat_ws(" ", "event_type", F.col("event_id").cast("string")).alias("value"))
    spark, path, out = lines.sparkSession, _again(lines, "lines", lambda d, at: d.write.text(at)), scratch_path(lines.sparkSession, "followed")
    stream = readers.follow_lines(spark, path).writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-state").trigger(availableNow=True).start()
    stream.awaitTermination()
    return spark.read.schema("value string").parquet(out)


@query("str1_interaction_log", f"with {S_LOG} select id, question, approved from log")
def _(t):
    rows = log(t).drop("seq")
    spark = rows.sparkSession
    path, out = _again(rows.select(F.to_json(F.struct("*")).alias("value")), "log", lambda d, at: d.write.text(at)), scratch_path(spark, "appended")
    jobs.append_log(readers.read_interactions(spark, path, stream=True), out, f"{out}-state").awaitTermination()
    return readers.read_interactions(spark, out).select("id", "question", "approved")


@query("str3_running_metrics", f"with {S_MET} select pattern, total_uses, success_count, round(sr, 4) as success_rate, recommend from mr")
def _(t):
    e = executions(t).select("pattern", "success", "cost_tokens", "latency_ms")
    spark, path = e.sparkSession, _again(e, "executions", lambda d, at: d.write.parquet(at))
    name = f"metrics_{path.rpartition('-')[2]}"
    jobs.running_metrics(spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 4).parquet(path), name, f"{path}-state").awaitTermination()
    return spark.table(name).select("pattern", "total_uses", "success_count", "success_rate", "recommend")


@query("str13_log_phases", """with x as (select user_id as run, event_id as seq, case event_id % 7 when 0 then 'Loading dataset' when 1 then 'Starting training: 10 examples' when 2 then 'Merging LoRA weights' end as said, case when event_id % 7 = 3 then event_id end as step from events)
select run, seq, case coalesce(last_value(said ignore nulls) over w, '') when 'Loading dataset' then 'dataset' when 'Starting training: 10 examples' then 'training' when 'Merging LoRA weights' then 'saving' else 'loading' end as phase, coalesce(last_value(step ignore nulls) over w, 0) as at_step
from x window w as (partition by run order by seq rows between unbounded preceding and current row)""")
def _(t):
    k = F.col("event_id") % 7
    said = F.when(k == 0, "Loading dataset").when(k == 1, "Starting training: 10 examples").when(k == 2, "Merging LoRA weights").when(k == 3, F.concat(F.lit("step: "), F.col("event_id").cast("string"))).otherwise("...")
    return readers.log_phases(t("events").select(F.col("user_id").alias("run"), F.col("event_id").alias("seq"), said.alias("value"))).select("run", "seq", "phase", "at_step")


@query("snk4_by_manual", f"with {S_QA}, k as (select *, row_number() over (order by md5('42' || chr(31) || seq), seq) > count(*) over () - greatest(1, floor(count(*) over () * 0.15)) as val from qa) select 'manual_' || conv_id % 3 as label, case when val then 'val' else 'train' end as split, question as instruction, answer as output from k")
def _(t):
    p = curation.split_train_val(pairs(t), ["seq"]).withColumn("label", F.concat(F.lit("manual_"), (F.col("conv_id") % 3).cast("string")))
    path = _again(p, "manuals", lambda d, at: write({"pairs": d}, at, ("alpaca",), ("label", "split")))
    return p.sparkSession.read.json(f"{path}/alpaca").select("label", "split", "instruction", "output")


@query("snk15_snapshot", f"with {S_QA} select question, answer from qa where conv_id % 2 = 0")
def _(t):
    """A dataset is saved, overwritten, and restored."""
    p = pairs(t)
    spark, path = p.sparkSession, _again(p.where("conv_id % 2 = 0").select("question", "answer"), "dataset", lambda d, at: d.write.parquet(at))
    sinks.snapshot(spark, path, f"{path}-saved")
    p.select("question").write.mode("overwrite").parquet(path)
    sinks.restore(spark, f"{path}-saved", path)
    return spark.read.schema("question string, answer string").parquet(path)


@query("gen14_answers_of_any_shape", "select r_name as name, 'one of ' || r_name || chr(10) || 'two' as description, 'a: b' || chr(10) || 'c: d' as syntax, 'error: e; cause: c' as errors, null as category from region")
def _(t):
    d = t("region")
    y = F.format_string("topics:\n  - name: %s\n    description: [one of %s, two]\n    syntax: {a: b, c: d}\n    common_errors: [{error: e, cause: c}]\n    category: []", "r_name", "r_name")
    path = _again(d.select(y.alias("value")).repartition(5, "value"), "vocabulary", lambda x, at: x.write.option("maxRecordsPerFile", 1).text(at))
    return readers.read_vocabularies(d.sparkSession, path, "*.txt").select("name", "description", "syntax", "errors", "category")


@query("gen18_formatting", "select n_name as name, chr(10) || '- ' || n_name || chr(10) || '- ' || r_name as listed, '**' || n_name || '** (type: nation) (optional) — one of ' || r_name || ' Example: ' || n_nationkey as parameter from nation join region on n_regionkey = r_regionkey")
def _(t):
    n = nations(t)
    p = F.struct(F.col("name"), F.lit("nation").alias("type"), F.lit(False).alias("required"), F.concat(F.lit("one of "), "category").alias("description"), F.col("entry").cast("string").alias("example"), F.lit(None).cast("string").alias("default"))
    return n.select("name", tx.bullets(F.array("name", "category")).alias("listed"), patterns.shown_parameter(p).alias("parameter"))


@query("set2_multiturn_union", f"""with {S_LOG}, m as (select timestamp || '/' || id as k from log where approved and trim(question) <> '' and trim(answer) <> ''), v as (select distinct {S_FP('question || chr(10) || answer')} as fp from ({s_vocabulary()}))
select '0' as part, count(*) as n from v union all select '2', count(*) from m""")
def _(t):
    from loomline.plans.prepare import prepare

    made = prepare(vocabularies=vocabulary_entries(t), memory=log(t))["multiturn"]
    return made.groupBy(F.substring("seq", 1, 1).alias("part")).agg(F.count("*").alias("n"))


@query("jn11_by_id", f"with {S_LOG} select seq, question from log where id = '3'")
def _(t):
    return memory.by_id(log(t), "3").select("seq", "question")


@query("cur3_added_pattern", f"select doc_id, case when regexp_matches(text, '(?i)the\\s+[a-z]{{4}}\\b') then 'article' else {S_BEST} end as name from documents")
def _(t):
    bank = curation.add_pattern(curation.MEDICAL_PATTERNS, curation.ErrorPattern("article", r"the\s+[a-z]{4}\b", 0.99))
    return t("documents").select("doc_id", curation.best_match(F.col("text"), bank)["name"].alias("name"))


@query("cur5_text_keys", S_CUR)
def _(t):
    """The text is found under the first name there is."""
    return curation.curriculum(t("documents").select("doc_id", F.col("text").alias("content"), F.lit("not this").alias("instruction"))).select("doc_id", "confidence")


@query("msc3_alias_questions", "select n_name as name, 'What is Land of ' || n_name || '?' as question, 'A nation of ' || r_name || '. It trades with many others.' as answer from nation join region on n_regionkey = r_regionkey where n_nationkey % 2 = 0")
def _(t):
    alias = F.when(F.col("entry") % 2 == 0, F.concat(F.lit("Land of "), "name")).otherwise(F.lower("name"))  # in other capitals it is no alias
    made = patterns.pattern_qa(library(t).withColumn("pattern_alias", alias), ["name"])
    return made.where(F.col("question").startswith("What is Land of") | (F.col("question") == F.concat(F.lit("What is "), F.lower("name"), F.lit("?")))).select("name", "question", "answer")


@query("msc8_messages", f"""with k as (select conv_id, turn, role, text, {S_TOK('text')} as tokens from conversations), l as (select *, (turn = max(turn) over (partition by conv_id) or sum(tokens) over (partition by conv_id order by turn rows between current row and unbounded following) <= 120) as live from k)
select conv_id, list(role || ':' || text order by turn) as said from l where live group by conv_id""")
def _(t):
    m = memory.messages(t("conversations"), "conv_id", budget=120)
    return m.select("conv_id", F.transform("messages", lambda x: F.concat_ws(":", x["role"], x["content"])).alias("said"))


@query("str12_segment_stats", f"""with k as (select conv_id, turn, {S_TOK('text')} as tokens from conversations where conv_id % 3 <> 0), l as (select *, (turn = max(turn) over (partition by conv_id) or sum(tokens) over (partition by conv_id order by turn rows between current row and unbounded following) <= 120) as live from k)
select conv_id, count(*) as messages, count(*) filter (live) as l1_messages, coalesce(sum(tokens) filter (live), 0)::bigint as l1_tokens, round(coalesce(sum(tokens) filter (live), 0) / 120, 4) as l1_share from l group by conv_id""")
def _(t):
    c = t("conversations")
    kept = memory.cleared(c, c.where("conv_id % 3 = 0"), "conv_id")
    return memory.segment_stats(kept, "conv_id", budgets=memory.Budgets(l1=120))


@query("str11_kernel", f"""with recursive k as (select conv_id, list('turn ' || turn || ': ' || text order by turn) as ls, list(text order by turn) as vs from conversations group by conv_id),
  r(conv_id, i, used, kept) as (select conv_id, 1, 0, []::varchar[] from k union all
    select conv_id, i + 1, (case when used + n <= 60 then used + n else used end)::int, case when used + n <= 60 then list_append(kept, ls[i]) else kept end from (select r.*, ls, {S_TOK("vs[i]")} as n from r join k using (conv_id) where i <= len(ls)))
  select conv_id, case when {S_TOK("array_to_string(ls, chr(10))")} > 60 then array_to_string(kept, chr(10)) else array_to_string(ls, chr(10)) end as kernel from k join r using (conv_id) where i = len(ls) + 1""")
def _(t):
    rows = F.array_sort(F.collect_list(F.struct("turn", F.concat(F.lit("turn "), F.col("turn").cast("string")).alias("key"), F.col("text").alias("value"))))
    k = t("conversations").groupBy("conv_id").agg(F.transform(rows, lambda x: F.struct(x["key"].alias("key"), x["value"].alias("value"))).alias("kv"))
    return k.select("conv_id", memory.kernel(F.col("kv"), 60).alias("kernel"))


@query("agg12_view_types", "with q as (select lower(text) as q from conversations where role = 'user') select case " + " ".join("when " + " or ".join(f"starts_with(q, '{k[1:]}')" if k[0] == "^" else f"contains(q, '{k}')" for k in ks) + f" then '{n}'" for n, ks in pages.QUESTION_TYPES_VIEW) + " end as kind, count(*) as n from q group by kind")
def _(t):
    return t("conversations").where("role = 'user'").groupBy(pages.question_type("text", view=True).alias("kind")).agg(F.count("*").alias("n"))


@query("jdg10_messages", f"with {S_QA} select seq, 'QUESTION: ' || {s_strip('question')} || chr(10) || chr(10) || 'ANSWER: ' || {s_strip('answer')} as asked, 2::int as messages from qa where {s_strip('question')} <> '' and {s_strip('answer')} <> ''")
def _(t):
    m = pairs(t).select("seq", curation.judge_messages(F.col("question"), F.col("answer")).alias("m")).where("m is not null")
    return m.select("seq", F.col("m")[1]["content"].alias("asked"), F.size("m").alias("messages"))


@query("jdg12_backend", f"with {S_SC} select seq, case when contains(answer, 'the') then 0.75::double else quality end as quality, not contains(answer, 'the') as fell_back from j")
def _(t):
    """A backend that answers some chats and fails on others."""
    def complete(chat: list[dict]) -> str:
        if "the" not in chat[1]["content"].partition("ANSWER: ")[2]:
            raise ValueError("no reply")
        return '{"quality": 0.75, "safety": 1, "cost": 1, "domain": 1, "performance": 1, "usability": 1}'

    j = curation.model_judged(pairs(t), curation.local_backend(complete), keywords=KEYWORDS)
    return j.select("seq", "quality", F.array_contains("flags", "heuristic_fallback").alias("fell_back"))


@query("ret5_cached_index", ORACLES["tfi5_search"])
def _(t):
    docs = t("documents").select("doc_id", "text")
    index = retrieval.TfidfIndex.build(docs, scratch_path(docs.sparkSession, "tfidf"), "doc_id", "text")
    index.reload()
    return index.search(t("benchmark").select("item_id", F.col("text").alias("query")), "item_id", "query")


@query("msc12_first_training_file", "select 'role=assistant' as folder")
def _(t):
    c = t("conversations").select("role", "text")
    path = _again(c, "files", lambda d, at: d.coalesce(1).write.partitionBy("role").text(at))
    found = readers.first_training_file(c.sparkSession, path, "part-*.txt")
    return c.sparkSession.createDataFrame([(found.split("/")[-2],)], "folder string")


@query("msc13_artifacts", "select 'role=' || role as artifact, true as filled, null as metadata from conversations group by role")
def _(t):
    c = t("conversations").select("role", "text")
    path = _again(c, "artifacts", lambda d, at: d.write.partitionBy("role").text(at))
    return readers.artifacts(c.sparkSession, path).select("artifact", (F.col("bytes") > 0).alias("filled"), F.col("metadata").cast("string").alias("metadata"))


@query("msc14_uploads", "select count(distinct r_name) as n from region")
def _(t):
    r = t("region").select("r_name")
    path = _again(r.repartition(5, "r_name"), "uploads", lambda d, at: d.write.option("maxRecordsPerFile", 1).csv(at))
    r.coalesce(1).write.mode("append").text(path)
    return readers.uploads(r.sparkSession, path).agg(F.count("*").alias("n"))


# ---- flagship

@query("flagship_prepare", f"""with recursive {s_generated(150)},
u as (select distinct source, {S_FP('question || chr(10) || answer')} as fp from g), n as (select count(*) as n from u)
select 'train' as split, (n - greatest(1, floor(n * 0.15)))::bigint as n from n union all select 'val', greatest(1, floor(n * 0.15))::bigint from n""")
def _(t):
    p = document_pairs(t("documents"), size=800, overlap=150, separator="\n+", domain=DOMAIN)
    kept = curation.dedup_first(p, within=["source"], order=["doc", "chunk", "part"])
    return curation.split_train_val(kept, ["doc", "chunk", "part"]).groupBy("split").agg(F.count("*").alias("n"))


from loomline.plans import stateful  # noqa: E402, F401  registers the rest
