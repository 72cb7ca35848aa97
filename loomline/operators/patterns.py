"""Knowledge patterns and vocabularies: questions and conversations from structured entries, and the form that captures them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.functions.config import Domain
from loomline.functions.questions import QUESTIONS
from loomline.functions.text import bullets, first_nonempty, first_sentence, nonempty, strip
from loomline.operators.qa import asked, expand, fact, only, template_table

PATTERN = (
    "name string, title string, description string, category string, pattern_alias string, use_cases array<string>, "
    "parameters array<struct<name:string,type:string,required:boolean,description:string,example:string,default:string,hint:string>>, "
    "templates array<struct<key:string,description:string,content:string,required_parameters:array<string>>>, "
    "examples array<struct<kind:string,name:string,description:string,content:string,expected_result:string,params:array<struct<key:string,value:string>>>>, "
    "common_errors array<struct<error:string,cause:string,solution:string>>, best_practices array<struct<kind:string,key:string,text:string>>, "
    "operators array<struct<symbol:string,meaning:string,example:string>>, guardrails array<string>, related_patterns array<string>, source_file string"
)


def pattern_templates(questions: dict = QUESTIONS) -> list[tuple[str, str, str, str]]:
    """What is asked about each block of a pattern."""
    t = questions["technical"]
    return [
        *(("desc", "", q, "{desc}") for q in t["description"]), *(("desc", "short", q, "{first}") for q in t["one_sentence"]), *(("desc", "category", q, "{cat}") for q in t["category"]), ("desc", "alias", "{alias_q}", "{desc}"),
        *(("uses", "", q, "{uc_text}") for q in t["use_case"]), ("uses", "desc", "Who would typically use {fn} and for what purpose?", "Use cases:\n{uc_text}\n\nOverview: {desc}"),
        ("use", "", "Can {fn} be used for {uc_low}?", "Yes, {fn} supports this: {uc}\n\nAll use cases:\n{uc_text}"), ("use", "desc", "How would you use {fn} to handle {uc_low}?", "{fn} can be applied to: {uc}\n\n{desc}"), ("use", "no_desc", "How would you use {fn} to handle {uc_low}?", "{uc_text}"),
        *(("params", "", q, "{all}") for q in t["parameter"]),
        ("param_use", "", "What parameters are most important when using {fn} for {uc_low}?", "When using {fn} for {uc}, configure these parameters:\n\n{all}"),
        ("param_kinds", "required", "Which parameters are required for {fn}?", "{req}"), ("param_kinds", "optional", "Which parameters are optional in {fn}?", "{opt}"),
        ("param", "", "What does the '{p}' parameter do in {fn}?", "{base}"), ("param", "", "Is '{p}' required or optional in {fn}?", "'{p}' is {word}. {d}"),
        ("param", "type", "What data type does '{p}' accept in {fn}?", "The '{p}' parameter accepts {type}. {d}"), ("param", "default", "What is the default value of '{p}' in {fn}?", "The default value of '{p}' is {default}. {d}"),
        ("param", "", "What happens if you omit '{p}' from {fn}?", "'{p}' is {word}. {d}"), ("param", "ex", "Give me an example value for '{p}' in {fn}.", "Example: {ex}\n\n{d}"),
        ("param", "", "How does '{p}' affect the output of {fn}?", "{base}"), ("param", "", "What is the role of '{p}' in controlling {fn} behavior?", "{base}"),
        ("param", "type", "What are valid values for '{p}' in {fn}?", "'{p}' accepts {type}. {d}{ex_tail}"), ("param", "", "What error occurs if '{p}' is set incorrectly in {fn}?", "'{p}' must satisfy: {d}. Incorrect values will cause errors."),
        ("param_pair", "", "Can '{a}' and '{b}' be used together in {fn}?", "{both}"), ("param_pair", "", "How does '{a}' interact with '{b}' in {fn}?", "{both}"), ("param_pair", "", "When configuring '{a}', what should '{b}' be set to in {fn}?", "{both}"),
        ("template", "", "How do I {td_low}?", "{full}"), ("template", "", "Show me how to {td_low}.", "{full}"), ("template", "req", "What does the {t} template for {fn} look like?", "{full}"),
        ("template", "", "Walk me through the {t} template for {fn}.", "{full}"), ("template", "req", "What are the required parameters for the {t} template in {fn}?", "Required parameters: {req}\n\nTemplate:\n{body}"),
        ("template", "no_req", "What are the required parameters for the {t} template in {fn}?", "All parameters are optional for this template.\n\nTemplate:\n{body}"), ("template", "", "What does each part of the {t} {fn} template do?", "{full}"),
        ("template", "use", "How would I adapt the {t} template for {use_low}?", "Starting from the {t} template:\n\n{body}\n\nAdapt it for: {use}"),
        ("use_template", "", "Which {fn} template would you use for {uc_low}?", "For '{uc}', the {t} template is a good starting point:\n\n{body}"), ("use_template", "", "Adapt the {t} template to solve: {uc_low}", "Base template ({t}):\n\n{body}\n\nAdapt it for: {uc}"),
        ("first_example", "", "Show me an example of {short}.", "{body}"), ("first_example", "other", "Show me an example of {fn}.", "{body}"),
        ("example", "name expected", "Show me an example of {fn} for {n}.", "{expected}"), ("example", "desc expected", "How do I use {fn} to {d_low}?", "{expected}"),
        ("example", "pattern expected", "What pattern would I use for '{n}' with {fn}?", "Pattern: {pat}\n\n{expected}"), ("example", "pattern no_expected", "What pattern would I use for '{n}' with {fn}?", "Pattern: {pat}"),
        ("example", "name", "Explain the {fn} example for '{n}'.", "{c}"), ("example", "name", "What question does the '{n}' {fn} example answer?", "The '{n}' example addresses: {d}\n\n{c}"), ("example", "name", "What outcome would you expect from the '{n}' {fn} example?", "{c}"),
        ("example", "name params", "What are the key parameters shown in the '{n}' {fn} example?", "{params}"), ("example", "name pattern", "What does the PATTERN '{pat}' match in the '{n}' {fn} example?", "{c}"),
        ("example", "name", "How would you modify the '{n}' {fn} example for a different patient profile?", "Starting from:\n\n{c}\n\nAdjust dosing, monitoring interval, and contraindications for the new patient profile."),
        ("errors", "", "What are common errors when using {fn}?", "{all}"), ("errors", "", "What gotchas should I know about {fn}?", "{all}"),
        ("error", "sol", "What causes '{e}' when using {fn}?", "{cause_sol}"), ("error", "sol", "How do I fix '{e}'?", "{sol}"), ("error", "sol", "How do I prevent '{e}' in {fn}?", "To prevent this: {sol}{root}"),
        ("error", "sol", "What should I check first when I see '{e}' in {fn}?", "{cause_sol}"), ("error", "cause", "What are the symptoms of '{e}' in {fn}?", "Error: {e}\nCause: {cause}{sol_tail}"),
        ("practices", "", "What are the best practices for {fn}?", "{bp}"), ("practices", "", "What should I know before using {fn}?", "{bp}"), ("practices", "text", "What are the most important guidelines for {fn}?", "{bp}"),
        ("practice", "list", "What is the best practice regarding '{topic}' when using {fn}?", "{x}"), ("practice", "list", "Why is it recommended to follow this {fn} guideline: {topic}?", "{x}"), ("practice", "list", "What happens if you skip this {fn} practice: {topic}?", "{x}"),
        ("practice", "map", "What is the best practice for '{topic}' in {fn}?", "{x}"), ("practice", "map", "Why is '{topic}' important when using {fn}?", "{x}"), ("practice", "map", "What happens if you ignore '{topic}' in {fn}?", "{x}"),
        ("operator", "", "What does the '{s}' operator mean in {fn} patterns?", "{m}{ex_tail}"), ("operator", "ex", "Give me an example pattern using the '{s}' operator in {fn}.", "Example: {ex}\n\nMeaning: {m}"), ("operator", "", "When would you use the '{s}' operator in an {fn} pattern?", "{m}{ex_tail}"),
        ("operators", "", "What are the {fn} pattern syntax operators?", "{all}"),
        ("operator_pair", "", "What is the difference between '{a}' and '{b}' operators in {fn}?", "{both}"), ("operator_pair", "", "Can the '{a}' and '{b}' operators be combined in an {fn} pattern?", "{both}"),
        ("limits", "", "What are the limitations of {fn}?", "{gl}"), ("limits", "", "When should you NOT use {fn}?", "{gl}"), ("limits", "", "What are the restrictions on {fn}?", "{gl}"),
        ("related", "", "How is {fn} different from {rel}?", "{fn}: {desc}\n\n{rel} is a related pattern — consult its documentation for details."), ("related", "", "When should I use {fn} instead of {rel}?", "{fn} is designed for: {desc}"),
        ("related", "", "What can {fn} do that {rel} cannot?", "{fn} specializes in: {desc}"), ("related", "", "Can {rel} replace {fn} in all use cases?", "No. {fn} is specifically designed for: {desc}"),
    ]


def _all(c: str, kind: str = "string") -> Column:
    return F.coalesce(F.col(c), F.array().cast(PATTERN_TYPES[c]))


PATTERN_TYPES = {
    "use_cases": "array<string>", "guardrails": "array<string>", "related_patterns": "array<string>",
    **{k: "array<struct<" + v for k, v in (("parameters", "name:string,type:string,required:boolean,description:string,example:string,default:string,hint:string>>"), ("templates", "key:string,description:string,content:string,required_parameters:array<string>>>"),
       ("examples", "kind:string,name:string,description:string,content:string,expected_result:string,params:array<struct<key:string,value:string>>>>"), ("common_errors", "error:string,cause:string,solution:string>>"), ("best_practices", "kind:string,key:string,text:string>>"), ("operators", "symbol:string,meaning:string,example:string>>"))},
}


def shown_parameter(p: Column) -> Column:
    return F.array_join(F.array_compact(F.array(
        F.concat(F.lit("**"), F.coalesce(p["name"], F.lit("?")), F.lit("**")), F.when(nonempty(p["type"]), F.format_string("(type: %s)", p["type"])), F.when(p["required"].eqNullSafe(False), F.lit("(optional)")),
        F.when(nonempty(p["description"]), F.format_string("— %s", p["description"])), F.when(nonempty(p["example"]), F.format_string("Example: %s", p["example"])), F.when(p["default"].isNotNull(), F.format_string("Default: %s", p["default"])),
    )), " ")


def pairs_of(a: Column, f) -> Column:
    """f(x_i, x_j, i, j) for all i < j of an array, in order."""
    return F.flatten(F.transform(a, lambda x, i: F.transform(F.filter(F.transform(a, lambda y, j: F.struct(y.alias("y"), j.alias("j"))), lambda z: z["j"] > i), lambda z: f(x, z["y"], i, z["j"]))))


def tail(before: str, c: Column, after: str = "") -> Column:
    return F.when(nonempty(c), F.concat(F.lit(before), c, F.lit(after))).otherwise("")


def _practices() -> Column:
    bp = _all("best_practices")
    kind = F.try_element_at(bp, F.lit(1))["kind"]
    return F.when(kind == "map", F.array_join(F.transform(bp, lambda x: F.concat(F.lit("**"), x["key"], F.lit("**: "), x["text"])), "\n\n")).when(kind == "list", bullets(F.transform(bp, lambda x: x["text"]))).otherwise(F.coalesce(strip(F.try_element_at(bp, F.lit(1))["text"]), F.lit("")))


def _errors() -> Column:
    return F.filter(_all("common_errors"), lambda e: nonempty(e["error"]))


def _blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def pattern_facts(domain: Domain = Domain()) -> Column:
    """Facts of one pattern row (schema PATTERN)."""
    name, desc, category, alias = (strip(c) for c in ("name", "description", "category", "pattern_alias"))
    fn = strip(first_nonempty(F.col("title"), F.col("name")))
    first = first_sentence(desc)
    alias_q = F.replace(F.lit(domain.alias_question), F.lit("{alias}"), alias)
    alias_q = strip(F.concat_ws(" ", alias_q, F.lit(domain.domain_label))) if domain.domain_label.strip() else alias_q
    uses = F.filter(F.transform(_all("use_cases"), strip), lambda u: u != "")
    uc_text, has_desc = bullets(uses), desc != ""
    params = F.filter(_all("parameters"), lambda p: nonempty(p["name"]) & nonempty(p["description"]))
    shown = lambda a: F.array_join(F.transform(a, shown_parameter), "\n\n")
    required, optional = F.filter(params, lambda p: ~p["required"].eqNullSafe(False)), F.filter(params, lambda p: p["required"].eqNullSafe(False))
    templates = _all("templates")
    bodied = F.filter(F.transform(templates, lambda t, i: F.struct(F.replace(t["key"], F.lit("_"), F.lit(" ")).alias("t"), strip(first_nonempty(t["description"], F.replace(t["key"], F.lit("_"), F.lit(" ")))).alias("td"), strip(t["content"]).alias("body"), F.coalesce(t["required_parameters"], F.array().cast("array<string>")).alias("req"), i.alias("i"))), lambda t: t["body"] != "")
    use0 = F.coalesce(F.try_element_at(uses, F.lit(1)), F.lit(""))
    examples = _all("examples")
    first_body = F.coalesce(F.try_element_at(F.filter(F.transform(F.filter(examples, lambda e: e["kind"] == "map"), lambda e: strip(first_nonempty(e["content"], e["expected_result"]))), lambda b: b != ""), F.lit(1)), F.lit(""))
    short = F.when(nonempty(F.col("pattern_alias")), alias).otherwise(fn)
    errors, practices, gl = _errors(), _all("best_practices"), bullets(_all("guardrails"))
    ops = F.filter(_all("operators"), lambda o: nonempty(o["symbol"]) & nonempty(o["meaning"]))
    has_fn = fn != ""
    long_uses = lambda n: F.filter(F.transform(F.slice(uses, 1, n), lambda u, i: F.struct(u.alias("u"), i.alias("i"))), lambda x: F.length(x["u"]) > 10)

    def param(p: Column, i: Column) -> Column:
        base = F.concat(p["description"], tail("\n\nExample value: ", p["example"]), tail("\n\nNote: ", p["hint"]))
        return fact("param", {"fn": fn, "p": p["name"], "d": p["description"], "type": p["type"], "ex": p["example"], "default": p["default"], "base": base, "word": F.when(p["required"].eqNullSafe(False), "optional").otherwise("required"), "ex_tail": tail(" Example: ", p["example"])},
                    {"type": nonempty(p["type"]), "default": p["default"].isNotNull(), "ex": nonempty(p["example"])}, i)

    def template(t: Column) -> Column:
        req = F.array_join(t["req"], ", ")
        return fact("template", {"fn": fn, "t": t["t"], "td_low": F.lower(t["td"]), "body": t["body"], "req": req, "full": F.concat(t["body"], tail("\n\nRequired parameters: ", req)), "use": use0, "use_low": F.lower(use0)}, {"req": F.size(t["req"]) > 0, "no_req": F.size(t["req"]) == 0, "use": use0 != ""}, t["i"])

    def example(e: Column, i: Column) -> Column:
        m = e["kind"] == "map"
        n, expected, body = (F.when(m, strip(e[k])).otherwise("") for k in ("name", "expected_result", "content"))
        d = F.when(m, strip(first_nonempty(e["description"], n))).otherwise("")
        c = F.when(m, first_nonempty(expected, body, d)).otherwise(strip(e["content"]))
        ps = F.coalesce(e["params"], F.array().cast("array<struct<key:string,value:string>>"))
        pat = F.try_element_at(F.filter(ps, lambda x: x["key"] == "pattern"), F.lit(1))["value"]
        return fact("example", {"fn": fn, "n": n, "d": d, "d_low": F.lower(d), "expected": expected, "c": c, "pat": pat, "params": F.array_join(F.transform(ps, lambda x: F.format_string("  %s: %s", x["key"], x["value"])), "\n")},
                    {"name": n != "", "desc": d != "", "expected": expected != "", "no_expected": expected == "", "pattern": pat.isNotNull(), "params": F.size(ps) > 0, "any": c != ""}, i)

    def error(e: Column, i: Column) -> Column:
        cause, sol = _blank(e["cause"]), _blank(e["solution"])
        return fact("error", {"fn": fn, "e": e["error"], "cause": cause, "sol": sol, "cause_sol": F.when(cause != "", F.concat(F.lit("Cause: "), cause, F.lit("\n\nSolution: "), sol)).otherwise(sol), "root": tail("\n\nRoot cause: ", cause), "sol_tail": tail("\nSolution: ", sol)}, {"sol": sol != "", "cause": cause != ""}, i)

    def practice(x: Column, i: Column) -> Column:
        text = strip(x["text"])
        topic = F.when(x["kind"] == "map", strip(F.replace(x["key"], F.lit("_"), F.lit(" ")))).otherwise(strip(F.substring(F.split(text, r"[,\.]")[0], 1, 60)))
        return fact("practice", {"fn": fn, "topic": topic, "x": text}, {"list": (x["kind"] == "list") & (F.length(text) > 15), "map": (x["kind"] == "map") & (topic != "") & (text != "")}, i)

    def both(x: Column, y: Column, name: str, text: str, example: str, link: str, end: str) -> Column:
        one = lambda z: F.concat(F.lit("'"), z[name], F.lit(f"'{link}"), z[text], tail(example, z["example"], end))
        return F.concat_ws("\n\n", one(x), one(y))

    return only(has_fn, F.concat(
        only(has_desc, F.array(fact("desc", {"fn": fn, "desc": desc, "first": first, "alias_q": alias_q, "cat": F.concat(fn, F.lit(" is a "), category, F.lit(" function. "), F.when(first != "", first).otherwise(desc))},
             {"short": (first != "") & (F.length(first) < F.length(desc) - 20), "category": category != "", "alias": (alias != "") & (F.upper(alias) != F.upper(name))}))),
        only(F.size(uses) > 0, F.array(fact("uses", {"fn": fn, "uc_text": uc_text, "desc": desc}, {"desc": has_desc}))),
        F.transform(long_uses(10), lambda x: fact("use", {"fn": fn, "uc": x["u"], "uc_low": F.lower(x["u"]), "uc_text": uc_text, "desc": desc}, {"desc": has_desc, "no_desc": ~has_desc}, x["i"])),
        only(F.size(params) > 0, F.concat(
            F.array(fact("params", {"fn": fn, "all": shown(params)}), fact("param_kinds", {"fn": fn, "req": shown(required), "opt": shown(optional)}, {"required": F.size(required) > 0, "optional": F.size(optional) > 0})),
            F.transform(long_uses(5), lambda x: fact("param_use", {"fn": fn, "uc": x["u"], "uc_low": F.lower(x["u"]), "all": shown(params)}, None, x["i"])),
            F.transform(params, param),
            pairs_of(params, lambda x, y, i, j: fact("param_pair", {"fn": fn, "a": x["name"], "b": y["name"], "both": both(x, y, "name", "description", " (e.g. ", ": ", ")")}, None, i, j)),
        )),
        F.transform(bodied, template),
        F.flatten(F.transform(F.slice(uses, 1, 5), lambda u, i: F.transform(F.filter(bodied, lambda t: t["i"] < 5), lambda t: fact("use_template", {"fn": fn, "uc": u, "uc_low": F.lower(u), "t": t["t"], "body": t["body"]}, None, i, t["i"])))),
        only(first_body != "", F.array(fact("first_example", {"fn": fn, "short": short, "body": first_body}, {"other": short != fn}))),
        F.filter(F.transform(examples, example), lambda f: F.array_contains(f["flags"], "any")),
        only(F.size(errors) > 0, F.array(fact("errors", {"fn": fn, "all": F.array_join(F.transform(errors, lambda e: F.concat(F.lit("**Error**: "), e["error"], F.lit("\n**Cause**: "), _blank(e["cause"]), F.lit("\n**Solution**: "), _blank(e["solution"]))), "\n\n")}))),
        F.transform(errors, error),
        only(_practices() != "", F.concat(F.array(fact("practices", {"fn": fn, "bp": _practices()}, {"text": F.try_element_at(practices, F.lit(1))["kind"] == "text"})), F.transform(F.slice(practices, 1, 12), practice))),
        F.transform(ops, lambda o, i: fact("operator", {"fn": fn, "s": o["symbol"], "m": o["meaning"], "ex": o["example"], "ex_tail": tail("\n\nExample: ", o["example"])}, {"ex": nonempty(o["example"])}, i)),
        only(F.size(ops) > 0, F.array(fact("operators", {"fn": fn, "all": F.array_join(F.transform(ops, lambda o: F.concat(F.lit("'"), o["symbol"], F.lit("' — "), o["meaning"], F.lit("."), tail(" ", o["example"]))), "\n")}))),
        pairs_of(ops, lambda x, y, i, j: fact("operator_pair", {"fn": fn, "a": x["symbol"], "b": y["symbol"], "both": both(x, y, "symbol", "meaning", " Example: ", " — ", "")}, None, i, j)),
        only(F.size(_all("guardrails")) > 0, F.array(fact("limits", {"fn": fn, "gl": gl}))),
        only(has_desc, F.transform(F.filter(F.transform(F.slice(_all("related_patterns"), 1, 5), strip), lambda r: r != ""), lambda r, i: fact("related", {"fn": fn, "rel": r, "desc": desc}, None, i))),
    ))


def pattern_qa(patterns: DataFrame, keep: list[str], domain: Domain = Domain(), questions: dict = QUESTIONS) -> DataFrame:
    """keep + (block_no, item, sub, pos, question, answer); in the order of those positions."""
    return expand(patterns, pattern_facts(domain), template_table(patterns.sparkSession, pattern_templates(questions)), keep)


# The wordings of the turns.
def pattern_conversations() -> Column:
    """array of conversations from up to four angles: exploration, debugging, efficiency, adoption. Each has four messages at least."""
    none = F.array().cast("array<struct<role:string,content:string>>")
    fn, desc = strip(first_nonempty(F.col("title"), F.col("name"))), strip("description")
    says = lambda fmt, *a: F.format_string(fmt, *a)
    when = lambda c, q, a: F.when(c, asked(q if isinstance(q, Column) else F.lit(q), a)).otherwise(none)
    bodied = F.filter(F.transform(_all("templates"), lambda t: F.struct(strip(t["content"]).alias("body"), strip(first_nonempty(t["description"], F.replace(t["key"], F.lit("_"), F.lit(" ")))).alias("d"))), lambda t: t["body"] != "")
    body, body_desc = F.coalesce(F.try_element_at(bodied, F.lit(1))["body"], F.lit("")), F.try_element_at(bodied, F.lit(1))["d"]
    ex = F.try_element_at(_all("examples"), F.lit(1))
    expected = F.coalesce(strip(first_nonempty(ex["expected_result"], ex["content"])), F.lit(""))
    any_errors = F.size(_all("common_errors")) > 0
    listed = lambda n: F.array_join(F.transform(F.filter(F.slice(_all("common_errors"), 1, n), lambda e: nonempty(e["error"])), lambda e: F.concat(F.lit("- "), e["error"], F.lit(": "), _blank(e["solution"]))), "\n")
    bp, gl = _practices(), bullets(_all("guardrails"))
    has_uses, has_rel = F.size(_all("use_cases")) > 0, F.size(_all("related_patterns")) > 0
    explore = F.concat(
        asked(says("What is %s?", fn), desc), when(has_uses, says("What are the use cases for %s?", fn), bullets(_all("use_cases"))),
        when(body != "", says("Can you show me the syntax for %s?", fn), F.concat(body_desc, F.lit(":\n\n"), body)), when(expected != "", "Can you show me a concrete example?", expected),
        when(any_errors & (listed(3) != ""), "Are there any common errors or gotchas I should watch out for?", listed(3)), when(~any_errors & (bp != ""), says("What are the best practices for %s?", fn), F.substring(bp, 1, 800)),
    )
    debug = F.concat(
        asked(says("My %s example did not produce the expected outcome. How do I debug it?", fn), says("When %s fails or looks wrong, check inputs, required parameters, and common pitfalls first.\n\nDescription of %s: %s", fn, fn, desc)),
        when(body != "", "Can you show me a diagnostic example I can start with?", F.concat(F.lit("Start with this template and verify each step:\n\n"), body)), when(listed(4) != "", "What are the most common mistakes that cause empty results?", listed(4)),
    )
    efficiency = F.concat(
        asked(says("How do I use %s more efficiently?", fn), says("Efficiency for %s depends on scope, data quality, and following recommended practices. %s", fn, desc)),
        when(bp != "", "What are the performance best practices?", F.substring(bp, 1, 800)), when(gl != "", "Are there any hard limits or restrictions I should know about?", gl),
    )
    adoption = F.concat(
        asked(says("We currently handle this manually with ad hoc steps. Should we adopt %s?", fn), says("%s provides a structured approach that can replace inconsistent manual workflows. %s", fn, desc)),
        when(body != "", says("What does a basic %s example look like?", fn), body),
        when(has_rel, "Are there related functions I should also know about?", F.concat(F.lit("Related patterns to consider alongside "), fn, F.lit(": "), F.array_join(F.slice(_all("related_patterns"), 1, 3), ", "))),
    )
    angles = F.array(explore, F.when((body != "") | any_errors, debug).otherwise(none), efficiency, F.when(body != "", adoption).otherwise(none))
    return F.when((fn != "") & (desc != ""), F.filter(angles, lambda a: F.size(a) >= 4)).otherwise(F.array().cast("array<array<struct<role:string,content:string>>>"))


# ---- vocabularies

#: Single answers normalised at load; None or empty fields ask nothing.
ENTRY = (
    "entry int, domain string, name string, category string, description string, one_sentence string, syntax string, null_behavior string, performance_tips string, "
    "analysis_notes string, errors string, first_example string, related array<string>, source_file string"
)


def placeholders(template: str) -> list[str]:
    """The names in a template, repeated ones too."""
    import re

    return re.findall(r"\{(\w+)\}", template)


def vocabulary_templates(questions: dict = QUESTIONS) -> list[tuple[str, str, str, str]]:
    """Which group is asked about which field. Only templates about {fn} alone count, and those about {fn} and {related} for related topics."""
    t, g, f = questions["technical"], questions["general"], questions["financial"]
    rows = [
        (t["description"], "description", "description"), (t["one_sentence"], "one_sentence", "one_sentence"), (t["category"], "category", "category"), (t["use_case"], "description", "description"), (t["syntax"], "syntax", "syntax"), (t["argument"], "syntax", "syntax"),
        (t["notes"], "description", "description"), (t["null_behavior"], "null_behavior", "null_behavior"), (t["performance"], "performance_tips", "performance_tips"), (t["example"], "first_example", "first_example"), (t["error_troubleshoot"], "errors", "errors"),
        (f["transaction"], "description transaction_type", "description"), (f["account_summary"], "description balance_concept", "description"), (f["analysis"], "description analysis_pattern", "description"),
        (g["overview"], "description", "description"), (g["detail"], "analysis_notes", "analysis_notes"),
    ]
    single = [("entry", needs, q, "{" + field + "}") for qs, needs, field in rows for q in qs if placeholders(q) == ["fn"]]
    related = [("related", "", q, "{fn}: {description}\n\nCompare with {related} for differences in behavior and use cases.") for q in t["comparison"] if set(placeholders(q)) == {"fn", "related"}]
    return single + related + [("related", "", q, "{fn}: {description}") for q in t["comparison"] if placeholders(q) == ["fn"]]


def vocabulary_facts() -> Column:
    fields = ("description", "one_sentence", "category", "syntax", "null_behavior", "performance_tips", "analysis_notes", "errors", "first_example")
    v = {"fn": F.col("name"), **{c: F.col(c) for c in fields}}
    flags = {c: nonempty(F.col(c)) for c in fields} | {k: (F.col("domain") == "financial") & (F.col("category") == k) for k in ("transaction_type", "balance_concept", "analysis_pattern")}
    named, desc = nonempty(F.col("name")), nonempty(F.col("description"))
    rel = F.filter(F.transform(F.coalesce("related", F.array().cast("array<string>")), strip), lambda r: r != "")
    return only(named, F.concat(F.array(fact("entry", v, flags)), only(desc, F.transform(rel, lambda r, i: fact("related", {"fn": F.col("name"), "description": F.col("description"), "related": r}, None, i)))))


def vocabulary_qa(entries: DataFrame, keep: list[str] | None = None, questions: dict = QUESTIONS) -> DataFrame:
    """keep + (block_no, item, sub, pos, question, answer, source)."""
    keep = keep or ["source_file", "entry"]
    out = expand(entries.withColumn("source", F.col("name")), vocabulary_facts(), template_table(entries.sparkSession, vocabulary_templates(questions)), [*dict.fromkeys([*keep, "source"])])
    return out


# ---- capture form


def parsed_uses(text: Column) -> Column:
    ls = F.transform(F.split(strip(text), "\r\n|\n|\r"), lambda x: strip(F.regexp_replace(strip(x), r"^[-•*]+", "")))
    return F.filter(ls, lambda x: F.length(x) > 3)


def _form_lines(text: Column) -> Column:
    ls = F.transform(F.split(strip(text), "\r\n|\n|\r"), lambda x: strip(F.regexp_replace(strip(x), r"^[-•*]+", "")))
    return F.filter(ls, lambda x: x != "")


def parsed_parameters(text: Column) -> Column:
    """name: description (example) lines."""
    shape, end = r"(?U)^(\w[\w\s_\-]*?)\s*:\s*(.+)$", r"\(([^)]+)\)\s*$"
    rows = F.filter(_form_lines(text), lambda x: x.rlike(shape))
    rest = lambda x: strip(F.regexp_extract(x, shape, 2))
    return F.transform(rows, lambda x: F.struct(
        F.replace(strip(F.regexp_extract(x, shape, 1)), F.lit(" "), F.lit("_")).alias("name"), F.lit("string").alias("type"), F.lit(True).alias("required"),
        F.when(rest(x).rlike(end), strip(F.regexp_replace(rest(x), end, ""))).otherwise(rest(x)).alias("description"), F.regexp_extract(rest(x), end, 1).alias("example"), F.lit(None).cast("string").alias("default"), F.lit(None).cast("string").alias("hint"),
    ))


def parsed_errors(text: Column) -> Column:
    """problem and solution lines, split at the first of : — - → whose sides are both longer than three characters."""
    def one(x: Column) -> Column:
        out = F.lit(None).cast("struct<error:string,cause:string,solution:string>")
        for sep in reversed((":", "—", "-", "→")):
            at = F.locate(sep, x)
            e, s = strip(F.substring(x, F.lit(1), at - 1)), strip(F.substring(x, at + 1, F.length(x)))
            out = F.when((at > 0) & (F.length(e) > 3) & (F.length(s) > 3), F.struct(e.alias("error"), F.lit("").alias("cause"), s.alias("solution"))).otherwise(out)
        return out

    return F.filter(F.transform(_form_lines(text), one), lambda x: x.isNotNull())


def slug(c: Column) -> Column:
    return F.btrim(F.lower(F.regexp_replace(c, r"(?U)[^\w\-]", "_")), F.lit("_"))


def form_to_pattern(forms: DataFrame) -> DataFrame:
    """Flat form rows as pattern rows (schema PATTERN)."""
    empty = lambda t: F.lit(None).cast(t)
    title, example, output, bp = strip("title"), strip("worked_example"), strip("example_output"), strip("best_practices")
    summary = F.when(strip("example_summary") != "", strip("example_summary")).otherwise("Worked example")
    made = {
        "name": F.btrim(F.lower(F.regexp_replace(title, r"(?U)[^\w]", "_")), F.lit("_")), "title": title, "description": strip("description"),
        "category": F.when(strip("category") != "", strip("category")).otherwise("general"), "pattern_alias": empty("string"), "use_cases": parsed_uses(F.col("use_cases_text")), "parameters": parsed_parameters(F.col("parameters_text")),
        "templates": F.when(example != "", F.array(F.struct(F.lit("example").alias("key"), summary.alias("description"), example.alias("content"), F.array().cast("array<string>").alias("required_parameters")))),
        "examples": F.when((example != "") & (output != ""), F.array(F.struct(F.lit("map").alias("kind"), summary.alias("name"), summary.alias("description"), empty("string").alias("content"), output.alias("expected_result"), F.array().cast("array<struct<key:string,value:string>>").alias("params")))),
        "common_errors": parsed_errors(F.col("common_errors_text")), "best_practices": F.when(bp != "", F.array(F.struct(F.lit("text").alias("kind"), F.lit("").alias("key"), bp.alias("text")))),
        "operators": empty(PATTERN_TYPES["operators"]), "guardrails": empty("array<string>"), "related_patterns": empty("array<string>"), "source_file": empty("string"),
    }
    return forms.select(*(v.alias(k) for k, v in made.items()))


def pattern_to_form(patterns: DataFrame) -> DataFrame:
    """Pattern rows as flat form rows."""
    one = lambda c: F.try_element_at(_all(c), F.lit(1))
    blank = _blank
    return patterns.select(
        "name", blank(F.col("title")).alias("title"), blank(F.col("description")).alias("description"), blank(F.col("category")).alias("category"), _practices().alias("best_practices"), F.array_join(_all("use_cases"), "\n").alias("use_cases_text"),
        F.array_join(F.transform(_all("parameters"), lambda p: F.concat(blank(p["name"]), F.lit(": "), blank(p["description"]), tail(" (", p["example"], ")"))), "\n").alias("parameters_text"),
        blank(one("templates")["content"]).alias("worked_example"), blank(one("templates")["description"]).alias("example_summary"), blank(one("examples")["expected_result"]).alias("example_output"),
        F.array_join(F.transform(_all("common_errors"), lambda e: F.concat(blank(e["error"]), F.lit(": "), blank(e["solution"]))), "\n").alias("common_errors_text"),
    )
