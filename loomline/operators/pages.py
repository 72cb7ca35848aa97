"""Pages of manuals: classification, running headers and footers, headings, sections, parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.functions.config import Domain
from loomline.functions.scratch import written
from loomline.functions.text import col, let, lines, n_words, strip, words

# Fixed values.
RESERVED_HEADINGS = ("INPUT", "OUTPUT", "RESULT", "OUTCOME", "CASE", "NOTES", "INTRODUCTION", "OVERVIEW", "SUMMARY", "INDEX", "CONTENTS", "DESCRIPTION", "SYNTAX", "ARGUMENTS", "PARAMETERS", "EXAMPLES")
STRUCTURE_WORDS = ("Column", "Schema", "Type", "Description", "Table", "Row")
HEADING_SHAPES = (r"^[A-Z][A-Z0-9 _\-/]{1,59}$", r"^\d+(?:\.\d+)*\s+[A-Z][^\n]{5,79}$", r"^(?:[A-Z][a-z]+\s+){1,6}[A-Z][a-z]+$")
PART_LABELS = {
    "description": r"(?i)^\s*(description|overview|purpose|about)\s*:?\s*$",
    "syntax": r"(?i)^\s*(syntax|format)\s*:?\s*$",
    "arguments": r"(?i)^\s*(arguments?|parameters?|operands?)\s*:?\s*$",
    "notes": r"(?i)^\s*(notes?|usage notes?|remarks?|restrictions?|considerations?|caveats?)\s*:?\s*$",
    "examples": r"(?i)^\s*(examples?|sample|results?|return value|input(\s+(data|tables?|history))?|protocol|treatment plan|clinical plan|calculation|journal entry|output(\s+(data|tables?|result|outcome))?)\s*:?\s*$",
}
CAPTION = r"(?i)(?:Figure|Fig\.?)\s+[\d\-\.]+\s*[:\-]\s*(.+)"


def matching(array: Column, pattern: str) -> Column:
    return F.size(F.filter(array, lambda x: x.rlike(pattern)))


def is_toc(text: Column | str) -> Column:
    def test(ls: Column) -> Column:
        n = F.size(ls)
        titled = F.coalesce(F.lower(F.try_element_at(ls, F.lit(1))).contains("contents"), F.lit(False)) & (n > 3)
        return titled | let(matching(ls, r"\.\s{0,2}\d+\s*$"), lambda leaders: (leaders >= 3) & (leaders >= F.floor(n / 2)))

    return (F.length(strip(text)) >= 50) & let(lines(text), test)


def is_boilerplate(text: Column | str) -> Column:
    return let(strip(text), lambda t: let(F.lower(t), lambda low: _boilerplate(t, low, F.length(t))))


def _boilerplate(t: Column, low: Column, n: Column) -> Column:
    return (n < 100) | (low.contains("copyright") & (low.contains("rights reserved") | t.contains("©"))) | (low.contains("trademark") & low.contains("safety") & (n < 800)) | (low.rlike(r"https?://\S+") & (n < 300))


def is_index(text: Column | str) -> Column:
    def test(ls: Column) -> Column:
        entries = F.size(F.filter(ls, lambda x: (F.length(x) < 80) & x.rlike(r"\d+(?:,\s*\d+)*\s*$")))
        return (matching(ls, "^[A-Z]$") >= 3) | let(entries, lambda n: (n >= 5) & (n >= F.size(ls) * 0.5))

    return (F.length(strip(text)) >= 50) & let(lines(text), test)


def is_substantive(text: Column | str) -> Column:
    text = F.coalesce(col(text), F.lit(""))
    long = F.filter(F.split(text, "\n"), lambda x: F.length(strip(x)) > 20)
    return (F.length(strip(text)) >= 80) & let(long, lambda ls: (F.size(ls) >= 2) & (F.aggregate(ls, F.lit(0), lambda s, x: s + F.length(x)) > 200))


def keep_page(text: Column | str, skip_toc: bool = True, skip_boilerplate: bool = True, skip_index: bool = True) -> Column:
    def test_all(t: Column) -> Column:
        keep = is_substantive(t)
        for skip, test in ((skip_boilerplate, is_boilerplate), (skip_toc, is_toc), (skip_index, is_index)):
            keep = keep & ~test(t) if skip else keep
        return keep

    return let(strip(text), test_all)


def is_heading(line: Column | str) -> Column:
    return let(strip(line), _heading)


def _heading(x: Column) -> Column:
    shape = F.lit(False)
    for p in HEADING_SHAPES:
        shape = shape | x.rlike(p)
    ws = words(x)
    return (
        F.length(x).between(3, 80) & ~x.rlike(r"[.:,]$") & (F.size(ws) <= 10) & ~x.rlike(r"^\d") & ~x.rlike(r"\d{4}-\d{2}-\d{2}")
        & (F.regexp_count(x, F.lit(r"(?U)\b\d+\b")) < 2) & ~F.upper(x).isin(*RESERVED_HEADINGS)
        & (F.size(F.array_intersect(ws, F.array(*map(F.lit, STRUCTURE_WORDS)))) < 2) & shape
    )


def page_heading(text: Column | str) -> Column:
    """The first heading among the top five lines, or null."""
    return F.try_element_at(F.filter(F.slice(lines(text), 1, 5), is_heading), F.lit(1))


def line_key(line: Column) -> Column:
    """A line without a page number at its ends, in lower case."""
    x = F.regexp_replace(strip(line), r"^\d{1,4}\s+", "")
    return strip(F.lower(F.regexp_replace(x, r"\s+\d{1,4}$", "")))


def running_lines(pages: DataFrame, doc: str = "doc", text: str = "text", min_share: float = 0.35) -> DataFrame:
    """(doc, side, line, n): lines that run at the head or foot of enough of a document's pages (4 at least)."""
    ls = F.filter(F.split(strip(text), "\n"), lambda x: strip(x) != "")
    ends = F.concat(F.transform(F.slice(ls, 1, 2), lambda x: F.struct(F.lit("header").alias("side"), line_key(x).alias("line"))), F.transform(F.slice(ls, F.when(F.size(ls) >= 2, -2).otherwise(1), 2), lambda x: F.struct(F.lit("footer").alias("side"), line_key(x).alias("line"))))
    counts = pages.select(doc, F.explode(ends).alias("e")).select(doc, "e.*").where(F.length("line") > 4).groupBy(doc, "side", "line").agg(F.count("*").alias("n"))
    sizes = pages.groupBy(doc).agg(F.count("*").alias("pages")).where("pages >= 4")
    return counts.join(sizes, doc).where(F.col("n") >= F.greatest(F.lit(3), F.floor(F.col("pages") * min_share))).select(doc, "side", "line", "n")


def strip_running(pages: DataFrame, running: DataFrame, doc: str = "doc", text: str = "text") -> DataFrame:
    """Pages without their document's running lines and, where it has any, without lines that are page numbers."""
    sets = running.groupBy(doc).agg(F.collect_set("line").alias("_lines"))
    kept = F.array_join(F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: ~F.array_contains("_lines", line_key(x)) & ~x.rlike(r"^\s*\d{1,4}\s*$")), "\n")
    return pages.join(sets, doc, "left").withColumn(text, F.when(F.col("_lines").isNull(), F.col(text)).otherwise(kept)).drop("_lines")


def sections(pages: DataFrame, doc: str = "doc", page: str = "page", text: str = "text") -> DataFrame:
    """(doc, section, heading, page_start, page_end, pages, text): a page whose heading differs from the one in force opens a section."""
    order = Window.partitionBy(doc).orderBy(page)
    p = pages.withColumn("_h", page_heading(text))
    p = p.withColumn("_now", F.coalesce(F.last("_h", ignorenulls=True).over(order), F.lit("Introduction")))
    p = p.withColumn("_new", F.coalesce((F.col("_now") != F.lag("_now").over(order)).cast("int"), F.lit(0)))
    p = p.withColumn("section", F.sum("_new").over(order).cast("long"))
    rows = F.array_sort(F.collect_list(F.struct(F.col(page).alias("page"), strip(text).alias("t"))))
    made = p.groupBy(doc, "section", F.col("_now").alias("heading")).agg(rows.alias("_rows"), F.min(page).alias("page_start"), F.max(page).alias("page_end"), F.count("*").alias("pages"))
    return made.withColumn("text", F.array_join(F.transform("_rows", lambda r: r["t"]), "\n\n")).drop("_rows")


def long_sections(pages: DataFrame, doc: str = "doc", page: str = "page", text: str = "text") -> DataFrame:
    """sections() for documents of any length: no task holds more of a document than one part of it.

    Pages are dealt by ranges of (document, page), so that a long document has several parts, and written once with
    numbers in their order. Of each part only its last heading and its number of new sections count for the parts after
    it; these two are carried over a document's parts, a few rows a document, and joined back. Texts meet by part first
    and then by section. A page number that occurs twice in a document has its pages in no fixed order.
    """
    spark = pages.sparkSession
    dealt = pages.select(F.col(doc).alias("d"), F.col(page).alias("p"), page_heading(text).alias("h"), strip(text).alias("t")).repartitionByRange("d", "p").sortWithinPartitions("d", "p")
    numbered = written(dealt.withColumn("n", F.monotonically_increasing_id()), "pages").withColumn("part", F.shiftright("n", 33))
    parts = Window.partitionBy("d").orderBy("part")
    before = parts.rowsBetween(Window.unboundedPreceding, -1)

    ends = numbered.groupBy("d", "part").agg(F.max_by("h", F.when(F.col("h").isNotNull(), F.col("n"))).alias("e"))
    came = ends.select("d", "part", F.coalesce(F.last("e", ignorenulls=True).over(before), F.lit("Introduction")).alias("came"), (F.row_number().over(parts) == 1).alias("opens"))

    def scanned(p: DataFrame, carried: DataFrame) -> DataFrame:
        """p with the heading in force and whether it is a new one."""
        order = Window.partitionBy("d", "part").orderBy("n")
        c = carried.withColumnsRenamed({"d": "cd", "part": "cpart"})
        now = F.coalesce(F.last("h", ignorenulls=True).over(order), F.col("came"))
        p = p.join(c, F.col("d").eqNullSafe(F.col("cd")) & (F.col("part") == F.col("cpart"))).drop("cd", "cpart").withColumn("now", now)
        was = F.coalesce(F.lag("now").over(order), F.when(~F.col("opens"), F.col("came")))
        return p.withColumn("new", F.coalesce((F.col("now") != was).cast("long"), F.lit(0)))

    found = scanned(numbered.drop("t"), came).groupBy("d", "part").agg(F.first("came").alias("came"), F.first("opens").alias("opens"), F.sum("new").alias("new"))
    carried = written(found.select("d", "part", "came", "opens", F.coalesce(F.sum("new").over(before), F.lit(0)).alias("base")), "parts")  # a table of its own: the join back can then be split or sent to all
    p = scanned(numbered, carried).withColumn("section", F.col("base") + F.sum("new").over(Window.partitionBy("d", "part").orderBy("n")))
    joined = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", c))), lambda r: r[c]), "\n\n")
    pieces = p.groupBy("d", "part", "section", "now").agg(joined("t").alias("t"), F.min("n").alias("n"), F.min("p").alias("low"), F.max("p").alias("high"), F.count("*").alias("pages"))
    made = pieces.groupBy("d", "section", "now").agg(joined("t").alias("text"), F.min("low").alias("page_start"), F.max("high").alias("page_end"), F.sum("pages").alias("pages"))
    return made.select(F.col("d").alias(doc), "section", F.col("now").alias("heading"), "page_start", "page_end", "pages", "text")


def example_parts(text: Column | str, domain: Domain = Domain()) -> Column:
    """struct(input, structured, output): the last filled block under each kind of label."""
    kinds = ("input", "structured", "output")
    empty = F.array().cast("array<string>")

    def labelled(para: Column) -> Column:
        def of(head: Column) -> Column:
            kind = F.lit(None).cast("string")
            for k in reversed(kinds):
                kind = F.when(head.rlike("(?i)" + domain.label_regex(k)), k).otherwise(kind)
            return kind

        rest = lambda ls: F.array_join(F.slice(ls, 2, F.greatest(F.size(ls), F.lit(1))), "\n")
        body = lambda ls, kind: F.struct(kind.alias("kind"), F.when(kind.isNull(), strip(para)).otherwise(rest(ls)).alias("body"))
        return let(lines(para), lambda ls: let(let(F.try_element_at(ls, F.lit(1)), of), lambda kind: body(ls, kind)))

    def closed(s: Column) -> dict[str, Column]:
        made = F.array_join(s["buf"], "\n\n")
        return {k: F.when((s["now"] == k) & (F.size(s["buf"]) > 0), strip(made)).otherwise(s[k]) for k in kinds}

    def step(s: Column, x: Column) -> Column:
        done = closed(s)
        opens = x["kind"].isNotNull()
        return F.struct(
            *(F.when(opens, done[k]).otherwise(s[k]).alias(k) for k in kinds),
            F.coalesce(x["kind"], s["now"]).alias("now"),
            F.when(opens, F.when(x["body"] != "", F.array(x["body"])).otherwise(empty)).when(s["now"].isNotNull(), F.concat(s["buf"], F.array(x["body"]))).otherwise(s["buf"]).alias("buf"),
        )

    paras = F.transform(F.filter(F.split(F.coalesce(col(text), F.lit("")), "\n\n+"), lambda p: F.size(lines(p)) > 0), labelled)
    start = F.struct(*(F.lit("").alias(k) for k in kinds), F.lit(None).cast("string").alias("now"), empty.alias("buf"))
    return F.aggregate(paras, start, step, lambda s: F.struct(*(v.alias(k) for k, v in closed(s).items())))


def section_parts(text: Column | str) -> Column:
    """struct of arrays description, syntax, arguments, notes, examples: paragraphs under the label in force."""
    empty = F.array().cast("array<string>")

    def labelled(para: Column) -> Column:
        def of(head: Column) -> Column:
            label = F.lit(None).cast("string")
            for k, p in reversed(PART_LABELS.items()):
                label = F.when(head.rlike(p), k).otherwise(label)
            return label

        rest = lambda ls: F.array_join(F.slice(ls, 2, F.greatest(F.size(ls), F.lit(1))), "\n")
        body = lambda ls, label: F.struct(label.alias("label"), F.when(label.isNull(), strip(para)).otherwise(rest(ls)).alias("body"))
        return let(lines(para), lambda ls: let(let(F.try_element_at(ls, F.lit(1)), of), lambda label: body(ls, label)))

    def step(s: Column, x: Column) -> Column:
        now = F.coalesce(x["label"], s["now"])
        return F.struct(*(F.when((now == k) & (x["body"] != ""), F.concat(s[k], F.array(x["body"]))).otherwise(s[k]).alias(k) for k in PART_LABELS), now.alias("now"))

    paras = F.transform(F.filter(F.split(F.coalesce(col(text), F.lit("")), "\n\n+"), lambda p: F.size(lines(p)) > 0), labelled)
    start = F.struct(*(empty.alias(k) for k in PART_LABELS), F.lit("description").alias("now"))
    return F.aggregate(paras, start, step, lambda s: F.struct(*(s[k].alias(k) for k in PART_LABELS)))


def captions(text: Column | str) -> Column:
    return F.transform(F.regexp_extract_all(F.coalesce(col(text), F.lit("")), F.lit(CAPTION), F.lit(0)), strip)


def structured_blocks(text: Column | str, domain: Domain = Domain(), separator: str = "\n\n+") -> Column:
    return F.transform(F.filter(F.split(F.coalesce(col(text), F.lit("")), separator), domain.structured), strip)


def manual_label(path: Column | str) -> Column:
    """A label for file names from a path's stem."""
    stem = F.regexp_replace(F.regexp_extract(col(path), r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")
    return F.btrim(F.lower(F.regexp_replace(stem, r"(?U)[^\w\-]", "_")), F.lit("_"))


def valid_text(text: Column | str) -> Column:
    """Whether extracted text is readable: long enough and mostly letters."""
    t = F.coalesce(col(text), F.lit(""))
    solid = F.length(F.translate(t, " \n", ""))
    letters = F.length(F.regexp_replace(t, r"[^\p{L}]+", ""))
    return (F.length(strip(t)) >= 50) & (F.size(F.filter(F.split(t, "\n"), lambda x: strip(x) != "")) >= 3) & (n_words(t) >= 10) & (solid > 0) & (letters / F.greatest(solid, F.lit(1)) >= 0.4)


def extract_manuals(pages: DataFrame, doc: str = "doc", page: str = "page", text: str = "text", **skip: bool) -> dict[str, DataFrame]:
    """pages -> {pages, running, sections, documents}: filter, strip running lines, filter again, stitch."""
    clean, running = clean_pages(pages, doc, text, **skip)
    return stitched(pages, clean, doc, page, text) | {"running": running}


def clean_pages(pages: DataFrame, doc: str = "doc", text: str = "text", **skip: bool) -> tuple[DataFrame, DataFrame]:
    """The pages that are kept, without running lines; and these lines."""
    kept = pages.where(keep_page(text, **skip))
    running = running_lines(kept, doc, text)
    return strip_running(kept, running, doc, text).where(is_substantive(text)), running


def stitched(pages: DataFrame, clean: DataFrame, doc: str = "doc", page: str = "page", text: str = "text") -> dict[str, DataFrame]:
    """{pages, sections, documents} from all pages and the clean ones."""
    parts = sections(clean, doc, page, text)
    rows = F.array_sort(F.collect_list(F.struct(F.col(page).alias("page"), strip(text).alias("t"))))
    full = clean.groupBy(doc).agg(rows.alias("r"), F.count("*").alias("num_pages_kept")).withColumn("full_text", F.array_join(F.transform(F.filter("r", lambda x: x["t"] != ""), lambda x: x["t"]), "\n\n")).drop("r")
    docs = pages.groupBy(doc).agg(F.count("*").alias("num_pages_total")).join(full, doc, "left").join(parts.groupBy(doc).agg(F.count("*").alias("num_sections")), doc, "left")
    return {"pages": clean, "sections": parts, "documents": docs.fillna({"num_pages_kept": 0, "num_sections": 0, "full_text": ""})}


# Ordered rules of the two histograms; a leading ^ means at the start.
QUESTION_TYPES = (
    ("Syntax / structured expression", ("syntax", "write a sql", "expression", "write a ")),
    ("Arguments / Parameters", ("argument", "parameter")),
    ("Example / Demonstrate / protocol", ("example", "demonstrate", "show me", "sql demonstrates")),
    ("Usage notes / Prerequisites / Gotchas", ("usage notes", "prerequisites", "gotchas", "restrictions")),
    ("When to use / Problem solved", ("when should", "problem does")),
    ("Diagram", ("diagram",)),
    ("What is / Describe / Purpose", ("^what is", "^describe")),
    ("Other / Fallback", ("^",)),
)
QUESTION_TYPES_VIEW = (
    ("Syntax / structured", ("syntax", "write a", "expression")),
    ("Arguments / Params", ("argument", "parameter")),
    ("Example / Demo", ("example", "demonstrate", "show me")),
    ("Usage notes", ("usage notes",)),
    ("What is / Describe", ("^what is", "^describe")),
    ("Other", ("^",)),
)


def question_type(question: Column | str, view: bool = False) -> Column:
    """The kind of a question by ordered keywords; `view` is the shorter list of the dashboard."""
    q = F.lower(col(question))
    out = F.lit(None).cast("string")
    for name, keys in reversed(QUESTION_TYPES_VIEW if view else QUESTION_TYPES):
        test = F.lit(False)
        for k in keys:
            test = test | (q.startswith(k[1:]) if k[0] == "^" else q.contains(k))
        out = F.when(test, name).otherwise(out)
    return out
