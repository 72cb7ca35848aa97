"""Sources: CSV with roles, YAML patterns and vocabularies, interaction and training JSONL, pages, log lines.

Files are listed and read by Spark alone, so any store works. Malformed rows and files are skipped.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomline.functions.text import strip
from loomline.operators.memory import RECORD
from loomline.operators.pages import valid_text
from loomline.operators.patterns import ENTRY, PATTERN


def csv_roles(headers: list[str], text: str | None = None, question: str | None = None, answer: str | None = None) -> tuple[str, ...]:
    """The columns that hold (question, answer) or (text,), or () for all columns as one text."""
    if question or answer or text:
        return (question, answer) if question and answer else (text,) if text else ()
    low = [h.lower().strip() for h in headers]
    for pair, sure in ((("question", "answer"), True), (("q", "a"), len(headers) == 2)):
        if sure and all(p in low for p in pair):
            return tuple(headers[low.index(p)] for p in pair)
    if "text" in low:
        return (headers[low.index("text")],)
    return (headers[0],) if len(headers) == 1 else tuple(headers[:2])


def read_csv(spark: SparkSession, path: str, text: str | None = None, question: str | None = None, answer: str | None = None, delimiter: str = ",", encoding: str = "UTF-8") -> dict[str, DataFrame]:
    """{"qa": (question, answer)} or {"texts": (text)}; blank rows go, values are stripped."""
    df = spark.read.csv(path, header=True, sep=delimiter, multiLine=True, escape='"', encoding=encoding)
    roles = csv_roles(df.columns, text, question, answer)
    quoted = [F.col(f"`{r}`") for r in roles]
    if len(roles) == 2:
        out = df.select(strip(quoted[0]).alias("question"), strip(quoted[1]).alias("answer"))
        return {"qa": out.where("question <> '' and answer <> ''")}
    if roles:
        return {"texts": df.select(strip(quoted[0]).alias("text")).where("text <> ''")}
    return {"texts": df.select(strip(F.array_join(F.array(*(strip(f"`{c}`") for c in df.columns)), " ")).alias("text"))}


def _text(v: object) -> str | None:
    return None if v is None else str(v)


def _strings(v: object) -> list[str]:
    return [str(x) for x in v if x is not None] if isinstance(v, list) else [] if v is None else [str(v)]


def _dicts(v: object) -> list[dict]:
    return [x for x in v if isinstance(x, dict)] if isinstance(v, list) else []


def pattern_record(data: dict, source: str) -> dict:
    """A parsed pattern file in the shape of PATTERN; unions become tagged rows."""
    bp = data.get("best_practices")
    if isinstance(bp, dict):
        practices = [{"kind": "map", "key": str(k), "text": str(v)} for k, v in bp.items()]
    elif isinstance(bp, list):
        practices = [{"kind": "list", "key": "", "text": str(x)} for x in bp if x]
    else:
        practices = [{"kind": "text", "key": "", "text": str(bp)}] if bp else []
    templates = data.get("templates")
    examples = []
    for x in data.get("examples") if isinstance(data.get("examples"), list) else []:
        if isinstance(x, dict):
            given = x.get("parameters")
            params = [{"key": str(k), "value": str(v)} for k, v in given.items()] if isinstance(given, dict) else []
            examples.append({"kind": "map", "params": params, **{k: _text(x.get(k)) for k in ("name", "description", "content", "expected_result")}})
        elif isinstance(x, str) and x.strip():
            examples.append({"kind": "text", "content": x, "params": []})
    syntax = data.get("pattern_syntax")
    out = {k: _text(data.get(k)) for k in ("name", "title", "description", "category", "pattern_alias")}
    return out | {
        "use_cases": _strings(data.get("use_cases")), "guardrails": _strings(data.get("guardrails")), "related_patterns": _strings(data.get("related_patterns")), "best_practices": practices, "examples": examples, "source_file": source,
        "parameters": [{**{k: _text(p.get(k)) for k in ("name", "type", "description", "example", "default")}, "required": p.get("required") is not False, "hint": _text(p.get("LLM-HINT") or next((v for k, v in p.items() if "hint" in k.lower()), None))} for p in _dicts(data.get("parameters"))],
        "templates": [{"key": str(k), "description": _text(v.get("description")), "content": _text(v.get("content")), "required_parameters": _strings(v.get("required_parameters"))} for k, v in templates.items() if isinstance(v, dict)] if isinstance(templates, dict) else [],
        "common_errors": [{k: _text(e.get(k)) for k in ("error", "cause", "solution")} for e in _dicts(data.get("common_errors"))],
        "operators": [{k: _text(o.get(k)) for k in ("symbol", "meaning", "example")} for o in _dicts(syntax.get("operators") if isinstance(syntax, dict) else None)],
    }


def _answer(v: object) -> str | None:
    """A field of any shape as one answer: lists by line, maps as key: value."""
    if isinstance(v, str):
        return v.strip() or None
    if isinstance(v, list):
        lines = [x.strip() if isinstance(x, str) else "; ".join(f"{k}: {y}" for k, y in x.items() if isinstance(y, str)) for x in v if isinstance(x, str | dict)]
        return "\n".join(lines) or None
    if isinstance(v, dict):
        return "\n".join(f"{k}: {y}" for k, y in v.items() if isinstance(y, str)) or None
    return _text(v)


def vocabulary_records(data: dict, source: str) -> list[dict]:
    """The entries of a vocabulary file, in order, from lists and one level of maps of lists."""
    meta = data.get("metadata")
    domain = str(meta.get("domain", "general")) if isinstance(meta, dict) else "general"
    lists = [v for k, top in data.items() if k != "metadata" for v in ([top] if isinstance(top, list) else top.values() if isinstance(top, dict) else [])]
    found = [e for v in lists if isinstance(v, list) for e in v if isinstance(e, dict) and "name" in e]
    out = []
    for i, e in enumerate(found):
        examples = (x.get("description") or x.get("content") for x in _dicts(e.get("examples")))
        fields = {k: _answer(e.get(k)) for k in ("category", "description", "one_sentence", "syntax", "null_behavior", "performance_tips", "analysis_notes")}
        out.append({**fields, "entry": i, "domain": domain, "name": _text(e.get("name")), "errors": _answer(e.get("common_errors")), "first_example": next((str(x).strip() for x in examples if x), None), "related": [x for x in e.get("related") or [] if isinstance(x, str)], "source_file": source})
    return out


def read_yaml(spark: SparkSession, path: str, make: Callable[[dict, str], list[dict]], schema: str, recursive: bool = False, glob: str = "*.yaml") -> DataFrame:
    """make() on each YAML mapping under path; a file that doesn't parse gives no rows. Spark lists no files whose names start with _ or a dot."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import yaml

        for batch in batches:
            rows = []
            for source, content in zip(batch["path"], batch["content"]):
                try:
                    data = yaml.safe_load(bytes(content).decode("utf-8", "replace"))
                except yaml.YAMLError:
                    continue
                if isinstance(data, dict):
                    rows += [json.dumps(r, ensure_ascii=False) for r in make(data, source)]
            yield pd.DataFrame({"j": rows}, dtype=object)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).option("pathGlobFilter", glob).load(path).select("path", "content")
    return files.mapInPandas(run, "j string").select(F.from_json("j", schema).alias("r")).select("r.*")


def _named(data: dict, source: str) -> list[dict]:
    return [pattern_record(data, source)] if data.get("name") else []


def read_patterns(spark: SparkSession, path: str) -> DataFrame:
    """All patterns under a folder, at any depth."""
    return read_yaml(spark, path, _named, PATTERN, recursive=True)


def read_library(spark: SparkSession, path: str, glob: str = "*.yaml") -> DataFrame:
    """A flat library folder; files whose name starts with _ aren't entries."""
    return read_yaml(spark, path, _named, PATTERN, glob=glob)


def read_vocabularies(spark: SparkSession, path: str, glob: str = "*_vocabulary.yaml") -> DataFrame:
    return read_yaml(spark, path, vocabulary_records, ENTRY, glob=glob)


def read_interactions(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """The interaction log; blank and malformed lines go."""
    lines = (spark.readStream if stream else spark.read).text(path).where(F.trim("value") != "")
    made = F.from_json("value", RECORD + ", _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    return lines.select(made.alias("r")).where("r is not null and r._bad is null").select("r.*").drop("_bad")


LONG_TERM = f"id string, tier string, relevance double, score_detail map<string,double>, record struct<{', '.join(f'{c.split()[0]}:{c.split()[1]}' for c in RECORD.split(', '))}>"


def read_long_term(spark: SparkSession, path: str) -> DataFrame:
    """Archived interactions; all are of the long-term tier, taken in now. Malformed lines go."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    made = F.from_json("value", LONG_TERM + ", _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    rows = lines.select(made.alias("r")).where("r is not null and r._bad is null").select("r.*").drop("_bad")
    return rows.withColumns({"tier": F.lit("long_term"), "relevance": F.coalesce("relevance", F.lit(0.0)), "ingested_at": F.unix_micros(F.current_timestamp()) / 1e6})


def training_rows(conversations: DataFrame, column: str = "conversations") -> DataFrame:
    """(text) of conversations for a trainer: ROLE: content lines of the usable messages; empty ones go."""
    from loomline.sources.sinks import training_text

    text = F.array_join(F.transform(training_text(F.col(column)), lambda m: F.concat_ws(": ", m["role"], m["content"])), "\n")
    return conversations.select(text.alias("text")).where("text <> ''")


def follow_lines(spark: SparkSession, path: str) -> DataFrame:
    """A stream of the lines that are added to a folder of logs."""
    return spark.readStream.text(path)


def normalised_training(lines: DataFrame, line: str = "value") -> DataFrame:
    """(question, answer) of JSONL rows as conversations (role/content or from/value), instruction/output, or question/answer."""
    turn = "array<struct<role:string,content:string,`from`:string,value:string>>"
    j = F.from_json(line, f"conversations {turn}, instruction string, output string, question string, answer string, prompt string, response string", {"mode": "PERMISSIVE"})

    def first(c: Column, *roles: str) -> Column:
        same = F.filter(c, lambda x: F.coalesce(x["role"], x["from"]).isin(*roles))
        hit = F.try_element_at(same, F.lit(1))
        return F.coalesce(hit["content"], hit["value"], F.lit(""))

    d = lines.where(strip(line) != "").withColumn("_j", j).where("_j is not null")
    talk, task = F.col("_j.conversations").isNotNull(), F.col("_j.instruction").isNotNull() & F.col("_j.output").isNotNull()
    q = F.when(talk, first(F.col("_j.conversations"), "user", "human")).when(task, F.col("_j.instruction")).otherwise(F.coalesce("_j.question", "_j.instruction", "_j.prompt"))
    a = F.when(talk, first(F.col("_j.conversations"), "assistant", "gpt")).when(task, F.col("_j.output")).otherwise(F.coalesce("_j.answer", "_j.output", "_j.response"))
    return d.withColumn("question", q).withColumn("answer", a).drop("_j").where("question is not null or answer is not null")


def read_training(spark: SparkSession, path: str) -> DataFrame:
    return normalised_training(spark.read.text(path)).drop("value")


def read_pages(spark: SparkSession, path: str, parser: Callable[[bytes], list[str]] | None = None, glob: str = "*.pdf") -> DataFrame:
    """(doc, page, text) of binary documents by a pluggable parser (bytes -> texts of pages); without one, of Parquet or JSON with those columns."""
    if parser is None:
        return (spark.read.json(path) if path.endswith((".json", ".jsonl")) else spark.read.parquet(path)).select("doc", "page", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(p, i + 1, t) for p, c in zip(batch["path"], batch["content"]) for i, t in enumerate(parser(bytes(c)))]
            yield pd.DataFrame(rows, columns=["doc", "page", "text"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "content")
    return files.mapInPandas(run, "doc string, page int, text string")


def read_documents(spark: SparkSession, path: str, parsers: Sequence[tuple[str, Callable[[bytes], list[str]]]], glob: str = "*.pdf", least: int = 100) -> DataFrame:
    """(source_file, method, num_pages, pages, full_text) of binary documents by a chain of parsers (name, bytes -> texts of pages).

    A parser's text counts if it has over `least` characters and is valid text; the last one's, by custom optical
    recognition, as it is. A parser that fails gives way to the next; with none left the method is `failed`.
    """
    last = len(parsers) - 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([(p, *_parsed(bytes(c), parsers)) for p, c in zip(batch["path"], batch["content"])], columns=["path", "tried"])

    def _parsed(content: bytes, chain) -> tuple[list[dict]]:
        tried = []
        for i, (name, parse) in enumerate(chain):
            try:
                pages = [t.strip() for t in parse(content)]
            except Exception:  # the next one may do
                continue
            tried.append({"method": name, "final": i == last, "pages": pages})
        return (tried,)

    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "content")
    got = files.mapInPandas(run, "path string, tried array<struct<method:string,final:boolean,pages:array<string>>>")
    text = lambda x: F.array_join(F.filter(x["pages"], lambda t: t != ""), "\n\n")
    good = F.try_element_at(F.filter("tried", lambda x: x["final"] | ((F.length(strip(text(x))) > least) & valid_text(text(x)))), F.lit(1))
    out = got.withColumn("good", good)
    none = F.array().cast("array<string>")
    return out.select(F.regexp_extract("path", r"([^/]*)$", 1).alias("source_file"), F.coalesce("good.method", F.lit("failed")).alias("method"), F.coalesce(F.size("good.pages"), F.lit(0)).alias("num_pages"), F.coalesce("good.pages", none).alias("pages"), F.coalesce(text(F.col("good")), F.lit("")).alias("full_text"))


def read_document_folder(spark: SparkSession, path: str, parsers: Sequence[tuple[str, Callable[[bytes], list[str]]]], glob: str = "*.pdf") -> DataFrame:
    """read_documents() without documents that have no text."""
    return read_documents(spark, path, parsers, glob).where("full_text <> ''")


def read_table(spark: SparkSession, path: str, least: int = 4 << 20) -> DataFrame:
    """A Parquet table. One that is too small for a split a core (its files may hold a single row group, which is one
    task whatever it takes) but above `least` bytes is dealt over the cores; larger ones are read as they lie."""
    df, cores = spark.read.parquet(path), spark.sparkContext.defaultParallelism
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    size = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(place).getLength()
    return df.repartition(cores) if least <= size < cores * least else df


def list_files(spark: SparkSession, path: str, glob: str = "*", recursive: bool = False) -> DataFrame:
    """(name, path, bytes, modified) of the files of a folder, by name; contents aren't read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", recursive).load(path)
    return files.select(F.regexp_extract("path", r"([^/]*)$", 1).alias("name"), "path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified")).orderBy("name", "path")


def uploads(spark: SparkSession, path: str) -> DataFrame:
    """The documents and tables among a folder's files."""
    return list_files(spark, path, "*.{pdf,csv}")


def first_training_file(spark: SparkSession, path: str, name: str = "train_alpaca.jsonl") -> str | None:
    """The path of the first such file: one at the root comes before those of sub-folders, and these go by name."""
    depth = F.size(F.split("path", "/"))
    found = list_files(spark, path, name, True).orderBy(depth, "path").select("path").first()
    return found["path"] if found else None


def artifacts(spark: SparkSession, path: str, metadata: str = "metadata.json") -> DataFrame:
    """(artifact, files, bytes, metadata) of each sub-folder: the number and size of its files, and its metadata file as JSON text."""
    files = list_files(spark, path, "*", True).select(F.regexp_extract("path", r"([^/]*)/[^/]*$", 1).alias("artifact"), "bytes", "path", "name")
    facts = files.groupBy("artifact").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))
    own = files.where(F.col("name") == metadata)
    if own.isEmpty():
        return facts.withColumn("metadata", F.lit(None).cast("string"))
    said = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", metadata).text(path).select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]*)/[^/]*$", 1).alias("artifact"), F.col("value").alias("metadata"))
    return facts.join(said, "artifact", "left")


# What a training log's lines say, and the lines that open its phases.
PHASES = (("loading", r"Loading base model:"), ("lora", r"Adding LoRA adapters"), ("dataset", r"Loading dataset"), ("training", r"Starting training: (\d+) examples"), ("saving", r"Merging LoRA weights"))
STEP, LOSS, METRIC = r"(?:step|Step)\s*[:=]?\s*(\d+)", r"'?(?<!eval_)loss'?\s*[:=]\s*([0-9.]+(?:e-?\d+)?)", r"'?eval_loss'?\s*[:=]\s*([0-9.]+(?:e-?\d+)?)"


def log_metrics(lines: DataFrame, line: str = "value") -> DataFrame:
    """lines with step, loss and eval_loss where they say so, and the phase that a line opens. Works on streams."""
    pick = lambda p, t: F.regexp_extract(line, p, 1).try_cast(t)
    opened = F.lit(None).cast("string")
    for name, pattern in reversed(PHASES):
        opened = F.when(F.col(line).rlike(pattern), name).otherwise(opened)
    return lines.withColumn("step", pick(STEP, "long")).withColumn("loss", pick(LOSS, "double")).withColumn("eval_loss", pick(METRIC, "double")).withColumn("opens", opened)


# What other lines of a training log look like.
EPOCH, PROGRESS = r"--- Epoch (\d+)/(\d+) ---", r"step (\d+)/(\d+) (\d+)%"
WEIGHTS, TRAINABLE = r"Loading weights:\s+(\d+)%", r"trainable params:\s*([\d,]+).*?all params:\s*([\d,]+).*?(\d+\.\d+)%"
#: Plain text that a line with such a match holds; it is looked for first.
SURELY = {p: p.partition(" (")[0] if p.startswith("Starting") else p for _, p in PHASES} | {EPOCH: "--- Epoch ", PROGRESS: "step ", WEIGHTS: "Loading weights:", TRAINABLE: "trainable params:", LOSS: "loss", METRIC: "eval_loss"}
#: What a run's log says of it, by name; those in LOG_FIRST keep their first value, the others their last.
LOG_FIELDS = {
    "phase": "string", "epoch": "long", "epochs": "long", "step": "long", "total_steps": "long", "percent": "double", "n_examples": "long", "weights_percent": "long", "trainable_params": "long", "all_params": "long", "trainable_percent": "double",
    "initial_loss": "double", "loss": "double", "eval_loss": "double", "failed": "string",
}
LOG_FIRST = ("initial_loss", "failed")


def line_fields(lines: DataFrame, line: str = "value") -> DataFrame:
    """lines with those LOG_FIELDS that each of them says. Works on streams."""
    c = F.col(line)
    holds = lambda p: F.lower(c).contains("step") if p == STEP else c.contains(SURELY[p])
    pick = lambda p, i, t: F.when(holds(p), F.replace(F.regexp_extract(c, p, i), F.lit(","), F.lit("")).try_cast(t))
    opened = F.lit(None).cast("string")
    for name, pattern in reversed(PHASES):
        opened = F.when(c.contains(SURELY[pattern]) & c.rlike(pattern), name).otherwise(opened)
    text = strip(c)
    failed = F.when(c.contains("Traceback (most recent call last)"), "error").when(c.contains("Error") & text.startswith("Error") & F.substring(text, 1, 40).contains(":"), text)
    said = {
        "phase": opened, "epoch": pick(EPOCH, 1, "long"), "epochs": pick(EPOCH, 2, "long"), "step": F.coalesce(pick(PROGRESS, 1, "long"), pick(STEP, 1, "long")), "total_steps": pick(PROGRESS, 2, "long"), "percent": pick(PROGRESS, 3, "double"),
        "n_examples": pick(PHASES[3][1], 1, "long"), "weights_percent": pick(WEIGHTS, 1, "long"), "trainable_params": pick(TRAINABLE, 1, "long"), "all_params": pick(TRAINABLE, 2, "long"), "trainable_percent": pick(TRAINABLE, 3, "double"),
        "initial_loss": pick(LOSS, 1, "double"), "loss": pick(LOSS, 1, "double"), "eval_loss": pick(METRIC, 1, "double"), "failed": failed,
    }
    return lines.withColumns(said)


def log_fields(lines: DataFrame, run: str = "run", seq: str = "seq", line: str = "value") -> DataFrame:
    """(run, seq, LOG_FIELDS): each line with what its run's log has said up to it. A run's lines meet in one window."""
    so_far = Window.partitionBy(run).orderBy(seq).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pick = lambda n: F.first if n in LOG_FIRST else F.last
    return line_fields(lines, line).select(run, seq, *(pick(n)(n, ignorenulls=True).over(so_far).alias(n) for n in LOG_FIELDS))


def log_phases(lines: DataFrame, run: str = "run", seq: str = "seq", line: str = "value") -> DataFrame:
    """log_metrics() with the phase and the step that each line of a run falls in: the last ones said before or in it; a run begins with loading, at step 0."""
    so_far = Window.partitionBy(run).orderBy(seq).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = lambda c, first: F.coalesce(F.last(c, ignorenulls=True).over(so_far), F.lit(first))
    return log_metrics(lines, line).withColumn("phase", last("opens", "loading")).withColumn("at_step", last("step", 0)).drop("opens")


def last_matching(lines: DataFrame, pattern: str, n: int = 15, seq: str = "seq", line: str = "value") -> DataFrame:
    """The last n lines that match, newest first: a top-k."""
    return lines.where(F.col(line).rlike(pattern)).orderBy(F.desc(seq)).limit(n)
