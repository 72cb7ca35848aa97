"""The end-to-end preparation job: sources -> chunks -> pairs -> dedup by origin -> shuffle and split -> training files."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomline.functions.config import DATA_PREP, Domain
from loomline.functions.scratch import written
from loomline.operators.chunking import chunks, exploded, structured_chunks
from loomline.operators.curation import dedup_first, pair_fingerprint, split_train_val
from loomline.operators.memory import usable
from loomline.operators.pages import clean_pages, extract_manuals, is_boilerplate, is_index, is_substantive, is_toc, manual_label, question_type, section_parts, stitched
from loomline.operators.patterns import pattern_conversations, pattern_qa, vocabulary_qa
from loomline.operators.qa import chunk_pairs, section_conversation, section_qa
from loomline.sources.sinks import sharegpt, write_training

#: What tells prepared rows apart, of documents and of manuals: the columns of their shuffle.
PAIR_IDS = (("origin_rank", "seq", "question", "answer"), ("doc", "kind", "a", "b", "c", "d"))
TALK_IDS = (("seq", "i"), ("doc", "section"))
PAIRS = ("origin_rank", "origin", "seq", "question", "answer")


def _pairs(df: DataFrame, rank: int, origin: str, order: list) -> DataFrame:
    """The common relation; seq is a struct of positions, turned into text that sorts like it."""
    key = F.concat_ws("/", *(F.lpad(F.coalesce(F.col(c).cast("string"), F.lit("")), 12, "0") if t != "string" else F.col(c) for c, t in order))
    return df.select(F.lit(rank).alias("origin_rank"), F.lit(origin).alias("origin"), key.alias("seq"), "question", "answer")


def document_pairs(docs: DataFrame, doc: str = "doc_id", text: str = "text", source: str = "source", size: int = DATA_PREP["chunk_size"], overlap: int = DATA_PREP["chunk_overlap"], separator: str = "\n\n+", domain: Domain = Domain(), structured: bool = False) -> DataFrame:
    made = structured_chunks(text, size, overlap, domain, separator) if structured else chunks(text, size, overlap, separator)
    rows = exploded(docs.select(doc, F.col(source).alias("_src"), text), made).select(doc, "_src", "seq", F.posexplode(chunk_pairs(F.col("chunk"), F.coalesce("_src", F.lit("doc")), domain)).alias("part", "p"))
    return rows.select(F.col(doc).alias("doc"), F.col("_src").alias("source"), F.col("seq").alias("chunk"), "part", "p.question", "p.answer")


def prepare(documents: DataFrame | None = None, csv: dict[str, DataFrame] | None = None, patterns: DataFrame | None = None, vocabularies: DataFrame | None = None, memory: DataFrame | None = None,
            val_ratio: float = DATA_PREP["val_ratio"], seed: int = DATA_PREP["seed"], domain: Domain = Domain(), separator: str = "\n\n+") -> dict[str, DataFrame]:
    """{"pairs": with split, "multiturn": conversations with split}. Patterns and vocabularies are deduplicated, each on its own."""
    parts, talks = [], []
    if documents is not None:
        d = document_pairs(documents, domain=domain, separator=separator)
        parts.append(_pairs(d, 0, "documents", [("doc", "long"), ("chunk", "long"), ("part", "long")]))
    if csv is not None and "qa" in csv:
        parts.append(_pairs(csv["qa"].withColumn("_i", F.monotonically_increasing_id()), 1, "csv", [("_i", "long")]))
    elif csv is not None:
        texts = csv["texts"].withColumn("doc_id", F.monotonically_increasing_id()).withColumn("source", F.lit("csv"))
        parts.append(_pairs(document_pairs(texts, domain=domain, separator=separator), 1, "csv", [("doc", "long"), ("chunk", "long"), ("part", "long")]))
    if patterns is not None:
        made = _pairs(pattern_qa(patterns, ["source_file"], domain), 2, "patterns", [("source_file", "string"), ("block_no", "long"), ("item", "long"), ("sub", "long"), ("pos", "long")])
        parts.append(dedup_first(made))
        talks.append(patterns.select(F.concat(F.lit("1/"), "source_file").alias("seq"), F.posexplode(pattern_conversations()).alias("i", "conversations")))
    if vocabularies is not None:
        made = _pairs(vocabulary_qa(vocabularies), 3, "vocabulary", [("source_file", "string"), ("entry", "long"), ("block_no", "long"), ("item", "long"), ("sub", "long"), ("pos", "long")])
        made = dedup_first(made)
        parts.append(made)
        talks.append(made.select(F.concat(F.lit("0/"), "seq").alias("seq"), F.lit(0).alias("i"), sharegpt()))
    if memory is not None:
        made = _pairs(usable(memory), 4, "memory", [("timestamp", "string"), ("id", "string")])
        parts.append(made)
        talks.append(made.select(F.concat(F.lit("2/"), "seq").alias("seq"), F.lit(0).alias("i"), sharegpt()))
    out: dict[str, DataFrame] = {}
    for name, tables, ids in (("pairs", parts, PAIR_IDS[0]), ("multiturn", talks, TALK_IDS[0])):
        if tables:
            whole = tables[0]
            for t in tables[1:]:
                whole = whole.unionByName(t)
            out[name] = split_train_val(whole, ids, val_ratio, seed)
    return out


def prepare_manuals(pages: DataFrame, domain: Domain = Domain(), val_ratio: float = DATA_PREP["val_ratio"], seed: int = DATA_PREP["seed"]) -> dict[str, DataFrame]:
    """Manuals (doc, page, text) -> their sections' and chunks' pairs and conversations, deduplicated by manual, with label and split."""
    got = extract_manuals(pages)
    typed = section_qa(got["sections"], ["doc", "section"], domain=domain).select("doc", F.lit(0).alias("kind"), F.col("section").alias("a"), F.col("block_no").alias("b"), F.col("item").alias("c"), F.col("pos").alias("d"), "question", "answer")
    plain = document_pairs(got["documents"].withColumn("src", F.col("doc")), "doc", "full_text", "src", domain=domain, structured=True)
    plain = plain.select("doc", F.lit(1).alias("kind"), F.col("chunk").cast("long").alias("a"), F.col("part").alias("b"), F.lit(0).alias("c"), F.lit(0).alias("d"), "question", "answer")
    pairs = typed.unionByName(plain).withColumn("seq", F.struct("kind", "a", "b", "c", "d"))
    pairs = dedup_first(pairs, within=["doc"]).withColumn("label", manual_label("doc")).drop("seq")
    talks = got["sections"].select("doc", "section", section_conversation(F.col("heading"), section_parts("text")).alias("conversations")).where("conversations is not null").withColumn("label", manual_label("doc"))
    return {"pairs": split_train_val(pairs, PAIR_IDS[1], val_ratio, seed), "multiturn": split_train_val(talks, TALK_IDS[1], val_ratio, seed), **got}


def write(prepared: dict[str, DataFrame], path: str, formats: tuple[str, ...] = ("alpaca", "sharegpt"), by: tuple[str, ...] = ("split",), seed: int = DATA_PREP["seed"]) -> None:
    """Training files in the order of the shuffle that the rows were split by; rows of another shape lie as they come."""
    def ids(df: DataFrame | None, known: tuple[tuple[str, ...], ...]) -> tuple[str, ...]:
        return next((k for k in known if df is not None and set(k) <= set(df.columns)), ())

    pairs, talks = prepared["pairs"], prepared.get("multiturn")
    write_training(pairs, path, formats, talks, by, ids(pairs, PAIR_IDS), ids(talks, TALK_IDS), seed)


def report(pages: DataFrame, domain: Domain = Domain(), size: int = DATA_PREP["chunk_size"], overlap: int = DATA_PREP["chunk_overlap"], **skip: bool) -> DataFrame:
    """(stage, name, n, min_chars, avg_chars, max_chars): what extraction keeps at each stage, pages by class, questions by
    kind before and after deduplication, and chunks with and without regard to structure, all and structured ones.

    Each table is made once and gives all rows that are counted of it."""
    tests = (("toc", is_toc), ("boilerplate", is_boilerplate), ("index", is_index))
    line = lambda stage, name, text=None: F.struct(F.lit(stage).alias("stage"), (F.lit(name) if isinstance(name, str) else name).alias("name"), (F.lit(None).cast("int") if text is None else F.length(text)).alias("chars"))
    counted = lambda df, lines: df.select(F.explode(F.filter(lines, lambda x: x.isNotNull())).alias("l")).select("l.*")

    raw = F.array(line("pages", "all", F.coalesce("text", F.lit(""))), *(F.when(test("text"), line("pages", name)) for name, test in tests), F.when(~is_substantive("text"), line("pages", "not substantive")))
    clean, running = clean_pages(pages, **skip)
    clean = written(clean.select("doc", "page", "text"), "clean")  # three steps read it
    got = stitched(pages.select("doc"), clean)
    talk = section_conversation(F.col("heading"), section_parts("text"))
    rows = [
        counted(pages, raw), counted(clean, F.array(line("pages", "kept", F.col("text")))), counted(running, F.array(line("running lines", F.col("side")))),
        counted(got["sections"], F.array(line("sections", "all", F.col("text")), F.when(talk.isNotNull(), line("conversations", "all")))),
    ]

    # what is told of a question is found before its row is dealt by fingerprint, so no text is dealt
    typed = section_qa(got["sections"], ["doc", "section"], domain=domain)
    small = typed.select("doc", F.struct("section", "block_no", "item", "pos").alias("seq"), pair_fingerprint("question", "answer").alias("fp"), F.length("answer").alias("chars"), question_type("question").alias("kind"))
    first = small.withColumn("first", F.row_number().over(Window.partitionBy("doc", "fp").orderBy("seq")) == 1)
    said = lambda name: F.struct(F.lit("questions").alias("stage"), F.lit(name).alias("name"), F.col("chars"))
    rows.append(counted(first, F.array(said("all"), F.when(F.col("first"), said("different")), F.when(F.col("first"), line("question kinds", F.col("kind"))))))

    made = got["documents"].select("full_text", chunks("full_text", size, overlap).alias("plain"), structured_chunks("full_text", size, overlap, domain).alias("aware"))
    told = lambda name: F.flatten(F.transform(name, lambda c: F.array(line("chunks", name, c), F.when(domain.structured(c), line("chunks", f"{name}, structured", c)))))
    rows.append(counted(made, F.concat(F.array(line("documents", "all", F.col("full_text"))), told("plain"), told("aware"))))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.groupBy("stage", "name").agg(F.count("*").alias("n"), F.min("chars").alias("min_chars"), F.avg("chars").alias("avg_chars"), F.max("chars").alias("max_chars"))
