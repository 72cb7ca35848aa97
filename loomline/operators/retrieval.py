"""Retrieval: keyword scores, TF-IDF and dense cosines, context blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomline.functions.scratch import written
from loomline.functions.text import first_nonempty, let, nonempty, sentences, strip, tokens

# Fixed values.
KEYWORD_STOP = [
    "a", "an", "the", "is", "are", "was", "were", "be", "been", "being", "have", "has", "had", "do", "does", "did", "will", "would", "could",
    "should", "may", "might", "can", "to", "of", "in", "on", "at", "by", "for", "with", "about", "as", "into", "through", "and", "or", "but", "not",
    "what", "when", "how", "why", "which", "who", "where", "show", "me", "an", "example", "give", "tell", "explain", "describe", "use", "used",
    "using", "define", "i", "my", "you", "your", "sql", "query", "function", "it", "this", "that", "if",
]
TFIDF_STOP = [
    "a", "an", "the", "is", "are", "was", "were", "be", "been", "have", "has", "had", "do", "does", "did", "will", "would", "could", "should", "may",
    "might", "can", "to", "of", "in", "on", "at", "by", "for", "with", "about", "as", "into", "through", "and", "or", "but", "not", "this", "that",
    "if", "it", "its", "from", "also", "use", "used", "using",
]
TOKEN = "[a-zA-Z][a-zA-Z0-9_]*"


def terms(text: Column | str, stop: list[str]) -> Column:
    words = F.array(*map(F.lit, dict.fromkeys(stop)))
    return F.filter(tokens(text, TOKEN), lambda t: (F.length(t) > 2) & ~F.array_contains(words, t))


def query_terms(text: Column | str) -> Column:
    return terms(text, KEYWORD_STOP)


def keyword_score(found: Column, name: Column, title: Column, body: Column) -> Column:
    """10 for a term that is the name or title, 5 for one inside them, 1 for one in the body. All in lower case."""
    return F.aggregate(found, F.lit(0), lambda s, t: s + term_points(t, name, title, body))


def term_points(t: Column, name: Column, title: Column, body: Column) -> Column:
    return F.when((t == name) | (t == title), 10).when(name.contains(t) | title.contains(t), 5).when(body.contains(t), 1).otherwise(0)


def keyword_search(questions: DataFrame, library: DataFrame, question: str = "question", by: str = "query_id", k: int = 2, min_score: int = 3) -> DataFrame:
    """(by, seq, score, rank): for each question the k library rows (name, title, body, seq) of highest score, and of those the ones that reach min_score.

    A term matches inside words, and only inside a run of its own characters. So terms are looked for in the library's
    different runs, names and titles: a term meets those that hold its rarest three characters, by a join, and then has
    to be in them. Rows meet the terms by their runs, names and titles.
    """
    runs, heads = _runs(library), _heads(library)
    asked = _asked(questions, question, by)
    wanted = asked.select("term").distinct()
    held = [written(holding(x.select("string").distinct(), wanted), "held") for x in (runs, heads)]  # tables of their own: Spark sends them to all tasks where it finds them small
    return _keyword_ranked(asked, runs.join(held[0], "string"), heads.join(held[1], "string"), by, k, min_score, _parts(library.agg(F.sum(F.length("body"))).first()[0], PART_CHARS))


PART_CHARS, PART_RUNS = 4 << 20, 400_000  # of a task


def _parts(size: int | None, each: int) -> int:
    """So many tasks that each has a bounded share, whatever the library's size."""
    return max(1, -(-(size or 0) // each))


def _asked(questions: DataFrame, question: str, by: str) -> DataFrame:
    return questions.select(by, F.explode(query_terms(question)).alias("term")).groupBy(by, "term").agg(F.count("*").alias("times"))


def _runs(library: DataFrame) -> DataFrame:
    """(seq, string): the runs of characters of which terms are made, of each body."""
    return library.select("seq", F.explode(F.array_distinct(tokens("body", "[a-z0-9_]{3,}"))).alias("string"))


def _heads(library: DataFrame) -> DataFrame:
    return library.select("seq", F.explode(F.array(*(F.lower(F.coalesce(c, F.lit(""))) for c in ("name", "title")))).alias("string"))


def _keyword_ranked(asked: DataFrame, inside: DataFrame, headed: DataFrame, by: str, k: int, min_score: int, parts: int) -> DataFrame:
    """(by, seq, score, rank) from the rows (seq, string, term) that hold terms in their bodies' runs and in their names or titles.

    Rows are dealt once, by seq; a library row's terms, and its scores for all questions, meet in its task. Of these only
    each task's k best a question go on.
    """
    points = F.when(F.col("term") == F.col("string"), 10).otherwise(5)
    found = inside.select("seq", "term", F.lit(1).alias("points")).unionByName(headed.select("seq", "term", points.alias("points"))).repartition(parts, "seq").groupBy("seq", "term").agg(F.max("points").alias("points"))
    scored = found.join(asked, "term").groupBy(by, "seq").agg(F.sum(F.col("points") * F.col("times")).cast("int").alias("score"))
    best = scored.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(F.desc("score"), "seq"))).where(F.col("rank") <= k)
    return best.where(F.col("score") >= min_score)


def _grams(c: str) -> Column:
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - 2), lambda i: F.substring(F.col(c), i, F.lit(3))))


def gram_postings(strings: DataFrame) -> DataFrame:
    """(string, gram): the distinct three characters that follow one another in each string."""
    return strings.where(F.length("string") > 2).select("string", F.explode(_grams("string")).alias("gram"))


def holding(strings: DataFrame, wanted: DataFrame) -> DataFrame:
    """(string, term): the distinct strings that hold each of the distinct terms, of three characters or more."""
    return posted(gram_postings(strings), wanted)


def posted(grams: DataFrame, wanted: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """holding() from the strings' postings. counts: how many each gram has, if that is known."""
    of = wanted.select("term", F.explode(_grams("term")).alias("gram"))
    times = counts if counts is not None else grams.join(of.select("gram").distinct(), "gram", "left_semi").groupBy("gram").agg(F.count("*").alias("times"))
    # a term with three characters that no string holds is in none
    rarest = of.join(times, "gram", "left").groupBy("term").agg(F.min_by("gram", F.struct(F.coalesce("times", F.lit(0)).alias("n"), F.col("gram").alias("g"))).alias("gram"))
    return grams.join(rarest, "gram").where(F.contains("string", "term")).select("string", "term")


class KeywordIndex:
    """keyword_search() over a library whose strings are indexed under a folder: their three-character grams with counts, and the rows that have them.

    A search reads counts of the terms' grams, the postings of each term's rarest one, and the rows of the strings that
    hold a term; no text of the library. Tables are sorted, so that it reads few row groups of them, and dealt by ranges
    of (gram, string), so that a frequent gram has several files. A session that finds the folder opens it.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.reload()

    @classmethod
    def build(cls, library: DataFrame, path: str) -> KeywordIndex:
        """A new index of library rows (name, title, body, seq); an older one at the path gives way."""
        spark = library.sparkSession

        def put(df: DataFrame, name: str, *order: str) -> DataFrame:
            df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(f"{path}/{name}")
            return spark.read.parquet(f"{path}/{name}")

        runs, heads = put(_runs(library), "runs", "string", "seq"), put(_heads(library), "heads", "string", "seq")
        grams = put(gram_postings(runs.select("string").union(heads.select("string")).distinct()), "grams", "gram", "string")
        put(grams.groupBy("gram").agg(F.count("*").alias("times")), "counts", "gram")
        return cls(spark, path)

    def reload(self) -> None:
        """Forget what was read; the next search sees the folder as it is then."""
        self._read: dict[str, DataFrame] = {}

    def _table(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.path}/{name}")
        return self._read[name]

    def search(self, questions: DataFrame, question: str = "question", by: str = "query_id", k: int = 2, min_score: int = 3) -> DataFrame:
        """As keyword_search() over the library of the index."""
        asked = _asked(questions, question, by)
        held = written(posted(self._table("grams"), asked.select("term").distinct(), self._table("counts")), "held")
        return _keyword_ranked(asked, self._table("runs").join(held, "string"), self._table("heads").join(held, "string"), by, k, min_score, _parts(self._table("runs").count(), PART_RUNS))


def term_counts(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """(doc, term, c, n): counts of each term, and the document's number of terms. Dealt by term: what goes on by term moves no row again.

    A row's terms are counted where it lies, as runs of their sorted array, so that a shuffle has a row for each
    different term.
    """
    starts = lambda s: F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
    run = lambda s, at: F.transform(at, lambda i, k: F.struct(F.get(s, i).alias("term"), (F.coalesce(F.get(at, k + 1), F.size(s)) - i).cast("long").alias("c")))
    t = docs.select(doc, F.sort_array(terms(text, TFIDF_STOP)).alias("t")).where(F.size("t") > 0)
    rows = t.select(doc, F.size("t").alias("n"), F.inline(let(F.col("t"), lambda s: let(starts(s), lambda at: run(s, at)))))
    return rows.repartition("term").groupBy(doc, "term", "n").agg(F.sum("c").alias("c"))


def term_weights(docs: DataFrame, n_docs: int, doc: str, text: str) -> DataFrame:
    """(doc, term, w, df, idf) by one shuffle of the counts; sorted by term."""
    counts = term_counts(docs, doc, text).withColumn("df", F.count("*").over(Window.partitionBy("term")))
    d = counts.withColumn("idf", _idf(n_docs, F.col("df")))
    return d.select(doc, "term", (F.col("c") / F.col("n") * F.col("idf")).alias("w"), "df", "idf")


def _idf(n_docs: int, df: Column) -> Column:
    return F.log((F.lit(n_docs) + 1.0) / (df + 1.0)) + 1.0


def document_frequency(counts: DataFrame, n_docs: int) -> DataFrame:
    """(term, df, idf)"""
    d = counts.groupBy("term").agg(F.count("*").alias("df"))
    return d.withColumn("idf", _idf(n_docs, F.col("df")))


def tfidf(counts: DataFrame, frequency: DataFrame, n_docs: int, doc: str) -> DataFrame:
    """(doc, term, w); terms no document has count as df 0."""
    unseen = F.log(F.lit(n_docs) + 1.0) + 1.0
    return counts.join(frequency, "term", "left").select(doc, "term", (F.col("c") / F.col("n") * F.coalesce("idf", unseen)).alias("w"))


def tfidf_search(queries: DataFrame, docs: DataFrame, query_id: str, query: str, doc: str, text: str, k: int = 3, min_score: float = 0.05) -> DataFrame:
    """(query_id, doc, score, rank) of the k documents of highest cosine, kept where it reaches min_score. Queries without shared terms get none."""
    n = docs.count()
    weights = written(term_weights(docs, n, doc, text), "weights")  # several steps read them, and Spark splits a frequent term's join
    return _searched(queries, weights.select(doc, "term", "w"), _frequency(weights), n, query_id, query, doc, k, min_score)


def _frequency(weights: DataFrame) -> DataFrame:
    return weights.groupBy("term").agg(F.first("df").alias("df"), F.first("idf").alias("idf"))


def _searched(queries: DataFrame, weights: DataFrame, idf: DataFrame, n: int, query_id: str, query: str, doc: str, k: int, min_score: float, norms: DataFrame | None = None) -> DataFrame:
    """Norms are one aggregate over all weights; only the weights of the queries' terms meet the queries, whose table Spark sends to all tasks where it finds it small."""
    norm = lambda w, i, name: w.groupBy(i).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias(name))
    qw = written(tfidf(term_counts(queries, query_id, query), idf, n, query_id), "asked")
    dots = qw.withColumnRenamed("w", "qw").join(weights, "term").groupBy(query_id, doc).agg(F.sum(F.col("qw") * F.col("w")).alias("dot"))
    scored = dots.join(norm(weights, doc, "dn") if norms is None else norms, doc).join(norm(qw, query_id, "qn"), query_id).withColumn("score", F.round(F.col("dot") / (F.col("dn") * F.col("qn")), 4))
    best = scored.withColumn("rank", F.row_number().over(Window.partitionBy(query_id).orderBy(F.desc("score"), F.asc(doc)))).where(F.col("rank") <= k)
    return best.where(F.col("score") >= min_score).select(query_id, doc, "score", "rank")


class TfidfIndex:
    """Term weights, document frequencies and norms under a folder, made once and read by each search; a session that finds the folder opens it without the documents."""

    def __init__(self, spark: SparkSession, path: str, doc: str = "doc"):
        self.spark, self.path, self.doc = spark, path, doc
        self.reload()

    @classmethod
    def build(cls, docs: DataFrame, path: str, doc: str, text: str) -> TfidfIndex:
        """A new index of docs; an older one at the path gives way."""
        n = docs.count()
        term_weights(docs, n, doc, text).sortWithinPartitions("term").write.mode("overwrite").parquet(f"{path}/weights")  # a search reads few row groups
        weights = docs.sparkSession.read.parquet(f"{path}/weights")
        _frequency(weights).withColumn("documents", F.lit(n)).write.mode("overwrite").parquet(f"{path}/frequency")
        weights.groupBy(doc).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("dn")).write.mode("overwrite").parquet(f"{path}/norms")
        return cls(docs.sparkSession, path, doc)

    def reload(self) -> None:
        """Forget what was read; the next search sees the folder as it is then."""
        self._read: dict[str, DataFrame] = {}

    def _table(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.path}/{name}")
        return self._read[name]

    def search(self, queries: DataFrame, query_id: str, query: str, k: int = 3, min_score: float = 0.05) -> DataFrame:
        """As tfidf_search() over the documents of the index."""
        frequency = self._table("frequency")
        n = frequency.agg(F.max("documents")).first()[0] or 0
        return _searched(queries, self._table("weights").select(self.doc, "term", "w"), frequency.drop("documents"), n, query_id, query, self.doc, k, min_score, self._table("norms"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def dense_cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)) + 1e-9)


VECTORS, QUERIES = 1024, 256  # a block


def _blocks(vectors: DataFrame, key: str, vector: str, rows: int, prefix: str) -> DataFrame:
    """Vectors packed as matrices of at most `rows` of one length: (ids, dim, matrix), names with the prefix. Vectors that are null or hold null or non-finite components are left out."""
    held = vectors.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v")).where(F.col("id").isNotNull() & F.forall("v", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))))
    ids = held.schema["id"].dataType.simpleString()

    def pack(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            v, dims = batch.column("v"), np.diff(batch.column("v").offsets.to_numpy())
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                for lo in range(0, len(at), rows):
                    mine = pa.array(at[lo : lo + rows])
                    matrix = v.take(mine).flatten().to_numpy(zero_copy_only=False)
                    yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays([0, len(mine)], batch.column("id").take(mine)), pa.array([int(dim)], pa.int32()), pa.array([matrix.tobytes()])], names=[f"{prefix}ids", f"{prefix}dim", f"{prefix}matrix"])

    return held.mapInArrow(pack, f"{prefix}ids array<{ids}>, {prefix}dim int, {prefix}matrix binary")


def _dots(a, b):
    """Sums of products of the rows of a and b, added in the order of components as dot() adds them."""
    import numpy as np

    out = np.zeros(len(a))
    for d in range(a.shape[1]):
        out += a[:, d] * b[:, d]
    return out


def _nearest(q, v, k: int, min_score: float):
    """(query, vector, score): the pairs of a block's rows that may be among a query's k best by score at four places, then by the lower row; few more.

    One matrix product gives scores to within rounding; those near the k-th or above are computed anew as the expressions
    compute them. Of rows with one score at four places the first k are enough, so copies of a vector don't add rows.
    """
    import numpy as np

    norm_q, norm_v = np.sqrt(_dots(q, q)), np.sqrt(_dots(v, v))
    with np.errstate(over="ignore", invalid="ignore"):
        near = (q @ v.T) / (np.outer(norm_q, norm_v) + 1e-9)
    near[~np.isfinite(near)] = np.inf  # out of range: computed anew
    cut = np.full(len(q), -np.inf) if len(v) <= k else np.partition(near, len(v) - k, axis=1)[:, len(v) - k]
    i, j = np.nonzero(near >= np.maximum(cut - 1.1e-4, min_score - 1.1e-4)[:, None])
    with np.errstate(over="ignore", invalid="ignore"):
        score = _dots(q[i], v[j]) / (norm_q[i] * norm_v[j] + 1e-9)
    places = score * 1e4
    sure = np.abs(places - np.floor(places) - 0.5) > 1e-6  # else the rounding is left to Spark
    same = np.where(sure, np.floor(places + 0.5), score)
    order = np.lexsort((j, same, sure, i))
    i, j, score, sure, same = (x[order] for x in (i, j, score, sure, same))
    new = np.ones(len(i), bool)
    new[1:] = (i[1:] != i[:-1]) | (sure[1:] != sure[:-1]) | (same[1:] != same[:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(len(i)), 0))
    keep = np.arange(len(i)) - first < k
    return i[keep], j[keep], score[keep]


def dense_search(queries: DataFrame, vectors: DataFrame, query_id: str = "query_id", vec_id: str = "vec_id", k: int = 3, min_score: float = 0.05) -> DataFrame:
    """The k nearest vectors of each query vector (columns qv and embedding): stated queries against all rows, block by block.

    Both sides are packed as matrices where they lie; a block of vectors meets each block of queries in one product, of
    which only what may be among a query's k best leaves the task. So work is the product itself, and rows are the
    queries' times the blocks of vectors. The queries' blocks are a written table: Spark sends it to all tasks where it
    finds it small, and else deals pairs of partitions. Vectors that are null or hold null or non-finite components, and
    those of another length than a query's, aren't found.
    """
    asked = written(_blocks(queries, query_id, "qv", QUERIES, "q_"), "queries")
    held = _blocks(vectors.select(vec_id, "embedding").sortWithinPartitions(vec_id), vec_id, "embedding", VECTORS, "v_")  # rows of a block in the order that ties follow
    q_type, v_type = queries.schema[query_id].dataType, vectors.schema[vec_id].dataType

    def meet(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for n in range(batch.num_rows):
                x = {c: batch.column(c)[n] for c in batch.schema.names}
                dim = x["q_dim"].as_py()
                if dim == 0 or dim != x["v_dim"].as_py():
                    continue
                q, v = (np.frombuffer(x[f"{s}_matrix"].as_buffer(), np.float64).reshape(-1, dim) for s in "qv")
                i, j, score = _nearest(q, v, k, min_score)
                yield pa.RecordBatch.from_arrays([x["q_ids"].values.take(pa.array(i)), x["v_ids"].values.take(pa.array(j)), pa.array(score)], names=["q", "v", "s"])

    found = held.crossJoin(asked).mapInArrow(meet, f"q {q_type.simpleString()}, v {v_type.simpleString()}, s double")
    scored = found.select(F.col("q").alias(query_id), F.col("v").alias(vec_id), F.round("s", 4).alias("score")).where(F.col("score") >= min_score)
    return scored.withColumn("rank", F.row_number().over(Window.partitionBy(query_id).orderBy(F.desc("score"), F.asc(vec_id)))).where(F.col("rank") <= k)


def _template(p: str = "templates") -> Column:
    """The first template's content, or empty."""
    return F.coalesce(strip(F.try_element_at(F.col(p), F.lit(1))["content"]), F.lit(""))


def context_block(similarity: Column | None = None) -> Column:
    """A library row as prompt text: keyword form, or the similarity form with its score."""
    title = first_nonempty(F.col("title"), F.col("name"))
    desc = strip("description")
    cases, params, errors = (F.coalesce(F.col(c), F.array().cast(t)) for c, t in (("use_cases", "array<string>"), ("parameters", PARAMETERS), ("common_errors", ERRORS)))
    body = _template()
    if similarity is not None:
        return F.array_join(F.array_compact(F.array(
            F.format_string("### %s  (similarity: %.2f)", title, similarity), F.when(desc != "", F.array_join(F.slice(sentences(desc), 1, 2), " ")),
            F.when(F.size(cases) > 0, F.concat(F.lit("Use cases: "), F.array_join(F.slice(cases, 1, 3), "; "))), F.when(body != "", F.concat(F.lit("Example:\n```\n"), body, F.lit("\n```"))),
        )), "\n")
    names = F.filter(F.transform(params, lambda p: p["name"]), nonempty)
    shown = F.transform(F.filter(F.slice(errors, 1, 2), lambda e: nonempty(e["error"])), lambda e: F.concat(F.lit("- "), e["error"], F.lit(": "), F.coalesce(e["solution"], F.lit(""))))
    return F.array_join(F.array_compact(F.array(
        F.concat(F.lit("### "), title), F.when(desc != "", F.array_join(F.slice(sentences(desc), 1, 3), "\n")), F.when(F.size(cases) > 0, F.concat(F.lit("Use cases: "), F.array_join(F.slice(cases, 1, 5), "; "))),
        F.when(F.size(names) > 0, F.concat(F.lit("Parameters: "), F.array_join(names, ", "))), F.when(body != "", F.concat(F.lit("Worked example:\n"), body)), F.when(F.size(shown) > 0, F.concat(F.lit("Common errors:\n"), F.array_join(shown, "\n"))),
    )), "\n")


PARAMETERS = "array<struct<name:string,type:string,required:boolean,description:string,example:string,default:string,hint:string>>"
ERRORS = "array<struct<error:string,cause:string,solution:string>>"
# The headers.
KEYWORD_HEADER = "The following knowledge library entries are relevant to this question. Use them as the authoritative source for your answer:\n\n"
SIMILARITY_HEADER = "Relevant knowledge patterns (ranked by semantic similarity):\n\n"


def contexts(found: DataFrame, by: str, header: str = KEYWORD_HEADER) -> DataFrame:
    """(by, context) from rows with `rank` and `block`."""
    blocks = F.transform(F.array_sort(F.collect_list(F.struct("rank", "block"))), lambda x: x["block"])
    return found.groupBy(by).agg(F.concat(F.lit(header), F.array_join(blocks, "\n\n---\n\n")).alias("context"))


def searchable(p: DataFrame) -> Column:
    """A library row's text for keyword search, in lower case."""
    strings = [F.col(c) for c, t in p.dtypes if t == "string"]
    cases = F.array_join(F.coalesce("use_cases", F.array().cast("array<string>")), " ")
    params = F.array_join(F.transform(F.coalesce("parameters", F.array().cast(PARAMETERS)), lambda x: F.concat_ws(" ", x["name"], x["description"])), " ")
    return F.lower(F.array_join(F.filter(F.array(*strings, cases, params), nonempty), " "))


def pattern_text(p: DataFrame) -> Column:
    """A library row's text for TF-IDF: string fields, lists, and the start of the first template."""
    strings = [F.col(c) for c, t in p.dtypes if t == "string"]
    lists = [F.array_join(F.coalesce(c, F.array().cast("array<string>")), " ") for c, t in p.dtypes if t == "array<string>"]
    return F.array_join(F.filter(F.array(*strings, *lists, F.substring(_template(), 1, 200)), nonempty), " ")
