"""The keyword index against the search without one; what it reads; reloading."""

import random

from loomline.operators import retrieval

LIBRARY = "seq long, name string, title string, body string"


def library(n=60, seed=1):
    r = random.Random(seed)
    words = ["index", "indexing", "reindex", "dose", "overdose", "table_scan", "scan", "été", "plan9", "x", "ab"]
    pick = lambda k: " ".join(r.choice(words) for _ in range(k))
    return [(i, r.choice((None, "", pick(1), pick(1).upper())), r.choice((None, pick(2))), r.choice((None, "", pick(r.randint(1, 30))))) for i in range(n)]


QUESTIONS = [(0, "How do I reindex a table_scan?"), (1, "dose DOSE overdose"), (2, "nothing here zzz"), (3, None), (4, "the of"), (5, "plan9 scan index")]


def test_index_equals_the_search_and_is_reloaded(spark, tmp_path):
    df = spark.createDataFrame(library(), LIBRARY).repartition(3)
    asked = spark.createDataFrame(QUESTIONS, "query_id int, question string")
    path = str(tmp_path / "k")
    index = retrieval.KeywordIndex.build(df, path)
    want = sorted(map(tuple, retrieval.keyword_search(asked, df, k=4).collect()))
    assert want and sorted(map(tuple, index.search(asked, k=4).collect())) == want
    later = retrieval.KeywordIndex(spark, path)
    assert sorted(map(tuple, later.search(asked, k=4).collect())) == want
    other = spark.createDataFrame(library(20, 7), LIBRARY)
    retrieval.KeywordIndex.build(other, path)
    later.reload()
    assert sorted(map(tuple, later.search(asked, k=4).collect())) == sorted(map(tuple, retrieval.keyword_search(asked, other, k=4).collect()))
    empty = retrieval.KeywordIndex.build(df.limit(0), str(tmp_path / "e"))
    assert empty.search(asked).count() == 0 and later.search(asked.limit(0)).count() == 0


def test_a_search_reads_no_texts(spark, tmp_path):
    df = spark.createDataFrame(library(), LIBRARY)
    index = retrieval.KeywordIndex.build(df, str(tmp_path / "k"))
    found = index.search(spark.createDataFrame(QUESTIONS, "query_id int, question string"))
    files = {f.rpartition("/")[0].rpartition("/")[2] for f in found.inputFiles()}
    assert {x.partition("-")[0] for x in files} <= {"runs", "heads", "held"}
