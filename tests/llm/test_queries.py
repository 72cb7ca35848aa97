"""The training-data queries against their SQL on the driver's smallest tables, where they are there."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from loomline.llm import media, pii, toxicity
from loomline.llm.queries import ORACLES, QUERIES
from tests.llm import cases
from tests.test_queries import DATA, duck, table  # noqa: F401

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


@pytest.mark.parametrize("name", [*sorted(QUERIES), "pipeline"])
def test_query(spark, duck, name):  # noqa: F811
    df = (QUERIES | {"pipeline": corpus_pipeline.run})[name](spark, str(DATA))
    rows = df.collect()
    if name in ORACLES:
        want = duck.sql(ORACLES[name])
        assert sorted(df.columns) == sorted(want.columns)
        assert table(df.columns, rows) == table(want.columns, want.fetchall())
    else:
        assert rows


def test_stages_are_declared():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "pii", "mixing", "packing"]


def test_entry_has_them_all_and_hides_no_failure(monkeypatch):
    import sys

    import __spark_entry__ as entry

    assert {*QUERIES, "pipeline"} < set(entry.queries()) and set(ORACLES) < set(entry.oracle_sql())
    monkeypatch.setattr(entry, "find_spec", lambda name: None if name == "corpus_pipeline" else True)
    assert set(QUERIES) < set(entry.queries()) and "pipeline" not in entry.queries()
    monkeypatch.setattr(entry, "find_spec", lambda name: None)
    assert not {*QUERIES, "pipeline"} & set(entry.queries())
    monkeypatch.setattr(entry, "find_spec", lambda name: True)
    monkeypatch.setitem(sys.modules, "loomline.llm.queries", None)
    with pytest.raises(ImportError):
        entry.queries()


@pytest.fixture(scope="module")
def texts(duck):  # noqa: F811
    return {i: t or "" for i, t in duck.sql("select doc_id, text from documents").fetchall()}


def test_op1_by_brute_force(spark, texts):
    """Base columns against the plain patterns; added spans are plausible and clear of base spans."""
    got = QUERIES["op1_pii"](spark, str(DATA)).collect()
    assert len(got) == len(texts)
    for r in got:
        base = cases.base_spans(texts[r.doc_id], cases.PII)
        said = [f"{n}:{a}:{b}" for n, a, b in base]
        assert r.base_sha256 == hashlib.sha256(",".join(said).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(n == k for n, _, _ in base) for k in pii.KINDS)
        spans = [x for x in r.spans.split(",") if x]
        added = list((Counter(spans) - Counter(said)).elements())
        assert len(added) == r.n_added == len(spans) - len(said)
        for kind, a, b in (x.split(":") for x in added):
            a, b = int(a), int(b)
            assert pii.plausible(pii.KINDS.index(kind), texts[r.doc_id][a:b]) and not any(x < b and a < y for _, x, y in base)


def test_op5_by_brute_force(spark, texts):
    for r in QUERIES["op5_media"](spark, str(DATA)).collect():
        raw = texts[r.doc_id].encode()
        body = raw + b"\xff" * (-len(raw) % 576 if raw else 576)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(body), hashlib.sha256(body).hexdigest(), zlib.crc32(body[-32:]))
        png = media.png_encode(np.frombuffer(body, np.uint8).reshape(-1, 24), None)
        assert (r.media_bytes, r.media_sha256) == (len(png), hashlib.sha256(png).hexdigest())


def test_op6_by_brute_force(spark, texts):
    """Every score from the model's weights, document by document, word by word."""
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    got = QUERIES["op6_toxicity"](spark, str(DATA)).collect()
    assert len(got) == len(texts)
    for r in got:
        words = {w for w in texts[r.doc_id].split(" ")}
        ids, _, _ = toxicity.features(pa.array([texts[r.doc_id]]))
        assert len(set(ids.tolist())) == len(ids) and (len(ids) > 0) == any(w.strip() for w in words)
        s = math.fsum(model.weights[i] for i in ids.tolist())
        above = [1 / (1 + math.exp(min(500, max(-500, t - s)))) for t in model.thresholds]
        levels = [1 - above[0], *(a - b for a, b in zip(above, above[1:])), above[-1]]
        assert math.isclose(r.p_toxic, above[0], abs_tol=1e-9) and math.isclose(r.expected_severity, sum(above), abs_tol=1e-9)
        assert math.isclose(max(levels), levels[r.grade], abs_tol=1e-9) and (r.toxic == (above[0] > model.cut) or math.isclose(above[0], model.cut, abs_tol=1e-9))


def test_op8_by_brute_force(spark, texts):
    """Each document's ids by the named tokenizer, in pieces that lie gapless in full sequences."""
    import public_tokenizers as P
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    ids = {i: [*t.encode(x, add_special_tokens=False).ids, 0] for i, x in texts.items()}
    at, sequences = Counter(), {}
    for r in sorted(QUERIES["op8_pack"](spark, str(DATA)).collect(), key=lambda r: (r.doc_id, r.start)):
        part = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4")
        assert r.start == at[r.doc_id] and r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == zlib.crc32(part.tobytes())
        at[r.doc_id] += r.length
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length, r.tier))
    assert at == {i: len(x) for i, x in ids.items()}
    for parts in sequences.values():
        parts.sort()
        assert all(a + n == b for (a, n, _), (b, _, _) in zip(parts, parts[1:])) and parts[0][0] == 0 and parts[-1][0] + parts[-1][1] == parts[0][2] in {1 << k for k in range(11)}
