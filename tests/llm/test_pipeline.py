import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from flowtally.llm.common import store
from flowtally.llm.packing import text_ids
from flowtally.llm.queries import LLM_ORACLE, LLM_QUERIES, tokenizer_path
from tests.llm.conftest import SCHEMA, prose
from tests.llm.test_simhash import brute_components, brute_print


def test_registered():
    names = set(entry.queries())
    assert {f"op{n}_" for n in range(1, 14)} <= {n.split("_")[0] + "_" for n in names if n.startswith("op")}
    assert "pipeline" in names and set(LLM_ORACLE) <= set(LLM_QUERIES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "pii", "mixing", "packing"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    r = random.Random(8)
    rows = []
    for i in range(240):
        text = prose(i, r.randint(20, 60))
        if i % 6 == 0:
            text += " vilebad " + prose(i + 1, 8)
        if i % 10 == 1:
            text += f" mail user{i}@mail.example.com or +1 (555) 555-{2000 + i}"
        rows.append((i, text, "en", f"s{i % 3}", len(text)))
    rows += [(300 + i, rows[7][1], "en", "s0", len(rows[7][1])) for i in range(20)]
    rows += [(400, None, None, None, None)]
    d = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 6 == 0)) for i in range(240)],
                          "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


def test_stages_on_their_own_input(spark, code, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen, columns = [docs.collect()], docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = store(stage(spark, docs, folder), f"test-{name}")
        seen.append(docs.collect())
        if name != "packing":
            assert docs.columns == columns
    start, clean, single, hidden, mixed, packed = seen
    assert {r.doc_id for r in clean} == {r.doc_id for r in start if not (r.doc_id < 240 and r.doc_id % 6 == 0)}
    roots = brute_components({r.doc_id: brute_print(r.text) for r in clean})
    assert {r.doc_id for r in single} == set(roots.values())
    before = {r.doc_id: r.text for r in single}
    for r in hidden:
        old = before[r.doc_id]
        if old and "@" in old:
            assert "@mail.example.com" in r.text and f"user{r.doc_id}@" not in r.text
            assert len(r.text) == len(old) and r.n_chars == len(r.text)
        else:
            assert r.text == old
    texts = {r.doc_id: r.text for r in hidden}
    copies = collections.Counter(r.doc_id for r in mixed)
    assert max(copies.values()) <= 3 and all(r.text == texts[r.doc_id] for r in mixed)
    words = {i: len((t or "").split()) for i, t in texts.items()}
    total = sum(words.values())
    assert abs(sum(words[i] * n for i, n in copies.items()) - total) < 0.1 * total
    lengths = {i: len(text_ids(t, tokenizer_path())) // 4 for i, t in texts.items()}
    assert collections.Counter(r.doc_id for r in packed) == copies      # none is longer than a sequence
    assert all(r.length == lengths[r.doc_id] for r in packed)
    used = len({r.sequence_id for r in packed})
    assert used <= np.ceil(sum(r.length for r in packed) / 4096) + 1


def test_run_returns_the_last_stage(spark, code, folder):
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert out.count() > 0


AWKWARD = ("__id", "__times", "__size", "__found", "__sign", "__of_row", "__row", "__replaced", "replaced", "fp", "h",
           "score", "copies", "size", "kept 0")


@pytest.fixture(scope="module")
def odd_folder(spark, tmp_path_factory):
    """Null and repeated doc_ids, null, empty and very long texts, repeated
    rows, and columns named like those that the stages use inside."""
    rows = [(i % 40, prose(i, 30), "en", f"s{i % 2}", 5) for i in range(60)]
    rows += [(None, prose(500, 40), "en", None, 7)] * 3 + [(None, None, None, None, None), (77, "", "de", "s0", 0)]
    rows += [(None, prose(501, 40), "en", "s1", 7), (78, prose(502, 30_000), "fr", "s1", 1), (78, "x" * 50_000, "fr", "s1", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    for k, name in enumerate(AWKWARD):
        df = df.withColumn(name, F.lit(f"clash {k}"))
    d = str(tmp_path_factory.mktemp("odd"))
    df.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 6 == 0)) for i in range(40)] + [(None, 1, 1), (3, None, None)],
                          "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


def test_stages_on_awkward_rows(spark, code, odd_folder):
    docs = spark.read.parquet(f"{odd_folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = store(stage(spark, before, odd_folder), f"odd-{name}")
        if name == "packing":
            assert docs.count() >= before.count()
            continue
        assert docs.columns == before.columns
        rows = docs.collect()
        assert rows and all(r[name] == f"clash {k}" for r in rows for k, name in enumerate(AWKWARD))
        if name == "simhash":       # one row of each component: null and empty texts are one
            assert sum(not r.text for r in rows) == 1 and len({r.text for r in rows}) == len(rows)


def test_stages_on_empty_tables(spark, code, tmp_path):
    docs = spark.createDataFrame([], SCHEMA)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = store(stage(spark, docs, str(tmp_path)), f"empty-{name}")
        assert docs.count() == 0
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
