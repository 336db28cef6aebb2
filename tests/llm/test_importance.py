import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowtally.llm import importance
from flowtally.llm.common import table
from tests.conftest import SF_SMALL
from tests.llm.conftest import prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(words), [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def brute(docs, target):
    """(doc_id, n_features, weight, score, rank) by plain Python, sorted."""
    def buckets(text):
        return Counter(zlib.crc32(f.encode()) % 10_000 for f in features(text)[1])

    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(buckets(text))
    for text in target:
        t.update(buckets(text))
    all_s, all_t = sum(s.values()), sum(t.values())
    rows = []
    for doc_id, text in docs:
        weight = sum(n * math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000))))
                     for b, n in buckets(text).items())
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32)))
        rows.append((features(text)[0], doc_id, len(features(text)[1]), weight, score))
    able = sorted((r for r in rows if r[0] >= 20),
                  key=lambda r: (-r[4], r[1] is None, r[1] or 0, r[2], r[3]))
    drawn = able[:5 * len(able) // 100]
    ranks = [(*r[1:], i + 1) for i, r in enumerate(drawn)]
    rest = Counter(rows) - Counter(drawn)
    return Counter(ranks + [(*r[1:], None) for r in rest.elements()])


def rows_of(df):
    return Counter(tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect())


def test_crc_matrices():
    raw = np.frombuffer(prose(9, 400).encode(), dtype=np.uint8)
    r = np.random.default_rng(3)
    starts = r.integers(0, 1000, 500)
    lengths = r.integers(0, 400, 500)
    got = importance.crc32_slices(raw, starts, lengths)
    assert got.tolist() == [zlib.crc32(raw[a:a + n].tobytes()) for a, n in zip(starts, lengths)]


def test_as_brute_force(spark, code):
    docs, target = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "benchmark")
    got = importance.resample(docs, target)
    assert all(kind == "bigint" for _, kind in got.dtypes)
    assert rows_of(got) == brute([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()])


@pytest.mark.parametrize("chunk", [1, 1 << 22])
def test_awkward(spark, awkward, docs_of, nothing, monkeypatch, chunk):
    from flowtally.llm import words
    monkeypatch.setattr(words, "CHUNK_BYTES", chunk)
    # Ties: 60 rows that are equal, without an id; a third of the rows with one id.
    more = [(i, prose(i, 30)) for i in range(100, 160)] + [(None, prose(5, 25))] * 60 + [(77, prose(6, 33))] * 60
    docs = awkward.select("doc_id", "text").unionByName(docs_of(more).select("doc_id", "text"))
    target = docs_of([(1, prose(5, 400)), (2, None), (3, "")])
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()])
    monkeypatch.setattr(importance, "COPIES", 7)        # equal rows given out by several tasks
    clashing = docs.withColumn("rank", F.lit("x")).withColumn("score", F.lit("x")).withColumn("n", F.lit(1))
    assert rows_of(importance.resample(clashing, target)) == want
    assert importance.resample(nothing, target).count() == 0
    assert rows_of(importance.resample(docs, nothing)) == brute(
        [(r.doc_id, r.text) for r in docs.collect()], [])


def test_ranks_go_on_across_partitions(spark, code):
    rows = spark.range(1000).select(F.pmod(F.col("id") * 7, F.lit(90)).alias("a"), (F.col("id") % 3).alias("b"))
    got = importance.ranked(rows, [F.desc("a"), F.asc("b")], 500).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 501)) and len(got) == 1000
    placed = sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])
    assert [(-r.a, r.b) for r in placed] == sorted((-r.a, r.b) for r in got)[:500]
