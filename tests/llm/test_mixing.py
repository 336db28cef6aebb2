import collections
import random

import duckdb

from flowtally.llm import mixing
from tests.llm.conftest import prose


def fill(sizes, weights=(5, 2, 1), most=3):
    """The stated rule step by step: cap, share the excess by weight again."""
    names = sorted((n for n in sizes if n is not None)) + [None] * (None in sizes)
    weight = {n: weights[i % 3] for i, n in enumerate(names)}
    free, total = set(names), sum(sizes.values())
    while True:
        left = total - sum(most * sizes[n] for n in names if n not in free)
        share = sum(weight[n] for n in free)
        target = {n: weight[n] * left / share if n in free else most * sizes[n] for n in names}
        over = {n for n in free if target[n] > most * sizes[n] + 1e-9}
        if not over:
            return target
        free -= over


def test_targets_against_the_stated_rule(spark, code):
    for k in range(4):
        r = random.Random(k)
        sizes = {f"s{i}": int(10 ** r.uniform(0, 5)) for i in range(r.randint(2, 12))}
        sizes[None] = r.randint(0, 5000)
        sizes["zero"] = 0
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in mixing.targets(df).collect()}
        want = fill(sizes)
        assert all(abs(got[n] - want[n]) <= 1e-6 * max(1, want[n]) for n in sizes)
        assert abs(sum(got.values()) - sum(sizes.values())) < 1e-3


def rows_for_mix():
    r = random.Random(9)
    return [(i, prose(i, r.randint(1, 40)), f"s{i % 7}" if i % 3 else "hot") for i in range(1500)]


def test_words_taken_come_near_the_targets(docs_of):
    rows = rows_for_mix()
    got = mixing.mix(docs_of(rows)).collect()
    source = {i: s for i, _, s in rows}
    taken, target = collections.Counter(), {}
    for r in got:
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
        assert 0 <= r.taken <= 3 * r.size and r.size == len(dict((i, t) for i, t, _ in rows)[r.doc_id].split())
    assert all(abs(taken[s] - target[s]) <= 0.02 * target[s] + 40 for s in target)
    assert [tuple(r) for r in sorted(got)] == [tuple(r) for r in sorted(mixing.mix(docs_of(rows)).collect())]


def test_a_third_of_the_rows_without_an_id(docs_of):
    """Rows of one doc_id, source and size are one row with a count while they
    are placed, and each is drawn by its own place."""
    rows = [(i, prose(i, 1 + i % 9), "a") for i in range(300)] + [(None, prose(7, 12), "a")] * 25_000
    docs = docs_of(rows).select("doc_id", "text", "source")
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows) and sum(r.taken for r in got) == got[0].source_size
    hot = [r for r in got if r.doc_id is None]
    assert len(hot) == 25_000 and all(r.taken == r.size == 12 for r in hot)
    two = mixing.mix(docs_of(rows + [(1000 + i, prose(i, 900), "b") for i in range(400)])).collect()
    taken = [r.taken // r.size for r in two if r.doc_id is None]
    share = two[0].target / two[0].source_size if two[0].source_size == got[0].source_size else None
    assert set(taken) <= {0, 1, 2, 3} and max(taken) - min(taken) <= 1
    assert share is None or abs(sum(taken) - share * 25_000) <= 1 + 300 * 9 / 12


def test_oracle_and_documents(spark, docs_of):
    rows = rows_for_mix()[:400] + [(9000, None, "s1"), (9001, "", None), (9002, "two words", None)]
    docs = docs_of(rows)
    got = sorted(tuple(r) for r in mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken").collect())
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "source").toPandas())
    assert got == sorted(con.execute(mixing.ORACLE_SQL).fetchall())
    copies = collections.Counter(r.doc_id for r in mixing.mixed_documents(docs).collect())
    for doc_id, size, _, _, taken in got:
        if size:
            assert copies[doc_id] * size == taken


def test_awkward(awkward, nothing):
    got = mixing.mix(awkward)
    assert got.count() == awkward.count()
    assert all(r.taken == 0 for r in got.collect() if r.size == 0)
    out = mixing.mixed_documents(awkward)
    assert out.columns == awkward.columns
    drawn = {(str(r.doc_id), r.size): 0 for r in got.collect()}
    for r in got.collect():
        if r.size:
            drawn[str(r.doc_id), r.size] += r.taken // r.size
    made = collections.Counter((str(r.doc_id), len(r.text.split())) for r in out.collect() if r.text and r.text.split())
    assert {k: v for k, v in drawn.items() if k[1] and v} == dict(made)
    assert mixing.mix(nothing).count() == 0 and mixing.mixed_documents(nothing).count() == 0


def test_no_python_in_the_plan(docs_of):
    plan = mixing.mix(docs_of([(1, "x")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
