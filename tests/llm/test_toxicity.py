import gc
import tracemalloc
import weakref
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from flowtally.llm import common, packing, toxicity
from flowtally.llm.queries import tokenizer_path
from tests.llm.conftest import prose

BAD = ["idiotish", "vilebad", "scumlike"]


@pytest.fixture(scope="module")
def rows():
    out = []
    for i in range(400):
        text = prose(i, 60)
        if i % 4 == 0:
            text += " " + BAD[i % 3] + " " + prose(i + 1, 20)
        out.append((i, text))
    return out


@pytest.fixture()
def model(spark, docs_of, rows):
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i, _ in rows],
                                   "doc_id long, quality int, toxic int")
    return toxicity.fit(docs_of(rows), labels)


def test_scores_and_folds(docs_of, model, rows):
    got = toxicity.toxicity_scores(docs_of(rows), model).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in got if r.held_out]
    assert all(r.predicted == int(r.doc_id % 4 == 0) for r in held)
    assert all(r.neighbours for r in held if r.predicted)


def test_index_against_brute_force(model, rows):
    vectors = {i: model.vector(t) for i, t in rows}
    place = {int(x): p for p, x in enumerate(model.ids)}
    dense = np.zeros((len(model.ids), len(model.idf)))
    for i, (at, w) in vectors.items():
        if i in place:
            dense[place[i], at] = w
    for i, (at, w) in list(vectors.items())[::7]:
        q = np.zeros(len(model.idf))
        q[at] = w
        cosines = np.round(dense @ q, 12)
        order = sorted((-c, int(model.ids[p]), p) for p, c in enumerate(cosines) if c > 0)
        want = [(round(-c, 12), p) for c, _, p in order[:toxicity.NEIGHBOURS]]
        assert [(round(c, 12), p) for c, p in model.nearest(at, w)] == want


def test_block_bounds_prune_nothing_needed():
    model = toxicity.Examples({f"t{i}": 1.0 + i for i in range(6)})
    rng = np.random.default_rng(0)
    vectors = []
    for _ in range(500):
        at = np.sort(rng.choice(6, rng.integers(1, 4), replace=False))
        w = rng.uniform(0.1, 1, len(at))
        vectors.append((at, w / np.linalg.norm(w)))
    model.build(list(range(500)), [int(x) for x in rng.integers(0, 2, 500)], vectors)
    dense = np.zeros((500, 6))
    for p, i in enumerate(model.ids):
        dense[p, vectors[i][0]] = vectors[i][1]
    for at, w in vectors[:50]:
        q = np.zeros(6)
        q[at] = w
        top = np.sort(np.round(dense @ q, 12))[::-1][:15]
        assert np.allclose([c for c, _ in model.nearest(at, w)], top[top > 0])


def test_calibration_is_monotone():
    model = toxicity.Examples({})
    rng = np.random.default_rng(1)
    votes = rng.uniform(0, 1, 400)
    model.calibrate(votes, (rng.uniform(0, 1, 400) < votes).astype(float))
    assert (np.diff(model.rates) > 0).all() and (np.diff(model.votes) > 0).all()


def test_awkward(spark, awkward, nothing, model, docs_of, rows):
    got = toxicity.toxicity_scores(awkward, model).collect()
    assert len(got) == awkward.count()
    assert {r.score for r in got if not r.neighbours} == {model.bare_rate}
    assert toxicity.toxicity_scores(nothing, model).count() == 0
    empty = toxicity.fit(nothing, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.score for r in toxicity.toxicity_scores(awkward, empty).collect()} == {0.0}
    nulls = spark.createDataFrame([(1, None), (None, 1), (2, 1), (2, 0)], "doc_id long, toxic int")
    assert toxicity.labelled(docs_of(rows), nulls).count() <= 1
    kept = toxicity.without_toxic(docs_of(rows), model)
    assert kept.columns == docs_of(rows).columns and kept.count() == 300


def test_no_word_of_a_text_is_dropped(spark, docs_of, rows):
    """A near copy of a toxic example that has no telling word."""
    other = [f"{a}{b}" for a in ("gri", "plo", "sna", "tru") for b in ("mbo", "ndle", "vix", "zzt", "lpa")]
    told = docs_of([*rows, (1001, " ".join(other))])
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows] + [(1001, 1)],
                                   "doc_id long, toxic int")
    got = toxicity.fit(told, labels)
    found = toxicity.toxicity_scores(docs_of([(2000, " ".join(other[:-1]) + " unseen")]), got).first()
    assert found.neighbours == [1001] and 0.9 < found.cosines[0] < 1
    at, weights = got.vector(" ".join(other[:-1]))
    assert len(at) > len(other) and np.isclose((weights ** 2).sum(), 1)
    # A word that no example has counts in the length.
    assert (got.vector(" ".join(other[:-1]) + " unseen")[1] ** 2).sum() < 1


def test_documents_are_counted_over_the_corpus(spark, docs_of, rows):
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id long, toxic int")
    more = docs_of([*rows, *((5000 + i, "bridge") for i in range(400))])

    def weight(model, term):
        return model.idf[np.searchsorted(model.keys, toxicity.term_keys([term])[0])]

    bridge = sum("bridge" in t.split() for _, t in rows)
    assert np.isclose(weight(toxicity.fit(more, labels), "bridge"), np.log(801 / (401 + bridge)) + 1)


def test_inner_folds_leave_the_held_out_rows_alone(spark, docs_of, rows):
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id long, toxic int")
    flipped = spark.createDataFrame([(i, int(i % 4 == 0) if zlib.crc32(str(i).encode()) % 5 else 1) for i, _ in rows],
                                    "doc_id long, toxic int")
    got = toxicity.inner_folds(docs_of(rows), labels, (3.0,))
    assert got == toxicity.inner_folds(docs_of(rows), flipped, (3.0,))
    train = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5]
    assert sum(r[3] for r in got) == sum(i % 4 == 0 for i in train) and [r[1] for r in got] == [1, 2, 3, 4]
    assert all(r[2] == r[3] and r[4] == 0 for r in got)


def test_batches_and_ties_of_a_repeated_id(spark, docs_of, rows):
    """Rows that repeat a doc_id with different texts are examples of their
    own, and none votes for itself."""
    more = [*rows, *((7, f"odd{k} words{k} here{k} stay{k}") for k in range(6))]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs_of(more), labels)
    assert model.ids.tolist().count(7) == 7 and len(set(zip(model.ids.tolist(), model.texts.tolist()))) == len(model.ids)
    texts = [t for _, t in more]
    single = [model.nearest(*model.vector(t)) for t in texts[-20:]]
    assert [[p for _, p in x] for x in model.nearest_of(model.vectors(texts[-20:]))] == [[p for _, p in x] for x in single]
    again = toxicity.loaded(model.shared(spark), model.outcome())
    assert again.scores(texts[:50]) == model.scores(texts[:50])


def test_workers_keep_one_operators_memory():
    path, texts = tokenizer_path(), [prose(i, 60) for i in range(50)]
    wanted = [packing.text_ids(t, path) for t in texts]
    words = weakref.ref(common.kept("packing")[path])
    assert len(words()) > 10
    list(toxicity._term_counts(iter([pa.RecordBatch.from_pydict({"text": texts})])))
    gc.collect()
    assert words() is None          # the words of packing went before terms were counted
    assert [packing.text_ids(t, path) for t in texts] == wanted


def test_keys_of_odd_terms():
    terms = ["", "a", "straße", "日本", "é", "\U0001f9ea", "\ud800x"]
    wanted = [xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass")) for t in terms]
    assert toxicity.term_keys(terms).view(np.uint64).tolist() == wanted
    assert toxicity.term_keys(terms[:-1]).view(np.uint64).tolist() == wanted[:-1]
    keys, text, term, n = toxicity.term_table(["abcdef abcdeg abcdef", None, "abcd"])
    got = {(int(i), int(keys[t])): int(c) for i, t, c in zip(text, term, n)}
    key = lambda t: int(toxicity.term_keys([t])[0])
    assert got == {(0, key("abcdef")): 2, (0, key("abcdeg")): 1, (0, key("abcd*")): 3, (0, key("abcde*")): 3,
                   (2, key("abcd")): 1}


def test_the_index_is_built_in_about_its_own_size():
    rng = np.random.default_rng(5)
    n, width, each = 20_000, 4_000, 40
    rows = [(np.sort(rng.choice(width, each, replace=False)).astype("<i4"), rng.integers(1, 9, each).astype("<u4"))
            for _ in range(n)]
    model = toxicity.Examples({})
    model.name_terms(np.arange(width), np.linspace(1, 9, width))
    tracemalloc.start()
    model.build_counts(np.arange(n), np.arange(n), np.zeros(n), rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    made = sum(getattr(model, a).nbytes for a in ("places", "held_counts", "matrix_counts", "starts", "column",
                                                  "ids", "texts", "labels", "norms"))
    assert peak < 2 * made
    for term in (0, 17, width - 1):         # every list: who holds the term, ascending, and how often
        span = slice(model.starts[term], model.starts[term + 1])
        wanted = [(p, int(rows[i][1][rows[i][0] == term][0])) for p, i in enumerate(model.ids) if term in rows[i][0]]
        assert list(zip(model.places[span].tolist(), model.held_counts[span].tolist())) == wanted


def test_words_of_many_texts_at_once():
    texts = ["One two_three 4five", None, "", "  \n\t ", "ΟΔΟΣ ΣΑΣ, Straße İstanbul", "日本 語\x0cＡ1ｂ", "e\u0301te \ud800x \u212a",
             "last"]
    words, per_text = toxicity.text_words(texts)
    wanted = [toxicity.WORD.findall((t or "").lower()) for t in texts]
    assert words == [w for ws in wanted for w in ws] and per_text.tolist() == list(map(len, wanted))
    assert toxicity.text_words([])[0] == [] and toxicity.text_words([None])[1].tolist() == [0]


def counted_index(n=1500, width=400, seed=3):
    """An index of examples with common and rare terms that repeat, and their vectors."""
    rng = np.random.default_rng(seed)
    held = 0.6 / np.sqrt(np.arange(1, width + 1))
    rows = []
    for _ in range(n):
        at = np.flatnonzero(rng.uniform(size=width) < held).astype("<i4")
        rows.append((at, rng.geometric(0.7, len(at)).astype("<u4")))
    rows = [r for r in rows if len(r[0])]
    model = toxicity.Examples({})
    model.name_terms(np.arange(width), np.linspace(1, 6, width))
    model.build_counts(np.arange(len(rows)), np.zeros(len(rows), dtype=np.int64), np.zeros(len(rows)), rows)
    vectors = [(at, (1 + np.log(c)) * model.idf[at]) for at, c in rows]
    return model, [(at, w / np.linalg.norm(w)) for at, w in vectors]


def test_counted_search_against_brute_force():
    model, vectors = counted_index()
    model.ready()
    assert 0 < model.matrix_counts.shape[1] < len(model.idf) and (model.matrix_counts > 1).any()
    dense = np.zeros((len(vectors), len(model.idf)))
    for i, (at, w) in enumerate(vectors):
        dense[i, at] = w
    place = {int(x): p for p, x in enumerate(model.ids)}
    asked = range(0, len(vectors), 7)
    near = model.nearest_of([vectors[i] for i in asked], without=[place[i] for i in asked])
    for i, found in zip(asked, near):
        cosines = np.round(dense @ dense[i], 12)
        cosines[i] = -1
        best = np.sort(cosines)[::-1][:toxicity.NEIGHBOURS]
        assert np.allclose([c for c, _ in found], best[best > 0], atol=2e-12)
        assert all(abs(cosines[model.ids[p]] - c) < 2e-12 for c, p in found)


def test_a_search_keeps_no_second_matrix():
    """Weights are worked out of the counts block by block."""
    model, vectors = counted_index(4000, 100)
    counts = model.matrix_counts.nbytes + model.places.nbytes + model.held_counts.nbytes
    before = sum(x.nbytes for x in vars(model).values() if isinstance(x, np.ndarray))
    model.ready()
    model.nearest_of(vectors[:200])
    after = sum(x.nbytes for x in vars(model).values() if isinstance(x, np.ndarray))
    assert after - before < 1.5 * counts


def grouped_index(n=2400, languages=4, width=160):
    """An index of examples in languages of their own, some with a term that
    a byte does not count, and their vectors."""
    rng = np.random.default_rng(11)
    held = 0.9 / np.sqrt(np.arange(1, width + 1))
    rows = []
    for i in range(n):
        at = np.flatnonzero(rng.uniform(size=width) < held)
        count = rng.geometric(0.7, len(at))
        if i % 50 == 0 and len(at):
            count[0] = 300 + 70_000 * (i % 100 == 0)
        rows.append(((at + width * (i % languages)).astype("<i4"), count.astype("<u4")))
    rows = [r for r in rows if len(r[0])]
    model = toxicity.Examples({})
    terms = width * languages
    model.name_terms(np.arange(terms), np.tile(np.linspace(1, 6, width), languages))
    model.build_counts(np.arange(len(rows)), np.zeros(len(rows), dtype=np.int64), np.zeros(len(rows)), rows)
    vectors = [(at.astype(np.int64), (1 + np.log(c)) * model.idf[at]) for at, c in rows]
    return model, [(at, w / np.linalg.norm(w)) for at, w in vectors]


def test_the_matrix_holds_bytes_whatever_one_example_repeats():
    model, vectors = grouped_index()
    assert model.matrix_counts.itemsize == 1 and model.held_counts.max() == 70_300
    model.ready()
    dense = np.zeros((len(vectors), len(model.idf)))
    for i, (at, w) in enumerate(vectors):
        dense[i, at] = w
    asked = range(0, len(vectors), 5)
    for i, found in zip(asked, model.nearest_of([vectors[i] for i in asked])):
        cosines = np.round(dense @ dense[i], 12)
        assert np.allclose([c for c, _ in found], np.sort(cosines)[::-1][:toxicity.NEIGHBOURS], atol=2e-12)
        assert all(abs(cosines[model.ids[p]] - c) < 2e-12 for c, p in found)


def test_a_text_is_multiplied_with_examples_like_it_only(monkeypatch):
    model, vectors = grouped_index()
    model.ready()
    seen = set()
    for name in ("_rough", "_some"):
        whole = getattr(model, name)
        monkeypatch.setattr(model, name, lambda g, lo, hi, *a, f=whole: seen.add((g, lo, hi)) or f(g, lo, hi, *a))
    model.nearest_of(vectors[:400:4])       # texts of one language
    assert 0 < sum(hi - lo for _, lo, hi in seen) < len(model.ids) / 2
