import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowtally.llm import repeats
from flowtally.llm.common import table
from tests.conftest import SF_SMALL
from tests.llm.conftest import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, window=50):
    """(doc_id, n_words, n_removed, kept_sha256, removed places) by plain Python."""
    first = {}
    split = [(doc_id, WORD.findall(text or "")) for doc_id, text in docs]

    def windows(words):
        return [tuple(words[i:i + window]) for i in range(len(words) - window + 1)]

    for doc_id, words in split:
        for w in windows(words):
            own = float("inf") if doc_id is None else doc_id
            first[w] = min(first.get(w, own), own)
    out = []
    for doc_id, words in split:
        own = float("inf") if doc_id is None else doc_id
        gone = {i + j for i, w in enumerate(windows(words)) if first[w] < own for j in range(window)}
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc_id, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest(), tuple(sorted(gone))))
    return Counter(out)


def rows_of(df):
    return Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256,
                    tuple(i for s in r.spans for i in range(s.lo, s.hi))) for r in df.collect())


def shared(n, seeds, length):
    """Documents that hold common passages at different places."""
    return [(i, " ".join([prose(1000 + i, 5 + i % 40), prose(seeds[i % len(seeds)], length), prose(2000 + i, 7)]))
            for i in range(n)]


# All groups small; all but the least lengthened to the whole window; trees of few suffixes.
@pytest.mark.parametrize("sizes", [{}, {"group": 30}, {"group": 0, "tree": 50}, {"group": 60, "tree": 50}])
def test_as_brute_force(spark, code, sizes):
    docs = table(spark, SF_SMALL, "documents")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert rows_of(repeats.without_repeats(docs, **sizes)) == want
    assert sum(r[2] for r in want) > 0


@pytest.mark.parametrize("group", [1 << 14, 40])
def test_awkward(spark, awkward, docs_of, nothing, group):
    more = docs_of(shared(30, (7, 8, 9), 60) + shared(12, (7,), 49) + [
        (None, prose(7, 60)), (None, prose(7, 60)), (90, prose(7, 60)), (90, prose(7, 60)), (90, prose(8, 70)),
        (200, prose(2, 30_000)), (201, "same " * 300), (202, "same " * 90), (203, "same word " * 60)])
    docs = awkward.unionByName(more)
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    clashing = docs.withColumns({c: F.lit("clash") for c in ("h1", "own", "start", "hits", "lo")})
    assert rows_of(repeats.without_repeats(clashing, group=group)) == want
    assert repeats.without_repeats(nothing, group=group).count() == 0


@pytest.mark.parametrize("group", [1 << 14, 5])
def test_other_windows(docs_of, group):
    docs = docs_of(shared(20, (3, 4), 25))
    for window, prefix in ((10, 3), (10, 10), (21, 8)):
        assert rows_of(repeats.without_repeats(docs, window, prefix, group=group)) == brute(
            [(r.doc_id, r.text) for r in docs.collect()], window)


def test_kept_text(docs_of):
    docs = docs_of(shared(6, (3,), 80))
    for r in repeats.without_repeats(docs, keep_text=True).collect():
        assert hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256
        assert len(r.kept.split()) == r.n_words - r.n_removed


def test_nodes_tell_windows_apart():
    r = np.random.default_rng(5)
    ids = r.integers(0, 3, 400)
    for depth in (1, 2, 5, 8, 50):
        places = np.arange(len(ids) - depth + 1)
        names = repeats.nodes_at(ids, places, depth)
        seen = {}
        for p, name in zip(places, names):
            assert seen.setdefault(tuple(ids[p:p + depth]), name) == name
        assert len(seen) == len(set(names.tolist()))


def test_equal_windows_have_equal_anchors():
    r = np.random.default_rng(6)
    part = r.integers(0, 1 << 63, 120, dtype=np.uint64)
    a = np.concatenate([r.integers(0, 1 << 63, 31, dtype=np.uint64), part])
    b = np.concatenate([r.integers(0, 1 << 63, 64, dtype=np.uint64), part])
    for prefix in (1, 8, 50):
        x, y = repeats.anchor_keys(a, prefix, 50), repeats.anchor_keys(b, prefix, 50)
        assert len(x) == len(a) - 49 and x[31:].tolist() == y[64:].tolist()
