import hashlib
import random
import re

from flowtally.llm import spotsigs
from tests.llm.conftest import prose

COMMON = set(spotsigs.ANCHORS)


def brute_set(text):
    words = re.sub(r"[\W_]+", " ", (text or "").lower()).split()
    out = set()
    for i, w in enumerate(words):
        if w in COMMON:
            content = [x for x in words[i + 1:] if x not in COMMON][:2]
            if len(content) == 2:
                out.add((w, *content))
    return out or {("text", text or "")}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def test_report(docs_of):
    r = random.Random(3)
    docs = [(i * 3, prose(i, r.randint(0, 120))) for i in range(60)] + [
        (500, ""), (501, None), (502, "the the the"), (503, "x"), (504, "The Stone, the STONE and the river — été!"),
        (505, prose(2, 90)), (506, prose(2, 90)), (600, "the and of " * 4000)]
    got = {x.doc_id: x for x in spotsigs.fingerprint_report(docs_of(docs)).collect()}
    texts = {i: t or "" for i, t in docs}
    order = sorted(texts, reverse=True)
    for k, i in enumerate(order):
        text, following = texts[i], texts[order[(k + 1) % len(order)]]
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        x = got[i]
        assert (x.n_chars, x.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert abs(x.near_edited - jaccard(brute_set(text), brute_set(edited))) < 1e-12
        assert abs(x.near_next - jaccard(brute_set(text), brute_set(following))) < 1e-12
    assert got[505].fingerprint == got[506].fingerprint and got[500].fingerprint == got[501].fingerprint
    assert got[505].fingerprint != got[504].fingerprint


def test_buckets_of_neighbours(docs_of):
    docs = docs_of([(i * i, prose(i, 12)) for i in range(80)])
    whole = sorted(tuple(r) for r in spotsigs.with_next(docs, 1000).select("doc_id", "next_text").collect())
    assert sorted(tuple(r) for r in spotsigs.with_next(docs, 7).select("doc_id", "next_text").collect()) == whole
    texts = {i * i: prose(i, 12) for i in range(80)}
    order = sorted(texts, reverse=True)
    assert dict(whole) == {i: texts[order[(k + 1) % 80]] for k, i in enumerate(order)}


def test_near_documents(docs_of):
    base = prose(1, 300).split()
    docs = [(i, prose(i + 50, 60)) for i in range(30)]
    for i in range(25):
        words = list(base)
        words[i * 3] = f"changed{i % 9}"
        docs.append((100 + i, " ".join(words)))
    docs += [(200, docs[0][1]), (201, " ".join(base))]
    members, links = spotsigs.near_documents(docs_of(docs))
    classes = {r.doc_id: r.class_id for r in members.collect()}
    sets = {i: brute_set(t) for i, t in docs}
    assert all(classes[i] == min(j for j in sets if sets[j] == sets[i]) for i in sets)
    reps = sorted(set(classes.values()))
    want = {(a, b) for x, a in enumerate(reps) for b in reps[x + 1:] if jaccard(sets[a], sets[b]) >= 0.8}
    assert {(r.a, r.b) for r in links.collect()} == want and len(want) > 100


def test_no_python_in_the_plan(docs_of):
    plan = spotsigs.fingerprint_report(docs_of([(1, "x"), (2, "y")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_awkward(awkward, nothing):
    got = spotsigs.fingerprint_report(awkward).collect()
    assert len(got) == awkward.count()
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert spotsigs.fingerprint_report(nothing).count() == 0
    only = awkward.filter("doc_id IS NULL")
    assert spotsigs.fingerprint_report(only).count() == 2
    members, links = spotsigs.near_documents(awkward)
    assert members.count() == awkward.count()
