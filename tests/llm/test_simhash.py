import itertools
import random
import re

import numpy as np
import xxhash

from flowtally.llm import simhash
from tests.llm.conftest import prose


def brute_print(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in hashes) * 2 > len(hashes))


def brute_components(prints):
    parent = {i: i for i in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(prints), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 3:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    return {i: find(i) for i in prints}


def test_masks_cover_every_pair_within_the_radius():
    tables = [m % (1 << 64) for m in simhash.masks(3)]
    assert len(tables) == 15
    r = random.Random(0)
    for size in (1, 2, 3):
        for _ in range(3000):
            apart = sum(1 << b for b in r.sample(range(64), size))
            assert any(not apart & m for m in tables)


def test_documents(docs_of):
    base = prose(1, 400).split()
    rows = [(i, prose(i, 30)) for i in range(40)]
    for i in range(60):             # near copies, by one or two words
        words = list(base)
        words[i] = "changed"
        rows.append((100 + i, " ".join(words)))
    rows += [(200 + i, prose(7, 50).upper()) for i in range(30)] + [(300, "É Ünï"), (301, "É ünï"), (302, "one")]
    rows += [(400, None), (401, ""), (402, " \n")]
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.simhash_components(docs_of(rows)).collect()}
    prints = {i: brute_print(t) for i, t in rows}
    roots = brute_components(prints)
    assert got == {i: (f"{prints[i]:016x}", roots[i]) for i, _ in rows}
    assert got[402] == ("0" * 16, 400)


def test_hot_buckets_are_dealt_into_chunks(spark, code):
    r = random.Random(3)
    centre = r.getrandbits(64)
    values = {centre} | {centre ^ (1 << a) ^ (1 << b) for a in range(40) for b in range(40, 60)}
    values |= {r.getrandbits(64) for _ in range(200)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    links = simhash.near_links(spark.createDataFrame([(v,) for v in signed], "fp long"), 3, chunk=64)
    rows = simhash.connected(links).collect()
    prints = {v: v % (1 << 64) for v in signed}
    want = brute_components(prints)
    roots = {x.node: x.root for x in rows}
    groups, brute = {}, {}
    for v in signed:
        groups.setdefault(roots.get(v, v), set()).add(v)
        brute.setdefault(want[v], set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, brute.values()))
    # Links are a forest per group, not all pairs.
    assert links.count() < 20 * len(values)


def test_chain_of_components(spark, code):
    pairs = [(i + 1, i) for i in range(300)] + [(1001, 1000)]
    got = {r.node: r.root for r in simhash.connected(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 301)}, 1001: 1000}


def test_spanning_links_connect():
    values = [0, 1, 3, 7, 15, 1 << 40, 3 << 50, 7 << 50]
    flat = simhash.spanning_links(np.array(values, dtype=np.int64), 1)
    links = list(zip(flat[::2], flat[1::2]))
    assert all((a ^ b).bit_count() == 1 for a, b in links)
    near = [(a, b) for a in values for b in values if (a ^ b).bit_count() == 1]

    def parts(pairs):
        root = {v: v for v in values}
        for _ in values:
            for a, b in pairs:
                root[a] = root[b] = min(root[a], root[b])
        return root

    # Links connect what brute force connects, with one link fewer than members.
    assert parts(links) == parts(near) and len(links) == len(values) - len(set(parts(near).values())) == 6


def test_awkward(awkward, nothing):
    got = simhash.simhash_components(awkward).collect()
    assert len(got) == awkward.count()
    assert simhash.simhash_components(nothing).count() == 0
    kept = simhash.one_per_component(awkward, 3, 3)
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert kept.columns == awkward.columns and ids == sorted(set(ids))
    assert 1 in ids and 2 not in ids and 4 in ids and 5 not in ids
    assert simhash.one_per_component(nothing, 3, 3).count() == 0


def test_one_row_of_every_component(docs_of, awkward):
    """Null and repeated doc_ids: components count, not ids."""
    a, b, c, d, e = (prose(i, 80) for i in range(50, 55))
    rows = [(None, a), (None, a), (None, b), (1, c), (None, c), (2, c), (2, d), (3, e), (3, a + " x y"), (3, e)]
    texts = {t: brute_print(t) for _, t in rows}
    roots = brute_components(texts)
    kept = [(r.doc_id, r.text) for r in simhash.one_per_component(docs_of(rows), 3, 3).collect()]
    assert len(kept) == len(set(roots.values())) and len({roots[t] for _, t in kept}) == len(kept)
    for doc_id, text in kept:
        ids = [i for i, t in rows if roots[t] == roots[text] and i is not None]
        assert doc_id == min(ids, default=None) and (doc_id, text) in rows
    # The null text without an id is a copy of doc 1; the other null id has a text of its own.
    ids = [(r.doc_id, r.text) for r in simhash.one_per_component(awkward, 3, 3).collect()]
    assert [x for x in ids if x[0] is None] == [(None, prose(3, 50))]
    assert (None, None) not in ids and (1, None) in ids
