import hashlib
import random
from collections import Counter
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pytest

from flowtally.llm import alignment
from flowtally.llm.common import table
from flowtally.llm.queries import tokenizer_path
from tests.conftest import SF_SMALL

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


def byte_letters():
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return {chr(b) if b in plain else chr(next(spare)): b for b in range(256)}


LETTERS = byte_letters()


def tokens(text):
    """Ids and bytes of both kinds, with the libraries alone."""
    both = alignment.pair(A, B)
    ea, eb = both.a.encode(" " + text, add_special_tokens=False), both.b.encode(text)
    pieces = [both.b.id_to_piece(i) for i in eb]
    return (ea.ids, [bytes(LETTERS[c] for c in t) for t in ea.tokens], eb,
            [bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()
             for p in pieces])


def brute(docs):
    rows, counts = [], Counter()
    for doc_id, text in docs:
        row = (doc_id, 0, 0, "", [])
        if text:
            ids_a, a, ids_b, b = tokens(text)
            if b"".join(a) == b"".join(b) == (" " + text).encode():
                ends_a, ends_b = list(accumulate(map(len, a))), list(accumulate(map(len, b)))
                links = [(x, y) for x, e in zip(ids_a, ends_a) for y, f in zip(ids_b, ends_b) if e == f] \
                    if len(a) < 3000 else None
                common = sorted(set(ends_a) & set(ends_b))
                at_a, at_b = [ends_a.index(e) + 1 for e in common], [ends_b.index(e) + 1 for e in common]
                if links is None:
                    links = [(ids_a[i - 1], ids_b[j - 1]) for i, j in zip(at_a, at_b)]
                parts = [",".join(map(str, ids_a[i:j])) + "|" + ",".join(map(str, ids_b[k:m]))
                         for i, j, k, m in zip([0, *at_a], at_a, [0, *at_b], at_b)]
                row = (doc_id, len(a), len(b), hashlib.sha256(";".join(parts).encode()).hexdigest(), links)
                counts.update(links)
        rows.append(row)
    highest = Counter()
    for (_, y), n in counts.items():
        highest[y] = max(highest[y], n)
    return Counter((i, n_a, n_b, len(links), len(links), sum(counts[x] == highest[x[1]] for x in links),
                    sum(counts[x] for x in links), digest) for i, n_a, n_b, digest, links in rows)


def rows_of(df):
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return Counter(tuple(r) for r in df.select(*names).collect())


def test_as_brute_force(spark, code):
    docs = table(spark, SF_SMALL, "documents")
    assert rows_of(alignment.align(docs, A, B)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_awkward(awkward, docs_of, nothing):
    more = docs_of([(20, "a ▁ b"), (21, "<|endoftext|> and </s> <0x0A>"), (22, "tabs\t\tand\n\n  spaces   "),
                    (23, "日本語 \U0001f9ea‍"), (24, "\x00\x01"), (25, "é Å ﬁ")])
    docs = awkward.unionByName(more)
    got = alignment.align(docs, A, B)
    assert rows_of(got) == brute([(r.doc_id, r.text) for r in docs.collect()])
    none = {r.doc_id for r in got.filter("n_a = 0").collect()}
    assert none >= {1, 2, 20} and 21 not in none
    assert got.filter("n_a = 0 AND (groups_sha256 <> '' OR n_b + n_groups + n_best + count_sum > 0)").count() == 0
    assert alignment.align(nothing, A, B).count() == 0


def test_parts_as_whole_texts():
    """Ids put together from remembered parts are those of the whole text."""
    both = alignment.pair(A, B)
    assert both.splits
    r = random.Random(4)
    bits = [" ", " ", "  ", "\n", "\t ", "\u00a0", "\u3000", "\x1c", "\u180e", "'s", "n't", "12", "é", "e\u0301", "\u0301",
            "日本", "\U0001f600", "\u200d", "ab", "The", ".", ",", "--", "<|endoftext|>", "</s>", "ſ", "\u0130"]
    texts = ["".join(r.choice(bits) for _ in range(r.randrange(1, 25))) for _ in range(3000)]
    for text, a, b in zip(texts, *both.encode(pa.array(texts))):
        ids_a, spelt_a, ids_b, spelt_b = tokens(text)
        if b"".join(spelt_a) == b"".join(spelt_b) == (" " + text).encode():
            assert (a.tolist(), b.tolist()) == (ids_a, ids_b)
        else:
            assert not len(a) and not len(b)


def test_parts_spell_the_texts():
    texts = pa.array(["a b", None, "", " x  y z", "é ü", "日本 語", "n\u00a0 m o", "end "])
    parts, first = alignment.spaced_parts(texts)
    parts = [p.decode() for p in parts.to_pylist()]
    spelt = [parts[lo:hi] for lo, hi in zip(first, first[1:])]
    assert spelt == [[" a", " b"], [], [], ["  x  y", " z"], [" é", " ü"], [" 日本 語"], [" n\u00a0 m", " o"],
                     [" end "]]


def test_groups_spell_the_text(docs_of):
    text = "Naïve tokenisers disagree: 12345 übergroß, isn't it?"
    row = alignment.alignments(docs_of([(1, text)]), A, B, keep_groups=True).first()
    both = alignment.pair(A, B)
    sides = [g.split("|") for g in row.groups.split(";")]
    for k, spelt in ((0, both.bytes_a), (1, both.bytes_b)):
        assert b"".join(spelt[int(i)] for g in sides for i in g[k].split(",")).decode() == " " + text
    for a, b in sides:
        assert b"".join(both.bytes_a[int(i)] for i in a.split(",")) == b"".join(
            both.bytes_b[int(i)] for i in b.split(","))


@pytest.mark.parametrize("seed", range(5))
def test_gallop(seed):
    r = np.random.default_rng(seed)
    within = np.unique(r.integers(0, 5000, r.integers(1, 900)))
    wanted = np.unique(np.concatenate([r.integers(0, within[-1] + 1, r.integers(1, 300)), within[-1:]]))
    guess = r.integers(0, len(within), len(wanted))
    assert alignment.gallop(wanted, within, guess).tolist() == np.searchsorted(within, wanted).tolist()


def test_pairs_are_bounded(spark, code):
    both = alignment.pair(A, B)
    links = alignment.link_counts(alignment.alignments(table(spark, SF_SMALL, "documents"), A, B),
                                  len(both.bytes_b)).collect()
    assert len(links) <= both.bound()
    for r in links:
        a, b = both.bytes_a[r.link // len(both.bytes_b)], both.bytes_b[r.link % len(both.bytes_b)]
        assert a.endswith(b) or b.endswith(a)


def test_batches_hold_few_whole_texts(spark, docs_of):
    set_to = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")     # Spark's default
    try:
        alignment.align(docs_of([(1, "one text")]), A, B)
        sizes = spark.range(0, 5000, 1, 1).mapInArrow(
            lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches), "n long").collect()
        assert sum(r.n for r in sizes) == 5000 and max(r.n for r in sizes) <= 1000
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "300")   # a choice of the session stays
        alignment.align(docs_of([(1, "one text")]), A, B)
        assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "300"
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", set_to)
