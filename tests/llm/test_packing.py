import collections
import random
import zlib

import numpy as np
import pytest

from flowtally.llm import packing
from flowtally.llm.queries import tokenizer_path
from tests.llm.conftest import prose

PATH = tokenizer_path()


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


def test_ids_equal_the_tokenizer(tokenizer):
    r = random.Random(6)
    bits = ["word", "Word.", "Été,", "naïve", "don't", "'s", "3.14", "!!", "...", ".", ",", "é", "é", "İ", "ſ",
            "ΣΑΣ", "≠", "≠", "<|endoftext|>", "<|ENDOFTEXT|>", "ŉ", "ß.", "　", "\x85", "x́.", "Ŀ"]
    for _ in range(300):
        text = "".join(r.choice(bits) + r.choice(["", " ", "\n", "\t "]) for _ in range(r.randint(0, 12)))
        want = tokenizer.encode(text, add_special_tokens=False).ids + [1]
        assert np.frombuffer(packing.text_ids(text, PATH), dtype="<u4").tolist() == want, text


@pytest.mark.parametrize("lengths", [
    [1] * 10, [4096] * 5, [2048, 2049, 2048, 2049], list(range(1, 4097, 7)), [1300, 1370, 1400, 2700] * 50, []])
def test_plan_holds_every_piece(lengths):
    demand = collections.Counter(lengths)
    made = packing.plan(dict(demand), 4096)
    slots = collections.Counter()
    for times, config in made:
        assert times > 0 and sum(s * c for s, c in config.items()) <= 4096
        for s, c in config.items():
            slots[s] += times * c
    assert slots == demand


def test_knapsack_against_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(30):
        prices = np.concatenate([[0], rng.uniform(0, 1, 12) * (rng.uniform(0, 1, 12) < 0.6)])
        best = [0.0] * 13
        for c in range(1, 13):
            best[c] = max([best[c - 1]] + [best[c - s] + prices[s] for s in range(1, c + 1)])
        chosen = packing.knapsack(prices)
        assert sum(s * k for s, k in chosen.items()) <= 12
        assert sum(prices[s] * k for s, k in chosen.items()) == pytest.approx(best[12])


def test_program_beats_best_fit_where_it_can():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1000, 2100, size=20_000).tolist()
    exact = np.zeros(4097, dtype=np.int64)
    for x in lengths:
        exact[x] += 1
    plain = sum(t for t, _ in packing.best_fit(exact))
    assert sum(t for t, _ in packing.plan(collections.Counter(lengths), 4096)) < plain


def lengths_of(kind):
    rng = np.random.default_rng(7)
    if kind == "uniform":
        return rng.integers(1, 4097, 100_000)
    if kind == "lognormal":
        return np.clip(rng.lognormal(5.5, 1.0, 100_000).astype(int), 1, 4096)
    if kind == "narrow":
        return rng.integers(1000, 2101, 100_000)
    import duckdb
    texts = duckdb.sql("SELECT text FROM '/root/testdata/sf0.1/documents.parquet'").fetchall()
    ids = [len(packing.text_ids(t, PATH)) // 4 for t, in texts]
    return np.array([min(4096, n - at) for n in ids for at in range(0, n, 4096)])


@pytest.mark.parametrize("kind", ["uniform", "lognormal", "narrow", "sf0.1"])
def test_the_program_covers_every_class(kind):
    facts = packing.plan_facts(dict(collections.Counter(lengths_of(kind).tolist())), 4096)
    print(kind, facts)
    assert facts["classes"] > 200 and facts["uncovered"] == 0
    # The dual bound holds, and the program's amounts stay within a tenth of it.
    assert facts["bound"] <= facts["amount"] <= 1.1 * facts["bound"]
    assert min(facts["program"], facts["best_fit"]) >= facts["tokens"]
    assert facts["program"] <= 1.05 * facts["best_fit"]


def test_bound_against_brute_force():
    """Small rooms: the bound is below the fewest sequences found by search."""
    rng = np.random.default_rng(8)

    def fewest(pieces, room):
        best = len(pieces)

        def put(i, rooms):
            nonlocal best
            if len(rooms) >= best:
                return
            if i == len(pieces):
                best = len(rooms)
                return
            for k in range(len(rooms)):
                if rooms[k] >= pieces[i] and rooms[k] not in rooms[:k]:
                    put(i + 1, rooms[:k] + [rooms[k] - pieces[i]] + rooms[k + 1:])
            put(i + 1, rooms + [room - pieces[i]])

        put(0, [])
        return best

    for _ in range(20):
        pieces = sorted(rng.integers(1, 14, 9).tolist(), reverse=True)
        facts = packing.plan_facts(dict(collections.Counter(pieces)), 13)
        assert facts["bound"] <= fewest(pieces, 13) + 1e-9 <= min(facts["program"], facts["best_fit"]) + 1e-9
        assert facts["uncovered"] == 0


def test_other_vocabularies_encode_whole_texts():
    """The shortcut by words holds for one kind of tokenizer only."""
    from tokenizers import Tokenizer
    other = tokenizer_path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(other)
    r = random.Random(2)
    bits = ["word", "Word.", "naïve", "don't", "'s", "3.14", "  ", "\n\n", "Ünï", "，"]
    for _ in range(200):
        text = "".join(r.choice(bits) + r.choice(["", " "]) for _ in range(r.randint(0, 12)))
        want = plain.encode(text, add_special_tokens=False).ids + [1]
        assert np.frombuffer(packing.text_ids(text, other), dtype="<u4").tolist() == want


def check(rows, docs, tokenizer, capacity):
    by_sequence, by_doc = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    for slots in by_sequence.values():
        at = 0
        for offset, length in sorted(slots):
            assert offset == at
            at += length
        assert at <= capacity
    want = collections.defaultdict(list)
    for doc_id, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for k, s in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[s:s + capacity], dtype="<u4")
            want[doc_id].append((k, s, len(part), zlib.crc32(part.tobytes())))
    assert {k: sorted(v) for k, v in by_doc.items()} == {k: sorted(v) for k, v in want.items()}
    return len(by_sequence)


def test_pack(docs_of, tokenizer):
    r = random.Random(1)
    docs = [(i, prose(i, r.randint(0, 200))) for i in range(150)] + [(900, prose(1, 9000)), (901, None)]
    used = check(packing.pack(docs_of(docs), PATH, 512).collect(), docs, tokenizer, 512)
    total = sum(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in docs)
    assert used <= total / 512 * 1.05 + 1


def test_ids_are_kept_on_demand(docs_of, tokenizer):
    rows = packing.pack(docs_of([(1, "one two three")]), PATH, 64, keep_ids=True).collect()
    ids = np.frombuffer(bytes(rows[0].ids), dtype="<u4").tolist()
    assert ids == tokenizer.encode("one two three", add_special_tokens=False).ids + [1]


def test_awkward(awkward, nothing, tokenizer):
    docs = [(r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()]
    check(packing.pack(awkward, PATH, 4096).collect(), docs, tokenizer, 4096)
    assert packing.pack(nothing, PATH).count() == 0
