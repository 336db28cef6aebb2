import hashlib
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa

from flowtally.llm import secrets
from tests.llm.conftest import prose

ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.I | re.A)


def brute(text):
    a = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    b = [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    c = [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return [(s, e, secrets.KINDS[k]) for s, k, e in sorted(a + b + c)]


def test_base_spans_against_brute_force():
    r = random.Random(5)
    parts = ["token = \"", "API_KEY:", "passwd=", "secret", "AKIA", "AKIAAKIA", "deadbeef", "0123456789abcdef",
             "=", ":", " ", "'", "ſecret=", "ABCDEFGH12345678", "xyz_-+/", "é", "\U0001f600", "\n"]
    for _ in range(400):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 25)))
        assert secrets.base_spans(text) == brute(text)


def test_digest_columns(docs_of):
    text = "\U0001f600 token: abcdefghijkl and 00112233445566778899 end"
    got = secrets.secret_digests(docs_of([(1, text), (2, None), (3, "")])).collect()
    rows = {r.doc_id: r for r in got}
    want = ",".join(f"{k}:{s}:{e}" for s, e, k in brute(text))
    assert (rows[1].n_assign, rows[1].n_access, rows[1].n_hex) == (1, 0, 1)
    assert rows[1].base_sha256 == hashlib.sha256(want.encode()).hexdigest()
    for i in (2, 3):
        assert rows[i].base_sha256 == hashlib.sha256(b"").hexdigest() and rows[i].spans == ""


def test_battery_separates_random_from_text():
    r = random.Random(2)
    letters = secrets.ALPHABETS["base64"]
    drawn = ["".join(r.choice(letters) for _ in range(40)) for _ in range(300)]
    lower = "abcdefghijklmnopqrstuvwxyz"
    text = [re.sub("[^a-z]", "", prose(i, 40))[:40] for i in range(300)]
    assert np.mean(secrets.battery(drawn, letters) < 3) > 0.97
    assert np.median(secrets.battery(text, lower)) > 1.5
    # Runs and order count, not frequencies alone.
    assert secrets.battery(["0123456789abcdef" * 4], secrets.ALPHABETS["hex"])[0] > 5


def test_false_discovery_control():
    decoys, tokens = np.zeros((9, secrets.BINS)), np.zeros((9, secrets.BINS))
    decoys[0, :40] = 10         # short text passes often,
    tokens[0, :40] = 5          # and the tokens look like it: none is a finding
    decoys[5, 50:] = 50         # long text never passes
    tokens[5, :10] = 20
    found = secrets.thresholds(decoys, tokens)
    assert found[0] == -1 and found[5] >= 9 and found[3] == -1


def test_random_tokens_are_added(docs_of):
    r = random.Random(1)
    token = lambda: "".join(r.choice(secrets.ALPHABETS["BASE36"]) for _ in range(40))
    rows = [(i, prose(i, 200) + " " + token() + " end") for i in range(120)]
    rows += [(1000 + i, prose(i, 150)) for i in range(60)]
    got = {x.doc_id: x.spans for x in secrets.secret_digests(docs_of(rows)).collect()}
    assert sum("random" in got[i] for i in range(120)) > 90
    assert all(got[1000 + i] == "" for i in range(60))


def test_awkward(awkward, nothing):
    got = secrets.secret_digests(awkward).collect()
    assert len(got) == awkward.count() and sum(r.doc_id is None for r in got) == 2
    assert secrets.secret_digests(nothing).count() == 0


def test_decoys_are_the_whole_of_every_distinct_text(docs_of):
    text = prose(1, 20_000)
    letters = len(re.sub("[^a-z]", "", text))
    want = [letters // n for n in secrets.LENGTHS]
    packed = secrets.decoy_counts([text, "", prose(2, 5)])
    assert [sum(x & (1 << 40) - 1 for x in packed[0] if (x >> 40) // secrets.BINS == c)
            for c in range(len(secrets.LENGTHS))] == want and packed[1] == []
    runs = re.sub("[^a-z]", "", text)
    runs = [runs[i:i + 24] for i in range(0, len(runs) - 23, 24)]
    bins = np.bincount(secrets._score_bin(secrets.battery(runs, "abcdefghijklmnopqrstuvwxyz")))
    assert {(2 * secrets.BINS + b) << 40 | int(n) for b, n in enumerate(bins) if n} <= set(packed[0])


def test_copies_of_a_text_do_not_set_the_thresholds(docs_of):
    """A text whose letters pass the battery, held by half of all rows."""
    r = random.Random(1)
    token = lambda: "".join(r.choice(secrets.ALPHABETS["BASE36"]) for _ in range(40))
    alike = "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(60))
    alike = " ".join(alike[i:i + 6] for i in range(0, 60, 6))
    rows = [(i, prose(i, 200) + " " + token() + " end") for i in range(120)]
    rows += [(1000 + i, alike) for i in range(120)]
    got = {x.doc_id: x.spans for x in secrets.secret_digests(docs_of(rows).repartition(3)).collect()}
    assert sum("random" in got[i] for i in range(120)) > 90


def test_mixed_separators_are_cut(docs_of):
    r = random.Random(6)
    drawn = lambda: "".join(r.choice(secrets.ALPHABETS["base36"].upper()) for _ in range(44))
    assert (16, 36, "BASE36") in secrets.text_tokens("see path/to_dir/ABCDEFGH1234567890XY")
    key = "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY"
    assert (3, 43, "base64") in secrets.text_tokens("id_" + key)
    rows = [(i, prose(i, 200) + f" conf/key_{drawn()} end") for i in range(120)]
    got = {x.doc_id: x.spans for x in secrets.secret_digests(docs_of(rows)).collect()}
    assert sum("random" in got[i] for i in range(120)) > 90


def test_texts_are_scanned_in_little_memory():
    """A worker's memory follows the text at hand, not the batch."""
    texts = [prose(i, 400) for i in range(2500)]
    size = sum(map(len, texts))
    tracemalloc.start()
    counts = secrets.decoy_counts(texts)
    peak = tracemalloc.get_traced_memory()[1] - sum(x.__sizeof__() + 32 * len(x) for x in counts)
    tracemalloc.stop()
    assert peak < 6 * size
    assert counts[::500] == [secrets.decoy_counts([t])[0] for t in texts[::500]]


def test_batches_hold_few_whole_texts(spark, docs_of):
    set_to = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")     # Spark's default
    try:
        assert secrets.scan(docs_of([(1, "one text")])).count() == 1
        sizes = spark.range(0, 5000, 1, 1).mapInArrow(
            lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches), "n long").collect()
        assert sum(r.n for r in sizes) == 5000 and max(r.n for r in sizes) <= 1000
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", set_to)
