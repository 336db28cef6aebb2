"""Secret scan: fixed patterns, and a randomness test battery.

Base findings are the stated patterns.  The method adds tokens that look drawn
at random.  Per token an encoding is inferred (its alphabet), and three tests
ask whether the token is a uniform draw from it:

* chi-squared: are the alphabet's symbols equally frequent?
* runs: does the token cross the middle of the alphabet as often as it should?
* serial correlation: does a symbol say anything about the next one?

Their p-values are combined by Fisher's method.  A token is a finding when the
battery does not reject it; how much that says depends on its length, as short
pieces of ordinary text pass easily.  So false discoveries are controlled by
length class.  Decoys, the successive runs of letters of each class's length
over the whole of every distinct text, take the same battery.  The share of tokens that are ordinary is
estimated from the rejected ones (Storey), and the threshold is the largest at
which the estimated false discovery rate, that share times the decoys' pass
rate over the tokens' pass rate, is within ``fdr``.

Texts are scanned once; what leaves the scan are spans, scores and, with the
first row of a text in its task, the text's digest and its decoys' counts by
(length class, score bin).  Counts of one digest count once.

A run of token characters that fits no alphabet because it holds both of
``+/`` and of ``-_`` is cut: its parts between ``-_``, those between ``+/`` and
those between all four are tokens of their own, which may overlap.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtally.llm.common import give_back, store, whole_texts
from flowtally.llm.words import text_chunks

# The base patterns, in the order in which kinds are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"""([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")      # finds the runs [0-9a-f]+ of 16 and more
KINDS = ("assign", "access", "hex")
LEAST = {"assign": 12, "access": 18, "hex": 16}

# Encodings by alphabet, the narrowest first.
ALPHABETS = {
    "decimal": "0123456789",
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "BASE36": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
ENCODINGS = tuple(ALPHABETS)
TOKEN = re.compile(r"[A-Za-z0-9+/_-]{16,}")
PARTS = tuple(map(re.compile, (r"[A-Za-z0-9+/]{16,}", r"[A-Za-z0-9_-]{16,}", r"[A-Za-z0-9]{16,}")))
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
LOWER = b"abcdefghijklmnopqrstuvwxyz"
NOT_LETTERS = bytes(set(range(256)) - set(LOWER))
LENGTHS = (16, 20, 24, 32, 40, 48, 64, 96, 128)     # length classes begin here
BINS = 64                                            # of the score, -log10 p, in tenths
REJECTED = 30                                        # from this bin on: p below 0.001
FDR = 0.01
DECOY_LETTERS = 1 << 18     # letters of decoys that take the battery at a time


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base findings, leftmost non-overlapping per
    kind, by start and then kind as listed."""
    found = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text)
             if m.end(2) - m.start(2) >= LEAST["assign"]]
    found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text)
              if m.end() - m.start() >= LEAST["access"]]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return [(s, e, KINDS[k]) for s, e, k in sorted(found, key=lambda x: (x[0], x[2]))]


def infer_encoding(token: str) -> str | None:
    """The narrowest alphabet that holds the token, None if none does or the
    token is a plain word or number."""
    if WORD.fullmatch(token):
        return None
    used = set(token)
    for name, letters in ALPHABETS.items():
        if used <= set(letters):
            return None if name == "decimal" else name
    return None


def text_tokens(text: str) -> list[tuple[int, int, str]]:
    """(start, end, encoding) of what the battery tests in a text."""
    out = []
    for m in TOKEN.finditer(text):
        token = m.group()
        encoding = infer_encoding(token)
        if encoding:
            out.append((m.start(), m.end(), encoding))
        elif not set("+/").isdisjoint(token) and not set("-_").isdisjoint(token):
            parts = {p.span(): infer_encoding(p.group()) for form in PARTS for p in form.finditer(token)}
            out += [(m.start() + s, m.start() + e, x) for (s, e), x in sorted(parts.items()) if x]
    return out


def _chi2_tail(x: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Upper tail of chi-squared with k degrees (Wilson-Hilferty)."""
    z = (np.cbrt(x / k) - (1 - 2 / (9 * k))) / np.sqrt(2 / (9 * k))
    return _normal_tail(z)


_ERFC = np.vectorize(math.erfc, otypes=[float])


def _normal_tail(z: np.ndarray) -> np.ndarray:
    return np.clip(0.5 * _ERFC(z / math.sqrt(2)), 1e-300, 1.0)


_LOOKUP: dict[str, np.ndarray] = {}


def _symbols(letters: str) -> np.ndarray:
    if letters not in _LOOKUP:
        to = np.zeros(128, dtype=np.int64)
        for i, x in enumerate(letters):
            to[ord(x)] = i
        _LOOKUP[letters] = to
    return _LOOKUP[letters]


def battery(tokens: list[str], letters: str) -> np.ndarray:
    """-log10 of the combined p-value of each token (ASCII) as a uniform draw
    from ``letters``; small means consistent with randomness."""
    k = len(letters)
    n = np.array([len(t) for t in tokens], dtype=np.int64)
    codes = _symbols(letters)[np.frombuffer("".join(tokens).encode("ascii"), dtype=np.uint8)]
    owner = np.repeat(np.arange(len(tokens)), n)
    counts = np.bincount(owner * k + codes, minlength=k * len(tokens)).reshape(-1, k)
    squares = (counts.astype(float) ** 2).sum(axis=1)
    high = codes >= k / 2
    inner = np.flatnonzero(owner[1:] == owner[:-1])
    changes = np.bincount(owner[inner], weights=high[inner] != high[inner + 1],
                          minlength=len(n))
    up = np.bincount(owner, weights=high, minlength=len(n))
    x = (codes - (k - 1) / 2) / math.sqrt((k * k - 1) / 12)
    lag = np.bincount(owner[inner], weights=x[inner] * x[inner + 1], minlength=len(n))
    return _combined(k, n, squares, changes, up, lag)


def decoy_battery(letters: np.ndarray) -> np.ndarray:
    """The battery of equally long runs of a-z, codes by row."""
    m, width = letters.shape
    cells = letters + np.arange(m, dtype=np.int32)[:, None] * 26
    counts = np.bincount(cells.ravel(), minlength=26 * m).reshape(-1, 26).astype(float)
    high = letters >= 13
    x = (letters - 12.5) / math.sqrt((26 * 26 - 1) / 12)
    return _combined(26, np.full(m, width), np.einsum("ij,ij->i", counts, counts),
                     (high[:, 1:] != high[:, :-1]).sum(axis=1).astype(float),
                     high.sum(axis=1).astype(float), np.einsum("ij,ij->i", x[:, 1:], x[:, :-1]))


def _combined(k: int, n, squares, changes, up, lag) -> np.ndarray:
    """Score of tokens of length ``n`` over ``k`` symbols by the sum of their
    squared symbol counts, their changes of half, symbols of the upper half
    and products of neighbours."""
    p_chi = _chi2_tail(np.maximum(squares * k / n - n, 1e-9), np.full(len(n), k - 1.0))
    # Runs about the middle of the alphabet.
    down = n - up
    mean = 2 * up * down / n + 1
    var = np.maximum((mean - 1) * (mean - 2) / np.maximum(n - 1, 1), 1e-9)
    p_runs = np.where((up > 0) & (down > 0),
                      2 * _normal_tail(np.abs(changes + 1 - mean) / np.sqrt(var)),
                      2.0 ** (1 - n.astype(float)))
    # Serial correlation at lag one, of symbols scaled to unit variance.
    p_serial = 2 * _normal_tail(np.abs(lag) / np.sqrt(np.maximum(n - 1, 1)))
    fisher = -2 * sum(np.log(np.clip(p, 1e-300, 1.0)) for p in (p_chi, p_runs, p_serial))
    half = fisher / 2       # chi-squared with 6 degrees has a closed tail
    log_p = -half + np.log1p(half + half * half / 2)
    return -log_p / math.log(10)


def _length_class(n: np.ndarray) -> np.ndarray:
    return np.searchsorted(LENGTHS, n, side="right") - 1


def _score_bin(score: np.ndarray) -> np.ndarray:
    return np.minimum((score * 10).astype(np.int64), BINS - 1)


SCAN = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("base", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
        T.StructField("kind", T.StringType())]))),
    T.StructField("tokens", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
        T.StructField("encoding", T.StringType()), T.StructField("length_class", T.IntegerType()),
        T.StructField("score_bin", T.IntegerType())]))),
    T.StructField("digest", T.BinaryType()),
    T.StructField("decoys", T.ArrayType(T.LongType()))])
# The same as Arrow has it.
SCANNED = pa.schema([
    ("doc_id", pa.int64()),
    ("base", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))),
    ("tokens", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("encoding", pa.string()),
                                   ("length_class", pa.int32()), ("score_bin", pa.int32())]))),
    ("digest", pa.binary()), ("decoys", pa.list_(pa.int64()))])


def _letters(text: str) -> np.ndarray:
    """The letters of a text as codes from 0, whatever stands between them."""
    return np.frombuffer(text.lower().encode("utf-8", "surrogatepass").translate(None, NOT_LETTERS),
                         dtype=np.uint8) - LOWER[0]


def decoy_counts(texts: list[str]) -> list[list[int]]:
    """Per text, ``cell << 40 | n`` for the cells (length class, score bin)
    that its decoys fall in: for every class, the successive runs of letters
    of its length over the whole text."""
    letters = [_letters(t) for t in texts]
    shape = len(LENGTHS) * BINS
    out: list[list[int]] = []
    at = 0
    while at < len(letters):
        # Texts of about DECOY_LETTERS letters together.
        upto, size = at, 0
        while upto < len(letters) and (upto == at or size + len(letters[upto]) <= DECOY_LETTERS):
            size += len(letters[upto])
            upto += 1
        part = letters[at:upto]
        found = []
        for c, n in enumerate(LENGTHS):
            rows = np.array([len(x) // n for x in part])
            joined = np.concatenate([x[:r * n] for x, r in zip(part, rows)]).reshape(-1, n)
            owner = np.repeat(np.arange(len(part)), rows)
            step = max(1, DECOY_LETTERS // n)
            for lo in range(0, len(joined), step):
                bins = _score_bin(decoy_battery(joined[lo:lo + step]))
                found.append(owner[lo:lo + step] * shape + c * BINS + bins)
        cells, n = np.unique(np.concatenate([np.zeros(0, dtype=np.int64), *found]), return_counts=True)
        packed = (cells % shape) << 40 | n
        edges = np.searchsorted(cells, np.arange(len(part) + 1) * shape)
        out += [packed[lo:hi].tolist() for lo, hi in zip(edges, edges[1:])]
        at = upto
    return out


def scan_batch(ids, texts, known: set[bytes]) -> list[tuple]:
    """One row per text; decoys are counted with digests not yet ``known``."""
    bases, spans, digests, fresh = [], [], [], []
    by_encoding: dict[str, list] = {}
    for i, text in enumerate(texts):
        text = text or ""
        bases.append(base_spans(text))
        spans.append([])
        for s, e, encoding in text_tokens(text):
            by_encoding.setdefault(encoding, []).append((i, s, e, text[s:e]))
        digest = xxhash.xxh3_128_digest(text.encode("utf-8", "surrogatepass"))
        digests.append(None if digest in known else digest)
        if digest not in known:
            known.add(digest)
            fresh.append(text)
    for encoding, found in by_encoding.items():
        scores = battery([x[3] for x in found], ALPHABETS[encoding])
        classes = _length_class(np.array([len(x[3]) for x in found]))
        for (i, s, e, _), c, b in zip(found, classes, _score_bin(scores)):
            spans[i].append((s, e, encoding, int(c), int(b)))
    counts = iter(decoy_counts(fresh))
    return [(d, b, sorted(s), x, next(counts) if x else None)
            for d, b, s, x in zip(ids, bases, spans, digests)]


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: set[bytes] = set()       # 16 bytes for each text of the task
    for batch in batches:
        for chunk in text_chunks(batch):
            rows = scan_batch(chunk.column("doc_id").to_pylist(), chunk.column("text").to_pylist(), known)
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, f.type) for column, f in zip(zip(*rows), SCANNED)], schema=SCANNED)
    give_back()                     # the worker lives on


def scan(docs: DataFrame) -> DataFrame:
    """Base findings, scored tokens and decoy counts per document."""
    whole_texts(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_scanned, SCAN)


def thresholds(decoys: np.ndarray, tokens: np.ndarray, fdr: float = FDR) -> list[int]:
    """By length class, the highest score bin that is a finding (-1: none);
    ``decoys`` and ``tokens`` count by (length class, score bin)."""
    out = []
    for d, t in zip(decoys, tokens):
        if not d.sum() or not t.sum():
            out.append(-1)
            continue
        rejected = d[REJECTED:].sum() / d.sum()
        ordinary = min(1.0, (t[REJECTED:].sum() + 1) / t.sum() / rejected) if rejected else 1.0
        false = ordinary * (np.cumsum(d) + 1) / (d.sum() + 1) * t.sum()
        passed = np.cumsum(t)
        good = np.flatnonzero((passed > 0) & (false <= fdr * passed))
        good = good[good < REJECTED]
        out.append(int(good.max()) if len(good) else -1)
    return out


def find_secrets(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """doc_id and findings (start, end, kind in order) of every row of ``docs``
    (doc_id, text; other columns are not read).

    Kinds are those of the base patterns and ``random`` for a token that the
    battery adds; a token that overlaps a base finding of the same span is
    reported too.  Positions are code points, ends exclusive.  Null and empty
    texts have no findings; repeated rows each give a row; a null doc_id stays
    null; an empty table gives no rows.
    """
    found = store(scan(docs), "secrets")
    shape = (len(LENGTHS), BINS)
    once = found.filter("digest IS NOT NULL").groupBy("digest").agg(F.first("decoys").alias("decoys"))
    cells = (once.select(F.explode("decoys").alias("d"))
             .groupBy(F.shiftright("d", 40).alias("cell"))
             .agg(F.sum(F.col("d").bitwiseAND(F.lit((1 << 40) - 1))).alias("n")))
    decoys, tokens = np.zeros(shape), np.zeros(shape)
    for r in cells.collect():       # one row per (length class, score bin)
        decoys[r.cell // BINS, r.cell % BINS] = r.n
    seen = (found.select(F.explode("tokens").alias("t"))
            .groupBy("t.length_class", "t.score_bin").agg(F.count("*").alias("n")))
    for r in seen.collect():        # likewise
        tokens[r.length_class, r.score_bin] = r.n
    upto = F.array(*map(F.lit, thresholds(decoys, tokens, fdr)))
    random = F.transform(
        F.filter("tokens", lambda t: t.score_bin <= F.element_at(upto, t.length_class + 1)),
        lambda t: F.struct(t.start.alias("start"), t.end.alias("end"), F.lit("random").alias("kind")))
    rows = found.select(
        "doc_id", "base", F.concat("base", random).alias("all"))
    return rows.select("doc_id", "base", F.expr("""array_sort(all, (a, b) -> CASE
        WHEN a.start <> b.start THEN CAST(sign(a.start - b.start) AS int)
        ELSE CAST(sign(array_position(array('assign', 'access', 'hex', 'random'), a.kind)
                       - array_position(array('assign', 'access', 'hex', 'random'), b.kind)) AS int)
        END)""").alias("findings"))


def secret_digests(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """doc_id, counts of the base findings, their digest and all spans."""
    rows = find_secrets(docs, fdr)

    def joined(column: str):
        return F.array_join(F.transform(column, lambda f: F.concat_ws(
            ":", f.kind, f.start.cast("string"), f.end.cast("string"))), ",")

    def count(kind: str):
        return F.size(F.filter("base", lambda f: f.kind == kind)).cast("long").alias(f"n_{kind}")

    return rows.select("doc_id", *map(count, KINDS),
                       F.sha2(joined("base"), 256).alias("base_sha256"),
                       joined("findings").alias("spans"))
