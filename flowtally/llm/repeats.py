"""Repeated passages by prefix-partitioned suffix trees over words.

A window is ``window`` successive words of a text: a suffix, read to that
depth.  A window that also starts in a document of a smaller doc_id is
repeated, and so are the words it covers.

Partition.  Suffixes are split by prefixes of variable length into groups that
fit into memory.  To let neighbouring suffixes share a group and travel as one
run of words (each alone would carry ``window`` words of its own), the prefix
that names a suffix's group is read from its anchor: of the runs of ``PREFIX``
words inside the window the one of the least hash.  Equal windows have equal
anchors, so they meet in one group.  Groups that hold one text only are dropped
before any text moves; only texts of which a window may repeat go on.  A prefix
that more than ``GROUP`` suffixes share is lengthened to the whole window,
which is one node of the tree: such suffixes are counted by it alone.

Subtrees.  The suffixes of a group are named level by level: their nodes at
depth 1, 2, 4, ... words and at the depth of the window, each level's node made
of two of the level above.  Words are compared, not hashes.  A node at the full
depth with leaves of several documents is a repeat; successive suffixes in such
nodes make a maximal passage of their text.

Equal texts are one text with the smallest doc_id while repeats are sought.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtally.llm.common import code_on_workers, store
from flowtally.llm.words import Words, split_words, text_chunks

WINDOW = 50
PREFIX = 8
GROUP = 1 << 14         # suffixes of a prefix that is not lengthened
TREE = 1 << 18          # suffixes whose subtrees one call builds, on average
SALTS = 16
UNNAMED = (1 << 63) - 1     # the place of a null doc_id, after all others
NOTHING = hashlib.sha256(b"").hexdigest()


def _odd_numbers(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


GRAM = _odd_numbers(1 << 10, 1)
FULL = _odd_numbers(1 << 10, 2), _odd_numbers(1 << 10, 3)


def word_hashes(words: Words) -> np.ndarray:
    """A 64-bit hash of every word."""
    ids, vocabulary = words.encoded()
    digest = xxhash.xxh64_intdigest
    return np.fromiter(map(digest, vocabulary.to_pylist()), dtype=np.uint64, count=len(vocabulary))[ids]


def anchor_keys(hashes: np.ndarray, prefix: int, window: int) -> np.ndarray:
    """For every window the least hash of its runs of ``prefix`` words."""
    n = len(hashes) - prefix + 1
    grams = np.zeros(n, dtype=np.uint64)
    for j in range(prefix):
        grams += hashes[j:j + n] * GRAM[j]
    grams ^= grams >> np.uint64(32)
    grams *= GRAM[-1]
    grams ^= grams >> np.uint64(29)
    width, span = window - prefix + 1, 1
    while 2 * span <= width:
        grams = np.minimum(grams[:-span], grams[span:])
        span *= 2
    return np.minimum(grams[:len(grams) - (width - span)], grams[width - span:]) if span < width else grams


def window_places(words: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The first word of every window, and its text."""
    n = np.maximum(words.per_text - window + 1, 0)
    text = np.repeat(np.arange(len(n)), n)
    first = words.bounds()[:-1]
    return np.arange(n.sum()) + np.repeat(first - np.cumsum(n) + n, n), text


def _slices(cuts: np.ndarray, total: int) -> np.ndarray:
    return np.diff(np.concatenate([cuts, [total]]))


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(kind.to_pandas_dtype())))


def anchored_runs(docs: DataFrame, window: int, prefix: int, keep_text: bool) -> DataFrame:
    """doc_id, h1, h2, n_words and digest of every row, and its runs of
    successive windows of one anchor: keys, starts and sizes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch):
                words = split_words(chunk.column("text"))
                place, text = window_places(words, window)
                keys = anchor_keys(word_hashes(words), prefix, window)[place] if len(place) else np.zeros(0, np.uint64)
                new = np.ones(len(place), dtype=bool)
                new[1:] = (keys[1:] != keys[:-1]) | (text[1:] != text[:-1])
                cuts = np.flatnonzero(new)
                per_text = np.bincount(text[cuts], minlength=chunk.num_rows)
                bounds = words.bounds()
                joined = [words.buf[words.starts[a]:max(words.starts[b] - 1, words.starts[a])].tobytes()
                          for a, b in zip(bounds, bounds[1:])]
                out = {
                    **{c: chunk.column(c) for c in ("doc_id", "h1", "h2")},
                    "n_words": pa.array(words.per_text),
                    "digest": pa.array([hashlib.sha256(x).hexdigest() for x in joined], pa.string()),
                    "keys": _lists(keys[cuts].view(np.int64), per_text, pa.int64()),
                    "starts": _lists(place[cuts] - bounds[text[cuts]], per_text, pa.int32()),
                    "sizes": _lists(_slices(cuts, len(place)), per_text, pa.int32())}
                if keep_text:
                    out["kept"] = pa.array([x.decode() for x in joined], pa.string())
                yield pa.RecordBatch.from_pydict(out)

    return docs.mapInArrow(run, "doc_id long, h1 long, h2 long, n_words long, digest string, keys array<long>, "
                                "starts array<int>, sizes array<int>" + (", kept string" if keep_text else ""))


def _hits(chunk: pa.RecordBatch, words: Words, crowded: bool):
    """(row, first word, start, size) of the runs of a chunk's texts that are
    (not) ``crowded``, one entry a run."""
    hits = chunk.column("hits")
    flat = hits.flatten()
    row = np.repeat(np.arange(chunk.num_rows), np.diff(hits.offsets.to_numpy()))
    mine = flat.field("crowded").to_numpy(zero_copy_only=False) == crowded
    start = flat.field("start").to_numpy(zero_copy_only=False)[mine].astype(np.int64)
    size = flat.field("size").to_numpy(zero_copy_only=False)[mine].astype(np.int64)
    key = flat.field("key").to_numpy(zero_copy_only=False)[mine]
    return row[mine], words.bounds()[row[mine]] + start, start, size, key


def group_pieces(texts: DataFrame, window: int) -> DataFrame:
    """The runs of words that go to the subtrees: key, h1, h2, own, start, words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch):
                words = split_words(chunk.column("text"))
                row, first, start, size, key = _hits(chunk, words, crowded=False)
                lo, hi = words.starts[first], words.starts[first + size + window - 1] - 1
                yield pa.RecordBatch.from_pydict({
                    "key": pa.array(key), **{c: chunk.column(c).take(pa.array(row)) for c in ("h1", "h2", "own")},
                    "start": pa.array(start.astype(np.int32)),
                    "words": pa.array([words.buf[a:b].tobytes() for a, b in zip(lo, hi)], pa.binary())})

    return texts.mapInArrow(run, "key long, h1 long, h2 long, own long, start int, words binary")


def nodes_at(ids: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """A number for the first ``depth`` words from every place, equal for
    equal words: the suffixes' nodes at that depth."""
    names, length = ids, 1
    while 2 * length <= depth:
        later = np.concatenate([names[length:], np.zeros(min(length, len(names)), dtype=np.int64)])
        names = pd.factorize(names * (names.max(initial=0) + 1) + later)[0].astype(np.int64)
        length *= 2
    return pd.factorize(names[places] * (names.max(initial=0) + 1) + names[places + depth - length])[0]


def _passages(run: np.ndarray, start: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(run, from, to) of the words that successive windows of a run cover."""
    new = np.ones(len(run), dtype=bool)
    new[1:] = (run[1:] != run[:-1]) | (start[1:] != start[:-1] + 1)
    cuts = np.flatnonzero(new)
    return run[cuts], start[cuts], start[cuts] + _slices(cuts, len(run)) - 1 + window


PASSAGES = "h1 long, h2 long, lo int, hi int"


def subtree_passages(pieces: pa.Table, window: int) -> pa.Table:
    """h1, h2 and the passages (words ``lo`` to ``hi``) of the given runs that
    start in a text of a smaller doc_id too."""
    pieces = pieces.combine_chunks()
    words = split_words(pieces.column("words").combine_chunks())
    place, run = window_places(words, window)
    start = pieces.column("start").to_numpy().astype(np.int64)[run] + place - words.bounds()[run]
    node = nodes_at(words.encoded()[0], place, window)
    own = pieces.column("own").to_numpy()[run]
    first = np.full(node.max(initial=-1) + 1, UNNAMED, dtype=np.int64)
    np.minimum.at(first, node, own)
    again = own > first[node]
    run, lo, hi = _passages(run[again], start[again], window)
    return pa.table({"h1": pieces.column("h1").take(pa.array(run)), "h2": pieces.column("h2").take(pa.array(run)),
                     "lo": pa.array(lo, pa.int32()), "hi": pa.array(hi, pa.int32())})


def crowded_windows(texts: DataFrame, window: int) -> DataFrame:
    """Every window of the crowded groups by two 64-bit hashes of all its
    words: w1, w2, h1, h2, own, start."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch):
                words = split_words(chunk.column("text"))
                row, first, start, size, _ = _hits(chunk, words, crowded=True)
                step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                place, row = np.repeat(first, size) + step, pa.array(np.repeat(row, size))
                hashes = word_hashes(words)
                whole = [np.zeros(len(place), dtype=np.uint64) for _ in FULL]
                for j in range(window):
                    at = hashes[place + j]
                    for total, numbers in zip(whole, FULL):
                        total += at * numbers[j % len(numbers)]
                yield pa.RecordBatch.from_pydict({
                    "w1": pa.array(whole[0].view(np.int64)), "w2": pa.array(whole[1].view(np.int64)),
                    **{c: chunk.column(c).take(row) for c in ("h1", "h2", "own")},
                    "start": pa.array((np.repeat(start, size) + step).astype(np.int32))})

    return texts.mapInArrow(run, "w1 long, w2 long, h1 long, h2 long, own long, start int")


def crowded_passages(texts: DataFrame, window: int) -> DataFrame:
    """h1, h2, lo, hi of the crowded groups' windows that repeat."""
    windows = crowded_windows(texts.filter(F.exists("hits", lambda x: x.crowded)), window)
    nodes = (windows.groupBy("w1", "w2").agg(F.min("own").alias("first"), F.max("own").alias("last"))
             .filter("first < last").select("w1", "w2", "first",
                                            F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    salted = windows.withColumn("salt", F.pmod("h1", F.lit(SALTS)).cast("int"))
    return (salted.join(nodes, ["w1", "w2", "salt"]).filter("own > first")
            .select("h1", "h2", F.col("start").alias("lo"), (F.col("start") + window).alias("hi")))


def _cut(texts: DataFrame, keep_text: bool) -> DataFrame:
    """h1, h2, n_removed, digest and spans of texts with their passages."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch):
                words = split_words(chunk.column("text"))
                bounds = words.bounds()
                removed, digests, spans, texts = [], [], [], []
                for i, passages in enumerate(chunk.column("passages").to_pylist()):
                    joined: list[list[int]] = []
                    for lo, hi in sorted((p["lo"], p["hi"]) for p in passages):
                        if joined and lo <= joined[-1][1]:
                            joined[-1][1] = max(hi, joined[-1][1])
                        else:
                            joined.append([lo, hi])
                    edges = [0, *(x for span in joined for x in span), int(words.per_text[i])]
                    at = words.starts[bounds[i] + np.array(edges)]
                    kept = b"".join(words.buf[a:b].tobytes() for a, b in zip(at[::2], at[1::2]))[:-1]
                    removed.append(sum(hi - lo for lo, hi in joined))
                    digests.append(hashlib.sha256(kept).hexdigest())
                    spans.append([{"lo": lo, "hi": hi} for lo, hi in joined])
                    texts.append(kept.decode())
                out = {**{c: chunk.column(c) for c in ("h1", "h2")}, "n_removed": pa.array(removed, pa.int64()),
                       "cut_digest": pa.array(digests, pa.string()),
                       "cut_spans": pa.array(spans, pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())])))}
                if keep_text:
                    out["cut_text"] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_pydict(out)

    return texts.mapInArrow(run, "h1 long, h2 long, n_removed long, cut_digest string, "
                                 "cut_spans array<struct<lo: int, hi: int>>" + (", cut_text string" if keep_text else ""))


def without_repeats(docs: DataFrame, window: int = WINDOW, prefix: int = PREFIX, group: int = GROUP,
                    tree: int = TREE, keep_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and spans (removed words from
    ``lo`` up to ``hi``) of every row of ``docs`` (doc_id, text; other columns
    are not read), with ``keep_text`` also the kept words, joined by spaces.

    A null doc_id comes after all others and none is smaller than another, as
    with rows of one doc_id: they do not lose words to each other.  Null and
    empty texts, and texts of fewer words than a window, lose none.  Repeated
    rows each give a row.  An empty table gives no rows.
    """
    code_on_workers(docs.sparkSession)
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Two hashes of 64 bits stand for a text.
    named = named.withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(7), "text")})
    runs = store(anchored_runs(named, window, prefix, keep_text), "repeats-runs")
    place = F.coalesce("doc_id", F.lit(UNNAMED))
    owners = store(runs.filter(F.col("n_words") >= window).groupBy("h1", "h2").agg(
        F.min(place).alias("own"), F.first(F.arrays_zip("keys", "starts", "sizes")).alias("runs")), "repeats-owners")
    heads = owners.select("h1", "h2", "own", F.inline("runs")).withColumnsRenamed(
        {"keys": "key", "starts": "start", "sizes": "size"})
    groups = store(heads.groupBy("key").agg(F.sum("size").alias("n"), F.min("own").alias("first"),
                                            F.max("own").alias("last")).filter("first < last")
                   .select("key", "n", (F.col("n") > group).alias("crowded")), "repeats-groups")
    # Only groups of several texts go on; a crowded one's runs are dealt by salt.
    salted = groups.select("key", "crowded", F.explode(F.when(
        F.col("crowded"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))).alias("salt"))
    dealt = heads.withColumn("salt", F.pmod("h1", F.lit(SALTS)).cast("int"))
    some = dealt.drop("salt").join(salted.filter("NOT crowded").drop("salt"), "key")
    many = dealt.join(salted.filter("crowded"), ["key", "salt"]).drop("salt")
    hits = (some.unionByName(many).groupBy("h1", "h2", "own")
            .agg(F.collect_list(F.struct("key", "start", "size", "crowded")).alias("hits")))
    distinct = named.filter("text IS NOT NULL").groupBy("h1", "h2").agg(F.first("text").alias("text"))
    texts = store(distinct.join(hits, ["h1", "h2"]), "repeats-texts")
    suffixes = groups.filter("NOT crowded").agg(F.sum("n")).first()[0] or 0        # one number
    buckets = max(64, math.ceil(suffixes / tree))
    pieces = group_pieces(texts, window).withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets))).drop("key")

    def subtrees(table: pa.Table) -> pa.Table:
        return subtree_passages(table, window)

    found = pieces.groupBy("bucket").applyInArrow(subtrees, PASSAGES).unionByName(crowded_passages(texts, window))
    passages = found.groupBy("h1", "h2").agg(F.collect_list(F.struct("lo", "hi")).alias("passages"))
    cut = _cut(texts.select("h1", "h2", "text").join(passages, ["h1", "h2"]), keep_text)
    facts = owners.select("h1", "h2", "own").join(cut, ["h1", "h2"], "left")
    whole = place > F.col("own")        # a copy of a text of a smaller doc_id
    none = F.lit(None).cast("array<struct<lo: int, hi: int>>")
    return (runs.drop("keys", "starts", "sizes").join(facts, ["h1", "h2"], "left").select(
        "doc_id", "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, F.lit(NOTHING)).otherwise(F.coalesce("cut_digest", "digest")).alias("kept_sha256"),
        F.when(whole, F.array(F.struct(F.lit(0).alias("lo"), F.col("n_words").cast("int").alias("hi"))))
        .otherwise(F.coalesce("cut_spans", none, F.array().cast("array<struct<lo: int, hi: int>>"))).alias("spans"),
        *([F.when(whole, F.lit("")).otherwise(F.coalesce("cut_text", "kept")).alias("kept")] if keep_text else [])))
