"""Importance resampling towards a target distribution of hashed n-grams.

A document's features are its runs of one to three words, hashed by CRC-32
into buckets.  A bucket's gain is the logarithm of its share among the target
texts against its share in the corpus; a document weighs the sum of the gains
of its features, and the documents of the largest weight plus Gumbel noise are
drawn: a sample without replacement in proportion to the weights' exponents.

The checksums are worked out by length: the distinct features of a chunk of
texts that have equal length stand in one two-dimensional array of bytes, and
all their checksums are updated column by column.  The buckets are then
scattered back to the occurrences.  Features longer than ``LONGEST`` bytes,
which would each fill an array of their own, are summed one at a time.

Two passes read the texts: one counts the buckets of the whole corpus (only
sums of ``buckets`` numbers leave a task), one weighs every document.  Ranks
come from range partitions of narrow rows and their counts, never from one
ordered task.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowtally.llm.common import code_on_workers, numbered, store
from flowtally.llm.words import SPACE, Words, split_words, text_chunks

BUCKETS = 10_000
GRAMS = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = "42"
LONGEST = 256           # bytes of a feature that joins an array of its length
ROWS = 1 << 14          # features of one array
COPIES = 10_000         # equal rows that one task gives out

# A-Z lower-cased; words are 0-9, a-z and every byte of a character beyond ASCII.
LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else
                b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else SPACE for b in range(256))


def _crc_table() -> np.ndarray:
    """CRC-32 of each byte by the reflected polynomial."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


CRC_TABLE = _crc_table()


def crc32_slices(buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The CRC-32 of ``buf[start:start + length]`` for every pair."""
    out = np.zeros(len(starts), dtype=np.uint32)
    order = np.argsort(lengths, kind="stable")
    sizes, first = np.unique(lengths[order], return_index=True)
    for size, lo, hi in zip(sizes, first, [*first[1:], len(order)]):
        if size > LONGEST:
            for i in order[lo:hi]:
                out[i] = zlib.crc32(buf[starts[i]:starts[i] + size])
            continue
        for at in range(lo, hi, ROWS):
            rows = order[at:min(at + ROWS, hi)]
            columns = buf[starts[rows] + np.arange(size)[:, None]]      # one row of the array is a column of bytes
            crc = np.full(len(rows), 0xFFFFFFFF, dtype=np.uint32)
            for column in columns:
                crc = CRC_TABLE[(crc ^ column) & 0xFF] ^ (crc >> np.uint32(8))
            out[rows] = crc ^ np.uint32(0xFFFFFFFF)
    return out


def feature_buckets(words: Words, buckets: int = BUCKETS, grams: int = GRAMS
                    ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of 1, 2, ... words: the bucket of each distinct run, and for
    every occurrence the number of its run and of its text."""
    ids, vocabulary = words.encoded()
    texts = words.texts()
    places = np.arange(len(words))
    codes, distinct = ids, len(vocabulary)
    for n in range(1, grams + 1):
        if n > 1:
            longer = places[:-1][texts[places[:-1] + n - 1] == texts[places[:-1]]] if len(places) else places
            # a longer run is a shorter one and a word
            whole = np.zeros(len(words), dtype=np.int64)
            whole[places] = codes
            codes, found = pd.factorize(whole[longer] * len(vocabulary) + ids[longer + n - 1])
            places, distinct = longer, len(found)
        first = np.zeros(distinct, dtype=np.int64)
        first[codes[::-1]] = places[::-1]
        begin = words.starts[first]
        crc = crc32_slices(words.buf, begin, words.starts[first + n] - 1 - begin)
        yield (crc % buckets).astype(np.int64), codes, texts[places]


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS, grams: int = GRAMS) -> np.ndarray:
    """How many features of all texts of ``docs`` fall into each bucket."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets)
        for batch in batches:
            for chunk in text_chunks(batch):
                words = split_words(chunk.column("text"), LETTERS)
                for bucket, codes, _ in feature_buckets(words, buckets, grams):
                    total += np.bincount(bucket, weights=np.bincount(codes, minlength=len(bucket)),
                                         minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(held, pa.int32()),
                                          "n": pa.array(total[held].astype(np.int64))})

    sums = (docs.select("text").mapInArrow(counted, "bucket int, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).toArrow())        # at most ``buckets`` rows
    out = np.zeros(buckets, dtype=np.int64)
    out[sums["bucket"].to_numpy()] = sums["n"].to_numpy()
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Each bucket's gain in thousandths, floors going down."""
    all_corpus, all_target, size = int(corpus.sum()), int(target.sum()), len(corpus)
    return np.array([math.floor(1000 * math.log((t + 1.0) * (all_corpus + size)
                                                / ((s + 1.0) * (all_target + size))))
                     for s, t in zip(corpus.tolist(), target.tolist())], dtype=np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, grams: int = GRAMS, seed: str = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch):
                words = split_words(chunk.column("text"), LETTERS)
                n = len(words.per_text)
                weight, features = np.zeros(n), np.zeros(n, dtype=np.int64)
                for bucket, codes, text in feature_buckets(words, len(gain), grams):
                    weight += np.bincount(text, weights=gain[bucket][codes], minlength=n)
                    features += np.bincount(text, minlength=n)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": chunk.column("doc_id"), "n_words": pa.array(words.per_text),
                    "n_features": pa.array(features), "weight": pa.array(weight.astype(np.int64))})

    out = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
           .mapInArrow(run, "doc_id long, n_words long, n_features long, weight long"))
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    return out.withColumn("score", (F.col("weight") + noise).cast("long"))


def ranked(rows: DataFrame, order: list, top: int) -> DataFrame:
    """``rows`` with ``rank`` (1 for the first by ``order``, which names all
    columns; null beyond ``top``).

    Equal rows are one row with a count while they are ranked.  Rows are
    range-partitioned by the order; a partition's first rank is the number of
    rows in the partitions before it.
    """
    names = rows.columns
    parts = store(rows.groupBy(*names).agg(F.count("*").alias("times")).repartitionByRange(*order)
                  .withColumn("part", F.spark_partition_id()), "ranks")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)     # one row per partition
    base = (parts.groupBy("part").agg(F.sum("times").alias("n"))
            .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    within = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    first = (parts.withColumn("above", F.coalesce(F.sum("times").over(within), F.lit(0)))
             .join(base, "part").withColumn("first", F.col("above") + F.col("base") + 1))

    place = F.col("first") + F.col("i")
    return numbered(first.select(*names, "first", "times"), "times", "i", COPIES).select(
        *names, F.when(place <= top, place).alias("rank"))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
             buckets: int = BUCKETS, grams: int = GRAMS, seed: str = SEED) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row of ``docs``
    (doc_id, text) towards the texts of ``target`` (text); other columns are
    not read.

    Of the rows of at least ``least_words`` words the ``percent`` hundredths of
    the highest scores are drawn, ties to the smaller doc_id, a null doc_id
    last; others have rank null.  Null and empty texts have no features and
    weight 0.  Repeated rows are drawn each; a null doc_id takes the noise of an
    empty name.  An empty table of either kind counts no features; no
    documents give no rows.
    """
    code_on_workers(docs.sparkSession)
    docs, target = docs.select("doc_id", "text"), target.select("text")
    gain = gains(bucket_counts(docs, buckets, grams), bucket_counts(target, buckets, grams))
    rows = store(weighed(docs, gain, grams, seed), "importance")
    names = ["doc_id", "n_features", "weight", "score"]
    able = rows.filter(F.col("n_words") >= least_words).select(*names)
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight")]
    drawn = ranked(able, order, percent * able.count() // 100)
    rest = rows.filter(F.col("n_words") < least_words).select(*names, F.lit(None).cast("long").alias("rank"))
    return drawn.unionByName(rest)
