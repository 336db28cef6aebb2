"""SimHash near-duplicates through covering locality-sensitive hashing.

A document's 64-bit fingerprint holds, bit by bit, the majority over the
XXH64 values of its word shingles.  Fingerprints that differ in at most
``max_bits`` bits are linked, and linked documents form components.

Candidate search.  For radius ``r`` every bit position gets a nonzero vector
of ``GF(2)^(r+1)``.  Each of the ``2^(r+1) - 1`` nonzero vectors ``v`` gives a
table whose mask keeps the positions with an odd inner product with ``v``.
The vectors of at most ``r`` differing positions span at most ``r``
dimensions, so some ``v`` is orthogonal to all of them: that table masks every
difference away and the pair collides there.  No pair within the radius is
lost, and there is no probability involved.

Scale.  Only distinct fingerprints enter the tables.  A bucket is never
gathered whole: buckets above ``CHUNK`` fingerprints are dealt into chunks and
every pair of chunks is compared in a group of its own.  From a group only a
spanning forest of its links leaves, at most one link per fingerprint, so a
dense group never turns into all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from flowtally.llm.common import code_on_workers, protected, store

SEED = 42
CHUNK = 2048        # fingerprints of one bucket chunk
SLICE = 1 << 15     # shingles whose bits are counted at a time


def text_fingerprint(text: str | None, shingle: int = 3) -> int:
    """The fingerprint of one text as an unsigned 64-bit number.

    Words are runs of anything but ASCII white space, A-Z lower-cased; a text
    of fewer than ``shingle`` words is one shingle, one without words (or
    null) has fingerprint zero.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = list(map(b" ".join, zip(*(words[i:] for i in range(shingle)))))
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(grams), SLICE):
        part = grams[at:at + SLICE]
        h = np.fromiter((digest(g, SEED) for g in part), dtype="<u8", count=len(part))
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    kept = np.packbits(ones * 2 > len(grams), bitorder="little")
    return int(kept.view("<u8")[0])


def fingerprint_udf(shingle: int):
    @pandas_udf("long")
    def fingerprint(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            fps = [text_fingerprint(t, shingle) for t in batch]
            yield pd.Series(np.array(fps, dtype=np.uint64).view(np.int64))
    return fingerprint


def masks(max_bits: int, width: int = 64) -> list[int]:
    """The table masks for ``max_bits``, as signed 64-bit numbers."""
    vectors = (1 << (max_bits + 1)) - 1
    given = [1 + i % vectors for i in range(width)]
    out = []
    for v in range(1, vectors + 1):
        mask = sum(1 << i for i, m in enumerate(given) if (m & v).bit_count() % 2)
        out.append(mask - (1 << 64) if mask >> 63 else mask)
    return out


def spanning_links(values: np.ndarray, max_bits: int) -> list[int]:
    """A spanning forest of the links within ``values``: a, b, a, b, ..."""
    out: list[int] = []
    rest = np.sort(values.view(np.uint64))
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            near = np.bitwise_count(rest ^ at) <= max_bits
            if near.any():
                found = rest[near]
                rest = rest[~near]
                queue.extend(found)
                for x in found.view(np.int64):
                    out += (int(at.view(np.int64)), int(x))
    return out


def _links_udf(max_bits: int):
    @pandas_udf("array<long>")
    def links(groups: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in groups:
            yield pd.Series([spanning_links(np.asarray(g, dtype=np.int64), max_bits)
                             for g in batch], dtype=object)
    return links


def near_links(fps: DataFrame, max_bits: int, chunk: int = CHUNK) -> DataFrame:
    """Links (u, v), u > v, that connect all pairs of the distinct ``fp``
    values of ``fps`` within ``max_bits``: every such pair is joined by a path."""
    keys = F.array(*(F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in masks(max_bits)))
    rows = fps.select("fp", F.posexplode(keys).alias("t", "key"))
    sizes = rows.groupBy("t", "key").agg(F.count("*").alias("n")).filter("n > 1")
    parts = F.ceil(F.col("n") / F.lit(chunk)).cast("int")
    dealt = (rows.join(sizes, ["t", "key"])
             .withColumn("parts", parts)
             .withColumn("mine", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))))
    groups = (dealt.groupBy("t", "key", F.least("mine", "other").alias("lo"),
                            F.greatest("mine", "other").alias("hi"))
              .agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1))
    flat = groups.select(_links_udf(max_bits)("fps").alias("e")).filter(F.size("e") > 0)
    pair = F.explode(F.expr("transform(sequence(0, size(e) div 2 - 1), "
                            "i -> struct(greatest(e[2*i], e[2*i+1]) AS u, "
                            "least(e[2*i], e[2*i+1]) AS v))")).alias("p")
    return flat.select(pair).select("p.u", "p.v").distinct()


def connected(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of ``links`` (u > v); the root is the
    smallest node of the component.

    Alternating large-star and small-star steps: each joins the links with
    one minimum per node, so a node with many links is never gathered.  Every
    round is a written table.
    """
    edges, mark = store(links, name), None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        low = low.select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").filter("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").filter("v > m").select(F.col("v").alias("u"),
                                                              F.col("m").alias("v"))
        edges = store(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), name)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == tuple(now):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = tuple(now)


def _rooted(nodes: DataFrame, max_bits: int) -> DataFrame:
    """fp, rep and the root of its component for distinct ``fp``."""
    roots = connected(near_links(nodes.select("fp"), max_bits))
    return (nodes.join(roots, nodes.fp == roots.node, "left")
            .select("fp", "rep", F.coalesce("root", "fp").alias("root")))


def simhash_components(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row of
    ``docs`` (doc_id, text; other columns are not read).

    component_id is the smallest doc_id reachable over links of at most
    ``max_bits`` differing bits, the document's own included.  Null and empty
    texts have fingerprint zero and link like any other; repeated rows each
    give a row; a null doc_id takes the smallest doc_id of its component, null
    if it has none.  An empty table gives an empty result.
    """
    code_on_workers(docs.sparkSession)
    prints = store(docs.select("doc_id", fingerprint_udf(shingle)("text").alias("fp")),
                   "fingerprints")
    tree = _rooted(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), max_bits)
    least = tree.groupBy("root").agg(F.min("rep").alias("component_id"))
    classes = tree.join(least, "root").select("fp", "component_id")
    return (prints.join(classes, "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    "component_id"))


def one_per_component(docs: DataFrame, shingle: int, max_bits: int) -> DataFrame:
    """``docs`` with one row of every component: that of its smallest doc_id.

    All columns are kept, whatever their names.  Null and empty texts are
    copies of each other.  A null doc_id comes after all others; of rows that
    share the doc_id the one of the smallest text hash, then row hash, stays,
    and of rows that are equal in all columns one.  An empty table gives no
    rows.
    """
    code_on_workers(docs.sparkSession)
    given, docs = docs.columns, protected(docs)
    names = docs.columns
    rows = store(docs.select("doc_id", fingerprint_udf(shingle)("text").alias("fp"),
                             F.xxhash64("text").alias("of_text"), F.xxhash64(*names).alias("of_row"))
                 .groupBy("fp", "doc_id", "of_text", "of_row").agg(F.count("*").alias("times")), "simhash")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "of_text", "of_row", "times")
    tree = _rooted(rows.groupBy("fp").agg(F.min(place).alias("rep")), max_bits)
    kept = tree.groupBy("root").agg(F.min("rep").alias("kept")).select(
        F.col("kept.doc_id").alias("__id"), F.col("kept.of_text").alias("__text"),
        F.col("kept.of_row").alias("__row"), F.col("kept.times").alias("__times"))
    own = docs.select("*", F.xxhash64("text").alias("__of_text"), F.xxhash64(*names).alias("__of_row"))
    match = own.join(kept, (F.col("__of_row") == F.col("__row")) & (F.col("__of_text") == F.col("__text"))
                     & F.col("doc_id").eqNullSafe(F.col("__id")))
    once = match.filter("__times = 1").select(*names)
    # Rows that are equal in every column.
    repeated = match.filter("__times > 1").dropDuplicates(["__id", "__text", "__row"]).select(*names)
    return once.unionByName(repeated).toDF(*given)
