"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected ``target / source size`` times.  With
the documents of a source in a fixed order, the prefix sums of these
expectations start at one random offset per source, and a document is emitted
once for each integer that its step crosses.  The order goes by size class
first, so large and small documents are taken in the same proportion and the
words taken come near the target.

The order within a source is never made in one task: documents are counted by
(source, size class, bucket), the counts are summed over these small tables,
and rows are numbered within one bucket only.  Rows that share doc_id, source
and size are one row with a count meanwhile, however many they are.  DataFrame
functions throughout.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowtally.llm.common import WORD_PATTERN, numbered, protected, store

WEIGHTS = (5, 2, 1)
MOST = 3                # times its size that a source, and a document, may be taken
CLASSES_PER_OCTAVE = 16
BUCKET_ROWS = 20_000    # rows of a (source, size class) per bucket, on average
SEED = "mix-1"
FRACTION = 1 << 52


def _number(text):
    """A number in [0, 1) from the MD5 of a text."""
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(FRACTION))


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size and target for a table (source, source_size).

    Sources by code point, null last, take ``weights`` in turn.  A target is
    ``min(weight * level, most * size)``, with the level at which all targets
    add up to all sizes: sources are capped in the order of their cap per
    weight, and the level is what the others then share.
    """
    # One row per source: the only ordering over the whole (small) table.
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("long")
    ranked = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy())
    level = ((total - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast("double")
             / F.sum("weight").over(rest))
    # The level is the first at which a source stays below its cap; later ones
    # (which cap a source that need not be) are lower.
    levels = ranked.withColumn("level", level)
    free = levels.withColumn("free", F.when(F.col("weight") * F.col("level") <= F.col("cap"),
                                            F.col("level")))
    final = F.max("free").over(Window.partitionBy())
    return free.withColumn("final", final).select(
        "source", "source_size",
        F.when(F.col("final").isNull(), F.col("cap").cast("double"))
        .otherwise(F.least(F.col("weight") * F.col("final"), F.col("cap").cast("double")))
        .alias("target"))


def copies(sized: DataFrame, weights=WEIGHTS, most: int = MOST, seed: str = SEED,
           bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The distinct rows of ``sized`` (doc_id, source, size) with how many there
    are (times), the place of the first in its source's order (first), what
    the k-th at place ``p`` is taken: whole steps crossed from ``(p - 1) * share +
    offset`` to ``p * share + offset``; the copies of all, source_size and target."""
    stats = store(sized.groupBy("source").agg(F.sum("size").alias("source_size"),
                                              F.count("*").alias("docs")), "mix-sources")
    goal = targets(stats.select("source", "source_size"), weights, most)
    largest = stats.agg(F.max("docs")).first()[0] or 0      # one number, for the bucket count
    buckets = max(16, math.ceil(largest / bucket_rows))
    octave = F.floor(F.log2(F.col("size") + F.lit(1)) * F.lit(CLASSES_PER_OCTAVE))
    key = F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string"))
    rows = (sized.groupBy("doc_id", "source", "size").agg(F.count("*").alias("times"))
            .withColumn("size_class", octave.cast("int"))
            .withColumn("draw", _number(key))
            .withColumn("bucket", F.floor(F.col("draw") * buckets).cast("int")))
    group = ["source", "size_class", "bucket"]
    counts = rows.groupBy(*group).agg(F.sum("times").alias("n"))
    in_class = Window.partitionBy("source", "size_class").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    classes = counts.groupBy("source", "size_class").agg(F.sum("n").alias("n"))
    in_source = Window.partitionBy("source").orderBy("size_class").rowsBetween(
        Window.unboundedPreceding, -1)
    start = classes.select(F.col("source").alias("s"), F.col("size_class").alias("c"),
                           F.coalesce(F.sum("n").over(in_source), F.lit(0)).alias("class_base"))
    base = (counts.withColumn("bucket_base", F.coalesce(F.sum("n").over(in_class), F.lit(0)))
            .join(start, F.col("source").eqNullSafe(F.col("s"))
                  & (F.col("size_class") == F.col("c")))
            .select(F.col("source").alias("s"), F.col("size_class").alias("c"),
                    F.col("bucket").alias("b"),
                    (F.col("class_base") + F.col("bucket_base")).alias("base")))
    above = (Window.partitionBy(*group).orderBy("draw", "doc_id", "size")
             .rowsBetween(Window.unboundedPreceding, -1))
    ranked = (rows.withColumn("number", F.coalesce(F.sum("times").over(above), F.lit(0)) + 1)
              .join(base, F.col("source").eqNullSafe(F.col("s")) & (F.col("size_class") == F.col("c"))
                    & (F.col("bucket") == F.col("b")))
              .withColumn("first", F.col("number") + F.col("base")))
    goal = goal.select(F.col("source").alias("g"), "source_size", "target")
    share = F.when(F.col("source_size") > 0,
                   F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = _number(F.concat_ws(":", F.lit(seed), F.lit("offset"),
                                 F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("null"))))
    return (ranked.join(F.broadcast(goal) if _few(stats) else goal,
                        F.col("source").eqNullSafe(F.col("g")))
            .withColumns({"share": share, "offset": offset})
            .withColumn("copies", _crossed(F.col("first"), F.col("times"))))


def _crossed(first, times):
    """The integers crossed by ``times`` rows from place ``first`` on."""
    def at(place):
        return F.floor(place * F.col("share") + F.col("offset"))

    return (at(first + times - 1) - at(first - 1)).cast("long")


def _few(stats: DataFrame, bound: int = 50_000) -> bool:
    """Whether the table of sources is small enough to be sent to every task."""
    return stats.limit(bound + 1).count() <= bound


def mix(docs: DataFrame, weights=WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """doc_id, size, source_size, target and taken for every row of ``docs``
    (doc_id, source, text; other columns are not read).

    A null text has size 0; a null source is a source of its own, the last.
    Documents without words are drawn like any other and take no words.  A
    source without words has target 0.  Repeated rows are drawn each; a null
    doc_id draws like an id of its own.  An empty table gives no rows.
    """
    sized = store(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")),
                  "mix-sizes")
    drawn = copies(sized, weights, most, seed).select("doc_id", "size", "source_size", "target", "times", "first",
                                                      "share", "offset")
    taken = _crossed(F.col("first") + F.col("i"), F.lit(1)) * F.col("size")
    return numbered(drawn, "times", "i").select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def mixed_documents(docs: DataFrame, weights=WEIGHTS, most: int = MOST,
                    seed: str = SEED) -> DataFrame:
    """``docs`` with every row as often as the mix takes it, all columns kept.

    Rows that repeat a doc_id, source and size are interchangeable to the
    draw: their copies are dealt among them in turn.  A null text has size 0
    and is drawn like any other; a null source is a source of its own, the
    last; a null doc_id draws like an id of its own.  An empty table gives no
    rows.
    """
    given, docs = docs.columns, protected(docs)
    sized = store(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")),
                  "mix-sizes")
    drawn = (copies(sized, weights, most, seed)
             .select(F.col("doc_id").alias("__d"), F.col("source").alias("__s"),
                     F.col("size").alias("__n"), F.col("copies").alias("__copies"),
                     F.col("times").alias("__times")))
    rows = docs.withColumn("__size", word_count(F.col("text")))
    joined = rows.join(drawn, F.col("doc_id").eqNullSafe(F.col("__d"))
                       & F.col("source").eqNullSafe(F.col("__s")) & (F.col("__size") == F.col("__n")))
    names = docs.columns
    once = joined.filter("__times = 1")
    many = joined.filter("__times > 1").withColumn("__turn", F.row_number().over(
        Window.partitionBy("__d", "__s", "__n").orderBy("text")))
    share = (F.floor((F.col("__copies") + F.col("__times") - F.col("__turn")) / F.col("__times"))
             .cast("long"))
    both = (once.select(*names, "__copies")
            .unionByName(many.select(*names, share.alias("__copies"))))
    return (both.filter("__copies > 0")
            .withColumn("__each", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))))
            .select(*names).toDF(*given))


ORACLE_SQL = f"""
WITH sized AS (
  SELECT doc_id, source,
         CASE WHEN text IS NULL THEN 0
              ELSE len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) END::BIGINT AS size
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
            WHEN 0 THEN {WEIGHTS[0]} WHEN 1 THEN {WEIGHTS[1]} ELSE {WEIGHTS[2]} END AS weight,
         source_size * {MOST} AS cap
  FROM sources),
levels AS (
  SELECT *, (sum(source_size) OVER ()
             - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
                        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
final AS (SELECT max(level) AS level FROM levels WHERE weight * level <= cap),
goals AS (
  SELECT l.source, l.source_size,
         CASE WHEN f.level IS NULL THEN cap::DOUBLE ELSE least(weight * f.level, cap::DOUBLE) END AS target
  FROM levels l, final f),
drawn AS (
  SELECT s.*, g.source_size, g.target,
         CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0::DOUBLE END AS share,
         row_number() OVER (PARTITION BY s.source
           ORDER BY floor(log2(size + 1) * {CLASSES_PER_OCTAVE}),
                    ('0x' || substr(md5('{SEED}:' || doc_id::VARCHAR), 1, 13))::BIGINT, doc_id, size) AS rank,
         ('0x' || substr(md5('{SEED}:offset:' || coalesce('s' || s.source, 'null')), 1, 13))::BIGINT
           / {FRACTION}::DOUBLE AS start
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       ((floor(rank * share + start) - floor((rank - 1) * share + start)) * size)::BIGINT AS taken
FROM drawn
"""
