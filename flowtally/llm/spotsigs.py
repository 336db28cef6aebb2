"""SpotSigs document fingerprints, with DataFrame functions only.

A signature is a common word (the anchor) and the chain of the next ``CHAIN``
content words, common words skipped.  A document's fingerprint is its set of
signatures, as 64-bit hashes; boilerplate has few anchors and adds little.
Likeness is the Jaccard coefficient of two sets.

Near-duplicate search deals sets into partitions by their length, such that
sets of one partition can only match within it and the next.  Inside, sets
meet over the rarest signatures of their prefix (sets that share none of these
cannot reach the threshold), lengths prune further, and what is left is
compared in full.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowtally.llm.common import store

# Common words of English, German, French and Spanish.
ANCHORS = (
    "a an and are as at be by for from had has have he her his in is it of on or she that the "
    "their they this to was were which with "
    "das dem den der des die ein eine einer es für ich im ist mit nicht sich sie und von war wie zu "
    "au aux avec ce dans de des du elle en est et il je la le les par pas pour que qui se sur un une "
    "con del el lo los las más no para por su sus una y como pero"
).split()
CHAIN = 2
BUCKET_ROWS = 500       # neighbouring documents of one bucket, on average
MOST_BUCKETS = 1 << 16  # with more rows the buckets grow instead


def signatures(text: Column, chain: int = CHAIN, anchors=ANCHORS) -> Column:
    """The sorted distinct signatures of a text (null: empty).

    A text without any has one that stands for the whole text, so that equal
    texts always have equal sets.
    """
    common = "(?:" + "|".join(sorted(set(anchors))) + ") "
    plain = F.concat(F.lit(" "), F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))),
                                                  r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    # One line per content word: the common words before it, then itself.
    lines = F.split(F.regexp_replace(F.regexp_replace(plain, " {2,}", " "),
                                     f"(?<= )(?!{common})([^ ]+) ", "$1\n"), "\n")

    def chains(run: Column) -> Column:
        def of_line(line: Column, i: Column) -> Column:
            words = F.split(F.ltrim(line), " ")
            following = [F.substring_index(F.get(run, i + k), " ", -1) for k in range(chain)]
            return F.when(
                (i + chain < F.size(run)) & F.contains(F.ltrim(line), F.lit(" ")),
                F.transform(F.slice(words, F.lit(1), F.size(words) - 1),
                            lambda anchor: F.xxhash64(anchor, *following)))
        return F.flatten(F.filter(F.transform(run, of_line), lambda x: x.isNotNull()))

    # Inside a lambda the lines are worked out once.
    found = F.get(F.transform(F.array(lines), lambda run: F.array_sort(F.array_distinct(chains(run)))), F.lit(0))
    whole = F.array(F.xxhash64(F.lit("text"), F.coalesce(text, F.lit(""))))
    return F.get(F.transform(F.array(found), lambda x: F.when(F.size(x) > 0, x).otherwise(whole)), F.lit(0))


def digest(sigs: Column) -> Column:
    """The fingerprint as text: SHA-256 over the signatures in order."""
    return F.sha2(F.array_join(F.transform(sigs, lambda s: F.hex(s)), ","), 256)


def likeness(a: Column, b: Column) -> Column:
    """The Jaccard coefficient of two signature sets."""
    both = F.size(F.array_intersect(a, b))
    return (both / (F.size(a) + F.size(b) - both)).cast("double")


def _bucketed(rows: DataFrame, bucket_rows: int) -> DataFrame:
    """``rows`` with ``bucket``, runs of neighbouring doc_ids of about
    ``bucket_rows`` rows; a bucket also gets the row that follows its last
    one, as ``guest``.

    The bounds are doc_ids that occur, each the largest of its bucket, so the
    row that follows a bucket is the one at the bound of the bucket below; the
    lowest bucket is followed by the largest doc_id.
    """
    n, top = rows.agg(F.count("doc_id"), F.max("doc_id")).first()
    buckets = min(MOST_BUCKETS, max(1, math.ceil(n / bucket_rows)))
    cuts = rows.agg(F.percentile_approx(
        "doc_id", [k / buckets for k in range(1, buckets)] or [0.5],
        max(10_000, 10 * buckets))).first()[0]      # at most MOST_BUCKETS numbers
    bounds = sorted({*(cuts or []), *([] if top is None else [top])})
    if not bounds:
        return rows.select("*", F.lit(0).alias("bucket"), F.lit(False).alias("guest"))
    # The number of bounds below an id, by a coarse and a fine step.
    step = math.ceil(math.sqrt(len(bounds)))
    many, few = F.array(*map(F.lit, bounds)), F.array(*map(F.lit, bounds[::step]))
    low = F.greatest(F.size(F.filter(few, lambda b: b < F.col("doc_id"))) - 1, F.lit(0)) * step
    own = low + F.size(F.filter(F.slice(many, low + 1, F.lit(step)), lambda b: b < F.col("doc_id")))
    placed = rows.withColumn("own", F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(own))
    at_bound = F.col("doc_id") == F.element_at(many, F.col("own") + 1)
    after = F.pmod(F.col("own") + 1, F.lit(len(bounds)))
    seats = F.when(at_bound, F.array(
        F.struct(F.col("own").alias("bucket"), F.lit(False).alias("guest")),
        F.struct(after.alias("bucket"), F.lit(True).alias("guest")))).otherwise(F.array(
            F.struct(F.col("own").alias("bucket"), F.lit(False).alias("guest"))))
    return placed.withColumn("seat", F.explode(seats)).select(
        *rows.columns, "seat.bucket", "seat.guest")


def with_next(docs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, text and the next document's text: descending doc_id, null ones
    last, rows that repeat a doc_id by text; after the last comes the first.
    Texts are shuffled once, into buckets of neighbours."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = _bucketed(rows, bucket_rows)
    order = Window.partitionBy("bucket").orderBy("guest", F.col("doc_id").desc_nulls_last(), "text")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = F.coalesce(F.lead("text", 1).over(order), F.first("text").over(whole))
    return (rows.withColumn("next_text", following).filter("NOT guest")
            .select("doc_id", "text", "next_text"))


def edited_text(text: Column, following: Column) -> Column:
    """``text`` with its last half replaced by the beginning of the next."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half),
                    F.substring(following, F.lit(1), half))


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """Fingerprints of every row of ``docs`` (doc_id, text; other columns are
    not read) and of its edited text, and their likeness.

    Null and empty texts have the fingerprint of the empty text.  Repeated
    rows each give a row; a single document is its own next; an empty table
    gives no rows.  Signatures are worked out after the shuffle, the next
    document's once more: they are dearer to move than to make.
    """
    rows = with_next(docs)
    edited = rows.withColumn("edited", edited_text(F.col("text"), F.col("next_text")))
    edited = edited.select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"), signatures(F.col("text")).alias("sigs"),
        signatures(F.col("next_text")).alias("next_sigs"),
        signatures(F.col("edited")).alias("edited_sigs"))
    return edited.select(
        "doc_id", "n_chars", "edited_sha256", digest(F.col("sigs")).alias("fingerprint"),
        digest(F.col("edited_sigs")).alias("edited_fingerprint"),
        likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
        likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"))


def near_documents(docs: DataFrame, threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(members, links): doc_id with the ``class_id`` (smallest doc_id of the
    same fingerprint), and the pairs of classes ``a < b`` with their likeness
    of ``threshold`` or more.

    Equal fingerprints are one class and never form pairs.  Null and empty
    texts form one class; a null doc_id belongs to its class; repeated rows are
    members each.  An empty table has neither members nor links.
    """
    prints = store(docs.select("doc_id", signatures(F.col("text")).alias("sigs"))
                   .withColumn("fingerprint", digest(F.col("sigs"))), "spotsigs")
    classes = store(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("class_id"),
                                                      F.first("sigs").alias("sigs")), "spotsigs-classes")
    members = prints.select("doc_id", "fingerprint").join(
        classes.select("fingerprint", "class_id"), "fingerprint").select("doc_id", "class_id")
    # Partition by length: part p holds the lengths from base^p up, with
    # base = 1 / threshold, so a match lies in the same part or the next.
    sets = classes.select("fingerprint", "class_id", F.size("sigs").alias("n"), "sigs").withColumn(
        "part", F.floor(F.log(F.col("n").cast("double")) / F.lit(math.log(1 / threshold))).cast("int"))
    each = sets.select("fingerprint", "n", "part", F.explode("sigs").alias("sig"))
    rarity = each.groupBy("sig").agg(F.count("*").alias("df")).filter("df > 1")
    # A set's signatures, rarest first; those of one set only can't meet.
    ordered = (each.join(rarity, "sig")
               .groupBy("fingerprint", "n", "part")
               .agg(F.array_sort(F.collect_list(F.struct("df", "sig"))).alias("known")))
    lone = F.col("n") - F.size("known")
    reach = F.greatest(F.col("n") - F.ceil(F.col("n") * F.lit(threshold) - F.lit(1e-9)) + 1 - lone, F.lit(0))
    prefix = ordered.select("fingerprint", "n", "part", F.explode(
        F.slice("known", F.lit(1), reach.cast("int"))).alias("k")).select(
            "fingerprint", "n", "part", F.col("k.sig").alias("sig"))
    short = prefix.select(F.col("fingerprint").alias("f1"), F.col("n").alias("n1"), "sig",
                          F.explode(F.array("part", F.col("part") + 1)).alias("part"))
    far = prefix.select(F.col("fingerprint").alias("f2"), F.col("n").alias("n2"), "sig", "part")
    pairs = (short.join(far, ["part", "sig"])
             .filter((F.col("n1") < F.col("n2")) | ((F.col("n1") == F.col("n2")) & (F.col("f1") < F.col("f2"))))
             .filter(F.col("n1") >= F.col("n2") * F.lit(threshold) - F.lit(1e-9))
             .select("f1", "f2").distinct())
    a = classes.select(F.col("fingerprint").alias("f1"), F.col("class_id").alias("c1"), F.col("sigs").alias("s1"))
    b = classes.select(F.col("fingerprint").alias("f2"), F.col("class_id").alias("c2"), F.col("sigs").alias("s2"))
    links = (pairs.join(a, "f1").join(b, "f2")
             .withColumn("likeness", likeness(F.col("s1"), F.col("s2")))
             .filter(F.col("likeness") >= threshold)
             .select(F.least("c1", "c2").alias("a"), F.greatest("c1", "c2").alias("b"), "likeness"))
    return members, links
