"""Best-fit packing of token sequences by a configuration linear program.

The plan is made on the length histogram, whose size depends on the capacity
and not on the data.  For the program, lengths are rounded up to classes of
``UNIT`` tokens.  A
configuration says how many pieces of each class share one sequence.  The
covering program (fewest sequences that hold all pieces) is solved by
multiplicative weights: every class has a price that decays with its coverage,
an unbounded-knapsack dynamic program finds the dearest configuration at these
prices, and its amount grows by a fixed share of the class that binds, until
every class is covered.  The fractional amounts are rounded down and the pieces
left over are placed by best fit, in bulk over the same histogram.

Spark does the rest: pieces are tokenised once and stored, get a rank within
their length from two-level counts (length, bucket), and each rank falls into
one interval of the plan.
"""

from __future__ import annotations

import bisect
import json
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtally.llm.common import kept, store

END_ID = 1
UNIT = 4
STEP = 0.5              # share of the binding class's demand that a round covers
WORDS_KEPT = 1 << 19        # words whose ids one Python worker remembers
BUCKET_ROWS = 20_000


def _byte_letters() -> list[str]:
    """How byte-level tokenizers spell bytes: printable Latin-1 characters
    stand for themselves, the others take the letters from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


SPELLED = _byte_letters()


# Steps of a tokenizer that drops white space, lower-cases, and never joins across white space.
NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
         "behavior": "Removed", "invert": True}


def by_words(made: dict) -> bool:
    """Whether a tokenizer, as JSON, has exactly the steps for which a text's
    ids are those of its white-space free pieces in a row."""
    split = (made.get("pre_tokenizer") or {}).get("pretokenizers") or []
    return ((made.get("normalizer") or {}).get("normalizers") == NORMALIZER and len(split) == 2 and split[0] == SPLIT
            and split[1].get("type") == "ByteLevel" and not split[1].get("add_prefix_space")
            and not split[1].get("use_regex") and made.get("post_processor") is None
            and made["model"].get("type") == "BPE" and made["model"].get("end_of_word_suffix") == "</w>")


class WordIds(dict):
    """Token ids (little-endian 32-bit bytes) of white-space free pieces.

    A tokenizer that drops white space and never joins across it gives a
    text the ids of its pieces in a row.  Words seen before are looked up.
    A piece of letters alone is one word of the tokenizer's model and goes to
    it directly; anything else takes the whole tokenizer.  With any other
    tokenizer (``whole``) texts are encoded as they are.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.whole = not by_words(json.loads(self.tokenizer.to_str()))

    def __missing__(self, word: bytes) -> bytes:
        if len(word) > 1 and word[-1:] in (b".", b",") and _letters(word[:-1]):
            return self[word[:-1]] + self[word[-1:]]
        if _letters(word):
            small = word.decode().lower()
            spelled = small if word.isalpha() else "".join([SPELLED[b] for b in small.encode()])
            ids = [t.id for t in self.tokenizer.model.tokenize(spelled)]
        else:
            ids = self.tokenizer.encode(word.decode("utf-8", "replace"),
                                        add_special_tokens=False).ids
        if len(self) >= WORDS_KEPT:
            self.clear()
        out = self[word] = np.array(ids, dtype="<u4").tobytes()
        return out


def _letters(word: bytes) -> bool:
    """Whether ``word`` is letters of ASCII, Latin-1 and Latin Extended-A only,
    which are composed already and have one lower-case letter each (but for
    the dotted capital I)."""
    if word.isalpha():
        return True
    text = word.decode("utf-8", "replace")
    return text.isalpha() and max(text) < "\u0180" and "\u0130" not in text


def text_ids(text: str | None, path: str, end_id: int = END_ID) -> bytes:
    """The ids of ``text`` and then ``end_id``, as little-endian 32-bit bytes."""
    known = kept("packing")
    words = known.get(path)
    if words is None:
        words = known[path] = WordIds(path)
    if words.whole:
        found = words.tokenizer.encode(text or "", add_special_tokens=False).ids
        return np.array([*found, end_id], dtype="<u4").tobytes()
    found = (text or "").encode("utf-8", "replace").split()
    return b"".join(map(words.__getitem__, found)) + end_id.to_bytes(4, "little")


PIECE = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()),
    T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType())])


def token_pieces(docs: DataFrame, path: str, capacity: int, keep_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32 (and ids, the
    little-endian bytes, with ``keep_ids``)."""
    schema = T.StructType(list(PIECE.fields)
                          + [T.StructField("ids", T.BinaryType())] * keep_ids)

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids, size = text_ids(text, path), 4 * capacity
                for k, at in enumerate(range(0, len(ids), size)):
                    part = ids[at:at + size]
                    rows.append((None if pd.isna(doc_id) else int(doc_id), k, at // 4, len(part) // 4,
                                 zlib.crc32(part)) + ((part,) if keep_ids else ()))
            yield pd.DataFrame(rows, columns=schema.names).astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(pieces, schema)


def knapsack(prices: np.ndarray) -> dict[int, int]:
    """The multiset of class sizes (1 .. capacity units) of the largest total
    price that fits the capacity; ``prices[s]`` is that of size s."""
    room = len(prices) - 1
    best, taken = np.zeros(room + 1), np.zeros(room + 1, dtype=np.int64)
    sizes = np.flatnonzero(prices > 0)
    upto = np.searchsorted(sizes, np.arange(room + 1), side="right")
    worth = prices[sizes]
    for c in range(1, room + 1):
        best[c] = best[c - 1]
        k = upto[c]
        if k:
            value = best[c - sizes[:k]] + worth[:k]
            s = int(value.argmax())
            if value[s] > best[c]:
                best[c], taken[c] = value[s], sizes[s]
    out: dict[int, int] = {}
    c = room
    while c > 0:
        if taken[c]:
            out[int(taken[c])] = out.get(int(taken[c]), 0) + 1
            c -= int(taken[c])
        else:
            c -= 1
    return out


def fractional_plan(demand: np.ndarray, step: float = STEP) -> tuple[list[tuple[float, dict[int, int]]], float]:
    """Amounts of configurations that cover ``demand`` (by class size in
    units) by multiplicative weights with knapsack pricing, and a lower bound
    on any such amounts.

    Every round covers at least the share ``step`` of the demand of the class
    that binds, or what is left of it, so there are at most ``1 / step``
    rounds to a class and the program ends with every class covered.  Prices
    over the dearest configuration's price are a dual solution: the demand's
    worth at them bounds the number of sequences from below.
    """
    need = demand.astype(float)
    live = need > 0
    cover = np.zeros(len(need))
    sizes = np.arange(len(need), dtype=float)
    amounts: dict[tuple, float] = {}
    bound = float((need * sizes).sum()) / max(1, len(need) - 1)
    while live.any():
        # A price starts at the class's size and decays as it gets covered.
        prices = np.where(live, sizes * np.exp(-cover), 0.0)
        packed = knapsack(prices)
        dearest = sum(prices[s] * c for s, c in packed.items())
        bound = max(bound, float((need * prices).sum()) / dearest)
        config = {s: min(c, int(demand[s])) for s, c in packed.items()}
        left = min((1 - cover[s]) * need[s] / c for s, c in config.items())
        grow = min(max(step * min(need[s] / c for s, c in config.items()), 1.0), left)
        key = tuple(sorted(config.items()))
        amounts[key] = amounts.get(key, 0.0) + grow
        for s, c in config.items():
            cover[s] += grow * c / need[s]
            live[s] = cover[s] < 1 - 1e-9
    return [(x, dict(k)) for k, x in amounts.items()], bound


def best_fit(demand: np.ndarray, opened: list[tuple[int, dict[int, int]]] = (),
             ) -> list[tuple[int, dict[int, int]]]:
    """Best-fit decreasing over the counts by length; equal sequences move
    together.  ``opened`` are sequences that have pieces already."""
    room = len(demand) - 1
    open_at: dict[int, list[tuple[int, dict[int, int]]]] = {}
    rooms: list[int] = []           # sorted remaining rooms that have sequences

    def put(left: int, count: int, config: dict[int, int]) -> None:
        if left not in open_at:
            open_at[left] = []
            bisect.insort(rooms, left)
        open_at[left].append((count, config))

    for count, config in opened:
        put(room - sum(s * c for s, c in config.items()), count, config)
    for s in range(room, 0, -1):
        n = int(demand[s])
        while n:
            k = bisect.bisect_left(rooms, s)
            if k < len(rooms):
                left = rooms[k]
                count, config = open_at[left].pop()
                if not open_at[left]:
                    del open_at[left], rooms[k]
                take = min(n, count)
                if count > take:
                    put(left, count - take, config)
                put(left - s, take, {**config, s: config.get(s, 0) + 1})
                n -= take
            else:
                each = min(room // s, n)
                take = n // each
                put(room - each * s, take, {s: each})
                n -= take * each
    return [x for group in open_at.values() for x in group]


def _by_length(config: dict[int, int], times: int, left: np.ndarray, unit: int):
    """``times`` sequences of a configuration of classes, as configurations of
    lengths, longest first; takes the pieces from ``left``."""
    while times > 0:
        chosen: dict[int, int] = {}
        for s, c in config.items():
            for length in range(s * unit, (s - 1) * unit, -1):
                take = min(c, int(left[length]))
                if take:
                    chosen[length] = take
                    c -= take
        now = min([times] + [int(left[x]) // c for x, c in chosen.items()])
        for x, c in chosen.items():
            left[x] -= now * c
        times -= now
        yield now, chosen


def _classes(histogram: dict[int, int], capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Pieces by length, by class, and the tokens of a class."""
    unit = UNIT if capacity % UNIT == 0 else 1
    exact = np.zeros(capacity + 1, dtype=np.int64)
    demand = np.zeros(capacity // unit + 1, dtype=np.int64)
    for length, n in histogram.items():
        exact[length] += n
        demand[math.ceil(length / unit)] += n
    return exact, demand, unit


def _rounded(exact: np.ndarray, demand: np.ndarray, unit: int, amounts) -> list[tuple[int, dict[int, int]]]:
    """Whole configurations of the program, completed by best fit: the best of
    three degrees of fullness that a configuration must have."""
    room, plans = len(demand) - 1, []
    for unused in (0, room // 64, room):
        left, classes, opened = exact.copy(), demand.copy(), []
        for amount, config in sorted(amounts, key=lambda x: -x[0]):
            if sum(s * c for s, c in config.items()) < room - unused:
                continue
            times = min([math.floor(amount + 1e-9)]
                        + [int(classes[s]) // c for s, c in config.items()])
            for s, c in config.items():
                classes[s] -= times * c
            opened += _by_length(config, times, left, unit)
        plans.append(best_fit(left, opened))
    return min(plans, key=_sequences)


def _sequences(made: list[tuple[int, dict[int, int]]]) -> int:
    return sum(times for times, _ in made)


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(number of sequences, {length: pieces}) for a length histogram; every
    piece has a slot.

    The program's amounts are rounded down: configurations open that many
    sequences, and best fit places the rest, also into the room they leave.
    The plan of the fewest sequences is taken, plain best fit's among them.
    """
    exact, demand, unit = _classes(histogram, capacity)
    return min([_rounded(exact, demand, unit, fractional_plan(demand)[0]), best_fit(exact)], key=_sequences)


def plan_facts(histogram: dict[int, int], capacity: int) -> dict[str, float]:
    """What the program gives for a histogram: classes and those it leaves
    uncovered, its fractional amount and the lower bound (of the program over
    classes), sequences by the rounded program, by plain best fit, and the
    bound by tokens alone."""
    exact, demand, unit = _classes(histogram, capacity)
    amounts, bound = fractional_plan(demand)
    cover = np.zeros(len(demand))
    for amount, config in amounts:
        for s, c in config.items():
            cover[s] += amount * c
    return {"classes": int((demand > 0).sum()), "uncovered": int((cover < demand * (1 - 1e-6)).sum()),
            "amount": sum(x for x, _ in amounts), "bound": bound,
            "program": _sequences(_rounded(exact, demand, unit, amounts)), "best_fit": _sequences(best_fit(exact)),
            "tokens": math.ceil(sum(length * n for length, n in histogram.items()) / capacity)}


def _intervals(configs: list[tuple[int, dict[int, int]]]) -> dict[int, tuple]:
    """By length: starts of rank intervals, their first sequence, and pieces a
    sequence there."""
    made: dict[int, list[list[int]]] = {}
    ranks: dict[int, int] = {}
    first = 0
    for times, config in configs:
        for s, c in config.items():
            at = ranks.get(s, 0)
            rows = made.setdefault(s, [[], [], []])
            for x, v in zip(rows, (at, first, c)):
                x.append(v)
            ranks[s] = at + times * c
        first += times
    return {s: tuple(np.array(x, dtype=np.int64) for x in rows) for s, rows in made.items()}


def pack(docs: DataFrame, path: str, capacity: int = 4096, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every
    piece of ``docs`` (doc_id, text; other columns are not read), and its ids
    (little-endian bytes) with ``keep_ids``.

    Null and empty texts are one piece that holds the end id alone.  Texts
    longer than the capacity are cut, no other is.  Repeated rows are packed
    each; a null doc_id stays null.  An empty table packs to no rows.
    """
    pieces = store(token_pieces(docs, path, capacity, keep_ids), "pieces")
    counts = {r.length: r.n for r in
              pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # <= capacity rows
    intervals = _intervals(plan(counts, capacity))
    buckets = max(8, math.ceil(sum(counts.values()) / BUCKET_ROWS))
    rows = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"),
                                              F.lit(buckets)).cast("int"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    base = (rows.groupBy("length", "bucket").agg(F.count("*").alias("n"))
            .select("length", "bucket",
                    F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (rows.withColumn("rank", F.row_number().over(within) - 1)
              .join(base, ["length", "bucket"])
              .withColumn("rank", F.col("rank") + F.col("base")))
    names = pieces.columns
    schema = T.StructType(list(pieces.schema.fields) + [T.StructField("sequence_id", T.LongType())])

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sequence = np.zeros(len(batch), dtype=np.int64)
            sizes, ranks = batch["length"].to_numpy(), batch["rank"].to_numpy()
            for s in np.unique(sizes):
                mine = sizes == s
                starts, first, each = intervals[int(s)]
                k = np.searchsorted(starts, ranks[mine], side="right") - 1
                sequence[mine] = first[k] + (ranks[mine] - starts[k]) // each[k]
            out = batch[names].copy()
            out["doc_id"] = out["doc_id"].astype("Int64")
            out["sequence_id"] = sequence
            yield out

    placed = ranked.select(*names, "rank").mapInPandas(assign, schema)
    order = (Window.partitionBy("sequence_id")
             .orderBy(F.desc("length"), "doc_id", "piece", "ids_crc32")
             .rowsBetween(Window.unboundedPreceding, -1))
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(order), F.lit(0)))
