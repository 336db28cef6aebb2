"""Alignment of the tokens of two tokenizers.

A text's tokens of either kind are byte ranges of the same bytes.  The byte
offsets at which a token of both ends cut them into groups.  They are found by
intersecting the two lists of ends: every end of the shorter list is searched
in the longer one by steps that double until the end is bracketed, then by
halving the bracket.  All ends of a chunk of texts are searched in lockstep,
each from the place that its share of the list suggests.  The places of the
common ends slice both token lists into groups, and the differences of
successive places are the numbers of tokens on either side of a group.

Tokens that end together are linked.  How often two ids are linked is counted
over the whole corpus.  Of two tokens that end together the shorter one's
bytes end the longer one's, so the vocabularies bound the number of linked
pairs whatever the corpus (:meth:`Pair.bound`); the counts are sent to every
task after a check against that bound.
"""

from __future__ import annotations

import hashlib
import json
import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtally.llm.common import code_on_workers, store, whole_texts
from flowtally.llm.words import text_chunks

PARTS_KEPT = 1 << 17        # parts of texts whose ids a worker remembers
LEARNT = 1 << 13            # parts that are encoded at a time
LINKS = 1 << 18             # links that are counted at a time

_PAIRS: dict[tuple[str, str], "Pair"] = {}


def _byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for:
    printable Latin-1 characters for themselves, the letters from U+0100 on
    for the other bytes in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = (b for b in range(256) if b not in plain)
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(spare)}}


class Pair:
    """A byte-level tokenizer (A) and a sentence-piece model (B), and the
    bytes of all their tokens."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark's tasks share the cores
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = _byte_of_letter()
        special = {i for i, t in self.a.get_added_tokens_decoder().items() if t.special}
        self.bytes_a = [b""] * (max(self.a.get_vocab().values()) + 1)
        for token, i in self.a.get_vocab().items():
            if i not in special:
                self.bytes_a[i] = bytes(letters[c] for c in token)
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.sizes_a = np.array([len(t) for t in self.bytes_a], dtype=np.int64)
        self.sizes_b = np.array([len(t) for t in self.bytes_b], dtype=np.int64)
        self.splits, self.known, self.earlier = self._splits(), {}, {}
        self.spelt = [np.array([f"{i}{mark}" for i in range(max(len(self.bytes_a), len(self.bytes_b)))],
                               dtype=object) for mark in ",|;"]

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        if self.b.is_control(i) or self.b.is_unknown(i) or self.b.is_unused(i):
            return b""
        return piece.replace("▁", " ").encode()

    def bound(self) -> int:
        """The number of pairs of ids of which one's bytes end the other's."""
        own, other = set(self.bytes_a) - {b""}, set(self.bytes_b) - {b""}
        ids_a, ids_b = _times(self.bytes_a), _times(self.bytes_b)
        total = 0
        for longer, ids, shorter, shorter_ids, least in ((own, ids_a, other, ids_b, 0), (other, ids_b, own, ids_a, 1)):
            for token in longer:        # equal bytes count once
                total += ids[token] * sum(shorter_ids[token[i:]] for i in range(least, len(token))
                                          if token[i:] in shorter)
        return total

    def _splits(self) -> bool:
        """Whether both tokenizers part a text before a single space between
        two other characters, whatever stands around: A's pre-tokenizer does
        by its pattern; B does if none of its pieces has a space after another
        character and it leaves characters as they are."""
        made = json.loads(self.a.to_str())
        before = made["pre_tokenizer"] or {}
        odd = "ﬁ①Å 　x"
        return (made["normalizer"] is None and before.get("type") == "ByteLevel" and before.get("use_regex", True)
                and not any("▁" in self.b.id_to_piece(i).lstrip("▁") for i in range(self.b.get_piece_size()))
                and self.b.normalize(odd) == "▁" + odd.replace(" ", "▁"))

    def _learn(self, parts: list[bytes]) -> None:
        """Remember the ids of the parts, which start with a space; none of a
        part that its tokens do not spell."""
        spaced = [x.decode("utf-8", "replace") for x in parts]
        a = [e.ids for e in self.a.encode_batch_fast(spaced, add_special_tokens=False)]
        b = self.b.encode([x[1:] for x in spaced], num_threads=1)
        for part, ids_a, ids_b in zip(parts, a, b):
            spelt = (b"".join([self.bytes_a[i] for i in ids_a]) == part
                     and b"".join([self.bytes_b[i] for i in ids_b]) == part)
            self.known[part] = (array("i", ids_a).tobytes(), array("i", ids_b).tobytes()) if spelt else None

    def _looked_up(self, parts: list[bytes]) -> list:
        """What is known of the parts.  Parts not met while ``PARTS_KEPT``
        others were learnt are forgotten."""
        if len(self.known) > PARTS_KEPT:
            self.earlier, self.known = self.known, {}
        known, earlier = self.known, self.earlier
        new = [x for x in parts if x not in known]
        known.update((x, earlier[x]) for x in new if x in earlier)
        new = [x for x in new if x not in earlier]
        for i in range(0, len(new), LEARNT):
            self._learn(new[i:i + LEARNT])
        return [known[x] for x in parts]

    def forget(self) -> None:
        self.known, self.earlier = {}, {}

    def encode(self, texts: pa.Array) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of A and of B for each text; none of a text whose tokens do
        not spell it.  Parts between single spaces are encoded once."""
        parts, of_text = spaced_parts(texts, self.splits)
        coded = parts.dictionary_encode()
        code, distinct = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()
        found = self._looked_up(distinct)
        spelt = np.array([x is not None for x in found], dtype=bool)
        broken = np.concatenate([[0], np.cumsum(~spelt[code])])
        out = []
        for side in (0, 1):
            ids = [b"" if x is None else x[side] for x in found]
            sizes = np.array(list(map(len, ids)), dtype=np.int64) // 4
            starts = np.cumsum(sizes) - sizes
            each = sizes[code]
            upto = np.concatenate([[0], np.cumsum(each)])
            at = np.arange(upto[-1]) + np.repeat(starts[code] - upto[:-1], each)
            joined = np.frombuffer(b"".join(ids), dtype=np.int32)[at]
            out.append([joined[upto[lo]:upto[hi]] if broken[lo] == broken[hi] else joined[:0]
                        for lo, hi in zip(of_text, of_text[1:])])
        return out[0], out[1]


def spaced_parts(texts: pa.Array, split: bool = True) -> tuple[pa.Array, np.ndarray]:
    """The parts of every text with a space before it, and the first part of
    each text: the bytes of all parts in a row are those of the spaced texts.

    A text is parted before a single space between two characters that are
    surely not white space: printable ASCII, or two bytes from U+00C0 on.
    Null and empty texts have no part.
    """
    column = pc.fill_null(texts.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[offsets[0]:offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    edges = offsets - offsets[0]
    full = np.flatnonzero(np.diff(edges))
    data = np.insert(data, edges[:-1][full], 0x20)
    first = edges[:-1][full] + np.arange(len(full))         # the added spaces
    cut = np.zeros(len(data), dtype=bool)
    if split and len(data) > 2:
        ascii_, lead = (data > 0x20) & (data < 0x7F), (data >= 0xC3) & (data <= 0xDF)
        ends = ascii_.copy()
        ends[1:] |= lead[:-1] & (data[1:] >= 0x80)
        cut[1:-1] = (data[1:-1] == 0x20) & ends[:-2] & (ascii_ | lead)[2:]
    cut[first] = True
    starts = np.flatnonzero(cut).astype(np.int64)
    parts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [
        None, pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(np.ascontiguousarray(data))])
    per_text = np.zeros(len(column), dtype=np.int64)
    per_text[full] = np.diff(np.append(np.searchsorted(starts, first), len(starts)))
    return parts, np.concatenate([[0], np.cumsum(per_text)])


def _times(tokens: list[bytes]) -> dict[bytes, int]:
    out: dict[bytes, int] = {}
    for t in tokens:
        out[t] = out.get(t, 0) + 1
    return out


def pair(path_a: str, path_b: str) -> Pair:
    """The tokenizers of a worker, loaded once."""
    key = (path_a, path_b)
    if key not in _PAIRS:
        _PAIRS[key] = Pair(path_a, path_b)
    return _PAIRS[key]


def gallop(wanted: np.ndarray, within: np.ndarray, guess: np.ndarray) -> np.ndarray:
    """For each of ``wanted`` the first place in ascending ``within`` that is
    not less, by doubling steps from ``guess`` and then by halving."""
    n = len(within)
    low, high = guess - 1, guess.copy()         # within[low] < wanted <= within[high], once settled
    step = np.ones(len(wanted), dtype=np.int64)
    todo = np.flatnonzero(within[np.minimum(high, n - 1)] < wanted)
    while len(todo):                            # upwards
        low[todo] = high[todo]
        high[todo] = np.minimum(high[todo] + step[todo], n)
        step[todo] *= 2
        inside = todo[high[todo] < n]
        todo = inside[within[high[inside]] < wanted[inside]]
    step[:] = 1
    todo = np.flatnonzero(low >= 0)
    todo = todo[within[low[todo]] >= wanted[todo]]
    while len(todo):                            # downwards
        high[todo] = low[todo]
        low[todo] = np.maximum(low[todo] - step[todo], -1)
        step[todo] *= 2
        inside = todo[low[todo] >= 0]
        todo = inside[within[low[inside]] >= wanted[inside]]
    todo = np.flatnonzero(high - low > 1)
    while len(todo):
        middle = (low[todo] + high[todo]) // 2
        less = within[middle] < wanted[todo]
        low[todo[less]] = middle[less]
        high[todo[~less]] = middle[~less]
        todo = todo[high[todo] - low[todo] > 1]
    return high


def common_ends(short: list[np.ndarray], long: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Places, in the joined lists, of the ends that a text has in both; a
    text's shorter list comes first, its ends rise and its last ends agree."""
    sizes = [int(x[-1]) for x in short]
    shift = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    n_short, n_long = np.array([len(x) for x in short]), np.array([len(x) for x in long])
    wanted = np.concatenate(short) + np.repeat(shift, n_short)
    within = np.concatenate(long) + np.repeat(shift, n_long)
    first_short, first_long = np.cumsum(n_short) - n_short, np.cumsum(n_long) - n_long
    rank = np.arange(len(wanted)) - np.repeat(first_short, n_short)
    guess = np.repeat(first_long, n_short) + rank * np.repeat(n_long, n_short) // np.repeat(n_short, n_short)
    place = gallop(wanted, within, guess)
    same = within[place] == wanted              # a text's last end bounds all others: no place is beyond
    return np.flatnonzero(same), place[same]


def aligned(both: Pair, ids_a: list[np.ndarray], ids_b: list[np.ndarray]) -> list[tuple]:
    """(places of group ends in A, in B) for each text."""
    ends_a = [np.cumsum(both.sizes_a[x]) for x in ids_a]
    ends_b = [np.cumsum(both.sizes_b[x]) for x in ids_b]
    none = np.zeros(0, dtype=np.int64)
    out = [(none, none)] * len(ids_a)
    for swap in (False, True):
        mine = [i for i in range(len(ids_a)) if len(ids_a[i]) and (len(ids_a[i]) > len(ids_b[i])) == swap]
        if not mine:
            continue
        short, long = (ends_b, ends_a) if swap else (ends_a, ends_b)
        at_short, at_long = common_ends([short[i] for i in mine], [long[i] for i in mine])
        upto = np.cumsum([len(short[i]) for i in mine])
        cuts = np.concatenate([[0], np.searchsorted(at_short, upto)])
        base_long = np.cumsum([0] + [len(long[i]) for i in mine])
        for k, i in enumerate(mine):
            lo, hi = cuts[k], cuts[k + 1]
            found = at_short[lo:hi] - (upto[k] - len(short[i])), at_long[lo:hi] - base_long[k]
            out[i] = found[::-1] if swap else found
    return out


def groups_text(both: Pair, a: np.ndarray, b: np.ndarray, end_a: np.ndarray, end_b: np.ndarray) -> str:
    """``a1,a2|b1;a3|b2,b3``: the ids of every group."""
    if not len(a):
        return ""
    comma, bar, semicolon = both.spelt
    # Token t of A comes after the B tokens of all earlier groups, B's after the A tokens of its own too.
    size_a, size_b = np.diff(end_a, prepend=-1), np.diff(end_b, prepend=-1)
    out = np.empty(len(a) + len(b), dtype=object)
    at_a = np.arange(len(a)) + np.repeat(end_b - size_b + 1, size_a)
    at_b = np.arange(len(b)) + np.repeat(end_a + 1, size_b)
    out[at_a], out[at_b] = comma[a], comma[b]
    out[at_a[end_a]], out[at_b[end_b]] = bar[a[end_a]], semicolon[b[end_b]]
    return "".join(out.tolist())[:-1]


ALIGNED = ("doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, "
           "link_a array<int>, link_b array<int>")


def alignments(docs: DataFrame, path_a: str, path_b: str, keep_groups: bool = False) -> DataFrame:
    """A row for each of ``docs`` (doc_id, text): numbers of tokens and groups,
    the ids that are linked, in order, and the digest of the groups; with
    ``keep_groups`` the groups' text too."""
    schema = ALIGNED + (", groups string" if keep_groups else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(path_a, path_b)
        for batch in batches:
            for chunk in text_chunks(batch):
                ids_a, ids_b = both.encode(chunk.column("text"))
                ends = aligned(both, ids_a, ids_b)
                texts = [groups_text(both, a, b, *e) for a, b, e in zip(ids_a, ids_b, ends)]
                out = {
                    "doc_id": chunk.column("doc_id"),
                    "n_a": pa.array([len(x) for x in ids_a], pa.int64()),
                    "n_b": pa.array([len(x) for x in ids_b], pa.int64()),
                    "n_groups": pa.array([len(e[0]) for e in ends], pa.int64()),
                    "groups_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() if t else "" for t in texts]),
                    "link_a": _lists([a[e[0]] for a, e in zip(ids_a, ends)]),
                    "link_b": _lists([b[e[1]] for b, e in zip(ids_b, ends)])}
                if keep_groups:
                    out["groups"] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_pydict(out)
        both.forget()       # the worker lives on

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0] + [len(x) for x in parts]).astype(np.int32)
    values = np.concatenate(parts).astype(np.int32) if parts else np.zeros(0, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _flat(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray]:
    """A number for each linked pair of a batch, and the links of each row."""
    a, b = (batch.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("link_a", "link_b"))
    return a * width + b, np.diff(batch.column("link_a").offsets.to_numpy())


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``LINKS`` links."""
    for batch in batches:
        part = np.cumsum(np.diff(batch.column("link_a").offsets.to_numpy()), dtype=np.int64) // LINKS
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            if hi > lo:
                yield batch.slice(lo, hi - lo)


def link_counts(links: DataFrame, width: int) -> DataFrame:
    """link (``a * width + b``) and n: how often the two ids are linked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            found, n = np.unique(_flat(batch, width)[0], return_counts=True)
            yield pa.RecordBatch.from_pydict({"link": pa.array(found), "n": pa.array(n.astype(np.int64))})

    return (links.select("link_a", "link_b").mapInArrow(run, "link long, n long")
            .groupBy("link").agg(F.sum("n").alias("n")))


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256
    of every row of ``docs`` (doc_id, text; other columns are not read).

    Null and empty texts, and texts that either tokenizer's tokens do not
    spell byte by byte, have no tokens: zeros and an empty digest.  Repeated
    rows each give a row and each count; a null doc_id stays null.  An empty
    table gives no rows.
    """
    code_on_workers(docs.sparkSession)
    whole_texts(docs.sparkSession)      # rows of links are as long as their texts
    both = pair(path_a, path_b)
    width = len(both.bytes_b)
    rows = store(alignments(docs, path_a, path_b), "alignment")
    counted = link_counts(rows, width).toArrow()        # at most ``bound`` rows of 16 bytes
    if len(counted) > both.bound():
        raise RuntimeError("more linked pairs than the vocabularies allow")
    links, n = counted["link"].to_numpy(), counted["n"].to_numpy()
    order = np.argsort(links)
    links, n = links[order], n[order]
    highest = np.zeros(width, dtype=np.int64)
    np.maximum.at(highest, links % width, n)
    shared = docs.sparkSession.sparkContext.broadcast((links, n, n == highest[links % width]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links, n, best = shared.value
        for batch in _slices(batches):
            found, sizes = _flat(batch, width)
            at = np.searchsorted(links, found)
            row = np.repeat(np.arange(batch.num_rows), sizes)
            ends = np.cumsum(sizes)
            upto = np.concatenate([[0], np.cumsum(n[at], dtype=np.int64)])
            yield pa.RecordBatch.from_pydict({
                **{c: batch.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups")},
                "n_links": pa.array(sizes.astype(np.int64)),
                "n_best": pa.array(np.bincount(row[best[at]], minlength=batch.num_rows).astype(np.int64)),
                "count_sum": pa.array(upto[ends] - upto[ends - sizes]),
                "groups_sha256": batch.column("groups_sha256")})

    return rows.mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, "
                                "n_best long, count_sum long, groups_sha256 string")
