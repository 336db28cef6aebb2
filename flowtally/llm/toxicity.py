"""Toxicity by nearest labelled examples.

Terms are words and their prefixes of four and five letters.  Texts are TF-IDF
vectors over all their terms, with document counts of the whole corpus; terms
that tell toxic from other labelled texts (chi-squared) weigh ``TELLING`` times
as much.  A text's neighbours are the labelled examples of the largest exact
cosine, found in a block-max inverted index.  The lists of most terms are short
and read whole.  Examples are dealt into groups that share common terms (so
those of one language); terms that more than one example in ``COMMON`` of a
group holds are the group's dense matrix by example, a byte a cell.  Groups are
dealt into blocks of ``BLOCK``, every such term keeps its largest weight in each
block, and only blocks that hold an example whose bound reaches the
``NEIGHBOURS``-th cosine of a text's own group are multiplied out for that text:
first in single precision, weights being worked out of the counts some blocks at
a time; then in double precision the examples that may be among the nearest.
Neighbours vote with a weight that grows as their distance falls, and isotonic
regression over the examples' own leave-one-out votes turns the vote into a
probability.
Texts without a term of any example have no neighbours and take the rate of
such examples.

The examples are a sample of at most about ``FIT_ROWS`` labelled rows (chosen
by a hash of doc_id; of rows that share text and label one).  Vocabulary and
index hold all their terms and are bounded by it.  Terms that no example has
count in a text's length, with the root mean square IDF of such terms in the
corpus.  Everything else covers every row.

The index is kept as numbers of occurrences, from which weights follow, and is
sent to the tasks once, compressed.
"""

from __future__ import annotations

import math
import re
import sys
import uuid
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtally.llm.common import code_on_workers, give_back, kept, share_hash, store, whole_texts
from flowtally.llm.words import text_chunks

FIT_ROWS = 20_000
FIT_TASKS = 64
LEAST_DF = 5                # examples that hold a term that is tested
TERM_LEVEL = 0.01           # chance that any of all tested terms is chosen without cause
TELLING = 3.0
NEIGHBOURS = 15
BLOCK = 64
COMMON = 16                 # of so many examples one holds a term of the matrix
GROUPS = 8                  # of examples that are like one another, at most
LANE = 16                   # a matrix has a multiple of so many columns
TOGETHER = 64               # texts whose neighbours are sought at a time
ROUGH = 1e-4                # more than single precision can be off
LETTERS = 1 << 18           # of texts whose words are cut together
STRIDE = 8                  # blocks that are multiplied out at a time
COUNTED = 1 << 19           # counts of terms that a worker holds before it adds them up
REMEMBERED = 2_000          # answers for equal texts that a worker keeps
PREFIXES = (4, 5)
WORD = re.compile(r"[^\W\d_]+")

PACKED = ("keys", "idf", "ids", "texts", "labels", "column", "edges", "widths", "starts", "places", "held_counts", "matrix_counts", "norms")


_LETTER: list[np.ndarray] = []


def letters() -> np.ndarray:
    """By code point, whether it belongs to words: what WORD finds."""
    if not _LETTER:
        found = np.zeros(sys.maxunicode + 1, dtype=bool)
        every = np.arange(len(found), dtype="<u4").tobytes().decode("utf-32-le", "surrogatepass")
        for m in WORD.finditer(every):
            found[m.start():m.end()] = True
        _LETTER.append(found)
    return _LETTER[0]


def text_words(texts) -> tuple[list[str], np.ndarray]:
    """The lower-case words of ``texts`` in order, and how many each has."""
    lower = [(t or "").lower() for t in texts]
    joined = bytearray("\n".join(lower).encode("utf-32-le", "surrogatepass"))
    points = np.frombuffer(joined, dtype="<u4")
    inside = letters()[points]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    ends = np.cumsum(np.array(list(map(len, lower)), dtype=np.int64) + 1)
    per_text = np.diff(np.searchsorted(np.flatnonzero(first), ends), prepend=0)
    points[~inside] = ord(" ")
    return joined.decode("utf-32-le", "surrogatepass").split(), per_text


def term_keys(terms) -> np.ndarray:
    """64-bit numbers that stand for the terms (prefixes have a trailing ``*``)."""
    digest = xxhash.xxh64_intdigest         # of a text's UTF-8 bytes
    try:
        found = np.fromiter(map(digest, terms), dtype=np.uint64, count=len(terms))
    except UnicodeEncodeError:
        found = np.fromiter((digest(t.encode("utf-8", "surrogatepass")) for t in terms),
                            dtype=np.uint64, count=len(terms))
    return found.view(np.int64)


def text_digest(text: str) -> bytes:
    return xxhash.xxh3_128_digest(text.encode("utf-8", "surrogatepass"))


def term_table(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(keys, text, term, n): the distinct terms of ``texts`` by ascending key,
    and for every text and term in it how often it occurs, by text."""
    words, per_text = text_words(texts)
    of_text = np.repeat(np.arange(len(per_text)), per_text)
    code, distinct = pd.factorize(np.array(words, dtype=object))
    sizes = np.array(list(map(len, distinct)), dtype=np.int64)
    keys, texts_of, marks = [term_keys(distinct)], [of_text], [code]
    for n in PREFIXES:
        longer = np.flatnonzero(sizes > n)
        place = np.full(len(distinct), -1, dtype=np.int64)
        same, prefixes = pd.factorize(np.array([w[:n] for w in distinct[longer]], dtype=object))
        place[longer] = sum(map(len, keys)) + same
        keys.append(term_keys([x + "*" for x in prefixes]))
        mine = place[code]
        texts_of.append(of_text[mine >= 0])
        marks.append(mine[mine >= 0])
    found, number = np.unique(np.concatenate(keys), return_inverse=True)
    term = number[np.concatenate(marks)] if len(found) else np.zeros(0, dtype=np.int64)
    pair, n = np.unique(np.concatenate(texts_of) * max(1, len(found)) + term, return_counts=True)
    return found, pair // max(1, len(found)), pair % max(1, len(found)), n


def _chunks(texts) -> Iterator[tuple[int, int]]:
    """Bounds of neighbouring texts of about ``LETTERS`` letters together."""
    sizes = np.cumsum([len(t or "") for t in texts], dtype=np.int64) // LETTERS
    cuts = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), len(texts)]
    return ((lo, hi) for lo, hi in zip(cuts, cuts[1:]) if hi > lo)


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows and toxic rows that hold each term, for batches together."""
    kept("toxicity").clear()        # an index of an earlier fit, if the worker has one
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def counted() -> pa.RecordBatch:
        keys, every, toxic = parts[0]
        return pa.RecordBatch.from_pydict({"term": pa.array(keys), "n": pa.array(every), "n_toxic": pa.array(toxic)})

    for batch in batches:
        for chunk in text_chunks(batch):
            if sum(len(p[0]) for p in parts) > COUNTED:
                parts = [_added_up(parts)]
                if 2 * len(parts[0][0]) > COUNTED:
                    yield counted()
                    parts = []
            keys, text, term, _ = term_table(chunk.column("text").to_pylist())
            toxic = (chunk.column("label").to_numpy(zero_copy_only=False)[text] > 0
                     if "label" in batch.schema.names else np.zeros(len(text), dtype=bool))
            parts.append((keys, np.bincount(term, minlength=len(keys)),
                          np.bincount(term[toxic], minlength=len(keys))))
    if parts:
        parts = [_added_up(parts)]
        yield counted()
    parts = []
    give_back()


def _added_up(parts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, counts, counts) of several such added up by key."""
    keys, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return (keys, *(np.bincount(at, weights=np.concatenate([p[i] for p in parts]),
                                minlength=len(keys)).astype(np.int64) for i in (1, 2)))


DAMPED = np.concatenate([[0.0], 1 + np.log(np.arange(1, 1 << 16))])
DAMPED_SINGLE = DAMPED[:1 << 8].astype(np.float32)


def _damped(counts: np.ndarray) -> np.ndarray:
    """What a term weighs by how often it occurs, before its IDF."""
    if counts.dtype.itemsize < 4:       # no count is beyond the table: nothing to check or clip
        return np.take(DAMPED, counts, mode="clip")
    return np.where(counts > 0, 1 + np.log(np.maximum(counts, 1).astype(float)), 0.0)


def _byte_lists(starts: np.ndarray, values: np.ndarray) -> pa.Array:
    """Lists as byte strings that share their memory: taken by copying runs."""
    ends = starts * values.itemsize
    if len(values) * values.itemsize < 1 << 31:
        kind, ends = pa.binary(), ends.astype(np.int32)
    else:
        kind, ends = pa.large_binary(), ends.astype(np.int64)
    return pa.Array.from_buffers(kind, len(starts) - 1, [None, pa.py_buffer(ends), pa.py_buffer(values)])


def _taken(lists: pa.Array, listed: np.ndarray, kind, n: int) -> np.ndarray:
    """The ``n`` entries of some lists, one list behind the other."""
    data = lists.take(pa.array(listed)).buffers()[2]
    return np.frombuffer(data if data is not None else b"", dtype=kind, count=n)


class Examples:
    """The vocabulary and the block-max index of the labelled examples."""

    def __init__(self, idf: dict[str, float]):
        self.name_terms(term_keys(idf), np.array(list(idf.values()), dtype=float))
        self.name = uuid.uuid4().hex
        self.ids = np.zeros(0, dtype=np.int64)
        self.texts = np.zeros(0, dtype=np.int64)
        self.labels = np.zeros(0)
        self.bare_rate = 0.0
        self.base_rate = 0.0
        self.votes, self.rates = np.array([0.0]), np.array([0.0])
        self.answers: dict = {}
        self._ready = False
        self._broadcast = None

    def name_terms(self, keys: np.ndarray, idf: np.ndarray, other: float = 1.0) -> None:
        """Set the terms, their weights and that of a term of no example."""
        order = np.argsort(keys)
        self.keys, self.idf, self.other = keys[order], idf[order], other

    def vectors(self, texts) -> list[tuple[np.ndarray, np.ndarray]]:
        """Term numbers and TF-IDF weights of the examples' terms in each
        text, as parts of a vector of unit length over all terms of the text."""
        out = []
        for lo, hi in _chunks(texts):
            out += self._vectors(texts[lo:hi])
        return out

    def _vectors(self, texts) -> list[tuple[np.ndarray, np.ndarray]]:
        keys, text, term, n = term_table(texts)
        at = np.searchsorted(self.keys, keys)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == keys[known]
        idf = np.full(len(keys), float(self.other))
        idf[known] = self.idf[at[known]]
        weights = (1 + np.log(n)) * idf[term]
        cuts = np.searchsorted(text, np.arange(len(texts) + 1))
        out = []
        for lo, hi in zip(cuts, cuts[1:]):
            mine, w = term[lo:hi], weights[lo:hi]
            length = math.sqrt(float((w * w).sum())) or 1.0
            held = known[mine]
            out.append((at[mine[held]], w[held] / length))
        return out

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        return self.vectors([text])[0]

    def _split_terms(self, group: int, sizes: np.ndarray, live: int) -> np.ndarray:
        """Choose the terms of a group's matrix by how many of its ``live``
        examples hold each: whether a term is one of them."""
        common = sizes * COMMON > live
        if common.sum() >= 1 << 15 and self.column.itemsize < 4:
            self.column = self.column.astype(np.int32)
        self.column[common, group] = np.arange(common.sum())
        return common

    def _rates(self, bare_labels, labels) -> None:
        self.base_rate = float(np.mean(labels)) if len(labels) else 0.0
        # One example's worth of the base rate steadies small groups.
        self.bare_rate = (float(sum(bare_labels)) + self.base_rate) / (len(bare_labels) + 1)

    def build(self, ids, labels, vectors) -> None:
        """Index the examples that have a vector, those of one leading common
        term side by side so that blocks differ."""
        live = [i for i, v in enumerate(vectors) if len(v[0])]
        row = np.repeat(np.arange(len(live)), [len(vectors[i][0]) for i in live]).astype(np.int64)
        none = np.zeros(0, dtype=np.int64)
        at = np.concatenate([none, *(vectors[i][0] for i in live)]).astype(np.int64)
        weights = np.concatenate([none, *(vectors[i][1] for i in live)]).astype(float)
        self.column = np.full((len(self.idf), 1), -1, dtype=np.int32)
        self._split_terms(0, np.bincount(at, minlength=len(self.idf)), len(live))
        self._rates([labels[i] for i, v in enumerate(vectors) if not len(v[0])], labels)
        self._arrange(np.array([ids[i] for i in live], dtype=np.int64),
                      np.array([labels[i] for i in live], dtype=float), row, at, weights)
        self.exact = True       # the stored values are weights, not counts
        self._finish()

    def build_counts(self, ids, texts, labels, rows) -> None:
        """Index examples of which ``rows[i]`` gives the terms, ascending, and
        how often each occurs.  A few hundred rows are unpacked at a time."""
        parts = [slice(i, i + 512) for i in range(0, len(rows), 512)]
        sizes = np.zeros(len(self.idf), dtype=np.int64)
        for part in parts:
            sizes += np.bincount(np.concatenate([at for at, _ in rows[part]]), minlength=len(sizes))
        common = sizes * COMMON > len(rows)
        group = self._grouped(rows, np.where(common, np.cumsum(common) - 1, -1))
        counts = np.bincount(group)
        self.column = np.full((len(sizes), len(counts)), -1, dtype=np.int16)
        self.edges = np.concatenate([[0], np.cumsum(counts)])
        norms, leading = np.zeros(len(rows)), np.full(len(rows), -1, dtype=np.int64)
        for g in range(len(counts)):
            mine = np.flatnonzero(group == g)
            held, small = np.zeros((2, len(sizes)), dtype=np.int64)
            for i in range(0, len(mine), 512):
                at = np.concatenate([rows[j][0] for j in mine[i:i + 512]])
                few = np.concatenate([rows[j][1] for j in mine[i:i + 512]]) <= 255
                held += np.bincount(at, minlength=len(sizes))
                small += np.bincount(at[few], minlength=len(sizes))
            dense = self._split_terms(g, held, len(mine))
            sizes[dense] -= small[dense]
            for i in range(0, len(mine), 512):
                part = mine[i:i + 512]
                lengths = [len(rows[j][0]) for j in part]
                row = np.repeat(np.arange(len(part)), lengths)
                at = np.concatenate([rows[j][0] for j in part])
                weights = (1 + np.log(np.concatenate([rows[j][1] for j in part]).astype(float))) * self.idf[at]
                norms[part] = np.sqrt(np.bincount(row, weights=weights * weights))
                leading[part] = self._leading(self.column[:, g], len(part), row, at, weights)
        order = np.lexsort((ids, leading, group))
        self.ids, self.texts, self.labels, self.norms = ids[order], texts[order], labels[order], norms[order]
        top = max((n.max() for _, n in rows), default=0)
        kind = np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32
        self._lay_out(np.uint8)
        matrices = [self._matrix(g) for g in range(len(counts))]
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        held = int(self.starts[-1])
        self.places, self.held_counts = np.empty(held, self._place_kind(len(rows))), np.empty(held, kind)
        upto = self.starts[:-1].copy()      # where each term's next entry goes
        for place, i in enumerate(order):
            at, n = rows[i]
            column = self.column[at, group[i]]
            rare = (column < 0) | (n > 255)     # the matrix holds bytes
            matrices[group[i]][place - self.edges[group[i]], column[~rare]] = n[~rare]
            to = upto[at[rare]]             # a row has a term once
            self.places[to], self.held_counts[to] = place, n[rare]
            upto[at[rare]] += 1

    def _lay_out(self, kind) -> None:
        """Room for the groups' matrices, one behind the other."""
        self.widths = -(-(self.column.max(axis=0, initial=-1).astype(np.int64) + 1) // LANE) * LANE
        self.matrix_counts = np.zeros((int((np.diff(self.edges) * self.widths).sum()) // LANE, LANE), kind)

    def _matrix(self, group: int) -> np.ndarray:
        """The examples of a group by its common terms."""
        sizes = np.diff(self.edges)
        ends = np.concatenate([[0], np.cumsum(sizes * self.widths)]) // LANE
        return self.matrix_counts[ends[group]:ends[group + 1]].reshape(sizes[group], self.widths[group])

    def _grouped(self, rows, column: np.ndarray) -> np.ndarray:
        """A group number for every example, by likeness in the terms with a
        ``column``: spherical k-means of some rows deals all of them.  Which
        group an example is in changes the work of a search, not what it finds."""
        width = int(column.max(initial=-1)) + 1
        if not width:
            return np.zeros(len(rows), dtype=np.int64)
        idf = self.idf.astype(np.float32)

        def dense(places) -> np.ndarray:
            out = np.zeros((len(places), width), dtype=np.float32)
            for i, j in enumerate(places):
                at, n = rows[j]
                mine = column[at] >= 0
                out[i, column[at[mine]]] = (1 + np.log(n[mine].astype(np.float32))) * idf[at[mine]]
            return out / np.maximum(np.sqrt((out * out).sum(axis=1, keepdims=True)), 1e-9)

        some = min(len(rows), max(64, min(2048, (1 << 22) // width)))
        chosen = dense(np.linspace(0, len(rows) - 1, some).astype(np.int64))
        chosen = chosen[chosen.any(axis=1)]
        if not len(chosen):
            return np.zeros(len(rows), dtype=np.int64)
        rng, best = np.random.default_rng(0), None
        for _ in range(4):      # the best of some starts
            centres = chosen[[rng.integers(len(chosen))]]
            while len(centres) < min(GROUPS, len(chosen)):      # unlike those before, by chance
                far = np.maximum(0, 1 - (chosen @ centres.T).max(axis=1)).astype(float) ** 2 + 1e-12
                centres = np.concatenate([centres, chosen[[rng.choice(len(far), p=far / far.sum())]]])
            for _ in range(10):
                own = (chosen @ centres.T).argmax(axis=1)
                sums = np.stack([chosen[own == g].sum(axis=0) for g in range(len(centres))])
                centres = sums / np.maximum(np.sqrt((sums * sums).sum(axis=1, keepdims=True)), 1e-9)
            like = float((chosen @ centres.T).max(axis=1).sum())
            if best is None or like > best[0]:
                best = like, centres
        centres = best[1]
        group = np.concatenate([(dense(range(i, min(i + 512, len(rows)))) @ centres.T).argmax(axis=1)
                                for i in range(0, len(rows), 512)])
        return np.unique(group, return_inverse=True)[1]     # none is empty

    @staticmethod
    def _place_kind(n: int):
        return np.uint16 if n < 1 << 16 else np.int32

    @staticmethod
    def _leading(column, n: int, row, at, weights) -> np.ndarray:
        """The common term of the largest weight in each of ``n`` rows, or -1."""
        dense = column[at] >= 0
        out = np.full(n, -1, dtype=np.int64)
        # A row's first of the largest weights comes last here.
        best = np.lexsort((-at[dense].astype(np.int64), weights[dense], row[dense]))
        out[row[dense][best]] = at[dense][best]
        return out

    def _arrange(self, ids, labels, row, at, weights) -> None:
        """Deal examples into places, and weights into lists and the matrix."""
        column = self.column[at, 0]
        dense = column >= 0
        order = np.lexsort((ids, self._leading(self.column[:, 0], len(ids), row, at, weights)))
        place = np.empty(len(ids), dtype=np.int64)
        place[order] = np.arange(len(ids))
        self.ids, self.texts, self.labels = ids[order], np.zeros(len(ids), dtype=np.int64), labels[order]
        self.edges = np.array([0, len(ids)])
        self._lay_out(float)
        self._matrix(0)[place[row[dense]], column[dense]] = weights[dense]
        listed, where = at[~dense], place[row[~dense]]
        by_term = np.argsort(listed * max(1, len(ids)) + where)
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(listed, minlength=len(self.idf)))])
        self.places = where[by_term].astype(self._place_kind(len(ids)))
        self.held_counts = weights[~dense][by_term]

    def ready(self) -> "Examples":
        """Work the weights out of the counts, once."""
        if not self._ready:
            if not hasattr(self, "places"):     # sent away: see ``shared``
                self._unpack(self._broadcast.value[1])
            if not hasattr(self, "norms"):
                self.norms = np.ones(len(self.ids))
            self.exact = False
            self._finish()
        return self

    def _finish(self) -> None:
        self.matrices = [self._matrix(g) for g in range(len(self.widths))]
        self.lists = _byte_lists(self.starts, self.places)
        if self.exact:
            self.list_weights = _byte_lists(self.starts, self.held_counts)
        self.common_idf, self.bounds, self.centres = [], [], []
        for g, matrix in enumerate(self.matrices):
            terms = np.flatnonzero(self.column[:, g] >= 0)
            idf = np.zeros(matrix.shape[1])
            idf[self.column[terms, g]] = self.idf[terms]
            self.common_idf.append(idf)
            every, total = np.arange(matrix.shape[1]), np.zeros(matrix.shape[1])
            most = np.zeros((matrix.shape[1], -(-len(matrix) // BLOCK)), dtype=np.float32)
            for b in range(most.shape[1]):
                rows = self._rows(g, np.arange(b * BLOCK, min((b + 1) * BLOCK, len(matrix))), every)
                most[:, b] = rows.max(axis=0, initial=0)
                total += rows.sum(axis=0)
            self.bounds.append(most)
            self.centres.append((total / max(1, len(matrix))).astype(np.float32))
        self.centres = np.concatenate(self.centres)
        self.first_column = np.cumsum([0, *(m.shape[1] for m in self.matrices)])
        if not self.exact:
            # Most terms occur once in an example: what more often ones weigh on top.
            often = np.flatnonzero(self.held_counts > 1)
            self.often_starts = np.searchsorted(often, self.starts)
            self.often_lists = _byte_lists(self.often_starts, self.places[often])
            self.often_counts = _byte_lists(self.often_starts, self.held_counts[often])
            self.held_kind = self.held_counts.dtype
            self.often_starts = self.often_starts.astype(np.int32)
            flat, some = self.matrix_counts.reshape(-1), 1 << 20        # cells looked at at a time
            kind = np.uint32 if flat.size < 1 << 32 else np.int64
            cells = [(np.flatnonzero(flat[i:i + some] > 1) + i).astype(kind) for i in range(0, flat.size, some)]
            self.often_cells = np.concatenate([np.zeros(0, dtype=kind), *cells])
        self._ready = True

    def _rows(self, group: int, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """Weights of a group's examples in columns of its matrix, in double
        precision."""
        stored = self.matrices[group][rows[:, None], columns]
        if self.exact:
            return stored
        return _damped(stored) * self.common_idf[group][columns] / self.norms[self.edges[group] + rows][:, None]

    def _rough(self, group: int, lo: int, hi: int) -> np.ndarray:
        """Rows of a group's matrix in single precision, without IDF and length."""
        rows = self.matrices[group][lo:hi].astype(np.float32)
        if not self.exact:
            width = rows.shape[1]
            before = int((np.diff(self.edges)[:group] * self.widths[:group]).sum())
            ends = np.array([before + lo * width, before + hi * width], dtype=self.often_cells.dtype)     # else the cells are cast
            mine = slice(*np.searchsorted(self.often_cells, ends))
            cells = self.often_cells[mine] - (before + lo * width)
            rows.reshape(-1)[cells] = DAMPED_SINGLE[self.matrices[group][lo:hi].reshape(-1)[cells]]
        return rows

    def _some(self, group: int, lo: int, hi: int, columns: np.ndarray) -> np.ndarray:
        """Columns of ``_rough``."""
        stored = np.take(self.matrices[group][lo:hi], columns, axis=1)
        return stored.astype(np.float32) if self.exact else np.take(DAMPED_SINGLE, stored)

    def _columns(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(group, column, term) of the matrices that have terms of a vector:
        ``term`` counts in ``at``."""
        column = self.column[at].T
        group, term = np.nonzero(column >= 0)
        return group, column[group, term].astype(np.int64), term

    def _home(self, columns, weights: np.ndarray) -> int:
        """The group whose mean is the most like a vector."""
        group, column, term = columns
        like = np.bincount(group, minlength=len(self.matrices),
                           weights=self.centres[self.first_column[group] + column] * weights[term])
        return int(like.argmax()) if len(like) else 0

    def nearest_of(self, vectors, k: int = NEIGHBOURS, without=None) -> list[list[tuple[float, int]]]:
        """For each vector (cosine, place) of the k nearest examples with a
        positive cosine, ties to the smaller id; ``without`` are the places
        of examples that are left out, one a vector.  Texts of one group are
        sought together."""
        self.ready()
        out: list = [[] for _ in vectors]
        if not len(self.ids):
            return out
        columns = [self._columns(at) for at, _ in vectors]
        home = np.array([self._home(c, w) for c, (_, w) in zip(columns, vectors)], dtype=np.int64)
        for g in np.unique(home):
            mine = np.flatnonzero(home == g)
            for i in range(0, len(mine), TOGETHER):
                part = mine[i:i + TOGETHER]
                found = self._nearest_in(g, [vectors[j] for j in part], [columns[j] for j in part], k,
                                         None if without is None else np.asarray(without)[part])
                for j, near in zip(part, found):
                    out[j] = near
        return out

    def _nearest_in(self, home: int, vectors, columns, k: int, without) -> list[list[tuple[float, int]]]:
        """``nearest_of`` for vectors that are like those of one group."""
        n = len(self.ids)
        part = np.empty((len(vectors), n))          # of the lists
        rough = np.full(part.shape, -np.inf, dtype=np.float32)
        query = np.zeros((len(vectors), self.first_column[-1]), dtype=np.float32)
        queries = [query[:, a:b] for a, b in zip(self.first_column, self.first_column[1:])]
        held = []       # by vector, the columns of each group and their weights
        for i, ((at, weights), (group, column, term)) in enumerate(zip(vectors, columns)):
            # A term's list has the examples of the groups where it is no column,
            # and those that hold it too often for a byte.
            part[i] = self._lists_sum(at, weights)
            query[i, self.first_column[group] + column] = weights[term]
            ends = np.searchsorted(group, np.arange(len(queries) + 1))
            held.append([(column[a:b], weights[term[a:b]]) for a, b in zip(ends, ends[1:])])
        if not self.exact:
            part /= self.norms
        if without is not None:
            part[np.arange(len(vectors)), without] = -np.inf
        least = np.zeros(len(vectors))      # no k-th cosine is lower
        order = [home, *(g for g in range(len(queries)) if g != home)]
        for g in order:
            lo, hi = self.edges[g], self.edges[g + 1]
            blocks = self.bounds[g].shape[1]
            starts = np.arange(0, blocks, STRIDE)
            if g == home:
                needed = np.ones((len(vectors), len(starts)), dtype=bool)
            else:       # what no example of a block exceeds, from the best of its lists
                best = np.maximum.reduceat(part[:, lo:hi], np.arange(blocks) * BLOCK, axis=1)
                upper = best + queries[g] @ self.bounds[g]
                needed = np.logical_or.reduceat(
                    (best > -np.inf) & (upper > -ROUGH) & (upper >= least[:, None] - ROUGH), starts, axis=1)
            single = queries[g] if self.exact else queries[g] * self.common_idf[g].astype(np.float32)
            # Neighbouring blocks are one product, for the texts that need one of them.
            for run, who in zip(starts, needed.T):
                who = np.flatnonzero(who)
                if len(who):
                    a, b = run * BLOCK, min((run + STRIDE) * BLOCK, hi - lo)
                    if 4 * sum(len(held[i][g][0]) for i in who) < single.shape[1]:     # too few for whole rows
                        found = np.stack([self._some(g, a, b, held[i][g][0]) @ single[i, held[i][g][0]] for i in who])
                    else:
                        found = single[who] @ self._rough(g, a, b).T
                    if not self.exact:
                        found /= self.norms[lo + a:lo + b].astype(np.float32)
                    rough[who, lo + a:lo + b] = found + part[who, lo + a:lo + b]
            if g == home and hi - lo >= k:
                least = np.maximum(0.0, np.partition(rough[:, lo:hi], hi - lo - k, axis=1)[:, hi - lo - k] - ROUGH)
        out = []
        for i in range(len(vectors)):
            places = np.flatnonzero((rough[i] > -ROUGH) & (rough[i] >= least[i] - ROUGH))
            if len(places) > k:
                values = rough[i, places]
                places = places[values >= np.partition(values, -k)[-k] - 2 * ROUGH]
            cosines = part[i, places]
            of = np.searchsorted(self.edges, places, side="right") - 1
            for g in np.unique(of):
                columns, weights = held[i][g]
                cosines[of == g] += self._rows(g, places[of == g] - self.edges[g], columns) @ weights
            near = sorted((-round(float(c), 12), int(self.ids[p]), int(p))
                          for p, c in zip(places, cosines) if c > 0)[:k]
            out.append([(-c, place) for c, _, place in near])
        return out

    def _lists_sum(self, listed: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """What the lists of terms add to every example, but for its length."""
        sizes = self.starts[listed + 1] - self.starts[listed]
        n = int(sizes.sum())
        if not n:
            return np.zeros(len(self.ids))
        places = _taken(self.lists, listed, self.places.dtype, n)
        if self.exact:
            added = np.repeat(weights, sizes) * _taken(self.list_weights, listed, float, n)
            return np.bincount(places, minlength=len(self.ids), weights=added)
        weights = weights * self.idf[listed]
        often = self.often_starts[listed + 1] - self.often_starts[listed]
        more = int(often.sum())
        where, added = np.empty(n + more, dtype=np.intp), np.empty(n + more)
        where[:n], added[:n] = places, np.repeat(weights, sizes)
        if more:
            where[n:] = _taken(self.often_lists, listed, self.places.dtype, more)
            np.multiply(np.repeat(weights, often), _damped(_taken(self.often_counts, listed, self.held_kind, more)) - 1,
                        out=added[n:])
        return np.bincount(where, minlength=len(self.ids), weights=added)

    def nearest(self, at: np.ndarray, weights: np.ndarray, k: int = NEIGHBOURS,
                without: int | None = None) -> list[tuple[float, int]]:
        """The nearest examples of one vector."""
        if not len(at) or not len(self.ids):
            return []
        return self.nearest_of([(at, weights)], k, None if without is None else [without])[0]

    def vote(self, near: list[tuple[float, int]]) -> float:
        """The distance-weighted share of toxic neighbours, against as many
        neighbours at cosine 0 that vote the base rate: agreement of close
        examples counts for more than that of distant ones."""
        weights = np.array([1 / (1.05 - c) for c, _ in near])
        labels = np.array([self.labels[p] for _, p in near])
        ground = NEIGHBOURS / 1.05
        return float(((weights * labels).sum() + ground * self.base_rate) / (weights.sum() + ground))

    def calibrate(self, votes: np.ndarray, labels: np.ndarray) -> None:
        """Centred isotonic regression of labels on votes: adjacent violators
        are pooled, and the rate is linear between the pools' mean votes."""
        order = np.argsort(votes, kind="stable")
        pools: list[list[float]] = []       # sum of votes, sum of labels, size
        for v, y in zip(votes[order], labels[order]):
            pools.append([v, y, 1])
            while len(pools) > 1 and (pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]
                                      or pools[-2][0] / pools[-2][2] >= pools[-1][0] / pools[-1][2]):
                v1, y1, n1 = pools.pop()
                pools[-1][0] += v1
                pools[-1][1] += y1
                pools[-1][2] += n1
        self.votes = np.array([p[0] / p[2] for p in pools])
        self.rates = np.array([p[1] / p[2] for p in pools])

    def scores(self, texts) -> list[tuple[float, list[int], list[float]]]:
        """For each text the probability of being toxic, and the evidence:
        neighbours' ids and cosines."""
        digests = [text_digest(t or "") for t in texts]
        new = {d: t for d, t in zip(digests, texts) if d not in self.answers}
        if len(self.answers) + len(new) > REMEMBERED:
            self.answers.clear()
            new = dict(zip(digests, texts))
        for d, near in zip(new, self.nearest_of(self.vectors(list(new.values())))):
            self.answers[d] = self._answer(near)
        return [self.answers[d] for d in digests]

    def _answer(self, near: list[tuple[float, int]]) -> tuple[float, list[int], list[float]]:
        if not near:
            return self.bare_rate, [], []
        vote = self.vote(near)
        # The vote itself orders texts beyond the outermost pools.
        rate = float(np.interp(vote, self.votes, self.rates))
        score = min(1.0, max(0.0, 0.999 * rate + 0.001 * vote))
        return score, [int(self.ids[p]) for _, p in near], [c for c, _ in near]

    def shared(self, spark):
        """The index as the tasks get it, sent once: compressed counts.  The
        driver keeps the vocabulary; the rest comes back when it is asked for."""
        if self._broadcast is None:
            squeeze = zstandard.ZstdCompressor(3).compress
            packed = {a: (x.dtype.str, x.shape, squeeze(np.ascontiguousarray(x).data.cast("B")) if x.size else b"")
                      for a in PACKED if (x := getattr(self, a, None)) is not None}
            self._broadcast = spark.sparkContext.broadcast((self.name, {**packed, "other": self.other,
                                                                        "base_rate": self.base_rate}))
            if not self._ready:
                for a in ("places", "held_counts", "matrix_counts"):
                    delattr(self, a)
        return self._broadcast

    def _unpack(self, packed: dict) -> None:
        restore = zstandard.ZstdDecompressor().decompress
        for a, x in packed.items():
            if isinstance(x, tuple):
                kind, shape, data = x
                x = np.frombuffer(restore(data) if data else b"", dtype=kind).reshape(shape)
            setattr(self, a, x)

    def outcome(self) -> tuple[np.ndarray, np.ndarray, float]:
        """What turns votes into scores."""
        return self.votes, self.rates, self.bare_rate


def loaded(shared, outcome=None) -> Examples:
    """The index in a worker, unpacked once."""
    name, packed = shared.value
    known = kept("toxicity")
    if name not in known:
        known.clear()
        model = Examples({})
        model._unpack(packed)
        known[name] = model.ready()
        del model.held_counts       # ``often_counts`` says it all
        give_back()
    model = known[name]
    if outcome is not None:
        model.votes, model.rates, model.bare_rate = outcome
    return model


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, label of the rows that may be learnt from: labelled, and
    crc32(doc_id as text) mod 5 is not 0.  A doc_id that repeats in ``labels``
    is toxic where one of its rows is."""
    return docs.select("doc_id", "text").join(_labels(labels), "doc_id")


def _labels(labels: DataFrame) -> DataFrame:
    return (labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
            .filter(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
            .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label")))


def sample(docs: DataFrame, labels: DataFrame, fit_rows: int) -> DataFrame:
    """About ``fit_rows`` of the rows that may be learnt from (doc_id, h, text,
    label), written once; of rows that share text and label the one of the
    smallest doc_id.  Texts move only when they are chosen."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    own = own.withColumns({"h": F.xxhash64("text"), "size": F.coalesce(F.length("text"), F.lit(0))})
    known = store(own.select("doc_id", "h", "size").join(_labels(labels), "doc_id"), "toxicity-labels")
    rate = min(1.0, fit_rows / max(1, known.count()))
    # Copies of a text would make all its words look telling: one of each stays.
    picked = store(known.filter(share_hash("doc_id") < int(rate * 1_000_000))
                   .groupBy("h", "size", "label").agg(F.min("doc_id").alias("doc_id")), "toxicity-picked")
    few = picked.count() <= 2 * fit_rows        # as expected: ids and hashes of that many rows
    rows = own.join(F.broadcast(picked) if few else picked, ["doc_id", "h", "size"])
    names = ["doc_id", "h", "size", "label"]
    return store(rows.repartition(FIT_TASKS, *names).groupBy(*names).agg(F.first("text").alias("text")), "toxicity-fit")


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, telling: float = TELLING) -> Examples:
    """Learn vocabulary, index and calibration from about ``fit_rows`` rows.

    Null doc_ids and null labels are not learnt from; null texts are, as texts
    without terms.  Without labelled rows the model gives every text 0.
    """
    spark = docs.sparkSession
    whole_texts(spark)
    rows = sample(docs, labels, fit_rows)
    seen = rows.agg(F.count("*"), F.sum("label")).first()
    n, n_toxic = seen[0], seen[1] or 0
    model = Examples({})
    if not n:
        model.build([], [], [])
        return model
    counts = (rows.select("text", "label").mapInArrow(_term_counts, "term long, n long, n_toxic long")
              .groupBy("term").agg(F.sum("n").alias("df"), F.sum("n_toxic").alias("a")))
    corpus = (docs.select(F.col("text").cast("string").alias("text"))
              .mapInArrow(_term_counts, "term long, n long, n_toxic long")
              .groupBy("term").agg(F.sum("n").alias("docs")))
    n_docs = docs.count()
    idf = F.log(F.lit(1.0 + n_docs) / (1 + F.col("docs"))) + 1
    terms = store(corpus.join(counts, "term", "left").withColumn("idf", idf), "toxicity-terms")
    facts = terms.agg(
        F.sum((F.col("df") >= LEAST_DF).cast("long")),
        F.sqrt(F.sum(F.when(F.col("df").isNull(), F.col("docs") * F.col("idf") * F.col("idf")))
               / F.sum(F.when(F.col("df").isNull(), F.col("docs"))))).first()
    least = NormalDist().inv_cdf(1 - TERM_LEVEL / max(1, facts[0] or 0) / 2) ** 2     # Bonferroni
    b, c = F.col("df") - F.col("a"), F.lit(n_toxic) - F.col("a")
    d = F.lit(n - n_toxic) - b
    odds = (F.col("a") * d - b * c).cast("double")
    below = (F.col("df") * (F.lit(n) - F.col("df"))).cast("double") * F.lit(float(n_toxic)) \
        * F.lit(float(n - n_toxic))
    tells = (F.col("df") >= LEAST_DF) & (below > 0) & (
        F.lit(float(n)) * odds * odds / F.when(below > 0, below) >= least)
    chosen = terms.filter("df IS NOT NULL").select(
        "term", (F.col("idf") * F.when(tells, telling).otherwise(1.0)).alias("weight")
    ).toArrow()     # the terms of at most about ``fit_rows`` rows, 16 bytes each
    model.name_terms(chosen["term"].to_numpy(), chosen["weight"].to_numpy(), facts[1] or 1.0)
    del chosen
    give_back()
    vocabulary = spark.sparkContext.broadcast(model.keys)

    def tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            for chunk in text_chunks(batch):
                keys, text, term, n = term_table(chunk.column("text").to_pylist())
                at = np.searchsorted(known, keys)[term].astype("<i4")
                cuts = np.searchsorted(text, np.arange(chunk.num_rows + 1))
                times = n.astype("<u4")
                yield pa.RecordBatch.from_pydict({
                    **{c: chunk.column(c) for c in ("doc_id", "h", "label")},
                    "at": pa.array([at[lo:hi].tobytes() for lo, hi in zip(cuts, cuts[1:])], pa.binary()),
                    "n": pa.array([_narrow(times[lo:hi]) for lo, hi in zip(cuts, cuts[1:])], pa.binary())})

    made = store(rows.select("doc_id", "h", "label", "text").mapInArrow(
        tallied, "doc_id long, h long, label int, at binary, n binary"), "toxicity-vectors")
    _index(model, made)
    vocabulary.destroy()
    shared = model.shared(spark)
    give_back()         # the driver's share of the examples

    def own_votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = loaded(shared)
        place = {k: p for p, k in enumerate(zip(examples.ids.tolist(), examples.texts.tolist(),
                                                examples.labels.tolist()))}
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024).to_pydict()
                own = [place.get(x) for x in zip(part["doc_id"], part["h"], map(float, part["label"]))]
                mine = [j for j, p in enumerate(own) if p is not None]
                vectors = [_weighed(examples, part["at"][j], part["n"][j], own[j]) for j in mine]
                near = examples.nearest_of(vectors, without=[own[j] for j in mine]) if mine else []
                found = [(examples.vote(x), part["label"][j]) for j, x in zip(mine, near) if x]
                yield pa.RecordBatch.from_pydict({"vote": pa.array([v for v, _ in found], pa.float64()),
                                                  "label": pa.array([y for _, y in found], pa.int32())})
                give_back()     # what a search took on top of the index

    votes = made.mapInArrow(own_votes, "vote double, label int").toArrow()
    if len(votes):
        order = np.lexsort((votes["label"].to_numpy(), votes["vote"].to_numpy()))
        model.calibrate(votes["vote"].to_numpy()[order], votes["label"].to_numpy()[order].astype(float))
    return model


def inner_folds(docs: DataFrame, labels: DataFrame, factors=(1.0, 3.0), fit_rows: int = FIT_ROWS) -> list[tuple]:
    """(factor, fold, toxic found, toxic, clean taken for toxic, clean): how
    factors for telling terms do within the rows that may be learnt from.

    The rows with remainder ``fold`` of crc32(doc_id) by 5, from 1 to 4, are
    scored by a model of the other three; those of remainder 0 stay unseen.
    One pass of learning for each factor and fold: a choice made once, not a
    step of :func:`fit`.
    """
    part = F.crc32(F.col("doc_id").cast("string")) % 5
    out = []
    for factor in factors:
        for fold in range(1, 5):
            model = fit(docs, labels.filter(part != fold), fit_rows, factor)
            asked = labelled(docs, labels).filter(part == fold)
            scores = toxicity_scores(asked, model).groupBy("doc_id").agg(F.max("predicted").alias("predicted"))
            known = _labels(labels).join(scores, "doc_id")
            toxic, hit = F.col("label") == 1, F.col("predicted") == 1
            out.append((factor, fold, *known.agg(F.count_if(toxic & hit), F.count_if(toxic),
                                                 F.count_if(~toxic & hit), F.count_if(~toxic)).first()))
    return out


def _narrow(counts: np.ndarray) -> bytes:
    """Counts as bytes if all are below 256, else as 32-bit numbers."""
    return (b"\x01" + counts.astype(np.uint8).tobytes() if counts.max(initial=0) < 256
            else b"\x04" + counts.astype("<u4").tobytes())


def _wide(packed) -> np.ndarray:
    return np.frombuffer(packed, dtype=np.uint8 if memoryview(packed)[0] == 1 else "<u4", offset=1)


def _weighed(model: Examples, at, n, place: int) -> tuple[np.ndarray, np.ndarray]:
    """The vector of an example from its counts."""
    at = np.frombuffer(at, dtype="<i4").astype(np.int64)
    return at, (1 + np.log(_wide(n).astype(float))) * model.idf[at] / model.norms[place]


def _index(model: Examples, made: DataFrame) -> None:
    """Build the index from the examples' counts, bounded by ``fit_rows``."""
    listed = made.toArrow()
    ids, texts, labels = (listed[c].to_numpy() for c in ("doc_id", "h", "label"))
    rows = [(np.frombuffer(at.as_buffer(), dtype="<i4"), _wide(n.as_buffer()))
            for at, n in zip(listed["at"], listed["n"])]        # views of the table
    order = np.lexsort((texts, labels, ids))
    ids, texts, labels, rows = ids[order], texts[order], labels[order], [rows[i] for i in order]
    live = np.array([len(at) > 0 for at, _ in rows], dtype=bool)
    model._rates(labels[~live].tolist(), labels)
    model.build_counts(ids[live], texts[live], labels[live].astype(float), [r for r, x in zip(rows, live) if x])


SCORES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("score", T.DoubleType()),
    T.StructField("neighbours", T.ArrayType(T.LongType())),
    T.StructField("cosines", T.ArrayType(T.DoubleType()))])


def toxicity_scores(docs: DataFrame, model: Examples) -> DataFrame:
    """doc_id, held_out, score, predicted, neighbours and cosines of every row
    of ``docs`` (doc_id, text; other columns are not read).

    Null and empty texts, and texts without a term of any example, have no
    neighbours and the score of such examples.  Repeated rows each give a row.
    A null doc_id stays null and counts as held out.  Without labelled rows
    every score is 0.
    """
    code_on_workers(docs.sparkSession)
    shared, outcome = model.shared(docs.sparkSession), model.outcome()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = loaded(shared, outcome).scores(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "score": pa.array([x[0] for x in out], pa.float64()),
                "neighbours": pa.array([x[1] for x in out], pa.list_(pa.int64())),
                "cosines": pa.array([x[2] for x in out], pa.list_(pa.float64()))})
            give_back()
        kept("toxicity").clear()        # the worker lives on
        give_back()

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.col("text").cast("string").alias("text")).mapInArrow(run, SCORES)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(True))
    return scored.select("doc_id", held.alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"),
                         "neighbours", "cosines")


def without_toxic(docs: DataFrame, model: Examples) -> DataFrame:
    """``docs`` without the rows whose text scores 0.5 or more; all columns
    and every other row are kept: null and empty texts, null doc_ids and
    repeated rows too.  An empty table gives no rows.
    """
    code_on_workers(docs.sparkSession)
    shared, outcome = model.shared(docs.sparkSession), model.outcome()

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([x[0] for x in loaded(shared, outcome).scores(batch.tolist())], dtype=float)
            give_back()
        kept("toxicity").clear()        # the worker lives on
        give_back()

    return docs.filter(score("text") < 0.5)
