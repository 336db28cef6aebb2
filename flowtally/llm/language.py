"""Language identification with a string kernel.

Two texts are compared by the blended-spectrum presence kernel: the number of
distinct character n-grams (n = 1 .. ``SPAN``) that both hold, over the root
of the product of how many each holds.  ``LANDMARKS`` texts, dealt among the
languages, give the Nystroem approximation of the kernel, and one-versus-rest
kernel ridge regression is solved in that space.  Scoring is two matrix
products per batch: presence of the landmarks' n-grams times their incidence
gives the kernel against every landmark, and that times the coefficients gives
one value per language.

Texts are lower-cased and read whole; every run of characters that are not
letters counts as one space.  The fit uses about ``FIT_ROWS`` labelled rows of
each language (chosen by a hash of doc_id); everything else covers every row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtally.llm.common import share_hash, store

SPAN = 3
FIT_ROWS = 500              # labelled rows of each language
LANDMARKS = 240             # over all languages
RIDGE = 1e-3
BATCH_CELLS = 1 << 23       # cells of a batch's presence matrix
UNKNOWN = "und"
GAP = re.compile(r"[\W\d_]+")
HAS_LETTER = re.compile(r"[^\W\d_]")
BITS = 21                   # of a code point


def spectrum(text: str | None, span: int = SPAN) -> np.ndarray:
    """The distinct n-grams of a text, as sorted 64-bit numbers."""
    plain = f" {GAP.sub(' ', (text or '').lower()).strip()} "
    codes = np.frombuffer(plain.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    grams, parts = codes, [np.unique(codes)]
    for _ in range(1, span):
        if len(grams) < 2:
            break
        grams = (grams[:-1] << BITS) | codes[len(codes) - len(grams) + 1:]
        parts.append(np.unique(grams))
    return np.concatenate(parts)        # by n, so sorted: longer ones are larger


class Kernel:
    """Landmarks and one-versus-rest coefficients."""

    def __init__(self, landmarks: list[np.ndarray], languages: list[str]):
        self.languages = languages
        self.grams = (np.unique(np.concatenate(landmarks)) if landmarks
                      else np.zeros(0, dtype=np.int64))
        self.incidence = np.zeros((len(self.grams), len(landmarks)), dtype=np.float32)
        for j, x in enumerate(landmarks):
            self.incidence[np.searchsorted(self.grams, x), j] = 1 / np.sqrt(len(x))
        self.coefficients = np.zeros((len(landmarks), len(languages)))

    def against_landmarks(self, spectra: list[np.ndarray]) -> np.ndarray:
        """The kernel of every text with every landmark."""
        out = np.zeros((len(spectra), self.incidence.shape[1]))
        step = max(1, BATCH_CELLS // max(1, len(self.grams)))
        for at in range(0, len(spectra), step):
            part = spectra[at:at + step]
            presence = np.zeros((len(part), len(self.grams)), dtype=np.float32)
            for i, x in enumerate(part):
                k = np.searchsorted(self.grams, x)
                k[k == len(self.grams)] = 0
                hit = k[self.grams[k] == x] if len(self.grams) else k[:0]
                presence[i, hit] = 1 / np.sqrt(max(1, len(x)))
            out[at:at + step] = presence @ self.incidence
        return out

    def solve(self, spectra: list[np.ndarray], labels: np.ndarray,
              landmarks: list[np.ndarray], ridge: float = RIDGE) -> None:
        """Kernel ridge regression of +1 / -1 targets in the Nystroem space,
        every language with the same total weight."""
        own = self.against_landmarks(landmarks)
        values, vectors = np.linalg.eigh((own + own.T) / 2)
        keep = values > 1e-6 * max(values.max(), 1e-12)
        root = vectors[:, keep] / np.sqrt(values[keep])
        x = self.against_landmarks(spectra) @ root
        y = 2.0 * (labels[:, None] == np.arange(len(self.languages))) - 1
        size = np.bincount(labels, minlength=len(self.languages))
        w = (len(labels) / np.maximum(size, 1) / len(self.languages))[labels][:, None]
        gram = x.T @ (w * x) + ridge * len(labels) * np.eye(x.shape[1])
        self.coefficients = root @ np.linalg.solve(gram, x.T @ (w * y))

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score (0 to 1) of every text."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        values = self.against_landmarks([spectrum(t) for t in texts]) @ self.coefficients
        best = values.argmax(axis=1)
        score = np.clip((values[np.arange(len(texts)), best] + 1) / 2, 0.0, 1.0)
        known = np.array([t is not None and HAS_LETTER.search(t) is not None for t in texts], dtype=bool)
        names = [self.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
        return names, np.where(known, score, 0.0)


def fit(docs: DataFrame, fit_rows: int = FIT_ROWS, landmarks: int = LANDMARKS) -> Kernel:
    """Learn from rows with a language whose crc32(doc_id as text) mod 4 is
    not 2; a null doc_id is not learnt from."""
    known = (docs.select("doc_id", "text", "lang")
             .filter("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL")
             .filter(F.crc32(F.col("doc_id").cast("string")) % 4 != 2))
    # One row per language code.
    sizes = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Kernel([], [])
    rates = F.create_map(*(x for lang in languages for x in (
        F.lit(lang), F.lit(int(min(1.0, fit_rows / sizes[lang]) * 1_000_000)))))
    rows = store(known.filter(share_hash("doc_id") < rates[F.col("lang")]), "language-fit")

    def spectra(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 200):
                part = batch.iloc[at:at + 200]
                yield pd.DataFrame({"doc_id": part["doc_id"], "lang": part["lang"],
                                    "grams": [spectrum(t).tobytes() for t in part["text"]]})

    # About ``fit_rows`` rows per language, as n-gram sets.
    sample = (rows.mapInPandas(spectra, "doc_id long, lang string, grams binary")
              .orderBy(share_hash("doc_id", seed=3), "doc_id", "lang").collect())
    chosen, each = [], -(-landmarks // len(languages))
    taken = dict.fromkeys(languages, 0)
    for r in sample:
        if taken[r.lang] < each:
            taken[r.lang] += 1
            chosen.append(np.frombuffer(r.grams, dtype=np.int64))
    model = Kernel(chosen, languages)
    place = {x: i for i, x in enumerate(languages)}
    model.solve([np.frombuffer(r.grams, dtype=np.int64) for r in sample],
                np.array([place[r.lang] for r in sample]), chosen)
    return model


PREDICTED = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("lang_pred", T.StringType()),
    T.StructField("score", T.DoubleType())])


def predict_language(docs: DataFrame, model: Kernel) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of ``docs`` (doc_id,
    text; other columns are not read).

    Null texts and texts without a letter are ``und`` with score 0, as is
    everything when no language was learnt.  Ties go to the first language by
    code.  Repeated rows each give a row; a null doc_id stays null and counts
    as held out.  An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 1000):
                part = batch.iloc[at:at + 1000]
                names, scores = shared.value.predict(
                    [None if t is None else t for t in part["text"]])
                yield pd.DataFrame({"doc_id": part["doc_id"].astype("Int64"),
                                    "lang_pred": names, "score": scores})

    found = docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(run, PREDICTED)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(True))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")
