import random
import zlib

import numpy as np
import pytest

from flowtally.llm import language

SYLLABLES = {"aa": "th er on an re he in ed".split(), "bb": "sch ung ein keit ver lich zu".split(),
             "cc": "ción que los ado mente ñe".split()}


def text_in(lang, seed, n=60):
    r = random.Random(f"{lang}{seed}")
    return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(i, text_in(lang, i), lang) for i, lang in enumerate(list(SYLLABLES) * 80)]
    rows += [(1000, None, "aa"), (1001, "123 !!", "bb"), (1002, "", "cc"), (1003, text_in("bb", 1), None),
             (None, text_in("cc", 2), "cc")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def brute_spectrum(text):
    plain = " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "
    return {plain[i:i + n] for n in (1, 2, 3) for i in range(len(plain) - n + 1)}


def test_spectrum_counts_and_kernel():
    a, b = text_in("aa", 1), text_in("bb", 2) + " Ñandú 42"
    sa, sb = language.spectrum(a), language.spectrum(b)
    assert len(sa) == len(brute_spectrum(a)) and len(sb) == len(brute_spectrum(b))
    assert (np.diff(sb) > 0).all()
    model = language.Kernel([sa, sb], ["aa", "bb"])
    got = model.against_landmarks([sa, language.spectrum(a + " " + b)])
    for i, x in enumerate((a, a + " " + b)):
        for j, y in enumerate((a, b)):
            gx, gy = brute_spectrum(x), brute_spectrum(y)
            assert got[i, j] == pytest.approx(len(gx & gy) / (len(gx) * len(gy)) ** 0.5, abs=1e-5)


def test_predictions(code, frame):
    model = language.fit(frame)
    assert model.languages == ["aa", "bb", "cc"]
    rows = language.predict_language(frame, model).collect()
    truth = {r.doc_id: r.lang for r in frame.collect()}
    assert len(rows) == frame.count()
    for r in rows:
        if r.doc_id in (1000, 1001, 1002):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
            assert r.lang_pred == (truth[r.doc_id] or "bb") and 0 <= r.score <= 1


def test_learns_only_from_its_fold(code, spark, frame):
    held = frame.filter("crc32(cast(doc_id as string)) % 4 = 2")
    assert language.fit(held).languages == []


def test_awkward(awkward, nothing, frame):
    model = language.fit(frame)
    got = language.predict_language(awkward, model).collect()
    assert len(got) == awkward.count()
    assert all(r.lang_pred == "und" for r in got if r.doc_id in (1, 2, 3))
    assert language.predict_language(nothing, model).count() == 0
    assert {r.lang_pred for r in language.predict_language(awkward, language.fit(nothing)).collect()} == {"und"}
