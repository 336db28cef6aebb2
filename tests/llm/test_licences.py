import random
import time

import pytest
import zstandard

from flowtally.llm import licences
from tests.llm.conftest import prose


@pytest.fixture(scope="module")
def matcher():
    return licences.Matcher(licences.TEMPLATES)


@pytest.mark.parametrize("name,notice", [(n, t) for n, ts in licences.TEMPLATES.items() for t in ts])
def test_every_notice_is_found_in_prose(matcher, name, notice):
    notice = notice.replace("* *", "2019 Example Corp.")
    text = prose(1, 50) + ". " + notice + "\n" + prose(2, 50) + "."
    found = matcher.find(text)
    assert [f[2] for f in found] == [name]
    start, end = found[0][:2]
    inside = text[start:end]
    assert inside in notice and len(inside) >= len(notice.rstrip(".:")) - 15


def test_versions_and_neighbours(matcher):
    text = ("This work is licensed under the GNU General Public License, version 2. All rights reserved. "
            "Licensed under CC BY-NC 4.0. Licensed under CC BY-SA 4.0.")
    assert [f[2] for f in matcher.find(text)] == ["GPL-2.0", "all-rights-reserved", "CC-BY-NC-4.0", "CC-BY-SA-4.0"]


def test_small_changes_are_told(matcher):
    notice = licences.TEMPLATES["MIT"][2].replace("without limitation ", "").replace("any person", "every person")
    found = matcher.find(notice)
    assert [f[2] for f in found] == ["MIT"] and 2 <= found[0][4] <= 4 and "limitation" in found[0][5]


def test_other_talk_of_licenses_is_left_alone(matcher):
    for text in ("His driving licence was stolen.", "We cannot warrant that the car is licensed.",
                 "The copyright office moved.", prose(3, 400)):
        assert matcher.find(text) == []


def test_reductions_rank_the_source_first(matcher):
    r = random.Random(0)
    for i, words in enumerate(matcher.words):
        if len(words) > 12:
            changed = list(words)
            changed[r.randrange(len(words))] = "something"
            assert matcher.names[matcher.reductions(changed)[0][1]] == matcher.names[i]


def test_report(docs_of, awkward, nothing):
    notice = "Released under the MIT License."
    rows = [(1, prose(1, 20) + ".\n" + notice + "\n" + prose(2, 20)), (2, None), (3, ""), (4, prose(3, 30))]
    got = {r.doc_id: r for r in licences.licence_report(docs_of(rows)).collect()}
    text = dict(rows)[1]
    at = text.index(notice)
    assert got[1].licenses == "MIT" and got[1].spans == f"MIT:{at}:{at + len(notice) - 1}"
    assert all(got[i].n_findings == 0 and got[i].spans == "" for i in (2, 3, 4))
    assert licences.licence_report(awkward).count() == awkward.count()
    assert licences.licence_report(nothing).count() == 0


HEADER = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as "
          "published by the Free Software Foundation, either version {} of the License, or (at your option) any "
          "later version.")


@pytest.mark.parametrize("kind,version,name", [
    ("General Public License", "3", "GPL-3.0"), ("General Public License", "2", "GPL-2.0"),
    ("Lesser General Public License", "3", "LGPL-3.0"), ("Lesser General Public License", "2.1", "LGPL-2.1"),
    ("Affero General Public License", "3", "AGPL-3.0")])
def test_standard_headers(matcher, kind, version, name):
    header = HEADER.format(kind, version)
    notice = header + "\n" + licences.TEMPLATES["GPL"][0].replace("*", "program")
    text = prose(1, 30) + ".\n" + notice + "\n" + prose(2, 30) + "."
    assert [f[2] for f in matcher.find(text)] == [name, name]
    changed = header.replace("program", "library").replace("published", "issued")
    assert [f[2] for f in matcher.find(prose(1, 30) + ".\n" + changed)] == [name]


def test_a_changed_deciding_word_is_no_finding(matcher):
    for text in (HEADER.format("General Public License", "1"), HEADER.format("Affero General Public License", "2"),
                 "This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1.",
                 "Licensed under CC BY 3.0.", "Licensed under the BSD 4-Clause License."):
        assert matcher.find(text) == []


def test_clauses_decide_between_bsd_licenses(matcher):
    first, one, two, warranty = licences.TEMPLATES["BSD"]
    three = licences.TEMPLATES["BSD-3-Clause"][1]
    assert [f[2] for f in matcher.find(first)] == ["BSD"]
    short = f"{first}\n\n1. {one}\n2. {two}\n\n{warranty}"
    assert {f[2] for f in matcher.find(short)} == {"BSD-2-Clause"}
    whole = f"{first}\n\n1. {one}\n2. {two}\n3. {three}\n\n{warranty}"
    assert {f[2] for f in matcher.find(whole)} == {"BSD-3-Clause"} and len(matcher.find(whole)) == 5
    mit = licences.TEMPLATES["MIT"]
    assert [f[2] for f in matcher.find("\n\n".join(mit[2:5]))] == ["MIT"] * 3


def plain_saving(template, words):
    """Share of the size that a template as raw dictionary saves, by the
    compressor alone."""
    block = " ".join(words).encode()
    raw = zstandard.ZstdCompressionDict(" ".join(template).encode(),
                                        dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    bare = {"level": licences.LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
    given = zstandard.ZstdCompressor(dict_data=raw, **bare)
    return 1 - len(given.compress(block)) / len(zstandard.ZstdCompressor(**bare).compress(block))


def fewest_changes(template, words):
    """Words to drop, add or replace (one each), by dynamic programming."""
    best = list(range(len(words) + 1))
    for i, a in enumerate(template, 1):
        row = [i]
        for j, b in enumerate(words, 1):
            row.append(min(row[-1] + 1, best[j] + 1, best[j - 1] + (a != b)))
        best = row
    return best[-1]


@pytest.mark.parametrize("seed", range(12))
def test_reductions_and_differences_by_brute_force(matcher, seed):
    r = random.Random(seed)
    i = r.choice([k for k, w in enumerate(matcher.words) if len(w) >= 20 and "*" not in w])
    words = list(matcher.words[i])
    for _ in range(r.randrange(4)):
        at = r.randrange(1, len(words) - 1)
        words[at:at + 1] = r.choice([[], ["plainly"], ["quite", words[at]]])
    got = dict((k, saved) for saved, k in matcher.reductions(words))
    assert all(abs(got[k] - plain_saving(t, words)) < 1e-12 for k, t in enumerate(matcher.words))
    ranks = [saved for saved, _ in matcher.reductions(words)]
    assert [round(x, 6) for x in ranks] == sorted((round(x, 6) for x in ranks), reverse=True)
    count, lo, hi, _, _ = matcher.differences(words, matcher.words[i])
    assert (lo, hi) == (0, len(words)) and count == fewest_changes(matcher.words[i], words)


def test_long_blocks_are_linear(matcher):
    """Two thousand notices in one block: as many findings, each at its place,
    and about the time of as many short texts."""
    notices = [t.replace("* *", "2019 Example Corp.") for ts in licences.TEMPLATES.values() for t in ts]
    r = random.Random(3)
    picked = [r.choice(notices) for _ in range(2000)]
    start = time.process_time()
    few = matcher.find("\n".join(picked[:250]))
    middle = time.process_time()
    many = matcher.find("\n".join(picked))
    end = time.process_time()
    assert len(many) >= 0.99 * len(picked) and [f[2:] for f in many[:200]] == [f[2:] for f in few[:200]]
    assert all(a[1] <= b[0] for a, b in zip(many, many[1:]))
    assert end - middle < 3 * 8 * (middle - start)
