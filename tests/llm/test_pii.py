import datetime as dt
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from flowtally.llm import pii
from tests.llm.conftest import prose


def h(kind, turn, part):
    return hashlib.sha256(f"{pii.KEY}:{kind}:{turn}:{part}".encode()).hexdigest()


def brute_feistel(x, y, a, b, kind):
    for i in range(1, pii.ROUNDS + 1):
        if i % 2:
            x = (x + int(h(kind, i, y)[:15], 16)) % a
        else:
            y = (y + int(h(kind, i, x)[:15], 16)) % b
    return x, y


def brute_digits(s, kind):
    u = len(s) // 2
    x, y = brute_feistel(int(s[:u]), int(s[u:]), 10 ** u, 10 ** (len(s) - u), kind)
    return str(x).zfill(u) + str(y).zfill(len(s) - u)


def luhn(s):
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(map(int, reversed(s)))) % 10 == 0


@pytest.mark.parametrize("a,b", [(229, 319), (3, 7), (1, 10)])
def test_network_is_a_permutation(spark, a, b):
    n = min(a * b, 2000)
    df = spark.range(n).withColumn("m", pii.feistel(F.floor(F.col("id") / b), F.col("id") % b, a, b, pii.KEY, "t"))
    got = {r.id: (r.m.x, r.m.y) for r in df.collect()}
    assert len(set(got.values())) == n
    assert all(got[i] == brute_feistel(i // b, i % b, a, b, "t") for i in range(0, n, 37))


def test_values(spark, docs_of):
    r = random.Random(4)
    cards = []
    while len(cards) < 30:
        s = "4" + "".join(r.choice("0123456789") for _ in range(15))
        if luhn(s):
            cards.append(s)
    rows = [(i, f"pay {c} now") for i, c in enumerate(cards)]
    got = {x.doc_id: x.text for x in pii.pseudonymised(docs_of(rows)).collect()}
    out = [got[i].split()[1] for i in range(30)]
    assert all(luhn(x) and x[0] == "4" and x[:-1] == "4" + brute_digits(c[1:-1], "card") for c, x in zip(cards, out))
    assert len(set(out)) == 30 and not set(out) & set(cards)


FORMS = {
    "ada.99@mail.example.com": r"[a-z]{3}\.\d\d@mail\.example\.com",
    "+1 (988) 555-2485": r"\+1 \(\d{3}\) \d{3}-\d{4}",
    "+49 30 1234 5678": r"\+49 \d\d \d{4} \d{4}",
    "123-45-6789": r"\d{3}-\d\d-\d{4}",
    "17.252.227.210": r"\d+\.\d+\.\d+\.\d+",
    "2024-02-29": r"\d{4}-\d\d-\d\d",
    "31.12.1999": r"\d\d\.\d\d\.\d{4}",
    "GB82 WEST 1234 5698 7654 32": r"GB\d\d WEST \d{4} \d{4} \d{4} \d\d",
    "4111-1111-1111-1111": r"4\d{3}-\d{4}-\d{4}-\d{4}",
}


def test_forms_linkage_and_neighbours(docs_of):
    rows = [(i, f"a {v} b {v}.") for i, v in enumerate(FORMS)]
    rows.append((99, " ".join(FORMS)))
    got = {r.doc_id: r for r in pii.pseudonymised(docs_of(rows)).collect()}
    for i, (value, form) in enumerate(FORMS.items()):
        text = got[i].text
        fresh = text[2:text.index(" b ")]
        assert re.fullmatch(form, fresh) and fresh != value and text == f"a {fresh} b {fresh}."
        assert fresh in got[99].text and value not in got[99].text     # linked across documents
    assert [x.kind for x in got[99].replaced] == ["email", "phone", "phone", "ssn", "ip", "date", "date", "iban", "card"]


def test_invalid_values_stay(docs_of):
    rows = [(i, f"see {v} here") for i, v in enumerate([
        "4111111111111112", "666-12-3456", "000-12-3456", "300.1.1.1", "2023-02-30", "99.99.2020",
        "GB00 WEST 1234 5698 7654 32", "user@nodot", "1.2.3.4.5"])]
    assert all(r.text == dict(rows)[r.doc_id] and not r.replaced for r in pii.pseudonymised(docs_of(rows)).collect())


def test_iban_stays_valid(spark):
    df = spark.createDataFrame([("DE89370400440532013000",)], "m string").select(pii.pseudonym(F.col("m")).alias("p"))
    p = df.first().p
    turned = "".join(str(int(c, 36)) for c in p[4:] + p[:4])
    assert int(turned) % 97 == 1 and p.startswith("DE") and p != "DE89370400440532013000"


def test_no_python_in_the_plan(docs_of):
    plan = pii.pseudonym_report(docs_of([(1, "x")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_awkward(awkward, nothing):
    got = pii.pseudonym_report(awkward).collect()
    want = sorted((str(r.doc_id), str(r.text)) for r in awkward.select("doc_id", "text").collect())
    assert sorted((str(r.doc_id), str(r.text)) for r in got) == want
    assert pii.pseudonym_report(nothing).count() == 0
    whole = pii.pseudonymised_documents(awkward)
    assert whole.columns == awkward.columns and {r.replaced for r in whole.collect()} == {"clash"}


def test_n_chars_follows(docs_of):
    got = pii.pseudonymised_documents(docs_of([(1, "mail ada@x.org now"), (2, prose(1, 5))])).collect()
    assert all(r.n_chars == len(r.text) for r in got)


FIRST = dt.date(1900, 1, 1)


def valid(text, form):
    """The day that ``text`` is in an order of fields such as "dmy"."""
    field = dict(zip(form, re.split("[-/.]", text)))
    try:
        return dt.date(*(int(field[c]) for c in "ymd"))
    except ValueError:
        return None


def brute_date(text):
    """A date's pseudonym by counting through the calendar."""
    first, other = ("mdy", "dmy") if "/" in text else ("dmy", "mdy")
    sign = re.search("[-/.]", text)[0]
    if valid(text, first):
        at = (valid(text, first) - FIRST).days
        x, y = brute_feistel(at // 319, at % 319, 229, 319, "date")
        day, form = FIRST + dt.timedelta(x * 319 + y), first
    else:
        late = [FIRST + dt.timedelta(i) for i in range(73_049) if (FIRST + dt.timedelta(i)).day > 12]
        at = late.index(valid(text, other))
        while True:
            x, y = brute_feistel(at // 250, at % 250, 177, 250, "late date")
            at = x * 250 + y
            if at < len(late):
                break
        day, form = late[at], other
    return sign.join({"d": f"{day.day:02}", "m": f"{day.month:02}", "y": f"{day.year:04}"}[c] for c in form)


@pytest.mark.parametrize("sign", "/-.")
def test_no_two_dates_share_a_pseudonym(spark, sign):
    days = [FIRST + dt.timedelta(i) for i in range(73_049)]
    texts = sorted({t for d in days for t in (f"{d:%m{sign}%d{sign}%Y}", f"{d:%d{sign}%m{sign}%Y}")})
    assert len(texts) == 117_298
    df = spark.createDataFrame([(t,) for t in texts], "m string").repartition(8)
    got = {r.m: r.p or r.m for r in df.select("m", pii.pseudonym(F.col("m")).alias("p")).collect()}
    assert len(set(got.values())) == len(texts)
    first = "mdy" if sign == "/" else "dmy"
    assert all((valid(a, first) is None) == (valid(b, first) is None) for a, b in got.items())
    r = random.Random(3)
    for text in r.sample(texts, 60):
        assert got[text] == brute_date(text)


def test_domains_of_any_letters(docs_of):
    text = pii.pseudonymised(docs_of([(1, "an anna.maier@bücher.de, bitte")])).first().text
    assert "anna" not in text and "@bücher.de, bitte" in text


NAMES = ("иван.петров", "γιάννης", "محمد", "山田太郎", "김철수", "straße", "œuvre", "żółw", "ışık.çağ", "ivan.петров",
         "\U0001d49c\U0001d49e\U0001d4aa", "ÿµß")


def test_names_of_any_letters_are_replaced(docs_of):
    rows = [(i, f"to {n}@mail.example.com now") for i, n in enumerate(NAMES)] + [(99, "to .-+_@mail.example.com now")]
    got = {r.doc_id: r for r in pii.pseudonymised(docs_of(rows)).collect()}
    for i, name in enumerate(NAMES):
        fresh = got[i].replaced[0].pseudonym
        assert [x.kind for x in got[i].replaced] == ["email"] and got[i].text == f"to {fresh} now"
        moved = fresh.removesuffix("@mail.example.com")
        assert len(moved) == len(name) and moved != name
        # Letters stay letters, and no part of two letters and more stays.
        assert all(a == b if not a.isalnum() else b.isalnum() for a, b in zip(name, moved))
        assert all(a not in moved for a in re.findall(r"\w{3,}", name))
    assert got[99].replaced == [] and got[99].text == rows[-1][1]


def test_runs_of_letters_are_permuted(docs_of):
    letters = [chr(c) for c in (*range(0x430, 0x460), *range(0x5d0, 0x5eb), *range(0x100, 0x180))] + list("ßÿªµº")
    rows = [(i, f"{x}{y}@x.org") for i, (x, y) in enumerate(zip(letters, letters[1:] + letters[:1]))]
    texts = [r.text for r in pii.pseudonymised(docs_of(rows)).collect()]
    assert len(set(texts)) == len(rows) and not set(texts) & {t for _, t in rows}
