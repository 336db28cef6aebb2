"""Format-preserving pseudonyms for personal data, with DataFrame functions.

Personal values are found by one pattern, validated by kind (check digits,
calendar, ranges), and replaced by a keyed permutation of their kind's format:
a pseudonym is again a valid value of the same form, equal values get equal
pseudonyms in all documents, and different values different ones.

The permutation is a Feistel network.  A value is split into two parts (x, y)
of ranges a and b; in turn ``x + F(key, round, y) mod a`` and
``y + F(key, round, x) mod b`` replace them.  Every round can be undone, so
the network permutes the a x b values whatever a and b are, and ranges are
chosen so that a x b is exactly the number of valid values: no value has to be
walked until it is valid.  F is SHA-256 of the key, the kind, the round and the
other part.

========  =============================================  =======================
kind      valid                                          stays as it is
========  =============================================  =======================
email     one @, a domain with a dot                     domain, place of letters
card      13 to 19 digits, Luhn                          first digit; check digit follows
iban      mod 97 is 1                                    country, letters; check digits follow
ssn       area, group and serial in use                  hyphens
phone     7 to 15 digits                                 country code, punctuation
ip        four numbers up to 255                         dots
date      a day of 1900 to 2099                          order and punctuation; whether a
                                                         text is a date in one order only
========  =============================================  =======================

Letters and digits of an e-mail's name move within ASCII, Latin-1, or the run
of consecutive code points that are letters or digits; those that stand alone
move among themselves.

Values that fail their check are left as they are.  So is a value that the
permutation maps to itself (a name without letters, or by chance); it is not
listed as replaced.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtally.llm.common import protected

KEY = "pseudonyms-1"        # a deployment passes its own secret
ROUNDS = 8

# The forms, in the order in which they are tried.
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)++"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
DATE = (r"(?<![0-9.\-/])(?:[0-9]{4}([-/.])[0-9]{2}\1[0-9]{2}|[0-9]{2}([-/.])[0-9]{2}\2[0-9]{4})"
        r"(?![0-9]|[.\-/][0-9])")
IP = r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"
SSN = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
CARD = (r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\3[0-9]{4}\3[0-9]{1,7}"
        r"|[0-9]{4}([ -])[0-9]{6}\4[0-9]{5})(?![0-9A-Za-z])")
PHONE = (r"(?<![0-9A-Za-z+(])(?:(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
         r"|\+[0-9]{1,3}(?:[ .-]?\([0-9]{1,4}\))?(?:[ .-]?[0-9]{2,4}){2,4})"
         r"(?![0-9A-Za-z]|[.-][0-9])")
NUMBERS = (IBAN, DATE, IP, SSN, CARD, PHONE)
PATTERN = "|".join((EMAIL, *NUMBERS))
WITHOUT_EMAIL = "|".join(NUMBERS)
KINDS = ("email", "iban", "date", "ip", "ssn", "card", "phone")
FIRST_DAY, DAYS = "1900-01-01", (229, 319)      # 229 * 319 days, to 2100-01-02
MONTHS = 2400                                   # to 2099-12
TURNED = ("MM-dd-yyyy", "MM.dd.yyyy", "dd/MM/yyyy")     # read only where the other order is no date
FROM_13TH, FROM_13TH_ROOM = 44_249, (177, 250)  # their days: from the 13th on; one place more
AREAS, GROUPS, SERIALS = 898, 99, 9999          # 001-899 without 666; 01-99; 0001-9999
ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
             "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþ", "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ")


def _other_letters() -> tuple[list[int], list[int], str]:
    """Where runs of two and more letters or digits outside ``ALPHABETS``
    begin and end, and the letters and digits without a neighbour."""
    own, runs = set("".join(ALPHABETS)), []
    for code in range(0x40000):     # no letters beyond
        if unicodedata.category(chr(code))[0] in "LN" and chr(code) not in own:
            if runs and runs[-1][1] == code:
                runs[-1][1] += 1
            else:
                runs.append([code, code + 1])
    long = [r for r in runs if r[1] - r[0] > 1]
    return ([lo for lo, _ in long], [hi for _, hi in long],
            "".join(chr(lo) for lo, hi in runs if hi - lo == 1))


RUN_STARTS, RUN_ENDS, ALONE = _other_letters()


def let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often it is
    used: an element of an array is a variable to the function over it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _hash(key: str, kind: str, turn: Column, part: Column) -> Column:
    return F.sha2(F.concat_ws(":", F.lit(key), F.lit(kind), turn.cast("string"), part.cast("string")), 256)


def _number(hexes: Column) -> Column:
    return F.conv(F.substring(hexes, 1, 15), 16, 10).cast("long")


def feistel(x: Column, y: Column, a, b, key: str, kind: str) -> Column:
    """Struct (x, y) of the permuted pair; x is below a, y below b."""
    a = a if isinstance(a, Column) else F.lit(a).cast("long")
    b = b if isinstance(b, Column) else F.lit(b).cast("long")
    start = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"))

    def turn(at: Column, i: Column) -> Column:
        return F.when(i % 2 == 1, F.struct(
            ((at.x + _number(_hash(key, kind, i, at.y))) % a).alias("x"), at.y.alias("y"))).otherwise(
                F.struct(at.x.alias("x"), ((at.y + _number(_hash(key, kind, i, at.x))) % b).alias("y")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn)


def _ten_to(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, "0").cast("long")


def permute_digits(digits: Column, key: str, kind: str) -> Column:
    """A permutation of the digit strings of each length from 2 to 36."""
    def permuted(d: Column) -> Column:
        n = F.length(d)
        u = F.floor(n / 2).cast("int")
        pair = feistel(F.substring(d, F.lit(1), u), F.substring(d, u + 1, n - u),
                       _ten_to(u), _ten_to(n - u), key, kind)
        return let(pair, lambda m: F.concat(F.lpad(m.x.cast("string"), u, "0"),
                                            F.lpad(m.y.cast("string"), n - u, "0")))

    return let(digits, permuted)


def only_digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def refill(form: Column, digits: Column) -> Column:
    """``form`` with its digits replaced by ``digits``, one by one."""
    return let(digits, lambda d: F.array_join(F.transform(F.split(form, ""), lambda ch, i: F.when(
        ch.rlike("^[0-9]$"),
        F.substring(d, F.length(only_digits(F.substring(form, F.lit(1), i + 1))), F.lit(1)))
        .otherwise(ch)), ""))


def luhn_digit(digits: Column) -> Column:
    """The check digit that follows ``digits``."""
    def check(all_digits: Column) -> Column:
        n = F.length(all_digits)

        def add(total: Column, i: Column) -> Column:
            d = F.substring(all_digits, n - i + 1, F.lit(1)).cast("int")
            return total + F.when(i % 2 == 1, 2 * d - F.when(d > 4, 9).otherwise(0)).otherwise(d)

        total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)
        return ((10 - total % 10) % 10).cast("string")

    return let(digits, check)


def mod97(account: Column) -> Column:
    """The remainder by 97 of an account in which letters count from 10."""
    codes = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.aggregate(F.split(account, ""), F.lit(0), lambda r, ch: (
        F.when(ch == "", r)
        .when(ch.rlike("^[0-9]$"), (r * 10 + F.instr(F.lit(codes), ch) - 1) % 97)
        .otherwise((r * 100 + F.instr(F.lit(codes), ch) - 1) % 97)).cast("int"))


def _shift_other(ch: Column, by: Column) -> Column:
    """A letter outside ``ALPHABETS`` moved within its run."""
    starts, ends = (F.split(F.lit(",".join(map(str, x))), ",").cast("array<int>") for x in (RUN_STARTS, RUN_ENDS))
    code, alone = F.ascii(ch), F.instr(F.lit(ALONE), ch)
    run = F.struct(F.array_max(F.filter(starts, lambda s: s <= code)).alias("lo"),
                   F.array_min(F.filter(ends, lambda e: e > code)).alias("hi"))
    return F.when(alone > 0, F.substring(F.lit(ALONE), (alone - 1 + by) % len(ALONE) + 1, F.lit(1))).otherwise(
        let(run, lambda r: F.when(
            F.array_position(starts, r.lo) == F.array_position(ends, r.hi),
            F.decode(F.unhex(F.lpad(F.hex(r.lo + (code - r.lo + by) % (r.hi - r.lo)), 8, "0")), "UTF-32"))
            .otherwise(ch)))


def _shift(text: Column, hexes: Column) -> Column:
    """Every character moved within its alphabet by the hash's bytes."""
    def shifted(h: Column) -> Column:
        def moved(ch: Column, i: Column) -> Column:
            by = F.conv(F.substring(h, (i % 32) * 2 + 1, F.lit(2)), 16, 10).cast("int")
            # Two bytes, as some runs are long.
            far = F.conv(F.substring(h, (i % 31) * 2 + 1, F.lit(4)), 16, 10).cast("int")
            out = F.when(F.ascii(ch) > 127, _shift_other(ch, far)).otherwise(ch)
            for letters in ALPHABETS:
                at = F.instr(F.lit(letters), ch)
                out = F.when((ch != "") & (at > 0), F.substring(
                    F.lit(letters), (at - 1 + by) % len(letters) + 1, F.lit(1))).otherwise(out)
            return out

        return F.array_join(F.transform(F.split(text, ""), moved), "")

    return let(hexes, shifted)


def permute_text(text: Column, key: str, kind: str) -> Column:
    """A permutation of texts that keeps every character's alphabet."""
    n = F.char_length(text)
    u = F.floor(n / 2).cast("int")
    start = F.struct(F.substring(text, F.lit(1), u).alias("x"),
                     F.substring(text, u + 1, n - u).alias("y"))

    def turn(at: Column, i: Column) -> Column:
        return F.when(i % 2 == 1, F.struct(
            _shift(at.x, _hash(key, kind, i, at.y)).alias("x"), at.y.alias("y"))).otherwise(
                F.struct(at.x.alias("x"), _shift(at.y, _hash(key, kind, i, at.x)).alias("y")))

    return let(F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn),
               lambda moved: F.concat(moved.x, moved.y))


def _email(m: Column, key: str) -> Column:
    name = F.substring_index(m, "@", 1)
    return F.concat(permute_text(name, key, "email"), F.lit("@"), F.substring_index(m, "@", -1))


def _card(m: Column, key: str) -> Column:
    digits = only_digits(m)
    n = F.length(digits)
    body = F.concat(F.substring(digits, 1, 1), permute_digits(
        F.substring(digits, F.lit(2), n - 2), key, "card"))
    fine = luhn_digit(F.substring(digits, F.lit(1), n - 1)) == F.substring(digits, n, F.lit(1))
    return F.when(fine, let(body, lambda b: refill(m, F.concat(b, luhn_digit(b)))))


def _iban(m: Column, key: str) -> Column:
    flat = F.regexp_replace(m, " ", "")
    country, account = F.substring(flat, 1, 2), F.substring(flat, F.lit(5), F.length(flat) - 4)
    numbers = only_digits(account)
    moved = F.when(F.length(numbers) < 2, numbers).otherwise(permute_digits(numbers, key, "iban"))
    fine = mod97(F.concat(account, F.substring(flat, 1, 4))) == 1

    def checked(fresh: Column) -> Column:
        rest = mod97(F.concat(refill(account, fresh), country, F.lit("00")))
        return refill(m, F.concat(F.lpad((98 - rest).cast("string"), 2, "0"), fresh))

    return F.when(fine, let(moved, checked))


def _ssn(m: Column, key: str) -> Column:
    area, group, serial = (F.substring(m, s, n).cast("long") for s, n in ((1, 3), (5, 2), (8, 4)))
    fine = (area >= 1) & (area <= 899) & (area != 666) & (group >= 1) & (serial >= 1)
    moved = feistel(area - 1 - F.when(area > 666, 1).otherwise(0), (group - 1) * SERIALS + serial - 1,
                    AREAS, GROUPS * SERIALS, key, "ssn")
    return F.when(fine, let(moved, lambda p: F.concat_ws(
        "-", F.lpad((p.x + 1 + F.when(p.x >= 665, 1).otherwise(0)).cast("string"), 3, "0"),
        F.lpad((F.floor(p.y / SERIALS) + 1).cast("string"), 2, "0"),
        F.lpad((p.y % SERIALS + 1).cast("string"), 4, "0"))))


def _phone(m: Column, key: str) -> Column:
    code = F.regexp_extract(m, r"^\+[0-9]{1,3}(?=[ .(-])", 0)
    rest = F.substring(m, F.length(code) + 1, F.length(m))
    digits = only_digits(rest)
    fine = F.length(only_digits(m)).between(7, 15) & (F.length(digits) >= 4)
    return F.when(fine, F.concat(code, refill(rest, permute_digits(digits, key, "phone"))))


def _ip(m: Column, key: str) -> Column:
    parts = [F.substring_index(F.substring_index(m, ".", k), ".", -1).cast("long") for k in (1, 2, 3, 4)]
    fine = F.greatest(*parts) <= 255
    moved = feistel(parts[0] * 256 + parts[1], parts[2] * 256 + parts[3], 1 << 16, 1 << 16, key, "ip")
    return F.when(fine, let(moved, lambda p: F.concat_ws(
        ".", *((F.floor(v / 256) if high else v % 256).cast("string")
               for v in (p.x, p.y) for high in (True, False)))))


def _since_first(day: Column) -> Column:
    return F.datediff(day, F.to_date(F.lit(FIRST_DAY)))


def _moved_day(at: Column, key: str) -> Column:
    """The pseudonym of day ``at`` among all days."""
    moved = feistel(F.floor(at / DAYS[1]), at % DAYS[1], *DAYS, key, "date")
    return let(moved, lambda p: F.date_add(F.to_date(F.lit(FIRST_DAY)), (p.x * DAYS[1] + p.y).cast("int")))


def _moved_late_day(day: Column, key: str) -> Column:
    """The pseudonym of a day from the 13th on among such days."""
    first, room = F.to_date(F.lit(FIRST_DAY)), FROM_13TH_ROOM[1]

    def month_start(m: Column) -> Column:       # such days before month m
        return F.datediff(F.add_months(first, m), first) - 12 * m

    def step(at: Column) -> Column:
        return let(feistel(F.floor(at / room), at % room, *FROM_13TH_ROOM, key, "late date"),
                   lambda p: p.x * room + p.y)

    def day_at(at: Column) -> Column:
        guess = F.floor(at * MONTHS / FROM_13TH).cast("int")        # at most one month off
        month = F.array_max(F.filter(F.array(guess - 1, guess, guess + 1), lambda m: month_start(m) <= at))
        return let(month, lambda m: F.date_add(F.add_months(first, m), (12 + at - month_start(m)).cast("int")))

    month = (F.year(day) - int(FIRST_DAY[:4])) * 12 + F.month(day) - 1
    # The one place beyond is stepped over: stepping from it never ends there again.
    once = let(step((_since_first(day) - 12 * (month + 1)).cast("long")),
               lambda at: F.when(at == FROM_13TH, step(at)).otherwise(at))
    return let(once, day_at)


def _date(m: Column, key: str) -> Column:
    """A date keeps its form.  Where two orders of day and month share a form,
    the texts that are dates in the first order, and those that are dates in
    the other order only, are permuted each among themselves."""
    out = F.lit(None).cast("string")
    # Day first comes before month first but for slashes; the first valid one counts.
    for form in (*TURNED, "MM/dd/yyyy", "dd-MM-yyyy", "dd.MM.yyyy", "yyyy.MM.dd", "yyyy/MM/dd", "yyyy-MM-dd"):
        day = F.try_to_timestamp(m, F.lit(form)).cast("date")
        at = _since_first(day)
        if form in TURNED:
            fine, fresh = (F.dayofmonth(day) > 12) & (at >= 0) & (at < FROM_13TH + 12 * MONTHS), _moved_late_day(day, key)
        else:
            fine, fresh = (at >= 0) & (at < DAYS[0] * DAYS[1]), _moved_day(at, key)
        shape = "^" + form.translate(str.maketrans({c: "[0-9]" for c in "yMd"})).replace(".", r"\.") + "$"
        out = F.when(m.rlike(shape) & fine, F.date_format(fresh, form)).otherwise(out)
    return out


def kind_of(m: Column) -> Column:
    """The kind whose form a finding has."""
    return (F.when(F.contains(m, F.lit("@")), "email")
            .when(m.rlike("^[A-Z]"), "iban")
            .when(m.rlike("^" + DATE + "$"), "date")
            .when(m.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"), "ip")
            .when(m.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "ssn")
            .when(m.rlike("^" + CARD.replace(r"\3", r"\1").replace(r"\4", r"\2") + "$"), "card")
            .otherwise("phone"))


def pseudonym(m: Column, key: str = KEY) -> Column:
    """The pseudonym of a finding, null if it fails the check of its kind or
    would stay as it is."""
    def by_kind(kind: Column) -> Column:
        out = F.lit(None).cast("string")
        for name, make in (("email", _email), ("iban", _iban), ("date", _date), ("ip", _ip),
                           ("ssn", _ssn), ("card", _card), ("phone", _phone)):
            out = F.when(kind == name, make(m, key)).otherwise(out)
        return let(out, lambda p: F.when(p != m, p))

    return let(kind_of(m), by_kind)


def pseudonymised(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` (doc_id, text) as doc_id, text with pseudonyms, and
    ``replaced``, one (kind, pseudonym) for every value replaced, in order.

    Null texts stay null with nothing replaced; empty texts, repeated rows and
    null doc_ids are kept as they are; other columns are not read; an empty
    table gives no rows.
    """
    return _replace(docs.select("doc_id", "text"), key).select("doc_id", "text", "replaced")


def _replace(docs: DataFrame, key: str) -> DataFrame:
    """All columns of ``docs`` with the new text, and ``replaced``."""
    names = [c for c in docs.columns if c != "text"]
    # Every form has a digit or an @; the dear pattern runs only where it can match.
    sign, digit = F.contains(F.col("text"), F.lit("@")), F.col("text").rlike("[0-9]")
    found = docs.select(*names, "text", sign.alias("__sign"), F.when(
        sign, F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))).when(
        digit, F.regexp_extract_all("text", F.lit(WITHOUT_EMAIL), F.lit(0))).otherwise(
        F.array().cast("array<string>")).alias("__found"))
    some = F.size("__found") > 0
    # Without findings nothing else is worked out.
    made = found.select(*names, "text", "__sign", "__found", F.when(some, F.transform(
        "__found", lambda m: pseudonym(m, key))).alias("__made"))
    between = F.when(F.col("__sign"), F.split("text", PATTERN, -1)).otherwise(
        F.split("text", WITHOUT_EMAIL, -1))
    text = F.when(some, F.array_join(F.transform(between, lambda part, i: F.concat(
        part, F.coalesce(F.get("__made", i), F.get("__found", i), F.lit("")))), "")).otherwise(F.col("text"))
    pairs = F.filter(F.transform("__made", lambda m, i: F.struct(
        kind_of(F.get("__found", i)).alias("kind"), m.alias("pseudonym"))), lambda p: p.pseudonym.isNotNull())
    empty = F.array().cast("array<struct<kind:string,pseudonym:string>>")
    return made.select(*names, text.alias("text"), F.coalesce(pairs, empty).alias("replaced"))


def pseudonym_report(docs: DataFrame, key: str = KEY) -> DataFrame:
    """doc_id, text and the number of values replaced, by kind."""
    rows = pseudonymised(docs, key)

    def count(kind: str) -> Column:
        return F.size(F.filter("replaced", lambda r: r.kind == kind)).cast("long").alias(f"n_{kind}")

    return rows.select("doc_id", "text", *map(count, KINDS))


def pseudonymised_documents(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with all its columns, whatever their names, the new text, and
    n_chars to match.

    Null texts stay null with the n_chars they have; empty texts, repeated rows
    and null doc_ids are kept as they are; an empty table gives no rows.
    """
    given, docs = docs.columns, protected(docs)
    rows = _replace(docs.withColumnsRenamed({"replaced": "__replaced"}), key).drop("replaced")
    rows = rows.withColumnsRenamed({"__replaced": "replaced"})
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        rows = rows.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                               .otherwise(F.char_length("text").cast(kind)))
    return rows.select(*docs.columns).toDF(*given)
