"""Format-preserving pseudonyms for personal data (DataFrame functions only).

Every validated value is mapped by a keyed Feistel network to another value of
the same format, so equal values get equal pseudonyms in all documents and
different ones stay different:

* card numbers (Luhn digit right): issuer digit and length stay, the digits
  between are permuted and the check digit is computed anew
* North American phone numbers, in any of the usual spellings
* social security numbers of a valid area, group and serial
* IPv4 addresses
* calendar dates (ISO, day.month.year, month/day/year or day/month/year):
  permuted among the days of their century, so the result is a valid date
* e-mail addresses (at most 64 characters before the @, host labels of at most
  63, at most 128 of them): letters and digits before the @ are permuted in place

Separators and spelling stay. Numbers that fail their validation, and all
other text, are left as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10

CARD = r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])"
IP_PART = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IP = rf"(?<![0-9.])(?:{IP_PART}\.){{3}}{IP_PART}(?![0-9]|\.[0-9])"
# A run of address characters is tried once, from its start or from where the last
# match ended, and never given back, so long runs cost no more than their length.
EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]{1,64}+@"
         r"[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,126}\.[A-Za-z]{2,}")
PHONE = r"(?<![0-9])(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
DATE = (r"(?<![0-9./-])(?:[0-9]{4}([-/.])[0-9]{2}\1[0-9]{2}|[0-9]{1,2}([./])[0-9]{1,2}\2[0-9]{4})"
        r"(?![0-9]|[./-][0-9])")
ANY = "|".join([EMAIL, IP, DATE, SSN, PHONE, CARD])
#: Texts without any of these are not searched further.
HINT = r"[0-9]{4}|@|[0-9]\.[0-9]"
KINDS = ("email", "ip", "date", "ssn", "phone", "card")


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _whole(pattern: str, x: Column) -> Column:
    return x.rlike(f"^(?:{pattern})$")


def _long(x: Column) -> Column:
    return x.cast("bigint")


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a digit string, its last digit being the check digit."""
    n = F.length(digits)
    return F.aggregate(
        F.sequence(F.lit(1), n), F.lit(0),
        lambda s, i: s + F.when((n - i) % 2 == 0, F.substr(digits, i, F.lit(1)).cast("int")).otherwise(
            F.element_at(F.array(*[F.lit(v) for v in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]),
                         F.substr(digits, i, F.lit(1)).cast("int") + 1)))


def _prf(key: Column, *parts: Column) -> Column:
    """A keyed pseudo-random bigint in [0, 2**60)."""
    return F.conv(F.substr(F.sha2(F.concat_ws("|", key, *[p.cast("string") for p in parts]), 256),
                           F.lit(1), F.lit(15)), 16, 10).cast("bigint")


def feistel(value: Column, a: Column, b: Column, key: Column, tweak: Column, undo: bool = False) -> Column:
    """A keyed permutation of 0 .. a*b - 1: alternating rounds on the pair
    (value div b, value mod b). ``undo`` inverts it."""
    rounds = range(ROUNDS - 1, -1, -1) if undo else range(ROUNDS)
    sign = -1 if undo else 1
    start = F.struct(F.floor(value / b).cast("bigint").alias("l"), F.pmod(value, b).alias("r"))

    def step(acc, i):
        left, right = acc["l"], acc["r"]
        return F.when(i % 2 == 0, F.struct(F.pmod(left + sign * (_prf(key, tweak, i, right) % a), a).alias("l"), right.alias("r"))
                      ).otherwise(F.struct(left.alias("l"), F.pmod(right + sign * (_prf(key, tweak, i, left) % b), b).alias("r")))

    return F.aggregate(F.array(*[F.lit(i) for i in rounds]), start, step, lambda acc: acc["l"] * b + acc["r"])


def _shift_text(side: Column, other: Column, key: Column, i: Column) -> Column:
    """``side`` with each letter and digit moved within its class by an amount
    that depends on ``other`` and the round."""
    def move(c: Column, j: Column) -> Column:
        by = _prf(key, F.lit("text"), i, other, j)
        return (F.when(c.rlike("^[a-z]$"), F.char(F.pmod(F.ascii(c) - 97 + by % 26, F.lit(26)) + 97))
                .when(c.rlike("^[A-Z]$"), F.char(F.pmod(F.ascii(c) - 65 + by % 26, F.lit(26)) + 65))
                .when(c.rlike("^[0-9]$"), F.char(F.pmod(F.ascii(c) - 48 + by % 10, F.lit(10)) + 48)).otherwise(c))
    return F.array_join(F.transform(F.split(side, ""), move), "")


def _text_feistel(x: Column, key: Column) -> Column:
    """A keyed permutation of the strings with x's pattern of character classes."""
    half = F.floor(F.length(x) / 2).cast("int")
    start = F.struct(F.substr(x, F.lit(1), half).alias("l"), F.substr(x, half + 1, F.length(x)).alias("r"))

    def step(acc, i):
        left, right = acc["l"], acc["r"]
        return F.when(i % 2 == 0, F.struct(left.alias("l"), _shift_text(right, left, key, i).alias("r"))).otherwise(
            F.struct(_shift_text(left, right, key, i).alias("l"), right.alias("r")))

    return F.aggregate(F.array(*[F.lit(i) for i in range(ROUNDS)]), start, step, lambda acc: F.concat(acc["l"], acc["r"]))


def _fill(pattern: Column, digits: Column) -> Column:
    """``pattern`` with its digits replaced, in order, by those of ``digits``."""
    return F.array_join(F.transform(
        F.sequence(F.lit(1), F.length(pattern)),
        lambda i: F.when(F.substr(pattern, i, F.lit(1)).rlike("[0-9]"),
                         F.substr(digits, F.length(_digits(F.substr(pattern, F.lit(1), i))), F.lit(1)))
        .otherwise(F.substr(pattern, i, F.lit(1)))), "")


def _date_format(x: Column) -> Column:
    """The reading under which x is a valid date (years from 1000), else null."""
    def valid(fmt):
        return F.try_to_timestamp(x, F.lit(fmt)).isNotNull()
    year = F.regexp_extract(x, "[0-9]{4}", 0).cast("int")
    known = F.when(F.lit(False), F.lit(""))
    for fmt, shape in (("yyyy-MM-dd", r"^[0-9]{4}-"), ("yyyy/MM/dd", r"^[0-9]{4}/"), ("yyyy.MM.dd", r"^[0-9]{4}\."),
                       ("d.M.yyyy", r"^[0-9]{1,2}\."), ("M/d/yyyy", r"^[0-9]{1,2}/"), ("d/M/yyyy", r"^[0-9]{1,2}/")):
        known = known.when(x.rlike(shape) & (year >= 1000) & valid(fmt), F.lit(fmt))
    return known


def _read(m: Column) -> Column:
    """kind, value, a, b of a match; kind is null if it fails its validation."""
    none = F.lit(None).cast("bigint")

    def row(kind, value=none, a=none, b=none, fmt=None):
        return F.struct(m.alias("m"), F.lit(kind).alias("kind"), _long(value).alias("value"), _long(a).alias("a"),
                        _long(b).alias("b"), (F.lit(None).cast("string") if fmt is None else fmt).alias("fmt"))

    def num(x, start, n):
        return _long(F.substr(x, F.lit(start), F.lit(n)))

    d = _digits(m)
    # card: everything between the issuer digit and the check digit
    inner = F.length(d) - 2
    card = row("card", F.substr(d, F.lit(2), inner), F.pow(F.lit(10), F.floor(inner / 2)), F.pow(F.lit(10), F.ceil(inner / 2)))
    # phone: ten digits; area codes 2xx-9xx and 0xx-1xx are permuted among themselves
    ten = F.substr(d, F.length(d) - 9, F.lit(10))
    usual = F.substr(ten, F.lit(1), F.lit(1)).cast("int") >= 2
    phone = row("phone", _long(ten) - F.when(usual, F.lit(2_000_000_000)).otherwise(F.lit(0)),
                F.when(usual, F.lit(80_000)).otherwise(F.lit(20_000)), F.lit(100_000))
    area, group, serial = num(d, 1, 3), num(d, 4, 2), num(d, 6, 4)
    ssn = row("ssn", ((area - 1 - (area > 666).cast("int")) * 99 + group - 1) * 9999 + serial - 1, F.lit(898 * 99), F.lit(9999))
    part = F.split(m, r"\.")
    ip = row("ip", ((_long(part[0]) * 256 + _long(part[1])) * 256 + _long(part[2])) * 256 + _long(part[3]),
             F.lit(65536), F.lit(65536))
    fmt = _date_format(m)
    day = F.to_date(F.try_to_timestamp(m, fmt))
    first = F.make_date(F.floor(F.year(day) / 100).cast("int") * 100, F.lit(1), F.lit(1))
    leap = F.floor(F.year(day) / 100) % 4 == 0
    # 36525 = 75 * 487 days in a century whose first year is a leap year, else 36524 = 92 * 397
    date = row("date", F.datediff(day, first), F.when(leap, 75).otherwise(92), F.when(leap, 487).otherwise(397), fmt)
    return (F.when(m.contains("@"), row("email")).when(_whole(IP, m), ip)
            .when(_whole(DATE, m) & fmt.isNotNull(), date)
            .when(_whole(SSN, m) & ~area.isin(0, 666) & (area < 900) & (group > 0) & (serial > 0), ssn)
            .when(_whole(PHONE, m), phone)
            .when(_whole(CARD, m) & (luhn_sum(d) % 10 == 0), card)
            .otherwise(row(None)))


def _write(x: Column, permuted: Column, key: Column) -> Column:
    """The pseudonym of a match that ``_read`` has read."""
    m, kind, value = x["m"], x["kind"], permuted
    d = _digits(m)
    body = F.concat(F.substr(d, F.lit(1), F.lit(1)), F.lpad(value.cast("string"), F.length(d) - 2, "0"))
    check = F.pmod(10 - luhn_sum(F.concat(body, F.lit("0"))) % 10, F.lit(10))
    back = value + F.when(x["a"] == 80_000, F.lit(2_000_000_000)).otherwise(F.lit(0))
    phone = F.concat(F.substr(d, F.lit(1), F.length(d) - 10), F.lpad(back.cast("string"), 10, "0"))
    head = F.floor(value / 9999).cast("bigint")
    area = F.floor(head / 99).cast("bigint") + 1
    ssn = F.concat(F.lpad((area + (area >= 666).cast("int")).cast("string"), 3, "0"),
                   F.lpad((head % 99 + 1).cast("string"), 2, "0"), F.lpad((value % 9999 + 1).cast("string"), 4, "0"))
    ip = F.concat_ws(".", *[(F.shiftright(value, s) % 256).cast("string") for s in (24, 16, 8, 0)])
    day = F.to_date(F.try_to_timestamp(m, x["fmt"]))
    moved = F.date_add(F.make_date(F.floor(F.year(day) / 100).cast("int") * 100, F.lit(1), F.lit(1)), value.cast("int"))
    date = F.when(F.lit(False), F.lit(""))
    for fmt in ("yyyy-MM-dd", "yyyy/MM/dd", "yyyy.MM.dd"):
        date = date.when(x["fmt"] == fmt, F.date_format(moved, fmt))
    for fmt, two in (("d.M.yyyy", "dd.MM.yyyy"), ("M/d/yyyy", "MM/dd/yyyy"), ("d/M/yyyy", "dd/MM/yyyy")):
        date = date.when((x["fmt"] == fmt) & (F.length(m) == 10), F.date_format(moved, two))
        date = date.when(x["fmt"] == fmt, F.date_format(moved, fmt))
    at = F.instr(m, "@")
    email = F.concat(_text_feistel(F.substr(m, F.lit(1), at - 1), key), F.substr(m, at, F.length(m)))
    return (F.when(kind == "card", _fill(m, F.concat(body, check.cast("string"))))
            .when(kind == "phone", _fill(m, phone)).when(kind == "ssn", _fill(m, ssn)).when(kind == "ip", ip)
            .when(kind == "date", date).when(kind == "email", email).otherwise(m))


def _equals(kind: str):
    return lambda x: x == kind


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", counts: bool = True) -> DataFrame:
    """The rows of ``docs`` with personal data in ``text_col`` replaced, and
    (if ``counts``) a column ``n_<kind>`` for each of KINDS.

    A null text stays null with counts of 0, an empty one empty. All rows and
    all other columns stay; a column of ``docs`` named like a count is replaced.
    No shuffle: each text is rewritten where it is read. ``key`` is the secret
    of the permutation and must not be empty. Longer addresses than the mail
    format knows are no addresses. A day/month/year date that can't be read as
    month/day/year may meet the pseudonym of one that can; all other formats
    are mapped one to one."""
    if not key:
        raise ValueError("the pseudonyms need a key")
    secret = F.lit(key)
    text = F.col(text_col)
    plain = [c for c in docs.columns if not (counts and c in {f"n_{k}" for k in KINDS})]
    found = F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(f"(?:{ANY})"), F.lit(0))).otherwise(
        F.array().cast("array<string>"))
    work = docs.select(*plain, found.alias("__found"))
    work = work.select("*", F.transform("__found", _read).alias("__read"))
    # one network for all numeric kinds; kinds have different tweaks
    work = work.select("*", F.transform("__read", lambda x: F.struct(x.alias("x"), F.when(
        x["a"].isNotNull(), feistel(x["value"], x["a"], x["b"], secret, F.concat_ws(":", x["kind"], x["a"]))).alias("p"))).alias("__done"))
    work = work.select("*", F.transform("__done", lambda y: _write(y["x"], y["p"], secret)).alias("__new"))
    gaps = F.split(text, f"(?:{ANY})", -1)
    rebuilt = F.array_join(F.zip_with(gaps, F.col("__new"), lambda g, v: F.concat(g, F.coalesce(v, F.lit("")))), "")
    out = [F.when(F.size("__found") > 0, rebuilt).otherwise(text).alias(c) if c == text_col else F.col(c) for c in plain]
    if counts:
        kinds = F.transform("__read", lambda x: x["kind"])
        out += [F.size(F.filter(kinds, _equals(k))).alias(f"n_{k}") for k in KINDS]
    return work.select(*out)
