"""Format-preserving pseudonyms for personal numbers, dates and addresses.

Each value found is replaced by another one of its own format, by a keyed
Feistel permutation: equal values get equal pseudonyms in all documents, and
different values different ones.  Only column expressions; nothing is shuffled.

================  ==========================  =======================================
kind              validated by                permuted
================  ==========================  =======================================
card              13 to 19 digits, grouped    all but the first and last digit; the last keeps its
                  as cards are                distance from the Luhn digit, so valid numbers stay
                                              valid and others do not become so
ssn               area, group, serial ranges  within the same ranges
phone             10 digits, grouped or       the 10 digits
                  after a country code
ip                four octets up to 255       the 32 bits
iban              mod 97 is 1, in one piece   letters and digits of the account part, each within
                  or in groups of four        its class; check digits anew
date              a day from 1900 to 2099;    within the days up to the twelfth or the later ones,
                  year first, day first, or   in the same notation
                  month first if only that
                  makes a date
email             shape of an address         letters and digits of the name, each within its class
================  ==========================  =======================================

What has the shape but is not valid (an octet of 300, a 31st of June) is left.
The Feistel rounds add a keyed hash of one half to the other half, modulo the
size of that half, in turn; no cycle walking is needed as each domain is a product.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

ROUNDS = 8
TEXT_ROUNDS = 4
KEY_CONF = "quire.pii.key"

_DAY = "(?:3[01]|[12][0-9]|0?[1-9])"
_MONTH = "(?:1[0-2]|0?[1-9])"
_YEAR = "(?:19|20)[0-9]{2}"
# Characters of an IBAN by country, as registered; groups of four end with it, and what follows is not taken for a group.
_IBAN_CHARS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}
_GROUPED_IBAN = "|".join(
    f"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?: [A-Z0-9]{{4}}){{{n // 4 - 1}}}" + (f" [A-Z0-9]{{{n % 4}}}" if n % 4 else "")
    for n, countries in _IBAN_CHARS.items()
)
SHAPES = {
    "email": "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\\.[A-Za-z0-9-]+)*\\.[A-Za-z]{2,}",
    "iban": f"[A-Z]{{2}}[0-9]{{2}}[A-Z0-9]{{11,30}}|{_GROUPED_IBAN}",
    "date": "|".join(f"{_YEAR}{m}{_MONTH}{m}{_DAY}|{_DAY}{m}{_DAY}{m}{_YEAR}" for m in ("-", "/", "\\.")),
    "ssn": "[0-9]{3}-[0-9]{2}-[0-9]{4}",
    # Like the other numbers it stands free of letters, and so does the dotted number it may begin.
    "ip": "[0-9]{1,3}\\.[0-9]{1,3}\\.[0-9]{1,3}\\.[0-9]{1,3}(?!(?:\\.[0-9]+)+[A-Za-z])",
    "phone": "(?:\\+?[0-9]{1,3}[ .-]?)?\\([0-9]{3}\\)[ .-]?[0-9]{3}[ .-]?[0-9]{4}|\\+[0-9]{1,3}[ .-]?[0-9]{3}[ .-]?[0-9]{3}[ .-]?[0-9]{4}|(?:[0-9]{1,3}[ .-])?[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}",
    "card": "[0-9]{4}(?:[ -][0-9]{4}){2,3}(?:[ -][0-9]{1,3})?|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}|[0-9]{13,19}",
}
KINDS = tuple(SHAPES)
# An address may touch any mark; numbers stand free of letters and digits.
ANY = f"{SHAPES['email']}|(?<![A-Za-z0-9])(?:" + "|".join(SHAPES[k] for k in KINDS if k != "email") + ")(?![A-Za-z0-9])"
# In every match of ANY: two digits together, an address of single digits, or an e-mail address.
GATE = "[0-9]{2}|[0-9]\\.[0-9]|@"

_FIRST_DAY = "1900-01-01"  # to 2099-12-31: 200 years of 12 * 12 days up to the twelfth, and 44,249 later ones
_EARLY, _LATE = (200, 144), (150, 295)  # the pairs of _LATE are one more than the later days


def _hash(key: str, kind: str, n: Column, i: Column, x: Column) -> Column:
    """60 keyed bits as a bigint."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), n.cast("string"), i.cast("string"), x.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def _permute(left: Column, right: Column, left_size: Column, right_size: Column, key: str, kind: str) -> Column:
    """``struct<l, r>``: Feistel permutation of the pairs below ``(left_size, right_size)``."""
    n = F.concat_ws("x", left_size.cast("string"), right_size.cast("string"))
    start = F.struct(left.cast("bigint").alias("l"), right.cast("bigint").alias("r"))

    def step(s, i):
        odd = i % 2 == 1
        l_new = F.when(odd, F.pmod(s["l"] + F.pmod(_hash(key, kind, n, i, s["r"]), left_size), left_size)).otherwise(s["l"])
        r_new = F.when(odd, s["r"]).otherwise(F.pmod(s["r"] + F.pmod(_hash(key, kind, n, i, s["l"]), right_size), right_size))
        return F.struct(l_new.cast("bigint").alias("l"), r_new.cast("bigint").alias("r"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _ten(n: Column) -> Column:
    return F.pow(F.lit(10.0), n).cast("bigint")


def _permute_digits(digits: Column, key: str, kind: str) -> Column:
    """A digit string of up to 36 digits to another of the same length."""
    a = F.floor(F.char_length(digits) / 2).cast("int")
    b = F.char_length(digits) - a
    left = F.coalesce(F.nullif(F.left(digits, a), F.lit("")), F.lit("0")).cast("bigint")
    moved = _permute(left, F.right(digits, b).cast("bigint"), _ten(a), _ten(b), key, kind)
    return _let(moved, lambda m: F.concat(F.when(a > 0, F.lpad(m["l"].cast("string"), a, F.lit("0"))).otherwise(F.lit("")), F.lpad(m["r"].cast("string"), b, F.lit("0"))))


def _luhn_digit(payload: Column) -> Column:
    """The check digit that belongs after ``payload``."""
    ds = F.reverse(F.split(payload, ""))
    total = F.aggregate(
        F.transform(ds, lambda d, i: F.when(i % 2 == 0, F.get(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), d.cast("int"))).otherwise(d.cast("int"))),
        F.lit(0), lambda s, x: s + x,
    )
    return F.pmod(-total, F.lit(10))


def _refill(shape: Column, digits: Column) -> Column:
    """The digits of ``shape`` replaced in order by ``digits``; everything else stays."""
    start = F.struct(F.lit(0).alias("used"), F.lit("").alias("out"))

    def step(s, c):
        is_digit = c.rlike("[0-9]")
        return F.struct(
            (s["used"] + F.when(is_digit, 1).otherwise(0)).alias("used"),
            F.concat(s["out"], F.when(is_digit, F.substring(digits, s["used"] + 1, F.lit(1))).otherwise(c)).alias("out"),
        )

    return F.aggregate(F.split(shape, ""), start, step, lambda s: s["out"])


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def _card(v: Column, key: str) -> Column:
    def moved(d):
        n = F.char_length(d)
        payload = F.left(d, n - 1)
        off = F.pmod(F.right(d, F.lit(1)).cast("int") - _luhn_digit(payload), F.lit(10))
        new = F.concat(F.left(d, F.lit(1)), _permute_digits(F.substring(d, F.lit(2), n - 2), key, "card"))
        return _let(new, lambda p: F.concat(p, F.pmod(_luhn_digit(p) + off, F.lit(10)).cast("string")))

    return _let(_digits(v), lambda d: _refill(v, moved(d)))


def _ssn(v: Column, key: str) -> Column:
    area, group, serial = (F.substring(v, a, n).cast("int") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    place = F.when(area < 666, area - 1).otherwise(area - 2)
    moved = _permute(place * 99 + group - 1, serial - 1, F.lit(898 * 99), F.lit(9999), key, "ssn")

    def told(m):
        p = F.floor(m["l"] / 99).cast("int")
        a = F.when(p < 665, p + 1).otherwise(p + 2)
        return F.concat_ws("-", F.lpad(a.cast("string"), 3, "0"), F.lpad((m["l"] % 99 + 1).cast("string"), 2, "0"), F.lpad((m["r"] + 1).cast("string"), 4, "0"))

    return F.when(valid, _let(moved, told)).otherwise(v)


def _phone(v: Column, key: str) -> Column:
    def told(d):
        country = F.left(d, F.char_length(d) - 10)
        return _refill(v, F.concat(country, _permute_digits(F.right(d, F.lit(10)), key, "phone")))

    return _let(_digits(v), told)


def _ip(v: Column, key: str) -> Column:
    def told(o):
        octets = [F.get(o, F.lit(k)).cast("int") for k in range(4)]
        valid = ~v.rlike("(^|\\.)0[0-9]")
        for x in octets:
            valid = valid & (x <= 255)
        moved = _permute(octets[0] * 256 + octets[1], octets[2] * 256 + octets[3], F.lit(65536), F.lit(65536), key, "ip")
        new = _let(moved, lambda m: F.concat_ws(".", *[x.cast("string") for h in ("l", "r") for x in (F.floor(m[h] / 256), m[h] % 256)]))
        return F.when(valid, new).otherwise(v)

    return _let(F.split(v, "\\."), told)


def _shift(string: Column, stream: Column) -> Column:
    """Letters and digits moved on within their class by the bytes of a hexadecimal ``stream``."""
    def move(c, i):
        by = F.conv(F.substring(stream, F.pmod(i, F.lit(32)) * 2 + 1, F.lit(2)), 16, 10).cast("int")
        out = c
        for pattern, base, size in (("[a-z]", 97, 26), ("[A-Z]", 65, 26), ("[0-9]", 48, 10)):
            out = F.when(c.rlike(pattern), F.char(F.pmod(F.ascii(c) - base + by, F.lit(size)) + base)).otherwise(out)
        return out

    return F.when(string == "", string).otherwise(F.array_join(F.transform(F.split(string, ""), move), ""))


def _permute_text(v: Column, key: str, kind: str) -> Column:
    """Feistel over the two halves of a string; every character keeps its class."""
    a = F.floor(F.char_length(v) / 2).cast("int")
    start = F.struct(F.left(v, a).alias("l"), F.right(v, F.char_length(v) - a).alias("r"))

    def step(s, i):
        def stream(other):
            return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), F.char_length(v).cast("string"), i.cast("string"), other), 256)

        odd = i % 2 == 1
        return F.struct(F.when(odd, _shift(s["l"], stream(s["r"]))).otherwise(s["l"]).alias("l"), F.when(odd, s["r"]).otherwise(_shift(s["r"], stream(s["l"]))).alias("r"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(TEXT_ROUNDS)), start, step, lambda s: F.concat(s["l"], s["r"]))


def _mod97(string: Column) -> Column:
    def add(r, c):
        return F.when(c.rlike("[0-9]"), F.pmod(r * 10 + F.ascii(c) - 48, F.lit(97))).otherwise(F.pmod(r * 100 + F.ascii(c) - 55, F.lit(97)))

    return F.aggregate(F.split(string, ""), F.lit(0), add)


def _iban(v: Column, key: str) -> Column:
    def told(c):
        rest = F.substring(c, F.lit(5), F.char_length(c))
        country = F.left(c, F.lit(2))
        valid = _mod97(F.concat(rest, F.left(c, F.lit(4)))) == 1

        def named(p):
            check = 98 - _mod97(F.concat(p, country, F.lit("00")))
            new = F.concat(country, F.lpad(check.cast("string"), 2, "0"), p)
            return F.when(F.contains(v, F.lit(" ")), F.regexp_replace(new, "(.{4})(?!$)", "$1 ")).otherwise(new)

        return F.when(valid, _let(_permute_text(rest, key, "iban"), named)).otherwise(v)

    return _let(F.replace(v, F.lit(" ")), told)


def _permute_date(day: Column, key: str) -> Column:
    """A day to another one; days up to the twelfth and later ones each stay among themselves,
    so that in any notation the day stays as easy or hard to tell from the month."""
    first = F.lit(_FIRST_DAY).cast("date")
    months = (F.year(day) - 1900) * 12 + F.month(day) - 1
    early = _let(
        _permute(F.year(day) - 1900, (F.month(day) - 1) * 12 + F.dayofmonth(day) - 1, *map(F.lit, _EARLY), key, "date"),
        lambda m: F.make_date((m["l"] + 1900).cast("int"), (F.floor(m["r"] / 12) + 1).cast("int"), (m["r"] % 12 + 1).cast("int")),
    )

    def once(n):
        return _let(_permute(F.floor(n / _LATE[1]), n % _LATE[1], *map(F.lit, _LATE), key, "date-late"), lambda m: m["l"] * _LATE[1] + m["r"])

    last = _LATE[0] * _LATE[1] - 1

    def later(n):
        # The month: 16 to 19 later days each, so a month's place is its number times their mean, or next to it.
        near = F.floor(n * 2400 / last).cast("int")
        starts = F.transform(F.sequence(near - 2, near + 2), lambda k: F.struct(F.add_months(first, k).alias("day"), (F.datediff(F.add_months(first, k), first) - 12 * k).alias("n")))
        return _let(F.element_at(F.filter(starts, lambda s: s["n"] <= n), -1), lambda s: F.date_add(s["day"], (n - s["n"] + 12).cast("int")))

    # The one pair too many is passed over: what meets it goes one step on.
    moved = _let(once((F.datediff(day, first) - 12 * (months + 1)).cast("bigint")), lambda n: F.when(n == last, once(n)).otherwise(n))
    return F.when(F.dayofmonth(day) <= 12, early).otherwise(_let(moved, later))


def _date(v: Column, key: str) -> Column:
    mark = F.regexp_extract(v, "[-/.]", 0)
    fields = F.split(v, "[-/.]")

    def told(f):
        a, b, c = (F.get(f, F.lit(k)) for k in range(3))
        ymd = F.char_length(a) == 4
        # Day before month, unless only month before day makes a date.
        mdy = ~ymd & (b.cast("int") > 12)
        y, m, d = F.when(ymd, a).otherwise(c), F.when(ymd | ~mdy, b).otherwise(a), F.when(ymd, c).when(mdy, b).otherwise(a)
        day = F.try_to_date(F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd")
        short = F.when(ymd, F.concat_ws(" ", b, c)).otherwise(F.concat_ws(" ", a, b))
        full = (F.char_length(short) == 5) | short.rlike("^0| 0")

        def shown(t):
            yy, mm, dd = (F.date_format(t, p) for p in ("yyyy", "MM", "dd"))
            mm, dd = (F.when(full, x).otherwise(x.cast("int").cast("string")) for x in (mm, dd))
            return F.when(ymd, F.concat(yy, mark, mm, mark, dd)).when(mdy, F.concat(mm, mark, dd, mark, yy)).otherwise(F.concat(dd, mark, mm, mark, yy))

        return F.when(day.isNotNull(), _let(_permute_date(day, key), shown)).otherwise(v)

    return _let(fields, told)


def _email(v: Column, key: str) -> Column:
    name = F.substring_index(v, "@", 1)
    return F.concat(_permute_text(name, key, "email"), F.substring(v, F.char_length(name) + 1, F.char_length(v)))


_MOVES = {"email": _email, "iban": _iban, "date": _date, "ssn": _ssn, "ip": _ip, "phone": _phone, "card": _card}


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of one found value; a value of no kind, or invalid in its kind, is returned as it is."""
    out = value
    for kind in reversed(KINDS):
        out = F.when(value.rlike(f"^(?:{SHAPES[kind]})$"), _MOVES[kind](value, key)).otherwise(out)
    return out


def replace(text: str, key: str) -> Column:
    """``array<struct<piece, old, new>>`` of a text cut at the values found; the last one has no value."""
    col = F.col(text)
    hits = F.regexp_extract_all(col, F.lit(ANY), F.lit(0))
    steps = F.arrays_zip(F.split(col, ANY, -1).alias("piece"), hits.alias("old"))
    found = F.transform(steps, lambda x: F.struct(x["piece"].alias("piece"), x["old"].alias("old"), F.when(x["old"].isNotNull(), pseudonym(x["old"], key)).alias("new")))
    none = F.array(F.struct(col.alias("piece"), F.lit(None).cast("string").alias("old"), F.lit(None).cast("string").alias("new")))
    # Most texts have nothing to replace: two quick looks before the work.
    return F.when(col.rlike(GATE) & col.rlike(ANY), found).otherwise(none)


def pseudonymise(docs: DataFrame, key: str | None = None) -> DataFrame:
    """``(doc_id, text, n_replaced, n_<kind>..., n_left, text_sha256)``, one row per row of ``docs``.

    ``n_left`` counts values of a known shape that are not valid and were left
    (or that their pseudonym happens to equal).  The key is ``key``, or the
    session setting ``quire.pii.key``; without either this raises, as whoever
    knows the key can undo the pseudonyms.  It is a literal of the plan: plans
    and event logs of the job have to be kept like the key.  A null text counts as empty.  Repeated
    rows are treated alike; other columns are not read; an empty table gives
    an empty result.
    """
    key = key if key is not None else docs.sparkSession.conf.get(KEY_CONF, None)
    if not key:
        raise ValueError(f"pseudonyms need a secret key: pass one or set {KEY_CONF}")
    d = docs.select("doc_id", text_or_empty().alias("text")).withColumn("parts", replace("text", key))

    def n(kind):
        return F.size(F.filter("parts", lambda p: (p["old"] != p["new"]) & p["old"].rlike(f"^(?:{SHAPES[kind]})$"))).cast("bigint")

    out = d.select(
        "doc_id",
        F.when(F.size("parts") == 1, F.get("parts", F.lit(0))["piece"]).otherwise(
            F.array_join(F.transform("parts", lambda p: F.concat(F.coalesce(p["piece"], F.lit("")), F.coalesce(p["new"], F.lit("")))), "")
        ).alias("text"),
        F.size(F.filter("parts", lambda p: p["old"] != p["new"])).cast("bigint").alias("n_replaced"),
        *[n(k).alias(f"n_{k}") for k in KINDS],
        F.size(F.filter("parts", lambda p: p["old"] == p["new"])).cast("bigint").alias("n_left"),
    )
    return out.withColumn("text_sha256", F.sha2("text", 256))
