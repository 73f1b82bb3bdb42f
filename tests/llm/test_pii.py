"""Pseudonyms: formats and validity are kept, equal values stay linked, different ones apart."""

import datetime
import re

import pytest

from quire.llm import pii as P

from ..conftest import SF001
from . import edge


def names(spark, values, key="k1"):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "doc_id long, text string")
    return [r["text"] for r in P.pseudonymise(df, key).orderBy("doc_id").collect()]


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (2 if k % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10


def mod97(iban):
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def test_cards_keep_their_luhn_rest_and_grouping(spark):
    values = [f"4{k * 7919:014d}" for k in range(60)]
    values = [v + str(k % 10) for k, v in enumerate(values)] + ["4111 1111 1111 1111", "4111-1111-1111-1111", "3782 822463 10005", "1234567890123"]
    out = names(spark, values)
    digits = [re.sub("[^0-9]", "", v) for v in out]
    for old, new, d in zip(values, out, digits, strict=True):
        assert re.sub("[0-9]", "9", old) == re.sub("[0-9]", "9", new) and new[0] == old[0]
        assert luhn(d) == luhn(re.sub("[^0-9]", "", old))
    assert digits[60] == digits[61]  # one number in two notations
    assert len(set(digits[:60])) == 60 and sum(a == b for a, b in zip(values, out, strict=True)) == 0


def test_each_kind_stays_in_its_domain(spark):
    ssn = [f"{a:03d}-{g:02d}-{s:04d}" for a, g, s in [(1, 1, 1), (665, 99, 9999), (667, 50, 5), (899, 1, 9999)]]
    ips = ["0.0.0.0", "255.255.255.255", "169.122.221.182"]
    dates = ["1900-01-01", "2099-12-31", "2020-02-29", "31/12/1999", "01.03.2001"]
    ibans = ["DE89370400440532013000", "GB82WEST12345698765432"]
    phones = ["+1 (017) 555-7713", "+49 123 456 7890"]
    out = names(spark, ssn + ips + dates + ibans + phones)
    for v in out[:4]:
        a, g, s = map(int, v.split("-"))
        assert 0 < a < 900 and a != 666 and g > 0 and s > 0 and len(v) == 11
    for v in out[4:7]:
        assert all(0 <= int(x) <= 255 and str(int(x)) == x for x in v.split("."))
    for old, v in zip(dates, out[7:12], strict=True):
        form = "%Y-%m-%d" if "-" in v else "%d/%m/%Y" if "/" in v else "%d.%m.%Y"
        assert 1900 <= datetime.datetime.strptime(v, form).year <= 2099 and len(v) == len(old)
    for old, v in zip(ibans, out[12:14], strict=True):
        assert mod97(v) == 1 and v[:2] == old[:2] and re.sub("[0-9]", "0", re.sub("[A-Z]", "A", v)) == re.sub("[0-9]", "0", re.sub("[A-Z]", "A", old))
    assert out[14].startswith("+1 (") and out[15].startswith("+49 ")
    assert len(set(out)) == len(out)


def test_permutations_are_one_to_one(spark):
    days = [(datetime.date(2000, 1, 1) + datetime.timedelta(k)).isoformat() for k in range(400)]
    assert len(set(names(spark, days))) == 400
    mails = [f"{a}{b}.{k}@x.org" for a in "abc" for b in "xyz" for k in range(20)]
    out = names(spark, mails)
    assert len(set(out)) == len(mails) and all(re.fullmatch(r"[a-z]{2}\.[0-9]{1,2}@x\.org", v) for v in out)


def test_invalid_values_and_other_text_stay(spark):
    same = ["000-12-3456 666-11-1111", "300.1.1.1", "30.02.2020", "DE00370400440532013000", "sha 04dbebab91ab85687d33", "x4111111111111111", "12 34 56", "1.2.3.4.5x"]
    assert names(spark, same) == same


def test_key_and_links(spark):
    text = ["call +1 (017) 555-7713 or mail ann.b@x.org now", "ann.b@x.org wrote from 10.1.2.3, +1 (017) 555-7713!"]
    a, b = names(spark, text, "k1"), names(spark, text, "k2")
    phone, mail = re.search(r"\+1 \([0-9]{3}\) [0-9-]+", a[0])[0], re.search(r"\S+@x\.org", a[0])[0]
    assert phone in a[1] and mail in a[1] and a != b and a == names(spark, text, "k1")
    assert a[0].startswith("call ") and a[0].endswith(" now")


def test_there_is_no_key_to_fall_back_to(spark):
    df = spark.createDataFrame([(1, "8.8.8.8")], "doc_id long, text string")
    for key in (None, ""):
        with pytest.raises(ValueError, match="key"):
            P.pseudonymise(df, key)
    spark.conf.set(P.KEY_CONF, "k1")
    try:
        assert P.pseudonymise(df).first()["text"] == names(spark, ["8.8.8.8"])[0]
    finally:
        spark.conf.unset(P.KEY_CONF)


def test_single_digit_addresses_are_replaced_wherever_they_stand(spark):
    for ip in ("8.8.8.8", "1.1.1.1", "0.0.0.0"):
        alone, beside = names(spark, [f"see {ip} now", f"see {ip} now 42"])
        assert alone != f"see {ip} now" and beside == alone + " 42"
    df = spark.createDataFrame([(1, "8.8.8.8"), (2, "300.1.1.1"), (3, "1.2.3.4.5x"), (4, "10.2.3.4.5x")], "doc_id long, text string")
    assert [(r["n_ip"], r["n_left"]) for r in P.pseudonymise(df, "k1").orderBy("doc_id").collect()] == [(1, 0), (0, 1), (0, 0), (0, 0)]


def test_one_value_in_several_notations_stays_one(spark):
    phones = ["+1 (743) 555-3824", "(743) 555-3824", "743-555-3824", "743.555.3824", "+17435553824", "+1-743-555-3824", "1-743-555-3824"]
    dates = ["2020-12-25", "2020/12/25", "25/12/2020", "12/25/2020", "25.12.2020", "25-12-2020", "12-25-2020"]
    early = ["2021-07-03", "03/07/2021", "3/7/2021", "2021/7/3", "3.7.2021"]
    ibans = ["DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "ES9121000418450200051332", "ES91 2100 0418 4502 0005 1332 PAID IN FULL"]
    values = phones + dates + early + ibans
    out = names(spark, [f"on {v} then" for v in values])
    for old, new in zip(values, out, strict=True):
        assert old not in new, old
    out = [v[3:-5] for v in out]
    for old, new in zip(phones, out, strict=False):
        assert re.sub("[0-9]", "9", old) == re.sub("[0-9]", "9", new)
    assert len({re.sub("[^0-9]", "", v)[-10:] for v in out[:7]}) == 1
    forms = ["%Y-%m-%d", "%Y/%m/%d", "%d/%m/%Y", "%m/%d/%Y", "%d.%m.%Y", "%d-%m-%Y", "%m-%d-%Y"] + ["%Y-%m-%d", "%d/%m/%Y", "%d/%m/%Y", "%Y/%m/%d", "%d.%m.%Y"]
    days = [datetime.datetime.strptime(v, f).date() for v, f in zip(out[7:19], forms, strict=True)]
    assert len(set(days[:7])) == len(set(days[7:])) == 1 and days[0].day > 12 >= days[7].day
    assert out[16] == f"{days[7].day}/{days[7].month}/{days[7].year}"
    assert out[20].replace(" ", "") == out[19] and mod97(out[19]) == 1 and re.fullmatch("DE[0-9]{2}(?: [0-9]{4}){4} [0-9]{2}", out[20])
    assert out[22].endswith(" PAID IN FULL") and out[22][:-13].replace(" ", "") == out[21] and mod97(out[21]) == 1


def test_all_days_are_permuted_one_to_one(spark):
    first = datetime.date(1900, 1, 1)
    days = [first + datetime.timedelta(k) for k in range(73049)]
    out = [datetime.date.fromisoformat(v) for v in names(spark, [d.isoformat() for d in days])]
    assert set(out) == set(days) and all((a.day > 12) == (b.day > 12) for a, b in zip(days, out, strict=True))


def test_the_gate_lets_every_shape_through():
    values = ["a@x.org", "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "1/2/2003", "2003-1-2", "123-45-6789", "1.2.3.4", "(743) 555-3824", "+17435553824", "1234567890123"]
    assert all(re.search(P.ANY, v) and re.search(P.GATE, v) for v in values)


def test_no_value_is_left_in_the_supplied_rows(spark):
    df = spark.read.parquet(f"{SF001}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in df.collect()}
    shapes = re.compile(r"[a-z]+\.[0-9]{2}@mail[0-9]+\.example\.com|\+1 \([0-9]{3}\) 555-[0-9]{4}|(?<![0-9A-Za-z])[0-9]{16}(?![0-9A-Za-z])")
    changed = 0
    for r in P.pseudonymise(df, "k1").collect():
        old = texts[r["doc_id"]]
        assert not [v for v in shapes.findall(old) if v in r["text"]]
        assert (r["text"] == old) == (r["n_replaced"] == 0) and len(r["text"]) >= len(old) - 12 * r["n_ip"]
        changed += r["n_replaced"] > 0
    assert changed > 3


def test_edge_rows(spark):
    out = P.pseudonymise(edge.table(spark), "k1").collect()
    assert len(out) == len(edge.ROWS)
    assert [r["text"] for r in out if r["doc_id"] == 2] == [""]
    assert [r["text"] for r in out if r["doc_id"] == 6] == [edge.LONG]
    assert P.pseudonymise(edge.empty(spark), "k1").count() == 0


@pytest.mark.parametrize("digits", ["5", "1234567890", "0" * 18])
def test_digit_strings_keep_their_length(spark, digits):
    from pyspark.sql import functions as F

    got = spark.createDataFrame([(digits,)], "d string").select(P._permute_digits(F.col("d"), "k", "x")).first()[0]
    assert len(got) == len(digits) and got.isdigit()
