"""The replaced spans, kinds and forms against a plain scan in Python."""

import datetime
import random

import pytest
import regex

from spanwright.llm import pseudonyms as ps

KIND = "doc_id long, text string"


def translated(pattern):
    """A pattern of Java's as one of the regex module: digits of ASCII only."""
    return regex.compile(pattern.replace(r"L}\d]", "L}0-9]").replace(r"\d", "[0-9]"))


def luhn(s):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(s))) % 10 == 0


def real_day(y, m, d):
    try:
        return datetime.date(1900, 1, 1) <= datetime.date(int(y), int(m), int(d)) < datetime.date(2100, 2, 1)
    except ValueError:
        return False


def assignable(ten):
    return all(c[0] in "23456789" and c[1:] != "11" for c in (ten[:3], ten[3:6]))


def kind(value):
    digits = regex.sub("[^0-9]", "", value)
    if "@" in value:
        return "email" if any(len(p) > 1 and p[:2].isascii() and p[:2].isalpha() for p in value.split("@")[1].split(".")[1:]) else None
    if regex.fullmatch(r"[0-9]{4}([/-])[0-9]{1,2}\1[0-9]{1,2}", value) or regex.fullmatch(r"[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{4}", value):
        a, b, c = regex.split("[./-]", value)
        days = [(a, b, c)] if len(a) == 4 else [(c, b, a), (c, a, b)]
        return "date" if any(real_day(*d) for d in days) else None
    if regex.fullmatch(r"[0-9]{1,3}(\.[0-9]{1,3}){3}", value):
        return "ip" if all(int(p) < 256 for p in value.split(".")) else None
    if regex.fullmatch("[0-9]{3}-[0-9]{2}-[0-9]{4}", value):
        a, b, c = value.split("-")
        return "ssn" if a not in ("000", "666") and a < "900" and b != "00" and c != "0000" else None
    if translated(f"^(?:{ps.CARD})$").match(value):
        return "card" if luhn(digits) else None
    if translated(f"^(?:{ps.PHONE})$").match(value):
        return "phone"
    if translated(f"^(?:{ps.BARE})$").match(value) or value.startswith("+1") and len(digits) == 11:
        return "phone" if assignable(digits[-10:]) else None
    code = regex.match(f"(?:{ps.COUNTRIES})", digits)
    national = digits[code.end() :] if code else ""
    bare = national.lstrip("0")
    good = code and not value.startswith("+1") and 8 <= len(digits) <= 15 and len(bare) >= 4 and len(national) - len(bare) <= 2
    return "phone" if value[0] == "+" and good else None


PIECES = [
    "a.b", "@", "mail.example.com", "x@y.org", " ", " ", ".", ",", "-", "/", "2024-02-29", "2024-02-30", "1999/12/31", "31.12.1999", "12/31/1999", "3/5/1999", "T10:00:00Z", "1.2.3.4", "010.001.000.001", "256.1.1.1",
    "4111 1111 1111 1111", "4111111111111111", "4111111111111112", "3782 822463 10005", "(640) 555-0953", "640-555-0953", "017 555 7713", "000 000 0000", "6405550953", "16405550953", "+1", "+44", "+442079460958", "+44 20 7946 0958",
    "+44 (0)20 7946 0958", "+999123456", "123-45-6789", "000-45-6789", "version ", "v", "server ", "0", "7", "12", "345", "é", "word", "\n",
]


def spans(text):
    """What stays and the replaced matches, as the plain scan finds them."""
    out, at = [], 0
    for m in translated(ps.PATTERN).finditer(text):
        if k := kind(m[0]):
            out += [text[at : m.start()], (k, m[0])]
            at = m.end()
    return [*out, text[at:]]


def check(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), KIND).repartition(4)
    got = {x.doc_id: x for x in ps.pseudonymised(frame, "key", counts=True).collect()}
    known = {}
    for i, t in enumerate(texts):
        parts, rest = spans(t), got[i].text
        for name in ps.KINDS:
            assert got[i][f"n_{name}"] == sum(isinstance(p, tuple) and p[0] == name for p in parts), (name, t, rest)
        # Read the new text by the same plain parts; every value has one pseudonym.
        form = "".join(regex.escape(p) if isinstance(p, str) else "(.+?)" for p in parts)
        found = regex.fullmatch(form, rest, regex.DOTALL)
        assert found, (t, rest)
        if "(.+?)(.+?)" in form:
            continue
        for (k, old), new in zip((p for p in parts if isinstance(p, tuple)), found.groups()):
            if t.count(old) == 1 and len(parts) == 3:
                assert known.setdefault(old, new) == new
                assert kind(new) == k and (k == "email" or len(new) >= len(old) - 3), (old, new)


def test_replaced_spans_equal_a_scan(spark):
    r = random.Random(8)
    texts = ["".join(r.choice(PIECES) for _ in range(r.randint(0, 9))) for _ in range(1500)] + [f"x {p} y" for p in PIECES] * 2
    check(spark, texts)


@pytest.mark.parametrize(("text", "n"), [
    ("2024-02-29T10:00:00Z", 1), ("+442079460958", 1), ("+44 20 7946 0958", 1), ("call 6405550953", 1), ("id 1234567890", 0), ("010.001.000.001", 1), ("version 1.2.3.4", 0), ("v 1.2.3.4", 0),
    ("server 1.2.3.4", 1), ("zu ver 42.24.84.20", 1), ("build 1.22.33.244", 1), ("Version: 10.20.30.40", 0), ("1.2.3.4.5", 0), ("+999123456", 0), ("a@b..com", 0), ("a@b.com.", 1),
])
def test_forms(spark, text, n):
    row = ps.pseudonymised(spark.createDataFrame([(1, text)], KIND), "key", counts=True).first()
    assert sum(row[f"n_{k}"] for k in ps.KINDS) == n and (row.text != text) == bool(n)
    if text.startswith("010"):
        assert all(len(p) == 3 and int(p) < 256 for p in row.text.split("."))
    if text.startswith("+44"):
        assert row.text.startswith("+44") and regex.sub("[0-9]", "d", row.text) == regex.sub("[0-9]", "d", text)


def test_phones_are_permuted_among_their_like(spark):
    codes = [(a, e) for a in (*range(196, 216), 310, 311, 312, 999) for e in (*range(0, 1000, 37), 211, 911, 200, 999)]
    texts = [f"{a:03}-{e:03}-{(a * e) % 10000:04}" for a, e in codes]
    got = [x.text for x in sorted(ps.pseudonymised(spark.createDataFrame(list(enumerate(texts)), KIND), "k").collect())]
    assert len(set(got)) == len(set(texts))
    for old, new in zip(texts, got):
        assert regex.fullmatch(r"[0-9]{3}-[0-9]{3}-[0-9]{4}", new)
        assert assignable(old.replace("-", "")) == assignable(new.replace("-", ""))


def test_long_texts_of_each_alphabet(spark):
    n = 1_000_000
    units = ["a@b.", "b.", "a@", "1.", "1-", "1 ", "12/", "+1", "(640) ", "9", "640-555-", "%+_", "2024-02-", "+44 20 ", "v "]
    texts = [("a@" + u * (n // len(u)) + "com") for u in units] + ["a@" + "b." * 4000 + "com", "x@y.org 1.2.3.4 " * 20_000]
    got = {x.doc_id: x for x in ps.pseudonymised(spark.createDataFrame(list(enumerate(texts)), KIND).repartition(8), "k", counts=True).collect()}
    assert len(got) == len(texts) and got[len(units)].n_email == 1 and got[len(units) + 1].n_ip == 20_000


def test_columns_of_any_name_and_empty_tables(spark):
    names = ["found", "new", "kinds", "__found", "a.b", "c1", "text", "n_ip", "p", "q"]
    frame = spark.createDataFrame([tuple("x@y.org" if n == "text" else i for i, n in enumerate(names))], names)
    row = ps.pseudonymised(frame, "k").first()
    assert row.__fields__ == names and row["found"] == 0 and row["a.b"] == 4 and row.text.endswith("@example.invalid") and row.n_ip == 7
    assert ps.pseudonymised(frame, "k", counts=True).first().n_ip == 0
    assert ps.pseudonymised(frame.limit(0), "k").count() == 0
    twice = spark.createDataFrame([(1, "x@y.org"), (1, "x@y.org"), (None, None)], KIND)
    got = sorted((str(x.doc_id), x.text) for x in ps.pseudonymised(twice, "k").collect())
    assert got[0] == got[1] and got[2] == ("None", None)
