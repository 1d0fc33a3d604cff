import datetime
import random
import re

import pytest

from tessera.llm import op06_pii as P

KEY = b"test key"


@pytest.fixture(scope="module")
def names():
    return P.Pseudonyms(KEY)


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000])
def test_permutation_is_one_to_one(n):
    p = P.Permutation(KEY, "t", n)
    sealed = [p.seal(x) for x in range(n)]
    assert sorted(sealed) == list(range(n)) and [p.unseal(y) for y in sealed] == list(range(n))
    assert n == 1 or all(x != y for x, y in enumerate(sealed))
    even = P.Permutation(KEY, "t", n, lambda x: x % 2 == 0)
    assert sorted(even.seal(x) for x in range(0, n, 2)) == list(range(0, n, 2))


CASES = [
    ("4111 1111 1111 1111", "card"), ("4111111111111111", "card"), ("9807915762804491", "number"), ("123-45-6789", "ssn"),
    ("+1 (017) 555-7713", "phone"), ("(555) 123-4567", "phone"), ("97.51.17.173", "ip"), ("2020-02-29", "date"),
    ("31/12/1999", "date"), ("1.2.2003", "date"), ("GB82WEST12345698765432", "iban"), ("04dbebab91ab85687d33eeaaf9ac699e1188f962", "secret"),
]


@pytest.mark.parametrize("value,kind", CASES)
def test_format_and_validity_stay_and_the_key_inverts(names, value, kind):
    text = f"before {value} after, {value}."
    new, counts = P.pseudonymise(text, names)
    assert counts[kind] == 2 and sum(counts.values()) == 2 and value not in new
    a, b = re.fullmatch(r"before (.*) after, (.*)\.", new).groups()
    assert a == b and P.classify(P.FOUND.search(a)) == kind
    if kind not in ("ip", "date"):
        assert re.sub(r"\w", "x", a) == re.sub(r"\w", "x", value)
    assert P.pseudonymise(new, P.Pseudonyms(KEY, back=True))[0] == text


def test_dates_link_across_notations(names):
    new = P.pseudonymise("2020-03-04 and 04/03/2020", names)[0]
    y, m, d = map(int, new[:10].split("-"))
    assert new == f"{y}-{m:02d}-{d:02d} and {d:02d}/{m:02d}/{y}" and datetime.date(y, m, d)


@pytest.mark.parametrize("value,kind", [
    ("\u0661\u0662\u0663-\u0664\u0665-\u0666\u0667\u0668\u0669", "ssn"),
    ("".join(chr(0xFF10 + int(c)) for c in "4111111111111111"), "card"),
    ("".join(chr(0xFF10 + int(c)) for c in "9807915762804491"), "number"),
    ("+\u0661 (\u0662\u0660\u0662) \u0665\u0665\u0665-\u0660\u0661\u0662\u0663", "phone"),
    ("\u0967\u0967.2\u0968.33.4", "ip"), ("\uff12\uff10\uff12\uff10-\uff10\uff12-\uff12\uff19", "date"), ("4111-1111-1111-111\uff11", "card"),
])
def test_digits_of_all_scripts_are_sealed(names, value, kind):
    new, counts = P.pseudonymise(f"x {value} y", names)
    assert counts[kind] == 1 and value not in new
    plain = P.FOREIGN.sub(lambda m: str(P.unicodedata.decimal(m[0])), value)
    assert P.FOREIGN.sub(lambda m: str(P.unicodedata.decimal(m[0])), new) == P.pseudonymise(f"x {plain} y", names)[0]
    if kind == "ip":  # each part keeps the script of its first digit
        assert P.FOREIGN.sub("d", new)[2] == "d"
    else:
        assert P.pseudonymise(new, P.Pseudonyms(KEY, back=True))[0] == f"x {value} y"


def test_long_runs_take_linear_time(names):
    import time

    for run in ("x" * 1_000_000, "." * 1_000_000, "a." * 500_000, "9" * 1_000_000, "x@" * 300_000, "+1 " * 300_000, "A" * 1_000_000):
        began = time.process_time()
        P.pseudonymise(f"{run} a.b@c.org {run}@", names)
        assert time.process_time() - began < 20
    assert P.pseudonymise("..jo.e@x.org", names)[1]["email"] == 1


def test_phones_link_with_and_without_separators(names):
    new = P.pseudonymise("+12025550123 and +1 202 555 0123 and 202-555-0123", names)[0].split(" and ")
    assert new[0] == new[1].replace(" ", "") and new[0][:2] == "+1" and new[2].replace("-", "") == new[0][2:]


def test_against_an_independent_finder(spark, names):
    """Values cut out by splitting at white space and testing by plain string methods."""
    def ip(t):
        p = t.split(".")
        return len(p) == 4 and all(x.isascii() and x.isdigit() and str(int(x)) == x and int(x) < 256 for x in p)

    def ssn(t):
        p = t.split("-")
        return [len(x) for x in p] == [3, 2, 4] and all(x.isdigit() for x in p) and P.valid_ssn("".join(p))

    def mail(t):
        return t.count("@") == 1 and t[0].isalnum() and "." in t.split("@")[1]

    n = 0
    for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect():
        tokens = [t.strip(".,;:!?()[]\"'") for t in (r.text or "").split()]
        counts = P.pseudonymise(r.text or "", names)[1]
        for kind, test in (("ip", ip), ("ssn", ssn), ("email", mail)):
            want = sum(bool(t) and test(t) for t in tokens)
            n += want
            assert counts[kind] >= want, (r.doc_id, kind)
    assert n > 10


def test_other_text_stays(names):
    for text in ("version 1.2.3 of 2020, pi 3.14159, 999.1.1.1, 2020-13-45 000-12-3456", "no digits", "", "a@b c 12345678"):
        assert P.pseudonymise(text, names) == (text, dict.fromkeys(P.KINDS, 0))


def test_mail_and_distinct_values(names):
    new, counts = P.pseudonymise("x.34@mail7.example.com y", names)
    assert counts["email"] == 1 and re.fullmatch(r"[a-z]\.\d\d@mail7\.example\.com y", new)
    rng = random.Random(1)
    phones = {f"555-{rng.randrange(1000):03d}-{rng.randrange(10000):04d}" for _ in range(2000)}
    assert len({names.of("phone", p) for p in phones}) == len(phones)


def test_lines_change_nothing(names):
    text = "a 97.51.17.173\nx\n\n2020-02-29\nbcd\n4111111111111111"
    assert P.pseudonymise(text, names)[0] == "\n".join(P.pseudonymise(t, names)[0] for t in text.split("\n"))


def test_edges(spark, edge, nothing):
    rows = P.hide_personal_data(edge).collect()
    key = lambda x: str(x)
    assert sorted(((r.doc_id, r.text) for r in rows), key=key) == sorted(((r.doc_id, r.text) for r in edge.collect()), key=key)
    assert P.hide_personal_data(nothing).count() == 0
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    back = P.Pseudonyms(P.KEY, back=True)
    sealed = {r.doc_id: r.text for r in P.hide_personal_data(df).collect()}
    assert all(P.pseudonymise(sealed[r.doc_id], back)[0] == r.text for r in df.collect())
