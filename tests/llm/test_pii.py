import hashlib
import re

from copse.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    odd = [int(c) for c in d[::-1]]
    return sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(odd)) % 10 == 0


def valid(kind, s):
    d = re.sub("[^0-9]", "", s)
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "card":
        return 13 <= len(d) <= 19 and luhn(d)
    return 9 <= len(d) <= 15 if kind == "phone" else True


def brute(text):
    return {k: [(m.start(), m.end()) for m in re.finditer(p, text or "") if valid(k, m[0])] for k, p in PLAIN.items()}


TEXTS = [
    None, "", "no data", "a@b.c", "a@b.c_d@e.f", "a@@b.c x@y", "a@b@c.d.e-f.", ".%+-@-.-", "é a.b+c@x.y.z ü q@r.s",
    "ip 1.2.3.4 and 1.2.3.4.5.6.7.8 and 256.1.1.1, 0001.002.03.255 1.2.3", "😀 10.0.0.1 😀 10.0.0.2",
    "4111 1111 1111 1111 and 4111-1111-1111-1112", "visa 4111111111111111x 12 3 4", "5500 0000 0000 0004 5500000000000004",
    "call +1 (702) 555-0742 or +49-30-1234567-", "+1", "+1 2", "++4915112345678.", "+1 (2", "+123456789012345678",
    "card+4111111111111111", "a" * 50_000, "a@" + "b." * 40_000, "1" * 60_000, "1." * 30_000, "+1" + "(" * 40_000,
    "x@y.z " * 700 + "end 8.8.8.8", "1.1.1.1\n" * 300, "\t\x00\x01 a@b.cc \x02",
    "iban DE89 3704 0044 0532 0130 00 or DE88 3704 0044 0532 0130 00", "GB82WEST12345698765432",
    "ssn 123-45-6789 here", "order 123-45-6789 here", "000-12-3456 social security",
    'token = "254ca002228af484f240146ffd26ba4415598ee8" x', "commit 254ca002228af484f240146ffd26ba4415598ee8",
]
SCHEMA = "doc_id long, text string, email int, start int"


def rows():
    return [(i if i != 5 else None, t, 1, 2) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], 1, 2)]


def test_base_kinds_equal_the_plain_patterns(spark):
    found = pii.find(spark.createDataFrame(rows(), SCHEMA)).collect()
    assert len(found) == len(TEXTS) + 1
    by = {r.doc_id: r for r in found}
    for i, t in enumerate(TEXTS):
        r, want = by[i if i != 5 else None], brute(t)
        for k in PLAIN:
            assert [(s.start, s.end) for s in r[k]] == want[k], (t[:60], k)


def test_added_kinds_need_checksum_or_context(spark):
    by = {r.doc_id: r for r in pii.find(spark.createDataFrame(rows(), SCHEMA)).collect()}
    spans = lambda t, k: [t[s.start:s.end] for s in by[TEXTS.index(t)][k]]
    t = TEXTS[-8]
    assert [spans(x, "iban") for x in TEXTS if x and x.startswith(("iban", "GB"))] == [
        ["DE89 3704 0044 0532 0130 00"], ["GB82WEST12345698765432"]], t
    assert spans("ssn 123-45-6789 here", "national_id") == ["123-45-6789"]
    assert spans("order 123-45-6789 here", "national_id") == []
    assert spans(TEXTS[-2], "secret") and not spans(TEXTS[-1], "secret")


def test_listing_and_digest(spark):
    d = pii.find(spark.createDataFrame([(1, "x 8.8.8.8 é a@b.c")], "doc_id long, text string"))
    s = d.select(pii.listed(*pii.BASE).alias("s")).first().s
    assert s == "email:12:17,ip:2:9"
    assert hashlib.sha256(s.encode()).hexdigest()


def test_redaction(spark):
    texts = {"mail a@b.c, ip 1.2.3.4!": "mail [email], ip [ip]!", "nothing": "nothing", "": "",
             "card+4111111111111111 é": "card[phone] é" if len("4111111111111111") <= 15 else "card+[card] é",
             "+4915112345678 and ü a@b.c": "[phone] and ü [email]"}
    d = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate([*texts, None])], SCHEMA)
    out = pii.redact(d)
    assert out.columns == d.columns
    assert [r.text for r in out.orderBy("doc_id").collect()] == [*texts.values(), None]


def test_empty_table_and_no_python(spark):
    d = pii.find(spark.createDataFrame([], SCHEMA))
    assert d.count() == 0
    assert "Python" not in d._jdf.queryExecution().toString()
