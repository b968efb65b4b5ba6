import hashlib
import random
import re

from cases import EDGE
from pyspark.sql import functions as F

from retain.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    found = [("email", *m.span()) for m in EMAIL.finditer(text)]
    found += [("ip", *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    found += [("card", *m.span()) for m in CARD.finditer(text) if 14 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
    found += [("phone", *m.span()) for m in PHONE.finditer(text) if 10 <= len(digits(m)) <= 15]
    return sorted(found, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def test_base_spans_against_the_patterns():
    draw = random.Random(1)
    for _ in range(20_000):
        text = "".join(draw.choice("a1@.2- +()5.é9 0") for _ in range(draw.randint(0, 90)))
        assert [s for s in pii.find(text) if s[0] in pii.BASE_KINDS] == brute(text)


def test_long_numbers_and_runs():
    assert pii.find("1" * 10_000 + ".2.3.4") == []
    assert [s[0] for s in pii.find("0000001.002.3.255")] == ["ip"]
    assert pii.find("a" * 300_000 + "@" * 1000) == []


def test_links_and_accounts():
    text = "see mailto:jo@x.org, https://ann:pw@host.example/p and https://host.example/p; IBAN: GB82 WEST 1234 5698 7654 32. SSN 123-45-6789"
    assert [(k, text[a:b]) for k, a, b in pii.find(text) if k not in pii.BASE_KINDS] == [
        ("link", "mailto:jo@x.org"), ("link", "https://ann:pw@host.example"),
        ("account", "GB82 WEST 1234 5698 7654 32"), ("account", "123-45-6789"),
    ]
    assert pii.find("IBAN GB82 WEST 1234 5698 7654 33") == []
    assert pii.redact("mail jo@x.org now") == "mail [EMAIL] now"


def test_added_spans_in_any_case_and_of_any_length():
    def added(text):
        return [(k, text[a:b]) for k, a, b in pii.find(text) if k not in pii.BASE_KINDS]

    assert added("IBAN: DE89 3704 0044 0532 0130 00 BIC COBADEFFXXX") == [("account", "DE89 3704 0044 0532 0130 00")]
    assert added("Iban DE89370400440532013000 and ACCOUNT 123456789.") == [
        ("account", "DE89370400440532013000"), ("account", "123456789")
    ]
    assert added("İ SSN 123-45-6789") == [("account", "123-45-6789")]
    assert added("iban AA00 " * 20_000) == []
    for user, password in (("u" * 65, "p"), ("u", "p" * 300), ("u" * 70_000, "p" * 70_000)):
        link = f"HTTPS://{user}:{password}@host.example"
        assert added(f"at {link}/x") == [("link", link)]
    long = "mailto:" + "m" * 5000 + "@x.org"
    assert added(long) == [("link", long)]
    assert added("tel:+49-170-1234567 tel:12") == [("link", "tel:+49-170-1234567")]


def test_secrets():
    def secrets(text):
        return [text[a:b] for k, a, b in pii.find(text) if k == "secret"]

    assert secrets('token = "04dbebab91ab"### API_KEY: \'k 1\' "password": "x-1", token=abcdefghijklmnop0') == ["04dbebab91ab", "x-1", "abcdefghijklmnop0"]
    assert secrets("the token is here, password: none, secret = ") == []
    assert secrets("token " * 20_000) == [] and secrets("token=" * 20_000 + "a") == ["token=" * 19_999 + "a"]


def test_recall_over_planted_kinds(spark):
    """Every value of the kinds that the documents hold, counted by plain patterns, lies in a span of its kind."""
    plain = {k: p for k, p in zip(pii.BASE_KINDS, (EMAIL, IP, CARD, PHONE))} | {"secret": re.compile(r'(?<=token = ")[0-9a-f]+(?=")')}
    wanted, got, with_secret = {k: 0 for k in plain}, {k: 0 for k in plain}, 0
    for (text,) in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").dropna().toLocalIterator():
        spans, base = set(pii.find(text)), brute(text)
        planted = base + [("secret", *m.span()) for m in plain["secret"].finditer(text)]
        for span in planted:
            wanted[span[0]] += 1
            got[span[0]] += span in spans
        with_secret += any(s[0] == "secret" for s in spans)
    assert all(n > 0 for n in wanted.values()) and all(got[k] >= 0.9 * wanted[k] for k in wanted)
    assert with_secret <= wanted["secret"]  # clean documents get none


def test_report_and_edge_cases(spark, frame):
    table = [*EDGE, (20, "jo@x.org 10.0.0.1 +49 170 1234567 4111 1111 1111 1111 ü a@b.c")]
    out = sorted(pii.report(frame(table)).collect(), key=repr)
    want = sorted(((i, brute(t or "")) for i, t in table), key=lambda x: str(x[0]))
    assert len(out) == len(table)
    for r, (i, spans) in zip(sorted(out, key=lambda r: str(r["doc_id"])), want):
        assert r["doc_id"] == i and [r[f"n_{k}"] for k in pii.BASE_KINDS] == [sum(s[0] == k for s in spans) for k in pii.BASE_KINDS]
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
    masked = frame([(1, "to jo@x.org"), (2, None)]).select(pii.redacted(F.col("text")).alias("t")).collect()
    assert [r["t"] for r in masked] == ["to [EMAIL]", None]
    assert pii.report(frame([])).count() == 0
