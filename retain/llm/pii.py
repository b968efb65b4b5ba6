"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs, digits, schemes and
identifier cues. From each, a local parser reads left and right and validates what it finds.
Emails, IP addresses, payment cards and phone numbers follow fixed patterns (the base kinds);
`link` (contact schemes and user names in web addresses), `account` (bank and social security
numbers behind a cue) and `secret` (the value assigned to a token, key or password) are found
besides. Schemes and cues are found in any mixture of cases; beyond the lengths that a
number's standard sets, no pattern bounds what it reads.

Spans are in code points, end exclusive. Defined cases: null and empty texts have no spans;
spans of one kind never overlap, spans of different kinds may; very long runs of one character
are read once; repeated rows get equal results; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The kinds in the order of their names in the result.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "link", "account", "secret")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
SPACED = re.compile(r"[0-9](?:[\x20-]?[0-9])*")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
USER_AT_HOST = re.compile(
    r"[A-Za-z0-9._~%!$&*+=-]++(?::[^\s/@<>\"']*+)?@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+(?::[0-9]{1,5}(?![0-9]))?"
)
MAILBOX = re.compile(r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DIALLED = re.compile(r"\+?[0-9][0-9().-]+[0-9]")
IBAN = re.compile(r"[\x20:#]*+([A-Za-z]{2}[0-9]{2}(?:\x20?[A-Za-z0-9]){11,30}+)")
SOCIAL = re.compile(r"[\x20:#]*+([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
ACCOUNT = re.compile(r"(?:\x20?(?:no\.?|number|nr\.?))?[\x20:#]*+([0-9]{8,17})(?![0-9]|[.-][0-9])", re.I)
SECRET = re.compile(r"[\"']?[\x20]*+[=:][\x20]*+(?:\"([^\"\s]++)\"|'([^'\s]++)'|([A-Za-z0-9_./+=~-]++))")

# Fixed values, in lower case: texts are folded before the search.
SCHEMES = {"mailto:": MAILBOX, "sip:": MAILBOX, "tel:": DIALLED, "http://": USER_AT_HOST, "https://": USER_AT_HOST, "ftp://": USER_AT_HOST}
CUES = {"iban": "iban", "ssn": "social", "account": "account", "acct": "account"}
SECRETS = ("token", "password", "passwd", "secret", "api_key", "api-key", "apikey", "access_key", "private_key")
# Shortest and longest account number of the standard, and of a secret without quotes.
IBAN_LENGTHS = (15, 34)
BARE_SECRET = 16
FOLD = {i: i + 32 for i in range(65, 91)}

RESULT = "spans array<struct<kind:string,start:int,end:int>>"


@lru_cache(maxsize=1)
def anchors() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    found.add_word("@", ("email", 1))
    found.add_word("+", ("phone", 1))
    for digit in "0123456789":
        found.add_word(digit, ("digit", 1))
    for scheme in SCHEMES:
        found.add_word(scheme, (scheme, len(scheme)))
    for cue, what in CUES.items():
        found.add_word(cue, (what, len(cue)))
    for cue in SECRETS:
        found.add_word(cue, ("secret", len(cue)))
    found.make_automaton()
    return found


def folded(text: str) -> str:
    """`text` in lower case with every character in its place."""
    low = text.lower()
    return low if len(low) == len(text) else text.translate(FOLD)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2)
    return total % 10 == 0


def iban_end(text: str, at: int, stop: int) -> int | None:
    """The end of the longest valid account number that begins at `at` and whose last character ends a word.

    The check (the number with its first four characters last, letters as two digits, is 1 modulo 97)
    is carried along, so every length is tried in one pass.
    """
    value = lambda c: (int(c, 36), 100 if c.isalpha() else 10)
    head, rest, n, found = text[at : at + 4], 0, 4, None
    for pos in range(at + 4, stop):
        if text[pos] == " ":
            continue
        number, base = value(text[pos])
        rest, n = (rest * base + number) % 97, n + 1
        if n > IBAN_LENGTHS[1]:
            break
        if n >= IBAN_LENGTHS[0] and not (pos + 1 < len(text) and text[pos + 1].isalnum()):
            check = rest
            for c in head:
                number, base = value(c)
                check = (check * base + number) % 97
            found = pos + 1 if check == 1 else found
    return found


def dotted_quads(text: str, at: int) -> tuple[list[tuple[int, int]], int]:
    """The address spans in the chain of dotted numbers at `at`, four numbers each, and its end."""
    chain = DOTTED.match(text, at)
    parts, spans, pos = chain[0].split("."), [], at
    for i in range(0, len(parts) - 3, 4):
        four = parts[i : i + 4]
        end = pos + sum(map(len, four)) + 3
        if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in four):
            spans.append((pos, end))
        pos = end + 1
    return spans, chain.end()


def find(text: str) -> list[tuple[str, int, int]]:
    """All spans as (kind, start, end), by start and then by kind."""
    spans: list[tuple[str, int, int]] = []
    email_end = dotted_end = spaced_end = link_end = account_end = secret_end = 0
    for last, (what, length) in anchors().iter(folded(text)):
        at = last - length + 1
        if what == "digit":
            if at >= dotted_end:
                quads, dotted_end = dotted_quads(text, at)
                spans += [("ip", a, b) for a, b in quads]
            if at >= spaced_end:
                spaced_end = SPACED.match(text, at).end()
                if spaced_end - at >= 14:
                    digits = text[at:spaced_end].replace(" ", "").replace("-", "")
                    if 14 <= len(digits) <= 19 and luhn(digits):
                        spans.append(("card", at, spaced_end))
        elif what == "email":
            start = at
            while start > email_end and text[start - 1] in LOCAL:
                start -= 1
            if start < at and (domain := DOMAIN.match(text, at + 1)):
                email_end = domain.end()
                spans.append(("email", start, email_end))
        elif what == "phone":
            if (number := PHONE.match(text, at)) and 10 <= sum(c.isdigit() for c in number[0]) <= 15:
                spans.append(("phone", at, number.end()))
        elif what in SCHEMES:
            if at >= link_end and not (at and text[at - 1].isalnum()) and (target := SCHEMES[what].match(text, last + 1)):
                if SCHEMES[what] is not DIALLED or sum(c.isdigit() for c in target[0]) >= 7:
                    spans.append(("link", at, target.end()))
                link_end = target.end()
        elif what == "secret":
            if at >= secret_end and (value := SECRET.match(text, last + 1)):
                group = value.lastindex
                secret_end = value.end()
                if group < 3 or value.end() - value.start(3) >= BARE_SECRET:
                    spans.append(("secret", *value.span(group)))
        elif at >= account_end and not (at and text[at - 1].isalnum()):
            if span := account(text, what, last + 1):
                account_end = span[1]
                spans.append(("account", *span))
    spans.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return spans


def account(text: str, what: str, at: int) -> tuple[int, int] | None:
    """The number behind a cue that ends at `at`, if it is valid."""
    if what == "iban":
        if number := IBAN.match(text, at):
            end = iban_end(text, number.start(1), number.end(1))
            return (number.start(1), end) if end else None
    elif what == "social":
        if (number := SOCIAL.match(text, at)) and number[1] not in ("000", "666") and number[1] < "900" and number[2] != "00" and number[3] != "0000":
            return number.start(1), number.end()
    elif number := ACCOUNT.match(text, at):
        return number.span(1)
    return None


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def digests(text: Column) -> Column:
    """A struct with the counts of the base kinds, the digest of their spans, and all spans as text."""

    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows = []
            for text in texts:
                spans = find(text.as_py() or "")
                base = [s for s in spans if s[0] in BASE_KINDS]
                row = {f"n_{k}": sum(s[0] == k for s in base) for k in BASE_KINDS}
                rows.append(row | {"base_sha256": hashlib.sha256(joined(base).encode()).hexdigest(), "spans": joined(spans)})
            fields = [(f"n_{k}", pa.int64()) for k in BASE_KINDS] + [("base_sha256", pa.string()), ("spans", pa.string())]
            yield pa.array(rows, pa.struct(fields))

    counts = ", ".join(f"n_{k} bigint" for k in BASE_KINDS)
    return F.arrow_udf(scan, f"{counts}, base_sha256 string, spans string")(text)


def redacted(text: Column, mask: str = "[{}]") -> Column:
    """`text` with every span replaced by its kind in capitals; overlapping spans become one."""

    def clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([None if (t := x.as_py()) is None else redact(t, mask) for x in texts], pa.string())

    return F.arrow_udf(clean, "string")(text)


def redact(text: str, mask: str = "[{}]") -> str:
    out, pos = [], 0
    for kind, start, end in find(text):
        if start >= pos:
            out += [text[pos:start], mask.format(kind.upper())]
        pos = max(pos, end)
    return "".join([*out, text[pos:]])


def report(docs: DataFrame) -> DataFrame:
    """The contract's row per document."""
    return docs.select("doc_id", digests(F.col("text")).alias("d")).select("doc_id", "d.*")
