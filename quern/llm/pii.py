"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame

from quern.llm.common import map_rows

#: Kinds in the order in which spans with the same start are listed.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
#: Spans of the kinds after the first four count from this score on; the first four always do.
LEAST_SCORE = 0.5
NEARBY = 48

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: The head of an account number; the group is as much as could belong to it.
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=((?:[ ]?[A-Z0-9]){11,30}))")
INSIDE = re.compile(r"[A-Za-z0-9]")
#: Characters of an account number by country.
IBAN_LENGTHS = {x[:2]: int(x[2:]) for x in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 FK18 "
    "FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 "
    "LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 "
    "SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30"
).split()}
SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
NOT_DIGIT = re.compile(r"[^0-9]")

#: What a confirmed span of each kind scores before its surroundings are looked at.
BASE_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.9, "ssn": 0.3}
#: Words before or after a span that raise its score, and those that lower it.
CONTEXT = {
    "email": ("mail", "e-mail", "contact", "write"),
    "ip": ("ip", "address", "host", "server", "addr"),
    "card": ("card", "visa", "credit", "debit", "mastercard", "payment"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "contact"),
    "iban": ("iban", "account", "bank", "transfer"),
    "ssn": ("ssn", "social", "security", "taxpayer"),
}
AGAINST = ("version", "example", "order", "serial", "isbn", "release")
RAISE, LOWER = 0.3, 0.2
WORDS = re.compile(r"[a-z][a-z-]*")


def luhn(digits: str) -> bool:
    """Every second digit from the right is doubled, less 9 if above 9; the sum ends in 0."""
    total = sum(map(int, digits[-1::-2])) + sum(int("0246813579"[int(d)]) for d in digits[-2::-2])
    return total % 10 == 0


def mod97(code: str) -> bool:
    """The first four characters go last, letters count from 10, and the number leaves 1 of 97."""
    code = code.replace(" ", "")
    return 15 <= len(code) <= 34 and int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses, one look at each ``@``: the name before it reaches back as far as it can."""
    at, done, past = text.find("@"), 0, 0
    while at >= 0:
        head = text[max(done, past) : at]
        name = len(head) - len(head.rstrip(LOCAL))
        past = at + 1
        if name and (m := DOMAIN.match(text, at)):
            done = m.end()
            yield at - name, done
        at = text.find("@", past)


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """Account numbers that pass mod 97, leftmost first and not overlapping. They end where no letter or digit follows:
    after as many characters as their country has, or, for countries not listed, after the most that pass."""
    done = 0
    for m in IBAN.finditer(text):
        start = m.start()
        if start < done:
            continue
        ends = [k + 1 for k in range(start, m.end(1)) if text[k] != " "]
        n = IBAN_LENGTHS.get(text[start : start + 2])
        for end in reversed(ends[n - 1 : n] if n else ends[14:]):
            if not INSIDE.match(text, end) and mod97(text[start:end]):
                done = end
                yield start, end
                break


def spans_of(text: str | None) -> list[tuple[int, int, int, float]]:
    """``(start, index of kind, end, score)`` in order; positions are code points, ends exclusive.

    Long runs of digits or letters are looked at once, so the time is in proportion to the text.
    """
    if not text:
        return []
    found = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if NUMBER.search(text):
        found += [("ip", *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = NOT_DIGIT.sub("", m[0])
                if 14 <= len(digits) <= 19 and luhn(digits):
                    found.append(("card", *m.span()))
        if "+" in text:
            found += [("phone", *m.span()) for m in PHONE.finditer(text) if 10 <= len(NOT_DIGIT.sub("", m[0])) <= 15]
        found += [("iban", a, b) for a, b in ibans(text)]
        found += [("ssn", *m.span()) for m in SSN.finditer(text)]
    scored = [(a, KINDS.index(k), b, score(text, k, a, b)) for k, a, b in found]
    return sorted(x for x in scored if x[1] < 4 or x[3] >= LEAST_SCORE)


NUMBER = re.compile(r"[0-9]")


def score(text: str, kind: str, start: int, end: int) -> float:
    near = WORDS.findall((text[max(0, start - NEARBY) : start] + " " + text[end : end + NEARBY]).lower())
    out = BASE_SCORE[kind] + RAISE * any(w in CONTEXT[kind] for w in near) - LOWER * any(w in AGAINST for w in near)
    return min(1.0, max(0.0, round(out, 4)))


def listed(spans: list[tuple[int, int, int, float]], kinds: int = len(KINDS)) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b, _ in spans if k < kinds)


def redact(text: str | None) -> str | None:
    """The text with each span, overlapping ones taken together, replaced by the kind of its first in brackets."""
    spans = spans_of(text)
    if not spans:
        return text
    out, at, past = [], 0, -1
    for a, k, b, _ in spans:
        if a >= past:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = past = max(past, b)
    return "".join([*out, text[at:]])


FOUND = "pii_spans array<struct<kind:string,start:int,end:int,score:double>>"


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Add ``pii_spans`` to every document: kind, start, end (code points, end exclusive) and score of each span.

    Email, ip, card and phone follow their patterns and validators whatever the score; IBANs that pass mod 97 and
    social security numbers are added from ``LEAST_SCORE`` on, the latter only with a word near that speaks for it.
    Null and empty texts have no spans; equal rows get equal spans; an empty table stays empty. Column read: ``text``.
    """
    def make():
        return lambda text: ([{"kind": KINDS[k], "start": a, "end": b, "score": s} for a, k, b, s in spans_of(text)],)

    return map_rows(docs, ["text"], FOUND, make)


def redacted_documents(docs: DataFrame) -> DataFrame:
    """The documents with personal data replaced; ``n_chars``, where there is one, follows the new text. Null texts stay."""
    from pyspark.sql import functions as F

    out = map_rows(docs, ["text"], "_q_text string", lambda: lambda t: (redact(t),))
    out = out.withColumn("text", F.col("_q_text"))
    if "n_chars" in docs.columns:
        n = F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), n))
    return out.select(*docs.columns)
