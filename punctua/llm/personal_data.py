"""Personal data in text: patterns propose spans, checksums confirm them, nearby words adjust a score.

The base kinds are email, ip, card (confirmed by the Luhn digit) and phone; their spans always stand.
Further kinds are added: iban (confirmed by mod 97 and the length of its country), ssn (a social
security number of a possible area, group and serial), national (a ten-digit phone number without a
country code) and hidden (an e-mail address with its signs spelt out in brackets). Every span has a
score in per cent: the prior of its kind, raised when a word of that kind stands within ``BEFORE``
characters before or ``AFTER`` characters after it, lowered when a word stands there that speaks
against it. Added spans are kept from ``KEEP`` on; base spans are kept whatever their score.

Every row is searched on its own in linear time, without a shuffle; rows of any length are whole.

Defined results: a null or empty text has no spans; offsets are code points, ends exclusive; spans are
ordered by kind, as in ``KINDS``, then start; spans of different kinds may overlap, but a national
number within a phone is that phone; repeated rows are rows of their own; a null ``doc_id`` stays null;
an empty table gives an empty result; very long texts and runs are read whole; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctua.llm.secret_scan import span_text

# Fixed patterns of the base kinds.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Patterns of the added kinds.
IBAN = r"[A-Z][A-Z][0-9][0-9](\x20?[A-Z0-9]){11,36}"
SSN = r"[0-9]+-[0-9]+-[0-9]+"
NATIONAL = r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}"
HIDDEN = r"[A-Za-z0-9._%+-]+\x20?[\[(](at|AT)[\])]\x20?[A-Za-z0-9-]+(\x20?(\.|[\[(](dot|DOT)[\])])\x20?[A-Za-z0-9-]+)+"

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn", "national", "hidden")
PRIOR = {"email": 90, "ip": 60, "card": 80, "phone": 70, "iban": 90, "ssn": 40, "national": 40, "hidden": 60}
STEP, KEEP = 30, 60
BEFORE, AFTER = 48, 24

# Words that speak for or against a kind, in ASCII lower case.
FOR = {
    "email": "e-mail email mail contact write correo courriel kontakt schreiben",
    "ip": "ip host server address login adresse direccion client",
    "card": "card visa mastercard amex credit debit karte kreditkarte carte tarjeta payment cvv",
    "phone": "phone call tel telephone telefon telefono mobile cell fax handy portable movil whatsapp",
    "iban": "iban account bank konto compte cuenta bic swift transfer",
    "ssn": "ssn social security taxpayer",
    "national": "phone call tel telephone telefon telefono mobile cell fax handy portable movil whatsapp",
    "hidden": "e-mail email mail contact write correo courriel kontakt schreiben",
}
AGAINST = {
    "email": "example noreply no-reply",
    "ip": "version release chapter section firmware",
    "card": "isbn order tracking serial invoice sku",
    "phone": "isbn order tracking serial invoice sku",
    "iban": "serial sku",
    "ssn": "isbn order tracking serial invoice sku part",
    "national": "isbn order tracking serial invoice sku part",
    "hidden": "example noreply no-reply",
}
# Length of an account number by country.
IBAN_LENGTH = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21,
    "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27,
    "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26,
    "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27,
    "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25,
    "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TL": 23,
    "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# As IP, but each run of digits is entered at its beginning only, so that long runs take linear time.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_SSN = re.compile(r"(?<![0-9])[0-9]++-[0-9]++-[0-9]++")
_CARD, _PHONE, _IBAN, _NATIONAL = (re.compile(p) for p in (CARD, PHONE, IBAN, NATIONAL))
_HIDDEN_SIGN = re.compile(HIDDEN.removeprefix("[A-Za-z0-9._%+-]+"))
_DIGIT = re.compile("[0-9]")


def words_pattern(words: str) -> str:
    """A pattern that finds one of the words as a whole, in ASCII lower case."""
    return "(^|[^a-z])(" + "|".join(words.split()) + ")([^a-z]|$)"


_FOR = {kind: re.compile(words_pattern(words)) for kind, words in FOR.items()}
_AGAINST = {kind: re.compile(words_pattern(words)) for kind, words in AGAINST.items()}
_LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def digits(span: str) -> list[int]:
    return [int(c) for c in _DIGIT.findall(span)]


def luhn(number: list[int]) -> bool:
    """Whether the last digit is the Luhn check digit of the others."""
    doubled = (2 * d - 9 * (d > 4) for d in number[-2::-2])
    return (sum(number[-1::-2]) + sum(doubled)) % 10 == 0


def mod97(account: str) -> bool:
    """Whether an account number without blanks leaves 1, its first four signs moved to the end."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def _signs(text: str, sign: re.Pattern | str, match: re.Pattern) -> Iterator[tuple[int, int]]:
    """Leftmost spans of a run of local signs and what ``match`` finds right after it, in linear time."""
    last = 0
    found = sign.finditer(text)
    for begin in found:
        start = begin.start()
        hit = match.match(text, start)
        if hit is None:
            continue
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < begin.start():
            last = hit.end()
            yield start, last


_AT = re.compile("@")
_BRACKET = re.compile(r"\x20?[\[(](?:at|AT)[\])]")


def _iban(text: str) -> Iterator[tuple[int, int]]:
    for m in _IBAN.finditer(text):
        start, end = m.span()
        length = IBAN_LENGTH.get(text[start:start + 2], 0)
        if start and text[start - 1].isascii() and text[start - 1].isalnum():
            continue
        account = ""
        for at in range(start, end):
            if text[at] != " ":
                account += text[at]
                if len(account) == length:
                    if mod97(account):
                        yield start, at + 1
                    break


def _ssn(text: str) -> Iterator[tuple[int, int]]:
    for m in _SSN.finditer(text):
        area, group, serial = m.group().split("-")
        possible = area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"
        if (len(area), len(group), len(serial)) == (3, 2, 4) and possible:
            yield m.span()


def _alone(text: str, start: int, end: int) -> bool:
    """Whether no further digit, sign or dash joins the number."""
    def joins(c: str) -> bool:
        return c.isascii() and (c.isalnum() or c in "-+.")

    return not (start and joins(text[start - 1])) and not (end < len(text) and joins(text[end]) and text[end] != ".")


def proposals(text: str) -> Iterator[tuple[int, int, int]]:
    """``(kind, start, end)`` of all confirmed spans, by kind, then start, before scores are looked at."""
    if "@" in text:
        for start, end in _signs(text, _AT, _DOMAIN):
            yield 0, start, end
    phones = []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            parts = [part.lstrip("0") for part in m.group().split(".")]
            if all(len(part) <= 3 and int(part or 0) <= 255 for part in parts):
                yield 1, *m.span()
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13:
                number = digits(m.group())
                if 13 <= len(number) <= 19 and luhn(number):
                    yield 2, *m.span()
        for m in _PHONE.finditer(text):
            if 9 <= len(digits(m.group())) <= 15:
                phones.append(m.span())
                yield 3, *m.span()
        for start, end in _iban(text):
            yield 4, start, end
        for start, end in _ssn(text):
            if _alone(text, start, end):
                yield 5, start, end
        for m in _NATIONAL.finditer(text):
            start, end = m.span()
            if _alone(text, start, end) and not any(s <= start and end <= e for s, e in phones):
                yield 6, start, end
    if "at" in text or "AT" in text:
        for start, end in _signs(text, _BRACKET, _HIDDEN_SIGN):
            yield 7, start, end


def score(text: str, kind: str, start: int, end: int) -> int:
    """Prior of the kind, adjusted by the words near the span, in per cent."""
    before = text[max(0, start - BEFORE):start].translate(_LOWER)
    after = text[end:end + AFTER].translate(_LOWER)
    value = PRIOR[kind]
    if _FOR[kind].search(before) or _FOR[kind].search(after):
        value += STEP
    if _AGAINST[kind].search(before) or _AGAINST[kind].search(after):
        value -= STEP
    return min(100, value)


def find(text: str) -> list[tuple[int, int, int, int]]:
    """``(kind, start, end, score)`` of all spans that are kept, by kind, then start."""
    found = []
    for kind, start, end in proposals(text):
        value = score(text, KINDS[kind], start, end)
        if kind < len(BASE) or value >= KEEP:
            found.append((kind, start, end, value))
    return found


def _found(batches) -> Iterator:
    import pyarrow as pa

    spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.int64())]))
    for batch in batches:
        rows = [
            [{"kind": KINDS[k], "start": s, "end": e, "score": v} for k, s, e, v in find(text or "")]
            for text in batch.column("text").to_pylist()
        ]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, spans)], names=[*batch.schema.names, "spans"])


def scan(docs: DataFrame) -> DataFrame:
    """Per row ``doc_id, text, spans``; a span has ``kind`` (of ``KINDS``), ``start``, ``end``, ``score`` (per cent)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _found, "doc_id long, text string, spans array<struct<kind: string, start: long, end: long, score: long>>")


def masked(found: DataFrame) -> DataFrame:
    """``doc_id, text`` of what ``scan`` returns, with each run of overlapping spans replaced by the
    kind of its first span in angle brackets. A null text stays null."""
    ordered = F.expr("array_sort(transform(spans, s -> struct(s.start AS start, s.`end` AS `end`, s.kind AS kind)))")
    merged = F.expr("""
        aggregate(ordered, struct('' AS done, 0L AS upto), (a, s) -> struct(
            CASE WHEN s.start >= a.upto
                THEN concat(a.done, substring(text, int(a.upto) + 1, int(s.start - a.upto)), '<', s.kind, '>')
                ELSE a.done END AS done,
            greatest(a.upto, s.`end`) AS upto))
    """)
    return found.withColumn("ordered", ordered).withColumn("merged", merged).select(
        "doc_id", F.expr("concat(merged.done, substring(text, int(merged.upto) + 1))").alias("text"))


def summary(found: DataFrame) -> DataFrame:
    """Counts and digests of the spans that ``scan`` returns."""
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, KINDS), F.sha2(span_text(base), 256).alias("base_sha256"),
                        span_text(F.col("spans")).alias("spans"))
