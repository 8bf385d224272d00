"""Personal data by anchor expansion.

An Aho-Corasick automaton finds the anchors of a text in one pass: at signs, plus signs, digits,
colons, ends of schemes and identifier cues in any case. From each anchor a local parser expands to the left and right as far
as its grammar allows and validates what it found. Parsers look at each character a bounded number of
times, so long runs of one character cost no more than others.

Base kinds, leftmost and without overlaps per kind:
``email`` local part, at sign, a domain of two or more labels;
``ip`` four numbers of at most 255; ``card`` 16 to 19 digits that pass Luhn, single blanks or hyphens
between; ``phone`` plus sign, 8 to 15 digits. A match that fails its check is dropped, not retried.
Kinds the anchors add: ``url``, any scheme with a user part (``scheme://name:word@host``, after
``jdbc:`` too); ``iban``, as long as its country's accounts are, single blanks or hyphens between, checked
modulo 97, in small letters only after its cue; ``secret``, a value of letters and digits of both sorts
after a cue and a colon or equals sign, quoted or not, of 16 characters (8 after a password cue) or
more; ``account``, a number of 6 to 17 digits after a cue such as ``account number``; ``ssn``, three,
two and four digits after its cue; ``ipv6``, of four or more groups; ``mac``; ``hidden_email``, an
address with its signs spelt out in brackets.

Offsets are code points, ends exclusive. A null text counts as empty and has no spans. Every row is
treated by itself, so repeated rows, null keys and other columns of any name make no difference.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from opinara.llm.frames import documents_of, map_batches

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "iban", "secret", "account", "ssn", "ipv6", "mac", "hidden_email")
PASSWORD_CUES = ("password", "passwd", "passphrase", "pwd")
SECRET_CUES = ("token", "secret", "api_key", "apikey", "api-key", "api key", "access_key", "access-key", "access key", "private_key", "bearer")
ACCOUNT_CUES = ("account number", "account no", "account #", "account:", "acct", "a/c no", "routing number", "passport number", "passport no")
HIDDEN_ATS = ("(at)", "[at]", "{at}", "<at>")
AT, PLUS, DIGIT, SCHEME, IBAN, SECRET, PASSWORD, ACCOUNT, SSN, COLON, HIDDEN = range(11)
ANCHORS = {
    AT: "@", PLUS: "+", DIGIT: "0123456789", SCHEME: ("://",), IBAN: ("iban",), SECRET: SECRET_CUES, PASSWORD: PASSWORD_CUES,
    ACCOUNT: ACCOUNT_CUES, SSN: ("ssn", "social security number", "social security no"), COLON: ":", HIDDEN: HIDDEN_ATS,
}
# The length of an account by its country, as registered under ISO 13616.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21,
    "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27,
    "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26,
    "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24,
    "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29,
    "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TL": 23, "TN": 24,
    "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
GROUPED = re.compile(r"[0-9](?:[ -]?[0-9])+")
DIALLED = re.compile(r"\+[0-9][ ().0-9-]+")
# Possessive: a run that ends wrong is not tried again shorter.
USERINFO = re.compile(r"//[^\s/@:]++:[^\s/@]++@[A-Za-z0-9.-]++(?::[0-9]++)?(?:/[^\s\"'<>]*+)?")
SCHEME_LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
AFTER_IBAN = re.compile(r"[\s:=#(]{0,4}")
VALUE = re.compile(r"[\"']?(?:\s{0,2}(?:[:=]|=>|:=)\s{0,2}|(?<=bearer)\s{1,2})(?:\"([^\s\"]*+)\"|'([^\s']*+)'|([A-Za-z0-9_+/=.~-]++))", re.I)
NUMBER = re.compile(r"(?:\s?(?:number|no|nr))?[\s.:=#]{0,4}([0-9](?:[ -]?[0-9])*+)(?![A-Za-z0-9])", re.I)
SOCIAL = re.compile(r"[\s.:=#]{0,4}((?!000|666|9)[0-9]{3}([ -]?)(?!00)[0-9]{2}\2(?!0000)[0-9]{4})(?![A-Za-z0-9])")
CAPITALS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
HEX = frozenset("0123456789abcdefABCDEF")
COLONS = re.compile(r"[0-9A-Fa-f:]*+")
MAC = re.compile(r"[0-9A-Fa-f]{2}(?::[0-9A-Fa-f]{2}){5}")
HIDDEN_DOMAIN = re.compile(r"\s{0,2}[A-Za-z0-9-]++(?:\s{0,2}(?:\.|[(\[{<]dot[)\]}>])\s{0,2}[A-Za-z0-9-]++)++", re.I)
PII_SCHEMA = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
)


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    """Anchors, in small letters, to what they are."""
    found = ahocorasick.Automaton()
    for kind, words in ANCHORS.items():
        for word in words:
            found.add_word(word, kind)
    found.make_automaton()
    return found


def small(text: str) -> str:
    """Small letters, place by place: the few letters whose small form is longer stay as they are."""
    lowered = text.lower()
    return lowered if len(lowered) == len(text) else "".join(c if len(c.lower()) > 1 else c.lower() for c in text)


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def mod97(account: str) -> bool:
    """The check of ISO 13616."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def emails(text: str, anchors: list[int]) -> list[tuple[int, int]]:
    spans, free = [], 0  # free: where the next local part may begin at the earliest
    for at in anchors:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at) if start < at else None
        if domain:
            spans.append((start, domain.end()))
            free = domain.end()
        else:
            free = at + 1  # an at sign is no part of a local part
    return spans


def numbers(text: str, runs: list[int], pattern: re.Pattern, valid) -> list[tuple[int, int]]:
    """Spans that begin a run of digits and do not lie within an earlier match of the same kind."""
    spans, free = [], 0
    for start in runs:
        if start < free:
            continue
        match = pattern.match(text, start)
        if match:
            free = match.end()
            if valid(match[0]):
                spans.append(match.span())
    return spans


def is_ip(found: str) -> bool:
    # The length check keeps int() from very long numbers, leading zeros apart.
    return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in found.split("."))


def is_card(found: str) -> bool:
    digits = found.replace(" ", "").replace("-", "")
    return 16 <= len(digits) <= 19 and luhn(digits)


def phones(text: str, anchors: list[int]) -> list[tuple[int, int]]:
    spans = []
    for start in anchors:
        match = DIALLED.match(text, start)
        if not match:
            continue
        found = match[0].rstrip(" ().-")
        if len(found) >= 4 and 8 <= sum(c.isdigit() for c in found) <= 15:
            spans.append((start, start + len(found)))
    return spans


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """All spans by kind in the order of ``KINDS``, then by start."""
    anchors: list[list[int]] = [[] for _ in ANCHORS]
    for end, kind in automaton().iter(small(text)):
        anchors[kind].append(end)
    runs = [at for i, at in enumerate(anchors[DIGIT]) if i == 0 or anchors[DIGIT][i - 1] != at - 1]
    found = {
        "email": emails(text, anchors[AT]),
        "ip": numbers(text, runs, DOTTED, is_ip),
        "card": numbers(text, runs, GROUPED, is_card),
        "phone": phones(text, anchors[PLUS]),
        "url": with_user(text, anchors[SCHEME]),
        "iban": ibans(text, runs, anchors[IBAN]),
        "secret": secrets(text, [(at, 16) for at in anchors[SECRET]] + [(at, 8) for at in anchors[PASSWORD]]),
        "account": numbered(text, anchors[ACCOUNT], NUMBER, lambda found: 6 <= sum(map(str.isdigit, found)) <= 17),
        "ssn": numbered(text, anchors[SSN], SOCIAL, lambda found: True),
        "ipv6": [],
        "mac": [],
        "hidden_email": hidden_emails(text, anchors[HIDDEN]),
    }
    for kind, span in colon_addresses(text, anchors[COLON]):
        found[kind].append(span)
    return [(kind, start, end) for kind in KINDS for start, end in found[kind]]


def with_user(text: str, anchors: list[int]) -> list[tuple[int, int]]:
    spans, free = [], 0
    for end in anchors:
        if end - 2 < free:
            continue
        match = USERINFO.match(text, end - 1)
        if not match:
            continue
        start = end - 2
        while start > free and text[start - 1] in SCHEME_LETTERS:
            start -= 1
        while start < end - 2 and not text[start].isalpha():
            start += 1
        if start == end - 2:
            continue
        outer = start  # a driver's prefix, as in jdbc:mysql://
        while outer > free and (text[outer - 1] == ":" or text[outer - 1] in SCHEME_LETTERS):
            outer -= 1
        driver = text[outer:start].lower().rfind("jdbc:")
        spans.append((start if driver < 0 else outer + driver, match.end()))
        free = match.end()
    return spans


def ibans(text: str, runs: list[int], cues: list[int]) -> list[tuple[int, int]]:
    """Accounts anywhere in capitals, and after a cue in any case."""
    wanted = {at - 2: False for at in runs if at >= 2 and text[at - 2 : at] in IBAN_LENGTHS}
    wanted |= {AFTER_IBAN.match(text, end + 1).end(): True for end in cues}
    spans = []
    for start, any_case in sorted(wanted.items()):
        if start and text[start - 1].isalnum() and not any_case:
            continue
        length = IBAN_LENGTHS.get(text[start : start + 2].upper())
        if not length:
            continue
        letters, at = [], start
        while len(letters) < length and at < len(text):
            letter = text[at].upper() if any_case else text[at]
            if letter in CAPITALS:
                letters.append(letter)
            elif letter not in " -" or text[at - 1] in " -":
                break
            at += 1
        ends = at == len(text) or not text[at].isalnum()
        if len(letters) == length and ends and "".join(letters[2:4]).isdigit() and mod97("".join(letters)):
            spans.append((start, at))
    return spans


def secrets(text: str, cues: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Values after ``cues``, places with the fewest characters that count."""
    spans, free = [], 0
    for end, least in sorted(cues):
        match = VALUE.match(text, end + 1) if end >= free else None
        if not match:
            continue
        free = match.end()  # cues within a value are part of it
        bare = match.lastindex == 3
        value = match[3].rstrip(".-") if bare else match[match.lastindex]
        if len(value) >= least and any(map(str.isdigit, value)) and any(map(str.isalpha, value)):
            start = match.start(match.lastindex)
            spans.append((start, start + len(value)))
    return spans


def numbered(text: str, cues: list[int], pattern: re.Pattern, valid) -> list[tuple[int, int]]:
    matches = (pattern.match(text, end + 1) for end in cues)
    return sorted({match.span(1) for match in matches if match and valid(match[1])})


def colon_addresses(text: str, colons: list[int]) -> Iterator[tuple[str, tuple[int, int]]]:
    """IPv6 and hardware addresses: runs of hexadecimal digits and colons between other characters."""
    free = 0
    for at in colons:
        if at < free:
            continue
        start = at
        while start > free and at - start < 5 and text[start - 1] in HEX:
            start -= 1
        end = free = COLONS.match(text, at).end()
        if start and (text[start - 1].isalnum() or text[start - 1] in "_.") or end < len(text) and (text[end].isalnum() or text[end] == "_"):
            continue
        if end - start <= 40:
            found = text[start:end].removesuffix(":") if not text[start:end].endswith("::") else text[start:end]
            if MAC.fullmatch(found):
                yield "mac", (start, start + len(found))
            elif sum(map(bool, found.split(":"))) >= 4 and any(map(str.isdigit, found)) and is_ipv6(found):
                yield "ipv6", (start, start + len(found))


def is_ipv6(found: str) -> bool:
    try:
        ipaddress.IPv6Address(found)
    except ValueError:
        return False
    return True


def hidden_emails(text: str, anchors: list[int]) -> list[tuple[int, int]]:
    spans, free = [], 0
    for end in anchors:
        stop = end - 3  # all ways to spell it have four characters
        while stop > free and end - stop < 6 and text[stop - 1] == " ":
            stop -= 1
        start = stop
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        domain = HIDDEN_DOMAIN.match(text, end + 1) if start < stop else None
        if domain:
            spans.append((start, domain.end()))
        free = domain.end() if domain else end + 1
    return spans


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = {kind: [] for kind in BASE_KINDS}
        digests, joined = [], []
        for text in batch.column(1):
            spans = find_spans(text.as_py())
            names = [f"{kind}:{start}:{end}" for kind, start, end in spans]
            base = [name for name, span in zip(names, spans) if span[0] in counts]
            for kind in BASE_KINDS:
                counts[kind].append(sum(span[0] == kind for span in spans))
            digests.append(hashlib.sha256(",".join(base).encode()).hexdigest())
            joined.append(",".join(names))
        columns = [batch.column(0), *(pa.array(counts[k], pa.int64()) for k in BASE_KINDS), pa.array(digests, pa.string()), pa.array(joined, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans"])


def find_pii(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: counts of the base kinds, a digest of their spans, and all spans."""
    return map_batches(documents_of(docs, key, text), _find, PII_SCHEMA)


def masked(text: str) -> str:
    """The text with each span replaced by its kind in brackets; spans that touch or overlap become one."""
    out, at = [], 0
    for start, end, kind in sorted((start, end, kind) for kind, start, end in find_spans(text)):
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def mask_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """The same rows and columns, texts masked; a null text stays null."""
    place = docs.columns.index(text)

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (value.as_py() for value in batch.column(place))
            column = pa.array([None if t is None else masked(t) for t in texts], pa.string())
            yield pa.RecordBatch.from_arrays([column if i == place else c for i, c in enumerate(batch.columns)], schema=batch.schema.set(place, pa.field(text, pa.string())))

    return map_batches(docs, mask, docs.schema)
