"""Personal data: the base kinds against plain regular expressions, the other kinds by example."""

import hashlib
import random
import re

from opinara.llm import pii

BASE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(d := re.sub(r"[ -]", "", m)) <= 19 and pii.luhn(d)),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(re.sub(r"\D", "", m)) <= 15),
}


def brute_force(text):
    return [
        (kind, m.start(), m.end())
        for kind, (pattern, valid) in BASE.items()
        for m in re.finditer(pattern, text)
        if valid(m[0])
    ]


def base_spans(text):
    return [span for span in pii.find_spans(text) if span[0] in BASE]


def test_base_kinds_equal_the_expressions_on_random_text():
    dice = random.Random(7)
    pieces = ["a", "B.c", "@", "@x.y", ".", "-", " ", "+1", "+", "1", "22", "4929348385146306", "255", "256", "(", ")", "é", "\n", "1.2.3.4", "mail@a-b.co", "%", "_"]
    for _ in range(20_000):
        text = "".join(dice.choice(pieces) for _ in range(dice.randint(0, 25)))
        assert base_spans(text) == brute_force(text), text


def test_base_kinds_equal_the_expressions_on_documents(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    found = {row.doc_id: row for row in pii.find_pii(docs).collect()}
    for row in docs.collect():
        spans = brute_force(row.text)
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        mine = found[row.doc_id]
        assert mine.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [mine[f"n_{kind}"] for kind in BASE] == [sum(s[0] == kind for s in spans) for kind in BASE]
        assert set(joined.split(",")) - {""} <= set(mine.spans.split(","))


def test_added_kinds():
    kinds = lambda text: [(k, text[s:e]) for k, s, e in pii.find_spans(text) if k not in BASE]
    assert kinds('x token = "a1b2c3d4e5f6a7b8c9d0" y') == [("secret", "a1b2c3d4e5f6a7b8c9d0")]
    assert kinds("IBAN: DE89 3704 0044 0532 0130 00.") == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert kinds("IBAN: DE88 3704 0044 0532 0130 00.") == []
    assert kinds("see https://me:word@host.org/x now") == [("url", "https://me:word@host.org/x")]
    assert kinds("the token was lost, https://host.org is clean") == []


def test_long_urls_and_secrets_are_found_whole():
    kinds = lambda text: [(k, text[s:e]) for k, s, e in pii.find_spans(text) if k in ("url", "secret")]
    for size in (257, 513, 900, 2049, 300_000):
        value = "a1" * size
        assert kinds(f'token = "{value}" y') == [("secret", value)]
        for url in (f"https://{value}:w@h.org/x", f"https://u:{value}@h.org/x", f"https://u:w@{value}.org/x", f"https://u:w@h.org/{value}"):
            assert kinds(f"see {url} now") == [("url", url)]
            assert pii.masked(f"see {url} now") == "see [URL] now"


def test_added_kinds_are_linear_on_long_runs():
    for text in ("http://a:b@c/" * 50_000, "http://" * 50_000, "http://a:" * 50_000, "http://" + "a:" * 200_000, 'token="' * 50_000, 'token="' + "a1" * 200_000, "token=" * 50_000, "jdbc:" * 50_000 + "//a:b@c/"):
        pii.find_spans(text)


def added(text):
    return [(kind, text[start:end]) for kind, start, end in pii.find_spans(text) if kind not in BASE]


def test_accounts_end_where_their_country_says():
    account = "DE89 3704 0044 0532 0130 00"
    for text in (f"IBAN {account} BIC COBADEFF", f"IBAN: {account}", f"pay to {account} 500 EUR", f"iban {account} EUR 500", f"({account})"):
        assert added(text) == [("iban", account)], text
    plain = account.replace(" ", "")
    assert added(f"IBAN: {plain} The next") == [("iban", plain)]
    assert added(f"iBaN={plain.lower()}, and") == [("iban", plain.lower())]
    assert added("to GB82-WEST-1234-5698-7654-32 now") == [("iban", "GB82-WEST-1234-5698-7654-32")]
    for text in (f"{plain}The", f"X{plain}", f"see {plain.lower()}", "IBAN DE89 3704 0044 0532 0130", f"IBAN {plain[:-1]}1", "IBAN", "iban "):
        assert added(text) == [], text


def test_secrets_in_any_spelling():
    value = "a1b2c3d4e5f6a7b8c9d0"
    for text in (f"Token: '{value}'", f"TOKEN={value}", f"token={value}.", f'"Api-Key": "{value}"', f"Authorization: Bearer {value}", f"Access_Key => {value};"):
        assert added(text) == [("secret", value)], text
    assert added("PassWord: hunter2000 x") == [("secret", "hunter2000")]
    assert added("İİ token=" + value) == [("secret", value)]
    for text in ("token=short1", f"the token {value}", "password: required", "secret = aaaaaaaaaaaaaaaaaaaaaaaa", "bearer of news"):
        assert added(text) == [], text


def test_urls_of_any_scheme():
    for url in ("amqp://u:w@host/x", "jdbc:postgresql:some.very.long.driver.name://u:w@host:5432/db", "mongodb+srv://u:w@h.org"):
        assert added(f"see {url} now") == [("url", url)]
    assert added("note:https://u:w@h.org") == [("url", "https://u:w@h.org")]
    assert added("https://host.org:80/a and ://u:w@h") == []


def test_numbers_after_cues_and_addresses():
    assert added("Account number: 1234 5678 90.") == [("account", "1234 5678 90")]
    assert added("acct no. 00123456") == [("account", "00123456")]
    assert added("SSN: 123-45-6789, x") == [("ssn", "123-45-6789")]
    assert added("at 2001:db8:85a3::8a2e:370:7334, and") == [("ipv6", "2001:db8:85a3::8a2e:370:7334")]
    assert added("card 00:1A:2b:3C:4d:5E.") == [("mac", "00:1A:2b:3C:4d:5E")]
    assert added("jo.doe (at) host [dot] org!") == [("hidden_email", "jo.doe (at) host [dot] org")]
    for text in ("at 12:30:45", "std::abs a::b 1:2:3:4", "SSN: 000-45-6789", "account no 123", "look (at) this", "account of 12345678 people", ":::::"):
        assert added(text) == [], text


def test_cues_are_linear_on_long_runs():
    for text in ("iban " * 60_000, "DE89" * 80_000, "DE89 " * 60_000, "a:" * 150_000, "1:" * 150_000, "::" * 150_000, "x(at)" * 60_000, "(at)" * 80_000, "password=" * 40_000, "password=a1" * 40_000, "account no " * 40_000, "account no 1 " * 40_000, "acct" + "1" * 300_000, "a" * 300_000 + "://" * 1000 + "u:w@h"):
        pii.find_spans(text)


def test_long_runs_are_linear():
    for text in ("a" * 300_000, "1" * 300_000, "@" * 300_000, "1." * 150_000, "+1" * 150_000, "1 " * 150_000):
        base_spans(text)


def test_masking_keeps_rows_columns_and_nulls(spark):
    rows = [(1, "to a@b.co, +1 (017) 555-7713!", "x"), (2, None, "y"), (None, "", "z"), (1, "clean", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = sorted(map(tuple, pii.mask_pii(docs).collect()), key=str)
    assert got == sorted([(1, "to [EMAIL], [PHONE]!", "x"), (2, None, "y"), (None, "", "z"), (1, "clean", None)], key=str)
    assert pii.find_pii(docs.limit(0)).count() == 0
    assert {r.spans for r in pii.find_pii(docs.filter("doc_id = 2")).collect()} == {""}
