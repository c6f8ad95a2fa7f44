import random
import re

from hashlib import sha256

from helpers import documents
from wardspan.llm.pii import find, find_pii, redact
from wardspan.llm.queries import op6_pii

RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(text):
    digits = [int(c) for c in text if c.isdigit()][::-1]
    doubled = [sum(divmod(2 * d, 10)) for d in digits[1::2]]
    return 14 <= len(digits) <= 19 and (sum(digits[::2]) + sum(doubled)) % 10 == 0


def brute(text):
    found = []
    for kind, rule in RULES.items():
        for m in re.finditer(rule, text):
            digits = sum(c.isdigit() for c in m[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": kind == "card" and luhn(m[0]),
                "phone": 10 <= digits <= 15,
            }[kind]
            if good:
                found.append((kind, m.start(), m.end()))
    return sorted(found, key=lambda s: (s[1], list(RULES).index(s[0])))


def base(text):
    return [s for s in find(text) if s[0] in RULES]


def test_equals_the_rules_on_random_characters():
    rng = random.Random(1)
    for alphabet in ("01.", "0129 -", "+12() .-", "ab@.-_%+ ", "4 1-1.+@a(é)"):
        for _ in range(4000):
            text = "".join(rng.choices(alphabet, k=rng.randrange(40)))
            assert base(text) == brute(text), text


def test_cards_phones_and_the_methods_own():
    text = "Call +1 (386) 555-3733, pay 4111 1111-1111 1111, ftp://me:pw@h.org/x, IBAN: GB82 WEST 1234 5698 7654 32."
    assert [(k, text[a:b]) for k, a, b in find(text)] == [
        ("phone", "+1 (386) 555-3733"), ("card", "4111 1111-1111 1111"), ("login", "ftp://me:pw@h.org"),
        ("email", "pw@h.org"), ("iban", "GB82 WEST 1234 5698 7654 32"),
    ]
    assert redact(text, find(text)) == "Call [PHONE], pay [CARD], [LOGIN]/x, IBAN: [IBAN]."
    assert not find("IBAN GB83 WEST 1234 5698 7654 32") and not find("see http://host.org/a")


def test_odd_rows(spark):
    long = "é" * 300_000 + " a@b.cd " + "9" * 6000
    rows = [(1, None), (2, ""), (None, "a@b.cd"), (3, long), (4, "1.2.3.4"), (4, "1.2.3.4")]
    got = find_pii(documents(spark, rows))
    assert got.columns == ["doc_id", "text", "spans", "redacted"]
    seen = {(r.doc_id, len(r.spans), None if r.text is None else len(r.redacted)) for r in got.collect()}
    assert seen == {(1, 0, None), (2, 0, 0), (None, 1, 7), (3, 1, 300_000 + 9 + 6000), (4, 1, 4)}
    assert find_pii(documents(spark, rows).where("false")).count() == 0


def test_query_over_the_table(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = op6_pii(spark, folder).collect()
    assert len(got) == len(texts) and sum(r.n_email + r.n_phone for r in got) > 0
    for r in got:
        own = brute(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in own) for kind in RULES]
        assert r.base_sha256 == sha256(",".join(f"{k}:{a}:{b}" for k, a, b in own).encode()).hexdigest()
        assert r.spans == ",".join(f"{k}:{a}:{b}" for k, a, b in find(texts[r.doc_id]))
