"""Fixed kinds against the plain patterns; added spans; redaction."""

import hashlib
import random
import re

from pairworks.llm import pii

SCHEMA = "doc_id long, text string, personal int"
# The plain patterns.
PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def valid(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(x) <= 255 for x in text.split("."))
    if kind == "card":
        doubled = sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 if c > "4" else 2 * int(c)) for i, c in enumerate(reversed(digits)))
        return 12 <= len(digits) <= 19 and doubled % 10 == 0
    return 9 <= len(digits) <= 15 if kind == "phone" else True


def plain(text):
    found, numbers = [], []
    for rank, (kind, pattern) in enumerate(PATTERNS):
        own = [m for m in re.finditer(pattern, text or "") if valid(kind, m.group())]
        numbers.append(len(own))
        found += [(m.start(), rank, m.end()) for m in own]
    listed = ",".join(f"{PATTERNS[r][0]}:{a}:{z}" for a, r, z in sorted(found))
    return (*numbers, hashlib.sha256(listed.encode()).hexdigest()), listed


def data():
    rnd = random.Random(8)
    odd = [None, "", "a@b.c_d@e.f x@y.zz. é mail a.b@c-d.ef", "1.2.3.4.5.6.7.8 300.1.1.1 01.002.0255.0", "4111 1111 1111 1111 4111-1111-1111-1112",
           "+1 (988) 555-2485.. +12 +1234567890123456 +1-2-3-4-5-6-7-8-9", "1 " * 3000, "a" * 3000, "1" * 3000, "a@b.c " * 300, "1.1.1.1 " * 150 + "x",
           "é日本 test@ex.com +49 (30) 1234567", "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 " * 2, "0.0.0.0000000 1..2.3.4 1.2.3.", "+1+22222222222 a@b a@.b.c @x.y"]
    noise = ["".join(rnd.choice("0123456789 -.+()@ab%é") for _ in range(rnd.randint(5, 120))) for _ in range(300)]
    return [(i, t, 1) for i, t in enumerate(odd + noise)] + [(None, "x@y.zz", 1), (3, "x@y.zz", 1), (3, "x@y.zz", 1)]


def secrets():
    rnd = random.Random(9)
    key = lambda n: "".join(rnd.choice("abcdef0123456789") for _ in range(n)) + "a1b2"
    return [(i, [f"we set password={key(16)} there", f"key AKIA{key(16).upper()} is", f"version v{i % 9}.2 of the 2nd part", "no digits here", f"on page p{i}"][i % 5], 0) for i in range(100)]


def test_fixed_kinds_like_plain_patterns(spark):
    rows = data()
    got = pii.report(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted(((r[0], *plain(r[1])[0]) for r in rows), key=str)
    spans = sorted((str(r.doc_id), r.base_sha256, r.spans) for r in got)
    for (_, _, all_of), (_, _, listed) in zip(spans, sorted((str(r[0]), plain(r[1])[0][4], plain(r[1])[1]) for r in rows), strict=True):
        assert set(filter(None, listed.split(","))) <= set(all_of.split(","))


def test_added_spans(spark):
    docs = spark.createDataFrame(secrets(), SCHEMA)
    model = pii.learn(docs)
    texts = {r[0]: r[1] for r in secrets()}
    found = {r.doc_id: [texts[r.doc_id][s.start:s.end] for s in r.personal_.spans] for r in pii.find(docs, model).collect()}
    assert all(len(v) == (i % 5 < 2) for i, v in found.items())
    assert all(v[0].startswith(("password=", "AKIA")) for v in found.values() if v)
    assert pii.learn(docs.limit(0)).weights[0] < 0 and pii.report(docs.limit(0)).collect() == []


def test_redaction(spark):
    rows = [(1, None, 1), (2, "", 1), (3, "mail a@b.cd, not", 1), (4, "a@b.c_d@e.f", 1), (5, "x 4111111111111111@b.cd y", 1), (6, "clean", 1)]
    out = pii.redact(spark.createDataFrame(rows, SCHEMA), pii.learn(spark.createDataFrame(secrets(), SCHEMA)))
    assert out.columns == ["doc_id", "text", "personal"]
    assert [r.text for r in out.orderBy("doc_id").collect()] == [None, "", "mail <EMAIL>, not", "<EMAIL><EMAIL>", "x <EMAIL> y", "clean"]


def test_other_candidates(spark):
    texts = {"our SSN 123-45-6789 ok": "123-45-6789", "passport 123456789 ok": "123456789", "account number 12345678 ok": "12345678", "password: correcthorse ok": "correcthorse",
             "we met Mr. Henry Miller there": "Mr. Henry Miller", "and Mary Jones came": "Mary Jones", "he lives at 12 Oak Street now": "12 Oak Street",
             "the secret garden": None, "on 2023-01-05 we sold 1,234,567 items": None, "number 1234567 of 9": None, "the password required here": None, "in 1990 there were 20": None}
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(list(texts) * 20)], SCHEMA)
    found = {}
    for r in pii.find(docs, pii.learn(docs)).collect():
        found.setdefault(r.text, set()).add(tuple(r.text[s.start:s.end] for s in r.personal_.spans))
    assert found == {t: {(x,) if x else ()} for t, x in texts.items()}
