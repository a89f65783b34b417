"""Personal data: base spans against Python's re, added spans, redaction."""

import random
import re

import pytest
from llm_fixtures import documents, edges, nothing  # noqa: F401
from pyspark.sql import functions as F

from barforge.llm import pii as P

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(c)] for i, c in enumerate(reversed(digits))) % 10 == 0


def plain(text):
    out = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind != "ip" or all(int(x) < 256 for x in m[0].split(".")),
                    "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]:
                out.append((m.start(), rank, m.end(), kind))
    return ",".join(f"{k}:{a}:{z}" for a, _, z, k in sorted(out))


TEXTS = ["a@b.c_d@e.f g@h", "x@y@z.com.", "..@a-b.c..d", "😀é me.too+x%y@sub-1.example.co.uk, ok", "1.2.3.4.5.6.7.8 256.1.1.1 0001.002.3.255",
         "4111 1111 1111 1111 and 4111-1111-1111-1112 4111111111111111 4111111111111111", "+1 (555) 123-4567 +12345 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6",
         "+4930 1234567- x +33.1.42.68.53.00", "1" * 40, "a" * 3000, "a.b" * 500 + "@" + "c.d" * 400, "@@@ + +1", "12-34 56-78 90-12 34-56 78",
         "0000 0000 0000", "token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\" 10.0.0.1", "mail: a@b.co\nmail: c@d.co\tip 8.8.8.8"]


def random_text(rnd):
    return "".join(rnd.choice("0123456789 .-+()@ab_%Z\né") for _ in range(rnd.randrange(0, 60)))


def test_base_spans(spark, edges, nothing):
    rnd = random.Random(3)
    rows = [(100 + i, t) for i, t in enumerate([*TEXTS, *(random_text(rnd) for _ in range(400))])]
    df = edges.unionByName(documents(spark, rows)).repartition(4)
    got = P.document_spans(df).select("doc_id", P.span_text("base").alias("b"), *(f"n_{k}" for k in P.BASE), P.span_text("spans").alias("s")).collect()
    exp = sorted([(r.doc_id, plain(r.text)) for r in df.collect()], key=str)
    assert sorted([(r.doc_id, r.b) for r in got], key=str) == exp
    for r in got:
        kinds = [s.split(":")[0] for s in r.b.split(",") if s]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(kinds.count(k) for k in P.BASE)
        assert set(filter(None, r.b.split(","))) <= set(filter(None, r.s.split(",")))
    assert P.document_spans(nothing).collect() == []


@pytest.fixture(scope="module")
def mixed(spark):
    """Documents with confirmed data, secrets, and numbers that are nobody's."""
    rnd = random.Random(9)
    rows = []
    for i in range(1500):
        body = " ".join(rnd.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(12))
        what = i % 6
        if what == 0:
            body += f" user{i}@mail.example.org and 10.{i % 250}.0.7"
        elif what == 1:
            body += f" call +1 ({200 + i % 700}) 555-{i % 10000:04d} now"
        elif what == 2:
            body += ' token = "' + "".join(rnd.choice("0123456789abcdef") for _ in range(40)) + '"'
        elif what == 3:
            body += f" order {i * 7919 % 10**9:09d} shipped"
        elif what == 4:
            body += " chapter 12 of 2019"
        rows.append((i, body))
    return rows


def test_added_spans(spark, mixed):
    df = documents(spark, mixed).repartition(4)
    got = {r.doc_id: r.s for r in P.document_spans(df).select("doc_id", P.span_text("spans").alias("s")).collect()}
    for i, text in mixed:
        kinds = {s.split(":")[0] for s in got[i].split(",") if s}
        if i % 6 == 2:
            # digits inside the token may be a valid card number of their own
            (a, z), = [map(int, s.split(":")[1:]) for s in got[i].split(",") if s.startswith("secret")]
            assert re.fullmatch("[0-9a-f]{40}", text[a:z])
        elif i % 6 >= 3:
            assert kinds == set()  # clean documents are left alone


def test_redaction(spark, edges, mixed):
    df = edges.unionByName(documents(spark, [(100, "x a@b.co y 10.0.0.1"), (101, "+1 (555) 123-4567"), (102, "😀é a@b.co😀"), *mixed[:60]])).repartition(3)
    out = P.redact(df)
    assert out.columns == df.columns
    got = {}
    for r in out.collect():
        got.setdefault(r.doc_id, []).append(r)
    assert got[100][0].text == "x [EMAIL] y [IP]" and got[102][0].text == "😀é [EMAIL]😀"
    assert got[101][0].text == "[PHONE]"
    before = {}
    for r in df.collect():
        before.setdefault(r.doc_id, []).append(r)
    for d, rows in before.items():
        assert len(got[d]) == len(rows)
        if not any(plain(r.text) or "token" in (r.text or "") for r in rows):
            assert sorted(map(tuple, got[d]), key=str) == sorted(map(tuple, rows), key=str)
    assert out.where(F.col("_hash") != "x").count() == 0


def test_trees_use_context(spark, mixed):
    found = P.featured(P.candidates(documents(spark, mixed)))
    chosen = P.selected_patterns(found, precision=0.9)
    phone = P.KINDS.index("phone")
    assert chosen is not None and chosen.where(F.col("kind_code") == phone).count() > 0
    assert P.selected_patterns(found.limit(0)) is None


def test_trees_alone_add_each_kind(spark):
    """What no rule confirms: a mixed secret, a phone without its plus, a spelled-out address."""
    rnd = random.Random(12)
    some = lambda chars, n: "".join(rnd.choice(chars) for _ in range(n))
    rows, expected = [], {}
    for i in range(6000):
        what, number = i % 10, f"1 ({200 + i % 700}) 555-{i % 10000:04d}"
        body = " ".join(rnd.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(6))
        body += {0: f" call +{number} now", 1: f" mail user{i}@mail{i % 9}.example.org today", 2: f' token = "{some("0123456789abcdef", 40)}"',
                 3: f" order {i * 7919 % 10**9:09d} shipped", 4: f" key = primary_column_{i % 7} set", 5: f" call {i * 7919 % 10**9:09d} times",
                 6: f" on 2019-{1 + i % 12:02d}-{10 + i % 18} we met", 7: f" look (at) table{i % 9}.2 here"}.get(what, "")
        if what == 8 and i % 100 == 8:
            found = [number, f"user{i} [at] mail{i % 9} [dot] example [dot] org", "aB3" + some("ABCDEFGHabcdefgh0123456789", 21) + "xY7"]
            body += " " + (f"phone {found[0]} please", f"write {found[1]} soon", f'secret = "{found[2]}"')[i // 100 % 3]
            expected[i] = (("number", "address", "secret")[i // 100 % 3], found[i // 100 % 3])
        rows.append((i, body))
    got = {r.doc_id: [s for s in r.s.split(",") if s] for r in P.document_spans(documents(spark, rows).repartition(4)).select("doc_id", P.span_text("spans").alias("s")).collect()}
    for i, (kind, value) in expected.items():
        at = rows[i][1].index(value)
        assert f"{kind}:{at}:{at + len(value)}" in got[i], (kind, value, got[i])
    assert all(got[i] == [] for i in got if i % 10 > 2 and i not in expected)  # clean documents are left alone
