from __future__ import annotations

import hashlib
import random
import re
import time

import pytest

from foldwise.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def base(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text)
            if all(int(x) <= 255 for x in m.group().split("."))]
    for m in CARD.finditer(text):
        d = re.sub("[^0-9]", "", m.group())
        if 12 <= len(d) <= 19 and pii.luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text)
            if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out)


def test_base_equals_plain_patterns():
    rnd = random.Random(1)
    for _ in range(3000):
        text = "".join(rnd.choices("0123456789  ..--@@+()ab%_é\n", k=rnd.randrange(1, 120)))
        assert pii.base_spans(text) == base(text), text
    for text in ("a@b.c@d.e", "x@@y.z", "@a.b", "1.2.3.4.5.6.7.8", "0000255.1.1.1 256.1.1.1",
                 "4111111111111111", "4111-1111 1111-1111", "+1 (212) 555-0100", "a@b", "a@b."):
        assert pii.base_spans(text) == base(text), text


def test_luhn():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


@pytest.mark.parametrize("text", ["1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+1 " * 60_000,
                                  "a@" * 100_000, "1 " * 100_000, "x1" * 100_000, "w" * 200_000 + " a1,b2,c3;" * 20_000,
                                  "w" * 200_000 + " " + "1234567x," * 20_000])
def test_long_runs_are_linear(text):
    t = time.process_time()
    spans = pii.base_spans(text)
    found = pii._candidates(text, spans)
    pii._contexts(text, sorted([(s, e) for s, _, e in spans] + [(s, e) for _, s, e in found]))
    assert time.process_time() - t < 5


def test_find_equals_base_on_documents(spark, edge, no_rows):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    for df in (d, edge):
        got = pii.find(df).collect()
        want = {}
        for r in df.select("doc_id", "text").collect():
            b = base(r.text)
            want[r.doc_id, hashlib.sha256(pii.spans_text(b).encode()).hexdigest()] = b
        assert len(got) == df.count()
        for r in got:
            b = want[r.doc_id, r.base_sha256]
            assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [
                sum(k == i for _, k, _ in b) for i in range(4)]
            assert set(pii.spans_text(b).split(",")) <= set(r.spans.split(","))
    assert pii.find(no_rows).count() == 0


def test_patterns_discover_unseen_identifiers(spark):
    rows = [(i, f"zzz {i} words. Please call me at +1 (212) 555-{1000 + i} today") for i in range(30)]
    rows += [(100, "Please call me at (212) 555-7777 today"), (101, "version 3.1 of 2024"),
             (102, "there were 5557777123 of them")]
    got = {r.doc_id: r for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[100].spans == "phone:18:32" and got[100].n_phone == 0
    assert got[101].spans == got[102].spans == ""


def test_contexts_are_the_two_words_before():
    text = "Call me: +1 2 at=7,b=8 end\n9"
    at = lambda x: (text.index(x), text.index(x) + len(x))
    got = pii._contexts(text, [at("+1 2"), at("7"), at("8"), at("9")])
    assert got == ["call me", "0 at=", "0 b=", "at=0,b=0 end"]
    assert pii._contexts("5 x", [(0, 1)]) == ["^ ^"]
    long = "w" * 90
    assert pii._contexts(f"{long} 5", [(91, 92)])[0].startswith("^ #")
    assert pii._contexts(f"{long}1 5", [(92, 93)]) == pii._contexts(f"{long}2 5", [(92, 93)])
    assert pii._contexts(f"{long}a 5", [(92, 93)]) != pii._contexts(f"{long}b 5", [(92, 93)])


def test_long_addresses_and_numbers_of_either_kind(spark):
    local = "x" * 100
    rows = [(i, f"please dial now +49 30 1234 {5000 + i} thanks") for i in range(20)]
    rows += [(i, f"mail the box b{i}@example.com thanks") for i in range(50, 70)]
    rows += [(100, "please dial now 0049 30 12345678 thanks"), (101, f"mail the box {local}@localhost thanks"),
             (102, "please pay with 0049 30 12345678 thanks")]
    got = {r.doc_id: r.spans for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[100] == "phone:16:32"
    assert got[101] == f"email:13:{13 + 100 + len('@localhost')}"
    assert got[102] == ""


def test_masked(spark, edge, no_rows):
    out = pii.masked(edge)
    assert out.schema == edge.schema
    by = {r.doc_id: r for r in out.collect()}
    assert by[11].text == ("mail [EMAIL] or [EMAIL], ip [IP] or 999.1.1.1, card [CARD], "
                           "call [PHONE] now")
    assert by[11].n_chars == len(by[11].text) and by[10].n_chars == 1 and by[3].text is None
    assert out.count() == edge.count() and pii.masked(no_rows).count() == 0
