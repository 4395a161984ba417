"""Spans of personal data against plain expressions for the base kinds, and cases for the others."""

import hashlib
import random
import re

import pytest
from llm_fixtures import documents, edge, edge_rows, nothing, small  # noqa: F401

from adtally.llm import personal as P
from adtally.llm.queries import op11_personal_data


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(n // 10 + n % 10 for n in doubled) % 10 == 0


def base(text):
    """The four base kinds as the contract writes them."""
    # where there is no at-sign, the expression would try each place of a long run to its end
    emails = re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text) if "@" in text else ()
    out = [("email", *m.span()) for m in emails]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


PIECES = (
    "@ . .. a b-c @x.y 1 12 255 256.1 1.2.3.4 4111-1111-1111-1111 4111111111111111 - + +1(234) ( ) % é 日 +12345678 :: a: "
    "http://u:p@h.c 0000 abc@d.ef (at) [dot] tel: fe80::1:2:3 İ 007.1.1.1 0.0.0.0 --"
).split() + [" ", "\n", "iban DE89370400440532013000", "account no: 12345678 and", "ssn 078-05-1120", "4111 1111 1111 1111"]


def test_base_spans_of_random_texts():
    rng = random.Random(3)
    for _ in range(8000):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 14)))
        found = P.spans(text)
        assert [x for x in found if x[0] in P.BASE] == base(text), text
        assert found == sorted(found, key=lambda x: (P.KINDS.index(x[0]), x[1]))
        assert all(0 <= a < b <= len(text) for _, a, b in found)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("mail josé.niño@exämple.com now", [("email_intl", "josé.niño@exämple.com")]),
        ("to lès.24@mail3.example.com", [("email", "s.24@mail3.example.com"), ("email_intl", "lès.24@mail3.example.com")]),
        ("john (at) example (dot) com.", [("email_spelled", "john (at) example (dot) com")]),
        ("john[at]example.com", [("email_spelled", "john[at]example.com")]),
        ("see ftp://joe:secret@host/x", [("login", "joe:secret")]),
        ("see https://host.org/a@b", []),
        ("tel:030-1234567, motel:1234567", [("tel", "030-1234567")]),
        ("addr 2001:db8::ff00:42:8329 x", [("ipv6", "2001:db8::ff00:42:8329")]),
        ("1:2:3:4:5:6:7:8", [("ipv6", "1:2:3:4:5:6:7:8")]),
        ("std::vector 12:30:45 a:b:c ::1 dad::", []),
        ("IBAN: GB82 WEST 1234 5698 7654 32 thanks", [("iban", "GB82 WEST 1234 5698 7654 32")]),
        ("IBAN: GB82 WEST 1234 5698 7654 33 thanks", []),
        ("Account number: 00123456 and more words", [("account", "00123456")]),
        ("passport no. X1234567, ssn: 078-05-1120", [("account", "X1234567"), ("account", "078-05-1120")]),
        ("an account of 1984 and accounts 123456", []),
        ("card 4111 1111 1111 1111, not 4111 1111 1111 1112", [("card", "4111 1111 1111 1111")]),
        ('token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"', []),
        ("", []),
    ],
)
def test_cases(text, expected):
    assert [(kind, text[a:b]) for kind, a, b in P.spans(text)] == expected


def test_long_runs_take_time_in_proportion():
    """Long runs of one kind of character; the plain expressions would try each place of them to its end."""
    for piece in ("1", "1 ", "1.", "+1", "a@", "a:"):
        assert [x for x in P.spans(piece * 800) if x[0] in P.BASE] == base(piece * 800)
    for piece in ("1", "1 ", "+1", "a@", "a:"):
        assert P.spans(piece * 100_000) == []
    assert len(P.spans("1." * 100_000)) == 25_000
    assert P.spans("x" * 300_000 + "@") == []


def test_edge_rows(edge, edge_rows, nothing):
    got = sorted(((r.doc_id, [tuple(s) for s in r.spans]) for r in P.find(edge).collect()), key=repr)
    assert got == sorted(((d, P.spans(t or "")) for d, t, *_ in edge_rows), key=repr)
    assert P.find(nothing).collect() == []


def test_redaction_keeps_other_columns(spark):
    rows = [(1, "write to a.b@c.de or +1 (234) 555-0000", "x", 7), (2, None, "y", None), (None, "", "z", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, __id int")
    got = P.redact(docs)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [(1, "write to <email> or <phone>", "x", 7), (2, None, "y", None), (None, "", "z", 1)], key=repr
    )
    assert P.hidden("ftp://joe:pass@host.org") == "ftp://<login>"


def test_query_digests(spark, small, documents):
    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    got = op11_personal_data(spark, small).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        found = base(texts[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == kind for k, _, _ in found) for kind in P.BASE)
        written = ",".join(f"{k}:{a}:{b}" for k, a, b in found)
        assert r.base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        assert r.spans == ",".join(f"{k}:{a}:{b}" for k, a, b in P.spans(texts[r.doc_id]))
        assert r.spans.startswith(written)
