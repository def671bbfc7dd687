import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from seqlake.llm import personal_data as pd_

PIECES = ["a@b.co", "x.y+z@m-1.example.com", "@", ".", "1.2.3.4", "256.1.1.1", "1.2.3.4.5", "007.0.0.255",
          "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 010-9999", "+12", " ", "-", "a", "9",
          "\n", "é", "378282246310005", "+44 20 7946 0958 ", "00000000000000"]


def brute(text):
    """The patterns as they are given, without shortcuts."""
    out = [("email", *m.span()) for m in
           re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in
            re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        total = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits[::-1]))
        if 14 <= len(digits) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    order = pd_.BASE_KINDS.index
    return sorted(out, key=lambda s: (s[1], order(s[0])))


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=12).map("".join))
def test_base_spans_are_the_patterns(text):
    assert pd_.base_spans(text)[0] == brute(text)


def test_long_runs_are_linear():
    for text in ("1" * 200_000, "999." * 50_000, "a@" * 100_000, "+" + "1 " * 100_000, "x" * 200_000):
        assert pd_.base_spans(text)[0] == []


def test_classes_cannot_trade_places():
    harmless, secret = "0-00000", "+0+0++0"
    for counts in ([1, 1000], [1000, 1]):
        model = pd_.train([harmless, secret], counts)
        assert model.accepts(secret) and not model.accepts(harmless)
        assert (model.reliability >= pd_.LEAST).all()


SECRET = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b"


def test_spans_of_rows(spark, documents):
    plain = "wörds a.b@example.org and 10.0.0.1, +1 (555) 010-9999 "
    rows = [(1, None), (2, ""), (3, plain), (3, plain), (None, f'token = "{SECRET}"'),
            (4, "number 1234567890123456 here"), (5, "no data at all")]
    rows += [(100 + i, f'key: "{hashlib.sha1(str(i).encode()).hexdigest()}"') for i in range(20)]
    got = {}
    for r in pd_.find_spans(documents(rows)).collect():
        got.setdefault(r["doc_id"], []).append(r)
    base = "email:6:21,ip:26:34,phone:36:53"
    for r in got[3]:
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == (1, 1, 0, 1)
        assert r["spans"] == base
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
    assert len(got[3]) == 2
    assert got[None][0]["spans"] == "secret:9:49"
    assert [got[i][0]["spans"] for i in (1, 2, 4, 5)] == [""] * 4
    assert pd_.find_spans(documents([])).collect() == []


def test_redaction(spark, documents):
    docs = documents([(1, f'a@b.co <{SECRET}> token="{SECRET}"'), (2, None), (3, "clean")])
    rows = {r["doc_id"]: r for r in pd_.redact_documents(docs).collect()}
    assert rows[1]["text"] == '[EMAIL] <[SECRET]> token="[SECRET]"'
    assert rows[1]["n_chars"] == len(rows[1]["text"])
    assert (rows[2]["text"], rows[2]["n_chars"], rows[3]["text"]) == (None, None, "clean")
    assert pd_.redact_documents(docs).columns == docs.columns
