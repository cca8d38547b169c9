import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from cardwatch.llm import pii as P
from llm_cases import clashing_docs, edge_docs, EDGE_ROWS, no_docs, rows_of, sf  # noqa: F401

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))
                    or kind == "card" and 14 <= len(digits) <= 19 and luhn(digits)
                    or kind == "phone" and 10 <= len(digits) <= 15):
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], P.KINDS.index(s[2])))


def base(text):
    return [s for s in P.find_spans(text) if s[2] in P.BASE]


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="0123456789 -.+()@aZ_%é\U0001f600\n", max_size=60))
def test_base_spans_equal_the_patterns(text):
    assert base(text) == brute(text)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 010-2030", "10.0.0.255", "256.1.1.1",
                                 "1.2.3.4.5.6.7.8", "a@b.co", "a@b@c.org", "x.y+z@mail-1.example.com", "@", ".", " ", "-", "5",
                                 "+", "١", "account no. 123456789", "https://u:p@h.example/x"]), max_size=8))
def test_base_spans_equal_the_patterns_on_pieces(parts):
    text = "".join(parts)
    assert base(text) == brute(text)


def test_added_kinds():
    def kinds(text):
        return [(k, text[a:b]) for a, b, k in P.find_spans(text)]

    assert kinds("see ftp://bob:pw1@host.example/x") == [
        ("login", "ftp://bob:pw1@host.example"), ("email", "pw1@host.example")]
    assert kinds("IBAN: GB82 WEST 1234 5698 7654 32.") == [("iban", "GB82 WEST 1234 5698 7654 32")]
    assert kinds("IBAN: GB83 WEST 1234 5698 7654 32.") == []
    # an upper-case word after it, a far cue, a failed one before it, and the next cue's own
    assert kinds("IBAN: ES91 2100 0418 4502 0005 1332 BIC CAIXESBB") == [("iban", "ES91 2100 0418 4502 0005 1332")]
    far = "IBAN of the account that was named in the letter of last week and again in the one before: GB82WEST12345698765432"
    assert kinds(far) == [("iban", "GB82WEST12345698765432")]
    assert kinds("IBAN GB83 WEST 1234 5698 7654 32, or GB82 WEST 1234 5698 7654 32") == [("iban", "GB82 WEST 1234 5698 7654 32")]
    assert kinds("IBAN: none. iban: NO93 8601 1117 947 x") == [("iban", "NO93 8601 1117 947")]
    assert kinds("Account No: 00123456, please") == [("account", "00123456")]
    assert kinds("accountable for 123456789 things, an accounting 123456") == []


def test_edges(edge_docs, clashing_docs, no_docs):
    want = []
    for d, t, *_ in EDGE_ROWS:
        spans = brute(t or "") if len(t or "") < 1000 else []
        want.append((d, *[sum(s[2] == k for s in spans) for k in P.BASE],
                     hashlib.sha256(P.joined(spans).encode()).hexdigest()))
    want.sort(key=lambda r: tuple((x is None, str(x)) for x in r))
    cols = ("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    for docs in (edge_docs, clashing_docs):
        assert rows_of(P.op5_pii(docs), *cols) == want
    assert P.find_personal_data(clashing_docs).count() == len(EDGE_ROWS)
    assert P.op5_pii(no_docs).count() == 0


def test_whole_table_equals_the_patterns(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: r.spans for r in P.op5_pii(docs).collect()}
    for r in docs.collect():
        assert [s for s in got[r.doc_id].split(",") if s.split(":")[0] in P.BASE] == (
            [x for x in P.joined(brute(r.text or "")).split(",")] if brute(r.text or "") else [])


def test_masking(spark):
    docs = spark.createDataFrame([(1, "mail a.b@c.org or +1 (555) 010-2030 now"), (2, None), (3, "")], "doc_id long, text string")
    assert rows_of(P.mask_personal_data(docs)) == [(1, "mail [email] or [phone] now"), (2, None), (3, "")]
