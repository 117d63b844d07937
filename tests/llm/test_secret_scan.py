import base64
import hashlib
import json
import re
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from tastegraph.llm import secret_scan as ss

from .fixtures import no_docs, odd_docs, odd_rows

ASSIGN = re.compile(r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|"
                    r"[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")


def brute(text):
    spans = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    spans += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans, key=lambda s: (s[1], ss.KINDS.index(s[0])))


def base(text):
    return [s for s in ss.Scanner().spans(text.encode()) if s[0] in ss.BASE_KINDS]


PIECES = st.sampled_from(["password", "PassWD", "secret", "tokEN", "apikey", "API_key", "=", ":", " ", "'", '"', "abc", "Zz9/+",
                          "AKIA", "A1B2C3D4E5F6G7H8", "0123456789ab", "deadbeef", "é", "\n", "ſecret", "toKen", "_", "x"])


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, max_size=14).map("".join))
def test_base_spans_equal_plain_scans(text):
    assert base(text) == brute(text)


def test_overlaps_and_short_values():
    for text in ("password=secret=token=abcdef", "token: abc secret: abcdefgh", "api_key = '" + "0f" * 20, "AKIAAKIA" + "Z" * 16,
                 "passwordpassword='abcdefg", "secret=" + "AKIA" + "Q" * 20, "x" * 200_000 + "token=abcdef"):
        assert base(text) == brute(text)


def github(body):
    return "ghp_" + body + ss.base62(zlib.crc32(body.encode()), 6).decode()


def test_checksums_are_validated():
    good = github("a1B2" * 7 + "zz")
    scan = lambda t: [(k, t[a:b]) for k, a, b in ss.Scanner().spans(t.encode())]
    assert scan(f"é {good}.") == [("github", good)]
    assert scan(good[:-1] + ("0" if good[-1] != "0" else "1")) == []
    assert scan(good.replace("ghp_", "npm_")) == [("npm", good.replace("ghp_", "npm_"))]
    head = base64.urlsafe_b64encode(json.dumps({"alg": "HS256"}).encode()).decode().rstrip("=")
    assert [k for k, _ in scan(f"{head}.{'ab12' * 5}.{'Cd34' * 8}")] == ["jwt"]
    assert scan(f"eyJ{'x' * 20}.{'ab12' * 5}.{'Cd34' * 8}") == []
    pem = "-----BEGIN RSA PRIVATE KEY-----\nMIIB\n-----END RSA PRIVATE KEY-----"
    assert scan(f"a {pem} b") == [("pem", pem)]


def test_digest_of_odd_rows(spark):
    got = sorted((str(r.doc_id), r.n_assign, r.n_access, r.n_hex, r.base_sha256)
                 for r in ss.secret_digest(odd_docs(spark)).collect())
    want = []
    for i, text, *_ in odd_rows():
        spans = brute(text or "")
        n = [sum(s[0] == k for s in spans) for k in ss.BASE_KINDS]
        want.append((str(i), *n, hashlib.sha256(ss.listed(spans).encode()).hexdigest()))
    assert got == sorted(want)


def test_redaction_keeps_everything_else(spark):
    docs = odd_docs(spark)
    out = ss.redact_secrets(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[9].text == "<assign> and <access> <hex>" and rows[9].n_chars == len(rows[9].text)
    assert rows[3].text is None and rows[4].text == "" and rows[3].n_chars is None
    texts = {r.text for r in out.collect()}
    assert {r[1] for r in odd_rows() if r[0] != 9} <= texts


def test_empty_table(spark):
    assert ss.secret_digest(no_docs(spark)).collect() == []
    assert ss.redact_secrets(no_docs(spark)).collect() == []
