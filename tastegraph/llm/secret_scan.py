"""Secret scans: an Aho-Corasick keyword prefilter, anchored expressions only near hits, then
embedded checksum validation.

One automaton holds the keywords of all kinds, and one pass over the ASCII-lower-cased
UTF-8 bytes of a text finds them. A kind's expression is tried only at its hits, anchored
there. The kinds, in the order in which ties are listed:

    assign   keyword, = or :, value of at least 6 characters
    access   AKIA and 16 or more capitals or digits
    hex      24 or more of 0-9 a-f (it has no keyword: maximal runs are found directly)
    github   ghp_ gho_ ghu_ ghs_ ghr_, 30 characters and the CRC-32 of them in 6 base-62 digits
    npm      npm_, 30 characters and their CRC-32 in 6 base-62 digits
    jwt      eyJ... three base64url parts whose head decodes to a JSON object with "alg"
    pem      -----BEGIN ... PRIVATE KEY----- to its END line
    slack    xoxb- xoxa- xoxp- xoxr- xoxs-, groups of digits, a secret of 20 or more
    google   AIza and 35 characters
    stripe   sk_live_ or rk_live_ and 20 or more letters or digits

Within a kind, matches are leftmost and do not overlap; spans of different kinds may.
``assign`` consumes a match whose value is too short, as a plain scan would.

Spans are given in code points, end exclusive. Defined cases: null and empty texts have no
spans; a text of any length is scanned whole; rows are independent, so repeated rows and
null ids (kept) need nothing special; an empty table gives an empty result; other columns
are ignored by the scan and kept by ``redact_secrets``.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.llm.common import byte_texts, slices_by_bytes

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "github", "npm", "jwt", "pem", "slack", "google", "stripe")

# fixed values: the kinds' keywords (lower case) and expressions
KEYWORDS = {
    "assign": (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key"),
    "access": (b"akia",),
    "github": (b"ghp_", b"gho_", b"ghu_", b"ghs_", b"ghr_"),
    "npm": (b"npm_",),
    "jwt": (b"eyj",),
    "pem": (b"-----begin ",),
    "slack": (b"xoxa-", b"xoxb-", b"xoxp-", b"xoxr-", b"xoxs-"),
    "google": (b"aiza",),
    "stripe": (b"sk_live_", b"rk_live_"),
}
EXPRESSIONS = {
    "assign": re.compile(rb"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"),
    "access": re.compile(rb"AKIA[A-Z0-9]+"),
    "github": re.compile(rb"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])"),
    "npm": re.compile(rb"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])"),
    "jwt": re.compile(rb"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{16,}"),
    "pem": re.compile(rb"-----BEGIN ([A-Z0-9 ]{0,40}PRIVATE KEY)-----(?:(?!-----BEGIN )[\x00-\xff])+?"
                      rb"-----END \1-----"),
    "slack": re.compile(rb"xox[abprs]-(?:[0-9]{6,}-){1,3}[A-Za-z0-9]{20,}"),
    "google": re.compile(rb"AIza[A-Za-z0-9_-]{35}(?![A-Za-z0-9_-])"),
    "stripe": re.compile(rb"[sr]k_live_[A-Za-z0-9]{20,}"),
}
HEX_RUN = re.compile(rb"[0-9a-f]{24,}")
DIGITS_62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def base62(number: int, width: int) -> bytes:
    out = ""
    for _ in range(width):
        number, digit = divmod(number, 62)
        out = DIGITS_62[digit] + out
    return out.encode()


def _checked_token(m: re.Match) -> bool:
    body = m.group()[4:]
    return base62(zlib.crc32(body[:30]), 6) == body[30:]


def _json_head(m: re.Match) -> bool:
    head = m.group().split(b".")[0]
    try:
        found = json.loads(base64.urlsafe_b64decode(head + b"=" * (-len(head) % 4)))
    except (binascii.Error, ValueError):
        return False
    return isinstance(found, dict) and "alg" in found


VALID = {
    "assign": lambda m: len(m.group(2)) >= 6,
    "access": lambda m: len(m.group()) >= 20,
    "github": _checked_token,
    "npm": _checked_token,
    "jwt": _json_head,
}


class Scanner:
    def __init__(self):
        self.automaton = ahocorasick.Automaton()
        for kind, words in KEYWORDS.items():
            for word in words:
                self.automaton.add_word(word.decode("ascii"), (kind, len(word)))
        self.automaton.make_automaton()

    def byte_spans(self, text: bytes) -> list[tuple[int, int, int]]:
        """(start, place of the kind in KINDS, end) in bytes, sorted."""
        spans = [(m.start(), KINDS.index("hex"), m.end()) for m in HEX_RUN.finditer(text)]
        hits: dict[str, list[int]] = {}
        # latin-1 gives one character a byte, so places are byte places
        for last, (kind, length) in self.automaton.iter(text.lower().decode("latin-1")):
            hits.setdefault(kind, []).append(last - length + 1)
        for kind, starts in hits.items():
            expression, valid, free = EXPRESSIONS[kind], VALID.get(kind), 0
            for start in sorted(set(starts)):
                if start >= free and (m := expression.match(text, start)):
                    free = m.end()
                    if valid is None or valid(m):
                        spans.append((start, KINDS.index(kind), free))
        return sorted(spans)

    def spans(self, text: bytes) -> list[tuple[str, int, int]]:
        """(kind, start, end) in code points, by start, then kind."""
        found = self.byte_spans(text)
        if not found:
            return []
        if text.isascii():
            return [(KINDS[k], a, b) for a, k, b in found]
        points = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
        before = np.r_[0, points]
        return [(KINDS[k], int(before[a]), int(before[b])) for a, k, b in found]


def listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


SPANS_SCHEMA = "doc_id long, spans array<struct<kind:string,start:long,end:long>>"
SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def secret_spans(docs: DataFrame) -> DataFrame:
    """doc_id and the spans of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in slices_by_bytes(batches, "text", 8 << 20):
            rows = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in scanner.spans(t)]
                    for t in byte_texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, SPAN_TYPE)],
                                             names=["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SPANS_SCHEMA)


def secret_digest(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, the SHA-256 of their list, and the list of all spans."""
    found = secret_spans(docs)
    text = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in BASE_KINDS],
                        F.sha2(F.concat_ws(",", F.transform(base, text)).cast("binary"), 256).alias("base_sha256"),
                        F.concat_ws(",", F.transform("spans", text)).alias("spans"))


def redact_secrets(docs: DataFrame, mark: str = "<{kind}>") -> DataFrame:
    """docs with every span of ``text`` replaced by a mark of its kind (overlapping spans by the
    mark of the first); all rows and other columns stay, and n_chars, if there, follows."""
    fields = docs.schema
    place = fields.fieldNames().index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in slices_by_bytes(batches, "text", 8 << 20):
            out = []
            for raw, there in zip(byte_texts(batch.column("text")), batch.column("text").is_valid().to_pylist(),
                                  strict=True):
                pieces, at = [], 0
                for start, kind, end in scanner.byte_spans(raw):
                    if start >= at:
                        pieces += [raw[at:start], mark.format(kind=KINDS[kind]).encode()]
                    at = max(at, end)
                out.append(b"".join([*pieces, raw[at:]]).decode("utf-8") if there else None)
            columns = list(batch.columns)
            columns[place] = pa.array(out, batch.schema.field(place).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    done = docs.mapInArrow(run, fields)
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.coalesce(F.length("text"), F.col("n_chars"))
                               .cast(fields["n_chars"].dataType))
    return done.select(*docs.columns)
