"""Fill-in-the-middle transformation by displacement scatter.

A text is cut at two token boundaries into prefix, middle and suffix, which are written in
another order behind marks (``spm``: suffix, prefix, middle; ``psm``: prefix, suffix,
middle), or it stays as it is (``plain``).

All texts of a batch lie in one byte array. One scan over it finds the ends of the tokens
and so the cuts. Each segment moves as a whole, so a difference array with one entry at
the start of each segment (its displacement less that of the segment before) has, as its
cumulative sum, the displacement of every byte; one scatter writes the outputs and another
the marks. Restoring scans the output for its marks, builds the displacements from the
other side the same way, and gathers the bytes back. The sums are taken over ``CHUNK``
bytes at a time, so beside the bytes themselves only masks and token ends grow with a text.

Which documents are transformed, how, and where they are cut follows from the SHA-256 of the
seed and doc_id, computed by Spark; nothing is shuffled, and a rerun gives the same result.

Defined cases: a null text is empty and stays plain. A null doc_id counts as empty text in
the hash. A text that holds a mark stays plain. Rows with equal doc_id are cut by the same
hash numbers. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegraph.llm.common import byte_texts, slices_by_bytes

# fixed values: the marks and the white space that parts tokens (space and U+0009 to U+000D)
MARK_BYTES = {"P": b"<P>", "S": b"<S>", "M": b"<M>"}
MARK = 3
FORMS = ("plain", "psm", "spm")
CHUNK = 1 << 20
SLICE_BYTES = 4 << 20


class Texts:
    """The texts of a batch in one byte array: text i is data[start[i]:end[i]]."""

    def __init__(self, raw: list[bytes]):
        self.data = np.frombuffer(b"".join(raw), np.uint8)
        self.end = np.cumsum([len(t) for t in raw], dtype=np.int64)
        self.start = self.end - np.array([len(t) for t in raw], np.int64)

    def token_ends(self) -> np.ndarray:
        """Where tokens end: behind a word, and at the end of a text."""
        space = (self.data == 0x20) | ((self.data >= 0x09) & (self.data <= 0x0D))
        ends = np.zeros(len(self.data), bool)
        ends[:-1] = ~space[:-1] & space[1:]
        ends[self.end[self.end > self.start] - 1] = True
        return np.flatnonzero(ends) + 1

    def marks(self) -> tuple[np.ndarray, np.ndarray]:
        """Place and text of every mark."""
        d = self.data
        if len(d) < MARK:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        letter = np.isin(d[1:-1], np.frombuffer(b"PSM", np.uint8))
        at = np.flatnonzero((d[:-2] == ord("<")) & letter & (d[2:] == ord(">")))
        text = np.searchsorted(self.end, at, side="right")
        inside = at + MARK <= self.end[text]
        return at[inside], text[inside]


def displacements(starts: np.ndarray, shifts: np.ndarray, total: int) -> Iterator[tuple[int, np.ndarray]]:
    """The displacement of each of ``total`` bytes, ``CHUNK`` at a time, where the segment that
    begins at starts[k] (ascending; empty segments share a start) moves by shifts[k]."""
    steps = np.diff(shifts, prepend=0)
    carry = 0
    for at in range(0, total, CHUNK):
        size = min(CHUNK, total - at)
        low, high = np.searchsorted(starts, [at, at + size])
        difference = np.zeros(size, np.int64)
        np.add.at(difference, starts[low:high] - at, steps[low:high])
        difference[0] += carry
        moved = np.cumsum(difference)
        carry = int(moved[-1])
        yield at, moved


def _layout(form: np.ndarray, prefix: np.ndarray, middle: np.ndarray, suffix: np.ndarray) -> tuple[np.ndarray, ...]:
    """Where prefix, middle and suffix begin in an output, and its length."""
    psm, spm = form == 1, form == 2
    marked = psm | spm
    zero = np.zeros_like(prefix)
    at_prefix = np.where(psm, MARK, np.where(spm, 2 * MARK + suffix, zero))
    at_suffix = np.where(psm, 2 * MARK + prefix, np.where(spm, MARK, prefix + middle))
    at_middle = np.where(marked, 3 * MARK + prefix + suffix, prefix)
    return at_prefix, at_middle, at_suffix, prefix + middle + suffix + 3 * MARK * marked


def transform(raw: list[bytes], h: np.ndarray, percent: int, spm_percent: int) -> tuple[list, ...]:
    """n, form, prefix and middle code points (None if plain) and output of each text; ``h`` has
    four hash numbers a row."""
    texts = Texts(raw)
    ends = texts.token_ends()
    first = np.searchsorted(ends, texts.start, side="right")
    n = np.searchsorted(ends, texts.end, side="right") - first
    one, two = h[:, 0] % (n + 1), h[:, 1] % (n + 1)
    bounds = np.r_[ends, 0]

    def place(units: np.ndarray) -> np.ndarray:
        return np.where(units > 0, bounds[np.where(units > 0, first + units - 1, -1)], texts.start)

    cut, cut2 = place(np.minimum(one, two)), place(np.maximum(one, two))
    plain = (texts.end == texts.start) | (h[:, 2] % 100 >= percent)
    plain[texts.marks()[1]] = True
    form = np.where(plain, 0, np.where(h[:, 3] % 100 < spm_percent, 2, 1))
    prefix, middle, suffix = cut - texts.start, cut2 - cut, texts.end - cut2
    at_prefix, at_middle, at_suffix, length = _layout(form, prefix, middle, suffix)
    out_end = np.cumsum(length)
    out_start = out_end - length
    starts = np.stack([texts.start, cut, cut2], axis=1)
    shifts = np.stack([at_prefix, at_middle, at_suffix], axis=1) + out_start[:, None] - starts
    out = np.empty(int(length.sum()), np.uint8)
    for at, moved in displacements(starts.ravel(), shifts.ravel(), len(texts.data)):
        out[np.arange(at, at + len(moved)) + moved] = texts.data[at:at + len(moved)]
    for letter, behind in (("P", at_prefix), ("M", at_middle), ("S", at_suffix)):
        to = (out_start + behind)[~plain] - MARK
        out[to[:, None] + np.arange(MARK)] = np.frombuffer(MARK_BYTES[letter], np.uint8)
    points = np.r_[0, np.cumsum((texts.data & 0xC0) != 0x80, dtype=np.int64)]
    whole = out.tobytes()
    return (n.tolist(), [FORMS[f] for f in form.tolist()],
            [None if p else int(x) for p, x in zip(plain, points[cut] - points[texts.start], strict=True)],
            [None if p else int(x) for p, x in zip(plain, points[cut2] - points[cut], strict=True)],
            [whole[a:b] for a, b in zip(out_start.tolist(), out_end.tolist(), strict=True)])


def restore(outputs: list[bytes], forms: list[str]) -> list[bytes]:
    """The texts from which ``transform`` made the outputs."""
    texts = Texts(outputs)
    form = np.array([FORMS.index(f) for f in forms], np.int64)
    marked = np.flatnonzero(form > 0)
    at, text = texts.marks()
    at = at[form[text] > 0]
    if len(at) != 3 * len(marked) or (np.diff(text[form[text] > 0].reshape(-1, 3), axis=1) != 0).any():
        raise ValueError("an output does not hold its three marks")
    first, second, third = at.reshape(-1, 3).T + MARK
    head, tail, middle = second - MARK - first, third - MARK - second, texts.end[marked] - third
    spm = form[marked] == 2
    parts = np.zeros((3, len(outputs)), np.int64)  # sources of prefix, middle, suffix
    sizes = np.zeros((3, len(outputs)), np.int64)
    parts[0], sizes[0] = texts.start, texts.end - texts.start
    parts[1] = parts[2] = texts.end
    parts[:, marked] = np.where(spm, second, first), third, np.where(spm, first, second)
    sizes[:, marked] = np.where(spm, tail, head), middle, np.where(spm, head, tail)
    end = np.cumsum(sizes.sum(axis=0))
    begin = end - sizes.sum(axis=0)
    starts = np.stack([begin, begin + sizes[0], begin + sizes[0] + sizes[1]], axis=1)
    total = int(end[-1]) if len(end) else 0
    back = np.empty(total, np.uint8)
    for place, moved in displacements(starts.ravel(), (parts.T - starts).ravel(), total):
        back[place:place + len(moved)] = texts.data[np.arange(place, place + len(moved)) + moved]
    whole = back.tobytes()
    return [whole[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)]


def hash_numbers(seed: int, doc_id: str = "doc_id") -> list[Column]:
    """The first four 8-digit groups of the SHA-256 of ``seed:doc_id`` as numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def fill_in_middle(docs: DataFrame, seed: int = 42, percent: int = 50, spm_percent: int = 80) -> DataFrame:
    """doc_id, n (tokens), form, prefix_chars, middle_chars and output of every row; ``percent`` of
    the texts are transformed, ``spm_percent`` of these with the suffix first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices_by_bytes(batches, "text", SLICE_BYTES):
            h = np.stack([batch.column(f"h{k}").to_numpy(zero_copy_only=False) for k in range(4)], axis=1)
            n, form, prefix, middle, output = transform(byte_texts(batch.column("text")), h, percent, spm_percent)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                 pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    numbers = [c.alias(f"h{k}") for k, c in enumerate(hash_numbers(seed))]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *numbers).mapInArrow(run, SCHEMA)


def restored(transformed: DataFrame) -> DataFrame:
    """``transformed`` plus ``restored``, the exact text rebuilt from output and form."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices_by_bytes(batches, "output", SLICE_BYTES):
            texts = restore(byte_texts(batch.column("output")), batch.column("form").to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary()).cast(pa.string())],
                                             names=[*batch.schema.names, "restored"])

    return transformed.mapInArrow(run, f"{SCHEMA}, restored string")


def fim_digest(docs: DataFrame) -> DataFrame:
    sha = lambda c: F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256")
    return (restored(fill_in_middle(docs))
            .select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha("output"), sha("restored")))


ORACLE_SQL = r"""
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
  FROM documents),
numbers AS (
  SELECT *, len(units) AS n,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM hashed),
cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50
              THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers),
parts AS (
  SELECT *, coalesce(array_to_string(units[1:a], ''), '') AS p, coalesce(array_to_string(units[a + 1:b], ''), '') AS m,
         coalesce(array_to_string(units[b + 1:n], ''), '') AS s
  FROM cuts)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""
