"""Fill-in-middle transformation with a sparse exception index.

Cuts fall on lines (found as bytes) or characters (counted as code points), so positions must be converted both ways. In
UTF-8 a code point and its byte differ only by what multibyte characters before it take beyond one byte. The index holds
just those characters: their byte position and the running sum of their excess bytes. A position is converted by one
``searchsorted`` among them plus an addition; where a text is ASCII there is nothing to search and both numbers are equal.

One index serves a whole batch of texts, which lie one after another in the batch's buffer: a position within a text is a
position in the buffer less the text's start, in bytes as well as in code points. So all cuts of a batch are found at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vantage.llm.common import col, settle_in, ship, slices

# Fixed values of the output's form.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
UNITS = ("line", "char")
NEWLINE = 10


class ExceptionIndex:
    """Multibyte characters of UTF-8 bytes: ``at`` their first bytes, ``excess`` the bytes beyond one per character that
    lie before each of them (and, last, in all)."""

    def __init__(self, data: np.ndarray):
        self.at = np.flatnonzero(data >= 0xC0)
        lead = data[self.at]
        more = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.excess = np.concatenate([[0], np.cumsum(more)])
        self.chars = self.at - self.excess[:-1]  # the same characters, counted in code points

    def to_chars(self, byte: np.ndarray) -> np.ndarray:
        """Code points before each byte position (which must be a character's first byte, or the end)."""
        return byte - self.excess[np.searchsorted(self.at, byte)]

    def to_bytes(self, char: np.ndarray) -> np.ndarray:
        """First byte of each code point (or the end)."""
        return char + self.excess[np.searchsorted(self.chars, char)]


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, n + 1 offsets into them) of a text batch without nulls."""
    texts = texts.cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), ends


def draws(keys: list[int | None], seed: int) -> np.ndarray:
    """n x 4 numbers below 2^32: the first four 8-digit groups of the hex SHA-256 of ``seed:key`` (zeros for a null key)."""
    found = b"".join(hashlib.sha256(b"%d:%d" % (seed, k)).digest()[:16] if k is not None else bytes(16) for k in keys)
    return np.frombuffer(found, ">u4").reshape(-1, 4).astype(np.int64)


def plan(texts: pa.Array, keys: list[int | None], seed: int, unit: str, rate: int, spm: int) -> dict[str, np.ndarray]:
    """Per text: n units, the form (0 plain, 1 psm, 2 spm), and the two cuts as bytes of the batch and as code points
    of the text."""
    data, ends = _buffers(texts)
    # the buffer may hold more than this slice: positions are counted from its first byte
    origin, data = (int(ends[0]), data[ends[0]:ends[-1]]) if len(ends) else (0, data)
    start, stop = ends[:-1] - origin, ends[1:] - origin
    index = ExceptionIndex(data)
    first = index.to_chars(start)
    h = draws(keys, seed)
    if unit == "line":
        breaks = np.flatnonzero(data == NEWLINE)
        lo, hi = np.searchsorted(breaks, start), np.searchsorted(breaks, stop)
        open_end = (stop > start) & (data[np.maximum(stop - 1, 0)] != NEWLINE) if len(data) else np.zeros(len(start), bool)
        n = hi - lo + open_end
        after = np.concatenate([breaks + 1, [0]])

        def cut(k: np.ndarray) -> np.ndarray:
            at = after[np.minimum(lo + np.maximum(k, 1) - 1, len(breaks))]
            return np.where(k == 0, start, np.where(k <= hi - lo, at, stop))
    else:
        n = index.to_chars(stop) - first

        def cut(k: np.ndarray) -> np.ndarray:
            return index.to_bytes(first + k)

    one, two = h[:, 0] % (n + 1), h[:, 1] % (n + 1)
    a, b = cut(np.minimum(one, two)), cut(np.maximum(one, two))
    whole = data.tobytes()
    marked = _marked(whole, stop)
    plain = (stop == start) | marked | (h[:, 2] % 100 >= rate) | np.array([k is None for k in keys], bool)
    return {"n": n, "form": np.where(plain, 0, np.where(h[:, 3] % 100 < spm, 2, 1)), "start": start, "stop": stop, "a": a, "b": b,
            "prefix_chars": index.to_chars(a) - first, "middle_chars": index.to_chars(b) - index.to_chars(a),
            "data": whole}


def _marked(whole: bytes, stop: np.ndarray) -> np.ndarray:
    """Which texts hold a sentinel. One that straddles two texts of the buffer is in neither."""
    found = np.zeros(len(stop), bool)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        m, at = mark.encode(), -1
        while (at := whole.find(m, at + 1)) >= 0:
            k = int(np.searchsorted(stop, at, "right"))
            found[k] |= at + len(m) <= stop[k]
    return found


def _outputs(p: dict) -> list[bytes]:
    whole, out = p["data"], []
    for form, s, a, b, e in zip(p["form"].tolist(), p["start"].tolist(), p["a"].tolist(), p["b"].tolist(), p["stop"].tolist()):
        if form == 0:
            out.append(whole[s:e])
        elif form == 1:
            out.append(b"<P>%b<S>%b<M>%b" % (whole[s:a], whole[b:e], whole[a:b]))
        else:
            out.append(b"<S>%b<P>%b<M>%b" % (whole[b:e], whole[s:a], whole[a:b]))
    return out


def transform(docs: DataFrame, text: str = "text", key: str = "doc_id", keep: tuple[str, ...] = ("doc_id",), seed: int = 7,
              unit: str = "line", rate: int = 100, spm: int = 50) -> DataFrame:
    """The columns ``keep`` of ``docs`` with n, form, prefix_chars, middle_chars and output (the rearranged text).

    A text of n ``unit``s (lines with their line feed, or characters) is cut at two of its n + 1 places, both drawn from a
    hash of ``seed`` and ``key``. Of 100 texts ``rate`` are rearranged, and of 100 of these ``spm`` suffix first.
    A text is left plain if it is empty or null (then output is empty), has a sentinel in it, or has a null key; then
    prefix_chars and middle_chars are null. Repeated rows give repeated results, an empty table none. Texts are taken a few
    megabytes at a time, a long one whole. ``keep`` must not name the new columns.
    """
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}")
    ship(docs.sparkSession)
    rows = docs.select(*map(col, keep), col(key).cast("long").alias("_key"), F.coalesce(col(text), F.lit("")).alias("_text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-2]]
    names = np.array([PLAIN, PSM, SPM])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settle_in(__name__)
        for batch in batches:
            at = 0
            for part in slices(batch.column(len(keep) + 1)):
                rows_here = [c.slice(at, len(part)) for c in batch.columns]
                at += len(part)
                p = plan(part, rows_here[-2].to_pylist(), seed, unit, rate, spm)
                plain = p["form"] == 0
                yield pa.RecordBatch.from_arrays(
                    [*rows_here[:-2], pa.array(p["n"], pa.int64()), pa.array(names[p["form"]].tolist(), pa.string()),
                     pa.array(p["prefix_chars"], pa.int64(), mask=plain), pa.array(p["middle_chars"], pa.int64(), mask=plain),
                     pa.array(_outputs(p), pa.binary()).cast(pa.string())],
                    [*keep, "n", "form", "prefix_chars", "middle_chars", "output"])

    return rows.mapInArrow(run, ", ".join([*fields, "n long", "form string", "prefix_chars long", "middle_chars long",
                                           "output string"]))


def restored(output: Column | str = "output", form: Column | str = "form") -> Column:
    """The text that ``output`` of the given form was made from, in Spark's own string functions. The text holds no
    sentinel, so the first one found is the one put there. Nulls give null."""
    out, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    head, middle = F.substring_index(out, MIDDLE, 1), F.substring_index(out, MIDDLE, -1)
    psm = F.concat(F.replace(F.substring_index(head, SUFFIX, 1), F.lit(PREFIX), F.lit("")), middle, F.substring_index(head, SUFFIX, -1))
    spm_ = F.concat(F.substring_index(head, PREFIX, -1), middle,
                    F.replace(F.substring_index(head, PREFIX, 1), F.lit(SUFFIX), F.lit("")))
    return F.when(form == PSM, psm).when(form == SPM, spm_).otherwise(out)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256 of every row."""
    return transform(docs).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output"), 256).alias("output_sha256"),
        F.sha2(restored(), 256).alias("restored_sha256"))


#: The same for DuckDB, with texts cut into lists of lines.
ORACLE_SQL = r"""WITH cut AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
    sha256('7:' || doc_id) AS h FROM documents),
drawn AS (SELECT *, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS x, CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS y,
    CAST('0x' || h[25:32] AS BIGINT) % 100 < 50 AS suffix_first,
    t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h IS NULL AS plain FROM cut),
parts AS (SELECT *, array_to_string(u[1:least(x, y)], '') AS p, array_to_string(u[least(x, y) + 1:greatest(x, y)], '') AS m,
    array_to_string(u[greatest(x, y) + 1:], '') AS s FROM drawn)
SELECT doc_id, n, CASE WHEN plain THEN 'plain' WHEN suffix_first THEN 'spm' ELSE 'psm' END AS form,
  CASE WHEN NOT plain THEN length(p) END AS prefix_chars, CASE WHEN NOT plain THEN length(m) END AS middle_chars,
  sha256(CASE WHEN plain THEN t WHEN suffix_first THEN '<S>' || s || '<P>' || p || '<M>' || m
              ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts"""
