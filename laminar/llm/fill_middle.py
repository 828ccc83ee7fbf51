"""Fill-in-middle: texts are cut at line ends into prefix, middle and suffix, and written out
with the middle last, by displacement scatter.

The texts of one Arrow batch are one run of bytes. A scan counts line ends at the borders of
the texts and finds the two line ends that each text is cut at. Every piece then has a
displacement: where it goes in the output less where it lies in the input. A difference
array holds, at the first byte of each piece, how its displacement differs from that of the
piece before; the cumulative sum gives every byte of the batch its own, and one numpy
scatter writes them all. The markers go into the gaps. Reading back works the other way
round: the markers of an output say where its pieces lie, and the same sums gather each
byte of the text from the output.

Memory: the batch, its output, and for the sums one window of ``WINDOW`` bytes, however
long a text is. Nothing is shuffled, a lost task is simply run again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laminar.llm.common import workers_import_package

# The markers of prefix, suffix and middle, as wide as each other.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
WIDTH = 3
NEWLINE = 10
WINDOW = 1 << 20  # bytes whose displacements are held at a time

MADE = "struct<n: bigint, form: string, prefix_chars: bigint, middle_chars: bigint, output: string>"


# --------------------------------------------------------------------------- batches as bytes

def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes of the batch, the limits of its texts in them); null counts as empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    limits = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.empty(0, np.uint8)
    return data[limits[0] : limits[-1]], limits - limits[0]


def _texts_of(data: np.ndarray, limits: np.ndarray, kind: pa.DataType) -> pa.Array:
    made = pa.Array.from_buffers(
        pa.large_string(), len(limits) - 1, [None, pa.py_buffer(limits), pa.py_buffer(data)]
    )
    return made.cast(kind)


def _windows(n: int) -> Iterator[tuple[int, int]]:
    for lo in range(0, n, WINDOW):
        yield lo, min(n, lo + WINDOW)


def _count_before(hits, n: int, at: np.ndarray) -> np.ndarray:
    """How many of ``hits(lo, hi)`` (a boolean array of a window) lie before each of ``at``
    (ascending)."""
    out = np.zeros(len(at), np.int64)
    seen = 0
    for lo, hi in _windows(n):
        found = np.flatnonzero(hits(lo, hi))
        first, stop = np.searchsorted(at, [lo, hi])
        out[first:stop] = seen + np.searchsorted(found, at[first:stop] - lo)
        seen += len(found)
    out[np.searchsorted(at, n) :] = seen
    return out


def _positions(hits, n: int, ranks: np.ndarray) -> np.ndarray:
    """Where the hits of the given ranks (from 0, in any order) lie."""
    out = np.zeros(len(ranks), np.int64)
    order = np.argsort(ranks, kind="stable")
    sorted_ranks = ranks[order]
    seen = 0
    for lo, hi in _windows(n):
        found = np.flatnonzero(hits(lo, hi))
        first, stop = np.searchsorted(sorted_ranks, [seen, seen + len(found)])
        out[order[first:stop]] = lo + found[sorted_ranks[first:stop] - seen]
        seen += len(found)
    return out


def _marker_at(data: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Whether a marker starts at each byte of the window."""
    seen = data[lo : hi + WIDTH - 1]
    whole = np.zeros(hi - lo, bool)
    n = len(seen) - WIDTH + 1
    if n > 0:
        kind = seen[1 : n + 1]
        whole[:n] = (seen[:n] == PREFIX[0]) & (seen[2 : n + 2] == PREFIX[2])
        whole[:n] &= (kind == PREFIX[1]) | (kind == SUFFIX[1]) | (kind == MIDDLE[1])
    return whole


def _displacements(starts: np.ndarray, shifts: np.ndarray, n: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(lo, hi, displacement of every byte lo..hi): pieces begin at ``starts`` (ascending)
    and move by ``shifts``. Of pieces that begin at one place only the last has bytes."""
    change = np.diff(shifts, prepend=0)
    carried = 0
    for lo, hi in _windows(n):
        first, stop = np.searchsorted(starts, [lo, hi])
        differences = np.zeros(hi - lo, np.int64)
        np.add.at(differences, starts[first:stop] - lo, change[first:stop])
        differences[0] += carried
        np.cumsum(differences, out=differences)
        carried = differences[-1]
        yield lo, hi, differences


# --------------------------------------------------------------------------- there and back

def scatter(texts: pa.Array, h: np.ndarray, rate: int, spm: int) -> pa.StructArray:
    """The batch transformed; ``h`` has the four random integers of each text as rows."""
    data, limits = _bytes_of(texts)
    n_bytes, begin, end = len(data), limits[:-1], limits[1:]
    newline = lambda lo, hi: data[lo:hi] == NEWLINE
    marker = lambda lo, hi: _marker_at(data, lo, hi)

    ends_before = _count_before(newline, n_bytes, limits)
    line_ends = np.diff(ends_before)
    full = end > begin
    open_line = full.copy()
    open_line[full] = data[end[full] - 1] != NEWLINE
    n = line_ends + open_line

    # a marker counts for a text only if it ends within it
    inside = np.maximum(begin, end - (WIDTH - 1))
    bounds = np.column_stack([begin, inside]).ravel()
    order = np.argsort(bounds, kind="stable")
    markers = np.empty(len(bounds), np.int64)
    markers[order] = _count_before(marker, n_bytes, bounds[order])
    plain = ~full | (markers[1::2] > markers[::2]) | (h[2] % 100 >= rate)

    one, two = h[0] % (n + 1), h[1] % (n + 1)
    cuts = []
    for k in (np.minimum(one, two), np.maximum(one, two)):
        cut = np.where(k == 0, begin, end)
        at_end_of_line = (k > 0) & (k <= line_ends)
        ranks = (ends_before[:-1] + k - 1)[at_end_of_line]
        cut[at_end_of_line] = _positions(newline, n_bytes, ranks) + 1
        cuts.append(np.where(plain, end, cut))
    b, c = cuts
    suffix_first = ~plain & (h[3] % 100 < spm)

    length = end - begin + np.where(plain, 0, 3 * WIDTH)
    out_limits = np.concatenate([[0], np.cumsum(length)])
    out = out_limits[:-1]
    p_len, s_len = b - begin, end - c
    p_at = np.where(plain, out, out + WIDTH + np.where(suffix_first, s_len + WIDTH, 0))
    s_at = out + WIDTH + np.where(suffix_first, 0, p_len + WIDTH)
    m_at = out + 3 * WIDTH + p_len + s_len

    made = np.empty(out_limits[-1], np.uint8)
    starts = np.column_stack([begin, b, c]).ravel()
    shifts = np.column_stack([p_at - begin, m_at - b, s_at - c]).ravel()
    for lo, hi, shift in _displacements(starts, shifts, n_bytes):
        made[np.arange(lo, hi) + shift] = data[lo:hi]
    for at, mark in ((p_at, PREFIX), (s_at, SUFFIX), (m_at, MIDDLE)):
        for k in range(WIDTH):
            made[at[~plain] - WIDTH + k] = mark[k]

    # code points: bytes that do not continue one
    first_bytes = lambda lo, hi: (data[lo:hi] & 0xC0) != 0x80
    chars = _count_before(first_bytes, n_bytes, starts).reshape(-1, 3)
    counted = lambda x: pa.array(x, pa.int64(), mask=plain)
    form = np.where(plain, "plain", np.where(suffix_first, "spm", "psm"))
    return pa.StructArray.from_arrays(
        [
            pa.array(n, pa.int64()),
            pa.array(form.tolist(), pa.string()),
            counted(chars[:, 1] - chars[:, 0]),
            counted(chars[:, 2] - chars[:, 1]),
            _texts_of(made, out_limits, texts.type),
        ],
        names=["n", "form", "prefix_chars", "middle_chars", "output"],
    )


def gather(outputs: pa.Array, forms: pa.Array) -> pa.Array:
    """The texts of a batch of outputs."""
    data, limits = _bytes_of(outputs)
    n_bytes, begin, end = len(data), limits[:-1], limits[1:]
    form = np.array(forms.fill_null("plain").to_pylist(), dtype="U5")
    if not np.isin(form, ["plain", "psm", "spm"]).all():
        raise ValueError("a form is plain, psm or spm")
    moved, suffix_first = form != "plain", form == "spm"

    marker = lambda lo, hi: _marker_at(data, lo, hi)
    before = _count_before(marker, n_bytes, limits)
    if (np.diff(before)[moved] != 3).any():
        raise ValueError("an output has not one marker of each kind")
    ranks = before[:-1][moved][:, None] + np.arange(3)
    first, second, third = _positions(marker, n_bytes, ranks.ravel()).reshape(-1, 3).T
    swapped = suffix_first[moved]
    p_mark, s_mark = np.where(swapped, second, first), np.where(swapped, first, second)
    kinds = ((p_mark, PREFIX), (s_mark, SUFFIX), (third, MIDDLE))
    if any((data[at + 1] != mark[1]).any() for at, mark in kinds) or (first != begin[moved]).any():
        raise ValueError("the markers of an output are not in the order of its form")

    length = end - begin - np.where(moved, 3 * WIDTH, 0)
    text_limits = np.concatenate([[0], np.cumsum(length)])
    at = text_limits[:-1]
    p_from, m_from, s_from = begin.copy(), end.copy(), end.copy()
    p_len, m_len = length.copy(), np.zeros_like(length)
    p_from[moved], m_from[moved], s_from[moved] = p_mark + WIDTH, third + WIDTH, s_mark + WIDTH
    p_len[moved] = np.where(swapped, third, second) - p_from[moved]
    m_len[moved] = end[moved] - m_from[moved]

    starts = np.column_stack([at, at + p_len, at + p_len + m_len])
    shifts = np.column_stack([p_from, m_from, s_from]) - starts
    text = np.empty(text_limits[-1], np.uint8)
    for lo, hi, shift in _displacements(starts.ravel(), shifts.ravel(), len(text)):
        text[lo:hi] = data[np.arange(lo, hi) + shift]
    return _texts_of(text, text_limits, outputs.type)


# --------------------------------------------------------------------------- on DataFrames

def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four integers of a document: the first 8-digit groups of the hex sha256 of
    ``<seed>:<doc_id>`` (a null id: nothing after the colon)."""
    told = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digest = F.sha2(told, 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def fill_in_middle(
    docs: DataFrame,
    seed: int = 0,
    rate: int = 100,
    spm: int = 50,
    doc_id: str = "doc_id",
    text: str = "text",
    name: str = "fim",
) -> DataFrame:
    """``docs`` with a struct column ``name``: n (lines of the text), form, prefix_chars,
    middle_chars (code points, null if plain) and output.

    ``rate`` per cent of the texts are transformed, ``spm`` per cent of them with the suffix
    first (spm: suffix, prefix, middle; psm: prefix, suffix, middle). The rest are plain, and
    so are empty and null texts and those that hold a marker: their output is the text.
    Cuts are at line ends, drawn from seed and id alone, so that repeated rows are alike and
    reruns agree. Texts of any length are whole. An empty table gives an empty result; other
    columns stay, one that is called ``name`` already is replaced.
    """
    workers_import_package()

    @F.arrow_udf(MADE)
    def made(texts: pa.Array, a: pa.Array, b: pa.Array, c: pa.Array, d: pa.Array) -> pa.Array:
        h = np.stack([x.to_numpy(zero_copy_only=False) for x in (a, b, c, d)])
        return scatter(texts, h, rate, spm)

    return docs.withColumn(name, made(docs[text].cast("string"), *draws(docs[doc_id], seed)))


def restored(output: Column, form: Column) -> Column:
    """The text that an output of this form was made of, to the byte. Null output counts as
    empty, null form as plain; an output whose markers do not suit its form is an error."""
    workers_import_package()

    @F.arrow_udf("string")
    def text(outputs: pa.Array, forms: pa.Array) -> pa.Array:
        return gather(outputs, forms)

    return text(output, form)


ORACLE_SQL = r"""WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
u AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS lines,
         CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM d),
k AS (
  SELECT *, len(lines) AS n,
         least(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS k1,
         greatest(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS k2
  FROM u),
p AS (
  SELECT doc_id, t, n,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
              THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
         coalesce(array_to_string(lines[1:k1], ''), '') AS prefix,
         coalesce(array_to_string(lines[k1 + 1:k2], ''), '') AS middle,
         coalesce(array_to_string(lines[k2 + 1:n], ''), '') AS suffix
  FROM k)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t
                WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(prefix || middle || suffix) AS restored_sha256
FROM p"""
