"""Fill-in-middle transformation with a sparse index of multibyte characters.

A text is cut in two places into prefix, middle and suffix, and written with the
middle last: ``<P>`` prefix ``<S>`` suffix ``<M>`` middle (psm), or with the suffix first:
``<S>`` suffix ``<P>`` prefix ``<M>`` middle (spm).

Texts stay the UTF-8 bytes that Arrow holds; nothing is decoded. Of a batch only the
multibyte characters are written down: the byte each begins at, and how many bytes it
has beyond one, added up. A binary search in that list turns a byte offset into a count
of code points and back; where a stretch is ASCII the list is empty and both are the
same number. Lines are found at bytes and counted in code points through the list; cuts
between characters are drawn in code points and found at bytes through it.

Units to cut between: ``line`` (``[^\\n]*\\n|[^\\n]+``) or ``char`` (code points). With n units
and the first four groups of eight hex digits of sha256(``seed:id``) as numbers h1 to h4,
the prefix ends after the smaller of h1 % (n+1) and h2 % (n+1) units and the middle after
the larger; the text is left as it is (plain) if h3 % 100 >= ``rate``, if it is empty or
null, or if it holds one of the marks already; it is spm if h4 % 100 < ``spm``, else psm.

Odd cases: a null text counts as empty, a null id as the empty string of digits, so rows
with equal ids are cut by the same numbers; repeated rows each get their row. A
very long text is one value like any other. Other columns are not read.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ordertide.llm.common import map_rows, quoted, type_of

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"  # none can overlap another or itself
SEED, RATE, SPM = 7, 100, 50


class ByteIndex:
    """Code points and byte offsets of a buffer of UTF-8 text, by its multibyte characters."""

    def __init__(self, data: np.ndarray):
        self.begin = np.flatnonzero(data >= 0xC0)
        lead = data[self.begin]
        excess = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.excess = np.concatenate([[0], np.cumsum(excess)])
        self.place = self.begin - self.excess[:-1]  # in code points

    def points(self, offset: np.ndarray) -> np.ndarray:
        """Code points before each byte offset, which must be between two characters."""
        return offset - self.excess[np.searchsorted(self.begin, offset)]

    def offsets(self, point: np.ndarray) -> np.ndarray:
        """Byte offset of each code point."""
        return point + self.excess[np.searchsorted(self.place, point)]


def _line_ends(data: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Number of lines of each text, and a function from line counts to byte offsets."""
    ends = np.flatnonzero(data == 0x0A) + 1
    first, last = np.searchsorted(ends, start, "right"), np.searchsorted(ends, end, "right")
    closed = last - first
    whole = np.where(closed > 0, ends[last - 1] if len(ends) else 0, start)
    n = closed + (whole < end)

    def after(lines: np.ndarray) -> np.ndarray:
        if not len(ends):
            return np.where(lines > 0, end, start)
        inside = ends[np.minimum(first + np.maximum(lines, 1), len(ends)) - 1]
        return np.where(lines == 0, start, np.where(lines > closed, end, inside))

    return n, after


def _cutter(unit: str):
    """A function per batch of (id, text, h1, h2, plain?, spm?)."""
    if unit not in ("line", "char"):
        raise ValueError(f"units are line or char, not {unit}")

    def step(batch: pa.RecordBatch):
        ids, text = batch.column(0), batch.column(1).cast(pa.large_binary())
        buffer = text.buffers()[2]
        bounds = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
        base, stop = int(bounds[0]), int(bounds[-1])
        data = np.frombuffer(buffer, np.uint8)[base:stop] if stop > base else np.zeros(0, np.uint8)
        start, end = bounds[:-1] - base, bounds[1:] - base
        index = ByteIndex(data)
        if unit == "line":
            n, after = _line_ends(data, start, end)
        else:
            first = index.points(start)
            n = index.points(end) - first
            after = lambda k: index.offsets(first + k)
        h1, h2, plain, spm = (c.to_numpy(zero_copy_only=False) for c in batch.columns[2:6])
        one, two = h1 % (n + 1), h2 % (n + 1)
        a, b = after(np.minimum(one, two)), after(np.maximum(one, two))
        points = index.points(a) - index.points(start), index.points(b) - index.points(a)
        form = np.where(plain, "plain", np.where(spm, "spm", "psm"))
        whole, out = memoryview(data), []
        for i in range(len(start)):
            prefix, middle, suffix = (whole[start[i]:a[i]], whole[a[i]:b[i]], whole[b[i]:end[i]])
            if plain[i]:
                out.append(bytes(whole[start[i]:end[i]]))
            elif spm[i]:
                out.append(b"".join([b"<S>", suffix, b"<P>", prefix, b"<M>", middle]))
            else:
                out.append(b"".join([b"<P>", prefix, b"<S>", suffix, b"<M>", middle]))
        lengths = [pa.array(p, pa.int64(), mask=plain) for p in points]
        return [ids, pa.array(n, pa.int64()), pa.array(form.tolist(), pa.string()), *lengths,
                pa.array(out, pa.binary()).cast(pa.string())]

    return lambda: step


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   unit: str = "line", seed: int = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """Columns ``id_col``, n (units), form, prefix_chars, middle_chars and output of each row.

    prefix_chars and middle_chars are code points, null where the form is plain.
    """
    text = F.coalesce(quoted(text_col), F.lit(""))
    number = F.coalesce(quoted(id_col).cast("string"), F.lit(""))
    digits = F.sha2(F.concat(F.lit(f"{seed}:"), number), 256)
    h = [F.conv(F.substring(digits, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains(text, F.lit(mark))
    plain = (text == "") | marked | (h[2] % 100 >= rate)
    rows = docs.select(quoted(id_col).alias("id"), text.alias("text"), h[0].alias("h1"),
                       h[1].alias("h2"), plain.alias("plain"), (h[3] % 100 < spm).alias("spm"))
    made = map_rows(rows, _cutter(unit),
                    f"id {type_of(rows, 'id')}, n long, form string, prefix_chars long, "
                    "middle_chars long, output string")
    return made.withColumnRenamed("id", id_col)


def restored(output: Column, form: Column) -> Column:
    """The text an output was made from.

    A text with a mark in it is plain, and no two marks can share a character, so
    the marks split any other output in exactly the pieces it was joined from.
    """
    parts = F.split(output, "<[PSM]>", -1)
    psm = F.concat(parts[1], parts[3], parts[2])
    spm = F.concat(parts[2], parts[3], parts[1])
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def digests(made: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The transformed rows with hashes of the output and of the text restored from it."""
    text = restored(F.col("output"), F.col("form"))
    return made.select(
        quoted(id_col), "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(text, 256).alias("restored_sha256"))
