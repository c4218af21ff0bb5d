"""Fill-in-the-middle rows, with a sparse index of the multibyte characters.

Texts stay UTF-8 bytes.  For a slice of texts the index holds the places and
the excess bytes (bytes beyond the first) of its multibyte characters only:
``CharIndex`` turns byte cuts into code-point cuts and back by a search in it,
and a slice without such characters has an empty index, where both are equal.

A text is cut into prefix, middle and suffix at two ends of units: words with
the white space before them (white space after the last word is a unit), or
single code points.  The cuts, the form and the share of transformed rows follow
from a hash of seed and id, so a lost task repeats them.

Defined cases: a null text is an empty one; an empty text and one that holds a
marker stay plain; a null id hashes as the seed alone; repeated rows give
repeated results; a text of any length is cut whole (a long one is a slice of
its own); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from clickscope.llm.tables import bounded_batches
from clickscope.llm.textops import Words, slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


class CharIndex:
    """Sparse index of the multibyte characters of UTF-8 bytes."""

    def __init__(self, buf: np.ndarray):
        self.at = np.flatnonzero(buf >= 0xC0)          # first byte of each
        lead = buf[self.at]
        self.excess = np.concatenate([[0], np.cumsum(1 + (lead >= 0xE0) + (lead >= 0xF0))])
        self.chars = self.at - self.excess[:-1]        # code points before each

    def to_chars(self, byte_cuts: np.ndarray) -> np.ndarray:
        """Code points before each byte position (a character's first byte)."""
        if not len(self.at):
            return byte_cuts
        return byte_cuts - self.excess[np.searchsorted(self.at, byte_cuts)]

    def to_bytes(self, char_cuts: np.ndarray) -> np.ndarray:
        """Byte position of each code-point position."""
        if not len(self.at):
            return char_cuts
        return char_cuts + self.excess[np.searchsorted(self.chars, char_cuts)]


def unit_counts(words: Words, buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Units of each text, and whether the last one is white space only."""
    offs = words.offs
    end = offs[:-1].copy()
    has = words.counts > 0
    end[has] = words.ends[words.first[1:][has] - 1]
    trailing = end < offs[1:]
    return words.counts + trailing, trailing


def _cuts(buf: np.ndarray, offs: np.ndarray, h: np.ndarray, unit: str, index: CharIndex) -> tuple[np.ndarray, np.ndarray]:
    """Units of each text, and both cuts as byte positions in the slice."""
    if unit == "char":
        edge = index.to_chars(offs)
        n = np.diff(edge)
        picked = np.sort(h % (n + 1), axis=0)
        return n, index.to_bytes(edge[:-1] + picked)
    words = Words(buf, offs)
    n, trailing = unit_counts(words, buf)
    picked = np.sort(h % (n + 1), axis=0)
    ends = np.append(words.ends, 0)
    at = np.where(picked > 0, ends[np.minimum(words.first[:-1] + np.maximum(picked, 1) - 1, len(ends) - 1)], offs[:-1])
    return n, np.where(trailing & (picked == n), offs[1:], at)


def transform(docs: DataFrame, id_col: str = "doc_id", text: str = "text", seed: int = 42, rate: int = 50, spm_rate: int = 80,
              unit: str = "word") -> DataFrame:
    """``id_col, n, form, prefix_chars, middle_chars, prefix_bytes,
    middle_bytes, output``: ``rate`` percent of the rows are transformed, of
    those ``spm_rate`` percent with the suffix first."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    part = lambda i: F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long")
    plain = part(2) % 100 >= rate
    src = bounded_batches(docs).select(F.col(id_col), F.col(text).alias("__t"), part(0).alias("__a"), part(1).alias("__b"),
                                       plain.alias("__plain"), (part(3) % 100 < spm_rate).alias("__spm"))
    schema = StructType([src.schema[id_col]]).add("n", LongType()).add("form", StringType())
    for c in ("prefix_chars", "middle_chars", "prefix_bytes", "middle_bytes"):
        schema = schema.add(c, LongType())
    schema = schema.add("output", StringType())
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    p, s, m = marks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = np.stack([b.column(c).to_numpy() for c in ("__a", "__b")]) if b.num_rows else np.empty((2, 0), np.int64)
            plain, spm = (b.column(c).to_numpy(zero_copy_only=False) for c in ("__plain", "__spm"))
            for lo, hi, buf, offs in slices(b.column("__t")):
                index, raw = CharIndex(buf), buf.tobytes()
                n, at = _cuts(buf, offs, h[:, lo:hi], unit, index)
                edge = np.stack([offs[:-1], *at])
                in_bytes, in_chars = np.diff(edge, axis=0), np.diff(index.to_chars(edge.ravel()).reshape(edge.shape), axis=0)
                form, out = [], []
                for i in range(hi - lo):
                    x, y, z, end = int(offs[i]), int(at[0, i]), int(at[1, i]), int(offs[i + 1])
                    t = raw[x:end]
                    if not t or plain[lo + i] or any(k in t for k in marks):
                        form.append("plain")
                        out.append(t)
                    else:
                        form.append("spm" if spm[lo + i] else "psm")
                        out.append(s + raw[z:end] + p + raw[x:y] + m + raw[y:z] if spm[lo + i] else p + raw[x:y] + s + raw[z:end] + m + raw[y:z])
                none = np.array([f == "plain" for f in form])
                yield pa.RecordBatch.from_arrays([
                    b.column(id_col).slice(lo, hi - lo), pa.array(n.astype(np.int64)), pa.array(form, pa.string()),
                    *(pa.array(v.astype(np.int64), mask=none) for v in (*in_chars, *in_bytes)), pa.array(out, pa.binary()).cast(pa.string())], schema.names)

    return src.mapInArrow(run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from: a transformed text holds each
    marker once, as it came from a text without any."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
            .when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output))
