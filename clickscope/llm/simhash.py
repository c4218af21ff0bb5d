"""SimHash near duplicates by tiled exact comparison.

1. Fingerprints: each text's shingles are hashed (XXH64) and the bits counted;
   a bit is set where over half of the hashes have it.
2. Equal fingerprints become one row (a partial aggregate), so groups of copies
   end here.  The rows are dealt into tiles by the population counts of the
   fingerprint's ``PARTS`` parts; a full tile is split by hash.
3. Two fingerprints within the radius differ by no more than it in all
   population counts together, so a tile is compared only with tiles whose
   counts are that near: every bit pair of the two tiles by exclusive-or and
   bit count, in numpy blocks.  All other tile pairs are skipped.
4. A tile pair returns links that span its groups (fewer than it has
   fingerprints, not all pairs); connected components join them.

Defined cases: a null or empty text and one without words has the fingerprint
zero and is linked like any other; of fewer words than a shingle has, the whole
sequence is hashed; a row with a null id has its fingerprint and links, and its
component is the smallest id that is not null (null if none); texts of one id
are rows of their own; repeated rows give repeated results; a long text is
hashed whole, in bounded steps; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickscope.llm.tables import bounded_batches, minimum_labels
from clickscope.llm.textops import Words, slices
from clickscope.session import cut_lineage

SEED = 42
PARTS, PART_BITS = 4, 16
TILE_ROWS = 32_768           # fingerprints of a tile (256 kB)
BLOCK = 1 << 20              # comparisons of a numpy step
STEP = 1 << 16               # shingles whose bits are counted at once
HEAVY_SHARE = 1000           # a fingerprint with over 1/1000 of the rows is heavy

# The multipliers of XXH64.
P1, P2, P3, P4, P5 = (np.uint64(x) for x in (
    11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))


def _turn(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def xxh64(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of many spans of ``buf``: those under 32 bytes as whole arrays, the
    longer ones by the library."""
    pad = np.concatenate([buf, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(buf) + 1, "<u8", pad, strides=(1,))
    four = np.ndarray(len(buf) + 1, "<u4", pad, strides=(1,))
    size = ends - starts
    out = np.empty(len(starts), np.uint64)
    raw = buf.tobytes()
    for i in np.flatnonzero(size >= 32):
        out[i] = xxhash.xxh64_intdigest(raw[starts[i]:ends[i]], seed)
    small = np.flatnonzero(size < 32)
    small = small[np.argsort(size[small], kind="stable")]
    at, n = starts[small], size[small]
    h = np.uint64(seed) + P5 + n.astype(np.uint64)
    for k in range(3):                       # ordered by size: a tail of the arrays has another lane
        s = slice(int(np.searchsorted(n, 8 * k + 8)), None)
        h[s] = _turn(h[s] ^ (_turn(eight[at[s] + 8 * k] * P2, 31) * P1), 27) * P1 + P4
    at, rest = at + (n & ~7), n & 7
    w = np.flatnonzero(rest >= 4)
    h[w] = _turn(h[w] ^ (four[at[w]].astype(np.uint64) * P1), 23) * P2 + P3
    at, rest = at + (rest & 4), rest & 3
    for k in range(3):
        w = np.flatnonzero(rest > k)
        h[w] = _turn(h[w] ^ (pad[at[w] + k].astype(np.uint64) * P5), 11) * P1
    h = (h ^ (h >> np.uint64(33))) * P2
    h = (h ^ (h >> np.uint64(29))) * P3
    out[small] = h ^ (h >> np.uint64(32))
    return out


def joined_words(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of a slice, lower-cased and joined by single spaces, and each
    word's start and end in that."""
    size = words.ends - words.starts
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    out = np.full(int(ends[-1]) + 1 if len(ends) else 0, 0x20, np.uint8)
    inside = np.zeros(len(words.buf) + 1, np.int8)
    inside[words.starts] += 1
    inside[words.ends] -= 1
    took = words.buf[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]
    to = np.ones(len(out) + 1, dtype=bool)
    to[ends] = False
    out[to[:-1]] = np.where((took >= 65) & (took <= 90), took + np.uint8(32), took)
    return out, starts, ends


def fingerprints_of(buf: np.ndarray, offs: np.ndarray, k: int) -> np.ndarray:
    """Fingerprint of each text of a slice."""
    words = Words(buf, offs)
    text, starts, ends = joined_words(words)
    each = np.where(words.counts >= k, words.counts - k + 1, np.minimum(words.counts, 1))
    bits = np.zeros((words.n_docs, 64), np.int64)
    if len(starts):
        doc = np.repeat(np.arange(words.n_docs), each)
        first = words.first[doc] + np.arange(len(doc)) - (np.cumsum(each) - each)[doc]
        last = first + np.minimum(words.counts[doc], k) - 1
        for lo in range(0, len(doc), STEP):
            h = xxh64(text, starts[first[lo:lo + STEP]], ends[last[lo:lo + STEP]])
            d = doc[lo:lo + STEP]
            cut = np.flatnonzero(np.append(True, d[1:] != d[:-1]))
            one = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            bits[d[cut]] += np.add.reduceat(one, cut, axis=0, dtype=np.int64)
    over = 2 * bits > each[:, None]
    return np.packbits(over, axis=1, bitorder="little").view("<u8").ravel()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = 3) -> DataFrame:
    """``id, fp`` of every row (the 64 bits as a long)."""
    src = bounded_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, buf, offs in slices(b.column("text")):
                fp = fingerprints_of(buf, offs, k)
                yield pa.RecordBatch.from_arrays([b.column("id").slice(lo, hi - lo), pa.array(fp.view(np.int64))], ["id", "fp"])

    return src.mapInArrow(run, "id long, fp long")


def near_counts(radius: int) -> list[int]:
    """Differences of two cells' numbers, each cell pair once: population counts
    are digits of base 32, and differ by ``radius`` in all together at most."""
    steps = [((), 0)]
    for _ in range(PARTS):
        steps = [((*d, x), used + abs(x)) for d, used in steps for x in range(-radius, radius + 1) if used + abs(x) <= radius]
    numbers = [sum(x * 32 ** i for i, x in enumerate(d)) for d, _ in steps]
    return sorted(n for n in numbers if n >= 0)


def tile_links(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links ``(u, v)`` that span the connected groups of two tiles, found by
    comparing all pairs, ``BLOCK`` of them a step.  Never more links are held
    than a block has and four times the fingerprints."""
    u, v = a[:0], a[:0]
    rows = max(1, BLOCK // max(1, len(b)))
    for lo in range(0, len(a), rows):
        part = a[lo:lo + rows]
        x, y = np.nonzero(np.bitwise_count(part[:, None] ^ b[None, :]) <= radius)
        u, v = np.concatenate([u, part[x]]), np.concatenate([v, b[y]])
        if len(u) > 4 * (len(a) + len(b)):
            u, v = spanning(u, v)
    return spanning(u, v)


def spanning(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star for each connected group of the links: as many links as it has
    members, less one."""
    nodes, both = np.unique(np.concatenate([u, v]), return_inverse=True)
    i, j = both[:len(u)], both[len(u):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = np.minimum(new[label], new)
        new = new[new]
        if (new == label).all():
            break
        label = new
    out = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[label[out]], nodes[out]


def links(fps: DataFrame, radius: int = 2) -> DataFrame:
    """``u, v``: links that span the groups of fingerprints (distinct ``fp``)
    within ``radius`` of each other."""
    counts = [F.bit_count(F.shiftrightunsigned("fp", PART_BITS * i).bitwiseAND(F.lit(2**PART_BITS - 1))) * 32 ** i for i in range(PARTS)]
    celled = fps.select("fp", sum(counts[1:], counts[0]).cast("long").alias("cell"))
    # at most 17 ** 4 cells, whatever the input
    sizes = celled.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(float(TILE_ROWS))).cast("int").alias("cuts"))
    dealt = celled.join(F.broadcast(sizes), "cell").withColumn("sub", F.pmod(F.xxhash64("fp"), "cuts").cast("int"))
    tiles = cut_lineage(dealt.groupBy("cell", "sub").agg(F.collect_list("fp").alias("fps")), "tiles")
    steps = F.array(*[F.lit(x).cast("long") for x in near_counts(radius)])
    # each tile goes to the tiles of its own and the near cells, dealt by tile
    out = tiles.select(F.explode(F.transform(steps, lambda x: x + F.col("cell"))).alias("cell"), F.col("cell").alias("from"), F.col("sub").alias("s"), F.col("fps").alias("other"))
    out = out.join(F.broadcast(sizes), "cell").withColumn("sub", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))).where("`from` <> cell or s <= sub")
    pairs = out.join(tiles, ["cell", "sub"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            us, vs = [], []
            sides = [(c.flatten().to_numpy().view(np.uint64), c.offsets.to_numpy() - c.offsets[0].as_py()) for c in (b.column("other"), b.column("fps"))]
            for i in range(b.num_rows):
                x, y = (v[o[i]:o[i + 1]] for v, o in sides)
                u, v = tile_links(x, y, radius)
                us.append(u)
                vs.append(v)
            if us:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).view(np.int64)) for c in (us, vs)], ["u", "v"])

    return pairs.select("other", "fps").mapInArrow(run, "u long, v long")


def components(docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = 3, radius: int = 2) -> DataFrame:
    """``id_col, fingerprint`` (16 hex digits) and ``component_id`` of every
    row."""
    rows = cut_lineage(fingerprints(docs, id_col, text, k), "fingerprints")
    fps = cut_lineage(rows.groupBy("fp").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("rows")), "distinct")
    joined = minimum_labels(links(fps.select("fp"), radius), "u", "v").select(F.col("node").alias("fp"), F.col("label").alias("root"))
    rooted = fps.join(joined, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = cut_lineage(rooted.join(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "root").select("fp", "rows", "component_id"), "named")
    # under HEAVY_SHARE fingerprints can have over 1/HEAVY_SHARE of the rows each
    heavy = F.col("rows") > max(1000, rows.count() // HEAVY_SHARE)
    few = F.broadcast(named.where(heavy).select("fp", F.col("component_id").alias("c"), F.lit(True).alias("h")))
    marked = rows.join(few, "fp", "left")
    light = marked.where("h is null").select("id", "fp").join(named.where(~heavy).select("fp", "component_id"), "fp")
    every = light.select("id", "fp", "component_id").unionByName(marked.where("h").select("id", "fp", F.col("c").alias("component_id")))
    return every.select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
