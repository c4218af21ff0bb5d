"""Fuzzy repeated passages by collinear chaining.

1. Seeds: a gram of ``GRAM`` words and one of the next few, that with the
   smallest hash together (randstrobes): the words between them may differ.
   Half of the seeds are taken, by hash, and the smallest of every ``W``.
   Equal texts take part once.
2. Join, in two ways whose matches grow with the occurrences, never with their
   pairs.  A seed's occurrences meet at two common documents, its first one (by
   id) and one chosen by hash.  That alone would miss a passage whose parts
   stand alone in other documents, so every window of ``min_words`` words that
   has no unshared seed also meets the first document with the same window, by
   a hash of all its words: an exact repeat is found wherever its parts stand.
   For a fuzzy one, two runs of a document's seeds near each other that met at
   different documents, one of them shorter than a passage, are a junction;
   the document also meets the first one with the same junction.
3. Chains: the matches of a pair of documents are merged along diagonals and
   the segments chained in order (both positions increasing) with a gap cost,
   the best predecessor by a prefix maximum in a Fenwick tree.
4. Alignment: the words around each chain of both documents are compared; the
   chain's ends are extended while matches outweigh differences, gaps between
   segments are split where most words match.

A passage of at least ``min_words`` words with ``identity`` matching words
counts; it repeats in the later document (larger id), the earlier one keeps it.

Defined cases: null and empty texts and texts under ``k`` words have no
passage; a text equal to an earlier one of ``min_words`` words is one passage
as a whole; rows with a null id take no part; the texts of one id are a document
each, ordered by their hash; repeated rows are one document; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickscope.llm.tables import bounded_batches, discard, small_side
from clickscope.llm.textops import Words, _powers, mix, slices, smallest_of
from clickscope.session import cut_lineage

GRAM, NEAR, FAR = 3, 3, 6     # words of a gram; words from the first gram to the second
K, W, SPAN = GRAM, 8, FAR + GRAM
GAP = 0.25          # cost of a word of distance in either document; a seed is worth K
BLOCK = 64          # texts are cut out in multiples of so many words
PAD = 48            # words around a chain that alignment may look at
CHAIN = "later long, earlier long, b0 array<int>, a0 array<int>, len array<int>"


def strobes(words: Words, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and word positions of the seeds."""
    g, at = words.grams(h, GRAM)
    if not len(g):
        return g, at
    doc, n, most = words.doc[at], len(g), np.uint64(2**64 - 1)
    pad, odoc = np.concatenate([g, np.zeros(FAR, np.uint64)]), np.concatenate([doc, np.full(FAR, -1)])
    key, has = np.full(n, most), np.zeros(n, dtype=bool)
    for t in range(NEAR, FAR + 1):
        inside = odoc[t:n + t] == doc
        key = np.minimum(key, np.where(inside, mix(g * np.uint64(31) + pad[t:n + t]), most))
        has |= inside
    key, at, doc = key[has], at[has], doc[has]
    low = smallest_of(key, doc, W)
    take = key & np.uint64(1) == 0
    take[low] = True
    return key[take], at[take]


def _word_counts(src: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = [Words(buf, offs).counts for _, _, buf, offs in slices(b.column("text"))]
            n = np.concatenate(n) if n else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("key"), pa.array(n.astype(np.int64))], ["id", "key", "n"])

    return src.mapInArrow(run, "id long, key long, n long")


def _seeds(src: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """``g, doc, pos`` of the seeds (of those in the short table ``only``)."""
    known = None if only is None else np.array([r["g"] for r in only.collect()], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("id").to_numpy(zero_copy_only=False)
            for lo, _, buf, offs in slices(b.column("text")):
                words = Words(buf, offs)
                g, at = strobes(words, words.hashes(lower=True))
                g = seed_number(g)
                if known is not None:
                    keep = np.isin(g, known)
                    g, at = g[keep], at[keep]
                doc = words.doc[at]
                yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(ids[lo + doc], pa.int64()), pa.array((at - words.first[doc]).astype(np.int32))], ["g", "doc", "pos"])

    return src.mapInArrow(run, "g long, doc long, pos int")


def seed_number(g: np.ndarray) -> np.ndarray:
    """Seeds travel as 48-bit numbers: what two different ones share by chance
    is a match like any other, which alignment refuses."""
    return (g >> np.uint64(16)).astype(np.int64)


PACKED = "r int, wide boolean, base long, g binary, ids binary, doc binary, pos binary"


def _packed(g: np.ndarray, doc: np.ndarray, pos: np.ndarray, bits: int) -> Iterator[tuple]:
    """Rows :data:`PACKED` of a flush: the seeds of each range
    of numbers in order, as differences, with short document numbers."""
    order = np.argsort(g, kind="stable")
    g, doc, pos = g[order], doc[order], pos[order]
    edge = np.searchsorted(g, np.arange((1 << bits) + 1, dtype=np.int64) << (48 - bits))
    for r in np.flatnonzero(np.diff(edge)):
        lo, hi = edge[r], edge[r + 1]
        ids, short = np.unique(doc[lo:hi], return_inverse=True)
        step = np.diff(g[lo:hi], prepend=np.int64(r) << (48 - bits))
        gap = np.diff(ids, prepend=ids[:1]).astype(np.uint64)
        wide = bool(step.max() >= 2**32 or gap.max() >= 2**32 or len(ids) > 2**16 or pos[lo:hi].max() >= 2**16)
        big, small = ("<u8", "<u4") if wide else ("<u4", "<u2")
        yield int(r), wide, int(ids[0]), step.astype(big).tobytes(), gap.astype(big).tobytes(), short.astype(small).tobytes(), pos[lo:hi].astype(small).tobytes()


def _unpacked(rows: pa.Table, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    gs, docs, ps = [], [], []
    for r, wide, base, g, ids, doc, pos in zip(*(rows.column(c).to_pylist() for c in ("r", "wide", "base", "g", "ids", "doc", "pos"))):
        big, small = ("<u8", "<u4") if wide else ("<u4", "<u2")
        gs.append(np.cumsum(np.frombuffer(g, big).astype(np.int64)) + (r << (48 - bits)))
        docs.append((base + np.cumsum(np.frombuffer(ids, big).astype(np.int64)))[np.frombuffer(doc, small)])
        ps.append(np.frombuffer(pos, small).astype(np.int64))
    return np.concatenate(gs), np.concatenate(docs), np.concatenate(ps)


def met_in(g: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, ...]:
    """``doc, pos, first doc, first pos, pick doc, pick pos`` of the occurrences
    of all seeds that several documents have."""
    order = np.lexsort((pos, doc, g))
    g, doc, pos = g[order], doc[order], pos[order]
    start = np.flatnonzero(np.append(True, g[1:] != g[:-1])) if len(g) else np.empty(0, np.int64)
    size = np.diff(np.append(start, len(g)))
    several = doc[start] != doc[start + size - 1]
    keep = np.repeat(several, size)
    g, doc, pos = g[keep], doc[keep], pos[keep]
    start = np.flatnonzero(np.append(True, g[1:] != g[:-1])) if len(g) else np.empty(0, np.int64)
    size = np.diff(np.append(start, len(g)))
    h = mix(doc.view(np.uint64))
    low = np.repeat(np.minimum.reduceat(h, start), size) if len(g) else h
    place = np.where(h == low, np.arange(len(g)), len(g))
    pick = np.minimum.reduceat(place, start) if len(g) else start
    f, p = np.repeat(start, size), np.repeat(pick, size)
    return doc, pos, doc[f], pos[f], doc[p], pos[p]


FLUSH_SEEDS, RANGE_WORDS = 400_000, 500_000
MET = "doc long, pos array<int>, first array<long>, first_pos array<int>, pick array<long>, pick_pos array<int>"
PARTS = "part int, doc array<long>, pos array<int>, first array<long>, first_pos array<int>, pick array<long>, pick_pos array<int>"
MATCHES = "part int, later array<long>, earlier array<long>, bpos array<int>, apos array<int>"


def range_bits(n_words: int) -> int:
    """Seeds are dealt to two to the power of so many ranges, and what they
    meet to as many parts (64 at least)."""
    return min(24, max(4, (n_words // RANGE_WORDS).bit_length()))


def _lists(new: np.ndarray, order: np.ndarray, columns: dict[str, np.ndarray]) -> tuple[np.ndarray, dict[str, pa.Array]]:
    """Where groups begin (``new``: a value begins one, in ``order``) and the
    columns as one list a group."""
    cut = np.flatnonzero(new)
    offs = pa.array(np.append(cut, len(order)).astype(np.int32))
    return cut, {c: pa.ListArray.from_arrays(offs, pa.array(v[order].astype(np.int32 if c.endswith("pos") else np.int64))) for c, v in columns.items()}


def by_part(key: np.ndarray, bits: int, **columns: np.ndarray) -> pa.Table:
    """One row for each part of the keys (by hash): lists of the columns."""
    part = (mix(key.view(np.uint64)) >> np.uint64(64 - max(6, bits))).astype(np.int32)
    order = np.argsort(part, kind="stable")
    part = part[order]
    cut, lists = _lists(np.append(True, part[1:] != part[:-1])[:len(part)], order, columns)
    return pa.table({"part": pa.array(part[cut], pa.int32())} | lists)


def by_document(doc: np.ndarray, pos: np.ndarray, **columns: np.ndarray) -> pa.Table:
    """:data:`MET`: one row for each document, its occurrences in order."""
    order = np.lexsort((pos, doc))
    own = doc[order]
    cut, lists = _lists(np.append(True, own[1:] != own[:-1])[:len(own)], order, {"pos": pos} | columns)
    return pa.table({"doc": pa.array(own[cut].astype(np.int64))} | lists)


def _spread(rows: pa.RecordBatch | pa.Table, *names: str) -> list[np.ndarray]:
    """The values of columns of lists, row after row."""
    return [np.asarray(pc.list_flatten(rows.column(c))) for c in names]


def _rows_of(rows: pa.RecordBatch, name: str, lists: str) -> np.ndarray:
    """The value of the row, for each value of its list."""
    return np.repeat(np.asarray(rows.column(name)), np.asarray(pc.list_value_length(rows.column(lists))))


def _held(pieces: Iterator[tuple[np.ndarray, ...]], most: int = FLUSH_SEEDS) -> Iterator[list[np.ndarray]]:
    """The pieces put together until ``most`` values are held."""
    held, n = [], 0
    for piece in pieces:
        held.append(piece)
        n += len(piece[0])
        if n >= most:
            yield [np.concatenate(x) for x in zip(*held)]
            held, n = [], 0
    if n:
        yield [np.concatenate(x) for x in zip(*held)]


def by_partner(doc: np.ndarray, pos: np.ndarray, first: np.ndarray, first_pos: np.ndarray, pick: np.ndarray, pick_pos: np.ndarray) -> pa.Table:
    """Occurrences and their meeting points: one row for each document and
    pair of meeting points (either may be the document itself)."""
    order = np.lexsort((pos, pick, first, doc))
    doc, first, pick = doc[order], first[order], pick[order]
    new = (doc[1:] != doc[:-1]) | (first[1:] != first[:-1]) | (pick[1:] != pick[:-1])
    cut = np.flatnonzero(np.append(True, new)) if len(doc) else np.empty(0, np.int64)
    offs = pa.array(np.append(cut, len(doc)).astype(np.int32))
    lists = [pa.ListArray.from_arrays(offs, pa.array(v[order].astype(np.int32))) for v in (pos, first_pos, pick_pos)]
    return pa.table([*(pa.array(v[cut].astype(np.int64)) for v in (doc, first, pick)), *lists], names=["doc", "first", "pick", "pos", "first_pos", "pick_pos"])


def meetings(src: DataFrame, n_words: int, sample_docs: int = 2000, most: int = 20_000) -> DataFrame:
    """:data:`MET` of the seeds that several documents have: the occurrences
    of a document, each with its two meeting points.

    The seeds are shuffled packed, a few bytes each, by ranges of their numbers
    (as many ranges as the words ask for); of a range only shared seeds leave
    the task, packed by parts of the documents: a row for each part, however
    many documents share seeds by chance.  Very common seeds (found in a sample of documents) are aggregated
    before they are shuffled.  The sample only decides which way a seed goes."""
    bits = range_bits(n_words)
    docs = max(1, src.count())
    edge = -(2**63) + min(2**64 - 1, int(2**64 * sample_docs / docs))
    sample = _seeds(src.where(F.xxhash64("id", F.lit(7)) <= F.lit(edge).cast("long")))
    common = cut_lineage(sample.groupBy("g").agg(F.count_distinct("doc").alias("c")).where("c >= 20").orderBy(F.desc("c"), "g").limit(most).select("g"), "common")
    hot = np.array([r["g"] for r in common.collect()], np.int64)

    def seeds(batches: Iterator[pa.RecordBatch], wanted) -> Iterator[tuple[np.ndarray, ...]]:
        for b in batches:
            ids = b.column("id").to_numpy(zero_copy_only=False)
            for lo, _, buf, offs in slices(b.column("text")):
                words = Words(buf, offs)
                g, at = strobes(words, words.hashes(lower=True))
                g = seed_number(g)
                keep = wanted(g)
                g, at = g[keep], at[keep]
                doc = words.doc[at]
                yield g, ids[lo + doc].astype(np.int64), (at - words.first[doc]).astype(np.int32)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int32(), pa.bool_(), pa.int64(), *[pa.binary()] * 4)
        for held in _held(seeds(batches, lambda g: ~np.isin(g, hot))):
            rows = list(zip(*_packed(*held, bits)))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows or [[]] * 7, kinds)], ["r", "wide", "base", "g", "ids", "doc", "pos"])

    def parts(doc: np.ndarray, *others: np.ndarray) -> pa.Table:
        return by_part(doc, bits, doc=doc, **dict(zip(("pos", "first", "first_pos", "pick", "pick_pos"), others)))

    def meet(rows: pa.Table) -> pa.Table:
        return parts(*met_in(*_unpacked(rows, bits)))

    def gather(rows: pa.Table) -> pa.Table:
        names = ("doc", "pos", "first", "first_pos", "pick", "pick_pos")
        return by_document(**dict(zip(names, _spread(rows, *names))))

    packed = src.mapInArrow(pack, PACKED)
    met = packed.groupBy("r").applyInArrow(meet, PARTS)
    if len(hot):
        points = _seeds(src, common).groupBy("g").agg(F.min(F.struct("doc", "pos")).alias("f"), F.min(F.struct(F.xxhash64("doc").alias("h"), "doc", "pos")).alias("p"))
        at = sorted((r["g"], r["f"]["doc"], r["f"]["pos"], r["p"]["doc"], r["p"]["pos"]) for r in points.collect())      # at most ``most``
        names, ends = np.array([r[0] for r in at], np.int64), np.array([r[1:] for r in at], np.int64).reshape(-1, 4)

        def attach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for g, doc, pos in _held(seeds(batches, lambda g: np.isin(g, names))):
                yield from parts(doc, pos, *ends[np.searchsorted(names, g)].T).to_batches()

        met = met.unionByName(src.mapInArrow(attach, PARTS))
    return met.groupBy("part").applyInArrow(gather, MET)


def _pair_parts(bits: int, later: np.ndarray, earlier: np.ndarray, bpos: np.ndarray, apos: np.ndarray) -> list[pa.RecordBatch]:
    """:data:`MATCHES`, packed by parts of the pairs."""
    key = later.view(np.uint64) * np.uint64(31) + mix(earlier.view(np.uint64))
    return by_part(key, bits, later=later, earlier=earlier, bpos=bpos, apos=apos).to_batches()


def matches(met: DataFrame, bits: int) -> DataFrame:
    """:data:`MATCHES`: seeds shared with a meeting point."""
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        for b in batches:
            doc = _rows_of(b, "doc", "pos")
            pos, first, first_pos, pick, pick_pos = _spread(b, "pos", "first", "first_pos", "pick", "pick_pos")
            for keep, point, at in ((doc != first, first, first_pos), ((pick != doc) & (pick != first), pick, pick_pos)):
                own, other, p, q = doc[keep], point[keep], pos[keep], at[keep]
                after = own > other
                yield np.maximum(own, other), np.minimum(own, other), np.where(after, p, q), np.where(after, q, p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _held(pairs(batches)):
            yield from _pair_parts(bits, *held)

    return met.mapInArrow(run, MATCHES)


def _junctions(near: int):
    """``ka, kb, doc, apos, aq, bpos, bq``: pairs of runs of one document, at
    most ``near`` words apart, that met at different documents ``ka``, ``kb``
    (positions in the document and at the meeting point).  Of a run, the part
    near the other counts; a run of one seed says nothing."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            pos, first, first_pos = _spread(batch, "pos", "first", "first_pos")
            met = by_partner(_rows_of(batch, "doc", "pos"), pos, first, first_pos, first, first_pos)
            docs, others, lists = met["doc"].to_numpy(), met["first"].to_numpy(), met["pos"].combine_chunks()
            edge, ps, qs = lists.offsets.to_numpy(), *_spread(met, "pos", "first_pos")
            several = np.flatnonzero(np.diff(edge) > 1)
            new = np.flatnonzero(docs[several][1:] != docs[several][:-1]) + 1
            for of_doc in np.split(several, new):
                if len(of_doc) < 2:
                    continue
                doc, runs = int(docs[of_doc[0]]), []
                for i in of_doc.tolist():
                    p, q = ps[edge[i]:edge[i + 1]], qs[edge[i]:edge[i + 1]]
                    for at in np.split(np.arange(len(p)), np.flatnonzero(np.diff(p) > 3 * W) + 1):
                        if len(at) > 1:
                            runs.append((int(p[at[0]]), int(p[at[-1]]), int(others[i]), p[at], q[at]))
                runs.sort(key=lambda r: r[:3])
                held = []                                # runs that may still come near the next one
                for start, end, other, p, q in runs:
                    held = [r for r in held if r[1] >= start - near]
                    for start0, end0, other0, p0, q0 in held:
                        if other0 == other or min(end0 - start0, end - start) >= near:
                            continue
                        one, two = p0 >= start - near, p <= end0 + near
                        if one.sum() > 1 and two.sum() > 1:
                            rows.append((other0, other, doc, p0[one], q0[one], p[two], q[two]))
                    held.append((start, end, other, p, q))
            kinds = [pa.int64()] * 3 + [pa.list_(pa.int32())] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [[]] * 7, kinds)], ["ka", "kb", "doc", "apos", "aq", "bpos", "bq"])

    return run


def junction_matches(met: DataFrame, near: int, bits: int) -> DataFrame:
    """:func:`matches` of documents with the first document that has the same
    junction: seeds of both that met at one place are one seed."""
    found = cut_lineage(met.mapInArrow(_junctions(near), "ka long, kb long, doc long, apos array<int>, aq array<int>, bpos array<int>, bq array<int>"), "junctions")
    firsts = small_side(found.groupBy("ka", "kb").agg(F.min(F.struct("doc", "apos", "aq", "bpos", "bq")).alias("f"), F.max("doc").alias("last")).where("f.doc <> last").select("ka", "kb", "f"))
    hits = found.join(firsts, ["ka", "kb"]).where("doc <> f.doc")

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        for b in batches:
            for r in b.to_pylist():
                later, earlier = [], []
                for p, q in (("apos", "aq"), ("bpos", "bq")):
                    _, x, y = np.intersect1d(r[q], r["f"][q], return_indices=True)
                    later += np.array(r[p])[x].tolist()
                    earlier += np.array(r["f"][p])[y].tolist()
                if len(later) > 1:
                    yield np.full(len(later), r["doc"]), np.full(len(later), r["f"]["doc"]), np.array(later), np.array(earlier)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _held(pairs(batches)):
            yield from _pair_parts(bits, *held)

    return hits.mapInArrow(run, MATCHES)


def _windows(src: DataFrame, met: DataFrame, n: int) -> DataFrame:
    """``k, doc, pos``: hash and position of the ``n``-word windows whose inner
    seeds are all shared.  A seed that is ``W - 1`` words inside a window is
    chosen by the window's words alone, so a repeated window has no other."""
    lo, hi = W - 1, n - SPAN - W + 1
    held = met.select("doc", F.col("pos").alias("shared")).where(F.size("shared") >= max(1, (hi - lo + 1) // W))
    joined = src.join(small_side(held), F.col("id") == F.col("doc")).select("doc", "shared", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, shared = b.column("doc").to_numpy(zero_copy_only=False), b.column("shared")
            for at0, at1, buf, offs in slices(b.column("text")):
                words = Words(buf, offs)
                h = words.hashes(lower=True)
                _, at = strobes(words, h)
                known = [words.first[i - at0] + np.asarray(shared[i].as_py(), np.int64) for i in range(at0, at1)]
                lone = np.zeros(len(h) + 1, np.int64)
                lone[at[~np.isin(at, np.concatenate(known))] + 1] = 1
                lone = np.cumsum(lone)
                p, inv = _powers(len(h) + 1)
                run_ = np.zeros(len(h) + 1, np.uint64)
                np.cumsum(h * p[:len(h)], out=run_[1:])
                s = np.arange(max(0, len(h) - n + 1))
                s = s[words.doc[s] == words.doc[s + n - 1]]
                if hi >= lo:
                    s = s[lone[s + hi + 1] == lone[s + lo]]
                doc = words.doc[s]
                yield pa.RecordBatch.from_arrays([pa.array(mix((run_[s + n] - run_[s]) * inv[s]).view(np.int64)), pa.array(ids[at0 + doc], pa.int64()),
                                                  pa.array((s - words.first[doc]).astype(np.int32))], ["k", "doc", "pos"])

    return joined.mapInArrow(run, "k long, doc long, pos int")


def exact_runs(src: DataFrame, met: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """Chains of one segment: where a document and the first document (by id)
    with the same ``n``-word windows are equal word by word; and the table of
    windows they are read from."""
    windows = cut_lineage(_windows(src, met, n), "windows")
    firsts = small_side(windows.groupBy("k").agg(F.min(F.struct("doc", "pos")).alias("first"), F.max("doc").alias("last")).where("first.doc <> last").select("k", "first"))
    hits = windows.join(firsts, "k").where("doc <> first.doc")
    grouped = hits.groupBy(F.col("doc").alias("later"), F.col("first.doc").alias("earlier")).agg(F.collect_set(F.struct("pos", F.col("first.pos").alias("apos"))).alias("m"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair, b, a = _flat(batch.column("m"), "pos", "apos")
            order = np.lexsort((b, b - a, pair))
            pair, b, a = pair[order], b[order], a[order]
            cut = np.flatnonzero(np.append(True, (np.diff(pair) != 0) | (np.diff(b - a) != 0) | (np.diff(b) > n))) if len(b) else np.empty(0, np.int64)
            last = np.append(cut[1:], len(b)) - 1
            yield _single(batch, pair[cut], b[cut], a[cut], b[last] - b[cut] + n)

    return grouped.mapInArrow(run, CHAIN), windows


def _flat(col: pa.ListArray, x: str, y: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row number and both fields of all structs in a column of lists."""
    flat = col.flatten()
    row = np.repeat(np.arange(len(col)), np.diff(col.offsets.to_numpy()))
    return row, *(flat.field(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in (x, y))


def _single(batch: pa.RecordBatch, row: np.ndarray, b0: np.ndarray, a0: np.ndarray, length: np.ndarray) -> pa.RecordBatch:
    """Chains of one segment of the pairs ``row``."""
    at, take = pa.array(np.arange(len(row) + 1, dtype=np.int32)), pa.array(row)
    return pa.RecordBatch.from_arrays([batch.column("later").take(take), batch.column("earlier").take(take),
                                       *(pa.ListArray.from_arrays(at, pa.array(v.astype(np.int32))) for v in (b0, a0, length))], ["later", "earlier", "b0", "a0", "len"])


class Fenwick:
    """Prefix maxima of (value, item) over positions 0..n-1."""

    def __init__(self, n: int):
        self.best = [(-1e18, -1)] * (n + 1)

    def put(self, i: int, value: tuple[float, int]) -> None:
        i += 1
        while i < len(self.best):
            if value > self.best[i]:
                self.best[i] = value
            i += i & -i

    def upto(self, i: int) -> tuple[float, int]:
        """Best over positions below ``i``."""
        out = (-1e18, -1)
        while i > 0:
            if self.best[i] > out:
                out = self.best[i]
            i -= i & -i
        return out


def diagonal_segments(b: np.ndarray, a: np.ndarray, k: int = K, reach: int = 3 * W) -> np.ndarray:
    """Matches on one diagonal at most ``reach`` apart become one segment:
    rows ``b0, a0, length, weight``."""
    return segments_of(np.zeros(len(b), np.int64), b, a, k, reach)[1]


def segments_of(pair: np.ndarray, b: np.ndarray, a: np.ndarray, k: int = K, reach: int = 3 * W) -> tuple[np.ndarray, np.ndarray]:
    """The pair of each segment (in order) and the segments of many pairs."""
    if not len(b):
        return pair, np.empty((0, 4))
    order = np.lexsort((b, b - a, pair))
    pair, b, a = pair[order], b[order], a[order]
    keep = np.ones(len(b), dtype=bool)
    keep[1:] = (b[1:] != b[:-1]) | (a[1:] != a[:-1]) | (pair[1:] != pair[:-1])
    pair, b, a = pair[keep], b[keep], a[keep]
    cut = np.ones(len(b), dtype=bool)
    step = np.diff(b)
    cut[1:] = ((b - a)[1:] != (b - a)[:-1]) | (step > reach) | (pair[1:] != pair[:-1])
    gain = np.full(len(b), float(k))
    gain[1:] = np.where(cut[1:], k, np.maximum(np.minimum(step, k) - 2 * GAP * np.maximum(step - k, 0), -k))
    first = np.flatnonzero(cut)
    last = np.append(first[1:], len(b)) - 1
    return pair[first], np.stack([b[first], a[first], b[last] - b[first] + k, np.add.reduceat(gain, first)], axis=1)


def chains(segments: np.ndarray) -> list[list[int]]:
    """Disjoint chains of segments, best first: ordered in both documents,
    score = weights - ``GAP`` for each word between them in either document."""
    n = len(segments)
    if n == 1:
        return [[0]]
    b0, a0, length, weight = segments.T
    b1, a1 = b0 + length, a0 + length
    rank = np.unique(a1)
    at_end, at_start = np.searchsorted(rank, a1), np.searchsorted(rank, a0, side="right")
    tree, score, back = Fenwick(len(rank)), weight.copy(), np.full(n, -1)
    events = sorted([(b1[i], 0, i) for i in range(n)] + [(b0[i], 1, i) for i in range(n)])
    for _, start, i in events:
        if start:
            best, j = tree.upto(int(at_start[i]))
            gain = best - GAP * (b0[i] + a0[i])
            if j >= 0 and gain > 0:
                score[i], back[i] = weight[i] + gain, j
        else:
            tree.put(int(at_end[i]), (score[i] + GAP * (b1[i] + a1[i]), i))
    out, used = [], np.zeros(n, dtype=bool)
    for i in np.argsort(-score, kind="stable"):
        path = []
        while i >= 0 and not used[i]:
            used[i] = True
            path.append(int(i))
            i = back[i]
        if path:
            out.append(path[::-1])
    return out


def _chained(least: int):
    """:data:`CHAIN` of a part of the pairs; a lone match says nothing."""
    def run(rows: pa.Table) -> pa.Table:
        later, earlier, b, a = _spread(rows, "later", "earlier", "bpos", "apos")
        order = np.lexsort((earlier, later))
        later, earlier, b, a = later[order], earlier[order], b[order].astype(np.int64), a[order].astype(np.int64)
        start = np.flatnonzero(np.append(True, (later[1:] != later[:-1]) | (earlier[1:] != earlier[:-1])))
        size = np.diff(np.append(start, len(later)))
        pairs = pa.RecordBatch.from_arrays([pa.array(later[start]), pa.array(earlier[start])], ["later", "earlier"])
        several = np.repeat(size > 1, size)
        pair, seg = segments_of(np.repeat(np.arange(len(start)), size)[several], b[several], a[several])
        start = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])) if len(pair) else np.empty(0, np.int64)
        size = np.diff(np.append(start, len(pair)))
        one = start[(size == 1)]
        one = one[seg[one, 2] >= least]
        got = [_single(pairs, pair[one], *seg[one, :3].astype(np.int64).T)]
        rows = []
        for lo, n in zip(start[size > 1].tolist(), size[size > 1].tolist()):
            own = seg[lo:lo + n]
            for c in chains(own):
                s = own[c].astype(np.int64)
                if s[-1, 0] + s[-1, 2] - s[0, 0] >= least:
                    rows.append((int(pair[lo]), s[:, 0].tolist(), s[:, 1].tolist(), s[:, 2].tolist()))
        if rows:
            take = pa.array([r[0] for r in rows])
            got.append(pa.RecordBatch.from_arrays([pairs.column("later").take(take), pairs.column("earlier").take(take),
                                                   *(pa.array([r[i] for r in rows], pa.list_(pa.int32())) for i in (1, 2, 3))], ["later", "earlier", "b0", "a0", "len"]))
        return pa.Table.from_batches(got)

    return run


def _runs(hit: np.ndarray, drop: float) -> int:
    """How far to extend: the prefix of ``hit`` with the best score (+1 match,
    -2 difference) before the score falls ``drop`` below the best."""
    if not len(hit):
        return 0
    score = np.cumsum(np.where(hit, 1, -2))
    top = np.maximum.accumulate(np.maximum(score, 0))
    stop = np.flatnonzero(top - score > drop)
    score = score[:stop[0]] if len(stop) else score
    return int(score.argmax()) + 1 if len(score) and score.max() > 0 else 0


def align(bw: np.ndarray, aw: np.ndarray, boff: int, aoff: int, b0: np.ndarray, a0: np.ndarray, length: np.ndarray,
          drop: float = 12) -> tuple[int, int, int, int, int]:
    """``b start, b end, a start, a end, matching words`` of a chain.  ``bw``,
    ``aw``: word hashes of the two texts from positions ``boff``, ``aoff``."""
    b0, a0 = b0 - boff, a0 - aoff
    room = min(b0[0], a0[0])
    left = _runs((bw[b0[0] - room:b0[0]] == aw[a0[0] - room:a0[0]])[::-1], drop)
    be, ae = b0[-1] + length[-1], a0[-1] + length[-1]
    room = max(0, min(len(bw) - be, len(aw) - ae))
    right = _runs(bw[be:be + room] == aw[ae:ae + room], drop)
    got = int((bw[b0[0] - left:b0[0]] == aw[a0[0] - left:a0[0]]).sum() + (bw[be:be + right] == aw[ae:ae + right]).sum())
    for i in range(len(b0)):
        got += int((bw[b0[i]:b0[i] + length[i]] == aw[a0[i]:a0[i] + length[i]]).sum())
        if i + 1 < len(b0):                        # the gap: one diagonal, then the other
            bs, as_, bt, at = b0[i] + length[i], a0[i] + length[i], b0[i + 1], a0[i + 1]
            g = max(0, min(bt - bs, at - as_))
            head = np.concatenate([[0], np.cumsum(bw[bs:bs + g] == aw[as_:as_ + g])])
            tail = np.concatenate([[0], np.cumsum((bw[bt - g:bt] == aw[at - g:at])[::-1])])
            got += int((head + tail[::-1]).max())
    return int(b0[0] - left + boff), int(be + right + boff), int(a0[0] - left + aoff), int(ae + right + aoff), got


def _words_of(col: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """All word hashes of a column and where each row's begin (and end)."""
    edge = np.append(0, np.cumsum(np.asarray(pc.binary_length(col)))) // 4
    return np.frombuffer(b"".join(col.to_pylist()), "<u4"), edge


def _runs_of_all(bw: np.ndarray, aw: np.ndarray, b: np.ndarray, a: np.ndarray, room: np.ndarray, step: int, drop: float) -> tuple[np.ndarray, np.ndarray]:
    """:func:`_runs` of many rows at once, from the words ``b``, ``a`` on in
    the direction ``step``; and the matching words in them."""
    n, most = len(room), int(room.max(initial=0))
    if not most:
        return np.zeros(n, np.int64), np.zeros(n, np.int64)
    t = np.arange(most)
    inside = t < room[:, None]
    at = np.where(inside, step * t, 0)
    hit = inside & (bw[np.where(inside, b[:, None] + at, 0)] == aw[np.where(inside, a[:, None] + at, 0)])
    score = np.cumsum(np.where(hit, 1, np.where(inside, -2, -10**6)), axis=1)
    over = np.maximum.accumulate(np.maximum.accumulate(np.maximum(score, 0), axis=1) - score > drop, axis=1)
    score = np.where(over, -1, score)
    far = np.where(score.max(axis=1) > 0, score.argmax(axis=1) + 1, 0)
    return far, (hit & (t < far[:, None])).sum(axis=1)


def align_single(bw: np.ndarray, aw: np.ndarray, be: np.ndarray, ae: np.ndarray, b0: np.ndarray, a0: np.ndarray, length: np.ndarray,
                 drop: float = 12) -> tuple[np.ndarray, ...]:
    """:func:`align` of many chains of one segment: words before and after it,
    matching words in all, matching words of the segment.  ``bw``, ``aw``: the
    words of all rows, row ``i`` in ``be[i]:be[i + 1]``; ``b0``, ``a0`` from there."""
    b, a = be[:-1] + b0, ae[:-1] + a0
    left, got_left = _runs_of_all(bw, aw, b - 1, a - 1, np.minimum(b0, a0), -1, drop)
    room = np.maximum(0, np.minimum(be[1:] - b - length, ae[1:] - a - length))
    right, got_right = _runs_of_all(bw, aw, b + length, a + length, room, 1, drop)
    edge = np.append(0, np.cumsum(length))
    t = np.arange(edge[-1]) - np.repeat(edge[:-1], length)
    same = np.append(0, np.cumsum(bw[np.repeat(b, length) + t] == aw[np.repeat(a, length) + t]))
    own = same[edge[1:]] - same[edge[:-1]]
    return left, right, got_left + got_right + own, own


def _pieces(src: DataFrame, wanted: DataFrame) -> DataFrame:
    """Word hashes of the wanted block ranges ``doc, q0, q1`` of the texts."""
    spans = cut_lineage(wanted.distinct().groupBy("doc").agg(F.collect_set(F.struct("q0", "q1")).alias("spans")), "spans")
    joined = src.join(small_side(spans), F.col("id") == F.col("doc")).select("doc", "text", F.col("spans.q0").alias("q0"), F.col("spans.q1").alias("q1"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, q0, q1 = (b.column(c).to_pylist() for c in ("doc", "q0", "q1"))
            for lo, hi, buf, offs in slices(b.column("text")):
                words = Words(buf, offs)
                h = (words.hashes(lower=True) & np.uint64(0xFFFFFFFF)).astype("<u4")
                rows = [(ids[i], x, y, h[words.first[i - lo]:words.first[i - lo + 1]][x * BLOCK:y * BLOCK].tobytes())
                        for i in range(lo, hi) for x, y in zip(q0[i], q1[i])]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int32()), pa.array([r[3] for r in rows], pa.binary())], ["doc", "q0", "q1", "words"])

    return cut_lineage(joined.mapInArrow(run, "doc long, q0 int, q1 int, words binary"), "pieces")


def passages(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_words: int = 50, identity: float = 0.8) -> DataFrame:
    """``doc_id, start_word, end_word`` (exclusive) of every repeated passage,
    with the earlier document ``other_id, other_start, other_end`` and
    ``n_matching`` words, and the ``text_key`` of the row's text."""
    src = bounded_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("key")).where("id is not null")
    rows = cut_lineage(_word_counts(src).where("n > 0").distinct(), "texts")
    own = rows.groupBy("id").agg(F.min("key").alias("key"))
    if rows.join(own, ["id", "key"], "left_anti").isEmpty():
        return _passages(src, rows, min_words, identity)
    # ids with several texts: numbers in the order of id and key stand for ids
    numbers = cut_lineage(rows.select("id", "key").distinct().orderBy("id", "key").withColumn("doc", F.monotonically_increasing_id()), "numbers")
    with_doc = lambda df: df.join(small_side(numbers), ["id", "key"]).withColumn("id", F.col("doc")).drop("doc")
    found = _passages(with_doc(src).select("id", "text", "key"), with_doc(rows), min_words, identity)
    names = found.columns
    for c in ("doc_id", "other_id"):
        found = found.join(small_side(numbers.select(F.col("doc").alias(c), F.col("id").alias("__id"))), c).withColumn(c, F.col("__id")).drop("__id")
    return found.select(*names)


def _passages(src: DataFrame, rows: DataFrame, min_words: int, identity: float) -> DataFrame:
    """:func:`passages` of ``id, text, key`` with one text per id; ``rows``:
    ``id, key, n`` of the texts with words."""
    own = rows.select("id", "key")
    firsts = rows.groupBy("key", "n").agg(F.min("id").alias("first"))
    copies = cut_lineage(rows.join(firsts, ["key", "n"]).where("id <> first").select("id", "key", "n", "first"), "copies")
    aside = small_side(copies.select("id", "key"))
    left = src.join(aside, (src["id"] == aside["id"]) & (src["key"] == aside["key"]), "left_anti")
    least = min_words // 4
    n_words = rows.agg(F.sum("n")).first()[0] or 0
    met, bits = cut_lineage(meetings(left, n_words), "meetings"), range_bits(n_words)
    chained = matches(met, bits).unionByName(junction_matches(met, min_words, bits)).groupBy("part").applyInArrow(_chained(least), CHAIN)
    runs, windows = exact_runs(left, met, min_words)
    found = cut_lineage(chained.unionByName(runs).distinct(), "chains")
    discard(met, windows)
    ranged = found.select("*", *[F.expr(e).cast("int").alias(c) for c, e in (
        ("bq0", f"greatest(0, b0[0] - {PAD}) div {BLOCK}"), ("bq1", f"(element_at(b0, -1) + element_at(len, -1) + {PAD}) div {BLOCK} + 1"),
        ("aq0", f"greatest(0, a0[0] - {PAD}) div {BLOCK}"), ("aq1", f"(element_at(a0, -1) + element_at(len, -1) + {PAD}) div {BLOCK} + 1"))])
    wanted = ranged.select(F.col("later").alias("doc"), F.col("bq0").alias("q0"), F.col("bq1").alias("q1")).unionByName(
        ranged.select(F.col("earlier").alias("doc"), F.col("aq0").alias("q0"), F.col("aq1").alias("q1")))
    pieces = _pieces(left, wanted)
    side = lambda doc, p: pieces.select(F.col("doc").alias(doc), F.col("q0").alias(f"{p}q0"), F.col("q1").alias(f"{p}q1"), F.col("words").alias(f"{p}w"))
    both = ranged.join(side("later", "b"), ["later", "bq0", "bq1"]).join(side("earlier", "a"), ["earlier", "aq0", "aq1"])

    names = ["doc_id", "start_word", "end_word", "other_id", "other_start", "other_end", "n_matching"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alone = pc.equal(pc.list_value_length(batch.column("len")), 1)
            f = batch.filter(alone)
            (bw, be), (aw, ae) = _words_of(f.column("bw")), _words_of(f.column("aw"))
            b0, a0, n = (v.astype(np.int64) for v in _spread(f, "b0", "a0", "len"))
            left, right, got, own = align_single(bw, aw, be, ae, b0 - np.asarray(f.column("bq0"), np.int64) * BLOCK, a0 - np.asarray(f.column("aq0"), np.int64) * BLOCK, n)
            far = (n >= min_words) & (got < identity * (left + n + right))       # extended too far: the segment alone
            left, right, got = np.where(far, 0, left), np.where(far, 0, right), np.where(far, own, got)
            total = left + n + right
            ok = (total >= min_words) & (got >= identity * total)
            later, earlier = np.asarray(f.column("later")), np.asarray(f.column("earlier"))
            yield pa.RecordBatch.from_arrays([pa.array(v[ok].astype(np.int64)) for v in (later, b0 - left, b0 + n + right, earlier, a0 - left, a0 + n + right, got)], names)
            found = []
            for r in batch.filter(pc.invert(alone)).to_pylist():
                bw, aw = np.frombuffer(r["bw"], "<u4"), np.frombuffer(r["aw"], "<u4")
                x = align(bw, aw, r["bq0"] * BLOCK, r["aq0"] * BLOCK, np.asarray(r["b0"]), np.asarray(r["a0"]), np.asarray(r["len"]))
                if x[1] - x[0] >= min_words and x[4] >= identity * max(x[1] - x[0], x[3] - x[2]):
                    found.append((r["later"], x[0], x[1], r["earlier"], *x[2:]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names)

    schema = ", ".join(f"{c} long" for c in names)
    both = both.select("later", "earlier", "b0", "a0", "len", "bq0", "aq0", "bw", "aw")
    fuzzy = both.mapInArrow(run, schema).distinct().join(own.select(F.col("id").alias("doc_id"), F.col("key").alias("text_key")), "doc_id")
    whole = copies.where(F.col("n") >= min_words).select(F.col("id").alias("doc_id"), F.lit(0).cast("long").alias("start_word"), F.col("n").alias("end_word"),
                                                         F.col("first").alias("other_id"), F.lit(0).cast("long").alias("other_start"), F.col("n").alias("other_end"),
                                                         F.col("n").alias("n_matching"), F.col("key").alias("text_key"))
    return fuzzy.unionByName(whole)


def remove_passages(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: str | None = "n_chars", **kwargs) -> DataFrame:
    """``docs`` with the repeated passages cut out of the later documents (and
    ``length`` set to the code points left); a document without a word left
    goes.  All columns; untouched rows stay as they are."""
    spans = passages(docs, id_col, text, **kwargs).groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("start_word", "end_word")).alias("__spans"))
    side = small_side(spans.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), "__spans"))
    names = docs.columns
    keyed = docs.withColumn("__k", F.xxhash64(text))
    joined = keyed.join(side, (keyed[id_col] == side["__id"]) & (keyed["__k"] == side["__key"]), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans, out = b.column("__spans").to_pylist(), []
            for lo, hi, buf, offs in slices(b.column("__text")):
                words, raw = Words(buf, offs), buf.tobytes()
                for i in range(lo, hi):
                    d = i - lo
                    starts, ends = words.starts[words.first[d]:words.first[d + 1]], words.ends[words.first[d]:words.first[d + 1]]
                    keep = np.ones(len(starts), dtype=bool)
                    for s in spans[i]:
                        keep[s["start_word"]:s["end_word"]] = False
                    at, left = int(offs[d]), []
                    edge = np.flatnonzero(np.diff(np.concatenate([[True], keep, [True]]).astype(np.int8)))
                    for x, y in zip(edge[::2], edge[1::2]):
                        left.append(raw[at:int(starts[x])])
                        at = int(ends[y - 1])
                    left.append(raw[at:int(offs[d + 1])])
                    out.append(b"".join(left).decode("utf-8", "replace") if keep.any() else None)
            rest = [c for c in b.schema.names if c not in ("__text", "__spans")]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in rest), pa.array(out, pa.string())], [*rest, "__left"])

    from pyspark.sql.types import StringType, StructType
    others = [n for n in names if n != text]
    hit = joined.where("__spans is not null").select(*others, F.col(text).alias("__text"), "__spans")
    done = hit.mapInArrow(cut, StructType([docs.schema[n] for n in others]).add("__left", StringType())).where("__left is not null")
    done = done.select(*[F.col("__left").alias(text) if n == text else F.char_length("__left").cast(docs.schema[n].dataType).alias(n) if n == length else F.col(n) for n in names])
    return joined.where("__spans is null").select(*names).unionByName(done)
