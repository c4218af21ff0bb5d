"""Token ids as compressed binary blocks with a shared zstandard dictionary.

A dictionary is trained on the serialised id arrays of sampled documents.  Each
document's ids (little-endian unsigned 32-bit) are compressed alone with it, so
one short document is read without its neighbours.  Documents lie in blocks in
id order; a block keeps its documents' ids, the offsets of their frames in its
``data``, their numbers of ids and the dictionary's hash.  Blocks are the rows
of a Parquet table (``blocks``), beside it the dictionary (``dictionary``):
Spark's own committed writes on any store, and a filter on ``first_id`` and
``last_id`` reaches the scan when one document is wanted.

The dictionary changes sizes, never ids: it is fitted on the ``SAMPLE_DOCS``
distinct texts with the smallest hashes among those of at most ``SAMPLE_CHARS``
characters (fewer, if few texts are that short).

Defined cases: a null text is an empty one and has only the end id; rows are
ordered by id (nulls first), then by a hash of the text; repeated rows are
repeated documents; an empty table gives an empty file set and an empty result;
with too little text to train on, frames are compressed without a dictionary
(hash 0); other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickscope.llm.ordered import cut_points, offsets, part_of
from clickscope.llm.tables import bounded_batches
from clickscope.llm.textops import slices

SAMPLE_DOCS, SAMPLE_CHARS, DICTIONARY_BYTES = 500, 8_000, 64 << 10
#: A reader holds a row group at a time, so blocks and row groups stay small.
BLOCK_BYTES, GROUP_BYTES = 1 << 16, 8 << 20
TABLE_PARTS, STEP_BYTES = 400_000, 6 << 20
#: Texts of these characters split into the tokenizer's parts with _PARTS:
#: ASCII and Latin-1 letters, on which its normaliser only lower-cases.
_PLAIN = re.compile("[\t\n\r -~À-ÖØ-öø-ÿ]*")
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\t\n\r a-z0-9ß-öø-ÿ]+")
_GAP = np.zeros(256, bool)
_GAP[[9, 10, 13, 32]] = True


def distinct_words(buf: np.ndarray, offs: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words of a slice of texts (between the white space at which
    this tokenizer ends a word), each word's number among them, and each
    text's number of words."""
    inside = ~_GAP[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[offs] = True
    first, last = inside & edge[:-1], inside & edge[1:]
    first[1:] |= inside[1:] & ~inside[:-1]
    last[:-1] |= inside[:-1] & ~inside[1:]
    starts = np.flatnonzero(first)
    # without the white space the words lie end to end: an Arrow string array
    at = np.concatenate([[0], np.cumsum(np.flatnonzero(last) + 1 - starts)]).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(buf[inside])))
    coded = words.dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False), np.diff(np.searchsorted(starts, offs))


class WordEncoder:
    """Ids of whole texts from a bounded table of distinct parts.

    White space ends words in this tokenizer, so a text's ids are its words'
    ids one after another: Arrow numbers the words of a slice, each distinct
    one is encoded once, and numpy places its ids wherever it stands.  Parts of
    words (runs of letters, digits, runs of other characters) are encoded alone
    as well; a table keeps them from slice to slice.  A word with other
    characters is one key of the table (after a space).

    The table has two generations of ``TABLE_PARTS / 2`` entries: parts that
    come again move to the young one, the old one is given up when the young
    one is full."""

    def __init__(self, path: str):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.parts: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.ends = np.array([(self.tok.id_to_token(i) or "").endswith("</w>") for i in range(self.tok.get_vocab_size())])

    def _encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for i in range(0, len(texts), 10_000):
            out += [np.array(e.ids, "<u4").tobytes() for e in self.tok.encode_batch_fast(texts[i:i + 10_000], add_special_tokens=False)]
        return out

    def _encode_parts(self, parts: list[str], step: int = 500) -> list[bytes]:
        """As ``_encode``, many at once: the last id of a part ends a word."""
        out: list[bytes] = []
        groups = [parts[i:i + step] for i in range(0, len(parts), step)]
        for group, e in zip(groups, self.tok.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(e.ids, "<u4")
            cut = np.flatnonzero(self.ends[ids]) + 1
            if len(cut) == len(group) and cut[-1] == len(ids):
                raw, at = ids.tobytes(), [0, *(4 * cut).tolist()]
                out += [raw[x:y] for x, y in zip(at, at[1:])]
            else:
                out += self._encode(group)
        return out

    @staticmethod
    def split(word: str) -> list[str]:
        return _PARTS.findall(word.lower()) if "<|" not in word and _PLAIN.fullmatch(word) else [" " + word]

    def learn(self, every: set[str]) -> None:
        """Afterwards the young generation holds all of ``every``."""
        new = every - self.parts.keys()
        if len(self.parts) + len(new) > TABLE_PARTS // 2:
            self.old, self.parts, new = self.parts, {}, every
        for k in new & self.old.keys():
            self.parts[k] = self.old[k]
        new = new - self.old.keys()
        plain = [k for k in new if k[0] != " "]
        odd = [k for k in new if k[0] == " "]
        self.parts.update(zip(plain, self._encode_parts(plain)))
        self.parts.update(zip(odd, self._encode([k[1:] for k in odd])))

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        """Ids of each text of a string array (null: none), as little-endian
        unsigned 32-bit integers."""
        for _, _, buf, offs in slices(texts, STEP_BYTES):
            words, number, counts = distinct_words(buf, offs)
            # a word of ASCII letters is one part
            keys = [w.lower() if w.isalpha() and w.isascii() else self.split(w) for w in words]
            mixed = [k for k in keys if type(k) is list]
            self.learn({k for k in keys if type(k) is str}.union(*mixed))
            parts = self.parts
            coded = [parts[k] if type(k) is str else b"".join([parts[x] for x in k]) for k in keys]
            ids = np.frombuffer(b"".join(coded), "<u4")
            size = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
            length = size[number]
            end = np.cumsum(length)
            # place of every id: its word's first id and how far it is into it
            take = np.arange(end[-1] if len(end) else 0) + np.repeat((np.cumsum(size) - size)[number] - (end - length), length)
            raw = ids[take].tobytes()
            cut = 4 * np.concatenate([[0], end])[np.concatenate([[0], np.cumsum(counts)])]
            for x, y in zip(cut[:-1].tolist(), cut[1:].tolist()):
                yield raw[x:y]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One table per Python worker and tokenizer."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def train_dictionary(docs: DataFrame, tokenizer: str, text: str, end_id: int) -> bytes:
    """Shared dictionary; empty if the sample is too small to train on."""
    import zstandard
    # about four times the sample lies under this hash: few texts leave a task
    edge = -(2**63) + min(2**64 - 1, 2**64 * 4 * SAMPLE_DOCS // max(1, docs.count()))
    short = docs.where(F.length(text).between(1, SAMPLE_CHARS)).select(F.col(text).alias("t"))
    rows = short.where(F.xxhash64("t") <= F.lit(edge).cast("long")).distinct().orderBy(F.xxhash64("t")).limit(SAMPLE_DOCS).collect()
    end = np.array([end_id], "<u4").tobytes()
    samples = [x + end for x in encoder(tokenizer).encode(pa.array([r["t"] for r in rows], pa.string()))]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def dictionary_hash(dictionary: bytes) -> int:
    return zlib.crc32(dictionary) if dictionary else 0


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text: str = "text") -> None:
    """Encodes all rows and writes ``path``/blocks and ``path``/dictionary."""
    spark = docs.sparkSession
    dictionary = train_dictionary(docs, tokenizer, text, end_id)
    mark = dictionary_hash(dictionary)
    spark.createDataFrame([(mark, bytearray(dictionary))], "hash long, dictionary binary").coalesce(1).write.mode("overwrite").parquet(f"{path}/dictionary")
    key = F.xxhash64(text)
    tie = (F.shiftrightunsigned(key, 11) / 2.0**53)
    cuts = cut_points(docs, id_col)
    src = bounded_batches(docs).select(F.col(id_col).cast("long").alias("id"), key.alias("key"), part_of(F.col(id_col), cuts, tie).alias("part"), F.col(text).alias("text"))

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        given = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if given:
            given.precompute_compress(level=1)         # digested once, not per document
        press = zstandard.ZstdCompressor(level=1, dict_data=given, write_content_size=True)
        end, enc = np.array([end_id], "<u4").tobytes(), encoder(tokenizer)
        for b in gathered(batches, "text", STEP_BYTES):
            frames, n = [], []
            for x in enc.encode(b.column("text")):
                frames.append(press.compress(x + end))
                n.append(len(x) // 4 + 1)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("key"), b.column("part"), pa.array(frames, pa.binary()), pa.array(n, pa.int64())], ["id", "key", "part", "frame", "n"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        number = {}

        def block(rows: list[tuple]) -> pa.RecordBatch:
            ids, parts, frames, n = zip(*rows)
            offs = np.concatenate([[0], np.cumsum([len(f) for f in frames])])
            at = number.get(parts[0], 0)
            number[parts[0]] = at + 1
            return pa.RecordBatch.from_arrays([pa.array([parts[0]], pa.int64()), pa.array([at], pa.int64()), pa.array([ids[0]], pa.int64()), pa.array([ids[-1]], pa.int64()),
                                               pa.array([list(ids)], pa.list_(pa.int64())), pa.array([offs.tolist()], pa.list_(pa.int64())), pa.array([list(n)], pa.list_(pa.int64())),
                                               pa.array([b"".join(frames)], pa.binary()), pa.array([mark], pa.int64())],
                                              ["part", "number", "first_id", "last_id", "ids", "offsets", "n_tokens", "data", "dictionary_hash"])

        size = 0
        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("id", "part", "frame", "n"))):
                if held and (row[1] != held[0][1] or size + len(row[2]) > BLOCK_BYTES):
                    yield block(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[2])
        if held:
            yield block(held)

    frames = src.mapInArrow(compress, "id long, key long, part long, frame binary, n long")
    dealt = frames.repartition("part").sortWithinPartitions("part", "id", "key")
    dealt.mapInArrow(pack, "part long, number long, first_id long, last_id long, ids array<long>, offsets array<long>, n_tokens array<long>, data binary, dictionary_hash long"
                     ).write.mode("overwrite").option("parquet.block.size", GROUP_BYTES).parquet(f"{path}/blocks")


def gathered(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of ``column``: the
    more text at once, the more often a word comes again."""
    held, size = [], 0
    for b in batches:
        more = b.column(column).nbytes
        if held and size + more > limit:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(b)
        size += more
    if held:
        yield pa.concat_batches(held)


def _dictionary(spark: SparkSession, path: str) -> bytes:
    return bytes(spark.read.parquet(f"{path}/dictionary").first()["dictionary"])


def _decompressor(dictionary: bytes):
    import zstandard
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def read(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """``id``, ``part``, ``number`` (of the block), ``place`` in it and
    ``tokens`` (the document's little-endian ids) of every document, or of
    those whose ``id`` passes ``where`` (only their frames are decompressed)."""
    dictionary = _dictionary(spark, path)
    mark = dictionary_hash(dictionary)
    blocks = spark.read.parquet(f"{path}/blocks")
    index = blocks.select("part", "number", "dictionary_hash", "data", F.posexplode(F.arrays_zip(F.col("ids").alias("id"), F.slice("offsets", 1, F.size("ids")).alias("lo"), F.slice("offsets", 2, F.size("ids")).alias("hi"))).alias("place", "d"))
    rows = index.select(F.col("d.id").alias("id"), "part", "number", "place", "dictionary_hash", F.expr("substring(data, cast(d.lo + 1 as int), cast(d.hi - d.lo as int))").alias("frame"))
    rows = rows if where is None else rows.where(where)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = _decompressor(dictionary)
        for b in batches:
            if any(h != mark for h in b.column("dictionary_hash").to_pylist()):
                raise ValueError("a block was written with another dictionary")
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("id", "part", "number", "place")), pa.array([press.decompress(f) for f in b.column("frame").to_pylist()], pa.binary())],
                                             ["id", "part", "number", "place", "tokens"])

    return rows.mapInArrow(unpack, "id long, part long, number long, place int, tokens binary")


def summary(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: ``doc_id``, ``start`` (ids of all
    documents before it), ``n_tokens`` and ``ids_crc32``."""
    blocks = spark.read.parquet(f"{path}/blocks").select("part", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda s, x: s + x).alias("n"))
    before = offsets(blocks, "part", {"before": F.col("n")})
    docs = read(spark, path).select("id", "part", "number", "place", (F.octet_length("tokens") / 4).cast("long").alias("n"), F.crc32("tokens").alias("crc"))
    w = Window.partitionBy("part").orderBy("number", "place").rowsBetween(Window.unboundedPreceding, -1)
    return docs.withColumn("inside", F.coalesce(F.sum("n").over(w), F.lit(0))).join(before, "part").select(
        F.col("id").alias("doc_id"), (F.col("inside") + F.col("before")).cast("long").alias("start"), F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"))
