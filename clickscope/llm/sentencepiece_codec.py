"""SentencePiece encoding and decoding over a table of distinct chunks.

When no piece of the vocabulary has a word marker after another character,
merges never cross from a character into a marker: a text is the sequence of
its chunks (a run of markers and what follows up to the next marker), and its
ids are the chunks' ids one after another.  The same holds for a line break,
which no longer piece contains: a chunk also ends before one.  Each distinct chunk of a task's
texts is segmented and decoded once; the texts' ids and decoded texts are
joined from that table by position.

The table lives in the Python worker in two generations of ``TABLE_CHUNKS / 2``
entries: chunks that come again move to the young one, the old one is given up
when the young one is full.  Memory stays bounded and no chunk is dropped.

A vocabulary with crossing pieces is refused (checked piece by piece), and so
is a model that changes texts (checked on a probe).

Defined cases: a null text is an empty one, whose only id is the end id and
whose decoded text is empty; repeated rows give repeated results; an empty
table gives an empty result; other columns may be kept by name.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

from clickscope.llm.tables import bounded_batches

MARK = "▁"
TABLE_CHUNKS = 300_000
STEP_CHARS = 500_000
_CHUNK = re.compile(" +[^ \n]*|\n[^ \n]*")


class ChunkTable:
    """Distinct chunk -> its ids as decimal text, and its decoded text."""

    def __init__(self, model: str):
        import sentencepiece
        self.sp = sentencepiece.SentencePieceProcessor(model_file=model)
        for i in range(self.sp.get_piece_size()):
            if not (self.sp.is_control(i) or self.sp.is_byte(i) or self.sp.is_unknown(i)) and (
                    MARK in self.sp.id_to_piece(i).lstrip(MARK) or "\n" in self.sp.id_to_piece(i)):
                raise ValueError("a piece crosses word markers or lines: chunks can't be encoded alone")
        probe = " a  b\tc\néé Ａ "
        if self.sp.decode(self.sp.encode(probe)) != probe:
            raise ValueError("the model changes texts: chunks can't be encoded alone")
        self.mark_id = self.sp.piece_to_id(MARK)
        self.lead = self.sp.encode("a")
        self.end = self.sp.eos_id()
        self.names = [str(i) for i in range(self.sp.get_piece_size())]
        self.ids: dict[str, str] = {}
        self.old: dict[str, str] = {}
        self.changed: dict[str, str] = {}          # chunks that decode to another text

    def learn(self, chunks: set[str]) -> None:
        """Afterwards the young generation holds all of ``chunks``."""
        # chunk by chunk: a set less a dict's keys would walk the whole table
        new = [c for c in chunks if c not in self.ids]
        if len(self.ids) + len(new) > TABLE_CHUNKS // 2:
            self.old, self.ids, new = self.ids, {}, list(chunks)
        self.ids.update((c, self.old[c]) for c in new if c in self.old)
        new = [c for c in new if c not in self.old]
        # the encoder puts one marker before a text: it stands for a chunk's
        # first space, goes where a chunk starts with a line break, and a lone
        # marker needs none
        found = self.sp.encode([c if c[0] == "\n" else c[1:] for c in new], num_threads=1)
        found = [x[1:] if c[0] == "\n" else x or [self.mark_id] for c, x in zip(new, found)]
        self.ids.update(zip(new, [" ".join([self.names[i] for i in x]) for x in found]))
        # one thread: by default each call starts as many as the machine has cores
        back = self.sp.decode([self.lead + x for x in found], num_threads=1)
        self.changed.update((c, t[1:]) for c, t in zip(new, back) if t[1:] != c)

    def encode(self, texts: list[str]) -> Iterator[tuple[str, str]]:
        """Ids as decimal text (without the end id) and decoded text of each."""
        i = 0
        while i < len(texts):
            j, chars = i, 0
            while j < len(texts) and (j == i or chars + len(texts[j]) <= STEP_CHARS):
                chars += len(texts[j])
                j += 1
            chunks = [_CHUNK.findall(" " + t.replace(MARK, " ")) if t else [] for t in texts[i:j]]
            self.learn(set().union(*chunks))
            for c in chunks:
                decoded = c if not self.changed or self.changed.keys().isdisjoint(c) else [self.changed.get(x, x) for x in c]
                yield " ".join(map(self.ids.__getitem__, c)), "".join(decoded)[1:]
            i = j


_TABLES: dict[str, ChunkTable] = {}


def chunk_table(model: str) -> ChunkTable:
    """One table per Python worker and model."""
    if model not in _TABLES:
        _TABLES[model] = ChunkTable(model)
    return _TABLES[model]


def round_trip(docs: DataFrame, model: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), with_ids: bool = True) -> DataFrame:
    """``keep`` columns, ``n_tokens`` (with the end id), ``ids_sha256`` and
    ``decoded_sha256``; with ``with_ids`` also the ``ids`` and ``decoded``."""
    src = bounded_batches(docs.select(*keep, F.col(text).alias("__text")))
    schema = StructType([src.schema[c] for c in keep]).add("n_tokens", LongType()).add("ids_sha256", StringType()).add("decoded_sha256", StringType())
    if with_ids:
        schema = schema.add("ids", ArrayType(IntegerType())).add("decoded", StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = chunk_table(model)
        end = str(table.end)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for b in batches:
            n, ids_sha, dec_sha, ids, dec = [], [], [], [], []
            for joined, decoded in table.encode([t or "" for t in b.column("__text").to_pylist()]):
                joined = f"{joined} {end}" if joined else end
                n.append(joined.count(" ") + 1)
                ids_sha.append(sha(joined))
                dec_sha.append(sha(decoded))
                if with_ids:
                    ids.append([int(x) for x in joined.split(" ")])
                    dec.append(decoded)
            cols = [*(b.column(c) for c in keep), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(dec_sha, pa.string())]
            if with_ids:
                cols += [pa.array(ids, pa.list_(pa.int32())), pa.array(dec, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, schema.names)

    return src.mapInArrow(run, schema)
