"""SHA-256 of files too large for one task.

SHA-256 takes a file's bytes in order, but all it carries from one byte to the
next is a state of 112 bytes.  Each task reads one part of a file and hands
that state on, so no task reads or holds a whole file.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Callable, Iterable
from math import ceil

from pyspark import RDD
from pyspark.sql import SparkSession

#: Most bytes of a part.
PART = 64_000_000

#: Bytes hashed at once.
_CHUNK = 1 << 16


class _State(ctypes.Structure):
    """OpenSSL's ``SHA256_CTX``; ``hashlib`` cannot hand its own on."""
    _fields_ = [("h", ctypes.c_uint32 * 8), ("bits", ctypes.c_uint32 * 2), ("data", ctypes.c_uint32 * 16),
                ("num", ctypes.c_uint), ("md_len", ctypes.c_uint)]


def _openssl() -> ctypes.CDLL:
    """The OpenSSL that ``hashlib`` runs on."""
    import _hashlib
    return ctypes.CDLL(_hashlib.__file__)


def first_state() -> bytes:
    state = _State()
    _openssl().SHA256_Init(ctypes.byref(state))
    return bytes(state)


def advance(state: bytes, records: Iterable[bytes]) -> tuple[bytes, int]:
    """The state after ``records``, and how many bytes they had."""
    update, to, n, held = _openssl().SHA256_Update, _State.from_buffer_copy(state), 0, bytearray()

    def take() -> int:
        update(ctypes.byref(to), bytes(held), ctypes.c_size_t(len(held)))
        return len(held)

    for record in records:
        held += record
        if len(held) >= _CHUNK:
            n += take()
            held.clear()
    n += take()
    return bytes(to), n


def digest(state: bytes) -> str:
    out = ctypes.create_string_buffer(32)
    _openssl().SHA256_Final(out, ctypes.byref(_State.from_buffer_copy(state)))
    return out.raw.hex()


def resumable() -> bool:
    """Whether this Python's OpenSSL has SHA-256 functions with an open state."""
    try:
        return digest(advance(first_state(), [b"abc"])[0]) == hashlib.sha256(b"abc").hexdigest()
    except (ImportError, AttributeError, OSError):
        return False


def cut(length: int, part: int = PART) -> list[tuple[int, int, int, int | None]]:
    """A file's bytes in order as ``(record, split, first, end)``: partitions
    ``first`` to ``end`` (none: the last) of the file in splits of ``split``
    bytes, read in records of ``record`` bytes.

    Only whole records can be read, so equal parts leave a rest that is read
    by single bytes; tenths of a part before it keep it near a hundredth of
    one.  What each leaves is over a tenth of its split, as Hadoop joins less
    to the split before it."""
    parts = ceil(length / part)
    size = int(length / (parts + 0.1115)) // 100 * 100
    tenth = size // 10
    end = 10 * parts + int((length - parts * size) / tenth - 0.11)
    return [(size // 100, size, 0, parts), (size // 100, tenth, 10 * parts, end), (1, tenth, end, None)]


def splittable(spark: SparkSession, path: str) -> bool:
    """Whether Hadoop reads ranges of the file: not by a compressed one's name."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop
    codecs = hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration())
    return codecs.getCodec(hadoop.fs.Path(path)) is None


def _records(spark: SparkSession, path: str, record: int, split: int) -> RDD:
    """The bytes of one file as records, a partition per ``split`` bytes."""
    literal = "".join("{\\,}" if c == "," else "\\" + c if c in "*?[]{}\\" else c for c in path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    names = [f"mapreduce.input.fileinputformat.split.{bound}size" for bound in ("min", "max")]
    before = {name: conf.get(name) for name in names}
    try:
        for name in names:
            conf.set(name, str(split))
        return spark.sparkContext.binaryRecords(literal, record)
    finally:
        for name, value in before.items():
            conf.unset(name) if value is None else conf.set(name, value)


def _step(states: dict[int, bytes]) -> Callable:
    return lambda i, records: [(i, *advance(states[i], records))]


def file_digests(spark: SparkSession, files: list[tuple[str, int]], part: int = PART) -> list[tuple[str, str]]:
    """``(path, SHA-256)`` of files given with their lengths.

    Job k reads part k of every file that has one; only the states come to the
    driver between jobs.  Every byte is read once, by its own task."""
    sc, rdds, order, at = spark.sparkContext, [], [], 0
    for path, length in files:
        order.append([])
        for record, split, first, end in cut(length, part):
            rdds.append(_records(spark, path, record, split))
            n = rdds[-1].getNumPartitions()
            order[-1] += range(at + first, at + (n if end is None else end))
            at += n
    everything = sc.union(rdds)
    states, read = [first_state() for _ in files], [0] * len(files)
    for k in range(max(map(len, order))):
        file_of = {o[k]: f for f, o in enumerate(order) if k < len(o)}
        job = everything.mapPartitionsWithIndex(_step({i: states[f] for i, f in file_of.items()}))
        for i, state, n in sc.runJob(job, list, sorted(file_of)):
            states[file_of[i]] = state
            read[file_of[i]] += n
    for (path, length), n in zip(files, read):
        if n != length:
            raise RuntimeError(f"{path}: {n} of {length} bytes read")
    return [(path, digest(state)) for (path, _), state in zip(files, states)]
