"""Token-id files: ids packed at the vocabulary's fixed bit width, in blocks with offsets.

A file is a header, the documents (id, whether it is null, first token), the byte offset of every block, and the blocks.
Any run of ids can be read by unpacking only the blocks that hold it. Spark writes the files as the binary column of a
Parquet table in the shared folder, ordered by (part, number), so every file system that Spark knows will do.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from couponlens.llm.bpe import encoded, encoder, vocabulary
from couponlens.llm.common import partitions, rows, stored, texts_only

_HEAD = struct.Struct("<4sHHIqqq")  # mark, version, bits, ids in a block, documents, ids, blocks
_MARK = b"IDPK"
BLOCK = 16_384  # ids in a block; a multiple of eight, so blocks end on whole bytes
FILE_IDS = 4_000_000  # a file is closed when it holds so many


def width(vocabulary_size: int) -> int:
    """Bits that the largest id needs."""
    return max(1, int(vocabulary_size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if len(ids) and (int(ids.min()) < 0 or int(ids.max()) >> bits):
        raise ValueError("an id does not fit the width")
    used = -(-bits // 8)  # bytes of an id that can differ from 0
    low = np.ascontiguousarray(ids, ">u4").view(np.uint8).reshape(-1, 4)[:, 4 - used :]
    return low.tobytes() if bits == 8 * used else np.packbits(np.unpackbits(low, axis=1)[:, 8 * used - bits :]).tobytes()


def unpack(raw: bytes, n: int, bits: int) -> np.ndarray:
    used = -(-bits // 8)
    low = np.frombuffer(raw, np.uint8)
    if bits < 8 * used:
        planes = np.zeros((n, 8 * used), np.uint8)
        planes[:, 8 * used - bits :] = np.unpackbits(low, count=n * bits).reshape(n, bits)
        low = np.packbits(planes, axis=1)
    out = np.zeros((n, 4), np.uint8)
    out[:, 4 - used :] = low.reshape(-1, used)[:n]
    return out.view(">u4").ravel().astype(np.uint32)


def write_file(doc_ids: list[int | None], starts: np.ndarray, ids: np.ndarray, bits: int, block: int = BLOCK) -> bytes:
    blocks = [pack(ids[a : a + block], bits) for a in range(0, len(ids), block)]
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in blocks])]).astype("<i8")
    head = _HEAD.pack(_MARK, 1, bits, block, len(doc_ids), len(ids), len(blocks))
    keys = np.array([x or 0 for x in doc_ids], "<i8").tobytes()
    return b"".join([head, keys, bytes(x is None for x in doc_ids), np.asarray(starts, "<i8").tobytes(), offsets.tobytes(), *blocks])


class TokenFile:
    """Reads one file; ``ids(a, b)`` unpacks only the blocks that hold the places a to b."""

    def __init__(self, raw: bytes) -> None:
        mark, version, self.bits, self.block, n, self.n_ids, n_blocks = _HEAD.unpack_from(raw)
        if mark != _MARK or version != 1:
            raise ValueError("not a token-id file")
        at = _HEAD.size
        keys, at = np.frombuffer(raw, "<i8", n, at), at + 8 * n
        null, at = np.frombuffer(raw, np.uint8, n, at), at + n
        self.doc_ids = pa.array(keys, mask=null.astype(bool))
        starts, at = np.frombuffer(raw, "<i8", n, at), at + 8 * n
        self.starts = np.concatenate([starts, [self.n_ids]])
        self.offsets, at = np.frombuffer(raw, "<i8", n_blocks + 1, at), at + 8 * (n_blocks + 1)
        self.body = memoryview(raw)[at:]

    def ids(self, a: int, b: int) -> np.ndarray:
        if a >= b:
            return np.zeros(0, np.uint32)
        first, last = a // self.block, (b - 1) // self.block + 1
        held = min(last * self.block, self.n_ids) - first * self.block
        got = unpack(self.body[self.offsets[first] : self.offsets[last]], held, self.bits)
        return got[a - first * self.block : b - first * self.block]


def write_token_files(docs: DataFrame, vocab_path: str, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encodes all documents in ascending order of their id, each closed by ``end_id``, and stores the files.

    Returns the stored table: part, number, n_ids, file. Null texts count as empty, a null id comes first, rows with
    the same id are ordered by text, an empty table gives no file. Documents are dealt out by ranges of their ids.
    """
    packed = vocabulary(vocab_path)

    def run(batches):
        bits = width(max(encoder(packed).size, end_id + 1))
        part, number, held, keys, sizes, total = TaskContext.get().partitionId(), 0, [], [], [], 0

        def closed():
            starts = np.cumsum([0, *sizes])[:-1]
            return rows(
                part=pa.array([part], pa.int32()), number=pa.array([number], pa.int32()), n_ids=[total],
                file=[write_file(keys, starts, np.concatenate(held), bits)])

        for got, ids, begins in encoded(batches, packed):
            held.append(np.insert(ids, begins[1:], end_id))
            sizes += (np.diff(begins) + 1).tolist()
            keys += got.to_pylist()
            total += len(held[-1])
            if total >= FILE_IDS:
                yield closed()
                number, held, keys, sizes, total = number + 1, [], [], [], 0
        if keys:
            yield closed()

    dealt = texts_only(docs, key, text).repartitionByRange(partitions(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id", "text")
    return stored(dealt.mapInArrow(run, "part int, number int, n_ids long, file binary"), "token-files")


def read_token_files(files: DataFrame) -> DataFrame:
    """One row per stored document: doc_id, start (ids of all documents before it), n_tokens and the CRC-32 of its ids as
    little-endian 32-bit integers. File totals are summed within parts and over parts, so no task sees all files."""
    totals = files.select("part", "number", "n_ids")
    parts = totals.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    parts = parts.select("part", (F.sum("part_ids").over(Window.orderBy("part")) - F.col("part_ids")).alias("part_base"))
    inside = Window.partitionBy("part").orderBy("number")
    bases = totals.withColumn("file_base", F.sum("n_ids").over(inside) - F.col("n_ids")).join(parts, "part")
    bases = bases.select("part", "number", (F.col("file_base") + F.col("part_base")).alias("base"))

    def run(batches):
        for batch in batches:
            for part, number, raw in zip(*(batch.column(i).to_pylist() for i in range(3))):
                file = TokenFile(raw)
                sizes, crcs = np.diff(file.starts), []
                step = max(1, file.block)
                held, low = file.ids(0, min(step, file.n_ids)), 0
                for a, b in zip(file.starts[:-1].tolist(), file.starts[1:].tolist()):
                    if b > low + len(held):
                        low, held = a, file.ids(a, min(max(b, a + step), file.n_ids))
                    crcs.append(zlib.crc32(held[a - low : b - low].astype("<u4")))
                n = len(sizes)
                yield rows(
                    part=pa.array([part] * n, pa.int32()), number=pa.array([number] * n, pa.int32()), doc_id=file.doc_ids,
                    local=file.starts[:-1], n_tokens=sizes, ids_crc32=pa.array(crcs, pa.int64()))

    read = files.select("part", "number", "file").mapInArrow(run, "part int, number int, doc_id long, local long, n_tokens long, ids_crc32 long")
    return read.join(bases, ["part", "number"]).select("doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")
