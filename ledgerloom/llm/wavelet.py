"""Token ids in wavelet matrices: one compressed file image a shard, with random access, counting and lookup.

A shard holds the ids of whole documents in order. Ids are renamed by falling frequency, so the upper bit planes
are nearly all zeros and compress well. Plane l holds bit l of every name, in the order left by a stable split on
the planes above; the ones before each block are stored, so a rank reads one block a plane. Blocks are compressed
one by one, and a reader unpacks only those it needs.

Shard images are rows of a Parquet table (part, shard, first, n_tokens, n_docs, image) that Spark commits, so a
lost executor leaves no half-written file and any Hadoop file system serves. An image stands alone: ``Shard``
opens it from its bytes. Layout, little-endian: magic "WMX1"; uint64 length of the directory; the directory (zlib
of int64 values: tokens, documents, symbols, planes, bits a block, then symbols by name, zeros of each plane,
ones before each block, compressed size of each block, document ids with a leading NULL flag each, document
lengths); then the blocks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm import textbytes
from ledgerloom.llm.common import parts, ship_code, written
from ledgerloom.llm.tokens import encoder

MAGIC = b"WMX1"
BLOCK_BITS = 1 << 16
SHARD_TOKENS = 1 << 21

SHARDS = "part int, shard int, first long, n_tokens long, n_docs long, image binary"
DOCUMENTS = "part int, shard int, doc_id long, within long, n_tokens long, ids_crc32 long"


def build(ids: np.ndarray, doc_ids: list[int | None], lengths: list[int]) -> bytes:
    """The file image of one shard."""
    n = len(ids)
    counts = np.bincount(ids) if n else np.zeros(0, np.int64)
    present = np.flatnonzero(counts)
    symbols = present[np.lexsort((present, -counts[present]))]
    planes = max(1, int(len(symbols) - 1).bit_length()) if n else 0
    name = np.zeros(len(counts), np.uint32)
    name[symbols] = np.arange(len(symbols), dtype=np.uint32)
    level = name[ids] if n else np.zeros(0, np.uint32)
    if len(symbols) <= 1 << 16:
        level = level.astype(np.uint16)
    squeeze = zstandard.ZstdCompressor(level=1)
    zeros, ones, sizes, blocks = [], [], [], []
    for plane in range(planes - 1, -1, -1):
        bit = (level >> plane & 1).astype(bool)
        packed = np.packbits(bit)
        seen = 0
        for at in range(0, n, BLOCK_BITS):
            ones.append(seen)
            seen += int(np.count_nonzero(bit[at : at + BLOCK_BITS]))
            blocks.append(squeeze.compress(packed[at // 8 : (at + BLOCK_BITS) // 8].tobytes()))
            sizes.append(len(blocks[-1]))
        zeros.append(n - seen)
        level = np.concatenate([level[~bit], level[bit]])
    names = [x for d in doc_ids for x in (d is None, d or 0)]
    head = [n, len(doc_ids), len(symbols), planes, BLOCK_BITS]
    directory = np.concatenate([np.asarray(x, np.int64) for x in (head, symbols, zeros, ones, sizes, names, lengths)])
    packed_directory = zlib.compress(directory.astype("<i8").tobytes(), 6)
    return MAGIC + len(packed_directory).to_bytes(8, "little") + packed_directory + b"".join(blocks)


class Shard:
    """One opened image: access, rank, count, select, and the ids of a document or of all."""

    def __init__(self, image: bytes):
        if bytes(image[:4]) != MAGIC:
            raise ValueError("not a token shard")
        self.image = memoryview(image)
        at = 12 + int.from_bytes(image[4:12], "little")
        values = np.frombuffer(zlib.decompress(self.image[12:at]), "<i8")
        self.n, docs, symbols, self.planes, self.bits = map(int, values[:5])
        per = -(-self.n // self.bits)
        cuts = np.cumsum([5, symbols, self.planes, self.planes * per, self.planes * per, 2 * docs, docs])
        self.symbols, self.zeros, ones, sizes, names, lengths = (values[a:b] for a, b in zip(cuts, cuts[1:]))
        self.ones = ones.reshape(self.planes, per)
        self.places = (at + np.concatenate([[0], np.cumsum(sizes)])).reshape(-1)
        self.per = per
        self.doc_ids = [None if missing else int(d) for missing, d in names.reshape(-1, 2)]
        self.starts = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        self.name = {int(s): i for i, s in enumerate(self.symbols)}
        self._expand = zstandard.ZstdDecompressor()
        self._open: dict[int, np.ndarray] = {}

    def _block(self, plane: int, block: int) -> np.ndarray:
        at = plane * self.per + block
        if at not in self._open:
            if len(self._open) > 256:
                self._open.clear()
            raw = self._expand.decompress(self.image[self.places[at] : self.places[at + 1]])
            self._open[at] = np.unpackbits(np.frombuffer(raw, np.uint8))
        return self._open[at]

    def _bit(self, plane: int, i: int) -> int:
        return int(self._block(plane, i // self.bits)[i % self.bits])

    def _rank1(self, plane: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        if i >= self.n:
            return self.n - int(self.zeros[plane])
        block = i // self.bits
        return int(self.ones[plane, block]) + int(np.count_nonzero(self._block(plane, block)[: i % self.bits]))

    def access(self, i: int) -> int:
        """The id at place i."""
        value = 0
        for plane in range(self.planes):
            bit, ones = self._bit(plane, i), self._rank1(plane, i)
            value = value << 1 | bit
            i = int(self.zeros[plane]) + ones if bit else i - ones
        return int(self.symbols[value])

    def _span(self, token: int, start: int, stop: int) -> tuple[int, int]:
        name = self.name[token]
        for plane in range(self.planes):
            a, b = self._rank1(plane, start), self._rank1(plane, stop)
            if name >> (self.planes - 1 - plane) & 1:
                start, stop = int(self.zeros[plane]) + a, int(self.zeros[plane]) + b
            else:
                start, stop = start - a, stop - b
        return start, stop

    def count(self, token: int, start: int = 0, stop: int | None = None) -> int:
        """How often an id stands in places start .. stop - 1."""
        if token not in self.name:
            return 0
        a, b = self._span(token, start, self.n if stop is None else stop)
        return b - a

    def select(self, token: int, k: int) -> int:
        """The place of the k-th occurrence (from 0) of an id."""
        if not 0 <= k < self.count(token):
            raise IndexError(k)
        name, at = self.name[token], self._span(token, 0, self.n)[0] + k
        for plane in range(self.planes - 1, -1, -1):
            bit = name >> (self.planes - 1 - plane) & 1
            at = self._select(plane, bit, at - int(self.zeros[plane]) if bit else at)
        return at

    def _select(self, plane: int, bit: int, k: int) -> int:
        before = self.ones[plane] if bit else np.arange(self.per) * self.bits - self.ones[plane]
        block = int(np.searchsorted(before, k, "right")) - 1
        hits = np.flatnonzero(self._block(plane, block)[: self.n - block * self.bits] == bit)
        return block * self.bits + int(hits[k - int(before[block])])

    def ids(self) -> np.ndarray:
        """All ids in order: the splits undone plane by plane."""
        kind = np.uint16 if len(self.symbols) <= 1 << 16 else np.uint32
        level = np.zeros(self.n, kind)
        for plane in range(self.planes - 1, -1, -1):
            raw = b"".join(
                self._expand.decompress(self.image[self.places[b] : self.places[b + 1]])
                for b in range(plane * self.per, (plane + 1) * self.per)
            )
            bit = np.unpackbits(np.frombuffer(raw, np.uint8), count=self.n).astype(bool)
            below, zeros = level, int(self.zeros[plane])
            level = np.empty(self.n, kind)
            level[~bit] = below[:zeros]
            level[bit] = below[zeros:] | kind(1 << (self.planes - 1 - plane))
        return self.symbols.astype(np.uint32)[level]

    def document(self, k: int) -> np.ndarray:
        """Ids of the k-th document, by access alone."""
        return np.array([self.access(i) for i in range(self.starts[k], self.starts[k + 1])], np.uint32)


def _write(tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard, first = TaskContext.get().partitionId(), 0, 0
        ids: list[np.ndarray] = []
        names: list[int | None] = []
        lengths: list[int] = []
        held = 0

        def emit() -> pa.RecordBatch:
            image = build(np.concatenate(ids), names, lengths)
            values = (part, shard, first, held, len(names), image)
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(values, kinds)], names=[x.split()[0] for x in SHARDS.split(", ")]
            )

        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            for row, data, offsets in textbytes.slices(batch.column("text")):
                coded, cuts = encoder(tokenizer).encode(data, offsets)
                closed = np.insert(coded, cuts[1:], np.uint32(end_id))
                cuts = cuts + np.arange(len(cuts))
                for i in range(len(offsets) - 1):
                    length = int(cuts[i + 1] - cuts[i])
                    if held and held + length > SHARD_TOKENS:
                        yield emit()
                        shard, first = shard + 1, first + held
                        ids, names, lengths, held = [], [], [], 0
                    ids.append(closed[cuts[i] : cuts[i + 1]])
                    names.append(doc_ids[row + i])
                    lengths.append(length)
                    held += length
        if names:
            yield emit()

    return run


def write_shards(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", end_id: int = 0) -> DataFrame:
    """Encode every text, close it with ``end_id`` and write the ids as shards in ascending doc_id order.

    Returns the written shard table. NULL text is empty. NULL ids come first; rows with equal ids lie next to
    each other, by text. An empty table gives a table without shards; other columns are ignored.
    """
    spark = docs.sparkSession
    ship_code(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # the second key parts rows of one id; equal rows may lie anywhere among themselves
    spread = texts.withColumn("tie", F.xxhash64("text"))
    ordered = spread.repartitionByRange(parts(spark), "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    return written(ordered.select("doc_id", "text").mapInArrow(_write(tokenizer, end_id), SHARDS))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            shard = Shard(batch.column("image")[i].as_buffer().to_pybytes())
            ids = shard.ids().astype("<u4")
            first = batch.column("first")[i].as_py()
            crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(shard.starts, shard.starts[1:])]
            n = len(shard.doc_ids)
            columns = [
                pa.array([batch.column("part")[i].as_py()] * n, pa.int32()),
                pa.array([batch.column("shard")[i].as_py()] * n, pa.int32()),
                pa.array(shard.doc_ids, pa.int64()),
                pa.array(shard.starts[:-1] + first),
                pa.array(np.diff(shard.starts)),
                pa.array(crc, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in DOCUMENTS.split(", ")])


def read_documents(shards: DataFrame) -> DataFrame:
    """Per document, from the shards alone: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    spark = shards.sparkSession
    ship_code(spark)
    # one row for each range partition: few, whatever the number of documents
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    docs = shards.select("part", "shard", "first", "image").mapInArrow(_read, DOCUMENTS)
    return docs.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"
    )


def count_token(shards: DataFrame, token: int) -> DataFrame:
    """(part, shard, n): how often an id stands in each shard, by rank alone."""
    ship_code(shards.sparkSession)

    def run(batches):
        for batch in batches:
            n = [Shard(x.as_buffer().to_pybytes()).count(token) for x in batch.column("image")]
            yield pa.RecordBatch.from_arrays([batch.column("part"), batch.column("shard"), pa.array(n, pa.int64())], names=["part", "shard", "n"])

    return shards.select("part", "shard", "image").mapInArrow(run, "part int, shard int, n long")


def find_token(shards: DataFrame, token: int) -> DataFrame:
    """(doc_id, place): every occurrence of an id, its place counted within the document, by select."""
    ship_code(shards.sparkSession)

    def run(batches):
        for batch in batches:
            for image in batch.column("image"):
                shard = Shard(image.as_buffer().to_pybytes())
                at = np.array([shard.select(token, k) for k in range(shard.count(token))], np.int64)
                doc = np.searchsorted(shard.starts, at, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard.doc_ids[d] for d in doc], pa.int64()), pa.array(at - shard.starts[doc])], names=["doc_id", "place"]
                )

    return shards.select("image").mapInArrow(run, "doc_id long, place long")
