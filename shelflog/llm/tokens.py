"""Token ids in binary shards with Elias-Fano document boundaries."""

from __future__ import annotations

import struct
import sys
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflog.llm.common import id_and_text, per_worker, slices
from shelflog.session import materialize, scratch_path

SHARD_IDS = 16 << 20
SHARDS_OF_TASK = 1_000_000
END_ID = 2
MEMO_PIECES = 1_500_000  # some 300 MB a worker
SELECT_EVERY = 256

# The printable character that byte-level tokenizers use for each byte.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_ALPHABET = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
_SPACE = chr(_BYTE_ALPHABET[32])

# magic, bytes an id, documents, documents without an id, ids, first doc_id, size of the
# boundary part, size of the doc_id part
HEADER = "<8sIIIQqQQ"
MAGIC = b"TOKEF001"


class EliasFano:
    """A non-decreasing sequence below ``universe``: low bits packed, high bits in unary.

    ``select`` reads one value: a sample points near the wanted one bit, byte counts find it.
    """

    HEAD = "<QQI"

    def __init__(self, n: int, universe: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.universe, self.low_bits, self.low, self.high = n, universe, low_bits, low, high
        ones = np.bitwise_count(high)
        self.ranks = np.cumsum(ones, dtype=np.uint32) - ones  # ones before each byte
        self.samples = np.searchsorted(self.ranks, np.arange(0, n, SELECT_EVERY), side="right").astype(np.uint32) - 1

    @classmethod
    def encode(cls, values: np.ndarray, universe: int) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        low_bits = max(0, (max(universe, 1) // max(n, 1)).bit_length() - 1)
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        high = np.zeros(n + (universe >> low_bits) + 1, np.uint8)
        high[(values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)] = 1
        return cls(n, universe, low_bits, low, np.packbits(high, bitorder="little"))

    def to_bytes(self) -> bytes:
        return struct.pack(self.HEAD, self.n, self.universe, self.low_bits) + self.low.tobytes() + self.high.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        n, universe, low_bits = struct.unpack_from(cls.HEAD, data)
        raw = np.frombuffer(data, np.uint8, offset=struct.calcsize(cls.HEAD))
        split = (n * low_bits + 7) // 8
        return cls(n, universe, low_bits, raw[:split], raw[split:])

    def select(self, i: int) -> int:
        byte = int(self.samples[i // SELECT_EVERY])
        while byte + 1 < len(self.ranks) and self.ranks[byte + 1] <= i:
            byte += 1
        left = i - int(self.ranks[byte])
        bit = np.flatnonzero(np.unpackbits(self.high[byte : byte + 1], bitorder="little"))[left]
        upper = byte * 8 + int(bit) - i
        lower = 0
        for b in range(self.low_bits):
            at = i * self.low_bits + b
            lower |= (int(self.low[at >> 3]) >> (at & 7) & 1) << b
        return upper << self.low_bits | lower

    def values(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        upper = (ones - np.arange(self.n)).astype(np.uint64)
        bits = np.unpackbits(self.low, bitorder="little")[: self.n * self.low_bits].reshape(self.n, self.low_bits)
        lower = np.zeros(self.n, np.uint64)
        for b in range(self.low_bits):
            lower |= bits[:, b].astype(np.uint64) << np.uint64(b)
        return (upper << np.uint64(self.low_bits)) | lower


class Encoder:
    """Ids of whole texts by a byte-level tokenizer file, as little-endian bytes.

    A single space between two characters that are no spaces always begins a piece of its
    own, so texts are cut there and the ids of each distinct piece are looked up. New pieces
    go through the tokenizer's own pre-tokenizer and model. A text that spells one of the
    tokenizer's added tokens is encoded whole, by the library's default.
    """

    def __init__(self, path: str, memo_pieces: int = MEMO_PIECES):
        import json
        import re

        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        with open(path) as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        plain = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
        self.by_piece = bool(plain and not spec.get("normalizer") and not spec["model"].get("dropout"))
        self.added = [t["content"] for t in spec.get("added_tokens") or []]
        self.tokenizer, self.model, self.pre = tokenizer, tokenizer.model, tokenizer.pre_tokenizer
        self.width = 2 if tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.dtype = np.dtype(f"<u{self.width}")
        self.code = "H" if self.width == 2 else "I"
        self.cut = re.compile(r"(?<=\S)(?= \S)").split
        self.memo_pieces = memo_pieces
        self.pieces: dict[str, bytes] = {}
        self.units: dict[str, bytes] = {}

    def _ids(self, unit: str) -> bytes:
        """Ids of one unit of the pre-tokenizer, in its byte alphabet."""
        ids = array(self.code, [t.id for t in self.model.tokenize(unit)])
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def _unit(self, unit: str) -> bytes:
        ids = self.units.get(unit)
        if ids is None:
            ids = self._ids(unit)
            if len(self.units) < self.memo_pieces // 4:
                self.units[unit] = ids
        return ids

    def _spaced(self, new: list[str]) -> dict[str, bytes]:
        """Ids of pieces that begin with a space: mostly a word, or a word and a sign."""
        found, rest = {}, []
        for piece in new:
            word, sign = (piece[1:-1], piece[-1]) if piece[-1] in ".,;:!?" else (piece[1:], "")
            # Latin letters only: here a word is one unit for any version of Unicode.
            if word.isalpha() and max(word) < "\u0250":
                spelt = word if word.isascii() else word.encode().decode("latin-1").translate(_BYTE_ALPHABET)
                found[piece] = self._ids(_SPACE + spelt) + self._unit(sign) if sign else self._ids(_SPACE + spelt)
            else:
                rest.append(piece)
        return found | self._pieces(rest) if rest else found

    def _pieces(self, new: list[str]) -> dict[str, bytes]:
        """Ids of any pieces; all but the first begin with a space."""
        ends = np.cumsum([len(p) for p in new]).tolist()
        found, parts = {}, []
        for unit, (_, stop) in self.pre.pre_tokenize_str("".join(new)):
            parts.append(self._unit(unit))
            if stop == ends[len(found)]:
                found[new[len(found)]] = b"".join(parts)
                parts = []
        return found

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.by_piece or any(a in text for a in self.added):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()
        known = self.pieces
        first, *rest = self.cut(text)
        head = self._pieces([first])[first]
        missing = [p for p in dict.fromkeys(rest) if p not in known]
        if missing:
            found = self._spaced(missing)
            if len(known) < self.memo_pieces:
                known.update(found)
            else:  # a full memo stays as it is: frequent pieces came early
                return head + b"".join([known.get(p) or found[p] for p in rest])
        return head + b"".join(map(known.__getitem__, rest))


def _file_system(uri: str):
    """File system and path of ``uri``; a plain path is local or mounted."""
    from pyarrow import fs

    if uri.startswith("file:"):
        uri = "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


class _Shard:
    def __init__(self, dtype: np.dtype):
        self.dtype = dtype
        self.ids: list[bytes] = []
        self.docs: list[int | None] = []
        self.lengths: list[int] = []
        self.n_ids = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.ids.append(ids)
        self.docs.append(doc_id)
        self.lengths.append(len(ids) // self.dtype.itemsize)
        self.n_ids += self.lengths[-1]

    def write(self, uri: str) -> None:
        bounds = EliasFano.encode(np.cumsum([0, *self.lengths]), self.n_ids + 1).to_bytes()
        known = np.array([d for d in self.docs if d is not None], np.int64)
        first = int(known[0]) if len(known) else 0
        above = (known - first).astype(np.uint64)
        names = EliasFano.encode(above, int(above[-1]) + 1 if len(above) else 1).to_bytes()
        head = struct.pack(
            HEADER, MAGIC, self.dtype.itemsize, len(self.docs), len(self.docs) - len(known), self.n_ids, first, len(bounds), len(names)
        )
        fs, path = _file_system(uri)
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        own = f"{path}.{TaskContext.get().taskAttemptId()}" if TaskContext.get() else f"{path}.part"
        with fs.open_output_stream(own) as out:
            for piece in (head, bounds, names, *self.ids):
                out.write(piece)
        fs.move(own, path)


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    shard_ids: int = SHARD_IDS,
    partitions: int | None = None,
) -> DataFrame:
    """Write token ids under ``path`` in ascending doc_id order; returns the manifest table.

    The rows are range-partitioned and sorted on the id before anything is encoded, so the
    texts move once and are encoded once. Each partition writes shards of about
    ``shard_ids`` ids (a longer document has a shard of its own length): a header, the
    Elias-Fano coded boundaries, the Elias-Fano coded doc_ids, then the ids, two bytes each
    while the vocabulary allows. A file is written under the name of its attempt and moved
    when whole, and its content depends on the partition alone, so a task that runs again
    replaces its own files. ``tokenizer_path`` and ``path`` must be in reach of all executors.

    Manifest columns: shard (its place in the order), path, n_docs, n_ids.

    Cases: a null text counts as empty, an empty text has only ``end_id``. An added token of
    the tokenizer that a text spells, such as its end mark, has its own id, as in the library. A null doc_id comes
    before all others. Rows with equal doc_ids are ordered by a hash of their text, so a
    frequent id is split too. An empty table writes no shard. Other columns are not read.
    """
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["doc_id", "tie"]
    rows = (
        id_and_text(docs, id_col, text_col)
        .select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("tie"))
        .repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
    )
    schema = T.StructType(
        [
            T.StructField("shard", T.LongType()),
            T.StructField("path", T.StringType()),
            T.StructField("n_docs", T.LongType()),
            T.StructField("n_ids", T.LongType()),
        ]
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_worker(("encoder", tokenizer_path), lambda: Encoder(tokenizer_path))
        end = np.array([end_id], encoder.dtype).tobytes()
        part = TaskContext.get().partitionId()
        made = 0

        def close(shard: _Shard) -> pa.RecordBatch:
            nonlocal made
            at = f"{path}/shard-{part:06d}-{made:06d}.tok"
            shard.write(at)
            made += 1
            row = {"shard": part * SHARDS_OF_TASK + made, "path": at, "n_docs": len(shard.docs), "n_ids": shard.n_ids}
            return pa.RecordBatch.from_pylist([row])

        shard = _Shard(encoder.dtype)
        for batch in batches:
            for piece in slices(batch, 1):
                for doc_id, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                    shard.add(doc_id, encoder.encode(text) + end)
                    if shard.n_ids >= shard_ids:
                        yield close(shard)
                        shard = _Shard(encoder.dtype)
        if shard.docs:
            yield close(shard)

    return materialize(rows.mapInArrow(write, schema), "token-manifest")


class ShardReader:
    """One shard file: boundaries and doc_ids in memory, ids read as asked for."""

    def __init__(self, uri: str):
        fs, path = _file_system(uri)
        self.file = fs.open_input_file(path)
        magic, width, self.n_docs, self.nulls, self.n_ids, self.first, a, b = struct.unpack(HEADER, self.file.read(struct.calcsize(HEADER)))
        if magic != MAGIC:
            raise ValueError(f"{uri} is no token shard")
        self.dtype = np.dtype(f"<u{width}")
        self.bounds = EliasFano.from_bytes(self.file.read(a))
        self.names = EliasFano.from_bytes(self.file.read(b))
        self.base = struct.calcsize(HEADER) + a + b

    def doc_ids(self) -> list[int | None]:
        known = self.names.values().astype(np.int64) + self.first
        return [None] * self.nulls + known.tolist()

    def ids(self, start: int, end: int) -> np.ndarray:
        self.file.seek(self.base + start * self.dtype.itemsize)
        return np.frombuffer(self.file.read((end - start) * self.dtype.itemsize), self.dtype)

    def document(self, i: int) -> np.ndarray:
        """The ids of the i-th document, through select on the boundaries."""
        return self.ids(self.bounds.select(i), self.bounds.select(i + 1))


def read_tokens(manifest: DataFrame, block_ids: int = 4 << 20) -> DataFrame:
    """Documents back from the shard files: doc_id, start, n_tokens, ids_crc32, shard.

    ``start`` counts the ids of all documents before it: the manifest's running sum, first over
    the writing tasks, then over the shards of one, plus the decoded boundary. Ids are read in blocks of about ``block_ids``.
    """
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    task = F.expr(f"shard div {SHARDS_OF_TASK}").alias("shard")
    tasks = manifest.groupBy(task).agg(F.sum("n_ids").alias("n_ids"))
    tasks = tasks.select(F.col("shard").alias("task"), F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).alias("of_tasks"))
    of_shards = F.coalesce(F.sum("n_ids").over(Window.partitionBy("task").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shards = manifest.withColumn("task", F.expr(f"shard div {SHARDS_OF_TASK}")).withColumn("of_shards", of_shards)
    shards = shards.join(tasks, "task").withColumn("base", F.col("of_tasks") + F.col("of_shards")).drop("task", "of_tasks", "of_shards")
    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long, shard long"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                reader = ShardReader(row["path"])
                names, bounds = reader.doc_ids(), reader.bounds.values().astype(np.int64)
                at = 0
                while at < reader.n_docs:
                    to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + block_ids, side="right")) - 1)
                    to = min(to, reader.n_docs)
                    ids = memoryview(reader.ids(int(bounds[at]), int(bounds[to])).astype("<u4")).cast("B")
                    cuts = ((bounds[at : to + 1] - bounds[at]) * 4).tolist()
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": pa.array(names[at:to], pa.int64()),
                            "start": bounds[at:to] + row["base"],
                            "n_tokens": np.diff(bounds[at : to + 1]),
                            "ids_crc32": pa.array([zlib.crc32(ids[a:b]) for a, b in zip(cuts, cuts[1:])], pa.int64()),
                            "shard": np.full(to - at, row["shard"]),
                        }
                    )
                    at = to

    return shards.repartition(n, "shard").mapInArrow(read, schema)


def token_path(spark) -> str:
    return scratch_path(spark, "tokens")
