"""Token-id files: frequency-ranked ids in byte-aligned variable-length coding.

Ids are replaced by their rank in the corpus frequency order (most frequent
first, ties to the smaller id), so most ranks need one byte.  A block holds

    header   little-endian uint32 x 8: magic, documents, ids (low, high),
             control bytes, data bytes (low, high), reserved
             uint64: ids of all blocks before this one
    index    per document int64 doc_id, uint64 id count, uint8 null flag
    control  two bits per id, four ids a byte: bytes of the rank minus one
    data     the ranks' little-endian bytes, nothing else

Control and data bytes are separate, so decoding is table look-up: a control byte gives
the four lengths, a prefix sum of the lengths gives every position, and the bytes are
gathered by numpy at once.

Writing: documents are range-partitioned by doc_id (null ids first, repeated
ids by text) and sorted inside partitions.  Each partition is tokenized once
into a table of id arrays with running counts and one row with its count of
every id; frequencies and partition totals are sums over these.  A second narrow pass writes blocks of about
``block_ids`` ids, a document is never split.  Blocks are rows of a Parquet
folder in the shared location (part, first row, image), so Spark's writer commits them.
The driver holds one number per partition and one per vocabulary entry.

Defined cases: null or empty texts hold the end id alone; special token strings
inside texts become their ids; repeated rows are written each; null doc_ids come first;
other columns are ignored; an empty table gives no blocks.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.llm.common import CACHES, claim, columns, tuned
from reelhouse.llm.pieces import PieceTable, char_batches, vocabulary, vocabulary_path
from reelhouse.session import scratch_path

VOCABULARY = "byte_bpe_50k.json"
END = 2
BLOCK_IDS = 1 << 20
MAGIC = 0x4B525631
SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"

#: Per control byte: lengths of its four ranks.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1
_MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control, data) of ranks."""
    ranks = ranks.astype("<u4")
    size = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    code = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    code[:len(ranks)] = size - 1
    code = code.reshape(-1, 4)
    control = code[:, 0] | code[:, 1] << 2 | code[:, 2] << 4 | code[:, 3] << 6
    used = np.arange(4, dtype=np.uint8) < size[:, None]
    return control.astype(np.uint8).tobytes(), ranks.view(np.uint8).reshape(-1, 4)[used].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """Ranks of (control, data)."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    end = np.cumsum(size, dtype=np.int64)
    raw = np.frombuffer(data + b"\x00\x00\x00", np.uint8)
    at = end - size
    words = raw[at].astype(np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(size > k)
        words[more] |= raw[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return words


def write_block(before: int, ids: list, counts: np.ndarray, ranks: np.ndarray) -> bytes:
    control, data = pack(ranks)
    head = np.array([MAGIC, len(ids), len(ranks) & 0xFFFFFFFF, len(ranks) >> 32, len(control),
                     len(data) & 0xFFFFFFFF, len(data) >> 32, 0], "<u4").tobytes()
    return b"".join([head, np.array([before], "<u8").tobytes(), np.array([i or 0 for i in ids], "<i8").tobytes(),
                     counts.astype("<u8").tobytes(), np.array([i is None for i in ids], np.uint8).tobytes(), control, data])


def read_block(image: bytes):
    """(ids before, doc ids, counts, ranks)."""
    head = np.frombuffer(image, "<u4", 8).tolist()
    if head[0] != MAGIC:
        raise ValueError("not a token block")
    docs, n, n_control, n_data = head[1], head[2] | head[3] << 32, head[4], head[5] | head[6] << 32
    before = int(np.frombuffer(image, "<u8", 1, 32)[0])
    ids = np.frombuffer(image, "<i8", docs, 40).tolist()
    counts = np.frombuffer(image, "<u8", docs, 40 + 8 * docs).astype(np.int64)
    null = np.frombuffer(image, np.uint8, docs, 40 + 16 * docs)
    at = 40 + 17 * docs
    ranks = unpack(image[at:at + n_control], image[at + n_control:at + n_control + n_data], n)
    return before, [None if x else i for i, x in zip(ids, null)], counts, ranks


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary:
    printable Latin-1 stands for itself, the others for letters from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    return {b: chr(b) if b in own else chr(256 + b - sum(x < b for x in own)) for b in range(256)}


class _Ids:
    """Known pieces with their ids, flat: row k has ``ids[begin[k]:begin[k] + size[k]]``."""

    def __init__(self, path: str):
        tokenizer, pre, specials = vocabulary(path)
        self.model, self.letters = tokenizer.model, byte_letters()
        self.pieces = PieceTable(pre, specials, self._encode, lambda i: [i], spaced=True, limit=600_000)
        self._clear()

    def _clear(self):
        self.known, self.ids = 0, np.zeros(1 << 20, np.uint32)
        self.begin, self.size = np.zeros(1 << 18, np.int64), np.zeros(1 << 18, np.int64)
        self.used = 0

    def _encode(self, new: list[str]) -> list[list[int]]:
        """Ids of pieces: what the library's model makes of each."""
        tokenize, letters = self.model.tokenize, self.letters
        return [[t.id for t in tokenize(piece.encode().decode("latin-1").translate(letters))] for piece in new]

    def _learn(self):
        """Take over the table's new rows."""
        values = self.pieces.values
        if len(values) < self.known:  # the table was emptied
            self._clear()
        new = values[self.known:]
        size = np.fromiter(map(len, new), np.int64, len(new))
        total = int(size.sum())
        while self.known + len(new) > len(self.begin):
            self.begin, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.begin, self.size))
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        at = slice(self.known, self.known + len(new))
        self.size[at], self.begin[at] = size, self.used + np.cumsum(size) - size
        self.ids[self.used:self.used + total] = np.fromiter((i for v in new for i in v), np.uint32, total)
        self.used += total
        for k in range(self.known, len(values)):
            values[k] = None  # the flat copy is the one that is read
        self.known = len(values)

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, count per text)."""
        found = self.pieces.look_up([self.pieces.specials.hide(t) for t in texts])
        self._learn()
        rows = found.rows[found.code]
        size = self.size[rows]
        ends = np.cumsum(size)
        take = np.repeat(self.begin[rows] - (ends - size), size)
        take += np.arange(len(take))
        sums = np.concatenate([[0], ends])[found.first]
        return self.ids[take], np.diff(sums)


_tables: dict[str, _Ids] = CACHES.setdefault("tokenfiles", {})


def _known_ids(path: str) -> _Ids:
    claim("tokenfiles")
    if path not in _tables:
        _tables[path] = _Ids(path)
    return _tables[path]


def _with_end(ids: np.ndarray, n: np.ndarray, end: int) -> np.ndarray:
    """Ids with ``end`` after each text's."""
    out = np.full(len(ids) + len(n), end, np.uint32)
    at = np.ones(len(out), bool)
    at[np.cumsum(n + 1) - 1] = False
    out[at] = ids
    return out


def _tokenized(docs: DataFrame, path: str, end: int, parts: int) -> DataFrame:
    """Rows in doc_id order: part, row, doc_id, n, before (ids earlier in the
    part), ids (uint32 bytes, the end id included); and one row per part with
    ``counts`` of every id (int64 bytes) instead."""

    def run(batches):
        from pyspark import TaskContext
        part, row, before = TaskContext.get().partitionId(), 0, 0
        known, total = _known_ids(vocabulary_path(path)), np.zeros(1, np.int64)
        names = ["part", "row", "doc_id", "n", "before", "ids", "counts"]
        for batch in batches:
            ids, text = columns(batch, "doc_id", "text")
            texts = text.fill_null("").to_pylist()
            for a, b in char_batches(texts):
                flat, n = known.of(texts[a:b])
                flat, n = _with_end(flat, n, end), n + 1
                got = np.bincount(flat, minlength=len(total))
                got[:len(total)] += total
                total = got
                # a batch holds at most a char_batches slice, so 32-bit offsets do
                offsets = np.concatenate([[0], np.cumsum(n) * 4]).astype(np.int32)
                raw = pa.BinaryArray.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), part), pa.int32()), pa.array(row + np.arange(len(n))), ids.slice(a, b - a).cast(pa.int64()),
                     pa.array(n), pa.array(before + np.cumsum(n) - n), raw, pa.nulls(len(n), pa.binary())], names)
                row, before = row + len(n), before + int(n.sum())
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([-1], pa.int64()), pa.nulls(1, pa.int64()), pa.array([before], pa.int64()),
             pa.array([0], pa.int64()), pa.nulls(1, pa.binary()), pa.array([total.tobytes()], pa.binary())], names)

    return docs.select("doc_id", "text").repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(
        run, "part int, row long, doc_id long, n long, before long, ids binary, counts binary")


def _frequencies(tokens: DataFrame) -> np.ndarray:
    """Corpus count of every id, from the parts' counts (summed in tasks; one
    array of vocabulary size comes to the driver)."""

    def run(batches):
        total = np.zeros(1, np.int64)
        for batch in batches:
            for x in batch.column(0).to_pylist():
                got = np.frombuffer(x, np.int64).copy()
                small, total = sorted((got, total), key=len)
                total[:len(small)] += small
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["id", "n"])

    rows = tokens.where("counts is not null").select("counts").mapInArrow(run, "id long, n long").groupBy("id").agg(
        F.sum("n").alias("n")).toArrow()
    ids, n = rows["id"].to_numpy(), rows["n"].to_numpy()
    out = np.zeros(int(ids.max()) + 1 if len(ids) else 1, np.int64)
    out[ids] = n
    return out


def write_tokens(docs: DataFrame, folder: str, path: str = VOCABULARY, end: int = END, block_ids: int = BLOCK_IDS) -> None:
    """Write the token files of ``docs`` under ``folder``: ``blocks`` (rows
    part, row, image) and ``ranks`` (rank, id)."""
    spark = tuned(docs.sparkSession)
    stage = scratch_path(spark, "tokens")
    _tokenized(docs, path, end, int(spark.conf.get("spark.sql.shuffle.partitions"))).write.option("compression", "zstd").parquet(stage)
    tokens = spark.read.parquet(stage)
    count = _frequencies(tokens)
    order = np.lexsort((np.arange(len(count)), -count))[:int((count > 0).sum())]
    rank = np.zeros(len(count), np.uint32)
    rank[order] = np.arange(len(order))
    ranks = spark.createDataFrame([(k, int(i)) for k, i in enumerate(order)], "rank int, id int")
    ranks.coalesce(1).write.parquet(f"{folder}/ranks")
    totals = {r["part"]: r["n"] for r in tokens.where("row = -1").select("part", "n").collect()}
    offset, at = {}, 0
    for part in sorted(totals):
        offset[part] = at
        at += totals[part]
    shared = spark.sparkContext.broadcast((rank, offset))

    def run(batches):
        rank, offset = shared.value
        open_, held = [], 0

        def close():
            part, row, _, _, before, _ = open_[0]
            counts = np.array([r[3] for r in open_])
            ids = np.frombuffer(b"".join(r[5] for r in open_), "<u4")
            image = write_block(offset[part] + before, [r[2] for r in open_], counts, rank[ids])
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([row]), pa.array([image], pa.binary())], ["part", "row", "image"])

        for batch in batches:
            for r in zip(*(c.to_pylist() for c in columns(batch, "part", "row", "doc_id", "n", "before", "ids"))):
                if open_ and (held + r[3] > block_ids or (r[0], r[1]) != (open_[-1][0], open_[-1][1] + 1)):
                    yield close()
                    open_, held = [], 0
                open_.append(r)
                held += r[3]
        if open_:
            yield close()

    tokens.where("row >= 0").select("part", "row", "doc_id", "n", "before", "ids").mapInArrow(run, "part int, row long, image binary") \
        .write.option("compression", "none").parquet(f"{folder}/blocks")


def _read(spark: SparkSession, folder: str, make, schema: str) -> DataFrame:
    """``make(before, doc ids, counts, ids)`` of each block gives a batch."""
    ranks = spark.read.parquet(f"{folder}/ranks").toArrow().sort_by("rank")["id"].to_numpy().astype("<u4")
    shared = spark.sparkContext.broadcast(ranks)

    def run(batches):
        id_of = shared.value
        for batch in batches:
            for image in columns(batch, "image")[0]:
                before, docs, counts, ranks = read_block(image.as_py())
                yield make(before, docs, counts, id_of[ranks])

    return spark.read.parquet(f"{folder}/blocks").select("image").mapInArrow(run, schema)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), ids array<int>."""

    def make(before, docs, counts, ids):
        end = np.cumsum(counts)
        parts = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], end]), pa.int32()), pa.array(ids.astype(np.int32)))
        return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(before + end - counts), parts], ["doc_id", "start", "ids"])

    return _read(spark, folder, make, "doc_id long, start long, ids array<int>")


def token_digests(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files."""

    def make(before, docs, counts, ids):
        end = np.cumsum(counts)
        raw = memoryview(np.ascontiguousarray(ids, "<u4").tobytes())
        crc = [zlib.crc32(raw[4 * (e - n):4 * e]) for e, n in zip(end.tolist(), counts.tolist())]
        return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(before + end - counts), pa.array(counts), pa.array(crc, pa.int64())],
                                          ["doc_id", "start", "n_tokens", "ids_crc32"])

    return _read(spark, folder, make, SCHEMA)


def written_and_read(docs: DataFrame, path: str = VOCABULARY, end: int = END) -> DataFrame:
    """Write ``docs`` to a fresh shared folder and report on what is read back."""
    spark = tuned(docs.sparkSession)
    folder = scratch_path(spark, "token-files")
    write_tokens(docs, folder, path, end)
    return token_digests(spark, folder)
