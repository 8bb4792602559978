"""Token-id files: tokenised documents in patched frame-of-reference blocks.

``write`` tokenises every document, in ascending doc_id order (ties by a hash of
the text), and writes a dataset through Spark's own writer, so lost executors
and retried tasks leave no half files.  Documents are dealt to shards by ranges
of doc_id; a shard's rows are *chunks* of whole documents:

    shard, first (position of the chunk's first id in its shard), n_ids,
    doc_ids, n_tokens (ids of each document), payload

The payload is self-contained and can be read from any id:

    "PFB1" | u32 ids | u32 blocks | u32 byte start of each block | blocks
    block: u32 minimum | u8 width | u16 ids | u16 outliers
           | ids less the minimum, ``width`` bits each
           | u16 place of each outlier | u32 its value less the minimum

All integers are little-endian.  A block holds up to 1024 ids; its width is the
one that a set share (``percentile``) of its values fits, the others are
outliers: their low bits stay packed, their whole values follow.

Texts are cut at ASCII white space, and between ASCII letters or digits and ASCII
punctuation other than apostrophes.  This kind of tokenizer never joins over
these places and lower-cases, so each distinct lower-cased piece is encoded once
by the tokenizers library while a bounded table holds it, and a text's ids are
its pieces' ids in order.  A tokenizer that joins there, and texts that hold its
special tokens or a piece that shares its hash with another, are encoded whole.

Odd input: a null or empty text has only the end id; repeated rows are written
each; a null doc_id sorts first; an empty table gives an empty dataset.
"""

from __future__ import annotations

import os
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.textblocks import SPACE, U64, Block, blocks, small_batches
from tidemark.session import scratch_path
from tidemark.sources.tables import read_table

MAGIC = b"PFB1"
BLOCK = 1024
CHUNK_IDS = 1 << 16
HEAD = struct.Struct("<IBHH")
CACHE_PIECES = 2_000_000

# 0 white space, 1 ASCII letters and digits, 2 ASCII punctuation and controls, 3
# apostrophes and all non-ASCII characters; pieces part between 1 and 2.
KIND = np.full(256, 2, np.uint8)
KIND[np.flatnonzero(SPACE)] = 0
KIND[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
KIND[[0x27, *range(0x80, 0x100)]] = 3

_STATE: dict = {}


def pack(ids: np.ndarray, percentile: float = 95.0) -> bytes:
    """A payload of unsigned 32-bit ids."""
    ids = np.ascontiguousarray(ids, np.uint32)
    n = len(ids)
    count = -(-n // BLOCK)
    sizes = np.full(count, BLOCK)
    if count:
        sizes[-1] = n - BLOCK * (count - 1)
    body, starts, at = [], [], len(MAGIC) + 8 + 4 * count
    if count:
        grid = np.full(count * BLOCK, ids[-1], np.uint32)
        grid[:n] = ids
        grid = grid.reshape(count, BLOCK)
        if sizes[-1] < BLOCK:
            grid[-1, sizes[-1] :] = ids[n - sizes[-1] :].min()
        least = grid.min(axis=1)
        grid -= least[:, None]
        rank = min(int(np.ceil(BLOCK * percentile / 100)), BLOCK) - 1
        fits = np.partition(grid, rank, axis=1)[:, rank]
        widths = np.ceil(np.log2(fits.astype(np.float64) + 1)).astype(np.int64)
        packed: list = [b""] * count
        for w in np.unique(widths):
            rows = np.flatnonzero(widths == w)
            if w:
                low = grid[rows].astype("<u4").view(np.uint8).reshape(len(rows), BLOCK, 4)
                bits = np.unpackbits(low, axis=2, count=None, bitorder="little")[:, :, :w]
                flat = np.packbits(bits.reshape(len(rows), BLOCK * w), axis=1, bitorder="little")
                for i, r in enumerate(rows):
                    packed[r] = flat[i, : (int(sizes[r]) * w + 7) // 8].tobytes()
        over = grid >> np.minimum(widths, 31)[:, None].astype(np.uint32) > 0
        over[widths >= 32] = False
        where, place = np.nonzero(over)
        edges = np.searchsorted(where, np.arange(count + 1))
        values = grid[where, place].astype("<u4")
        place = place.astype("<u2")
        for r in range(count):
            a, b = edges[r], edges[r + 1]
            row = HEAD.pack(int(least[r]), int(widths[r]), int(sizes[r]), b - a)
            row += packed[r] + place[a:b].tobytes() + values[a:b].tobytes()
            starts.append(at)
            at += len(row)
            body.append(row)
    return MAGIC + struct.pack("<II", n, count) + np.array(starts, "<u4").tobytes() + b"".join(body)


def unpack(payload: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids ``first`` to ``last`` (exclusive) of a payload; only the blocks that
    hold them are decoded."""
    if payload[:4] != MAGIC:
        raise ValueError("not a token-id payload")
    n, count = struct.unpack_from("<II", payload, 4)
    last = n if last is None else min(last, n)
    if first >= last:
        return np.zeros(0, np.uint32)
    starts = np.frombuffer(payload, "<u4", count, 12)
    lo, hi = first // BLOCK, (last - 1) // BLOCK + 1
    out = []
    for start in starts[lo:hi]:
        least, width, size, outliers = HEAD.unpack_from(payload, start)
        at = int(start) + HEAD.size
        length = (size * width + 7) // 8
        bits = np.unpackbits(np.frombuffer(payload, np.uint8, length, at), count=size * width, bitorder="little")
        room = 16 if width <= 16 else 32
        wide = np.zeros((size, room), np.uint8)
        wide[:, :width] = bits.reshape(size, width)
        values = np.packbits(wide, axis=1, bitorder="little").view(f"<u{room // 8}").ravel().astype(np.uint32)
        at += length
        place = np.frombuffer(payload, "<u2", outliers, at)
        values[place] = np.frombuffer(payload, "<u4", outliers, at + 2 * outliers)
        out.append(values + np.uint32(least))
    return np.concatenate(out)[first - lo * BLOCK : last - lo * BLOCK]


class Lists:
    """Arrays of numbers kept one behind the other in one that grows."""

    def __init__(self, kind):
        self.flat, self.ptr = np.zeros(1 << 16, kind), np.zeros(1, np.int64)

    def add(self, arrays: list) -> None:
        sizes = np.cumsum([len(x) for x in arrays])
        used, more = self.ptr[-1], np.concatenate(arrays)
        if used + len(more) > len(self.flat):
            self.flat = np.concatenate([self.flat[:used], np.zeros(2 * (used + len(more)), self.flat.dtype)])
        self.flat[used : used + len(more)] = more
        self.ptr = np.concatenate([self.ptr, used + sizes])

    def sizes(self, which: np.ndarray) -> np.ndarray:
        return self.ptr[which + 1] - self.ptr[which]

    def take(self, which: np.ndarray) -> np.ndarray:
        """The arrays of these numbers, one behind the other."""
        sizes = self.sizes(which)
        upto = np.cumsum(sizes) - sizes
        return self.flat[np.repeat(self.ptr[which] - upto, sizes) + np.arange(sizes.sum())]


class Pieces:
    """Ids of the pieces met so far, looked up by a 64-bit hash.

    Sorted hashes with the number of each piece, whose ids and bytes are kept by
    number: a large table, and a small one of recent pieces that is merged into it
    now and then.  A full table is forgotten, so memory is bounded.  A hit counts
    only if the bytes are the same.
    """

    def __init__(self, tokenizer, size: int = CACHE_PIECES):
        self.tokenizer, self.size = tokenizer, size
        one = lambda t: tokenizer.encode(t, add_special_tokens=False).ids
        self.mark = one("\x00")
        # Only a tokenizer that never joins over white space can be cut there.
        self.cuts = len(self.mark) == 1 and one("aB, \x00 c") == one("ab") + one(",") + self.mark + one("c")
        self.special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.forget()

    def forget(self):
        self.tables = [(np.zeros(0, U64), np.zeros(0, np.int64))] * 2
        self.ids, self.bytes = Lists(np.uint32), Lists(np.uint8)

    def whole(self, texts: list) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encoded(self, pieces: list) -> list[np.ndarray]:
        """Ids of each piece; many in one text, parted by a mark of their own."""
        odd = [i for i, p in enumerate(pieces) if "\x00" in p]
        if odd:
            known = dict(zip(odd, self.whole([pieces[i] for i in odd])))
            rest = iter(self.encoded([p for i, p in enumerate(pieces) if i not in known]))
            return [known[i] if i in known else next(rest) for i in range(len(pieces))]
        out: list = []
        runs = [pieces[i : i + 500] for i in range(0, len(pieces), 500)]
        for ids in self.whole([" \x00 ".join(r) for r in runs]):
            at = np.flatnonzero(ids == self.mark[0])
            out += [x[1:] if i else x for i, x in enumerate(np.split(ids, at))]
        return out

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of the piece with each hash; -1 if it isn't known."""
        number = np.full(len(keys), -1, np.int64)
        for known, numbers in self.tables:
            if len(known):
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                hit = known[at] == keys
                number[hit] = numbers[at[hit]]
        return number

    def learn(self, keys: np.ndarray, pieces: list) -> None:
        number = len(self.ids.ptr) - 1 + np.arange(len(pieces))
        self.ids.add(self.encoded([p.decode() for p in pieces]))
        self.bytes.add([np.frombuffer(p, np.uint8) for p in pieces])
        main, recent = self.tables
        recent = self.merged(recent, (keys, number))
        if len(recent[0]) > 1 << 16:
            main, recent = self.merged(main, recent), tuple(x[:0] for x in recent)
        self.tables = [main, recent]

    @staticmethod
    def merged(a, b):
        both = [np.concatenate(x) for x in zip(a, b)]
        order = np.argsort(both[0], kind="stable")
        return tuple(x[order] for x in both)

    def encode(self, block: Block) -> tuple[np.ndarray, np.ndarray] | None:
        """(ids of all texts of a block of lower-cased ASCII, ids of each text);
        None if two pieces with the same hash differ."""
        kind = KIND[block.data]
        size = len(kind)
        edge = np.zeros(size + 1, bool)
        edge[block.offsets] = True
        parted = np.ones(size + 1, bool)
        parted[1:-1] = (kind[1:] == 0) | (kind[:-1] == 0) | (kind[1:] * kind[:-1] == 2)
        parted |= edge
        starts = np.flatnonzero((kind > 0) & parted[:-1])
        ends = np.flatnonzero((kind > 0) & parted[1:]) + 1
        keys, first, which = np.unique(block.hashes(starts, ends), return_index=True, return_inverse=True)
        number = self.find(keys)
        if len(keys) and sum(len(t[0]) for t in self.tables) + (number < 0).sum() > self.size:
            self.forget()
            number[:] = -1
        new = np.flatnonzero(number < 0)
        if len(new):
            raw = block.data.tobytes()
            self.learn(keys[new], [raw[starts[i] : ends[i]] for i in first[new]])
            number = self.find(keys)
        number = number[which]
        if not np.array_equal(self.bytes.sizes(number), ends - starts):
            return None
        if not np.array_equal(self.bytes.take(number), block.data[kind > 0]):
            return None
        upto = np.concatenate([[0], np.cumsum(self.ids.sizes(number))])
        return self.ids.take(number), np.diff(upto[np.searchsorted(starts, block.offsets)])


def _pieces(path: str) -> Pieces:
    if path not in _STATE:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _STATE[path] = Pieces(Tokenizer.from_file(path))
    return _STATE[path]


def encode_texts(column, path: str) -> list[np.ndarray]:
    """Ids of each text of an Arrow column."""
    pieces = _pieces(path)
    block = Block(column, lower=True)
    texts = block.data.tobytes()
    found = None
    if pieces.cuts and not any(s.lower().encode() in texts for s in pieces.special):
        found = pieces.encode(block)
    if found is None:
        return pieces.whole([t or "" for t in column.to_pylist()])
    ids, sizes = found
    return np.split(ids, np.cumsum(sizes)[:-1])


FILE_SCHEMA = (
    "shard int, first long, n_ids long, doc_ids array<long>, n_tokens array<long>, payload binary"
)


def _map_write(path: str, end_id: int, percentile: float):
    end = np.array([end_id], np.uint32)

    def chunk(shard, first, doc_ids, parts):
        sizes = [len(p) for p in parts]
        ids = np.concatenate(parts)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([shard], pa.int32()),
                pa.array([first], pa.int64()),
                pa.array([len(ids)], pa.int64()),
                pa.array([doc_ids], pa.list_(pa.int64())),
                pa.array([sizes], pa.list_(pa.int64())),
                pa.array([pack(ids, percentile)], pa.binary()),
            ],
            ["shard", "first", "n_ids", "doc_ids", "n_tokens", "payload"],
        ), len(ids)

    def run(batches):
        first, held, doc_ids, parts, shard = 0, 0, [], [], None
        for part in blocks(batches):
            shard = part.column(2)[0].as_py()
            for doc_id, ids in zip(part.column(0).to_pylist(), encode_texts(part.column(1), path)):
                doc_ids.append(doc_id)
                parts.append(np.concatenate([ids, end]))
                held += len(parts[-1])
                if held >= CHUNK_IDS:
                    batch, n = chunk(shard, first, doc_ids, parts)
                    yield batch
                    first, held, doc_ids, parts = first + n, 0, [], []
        if doc_ids:
            yield chunk(shard, first, doc_ids, parts)[0]

    return run


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, percentile: float = 95.0) -> None:
    """Tokenise ``docs`` (doc_id, text) with the tokenizer file and write them."""
    spark = docs.sparkSession
    small_batches(spark)
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["doc_id", "tie"]
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.xxhash64(F.col("text").cast("string")).alias("tie"),
    )
    rows = rows.repartitionByRange(shards, *order).sortWithinPartitions(*order)
    rows = rows.select("doc_id", "text", F.spark_partition_id().alias("shard"))
    rows.mapInArrow(_map_write(tokenizer, end_id, percentile), FILE_SCHEMA).write.parquet(path)


def _map_read(batches):
    for batch in batches:
        base = batch.column(0).to_pylist()
        first = batch.column(1).to_pylist()
        for i in range(batch.num_rows):
            sizes = batch.column(3)[i].values.to_numpy()
            ids = unpack(batch.column(4)[i].as_py()).astype("<u4").tobytes()
            ends = np.cumsum(sizes)
            begins = ends - sizes
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(2)[i].values,
                    pa.array(begins + base[i] + first[i]),
                    pa.array(sizes),
                    pa.array([zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(begins, ends)], pa.int64()),
                ],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 of
    every document, decoded from the files.  Only the shards' totals (one row
    each) are summed in order and sent to all tasks."""
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    totals = files.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = totals.select("shard", before.alias("base"))
    rows = files.join(F.broadcast(base), "shard").select("base", "first", "doc_ids", "n_tokens", "payload")
    return rows.mapInArrow(_map_read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_and_read(docs: DataFrame, tokenizer: str | None = None, path: str | None = None) -> DataFrame:
    spark = docs.sparkSession
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    path = path or scratch_path(spark, "token-files")
    write(docs, path, str(tokenizer))
    return read(spark, path)


def query(spark, sf_dir):
    """Write all documents' ids and read them back."""
    return encode_and_read(read_table(spark, sf_dir, "documents"))
