"""Token ids as binary shards in training order.

Every sequence has an index, counted over the tasks that cut the documents. A keyed Feistel network permutes the
numbers below a power of four; walking its cycle until a number is below the count of sequences makes that a
permutation of the indexes, and the image is the sequence's slot. Slots are dealt to tasks by range, and a shard holds
the records of consecutive slots, all of one length: slot s is record s mod R of shard s div R, so a reader can start
anywhere and go on from any slot.

Spark's text writer commits the shards, so they can go to any store that Spark writes, and a lost task leaves no half
file: a record is one line, whose last byte is a line feed and whose other bytes may be any.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewalk.llm.common import slices
from tidewalk.llm.tokens import encoder

ROUNDS = 6
END_ID = 0  # closes every document; zeros also fill its last record, which carries its length
OTHER_ROWS = "a task saw other documents than when it counted; write the table first"
RECORDS_AT_ONCE = 512
MOST_TASKS = 100_000


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _feistel(x: np.ndarray, half: int, key: int) -> np.ndarray:
    """A permutation of the numbers of 2 * half bits."""
    mask = np.uint64((1 << half) - 1)
    left, right = x >> np.uint64(half), x & mask
    for number in range(ROUNDS):
        salt = np.uint64((key * 0x9E3779B97F4A7C15 + (number + 1) * 0xD1B54A32D192ED03) % (1 << 64))
        left, right = right, left ^ (_mix(right ^ salt) & mask)
    return (left << np.uint64(half)) | right


def slots(index: np.ndarray, total: int, key: int) -> np.ndarray:
    """The slots of the indexes: a keyed permutation of 0 to total - 1."""
    half = max(1, (max(1, total - 1).bit_length() + 1) // 2)
    out = _feistel(index.astype(np.uint64), half, key)
    while (far := out >= total).any():
        out[far] = _feistel(out[far], half, key)
    return out.astype(np.int64)


@dataclass(frozen=True)
class Layout:
    """Tokens in a record and records in a shard. Ids of a vocabulary above 65,536 take four bytes."""

    tokens: int = 512
    records: int = 8192
    wide: bool = False

    def record(self) -> np.dtype:
        return np.dtype([
            ("slot", "<i8"), ("has_id", "u1"), ("doc_id", "<i8"), ("piece", "<u4"), ("n_tokens", "<u4"),
            ("ids", "<u4" if self.wide else "<u2", (self.tokens,)), ("end", "S1"),
        ])


class _Seen:
    """How many sequences a task has cut, and a checksum of its texts."""

    def __init__(self):
        self.count, self.crc = 0, 0

    def add(self, text: str, pieces: int) -> None:
        self.count += pieces
        self.crc = zlib.crc32(text.encode("utf-8", "replace"), zlib.crc32(b"|", self.crc))


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _counts(documents: DataFrame, tokenizer: str, layout: Layout) -> DataFrame:
    """(task, n, crc): what each task will cut."""

    def count(batches):
        ids, seen = encoder(tokenizer).ids, _Seen()
        for batch in slices(batches):
            for text in batch.column("text").to_pylist():
                seen.add(text or "", len(ids(text or "")) // layout.tokens + 1)
        yield pa.RecordBatch.from_pydict(
            {"task": [TaskContext.get().partitionId()], "n": [seen.count], "crc": [seen.crc]},
            schema=pa.schema({"task": pa.int32(), "n": pa.int64(), "crc": pa.int64()}),
        )

    return _texts(documents).mapInArrow(count, "task int, n long, crc long")


def _sequences(
    documents: DataFrame, tokenizer: str, layout: Layout, first: dict[int, int], told: dict[int, tuple[int, int]],
    total: int, key: int,
) -> DataFrame:
    """(shard, slot, doc_id, piece, n_tokens, ids) of every sequence, the ids compressed.

    `first` has the index of each task's first sequence, `told` what it counted.
    """
    code = layout.record()["ids"].base

    def cut(batches):
        import zstandard

        ids, seen, press = encoder(tokenizer).ids, _Seen(), zstandard.ZstdCompressor(level=1).compress
        task, step = TaskContext.get().partitionId(), layout.tokens * code.itemsize
        for batch in slices(batches):
            rows, piece, length, data, start = [], [], [], [], seen.count
            for row, text in enumerate(batch.column("text").to_pylist()):
                found = np.append(ids(text or ""), np.uint32(END_ID)).astype(code)
                whole = memoryview(found.tobytes())
                pieces = -(-len(found) // layout.tokens)
                seen.add(text or "", pieces)
                rows += [row] * pieces
                piece += range(pieces)
                length += [layout.tokens] * (pieces - 1) + [len(found) - layout.tokens * (pieces - 1)]
                data += [press(whole[at: at + step]) for at in range(0, len(whole), step)]
            index = np.arange(start, seen.count) + first.get(task, 0)
            if len(index) and index[-1] >= total:
                raise RuntimeError(OTHER_ROWS)
            slot = slots(index, total, key)
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array(slot // layout.records, pa.int64()), "slot": pa.array(slot, pa.int64()),
                "doc_id": batch.column("doc_id").take(pa.array(rows, pa.int64())), "piece": pa.array(piece, pa.int32()),
                "n_tokens": pa.array(length, pa.int32()), "ids": pa.array(data, pa.binary()),
            })
        if (seen.count, seen.crc) != told.get(task, (0, 0)):
            raise RuntimeError(OTHER_ROWS)

    return _texts(documents).mapInArrow(cut, "shard long, slot long, doc_id long, piece int, n_tokens int, ids binary")


def write_training_order(documents: DataFrame, folder: str, tokenizer: str, key: int, layout: Layout | None = None) -> int:
    """Write all sequences to `folder`/shard=N/ and return how many there are.

    Documents are tokenized twice: once to count, so that the ids themselves are neither stored nor shuffled before
    their slot is known. The table must give the same rows in the same order both times, as a Parquet scan does; a task
    that sees other rows the second time ends the job. A null text is empty; every document ends in `END_ID`. An empty
    table writes nothing.
    """
    layout = layout or Layout()
    if encoder(tokenizer).tokenizer.get_vocab_size() > (1 << (32 if layout.wide else 16)):
        raise ValueError("this vocabulary needs wide records")
    first, told, total = {}, {}, 0
    for task, n, crc in sorted(_counts(documents, tokenizer, layout).collect()):  # one row per task
        first[task], told[task], total = total, (n, crc), total + n
    if not total:
        return 0
    shards = -(-total // layout.records)
    placed = _sequences(documents, tokenizer, layout, first, told, total, key)
    record = layout.record()

    def fill(batches):
        import zstandard

        unpress = zstandard.ZstdDecompressor().decompress
        for batch in slices(batches, RECORDS_AT_ONCE):
            out = np.zeros(batch.num_rows, record)
            out["slot"], out["piece"], out["n_tokens"] = (batch.column(c).to_numpy() for c in ("slot", "piece", "n_tokens"))
            out["has_id"] = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            out["doc_id"] = batch.column("doc_id").fill_null(0).to_numpy()
            for row, ids in enumerate(batch.column("ids").to_pylist()):
                part = np.frombuffer(unpress(ids), record["ids"].base)
                out["ids"][row, : len(part)] = part
            size = record.itemsize - 1  # the writer adds the line feed
            data = out.tobytes()
            yield pa.RecordBatch.from_pydict({
                "shard": batch.column("shard").cast(pa.int32()), "slot": batch.column("slot"),
                "record": pa.array([data[i: i + size] for i in range(0, len(data), size + 1)], pa.binary()),
            })

    tasks = min(shards, MOST_TASKS)  # each writes a range of shards
    dealt = placed.repartitionById(tasks, F.expr(f"cast(shard * {tasks} div {shards} AS int)"))
    ranged = dealt.mapInArrow(fill, "shard int, slot long, record binary")
    lines = ranged.sortWithinPartitions("shard", "slot").select("shard", F.col("record").cast("string").alias("value"))
    lines.write.partitionBy("shard").option("lineSep", "\n").text(folder)
    return total


def read_training_order(spark: SparkSession, folder: str, layout: Layout | None = None, start: int = 0) -> DataFrame:
    """(shard, offset, slot, doc_id, piece, n_tokens, ids) of the records from slot `start` on; earlier shards are not read.

    `offset` is the record's first byte in its shard, `ids` the bytes of its tokens.
    """
    layout = layout or Layout()
    record = layout.record()
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    chosen = files.where(F.col("shard") >= start // layout.records).select(F.col("shard").cast("int").alias("shard"), "content")

    def parse(batches):
        width = record["ids"].base.itemsize
        for batch in slices(batches, 1):
            for shard, content in zip(batch.column("shard").to_pylist(), batch.column("content"), strict=True):
                whole = np.frombuffer(content.as_buffer(), record)
                for at in range(0, len(whole), RECORDS_AT_ONCE):
                    rows = whole[at: at + RECORDS_AT_ONCE]
                    n = rows["n_tokens"].astype(np.int64)
                    yield pa.RecordBatch.from_pydict({
                        "shard": pa.array([shard] * len(rows), pa.int32()),
                        "offset": pa.array((np.arange(len(rows)) + at) * record.itemsize, pa.int64()),
                        "slot": pa.array(rows["slot"].copy()), "piece": pa.array(rows["piece"].astype(np.int32)),
                        "doc_id": pa.array(rows["doc_id"].copy(), mask=rows["has_id"] == 0),
                        "n_tokens": pa.array(n), "ids": pa.array(
                            [r.tobytes()[: k * width] for r, k in zip(rows["ids"], n, strict=True)], pa.binary()),
                    })

    found = chosen.mapInArrow(
        parse, "shard int, offset long, slot long, piece int, doc_id long, n_tokens long, ids binary")
    return found.where(F.col("slot") >= start)
