"""Best-fit packing of documents into sequences of fixed length (best-two-fit).

Lengths are whole numbers up to the capacity, so the packer needs only how many pieces there are of each length: at most
`capacity` numbers, whatever the corpus. It fills a sequence greedily, largest piece first, then replaces the smallest
piece by two unpacked ones that fill the widened gap better, as long as that helps. A filling is repeated as often as
the counts allow, so the plan is a short list of fillings. Pieces take their places by their rank among equal lengths.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tidewalk.llm.common import materialise_with_task, rank_within, slices
from tidewalk.llm.tokens import encoder

END_ID = 0  # closes every document
RANKS = 1 << 48  # more than there are pieces of one length


@dataclass(frozen=True)
class Filling:
    """A sequence's pieces as (length, copies), and how many sequences are filled this way."""

    pieces: tuple[tuple[int, int], ...]
    times: int


def _two_for(gap: int, free: np.ndarray, lengths: np.ndarray) -> tuple[int, int] | None:
    """The two unpacked lengths with the largest sum that fits the gap."""
    if gap < 2:
        return None
    largest = np.maximum.accumulate(np.where(free[: gap + 1] > 0, np.arange(gap + 1), 0))
    a = lengths[(lengths * 2 <= gap) & (free[lengths] > 0)]
    b = largest[gap - a]
    fits = (b > a) | ((b == a) & (free[a] > 1))
    if not fits.any():
        return None
    a, b = a[fits], b[fits]
    best = int(np.argmax(a + b))
    return int(a[best]), int(b[best])


def best_two_fit(counts: dict[int, int], capacity: int) -> list[Filling]:
    """Fillings that use up all counts (length -> pieces)."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    plan = []
    while True:
        lengths = np.flatnonzero(left)
        if not len(lengths):
            return plan
        taken: dict[int, int] = {}
        gap, at = capacity, len(lengths) - 1
        while at >= 0 and gap:
            length = int(lengths[at])
            if copies := min(int(left[length]), gap // length):
                taken[length] = copies
                gap -= copies * length
            at = min(at - 1, int(np.searchsorted(lengths, gap, side="right")) - 1)
        while gap and sum(taken.values()) > 1:
            smallest = min(taken)
            free = left.copy()
            for length, copies in taken.items():
                free[length] -= copies
            two = _two_for(gap + smallest, free, lengths)
            if two is None or sum(two) <= smallest:
                break
            gap += smallest - sum(two)
            taken[smallest] -= 1
            for length in two:
                taken[length] = taken.get(length, 0) + 1
            taken = {length: copies for length, copies in taken.items() if copies}
        times = min(int(left[length]) // copies for length, copies in taken.items())
        for length, copies in taken.items():
            left[length] -= copies * times
        plan.append(Filling(tuple(sorted(taken.items(), reverse=True)), times))


def places(plan: list[Filling]):
    """A vectorised lookup (length, rank among equal lengths) -> (sequence, offset)."""
    used: dict[int, int] = {}
    entries, sequence = [], 0
    for filling in plan:
        offset = 0
        for length, copies in filling.pieces:
            entries.append((length * RANKS + used.get(length, 0), used.get(length, 0), sequence, copies, offset))
            used[length] = used.get(length, 0) + copies * filling.times
            offset += length * copies
        sequence += filling.times
    table = np.array(sorted(entries), np.int64).reshape(-1, 5)

    def lookup(length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        entry = table[np.searchsorted(table[:, 0], length * RANKS + rank, side="right") - 1]
        nth = rank - entry[:, 1]
        return entry[:, 2] + nth // entry[:, 3], entry[:, 4] + nth % entry[:, 3] * length

    return lookup


def pieces(documents: DataFrame, tokenizer: str, capacity: int, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, if asked for, the ids (32-bit, little-endian).

    A document is its ids and then `END_ID`; a null text counts as empty. Longer documents are cut so that only the
    first piece is shorter than the capacity. Only doc_id and text are read; rows may repeat, ids may be null.
    """

    def cut(batches):
        encode = encoder(tokenizer).encode
        end = np.array([END_ID], "<u4").tobytes()
        for batch in slices(batches):
            ids = encode([t or "" for t in batch.column("text").to_pylist()])
            rows, out = [], []
            for row, doc in enumerate(ids):
                doc += end
                total = len(doc) // 4
                first = total % capacity or capacity
                for piece, stop in enumerate(range(first, total + 1, capacity)):
                    start = max(0, stop - capacity) if piece else 0
                    part = doc[4 * start: 4 * stop]
                    rows.append(row)
                    out.append((piece, start, stop - start, zlib.crc32(part), part if with_ids else None))
            piece, start, length, crc, part = zip(*out, strict=True)
            columns = {
                "doc_id": batch.column("doc_id").take(pa.array(rows)), "piece": pa.array(piece, pa.int32()),
                "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()),
                "ids_crc32": pa.array(crc, pa.int64()),
            }
            if with_ids:
                columns["ids"] = pa.array(part, pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return documents.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(cut, schema)


def pack(table: DataFrame, capacity: int, *order: str) -> DataFrame:
    """Add sequence_id and offset to a table of pieces with a `length` of 1 to capacity; equal rows are interchangeable.

    Counts per length, at most `capacity` rows, go to the driver; the plan goes to the tasks.
    """
    written = materialise_with_task(table, "pieces")
    counts = {r["length"]: r["n"] for r in written.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    lookup = places(best_two_fit(counts, capacity))

    @pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = lookup(length.to_numpy(), rank.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    ranked = rank_within(written, "length", *order)
    placed = ranked.withColumn("_place", place("length", "position"))
    return placed.select(*table.columns, "_place.sequence_id", "_place.offset")


def pack_documents(documents: DataFrame, tokenizer: str, capacity: int = 2048) -> DataFrame:
    """The pieces of all documents with their places. An empty table gives an empty result."""
    return pack(pieces(documents, tokenizer, capacity), capacity, "doc_id", "piece", "start", "ids_crc32")


def sequences(packed: DataFrame) -> DataFrame:
    """The token sequences themselves, from packed pieces that kept their ids: sequence_id, n_tokens, ids.

    A group is one sequence, so it holds at most its capacity.
    """
    parts = F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])
    joined = F.aggregate(parts, F.expr("x''"), lambda all_, part: F.concat(all_, part))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))
