"""SimHash near-duplicates by anchor-point covering.

Fingerprints of 64 bits that differ in at most 3 bits differ in at most one bit of one half. The anchors of a half are
the codewords of the Hamming code on its low 31 bits: every half lies within one bit of exactly one anchor, its home,
and within two bits (covering radius plus threshold) of at most 16. A fingerprint is replicated to all of those, so it
meets at their home every fingerprint that could be linked to it, and all 64 bits are compared there.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewalk.llm.common import close_pairs, components, materialise, slices

SEED = 42
BITS_AT_ONCE = 1 << 16  # shingles whose bits are held at a time
CODE_BITS = 31


def fingerprint(text: str | None, words_per_shingle: int) -> int:
    """The 64-bit fingerprint, unsigned; 0 without words."""
    import xxhash

    words = (text or "").encode().lower().split()  # bytes: only A-Z are lowered, only ASCII white space splits
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < words_per_shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        last = words_per_shingle - 1
        spans = zip(starts[: len(words) - last].tolist(), ends[last:].tolist(), strict=True)
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in spans]
    counts = np.zeros(64, np.int64)
    for start in range(0, len(hashes), BITS_AT_ONCE):
        part = np.array(hashes[start: start + BITS_AT_ONCE], "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, words_per_shingle: int = 3, *carried: str) -> DataFrame:
    """doc_id, the carried columns and fp, the fingerprint's bits as a long, of every row; a null text has no words."""
    names = ["doc_id", *carried]

    def compute(batches):
        for batch in slices(batches):
            found = [fingerprint(t, words_per_shingle) for t in batch.column("text").to_pylist()]
            fp = pa.array(np.array(found, "<u8").view("<i8"), pa.int64())
            yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in names} | {"fp": fp})

    texts = documents.select(*names, F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(compute, documents.select(*names).schema.add("fp", "long"))


def covering_masks() -> tuple[np.ndarray, np.ndarray]:
    """What to flip, by syndrome, to reach every codeword within two bits, the home first; and how many there are."""
    masks, count = np.zeros((CODE_BITS + 1, CODE_BITS // 2 + 1), np.int64), np.ones(CODE_BITS + 1, np.int64)
    for syndrome in range(1, CODE_BITS + 1):
        masks[syndrome, 0] = 1 << (syndrome - 1)
        for i, j in combinations(range(1, CODE_BITS + 1), 2):
            if i ^ j == syndrome:
                masks[syndrome, count[syndrome]] = (1 << (i - 1)) | (1 << (j - 1))
                count[syndrome] += 1
    return masks, count


def syndromes(words: np.ndarray) -> np.ndarray:
    """The Hamming syndrome of each word: the exclusive or of the numbers, from 1, of its set bits."""
    out = np.zeros(len(words), np.int64)
    for bit in range(CODE_BITS):
        out ^= ((words >> bit) & 1) * (bit + 1)
    return out


def anchored(fps: DataFrame) -> DataFrame:
    """The fingerprints (column fp, distinct) at home and at every anchor they visit, as `close_pairs` takes them."""

    def replicate(batches):
        masks, count = covering_masks()
        for batch in slices(batches, 4096):
            fp = batch.column("fp").to_numpy()
            for half in (0, 1):
                word = (fp >> (32 * half)) & ((1 << CODE_BITS) - 1)
                syndrome = syndromes(word)
                anchors = word[:, None] ^ masks[syndrome]
                near = np.arange(masks.shape[1]) < count[syndrome][:, None]
                visits, visitor = anchors[near], np.repeat(fp, count[syndrome])
                ids = np.concatenate([fp, visitor])
                yield pa.RecordBatch.from_pydict({
                    "bucket": np.concatenate([anchors[:, 0], visits]) | (half << 32),
                    "home": np.arange(len(ids)) < len(fp), "sig": ids, "id": ids,
                })

    return fps.select("fp").mapInArrow(replicate, "bucket long, home boolean, sig long, id long")


def groups(rows: DataFrame, max_bits: int) -> DataFrame:
    """(fp, root) for every fingerprint of the rows: groups that share a root are linked."""
    if max_bits > 3:
        raise ValueError("two halves cover at most 3 differing bits")
    distinct = rows.select("fp").distinct()
    linked = components(close_pairs(anchored(distinct), max_bits, forest=True), "simhash")
    return distinct.join(linked, distinct["fp"] == linked["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(documents: DataFrame, words_per_shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id that links reach, for every row.

    Rows without words have fingerprint zero and are linked like any others. Null ids never are the smallest; a
    component of nothing but null ids has a null component_id. Repeated rows stay. An empty table gives none. At most
    3 bits: the covering holds no further.
    """
    rows = materialise(fingerprints(documents, words_per_shingle), "fingerprints")
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    tops = materialise(groups(rows, max_bits).join(least.hint("merge"), "fp"), "simhash-groups")
    smallest = tops.groupBy("root").agg(F.min("least").alias("component_id"))
    named = tops.join(smallest, "root").select("fp", "component_id")
    # A left join, though every row has a group: rows that repeat have a small file, by which Spark would broadcast them.
    return rows.join(named, "fp", "left").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def deduplicate(documents: DataFrame, words_per_shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """The documents with one row of each group: that with the smallest doc_id, an id before none; of equal ids, one.

    Rows are numbered in a written copy, so rows that repeat an id, or have none, are told apart.
    """
    numbered = materialise(documents.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    rows = materialise(fingerprints(numbered, words_per_shingle, "__row"), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__row")
    least = rows.groupBy("fp").agg(F.min(order).alias("least"))
    kept = groups(rows, max_bits).join(least.hint("merge"), "fp").groupBy("root").agg(F.min("least").alias("least"))
    return numbered.join(kept.select(F.col("least.__row").alias("__row")), "__row", "left_semi").drop("__row")
