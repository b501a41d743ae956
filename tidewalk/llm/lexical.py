"""Ranked lexical search with sequential reads only (NRA, no random access).

Documents are split into terms once; a document's row keeps its length and the frequencies of the terms that queries
use. Search reads these rows in segments of bounded size. In a segment every term's list is sorted by impact, and a
query reads its lists from the top: what it has seen of a document is a lower bound of its score, and the impacts at
which the unread rests start bound it from above. Reading goes on until the best documents of the segment, ties
included, have exact scores and no other can reach them. The best of all segments are cut to the best of the table.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewalk.llm.common import materialise, slices

# A term is a run of ASCII letters and digits and of all characters beyond ASCII.
TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_BREAK = re.compile(rb"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]")
BYTES_AT_ONCE = 1 << 20  # bytes of a text split into terms at a time
TERMS_AT_ONCE = 200_000  # about how many (query, term) rows are searched at a time, and kept in a task's memory
SEGMENT_POSTINGS = 2_000_000  # postings of one segment; a longer document is a segment of its own
FIRST_READ = 64  # entries that a query's first round reads of every list; each round reads twice as many
INDEX = "doc_id long, n long, terms array<string>, tfs array<long>"
FOUND = "item_id long, doc_id long, score long"


def term_counts(text: str) -> Counter:
    """How often every term, as lower-case UTF-8, occurs in the text."""
    data, found, start = text.encode().lower(), Counter(), 0
    while len(data) - start > BYTES_AT_ONCE:
        gap = _BREAK.search(data, start + BYTES_AT_ONCE)
        if gap is None:
            break
        found.update(TERM.findall(data, start, gap.start()))
        start = gap.end()
    found.update(TERM.findall(data, start))
    return found


def term_rows(texts: DataFrame, label: str, wanted: set[bytes] | None = None) -> DataFrame:
    """(doc_id, n, terms, tfs) of every row (doc_id, text) with a term; `terms` are those `wanted`, or all."""
    def split(batches):
        for batch in slices(batches):
            ids, lengths, terms, tfs, ends = [], [], [], [], [0]
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                found = term_counts(text or "")
                if not found:
                    continue
                kept = found if wanted is None else {t: found[t] for t in found.keys() & wanted}
                ids.append(doc_id)
                lengths.append(found.total())
                terms.extend(kept)
                tfs.extend(kept.values())
                ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()),
                pa.ListArray.from_arrays(offsets, pa.array(terms, pa.binary()).cast(pa.string())),
                pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int64())),
            ], names=["doc_id", "n", "terms", "tfs"])

    selected = texts.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return materialise(selected.mapInArrow(split, INDEX), label)


def _exploded(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", F.explode(F.arrays_zip(F.col("terms").alias("term"), F.col("tfs").alias("tf"))).alias("p"))


class Query:
    """The lists that a query reads: terms of a block, by number, and how often each occurs in the query."""

    def __init__(self, item_id, terms: np.ndarray, times: np.ndarray):
        self.item_id, self.terms, self.times = item_id, terms, times


class Segment:
    """Impact-sorted lists over some documents."""

    def __init__(self, doc_ids: np.ndarray, docs: np.ndarray, terms: np.ndarray, impacts: np.ndarray, n_terms: int):
        order = np.lexsort((-impacts, terms))
        self.doc_ids, self.docs, self.impacts = doc_ids, docs[order], impacts[order]
        self.starts = np.searchsorted(terms[order], np.arange(n_terms + 1))

    def best(self, query: Query, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of the k highest scores above 0, equal scores by document id.

        A round reads on in the lists that could still change the result. The bounds are taken anew from what has been
        read; as rounds double, that costs no more than reading.
        """
        first, last = self.starts[query.terms], self.starts[query.terms + 1]
        some = last > first
        begin, ends, times = first[some], last[some], query.times[some]
        at = begin.copy()
        if not len(at):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        lower = np.zeros(len(self.doc_ids), np.int64)
        frontier = self.impacts[at] * times  # of the next entry: no unread one is above it
        reading, step = np.ones(len(at), bool), FIRST_READ
        while reading.any():
            for i in np.flatnonzero(reading):
                upto = min(at[i] + step, ends[i])
                lower[self.docs[at[i]:upto]] += self.impacts[at[i]:upto] * times[i]
                at[i] = upto
                frontier[i] = self.impacts[upto] * times[i] if upto < ends[i] else 0
            step *= 2
            # The k-th lower bound is the score to reach. With fewer documents above 0 any document may come in.
            seen = np.flatnonzero(lower)
            reach = int(np.partition(lower[seen], len(seen) - k)[len(seen) - k]) if len(seen) >= k else 1
            rest = np.full(len(lower), frontier.sum())  # what the lists that have not shown a document could add
            for i in np.flatnonzero(frontier):
                rest[self.docs[begin[i]:at[i]]] -= frontier[i]
            candidates = seen[lower[seen] + rest[seen] >= reach]
            among = np.zeros(len(lower), bool)
            among[candidates] = True
            missing = np.array([len(candidates) > among[self.docs[begin[i]:at[i]]].sum() for i in range(len(at))])
            others = frontier.sum() >= reach  # a document that no list has shown yet could come in
            reading = (frontier > 0) & (missing | others)
        order = np.lexsort((self.doc_ids[candidates], -lower[candidates]))[:k]
        return candidates[order], lower[candidates[order]]


def _segments(batches: Iterable[pa.RecordBatch], vocabulary: pa.Array, weights: np.ndarray, n_docs: int, total: int):
    """Segments of the rows that have a term of the vocabulary, in the order they are read."""
    kept: list[tuple] = []
    size = 0

    def build():
        ids = np.concatenate([k[0] for k in kept])
        shift = np.cumsum([0, *[len(k[0]) for k in kept]])
        docs = np.concatenate([k[1] + s for k, s in zip(kept, shift)])
        terms, tfs = (np.concatenate([k[c] for k in kept]) for c in (2, 3))
        m = np.concatenate([k[4] for k in kept])
        impacts = weights[terms] * ((1_000_000_000 * tfs) // (1000 * tfs + 8 * m[docs]))
        return Segment(ids, docs, terms, impacts, len(weights))

    for batch in batches:
        lists = batch.column("terms")
        numbers = pc.index_in(lists.flatten(), value_set=vocabulary)
        known = numbers.is_valid().to_numpy(zero_copy_only=False)
        if not known.any():
            continue
        docs = np.repeat(np.arange(batch.num_rows), pc.list_value_length(lists).to_numpy())[known]
        terms = numbers.drop_null().to_numpy().astype(np.int64)
        tfs = batch.column("tfs").flatten().to_numpy()[known]
        m = 25 + (75 * batch.column("n").to_numpy() * n_docs) // total
        # a null id comes after the others
        ids = pc.fill_null(batch.column("doc_id"), NO_ID).to_numpy()
        if kept and size + len(docs) > SEGMENT_POSTINGS:
            yield build()
            kept, size = [], 0
        kept.append((ids, docs, terms, tfs, m))
        size += len(docs)
    if kept:
        yield build()


NO_ID = (1 << 63) - 1  # stands for a null id inside tasks


def _find(index: DataFrame, queries: list[Query], terms: list[str], weights: list[int], n_docs: int, total: int, k: int):
    """(item_id, doc_id, score) of the k best documents of every segment, for some queries."""
    def search(batches: Iterator[pa.RecordBatch]):
        vocabulary, weight = pa.array(terms, pa.string()), np.array(weights, np.int64)
        for segment in _segments(batches, vocabulary, weight, n_docs, total):
            for query in queries:
                docs, scores = segment.best(query, k)
                if len(docs):
                    ids = segment.doc_ids[docs]
                    yield pa.RecordBatch.from_pydict({
                        "item_id": pa.array([query.item_id] * len(docs), pa.int64()),
                        "doc_id": pa.array(ids, pa.int64(), mask=ids == NO_ID), "score": pa.array(scores, pa.int64()),
                    })

    return index.select("doc_id", "n", "terms", "tfs").mapInArrow(search, FOUND)


def search(documents: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score) of the k highest-scoring documents (doc_id, text) of every item (item_id, text).

    Items are taken in blocks of about `TERMS_AT_ONCE` (item, term) rows, each a job over the index, which is written
    once: with the items' terms alone while they are one block, with all terms otherwise. Null, empty and termless
    texts are in no list and in no count; an item without terms has no rows. Rows that share an item_id, or a null one,
    are one item with all their terms; rows that repeat a doc_id are documents of their own, and a null doc_id comes
    after the others in a tie. Texts of any length are split part by part. Empty tables give no rows; other columns are
    not looked at.
    """
    spark = documents.sparkSession
    asked = items.select(F.col("item_id").alias("doc_id"), "text")
    item_terms = materialise(
        _exploded(term_rows(asked, "item-terms")).groupBy(F.col("doc_id").alias("item_id"), "p.term")
        .agg(F.sum("p.tf").alias("times")), "items",
    )
    blocks = -(-item_terms.count() // TERMS_AT_ONCE)
    wanted = None
    if blocks <= 1:
        wanted = {row.term.encode() for row in item_terms.select("term").distinct().collect()}
    index = term_rows(documents, "index", wanted)
    n_docs, total = index.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    found = spark.createDataFrame([], FOUND)
    if n_docs:
        asked_terms = item_terms.select("term").distinct()
        df = materialise(
            _exploded(index).groupBy("p.term").count().join(asked_terms, "term").select("term", F.col("count").alias("df")), "df"
        )
        weighed = item_terms.join(df, "term")
        for block in range(blocks):
            part = weighed.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
            # about TERMS_AT_ONCE rows, whatever the tables' sizes
            rows = part.orderBy("item_id", "term").collect()
            terms = sorted({row.term for row in rows})
            numbers = {term: i for i, term in enumerate(terms)}
            weights = {row.term: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * row.df + 1))) for row in rows}
            queries: dict = {}
            for row in rows:
                queries.setdefault(row.item_id, []).append((numbers[row.term], row.times))
            made = [Query(item, *np.array(pairs, np.int64).T.copy()) for item, pairs in queries.items()]
            found = found.unionByName(_find(index, made, terms, [weights[t] for t in terms], n_docs, total, k))
    place = F.row_number().over(
        Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    )
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
