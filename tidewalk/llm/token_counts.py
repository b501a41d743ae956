"""Token counts of whole documents without token ids.

A tokenizer cuts a text into pre-tokens and merges each by itself, so a text's token count is the sum over its distinct
pre-tokens of how often each occurs times its number of pieces. Documents are read once, in blocks: a block writes its
vocabulary and every document's frequencies over the places in it, packed. The vocabularies of all blocks are brought
together by pre-token, pieces are counted once for each, and the counts go back to their blocks and meet the
frequencies there. What moves by pre-token is a block's vocabulary, not its words.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewalk.llm.common import materialise, slices
from tidewalk.llm.tokens import byte_of

BLOCK_CHARS = 16 << 20  # characters of the documents of one block; a longer document is a block of its own
PIECES_A_ROW, DOCUMENTS_A_ROW = 4096, 512  # of a block, in one row
COUNTS_AT_ONCE = 1 << 20  # counts gathered before they are sent to their blocks
CHARS_AT_ONCE = 1 << 20  # characters split into words at a time
# The rules of the files with word ends. White space only parts words, so it need not be made equal.
WORD_RULES = {
    "normalizer": [("NFC", None), ("Replace", r"\s+"), ("Lowercase", None)],
    "pattern": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",
}
# The same pattern for lower-case Latin-1 text, whose letters, digits and spaces are written out.
_LETTER, _DIGIT, _SPACE = "a-zªµºß-öø-ÿ", "0-9²³¹¼-¾", "\\t-\\r \x85\xa0"
LATIN_WORDS = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_DIGIT}]|[^{_SPACE}{_LETTER}{_DIGIT}]+"
)
_GAP = re.compile(r"[ \t\n\r]")
BLOCKS = "block long, first int, pieces array<string>, doc_ids array<long>, n_bytes array<long>, words array<int>, packed binary"
COUNTS = "of long, slots array<int>, n array<int>"


def parts(text: str, size: int = CHARS_AT_ONCE) -> Iterator[str]:
    """The text cut behind white space into parts of about `size` characters; no pre-token spans white space."""
    start = 0
    while len(text) - start > size:
        gap = _GAP.search(text, start + size)
        if gap is None:
            break
        yield text[start:gap.end()]
        start = gap.end()
    yield text[start:] if start else text


class PreTokens:
    """Pre-tokens of a text and pieces of a pre-token, by a file of the `tokenizers` library.

    A pre-token is in the form that the merges see. A special string of the file is a pre-token of one piece. Latin-1
    texts under the rules `WORD_RULES` are split here, ten times as fast; tests compare both ways.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        if not told.get("pre_tokenizer"):
            raise ValueError(f"{path}: without pre-tokens the counts of words do not add up")
        added = told.get("added_tokens") or []
        if any(t[rule] for t in added for rule in ("normalized", "single_word", "lstrip", "rstrip")):
            raise ValueError(f"{path}: added tokens with rules of their own are not supported")
        self.specials = {t["content"] for t in added}
        longest_first = sorted(self.specials, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if added else None
        self.tokenizer = Tokenizer.from_file(path)
        self.fast = self._follows_word_rules(told)
        letters = {byte: letter for letter, byte in byte_of().items()}
        self.letters = {c: "".join(letters[b] for b in chr(c).encode()) for c in range(256)}

    @staticmethod
    def _follows_word_rules(told: dict) -> bool:
        steps = [
            (n["type"], n.get("pattern", {}).get("Regex")) for n in (told.get("normalizer") or {}).get("normalizers", [])
        ]
        before = told["pre_tokenizer"].get("pretokenizers", [])
        return steps == WORD_RULES["normalizer"] and [p["type"] for p in before] == ["Split", "ByteLevel"] and (
            before[0]["pattern"].get("Regex"), before[0]["behavior"], before[0]["invert"],
            before[1]["add_prefix_space"], before[1]["use_regex"],
        ) == (WORD_RULES["pattern"], "Removed", True, False, False)

    def _library(self, segment: str) -> list[str]:
        normalizer = self.tokenizer.normalizer
        plain = normalizer.normalize_str(segment) if normalizer else segment
        return [piece for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(plain)]

    def is_latin(self, text: str) -> bool:
        """Whether the text is split here."""
        if not self.fast:
            return False
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return False
        return True

    def count(self, text: str, latin: bool) -> Counter:
        """How often every pre-token occurs in the text; those of Latin-1 texts in plain letters."""
        found: Counter = Counter()
        segments = self.special.split(text) if self.special is not None and self.special.search(text) else [text]
        for segment in segments:
            if segment in self.specials:
                found[segment] += 1
                continue
            for part in parts(segment):
                found.update(LATIN_WORDS.findall(part.lower()) if latin else self._library(part))
        return found

    def pieces(self, piece: str) -> int:
        return 1 if piece in self.specials else len(self.tokenizer.model.tokenize(piece))


@lru_cache(maxsize=4)
def pre_tokens(path: str) -> PreTokens:
    """The worker's splitter for this file."""
    return PreTokens(path)


class _Latin(dict):
    """Places of pre-tokens in plain letters, in the vocabulary of their written form."""

    def __init__(self, vocabulary: dict[str, int], letters: dict[int, str]):
        super().__init__()
        self.vocabulary, self.letters = vocabulary, letters

    def __missing__(self, word: str) -> int:
        written = word if word.isascii() and word.isprintable() else word.translate(self.letters)
        place = self[word] = self.vocabulary.setdefault(written, len(self.vocabulary))
        return place


def pack(slots: np.ndarray, times: np.ndarray) -> bytes:
    """Rising places and frequencies of some documents: differences and frequencies by byte planes, compressed."""
    planes = np.concatenate([np.diff(slots, prepend=0), times]).astype("<i4").view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(np.ascontiguousarray(planes).tobytes(), 1)


def unpack(data: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, 2 * n)
    both = np.ascontiguousarray(planes.T).view("<i4").reshape(-1).astype(np.int64)
    return np.cumsum(both[:n]), both[n:]


class _Block:
    """Documents whose frequencies count places in one vocabulary."""

    def __init__(self, number: int, splitter: PreTokens):
        self.number, self.splitter, self.chars, self.vocabulary, self.documents = number, splitter, 0, {}, []
        self.latin = _Latin(self.vocabulary, splitter.letters)

    def add(self, doc_id, n_bytes, text: str) -> None:
        latin, places = self.splitter.is_latin(text), self.vocabulary
        found = self.splitter.count(text, latin)
        place = self.latin.__getitem__ if latin else lambda word: places.setdefault(word, len(places))
        slots = np.fromiter(map(place, found), np.int32, len(found))
        times = np.fromiter(found.values(), np.int32, len(found))
        order = np.argsort(slots)
        self.documents.append((doc_id, n_bytes, slots[order], times[order]))
        self.chars += len(text)

    def batches(self) -> Iterator[pa.RecordBatch]:
        words = list(self.vocabulary)
        for first in range(0, len(words), PIECES_A_ROW):
            yield self._row(first=first, pieces=words[first:first + PIECES_A_ROW])
        for first in range(0, len(self.documents), DOCUMENTS_A_ROW):
            ids, sizes, slots, times = map(list, zip(*self.documents[first:first + DOCUMENTS_A_ROW]))
            yield self._row(
                doc_ids=ids, n_bytes=sizes, words=[len(s) for s in slots],
                packed=pack(np.concatenate(slots), np.concatenate(times)),
            )

    def _row(self, **values) -> pa.RecordBatch:
        told = {"block": self.number, **values}
        return pa.RecordBatch.from_arrays([pa.array([told.get(f.name)], f.type) for f in _FIELDS], schema=_FIELDS)


_FIELDS = pa.schema([
    ("block", pa.int64()), ("first", pa.int32()), ("pieces", pa.list_(pa.string())), ("doc_ids", pa.list_(pa.int64())),
    ("n_bytes", pa.list_(pa.int64())), ("words", pa.list_(pa.int32())), ("packed", pa.binary()),
])


def frequencies(documents: DataFrame, path: str) -> DataFrame:
    """Rows of vocabulary (block, first, pieces) and of documents (block, doc_ids, n_bytes, words, packed).

    `pieces` take the places from `first` on; a document has as many of the packed frequencies as it has distinct
    `words`. Blocks are numbered by task and order. All rows of a task are committed together, so a task that runs
    again leaves no mixture.
    """
    def split(batches):
        splitter, task = pre_tokens(path), TaskContext.get().partitionId()
        numbers = count(task << 32)
        block = None
        for batch in slices(batches):
            for doc_id, n_bytes, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n_bytes", "text"))):
                if block is not None and block.chars + len(text) > BLOCK_CHARS:
                    yield from block.batches()
                    block = None
                block = block or _Block(next(numbers), splitter)
                block.add(doc_id, n_bytes, text)
        if block is not None:
            yield from block.batches()

    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    ).select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    return materialise(texts.mapInArrow(split, BLOCKS), "pre-tokens")


def piece_counts(vocabulary: DataFrame, path: str) -> DataFrame:
    """(of, slots, n): the piece counts of the blocks' places, from (piece, block, slot).

    The rows of a pre-token come one after the other, so its pieces are counted once. A frequent one has a row per
    block at most.
    """
    def merge(batches):
        splitter, gathered, size = pre_tokens(path), [], 0
        last, last_n = None, 0
        for batch in batches:
            words = batch.column("piece").dictionary_encode()
            distinct = words.dictionary.to_pylist()
            counted = np.array([last_n if w == last else splitter.pieces(w) for w in distinct], np.int32)
            if distinct:
                last, last_n = distinct[-1], int(counted[-1])
            gathered.append((
                batch.column("block").to_numpy(), batch.column("slot").to_numpy(), counted[words.indices.to_numpy()]
            ))
            size += batch.num_rows
            if size >= COUNTS_AT_ONCE:
                yield _by_block(gathered)
                gathered, size = [], 0
        if size:
            yield _by_block(gathered)

    ordered = vocabulary.repartition("piece").sortWithinPartitions("piece")
    return ordered.select("piece", "block", "slot").mapInArrow(merge, COUNTS)


def _by_block(gathered: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """One row per block of the counts gathered."""
    blocks, slots, n = (np.concatenate(side) for side in zip(*gathered))
    order = np.argsort(blocks, kind="stable")
    starts = np.flatnonzero(np.diff(blocks[order], prepend=-1))
    ends = pa.array([*starts, len(blocks)], pa.int32())
    lists = (pa.ListArray.from_arrays(ends, pa.array(side[order], pa.int32())) for side in (slots, n))
    return pa.RecordBatch.from_arrays([pa.array(blocks[order][starts], pa.int64()), *lists], names=["of", "slots", "n"])


def _sums(documents: pa.Table, counts: pa.Table) -> pa.Table:
    """The token counts of a block's documents from the counts of its vocabulary."""
    slots, n = (_flat(counts, c) for c in ("slots", "n"))
    of = np.zeros(len(slots), np.int64)
    of[slots] = n
    totals = [np.empty(0, np.int64)]
    for words, packed in zip(documents.column("words").to_pylist(), documents.column("packed").to_pylist()):
        ends = np.cumsum(words)
        places, times = unpack(packed, int(ends[-1]))
        running = np.concatenate([[0], np.cumsum(of[places] * times)])
        totals.append(np.diff(running[ends], prepend=0))
    return pa.table({
        "doc_id": pa.array([i for ids in documents.column("doc_ids").to_pylist() for i in ids], pa.int64()),
        "n_bytes": pa.array(_flat(documents, "n_bytes"), pa.int64()), "n_tokens": pa.array(np.concatenate(totals), pa.int64()),
    })


def _flat(table: pa.Table, column: str) -> np.ndarray:
    return table.column(column).combine_chunks().flatten().to_numpy(zero_copy_only=False)


def count_tokens(documents: DataFrame, path: str, limit: int) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of `documents` (doc_id, text), other columns left out.

    Null and empty texts have no bytes and no tokens; null ids and repeated rows are counted like others, each on a row
    of its own; an empty table gives no rows. Texts of any length are split part by part. A block's documents and
    vocabulary (`BLOCK_CHARS`) are what one task holds at a time, however often a word occurs in the corpus.
    """
    table = frequencies(documents, path)
    places = table.where("pieces IS NOT NULL").select("block", "first", F.posexplode("pieces").alias("at", "piece"))
    vocabulary = places.select("piece", "block", (F.col("first") + F.col("at")).alias("slot"))
    held = table.where("packed IS NOT NULL").select("block", "doc_ids", "n_bytes", "words", "packed")
    sums = held.groupBy("block").cogroup(piece_counts(vocabulary, path).groupBy("of")).applyInArrow(
        _sums, "doc_id long, n_bytes long, n_tokens long"
    )
    return sums.withColumn("over_limit", F.col("n_tokens") > limit)
