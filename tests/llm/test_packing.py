import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import cases
from tidewalk.llm import packing, queries, tokens

PATH = tokens.default_tokenizer()


@given(st.text(alphabet=st.sampled_from(list("aB1é \n\t\f\x1c\xa0<|>endoftext日.'s")), max_size=60))
@settings(max_examples=200, deadline=None)
def test_ids_are_those_of_the_tokenizers_library(text):
    encode = tokens.encoder(PATH)
    assert encode.encode([text, "x " + text]) == encode.plain([text, "x " + text])


def test_special_tokens_and_real_texts(spark, sf_dir):
    texts = [r[0] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").limit(100).collect()]
    texts += ["a <|endoftext|> b", "<|endoftext|>"]
    encode = tokens.encoder(PATH)
    assert encode.encode(texts) == encode.plain(texts)


def test_two_smaller_replace_the_smallest():
    # greedy takes 6 and then 3; two of 2 fill the gap of 4 exactly
    plan = packing.best_two_fit({6: 1, 3: 1, 2: 2}, 10)
    assert plan[0].pieces == ((6, 1), (2, 2))


@given(st.dictionaries(st.integers(1, 50), st.integers(1, 200), max_size=30))
@settings(max_examples=200, deadline=None)
def test_plan_uses_every_piece_once_and_fits(counts):
    plan = packing.best_two_fit(counts, 50)
    used = Counter()
    for filling in plan:
        assert 0 < sum(length * copies for length, copies in filling.pieces) <= 50
        for length, copies in filling.pieces:
            used[length] += copies * filling.times
    assert used == Counter(counts)
    lookup = packing.places(plan)
    taken = set()
    for length, n in counts.items():
        sequence, offset = lookup(np.full(n, length), np.arange(n))
        for s, o in zip(sequence.tolist(), offset.tolist()):
            cells = {(s, o + k) for k in range(length)}
            assert not cells & taken and o + length <= 50
            taken |= cells


def check(rows, texts, capacity):
    """Pieces are whole, places are gapless, and few more sequences are used than the tokens need."""
    encode = tokens.encoder(PATH)
    expected = Counter()
    for doc_id, text in texts:
        ids = np.concatenate([np.frombuffer(encode.plain([text or ""])[0], "<u4"), [0]]).astype("<u4")
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            expected[doc_id, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r["length"] for r in rows)
    return len(sequences), math.ceil(total / capacity)


@pytest.mark.parametrize("capacity", [16, 2048])
def test_awkward_documents(spark, capacity):
    rows = packing.pack_documents(cases.documents(spark), PATH, capacity).collect()
    used, least = check(rows, [(r[0], r[1]) for r in cases.awkward()], capacity)
    assert used <= least * 1.02 + 2


def test_query_packs_nearly_as_tightly_as_possible(spark, sf_dir):
    rows = queries.QUERIES["op10_best_fit_packing"](spark, sf_dir).collect()
    texts = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    used, least = check(rows, texts, 2048)
    assert used <= least + 1


def test_sequences_hold_the_ids(spark):
    pieces = packing.pieces(cases.documents(spark), PATH, 64, with_ids=True)
    packed = packing.pack(pieces, 64, "doc_id", "piece", "start", "ids_crc32").cache()
    whole = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        part = whole[r["sequence_id"]][4 * r["offset"]: 4 * (r["offset"] + r["length"])]
        assert zlib.crc32(part) == r["ids_crc32"]
    assert sum(map(len, whole.values())) == 4 * packed.groupBy().sum("length").first()[0]


def test_empty_table(spark):
    assert packing.pack_documents(cases.empty(spark), PATH).collect() == []
