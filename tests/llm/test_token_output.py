import itertools
import zlib
from collections import Counter

import numpy as np
import pytest

import cases
from tidewalk.llm import queries, token_output, tokens

PATH = tokens.default_tokenizer()


@pytest.mark.parametrize("total", [1, 2, 3, 7, 64, 65, 1000, 4097])
def test_slots_are_a_keyed_permutation(total):
    a, b = (token_output.slots(np.arange(total), total, key) for key in (1, 2))
    assert sorted(a.tolist()) == sorted(b.tolist()) == list(range(total))
    assert total < 64 or (a != b).any() and (a != np.arange(total)).any()


def test_slots_do_not_follow_the_index():
    a = token_output.slots(np.arange(100_000), 100_000, 3).astype(float)
    assert abs(np.corrcoef(a, np.arange(100_000))[0, 1]) < 0.02 and abs(np.corrcoef(a[:-1], a[1:])[0, 1]) < 0.02


def expected(texts, length):
    encode, out = tokens.encoder(PATH), Counter()
    for doc_id, text in texts:
        ids = np.concatenate([np.frombuffer(encode.plain([text or ""])[0], "<u4"), [0]]).astype("<u2")
        for piece, at in enumerate(range(0, len(ids), length)):
            part = ids[at: at + length]
            out[doc_id, piece, len(part), zlib.crc32(part.tobytes())] += 1
    return out


def test_round_trip_and_resumed_reads(spark, tmp_path):
    layout = token_output.Layout(tokens=16, records=50)
    docs = cases.documents(spark)
    docs.write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    total = token_output.write_training_order(docs, f"{tmp_path}/out", PATH, 9, layout)
    rows = token_output.read_training_order(spark, f"{tmp_path}/out", layout).collect()
    got = Counter((r["doc_id"], r["piece"], r["n_tokens"], zlib.crc32(bytes(r["ids"]))) for r in rows)
    assert got == expected([(r[0], r[1]) for r in cases.awkward()], 16)
    assert sorted(r["slot"] for r in rows) == list(range(total))
    size = layout.record().itemsize
    for r in rows:
        assert (r["shard"], r["offset"]) == (r["slot"] // 50, r["slot"] % 50 * size)
    resumed = token_output.read_training_order(spark, f"{tmp_path}/out", layout, start=123).collect()
    assert sorted(map(tuple, resumed), key=str) == sorted((tuple(r) for r in rows if r["slot"] >= 123), key=str)
    # a plain seek and read gives the same record
    row = next(r for r in rows if r["slot"] == 77)
    files = list((tmp_path / "out" / "shard=1").glob("part-*"))
    assert len(files) == 1
    record = np.fromfile(files[0], layout.record(), 1, offset=row["offset"])[0]
    assert record["slot"] == 77 and record["ids"][: row["n_tokens"]].tobytes() == bytes(row["ids"])


def test_another_order_of_rows_is_noticed(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(50)], "doc_id long, text string").repartition(3)
    docs.write.parquet(f"{tmp_path}/docs")
    first = spark.read.parquet(f"{tmp_path}/docs")
    plain = token_output._sequences
    other = lambda documents, *args: plain(documents.where("doc_id <> 7"), *args)
    monkeypatch.setattr(token_output, "_sequences", other)
    with pytest.raises(Exception, match="other documents"):
        token_output.write_training_order(first, f"{tmp_path}/out", PATH, 9)


def test_query_and_empty_table(spark, sf_dir, tmp_path):
    rows = queries.QUERIES["op1_training_order"](spark, sf_dir).collect()
    texts = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert Counter((r["doc_id"], r["piece"], r["n_tokens"], r["ids_crc32"]) for r in rows) == expected(texts, 512)
    assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
    assert token_output.write_training_order(cases.empty(spark), f"{tmp_path}/none", PATH, 1) == 0


def test_words_are_found_without_a_lookahead():
    """Every pair and triple of Latin-1 white space and of what stands beside it, inside a text and at both ends."""
    encode = tokens.encoder(PATH)
    signs = ["\t", "\n", "\v", "\r", " ", "\x85", "\xa0", "\x1c", "a", "é", "7", "²", "'s", "!", "'"]
    texts = ["".join(t) for n in (1, 2, 3) for t in itertools.product(signs, repeat=n)]
    texts += [f"word{t}end" for t in texts] + [" \n" * 50, "a" + "\n" * 40 + " b" + " " * 30, "x\n\n  y\n\n\tz\n\n"]
    assert encode.encode(texts) == encode.plain(texts)
    assert "(?!" not in encode.fast._pat_str
    assert tokens.stretches("a  b \n\n c  ", b"a  b \n\n c  ") == ["a ", " b \n\n", " c  "]
