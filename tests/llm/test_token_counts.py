import random

import cases
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewalk.llm import queries, token_counts

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]
ODD = "ab'stredlmvELD 9<|>endoftext\n\t\x85\xa0\x1c\x00ß½²ÿµªÀńé日本\U0001F600İΣ１́"


def splitter(name):
    return token_counts.pre_tokens(public_tokenizers.path(name))


def whole(name, text):
    return len(splitter(name).tokenizer.encode(text, add_special_tokens=False).ids)


def by_words(name, text):
    made = splitter(name)
    latin = made.is_latin(text)
    return sum(n * made.pieces(w.translate(made.letters) if latin else w) for w, n in made.count(text, latin).items())


def test_fast_way_is_taken_for_word_rules_only():
    assert splitter(FILES[0]).is_latin("é") and not splitter(FILES[0]).is_latin("ń")
    assert not splitter(FILES[1]).is_latin("e")


@pytest.mark.parametrize("name", FILES)
@given(st.text(st.sampled_from(ODD), max_size=40), st.booleans())
@settings(max_examples=400, deadline=None)
def test_sums_are_the_library_counts(name, text, special):
    text = text[:9] + "<|endoftext|>" + text[9:] if special else text
    assert by_words(name, text) == whole(name, text)


def test_every_latin_character_beside_a_letter():
    for a in range(256):
        text = "".join(f"x{chr(a)}{chr(b)}'s " for b in range(0, 256, 5))
        assert by_words(FILES[0], text) == whole(FILES[0], text)


def test_long_texts_are_split_whole(monkeypatch):
    monkeypatch.setattr(token_counts, "CHARS_AT_ONCE", 50)
    rng = random.Random(1)
    for _ in range(30):
        text = " ".join("".join(rng.choice("ab'sé1!日") for _ in range(rng.randrange(40))) for _ in range(30))
        assert "".join(token_counts.parts(text, 50)) == text
        assert by_words(FILES[0], text) == whole(FILES[0], text)
    assert list(token_counts.parts("x" * 500, 50)) == ["x" * 500]


@pytest.mark.parametrize("name, block_chars", [(FILES[0], 4 << 20), (FILES[0], 900), (FILES[1], 4 << 20)])
def test_awkward_documents(spark, monkeypatch, name, block_chars):
    monkeypatch.setattr(token_counts, "BLOCK_CHARS", block_chars)
    rows = cases.awkward() + [(50, "<|endoftext|>It's <|startoftext|>", "en", "a", 1), (51, "\x00\x1c", "en", "a", 1)]
    found = token_counts.count_tokens(cases.documents(spark, rows), public_tokenizers.path(name), limit=40)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    expected = []
    for doc, text, *_ in rows:
        n = whole(name, text or "")
        expected.append((doc, len((text or "").encode()), n, n > 40))
    assert sorted((tuple(r) for r in found.collect()), key=str) == sorted(expected, key=str)


def test_empty_table(spark):
    path = public_tokenizers.path(FILES[0])
    assert token_counts.count_tokens(cases.empty(spark), path, 9).collect() == []


def test_query_equals_the_library(spark, sf_dir):
    found = sorted(tuple(r) for r in queries.op13_token_counts(spark, sf_dir).collect())
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    counts = [(d, len((t or "").encode()), whole(FILES[0], t or "")) for d, t in texts]
    assert found == sorted((*row, row[2] > 2048) for row in counts)
