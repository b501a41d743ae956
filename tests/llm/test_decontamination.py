from collections import defaultdict

import cases
from tidewalk.llm import decontamination, queries

QUESTION = "a train travels 120 km in 3 hours how far will the train travel in 5 hours if the speed of 120 stays"
NAMED = "yesterday morning farmer John Smith sold 12 fresh apples to his old neighbour and John kept the remaining money"


def found(spark, texts, items):
    docs = cases.documents(spark, [(i, t, "en", "a", 0) for i, t in enumerate(texts)])
    benchmark = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(items)], "item_id long, text string, doc_id string")
    rows = decontamination.contaminated(docs, benchmark).collect()
    kept = {r["doc_id"] for r in decontamination.decontaminate(docs, benchmark).collect()}
    leaks = {r["doc_id"] for r in rows if r["item_words"] >= decontamination.LEAST_WORDS or r["whole_text"]}
    assert kept == set(range(len(texts))) - leaks
    return {(r["doc_id"], r["item_id"]): r["literal"] for r in rows}


def test_templates(spark):
    frame = spark.createDataFrame([("Then, Bob Ray ran 3.5 km, or 12,000 m. The end - 7 hours",)], "text string")
    out = frame.select(decontamination.words(frame.text).alias("w")).select("w", decontamination.template("w")).first()
    assert out[0].replace(decontamination.MARK, "").split(" ") == ["Then", "Bob", "Ray", "ran", "3.5", "km", "or", "12,000", "m", "The", "end", "7", "hours"]
    assert out[1].split(" ") == ["then", "<name>", "<name>", "ran", "<number>", "<unit>", "or", "<number>", "<unit>", "the", "end",
                                 "<number>", "<unit>"]


def test_literal_and_reparameterised_items(spark):
    other = QUESTION.replace("120", "90").replace(" 3 ", " 4 ").replace(" 5 ", " 9 ").replace("km", "miles")
    clash = QUESTION.replace("travels 120", "travels 90")  # 120 would be 90 and 120
    renamed = NAMED.replace("John", "Peter").replace("12 ", "7 ")
    texts = [
        cases.prose(1, 50) + " " + QUESTION + ". " + cases.prose(2, 50), "intro words here " + other, clash, renamed,
        cases.prose(3, 300), None, "", QUESTION[:30], QUESTION + "\n" + other,
    ]
    got = found(spark, texts, [QUESTION, NAMED, None, "", "too short", QUESTION])
    assert got == {(0, 0): True, (1, 0): False, (3, 1): False, (8, 0): True}


def test_short_items_are_matched_whole(spark):
    got = found(spark, ["x y quick brown foxes jumped over z", "quick brown foxes jumped under"], ["quick brown foxes jumped over"])
    assert got == {(0, 0): True}


def test_blocks_of_the_index_give_the_same(spark, monkeypatch, sf_dir):
    whole = sorted(map(tuple, queries.QUERIES["op7_benchmark_decontamination"](spark, sf_dir).collect()))
    monkeypatch.setattr(decontamination, "INDEX_ROWS", 300)
    assert sorted(map(tuple, queries.QUERIES["op7_benchmark_decontamination"](spark, sf_dir).collect())) == whole


def test_query_finds_the_passages_and_no_clean_document(spark):
    folder = "/root/testdata/sf0.01"
    got = {(r["doc_id"], r["item_id"]) for r in queries.QUERIES["op7_benchmark_decontamination"](spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{folder}/benchmark.parquet").collect()
    shingles = defaultdict(set)
    for item_id, text in items:
        words = text.split()
        for i in range(len(words) - 7):
            shingles[tuple(words[i: i + 8])].add(item_id)
    expected, touched = set(), set()
    for doc_id, text in docs:
        expected |= {(doc_id, i) for i, t in items if t in text}
        words = text.split()
        for i in range(len(words) - 7):
            touched |= {(doc_id, item) for item in shingles.get(tuple(words[i: i + 8]), ())}
    assert expected and expected <= got <= touched


def test_awkward_documents(spark):
    benchmark = spark.createDataFrame([(1, cases.prose(1, 60)), (None, cases.prose(2, 50))], "item_id long, text string")
    docs = cases.documents(spark)
    rows = decontamination.contaminated(docs, benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} >= {(5, 1), (6, 1), (None, None)}
    kept = decontamination.decontaminate(docs, benchmark)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert 5 not in ids and 6 not in ids and ids.count(None) == 1  # the null text with a null id is clean
    assert decontamination.contaminated(cases.empty(spark), benchmark).collect() == []
    nothing = benchmark.where("item_id < 0")
    assert decontamination.contaminated(docs, nothing).collect() == []
    assert decontamination.decontaminate(docs, nothing).count() == len(cases.awkward())


SENTENCES = "Tom has 5 apples. Sue has 3 pears. Ann has 9 plums. Tom gives Sue 2 apples. How many apples has Tom now?"


def test_names_at_the_start_of_sentences(spark):
    renamed = SENTENCES.replace("Tom", "Bob").replace("Sue", "Eva").replace("Ann", "Joe").replace("5", "8")
    got = found(spark, [renamed, "he said: (" + renamed + ")", SENTENCES], [SENTENCES])
    assert got == {(0, 0): False, (1, 0): False, (2, 0): True}


def test_copies_in_other_case_or_after_other_words(spark):
    short = "Marie went to Paris with seven friends"
    texts = [NAMED.lower(), NAMED.upper(), "and then " + short + " of old", "And. " + short, short.lower(), "some " + SENTENCES.lower()]
    got = found(spark, texts, [NAMED, short, SENTENCES])
    assert got == {(0, 0): True, (1, 0): True, (2, 1): True, (3, 1): True, (4, 1): True, (5, 2): True}


def test_items_without_a_plain_window_are_found_as_a_whole(spark):
    items = [
        "Solve 3 x 4 + 5", "Ann Bob Eva Joe Tom Sue Max Kim Ray Lee Amy", "12 km 13 km 14 km 15 km 16 km 17 km", "too short",
        "今天天气很好，我们去公园散步吧", "テキストを3回読む", "ทดสอบภาษาไทย", "###",
    ]
    texts = [f"so {item.lower()} it is" for item in items] + ["我说" + items[4] + "你呢", "彼は" + items[5] + "と言った"]
    clean = ["solve 3 x 4 + 6", "今天天气很好我们去公园", "too long and short", "12 km 13 km 14 km", "", None]
    got = found(spark, texts + clean, items)
    assert got == {(i, i): True for i in range(7)} | {(8, 4): True, (9, 5): True}


def test_a_junk_item_is_told_but_empties_no_corpus(spark):
    """`Yes` is found wherever it stands, and removes only the documents that say nothing else."""
    texts = [cases.prose(i, 40) + " yes " + cases.prose(i + 50, 40) for i in range(20)] + ["Yes.", "yes", "no", QUESTION]
    docs = cases.documents(spark, [(i, t, "en", "a", 0) for i, t in enumerate(texts)])
    benchmark = spark.createDataFrame([(1, "Yes"), (2, QUESTION)], "item_id long, text string")
    rows = decontamination.contaminated(docs, benchmark)
    assert {r["item_id"]: r["documents"] for r in decontamination.documents_per_item(rows).collect()} == {1: 22, 2: 1}
    kept = {r["doc_id"] for r in decontamination.decontaminate(docs, benchmark).collect()}
    assert kept == set(range(20)) | {22}
    strict = {r["doc_id"] for r in decontamination.decontaminate(docs, benchmark, least_words=1).collect()}
    assert strict == {22}
