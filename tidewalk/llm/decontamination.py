"""Benchmark decontamination by template canonicalisation, with DataFrame functions only.

A text becomes words without punctuation. Numbers, names (capitalised words inside a sentence) and units after a number
give place to typed placeholders, one word for one word, so a template's position is the text's. Windows of template
words are joined on their hash with those of the benchmark. A hit's slots must be consistent: over one alignment of an
item with a document, equal values in the item stand for equal values in the document. That finds an item with other
numbers or names as well as a literal copy.

Whether a capitalised word is a name depends on the words before it, so every window is made in three forms: with the
capitalised words inside a sentence as names, with all capitalised words as names (sentences that begin with one), and
without names, in lower case (copies in other case). A window meets windows of its own form only.

Items without a window that is long and plain enough (short ones, formulas, tables, lists of names, scripts without
spaces) are found as a whole by their words in lower case, where a letter of a script without spaces is a word.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewalk.llm.common import materialise

WINDOW = 8  # template words
LEAST_WORDS = 5  # shorter items are common phrases, found as a whole only
LEAST_LITERALS = 4  # words of a window that are no placeholders
LEAST_WINDOWS = 3  # consecutive or not, in one alignment; all windows of shorter items
INDEX_ROWS = 500_000  # benchmark windows broadcast at once, under 200 MB; a larger index is joined in such blocks
REMOVED_ROWS = 1_000_000  # keys broadcast at most to remove documents; more are joined by a shuffle

MARK = "\ue000"  # a private-use character
NAME, NUMBER, UNIT = "<name>", "<number>", "<unit>"
INSIDE, ALL, NONE = FORMS = range(3)  # which capitalised words are names
# Units that may follow a number.
UNITS = (
    "mm cm m km in inch inches ft foot feet yard yards mile miles mg g gram grams kg kilogram kilograms ton tons oz "
    "ounce ounces lb lbs pound pounds ml l liter liters litre litres gallon gallons second seconds minute minutes min "
    "hour hours h day days week weeks month months year years percent dollar dollars usd euro euros eur cent cents "
    "degree degrees mph kmh kph joule joules watt watts volt volts hz khz mhz ghz kb mb gb tb byte bytes people items"
).split()


# Letters of scripts without spaces, and the marks that Japanese writes among them.
UNSPACED = "".join(rf"\p{{Is{s}}}" for s in "Han Hiragana Katakana Thai Lao Khmer Myanmar".split()) + "ー々"
LETTER = r"a-zA-Z0-9\p{L}\p{N}"  # the plain ranges first: they are tested faster


def words(text: Column) -> Column:
    """The text's words as one string between single spaces; a name has `MARK` before it. Null becomes empty."""
    named = F.regexp_replace(F.coalesce(text, F.lit("")), r"(\p{Lu}(?<=\p{Ll},? .)\p{Ll}+)", MARK + "$1")
    # a run of other characters, unless it is one point or comma between two digits
    apart = rf"[^{LETTER}{MARK}]++(?:(?<!\p{{N}}[.,])|(?!\p{{N}}))"
    return F.trim(F.regexp_replace(named, apart, " "))


def template(worded: Column) -> Column:
    """The same number of words, with placeholders."""
    named = F.lower(F.regexp_replace(worded, MARK + "[^ ]++", NAME))
    numbered = F.regexp_replace(named, r"\p{N}(?<=(?:^| ).)[\p{N}.,]*+(?= |$)", NUMBER)
    return F.regexp_replace(numbered, rf"(?<=<number> )(?:{'|'.join(UNITS)})(?= |$)", UNIT)


def plain(word: Column) -> Column:
    return F.lower(F.replace(word, F.lit(MARK), F.lit("")))


def in_forms(raw: Column | str, tmpl: Column | str, name, unit, other) -> list[Column]:
    """The template words, or what stands for them, in all forms, from the words and those of the form `INSIDE`."""
    capital = rf"^{MARK}?\p{{Lu}}\p{{Ll}}"
    return [
        F.col(tmpl) if isinstance(tmpl, str) else tmpl,
        F.zip_with(raw, tmpl, lambda r, t: F.when(r.rlike(capital) & (t != unit), name).otherwise(t)),
        F.zip_with(raw, tmpl, lambda r, t: F.when(t == name, other(plain(r))).otherwise(t)),
    ]


def exact_words(text: Column) -> Column:
    """The text's words in lower case, as an array; letters of scripts without spaces stand alone."""
    apart = F.regexp_replace(plain(words(text)), f"([{UNSPACED}])", " $1 ")
    return F.split(F.trim(F.regexp_replace(apart, "  +", " ")), " ")


def _template_in(form: Column, raw: Column, tmpl: Column) -> Column:
    forms = in_forms(raw, tmpl, F.lit(NAME), F.lit(UNIT), lambda w: w)
    return F.when(form == INSIDE, forms[INSIDE]).when(form == ALL, forms[ALL]).otherwise(forms[NONE])


def _hash(hashes: str, at: Column | int, length: int, *form: Column) -> Column:
    """The hash of the window of `length` words at a position from 0, from the words' hashes."""
    return F.xxhash64(*form, *(F.get(hashes, at + k) for k in range(length)))


def _once(benchmark: DataFrame) -> DataFrame:
    """text, item (its checksum) and item_id of every different item."""
    once = benchmark.groupBy(F.col("text").cast("string").alias("text")).agg(F.min("item_id").alias("item_id"))
    return once.withColumn("item", F.sha2("text", 256))


def _split(frame: DataFrame, *keys: str) -> DataFrame:
    """raw and tmpl, the words and the template words, and the latter's hashes in all forms, one form after the other."""
    worded = frame.select(*keys, words(F.col("text").cast("string")).alias("worded"))
    split = worded.select(*keys, F.split("worded", " ").alias("raw"), F.split(template(F.col("worded")), " ").alias("tmpl"))
    inside = split.withColumn("inside", F.transform("tmpl", lambda w: F.xxhash64(w)))
    forms = in_forms("raw", "inside", F.xxhash64(F.lit(NAME)), F.xxhash64(F.lit(UNIT)), F.xxhash64)
    return inside.withColumn("hashes", F.concat(*forms)).drop("inside")


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """One row per window of every different item and form: item_id (the smallest of equal items), its windows in the
    form, place, template.

    Items shorter than `LEAST_WORDS` and windows of fewer than `LEAST_LITERALS` plain words are left out (`left_out`
    has items without a window); an item shorter than the window is one window. Null texts have no words.
    """
    items = _split(_once(benchmark), "item", "item_id").where(F.size("tmpl") >= LEAST_WORDS)
    items = items.withColumn("length", F.least(F.size("tmpl"), F.lit(WINDOW)))
    placed = items.withColumn("item_at", F.explode(F.expr("sequence(1, size(tmpl) - length + 1)")))
    placed = placed.withColumn("form", F.explode(F.array(*map(F.lit, FORMS))))
    place = F.col("form") * F.size("tmpl") + F.col("item_at") - 1
    hashed = F.coalesce(*(
        F.when(F.col("length") == n, _hash("hashes", place, n, F.col("form"))) for n in range(LEAST_WORDS, WINDOW + 1)
    ))
    tmpl, raw = F.expr("slice(tmpl, item_at, length)"), F.expr("slice(raw, item_at, length)")
    cut = placed.select(
        "item", "item_id", "length", "form", "item_at", _template_in(F.col("form"), raw, tmpl).alias("item_tmpl"),
        raw.alias("item_raw"), hashed.alias("h"),
    )
    literals = F.size(F.filter("item_tmpl", lambda w: ~w.isin(NAME, NUMBER, UNIT)))
    kept = cut.where(literals >= LEAST_LITERALS)
    count = kept.groupBy("item", "form").agg(F.count(F.lit(1)).alias("item_windows"))
    return kept.join(count, ["item", "form"])


def left_out(benchmark: DataFrame, index: DataFrame) -> DataFrame:
    """item_id, item_words, length and hash of the first window of every different item that the index has no window of.

    Items without any word (nothing but signs) are not there.
    """
    rest = _once(benchmark).join(index.select("item").distinct(), "item", "left_anti").where("text IS NOT NULL")
    items = rest.select("item_id", exact_words(F.col("text")).alias("item_words")).where(F.get("item_words", F.lit(0)) != "")
    items = items.withColumn("length", F.least(F.size("item_words"), F.lit(WINDOW)))
    items = items.withColumn("hashes", F.transform("item_words", lambda w: F.xxhash64(w)))
    hashed = F.coalesce(*(F.when(F.col("length") == n, _hash("hashes", F.lit(0), n)) for n in range(1, WINDOW + 1)))
    return items.withColumn("h", hashed).drop("hashes")


def exact_matches(documents: DataFrame, items: DataFrame) -> list[DataFrame]:
    """The rows of `matches` for items that are found as a whole: one window of one, literal."""
    lengths = [r["length"] for r in items.select("length").distinct().collect()]  # at most WINDOW different ones
    n_words = items.agg(F.sum(F.size("item_words"))).first()[0] or 0
    blocks = max(1, -(-n_words // (INDEX_ROWS * WINDOW)))
    docs = documents.select("doc_id", key_of(documents).alias("key"), exact_words(F.col("text").cast("string")).alias("raw"))
    docs = docs.withColumn("hashes", F.transform("raw", lambda w: F.xxhash64(w)))
    found = []
    for length in lengths:
        each = docs.select("*", F.posexplode_outer("hashes").alias("at", "word"))
        each = each.where(F.col("at") + length <= F.size("hashes"))
        at = each.withColumn("h", _hash("hashes", F.col("at"), length))
        for block in range(blocks):
            chosen = F.pmod(F.xxhash64("item_id", "item_words"), F.lit(blocks)) == block
            hit = at.join(F.broadcast(items.where((F.col("length") == length) & chosen)), "h")
            whole = hit.where(F.slice("raw", F.col("at") + 1, F.size("item_words")) == F.col("item_words"))
            found.append(whole.select(
                "doc_id", "key", "item_id", F.lit(1).alias("windows"), F.lit(1).cast("long").alias("item_windows"),
                F.lit(True).alias("literal"), F.size("item_words").alias("item_words"),
                (F.size("raw") == F.size("item_words")).alias("whole_text"),
            ))
    return found


def key_of(documents: DataFrame) -> Column:
    return F.xxhash64(documents["doc_id"], documents["text"].cast("string"))


def matches(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, key, item_id, windows, item_windows, literal, item_words, whole_text) of every document and item that
    match.

    `key` is a hash of the row's id and text. `windows` counts the item's windows found in the best consistent
    alignment, `literal` tells that no slot differs there. `item_words` is the item's length as far as `LEAST_WORDS`,
    or beyond for items found as a whole; `whole_text` tells that such an item is all that the document says. Rows
    without words match nothing.
    """
    index = materialise(benchmark_windows(benchmark), "benchmark-windows")
    whole = exact_matches(documents, materialise(left_out(benchmark, index), "benchmark-left-out"))
    rows = index.count()
    lengths = [r["length"] for r in index.select("length").distinct().collect()]  # at most WINDOW different ones
    docs = _split(documents.withColumn("key", key_of(documents)), "doc_id", "key")
    blocks = max(1, -(-rows // INDEX_ROWS))
    found = []
    for length in lengths:
        # The windows are made, hashed and joined in one generated loop that copies no array of a document. The outer
        # form keeps Spark from testing the array's size below, where it would make all words a second time.
        each = docs.select("*", F.posexplode_outer("hashes").alias("place", "word"))
        each = each.withColumn("at", F.col("place") % F.size("raw")).where(F.col("at") + length <= F.size("raw"))
        form = F.floor(F.col("place") / F.size("raw")).cast("int")
        at = each.withColumn("h", _hash("hashes", F.col("place"), length, form))
        for block in range(blocks):
            chosen = F.pmod(F.xxhash64("item_id", "item_at", "form"), F.lit(blocks)) == block
            part = index.where((F.col("length") == length) & chosen)
            hit = at.join(F.broadcast(part), "h")
            found.append(hit.select(
                "doc_id", "key", "item_id", "item_windows", "form", "item_at", "item_tmpl", "item_raw",
                (F.col("at") + 1 - F.col("item_at")).alias("shift"),
                F.slice("tmpl", F.col("at") + 1, F.lit(length)).alias("doc_tmpl"),
                F.slice("raw", F.col("at") + 1, F.lit(length)).alias("doc_raw"),
            ))
    if not found and not whole:
        return documents.sparkSession.createDataFrame(
            [], f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, key long, item_id long, item_windows long, "
                "windows int, literal boolean, item_words int, whole_text boolean"
        )
    every = whole if not found else [*whole, _consistent(reduce(DataFrame.unionByName, found))]
    return reduce(DataFrame.unionByName, every).groupBy("doc_id", "key", "item_id").agg(
        F.max("windows").alias("windows"), F.max("item_windows").alias("item_windows"), F.max("literal").alias("literal"),
        F.max("item_words").alias("item_words"), F.max("whole_text").alias("whole_text"),
    )


def _consistent(hits: DataFrame) -> DataFrame:
    """The rows of `matches`, one per alignment of enough windows with consistent slots."""
    hits = hits.withColumn("doc_tmpl", _template_in(F.col("form"), F.col("doc_raw"), F.col("doc_tmpl")))
    # At most one window for every place of the item in every form.
    aligned = hits.groupBy("doc_id", "key", "item_id", "item_windows", "form", "shift").agg(
        F.collect_set(F.struct("item_at", "item_tmpl", "item_raw", "doc_tmpl", "doc_raw")).alias("found")
    )
    aligned = aligned.withColumn("found", F.filter("found", lambda f: f["item_tmpl"] == f["doc_tmpl"]))
    slots = F.expr(
        "array_distinct(flatten(transform(found, f -> filter(zip_with(zip_with(f.item_tmpl, f.item_raw, "
        f"(t, i) -> struct(t, lower(replace(i, '{MARK}', '')) AS item)), f.doc_raw, "
        f"(s, d) -> struct(s.t AS t, s.item AS item, lower(replace(d, '{MARK}', '')) AS doc)), "
        f"s -> s.t IN ('{NAME}', '{NUMBER}', '{UNIT}')))))"
    )
    aligned = aligned.select("doc_id", "key", "item_id", "item_windows", F.size("found").alias("windows"), slots.alias("slots"))
    consistent = F.size("slots") == F.size(F.array_distinct(F.transform("slots", lambda s: F.struct(s["t"], s["item"]))))
    enough = F.col("windows") >= F.least(F.lit(LEAST_WINDOWS), F.col("item_windows"))
    literal = ~F.exists("slots", lambda s: s["item"] != s["doc"])
    best = aligned.where(consistent & enough).withColumn("literal", literal)
    return best.select(
        "doc_id", "key", "item_id", "windows", "item_windows", "literal", F.lit(LEAST_WORDS).alias("item_words"),
        F.lit(False).alias("whole_text"),
    )


def contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, windows, item_windows, literal, item_words, whole_text): the documents that hold items, once per
    item.

    Items of any length are searched, and all hits are told. Items with equal texts are one, with the smallest id; rows
    that repeat a doc_id are joined in one row. Null and empty texts, null items and empty tables give no rows, a null
    doc_id is told like others; texts of any length are searched whole, and other columns are not looked at.
    """
    found = matches(documents, benchmark)
    return found.groupBy("doc_id", "item_id").agg(
        F.max("windows").alias("windows"), F.max("item_windows").alias("item_windows"), F.max("literal").alias("literal"),
        F.max("item_words").alias("item_words"), F.max("whole_text").alias("whole_text"),
    )


def documents_per_item(found: DataFrame) -> DataFrame:
    """(item_id, documents) of the rows of `contaminated`: an item that hits very many is no question but a phrase."""
    return found.groupBy("item_id").agg(F.count(F.lit(1)).alias("documents"))


def decontaminate(documents: DataFrame, benchmark: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """The documents that hold no item, but for items below `least_words` words: a document goes for such an item only
    if that is all it says, since a word or two in a long text are no sign of the benchmark."""
    leaks = (F.col("item_words") >= least_words) | F.col("whole_text")
    keys = matches(documents, benchmark).where(leaks).select(F.col("key").alias("__key"), F.col("doc_id").alias("__doc")).distinct()
    found = materialise(keys, "contaminated")
    removed = F.broadcast(found) if found.count() <= REMOVED_ROWS else found
    keyed = documents.withColumn("__own", key_of(documents))
    same = (F.col("__own") == F.col("__key")) & F.col("doc_id").eqNullSafe(F.col("__doc"))
    return keyed.join(removed, same, "left_anti").drop("__own")
