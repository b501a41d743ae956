"""How filters interact: what each removes in every order, alone and on top of the others.

A document counts only through its mask, the set of filters that it fails, so a part of the corpus is at most 2^5 cells
of (mask, documents, good ones, toxic ones). Each cell is folded across the array of all 120 orders with higher-order
functions into 600 structs, weighted by the cell's counts, and the cells of a part are merged element by element.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# White space between words, capitals and marks of the filters.
SPACE, NO_CAPITALS, MARKS = r"[\x20\x09-\x0D]+", r"[^A-Z]+", r"[#$%&*|]"
DUPLICATE = "E"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def text_failures(text: Column) -> dict[str, Column]:
    """The failure conditions that a text decides by itself, by filter letter."""
    words = F.array_remove(F.split(text, SPACE), "")
    capitals = F.length(F.regexp_replace(text, NO_CAPITALS, ""))
    return {
        "A": F.size(words) < 100,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 80,
        "C": capitals * 100 > F.length(text) * 10,
        "D": text.rlike(MARKS),
    }


def _mask(failures: Mapping[str, Column], letters: str) -> Column:
    bits = [F.when(failed, 1 << letters.index(letter)).otherwise(0) for letter, failed in failures.items()]
    return reduce(Column.bitwiseOR, bits).cast("int")


def _labelled(labels: DataFrame) -> DataFrame:
    """One row per labelled document: whether a row calls it good, and toxic."""
    return labels.groupBy(F.col("doc_id").cast("long").alias("_doc")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("_good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("_toxic"),
    )


def cells(documents: DataFrame, labels: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """(part, mask, n, good, toxic): documents of every language by the set of filters that they fail.

    A text's copies are brought together by its SHA-256, aggregated map-side by (text, part, labels), so a text that a
    third of all rows share is a few rows in the shuffle; the copy with the smallest doc_id is told from the others by
    the minimum over these rows.
    """
    text = F.coalesce("text", F.lit(""))
    judged = documents.select(
        F.col("doc_id").cast("long").alias("_doc"), F.coalesce("lang", F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("_text"), _mask(text_failures(text), letters).alias("_mask"),
    )
    # rows of one document first: they share its place among the copies
    told = judged.join(_labelled(labels), "_doc", "left").na.fill(False, ["_good", "_toxic"])
    rows = told.groupBy("_doc", "_text", "_mask", "part", "_good", "_toxic").agg(F.count(F.lit(1)).alias("_n"))
    known = F.col("_doc").isNotNull()
    groups = rows.groupBy("_text", "_mask", "part", "_good", "_toxic").agg(
        F.sum("_n").alias("_all"), F.sum(F.when(~known, F.col("_n")).otherwise(0)).alias("_unnumbered"),
        F.min(F.when(known, F.struct("_doc", "_n"))).alias("_least"),
    )
    first = F.min("_least._doc").over(Window.partitionBy("_text"))
    original = F.col("_unnumbered") + F.when(F.col("_least._doc") == first, F.col("_least._n")).otherwise(0)
    duplicate = 1 << letters.index(DUPLICATE)
    both = F.inline(F.array(
        F.struct(F.col("_mask").alias("mask"), F.col("_original").alias("n")),
        F.struct(F.col("_mask").bitwiseOR(F.lit(duplicate)).alias("mask"), (F.col("_all") - F.col("_original")).alias("n")),
    ))
    split = groups.withColumn("_original", original).select("part", "_good", "_toxic", both).where("n > 0")
    return split.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("_good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("_toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )


def _orders(letters: str) -> Column:
    """The array of all orders, each an array of filter bits: a constant of the plan."""
    bits = [[1 << letters.index(letter) for letter in order] for order in permutations(letters)]
    return F.array(*[F.array(*[F.lit(b) for b in order]) for order in bits])


def _fold(order: Column) -> Column:
    """One order's steps for a cell: the state is whether its documents are still there, and the steps so far."""
    mask = F.col("mask")
    zero = F.lit(0).cast("long")

    def counted(condition: Column, weight: str) -> Column:
        return F.when(condition, F.col(weight)).otherwise(zero)

    def step(state: Column, bit: Column) -> Column:
        there, fails = state["there"], mask.bitwiseAND(bit) != 0
        done = F.struct(
            bit.alias("bit"), counted(there & ~fails, "n").alias("kept"), counted(there & fails, "n").alias("removed"),
            counted(~there & fails, "n").alias("redundant"), counted(mask == bit, "n").alias("unique_fails"),
            counted(there & fails, "good").alias("good_lost"), counted(there & fails, "toxic").alias("toxic_lost"),
        )
        return F.struct((there & ~fails).alias("there"), F.concat(state["steps"], F.array(done)).alias("steps"))

    fields = ", ".join(f"{name}: bigint" for name in COUNTS)
    nothing = F.array().cast(f"array<struct<bit: int, {fields}>>")
    start = F.struct(F.lit(True).alias("there"), nothing.alias("steps"))
    return F.aggregate(order, start, step, lambda state: state["steps"])


def _merged(folds: Column) -> Column:
    """Arrays of structs added element by element."""
    def add(a: Column, b: Column) -> Column:
        return F.struct(a["bit"].alias("bit"), *[(a[name] + b[name]).alias(name) for name in COUNTS])

    return F.aggregate(F.slice(folds, 2, F.size(folds)), folds[0], lambda so_far, one: F.zip_with(so_far, one, add))


def audit(documents: DataFrame, labels: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """Per part, order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    `documents` has doc_id, text and lang, `labels` doc_id, quality and toxic; other columns are not looked at. A null
    text is empty, and equal to empty texts; a null language is the part of the empty string. Rows that repeat a doc_id
    count one by one, and none of them is a copy of the other; a null doc_id is smaller than none and none is smaller
    than it, so such rows are no copies. Of several label rows of a document any may call it good or toxic; labels of
    null or unknown ids count for nothing. Texts of any length are judged whole. No documents give no rows. What is
    gathered for a part are its cells, at most 2^5 arrays of 600 structs.
    """
    folded = cells(documents, labels, letters).select("part", F.transform(_orders(letters), _fold).alias("steps"))
    merged = folded.select("part", F.flatten("steps").alias("steps")).groupBy("part").agg(
        _merged(F.collect_list("steps")).alias("steps")
    )
    def removals(bit: int) -> Column:
        """What a filter removes over all orders, at any step."""
        return F.aggregate(
            "steps", F.lit(0).cast("long"), lambda so_far, s: so_far + F.when(s["bit"] == bit, s["removed"]).otherwise(0)
        )

    values = [removals(1 << i) for i in range(len(letters))]
    names = F.array(*[F.lit("".join(order)) for order in permutations(letters)])
    return (
        merged.select("part", F.array(*values).alias("values"), F.posexplode("steps").alias("at", "done"))
        .withColumn("step", F.expr(f"at % {len(letters)} + 1").cast("int"))
        .withColumn("filter_order", F.element_at(names, F.expr(f"int(at div {len(letters)}) + 1")))
        .select(
            "part", "filter_order", "step", *[F.col(f"done.{name}").alias(name) for name in COUNTS],
            F.element_at("values", F.instr(F.lit(letters), F.substring("filter_order", F.col("step"), F.lit(1)))).alias("shapley"),
        )
    )
