"""URL filters: rules, and gradient-boosted trees on lexical features for what no rule fits.

DataFrame functions and Spark ML only. The trees learn from labelled URLs: length, depth, digit ratio, entropy of the
characters, parameter counts, and how often the URL's suffixes (last host label, last two, file ending, first path
segment) were blocked among the labelled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewalk.llm.common import lower_ascii, materialise

ALLOW, BLOCK = "allow", "block"
TRAINING_URLS = 50_000  # different labelled URLs that the trees learn from, chosen by hash; the statistics count all
SUFFIXES_BROADCAST = 200_000  # suffixes of a statistics table sent to every task; more are joined by a shuffle
PARTS = 5  # of the labelled URLs; a URL learns from the suffix shares of the parts it is not in
SMOOTHING = 4.0  # URLs of average label added to every suffix
TREES, DEPTH, STEP, SEED = 20, 4, 0.3, 7


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    def __str__(self) -> str:
        return self.host + self.path


def rule(verdict: str, written: str) -> Rule:
    """A rule from its written form: a host and the start of a path."""
    host, slash, rest = written.partition("/")
    return Rule(verdict, host, slash + rest)


def with_parts(frame: DataFrame) -> DataFrame:
    """Add host and path of `url`: both empty if it is null or has no `://`."""
    rest = F.coalesce(F.regexp_extract("url", r"(?s)^.*?://(.*)$", 1), F.lit(""))
    parted = frame.withColumn("_rest", rest)
    host = lower_ascii(F.regexp_extract("_rest", r"^[^/?#]*", 0))
    return parted.withColumn("host", host).withColumn("path", F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1)).drop("_rest")


def fits(r: Rule) -> Column:
    """Whether the rule's host or a subdomain of it is the URL's, and its path starts with the rule's."""
    same = (F.col("host") == r.host) | F.endswith(F.col("host"), F.lit("." + r.host))
    return same & F.startswith(F.col("path"), F.lit(r.path))


def by_rules(rules: list[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits, as written, and its verdict; null if none fits."""
    written, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(str(r))):  # the longest is asked first
        written = F.when(fits(r), str(r)).otherwise(written)
        verdict = F.when(fits(r), r.verdict).otherwise(verdict)
    return written, verdict


# Suffixes whose statistics are features.
SUFFIXES = {
    "tld": r"^.*?([^.]*)$", "domain": r"^.*?([^.]*\.[^.]*)$",
    "ending": r"^.*/[^/]*?(\.[A-Za-z0-9]{1,8})$", "segment": r"^/([^/]*)",
}
PLAIN = [
    "n_url", "n_host", "n_path", "n_query", "depth", "labels", "digits", "host_digits", "hyphens", "entropy",
    "parameters", "fragment",
]


def _count(text: str, characters: str) -> Column:
    """How often the class of characters occurs in the column."""
    return F.length(F.col(text)) - F.length(F.regexp_replace(text, characters, ""))


def with_features(frame: DataFrame) -> DataFrame:
    """Add the lexical features of url, host and path, and the suffixes in `of_` columns."""
    frame = frame.withColumn("_url", F.coalesce("url", F.lit("")))
    query = F.regexp_extract("_url", r"(?s)^[^?#]*\?([^#]*)", 1)
    frame = frame.withColumn("_query", query).withColumn("n_url", F.length("_url").cast("double"))
    count = F.transform(
        F.array_distinct(F.split("_url", "")), lambda c: F.length("_url") - F.length(F.replace(F.col("_url"), c, F.lit("")))
    )
    share = F.transform(count, lambda n: n / F.col("n_url"))
    entropy = F.aggregate(share, F.lit(0.0), lambda sum_, p: sum_ - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    longest = F.greatest(F.col("n_url"), F.lit(1.0))
    columns = {
        "n_host": F.length("host"), "n_path": F.length("path"), "n_query": F.length("_query"),
        "depth": _count("path", "/"), "labels": _count("host", r"\."), "digits": _count("_url", "[0-9]") / longest,
        "host_digits": _count("host", "[0-9]"), "hyphens": _count("host", "-"),
        "entropy": F.when(F.col("n_url") > 0, entropy).otherwise(0.0),
        "parameters": F.when(F.length("_query") > 0, _count("_query", "&") + 1).otherwise(0),
        "fragment": F.col("_url").contains("#").cast("int"),
    }
    suffixes = {
        f"of_{name}": F.regexp_extract("path" if name in ("ending", "segment") else "host", pattern, 1)
        for name, pattern in SUFFIXES.items()
    }
    columns = {name: column.cast("double") for name, column in columns.items()} | suffixes
    return frame.withColumns(columns).drop("_url", "_query")


@dataclass(frozen=True)
class Model:
    """Trees, the blocked share of every suffix of the labelled URLs, and that of all; no trees if one verdict is all."""

    trees: GBTClassificationModel | None
    statistics: dict[str, DataFrame]
    blocked: float


def _with_statistics(frame: DataFrame, statistics: dict[str, DataFrame], blocked: float, *keys: str) -> DataFrame:
    for name, table in statistics.items():
        small = table.count() <= SUFFIXES_BROADCAST
        frame = frame.join(F.broadcast(table) if small else table, [f"of_{name}", *keys], "left")
    return frame.fillna(blocked, [f"rate_{name}" for name in statistics])


def _assembled(frame: DataFrame, statistics: dict[str, DataFrame]) -> DataFrame:
    inputs = PLAIN + [f"rate_{name}" for name in statistics]
    return VectorAssembler(inputCols=inputs, outputCol="_features").transform(frame)


def train(labelled: DataFrame) -> Model:
    """Fit the trees to labelled URLs (url, label 1 for block); null URLs and labels teach nothing.

    Each URL counts once, with its mean label. The suffixes' shares are of all URLs; of more than `TRAINING_URLS` URLs the
    trees learn from those with the smallest hashes, that many in expectation. A URL that teaches the trees has the
    shares of the other `PARTS` that hashes deal all URLs to, so its own label is in none of its features. Without
    labelled URLs everything is allowed.
    """
    once = labelled.where("url IS NOT NULL AND label IS NOT NULL").groupBy("url").agg(
        (F.avg("label") >= 0.5).cast("double").alias("label")
    )
    once = materialise(once, "labelled-urls")
    count = once.count()
    span = 1 << 40
    chosen = once.where(F.pmod(F.xxhash64("url"), F.lit(span)) < F.lit(span * min(1.0, TRAINING_URLS / max(1, count))))
    blocked = (once.agg(F.sum("label")).first()[0] or 0.0) / max(1, count)
    if blocked in (0.0, 1.0):
        return Model(None, {}, blocked)
    part = F.pmod(F.xxhash64(F.lit("part"), "url"), F.lit(PARTS)).cast("int").alias("_part")
    featured = materialise(with_features(with_parts(chosen)).select("*", part), "url-features")
    suffixes = with_features(with_parts(once)).select("label", part, *(f"of_{name}" for name in SUFFIXES))
    statistics, of_others = {}, {}
    for name in SUFFIXES:
        of = f"of_{name}"
        sums = materialise(
            suffixes.groupBy(of, "_part").agg(F.sum("label").alias("_s"), F.count(F.lit(1)).alias("_n")), "url-suffixes"
        )
        whole = sums.groupBy(of).agg(F.sum("_s").alias("_all_s"), F.sum("_n").alias("_all_n"))
        rate = ((F.col("_all_s") + SMOOTHING * blocked) / (F.col("_all_n") + SMOOTHING)).alias(f"rate_{name}")
        statistics[name] = materialise(whole.select(of, rate), "url-suffixes")
        rest_s, rest_n = F.col("_all_s") - F.col("_s"), F.col("_all_n") - F.col("_n")
        rate = ((rest_s + SMOOTHING * blocked) / (rest_n + SMOOTHING)).alias(f"rate_{name}")
        of_others[name] = materialise(sums.join(whole, of).select(of, "_part", rate), "url-suffixes")
    rows = _assembled(_with_statistics(featured, of_others, blocked, "_part"), statistics)
    trees = GBTClassifier(
        featuresCol="_features", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=SEED
    ).fit(rows.select("_features", "label"))
    return Model(trees, statistics, blocked)


def predict(urls: DataFrame, model: Model) -> DataFrame:
    """Add `verdict` to rows with url, host and path."""
    if model.trees is None:
        return urls.withColumn("verdict", F.lit(BLOCK if model.blocked == 1.0 else ALLOW))
    rows = _assembled(_with_statistics(with_features(urls), model.statistics, model.blocked), model.statistics)
    found = model.trees.transform(rows)
    verdict = F.when(F.col("prediction") == 1.0, BLOCK).otherwise(ALLOW)
    return found.withColumn("verdict", verdict).select(*urls.columns, "verdict")


def judge(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """page_id, host, path, rule and verdict of every page: the verdict of the longest rule that fits, else the trees'.

    The URLs that rules judge are the labelled ones. A null URL has an empty host and path and fits no rule. Repeated
    rows stay, other columns are not read. An empty table gives none.
    """
    written, verdict = by_rules(rules)
    parted = with_parts(pages.select("page_id", F.col("url").cast("string").alias("url")))
    ruled = parted.withColumn("rule", written).withColumn("ruled", verdict)
    model = train(ruled.where("ruled IS NOT NULL").select("url", (F.col("ruled") == BLOCK).cast("int").alias("label")))
    judged = predict(ruled, model)
    return judged.select("page_id", "host", "path", "rule", F.coalesce("ruled", "verdict").alias("verdict"))
