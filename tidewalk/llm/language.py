"""Language identification: the mixture of languages of each document, by expectation-maximisation.

Character trigrams are counted per language over all labelled texts of the learning part. A document is a mixture:
its trigrams come from languages in unknown proportions, which expectation-maximisation estimates. Languages are
dropped from the mixture as long as that raises the likelihood less a penalty for every language (Schwarz's criterion).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewalk.llm.common import slices

BUCKETS = 1 << 14  # trigrams are hashed to so many
UNKNOWN = "und"
ROUNDS = 12  # of expectation-maximisation for one set of languages
SMOOTHING = 0.5
TEXTS = 64  # documents estimated together
LIVE = 1e-3  # a smaller share is no share


def trigrams(text: str) -> np.ndarray:
    """The buckets of a text's letter trigrams: lower case, a run of other characters counts as one space."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    letter = _letters(points)
    points = np.where(letter, points, 32)
    kept = letter.copy()
    kept[0] = True
    kept[1:] |= letter[:-1]
    points = points[kept]
    if len(points) < 3:
        return np.zeros(0, np.int64)
    mixed = points[:-2] * 0x9E3779B1 + points[1:-1] * 0x85EBCA77 + points[2:] * 0xC2B2AE3D
    return (mixed ^ (mixed >> 17)) % BUCKETS


_IS_LETTER = np.fromiter((chr(c).isalpha() for c in range(0x30000)), bool, 0x30000)


def _letters(points: np.ndarray) -> np.ndarray:
    return _IS_LETTER[np.minimum(points, 0x2FFFF)] | ((points >= 0x30000) & (points < 0x323B0))


@dataclass(frozen=True)
class Model:
    """Probabilities of the trigram buckets (rows) in the languages (columns), bounded by both numbers."""

    languages: tuple[str, ...]
    probability: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """The language with the largest share, and that share, of every text."""
        grams = [trigrams(t) if t else np.zeros(0, np.int64) for t in texts]
        rows = [i for i, g in enumerate(grams) if len(g)]
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if rows and self.languages:
            share = mixture([grams[i] for i in rows], self.probability)
            best = share.argmax(axis=1)
            for row, language, part in zip(rows, best.tolist(), share[np.arange(len(rows)), best].tolist(), strict=True):
                names[row], scores[row] = self.languages[language], min(1.0, part)
        return names, scores


def _estimate(doc, count, p, allowed, total):
    """Shares of the allowed languages, and the log-likelihood, of every document."""
    starts = np.flatnonzero(np.diff(doc, prepend=-1))
    share = allowed / allowed.sum(axis=1, keepdims=True)
    for _ in range(ROUNDS):
        weighted = p * share[doc]
        weighted *= (count / weighted.sum(axis=1))[:, None]
        share = np.add.reduceat(weighted, starts, axis=0) / total[:, None]
    likely = np.log((p * share[doc]).sum(axis=1)) * count
    return share, np.add.reduceat(likely, starts)


def mixture(grams: list[np.ndarray], probability: np.ndarray) -> np.ndarray:
    """Shares of the languages in every document (none empty), zero outside its selected set of languages."""
    docs, languages = len(grams), probability.shape[1]
    keys = np.concatenate([g + i * BUCKETS for i, g in enumerate(grams)])
    keys, count = np.unique(keys, return_counts=True)
    doc, p, count = keys // BUCKETS, probability[keys % BUCKETS], count.astype(float)
    total = np.bincount(doc, count, docs)
    allowed = np.ones((docs, languages))
    share, likely = _estimate(doc, count, p, allowed, total)
    penalty = 0.5 * np.log(total)
    open_ = np.arange(docs)
    while languages > 1 and len(open_):
        # leave out the smallest share, and all that vanished, of every document that has more than one language
        now = share[open_]
        inside = allowed[open_] > 0
        smallest = np.where(inside, now, np.inf).argmin(axis=1)
        less = inside & (now > LIVE)
        less[np.arange(len(open_)), smallest] = False
        some = less.any(axis=1)
        open_, less = open_[some], less[some].astype(float)
        if not len(open_):
            break
        place = np.full(docs, -1)
        place[open_] = np.arange(len(open_))
        part = place[doc] >= 0
        new_share, new_likely = _estimate(place[doc[part]], count[part], p[part], less, total[open_])
        dropped = (allowed[open_] > 0).sum(axis=1) - less.sum(axis=1)
        better = new_likely - likely[open_] + penalty[open_] * dropped > 0
        chosen = open_[better]
        allowed[chosen], share[chosen], likely[chosen] = less[better], new_share[better], new_likely[better]
        open_ = chosen
    return share


def learn(labelled: DataFrame) -> Model:
    """Count the trigrams of all texts by `lang`; rows with a null text or lang teach nothing.

    Tasks add their counts up before they send them: one row of `BUCKETS` numbers per task and language. The model has
    one column per language, so its size depends on neither the corpus nor its skew.
    """

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in slices(batches):
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                counted = np.bincount(trigrams(text), minlength=BUCKETS)
                sums[lang] = sums[lang] + counted if lang in sums else counted
        for lang, counted in sums.items():
            found = np.flatnonzero(counted)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * len(found), pa.string()), "bucket": found.astype(np.int32), "n": counted[found],
            })

    known = labelled.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    counts = known.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    rows = counts.toPandas()
    languages = tuple(sorted(rows["lang"].unique()))
    table = np.full((BUCKETS, len(languages)), SMOOTHING)
    at = {lang: i for i, lang in enumerate(languages)}
    table[rows["bucket"].to_numpy(int), rows["lang"].map(at).to_numpy(int)] += rows["n"].to_numpy(float)
    return Model(languages, table / table.sum(axis=0))


def held_out(documents: DataFrame) -> DataFrame:
    """Add held_out: whether crc32 of the id's digits leaves 2 modulo 4. A null id is not held out."""
    rest = F.crc32(F.col("doc_id").cast("string")) % 4
    return documents.withColumn("held_out", F.coalesce(rest == 2, F.lit(False)))


def identify(documents: DataFrame, model: Model, language: str = "lang_pred", share: str = "score") -> DataFrame:
    """The documents with the language that has the largest share in the text, and its share, in these two columns.

    `und`, with share 0, for a null text, for one without a letter and when nothing was learned. All columns of
    `documents` stay, but any of the two names are replaced.
    """
    names = [c for c in documents.columns if c not in (language, share)]

    def predict(batches):
        for batch in slices(batches, TEXTS):
            lang, score = model.predict(batch.column("text").to_pylist())
            columns = {c: batch.column(c) for c in names}
            columns |= {language: pa.array(lang, pa.string()), share: pa.array(score, pa.float64())}
            yield pa.RecordBatch.from_pydict(columns)

    schema = documents.select(*names).schema.add(language, "string").add(share, "double")
    return documents.select(*names).mapInArrow(predict, schema)
