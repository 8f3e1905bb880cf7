"""Language identification with string kernels.

A text is the set of its character n-grams of one to three characters (blended spectrum,
presence only), lower-cased.  The kernel of two texts is the size of the intersection over
the geometric mean of the sizes.  Landmark texts of each language give the Nystroem
features, ridge regression fits one score per language on them, one against the rest, and
the language with the highest score is predicted.

Kernel against landmarks, Nystroem map and ridge weights are linear in the presence
vector, so they are multiplied out once into a table (n-gram x language); a batch of
texts is scored by one sparse product with it.

Training takes ``per_language`` labelled rows of each language, chosen by hash: a bounded
sample, fitted on the driver.  Prediction reads every whole text.

Null texts and texts without a letter are ``und`` with score 0; so is everything when
there is nothing to learn from.  Labels of null or from held-out rows are never used.
Repeated rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatprep.llm.common import broadcast_if_small, is_held_out, read_table, seeded_hash

UNKNOWN = "und"
PER_LANGUAGE = 300
LANDMARKS = 32
RIDGE = 1e-2
BATCH = 256
FLOOR_TEXTS = 20  # labelled texts of a size that give it a floor
FLOOR_SHARE = 0.1


def spectrum(text: str) -> np.ndarray:
    """Sorted distinct n-grams of 1 to 3 characters, 21 bits a character."""
    chars = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) + 1
    if len(chars) < 3:
        pairs = (chars[:-1] << 21) | chars[1:]
        return np.unique(np.concatenate((chars, pairs)))
    triples = np.unique((chars[:-2] << 42) | (chars[1:-1] << 21) | chars[2:])
    tail = (chars[-2] << 21) | chars[-1]
    pairs = np.unique(np.append(triples >> 21, tail))
    single = np.unique(np.append(pairs >> 21, chars[-1]))
    return np.concatenate((single, pairs, triples))


@dataclass
class LanguageModel:
    languages: list[str]
    grams: np.ndarray  # sorted n-grams of the landmarks
    weights: np.ndarray  # n-gram x language
    base: np.ndarray  # score of a text without any known n-gram

    def scores(self, spectra: list[np.ndarray]) -> np.ndarray:
        """Texts x languages; no spectrum is empty."""
        sizes = np.array([len(s) for s in spectra])
        grams = np.concatenate(spectra)
        spots = np.searchsorted(self.grams, grams)
        spots[spots == len(self.grams)] = 0
        rows = np.where((self.grams[spots] == grams)[:, None], self.weights[spots], 0.0)
        sums = np.add.reduceat(rows, np.concatenate(([0], np.cumsum(sizes)[:-1])), axis=0)
        return sums / np.sqrt(sizes)[:, None] + self.base


def fit(labelled: list[tuple[str, str]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> LanguageModel | None:
    """From (language, text) rows; the first ``landmarks`` of each language are landmarks."""
    rows = [(lang, spectrum(text)) for lang, text in labelled if text]
    if not rows:
        return None
    languages = sorted({lang for lang, _ in rows})
    chosen = [s for lang in languages for s in [s for l, s in rows if l == lang][:landmarks]]
    grams = np.unique(np.concatenate(chosen))
    held = np.zeros((len(grams), len(chosen)), np.float64)  # n-gram x landmark, scaled by its size
    for k, s in enumerate(chosen):
        held[np.searchsorted(grams, s), k] = 1 / np.sqrt(len(s))

    def kernel(spectra):
        out = np.empty((len(spectra), len(chosen)))
        for i, s in enumerate(spectra):
            known = s[np.isin(s, grams, assume_unique=True)]
            out[i] = held[np.searchsorted(grams, known)].sum(axis=0) / np.sqrt(len(s))
        return out

    values, vectors = np.linalg.eigh(kernel(chosen))
    keep = values > 1e-6 * values.max()
    nystroem = vectors[:, keep] / np.sqrt(values[keep])
    z = kernel([s for _, s in rows]) @ nystroem
    y = np.array([[1.0 if lang == c else -1.0 for c in languages] for lang, _ in rows])
    counts = {c: sum(lang == c for lang, _ in rows) for c in languages}
    weight = np.array([1 / counts[lang] for lang, _ in rows])[:, None] / len(languages)
    middle, level = (z * weight).sum(axis=0), (y * weight).sum(axis=0)
    zc, yc = z - middle, y - level
    w = np.linalg.solve((zc * weight).T @ zc + ridge / len(rows) * np.eye(z.shape[1]), (zc * weight).T @ yc)
    return LanguageModel(languages, grams, held @ (nystroem @ w), level - middle @ w)


def labelled_sample(docs: DataFrame, label: Column, per_language: int = PER_LANGUAGE) -> list[tuple[str, str]]:
    """(language, text) of up to ``per_language`` rows of each label; rows with a null label are left out."""
    drawn = docs.select("doc_id", label.alias("lang"), seeded_hash(5, F.col("doc_id")).alias("draw"), F.xxhash64("text").alias("digest"))
    drawn = drawn.filter("lang IS NOT NULL AND doc_id IS NOT NULL")
    # Of each language only draws low enough for a few times the sample are ranked, so that
    # a common language is no large task.
    counts = drawn.groupBy("lang").agg((F.lit(4.0 * per_language * (1 << 52)) / F.count(F.lit(1))).alias("ceiling"))
    drawn = drawn.join(broadcast_if_small(counts), "lang").filter("draw <= ceiling").drop("ceiling")
    first = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "digest"))
    sample = (
        drawn.withColumn("nth", first)
        .filter(F.col("nth") <= per_language)
        .drop("draw")
    )
    texts = docs.select("doc_id", F.xxhash64("text").alias("digest"), "text").filter("text IS NOT NULL")
    rows = texts.join(F.broadcast(sample), ["doc_id", "digest"]).select("lang", "nth", "text").distinct()
    return [(r["lang"], r["text"]) for r in sorted(rows.collect(), key=lambda r: (r["lang"], r["nth"]))]


def train(docs: DataFrame, label: Column, per_language: int = PER_LANGUAGE) -> LanguageModel | None:
    """Fit on the labelled sample."""
    return fit(labelled_sample(docs, label, per_language))


def predictor(model: LanguageModel | None):
    """A column function of the text: struct of lang_pred and score."""

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in batches:
            texts = series.to_numpy(dtype=object)
            lang, score = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
            known = [i for i, t in enumerate(texts) if model and isinstance(t, str) and any(map(str.isalpha, t))]
            for at in range(0, len(known), BATCH):
                part = known[at : at + BATCH]
                found = model.scores([spectrum(texts[i]) for i in part])
                best = found.argmax(axis=1)
                lang[part] = np.array(model.languages, object)[best]
                score[part] = np.clip((found[np.arange(len(part)), best] + 1) / 2, 0, 1)
            yield pd.DataFrame({"lang_pred": lang, "score": score})

    return predict


def best_scores(model: LanguageModel, spectra: list[np.ndarray]) -> np.ndarray:
    """The highest score of each spectrum, none of them empty."""
    parts = [model.scores(spectra[at : at + BATCH]).max(axis=1) for at in range(0, len(spectra), BATCH)]
    return np.concatenate(parts) if parts else np.empty(0)


def score_floors(model: LanguageModel, labelled: list[tuple[str, str]], least: int = FLOOR_TEXTS, share: float = FLOOR_SHARE) -> np.ndarray:
    """The score that a text of a learned language reaches, by the bit length of its number of n-grams.

    It lies above the score of a text without any known n-gram by ``share`` of the way to the
    lowest of the labelled texts of the size.  There is no floor where labelled texts score
    no better than that, as the shortest do.  A size with fewer than ``least`` of them goes
    by the next smaller one, whose texts have less evidence.
    """
    spectra = [spectrum(text) for _, text in labelled if text]
    sizes, best = np.array([len(s).bit_length() for s in spectra]), best_scores(model, spectra)
    floors, unknown = np.full(64, -np.inf), model.base.max()
    for size in range(1, len(floors)):
        mine = best[sizes == size]
        if len(mine) < least:
            floors[size] = floors[size - 1]
        elif mine.min() > unknown:
            floors[size] = unknown + share * (mine.min() - unknown)
    return floors


def is_known(model: LanguageModel | None, floors: np.ndarray | None):
    """A column function of the text: whether it has a letter and, with a model, a score from the floor up."""

    @F.pandas_udf("boolean")
    def known(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in batches:
            texts = series.to_numpy(dtype=object)
            out = np.array([isinstance(t, str) and any(map(str.isalpha, t)) for t in texts], bool)
            lettered = np.flatnonzero(out) if model else []
            for at in range(0, len(lettered), BATCH):
                part = lettered[at : at + BATCH]
                spectra = [spectrum(texts[i]) for i in part]
                out[part] = best_scores(model, spectra) >= floors[[len(s).bit_length() for s in spectra]]
            yield pd.Series(out)

    return known


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of ``docs`` in a language that the labelled rows teach.

    Null texts and texts without letters go, and so do texts that score below the floor of
    their size.  Without labelled rows every text with a letter stays.
    """
    labelled = labelled_sample(docs, F.col("lang"))
    model = fit(labelled)
    floors = score_floors(model, labelled) if model else None
    return docs.filter(is_known(model, floors)(F.col("text")))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = is_held_out(F.col("doc_id"), 4, 2)
    model = train(docs, F.when(~held_out, F.col("lang")))
    judged = docs.select("doc_id", held_out.alias("held_out"), predictor(model)(F.col("text")).alias("p"))
    return judged.select("doc_id", "held_out", "p.lang_pred", "p.score")
