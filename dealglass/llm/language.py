"""Language identification by a mixture of languages per document.

Every language has a distribution over letter trigrams (hashed to ``BINS``),
counted over the text of all labelled documents that may be learned from: the
counting is a Spark aggregation over all of them, not a sample. A document is a
mixture: expectation-maximisation estimates the share of each language from the
likelihoods of its trigrams. The set of languages is chosen by penalised
likelihood: starting from all, the language with the smallest share is dropped
while that costs less likelihood than the penalty for one more language.

``lang_pred`` is the language with the largest share in the chosen set, ``score``
its share in the mixture of all languages, ``share`` that in the mixture of the
chosen set, ``languages`` the set by share.

How well the languages explain the text is tested against a background of unknown
text: the mean of all languages, flattened, with a uniform part.  Letter noise,
encoded data and languages never learned fit it better than the languages.  If it
adds more likelihood to all languages than the penalty, it is part of the text, and
``share`` is that of ``lang_pred`` beside it.  A text is accepted if its language fills a
third of it: a short text with little evidence is one language; a mixture without a
main language is refused, and a text of which the background leaves too little.  A
language much like a learned one can pass as that one, and the test is as good as the
labelled text: where that has few words, new words look unknown.

A text that is null or has no letter, or any text when nothing could be learned,
is ``und`` with score and share 0 and an empty set. Rows without an id are never learned
from; a null label is no label. Ties go to the language first by name. Repeated
rows are predicted alike; columns other than the text are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealglass.llm.common import learnable

BINS = 1 << 16
MAX_LANGUAGES = 256  # the model then has 128 MB
SMOOTHING = 0.05  # added to every count, times the language's mean count
PENALTY = 4.0  # times log(trigrams) per further language; trigrams overlap
ROUNDS = 30
FLATTEN = 0.7  # power of the mean distribution in the background
UNIFORM = 0.3  # part of the background that is equal for all trigrams
MIN_SHARE = 1 / 3  # of the main language in an accepted text
UNKNOWN = "und"
MIXTURE = "lang_pred string, score double, share double, languages array<string>"

_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    """For every code point whether it is a letter; made once per process."""
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def trigrams(text: str | None) -> np.ndarray:
    """Hashed trigrams of lower-case letters, other runs being one space."""
    if not text:
        return np.empty(0, np.uint16)
    points = np.frombuffer(
        text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _is_letter()[points]
    if not letter.any():
        return np.empty(0, np.uint16)
    points = np.where(letter, points, np.uint32(32))
    points = np.concatenate(([np.uint32(32)], points, [np.uint32(32)]))
    space = points == 32
    points = points[~(space & np.concatenate(([False], space[:-1])))]
    mixed = points[:-2] * np.uint32(0x9E3779B1) ^ points[1:-1] * np.uint32(0x85EBCA77)
    mixed ^= points[2:] * np.uint32(0xC2B2AE3D)
    mixed ^= mixed >> np.uint32(15)
    return ((mixed * np.uint32(0x27D4EB2F)) >> np.uint32(16)).astype(np.uint16)


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Trigram counts per language of one partition."""
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for text, lang in zip(batch["text"], batch["lang"]):
            if lang not in totals:
                totals[lang] = np.zeros(BINS, np.int64)
            totals[lang] += np.bincount(trigrams(text), minlength=BINS)
    for lang, total in totals.items():
        used = np.flatnonzero(total)
        yield pd.DataFrame({"lang": lang, "bin": used.astype(np.int32), "n": total[used]})


def learn(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang"
) -> tuple[list[str], np.ndarray]:
    """Sorted languages and their trigram probabilities (bins x languages)."""
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"),
        F.col(f"`{lang}`").alias("lang"))
    rows = rows.filter(learnable(F.col("id"))).filter("text is not null and lang is not null")
    counts = rows.select("text", "lang").mapInPandas(_counted, "lang string, bin int, n long")
    counts = counts.groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    per_lang = counts.groupBy("lang").agg(
        F.collect_list("bin").alias("bins"), F.collect_list("n").alias("counts"))
    model = per_lang.limit(MAX_LANGUAGES + 1).collect()
    if len(model) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    model.sort(key=lambda r: r["lang"])
    weights = np.zeros((BINS, len(model)))
    for i, row in enumerate(model):
        weights[row["bins"], i] = row["counts"]
    if len(model):
        weights += SMOOTHING * weights.sum(axis=0) / BINS
        weights /= weights.sum(axis=0)
    return [r["lang"] for r in model], weights


def shares(likelihood: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, float]:
    """Share of each column by expectation-maximisation, and the log-likelihood."""
    total, k = n.sum(), likelihood.shape[1]
    share = np.full(k, 1.0 / k)
    mixed = likelihood @ share
    for _ in range(ROUNDS if k > 1 else 0):
        new = share * ((n / mixed) @ likelihood) / total
        moved = np.abs(new - share).max()
        share = new
        mixed = likelihood @ share
        if moved < 1e-3:
            break
    return share, float(n @ np.log(mixed))


def background(model: np.ndarray) -> np.ndarray:
    """Trigram probabilities of text in no learned language."""
    if not model.shape[1]:
        return np.full(BINS, 1 / BINS)
    flat = model.mean(axis=1) ** FLATTEN
    return (1 - UNIFORM) * flat / flat.sum() + UNIFORM / BINS


def beside_unknown(likelihood: np.ndarray, n: np.ndarray, every: np.ndarray, best: float,
                   unknown: np.ndarray, price: float) -> np.ndarray | None:
    """Shares of all languages beside the background, or None if that is not proven.

    ``every`` and ``best`` are the shares and log-likelihood without it.  As the
    likelihood is concave, the first step bounds what the background can add.
    """
    ratio = float(n @ (unknown / (likelihood @ every))) / n.sum()
    if ratio <= 1 or n.sum() * np.log(ratio) <= price:
        return None
    share, value = shares(np.column_stack((likelihood, unknown)), n)
    return share[:-1] if value - best > price else None


def mixture(codes: np.ndarray, langs: list[str], model: np.ndarray,
            unknown: np.ndarray | None = None):
    """(language, score, share, languages by share) of one document's trigrams.

    ``unknown`` is ``background(model)``, if the caller has it.
    """
    if not len(codes) or not langs:
        return UNKNOWN, 0.0, 0.0, []
    bins, n = np.unique(codes, return_counts=True)
    likelihood, n = model[bins], n.astype(float)
    every, best_all = shares(likelihood, n)
    price = PENALTY * np.log(len(codes) + 1.0)
    alone = n @ np.log(likelihood)
    single = int(alone.argmax())
    chosen, share = [single], np.ones(1)
    if best_all - price > alone[single]:  # else no larger set can pay for itself
        held = [i for i in range(len(langs)) if every[i] * len(codes) >= 1] or [single]
        part, value = shares(likelihood[:, held], n)
        while len(held) > 1:
            less = held[: part.argmin()] + held[part.argmin() + 1:]
            p, v = shares(likelihood[:, less], n)
            if value - v >= price:
                break
            held, part, value = less, p, v
        chosen, share = held, part
    order = np.lexsort((chosen, -share))
    names = [langs[chosen[i]] for i in order]
    first = order[0]
    main = share[first]
    if unknown is None:
        unknown = background(model)
    beside = beside_unknown(likelihood, n, every, best_all, unknown[bins], price)
    if beside is not None:
        main = min(main, beside[chosen[first]])
    return names[0], float(min(1.0, every[chosen[first]])), float(min(1.0, main)), names


def detector(docs: DataFrame, langs: list[str], model: np.ndarray):
    """A column function: text to a struct of ``MIXTURE``."""
    shared = docs.sparkSession.sparkContext.broadcast((langs, model, background(model)))

    @F.pandas_udf(MIXTURE)
    def detect(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names, table, unknown = shared.value
        for batch in batches:
            rows = [mixture(trigrams(text), names, table, unknown) for text in batch]
            yield pd.DataFrame(rows, columns=["lang_pred", "score", "share", "languages"])

    return detect.asNondeterministic()  # so that a filter does not run it again


def predict(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """All rows and columns, and a struct ``language`` of ``MIXTURE``, which replaces one so named."""
    detect = detector(docs, *learn(docs, doc_id, text, lang))
    return docs.withColumn("language", detect(F.col(f"`{text}`")))


def accepted(language: Column, min_share: float = MIN_SHARE) -> Column:
    """In a known language that fills ``min_share`` of the text, unknown text included."""
    return (language["lang_pred"] != UNKNOWN) & (language["share"] >= min_share)


def keep(docs: DataFrame, min_share: float = MIN_SHARE, doc_id: str = "doc_id", text: str = "text",
         lang: str = "lang") -> DataFrame:
    """The documents in a known language, with their own columns only."""
    packed = docs.select(
        F.struct("*").alias("__row"), F.col(f"`{doc_id}`").alias("__id"),
        F.col(f"`{text}`").alias("__text"), F.col(f"`{lang}`").alias("__lang"))
    found = predict(packed, "__id", "__text", "__lang")
    return found.filter(accepted(F.col("language"), min_share)).select("__row.*")
