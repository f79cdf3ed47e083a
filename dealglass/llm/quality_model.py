"""Quality classifier: nearest-neighbour votes in a latent-semantic space.

Every text becomes a vector of term weights: hashed words, the shapes of words
(capitals, digits, symbols), stutters, repeated lines and a length class, each
kind weighted and scaled by itself. A truncated singular value decomposition of
a labelled sample gives the latent space. The labelled vectors, in that space
and of unit length, are broadcast; the cosines of all documents with all of them
are computed exactly, in blocks, and the labels of the nearest vote with their
similarity as weight.

Learned is only from labels of rows that may be learned from, and of them at
most ``SAMPLE`` per label value (by hash of the id): this bounds what is
collected and broadcast, 2 * SAMPLE vectors of at most WORD_BINS + STYLE_BINS
terms each; texts stay in the tasks. All documents are scored.

Labels, language, source and id are no input of a score. A null or empty text
has its length class as its only term; one that is
like no labelled text scores 0.5. Null labels and ids are not learned from;
a document with several labels counts once for each. Without any usable label
every score is 0.5. Rows, repeated ones included, and their other columns pass
through unchanged; ``quality_score`` replaces a column of that name. Of labelled vectors
as near as the last neighbour any may vote, so equal texts always get one score within a
block, and up to rounding in any block.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealglass.llm.common import learnable

SAMPLE = 2048  # labelled rows per label value
WORD_BINS = 4096
STYLE_BINS = 512
LATENT = 48
NEIGHBOURS = 15
VOTE = 4  # a vote's weight is the cosine to this power
BLOCK = 256  # documents per block of cosines
STYLE_WEIGHT = 1.5  # of style terms against word terms
THRESHOLD = 0.7
KNOWN_WORDS = 200_000  # words whose terms a task remembers

_RUNS = re.compile(r"(.)\1+")
_LINE = re.compile(r"[^\n]+")
_known: dict[str, tuple[int, int]] = {}


def _bin(text: str, bins: int) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) % bins


def _shape(word: str) -> str:
    kinds = "".join(
        "a" if c.islower() else "A" if c.isupper() else "x" if c.isalpha()
        else "0" if c.isdigit() else c for c in word)
    return _RUNS.sub(r"\1", kinds)


def _word_terms(word: str) -> tuple[int, int]:
    """Word bin and style bin of a word, remembered."""
    terms = _known.get(word)
    if terms is None:
        if len(_known) >= KNOWN_WORDS:
            _known.clear()
        plain = word.strip(".,;:!?\"'()[]{}%$&*#|<>").lower()
        terms = _bin(plain, WORD_BINS), _bin("s:" + _shape(word), STYLE_BINS)
        _known[word] = terms
    return terms


def terms(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Term bins (style bins after word bins) and weights, each kind of unit length."""
    words = (text or "").split()
    n = len(words)
    style: Counter[int] = Counter()
    word: Counter[int] = Counter()
    for w, count in Counter(words).items():
        at, shape = _word_terms(w)
        word[at] += count
        style[shape] += count / n
    lines = [x.strip() for x in _LINE.findall(text or "")]
    lines = [x for x in lines if x]
    if lines:
        style[_bin("l:repeat", STYLE_BINS)] += 1 - len(set(lines)) / len(lines)
        stutters = sum(a == b for a, b in zip(words, words[1:])) / n
        style[_bin("r:stutter", STYLE_BINS)] += stutters
    style[_bin(f"n:{n.bit_length()}", STYLE_BINS)] += 0.2 if n else 1.0
    style_at = np.fromiter(style, np.int64, len(style)) + WORD_BINS
    style_by = np.sqrt(np.fromiter(style.values(), float, len(style)))
    style_by *= STYLE_WEIGHT / np.sqrt((style_by**2).sum())
    word_at = np.fromiter(word, np.int64, len(word))
    word_by = 1 + np.log(np.fromiter(word.values(), float, len(word)))
    return np.concatenate((word_at, style_at)), np.concatenate((word_by, style_by))


class Model:
    """Term weights, latent space, and the labelled vectors with their labels."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: list[int]):
        """Learns from the ``terms`` of texts."""
        in_texts = np.zeros(WORD_BINS + STYLE_BINS)
        for at, _ in rows:
            in_texts[at] += 1
        self.idf = np.log((1 + len(rows)) / (1 + in_texts)) + 1
        self.idf[WORD_BINS:] = 1
        full = np.zeros((len(rows), WORD_BINS + STYLE_BINS), np.float32)
        for i, (at, by) in enumerate(rows):
            full[i, at] = self.weigh(at, by)
        self.space = _singular_vectors(full, LATENT)
        self.labels = np.asarray(labels, np.float32)
        self.vectors = unit(full @ self.space)

    def weigh(self, at: np.ndarray, by: np.ndarray) -> np.ndarray:
        weight = by * self.idf[at]
        words = at < WORD_BINS
        size = np.sqrt((weight[words] ** 2).sum())
        if size > 0:
            weight[words] /= size
        return weight.astype(np.float32)

    def project(self, texts) -> np.ndarray:
        out = np.zeros((len(texts), self.space.shape[1]), np.float32)
        for i, text in enumerate(texts):
            at, by = terms(text)
            out[i] = self.weigh(at, by) @ self.space[at]
        return unit(out)

    def score(self, texts) -> np.ndarray:
        """Label 1's share of the similarity of the nearest labelled vectors."""
        out = np.empty(len(texts))
        k = min(NEIGHBOURS, len(self.labels))
        for begin in range(0, len(texts), BLOCK):
            near = self.project(texts[begin:begin + BLOCK]) @ self.vectors.T
            top = np.argpartition(near, -k, axis=1)[:, -k:]
            weight = np.maximum(np.take_along_axis(near, top, 1), 0) ** VOTE
            total = weight.sum(1)
            votes = (weight * self.labels[top]).sum(1)
            out[begin:begin + BLOCK] = np.where(total > 0, votes / np.maximum(total, 1e-12), 0.5)
        return np.clip(out, 0, 1)


def _singular_vectors(rows: np.ndarray, n: int, rounds: int = 8) -> np.ndarray:
    """The first right singular vectors, by subspace iteration from a fixed start."""
    n = min(n, *rows.shape)
    some = np.random.default_rng(0).standard_normal((rows.shape[1], min(2 * n, rows.shape[1])))
    base = some.astype(np.float32)
    for _ in range(rounds):
        base, _ = np.linalg.qr(rows.T @ (rows @ base))
    return base @ np.linalg.svd(rows @ base, full_matrices=False)[2][:n].T


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.sqrt((rows**2).sum(axis=1, keepdims=True)), 1e-9)


def sample(
    docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, most: int = SAMPLE
) -> DataFrame:
    """At most ``most`` labelled texts of each label value 0 and 1."""
    rows = labels.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{label}`").alias("label"))
    rows = rows.filter(learnable(F.col("id")) & F.col("label").isin(0, 1))
    chosen = [
        rows.filter(F.col("label") == value).orderBy(F.xxhash64(F.col("id").cast("string")), "id")
        .limit(most) for value in (0, 1)]
    few = F.broadcast(chosen[0].unionByName(chosen[1]).dropDuplicates())  # 2 * most ids
    # Repeated rows of one id: any one text of it.
    texts = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    return texts.join(few, "id").groupBy("id", "label").agg(F.min("text").alias("text"))


def _as_lists(text: str | None) -> dict[str, list]:
    at, by = terms(text)
    return {"at": at.tolist(), "by": by.tolist()}


def learn(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
    label: str = "quality",
) -> Model | None:
    """Tasks turn the sampled texts into terms; the driver gets those, at most one per bin."""
    chosen = sample(docs, labels, doc_id, text, label)
    turn = F.udf(_as_lists, "at array<int>, by array<double>", useArrow=True)
    rows = chosen.select("id", "label", turn("text").alias("terms"))
    rows = rows.orderBy("id", "label").select("label", "terms.*").toArrow()
    if not len(rows):
        return None
    at, by = (rows[c].combine_chunks() for c in ("at", "by"))
    ends = np.cumsum(pa.compute.list_value_length(at).to_numpy())[:-1]
    parts = zip(np.split(at.flatten().to_numpy(), ends), np.split(by.flatten().to_numpy(), ends))
    return Model(list(parts), rows["label"].to_pylist())


def with_scores(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """All rows and columns, and a column ``quality_score`` from 0 to 1."""
    if model is None:
        return docs.withColumn("quality_score", F.lit(0.5))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(shared.value.score(batch.tolist()))

    return docs.withColumn("quality_score", score.asNondeterministic()(F.col(f"`{text}`")))
