"""Toxicity: a linear-chain conditional random field over words, learned from documents.

Every word has one of two tags, clean or toxic. A tag's weight comes from hashed features of
the word (the word, its beginnings and endings, its shape) and from the tag before it. Only
toxic tags have weights, so the tagging that is clean throughout has weight one, and with Z
as the sum over all taggings 1 / Z is its probability.

Learning. ``labels`` mark documents, and so the words: all words of a document with label 0
are clean; of one with label 1 at least one is toxic, which one is open. The likelihood of
that is 1 / Z and 1 - 1 / Z, whose gradients are weighted marginals of forward-backward;
they are climbed by Adam with decay towards no weight. A second, smaller part of the sample
sets the scale of the document score. The sample is the documented bound of what is learned
from: at most ``SAMPLE`` labelled rows of each label value, by hash of the id, of these the
texts of at most ``SAMPLE_WORDS`` words, equal texts once. Tasks send word keys and feature
numbers to the driver, no texts.

Scoring. All words of all texts are tagged. Forward-backward runs over all texts of a block
at once: texts are cut into chunks of ``CHUNK`` words, the 2 x 2 products of all chunks are
formed side by side, joined along each text, and run through again with what comes in from
either end, so the marginals are exact at any length. The document score is a logistic
function of log(Z - 1) and of the expected number of toxic words; the offending spans are
runs of words with a marginal of ``SPAN`` or more, as offsets in code points, with the
greatest marginal of the run.

A null text and one without words score as the lowest, with no spans. Labels other than 0
and 1 and rows without an id are not learned from; a document labelled both ways counts for
both. Without labels of both values every score is 0. Rows, repeated ones included, and
other columns pass through; ``toxicity`` replaces a column of that name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealglass.llm.common import learnable, store

SAMPLE = 2048  # labelled rows of each label value
SAMPLE_WORDS = 2048  # of a text that is learned from
BINS = 1 << 18
CHUNK = 64
BLOCK = 200_000  # words tagged at once
BEGIN = (3, 4, 5, 6, 7, 8)  # bytes of a word's beginnings
END = (2, 3, 4)
ROUNDS = 60
RATE = 0.25
DECAY = 0.1  # pull of weights to zero, in documents of the mean share
NOISE = 0.03  # share of documents with label 1 that have no toxic word
START = -7.0  # weight of a toxic tag at first
SPAN = 0.5
THRESHOLD = 0.3
CALIBRATION = 5  # one in so many sampled texts sets the scale of the score
_SPANS = "array<struct<start:int,end:int,marginal:double>>"
TYPE = f"score double, expected double, spans {_SPANS}"
_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("marginal", pa.float64())])

_WORDS = re.compile(r"\w+")


def _bins(values: np.ndarray, kind: int) -> np.ndarray:
    """A bin from 1 to BINS - 1 for each value of a kind of feature."""
    mixed = (values ^ np.uint64(kind * 0x632BE59BD9B4E019 % 2**64)) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (1 + (mixed >> np.uint64(32)) % np.uint64(BINS - 1)).astype(np.int64)


def _bytes(parts: list[bytes], width: int) -> np.ndarray:
    return np.array(parts, f"S{width}").view(f"u{width}").astype(np.uint64)


def features(words: list[str]) -> np.ndarray:
    """Bins of each word (rows), in lower case: the word, its beginnings and endings in UTF-8
    as far as it goes beyond them, its length.  0 where there is none."""
    if not len(words):
        return np.zeros((0, 2 + len(BEGIN) + len(END)), np.int64)
    raw = [w.lower().encode("utf-8", "surrogatepass") for w in words]
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    whole = np.fromiter(map(xxhash.xxh3_64_intdigest, raw), np.uint64, len(raw))
    first, last = _bytes([w[:8] for w in raw], 8), _bytes([w[:-5:-1] for w in raw], 4)
    out = [_bins(whole, 0), _bins(np.minimum(size // 4, 8).astype(np.uint64), 1)]
    for kind, (part, lengths) in enumerate(((first, BEGIN), (last, END)), 1):
        for k in lengths:
            found = _bins(part & np.uint64(2 ** (8 * k) - 1), 16 * kind + k)
            out.append(np.where(size > k, found, 0))
    return np.stack(out, 1)


@dataclass
class Chain:
    """Transition weights into and out of the toxic tag, as logs."""

    enter: float
    leave: float
    stay: float


def marginals(
    weights: np.ndarray, lengths: np.ndarray, chain: Chain
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over many texts: log Z of each; each word's toxic marginal; and of each
    text the expected moves from clean to toxic, from toxic to clean, and within toxic.

    ``weights`` are the words' weights for the toxic tag, text after text.
    """
    lengths = np.asarray(lengths, np.int64)
    texts = len(lengths)
    chunks = -(-lengths // CHUNK)
    n = int(chunks.sum())
    first = np.cumsum(chunks) - chunks
    text = np.repeat(np.arange(texts), lengths)
    within = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    # Rows are places within a chunk, columns are chunks, so that a step reads one row.
    at = (within % CHUNK) * n + first[text] + within // CHUNK
    enter, leave, stay = np.exp((chain.enter, chain.leave, chain.stay))
    odds = np.exp(np.clip(weights, -60, 60))
    # A word's step from (clean, toxic) to (clean, toxic); clean to clean is one.  Beyond a
    # text's end nothing moves.
    ct, tc, tt = np.zeros(CHUNK * n), np.zeros(CHUNK * n), np.ones(CHUNK * n)
    ct[at], tc[at], tt[at] = odds * enter, leave, odds * stay
    ct, tc, tt = (x.reshape(CHUNK, n) for x in (ct, tc, tt))

    # Products of the steps of each chunk, scaled, with the logs of the scales.
    p = [np.ones(n), np.zeros(n), np.zeros(n), np.ones(n)]
    scale = np.zeros(n)
    for k in range(CHUNK):
        b, c, d = ct[k], tc[k], tt[k]
        p = [p[0] + p[1] * c, p[0] * b + p[1] * d, p[2] + p[3] * c, p[2] * b + p[3] * d]
        if k % 4 == 3:  # a step is at most e^60 or so, four are within a double
            size = np.maximum(np.maximum(p[0], p[1]), np.maximum(p[2], p[3]))
            p = [x / size for x in p]
            scale += np.log(size)

    # Along the chunks of each text, longest texts first so that those still running lead.
    by = np.argsort(-chunks, kind="stable")
    most = int(chunks.max(initial=0))
    running = [by[:m] for m in np.searchsorted(-chunks[by], -np.arange(most), "left").tolist()]
    ahead = np.zeros((2, CHUNK + 1, n))
    back = np.zeros((2, n))
    clean, bad, log_z = np.ones(texts), np.zeros(texts), np.zeros(texts)
    for k, some in enumerate(running):
        c = first[some] + k
        x, y = clean[some], bad[some]
        ahead[0, 0, c], ahead[1, 0, c] = x, y
        x, y = x * p[0][c] + y * p[2][c], x * p[1][c] + y * p[3][c]
        clean[some], bad[some] = x / (x + y), y / (x + y)
        log_z[some] += np.log(x + y) + scale[c]
    clean, bad = np.ones(texts), np.ones(texts)
    for k in range(most - 1, -1, -1):
        some = running[k]
        c = first[some] + k
        x, y = clean[some], bad[some]
        back[0, c], back[1, c] = x, y
        x, y = p[0][c] * x + p[1][c] * y, p[2][c] * x + p[3][c] * y
        clean[some], bad[some] = x / (x + y), y / (x + y)

    # Within all chunks at once.
    clean, bad = ahead[:, 0]
    for k in range(CHUNK):
        clean, bad = clean + bad * tc[k], clean * ct[k] + bad * tt[k]
        size = clean + bad
        clean, bad = clean / size, bad / size
        ahead[0, k + 1], ahead[1, k + 1] = clean, bad
    marginal = np.empty((CHUNK, n))
    moves = np.zeros((3, n))
    x, y = back
    for k in range(CHUNK - 1, -1, -1):
        clean, bad = ahead[0, k], ahead[1, k]
        into, out, on = clean * ct[k] * y, bad * tc[k] * x, bad * tt[k] * y
        total = clean * x + into + out + on
        marginal[k] = (into + on) / total
        real = tc[k] > 0
        moves += np.stack((into, out, np.where(real, on, 0))) / total
        x, y = x + ct[k] * y, tc[k] * x + tt[k] * y
        size = x + y
        x, y = x / size, y / size
    of_chunk = np.repeat(np.arange(texts), chunks)
    counts = np.stack([np.bincount(of_chunk, m, texts) for m in moves], 1)
    return log_z, marginal.ravel()[at], counts.reshape(texts, 3)


def _log_any(log_z: np.ndarray) -> np.ndarray:
    """log(Z - 1), the log odds that a text has a toxic word."""
    small = np.maximum(log_z, 1e-12)
    return np.where(small > 30, small, np.log(np.expm1(np.minimum(small, 30))))


class Model:
    """Feature weights, transitions, and the scale of the document score."""

    def __init__(
        self, keys: np.ndarray, bins: np.ndarray, texts: list[np.ndarray], labels,
        held=None,
    ):
        """Learns from texts of word keys; ``bins`` has a row for each of the sorted ``keys``."""
        codes = [np.searchsorted(keys, text) for text in texts]
        lengths = np.array([len(c) for c in codes], np.int64)
        labels = np.asarray(labels)
        held = np.zeros(len(texts), bool) if held is None else np.asarray(held, bool)
        bins = np.where(_in_texts(bins, codes)[bins] > 1, bins, 0)  # others tell of one text only
        self.weights = np.zeros(BINS)
        self.bias = START
        self.chain = Chain(0.0, 0.0, 0.0)
        learn = [k for k in range(len(texts)) if not held[k] and lengths[k]]
        self._climb(bins, [codes[k] for k in learn], labels[learn])
        self.scale = np.array([0.0, 1.0, 0.0])
        check = [k for k in range(len(texts)) if held[k]] if held.any() else list(range(len(texts)))
        if len(set(labels[check].tolist())) == 2:
            of_word = self.bias + self.weights[bins].sum(1)
            inputs = [self.inputs(of_word[np.concatenate([codes[k] for k in part])], lengths[part])[0]
                      for part in _parts(check, lengths)]
            self.scale = _logistic(np.concatenate(inputs), labels[check])

    def _climb(self, bins: np.ndarray, codes: list[np.ndarray], labels: np.ndarray) -> None:
        """Adam on the likelihood of the labels, in blocks of texts."""
        if not codes:
            return
        lengths = np.array([len(c) for c in codes])
        share = np.where(labels == 1, 0.5 / max((labels == 1).sum(), 1),
                         0.5 / max((labels == 0).sum(), 1))
        used, place = np.unique(bins, return_inverse=True)
        place = place.reshape(bins.shape)
        blocks = [(np.concatenate([codes[k] for k in part]), lengths[part], labels[part], share[part])
                  for part in _parts(list(range(len(codes))), lengths)]
        values = np.concatenate((np.zeros(len(used)), [self.bias, 0.0, 0.0, 0.0]))
        mean, square = np.zeros(len(values)), np.zeros(len(values))
        for step in range(1, ROUNDS + 1):
            of_word = values[-4] + values[place].sum(1)
            chain = Chain(*values[-3:])
            by_word, by_move = np.zeros(len(bins)), np.zeros(3)
            for words, sizes, marked, weight in blocks:
                log_z, marginal, moves = marginals(of_word[words], sizes, chain)
                # Gradient of the loss by log Z.  Of a toxic text the likelihood is that of a
                # toxic word or, with NOISE, of a wrong label; a clean one's is 1 / Z.
                clean = np.exp(-log_z)
                toxic = -(1 - NOISE) * clean / (NOISE + (1 - NOISE) * (1 - clean))
                by_z = np.where(marked == 1, toxic, 1.0) * weight
                by_word += np.bincount(words, marginal * np.repeat(by_z, sizes), len(bins))
                by_move += by_z @ moves
            slope = np.zeros(len(values))
            for column in place.T:
                slope[:-4] += np.bincount(column, by_word, len(used))
            slope[-4], slope[-3:] = by_word.sum(), by_move
            slope[:-4] += DECAY * values[:-4] / len(codes)
            slope[-3:] += DECAY * values[-3:]
            if used[0] == 0:
                slope[0] = 0  # stands for no feature
            mean = 0.9 * mean + 0.1 * slope
            square = 0.99 * square + 0.01 * slope**2
            step_size = RATE * (1 - step / (ROUNDS + 1))
            values -= step_size * (mean / (1 - 0.9**step)) / (
                np.sqrt(square / (1 - 0.99**step)) + 1e-9)
        self.weights[used] = values[:-4]
        self.bias, self.chain = float(values[-4]), Chain(*values[-3:].tolist())

    def inputs(self, weights: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Inputs of the document score, and the words' marginals."""
        log_z, marginal, _ = marginals(weights, lengths, self.chain)
        text_of = np.repeat(np.arange(len(lengths)), lengths)
        expected = np.bincount(text_of, marginal, len(lengths))
        odds = np.where(lengths > 0, np.clip(_log_any(log_z), -20, 20), -20.0)
        return np.stack((np.ones(len(lengths)), odds, np.log1p(expected)), 1), marginal

    def score(self, inputs: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(inputs @ self.scale, -40, 40)))


def _in_texts(bins: np.ndarray, codes: list[np.ndarray]) -> np.ndarray:
    """In how many texts each bin occurs."""
    texts = np.zeros(BINS, np.int64)
    for text in codes:
        texts[np.unique(bins[np.unique(text)])] += 1
    return texts


def _parts(texts: list[int], lengths: np.ndarray) -> list[list[int]]:
    """The texts in blocks of about ``BLOCK`` words."""
    block = np.cumsum(lengths[texts]) // BLOCK
    return [[texts[k] for k in np.flatnonzero(block == b)] for b in np.unique(block)]


def _logistic(inputs: np.ndarray, labels: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Logistic regression by Newton's steps, with a light pull to (0, 1, 0)."""
    start = np.array([0.0, 1.0, 0.0])
    out, pull = start.copy(), 0.5 * np.eye(inputs.shape[1])
    for _ in range(rounds):
        guess = 1 / (1 + np.exp(-np.clip(inputs @ out, -30, 30)))
        slope = inputs.T @ (guess - labels) + pull @ (out - start)
        bend = (inputs * (guess * (1 - guess))[:, None]).T @ inputs + pull
        step = np.linalg.solve(bend, slope)
        out -= step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-9:
            break
    return np.concatenate((out[:1], np.maximum(out[1:], 0)))


class Tagger:
    """Scores and spans of texts."""

    def __init__(self, model: Model):
        self.model = model

    def tag(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[list[tuple]]]:
        """Document scores, expected toxic words, and spans of each text."""
        lists = [_WORDS.findall(t or "") for t in texts]
        lengths = np.array([len(x) for x in lists], np.int64)
        codes, known = pd.factorize(np.array([w for x in lists for w in x], object))
        weights = (self.model.bias + self.model.weights[features(known)].sum(1))[codes]
        inputs, marginal = self.model.inputs(weights, lengths)
        begin = np.concatenate(([0], np.cumsum(lengths)))
        bad = np.searchsorted(begin, np.flatnonzero(marginal >= SPAN), "right") - 1
        spans: list[list[tuple]] = [[] for _ in texts]
        for k in np.unique(bad).tolist():
            spans[k] = _spans(texts[k], marginal[begin[k]:begin[k + 1]])
        return self.model.score(inputs), np.expm1(inputs[:, 2]), spans


def _spans(text: str, marginal: np.ndarray) -> list[tuple[int, int, float]]:
    """Offsets of the runs of toxic words of a text, and their greatest marginal."""
    found = [m.span() for m in _WORDS.finditer(text)]
    out: list[list] = []
    last = -2
    for k in np.flatnonzero(marginal >= SPAN).tolist():
        if k == last + 1:
            out[-1][1], out[-1][2] = found[k][1], max(out[-1][2], float(marginal[k]))
        else:
            out.append([*found[k], float(marginal[k])])
        last = k
    return [tuple(x) for x in out]


def key(word: str) -> int:
    """A word's number: a signed 64-bit hash of its lower case."""
    return xxhash.xxh3_64_intdigest(word.lower().encode("utf-8", "surrogatepass")) - 2**63


def sample(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
    label: str = "toxic", most: int = SAMPLE,
) -> DataFrame:
    """Texts to learn from: at most ``most`` ids of each label, equal texts once."""
    rows = labels.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{label}`").alias("label"))
    rows = rows.filter(learnable(F.col("id")) & F.col("label").isin(0, 1)).distinct()
    mixed = F.xxhash64(F.col("id").cast("string"))
    chosen = [rows.filter(F.col("label") == value).orderBy(mixed, "id").limit(most)
              for value in (0, 1)]
    few = F.broadcast(chosen[0].unionByName(chosen[1]))  # 2 * most ids
    texts = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    found = texts.filter(F.col("text").isNotNull()).join(few, "id")
    return found.groupBy("text", "label").agg(F.min(mixed).alias("mixed")).select(
        "text", F.col("label").cast("int").alias("label"),
        (F.pmod("mixed", F.lit(CALIBRATION)) == 0).alias("held"))


def _as_keys(texts: DataFrame) -> DataFrame:
    """The sampled texts as word keys, with the bins of their words; long texts left out."""
    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, label, held in zip(*(c.to_pylist() for c in batch.columns)):
                words = _WORDS.findall(text)
                if len(words) <= SAMPLE_WORDS:
                    known = dict.fromkeys(words)
                    each = [{"key": key(w), "bins": b}
                            for w, b in zip(known, features(list(known)).tolist())]
                    yield pa.RecordBatch.from_pylist(
                        [{"label": label, "held": held, "keys": [key(w) for w in words],
                          "words": each}], schema)

    schema = pa.schema([
        ("label", pa.int32()), ("held", pa.bool_()), ("keys", pa.list_(pa.int64())),
        ("words", pa.list_(pa.struct([("key", pa.int64()), ("bins", pa.list_(pa.int32()))])))])
    return texts.mapInArrow(
        convert, "label int, held boolean, keys array<bigint>, "
        "words array<struct<key:bigint,bins:array<int>>>")


def learn(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
    label: str = "toxic",
) -> Model | None:
    """None unless there are sampled texts of both labels."""
    texts = store(_as_keys(sample(docs, labels, doc_id, text, label)), "toxic-sample")
    rows = texts.select("keys", "label", "held").orderBy("label", "held", "keys").toArrow()
    marks = rows["label"].to_numpy()
    if len(set(marks.tolist())) < 2:
        return None
    each = texts.select(F.explode("words").alias("word")).select("word.*")
    words = each.groupBy("key").agg(F.min("bins").alias("bins")).orderBy("key").toArrow()
    bins = words["bins"].combine_chunks().flatten().to_numpy().reshape(len(words), -1)
    lists = rows["keys"].combine_chunks()
    flat, ends = lists.flatten().to_numpy(), np.cumsum(pa.compute.list_value_length(lists))
    return Model(words["key"].to_numpy(), bins, np.split(flat, ends[:-1]), marks,
                 rows["held"].to_numpy(zero_copy_only=False))


def with_scores(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """All rows and columns, and ``toxicity``: score, expected toxic words, spans."""
    if model is None:
        nothing = F.struct(F.lit(0.0).alias("score"), F.lit(0.0).alias("expected"),
                           F.array().cast(_SPANS).alias("spans"))
        return docs.withColumn("toxicity", nothing)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(TYPE)
    def toxicity(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tagger = Tagger(shared.value)
        for batch in batches:
            parts = [tagger.tag(block) for block in _blocks(batch.to_pylist())]
            spans = [x for part in parts for x in part[2]]
            flat = [dict(zip(("start", "end", "marginal"), s)) for x in spans for s in x]
            offsets = np.cumsum([0, *map(len, spans)])
            yield pa.StructArray.from_arrays(
                [pa.array(np.concatenate([part[0] for part in parts] or [np.zeros(0)])),
                 pa.array(np.concatenate([part[1] for part in parts] or [np.zeros(0)])),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, _SPAN))],
                ["score", "expected", "spans"])

    return docs.withColumn("toxicity", toxicity.asNondeterministic()(F.col(f"`{text}`")))


def _blocks(texts: list[str | None]) -> Iterator[list[str | None]]:
    """Texts in blocks of about ``BLOCK`` words, by their lengths; a longer one by itself."""
    block, size = [], 0
    for text in texts:
        block.append(text)
        size += len(text or "") // 6 + 1
        if size >= BLOCK:
            yield block
            block, size = [], 0
    if block:
        yield block
