"""Periodic run detection: stretches of words that repeat with a period, found exactly.

A run is a stretch of consecutive words with smallest period q (words q apart are the same)
that is at least ``LEAST_LENGTH`` words long, holds its period ``LEAST_EXPONENT`` times or
more, and that no neighbouring word extends. All runs of a text are found, in any number and
of any period, in work that grows as n log n with its words:

1. Suffixes are sorted by prefix doubling, from grams of ``_shortest`` words on. A run starts
   with a gram that comes again one period later, so positions whose gram occurs once in
   their text take no part; in plain prose that leaves almost nothing to sort.
2. The longest common prefix (LCP) of neighbours in that order is read off the ranks of the
   doubling rounds.
3. Kruskal: the pairs are taken by falling LCP, and union-find joins the classes of their
   suffixes; each class keeps its positions in order, the smaller set going into the larger.
   At LCP l a class holds all places of one text of l words. Two positions that become
   neighbours in a class, d <= l words apart, have no nearer pair between them, so d is the
   smallest period of the d + l words from the first one on: a seed. Of the seeds of a run
   the one at its first word is kept; it has the run's whole length.

The positions, classes and runs of a text stay in the task that has the text. Texts are
handled in blocks of about ``BLOCK`` words, a longer text by itself, so memory grows with the
longest text only.

Words lie between ASCII white space. A null text has no words, like an empty one: no runs and
an empty collapsed text. Rows, repeated ones included, and other columns pass through;
``periodic`` replaces a column of that name.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealglass.llm.common import SPACE_WORD

LEAST_LENGTH = 6
LEAST_EXPONENT = 4
BLOCK = 200_000  # words handled at once

_WORDS = re.compile(SPACE_WORD)
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
TYPE = ("n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, "
        "strongest struct<start:bigint,length:bigint,period:bigint>, collapsed string")
Run = tuple[int, int, int]  # start, length, period


def _shortest(least_length: int, least_exponent: int) -> int:
    """Words that a run's first word and the one a period later have in common, at least."""
    return min(max(least_length - q, (least_exponent - 1) * q, 1)
               for q in range(1, least_length + 1))


def _grams(codes: np.ndarray, text_of: np.ndarray, size: int) -> np.ndarray:
    """Positions whose gram of ``size`` words lies in one text and may occur there again."""
    n = len(codes) - size + 1
    if n < 2:
        return np.zeros(0, np.int64)
    mixed = text_of[:n].astype(np.uint64)
    for k in range(size):
        mixed = (mixed + codes[k:k + n].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    inside = np.flatnonzero(text_of[:n] == text_of[size - 1:])
    order = inside[np.argsort(mixed[inside], kind="stable")]
    same = mixed[order[1:]] == mixed[order[:-1]]
    again = np.zeros(len(order), bool)
    again[1:] |= same
    again[:-1] |= same
    return np.sort(order[again])


def _starts(changed: np.ndarray) -> np.ndarray:
    """For each place of a sorted list the first place of its group."""
    return np.maximum.accumulate(np.where(changed, np.arange(len(changed)), 0))


def _sorted_suffixes(
    codes: np.ndarray, text_of: np.ndarray, some: np.ndarray, size: int
) -> tuple[np.ndarray, list[np.ndarray]]:
    """The positions in suffix order, and their ranks by grams of size, 2 * size, ...

    Two ranks of a round are equal if and only if the grams are; a position that takes no
    part has a rank of its own. Sorted with ``some`` are the positions a gram later, so
    that suffixes with the same words beyond a gram stay together.
    """
    end = len(codes)
    ranks = -1 - np.arange(end + 1)
    more = np.union1d(some, some[some + size < end] + size)
    grams = [text_of[more]]
    for k in range(size):
        at = np.minimum(more + k, end - 1)
        grams.append(np.where((more + k < end) & (text_of[at] == text_of[more]), codes[at], -1))
    by = np.lexsort(grams[::-1])
    order = more[by]
    changed = np.ones(len(order), bool)
    changed[1:] = np.any([g[by[1:]] != g[by[:-1]] for g in grams], axis=0)
    ranks[order] = _starts(changed)
    rounds, width = [ranks], size
    tied = order
    while len(tied):
        first = ranks[tied]
        group = np.ones(len(tied), bool)
        group[1:] = first[1:] != first[:-1]
        alone = group & np.append(group[1:], True)
        tied, first = tied[~alone], first[~alone]
        if not len(tied):
            break
        second = ranks[np.minimum(tied + width, end)]
        by = np.lexsort((second, first))
        tied, first, second = tied[by], first[by], second[by]
        group = np.ones(len(tied), bool)
        group[1:] = first[1:] != first[:-1]
        part = group.copy()
        part[1:] |= second[1:] != second[:-1]
        ranks = ranks.copy()
        ranks[tied] = first + _starts(part) - _starts(group)
        rounds.append(ranks)
        width *= 2
    return some[np.argsort(ranks[some], kind="stable")], rounds


def _common(
    left: np.ndarray, right: np.ndarray, codes: np.ndarray, text_of: np.ndarray,
    rounds: list[np.ndarray], size: int,
) -> np.ndarray:
    """Words that the suffixes at ``left`` and ``right`` have in common, pair by pair."""
    end = len(codes)
    same = np.zeros(len(left), np.int64)
    for k in range(len(rounds) - 1, -1, -1):
        ranks = rounds[k]
        i, j = np.minimum(left + same, end), np.minimum(right + same, end)
        same += np.where((ranks[i] == ranks[j]) & (i != j), size << k, 0)
    on = same > 0
    for _ in range(size - 1):  # what is left is shorter than a gram
        i, j = left + same, right + same
        on &= (i < end) & (j < end)
        i, j = np.where(on, i, 0), np.where(on, j, 0)
        on &= (codes[i] == codes[j]) & (text_of[i] == text_of[left]) & (text_of[j] == text_of[left])
        same += on
    return same


class _Classes:
    """Union-find over positions; a class keeps its positions in order."""

    def __init__(self):
        self.parent: dict[int, int] = {}
        self.positions: dict[int, list[int]] = {}

    def find(self, at: int) -> int:
        parent = self.parent
        root = at
        while parent.setdefault(root, root) != root:
            root = parent[root]
        while at != root:
            parent[at], at = root, parent[at]
        return root

    def unite(self, left: int, right: int) -> list[tuple[int, int]]:
        """Joins two classes; returns the pairs of positions that are neighbours now."""
        a, b = self.find(left), self.find(right)
        large = self.positions.pop(a, None) or [a]
        small = self.positions.pop(b, None) or [b]
        if len(large) < len(small):
            a, b, large, small = b, a, small, large
        self.parent[b] = a
        self.positions[a] = large
        pairs = []
        for k, x in enumerate(small):
            at = bisect(large, x)
            if at and not (k and large[at - 1] == small[k - 1]):  # those two were so before
                pairs.append((large[at - 1], x))
            if at < len(large) and (k + 1 == len(small) or large[at] < small[k + 1]):
                pairs.append((x, large[at]))
            large.insert(at, x)
        return pairs


def find_runs(
    texts: list[list[str]], least_length: int = LEAST_LENGTH, least_exponent: int = LEAST_EXPONENT
) -> list[list[Run]]:
    """The runs of each list of words, by start and period."""
    out: list[list[Run]] = [[] for _ in texts]
    size = _shortest(least_length, least_exponent)
    lengths = [len(t) for t in texts]
    text_of = np.repeat(np.arange(len(texts)), lengths)
    codes = pd.factorize(np.array([w for t in texts for w in t], object))[0].astype(np.int64)
    some = _grams(codes, text_of, size)
    if not len(some):
        return out
    order, rounds = _sorted_suffixes(codes, text_of, some, size)
    left, right = order[:-1], order[1:]
    common = _common(left, right, codes, text_of, rounds, size)
    kept = np.flatnonzero(common >= size)
    kept = kept[np.argsort(-common[kept], kind="stable")]
    begin = np.cumsum([0, *lengths])
    classes = _Classes()
    found: set[tuple[int, int, int]] = set()
    for i, j, same in zip(left[kept].tolist(), right[kept].tolist(), common[kept].tolist()):
        for first, second in classes.unite(i, j):
            period = second - first
            if (period * (least_exponent - 1) <= same and period + same >= least_length
                    and (first == begin[text_of[first]] or codes[first - 1] != codes[second - 1])):
                found.add((first, period, same + period))
    for first, period, length in sorted(found):
        text = text_of[first]
        out[text].append((int(first - begin[text]), length, period))
    return out


def strongest(runs: list[Run]) -> Run | None:
    """The run with the greatest length over period; of equals the first, then the shorter period."""
    best = None
    for run in runs:  # by start and period, so a later equal does not win
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapse(words: list[str], runs: list[Run]) -> str:
    """The words without those that a run holds after its first period."""
    if not runs:
        return " ".join(words)
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return " ".join([w for w, inside in zip(words, np.cumsum(edges).tolist()) if not inside])


def _blocks(texts: list[str | None]) -> Iterator[list[list[str]]]:
    block, n = [], 0
    for text in texts:
        block.append(_WORDS.findall(text or ""))
        n += len(block[-1])
        if n >= BLOCK:
            yield block
            block, n = [], 0
    if block:
        yield block


def _structs(runs: list[Run | None]) -> pa.Array:
    return pa.array(
        [None if r is None else dict(zip(("start", "length", "period"), r)) for r in runs], _RUN)


def with_runs(
    df: DataFrame, text: str = "text", least_length: int = LEAST_LENGTH,
    least_exponent: int = LEAST_EXPONENT,
) -> DataFrame:
    """All rows and columns, and ``periodic``: n_words, runs, the strongest run, collapsed text.

    ``least_exponent`` must be 2 or more.
    """
    if least_exponent < 2:
        raise ValueError("a run holds its period twice at least")

    @F.arrow_udf(TYPE)
    def periodic(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            sizes, runs, collapsed = [], [], []
            for block in _blocks(batch.to_pylist()):
                found = find_runs(block, least_length, least_exponent)
                sizes += [len(words) for words in block]
                runs += found
                collapsed += [collapse(words, of) for words, of in zip(block, found)]
            offsets = np.cumsum([0, *[len(of) for of in runs]])
            flat = [run for of in runs for run in of]
            yield pa.StructArray.from_arrays(
                [pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), _structs(flat)),
                 _structs([strongest(of) for of in runs]), pa.array(collapsed, pa.string())],
                ["n_words", "runs", "strongest", "collapsed"])

    return df.withColumn("periodic", periodic.asNondeterministic()(F.col(f"`{text}`")))
