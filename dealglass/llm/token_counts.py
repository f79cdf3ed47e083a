"""Token counts by a longest-match automaton, without building the pieces.

The vocabulary is a trie of byte strings: pieces that begin a word and pieces
that continue one. Every node knows how many pieces of the longest-match split
of its string are final (``pops``) and the node of the unfinished rest (its
failure link). A word is read once, byte by byte; where the trie has no edge,
the count grows by ``pops`` and reading goes on at the failure link. So the time
is linear in the bytes, however long the word.

The count of a word is that of greedy longest match from the left. A word that
cannot be split is one unknown token. Words stand between ASCII white space,
which is not counted. The automaton is built once from a vocabulary file whose
path is a parameter, and broadcast; its size is that of the vocabulary.

A null or empty text has no words and no tokens. Rows and their other columns
pass through unchanged, repeated rows included. Long texts are read as a whole.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
KNOWN_WORDS = 200_000  # words whose counts a task remembers
LONG_WORD = 48  # longer ones are not remembered
COUNTS = "n_words long, n_tokens long"


@dataclass
class Automaton:
    edges: dict[int, int]  # node * 256 + byte -> node
    fails: array  # -1: none
    pops: array
    begin: int  # node before a word's first byte
    inside: int  # node where a piece has just ended
    prefix: bytes  # read before every word

    def count(self, word: str) -> int:
        """Tokens of one word; one if it cannot be split."""
        edges, fails, pops = self.edges, self.fails, self.pops
        node, n = self.begin, 0
        for byte in self.prefix + word.encode("utf-8", "surrogatepass"):
            step = edges.get(node << 8 | byte)
            while step is None:
                if fails[node] < 0:
                    return 1
                n += pops[node]
                node = fails[node]
                step = edges.get(node << 8 | byte)
            node = step
        while node != self.inside:
            if fails[node] < 0:
                return 1
            n += pops[node]
            node = fails[node]
        return n


def build(begin: Iterable[bytes], inside: Iterable[bytes] | None, prefix: bytes = b"") -> Automaton:
    """The automaton of pieces that begin words and pieces inside words.

    ``inside`` None: one set of pieces for both places.
    """
    edges: dict[int, int] = {}
    ends = bytearray(1 if inside is None else 2)
    parent, byte_of = array("l", [-1] * len(ends)), bytearray(len(ends))
    roots = [0] if inside is None else [0, 1]
    for root, pieces in zip(roots, [begin] if inside is None else [begin, inside]):
        for piece in pieces:
            node = root
            for byte in piece:
                key = node << 8 | byte
                if key not in edges:
                    edges[key] = len(ends)
                    ends.append(0)
                    parent.append(node)
                    byte_of.append(byte)
                node = edges[key]
            if node != root:
                ends[node] = 1
    within = roots[-1]
    fails, pops = array("l", [-1] * len(ends)), array("l", [0] * len(ends))
    # A node's link leads to a shorter string, so links are made by length.
    depth = array("l", [0] * len(ends))
    for node in range(len(roots), len(ends)):
        depth[node] = depth[parent[node]] + 1
    for node in sorted(range(len(roots), len(ends)), key=depth.__getitem__):
        if ends[node]:
            fails[node], pops[node] = within, 1
            continue
        rest, n = fails[parent[node]], pops[parent[node]]
        while rest >= 0 and (rest << 8 | byte_of[node]) not in edges:
            n += pops[rest]
            rest = fails[rest]
        if rest >= 0:
            fails[node], pops[node] = edges[rest << 8 | byte_of[node]], n
    return Automaton(edges, fails, pops, roots[0], within, prefix)


def load(path: str = VOCABULARY) -> Automaton:
    """From a file of lines "base64 rank"; pieces with a leading space begin words."""
    with open(path, "rb") as lines:
        pieces = [base64.b64decode(line.split()[0]) for line in lines if line.strip()]
    return build(pieces, None, b" ")


def counter(df: DataFrame, automaton: Automaton):
    """A column function: text to a struct of ``COUNTS``."""
    shared = df.sparkSession.sparkContext.broadcast(automaton)

    @F.pandas_udf(COUNTS)
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        machine, known = shared.value, {}
        for batch in batches:
            rows = []
            for text in batch:
                words = WORD.findall(text) if text else ()
                total = 0
                for word in words:
                    n = known.get(word)
                    if n is None:
                        n = machine.count(word)
                        if len(word) <= LONG_WORD:
                            if len(known) >= KNOWN_WORDS:
                                known.clear()
                            known[word] = n
                    total += n
                rows.append((len(words), total))
            yield pd.DataFrame(rows, columns=["n_words", "n_tokens"])

    return count.asNondeterministic()  # so that a filter does not run it again


def with_counts(df: DataFrame, automaton: Automaton | None = None, text: str = "text") -> DataFrame:
    """All rows and columns, and a struct ``tokens`` of ``COUNTS``, which replaces one so named."""
    count = counter(df, automaton or load())
    return df.withColumn("tokens", count(F.col(f"`{text}`")))
