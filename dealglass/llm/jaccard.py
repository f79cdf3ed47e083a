"""N-gram Jaccard join by a MinHash LSH forest, with exact verification.

Texts are sets of shingles (``WIDTH`` words between ASCII white space; a text of
fewer words, but not none, is one shingle). Equal sets are joined as one.

*Forest.* Each set has a signature of ``TREES`` labels of ``DEPTH`` minimum hashes.
A tree is the sorted order of all its labels: sets under one node of the prefix
trie stand together. The prefix that must match is shortened from the full label
one hash at a time until sets at the threshold share a node in some tree with
probability ``RECALL``; by then sets under a node are candidates.

*Verification.* Candidates linked by nodes form candidate components (links from
each node's members to its first one, so no pairs are made). Inside a component
all pairs are compared exactly, as products of shingle matrices: small components
many to a task, large ones in blocks of ``BLOCK`` sets, each pair of blocks its own
group. So a component of any size is spread over tasks, and what leaves a task
are counts per set and a spanning forest of the links it found, not pairs.

The result is one row per document: its class (documents linked directly or by
way of others), the size of that class, and its numbers of links: ``n_links`` to
other documents with a similarity of at least the threshold, copies included,
and ``n_text_links`` to other shingle sets.

Links between sets at the threshold or above are missed with a probability of at
most 1 - ``RECALL`` each, less if a way of candidates joins them; no link that is
reported is wrong, but for collisions of 64-bit shingle hashes.

A null text, or one without words, is a class of its own without links. A null id
is a value like others; ``class_id``, the smallest id of the class, is null if no
member has one, ``class_key`` never. Repeated rows are documents of their own and
copies of each other. Other columns are ignored by ``join`` and kept by
``keep_one``. Empty tables give an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealglass.llm.common import store
from dealglass.llm.components import components

WIDTH = 5
THRESHOLD = Fraction(4, 5)
TREES = 24
DEPTH = 6
RECALL = 0.9999
BLOCK = 256  # sets per side of a comparison
GROUP = 1024  # sets of small components per task, about
COLUMNS = 8192  # shingles per matrix product
KNOWN_WORDS = 300_000

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_random = np.random.default_rng(7)
_FACTORS = _random.integers(1, 1 << 32, TREES * DEPTH, dtype=np.uint64).astype(np.uint32) | 1
_MASKS = _random.integers(0, 1 << 32, TREES * DEPTH, dtype=np.uint64).astype(np.uint32)


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


_hashes = _Hashes()


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    words = _WORD.findall(text) if text else []
    if len(_hashes) > KNOWN_WORDS:
        _hashes.clear()
    each = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    width = min(WIDTH, len(words))
    if not width:
        return each
    count = len(words) - width + 1
    mixed = np.zeros(count, np.uint64)
    for i in range(width):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + each[i:i + count]
        mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(mixed ^ (mixed >> np.uint64(32)))


def signature(found: np.ndarray) -> bytes:
    """Labels of all trees, one after the other, as big-endian 32-bit numbers."""
    low = (found ^ (found >> np.uint64(31))).astype(np.uint32)
    least = np.full(TREES * DEPTH, 0xFFFFFFFF, np.uint32)
    for begin in range(0, len(low), COLUMNS):
        part = low[begin:begin + COLUMNS]
        mixed = (part[None, :] ^ _MASKS[:, None]) * _FACTORS[:, None]
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(0x2C1B3C6D)
        np.minimum(least, mixed.min(axis=1), out=least)
    return least.astype(">u4").tobytes()


def matched_prefix(threshold: float = float(THRESHOLD), recall: float = RECALL) -> int:
    """The longest prefix with which the forest reaches the target recall."""
    depth = DEPTH
    while depth > 1 and 1 - (1 - threshold**depth) ** TREES < recall:
        depth -= 1
    return depth


def _signed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for text in batch:
            found = shingles(text)
            if len(found):
                rows.append((xxhash.xxh3_128_digest(found.tobytes()), signature(found)))
            else:
                rows.append((None, None))
        yield pd.DataFrame(rows, columns=["set_hash", "labels"], dtype=object)


def signatures(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Slim rows, stored: row, id, fp (hash of the text), set_hash, labels."""
    sign = F.pandas_udf(_signed, "set_hash binary, labels binary")
    col = F.col(f"`{text}`")
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("id"), F.xxhash64(F.coalesce(col, F.lit(""))).alias("fp"),
        sign(col).alias("s"))
    return store(rows.select(
        F.monotonically_increasing_id().alias("row"), "id", "fp", "s.set_hash", "s.labels"),
        "signatures")


def distinct_sets(rows: DataFrame) -> DataFrame:
    """One row per shingle set, stored: set (its first row), id and fp of a text
    that has it, copies, labels."""
    sets = rows.filter("set_hash is not null").groupBy("set_hash").agg(
        F.min(F.struct("row", "id", "fp")).alias("first"), F.count("*").alias("copies"),
        F.first("labels").alias("labels"))
    return store(sets.select(
        "set_hash", F.col("first.row").alias("set"), "first.id", "first.fp", "copies", "labels"),
        "sets")


def _nodes(prefix: int):
    """Links members of a trie node to its smallest set; rows come in sorted order.

    A node may go on in the next task, so the first and last node of each batch
    also leave a row (tree, prefix) to be met by others.
    """
    size = 4 * prefix

    def linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            sets = batch["set"].to_numpy()
            tree = batch["tree"].to_numpy()
            label = b"".join(x[:size] for x in batch["label"])
            words = np.frombuffer(label, ">u4").reshape(len(batch), prefix)
            new = np.ones(len(batch), bool)
            new[1:] = (tree[1:] != tree[:-1]) | (words[1:] != words[:-1]).any(axis=1)
            begin = np.flatnonzero(new)
            least = np.minimum.reduceat(sets, begin)
            to = np.repeat(least, np.diff(np.append(begin, len(sets))))
            other = to != sets
            edge = [0, len(begin) - 1] if len(begin) > 1 else [0]
            at = begin[edge]
            yield pd.DataFrame({
                "a": np.concatenate((sets[other], least[edge])),
                "b": pd.array(np.concatenate((to[other], least[edge])), "Int64"),
                "tree": pd.array(
                    [None] * int(other.sum()) + tree[at].tolist(), "Int32"),
                "node": [None] * int(other.sum()) + [label[i * size:(i + 1) * size] for i in at],
            })

    return linked


def candidate_links(sets: DataFrame, prefix: int) -> DataFrame:
    """Links (a, b) that join all sets under each node of the forest."""
    tree = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    labels = sets.select("set", "labels", tree).select(
        "set", "tree", F.substring("labels", F.col("tree") * (4 * DEPTH) + 1, F.lit(4 * DEPTH))
        .alias("label"))
    # The set itself is the last sort key, so even equal labels can be dealt out.
    ordered = labels.repartitionByRange("tree", "label", "set").sortWithinPartitions(
        "tree", "label", "set")
    found = store(ordered.mapInPandas(
        _nodes(prefix), "a long, b long, tree int, node binary").distinct(), "links")
    rims = found.filter("node is not null")
    met = rims.join(rims.groupBy("tree", "node").agg(F.min("a").alias("least")), ["tree", "node"])
    return found.filter("node is null").select("a", "b").unionByName(
        met.select("a", F.col("least").alias("b")).filter("a <> b")).distinct()


def _common(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the left with the right sets (by index)."""
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, counts = np.unique(every, return_inverse=True, return_counts=True)
    shared = counts > 1  # other shingles are in no intersection
    number = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column = owner[keep], number[column[keep]]
    out = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = int(shared.sum())
    for begin in range(0, total, COLUMNS):
        a, b = np.searchsorted(column, (begin, begin + COLUMNS))
        part = np.zeros((len(sets), min(COLUMNS, total - begin)), np.float32)
        part[owner[a:b], column[a:b] - begin] = 1
        out += part[left] @ part[right].T
    return np.rint(out).astype(np.int64)


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Links that join what all links (a, b) among n nodes join."""
    up = list(range(n))

    def top(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    kept = []
    for x, y in zip(a.tolist(), b.tolist()):
        p, q = top(x), top(y)
        if p != q:
            up[max(p, q)] = min(p, q)
            kept.append((x, y))
            if len(kept) == n - 1:
                break
    return kept


def _compared(rows: pd.DataFrame, num: int, den: int) -> tuple[list, np.ndarray, np.ndarray]:
    """Forest of links, and numbers of linked sets and documents per row.

    Rows of side 0 and 1 are two blocks to compare with each other; side 2 alone
    stands for all pairs within.
    """
    sets = [shingles(t) for t in rows["text"]]
    size = np.array([len(s) for s in sets])
    side = rows["side"].to_numpy()
    left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    common = _common(sets, left, right)
    linked = common * (num + den) >= num * (size[left][:, None] + size[right][None, :])
    linked &= left[:, None] != right[None, :]
    copies = rows["copies"].to_numpy()
    texts, docs = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    texts[left] += linked.sum(axis=1)
    docs[left] += linked @ copies[right]
    if (side != 2).any():
        texts[right] += linked.sum(axis=0)
        docs[right] += copies[left] @ linked
    a, b = np.nonzero(linked)
    return _forest(left[a], right[b], len(rows)), texts, docs


def _verified(num: int, den: int):
    def verify(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, part in rows.groupby("component", sort=False):
            part = part.reset_index(drop=True)
            ids = part["set"].to_numpy()
            links, texts, docs = _compared(part, num, den)
            out += [(ids[a], ids[b], 0, 0) for a, b in links]
            out += [(ids[i], None, texts[i], docs[i]) for i in np.flatnonzero(texts)]
        frame = pd.DataFrame(out, columns=["a", "b", "texts", "docs"])
        return frame.astype({"a": "int64", "b": "Int64", "texts": "int64", "docs": "int64"})

    return verify


def verified(
    docs: DataFrame, sets: DataFrame, members: DataFrame, doc_id: str, text: str,
    threshold: Fraction,
) -> DataFrame:
    """Rows (a, b) of a spanning forest of the links in each candidate component,
    and rows (a, null, texts, docs) with parts of each set's numbers of links."""
    # Grouped sides of joins are stored, so that Spark can split a very large group.
    sizes = store(members.groupBy("root").agg(F.count("*").alias("size")), "sizes")
    known = members.join(sizes, "root").select(
        F.col("node").alias("set"), F.col("root").alias("component"), "size")
    known = known.join(sets.select("set", "id", "fp", "copies"), "set")
    col = F.col(f"`{text}`")
    texts = docs.select(
        F.col(f"`{doc_id}`").alias("t_id"), F.xxhash64(F.coalesce(col, F.lit(""))).alias("t_fp"),
        col.alias("text"))
    read = texts.join(
        known, F.col("t_id").eqNullSafe(F.col("id")) & (F.col("t_fp") == F.col("fp")))
    # Repeated rows: one text of each set is enough.
    one = read.groupBy("set", "component", "size", "copies").agg(F.first("text").alias("text"))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    one = one.withColumn("blocks", blocks).withColumn(
        "block", F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int"))
    total = members.count()
    tasks = max(1, -(-total // GROUP))
    small = one.filter("blocks = 1").withColumn("side", F.lit(2)).withColumn(
        "group", F.concat_ws("-", F.lit("s"), F.pmod(F.xxhash64("component"), F.lit(tasks))))
    large = one.filter("blocks > 1").withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    side = F.when(low == high, 2).when(F.col("block") == low, 0).otherwise(1)
    large = large.withColumn("side", side).withColumn(
        "group", F.concat_ws("-", F.lit("l"), "component", low, high)).drop("other")
    wanted = ["group", "component", "set", "side", "copies", "text"]
    both = small.select(*wanted).unionByName(large.select(*wanted))
    return store(both.groupBy("group").applyInPandas(
        _verified(threshold.numerator, threshold.denominator),
        "a long, b long, texts long, docs long"), "verified")


def classes(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
    threshold: Fraction = THRESHOLD, recall: float = RECALL,
) -> DataFrame:
    """One row per document: row, id, fp, class_key, n_text_links, n_links."""
    rows = signatures(docs, doc_id, text)
    sets = distinct_sets(rows)
    links = candidate_links(sets, matched_prefix(float(threshold), recall))
    found = verified(docs, sets, components(links), doc_id, text, threshold)
    roots = components(found.filter("b is not null").select("a", "b"))
    counts = found.filter("b is null").groupBy("a").agg(
        F.sum("texts").alias("texts"), F.sum("docs").alias("docs"))
    by_set = sets.select("set", "set_hash", "copies").join(
        roots, F.col("set") == F.col("node"), "left").join(
        counts, F.col("set") == F.col("a"), "left")
    by_set = by_set.select(
        "set_hash", F.coalesce("root", "set").alias("class_key"),
        F.coalesce("texts", F.lit(0)).alias("n_text_links"),
        (F.coalesce("docs", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return rows.drop("labels").join(by_set, "set_hash", "left").select(
        "row", "id", "fp", F.coalesce("class_key", "row").alias("class_key"),
        F.coalesce("n_text_links", F.lit(0)).alias("n_text_links"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"))


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
         threshold: Fraction = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row per document: class_id, class_key, class_size and numbers of links."""
    each = store(classes(docs, doc_id, text, threshold, recall), "classes")
    whole = store(each.groupBy("class_key").agg(
        F.min("id").alias("class_id"), F.count("*").alias("class_size")), "class-sizes")
    return each.join(whole, "class_key").select(
        F.col("id").alias("doc_id"), "class_id", "class_key", "class_size", "n_text_links",
        "n_links")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
             threshold: Fraction = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One document of each class (the smallest id, then text hash), its own columns."""
    each = store(classes(docs, doc_id, text, threshold, recall), "classes")
    first = each.groupBy("class_key").agg(F.min(F.struct("id", "fp")).alias("first"))
    kept = first.select(F.col("first.id").alias("k_id"), F.col("first.fp").alias("k_fp"))
    kept = kept.distinct()
    # Rows to drop: of other texts, and all but one of repeated rows.
    repeated = each.groupBy("id", "fp").agg(F.count("*").alias("n"))
    same = F.col("id").eqNullSafe(F.col("k_id")) & (F.col("fp") == F.col("k_fp"))
    marks = repeated.join(kept, same, "left").filter("k_fp is null or n > 1").select(
        F.col("id").alias("m_id"), F.col("fp").alias("m_fp"),
        F.col("k_fp").isNotNull().alias("repeated"))
    packed = docs.select(
        F.struct("*").alias("__row"), F.col(f"`{doc_id}`").alias("__id"),
        F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("__fp"))
    marked = packed.join(
        marks, F.col("__id").eqNullSafe(F.col("m_id")) & (F.col("__fp") == F.col("m_fp")), "left")
    single = marked.filter("repeated is null").select("__row.*")
    some = marked.filter("repeated").groupBy("__id", "__fp").agg(F.first("__row").alias("__row"))
    return single.unionByName(some.select("__row.*"))
