"""Best-fit packing of documents into training bins under conflicts.

Texts longer than a bin are cut into pieces of a bin's length; full pieces are
bins of their own. Of the rest, a bin holds at most one piece of a source and
one of a cluster of copies. Pieces are placed longest first. Open bins are kept
in order of their residual space, each with a bitmap of its sources and one of
its clusters; the search starts at the smallest residual that fits and goes on
to the next larger one until both bitmaps allow the piece. So a piece goes to
the tightest compatible bin, or opens a new one.

Best fit is sequential, so pieces are dealt at random to packs of about
``PACK_ROWS`` rows, each packed by one call. The number of packs grows with the
data; one source or cluster with a third of all rows is spread over all packs.
Only ids, lengths, sources and clusters are shuffled, never texts.

A document without words (null, empty) has one row with length 0 and no bin. A
null source or cluster conflicts with nothing. Repeated rows are pieces of their
own; a repeated text is a cluster. Other columns are ignored. Ties go by id.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealglass.llm.common import SPACE_WORD, matches, store

CAPACITY = 2048  # words
PACK_ROWS = 2048


def place(lengths: list[int], sources: list[int], clusters: list[int], capacity: int) -> list[int]:
    """The bin of each piece, given longest first. Bits are 0 where nothing conflicts."""
    order: list[tuple[int, int]] = []  # (residual, bin)
    in_source: list[int] = []
    in_cluster: list[int] = []
    out = []
    for length, source, cluster in zip(lengths, sources, clusters):
        at = bisect_left(order, (length, -1))
        while at < len(order):
            bin_ = order[at][1]
            if not (in_source[bin_] & source or in_cluster[bin_] & cluster):
                break
            at += 1
        if at < len(order):
            residual, bin_ = order.pop(at)
            in_source[bin_] |= source
            in_cluster[bin_] |= cluster
        else:
            residual, bin_ = capacity, len(in_source)
            in_source.append(source)
            in_cluster.append(cluster)
        if residual > length:
            insort(order, (residual - length, bin_))
        out.append(bin_)
    return out


def _bits(values: pd.Series) -> list[int]:
    """One bit per value that occurs twice or more; no bit for nulls and the rest."""
    counts = values.value_counts()
    bit = {v: 1 << i for i, v in enumerate(counts.index[counts.values > 1])}
    return [bit.get(v, 0) for v in values]


def _pack(capacity: int):
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(
            ["length", "row", "piece"], ascending=[False, True, True], ignore_index=True)
        bins = place(
            rows["length"].tolist(), _bits(rows["source"]), _bits(rows["cluster"]), capacity)
        rows["number"] = bins
        rows["start"] = rows.groupby("number")["length"].cumsum() - rows["length"]
        return rows[["row", "piece", "pack", "number", "start"]]

    return pack


def pieces(docs: DataFrame, capacity: int, doc_id: str, text: str, source: str,
           cluster: str | None) -> DataFrame:
    """Slim pieces, stored: row, doc_id, source, cluster, piece, length."""
    col = F.col(f"`{text}`")
    copies = F.col(f"`{cluster}`").cast("string") if cluster else F.md5(col.cast("binary"))
    slim = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.col(f"`{source}`").cast("string").alias("source"),
        copies.alias("cluster"),
        F.size(matches(col, SPACE_WORD)).alias("words"),
    )
    last = F.greatest(F.ceil(F.col("words") / capacity), F.lit(1)) - 1
    each = slim.withColumn("piece", F.explode(F.sequence(F.lit(0), last.cast("int"))))
    length = F.least(F.col("words") - F.col("piece") * capacity, F.lit(capacity))
    return store(
        each.select("row", "doc_id", "source", "cluster", "piece", length.alias("length")),
        "pieces")


def pack(
    docs: DataFrame, capacity: int = CAPACITY, pack_rows: int = PACK_ROWS,
    doc_id: str = "doc_id", text: str = "text", source: str = "source",
    cluster: str | None = None,
) -> DataFrame:
    """One row per piece: doc_id, source, piece, length (words), bin, start in the bin.

    ``cluster`` names a column of copy groups; without it equal texts are copies.
    """
    every = pieces(docs, capacity, doc_id, text, source, cluster)
    partial = every.filter((F.col("length") > 0) & (F.col("length") < capacity))
    packs = max(1, -(-partial.count() // pack_rows))
    dealt = partial.withColumn(
        "pack", F.pmod(F.xxhash64("row", "piece"), F.lit(packs)).cast("int"))
    bins = dealt.select("row", "piece", "pack", "length", "source", "cluster").groupBy(
        "pack").applyInPandas(
        _pack(capacity), "row long, piece int, pack int, number int, start long")
    bins = bins.select(
        "row", "piece", F.concat_ws("-", F.lit("p"), "pack", "number").alias("bin"), "start")
    whole = every.filter(F.col("length") == capacity).select(
        "row", "piece", F.concat_ws("-", F.lit("f"), "row", "piece").alias("bin"),
        F.lit(0).cast("long").alias("start"))
    return every.join(bins.unionByName(whole), ["row", "piece"], "left").select(
        "doc_id", "source", "piece", F.col("length").cast("long").alias("length"), "bin", "start")
