"""Benchmark decontamination with a positional inverted index of the corpus.

A *window* is ``width`` consecutive words of a test item (the whole item where
it is shorter). The index stores, for the terms that the windows are looked up
by, one posting per occurrence: term, document, word position. A window is
looked up from its rarest term: its postings minus the term's offset are the
candidate starts, which are then intersected with the offset-adjusted postings
of the next rarest terms, as equi-joins on (document, term, position). The
postings of rarest terms carry the words around them, so what is left is checked
against the whole window without reading the texts again.

Every join key holds the document and the position, so neither a passage shared
by many documents nor a very frequent word meets in one task; the one lookup by
term alone is a broadcast of the test terms while those are few, and is salted
by document beyond ``MAX_BROADCAST_TERMS``.

Documents are known by (id, hash of the text): repeated rows share postings and
each gets its result row; null ids are ordinary values. A null or empty text has
no words. Items without words have no window; an item without an id marks words
as hit but is not counted in ``n_items``. Other columns are ignored by ``scan``
and left alone by ``drop_contaminated``. Empty tables give no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dealglass.llm.common import lower_ascii, store

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WIDTH = 13
PROBES = 3  # rarest terms whose postings are intersected before the exact check
MIN_SHARE = 20  # contaminated: one in so many words, or more, is hit
MAX_BROADCAST_TERMS = 200_000  # about 20 MB
SALTS = 32
KEY = ["__id", "__fp"]


def spaced(text: Column) -> Column:
    """The words with one space between them; empty for a null text."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    low = F.when(ascii_only, F.lower(text)).otherwise(lower_ascii(text))
    return F.coalesce(F.trim(F.regexp_replace(low, BETWEEN, " ")), F.lit(""))


def split_words(words: Column) -> Column:
    none = F.array().cast("array<string>")
    return F.when(words == "", none).otherwise(F.split(words, " ", -1))


def tokens(text: Column) -> Column:
    return split_words(spaced(text))


def fingerprint(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(id, fingerprint, number of words, words) of each row.

    The words are stored with single spaces between them: reading them again is
    several times cheaper than finding them in the text again.
    """
    col = F.col(f"`{text}`")
    slim = docs.select(
        F.col(f"`{doc_id}`").alias("__id"), fingerprint(col).alias("__fp"),
        spaced(col).alias("__spaced"))
    gaps = F.length("__spaced") - F.length(F.replace(F.col("__spaced"), F.lit(" ")))
    n = F.when(F.col("__spaced") == "", 0).otherwise(gaps + 1).cast("long")
    return store(slim.withColumn("__n", n), "words").select(
        *KEY, "__n", split_words(F.col("__spaced")).alias("__words"))


def windows(items: DataFrame, item_id: str, text: str, width: int = WIDTH) -> DataFrame:
    """Distinct windows: words, and the sorted ids (as text) of items that hold them."""
    words = items.select(
        F.col(f"`{item_id}`").cast("string").alias("item"), tokens(F.col(f"`{text}`")).alias("w"))
    words = words.filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - width + 1, F.lit(1)))
    each = words.select("item", F.explode(
        F.transform(starts, lambda i: F.slice("w", i, width))).alias("words"))
    found = each.groupBy("words").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return found.select(F.xxhash64("words").alias("window"), "words", "items")


def _few(terms: DataFrame) -> bool:
    return terms.limit(MAX_BROADCAST_TERMS + 1).count() <= MAX_BROADCAST_TERMS


# The outer forms of explode: the plain ones have Spark check the array in a filter of
# its own first, for which the words are split a second time.
def term_counts(corpus: DataFrame, terms: DataFrame, few: bool) -> DataFrame:
    """How often each test term occurs in the corpus (absent terms: no row)."""
    each = corpus.select(F.explode_outer("__words").alias("term"))
    if few:
        return each.join(F.broadcast(terms), "term").groupBy("term").agg(F.count("*").alias("tf"))
    return each.groupBy("term").agg(F.count("*").alias("tf")).join(terms, "term")


def probes(wins: DataFrame, counts: DataFrame, n: int | None = PROBES) -> DataFrame:
    """The ``n`` rarest terms of each window (all: None) with their offsets.

    Columns: words, size, rarity (0 is the rarest), term, offset. A window with
    a term that the corpus lacks cannot occur and is left out.
    """
    each = wins.select("words", F.posexplode("words").alias("offset", "term"))
    # A term twice in a window: its first offset.
    each = each.groupBy("words", "term").agg(F.min("offset").alias("offset"))
    each = each.join(counts, "term", "left")
    by_rarity = W.partitionBy("words").orderBy("tf", "term")
    each = each.withColumn("rarity", F.row_number().over(by_rarity) - 1)
    each = each.withColumn(
        "absent", F.max(F.col("tf").isNull()).over(W.partitionBy("words"))).filter("not absent")
    if n is not None:
        each = each.filter(F.col("rarity") < n)
    return each.select("words", F.size("words").alias("size"), "rarity", "term", "offset")


def build_index(corpus: DataFrame, probe: DataFrame, few: bool, context: bool = True) -> DataFrame:
    """Postings (term, document, position, around, from) of the probed terms, stored.

    ``around`` holds the words from position ``from``, as far as the windows
    reach that are looked up by this term first; null for other terms.
    """
    first = F.when(F.col("rarity") == 0, F.lit(True))
    reach = probe.groupBy("term").agg(
        F.max(F.when(first, F.col("offset"))).alias("left"),
        F.max(F.when(first, F.col("size") - F.col("offset"))).alias("right"),
    )
    each = corpus.select(*KEY, "__words", F.posexplode_outer("__words").alias("position", "term"))
    if few:
        held = each.join(F.broadcast(reach), "term")
    else:
        salted = reach.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salt = F.pmod(F.xxhash64(*KEY, "position"), F.lit(SALTS)).cast("int")
        # Positions only: the words around a posting are looked up by document.
        held = each.drop("__words").withColumn("__salt", salt).join(salted, ["term", "__salt"])
        texts = corpus.select(
            F.col("__id").alias("t_id"), F.col("__fp").alias("t_fp"), "__words").dropDuplicates(
            ["t_id", "t_fp"])
        held = held.join(
            texts, F.col("__id").eqNullSafe(F.col("t_id")) & (F.col("__fp") == F.col("t_fp")))
    begin = F.greatest(F.col("position") - F.col("left"), F.lit(0))
    around = F.slice("__words", begin + 1, F.col("position") + F.col("right") - begin)
    return store(
        held.select(
            "term", *KEY, "position",
            (F.when(F.col("left").isNotNull(), around) if context
             else F.lit(None).cast("array<string>")).alias("around"),
            F.when(F.col("left").isNotNull(), begin).alias("from"),
        ),
        "postings",
    )


def _starts(index: DataFrame, probe: DataFrame, few: bool) -> DataFrame:
    """Candidate starts of each window, from its rarest term."""
    rarest = probe.filter("rarity = 0").select("words", "size", "term", "offset")
    if few:
        found = index.join(F.broadcast(rarest), "term")
    else:
        salted = rarest.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salt = F.pmod(F.xxhash64(*KEY, "position"), F.lit(SALTS)).cast("int")
        found = index.withColumn("__salt", salt).join(salted, ["term", "__salt"])
    found = found.withColumn("start", F.col("position") - F.col("offset"))
    return found.filter("start >= 0").select(*KEY, "words", "size", "start", "around", "from")


def phrase_matches(index: DataFrame, probe: DataFrame, few: bool, n: int = PROBES) -> DataFrame:
    """Exact occurrences (document, words, size, start), each once."""
    found = _starts(index, probe, few)
    postings = index.select(
        F.col("__id").alias("p_id"), F.col("__fp").alias("p_fp"),
        F.col("term").alias("p_term"), F.col("position").alias("p_position"))
    rest = probe.filter((F.col("rarity") > 0) & (F.col("rarity") < n)).groupBy("words").agg(
        F.map_from_entries(F.collect_list(F.struct("rarity", F.struct("term", "offset")))).alias(
            "more"))
    found = found.join(F.broadcast(rest) if few else rest, "words", "left")
    for rarity in range(1, n):
        probe_at = F.col("more")[F.lit(rarity)]
        found = found.withColumn("__term", probe_at["term"]).withColumn(
            "__at", F.col("start") + probe_at["offset"])
        short = found.filter("__term is null")  # a window of fewer different words
        met = found.filter("__term is not null").join(
            postings,
            F.col("__id").eqNullSafe(F.col("p_id")) & (F.col("__fp") == F.col("p_fp"))
            & (F.col("__term") == F.col("p_term")) & (F.col("__at") == F.col("p_position")),
            "left_semi",
        )
        found = met.unionByName(short)
    here = F.slice("around", F.col("start") - F.col("from") + 1, F.col("size"))
    exact = found.filter((F.col("start") >= F.col("from")) & (here == F.col("words")))
    return exact.select(*KEY, "words", "size", "start").distinct()


def proximity_matches(index: DataFrame, probe: DataFrame, few: bool, slop: int) -> DataFrame:
    """Documents (with the window's words and start) that hold all probed terms
    near their places: each at most ``slop`` words off where the rarest puts it."""
    found = _starts(index, probe, few).select(*KEY, "words", "start").distinct()
    wanted = probe.groupBy("words").agg(F.count("*").alias("n_terms"))
    terms = probe.select("words", "term", "offset", "rarity")
    each = found.join(terms, "words").withColumn(
        "at", F.explode(F.sequence(
            F.col("start") + F.col("offset") - slop, F.col("start") + F.col("offset") + slop)))
    postings = index.select(
        F.col("__id").alias("p_id"), F.col("__fp").alias("p_fp"),
        F.col("term").alias("p_term"), F.col("position").alias("p_position"))
    met = each.join(
        postings,
        F.col("__id").eqNullSafe(F.col("p_id")) & (F.col("__fp") == F.col("p_fp"))
        & (F.col("term") == F.col("p_term")) & (F.col("at") == F.col("p_position")),
        "left_semi",
    )
    held = met.groupBy(*KEY, "words", "start").agg(F.countDistinct("rarity").alias("n"))
    return held.join(wanted, "words").filter("n = n_terms").select(*KEY, "words", "start")


def occurrences(corpus: DataFrame, wins: DataFrame) -> DataFrame:
    """Builds and stores the index for these windows and looks them all up."""
    terms = wins.select(F.explode("words").alias("term")).distinct()
    few = _few(terms)
    counts = store(term_counts(corpus, terms, few), "term-counts")
    probe = store(probes(wins, counts), "probes")
    return phrase_matches(build_index(corpus, probe, few), probe, few)


def _hits(occ: DataFrame, wins: DataFrame) -> DataFrame:
    """(id, fingerprint, n_hit, items): words inside occurrences, items named."""
    named = occ.join(wins.select("words", "items"), "words")
    items = named.select(*KEY, F.explode("items").alias("item")).distinct().groupBy(*KEY).agg(
        F.array_sort(F.collect_set("item")).alias("items"))
    spans = occ.groupBy(*KEY, "start").agg(F.max("size").alias("size"))
    end = F.col("start") + F.col("size")
    before = W.partitionBy(*KEY).orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    spans = spans.withColumn("covered", F.coalesce(F.max(end).over(before), F.lit(0)))
    new = F.greatest(end - F.greatest(F.col("start"), F.col("covered")), F.lit(0))
    hit = spans.groupBy(*KEY).agg(F.sum(new).alias("n_hit"))
    # A hit document without a named item has a null here.
    i = items.select(F.col("__id").alias("i_id"), F.col("__fp").alias("i_fp"), "items")
    same = F.col("__id").eqNullSafe(F.col("i_id")) & (F.col("__fp") == F.col("i_fp"))
    return hit.join(i, same, "left").drop("i_id", "i_fp")


def scan(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """One row per document: counts of words, hit words and items, and the verdict."""
    corpus = keyed(docs, doc_id, text)
    wins = windows(items, item_id, item_text)
    hits = _hits(occurrences(corpus, wins), wins).select(
        F.col("__id").alias("h_id"), F.col("__fp").alias("h_fp"), "n_hit", "items")
    rows = corpus.select(*KEY, F.col("__n").alias("n_words"))
    same = F.col("__id").eqNullSafe(F.col("h_id")) & (F.col("__fp") == F.col("h_fp"))
    none = F.array().cast("array<string>")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return rows.join(hits, same, "left").select(
        F.col("__id").alias("doc_id"),
        F.col("__fp").alias("text_hash"),
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("items", none).alias("items"),
        ((n_hit > 0) & (n_hit * MIN_SHARE >= F.col("n_words"))).alias("contaminated"),
    )


def drop_contaminated(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    corpus = keyed(docs, doc_id, text)
    wins = windows(items, item_id, item_text)
    hits = _hits(occurrences(corpus, wins), wins).select(
        F.col("__id").alias("h_id"), F.col("__fp").alias("h_fp"), "n_hit")
    same = F.col("__id").eqNullSafe(F.col("h_id")) & (F.col("__fp") == F.col("h_fp"))
    bad = corpus.select(*KEY, "__n").join(hits, same)
    bad = bad.filter(F.col("n_hit") * MIN_SHARE >= F.col("__n")).select("h_id", "h_fp").distinct()
    packed = docs.select(
        F.struct("*").alias("__row"), F.col(f"`{doc_id}`").alias("__id"),
        fingerprint(F.col(f"`{text}`")).alias("__fp"))
    return packed.join(store(bad, "contaminated"), same, "left_anti").select("__row.*")
