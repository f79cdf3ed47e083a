"""Licences, decontamination, quality rules and sharding against brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import odd
from compare import differences, duck
from dealglass.llm import decontaminate, licenses, quality_rules, sharding
from dealglass.llm.oracle import TEXT_SQL
from dealglass.llm.queries import TEXT_QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.mark.parametrize("name", sorted(TEXT_SQL))
def test_same_as_sql(spark, folder, name):
    assert differences(TEXT_QUERIES[name](spark, folder), duck(folder), TEXT_SQL[name]) == []


def test_queries_cover_all_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in TEXT_QUERIES) == list(range(1, 11))


# ------------------------------------------------------------------ licences

MIT = next(t for i, t in licenses.KNOWN if i == "MIT" and t.startswith("Permission"))


def test_equal_licences(spark):
    plain = MIT.replace('"', "“").replace(". ", ".\n\n").replace("sublicense", "sub-licence")
    texts = [MIT, "Copyright (c) 2020 Someone\n" + plain, "© 1999 X\n * (C) 2001 Y\n" + MIT.upper(),
             MIT + " Really.", "released under the  MIT licence", "x\nReleased under the MIT License.",
             "first\n\nLicensed under\nCC-BY 4.0!\n\nlast", "", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: r for r in licenses.scan(rows).collect()}
    assert [got[i].text_license for i in range(5)] == ["MIT", "MIT", "MIT", None, "MIT"]
    assert len({got[i].text_digest for i in range(3)}) == 1
    assert got[5].text_license is None and got[5].licenses == ["MIT"]
    assert got[6].licenses == ["CC-BY-4.0"]
    assert got[7].licenses == [] and got[7].text_digest == hashlib.sha256(b"").hexdigest()
    assert got[8].text_digest is None and got[8].licenses == []


MIT_FILE = """MIT License

Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""


def test_published_files(spark):
    isc = next(t for i, t in licenses.SHORT if i == "ISC")
    files = {f.stem: f.read_text() for f in licenses.PUBLISHED.glob("*.txt")}
    assert len(files) == 14
    files["MIT"], files["ISC"] = MIT_FILE, "ISC License\n\nCopyright (c) 2004 X\n\n" + isc
    bsd = files["BSD-3-Clause"]
    titled = "BSD 3-Clause License\n\nCopyright (c) 1999, X\nAll rights reserved.\n\n" + bsd
    rows = [(k, t) for k, t in files.items()] + [
        ("BSD-3-Clause", titled), ("BSD-3-Clause", re.sub(r"(?m)^\d\.", "  *", titled)),
        ("BSD-2-Clause", files["BSD-2-Clause"].replace("HOLDER OR CONTRIBUTORS BE", "OWNER OR CONTRIBUTORS BE"))]
    rows += [("in " + k, "Some text.\n\n" + t + "\nMore text.") for k, t in files.items()]
    rows.append(("cut", files["Apache-2.0"].split("   END OF TERMS")[0]))
    got = licenses.scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    for r in got:
        if r.doc_id == "cut":
            assert r.text_license == "Apache-2.0"
        elif r.doc_id.startswith("in "):
            name = r.doc_id[3:]
            # inside a document, no paragraph is of the two-clause text alone
            assert r.text_license is None
            assert r.licenses == ([] if name == "BSD-2-Clause" else [name])
        else:
            assert r.text_license == r.doc_id and r.doc_id in r.licenses


def test_licences_of_the_caller(spark, docs, no_docs, monkeypatch):
    known = spark.createDataFrame(
        [("fox", odd.PROSE.upper()), ("afox", odd.PROSE), ("none", "..."), ("null", None)],
        "license_id string, text string")
    for limit in (licenses.MAX_BROADCAST_LICENSES, 0):
        monkeypatch.setattr(licenses, "MAX_BROADCAST_LICENSES", limit)
        got = licenses.scan(docs, known)
        assert got.count() == docs.count()
        hits = Counter(r.doc_id for r in got.collect() if r.licenses == ["afox"])
        assert hits == Counter({1: 1, 2: 1, 11: 3, 12: 1, None: 1})
    assert licenses.scan(no_docs, known).count() == 0
    assert licenses.scan(docs, known.limit(0)).count() == docs.count()


# ----------------------------------------------------------- decontamination

ITEMS = [("a", odd.PROSE), ("b", "the lazy dog"), ("c", "word"), ("d", None), ("e", "..."),
         ("e2", "absent words"), (None, "sit under the tall"), ("b", "the lazy dog"),
         ("f", "word1 tail1 word2 tail2 word3 tail3 word4 tail4 word5 tail5 word6 tail6 word7 no"),
         ("g", "eins ZWEI drei vier fünf sechs sieben acht")]


def tokens(text):
    return WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))


def brute_scan(rows, items, width=13):
    windows = defaultdict(set)
    for item, text in items:
        w = tokens(text)
        for i in range(max(1, len(w) - width + 1) if w else 0):
            windows[tuple(w[i:i + width])].add(item)
    sizes = {len(k) for k in windows}
    out = []
    for doc_id, text in rows:
        w, hit, found = tokens(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                items_here = windows.get(tuple(w[i:i + n]))
                if items_here:
                    hit.update(range(i, i + n))
                    found |= items_here
        named = sorted(x for x in found if x is not None)
        out.append((doc_id, len(w), len(hit), named, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(map(str, out))


@pytest.mark.parametrize("most", [decontaminate.MAX_BROADCAST_TERMS, 0])
def test_decontamination(spark, docs, no_docs, most, monkeypatch):
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST_TERMS", most)
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = decontaminate.scan(docs, items)
    want = brute_scan(rows, ITEMS)
    assert sorted(str((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated))
                  for r in got.collect()) == want
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    clean = [x for x in want if x.endswith("False)")]
    assert kept.count() == len(clean)
    assert decontaminate.scan(no_docs, items).count() == 0
    assert {r.n_hit for r in decontaminate.scan(docs, items.limit(0)).collect()} == {0}


def test_proximity(spark):
    docs = spark.createDataFrame(
        [(1, "red x green blue"), (2, "red green blue"), (3, "red a b c green blue"),
         (4, "blue green red")], "doc_id int, text string")
    items = spark.createDataFrame([(1, "Red green blue")], "item_id int, text string")
    corpus = decontaminate.keyed(docs, "doc_id", "text")
    wins = decontaminate.windows(items, "item_id", "text")
    terms = wins.select(F.explode("words").alias("term")).distinct()
    probe = decontaminate.probes(wins, decontaminate.term_counts(corpus, terms, True), None)
    index = decontaminate.build_index(corpus, probe, True)

    def near(slop):
        found = decontaminate.proximity_matches(index, probe, True, slop)
        return sorted({r["__id"] for r in found.collect()})

    assert near(0) == [2] and near(1) == [1, 2] and near(3) == [1, 2, 3]
    exact = decontaminate.phrase_matches(index, probe, True).collect()
    assert [(r["__id"], r["start"]) for r in exact] == [(2, 0)]


# ------------------------------------------------------------- quality rules

def brute_counts(text):
    w = odd.words(text)
    at = defaultdict(list)
    for i in range(len(w) - 7):
        at[tuple(w[i:i + 8])].append(i)
    covered = {j for p in at.values() if len(p) > 1 for i in p for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if odd.words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)), len(covered))


def test_quality_counts(spark, docs, no_docs):
    repeat = "one two three four five six seven eight nine. "
    more = [(21, repeat * 5), (22, repeat + "x " + repeat + "y"), (23, "a\nb\na\n\n\nb\na # | <"),
            (24, ("b " * 20).strip()), (25, "\n" * 50 + repeat)]
    rows = docs.select("doc_id", "text").unionByName(
        spark.createDataFrame(more, "doc_id long, text string"))
    got = quality_rules.judge(rows).collect()
    fields = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    want = sorted(str((r.doc_id, *brute_counts(r.text))) for r in rows.collect())
    assert sorted(str((r.doc_id, *[r[f] for f in fields])) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.kept and r.base_failed)
    assert quality_rules.judge(no_docs).count() == 0


def test_bad_lines_go_first(spark, docs):
    good = [odd.PROSE, "Another line tells of ships, of harbours and of sailors far from home."]
    bad = ["Home | News | About | Contact", "BUY!! NOW!! HERE!!", "$$$ %%% a", "Read our cookie policy",
           "so so so so so so so so so so so so so so so so so so so so"]
    texts = ["\n".join(good + bad[:3]), "\n".join(bad + good[:1]), "\n".join(good), None]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: r for r in quality_rules.judge(rows).collect()}
    assert [got[i].kept for i in range(4)] == [True, False, True, False]
    assert got[1].n_lost_words == sum(len(x.split()) for x in bad)
    cleaned = rows.select(quality_rules.clean(F.col("text"))).collect()
    assert [r[0] for r in cleaned] == ["\n".join(good), good[0], "\n".join(good), None]
    kept = quality_rules.keep(docs)
    assert kept.columns == docs.columns
    assert kept.count() == quality_rules.judge(docs).filter("kept").count() > 0


# ------------------------------------------------------------------ sharding

def test_sharding_by_bytes(spark, folder):
    rows = TEXT_QUERIES["op9_sharding"](spark, folder).toPandas()
    docs = spark.read.parquet(f"{folder}/documents.parquet").toPandas()
    text = docs.set_index("doc_id")["text"]
    assert sorted(rows["doc_id"]) == sorted(text.index)
    for r in rows.itertuples():
        data = text[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(data) + 1, zlib.crc32(data))
    assert set(rows["shard"]) <= set(range(16)) and set(rows["law"]) == {"bytes"}
    for _, part in rows.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    load = rows.groupby("shard")["size"].sum().reindex(range(16), fill_value=0)
    assert load.max() - load.min() <= rows["size"].max()
    assert rows.groupby("virtual_slot")["shard"].nunique().max() == 1


def test_sharding_odd_rows(docs, no_docs):
    got = sharding.shard_records(docs, 4).collect()
    assert len(got) == docs.count()
    for s in range(4):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    assert {r.size for r in got if r.doc_id in (4, 5)} == {1}
    assert sharding.shard_records(no_docs).count() == 0


def brute_places(recs, slot_map):
    """Places within the shards, slot by slot and part by part, by plain lists."""
    shard_of = {r.slot: r.shard for r in slot_map}
    rows = sorted(recs, key=lambda r: (shard_of[r.virtual_slot], r.virtual_slot, r.part))
    filled, out = {}, []
    for r in rows:
        shard = shard_of[r.virtual_slot]
        out.append((r.virtual_slot, r.part, shard, filled.get(shard, 0)))
        filled[shard] = filled.get(shard, 0) + 1
    return sorted(out)


def test_dealing_by_brute_force(spark, docs):
    recs = sharding.records(docs)
    sizes = sharding.slot_sizes(recs)
    want = {}
    for r in recs.collect():
        want[r.virtual_slot] = want.get(r.virtual_slot, 0) + r.size
    assert {r.slot: r.bytes for r in sizes.collect() if r.bytes} == want
    edited = sharding.rebalance(sharding.even_map(spark, 3), sizes, 3)
    placed = sharding.place(recs, edited).collect()
    got = sorted((r.virtual_slot, r.part, r.shard, r.slot) for r in placed)
    assert got == brute_places(recs.collect(), edited.collect())


def test_a_row_repeated_for_a_third_of_all(spark):
    one = spark.range(0, 3000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 10).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "x" * 100).otherwise(
            F.concat(F.lit("y" * 60), F.col("id").cast("string"))).alias("text"))
    rows = sharding.shard_records(one)
    loads = rows.groupBy("shard").agg(F.sum("size").alias("b")).toPandas()["b"]
    assert len(loads) == 16 and loads.max() - loads.min() <= 0.01 * loads.mean() + 9 * 101
    copies = rows.where("doc_id = 7").groupBy("virtual_slot").count().toPandas()["count"]
    assert copies.sum() == 1000 and copies.max() <= 24  # one of each part, and a few by chance


def test_versions_under_one_name(spark, docs):
    versions = sharding.SlotMap(spark)
    first = sharding.shard_records(docs, 4, slot_map=versions).collect()
    again = sharding.shard_records(docs, 4, slot_map=versions).collect()
    assert {r.map_version for r in first} == {2} and {r.map_version for r in again} == {3}
    assert sorted(map(tuple, versions.versions().groupBy("version").count().collect())) == [
        (k, sharding.SLOTS) for k in (1, 2, 3)]
    wider = sharding.shard_records(docs, 5, slot_map=versions)
    assert {r.map_version for r in wider.collect()} == {4}
    # a version that a failed run left half does not count
    versions.version(4).where("slot < 9").select("slot", "shard").write.parquet(
        f"{versions.folder}/version=9")
    assert versions.current()[1] == 4


def test_map_versions(spark):
    sizes = spark.range(sharding.SLOTS).select(
        F.col("id").cast("int").alias("slot"), (F.col("id") % 100 + 1).alias("bytes")).cache()
    first = sharding.first_map(sizes, 16).cache()
    assert (first.count(), first.select("slot").distinct().count()) == (sharding.SLOTS,) * 2

    def loads(slot_map, by):
        found = slot_map.join(by, "slot").groupBy("shard").agg(F.sum("bytes").alias("b"))
        return {r.shard: r.b for r in found.collect()}

    even = loads(first, sizes)
    assert len(even) == 16 and max(even.values()) - min(even.values()) <= 100
    # one slot's growth moves few slots; one more shard takes nearly all that moves
    grown = sizes.withColumn("bytes", F.when(F.col("slot") == 5, 3000).otherwise(F.col("bytes")))
    second = sharding.rebalance(first, grown, 16)
    after = loads(second, grown)
    assert max(after.values()) <= sum(after.values()) / 16 + 3000
    moved = first.join(second.withColumnRenamed("shard", "to"), "slot").where("shard <> to")
    assert moved.count() < sharding.SLOTS / 10
    assert {r.version for r in second.select("version").distinct().collect()} == {2}
    wider = sharding.rebalance(first, sizes, 17)
    into = first.join(wider.withColumnRenamed("shard", "to"), "slot").where("shard <> to")
    by_kind = {r.new: r.b for r in into.join(sizes, "slot").groupBy(
        (F.col("to") == 16).alias("new")).agg(F.sum("bytes").alias("b")).collect()}
    assert by_kind.get(False, 0) <= 0.05 * by_kind[True]  # small slots that level the loads
    total = loads(wider, sizes)
    assert max(total.values()) - min(total.values()) <= 200 and len(total) == 17
