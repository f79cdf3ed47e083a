"""The pipeline, stage by stage, against a brute-force version on a small folder."""

import numpy as np

import corpus_pipeline
import odd
from dealglass.llm import language, packing
from dealglass.llm import quality_rules as qr
from test_models import brute_classes, check_bins, held
from test_native import brute_counts, brute_scan

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def languages_kept(rows):
    langs = sorted({r.lang for r in rows if r.lang is not None})
    model = np.zeros((language.BINS, len(langs)))
    for r in rows:
        if r.doc_id is not None and not held(r.doc_id) and r.lang is not None:
            for code in language.trigrams(r.text):
                model[code, langs.index(r.lang)] += 1
    model += language.SMOOTHING * model.sum(0) / language.BINS
    model /= model.sum(0)
    out = set()
    for r in rows:
        name, _, share, _ = language.mixture(language.trigrams(r.text), langs, model)
        if name != "und" and share >= 1 / 3:
            out.add(r.doc_id)
    return out


def line_fails(line):
    w = odd.words(line)
    return bool(w) and (
        line.count("|") >= qr.BARS or line.count("!!") * 4 > len(w)
        or sum(c in "#*$%&|<>" for c in line) * 4 > len(w)
        or (len(w) > qr.LONG_RUN and not any(c in ".!?:;,…" for c in line))
        or (len(w) >= qr.STUTTER_WORDS and len(set(w)) * 4 <= len(w))
        or (len(w) <= qr.LONG_RUN and any(p in line.lower() for p in qr.BOILERPLATE)))


def quality_kept(text):
    n, _, _, _, repeated = brute_counts(text)
    lost = sum(len(odd.words(x)) for x in (text or "").split("\n") if line_fails(x))
    return n >= 20 and repeated * 100 <= 30 * n and lost * 100 <= 30 * n and n - lost >= 20


def cleaned(text):
    return "\n".join(x for x in text.split("\n") if not line_fails(x))


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = [(str(r.item_id), r.text)
             for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language ID", "quality rules", "n-gram Jaccard join",
                     "benchmark decontamination", "best-fit packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.collect()
        docs = stage(spark, docs, folder).cache()
        assert docs.columns == COLUMNS
        got = sorted(r.doc_id for r in docs.collect())
        if name == "language ID":
            want = languages_kept(before)
        elif name == "quality rules":
            want = {r.doc_id for r in before if quality_kept(r.text)}
            texts = {r.doc_id: cleaned(r.text) for r in before}
            for r in docs.collect():
                assert r.text == texts[r.doc_id] and r.n_chars == len(r.text)
        elif name == "n-gram Jaccard join":
            before.sort(key=lambda r: r.doc_id)
            found = brute_classes([r.doc_id for r in before], [r.text for r in before])
            want = {r.doc_id for i, r in enumerate(before) if found[i][0] == i}
        else:
            scanned = brute_scan([(r.doc_id, r.text) for r in before], items)
            want = {int(x[1:].split(",")[0]) for x in scanned if x.endswith("False)")}
        assert got == sorted(want), name
        assert 0 < len(got) <= len(before)
    rows = corpus_pipeline.run(spark, folder).collect()
    check_bins(rows, packing.CAPACITY)
    packed = {}
    for r in rows:
        packed[r.doc_id] = packed.get(r.doc_id, 0) + r.length
    assert packed == {r.doc_id: len(odd.words(r.text)) for r in docs.collect()}


def test_odd_rows(spark, docs, no_docs, folder):
    for table in (docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            table = stage(spark, table, folder)
            if name != "best-fit packing":
                assert table.columns == docs.columns
        rows = table.collect()
        check_bins(rows, packing.CAPACITY)
    assert rows == []
