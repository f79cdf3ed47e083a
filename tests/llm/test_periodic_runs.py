"""Runs of words against a search of every period, on small texts and whole tables."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import odd
import pytest

from dealglass.llm import periodic_runs, queries
from dealglass.llm.common import read


def brute(words, least_length=6, least_exponent=4):
    """All runs, period by period: a period that a shorter one divides within is not smallest."""
    out, n = [], len(words)
    for q in range(1, n // least_exponent + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(least_length, least_exponent * q):
                part = words[i:i + length]
                if all(part[d:] != part[:-d] for d in range(1, q)):
                    out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def dropped(n, runs):
    return {k for start, length, period in runs for k in range(start + period, start + length)}


def some_words(rng):
    n = rng.randint(0, 70)
    words = [rng.choice("abcdefgh"[:rng.choice([1, 2, 3, 8])]) for _ in range(n)]
    if n and rng.random() < 0.6:
        a = rng.randrange(n)
        p = 1 + rng.randrange((n - a) // 2 + 1)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


@pytest.mark.parametrize("least", [(6, 4), (2, 2), (1, 2), (5, 3), (8, 2), (12, 4)])
def test_all_runs(least):
    rng = random.Random(str(least))
    for _ in range(300):
        texts = [some_words(rng) for _ in range(rng.randint(1, 5))]
        assert periodic_runs.find_runs(texts, *least) == [brute(t, *least) for t in texts]


def test_long_texts():
    rng = random.Random(2)
    plain = [str(rng.randrange(5000)) for _ in range(30_000)]
    again = plain[:4000] * 5
    texts = [["x"] * 60_000, plain, plain[:100] + again + ["end"], ["a", "b"] * 20_000 + ["c"]]
    assert periodic_runs.find_runs(texts) == [
        [(0, 60_000, 1)], [], brute_of_blocks(plain), [(0, 40_000, 2)]]


def brute_of_blocks(plain):
    """The first 100 words stand before the copies too, so the run reaches back if they agree."""
    words, start = plain[:100] + plain[:4000] * 5 + ["end"], 100
    while start and words[start - 1] == words[start + 3999]:
        start -= 1
    return [(start, len(words) - 1 - start, 4000)]


def test_runs_do_not_cross_texts():
    assert periodic_runs.find_runs([["a"] * 5, ["a"] * 5, [], ["a"] * 6]) == [
        [], [], [], [(0, 6, 1)]]


def test_strongest_by_exact_ratio():
    assert periodic_runs.strongest([]) is None
    assert periodic_runs.strongest([(0, 8, 2), (3, 12, 3), (9, 6, 1)]) == (9, 6, 1)
    assert periodic_runs.strongest([(0, 8, 2), (0, 12, 3), (1, 4, 1)]) == (0, 8, 2)
    near = [(0, 10**17 + 1, 10**16), (1, 10**17 + 2, 10**16)]
    assert periodic_runs.strongest(near) == near[1]


def test_collapse_of_overlapping_runs():
    words = "x a b a b a b a b b b b b b y".split()
    runs = brute(words)
    assert runs == [(1, 8, 2), (8, 6, 1)]
    left = [w for k, w in enumerate(words) if k not in dropped(len(words), runs)]
    assert periodic_runs.collapse(words, runs) == " ".join(left) == "x a b y"


def test_rows_pass_through(docs, no_docs):
    found = periodic_runs.with_runs(docs.withColumn("Periodic", docs["doc_id"]))
    assert len(found.columns) == len(docs.columns) + 1
    rows = found.collect()
    assert odd.sorted_rows(found.drop("periodic")) == odd.sorted_rows(docs)
    for r in rows:
        words = odd.words(r["text"])
        got = r["periodic"] if "periodic" in r.asDict() else r["Periodic"]
        assert got.n_words == len(words)
        assert got.collapsed is not None and (words or got.collapsed == "")
        if len(words) < 1000:
            assert [tuple(x) for x in got.runs] == brute(words)
    assert periodic_runs.with_runs(no_docs).collect() == []


def test_written_with_a_clashing_name(docs, tmp_path):
    clash = docs.withColumn("periodic", docs["text"])
    periodic_runs.with_runs(clash).write.parquet(str(tmp_path / "out"))


def test_exponent_below_two(docs):
    with pytest.raises(ValueError):
        periodic_runs.with_runs(docs, least_exponent=1)


def planted(doc_id, words):
    """The words of the query: from word a on a cycle, in a tenth of the documents."""
    code, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or code % 10 or not n:
        return words
    g = code // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_query_over_the_table(spark, folder):
    got = {r["doc_id"]: r for r in queries.op11_periodic_runs(spark, folder).collect()}
    source = read(spark, folder, "documents").select("doc_id", "text").collect()
    assert len(got) == len(source)
    with_runs = 0
    for doc_id, text in source:
        words = planted(doc_id, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        runs = fast_brute(words)
        row = got[doc_id]
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        gone = dropped(len(words), runs)
        left = " ".join(w for k, w in enumerate(words) if k not in gone)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
        milli = 1000 * best[1] // best[2] if runs else None
        assert (row.n_words, row.n_runs) == (len(words), len(runs))
        assert (row.start, row.length, row.period, row.exponent_milli) == (*best, milli)
        assert row.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(left.encode()).hexdigest()
        with_runs += bool(runs)
    assert with_runs > len(source) // 20


def fast_brute(words, least_length=6, least_exponent=4):
    """As ``brute``, by comparing the text with itself at each distance at once."""
    import numpy as np
    n = len(words)
    known: dict[str, int] = {}
    codes = np.array([known.setdefault(w, len(known)) for w in words])
    out = []
    for q in range(1, n // least_exponent + 1):
        same = np.concatenate(([0], codes[:-q] == codes[q:], [0])).astype(int)
        edges = np.diff(same)
        for i, j in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)):
            length = int(j - i) + q
            if length >= max(least_length, least_exponent * q):
                part = codes[i:i + length]
                if not any((part[d:] == part[:-d]).all() for d in range(1, q)):
                    out.append((int(i), length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))
