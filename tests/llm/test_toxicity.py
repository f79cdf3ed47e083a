"""The random field against sums over all taggings, its learning, and held-out documents."""

import itertools

import numpy as np
import odd
import pytest

from dealglass.llm import queries, toxicity
from dealglass.llm.common import read
from dealglass.llm.toxicity import Chain, Model, Tagger, features, key, marginals


def all_taggings(weights, chain):
    """log Z, marginals and expected moves by listing every tagging."""
    z, marginal, moves = 0.0, np.zeros(len(weights)), np.zeros(3)
    for tags in itertools.product((0, 1), repeat=len(weights)):
        log, before, made = 0.0, 0, np.zeros(3)
        for tag, weight in zip(tags, weights):
            log += weight * tag
            log += chain.enter * (tag > before) + chain.leave * (tag < before)
            log += chain.stay * (tag and before)
            made += (tag > before, tag < before, tag and before)
            before = tag
        z += np.exp(log)
        marginal += np.exp(log) * np.array(tags)
        moves += np.exp(log) * made
    return np.log(z), marginal / z, moves / z


@pytest.mark.parametrize("chain", [Chain(0, 0, 0), Chain(-2, 0.5, 1.5), Chain(1, -3, 2)])
def test_forward_backward(monkeypatch, chain):
    monkeypatch.setattr(toxicity, "CHUNK", 4)  # texts of several chunks, with rests
    random = np.random.default_rng(4)
    lengths = [0, 1, 3, 4, 5, 8, 11, 0, 2]
    texts = [random.normal(0, 3, n) for n in lengths]
    log_z, marginal, moves = marginals(np.concatenate(texts), lengths, chain)
    begin = np.cumsum([0, *lengths])
    for k, weights in enumerate(texts):
        z, of_word, made = all_taggings(weights, chain)
        assert log_z[k] == pytest.approx(z, abs=1e-10)
        assert np.allclose(marginal[begin[k]:begin[k + 1]], of_word)
        assert np.allclose(moves[k], made)


def test_long_text_does_not_overflow():
    weights = np.tile([40.0, -40.0, 55.0], 50_000)
    log_z, marginal, _ = marginals(weights, [len(weights)], Chain(-1, -1, 1))
    assert np.isfinite(log_z).all() and np.isfinite(marginal).all()
    assert marginal[0] > 0.99 and marginal[1] < 0.01


def test_nothing():
    log_z, marginal, moves = marginals(np.zeros(0), [], Chain(0, 0, 0))
    assert len(log_z) == len(marginal) == 0 and moves.shape == (0, 3)
    assert features([]).shape[0] == 0


def test_gradient_of_log_z_is_the_marginal():
    random = np.random.default_rng(1)
    weights, chain = random.normal(0, 1, 150), Chain(-1, 0.2, 0.4)
    _, marginal, moves = marginals(weights, [150], chain)
    for k in (0, 63, 64, 149):
        more = weights.copy()
        more[k] += 1e-5
        up = marginals(more, [150], chain)[0][0] - marginals(weights, [150], chain)[0][0]
        assert up / 1e-5 == pytest.approx(marginal[k], abs=1e-4)
    up = marginals(weights, [150], Chain(-1, 0.2, 0.4 + 1e-5))[0][0]
    assert (up - marginals(weights, [150], chain)[0][0]) / 1e-5 == pytest.approx(moves[0, 2], abs=1e-3)


def learned(texts, labels):
    lists = [toxicity._WORDS.findall(t) for t in texts]
    words = sorted({w for x in lists for w in x}, key=key)
    return Model(np.array([key(w) for w in words]), features(words),
                 [np.array([key(w) for w in x]) for x in lists], labels)


@pytest.fixture(scope="module")
def model():
    random = np.random.default_rng(2)
    plain = [f"word{k}" for k in range(60)]
    texts, labels = [], []
    for k in range(240):
        text = random.choice(plain, 40).tolist()
        if k % 4 == 0:
            for at in random.choice(40, 3, replace=False):
                text[at] = str(random.choice(["vilest", "rotten", "vilely"]))
        texts.append(" ".join(text))
        labels.append(int(k % 4 == 0))
    return learned(texts, labels)


def test_spans(model):
    text = "Word1, word2: (ROTTEN vilest) word3 😀 vilely."
    scores, expected, spans = Tagger(model).tag([text, "word1 word2", None, "", "!!", text * 300])
    found = [(text[a:b]) for a, b, _ in spans[0]]
    assert found == ["ROTTEN vilest", "vilely"]
    assert all(toxicity.SPAN <= m <= 1 for _, _, m in spans[0])
    assert expected[0] == pytest.approx(3, abs=0.4)
    assert scores[0] > 0.9 and scores[1] < 0.1 and scores[2] == scores[3] == scores[4] < 0.1
    assert spans[1:5] == [[]] * 4 and len(spans[5]) == 600


def test_unseen_form_of_a_known_beginning(model):
    scores, _, _ = Tagger(model).tag(["word1 vilesome rottenly vilest word2"])
    assert scores[0] >= toxicity.THRESHOLD


def test_same_score_in_any_block(model):
    texts = ["word1 vilest word2", "word5 " * 500, "rotten"]
    tagger = Tagger(model)
    together = tagger.tag(texts)[0]
    assert np.allclose(together, [tagger.tag([t])[0][0] for t in texts], rtol=0, atol=1e-12)


def labels_of(spark, docs, some):
    return spark.createDataFrame(some, "doc_id long, toxic int, quality int, text string")


def test_odd_rows(spark, docs, no_docs, tmp_path):
    marks = labels_of(spark, docs, [
        (1, 1, 0, "x"), (2, 0, 1, "x"), (3, 1, 1, None), (7, 0, 0, "x"), (9, None, 0, "x"),
        (None, 1, 0, "x"), (12, 7, 0, "x"), (11, 1, 0, "x"), (11, 0, 0, "x"), (15, 0, 1, "x")])
    found = toxicity.with_scores(docs, toxicity.learn(docs, marks))
    rows = found.collect()
    assert odd.sorted_rows(found.drop("toxicity")) == odd.sorted_rows(docs)
    assert all(0 <= r["toxicity"].score <= 1 for r in rows)
    null = [r["toxicity"] for r in rows if not odd.words(r["text"])]
    assert len({t.score for t in null}) == 1 and all(t.spans == [] for t in null)
    clash = docs.withColumn("Toxicity", docs["text"])
    toxicity.with_scores(clash, toxicity.learn(docs, marks)).write.parquet(str(tmp_path / "out"))
    assert toxicity.with_scores(no_docs, None).collect() == []


def test_without_labels(spark, docs, no_docs):
    for some in ([], [(1, 1, 0, "x")], [(6, 0, 0, "x"), (4, 1, 0, "x")]):
        model = toxicity.learn(docs, labels_of(spark, docs, some))
        scores = {r["toxicity"].score for r in toxicity.with_scores(docs, model).collect()}
        assert model is not None or scores == {0.0}
    marks = labels_of(spark, docs, [(1, 1, 0, "x"), (2, 0, 0, "x")])
    assert toxicity.learn(no_docs, marks) is None


def test_held_out_rows_are_not_learned_from(spark, larger):
    docs = read(spark, larger, "documents").select("doc_id", "text")
    marks = read(spark, larger, "labels")
    some = toxicity.sample(docs, marks).select("text").distinct().join(docs, "text")
    from dealglass.llm.common import learnable
    labelled = marks.filter(learnable(marks["doc_id"])).select("doc_id")
    found = {r["text"] for r in some.join(labelled, "doc_id").select("text").collect()}
    assert found == {r["text"] for r in some.collect()}  # each comes from a row of the folds


def test_held_out_accuracy(spark, larger):
    folder = larger.replace("sf0.01", "sf0.1")
    scored = queries.op13_toxicity(spark, folder)
    rows = scored.join(read(spark, folder, "labels"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    hits = sum(r["predicted"] == r["toxic"] == 1 for r in held)
    assert hits >= 0.88 * sum(r["toxic"] for r in held)
    assert hits >= 0.88 * sum(r["predicted"] for r in held)
    assert all(bool(r["spans"]) == (r["n_spans"] > 0) for r in rows)
