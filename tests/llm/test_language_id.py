from itertools import product

import numpy as np

from lodestride.llm import language_id as L
from lodestride.llm.sampling import crc


def test_forward_backward_matches_enumeration():
    rng = np.random.default_rng(0)
    lengths, k = np.array([4, 4, 2, 1]), 3
    scores, transition = rng.normal(size=(lengths.sum(), k)), rng.normal(size=(k, k))
    marginals, pairs, logz = L.forward_backward(scores, lengths, transition)
    want, want_pairs, want_logz, at = np.zeros_like(scores), np.zeros((k, k)), 0.0, 0
    for n in lengths:
        paths = list(product(range(k), repeat=int(n)))
        weight = np.exp([sum(scores[at + i, y] for i, y in enumerate(p)) + sum(transition[a, b] for a, b in zip(p, p[1:])) for p in paths])
        for p, w in zip(paths, weight / weight.sum()):
            for i, y in enumerate(p):
                want[at + i, y] += w
            for a, b in zip(p, p[1:]):
                want_pairs[a, b] += w
        want_logz += np.log(weight.sum())
        at += n
    assert np.allclose(marginals, want) and np.allclose(pairs, want_pairs)
    assert np.isclose(logz, want_logz)


def test_switches_inside_a_text_are_followed():
    texts = ["the thing and other", "das ding und andere", "the one thing that other", "ein ding das andere und"] * 5
    model = L.fit(texts, ["en", "de", "en", "de"] * 5, rounds=15)
    words = "the other thing and that das ding und andere ein".split()
    emit = model.emissions(words)
    marginals, _, _ = L.forward_backward(emit, np.array([len(words)]), model.transition)
    assert [model.languages[i] for i in marginals.argmax(1)] == ["en"] * 5 + ["de"] * 5


def test_held_out_accuracy_and_edges(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    extra = [(-1, None, "en"), (-2, "", "en"), (-3, "123 %%% \n", None), (-4, "the " * 60_000, None), (-4, "the " * 60_000, None), (None, "the and of", None)]
    more = spark.createDataFrame(extra, "doc_id long, text string, lang string")
    both = docs.select("doc_id", "text", "lang").union(more)
    got = L.identify(both).collect()
    assert len(got) == docs.count() + len(extra)
    langs = {r.doc_id: r.lang for r in docs.collect()}
    test = [r for r in got if r.held_out and r.doc_id in langs]
    assert all(r.held_out == (r.doc_id is not None and crc(str(r.doc_id)) % 3 == 1) for r in got)
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in test]) > 0.95
    by = {r.doc_id: (r.lang_pred, r.score) for r in got}
    assert by[-1] == by[-2] == by[-3] == ("und", 0.0) and by[-4][0] == "en" and by[None][0] == "en"
    assert all(0 <= r.score <= 1 for r in got)
    kept = L.accepted_documents(both)
    assert kept.columns == both.columns and not {-1, -2, -3} & {r.doc_id for r in kept.collect()}
    none = L.identify(more.where("lang is null and doc_id is null"))
    assert [r.lang_pred for r in none.collect()] == ["und"]
    assert L.identify(both.limit(0)).count() == 0


def test_long_runs_are_read_to_their_end():
    model = L.fit(["the thing and other that was here", "das ding und andere die nicht waren"] * 20, ["en", "de"] * 20)
    run = "thethingandotherthatwashere"
    tail = "dasdingundanderedienichtwarenunddasdingund" * 20
    assert L.predict(model, [run * 2])[0] == ["en"] and L.predict(model, [run * 2 + tail])[0] == ["de"]
    assert "".join(L.words_of("x" * 95)) == "x" * 95 and max(map(len, L.words_of("x" * 95 + " y"))) == 40
    assert L.words_of("\u4e2d\u6587" * 50) and L.words_of("1" * 60) == []


def test_transitions_are_learned_from_spliced_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang is not null").collect()
    docs = [d for d in docs if len(d.text.split()) > 60]
    model = L.fit([d.text for d in docs[:150]], [d.lang for d in docs[:150]])
    other = L.spliced([(L.words_of(d.text), d.lang) for d in docs[150:250]], 60)
    right = []
    for words, labels in other:
        marginals, _, _ = L.forward_backward(model.emissions(words), np.array([len(words)]), model.transition)
        right += [model.languages[i] == lang for i, lang in zip(marginals.argmax(1), labels)]
    assert np.mean(right) > 0.93
    off = model.transition - np.diag(np.diag(model.transition))
    assert np.diag(model.transition).min() > off.max()


def test_segments_give_one_result():
    model = L.fit(["the thing and other", "das ding und andere"] * 10, ["en", "de"] * 10)
    long = "the thing and " * 3 * L.SEGMENT_WORDS
    langs, scores = L.predict(model, [long, "das ding", None, long])
    assert langs == ["en", "de", "und", "en"] and scores[0] == scores[3] > 0.9


def test_sample_with_one_id_on_many_rows(spark):
    rows = [(1, f"the thing and other {i}", "en", "a") for i in range(300)] + [(i, "das ding und andere", "de", "b") for i in range(1000, 1040)] + [(None, "und", None, "c")] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, held_out string")
    got = L.identify(docs).collect()
    assert len(got) == len(rows) and {r.lang_pred for r in got if r.doc_id == 1} == {"en"}


def test_held_out_labels_change_nothing(spark):
    """Which rows are sampled, and so the model, depends on rows that aren't held out alone."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    from pyspark.sql import functions as F

    other = docs.withColumn("lang", F.when(L.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang")))
    a, b = L.train(docs, sample_docs=20), L.train(other, sample_docs=20)
    assert a.languages == b.languages and a.lexicon == b.lexicon and np.array_equal(a.transition, b.transition) and np.array_equal(a.weights, b.weights)
