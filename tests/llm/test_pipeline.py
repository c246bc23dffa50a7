from collections import Counter, defaultdict

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    base = docs.first()
    words = [f"wort{i} the" for i in range(1500)]
    extra = [(5001, "%%% 123", "en", "src1", 7), (5002, base.text, "en", "src1", 1), (5003, None, None, None, 0),
             (5004, "the house and " + " ".join(words), "en", "src2", 1), (5005, "the house and " + " ".join(words[:-1]) + " other the", "en", "src2", 1)]
    docs = docs.union(spark.createDataFrame(extra, docs.schema))
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, out[-1], "/root/testdata/sf0.001").write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_each_stage_on_its_input(stages):
    docs, language, exact, near, mixed, packed = [[r.asDict() for r in s.collect()] for s in stages]
    for s in stages[1:5]:
        assert s.columns == stages[0].columns
    ids = lambda rows: {r["doc_id"] for r in rows}
    assert ids(docs) - ids(language) == {5001, 5003}
    best = defaultdict(int)
    for r in language:
        best[r["text"]] = max(best[r["text"]], r["doc_id"])
    assert sorted(ids(exact)) == sorted(best.values()) and len(exact) == len(best)
    assert ids(near) < ids(exact) and 5005 not in ids(near)
    key = lambda r: tuple(map(str, r.values()))
    assert Counter(map(key, mixed)) == Counter(map(key, near))
    assert {r["doc_id"] for r in packed} == ids(mixed)
    total = Counter()
    for r in packed:
        total[r["doc_id"]] += r["length"]
        assert r["offset"] + r["length"] <= 4096
    assert all(total[r["doc_id"]] == r["doc_tokens"] for r in packed)


def test_mixture_reaches_the_sequences(spark, stages, tmp_path, monkeypatch):
    """Other weights give other sequences, and the first ones hold the preferred source."""
    source = {r.doc_id: r.source for r in stages[3].collect()}
    first = {}
    for name, weights in (("own", None), ("src1", {"src1": 0.9}), ("src2", {"src2": 0.9})):
        monkeypatch.setattr(corpus_pipeline, "MIX_WEIGHTS", weights)
        corpus_pipeline.mixture(spark, stages[3], "").write.parquet(str(tmp_path / name))
        rows = corpus_pipeline.packed(spark, spark.read.parquet(str(tmp_path / name)), "").collect()
        rows = sorted((r.sequence_id, r.offset, r.doc_id) for r in rows)
        first[name] = rows
        if weights:
            s = next(iter(weights))
            head, every = Counter(source[i] for _, _, i in rows[: len(rows) // 4]), Counter(source[i] for _, _, i in rows)
            assert head[s] / (len(rows) // 4) > 1.5 * every[s] / len(rows)
    assert len({tuple(x) for x in first.values()}) == 3


def test_stages_on_an_empty_table(spark, stages):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, stages[0].where("false"), "")
        assert out.columns == stages[0].columns and out.count() == 0
    assert corpus_pipeline.packed(spark, stages[1].where("false"), "").count() == 0


def test_run(spark, stages):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert got.columns == stages[-1].columns and got.count() >= 150


def test_near_stage_gives_the_groups_of_true_jaccard(stages):
    n = corpus_pipeline.NEAR_WORDS
    exact, near = ([r.asDict() for r in s.collect()] for s in stages[2:4])
    sets = {r["doc_id"]: {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} for r in exact for w in [r["text"].lower().split()]}
    label = {i: i for i in sets}
    pairs = [(i, j) for i in sets for j in sets if j < i and 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j])]
    for _ in pairs:
        for i, j in pairs:
            label[i] = label[j] = min(label[i], label[j])
    assert len(pairs) >= 3 and {r["doc_id"] for r in near} == set(label.values())


def test_stages_take_columns_with_the_names_of_helpers(spark, tmp_path):
    from lodestride.llm.packing import pack_in_order
    from lodestride.llm.simhash import one_of_each

    names = ["__kept", "kept", "id", "row", "component_id", "_metadata", "c0"]
    text = "one two three four five six seven eight nine ten"
    rows = [(1, text), (2, text), (3, "other words of another text that has nothing in common with it"), (None, text)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", *[f"7 AS `{n}`" for n in names])
    kept = one_of_each(docs, words_per_shingle=5)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, 1, 3]
    docs.write.parquet(str(tmp_path / "d"))
    packed = pack_in_order(spark.read.parquet(str(tmp_path / "d")))
    assert {r["doc_id"] for r in packed.collect()} == {None, 1, 2, 3}
