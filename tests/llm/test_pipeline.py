import corpus_pipeline
from quillmill.llm import decontaminate, neardup, secrets, toxicity
from quillmill.llm.common import table


def test_stages_decide(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    bench = [(r.item_id, r.text) for r in table(spark, sf_dir, "benchmark").collect()]
    index = decontaminate.Index(bench, 0.8)
    seen = docs
    for name, stage in corpus_pipeline.STAGES:
        before = seen.toPandas()
        seen = spark.createDataFrame(stage(spark, seen, sf_dir).toPandas())
        after = seen.toPandas()
        if name == "toxicity":
            weights, bias = toxicity.train(docs, table(spark, sf_dir, "labels").where(~toxicity.held_out()))
            model = toxicity.Model(weights, bias)
            assert set(after.doc_id) == {i for i, t in zip(before.doc_id, before.text, strict=True) if model.score(t) < toxicity.THRESHOLD}
        elif name == "near_duplicates":
            bags = {i: neardup.bag(t) for i, t in zip(before.doc_id, before.text, strict=True)}
            up = {i: i for i in bags}

            def root(i, up=up):
                while up[i] != i:
                    i = up[i]
                return i

            ids = sorted(bags)
            for n, i in enumerate(ids):
                for j in ids[:n]:
                    if neardup.overlap(bags[i], bags[j]) >= 0.8:
                        a, b = root(i), root(j)
                        up[max(a, b)] = min(a, b)
            assert set(after.doc_id) == {root(i) for i in ids}
        elif name == "decontamination":
            assert set(after.doc_id) == {i for i, t in zip(before.doc_id, before.text, strict=True) if not index.search(t)}
        elif name == "secrets":
            want = {i: secrets.redacted(t, secrets.find_spans(t)) for i, t in zip(before.doc_id, before.text, strict=True)}
            assert dict(zip(after.doc_id, after.text, strict=True)) == want
        if name != "bpe":
            assert list(after.columns) == docs.columns
        else:
            assert len(after) == len(before) and (after.n_tokens > 0).any()


def test_run_equals_stages(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0


ODD = "doc_id long, text string, lang string, source string, n_chars long, score double, node string, blob string, band long, sig binary, extra struct<a:array<int>>"


def odd_rows():
    tail = (None, None, None, 0.5, "n", "b", 7, b"s", ([1, None],))
    text = "some words that are long enough to be a text of its own and no other"
    rows = [(1, None), (2, ""), (2, ""), (3, text), (4, text), (4, text), (None, "another " + text), (5, "key token = abcdefgh12 " + "w " * 60000), (6, "!!! ???"), (None, None)]
    return [(*r, *tail) for r in rows]


def test_stages_take_odd_rows(spark, sf_dir):
    odd = spark.createDataFrame(odd_rows(), ODD)
    expected = {"toxicity": 10, "near_duplicates": 6, "decontamination": 10, "secrets": 10, "bpe": 10}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd, sf_dir)
        got = out.collect()
        assert out.columns[: len(odd.columns)] == odd.columns and len(got) == expected[name], (name, len(got))
        assert all(r.extra.a == [1, None] and r.blob == "b" and r.sig == b"s" for r in got)
        assert stage(spark, odd.limit(0), sf_dir).count() == 0


def test_near_duplicates_keep_one_of_each(spark, sf_dir):
    kept = neardup.stage_neardup(spark, spark.createDataFrame(odd_rows(), ODD), sf_dir).select("doc_id", "text").collect()
    # 3, 4, 4 and the first row without an id are one class; 2 and 2 are one row.
    assert sorted(str(r.doc_id) for r in kept) == ["1", "2", "3", "5", "6", "None"]


def test_chained_stages_on_empty(spark, sf_dir):
    docs = spark.createDataFrame([], ODD)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0
