"""The pipeline: every stage keeps the documents' columns and works on what its predecessor kept."""

import corpus_pipeline
from tests.llm import brute, data


def test_stages_over_the_small_table(spark):
    docs = spark.read.parquet(f"{data.SMALL}/documents.parquet")
    names, columns = [n for n, _ in corpus_pipeline.STAGES], docs.columns
    assert len(names) == 5 and len(set(names)) == 5
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, data.SMALL).cache()
        if name != names[-1]:
            assert out.columns == columns
        kept[name] = out
        if name == "near_duplicates":
            comp = {d: c for d, _, c, _ in brute.op9(data.pairs(docs))}
            assert {r["doc_id"] for r in out.collect()} == {d for d, c in comp.items() if d == c}
        if name == "quality_rules":
            bad = {d for d, t in data.pairs(docs) if brute.op10(t)[-1]}
            assert bad.isdisjoint(r["doc_id"] for r in out.collect())
        docs = out
    assert kept["source_mix"].select("doc_id").distinct().join(kept["decontamination"], "doc_id", "left_anti").count() == 0
    whole = corpus_pipeline.run(spark, data.SMALL)
    assert data.rows(whole, "doc_id", "epoch", "block") == data.rows(kept["source_mix"], "doc_id", "epoch", "block")


def test_awkward_rows(spark):
    docs = data.awkward(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, data.SMALL)
        if name != "source_mix":
            assert out.columns == docs.columns
        out.write.format("noop").mode("overwrite").save()
        assert stage(spark, docs.limit(0), data.SMALL).count() == 0


def test_near_duplicates_follow_the_corpus_rule(spark):
    """One word changed in 51: 42 of 52 shingles of five words are shared (0.81), 44 of 52 of four words (0.846)."""
    words = [f"w{i}" for i in range(51)]
    near, far = list(words), list(words)
    near[25] = "x"
    far[10] = far[30] = "x"
    rows = [(3, " ".join(words)), (5, " ".join(near)), (7, " ".join(far))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    comp = {d: c for d, _, c, _ in brute.op9(rows, 5, 80)}
    got = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, data.SMALL).collect()}
    assert got == {d for d, c in comp.items() if d == c} == {3, 7}
    small = spark.read.parquet(f"{data.SMALL}/documents.parquet")
    comp = {d: c for d, _, c, _ in brute.op9(data.pairs(small), 5, 80)}
    got = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, small, data.SMALL).collect()}
    assert got == {d for d, c in comp.items() if d == c}


def test_line_dedup_compares_short_lines(spark):
    rows = [(1, "All rights reserved.\nfirst text\n---"), (2, "one more\n  All rights reserved. \n---\nAll rights reserved!"),
            (3, "All rights reserved.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_dedup(spark, docs, data.SMALL).collect()}
    assert got == {1: rows[0][1], 2: "one more\n---\nAll rights reserved!"}
