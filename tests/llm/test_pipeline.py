"""The corpus pipeline: each stage on what the one before kept, and the contract of its frames."""

import corpus_pipeline
from churnkit.llm import decontaminate, near_dup
from tests.conftest import SF001
from tests.llm.test_near_dup import brute
from tests.llm.test_texts import brute_lines, check_packing


def test_stages_and_their_decisions(spark, tmp_path):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    columns = docs.columns
    kept = [(r.doc_id, r.text) for r in docs.collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF001)
        out.write.parquet(path := str(tmp_path / str(k)))
        docs = spark.read.parquet(path)
        rows = docs.collect()
        if k < 4:
            assert docs.columns == columns and len({r.doc_id for r in rows}) == len(rows)
            assert all(r.n_chars == len(r.text) for r in rows)
        if name == "language":
            assert {r.doc_id for r in rows} == {i for i, t in kept if t and any(map(str.isalpha, t))}
        if name == "line_dedup":
            gone = brute_lines(kept)
            text = {i: "\n".join(x for p, x in enumerate(t.split("\n")) if p not in gone[i]) for i, t in kept}
            assert {r.doc_id: r.text for r in rows} == {i: t for i, t in text.items() if not gone[i] or t.strip(" ")}
        if name == "near_dedup":
            component, _ = brute(kept, 5, 80)
            assert {r.doc_id for r in rows} == {i for i, c in component.items() if i == c}
        if name == "decontaminate":
            items = [r.text for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
            held = {i for i, t in kept if any(x in t for x in items)}
            assert not held & {r.doc_id for r in rows}
        if name == "pack":
            check_packing(kept, rows, 1024)
            assert {r.doc_id for r in rows} == {i for i, _ in kept}
        else:
            kept = [(r.doc_id, r.text) for r in rows]


def test_pipeline_of_awkward_and_empty_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, extra string"
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    odd = spark.createDataFrame([(10**6, None, None, None, None, None), (10**6 + 1, "", "en", "s", 0, "x"),
                                 (None, "Null id text of some words that are here.", None, None, None, None)], schema)
    for k, rows in enumerate((spark.createDataFrame([], schema), docs.unionByName(docs.limit(20)).unionByName(odd, allowMissingColumns=True))):
        frame = rows
        for j, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, frame, SF001).write.parquet(path := str(tmp_path / f"{k}-{j}"))
            frame = spark.read.parquet(path)
        assert (frame.count() > 0) == (k == 1)


def test_run_is_the_stages_in_turn(spark):
    got = corpus_pipeline.run(spark, SF001)
    assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(got.columns)
    assert got.count() > 0
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5
    assert near_dup and decontaminate
