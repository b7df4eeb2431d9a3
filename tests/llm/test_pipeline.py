"""The pipeline, stage by stage, and the guard that lets it be absent."""

from __future__ import annotations

import corpus_pipeline
from parcelgrid.llm import packing

SHARED = "One sentence of the text. " * 20


def test_stages_take_effect_and_keep_the_columns(spark, docs, tmp_path):
    words = [" ".join(f"w{(i * 31 + k * k) % 997}" for k in range(80)) for i in range(60)]
    passage = "a benchmark passage that is long enough to be told apart from chance " * 2
    rows = [(i, w + (" vile1 vile2 vile3 vile4" if i % 3 == 0 else "")) for i, w in enumerate(words)]
    rows += [(100, SHARED), (101, SHARED.replace(" ", "  ")), (102, SHARED), (103, words[1] + " " + passage), (104, None)]
    frame = docs(rows)
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, int(i % 3 == 0)) for i in range(60)]
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "near dedup", "decontamination", "packing"]
    kept = {}
    now = frame
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path))
        assert now.columns == frame.columns
        kept[name] = {r.doc_id for r in now.select("doc_id").collect()}
    toxic = {i for i in range(60) if i % 3 == 0}
    assert not kept["toxicity"] & toxic and {i for i, _ in rows} - toxic == kept["toxicity"]
    assert kept["toxicity"] - kept["exact dedup"] == {100, 102}
    assert 103 not in kept["decontamination"] and 104 in kept["decontamination"]
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in packed.collect()} == kept["decontamination"]
    assert packed.groupBy("sequence_id").sum("length").where(f"`sum(length)` > {packing.LENGTH}").count() == 0


def test_stages_keep_rows_not_ids(spark, docs, tmp_path):
    """Null and shared ids: a row goes or stays by its own text."""
    words = [" ".join(f"w{(i * 31 + k * k) % 997}" for k in range(60)) for i in range(6)]
    rows = [(1, words[0]), (1, words[0]), (2, words[1]), (3, words[1]), (3, words[2]), (None, words[3]), (None, words[0]), (None, words[4])]
    docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    frame = spark.read.parquet(str(tmp_path / "documents.parquet"))
    once = corpus_pipeline.drop_exact_copies(spark, frame, str(tmp_path))
    assert once.columns == frame.columns
    assert sorted(r.text for r in once.collect()) == sorted({t for _, t in rows})
    near = docs([(1, words[0]), (1, words[0] + " "), (None, words[0].upper()), (None, words[5]), (7, words[5] + "\n"), (7, words[2])])
    kept = corpus_pipeline.drop_near_copies(spark, near, str(tmp_path)).collect()
    assert sorted(" ".join(r.text.lower().split()) for r in kept) == sorted([words[0], words[5], words[2]])


def test_stages_on_nothing(spark, docs, tmp_path):
    docs([]).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
