"""The pipeline on a small table: stages in order, what they keep, and the entry without them."""

import os

import corpus_pipeline

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, docs, rows, tmp_path):
    frame = docs.select(COLUMNS)
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, frame, str(tmp_path))
        path = os.path.join(str(tmp_path), name)
        out.write.parquet(path)
        frame = spark.read.parquet(path)
        kept[name] = frame
        if name != "packing":
            assert frame.columns == COLUMNS
    ids = {r.doc_id for r in kept["near_duplicates"].select("doc_id").collect()}
    assert set(range(1, 80)) <= ids  # clean documents stay
    assert len(ids & {0, 110, 111, 112}) == 1  # one of the copies
    passage = {r.doc_id: r.text for r in kept["repeated_passages"].collect()}
    texts = {i: t for i, t, _ in rows}
    assert all(len(passage[i].split()) < len(texts[i].split()) for i in range(100, 104))
    assert all(passage[i] == texts[i] for i in range(1, 80))
    sizes = {}
    for r in kept["packing"].collect():
        sizes[r.sequence_id] = sizes.get(r.sequence_id, 0) + r.length
    assert all(n == 2048 or n & (n - 1) == 0 for n in sizes.values())
    assert {r.doc_id for r in kept["packing"].collect()} == set(passage)


def test_run_reads_documents(spark, docs, tmp_path):
    docs.select(COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    empty = tmp_path / "empty"
    docs.select(COLUMNS).limit(0).write.parquet(f"{empty}/documents.parquet")
    assert corpus_pipeline.run(spark, str(empty)).count() == 0
