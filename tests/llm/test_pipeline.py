"""The stages one after the other against plain Python, and their columns."""

import brute
import corpus_pipeline

from quayside.llm import queries


def test_stages(spark, sf_dir, given):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    texts = dict(given)
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, sf_dir)
        assert now.columns == columns
        after = {r.doc_id: r.text for r in now.collect()}
        if name == "quality_classifier":
            assert 0 < len(after) < len(texts) and all(texts[i] == t for i, t in after.items())
        elif name == "line_dedup":
            shas = {i: h for i, _, _, h in brute.line_dedup(list(texts.items()))}
            import hashlib

            assert {i: hashlib.sha256(t.encode()).hexdigest() for i, t in after.items()} == shas
        elif name == "minhash_near_dedup":
            assert sorted(after) == [i for i, _, _, kept in brute.near_duplicates(list(texts.items()), 5) if kept]
        else:
            assert set(after) == set(texts)
            assert not any(k in ("email", "card", "phone") for t in after.values() for k, _, _ in brute.base_spans(t))
        texts = after
        now = spark.createDataFrame(now.collect(), docs.schema)
    rows = corpus_pipeline.STAGES[-1][1](spark, now, sf_dir).collect()
    assert sorted(tuple(r)[:5] for r in rows) == brute.pieces(list(texts.items()), queries.WORD_BPE)


def test_run_and_clashing_columns(spark, sf_dir):
    from pyspark.sql import functions as F

    assert corpus_pipeline.run(spark, sf_dir).count() > 0
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumns(
        {c: F.lit("mine") for c in ("score", "kept", "n_lines", "rest", "spans", "key")}
    )
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns and out.select("score", "n_lines", "rest").distinct().collect() == [("mine",) * 3]
        assert stage(spark, docs.limit(0), sf_dir).count() == 0


def test_batches_are_bounded_by_bytes(spark, sf_dir, monkeypatch):
    import pyarrow as pa
    from pyspark.sql import functions as F

    def sizes(docs, model):
        def run(batches):
            for batch in batches:
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array([str(batch.get_total_buffer_size())] * n), pa.array([1.0] * n)], ["doc_id", "text", "score"]
                )

        return docs.mapInArrow(run, "doc_id long, text string, score double")

    monkeypatch.setattr(corpus_pipeline.quality_model, "score_documents", sizes)
    docs = spark.range(1, 41, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 40_000).alias("text"))
    key = corpus_pipeline.BATCH_SETTING
    stage = corpus_pipeline.STAGES[0][1]
    spark.conf.unset(key)
    try:
        found = [int(r.text) for r in stage(spark, docs, sf_dir).collect()]
        # A row that passes the limit goes with its batch, and buffers are up to twice their content.
        assert len(found) == 40 and max(found) <= 4 << 20
        spark.conf.set(key, str(1 << 24))
        stage(spark, docs.limit(0), sf_dir)
        assert spark.conf.get(key) == str(1 << 24)
    finally:
        spark.conf.unset(key)
