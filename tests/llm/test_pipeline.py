"""The pipeline's stages on the smallest tables, each against its contract."""
import corpus_pipeline
from panelforge.llm.common import scratch_table, table

SF = "/root/testdata/sf0.001"


def test_stages_take_effect_and_keep_columns(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch_table(stage(spark, docs, SF), "test-" + name)
        counts.append(docs.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    assert counts[0] > counts[1] >= counts[2] == counts[3] and docs.filter("n_pieces > 0").count() > 0
    assert [s for s, _ in corpus_pipeline.STAGES] == ["toxicity", "near_copies", "personal_data", "source_mix", "piece_encoding"]


def test_stages_accept_empty_and_odd_documents(spark):
    odd = spark.createDataFrame([(1, None, None, None, None), (None, "", "en", "a", 0), (2, "a b", "en", None, 3), (2, "a b", "en", None, 3)],
                                table(spark, SF, "documents").schema)
    for docs in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            docs = scratch_table(stage(spark, docs, SF), "odd-" + name)
        docs.count()


def test_stages_leave_columns_of_any_name_alone(spark):
    """Columns called like the stages' own ones come back as they were."""
    from pyspark.sql import functions as F
    extra = ["clean", "_clean", "size", "_size", "words", "_words", "toxic", "_toxic", "gone", "_gone", "m_id", "m_source", "rank",
             "nth", "m_extra", "m_epochs", "m_size"]
    docs = table(spark, SF, "documents").limit(60).withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in extra})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = scratch_table(stage(spark, docs, SF), "named-" + name)
        assert docs.count() > 0
        wrong = [F.col(c) != F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in extra]
        assert docs.filter(F.array_contains(F.array(*wrong), True)).count() == 0
