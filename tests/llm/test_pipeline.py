import corpus_pipeline as cp
from tests.llm.fixtures import SF, clashing, documents, empty_documents, odd_documents


def test_stages_hand_on_the_columns_of_documents(spark):
    docs = documents(spark)
    for name, stage in cp.STAGES[:-1]:
        before, docs = docs, cp.staged(stage(spark, docs, SF), name)
        assert docs.columns == before.columns and docs.count() > 0
        if name != "mixing":
            assert docs.join(before, docs.columns, "left_anti").count() == 0
            assert docs.select("doc_id").distinct().count() == docs.count()
    ids = {r["doc_id"] for r in docs.collect()}
    packed = cp.STAGES[-1][1](spark, docs, SF)
    assert {r["doc_id"] for r in packed.collect()} == ids


def test_run_is_repeatable(spark):
    key = ["doc_id", "piece", "length", "ids_crc32"]
    first, second = (sorted(map(tuple, cp.run(spark, SF).select(key).collect())) for _ in range(2))
    assert first == second and first


def test_odd_and_empty_documents_go_through(spark):
    for docs in (clashing(odd_documents(spark), "doc", "digest", "fp", "copy"), empty_documents(spark)):
        for name, stage in cp.STAGES:
            docs = cp.staged(stage(spark, docs, SF), name)
        docs.count()
