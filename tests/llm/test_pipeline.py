import re

import corpus_pipeline
import edges
from starfold.llm.common import table, written

FOLDER = "/root/testdata/sf0.01"


def test_stages_in_turn(spark):
    docs = table(spark, FOLDER, "documents")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, FOLDER), f"test_{name}")
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.7 * counts[0]
    texts = [r.text for r in docs.collect()]
    assert not any(re.search(r"[0-9a-f]{24}", t) for t in texts)
    assert sum("[SECRET]" in t for t in texts) > 0
    out = corpus_pipeline.run(spark, FOLDER)
    assert out.count() == counts[-1] and {"doc_id", "n_tokens", "ids", "ids_sha256"} <= set(out.columns)


def test_stages_on_awkward_documents(spark, tmp_path):
    docs = edges.documents(spark)
    edges.some_labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "some item of words")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for source in (docs, docs.limit(0)):
        own = source
        for _, stage in corpus_pipeline.STAGES[:-1]:
            own = written(stage(spark, own, str(tmp_path)), "test_edges")
            assert own.columns == docs.columns and own.dtypes == docs.dtypes
            for r in own.collect():
                assert [r[n] for n in edges.INTERNAL] == [f"own {n}" for n in edges.INTERNAL]
        last = corpus_pipeline.STAGES[-1][1](spark, own, str(tmp_path))
        assert last.count() == own.count()
        assert all([r[n] for n in edges.INTERNAL] == [f"own {n}" for n in edges.INTERNAL] for r in last.collect())
