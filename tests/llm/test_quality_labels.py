"""The sample of labels is drawn from those of documents in the table."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tallyhouse.llm.common import table
from tallyhouse.llm.quality_model import score_quality


def test_labels_of_other_documents_do_not_use_up_the_sample(spark):
    docs, labels = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "labels").select("doc_id", "quality")
    foreign = spark.range(10**6, 10**6 + 5000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))

    def scores(known):
        rows = score_quality(docs, known, max_train_rows=100).select("doc_id", "_quality_score.score").collect()
        return sorted((r["doc_id"], round(r["score"], 9)) for r in rows)

    want = scores(labels)
    assert len({s for _, s in want}) > 1
    assert scores(labels.unionByName(foreign)) == want
