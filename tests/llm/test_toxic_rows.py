"""The texts that toxicity is tuned and calibrated on meet their labels without being shuffled while the labels are few."""

from pyspark.sql import functions as F

from rawfold.llm import toxicity


def test_few_labels_are_sent_to_the_texts(spark, monkeypatch):
    plans = []

    def calibrated(rows, model):
        plans.append(rows._jdf.queryExecution().sparkPlan().toString())
        return done(rows, model)

    done = toxicity._calibrated
    monkeypatch.setattr(toxicity, "_calibrated", calibrated)
    monkeypatch.setitem(toxicity.fit.__kwdefaults__, "max_docs", 40)
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = spark.range(200).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "bad words here").otherwise("kind words here").alias("text"),
                                       F.lit("en").alias("lang"))
        labels = docs.select("doc_id", F.when(F.col("text").startswith("bad"), 1).otherwise(0).alias("toxic"))
        model = toxicity.fit(docs, labels, F.lit(True), steps=40)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert model is not None and len(plans) == 1
    assert "BroadcastHashJoin" in plans[0] and "SortMergeJoin" not in plans[0]
