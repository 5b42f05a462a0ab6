"""A key holding a third of all rows (all tied in one batch) is split across tasks, not gathered."""

import random

from rawfold.operators.latest import keep_latest

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
}


def test_hot_key_with_ties_is_split_by_aqe(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        rnd = random.Random(11)
        rows = [(rnd.randint(0, 5000), rnd.randint(1, 5), f"p{i}") for i in range(20000)]
        rows += [(7, 9, f"hot{i}") for i in range(10000)]  # one third of the rows, one key, one batch
        df = spark.createDataFrame(rows, "k long, b long, payload string").repartition(8)
        out = keep_latest(df, ["k"], ["b"], ties=True)
        got = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan and "AQEShuffleRead skewed" in plan
        assert sum(1 for r in got if r.k == 7) == 10000  # whole result: every tied row of the hot key
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
