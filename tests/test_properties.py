"""Property: incremental loads over any in-order batch split equal one full load."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rawfold.operators.latest import keep_latest
from rawfold.sources.incremental import high_watermark, merge_by_key, watermark_filter

ROW = st.tuples(st.integers(0, 6), st.integers(1, 8), st.integers(0, 3))


@settings(max_examples=6, deadline=None)
@given(rows=st.lists(ROW, min_size=1, max_size=40), cuts=st.lists(st.integers(1, 8), max_size=3), ties=st.booleans())
def test_incremental_equals_full(spark, rows, cuts, ties):
    schema = "k long, _daton_batch_runtime long, v long"
    raw = spark.createDataFrame([(k, b, v) for k, b, v in rows], schema)

    def latest(df):
        return keep_latest(df, ["k"], ["_daton_batch_runtime"], ties=ties, tiebreak=["v"])

    target = None
    for cut in sorted(set(cuts)) + [99]:
        loaded = raw.filter(F.col("_daton_batch_runtime") <= cut)  # the raw table as of this run
        w = high_watermark(target)
        updates = latest(loaded.filter(watermark_filter(w)))
        target = merge_by_key(target, updates, ["k"])
        target = spark.createDataFrame(target.collect(), schema)  # a written version
    full = latest(raw)
    assert sorted(map(tuple, target.collect())) == sorted(map(tuple, full.collect()))
