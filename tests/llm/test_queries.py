"""Every registered query over its whole tables: against SQL where there is one, and the pipeline's stages."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from rawfold.llm.oracle import SQL
from rawfold.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "documents benchmark labels conversations".split()


def test_one_query_per_operator_and_the_pipeline():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_dups", "decontaminate", "mix", "tokens"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found = con.execute(SQL[name])
    names = [d[0] for d in found.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(str, map(tuple, got.select(*names).collect()))) == sorted(map(str, found.fetchall()))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_one_row_per_document(spark, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = QUERIES[name](spark, SF)
    assert got.count() == docs.count() and got.select("doc_id").exceptAll(docs.select("doc_id")).isEmpty()


def test_op5_scores_by_contexts_of_two_words(spark):
    from rawfold.llm.common import crc_mod_col
    from rawfold.llm.kn_lm import build, score
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {(r["doc_id"], r["score"]) for r in QUERIES["op5_lm_score"](spark, SF).collect()}
    learn = crc_mod_col("doc_id", 5) != 1
    of = [{(r["doc_id"], r["score"]) for r in score(docs, build(docs, learn, order=k)).collect()} for k in (2, 3)]
    assert got == of[1] != of[0]


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.materialize(stage(spark, before, SF), f"test-{name}")
        assert after.columns == docs.columns, name
        new = after.join(before, "doc_id", "left_anti").count()
        assert new == 0
        if name == "language":
            assert after.count() >= 0.98 * before.count()
        elif name in ("near_dups", "decontaminate"):
            assert after.count() < before.count()
        before = after
    from rawfold.llm.minhash import near_dup
    assert near_dup(before.dropDuplicates(["doc_id"])).filter("not kept").isEmpty()
    last = corpus_pipeline.STAGES[-1][1](spark, before, SF)
    assert last.count() == before.count() and last.agg({"start": "min"}).first()[0] == 0


def test_pipeline_run_on_edge_rows(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(9001, None, None, None, 0), (9002, "", "en", "src1", 0), (9003, "12 34", None, "src2", 5),
                                 (9004, docs.first()["text"], "en", None, None), (9004, docs.first()["text"], "en", None, None)], docs.schema)
    docs.unionByName(odd).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert out.filter("doc_id between 9001 and 9003").count() == 0  # no letter: not recognised
    docs.limit(0).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(str(tmp_path / "none" / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
