"""Landed runs are stored where their join leaves them: their wide rows are not shuffled again."""

from testbed.stages import Stages


def test_wide_rows_are_not_dealt_out_again(spark, tmp_path, monkeypatch):
    (spark.range(40).selectExpr(
        "id AS l_orderkey", "cast(id % 7 + 1 AS int) AS l_linenumber", "id % 5 AS l_partkey",
        "id % 3 AS l_suppkey", "cast(id % 50 + 1 AS double) AS l_quantity",
        "10.5D AS l_extendedprice", "'R' AS l_returnflag", "'O' AS l_linestatus",
        "timestamp'2024-01-01 00:00:00' AS l_shipdate")
     .unionAll(spark.sql(  # an order that does not exist, and one that is not known
         "SELECT * FROM VALUES (99L, 1, 1L, 1L, 2D, 3D, 'A', 'F', timestamp'2024-01-01 00:00:00'), "
         "(NULL, 1, 1L, 1L, 2D, 3D, 'A', 'F', timestamp'2024-01-01 00:00:00')"))
     .write.parquet(f"{tmp_path}/lineitem.parquet"))
    spark.range(40).selectExpr("id AS o_orderkey", "id % 4 AS o_custkey", "'1-URGENT' AS o_orderpriority") \
        .write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(4).selectExpr("id AS c_custkey", "cast(id AS int) AS c_nationkey") \
        .write.parquet(f"{tmp_path}/customer.parquet")
    plans, stored = [], Stages.stored

    def watched(self, name, build, **options):
        def built():
            rows = build()
            plans.append(rows._jdf.queryExecution().executedPlan().toString())
            return rows
        return stored(self, name, built, **options)

    monkeypatch.setattr(Stages, "stored", watched)
    runs = Stages(spark, str(tmp_path)).raw_runs()
    assert sorted(r.experiment_accession for r in runs.collect()) == sorted(f"SRX{i}" for i in range(40))
    assert "Join" in plans[0] and "RoundRobinPartitioning" not in plans[0]
