"""States, ranks and split joins against the plain forms."""

import datetime as dt

from conftest import route_row, routes_df
from pyspark.sql import functions as F

from routeflow.operators import quality as Q
from routeflow.operators import states as S
from routeflow.operators import views as V
from routeflow.plans.layers import load_raw_rows
from routeflow.sources import ledger
from routeflow.sources.tables import read_curated, read_raw
from routeflow.streaming.incremental import run_curation


def _load(spark, fresh, rows):
    load_raw_rows(routes_df(spark, rows), fresh)
    run_curation(spark, fresh.raw, fresh.curated, fresh.checkpoint("curate"))
    S.update_all(spark, fresh)


def _same(a, b):
    assert sorted(map(str, a.select(*b.columns).collect())) == sorted(map(str, b.collect()))


def _all_equal(spark, fresh):
    cur, raw = read_curated(spark, fresh.curated), read_raw(spark, fresh.raw)
    _same(S.route_summary(spark, fresh), V.route_summary(cur))
    _same(S.airline_stats(spark, fresh), V.airline_stats(cur))
    _same(S.busiest_airports(spark, fresh), V.busiest_airports(cur))
    _same(S.run_checks(spark, fresh), Q.run_checks(cur, raw))


def test_states_equal_full_aggregations_after_every_load(spark, fresh):
    S.update_all(spark, fresh)
    _all_equal(spark, fresh)  # empty tables
    _load(spark, fresh, [route_row(), route_row(distance_km=None, seats=None), route_row(airline_code="BA", flight_number=None, distance_km=-1.0)])
    _all_equal(spark, fresh)
    _load(spark, fresh, [route_row(), route_row(airline_code="BA", origin_latitude=99.0, flight_date=dt.date(1950, 1, 1)), route_row(airline_code=None)])
    _all_equal(spark, fresh)
    entries = len(ledger.entries(spark, fresh.states("curated")))
    S.update_all(spark, fresh)  # nothing new: nothing read, nothing kept
    assert len(ledger.entries(spark, fresh.states("curated"))) == entries == 2


def test_states_are_read_instead_of_the_tables(spark, fresh):
    _load(spark, fresh, [route_row()])
    for df in (S.route_summary(spark, fresh), S.run_checks(spark, fresh)):
        files = df.inputFiles()
        assert files and all("/states/" in f for f in files)


def test_rank_is_the_global_row_number(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") * 37 % 101).alias("v")).repartition(5)
    got = V.with_rank(df, [F.desc("v"), F.asc("id")]).collect()
    want = sorted(((-r["v"], r["id"]) for r in df.collect()))
    assert [(-r["v"], r["id"]) for r in sorted(got, key=lambda r: r["rank"])] == want
    assert sorted(r["rank"] for r in got) == list(range(1, 1001))
    assert V.with_rank(df.where("false"), [F.asc("id")]).count() == 0


def test_split_join_equals_the_plain_one_and_spreads_a_hot_key(spark):
    left = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 1000 == 1, None).otherwise(F.col("id") + 100).alias("k"), F.lit("x").alias("f"), "id")
    right = spark.range(0, 4000).select((F.col("id") + 100).alias("k"), F.lit("x").alias("f"), F.col("id").alias("w"))
    right = right.unionByName(spark.createDataFrame([(7, "x", -1), (7, "x", -2), (None, "x", -3)], "k long, f string, w long"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        plain = left.join(right, ["k", "f"], "left")
        split = V.split_left_join(left, right, ["k", "f"], one_in=20, splits=64)
        _same(split, plain)

        def sizes(df):
            return sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())

        assert max(sizes(plain)) > 6 * sizes(plain)[8]
        assert max(sizes(split)) <= 2 * sizes(split)[8]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    _same(V.split_left_join(left.where("false"), right, ["k", "f"]), plain.where("false"))
