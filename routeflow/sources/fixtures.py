"""Route-shaped inputs derived from the driver's star-schema tables.

The driver data holds no flights, so one shipment line becomes one flight row: the supplier is the
carrier and origin, the customer the destination. Padding, case, NULLs and out-of-range values are
injected by fixed rules so every cleaning and checking rule has rows to act on. All joins are inner
and keep every line.

Two shapes are produced:

* ``routes_from_tables`` -- typed, raw-shaped rows (24 source columns + ``source_file``);
* ``landing_text_from_tables`` -- the same rows as landing-file text, with extra text-level defects
  (non-numeric seats, month-13 dates, fractional seats, NULL spellings, quotes and commas) for the
  CSV load path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from routeflow.schemas import SOURCE_COLUMNS, SOURCE_FILE
from routeflow.sources.ledger import file_system

FIXTURE_SOURCE_FILE = "lineitem.parquet"
FIXTURE_TABLES = ("lineitem", "orders", "customer", "supplier", "part", "nation", "region")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Up to so many lines the scan's rows are dealt out, since the joins may move none; beyond, the joins' own exchanges deal them.
SPREAD_ROWS = 2_000_000
#: A table of at most this many short rows may be broadcast.
BROADCAST_ROWS = 400_000


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a batch input evenly: the driver's tables are single row groups, hence single scan tasks."""
    return df if df.isStreaming or df.count() > SPREAD_ROWS else df.repartition(F.xxhash64(*df.columns))


def _small(df: DataFrame) -> DataFrame:
    """With a broadcast hint if its counted rows (Parquet footers) allow it."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _joined_lines(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None) -> DataFrame:
    """One row per lineitem with the carrier / destination attributes it maps to.

    Lines are moved while they hold numbers only: once to meet their order (which has met its customer before) and once to meet their
    part. Names of carriers, nations and regions come last, by broadcasts.
    """
    li = spread((lineitem if lineitem is not None else table(spark, sf_dir, "lineitem")).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_linestatus", "l_shipdate"
    ))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")

    def ends(prefix: str) -> DataFrame:
        n = nation.select(
            F.col("n_nationkey").alias(f"{prefix}_nationkey"),
            F.col("n_name").alias(f"{prefix}_nation"),
            F.col("n_regionkey").alias(f"{prefix}_regionkey"),
        )
        r = region.select(F.col("r_regionkey").alias(f"{prefix}_regionkey"), F.col("r_name").alias(f"{prefix}_region"))
        return n.join(r, f"{prefix}_regionkey")

    bound = orders.join(customer, F.col("o_custkey") == customer.c_custkey).select("o_orderkey", "c_nationkey")
    return (
        li.join(bound, li.l_orderkey == bound.o_orderkey)
        .join(part, F.col("l_partkey") == part.p_partkey)
        .join(_small(supplier), F.col("l_suppkey") == supplier.s_suppkey)
        .join(ends("o"), F.col("s_nationkey") == F.col("o_nationkey"))
        .join(ends("d"), F.col("c_nationkey") == F.col("d_nationkey"))
    )


def _s(c: Column) -> Column:
    return c.cast(T.StringType())


def _airport(key: str) -> Column:
    return F.concat(F.lit("ap"), F.lpad(_s(F.col(key)), 2, "0"))


def _typed_columns() -> dict[str, Column]:
    ok, ln = F.col("l_orderkey"), F.col("l_linenumber")
    flight_date = F.when(ok % 107 == 0, F.lit("2031-01-01").cast(T.DateType())).otherwise(
        F.col("l_shipdate").cast(T.DateType())
    )
    distance = F.col("l_quantity").cast(T.DoubleType()) * F.lit(100.0)
    return {
        "airline_code": F.when((ln == 7) & (ok % 11 == 0), F.lit(None).cast(T.StringType())).otherwise(
            F.concat(F.lit(" s"), _s(F.col("l_suppkey")), F.lit(" "))
        ),
        "airline_name": F.concat(F.col("s_name"), F.lit(" ")),
        "flight_number": F.when(ok % 97 == 0, F.lit(None).cast(T.StringType())).otherwise(
            F.concat(F.lit(" f"), _s(F.col("l_suppkey")), F.lit("-"), _s(F.col("l_partkey") % 10))
        ),
        "origin_airport": F.concat(_airport("o_nationkey"), F.lit(" ")),
        "origin_city": F.concat(F.lit("City "), _s(F.col("o_nationkey"))),
        "origin_country": F.concat(F.lit(" "), F.col("o_nation")),
        "origin_region": F.col("o_region"),
        "origin_latitude": F.when((ln == 6) & (ok % 89 == 0), F.lit(95.0)).otherwise(
            (F.col("o_nationkey") * 7 - 84).cast(T.DoubleType())
        ),
        "origin_longitude": (F.col("o_nationkey") * 14 - 168).cast(T.DoubleType()),
        "destination_airport": _airport("d_nationkey"),
        "destination_city": F.concat(F.lit("City "), _s(F.col("d_nationkey"))),
        "destination_country": F.concat(F.col("d_nation"), F.lit(" ")),
        "destination_region": F.col("d_region"),
        "destination_latitude": (F.col("d_nationkey") * 7 - 84).cast(T.DoubleType()),
        "destination_longitude": (F.col("d_nationkey") * 14 - 168).cast(T.DoubleType()),
        "distance_km": F.when(ok % 101 == 0, F.lit(-1.0))
        .when(ok % 103 == 0, F.lit(None).cast(T.DoubleType()))
        .otherwise(distance),
        "seats": F.col("p_size").cast(T.LongType()),
        "aircraft_type": F.lower(F.col("p_brand")),
        "codeshare": F.when(F.col("l_linestatus") == "F", F.lit(1)).otherwise(F.lit(0)).cast(T.LongType()),
        "stops": (ln - 1).cast(T.LongType()),
        "flight_date": flight_date,
        "flight_year": F.year(flight_date).cast(T.LongType()),
        "flight_month": F.month(flight_date).cast(T.LongType()),
        "flight_quarter": F.quarter(flight_date).cast(T.LongType()),
    }


def routes_of_lines(lines: DataFrame) -> DataFrame:
    """Raw-shaped route rows (24 source columns + source_file) of joined lines, a projection."""
    cols = _typed_columns()
    return lines.select(*[cols[c].alias(c) for c in SOURCE_COLUMNS], F.lit(FIXTURE_SOURCE_FILE).alias(SOURCE_FILE))


def routes_from_tables(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None) -> DataFrame:
    """Raw-shaped route rows from the driver tables.

    ``lineitem`` may be a streaming DataFrame over the lineitem files (stream-static joins).
    """
    return routes_of_lines(_joined_lines(spark, sf_dir, lineitem))


#: What route rows are made of.
LINE_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_linestatus", "l_shipdate", "p_brand", "p_size",
    "s_name", "o_nationkey", "o_nation", "o_region", "d_nationkey", "d_nation", "d_region",
)


def lines_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Joined lines of the driver tables, before they are rendered as routes: about half as wide."""
    return _joined_lines(spark, sf_dir).select(*LINE_COLUMNS)


def landing_text_from_tables(spark: SparkSession, sf_dir: str, line_breaks: bool = False) -> DataFrame:
    """The fixture rows as landing-file text (24 string columns, file order).

    Text-level defects on top of the typed ones, by fixed rules on ``l_orderkey``:
    %109 seats 'n/a' (rejected) · %113 month-13 date (rejected) · %127 seats 'N.5' (loads as N+1) ·
    %131 airline_name 'NULL' · %137 aircraft_type 'null' · %139 destination_city '' ·
    %149 airline_name with a quoted comma and doubled quotes. ``line_breaks`` adds: %151 on finished flights airline_name over three lines.
    """
    typed = _typed_columns()
    ok = F.col("l_orderkey")
    text = {c: _s(e) for c, e in typed.items()}
    text["seats"] = (
        F.when(ok % 109 == 0, F.lit("n/a"))
        .when(ok % 127 == 0, F.concat(text["seats"], F.lit(".5")))
        .otherwise(text["seats"])
    )
    text["flight_date"] = F.when(
        ok % 113 == 0, F.concat(text["flight_year"], F.lit("-13-"), F.lpad(_s(F.dayofmonth(typed["flight_date"])), 2, "0"))
    ).otherwise(text["flight_date"])
    text["airline_name"] = (
        F.when(ok % 131 == 0, F.lit("NULL"))
        .when(ok % 149 == 0, F.concat(F.col("s_name"), F.lit(', "Air" Inc')))
        .otherwise(text["airline_name"])
    )
    if line_breaks:
        three = F.concat(F.col("s_name"), F.lit('\n"Second", line\nthird'))
        text["airline_name"] = F.when((ok % 151 == 0) & (typed["codeshare"] == 1), three).otherwise(text["airline_name"])
    text["aircraft_type"] = F.when(ok % 137 == 0, F.lit("null")).otherwise(text["aircraft_type"])
    text["destination_city"] = F.when(ok % 139 == 0, F.lit("")).otherwise(text["destination_city"])
    return _joined_lines(spark, sf_dir).select(*[text[c].alias(c) for c in SOURCE_COLUMNS])


def age_files(spark: SparkSession, folder: str, days: int) -> None:
    """Date the newest batch of files in ``folder`` back by ``days``, as a restore or a slow copy may."""
    path, fs = file_system(spark, folder)
    files = [f for f in fs.listStatus(path) if f.isFile() and not f.getPath().getName().startswith(("_", "."))]
    newest = max(f.getModificationTime() for f in files)
    for f in files:
        if newest - f.getModificationTime() < 1000:
            fs.setTimes(f.getPath(), f.getModificationTime() - days * 86_400_000, -1)
