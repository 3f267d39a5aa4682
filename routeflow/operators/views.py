"""Reporting views over the curated (and enriched) tables.

Each view is a function ``DataFrame -> DataFrame``; ``publish`` registers one as a temp view for SQL
users. Aggregations run partial (map-side) then final, so a hot group key costs one partial row
per input partition, not a skewed reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from routeflow.functions import columns as C
from routeflow.session import scratch_path

ROUTE_GROUP = (
    "route_key",
    "origin_airport",
    "origin_city",
    "origin_country",
    "destination_airport",
    "destination_city",
    "destination_country",
    "is_international",
    "distance_category",
)


def _distinct_count(c: str, approx: bool, rsd: float) -> Column:
    return F.approx_count_distinct(c, rsd) if approx else F.countDistinct(c)


def _sorted(df: DataFrame, by: Sequence[Column], top_n: int | None) -> DataFrame:
    ordered = df.orderBy(*by)
    return ordered.limit(top_n) if top_n else ordered


def route_summary(
    curated: DataFrame,
    group: Sequence[str] = ROUTE_GROUP,
    *,
    distance: str = "distance_km",
    carrier: str = "airline_code",
    seats: str = "seats",
    flight_date: str = "flight_date",
    approx: bool = False,
    rsd: float = 0.05,
) -> DataFrame:
    """Per-route facts: one row per distinct combination of the ``group`` columns.

    A route whose rows straddle a category boundary or spell a city differently yields several rows.
    """
    return curated.groupBy(*group).agg(
        F.round(F.avg(distance), 1).alias("avg_distance_km"),
        F.count(F.lit(1)).alias("flight_count"),
        _distinct_count(carrier, approx, rsd).alias("airline_count"),
        F.sum(seats).alias("total_seats"),
        F.min(flight_date).alias("first_flight"),
        F.max(flight_date).alias("last_flight"),
    )


def airline_stats(
    curated: DataFrame,
    group: Sequence[str] = ("airline_code", "airline_name"),
    *,
    route: str = "route_key",
    country: str = "origin_country",
    distance: str = "distance_km",
    flag: str = "is_international",
    approx: bool = False,
    rsd: float = 0.05,
    ordered: bool = True,
    top_n: int | None = None,
) -> DataFrame:
    """Carrier comparison, most flights first (ties broken by the group keys).

    Two levels: flights are first summed per carrier, route and country (map-side), so what Catalyst expands for the two
    exact distinct counts is that small result, not the scan. ``approx=True`` takes HyperLogLog++ sketches in one level.
    """
    intl, total = F.sum(C.as_flag(F.col(flag))), F.count(F.lit(1))
    if approx:
        out = curated.groupBy(*group).agg(
            total.alias("total_flights"),
            _distinct_count(route, True, rsd).alias("unique_routes"),
            _distinct_count(country, True, rsd).alias("countries_served"),
            F.round(F.avg(distance), 1).alias("avg_distance_km"),
            intl.cast(T.LongType()).alias("international_flights"),
            F.round((F.lit(100.0) * intl / total).cast(T.DoubleType()), 1).alias("pct_international"),
        )
    else:
        keys = list(dict.fromkeys([*group, route, country]))
        small = curated.groupBy(*keys).agg(
            total.alias("_n"), intl.alias("_intl"), F.sum(distance).alias("_km"), F.count(distance).alias("_with_km")
        )
        flights, abroad = F.sum("_n"), F.sum("_intl")
        out = small.groupBy(*group).agg(
            flights.alias("total_flights"),
            F.countDistinct(route).alias("unique_routes"),
            F.countDistinct(country).alias("countries_served"),
            F.round(F.try_divide(F.sum("_km"), F.sum("_with_km")), 1).alias("avg_distance_km"),
            abroad.cast(T.LongType()).alias("international_flights"),
            F.round((F.lit(100.0) * abroad / flights).cast(T.DoubleType()), 1).alias("pct_international"),
        )
    if not ordered and not top_n:
        return out
    return _sorted(out, [F.desc("total_flights"), *[F.asc_nulls_first(g) for g in group]], top_n)


def airport_roles(
    curated: DataFrame,
    *,
    mode: str = "explode",
    origin: Sequence[str] = ("origin_airport", "origin_city", "origin_country"),
    destination: Sequence[str] = ("destination_airport", "destination_city", "destination_country"),
    names: Sequence[str] = ("airport_code", "city", "country"),
    route: str = "route_key",
) -> DataFrame:
    """Two rows per flight: the origin end and the destination end (duplicates kept).

    ``mode='union'`` is UNION ALL of two projections (two scans of the input); ``mode='explode'``
    emits both ends from one scan via ``inline(array(struct, struct))``.
    """
    if mode == "union":
        a = curated.select(*[F.col(c).alias(n) for c, n in zip(origin, names)], F.col(route))
        b = curated.select(*[F.col(c).alias(n) for c, n in zip(destination, names)], F.col(route))
        return a.unionAll(b)
    if mode != "explode":
        raise ValueError(f"mode must be 'union' or 'explode', got {mode!r}")
    ends = F.array(
        F.struct(*[F.col(c).alias(n) for c, n in zip(origin, names)]),
        F.struct(*[F.col(c).alias(n) for c, n in zip(destination, names)]),
    )
    return curated.select(F.inline(ends), F.col(route))


def busiest_airports(
    curated: DataFrame,
    *,
    mode: str = "explode",
    route: str = "route_key",
    approx: bool = False,
    rsd: float = 0.05,
    ordered: bool = True,
    top_n: int | None = None,
) -> DataFrame:
    """Airports in either role, most appearances first; a same-airport round trip counts twice."""
    roles = airport_roles(curated, mode=mode, route=route)
    out = roles.groupBy("airport_code", "city", "country").agg(
        F.count(F.lit(1)).alias("total_appearances"),
        _distinct_count(route, approx, rsd).alias("unique_routes"),
    )
    if not ordered and not top_n:
        return out
    keys = [F.asc_nulls_first(c) for c in ("airport_code", "city", "country")]
    return _sorted(out, [F.desc("total_appearances"), *keys], top_n)


DASHBOARD_CURATED = (
    "airline_code",
    "airline_name",
    "flight_number",
    "route_key",
    "origin_city",
    "origin_country",
    "destination_city",
    "destination_country",
    "distance_km",
    "distance_category",
    "is_international",
    "seats",
    "aircraft_type",
)
DASHBOARD_ENRICHED = ("route_classification", "route_summary", "enriched_at")


def latest_per_key(
    enriched: DataFrame,
    keys: Sequence[str] = ("route_key", "flight_number"),
    values: Sequence[str] = DASHBOARD_ENRICHED,
    order: str = "enriched_at",
) -> DataFrame:
    """One enriched row per key: newest ``order``, ties broken by the largest remaining values.

    A plain grouped ``max`` over a struct: partial aggregation map-side, no window sort.
    """
    rest = [v for v in values if v != order]
    best = F.max(F.struct(F.col(order), *[F.col(v) for v in rest])).alias("_best")
    return enriched.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{v}").alias(v) for v in values])


def dashboard(
    curated: DataFrame,
    enriched: DataFrame,
    *,
    keys: Sequence[str] = ("route_key", "flight_number"),
    curated_columns: Sequence[str] = DASHBOARD_CURATED,
    enriched_columns: Sequence[str] = DASHBOARD_ENRICHED,
    dedupe: str | None = None,
    split_hot_keys: bool = False,
) -> DataFrame:
    """Curated rows left-joined to enrichment on ``keys`` (NULL keys never match).

    ``dedupe=None`` keeps the plain join: *m* curated and *n* enriched rows with equal keys give
    *m·n* rows. ``dedupe='latest'`` first reduces the enriched side to one row per key.

    The join strategy is left to AQE, which broadcasts on measured size. ``split_hot_keys`` deals the rows of heavy keys over
    several tasks (``split_left_join``), which AQE cannot do after the aggregate of ``dedupe='latest'``.
    """
    # fresh column identities: the enriched frame may descend from the same curated frame
    right = enriched.select(*[F.col(c).alias(c) for c in (*keys, *enriched_columns)])
    if dedupe == "latest":
        right = latest_per_key(right, keys, enriched_columns)
    elif dedupe is not None:
        raise ValueError(f"dedupe must be None or 'latest', got {dedupe!r}")
    left = curated.select(*curated_columns)
    joined = split_left_join(left, right, keys) if split_hot_keys else left.join(right, list(keys), "left")
    return joined.select(*curated_columns, *enriched_columns)


def with_rank(df: DataFrame, by: Sequence[Column], rank: str = "rank") -> DataFrame:
    """``df`` in the order ``by`` (which must leave no ties), with its global row number, without a single-task window.

    Two levels: the rows are sorted by range partitions and written with their place in their partition; the partitions' sizes, summed
    up, give each its offset.
    """
    place, part, found = "_place", "_part", "_found"
    path = scratch_path(df.sparkSession, "ranked")
    df.orderBy(*by).withColumn(place, F.monotonically_increasing_id()).write.parquet(path)
    rows = df.sparkSession.read.parquet(path)
    rows = rows.withColumn(part, F.shiftright(place, 33)).withColumn(place, F.col(place).bitwiseAND(F.lit((1 << 33) - 1)))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # one row per partition of the sort
    sizes = rows.groupBy(part).agg(F.count(F.lit(1)).alias(found)).withColumn(found, F.coalesce(F.sum(found).over(before), F.lit(0)))
    return rows.join(F.broadcast(sizes), part).select(*df.columns, (F.col(found) + F.col(place) + 1).alias(rank))


#: Join keys that hold at least one in so many rows are split; most keys that a summary names.
HEAVY_ONE_IN = 1000
HEAVY_KEYS = 512
SPLITS = 32


def heavy_keys(df: DataFrame, key: Column, one_in: int = HEAVY_ONE_IN) -> DataFrame:
    """Values of ``key`` that may hold one in ``one_in`` rows, from a frequent-items summary: ``HEAVY_KEYS`` rows at most."""
    top = df.where(key.isNotNull()).select(key.alias("key")).agg(F.expr(f"approx_top_k(key, {HEAVY_KEYS}, {8 * HEAVY_KEYS})").alias("top"), F.count(F.lit(1)).alias("n"))
    many = top.select("n", F.explode("top").alias("x")).where(F.col("x.count") * one_in >= F.col("n"))
    return many.select(F.col("x.item").alias("key"))


def split_left_join(left: DataFrame, right: DataFrame, keys: Sequence[str], one_in: int = HEAVY_ONE_IN, splits: int = SPLITS) -> DataFrame:
    """Left join on ``keys`` in which the rows of heavy keys are dealt over ``splits`` parts of the left side.

    The right rows of heavy keys are repeated for each part; all other rows keep part 0. NULL keys match nothing and are dealt out
    too. The result is the plain left join's.
    """
    digest, part = "_key", "_part"
    key = F.when(F.coalesce(*(F.when(F.col(k).isNull(), F.lit(1)) for k in keys)).isNull(), F.xxhash64(*keys))
    heavy = F.broadcast(heavy_keys(left, key, one_in).select(F.col("key").alias("_heavy")))
    dealt = F.pmod(F.monotonically_increasing_id(), F.lit(splits)).cast("int")
    lefts = left.withColumn(digest, key)
    lefts = lefts.join(heavy, F.col(digest) == F.col("_heavy"), "left")
    lefts = lefts.withColumn(part, F.when(F.col("_heavy").isNotNull() | F.col(digest).isNull(), dealt).otherwise(F.lit(0))).drop(digest, "_heavy")
    rights = right.withColumn(digest, key)
    rights = rights.join(heavy, F.col(digest) == F.col("_heavy"), "left")
    copies = F.when(F.col("_heavy").isNotNull(), F.sequence(F.lit(0), F.lit(splits - 1))).otherwise(F.array(F.lit(0)))
    rights = rights.withColumn(part, F.explode(copies)).drop(digest, "_heavy")
    return lefts.join(rights, [*keys, part], "left").drop(part)


def publish(df: DataFrame, name: str) -> DataFrame:
    """``CREATE OR REPLACE VIEW name``: register for SQL and return the frame."""
    df.createOrReplaceTempView(name)
    return df


VIEW_NAMES = ("v_route_summary", "v_airline_stats", "v_busiest_airports", "v_enriched_routes_dashboard")


def publish_all(curated: DataFrame, enriched: DataFrame | None = None, dedupe: str | None = None) -> dict[str, DataFrame]:
    """Register the reporting views for SQL users (``SELECT * FROM v_airline_stats ...``)."""
    views = {
        "v_route_summary": route_summary(curated),
        "v_airline_stats": airline_stats(curated),
        "v_busiest_airports": busiest_airports(curated),
    }
    if enriched is not None:
        views["v_enriched_routes_dashboard"] = dashboard(curated, enriched, dedupe=dedupe)
    return {name: publish(df, name) for name, df in views.items()}
