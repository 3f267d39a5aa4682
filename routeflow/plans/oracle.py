"""SQL (DuckDB dialect) for every registered query, over the driver's tables.

Thresholds, rules and aggregates are written here anew; only names, messages, prompt texts, labels and column lists are imported.

The fixture adapter, the landing-text defects and the curation rules are restated here in plain
SQL, so each Spark result is checked against a formulation that shares no code with it. Dialect
notes: ``||`` (not ``concat``) so NULL propagates; integer sums cast to BIGINT; a tuple holding a
NULL is excluded from distinct counts explicitly.
"""

from __future__ import annotations

from routeflow import fixed_values as FV
from routeflow.schemas import SOURCE_FIELDS

_SQL_TYPES = {"StringType()": "VARCHAR", "DoubleType()": "DOUBLE", "LongType()": "BIGINT", "DateType()": "DATE"}


def _sql_type(t) -> str:
    return _SQL_TYPES[repr(t)]


SOURCE_COLS = [n for n, _ in SOURCE_FIELDS]


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# --- fixture adapter --------------------------------------------------------------------------

BASE_CTE = """
lines AS (
  SELECT l.l_orderkey AS ok, l.l_partkey, l.l_suppkey, l.l_linenumber AS ln, l.l_quantity, l.l_linestatus,
         l.l_shipdate, s.s_name, s.s_nationkey AS o_nk, c.c_nationkey AS d_nk, p.p_brand, p.p_size,
         n1.n_name AS o_nation, r1.r_name AS o_region, n2.n_name AS d_nation, r2.r_name AS d_region
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN nation n1 ON s.s_nationkey = n1.n_nationkey
  JOIN region r1 ON n1.n_regionkey = r1.r_regionkey
  JOIN nation n2 ON c.c_nationkey = n2.n_nationkey
  JOIN region r2 ON n2.n_regionkey = r2.r_regionkey
),
dated AS (
  SELECT *, CASE WHEN ok % 107 = 0 THEN DATE '2031-01-01' ELSE CAST(l_shipdate AS DATE) END AS fdate
  FROM lines
),
fixture AS (
  SELECT
    CASE WHEN ln = 7 AND ok % 11 = 0 THEN NULL ELSE ' s' || CAST(l_suppkey AS VARCHAR) || ' ' END AS airline_code,
    s_name || ' ' AS airline_name,
    CASE WHEN ok % 97 = 0 THEN NULL
         ELSE ' f' || CAST(l_suppkey AS VARCHAR) || '-' || CAST(l_partkey % 10 AS VARCHAR) END AS flight_number,
    'ap' || lpad(CAST(o_nk AS VARCHAR), 2, '0') || ' ' AS origin_airport,
    'City ' || CAST(o_nk AS VARCHAR) AS origin_city,
    ' ' || o_nation AS origin_country,
    o_region AS origin_region,
    CASE WHEN ln = 6 AND ok % 89 = 0 THEN CAST(95 AS DOUBLE) ELSE CAST(o_nk * 7 - 84 AS DOUBLE) END AS origin_latitude,
    CAST(o_nk * 14 - 168 AS DOUBLE) AS origin_longitude,
    'ap' || lpad(CAST(d_nk AS VARCHAR), 2, '0') AS destination_airport,
    'City ' || CAST(d_nk AS VARCHAR) AS destination_city,
    d_nation || ' ' AS destination_country,
    d_region AS destination_region,
    CAST(d_nk * 7 - 84 AS DOUBLE) AS destination_latitude,
    CAST(d_nk * 14 - 168 AS DOUBLE) AS destination_longitude,
    CASE WHEN ok % 101 = 0 THEN CAST(-1 AS DOUBLE) WHEN ok % 103 = 0 THEN NULL
         ELSE CAST(l_quantity AS DOUBLE) * CAST(100 AS DOUBLE) END AS distance_km,
    CAST(p_size AS BIGINT) AS seats,
    lower(p_brand) AS aircraft_type,
    CAST(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS BIGINT) AS codeshare,
    CAST(ln - 1 AS BIGINT) AS stops,
    fdate AS flight_date,
    CAST(year(fdate) AS BIGINT) AS flight_year,
    CAST(month(fdate) AS BIGINT) AS flight_month,
    CAST(quarter(fdate) AS BIGINT) AS flight_quarter,
    'lineitem.parquet' AS source_file,
    ok AS _ok, s_name AS _s_name
  FROM dated
),
raw_routes AS (
  SELECT {source}, source_file FROM fixture
)
""".replace("{source}", ", ".join(SOURCE_COLS))

_CODES = {"airline_code", "flight_number", "origin_airport", "destination_airport", "aircraft_type"}
_TEXTS = {"airline_name", "origin_city", "origin_country", "origin_region", "destination_city",
          "destination_country", "destination_region"}


def _clean(c: str) -> str:
    if c in _CODES:
        return f"upper(trim({c})) AS {c}"
    if c in _TEXTS:
        return f"trim({c}) AS {c}"
    return c


def _category(x: str) -> str:
    (b1, l1), (b2, l2) = FV.DISTANCE_CATEGORIES
    return f"CASE WHEN {x} < {b1} THEN {_q(l1)} WHEN {x} < {b2} THEN {_q(l2)} ELSE {_q(FV.DISTANCE_CATEGORY_ELSE)} END"


def curated_cte(source: str = "raw_routes", name: str = "curated") -> str:
    return f"""
{name} AS (
  SELECT {", ".join(_clean(c) for c in SOURCE_COLS)},
    upper(trim(origin_airport)) || '-' || upper(trim(destination_airport)) AS route_key,
    CASE WHEN trim(origin_country) <> trim(destination_country) THEN TRUE ELSE FALSE END AS is_international,
    {_category("distance_km")} AS distance_category,
    source_file
  FROM {source}
  WHERE airline_code IS NOT NULL AND flight_date IS NOT NULL
    AND origin_airport IS NOT NULL AND destination_airport IS NOT NULL
)
"""


CURATED_COLS = SOURCE_COLS + ["route_key", "is_international", "distance_category", "source_file"]


def with_ctes(body: str, *extra: str) -> str:
    return "WITH " + ",".join([BASE_CTE, curated_cte(), *extra]) + "\n" + body


# --- landing text and its typed load ----------------------------------------------------------


def _landing_text_cte(line_breaks: bool = False) -> str:
    exprs = []
    for c in SOURCE_COLS:
        t = f"CAST({c} AS VARCHAR)"
        if c == "seats":
            t = f"CASE WHEN _ok % 109 = 0 THEN 'n/a' WHEN _ok % 127 = 0 THEN {t} || '.5' ELSE {t} END"
        elif c == "flight_date":
            t = (f"CASE WHEN _ok % 113 = 0 THEN CAST(flight_year AS VARCHAR) || '-13-' || "
                 f"lpad(CAST(day(flight_date) AS VARCHAR), 2, '0') ELSE {t} END")
        elif c == "airline_name":
            three = "_s_name || chr(10) || '\"Second\", line' || chr(10) || 'third'"
            broken = f"WHEN _ok % 151 = 0 AND codeshare = 1 THEN {three} " if line_breaks else ""
            t = f"""CASE {broken}WHEN _ok % 131 = 0 THEN 'NULL' WHEN _ok % 149 = 0 THEN _s_name || ', "Air" Inc' ELSE {t} END"""
        elif c == "aircraft_type":
            t = f"CASE WHEN _ok % 137 = 0 THEN 'null' ELSE {t} END"
        elif c == "destination_city":
            t = f"CASE WHEN _ok % 139 = 0 THEN '' ELSE {t} END"
        exprs.append(f"{t} AS {c}")
    return "landing_text AS (SELECT " + ", ".join(exprs) + " FROM fixture)"


def _typed_landing_cte() -> str:
    spell = ", ".join(_q(s) for s in FV.NULL_SPELLINGS)
    nulled = ", ".join(f"CASE WHEN {c} IN ({spell}) THEN NULL ELSE {c} END AS {c}" for c in SOURCE_COLS)
    typed, fails = [], []
    for c, t in SOURCE_FIELDS:
        st = _sql_type(t)
        if st == "VARCHAR":
            typed.append(c)
            continue
        conv = f"TRY_CAST(TRY_CAST({c} AS DECIMAL(38,0)) AS BIGINT)" if st == "BIGINT" else f"TRY_CAST({c} AS {st})"
        typed.append(f"{conv} AS {c}")
        fails.append(f"CASE WHEN {c} IS NOT NULL AND {conv} IS NULL THEN {_q(c)} END")
    reason = f"NULLIF(concat_ws(',', {', '.join(fails)}), '')"
    return (
        f"landing_nulled AS (SELECT {nulled} FROM landing_text),\n"
        f"landing_typed AS (SELECT {', '.join(typed)}, {reason} AS reject_reason FROM landing_nulled)"
    )


def landing_ctes() -> list[str]:
    return [_landing_text_cte(), _typed_landing_cte()]


# --- number rendering and enrichment ----------------------------------------------------------


def _num(c: str) -> str:
    return f"regexp_replace(CAST(CAST({c} AS DECIMAL(38,6)) AS VARCHAR), '\\.?0+$', '')"


def _template(parts) -> str:
    out = []
    for p in parts:
        if p.startswith("{") and p.endswith("}"):
            n = p[1:-1]
            out.append(_num(n) if n in ("distance_km", "seats") else n)
        else:
            out.append(_q(p))
    return "(" + " || ".join(out) + ")"


CLASSIFY_PROMPT = _template(FV.CLASSIFY_PROMPT_TEMPLATE)
SUMMARY_PROMPT = _template(FV.SUMMARY_PROMPT_TEMPLATE)
ENRICH_BASE = ["airline_code", "airline_name", "flight_number", "route_key", "origin_city", "origin_country",
               "destination_city", "destination_country", "distance_km", "seats", "aircraft_type",
               "is_international", "distance_category"]


def _rule_label() -> str:
    (b1, _), (b2, _) = FV.DISTANCE_CATEGORIES
    ds, dl, ir, il = (_q(x) for x in FV.ROUTE_LABELS)
    return (f"CASE WHEN {CLASSIFY_PROMPT} IS NULL THEN NULL "
            f"WHEN NOT is_international AND distance_km < {b1} THEN {ds} "
            f"WHEN NOT is_international THEN {dl} WHEN distance_km < {b2} THEN {ir} ELSE {il} END")


TEMPLATE_SUMMARY = (
    "CASE WHEN " + SUMMARY_PROMPT + " IS NULL THEN NULL ELSE "
    "airline_name || ' flight ' || flight_number || ' flies from ' || origin_city || ' (' || origin_country || ')'"
    " || ' to ' || destination_city || ' (' || destination_country || '), ' || " + _num("distance_km") +
    " || ' km with ' || " + _num("seats") + " || ' seats on a ' || aircraft_type || '.' END"
)
NAMES_IN_SUMMARY = f"array_to_string(regexp_extract_all({SUMMARY_PROMPT}, '[A-Z][A-Za-z]*(?: [A-Z][A-Za-z]*)*'), '; ')"


def _enriched_cte(name: str, limit: int | None) -> str:
    base = ", ".join(ENRICH_BASE)
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in ENRICH_BASE)
    sample = f"SELECT {base} FROM curated" + (f" ORDER BY {order} LIMIT {limit}" if limit else "")
    return (f"{name}_rows AS ({sample}),\n{name} AS (SELECT {base}, {_rule_label()} AS route_classification, "
            f"{TEMPLATE_SUMMARY} AS route_summary FROM {name}_rows)")


DASHBOARD_COLS = ["airline_code", "airline_name", "flight_number", "route_key", "origin_city", "origin_country",
                  "destination_city", "destination_country", "distance_km", "distance_category",
                  "is_international", "seats", "aircraft_type"]


# --- checks -----------------------------------------------------------------------------------

_FLIGHT_KEY = ["airline_code", "flight_number", "flight_date", "origin_airport", "destination_airport"]
# The rules below are restated with their own constants.
NULL_KEYS_WHERE = "airline_code IS NULL OR flight_date IS NULL OR origin_airport IS NULL OR destination_airport IS NULL"
DISTANCE_WHERE = "distance_km <= 0 OR distance_km > 20000"
DATE_WHERE = "year(flight_date) NOT BETWEEN 1970 AND 2030"
COORD_WHERE = (
    "greatest(abs(origin_latitude), abs(destination_latitude)) > 90.0 "
    "OR greatest(abs(origin_longitude), abs(destination_longitude)) > 180.0"
)
INTL_WHERE = "is_international <> (trim(origin_country) <> trim(destination_country))"
DISTINCT_TUPLE = (
    "len(list_distinct(list(" + " || chr(31) || ".join(f"CAST({k} AS VARCHAR)" for k in _FLIGHT_KEY) + ")))"
)
TRACED = (
    "SELECT upper(trim(airline_code)) || chr(31) || upper(trim(flight_number)) || chr(31) || CAST(flight_date AS VARCHAR) "
    "AS k FROM raw_routes"
)
ORPHAN_WHERE = (
    "coalesce(c.airline_code || chr(31) || c.flight_number || chr(31) || CAST(c.flight_date AS VARCHAR) "
    f"NOT IN (SELECT k FROM ({TRACED}) WHERE k IS NOT NULL), TRUE)"
)


def _check_sql(fixed: tuple, count_expr: str, source: str, ok: str) -> str:
    cid, name, _, count_name, _ = fixed
    return (f"SELECT {_q(cid)} AS check_id, {_q(name)} AS check_name, CAST({count_expr} AS BIGINT) AS {count_name}, "
            f"CASE WHEN {ok.format(n=count_expr)} THEN 'PASS' ELSE 'FAIL' END AS result FROM {source}")


def _counts_cte() -> str:
    return (
        "counts AS (SELECT "
        "(SELECT count(*) FROM raw_routes) AS n_raw, "
        "(SELECT count(*) FROM curated) AS n_cur, "
        f"(SELECT count(*) FROM curated WHERE {NULL_KEYS_WHERE}) AS n_null, "
        f"(SELECT count(*) - {DISTINCT_TUPLE} FROM curated) AS n_dup, "
        f"(SELECT count(*) FROM curated WHERE {DISTANCE_WHERE}) AS n_dist, "
        f"(SELECT count(*) FROM curated WHERE {DATE_WHERE}) AS n_date, "
        f"(SELECT count(*) FROM curated WHERE {COORD_WHERE}) AS n_coord, "
        f"(SELECT count(*) FROM curated c WHERE {ORPHAN_WHERE}) AS n_orphan, "
        f"(SELECT count(*) FROM curated WHERE {INTL_WHERE}) AS n_intl)"
    )


def _all_checks_rows(with_bounds: bool = True, subset: bool = False) -> str:
    spec = [
        (FV.CHECK_RAW_NOT_EMPTY, "n_raw", 1, None),
        (FV.CHECK_CLEAN_NOT_EMPTY, "n_cur", 1, None),
        (FV.CHECK_NO_NULL_KEYS, "n_null", 0, 0),
        (FV.CHECK_NO_DUPLICATES, "n_dup", 0, 0),
        (FV.CHECK_DISTANCE_VALID, "n_dist", 0, 0),
        (FV.CHECK_FLIGHT_DATE_SANE, "n_date", 0, 0),
        (FV.CHECK_COORDINATES_VALID, "n_coord", 0, 0),
        (FV.CHECK_CURATED_TRACES_TO_RAW, "n_orphan", 0, 0),
        (FV.CHECK_INTERNATIONAL_LOGIC, "n_intl", 0, 0),
    ]
    if subset:
        spec = spec[:3]
    parts = []
    for fixed, col, lo, hi in spec:
        cid, name, layer, _, msg = fixed
        conds = []
        if lo is not None:
            conds.append(f"{col} >= {lo}")
        if hi is not None:
            conds.append(f"{col} <= {hi}")
        lo_s = str(lo) if (with_bounds and lo is not None) else "NULL"
        hi_s = str(hi) if (with_bounds and hi is not None) else "NULL"
        parts.append(
            f"SELECT {_q(cid)} AS check_id, {_q(name)} AS check_name, {_q(layer)} AS layer, "
            f"CASE WHEN {' AND '.join(conds)} THEN 'PASS' ELSE 'FAIL' END AS result, "
            f"CAST({col} AS BIGINT) AS actual_count, CAST({lo_s} AS BIGINT) AS expected_min, "
            f"CAST({hi_s} AS BIGINT) AS expected_max, {_q(msg)} AS message FROM counts"
        )
    return "\nUNION ALL\n".join(parts)


def oracle_sql() -> dict[str, str]:
    cur_cols = ", ".join(CURATED_COLS)
    raw_cols = ", ".join(SOURCE_COLS)
    base = ", ".join(ENRICH_BASE)
    dash = ", ".join(f"c.{c}" for c in DASHBOARD_COLS)
    smoke = FV.SMOKE_ROW
    smoke_vals = []
    for (c, t), v in zip(SOURCE_FIELDS, smoke):
        st = _sql_type(t)
        smoke_vals.append(f"CAST({_q(str(v)) if st in ('VARCHAR', 'DATE') else repr(v)} AS {st}) AS {c}")
    sql = {}

    sql["p_curate"] = with_ctes(f"SELECT {cur_cols} FROM curated")
    sql["s_csv_roundtrip_load"] = with_ctes(
        f"SELECT {raw_cols} FROM landing_typed WHERE reject_reason IS NULL", *landing_ctes()
    )
    sql["s_csv_rejects"] = with_ctes(
        "SELECT reject_reason, count(*) AS rejected_rows FROM landing_typed WHERE reject_reason IS NOT NULL "
        "GROUP BY reject_reason",
        *landing_ctes(),
    )
    sql["s_csv_rejected_text"] = with_ctes(
        "SELECT flight_number, seats, flight_date FROM landing_text WHERE seats = 'n/a' OR flight_date LIKE '%-13-%'", _landing_text_cte()
    )
    sql["s_csv_load_defaults"] = with_ctes(
        "SELECT TRUE AS has_file_name, TRUE AS stamped_by_load, count(*) AS loaded_rows FROM landing_typed WHERE reject_reason IS NULL",
        *landing_ctes(),
    )
    sql["s_csv_load_history"] = with_ctes(
        "SELECT 'copy-' || CASE WHEN codeshare = 1 THEN '1' ELSE '2' END AS load_id, codeshare, count(*) AS loaded_rows FROM landing_typed "
        "WHERE reject_reason IS NULL GROUP BY codeshare",
        *landing_ctes(),
    )
    sql["s_csv_quoted_breaks"] = with_ctes(
        f"SELECT {raw_cols} FROM landing_typed WHERE reject_reason IS NULL", _landing_text_cte(line_breaks=True), _typed_landing_cte()
    )
    sql["s_csv_wide_numbers"] = with_ctes(
        "SELECT flight_number, CAST(stops AS BIGINT) AS stops, CASE WHEN regexp_full_match(seats, '[0-9]+') THEN seats || '00000000000000000007' "
        "ELSE CAST(CAST(seats AS DECIMAL(38,0)) AS VARCHAR) END AS seats_text FROM landing_nulled "
        "WHERE seats <> 'n/a' AND (flight_date IS NULL OR TRY_CAST(flight_date AS DATE) IS NOT NULL)",
        *landing_ctes(),
    )
    sql["p_curate_inserts"] = with_ctes(f"SELECT {cur_cols} FROM curated WHERE stops > 0")
    sql["k_views_through_sql"] = with_ctes(
        "SELECT route_key, is_international, flight_count FROM (SELECT route_key, is_international, count(*) AS flight_count FROM curated "
        "GROUP BY route_key, is_international, origin_airport, origin_city, origin_country, destination_airport, destination_city, destination_country, "
        "distance_category) WHERE flight_count > 1"
    )
    sql["k_manual_insert"] = with_ctes(
        f"SELECT {raw_cols}, source_file FROM raw_routes UNION ALL "
        f"SELECT {', '.join(smoke_vals)}, {_q(FV.SMOKE_SOURCE_FILE)} AS source_file"
    )
    sql["t_stream_ingest"] = sql["s_csv_roundtrip_load"]
    sql["t_stream_curate_all"] = sql["p_curate"]
    sql["t_stream_curate_new"] = with_ctes(f"SELECT {cur_cols} FROM curated WHERE codeshare = 0")
    sql["t_no_new_data"] = sql["p_curate"]
    sql["t_ingest_late_file"] = sql["s_csv_roundtrip_load"]
    sql["t_curate_after_replay"] = sql["p_curate"]
    sql["t_curate_after_torn_commit"] = sql["p_curate"]
    sql["t_stream_by_ledger"] = sql["p_curate"]
    sql["t_has_data"] = with_ctes(
        "SELECT '1 declared' AS step, FALSE AS has_data, CAST(0 AS BIGINT) AS curated_rows UNION ALL SELECT '2 loaded', TRUE, 0 "
        "UNION ALL SELECT '3 curated', FALSE, count(*) FROM curated WHERE codeshare = 1 "
        "UNION ALL SELECT '4 loaded again', TRUE, count(*) FROM curated WHERE codeshare = 1 "
        "UNION ALL SELECT '5 curated again', FALSE, count(*) FROM curated"
    )

    ends = ["route_key", *(f"{e}_{x}" for e in ("origin", "destination") for x in ("airport", "city", "country")),
            "is_international", "distance_category"]
    mean = "floor(sum(distance_km) / count(distance_km) * 10 + 0.5) / 10"
    sql["a_route_summary"] = with_ctes(
        f"SELECT {', '.join(ends)}, {mean} AS avg_distance_km, count(*) AS flight_count, "
        "len(list_distinct(list(airline_code))) AS airline_count, CAST(list_sum(list(seats)) AS BIGINT) AS total_seats, "
        "list_min(list(flight_date)) AS first_flight, list_max(list(flight_date)) AS last_flight FROM curated GROUP BY ALL"
    )
    sql["a_airline_stats"] = with_ctes(
        "SELECT code AS airline_code, name AS airline_name, CAST(sum(n) AS BIGINT) AS total_flights, "
        "len(list_distinct(list(route_key))) AS unique_routes, len(list_distinct(list(origin_country))) AS countries_served, "
        "floor(sum(km) / sum(with_km) * 10 + 0.5) / 10 AS avg_distance_km, CAST(sum(abroad) AS BIGINT) AS international_flights, "
        "floor(sum(abroad) * 1000.0 / sum(n) + 0.5) / 10 AS pct_international FROM per_route GROUP BY code, name",
        "per_route AS (SELECT airline_code AS code, airline_name AS name, route_key, origin_country, count(*) AS n, "
        "sum(distance_km) AS km, count(distance_km) AS with_km, count(*) FILTER (WHERE is_international) AS abroad "
        "FROM curated GROUP BY ALL)",
    )
    busiest = (
        "SELECT e.code AS airport_code, e.city AS city, e.country AS country, count(*) AS total_appearances, "
        "len(list_distinct(list(route_key))) AS unique_routes FROM (SELECT route_key, unnest(["
        "{'code': origin_airport, 'city': origin_city, 'country': origin_country}, "
        "{'code': destination_airport, 'city': destination_city, 'country': destination_country}]) AS e FROM curated) "
        "GROUP BY e.code, e.city, e.country"
    )
    sql["a_busiest_airports"] = with_ctes(busiest)
    sql["a_busiest_airports_explode"] = with_ctes(busiest)

    sql["a_route_summary_incremental"] = sql["a_route_summary"]
    sql["a_airline_stats_incremental"] = sql["a_airline_stats"]
    sql["a_busiest_airports_incremental"] = sql["a_busiest_airports"]
    sql["o_airline_rank"] = with_ctes(
        "SELECT airline_code, airline_name, count(*) AS total_flights, "
        "row_number() OVER (ORDER BY count(*) DESC, airline_code NULLS FIRST, airline_name NULLS FIRST) AS rank FROM curated GROUP BY airline_code, airline_name"
    )
    sql["o_airport_rank"] = with_ctes(
        "SELECT *, row_number() OVER (ORDER BY total_appearances DESC, airport_code NULLS FIRST, city NULLS FIRST, country NULLS FIRST) AS rank "
        f"FROM ({busiest})"
    )
    sql["e_prompts"] = with_ctes(
        f"SELECT {base}, {CLASSIFY_PROMPT} AS classify_prompt, {SUMMARY_PROMPT} AS summary_prompt FROM curated"
    )
    sql["e_classify"] = with_ctes(f"SELECT {base}, {_rule_label()} AS route_classification FROM curated")
    by_country = {c: " + ".join(f"contains(p, '{w}')::INT" for w in c.lower().split("_")) for c in ("UNITED_STATES", "UNITED_KINGDOM", "SAUDI_ARABIA", "CHINA")}
    shares = {c: f"(({x}) / {len(c.split('_'))})" for c, x in by_country.items()}
    best = f"greatest({', '.join(shares.values())})"
    picked = " ".join(f"WHEN {x} = {best} THEN '{c}'" for c, x in shares.items())
    sql["e_classify_batched"] = with_ctes(
        f"SELECT {base}, CASE WHEN {best} = 0 THEN NULL {picked} END AS route_classification FROM (SELECT *, lower({CLASSIFY_PROMPT}) AS p FROM curated)"
    )
    sql["e_classify_memo"] = sql["e_classify_batched"]
    sql["e_memo_calls"] = with_ctes(
        "SELECT 1 AS run, count(DISTINCT p) FILTER (WHERE codeshare = 1) AS prompts_scored FROM asked UNION ALL "
        "SELECT 2, count(DISTINCT p) - count(DISTINCT p) FILTER (WHERE codeshare = 1) FROM asked UNION ALL SELECT 3, 0",
        f"asked AS (SELECT codeshare, {CLASSIFY_PROMPT} AS p FROM curated)",
    )
    sql["e_complete"] = with_ctes(f"SELECT {base}, {TEMPLATE_SUMMARY} AS route_summary FROM curated")
    sql["e_complete_batched"] = with_ctes(f"SELECT {base}, {NAMES_IN_SUMMARY} AS route_summary FROM curated")
    sql["e_enriched_table"] = with_ctes(
        f"SELECT {base}, route_classification, route_summary FROM enriched",
        _enriched_cte("enriched", FV.ENRICH_SAMPLE_ROWS),
    )
    sql["j_dashboard"] = with_ctes(
        f"SELECT {dash}, e.route_classification, e.route_summary FROM curated c LEFT JOIN enriched e "
        "ON c.route_key = e.route_key AND c.flight_number = e.flight_number",
        _enriched_cte("enriched", FV.ENRICH_SAMPLE_ROWS),
    )
    sql["j_dashboard_latest"] = with_ctes(
        f"SELECT {dash}, e.route_classification, e.route_summary FROM curated c LEFT JOIN latest e "
        "ON c.route_key = e.route_key AND c.flight_number = e.flight_number",
        _enriched_cte("enriched", None),
        "latest AS (SELECT route_key, flight_number, route_classification, route_summary FROM ("
        "SELECT *, row_number() OVER (PARTITION BY route_key, flight_number ORDER BY route_classification DESC NULLS LAST, "
        "route_summary DESC NULLS LAST) AS rn FROM enriched) WHERE rn = 1)",
    )

    label, summary = _rule_label(), TEMPLATE_SUMMARY
    sql["j_dashboard_newest"] = with_ctes(
        f"SELECT {dash}, TIMESTAMP '2026-01-02 00:00:00' AS enriched_at, e.route_classification, e.route_summary "
        "FROM curated c LEFT JOIN newest e ON c.route_key = e.route_key AND c.flight_number = e.flight_number WHERE c.flight_number IS NOT NULL "
        f"UNION ALL SELECT {dash}, NULL, NULL, NULL FROM curated c WHERE c.flight_number IS NULL",
        f"newest AS (SELECT route_key, flight_number, (s).route_classification AS route_classification, (s).route_summary AS route_summary FROM ("
        f"SELECT route_key, flight_number, first(s ORDER BY s.route_classification DESC NULLS LAST, s.route_summary DESC NULLS LAST) AS s FROM ("
        f"SELECT route_key, flight_number, {{'route_classification': {label}, 'route_summary': {summary}}} AS s FROM curated) "
        "GROUP BY route_key, flight_number))",
    )
    sql["q_raw_not_empty"] = with_ctes(_check_sql(FV.CHECK_RAW_NOT_EMPTY, "count(*)", "raw_routes", "{n} > 0"))
    sql["q_clean_not_empty"] = with_ctes(_check_sql(FV.CHECK_CLEAN_NOT_EMPTY, "count(*)", "curated", "{n} > 0"))
    sql["q_clean_not_empty_on_empty"] = with_ctes(
        _check_sql(FV.CHECK_CLEAN_NOT_EMPTY, "count(*)", "curated WHERE airline_code IS NULL", "{n} > 0")
    )
    sql["q_no_null_keys"] = with_ctes(
        _check_sql(FV.CHECK_NO_NULL_KEYS, "count(*)", f"curated WHERE {NULL_KEYS_WHERE}", "{n} = 0")
    )
    sql["q_no_duplicates"] = with_ctes(
        _check_sql(FV.CHECK_NO_DUPLICATES, f"count(*) - {DISTINCT_TUPLE}", "curated", "{n} = 0")
    )
    sql["q_distance_valid"] = with_ctes(
        _check_sql(FV.CHECK_DISTANCE_VALID, "count(*)", f"curated WHERE {DISTANCE_WHERE}", "{n} = 0")
    )
    sql["q_flight_date_sane"] = with_ctes(
        _check_sql(FV.CHECK_FLIGHT_DATE_SANE, "count(*)", f"curated WHERE {DATE_WHERE}", "{n} = 0")
    )
    sql["q_coordinates_valid"] = with_ctes(
        _check_sql(FV.CHECK_COORDINATES_VALID, "count(*)", f"curated WHERE {COORD_WHERE}", "{n} = 0")
    )
    sql["q_curated_traces_to_raw"] = with_ctes(
        _check_sql(FV.CHECK_CURATED_TRACES_TO_RAW, "count(*)", f"curated c WHERE {ORPHAN_WHERE}", "{n} = 0")
    )
    sql["q_international_logic"] = with_ctes(
        _check_sql(FV.CHECK_INTERNATIONAL_LOGIC, "count(*)", f"curated WHERE {INTL_WHERE}", "{n} = 0")
    )
    sql["q_orphan_rows"] = with_ctes(f"SELECT {', '.join('c.' + x for x in CURATED_COLS)} FROM curated c WHERE {ORPHAN_WHERE}")
    sql["q_trace_colocated"] = sql["q_curated_traces_to_raw"]
    sql["q_orphans_colocated"] = sql["q_orphan_rows"]
    sql["k_stored_route_summary"] = sql["a_route_summary"]
    sql["k_stored_airline_stats"] = sql["a_airline_stats"]
    sql["k_stored_busiest_airports"] = sql["a_busiest_airports"]
    sql["k_stored_dashboard"] = sql["j_dashboard"]
    sql["k_sql_insert_defaults"] = with_ctes(
        f"SELECT {', '.join(c for c in CURATED_COLS if c != 'source_file')}, TRUE AS defaults_filled FROM curated"
    )
    sql["q_all_checks_fused"] = with_ctes(_all_checks_rows(), _counts_cte())
    sql["q_audit_append"] = sql["q_all_checks_fused"]
    sql["q_checks_incremental"] = sql["q_all_checks_fused"]
    sql["o_audit_rank"] = with_ctes(
        "SELECT row_number() OVER (ORDER BY minute DESC, check_id) AS rank, check_id, actual_count, minute AS run_minute FROM ("
        + _all_checks_rows(with_bounds=False, subset=True) + ") CROSS JOIN (VALUES ('12:00'), ('11:57')) AS runs(minute)",
        _counts_cte(),
    )
    sql["q_recent_audit"] = with_ctes(
        "SELECT check_id, check_name, layer, result, actual_count FROM ("
        + _all_checks_rows(with_bounds=False, subset=True) + ")",
        _counts_cte(),
    )
    return sql
