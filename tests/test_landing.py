import datetime as dt
import os

from routeflow.operators.curate import curate
from routeflow.schemas import RAW_SCHEMA, SOURCE_COLUMNS, full_width
from routeflow.sources.landing import classify_landing, load_landing, loaded_rows, read_landing, read_rejects, rejected_rows
from routeflow.sources.tables import read_raw

HEADER = ",".join(SOURCE_COLUMNS)
GOOD = ('AA,American Airlines,AA100,JFK,New York,USA,North America,40.6413,-73.7781,LHR,London,United Kingdom,'
        'Europe,51.47,-0.4543,5541.0,220,B77W,0,0,2026-04-21,2026,4,2')


def _write(dirpath, name, lines):
    os.makedirs(dirpath, exist_ok=True)
    with open(os.path.join(dirpath, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def test_csv_parse_rules_and_rejects(spark, fresh):
    lines = [
        HEADER,
        GOOD,
        GOOD.replace("American Airlines", '"A, Inc"'),
        GOOD.replace("American Airlines", '"q""t"'),
        GOOD.replace("AA,American", " aa ,American"),
        GOOD.replace("New York", "NULL").replace("London", "null").replace("Europe", ""),
        GOOD.replace(",2026,4,2", ""),  # short row: trailing fields NULL, kept
        GOOD + ",extra,fields",  # long row: extras ignored, kept
        GOOD.replace(",220,", ",many,"),  # rejected (seats)
        GOOD.replace("2026-04-21", "2026-13-21"),  # rejected (flight_date)
        GOOD.replace(",220,", ",1.5,"),  # loads as 2
        GOOD.replace("AA100", ""),  # NULL flight number, kept
        GOOD.replace("JFK", ""),  # NULL airport: kept in raw
    ]
    landing = _local(fresh.landing)
    _write(landing, "routes_a.csv", lines)
    classified = classify_landing(read_landing(spark, fresh.landing))
    good = loaded_rows(classified).collect()
    bad = rejected_rows(classified).collect()
    assert len(good) == 10 and len(bad) == 2
    assert sorted(r["reject_reason"] for r in bad) == ["flight_date", "seats"]
    assert all(r["source_file"] == "routes_a.csv" for r in good + bad)
    names = [r["airline_name"] for r in good]
    assert "A, Inc" in names and 'q"t' in names
    assert good[3]["airline_code"] == " aa "  # padding survives into raw
    assert (good[4]["origin_city"], good[4]["destination_city"], good[4]["destination_region"]) == (None, None, None)
    assert (good[5]["flight_year"], good[5]["flight_quarter"]) == (None, None)
    assert good[6]["flight_quarter"] == 2
    assert good[7]["seats"] == 2
    assert good[8]["flight_number"] is None
    assert good[9]["origin_airport"] is None
    assert good[0]["flight_date"] == dt.date(2026, 4, 21) and good[0]["seats"] == 220


def test_load_landing_writes_raw_and_rejects(spark, fresh):
    _write(_local(fresh.landing), "a.csv", [HEADER, GOOD, GOOD.replace(",220,", ",x,")])
    load_landing(spark, fresh.landing, fresh.raw, "copy-1")
    raw = read_raw(spark, fresh.raw)
    assert raw.count() == 1
    assert raw.where("load_timestamp is not null").count() == 1
    assert read_rejects(spark, fresh.raw).count() == 1
    # a retried load adds nothing
    load_landing(spark, fresh.landing, fresh.raw, "copy-1")
    assert read_raw(spark, fresh.raw).count() == 1


def test_number_beyond_64_bits_is_rejected_under_its_own_reason(spark, fresh):
    from routeflow.sources.landing import classify_landing, read_landing, rejected_rows

    wide = GOOD.replace(",220,", ",99999999999999999999,")
    _write(_local(fresh.landing), "wide.csv", [HEADER, GOOD, wide, GOOD.replace(",220,", ",many,")])
    reasons = rejected_rows(classify_landing(read_landing(spark, fresh.landing))).select("reject_reason").collect()
    assert sorted(r[0] for r in reasons) == ["seats", "seats:out_of_range"]


def test_full_width_numbers(spark, fresh):
    digits = "12345678901234567890123456789012345678"  # 38 of them
    lines = [HEADER, GOOD, GOOD.replace(",220,", f",{digits},"), GOOD.replace(",220,", f",{digits}9,"), GOOD.replace(",220,", ",-2.5,"), GOOD.replace(",220,", ",many,")]
    _write(_local(fresh.landing), "wide.csv", lines)
    schema = full_width(RAW_SCHEMA)
    assert load_landing(spark, fresh.landing, fresh.raw, "one", schema=schema) == 1
    rows = read_raw(spark, fresh.raw, schema)
    assert sorted(str(r["seats"]) for r in rows.collect()) == sorted(["220", digits, "-3"])
    assert rows.schema["stops"].dataType.simpleString() == "decimal(38,0)"
    assert sorted(r["reject_reason"] for r in read_rejects(spark, fresh.raw).collect()) == ["seats", "seats"]
    assert digits in {str(r["seats"]) for r in curate(rows).collect()}  # curated rows keep the width


def test_landing_files_are_compressed_and_load_whole(spark, fresh):
    from routeflow.sources.landing import CSV_WRITE_OPTIONS

    text = spark.range(7).selectExpr(*(f"concat('{c}', id) AS {c}" if c.endswith("name") else f"CAST(NULL AS STRING) AS {c}" for c in SOURCE_COLUMNS)).coalesce(1)
    text.write.options(**{**CSV_WRITE_OPTIONS, "maxRecordsPerFile": "3"}).csv(fresh.landing)
    names = [f for f in os.listdir(_local(fresh.landing)) if f.startswith("part-")]
    assert len(names) == 3 and all(f.endswith(".csv.gz") for f in names)
    assert load_landing(spark, fresh.landing, fresh.raw, "gz") == 3
    assert sorted(r["airline_name"] for r in read_raw(spark, fresh.raw).collect()) == [f"airline_name{k}" for k in range(7)]
