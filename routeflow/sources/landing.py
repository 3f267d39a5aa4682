"""Landing files (CSV) -> typed raw rows + rejects.

The file is read **as text first** (one string column per position, header skipped), so short rows
get NULL trailing fields and long rows lose their extras instead of being flagged corrupt. NULL
spellings are applied to the text, then every column is converted with ``try_cast``; a row whose
non-NULL text does not convert in some column is a reject (kept aside with its text and the
failing column names), every other row loads.

Large files stay splittable: each line is a record, except in files in which some line holds an odd number of quotes, that is, in
which a quoted field goes on over a line break. Only those are read whole (``read_files``).

The load history is part of the raw table: every load writes the files it took (path, size, time) into its slice, which one ledger
entry publishes together with the rows and the rejects. A load takes the files of its listing that are not in the history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from routeflow import fixed_values as FV
from routeflow.functions import columns as C
from routeflow.schemas import RAW_SCHEMA, SOURCE_FIELDS, SOURCE_FILE, landing_fields
from routeflow.sources import ledger
from routeflow.sources.tables import MAX_FILE_AGE, ROWS, conform, read_slices, stage_slice

REJECT_REASON = "reject_reason"
REJECTED_RECORD = "rejected_record"

#: Parts of a load's slice next to its rows.
REJECTS, FILES = "rejects", "files"
REJECTS_SCHEMA = T.StructType([T.StructField(n, T.StringType(), True) for n in (REJECTED_RECORD, REJECT_REASON, SOURCE_FILE)])
FILES_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType(), True),
        T.StructField("file_path", T.StringType(), True),
        T.StructField("length", T.LongType(), True),
        T.StructField("modified", T.TimestampType(), True),
    ]
)

CSV_READ_OPTIONS = {
    "header": "true",  # one header line per file, skipped (not matched against the schema)
    "enforceSchema": "true",
    "quote": FV.CSV_QUOTE,
    "escape": FV.CSV_QUOTE,  # a doubled quote inside a quoted field is one quote
    "mode": "PERMISSIVE",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "multiLine": "false",  # keeps large files splittable; read_files sets it for the files that need it
}

#: Landing files are written compressed. Such a file is read by one task, so its rows are bounded.
CSV_WRITE_OPTIONS = {
    "header": "true",
    "compression": "gzip",
    "maxRecordsPerFile": "500000",
    "quote": FV.CSV_QUOTE,
    "escape": FV.CSV_QUOTE,
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def text_schema(fields: Sequence[tuple[str, T.DataType]] = SOURCE_FIELDS) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n, _ in fields])


def read_landing(
    spark: SparkSession,
    path: str | Sequence[str],
    fields: Sequence[tuple[str, T.DataType]] = SOURCE_FIELDS,
    *,
    source_file: str | None = SOURCE_FILE,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Landing CSV as text columns in file order (+ the file name each row came from).

    ``path`` is a directory, a glob or a list of files.
    """
    opts = {**CSV_READ_OPTIONS, **(options or {})}
    df = spark.read.schema(text_schema(fields)).options(**opts).csv(path if isinstance(path, str) else list(path))
    cols = [F.col(n) for n, _ in fields]
    if source_file:
        cols.append(F.col("_metadata.file_name").alias(source_file))
    return df.select(*cols)


#: A whole number that is valid text but beyond 64 bits is rejected under this suffix, apart from text that is no number.
OUT_OF_RANGE = "out_of_range"


def _failure(name: str, kind: T.DataType, text: Column, value: Column) -> Column:
    reason = F.lit(name)
    if isinstance(kind, T.LongType):
        wide = text.try_cast(T.DecimalType(38, 0)).isNotNull()
        reason = F.when(wide, F.lit(f"{name}:{OUT_OF_RANGE}")).otherwise(reason)
    return F.when(text.isNotNull() & value.isNull(), reason)


def classify_landing(
    text_df: DataFrame,
    fields: Sequence[tuple[str, T.DataType]] = SOURCE_FIELDS,
    null_spellings: Sequence[str] = FV.NULL_SPELLINGS,
    passthrough: Sequence[str] = (SOURCE_FILE,),
) -> DataFrame:
    """Typed columns, passthrough columns, ``reject_reason`` and ``rejected_record`` in one pass."""
    cleaned = {n: C.null_if(n, null_spellings) for n, _ in fields}
    typed = {n: C.try_convert(cleaned[n], t) for n, t in fields}
    failures = [_failure(n, t, cleaned[n], typed[n]) for n, t in fields if not isinstance(t, T.StringType)]
    reason = F.concat_ws(",", *failures) if failures else F.lit("")
    reason = F.when(reason != F.lit(""), reason)
    keep = [c for c in passthrough if c in text_df.columns]
    record = F.to_json(F.struct(*[F.col(n) for n, _ in fields]))
    return text_df.select(
        *[typed[n].alias(n) for n, _ in fields],
        *keep,
        reason.alias(REJECT_REASON),
        F.when(reason.isNotNull(), record).alias(REJECTED_RECORD),
    )


def loaded_rows(classified: DataFrame) -> DataFrame:
    """Rows that converted cleanly (typed columns + passthrough)."""
    return classified.where(F.col(REJECT_REASON).isNull()).drop(REJECT_REASON, REJECTED_RECORD)


def rejected_rows(classified: DataFrame, passthrough: Sequence[str] = (SOURCE_FILE,)) -> DataFrame:
    """Rows skipped by the load: original text (JSON), failing columns, file."""
    keep = [c for c in passthrough if c in classified.columns]
    return classified.where(F.col(REJECT_REASON).isNotNull()).select(REJECTED_RECORD, REJECT_REASON, *keep)


def list_files(spark: SparkSession, path: str, streaming: bool = False, most: int | None = None) -> DataFrame:
    """The landing files under ``path`` (``FILES_SCHEMA``); their contents are not read.

    ``streaming=True`` gives a stream whose checkpoint remembers the files it delivered, late ones included.
    """
    reader = spark.readStream.option("maxFileAge", MAX_FILE_AGE) if streaming else spark.read
    if most:
        reader = reader.option("maxFilesPerTrigger", str(most))
    found = reader.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").load(path)
    return found.select("path", F.col("_metadata.file_path").alias("file_path"), "length", F.col("modificationTime").alias("modified"))


def files_with_quoted_breaks(spark: SparkSession, files: Sequence[Row]) -> set[str]:
    """``file_path`` of the files in which a quoted field goes on over a line end: some line holds an odd number of quotes."""
    lines = spark.read.text([f["path"] for f in files])
    quotes = F.length("value") - F.length(F.replace("value", F.lit(FV.CSV_QUOTE), F.lit("")))
    odd = lines.where(quotes % 2 == 1).select(F.col("_metadata.file_path").alias("file_path")).distinct()
    return {r["file_path"] for r in odd.collect()}  # some of the given files


def read_files(
    spark: SparkSession,
    files: Sequence[Row],
    fields: Sequence[tuple[str, T.DataType]] = SOURCE_FIELDS,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """``read_landing`` of listed files: those with quoted line breaks whole, the others split.

    A ``multiLine`` option settles it for all files and saves the pass that looks for such breaks.
    """
    options = dict(options or {})
    if "multiLine" in options:
        return read_landing(spark, [f["path"] for f in files], fields, options=options)
    whole = files_with_quoted_breaks(spark, files)
    groups = [
        ([f["path"] for f in files if f["file_path"] not in whole], {}),
        ([f["path"] for f in files if f["file_path"] in whole], {"multiLine": "true"}),
    ]
    read = [read_landing(spark, paths, fields, options={**options, **more}) for paths, more in groups if paths]
    return read[0] if len(read) == 1 else read[0].unionByName(read[1])


def _part(spark: SparkSession, raw_path: str, part: str, schema: T.StructType, found: list[ledger.Entry] | None = None) -> DataFrame:
    """A part of the slices that loads wrote (inserts have rows only)."""
    found = ledger.live(ledger.entries(spark, raw_path) if found is None else found)
    return read_slices(spark, raw_path, schema, [e.folder for e in found if e.folder.startswith(LOAD_PREFIX)], part, with_load_id=True)


def read_rejects(spark: SparkSession, raw_path: str) -> DataFrame:
    """The rows that loads into the raw table skipped: their text, the failing columns, their file and load id."""
    return _part(spark, raw_path, REJECTS, REJECTS_SCHEMA)


def load_history(spark: SparkSession, raw_path: str, found: list[ledger.Entry] | None = None) -> DataFrame:
    """The files that loads have taken into the raw table, with the id of the load."""
    return _part(spark, raw_path, FILES, FILES_SCHEMA, found)


#: Folders of load slices begin with this, so that those with rejects and files are known by name.
LOAD_PREFIX = "load="


def pending(spark: SparkSession, files: Sequence[Row], raw_path: str, found: list[ledger.Entry]) -> list[Row]:
    """The files that the history does not hold in the same size and with the same time."""
    if not files:
        return []
    asked = spark.createDataFrame(list(files), FILES_SCHEMA)
    same = ["path", "length", "modified"]
    known = load_history(spark, raw_path, found).join(F.broadcast(asked.select(*same)), same, "left_semi").select(*same).distinct()
    loaded = {tuple(r) for r in known.collect()}  # some of the given files
    return [f for f in files if (f["path"], f["length"], f["modified"]) not in loaded]


def load_files(
    spark: SparkSession,
    files: Sequence[Row],
    raw_path: str,
    load_id: str,
    csv_options: dict[str, str] | None = None,
    force: bool = False,
    schema: T.StructType = RAW_SCHEMA,
) -> int:
    """Load listed files into the raw table, each at most once; returns how many files this load took.

    ``schema`` is the table's; the files hold its columns in order, but for those that the load adds.

    Rows, rejects and the files taken become visible together. If another load commits meanwhile the history is looked at again; what
    that load has taken is left out. A load id that was committed before adds nothing. Rows and rejects are two narrow passes.
    """
    staged, folder = None, ""
    while True:
        found = ledger.entries(spark, raw_path)
        wanted = list(files) if force else pending(spark, files, raw_path, found)
        if not wanted or ledger.holds(found, load_id):
            return 0
        if wanted != staged:
            fields = landing_fields(schema)
            classified = classify_landing(read_files(spark, wanted, fields, csv_options), fields)
            taken = spark.createDataFrame(wanted, FILES_SCHEMA).coalesce(1)
            parts = {REJECTS: rejected_rows(classified), ROWS: conform(loaded_rows(classified), schema), FILES: taken}
            staged, folder = wanted, stage_slice(parts, raw_path, load_id, LOAD_PREFIX)
        try:
            entry = ledger.commit(spark, raw_path, load_id, folder, expected=found[-1].position if found else -1)
        except ledger.LedgerMoved:
            continue
        return len(wanted) if entry else 0


def load_landing(
    spark: SparkSession,
    landing_path: str,
    raw_path: str,
    load_id: str,
    csv_options: dict[str, str] | None = None,
    force: bool = False,
    schema: T.StructType = RAW_SCHEMA,
) -> int:
    """Bulk load (``COPY INTO raw``): the files under ``landing_path`` that were not loaded yet -> raw rows + rejects.

    A file that changed since (another size or time) counts as new; ``force`` takes all files again. ``load_timestamp`` takes the write
    time. Returns the number of files taken. ``schema`` is that of the table, which every load and ``read_raw`` must be given alike;
    with ``schemas.full_width(RAW_SCHEMA)`` whole numbers keep up to 38 digits.
    """
    return load_files(spark, list_files(spark, landing_path).collect(), raw_path, load_id, csv_options, force, schema)
