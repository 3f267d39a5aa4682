"""Content-addressed WARC archive.

``write_archive`` makes one WARC record per page and stores it in two tables of the shared folder:

* ``payloads``: payload bytes, once per distinct payload, keyed by their SHA-256;
* ``records``: the exact header bytes of every record (WARC header and HTTP head) with the payload's key.

``read_archive`` joins the two, verifies every payload against its key and gives back the original records.
``export_files`` / ``read_files`` write the records as ``.warc`` files and parse such files.

Of records with equal payloads (of at least ``min_bytes``) the one with the smallest page id is a ``response``,
the others are ``revisit`` records that refer to it.

Distribution: only payloads that occur more than once are grouped (a hot payload collapses map-side); all
others are written where they are read. The joins read written tables, so AQE can split a hot key.

Defined results: NULL html is the empty payload; a NULL url is an empty target URI and line ends in an url
become spaces; a NULL page id is never the referred one unless all ids of the group are NULL; rows
that repeat the smallest id of their group are all responses (the payload is stored once); an empty table
gives an empty archive; other columns are ignored whatever their names.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from routeflow.llm.common import staged
from routeflow.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not import this package

#: The pages have no fetch time; every record carries this date.
DATE = "2000-01-01T00:00:00Z"
RECORD_ID = "urn:page:"
EOL = "\r\n"
END = EOL + EOL


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 SHA-1. Five hex digits are four base32 digits; ``conv`` gives 0-9A-V."""
    digest = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _head(date: str) -> Column:
    """The header bytes of a record from page_id, url, payload_bytes, payload_digest and first_id (set on revisits)."""
    revisit = F.col("first_id").isNotNull()
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(END),
    )
    block = F.length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))
    lines = F.concat_ws(
        EOL,
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit(f"WARC-Record-ID: <{RECORD_ID}"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">")),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", " ")),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        # concat_ws leaves out what is NULL: these two lines are in revisits only
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.when(revisit, F.concat(F.lit(f"WARC-Refers-To: <{RECORD_ID}"), F.col("first_id").cast("string"), F.lit(">"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), block.cast("string")),
    )
    return F.encode(F.concat(lines, F.lit(END), http), "UTF-8")


def write_archive(pages: DataFrame, root: str, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0, date: str = DATE) -> None:
    """Write the records of ``pages`` to ``root``/payloads and ``root``/records."""
    raw = pages.select(
        F.col(page_id).alias("page_id"),
        F.col(url).alias("url"),
        F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8").alias("payload"),
    )
    keyed = raw.withColumn("digest", F.sha2("payload", 256))
    keys = staged(
        keyed.select("page_id", "url", "digest", F.octet_length("payload").cast("long").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("payload_digest")),
        "warc-keys",
    )
    shared = staged(
        keys.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"), F.max("payload_bytes").alias("bytes")).where("n > 1"),
        "warc-shared",
    )
    once = keyed.select("digest", "payload").join(shared.select("digest"), "digest", "left_anti")
    # Equal digests must mean equal bytes; two different payloads under one digest stop the job.
    many = (
        keyed.select("digest", "payload")
        .join(shared.select("digest"), "digest", "left_semi")
        .groupBy("digest")
        .agg(F.min("payload").alias("payload"), F.max("payload").alias("other"))
        .select("digest", F.when(F.col("payload") == F.col("other"), F.col("payload")).otherwise(F.raise_error(F.lit("payloads differ under one digest"))).alias("payload"))
    )
    once.unionByName(many).write.parquet(f"{root}/payloads")
    firsts = shared.where(F.col("bytes") >= F.lit(min_bytes)).select("digest", F.col("first_id").alias("first"))
    revisits = F.when(F.col("page_id").eqNullSafe(F.col("first")), None).otherwise(F.col("first"))
    records = keys.join(firsts, "digest", "left").withColumn("first_id", revisits)
    records.select("page_id", "digest", _head(date).alias("head")).write.parquet(f"{root}/records")


def read_archive(spark: SparkSession, root: str) -> DataFrame:
    """The original records: page_id, head, payload (verified against its key), record (its bytes in a WARC file)."""
    payloads = spark.read.parquet(f"{root}/payloads")
    checked = payloads.select(
        "digest",
        F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("damaged payload "), F.col("digest")))).alias("payload"),
    )
    records = spark.read.parquet(f"{root}/records").join(checked, "digest")
    own = F.when(header_field(F.col("head"), "WARC-Type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return records.select("page_id", "head", "payload", F.concat("head", own, F.lit(END.encode())).alias("record"))


def header_field(head: Column, name: str) -> Column:
    """The value of a header line, NULL if there is none."""
    found = F.regexp_extract(F.decode(head, "UTF-8"), rf"(?:^|\r\n){name}: ([^\r\n]*)", 1)
    return F.nullif(found, F.lit(""))


def parsed(records: DataFrame) -> DataFrame:
    """page_id, payload and the parts of each ``record`` by its own framing: warc and http (header bytes), body.

    The WARC header ends at the first empty line; its Content-Length gives the block, which must be followed by the two line ends that
    close a record and nothing else. The HTTP head ends at the block's first empty line. A record that breaks this stops the job.
    """
    text = F.decode("record", "ISO-8859-1")  # one character a byte
    ends = records.withColumn("warc_end", F.locate(END, text)).withColumn("http_end", F.expr(f"locate('{END}', decode(record, 'ISO-8859-1'), locate('{END}', decode(record, 'ISO-8859-1')) + 4)"))
    warc = F.expr("substring(record, 1, warc_end - 1)")
    split = ends.withColumn("warc", warc).withColumn("block_bytes", header_field(F.col("warc"), "Content-Length").cast("long"))
    whole = F.col("warc_end") + 3 + F.col("block_bytes") + len(END) == F.octet_length("record")
    framed = (F.col("warc_end") > 0) & (F.col("http_end") > F.col("warc_end")) & whole & (F.expr("right(decode(record, 'ISO-8859-1'), 4)") == END)
    body = F.expr("substring(record, http_end + 4, int(warc_end + 3 + block_bytes - (http_end + 3)))")
    return split.select(
        "page_id",
        "payload",
        "warc",
        F.expr("substring(record, warc_end + 4, http_end - warc_end - 4)").alias("http"),
        F.when(F.coalesce(framed, F.lit(False)), body).otherwise(F.raise_error(F.lit("broken record"))).alias("body"),
    )


def page_table(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, all from the bytes of the records read back.

    A response's payload is the body cut from its record; a revisit's is the stored one that its record stands for. Either must have
    the length and the digest that the record's own headers state.
    """
    kind = header_field(F.col("warc"), "WARC-Type")
    cut = parsed(records).select("page_id", "warc", "http", kind.alias("record_type"), F.when(kind == "response", F.col("body")).otherwise(F.col("payload")).alias("payload"))
    digest, size = base32_sha1(F.col("payload")), F.octet_length("payload").cast("long")
    stated = (header_field(F.col("warc"), "WARC-Payload-Digest") == F.concat(F.lit("sha1:"), digest)) & (header_field(F.col("http"), "Content-Length").cast("long") == size)
    refers = F.regexp_extract(header_field(F.col("warc"), "WARC-Refers-To"), rf"^<{RECORD_ID}(-?[0-9]+)>$", 1)
    return cut.select(
        "page_id",
        size.alias("payload_bytes"),
        F.when(F.coalesce(stated, F.lit(False)), digest).otherwise(F.raise_error(F.lit("record and payload differ"))).alias("payload_digest"),
        "record_type",
        refers.cast("long").alias("refers_to"),
    )


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as an archive in the shared folder and read its records back as ``page_table``."""
    spark = pages.sparkSession
    root = scratch_path(spark, "llm-warc")
    write_archive(pages, root)
    return page_table(read_archive(spark, root))


def export_files(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write ``record`` bytes as WARC files; the two line ends that close a record are the line separator."""
    body = F.expr("cast(substring(record, 1, octet_length(record) - 4) as string)")
    records.select(body.alias("value")).write.option("lineSep", END).option("compression", compression).text(path)


_FILE_SCHEMA = "record_type string, record_id string, target_uri string, payload_digest string, refers_to string, head binary, payload binary"


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Records of the WARC files under ``path`` (plain or gzip). A file is read whole: keep files to some 100 MB."""

    def fields(head: bytes) -> dict[str, str]:
        lines = head.decode("utf-8", "replace").split(EOL)[1:]
        return {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import gzip

        for batch in batches:
            for data in batch.column("content"):
                data, at, rows = data.as_py(), 0, []
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                while at < len(data):
                    end = data.index(b"\r\n\r\n", at) + 4
                    warc = fields(data[at : end - 4])
                    stop = end + int(warc["content-length"])
                    cut = data.index(b"\r\n\r\n", end, stop) + 4 if "application/http" in warc.get("content-type", "") else end
                    digest = warc.get("warc-payload-digest", "").removeprefix("sha1:")
                    rows.append((warc.get("warc-type"), warc.get("warc-record-id"), warc.get("warc-target-uri"), digest, warc.get("warc-refers-to"), data[at:cut], data[cut:stop]))
                    at = stop + 4
                columns = list(zip(*rows)) or [()] * 7
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.string()] * 5 + [pa.binary()] * 2)], names=["record_type", "record_id", "target_uri", "payload_digest", "refers_to", "head", "payload"])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(parse, _FILE_SCHEMA)
