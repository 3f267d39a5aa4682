"""Fill-in-the-middle: texts cut into prefix, middle and suffix at token boundaries and put together in another order.

Method: a ``pyarrow.compute`` pipeline over each Arrow batch. Units are split into list arrays and flattened with their parent's
index; the ordinal of a unit is its distance from its parent's first unit; units are filtered by role (prefix, middle, suffix), the
lists of each role are rebuilt from the known lengths, and ``binary_join`` makes one piece of each list. No Python code runs per
row or per unit. The random numbers are digests of the id, computed by Spark, so a rerun gives the same cuts.

Distribution: one narrow pass (scan, map, projection), no shuffle. A batch is worked on in slices of about ``SLICE_BYTES`` of text, so
memory is bounded by that or by the longest single text.

Results: a NULL text counts as empty; an empty text, a text that holds one of the three markers, and texts the draw leaves out
keep their form (``plain``, NULL lengths). A NULL id draws as the empty id. Repeated rows give repeated results, an empty table none.
Other columns of the input are not read; result columns are lengthened by ``_`` where the id column has their name.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from routeflow.llm.common import fresh_name, let

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not import this package

MARKERS = ("<P>", "<S>", "<M>")
PLAIN, PSM, SPM = "plain", "psm", "spm"

#: Bytes of text that are cut at once.
SLICE_BYTES = 8 << 20

#: A unit over UTF-8 bytes: a run of ASCII letters, or any other character with its continuation bytes.
_UNIT = r"([A-Za-z]+|[^A-Za-z\x80-\xBF][\x80-\xBF]*)"
_END = b"\xff"  # no byte of UTF-8 text


def draws(id_col: str, seed: str, count: int = 4) -> list[Column]:
    """``count`` 32-bit numbers: the leading 8-digit groups of the hex SHA-256 of ``seed:id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(count)]


def _mod(x: pa.Array, m: pa.Array | int) -> pa.Array:
    return pc.subtract(x, pc.multiply(pc.divide(x, m), m))


def _offsets(counts: pa.Array) -> pa.Array:
    return pa.concat_arrays([pa.array([0], pa.int32()), pc.cumulative_sum(counts).cast(pa.int32())])


def cut(text: pa.Array, h1: pa.Array, h2: pa.Array) -> tuple[pa.Array, list[pa.Array]]:
    """Number of units of each text, and its prefix, middle and suffix as large_binary arrays."""
    ended = pc.replace_substring_regex(text.cast(pa.large_binary()), pattern=_UNIT, replacement=b"\\1" + _END)
    units = pc.split_pattern(ended, pattern=_END)  # one empty piece more than there are units
    pieces = pc.list_value_length(units).cast(pa.int64())
    n = pc.subtract(pieces, 1)
    ends = pc.add(n, 1)
    cuts = (_mod(h1, ends), _mod(h2, ends))
    first, second = pc.min_element_wise(*cuts), pc.max_element_wise(*cuts)

    parent = pc.list_parent_indices(units)
    flat = pc.list_flatten(units)
    starts = pc.subtract(pc.cumulative_sum(pieces), pieces)
    ordinal = pc.subtract(_range(len(flat)), starts.take(parent))
    before_middle = pc.less(ordinal, first.take(parent))
    before_suffix = pc.less(ordinal, second.take(parent))
    real = pc.less(ordinal, n.take(parent))
    roles = [
        (before_middle, first),
        (pc.and_not(before_suffix, before_middle), pc.subtract(second, first)),
        (pc.and_not(real, before_suffix), pc.subtract(n, second)),
    ]
    lists = [pa.ListArray.from_arrays(_offsets(count), flat.filter(role)) for role, count in roles]
    return n, [pc.binary_join(x, pa.scalar(b"", pa.large_binary())) for x in lists]


def _range(n: int) -> pa.Array:
    return pc.subtract(pc.cumulative_sum(pa.repeat(pa.scalar(1, pa.int64()), n)), 1)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).cast(pa.int64())
    part = pc.divide(pc.subtract(pc.cumulative_sum(sizes), sizes), SLICE_BYTES)
    start = 0
    for count in pc.run_end_encode(part).run_ends.to_pylist() if batch.num_rows else []:
        yield batch.slice(start, count - start)
        start = count


def _transform(keep_percent: int, spm_percent: int, markers: tuple[str, str, str], names: list[str]):
    p, s, m = (pa.scalar(x.encode(), pa.large_binary()) for x in markers)
    nothing = pa.scalar(b"", pa.large_binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                key, text, h1, h2, h3, h4 = part.columns
                text = pc.fill_null(text, "")
                n, (prefix, middle, suffix) = cut(text, h1, h2)
                plain = pc.or_(pc.equal(pc.binary_length(text), 0), pc.greater_equal(_mod(h3, 100), keep_percent))
                for marker in markers:
                    plain = pc.or_(plain, pc.match_substring(text, marker))
                spm = pc.less(_mod(h4, 100), spm_percent)
                psm_text = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, nothing)
                spm_text = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, nothing)
                output = pc.if_else(plain, text.cast(pa.large_binary()), pc.if_else(spm, spm_text, psm_text))
                length = [
                    pc.if_else(plain, pa.scalar(None, pa.int64()), pc.utf8_length(x.cast(pa.large_string())).cast(pa.int64()))
                    for x in (prefix, middle)
                ]
                form = pc.if_else(plain, PLAIN, pc.if_else(spm, SPM, PSM))
                yield pa.RecordBatch.from_arrays([key, n, form, *length, output.cast(pa.string())], names)

    return run


def rewrite(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: str = "1",
    keep_percent: int = 90,
    spm_percent: int = 20,
    markers: tuple[str, str, str] = MARKERS,
) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output): every text with its units, form and rewritten text.

    ``keep_percent`` of the texts are rewritten, ``spm_percent`` of these in the order suffix, prefix, middle.
    """
    names = [id_col, *(fresh_name(x, [id_col]) for x in ("n", "form", "prefix_chars", "middle_chars", "output"))]
    kinds = [docs.schema[id_col].dataType, T.LongType(), T.StringType(), T.LongType(), T.LongType(), T.StringType()]
    schema = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds, strict=True)])
    drawn = [x.alias(f"h{k}") for k, x in enumerate(draws(id_col, seed))]
    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text"), *drawn)
    return rows.mapInArrow(_transform(keep_percent, spm_percent, tuple(markers), names), schema)


def restored(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The original text, rebuilt from the rewritten one: the texts between the markers, in their first order.

    A rewritten text holds each marker once, because texts that contain one stay plain and no marker overlaps another.
    """
    either = "|".join(rf"\Q{m}\E" for m in markers)
    body = F.split(output, either, 4)  # nothing before the first marker, then three texts
    return F.when(form == F.lit(PLAIN), output).otherwise(
        let(body, lambda x: F.when(form == F.lit(PSM), F.concat(x[1], x[3], x[2])).otherwise(F.concat(x[2], x[3], x[1])))
    )
