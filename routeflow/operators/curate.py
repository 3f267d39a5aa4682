"""Raw -> curated: filter incomplete rows, standardise codes and text, derive route columns.

The same function serves the batch path and the streaming path (it only uses stateless
projections and filters), so the incremental curated table equals the batch transform.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routeflow.functions import columns as C
from routeflow.schemas import (
    CODE_COLUMNS,
    DISTANCE_CATEGORY,
    IS_INTERNATIONAL,
    REQUIRED_COLUMNS,
    ROUTE_KEY,
    SOURCE_COLUMNS,
    SOURCE_FILE,
    TEXT_COLUMNS,
)


def require(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Keep rows where every required column is present (tested before any trimming)."""
    return df.where(C.all_not_null(required)) if required else df


def keep_inserts(df: DataFrame, action_col: str | None, insert_value: str = "INSERT") -> DataFrame:
    """Change-feed filter: keep insert actions (no-op for append-only sources without an action)."""
    if action_col and action_col in df.columns:
        return df.where(F.col(action_col) == F.lit(insert_value))
    return df


def standardise(
    df: DataFrame,
    codes: Sequence[str] = CODE_COLUMNS,
    texts: Sequence[str] = TEXT_COLUMNS,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Project ``columns`` (default: all) with codes upper-trimmed and texts trimmed."""
    columns = list(columns or df.columns)
    code_set, text_set = set(codes), set(texts)
    out = []
    for c in columns:
        if c in code_set:
            out.append(C.code(c).alias(c))
        elif c in text_set:
            out.append(C.text(c).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def curate(
    raw: DataFrame,
    *,
    columns: Sequence[str] = SOURCE_COLUMNS,
    codes: Sequence[str] = CODE_COLUMNS,
    texts: Sequence[str] = TEXT_COLUMNS,
    required: Sequence[str] = REQUIRED_COLUMNS,
    origin: str = "origin_airport",
    destination: str = "destination_airport",
    origin_country: str = "origin_country",
    destination_country: str = "destination_country",
    distance: str = "distance_km",
    carry: Sequence[str] = (SOURCE_FILE,),
    action_col: str | None = None,
) -> DataFrame:
    """Curated rows: ``columns`` standardised, then route key, international flag and distance
    category, then the ``carry`` columns. Works on batch and streaming DataFrames alike.

    * route key = cleaned origin || '-' || cleaned destination (NULL if either is NULL)
    * international = trimmed countries differ; a NULL country gives FALSE
    * distance category: < 1500 SHORT, < 4000 MEDIUM, else LONG (NULL distance -> LONG)
    """
    df = require(keep_inserts(raw, action_col), required)
    code_set, text_set = set(codes), set(texts)

    def clean(c: str):
        if c in code_set:
            return C.code(c)
        if c in text_set:
            return C.text(c)
        return F.col(c)

    derived = [
        C.route_key(clean(origin), clean(destination)).alias(ROUTE_KEY),
        C.differs(origin_country, destination_country).alias(IS_INTERNATIONAL),
        C.bucket(distance).alias(DISTANCE_CATEGORY),
    ]
    return df.select(
        *[clean(c).alias(c) for c in columns],
        *derived,
        *[F.col(c) for c in carry if c in raw.columns],
    )
