"""Silver: typed, keyed, de-duplicated rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.functions.casts import lenient_cast, strict_cast, strict_iso_date_text
from snapmart.functions.keys import entity_key
from snapmart.operators.dedupe import keep_last
from snapmart.operators.quality import strip_whitespace

DEFAULT_ORDER = ("ingested_at_utc", "source_file")
FILE_ORDER = ("ingested_at_utc", "source_path", "source_block", "source_row")


def standardize(
    bronze: DataFrame,
    name_col: str = "municipality",
    key_col: str = "municipality_key",
    order_by: Sequence[str] | None = None,
    dedupe_on: Sequence[str] | None = None,
    date_columns: Sequence[str] = ("source_last_updated", "snapshot_retrieved_at"),
) -> DataFrame:
    """Trim the name, derive the entity key, cast strictly, keep the last row per
    (dataset, name, year, metric) under ``order_by`` with a full tie-break.

    Default order: file position when the bronze came from
    :func:`~snapmart.sources.files.read_raw_csv` (the last line of a file
    wins), else ingestion time and source label.

    Strict casts (year, value, dates) raise on bad text; the growth rates are
    lenient (bad text becomes null).
    """
    typed = {
        name_col: strip_whitespace(name_col),
        "year": strict_cast("year", "int", "year"),
        "value": strict_cast("value", "double", "value"),
        "yoy_change_pct": lenient_cast("yoy_change_pct", "double"),
        "five_year_change_pct": lenient_cast("five_year_change_pct", "double"),
    }
    typed.update({c: strict_iso_date_text(c, c) for c in date_columns})
    # one projection (not a withColumn chain): a single analysis pass
    df = bronze.select(
        *[typed[c].alias(c) if c in typed else F.col(c) for c in bronze.columns],
        entity_key(strip_whitespace(name_col)).alias(key_col),
    )
    if dedupe_on is None:
        dedupe_on = (["dataset"] if "dataset" in bronze.columns else []) + [name_col, "year",
                                                                            "metric"]
    if order_by is None:
        order_by = FILE_ORDER if "source_row" in bronze.columns else DEFAULT_ORDER
    return keep_last(df, list(dedupe_on), list(order_by))


def lake_silver(bronze: DataFrame, keys: Sequence[str], order_by: Sequence[str] = DEFAULT_ORDER,
                date_columns: Sequence[str] = ("source_last_updated", "snapshot_retrieved_at")
                ) -> DataFrame:
    """The lake path's silver (C8): drop negative/null values *first*, then keep
    one row per key deterministically, then parse dates to DATE (P5, P11, W4).

    Filtering before de-duplication lets the filter reach the scan and stops a
    bad duplicate from hiding a good row.
    """
    kept = bronze.filter(F.col("value").cast("double") >= 0)
    deduped = keep_last(kept, list(keys), list(order_by))
    for c in date_columns:
        deduped = deduped.withColumn(c, F.to_date(F.col(c)))
    return deduped
