"""Row-wise operators on streaming tables: harmonization and score filters need no state, so they run unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantspark.operators.filters import FilterSettings, censor, score_filter
from quantspark.operators.reshape import rename
from quantspark.schema import canonical_types


def harmonize_stream(df: DataFrame, config: dict[str, str | None], settings: FilterSettings) -> DataFrame:
    """Rename, cast, filter by scores and censor, in append mode."""
    df = canonical_types(rename(df, config))
    if settings.qvalue is not None:
        df = score_filter(df, "QVALUE", settings.qvalue)
    if settings.pep is not None:
        df = score_filter(df, "PEP", settings.pep, settings.pep_direction)
    return censor(df, settings.min_linear_intensity)


def running_roll_up(df: DataFrame, out: str = "raw") -> DataFrame:
    """Sums of cells as rows arrive; use with complete or update mode. The state is one row a cell."""
    return df.groupBy("INDEX", F.col("FILENAME").alias("Sample")).agg(F.sum("SIGNAL").alias(out))
