"""Numeric features: choosing, assembling and standardising them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import NumericType

from dayledger.schema import BATCH, LABEL

RAW_VECTOR = "features_raw"
VECTOR = "features"


def feature_columns(rows: DataFrame, label: str = LABEL, exclude: Sequence[str] = ()) -> list[str]:
    """Every numeric column but the label and the excluded ones, in schema order.

    Ids are features unless excluded, and so is `tx_fraud_scenario`, which gives the
    label away. The batch number of a streamed history is none.
    """
    skipped = {label, BATCH, *exclude}
    return [
        f.name
        for f in rows.schema.fields
        if isinstance(f.dataType, NumericType) and f.name not in skipped
    ]


def assembler(columns: list[str], handle_invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=columns, outputCol=RAW_VECTOR, handleInvalid=handle_invalid)


def scaler() -> StandardScaler:
    return StandardScaler(inputCol=RAW_VECTOR, outputCol=VECTOR, withMean=True, withStd=True)


def standardize(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Add the vector of z-scores; a feature that never varies becomes zero."""
    assembled = assembler(columns).transform(rows)
    return scaler().fit(assembled).transform(assembled)


def vector_long(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """One row (key, idx, value) per vector entry."""
    return rows.select(key, F.posexplode(vector_to_array(vector)).alias("idx", "value"))


def scaler_stats(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Mean and sample standard deviation of each feature, from one pass."""
    wide = rows.agg(
        F.array(
            *(
                F.struct(
                    F.lit(i).alias("idx"),
                    F.lit(c).alias("feature"),
                    F.count(c).alias("n"),
                    F.avg(F.col(c).cast("double")).alias("mean"),
                    F.stddev_samp(F.col(c).cast("double")).alias("std"),
                )
                for i, c in enumerate(columns)
            )
        ).alias("stats")
    )
    return wide.select(F.inline("stats"))
