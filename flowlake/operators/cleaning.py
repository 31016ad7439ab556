"""Raw labelled tables to clean features and a binary label. Column expressions only, one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake import schema as S
from flowlake.functions import expressions as X
from flowlake.functions.ranks import global_row_number
from flowlake.runtime import checked_lookup


def clean_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def find_label(names: list[str], candidates: list[str] | None = None) -> str | None:
    """The first label spelling that is present, case-sensitively."""
    return next((c for c in candidates or S.LABEL_CANDIDATES if c in names), None)


def resolve_label_column(df: DataFrame) -> DataFrame:
    """Rename the label column to ``Label``."""
    found = find_label(df.columns)
    if found is None:
        raise ValueError(f"no label column among {df.columns}")
    return df.withColumnRenamed(found, "Label")


def project_canonical(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """(the model features that are present plus ``Label``, the features that are missing)."""
    missing = [c for c in S.CANONICAL_FEATURES if c not in df.columns]
    kept = [F.col(f"`{c}`") for c in S.CANONICAL_FEATURES if c not in missing]
    return df.select(*kept, "Label"), missing


def coerce_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """Text to double, null where it is not a number."""
    return df.withColumns({c: X.to_number(F.col(f"`{c}`")) for c in cols})


def nullify_nonfinite(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: X.finite(F.col(f"`{c}`")) for c in cols})


def drop_incomplete(df: DataFrame, cols: list[str]) -> DataFrame:
    complete = F.lit(True)
    for c in cols:
        complete = complete & F.col(f"`{c}`").isNotNull()
    return df.where(complete)


def number(col: Column) -> Column:
    """Text to a finite double, else null."""
    return X.finite(X.to_number(col))


def clean_numbers(df: DataFrame, cols: list[str]) -> DataFrame:
    """The three steps above in order: also a textual infinity is dropped."""
    return drop_incomplete(nullify_nonfinite(coerce_numeric(df, cols), cols), cols)


def with_binary_label(df: DataFrame, source: str = "Label", output: str = "label", numeric: bool | None = None) -> DataFrame:
    """0 / 1 label. ``numeric=None``: taken from the column type."""
    if numeric is None:
        numeric = dict(df.dtypes)[source] != "string"
    return df.withColumn(output, X.binary_label(F.col(source), numeric))


def drop_identifiers(df: DataFrame, label: str | None = None) -> DataFrame:
    """Drop what would give the answer away: record ids, addresses, the attack category."""
    return df.drop(*S.IDENTIFIER_COLUMNS, *([label] if label else []))


def category_codes(df: DataFrame, cols: list[str]) -> DataFrame:
    """(``column``, ``value``, ``code``): codes count up in sorted order from 0 per column.

    All columns in one pass: distinct pairs are a map-side aggregate, the numbering is a range sort.
    """
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), _category(F.col(f"`{c}`")).alias("value")) for c in cols]
    )
    distinct = df.select(F.inline(pairs)).distinct()
    numbered = global_row_number(distinct, [F.col("column"), F.col("value")])
    firsts = numbered.groupBy("column").agg(F.min("rn").alias("first_rn"))
    # One row per encoded column.
    return numbered.join(F.broadcast(firsts), "column").select(
        "column", "value", (F.col("rn") - F.col("first_rn")).cast("int").alias("code")
    )


def _category(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit("nan"))


def encode_categoricals(df: DataFrame, cols: list[str]) -> DataFrame:
    """Replace texts by their sorted-order code; null is a category of its own.

    The code table of a column is joined according to its size, see ``checked_lookup``.
    """
    if not cols:
        return df
    codes = category_codes(df, cols)
    order = df.columns
    for c in cols:
        lookup = checked_lookup(
            codes.where(F.col("column") == c).select(F.col("value").alias("__value"), F.col("code").alias("__code")),
            "codes",
        )
        df = df.withColumn("__key", _category(F.col(f"`{c}`")))
        df = df.join(lookup, F.col("__key") == F.col("__value"), "left").drop("__key", "__value")
        df = df.withColumn(c, F.col("__code")).drop("__code")
    return df.select(*[f"`{c}`" for c in order])
