"""Column set-up and validity of rows and columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow import constants as K
from corpusflow.functions.columns import normalize_id, to_number, valid_url


def quoted(name: str) -> str:
    """Column reference that is safe for dotted names."""
    return f"`{name}`" if "." in name else name


def require_columns(df: DataFrame, names: Iterable[str], what: str = "table") -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"{what} lacks the columns {missing}")
    return df


def scan_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Only the named columns; Catalyst carries the pruning into the file scan."""
    return require_columns(df, cols).select(*[F.col(quoted(c)) for c in cols])


def normalize_missing_tokens(
    df: DataFrame, cols: Sequence[str] | None = None, tokens: Sequence[str] = K.MISSING_TOKENS
) -> DataFrame:
    """Turn texts that mean "no value" into NULL (all string columns by default)."""
    names = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns(
        {c: F.when(~F.col(quoted(c)).isin(*tokens), F.col(quoted(c))) for c in names}
    )


def select_and_rename(
    df: DataFrame, mapping: Mapping[str, str] = K.RENAMES, keep: Sequence[str] | None = None
) -> DataFrame:
    """Rename the columns that exist, then keep ``keep`` (those present, in that order)."""
    renamed = df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})
    if keep is None:
        return renamed
    return renamed.select(*[F.col(quoted(c)) for c in keep if c in renamed.columns])


def reorder_columns(
    df: DataFrame,
    priority: Sequence[str] = K.PRIORITY_COLS,
    features: Sequence[str] = K.FEATURE_COLS,
) -> DataFrame:
    """Priority columns, then features, then the remainder in its present order."""
    lead = [c for c in [*priority, *features] if c in df.columns]
    rest = [c for c in df.columns if c not in lead]
    return df.select(*[F.col(quoted(c)) for c in dict.fromkeys([*lead, *rest])])


def coerce_numeric(
    df: DataFrame, floats: Sequence[str] = (), ints: Sequence[str] = ()
) -> DataFrame:
    """Cast the listed columns that exist; what is no number becomes NULL."""
    casts = {c: "float" for c in floats} | {c: "int" for c in ints}
    return df.withColumns({c: to_number(quoted(c), t) for c, t in casts.items() if c in df.columns})


def first_present(df: DataFrame, names: Sequence[str], default: object = None) -> Column:
    """The first of ``names`` the table has, else the constant ``default``."""
    found = next((c for c in names if c in df.columns), None)
    return F.lit(default) if found is None else F.col(quoted(found))


def is_missing(df: DataFrame, name: str) -> Column:
    col = F.col(quoted(name))
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def drop_invalid(df: DataFrame, required: Sequence[str], id_col: str = K.ID_COL) -> DataFrame:
    """Drop rows that lack a required value or have a blank or ``nan`` identifier."""
    return df.na.drop(subset=[quoted(c) for c in required]).filter(normalize_id(id_col).isNotNull())


def mark_complete(df: DataFrame, name: str = "complete") -> DataFrame:
    """Flag rows without a single missing value."""
    gap = F.lit(False)
    for c in df.columns:
        gap = gap | is_missing(df, c)
    return df.withColumn(name, ~gap)


def split_complete(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Complete rows and the others, as two filters on one plan."""
    marked = mark_complete(df, "_complete")
    return (
        marked.filter("_complete").drop("_complete"),
        marked.filter(~F.col("_complete")).drop("_complete"),
    )


def eligible_tasks(
    df: DataFrame, id_col: str = K.ID_COL, title_col: str = K.TITLE_COL, url_col: str = K.URL_COL
) -> DataFrame:
    """Rows worth fetching: valid identifier and a usable URL."""
    title = first_present(df, [title_col], K.UNKNOWN).cast("string")
    tasks = df.select(
        normalize_id(id_col).alias("track_id"),
        F.coalesce(title, F.lit("nan")).alias("track_name"),
        F.coalesce(valid_url(url_col), F.lit("")).alias("url"),
    )
    return tasks.filter(F.col("track_id").isNotNull() & (F.col("url") != ""))


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column with its number of missing values, from one scan."""
    counts = df.agg(*[F.count_if(is_missing(df, c)).alias(f"n{i}") for i, c in enumerate(df.columns)])
    pairs = [
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("nulls"))
        for i, c in enumerate(df.columns)
    ]
    return counts.select(F.explode(F.array(*pairs)).alias("p")).select("p.column", "p.nulls")


def empty_columns(df: DataFrame) -> list[str]:
    """Names of the columns without any value. Runs one aggregation to a single row."""
    row = df.agg(
        *[F.count_if(~is_missing(df, c)).alias(f"n{i}") for i, c in enumerate(df.columns)]
    ).first()
    return sorted(c for i, c in enumerate(df.columns) if row[f"n{i}"] == 0)


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop all-missing columns; the resulting schema depends on the data."""
    gone = set(empty_columns(df))
    return df.select(*[F.col(quoted(c)) for c in df.columns if c not in gone])
