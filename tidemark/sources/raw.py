"""Raw loads (L1): every column as text, bad rows captured instead of
ending the job.

:func:`read_raw` reads a CSV without trusting it: all columns are text and a
line with too few or too many fields keeps its text in ``_broken``.
:func:`checked` lists what is wrong with every row, before any cast;
:func:`accepted` gives the good rows in the declared types, :func:`rejects`
one row per fault of the others.  All of it is narrow: one scan, no shuffle.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.model import Tables
from tidemark.schema import DECIMAL_COLUMNS, TABLES, VARCHAR, not_null_columns

BROKEN = "_broken"
FAULTS = "_faults"
ANY_NUMBER = "decimal(38,10)"


def raw_schema(table: str) -> T.StructType:
    fields = [T.StructField(f.name, T.StringType(), True) for f in TABLES[table].fields]
    return T.StructType([*fields, T.StructField(BROKEN, T.StringType(), True)])


def read_raw(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A CSV as text columns plus ``_broken``, the text of a line that has
    not the declared number of fields."""
    return (
        spark.read.schema(raw_schema(table))
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BROKEN)
        .option("nullValue", "")
        .option("emptyValue", None)
        .csv(path)
    )


def load_raw(spark: SparkSession, paths) -> Tables:
    """The four CSVs as text; ``paths`` as for the typed loader."""
    if isinstance(paths, str):
        paths = {t: os.path.join(paths, f"{t}.csv") for t in TABLES}
    return Tables(**{t: read_raw(spark, paths[t], t) for t in TABLES})


def as_text(df: DataFrame, table: str) -> DataFrame:
    """A typed (or half-typed) table as a raw load would see it."""
    cols = [F.col(f.name).cast("string").alias(f.name) for f in TABLES[table].fields]
    broken = F.col(BROKEN) if BROKEN in df.columns else F.lit(None).cast("string")
    return df.select(*cols, broken.alias(BROKEN))


def row_checks(table: str) -> dict[tuple[str, str], Column]:
    """(check, column) -> condition under which a raw row breaks it.  A NULL
    or a value of the wrong type breaks that check alone."""
    whole = F.col(BROKEN).isNull()
    out = {("broken_line", "*"): ~whole}
    for c in not_null_columns(table):
        out["not_null", c] = whole & F.col(c).isNull()
    for f in TABLES[table].fields:
        c = F.col(f.name)
        if f.name in DECIMAL_COLUMNS.get(table, ()):
            number = c.try_cast(ANY_NUMBER).isNotNull() | c.try_cast("double").isNotNull()
            fits = c.try_cast(f.dataType).isNotNull()
            out["bad_type", f.name] = whole & c.isNotNull() & ~number
            out["decimal_range", f.name] = whole & number & ~fits
        elif not isinstance(f.dataType, T.StringType):
            out["bad_type", f.name] = whole & c.isNotNull() & c.try_cast(f.dataType).isNull()
    for name, n in VARCHAR.get(table, {}).items():
        out["varchar_length", name] = whole & (F.length(name) > n)
    return out


def checked(raw: DataFrame, table: str) -> DataFrame:
    """``raw`` with ``_faults``: (check, column) of everything wrong with the row."""
    tests = [
        F.when(cond, F.struct(F.lit(check).alias("check_name"), F.lit(column).alias("column_name")))
        for (check, column), cond in row_checks(table).items()
    ]
    return raw.withColumn(FAULTS, F.array_compact(F.array(*tests)))


def accepted(raw: DataFrame, table: str) -> DataFrame:
    """Rows without a fault, in the declared types."""
    good = checked(raw, table).where(F.size(FAULTS) == 0)
    return good.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TABLES[table].fields])


def rejects(raw: DataFrame, table: str) -> DataFrame:
    """One row per fault: (table_name, check_name, column_name, value, line);
    ``line`` is the whole row as the loader saw it."""
    bad = checked(raw, table).where(F.size(FAULTS) > 0)
    names = [f.name for f in TABLES[table].fields]
    line = F.coalesce(BROKEN, F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in names]))
    value = F.create_map(*[x for c in names for x in (F.lit(c), F.col(c))])
    return bad.select(F.explode(FAULTS).alias("_f"), value.alias("_v"), line.alias("line")).select(
        F.lit(table).alias("table_name"), "_f.check_name", "_f.column_name",
        F.try_element_at("_v", F.col("_f.column_name")).alias("value"), "line",
    )


def load_accepted(spark: SparkSession, paths) -> tuple[Tables, DataFrame]:
    """The typed good rows of the four CSVs, and all reject rows."""
    raw = load_raw(spark, paths).as_dict()
    bad = None
    for name, df in raw.items():
        r = rejects(df, name)
        bad = r if bad is None else bad.unionByName(r)
    return Tables(**{name: accepted(df, name) for name, df in raw.items()}), bad
