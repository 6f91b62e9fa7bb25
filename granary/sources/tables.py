"""Table, file and literal sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A parquet table of a folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def delimited(spark: SparkSession, path: str, schema: str | T.StructType, separator: str = ";") -> DataFrame:
    """Delimited file with one heading line; the schema is stated, so the file is read once."""
    return spark.read.csv(path, sep=separator, header=True, schema=schema)


def lines(spark: SparkSession, path: str, name: str = "str") -> DataFrame:
    """Raw lines, each one text column."""
    return spark.read.text(path).withColumnRenamed("value", name)


def quoted_cells(rows: DataFrame, line: str, names: Sequence[str], separator: str = ";", quote: str = '"', keep: str | None = None) -> DataFrame:
    """Split quoted, separated lines into text columns called ``names``; an unquoted empty cell is NULL.

    A quote inside a quoted cell is doubled. ``keep`` names a column for the line itself. The line is parsed once: the cells
    leave the parser through ``inline``, where a projection of fields would be parsed anew for each of them.
    """
    places = [f"c{i}" for i in range(len(names))]
    schema = ", ".join(f"{p} STRING" for p in places)
    parsed = F.from_csv(F.col(line), F.lit(schema), {"sep": separator, "quote": quote, "escape": quote})
    cells = rows.select(*([F.col(line).alias(keep)] if keep else []), F.inline(F.array(parsed)))
    return cells.select(*[F.col(p).alias(n) for p, n in zip(places, names, strict=True)], *([keep] if keep else []))


def quoted_file(spark: SparkSession, path: str, names: Sequence[str], separator: str = ";", quote: str = '"') -> DataFrame:
    """Quoted delimited file without heading handling: every line is data, every column text."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.read.csv(path, sep=separator, quote=quote, escape=quote, schema=schema)


def literal(spark: SparkSession, rows: Sequence[Sequence], schema: str | T.StructType) -> DataFrame:
    """A table written out in the program, as for a journal row."""
    return spark.createDataFrame([tuple(r) for r in rows], schema)


def mapped(source: DataFrame, mapping: Mapping[str, str | Column]) -> DataFrame:
    """Fill target columns by name, never by position."""
    return source.select(*[(F.col(e) if isinstance(e, str) else e).alias(t) for t, e in mapping.items()])


def matching(df: DataFrame, target: T.StructType) -> DataFrame:
    """Columns of ``df`` in the order and types of ``target``; a missing or extra column is an error."""
    missing = [f.name for f in target if f.name not in df.columns]
    extra = [c for c in df.columns if c not in target.fieldNames()]
    if missing or extra:
        raise ValueError(f"columns differ from the target: missing {missing}, extra {extra}")
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in target])


def retyped(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Change the type of columns in place."""
    return df.withColumns({c: F.col(f"`{c}`").cast(t) for c, t in types.items()})


def flattened(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Flat columns from nested records: ``{"region_name": "address.region.name"}``."""
    return df.select(*[F.col(path).alias(name) for name, path in columns.items()])
