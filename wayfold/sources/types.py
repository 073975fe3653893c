"""Column types of a relational source and the Spark types they are read as."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F, types as T

# Source type names and Spark types; those that depend on a size are in source_type.
TYPES = {
    "TINYINT": T.ByteType(),
    "SMALLINT": T.ShortType(),
    "MEDIUMINT": T.IntegerType(),
    "INT": T.IntegerType(),
    "INTEGER": T.IntegerType(),
    "BIGINT": T.LongType(),
    "FLOAT": T.FloatType(),
    "DOUBLE": T.DoubleType(),
    "REAL": T.DoubleType(),
    "DATE": T.DateType(),
    "DATETIME": T.TimestampNTZType(),
    "TIMESTAMP": T.TimestampType(),
    "TIME": T.LongType(),
    "CHAR": T.StringType(),
    "VARCHAR": T.StringType(),
    "ENUM": T.StringType(),
    "SET": T.StringType(),
    "TINYTEXT": T.StringType(),
    "TEXT": T.StringType(),
    "MEDIUMTEXT": T.StringType(),
    "LONGTEXT": T.StringType(),
    "BINARY": T.BinaryType(),
    "VARBINARY": T.BinaryType(),
    "TINYBLOB": T.BinaryType(),
    "BLOB": T.BinaryType(),
    "MEDIUMBLOB": T.BinaryType(),
    "LONGBLOB": T.BinaryType(),
    "GEOMETRY": T.BinaryType(),
    "NULL": T.NullType(),
}


def source_type(
    name: str, size: int | None = None, scale: int = 0, tiny_as_bool: bool = True,
    year_as_date: bool = True,
) -> T.DataType:
    """Spark type of a source type; TIME is read as seconds."""
    name = name.strip().upper()
    if name in ("DECIMAL", "NUMERIC"):
        return T.DecimalType(10 if size is None else size, scale)
    if name == "BIT":
        return T.BooleanType() if size in (None, 1) else T.BinaryType()
    if name == "TINYINT" and size == 1 and tiny_as_bool:
        return T.BooleanType()
    if name == "YEAR":
        return T.DateType() if year_as_date else T.ShortType()
    if name not in TYPES:
        raise ValueError(f"unknown source type {name!r}")
    return TYPES[name]


def source_schema(columns: Iterable[tuple], **options: bool) -> T.StructType:
    """Schema from (column, type name, size, scale); size and scale may be left out."""
    return T.StructType([T.StructField(c, source_type(*declared, **options)) for c, *declared in columns])


def set_to_array(value: Column) -> Column:
    """The members of a SET, whose text joins them by commas."""
    return F.when(value == "", F.array().cast("array<string>")).otherwise(F.split(value, ","))
