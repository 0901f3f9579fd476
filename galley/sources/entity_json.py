"""Source JSON: reading, observed schema, drift against the contract, typed projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from galley.sources.array_files import array_records
from galley.sources.contracts import CONTRACTS, TIMESTAMP_COLUMNS


# Text of records that are no JSON objects; never part of a schema or contract.
MALFORMED = "_malformed_record"


def read_json(
    spark: SparkSession, path: str, schema: T.StructType | None = None, arrays: bool = True
) -> DataFrame:
    """JSON files of one entity, without columns taken from the path.

    ``arrays`` reads files holding one array of records, otherwise they hold a record per
    line; both are read by as many tasks as their bytes ask for. A record that cannot be
    parsed is a row of NULLs, with its text in ``MALFORMED`` where the schema asks for that.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("columnNameOfCorruptRecord", MALFORMED)
    if schema is not None:
        reader = reader.schema(schema)
    if not arrays:
        return reader.json(path)
    texts = getattr(array_records(spark, path)._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    return DataFrame(reader._jreader.json(texts), spark)


def _temporal(kind: T.DataType) -> bool:
    return isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType))


def read_entity(spark: SparkSession, path: str, entity: str, arrays: bool = True) -> DataFrame:
    """JSON of one entity in its contract's columns, as a load would keep it.

    Numbers have the type found in the files where it is another than the contract's, so a
    price with cents keeps them; new columns are left out.
    """
    observed = observe_schema(spark, path, arrays)
    breaking = [row for row in drift_rows(entity, CONTRACTS[entity], observed) if row[-1]]
    if breaking:
        raise ValueError(f"{path} breaks the contract of {entity}: {breaking}")
    accepted = accepted_schema(CONTRACTS[entity], observed)
    known = T.StructType([accepted[f.name] for f in CONTRACTS[entity].fields])
    return typed(read_json(spark, path, observed, arrays), known)


def observe_schema(spark: SparkSession, path: str, arrays: bool = True) -> T.StructType:
    """Names and types found in the files, over all their records."""
    found = read_json(spark, path, arrays=arrays).schema
    return T.StructType([f for f in found.fields if f.name != MALFORMED])


def with_malformed(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())])


def date_columns(contract: T.StructType) -> list[str]:
    return [f.name for f in contract.fields if isinstance(f.dataType, T.DateType)]


def is_bad_date(column: str) -> Column:
    """Whether text is there that is no date."""
    text = F.col(f"`{column}`")
    return text.isNotNull() & text.try_cast("date").isNull()


def drift(
    spark: SparkSession, source: str, expected: T.StructType, actual: T.StructType
) -> DataFrame:
    """One row per difference between contract and observed schema."""
    rows = drift_rows(source, expected, actual)
    return spark.createDataFrame(
        rows,
        "source string, column string, change string, expected string, actual string, breaking boolean",
    )


def drift_rows(
    source: str, expected: T.StructType, actual: T.StructType
) -> list[tuple[str, str, str, str | None, str | None, bool]]:
    """Missing columns break a load, and so do type changes other than between numbers.

    Text is what JSON holds for a date or time, so it is no change of one; that the text is
    a date is seen when it is read.
    """
    found = {f.name: f.dataType for f in actual.fields}
    known = {f.name: f.dataType for f in expected.fields}
    rows = []
    for name, kind in known.items():
        if name not in found:
            rows.append((source, name, "missing", kind.simpleString(), None, True))
            continue
        seen = found[name]
        if seen == kind or (_temporal(kind) and (_temporal(seen) or isinstance(seen, T.StringType))):
            continue
        numbers = isinstance(kind, T.NumericType) and isinstance(seen, T.NumericType)
        rows.append((source, name, "type", kind.simpleString(), seen.simpleString(), not numbers))
    for name, seen in found.items():
        if name not in known:
            rows.append((source, name, "new", None, seen.simpleString(), False))
    return rows


def accepted_schema(expected: T.StructType, actual: T.StructType) -> T.StructType:
    """The contract after accepted drift: known columns first, observed types, then new ones."""
    found = {f.name: f.dataType for f in actual.fields}
    fields = [
        T.StructField(f.name, f.dataType if _temporal(f.dataType) else found[f.name])
        for f in expected.fields
        if f.name in found
    ]
    names = {f.name for f in fields}
    return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in actual.fields if f.name not in names])


def typed(df: DataFrame, contract: T.StructType) -> DataFrame:
    """The contract's columns in its order; malformed dates and times become NULL."""

    def column(f: T.StructField) -> Column:
        value = F.col(f"`{f.name}`")
        return (value.try_cast(f.dataType) if _temporal(f.dataType) else value.cast(f.dataType)).alias(f.name)

    return df.select(*[column(f) for f in contract.fields])


def with_lineage(df: DataFrame, source: str, batch_id: str) -> DataFrame:
    return df.withColumns(
        {
            "_source_file": F.lit(f"{source}.json"),
            "_loaded_at": F.current_timestamp(),
            "_batch_id": F.lit(batch_id),
        }
    )


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column, one row per column that has any."""
    one_row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("null_count")) for c in columns]
    return one_row.select(F.inline(F.array(*pairs))).where("null_count > 0")


def timestamp_columns(source: str) -> Sequence[str]:
    return TIMESTAMP_COLUMNS.get(source, ())
