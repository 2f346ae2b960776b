"""Data-quality checks (Q1-Q5). Checks that raise are thin wrappers over a
DataFrame that lists the offending rows, so the same logic can be reported
or enforced."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType


class ValidationError(AssertionError):
    """A data-quality check failed."""


def schema_issues(df: DataFrame, expected: StructType) -> list[tuple]:
    """Where the schema of ``df`` differs from ``expected``, at any depth:
    (path, expected, actual, issue). A path such as ``results[].n`` goes
    through arrays (``[]``) and maps (``{key}``, ``{value}``); issue is
    missing, extra, order, type or nullability."""
    return _differences("", expected, df.schema)


def _differences(path: str, expected: DataType, actual: DataType) -> list[tuple]:
    if isinstance(expected, StructType) and isinstance(actual, StructType):
        return _field_differences(path, expected, actual)
    if isinstance(expected, ArrayType) and isinstance(actual, ArrayType):
        return _nullability(f"{path}[]", expected.containsNull, actual.containsNull) \
            + _differences(f"{path}[]", expected.elementType, actual.elementType)
    if isinstance(expected, MapType) and isinstance(actual, MapType):
        return _differences(f"{path}{{key}}", expected.keyType, actual.keyType) \
            + _nullability(f"{path}{{value}}", expected.valueContainsNull, actual.valueContainsNull) \
            + _differences(f"{path}{{value}}", expected.valueType, actual.valueType)
    return [] if expected == actual else [(path, expected.simpleString(), actual.simpleString(), "type")]


def _field_differences(path: str, expected: StructType, actual: StructType) -> list[tuple]:
    def at(name: str) -> str:
        return f"{path}.{name}" if path else name

    out, own, other = [], {f.name: f for f in expected.fields}, {f.name: f for f in actual.fields}
    for name, e in own.items():
        a = other.get(name)
        if a is None:
            out.append((at(name), e.dataType.simpleString(), None, "missing"))
        else:
            out += _nullability(at(name), e.nullable, a.nullable) + _differences(at(name), e.dataType, a.dataType)
    out += [(at(n), None, a.dataType.simpleString(), "extra") for n, a in other.items() if n not in own]
    shared, came = [n for n in expected.names if n in other], [n for n in actual.names if n in own]
    if shared != came:
        out.append((path, ",".join(shared), ",".join(came), "order"))
    return out


def _nullability(path: str, expected: bool, actual: bool) -> list[tuple]:
    said = {True: "nullable", False: "not null"}
    return [] if expected == actual else [(path, said[expected], said[actual], "nullability")]


def schema_diff(spark: SparkSession, df: DataFrame, expected: StructType) -> DataFrame:
    """Q1 report of ``schema_issues`` (schemas are metadata: no data is read)."""
    return spark.createDataFrame(schema_issues(df, expected), "path string, expected string, actual string, issue string")


def assert_schema(df: DataFrame, expected: StructType) -> None:
    """Q1: exact equality of names, types, order and nullability."""
    issues = schema_issues(df, expected)
    if issues:
        raise ValidationError("schema mismatch:\n" + "\n".join(
            f"  {path or 'columns'}: expected {want}, got {got} ({issue})" for path, want, got, issue in issues))


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Q2 report: key groups that occur more than once, with their count."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def assert_primary_key(df: DataFrame, keys) -> None:
    """Q2: raise if any key occurs twice. Only the key columns are read."""
    dups = duplicate_keys(df, keys)
    if not dups.isEmpty():
        sample = [r.asDict() for r in dups.limit(5).collect()]
        raise ValidationError(f"{dups.count()} duplicate primary keys {list(keys)}: e.g. {sample}")


def assert_not_empty(df: DataFrame, what: str = "input") -> None:
    """Q3: raise on an empty DataFrame (reads at most one row)."""
    if df.isEmpty():
        raise ValidationError(f"{what} is empty")


def landed_completeness(bronze: DataFrame, symbols: DataFrame) -> DataFrame:
    """Q4: requested symbols with no landed document at all."""
    landed = bronze.select(F.col("ticker").alias("symbol")).distinct()
    return symbols.select("symbol").distinct().join(landed, "symbol", "left_anti")


def missing_results(bronze: DataFrame) -> DataFrame:
    """Q5: landed documents whose ``results`` is missing or empty; exploding
    them yields no rows, so without this report they vanish silently."""
    n = F.col("results_count") if "results_count" in bronze.columns else F.lit(None)
    return bronze.filter(F.coalesce(n, F.size("results"), F.lit(-1)) <= 0).select("ticker")


def corrupt_documents(bronze: DataFrame) -> DataFrame:
    """S2 report: documents that did not parse, or in which a field did not
    fit the schema, with their text. The bars are read too, since a field
    that nobody asks for is not checked."""
    asked = F.coalesce(F.size("results"), F.lit(0)) >= 0  # always so, but keeps the bars in the plan
    return bronze.withColumn("n_results", F.size("results")).filter(F.col("corrupt").isNotNull() & asked) \
                 .select("source_file", "ticker", "n_results", F.col("corrupt").alias("document"))


def assert_no_corrupt_documents(bronze: DataFrame, n: int | None = None) -> None:
    """Raise if any document is corrupt; the full list stays in the report.
    ``n`` is their number where it has been observed already
    (``observe_documents``): then documents are parsed again only to name
    the corrupt ones."""
    bad = corrupt_documents(bronze)
    n = bad.count() if n is None else n
    if n:
        raise ValidationError(f"{n} corrupt documents, e.g. in "
                              f"{sorted({r.source_file for r in bad.limit(5).collect()})}")


def observe_documents(bronze: DataFrame, seen: Observation) -> DataFrame:
    """``bronze`` with its documents, and the corrupt and the empty ones among
    them, counted into ``seen`` by whatever job reads it."""
    empty = F.coalesce(F.col("results_count"), F.size("results"), F.lit(-1)) <= 0
    return bronze.observe(seen, F.count(F.lit(1)).alias("documents"), F.count_if(F.col("corrupt").isNotNull()).alias("corrupt"),
                          F.count_if(F.col("corrupt").isNull() & empty).alias("empty"))
