"""CSV folders whose files may order their columns differently, with bad rows kept aside."""

from __future__ import annotations

import csv
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from staylens.session import scratch_dir

_BAD, _FILE, _REASON = "_bad_record", "_file", "_reason"


@dataclass(frozen=True)
class CsvRows:
    """What was read: ``good`` rows of the schema, and ``bad`` ones as (file, reason, record)."""

    good: DataFrame
    bad: DataFrame


def headers(spark: SparkSession, path: str, names: list[str], separator: str = ",") -> dict[str, list[str]]:
    """Header line -> the files that have it: the lines that hold every wanted name as a field.

    As many lines come to the driver as there are files.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.rtrim("value").alias("line"))
    fields = F.transform(F.split("line", f"\\Q{separator}\\E"), lambda x: F.trim(x, F.lit(' "﻿')))
    test = F.lit(True)
    for name in names:
        test = test & F.col("line").contains(name)  # cheap, and true for few other lines
    full = F.size(F.array_except(F.array(*[F.lit(n) for n in names]), fields)) == 0
    found: dict[str, list[str]] = {}
    for row in lines.filter(test & full).distinct().collect():
        found.setdefault(row["line"], []).append(row["file"])
    # Listed, not read: an empty file has no line and needs no header.
    listed = spark.read.format("binaryFile").load(path).filter(F.col("length") > 0)
    files = {r["file"] for r in listed.select(F.col("_metadata.file_path").alias("file")).collect()}
    lacking = sorted(files - {f for own in found.values() for f in own})
    if lacking:
        raise ValueError(f"no header with all wanted columns in: {lacking[:5]}")
    return found


def read_csv_folder(spark: SparkSession, path: str, schema: StructType, separator: str = ",") -> CsvRows:
    """Read every file by its own header; rows that do not parse or do not fit their types go to ``bad``.

    Files with one header are read together. All rows are parsed once and written with their
    fault, so both tables, and counts of them, come from the same parse; only a bad row's record is
    put together and written. Columns that ``schema`` does not name are ignored.
    """
    names = [f.name for f in schema.fields]

    def mistyped(field: StructField) -> Column:
        value = F.col(field.name)
        return value.isNotNull() & value.try_cast(field.dataType).isNull()

    reason = F.when(F.col(_BAD).isNotNull(), "malformed")
    for field in schema.fields:
        reason = reason.when(mistyped(field), f"mistyped {field.name}")
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    fault = F.col("_row_fault")
    parts = None
    for line, files in sorted(headers(spark, path, names, separator).items()):
        order = [x.strip(' "﻿') for x in next(csv.reader([line], delimiter=separator))]
        raw = StructType([*[StructField(c, StringType()) for c in order], StructField(_BAD, StringType())])
        rows = spark.read.schema(raw).csv(
            files, header=True, sep=separator, mode="PERMISSIVE", columnNameOfCorruptRecord=_BAD, enforceSchema=True
        )
        record = F.coalesce(_BAD, F.to_csv(F.struct(*[F.col(c) for c in order])))
        part = rows.withColumns({"_row_fault": reason, "_row_file": F.col("_metadata.file_path")}).select(
            *typed, fault.alias(_REASON),
            F.when(fault.isNotNull(), record).alias("record"), F.when(fault.isNotNull(), F.col("_row_file")).alias(_FILE),
        )
        parts = part if parts is None else parts.unionByName(part)
    out = scratch_dir(spark, "csv-rows")
    parts.write.parquet(out)
    parsed = spark.read.parquet(out)
    bad = parsed.filter(F.col(_REASON).isNotNull())
    return CsvRows(
        parsed.filter(F.col(_REASON).isNull()).select(*names),
        bad.select(F.col(_FILE).alias("file"), F.col(_REASON).alias("reason"), "record"),
    )
