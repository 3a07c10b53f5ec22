"""Raw files as frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from millrace import fixed
from millrace.functions.text import column, quoted, spare
from millrace.settings import scratch
from millrace.sources.local import local_frame

MALFORMED = StructType([StructField("FILE", StringType()), StructField("RECORD", StringType())])
# Spark's own column for records that schema inference could not parse.
CORRUPT = "_corrupt_record"

AS_TEXT = {"json": {"primitivesAsString": True}, "xml": {"inferSchema": False}}


def read_raw(
    spark: SparkSession,
    path: str | list[str],
    fmt: str,
    sep: str | None = None,
    header: bool = True,
    as_text: bool = False,
    **options,
) -> DataFrame:
    """Read a raw file in any format Spark knows by name.

    Delimited text is read as text columns, by header or, without one, as `_c0`, `_c1`, ...
    A quote inside quotes is doubled and a backslash is a plain character; `options` may say
    otherwise, and may hold any other option of the format.

    `as_text` keeps the values of JSON and XML as the file spells them, `00501` and `1.10`: types
    are inferred only where columns pass through unmapped.
    """
    if as_text:
        options = {**AS_TEXT.get(fmt.lower(), {}), **options}
    if fmt.lower() == "csv":
        options = {"header": header, "sep": sep or ",", "escape": '"', **options}
    return spark.read.format(fmt.lower()).options(**options).load(path)


def split_malformed(
    spark: SparkSession,
    path: str | list[str],
    fmt: str,
    sep: str | None = None,
    header: bool = True,
    as_text: bool = False,
    work: str | None = None,
    schema: str | None = None,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """The records of a raw file that fit its columns, as `read_raw` has them, and those that do not:
    FILE and RECORD, the text as it stands in the file.

    Delimited records with too many or too few fields do not fit, nor do JSON and XML records that
    cannot be parsed. Formats with a schema of their own have none. The file is parsed once, into a
    table under `work`, from which both are read, so both are of one reading. The columns are those
    of `schema` (SQL text), or else those that the header, the first record or, of JSON and XML, the
    whole text shows.
    """
    kind = fmt.lower()
    if kind not in ("csv", "json", "xml"):
        return (read_raw(spark, path, fmt, sep, header, as_text, **options),
                local_frame(spark, [], MALFORMED))
    shown = (StructType.fromDDL(schema) if schema
             else read_raw(spark, path, fmt, sep, header, as_text, **options).schema)
    columns = [f for f in shown if f.name.lower() != CORRUPT]
    record, = spare(shown.names, "_record")
    wanted = StructType([*columns, StructField(record, StringType())])
    options = {**options, "columnNameOfCorruptRecord": record, "mode": "PERMISSIVE"}
    if as_text:
        options = {**AS_TEXT.get(kind, {}), **options}
    if kind == "csv":
        options = {"header": header, "sep": sep or ",", "escape": '"', "enforceSchema": True, **options}
    place = f"{work or scratch(spark, 'work')}/parsed"
    file, = spare([*shown.names, record], "_file")
    spark.read.format(kind).options(**options).schema(wanted).load(path).withColumn(
        file, F.col("_metadata.file_path")).write.mode("overwrite").parquet(place)
    parsed = spark.read.schema(StructType([*wanted, StructField(file, StringType())])).parquet(place)
    good = parsed.where(F.col(quoted(record)).isNull()).select(*[column(f.name) for f in columns])
    return good, parsed.where(F.col(quoted(record)).isNotNull()).select(
        F.col(quoted(file)).alias("FILE"), F.col(quoted(record)).alias("RECORD"))


def has_header(flag: str | None) -> bool:
    return flag == fixed.YES
