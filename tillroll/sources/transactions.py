"""Load raw transactions: declared schema, inferred schema, stream, snapshot."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.schema import TRANSACTIONS, WORKBOOK_HEADERS

# Doubled quotes stand for one; a value that does not fit its type, or a header that does not fit, stops the job.
CSV_OPTIONS = {"header": "true", "escape": '"', "mode": "FAILFAST", "enforceSchema": "false"}


def read_transactions(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "parquet",
    infer: bool = False,
    partitions: int | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Transactions under ``path`` (a file, a folder, a glob or a list of them).

    CSV columns are found by their header, in any order; files read together
    share one. A missing column, a column of another name and a value that is
    not of the declared type stop the job. ``multi_line`` allows line breaks in
    quoted texts; such files are not split, so it is for files of moderate size.
    ``infer`` reads CSV values once more to guess the types of all but the text
    columns (a stock code 0012 stays as it is) and casts them to the declared
    ones; it is meant for profiling. ``partitions`` redistributes the rows;
    splittable files do not need it.
    """
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"unsupported format: {fmt}")
    if fmt == "parquet":
        reader = spark.read if infer else spark.read.schema(TRANSACTIONS)
        df = reader.format("parquet").load(path)
        df = conform(df) if infer else df
    else:
        reader = spark.read.options(**CSV_OPTIONS, multiLine=multi_line)
        found = reader.option("inferSchema", infer).csv(path).schema
        df = conform(reader.schema(_typed(found, infer)).csv(path))
    return df.repartition(partitions) if partitions else df


def _typed(found: T.StructType, inferred: bool = False) -> T.StructType:
    """The file's columns in its order: declared types, or the inferred ones for what is no text."""
    declared = {f.name: f.dataType for f in TRANSACTIONS.fields}
    fields = []
    for field in found.fields:
        kind = declared.get(WORKBOOK_HEADERS.get(field.name, field.name), T.StringType())
        fields.append(T.StructField(field.name, field.dataType if inferred and kind != T.StringType() else kind))
    return T.StructType(fields)


def conform(df: DataFrame) -> DataFrame:
    """The declared columns, found under their own or the workbook's names, cast to the declared types."""
    df = df.withColumnsRenamed({old: new for old, new in WORKBOOK_HEADERS.items() if old in df.columns})
    missing = [f.name for f in TRANSACTIONS.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the source: {', '.join(missing)}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TRANSACTIONS.fields])


def stream_transactions(
    spark: SparkSession,
    folder: str,
    schema: T.StructType = TRANSACTIONS,
    fmt: str = "csv",
    headers: Sequence[str] | None = None,
    **options: str,
) -> DataFrame:
    """Watch ``folder`` for new files; streams need the schema up front.

    ``headers`` are the names in the files' own order, where they are not those
    of ``schema``; a file with another header stops the stream.
    """
    if fmt != "csv":
        return spark.readStream.format(fmt).schema(schema).options(**options).load(folder)
    by_name = {f.name: f for f in schema.fields}
    names = list(headers or by_name)
    fields = [T.StructField(name, by_name[WORKBOOK_HEADERS.get(name, name)].dataType) for name in names]
    stream = spark.readStream.format("csv").schema(T.StructType(fields)).options(**CSV_OPTIONS).options(**options).load(folder)
    found = stream.withColumnsRenamed({name: WORKBOOK_HEADERS.get(name, name) for name in names})
    missing = [name for name in by_name if name not in found.columns]
    if missing:
        raise ValueError(f"columns missing from the stream: {', '.join(missing)}")
    return found.select(*by_name)


def read_snapshot(spark: SparkSession, archive_dir: str, stage: str, run_id: str) -> DataFrame:
    """Read back what ``sinks.archive.archive`` wrote."""
    return spark.read.parquet(f"{archive_dir}/{stage}_{run_id}")
