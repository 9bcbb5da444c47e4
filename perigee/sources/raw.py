"""The three raw datasets by format and base path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from perigee.model import COVERAGE, PERFORMANCE, RAW_DATASETS, SATELLITE, RawDataset
from perigee.sources.files import scan_csv, scan_json, scan_parquet
from perigee.sources.json_records import CORRUPT, read_records, with_corrupt

RAW_FORMATS = ("csv", "json", "parquet")


def extract_dataset(
    spark: SparkSession,
    path: str,
    dataset: RawDataset,
    file_format: str = "csv",
    multi_line: bool = False,
) -> DataFrame:
    match file_format.lower():
        case "csv":
            return scan_csv(spark, path, dataset.schema)
        case "json":
            return scan_json(spark, path, dataset.schema, multi_line)
        case "parquet":
            return scan_parquet(spark, path, dataset.schema)
        case other:
            raise ValueError(f"unsupported format {other!r}; expected one of {RAW_FORMATS}")


def extract_satellite(
    spark: SparkSession, path: str, file_format: str = "csv", multi_line: bool = False
) -> DataFrame:
    return extract_dataset(spark, path, SATELLITE, file_format, multi_line)


def extract_coverage(
    spark: SparkSession, path: str, file_format: str = "csv", multi_line: bool = False
) -> DataFrame:
    return extract_dataset(spark, path, COVERAGE, file_format, multi_line)


def extract_performance(
    spark: SparkSession, path: str, file_format: str = "csv", multi_line: bool = False
) -> DataFrame:
    return extract_dataset(spark, path, PERFORMANCE, file_format, multi_line)


def raw_path(base_path: str, dataset: RawDataset, file_format: str) -> str:
    name = f"{dataset.file_stem}.{file_format.lower()}"
    return f"{base_path.rstrip('/')}/{name}" if base_path else name


def extract_all(
    spark: SparkSession, base_path: str = "", file_format: str = "csv", multi_line: bool = False
) -> dict[str, DataFrame]:
    return {
        d.name: extract_dataset(spark, raw_path(base_path, d, file_format), d, file_format, multi_line)
        for d in RAW_DATASETS
    }


def extract_with_rejects(
    spark: SparkSession, path: str, dataset: RawDataset, file_format: str, multi_line: bool = False
) -> DataFrame:
    """Raw text rows with one column more: the raw text of a row that could not be fully parsed, else NULL.

    One pass over the text gives both the rows and the rejects. With ``multi_line`` JSON is read by file, and the raw
    text is that of the file.
    """
    if file_format.lower() == "json" and not multi_line:
        return read_records(spark, path, dataset.schema)
    reader = spark.read.schema(with_corrupt(dataset.schema)).option("columnNameOfCorruptRecord", CORRUPT)
    if file_format.lower() == "csv":
        scan_csv(spark, path, dataset.schema).limit(0).count()  # a wrong header is an error
        return reader.option("header", True).csv(path)
    return reader.option("multiLine", True).json(path)


def require_nonempty(inputs: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Fail when a dataset has no rows. Looks for one row; counts nothing."""
    empty = [name for name, df in inputs.items() if df.isEmpty()]
    if empty:
        raise ValueError(f"no rows in {', '.join(empty)}")
    return inputs
