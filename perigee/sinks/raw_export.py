"""Write the raw datasets in any format the scans read."""

from __future__ import annotations

from pyspark.sql import DataFrame

from perigee.model import RAW_DATASETS
from perigee.sources.files import conform_schema
from perigee.sources.raw import RAW_FORMATS, raw_path

# Keeps microseconds, which the default text form cuts to milliseconds.
_TEXT_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def export_raw(
    inputs: dict[str, DataFrame], base_path: str, file_format: str = "csv", mode: str = "error"
) -> None:
    """One folder per dataset. JSON is written as JSON Lines."""
    file_format = file_format.lower()
    if file_format not in RAW_FORMATS:
        raise ValueError(f"unsupported format {file_format!r}; expected one of {RAW_FORMATS}")
    for dataset in RAW_DATASETS:
        if dataset.name not in inputs:
            continue
        writer = conform_schema(inputs[dataset.name], dataset.schema).write.mode(mode)
        if file_format == "csv":
            writer = writer.option("header", True)
        if file_format in ("csv", "json"):
            writer = writer.option("timestampFormat", _TEXT_TIME)
        writer.format(file_format).save(raw_path(base_path, dataset, file_format))
