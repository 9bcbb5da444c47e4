"""Raw datasets to processed datasets and hourly statistics."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from perigee.model import COVERAGE_STATS, PERFORMANCE_STATS, SATELLITE_STATS
from perigee.operators.cleaning import impute_velocity_mean, orbital_metrics, valid_positions
from perigee.operators.rollups import (
    hourly_coverage_stats,
    hourly_performance_stats,
    mean_velocity_of,
    stats_from_partials,
    velocity_partials,
)

Cut = Callable[[DataFrame], DataFrame]


def transform_all(
    inputs: Mapping[str, DataFrame], cut: Cut = lambda df: df
) -> dict[str, DataFrame]:
    """All outputs the given inputs allow; absent inputs are skipped.

    Satellite rows are cleaned and given orbital metrics; coverage and performance pass through as
    they are. ``cut`` is applied to the hourly satellite sums and may materialise them, for example
    with ``checkpoint``: then one pass over the satellite rows serves both their statistics and the
    mean that fills velocity in the detail rows.
    """
    outputs: dict[str, DataFrame] = {}
    if "satellite" in inputs:
        valid = valid_positions(inputs["satellite"])
        partials = cut(velocity_partials(valid))
        filled = impute_velocity_mean(valid, mean_velocity_of(partials))
        outputs["satellite"] = orbital_metrics(filled)
        outputs[SATELLITE_STATS.name] = stats_from_partials(partials)
    for name, rollup, table in (
        ("coverage", hourly_coverage_stats, COVERAGE_STATS),
        ("performance", hourly_performance_stats, PERFORMANCE_STATS),
    ):
        if name in inputs:
            outputs[name] = inputs[name]
            outputs[table.name] = rollup(inputs[name])
    return outputs
