"""From the annual panel to ranked targets and the sector summary."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import features, scoring
from ledgerloom.session import cut_lineage


@dataclass(frozen=True)
class Targets:
    ranked: DataFrame
    sectors: DataFrame


def acquisition_targets(
    annual: DataFrame, preset: str = "balanced", mode: str = "last_non_null", pad: bool = True
) -> Targets:
    """Features, snapshot, scores, rank and sector means.

    The snapshot has one row per company and is written out, because ranking reads it several
    times; so is the ranked table that the summary is taken from.
    """
    featured = features.with_target_features(annual, pad=pad)
    latest = features.with_some_data(features.latest_values(featured, mode=mode))
    scored = scoring.with_scores(cut_lineage(latest))
    ranked = cut_lineage(scoring.export_columns(scoring.rank_targets(scored, preset=preset)))
    return Targets(ranked.orderBy(F.col("rank")), scoring.sector_summary(ranked))
