"""The road job: names, rules, one class per geometry, summary."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from zonalis import config
from zonalis.config import RoadCategory
from zonalis.operators import roads
from zonalis.sources.session import staged


@dataclass(frozen=True)
class Roads:
    classified: DataFrame
    summary: DataFrame
    hits: DataFrame


def classify_roads(segments: DataFrame,
                   categories: Iterable[RoadCategory] = config.ROAD_CATEGORIES) -> Roads:
    categories = list(categories)
    matches = staged(roads.match_rules(roads.with_names(segments), categories), "road-matches")
    classified = staged(roads.first_rule_per_geometry(matches), "roads")
    return Roads(classified, roads.road_summary(classified), roads.rule_hits(matches, categories))
