"""Sites, roads and substations to the three result tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame

from .. import settings as S
from ..operators import network as N
from ..operators.cleaning import first_present
from ..operators.spatial import dealt
from ..session import materialise


class NetworkPlan:
    """The chain from raw geometry to proposed stations, friction points and scorecard.

    Intermediate tables that several branches read (kept roads, interurban
    stations, proposals) are stored once.  A road's label is the first of the columns
    ``labels`` that the table has; with a ``box`` (ranges of x and y) only roads that
    meet it take part.
    """

    def __init__(
        self,
        sites: DataFrame,
        roads: DataFrame,
        urban: DataFrame,
        country: DataFrame,
        substations: DataFrame,
        growth: Column,
        spacing: float = S.FILL_SPACING_M,
        exclusion: float = S.FILL_EXCLUSION_M,
        labels: Sequence[str] = ("label",),
        box: tuple[tuple[float, float], tuple[float, float]] | None = None,
    ) -> None:
        self.sites, self.all_roads, self.urban, self.country = sites, roads, urban, country
        self.substations, self.growth = substations, growth
        self.spacing, self.exclusion = spacing, exclusion
        self.labels, self.box = labels, box

    @cached_property
    def roads(self) -> DataFrame:
        named = self.all_roads.withColumn("label", first_present(self.all_roads, self.labels))
        # stored in as many parts as a shuffle has: what follows is much work on few bytes
        return materialise(dealt(N.interurban_roads(N.main_roads(named, box=self.box), self.urban)))

    @cached_property
    def stations(self) -> DataFrame:
        return materialise(N.interurban_sites(self.sites, self.roads, self.urban))

    @property
    def expand(self) -> DataFrame:
        snapped = N.snap_to_road(self.stations, self.roads)
        return N.expand_stations(materialise(N.station_pressure(snapped, self.growth)))

    @property
    def fill(self) -> DataFrame:
        candidates = N.road_candidates(self.roads, self.spacing)
        return N.fill_candidates(candidates, self.country, self.urban, self.stations, self.exclusion)

    @cached_property
    def thinned(self) -> DataFrame:
        return N.thin_candidates(self.fill, self.spacing)

    @cached_property
    def proposed(self) -> DataFrame:
        """Places in the country, each once, then rated: what is dropped is never looked up."""
        both = N.proposals(self.expand, self.thinned)
        places = N.unique_places(N.clip_to_country(both, self.country))
        return materialise(N.with_grid_status(places, self.substations))

    @property
    def proposed_stations(self) -> DataFrame:
        return N.proposed_stations(self.proposed)

    @property
    def friction_points(self) -> DataFrame:
        return N.friction_points(self.proposed, self.substations)

    def scorecard(self, projected: DataFrame) -> DataFrame:
        return N.kpi_scorecard(self.proposed, self.stations, projected)
