"""The usual questions about one destination, park or ride, asked of a lake of landed responses.

For all entities at once use the functions in `queuelake.operators`; the handles here only narrow the
lake to one entity first, so a partitioned lake is read for that endpoint and entity alone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queuelake.functions import paths
from queuelake.operators import directory, flatten, live, schedule
from queuelake.sources import bronze
from queuelake.sources.validate import documents


class ParkLake:
    """Questions to a lake of responses (see `queuelake.sources.bronze.read_bronze`).

    Where a path was fetched more than once, the newest response counts.
    """

    def __init__(self, responses: DataFrame) -> None:
        self._responses = bronze.route(responses)

    def destinations(self) -> DataFrame:
        """The directory, in list order by `ord`."""
        listing = self._responses.where(F.col("endpoint") == "destinations")
        return flatten.destinations(documents(bronze.newest_per_path(listing), "destinations"))

    def find(self, query: str) -> DataFrame:
        """First destination whose slug or name loosely contains `query`; no row when none does."""
        return directory.find(self.destinations(), query)

    def find_many(self, queries: DataFrame) -> DataFrame:
        """`find` for every row of `queries(q)`."""
        return directory.find_many(self.destinations(), queries)

    def entity(self, entity_id: str) -> Entity:
        # The encoded path is what storage can skip by; the decoded id settles the rest.
        path = paths.entity_path(F.lit(entity_id))
        own = (F.col("path") == path) | F.col("path").startswith(F.concat(path, F.lit("/")))
        return Entity(self._responses.where(own & (F.col("entity_id") == entity_id)))


class Entity:
    """One destination, park, ride, show, hotel or restaurant."""

    def __init__(self, responses: DataFrame) -> None:
        self._responses = responses

    def _newest(self, kind: str, responses: DataFrame | None = None) -> DataFrame:
        chosen = self._responses if responses is None else responses
        stored = chosen.where(F.col("endpoint") == kind)
        return documents(bronze.newest_per_path(stored), kind)

    def record(self) -> DataFrame:
        return flatten.entities(self._newest("entity"))

    def descendants(self) -> DataFrame:
        """Everything below the entity, in payload order by `ord`."""
        return flatten.descendants(self._newest("children"))

    def live(self) -> DataFrame:
        """Live entries of the newest poll."""
        return flatten.live(self._newest("live"))

    def board(self) -> DataFrame:
        """Live entries with their waits, by name."""
        return live.board_by_name(self.live())

    def longest_waits(self) -> DataFrame:
        return live.longest_waits(self.live())

    def queue_offers(self) -> DataFrame:
        return live.queue_offers(self.live())

    def upcoming(self) -> DataFrame:
        return flatten.schedule(self._newest("schedule", bronze.upcoming(self._responses)))

    def month(self, year: int, month: int) -> DataFrame:
        return flatten.schedule(self._newest("schedule", bronze.month_page(self._responses, year, month)))

    def schedule_between(self, start: dt.date, end: dt.date) -> DataFrame:
        """Entries dated within `[start, end]`, by date; empty when `end` is before `start`."""
        pages = self._responses.where(F.col("year").between(start.year, end.year))
        return schedule.range_report(flatten.schedule(self._newest("schedule", pages)), start, end)
