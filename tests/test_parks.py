import datetime as dt

import pytest

from queuelake.parks import ParkLake


def hours(*dates):
    return {"schedule": [{"date": d, "type": "OPERATING", "openingTime": f"{d}T09:00:00Z", "closingTime": f"{d}T21:00:00Z"} for d in dates]}


def ride(name, wait):
    return {"id": name, "name": name, "entityType": "ATTRACTION", "lastUpdated": "2026-04-14T12:00:00Z", "queue": {"STANDBY": {"waitTime": wait}}}


@pytest.fixture(scope="module")
def parks(landed):
    children = [{"id": i, "name": i, "entityType": "SHOW"} for i in "zya"]
    return ParkLake(
        landed(
            ("/destinations", {"destinations": [{"id": "d1", "name": "Wonder World", "slug": "wonder"}, {"id": "d2", "name": "Wonder Land"}]}),
            ("/entity/d1/children", {"id": "d1", "children": children}),
            ("/entity/p%201", {"id": "p 1", "name": "P", "entityType": "PARK", "timezone": "UTC"}),
            ("/entity/p%201/live", {"liveData": [ride("old", 5)]}),
            ("/entity/p%201/live", {"liveData": [ride("B", 10), ride("A", None), ride("C", 45)]}),
            ("/entity/p%201/schedule", hours("2026-04-15")),
            ("/entity/p%201/schedule/2026/04", hours("2026-04-01", "2026-04-30")),
            ("/entity/p%201/schedule/2026/05", hours("2026-05-02", "2026-05-01")),
            ("/entity/other/schedule/2026/05", hours("2026-05-03")),
        )
    )


def test_directory(parks, spark):
    assert [r.id for r in parks.destinations().orderBy("ord").collect()] == ["d1", "d2"]
    assert [r.id for r in parks.find("WONDER").collect()] == ["d1"]
    assert [r.id for r in parks.find("wonderland").collect()] == ["d2"]
    assert parks.find(" ").count() == 0
    asked = spark.createDataFrame([("wonder land",), ("moon",)], "q string")
    assert {(r.q, r.id) for r in parks.find_many(asked).collect()} == {("wonder land", "d2"), ("moon", None)}


def test_entity(parks):
    assert [r.id for r in parks.entity("d1").descendants().orderBy("ord").collect()] == ["z", "y", "a"]
    park = parks.entity("p 1")
    assert [r.name for r in park.record().collect()] == ["P"]
    assert [(r.name, r.wait) for r in park.board().collect()] == [("A", None), ("B", 10), ("C", 45)]
    assert [r.name for r in park.longest_waits().collect()] == ["C", "B"]
    assert park.queue_offers().count() == 3


def test_schedules(parks):
    park = parks.entity("p 1")
    assert [r.date for r in park.upcoming().collect()] == ["2026-04-15"]
    assert park.month(2026, 4).count() == 2
    between = park.schedule_between(dt.date(2026, 4, 30), dt.date(2026, 5, 2))
    assert [r.date for r in between.collect()] == ["2026-04-30", "2026-05-01", "2026-05-02"]
    assert park.schedule_between(dt.date(2026, 5, 2), dt.date(2026, 4, 30)).count() == 0
