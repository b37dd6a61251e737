import math
import random

import pytest
from pyspark.sql import functions as F

from perron.functions import unit_sphere
from perron.operators import nearest


def km(lat1, lon1, lat2, lon2):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    h = math.sin((p2 - p1) / 2) ** 2
    h += math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * 6371.0088 * math.asin(min(1, math.sqrt(h)))


@pytest.mark.parametrize("seed, spread", [(1, 0.2), (2, 5.0), (3, 90.0)])
def test_batch_equals_brute_force(spark, seed, spread):
    rng = random.Random(seed)
    centre = [(52.5, 13.4), (0.0, 179.9), (89.0, 0.0), (-89.9, -179.0)]

    def place():
        lat, lon = rng.choice(centre)
        lat = max(-90.0, min(90.0, lat + rng.uniform(-spread, spread)))
        return round(lat, 7), round((lon + rng.uniform(-2 * spread, 2 * spread) + 180) % 360 - 180, 7)

    stations = [(k, f"s{k}", *place()) for k in range(150)]
    stations.append((150, "twin", stations[7][2], stations[7][3]))
    points = [(i, *place()) for i in range(300)] + [(300, 90.0, 0.0), (301, -90.0, 10.0), (302, 0.0, 180.0), (303, 0.0, 0.0)]
    station_df = spark.createDataFrame(
        stations, "station_key long, station_name string, latitude double, longitude double"
    ).union(spark.sql("select 999L, 'nowhere', cast(null as double), cast(null as double)"))
    found = nearest.nearest_station_batch(spark.createDataFrame(points, "point_id long, lat double, lon double"), station_df)
    got = {r.point_id: (r.station_key, r.distance_km) for r in found.collect()}
    assert len(got) == len(points)
    for i, lat, lon in points:
        best = min(km(lat, lon, s[2], s[3]) for s in stations)
        key, distance = got[i]
        assert distance == pytest.approx(best, abs=1e-6)
        assert km(lat, lon, stations[key][2], stations[key][3]) == pytest.approx(best, abs=1e-6)
        assert key != 150


def test_single_point_ties_go_to_the_lower_key(spark):
    stations = spark.createDataFrame(
        [(2, "b", 52.0, 13.0), (1, "a", 52.0, 13.0), (3, "c", 53.0, 13.0)],
        "station_key long, station_name string, latitude double, longitude double",
    )
    assert nearest.nearest_station(stations, 52.1, 13.0).first().station_key == 1


def test_far_cells_keep_few_candidates(spark):
    rng = random.Random(4)
    stations = [(k, f"s{k}", rng.uniform(47.3, 55.0), rng.uniform(5.9, 15.0)) for k in range(2000)]
    station_df = spark.createDataFrame(stations, "station_key long, station_name string, latitude double, longitude double")
    points = [(i, rng.uniform(-35.0, -30.0), rng.uniform(140.0, 152.0)) for i in range(200)]
    placed = spark.createDataFrame(points, "point_id long, lat double, lon double").withColumn("cell", nearest._cell(F.col("lat"), F.col("lon")))
    sx, sy, sz = unit_sphere(F.col("latitude"), F.col("longitude"))
    per_cell = nearest._contenders(placed, station_df.withColumns({"cell": nearest._cell(F.col("latitude"), F.col("longitude")), "sx": sx, "sy": sy, "sz": sz})).groupBy("cell").count().collect()
    assert len(per_cell) == placed.select("cell").distinct().count()
    assert sum(r["count"] for r in per_cell) / len(per_cell) < 20
