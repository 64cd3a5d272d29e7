"""Region lookup against a brute-force test with exact fractions."""

import json
import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from moodlens.operators import assign_region, read_index, region_index, write_index
from moodlens.operators.regions import _entries
from moodlens.schemas import REGION
from moodlens.sources.regions import across_antimeridian, load_regions, regions_from_geojson

SQUARE = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]
HOLE = [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 2.0)]
CONCAVE = [(3.0, 3.0), (9.0, 3.0), (9.0, 8.0), (6.0, 4.5), (3.0, 8.0)]
PART = [(-5.5, -3.5), (-4.5, -3.5), (-4.5, -2.5)]
REGIONS = {
    ("Holed", "HO"): [SQUARE, HOLE],
    ("Concave", "CO"): [CONCAVE],
    ("Parts", "PA"): [PART, [(20.0, 0.0), (21.0, 0.0), (21.0, 30.0), (20.0, 30.0), (20.0, 0.0)]],
}


def region_rows(regions):
    return [
        (ordinal, name, code, ring, seq, lon, lat)
        for ordinal, ((name, code), rings) in enumerate(regions.items())
        for ring, points in enumerate(rings)
        for seq, (lon, lat) in enumerate(points)
    ]


def brute_force(regions, location):
    try:
        lat, lon = (Fraction(float(part)) for part in location.split(",")[:2])
    except (AttributeError, ValueError, OverflowError):
        return "Unknown"
    for (name, _), rings in regions.items():
        odd = touching = False
        for points in rings:
            for (x1, y1), (x2, y2) in zip(points, points[1:] + points[:1]):
                x1, y1, x2, y2 = map(Fraction, (x1, y1, x2, y2))
                if (x1, y1) == (x2, y2):
                    continue
                side = (x2 - x1) * (lat - y1) - (lon - x1) * (y2 - y1)
                within = min(x1, x2) <= lon <= max(x1, x2) and min(y1, y2) <= lat <= max(y1, y2)
                touching = touching or (side == 0 and within)
                if (y1 > lat) != (y2 > lat) and (y2 > y1) == (side > 0):
                    odd = not odd
        if odd and not touching:
            return name
    return "Unknown"


def lookup(spark, index, locations):
    df = spark.createDataFrame(list(enumerate(locations)), "id int, location string")
    return [row["region_name"] for row in assign_region(df, index).orderBy("id").collect()]


@pytest.mark.parametrize("max_broadcast_bytes", [10**8, 0])
@pytest.mark.parametrize("cells_per_degree", [1, 4])
def test_fixed_points(spark, max_broadcast_bytes, cells_per_degree):
    index = region_index(spark.createDataFrame(region_rows(REGIONS), REGION), cells_per_degree, max_broadcast_bytes)
    cases = {
        "0.5,0.5": "Holed",
        "1.5,1.5": "Unknown",  # in the hole
        "1.0,1.5": "Unknown",  # on the hole's edge
        "0.0,2.0": "Unknown",  # on the outer edge
        "4.0,4.0": "Concave",  # a corner of one, inside the other
        "3.5,3.5": "Holed",  # in two regions
        "6.0,6.0": "Unknown",  # in the notch
        "-3.25,-4.75": "Parts",
        "29.5,20.5": "Parts",
        " 0.5 , 0.5 ,7": "Holed",
        "0.5": "Unknown",
        "abc": "Unknown",
        "": "Unknown",
        "nan,nan": "Unknown",
        "inf,0.5": "Unknown",
        None: "Unknown",
        "1e300,1e300": "Unknown",
    }
    assert dict(zip(cases, lookup(spark, index, list(cases)))) == cases


@pytest.mark.parametrize("seed", range(4))
def test_random_polygons_equal_brute_force(spark, seed):
    rng = random.Random(seed)

    def polygon():
        cx, cy = rng.uniform(-8, 8), rng.uniform(-8, 8)
        return [
            (round((cx + rng.uniform(-5, 5)) * 8) / 8, round((cy + rng.uniform(-5, 5)) * 8) / 8)
            for _ in range(rng.randint(3, 12))
        ]

    regions = {(f"R{i}", f"{i}"): [polygon() for _ in range(rng.randint(1, 3))] for i in range(6)}
    grid = [f"{rng.randint(-100, 100) / 8},{rng.randint(-100, 100) / 8}" for _ in range(400)]
    fine = [f"{rng.uniform(-13, 13)!r},{rng.uniform(-13, 13)!r}" for _ in range(400)]
    corners = [f"{y!r},{x!r}" for rings in regions.values() for ring in rings for x, y in ring]
    locations = grid + fine + corners
    expected = [brute_force(regions, location) for location in locations]
    assert len(set(expected)) > 3
    table = spark.createDataFrame(region_rows(regions), REGION)
    assert lookup(spark, region_index(table, 2), locations) == expected
    assert lookup(spark, region_index(table, 1, max_broadcast_bytes=0), locations) == expected


def test_cell_size_must_be_exact(spark):
    with pytest.raises(ValueError):
        region_index(spark.createDataFrame([], REGION), cells_per_degree=10)


def test_inner_cells_carry_no_edges(spark):
    big = {("Big", "B"): [[(0.5, 0.5), (20.5, 0.5), (20.5, 20.5), (0.5, 20.5)]]}
    cells = region_index(spark.createDataFrame(region_rows(big), REGION)).cells
    inner = cells.where("size(candidates[0].edges) = 0")
    assert inner.count() == 19 * 19 and inner.where("size(candidates[0].flips) <> 1").count() == 0
    assert cells.count() == 21 * 21


TEETH = [(i / 64, 0.5 + (i % 2) / 4) for i in range(65)] + [(1.0, 2.0), (0.0, 2.0)]


def cell_sizes(index):
    size = "aggregate(candidates, 0, (n, c) -> n + size(c.edges) + size(c.flips))"
    return {(r["level"], r["cx"], r["cy"]): r["n"] for r in index.cells.selectExpr("level", "cx", "cy", f"{size} as n").collect()}


@pytest.mark.parametrize("max_broadcast_bytes", [10**8, 0])
def test_crowded_cells_are_cut_up(spark, monkeypatch, max_broadcast_bytes):
    comb = {("Comb", "C"): [TEETH]}
    table = spark.createDataFrame(region_rows(comb), REGION)
    index = region_index(table, max_broadcast_bytes=max_broadcast_bytes, max_cell_entries=20)
    assert index.levels >= 2 and max(cell_sizes(index).values()) <= 20
    locations = [f"{0.5 + y / 37},{x / 41}" for x in range(42) for y in range(12)]
    locations += [f"{0.5 + y / 64},{x / 256}" for x in range(0, 257, 3) for y in range(18)]
    expected = [brute_force(comb, location) for location in locations]
    assert len(set(expected)) == 2
    assert lookup(spark, index, locations) == expected
    monkeypatch.setattr("moodlens.operators.regions.FINEST_LEVEL", 1)
    crowded = region_index(table, max_cell_entries=0)
    assert crowded.levels == 1
    assert lookup(spark, crowded, locations) == expected


def test_a_dense_spot_costs_cells_there_alone(spark):
    """A city of very many edges is cut up below its own cell; the cells elsewhere stay as they are."""
    country = {("Land", "L"): [[(-20.5, -20.5), (20.5, -20.5), (20.5, 20.5), (-20.5, 20.5)]]}
    before = cell_sizes(region_index(spark.createDataFrame(region_rows(country), REGION), max_cell_entries=500))
    i = F.col("id")
    border = spark.range(100_000).select(
        F.lit(5).cast("bigint").alias("ordinal"), F.lit("City").alias("region_name"), F.lit("C").alias("region_code"),
        F.lit(0).alias("ring_id"), i.cast("int").alias("seq"),
        (3.5 + 0.25 * F.cos(i * 2 * math.pi / 100_000) * (1 + i % 2 / 100)).alias("lon"),
        (4.5 + 0.25 * F.sin(i * 2 * math.pi / 100_000) * (1 + i % 2 / 100)).alias("lat"),
    )
    table = spark.createDataFrame(region_rows(country), REGION).unionByName(border)
    index = region_index(table, max_cell_entries=500)
    after = cell_sizes(index)
    assert max(after.values()) <= 500 and index.levels >= 4
    elsewhere = lambda cells: {c: n for c, n in cells.items() if c[0] == 0 and c[1:] != (3, 4)}
    assert elsewhere(after) == elsewhere(before)
    assert all((cx >> level, cy >> level) == (3, 4) for level, cx, cy in after if level)
    names = lookup(spark, region_index(table.where("ordinal = 5"), max_cell_entries=500), ["4.5,3.5", "4.5,3.2", "4.5,3.9", "4.74,3.5", "4.7,3.7"])
    assert names == ["City", "Unknown", "Unknown", "City", "Unknown"]


@pytest.mark.parametrize("turned", [False, True])
def test_long_edges_side_by_side_are_not_repeated(spark, turned):
    """Each edge of this border crosses half a degree while hundreds of them lie side by side, so cuts along the edges only repeat them."""
    sizes = []
    for n in (400, 1600):
        ring = [(0.125 + 0.75 * k / n, 0.25 + k * 37 % 64 / 128) for k in range(n)] + [(0.9, 0.1), (0.1, 0.1)]
        comb = {("Comb", "C"): [[(y, x) if turned else (x, y) for x, y in ring]]}
        index = region_index(spark.createDataFrame(region_rows(comb), REGION), max_cell_entries=16)
        locations = [f"{i / 97},{k / 89}" for i in range(3, 97, 12) for k in range(5, 89, 9)]
        assert lookup(spark, index, locations) == [brute_force(comb, location) for location in locations]
        assert max(cell_sizes(index).values()) <= 16
        sizes.append(index.entries)
    assert sizes[0] < 8 * 400 and sizes[1] < 6 * sizes[0]


def test_cut_index_reads_back(spark, tmp_path):
    table = spark.createDataFrame(region_rows({("Comb", "C"): [TEETH]}), REGION)
    index = region_index(table, max_cell_entries=10)
    write_index(index, str(tmp_path / "index"))
    again = read_index(spark, str(tmp_path / "index"))
    assert (again.levels, again.entries, again.bytes) == (index.levels, index.entries, index.bytes) and index.levels
    locations = [f"{0.5 + y / 37},{x / 41}" for x in range(42) for y in range(12)]
    assert lookup(spark, again, locations) == lookup(spark, index, locations)


def test_columns_named_like_those_of_the_index_stay(spark):
    index = region_index(spark.createDataFrame(region_rows(REGIONS), REGION))
    df = spark.createDataFrame([("0.5,0.5", 7, 8, "old")], "location string, level int, cx int, region_name string")
    assert assign_region(df, index).select("level", "cx", "region_name").collect() == [(7, 8, "Holed")]


def test_rings_across_the_180th_meridian(spark):
    """Such rings equal the same rings drawn in degrees that run on, at every place on both sides."""
    wrap = lambda x: x - 360 if x > 180 else x + 360 if x < -180 else x
    through = {
        ("East", "E"): [[(170.5, 1.5), (185.0, -3.0), (192.5, 8.0), (178.0, 12.5)], [(179.0, 2.0), (182.0, 2.0), (182.0, 4.0), (179.0, 4.0)]],
        ("Far", "F"): [[(-186.5, 20.0), (-170.0, 20.0), (-175.5, 31.0)]],
        ("Plain", "P"): [[(100.0, 0.0), (120.0, 0.0), (120.0, 10.0)]],
        ("Pole", "O"): [[(-120.0, 70.0), (0.0, 70.0), (120.0, 70.0)]],
    }
    short = {key: [[(wrap(x), y) for x, y in ring] for ring in rings] for key, rings in through.items()}
    both = {
        key: rings if key[0] in ("Plain", "Pole") else [[(x + move, y) for x, y in ring] for ring in rings for move in (0, 360, -360)]
        for key, rings in through.items()
    }
    index = region_index(across_antimeridian(spark.createDataFrame(region_rows(short), REGION)))
    locations = [f"{y + 0.25},{x + 0.25}" for y in range(-5, 36, 2) for x in [*range(-180, -160), *range(95, 125, 5), *range(165, 180)]]
    expected = [brute_force(both, location) for location in locations]
    assert set(expected) == {"East", "Far", "Plain", "Unknown"}
    assert lookup(spark, index, locations) == expected


def test_wide_ring_has_few_flips(spark):
    """Flips are kept as spans: their number follows the edges, not the cells between them and the western border."""
    steps = 250
    top = [(-60 + 120 * i / steps, 10.0 + (i % 2) / 3) for i in range(steps + 1)]
    wide = {("Wide", "W"): [top + [(60.0, 0.0), (-60.0, 0.0)]]}
    entries = _entries(spark.createDataFrame(region_rows(wide), REGION), 4)
    edges, flips = entries.where("edge is not null").count(), entries.where("flip is not null").count()
    assert flips <= 12 * edges


def test_kept_index_reads_back(spark, tmp_path):
    index = region_index(spark.createDataFrame(region_rows(REGIONS), REGION))
    write_index(index, str(tmp_path / "index"))
    again = read_index(spark, str(tmp_path / "index"))
    assert (again.cells_per_degree, again.entries, again.fits_broadcast) == (index.cells_per_degree, index.entries, True)
    locations = [f"{y / 3},{x / 3}" for x in range(-9, 60) for y in range(-9, 60)]
    assert lookup(spark, again, locations) == lookup(spark, index, locations)


def test_region_order_follows_the_file_names(spark, tmp_path):
    """A feature of the first file wins an overlap, though Spark reads the larger file first."""

    def feature(name, pad):
        ring = [[0, 0], [0, 10], [10, 10], [10, 0], [0, 0]]
        return json.dumps({"type": "Feature", "properties": {"State_Name": name, "State_Code": name, "pad": "x" * pad}, "geometry": {"type": "Polygon", "coordinates": [ring]}})

    (tmp_path / "a.json").write_text(feature("A", 0) + "\n" + feature("C", 0))
    (tmp_path / "b.json").write_text(feature("B", 5000))
    loaded = load_regions(spark, str(tmp_path), "geojson")
    names = [r[0] for r in loaded.groupBy("ordinal").agg(F.first("region_name")).orderBy("ordinal").select(F.col("first(region_name)")).collect()]
    assert names == ["A", "C", "B"]
    assert lookup(spark, region_index(loaded), ["5,5"]) == ["A"]


def test_small_index_needs_no_shuffle_of_the_tweets(spark):
    index = region_index(spark.createDataFrame(region_rows(REGIONS), REGION))
    df = spark.range(10).select(F.concat_ws(",", "id", "id").alias("location"))
    plan = assign_region(df, index)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Python" not in plan


def test_lookup_keeps_rows_and_columns(spark):
    index = region_index(spark.createDataFrame(region_rows(REGIONS), REGION))
    df = spark.createDataFrame([("a", "0.5,0.5"), ("b", "0.5,0.5"), ("c", None)], "tweet_id string, location string")
    located = assign_region(df, index)
    assert located.columns == ["tweet_id", "location", "lat", "lon", "region_name", "region_code"]
    assert sorted(map(tuple, located.select("tweet_id", "lat", "region_code").collect())) == [
        ("a", 0.5, "HO"), ("b", 0.5, "HO"), ("c", None, "Unknown"),
    ]


def test_geojson(spark, tmp_path):
    lines = [
        '{"type":"Feature","properties":{"State_Name":"One","State_Code":"O"},"geometry":'
        '{"type":"Polygon","coordinates":[[[0,0],[4,0],[4,4],[0,4],[0,0]],[[1,1],[2,1],[2,2],[1,2],[1,1]]]}}',
        '{"type":"Feature","properties":{"State_Name":"Two","State_Code":"T"},"geometry":'
        '{"type":"MultiPolygon","coordinates":[[[[3,3],[9,3],[9,9],[3,3]]],[[[-5,-5],[-4,-5],[-4,-4],[-5,-5]]]]}}',
    ]
    (tmp_path / "regions.json").write_text("\n".join(lines))
    regions = load_regions(spark, str(tmp_path / "regions.json"), "geojson")
    assert regions.count() == 5 + 5 + 4 + 4
    found = lookup(spark, region_index(regions), ["0.5,0.5", "1.5,1.5", "3.6,3.9", "-4.8,-4.2", "8,8.5"])
    assert found == ["One", "Unknown", "One", "Two", "Two"]
    assert regions_from_geojson(spark.read.text(str(tmp_path))).columns == [field.name for field in REGION]


def test_region_table(spark, tmp_path):
    table = spark.createDataFrame(region_rows(REGIONS), REGION)
    table.write.parquet(str(tmp_path / "regions"))
    assert load_regions(spark, str(tmp_path / "regions")).count() == table.count()
