"""Which region a location lies in.

A region is a set of rings, counted even-odd, so holes and several parts need no special care. Points on an edge are
outside. Where regions overlap, the lowest ordinal wins.

The globe is cut into grid cells, and a location meets the regions of its cell in one equi-join. A ray from the location
towards the east tells inside from outside by the parity of its crossings. A cell keeps the edges that come near it. Of
the edges further east only their latitudes matter, where each end flips the parity; flips at the same latitude cancel in
pairs, which leaves next to nothing. A cell that no edge comes near has no edges to test at all.

A crowded cell is cut into four, and those again, until none is crowded: a quadtree below each cell of the grid. Where many
edges cross the line that would part the rows, and few the one that parts the columns, a cell is cut into two columns alone, or
the other way round, so long edges side by side are dealt to cells without being repeated. What a child needs follows from its
parent's entries, so a dense city costs cells there and nowhere else. A location goes down the tree through the list of the
cells that were cut, which is short, and meets one cell.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from moodlens.functions.location import latitude, longitude
from moodlens.session import checkpointed, salted_join

UNKNOWN = "Unknown"
EDGE = "struct<x1:double,y1:double,x2:double,y2:double>"

#: An index that takes more bytes than this is shuffled instead of being broadcast.
MAX_BROADCAST_BYTES = 64 << 20
#: A cell with more entries than this is cut up, at most so many times; the finest cells are some 10 cm wide.
MAX_CELL_ENTRIES = 512
FINEST_LEVEL = 20
# what an edge, a flip and the rest of a candidate take
_EDGE_BYTES, _FLIP_BYTES, _CANDIDATE_BYTES = 48, 8, 64
# a line that more than one in so many of a cell's near edges cross is no place for a cut
_CROSSED_SHARE = 4
# how a cell was cut: columns and rows of its level that it spans, and what its children have half of
_CUT = ("wide", "tall", "columns", "rows")
# columns of a kept index besides the cells
_ABOUT = ("cells_per_degree", "levels", "entries", "bytes")


@dataclass(frozen=True)
class RegionIndex:
    """The cells that are not cut up, with the regions that reach into them, and the list of those that are.

    ``cells`` has a row per level, column and row of a cell, whose candidates are regions by ordinal, each with the near edges and the
    flips of the far ones. Level 0 has ``cells_per_degree`` cells a degree, each further level twice as many. A cell that was cut in one
    direction alone leaves children that span several columns or rows of their level and go by the first of them. ``cuts`` names the cells
    that were cut, on ``levels`` levels, how many columns and rows they span, and in which directions they were cut.
    """

    cells_per_degree: int
    cells: DataFrame
    cuts: DataFrame
    levels: int
    entries: int
    bytes: int
    fits_broadcast: bool


def _edges(regions: DataFrame) -> DataFrame:
    ring = Window.partitionBy("ordinal", "ring_id").orderBy("seq")
    start = ring.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def following(name: str) -> Column:
        # the last vertex connects to the first, which closes an open ring
        return F.coalesce(F.lead(name).over(ring), F.first(name).over(start))

    return regions.select(
        "ordinal",
        F.col("lon").alias("x1"),
        F.col("lat").alias("y1"),
        following("lon").alias("x2"),
        following("lat").alias("y2"),
    ).where("x1 <> x2 or y1 <> y2")


def _side(edge: Column, lon: Column, lat: Column) -> Column:
    """Positive when the point lies left of the edge seen along its direction, 0 on its line."""
    x1, y1, x2, y2 = (edge[name] for name in ("x1", "y1", "x2", "y2"))
    return (x2 - x1) * (lat - y1) - (lon - x1) * (y2 - y1)


def _crosses(edge: Column, lon: Column, lat: Column) -> Column:
    """Whether a ray from the point towards the east crosses the edge."""
    straddles = (edge["y1"] > lat) != (edge["y2"] > lat)
    return straddles & ((edge["y2"] > edge["y1"]) == (_side(edge, lon, lat) > 0))


def _touches(edge: Column, lon: Column, lat: Column) -> Column:
    """Whether the point lies on the edge."""
    return (
        lon.between(F.least(edge["x1"], edge["x2"]), F.greatest(edge["x1"], edge["x2"]))
        & lat.between(F.least(edge["y1"], edge["y2"]), F.greatest(edge["y1"], edge["y2"]))
        & (_side(edge, lon, lat) == 0)
    )


def _inside(edges: Column, flips: Column, lon: Column, lat: Column) -> Column:
    far = F.size(F.filter(flips, lambda flip: flip <= lat))
    crossings = F.aggregate(edges, far, lambda n, edge: n + F.when(_crosses(edge, lon, lat), 1).otherwise(0))
    return (crossings % 2 == 1) & ~F.exists(edges, lambda edge: _touches(edge, lon, lat))


def _cell(degrees: Column, cells_per_degree: int) -> Column:
    return F.floor(degrees * cells_per_degree)


def _odd_spans(west: Column, firsts: Column) -> Column:
    """The spans of cells that an odd number of flips at one latitude concern.

    A flip concerns the cells from ``west`` up to the one before its edge. With the edges from the east to the west, their number
    is odd after the first, even after the second, and so on, so every other gap between neighbours is a span.
    """
    gaps = F.transform(
        firsts,
        lambda first, k: F.struct(F.coalesce(F.get(firsts, k + 1), west).alias("from"), (first - 1).alias("to"), (k % 2).alias("even")),
    )
    return F.filter(gaps, lambda gap: (gap["even"] == 0) & (gap["from"] <= gap["to"]))


def _entries(regions: DataFrame, n: int) -> DataFrame:
    """Per cell and region a row for each near edge and for each flip."""
    wests = regions.groupBy("ordinal").agg(
        F.min("region_name").alias("region_name"),
        F.min("region_code").alias("region_code"),
        _cell(F.min("lon"), n).alias("west"),
    )
    # a ray towards the east meets edges of its own row of cells that do not end west of the point's cell
    rows = _edges(regions).select(
        "*",
        _cell(F.least("x1", "x2"), n).alias("first"),
        _cell(F.greatest("x1", "x2"), n).alias("last"),
        F.explode(F.sequence(_cell(F.least("y1", "y2"), n), _cell(F.greatest("y1", "y2"), n))).alias("cy"),
    )
    region = ["ordinal", "region_name", "region_code"]
    near = (
        rows.select("*", F.explode(F.sequence("first", "last")).alias("cx"))
        .join(wests, "ordinal")
        .select("cx", "cy", *region, F.struct("x1", "y1", "x2", "y2").alias("edge"), F.lit(None).cast("double").alias("flip"))
    )
    # a flip below the row of cells counts for all of it, one above for none
    ends = F.array(*[F.greatest(F.col(y), F.col("cy") / n) for y in ("y1", "y2")])
    flips = (
        rows.select("ordinal", "cy", "first", F.explode(ends).alias("flip"))
        .where(F.col("flip") < (F.col("cy") + 1) / n)
        .join(wests, "ordinal")
        .where("west < first")
        .groupBy(*region, "cy", "flip")
        .agg(F.min("west").alias("west"), F.sort_array(F.collect_list("first"), asc=False).alias("firsts"))
        .select(*region, "cy", "flip", F.explode(_odd_spans(F.col("west"), F.col("firsts"))).alias("span"))
        .select(F.explode(F.sequence("span.from", "span.to")).alias("cx"), "cy", *region, F.lit(None).cast(EDGE).alias("edge"), "flip")
    )
    return near.unionByName(flips)


def _crowded(entries: DataFrame, n: int, max_cell_entries: int) -> DataFrame:
    """The cells with more than ``max_cell_entries`` entries, and how to cut them; their children have ``n`` cells a degree."""

    def crosses(a: str, b: str, first: str, span: str) -> Column:
        middle = F.col(first) * 2 + F.col(span)
        return F.count_if((_cell(F.least(a, b), n) < middle) & (_cell(F.greatest(a, b), n) >= middle)) * _CROSSED_SHARE > F.count("edge")

    across_columns, across_rows = crosses("edge.x1", "edge.x2", "cx", "wide"), crosses("edge.y1", "edge.y2", "cy", "tall")
    return (
        entries.groupBy("cx", "cy", "wide", "tall")
        .agg(F.count(F.lit(1)).alias("n"), across_columns.alias("across_columns"), across_rows.alias("across_rows"))
        .where(F.col("n") > max_cell_entries)
        .select("cx", "cy", "wide", "tall", F.expr("not across_columns or across_rows").alias("columns"), F.expr("not across_rows or across_columns").alias("rows"))
    )


def _children(entries: DataFrame, crowded: DataFrame, n: int) -> DataFrame:
    """Entries of the children of each crowded cell, from the cell's own; the children have ``n`` cells a degree.

    An edge of the parent stays near the children it comes near; for the children west of it in the same rows only its flips are left.
    Flips of the parent hold for all of it, so a child takes those below its top, none of them lower than its bottom.
    """

    def halves(first: str, span: str, cut: str) -> Column:
        begins = F.col(first) * 2
        whole = F.array(F.struct(begins.alias(first), (F.col(span) * 2).alias(span)))
        return F.explode(F.when(F.col(cut), F.array(*[F.struct((begins + k * F.col(span)).alias(first), F.col(span)) for k in (0, 1)])).otherwise(whole))

    cell, region = ["cx", "cy", "wide", "tall"], ["ordinal", "region_name", "region_code"]
    dealt = entries.join(F.broadcast(crowded), cell).withColumn("_x", halves("cx", "wide", "columns")).withColumn("_y", halves("cy", "tall", "rows"))
    dealt = dealt.select("_x.*", "_y.*", *region, "edge", "flip").withColumns({"bottom": F.col("cy") / n, "top": (F.col("cy") + F.col("tall")) / n})
    first, last = (_cell(side("edge.x1", "edge.x2"), n) for side in (F.least, F.greatest))
    low, high = (_cell(side("edge.y1", "edge.y2"), n) for side in (F.least, F.greatest))
    rows, beyond = (low < F.col("cy") + F.col("tall")) & (high >= F.col("cy")), F.col("cx") + F.col("wide")
    near = dealt.where(rows & (first < beyond) & (last >= F.col("cx"))).select(*cell, *region, "edge", F.lit(None).cast("double").alias("flip"))
    ends = F.when(F.col("flip").isNotNull(), F.array("flip")).when(rows & (first >= beyond), F.array("edge.y1", "edge.y2"))
    flips = (
        dealt.select(*cell, "bottom", "top", *region, F.explode(ends).alias("end"))
        .where("end < top")
        .groupBy(*cell, *region, F.greatest("end", "bottom").alias("flip"))
        .count()
        .where("count % 2 = 1")
        .select(*cell, *region, F.lit(None).cast(EDGE).alias("edge"), "flip")
    )
    return near.unionByName(flips)


def region_index(
    regions: DataFrame,
    cells_per_degree: int = 1,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    max_cell_entries: int = MAX_CELL_ENTRIES,
) -> RegionIndex:
    """Index a region table. ``cells_per_degree`` is a power of two, so that cell borders are exact.

    The entries of a level are computed into the shared folder and counted by cell. Those of crowded cells go on to the next level,
    the others are settled. Only edges that meet at one spot can still crowd a cell of the finest level; they are kept there. The cells
    are computed once and kept too, so the micro-batches of a stream read them as they are.
    """
    n = cells_per_degree
    if n < 1 or n & (n - 1):
        raise ValueError("cells_per_degree must be a power of two")
    entries = checkpointed(_entries(regions, n).withColumns({span: F.lit(1).cast("bigint") for span in ("wide", "tall")}))
    settled, cuts, level = [], [], 0
    while level < FINEST_LEVEL:
        # a crowded cell holds more than max_cell_entries entries, so there are few
        crowded = checkpointed(_crowded(entries, n << level + 1, max_cell_entries))
        if crowded.isEmpty():
            break
        settled.append(entries.join(F.broadcast(crowded), ["cx", "cy"], "left_anti").select(F.lit(level).alias("level"), "*"))
        cuts.append(crowded.select(F.lit(level).alias("level"), "cx", "cy", *_CUT))
        level += 1
        entries = checkpointed(_children(entries, crowded, n << level))
    settled.append(entries.select(F.lit(level).alias("level"), "*"))
    candidates = (
        reduce(DataFrame.unionByName, settled)
        .groupBy("level", "cx", "cy", "ordinal", "region_name", "region_code")
        .agg(F.collect_list("edge").alias("edges"), F.collect_list("flip").alias("flips"))
    )
    cells = checkpointed(
        candidates.groupBy("level", "cx", "cy").agg(
            F.sort_array(F.collect_list(F.struct("ordinal", "region_name", "region_code", "edges", "flips"))).alias("candidates")
        )
    )
    region = F.explode("candidates").alias("c")
    edges, flips = F.size("c.edges"), F.size("c.flips")
    names = F.octet_length(F.coalesce("c.region_name", F.lit(""))) + F.octet_length(F.coalesce("c.region_code", F.lit("")))
    total, size = (
        cells.select(region)
        .agg(
            F.coalesce(F.sum(edges + flips), F.lit(0)),
            F.coalesce(F.sum(edges * _EDGE_BYTES + flips * _FLIP_BYTES + names + _CANDIDATE_BYTES), F.lit(0)),
        )
        .first()
    )
    none = _crowded(entries.limit(0), n, 0).select(F.lit(0).alias("level"), "cx", "cy", *_CUT)
    return RegionIndex(n, cells, checkpointed(reduce(DataFrame.unionByName, cuts)) if cuts else none, level, total, size, size <= max_broadcast_bytes)


def write_index(index: RegionIndex, path: str, mode: str = "errorifexists") -> None:
    """Keep an index as a table, for ``read_index``; the cells that were cut are rows without candidates."""
    about = {name: F.lit(getattr(index, name)) for name in _ABOUT}
    rows = index.cells.unionByName(index.cuts, allowMissingColumns=True)
    rows.withColumns(about).write.mode(mode).parquet(path)


def read_index(spark: SparkSession, path: str, max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> RegionIndex:
    """An index that ``write_index`` has kept; nothing is computed again."""
    kept = spark.read.parquet(path)
    n, levels, entries, size = kept.select(*_ABOUT).first() or (1, 0, 0, 0)
    rows = kept.drop(*_ABOUT)
    cells, cuts = rows.where("candidates is not null").drop(*_CUT), rows.where("candidates is null").drop("candidates")
    return RegionIndex(n, cells, cuts, levels, entries, size, size <= max_broadcast_bytes)


def _in_cell(located: DataFrame, index: RegionIndex) -> DataFrame:
    """Add level, column and row of the cell that is not cut up and holds the location, as ``_level``, ``_cx`` and ``_cy``."""
    n = index.cells_per_degree
    placed = located.withColumns({"_level": F.lit(0), "_cx": _cell(F.col("lon"), n), "_cy": _cell(F.col("lat"), n)})
    known = F.broadcast(_as_key(index.cuts).withColumnsRenamed({name: f"_{name}" for name in _CUT}).withColumn("_cut", F.lit(True)))
    for level in range(1, index.levels + 1):
        # both spans and what is cut are the parent's, so a half begins at its first column or row or one span later
        down = {}
        for name, degrees, span, halved in (("_cx", "lon", "_wide", "_columns"), ("_cy", "lat", "_tall", "_rows")):
            begins = F.col(name) * 2
            later = F.col(halved) & (_cell(F.col(degrees), n << level) >= begins + F.col(span))
            down[name] = F.when(F.col("_cut"), F.when(later, begins + F.col(span)).otherwise(begins)).otherwise(F.col(name))
        down["_level"] = F.when(F.col("_cut"), F.lit(level)).otherwise(F.col("_level"))
        placed = placed.join(known, _KEY, "left").withColumns(down).drop("_cut", *[f"_{name}" for name in _CUT])
    return placed


_KEY = ["_level", "_cx", "_cy"]


def _as_key(cells: DataFrame) -> DataFrame:
    return cells.withColumnsRenamed({"level": "_level", "cx": "_cx", "cy": "_cy"})


def assign_region(df: DataFrame, index: RegionIndex, location: str = "location") -> DataFrame:
    """Add ``lat``, ``lon``, ``region_name`` and ``region_code``; ``Unknown`` for a location in no region or unreadable.

    With a small index this is a map-side join without any shuffle, for batches and streams alike. A larger one is
    joined by cell, every cell spread over salted partitions, as one city may hold a third of all rows; unreadable locations are
    spread over all of them. The list of cut cells is broadcast in either case: each of them held more than the bound of a cell.
    """
    located = _in_cell(df.withColumns({"lat": latitude(location), "lon": longitude(location)}), index)
    if index.fits_broadcast:
        joined = located.join(F.broadcast(_as_key(index.cells)), _KEY, "left")
    else:
        joined = salted_join(located, _as_key(index.cells), _KEY, how="left")
    added = ("lat", "lon", "region_name", "region_code")
    hits = F.filter(
        "candidates",
        lambda region: _inside(region["edges"], region["flips"], F.col("lon"), F.col("lat")),
    )
    return (
        joined.withColumn("_region", F.get(hits, F.lit(0)))
        .withColumns(
            {
                "region_name": F.coalesce("_region.region_name", F.lit(UNKNOWN)),
                "region_code": F.coalesce("_region.region_code", F.lit(UNKNOWN)),
            }
        )
        .drop(*_KEY, "candidates", "_region")
        .select(*[name for name in df.columns if name not in added], *added)
    )
