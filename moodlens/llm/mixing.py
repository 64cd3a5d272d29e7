"""Mixing sources to target weights by entropy balancing."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodlens.llm.shared import global_rank, join_hot, ranked, row_key, rows_with, running, word_count
from moodlens.session import checkpointed

#: No document is taken more often than this.
MAX_COPIES = 3
#: Newton steps at most, and the relative error at which they end.
MAX_STEPS, TOLERANCE = 40, 1e-5


def source_targets(sizes: DataFrame, weight: Column) -> DataFrame:
    """Targets of the sources of ``sizes`` (source, source_size, place): their share by ``weight`` of all sizes.

    A target stops at ``MAX_COPIES`` times the size of its source; what is above is shared again by weight among the rest. The sources
    that stop come first by limit per weight, so running sums over that order give the level at which the others share.
    """
    size, limit = F.col("source_size").cast("double"), MAX_COPIES * F.col("source_size").cast("double")
    rows = sizes.withColumns({"_w": weight.cast("double"), "_c": limit})
    total, weights = rows.agg(F.sum(size), F.sum("_w")).first()
    by_limit = F.col("_c") / F.col("_w")
    levels = running(rows, [by_limit.asc(), F.col("place").asc()], {"_limits": F.col("_c"), "_weights": F.col("_w")})
    # what the sources before leave, by weight among this one and those after
    left = F.lit(total) - F.col("_limits") + F.col("_c")
    levels = levels.withColumn("_level", left / (F.lit(weights) - F.col("_weights") + F.col("_w")))
    levels = checkpointed(levels.withColumn("_stops", F.col("_level") * F.col("_w") > F.col("_c")))
    # the first source that does not stop sets the level of all that follow
    first = levels.filter(~F.col("_stops")).agg(F.min(F.struct(by_limit, F.col("place"), F.col("_level").alias("level"))).alias("first")).first()["first"]
    shared = F.lit(first["level"] if first else None).cast("double")
    target = F.when(F.col("_stops"), F.col("_c")).otherwise(F.least(F.col("_c"), shared * F.col("_w")))
    return levels.withColumn("target", target).drop("_w", "_c", "_level", "_stops", "_limits", "_weights")


def _rate(tilt: Column, z: Column) -> Column:
    """Copies of a document of relative size ``z``: exponentially tilted, at most ``MAX_COPIES``."""
    return F.when(tilt * z >= math.log(MAX_COPIES), F.lit(float(MAX_COPIES))).otherwise(F.exp(tilt * z))


def solve_tilts(groups: DataFrame, targets: DataFrame) -> DataFrame:
    """The tilt of every source, by Newton steps on the convex dual.

    ``groups`` counts documents by (place, size). Document rates minimise the entropy relative to one copy each, subject to the tokens
    of the source; the dual has one variable a source, and its gradient and curvature are sums over ``groups``, taken by Spark in every
    step. A step outside the bracket of the root is replaced by its middle. State is a row per source, kept in the shared folder.
    """
    scale = groups.groupBy("place").agg((F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("mean"))
    state = targets.select("place", "source_size", "target").join(scale, "place")
    ratio = F.col("target") / F.col("source_size")
    state = state.withColumn("full", ratio >= MAX_COPIES * (1 - 1e-12)).withColumn("tilt", F.lit(0.0)).withColumn("low", F.lit(-1e6)).withColumn("high", F.lit(1e6))
    state = checkpointed(state)
    for _ in range(MAX_STEPS):
        z = F.col("size") / F.col("mean")
        rate = _rate(F.col("tilt"), z)
        tokens = F.col("n") * F.col("size") * rate
        bend = F.when(rate < MAX_COPIES, tokens * z).otherwise(F.lit(0.0))
        sums = groups.join(state, "place").groupBy("place").agg(F.sum(tokens).alias("now"), F.sum(bend).alias("bend"))
        gap = F.col("now") - F.col("target")
        low = F.when(gap < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("tilt")).otherwise(F.col("high"))
        # Newton on the logarithm of the tokens, which is nearly straight
        step = F.col("tilt") - F.log(F.col("now") / F.col("target")) * F.col("now") / F.col("bend")
        moved = state.join(sums, "place").select("place", "source_size", "target", "mean", "full", "tilt", "now", "bend", low.alias("low"), high.alias("high"), gap.alias("gap"))
        inside = F.col("bend").isNotNull() & (F.col("bend") > 0) & (step > F.col("low")) & (step < F.col("high"))
        middle = F.when((F.col("low") > -1e6) & (F.col("high") < 1e6), (F.col("low") + F.col("high")) / 2).when(F.col("gap") < 0, 2 * F.col("tilt") + 1).otherwise(2 * F.col("tilt") - 1)
        settled = F.col("full") | (F.abs(F.col("gap")) <= TOLERANCE * F.col("target"))
        moved = moved.select("place", "source_size", "target", "mean", "full", F.when(settled, F.col("tilt")).when(inside, step).otherwise(middle).alias("tilt"), "low", "high", settled.alias("settled"))
        moved = checkpointed(moved)
        state = moved.drop("settled")
        if moved.filter(~F.col("settled")).isEmpty():
            break
    return state


def _round_sizes(rows: pd.DataFrame) -> pd.DataFrame:
    """Whole copies for the sizes of one source: what rounding loses or adds at one size is carried to the next smaller one."""
    rows = rows.sort_values("size", ascending=False)
    owed, copies = 0.0, []
    for size, n, rate in zip(rows["size"], rows["n"], rows["rate"]):
        wanted = n * rate * size + owed
        got = min(MAX_COPIES * n, max(0, math.floor(wanted / size + 0.5)))
        owed = wanted - got * size
        copies.append(got)
    return rows.assign(copies=copies)[["place", "size", "n", "copies"]]


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, copies, taken.

    Size is the number of words. Sources, by code point and null last, weigh ``weights`` in turn. Documents of one source and size have
    the same tilted rate, so rates are solved and rounded on counts by source and size; within such a group the extra copies go by
    lots drawn from the ids, and from the place in the table for null ids. A null or empty text has size 0 and is never taken. Repeated
    rows count as rows of their own. Other columns are ignored; an empty table gives no rows.
    """
    return _mixed(docs, weights, keyed=False).drop("_key")


def _mixed(docs: DataFrame, weights: tuple[int, ...], keyed: bool) -> DataFrame:
    """``mix`` with the ``row_key`` of id, source and text as ``_key``, if asked for."""
    key = row_key(docs, "source") if keyed else F.lit(None).cast("string")
    sized = checkpointed(docs.select(F.col("doc_id"), "source", word_count(docs["text"]).alias("size"), key.alias("_key")))
    sources = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    places = global_rank(sources, [F.col("source").asc_nulls_last()], "place").withColumn("place", F.col("place") - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("place"), F.lit(len(weights))) + 1).cast("int"))
    targets = checkpointed(source_targets(places, weight))

    counted = sized.groupBy("source", "size").agg(F.count("*").alias("n"))
    known = targets.select(F.col("source").alias("_source"), "place", "source_size", "target")
    groups = counted.join(known, counted["source"].eqNullSafe(known["_source"])).select("place", "source", "source_size", "target", "size", "n")
    groups = checkpointed(groups)
    dealt = groups.filter((F.col("size") > 0) & (F.col("target") > 0)).select("place", "size", "n")
    tilts = solve_tilts(dealt, targets.filter("target > 0"))
    rate = F.when(F.col("full"), F.lit(float(MAX_COPIES))).otherwise(_rate(F.col("tilt"), F.col("size") / F.col("mean")))
    rated = dealt.join(tilts.select("place", "tilt", "mean", "full"), "place").select("place", "size", "n", rate.alias("rate"))
    rounded = rated.groupBy("place").applyInPandas(_round_sizes, "place long, size long, n long, copies long")
    plan = groups.join(rounded.select("place", "size", "copies"), ["place", "size"], "left")
    plan = plan.select(F.col("source").alias("_source"), F.col("size").alias("_size"), "place", "source_size", "target", F.coalesce("copies", F.lit(0)).cast("long").alias("all_copies"), "n")
    return _deal(sized, checkpointed(plan))


def _deal(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """Give every row its copies: all rows of a group the same whole number, and one more to those first by lot."""

    def named(source: Column, size: Column) -> Column:
        return F.concat(F.when(source.isNull(), F.lit("0")).otherwise(F.lit("1")), size.cast("string"), F.lit(" "), F.coalesce(source, F.lit("")))

    # the sizes are written, so the number of a row in them is the same for every task that asks
    rows = sized.withColumn("_group", named(F.col("source"), F.col("size"))).withColumn("_at", F.monotonically_increasing_id())
    lot = F.when(F.col("doc_id").isNull(), F.xxhash64("_at")).otherwise(F.xxhash64("doc_id"))
    placed = ranked(rows, ["_group"], ["doc_id", "_at"], "_rank", rows.count(), lot=lot)
    plan = plan.select(named(F.col("_source"), F.col("_size")).alias("_group"), "source_size", "target", "all_copies", "n")
    dealt = join_hot(placed, plan, ["_group"], "n", "_at")
    base = F.floor(F.col("all_copies") / F.col("n"))
    copies = (base + (F.col("_rank") < F.col("all_copies") - base * F.col("n")).cast("long")).cast("long")
    return dealt.select("doc_id", "_key", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mix_documents(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """``docs`` with every row as often as the mix takes it, columns unchanged.

    Rows that share id, source and text are copies, so what the mix takes of them is dealt evenly among them, null ids included.
    """
    taken = _mixed(docs, weights, keyed=True).groupBy("_key").agg(F.sum("copies").alias("_copies"), F.count("*").alias("_n"))
    found = rows_with(docs, checkpointed(taken.filter("_copies > 0")), "source")
    single = found.filter("_n = 1").select("_row", "_copies")
    # copies are numbered only once they are written, so that a task that runs again numbers them alike
    twins = checkpointed(found.filter("_n > 1").withColumn("_at", F.monotonically_increasing_id()))
    numbered = ranked(twins, ["_key"], ["_at"], "_rank", twins.count())
    base = F.floor(F.col("_copies") / F.col("_n"))
    shared = numbered.select("_row", (base + (F.col("_rank") < F.col("_copies") - base * F.col("_n")).cast("long")).alias("_copies"))
    all_rows = single.union(shared.filter("_copies > 0"))
    return all_rows.select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select("_row.*")
