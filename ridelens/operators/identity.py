"""Station identity: one canonical id and name for every chain of conflicting
names and ids (J6, J7, A17, A18).

The audits list conflicts pair by pair, and one rewrite by name or by id cannot
settle a chain (name A has ids 1 and 2, id 2 is shared with name B, and so on).
Here names and ids are the two sides of a graph whose edges are the pairs seen
on a trip; a station is a connected component of it, and takes the id and the
name that most of its trips have.

Scale: the graph has one edge per distinct (name, id) pair, counted over both
sides of the trips in one scan with partial aggregation. Components come from
minimum labels with hooking and shortcutting, a few rounds even for a long
chain; a round is two joins and one aggregate over the graph, written to the
shared folder, so that each join's small side is a scan with one row per vertex
and a hub (an id that very many names share) is split by adaptive execution.
Nothing but the number of changed labels reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelens.operators._plan import written_map
from ridelens.operators.conform import arg_max
from ridelens.operators.predicates import exclude_like

SIDES = ("start", "end")


def station_pairs(trips: DataFrame, sides: Sequence[str] = SIDES) -> DataFrame:
    """name, id and n_trips of every pair on the given sides. A pair without a
    name (NULL or blank) or without an id links nothing and is left out."""
    stops = F.array(*(F.struct(F.col(f"{s}_station_name").alias("name"), F.col(f"{s}_station_id").alias("id")) for s in sides))
    pairs = trips.select(F.inline(stops)).where((F.col("name") != "") & (F.col("id") != ""))
    return pairs.groupBy("name", "id").agg(F.count(F.lit(1)).alias("n_trips"))


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``vertex`` and ``component`` (its smallest vertex) of the graph with the
    edges a - b; vertices of both columns are one set of values."""
    pairs = F.array(
        F.struct(F.col(a).alias("vertex"), F.col(b).alias("other")), F.struct(F.col(b).alias("vertex"), F.col(a).alias("other"))
    )
    links = written_map(edges.select(F.inline(pairs)).where("vertex IS NOT NULL AND other IS NOT NULL").distinct(), "links")
    none = F.lit(None).cast(links.schema["vertex"].dataType)
    labels = links.groupBy("vertex").agg(F.least("vertex", F.min("other")).alias("parent"))
    labels = written_map(labels, "labels")
    while True:
        of = labels.select(F.col("vertex").alias("__v"), F.col("parent").alias("__p"))
        # the label of each vertex's label
        grand = labels.join(of, F.col("parent") == F.col("__v")).select("vertex", "parent", F.col("__p").alias("grand"))
        grand = written_map(grand, "grand_labels")
        near = grand.select(F.col("vertex").alias("__v"), F.col("grand").alias("__g"))
        lowest = links.join(near, F.col("other") == F.col("__v")).groupBy("vertex").agg(F.min("__g").alias("lowest"))
        met = grand.join(written_map(lowest, "lowest_labels"), "vertex")
        # a label takes the lowest label met by its vertices; so do the vertices themselves
        told = met.select(
            F.inline(
                F.array(
                    F.struct(F.col("parent").alias("vertex"), F.col("lowest").alias("label"), none.alias("old")),
                    F.struct(F.col("vertex"), F.least("lowest", "grand").alias("label"), F.col("parent").alias("old")),
                )
            )
        )
        after = told.groupBy("vertex").agg(F.least(F.min("label"), F.max("old")).alias("parent"), F.max("old").alias("old"))
        after = written_map(after, "labels")
        changed = after.where(F.col("parent") != F.col("old")).limit(1).count()
        labels = after.select("vertex", "parent")
        if not changed:
            return labels.withColumnRenamed("parent", "component")


def _labelled(pairs: DataFrame) -> DataFrame:
    """The pairs with the component of their station, its smallest id."""
    edges = pairs.select(F.concat(F.lit("n"), "name").alias("a"), F.concat(F.lit("i"), "id").alias("b"))
    components = connected_components(edges, "a", "b")  # ids come before names
    ids = components.where(F.col("vertex").startswith("i"))
    ids = ids.select(F.expr("substr(vertex, 2)").alias("id"), F.expr("substr(component, 2)").alias("component"))
    return pairs.join(written_map(ids, "station_ids"), "id")


def station_identity(trips: DataFrame, sides: Sequence[str] = SIDES, exclude: Sequence[str] = ()) -> DataFrame:
    """One row per station: ``component`` (its smallest id), ``canonical_id``
    and ``canonical_name`` (most trips, the smaller value on a tie), the numbers
    of ids and names, and n_trips. A name that matches a pattern of ``exclude``
    links like any other, but is canonical only where the station has no other."""
    return _identity(_labelled(written_map(station_pairs(trips, sides), "station_pairs")), exclude)


def _identity(labelled: DataFrame, exclude: Sequence[str]) -> DataFrame:
    pairs = written_map(labelled, "station_components")
    by_id = pairs.groupBy("component", "id").agg(F.sum("n_trips").alias("n"))
    ids = by_id.groupBy("component").agg(
        arg_max("id", "n").alias("canonical_id"), F.count(F.lit(1)).alias("n_ids"), F.sum("n").alias("n_trips")
    )
    by_name = pairs.groupBy("component", "name").agg(F.sum("n_trips").alias("n"))
    plain = by_name.withColumn("plain", F.lit(True))
    if exclude:
        kept = exclude_like(by_name, "name", exclude, how="all").select("component", "name", F.lit(True).alias("plain"))
        plain = by_name.join(kept, ["component", "name"], "left")
    rank = F.struct((~F.coalesce("plain", F.lit(False))).alias("rack"), (-F.col("n")).alias("n"), F.col("name").alias("name"))
    names = plain.groupBy("component").agg(F.min(rank)["name"].alias("canonical_name"), F.count(F.lit(1)).alias("n_names"))
    return ids.join(names, "component").select("component", "canonical_id", "canonical_name", "n_ids", "n_names", "n_trips")


def unify_stations(trips: DataFrame, sides: Sequence[str] = SIDES, exclude: Sequence[str] = ()) -> DataFrame:
    """The trips with the canonical id and name of their station on each side.
    A stop without a name takes the name of its id's station, one without an id
    the id of its name's; one without both stays as it is."""
    pairs = written_map(_labelled(written_map(station_pairs(trips, sides), "station_pairs")), "station_components")
    stations = _identity(pairs, exclude)
    both = pairs.join(stations.select("component", "canonical_id", "canonical_name"), "component")
    out = trips
    for kind in ("name", "id"):
        own = both.groupBy(kind).agg(F.min("canonical_id").alias("__id"), F.min("canonical_name").alias("__name"))
        own = written_map(own.withColumnRenamed(kind, "__key"), f"stations_by_{kind}")
        for s in sides:
            value = F.col(f"{s}_station_{kind}")
            joined = out.join(own, value == F.col("__key"), "left")
            at = {f"{s}_station_id": "__id", f"{s}_station_name": "__name"}
            # by name first; by id only where the name says nothing
            says = F.col("__key").isNotNull() if kind == "name" else F.col("__key").isNotNull() & ~F.coalesce(F.col(f"{s}_station_name") != "", F.lit(False))
            out = joined.select(*[F.when(says, F.col(at[c])).otherwise(F.col(c)).alias(c) if c in at else F.col(c) for c in out.columns])
    return out
