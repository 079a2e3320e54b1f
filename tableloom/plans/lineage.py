"""Lineage edges from configured steps, their depth and paths."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame, functions as F

from tableloom.session import settle
from tableloom.spec import SpecError

# Step attributes that name another table, and the relationship they make.
REFERENCES = {
    ("join_data", "right_table_name"): "join",
    ("attach_dimension_surrogate_key", "dimension_table_name"): "dimension_lookup",
    ("union_data", "union_tables"): "union",
    ("custom_transformation_function", "source_tables"): "custom_transformation_function",
}


def edges(orchestration: DataFrame, primary: DataFrame, advanced: DataFrame) -> DataFrame:
    """One row per source and target: where each orchestrated table reads from."""
    target = orchestration.select(
        "Table_ID", "Trigger_Name", F.lower(F.concat_ws(".", "Target_Datastore", "Target_Entity")).alias("target")
    )
    direct = primary.filter("Configuration_Category = 'source_details' AND Configuration_Name = 'table_name'").select(
        "Table_ID", F.col("Configuration_Value").alias("source"), F.lit("direct").alias("relationship")
    )
    kind = F.when(F.lit(False), F.lit(None).cast("string"))
    for (step, attribute), name in REFERENCES.items():
        hit = (F.col("Configuration_Name") == step) & (F.col("Configuration_Attribute_Name") == attribute)
        kind = kind.when(hit, F.lit(name))
    used = advanced.withColumn("relationship", kind).filter("relationship IS NOT NULL").select(
        "Table_ID", F.explode(F.split("Configuration_Attribute_Value", r"\s*,\s*")).alias("source"), "relationship"
    )
    named = direct.unionByName(used).withColumn("source", F.lower(F.trim("source"))).filter("source <> ''")
    out = named.join(target, "Table_ID").select("source", "target", "relationship", "Trigger_Name", "Table_ID")
    makers = target.select(F.col("target").alias("source"), F.col("Trigger_Name").alias("made_by")).distinct()
    across = out.join(makers, "source", "left").groupBy("source", "target", "relationship", "Trigger_Name", "Table_ID").agg(
        F.coalesce(F.bool_and(F.col("made_by") != F.col("Trigger_Name")), F.lit(False)).alias("is_cross_trigger"),
        F.array_join(F.array_sort(F.collect_set("made_by")), ", ").alias("source_triggers"),
    )
    return across


def depths(edge: DataFrame, max_depth: int | None = None) -> DataFrame:
    """Hops from the farthest root and one such path, for every table.

    Tables without an incoming edge are roots. Each round extends the frontier by
    one join and keeps the smallest path per table, so a round holds at most one
    row per table however many paths there are. Paths longer than the number of tables, or
    than ``max_depth`` if given, are an error: there is a cycle.
    """
    links = edge.select("source", "target").distinct().filter("source <> target")
    roots = links.select(F.col("source").alias("node")).join(
        links.select(F.col("target").alias("node")), "node", "left_anti"
    ).distinct()
    tables = settle(links.select(F.col("source").alias("node")).union(links.select("target")).distinct(), "tables")
    most = max_depth if max_depth is not None else tables.count()
    level = roots.select("node", F.lit(0).alias("depth"), F.col("node").alias("path"))
    found = level
    for depth in range(1, most + 2):
        step = level.join(links, F.col("node") == F.col("source")).groupBy("target").agg(
            F.min(F.concat_ws(" -> ", "path", "target")).alias("path")
        )
        level = settle(step.select(F.col("target").alias("node"), F.lit(depth).alias("depth"), "path"), "lineage")
        if level.isEmpty():
            break
        if depth > most:
            raise SpecError(f"lineage is deeper than {most} hops; is there a cycle?")
        found = found.unionByName(level)
    lost = tables.join(found.select("node").distinct(), "node", "left_anti").agg(F.count(F.lit(1)), F.min("node")).first()
    if lost[0]:
        raise SpecError(f"{lost[0]} tables lie on or below a cycle, '{lost[1]}' for one")
    return found.groupBy("node").agg(F.max(F.struct("depth", "path")).alias("m")).select("node", "m.depth", "m.path")


def records(edge: DataFrame, depth: DataFrame) -> DataFrame:
    """Edges with the depth and path of their target."""
    at = depth.select(F.col("node").alias("target"), F.col("depth").alias("Lineage_Depth"), F.col("path").alias("Lineage_Path"))
    return edge.join(at, "target", "left")


def upstream(edge: DataFrame, table: str, max_depth: int | None = None) -> DataFrame:
    """All tables that feed ``table``, with their least distance."""
    return _reach(edge.select(F.col("target").alias("here"), F.col("source").alias("next")), table, max_depth)


def downstream(edge: DataFrame, table: str, max_depth: int | None = None) -> DataFrame:
    """All tables fed by ``table``."""
    return _reach(edge.select(F.col("source").alias("here"), F.col("target").alias("next")), table, max_depth)


def _reach(links: DataFrame, start: str, max_depth: int | None) -> DataFrame:
    """Hops from ``start`` until no new table is found; more than ``max_depth``, where given, is an error."""
    frontier = links.sparkSession.createDataFrame([(start.lower(),)], "node string")
    seen = frontier.withColumn("distance", F.lit(0))
    for distance in count(1):
        step = frontier.join(links, F.col("node") == F.col("here")).select(F.col("next").alias("node")).distinct()
        frontier = settle(step.join(seen.select("node"), "node", "left_anti"), "lineage")
        if frontier.isEmpty():
            break
        if max_depth is not None and distance > max_depth:
            raise SpecError(f"lineage of '{start}' is deeper than {max_depth} hops")
        seen = seen.unionByName(frontier.withColumn("distance", F.lit(distance)))
    return seen.filter("distance > 0")


def fingerprint(edge: DataFrame) -> DataFrame:
    """One md5 per target over its sorted incoming edges, to detect structural change."""
    line = F.concat_ws("|", "source", "relationship")
    return edge.groupBy("target").agg(F.md5(F.array_join(F.array_sort(F.collect_set(line)), ";")).alias("fingerprint"))
