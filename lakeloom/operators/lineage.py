"""Table and column lineage over an edge log.

The log holds one row per observed flow and day, so it is reduced to distinct edges (a partial
aggregation, safe for a target that owns a third of the log) before any join looks at it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.text import name_part, name_parts
from lakeloom.operators.rows import running_id
from lakeloom.session import cut, cut_and_count

SOURCE, TARGET = "source_table_full_name", "target_table_full_name"
SOURCE_COLUMN, TARGET_COLUMN = "source_column_name", "target_column_name"
DAY, TIME = "event_date", "event_time"

# Patterns of internal tables and layer colours of the flow diagram.
INTERNAL_PART = "__materialization_%"
INTERNAL_NAME = "%__materialization_mat_%"
LAYER_COLOURS = {"bronze": "#cd7f32", "silver": "#c0c0c0", "gold": "#ffd700"}
OTHER_COLOUR = "#a9a9a9"


def latest_edges(
    edges: DataFrame,
    by_column: bool = False,
    drop_internal: bool = True,
    prefix: str | None = None,
) -> DataFrame:
    """Distinct edges seen on the newest date of their target.

    The newest date counts every row of a target, also those dropped afterwards: NULL sources,
    self-loops and internal tables. ``prefix`` keeps targets of one catalog; give it with the dot.
    """
    ends = [SOURCE, TARGET] + ([SOURCE_COLUMN, TARGET_COLUMN] if by_column else [])
    if prefix is not None:
        edges = edges.filter(F.col(TARGET).startswith(prefix))
    # The log is read once; both sides of the join below, and all stages above, read these reduced rows.
    newest_per_edge = cut(edges.groupBy(*ends).agg(F.max(DAY).alias(DAY)), "newest")
    newest_per_target = newest_per_edge.groupBy(TARGET).agg(F.max(DAY).alias(DAY))
    usable = F.col(SOURCE) != F.col(TARGET)
    if by_column:
        usable = usable & F.col(SOURCE_COLUMN).isNotNull() & F.col(TARGET_COLUMN).isNotNull()
    if drop_internal:
        # LIKE is meant: "_" stands for any character, and a name without a third part is dropped.
        usable = usable & ~name_part(F.col(SOURCE), 2).like(INTERNAL_PART)
    return newest_per_edge.filter(usable).join(newest_per_target, [TARGET, DAY]).select(*ends)


def table_stages(edges: DataFrame, stages: int = 2, **latest: object) -> DataFrame:
    """``stage_n … stage_0`` for every chain of ``stages`` edges, with the name parts of each stage.

    Inner joins: a target with a shorter ancestry does not appear.
    """
    links = latest_edges(edges, **latest)
    rows = links.select(F.col(SOURCE).alias("stage_1"), F.col(TARGET).alias("stage_0"))
    for stage in range(2, stages + 1):
        step = links.select(F.col(SOURCE).alias(f"stage_{stage}"), F.col(TARGET).alias("_at"))
        rows = step.join(rows, step["_at"] == rows[f"stage_{stage - 1}"]).drop("_at")
    names = [f"stage_{s}" for s in range(stages, -1, -1)]
    return rows.select(
        *names,
        *[part for s in range(stages + 1) for part in name_parts(F.col(f"stage_{s}"), f"{s}_")],
    )


def column_stages(edges: DataFrame, stages: int = 2, table: str | None = None) -> DataFrame:
    """As :func:`table_stages` on (table, column) pairs; ``table`` keeps one stage-0 table."""
    links = latest_edges(edges, by_column=True)
    rows = links.select(
        F.col(SOURCE).alias("stage_1_table"),
        F.col(SOURCE_COLUMN).alias("stage_1_column"),
        F.col(TARGET).alias("stage_0_table"),
        F.col(TARGET_COLUMN).alias("stage_0_column"),
    )
    if table is not None:
        rows = rows.filter(F.col("stage_0_table") == table)
    for stage in range(2, stages + 1):
        step = links.select(
            F.col(SOURCE).alias(f"stage_{stage}_table"),
            F.col(SOURCE_COLUMN).alias(f"stage_{stage}_column"),
            F.col(TARGET).alias("_table"),
            F.col(TARGET_COLUMN).alias("_column"),
        )
        rows = step.join(
            rows,
            (step["_table"] == rows[f"stage_{stage - 1}_table"])
            & (step["_column"] == rows[f"stage_{stage - 1}_column"]),
        ).drop("_table", "_column")
    names = [f"stage_{s}_{kind}" for s in range(stages, -1, -1) for kind in ("table", "column")]
    return rows.select(
        *names,
        *[p for s in range(stages + 1) for p in name_parts(F.col(f"stage_{s}_table"), f"{s}_")],
    )


def path_stages(edges: DataFrame, stages: int = 4, **latest: object) -> DataFrame:
    """Chains in flow order, ``stage_0`` the farthest source, with the target's catalog and schema."""
    rows = table_stages(edges, stages, **latest)
    return rows.select(
        *[F.col(f"stage_{stages - s}").alias(f"stage_{s}") for s in range(stages + 1)],
        F.lit(1).alias("value"),
        F.col("stage_0").alias("target_table"),
        name_part(F.col("stage_0"), 0).alias("target_catalog"),
        name_part(F.col("stage_0"), 1).alias("target_schema"),
    )


def newest_rows_of(edges: DataFrame, target: str, entity_type: str = "PIPELINE") -> DataFrame:
    """Rows of one target on its newest date, of one entity type; the date counts all types."""
    mine = edges.filter(F.col(TARGET) == target)
    newest = mine.agg(F.max(DAY)).scalar()
    return mine.filter((F.col("entity_type") == entity_type) & (F.col(DAY) == newest))


def recursive_lineage(
    edges: DataFrame,
    start: str,
    max_depth: int = 10,
    day: object | None = None,
    levels_per_round: int = 5,
) -> DataFrame:
    """All edges upstream of ``start``, each table expanded at its smallest depth.

    ``day`` defaults to the newest date of the whole log. A table at depth ``max_depth`` still has
    its own edges listed. A round walks a few levels in one job and writes the tables it finds for the
    first time; the loop ends when the last level of a round finds none.
    """
    if day is None:
        day = edges.agg(F.max(DAY)).first()[0]
        if day is None:
            raise ValueError("the edge log holds no event_date")
    direct = cut(
        edges.filter(
            (F.col(DAY) == F.lit(day))
            & (F.col(SOURCE) != F.col(TARGET))
            & ~F.col(SOURCE).like(INTERNAL_NAME)
        )
        .select(SOURCE, TARGET, TIME)
        .distinct(),
        "edges",
    )
    links = direct.select(F.col(SOURCE).alias("_parent"), F.col(TARGET).alias("_node"))
    frontier = edges.sparkSession.createDataFrame([(start,)], "_node string")
    visited, depth = frontier, 0
    while depth < max_depth:
        reached, last = [], min(depth + levels_per_round, max_depth)
        step = frontier
        for level in range(depth + 1, last + 1):
            step = links.join(step, "_node").select(F.col("_parent").alias("_node")).distinct()
            reached.append(step.withColumn("_depth", F.lit(level)))
        # A walk may come back to known tables; a new one has its smallest depth.
        new = (
            reduce(DataFrame.union, reached)
            .groupBy("_node")
            .agg(F.min("_depth").alias("_depth"))
            .join(visited, "_node", "left_anti")
        )
        at_last = F.col("_depth") == last
        found, going_on = cut_and_count(new, "levels", at_last)
        visited = visited.unionByName(found.select("_node"))
        frontier, depth = found.filter(at_last).select("_node"), last
        if not going_on:
            break
    return direct.join(visited, direct[TARGET] == visited["_node"], "left_semi")


def _links(lineage: DataFrame) -> DataFrame:
    return lineage.filter(F.col(SOURCE) != F.col(TARGET)).select(
        F.col(SOURCE).alias("_parent"), F.col(TARGET).alias("_node")
    ).distinct()


def _join_key(name: Column, alive: Column, spread: Column) -> Column:
    """The name while a path may grow; else a value no table has, spread over all partitions."""
    return F.when(alive & name.isNotNull(), name).otherwise(
        F.concat(F.lit("\u0000"), F.xxhash64(spread).cast("string"))
    )


def simple_paths(
    edges: DataFrame, start: str, max_depth: int = 5, day: object | None = None
) -> DataFrame:
    """Paths without repeated tables, farthest source first, padded with NULL to max_depth+1 columns.

    The rows are the paths themselves: their number may grow with the branching to the power of the depth.
    Paths that still grow after ``max_depth`` rounds are dropped, and so is a branch that only
    meets tables it already holds.
    """
    links = cut(_links(recursive_lineage(edges, start, max_depth, day)), "links")
    paths = edges.sparkSession.createDataFrame([([start],)], "path array<string>").withColumn(
        "done", F.lit(False)
    )
    for _ in range(max_depth):
        keyed = paths.withColumn(
            "_node", _join_key(F.element_at("path", -1), ~F.col("done"), F.col("path"))
        )
        paths = (
            keyed.join(links, "_node", "left")
            .filter(F.col("_parent").isNull() | ~F.array_contains("path", F.col("_parent")))
            .select(
                F.when(F.col("_parent").isNull(), F.col("path"))
                .otherwise(F.concat("path", F.array("_parent")))
                .alias("path"),
                (F.col("done") | F.col("_parent").isNull()).alias("done"),
            )
        )
    ended = paths.filter("done").select(F.reverse("path").alias("path"))
    return ended.select(
        *[F.get("path", F.lit(i)).alias(f"stage_{i + 1}") for i in range(max_depth + 1)],
        F.lit(1).alias("value"),
    )


def _grow_left(paths: DataFrame, links: DataFrame, max_depth: int) -> DataFrame:
    """From ``stage_<max_depth>`` back to ``stage_0`` by left joins; no loop check."""
    for stage in range(max_depth - 1, -1, -1):
        after = F.col(f"stage_{stage + 1}")
        keyed = paths.withColumn("_node", _join_key(after, F.lit(True), F.struct(*paths.columns)))
        paths = (
            keyed.join(links, "_node", "left")
            .withColumnRenamed("_parent", f"stage_{stage}")
            .drop("_node")
        )
    return paths


def left_paths(
    edges: DataFrame, start: str, max_depth: int = 5, day: object | None = None
) -> DataFrame:
    """Paths ending in ``start`` as ``stage_0 … stage_<max_depth>``, short ones NULL at the front."""
    links = cut(_links(recursive_lineage(edges, start, max_depth, day)), "links")
    root = edges.sparkSession.createDataFrame([(start,)], f"stage_{max_depth} string")
    return _grow_left(root, links, max_depth).select(
        *[f"stage_{s}" for s in range(max_depth + 1)], F.lit(1).alias("value")
    )


def all_paths(edges: DataFrame, prefix: str, max_depth: int = 5) -> DataFrame:
    """:func:`left_paths` for every target below ``prefix`` in one chain of joins, newest edges only.

    The newest date of a target counts usable rows only (self-loops and NULL sources are out first).
    """
    usable = edges.filter(
        (F.col(SOURCE) != F.col(TARGET)) & F.col(TARGET).startswith(prefix)
    )
    links = latest_edges(usable, drop_internal=False).select(
        F.col(SOURCE).alias("_parent"), F.col(TARGET).alias("_node")
    )
    roots = links.select(F.col("_node").alias(f"stage_{max_depth}")).distinct()
    target = F.col(f"stage_{max_depth}")
    return _grow_left(roots, links, max_depth).select(
        *[f"stage_{s}" for s in range(max_depth + 1)],
        F.lit(1).alias("value"),
        target.alias("target_table"),
        name_part(target, 0).alias("target_catalog"),
        name_part(target, 1).alias("target_schema"),
    )


def layer_colour(name: Column) -> Column:
    """Colour of the first layer word found in the name, grey without one."""
    colour = F
    for word, value in LAYER_COLOURS.items():
        colour = colour.when(F.lower(name).contains(word), F.lit(value))
    return colour.otherwise(F.lit(OTHER_COLOUR))


def flow(lineage: DataFrame) -> DataFrame:
    """Link table of a flow diagram: one row per edge with its count, node numbers, labels, colours.

    Nodes are numbered from 0 in the order of their digest, which spreads them evenly over the
    buckets of the numbering.
    """
    links = lineage.na.drop(subset=[SOURCE, TARGET]).groupBy(SOURCE, TARGET).agg(
        F.count(F.lit(1)).alias("value")
    )
    names = links.select(F.explode(F.array(SOURCE, TARGET)).alias("name")).distinct()
    nodes = running_id(
        names.withColumn("_digest", F.md5("name")).withColumn("_bucket", F.substring("_digest", 1, 3)),
        "_bucket",
        ["_digest"],
        "index",
        0,
    ).select("name", "index")
    sources = nodes.select(F.col("name").alias(SOURCE), F.col("index").alias("source"))
    targets = nodes.select(F.col("name").alias(TARGET), F.col("index").alias("target"))
    return links.join(sources, SOURCE).join(targets, TARGET).select(
        SOURCE,
        TARGET,
        "value",
        "source",
        "target",
        F.substring_index(SOURCE, ".", -1).alias("source_label"),
        F.substring_index(TARGET, ".", -1).alias("target_label"),
        layer_colour(F.col(SOURCE)).alias("source_colour"),
        layer_colour(F.col(TARGET)).alias("target_colour"),
    )
