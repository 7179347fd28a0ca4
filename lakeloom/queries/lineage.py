"""Queries on lineage."""

from pyspark.sql import functions as F

from lakeloom.operators import lineage as L
from lakeloom.queries.base import query
from lakeloom.queries.inputs import EDGES, GRAPH

_ENDS = "source_table_full_name, target_table_full_name"
_LATEST = f"""
WITH edges AS ({EDGES}),
newest AS (SELECT target_table_full_name AS t, max(event_date) AS d FROM edges GROUP BY 1),
latest AS (
  SELECT DISTINCT {_ENDS} FROM edges JOIN newest ON target_table_full_name = t AND event_date = d
  WHERE source_table_full_name IS NOT NULL AND source_table_full_name <> target_table_full_name
    AND split_part(source_table_full_name, '.', 3) NOT LIKE '__materialization_%')
"""


def _parts(column, number):
    return ", ".join(
        f"""split_part({column}, '.', {i + 1}) AS "{number}_{part}" """
        for i, part in enumerate(("catalog", "schema", "table"))
    )


@query("l1_latest_edges", _LATEST + f"SELECT {_ENDS} FROM latest")
def _(t):
    return L.latest_edges(t.sql(EDGES))


@query(
    "l2_lineage_stages",
    _LATEST
    + f"""SELECT l2.source_table_full_name AS stage_2, l1.source_table_full_name AS stage_1,
       l1.target_table_full_name AS stage_0, {_parts("l1.target_table_full_name", 0)},
       {_parts("l1.source_table_full_name", 1)}, {_parts("l2.source_table_full_name", 2)}
    FROM latest l2 JOIN latest l1 ON l2.target_table_full_name = l1.source_table_full_name""",
)
def _(t):
    return L.table_stages(t.sql(EDGES), 2)


_GRAPH_LATEST = f"""
WITH edges AS ({GRAPH}),
newest AS (SELECT target_table_full_name AS t, max(event_date) AS d FROM edges GROUP BY 1),
latest AS (
  SELECT DISTINCT {_ENDS} FROM edges JOIN newest ON target_table_full_name = t AND event_date = d
  WHERE source_table_full_name <> target_table_full_name)
"""


@query(
    "l2_four_stage_paths",
    _GRAPH_LATEST
    + """SELECT a.source_table_full_name AS stage_0, b.source_table_full_name AS stage_1,
       c.source_table_full_name AS stage_2, d.source_table_full_name AS stage_3,
       d.target_table_full_name AS stage_4, 1 AS value, d.target_table_full_name AS target_table,
       split_part(d.target_table_full_name, '.', 1) AS target_catalog,
       split_part(d.target_table_full_name, '.', 2) AS target_schema
    FROM latest a JOIN latest b ON a.target_table_full_name = b.source_table_full_name
    JOIN latest c ON b.target_table_full_name = c.source_table_full_name
    JOIN latest d ON c.target_table_full_name = d.source_table_full_name""",
)
def _(t):
    return L.path_stages(t.sql(GRAPH), 4, drop_internal=False, prefix="c1.")


_COLUMN_ENDS = f"{_ENDS}, source_column_name, target_column_name"


@query(
    "l3_column_lineage_stages",
    f"""
WITH edges AS ({EDGES}),
newest AS (SELECT target_table_full_name AS t, max(event_date) AS d FROM edges GROUP BY 1),
latest AS (
  SELECT DISTINCT {_COLUMN_ENDS} FROM edges JOIN newest ON target_table_full_name = t AND event_date = d
  WHERE source_column_name IS NOT NULL AND target_column_name IS NOT NULL
    AND source_table_full_name <> target_table_full_name
    AND split_part(source_table_full_name, '.', 3) NOT LIKE '__materialization_%')
SELECT l2.source_table_full_name AS stage_2_table, l2.source_column_name AS stage_2_column,
       l1.source_table_full_name AS stage_1_table, l1.source_column_name AS stage_1_column,
       l1.target_table_full_name AS stage_0_table, l1.target_column_name AS stage_0_column,
       {_parts("l1.target_table_full_name", 0)}, {_parts("l1.source_table_full_name", 1)},
       {_parts("l2.source_table_full_name", 2)}
FROM latest l2 JOIN latest l1 ON l2.target_table_full_name = l1.source_table_full_name
  AND l2.target_column_name = l1.source_column_name""",
)
def _(t):
    return L.column_stages(t.sql(EDGES), 2)


@query(
    "l4_table_lineage",
    f"""WITH edges AS ({GRAPH})
    SELECT * FROM edges WHERE target_table_full_name = 'c1.l2.t5' AND entity_type = 'PIPELINE'
      AND event_date = (SELECT max(event_date) FROM edges WHERE target_table_full_name = 'c1.l2.t5')""",
)
def _(t):
    return L.newest_rows_of(t.sql(GRAPH), "c1.l2.t5")


_CLOSURE = f"""
WITH RECURSIVE edges AS ({GRAPH}),
direct AS (
  SELECT DISTINCT {_ENDS}, event_time FROM edges
  WHERE event_date = (SELECT max(event_date) FROM edges)
    AND source_table_full_name <> target_table_full_name
    AND source_table_full_name NOT LIKE '%__materialization_mat_%'),
reached(node, depth) AS (
  SELECT 'c1.l6.t0', 0
  UNION
  SELECT source_table_full_name, depth + 1 FROM reached JOIN direct ON target_table_full_name = node
  WHERE depth < 10),
lineage AS (SELECT * FROM direct WHERE target_table_full_name IN (SELECT node FROM reached))
"""


@query("l5_recursive_lineage", _CLOSURE + f"SELECT {_ENDS}, event_time FROM lineage")
def _(t):
    return L.recursive_lineage(t.sql(GRAPH), "c1.l6.t0", 10)


_LINKS = _CLOSURE.rstrip() + f""",
links AS (SELECT DISTINCT {_ENDS} FROM lineage)
"""


@query(
    "l6_lineage_paths",
    _LINKS.rstrip()
    + """,
paths(path, steps) AS (
  SELECT ['c1.l6.t0'], 0
  UNION ALL
  SELECT list_append(path, source_table_full_name), steps + 1
  FROM paths JOIN links ON target_table_full_name = path[-1]
  WHERE steps < 9 AND NOT list_contains(path, source_table_full_name)),
ended AS (
  SELECT list_reverse(path) AS p FROM paths
  WHERE path[-1] NOT IN (SELECT target_table_full_name FROM links))
SELECT p[1] AS stage_1, p[2] AS stage_2, p[3] AS stage_3, p[4] AS stage_4, p[5] AS stage_5,
       p[6] AS stage_6, p[7] AS stage_7, p[8] AS stage_8, p[9] AS stage_9, p[10] AS stage_10,
       p[11] AS stage_11, 1 AS value
FROM ended""",
)
def _(t):
    return L.simple_paths(t.sql(GRAPH), "c1.l6.t0", 10)


def _left_chain(first, stages, links):
    """FROM clause of a chain of left joins a<stages> … a1 on the links."""
    text = first
    for stage in range(stages - 1, -1, -1):
        on = f"r.root" if stage == stages - 1 else f"a{stage + 1}.source_table_full_name"
        text += f"\nLEFT JOIN {links} a{stage} ON a{stage}.target_table_full_name = {on}"
    return text


@query(
    "l7_lineage_paths_left",
    _LINKS
    + "SELECT "
    + ", ".join(f"a{s}.source_table_full_name AS stage_{s}" for s in range(6))
    + ", root AS stage_6, 1 AS value "
    + _left_chain("FROM (SELECT 'c1.l6.t0' AS root) r", 6, "links"),
)
def _(t):
    return L.left_paths(t.sql(GRAPH), "c1.l6.t0", 6)


@query(
    "l8_all_lineage_paths",
    _GRAPH_LATEST
    + "SELECT "
    + ", ".join(f"a{s}.source_table_full_name AS stage_{s}" for s in range(5))
    + """, root AS stage_5, 1 AS value, root AS target_table,
       split_part(root, '.', 1) AS target_catalog, split_part(root, '.', 2) AS target_schema """
    + _left_chain("FROM (SELECT DISTINCT target_table_full_name AS root FROM latest) r", 5, "latest"),
)
def _(t):
    return L.all_paths(t.sql(GRAPH), "c1.", 5)


_COLOUR = """CASE WHEN lower({0}) LIKE '%bronze%' THEN '#cd7f32' WHEN lower({0}) LIKE '%silver%' THEN '#c0c0c0'
  WHEN lower({0}) LIKE '%gold%' THEN '#ffd700' ELSE '#a9a9a9' END"""


@query(
    "l9_lineage_flow",
    f"""WITH edges AS ({EDGES}),
links AS (SELECT {_ENDS}, count(*) AS value FROM edges
          WHERE source_table_full_name IS NOT NULL AND target_table_full_name IS NOT NULL GROUP BY 1, 2),
names AS (SELECT source_table_full_name AS name FROM links UNION SELECT target_table_full_name FROM links),
nodes AS (SELECT name, row_number() OVER (ORDER BY md5(name)) - 1 AS index FROM names)
SELECT {_ENDS}, value, s.index AS source, t.index AS target,
  split_part(source_table_full_name, '.', -1) AS source_label,
  split_part(target_table_full_name, '.', -1) AS target_label,
  {_COLOUR.format("source_table_full_name")} AS source_colour,
  {_COLOUR.format("target_table_full_name")} AS target_colour
FROM links JOIN nodes s ON s.name = source_table_full_name JOIN nodes t ON t.name = target_table_full_name""",
)
def _(t):
    return L.flow(t.sql(EDGES))


@query(
    "l9_flow_of_one_table",
    _CLOSURE.rstrip()
    + f""",
links AS (SELECT {_ENDS}, count(*) AS value FROM lineage GROUP BY 1, 2),
names AS (SELECT source_table_full_name AS name FROM links UNION SELECT target_table_full_name FROM links),
nodes AS (SELECT name, row_number() OVER (ORDER BY md5(name)) - 1 AS index FROM names)
SELECT {_ENDS}, value, s.index AS source, t.index AS target,
  split_part(source_table_full_name, '.', -1) AS source_label,
  split_part(target_table_full_name, '.', -1) AS target_label, '#a9a9a9' AS source_colour, '#a9a9a9' AS target_colour
FROM links JOIN nodes s ON s.name = source_table_full_name JOIN nodes t ON t.name = target_table_full_name""",
)
def _(t):
    return L.flow(L.recursive_lineage(t.sql(GRAPH), "c1.l6.t0", 10))


@query(
    "l2_stage_counts",
    _LATEST
    + """SELECT 1 AS stages, count(*) AS chains FROM latest
    UNION ALL
    SELECT 2, count(*) FROM latest l2 JOIN latest l1 ON l2.target_table_full_name = l1.source_table_full_name""",
)
def _(t):
    edges = t.sql(EDGES)
    return L.latest_edges(edges).agg(F.lit(1).alias("stages"), F.count(F.lit(1)).alias("chains")).unionByName(
        L.table_stages(edges, 2).agg(F.lit(2).alias("stages"), F.count(F.lit(1)).alias("chains"))
    )
