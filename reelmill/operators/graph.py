"""Connected components by alternating stars; no group of neighbours is ever gathered in one task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmill.shared import looked_up, small, stored

#: Beyond so many edges joins with a node's least neighbour are made splittable.
LARGE_EDGES = 1_000_000
#: A graph of no more edges than that is solved in one task, as a round of stars would take longer to start.
ONE_TASK_EDGES = 16_384


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum((F.xxhash64("a", "b") % 1_000_003).cast("long")), F.bit_xor(F.xxhash64("a", "b"))).first())


def _with_least(edges: DataFrame, least: DataFrame, large: bool) -> DataFrame:
    """A node can have a large share of all edges; where there are many, its rows have to be splittable."""
    return looked_up(edges, least, "a", "least") if large else edges.join(least, "a")


def _large_star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    met = _with_least(both, least, large).where("b > a")
    return met.select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()


def _small_star(edges: DataFrame, large: bool) -> DataFrame:
    """Every edge leads from its larger end (a) to its smaller one (b)."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    met = _with_least(edges, least, large)
    return met.select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").where("a <> b").distinct()


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over a bounded number of edges; roots are the smallest nodes."""
    root: dict = {}

    def find(x):
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root[up]
        return x

    kind = None
    for batch in batches:
        kind = batch.schema.field(0).type
        for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x, y = sorted((find(x), find(y)))
            root[y] = x
    if kind is not None:
        nodes = list(root)
        yield pa.RecordBatch.from_arrays([pa.array(nodes, kind), pa.array([find(x) for x in nodes], kind)], names=["node", "component"])


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", one_task_edges: int = ONE_TASK_EDGES) -> DataFrame:
    """(node, component): each node that has an edge and the smallest node that it reaches.

    Rows with a null end or one end twice add nothing. The rounds grow with the logarithm of the longest path; each
    is written to the shared folder, so the plan stays as short as one round.
    """
    rows = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(F.col(a).isNotNull() & F.col(b).isNotNull()).where("a <> b").distinct()
    rows = stored(rows, "edges")
    before, mark = None, _mark(rows)
    kind = rows.schema["a"].dataType.simpleString()
    if mark[0] <= one_task_edges and kind in ("string", "bigint", "int"):
        return rows.coalesce(1).mapInArrow(_united, f"node {kind}, component {kind}")
    while mark != before:
        large = mark[0] > LARGE_EDGES
        rows = stored(_small_star(stored(_large_star(rows, large), "edges"), large), "edges")
        before, mark = mark, _mark(rows)
    return rows.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(rows.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def identity_edges(rows: DataFrame, tokens: str, label: str, split: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges): all tokens of rows outside the test split, and the first two tokens of each positive row."""
    rows = rows.where(F.coalesce(F.col(split) != "test", F.lit(True))) if split else rows
    nodes = rows.select(F.explode(tokens).alias("node")).distinct()
    edges = rows.where((F.col(label) == 1) & (F.size(tokens) >= 2)).select(F.col(tokens)[0].alias("a"), F.col(tokens)[1].alias("b"))
    return nodes, edges


def component_tables(nodes: DataFrame, edges: DataFrame, prefix: str = "identity-component/") -> tuple[DataFrame, DataFrame]:
    """(node, component) of every node and (component, name): a component is named by its sorted members; a node without edges is one by itself."""
    found = nodes.join(connected_components(edges), "node", "left").withColumn("component", F.coalesce("component", "node"))
    found = stored(found, "components")
    names = found.groupBy("component").agg(F.concat(F.lit(prefix), F.array_join(F.array_sort(F.collect_set(F.col("node").cast("string"))), "-")).alias("name"))
    return found.select("node", "component"), names


def named_components(nodes: DataFrame, edges: DataFrame, prefix: str = "identity-component/") -> DataFrame:
    """(node, component, name): both tables of component_tables in one, so its bytes grow with the square of a component's size."""
    found, names = component_tables(nodes, edges, prefix)
    return found.join(names, "component").select("node", "component", "name")


def group_ids(
    rows: DataFrame, components: DataFrame, tokens: str, path: str, split: str, names: DataFrame | None = None, form: Callable[[Column], Column] = lambda c: c
) -> DataFrame:
    """Adds group_id: official-test/<path> for test rows, the component of the first token, else the path; paths lower-case, without suffix.

    Large components come as the two tables of component_tables, so a name meets its rows last and is never moved or
    kept once for each node. form: what is made of a group's id, such as a digest; of a component's name once.
    """
    stem = F.lower(F.regexp_replace(path, r"\.[^./]*$", ""))
    # get() is null beyond the end, so a row without tokens finds no component
    rows, first = rows.withColumn("_first", F.get(tokens, 0)), F.col("node").alias("_first")
    if names is None:
        # with a name on every node this side is far larger than it is estimated, so it must not be broadcast
        joined = rows.join(components.select(first, form(F.col("name")).alias("_name")).hint("merge"), "_first", "left")
    else:
        found = rows.join(small(components.select(first, F.col("component").alias("_component"))), "_first", "left")
        joined = looked_up(found, names.select(F.col("component").alias("_component"), form(F.col("name")).alias("_name")), "_component", "names", "left").drop("_component")
    group = F.when(F.col(split) == "test", form(F.concat(F.lit("official-test/"), stem))).otherwise(F.coalesce("_name", form(stem)))
    return joined.withColumn("group_id", group).drop("_first", "_name")
