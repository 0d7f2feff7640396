"""Approximate nearest neighbours: one hierarchical navigable small-world graph per shard, results merged.

Index. Equal vectors are one node that lists its smallest ids (as many as a
result can need), so copies neither crowd a graph nor hide each other. Nodes are
dealt to shards of about ``SHARD_ROWS`` by hash. A shard's graph is a row of flat
arrays: vectors, per layer the member nodes and a fixed-width table of
neighbours, and the entry node. Every row is indexed.

Search. Queries go to every shard in blocks of ``QUERY_BLOCK``; a task answers
one block on one shard by beam search and returns its best candidates, scored in
double precision on the original vectors; a window per query merges the shards.
Work per task is bounded by the shard and block sizes; no task or driver holds
all vectors or all queries.

Building and searching advance many nodes at a time in numpy: nodes are inserted
in batches that at most double a graph, each batch finding candidates by the
same beam search plus an exact look at its own batch, and choosing neighbours by
the usual diversity rule.

Cases with a defined result: vectors that are NULL, empty, zero or hold a NULL or
non-finite component take no part, nor do rows with a NULL id; vectors are
compared within their own dimension; repeated rows count once; an id with several
vectors is a candidate at its nearest one and a query with each; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapecraft.session import scratch_path

SHARD_ROWS = 4096
QUERY_BLOCK = 4096
#: Neighbours of a node in upper layers; the ground layer has twice as many.
LINKS = 16
BUILD_BEAM = 64
SEARCH_BEAM = 128
#: Candidates whose neighbours are looked at in one step of a beam.
STEP = 4
BATCH = 512


class Graph:
    """A navigable small-world graph over the rows of a matrix; neighbours in flat arrays, -1 for none."""

    def __init__(self, vectors: np.ndarray, members: list[np.ndarray], tables: list[np.ndarray], entry: int):
        self.vectors = vectors.astype(np.float32)
        self.norms = (self.vectors ** 2).sum(axis=1)
        self.members, self.tables, self.entry = members, tables, entry
        # a node's row in each layer's table
        self.rows = []
        for nodes in members:
            row = np.full(len(vectors), -1, np.int32)
            row[nodes] = np.arange(len(nodes), dtype=np.int32)
            self.rows.append(row)

    def distances(self, queries: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Squared distances of each query (a row) to its nodes (-1: infinite)."""
        found = self.norms[nodes] - 2 * np.einsum("bkd,bd->bk", self.vectors[nodes], queries)
        found += (queries ** 2).sum(axis=1)[:, None]
        found[nodes < 0] = np.inf
        return found

    def beam(self, queries: np.ndarray, start: np.ndarray, layer: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` best nodes found in a layer for each query, nearest first, from start nodes (b, s)."""
        b = len(queries)
        line = np.arange(b)[:, None]
        stamp = np.full((b, len(self.vectors)), -1, np.int16)
        r, c = np.nonzero(start >= 0)
        stamp[r, start[r, c]] = 0
        best = np.full((b, width), -1, np.int32)
        dist = np.full((b, width), np.inf, np.float32)
        s = min(start.shape[1], width)
        best[:, :s], dist[:, :s] = start[:, :s], self.distances(queries, start)[:, :s]
        done = best < 0
        while True:
            waiting = np.where(done, np.inf, dist)
            live = np.flatnonzero(np.isfinite(waiting).any(axis=1))
            if not len(live):
                break
            take = np.argpartition(waiting[live], min(STEP, width - 1), axis=1)[:, :STEP]
            rows = live[:, None]
            usable = np.isfinite(waiting[rows, take])
            nodes = np.where(usable, best[rows, take], -1)
            done[rows, take] = True
            near = np.where(nodes[:, :, None] >= 0, self.tables[layer][self.rows[layer][nodes]], -1).reshape(len(live), -1)
            # a node counts where it was not seen before, and once a step
            fresh = (near >= 0) & (stamp[rows, near] < 0)
            slot = np.broadcast_to(np.arange(1, near.shape[1] + 1, dtype=np.int16), near.shape)
            r, c = np.nonzero(fresh)
            stamp[live[r], near[r, c]] = slot[r, c]
            fresh &= stamp[rows, near] == slot
            near = np.where(fresh, near, -1)
            every = np.concatenate([best[live], near], axis=1)
            scores = np.concatenate([dist[live], self.distances(queries[live], near)], axis=1)
            seen = np.concatenate([done[live], np.zeros(near.shape, bool)], axis=1)
            keep = np.argpartition(scores, width - 1, axis=1)[:, :width]
            best[live] = np.take_along_axis(every, keep, axis=1)
            dist[live] = np.take_along_axis(scores, keep, axis=1)
            done[live] = np.take_along_axis(seen, keep, axis=1) | (best[live] < 0)
        order = np.argsort(dist, axis=1, kind="stable")
        return best[line, order], dist[line, order]

    def descend(self, queries: np.ndarray, down_to: int) -> np.ndarray:
        """Start nodes for a layer: the best found on the layers above it."""
        start = np.full((len(queries), 1), self.entry, np.int32)
        for layer in range(len(self.members) - 1, down_to, -1):
            start = self.beam(queries, start, layer, 8)[0]
        return start

    def search(self, queries: np.ndarray, k: int, width: int = SEARCH_BEAM) -> np.ndarray:
        """Up to k nodes per query, nearest first; -1 fills short rows."""
        found = []
        for at in range(0, len(queries), BATCH):
            some = queries[at:at + BATCH].astype(np.float32)
            found.append(self.beam(some, self.descend(some, 0), 0, max(width, k))[0][:, :k])
        return np.concatenate(found) if found else np.zeros((0, k), np.int32)


def _diverse(graph: Graph, owners: np.ndarray, nodes: np.ndarray, dist: np.ndarray, most: int) -> np.ndarray:
    """Per owner up to ``most`` nodes, nearest first, each nearer to the owner than to a chosen one; then the nearest rest."""
    b, c = nodes.shape
    points = graph.vectors[nodes]
    norms = graph.norms[nodes]
    between = norms[:, :, None] + norms[:, None, :] - 2 * points @ points.transpose(0, 2, 1)
    valid = np.isfinite(dist) & (nodes >= 0) & (nodes != owners[:, None])
    nearest = np.full((b, c), np.inf, np.float32)
    chosen = np.zeros((b, c), bool)
    count = np.zeros(b, np.int64)
    for j in range(c):
        accept = valid[:, j] & (dist[:, j] <= nearest[:, j]) & (count < most)
        chosen[:, j] = accept
        count += accept
        nearest[accept] = np.minimum(nearest[accept], between[accept, j, :])
    place = np.argsort(np.where(chosen, 0, np.where(valid, 1, 2)), axis=1, kind="stable")[:, :most]
    kept = np.where(np.take_along_axis(valid, place, axis=1), np.take_along_axis(nodes, place, axis=1), -1)
    if kept.shape[1] < most:
        kept = np.pad(kept, ((0, 0), (0, most - kept.shape[1])), constant_values=-1)
    return kept.astype(np.int32)


def _nearest_first(nodes: np.ndarray, dist: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(dist, axis=1, kind="stable")
    return np.take_along_axis(nodes, order, axis=1), np.take_along_axis(dist, order, axis=1)


def _insert(graph: Graph, layer: int, fresh: np.ndarray, first: bool, most: int) -> None:
    """Link a batch of nodes into a layer."""
    queries = graph.vectors[fresh]
    own = np.broadcast_to(fresh[None, :], (len(fresh), len(fresh))).astype(np.int32).copy()
    np.fill_diagonal(own, -1)
    near = graph.distances(queries, own)
    keep = np.argsort(near, axis=1, kind="stable")[:, :BUILD_BEAM]
    nodes, dist = np.take_along_axis(own, keep, axis=1), np.take_along_axis(near, keep, axis=1)
    if not first:
        start = graph.descend(queries, layer)
        start = np.concatenate([start, np.where((start == graph.entry).any(axis=1), -1, graph.entry)[:, None]], axis=1)
        found, there = graph.beam(queries, start.astype(np.int32), layer, BUILD_BEAM)
        nodes, dist = np.concatenate([nodes, found], axis=1), np.concatenate([dist, there], axis=1)
    nodes, dist = _nearest_first(nodes, dist)
    table, row = graph.tables[layer], graph.rows[layer]
    links = _diverse(graph, fresh, nodes[:, :2 * BUILD_BEAM], dist[:, :2 * BUILD_BEAM], most)
    table[row[fresh]] = links
    # links back: a target keeps the most diverse of its old and new neighbours
    source = np.repeat(fresh, links.shape[1])
    target = links.ravel()
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    targets, begin, sizes = np.unique(target, return_index=True, return_counts=True)
    for at in range(0, len(targets), BATCH):
        some, size, start = targets[at:at + BATCH], sizes[at:at + BATCH], begin[at:at + BATCH]
        column = np.arange(size.max())
        new = np.where(column < size[:, None], source[np.minimum(start[:, None] + column, len(source) - 1)], -1)
        old = table[row[some]]
        new[(new[:, :, None] == old[:, None, :]).any(axis=2)] = -1
        every = np.concatenate([old, new], axis=1).astype(np.int32)
        every, far = _nearest_first(every, graph.distances(graph.vectors[some], every))
        table[row[some]] = _diverse(graph, some, every[:, :4 * most], far[:, :4 * most], most)


def build_graph(vectors: np.ndarray, seed: int = 0) -> Graph:
    """A graph over all rows; equal input gives an equal graph."""
    n = len(vectors)
    height = np.floor(-np.log(np.random.default_rng(seed).uniform(1e-12, 1, n)) / np.log(LINKS)).astype(np.int64)
    height = np.minimum(height, max(0, int(np.log(max(n, 1)) / np.log(LINKS))))
    entry = int(np.argmax(height))
    members = [np.flatnonzero(height >= layer) for layer in range(int(height.max()) + 1)]
    tables = [np.full((len(nodes), LINKS * (1 if layer else 2)), -1, np.int32) for layer, nodes in enumerate(members)]
    graph = Graph(vectors, members, tables, entry)
    for layer in range(len(members) - 1, -1, -1):
        nodes = members[layer]
        # nodes of higher layers first, the entry before all, so that searches start at linked nodes
        nodes = nodes[np.lexsort((nodes, nodes != entry, -height[nodes]))]
        for at in range(0, len(nodes), BATCH):
            _insert(graph, layer, nodes[at:at + BATCH], at == 0, tables[layer].shape[1])
    return graph


# --- Spark -----------------------------------------------------------------------------------------------------

INDEX_SCHEMA = ("dim int, shard int, nodes int, vectors binary, ids binary, id_ends binary, entry int, "
                "members array<binary>, tables array<binary>")


def usable(table: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``vec_id, vec``: distinct rows with an id and a finite vector other than zero, as doubles."""
    vec = F.col(vector_column).cast("array<double>")
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (table.filter(F.col(id_column).isNotNull() & F.coalesce(fine, F.lit(False)))
            .select(F.col(id_column).cast("long").alias("vec_id"), vec.alias("vec"))
            .filter(F.exists("vec", lambda x: x != 0)).distinct())


def build_index(vectors: DataFrame, k: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row of flat arrays per shard, from ``vec_id, vec`` rows; written to the shared folder."""
    spark = vectors.sparkSession
    # of equal vectors a result can name k, and the query's own id may be one more
    ranked = (vectors.withColumn("_r", F.row_number().over(Window.partitionBy("vec").orderBy("vec_id")))
              .filter(F.col("_r") <= k + 1))
    nodes = ranked.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    shards = max(1, -(-vectors.count() // shard_rows))
    placed = nodes.select(F.size("vec").alias("dim"), F.pmod(F.xxhash64("vec"), F.lit(shards)).cast("int").alias("shard"),
                          "vec", "ids")

    def build(part: pd.DataFrame) -> pd.DataFrame:
        part = part.assign(first=part["ids"].map(lambda x: x[0])).sort_values("first", kind="stable")
        matrix = np.stack(part["vec"].to_list()).astype(np.float64)
        graph = build_graph(matrix)
        ends = np.cumsum(part["ids"].map(len).to_numpy())
        return pd.DataFrame([{
            "dim": matrix.shape[1], "shard": int(part["shard"].iloc[0]), "nodes": len(matrix),
            "vectors": matrix.tobytes(), "ids": np.concatenate(part["ids"].to_list()).astype("<i8").tobytes(),
            "id_ends": ends.astype("<i8").tobytes(), "entry": graph.entry,
            "members": [m.astype("<i4").tobytes() for m in graph.members],
            "tables": [t.astype("<i4").tobytes() for t in graph.tables]}])

    folder = scratch_path(spark, "hnsw")
    placed.groupBy("dim", "shard").applyInPandas(build, INDEX_SCHEMA).write.mode("overwrite").parquet(f"{folder}/index")
    return spark.read.parquet(f"{folder}/index")


def _load(row) -> tuple[Graph, np.ndarray, np.ndarray, np.ndarray]:
    vectors = np.frombuffer(row["vectors"], "<f8").reshape(int(row["nodes"]), int(row["dim"]))
    members = [np.frombuffer(m, "<i4") for m in row["members"]]
    tables = [np.frombuffer(t, "<i4").reshape(len(m), -1) for m, t in zip(members, row["tables"])]
    return (Graph(vectors, members, tables, int(row["entry"])), vectors, np.frombuffer(row["ids"], "<i8"),
            np.frombuffer(row["id_ends"], "<i8"))


def search_index(index: DataFrame, queries: DataFrame, k: int, width: int = SEARCH_BEAM) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k nearest found, its own id left out."""
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    asked = queries.select(F.col("vec_id").alias("query_id"), F.col("vec").alias("q"), F.size("vec").alias("dim"),
                           F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"))
    # a query block meets every shard of its dimension
    places = index.select(F.col("dim").alias("_dim"), F.col("shard").alias("_shard"))
    asked = asked.join(places, F.col("dim") == F.col("_dim")).select(
        "query_id", "q", "dim", F.col("_shard").alias("shard"), "block")
    held = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def answer(shard: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(shard) and len(block):
            graph, vectors, ids, ends = _load(shard.iloc[0])
            wanted = np.stack(block["q"].to_list()).astype(np.float64)
            for query_id, q, nodes in zip(block["query_id"], wanted, graph.search(wanted, k + 1, width)):
                nodes = nodes[nodes >= 0]
                scores = np.sqrt(((vectors[nodes] - q) ** 2).sum(axis=1))
                begin = np.where(nodes > 0, ends[nodes - 1], 0)
                for node, score, a in zip(nodes, scores, begin):
                    out += [(query_id, i, score) for i in ids[a:ends[node]].tolist() if i != query_id]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    keys = ["dim", "shard", "block"]
    found = (held.groupBy(*keys).cogroup(asked.groupBy(*keys))
             .applyInPandas(answer, "query_id long, vec_id long, score double"))
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def nearest_neighbours(spark: SparkSession, table: DataFrame, is_query, k: int = 10, id_column: str = "vec_id",
                       vector_column: str = "embedding") -> DataFrame:
    """Index all usable rows and search those that ``is_query`` (a condition on ``vec_id``) selects."""
    vectors = usable(table, id_column, vector_column).persist()
    index = build_index(vectors, k)
    return search_index(index, vectors.filter(is_query), k)
