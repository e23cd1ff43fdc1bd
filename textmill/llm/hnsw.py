"""Approximate nearest neighbours: one navigable small-world graph per shard.

Equal vectors collapse first, so a vector that a third of all rows share is one
node; of its ids only the ``k + 1`` smallest can ever be among the ``k`` nearest,
ties going to the smaller id. Nodes are dealt to shards by a digest of their
smallest id; a shard has about ``shard_rows`` of them, whatever the table's size. A
query visits every shard, so shards should be as large as a task's memory and time
allow: a node takes its vector and about 100 bytes of links. Each
shard's graph (Malkov and Yashunin, 2016) is one row of flat arrays: vectors, ids,
and neighbour lists of a fixed width for every level. Queries go to every shard
in blocks; the shards' results are merged by distance, then id.

Distances are Euclidean, in double precision on the vectors as they are. Defined results: a
null, empty or zero vector, or one with a null or non-finite component, takes no
part, nor does a row with a null id. Vectors of very different magnitude (bands of 2^256) have
shards of their own, which are scaled by a power of two, so no square overflows or
vanishes; a distance above the largest double is infinite. Vectors are compared within one length. A
row that repeats counts once; an id with several vectors is as near as the nearest
of them. An empty table gives an empty result.
"""

from __future__ import annotations

from heapq import heappop, heappush, heappushpop

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.llm.common import col
from textmill.session import cut

SHARD_ROWS = 8192
BLOCK_ROWS = 1024
LINKS = 12
EF_BUILD = 64
EF_SEARCH = 192

GRAPH = (
    "dim INT, band INT, shard INT, nodes INT, scale DOUBLE, vectors BINARY, ids BINARY, id_stops BINARY, entry INT, "
    "widths ARRAY<INT>, level_nodes ARRAY<BINARY>, level_links ARRAY<BINARY>"
)
FOUND = "query_id BIGINT, vec_id BIGINT, score DOUBLE"


class Graph:
    """Flat neighbour arrays: ``links[level][row]`` lists nodes, -1 where there is none.

    Level 0 has a row for every node; ``place[level]`` gives a node's row above it."""

    def __init__(self, vectors: np.ndarray, width: int = LINKS):
        self.vectors, self.width = vectors, width
        self.norms = np.einsum("ij,ij->i", vectors, vectors)
        self.links: list[np.ndarray] = []
        self.place: list[np.ndarray] = []
        self.nodes: list[np.ndarray] = []
        self.entry, self.stamp = -1, 0
        self.seen = np.zeros(len(vectors), np.int64)

    def distances(self, nodes: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Squared distances less the query's own square, which changes no order."""
        return self.norms[nodes] - 2.0 * (self.vectors[nodes] @ query)

    def search(self, query: np.ndarray, entries: list[tuple[float, int]], ef: int, level: int) -> list[tuple[float, int]]:
        """The ``ef`` nearest found from ``entries`` on one level, nearest first."""
        self.stamp += 1
        links, place, seen, stamp = self.links[level], self.place[level], self.seen, self.stamp
        ahead, best = [], []
        for d, node in entries:
            seen[node] = stamp
            heappush(ahead, (d, node))
            heappush(best, (-d, -node))
        while ahead:
            d, node = heappop(ahead)
            if len(best) >= ef and d > -best[0][0]:
                break
            near = links[place[node]]
            near = near[near >= 0]
            near = near[seen[near] != stamp]
            if not len(near):
                continue
            seen[near] = stamp
            for e, other in zip(self.distances(near, query).tolist(), near.tolist()):
                if len(best) < ef:
                    heappush(best, (-e, -other))
                elif e < -best[0][0]:
                    heappushpop(best, (-e, -other))
                else:
                    continue
                heappush(ahead, (e, other))
        return sorted((-d, -node) for d, node in best)

    def _spread(self, found: list[tuple[float, int]], most: int) -> list[int]:
        """At most ``most`` of ``found``: first those nearer to the centre than to one chosen before."""
        if len(found) <= most:
            return [node for _, node in found]
        nodes = np.array([node for _, node in found])
        rows = self.vectors[nodes]
        gaps = self.norms[nodes][:, None] + self.norms[nodes][None, :] - 2.0 * (rows @ rows.T)
        nearest = np.full(len(nodes), np.inf)
        chosen, rest = [], []
        base = np.array([d for d, _ in found])
        # Distances to the centre lack its square; differences of two restore it.
        for i in range(len(nodes)):
            if len(chosen) < most and (not chosen or base[i] + self._centre < nearest[i]):
                chosen.append(i)
                nearest = np.minimum(nearest, gaps[i])
            else:
                rest.append(i)
        return nodes[chosen + rest[: most - len(chosen)]].tolist()

    def build(self, levels: np.ndarray, ef: int = EF_BUILD) -> Graph:
        n = len(self.vectors)
        for level in range(int(levels.max()) + 1 if n else 0):
            nodes = np.flatnonzero(levels >= level)
            place = np.full(n, -1, np.int64)
            place[nodes] = np.arange(len(nodes))
            self.nodes.append(nodes)
            self.place.append(place)
            self.links.append(np.full((len(nodes), self.width * (2 if level == 0 else 1)), -1, np.int32))
        for node in range(n):
            self._insert(node, int(levels[node]), levels, ef)
        return self

    def _insert(self, node: int, top: int, levels: np.ndarray, ef: int) -> None:
        if self.entry < 0:
            self.entry = node
            return
        query = self.vectors[node]
        entries = [(float(self.distances(np.array([self.entry]), query)[0]), self.entry)]
        highest = int(levels[self.entry])
        for level in range(highest, top, -1):
            entries = self.search(query, entries, 1, level)
        for level in range(min(top, highest), -1, -1):
            entries = self.search(query, entries, ef, level)
            links, place = self.links[level], self.place[level]
            self._centre = float(self.norms[node])
            chosen = self._spread(entries, self.width)
            links[place[node], : len(chosen)] = chosen
            for other in chosen:
                row = links[place[other]]
                used = int((row >= 0).sum())
                if used < len(row):
                    row[used] = node
                    continue
                around = np.append(row, node)
                order = sorted(zip(self.distances(around, self.vectors[other]).tolist(), around.tolist()))
                self._centre = float(self.norms[other])
                row[:] = self._spread(order, len(row))
        if top > highest:
            self.entry = node

    def nearest(self, query: np.ndarray, k: int, ef: int) -> np.ndarray:
        if self.entry < 0:
            return np.empty(0, np.int64)
        entries = [(float(self.distances(np.array([self.entry]), query)[0]), self.entry)]
        for level in range(len(self.links) - 1, 0, -1):
            entries = self.search(query, entries, 1, level)
        return np.array([node for _, node in self.search(query, entries, max(ef, k), 0)], np.int64)


def _levels(ids: np.ndarray, width: int) -> np.ndarray:
    """A geometric level from a digest of the id, so that a rebuilt graph is the same."""
    x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    u = ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / 2.0**53
    return np.floor(-np.log(np.maximum(u, 1e-18)) / np.log(width)).astype(np.int64)


def _scale(vectors: np.ndarray) -> float:
    """A power of two near the largest component, 1 where no square can overflow or vanish."""
    largest = float(np.abs(vectors).max())
    return 1.0 if 2.0**-64 < largest < 2.0**64 else 2.0 ** min(int(np.floor(np.log2(largest))), 1022)


def _lengths(gaps: np.ndarray) -> np.ndarray:
    """Euclidean lengths of rows, by their largest component where squares overflow or vanish."""
    with np.errstate(over="ignore", under="ignore", invalid="ignore"):
        found = np.sqrt((gaps**2).sum(axis=1))
        most = np.abs(gaps).max(axis=1)
        odd = (most > 0) & np.isfinite(most) & ((most > 2.0**500) | (most < 2.0**-400))
        if odd.any():
            found[odd] = most[odd] * np.sqrt(((gaps[odd] / most[odd, None]) ** 2).sum(axis=1))
    return found


def _build(shard: pd.DataFrame) -> pd.DataFrame:
    shard = shard.sort_values("least", kind="stable")
    given = np.stack([np.asarray(v, np.float64) for v in shard["vector"]])
    scale = _scale(given)
    vectors = given / scale
    ids = [np.asarray(i, np.int64) for i in shard["ids"]]
    graph = Graph(vectors).build(_levels(shard["least"].to_numpy(np.int64), LINKS))
    row = {
        "dim": shard["dim"].iloc[0], "band": shard["band"].iloc[0], "shard": shard["shard"].iloc[0], "nodes": len(vectors),
        "scale": scale, "vectors": vectors.tobytes(),
        "ids": np.concatenate(ids).tobytes(), "id_stops": np.cumsum([len(i) for i in ids]).astype(np.int64).tobytes(),
        "entry": graph.entry, "widths": [x.shape[1] for x in graph.links],
        "level_nodes": [x.astype(np.int32).tobytes() for x in graph.nodes], "level_links": [x.tobytes() for x in graph.links],
    }
    return pd.DataFrame([row])


def _scaled(query: np.ndarray, scale: float) -> np.ndarray:
    """``query`` in a shard's scale; one that is out of all proportion to it keeps its direction, which alone orders the nodes then."""
    with np.errstate(over="ignore"):
        small = query / scale
    if np.abs(small).max() < 2.0**400:
        return small
    return query / np.abs(query).max() * 2.0**400


def _load(row: pd.Series) -> tuple[Graph, np.ndarray, np.ndarray]:
    n = int(row["nodes"])
    graph = Graph(np.frombuffer(row["vectors"], np.float64).reshape(n, -1))
    for width, nodes, links in zip(row["widths"], row["level_nodes"], row["level_links"]):
        graph.nodes.append(np.frombuffer(nodes, np.int32).astype(np.int64))
        graph.place.append(np.full(n, -1, np.int64))
        graph.place[-1][graph.nodes[-1]] = np.arange(len(graph.nodes[-1]))
        graph.links.append(np.frombuffer(links, np.int32).reshape(-1, width))
    graph.entry = int(row["entry"])
    return graph, np.frombuffer(row["ids"], np.int64), np.frombuffer(row["id_stops"], np.int64)


def _searcher(k: int, ef: int):
    def search(graphs: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found: list[pd.DataFrame] = []
        if len(graphs) and len(queries):
            graph, ids, stops = _load(graphs.iloc[0])
            scale = float(graphs["scale"].iloc[0])
            starts = np.concatenate(([0], stops[:-1]))
            for query_id, vector in zip(queries["query_id"], queries["vector"]):
                query = np.asarray(vector, np.float64)
                nodes = graph.nearest(_scaled(query, scale), k + 1, ef)
                with np.errstate(over="ignore"):
                    scores = _lengths(graph.vectors[nodes] * scale - query)
                counts = stops[nodes] - starts[nodes]
                own = np.concatenate([ids[starts[n] : stops[n]] for n in nodes])
                table = pd.DataFrame({"query_id": query_id, "vec_id": own, "score": np.repeat(scores, counts)})
                found.append(table[own != query_id].sort_values(["score", "vec_id"]).head(k))
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    return search


def usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & F.coalesce(fine & F.exists(vector, lambda x: x != 0.0), F.lit(False))


def _valid(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    rows = table.select(col(id_col).cast("bigint").alias("id"), col(vector_col).cast("array<double>").alias("vector"))
    return rows.where(F.col("id").isNotNull() & usable(F.col("vector")))


def build_index(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """One row per shard: its graph, for queries of up to ``k`` neighbours."""
    rank = Window.partitionBy("vector").orderBy("id")
    # dense_rank counts a repeated id once; what is beyond the limit leaves no task.
    few = _valid(table, id_col, vector_col).withColumn("r", F.dense_rank().over(rank)).where(F.col("r") <= k + 1)
    nodes = few.groupBy("vector").agg(F.array_sort(F.collect_set("id")).alias("ids"))
    band = F.floor(F.log2(F.array_max(F.transform("vector", lambda x: F.abs(x)))) / 256 + 0.5).cast("int")
    nodes = cut(nodes.withColumns({"least": F.col("ids")[0], "dim": F.size("vector"), "band": band}), "nodes")
    shards = -(-max(1, nodes.count()) // shard_rows)
    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64("least"), F.lit(shards)).cast("int"))
    return cut(dealt.groupBy("dim", "band", "shard").applyInPandas(_build, GRAPH), "graphs")


def search_index(
    graphs: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10,
    ef: int = EF_SEARCH, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found to each query but its own id.

    A group is one shard and one block of queries, so neither grows with the input.
    """
    wanted = cut(_valid(queries, id_col, vector_col).distinct().withColumn("dim", F.size("vector")), "queries")
    blocks = -(-max(1, wanted.count()) // block_rows)
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    shards = graphs.groupBy(F.col("dim").alias("at_dim"), F.col("band").alias("at_band")).agg(F.max("shard").alias("last"))
    asked = wanted.select(F.col("id").alias("query_id"), "vector", "dim", block.alias("block")).join(
        shards, F.col("dim") == F.col("at_dim")
    ).select("query_id", "vector", "dim", F.col("at_band").alias("band"), "block", F.explode(F.sequence(F.lit(0), "last")).alias("shard"))
    offered = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    key = ["dim", "band", "shard", "block"]
    found = offered.groupBy(*key).cogroup(asked.groupBy(*key)).applyInPandas(_searcher(k, ef), FOUND)
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
