"""Approximate nearest neighbours by a robust-pruned directed graph per shard.

Distinct vectors are dealt over shards by hash; a vector's smallest ids stand for all its
copies. In each shard vectors enter a graph in growing batches: a greedy search from the
middle proposes neighbours, and pruning keeps a candidate only if no kept one is closer to it
by the relaxed factor, so edges stay diverse. A query runs a beam search in every shard, and
the best of all shards count. Scores are then exact, in double precision.

The largest inner product is sought. For that, vectors get one more component that brings
all to the same length; the nearest point for a query is then the one of largest product.
A shard holds vectors of one band of lengths, whose lengths differ by a factor of 2 at most,
and lifts them to its own largest one: a very long vector does not drown the others.

A shard has at most ``SHARD_ROWS`` vectors on average and a block of queries ``BLOCK_ROWS``;
shards meet blocks one pair at a time, so no task grows with the table.

Defined cases: vectors that are NULL, zero, or hold NULL or non-finite components take no
part, nor do those of another length than the most common one (the shorter among equals);
repeated rows count once; a row is no neighbour of its own id; other columns are ignored;
an empty table gives an empty result; with fewer candidates all are returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrina.llm.tables import table
from vitrina.session import materialize

NEAREST = 20
DEGREE = 28
BUILD_BEAM = 56
SEARCH_BEAM = 96
#: Factor by which a kept neighbour must be closer to a candidate to prune it.
RELAXED = 1.2
BATCH = 512
#: One size for tables of every size, so a search sees the same share of each shard.
SHARD_ROWS = 5000
BLOCK_ROWS = 20_000
SALTS = 16


def _squares(points: np.ndarray, of: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Squared distances of each row of ``of`` to its row of points."""
    near = points[ids] - of[:, None, :]
    return np.einsum("bcd,bcd->bc", near, near)


def beam_search(
    points: np.ndarray, edges: np.ndarray, start: int, queries: np.ndarray, beam: int
) -> tuple[np.ndarray, np.ndarray]:
    """Per query the ids of the ``beam`` nearest found, nearest first (-1: none), and distances."""
    count = len(queries)
    ids = np.full((count, beam), -1, dtype=np.int64)
    far = np.full((count, beam), np.inf, dtype=np.float32)
    open_ = np.zeros((count, beam), dtype=bool)
    ids[:, 0], open_[:, 0] = start, True
    far[:, 0] = _squares(points, queries, np.full((count, 1), start))[:, 0]
    active = np.arange(count)
    while len(active):
        at = open_[active].argmax(axis=1)  # beams are sorted, so the first open one is nearest
        busy = open_[active, at]
        active, at = active[busy], at[busy]
        if not len(active):
            break
        open_[active, at] = False
        next_ = edges[ids[active, at]]
        seen = (next_[:, :, None] == ids[active][:, None, :]).any(axis=2) | (next_ < 0)
        away = _squares(points, queries[active], np.maximum(next_, 0)).astype(np.float32)
        away[seen] = np.inf
        all_far = np.concatenate([far[active], away], axis=1)
        order = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
        far[active] = np.take_along_axis(all_far, order, axis=1)
        ids[active] = np.take_along_axis(np.concatenate([ids[active], next_], axis=1), order, axis=1)
        fresh = np.concatenate([open_[active], ~seen], axis=1)
        open_[active] = np.take_along_axis(fresh, order, axis=1)
        ids[active] = np.where(np.isinf(far[active]), -1, ids[active])
    return ids, far


def prune(points: np.ndarray, nodes: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """At most ``DEGREE`` diverse neighbours of each node among its candidates (-1: none)."""
    away = _squares(points, points[nodes], np.maximum(candidates, 0)).astype(np.float32)
    away[(candidates < 0) | (candidates == nodes[:, None])] = np.inf
    order = np.argsort(away, axis=1, kind="stable")
    candidates = np.take_along_axis(candidates, order, axis=1)
    away = np.take_along_axis(away, order, axis=1)
    # The same candidate twice has the same distance; the later one goes.
    again = np.zeros(candidates.shape, dtype=bool)
    again[:, 1:] = candidates[:, 1:] == candidates[:, :-1]
    alive = np.isfinite(away) & ~again
    kept = np.full((len(nodes), DEGREE), -1, dtype=np.int64)
    rows = np.arange(len(nodes))
    vectors = points[np.maximum(candidates, 0)]
    for place in range(DEGREE):
        at = alive.argmax(axis=1)
        some = alive[rows, at]
        if not some.any():
            break
        kept[some, place] = candidates[rows, at][some]
        gap = vectors - vectors[rows, at][:, None, :]
        between = np.einsum("bcd,bcd->bc", gap, gap)
        alive &= ~(RELAXED * RELAXED * between <= away)
        alive[rows, at] = False
    return kept


def build(points: np.ndarray, seed: int = 0) -> tuple[np.ndarray, int]:
    """The edges of a graph over the points, and the point at which searches start."""
    count = len(points)
    start = int(np.argmin(((points - points.mean(axis=0)) ** 2).sum(axis=1)))
    edges = np.full((count, DEGREE), -1, dtype=np.int64)
    order = np.random.default_rng(seed).permutation(count)
    order = order[order != start]
    done = 0
    while done < len(order):
        nodes = order[done : done + min(BATCH, max(1, done))]
        done += len(nodes)
        found, _ = beam_search(points, edges, start, points[nodes], BUILD_BEAM)
        edges[nodes] = prune(points, nodes, np.concatenate([found, edges[nodes]], axis=1))
        _add_back(points, edges, nodes)
    return edges, start


def _add_back(points: np.ndarray, edges: np.ndarray, nodes: np.ndarray) -> None:
    """Edges from the neighbours back to the nodes; full lists are pruned."""
    target = edges[nodes].ravel()
    source = np.repeat(nodes, DEGREE)[target >= 0]
    target = target[target >= 0]
    order = np.argsort(target, kind="stable")
    target, source = target[order], source[order]
    first = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]]))
    rank = np.arange(len(target)) - np.repeat(first, np.diff(np.append(first, len(target))))
    # A neighbour of many nodes takes them in turns of at most a list's length.
    for turn in range(int(rank.max(initial=-1)) // DEGREE + 1):
        here = (rank // DEGREE) == turn
        own = np.unique(target[here])
        added = np.full((len(own), DEGREE), -1, dtype=np.int64)
        added[np.searchsorted(own, target[here]), rank[here] % DEGREE] = source[here]
        both = np.concatenate([edges[own], added], axis=1)
        size = (both >= 0).sum(axis=1)
        roomy = size <= DEGREE
        packed = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), axis=1)
        edges[own[roomy]] = packed[roomy, :DEGREE]
        full = own[~roomy]
        if len(full):
            edges[full] = prune(points, full, both[~roomy])


def scaled(vectors: np.ndarray, axis: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Vectors, together or (axis 1) each, divided by a power of two near the largest component.

    The exponents come with them. Only bits below the range of doubles are lost.
    """
    exponent = np.frexp(np.abs(vectors).max(axis=axis, keepdims=True))[1]
    return np.ldexp(vectors, -exponent), exponent


def lifted(vectors: np.ndarray) -> tuple[np.ndarray, float]:
    """Vectors with one more component, so that all have the largest length, and that length."""
    squares = (vectors**2).sum(axis=1)
    rest = np.sqrt(np.maximum(0.0, squares.max() - squares))
    points = np.concatenate([vectors, rest[:, None]], axis=1).astype(np.float32)
    return points, float(np.sqrt(squares.max()))


_GRAPH = "shard int, place int, start int, edges array<int>, embedding array<double>, ids array<bigint>"


def _graph_of(key, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("number", ignore_index=True)
    edges, start = build(lifted(scaled(np.stack(rows["embedding"].to_numpy()))[0])[0])
    return pd.DataFrame({
        "shard": rows["shard"],
        "place": np.arange(len(rows)),
        "start": start,
        "edges": list(edges.astype(np.int32)),
        "embedding": rows["embedding"],
        "ids": rows["ids"],
    })


def _searched(nearest: int):
    def run(key, graph: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if graph.empty or queries.empty:
            return pd.DataFrame({"query_id": [], "score": [], "ids": []})
        graph = graph.sort_values("place", ignore_index=True)
        vectors, exponent = scaled(np.stack(graph["embedding"].to_numpy()))
        points, longest = lifted(vectors)
        edges = np.stack(graph["edges"].to_numpy()).astype(np.int64)
        asked, exponents = scaled(np.stack(queries["embedding"].to_numpy()), axis=1)
        exponents = exponents + exponent
        names, members = queries["query_id"].to_numpy(), graph["ids"].to_numpy()
        smallest = np.array([min(ids) for ids in members])
        # Directions decide, so queries are brought to the length of the points.
        length = np.sqrt((asked**2).sum(axis=1, keepdims=True))
        flat = np.concatenate([asked / length * longest, np.zeros((len(asked), 1))], axis=1)
        query_ids, scores, ids = [], [], []
        for first in range(0, len(asked), BATCH):
            part = slice(first, first + BATCH)
            found, _ = beam_search(
                points, edges, int(graph["start"][0]), flat[part].astype(np.float32), SEARCH_BEAM
            )
            exact = np.einsum("bcd,bd->bc", vectors[np.maximum(found, 0)], asked[part])
            exact[found < 0] = -np.inf
            # Of equal products those with the smaller ids stay.
            best = np.lexsort((smallest[found], -exact), axis=1)[:, : nearest + 1]
            exact = np.ldexp(exact, exponents[part])
            for row, columns in enumerate(best):
                for column in columns:
                    if found[row, column] >= 0:
                        query_ids.append(names[first + row])
                        scores.append(exact[row, column])
                        ids.append(members[found[row, column]])
        return pd.DataFrame({"query_id": query_ids, "score": scores, "ids": ids})

    return run


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``id`` and ``embedding`` in double precision of the rows that take part."""
    rows = vectors.select(
        F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("embedding")
    )
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(
        F.col("id").isNotNull()
        & F.col("embedding").isNotNull()
        & F.coalesce(finite, F.lit(False))
        & F.exists("embedding", lambda x: x != 0.0)
    )
    sizes = rows.groupBy(F.size("embedding").alias("size")).count()
    common = sizes.orderBy(F.desc("count"), "size").first()
    return rows.filter(F.size("embedding") == (common["size"] if common else -1))


def distinct_points(rows: DataFrame, copies: int) -> DataFrame:
    """Distinct vectors with their ``copies`` smallest ids.

    Copies are first thinned out per salt, so a vector of very many rows is no task's load.
    """
    salt = F.pmod(F.xxhash64("id"), F.lit(SALTS))
    thinned = rows.distinct()
    for keys in ([F.col("embedding"), salt], [F.col("embedding")]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("id"))
        thinned = thinned.withColumn("place", place).filter(F.col("place") <= copies).drop("place")
    return thinned.groupBy("embedding").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def shards_of(total: int) -> int:
    """Shards for the vectors of a band."""
    return -(-total // SHARD_ROWS)


def band_of(largest, embedding) -> Column:
    """The power of two nearest to a vector's length, from its ``largest`` component."""
    square = F.aggregate(
        embedding, F.lit(0.0), lambda total, x: total + (x / F.col(largest)) * (x / F.col(largest))
    )
    return F.round(F.log2(largest) + 0.5 * F.log2(square)).cast("int")


def nearest(
    vectors: DataFrame,
    is_query,
    key: str = "vec_id",
    vector: str = "embedding",
    count: int = NEAREST,
) -> DataFrame:
    """``query_id``, ``rank``, ``id`` and ``score`` of the ``count`` nearest rows found."""
    rows = materialize(usable(vectors, key, vector), "vectors")
    points = materialize(
        distinct_points(rows, count + 1)
        .withColumn("number", F.monotonically_increasing_id())
        .withColumn("largest", F.array_max(F.transform("embedding", F.abs))),
        "points",
    )
    banded = points.withColumn("band", band_of("largest", "embedding"))
    # One row a band; doubles have about two thousand at most.
    first, dealt, shards = [], [], 0
    for band, total in sorted(banded.groupBy("band").count().collect()):
        own = shards_of(total)
        first += [F.lit(band), F.lit(shards)]
        dealt += [F.lit(band), F.lit(own)]
        shards += own
    if not shards:
        first, dealt, shards = [F.lit(0)] * 2, [F.lit(0), F.lit(1)], 1

    band = F.col("band")
    place = F.pmod(F.xxhash64("number"), F.create_map(*dealt)[band])
    sharded = banded.withColumn("shard", (F.create_map(*first)[band] + place).cast("int"))
    graph = materialize(sharded.groupBy("shard").applyInPandas(_graph_of, _GRAPH), "graph")
    queries = rows.distinct().filter(is_query(F.col("id"))).withColumnRenamed("id", "query_id")
    blocks = max(1, -(-queries.count() // BLOCK_ROWS))
    asked = queries.select(
        "query_id",
        "embedding",
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("block"),
    )
    held = graph.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = (
        held.groupBy("shard", "block")
        .cogroup(asked.groupBy("shard", "block"))
        .applyInPandas(_searched(count), "query_id bigint, score double, ids array<bigint>")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (
        found.select("query_id", "score", F.explode("ids").alias("id"))
        .filter("id <> query_id")
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= count)
        .select("query_id", "rank", "id", "score")
    )


def op5_graph_search(spark, sf_dir) -> DataFrame:
    """The 20 nearest rows of every row whose id is divisible by 20."""
    found = nearest(table(spark, sf_dir, "embeddings"), lambda key: key % 20 == 0)
    return found.withColumnRenamed("id", "vec_id")


def brute_force(ids: np.ndarray, vectors: np.ndarray, count: int = NEAREST) -> Iterator[tuple]:
    """Query and its nearest ids by all products, for tests and for measuring recall."""
    for row in np.flatnonzero(ids % 20 == 0):
        scores = vectors @ vectors[row]
        order = np.lexsort((ids, -scores))
        yield int(ids[row]), [int(i) for i in ids[order] if i != ids[row]][:count]
