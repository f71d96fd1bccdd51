"""Clusters of integer vectors around centroids, with distances counted on bit planes.

A vector of 64 integers is kept as its bit planes: plane ``p`` is one 64-bit number whose bit
``c`` is bit ``p`` of component ``c`` in two's complement. The product of two vectors is then

    sum over planes p, q of  weight(p) * weight(q) * popcount(plane p AND plane q)

with weight 2^p, negative for the highest plane. Squared distances follow from three such
products and are exact. The planes are packed once and written; every round reads them,
assigns vectors in blocks and counts, per centroid and plane, how many of its vectors have
each bit. These counts add up over tasks in Spark, and the exact sum of a component is the
weighted sum of its counts, so a round moves a fixed number of rows per task, however many
vectors a centroid has. Only centroids and their counts reach the driver: ``k`` times the
number of planes, whatever the size of the table.

Defined cases: vectors that are NULL, of another length than 64, or hold a NULL or a
component whose 256-fold is not finite are left out; with fewer vectors than centroids every
vector starts one; rows that repeat are separate vectors, equal ids start in the order of
their components, NULL ids last; a distance or sum beyond a long is NULL, and every other
value is still exact; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrina.llm.tables import discard, table, written

COMPONENTS = 64
SCALE = 256
CENTROIDS = 40
ROUNDS = 5
#: Vectors compared to all centroids at a time.
BLOCK = 4096
LONGEST = (1 << 63) - 1
#: Products of this many planes on both sides together still fit in a long.
PLANES_IN_LONG = 54


def usable(vector: Column) -> Column:
    """Whether a vector has 64 components, all of them numbers."""
    return (F.size(vector) == COMPONENTS) & F.forall(
        vector, lambda x: x.isNotNull() & (F.abs(x.cast("double") * SCALE) < float("inf"))
    )


def integers(values: np.ndarray) -> np.ndarray:
    """``floor(256 * x)``, as longs if they fit and else as Python's integers."""
    scaled = np.floor(np.asarray(values, dtype=np.float64) * SCALE)
    if scaled.size == 0 or np.abs(scaled).max() < 2.0**62:
        return scaled.astype(np.int64)
    return np.array([[int(x) for x in row] for row in scaled], dtype=object)


def pack(numbers: np.ndarray, planes: int) -> np.ndarray:
    """The bit planes of rows of 64 integers, one column a plane, lowest first."""
    last = planes - 1 if numbers.dtype == object else 62
    packed = np.empty((len(numbers), planes), dtype=np.uint64)
    for plane in range(planes):
        bits = ((numbers >> min(plane, last)) & 1).astype(np.uint8)
        packed[:, plane] = np.packbits(bits, axis=1, bitorder="little").view("<u8")[:, 0]
    return packed


def weights(planes: int) -> list[int]:
    """What a set bit of each plane is worth; the highest plane is the sign."""
    return [-(1 << p) if p == planes - 1 else 1 << p for p in range(planes)]


def _needed(packed: np.ndarray) -> np.ndarray:
    """Without the highest planes that only repeat the sign."""
    planes = packed.shape[1]
    while planes > 1 and np.array_equal(packed[:, planes - 1], packed[:, planes - 2]):
        planes -= 1
    return packed[:, :planes]


def products(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Exact products of packed vectors; ``one`` and ``other`` may broadcast over rows."""
    p, q = one.shape[-1], other.shape[-1]
    exact = np.int64 if p + q <= PLANES_IN_LONG else object
    total = np.zeros(np.broadcast_shapes(one.shape[:-1], other.shape[:-1]), dtype=exact)
    for i, x in enumerate(weights(p)):
        for j, y in enumerate(weights(q)):
            common = np.bitwise_count(one[..., i] & other[..., j])
            total += common.astype(exact) * (x * y)
    return total


def nearest(packed: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector, the first of several, and its squared distance."""
    packed, centroids = _needed(packed), _needed(centroids)
    cross = products(packed[:, None, :], centroids[None, :, :])
    squares = products(centroids, centroids)[None, :] - 2 * cross
    chosen = np.argmin(squares, axis=1)
    return chosen, squares[np.arange(len(packed)), chosen] + products(packed, packed)


def _planes_of(part: pa.RecordBatch, planes: int) -> np.ndarray:
    flat = part.column(part.schema.get_field_index("planes")).flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64).view(np.uint64).reshape(part.num_rows, planes)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            yield batch.slice(start, BLOCK)


def _packer(planes: int):
    def pack_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _blocks(batches):
            flat = part.column(1).flatten().to_numpy(zero_copy_only=False)
            packed = pack(integers(flat.reshape(part.num_rows, COMPONENTS)), planes)
            ends = pa.array(np.arange(part.num_rows + 1) * planes, pa.int32())
            lists = pa.ListArray.from_arrays(ends, pa.array(packed.reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays([part.column(0), lists], ["id", "planes"])

    return pack_rows


def _counter(centroids: np.ndarray, planes: int):
    """Per task: for each centroid and plane, how often each bit is set in its vectors."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(centroids)
        members = np.zeros(k, dtype=np.int64)
        bits_set = np.zeros((k, planes, COMPONENTS), dtype=np.int64)
        for part in _blocks(batches):
            packed = _planes_of(part, planes)
            chosen, _ = nearest(packed, centroids)
            own = (chosen[None, :] == np.arange(k)[:, None]).astype(np.float32)
            bits = np.unpackbits(packed.view(np.uint8), axis=1, bitorder="little")
            members += np.bincount(chosen, minlength=k)
            # At most BLOCK ones are added, so the products are exact.
            bits_set += (own @ bits.astype(np.float32)).astype(np.int64).reshape(k, planes, COMPONENTS)
        found = np.flatnonzero(members)
        if not len(found):
            return
        ends = pa.array(np.arange(len(found) * COMPONENTS + 1) * planes, pa.int32())
        by_component = bits_set[found].transpose(0, 2, 1).reshape(-1)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(found, COMPONENTS), pa.int32()),
                pa.array(np.tile(np.arange(COMPONENTS), len(found)), pa.int32()),
                pa.array(np.repeat(members[found], COMPONENTS), pa.int64()),
                pa.ListArray.from_arrays(ends, pa.array(by_component)),
            ],
            ["cluster", "component", "members", "bits"],
        )

    return count


def _assigner(centroids: np.ndarray, planes: int):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _blocks(batches):
            chosen, far = nearest(_planes_of(part, planes), centroids)
            told = [int(x) if x <= LONGEST else None for x in far.tolist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(chosen, pa.int32()), pa.array(told, pa.int64())],
                ["id", "cluster", "distance"],
            )

    return assign


def _moved(packed: DataFrame, centroids: list[list[int]], planes: int) -> list[list[int]]:
    """Each centroid as the exact floor of the mean of the vectors nearest to it."""
    counted = packed.mapInArrow(
        _counter(pack(_matrix(centroids), planes), planes),
        "cluster int, component int, members bigint, bits array<bigint>",
    )
    sums = [F.sum(F.col("bits")[p]).alias(f"p{p}") for p in range(planes)]
    rows = counted.groupBy("cluster", "component").agg(F.sum("members").alias("members"), *sums).collect()
    worth, totals, members = weights(planes), {}, {}
    for row in rows:
        total = totals.setdefault(row.cluster, [0] * COMPONENTS)
        total[row.component] = sum(worth[p] * row[f"p{p}"] for p in range(planes))
        members[row.cluster] = row.members
    return [
        [x // members[k] for x in totals[k]] if k in members else old
        for k, old in enumerate(centroids)
    ]


def _matrix(rows: list[list[int]]) -> np.ndarray:
    fits = all(abs(x) < 1 << 62 for row in rows for x in row)
    return np.array(rows, dtype=np.int64 if fits else object).reshape(len(rows), COMPONENTS)


def clusters(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    seed: int = 2,
) -> tuple[DataFrame, list[list[int]]]:
    """``id``, ``cluster`` and ``distance`` of every usable vector, and the final centroids.

    The first centroids are the ``k`` vectors with the smallest SHA-256 of ``seed:id``.
    """
    kept = vectors.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("x"))
    kept = kept.filter(usable(F.col("x")))
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = kept.orderBy(drawn.asc_nulls_last(), "x").limit(k).select("x").collect()
    centroids = [integers(np.array([row.x]))[0].tolist() for row in first]
    largest = F.max(F.array_max(F.transform("x", lambda x: F.abs(x * SCALE))))
    planes = int(np.ceil(kept.agg(largest).first()[0] or 0)).bit_length() + 1
    id_type = kept.schema["id"].dataType.simpleString()
    if not centroids:
        none = kept.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return none.limit(0), []
    packed = written(kept.mapInArrow(_packer(planes), f"id {id_type}, planes array<bigint>"), "planes")
    for _ in range(rounds):
        centroids = _moved(packed, centroids, planes)
    found = written(
        packed.mapInArrow(
            _assigner(pack(_matrix(centroids), planes), planes),
            f"id {id_type}, cluster int, distance bigint",
        ),
        "clusters",
    )
    discard(packed)
    return found, centroids


def with_inertia(found: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """Adds the summed distances of the cluster and of all, and the centroid's digest."""
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    whole = F.when(F.count("distance") == F.count(F.lit(1)), exact)
    # A row for each centroid that has vectors: their number is a parameter.
    sums = {row.cluster: row.own for row in found.groupBy("cluster").agg(whole.alias("own")).collect()}
    known = all(own is not None for own in sums.values())
    every = _in_long(sum(map(int, sums.values()))) if known else None
    rows = [
        (k, None if own is None else _in_long(int(own)), every, _digest(centroids[k]))
        for k, own in sums.items()
    ]
    about = found.sparkSession.createDataFrame(
        rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    )
    return found.join(F.broadcast(about), "cluster").select(
        "id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _in_long(number: int) -> int | None:
    return number if number <= LONGEST else None


def _digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def op12_popcount_clusters(spark, sf_dir) -> DataFrame:
    """Every usable vector's cluster, squared distance, inertias and centroid digest."""
    found, centroids = clusters(table(spark, sf_dir, "embeddings"))
    return with_inertia(found, centroids).withColumnRenamed("id", "vec_id")


def _round_sql(number: int) -> str:
    """One assignment and, from it, the centroids of the next round."""
    return f"""
a{number} AS MATERIALIZED (
  SELECT rid, any_value(vec_id) AS vec_id, any_value(v) AS v,
         min(list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))
             * 1000 + cluster) AS best
  FROM kept, c{number} GROUP BY rid),
s{number} AS (
  SELECT best % 1000 AS cluster, i, sum(v[i]) AS s, count(*) AS n
  FROM a{number}, range(1, {COMPONENTS + 1}) AS t(i) GROUP BY ALL),
m{number} AS (
  SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM s{number} GROUP BY cluster),
c{number + 1} AS MATERIALIZED (
  SELECT o.cluster, coalesce(m.c, o.c) AS c
  FROM c{number} AS o LEFT JOIN m{number} AS m ON m.cluster = o.cluster),"""


OP12_SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id,
         list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS HUGEINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {COMPONENTS}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {COMPONENTS}),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || CAST(vec_id AS VARCHAR)), v) - 1 AS cluster, v AS c
  FROM kept QUALIFY cluster < {CENTROIDS}),
{"".join(_round_sql(number) for number in range(ROUNDS + 1))}
told AS (SELECT vec_id, best % 1000 AS cluster, best // 1000 AS distance FROM a{ROUNDS})
SELECT vec_id, CAST(t.cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
       CAST(sum(distance) OVER (PARTITION BY t.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM told AS t JOIN c{ROUNDS} AS c ON c.cluster = t.cluster
"""
