"""Jaccard join of n-gram sets by vertical partitioning, and its connected groups.

Every document is the set of its distinct shingles. All sets follow one global order: a part
of the shingles, sampled by hash, comes first, rarer ones before, and the others follow by
hash. The order is cut into ``FRAGMENTS`` intervals, the sampled part and ranges of the rest,
and every set at the same places. Overlaps are counted fragment by fragment and summed per pair.

1. Documents with equal sets are one node. A linked pair shares one of the first shingles of
   both (the prefix filter). The sampled shingles are counted over all documents; a node
   whose prefix holds only shingles of its own can have no link, and goes no further.
2. Fragment after fragment, all shingles of the nodes left are counted. How many of a node's are
   its own bounds every overlap it can have; nodes and pairs that cannot reach a link go. What
   is left are the near copies.
3. In a group of many near copies not every pair is needed to know that it hangs together.
   First each node is compared to two representatives of each shingle it meets others at. A row
   per pair and fragment holds the partial overlap, a grouping sums them, and linked nodes get
   one label.
4. What is left are shingles at which different labels meet. Labels that meet, directly or
   through others, are a block, and the nodes of a block are compared exactly without listing
   their pairs: a block is cut into tiles by size class and hash, two tiles meet in one task, and
   there the partial overlaps of all their pairs are matrices, one a fragment, that add up.
   Sizes that differ by more than a class cannot be linked and never meet. A task sends back
   only as many links as join labels, fewer than it has nodes.
5. Components grow by taking the smallest number of all neighbours and of their roots, on
   tables in the shared folder.

Meetings at one shingle are dealt over ``SALTS`` tasks, and the smallest nodes of those meet
in a second step, so a shingle of a third of all documents is no task's load alone. Counts
combine before they are shuffled. 64-bit hashes stand for shingles.

Defined cases: NULL and empty texts have an empty set and no links; with fewer than
``WORDS`` words the whole sequence is the only shingle; repeated rows have links like other
copies; rows without an id take part and get the smallest id of their group, if any; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrina.llm.tables import discard, id_and_text, row_and_text, table, written
from vitrina.llm.url_cascade import Level, filter_of

WORDS = 5
PERCENT = 80
FRAGMENTS = 8
#: Fragments that are counted at once; their counts are all that is shuffled at a time.
TOGETHER = 2
SALTS = 16
#: Tenths of all shingles, by hash, that come first in the global order and are counted.
SAMPLED = 3
#: Nodes, and shingles, of which a tile has about so many at most.
TILE = 1024
TILE_SHINGLES = 1 << 21
#: Shingles of a tile with more nodes than this are counted by matrix products.
SPARSE = 16
#: Shingles in one such product.
COLUMNS = 2048
#: Bits of the filter over texts with candidates.
FILTER_BITS = 1 << 22
CACHED = 1 << 18


class Words(dict):
    """64-bit hashes of words; starts anew when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_words = Words()


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingles(text: str) -> np.ndarray:
    """Sorted distinct shingle hashes; ``bytes`` lower-cases and splits ASCII only."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    hashes = np.fromiter(map(_words.__getitem__, words), dtype=np.uint64, count=len(words))
    with np.errstate(over="ignore"):
        count = max(1, len(words) - WORDS + 1)
        length = min(WORDS, len(words))
        total = np.full(count, length, dtype=np.uint64)
        for step in range(length):
            total = _mixed(total * np.uint64(0x9E3779B97F4A7C15) + hashes[step : step + count])
    return np.unique(total)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            texts = part.column(part.schema.get_field_index("text")).to_pylist()
            yield part, [shingles(text) for text in texts]


def prefix_length(count: int) -> int:
    """First shingles of which a linked set of any size shares at least one."""
    return count - -(-count * PERCENT // 100) + 1


def _first_of(tokens: np.ndarray) -> tuple[np.ndarray, int]:
    """The sampled shingles, filled up to a prefix with others, and how many are sampled."""
    chosen = tokens % np.uint64(10) < SAMPLED
    sampled, missing = tokens[chosen], prefix_length(len(tokens)) - int(chosen.sum())
    if missing > 0:
        return np.concatenate([sampled, tokens[~chosen][:missing]]), len(sampled)
    return sampled, len(sampled)


def _lists(values: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)])
    flat = np.concatenate(values) if values else np.zeros(0, dtype=np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64)))


def _node_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, sets in _texts(batches):
        firsts = [_first_of(one) if len(one) else (one, 0) for one in sets]
        yield pa.RecordBatch.from_arrays(
            [
                part.column(0),
                part.column(1),
                pa.array([len(one) for one in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(one.tobytes()) for one in sets], pa.binary()),
                _lists([first for first, _ in firsts]),
                pa.array([sampled for _, sampled in firsts], pa.int32()),
            ],
            ["id", "h", "n", "key", "first", "sampled"],
        )


def pieces_of(tokens: np.ndarray) -> list[np.ndarray]:
    """A set cut at fixed places of the global order: the sampled part, then ranges of the rest."""
    rest = FRAGMENTS - 1
    cuts = np.arange(1, rest, dtype=np.uint64) * np.uint64((1 << 64) // rest)
    chosen = tokens % np.uint64(10) < SAMPLED
    others = tokens[~chosen]
    return [tokens[chosen], *np.split(others, np.searchsorted(others, cuts))]


def _token_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The whole set of each text, cut into fragments."""
    for _, sets in _texts(batches):
        keys = [xxhash.xxh3_128_digest(one.tobytes()) for one in sets]
        pieces = [piece for one in sets for piece in pieces_of(one)]
        ends = pa.array(range(0, len(pieces) + 1, FRAGMENTS), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), pa.ListArray.from_arrays(ends, _lists(pieces))],
            ["key", "fragments"],
        )


def _fitting(one: Column, other: Column) -> Column:
    """Whether two nodes may be linked, by their sizes ``n`` and their ``own`` shingles."""
    most = F.least(one["n"] - one["own"], other["n"] - other["own"])
    return 100 * most >= PERCENT * (one["n"] + other["n"] - most)


def _first_pairs(meetings: DataFrame) -> DataFrame:
    """Each node with the nodes of smallest and largest number at each of its shingles.

    Two steps: inside each of ``SALTS`` parts of a shingle, then between the parts' nodes.
    """
    salted = meetings.withColumn("salt", F.pmod("node", F.lit(SALTS)))

    def pairs(window) -> Column:
        node = F.struct("node", "n", "own")
        return F.array(F.min(node).over(window), F.max(node).over(window))

    inside = salted.select(
        "token", "node", "n", "own", "salt", pairs(Window.partitionBy("token", "salt")).alias("ends")
    )
    # One node stands for its part.
    heads = inside.filter(F.col("node") == F.col("ends")[0]["node"]).select("token", "node", "n", "own")
    across = heads.select("token", "node", "n", "own", pairs(Window.partitionBy("token")).alias("ends"))

    def found(table_: DataFrame) -> DataFrame:
        return table_.select("node", F.struct("n", "own").alias("size"), F.explode("ends").alias("end"))

    both = found(inside.filter(F.col("ends")[0]["node"] != F.col("ends")[1]["node"])).unionByName(
        found(across.filter(F.col("ends")[0]["node"] != F.col("ends")[1]["node"]))
    )
    return (
        both.filter((F.col("node") != F.col("end.node")) & _fitting(F.col("size"), F.col("end")))
        .select(
            F.least("node", "end.node").alias("a"), F.greatest("node", "end.node").alias("b")
        )
        .distinct()
    )


def _linked(pairs: DataFrame, fragments: DataFrame, sizes: DataFrame) -> DataFrame:
    """The pairs whose partial overlaps, counted per fragment, sum up to a link."""
    pieces = fragments.select("node", F.posexplode("fragments").alias("fragment", "piece"))
    one = pieces.select(F.col("node").alias("a"), "fragment", F.col("piece").alias("of_a"))
    other = pieces.select(F.col("node").alias("b"), "fragment", F.col("piece").alias("of_b"))
    partial = (
        pairs.join(one, "a")
        .join(other, ["b", "fragment"])
        .select("a", "b", F.size(F.array_intersect("of_a", "of_b")).cast("long").alias("partial"))
    )
    overlaps = partial.groupBy("a", "b").agg(F.sum("partial").alias("overlap"))
    sized = overlaps.join(sizes.select(F.col("node").alias("a"), F.col("n").alias("n_a")), "a").join(
        sizes.select(F.col("node").alias("b"), F.col("n").alias("n_b")), "b"
    )
    union = F.col("n_a") + F.col("n_b") - F.col("overlap")
    return sized.filter(100 * F.col("overlap") >= PERCENT * union).select("a", "b")


def overlaps(owners: list[np.ndarray], tokens: list[np.ndarray], count: int) -> np.ndarray:
    """The overlap of all pairs of ``count`` sets, from the shingles of each fragment and their sets.

    Partial overlaps of a fragment are counted pair by pair at shingles of few sets, and by
    products of indicator matrices at the others; the fragments' counts add up.
    """
    total = np.zeros((count, count), dtype=np.float32)
    for owner, token in zip(owners, tokens):
        order = np.lexsort((owner, token))
        owner, token = owner[order], token[order]
        starts = np.flatnonzero(np.append(True, token[1:] != token[:-1])) if len(token) else token
        lengths = np.diff(np.append(starts, len(token)))
        for length in np.unique(lengths[(lengths > 1) & (lengths <= SPARSE)]).tolist():
            rows = owner[starts[lengths == length][:, None] + np.arange(length)]
            for a in range(length):
                for b in range(a + 1, length):
                    np.add.at(total, (rows[:, a], rows[:, b]), 1)
        large = np.flatnonzero(lengths > SPARSE)
        for first in range(0, len(large), COLUMNS):
            part = large[first : first + COLUMNS]
            held = np.zeros((count, len(part)), dtype=np.float32)
            for column, number in enumerate(part.tolist()):
                held[owner[starts[number] : starts[number] + lengths[number]], column] = 1
            total += np.triu(held @ held.T, 1)
    return total


def joining_links(overlap: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> list[tuple[int, int]]:
    """Links between labels, as few as show which labels hang together."""
    union = sizes[:, None] + sizes[None, :] - overlap
    linked = (100 * overlap >= PERCENT * union) & (overlap > 0) & (labels[:, None] != labels[None, :])
    one, other = np.nonzero(linked)
    pairs = np.unique(np.sort(np.stack([labels[one], labels[other]], axis=1), axis=1), axis=0)
    root: dict[int, int] = {}

    def find(label: int) -> int:
        while root.setdefault(label, label) != label:
            root[label] = root[root[label]]
            label = root[label]
        return label

    joined = []
    for a, b in pairs.tolist():
        x, y = find(a), find(b)
        if x != y:
            root[max(x, y)] = min(x, y)
            joined.append((a, b))
    return joined


def _tile_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between labels inside each pair of tiles; rows are sorted by ``block, low, high``."""
    last, labels, sizes = None, [], []
    owners: list[list[np.ndarray]] = [[] for _ in range(FRAGMENTS)]
    tokens: list[list[np.ndarray]] = [[] for _ in range(FRAGMENTS)]

    def links() -> pa.RecordBatch | None:
        told = np.array(labels, dtype=np.int64)
        if len(told) < 2 or (told == told[0]).all():
            return None
        counted = overlaps([*map(np.concatenate, owners)], [*map(np.concatenate, tokens)], len(told))
        found = joining_links(counted, np.array(sizes, dtype=np.int64), told)
        pairs = np.array(found, dtype=np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    for batch in batches:
        pieces = batch.column(5)
        for row, key in enumerate(zip(*(batch.column(at).to_pylist() for at in range(3)))):
            if key != last:
                if (found := links()) is not None:
                    yield found
                last, labels, sizes = key, [], []
                owners = [[] for _ in range(FRAGMENTS)]
                tokens = [[] for _ in range(FRAGMENTS)]
            for fragment, piece in enumerate(pieces[row].values):
                values = piece.values.to_numpy(zero_copy_only=False)
                owners[fragment].append(np.full(len(values), len(labels), dtype=np.int64))
                tokens[fragment].append(values)
            labels.append(batch.column(3)[row].as_py())
            sizes.append(batch.column(4)[row].as_py())
    if (found := links()) is not None:
        yield found


def _tiles(nodes: DataFrame) -> DataFrame:
    """``node, label, n, block`` with the pairs of tiles ``low`` and ``high`` each node takes part in.

    A block of one tile's size is one tile. Others are cut by size class, a linked pair being in
    one class or in neighbouring ones, and inside a class by hash.
    """
    ratio = F.lit(100 / PERCENT)
    whole = nodes.groupBy("block").agg(F.count(F.lit(1)).alias("nodes"), F.sum("n").alias("shingles"))
    small = (F.col("nodes") <= TILE) & (F.col("shingles") <= TILE_SHINGLES)
    classed = nodes.join(whole.select("block", small.alias("small")), "block").withColumn(
        "class", F.when(F.col("small"), 0).otherwise(F.floor(F.log(F.col("n")) / F.log(ratio))).cast("int")
    )
    parts = classed.groupBy("block", "class").agg(
        F.greatest(
            F.ceil(F.count(F.lit(1)) / TILE), F.ceil(F.sum("n") / TILE_SHINGLES)
        ).cast("int").alias("parts")
    )
    own = classed.join(parts, ["block", "class"]).withColumn(
        "tile", F.struct("class", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"))
    )
    # Floating point may put a pair at the very limit of a class one further away.
    met = parts.select(
        "block", F.col("parts").alias("others"), F.explode(F.expr("sequence(class - 2, class + 2)")).alias("class"),
        F.col("class").alias("other_class"),
    )
    dealt = own.join(met, ["block", "class"]).select(
        "block", "node", "label", "n", "tile", "other_class",
        F.explode(F.expr("sequence(0, others - 1)")).alias("other_part"),
    )
    other = F.struct(F.col("other_class").alias("class"), F.col("other_part").alias("part"))
    return dealt.select(
        "block", F.least("tile", other).alias("low"), F.greatest("tile", other).alias("high"),
        "node", "label", "n",
    )


def _left_links(meetings: DataFrame, labels: DataFrame, fragments: DataFrame) -> DataFrame:
    """Links between the labels that meet at a shingle, as few as join what hangs together."""
    named = meetings.join(labels, "node")
    mixed = (
        named.groupBy("token")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"))
        .filter("low <> high")
    )
    open_ = written(
        named.join(mixed.select("token", "low"), "token").groupBy("node", "label", "n").agg(
            F.collect_set("low").alias("lows")
        ),
        "open",
    )
    edges = open_.select(F.col("label").alias("a"), F.explode("lows").alias("b")).filter("a <> b").distinct()
    blocks = components(edges).select(F.col("node").alias("label"), F.col("label").alias("block"))
    tiled = _tiles(open_.select("node", "label", "n").join(blocks, "label"))
    key = ["block", "low", "high"]
    rows = tiled.join(fragments, "node").select(*key, "label", "n", "fragments")
    return rows.repartition(*key).sortWithinPartitions(*key).mapInArrow(_tile_links, "a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node that its links reach, for all linked nodes.

    Rounds of two steps: every node's edges go to its smallest neighbour; then labels of
    labels are followed. Each round is a table; rounds grow with the logarithm of the longest
    path.
    """
    edges = written(links.select("a", "b").distinct(), "links")
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = written(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")),
        "labels",
    )
    while True:
        # The smallest label at either end of each edge, then the label of that label.
        near = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        told = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("low"))
        # What a node learns, its former root learns too.
        root = told.groupBy(F.col("label").alias("node")).agg(F.min("low").alias("root_low"))
        told = told.join(root, "node", "left").select(
            "node", "label", F.least("low", "root_low").alias("low")
        )
        jump = told.select(F.col("node").alias("low"), F.col("low").alias("far"))
        fresh = written(
            told.join(jump, "low", "left").select(
                "node", F.least("low", F.coalesce("far", "low")).alias("label"), F.col("label").alias("old")
            ),
            "labels",
        )
        if fresh.filter("label <> old").isEmpty():
            return fresh.select("node", "label")
        labels = fresh.select("node", "label")


def _prefix() -> Column:
    """``prefix_length`` of the column ``n``."""
    return F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1


def _chosen(keys: DataFrame, seed: int) -> Level:
    """A filter of bounded size over the column ``key``; fuller ones only let more through."""
    count = max(1, keys.count())
    return filter_of(keys, count, min(10.0, FILTER_BITS / count), seed)


def _alive(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """The nodes whose prefix holds a sampled shingle that another row has too."""
    # Sampled shingles that only one row has; those of copied sets count as shared.
    lone = (
        rows.select("node", F.explode(F.slice("first", 1, F.col("sampled"))).alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("node").alias("node"))
        .filter("rows = 1")
        .groupBy("node")
        .agg(F.count(F.lit(1)).alias("lone"))
    )
    return nodes.select("node", "n").join(lone, "node", "left").filter(
        F.coalesce("lone", F.lit(0)) < _prefix()
    ).select("node", "n")


def _with_own(alive: DataFrame, fragments: DataFrame) -> DataFrame:
    """The nodes with fewer shingles of their ``own`` than a prefix, counted fragment-wise."""
    parts = None
    for first in range(0, FRAGMENTS, TOGETHER):
        own = (
            fragments.select("node", F.slice("fragments", first + 1, TOGETHER).alias("some"))
            .select("node", F.explode(F.flatten("some")).alias("token"))
            .groupBy("token")
            .agg(F.count(F.lit(1)).alias("nodes"), F.min("node").alias("node"))
            .filter("nodes = 1")
            .groupBy("node")
            .agg(F.count(F.lit(1)).alias("own"))
        )
        own = written(own, "own")
        parts = own if parts is None else parts.unionByName(own)
    total = parts.groupBy("node").agg(F.sum("own").alias("own"))
    counted = alive.join(total, "node", "left").select(
        "node", "n", F.coalesce("own", F.lit(0)).cast("long").alias("own")
    )
    return counted.filter(F.col("own") < _prefix())


def _meetings(rows: DataFrame, left: DataFrame) -> DataFrame:
    """``token``, ``node``, ``n`` and ``own`` for shared shingles in the prefixes of nodes."""
    filled = _chosen(left.select(F.col("node").alias("key")), 29)
    listed = written(
        rows.filter(filled.holds(F.col("node")))
        .select("node", "first", "sampled")
        .join(left, "node")
        .select("node", "n", "own", "sampled", F.posexplode("first").alias("place", "token")),
        "first-shingles",
    )
    often = listed.groupBy("token").agg(F.count(F.lit(1)).alias("nodes")).filter("nodes > 1")
    shared = listed.join(often, "token").withColumn("counted", F.col("place") < F.col("sampled"))
    by_node = Window.partitionBy("node")
    order = by_node.orderBy(F.desc("counted"), "nodes", "token")
    # Sampled shingles that no other node here has stand before the shared ones.
    before = F.col("sampled") - F.sum(F.col("counted").cast("int")).over(by_node)
    ranked = shared.withColumn("rank", F.row_number().over(order)).withColumn("before", before)
    return ranked.filter(
        ~F.col("counted") | (F.col("rank") + F.col("before") <= _prefix())
    ).select("token", "node", "n", "own")


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``n_shingles`` and ``component_id`` of every document.

    Also its ``group``, NULL without shingles, a number ``node`` of its own, and ``h``, a hash of
    its text.
    """
    texts = id_and_text(docs, key, text)
    id_type = texts.schema["id"].dataType.simpleString()
    sets = written(
        texts.select("id", F.xxhash64("text").alias("h"), "text")
        .mapInArrow(
            _node_rows,
            f"id {id_type}, h bigint, n bigint, key binary, first array<bigint>, sampled int",
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "sets",
    )
    rows = written(sets.select("id", "h", "n", "key", "node"), "rows")
    # One node per distinct set, numbered by one of its rows.
    nodes = written(
        rows.filter("n > 0")
        .groupBy("key")
        .agg(F.min("node").alias("node"), F.min("id").alias("smallest"), F.first("n").alias("n")),
        "nodes",
    )
    sizes = nodes.select("node", "n")
    alive = written(_alive(sets, nodes), "alive")

    # Whole sets are made again for the nodes left, and only for those.
    left = nodes.join(alive.select("node"), "node", "left_semi")
    wanted = rows.select("node", "h").join(alive, "node", "left_semi").select(F.col("h").alias("key"))
    chosen = _chosen(wanted, 23)
    again = (
        texts.select("text")
        .filter(chosen.holds(F.xxhash64("text")))
        .groupBy(F.xxhash64("text").alias("h"), F.md5("text").alias("digest"))
        .agg(F.first("text").alias("text"))
        .select("text")
        .mapInArrow(_token_rows, "key binary, fragments array<array<bigint>>")
    )
    # Several texts may have one set.
    fragments = written(
        again.join(left.select("key", "node"), "key")
        .groupBy("node")
        .agg(F.first("fragments").alias("fragments")),
        "fragments",
    )
    counted = written(_with_own(alive, fragments), "counted")
    meetings = written(_meetings(sets, counted), "meetings")
    discard(sets)

    first = written(_first_pairs(meetings), "pairs")
    links = written(_linked(first, fragments, sizes), "links")
    discard(first)

    def labelled(found: DataFrame) -> DataFrame:
        return sizes.select("node").join(components(found), "node", "left").select(
            "node", F.coalesce("label", "node").alias("label")
        )

    labels = written(labelled(links), "labelled")
    more = written(_left_links(meetings, labels, fragments), "links")
    if not more.isEmpty():
        # Labels are nodes, and joined by links between their nodes.
        labels = labelled(links.unionByName(more))
    # The smallest id of a component, over the smallest ids of its nodes.
    named = nodes.join(labels, "node")
    smallest = named.groupBy("label").agg(F.min("smallest").alias("component_id"))
    by_key = written(
        named.join(smallest, "label").select("key", "component_id", F.col("label").alias("group")),
        "components",
    )
    for table_ in (meetings, fragments, links, more):
        discard(table_)
    return rows.join(by_key, "key", "left").select(
        "id",
        "h",
        "node",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "id").alias("component_id"),
        "group",
    )


def one_of_each_group(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group, that of smallest id, NULL last; all documents without shingles.

    Rows of a group that have the chosen id and text stay only once; of several texts under the
    chosen id the one whose row was numbered first stays.
    """
    judged = written(groups(docs, key, text).select("id", "h", "node", "group"), "judged")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "node", "h")
    chosen = judged.filter("group IS NOT NULL").groupBy("group").agg(F.min(order).alias("first"))
    kept = chosen.select("first.id", "first.h", F.lit(True).alias("once")).unionByName(
        judged.filter("group IS NULL").select("id", "h", F.lit(False).alias("once")).distinct()
    )
    numbered = row_and_text(docs, text).select(
        "row", F.col(f"row.{key}").alias("own_id"), F.xxhash64("text").alias("own_h")
    )
    same = numbered["own_id"].eqNullSafe(kept["id"]) & (numbered["own_h"] == kept["h"])
    stay = numbered.join(kept, same)
    once = stay.filter("once").dropDuplicates(["own_id", "own_h"])
    return stay.filter("NOT once").unionByName(once).select("row.*")


def op8_shingle_join(spark, sf_dir) -> DataFrame:
    """Every document's number of shingles and the smallest id of its group."""
    return groups(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id"
    )


def brute_force(rows: list[tuple[int, str | None]]) -> dict[int, tuple[int, int]]:
    """The same by comparing all pairs that share a shingle, for tests."""
    sets, where = {}, {}
    for one, text in rows:
        words = (text or "").encode().lower().split()
        if len(words) < WORDS:
            sets[one] = {tuple(words)} if words else set()
        else:
            sets[one] = {tuple(words[at : at + WORDS]) for at in range(len(words) - WORDS + 1)}
        for shingle in sets[one]:
            where.setdefault(shingle, []).append(one)
    root = {one: one for one in sets}

    def find(one: int) -> int:
        while root[one] != one:
            one = root[one]
        return one

    for a in sets:
        shared: dict[int, int] = {}
        for shingle in sets[a]:
            for b in where[shingle]:
                shared[b] = shared.get(b, 0) + 1
        for b, overlap in shared.items():
            if b > a and 100 * overlap >= PERCENT * (len(sets[a]) + len(sets[b]) - overlap):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {one: (len(sets[one]), find(one)) for one in sets}
