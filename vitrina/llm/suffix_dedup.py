"""Removal of byte strings that occur twice, by sorting suffixes block by block.

Every byte that lies in a string of ``SPAN`` bytes starting at two places or more is removed.

1. Which suffixes can matter: in each window of ``SPAN`` bytes the piece of ``GRAM`` bytes
   with the smallest hash is its anchor, chosen by the window's content alone. Equal windows
   have equal anchors, so only windows whose anchor value occurs twice are looked at.
2. The windows of one anchor value are a bucket of suffixes. Buckets are dealt out by Spark
   and arrive in order; as many as fit into a bounded block are sorted at a time. In a block
   the suffixes at the residues of a difference cover are ranked first, by doubling. Two
   suffixes then need a few bytes up to the next cover place, and the rank found there
   resolves any tie, however long. Neighbours in that order are compared byte by byte.
3. A bucket with more than ``HOT`` suffix groups is not sorted in one task. Its windows are
   split into runs; equal runs are merged before any shuffle, runs whose common middle is
   unique are dropped, and the few others are counted window by window.
4. Spans found are joined to the texts by digest. A Bloom filter of fixed size over the
   digests keeps all other texts from being shuffled.

Copies of a whole text are one text here; they are removed as a whole.

Defined cases: a NULL or empty text has no bytes and keeps none; a text shorter than
``SPAN`` bytes keeps all; repeated rows are copies of each other; NULL keys are kept; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrina.llm.tables import discard, id_and_text, table, written
from vitrina.llm.url_cascade import Level, filter_of

SPAN = 200
GRAM = 40
#: Bytes of the buckets that are sorted at a time. A bucket of up to ``HOT`` suffix groups, of at
#: most 360 bytes each, is a block of its own in the worst case; a larger one is split.
BLOCK_BYTES = 1 << 20
HOT = 1 << 15
#: Windows in a run of a split bucket.
RUN = 16
#: Bits of the filter over digests; a fuller filter only lets more texts through.
FILTER_BITS = 1 << 22
PERIOD = 32


def difference_cover(period: int) -> list[int]:
    """Residues such that every difference modulo ``period`` occurs between two of them."""
    cover, missing = [0], set(range(1, period))
    while missing:
        def gained(residue: int) -> set[int]:
            return {(residue - other) % period for other in cover} | {
                (other - residue) % period for other in cover
            }

        best = max(range(period), key=lambda residue: len(gained(residue) & missing))
        missing -= gained(best)
        cover.append(best)
    return sorted(cover)


COVER = np.array(difference_cover(PERIOD))
#: Bytes from a residue to the next cover place.
TO_COVER = np.array([min((c - r) % PERIOD for c in COVER.tolist()) for r in range(PERIOD)])

_MULTIPLIER = 0x9E3779B97F4A7C15
_VALUES = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def gram_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """A mixed rolling hash of every ``length`` bytes, by doubling."""
    part, span, whole, done = _VALUES[data], 1, None, 0
    with np.errstate(over="ignore"):
        while True:
            if length & span:
                if whole is None:
                    whole, done = part, span
                else:
                    count = min(len(whole), len(part) - done)
                    factor = np.uint64(pow(_MULTIPLIER, span, 1 << 64))
                    whole = whole[:count] * factor + part[done : done + count]
                    done += span
            if done == length:
                break
            factor = np.uint64(pow(_MULTIPLIER, span, 1 << 64))
            part = part[:-span] * factor + part[span:]
            span *= 2
        whole = whole ^ (whole >> np.uint64(29))
        whole = whole * np.uint64(0xBF58476D1CE4E5B9)
        return whole ^ (whole >> np.uint64(32))


def anchors_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, anchor place and anchor hash of every run of windows with one anchor."""
    windows = len(data) - SPAN + 1
    if windows < 1:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none.astype(np.uint64)
    hashes = gram_hashes(data, GRAM)
    width, span = SPAN - GRAM + 1, 1
    least = np.arange(len(hashes))
    while 2 * span <= width:
        left, right = least[:-span], least[span:]
        least = np.where(hashes[left] <= hashes[right], left, right)
        span *= 2
    left, right = least[:windows], least[width - span : width - span + windows]
    place = np.where(hashes[left] <= hashes[right], left, right)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    return first, place[first], hashes[place[first]]


def _bytes(column: pa.Array, at: int) -> bytes:
    return column[at].as_py().encode("utf-8", "replace")


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text its size and the hashes of its anchors."""
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            found, bounds, sizes = [], [0], []
            for at in range(part.num_rows):
                data = np.frombuffer(_bytes(part.column(1), at), dtype=np.uint8)
                hashes = anchors_of(data)[2]
                found.append(hashes)
                bounds.append(bounds[-1] + len(hashes))
                sizes.append(len(data))
            flat = np.concatenate(found).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat)),
                ],
                ["digest", "n_bytes", "anchors"],
            )


_PLACED = (
    "digest binary, anchor bigint, offset int, context binary, firsts array<int>, "
    "run bigint, core bigint, windows array<bigint>, place int"
)


def _signed(data: bytes) -> int:
    value = xxhash.xxh3_64_intdigest(data)
    return value - (1 << 64) if value >> 63 else value


def _context_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The suffix groups of wanted anchors: all windows of an anchor in one string of bytes.

    Groups of a text that are alike come once, with all their places. Of hot anchors come
    runs of windows instead: hashes of the run, of its middle and of each window.
    """
    names = ["digest", "anchor", "offset", "context", "firsts", "run", "core", "windows", "place"]
    kinds = [pa.binary(), pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int32())] + [
        pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32()
    ]
    for batch in batches:
        rows: list[tuple] = []
        for at in range(batch.num_rows):
            digest, raw = batch.column(0)[at].as_py(), _bytes(batch.column(1), at)
            wanted = dict(zip(batch.column(2)[at].as_py(), batch.column(3)[at].as_py()))
            first, place, hashes = anchors_of(np.frombuffer(raw, dtype=np.uint8))
            behind = np.append(first[1:], len(raw) - SPAN + 1)
            groups: dict[tuple, list[int]] = {}
            for low, high, anchor, value in zip(
                first.tolist(), behind.tolist(), place.tolist(), hashes.view(np.int64).tolist()
            ):
                hot = wanted.get(value)
                if hot is None:
                    continue
                if not hot:
                    key = (value, anchor - low, raw[low : high + SPAN - 1])
                    groups.setdefault(key, []).append(low)
                    continue
                # Runs are cut by the distance to the anchor, so equal windows share a cut
                # and the bytes that all windows between two cuts have in common.
                start = low
                while start < high:
                    cut = anchor - (anchor - start) // RUN * RUN
                    stop = min(high, cut + 1)
                    rows.append((
                        digest, value, None, None, None,
                        _signed(raw[start : stop + SPAN - 1]),
                        _signed(raw[cut : cut + SPAN - RUN + 1]),
                        [_signed(raw[p : p + SPAN]) for p in range(start, stop)],
                        start,
                    ))
                    start = stop
            rows += [
                (digest, value, offset, context, firsts, None, None, None, None)
                for (value, offset, context), firsts in groups.items()
            ]
            if len(rows) >= 2048:
                yield _batch(rows, kinds, names)
                rows = []
        if rows:
            yield _batch(rows, kinds, names)


def _batch(rows: list[tuple], kinds: list, names: list[str]) -> pa.RecordBatch:
    columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(columns, names)


def cover_ranks(data: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Ranks of the suffixes at cover places, exact for 256 bytes; 0 elsewhere.

    ``words`` holds the eight bytes from each place on. The cover repeats with its period,
    so the place one period on has a rank too, and ranks double their depth.
    """
    count = len(data)
    periods = np.arange(0, count, PERIOD)
    places = (periods[:, None] + COVER[None, :]).ravel()
    places = places[places < count]
    ranks = np.zeros(count + 8 * PERIOD, dtype=np.int64)
    padded = np.concatenate([words, np.zeros(PERIOD, dtype=np.uint64)])
    keys = [padded[places + step] for step in range(0, PERIOD, 8)]
    depth = PERIOD
    while True:
        order = np.lexsort(keys[::-1])
        fresh = np.zeros(len(places), dtype=bool)
        for key in keys:
            ordered = key[order]
            fresh[1:] |= ordered[1:] != ordered[:-1]
        ranks[places[order]] = np.cumsum(fresh) + 1
        if depth >= 256:
            return ranks
        keys = [ranks[places], ranks[places + depth]]
        depth *= 2


def repeated_windows(groups: list[tuple[int, int, bytes]]) -> list[np.ndarray]:
    """For distinct suffix groups (anchor, offset, bytes): which of their windows occur twice.

    The groups are laid out so that their anchors have the same residue; equal windows then
    meet the cover after the same number of bytes.
    """
    starts, size = [], 0
    for _, offset, context in groups:
        size += (-size - offset) % PERIOD
        starts.append(size)
        size += len(context)
    data = np.zeros(size + SPAN + 8 * PERIOD, dtype=np.uint8)
    for start, (_, _, context) in zip(starts, groups):
        data[start : start + len(context)] = np.frombuffer(context, dtype=np.uint8)
    words = np.zeros(len(data), dtype=np.uint64)
    for step in range(8):
        words[: len(data) - step] |= data[step:].astype(np.uint64) << np.uint64(56 - 8 * step)
    ranks = cover_ranks(data, words)

    counts = np.array([len(context) - SPAN + 1 for _, _, context in groups])
    group = np.repeat(np.arange(len(groups), dtype=np.int32), counts)
    inside = np.arange(len(group), dtype=np.int32)
    inside -= np.repeat((np.cumsum(counts) - counts).astype(np.int32), counts)
    place = np.array(starts, dtype=np.int32)[group] + inside
    buckets = {value: number for number, value in enumerate({value for value, _, _ in groups})}
    bucket = np.array([buckets[value] for value, _, _ in groups])[group]
    distance = np.array([offset for _, offset, _ in groups])[group] - inside
    # One suffix class per bucket and distance to the anchor.
    kind = bucket * (2 * SPAN) + distance
    del group, inside, bucket, distance
    gap = TO_COVER[place % PERIOD]
    keys = [ranks[place + gap]]
    for step in range(0, int(TO_COVER.max()), 8):
        used = np.clip(gap - step, 0, 8).astype(np.uint64) * np.uint64(8)
        mask = np.where(used > 0, ~np.uint64(0) << (np.uint64(64) - np.maximum(used, 1)), np.uint64(0))
        keys.append(words[place + step] & mask)
    keys.append(kind)
    order = np.lexsort(keys)

    same = np.zeros(len(order), dtype=bool)
    left, right = order[:-1], order[1:]
    close = np.flatnonzero((kind[left] == kind[right]) & (words[place[left]] == words[place[right]]))
    for step in range(8, SPAN, 8):
        equal = words[place[left[close]] + step] == words[place[right[close]] + step]
        close = close[equal]
    same[left[close]] = True
    same[right[close]] = True
    return np.split(same, np.cumsum(counts)[:-1])


def _runs(flags: np.ndarray) -> tuple[list[int], list[int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    return edges[::2].tolist(), edges[1::2].tolist()


def _sorted_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated spans of texts, from suffix groups that arrive bucket by bucket."""
    names = ["digest", "starts", "ends"]
    kinds = [pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32())]
    held: dict[tuple, list[tuple]] = {}
    size = 0

    def spans() -> list[tuple]:
        groups = list(held)
        out = []
        for key, flags in zip(groups, repeated_windows(groups)):
            owners = held[key]
            if len(owners) > 1 or len(owners[0][1]) > 1:
                flags = np.ones(len(flags), dtype=bool)
            if flags.any():
                lows, highs = _runs(flags)
                for digest, firsts in owners:
                    out.append((
                        digest,
                        [first + low for first in firsts for low in lows],
                        [first + high - 1 + SPAN for first in firsts for high in highs],
                    ))
        return out

    last = None
    for batch in batches:
        columns = [batch.column(at).to_pylist() for at in range(batch.num_columns)]
        for digest, anchor, offset, context, firsts in zip(*columns):
            if size >= BLOCK_BYTES and anchor != last:
                if rows := spans():
                    yield _batch(rows, kinds, names)
                held, size = {}, 0
            owners = held.setdefault((anchor, offset, context), [])
            size += 0 if owners else len(context) + 64
            owners.append((digest, firsts))
            last = anchor
    if held and (rows := spans()):
        yield _batch(rows, kinds, names)


_SPANS = "digest binary, starts array<int>, ends array<int>"


def _hot_spans(runs: DataFrame) -> DataFrame:
    """Repeated spans of split buckets; equal runs merge before every shuffle."""
    classes = runs.groupBy("run").agg(
        F.count(F.lit(1)).alias("times"),
        F.first("core").alias("core"),
        F.first("windows").alias("windows"),
    )
    cores = classes.groupBy("core").agg(F.sum("times").alias("alike")).filter("alike > 1")
    open_classes = classes.join(cores, "core", "left_semi")
    counted = (
        open_classes.select("run", "times", F.posexplode("windows").alias("at", "window"))
    )
    twice = counted.groupBy("window").agg(F.sum("times").alias("times")).filter("times > 1")
    repeated = (
        counted.drop("times")
        .join(twice.select("window"), "window", "left_semi")
        .groupBy("run")
        .agg(F.sort_array(F.collect_list("at")).alias("at"))
    )
    found = runs.select("digest", "run", "place").join(repeated, "run")
    return found.select(
        "digest",
        F.transform("at", lambda at: (F.col("place") + at).cast("int")).alias("starts"),
        F.transform("at", lambda at: (F.col("place") + at + SPAN).cast("int")).alias("ends"),
    )


def _digest() -> F.Column:
    return F.unhex(F.md5("text"))


def _number() -> F.Column:
    return F.xxhash64("text")


def _holding(keys: DataFrame) -> Level:
    """A filter of bounded size over the column ``key``."""
    count = max(1, keys.count())
    return filter_of(keys, count, min(10.0, FILTER_BITS / count), 17)


def repeated_spans(texts: DataFrame) -> tuple[DataFrame, Level]:
    """``digest``, ``starts`` and ``ends`` of repeated strings, and a filter over their texts.

    ``texts`` has the column ``text``. Copies of a text have one row.
    """
    texts = texts.select("text").filter(F.octet_length("text") >= SPAN)
    anchored = written(
        texts.select(_digest().alias("digest"), "text").mapInArrow(
            _anchor_rows, "digest binary, n_bytes bigint, anchors array<bigint>"
        ),
        "anchors",
    )
    copies = anchored.groupBy("digest").agg(
        F.count(F.lit(1)).alias("copies"), F.first("n_bytes").alias("n_bytes")
    )
    # Anchors of one text for all its copies; a text may hold an anchor many times.
    anchors = (
        anchored.groupBy("digest")
        .agg(F.first("anchors").alias("anchors"))
        .select("digest", F.explode("anchors").alias("anchor"))
        .groupBy("digest", "anchor")
        .agg(F.count(F.lit(1)).alias("times"))
    )
    often = anchors.groupBy("anchor").agg(F.sum("times").alias("times")).filter("times > 1")
    wanted = written(
        anchors.drop("times")
        .join(often.select("anchor", (F.col("times") > HOT).alias("hot")), "anchor")
        .groupBy("digest")
        .agg(F.collect_list("anchor").alias("anchors"), F.collect_list("hot").alias("hot")),
        "wanted",
    )
    # Only texts with a wanted anchor are read again, and one of each group of copies.
    chosen = _holding(wanted.select(F.xxhash64("digest").alias("key")))
    again = (
        texts.select(_digest().alias("digest"), "text")
        .filter(chosen.holds(F.xxhash64("digest")))
        .groupBy("digest")
        .agg(F.first("text").alias("text"))
    )
    placed = written(
        again.join(wanted, "digest")
        .select("digest", "text", "anchors", "hot")
        .mapInArrow(_context_rows, _PLACED),
        "suffixes",
    )
    sorted_spans = (
        placed.filter("context IS NOT NULL")
        .select("digest", "anchor", "offset", "context", "firsts")
        .repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(_sorted_blocks, _SPANS)
    )
    runs = placed.filter("run IS NOT NULL")
    whole = copies.filter("copies > 1").select(
        "digest",
        F.array(F.lit(0)).alias("starts"),
        F.array(F.col("n_bytes").cast("int")).alias("ends"),
    )
    spans = written(
        sorted_spans.unionByName(_hot_spans(runs))
        .unionByName(whole)
        .groupBy("digest")
        .agg(
            F.flatten(F.collect_list("starts")).alias("starts"),
            F.flatten(F.collect_list("ends")).alias("ends"),
        ),
        "spans",
    )
    for table_ in (anchored, wanted, placed):
        discard(table_)
    return spans, _holding(spans.select(F.xxhash64("digest").alias("key")))


def whole_characters(raw: bytes, gone: np.ndarray) -> np.ndarray:
    """``gone`` with all other bytes of each UTF-8 character that loses one."""
    first = (np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80
    character = np.cumsum(first) - 1
    split = np.zeros(len(raw), dtype=bool)
    split[character[gone]] = True
    return split[character]


def _removal_rows(batches: Iterator[pa.RecordBatch], whole: bool = False) -> Iterator[pa.RecordBatch]:
    """Replaces the text and its spans by sizes and the bytes that are kept."""
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            place = {name: at for at, name in enumerate(part.schema.names)}
            removed, spans, kept = [], [], []
            for at in range(part.num_rows):
                raw = _bytes(part.column(place["text"]), at)
                lows = np.array(part.column(place["starts"])[at].as_py() or [], dtype=np.int64)
                highs = np.array(part.column(place["ends"])[at].as_py() or [], dtype=np.int64)
                change = np.zeros(len(raw) + 1, dtype=np.int64)
                np.add.at(change, lows, 1)
                np.add.at(change, highs, -1)
                gone = np.cumsum(change[:-1]) > 0
                removed.append(int(gone.sum()))
                spans.append(int(np.count_nonzero(np.diff(np.concatenate([[0], gone.view(np.int8)])) == 1)))
                if whole:
                    gone = whole_characters(raw, gone)
                kept.append(np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(place["row"]),
                    pa.array(removed, pa.int64()),
                    pa.array(spans, pa.int64()),
                    pa.array(kept, pa.binary()),
                ],
                ["row", "n_removed", "n_spans", "kept"],
            )


def without_repeats(texts: DataFrame, characters: bool = False) -> DataFrame:
    """``row`` of every text with ``n_bytes``, ``n_removed``, ``n_spans`` and the ``kept`` bytes.

    With ``characters`` the rest of a character that is cut is not kept either, so ``kept`` is
    UTF-8; the counts are of the repeated bytes all the same.
    """
    spans, filled = repeated_spans(texts)
    sized = texts.select(
        F.struct("row", F.octet_length("text").cast("long").alias("n_bytes")).alias("row"),
        "text",
        _digest().alias("digest"),
    ).withColumn("listed", filled.holds(F.xxhash64("digest")))
    touched = sized.filter("listed").join(spans, "digest", "left").select(
        "row", "text", "starts", "ends"
    )
    fields = touched.select("row").schema
    cut = touched.mapInArrow(
        partial(_removal_rows, whole=characters),
        fields.add("n_removed", "long").add("n_spans", "long").add("kept", "binary"),
    )
    whole = sized.filter("NOT listed").select(
        "row",
        F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"),
        F.encode("text", "UTF-8").alias("kept"),
    )
    return whole.unionByName(cut).select("row.row", "row.n_bytes", "n_removed", "n_spans", "kept")


def op6_suffix_dedup(spark, sf_dir) -> DataFrame:
    """What is left of every document without repeated strings."""
    docs = id_and_text(table(spark, sf_dir, "documents"), "doc_id", "text")
    left = without_repeats(docs.select(F.struct(F.col("id").alias("doc_id")).alias("row"), "text"))
    return left.select(
        "row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def brute_force(texts: list[str | None]) -> list[tuple[int, int, int, str]]:
    """The same by a dictionary of all windows, for tests."""
    data = [(text or "").encode() for text in texts]
    seen: dict[bytes, int] = {}
    for raw in data:
        for at in range(len(raw) - SPAN + 1):
            window = raw[at : at + SPAN]
            seen[window] = seen.get(window, 0) + 1
    out = []
    for raw in data:
        gone = [False] * len(raw)
        for at in range(len(raw) - SPAN + 1):
            if seen[raw[at : at + SPAN]] > 1:
                gone[at : at + SPAN] = [True] * SPAN
        spans = sum(here and not before for before, here in zip([False, *gone], gone))
        kept = bytes(byte for byte, dropped in zip(raw, gone) if not dropped)
        out.append((len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out
