"""Spelling variants: frequent words one edit apart, grouped under the most frequent spelling.

1. Each task counts the words of its documents and emits one row per word and flush; Spark adds
   them up. Words that are long and frequent enough are the vocabulary.
2. Two words one edit apart have lengths that differ by at most one, and the edit leaves the
   first half of the shorter word in place or the second. So a word goes to the blocks of its
   first and of its last half, as a word of the block's length and as one letter longer.
3. Inside blocks NumPy multiplies matrices of letter counts. The Gram matrix gives the squared
   distance of all pairs of counts; one edit changes it by two at most. The few pairs left are
   compared letter by letter. Small blocks share one product, a block beyond ``TILE`` words is
   cut into tiles, each pair of which is a product of its own, so no task holds a whole block.
4. A product sends back one row per word: how many near words it found, and the most frequent.
   The pair is counted in the block of the first half if that is common, so in one block only.
5. A form is five times as frequent as its word at least, so chains of forms are short; they are
   followed by doubling.

Defined cases: NULL and empty texts have no words; a NULL id is written as an empty text in the
checksum; documents that repeat count each time; ties between forms go to the smaller word in
code-point order; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrina.llm.tables import discard, table, written

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: One run in so many, by checksum, loses a letter.
SLIP = 199
SHORTEST = 6
LEAST = 5
TIMES = 5
#: Code points read at a time from one text, and words counted before a task sends them on.
PIECE = 1 << 20
COUNTED = 1 << 18
#: Words in one tile of a large block, and in one product of small ones.
TILE = 2048
TOGETHER = 1024
#: Letters compared at a time.
CELLS = 1 << 22
#: Column of each letter in a matrix of letter counts; words hold no code point above 255.
LETTERS = [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]


def pieces(text: str) -> Iterator[str]:
    """A long text in parts that end where a run ends."""
    at = 0
    while at < len(text):
        end = at + PIECE
        if end < len(text):
            cut = RUN.match(text, end)
            end = cut.end() if cut else end
        yield text[at:end]
        at = end


def words_of(key: str, text: str) -> Counter:
    """The words of one document with their numbers, slips made."""
    runs: Counter = Counter()
    for piece in pieces(text):
        runs.update(RUN.findall(piece.translate(LOWER)))
    found: Counter = Counter()
    start = zlib.crc32(f"{key}:".encode())
    for run, times in runs.items():
        check = zlib.crc32(run.encode(), start)
        if check % SLIP == 0:
            place = check % len(run)
            run = run[:place] + run[place + 1 :]
        if len(run) >= SHORTEST:
            found[run] += times
    return found


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"]
        )

    for batch in batches:
        keys, texts = batch.column(0), batch.column(1)
        for at in range(batch.num_rows):
            if texts[at].is_valid:
                counts.update(words_of(keys[at].as_py() or "", texts[at].as_py()))
                if len(counts) >= COUNTED:
                    yield rows()
                    counts.clear()
    if counts:
        yield rows()


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word`` and ``n`` of all words that are long and frequent enough."""
    texts = docs.select(F.col(key).cast("string").alias("key"), F.col(text).cast("string").alias("text"))
    counted = texts.mapInArrow(_count_words, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST)


def one_edit(words: list[bytes], one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether each pair differs by one edit; ``one`` is never longer, ``other`` one more at most."""
    lengths = np.array([len(word) for word in words])
    result = np.zeros(len(one), dtype=bool)
    for length, longer in {*zip(lengths[one].tolist(), lengths[other].tolist())}:
        group = np.flatnonzero((lengths[one] == length) & (lengths[other] == longer))
        step = max(1, CELLS // (length + 1))
        for start in range(0, len(group), step):
            part = group[start : start + step]

            def letters(numbers: np.ndarray, size: int) -> np.ndarray:
                joined = b"".join(words[number] for number in numbers.tolist())
                return np.frombuffer(joined, dtype=np.uint8).reshape(len(numbers), size)

            a, b = letters(one[part], length), letters(other[part], longer)
            if length == longer:
                result[part] = (a != b).sum(axis=1) == 1
            else:
                before = np.logical_and.accumulate(a == b[:, :length], axis=1).sum(axis=1)
                after = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
                result[part] = before + after >= length
    return result


def near_pairs(
    words: list[bytes], groups: np.ndarray, sides: np.ndarray, sizes: np.ndarray, tiles: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of all near pairs of one product, the shorter word first.

    ``groups`` tells blocks and pairs of tiles apart, ``sizes`` is the length of a block's
    shorter words, and of two different ``tiles`` only pairs between them are wanted.
    """
    lengths = np.array([len(word) for word in words])
    joined = np.frombuffer(b"".join(words), dtype=np.uint8)
    column = np.zeros(256, dtype=np.int64)
    column[LETTERS] = np.arange(len(LETTERS))
    owner = np.repeat(np.arange(len(words)), lengths)
    cells = np.bincount(owner * len(LETTERS) + column[joined], minlength=len(words) * len(LETTERS))
    counts = cells.reshape(len(words), len(LETTERS)).astype(np.float64)
    squares = (counts * counts).sum(axis=1)
    # Exact: all numbers are integers far below 2^53.
    close = squares[:, None] + squares[None, :] - 2 * (counts @ counts.T) <= 2
    close &= (groups[:, None] == groups[None, :]) & (tiles[:, None] != tiles[None, :])
    # The shorter word has the block's length; of equal ones the first in the block comes first.
    short = lengths == sizes
    first = np.arange(len(words))
    close &= short[:, None] & (~short[None, :] | (first[:, None] < first[None, :]))
    one, other = np.nonzero(close)
    half = sizes[one] // 2
    common = np.array(
        [words[a][:cut] == words[b][:cut] for a, b, cut in zip(one.tolist(), other.tolist(), half.tolist())],
        dtype=bool,
    )
    wanted = common == (sides[one] == 0)
    one, other = one[wanted], other[wanted]
    near = one_edit(words, one, other)
    return one[near], other[near]


def _found(words: list[bytes], times: np.ndarray, one: np.ndarray, other: np.ndarray) -> pa.RecordBatch:
    """One row per word with its number of near words and the most frequent of them."""
    own, far = np.concatenate([one, other]), np.concatenate([other, one])
    rank = np.empty(len(words), dtype=np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((rank[far], -times[far], own))
    own, far = own[order], far[order]
    starts = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else own
    near = np.diff(np.append(starts, len(own)))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([words[number].decode("latin-1") for number in own[starts].tolist()], pa.string()),
            pa.array(near, pa.int64()),
            pa.array(times[far[starts]], pa.int64()),
            pa.array([words[number].decode("latin-1") for number in far[starts].tolist()], pa.string()),
        ],
        ["word", "near", "form_n", "form"],
    )


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Products over rows that are sorted by block: ``size, side, half, low, high, tile, word, n``."""
    words, times, groups, sides, sizes, tiles = [], [], [], [], [], []
    last, number, starts = None, 0, 0

    def product() -> pa.RecordBatch | None:
        if len(words) < 2:
            return None
        tile = np.array(tiles, dtype=np.int64)
        # Without tiles all pairs of a block are wanted, so every word is a tile of its own.
        alone = tile < 0
        tile[alone] = -1 - np.arange(len(tile))[alone]
        pairs = near_pairs(words, np.array(groups), np.array(sides), np.array(sizes), tile)
        return _found(words, np.array(times, dtype=np.int64), *pairs) if len(pairs[0]) else None

    for batch in batches:
        for size, side, half, low, high, tile, word, n in zip(*(c.to_pylist() for c in batch.columns)):
            block = (size, side, half, low, high)
            if block != last:
                if last is not None and len(words) - starts < 2:
                    # A block of one word has no pairs.
                    for values in (words, times, groups, sides, sizes, tiles):
                        del values[starts:]
                if len(words) >= TOGETHER:
                    found = product()
                    if found is not None:
                        yield found
                    for values in (words, times, groups, sides, sizes, tiles):
                        values.clear()
                last, number, starts = block, number + 1, len(words)
            words.append(word.encode("latin-1"))
            times.append(n)
            groups.append(number)
            sides.append(side)
            sizes.append(size)
            tiles.append(-1 if low == high else tile)
    found = product()
    if found is not None:
        yield found


def _blocks(words: DataFrame) -> DataFrame:
    """Each word once per block: by either half, as one of its length and as one longer."""
    length = F.length("word")
    roles = [
        F.struct(
            size.alias("size"),
            F.lit(side).alias("side"),
            F.xxhash64(
                F.substring("word", F.lit(1), F.floor(size / 2).cast("int"))
                if side == 0
                else F.expr(f"right(word, length(word) - {less} - int((length(word) - {less}) div 2))")
            ).alias("half"),
        )
        for less, size in ((0, length), (1, length - 1))
        for side in (0, 1)
    ]
    return words.select("word", "n", F.explode(F.array(*roles)).alias("block")).select("word", "n", "block.*")


def _tiled(blocks: DataFrame, tile: int) -> DataFrame:
    """Blocks with pairs of tiles ``low`` and ``high``; a small block is one tile."""
    by = ["size", "side", "half"]
    large = blocks.groupBy(by).agg(F.count(F.lit(1)).alias("words")).filter(F.col("words") > tile)
    large = large.withColumn("tiles", F.ceil(F.col("words") / tile).cast("int")).drop("words")
    named = blocks.join(large, by, "left").withColumn(
        "tile", F.pmod(F.xxhash64("word"), F.coalesce("tiles", F.lit(1))).cast("int")
    )
    others = F.explode(F.sequence(F.lit(0), F.coalesce("tiles", F.lit(1)) - 1)).alias("other")
    return named.select(*by, "tile", "word", "n", others).select(
        *by, F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "tile", "word", "n"
    )


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """``word, n, n_near, form, form_n`` for a vocabulary of distinct words and their numbers."""
    key = ["size", "side", "half", "low", "high"]
    dealt = _tiled(_blocks(words), tile).repartition(*key).sortWithinPartitions(*key)
    found = dealt.mapInArrow(_compare, "word string, near bigint, form_n bigint, form string")
    best = F.struct((-F.col("form_n")).alias("less"), F.col("form"))
    both = words.select("word", "n", F.lit(0).cast("long").alias("near"), F.lit(None).alias("best")).unionByName(
        found.select("word", F.lit(None).alias("n"), "near", best.alias("best")), allowMissingColumns=True
    )
    grouped = both.groupBy("word").agg(
        F.max("n").alias("n"), F.sum("near").alias("n_near"), F.min("best").alias("best")
    )
    chosen = -F.col("best.less") >= TIMES * F.col("n")
    return grouped.select(
        "word",
        "n",
        "n_near",
        F.when(chosen, F.col("best.form")).alias("form"),
        F.when(chosen, -F.col("best.less")).alias("form_n"),
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` of all words that have a form, following forms to the last.

    A step doubles the part of each chain that is followed.
    """
    known = written(forms.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        further = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        fresh = written(
            known.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"),
            "roots",
        )
        discard(known)
        known = fresh.select("word", "root")
        if fresh.filter("next IS NOT NULL").isEmpty():
            return known


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the vocabulary."""
    words = written(vocabulary(docs, key, text), "vocabulary")
    forms = written(near_words(words), "forms")
    discard(words)
    return forms.join(roots(forms), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op11_spelling_variants(spark, sf_dir) -> DataFrame:
    """Every frequent word with its near words, its form and its root."""
    return variants(table(spark, sf_dir, "documents"))


def _checksums() -> list[int]:
    """The table of CRC-32, from its polynomial."""
    made = []
    for byte in range(256):
        for _ in range(8):
            byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
        made.append(byte)
    return made


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OP11_SQL = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, w, count(*) AS k
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'),
                                                 '[A-Za-zÀ-ÿ]+')) AS w FROM documents)
  GROUP BY doc_id, w),
hexed AS (SELECT w, k, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w)) AS x FROM runs),
checked AS (
  SELECT w, k, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, len(x), 2),
      lambda i: CAST('0x' || substr(x, i + 1, 2) AS BIGINT))),
      lambda c, b: xor(c >> 8, CAST({_checksums()} AS BIGINT[])[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM hexed),
made AS (
  SELECT CASE WHEN h % {SLIP} = 0
    THEN substr(w, 1, CAST(h % len(w) AS INTEGER)) || substr(w, CAST(h % len(w) AS INTEGER) + 2) ELSE w END AS w, k
  FROM checked),
words AS MATERIALIZED (
  SELECT w AS word, CAST(sum(k) AS BIGINT) AS n FROM made
  WHERE len(w) >= {SHORTEST} GROUP BY w HAVING sum(k) >= {LEAST}),
shorter AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS s
  FROM (SELECT word, n, CAST(unnest(range(len(word))) AS INTEGER) AS i FROM words)),
near AS MATERIALIZED (
  SELECT a.word, b.word AS other, b.n AS m FROM shorter AS a JOIN shorter AS b
    ON a.s = b.s AND a.i = b.i AND a.word <> b.word
  UNION SELECT s.word, w.word, w.n FROM shorter AS s JOIN words AS w ON w.word = s.s
  UNION SELECT w.word, s.word, s.n FROM shorter AS s JOIN words AS w ON w.word = s.s),
best AS MATERIALIZED (
  SELECT word, count(*) AS n_near, first(other ORDER BY m DESC, other) AS other, max(m) AS m
  FROM near GROUP BY word),
forms AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= {TIMES} * w.n THEN other END AS form,
         CASE WHEN m >= {TIMES} * w.n THEN m END AS form_n
  FROM words AS w LEFT JOIN best AS b ON b.word = w.word),
chains AS (
  SELECT word, word AS root, 0 AS step FROM forms
  UNION ALL SELECT c.word, f.form, step + 1 FROM chains AS c JOIN forms AS f ON f.word = c.root
  WHERE f.form IS NOT NULL)
SELECT f.word, form, c.root, n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n
FROM forms AS f JOIN (SELECT word, arg_max(root, step) AS root FROM chains GROUP BY word) AS c ON c.word = f.word
"""
