"""Byte-level BPE with vectorised pre-tokenisation, and its decoding.

Pre-tokenisation uses no regular expression. Every code point becomes a symbol (letter,
number, space before a word, ...); a symbol is a transition function over the states "inside
letters", "inside numbers" and so on. Functions compose associatively, so the state before
every code point comes from a blocked prefix scan over numbers of functions, with a
multiplication table of the few functions that compositions can reach. A token starts where
the state says that the symbol does not continue what is open.

The slices between boundaries are merged by rank; merged slices are cached, as the same
words come again and again. Byte offsets of the tokens are kept beside the ids.

Texts are independent: one pass over each partition, no shuffle, and a batch holds a bounded
number of code points besides a text that is longer by itself.

Defined cases: NULL and empty texts give no ids; repeated rows and NULL keys are encoded
like others; other columns are ignored; ids outside of the vocabulary fail on decoding.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from vitrina.llm.tables import id_and_text, table

#: Code points encoded at once, and cached slices of a worker.
CHUNK = 1 << 20
CACHED = 1 << 18
#: Texts decoded at once.
TOGETHER = 256
#: Slices longer than this (bytes) are merged with a heap and not cached.
LONG = 96
BLOCK = 64

LETTER, NUMBER, OTHER, SHORT, LONG_FORM, JOIN, LAST, SPACES, END = range(9)
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_SPACES, JOINED, ONE_MORE, TWO_MORE = range(8)

#: White space of the Unicode standard.
WHITE = (
    [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)]
    + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)


def step(state: int, symbol: int) -> tuple[int, bool]:
    """The state after a symbol and whether a token starts with it."""
    if state == TWO_MORE:
        return ONE_MORE, False
    if state == ONE_MORE:
        return FRESH, False
    runs = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, SPACES: IN_SPACES}
    if symbol in runs:
        joins = state == JOINED and symbol != SPACES
        return runs[symbol], not (joins or state == runs[symbol])
    if symbol in (SHORT, LONG_FORM):
        # An apostrophe inside a run of signs, or after a space, is a sign like others.
        if state in (IN_OTHERS, JOINED):
            return IN_OTHERS, False
        return (ONE_MORE if symbol == SHORT else TWO_MORE), True
    return (JOINED if symbol == JOIN else FRESH), True


class Scan:
    """Tables for the prefix scan: the functions that compositions reach, and their products."""

    def __init__(self) -> None:
        states, symbols = range(8), range(9)
        single = [tuple(step(state, symbol)[0] for state in states) for symbol in symbols]
        found = {tuple(states): 0}
        waiting = [tuple(states)]
        for function in waiting:
            for after in single:
                product = tuple(after[state] for state in function)
                if product not in found:
                    found[product] = len(found)
                    waiting.append(product)
        functions = np.array(waiting, dtype=np.uint8)
        self.size = len(functions)
        self.of_symbol = np.array([found[function] for function in single], dtype=np.int16)
        products = functions[:, functions]  # [second, first, state]
        self.product = np.array(
            [[found[tuple(p)] for p in row] for row in products.transpose(1, 0, 2).tolist()],
            dtype=np.int16,
        ).ravel()  # [first, second]
        self.state = functions.ravel()
        self.starts = np.array(
            [[step(state, symbol)[1] for symbol in symbols] for state in states], dtype=bool
        ).ravel()

    def prefixes(self, functions: np.ndarray) -> np.ndarray:
        """The product of all functions up to each place."""
        count = len(functions)
        if count <= BLOCK:
            out = functions.copy()
            for place in range(1, count):
                out[place] = self.product[int(out[place - 1]) * self.size + int(functions[place])]
            return out
        rows = -(-count // BLOCK)
        padded = np.zeros(rows * BLOCK, dtype=np.int16)
        padded[:count] = functions
        columns = np.ascontiguousarray(padded.reshape(rows, BLOCK).T)
        for place in range(1, BLOCK):
            columns[place] = self.product[
                columns[place - 1].astype(np.int32) * self.size + columns[place]
            ]
        before = np.zeros(rows, dtype=np.int32)
        before[1:] = self.prefixes(columns[-1])[:-1]
        return self.product[before[None, :] * self.size + columns].T.ravel()[:count]

    def boundaries(self, symbols: np.ndarray) -> np.ndarray:
        """Whether a token starts at each symbol; the first one comes at a text's start."""
        after = self.prefixes(self.of_symbol[symbols]).astype(np.int32)
        states = np.zeros(len(symbols), dtype=np.int32)
        states[1:] = self.state[after[:-1] * 8 + FRESH]
        return self.starts[states * 9 + symbols]


@lru_cache(maxsize=1)
def scan() -> Scan:
    return Scan()


@lru_cache(maxsize=1)
def point_classes() -> np.ndarray:
    """LETTER, NUMBER, OTHER or SPACES by code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    classes = np.fromiter(
        (kinds.get(unicodedata.category(chr(point))[0], OTHER) for point in range(0x110000)),
        dtype=np.uint8,
        count=0x110000,
    )
    classes[WHITE] = SPACES
    return classes


def symbols_of(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Symbols of code points; ``ends`` are the places behind the texts."""
    symbols = point_classes()[points]
    symbols[ends] = END
    following = np.append(symbols[1:], END)
    last = (symbols == SPACES) & (following != SPACES) & (following != END)
    symbols[last] = np.where(points[last] == 0x20, JOIN, LAST)
    marks = np.flatnonzero((points == 0x27) & (symbols == OTHER))
    padded = np.append(points, [0, 0])
    first, second = padded[marks + 1], padded[marks + 2]
    symbols[marks[np.isin(first, [ord(c) for c in "stmd"])]] = SHORT
    pairs = first.astype(np.int64) << 32 | second
    symbols[marks[np.isin(pairs, [ord(a) << 32 | ord(b) for a, b in ("re", "ve", "ll")])]] = LONG_FORM
    return symbols


def slices(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """The slices of all texts in order, and the number of slices up to each text's end."""
    joined = "\0".join([*texts, ""])
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ends = np.cumsum([len(text) + 1 for text in texts]) - 1
    places = np.flatnonzero(scan().boundaries(symbols_of(points, ends)))
    last = np.searchsorted(places, ends)  # an end counts as a boundary of its own
    found = places.tolist()
    closing = set(ends.tolist())
    pieces = [joined[a:b] for a, b in zip(found, found[1:]) if a not in closing]
    return pieces, last - np.arange(len(texts))


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a slice: the pair of lowest rank is merged first, the leftmost among equals."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    if len(piece) > LONG:
        return merge_long(piece, ranks)
    never, get = 1 << 60, ranks.get
    bounds = list(range(len(piece) + 1))
    pairs = [get(piece[at : at + 2], never) for at in range(len(piece) - 1)]
    while pairs:
        best = min(pairs)
        if best == never:
            break
        at = pairs.index(best)
        del bounds[at + 1], pairs[at]
        if at < len(pairs):
            pairs[at] = get(piece[bounds[at] : bounds[at + 2]], never)
        if at:
            pairs[at - 1] = get(piece[bounds[at - 1] : bounds[at + 1]], never)
    return [ranks[piece[a:b]] for a, b in zip(bounds, bounds[1:])]


def merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same in n log n steps."""
    size = len(piece)
    end = list(range(1, size + 1))  # of the part that starts here, 0 once merged away
    before = list(range(-1, size - 1))
    heap = []

    def offer(at: int) -> None:
        middle = end[at]
        if middle < size:
            rank = ranks.get(piece[at : end[middle]])
            if rank is not None:
                heapq.heappush(heap, (rank, at, middle, end[middle]))

    for at in range(size - 1):
        offer(at)
    while heap:
        _, at, middle, stop = heapq.heappop(heap)
        if end[at] != middle or end[middle] != stop:
            continue
        end[at], end[middle] = stop, 0
        if stop < size:
            before[stop] = at
        offer(at)
        if before[at] >= 0:
            offer(before[at])
    ids, at = [], 0
    while at < size:
        ids.append(ranks[piece[at : end[at]]])
        at = end[at]
    return ids


class Merged(dict):
    """Ids by slice as 32-bit numbers, two generations of at most ``CACHED`` slices."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = array("i", merge(piece.encode("utf-8", "replace"), self.ranks)).tobytes()
        if len(piece) <= LONG:
            if len(self) >= CACHED:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


@lru_cache(maxsize=2)
def vocabulary(path: str) -> tuple[Merged, list[bytes], np.ndarray]:
    """The cache over the ranks of a file, the bytes by id, and their lengths."""
    with open(path, "rb") as lines:
        ranks = {
            base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)
        }
    by_id = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        by_id[rank] = token
    return Merged(ranks), by_id, np.array([len(token) for token in by_id], dtype=np.int64)


def encode_texts(texts: list[str], path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all texts, their byte offsets in their text, and the ids up to each text's end."""
    merged, _, lengths = vocabulary(path)
    pieces, ends = slices(texts)
    found = list(map(merged.__getitem__, pieces))
    ids = np.frombuffer(b"".join(found), dtype=np.int32)
    upto = np.zeros(len(pieces) + 1, dtype=np.int64)
    np.cumsum(np.fromiter(map(len, found), dtype=np.int64, count=len(found)), out=upto[1:])
    bounds = np.concatenate([[0], upto[ends]]) // 4
    places = np.zeros(len(ids) + 1, dtype=np.int64)
    np.cumsum(lengths[ids], out=places[1:])
    offsets = places[:-1] - np.repeat(places[bounds[:-1]], np.diff(bounds))
    return ids, offsets.astype(np.int32), bounds


def chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts with a bounded number of code points, or of one longer text."""
    start, size = 0, 0
    for at, text in enumerate(texts):
        if size and size + len(text) > CHUNK:
            yield start, at
            start, size = at, 0
        size += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, the token ``ids`` and the byte ``offsets`` at which the tokens start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for start, stop in chunks(texts):
                ids, offsets, bounds = encode_texts(texts[start:stop], path)
                ends = pa.array(bounds, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, stop - start),
                        pa.ListArray.from_arrays(ends, pa.array(ids, pa.int32())),
                        pa.ListArray.from_arrays(ends, pa.array(offsets, pa.int32())),
                    ],
                    ["id", "ids", "offsets"],
                )

    source = id_and_text(docs, key, text)
    numbers = ArrayType(IntegerType())
    schema = StructType(
        [source.schema["id"], StructField("ids", numbers), StructField("offsets", numbers)]
    )
    return source.mapInArrow(run, schema).withColumnRenamed("id", key)


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """Replaces the column ``ids`` by ``decoded``, the bytes of the tokens (NULL ids: none)."""
    place = encoded.columns.index(ids)
    names = [*(name for name in encoded.columns if name != ids), "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, by_id, _ = vocabulary(path)
        for batch in batches:
            column = batch.column(place)
            values, bounds = column.values.to_numpy(), column.offsets.to_numpy()
            for first in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(first, TOGETHER)
                ends = bounds[first : first + TOGETHER + 1]
                texts = [
                    b"".join(map(by_id.__getitem__, values[a:b].tolist()))
                    for a, b in zip(ends, ends[1:])
                ]
                rest = [part.column(at) for at in range(part.num_columns) if at != place]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(texts, pa.binary())], names)

    fields = [field for field in encoded.schema if field.name != ids]
    return encoded.mapInArrow(run, StructType([*fields, StructField("decoded", BinaryType())]))


def op7_byte_bpe(spark, sf_dir) -> DataFrame:
    """Every document's ids, digested, and the digest of what they decode to."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = encode(table(spark, sf_dir, "documents"), path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        "ids",
    )
    return decode(encoded, path).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256")
    )
