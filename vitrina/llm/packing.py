"""Packing token sequences under several limits at once.

A sequence holds at most ``tokens`` ids, ``segments`` pieces of documents and ``loss``
loss-bearing ids. A document of full length is cut into full sequences; what remains waits
in a buffer. A sequence is filled by the dot-product heuristic of vector bin packing: among
the waiting remainders that fit, the one whose demands point along what is left of the three
limits. When none fits, one is cut to fill the sequence up. A sequence that a limit closes
early, and the last ones of a partition, are cut back to a power of two and the rest waits,
so nothing is padded.

Every partition packs its own documents: no shuffle, memory for one buffer, and a lost task
gives the same pieces and the same sequence numbers again.

Defined cases: a NULL or empty text is the end id alone; repeated rows are packed once each;
NULL keys stay NULL; other columns are ignored; an empty table gives no pieces.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import filterfalse

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from vitrina.llm.tables import id_and_text, table

END_ID = 1
#: Waiting remainders of a task, cached words of a worker.
BUFFER = 1024
CACHED = 1 << 19
#: New words encoded in one call, documents whose new words are looked up together.
TOGETHER = 500
DOCUMENTS = 256


@dataclass(frozen=True)
class Limits:
    """What a sequence holds at most."""

    tokens: int = 2048
    segments: int = 64
    loss: int = 2048


class Words(dict):
    """Ids of words between white space as little-endian bytes.

    The tokenizer drops white space and no token crosses it, so a text's ids are those of
    its words one after the other. Two generations of at most ``CACHED`` words are kept.

    Most new words are letters with punctuation behind them. No token crosses that border
    either, so the letters, in lower case, and the punctuation are looked up apart: "Word",
    "word," and "word." are one run of letters.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # For lower-case letters below U+0300, which the normalizer leaves as they are.
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        vocabulary = self.tokenizer.get_vocab()
        suffix = self.tokenizer.model.end_of_word_suffix
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[number for token, number in vocabulary.items() if token.endswith(suffix)]] = True
        self.older: dict[str, bytes] = {}
        self.runs: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {"": b""}

    def learn(self, words: set[str]) -> None:
        """Makes all ``words`` known, many at a time."""
        if len(self) > CACHED:
            self.older = dict(self)
            self.clear()
        if len(self.runs) > CACHED:
            self.runs.clear()
        if len(self.tails) > CACHED:
            self.tails = {"": b""}
        mixed, cut = [], []
        for word in filterfalse(self.__contains__, words):
            if word in self.older:
                self[word] = self.older[word]
                continue
            letters = word.rstrip(PUNCTUATION)
            run = letters.lower()
            if run.isalpha() and (run.isascii() or max(run) < "\u0300"):
                cut.append((word, run, word[len(letters) :]))
            else:
                mixed.append(word)
        runs, tails = self.runs, self.tails
        self._learn_runs(list({run for _, run, _ in cut if run not in runs}))
        self._learn_mixed(list({tail for _, _, tail in cut if tail not in tails}), tails)
        self._learn_mixed(mixed, self)
        for word, run, tail in cut:
            self[word] = runs[run] + tails[tail]

    def _learn_runs(self, runs: list[str]) -> None:
        """Each run is one word to the tokenizer, so its last id is the only one that ends one."""
        for first in range(0, len(runs), TOGETHER):
            group = runs[first : first + TOGETHER]
            ids = np.array(self.plain.encode(" ".join(group)).ids, dtype="<u4")
            bounds = np.flatnonzero(self.ends[ids]) * 4 + 4
            data, low = ids.tobytes(), 0
            for run, high in zip(group, bounds.tolist(), strict=True):
                self.runs[run] = data[low:high]
                low = high

    def _learn_mixed(self, words: list[str], known: dict[str, bytes]) -> None:
        for first in range(0, len(words), TOGETHER):
            group = words[first : first + TOGETHER]
            encoded = self.tokenizer.encode(" ".join(group), add_special_tokens=False)
            starts = np.cumsum([0, *(len(word) + 1 for word in group)])
            at = np.fromiter((span[0] for span in encoded.offsets), dtype=np.int64)
            bounds = np.searchsorted(at, starts) * 4
            data = np.array(encoded.ids, dtype="<u4").tobytes()
            for word, low, high in zip(group, bounds.tolist(), bounds[1:].tolist()):
                known[word] = data[low:high]


@lru_cache(maxsize=2)
def words_of(path: str) -> Words:
    return Words(path)


#: ASCII that is neither letter, digit nor white space.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Characters at which ``str.split`` cuts although they are no white space to the tokenizer.
ODD = regex.compile("[\x1c-\x1f]")
WHITE = regex.compile(r"[\p{White_Space}]+")


def split(text: str) -> list[str]:
    if ODD.search(text):
        return [word for word in WHITE.split(text) if word]
    return text.split()


def encode_texts(texts: list[str], path: str) -> list[bytes]:
    """Ids of each text with the end id, as little-endian unsigned 32-bit numbers."""
    known = words_of(path)
    end = np.array([END_ID], dtype="<u4").tobytes()
    parts = [split(text) for text in texts]
    known.learn(set().union(*parts))
    return [b"".join(map(known.__getitem__, words)) + end for words in parts]


class Packer:
    """Packs documents one after the other; ``pieces`` holds what is placed."""

    def __init__(self, limits: Limits, first_sequence: int) -> None:
        self.limits, self.next = limits, first_sequence
        self.waiting: list[tuple] = []  # key, ids, start, document's length, prompt
        self.left = np.zeros((0, 2))  # waiting tokens and loss tokens
        self.pieces: list[tuple] = []

    def add(self, key, ids: bytes, prompt: int = 0) -> None:
        """A document whose first ``prompt`` ids bear no loss."""
        count, start = len(ids) // 4, 0
        full = self.limits.tokens
        while count - start >= full and self._loss(start, start + full, prompt) <= self.limits.loss:
            self._emit([((key, ids, start, count, prompt), full)])
            start += full
        if start < count:
            self._wait((key, ids, start, count, prompt))
        while len(self.waiting) > BUFFER:
            self._fill()

    def finish(self) -> None:
        while self.waiting:
            self._fill()

    @staticmethod
    def _loss(start: int, stop: int, prompt: int) -> int:
        return max(0, stop - max(start, prompt))

    def _wait(self, item: tuple) -> None:
        _, _, start, count, prompt = item
        at = len(self.waiting)
        if at >= len(self.left):
            grown = np.zeros((max(BUFFER + 64, 2 * at), 2))
            grown[:at] = self.left[:at]
            self.left = grown
        self.waiting.append(item)
        self.left[at] = count - start, self._loss(start, count, prompt)

    def _take(self, at: int) -> tuple:
        item, last = self.waiting[at], self.waiting.pop()
        if at < len(self.waiting):
            self.waiting[at] = last
            self.left[at] = self.left[len(self.waiting)]
        return item

    def _fill(self) -> None:
        limits = self.limits
        tokens, segments, loss = limits.tokens, limits.segments, limits.loss
        placed: list[tuple[tuple, int]] = []
        while tokens and segments and self.waiting:
            left = self.left[: len(self.waiting)]
            # The demand for a segment is the same for all, so it doesn't rank them.
            along = left @ np.array([tokens / limits.tokens**2, loss / limits.loss**2])
            fits = (left[:, 0] <= tokens) & (left[:, 1] <= loss)
            if fits.any():
                item = self._take(int(np.argmax(np.where(fits, along, -1.0))))
                size = item[3] - item[2]
            else:
                # The longest one is cut, as far as the loss-bearing ids allow.
                item = self._take(int(np.argmax(left[:, 0])))
                _, _, start, count, prompt = item
                size = min(tokens, count - start, max(0, prompt - start) + loss)
                if size < 1:
                    self._wait(item)
                    break
                if start + size < count:
                    self._wait((*item[:2], start + size, *item[3:]))
            start, prompt = item[2], item[4]
            placed.append((item, size))
            tokens, segments = tokens - size, segments - 1
            loss -= self._loss(start, start + size, prompt)
        used = limits.tokens - tokens
        surplus = used - (1 << (used.bit_length() - 1)) if tokens else 0
        while surplus:
            item, size = placed.pop()
            back = min(size, surplus)
            surplus -= back
            if size > back:
                placed.append((item, size - back))
            self._back(item, item[2] + size - back, back)
        self._emit(placed)

    def _back(self, item: tuple, start: int, size: int) -> None:
        """Has a part wait again, together with a waiting rest of its document behind it."""
        key, ids, _, count, prompt = item
        if start + size < count:
            for at, other in enumerate(self.waiting):
                if other[1] is ids and other[2] == start + size:
                    self._take(at)
                    break
        self._wait((key, ids, start, count, prompt))

    def _emit(self, placed: list[tuple[tuple, int]]) -> None:
        offset = 0
        for (key, ids, start, count, _), size in placed:
            data = ids[4 * start : 4 * (start + size)]
            self.pieces.append((key, start, size, data, count, self.next, offset))
            offset += size
        self.next += 1


def pack(
    docs: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    limits: Limits = Limits(),
    prompt: str | None = None,
) -> DataFrame:
    """A row per placed piece: where it lies in its document and in its sequence, and its ids.

    ``ids`` holds little-endian unsigned 32-bit numbers. ``prompt`` names a column with the
    number of leading ids of a document that bear no loss; without it all ids bear loss.
    """
    source = id_and_text(docs, key, text)
    if prompt is not None:
        source = docs.select(
            F.col(key).alias("id"),
            F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
            F.coalesce(F.col(prompt).cast("long"), F.lit(0)).alias("prompt"),
        )
    names = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    kinds = [LongType(), LongType(), BinaryType(), LongType(), LongType(), LongType()]
    fields = [StructField(name, kind) for name, kind in zip(names[1:], kinds)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Sequence numbers of a partition start where no other partition's can be.
        packer = Packer(limits, TaskContext.get().partitionId() << 33)
        kind = None

        def placed() -> pa.RecordBatch:
            columns = list(zip(*packer.pieces))
            packer.pieces = []
            types = [kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(values, of) for values, of in zip(columns, types)], names
            )

        for batch in batches:
            kind = batch.schema.types[0]
            for start in range(0, batch.num_rows, DOCUMENTS):
                part = batch.slice(start, DOCUMENTS)
                keys, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
                prompts = part.column(2).to_pylist() if prompt is not None else [0] * len(keys)
                for one, ids, free in zip(keys, encode_texts(texts, path), prompts):
                    packer.add(one, ids, free)
                if packer.pieces:
                    yield placed()
        packer.finish()
        if packer.pieces:
            yield placed()

    packed = source.mapInArrow(run, StructType([source.schema["id"], *fields]))
    return packed.withColumnRenamed("id", key)


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of the ids."""
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op10_packing(spark, sf_dir) -> DataFrame:
    """Every document's pieces in sequences of at most 2048 ids."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return digest(pack(table(spark, sf_dir, "documents"), path))
