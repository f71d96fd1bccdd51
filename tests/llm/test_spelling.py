"""Spelling variants against plain loops over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from vitrina.llm import spelling_variants as sv


def plain_words(rows):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            check = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if check % 199 == 0:
                run = run[: check % len(run)] + run[check % len(run) + 1 :]
            counts[run] += 1
    return {word: n for word, n in counts.items() if n >= 5 and len(word) >= 6}


def plain_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain(words):
    forms, found = {}, []
    for word, n in words.items():
        near = [other for other in words if other != word and plain_near(word, other)]
        best = min(near, key=lambda one: (-words[one], one), default=None)
        if best is not None and words[best] >= 5 * n:
            forms[word] = best
        found.append((word, n, len(near)))
    rows = []
    for word, n, near in found:
        root = word
        while root in forms:
            root = forms[root]
        rows.append((word, forms.get(word), root, n, near, words[forms[word]] if word in forms else None))
    return sorted(rows, key=str)


def made_words(count, letters, lengths, seed):
    random_ = random.Random(seed)
    words = {"".join(random_.choice(letters) for _ in range(random_.choice(lengths))) for _ in range(count)}
    return {word: random_.choice([5, 6, 30, 31, 200, 1100, 6000]) for word in sorted(words)}


@pytest.mark.parametrize("tile", [8, 4096])
@pytest.mark.parametrize("letters, lengths", [("ab", [6, 7, 8, 9]), ("aàÿ×", [6, 7]), ("abcdefgh", [6, 6, 7, 12])])
def test_near_words_forms_and_roots(spark, letters, lengths, tile):
    words = made_words(300, letters, lengths, 3)
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    forms = sv.near_words(frame, tile)
    ends = {row.word: row.root for row in sv.roots(forms).collect()}
    got = [
        (row.word, row.form, ends.get(row.word, row.word), row.n, row.n_near, row.form_n)
        for row in forms.collect()
    ]
    assert sorted(got, key=str) == plain(words)


def documents():
    random_ = random.Random(17)
    vocabulary = [*made_words(60, "abé", [6, 7, 8], 4), "Straße", "ÉTUDES", "étudeS", "short", "x" * 3000]
    rows = [
        (key, " ".join(random_.choice(vocabulary) + random_.choice(["", "1", ",", "!"]) for _ in range(60)))
        for key in range(400)
    ]
    return rows + [(1000, None), (1001, ""), (None, rows[0][1]), (3, rows[5][1]), (3, rows[5][1])]


def test_documents_with_slips(spark, monkeypatch):
    monkeypatch.setattr(sv, "PIECE", 100)
    rows = documents()
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "'w' AS word", "1 AS n", "2 AS key", "3 AS tile", "4 AS form"
    )
    got = sorted(map(tuple, sv.variants(frame).collect()), key=str)
    want = plain(plain_words(rows))
    assert got == want and len(want) > 30
    assert sv.variants(frame.limit(0)).collect() == []


def test_pieces_hold_the_whole_text(monkeypatch):
    monkeypatch.setattr(sv, "PIECE", 7)
    text = "eins zwei, dreivierfünf " * 9 + "schluss"
    assert "".join(sv.pieces(text)) == text
    assert [run for one in sv.pieces(text) for run in sv.RUN.findall(one)] == sv.RUN.findall(text)
