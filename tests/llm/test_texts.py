"""The operators on texts against brute force, libraries and planted cases."""

import base64
import hashlib
import random
import re
import tempfile
import zlib

import numpy as np
import pytest
import public_tokenizers
import tiktoken
from pyspark.sql import Row
from tokenizers import Tokenizer

from vitrina.llm import byte_bpe, license_scan, packing, pii, shingle_join, suffix_dedup, toxicity
from vitrina.llm.registry import LLM_QUERIES
from vitrina.llm.tables import with_settings

SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return {row.doc_id: row.text or "" for row in rows}


def result(spark, name):
    return LLM_QUERIES[name](spark, SF).collect()


def odd_texts(count=400):
    random_ = random.Random(11)
    parts = ["a", "Zé", "'", "'s", "'re", " ", "  ", "\n", "\t", "1", "²", "!", "日", "　"]
    parts += [" ", "ß", "́", "😀", "\x1c", "​", "٣", " ", "Σ"]
    made = ["".join(random_.choice(parts) for _ in range(random_.randint(0, 40))) for _ in range(count)]
    return ["", "x" * 5000, " " * 300, "'s's ''s", *made]


def test_byte_bpe_is_what_the_library_gives():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    texts = odd_texts()
    ids, offsets, bounds = byte_bpe.encode_texts(texts, RANKS)
    by_id = byte_bpe.vocabulary(RANKS)[1]
    for text, low, high in zip(texts, bounds, bounds[1:]):
        own = ids[low:high].tolist()
        assert own == library.encode_ordinary(text)
        raw = text.encode()
        assert b"".join(by_id[one] for one in own) == raw
        for one, at in zip(own, offsets[low:high].tolist()):
            assert raw[at : at + len(by_id[one])] == by_id[one]


def test_long_slices_merge_alike():
    ranks = byte_bpe.vocabulary(RANKS)[0].ranks
    random_ = random.Random(2)
    for _ in range(30):
        piece = bytes(random_.choice(b"abetho ") for _ in range(90))
        assert byte_bpe.merge_long(piece, ranks) == byte_bpe.merge(piece, ranks)


def test_byte_bpe_query_round_trip(spark, docs):
    rows = result(spark, "op7_byte_bpe")
    assert len(rows) == len(docs)
    for row in rows:
        assert row.decoded_sha256 == hashlib.sha256(docs[row.doc_id].encode()).hexdigest()


def test_packing_places_every_id_once(spark, docs):
    library = Tokenizer.from_file(WORDS)
    rows = result(spark, "op10_packing")
    pieces, sequences = {}, {}
    for row in rows:
        pieces.setdefault(row.doc_id, []).append(row)
        sequences.setdefault(row.sequence_id, []).append(row)
    assert set(pieces) == set(docs)
    for doc, text in docs.items():
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 1], dtype="<u4")
        at = 0
        for row in sorted(pieces[doc], key=lambda row: row.start):
            assert (row.start, row.doc_tokens) == (at, len(ids))
            assert row.ids_crc32 == zlib.crc32(ids[at : at + row.length].tobytes())
            at += row.length
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for row in sorted(parts, key=lambda row: row.offset):
            assert row.offset == at
            at += row.length
        # Nothing is padded: a power of two ids.
        assert at <= 2048 and at & (at - 1) == 0


def test_word_ids_are_those_of_the_whole_text():
    library = Tokenizer.from_file(WORDS)
    library.encode_special_tokens = True
    texts = odd_texts()
    for text, own in zip(texts, packing.encode_texts(texts, WORDS)):
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own, dtype="<u4").tolist() == [*ids, 1]


def test_words_are_letters_and_punctuation_apart():
    library = Tokenizer.from_file(WORDS)
    library.encode_special_tokens = True
    texts = [
        "Don't 'S 're's WORD'S x's, word, Word. word's. " + "'" * 3 + " a--- A.B. 12ab, _ab_ ab_ \u00aa\u00ba.",
        "\u0130stanbul \u03a3\u0391\u03a3. \u00e9\u00c9, e\u0301x n\u01c5, \u00df. \ufb01, \uac00. \u0149.",
        "<|endoftext|> word\x1cword a\u0085b x\u3000y, , ' 's 't. I'll. I'LL, !!!",
    ]
    for text, own in zip(texts, packing.encode_texts(texts, WORDS)):
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own, dtype="<u4").tolist() == [*ids, 1], text


def test_words_outlive_their_cache(monkeypatch):
    monkeypatch.setattr(packing, "CACHED", 3)
    texts = ["one two, three four.", "five two six, one", "four four. seven three", "", "one two,"]
    whole = packing.encode_texts(texts, WORDS)
    assert [packing.encode_texts([text], WORDS)[0] for text in texts * 2] == whole * 2


def test_packing_keeps_all_limits():
    random_ = random.Random(5)
    limits = packing.Limits(tokens=64, segments=3, loss=20)
    packer = packing.Packer(limits, 0)
    sizes = {}
    for doc in range(500):
        sizes[doc] = random_.randint(1, 150)
        prompt = random_.randint(0, sizes[doc])
        packer.add(doc, np.arange(sizes[doc], dtype="<u4").tobytes(), prompt)
        sizes[doc] = (sizes[doc], prompt)
    packer.finish()
    placed, loads = {}, {}
    for doc, start, length, ids, count, sequence, offset in packer.pieces:
        assert ids == np.arange(start, start + length, dtype="<u4").tobytes()
        placed.setdefault(doc, []).append((start, length))
        tokens, segments, loss = loads.get(sequence, (0, 0, 0))
        assert offset == tokens
        bearing = max(0, start + length - max(start, sizes[doc][1]))
        loads[sequence] = tokens + length, segments + 1, loss + bearing
    for doc, parts in placed.items():
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == sizes[doc][0]
    assert set(placed) == set(sizes)
    assert all(t <= 64 and s <= 3 and b <= 20 for t, s, b in loads.values())


def test_suffix_dedup_query(spark, docs, monkeypatch):
    keys = list(docs)
    want = dict(zip(keys, suffix_dedup.brute_force([docs[key] for key in keys])))
    for hot in (suffix_dedup.HOT, 2):
        monkeypatch.setattr(suffix_dedup, "HOT", hot)
        rows = result(spark, "op6_suffix_dedup")
        assert len(rows) == len(want)
        for row in rows:
            assert want[row.doc_id] == (row.n_bytes, row.n_removed, row.n_spans, row.kept_sha256)


def test_repeated_windows_of_periodic_and_shared_texts():
    random_ = random.Random(1)

    def some(count):
        return bytes(random_.choice(b"abcdefgh ") for _ in range(count))

    shared = [some(600) for _ in range(4)]
    texts = [b"a" * 700, b"a" * 300 + b"b" * 500, b"xy" * 400, b"", b"q" * 199]
    for _ in range(40):
        text = bytearray(some(random_.randint(0, 900)))
        for _ in range(random_.randint(0, 3)):
            cut, at = random_.randint(0, 300), random_.randint(0, len(text))
            text[at:at] = random_.choice(shared)[cut : cut + random_.randint(150, 300)]
        texts.append(bytes(text))
    groups = {}
    for number, raw in enumerate(texts):
        first, place, hashes = suffix_dedup.anchors_of(np.frombuffer(raw, dtype=np.uint8))
        behind = np.append(first[1:], len(raw) - suffix_dedup.SPAN + 1)
        for low, high, at, value in zip(first.tolist(), behind.tolist(), place.tolist(), hashes.tolist()):
            groups.setdefault((value, at - low, raw[low : high + 199]), []).append((number, low))
    seen = {}
    for raw in texts:
        for at in range(len(raw) - 199):
            seen[raw[at : at + 200]] = seen.get(raw[at : at + 200], 0) + 1
    for group, flags in zip(groups, suffix_dedup.repeated_windows(list(groups))):
        for at, flag in enumerate(flags):
            # Alike groups are one here, so a window may repeat only between places of it.
            if flag:
                assert seen[group[2][at : at + 200]] > 1
            elif len(groups[group]) == 1:
                assert seen[group[2][at : at + 200]] == 1


def test_difference_cover_covers():
    for period in (8, 32, 64):
        cover = suffix_dedup.difference_cover(period)
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_shingle_join_query(spark, docs):
    want = shingle_join.brute_force(list(docs.items()))
    rows = result(spark, "op8_shingle_join")
    assert {row.doc_id: (row.n_shingles, row.component_id) for row in rows} == want


def test_shingle_join_on_chains_and_thresholds(spark):
    random_ = random.Random(9)
    words = [f"w{number}" for number in range(400)]
    rows = [(0, None), (1, ""), (2, "  \n"), (3, "one two"), (4, "One  TWO"), (5, "one two three")]
    base = [random_.choice(words) for _ in range(60)]
    # Neighbours in the chain are near copies, its ends are not.
    for step in range(40):
        rows.append((10 + step, " ".join(base)))
        base = base[1:] + [random_.choice(words)]
    for step in range(60):
        changed = list(base)
        changed[random_.randrange(60)] = f"x{step}"
        rows.append((100 + step, " ".join(changed)))
    want = shingle_join.brute_force(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {row.id: (row.n_shingles, row.component_id) for row in shingle_join.groups(frame).collect()}
    assert got == want
    kept = {row.doc_id for row in shingle_join.one_of_each_group(frame).collect()}
    assert kept == {component for _, component in want.values()}


def test_prefixes_of_linked_sets_meet():
    for count in range(1, 300):
        for other in range(count, min(300, count * 100 // 80) + 1):
            least = -(-80 * (count + other) // 180)
            # Even when the shared ones are the last of both.
            assert shingle_join.prefix_length(count) + least > count
            assert shingle_join.prefix_length(other) + least > other


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    def digits(match):
        return re.sub("[^0-9]", "", match.group())

    found = [(0, *m.span()) for m in EMAIL.finditer(text)]
    found += [(1, *m.span()) for m in IP.finditer(text) if max(map(int, m.group().split("."))) < 256]
    found += [
        (2, *m.span())
        for m in CARD.finditer(text)
        if 16 <= len(digits(m)) <= 19 and pii.luhn(digits(m))
    ]
    return found + [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15]


def test_base_spans_are_those_of_the_plain_patterns(docs):
    random_ = random.Random(4)
    parts = ["a", "@", ".", "-", "1", "255", "256", "0", "+", " ", "(", "b.c", "4111 1111 1111 1111"]
    made = ["".join(random_.choice(parts) for _ in range(random_.randint(1, 30))) for _ in range(4000)]
    for text in [*made, *docs.values()]:
        assert pii.base_spans(text) == plain_spans(text)


def test_contexts_of_seeds_find_unseen_identifiers(spark):
    rows = [(n, f"please reach me at user{n}@mail{n}.example.com for more") for n in range(12)]
    rows += [(100, "please reach me at user#5521-home for more"), (101, "the year 20211231 was fine")]
    rows += [(102, None), (103, ""), (104, "please reach me at noon for more")]
    found = pii.find(
        spark.createDataFrame(rows, "id long, text string").na.fill("", ["text"])
    ).collect()
    learnt = {row.id: [(s.kind, s.start, s.end) for s in row.learnt] for row in found}
    assert learnt.pop(100) == [(0, 19, 33)]
    assert not any(learnt.values())
    assert len(found) == len(rows)


def plain_scan(text):
    """All matches of all signatures, thinned out as the operator says."""
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = " ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower))
    padded, found = f" {words} ", []
    if not re.search(license_scan.GATE, text):
        return len(words.split()), [], []
    for rule in license_scan.signatures():
        for match in re.finditer(f"(?<= )(?:{rule.expression})(?= )", padded):
            start = padded.count(" ", 0, match.start()) - 1
            end = start + match.group().count(" ") + 1
            found.append((start, -end, rule.priority, end, rule.label, rule.weight))
    found.sort()
    outer = []
    for one in found:
        if not outer or outer[-1][3] < one[3]:
            outer.append(one)
    kept = [
        one
        for at, one in enumerate(outer)
        if not (at and outer[at - 1][3] > one[0] and outer[at - 1][2] < one[2])
        and not (at + 1 < len(outer) and outer[at + 1][0] < one[3] and outer[at + 1][2] < one[2])
    ]
    return len(words.split()), [one for one in found if one[2] == 0], kept


def test_long_seeds_are_instances_of_their_own(spark):
    start = "a" * 70
    texts = [f"please mail to {start}{n}@example.com now" for n in range(12)]
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    edges = pii.graph_edges(pii.extract(frame))
    assert edges.filter("pattern = 'mail to _'").count() == 12
    assert [row.pattern for row in pii.trusted_patterns(edges).collect()].count("mail to _") == 1


def test_scoring_goes_on_until_no_pattern_is_new(spark):
    # Seeds alone trust only the first pattern; each unlocks what the next one lacks.
    rows = []
    for link in range(1, 7):
        rows += [(f"p{link}", f"seed {link} {n}", 0) for n in range(40)]
        rows += [(f"p{link}", f"new {link} {n}", -1) for n in range(6)]
        rows += [(f"p{link}", f"new {link - 1} {n}", -1) for n in range(6) if link > 1]
    edges = spark.createDataFrame(rows, "pattern string, instance string, kind int")
    assert sorted(row.pattern for row in pii.trusted_patterns(edges).collect()) == [
        f"p{link}" for link in range(1, 7)
    ]


def test_lookalikes_are_cut_out_of_longer_tokens():
    def found(text):
        return [text[start:end] for _, start, end, *_ in pii.candidates(text, [])]

    assert found('{"member":"QX-2291-77","note":"x"}') == ["QX-2291-77"]
    assert found("https://a.example/?member=QX-2291-77&page=2") == ["QX-2291-77"]
    long = "K" * 90 + "20771"
    assert found(f"badge {long}.") == [long]


def test_contexts_hold_whole_words():
    word = "long" * 40
    text = f"{word} badge" + " " * 500 + "QX-2291-77" + "." * 100 + word
    start = text.index("QX")
    assert pii.contexts(text, start, start + 10) == [
        f"{pii.spelling(word)} badge _",
        f"badge _ {pii.spelling(word)}",
    ]


def test_license_scan(spark, docs):
    texts = list(docs.values()) + [
        "Licensed under the MIT License, and CC BY-NC 4.0. cc-by-nc",
        "released under the GNU Lesser General Public License v3; apache license version 2.0",
        "mit mit license all rights reserved (c) Under the MIT  license under THE mit LICENSE",
        "licence to kill, the MPL: Mozilla Public Licence, version 2.0 spdx license identifier bsl",
        "This is in the Public Domain. licensed under the terms of the BSD 3-clause license",
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {row.doc_id: row for row in license_scan.scan(frame).collect()}
    for number, text in enumerate(texts):
        count, base, kept = plain_scan(text)
        row = rows[number]
        assert row.n_words == count
        assert [tuple(one) for one in row.base] == base
        assert [tuple(one) for one in row.detections] == kept
    labels = {one.label for row in rows.values() for one in row.detections}
    assert {"mit", "cc-by-nc", "lgpl-3.0", "apache-2.0", "mpl-2.0", "public-domain"} <= labels
    assert len(license_scan.signatures()) > 250


def strings_of(expression):
    """Every string that a regular expression without open repeats matches."""

    def of(parts):
        made = [""]
        for kind, value in parts:
            name = str(kind)
            if name == "LITERAL":
                more = [chr(value)]
            elif name == "IN":
                more = []
                for one, inside in value:
                    span = range(inside[0], inside[1] + 1) if str(one) == "RANGE" else [inside]
                    more += map(chr, span)
            elif name == "BRANCH":
                more = [text for branch in value[1] for text in of(branch)]
            elif name == "SUBPATTERN":
                more = of(value[-1])
            else:
                assert name == "MAX_REPEAT" and value[:2] == (0, 1), name
                more = ["", *of(value[2])]
            made = [left + right for left in made for right in more]
        return made

    return of(re._parser.parse(expression))


def test_every_name_holds_its_keyword():
    for _, keyword, name in license_scan.NAMES:
        for text in strings_of(name):
            assert re.fullmatch(name, text) and keyword in text, (keyword, text)
            assert re.search(license_scan.GATE, f"{text} "), text


def test_library_names_of_the_lesser_license(spark):
    texts = [
        "licensed under the terms of the GNU Library General Public License version 2",
        "GNU Library General Public License, version 2.0",
        "the Library General Public License",
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = license_scan.scan(frame).orderBy("doc_id").collect()
    labels = [[one.label for one in row.detections] for row in rows]
    assert labels == [["lgpl-2.1"], ["lgpl-2.1"], ["lgpl"]]
    assert [[tuple(one) for one in row.detections] for row in rows] == [plain_scan(t)[2] for t in texts]


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    rows = {row.doc_id: row for row in LLM_QUERIES["op4_toxicity"](spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    for row in rows.values():
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 3 == 1)
        assert 0 <= row.score <= 1 and row.predicted == (row.score >= 0.7)
    held = [(rows[label.doc_id].score, label.toxic) for label in labels if rows[label.doc_id].held_out]
    toxic = [score for score, mark in held if mark]
    clean = [score for score, mark in held if not mark]
    wins = sum((a > b) + 0.5 * (a == b) for a in toxic for b in clean)
    assert wins / (len(toxic) * len(clean)) > 0.85
    assert sum(score >= 0.7 for score in clean) <= 0.03 * len(clean)


def test_toxicity_learns_from_every_labelled_text(spark):
    # More rows of a class than any sample took, and one text longer than it took.
    long = "calm " * 6000 + "zzrare"
    texts = [(n, f"word{n} calm day", None) for n in range(4000)] + [(n, f"word{n} vile scum", "x") for n in range(4000, 8000)]
    texts += [(8002, "copy", "x"), (8003, "copy", "x"), (8004, long, "x"), (8005, None, "x")]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    marks = [(n, int(n >= 4000)) for n, *_ in texts] + [(8004, 0)]
    rows = toxicity.labelled(docs, spark.createDataFrame(marks, "doc_id long, toxic int")).collect()

    def learns(doc_id):
        return zlib.crc32(str(doc_id).encode()) % 3 != 1

    wanted = {text: mark for (doc_id, text, _), (_, mark) in zip(texts, marks) if learns(doc_id) and text is not None}
    assert len(wanted) > 2 * 2600 and long in wanted
    assert sorted((len(row.words), row.toxic) for row in rows) == sorted(
        (len(toxicity.rows_of(text)), mark) for text, mark in wanted.items()
    )
    # All of them reach the counts.
    frame = spark.createDataFrame(rows)
    seen = toxicity._seen_by_all(frame)
    assert (seen == toxicity._seen([toxicity.rows_of(text) for text in wanted], list(wanted.values()))).all()


def test_toxicity_drops_other_texts_before_they_are_shuffled(spark):
    docs = [(n, f"text {n % 50}", "en") for n in range(400)]
    docs = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    marks = [(n, n % 2) for n in range(0, 400, 4)] + [(0, 1), (8, None), (12, 7), (None, 1)]
    marks = spark.createDataFrame(marks, "doc_id long, toxic int")
    wanted = sorted(map(tuple, toxicity.labelled(docs, marks).collect()))
    name = "spark.sql.optimizer.runtime.bloomFilter.numBits"
    before = spark.conf.get(name)
    with with_settings(spark, {**toxicity.LABELLED_FIRST, "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        folder = tempfile.mkdtemp(prefix="vitrina-tests-")
        docs.write.parquet(f"{folder}/docs")
        marks.write.parquet(f"{folder}/marks")
        rows = toxicity.labelled(spark.read.parquet(f"{folder}/docs"), spark.read.parquet(f"{folder}/marks"))
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert plan.count("bloom_filter_agg(") == 2  # partial and final, of one filter
        assert sorted(map(tuple, rows.collect())) == wanted
    assert spark.conf.get(name) == before


def test_toxicity_shards_agree_with_one(spark):
    texts = [(f"word{n % 37} {'vile scum' if n % 4 == 0 else 'calm day'} t{n}", int(n % 4 == 0)) for n in range(300)]
    rows = [(toxicity._packed(text).tolist(), toxic, "x", n) for n, (text, toxic) in enumerate(texts)]
    frame = spark.createDataFrame(rows, "words array<bigint>, toxic int, lang string, draw bigint")
    asked = ["vile scum here", "a calm day", ""]
    for shard in (1000, 40):
        scores = toxicity.learnt(frame.repartition(3), shard=shard).score(asked)
        assert scores[0] > 0.7 > 0.3 > scores[1]
        # The order of rows and of sums does not matter.
        assert (toxicity.learnt(frame.repartition(5), shard=shard).score(asked) == scores).all()


def test_toxicity_thresholds_per_language(spark):
    rng = random.Random(3)
    rows = [(lang, rng.randrange(1000) / 1000, int(rng.random() < 0.4)) for lang in "ab" for _ in range(400)]
    rows += [("few", 0.5, 1)] * 20 + [("few", 0.1, 0)] * 3
    found = toxicity.lang_thresholds(spark.createDataFrame(rows, "lang string, score double, toxic int"))
    assert sorted(found) == ["a", "b"]
    for lang in "ab":
        own = [(score, toxic) for name, score, toxic in rows if name == lang]
        cuts = sorted({score for score, _ in own}, reverse=True)

        def balance(cut):
            hits = sum(toxic for score, toxic in own if score >= cut)
            return 2 * hits / (sum(score >= cut for score, _ in own) + sum(toxic for _, toxic in own))

        best = max(range(len(cuts)), key=lambda at: (balance(cuts[at]), -at))
        below = cuts[best + 1] if best + 1 < len(cuts) else 0.0
        assert found[lang] == pytest.approx((cuts[best] + below) / 2)


def test_toxicity_without_both_classes():
    assert toxicity.train([], np.zeros(0)).score(["x", ""]).tolist() == [0.0, 0.0]
    assert toxicity.train(["a", "b"], np.ones(2)).score(["x"]).tolist() == [1.0]
    assert toxicity.best_threshold(np.array([0.9, 0.8, 0.1]), np.array([1, 1, 0])) == pytest.approx(0.45)


def test_redaction(spark):
    from pyspark.sql import functions as F

    spans = [Row(kind=0, start=2, end=5), Row(kind=1, start=4, end=6), Row(kind=3, start=7, end=8)]
    frame = spark.createDataFrame([("abcdefghij", spans), ("é", [])], "text string, s array<struct<kind:int,start:int,end:int>>")
    got = [row[0] for row in frame.select(pii.redact(F.col("text"), F.col("s"))).collect()]
    assert got == ["ab<email>g<phone>ij", "é"]


def near_copies(count, words, seed):
    """Texts around one base text, each with some words of its own: some pairs linked, some not."""
    random_ = random.Random(seed)
    base = [f"w{random_.randrange(500)}" for _ in range(words)]
    made = []
    for number in range(count):
        own = list(base)
        for _ in range(random_.choice([0, 1, 1, 2, 2, 3])):
            own[random_.randrange(len(own))] = f"own{number % 7}"
        made.append(" ".join(own[: random_.choice([words, words, words - 6])]))
    return made


@pytest.mark.parametrize("tile, shingles", [(1024, 1 << 21), (5, 1 << 21), (1024, 300)])
def test_dense_groups_in_tiles(spark, monkeypatch, tile, shingles):
    monkeypatch.setattr(shingle_join, "TILE", tile)
    monkeypatch.setattr(shingle_join, "TILE_SHINGLES", shingles)
    texts = near_copies(60, 60, 1) + near_copies(40, 25, 2) + near_copies(30, 9, 3)
    rows = list(enumerate(texts))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {row.id: (row.n_shingles, row.component_id) for row in shingle_join.groups(frame).collect()}
    want = shingle_join.brute_force(rows)
    assert got == want
    assert 10 < len({component for _, component in want.values()}) < len(rows) - 10


def test_partial_overlaps_sum_up(monkeypatch):
    monkeypatch.setattr(shingle_join, "SPARSE", 3)
    monkeypatch.setattr(shingle_join, "COLUMNS", 5)
    random_ = np.random.default_rng(2)
    sets = [np.unique(random_.integers(0, 1 << 63, size=40)[:5]).astype(np.uint64) for _ in range(3)]
    shared = random_.integers(0, 1 << 63, size=60).astype(np.uint64)
    sets += [np.unique(random_.choice(shared, size=40)) for _ in range(9)]
    cut = [shingle_join.pieces_of(one) for one in sets]
    assert all(np.array_equal(np.sort(np.concatenate(one)), two) for one, two in zip(cut, sets))
    owners = [
        np.concatenate([np.full(len(one[f]), number) for number, one in enumerate(cut)])
        for f in range(shingle_join.FRAGMENTS)
    ]
    tokens = [np.concatenate([one[f] for one in cut]) for f in range(shingle_join.FRAGMENTS)]
    got = shingle_join.overlaps(owners, tokens, len(sets))
    for a in range(len(sets)):
        for b in range(a + 1, len(sets)):
            assert got[a, b] == len(np.intersect1d(sets[a], sets[b]))


def test_one_of_each_group_without_and_with_repeated_ids(spark):
    copy = "one two three four five six seven eight nine ten eleven twelve"
    rows = [
        (3, copy), (None, copy), (None, copy + " "), (8, copy), (3, copy), (3, "another text under the id three"),
        (None, "only here and without any id"), (5, ""), (5, ""), (None, None), (9, "another text under the id three"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS h", "1 AS node")
    kept = [(row.doc_id, row.text) for row in shingle_join.one_of_each_group(frame).collect()]
    assert sorted(kept, key=str) == sorted([
        (3, copy), (3, "another text under the id three"), (None, "only here and without any id"),
        (5, ""), (5, ""), (None, None),
    ], key=str)
