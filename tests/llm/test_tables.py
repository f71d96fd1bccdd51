"""SQL, edge cases of every operator, the vector and URL operators, and the pipeline."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.check_registry import compare, connect
from vitrina.llm import (
    byte_bpe, graph_search, license_scan, packing, pii, quality_rules, shingle_join,
    suffix_dedup, toxicity, url_cascade,
)
from vitrina.llm.registry import LLM_QUERIES, LLM_SQL
from vitrina.llm.tables import id_and_text, row_and_text

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", LLM_SQL)
def test_query_equals_its_sql(spark, name):
    assert compare(spark, connect(SF), name, LLM_QUERIES[name], LLM_SQL[name], SF) is None


def test_queries_of_all_operators():
    assert [int(name[2:].split("_")[0]) for name in LLM_QUERIES] == list(range(1, 14))


LONG = "word " * 30_000 + "x" * 50_000
EDGES = [
    (1, None), (2, ""), (3, " \n\t "), (4, "Hello world"), (4, "Hello world"), (None, "no id here"),
    (5, LONG), (6, "é" * 300), (7, "!!! ### \n!!! ###\n"), (8, "Hello world"),
]
#: Columns that operators use inside.
CLASHES = ["row", "id", "words", "node", "n", "key", "digest", "base", "row_id", "failed", "ids"]


@pytest.fixture(scope="module")
def edges(spark):
    frame = spark.createDataFrame(EDGES, "doc_id long, text string")
    return frame.select("*", *(F.lit(name).alias(name) for name in CLASHES), F.lit("en").alias("lang"))


def operators(frame):
    """Every operator on texts over a table; each gives a row per document but packing."""
    ranks, words = byte_bpe_paths()
    model = toxicity.train(["you idiot", "nice day", "idiot", "day"] * 3, np.array([1.0, 0.0, 1.0, 0.0] * 3))
    return {
        "quality": quality_rules.ledger(frame),
        "license": license_scan.scan(frame),
        "pii": pii.find(id_and_text(frame, "doc_id", "text")),
        "toxicity": toxicity.scored(frame, model),
        "suffix": suffix_dedup.without_repeats(row_and_text(frame, "text")),
        "bpe": byte_bpe.decode(byte_bpe.encode(frame, ranks), ranks),
        "shingles": shingle_join.groups(frame),
        "packing": packing.pack(frame, words),
    }


def byte_bpe_paths():
    import public_tokenizers

    return tuple(map(public_tokenizers.path, ("byte_bpe_50k.tiktoken", "word_bpe_49k.json")))


def test_edge_rows(edges):
    found = {name: frame.collect() for name, frame in operators(edges).items()}
    for name, rows in found.items():
        if name != "packing":
            assert len(rows) == len(EDGES), name
    assert sum(row.length for row in found["packing"] if row.start == 0) > 0
    assert sum(row.start == 0 for row in found["packing"]) == len(EDGES)
    assert {row.doc_id: row.n_words for row in found["quality"]}[5] == 30_001
    sizes = {row.row.doc_id: row.n_bytes for row in found["suffix"]}
    assert (sizes[1], sizes[2], sizes[6]) == (0, 0, 600)
    groups = {row.id: row.component_id for row in found["shingles"]}
    assert (groups[4], groups[8], groups[1], groups[None]) == (4, 4, 1, None)
    texts = {key: text or "" for key, text in EDGES}
    assert all(bytes(row.decoded).decode() == texts[row.doc_id] for row in found["bpe"])


def test_empty_tables(edges):
    for name, frame in operators(edges.limit(0)).items():
        assert frame.collect() == [], name
    assert quality_rules.ablations(quality_rules.ledger(edges.limit(0))).collect() == []


def test_ledger_policies_and_ablations(edges):
    books = quality_rules.ledger(edges)
    masks = [row.failed for row in books.collect()]
    for row in quality_rules.ablations(books).collect():
        bit, mask = quality_rules.BIT[row["rule"]], quality_rules.policy_mask(row["policy"])
        assert row.failing == sum(bool(one & bit) for one in masks)
        assert row.only_this == sum((one & mask) == bit for one in masks)
        assert row.kept_without == sum(not one & (mask ^ bit) for one in masks)
    kept = quality_rules.accepted(edges, "base")
    assert kept.columns == edges.columns
    assert kept.count() == sum(not one & quality_rules.policy_mask("base") for one in masks)


URLS = [
    (1, None), (2, "no scheme"), (3, "http://COM/"), (4, "http://com"), (5, "https://a.example.com/en/x?y#z"),
    (6, "http://www.example.com/en/"), (7, "http://b.www.example.com/en/q"), (8, "http://x.net/es/1"),
    (9, "http://net/fr/"), (10, "http://xnet/es/"), (11, "ftp://cheap-pills.org#/en/"), (12, "http://"),
    (12, "http://"), (None, "http://spam.example.org/a"), (13, "http://example.com/en"), (14, "http://a..com/"),
]


def plain_verdict(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, behind = rest[:cut].lower(), rest[cut:]
    path = behind[: min([behind.find(c) for c in "?#" if c in behind], default=len(behind))]
    fits = [
        (len(h + p), h + p, verdict)
        for h, p, verdict in url_cascade.RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    if fits:
        return host, path, *max(fits)[1:]
    unwanted = any(p in url_cascade.UNWANTED.split() for p in host.replace("-", ".").split("."))
    return host, path, None, "block" if unwanted else "allow"


@pytest.mark.parametrize("most", [url_cascade.MOST_LISTED, 0])
def test_url_verdicts(spark, monkeypatch, most):
    monkeypatch.setattr(url_cascade.first_listed, "__defaults__", (most,))
    frame = spark.createDataFrame(URLS, "page_id long, url string").withColumn("host", F.lit(1))
    pages = url_cascade.split_pages(frame)
    rows = url_cascade.judge(pages, url_cascade.rule_table(spark), url_cascade.unwanted_hosts(pages))
    key = lambda row: (row[0] is None, row[0] or 0, str(row[1:]))
    want = sorted([(page, *plain_verdict(url)) for page, url in URLS], key=key)
    assert sorted(map(tuple, rows.collect()), key=key) == want
    none = pages.limit(0)
    assert url_cascade.judge(none, url_cascade.rule_table(spark), url_cascade.unwanted_hosts(none)).count() == 0


def test_cascade_is_exact_with_crowded_filters(spark, monkeypatch):
    monkeypatch.setattr(url_cascade, "BITS_PER_KEY", 2)
    universe = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = spark.range(0, 4000, 7).select(F.concat(F.lit("k"), "id").alias("key"))
    cascade = url_cascade.build(listed, universe)
    assert len(cascade.levels) > 2
    held = universe.filter(cascade.holds(F.col("key"))).collect()
    assert {row.key for row in held} == {f"k{number}" for number in range(0, 3000, 7)}


def test_nearest_rows(spark):
    rows = graph_search.op5_graph_search(spark, "/root/testdata/sf0.01").collect()
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").toPandas()
    ids, vectors = table.vec_id.to_numpy(), np.stack(table.embedding.to_numpy()).astype(float)
    place = {number: at for at, number in enumerate(ids)}
    found = {}
    for row in rows:
        found.setdefault(row.query_id, []).append(row)
        product = vectors[place[row.query_id]] @ vectors[place[row.vec_id]]
        assert row.score == pytest.approx(product, abs=1e-12)
    recall = []
    for query, want in graph_search.brute_force(ids, vectors):
        own = sorted(found[query], key=lambda row: row["rank"])
        assert [row["rank"] for row in own] == list(range(1, 21))
        assert [(-row.score, row.vec_id) for row in own] == sorted((-row.score, row.vec_id) for row in own)
        recall.append(len(set(want) & {row.vec_id for row in own}) / len(want))
    assert np.mean(recall) >= 0.9


def test_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [3.0, 4.0]), (2, [3.0, 4.0])]
    rows += [(3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [None, 1.0]), (7, [1.0])]
    rows += [(8, [float("inf"), 1.0]), (9, []), (10, [0.0, -2.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("ids", F.lit(1))
    got = graph_search.nearest(frame, lambda key: key % 20 == 0).collect()
    own = [(r.id, r.score) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == 0]
    assert own == [(2, 3.0), (1, 1.0), (20, 1.0), (10, 0.0)]
    assert graph_search.nearest(frame.limit(0), lambda key: key % 20 == 0).collect() == []


def test_shards_have_one_size_at_every_table_size():
    for total in (1, 5000, 16_000, 51_282, 400_000, 10_000_000):
        shards = graph_search.shards_of(total)
        assert (shards - 1) * 5000 < total <= shards * 5000


@pytest.mark.parametrize("length", [1e5, 3e38])
def test_one_very_long_vector(spark, length):
    random = np.random.default_rng(8)
    vectors = random.normal(size=(600, 16))
    vectors /= np.sqrt((vectors**2).sum(axis=1, keepdims=True))
    vectors[7] *= length
    vectors = vectors.astype(np.float32).astype(float)
    rows = [(number, vector.tolist()) for number, vector in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = {}
    for row in graph_search.nearest(frame, lambda key: key % 20 == 0).collect():
        assert row.score == pytest.approx(vectors[row.query_id] @ vectors[row.id], rel=1e-9)
        found.setdefault(row.query_id, set()).add(row.id)
    want = dict(graph_search.brute_force(np.arange(600), vectors))
    assert set(found) == set(want)
    assert np.mean([len(found[key] & set(ids)) / len(ids) for key, ids in want.items()]) >= 0.9


def test_ties_between_distinct_vectors_go_to_smaller_ids(spark):
    random = np.random.default_rng(4)
    side = random.normal(size=(101, 8)) * 0.1
    first = np.where(np.arange(101) <= 60, 1.0, -1.0)
    vectors = np.concatenate([first[:, None], side], axis=1)
    vectors[0] = [1.0] + [0.0] * 8
    order = random.permutation(101)
    rows = [(int(key), vectors[key].tolist()) for key in order]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = graph_search.nearest(frame, lambda key: key % 200 == 0).collect()
    assert {row.score for row in found} == {1.0}
    assert sorted((row["rank"], row.id) for row in found) == [(rank, rank) for rank in range(1, 21)]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The documents before and after each stage; ``after[k]`` is ``before[k + 1]``."""
    folder = tmp_path_factory.mktemp("stages")
    docs, tables = spark.read.parquet(f"{SF}/documents.parquet"), []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        tables.append(docs)
        stage(spark, docs, SF).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return [*tables, docs]


def stage_rows(stages, number):
    before = {row.doc_id: row.text or "" for row in stages[number].collect()}
    assert stages[number + 1].columns == list(corpus_pipeline.COLUMNS)
    return before, {row.doc_id: row for row in stages[number + 1].collect()}


def test_names_of_stages():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "shingle_join", "suffix_dedup", "pii", "packing"]


def test_stage_quality_rules(spark, stages):
    # A filter on top would have Spark work out the whole ledger a second time to filter by it.
    judged = LLM_QUERIES["op1_quality_rules"](spark, SF).collect()
    assert set(stage_rows(stages, 0)[1]) == {row.doc_id for row in judged if row.kept}


def test_stage_shingle_join(stages):
    rows, after = stage_rows(stages, 1)
    want = shingle_join.brute_force(list(rows.items()))
    assert set(after) == {component for _, component in want.values()}


def test_stage_suffix_dedup(stages):
    rows, after = stage_rows(stages, 2)
    keys = list(rows)
    for key, (size, gone, _, _) in zip(keys, suffix_dedup.brute_force([rows[k] for k in keys])):
        assert (key in after) == (gone == 0 or gone < size)
        if gone == 0:
            assert after[key].text == rows[key]
        elif key in after:
            left = len(after[key].text.encode())
            assert size - gone - 6 * 10 <= left <= size - gone


def test_stage_pii(stages):
    rows, after = stage_rows(stages, 3)
    assert set(after) == set(rows)
    for key, row in after.items():
        assert not [one for one in pii.base_spans(row.text) if one[0] == 0]
        if not pii.base_spans(rows[key]) and "token" not in rows[key]:
            assert row.text == rows[key]
        assert row.n_chars == len(row.text)


def test_stage_packing(stages):
    rows = {row.doc_id for row in stages[4].select("doc_id").collect()}
    pieces = stages[5].collect()
    assert {row.doc_id for row in pieces} == rows
    for key in rows:
        own = sorted((row.start, row.length) for row in pieces if row.doc_id == key)
        assert [start for start, _ in own] == np.cumsum([0, *(length for _, length in own)])[:-1].tolist()


#: Rows that no stage may fail on: NULL ids and texts, empty and long texts, repeated rows.
STAGE_EDGES = [
    (1, None, "en", "web", None), (None, "no id " * 30, None, None, 5), (3, "", "en", "web", 0),
    (4, "word and more " * 300, "en", "web", 1), (4, "word and more " * 300, "en", "web", 1), (5, " \n ", "", "", 3),
]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_on_edge_rows_and_empty_tables(spark, name, stage):
    frame = spark.createDataFrame(
        STAGE_EDGES, "doc_id long, text string, lang string, source string, n_chars long"
    ).selectExpr("*", *(f"'{clash}' AS {clash}" for clash in CLASHES))
    rows = stage(spark, frame, SF).collect()
    texts = {(row[0], row[1]) for row in STAGE_EDGES}
    if name == "quality_rules":
        assert {(row.doc_id, row.text) for row in rows} <= texts
    elif name == "shingle_join":
        got = sorted(((row.doc_id, row.text) for row in rows), key=str)
        assert got == sorted([*(row[:2] for row in STAGE_EDGES[:4]), STAGE_EDGES[5][:2]], key=str)
    elif name == "pii":
        assert sorted(str((row.doc_id, row.text)) for row in rows) == sorted(
            str((key, text or "")) if text else str((key, text)) for key, text, *_ in STAGE_EDGES
        )
    elif name == "packing":
        assert sum(row.start == 0 for row in rows) == len(STAGE_EDGES)
    else:
        assert {row.doc_id for row in rows} >= {None}
    assert stage(spark, frame.limit(0), SF).collect() == []


def test_cut_characters_cost_only_themselves(spark):
    passage = "".join(f"{number} shared " for number in range(40))
    rows = [
        (1, f"first own \ufffd text à{passage}é ends here"),
        (2, f"second own text Ġ{passage}à stops there"),
        (3, f"third 日{passage}本 text"),
        (4, f"fourth 旦{passage}末 text"),
        (5, passage),
        (6, "nothing in common"),
    ]
    docs = spark.createDataFrame(
        [(key, text, "fr", "web", len(text)) for key, text in rows],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    left = corpus_pipeline.repeated_strings(spark, docs, SF).collect()
    assert {row.doc_id: row.text for row in left} == {
        1: "first own \ufffd text  ends here",
        2: "second own text  stops there",
        3: "third 日 text",
        4: "fourth 旦 text",
        6: "nothing in common",
    }
    assert all(row.n_chars == len(row.text) for row in left)
