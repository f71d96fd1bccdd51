"""URL filtering by Bloom filter cascades.

A filter of the listed keys gives false positives. As the keys of the whole corpus are known,
its false positives are too: a second filter holds exactly those, a third one the listed keys
that the second one holds falsely, and so on until no error is left. Each level is smaller
than the one before. A lookup asks the levels in turn, and over the keys of the corpus the
answer is exact, without a join: the filters are literals inside a column expression.

Keys are ``host`` followed by a path prefix. A page is looked up under each suffix of its
host and each prefix of its path that has the shape (labels, length) of some listed key, the
longest first, so the most specific rule decides.

The filters take about 10 bits a listed key. That is checked: a list of more than
``MOST_LISTED`` keys is answered by an equi-join instead, with the same result.

Defined cases: a NULL url, or one without ``://``, has an empty host and path, fits no rule
and is allowed; repeated pages and NULL keys give a row each; other columns are ignored; an
empty table gives an empty result; an empty list holds no key.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrina.llm.tables import table
from vitrina.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bits a key of every level but the first, and the longest list that is kept as filters.
BITS_PER_KEY = 8
MOST_LISTED = 4_000_000

#: Rules: host, path, verdict.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
#: Parts of host names that put a host on the list of unwanted hosts.
UNWANTED = "adult ads bets casino pills porn spam viagra warez xxx"
UNWANTED_HOST = rf"(^|[.-])({'|'.join(UNWANTED.split())})([.-]|$)"


@dataclass(frozen=True)
class Level:
    """One Bloom filter: its bits in words of 64, its seed and its number of hashes."""

    words: tuple[int, ...]
    seed: int
    hashes: int

    def holds(self, key: Column) -> Column:
        # Folded into one array literal when the plan is optimized.
        words = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")
        held = F.lit(True)
        for place in positions(key, self.seed, self.hashes, 64 * len(self.words)):
            held = held & _bit(words, place)
        return held


def _bit(words: Column, place: Column) -> Column:
    return F.getbit(F.get(words, F.shiftright(place, 6).cast("int")), (place % 64).cast("int")) == 1


def positions(key: Column, seed: int, hashes: int, bits: int) -> list[Column]:
    """Places of a key's bits in a filter: multiples of one hash added to another."""
    first = F.pmod(F.xxhash64(key, F.lit(2 * seed)), F.lit(bits).cast("long"))
    second = F.pmod(F.xxhash64(key, F.lit(2 * seed + 1)), F.lit(bits).cast("long"))
    return [(first + second * F.lit(step).cast("long")) % F.lit(bits) for step in range(hashes)]


def filter_of(keys: DataFrame, count: int, bits_per_key: float, seed: int) -> Level:
    """The filter of the column ``key``; its bits are ORed in Spark and come as whole words."""
    size = max(1, math.ceil(count * bits_per_key / 64))
    hashes = max(1, round(bits_per_key * math.log(2)))
    set_bits = (
        keys.select(F.explode(F.array(*positions(F.col("key"), seed, hashes, 64 * size))).alias("bit"))
        .groupBy(F.expr("bit div 64").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 AS int))")).alias("bits"))
    )
    words = [0] * size
    for row in set_bits.collect():  # as many rows as the filter has words
        words[row["word"]] = row["bits"]
    return Level(tuple(words), seed, hashes)


@dataclass
class Cascade:
    """Alternating filters; levels 0, 2, ... hold listed keys, the others false positives."""

    levels: list[Level] = field(default_factory=list)

    def holds(self, key: Column) -> Column:
        answer = F.lit(len(self.levels) % 2 == 1)
        for place in reversed(range(len(self.levels))):
            answer = F.when(self.levels[place].holds(key), answer).otherwise(F.lit(place % 2 == 1))
        return answer


def build(listed: DataFrame, universe: DataFrame) -> Cascade:
    """The cascade of distinct listed keys over the distinct keys of the corpus.

    Both have the column ``key``. The universe is read once to learn its size and once to
    find the false positives of the first level; all further levels are subsets of those and
    of the list.
    """
    inside = universe.join(listed, "key", "left_semi")
    count, total = inside.count(), universe.count()
    if not count:
        return Cascade()
    # So sparse that about as many keys err at the first level as are listed.
    first = max(float(BITS_PER_KEY), 1.44 * math.log2(total / count) + 2)
    cascade = Cascade([filter_of(inside, count, first, 0)])
    outside = materialize(
        universe.filter(cascade.levels[0].holds(F.col("key"))).join(listed, "key", "left_anti"),
        "false-positives",
    )
    wrong, right = outside, inside
    while number := wrong.count():
        level = filter_of(wrong, number, BITS_PER_KEY, len(cascade.levels))
        cascade.levels.append(level)
        wrong, right = right.filter(level.holds(F.col("key"))), wrong
    return cascade


def parts(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path of a URL."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)"))
    pattern = r"(?s)^([^/?#]*)([^?#]*).*$"
    host = F.translate(F.regexp_extract(rest, pattern, 1), UPPER, LOWER)
    return (
        F.coalesce(host, F.lit("")),
        F.coalesce(F.regexp_extract(rest, pattern, 2), F.lit("")),
    )


def split_pages(pages: DataFrame, key: str = "page_id", url: str = "url") -> DataFrame:
    """``id``, ``host`` and ``path`` of every page."""
    named = pages.select(F.col(key).alias("id"), F.col(url).cast("string").alias("url"))
    host, path = parts(F.col("url"))
    return named.select("id", host.alias("host"), path.alias("path"))


def candidates(shapes: Iterable[tuple[int, int]]) -> Column:
    """Keys under which a page may be listed, longest first, from ``host`` and ``path``."""
    labels = F.length("host") - F.length(F.replace("host", F.lit("."), F.lit(""))) + 1
    keys = [
        F.when(
            (labels >= count) & (F.length("path") >= length),
            F.concat(F.substring_index("host", ".", -count), F.substring("path", 1, length)),
        )
        for count, length in sorted(shapes, reverse=True)
    ]
    if not keys:
        return F.array().cast("array<string>")
    longest = F.transform(F.array_compact(F.array(*keys)), lambda key: F.struct(F.length(key).alias("length"), key.alias("key")))
    return F.transform(F.sort_array(longest, asc=False), lambda pair: pair["key"])


def shapes_of(listed: DataFrame) -> list[tuple[int, int]]:
    """Pairs of label count and path length that occur among listed ``host`` and ``path``."""
    rows = listed.select(
        (F.length("host") - F.length(F.replace("host", F.lit("."), F.lit(""))) + 1).alias("labels"),
        F.length("path").alias("length"),
    ).distinct()
    return [tuple(row) for row in rows.collect()]


def first_listed(pages: DataFrame, listed: DataFrame, most: int = MOST_LISTED) -> DataFrame:
    """``pages`` with ``hit``: the longest listed key and its ``verdict``, NULL without one.

    ``listed`` has ``host``, ``path`` and ``verdict``; of repeated keys the one with the
    smallest verdict counts. ``pages`` has ``host`` and ``path``.
    """
    keys = listed.groupBy("host", "path").agg(F.min("verdict").alias("verdict")).select(
        "host", "path", F.concat("host", "path").alias("key"), "verdict"
    )
    keys = materialize(keys, "listed")
    asked = pages.withColumn("candidates", candidates(shapes_of(keys)))
    if keys.count() > most:
        return _joined(asked, keys)
    universe = materialize(
        asked.select(F.explode("candidates").alias("key")).distinct(), "page-keys"
    )
    verdicts = [row[0] for row in keys.select("verdict").distinct().orderBy("verdict").collect()]
    cascades = {
        verdict: build(keys.filter(F.col("verdict") == verdict).select("key"), universe)
        for verdict in verdicts
    }

    def judged(key: Column) -> Column:
        verdict = F.lit(None).cast("string")
        for name, cascade in cascades.items():
            verdict = F.when(cascade.holds(key), F.lit(name)).otherwise(verdict)
        return F.struct(key.alias("key"), verdict.alias("verdict"))

    hits = F.filter(F.transform("candidates", judged), lambda one: one["verdict"].isNotNull())
    return asked.withColumn("hit", F.get(hits, F.lit(0))).drop("candidates")


def _joined(asked: DataFrame, keys: DataFrame) -> DataFrame:
    """The same by joins, for lists that are too long for filters."""
    rows = materialize(asked.withColumn("row_id", F.monotonically_increasing_id()), "asked")
    hits = (
        rows.select("row_id", F.posexplode("candidates").alias("place", "key"))
        .join(keys.select("key", "verdict"), "key")
        .groupBy("row_id")
        .agg(F.min_by(F.struct("key", "verdict"), "place").alias("hit"))
    )
    return rows.join(hits, "row_id", "left").drop("row_id", "candidates")


def unwanted_hosts(pages: DataFrame) -> DataFrame:
    """The hosts of the corpus whose name has an unwanted part, as a list of keys."""
    return (
        pages.filter(F.col("host").rlike(UNWANTED_HOST))
        .select("host", F.lit("").alias("path"), F.lit("block").alias("verdict"))
        .distinct()
    )


def rule_table(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in RULES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS rules(host, path, verdict)")


def judge(pages: DataFrame, rules: DataFrame, hosts: DataFrame) -> DataFrame:
    """``id``, ``host``, ``path``, ``rule`` and ``verdict`` of pages split before.

    The longest fitting rule decides; without one, pages of unwanted hosts are blocked.
    """
    ruled = first_listed(pages, rules).withColumnRenamed("hit", "by_rule")
    known = first_listed(ruled, hosts).withColumnRenamed("hit", "by_host")
    return known.select(
        "id",
        "host",
        "path",
        F.col("by_rule.key").alias("rule"),
        F.coalesce("by_rule.verdict", "by_host.verdict", F.lit("allow")).alias("verdict"),
    )


def op9_url_cascade(spark, sf_dir) -> DataFrame:
    """Every page's host, path, rule and verdict."""
    pages = split_pages(table(spark, sf_dir, "pages"))
    judged = judge(pages, rule_table(spark), unwanted_hosts(pages))
    return judged.withColumnRenamed("id", "page_id")


OP9_SQL = rf"""
WITH parts AS (
  SELECT page_id,
         CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS rest
  FROM pages
), split AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1),
                  '{UPPER}', '{LOWER}'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM parts
), rules(rule_host, rule_path, verdict) AS (
  VALUES {", ".join(str(rule) for rule in RULES)}
), fitting AS (
  SELECT page_id, rule_host || rule_path AS rule, verdict
  FROM split JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC) = 1
)
SELECT s.page_id, host, path, rule,
       coalesce(f.verdict, CASE WHEN regexp_matches(host, '{UNWANTED_HOST}') THEN 'block'
                                ELSE 'allow' END) AS verdict
FROM split s LEFT JOIN fitting f USING (page_id)
"""
