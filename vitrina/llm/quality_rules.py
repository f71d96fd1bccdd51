"""Quality rules as a ledger of failure bits and measurements.

Every rule is evaluated once per document. The ledger keeps what was measured and one bit
per failed rule, so that a policy (a versioned set of rules) is a bitwise AND afterwards,
and the effect of leaving a rule out is a count over the few distinct bit masks: changing a
policy never reads the texts again.

Everything is a column expression; measuring moves no row.

Defined cases: a NULL or empty text has no words and fails ``too_few_words``; repeated rows
and NULL ids give a ledger row each; other columns of the table are ignored, whatever their
names; an empty table gives an empty ledger.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrina.llm.tables import id_and_text, table

#: Words in a window whose repetition counts.
WINDOW = 8
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Rule:
    """A named test over the measurements; true means that the document fails it."""

    name: str
    fails: str


#: A rule's place is its bit. Rules are only ever appended, so that stored ledgers stay readable.
RULES = (
    Rule("too_few_words", "n_words < 20"),
    Rule("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 30 * n_lines"),
    Rule("short_words", "word_chars < 3 * n_words"),
    Rule("long_words", "word_chars > 12 * n_words"),
    Rule("capitals", "100 * n_upper > 35 * word_chars"),
    Rule("exclamations", "2 * n_exclamations > n_words"),
    Rule("digits", "100 * n_digits > 35 * word_chars"),
)
BIT = {rule.name: 1 << place for place, rule in enumerate(RULES)}

BASE = ("too_few_words", "repeated_windows")
#: Policies by version: the rules whose failure rejects a document.
POLICIES = {
    "base": BASE,
    "v1": (*BASE, "symbols", "repeated_lines", "capitals"),
    "v2": tuple(rule.name for rule in RULES),
}
CURRENT = "v2"

MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_upper",
    "n_exclamations",
    "n_digits",
)


def policy_mask(policy: str) -> int:
    return sum(BIT[name] for name in POLICIES[policy])


def _count_without(pattern: str) -> Column:
    """Code points of the text that the pattern removes."""
    return F.length("text") - F.length(F.regexp_replace("text", pattern, ""))


def _pair_hashes(hashes: str, distance: int) -> Column:
    """Hash of each element and the one ``distance`` further."""
    return F.transform(
        hashes, lambda value, at: F.xxhash64(value, F.get(F.col(hashes), at + distance))
    )


def measure(texts: DataFrame) -> DataFrame:
    """Adds a column for each of ``MEASURES`` to a table with the column ``text``."""
    kept = texts.columns
    # Hashes of 2, 4 and 8 words in a row, each from two halves.
    parts = texts.withColumn(
        "words", F.filter(F.split("text", SPACE), lambda word: word != "")
    ).withColumn("hash1", F.transform("words", lambda word: F.xxhash64(word)))
    for width in (1, 2, 4):
        parts = parts.withColumn(f"hash{2 * width}", _pair_hashes(f"hash{width}", width))
    parts = parts.withColumn(
        "windows", F.slice("hash8", 1, F.greatest(F.size("words") - WINDOW + 1, F.lit(0)))
    )
    # Only a text in which some window occurs twice is looked at closer.
    parts = parts.withColumn(
        "ordered",
        F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.array_sort(
                F.transform("windows", lambda value, at: F.struct(value.alias("h"), at.alias("at")))
            ),
        ),
    )

    def same(one: Column, other: Column) -> Column:
        """Equal hashes, and then equal words."""
        words = F.col("words")
        return (one["h"] == other["h"]) & (
            F.slice(words, one["at"] + 1, WINDOW) == F.slice(words, other["at"] + 1, WINDOW)
        )

    ordered = F.col("ordered")
    parts = parts.withColumn(
        "starts",
        F.array_sort(
            F.transform(
                F.filter(
                    "ordered",
                    lambda one, at: F.coalesce(same(one, F.get(ordered, at - 1)), F.lit(False))
                    | F.coalesce(same(one, F.get(ordered, at + 1)), F.lit(False)),
                ),
                lambda one: one["at"],
            )
        ),
    )
    # A window covers its words up to the start of the next repeated one.
    covered = F.aggregate(
        F.transform(
            "starts",
            lambda start, at: F.least(
                F.lit(WINDOW), F.coalesce(F.get(F.col("starts"), at + 1) - start, F.lit(WINDOW))
            ),
        ),
        F.lit(0),
        lambda total, part: total + part,
    )
    parts = parts.withColumn(
        "lines", F.filter(F.split("text", "\n"), lambda line: line.rlike(WORD))
    )
    measures = {
        "n_words": F.size("words"),
        "word_chars": F.length(F.regexp_replace("text", SPACE, "")),
        "n_symbols": _count_without("[#*$%&|<>]+"),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": F.coalesce(covered, F.lit(0)),
        "n_lines": F.size("lines"),
        "n_upper": _count_without(r"\p{Lu}+"),
        "n_exclamations": _count_without("!+"),
        "n_digits": _count_without("[0-9]+"),
    }
    return parts.select(*kept, *(measures[name].cast("long").alias(name) for name in MEASURES))


def failure_mask() -> Column:
    """Bits of the failed rules, from the measurements."""
    mask = F.lit(0).cast("long")
    for rule in RULES:
        bit = F.when(F.expr(rule.fails), F.lit(BIT[rule.name])).otherwise(F.lit(0))
        mask = mask.bitwiseOR(bit.cast("long"))
    return mask


def ledger(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, every measurement and ``failed`` with a bit for each failed rule."""
    measured = measure(id_and_text(docs, key, text))
    return measured.select(F.col("id").alias(key), *MEASURES, failure_mask().alias("failed"))


def fails(policy: str, failed: str = "failed") -> Column:
    """Whether a policy rejects a document with these bits."""
    return F.col(failed).bitwiseAND(F.lit(policy_mask(policy))) != 0


def ablations(
    books: DataFrame, policies: Mapping[str, tuple[str, ...]] = POLICIES
) -> DataFrame:
    """What each rule of each policy decides, from the bits alone.

    Per policy and rule: documents that fail the rule, that fail no other rule of the policy
    (the rule's own share), and that would be kept without it. The documents are first
    counted per mask, so the rest runs over at most 2^rules rows.
    """
    masks = books.groupBy("failed").agg(F.count(F.lit(1)).alias("docs"))
    steps = F.array(
        *(
            F.struct(
                F.lit(version).alias("policy"),
                F.lit(name).alias("rule"),
                F.lit(BIT[name]).cast("long").alias("bit"),
                F.lit(sum(BIT[other] for other in names)).cast("long").alias("mask"),
            )
            for version, names in policies.items()
            for name in names
        )
    )
    hit = F.col("failed").bitwiseAND(F.col("bit")) != 0
    others = F.col("failed").bitwiseAND(F.col("mask").bitwiseXOR(F.col("bit"))) != 0
    return (
        masks.select("failed", "docs", F.inline(steps))
        .groupBy("policy", "rule")
        .agg(
            F.sum(F.when(hit, F.col("docs")).otherwise(0)).alias("failing"),
            F.sum(F.when(hit & ~others, F.col("docs")).otherwise(0)).alias("only_this"),
            F.sum(F.when(~others, F.col("docs")).otherwise(0)).alias("kept_without"),
        )
    )


def accepted(docs: DataFrame, policy: str = CURRENT, text: str = "text") -> DataFrame:
    """The documents that a policy keeps, with their columns."""
    # Numbered names cannot clash with those of the measurements.
    own = [F.col(f"`{name}`").alias(f"own_{place}") for place, name in enumerate(docs.columns)]
    texts = docs.select(*own, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    judged = measure(texts).select(
        *(f"own_{place}" for place in range(len(docs.columns))),
        failure_mask().alias("failed"),
        # A condition on it keeps the optimizer from moving the filter below this projection,
        # where every use of a measurement would evaluate it anew.
        F.monotonically_increasing_id().alias("number"),
    )
    kept = judged.filter(~fails(policy) & (F.col("number") >= 0))
    return kept.select(
        *(F.col(f"own_{place}").alias(name) for place, name in enumerate(docs.columns))
    )


def op1_quality_rules(spark, sf_dir) -> DataFrame:
    """The ledger of every document with the verdicts of the base and the current policy."""
    books = ledger(table(spark, sf_dir, "documents"))
    return books.select(
        "doc_id",
        *MEASURES[:5],
        fails("base").alias("base_failed"),
        (~fails("base") & ~fails(CURRENT)).alias("kept"),
        "failed",
        *MEASURES[5:],
    )


OP1_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), words AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM docs
), windows AS (
  SELECT doc_id, i, ws[i:i + 7] AS k FROM words, unnest(range(1, len(ws) - 6)) AS t(i)
), repeated AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + j) AS n FROM repeated, range(8) AS r(j) GROUP BY doc_id
), m AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         len(ls)::BIGINT AS n_lines,
         length(regexp_replace(text, '[^\p{Lu}]', '', 'g'))::BIGINT AS n_upper,
         length(regexp_replace(text, '[^!]', '', 'g'))::BIGINT AS n_exclamations,
         length(regexp_replace(text, '[^0-9]', '', 'g'))::BIGINT AS n_digits
  FROM words w LEFT JOIN covered c USING (doc_id)
), f AS (
  SELECT *, (CASE WHEN n_words < 20 THEN 1 ELSE 0 END
      + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
      + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END
      + CASE WHEN 100 * n_dup_lines > 30 * n_lines THEN 8 ELSE 0 END
      + CASE WHEN word_chars < 3 * n_words THEN 16 ELSE 0 END
      + CASE WHEN word_chars > 12 * n_words THEN 32 ELSE 0 END
      + CASE WHEN 100 * n_upper > 35 * word_chars THEN 64 ELSE 0 END
      + CASE WHEN 2 * n_exclamations > n_words THEN 128 ELSE 0 END
      + CASE WHEN 100 * n_digits > 35 * word_chars THEN 256 ELSE 0 END)::BIGINT AS failed
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failed & 3) <> 0 AS base_failed, failed = 0 AS kept, failed,
       n_lines, n_upper, n_exclamations, n_digits
FROM f
"""
