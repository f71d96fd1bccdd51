"""License detection by ordered signature rules.

A signature is a regular expression over the words of a text. Rules come from names of
licenses (hand-written expressions with a keyword and a label) and forms of mention (from
"licensed under ..." to the bare name); a form's place is its priority. A text without any
keyword is not looked at, and a rule runs only where its own keyword occurs.

Detections overlap: a name lies inside a statement, "gpl" inside "lgpl"-like names. They are
ordered by start, longest first, then by priority. One that lies inside an earlier one is
dropped; of two that overlap partly, the one of lower priority is dropped.

All of it is column expressions inside one row, so no row moves, and the work on a text
grows with its length and its detections.

Defined cases: a NULL or empty text has no words, no places and score 0; repeated rows and
NULL keys give a row each; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrina.llm.tables import id_and_text, table

#: Words before lower-casing and what separates them after it.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Phrases that always count, and their labels.
BASE = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

#: Every text with a detection holds one of these, however its words are separated.
GATE = r"(?i)licen|copyright|reserved|domain|commons|gpl|spdx|cc[^0-9A-Za-z]"

#: Names: label, a word that every match contains, expression over words.
NAMES = (
    ("mit", "mit", "mit licen[cs]e"),
    ("mit", "expat", "expat licen[cs]e"),
    ("x11", "x11", "x11 licen[cs]e"),
    ("isc", "isc", "isc licen[cs]e"),
    ("0bsd", "bsd", "(?:zero clause|0) ?bsd licen[cs]e"),
    ("bsd-2-clause", "bsd", "(?:simplified|freebsd|2 clause|two clause) bsd licen[cs]e"),
    ("bsd-2-clause", "bsd", "bsd 2 clause licen[cs]e"),
    ("bsd-3-clause", "bsd", "bsd 3 clause licen[cs]e"),
    ("bsd-3-clause", "bsd", "(?:new|modified|revised|3 clause|three clause) bsd licen[cs]e"),
    ("bsd-4-clause", "bsd", "(?:original|4 clause|four clause) bsd licen[cs]e"),
    ("bsd", "bsd", "bsd(?: style)? licen[cs]e"),
    ("apache-1.1", "apache", "apache(?: software)? licen[cs]e(?: version)? v?1 1"),
    ("apache-2.0", "apache", "apache(?: software)? licen[cs]e(?: version)? v?2(?: 0)?"),
    ("apache", "apache", "apache(?: software)? licen[cs]e"),
    ("gpl-1.0", "general", "gnu general public licen[cs]e(?: version)? v?1(?: 0)?"),
    ("gpl-2.0", "general", "gnu general public licen[cs]e(?: version)? v?2(?: 0)?"),
    ("gpl-3.0", "general", "gnu general public licen[cs]e(?: version)? v?3(?: 0)?"),
    ("gpl", "general", "(?:gnu )?general public licen[cs]e"),
    ("gpl-2.0", "gpl", "gpl ?v? ?2(?: 0)?"),
    ("gpl-3.0", "gpl", "gpl ?v? ?3(?: 0)?"),
    ("gpl", "gpl", "(?:gnu )?gpl"),
    ("lgpl-2.1", "general", "gnu (?:lesser|library) general public licen[cs]e(?: version)? v?2(?: [01])?"),
    ("lgpl-3.0", "lesser", "gnu lesser general public licen[cs]e(?: version)? v?3(?: 0)?"),
    ("lgpl", "general", "(?:gnu )?(?:lesser|library) general public licen[cs]e"),
    ("lgpl", "lgpl", "(?:gnu )?lgpl(?: ?v? ?[23](?: [01])?)?"),
    ("agpl-3.0", "affero", "(?:gnu )?affero general public licen[cs]e(?: version)?(?: 3(?: 0)?)?"),
    ("agpl-3.0", "agpl", "(?:gnu )?agpl(?: ?v? ?3(?: 0)?)?"),
    ("gfdl", "documentation", "(?:gnu )?free documentation licen[cs]e(?: version)?(?: 1(?: [0-9])?)?"),
    ("mpl-1.1", "mozilla", "mozilla public licen[cs]e(?: version)? v?1(?: [01])?"),
    ("mpl-2.0", "mozilla", "mozilla public licen[cs]e(?: version)?(?: 2(?: 0)?)?"),
    ("epl-1.0", "eclipse", "eclipse public licen[cs]e(?: version)? v?1(?: 0)?"),
    ("epl-2.0", "eclipse", "eclipse public licen[cs]e(?: version)?(?: v?2(?: 0)?)?"),
    ("cddl", "distribution", "common development and distribution licen[cs]e(?: version)?(?: 1(?: [01])?)?"),
    ("cpl-1.0", "common", "common public licen[cs]e(?: version)?(?: 1(?: 0)?)?"),
    ("eupl", "european", "european union public licen[cs]e(?: version)?(?: 1(?: [0-2])?)?"),
    ("bsl-1.0", "boost", "boost software licen[cs]e(?: version)?(?: 1(?: 0)?)?"),
    ("zlib", "zlib", "zlib(?: libpng)? licen[cs]e"),
    ("artistic", "artistic", "artistic licen[cs]e(?: version)?(?: [12](?: 0)?)?"),
    ("ofl-1.1", "font", "(?:sil )?open font licen[cs]e(?: version)?(?: 1(?: [01])?)?"),
    ("unlicense", "unlicense", "unlicense"),
    ("wtfpl", "want", "do what the fuck you want to public licen[cs]e"),
    ("odbl", "database", "open (?:data commons )?open database licen[cs]e|open database licen[cs]e"),
    ("cc0", "cc0", "cc0(?: 1 0)? licen[cs]e"),
    ("cc-by-nc-nd", "nd", "cc by nc nd(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "sa", "cc by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc", "nc", "cc by nc(?: [1-4] [05])?"),
    ("cc-by-nd", "nd", "cc by nd(?: [1-4] [05])?"),
    ("cc-by-sa", "sa", "cc by sa(?: [1-4] [05])?"),
    ("cc-by", "cc", "cc by(?: [1-4] [05])?"),
    ("cc-by-nc", "commons", "creative commons attribution non ?commercial(?: [1-4] [05])?"),
    ("cc-by-sa", "commons", "creative commons attribution share ?alike(?: [1-4] [05])?"),
    ("cc-by", "commons", "creative commons attribution(?: [1-4] [05])?"),
    ("cc0", "commons", "creative commons (?:zero|public domain dedication)"),
    ("cc", "commons", "creative commons licen[cs]e"),
    ("public-domain", "domain", "(?:in|into|to) the public domain"),
    ("proprietary", "reserved", "all rights reserved"),
)

#: Forms of mention around a name, by priority, with the weight of what they say.
FORMS = (
    ("(?:dual |re)?licensed (?:to you )?under (?:the )?(?:terms of )?(?:the )?{}", 1.0),
    ("(?:released|published|available|provided) under (?:the )?(?:terms of )?(?:the )?{}", 1.0),
    ("(?:distributed|redistributed|used|modified) under (?:the )?(?:terms of )?(?:the )?{}", 0.95),
    ("(?:subject to|governed by|according to|covered by) (?:the )?(?:terms of )?(?:the )?{}", 0.9),
    ("spdx license identifier (?:the )?{}", 0.9),
    ("{}", 0.6),
)

_KIND = "array<struct<start:int,longest:int,priority:int,end:int,label:string,weight:double>>"


@dataclass(frozen=True)
class Signature:
    """A rule: the smaller the priority, the more it counts."""

    priority: int
    label: str
    keyword: str
    expression: str
    weight: float


def signatures() -> list[Signature]:
    """All rules: the base phrases first, then every name in every form."""
    base = [
        Signature(0, label, max(phrase.split(), key=len), phrase, 1.0) for phrase, label in BASE
    ]
    return base + [
        Signature(place, label, keyword, form.format(f"(?:{name})"), weight)
        for place, (form, weight) in enumerate(FORMS, start=1)
        for label, keyword, name in NAMES
    ]


def _rules(rules: list[Signature]) -> Column:
    return F.array(
        *(
            F.struct(
                F.lit(rule.priority).alias("priority"),
                F.lit(rule.label).alias("label"),
                F.lit(rule.keyword).alias("keyword"),
                F.lit(f"(?<= )(?:{rule.expression})(?= )").alias("expression"),
                F.lit(rule.weight).alias("weight"),
            )
            for rule in rules
        )
    )


def _spaces(part: Column) -> Column:
    return F.length(part) - F.length(F.replace(part, F.lit(" "), F.lit("")))


def _places(rule: Column) -> Column:
    """Every match of a rule in ``words_text``: first word, word behind it, priority, ..."""
    pairs = F.filter(
        F.zip_with(
            F.split("words_text", rule["expression"]),
            F.regexp_extract_all("words_text", rule["expression"], F.lit(0)),
            lambda gap, match: F.struct(
                _spaces(gap).alias("gap"), _spaces(match).alias("inside"), match.alias("match")
            ),
        ),
        lambda pair: pair["match"].isNotNull(),
    )

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + pair["gap"]
        end = start + pair["inside"] + 1
        found = F.struct(
            start.alias("start"),
            (-end).alias("longest"),
            rule["priority"].alias("priority"),
            end.alias("end"),
            rule["label"].alias("label"),
            rule["weight"].alias("weight"),
        )
        return F.struct(
            (start + pair["inside"]).alias("at"),
            F.concat(state["found"], F.array(found)).alias("found"),
        )

    # The text begins with a space before its first word.
    begin = F.struct(F.lit(-1).alias("at"), F.array().cast(_KIND).alias("found"))
    return F.aggregate(pairs, begin, step, lambda state: state["found"])


def _outermost(found: str) -> Column:
    """Detections that lie inside no earlier one; they are ordered by start, longest first."""

    def step(kept: Column, one: Column) -> Column:
        # What is kept ends later and later, so the last one decides.
        inside = F.coalesce(F.get(kept, F.size(kept) - 1)["end"] >= one["end"], F.lit(False))
        return F.when(inside, kept).otherwise(F.concat(kept, F.array(one)))

    return F.aggregate(found, F.array().cast(_KIND), step)


def _undisputed(kept: str) -> Column:
    """Without those that overlap a neighbour of higher priority."""
    return F.filter(
        kept,
        lambda one, at: ~F.coalesce(
            (F.get(F.col(kept), at - 1)["end"] > one["start"])
            & (F.get(F.col(kept), at - 1)["priority"] < one["priority"]),
            F.lit(False),
        )
        & ~F.coalesce(
            (F.get(F.col(kept), at + 1)["start"] < one["end"])
            & (F.get(F.col(kept), at + 1)["priority"] < one["priority"]),
            F.lit(False),
        ),
    )


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_words``, ``base`` (places of the base phrases) and ``detections``.

    Both are arrays of structs with first word, word behind the last, priority, label, weight.
    """
    gated = id_and_text(docs, key, text).select(
        "id",
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("n_words"),
        F.when(
            F.col("text").rlike(GATE),
            F.concat(
                F.lit(" "),
                F.trim(F.regexp_replace(F.translate("text", UPPER, LOWER), BREAK, " ")),
                F.lit(" "),
            ),
        ).alias("words_text"),
    )
    rules = F.filter(
        _rules(signatures()), lambda rule: F.contains(F.col("words_text"), rule["keyword"])
    )
    found = gated.withColumn(
        "found",
        F.when(
            F.col("words_text").isNotNull(),
            F.array_sort(F.flatten(F.transform(rules, _places))),
        ).otherwise(F.array().cast(_KIND)),
    )
    kept = found.withColumn("outermost", _outermost("found"))
    return kept.select(
        F.col("id").alias(key),
        "n_words",
        F.filter("found", lambda one: one["priority"] == 0).alias("base"),
        _undisputed("outermost").alias("detections"),
    )


def _labels(*arrays: str) -> Column:
    labels = F.concat(*(F.transform(array, lambda one: one["label"]) for array in arrays))
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def op2_license_scan(spark, sf_dir) -> DataFrame:
    """Places and labels of licenses in every document."""
    scanned = scan(table(spark, sf_dir, "documents"))
    starts = F.transform("base", lambda one: one["start"].cast("long"))
    weights = F.transform("detections", lambda one: one["weight"])
    return scanned.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        _labels("base").alias("base_labels"),
        _labels("base", "detections").alias("labels"),
        F.coalesce(F.array_max(weights), F.lit(0.0)).alias("score"),
        F.size("detections").cast("long").alias("n_detections"),
    )
