"""Personal data: fixed patterns, and contexts learnt from what those find.

Base spans come from four validated patterns (e-mail, ip, card, phone). They are the seeds of
a bootstrap: the words around a seed are lexical patterns, and other tokens that look like
identifiers and stand in the same contexts are instances. Spark scores the graph of patterns
and instances in rounds: a pattern is as good as the share of its distinct instances that are
known to be of one kind, an instance is as good as its best-supported patterns make it. The
rounds end when one trusts no pattern that an earlier one didn't. Instances that patterns of
high confidence vouch for are spans of that kind.

A look-alike is a piece of text between white space, quotes, brackets and the signs that
separate values (``,;=&?|``), of ``SHORTEST`` characters or more, ``DIGITS`` of them digits.

The texts are read once, in Python; that gives base spans and candidates, which are few. All
counts run over the distinct pairs of pattern and instance, which combine before the shuffle,
so neither a frequent pattern nor a frequent instance gathers in one task. Patterns and
instances meet in plain joins of narrow tables; nothing is broadcast by hand.

Defined cases: a NULL or empty text has no spans; repeated rows and NULL keys give a row
each; a text counts in the graph once, however often it is copied; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from vitrina.llm.tables import id_and_text, table
from vitrina.session import materialize

KINDS = ("email", "ip", "card", "phone")
#: Credentials are seeds too, but count only where a learnt context vouches for them.
SECRET = len(KINDS)
ALL_KINDS = (*KINDS, "secret")
#: Distinct known instances a pattern needs, and the share they must have.
SUPPORT = 5
CONFIDENT = 0.8
#: Score from which an instance is taken for one of a kind.
ACCEPTED = 0.9
#: Least length and digits of tokens that may be identifiers.
SHORTEST, DIGITS = 6, 4
#: A digest stands for a longer instance or word in the graph.
SPELT = 64

#: The patterns of the base kinds (fixed values); the e-mail's is found from its "@".
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_HEX = re.compile(r"(?=.*[0-9])(?=.*[a-f])[0-9a-f]{32,64}", re.ASCII | re.IGNORECASE)
_WORDS = re.compile(r"[^\W_]+|=|:|@|#")
_CUTS = frozenset("\"'`,;=&?|()[]{}<>")
_EDGES = "\"'`.,;:!?()[]{}<>|*&%$#="


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each "@" with the longest name before it that no earlier match holds, and a domain."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            floor = domain.end()
            yield start, floor
        at = text.find("@", max(at + 1, floor))


def ips(text: str) -> Iterator[tuple[int, int]]:
    for match in _IP.finditer(text):
        # Leading zeros don't count; longer numbers are over 255 anyway.
        if all(len(part.lstrip("0")) < 4 and int(part[-3:]) <= 255 for part in match.groups()):
            yield match.span()


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for match in _CARD.finditer(text):
        digits = match.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield match.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for match in _PHONE.finditer(text):
        if 8 <= sum("0" <= char <= "9" for char in match.group()) <= 15:
            yield match.span()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Kind number, start and end, by kind and start; ends are exclusive."""
    found = []
    if "@" in text:
        found += [(0, *span) for span in emails(text)]
    if _DIGIT.search(text):
        found += [(1, *span) for span in ips(text)]
        found += [(2, *span) for span in cards(text)]
        if "+" in text:
            found += [(3, *span) for span in phones(text)]
    return found


def _spaced_tokens(text: str) -> Iterator[tuple[int, int]]:
    """Tokens between white space and ``_CUTS`` with a digit, without punctuation around them."""
    done = 0
    while match := _DIGIT.search(text, done):
        start = end = match.start()
        while start > done and not (text[start - 1].isspace() or text[start - 1] in _CUTS):
            start -= 1
        while end < len(text) and not (text[end].isspace() or text[end] in _CUTS):
            end += 1
        done = end
        while start < end and text[start] in _EDGES:
            start += 1
        while end > start and text[end - 1] in _EDGES:
            end -= 1
        yield start, end


def spelling(part: str) -> str:
    """What stands for a word or instance in the graph: itself in lower case, or a digest."""
    part = part.lower()
    if len(part) <= SPELT:
        return part
    return "#" + hashlib.md5(part.encode("utf-8", "surrogatepass")).hexdigest()


def words_before(text: str, start: int) -> list[str]:
    """The last two words before ``start``, whole however long they are."""
    width = 64
    while True:
        low = max(0, start - width)
        words = _WORDS.findall(text, low, start)
        # Only the first of the words found may be cut.
        if low == 0 or len(words) > 2:
            return words[-2:]
        width *= 4


def contexts(text: str, start: int, end: int) -> list[str]:
    """Lexical patterns around a span: two words before it, and one on either side."""
    before = [spelling(word) for word in words_before(text, start)]
    after = _WORDS.search(text, end)
    out = []
    if len(before) == 2:
        out.append(f"{before[0]} {before[1]} _")
    if before and after:
        out.append(f"{before[-1]} _ {spelling(after.group())}")
    return out


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple]:
    """Seeds and look-alikes: kind number (-1: none known), start, end, instance, patterns."""
    out = [
        (kind, start, end, spelling(text[start:end]), contexts(text, start, end))
        for kind, start, end in base
    ]
    taken = sorted((start, end) for _, start, end in base)
    at = 0
    for start, end in _spaced_tokens(text):
        if end - start < SHORTEST:
            continue
        if sum("0" <= char <= "9" for char in text[start:end]) < DIGITS:
            continue
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        if at < len(taken) and taken[at][0] < end:
            continue
        kind = SECRET if _HEX.fullmatch(text, start, end) else -1
        out.append((kind, start, end, spelling(text[start:end]), contexts(text, start, end)))
    return out


_SPAN = StructType([StructField(name, IntegerType()) for name in ("kind", "start", "end")])
_CANDIDATE = StructType(
    [
        *_SPAN.fields,
        StructField("instance", StringType()),
        StructField("patterns", ArrayType(StringType())),
    ]
)
_ARROW_SPAN = pa.struct([(name, pa.int32()) for name in ("kind", "start", "end")])
_ARROW_CANDIDATE = pa.struct(
    [*_ARROW_SPAN, ("instance", pa.string()), ("patterns", pa.list_(pa.string()))]
)
_SPAN_KEYS = ("kind", "start", "end")
_CANDIDATE_KEYS = (*_SPAN_KEYS, "instance", "patterns")


def _found_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replaces the text (first column) by base spans and candidates."""
    for batch in batches:
        for first in range(0, batch.num_rows, 512):
            part = batch.slice(first, 512)
            spans, others = [], []
            for text in part.column(0).to_pylist():
                base = base_spans(text)
                spans.append([dict(zip(_SPAN_KEYS, span)) for span in base])
                near = candidates(text, base) if base or _DIGIT.search(text) else []
                others.append([dict(zip(_CANDIDATE_KEYS, one)) for one in near])
            yield pa.RecordBatch.from_arrays(
                [
                    *part.columns[1:],
                    pa.array(spans, pa.list_(_ARROW_SPAN)),
                    pa.array(others, pa.list_(_ARROW_CANDIDATE)),
                ],
                [*part.schema.names[1:], "base", "candidates"],
            )


def extract(texts: DataFrame) -> DataFrame:
    """Base spans and candidates of every row; other columns beside ``text`` are kept.

    A number for each row and the digest of its text come with them.
    """
    rest = [name for name in texts.columns if name != "text"]
    source = texts.select("text", *rest, F.unhex(F.md5("text")).alias("digest"))
    schema = StructType(
        [
            *source.schema.fields[1:],
            StructField("base", ArrayType(_SPAN)),
            StructField("candidates", ArrayType(_CANDIDATE)),
        ]
    )
    return source.mapInArrow(_found_rows, schema)


def graph_edges(found: DataFrame) -> DataFrame:
    """Distinct pairs of ``pattern`` and ``instance``; ``kind`` is that of seeds, else -1."""
    return (
        found.select(F.explode("candidates").alias("one"))
        .select(F.explode("one.patterns").alias("pattern"), "one.instance", "one.kind")
        .groupBy("pattern", "instance")
        .agg(F.max("kind").alias("kind"))
    )


def trusted_patterns(edges: DataFrame) -> DataFrame:
    """``pattern``, ``kind`` and ``confidence`` after the last round.

    A round is the last when it trusts only patterns that some earlier round trusted. Every
    other one adds at least one, so the rounds end.

    Patterns that no seed stands in lend nothing in the first round, so edges without any
    pattern that occurs with several instances are left out from the start.
    """
    several = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).filter(f"n >= {SUPPORT}")
    edges = materialize(edges.join(several.select("pattern"), "pattern", "left_semi"), "edges")
    # What is known of an instance: the kind and how sure it is.
    known = materialize(
        edges.filter("kind >= 0")
        .select("instance", F.col("kind").alias("is_kind"), F.lit(1.0).alias("score"))
        .distinct(),
        "instances",
    )
    trusted = None
    while True:
        sums = (
            edges.join(known, "instance", "left")
            .groupBy("pattern", "is_kind")
            .agg(F.sum("score").alias("mass"), F.count(F.lit(1)).alias("rows"))
        )
        best = F.max(F.struct(F.coalesce("mass", F.lit(0.0)).alias("mass"), "is_kind"))
        rated = (
            sums.groupBy("pattern")
            .agg(best.alias("best"), F.sum("rows").alias("rows"))
            .select(
                "pattern",
                F.col("best.is_kind").alias("kind"),
                (F.col("best.mass") / F.col("rows")).alias("confidence"),
                F.col("best.mass").alias("mass"),
            )
        )
        patterns = materialize(
            rated.filter((F.col("confidence") >= CONFIDENT) & (F.col("mass") >= SUPPORT)).select(
                "pattern", "kind", "confidence"
            ),
            "patterns",
        )
        names = patterns.select("pattern")
        added = names if trusted is None else names.join(trusted, "pattern", "left_anti")
        if added.isEmpty():
            return patterns
        trusted = names if trusted is None else trusted.unionByName(names)
        # Independent patterns add up: what is left of doubt is the product of their doubts.
        doubt = F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-6))))
        fresh = (
            edges.filter("kind < 0")
            .drop("kind")
            .join(patterns, "pattern")
            .groupBy("instance", F.col("kind").alias("is_kind"))
            .agg((1 - F.exp(doubt)).alias("score"))
        )
        known = materialize(
            known.filter("score = 1.0")
            .unionByName(fresh.filter(f"score < 1.0 AND score >= {CONFIDENT}"))
            .groupBy("instance")
            .agg(F.max(F.struct("score", "is_kind")).alias("best"))
            .select("instance", "best.is_kind", "best.score"),
            "instances",
        )


def _unsure(one: Column) -> Column:
    """Whether a candidate is no base span."""
    return (one["kind"] < 0) | (one["kind"] == SECRET)


def discovered(found: DataFrame, patterns: DataFrame) -> DataFrame:
    """``row_id`` with the new spans of its text, from trusted patterns."""
    doubt = F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-6))))
    places = found.select("row_id", F.explode("candidates").alias("one")).filter(
        _unsure(F.col("one"))
    )
    return (
        places.select("row_id", "one.start", "one.end", F.explode("one.patterns").alias("pattern"))
        .join(patterns, "pattern")
        .groupBy("row_id", "start", "end", "kind")
        .agg((1 - F.exp(doubt)).alias("score"))
        .filter(F.col("score") >= ACCEPTED)
        .groupBy("row_id", "start", "end")
        .agg(F.max(F.struct("score", "kind")).alias("best"))
        .groupBy("row_id")
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct(F.col("best.kind").alias("kind"), F.col("start"), F.col("end"))
                )
            ).alias("learnt")
        )
    )


def find(texts: DataFrame) -> DataFrame:
    """All columns but ``text``, with ``base`` and ``learnt`` spans of every row."""
    kept = [name for name in texts.columns if name != "text"]
    found = materialize(
        extract(texts).withColumn("row_id", F.monotonically_increasing_id()), "candidates"
    )
    new = discovered(found, trusted_patterns(graph_edges(found)))
    # Only rows with candidates beside the base spans can have gained a span.
    open_ = F.exists("candidates", _unsure)
    nothing = F.array().cast("array<struct<kind:int,start:int,end:int>>")
    gained = found.filter(open_).select(*kept, "row_id", "base").join(new, "row_id", "left")
    rest = found.filter(~open_).select(*kept, "base", nothing.alias("learnt"))
    return rest.unionByName(
        gained.select(*kept, "base", F.coalesce("learnt", nothing).alias("learnt"))
    )


def _texted(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    names = F.array(*map(F.lit, ALL_KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda one: F.concat_ws(":", F.get(names, one["kind"]), one["start"], one["end"]),
        ),
        ",",
    )


def _count(kind: int) -> Column:
    return F.size(F.filter("base", lambda one: one["kind"] == kind)).cast("long")


def op3_pii(spark, sf_dir) -> DataFrame:
    """Counts and spans of personal data in every document."""
    found = find(id_and_text(table(spark, sf_dir, "documents"), "doc_id", "text"))
    return found.select(
        F.col("id").alias("doc_id"),
        *(_count(number).alias(f"n_{kind}") for number, kind in enumerate(KINDS)),
        F.sha2(_texted(F.col("base")), 256).alias("base_sha256"),
        _texted(F.array_sort(F.concat("base", "learnt"))).alias("spans"),
        F.size("learnt").cast("long").alias("n_learnt"),
    )


def redact(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in angle brackets."""
    names = F.array(*(F.lit(f"<{kind}>") for kind in ALL_KINDS))
    ordered = F.array_sort(
        F.transform(
            spans,
            lambda one: F.struct(
                one["start"].alias("start"), one["end"].alias("end"), one["kind"].alias("kind")
            ),
        )
    )

    def step(state: Column, one: Column) -> Column:
        # Spans of two kinds may overlap; what is already replaced stays so.
        fresh = one["start"] >= state["at"]
        gap = F.substring(text, state["at"] + 1, F.greatest(one["start"] - state["at"], F.lit(0)))
        return F.struct(
            F.greatest(state["at"], one["end"]).alias("at"),
            F.when(fresh, F.concat(state["done"], gap, F.get(names, one["kind"])))
            .otherwise(state["done"])
            .alias("done"),
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))
    return F.aggregate(
        ordered,
        start,
        step,
        lambda state: F.concat(state["done"], F.substring(text, state["at"] + 1, F.length(text))),
    )
