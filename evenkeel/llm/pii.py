"""Personal data by weak supervision, in DataFrame functions only.

Patterns propose spans. Labelers vote on each: the kind's own check, a gazetteer,
words of the context, and the span's edges; any may abstain. Expectation
maximisation over the counts of vote patterns estimates how reliable each labeler
is, and with the resulting soft labels a naive Bayes classifier over span features
is trained. Spans that pass the kind's own check always stay; the classifier
decides on the others. Votes and features have few values, so what comes to the
driver has a fixed bound.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.llm.scratch import save

KINDS = ("email", "ip", "card", "phone")

_LOCAL = "A-Za-z0-9._%+-"
_LABEL = "[A-Za-z0-9-]++"
# What proposes spans, as (kind, strict, pattern, a text that must occur). Strict
# patterns find the same spans as the plain forms below them in the contract, but
# start only where a longest run starts, so that no text takes quadratic time.
_PROPOSALS = (
    ("email", True, rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@{_LABEL}(?:\.{_LABEL})++", "@"),
    ("ip", True, r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "."),
    ("card", True, r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,}+", None),
    ("phone", True, r"\+[0-9][ ().0-9-]+[0-9]", "+"),
    (
        "email",
        False,
        rf"(?<![{_LOCAL}])[{_LOCAL}]{{1,64}}+ ?(?:\[at\]|\(at\)) ?{_LABEL}(?: ?(?:\.|\[dot\]|\(dot\)) ?{_LABEL})++",
        "at",
    ),
    ("phone", False, r"(?<![0-9+.(-])(?<![0-9] )(?:00[1-9]|0|\([0-9]{2,4}\))(?:[ ()/-]{0,3}+[0-9]){6,15}+(?![0-9])", None),
    ("phone", False, r"(?<![0-9+.(-])(?<![0-9] )[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9.-])", None),
)

# Top-level domains, calling codes, first digits of card numbers.
_DOMAINS = "com org net edu gov int info biz io ai co de fr es it nl be ch at uk us ca au jp cn in br ru pl se no dk fi eu".split()
_CALLING = (
    "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 "
    "90 91 92 93 94 95 98 212 213 216 234 254 351 352 353 354 358 359 370 371 372 380 385 420 421 852 880 886 966 971 972"
).split()
_ISSUERS = "3 4 5 6".split()
# Words before a span that speak for it or against it.
_FOR = {
    "email": "mail|contact|write|reach|send|kontakt|correo|courriel|schreib",
    "ip": r"\bip\b|address|host|server|client|from|login|adresse",
    "card": "card|credit|visa|amex|master|payment|karte|carte|tarjeta|zahlung",
    "phone": "phone|tel|call|mobile|fax|contact|whatsapp|anruf|telefon|appel|llam",
}
_AGAINST = {
    "email": "git|ssh|package|npm",
    "ip": "version|section|chapter|release|build|abschnitt",
    "card": "order|isbn|invoice|tracking|serial|bestell|hash|token|password|secret",
    "phone": "order|isbn|invoice|version|serial|date|datum|fecha|hash|token|password",
}

_LABELERS = ("check", "gazetteer", "context", "edges")
_FEATURES = ("digits", "length", "left", "right", "marks", "said")


@dataclass(frozen=True)
class Supervision:
    """``rounds`` of expectation maximisation; ``accept`` is the least chance of an added span."""

    rounds: int = 50
    accept: float = 0.5


def _span(number: int, kind: str, strict: bool) -> Callable[[Column, Column], Column]:
    return lambda z, i: F.struct(
        F.lit(number).alias("rule"),
        F.lit(kind).alias("kind"),
        F.lit(strict).alias("strict"),
        i.alias("nth"),
        F.char_length(z["gap"]).alias("gap"),
        z["value"].alias("value"),
        F.right(z["gap"], F.lit(32)).alias("before"),
        F.left(z["next"], F.lit(8)).alias("after"),
    )


def _proposed(text: Column) -> Column:
    """All matches of all patterns, with what stands before them since the last match."""
    arrays = []
    for number, (kind, strict, pattern, needed) in enumerate(_PROPOSALS):
        gaps, values = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        spans = F.transform(
            F.arrays_zip(
                F.slice(gaps, 1, F.size(gaps) - 1).alias("gap"),
                values.alias("value"),
                F.slice(gaps, 2, F.size(gaps) - 1).alias("next"),
            ),
            _span(number, kind, strict),
        )
        there = F.rlike(text, F.lit(pattern))
        if needed:
            there = F.contains(text, F.lit(needed)) & there
        arrays.append(F.when(there, spans).otherwise(F.array().cast(_SPAN)))
    return F.concat(*arrays)


_SPAN = (
    "array<struct<rule:int,kind:string,strict:boolean,nth:int,gap:int,value:string,"
    "before:string,after:string>>"
)


def _luhn(digits: Column) -> Column:
    size = F.char_length(digits)

    def worth(i: Column) -> Column:
        digit = F.substring(digits, size - i + 1, F.lit(1)).cast("int")
        doubled = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return F.when(i % 2 == 0, doubled).otherwise(digit)

    places = F.sequence(F.lit(1), F.greatest(size, F.lit(1)))
    return F.aggregate(F.transform(places, worth), F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def _checked() -> Column:
    """Whether a span passes its kind's own check."""
    value, digits = F.col("value"), F.col("digit_text")
    count = F.char_length(digits)
    byte = lambda p: (F.char_length(F.ltrim(p, F.lit("0"))) <= 3) & (
        F.right(p, F.lit(3)).cast("int") <= 255
    )
    return (
        F.when(F.col("kind") == "email", F.lit(True))
        .when(F.col("kind") == "ip", F.forall(F.split(value, "[.]"), byte))
        .when(F.col("kind") == "card", (count >= 12) & (count <= 19) & _luhn(digits))
        .otherwise((count >= 9) & (count <= 15))
    )


def _by_kind(table: dict[str, str], text: Column) -> Column:
    found = F.lit(False)
    for kind, words in table.items():
        found = F.when(F.col("kind") == kind, F.rlike(text, F.lit(f"(?i){words}"))).otherwise(found)
    return found


def _spans(docs: DataFrame) -> DataFrame:
    """Proposed spans with positions, votes and features, a row each."""
    read = docs.select(
        F.col("doc_id").cast("long"),
        F.xxhash64("text").alias("print"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    found = read.select("doc_id", "print", F.explode(_proposed(F.col("text"))).alias("span")).select(
        "doc_id", "print", "span.*"
    )
    # Repeated rows propose the same spans.
    found = found.dropDuplicates(["doc_id", "print", "rule", "nth"])
    earlier = (
        Window.partitionBy("doc_id", "print", "rule")
        .orderBy("nth")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    placed = found.withColumn(
        "end", F.sum(F.col("gap") + F.char_length("value")).over(earlier).cast("int")
    ).withColumn("start", F.col("end") - F.char_length("value"))
    placed = placed.withColumn("digit_text", F.regexp_replace("value", "[^0-9]", "")).withColumn(
        "passed", _checked()
    )
    lower = F.lower("value")
    prefix = lambda codes: F.rlike("digit_text", F.lit(f"^(?:00)?(?:{'|'.join(codes)})"))
    gazetteer = (
        F.when(F.col("kind") == "email", F.rlike(lower, F.lit(rf"(?:\.|\bdot\b)\W*(?:{'|'.join(_DOMAINS)})$")).cast("int"))
        .when(F.col("kind") == "card", prefix(_ISSUERS).cast("int"))
        .when((F.col("kind") == "phone") & F.rlike("value", F.lit(r"^(?:\+|00)")), prefix(_CALLING).cast("int"))
        .when((F.col("kind") == "ip") & F.rlike("value", F.lit(r"^(?:0|127|255)\.")), F.lit(0))
    )
    context = F.when(_by_kind(_AGAINST, F.col("before")), F.lit(0)).when(
        _by_kind(_FOR, F.col("before")), F.lit(1)
    )
    edge = lambda side: F.when(F.rlike(side, F.lit(r"\w")), 2).when(side == "", 0).otherwise(1)
    left, right = edge(F.right("before", F.lit(1))), edge(F.left("after", F.lit(1)))
    return placed.select(
        "doc_id",
        "print",
        "kind",
        "start",
        "end",
        (F.col("strict") & F.col("passed")).alias("base"),
        F.when(F.col("strict") | (F.col("kind") == "phone"), F.col("passed").cast("int")).alias("check"),
        gazetteer.alias("gazetteer"),
        context.alias("context"),
        F.when((left == 2) | (right == 2), F.lit(0)).otherwise(1).alias("edges"),
        F.least(F.floor(F.char_length("digit_text") / 3), F.lit(7)).cast("int").alias("digits"),
        F.least(F.floor(F.char_length("value") / 6), F.lit(7)).cast("int").alias("length"),
        left.alias("left"),
        right.alias("right"),
        F.least(F.char_length(F.regexp_replace("value", r"[\w ]", "")), F.lit(4)).cast("int").alias("marks"),
        F.coalesce(context, F.lit(2)).alias("said"),
    )


def _reliabilities(patterns: dict[tuple, float], rounds: int) -> dict[tuple, float]:
    """Chance of truth per (kind, votes), by expectation maximisation over pattern counts.

    Starts from the share of votes in favour. Abstentions say nothing.
    """
    truth = {}
    for key in patterns:
        votes = [v for v in key[1:] if v is not None]
        truth[key] = (sum(votes) + 0.5) / (len(votes) + 1.0)
    for _ in range(rounds):
        prior: dict = defaultdict(lambda: [1.0, 1.0])
        agree: dict = defaultdict(lambda: [[1.0, 3.0], [3.0, 1.0]])
        for key, n in patterns.items():
            for y, p in ((0, 1 - truth[key]), (1, truth[key])):
                prior[key[0]][y] += n * p
                for j, v in enumerate(key[1:]):
                    if v is not None:
                        # Row: the truth; column: the vote. More likely right at first.
                        agree[key[0], j][y][1 - v] += n * p
        for key in patterns:
            odds = math.log(prior[key[0]][1] / prior[key[0]][0])
            for j, v in enumerate(key[1:]):
                if v is not None:
                    for_, against = agree[key[0], j][1], agree[key[0], j][0]
                    odds += math.log(for_[1 - v] / sum(for_)) - math.log(against[1 - v] / sum(against))
            truth[key] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return truth


def _classifier(
    counts: dict[tuple, float], truth: dict[tuple, float]
) -> dict[tuple, float]:
    """Chance per (kind, features), by naive Bayes on the soft labels of the votes."""
    kinds: dict = defaultdict(lambda: [1.0, 1.0])
    seen: dict = defaultdict(lambda: [0.5, 0.5])
    votes = 1 + len(_LABELERS)
    for key, n in counts.items():
        p = truth[key[:votes]]
        for y, part in ((0, n * (1 - p)), (1, n * p)):
            kinds[key[0]][y] += part
            for j, v in enumerate(key[votes:]):
                seen[key[0], j, v][y] += part
    chances = {}
    for key in counts:
        features = (key[0], *key[votes:])
        total = kinds[key[0]]
        odds = math.log(total[1] / total[0])
        for j, v in enumerate(key[votes:]):
            no, yes = seen[key[0], j, v]
            odds += math.log(yes / total[1]) - math.log(no / total[0])
        chances[features] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return chances


def personal_data(docs: DataFrame, supervision: Supervision = Supervision()) -> DataFrame:
    """``(doc_id, kind, start, end, base, chance)``: each span of personal data.

    Positions count code points, ``end`` exclusive. ``base`` spans come from the
    strict patterns and pass their kind's check; further spans do not overlap one, have
    neither their kind's check nor the words before them against them, and have a ``chance`` of at least ``supervision.accept``. A null text has none;
    repeated rows of id and text count once (``print``, a hash of the text, tells
    apart rows that repeat only the id). docs: ``doc_id`` and ``text``.
    """
    spark = docs.sparkSession
    spans = save(_spans(docs), "spans")
    columns = ["kind", *_LABELERS, *_FEATURES]
    # At most 4 kinds x 3**4 votes x 8 x 8 x 3 x 3 x 5 x 3 features, whatever the input.
    counts = {tuple(r)[:-1]: float(r[-1]) for r in spans.groupBy(*columns).count().collect()}
    patterns: dict = defaultdict(float)
    for key, n in counts.items():
        patterns[key[: 1 + len(_LABELERS)]] += n
    chances = _classifier(counts, _reliabilities(patterns, supervision.rounds))
    table = spark.createDataFrame(
        [(*key, chance) for key, chance in chances.items()],
        "kind string, " + ", ".join(f"{f} int" for f in _FEATURES) + ", chance double",
    )
    judged = spans.join(F.broadcast(table), ["kind", *_FEATURES])

    per_text = Window.partitionBy("doc_id", "print").orderBy("start", "end", "kind")
    before = F.max(F.when(F.col("base"), F.col("end"))).over(
        per_text.rowsBetween(Window.unboundedPreceding, -1)
    )
    after = F.min(F.when(F.col("base"), F.col("start"))).over(
        per_text.rowsBetween(1, Window.unboundedFollowing)
    )
    sound = F.coalesce(F.col("check") == 1, F.lit(True)) & F.coalesce(F.col("context") == 1, F.lit(True))
    free = F.coalesce(before <= F.col("start"), F.lit(True)) & F.coalesce(after >= F.col("end"), F.lit(True))
    return (
        judged.withColumn("free", free)
        .where(F.col("base") | (F.col("free") & sound & (F.col("chance") >= supervision.accept)))
        .select("doc_id", "print", "kind", "start", "end", "base", "chance")
    )


def personal_data_by_document(docs: DataFrame, supervision: Supervision = Supervision()) -> DataFrame:
    """Counts of base spans per kind and the lists of spans, a row for each row of ``docs``."""
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    span = F.struct("start", rank.alias("rank"), "end", "kind")
    counts = [F.count_if(F.col("base") & (F.col("kind") == k)).alias(f"n_{k}") for k in KINDS]
    per_text = (
        personal_data(docs, supervision)
        .groupBy("doc_id", "print")
        .agg(
            *counts,
            F.array_sort(F.collect_set(F.when(F.col("base"), span))).alias("base_spans"),
            F.array_sort(F.collect_set(span)).alias("all_spans"),
        )
        .select(F.col("doc_id").alias("of"), F.col("print").alias("at"), *(f"n_{k}" for k in KINDS), "base_spans", "all_spans")
    )
    texts = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("print"))

    def listed(spans: str) -> Column:
        parts = F.transform(F.col(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.coalesce(F.array_join(parts, ","), F.lit(""))

    return texts.join(
        per_text, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("print") == F.col("at")), "left"
    ).select(
        "doc_id",
        *(F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(listed("base_spans").cast("binary"), 256).alias("base_sha256"),
        listed("all_spans").alias("spans"),
    )
