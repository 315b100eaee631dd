"""Language identification by interpolated Kneser-Ney character models.

Per language, 4-grams of folded characters are counted over all training texts.
Discounts, continuation counts and back-off weights follow from them in Spark;
what is left per order is a sorted array of n-gram hashes with a number for each
language that has the gram. A text gets the language of lowest cross-entropy per
character, and a score from the margin to the second. It is rejected if its
cross-entropy is far above what texts of that language and length have. Margin and
cross-entropy are calibrated on an eighth of the training texts, which the counts leave out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.calibration import logistic
from evenkeel.llm.quality import held_out
from evenkeel.llm.scratch import discard, save
from evenkeel.llm.text import rows

ORDER = 4
UNKNOWN = "und"
_PAD, _SPACE = 1, 32
# n-grams of one order share this many hash values, which bounds a model's size.
_SLOT_BITS = 22
_MIX = 0x9E3779B97F4A7C15
# Longer texts are taken in parts, whose first characters see no earlier ones.
_PART = 1 << 20
_HELD_GRAMS = 1 << 21
# One in so many training texts (by hash, so copies go together) calibrates and is not counted.
_ASIDE = 8
# Calibrating texts farther out than all but this part of them are as foreign as the rejected.
_OUTLIERS = 0.001
# Above the cut, a cross-entropy of so many deviations more is rejected at the latest.
_SLACK = 4.0

_FOLDS: list[np.ndarray] = []


def _folds() -> np.ndarray:
    """Letters in lower case, anything else a space; beyond 16 bits letters share numbers."""
    if not _FOLDS:
        table = np.full(0x110000, _SPACE, dtype=np.uint16)
        for point in range(0x30000):
            char = chr(point)
            if char.isalpha():
                low = char.lower()
                table[point] = max(ord(low if len(low) == 1 else char) & 0xFFFF, _SPACE + 1)
        table[0] = _PAD
        _FOLDS.append(table)
    return _FOLDS[0]


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of the 4-grams that end at each character, the text of each, and letters per text."""
    pad = "\0" * (ORDER - 1)
    raw = pad + pad.join(t.replace("\0", " ") for t in texts)
    points = np.frombuffer(raw.encode("utf-32-le", "surrogatepass"), np.uint32)
    chars = _folds()[points]
    owner = np.repeat(np.arange(len(texts)), [len(t) + len(pad) for t in texts])
    keep = np.ones(len(chars), dtype=bool)
    keep[1:] = (chars[1:] != _SPACE) | (chars[:-1] != _SPACE)
    chars, owner = chars[keep].astype(np.uint64), owner[keep]
    codes = chars.copy()
    for back in range(1, ORDER):
        codes[back:] |= chars[:-back] << np.uint64(16 * back)
    real = chars != _PAD
    letters = np.bincount(owner[real & (chars != _SPACE)], minlength=len(texts))
    return codes[real], owner[real], letters


def _slot(codes: np.ndarray) -> np.ndarray:
    return (codes * np.uint64(_MIX)) >> np.uint64(64 - _SLOT_BITS)


# Sorted hashes, where the numbers of each begin, and the language and value of every number.
Table = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


@dataclass(frozen=True)
class Models:
    """Languages in code point order; per order sorted hashes, each with numbers of some languages."""

    languages: tuple[str, ...]
    shares: tuple[Table, ...]  # orders 1 to 4: discounted shares
    weights: tuple[Table, ...]  # contexts of 0 to 3: back-off weights
    symbols: int

    def parts(self) -> tuple:
        return self.languages, self.shares, self.weights, self.symbols

    def log_shares(self, codes: np.ndarray) -> np.ndarray:
        """log probability of each 4-gram's last character, per language."""
        p = np.full((len(codes), len(self.languages)), 1.0 / max(self.symbols, 1))
        for order in range(1, ORDER + 1):
            gram = codes & np.uint64((1 << 16 * order) - 1) if order < ORDER else codes
            context = gram >> np.uint64(16)
            width = len(self.languages)
            p = _looked_up(self.shares[order - 1], gram, 0.0, width) + p * _looked_up(
                self.weights[order - 1], context, 1.0, width
            )
        return np.log(np.maximum(p, 1e-12))


def _looked_up(table: Table, codes: np.ndarray, absent: float, width: int) -> np.ndarray:
    hashes, starts, langs, values = table
    found = np.full((len(codes), width), absent)
    if len(hashes):
        slots = _slot(codes)
        at = np.minimum(np.searchsorted(hashes, slots), len(hashes) - 1)
        there = np.flatnonzero(hashes[at] == slots)
        first = starts[at[there]]
        size = starts[at[there] + 1] - first
        # The numbers of one hash lie side by side.
        place = np.arange(size.sum()) + np.repeat(first - (np.cumsum(size) - size), size)
        found[np.repeat(there, size), langs[place]] = values[place]
    return found


_COUNTS = pa.schema([("lang", pa.string()), ("code", pa.int64()), ("n", pa.int64())])


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    total = 0

    def merge() -> None:
        for lang, pieces in held.items():
            codes = np.concatenate([c for c, _ in pieces])
            distinct, place = np.unique(codes, return_inverse=True)
            counts = np.bincount(place, weights=np.concatenate([n for _, n in pieces])).astype(np.int64)
            held[lang] = [(distinct, counts)]

    def released() -> Iterator[pa.RecordBatch]:
        merge()
        for lang, ((codes, counts),) in held.items():
            for start in range(0, len(codes), 1 << 16):
                part = codes[start : start + (1 << 16)].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(part)), pa.array(part), pa.array(counts[start : start + (1 << 16)])],
                    schema=_COUNTS,
                )
        held.clear()

    for texts, langs in _parts(batches):
        codes, owner, _ = _grams(texts)
        for lang in sorted(set(langs)):
            wanted = np.array([x == lang for x in langs])
            distinct, counts = np.unique(codes[wanted[owner]], return_counts=True)
            held.setdefault(lang, []).append((distinct, counts))
            total += len(distinct)
        if total > _HELD_GRAMS:
            yield from released()
            total = 0
    yield from released()


def _parts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list[str], list]]:
    """Texts, none longer than a part, with what stands beside them, about a part at a time."""
    texts: list[str] = []
    beside: list = []
    size = 0
    for text, mark in rows(batches):
        text = text or ""
        for start in range(0, max(1, len(text)), _PART):
            texts.append(text[start : start + _PART])
            beside.append(mark)
            size += len(texts[-1])
            if size >= _PART:
                yield texts, beside
                texts, beside, size = [], [], 0
    if texts:
        yield texts, beside


def learn(docs: DataFrame) -> Models:
    """Models of every language among the rows of ``docs(text, lang)``.

    What comes to the driver are at most 2**22 hashes per order and language.
    """
    known = docs.select(F.col("text").cast("string"), F.col("lang").cast("string")).where(
        "lang is not null and text is not null"
    )
    four = save(
        known.mapInArrow(_counted, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n")),
        "grams",
    )
    tables = {ORDER: four}
    for order in range(ORDER - 1, 0, -1):
        # How many characters stand before a shorter gram.
        shorter = F.col("code").bitwiseAND((1 << 16 * order) - 1)
        tables[order] = save(
            tables[order + 1].groupBy("lang", shorter.alias("code")).agg(F.count(F.lit(1)).alias("n")), "grams"
        )
    languages = tuple(sorted((r[0] for r in four.select("lang").distinct().collect()), key=lambda x: x.encode()))
    shares, weights = [], []
    for order in range(1, ORDER + 1):
        share, weight = _discounted(tables[order])
        shares.append(_arrays(share, languages))
        weights.append(_arrays(weight, languages))
    symbols = tables[1].select("code").distinct().count()
    for table in tables.values():
        discard(table)
    return Models(languages, tuple(shares), tuple(weights), symbols)


def _discounted(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Shares of grams and back-off weights of their contexts, by hash."""
    seen = table.groupBy("lang").agg(
        F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice")
    )
    discounts = {
        lang: once / (once + 2 * twice) if once and twice else 0.5 for lang, once, twice in seen.collect()
    }
    pairs = [x for lang, d in discounts.items() for x in (F.lit(lang), F.lit(float(d)))]
    discount = F.element_at(F.create_map(*pairs), F.col("lang")) if pairs else F.lit(0.5)
    marked = table.withColumn("context", F.shiftrightunsigned("code", 16))
    contexts = marked.groupBy("lang", "context").agg(
        F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds")
    )
    share = marked.join(contexts, ["lang", "context"]).select(
        "lang", "code", (F.greatest(F.col("n") - discount, F.lit(0.0)) / F.col("total")).alias("value")
    )
    weight = contexts.select(
        "lang", F.col("context").alias("code"), (discount * F.col("kinds") / F.col("total")).alias("value")
    )
    return share, weight


_SLOTTED = pa.schema([("lang", pa.string()), ("slot", pa.int64()), ("value", pa.float64())])


def _slotted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        slots = _slot(batch.column(1).to_numpy().view(np.uint64)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(slots), batch.column(2)], schema=_SLOTTED)


def _arrays(values: DataFrame, languages: tuple[str, ...]) -> Table:
    found = (
        values.mapInArrow(_slotted, "lang string, slot long, value double")
        .groupBy("lang", "slot")
        .agg(F.max("value").alias("value"))
        .toArrow()
    )
    column = {lang: i for i, lang in enumerate(languages)}
    which = np.array([column[x] for x in found["lang"].to_pylist()], dtype=np.int16)
    slots = found["slot"].to_numpy()
    order = np.lexsort((which, slots))
    hashes, starts = np.unique(slots[order], return_index=True)
    return (
        hashes.astype(np.uint64),
        np.append(starts, len(slots)).astype(np.int64),
        which[order],
        found["value"].to_numpy()[order],
    )


_SCORED = pa.schema(
    [("doc_id", pa.int64()), ("lang", pa.string()), ("best", pa.string()), ("margin", pa.float64()), ("entropy", pa.float64()), ("size", pa.int64())]
)


def _scored(model) -> Callable:
    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = Models(*model.value)
        for batch in batches:
            ids, texts, langs = batch.column(0), batch.column(1), batch.column(2)
            pairs = pa.RecordBatch.from_arrays([texts, pa.array(range(batch.num_rows))], names=["text", "row"])
            width = len(models.languages)
            sums = np.zeros((batch.num_rows, width))
            size = np.zeros(batch.num_rows)
            letters = np.zeros(batch.num_rows)
            for parts, row in _parts([pairs]):
                codes, owner, own_letters = _grams(parts)
                row = np.array(row)
                distinct, place = np.unique(codes, return_inverse=True)
                logs = models.log_shares(distinct)
                for k in range(width):
                    sums[:, k] += np.bincount(row[owner], weights=logs[place, k], minlength=batch.num_rows)
                size += np.bincount(row[owner], minlength=batch.num_rows)
                np.add.at(letters, row, own_letters)
            best: list[str | None] = [None] * batch.num_rows
            margin = np.zeros(batch.num_rows)
            entropy = np.zeros(batch.num_rows)
            if width:
                crossed = -sums / np.maximum(size, 1)[:, None]
                order = np.argsort(crossed, axis=1, kind="stable")
                first = crossed[np.arange(batch.num_rows), order[:, 0]]
                entropy = first
                if width > 1:
                    second = crossed[np.arange(batch.num_rows), order[:, 1]]
                    margin = (second - first) * np.sqrt(size)
                for i in np.flatnonzero(letters):
                    best[i] = models.languages[order[i, 0]]
            yield pa.RecordBatch.from_arrays(
                [ids, langs, pa.array(best, pa.string()), pa.array(margin), pa.array(entropy), pa.array(size.astype(np.int64))], schema=_SCORED
            )

    return found


def _spread(scored: DataFrame) -> tuple[dict[str, tuple[float, float, float]], float]:
    """Per language mean, variance of texts and variance of one character of the
    cross-entropy, and the cut of the deviations (languages x 64 rows reach the driver)."""
    length = F.least(F.floor(F.log2(F.col("size"))), F.lit(31)).alias("length")
    bins = (
        scored.groupBy("lang", length)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("entropy").alias("total"),
            F.sum(F.col("entropy") * F.col("entropy")).alias("squares"),
            F.avg(1 / F.col("size")).alias("short"),
        )
        .collect()
    )
    fits = {}
    for lang in {b.lang for b in bins}:
        own = [b for b in bins if b.lang == lang]
        n = np.array([b.n for b in own], dtype=float)
        # Long texts say more about the mean.
        trust = n / (0.01 + np.array([b.short for b in own]))
        mean = float(np.dot(trust, [b.total / b.n for b in own]) / trust.sum())
        off = np.array([b.squares / b.n - 2 * mean * b.total / b.n + mean * mean for b in own])
        short = np.array([b.short for b in own])
        # Variance = of texts + of one character / characters, by weighted least squares.
        middle, level = np.average(short, weights=n), np.average(off, weights=n)
        width = np.average((short - middle) ** 2, weights=n)
        slope = np.average((short - middle) * (off - level), weights=n) / width if width > 0 else 0.0
        slope = min(max(slope, 0.0), level / middle)
        fits[lang] = (mean, max(float(level - slope * middle), 1e-6), max(float(slope), 0.25))
    if not fits:
        return fits, 0.0
    steps = (
        scored.groupBy(F.ceil(F.greatest(F.lit(0.0), F.least(_deviation(fits, "lang"), F.lit(64.0))) * 4).alias("step"))
        .count()
        .orderBy(F.desc("step"))
        .collect()
    )
    beyond, allowed = 0, _OUTLIERS * sum(r["count"] for r in steps)
    for row in steps:
        beyond += row["count"]
        if beyond > allowed:
            return fits, row.step / 4
    return fits, 0.0


def _deviation(fits: dict[str, tuple[float, float, float]], language: str) -> Column:
    """How many deviations a text's cross-entropy lies above its language's mean."""
    pairs = [
        x
        for lang, (mean, texts, char) in sorted(fits.items())
        for x in (F.lit(lang), F.array(F.lit(mean), F.lit(texts), F.lit(char)))
    ]
    if not pairs:
        return F.lit(0.0)
    fit = F.element_at(F.create_map(*pairs), F.col(language))
    off = (F.col("entropy") - fit[0]) / F.sqrt(fit[1] + fit[2] / F.greatest("size", F.lit(1)))
    # A language without calibrating texts rejects nothing.
    return F.coalesce(off, F.lit(0.0))


def identify(docs: DataFrame, reject: float = 0.5) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score, entropy, deviation, rejected)``, a row for each row of ``docs``.

    Models and calibration come from rows with a language that are not held out.
    ``lang_pred`` is ``und`` if the text is null or has no letter, or if there is
    no model at all; then ``score`` is 0. Otherwise ``score`` is the chance that
    the language is right, made smaller for a cross-entropy (``deviation``) above
    that of nearly all calibrating texts; ``rejected`` says that it is below
    ``reject``, and ``lang_pred`` is then the nearest language. Of languages with
    equal cross-entropy the first by code point is taken. Repeated rows are counted and
    answered each. A text above 1 MiB is scored in parts as a whole; the first three
    characters of a part see no earlier ones. docs: ``doc_id, text, lang``; other
    columns are not read, and ``lang`` only of rows that are learned from.
    """
    held = held_out(F.col("doc_id"))
    drawn = F.pmod(F.xxhash64("text"), F.lit(_ASIDE)) == 0
    read = docs.select(
        F.col("doc_id").cast("long"),
        F.col("text").cast("string"),
        F.when(~held, F.col("lang").cast("string")).alias("lang"),
    )
    # A language with no other texts is counted from those that would calibrate.
    alone = read.where("lang is not null and text is not null").groupBy("lang").agg(F.bool_and(drawn).alias("all"))
    lonely = [r.lang for r in alone.where("all").select("lang").collect()]
    aside = drawn & ~F.coalesce(F.col("lang").isin(lonely), F.lit(False))
    # A broadcast names its classes, so it holds the plain parts.
    models = docs.sparkSession.sparkContext.broadcast(learn(read.where(~aside)).parts())
    scored = save(
        read.withColumn("lang", F.when(aside, F.col("lang"))).mapInArrow(
            _scored(models), "doc_id long, lang string, best string, margin double, entropy double, size long"
        ),
        "scored",
    )
    models.destroy()
    known = scored.where("lang is not null and best is not null")
    bins = (
        known.groupBy(F.round(F.least("margin", F.lit(50.0)) * 4).alias("bin"), (F.col("lang") == F.col("best")).alias("right"))
        .count()
        .collect()
    )
    slope, offset = logistic([(b / 4, int(right), n) for b, right, n in bins]) if bins else (1.0, 0.0)
    chance = 1 / (1 + F.exp(-(F.least("margin", F.lit(50.0)) * slope + offset)))
    fits, cut = _spread(known.where("lang = best"))
    above = F.least(F.greatest(F.col("deviation") - cut, F.lit(0.0)) / _SLACK, F.lit(700.0))
    fitting = F.exp(-above * float(np.log(2.0)))
    score = F.when(F.col("best").isNull(), F.lit(0.0)).otherwise(chance * fitting)
    return scored.withColumn("deviation", _deviation(fits, "best")).select(
        "doc_id",
        held.alias("held_out"),
        F.coalesce("best", F.lit(UNKNOWN)).alias("lang_pred"),
        score.alias("score"),
        "entropy",
        "deviation",
        (score < reject).alias("rejected"),
    )
