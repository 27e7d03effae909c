"""Toxic texts by string-kernel machines over their words.

The kernel counts common subsequences and lets them have gaps, so an insult with inserted
characters, endings or dots stays close to the one that was learned. Words are compared with a
bounded number of landmark words (Nyström). There are two machines: of the first a text is as
toxic as its worst word, of the second as its third worst, for insults that are made of ordinary
parts and give a text away only when they keep coming.

Labels are given for texts, not words. The words to learn from hold a telling string of a few
characters: one that stands in so many toxic texts (for the second machine: in two words of so
many), and hardly in clean ones, that chance does not explain it. Single clean texts with an insult
(wrong labels, quotations) do not save it. Near copies count as one text, so that words which merely
stand in copies of one toxic text are not taken for insults. All of the learning data are drawn from
labelled texts up to stated bounds; scoring covers every whole text. Only words that share two
strings of three characters with one of the things learned are compared at all.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.held import held, let_go
from ledgerlens.llm.staging import ROW, Stage, as_bytes, row_number, ship_package, without
from ledgerlens.llm.string_kernel import Machine, fit

#: Labelled texts to learn from, chosen by a hash of their ids; the only bounds on learning.
TOXIC_TEXTS, CLEAN_TEXTS = 3000, 6000

#: Words the machine is fitted on, and landmarks, of either class.
FITTED_WORDS, TOXIC_LANDMARKS, CLEAN_LANDMARKS = 1200, 48, 16

#: Least number of toxic texts (near copies once) with a telling string, and the probability
#: at which a string counts as telling by chance.
LEAST_SUPPORT, CHANCE = 5, 1e-7

#: Words at more than so many times their rate of clean texts in toxic ones may be insults, where they
#: hold a telling string, and are no examples of clean words.
FAR_MORE = 5

#: The machines: telling strings stand in so many words of a text, which counts by its n-th worst
#: word, and may have so many clean texts for each toxic one (labels err, texts quote; ordinary
#: parts meet by chance).
LEVELS = ((1, 1, 0.02), (2, 3, 0.05))

#: What a clean text that is rejected costs against a toxic one that is kept.
BLAME = 3.0

#: Decision for texts without enough words to compare.
LEAST = -10.0

#: Words that tell near copies.
_SAMPLED_WORDS = 12

#: A text is predicted toxic from this score on.
REJECT_AT = 0.7

#: Steepness of the score over the machine's decisions, whose margin is 1.
SLOPE = 4.0

#: Longer words are compared in overlapping windows of this many characters.
LONG_WORD = 24

#: Words whose decisions a Python worker remembers.
REMEMBERED = 250_000

_EDGE = ".,;:!?\"'()[]{}<>«»“”‘’…*#$%&/|\\-_=+~^`@"

#: Letters written apart from each other.
_SPACED = re.compile(r"(?<!\w)\w(?:[\s._*+|-]{1,2}\w(?!\w)){3,}")


def words(text: str) -> set[str]:
    """The distinct strings of a text that are compared, all of it covered."""
    lowered = text.lower()
    found = {word.strip(_EDGE) for word in set(lowered.split())}
    found.update("".join(filter(str.isalnum, run)) for run in _SPACED.findall(lowered))
    step = LONG_WORD // 2
    return {
        part
        for word in found
        if len(word) > 2
        for part in (
            [word]
            if len(word) <= LONG_WORD
            else (word[at : at + LONG_WORD] for at in range(0, len(word) - step, step))
        )
    }


def grams(word: str) -> set[str]:
    """Strings of four and five characters of a word with its ends marked."""
    marked = f"^{word}$"
    return {marked[at : at + size] for size in (4, 5) for at in range(len(marked) - size + 1)}


def _triples(string: str) -> list[str]:
    return [string[at : at + 3] for at in range(len(string) - 2)]


class _Gate:
    """Which words share two strings of three characters with one of some strings."""

    def __init__(self, strings: tuple[str, ...]):
        self.holders: dict[str, int] = {}
        for at, string in enumerate(strings):
            for triple in set(_triples(string)):
                self.holders[triple] = self.holders.get(triple, 0) | 1 << at

    def passes(self, word: str) -> bool:
        once = twice = 0
        for triple in set(_triples(f"^{word}$")):
            holders = self.holders.get(triple, 0)
            twice |= once & holders
            once |= holders
        return twice != 0


@dataclass(frozen=True)
class Level:
    """A word machine, what its words have to resemble, and the line that makes a probability of
    the decision for the ``rank``-th worst word of a text."""

    machine: Machine
    strings: tuple[str, ...]
    rank: int
    slope: float = 0.0
    offset: float = 0.0


@dataclass(frozen=True)
class Model:
    """The machines; a text has the score of the one that finds it most toxic."""

    levels: tuple[Level, ...]


class _Scorer:
    """Decisions of a worker, remembered by word."""

    def __init__(self, levels: tuple[Level, ...]):
        self.levels = levels
        self.gates = [_Gate(level.strings) for level in levels]
        #: Decisions by word, None for the many words that no machine looks at.
        self.known: dict[str, list[float] | None] = {}

    def _learn(self, fresh: list[str]) -> None:
        self.known.update(dict.fromkeys(fresh))
        for at, (level, gate) in enumerate(zip(self.levels, self.gates, strict=True)):
            some = [word for word in fresh if gate.passes(word)]
            for word, decision in zip(some, level.machine.decide(some).tolist() if some else (), strict=True):
                if self.known[word] is None:
                    self.known[word] = [LEAST] * len(self.levels)
                self.known[word][at] = decision

    def decide(self, texts: list[str]) -> list[list[float]]:
        """For every text the decision of every level."""
        if not self.levels:
            return [[] for _ in texts]
        found = [words(text) for text in texts]
        missing = set().union(*found) - self.known.keys()
        if len(self.known) + len(missing) > REMEMBERED:
            self.known.clear()
            missing = set().union(*found)
        self._learn(list(missing))
        answer = []
        for some in found:
            rated = [decisions for word in some if (decisions := self.known[word]) is not None]
            text = []
            for at, level in enumerate(self.levels):
                worst = sorted((decisions[at] for decisions in rated), reverse=True)
                text.append(worst[level.rank - 1] if len(worst) >= level.rank else LEAST)
            answer.append(text)
        return answer


def _scorer(levels: tuple[Level, ...]) -> _Scorer:
    """The scorer of this Python worker for these machines."""
    mark = tuple(
        (one.rank, one.strings, one.machine.weights.tobytes(), tuple(one.machine.landmarks)) for one in levels
    )
    return held(("toxicity", mark), lambda: _Scorer(levels))


def _decisions(texts: DataFrame, levels: tuple[Level, ...], fields: str) -> DataFrame:
    """``texts`` (other columns, then _text) with the decisions in place of the text."""
    names = [field.split()[0].strip("`") for field in fields.split(", ")]

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(levels)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                some = batch.slice(start, 500)
                raw = [text.as_py().decode("utf-8", "replace") for text in some.column("_text")]
                yield pa.RecordBatch.from_arrays(
                    [*some.columns[:-1], pa.array(scorer.decide(raw), pa.list_(pa.float64()))],
                    names=[*names, "decisions"],
                )

    return texts.mapInArrow(decide, f"{fields}, decisions array<double>")


def _sample(some: set[str]) -> list[str]:
    """A few words of a text, the same for texts with nearly the same words."""
    return sorted(some, key=lambda word: zlib.crc32(word.encode()))[:_SAMPLED_WORDS]


def _kinds(samples: list[list[str]]) -> list[int]:
    """A number per text, equal for near copies: they share most of their sampled words."""
    found: list[int] = []
    holders: dict[str, list[int]] = {}
    for at, sample in enumerate(samples):
        shared = Counter(kind for word in sample for kind in holders.get(word, ()))
        kind, times = max(shared.items(), key=lambda item: item[1], default=(at, 0))
        if times * 2 < len(sample) or not times:
            kind = at
            for word in sample:
                holders.setdefault(word, []).append(kind)
        found.append(kind)
    return found


def _by_chance(toxic: int, clean: int, share: float) -> float:
    """Probability that of all these texts at most ``clean`` are not toxic."""
    total = toxic + clean
    logs = (
        math.lgamma(total + 1) - math.lgamma(i + 1) - math.lgamma(total - i + 1)
        + i * math.log1p(-share) + (total - i) * math.log(share)
        for i in range(clean + 1)
    )
    return sum(map(math.exp, logs))


def _telling(counted: dict[str, tuple[int, int]], share: float) -> list[str]:
    """Strings of toxic texts that chance would not keep out of clean ones, most frequent first.

    With a toxic share s of the texts, a string of m texts falls into toxic ones only with a
    probability of s**m (and the binomial tail where some are clean); it is asked to be
    improbable for all strings together.
    """
    share = min(max(share, 1e-3), 0.999)
    telling = {
        gram: toxic for gram, (toxic, clean) in counted.items() if _by_chance(toxic, clean, share) <= CHANCE
    }
    return sorted(telling, key=lambda gram: (-telling[gram], gram))


def _spoiled(word: str) -> list[str]:
    """A word with characters put into it, as writers do who avoid filters."""
    middle = len(word) // 2
    return [
        word[:middle] + "." + word[middle:],
        word[:1] + "*" + word[1:],
        word[:middle] + word[middle : middle + 1] * 2 + word[middle:],
    ]


def learn(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
) -> Model:
    """Fit on labelled texts: at most TOXIC_TEXTS and CLEAN_TEXTS of them.

    Rows with a null key or label are left out; a key labelled both ways counts as toxic. Without
    texts of either class the model scores every text 0.5.
    """
    ship_package(docs.sparkSession)
    rated = (
        labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(key).alias("_key"))
        .agg(F.max((F.col(label) > 0).cast("int")).alias("toxic"))
    )
    order = (F.xxhash64("_key"), F.col("_key"))
    drawn = Stage(
        rated.where("toxic = 1").orderBy(*order).limit(TOXIC_TEXTS).unionByName(
            rated.where("toxic = 0").orderBy(*order).limit(CLEAN_TEXTS)
        ),
        "drawn-labels",
    ).frame
    # Two numbers for each of a stated number of texts: small enough for every executor.
    texts = Stage(
        docs.select(F.col(key).alias("_key"), as_bytes(text).alias("_text"))
        .join(F.broadcast(drawn), "_key")
        .select("_key", "toxic", "_text"),
        "drawn-texts",
    ).frame

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for at, raw in enumerate(batch.column("_text")):
                some, row = words(raw.as_py().decode("utf-8", "replace")), batch.slice(at, 1)
                lists = [pa.array([x], pa.list_(pa.string())) for x in (sorted(some), _sample(some))]
                yield pa.RecordBatch.from_arrays(
                    [row.column("toxic"), *lists], names=["toxic", "words", "sample"]
                )

    spelled = Stage(
        texts.select("toxic", "_text")
        .mapInArrow(spell, "toxic int, words array<string>, sample array<string>")
        .withColumn("at", F.monotonically_increasing_id()),
        "spelled",
    ).frame
    sampled = spelled.select("toxic", "at", "sample").orderBy("toxic", "at").collect()
    numbered = []
    for toxic in (0, 1):
        some = [row for row in sampled if row["toxic"] == toxic]
        numbered += zip([row["at"] for row in some], _kinds([row["sample"] for row in some]))
    # Near copies count once; two numbers for each of the drawn texts.
    kinds = docs.sparkSession.createDataFrame(numbered, "at bigint, kind bigint")
    occurring = Stage(
        spelled.select("toxic", "at", F.explode("words").alias("word"))
        .join(F.broadcast(kinds), "at")
        .select("word", "toxic", "kind")
        .distinct(),
        "occurring",
    ).frame
    vocabulary = Stage(
        occurring.groupBy("word")
        .agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean")),
        "vocabulary",
    ).frame
    both = {row["toxic"]: row["count"] for row in drawn.groupBy("toxic").count().collect()}
    far_more = F.col("toxic") * both.get(0, 0) > FAR_MORE * F.col("clean") * both.get(1, 0)
    harmless = vocabulary.where((F.col("clean") > 0) & ~far_more).select("word", "clean")
    share = both.get(1, 0) / max(1, sum(both.values()))
    found: list[Level] = []
    if both.get(1, 0) and not harmless.isEmpty():
        usual = _top(harmless.orderBy(F.desc("clean"), "word"), FITTED_WORDS // 3)
        various = _top(harmless.orderBy(F.xxhash64("word"), "word"), FITTED_WORDS)
        counted = _gram_counts(vocabulary, occurring)
        for least, rank, _ in LEVELS:
            telling = _telling(counted[least], share)
            insults = _insults(vocabulary.where(far_more & (F.col("toxic") > 0)), telling)
            if not insults:
                continue
            landmarks = _spread(insults, telling)[:TOXIC_LANDMARKS]
            # A whole insult, or where it is made of ordinary parts the telling one of them.
            strings = tuple(f"^{word}$" for word in landmarks) if least == 1 else tuple(telling)
            landmarks += usual[:CLEAN_LANDMARKS]
            level = Level(_fit(insults, usual + various, landmarks), strings, 1)
            # Once more with the clean words that come closest.
            hard = _decisions(
                harmless.select("word", F.col("word").cast("binary").alias("_text")), (level,), "word string"
            )
            closest = _top(hard.orderBy(F.desc(F.col("decisions")[0]), "word"), FITTED_WORDS // 3)
            found.append(Level(_fit(insults, usual + various + closest, landmarks), strings, rank))
    rated = _decisions(texts.select("toxic", "_text"), tuple(found), "toxic int").collect()
    lines = [_line([(row["decisions"][at], row["toxic"]) for row in rated]) for at in range(len(found))]
    return Model(
        tuple(
            replace(level, slope=slope, offset=offset)
            for level, (slope, offset) in zip(found, lines, strict=True)
            if slope
        )
    )


def _spread(insults: list[str], telling: list[str]) -> list[str]:
    """The insults in an order that begins with one for each telling string."""
    first = dict.fromkeys(
        next((word for word in insults if gram in f"^{word}$"), insults[0]) for gram in telling
    )
    return list(dict.fromkeys([*first, *insults]))


def _top(ordered: DataFrame, count: int) -> list[str]:
    return [row["word"] for row in ordered.select("word").limit(count).collect()]


def _fit(insults: list[str], harmless: list[str], landmarks: list[str]) -> Machine:
    spoiled = sorted({variant for word in insults[: FITTED_WORDS // 4] for variant in _spoiled(word)})
    harmless = sorted(set(harmless) - set(insults))
    labels = np.repeat([1.0, -1.0], [len(insults) + len(spoiled), len(harmless)])
    return fit(insults + spoiled + harmless, labels, landmarks)


def _cut(words_: DataFrame) -> DataFrame:
    """gram and word for every string of four or five characters of every word."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            pairs = [(gram, word) for word in batch.column("word").to_pylist() for gram in grams(word)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([pair[at] for pair in pairs], pa.string()) for at in (0, 1)], ["gram", "word"]
            )

    return words_.select("word").mapInArrow(cut, "gram string, word string")


def _gram_counts(vocabulary: DataFrame, occurring: DataFrame) -> dict[int, dict[str, tuple[int, int]]]:
    """For every level the strings that may tell, with the toxic and the clean texts they stand in.

    A text counts (near copies once) where so many of its words, as the level asks, hold the
    string. Strings that stand in fewer than LEAST_SUPPORT toxic texts, or in more clean texts than
    three errors above the level's rate, are left out before anything is gathered.
    """

    def texts(toxic: int, pairs: DataFrame) -> DataFrame:
        return (
            pairs.join(occurring.where(F.col("toxic") == toxic), "word")
            .groupBy("gram", "kind")
            .agg(F.count(F.lit(1)).alias("words"))
            .groupBy("gram")
            .agg(*[F.count_if(F.col("words") >= least).alias(f"texts{toxic}_{least}") for least, *_ in LEVELS])
        )

    first = min(least for least, *_ in LEVELS)
    toxic = Stage(
        texts(1, _cut(vocabulary.where("toxic > 0"))).where(F.col(f"texts1_{first}") >= LEAST_SUPPORT),
        "toxic-strings",
    ).frame
    clean = texts(0, _cut(vocabulary.where("clean > 0")).join(toxic.select("gram"), "gram"))
    both = Stage(toxic.join(clean, "gram", "left").fillna(0), "strings").frame
    found = {}
    for least, _, clean_rate in LEVELS:
        times, spoilt = F.col(f"texts1_{least}"), F.col(f"texts0_{least}")
        expected = F.lit(clean_rate) * times
        rows = both.where((times >= LEAST_SUPPORT) & (spoilt <= expected + 3 * F.sqrt(expected)))
        found[least] = {row[0]: (row[1], row[2]) for row in rows.select("gram", times, spoilt).collect()}
    return found


def _insults(words_: DataFrame, telling: list[str]) -> list[str]:
    """Words with a telling string, those of most toxic texts first."""
    if not telling:
        return []
    listed = words_.sparkSession.createDataFrame([(gram,) for gram in telling], "gram string")
    held_ = _cut(words_).join(listed, "gram", "left_semi").select("word").distinct()
    return _top(words_.join(held_, "word").orderBy(F.desc("toxic"), "word"), FITTED_WORDS)


def _line(rated: list[tuple[float, int]]) -> tuple[float, float]:
    """Slope and offset of a logistic curve that is REJECT_AT where the classes part best.

    The place is the middle of the widest gap among the cheapest cuts, a blamed clean text costing
    BLAME times a missed toxic one. Where no cut is better than none, there is no line (0, 0).
    """
    if len({toxic for _, toxic in rated}) < 2:
        return 0.0, 0.0
    order = sorted(rated)
    x = np.asarray([decision for decision, _ in order])
    y = np.asarray([toxic for _, toxic in order], dtype=np.float64)
    missed = np.concatenate([[0], np.cumsum(y)]) / y.sum()
    blamed = 1 - np.concatenate([[0], np.cumsum(1 - y)]) / (1 - y).sum()
    ends = np.concatenate([[x[0] - 1], x, [x[-1] + 1]])
    gaps, cost = np.diff(ends), missed + BLAME * blamed
    cost[gaps <= 0] = np.inf
    if cost.min() > 1 - 1e-9:  # no better than chance
        return 0.0, 0.0
    best = np.flatnonzero(cost <= cost.min() + 1e-12)
    at = best[np.argmax(gaps[best])]
    middle = (ends[at] + ends[at + 1]) / 2
    return SLOPE, math.log(REJECT_AT / (1 - REJECT_AT)) - SLOPE * float(middle)


def score_texts(
    docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row: key and score (0 to 1). A null text is empty and has the score of no words."""
    ship_package(docs.sparkSession)
    plain = docs.select(F.col(key).alias("_key"), as_bytes(text).alias("_text"))
    kind = plain.schema["_key"].dataType.simpleString()
    decided = _decisions(plain, model.levels, f"_key {kind}")
    return decided.select(F.col("_key").alias(key), _score(model).alias("score"))


def keep_clean(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all columns, null texts included."""
    model = learn(docs, labels, key, text)
    marked = docs.select(row_number().alias("_row"), as_bytes(text).alias("_text"))
    ship_package(docs.sparkSession)
    decided = _decisions(marked, model.levels, "_row bigint")
    toxic = Stage(
        decided.where(_score(model) >= REJECT_AT).select(F.col("_row").alias(ROW)), "toxic-rows"
    ).frame
    return without(docs, toxic)


def _score(model: Model) -> Column:
    if not model.levels:
        return F.lit(0.5)
    scores = []
    for at, level in enumerate(model.levels):
        exponent = F.lit(level.slope) * F.col("decisions")[at] + F.lit(level.offset)
        bounded = F.greatest(F.least(-exponent, F.lit(700.0)), F.lit(-700.0))
        scores.append(F.lit(1.0) / (F.lit(1.0) + F.exp(bounded)))
    return scores[0] if len(scores) == 1 else F.greatest(*scores)
