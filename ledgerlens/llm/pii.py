"""Personal data: patterns propose spans, checksums confirm them, nearby words weigh them.

DataFrame functions only. Positions come from the texts between the matches, so they count code
points. The patterns never look at a character more often than a small number of times: starts
inside a run that has already failed are excluded, and repeated groups are possessive, so that a
text of one endless number or name costs time in proportion to its length. Account numbers are
sought from every start in the next 60 characters at most.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.staging import as_text

#: Spans at or above this score are reported for kinds that are not base kinds.
REPORT_AT = 0.5

#: Characters on either side in which context words count.
CONTEXT = 40

_LOCAL = "[A-Za-z0-9._%+-]"


@dataclass(frozen=True)
class Kind:
    name: str
    #: Cheap test whether a text can hold a match at all.
    hint: str
    pattern: str
    #: Score of a confirmed match, before context.
    score: float
    context: str
    base: bool = True
    #: Group of the pattern that holds a run in which the match is sought; the pattern itself then
    #: takes only the run's first characters, so that later starts are seen too.
    run: int = 0
    first: int = 0


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn checksum."""
    reverse = F.split(F.reverse(digits), "")
    doubled = F.transform(
        reverse,
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            F.when(d.cast("int") * 2 > 9, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)
        ),
    )
    return F.aggregate(doubled, F.lit(0), lambda total, d: total + d) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number (country, check digits, rest) leaves 1 modulo 97."""
    compact = F.regexp_replace(account, " ", "")
    turned = F.concat(F.substring(compact, 5, 40), F.substring(compact, 1, 4))
    def step(rest, sign):
        letter = F.ascii(sign) >= 65
        value = F.when(letter, F.ascii(sign) - 55).otherwise(F.ascii(sign) - 48)
        return (rest * F.when(letter, F.lit(100)).otherwise(F.lit(10)) + value) % 97
    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


#: Characters of an account number by country; other countries' numbers may have any length.
ACCOUNT_LENGTHS = {
    code: size
    for size, codes in (
        (15, "NO"),
        (16, "BE"),
        (18, "DK FI FK FO GL NL SD"),
        (19, "MK SI"),
        (20, "AT BA EE KZ LT LU MN XK"),
        (21, "CH HR LI LV"),
        (22, "BG BH CR DE GB GE IE ME RS VA"),
        (23, "AE GI IL IQ OM SO TL"),
        (24, "AD CZ ES MD PK RO SA SE SK TN VG"),
        (25, "LY PT ST"),
        (26, "IS TR"),
        (27, "BI DJ FR GR IT MC MR SM"),
        (28, "AL AZ BY CY DO GT HU LB NI PL SV"),
        (29, "BR EG PS QA UA"),
        (30, "JO KW MU YE"),
        (31, "MT SC"),
        (32, "LC"),
        (33, "RU"),
    )
    for code in codes.split()
}


def account_in(run: Column) -> Column:
    """The account number a run begins with, null where there is none.

    It ends where a group of the run ends and passes the checksum; among several ends the one of
    the country's length, else the longest.
    """
    sizes = F.create_map(*[F.lit(x) for pair in ACCOUNT_LENGTHS.items() for x in pair])
    parts = F.split(run, " ")
    ends = F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), " ")
    )
    length = lambda some: F.length(F.regexp_replace(some, " ", ""))
    sized = F.filter(ends, lambda some: length(some).between(15, 34) & some.rlike("^[A-Z0-9 ]+$"))
    valid = F.filter(sized, mod97)
    ranked = F.transform(
        valid,
        lambda some: F.struct(
            F.coalesce(sizes[F.substring(run, 1, 2)] == length(some), F.lit(False)).alias("exact"),
            F.length(some).alias("size"),
            some.alias("account"),
        ),
    )
    return F.array_max(ranked)["account"]


def _octets(match: Column) -> Column:
    """Whether all parts of a dotted number are at most 255."""
    def fits(part):
        plain = F.regexp_replace(part, "^0+(?=[0-9])", "")
        return (F.length(plain) <= 3) & (F.substring(plain, 1, 3).cast("int") <= 255)
    return F.forall(F.split(match, r"\."), fits)


KINDS = (
    Kind(
        "email",
        "@",
        rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        0.9,
        r"e-?mail|contact|write|correo|courriel",
    ),
    Kind(
        "ip",
        r"[0-9]\.[0-9]",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        0.6,
        r"\bip\b|address|host|server|adresse",
    ),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?[0-9]){11}",
        r"[0-9](?:[\x20-]?+[0-9]){11,}+",
        0.8,
        r"card|visa|credit|payment|karte|tarjeta|carte",
    ),
    Kind(
        "phone",
        r"\+[0-9]",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        0.6,
        r"phone|call|tel|mobile|fax|anruf",
    ),
    Kind(
        "iban",
        r"[A-Z]{2}[0-9]{2}[\x20A-Z0-9]",
        # The run goes on over following capitals and digits, and one letter more shows where it is cut.
        r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?:\x20?+[A-Z0-9]){11,30}+[A-Za-z0-9]?+))[A-Z]{2}[0-9]{2}",
        0.8,
        r"iban|account|bank|konto|cuenta|compte",
        base=False,
        run=1,
        first=4,
    ),
    Kind(
        "national_id",
        r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        0.3,
        r"\bssn\b|social|security|identity",
        base=False,
    ),
)


def _confirmed(kind: Kind, match: Column) -> Column:
    """The checksum or range check of a kind."""
    if kind.name == "card":
        digits = _digits(match)
        sized = F.length(digits).between(12, 19)
        return F.when(sized, luhn(digits)).otherwise(F.lit(False))
    if kind.name == "phone":
        return F.length(_digits(match)).between(9, 15)
    if kind.name == "ip":
        return _octets(match)
    return F.lit(True)


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also where the body uses it for each element."""
    return F.transform(F.array(value), body)[0]


def _fold(items: Column, state: Column, step, found: str) -> Column:
    """The elements that ``step`` finds on its way through an array, in time of about n times its root.

    ``step(state, item)`` gives the next state and an array of found elements. Appending to one
    array would copy it each time, so stretches of about the root of n items have arrays of their own.
    """
    empty = F.array().cast(f"array<{found}>")

    def stretches(known):
        width = F.greatest(F.ceil(F.sqrt(F.size(known))).cast("int"), F.lit(1))
        return F.transform(
            F.sequence(F.lit(0), F.floor((F.size(known) - 1) / width).cast("int")),
            lambda at: F.slice(known, at * width + 1, width),
        )

    def through(done, item):
        after, some = step(done["state"], item)
        return F.struct(after.alias("state"), F.concat(done["found"], some.cast(f"array<{found}>")).alias("found"))

    def stretch(done, part):
        return F.aggregate(
            part,
            F.struct(done["state"].alias("state"), empty.alias("found")),
            through,
            lambda last: F.struct(
                last["state"].alias("state"), F.concat(done["found"], F.array(last["found"])).alias("found")
            ),
        )

    start = F.struct(state.alias("state"), F.array().cast(f"array<array<{found}>>").alias("found"))
    every = lambda known: F.aggregate(stretches(known), start, stretch, lambda last: F.flatten(last["found"]))
    return _let(items, lambda known: F.when(F.size(known) > 0, every(known)).otherwise(empty))


def _accounts(placed: Column) -> Column:
    """Runs cut to the account numbers they begin with; none begins inside an earlier one."""
    cut = F.transform(
        placed, lambda span: F.struct(span["start"].alias("start"), account_in(span["match"]).alias("match"))
    )
    return _fold(
        F.filter(cut, lambda span: span["match"].isNotNull()),
        F.lit(0),
        lambda at, span: (
            F.when(span["start"] < at, at).otherwise(span["start"] + F.length(span["match"])),
            F.when(span["start"] < at, F.array()).otherwise(F.array(span)),
        ),
        _PLACED,
    )


_PLACED = "struct<start:int,match:string>"
_SPAN = "array<struct<start:int,rank:int,kind:string,end:int,score:double>>"


#: Characters of the parts in which a text is looked up.
_PART = 512


def _parts(text: Column) -> Column:
    """A text in parts of _PART code points, so that looking up a place does not scan the text."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_PART}}}"), F.lit(0))


def _cut(parts: Column, begin: Column, size: Column) -> Column:
    """At most ``size`` characters of a text from a position on."""
    first = F.floor(begin / _PART).cast("int")
    near = F.slice(parts, first + 1, F.floor(size / _PART).cast("int") + 2)
    return F.substring(F.array_join(near, ""), begin - first * _PART + 1, size)


def _spans(rank: int, kind: Kind, text: Column) -> Column:
    """Confirmed spans of one kind with their scores, in order."""
    pattern = F.lit(kind.pattern)
    # split() gives the text between the matches, so the two lists tell every position.
    pairs = F.arrays_zip(
        F.split(text, kind.pattern, -1).alias("gap"),
        F.regexp_extract_all(text, pattern, F.lit(kind.run)).alias("match"),
    )
    taken = lambda match: F.lit(kind.first) if kind.run else F.length(match)
    placed = _fold(
        pairs,
        F.lit(0),
        lambda at, pair: (
            at + F.length(pair["gap"]) + F.coalesce(taken(pair["match"]), F.lit(0)),
            F.when(pair["match"].isNull(), F.array()).otherwise(
                F.array(F.struct((at + F.length(pair["gap"])).alias("start"), pair["match"].alias("match")))
            ),
        ),
        _PLACED,
    )
    if kind.run:
        placed = _accounts(placed)
    confirmed = F.filter(placed, lambda span: _confirmed(kind, span["match"]))

    def scored(parts, span):
        begin, size = span["start"], F.length(span["match"])
        before = _cut(parts, F.greatest(begin - CONTEXT, F.lit(0)), F.least(begin, F.lit(CONTEXT)))
        after = _cut(parts, begin + size, F.lit(CONTEXT))
        near = F.lower(F.concat(before, F.lit(" "), after)).rlike(kind.context)
        score = F.lit(kind.score) + F.when(near, F.lit(0.3)).otherwise(F.lit(0.0))
        return F.struct(
            begin.alias("start"),
            F.lit(rank).alias("rank"),
            F.lit(kind.name).alias("kind"),
            (begin + size).cast("int").alias("end"),
            F.least(score, F.lit(1.0)).alias("score"),
        )

    found = _let(
        _parts(text), lambda parts: F.transform(confirmed, lambda span: scored(parts, span))
    )
    if not kind.base:
        found = F.filter(found, lambda span: span["score"] >= REPORT_AT)
    # Most texts hold no match of a kind: they cost one scan for the hint.
    return F.when(text.rlike(kind.hint), found.cast(_SPAN)).otherwise(F.array().cast(_SPAN))


def find_personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``pii_spans``: structs of start, rank, kind, end, score in order.

    ``start`` and ``end`` (exclusive) count code points of the whole text; a null text is empty
    and has no spans. Base kinds (email, ip, card, phone) are reported whenever they pass their
    check; account numbers and national ids only from a score of ``REPORT_AT`` on, which
    nearby words raise. Repeated rows each get their spans. A column of the same name is replaced.
    """
    source = as_text(text)
    every = F.flatten(F.array(*[_spans(i, kind, source) for i, kind in enumerate(KINDS)]))
    return docs.withColumn("pii_spans", F.array_sort(every))


def of_kind(*kinds: str):
    """A filter for spans of these kinds."""
    return lambda span: span["kind"].isin(*kinds)


def joined(spans: Column, wanted: tuple[str, ...] | None = None) -> Column:
    """Spans as kind:start:end, comma-joined."""
    if wanted is not None:
        spans = F.filter(spans, of_kind(*wanted))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def base_kinds() -> tuple[str, ...]:
    return tuple(kind.name for kind in KINDS if kind.base)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; null texts stay null.

    Where spans overlap, the one that begins first names the whole stretch.
    """
    found = find_personal_data(docs, text)
    source = F.col(text)
    end = F.struct(
        F.length(source).alias("start"), F.lit(len(KINDS)).alias("rank"), F.lit(None).cast("string").alias("kind"),
        F.length(source).alias("end"), F.lit(0.0).alias("score"),
    )

    def piece(parts, at, span):
        name = F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]"))
        return F.concat(_cut(parts, at, span["start"] - at), F.coalesce(name, F.lit("")))

    masked = _let(
        _parts(source),
        lambda parts: F.array_join(
            _fold(
                F.concat("pii_spans", F.array(end)),
                F.lit(0),
                lambda at, span: (
                    F.greatest(at, span["end"]),
                    F.when(span["start"] >= at, F.array(piece(parts, at, span))).otherwise(F.array()),
                ),
                "string",
            ),
            "",
        ),
    )
    return found.withColumn(
        text, F.when(F.size("pii_spans") > 0, masked).otherwise(source)
    ).drop("pii_spans")
