"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust a score."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daystrata.llm.common import text_of

# Characters of the gap on either side of a span in which context words are looked for.
NEAR = 40
# Matches of a text whose lengths are added up one by one; what comes before them is added up by blocks.
BLOCK = 64
SPAN = "struct<start:int,kind_no:int,end:int,kind:string,value:string,score:double>"


@dataclass(frozen=True)
class Kind:
    """A kind of personal data.

    ``pattern`` is linear in the text: a match starts where the previous one ended or where its run of characters
    starts, which is where the leftmost match of the plain pattern starts too. ``base`` is the score of a confirmed
    span; a context word ``near`` it adds 0.25, a word ``against`` it takes 0.25 away, within 0 and 1.
    """

    name: str
    pattern: str
    valid: Callable[[Column], Column]
    base: float
    near: tuple[str, ...]
    against: tuple[str, ...] = ()


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit of a string of digits is right."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: _luhn_digit(d.cast("int"), i))
    return F.aggregate(each, F.lit(0), lambda total, d: total + d) % 10 == 0


def _luhn_digit(digit: Column, place: Column) -> Column:
    twice = digit * 2
    return F.when(place % 2 == 0, digit).when(twice > 9, twice - 9).otherwise(twice)


def mod97(account: Column) -> Column:
    """Whether an account number (country, check digits, rest) leaves 1 when divided by 97."""
    turned = F.concat(F.substr(account, F.lit(5)), F.left(account, F.lit(4)))

    def step(rest: Column, char: Column) -> Column:
        number = F.ascii(char) - 48
        return F.when(number < 10, (rest * 10 + number) % 97).otherwise((rest * 100 + number + 3 - 10) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def _email(value: Column) -> Column:
    return F.lit(True)


def _ip(value: Column) -> Column:
    def fits(part: Column) -> Column:
        plain = F.regexp_replace(part, "^0+(?=[0-9])", "")
        return F.when(F.length(plain) > 3, False).otherwise(plain.cast("int") <= 255)

    return F.forall(F.split(value, "[.]"), fits)


def _card(value: Column) -> Column:
    digits = digits_of(value)
    return F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(False)


def _phone(value: Column) -> Column:
    return F.length(digits_of(value)).between(10, 15)


def _iban(value: Column) -> Column:
    account = F.replace(value, F.lit(" "), F.lit(""))
    return F.when(F.length(account).between(15, 34), mod97(account)).otherwise(False)


BASE_KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        _email,
        0.7,
        ("mail", "contact", "write"),
    ),
    Kind(
        "ip",
        r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        _ip,
        0.5,
        ("ip", "host", "server", "address"),
        ("version", "release"),
    ),
    Kind(
        "card",
        r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?[0-9])++",
        _card,
        0.6,
        ("card", "visa", "credit", "payment"),
        ("order", "isbn", "serial"),
    ),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", _phone, 0.6, ("phone", "call", "tel", "mobile"), ("offset",)),
)
# Kinds of the method's own, beside the base ones.
MORE_KINDS = (
    Kind(
        "iban",
        r"(?<![A-Za-z0-9_])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9_])",
        _iban,
        0.8,
        ("iban", "account", "bank"),
    ),
)
KINDS = BASE_KINDS + MORE_KINDS


def context_pattern(words: tuple[str, ...]) -> str:
    return "(?i)(?:^|[^A-Za-z])(?:" + "|".join(words) + ")"


def _word_near(text: Column, words: tuple[str, ...]) -> Column:
    return F.regexp_like(text, F.lit(context_pattern(words))) if words else F.lit(False)


def _score(kind: Kind, context: Column) -> Column:
    up = F.when(_word_near(context, kind.near), 25).otherwise(0)
    down = F.when(_word_near(context, kind.against), 25).otherwise(0)
    return F.greatest(F.lit(0), F.least(F.lit(100), F.lit(round(100 * kind.base)) + up - down)) / 100


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, wherever Spark moves the expression: it is bound, not looked up."""
    return F.element_at(F.transform(F.array(value), use), 1)


def find_spans(rows: DataFrame, kinds: tuple[Kind, ...] = KINDS, text: str = "text") -> DataFrame:
    """``rows`` with ``found``: structs (start, kind_no, end, kind, value, score), by start and kind.

    Splitting at a pattern gives the gaps between its matches, so places are running sums of the lengths of gaps and
    matches, in code points. Texts without a match are left after one look. A row number that is never below 0 keeps
    filters on the result from having it worked out again.
    """
    spans = F.array_sort(F.concat(*[_spans(kind, no, text) for no, kind in enumerate(kinds)]))
    return rows.withColumn("found", F.when(F.monotonically_increasing_id() >= 0, spans))


def _spans(kind: Kind, no: int, text: str) -> Column:
    """Confirmed spans of one kind."""
    nothing = F.array().cast(f"array<{SPAN}>")
    matched = F.struct(F.regexp_extract_all(text, F.lit(kind.pattern), 0).alias("hits"), F.split(text, kind.pattern, -1).alias("gaps"))
    found = _let(matched, lambda m: _let(_lengths(m), lambda lengths: _let(_starts(lengths), lambda s: _placed(kind, no, m, lengths, s))))
    valid = F.filter(found, lambda x: F.coalesce(kind.valid(x["value"]), F.lit(False)))
    return F.when(F.regexp_like(F.col(text), F.lit(kind.pattern)), valid).otherwise(nothing)


def _lengths(matched: Column) -> Column:
    """Characters of each gap and the match behind it."""
    return F.transform(matched["hits"], lambda hit, i: F.char_length(matched["gaps"][i]) + F.char_length(hit))


def _starts(lengths: Column) -> Column:
    """Characters before every block of BLOCK matches."""
    blocks = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int"))
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))

    def add(done: Column, block: Column) -> Column:
        return F.struct(
            (done["at"] + _sum(F.slice(lengths, block * BLOCK + 1, F.lit(BLOCK)))).alias("at"),
            F.array_append(done["starts"], done["at"]).alias("starts"),
        )

    return F.aggregate(blocks, first, add, lambda done: done["starts"])


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda total, n: total + n)


def _placed(kind: Kind, no: int, matched: Column, lengths: Column, starts: Column) -> Column:
    """A match starts behind its block's start, the earlier matches of the block and its own gap."""

    def place(hit: Column, i: Column) -> Column:
        block = F.floor(i / BLOCK).cast("int")
        gap, after = matched["gaps"][i], matched["gaps"][i + 1]
        start = starts[block] + _sum(F.slice(lengths, block * BLOCK + 1, i - block * BLOCK)) + F.char_length(gap)
        context = F.concat(F.right(gap, F.lit(NEAR)), F.lit(" "), F.left(after, F.lit(NEAR)))
        return F.struct(
            start.alias("start"), F.lit(no).alias("kind_no"), (start + F.char_length(hit)).alias("end"), F.lit(kind.name).alias("kind"),
            hit.alias("value"), _score(kind, context).alias("score"),
        )

    return F.transform(matched["hits"], place).cast(f"array<{SPAN}>")


def pii_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """Per input row: doc_id and ``found``, an array of (start, kind_no, end, kind, value, score).

    Null and empty texts have no spans. Rows are independent: repeated rows get the same answer, an empty table gives
    an empty result, and columns other than id and text are not looked at. Spans of different kinds may overlap; those
    of one kind do not. Failing matches are dropped and their characters are not tried again.
    """
    return find_spans(docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")), kinds).drop("text")


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def _count(name: str) -> Column:
    return F.size(F.filter("found", lambda x: x["kind"] == name)).cast("long")


def pii_digest(spans: DataFrame) -> DataFrame:
    """Counts, digest of the base spans, all spans and their scores as text, from the result of ``pii_spans``."""
    names = [k.name for k in BASE_KINDS]
    counts = [_count(name).alias(f"n_{name}") for name in names]
    return spans.select(
        "doc_id",
        *counts,
        F.sha2(joined(F.filter("found", lambda x: x["kind_no"] < len(names))), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
        F.array_join(F.transform("found", lambda x: F.format_string("%.2f", x["score"])), ",").alias("scores"),
    )
