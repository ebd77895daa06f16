"""Quality rules as a short-circuit cascade of column expressions.

Features are expressions of the text, each evaluated once per row; rules are conditions on features.
On a bounded sample each rule is timed and its share of rejections taken; rules then run in the order
of rejections per second, inside one CASE, so that a text that a cheap rule rejects never reaches a
dear one. The order changes the work, never the verdict: a text is kept if no rule rejects it.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.session import cut_lineage

#: Rows of the sample on which costs and selectivities are estimated, about.
SAMPLE_ROWS = 2000
#: Bits of a place in a text: as many as an array can have.
_PLACE = 31
_SPACE = " \t\n\x0b\f\r"
_SYMBOLS = "#*$%&|<>"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_DIGITS = "0123456789"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` evaluated once however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _text(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def words_of(text: Column) -> Column:
    """Runs without ASCII white space; an empty array for none."""
    trimmed = F.btrim(_text(text), F.lit(_SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def _without(text: Column, chars: str) -> Column:
    return F.length(F.translate(_text(text), chars, ""))


def _count_of(text: Column, chars: str) -> Column:
    return (F.length(_text(text)) - _without(text, chars)).cast("long")


def n_words(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def word_chars(text: Column) -> Column:
    return _without(text, _SPACE).cast("long")


def n_symbols(text: Column) -> Column:
    return _count_of(text, _SYMBOLS)


def n_upper(text: Column) -> Column:
    return _count_of(text, _UPPER)


def n_digits(text: Column) -> Column:
    return _count_of(text, _DIGITS)


def n_lines(text: Column) -> Column:
    """Lines with a word."""
    return F.size(_lines(text)).cast("long")


def _lines(text: Column) -> Column:
    return F.filter(F.split(_text(text), "\n"), lambda line: F.btrim(line, F.lit(_SPACE)) != "")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return _let(_lines(text), lambda lines: (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"))


def n_repeat_words(text: Column) -> Column:
    """Words in 3-word windows that the text holds twice or more, the first included.

    A window is one number, bits of its hash above its place; sorted, windows that may be equal are
    neighbours: n log n for texts of any length, without a record per word. Those few are sorted again
    by the whole 64-bit hash. The starts of repeated windows, in order, cover three words each, less
    what the next one covers too.
    """

    def window(words: Column, i: Column) -> Column:
        return F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))

    def candidates(words: Column) -> Column:
        firsts = F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0)))
        numbers = F.transform(firsts, lambda _, i: F.shiftleft(window(words, i), _PLACE).bitwiseOR(i.cast("long")))

        def like(one: Column, other: Column) -> Column:
            return F.shiftright(one.bitwiseXOR(other), _PLACE) == 0

        return _let(F.sort_array(numbers), lambda ordered: F.filter(
            ordered, lambda one, j: like(one, F.get(ordered, j - 1)) | like(one, F.get(ordered, j + 1))
        ))

    def starts(words: Column) -> Column:
        hashed = F.transform(candidates(words), lambda one: _let(
            one.bitwiseAND(F.lit((1 << _PLACE) - 1)).cast("int"), lambda i: F.struct(window(words, i).alias("h"), i.alias("i"))
        ))
        return _let(F.sort_array(hashed), lambda ordered: F.sort_array(F.transform(
            F.filter(ordered, lambda w, j: (w["h"] == F.get(ordered, j - 1)["h"]) | (w["h"] == F.get(ordered, j + 1)["h"])),
            lambda w: w["i"],
        )))

    return F.aggregate(
        _let(words_of(text), starts),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
        lambda so_far, i: F.struct(
            (so_far["n"] + F.least(F.lit(3), i - so_far["last"])).alias("n"), i.alias("last")
        ),
        lambda so_far: so_far["n"],
    )


FEATURES: dict[str, Callable[[Column], Column]] = {
    f.__name__: f for f in (n_words, word_chars, n_symbols, n_upper, n_digits, n_lines, n_dup_lines, n_repeat_words)
}


@dataclass(frozen=True)
class Rule:
    """A text is rejected where ``fails``, given the columns of the features it names, is true."""

    name: str
    features: tuple[str, ...]
    fails: Callable[..., Column]


BASE_RULES = (
    Rule("few_words", ("n_words",), lambda n: n < 50),
    Rule("repeated_windows", ("n_repeat_words", "n_words"), lambda repeats, n: repeats * 100 > n * 50),
)
#: Beyond the base: bounds that prose in any language with spaces keeps far from.
RULES = (
    *BASE_RULES,
    Rule("symbols", ("n_symbols", "n_words"), lambda symbols, n: symbols * 4 > n),
    Rule("shouting", ("n_upper", "word_chars"), lambda upper, chars: upper * 10 > chars * 4),
    Rule("digits", ("n_digits", "word_chars"), lambda digits, chars: digits * 2 > chars),
    Rule("long_words", ("word_chars", "n_words"), lambda chars, n: chars > n * 25),
    Rule("repeated_lines", ("n_dup_lines", "n_lines"), lambda repeats, n: repeats * 2 > n),
)


def rejected(rule: Rule, text: Column, ready: Sequence[str] = ()) -> Column:
    """Whether ``rule`` rejects ``text``; features named in ``ready`` are taken from their columns."""
    return rule.fails(*(F.col(name) if name in ready else FEATURES[name](text) for name in rule.features))


def in_best_order(
    docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS, text_col: str = "text", seed: int = 0,
) -> list[tuple[Rule, float, float]]:
    """(rule, seconds on the sample, share rejected), most rejections per second first.

    The sample holds about ``sample_rows`` rows of the whole table, whatever its size. On an empty
    table the order stays as given.
    """
    total = docs.count()
    if not total:
        return [(rule, 0.0, 0.0) for rule in rules]
    sample = cut_lineage(docs.select(text_col).sample(min(1.0, sample_rows / total), seed).repartition(4))

    def timed(*columns: Column) -> tuple[float, tuple]:
        start = time.perf_counter()
        row = sample.agg(F.count(text_col), *columns).first()
        return time.perf_counter() - start, tuple(row)

    timed()
    idle, _ = timed()
    found = []
    for rule in rules:
        seconds, row = timed(F.avg(rejected(rule, F.col(text_col)).cast("double")))
        found.append((rule, max(seconds - idle, 1e-3), row[1] or 0.0))
    return sorted(found, key=lambda one: -one[2] / one[1])


def first_rejection(text: Column, ordered: Sequence[Rule], ready: Sequence[str] = ()) -> Column:
    """The name of the first rule of ``ordered`` that rejects ``text``; null if none does."""
    out = F.lit(None).cast("string")
    for rule in reversed(ordered):
        out = F.when(rejected(rule, text, ready), F.lit(rule.name)).otherwise(out)
    return out


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES, features: Sequence[str] = (), text_col: str = "text", out: str = "rejected_by") -> DataFrame:
    """``docs`` with ``out``: the rule that rejects the row's text, null if it is kept; ``features``
    adds those as columns of their names.

    A null text is an empty one. Columns of ``docs`` named like a new one are replaced by it. Rows are
    judged one by one: repeated rows get equal verdicts, an empty table gives none.
    """
    ordered = [rule for rule, _, _ in in_best_order(docs, rules, text_col=text_col)]
    for name in features:
        if name == text_col:
            raise ValueError(f"the text column is named like the feature {name}")
    text = F.col(text_col)
    with_features = docs.withColumns({name: FEATURES[name](text) for name in features}) if features else docs
    return with_features.withColumn(out, first_rejection(text, ordered, features))
