"""Mixing sources to target weights: iterative proportional fitting, then calibrated sampling.

Token weights are summed into cells of (source, language, topic). Each round scales, one dimension
after another, the rate of every value's cells so that their weights meet its target share, until all
do. State is the table of cells; a step is one aggregation of it, combined ahead of the shuffle,
whatever share of the tokens one value holds, or no shuffle where one task can hold the cells. The
fitted rate of a cell, scaled to the wanted number of tokens and cut at one, is the probability with
which its documents stay. Texts are read once: what is known of each row is written beside it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlake.llm.quality import n_symbols, n_upper, n_words, word_chars
from postlake.session import cut_lineage

#: Rounds end when every value's share is this near its target, and at the latest after ROUNDS.
TOLERANCE = 1e-6
ROUNDS = 100
STEP = 4
CAP_ROUNDS = 6
#: Cells up to which one task scales them all.
ONE_TASK = 200_000
DIMENSIONS = ("source", "lang", "topic")
_BITS = 48


def token_weight(text: Column) -> Column:
    """Words of a text, one at least, so that every document has weight."""
    return F.greatest(n_words(text), F.lit(1))


def text_topic(text: Column, weight: Column) -> Column:
    """The kind of text, where a table names no topic: by symbols, capitals and length."""
    return (
        F.when(n_symbols(text) * 4 > weight, "symbols")
        .when(n_upper(text) * 10 > word_chars(text) * 4, "capitals")
        .when(weight < 100, "note").when(weight < 1000, "article").otherwise("long")
    )


def tempered(cells: DataFrame, power: float) -> dict[str, DataFrame]:
    """Targets (value, share) of each dimension: its natural shares to a power, which lifts the rare."""
    out = {}
    for dim in DIMENSIONS:
        sums = cells.groupBy(F.col(dim).alias("value")).agg(F.sum("weight").alias("share"))
        out[dim] = sums.select("value", F.pow("share", F.lit(power)).alias("share"))
    return out


def fit(
    cells: DataFrame, targets: Mapping[str, DataFrame], rounds: int = ROUNDS, tolerance: float = TOLERANCE,
    one_task: int = ONE_TASK,
) -> DataFrame:
    """``cells`` (source, lang, topic, weight) with ``rate``: fitted weight over weight, before scaling.

    ``targets`` names (value, share) per dimension; shares need no sum. A value without a target gets
    none of the weight. Dimensions left out stay as they are. After every ``STEP`` rounds they end if in
    the last no value's share of the weight was further than ``tolerance`` from its target, and at the
    latest after ``rounds``: targets that no table meets never come near. ``deviation`` says how far a fit is off.

    Up to ``one_task`` cells a step is one plan without an exchange; more are summed by aggregates.
    """
    for dim, target in targets.items():
        shares = target.groupBy("value").agg(F.sum("share").alias("share"))
        present = cut_lineage(cells.select(F.col(dim).alias("value")).distinct().join(shares, "value"))
        total = present.agg(F.sum("share")).first()[0] or 1.0
        cells = cells.join(present.select(F.col("value").alias(dim), (F.col("share") / total).alias(f"_{dim}")), dim)
    state = cut_lineage(cells.withColumn("rate", F.lit(1.0)))
    few = state.count() <= one_task
    weight = F.col("weight") * F.col("rate")
    for at in range(1, rounds + 1):
        for dim in targets:
            if few:
                state = state.coalesce(1).withColumn("_sum", F.sum(weight).over(Window.partitionBy(dim)))
            else:
                state = state.join(state.groupBy(dim).agg(F.sum(weight).alias("_sum")), dim)
            state = state.withColumns({
                "rate": F.when(F.col("_sum") > 0, F.col("rate") * F.col(f"_{dim}") / F.col("_sum")).otherwise(0.0),
                f"_off_{dim}": F.abs(F.col("_sum") - F.col(f"_{dim}")),
            }).drop("_sum")
            if not few:
                state = cut_lineage(state)
        if at % STEP == 0 or at == rounds:
            if few:
                state = cut_lineage(state)
            off = state.agg(*(F.max(f"_off_{dim}") for dim in targets)).first() if targets else ()
            if all(value is None or value <= tolerance for value in off):
                break
    return state.select(*DIMENSIONS, "weight", "rate")


def deviation(rates: DataFrame, targets: Mapping[str, DataFrame]) -> float:
    """The greatest distance, over the values of all dimensions, of the fitted share from its target."""
    out = 0.0
    for dim, target in targets.items():
        sums = rates.groupBy(F.col(dim).alias("value")).agg(F.sum(F.col("weight") * F.col("rate")).alias("_sum"))
        both = cut_lineage(sums.join(target.groupBy("value").agg(F.sum("share").alias("share")), "value"))
        total, wanted = both.agg(F.sum("_sum"), F.sum("share")).first()
        if total and wanted:
            out = max(out, both.agg(F.max(F.abs(F.col("_sum") / total - F.col("share") / wanted))).first()[0])
    return out


def probabilities(rates: DataFrame, keep: float, rounds: int = CAP_ROUNDS) -> DataFrame:
    """``rates`` with ``probability``: the rate times the scale at which the tokens expected to stay
    are ``keep`` of all, no cell above one. Cells cut at one leave their rest to the others, round by
    round; only the two sums that give the next scale reach the driver."""
    total = rates.agg(F.sum("weight")).first()[0] or 0
    scale = 0.0
    for at in range(rounds + 1):
        full = F.lit(False) if at == 0 else F.col("rate") * scale >= 1.0
        row = rates.agg(
            F.sum(F.when(full, F.col("weight")).otherwise(0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight") * F.col("rate")))
        ).first()
        if not row[1]:
            break
        before, scale = scale, max(scale, (keep * total - row[0]) / row[1])
        if scale == before:
            break
    return rates.withColumn("probability", F.least(F.lit(1.0), F.col("rate") * F.lit(scale)))


def draw(identity: Column, seed: str) -> Column:
    """A number in [0, 1) that follows from the row alone, so that a task run again draws the same."""
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), identity)), 1, _BITS // 4)
    return F.conv(digits, 16, 10).cast("double") / float(1 << _BITS)


def mix(
    docs: DataFrame, keep: float = 0.5, power: float = 0.5, targets: Mapping[str, DataFrame] | None = None,
    rounds: int = ROUNDS, tolerance: float = TOLERANCE, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text",
    source_col: str = "source", lang_col: str = "lang", topic: Column | None = None, prefix: str = "",
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """``docs``, or its columns ``carry``, with ``topic``, ``n_tokens``, ``probability`` and ``kept``,
    each behind ``prefix``.

    Without ``targets`` each dimension's natural shares to ``power`` are aimed at. A null source,
    language or topic is the value ''. A null or empty text counts as one token. The draw hangs on
    ``seed`` and the id alone: rows that share an id share their fate, a null id draws like the text
    'null'. Columns of ``docs`` named like a new one are replaced. An empty table gives no rows.
    """
    columns = list(docs.columns if carry is None else carry)
    row = F.struct(*map(F.col, columns)) if columns else F.lit(True)
    tagged = docs.select(
        row.alias("_row"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("_source"),
        F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("_lang"), F.col(id_col).cast("string").alias("_id"),
        F.col(text_col).alias("_text"), token_weight(F.col(text_col)).alias("_weight"),
        *([topic.alias("_given")] if topic is not None else []),
    )
    kind = F.col("_given") if topic is not None else text_topic(F.col("_text"), F.col("_weight"))
    tagged = cut_lineage(tagged.withColumn("_topic", F.coalesce(kind, F.lit(""))).drop("_text", "_given"))
    cells = cut_lineage(tagged.groupBy(
        F.col("_source").alias("source"), F.col("_lang").alias("lang"), F.col("_topic").alias("topic")
    ).agg(F.sum("_weight").cast("double").alias("weight")))
    rates = probabilities(fit(cells, targets or tempered(cells, power), rounds, tolerance), keep)
    rates = cut_lineage(rates.select(
        F.col("source").alias("_s"), F.col("lang").alias("_l"), F.col("topic").alias("_t"), F.col("probability").alias("_p")
    ))
    same = (F.col("_source") == F.col("_s")) & (F.col("_lang") == F.col("_l")) & (F.col("_topic") == F.col("_t"))
    probability = F.coalesce("_p", F.lit(0.0))
    new = {
        prefix + "topic": F.col("_topic"), prefix + "n_tokens": F.col("_weight"), prefix + "probability": probability,
        prefix + "kept": draw(F.coalesce("_id", F.lit("null")), seed) < probability,
    }
    own = [F.col("_row")[c].alias(c) for c in columns if c not in new]
    return tagged.join(rates, same, "left").select(*own, *(column.alias(name) for name, column in new.items()))
