"""Mixing sources to target weights, with DataFrame functions only.

Words are added up per source, target words are shared out by weight up to a
cap, and a source's repetition rate is target / size. A document is emitted
floor(rate) times, and once more where a hash of its id and the seed falls below the
rate's fraction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabml.llm.common import WORD, shared_table

#: a rates table up to this many bytes is broadcast
BROADCAST_BYTES = 4 << 20


def word_count(text: Column) -> Column:
    """The number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(doc_id: Column, text: Column, seed: int) -> Column:
    """A number in [0, 1) from the seed and the id (the text, where there is no
    id): the first 52 bits of an MD5."""
    name = F.coalesce(doc_id.cast("string"), F.concat(F.lit("text:"), F.md5(F.coalesce(text, F.lit("")))))
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), name)), 1, 13)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(1 << 52))


def _ranked(sources: DataFrame) -> DataFrame:
    """The sources with ``rank``, their place by code point from 0, null last.

    Range-partitioned, so that no task gets all sources; the driver only
    sees one count per partition."""
    ordered = shared_table(sources.orderBy(F.asc_nulls_last("source")).withColumn("_at", F.monotonically_increasing_id()), "sources")
    part = F.shiftright("_at", 33)
    before, offsets = 0, [F.lit(0), F.lit(0)]
    for r in ordered.groupBy(part.alias("p")).count().orderBy("p").collect():
        offsets += [F.lit(r["p"]), F.lit(before)]
        before += r["count"]
    rank = F.element_at(F.create_map(*[o.cast("long") for o in offsets[2:] or offsets]), part) + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return ordered.withColumn("rank", rank).drop("_at")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(source, source_size, target, rate) of (source, source_size).

    Sources by code point, null last, get ``weights`` in turn and share ``share``
    times all sizes; a target stops at ``cap`` times its source's size, and the
    excess is shared by weight again until none is above. A source without words gets 0.
    """
    ranked = _ranked(sizes)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights)).cast("int") + 1)
    ranked = shared_table(ranked.select("source", "source_size", weight.alias("w"), (F.col("source_size") * cap).alias("cap")), "weights")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, stopped = 0.0, -1
    while total:
        # shared over those that the last level leaves below their cap
        over = F.col("w") * F.lit(level) > F.col("cap")
        spent, left, n = ranked.agg(F.sum(F.when(over, F.col("cap")).otherwise(0.0)), F.sum(F.when(over, 0).otherwise(F.col("w"))),
                                    F.sum(over.cast("long"))).first()
        if n == stopped or not left:
            break
        level, stopped = (share * total - spent) / left, n
    target = F.least(F.col("w") * F.lit(float(level)), F.col("cap"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return ranked.withColumn("target", target).select("source", "source_size", "target", rate.alias("rate"))


def copies(rate: Column, draw: Column) -> Column:
    """floor(rate), and one more with the probability of its fraction."""
    return F.floor(rate) + (draw < rate - F.floor(rate)).cast("long")


def with_rates(rows: DataFrame, rates: DataFrame, source_col: str) -> DataFrame:
    """Rows with their source's rate as ``_rate`` and so on. The rates are
    broadcast if their size, measured here, is small; else the join may
    shuffle, with hot sources split by the adaptive skew join."""
    rates = rates.select([F.col(c).alias(f"_{c}") for c in rates.columns])
    held = rates.agg(F.sum(F.coalesce(F.octet_length("_source"), F.lit(0)) + 64)).first()[0] or 0
    side = F.broadcast(rates) if held <= BROADCAST_BYTES else rates
    return rows.join(side, F.col(f"`{source_col}`").eqNullSafe(F.col("_source"))).drop("_source")


def mix_sizes(df: DataFrame, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
              weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, taken.

    ``taken`` counts the words that the mix takes of a row, copies included;
    repeated rows take the same. Null text has no words, a null source is a source, a row without an
    id draws by its text. An empty table gives no rows. Other columns are ignored.
    """
    text, ident = F.col(f"`{text_col}`"), F.col(f"`{id_col}`")
    rows = shared_table(df.select(ident.alias("doc_id"), F.col(f"`{source_col}`").alias("source"), word_count(text).alias("size"),
                                  uniform(ident, text, seed).alias("draw")), "sizes")
    rates = shared_table(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap), "rates")
    return with_rates(rows, rates, "source").select(
        "doc_id", "size", F.col("_source_size").alias("source_size"), F.col("_target").alias("target"),
        (F.col("size") * copies(F.col("_rate"), F.col("draw"))).alias("taken"))


def mix(df: DataFrame, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """The mix itself: the input's rows with all their columns, each as often
    as it is taken. The rows aren't shuffled while the rates are broadcast. Any
    column names are fine: the input's row travels as one struct. Nulls, repeated rows
    and an empty table are as in ``mix_sizes``."""
    text, ident, source = F.col(f"`{text_col}`"), F.col(f"`{id_col}`"), F.col(f"`{source_col}`")
    sizes = df.groupBy(source.alias("source")).agg(F.sum(word_count(text)).alias("source_size"))
    rates = shared_table(targets(sizes, weights, share, cap), "rates")
    rows = df.select(F.struct("*").alias("row"), source.alias("source"), uniform(ident, text, seed).alias("draw"))
    n = copies(F.col("_rate"), F.col("draw")).cast("int")
    return with_rates(rows, rates, "source").select("row", F.explode(F.array_repeat(F.lit(0), n)).alias("copy")).select("row.*")
