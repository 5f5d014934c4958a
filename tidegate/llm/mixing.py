"""Operator 5: temperature mixing of sources, all in DataFrame operations.

A source's share p of all tokens becomes the weight w = p^a / sum(p^a). The exponent a is bisected
in [0, 1]: the flattest mixture in which no source is read more than `repeat_limit` times as often
as the source read least, and, when `target_entropy` (in nats) is given, whose entropy is not
above it. The token budget is the smallest that reads every source at least once, so no document
is lost.

The mixture is realised by block permutations. A source is cut by keyed hash into blocks of about
`block_tokens` tokens; a source that should be read r times is passed over floor(r) times, and
once more up to the budget of frac(r) tokens in each block, in an order by keyed hash that differs
from pass to pass. A document is taken in the last pass when at least half of it fits.

Defined results: a null source is a source of its own; documents without tokens, also null texts,
have no weight and are passed over as often as floor(r); equal rows are kept; no rows give no rows; extra columns
travel along in the document. Blocks and orders are drawn from doc_id and text together, so that rows of one
doc_id, or without one, spread over the blocks; rows equal in both are told apart by their other columns.
Rows equal in all columns share a block.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidegate.llm.common import stage

REPEAT_LIMIT, BLOCK_TOKENS, SEED = 1.5, 1 << 18, 29
ROUNDS = 40
WORD = r"[^\x20\x09-\x0D]+"


def token_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def bisect_exponent(shares: DataFrame, repeat_limit: float, target_entropy: float | None) -> float:
    """The exponent for one row per source with its token share `p`.

    Each round asks one aggregate over the sources; only its scalars reach the driver.
    """

    def fits(exponent: float) -> bool:
        weight = F.pow("p", F.lit(exponent))
        row = shares.agg(F.sum(weight).alias("z"), F.sum(weight * F.ln("p") * exponent).alias("e"),
                         F.max(weight / F.col("p")).alias("most"), F.min(weight / F.col("p")).alias("least")).first()
        if row["z"] is None:
            return True
        entropy = math.log(row["z"]) - row["e"] / row["z"]
        return row["most"] <= repeat_limit * row["least"] * (1 + 1e-12) and (
            target_entropy is None or entropy <= target_entropy)

    low, high = 0.0, 1.0
    if fits(low):
        return low
    for _ in range(ROUNDS):
        middle = (low + high) / 2
        low, high = (low, middle) if fits(middle) else (middle, high)
        if high - low < 1e-6:
            break
    return high


def source_weights(totals: DataFrame, repeat_limit: float = REPEAT_LIMIT, target_entropy: float | None = None) -> DataFrame:
    """Per source (source, tokens, rows): its share, weight, exponent, and how often it is read."""
    whole = totals.agg(F.sum("tokens").alias("_all")).first()["_all"] or 0
    shares = totals.withColumn("p", F.when(F.col("tokens") > 0, F.col("tokens") / F.lit(float(max(whole, 1)))))
    exponent = bisect_exponent(shares.filter("tokens > 0"), repeat_limit, target_entropy)
    raw = F.when(F.col("tokens") > 0, F.pow("p", F.lit(exponent)))
    weighed = shares.withColumn("_raw", raw)
    row = weighed.agg(F.sum("_raw").alias("z"), F.min(F.col("_raw") / F.col("p")).alias("least")).first()
    total, least = row["z"] or 1.0, row["least"] or 1.0
    return weighed.select("source", "tokens", "rows", F.coalesce("p", F.lit(0.0)).alias("share"),
                          F.coalesce(F.col("_raw") / F.lit(total), F.lit(0.0)).alias("weight"), F.lit(exponent).alias("exponent"),
                          F.coalesce(F.round(F.col("_raw") / F.col("p") / F.lit(least), 9), F.lit(1.0)).alias("repeats"))


def _drawn(*parts: Column) -> Column:
    return F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]))


def _others(docs: DataFrame) -> Column:
    """A hash of the columns that neither name, weigh nor place a document."""
    rest = [c for c in docs.columns if c.lower() not in ("doc_id", "text", "source")]
    return F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in rest])).cast("binary")) if rest else F.lit("")


def mix(docs: DataFrame, repeat_limit: float = REPEAT_LIMIT, target_entropy: float | None = None,
        block_tokens: int = BLOCK_TOKENS, seed: int = SEED) -> DataFrame:
    """One row per reading of a document of `docs` (doc_id, text, source, ...).

    Columns: document, a struct of the columns of `docs`; source, tokens, weight, exponent, repeats;
    block, pass (from 1) and place, the row's place in its block's permutation of that pass.
    """
    counted = docs.select(F.struct(*docs.columns).alias("document"), F.col("source").alias("source"),
                          token_count("text").alias("tokens"), F.col("doc_id").alias("id"),
                          F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("null")).alias("content"), _others(docs).alias("others"))
    totals = stage(counted.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("rows")), "source-tokens")
    weights = stage(source_weights(totals, repeat_limit, target_entropy), "source-weights").select(
        F.col("source").alias("of"), "weight", "exponent", "repeats",
        F.ceil((F.col("tokens") + F.col("rows")) / block_tokens).alias("blocks"))
    # A few numbers per source. Spark sends them to all tasks only while they are small.
    known = counted.join(weights, counted["source"].eqNullSafe(weights["of"])).drop("of")
    number = F.conv(F.substring(_drawn(F.lit(f"block{seed}"), F.col("id"), F.col("content")), 1, 8), 16, 10).cast("bigint")
    blocked = known.withColumn("block", number % F.col("blocks")).drop("blocks")
    whole_passes = F.floor("repeats").cast("int")
    order = lambda pass_: (_drawn(F.lit(f"order{seed}"), pass_, F.col("id"), F.col("content")), "id", "content", "others")
    block = Window.partitionBy("source", "block")
    before = F.sum("tokens").over(block.orderBy(*order(whole_passes + 1)).rowsBetween(Window.unboundedPreceding, -1))
    room = (F.col("repeats") - whole_passes) * F.sum("tokens").over(block)
    fits = (F.col("tokens") > 0) & (F.coalesce(before, F.lit(0)) + F.col("tokens") / 2 <= room)
    passes = blocked.withColumn("passes", whole_passes + fits.cast("int"))
    read = passes.withColumn("pass", F.explode(F.sequence(F.lit(1), "passes"))).drop("passes")
    place = F.row_number().over(Window.partitionBy("source", "block", "pass").orderBy(*order(F.col("pass"))))
    return read.withColumn("place", place.cast("bigint")).drop("id", "content", "others")
