"""Mixing sources to target weights by temperature.

Everything here is made of DataFrame functions; no row passes through Python.

A source's share of all tokens (words) is raised to an exponent and normalised. The exponent
is bisected, over a grid of 2^-24, until the weights meet a repetition limit or a target
entropy. The budget is the smallest with which every source is used at least once, so that no
document is lost; a source's weight then says how often its documents come.

Whole epochs repeat all documents of a source. The rest of its budget is realised as a block
permutation: documents fall into 256 blocks by a hash, blocks are put into a pseudo-random
order, documents inside a block into another, and documents are taken in that order while
they fit the budget. As the order is that of one string key, the taken ones are those up to a
cut-off key. It is found level by level (sums over key prefixes, then inside the prefix at
the boundary), so that no source's documents are ever sorted in one task.

Defined results: a null source is a source of its own; texts without words (null, empty) cost
nothing and come once an epoch; rows of equal id share their fate; an empty table gives an
empty result; further columns are kept as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

GRID = 1 << 24
_ARY = 64


@dataclass(frozen=True)
class MixConfig:
    max_repetition: float | None = 1.5
    target_entropy: float | None = None  # as a share of the greatest possible one
    seed: str = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def order_key(source: Column, ident: Column, config: MixConfig, epoch: Column | None = None) -> Column:
    """8 digits that order the blocks of a source, then the digits of the row's own hash."""
    tag = F.lit(config.seed) if epoch is None else F.concat_ws("|", F.lit(config.seed), epoch.cast("string"))
    own = F.md5(F.concat_ws("|", tag, ident.cast("string")).cast("binary"))
    block = F.md5(F.concat_ws("|", tag, source, F.substring(own, 1, 2)).cast("binary"))
    return F.concat(F.substring(block, 1, 8), own)


def exponent(shares: DataFrame, config: MixConfig = MixConfig()) -> float:
    """The least exponent on the grid that keeps to the repetition limit, or whose entropy is at most the target.

    ``shares`` has a row with ``share`` > 0 a source. Each round tries 64 exponents in one
    job and gets 64 rows back, however many sources there are.
    """
    low, step = 0, GRID
    ok_at = GRID
    for _ in range(4):
        step //= _ARY
        grid = F.explode(F.sequence(F.lit(low), F.lit(low + step * (_ARY - 1)), F.lit(step)))
        tried = shares.select("share", grid.alias("k")).withColumn("raised", F.pow("share", F.col("k") / GRID))
        sums = tried.groupBy("k").agg(F.sum("raised").alias("z"), F.sum(F.col("raised") * F.log("raised")).alias("zl"), F.max(F.col("raised") / F.col("share")).alias("most"), F.min(F.col("raised") / F.col("share")).alias("least"), F.count("*").alias("n"))
        met = []
        if config.max_repetition is not None:
            met.append(F.col("most") / F.col("least") <= config.max_repetition)
        if config.target_entropy is not None:
            met.append(F.when(F.col("n") < 2, True).otherwise((F.log("z") - F.col("zl") / F.col("z")) / F.log(F.col("n").cast("double")) <= config.target_entropy))
        rule = met[0] if len(met) == 1 else met[0] & met[1]
        good = [r["k"] for r in sums.filter(rule).orderBy("k").limit(1).collect()]  # one row
        ok_at = good[0] if good else low + step * _ARY
        if ok_at == 0:
            return 0.0
        low = ok_at - step
        low += max(step // _ARY, 1) if step > 1 else 0
    return min(ok_at, GRID) / GRID


def _cut_offs(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """source and ``cut``: rows with a key up to it are taken once more; '' takes none.

    rows: source, key, n_tokens. targets: source, rest (tokens). Each level sums tokens over
    longer prefixes inside the boundary prefix, of which each source has one.
    """
    state = targets.select("source", F.lit("").alias("at"), "rest")
    cuts = targets.select("source", F.lit("").alias("cut"))
    for size in (8, 12, 14, 16, 40):
        inside = rows.join(state, "source").filter(F.col("key").startswith(F.col("at")))
        sums = inside.groupBy("source", F.substring("key", 1, size).alias("prefix")).agg(F.sum("n_tokens").alias("n"), F.first("rest").alias("rest"))
        run = sums.withColumn("total", F.sum("n").over(Window.partitionBy("source").orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0)))
        fits = F.col("total") <= F.col("rest")
        level = run.groupBy("source").agg(
            F.max(F.when(fits, F.col("prefix"))).alias("last"),
            F.coalesce(F.max(F.when(fits, F.col("total"))), F.lit(0)).alias("used"),
            F.min(F.when(~fits, F.col("prefix"))).alias("at"),
            F.first("rest").alias("all"),
        )
        level = stored(level, f"mix-level-{size}")
        # a cut is a prefix; "~" follows every digit, so the whole prefix is taken
        cuts = cuts.join(level.select("source", F.concat("last", F.lit("~")).alias("new")), "source", "left").select("source", F.coalesce("new", "cut").alias("cut"))
        state = level.filter("at is not null").select("source", "at", (F.col("all") - F.col("used")).alias("rest"))
    return cuts


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", config: MixConfig = MixConfig()) -> DataFrame:
    """Per source: tokens, weight, epochs (whole ones) and cut (key up to which one more comes)."""
    source = F.coalesce(F.col(source_col).cast("string"), F.lit("\x00null"))
    rows = docs.select(source.alias("source"), order_key(source, F.coalesce(F.col(id_col).cast("string"), F.lit("")), config).alias("key"), word_count(F.col(text_col).cast("string")).alias("n_tokens"))
    rows = stored(rows, "mix-rows")
    sums = stored(rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens")), "mix-sources")
    total = sums.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("t")).collect()[0]["t"]
    shares = sums.filter("tokens > 0").withColumn("share", F.col("tokens") / F.lit(float(max(total, 1))))
    power = exponent(shares, config)
    raised = shares.withColumn("raised", F.pow("share", F.lit(power)))
    z = raised.agg(F.sum("raised").alias("z"), F.min(F.col("raised") / F.col("share")).alias("least")).collect()[0]
    # budget = max(tokens / weight), so a source comes raised / share / least times
    times = F.round(F.col("raised") / F.col("share") / F.lit(z["least"] or 1.0), 9)
    weights = raised.select("source", "tokens", F.round(F.col("raised") / F.lit(z["z"] or 1.0), 9).alias("weight"), F.floor(times).alias("epochs"), F.floor((times - F.floor(times)) * F.col("tokens")).alias("rest"))
    weights = stored(weights, "mix-weights")
    cuts = _cut_offs(rows, weights.filter("rest > 0"))
    every = sums.select("source").join(weights, "source", "left").join(cuts, "source", "left")
    return stored(every.select("source", F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("weight", F.lit(0.0)).alias("weight"), F.coalesce("epochs", F.lit(1)).cast("int").alias("epochs"), F.coalesce("cut", F.lit("")).alias("cut")), "mix-plan")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", config: MixConfig = MixConfig()) -> DataFrame:
    """``row`` (a struct of all columns of ``docs``) once for each time that it comes.

    Also: epoch (from 0), n_tokens, weight of the source, and order_key, by which a source's
    rows of an epoch are put into their order.
    """
    names = docs.columns
    made = plan(docs, id_col, text_col, source_col, config)
    ident = F.coalesce(F.col(f"row.`{id_col}`").cast("string"), F.lit(""))
    source = F.coalesce(F.col(f"row.`{source_col}`").cast("string"), F.lit("\x00null"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")).withColumn("source", source).withColumn("key", order_key(F.col("source"), ident, config))
    rows = rows.join(made, "source")  # one row a source; Spark broadcasts it while it is small
    times = F.col("epochs") + F.when(F.col("key") <= F.col("cut"), 1).otherwise(0)
    rows = rows.select("row", "source", "weight", F.explode(F.sequence(F.lit(0), times - 1)).alias("epoch"))
    return rows.select("row", "epoch", word_count(F.col(f"row.`{text_col}`").cast("string")).alias("n_tokens"), "weight", order_key(F.col("source"), ident, config, F.col("epoch")).alias("order_key"))
