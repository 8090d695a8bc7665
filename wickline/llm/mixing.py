"""Mixing sources to target weights by entropy balancing."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wickline.llm.common import fresh, stage, words

#: Weights of the sources in turn, share of all words that the mix holds, most copies.
WEIGHTS, SHARE, COPIES = (5, 2, 1), 1.5, 2
#: Rows of equal source and size that are ranked in one group.
SLOT_ROWS = 50_000
#: Allocation rows up to which their table is broadcast (64 bytes each).
BROADCAST_ROWS = 500_000


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = COPIES) -> DataFrame:
    """``(key, source_size, target)`` from ``(key, source_size)``, one row a source in key order.

    Sources above ``most`` times their size are held there; the excess goes to the others by weight.
    In order of ``most * size / weight`` the held ones come first: a source is held if its fair part
    of what those before it leave is above its limit.
    """
    whole, by_key = Window.partitionBy(F.lit(0)), Window.orderBy("key")
    turn = (F.row_number().over(by_key) - 1) % len(weights)
    rows = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1))
    rows = rows.withColumn("limit", (most * F.col("source_size")).cast("double"))
    rows = rows.withColumn("level", F.col("limit") / F.col("weight"))
    before = Window.orderBy("level", "key").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum(F.col("source_size")).over(whole) * F.lit(float(share))
    left = total - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    rows = rows.withColumn("fair", left / open_weight)
    rows = rows.withColumn("held", F.col("fair") > F.col("level"))
    first_open = F.min(F.when(~F.col("held"), F.struct("level", "key", "fair"))).over(whole)
    target = F.when(F.col("held"), F.col("limit")).otherwise(F.least(first_open["fair"] * F.col("weight"), "limit"))
    return rows.select("key", "source_size", target.alias("target"))


def _rate(most: int) -> Column:
    """Copies of a document: one, tilted exponentially by its size, up to ``most``."""
    tilt = F.col("slope") * F.col("size") / F.col("scale")
    grown = F.when(tilt >= math.log(most), F.lit(float(most))).otherwise(F.exp(tilt))
    return F.when(F.col("size") == 0, F.lit(1.0)).when(F.col("full"), F.lit(float(most))).otherwise(grown)


def balance(histogram: DataFrame, wanted: DataFrame, most: int = COPIES, rounds: int = 80) -> DataFrame:
    """``(key, source_size, target, slope, scale, full)``: the tilt that meets each source's target.

    Among all rates the ones nearest to one copy each in relative entropy, given the words they must
    give, are ``exp(slope * size)``; ``slope`` is the multiplier of the source's word constraint and
    minimises a convex dual. Each Newton round sums words and curvature of all sources over the
    ``histogram`` ``(key, size, n)``; a step that leaves the bracket of the minimum is a bisection.
    ``scale`` is the mean size; ``full`` sources get the most copies throughout.
    """
    scale = histogram.groupBy("key").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("scale"))
    state = stage(
        wanted.join(scale, "key").select(
            "*",
            F.lit(0.0).alias("slope"),
            F.lit(-1e6).alias("low"),
            F.lit(1e6).alias("high"),
            (F.col("target") >= most * F.col("source_size") * (1 - 1e-12)).alias("full"),
        ),
        "mix-state",
    )
    for _ in range(rounds):
        rows = histogram.join(state, "key").withColumn("rate", _rate(most))
        given = F.col("n") * F.col("size") * F.col("rate")
        sums = rows.groupBy("key").agg(
            F.sum(given).alias("words"),
            F.sum(F.when(F.col("rate") < most, given * F.col("size") / F.col("scale")).otherwise(0.0)).alias("curve"),
        )
        gap = F.col("words") - F.col("target")
        done = F.col("full") | (F.abs(gap) <= 1e-9 * F.col("target") + 1e-9)
        low = F.when(gap < 0, F.col("slope")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("slope")).otherwise(F.col("high"))
        newton = F.when(F.col("curve") > 0, F.col("slope") - gap / F.col("curve"))
        inside = (newton > low) & (newton < high)
        slope = F.when(done, F.col("slope")).when(inside, newton).otherwise((low + high) / 2)
        state = stage(
            state.join(sums, "key").select(
                "key", "source_size", "target", "scale", slope.alias("slope"), low.alias("low"), high.alias("high"), "full",
                done.alias("done"),
            ),
            "mix-state",
        )
        if not state.filter(~F.col("done")).take(1):
            break
        state = state.drop("done")
    return state.select("key", "source_size", "target", "slope", "scale", "full")


def _round(rates: DataFrame, most: int) -> DataFrame:
    """``(key, size, n, source_size, target, base, extra)``: ``extra`` of ``n`` documents get one copy more than ``base``.

    Sizes are taken from large to small; each gets the rounded growth of the running sum of expected
    copies. What a source then lacks or has too much is mended from its smallest documents on.
    """
    down = Window.partitionBy("key").orderBy(F.col("size").desc()).rowsBetween(Window.unboundedPreceding, 0)
    up = Window.partitionBy("key").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    source = Window.partitionBy("key")
    rows = rates.withColumn("base", F.floor("rate")).withColumn("part", F.col("n") * (F.col("rate") - F.col("base")))
    rows = rows.withColumn("upto", F.floor(F.sum("part").over(down) + 0.5))
    step = Window.partitionBy("key").orderBy(F.col("size").desc())
    rows = rows.withColumn("extra", F.col("upto") - F.lag("upto", 1, 0).over(step))
    rows = rows.withColumn("extra", F.least(F.greatest("extra", F.lit(0)), "n"))
    taken = F.col("size") * (F.col("n") * F.col("base") + F.col("extra"))
    rows = rows.withColumn("gap", F.round(F.col("target") - F.sum(taken).over(source)).cast("bigint"))
    spare = F.when(F.col("base") < most, F.col("n") - F.col("extra")).otherwise(F.lit(0))
    room = F.when(F.col("gap") > 0, spare).otherwise(F.col("extra"))
    rows = rows.withColumn("room", room)
    rows = rows.withColumn("used", F.coalesce(F.sum(F.col("room") * F.col("size")).over(up), F.lit(0)))
    fits = F.floor((F.abs("gap") - F.col("used")) / F.greatest("size", F.lit(1)))
    moved = F.when(F.col("size") > 0, F.least(F.greatest(fits, F.lit(0)), "room")).otherwise(F.lit(0))
    extra = F.col("extra") + F.when(F.col("gap") > 0, moved).otherwise(-moved)
    return rows.select("key", "size", "n", "source_size", "target", "base", extra.alias("extra"))


def _cutoffs(sized: DataFrame, rounded: DataFrame) -> DataFrame:
    """``(key, size, cutoff)``: the ``extra`` smallest hashes of a group are those up to ``cutoff``.

    A group is ranked in slots of about ``SLOT_ROWS`` rows by hash range, so that no task ranks a whole
    large group.
    """
    some = rounded.filter("extra > 0 AND extra < n").select(
        "key", "size", "extra", F.ceil(F.col("n") / SLOT_ROWS).alias("slots")
    )
    top = F.shiftrightunsigned("hash", 33)
    rows = sized.join(some, ["key", "size"]).withColumn("slot", F.shiftright(top * F.col("slots"), 31))
    counts = rows.groupBy("key", "size", "slot").agg(F.count("*").alias("in_slot"), F.first("extra").alias("extra"))
    earlier = Window.partitionBy("key", "size").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("prior", F.coalesce(F.sum("in_slot").over(earlier), F.lit(0)))
    edge = counts.filter("prior < extra AND prior + in_slot >= extra").select(
        "key", "size", "slot", (F.col("extra") - F.col("prior")).alias("quota")
    )
    ranked = rows.join(edge, ["key", "size", "slot"]).withColumn(
        "rank", F.row_number().over(Window.partitionBy("key", "size", "slot").orderBy(F.col("top")))
    )
    return ranked.filter(F.col("rank") == F.col("quota")).select("key", "size", F.col("top").alias("cutoff"))


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = COPIES,
) -> tuple[DataFrame, str]:
    """``docs`` with one more column, and its name: a struct of

    size (words), source_size, target, copies, taken (``copies * size``). Sources are taken in code
    point order, a null source is a source of its own and last. Null and empty texts have size 0, keep
    one copy and take no words. Rows equal in id and text get equal copies. An empty table stays
    empty. The column is called ``mix``, with underscores before it if ``docs`` has such a column.
    """
    name = fresh(docs, "mix")
    key = F.coalesce(F.concat(F.lit("a"), F.col(source).cast("string")), F.lit("b"))
    size = F.size(words(F.col(text))).cast("bigint")
    mark = F.xxhash64(F.col(doc_id).cast("string"), F.col(text))
    # Unsigned order of the hash, as in its slots.
    top = mark.bitwiseXOR(F.lit(-(1 << 63)))
    sized = stage(docs.select(key.alias("key"), size.alias("size"), mark.alias("hash"), top.alias("top")), "mix-sizes")
    histogram = stage(sized.groupBy("key", "size").agg(F.count("*").alias("n")), "mix-histogram")
    sizes = histogram.groupBy("key").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    state = balance(histogram, targets(sizes, weights, share, most), most)
    rates = histogram.join(state, "key").withColumn("rate", _rate(most))
    rounded = stage(_round(rates, most), "mix-rounded")
    cut = rounded.join(_cutoffs(sized, rounded), ["key", "size"], "left").select(
        *[F.col(c).alias(f"{name}_{c}") for c in ("key", "size", "source_size", "target", "base", "extra", "n", "cutoff")]
    )
    cut = stage(cut, "mix-allocation")
    side = F.broadcast(cut) if cut.count() <= BROADCAST_ROWS else cut
    joined = docs.join(side, (key == F.col(f"{name}_key")) & (size == F.col(f"{name}_size")), "left")
    col = lambda c: F.col(f"{name}_{c}")
    more = (col("extra") == col("n")) | F.coalesce(top <= col("cutoff"), F.lit(False))
    copies = F.coalesce(col("base") + more.cast("bigint"), F.lit(1)).cast("bigint")
    out = F.struct(
        col("size").alias("size"),
        col("source_size").alias("source_size"),
        col("target").alias("target"),
        copies.alias("copies"),
        (copies * col("size")).alias("taken"),
    )
    return joined.select(*[docs[c] for c in docs.columns], out.alias(name)), name
