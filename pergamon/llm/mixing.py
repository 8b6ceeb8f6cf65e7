"""Mixing sources to target weights by entropy balancing.

Of all document rates that meet the token targets, the ones nearest to one copy each, in relative
entropy bounded by the highest rate allowed, tilt exponentially: the odds of a document's rate
change by exp(lambda * feature). Lambda is the solution of a convex dual, one number for each source,
which Newton's method finds from two sums a source and round.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from pergamon.llm.graph import stored
from pergamon.llm.text import SPACE_RUN, SPACES

#: Copies of a document at most, and the weights of the sources in turn.
MAX_COPIES = 3
WEIGHTS = (1, 2, 3)

#: Rates are whole millionths, so that sums of them don't depend on their order.
UNIT = 1_000_000

#: Newton's rounds at most, and the relative error of a source's tokens at which they end.
ROUNDS = 60
TOLERANCE = 1e-7

#: Documents of one size and source that are ranked together, about, rows of one id that one task makes
#: again, and offsets tried a source.
CELL_ROWS = 50_000
RUN_ROWS = 50_000
OFFSETS = 64


def sizes(docs, text="text"):
    """The number of words of each row, 0 for a null text."""
    trimmed = F.btrim(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit(SPACES))
    split = F.size(F.split(trimmed, SPACE_RUN)).cast("long")
    return F.when(F.length(trimmed) > 0, split).otherwise(F.lit(0).cast("long"))


def source_targets(by_source, weights=WEIGHTS, most=MAX_COPIES):
    """Adds `place` (from 0, by code point, null last), `weight` and `target` to (source, tokens).

    A target is the source's share by weight of all tokens, but `most` times its own at most; what is cut
    off goes to the others by weight, until none is above. Each round is one sum over sources.
    """
    part = F.spark_partition_id()
    ranged = stored(by_source.repartitionByRange(F.col("source").asc_nulls_last())
                    .sortWithinPartitions(F.col("source").asc_nulls_last())
                    .select("source", "tokens", part.alias("part")), "sources")
    before = ranged.groupBy("part").count()
    before = before.select("part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1
    placed = ranged.withColumn("inside", inside).join(before, "part").withColumn(
        "place", (F.col("inside") + F.col("before")).cast("long"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.col("place") % len(weights) + 1).cast("int"))
    placed = stored(placed.select("source", "tokens", "place", weight.alias("weight")), "sources")
    level, capped = 0.0, -1
    limit = F.col("tokens") * float(most)
    while True:
        above = F.col("weight") * level > limit
        row = placed.agg(
            F.sum("tokens").alias("all"), F.sum(F.when(above, 1).otherwise(0)).alias("n"),
            F.sum(F.when(above, limit).otherwise(0.0)).alias("fixed"),
            F.sum(F.when(above, 0.0).otherwise(F.col("weight"))).alias("free")).first()
        if row["n"] == capped or not row["free"]:
            break
        capped = row["n"]
        level = (row["all"] - row["fixed"]) / row["free"]
    return placed.withColumn("target", F.least(F.col("weight") * level, limit).cast("double"))


def _rate(slope, feature, most=MAX_COPIES):
    """The bounded exponential tilt of one copy: odds of `most` to one at slope zero, times exp(-x)."""
    x = F.greatest(F.least(slope * feature, F.lit(60.0)), F.lit(-60.0))
    return F.lit(float(most)) / (F.lit(1.0) + (most - 1) * F.exp(-x))


def balanced(cells, sources, most=MAX_COPIES):
    """(source, slope): the dual's solution, by Newton steps kept inside a bracket.

    `cells` has source, size, n (documents) and feature. The gradient is a source's tokens at the rates
    now, the second derivative the sum of n * size * feature * rate * (1 - rate / most); both are monotone in
    the slope, so a step that leaves the bracket is replaced by its middle.
    """
    goal = F.col("target") / F.col("tokens")
    state = sources.filter("tokens > 0").select(
        "source", "tokens", "target", F.lit(0.0).alias("slope"), F.lit(-60.0).alias("low"), F.lit(60.0).alias("high"),
        F.lit(False).alias("done"))
    cells = cells.filter("size > 0")
    for _ in range(ROUNDS):
        rate = _rate(F.col("slope"), F.col("feature"), most)
        mass = F.col("n") * F.col("size") * rate
        sums = cells.join(state.select(F.col("source").alias("_s"), "slope"), F.col("source").eqNullSafe(F.col("_s"))).groupBy(
            "source").agg(F.sum(mass).alias("g"), F.sum(mass * F.col("feature") * (1 - rate / most)).alias("h"))
        sums = sums.withColumnRenamed("source", "_s")
        error = F.col("g") - F.col("target")
        low = F.when(error < 0, F.col("slope")).otherwise(F.col("low"))
        high = F.when(error > 0, F.col("slope")).otherwise(F.col("high"))
        step = F.col("slope") - F.when(F.col("h") > 0, error / F.col("h"))
        middle = (F.col("low") + F.col("high")) / 2
        near = (F.abs(error) <= F.col("tokens") * TOLERANCE) | (goal >= most)
        state = state.join(sums, F.col("source").eqNullSafe(F.col("_s"))).select(
            "source", "tokens", "target", "slope", low.alias("low"), high.alias("high"), step.alias("step"),
            near.alias("done"))
        state = stored(state.select(
            "source", "tokens", "target",
            F.when(F.col("done"), F.col("slope"))
            .when((F.col("step") > F.col("low")) & (F.col("step") < F.col("high")), F.col("step"))
            .otherwise(middle).alias("slope"), "low", "high", "done"), "dual")
        if state.filter("not done").isEmpty():
            break
    slope = F.when(goal >= most, F.lit(None).cast("double")).otherwise(F.col("slope"))
    return state.select("source", slope.alias("slope"))


def _rows_of_runs(runs):
    """One row for each of the `c` equal rows of a run, numbered by `inside` from 0.

    Runs over RUN_ROWS are cut first, and the pieces dealt to tasks, so no task makes a whole long run.
    """
    columns = [F.col(c) for c in runs.columns]
    short = runs.filter(F.col("c") <= RUN_ROWS).select(
        *columns, F.explode(F.sequence(F.lit(0).cast("long"), F.col("c") - 1)).alias("inside"))
    pieces = runs.filter(F.col("c") > RUN_ROWS).select(
        *columns, F.explode(F.sequence(F.lit(0).cast("long"), F.col("c") - 1, F.lit(RUN_ROWS).cast("long"))).alias("first"))
    last = F.least(F.col("first") + RUN_ROWS, F.col("c")) - 1
    # dealt by a hash of the piece: round robin would first sort all pieces
    long = pieces.repartition(F.xxhash64("source", "size", "doc_id", "first")).select(
        *columns, F.explode(F.sequence(F.col("first"), last)).alias("inside"))
    return short.unionByName(long)


def mixed(docs, doc_id="doc_id", source="source", text="text", most=MAX_COPIES):
    """doc_id, size, source, source_size, target, rate and copies of every row; taken = copies * size.

    Texts are read once, for their sizes; all else works on counts by source and size. A rate depends on
    source and size only, so Newton's sums run over such cells, and rounding too: along a source's
    cells, from long documents to short, copies are dealt systematically, so that the error of each
    prefix is below one copy; of some offsets the one that ends nearest to the target is used. Which
    documents of a cell get the copy more is settled by hash of the id. Large cells are split by
    hash first, and rows of one id, source and size, which are interchangeable, are counted, ranked as one
    run and made again at the end, so rows without an id are no hot key. All rates are whole numbers and
    nothing depends on how rows lie, so reruns agree.

    A null source is a source; null and empty texts have size 0 and one copy. Sources without words
    have the target 0. Repeated rows are dealt with as one document each; no rows give no rows.
    """
    sized = stored(docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"),
        sizes(docs, text).alias("size")), "sizes")
    cells = stored(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "cells")
    by_source = cells.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).cast("long").alias("tokens"), F.sum("n").alias("n_docs"))
    sources = stored(source_targets(by_source.select("source", "tokens"), most=most), "sources")

    mean = by_source.select(F.col("source").alias("_s"), (F.col("tokens") / F.col("n_docs")).alias("mean"))
    same = F.col("source").eqNullSafe(F.col("_s"))
    # long texts tilt more than short ones, with the root of their length
    featured = stored(cells.join(mean, same).drop("_s").withColumn(
        "feature", F.when(F.col("mean") > 0, F.sqrt(F.col("size") / F.col("mean"))).otherwise(0.0)), "cells")
    slopes = balanced(featured, sources, most).withColumnRenamed("source", "_s")
    aim = sources.select(F.col("source").alias("_s"), "tokens", "target")
    rate = F.when(F.col("size") == 0, 1.0).when(F.col("slope").isNull(), float(most)).otherwise(
        _rate(F.col("slope"), F.col("feature"), most))
    rated = featured.join(aim, same).drop("_s").join(slopes, same, "left").drop("_s").select(
        "source", "size", "n", "tokens", "target", F.round(rate * UNIT).cast("long").alias("rate"),
        F.ceil(F.col("n") / CELL_ROWS).cast("int").alias("parts"))
    rated = stored(rated, "rates")

    # sub-cells and how many whole rates lie before each, from long documents to short
    runs = sized.groupBy("source", "size", "doc_id").agg(F.count("*").alias("c"))
    sub = runs.join(rated.select(F.col("source").alias("_s"), F.col("size").alias("_z"), "rate", "parts"),
                    same & (F.col("size") == F.col("_z"))).drop("_s", "_z")
    sub = stored(sub.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int")).drop("parts"), "runs")
    counts = sub.groupBy("source", "size", "part", "rate").agg(F.sum("c").alias("m"))
    fraction = F.col("rate") % UNIT
    along = Window.partitionBy("source").orderBy(F.col("size").desc(), "part")
    counts = counts.withColumn("end", F.sum(F.col("m") * fraction).over(along)).withColumn(
        "begin", F.col("end") - F.col("m") * fraction)
    counts = stored(counts, "parts")

    def more(begin, end, shift):
        return F.floor((end + shift) / UNIT) - F.floor((begin + shift) / UNIT)

    shifts = [i * UNIT // OFFSETS for i in range(OFFSETS)]
    whole = F.floor(F.col("rate") / UNIT) * F.col("m")
    taken = [F.sum(F.col("size") * (whole + more(F.col("begin"), F.col("end"), F.lit(s)))).alias(f"t{i}")
             for i, s in enumerate(shifts)]
    tried = counts.groupBy("source").agg(*taken).join(aim, same)
    tried = tried.select("source", F.array_min(F.array(*[
        F.struct(F.abs(F.col(f"t{i}") - F.col("target")).alias("off"), F.lit(s).alias("shift"))
        for i, s in enumerate(shifts)]))["shift"].alias("shift"))
    chosen = counts.join(tried.withColumnRenamed("source", "_s"), same).drop("_s").join(aim, same).select(
        F.col("source").alias("_s"), F.col("size").alias("_z"), F.col("part").alias("_p"), "begin", "shift", "tokens", "target")

    before = F.sum("c").over(
        Window.partitionBy("source", "size", "part").orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id")) - F.col("c")
    ranked = sub.withColumn("before", before).join(
        chosen, same & (F.col("size") == F.col("_z")) & (F.col("part") == F.col("_p"))).drop("_s", "_z", "_p")
    dealt = _rows_of_runs(stored(ranked, "ranks"))
    at = F.col("begin") + (F.col("before") + F.col("inside")) * fraction
    copies = F.floor(F.col("rate") / UNIT) + more(at, at + fraction, F.col("shift"))
    return dealt.select(
        "doc_id", "source", "size", F.col("tokens").alias("source_size"), "target",
        (F.col("rate") / UNIT).alias("rate"), copies.cast("long").alias("copies"),
        (copies * F.col("size")).cast("long").alias("taken"))
