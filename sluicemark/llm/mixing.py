"""Mix sources to target weights by entropy balancing.

Every document gets a rate, the number of times it should be used.  Among all rates from 0 to
``most`` that give each source its target number of words, the ones nearest to 1 in relative entropy are
``min(most, exp(lambda * size / mean size))`` with one multiplier per source.  Newton steps on the
dual, kept inside a bracket, find the multipliers; each step is one aggregation over the counts of
(source, size).  Rates become whole copies by adding a number from 0 to 1 drawn from the row's own
hash, and a shift per source, found through two histograms of the points where a copy is gained,
brings the words taken to within about one document of the target.  One document more or less of
the size that is missing closes most of the rest.

Only DataFrame operations are used.  Rows per source, the source of a third of all rows included,
are only summed before a shuffle.  The table of sources is ranked in one task, so their number, not
the number of documents, is what that task sees.

Null text has size 0.  A null source is a source, ordered last.  Documents of size 0 have rate 1 and take no words.
Repeated rows share their number and so their copies.  A very long text is a size like any other; its words are counted in one task.  Ties of points are
told apart by the rows' hashes.  An empty table gives no rows.  Other columns
are kept by ``mix``; one with the name of a column it adds is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluicemark.session import staged

MOST = 3
WEIGHTS = (1, 2, 3)
STEPS = 60
TOLERANCE = 1e-7
BINS = 2048
ADDED = ("size", "source_size", "target", "rate", "copies")
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _key(source: Column) -> Column:
    """A source as a join key that is never null."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def _draw(doc_id: Column, text: Column) -> Column:
    """From 0 to below 1, the same in every run."""
    return F.shiftrightunsigned(F.xxhash64(doc_id, text), 11) / F.lit(float(1 << 53))


def targets(sources: DataFrame, most: float = MOST, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Target of every row of ``sources`` (source, source_size), capped shares passed on by weight.

    With sources ordered by cap over weight, the capped ones come first; the others share what is left.
    """
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    weighed = sources.withColumns({"weight": weight, "cap": F.col("source_size") * float(most)})
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.asc_nulls_last("source"))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    heavy = F.sum("weight").over(Window.partitionBy()) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    ranked = weighed.withColumns({"left": left, "heavy": heavy})
    fits = F.col("cap") * F.col("heavy") > F.col("left") * F.col("weight")
    level = F.max(F.when(fits, F.struct(-F.col("cap") / F.col("weight"), F.col("left") / F.col("heavy")))).over(Window.partitionBy())
    share = F.col("weight") * level["col2"]
    return ranked.withColumn("target", F.least("cap", F.coalesce(share, F.col("cap")))).drop("weight", "left", "heavy")


def _rate(multiplier: Column, size: Column, mean: Column, most: float) -> Column:
    return F.least(F.lit(float(most)), F.exp(F.least(multiplier * size / mean, F.lit(50.0))))


def multipliers(counts: DataFrame, wanted: DataFrame, most: float = MOST) -> DataFrame:
    """``wanted`` (key, source_size, n, cap, target) with the multiplier of each source.

    ``counts`` has the number n of documents for each (key, size).  A source at its cap has none;
    all its rates are ``most``.
    """
    mean = F.greatest(F.col("source_size") / F.col("n_docs"), F.lit(1e-9))
    smallest = F.greatest(F.col("least") / F.col("mean"), F.lit(1e-12))
    open_ = F.col("target") < F.col("cap")
    state = staged(
        wanted.withColumn("mean", mean).filter(open_ & (F.col("target") > 0))
        .withColumns({"low": -(F.log(F.col("source_size") / F.col("target")) + 1) / smallest, "high": F.log(F.lit(float(most))) / smallest, "at": F.lit(0.0)})
        .withColumn("low", F.least("low", F.lit(-1.0)))
    )
    for _ in range(STEPS):
        size = F.col("size")
        rate = _rate(F.col("at"), size, F.col("mean"), most)
        words = F.sum(F.col("n") * size * rate).alias("words")
        slope = F.sum(F.when(rate < most, F.col("n") * size * rate * size / F.col("mean")).otherwise(0.0)).alias("slope")
        seen = counts.join(state.select("key", "at", "mean"), "key").groupBy("key").agg(words, slope)
        gap = F.col("words") - F.col("target")
        newton = F.col("at") - gap / F.col("slope")
        inside = (F.col("slope") > 0) & (newton > F.col("low")) & (newton < F.col("high"))
        done = F.abs(gap) <= F.col("target") * TOLERANCE
        state = staged(
            state.join(seen, "key")
            .withColumns({"low": F.when(gap > 0, F.col("low")).otherwise(F.col("at")), "high": F.when(gap > 0, F.col("at")).otherwise(F.col("high"))})
            .withColumns({"at": F.when(done, F.col("at")).when(inside, newton).otherwise((F.col("low") + F.col("high")) / 2), "far": ~done})
            .drop("words", "slope")
        )
        moving = state.agg(F.coalesce(F.max("far"), F.lit(False)).alias("far")).first()["far"]
        state = state.drop("far")
        if not moving:
            break
    return wanted.withColumn("mean", mean).join(state.select("key", "at"), "key", "left")


def _rated(docs: DataFrame, solved: DataFrame, most: float) -> DataFrame:
    full = F.when(F.col("target") > 0, F.lit(float(most))).otherwise(0.0)
    rate = F.when(F.col("at").isNull(), full).otherwise(_rate(F.col("at"), F.col("size"), F.col("mean"), most))
    return docs.join(solved.drop("cap", "least", "n_docs", "source"), "key").withColumn("rate", rate)


def _crossing(points: DataFrame, width: float) -> DataFrame:
    """For each key the one of ``BINS`` bins from ``low`` on in which the words taken reach the target.

    ``words`` are taken before ``low``.
    """
    step = width / BINS
    at = F.floor((F.col("point") - F.col("low")) / step).cast("int")
    bins = points.withColumn("bin", at).filter(F.col("bin").between(0, BINS - 1))
    summed = bins.groupBy("key", "target", "low", "words", "bin").agg(F.sum("size").alias("size"))
    after = F.col("words") + F.sum("size").over(Window.partitionBy("key").orderBy("bin"))
    crossed = summed.withColumn("after", after).filter(F.col("after") >= F.col("target")).groupBy("key", "target").agg(
        F.min(F.struct((F.col("low") + F.col("bin") * step).alias("low"), (F.col("after") - F.col("size")).alias("words"), "after")).alias("c")
    )
    return staged(crossed.select("key", "target", "c.*"))


def _shifts(rated: DataFrame, most: int) -> DataFrame:
    """(key, shift): the shift whose words come nearest to each source's target.

    Copy c of a document is taken from the shift c - rate - draw on.
    """
    gained = F.explode(F.sequence(F.lit(1), F.lit(most)))
    points = (
        rated.filter(F.col("at").isNotNull() & (F.col("size") > 0))
        .select("key", "target", "size", "rate", "draw", gained.alias("copy"))
        .select("key", "target", "size", (F.col("copy") - F.col("rate") - F.col("draw")).alias("point"))
    )
    coarse = _crossing(points.withColumns({"low": F.lit(-float(most)), "words": F.lit(0).cast("long")}), 2.0 * most)
    fine = _crossing(points.join(coarse.select("key", "low", "words"), "key"), 2.0 * most / BINS)
    nearer = F.col("after") - F.col("target") < F.col("target") - F.col("words")
    return fine.select("key", F.when(nearer, F.col("low") + 2.0 * most / BINS**2).otherwise(F.col("low")).alias("shift"))


def _copies(most: int) -> Column:
    """Whole copies of a rated row."""
    moved = F.floor(F.col("rate") + F.col("draw") + F.coalesce("shift", F.lit(0.0)))
    whole = F.greatest(F.lit(0), F.least(F.lit(most), moved))
    return F.when(F.col("at").isNull(), F.floor("rate")).otherwise(whole).cast("long")


def _last_steps(rated: DataFrame, most: int) -> DataFrame:
    """(key, step, step_size, step_draw): the document whose copy, one more or less, closes most of a source's gap."""
    counted = rated.filter(F.col("at").isNotNull()).withColumn("copies", _copies(most))
    gaps = staged(counted.groupBy("key").agg((F.first("target") - F.sum(F.col("size") * F.col("copies"))).alias("gap")))
    step = F.signum("gap").cast("long")
    rest = F.abs(F.abs("gap") - F.col("size"))
    able = counted.join(gaps, "key").filter((F.col("copies") + step).between(0, most) & (F.col("size") > 0) & (rest < F.abs("gap")))
    best = able.groupBy("key").agg(F.min(F.struct(rest.alias("rest"), "size", "draw", step.alias("step"))).alias("b"))
    return best.select("key", "b.step", F.col("b.size").alias("step_size"), F.col("b.draw").alias("step_draw"))


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    most: int = MOST,
    weights: tuple[int, ...] = WEIGHTS,
) -> DataFrame:
    """``docs`` with size, source_size, target, rate and copies of every row.

    A document is to be used ``copies`` times, 0 to ``most``.
    """
    measured = docs.select(
        F.col(source).alias("source"), word_count(F.col(text)).alias("size"), _draw(F.col(doc_id), F.col(text)).alias("draw")
    )
    sized = staged(measured.withColumn("key", _key(F.col("source"))))
    counts = staged(sized.groupBy("key", "source", "size").agg(F.count(F.lit(1)).alias("n")))
    totals = counts.groupBy("key", "source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"),
        F.sum("n").alias("n_docs"),
        F.coalesce(F.min(F.when(F.col("size") > 0, F.col("size"))), F.lit(1)).alias("least"),
    )
    solved = staged(multipliers(counts, staged(targets(totals, most, weights)), most))
    shifts = _shifts(_rated(sized.drop("source"), solved, most), most)
    solved = staged(solved.join(shifts, "key", "left"))
    steps = _last_steps(_rated(sized.drop("source"), solved, most), most)
    final = staged(solved.join(steps, "key", "left"))
    kept = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in ADDED]).alias("row"),
        _key(F.col(source)).alias("key"),
        word_count(F.col(text)).alias("size"),
        _draw(F.col(doc_id), F.col(text)).alias("draw"),
    )
    chosen = (F.col("size") == F.col("step_size")) & (F.col("draw") == F.col("step_draw"))
    copies = _copies(most) + F.when(chosen, F.col("step")).otherwise(0)
    return _rated(kept, final, most).select("row.*", "size", "source_size", "target", "rate", copies.alias("copies"))
