"""Exact order statistics by rank search, and what is built on them.

``rank_search`` finds the value of a given rank in each group without sorting the
rows. A histogram of at most ``CELLS`` cells between the least and the greatest
value tells in which cell the rank lies; that cell's own least and greatest value are
the next range, and so on until they are one value. Each round is a partial
aggregate over the rows that are still in range, a thousandth of those before
it, so the first round does nearly all the work and no round moves rows. Ranges
travel as a table: groups may be many (a class each) and targets too. Tables
between rounds are staged files, so that Spark plans by their real sizes.

* ``fit_quantile_bins``: cuts at exact quantiles of numeric columns.
* ``fit_mdl_bins``: cuts that tell classes apart, as long as the minimum
  description length principle says they pay (Fayyad and Irani).
* ``split_stratified``: of each class the rows with the smallest hashes, exact to one row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybayes.functions.exprs import DEFAULT_TRAIN_RATIO, split_key
from tallybayes.operators.prepare import LABEL
from tallybayes.operators.train import release, stage_table

CELLS = 1024
GROUP, X, TARGET, RANK = "_group", "_x", "_target", "_rank"


def rank_search(data: DataFrame, targets: DataFrame, cells: int = CELLS, staged: bool = False) -> DataFrame:
    """(_group, _target, _x): the value of rank ``_rank`` (from 1, ascending) in each group.

    ``data`` has (_group, _x double), ``targets`` (_group, _target, _rank).
    Null and NaN values don't count; ranks beyond a group's rows have no row.
    Groups are compared as equal values, nulls included. ``staged``: the data are
    durable already and hold neither.
    """
    own = None if staged else stage_table(data.filter(F.col(X).isNotNull() & ~F.isnan(X)).select(GROUP, (F.col(X) + 0.0).alias(X)))
    data = data if own is None else own
    ends = data.groupBy(GROUP).agg(F.min(X).alias("lo"), F.max(X).alias("hi"), F.count(F.lit(1)).alias("n"))
    mine = targets.select(F.col(GROUP).alias("_g"), TARGET, RANK)
    now = mine.join(ends, F.col("_g").eqNullSafe(F.col(GROUP))).drop("_g").filter(F.col(RANK).between(1, F.col("n"))).drop("n")
    now = stage_table(now.select(GROUP, TARGET, RANK, "lo", "hi"))
    before = Window.partitionBy("_g", TARGET).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    first = True
    while not (open_ := now.filter("lo < hi")).isEmpty():
        cell, first = _cell(cells, first), False
        ranges = open_.select(F.col(GROUP).alias("_g"), "lo", "hi").distinct()
        inside = F.col(GROUP).eqNullSafe(F.col("_g")) & F.col(X).between(F.col("lo"), F.col("hi"))
        per = data.join(ranges, inside).groupBy("_g", "lo", "hi", cell.alias("cell"))
        per = per.agg(F.count(F.lit(1)).alias("c"), F.min(X).alias("a"), F.max(X).alias("b"))
        # at most ``cells`` rows for each target
        same = F.col("_g").eqNullSafe(F.col("g")) & (F.col("lo") == F.col("l")) & (F.col("hi") == F.col("h"))
        mine = open_.select(F.col(GROUP).alias("g"), TARGET, RANK, F.col("lo").alias("l"), F.col("hi").alias("h"))
        per = mine.join(per, same).withColumn("past", F.coalesce(F.sum("c").over(before), F.lit(0)))
        per = per.filter((F.col("past") < F.col(RANK)) & (F.col(RANK) <= F.col("past") + F.col("c")))
        step = per.select(F.col("g").alias(GROUP), TARGET, (F.col(RANK) - F.col("past")).alias(RANK), F.col("a").alias("lo"), F.col("b").alias("hi"))
        done = now
        now = stage_table(now.filter("lo = hi").unionByName(step))
        release(done)
    if own is not None:
        release(own)
    return now.select(GROUP, TARGET, F.col("lo").alias(X))


def _cell(cells: int, first: bool) -> Column:
    """The cell of ``_x`` in [lo, hi]: it never falls as ``_x`` rises, and those of lo and hi differ.

    Cells of equal width; from the second round on, ranges over many orders of
    magnitude are cut by sign and exponent instead, so that a handful of rounds
    is enough for any doubles.
    """
    x, lo, hi = F.col(X), F.col("lo"), F.col("hi")
    # halves where the width overflows; either branch may be evaluated, so neither may divide by zero
    share = F.when(hi - lo == float("inf"), F.try_divide(x / 2 - lo / 2, hi / 2 - lo / 2)).otherwise(F.try_divide(x - lo, hi - lo))
    even = F.least(F.floor(share * cells), F.lit(cells - 1))
    if first:
        return even
    order = (F.signum(x) * (F.floor(F.log2(F.abs(x))) + 1076)).cast("bigint")  # doubles begin at 2^-1074
    far = (lo <= 0) & (hi >= 0) | (F.abs(hi) > F.abs(lo) * 4096) | (F.abs(lo) > F.abs(hi) * 4096)
    return F.when(far, F.coalesce(order, F.lit(0))).otherwise(even)


# -- bins -----------------------------------------------------------------------
@dataclass(frozen=True)
class CutBins:
    """Bins between ascending cuts: bin i holds the values above i cuts; NaN is a category of its own."""

    cuts: dict[str, tuple[float, ...]]

    def column(self, name: str) -> Column:
        """Bin index as a string category (null input stays null)."""
        x = F.col(name).cast("double")
        above = F.when(x.isNotNull(), F.lit(0))
        for c in self.cuts[name]:
            above = above + (x > F.lit(c)).cast("int")
        return F.when(F.isnan(x), F.lit("NaN")).otherwise(above.cast("string"))

    def apply(self, df: DataFrame, cols=None) -> DataFrame:
        return df.withColumns({c: self.column(c) for c in (cols or self.cuts)})


def _long(train: DataFrame, cols, *keep) -> DataFrame:
    """(_group: column number, _x, keep): one Generate over one scan."""
    pairs = [F.struct(F.lit(i).alias(GROUP), F.col(c).cast("double").alias(X)) for i, c in enumerate(cols)]
    return train.select(*keep, F.explode(F.array(*pairs)).alias("p")).select("p.*", *keep)


def fit_quantile_bins(train: DataFrame, cols, bins: int = 4) -> CutBins:
    """Cuts at the exact quantiles 1/bins, 2/bins, ...: the value of rank ceil(n * i / bins) each.

    Equal cuts are one, and none is at the greatest value, above which no bin would have
    rows. Only the cuts (``bins - 1`` a column) reach the driver.
    """
    cols = list(cols)
    data = _long(train, cols).filter(F.col(X).isNotNull() & ~F.isnan(X)).withColumn(X, F.col(X) + 0.0)
    data = stage_table(data)
    sizes = data.groupBy(GROUP).agg(F.count(F.lit(1)).alias("n"), F.max(X).alias("top"))
    targets = sizes.select(GROUP, F.explode(F.sequence(F.lit(1), F.lit(bins - 1))).alias(TARGET), "n") if bins > 1 else sizes.limit(0).withColumn(TARGET, F.lit(1))
    targets = targets.select(GROUP, TARGET, F.ceil(F.col("n") * F.col(TARGET) / F.lit(bins)).alias(RANK))
    found = rank_search(data, targets, staged=True).join(sizes.select(GROUP, "top"), GROUP).filter(F.col(X) < F.col("top"))
    cuts: dict[int, set[float]] = {}
    for r in found.select(GROUP, X).collect():  # bins - 1 a column
        cuts.setdefault(r[GROUP], set()).add(r[X])
    release(data)
    return CutBins({c: tuple(sorted(cuts.get(i, ()))) for i, c in enumerate(cols)})


def _xlogx(n: Column) -> Column:
    return F.when(n > 0, n * F.log2(n.cast("double"))).otherwise(F.lit(0.0))


def _best_cuts(counts: DataFrame) -> DataFrame:
    """(_group, segment, cell): the accepted cut after a cell of each segment, of class counts (_group, segment, cell, label, n).

    Sums over the classes change from cell to cell by the classes that the cell
    has, so each cut costs its own rows, not all classes.
    """
    per = Window.partitionBy(GROUP, "segment", LABEL)
    counts = counts.withColumn("left", F.sum("n").over(per.orderBy("cell"))).withColumn("all", F.sum("n").over(per))
    left, every, n = F.col("left"), F.col("all"), F.col("n")
    first, last = (left == n).cast("int"), (left == every).cast("int")
    cells = counts.groupBy(GROUP, "segment", "cell").agg(
        F.sum("n").alias("n"),
        F.sum(_xlogx(left) - _xlogx(left - n)).alias("dl"),
        F.sum(_xlogx(every - left) - _xlogx(every - left + n)).alias("dr"),
        F.sum(first).alias("kl"),
        F.sum(last).alias("kr"),
    )
    # a row for each cell from here on
    seg = Window.partitionBy(GROUP, "segment")
    run = seg.orderBy("cell")
    cells = cells.select(
        GROUP, "segment", "cell",
        F.sum("n").over(seg).alias("N"), F.sum("n").over(run).alias("NL"),
        F.sum("dl").over(run).alias("SL"), F.sum("dl").over(seg).alias("S"), F.sum("dr").over(run).alias("dr"),
        F.sum("kl").over(seg).alias("K"), F.sum("kl").over(run).alias("KL"), F.sum("kr").over(run).alias("gone"),
        F.max("cell").over(seg).alias("end"),
    ).filter("cell < end")
    total, nl = F.col("N").cast("double"), F.col("NL").cast("double")
    nr = total - nl
    ent = F.log2(total) - F.col("S") / total
    ent_l = F.log2(nl) - F.col("SL") / nl
    ent_r = F.log2(nr) - (F.col("S") + F.col("dr")) / nr
    gain = ent - nl / total * ent_l - nr / total * ent_r
    k, kl, kr = F.col("K"), F.col("KL"), F.col("K") - F.col("gone")
    # log2(3^k - 2); 3^k leaves the doubles for many classes, where the 2 is nothing
    ways = F.when(k <= 30, F.log2(F.pow(F.lit(3.0), k) - 2)).otherwise(k * F.log2(F.lit(3.0)))
    cost = (F.log2(total - 1) + ways - (k * ent - kl * ent_l - kr * ent_r)) / total
    scored = cells.select(GROUP, "segment", "cell", F.round(gain, 12).alias("gain"), (gain > cost).alias("pays"))
    best = scored.groupBy(GROUP, "segment").agg(F.min(F.struct((-F.col("gain")).alias("g"), "cell", "pays")).alias("b"))
    return best.filter("b.pays").select(GROUP, "segment", F.col("b.cell").alias("cut"))


def fit_mdl_bins(train: DataFrame, cols, label: str, candidates: int = 64, depth: int = 3) -> CutBins:
    """Cuts that lower the class entropy by more than they cost to state; none where none does.

    The candidates are the exact quantiles of each column (``candidates`` bins),
    fitted first; class counts of those bins, one partial aggregate over the rows,
    are all that the search reads. Each of ``depth`` rounds cuts every segment at
    the candidate of greatest gain (the first of equals, to 12 places) if the
    principle accepts it. Rows without a label or a number don't count.
    """
    cols = list(cols)
    fine = fit_quantile_bins(train.filter(F.col(label).isNotNull()), cols, candidates)
    binned = fine.apply(train.filter(F.col(label).isNotNull()).select(*cols, F.col(label).cast("string").alias("_label")))
    pairs = F.array(*[F.struct(F.lit(i).alias(GROUP), F.col(c).alias("cell")) for i, c in enumerate(cols)])
    counts = binned.select(F.col("_label").alias(LABEL), F.explode(pairs).alias("p")).select("p.*", LABEL)
    counts = counts.filter((F.col("cell") != "NaN") & F.col("cell").isNotNull())
    counts = counts.groupBy(GROUP, F.col("cell").cast("int").alias("cell"), LABEL).agg(F.count(F.lit(1)).alias("n"))
    counts = stage_table(counts.withColumn("segment", F.lit(0)))
    chosen: dict[int, set[int]] = {}
    whole = counts
    for _ in range(depth):
        cuts = _best_cuts(whole).collect()  # fewer than candidates a column
        if not cuts:
            break
        for r in cuts:
            chosen.setdefault(r[GROUP], set()).add(r["cut"])
        # only segments that were cut are looked at again
        segment = F.lit(None).cast("int")
        for r in cuts:
            here = (F.col(GROUP) == r[GROUP]) & (F.col("segment") == r["segment"])
            segment = F.when(here, F.col("segment") * 2 + 1 + (F.col("cell") > r["cut"]).cast("int")).otherwise(segment)
        whole = whole.withColumn("segment", segment).filter(F.col("segment").isNotNull())
    release(counts)
    return CutBins({c: tuple(fine.cuts[c][i] for i in sorted(chosen.get(g, ()))) for g, c in enumerate(cols)})


# -- exact stratified split --------------------------------------------------------
def hash_place(*cols: str) -> Column:
    """52 bits of the id's md5 as a double, exactly; the same arithmetic is expressible in DuckDB."""
    return F.conv(F.substring(F.md5(split_key(*cols)), 1, 13), 16, 10).cast("bigint").cast("double")


def split_stratified(df: DataFrame, label: str, ids, train_ratio: float = DEFAULT_TRAIN_RATIO) -> tuple[DataFrame, DataFrame]:
    """(train, test): of each class the ``round(ratio * rows)`` rows with the smallest hashes of the id.

    The shares are exact to one row in every class, null being a class of its
    own, where a hash split is only so on average. Rows of equal ids stay together, on the training
    side. Two scans and the rank search find a threshold a class; rows are not
    sorted and only meet the thresholds, a row a class.
    """
    place = hash_place(*ids)
    keyed = df.select(F.col(label).cast("string").alias(GROUP), place.alias(X))
    sizes = keyed.groupBy(GROUP).agg(F.count(F.lit(1)).alias("n"))
    k = F.round(F.col("n") * F.lit(float(train_ratio))).cast("bigint")
    bounds = rank_search(keyed, sizes.select(GROUP, F.lit(1).alias(TARGET), k.alias(RANK)))
    # names that no column of the rows has
    mine, bound = (_unused(df, c) for c in ("_mine", "_bound"))
    bounds = bounds.select(F.col(GROUP).alias(mine + "_class"), F.col(X).alias(bound))
    # a class without a training row has no bound
    sided = df.withColumn(mine, F.col(label).cast("string"))
    sided = sided.join(bounds, F.col(mine).eqNullSafe(F.col(mine + "_class")), "left")
    side = F.coalesce(place <= F.col(bound), F.lit(False))
    columns = [F.col(f"`{c}`") for c in df.columns]
    return sided.filter(side).select(*columns), sided.filter(~side).select(*columns)


def _unused(df: DataFrame, name: str) -> str:
    while any(c.lower().startswith(name) for c in df.columns):
        name += "_"
    return name
