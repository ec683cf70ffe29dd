"""Mixing sources to target weights: Efraimidis-Spirakis keys, prefix sums to a budget.

Each source gets a target number of words. Whole epochs of the source come
first; what is left of its target is filled from one ordered pass: every
document draws the exponential key -ln(u) / weight, with u from a hash of its
id, so that heavier documents tend to come earlier, and documents are taken
in key order while their running total stays nearest the budget.

The order is never sorted as a whole. Keys fall into buckets of equal ratio
(``PER_OCTAVE`` to a doubling, so a bucket holds a small share of any source);
sizes are summed per (source, bucket), a running total over at most a few
thousand buckets a source finds the one in which the budget ends, and only that
bucket's documents are ordered one by one. A source with a third of all
documents is spread over as many tasks as any other rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybayes.llm._util import NO_ID, Stage, fresh, n_words

FINE = 4096  # parts that an edge bucket is cut into, while
EDGE = 100_000  # rows of a source are more than this
PER_OCTAVE = 64
CYCLE = (3.0, 1.0, 2.0)


def targets(sizes: DataFrame, weights: tuple[float, ...] = CYCLE, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, target) of (source, size) rows.

    Sources in code-point order, null last, take ``weights`` in turn and share
    ``share`` times all sizes by them. A target stops at ``most`` times its
    source's size; what is over is shared again by weight among the others
    until none is above. That end state needs no rounds: in order of
    ``most * size / weight`` the sources that stop are a prefix, those whose
    limit is at most the level that the rest would then have. One row per
    source is all that the two ordered windows see.
    """
    n = len(weights)
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.row_number().over(by_name) - 1) % n + 1)
    per = per.withColumn("w", w).withColumn("limit", F.col("source_size") * F.lit(float(most)))
    everything = Window.partitionBy()
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    on = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    per = per.withColumn("ratio", F.col("limit") / F.col("w"))
    left = F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    per = per.withColumn("level", left / F.sum("w").over(on))
    # the level at the first source that doesn't stop holds for all after it; it is the highest of theirs
    per = per.withColumn("open", F.col("level") < F.col("ratio"))
    level = F.max(F.when(F.col("open"), F.col("level"))).over(everything)
    target = F.when(F.col("open"), F.col("w") * level).otherwise(F.col("limit"))
    return per.select("source", "source_size", target.alias("target"))


def uniform(doc_id: Column, seed: int, tie: Column) -> Column:
    """A number in (0, 1) from the id (without one, the tie) and the seed, the same in every run and engine."""
    own = F.coalesce(doc_id.cast("string"), F.concat(F.lit("null:"), tie.cast("string")), F.lit("null"))
    h = F.md5(F.concat(F.lit(f"{seed}:"), own).cast("binary"))
    return (F.conv(F.substring(h, 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))


def quality(labels: DataFrame) -> DataFrame:
    """(doc_id, weight): 2 for a document labelled good, 0.5 for one labelled bad (any bad row decides)."""
    return (
        labels.filter("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg(F.when(F.min("quality") >= 1, 2.0).otherwise(0.5).alias("weight"))
    )


def mix(docs: DataFrame, quality_weights: DataFrame | None = None, seed: int = 13, **shape) -> DataFrame:
    """(doc_id, source, tie, size, source_size, target, copies, taken): a row for each row of ``docs``.

    ``docs`` has doc_id, text and source. ``quality_weights`` is (doc_id,
    weight); a document without one, or with a weight that is not above zero,
    weighs 1. ``copies`` is how often the mix takes the document, ``taken`` its
    words times that. Null and empty texts have size 0. A null source is a
    source. Equal keys (repeated ids) are ordered by id (null last), size and
    the hash ``tie`` of the text; rows equal in all of these are taken alike.
    An empty table gives an empty mix.
    """
    stage = Stage(docs.sparkSession, "mix")
    rows = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("tie"))
    if quality_weights is None:
        weight = F.lit(1.0)
    else:
        rows = rows.join(quality_weights, "doc_id", "left")
        weight = F.when(F.col("weight") > 0, F.col("weight")).otherwise(1.0)
    rows = rows.withColumn("key", -F.log(uniform(F.col("doc_id"), seed, F.col("tie"))) / weight)
    octaves = F.log2("key") * PER_OCTAVE
    rows = rows.withColumn("bucket", F.floor(octaves)).withColumn("inside", octaves - F.floor(octaves)).drop("weight")
    place = F.struct("key", F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "size", "tie")
    rows = stage.table(rows.withColumn("place", place))

    goal = targets(rows.select("source", "size"), **shape)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    goal = goal.withColumn("epochs", epochs)
    goal = stage.table(goal.withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size")))

    # the bucket in which each source's budget ends: a running total over its buckets
    sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    up_to = Window.partitionBy("source").orderBy("bucket")
    sums = _with(sums.withColumn("upto", F.sum("words").over(up_to)), goal)
    ends = (
        sums.filter("upto >= budget")
        .groupBy("source")
        .agg(F.min(F.struct("bucket", (F.col("upto") - F.col("words")).alias("before"))).alias("end"))
        .select("source", F.col("end.bucket").alias("last"), F.col("end.before").alias("before"))
    )
    goal = stage.table(_with(goal, ends))

    # in that bucket, the last document that brings the total nearer the budget than leaving it out
    edge = _with(rows, goal).filter("bucket = last").select("source", "size", "place", "inside", "before", "budget")
    edge, past = _refined(stage.table(edge), stage)
    by_place = Window.partitionBy("source").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = edge.withColumn("run", F.col("before") + F.sum("size").over(by_place))
    cut = edge.filter("run - size / 2.0 <= budget").select("source", "place")
    for p in past:  # all of those were taken
        cut = cut.unionByName(p)
    goal = stage.table(_with(goal, cut.groupBy("source").agg(F.max("place").alias("cut"))))

    full = _with(rows, goal)
    # no last bucket: the budget is above the sum of all sizes, by rounding alone
    picked = F.coalesce(F.col("bucket") < F.col("last"), F.lit(True)) | F.coalesce(
        (F.col("bucket") == F.col("last")) & (F.col("place") <= F.col("cut")), F.lit(False)
    )
    copies = (F.col("epochs") + F.when(picked & (F.col("budget") > 0), 1).otherwise(0)).cast("long")
    return full.withColumn("copies", copies).select(
        "doc_id", "source", "tie", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")
    )


def _refined(edge: DataFrame, stage: Stage) -> tuple[DataFrame, list[DataFrame]]:
    """The rows of the last buckets cut finer until few are left, and the greatest places below what is left.

    A bucket is cut into ``FINE`` parts by the next bits of its keys, up to three times, by the same
    running total; so what is ordered in one task stays about ``EDGE`` rows however
    large a source is (unless keys are equal, as those of repeated ids).
    """
    past = []
    for level in (1, 2, 3):
        most = edge.groupBy("source").agg(F.count("*").alias("c")).agg(F.max("c")).first()[0] or 0
        if most <= EDGE:
            break
        edge = edge.withColumn("part", F.floor(F.col("inside") * float(FINE) ** level))
        sums = edge.groupBy("source", "part", "before", "budget").agg(F.sum("size").alias("words"))
        upto = F.col("before") + F.sum("words").over(Window.partitionBy("source").orderBy("part"))
        sums = sums.withColumn("upto", upto).filter("upto >= budget").groupBy("source")
        ends = sums.agg(F.min(F.struct("part", (F.col("upto") - F.col("words")).alias("b"))).alias("end"))
        ends = stage.table(ends.select("source", F.col("end.part").alias("last_part"), F.col("end.b").alias("past")))
        edge = _with(edge, ends)
        past.append(stage.table(edge.filter("part < last_part").groupBy("source").agg(F.max("place").alias("place"))))
        here = edge.filter("part = last_part").withColumn("before", F.col("past"))
        edge = stage.table(here.select("source", "size", "place", "inside", "before", "budget"))
    return edge, past


def _with(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join on source, null equal to null. One row a source on the right; Spark broadcasts it if its size allows."""
    common = [c for c in right.columns if c in left.columns and c != "source"]
    r = right.drop(*common).withColumnRenamed("source", "source_r")
    return left.join(r, left["source"].eqNullSafe(r["source_r"]), "left").drop("source_r")


def apply(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The mix as documents: each row as many times as ``mixed`` takes it, columns as they were."""
    i, s, t, h, c = fresh(docs, "mix_id", "mix_source", "mix_tie", "mix_hash", "mix_copies")
    m = mixed.filter("copies > 0").select(
        F.col("doc_id").alias(i), F.col("source").alias(s), F.col("tie").alias(t), F.col("copies").alias(c)
    )
    m = m.distinct()
    rows = docs.withColumn(h, F.xxhash64("text"))
    out = rows.join(m, rows["doc_id"].eqNullSafe(m[i]) & rows["source"].eqNullSafe(m[s]) & (rows[h] == m[t]))
    out = out.withColumn(c, F.explode(F.sequence(F.lit(1).cast("long"), F.col(c))))
    return out.select(*[F.col(f"`{x}`") for x in docs.columns])
