"""Class-sparse scoring: the best class of each row without scoring every class.

The dense scorers give each row a score for each class, so their work and their
arrays grow with the number of classes K. Here nothing is as long as K. A
feature value has a *posting list*, the classes it was seen with; a class without
it gets the fallback of the feature, which is lower. For each distinct feature
vector:

1. The value with the fewest classes is its *pivot*. Only the classes of the
   pivot's list, and the one class that is best where no value was seen, are
   scored: the best of them is a lower bound.
2. Any other class pays the pivot feature's fallback and, for each other feature, no
   more than its own most frequent value would give. These bounds depend on the
   class, the pivot feature and the number of features alone, so classes are
   ranked by them once; a vector goes down the ranking until the bound falls
   below what it has (an equi-join on cells of bounds, never all classes).
3. The classes met there are scored too, and the best of both is the prediction.

A class's counts are one row, its *profile*, so a (vector, class) pair is scored by
one projection where the profile meets the vector, and a task hands on one score a
vector: pairs are neither exchanged nor kept. Lookups in a profile are scans, so where
a class has more than ``MAX_PROFILE`` values, pairs are joined with the counts instead.

Terms are the same expressions added in the same order as in the dense scorers, and
rounding is monotone, so bounds hold exactly and predictions and scores are
equal to theirs, ties (the lowest label) included. All joins are equi-joins on
(model, feature, value, class) or vector numbers; a hot value or class is a hot
key that AQE splits, and equal test rows are one vector from the scan on.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybayes.functions.exprs import UNKNOWN_LOG_PROB, log_fallback, log_likelihood
from tallybayes.operators.prepare import FEAT_IDX, FEATURES, LABEL, VALUE
from tallybayes.operators.train import N, NBModel, stage_table

VECTOR = "_vector"
SIZE = "_size"
PIVOT = "_pivot"
CLASS = "_class"
SCORE = "_score"
BOUND = "_bound"
CELL = "_cell"
CELLS = 4  # cells of bounds in a unit of log probability
MAX_PROFILE = 256  # most values of a class whose counts are held in one row
UNROLL = 32  # most features whose terms are written out as one expression
VALUES = "_values"  # values of each feature of a model
COUNTS = "_counts"


def extra(size: Column, m: int) -> Column:
    """What the features beyond the model's count add; one expression for every scorer."""
    return F.when(size > m, (size - m).cast("double") * F.lit(UNKNOWN_LOG_PROB)).otherwise(F.lit(0.0))


def tied(score: Column, digits: int | None) -> Column:
    """The score as it is compared."""
    return score if digits is None else F.round(score, digits)


def _total(prior: Column, terms: Column, size: Column, m: int) -> Column:
    """prior + terms (structs, by feature) from left to right, then the features beyond the model's."""
    return F.aggregate(F.array_sort(terms), prior, lambda s, t: s + t["t"]) + extra(size, m)


def _folded(prior: Column, term, size: Column, m: int) -> Column:
    """``_total`` of ``term(i)``, without a list of terms."""
    if m <= UNROLL:
        score = prior
        for i in range(m):
            score = score + F.when(size > i, term(F.lit(i))).otherwise(F.lit(0.0))
    else:
        at = F.when(size > 0, F.sequence(F.lit(0), F.least(size, F.lit(m)) - 1)).otherwise(F.array().cast("array<int>"))
        score = F.aggregate(at, prior, lambda s, i: s + term(i))
    return score + extra(size, m)


class SparseModel:
    """The frames of a model that sparse scoring joins; each row is one (feature, value), class or both."""

    def __init__(self, model: NBModel):
        self.keys, self.m = model.keys, model.stats().max_features
        self.counts, self.prior = model.counts, model.prior
        # classes of each value, and values of each feature
        self.lists = self.counts.groupBy(*self.keys, FEAT_IDX, VALUE).agg(F.count(F.lit(1)).alias("classes"))
        self.vocabulary = self.lists.groupBy(*self.keys, FEAT_IDX).agg(F.count(F.lit(1)).alias("n_values"))

    @cached_property
    def profiles(self) -> DataFrame:
        """(keys, class, n_c, log_prior, counts, width): a row per class; counts: map<feat_idx, map<value, n>>."""
        near = self.counts.filter(F.col(VALUE).isNotNull()).repartition(*self.keys, LABEL)
        per = near.groupBy(*self.keys, LABEL, FEAT_IDX).agg(F.map_from_entries(F.collect_list(F.struct(VALUE, N))).alias("v"))
        per = per.groupBy(*self.keys, LABEL).agg(
            F.map_from_entries(F.collect_list(F.struct(FEAT_IDX, "v"))).alias(COUNTS), F.max(F.size("v")).alias("width")
        )
        return stage_table(self.prior.join(per, [*self.keys, LABEL], "left").withColumnRenamed(LABEL, CLASS), "profiles")

    @cached_property
    def narrow(self) -> bool:
        """Are the counts of every class few enough to be held, and scanned, as one row?"""
        per = self.counts.groupBy(*self.keys, LABEL).agg(F.count(F.lit(1)).alias("n_counts"))
        return (per.agg(F.max("n_counts").alias("most")).first()["most"] or 0) <= MAX_PROFILE

    def with_values(self, vectors: DataFrame) -> DataFrame:
        """The vectors with the number of values of each feature of their model."""
        per = F.map_from_entries(F.collect_list(F.struct(FEAT_IDX, "n_values"))).alias(VALUES)
        per = self.vocabulary.filter(F.col(FEAT_IDX).isNotNull()).groupBy(*self.keys).agg(per)
        return vectors.join(per, self.keys, "left")

    def listed(self, vectors: DataFrame) -> DataFrame:
        """(vector, class) of the classes that the vectors' pivot values were seen with."""
        at = [*self.keys, PIVOT, "_value"]
        if not self.narrow:
            lists = self.counts.select(*self.keys, F.col(FEAT_IDX).alias(PIVOT), F.col(VALUE).alias("_value"), F.col(LABEL).alias(CLASS))
            return vectors.join(lists, at).select(VECTOR, CLASS)
        own = [*self.keys, CLASS, "n_c", "log_prior", COUNTS]
        lists = self.profiles.select(*own, F.explode(COUNTS).alias(PIVOT, "_map"))
        lists = lists.select(*own, PIVOT, F.explode(F.map_keys("_map")).alias("_value"))
        return lists.join(vectors.select(*at, VECTOR, SIZE, FEATURES, VALUES), at)

    def with_profiles(self, pairs: DataFrame, vectors: DataFrame) -> DataFrame:
        """(vector, class) pairs as ``listed`` gives them."""
        if not self.narrow:
            return pairs
        pairs = pairs.join(vectors.select(VECTOR, *self.keys, SIZE, FEATURES, VALUES), VECTOR)
        return pairs.join(self.profiles, [*self.keys, CLASS])

    def bounds(self, groups: DataFrame) -> DataFrame:
        """(keys, pivot, size, class, bound, base) of each class in each group of vectors (keys, pivot, size).

        ``bound``: no vector of the group whose pivot value the class lacks scores
        higher; ``base``: the score where no value was seen with the class.
        """
        top = self.counts.groupBy(*self.keys, LABEL, FEAT_IDX).agg(F.max(N).alias("top"))
        per = top.join(self.vocabulary, [*self.keys, FEAT_IDX]).join(self.prior, [*self.keys, LABEL])
        n_c, v = F.col("n_c"), F.col("n_values")
        terms = F.struct(FEAT_IDX, log_likelihood(F.col("top"), n_c, v).alias("hit"), log_fallback(n_c, v).alias("miss"))
        classes = per.groupBy(*self.keys, LABEL, "log_prior").agg(F.collect_list(terms).alias("terms"))
        both = groups.join(classes, self.keys)
        every = F.sequence(F.lit(0), F.least(F.col(SIZE), F.lit(self.m)) - 1)
        every = F.when(F.least(F.col(SIZE), F.lit(self.m)) > 0, every).otherwise(F.array().cast("array<int>"))

        def summed(pick) -> Column:
            def term(i: Column) -> Column:
                own = F.get(F.filter("terms", lambda t: t[FEAT_IDX] == i), F.lit(0))
                return F.struct(i.alias("i"), F.coalesce(pick(i, own), F.lit(UNKNOWN_LOG_PROB)).alias("t"))

            return _total(F.col("log_prior"), F.transform(every, term), F.col(SIZE), self.m)

        bound = summed(lambda i, t: F.when(i.eqNullSafe(F.col(PIVOT)), t["miss"]).otherwise(t["hit"]))
        base = summed(lambda i, t: t["miss"])
        return both.select(*self.keys, PIVOT, SIZE, F.col(LABEL).alias(CLASS), bound.alias(BOUND), base.alias("base"))

    def scored(self, pairs: DataFrame, long: DataFrame) -> DataFrame:
        """(vector, class, score) of (vector, class) pairs with their profiles; ``long`` has the vectors' features, to be joined where there are none."""
        if self.narrow:

            def lookup(i: Column) -> Column:
                n = F.try_element_at(F.try_element_at(F.col(COUNTS), i), F.get(F.col(FEATURES), i))
                n_c, v = F.col("n_c"), F.try_element_at(F.col(VALUES), i)
                return F.coalesce(log_likelihood(n, n_c, v), log_fallback(n_c, v), F.lit(UNKNOWN_LOG_PROB))

            return pairs.select(VECTOR, CLASS, _folded(F.col("log_prior"), lookup, F.col(SIZE), self.m).alias(SCORE))
        at = pairs.join(long, VECTOR)
        counts = self.counts.select(*self.keys, FEAT_IDX, VALUE, F.col(LABEL).alias(CLASS), N)
        at = at.join(counts, [*self.keys, FEAT_IDX, VALUE, CLASS], "left")
        at = at.join(self.vocabulary, [*self.keys, FEAT_IDX], "left")
        at = at.join(self.prior.withColumnRenamed(LABEL, CLASS), [*self.keys, CLASS])
        n_c, v = F.col("n_c"), F.col("n_values")
        term = F.coalesce(log_likelihood(F.col(N), n_c, v), log_fallback(n_c, v), F.lit(UNKNOWN_LOG_PROB))
        term = F.when(F.col(FEAT_IDX) < self.m, F.struct(F.col(FEAT_IDX).alias("i"), term.alias("t")))
        score = _total(F.first("log_prior"), F.collect_list(term), F.first(SIZE), self.m)
        return at.groupBy(VECTOR, CLASS).agg(score.alias(SCORE))


def _best(scored: DataFrame, digits: int | None) -> DataFrame:
    """The highest score of each vector, ties (to ``digits`` places) to the lowest label."""
    ranked = F.struct((-tied(F.col(SCORE), digits)).alias("r"), F.col(CLASS).alias("c"), F.col(SCORE).alias("s"))
    best = scored.groupBy(VECTOR).agg(F.min(ranked).alias("b"))
    return best.select(VECTOR, F.col("b.c").alias("prediction"), F.col("b.s").alias("score"))


def distinct_vectors(test: DataFrame, keys) -> DataFrame:
    """(keys, features) once each: aggregated by the scan's own tasks before they are exchanged."""
    return test.groupBy(*keys, FEATURES).agg(F.count(F.lit(1)).alias("n_rows"))


def predict_sparse(test: DataFrame, model: NBModel, ids=(), tie_digits: int | None = None) -> DataFrame:
    """(keys, ids, label, prediction, score), as the dense scorers give them; one row per test row.

    Rows without a model, or without a feature array, keep a null prediction. Not for streams: a
    vector's classes are grouped.
    """
    keys = model.keys
    vectors = distinct_vectors(test, keys).drop("n_rows").withColumn(SIZE, F.size(FEATURES))
    vectors = stage_table(vectors.filter(F.col(FEATURES).isNotNull()).withColumn(VECTOR, F.monotonically_increasing_id()))
    best = best_classes(vectors, model, tie_digits)
    found = vectors.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(FEATURES).alias("_features"), VECTOR).join(best, VECTOR)
    same = F.col(FEATURES).eqNullSafe(F.col("_features"))
    for k in keys:
        same = same & (test[k] == F.col(f"_{k}"))
    return test.join(found, same, "left").select(*[test[c] for c in (*keys, *ids, LABEL)], "prediction", "score")


def best_classes(vectors: DataFrame, model: NBModel, tie_digits: int | None = None) -> DataFrame:
    """(vector, prediction, score) of staged vectors (keys, features, size, vector)."""
    keys, s = model.keys, SparseModel(model)
    long = vectors.select(VECTOR, SIZE, *keys, F.posexplode_outer(FEATURES).alias(FEAT_IDX, VALUE))

    # the pivot: the model's feature whose value has the fewest classes, none at all if unseen
    known = long.join(s.vocabulary.select(*keys, FEAT_IDX), [*keys, FEAT_IDX]).join(s.lists, [*keys, FEAT_IDX, VALUE], "left")
    fewest = F.min(F.struct(F.coalesce("classes", F.lit(0)).alias("p"), F.col(FEAT_IDX).alias("i"), F.col(VALUE).alias("v")))
    pivots = known.groupBy(VECTOR).agg(fewest.alias("f")).select(VECTOR, F.col("f.i").alias(PIVOT), F.col("f.v").alias("_value"))
    vectors = stage_table(s.with_values(vectors.select(VECTOR, SIZE, *keys, FEATURES)).join(pivots, VECTOR, "left"))
    groups = vectors.select(*keys, PIVOT, SIZE).distinct()
    bounds = stage_table(s.bounds(groups).withColumn(CELL, F.floor(F.col(BOUND) * CELLS)))

    # the pivot's classes, and the best class of those that have none of the values
    plain = bounds.groupBy(*keys, PIVOT, SIZE).agg(
        F.min(F.struct((-tied(F.col("base"), tie_digits)).alias("s"), F.col(CLASS).alias("c"))).alias("b"), F.max(CELL).alias("_top")
    )
    group = F.coalesce(F.col(PIVOT), F.lit(-1)).alias(PIVOT)
    here = vectors.select(VECTOR, SIZE, *keys, group)
    plain = plain.select(*keys, group, SIZE, F.col("b.c").alias(CLASS), "_top")
    here = here.join(plain, [*keys, PIVOT, SIZE])
    listed = s.scored(s.listed(vectors), long)
    if not s.narrow:
        listed = stage_table(listed)
    first = listed.unionByName(s.scored(s.with_profiles(here.select(VECTOR, CLASS), vectors), long))

    # down the ranking of the others, as long as their bounds reach the best so far
    reach = 0.0 if tie_digits is None else 10.0**-tie_digits  # a tie may be that far below
    least = stage_table(first.groupBy(VECTOR).agg((F.max(SCORE) - reach).alias("_least")))
    here = here.select(VECTOR, SIZE, *keys, PIVOT, "_top").join(least, VECTOR)
    low = F.floor(F.col("_least") * CELLS)
    cells = F.when(low <= F.col("_top"), F.sequence(low, F.col("_top")))
    here = here.select(VECTOR, SIZE, *keys, PIVOT, "_least", F.explode(cells).alias(CELL))
    ranked = bounds.select(*keys, group, SIZE, CELL, CLASS, BOUND)
    more = here.join(ranked, [*keys, PIVOT, SIZE, CELL]).filter(F.col(BOUND) >= F.col("_least")).select(VECTOR, CLASS)
    # some were scored already, which gives the same score again; only those that reach the best are compared
    every = first.unionByName(s.scored(s.with_profiles(more, vectors), long))
    return _best(every.join(least, VECTOR).filter(F.col(SCORE) >= F.col("_least")).drop("_least"), tie_digits)
