"""Scoring: per-class log scores, argmax, prediction.

Every scorer gives one output row per test row, whatever its ids (they are
carried, never grouped by; they may repeat, be null or be absent), and adds the
same terms in the same order: prior first, then the features in column order.

``map`` (the default while the model can be broadcast)
    Test rows are never shuffled. Features of up to ``max_map_values`` values
    are folded with the class header into one row per model, broadcast and
    joined on the model key; each row looks its values up by map access, a
    linear scan. A wider feature is a hashed lookup instead: its part of the
    dense likelihood frame is broadcast and joined on (model key, value), one
    hash join per wide feature, in the same stage. When ``features × classes``
    is small the sum is unrolled into scalar expressions (one per class), which
    keeps the projection inside whole-stage codegen; otherwise it uses
    higher-order array functions, which Spark evaluates interpreted (about 6x
    slower per row, measured). Where ``NBModel.stats()`` puts the folded row
    above its bound, every feature is a hashed lookup, and a part above its own
    bound is merge-joined instead of broadcast: likelihoods on (model key,
    value), read without an exchange where the model is a stored one (see
    ``store.py``), and the class header on the model key and a salt, which
    spreads the rows of one model and keeps Spark from turning a constant key into a
    broadcast. That needs no state, so it serves streams too.

``long`` (models too large to broadcast)
    Test rows get a row number that is made durable first, go to long form,
    left-join the dense likelihood frame on (key, feature, value) and are
    regrouped by the row number: two shuffles however many features there are.

``sparse`` (very many classes, see ``sparse.py``)
    Scores, for each distinct feature vector, only the classes that can be the
    best: no array is as long as the number of classes.

``map_arrays`` forces the array form of the map scorer (no unrolling).
``auto`` picks ``sparse`` above ``SPARSE_CLASSES`` classes, else ``map`` when the
folded model is below ``max_map_bytes``, else ``long``: a choice of cost alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybayes.functions.exprs import UNKNOWN_LOG_PROB, argmax, fold_sum
from tallybayes.operators.prepare import FEAT_IDX, FEATURES, LABEL, VALUE
from tallybayes.operators.sparse import extra as _extra
from tallybayes.operators.sparse import predict_sparse, tied
from tallybayes.operators.train import ModelStats, NBModel, make_durable

MAX_MAP_BYTES = 64 * 1024 * 1024
# map access scans keys linearly; measured on 600k test rows (orders + one
# feature of V values, local[8]): V=256 map 1.5 s / long 1.7 s, V=1024 map
# 2.2 s / long 1.6 s, V=4096 map 5.6 s / long 1.8 s -> switch above 256
MAX_MAP_VALUES = 256
# dense likelihood frames (of one wide feature, or of all in the long scorer) up to this size are broadcast
MAX_DENSE_BROADCAST_BYTES = 256 * 1024 * 1024
# largest features x classes for which the sum is unrolled into scalar
# expressions. Measured (120k test rows, 22 features, local[8]): 12-66 terms
# unrolled is 4-6x faster than the array form; 550 terms only reaches parity
# when warm and costs ~3.5 s of code generation on first use; at 1,100 terms
# the array form is faster.
UNROLL_MAX_TERMS = 256
# classes from which scoring only those that can win is cheaper than scoring all
SPARSE_CLASSES = 1000

CLASSES = "classes"
SCORES = "scores"
PARTS = "_parts"
ROW = "_row"


def choose_scorer(model: NBModel, max_map_bytes: int = MAX_MAP_BYTES) -> str:
    st = model.stats()
    if st.max_classes > SPARSE_CLASSES:
        return "sparse"
    return "map" if st.map_bytes <= max_map_bytes else "long"


def _unknown(n_classes):
    return F.array_repeat(F.lit(UNKNOWN_LOG_PROB), n_classes)


def _unrollable(st: ModelStats) -> bool:
    return 0 < st.max_features * max(st.max_classes, 1) <= UNROLL_MAX_TERMS


def _wide(i: int) -> str:
    return f"_wide_{i}"


def _wide_features(st: ModelStats, max_map_bytes: int, max_map_values: int) -> list[int]:
    """Features that are hashed lookups: those of many values, or all if the others don't fold into a bounded row."""
    wide = [i for i, (n, _) in enumerate(st.features) if n > max_map_values]
    narrow = sum(b for i, (_, b) in enumerate(st.features) if i not in wide)
    return wide if st.header_bytes + narrow <= max_map_bytes else list(range(len(st.features)))


def _salted(test: DataFrame, header: DataFrame, keys) -> DataFrame:
    """The test rows with their model's header, merge-joined on the model key and a salt.

    The salt comes from the whole row, so the rows of one model meet in as many
    tasks as there are shuffle partitions, each with one copy of the header.
    """
    salts = int(test.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mine = test.withColumn("_salt", F.pmod(F.xxhash64(*test.columns), F.lit(salts)))
    copies = header.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return mine.join(copies.hint("merge"), [*keys, "_salt"], "left").drop("_salt")


def _with_map_model(
    test: DataFrame, model: NBModel, max_map_bytes: int, max_map_values: int, max_dense_bytes: int | None = None
) -> DataFrame:
    """The test rows with the folded model and, for each wide feature, the likelihoods of their value."""
    st = model.stats()
    limit = MAX_DENSE_BROADCAST_BYTES if max_dense_bytes is None else max_dense_bytes
    wide = _wide_features(st, max_map_bytes, max_map_values)
    narrow = [i for i in range(len(st.features)) if i not in wide]
    out = test
    # lookups first: where they shuffle, the rows don't carry the header yet
    for i in wide:
        dense = model.lookup.filter(F.col(FEAT_IDX) == i)
        right = dense.select(
            *[F.col(k).alias(f"{_wide(i)}_{k}") for k in model.keys],
            F.col(VALUE).alias(_wide(i) + "_value"),
            F.col("log_liks").alias(_wide(i)),
        )
        right = F.broadcast(right) if st.features[i][1] <= limit else right.hint("merge")
        at = F.get(F.col(FEATURES), i) == F.col(_wide(i) + "_value")
        for k in model.keys:
            at = at & (out[k] == F.col(f"{_wide(i)}_{k}"))
        out = out.join(right, at, "left").drop(*[f"{_wide(i)}_{k}" for k in model.keys], _wide(i) + "_value")
    header = model.folded(narrow) if narrow else model.score_header
    if narrow or st.header_bytes <= max_map_bytes:
        return out.join(F.broadcast(header), model.keys, "left")
    return _salted(out, header, model.keys)


def _map_lookup(wide):
    """lik[i][value_i] (of a wide feature: its joined likelihoods), else fallback[i]."""

    def look(i: int) -> Column:
        if i in wide:
            own = F.col(_wide(i))
        else:
            own = F.try_element_at(F.try_element_at(F.col("lik"), F.lit(i)), F.get(F.col(FEATURES), i))
        return F.coalesce(own, F.try_element_at(F.col("fallback"), F.lit(i)))

    return look


def _long_lookup(i: int) -> Column:
    """The joined likelihood of part i, else fallback[i] (long scorer)."""
    return F.coalesce(
        F.get(F.col(PARTS), i)["c"],
        F.try_element_at(F.col("fallback"), F.lit(i)),
    )


def _unrolled_class_scores(st: ModelStats, lookup, size: Column) -> list[Column]:
    """One scalar score expression per class slot 0..K-1 (null past a model's K).

    ``look_i`` (``lookup(i)``, null when the row has no feature i) is written
    once per class, always as the first argument of ``coalesce``: an
    always-evaluated position, so Catalyst's subexpression elimination
    computes each lookup once per row (inside a ``when`` branch it would not,
    and every lookup would run K times; measured 4x slower). ``pad_i`` is
    ``ln(1e-10)`` for a feature the model does not know and ``0.0`` for a
    feature the row does not have (``+ 0.0`` is exact); features beyond the
    model's count add ``ln(1e-10)`` each, in one product, as in the array form.
    """
    m, k = st.max_features, max(st.max_classes, 1)
    unknown = F.lit(UNKNOWN_LOG_PROB)
    looks = [F.when(size > i, lookup(i)) for i in range(m)]
    pads = [F.when(size > i, unknown).otherwise(F.lit(0.0)) for i in range(m)]
    extra = _extra(size, m)
    out = []
    for c in range(k):
        s = F.get(F.col("prior"), c)
        for i in range(m):
            s = s + F.coalesce(F.get(looks[i], c), pads[i])
        out.append(s + extra)
    return out


def _unrolled_argmax(scores: list[Column], digits: int | None = None) -> tuple[Column, Column]:
    """Highest score, ties to the lowest class slot (classes are sorted)."""
    cands = [F.struct(s.alias("s"), F.lit(-c).alias("neg_j")) for c, s in enumerate(scores)]
    if digits is not None:
        cands = [F.struct(tied(s, digits).alias("r"), F.lit(-c).alias("neg_j"), s.alias("s")) for c, s in enumerate(scores)]
    best = cands[0] if len(cands) == 1 else F.greatest(*cands)
    return F.get(F.col(CLASSES), -best["neg_j"]), best["s"]


def _array_scores(st: ModelStats, parts: Column, size: Column) -> Column:
    """prior + parts folded left to right (higher-order functions), then the features beyond the model's count."""
    known = fold_sum(F.col("prior"), F.slice(parts, 1, st.max_features))
    return F.transform(known, lambda s: s + _extra(size, st.max_features))


def _map_parts(wide, every: bool) -> Column:
    def part(v: Column, i: Column) -> Column:
        own = F.lit(None).cast("array<double>") if every else F.try_element_at(F.try_element_at(F.col("lik"), i), v)
        for w in wide:
            own = F.when(i == w, F.col(_wide(w))).otherwise(own)
        return F.coalesce(own, F.try_element_at(F.col("fallback"), i), _unknown(F.size(CLASSES)))

    return F.transform(FEATURES, part)


def _long_parts() -> Column:
    return F.transform(
        PARTS,
        lambda p: F.coalesce(
            p["c"], F.try_element_at(F.col("fallback"), p["i"]), _unknown(F.size(CLASSES))
        ),
    )


def _long_grouped(test: DataFrame, model: NBModel, ids, max_dense_bytes: int | None = None) -> DataFrame:
    """(keys, ids, label, _parts, classes, prior, fallback): one row per test row.

    ``_parts`` is the row's (feat_idx, likelihood array) list sorted by
    feature; a value the model has not seen has a null array. Rows are
    regrouped by a number of their own, fixed by a checkpoint, so equal ids stay apart.
    """
    keys, st = model.keys, model.stats()
    dense = model.dense_likelihood
    limit = MAX_DENSE_BROADCAST_BYTES if max_dense_bytes is None else max_dense_bytes
    src = make_durable(test.select(*keys, *ids, LABEL, FEATURES).withColumn(ROW, F.monotonically_increasing_id()))
    if st.dense_bytes <= limit:
        # size-proven: broadcast the dense model and hash-partition the compact
        # test rows by number once; explode, lookup and regrouping then reuse
        # that partitioning, so no exploded row is ever shuffled
        dense = F.broadcast(dense)
        src = src.repartition(ROW)
    long = src.select(ROW, *keys, *ids, LABEL, F.posexplode_outer(FEATURES).alias(FEAT_IDX, VALUE))
    joined = long.join(dense, [*keys, FEAT_IDX, VALUE], "left")
    rest = [F.first(c).alias(c) for c in (*keys, *ids, LABEL)]
    part = F.struct(F.col(FEAT_IDX).alias("i"), F.col("log_liks").alias("c"))
    part = F.when(F.col(FEAT_IDX).isNotNull(), part)  # a row without features has no part
    grouped = joined.groupBy(ROW).agg(*rest, F.array_sort(F.collect_list(part)).alias(PARTS))
    header = model.score_header
    if st.header_bytes <= limit:
        header = F.broadcast(header)
    return grouped.join(header, keys, "left")


def _resolve(model: NBModel, scorer: str, max_map_bytes: int) -> str:
    if scorer == "auto":
        scorer = choose_scorer(model, max_map_bytes)
    if scorer not in ("map", "map_arrays", "long", "sparse"):
        raise ValueError(f"unknown scorer {scorer!r}")
    return scorer


def score_arrays(
    test: DataFrame,
    model: NBModel,
    ids=(),
    scorer: str = "auto",
    max_map_bytes: int = MAX_MAP_BYTES,
    max_map_values: int = MAX_MAP_VALUES,
    max_dense_bytes: int | None = None,
) -> DataFrame:
    """(keys, ids, label, classes, scores): all class scores of each test row."""
    ids = list(ids)
    # all classes are asked for: sparse scoring has nothing to leave out
    if _resolve(model, scorer, max_map_bytes) in ("long", "sparse"):
        g = _long_grouped(test, model, ids, max_dense_bytes)
        return g.select(*model.keys, *ids, LABEL, CLASSES, _array_scores(model.stats(), _long_parts(), F.size(PARTS)).alias(SCORES))
    j = _with_map_model(test, model, max_map_bytes, max_map_values, max_dense_bytes)
    wide = _wide_features(model.stats(), max_map_bytes, max_map_values)
    parts = _map_parts(wide, "lik" not in j.columns)
    return j.select(*model.keys, *ids, LABEL, CLASSES, _array_scores(model.stats(), parts, F.size(FEATURES)).alias(SCORES))


def _unrolled_source(test, model, ids, kind, max_map_bytes, max_map_values, max_dense_bytes=None):
    """(frame, per-class score expressions) when the sum can be unrolled, else None."""
    st = model.stats()
    if kind == "map_arrays" or not _unrollable(st):
        return None
    if kind == "map":
        look = _map_lookup(_wide_features(st, max_map_bytes, max_map_values))
        joined = _with_map_model(test, model, max_map_bytes, max_map_values, max_dense_bytes)
        return joined, _unrolled_class_scores(st, look, F.size(FEATURES))
    return _long_grouped(test, model, ids, max_dense_bytes), _unrolled_class_scores(st, _long_lookup, F.size(PARTS))


def predict(
    test: DataFrame,
    model: NBModel,
    ids=(),
    scorer: str = "auto",
    max_map_bytes: int = MAX_MAP_BYTES,
    max_map_values: int = MAX_MAP_VALUES,
    max_dense_bytes: int | None = None,
    tie_digits: int | None = None,
) -> DataFrame:
    """(keys, ids, label, prediction, score); rows without a model keep a null prediction.

    The highest score wins, the lowest label among equals. Classes of the same
    counts in another order have equal scores that may differ in their last bit;
    ``tie_digits`` treats scores as equal that agree when rounded to so many decimal places.

    ``max_dense_bytes`` overrides the broadcast bound of dense likelihood frames
    (0 joins them by shuffles), ``max_map_bytes`` that of the folded row and the
    header; at 0 for both no part of the model is broadcast.
    """
    ids = list(ids)
    kind = _resolve(model, scorer, max_map_bytes)
    if kind == "sparse":
        return predict_sparse(test, model, ids, tie_digits)
    unrolled = _unrolled_source(test, model, ids, kind, max_map_bytes, max_map_values, max_dense_bytes)
    if unrolled is not None:
        joined, scores = unrolled
        pred, best = _unrolled_argmax(scores, tie_digits)
    else:
        joined = score_arrays(test, model, ids, kind, max_map_bytes, max_map_values, max_dense_bytes)
        pred, best = argmax(F.col(CLASSES), F.col(SCORES), tie_digits)
    return joined.select(*model.keys, *ids, LABEL, pred.alias("prediction"), best.alias("score"))


def class_scores(
    test: DataFrame,
    model: NBModel,
    ids=(),
    scorer: str = "auto",
    max_map_bytes: int = MAX_MAP_BYTES,
    max_map_values: int = MAX_MAP_VALUES,
    max_dense_bytes: int | None = None,
) -> DataFrame:
    """(keys, ids, label, class, score): one row per test row and class."""
    ids = list(ids)
    kind = _resolve(model, scorer, max_map_bytes)
    kind = "long" if kind == "sparse" else kind
    unrolled = _unrolled_source(test, model, ids, kind, max_map_bytes, max_map_values, max_dense_bytes)
    if unrolled is not None:
        joined, scores = unrolled
        pairs = F.array(
            *[F.struct(F.get(F.col(CLASSES), c).alias("class"), s.alias("score")) for c, s in enumerate(scores)]
        )
        out = joined.select(*model.keys, *ids, LABEL, F.inline(pairs))
        return out.filter(F.col("class").isNotNull())
    scored = score_arrays(test, model, ids, kind, max_map_bytes, max_map_values, max_dense_bytes)
    pairs = F.transform(
        CLASSES, lambda c, j: F.struct(c.alias("class"), F.get(F.col(SCORES), j).alias("score"))
    )
    return scored.select(*model.keys, *ids, LABEL, F.inline(pairs))
