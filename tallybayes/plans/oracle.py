"""DuckDB oracle SQL for the registered queries.

Written independently of the Spark plans: wide-to-long is a ``UNION ALL`` of
one select per feature, scoring is one left join per feature and class with
the terms added left to right, and the argmax is ``row_number()`` ordered by
score descending, then label ascending. Replication is modelled by
multiplying counts instead of copying rows.
"""

from __future__ import annotations

# fixed values, written out so that a wrong constant in the engine cannot match itself
NULL_CATEGORY = "None"
UNKNOWN_LOG_PROB = -23.025850929940457  # ln(1e-10)
LANG_WORDS = ("the", "und", "el", "les", "die", "que")
R = 9  # rounding digits, as in the Spark queries


def bucket(*cols: str) -> str:
    parts = [f"COALESCE(CAST({c} AS VARCHAR), '')" for c in cols]
    key = parts[0] if len(parts) == 1 else "concat_ws('|', " + ", ".join(parts) + ")"
    return f"(CAST('0x' || substr(md5({key}), 1, 8) AS BIGINT) % 100)"


def cat(expr: str) -> str:
    return f"COALESCE(CAST({expr} AS VARCHAR), '{NULL_CATEGORY}')"


def _features(exprs) -> str:
    return ", ".join(f"{cat(e)} AS f{i}" for i, e in enumerate(exprs))


LANG_IDS = ("doc_id",)
LANG_BASE = (
    "SELECT doc_id, CAST(lang AS VARCHAR) AS label, "
    + _features(
        [f"CASE WHEN contains(lower(' ' || text || ' '), ' {w} ') THEN 'y' ELSE 'n' END" for w in LANG_WORDS]
    )
    + f", {bucket('doc_id')} AS bucket FROM documents"
)

ORDERS_FROM = (
    "orders o JOIN customer c ON o.o_custkey = c.c_custkey "
    "JOIN nation n ON c.c_nationkey = n.n_nationkey"
)
ORDERS_IDS = ("o_orderkey",)


def orders_base(status: str = "o.o_orderstatus", extra: str = "") -> str:
    return (
        "SELECT o.o_orderkey, CAST(o.o_orderpriority AS VARCHAR) AS label, "
        + _features([status, "c.c_mktsegment", "n.n_name"])
        + f", {bucket('o.o_orderkey')} AS bucket{extra} FROM {ORDERS_FROM}"
    )


ORDERS_BASE = orders_base()

LINEITEM_IDS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
LINEITEM_BASE = (
    "SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, "
    "CAST(l.l_returnflag AS VARCHAR) AS label, "
    + _features(["l.l_linestatus", "l.l_linenumber", "p.p_brand", "p.p_type"])
    + ", "
    + bucket("l.l_orderkey", "l.l_linenumber", "l.l_partkey", "l.l_suppkey")
    + " AS bucket FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey"
)

QUALITY_IDS = ("doc_id",)


def documents_flag_base(flag: str) -> str:
    """Documents joined with their label flag; length binned on the training rows."""
    return (
        f"WITH raw AS (SELECT d.doc_id, CAST(l.{flag} AS VARCHAR) AS label, d.lang, d.source, d.n_chars, "
        + bucket("d.doc_id")
        + " AS bucket FROM documents d JOIN labels l ON d.doc_id = l.doc_id), "
        "e AS (SELECT min(CAST(n_chars AS DOUBLE)) AS lo, "
        "(max(CAST(n_chars AS DOUBLE)) - min(CAST(n_chars AS DOUBLE))) / 3 AS w FROM raw WHERE bucket < 80) "
        "SELECT doc_id, label, "
        + _features(
            [
                "lang",
                "source",
                "CAST(CASE WHEN n_chars IS NULL THEN NULL WHEN w = 0 THEN 0 "
                "ELSE least(greatest(floor((n_chars - lo) / w), 0), 2) END AS BIGINT)",
            ]
        )
        + ", bucket FROM raw CROSS JOIN e"
    )


QUALITY_BASE = documents_flag_base("quality")
TOXIC_BASE = documents_flag_base("toxic")

EVENTS_IDS = ("event_id",)
EVENTS_BASE = (
    "SELECT event_id, CAST(event_type AS VARCHAR) AS label, "
    + _features(["props", "user_id", "hour(ts)"])
    + f", {bucket('event_id')} AS bucket FROM events"
)


def nb_ctes(
    base: str,
    ids,
    m: int,
    group=(),
    train_where: str = "bucket < 80",
    test_where: str = "bucket >= 80",
    scales=None,
    ties: int | None = None,
) -> str:
    """Test rows are numbered, so that repeated ids stay apart. CTE chain ``base, train, test, cnt, cls, tot, voc, pri, lik, fb, sc, best``."""
    g = list(group) + (["scale"] if scales else [])

    def gsel(a: str) -> str:
        return "".join(f"{a}.{c}, " for c in g)

    def gon(a: str, b: str) -> str:
        return " AND ".join([f"{a}.{c} = {b}.{c}" for c in g]) or "TRUE"

    gby = "".join(f"{c}, " for c in g)
    if scales:
        sv = ", ".join(f"({int(s)})" for s in scales)
        rep = f" CROSS JOIN (VALUES {sv}) s(scale)"
        nexpr = "COUNT(*) * scale"
    else:
        rep = ""
        nexpr = "COUNT(*)"
    unions = " UNION ALL ".join(
        f"SELECT {gby}label, {i} AS feat_idx, f{i} AS value FROM train" for i in range(m)
    )
    ids_t = "".join(f"t.{c}, " for c in ids)
    terms = " + ".join(
        ["p.log_prior"]
        + [f"COALESCE(l{i}.log_lik, b{i}.log_fallback, {UNKNOWN_LOG_PROB!r})" for i in range(m)]
    )
    joins = " ".join(
        f"LEFT JOIN lik l{i} ON {gon(f'l{i}', 't')} AND l{i}.feat_idx = {i} AND l{i}.value = t.f{i} "
        f"AND l{i}.label = p.label "
        f"LEFT JOIN fb b{i} ON {gon(f'b{i}', 't')} AND b{i}.feat_idx = {i} AND b{i}.label = p.label"
        for i in range(m)
    )
    return f"""
base AS ({base}),
train AS (SELECT b.*{', s.scale' if scales else ''} FROM base b{rep} WHERE {train_where}),
test AS (SELECT b.*{', s.scale' if scales else ''}, row_number() OVER () AS rid FROM base b{rep} WHERE {test_where}),
cnt AS (SELECT {gby}feat_idx, value, label, CAST({nexpr} AS BIGINT) AS n
        FROM ({unions}) u WHERE label IS NOT NULL GROUP BY {gby}feat_idx, value, label),
cls AS (SELECT {gby}label, CAST(SUM(n) AS BIGINT) AS n_c FROM cnt WHERE feat_idx = 0 GROUP BY {gby}label),
tot AS (SELECT {gby}CAST(SUM(n_c) AS BIGINT) AS n_total, CAST(COUNT(*) AS BIGINT) AS n_classes
        FROM cls {('GROUP BY ' + ', '.join(g)) if g else ''}),
voc AS (SELECT {gby}feat_idx, CAST(COUNT(DISTINCT value) AS BIGINT) AS n_values FROM cnt GROUP BY {gby}feat_idx),
pri AS (SELECT {gsel('c')}c.label, c.n_c, ln((c.n_c + 1) / (t.n_total + t.n_classes)) AS log_prior
        FROM cls c JOIN tot t ON {gon('c', 't')}),
lik AS (SELECT {gsel('c')}c.feat_idx, c.value, c.label, c.n,
               ln((c.n + 1) / (k.n_c + v.n_values)) AS log_lik
        FROM cnt c JOIN cls k ON {gon('c', 'k')} AND c.label = k.label
                   JOIN voc v ON {gon('c', 'v')} AND c.feat_idx = v.feat_idx),
fb AS (SELECT {gsel('v')}v.feat_idx, k.label, ln(CAST(1 AS DOUBLE) / (k.n_c + v.n_values)) AS log_fallback
       FROM voc v JOIN cls k ON {gon('v', 'k')}),
sc AS (SELECT t.rid, {gsel('t')}{ids_t}t.label, p.label AS class, {terms} AS score
       FROM test t LEFT JOIN pri p ON {gon('p', 't')} {joins}),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY rid
                                   ORDER BY {f'round(score, {ties})' if ties else 'score'} DESC NULLS LAST, class ASC) AS rn FROM sc) x
         WHERE rn = 1)
"""


def predictions_sql(base: str, ids, m: int, **kw) -> str:
    cols = ", ".join(ids)
    return f"WITH {nb_ctes(base, ids, m, **kw)} SELECT {cols}, label, class AS prediction, round(score, {R}) AS score FROM best"


def accuracy_sql(base: str, ids, m: int, **kw) -> str:
    return (
        f"WITH {nb_ctes(base, ids, m, **kw)} SELECT CAST(COUNT(*) AS BIGINT) AS n_test, "
        "CAST(COALESCE(SUM(CASE WHEN class IS NOT DISTINCT FROM label THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_correct, "
        f"round(COALESCE(AVG(CASE WHEN class IS NOT DISTINCT FROM label THEN 1.0 ELSE 0.0 END), 0.0), {R}) AS accuracy "
        "FROM best"
    )


def model_sql(base: str, ids, m: int, select: str) -> str:
    return f"WITH {nb_ctes(base, ids, m)} {select}"


EXPERIMENT_BASE = (
    "SELECT 'orders' AS dataset, o_orderkey AS row_id, label, f0, f1, f2, bucket FROM ("
    + ORDERS_BASE
    + ") a UNION ALL SELECT 'events' AS dataset, event_id AS row_id, label, f0, f1, f2, bucket FROM ("
    + EVENTS_BASE
    + ") b"
)
EXPERIMENT_SCALES = (1, 10, 50)
SIZE_LABEL_SQL = (
    "CASE a.scale WHEN 1 THEN 'Small' WHEN 10 THEN 'Medium' WHEN 50 THEN 'Large' "
    "ELSE CAST(a.scale AS VARCHAR) END"
)
EXPERIMENT_RECORDS = (
    f"WITH {nb_ctes(EXPERIMENT_BASE, ('row_id',), 3, group=('dataset',), scales=EXPERIMENT_SCALES)}, "
    "acc AS (SELECT dataset, scale, CAST(COUNT(*) AS BIGINT) AS n_test, "
    "CAST(SUM(CASE WHEN class IS NOT DISTINCT FROM label THEN 1 ELSE 0 END) AS BIGINT) AS n_correct, "
    "AVG(CASE WHEN class IS NOT DISTINCT FROM label THEN 1.0 ELSE 0.0 END) AS accuracy "
    "FROM best GROUP BY dataset, scale) "
    f"SELECT a.dataset, a.scale, {SIZE_LABEL_SQL} AS size_label, t.n_total AS n_train, a.n_test, a.n_correct, "
    f"round(a.accuracy, {R}) AS accuracy FROM acc a JOIN tot t ON a.dataset = t.dataset AND a.scale = t.scale"
)


def _experiment_impl() -> str:
    """The experiment records under each scorer's name: all scorers must give the same."""
    return (
        f"WITH rec AS ({EXPERIMENT_RECORDS}) SELECT r.*, i.impl FROM rec r "
        "CROSS JOIN (VALUES ('long'), ('map'), ('map_arrays')) i(impl)"
    )


SIZE_OF_SCALE = "CASE scale WHEN 1 THEN 'Small' WHEN 10 THEN 'Medium' WHEN 50 THEN 'Large' ELSE CAST(scale AS VARCHAR) END"
RUNS = f"""
runs AS (SELECT *, {SIZE_OF_SCALE} AS size_label, train_time + pred_time AS total_time FROM (
  SELECT l_returnflag AS dataset,
    ['RDD Baseline', 'RDD Optimised', 'DF Baseline', 'DF Optimised'][1 + l_linenumber % 4] AS impl,
    [1, 10, 50, 100][1 + l_suppkey % 4] AS scale,
    CAST(SUM(CAST(floor(l_quantity) AS BIGINT)) AS BIGINT) / CAST(1000 AS DOUBLE) AS train_time,
    CAST(SUM(CAST(floor(l_extendedprice) AS BIGINT)) AS BIGINT) / CAST(1000 AS DOUBLE) AS pred_time
  FROM lineitem GROUP BY ALL) t)
"""


def _of(impl: str, agg: str = "max") -> str:
    names = ", ".join(f"'{i}'" for i in impl.split("|"))
    return f"{agg}(CASE WHEN impl IN ({names}) THEN total_time END)"


CUSTOMER_BASE = (
    "SELECT o.o_orderkey, CAST(o.o_custkey AS VARCHAR) AS label, "
    + _features(["c.c_mktsegment", "n.n_name", "o.o_orderstatus", "o.o_orderpriority"])
    + f", {bucket('o.o_orderkey')} AS bucket FROM {ORDERS_FROM}"
)


# -- bins between cuts ----------------------------------------------------------------
def cut_ctes(source: str, exprs, label: str, bins: int) -> str:
    """CTEs ``train, long, cuts, cell``: training rows by column, exact quantile cuts, each row's bin."""
    key = bucket("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    cols = ", ".join(f"{e} AS x{i}" for i, e in enumerate(exprs))
    parts = " UNION ALL ".join(f"SELECT {i} AS g, x{i} AS x, label FROM train" for i in range(len(exprs)))
    return f"""
train AS (SELECT {label} AS label, {cols} FROM {source} WHERE {key} < 80),
long AS ({parts}),
ranked AS (SELECT g, x, row_number() OVER (PARTITION BY g ORDER BY x) AS rn, count(*) OVER (PARTITION BY g) AS n,
                  max(x) OVER (PARTITION BY g) AS top FROM long),
cuts AS (SELECT g, x, row_number() OVER (PARTITION BY g ORDER BY x) - 1 AS i FROM (
           SELECT DISTINCT g, x FROM ranked, range(1, {bins}) j(j) WHERE rn = ceil(n * j / {bins}.0) AND x < top) d),
cell AS (SELECT l.g, l.x, l.label, coalesce(c.i + 1, 0) AS cell FROM long l ASOF LEFT JOIN cuts c ON l.g = c.g AND l.x > c.x)
"""


def mdl_round(k: int) -> str:
    """CTEs ``seg{k}, cut{k}``: the cells of the segments of round k, and the accepted cuts."""
    if k == 0:
        seg = "SELECT g, 0 AS segment, cell, label, count(*) AS n FROM cell GROUP BY ALL"
    else:
        seg = (
            f"SELECT s.g, s.segment * 2 + 1 + CASE WHEN s.cell > c.cut THEN 1 ELSE 0 END AS segment, s.cell, s.label, s.n "
            f"FROM seg{k - 1} s JOIN cut{k - 1} c ON s.g = c.g AND s.segment = c.segment"
        )
    return f"""
seg{k} AS ({seg}),
at{k} AS (SELECT DISTINCT g, segment, cell AS c FROM seg{k}
          WHERE cell < (SELECT max(cell) FROM seg{k} m WHERE m.g = seg{k}.g AND m.segment = seg{k}.segment)),
two{k} AS (SELECT a.g, a.segment, a.c, s.label, sum(s.n) AS w, sum(CASE WHEN s.cell <= a.c THEN s.n ELSE 0 END) AS l
           FROM at{k} a JOIN seg{k} s ON a.g = s.g AND a.segment = s.segment GROUP BY ALL),
sums{k} AS (SELECT *, sum(w) OVER p AS nw, sum(l) OVER p AS nl FROM two{k} WINDOW p AS (PARTITION BY g, segment, c)),
ent{k} AS (SELECT g, segment, c, max(nw) AS nw, max(nl) AS nl, max(nw) - max(nl) AS nr,
    count(*) AS kw, count(CASE WHEN l > 0 THEN 1 END) AS kl, count(CASE WHEN w > l THEN 1 END) AS kr,
    -sum(w / nw * log2(w / nw)) AS ew,
    -sum(CASE WHEN l > 0 THEN l / nl * log2(l / nl) ELSE 0 END) AS el,
    -sum(CASE WHEN w > l THEN (w - l) / (nw - nl) * log2((w - l) / (nw - nl)) ELSE 0 END) AS er
  FROM sums{k} GROUP BY g, segment, c),
gain{k} AS (SELECT g, segment, c, round(ew - nl / nw * el - nr / nw * er, 12) AS gain,
    ew - nl / nw * el - nr / nw * er > (log2(nw - 1) + log2(pow(3, kw) - 2) - (kw * ew - kl * el - kr * er)) / nw AS pays FROM ent{k}),
cut{k} AS (SELECT g, segment, c AS cut FROM (SELECT *, row_number() OVER (PARTITION BY g, segment ORDER BY gain DESC, c) AS rn FROM gain{k}) r
           WHERE rn = 1 AND pays)
"""


def mdl_sql(source: str, exprs, label: str, candidates: int, depth: int) -> str:
    rounds = ",".join(mdl_round(k) for k in range(depth))
    every = " UNION ".join(f"SELECT g, cut FROM cut{k}" for k in range(depth))
    return (
        f"WITH {cut_ctes(source, exprs, label, candidates)}, {rounds}, chosen AS ({every}) "
        "SELECT g AS feat_idx, CAST(above AS VARCHAR) AS value, CAST(label AS VARCHAR) AS label, count(*) AS n FROM ("
        "SELECT c.g, c.label, (SELECT count(*) FROM chosen h WHERE h.g = c.g AND c.cell > h.cut) AS above FROM cell c) a GROUP BY ALL"
    )


SCAN_REJECTS = """
SELECT CAST(NULL AS BIGINT) AS key, CAST(NULL AS VARCHAR) AS status, CAST(NULL AS VARCHAR) AS priority, line, reason FROM (
  SELECT CASE k WHEN 0 THEN o_orderkey || ',' || o_orderstatus
                WHEN 1 THEN o_orderkey || ',' || o_orderstatus || ',' || o_orderpriority || ',more'
                WHEN 2 THEN 'no' || o_orderkey || ',' || o_orderstatus || ',' || o_orderpriority
                WHEN 3 THEN '   '
                ELSE o_orderkey || ',' || o_orderstatus || ',' || o_orderpriority || ',"open' END AS line,
         CASE k WHEN 0 THEN 'fields: expected 3, got 2' WHEN 1 THEN 'fields: expected 3, got 4'
                WHEN 2 THEN 'type: column key is not bigint' WHEN 3 THEN 'blank line' ELSE 'malformed' END AS reason
  FROM (SELECT *, o_orderkey % 10 AS k FROM orders) o WHERE k < 5) r
UNION ALL SELECT o_orderkey, o_orderstatus, o_orderpriority, NULL, NULL FROM orders WHERE o_orderkey % 10 >= 5
"""

ORDERS_SET_COLS = "o.o_orderkey, o.o_orderstatus, c.c_mktsegment, n.n_name, o.o_orderpriority"


def oracle_sql() -> dict[str, str]:
    lik_m = len(LINEITEM_IDS)
    return {
        "nb_lang_predict": predictions_sql(LANG_BASE, LANG_IDS, len(LANG_WORDS)),
        "nb_lang_accuracy": accuracy_sql(LANG_BASE, LANG_IDS, len(LANG_WORDS)),
        "nb_orders_predict": predictions_sql(ORDERS_BASE, ORDERS_IDS, 3),
        "nb_orders_accuracy": accuracy_sql(ORDERS_BASE, ORDERS_IDS, 3),
        "nb_lineitem_predict": predictions_sql(LINEITEM_BASE, LINEITEM_IDS, lik_m),
        "nb_lineitem_accuracy": accuracy_sql(LINEITEM_BASE, LINEITEM_IDS, lik_m),
        "nb_events_accuracy": accuracy_sql(EVENTS_BASE, EVENTS_IDS, 3),
        "predict_long": predictions_sql(EVENTS_BASE, EVENTS_IDS, 3),
        "stream_predict_events": predictions_sql(EVENTS_BASE, EVENTS_IDS, 3),
        "nb_quality_predict": predictions_sql(QUALITY_BASE, QUALITY_IDS, 3),
        "nb_quality_accuracy": accuracy_sql(QUALITY_BASE, QUALITY_IDS, 3),
        "nb_toxic_accuracy": accuracy_sql(TOXIC_BASE, QUALITY_IDS, 3),
        "class_distribution": (
            "SELECT o_orderpriority, CAST(COUNT(*) AS BIGINT) AS count FROM orders "
            "GROUP BY o_orderpriority ORDER BY count DESC, o_orderpriority"
        ),
        "label_feature_project": f"SELECT o_orderkey, label, f0, f1, f2 FROM ({ORDERS_BASE}) x",
        "wide_to_long": (
            f"WITH base AS ({LINEITEM_BASE}) "
            + " UNION ALL ".join(
                f"SELECT {', '.join(LINEITEM_IDS)}, label, CAST({i} AS INTEGER) AS feat_idx, f{i} AS value FROM base"
                for i in range(4)
            )
        ),
        "composite_key_counts": model_sql(
            ORDERS_BASE,
            ORDERS_IDS,
            3,
            "SELECT concat_ws('_', 'feat', CAST(feat_idx AS VARCHAR), value, label) AS key, n FROM cnt "
            "UNION ALL SELECT 'class_' || label AS key, n_c AS n FROM cls",
        ),
        "feature_value_counts": model_sql(
            LINEITEM_BASE, LINEITEM_IDS, lik_m, "SELECT CAST(feat_idx AS INTEGER) AS feat_idx, value, label, n FROM cnt"
        ),
        "vocabulary_size": model_sql(
            LINEITEM_BASE,
            LINEITEM_IDS,
            lik_m,
            "SELECT CAST(feat_idx AS INTEGER) AS feat_idx, "
            "CASE feat_idx WHEN 0 THEN 'l_linestatus' WHEN 1 THEN 'l_linenum' WHEN 2 THEN 'p_brand' "
            "WHEN 3 THEN 'p_type' END AS feature, n_values FROM voc",
        ),
        "training_totals": model_sql(LINEITEM_BASE, LINEITEM_IDS, lik_m, "SELECT n_total, n_classes FROM tot"),
        "log_prior": model_sql(
            LINEITEM_BASE, LINEITEM_IDS, lik_m, f"SELECT label, n_c, round(log_prior, {R}) AS log_prior FROM pri"
        ),
        "log_likelihood": model_sql(
            LINEITEM_BASE,
            LINEITEM_IDS,
            lik_m,
            f"SELECT CAST(feat_idx AS INTEGER) AS feat_idx, value, label, n, round(log_lik, {R}) AS log_lik FROM lik",
        ),
        "log_fallback": model_sql(
            LINEITEM_BASE,
            LINEITEM_IDS,
            lik_m,
            f"SELECT CAST(feat_idx AS INTEGER) AS feat_idx, label, round(log_fallback, {R}) AS log_fallback FROM fb",
        ),
        "model_table": model_sql(
            ORDERS_BASE,
            ORDERS_IDS,
            3,
            "SELECT 'prior' AS kind, CAST(NULL AS INTEGER) AS feat_idx, CAST(NULL AS VARCHAR) AS value, label, "
            f"n_c AS n, round(log_prior, {R}) AS log_prob FROM pri UNION ALL "
            "SELECT 'likelihood', CAST(feat_idx AS INTEGER), value, label, n, "
            f"round(log_lik, {R}) FROM lik UNION ALL "
            "SELECT 'fallback', CAST(feat_idx AS INTEGER), CAST(NULL AS VARCHAR), label, CAST(NULL AS BIGINT), "
            f"round(log_fallback, {R}) FROM fb",
        ),
        "class_scores": model_sql(
            ORDERS_BASE, ORDERS_IDS, 3, f"SELECT o_orderkey, label, class, round(score, {R}) AS score FROM sc"
        ),
        "predict_unseen": predictions_sql(
            orders_base(extra=", r.r_name").replace(
                f"FROM {ORDERS_FROM}", f"FROM {ORDERS_FROM} JOIN region r ON n.n_regionkey = r.r_regionkey"
            ),
            ORDERS_IDS,
            3,
            train_where="bucket < 80 AND r_name <> 'ASIA'",
        ),
        "nulls_as_category": predictions_sql(
            orders_base(status="nullif(o.o_orderstatus, 'P')"), ORDERS_IDS, 3
        ),
        "label_with_underscore": predictions_sql(
            "SELECT o.o_orderkey, concat_ws('_', o.o_orderstatus, c.c_mktsegment) AS label, "
            + _features(["o.o_orderpriority", "n.n_name"])
            + f", {bucket('o.o_orderkey')} AS bucket FROM {ORDERS_FROM}",
            ORDERS_IDS,
            2,
        ),
        "accuracy_empty": accuracy_sql(ORDERS_BASE, ORDERS_IDS, 3, test_where="bucket >= 80 AND o_orderkey < 0"),
        "hash_split_counts": (
            f"SELECT CASE WHEN {bucket('o_orderkey')} < 80 THEN 'train' ELSE 'test' END AS part, "
            "CAST(COUNT(*) AS BIGINT) AS n_rows FROM orders GROUP BY 1"
        ),
        "replicate_counts": (
            f"WITH {nb_ctes(ORDERS_BASE, ORDERS_IDS, 3)}, "
            "c3 AS (SELECT label, n_c * 3 AS n_c FROM cls), "
            "t3 AS (SELECT SUM(n_c) AS n_total, COUNT(*) AS n_classes FROM c3) "
            f"SELECT label, CAST(n_c AS BIGINT) AS n_c, round(ln((n_c + 1) / (n_total + n_classes)), {R}) AS log_prior "
            "FROM c3, t3"
        ),
        "binned_train_counts": (
            "WITH base AS (SELECT l_returnflag AS label, l_quantity AS q, l_discount AS d, "
            + bucket("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
            + " AS bucket FROM lineitem), "
            "train AS (SELECT * FROM base WHERE bucket < 80), "
            "e AS (SELECT min(q) AS qlo, (max(q) - min(q)) / 3 AS qw, min(d) AS dlo, (max(d) - min(d)) / 3 AS dw FROM train), "
            "binned AS (SELECT label, "
            "CAST(CAST(CASE WHEN q IS NULL THEN NULL WHEN qw = 0 THEN 0 ELSE least(greatest(floor((q - qlo) / qw), 0), 2) END AS BIGINT) AS VARCHAR) AS f0, "
            "CAST(CAST(CASE WHEN d IS NULL THEN NULL WHEN dw = 0 THEN 0 ELSE least(greatest(floor((d - dlo) / dw), 0), 2) END AS BIGINT) AS VARCHAR) AS f1 "
            "FROM train CROSS JOIN e) "
            "SELECT 0 AS feat_idx, f0 AS value, label, CAST(COUNT(*) AS BIGINT) AS n FROM binned GROUP BY f0, label "
            "UNION ALL SELECT 1, f1, label, CAST(COUNT(*) AS BIGINT) FROM binned GROUP BY f1, label"
        ),
        "sample_rows": (
            "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders ORDER BY o_orderkey LIMIT 5"
        ),
        "csv_scan": f"SELECT {ORDERS_SET_COLS} FROM {ORDERS_FROM}",
        "text_scan": f"SELECT o.o_orderpriority, o.o_orderstatus, c.c_mktsegment, n.n_name, o.o_orderkey FROM {ORDERS_FROM}",
        "experiment_records": EXPERIMENT_RECORDS,
        "experiment_records_long": EXPERIMENT_RECORDS,
        "scan_policies": (
            "SELECT 'csv' AS scan, '  ' || o.o_orderkey AS key, nullif(o.o_orderstatus, 'P') AS status, "
            "c.c_mktsegment || ',' || n.n_name AS segment, o.o_orderpriority || ' ' AS priority, CAST(NULL AS VARCHAR) AS rest "
            f"FROM {ORDERS_FROM} UNION ALL "
            "SELECT 'text', CAST(o.o_orderkey AS VARCHAR), CASE WHEN o.o_orderstatus = 'P' THEN '' ELSE o.o_orderstatus END, "
            "'\"' || c.c_mktsegment, n.n_name || '\"', o.o_orderpriority "
            f"FROM {ORDERS_FROM}"
        ),
        "random_split_check": (
            "SELECT CAST(COUNT(*) AS BIGINT) AS n_rows, CAST(COUNT(*) AS BIGINT) AS n_union, "
            "CAST(0 AS BIGINT) AS n_overlap FROM orders"
        ),
        "predict_repeated_ids": predictions_sql(orders_base(extra=", o.o_custkey"), ("o_custkey",), 3),
        "predict_shuffle_tier": predictions_sql(EVENTS_BASE, EVENTS_IDS, 3),
        "predict_tie": predictions_sql(
            f"SELECT b.* REPLACE (l.label AS label) FROM ({ORDERS_BASE}) b "
            "CROSS JOIN (VALUES ('z late'), ('a early')) l(label)",
            ORDERS_IDS,
            3,
        ),
        "report_pivot_impl": (
            f"WITH rec AS ({_experiment_impl()}) SELECT dataset, impl, "
            "max(CASE WHEN size_label = 'Small' THEN accuracy END) AS Small, "
            "max(CASE WHEN size_label = 'Medium' THEN accuracy END) AS Medium, "
            "max(CASE WHEN size_label = 'Large' THEN accuracy END) AS Large "
            "FROM rec GROUP BY dataset, impl ORDER BY dataset, impl"
        ),
        "accuracy_listing": f"SELECT dataset, impl, scale, accuracy FROM ({_experiment_impl()}) x ORDER BY dataset, impl, scale",
        "report_totals": (
            f"WITH {RUNS} SELECT dataset, impl, scale, size_label, round(train_time, {R}) AS train_time, "
            f"round(pred_time, {R}) AS pred_time, round(total_time, {R}) AS total_time FROM runs"
        ),
        "report_total_pivot": (
            f"WITH {RUNS} SELECT dataset, impl, "
            + ", ".join(
                f"""round(max(CASE WHEN size_label = '{s}' THEN total_time END), {R}) AS "{s}" """
                for s in ("Small", "Medium", "Large", "100")
            )
            + " FROM runs GROUP BY dataset, impl"
        ),
        "report_speedup": (
            f"WITH {RUNS}, w AS (SELECT dataset, size_label, {_of('RDD Baseline')} AS rb, {_of('RDD Optimised')} AS ro, "
            f"{_of('DF Baseline')} AS db, {_of('DF Optimised')} AS dopt FROM runs GROUP BY dataset, size_label) "
            f"SELECT dataset, size_label, round(rb / ro, {R}) AS rdd_speedup, round(db / dopt, {R}) AS df_speedup, "
            "CASE WHEN least(rb, ro) < least(db, dopt) THEN 'RDD' ELSE 'DF' END AS winner FROM w "
            "WHERE rb IS NOT NULL AND ro IS NOT NULL AND db IS NOT NULL AND dopt IS NOT NULL"
        ),
        "report_mean_by": f"WITH {RUNS} SELECT impl, round(avg(total_time), {R}) AS mean_total_time FROM runs GROUP BY impl",
        "report_mean_winner": (
            f"WITH {RUNS}, p AS (SELECT dataset, scale, {_of('RDD Baseline|RDD Optimised', 'min')} AS r, "
            f"{_of('DF Baseline|DF Optimised', 'min')} AS d FROM runs GROUP BY dataset, scale) "
            f"SELECT round(avg(r), {R}) AS avg_rdd, round(avg(d), {R}) AS avg_df, "
            "CASE WHEN avg(r) < avg(d) THEN 'RDD' ELSE 'DataFrame' END AS winner FROM p"
        ),
        "predict_many_classes": predictions_sql(CUSTOMER_BASE, ORDERS_IDS, 4, ties=R),
        "accuracy_many_classes": accuracy_sql(CUSTOMER_BASE, ORDERS_IDS, 4, ties=R),
        "predict_size_safe": predictions_sql(EVENTS_BASE, EVENTS_IDS, 3),
        "accuracy_weighted": accuracy_sql(LINEITEM_BASE, LINEITEM_IDS, lik_m),
        "model_roundtrip": predictions_sql(ORDERS_BASE, ORDERS_IDS, 3),
        "predict_observed": accuracy_sql(EVENTS_BASE, EVENTS_IDS, 3),
        "stream_sink_restart": predictions_sql(EVENTS_BASE, EVENTS_IDS, 3),
        "counts_incremental": (
            f"WITH {nb_ctes(ORDERS_BASE, ORDERS_IDS, 3, train_where='o_orderkey % 4 <> 2')} "
            "SELECT CAST(feat_idx AS INTEGER) AS feat_idx, value, label, n FROM cnt"
        ),
        "scan_rejects": SCAN_REJECTS,
        "spread_rows": (
            "SELECT CAST(7 AS BIGINT) AS n_parts, count(*) AS n_rows, CAST(sum(o_orderkey) AS BIGINT) AS key_sum, true AS even FROM orders"
        ),
        "split_stratified": (
            "SELECT o_orderkey, o_orderpriority, CASE WHEN rn <= round(n * 0.8) THEN 'train' ELSE 'test' END AS part FROM ("
            "SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 13) AS BIGINT)) AS rn, "
            "count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders) x"
        ),
        "binned_quantile_counts": (
            f"WITH {cut_ctes('lineitem', ['l_extendedprice', 'l_discount'], 'l_returnflag', 4)} "
            "SELECT g AS feat_idx, CAST(cell AS VARCHAR) AS value, label, count(*) AS n FROM cell GROUP BY ALL"
        ),
        "binned_mdl_counts": mdl_sql(
            "lineitem", ["l_extendedprice / l_quantity", "l_discount"], "CAST(floor(l_quantity / 10) AS BIGINT)", 64, 3
        ),
        "report_pivot": (
            f"WITH rec AS ({EXPERIMENT_RECORDS}) SELECT dataset, 'map' AS impl, "
            "max(CASE WHEN size_label = 'Small' THEN accuracy END) AS Small, "
            "max(CASE WHEN size_label = 'Medium' THEN accuracy END) AS Medium, "
            "max(CASE WHEN size_label = 'Large' THEN accuracy END) AS Large "
            "FROM rec GROUP BY dataset ORDER BY dataset"
        ),
    }
