"""URL filters: host-suffix and path-prefix expressions joined with rules on short digests.

Only DataFrame functions: every url is expanded into the expressions (host
suffix + path up to a slash) that could be a rule's, each is reduced to the
first 8 hex digits of its SHA-256, an equi-join on those finds candidates,
the full digest and the rest of the rule's path confirm them, and the most
specific rule wins.

Expansion is bounded by the rules, not by the url: only suffixes with as many
labels, and prefixes with as many slashes, as some rule has can match, so a
url of thousands of labels costs no more than a short one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybayes.llm._util import Stage, fresh, lower_ascii

SHORT = 8  # hex digits joined on; the full digest decides


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): host after the first ``://`` up to ``/ ? #``, A-Z lowered; path up to ``? #``.

    Null, or without ``://``: both empty.
    """
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return lower_ascii(host), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _labels(host: Column) -> Column:
    return F.size(F.split(host, r"\.", -1))


def _slashes(path: Column) -> Column:
    return F.regexp_count(path, F.lit("/"))


def rule_table(spark: SparkSession, rules) -> DataFrame:
    """(host, path, verdict) tuples as a table of literals."""
    rows = [F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in rules]
    if not rows:
        return spark.sql("SELECT '' AS host, '' AS path, '' AS verdict WHERE false")
    return spark.range(1).select(F.inline(F.array(*rows)))


def verdicts(urls: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``urls`` with host, path, rule and verdict columns; the rows stay as they are.

    A rule (host, path, verdict) fits its host and all subdomains when the
    url's path starts with the rule's path; the longest rule (host and path
    together) wins, then the longer host; of equal rules, ``block``. No rule:
    null, and ``default``. Null or malformed urls have empty host and path and
    match only a rule with an empty host (none, normally). Repeated rows each
    get their verdict; extra columns pass through, except that columns named
    host, path, rule or verdict are replaced. Rules with a null host or path
    are ignored; an empty rule table gives the default everywhere.
    """
    spark = urls.sparkSession
    stage = Stage(spark, "url-filter")
    host, path = split_url(F.col(url))
    h_col, p_col, r_col, v_col = fresh(urls, "url_host", "url_path", "url_rule", "url_verdict")
    pages = urls.withColumn(h_col, host).withColumn(p_col, path)

    # one row per rule: its host, the part of its path up to the last slash, the whole path
    r = rules.filter("host is not null and path is not null").select(
        lower_ascii(F.col("host")).alias("r_host"), F.col("path").alias("r_path"), F.col("verdict").alias("r_verdict")
    )
    r = r.groupBy("r_host", "r_path").agg(F.max("r_verdict").alias("r_verdict"))  # "block" > "allow"
    stem = F.regexp_extract("r_path", r"(?s)^(.*/)?", 0)
    r = r.withColumn("digest", F.sha2(F.concat_ws("\n", "r_host", stem), 256)).withColumn(
        "short", F.substring("digest", 1, SHORT)
    )
    # what lengths the rules have: one row, two short arrays
    shape = r.agg(
        F.collect_set(_labels(F.col("r_host"))).alias("labels"),
        F.collect_set(_slashes(stem)).alias("slashes"),
    ).first()
    labels, slashes = sorted(shape["labels"]), sorted(shape["slashes"])

    # expand each distinct (host, path) once: a hot url is aggregated before the shuffle
    ways = pages.select(F.col(h_col).alias("host"), F.col(p_col).alias("path")).distinct()
    n = _labels(F.col("host"))
    hosts = F.array(*[F.when(n >= k, F.substring_index("host", ".", -k)) for k in labels])
    depth = _slashes(F.col("path"))
    stems = F.array(
        *[
            F.when(F.lit(k) == 0, F.lit("")).otherwise(F.when(depth >= k, F.concat(F.substring_index("path", "/", k), F.lit("/"))))
            for k in slashes
        ]
    )
    keys = ways.select("host", "path", F.explode(hosts).alias("h") if labels else F.lit(None).cast("string").alias("h"))
    keys = keys.filter("h is not null").select(
        "host", "path", "h", F.explode(stems).alias("p") if slashes else F.lit(None).cast("string").alias("p")
    )
    keys = keys.filter("p is not null").withColumn("k_digest", F.sha2(F.concat_ws("\n", "h", "p"), 256))
    keys = keys.withColumn("k_short", F.substring("k_digest", 1, SHORT))
    hits = keys.join(r, F.col("k_short") == F.col("short")).filter(
        (F.col("k_digest") == F.col("digest")) & F.col("path").startswith(F.col("r_path"))
    )
    rank = F.struct(
        (F.length("r_host") + F.length("r_path")).alias("len"),
        F.length("r_host").alias("host_len"),
        F.concat("r_host", "r_path").alias("rule"),
        F.col("r_verdict").alias("verdict"),
    )
    best = hits.groupBy("host", "path").agg(F.max(rank).alias("best"))
    best = stage.table(best.select(F.col("host").alias(h_col), F.col("path").alias(p_col), F.col("best.rule").alias(r_col), F.col("best.verdict").alias(v_col)))
    kept = [c for c in urls.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    return pages.join(best, [h_col, p_col], "left").select(
        *[F.col(f"`{c}`") for c in kept],
        F.col(h_col).alias("host"),
        F.col(p_col).alias("path"),
        F.col(r_col).alias("rule"),
        F.coalesce(v_col, F.lit(default)).alias("verdict"),
    )
