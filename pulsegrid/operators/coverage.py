"""Coverage checks: required vs. provided names and labels (JN-1..7, ST-1..3, AG-8/9/14).

Findings have the schema ``(check STRING, subject STRING, status STRING, detail STRING)``.

Joins are written as plain equi / semi / anti joins: Catalyst + AQE broadcast the side that
is small at run time (``autoBroadcastJoinThreshold`` is the size check) and fall back to a
shuffle join beyond it. Only literal tables of fixed size are broadcast explicitly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import strip_histogram_suffix
from ..functions.plan import settled, with_columns_once

FINDING_COLS = ["check", "subject", "status", "detail"]

# Status precedence of a verdict (FAIL > WARN > PASS > SKIP).
STATUS_RANK = {"SKIP": 0, "PASS": 1, "WARN": 2, "FAIL": 3}

# Infrastructure metric prefixes excluded from payload coverage.
INFRA_METRIC_RE = r"^(traces_|process_cpu_seconds|process_resident_memory|up|scrape_)"


def finding(check: str, subject: Column, status: Column | str, detail: Column | str = "") -> list[Column]:
    st = F.lit(status) if isinstance(status, str) else status
    de = F.lit(detail) if isinstance(detail, str) else detail
    return [F.lit(check).alias("check"), subject.cast("string").alias("subject"), st.alias("status"),
            de.cast("string").alias("detail")]


def missing(required: DataFrame, provided: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """JN-1: required keys that no provided row has."""
    return required.join(provided, on, "left_anti")


def covered(required: DataFrame, provided: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """JN-2: required keys that some provided row has."""
    return required.join(provided, on, "left_semi")


def coverage_findings(check: str, required: DataFrame, provided: DataFrame, on: str) -> DataFrame:
    """JN-1 + JN-2 as findings in one pass: a left join with an existence flag."""
    flag = provided.select(on).distinct().withColumn("__hit", F.lit(True))
    j = required.select(on).distinct().join(flag, on, "left")
    status = F.when(F.col("__hit"), "PASS").otherwise("FAIL")
    detail = F.when(F.col("__hit"), "covered").otherwise("missing")
    return j.select(*finding(check, F.col(on), status, detail))


def map_names(names: DataFrame, mapping: DataFrame, name_col: str = "otel_name") -> DataFrame:
    """JN-3: mapped name, else dots -> underscores. ``mapping(otel_name, prom_name)``."""
    m = mapping.groupBy("otel_name").agg(F.min("prom_name").alias("mapped"))
    j = names.join(m, names[name_col] == m["otel_name"], "left").drop(m["otel_name"])
    return j.withColumn("prom_name", F.coalesce(F.col("mapped"), F.regexp_replace(F.col(name_col), r"\.", "_"))
                        ).drop("mapped")


def reverse_map(required: DataFrame, mapping: DataFrame, col: str = "prom_name") -> DataFrame:
    """JN-4: prom name -> the (first) otel name mapping to it, else 'unknown'."""
    rev = mapping.groupBy("prom_name").agg(F.min("otel_name").alias("otel_name"))
    j = required.join(rev, required[col] == rev["prom_name"], "left").drop(rev["prom_name"])
    return j.withColumn("otel_name", F.coalesce(F.col("otel_name"), F.lit("unknown")))


def label_coverage(labels: DataFrame, provided_keys: DataFrame, builtin_present: DataFrame,
                   mode: str = "equal") -> DataFrame:
    """JN-5: ``labels(label, source)`` with source ``resource:k`` / ``attribute:k`` /
    ``builtin:f`` / other; ``provided_keys(scope, key)``; ``builtin_present(field)``.

    One left join against the union of key tables; the status comes from a ``when`` chain.
    ``mode="substring"`` reproduces a substring search (a wanted key is covered when it
    occurs inside any provided key of its scope), through ``contains_join``: its keys are the
    texts, not the two or three scopes. An empty key is covered by nothing."""
    scope = F.split_part(F.col("source"), F.lit(":"), F.lit(1))
    key = F.regexp_extract(F.col("source"), r"^[^:]*:(.*)$", 1)
    lab = labels.select("label", "source", scope.alias("scope"), key.alias("key"))
    avail = (provided_keys.select("scope", "key")
             .unionByName(builtin_present.select(F.lit("builtin").alias("scope"), F.col("field").alias("key")))
             .distinct().withColumn("__hit", F.lit(True)))
    if mode == "substring":
        hay = avail.select(F.struct("scope", "key").alias("h"), F.col("key").alias("htext"))
        wanted = lab.filter(F.col("key") != "").select(F.struct("scope", "key").alias("n"), F.col("key").alias("ntext"))
        hit = (contains_join(hay, wanted.distinct(), "h", "htext", "n", "ntext")
               .filter(F.col("h.scope") == F.col("n.scope"))
               .select("n.scope", "n.key").distinct().withColumn("__hit", F.lit(True)))
        j = lab.join(hit, ["scope", "key"], "left")
    else:
        j = lab.join(avail, ["scope", "key"], "left")
    known = F.col("scope").isin("resource", "attribute", "builtin")
    status = F.when(~known, "WARN").when(F.col("__hit"), "PASS").otherwise("FAIL")
    detail = F.when(~known, F.lit("unknown source")).otherwise(F.concat_ws(".", F.col("scope"), F.col("key")))
    return j.select(*finding("log_label", F.col("label"), status, detail))


def classify_names(dynamic: DataFrame, known: DataFrame, provided: DataFrame,
                   infra_re: str = INFRA_METRIC_RE) -> DataFrame:
    """JN-7 waterfall: already known -> base of a provided histogram -> infrastructure ->
    provided -> else WARN. ``dynamic(name)``, ``known(name)``, ``provided(name)``."""
    kn = known.select("name").distinct().withColumn("is_known", F.lit(True))
    pv = provided.select("name").distinct().withColumn("is_provided", F.lit(True))
    pb = provided.select(F.col("name").alias("base")).distinct().withColumn("base_provided", F.lit(True))
    d = dynamic.select("name").distinct().withColumn("base", strip_histogram_suffix(F.col("name")))
    j = (d.join(kn, "name", "left").join(pv, "name", "left").join(pb, "base", "left"))
    cls = (F.when(F.col("is_known"), "known")
           .when((F.col("base") != F.col("name")) & F.col("base_provided"), "histogram_part")
           .when(F.col("name").rlike(infra_re), "infrastructure")
           .when(F.col("is_provided"), "provided")
           .otherwise("unverified"))
    return j.select("name", cls.alias("class"))


def name_findings(classes: DataFrame, check: str = "dynamic_metric") -> DataFrame:
    """JN-7 as findings: a name that no step of the waterfall explains is a WARN."""
    status = F.when(F.col("class") == "unverified", "WARN").otherwise("PASS")
    return classes.select(*finding(check, F.col("name"), status, F.col("class")))


def unknown(dynamic: DataFrame, known: DataFrame, on: str = "name") -> DataFrame:
    """ST-2: dynamic set minus known set (set semantics)."""
    return dynamic.select(on).distinct().join(known.select(on), on, "left_anti")


def or_default(df: DataFrame, defaults: DataFrame) -> DataFrame:
    """ST-3: ``df`` if it has any row, else ``defaults``.

    The emptiness probe is a one-row aggregate (never a scan of ``df``'s rows on the driver);
    it is broadcast-joined to the defaults, so no cross join with data."""
    probe = df.select(F.lit(1).alias("__k")).limit(1)
    keep_defaults = defaults.join(F.broadcast(probe), how="left_anti")
    return df.unionByName(keep_defaults)


def union_findings(*dfs: DataFrame) -> DataFrame:
    """ST-1."""
    out = dfs[0].select(*FINDING_COLS)
    for d in dfs[1:]:
        out = out.unionByName(d.select(*FINDING_COLS))
    return out


def tally(findings: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """AG-8: counts per status and total."""
    return findings.groupBy(*by).agg(
        F.count_if(F.col("status") == "PASS").alias("pass"),
        F.count_if(F.col("status") == "FAIL").alias("fail"),
        F.count_if(F.col("status") == "WARN").alias("warn"),
        F.count_if(F.col("status") == "SKIP").alias("skip"),
        F.count(F.lit(1)).alias("total"))


def verdict(findings: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """AG-9: FAIL if any FAIL, else WARN if any WARN, else PASS."""
    rank = F.create_map(*[x for k, v in STATUS_RANK.items() for x in (F.lit(k), F.lit(v))])
    inv = F.create_map(*[x for k, v in STATUS_RANK.items() for x in (F.lit(v), F.lit(k))])
    r = findings.groupBy(*by).agg(F.max(rank[F.col("status")]).alias("r"))
    return r.select(*by, inv[F.greatest(F.col("r"), F.lit(STATUS_RANK["PASS"]))].alias("verdict"))


def per_subject(subjects: DataFrame, violations: DataFrame, check: str, on: str = "subject") -> DataFrame:
    """AG-14: PASS for a subject without violations, else one FAIL per violating item."""
    j = subjects.select(on).distinct().join(violations.select(on, "item"), on, "left")
    status = F.when(F.col("item").isNull(), "PASS").otherwise("FAIL")
    return j.select(*finding(check, F.col(on), status, F.coalesce(F.col("item"), F.lit(""))))


# ---------------------------------------------------------------- JN-6 substring containment

def _tokens(c: Column) -> Column:
    return F.split(F.trim(c), r"\s+")


def contains_join(hay: DataFrame, needles: DataFrame, hay_id: str, hay_text: str,
                  needle_id: str, needle_text: str, n: int = 8) -> DataFrame:
    """JN-6: all pairs (hay_id, needle_id) where the needle text occurs in the hay text.

    Every needle takes an equi-join for its candidates; ``contains`` verifies each one, so the
    result is exact and no needle is broadcast, capped or dropped.

    * Needles of k >= 3 tokens: their middle tokens 2..k-1 must appear in the hay as whole,
      consecutive tokens (the first and last may be glued to neighbouring text). All their runs of
      min(k-2, n) tokens are hashed; the distinct token grams of each hay text that any needle holds
      (all lengths in one pass) form an inverted index. Each needle takes the list of its rarest
      run: phrases that open with common words do not pull in every text with that opening.
    * Needles of 1-2 tokens: their longer token is a substring of one hay token. The key is
      every substring of the distinct hay vocabulary with a length some anchor has; the
      matching vocabulary is mapped back to the documents that use it.

    Which lengths occur is a scalar subquery of the same job, so the plan does not depend on the needles.
    """
    nd = needles.select(F.col(needle_id).alias("nid"), F.col(needle_text).alias("ntext"))
    nd = nd.withColumn("ntok", _tokens(F.col("ntext")))
    hy = hay.select(F.col(hay_id).alias("hid"), F.col(hay_text).alias("htext"))

    # ---- k >= 3: middle-gram hashes, every place of a needle
    glen = F.least(F.size("ntok") - F.lit(2), F.lit(n))
    mid = nd.filter(F.size("ntok") >= 3).select("nid", glen.alias("L"), F.inline(F.transform(
        F.sequence(F.lit(2), F.size("ntok") - glen),
        lambda i: F.struct(i.alias("place"), F.xxhash64(
            glen, F.transform(F.slice("ntok", i, glen), lambda w: F.xxhash64(w))).alias("h")))))
    th = with_columns_once(hy.select("hid", "htext"), {
        "th": F.transform(_tokens(F.col("htext")), lambda w: F.xxhash64(w)),
        "lens": F.coalesce(mid.agg(F.collect_set("L")).scalar(), F.array().cast("array<int>"))})
    grams = F.array_distinct(F.flatten(F.transform(
        F.filter("lens", lambda L: F.size("th") >= L),
        lambda L: F.transform(F.sequence(F.lit(1), F.size("th") - L + 1),
                              lambda i: F.xxhash64(L, F.slice("th", i, L))))))  # longs: distinct by hashing
    # the inverted index of the grams any needle holds, written once: its counts choose each needle's
    # rarest gram, and that gram's list is the needle's candidates
    index = settled(th.select("hid", F.explode(grams).alias("h")).join(mid.select("h").distinct(), "h", "left_semi"))
    df = index.groupBy("h").agg(F.count(F.lit(1)).alias("df"))
    rarest = (mid.join(df, "h").groupBy("nid").agg(F.min_by("h", F.col("df") * 65536 + F.least("place", F.lit(65535))).alias("h"),
                                                   F.count(F.lit(1)).alias("found"), F.min("L").alias("L"))
              .join(mid.groupBy("nid").agg(F.count(F.lit(1)).alias("places")), "nid")
              .filter("found = places").select("nid", "h"))  # a gram that no text has: no match
    cand = index.join(rarest, "h").select("hid", "nid")

    # ---- k <= 2: substrings of the vocabulary
    t0, t1 = F.get(F.col("ntok"), 0), F.get(F.col("ntok"), 1)
    anchor = F.when(F.size("ntok") == 1, t0).when(F.length(t1) > F.length(t0), t1).otherwise(t0)
    short = nd.filter(F.size("ntok") <= 2).select("nid", anchor.alias("sub"))
    alens = F.coalesce(short.agg(F.collect_set(F.length("sub"))).scalar(), F.array().cast("array<int>"))
    vocab = hy.withColumn("any", F.size(alens) > 0).filter("any").select(
        "hid", F.explode(F.array_distinct(_tokens(F.col("htext")))).alias("tok"))
    words = with_columns_once(vocab.select("tok").distinct(), {"lens": alens})
    subs = words.select("tok", F.explode(F.array_distinct(F.flatten(F.transform(
        F.filter("lens", lambda k: F.length("tok") >= k),
        lambda k: F.transform(F.sequence(F.lit(1), F.length("tok") - k + 1),
                              lambda i: F.substring(F.col("tok"), i, k)))))).alias("sub"))
    hit = subs.join(short, "sub").select("tok", "nid").distinct()
    cand = cand.unionByName(vocab.join(hit, "tok").select("hid", "nid"))
    cand = cand.distinct()
    pairs = (cand.join(hy, "hid").join(nd.select("nid", "ntext"), "nid")
             .filter(F.contains(F.col("htext"), F.col("ntext"))).select("hid", "nid"))
    return pairs.select(F.col("hid").alias(hay_id), F.col("nid").alias(needle_id))


def probe(samples: DataFrame, catalog: DataFrame) -> DataFrame:
    """AG-10: per catalogued selector (here: a metric name) the number of series and the
    first sample value; PASS when non-empty. One pass over the samples for all selectors:
    the per-query aggregate is partial, and Spark broadcasts the catalog where its size allows."""
    sel = samples.join(catalog.select("metric").distinct(), "metric")
    a = sel.groupBy("metric").agg(
        F.countDistinct("series_id").alias("n_series"),
        F.min_by("value", F.struct("series_id", "ts_ns", "value")).alias("first_value"))
    j = catalog.join(a, "metric", "left")
    n = F.coalesce(F.col("n_series"), F.lit(0)).cast("bigint")
    return j.select(F.col("metric").alias("query"), n.alias("n_series"), "first_value",
                    F.when(n > 0, "PASS").otherwise("FAIL").alias("status"))


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Small fixed table (e.g. a mapping that is part of the check's definition)."""
    return spark.createDataFrame(rows, schema)
