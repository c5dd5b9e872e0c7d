"""Query-corpus sources: dashboard documents and rule files (SRC-4, SRC-5, PF-3, PF-4).

``documents_json(path STRING, json STRING)`` — one dashboard document per row.
Each document is small; the walk is a per-row Python UDTF (Arrow batches), so Spark
partitions the documents across executors. A JVM-only variant for the common
two-level layout (panels -> rows -> panels) is provided too.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from ..functions.plan import with_columns_once

TARGET_SCHEMA = "panel_id bigint, ds_type string, ds_uid string, ref string, expr string, query string"
_TARGET = "struct<panel_id:bigint,ds_type:string,ds_uid:string,ref:string,expr:string,query:string>"


def _walk_targets(doc: str | None):
    """Visit every object at any depth; for each object with a ``datasource``, one row per entry of its
    ``targets`` (or one row with NULL target fields when it has none). Invalid JSON gives nothing."""
    if doc is None:
        return
    try:
        root = json.loads(doc)
    except ValueError:
        return
    stack = [root]
    while stack:
        o = stack.pop()
        if isinstance(o, dict):
            ds = o.get("datasource")
            if isinstance(ds, dict):
                pid = o.get("id")
                pid = pid if isinstance(pid, int) and not isinstance(pid, bool) else None
                dtype, duid = _s(ds.get("type")), _s(ds.get("uid"))
                targets = [t for t in (o.get("targets") or []) if isinstance(t, dict)] \
                    if isinstance(o.get("targets"), list) else []
                for t in targets or [{}]:
                    yield pid, dtype, duid, _s(t.get("refId")), _s(t.get("expr")), _s(t.get("query"))
            stack.extend(o.values())
        elif isinstance(o, list):
            stack.extend(o)


@udtf(returnType=TARGET_SCHEMA, useArrow=True)
class DashboardWalk:
    """Targets of one document at any depth."""

    def eval(self, doc: str):
        yield from _walk_targets(doc)


def _walk_udf(walk, kind: str):
    """A column function: the rows that ``walk`` finds in a document, as an array (NULL for NULL). Documents
    go to Python in Arrow batches; NULL stands for those that need no walk."""
    import pyarrow as pa

    names = [f.split(":")[0].split("<")[-1] for f in kind.split(",")]
    types = [pa.int64() if f.rstrip(">").endswith(":bigint") else pa.string() for f in kind.split(",")]
    arrow_type = pa.list_(pa.struct(list(zip(names, types))))

    def found(docs):
        return pa.array([None if d is None else list(walk(d)) for d in docs.to_pylist()], arrow_type)

    found.__annotations__ = {"docs": pa.Array, "return": pa.Array}
    return F.arrow_udf(found, f"array<{kind}>")


def _s(v):
    return v if isinstance(v, str) else None


def dashboard_targets_any_depth(docs: DataFrame, path: str = "path", text: str = "json") -> DataFrame:
    """SRC-4 (any depth) through the Python walk only."""
    from ..session import let_workers_import

    let_workers_import(docs.sparkSession)
    return docs.select(path, text).lateralJoin(DashboardWalk(F.col(text).outer())).drop(text)


_DS = "struct<type:string,uid:string>"
_TG = "array<struct<refId:string,expr:string,query:string>>"
_PANEL = f"struct<id:bigint,type:string,datasource:{_DS},targets:{_TG}>"
_TOP = f"array<struct<id:bigint,type:string,datasource:{_DS},targets:{_TG},panels:array<{_PANEL}>>>"
DOC_SCHEMA = f"struct<title:string,panels:{_TOP}>"


def _parse_2level(docs: DataFrame, path: str, text: str) -> DataFrame:
    """Parse with the two-level schema and check that it explains every ``"datasource"`` key
    of the text: ``covered`` is true when the number of panels with a datasource found by
    the schema equals the number of ``"datasource"`` keys in the document."""
    docs = with_columns_once(docs.select(path, text), {"d": F.from_json(F.col(text), DOC_SCHEMA)})
    d = F.col("d")
    found = F.coalesce(F.aggregate(
        d["panels"], F.lit(0),
        lambda acc, p: acc + F.when(p["datasource"].isNotNull(), 1).otherwise(0)
        + F.when(p["panels"].isNull(), 0).otherwise(F.size(F.filter(p["panels"], lambda q: q["datasource"].isNotNull())))),
        F.lit(0))
    keys = F.size(F.split(F.col(text), '"datasource"', -1)) - 1
    return with_columns_once(docs, {"covered": d.isNotNull() & (found == keys)})


def document_rows(docs: DataFrame, path: str = "path", text: str = "json") -> DataFrame:
    """(path, valid, found, panel_id, ds_type, ds_uid, ref, expr, query): a row for each target (see
    ``dashboard_targets``), and one with ``found`` false for a document without any.

    Every document is read and parsed once: documents fully explained by the common two-level layout
    give their targets as an array in the JVM; only the others (deeper nesting, datasources
    elsewhere, invalid JSON) take the per-document Python walk. Both give the same rows."""
    from ..functions.names import json_valid
    from ..session import let_workers_import

    let_workers_import(docs.sparkSession)
    p = _parse_2level(docs, path, text)
    walk = _walk_udf(lambda doc: (dict(zip(names, row)) for row in _walk_targets(doc)), _TARGET)
    names = [f.split()[0] for f in TARGET_SCHEMA.split(", ")]
    none = F.lit(None).cast(_TARGET)
    p = with_columns_once(p, {"walked": walk(F.when(~F.col("covered"), F.col(text)))})
    rows = F.when(F.col("covered"), _targets_2level(F.col("d"))).otherwise(F.col("walked"))
    rows = F.when(F.size(rows) > 0, rows).otherwise(F.array(none))
    x = p.select(path, json_valid(F.col(text)).alias("valid"), F.explode(rows).alias("t"))
    return x.select(path, "valid", F.col("t").isNotNull().alias("found"), *[F.col(f"t.{n}").alias(n) for n in names])


def dashboard_targets(docs: DataFrame, path: str = "path", text: str = "json") -> DataFrame:
    """SRC-4: (path, panel_id, ds_type, ds_uid, ref, expr, query) for every object at any depth
    that has a datasource."""
    return document_rows(docs, path, text).filter("found").drop("valid", "found")


def _targets_2level(d: Column) -> Column:
    """Targets of a parsed document as an array; a panel without targets gives one without query."""
    def slim(panels):
        return F.transform(F.coalesce(panels, F.array().cast(f"array<{_PANEL}>")), lambda p: F.struct(
            p["id"].alias("id"), p["datasource"].alias("ds"), p["targets"].alias("targets")))
    nested = F.flatten(F.transform(F.coalesce(d["panels"], F.array().cast(_TOP)), lambda p: slim(p["panels"])))
    top = F.transform(F.coalesce(d["panels"], F.array().cast(_TOP)), lambda p: F.struct(
        p["id"].alias("id"), p["datasource"].alias("ds"), p["targets"].alias("targets")))

    def rows(p):
        ts = F.when(F.size(p["targets"]) > 0, p["targets"]).otherwise(F.array(F.lit(None).cast(_TG[6:-1])))
        return F.transform(ts, lambda t: F.struct(
            p["id"].alias("panel_id"), p["ds"]["type"].alias("ds_type"), p["ds"]["uid"].alias("ds_uid"),
            t["refId"].alias("ref"), t["expr"].alias("expr"), t["query"].alias("query")))
    return F.flatten(F.transform(F.filter(F.concat(top, nested), lambda p: p["ds"].isNotNull()), rows))


# Datasource kinds and the query language / field each one uses.
DATASOURCES = {"prometheus": ("promql", "expr"), "loki": ("logql", "expr"), "tempo": ("traceql", "query")}


def route_targets(targets: DataFrame) -> DataFrame:
    """PF-4: language by datasource type **or** uid; text from ``expr`` or ``query`` by language."""
    lang: Column = F.lit(None).cast("string")
    text: Column = F.lit(None).cast("string")
    for ds, (lg, field) in reversed(list(DATASOURCES.items())):
        hit = (F.col("ds_type") == ds) | (F.col("ds_uid") == ds)
        lang = F.when(hit, F.lit(lg)).otherwise(lang)
        text = F.when(hit, F.col(field)).otherwise(text)
    return targets.withColumn("lang", lang).withColumn("text", text)


def non_empty(df: DataFrame, col: str) -> DataFrame:
    """PF-3: present and non-empty."""
    return df.filter(F.col(col).isNotNull() & (F.col(col) != ""))


def strip_comments(lines: DataFrame, col: str = "line") -> DataFrame:
    """PF-7: drop blank lines and ``#`` comments."""
    return lines.filter(~F.col(col).rlike(r"^\s*(#.*)?$"))


_RULE = ("struct<alert:string,record:string,expr:string,for:string,labels:map<string,string>,"
         "annotations:map<string,string>>")
_GROUPS = f"groups:array<struct<name:string,rules:array<{_RULE}>>>"
RULE_SCHEMA = f"struct<{_GROUPS},spec:struct<{_GROUPS}>>"


def _walk_rules(doc: str):
    """Visit every object at any depth; for each object with an ``expr``, the ``name`` of the object that
    holds it (directly or in a list) and the object as JSON. Invalid JSON gives nothing."""
    try:
        stack = [(json.loads(doc), None)]
    except ValueError:
        return
    while stack:
        o, grp = stack.pop()
        if isinstance(o, dict):
            if o.get("expr") is not None:
                yield {"grp": grp, "rule": json.dumps(o)}
            stack.extend((v, _s(o.get("name"))) for v in o.values())
        elif isinstance(o, list):
            stack.extend((v, grp) for v in o)


def load_rules(files: DataFrame, path: str = "path", text: str = "json") -> DataFrame:
    """SRC-5: every object with an ``expr``, at any depth, from rule documents (JSON form of the
    rule YAML). -> (path, grp, alert, expr, for_ns, severity, annotations).

    Documents whose ``"expr"`` keys are all rules of ``groups`` or ``spec.groups`` are exploded in the
    JVM; only the others take the per-document Python walk. Both give the same rows for the same document."""
    from ..functions.time import duration_ns_col
    from ..session import let_workers_import

    let_workers_import(files.sparkSession)
    none = F.array().cast(f"array<struct<name:string,rules:array<{_RULE}>>>")
    d = with_columns_once(files.select(path, text), {"d": F.from_json(F.col(text), RULE_SCHEMA)})
    d = with_columns_once(d, {"gs": F.concat(F.coalesce("d.groups", none), F.coalesce("d.spec.groups", none))})
    found = F.aggregate("gs", F.lit(0), lambda n, g: n + F.when(g["rules"].isNull(), 0).otherwise(
        F.size(F.filter(g["rules"], lambda r: r["expr"].isNotNull()))))
    keys = F.size(F.split(F.col(text), '"expr"', -1)) - 1
    d = with_columns_once(d, {"covered": F.coalesce(found == keys, F.lit(False))})
    walk = _walk_udf(_walk_rules, "struct<grp:string,rule:string>")
    d = with_columns_once(d, {"walked": walk(F.when(~F.col("covered"), F.col(text)))})
    pair = f"array<struct<grp:string,r:{_RULE}>>"
    fast = F.flatten(F.transform("gs", lambda g: F.transform(
        F.coalesce(g["rules"], F.array().cast(f"array<{_RULE}>")), lambda x: F.struct(g["name"].alias("grp"), x.alias("r")))))
    slow = F.transform("walked", lambda x: F.struct(x["grp"].alias("grp"), F.from_json(x["rule"], _RULE).alias("r")))
    r = d.select(path, F.inline(F.when(F.col("covered"), fast.cast(pair)).otherwise(slow.cast(pair))))
    return r.filter(F.col("r.expr").isNotNull()).select(
        path, "grp", F.coalesce(F.col("r.alert"), F.col("r.record")).alias("alert"), F.col("r.expr").alias("expr"),
        F.when(F.col("r.for").isNull(), 0).otherwise(duration_ns_col(F.col("r.for"))).alias("for_ns"),
        F.col("r.labels")["severity"].alias("severity"), F.col("r.annotations").alias("annotations"))
