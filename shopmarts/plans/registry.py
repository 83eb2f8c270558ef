"""The registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query reads the driver tables of ``sf_dir`` (through the adapters) in full.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as _F

from shopmarts.functions import presentation as P
from shopmarts.operators import distincts as D
from shopmarts.operators import evalstats as E
from shopmarts.operators import layout as LY
from shopmarts.operators import overlaps as OV
from shopmarts.operators import pivots as PV
from shopmarts.operators import quality as V
from shopmarts.operators import questions as Q
from shopmarts.operators import retrieval as R
from shopmarts.plans import pipeline as PL
from shopmarts.plans import refresh as RF
from shopmarts.plans.shop import Shop
from shopmarts.session import default_parallelism, shared_path
from shopmarts.sources import adapters as A
from shopmarts.sources import csvranges, files
from shopmarts.sources.tables import DriverTables
from shopmarts.streaming import access as AC
from shopmarts.streaming import monitor as M

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _shop(spark: SparkSession, sf_dir: str) -> Shop:
    return Shop(spark, sf_dir)


# ---------------------------------------------------------------- bronze (CSV ingest)
def _csv_roundtrip(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Raw shape -> header CSV in the shared folder -> explicit-schema CSV scan."""
    df = _shop(spark, sf_dir).raw[table]
    path = shared_path(spark, "raw_csv", table, unique=True)
    files.write_csv(df, path)
    return files.read_csv(spark, path, df.schema)


def _bronze(table: str) -> Query:
    return lambda spark, sf_dir: _csv_roundtrip(spark, sf_dir, table)


for _t in ("users", "products", "orders", "order_items", "sessions", "access_logs"):
    QUERIES[f"bronze_{_t}"] = _bronze(_t)
    QUERIES[f"silver_{_t}"] = (lambda t: lambda spark, sf_dir: _shop(spark, sf_dir).silver[t])(_t)

register("csv_roundtrip")(_bronze("access_logs"))


@register("csv_range_scan")
def _csv_range_scan(spark, sf_dir):
    """Raw orders with quoted line breaks -> CSV files -> scan by byte ranges."""
    df = A.with_line_breaks(_shop(spark, sf_dir).raw["orders"])
    path = shared_path(spark, "raw_csv", "orders", unique=True)
    files.write_csv(df, path)
    return csvranges.read_csv_ranges(spark, path, df.schema)

# ---------------------------------------------------------------- marts
for _m in ("monthly_sales", "rfm_base", "rfm_scores", "customer_rfm", "cart_abandonment",
           "access_summary", "threat_events", "risk_counters", "user_risk"):
    QUERIES[_m] = (lambda m: lambda spark, sf_dir: getattr(_shop(spark, sf_dir), m)())(_m)

# ---------------------------------------------------------------- business questions


def _q(fn):
    def deco(name):
        QUERIES[name] = lambda spark, sf_dir: fn(_shop(spark, sf_dir))
    return deco


_q(lambda s: Q.category_sales_trend(s.monthly_sales()))("category_sales_trend")
_q(lambda s: Q.churn_risk_by_age_group(s.customer_rfm()))("churn_risk_by_age_group")
_q(lambda s: Q.abandonment_by_category(s.cart_abandonment()))("abandonment_by_category")
_q(lambda s: Q.threat_trend_since(s.threat_events()))("threat_trend_since")
_q(lambda s: Q.top_risk_users(s.user_risk()))("top_risk_users")
_q(lambda s: Q.late_night_suspicious(s.access_summary()))("late_night_suspicious")
_q(lambda s: Q.silent_churn(s.customer_rfm()))("silent_churn")
_q(lambda s: Q.gold_members(s.customer_rfm()))("gold_members")
_q(lambda s: Q.top_categories_last_month(s.monthly_sales()))("top_categories_last_month")
_q(lambda s: Q.top_categories_by_month(s.monthly_sales()))("top_categories_by_month")
_q(lambda s: Q.recent_threat_types(s.threat_events()))("recent_threat_types")
_q(lambda s: Q.customer_360(s.silver["users"], s.rfm_scores(), s.risk_scores()))("customer_360")
_q(lambda s: Q.response_decision(
    Q.customer_360(s.silver["users"], s.rfm_scores(), s.risk_scores())))("response_decision")
_q(lambda s: Q.relief_candidates(s.customer_rfm(), s.silver["orders"], s.risk_scores()))(
    "relief_candidates")
_q(lambda s: P.presented_sales(s.monthly_sales()))("presented_sales")
_q(lambda s: P.presented_risk(s.user_risk()))("presented_risk")
_q(lambda s: P.presented_threats(s.access_summary()))("presented_threats")

# ---------------------------------------------------------------- data quality



def _checked(fn):
    """A check over the raw shapes with faults that follow from their keys."""
    def deco(name):
        QUERIES[name] = lambda spark, sf_dir: fn(A.with_faults(_shop(spark, sf_dir).raw))
    return deco


_checked(lambda r: V.item_subtotal(r["order_items"]))("dq_item_subtotal")
_checked(lambda r: V.order_total(r["orders"], r["order_items"]))("dq_order_total")
_checked(lambda r: V.orphans(r["order_items"], r["orders"], r["products"]))("dq_orphans")
_checked(lambda r: V.category_match(r["order_items"], r["orders"], r["products"]))(
    "dq_category_match")
_checked(V.duplicate_keys)("dq_duplicate_keys")
_q(lambda s: V.domains(s.raw))("dq_domains")
_q(lambda s: V.bot_orders(s.silver["orders"], s.silver["access_logs"]))("dq_bot_orders")
_checked(V.rejects)("dq_rejects")

# ---------------------------------------------------------------- sinks, pipeline, catalog


def _fresh_database() -> str:
    return f"shopmarts_{uuid.uuid4().hex[:10]}"


@register("medallion_row_counts")
def _medallion_row_counts(spark, sf_dir):
    """Whole CSV-free pipeline on the driver tables: 18 tables, counts observed."""
    return PL.run_pipeline(spark, _shop(spark, sf_dir).raw, _fresh_database())


def _refreshed(mart: str) -> Query:
    """The facts in two batches, all months up to 2025-06 and then the later ones and
    some late rows of earlier months; the mart after the second."""
    late = {"orders": "order_date > '2025-06' or order_id % 50 = 0",
            "sessions": "session_date > '2025-06' or session_id % 50 = 0",
            "access_logs": "timestamp > '2025-06' or access_id % 50 = 0"}

    def run(spark, sf_dir):
        shop, kept = _shop(spark, sf_dir), RF.MonthlyMarts(spark)
        facts = {"customer_rfm": "orders", "user_risk": "access_logs"}.get(mart) or RF.BY_MONTH[mart][0]
        rows, second = shop.raw[facts], _F.coalesce(_F.expr(late[facts]), _F.lit(True))
        kept.add({facts: rows.filter(~second)}, "first")
        kept.add({facts: rows.filter(second)}, "second")
        return kept.mart(mart, shop.silver["users"])
    return run


for _m in ("monthly_sales", "customer_rfm", "cart_abandonment", "access_summary", "threat_events",
           "user_risk"):
    QUERIES[f"refreshed_{_m}"] = _refreshed(_m)


@register("table_roundtrip")
def _table_roundtrip(spark, sf_dir):
    """Mart -> parquet table in the shared folder -> named-table scan."""
    db = _fresh_database()
    PL.create_database(spark, db, shared_path(spark, "warehouse", db))
    files.save_table(_shop(spark, sf_dir).user_risk(), f"{db}.gold_user_risk",
                     path=shared_path(spark, "warehouse", db, "gold_user_risk"))
    return spark.table(f"{db}.gold_user_risk")


@register("schema_evolution_overwrite")
def _schema_evolution_overwrite(spark, sf_dir):
    """Overwrite a table with a different schema: the new schema replaces the old."""
    db = _fresh_database()
    path = shared_path(spark, "warehouse", db, "gold_monthly_sales")
    PL.create_database(spark, db, shared_path(spark, "warehouse", db))
    ms = _shop(spark, sf_dir).monthly_sales()
    files.save_table(ms.select("ym", "category", "order_count"), f"{db}.gold_monthly_sales",
                     path=path)
    files.save_table(ms, f"{db}.gold_monthly_sales", path=path)
    return spark.table(f"{db}.gold_monthly_sales")


# ---------------------------------------------------------------- retrieval


def _t(spark, sf_dir) -> DriverTables:
    return DriverTables(spark, sf_dir)


register("passages")(lambda spark, sf_dir: R.passages(_t(spark, sf_dir).documents))
register("lexical_topk")(lambda spark, sf_dir: R.lexical_topk_with_source(
    _t(spark, sf_dir).documents, _t(spark, sf_dir).benchmark, k=5))
register("vector_topk")(lambda spark, sf_dir: R.centroid_topk(_t(spark, sf_dir).embeddings, k=10))

register("vector_index_topk")(lambda spark, sf_dir: PV.centroid_topk(_t(spark, sf_dir).embeddings, k=10))


@register("clustered_access_logs")
def _clustered_access_logs(spark, sf_dir):
    """Access logs written clustered by day and user, so that predicates on either
    skip files, and read back."""
    logs = _shop(spark, sf_dir).silver["access_logs"]
    return LY.rewritten(logs, {"day": _F.unix_date("access_date"), "user": _F.col("user_id")})

# ---------------------------------------------------------------- mergeable distinct counts


@register("distinct_rollups")
def _distinct_rollups(spark, sf_dir):
    """Distinct users and sources at four levels from one written bitmap state."""
    state = files.written(D.access_state(_shop(spark, sf_dir).silver["access_logs"]), "access_state")
    return D.access_rollups(state)


# ---------------------------------------------------------------- evaluation statistics


def _spans(spark, sf_dir):
    return A.spans(_t(spark, sf_dir).conversations)


def _verdicts(spark, sf_dir):
    t = _t(spark, sf_dir)
    return A.verdicts(t.documents, t.labels)


register("pass_rate")(lambda spark, sf_dir: E.pass_rate(_verdicts(spark, sf_dir)))
register("run_comparison")(lambda spark, sf_dir: E.run_comparison(_verdicts(spark, sf_dir)))
register("latency_profile")(lambda spark, sf_dir: E.latency_profile(_spans(spark, sf_dir)))
register("trace_call_profile")(lambda spark, sf_dir: E.trace_call_profile(_spans(spark, sf_dir)))


register("trace_depth_time")(lambda spark, sf_dir: OV.overlap_depths(_spans(spark, sf_dir)))
register("agent_depth_time")(lambda spark, sf_dir: OV.overlap_depths(_spans(spark, sf_dir), "agent"))
register("trace_parallelism")(lambda spark, sf_dir: OV.parallelism(
    OV.overlap_depths(_spans(spark, sf_dir))))


@register("evaluation_dataset")
def _evaluation_dataset(spark, sf_dir):
    """Documents that answered a benchmark question (lexical top-k), with labels."""
    t = _t(spark, sf_dir)
    traces = t.documents.select(_F.col("doc_id").alias("trace_id"), "lang", "source", "n_chars")
    chosen = R.lexical_topk(t.documents, t.benchmark, k=5).select(
        _F.col("doc_id").alias("trace_id"))
    labels = t.labels.select(_F.col("doc_id").alias("trace_id"), "quality", "toxic")
    return E.evaluation_dataset(traces, chosen, labels)

# ---------------------------------------------------------------- streaming


@register("pass_rate_stream")
def _pass_rate_stream(spark, sf_dir):
    """Verdicts land as files in the shared folder; the streaming monitor
    consumes all of them in micro-batches and publishes per-judge pass rates."""
    base = shared_path(spark, "stream", unique=True)
    _verdicts(spark, sf_dir).write.parquet(f"{base}/in")
    out = M.run_until_caught_up(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt",
                                files_per_trigger=max(1, default_parallelism(spark)))
    # one-shot run: the landed files and the stream's state are not needed any more
    from shopmarts.session import remove_path
    for part in ("in", "ckpt"):
        remove_path(spark, f"{base}/{part}")
    return out


def _access_stream(spark, sf_dir) -> AC.AccessStream:
    """All access logs land in two parts, the second with a tenth of the first again;
    the stream takes them in micro-batches.  The delay spans the whole log, whose
    events are in no order of time."""
    logs = _shop(spark, sf_dir).raw["access_logs"]
    base = shared_path(spark, "access_stream", unique=True)
    key = _F.pmod(_F.xxhash64("access_id"), _F.lit(10))
    logs.filter(key < 5).write.parquet(f"{base}/in/part=1")
    logs.filter((key >= 5) | (key == 0)).write.parquet(f"{base}/in/part=2")
    stream = AC.AccessStream(spark, f"{base}/in/part=*", logs.schema, base, delay="36500 days",
                             files_per_trigger=max(1, default_parallelism(spark)))
    stream.catch_up()
    return stream


register("access_summary_stream")(lambda spark, sf_dir: _access_stream(spark, sf_dir).access_summary())
register("threat_events_stream")(lambda spark, sf_dir: _access_stream(spark, sf_dir).threat_events())


@register("customer_360_colocated")
def _customer_360_colocated(spark, sf_dir):
    """Q11 over pipeline tables bucketed by user id: the joins read co-located
    buckets instead of shuffling the user dimension and both marts."""
    db = _fresh_database()
    # as many buckets as a shuffle of the session would have partitions
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    PL.run_pipeline(spark, _shop(spark, sf_dir).raw, db, comments=False, user_buckets=buckets)
    return PL.customer_360_from_tables(spark, db)
_q(lambda s: P.presented_threat_events(s.threat_events()))("presented_threat_events")
