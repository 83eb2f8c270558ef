"""Command line: run the pipeline, ask the business questions, run queries.

  python -m shopmarts pipeline --src DIR --database DB [--driver] [--user-buckets N]
  python -m shopmarts ask QUESTION --database DB [--param k=v ...] [--out PATH] [--show N] [--explain]
  python -m shopmarts query NAME --sf DIR [--out PATH] [--show N] [--explain]
  python -m shopmarts list

``pipeline`` reads raw CSV files (``--driver``: a driver parquet folder) and
writes 18 tables plus comments into DB.  ``ask`` answers a question from the
written marts of DB.  Results are shown (first N rows) or written as parquet.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from shopmarts.functions import presentation as P
from shopmarts.operators import questions as Q
from shopmarts.plans import catalog as C


class Warehouse:
    """The written tables of one pipeline database."""

    def __init__(self, spark: SparkSession, database: str):
        self.spark, self.db = spark, database

    def silver(self, t: str) -> DataFrame:
        return self.spark.table(f"{self.db}.silver_{t}")

    def gold(self, m: str) -> DataFrame:
        return self.spark.table(f"{self.db}.gold_{m}")


def _c360(w: Warehouse, user_id=None) -> DataFrame:
    df = Q.customer_360(w.silver("users"), w.gold("customer_rfm"), w.gold("user_risk"))
    return df if user_id is None else df.filter(df.user_id == int(user_id))


QUESTIONS = {
    "category_sales_trend": lambda w, category=None: Q.category_sales_trend(
        w.gold("monthly_sales"), category),
    "churn_risk_by_age_group": lambda w: Q.churn_risk_by_age_group(w.gold("customer_rfm")),
    "abandonment_by_category": lambda w: Q.abandonment_by_category(w.gold("cart_abandonment")),
    "threat_trend_since": lambda w, since="2025-10": Q.threat_trend_since(
        w.gold("threat_events"), since),
    "top_risk_users": lambda w, k="10": Q.top_risk_users(w.gold("user_risk"), int(k)),
    "late_night_suspicious": lambda w: Q.late_night_suspicious(w.gold("access_summary")),
    "silent_churn": lambda w, days="90": Q.silent_churn(w.gold("customer_rfm"), int(days)),
    "gold_members": lambda w: Q.gold_members(w.gold("customer_rfm")),
    "top_categories_last_month": lambda w, k="3": Q.top_categories_last_month(
        w.gold("monthly_sales"), int(k)),
    "top_categories_by_month": lambda w: Q.top_categories_by_month(w.gold("monthly_sales")),
    "recent_threat_types": lambda w: Q.recent_threat_types(w.gold("threat_events")),
    "customer_360": _c360,
    "response_decision": lambda w, user_id=None: Q.response_decision(_c360(w, user_id)),
    "relief_candidates": lambda w: Q.relief_candidates(
        w.gold("customer_rfm"), w.silver("orders"), w.gold("user_risk")),
    "presented_sales": lambda w: P.presented_sales(w.gold("monthly_sales")),
    "presented_risk": lambda w: P.presented_risk(w.gold("user_risk")),
    "presented_threats": lambda w: P.presented_threats(w.gold("access_summary")),
    "presented_threat_events": lambda w: P.presented_threat_events(w.gold("threat_events")),
    "catalog_search": lambda w, term: C.search_catalog(C.table_catalog(w.spark, w.db), term),
}


def ask(spark: SparkSession, database: str, question: str, **params) -> DataFrame:
    return QUESTIONS[question](Warehouse(spark, database), **params)


def _emit(df: DataFrame, out: str | None, show: int, explain: bool = False) -> None:
    if explain:
        df.explain("formatted")
    elif out:
        df.write.mode("overwrite").parquet(out)
        print(f"written to {out}")
    else:
        df.show(show, truncate=False)


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="python -m shopmarts")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("pipeline")
    p.add_argument("--src", required=True)
    p.add_argument("--database", required=True)
    p.add_argument("--driver", action="store_true", help="src is a driver parquet folder")
    p.add_argument("--user-buckets", type=int, default=None)
    a = sub.add_parser("ask")
    a.add_argument("question", choices=sorted(QUESTIONS))
    a.add_argument("--database", required=True)
    a.add_argument("--param", action="append", default=[], help="k=v question parameter")
    a.add_argument("--out")
    a.add_argument("--show", type=int, default=20)
    a.add_argument("--explain", action="store_true", help="print the physical plan only")
    q = sub.add_parser("query")
    q.add_argument("name")
    q.add_argument("--sf", required=True)
    q.add_argument("--out")
    q.add_argument("--show", type=int, default=20)
    q.add_argument("--explain", action="store_true", help="print the physical plan only")
    sub.add_parser("list")
    args = ap.parse_args(argv)

    from shopmarts.plans.registry import QUERIES
    if args.cmd == "list":
        print("questions:", ", ".join(sorted(QUESTIONS)))
        print("queries:", ", ".join(sorted(QUERIES)))
        return 0
    from shopmarts.session import build_session
    spark = build_session()
    if args.cmd == "pipeline":
        from shopmarts.plans.pipeline import raw_from_csv, run_pipeline
        from shopmarts.plans.shop import Shop
        raw = Shop(spark, args.src).raw if args.driver else raw_from_csv(spark, args.src)
        run_pipeline(spark, raw, args.database, user_buckets=args.user_buckets).show(18, False)
    elif args.cmd == "ask":
        params = dict(kv.split("=", 1) for kv in args.param)
        _emit(ask(spark, args.database, args.question, **params), args.out, args.show,
              args.explain)
    else:
        _emit(QUERIES[args.name](spark, args.sf), args.out, args.show, args.explain)
    return 0


if __name__ == "__main__":
    sys.exit(main())
