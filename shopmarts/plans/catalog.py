"""Semantic layer: table and column comments on the gold marts (S8, S9) and the
catalog view built from them (Q15).

Comments live in the metastore.  An overwrite drops them, so ``apply_comments``
runs after every pipeline write; failing statements are raised.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

# The semantic-layer comments of the gold marts (table comment,
# then column comments), as the reference writes them.
COMMENTS = {
    "gold_monthly_sales": (
        "月別・カテゴリ別の売上集計テーブル。completed（完了）注文のみを集計。ECサイトの売上分析に使用。",
        {
            "ym": "年月（yyyy-MM形式、例: 2024-01）",
            "category": "商品カテゴリ（電子機器、ファッション、食品、家具・インテリア、スポーツ、本・メディア、美容・健康、ホビー・ゲーム）",
            "sales_amount": "売上金額（日本円）。「売上」「revenue」と同義。",
            "order_count": "注文件数",
            "avg_order_value": "平均注文単価（日本円）",
        }),
    "gold_customer_rfm": (
        "顧客のRFM分析結果。Recency（最終購入からの日数）、Frequency（購入回数）、Monetary（累計購入金額）に基づくセグメント分類。",
        {
            "user_id": "顧客ID",
            "age_group": "年齢層（10-20代、30代、40代、50代以上）",
            "recency_days": "最終購入からの経過日数。小さいほど最近購入。",
            "frequency": "購入回数（多いほどリピーター）",
            "monetary": "累計購入金額（日本円）。LTVと同義。",
            "segment": "顧客セグメント（優良顧客、成長顧客、休眠予備軍、離脱リスク）。「ゴールド会員」は優良顧客の社内呼称。",
        }),
    "gold_cart_abandonment": (
        "月別・カテゴリ別のカゴ落ち率。全セッションのうち離脱（abandon）で終わった割合。",
        {
            "abandonment_rate": "カゴ落ち率（%）。高いほど離脱が多い。「バスケット落ち」と同義。",
        }),
    "gold_access_summary": (
        "月別・脅威タイプ別のアクセス集計。ログイン成功/失敗、攻撃元IP数を確認できる。セキュリティ監視に使用。",
        {
            "period": "年月（yyyy-MM形式）",
            "thr_cls": "脅威タイプ（normal=通常、brute_force=総当たり攻撃、bot=BOTアクセス、fraud=不正購入試行）",
            "tz_band": "時間帯（深夜帯=2-5時、午前=6-11時、午後=12-17時、夜間=18-1時）",
            "evt_cnt": "イベント総数",
            "succ_cnt": "成功したアクセス数",
            "fail_cnt": "失敗したアクセス数。「失敗」「ログイン失敗」と同義。",
            "fail_pct": "失敗率（%）。高いほど攻撃の可能性。",
        }),
    "gold_threat_events": (
        "脅威イベントの詳細。攻撃タイプ別・IP別のイベント数と対象ユーザー数。normalを除く異常アクセスのみ。",
        {
            "thr_cls": "脅威タイプ（brute_force=総当たり攻撃、bot=BOTアクセス、fraud=不正購入試行）",
            "src_addr": "攻撃元IPアドレス",
            "evt_cnt": "イベント件数。「攻撃回数」と同義。",
            "tgt_usr": "攻撃対象となったユニークユーザー数",
        }),
    "gold_user_risk": (
        "ユーザーごとのリスクスコア。ログイン失敗・BOT活動・不正購入試行を重み付けしてスコアリング。高スコアほど要注意。",
        {
            "usr_ref": "ユーザーID",
            "fail_cnt": "ログイン失敗回数",
            "bf_cnt": "総当たり攻撃に関連したイベント数",
            "bot_cnt": "BOT活動イベント数",
            "frd_cnt": "不正購入試行回数",
            "rsk_val": "リスクスコア（高いほど危険）。失敗×1 + 総当たり×3 + BOT×5 + 不正購入×10 で算出。",
            "rsk_cat": "リスクレベル（critical=50以上、high=20以上、medium=5以上、low=5未満）",
        }),
}


def _q(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def comment_statements(database: str) -> list[str]:
    out = []
    for table, (tcomment, cols) in COMMENTS.items():
        fq = f"{database}.{table}"
        out.append(f"COMMENT ON TABLE {fq} IS '{_q(tcomment)}'")
        out += [f"ALTER TABLE {fq} ALTER COLUMN {c} COMMENT '{_q(t)}'" for c, t in cols.items()]
    return out


def apply_comments(spark: SparkSession, database: str, strict: bool = True) -> dict[str, str]:
    """Run every comment statement; returns the failed ones with their errors.

    All statements are tried; with ``strict`` a failure is raised in the end, so
    no run reports success with half a semantic layer."""
    failed: dict[str, str] = {}
    for stmt in comment_statements(database):
        try:
            spark.sql(stmt)
        except AnalysisException as e:
            failed[stmt] = str(e)
    if failed and strict:
        raise RuntimeError(f"{len(failed)} comments failed, first: {next(iter(failed.items()))}")
    return failed


def table_catalog(spark: SparkSession, database: str, tables=None) -> DataFrame:
    """(table_name, column_name, data_type, column_comment, table_comment) rows,
    from the metastore (DESCRIBE) -- no data is read."""
    tables = tables or list(COMMENTS)
    parts = []
    for t in tables:
        fq = f"{database}.{t}"
        tcomment = spark.catalog.getTable(fq).description  # metastore metadata, one string
        parts.append(spark.sql(f"DESCRIBE TABLE {fq}")
                     .filter(~F.col("col_name").startswith("#") & (F.col("col_name") != ""))
                     .select(F.lit(t).alias("table_name"), F.col("col_name").alias("column_name"),
                             "data_type", F.col("comment").alias("column_comment"),
                             F.lit(tcomment).cast("string").alias("table_comment")))
    return reduce(DataFrame.unionByName, parts)


def search_catalog(catalog: DataFrame, term: str) -> DataFrame:
    """Q15: catalog rows whose column or table comment mentions ``term``."""
    hit = (F.coalesce(F.col("column_comment"), F.lit("")).contains(term)
           | F.coalesce(F.col("table_comment"), F.lit("")).contains(term))
    return catalog.filter(hit)
