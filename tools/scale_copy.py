"""Make an N-times larger copy of a driver data folder, for scaling runs of bench.py.

Usage: python tools/scale_copy.py --sf /root/testdata/sf0.1 --times 10 --out /tmp/run-x/sf1x

Every table is unioned N times; copy i shifts each key by i x (the key's range),
so keys stay unique and every join (orders -> customer, lineitem -> orders/part,
events -> users, labels -> documents, ...) still matches within its copy.
Fixed dimensions (region, nation) and the query set (benchmark) are not copied.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# table -> {column: key family}; each family is shifted by its own range
KEYS = {
    "customer": {"c_custkey": "cust"},
    "supplier": {"s_suppkey": "supp"},
    "part": {"p_partkey": "part"},
    "orders": {"o_orderkey": "order", "o_custkey": "cust"},
    "lineitem": {"l_orderkey": "order", "l_partkey": "part", "l_suppkey": "supp"},
    "events": {"event_id": "event", "user_id": "cust"},
    "documents": {"doc_id": "doc"},
    "labels": {"doc_id": "doc"},
    "embeddings": {"vec_id": "vec"},
    "pages": {"page_id": "page"},
    "conversations": {"conv_id": "conv"},
}
FAMILY_SOURCE = {"cust": ("customer", "c_custkey"), "supp": ("supplier", "s_suppkey"),
                 "part": ("part", "p_partkey"), "order": ("orders", "o_orderkey"),
                 "event": ("events", "event_id"), "doc": ("documents", "doc_id"),
                 "vec": ("embeddings", "vec_id"), "page": ("pages", "page_id"),
                 "conv": ("conversations", "conv_id")}
AS_IS = ("region", "nation", "benchmark")


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("--times", type=int, default=10)
    ap.add_argument("--out", required=True)
    args = ap.parse_args()
    from pyspark.sql import functions as F

    from shopmarts.session import build_session
    spark = build_session("local[8]", 16, conf={"spark.driver.memory": "16g"})
    read = lambda t: spark.read.parquet(os.path.join(args.sf, f"{t}.parquet"))
    span = {}
    for fam, (t, c) in FAMILY_SOURCE.items():
        lo, hi = read(t).agg(F.min(c), F.max(c)).first()
        span[fam] = int(hi) + 1 if hi is not None else 1
    for t, keys in KEYS.items():
        df = read(t)
        # replicate each row N times (one explode per row: no join, no pairs)
        rep = df.withColumn("copy_i", F.explode(F.sequence(F.lit(0), F.lit(args.times - 1))))
        for c, fam in keys.items():
            typ = dict(df.dtypes)[c]
            rep = rep.withColumn(c, (F.col(c) + F.col("copy_i") * span[fam]).cast(typ))
        rep.drop("copy_i").write.mode("overwrite").parquet(os.path.join(args.out, f"{t}.parquet"))
    for t in AS_IS:
        read(t).write.mode("overwrite").parquet(os.path.join(args.out, f"{t}.parquet"))
    print(f"wrote x{args.times} copy of {args.sf} to {args.out}")


if __name__ == "__main__":
    main()
