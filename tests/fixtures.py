"""Hand-written raw rows (the six raw shapes with the raw-file schemas)."""

from shopmarts.sources.schemas import RAW_SCHEMAS


def raw_frames(spark, **rows):
    """DataFrames for all six raw tables; tables not given are empty."""
    return {t: spark.createDataFrame(rows.get(t, []), RAW_SCHEMAS[t]) for t in RAW_SCHEMAS}


def user(uid, age=35, gender="M", pref="東京都", reg="2023-05-01", name=None):
    return (uid, name or f"name{uid}", age, gender, pref, reg, f"user{uid}@example.com")


def order(oid, uid, date, status="completed", total=1000, channel="web", category="食品"):
    return (oid, uid, date, status, total, channel, category)


def access(aid, uid, ts="2025-01-01 10:00:00", ip="203.0.113.1", success=1,
           event="login", threat="normal", ua="test-agent"):
    return (aid, uid, ts, ip, ua, success, event, threat)
