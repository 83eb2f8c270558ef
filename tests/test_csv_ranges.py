"""One CSV file read by many tasks equals the same file read by one."""

import random
from collections import Counter

import pytest

from shopmarts.sources import csvranges as R
from shopmarts.sources import files
from shopmarts.sources.schemas import ORDERS

HEADER = "order_id,user_id,order_date,status,total_amount,channel,category"


@pytest.fixture
def small_ranges(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes",
                                          "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def write(tmp_path, text, name="o.csv"):
    p = tmp_path / name
    p.write_bytes(text.encode("utf-8"))
    return str(p)


def both(spark, path):
    one = files.read_csv(spark, path, ORDERS, keep_corrupt=True)
    many = R.read_csv_ranges(spark, path, ORDERS, keep_corrupt=True)
    assert many.columns == one.columns
    return Counter(map(tuple, many.collect())), Counter(map(tuple, one.collect()))


VALUES = ["plain", '"two\nlines"', '"a ""quoted"" word"', '"comma, here"', '""', "", '"\n\n\n"', "  padded ",
          '"日本 é"', '"line one\nline, two\n""three"""', '"' + "long\n" * 90 + '"', "back\\slash", '"tail\\"']


@pytest.mark.parametrize("seed", range(4))
def test_equal_to_the_one_task_reader(spark, tmp_path, small_ranges, seed):
    rng = random.Random(seed)
    rows = [f"{i},{i % 7},2025-01-01,completed,{i * 3},web,{rng.choice(VALUES)}" for i in range(150)]
    rows[20] = "x4,13,2025-01-04,completed,400,web,食品"          # not a number
    rows[50] = "2,11,2025-01-02,completed"                        # short
    rows[90] = "3,12,2025-01-03,completed,300,web,食品,extra"     # long
    rows[91] = ""
    path = write(tmp_path, HEADER + "\n" + "\n".join(rows) + ("\n" if seed % 2 else ""))
    assert R.physical_lines(spark, path).rdd.getNumPartitions() > 20
    many, one = both(spark, path)
    assert many == one and sum(one.values()) == 149


def test_carriage_returns(spark, tmp_path, small_ranges):
    rows = [f"{i},1,2025-01-01,completed,5,web," + ('"two\r\nlines"' if i % 3 else "one") for i in range(60)]
    many, one = both(spark, write(tmp_path, "\r\n".join([HEADER, *rows]) + "\r\n"))
    assert many == one and len(one) == 60


def test_a_value_longer_than_many_ranges(spark, tmp_path, small_ranges):
    long = '"' + 'x, ""y""\n' * 500 + '"'
    rows = ["1,1,2025-01-01,completed,5,web,a", f"2,1,2025-01-01,completed,5,web,{long}",
            f"3,1,2025-01-01,completed,5,web,{long}", "4,1,2025-01-01,completed,5,web,b"]
    many, one = both(spark, write(tmp_path, "\n".join([HEADER, *rows])))
    assert many == one and len(one) == 4


def test_files_with_stray_quotes_are_read_by_file(spark, tmp_path, small_ranges):
    good = [f'{i},1,2025-01-01,completed,5,web,"a\nb"' for i in range(40)]
    odd = [f'{i},1,2025-01-01,completed,5,web,5" pipe' for i in range(100, 141)]
    folder = tmp_path / "in.csv"
    folder.mkdir()
    write(folder, "\n".join([HEADER, *good]), "a.csv")
    write(folder, "\n".join([HEADER, *odd]), "b.csv")
    many, one = both(spark, str(folder))
    assert many == one and len(one) == 81


def test_headers_are_checked_and_empty_files_pass(spark, tmp_path):
    bad = "user_id,order_id,order_date,status,total_amount,channel,category\n1,2,2025-01-01,x,1,web,a\n"
    with pytest.raises(ValueError):
        R.read_csv_ranges(spark, write(tmp_path, bad), ORDERS)
    assert R.read_csv_ranges(spark, write(tmp_path, HEADER + "\n"), ORDERS).collect() == []
    assert R.read_csv_ranges(spark, write(tmp_path, ""), ORDERS).collect() == []


def test_nulls_and_empties_differ(spark, tmp_path, small_ranges):
    from shopmarts.session import shared_path
    from tests.fixtures import order, raw_frames
    values = ["plain", "two\nlines", 'quo"te', "", None, "\x01", "  padded ", "日本"] * 20
    raw = raw_frames(spark, orders=[order(i, 1, "2025-01-01", category=v) for i, v in enumerate(values)])
    path = shared_path(spark, "test_csv", unique=True)
    files.write_csv(raw["orders"].coalesce(1), path)
    got = {r.order_id: r.category for r in R.read_csv_ranges(spark, path, ORDERS).collect()}
    assert got == dict(enumerate(values))
