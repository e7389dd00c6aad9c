"""File scans: CSV strings with pruning, gzip, tagged multi-file reads, parquet-or-clean."""

import os
import tempfile

from pyspark.sql import functions as F

from tallyspark.operators.cleaning import clean_stock_prices
from tallyspark.operators.market import daily_returns
from tallyspark.sources.raw import read_csv_strings, read_or_clean, read_tagged


def test_read_tagged_and_gzip(spark):
    d = tempfile.mkdtemp(prefix="tallyspark-csv-")
    paths = {}
    for t, n in (("AAA", 3), ("BBB", 2)):
        p = os.path.join(d, f"{t}.csv")
        with open(p, "w") as f:
            f.write("Date,Close\n" + "".join(f"2024-01-0{i + 1},{10 + i}\n" for i in range(n)))
        paths[t] = p
    df = read_tagged(spark, paths)
    assert {(r.ticker, r.n) for r in df.groupBy("ticker").agg(F.count("*").alias("n")).collect()} == {("AAA", 3), ("BBB", 2)}
    # equal file names in two folders, and a whole folder as a source
    two = {}
    for t, n in (("XX", 1), ("YY", 4)):
        os.makedirs(os.path.join(d, t))
        two[t] = os.path.join(d, t, "p.csv")
        with open(two[t], "w") as f:
            f.write("Date,Close\n" + "2024-01-01,1\n" * n)
    for paths2 in (two, {"XX": two["XX"], "YY": os.path.dirname(two["YY"])}):
        got2 = read_tagged(spark, paths2).groupBy("ticker").agg(F.count("*").alias("n")).collect()
        assert {(r.ticker, r.n) for r in got2} == {("XX", 1), ("YY", 4)}
    gz = os.path.join(d, "gz")
    spark.createDataFrame([("1", "x", "y")], "a string, b string, c string").write.option("header", True) \
        .option("compression", "gzip").csv(gz)
    got = read_csv_strings(spark, gz, ["a", "c"])
    assert got.columns == ["a", "c"] and got.first().c == "y"


def test_read_or_clean_prefers_parquet(spark):
    d = tempfile.mkdtemp(prefix="tallyspark-roc-")
    cleaned = os.path.join(d, "prices.parquet")
    calls = []

    def raw():
        calls.append(1)
        return spark.createDataFrame([("abc ", "2024-01-02", "1", "1", "1", "2", "2", "5", 1)],
                                     "ticker string, Date string, Open string, High string, Low string, "
                                     "Close string, `Adj Close` string, Volume string, seq long")

    first = read_or_clean(spark, cleaned, raw, clean_stock_prices)
    assert calls == [1] and first.first().ticker == "ABC"
    first.write.parquet(cleaned)
    read_or_clean(spark, cleaned, raw, clean_stock_prices).count()
    assert calls == [1]


def test_daily_returns_gap_semantics(spark):
    rows = [("T", f"2024-01-0{i}", p) for i, p in ((1, 10.0), (2, None), (3, 12.0), (4, 6.0))]
    df = spark.createDataFrame(rows, "ticker string, trade_date string, adj_close double")
    got = [r.daily_return for r in daily_returns(df).orderBy("trade_date").collect()]
    assert got == [None, None, 0.2, -0.5]
