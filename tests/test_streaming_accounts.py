"""Nothing that arrives is lost; X2: a batch rewrites its days only."""

import os
import tempfile
from datetime import date

from pyspark.sql import functions as F

from tallyspark.sources.buckets import BucketTable
from tallyspark.streaming import pipelines as sp

SCHEMA = "txn_id long, step long, txn_type string, amount double, sender_bal_before double, sender_bal_after double, is_fraud int"


def _row(i, step, drain=True):
    return (i, step, "TRANSFER", 10.0, 10.0 if drain else 12.0, 0.0 if drain else 2.0, 0)


def _run(spark, arrivals, src, out):
    for rows in arrivals:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)
    q = sp.start_accounting(sp.read_transaction_stream(spark, src, spark.createDataFrame([], SCHEMA).schema, 1), out, out + "_ckpt")
    q.awaitTermination()


def test_flagged_repeated_and_late_are_all_that_arrived(spark):
    base = tempfile.mkdtemp(prefix="tallyspark-arrivals-")
    src, out = f"{base}/src", f"{base}/out"
    _run(spark, [[_row(1, 1), _row(2, 1, False), _row(1, 1)], [_row(3, 50), _row(1, 1)]], src, out)
    # a second start goes on where the first ended: state, watermark and files
    _run(spark, [[_row(4, 2), _row(4, 2), _row(3, 50), _row(5, 60)], [_row(6, 3), _row(2, 70)]], src, out)
    got = sorted((r.status, r.txn_id, r.is_flagged_rule) for r in spark.read.parquet(out).collect())
    assert got == sorted([("flagged", 1, 1), ("flagged", 2, 0), ("repeated", 1, 1), ("repeated", 1, 1), ("flagged", 3, 1),
                          ("late", 4, 1), ("late", 4, 1), ("repeated", 3, 1), ("flagged", 5, 1), ("late", 6, 1), ("repeated", 2, 1)])
    for _ in range(2):                                        # the repair may run again
        sp.repair_late(spark, out, out + "_repaired")
        fixed = sorted((r.status, r.txn_id, r.n_repeated) for r in spark.read.parquet(out + "_repaired").collect())
        assert fixed == [("repaired", 4, 1), ("repaired", 6, 0)]


def _days(spark, rows):
    return spark.createDataFrame(rows, "txn_day date, txn_type string, txn_count long, fraud_count long, total_amount decimal(38,2)")


def test_a_batch_rewrites_its_days_only_and_a_replay_nothing(spark):
    table = tempfile.mkdtemp(prefix="tallyspark-days-")
    write = sp.upsert_days(table)
    d = [date(2024, 1, i) for i in (1, 2, 3)]
    write(_days(spark, [(d[0], "A", 1, 0, None), (d[0], "B", 2, 0, None), (d[1], "A", 3, 1, None)]), 0)
    before = BucketTable(spark, table).manifest()
    write(_days(spark, [(d[1], "A", 5, 1, None), (d[1], "B", 1, 0, None), (d[2], "A", 1, 0, None)]), 1)
    after = BucketTable(spark, table).manifest()
    day = lambda x: str((x - date(1970, 1, 1)).days)
    assert after.folders[day(d[0])] == before.folders[day(d[0])] and after.folders[day(d[1])] != before.folders[day(d[1])]
    files = {f for f in os.listdir(table)}
    write(_days(spark, [(d[1], "A", 99, 9, None)]), 1)        # the same batch again
    assert BucketTable(spark, table).manifest() == after and {f for f in os.listdir(table)} == files
    got = {(r.txn_day, r.txn_type): r.txn_count for r in BucketTable(spark, table).read().collect()}
    assert got == {(d[0], "A"): 1, (d[0], "B"): 2, (d[1], "A"): 5, (d[1], "B"): 1, (d[2], "A"): 1}


def test_event_time_is_utc_whatever_the_session(spark):
    df = spark.createDataFrame([(0,)], "step long").select(F.unix_seconds(sp.event_time()).alias("s"))
    assert df.first().s % 3600 == 0


def test_flagged_ids_share_bucketed_states(spark):
    """A call of Python for every id took milliseconds a row; the states kept must not grow with the ids."""
    base = tempfile.mkdtemp(prefix="tallyspark-buckets-")
    src, out = f"{base}/src", f"{base}/out"
    n = 3 * sp.STATE_BUCKETS
    big = [2 ** 60 + i for i in range(n)]                     # ids that floats cannot hold
    null = (None, *_row(0, 5)[1:])
    _run(spark, [[_row(i, 5) for i in big] + [null, null], [_row(big[7], 5), (big[8], None, *_row(0, 5)[2:]), null]], src, out)
    got = {r.status: (r.n, r.ids) for r in spark.read.parquet(out).groupBy("status").agg(
        F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_set("txn_id")).alias("ids")).collect()}
    assert got == {"flagged": (n + 1, big), "repeated": (4, big[7:9])}
    states = spark.read.format("statestore").load(out + "_ckpt")
    assert states.count() <= sp.STATE_BUCKETS + 1
