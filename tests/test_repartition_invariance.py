"""Queries with a 'first', a sample, a split or a rank give the same rows for any partitioning."""

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
NAMES = ["s18_customers", "v5_segment_summary", "l3_md5_sample", "l6_stratified_split", "c3_clean_stock_prices",
         "c1_clean_loans", "a36_threshold_tradeoff", "a34_best_f2_threshold", "s10_price_ids",
         "d9_bubble_sample", "l4_block_sample", "a38_score_distribution_contrast",
         "m13_cluster_labels_by_frequency_bucket"]


def _rows(spark, name, parts):
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        df = entry.queries()[name](spark, SF)
        return sorted(tuple(r) for r in df.collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


@pytest.mark.parametrize("name", NAMES)
def test_same_result_for_any_shuffle_partitioning(spark, name):
    assert _rows(spark, name, 3) == _rows(spark, name, 11)
