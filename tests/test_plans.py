"""Plan checks: column pruning reaches the scan and the native paths stay in the JVM."""

from reviewflow.plans import QUERIES

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_select_prunes_scan(spark):
    plan = _plan(QUERIES["rating_counts"](spark, SF))
    assert "ReadSchema: struct<doc_id:bigint>" in plan or "ReadSchema: struct<doc_id:bigint,quality:int>" in plan


def test_no_python_udf_in_native_queries(spark):
    for name in ("label_polarity", "rating_counts", "phone_valid", "parse_request_body",
                 "status_extend_check", "token_counts", "encode_fixed", "activity_sessions"):
        plan = _plan(QUERIES[name](spark, SF))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_filters_pushed_to_scan(spark):
    plan = _plan(QUERIES["shutdown_deadline"](spark, SF))
    assert "PushedFilters" in plan


def test_kind_filter_reaches_parquet_scan(spark):
    plan = _plan(QUERIES["activity_sessions"](spark, SF))
    assert "EqualTo(event_type,purchase)" in plan


def test_raw_kind_filter_matches_derived(spark):
    from pyspark.sql import functions as F

    from reviewflow.tables import lifecycle_events
    for kinds in (("predict",), ("shutdown",), ("start", "status")):
        a = lifecycle_events(spark, SF, kinds=kinds).count()
        b = lifecycle_events(spark, SF).where(F.col("kind").isin(list(kinds))).count()
        assert a == b > 0


def test_unused_ratings_are_not_joined(spark):
    for name in ("full_text", "full_text_filled", "fill_text"):
        plan = _plan(QUERIES[name](spark, SF))
        assert "Join" not in plan and "Exchange" not in plan, name


def test_token_counts_reads_the_text_once(spark):
    assert _plan(QUERIES["token_counts"](spark, SF)).count("Scan parquet") == 1


def test_exact_sample_is_a_filter(spark):
    # the n-th hash is found beforehand; the sample itself never goes through one task
    plan = _plan(QUERIES["sample_exact"](spark, SF))
    assert "TakeOrderedAndProject" not in plan and "Limit" not in plan, plan
