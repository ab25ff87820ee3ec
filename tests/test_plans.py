"""What queries read and store: text is parsed once, and no more than a query needs is written."""

import datetime

import pytest
import samples

from edilake.operators import lookup
from edilake.plans.automaton import automaton_for
from edilake.plans.claims import QUERIES
from edilake.plans.lake import lake


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    day = datetime.datetime(2024, 1, 2)
    spark.createDataFrame([(k, f"N{k}", 1, "AUTO") for k in (1, 2, 7)], "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string").write.parquet(
        f"{folder}/customer.parquet")
    spark.createDataFrame([(10 * c + i, c, 5.0, "1-URGENT") for c in (1, 2, 7) for i in range(3)],
                          "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderpriority string").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame([(10 * c + i, n, n, 1, 2.0, 3.0, day) for c in (1, 2, 7) for i in range(3) for n in (1, 2)],
                          "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double,"
                          " l_shipdate timestamp").write.parquet(f"{folder}/lineitem.parquet")
    return folder


@pytest.mark.parametrize("name, variant", [
    *[(k, "clean") for k in ("children", "ancestor", "nth_segment", "get_element", "count_children", "replace_segment", "replace_loop")],
    *[(k, "dirty") for k in ("check_order", "check_known_segment", "check_required_elements", "check_required_composites", "check_loop_repeats",
                             "check_required_child_loops", "structural_faults", "flatten_siblings")]])
def test_whole_segments_are_not_stored_for_one_query(spark, tables, name, variant):
    rows = QUERIES[name][0](spark, tables).count()
    x = lake(spark, tables, variant)
    assert "located" not in x.__dict__
    assert rows == {"children": 18, "ancestor": 9, "nth_segment": 9, "get_element": 9, "count_children": 9, "replace_segment": 9, "replace_loop": 3,
                    "flatten_siblings": 9}.get(name, rows)


def test_a_filter_on_multi_leaves_the_other_documents_out_of_the_plan(spark):
    located = samples.locate(spark, {"a": samples.document(samples.claim(1, 2))})
    assert located.where("not multi").count() == located.count()
    assert "LocalRelation <empty>" in located.where("multi")._jdf.queryExecution().optimizedPlan().toString()


def test_flatten_walks_its_segments_once(spark):
    located = samples.locate(spark, {"a": samples.document(samples.claim(1, 2), samples.claim(2))})
    wide = lookup.flatten(located, [lookup.Field("claim", "2300", "CLM", 1), lookup.Field("line", "2400", "LX", 1)], samples.SPEC)
    assert "ArrowEvalPython" not in wide._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.claim, r.line) for r in wide.collect()) == [("1", "1"), ("1", "2"), ("2", "1")]


def test_the_signature_has_no_branch_for_each_segment_id(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(["NM1", "41"],), (["NM1", "zz"],), (["SV1"],), ([],)], "e array<string>")
    sig = df.select(automaton_for(samples.SPEC).signature(F.col("e")).alias("s"))
    assert sig._jdf.queryExecution().optimizedPlan().toString().count("WHEN") <= 2
    got = [r.s for r in sig.collect()]
    assert got[0] > 0 and got[1:] == [0, 0, 0]
