"""Documents from tables, with one customer holding a third of the orders and one order a third of the lines."""

import pytest
import samples
from pyspark.sql import functions as F

from edilake.operators import build, framing, loops, lookup, writing
from edilake.plans.lake import SPEC
from edilake.session import store

SF = "/root/testdata/sf0.001"
FIELDS = [lookup.Field("subscriber", "2000B", "SBR", 3), lookup.Field("claim", "2300", "CLM", 1, cast="bigint"),
          lookup.Field("line", "2400", "LX", 1, cast="int"), lookup.Field("part", "2400", "SV1", 1, sub=1, cast="bigint"),
          lookup.Field("charge", "2400", "SV1", 2, cast="decimal(18,2)")]


def tables(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    orders = orders.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, 5).otherwise(F.col("o_custkey")).cast("bigint"))
    lines = lines.withColumn("l_orderkey", F.when(F.col("l_partkey") % 3 == 0, 30).otherwise(F.col("l_orderkey")).cast("bigint"))
    # written out, as the row numbers of the stored file cut the long order into chunks
    return (spark.read.parquet(f"{SF}/customer.parquet"), store(orders, "skew/orders"), store(lines, "skew/lineitem"))


@pytest.fixture(scope="module")
def skewed(spark):
    return tables(spark)


def located(raw):
    framed = framing.frame(raw, SPEC.spec_id)
    return store(loops.assign_loops(framing.cut_elements(framing.cut_segments(framed)), SPEC), "skew/located")


def test_hot_customer_and_hot_order(spark, skewed, monkeypatch):
    customer, orders, lineitem = skewed
    monkeypatch.setattr(build, "ROWS_PER_CHUNK", 250)
    raw = store(build.claim_documents(customer, orders, lineitem, limit=300), "skew/raw", ("multi",))
    sizes = {r.multi: (r.n, r.longest) for r in raw.groupBy("multi").agg(
        F.count("*").alias("n"), F.max(F.length("content")).alias("longest")).collect()}
    whole = F.length("content")
    assert sizes[True][0] > 10
    # the hot document has about 90,000 characters; no part holds more than a fraction of it
    total = raw.where("multi").groupBy("file_id").agg(F.sum(whole).alias("n"))
    assert total.agg(F.max("n")).first()[0] > 4 * sizes[True][1]

    rows = located(raw)
    wide = lookup.flatten(rows, FIELDS, SPEC).select("file_id", "claim", "line", "part", "charge")
    want = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").cast("string").alias("file_id"), F.col("o_orderkey").alias("claim"), F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("part"), F.col("l_extendedprice").cast("decimal(18,2)").alias("charge"))
    assert wide.count() == want.count() == 6000
    assert wide.exceptAll(want).isEmpty() and want.exceptAll(wide).isEmpty()

    loop_rows = loops.link_parents(rows)
    assert loop_rows.where("loop_id = '2300'").count() == 1500
    assert loop_rows.where("loop_id = '2400' and parent_id <> '2300'").isEmpty()
    assert loops.structural_faults(rows, SPEC).isEmpty()
    counts = lookup.envelope_counts(rows).where("claimed <> cast(actual as string)")
    assert counts.isEmpty()
    ranks = loops.number_loop_iterations(loop_rows.where("loop_id = '2400'")).groupBy("file_id").agg(
        F.max("iteration").alias("top"), F.count("*").alias("n"), F.count_distinct("iteration").alias("d"))
    assert ranks.where("top <> n or d <> n").isEmpty()


@pytest.mark.parametrize("name", ["clean", "copies", "packed", "dirty"])
def test_limit_does_not_change_the_text(spark, skewed, monkeypatch, name):
    """The same text for every limit: a hot customer, a hot order, copied claims, many interchanges in a file."""
    variant = build.VARIANTS[name]

    def digests(**limit):
        raw = store(build.claim_documents(*skewed, variant, **limit), "skew/limits").orderBy("file_id", "part")
        texts = {}
        for r in raw.select("file_id", "content").collect():
            texts[r.file_id] = texts.get(r.file_id, "") + r.content
        return texts, raw.where("multi").count()

    plain, _ = digests()
    monkeypatch.setattr(build, "ROWS_PER_CHUNK", 32)
    for limit in (12, 40, 3000):
        cut, parts = digests(limit=limit)
        assert cut == plain and parts > len(plain) / 2 if limit < 3000 else cut == plain


def test_isa_is_106_characters(spark, skewed):
    raw = build.claim_documents(*skewed)
    assert raw.where("length(split(content, 'GS')[0]) <> 106").isEmpty()


def test_documents_from_any_segments(spark, monkeypatch):
    want = {"a": samples.text(samples.document(samples.claim(1), samples.claim(2))), "b": samples.text(samples.document(samples.claim(3, 0)))}
    rows = [(k, i, s.split("*")) for k, v in want.items() for i, s in enumerate(v.split("~")[:-1])]
    table = spark.createDataFrame(rows, "file_id string, n int, elements array<string>").repartition(3)
    documents = build.documents_from_segments(table, ["n"])
    assert {r.file_id: r.content for r in documents.collect()} == want
    # the longer one in pieces, each with the head that framing needs
    monkeypatch.setattr(build, "SLICE_SEGMENTS", 24)
    for rows in (7, 1):
        monkeypatch.setattr(writing, "ROWS_PER_PIECE", rows)
        pieces = build.documents_from_segments(table, ["n"]).orderBy("file_id", "part").collect()
        assert len([p for p in pieces if p.multi]) > 2
        assert "".join(p.content for p in pieces if p.file_id == "a") == want["a"]
        assert {p.head for p in pieces if p.multi} == {"".join(s + "~" for s in want["a"].split("~")[:2])}
