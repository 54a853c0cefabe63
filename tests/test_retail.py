"""Retail popularity: goldens on the driver tables, hand-made edge cases, invariants, plans."""

import pytest
from conftest import SF001, SF01
from pyspark.sql import functions as F

from popcenter.operators import retail as R
from popcenter.plans.retail import retail_popularity
from popcenter.sources import read_transactions, retail_view


@pytest.mark.parametrize("sf,rows,pairs,pairs_n1,top5", [
    (SF001, 6000, 3730, 129, [(104, 30), (72, 28), (58, 27), (144, 27), (36, 26)]),
    (SF01, 60000, 39697, 1426, [(1936, 35), (722, 34), (817, 34), (954, 34), (444, 33)]),
])
def test_goldens(spark, sf, rows, pairs, pairs_n1, top5):
    v = retail_view(spark, sf)
    assert R.row_count(v).first()["row_count"] == rows
    assert R.pair_count(v).first()["pair_count"] == pairs
    assert R.pair_count(v, "NATION_1").first()["pair_count"] == pairs_n1
    top = R.top_products(R.product_popularity(v), 5).orderBy("rank").collect()
    assert [(r.product_id, r.popularity) for r in top] == top5
    assert [r.rank for r in top] == [1, 2, 3, 4, 5]


def test_two_stage_equals_single_and_sums_to_pairs(spark):
    v = retail_view(spark, SF001)
    for country in (None, "NATION_3"):
        a = {(r.product_id, r.popularity) for r in R.product_popularity(v, country).collect()}
        b = {(r.product_id, r.popularity) for r in R.popularity_two_stage(v, country, buckets=3).collect()}
        assert a == b
        assert sum(p for _, p in a) == R.pair_count(v, country).first()[0]


def test_top_is_prefix_of_ordered_listing(spark):
    pop = R.product_popularity(retail_view(spark, SF001))
    full = sorted(((r.popularity, r.product_id) for r in pop.collect()), key=lambda t: (-t[0], t[1]))
    top = [(r.popularity, r.product_id) for r in R.top_products(pop, 17).orderBy("rank").collect()]
    assert top == full[:17]
    listing = [r.product_id for r in R.popularity_listing(pop).collect()]
    assert listing == sorted(listing)


def test_report_modes(spark):
    v = retail_view(spark, SF001)
    with pytest.raises(ValueError):
        retail_popularity(v, "all", -1)
    with pytest.raises(ValueError):
        R.top_products(R.product_popularity(v), 0)
    rep = retail_popularity(v, "all", 0)
    assert rep.top_products is None
    assert rep.listing.collect() == rep.listing_two_stage.collect()
    rep = retail_popularity(v, "NATION_2", 3)
    assert rep.listing is None and rep.top_products.count() == 3


HAND = [
    "T1,P1,GIFT TAPE, 24,2010-12-01 8:45,0.65,100,France",      # leading blank in quantity
    "T2,P1,GIFT TAPE,-3,2010-12-01 8:45,0.65,101,France",       # return: dropped
    "T3,P1,GIFT TAPE,0,2010-12-01 8:45,0.65,102,France",        # zero: dropped
    "T4,P2,MUG,2,2010-12-01 9:00,1.00,100,France",
    "T5,P2,MUG,5,2010-12-02 9:00,1.00,100,Italy",               # same pair, other transaction and country
    "T6,P3,LAMP,x7,2010-12-02 9:00,1.00,103,Italy",             # bad quantity: never qualifies
    "T7,P3,LAMP,7,2010-12-02 9:00,1.00,1o4,Italy",              # bad customer on a qualifying row
    "T8,P4,BOWL,1,2010-12-02 9:00,1.00,105",                    # seven fields: no country
    "T9,P5,RED, BLUE CUP,3,2010-12-02 9:00,1.00,106,France",    # comma in description shifts fields
    "T10,P6,PLATE,4,2010-12-03 9:00,2.00,107,all,,",            # trailing commas; country literally 'all'
    "",                                                          # blank line still counts as a row
]


def test_text_source_edge_cases(spark, tmp_text):
    rows = read_transactions(spark, tmp_text(HAND))
    assert R.row_count(rows).first()[0] == len(HAND)
    pairs = {(r.product_id, r.customer_id) for r in R.product_customer_pairs(rows).collect()}
    assert pairs == {("P1", 100), ("P2", 100), ("P4", 105), ("P6", 107)}
    france = {(r.product_id, r.customer_id) for r in R.product_customer_pairs(rows, "France").collect()}
    assert france == {("P1", 100), ("P2", 100)}
    # "all" is the no-filter sentinel, so the country named "all" cannot be selected alone
    assert R.pair_count(rows, "all").first()[0] == 4
    assert R.pair_count(rows, "Italy").first()[0] == 1
    assert R.pair_count(rows, "france").first()[0] == 0  # exact, case-sensitive
    pop = {(r.product_id, r.popularity) for r in R.product_popularity(rows).collect()}
    assert pop == {("P1", 1), ("P2", 1), ("P4", 1), ("P6", 1)}


def test_plan_shapes(spark):
    v = retail_view(spark, SF001)
    top = R.top_products(R.product_popularity(v, "NATION_1"), 5)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    formatted = top._sc._jvm.PythonSQLUtils.explainString(top._jdf.queryExecution(), "formatted") \
        if hasattr(top._sc._jvm, "PythonSQLUtils") else ""
    text = formatted or plan
    assert "EqualTo(n_name,NATION_1)" in text
    # column pruning: lineitem is read with 4 of its 11 columns
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_returnflag:string>" in text
    # at this size every join is broadcast: one shuffle for the distinct pairs, one for the counts
    assert plan.count("Exchange hashpartitioning") == 2


def test_two_stage_spreads_hot_product(spark):
    """One product bought by many customers: the two-stage partials stay bounded per slice."""
    rows = spark.range(0, 3000).select(
        F.lit("T").alias("transaction_id"), F.lit("HOT").alias("product_id"), F.lit(None).cast("string").alias("description"),
        F.lit(1).alias("quantity"), F.lit(None).cast("string").alias("invoice_date"), F.lit(1.0).alias("unit_price"),
        F.col("id").cast("int").alias("customer_id"), F.lit("X").alias("country"))
    assert R.popularity_two_stage(rows, buckets=8).first()["popularity"] == 3000
    assert R.product_popularity(rows).first()["popularity"] == 3000


def test_strict_mode_and_rejects(spark, tmp_text):
    from popcenter.sources.retail import parse_transactions

    lines = spark.read.text(tmp_text(HAND))
    rows = parse_transactions(lines, keep_raw=True)
    rej = {(r.transaction_id, r.bad_country, r.bad_quantity, r.bad_customer) for r in R.rejected_rows(rows).collect()}
    # T9's comma in the description shifts a text token into the quantity field; the blank line has no fields
    assert rej == {("T6", False, True, False), ("T7", False, False, True), ("T9", False, True, False), ("", False, True, False)}
    with pytest.raises(ValueError, match="3 quantity field"):
        R.check_strict(rows)
    kept = [h for h in HAND if h and not h.startswith(("T6,", "T8,", "T9,"))]
    ok = parse_transactions(spark.read.text(tmp_text(kept, "ok.txt")), keep_raw=True)
    with pytest.raises(ValueError, match="1 customer field"):
        R.check_strict(ok, "Italy")          # T7 qualifies in Italy: its customer must parse
    R.check_strict(ok, "France")             # T7 does not qualify in France: no failure
    assert R.pair_count(ok, "France").first()[0] == 2


@pytest.mark.parametrize("line,country,fault", [
    ("T1,P1,X,x7,d,1,100,Italy", "France", None),      # another country's quantity is never parsed
    ("T1,P1,X,x7,d,1,100,Italy", "Italy", "1 quantity"),
    ("T1,P1,X,,d,1,100,France", "France", "1 quantity"),
    ("T1,P1", None, "1 quantity"),
    ("T1,P1,X,3,d,1,100", "France", "1 without a country"),
    ("T1,P1,X,3,d,1,100", None, None),
    ("T1,P1,X,3,d,1,,France", "France", "1 customer"),
    ("T1,P1,X,0,d,1,,France", "France", None),
])
def test_strict_rules(spark, line, country, fault):
    from popcenter.sources.retail import parse_transactions

    rows = parse_transactions(spark.createDataFrame([(line,)], "value string"))
    if fault:
        with pytest.raises(ValueError, match=fault):
            R.check_strict(rows, country)
    else:
        R.check_strict(rows, country)
    assert R.rejected_rows(rows, country).count() == (1 if fault else 0)


def test_listing_positions(spark):
    pop = spark.createDataFrame([(f"P{k}é" if k % 3 else f"p{k}", k) for k in range(500)], "product_id string, popularity long")
    got = R.listing_positions(pop.repartition(4)).orderBy("position").collect()
    assert [r.position for r in got] == list(range(1, 501))
    assert [r.product_id for r in got] == sorted((r[0] for r in pop.collect()), key=str.encode)


def test_purchases_predicate_reaches_the_scan(spark):
    v = retail_view(spark, SF001, purchases_only=True)
    assert R.pair_count(v).first()[0] == R.pair_count(retail_view(spark, SF001)).first()[0]
    df = R.popularity_two_stage(v)
    plan = df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    pushed = [x for x in plan.split("\n") if "PushedFilters" in x and "l_quantity" in x]
    assert pushed and all("GreaterThan(l_quantity,0" in x for x in pushed)
    # distinct pairs, slices, products; each behind a partial aggregate (tested below)
    assert df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 3


def test_report_with_explicit_partitions(spark):
    v = retail_view(spark, SF001)
    rep = retail_popularity(v, "NATION_4", 5, num_partitions=3)
    base = retail_popularity(v, "NATION_4", 5)
    assert rep.top_products.collect() == base.top_products.collect()
    assert rep.pair_count.first()[0] == base.pair_count.first()[0]
    with pytest.raises(ValueError):
        retail_popularity(v, "all", 1, num_partitions=0)


def test_two_stage_has_a_partial_aggregate_below_each_exchange(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = R.popularity_two_stage(retail_view(spark, SF001, purchases_only=True), buckets=4)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    lines = plan.split("Join")[0].split("\n")
    exchanges = [i for i, x in enumerate(lines) if "Exchange hashpartitioning" in x]
    assert len(exchanges) >= 3
    for i in exchanges[:3]:
        assert "HashAggregate" in lines[i + 1]


def test_report_reads_the_rows_once(spark):
    """Row count and pairs come from one pass, also after a redistribution."""
    seen = spark.sparkContext.accumulator(0)
    counted = F.udf(lambda q: seen.add(1) or q, "double")
    v = retail_view(spark, SF001).select("product_id", "customer_id", F.col("quantity").cast("double").alias("q"), "country")
    rows = v.coalesce(1).withColumn("quantity", counted("q")).drop("q")
    rep = retail_popularity(rows, None, 5, num_partitions=3)
    assert rep.row_count.first()[0] == 6000 and rep.pair_count.first()[0] == 3730 and rep.top_products.count() == 5
    assert seen.value == 6000
    none = retail_popularity(rows.limit(0), None, 5)
    assert none.row_count.first()[0] == 0 and none.pair_count.first()[0] == 0


def test_top_products_of_any_h(spark, monkeypatch):
    pop = R.product_popularity(retail_view(spark, SF001))
    full = sorted(((r.popularity, r.product_id) for r in pop.collect()), key=lambda t: (-t[0], t[1]))
    monkeypatch.setattr(R, "HEAP", 3)
    for h in (4, 57, len(full), len(full) + 9):  # ties at the threshold go by product id
        top = [(r.rank, r.popularity, r.product_id) for r in R.top_products(pop, h).orderBy("rank").collect()]
        assert top == [(k + 1, *row) for k, row in enumerate(full[:h])]


def test_line_numbers_do_not_depend_on_splits(spark, tmp_path):
    from popcenter.sources import read_points
    from popcenter.sources.points import numbered_lines

    texts = {"b.txt": [f"{i},{i * 2}" for i in range(700)], "a.txt": ["7,7", "", "8,8"], "c.txt": [], "d.txt": ["1.5,x" * 3, "9,9,"]}
    for name, lines in texts.items():
        (tmp_path / name).write_text("".join(line + "\n" for line in lines))
    want = list(enumerate(line for name in sorted(texts) for line in texts[name]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for split in ("128m", "400", "64"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            lines = numbered_lines(spark, str(tmp_path))
            assert lines.rdd.getNumPartitions() >= (1 if split == "128m" else 8)
            assert sorted(map(tuple, lines.collect())) == want
            ids = sorted(r["point_id"] for r in read_points(spark, str(tmp_path)).collect())
            assert ids == [i for i, line in want if line.strip()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
