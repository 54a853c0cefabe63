"""Property tests: random retail rows against a plain Python model of the operators."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from popcenter.operators import retail as R

ROW = st.tuples(
    st.sampled_from(["P1", "P2", "P3", "P4"]),           # product
    st.integers(min_value=-3, max_value=5),               # quantity
    st.one_of(st.none(), st.integers(1, 6)),              # customer (None: did not parse)
    st.sampled_from(["IT", "FR", "all"]),                 # country
)
SCHEMA = ("transaction_id string, product_id string, description string, quantity int, invoice_date string, "
          "unit_price double, customer_id int, country string")


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(ROW, max_size=40), country=st.sampled_from([None, "IT", "all"]), h=st.integers(1, 5))
def test_retail_matches_model(spark, rows, country, h):
    df = spark.createDataFrame([("T", p, "", q, "", 1.0, c, ctry) for p, q, c, ctry in rows], SCHEMA)
    keep = {(p, c) for p, q, c, ctry in rows
            if q > 0 and c is not None and (country in (None, "all") or ctry == country)}
    pop = {}
    for p, _ in keep:
        pop[p] = pop.get(p, 0) + 1
    assert R.pair_count(df, country).first()[0] == len(keep)
    assert {(r.product_id, r.customer_id) for r in R.product_customer_pairs(df, country).collect()} == keep
    got = {r.product_id: r.popularity for r in R.product_popularity(df, country).collect()}
    assert got == pop
    assert {r.product_id: r.popularity for r in R.popularity_two_stage(df, country, 3).collect()} == pop
    want_top = sorted(pop.items(), key=lambda t: (-t[1], t[0]))[:h]
    top = [(r.product_id, r.popularity) for r in R.top_products(R.product_popularity(df, country), h)
           .orderBy("rank").collect()]
    assert top == want_top
