"""Properties of the summary: totals, ordering, subset, and independence from input partitioning."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flatwatch.operators.enrich import area_bucket
from flatwatch.operators.summary import city_summary, main_city_summary
from flatwatch.plans import testview as tv
from flatwatch.plans.catalog import _enriched

SF = "/root/testdata/sf0.001"
ORDER = ["<30", "30-49", "50-74", "75-100", ">100"]


@settings(max_examples=1, deadline=None)
@given(st.lists(st.floats(min_value=0, max_value=1000, allow_nan=False), min_size=1, max_size=200))
def test_bucket_total_and_monotone(spark, areas):
    df = spark.createDataFrame([(float(a),) for a in sorted(areas)], "a double")
    got = [ORDER.index(r[0]) for r in df.orderBy("a").select(area_bucket(F.col("a"))).collect()]
    assert got == sorted(got)


def test_summary_properties(spark):
    listings = _enriched(spark, SF)
    snap = listings.filter(F.col("download_date") == tv.SNAPSHOT_DATE)
    s = city_summary(listings, tv.SNAPSHOT_DATE)
    rows = s.collect()
    assert sum(r.number_of_posts for r in rows) == snap.count()
    assert all(r.min_price <= r.max_price for r in rows if r.min_price is not None)
    main = main_city_summary(s, tv.TEST_MAIN_CITIES).collect()
    assert {tuple(r) for r in main} <= {tuple(r) for r in rows}
    again = city_summary(listings.repartition(7, "post_title"), tv.SNAPSHOT_DATE).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))
