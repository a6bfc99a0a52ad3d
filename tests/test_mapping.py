"""The input adapters reproduce the overlap counts published with the test
tables (FIXTURES §2): distinct pairs clicked in the 21 days before the as-of
day, clicked with any of the three click types, bought on the day, and their
intersections."""

import pytest
from pyspark.sql import functions as F

from cartwise.constants import TAB_CLOTH
from cartwise.functions.dates import shift, to_day
from cartwise.sources.tables import ShopData

# fixed values: the published table (sf, as-of, clicked, any type, bought, clicked & bought, any & bought)
PUBLISHED = [
    ("0.001", "2024-01-25", 143, 365, 7, 1, 2),
    ("0.001", "2024-01-30", 146, 368, 7, 1, 4),
    ("0.01", "2024-01-25", 1335, 3626, 71, 7, 19),
    ("0.01", "2024-01-30", 1334, 3675, 61, 6, 13),
]


@pytest.mark.parametrize("sf,asof,clicked,any_type,bought,c_and_b,a_and_b", PUBLISHED)
def test_overlap_counts(spark, sf, asof, clicked, any_type, bought, c_and_b, a_and_b):
    d = ShopData(spark, f"/root/testdata/sf{sf}")
    day = to_day(asof)
    look_back = (F.col("dt") >= F.lit(shift(day, -21))) & (F.col("dt") < F.lit(day))
    ev = d.click_events().where(look_back)
    c = ev.where(F.col("child_tab") == TAB_CLOTH).select("role_id", "item_id").distinct()
    a = ev.select("role_id", "item_id").distinct()
    b = d.buy_log().where(F.col("dt") == F.lit(day)).select("role_id", "item_id").distinct()
    got = (c.count(), a.count(), b.count(), c.join(b, ["role_id", "item_id"]).count(),
           a.join(b, ["role_id", "item_id"]).count())
    assert got == (clicked, any_type, bought, c_and_b, a_and_b)
