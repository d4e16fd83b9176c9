from brontide.plans import catalogue
from brontide.sources import tables as T

from .conftest import SMALL


def test_every_line_item_is_an_anchor(spark):
    items = T.table(spark, SMALL, "lineitem")
    assert T.oi_anchors(spark, SMALL).count() == items.count()
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    got = catalogue.QUERIES["oi_asof"](spark, SMALL).select(keys)
    assert sorted(got.collect()) == sorted(items.select(keys).collect())
