"""Cleaned rows of which few columns are read."""

from leasekit.plans import registry

SF = "/root/testdata/sf0.001"


def test_columns_that_are_not_read_are_not_written_again(spark):
    few = registry.cleaned(spark, SF, ["id", "price", "price_display"])
    assert set(few.columns) == {"id", "price", "price_display", "bathrooms", "bedrooms", "square_feet"}
    assert sorted(map(str, few.collect())) == sorted(map(str, registry.cleaned(spark, SF).select(*few.columns).collect()))
