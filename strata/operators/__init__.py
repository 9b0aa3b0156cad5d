"""DataFrame -> DataFrame operators."""
from strata.operators import aggregates, filters, joins, projection, sets, timeseries  # noqa: F401
