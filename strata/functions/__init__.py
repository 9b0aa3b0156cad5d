from strata.functions import columns  # noqa: F401
