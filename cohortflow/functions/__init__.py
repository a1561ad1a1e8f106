"""Column expressions: bands, measures, geo, keys."""

from cohortflow.functions import bands, geo, keys, measures  # noqa: F401
