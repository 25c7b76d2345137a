"""souk — job-offer market analytics on Spark.

Captured job-board pages become typed offer records (bronze), are cleaned,
unified and de-duplicated (silver) and shaped into a star schema (gold), all as
DataFrame plans that Catalyst optimises and that scale out with the data.
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Pickle this package's functions by value, so executor-side Python
    (``mapInPandas``) works on workers where ``souk`` is not installed."""
    import sys

    try:
        from pyspark import cloudpickle
    except ImportError:  # pragma: no cover - pyspark is a hard dependency
        return
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_ship_by_value()
