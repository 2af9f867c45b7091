"""txrisk: Spark-native profiling, resampling, classification and evaluation of
payment transactions.

Everything is a function from DataFrames to DataFrames; fitted parameters are
small driver-side values (a handful of numbers per feature or class) that are
embedded into later plans as literals.
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Functions of this package run inside Python workers (mapInPandas
    stages). Pickle them by value so executors need no installed copy."""
    try:
        import sys

        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # pragma: no cover - older cloudpickle
        pass


_ship_by_value()
