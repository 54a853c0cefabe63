"""popcenter: retail popularity and robust k-center clustering as Spark DataFrame jobs.

Sub-packages:

* ``sources``   -- readers for comma-separated retail rows and point files, and the
                   views built from the driver's parquet tables.
* ``functions`` -- column expressions (vector parsing, Euclidean distance) and kernels.
* ``operators`` -- one function per operator (distinct pairs, popularity, top-H,
                   farthest-first coreset, ball weights, weighted greedy, objective).
* ``plans``     -- composite jobs (retail report, sequential and coreset k-center).
"""

__all__ = ["sources", "functions", "operators", "plans"]


def _ship_by_value() -> None:
    """Pickle this package's functions by value inside Spark tasks.

    The Arrow UDFs and grouped-map kernels reference helpers defined here; pickled by
    value, Python workers run them without having the package installed or on their
    path (no --py-files needed, nothing depends on the driver's working directory).
    """
    import sys

    try:
        from pyspark import cloudpickle
    except Exception:  # pragma: no cover - pyspark without its vendored cloudpickle
        return
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_ship_by_value()
