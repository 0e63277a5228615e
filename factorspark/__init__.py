"""factorspark: quantitative equity research as lazy Spark DataFrame jobs.

Panels are long tables keyed ``(date, asset)``; text is ``(doc key, text)``;
matrices stay long ``(row, col, value)``.  Every operator is a
``DataFrame -> DataFrame`` function so Catalyst sees whole plans.
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Python code that runs inside tasks (the per-date K x K solve of the
    attribution) is pickled by value, so executors need no installed copy
    of this package; on a cluster shipping it with ``--py-files`` works too."""
    import sys

    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_ship_by_value()
