"""Spark engine that turns captured web material into a clean table of event records."""

import sys

from pyspark import cloudpickle

from gleanfield.schema import DATE_COLUMNS, EVENT_COLUMNS, EVENT_SCHEMA

__all__ = ["DATE_COLUMNS", "EVENT_COLUMNS", "EVENT_SCHEMA"]

# Executors get Python helpers with the task, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
