"""Drilling and industrial-sensor telemetry operators for PySpark.

Every operator is a function from DataFrame to DataFrame (or Column to Column).
Import the sub-packages you need:

* ``rigstream.sources``    message sources, offset ledger, keyed tables
* ``rigstream.operators``  decode, routing, aggregates, comparison, reshape, forecast
* ``rigstream.functions``  scalar column functions and payload builders
* ``rigstream.streaming``  keyed-state processors and streaming sinks
* ``rigstream.plans``      ready-made jobs and the registered queries
"""

import sys

from pyspark import cloudpickle

from rigstream.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]

# functions sent to executors carry their code, so the package need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])
