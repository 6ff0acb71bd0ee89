"""API and AI-agent telemetry as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

from tracewell.session import prepare_session

# The few batch functions travel to the executors with the job, so the package
# need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["prepare_session"]
