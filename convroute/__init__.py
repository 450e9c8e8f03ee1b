"""Routing of customer conversations on Spark DataFrames."""

import sys

from pyspark import cloudpickle

from convroute.config import Precedence, RoutingConfig
from convroute.workspace import Workspace

# Executors need no installed copy: the few functions that run in Python workers travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["Precedence", "RoutingConfig", "Workspace"]
