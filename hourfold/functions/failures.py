"""Telling failures of the data from failures of the cluster."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

FAILURES = (PySparkException, Py4JJavaError)
#: What the cluster, not the data, is to blame for.
_OF_THE_CLUSTER = ("ExecutorLostFailure", "FetchFailed", "MetadataFetchFailed", "SparkContext was shut down", "NO_ACTIVE_SESSION")


def is_transient(err: Exception) -> bool:
    return any(word in str(err) for word in _OF_THE_CLUSTER)
