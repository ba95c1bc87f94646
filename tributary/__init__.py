"""tributary — a Spark-native engine that consolidates point-of-sale, online-order
and mobile sales feeds into one scored, de-duplicated sales table and publishes
business aggregates from it.

Every operator is a ``DataFrame -> DataFrame`` function or a ``Column`` builder;
nothing in the library collects data to the driver or runs per-row Python.
"""

from tributary.rules import AS_CODED, DOCUMENTED, CleaningRules
from tributary.session import get_session, workspace_dir

__all__ = ["AS_CODED", "DOCUMENTED", "CleaningRules", "get_session", "workspace_dir"]
