"""seismiq: Spark-native layered analytics over seismic event observations.

Bronze (raw feed rows) -> Silver (latest version per event, labelled) ->
Gold (hourly rollup) -> anomaly / classifier enrichment -> report datasets
-> export.  Every operator is a ``DataFrame -> DataFrame`` function built
from Spark SQL expressions, so Catalyst plans and distributes the work.
"""

__version__ = "0.1.0"
