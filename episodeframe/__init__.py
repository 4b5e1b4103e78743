"""episodeframe: Spark-native analytics over multi-rate sensor recordings.

Every operator is a plain ``DataFrame -> DataFrame`` or ``Column -> Column``
function so Catalyst plans the whole job: scans prune columns and push
filters, aggregations combine map-side, and windows are split into fixed
blocks so no single recording has to fit in one task.
"""

__version__ = "0.1.0"
