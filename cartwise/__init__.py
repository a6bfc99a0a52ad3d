"""cartwise: shop click / purchase logs to ranked recommendations, on Spark.

Every public builder takes and returns ``DataFrame``s; the as-of day is an
explicit parameter. Sub-packages:

* ``sources``   -- logical input tables and file readers / writers
* ``functions`` -- ``Column`` expressions (payload parsing, dates, guarded ratios)
* ``operators`` -- day-grain counts, windowed sums, ranks, joins, metrics, smoothing
* ``plans``     -- the composite feature / training / ranking pipelines
* ``streaming`` -- the day-grain click counts as a Structured Streaming query
"""

__all__ = ["constants", "session"]
