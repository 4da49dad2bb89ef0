"""racestream: event-stream analytics on Spark.

Two families of jobs, each a chain of ``DataFrame -> DataFrame`` operators that
run unchanged on static and on streaming input:

* clicks: parse JSON click events, drop anonymous users, count clicks per
  account in sliding or tumbling event-time windows, route accounts by count;
* telemetry: decode car telemetry, follow tracked drivers together with the
  cars just ahead and behind, compute gaps, report them, detect a change of
  follower.
"""

__version__ = "0.1.0"
