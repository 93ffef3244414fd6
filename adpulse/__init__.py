"""adpulse: job-advertising analytics on Spark.

Entry points:

* ``adpulse.plans.pipeline``: ``run_daily`` (raw JSON -> final ads of a day) and
  ``run_monthly`` (jobs, campaigns, clicks, performance mart of a month);
* ``adpulse.operators``: the DataFrame -> DataFrame steps;
* ``adpulse.streaming.incremental_ingest``: the daily stages over newly landed files;
* ``adpulse.plans.catalog``: registered queries with their SQL oracles.
"""
