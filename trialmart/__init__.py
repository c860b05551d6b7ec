"""Clinical-operations reporting marts on Spark.

The package turns trial-management snapshots (studies, patients, calendars,
teams) and nightly medical-record extracts (appointments, chemotherapy
orders, labs) into reporting marts.  Every mart is a lazy DataFrame plan:

* ``trialmart.functions``  - Column helpers (clip, to_unsigned, date_key ...)
* ``trialmart.operators``  - reusable DataFrame operators (lookups, string
  lists, latest-per-group, anti exclusions, EAV slots, tagged unions ...)
* ``trialmart.sources``    - source table access and the derived test sources
* ``trialmart.plans``      - the mart builders M1-M10
* ``trialmart.sinks``      - versioned full-refresh publish, idempotent history
* ``trialmart.streaming``  - incremental (available-now) extract ingestion
"""

from trialmart.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
