"""Publishing marts: atomic versions, idempotent history, nightly run, quality report.

* ``publish`` (SNK-01/05): a full refresh writes a new attempt folder; a manifest
  and then the pointer (and the catalog table) are switched when all its files
  are there, so readers never see a part of a mart, also not on a rerun of a
  published run.  Columns are checked and written by name, in contract order.
* ``clustered``: the patient mart lies in sorted buckets by study, hot studies over
  sub-keys, so M6-M8 read it without an exchange of patients.
* ``parts``: a mart in parts by a key; a version writes the parts whose rows differ from
  the version before and links the others.
* ``archive_snapshot`` (SNK-02): writes a worklist snapshot into its run's
  partition of the history, replacing only that partition, so a rerun (also
  of a half-written run) gives the same history and no row depends on its
  stamp.
* ``run_nightly``: builds M1-M10 in dependency order, independent ones at the
  same time, publishing each mart and re-reading it from storage before
  dependants use it.  That is how the source system materialises its marts, it
  keeps each plan small, and it cuts lineage: a lost executor only recomputes
  the mart being written.  A failed night resumes at its first unfinished mart.
  The reference table of M10 starts from its last published version, so a lab
  name keeps its key from night to night.
* ``quality_report``: rows, fan-out and null keys, observed by the writes.

``base`` is a folder that driver and executors share; versions are listed from
the file system.
"""

from trialmart.sinks.clustered import Clustering, measured
from trialmart.sinks.nightly import (KEYS, PARENTS, RUN_ID_FORMAT, TABLES, NightlyError, archive_snapshot, quality_report,
                                     run_id_of, run_nightly)
from trialmart.sinks.parts import Parts
from trialmart.sinks.versions import current, leftovers, manifest, publish, read_current, read_version, switch, versions

__all__ = [
    "Clustering", "KEYS", "PARENTS", "RUN_ID_FORMAT", "TABLES", "NightlyError", "Parts", "archive_snapshot", "current", "leftovers",
    "manifest", "measured", "publish", "quality_report", "read_current", "read_version", "run_id_of", "run_nightly", "switch",
    "versions",
]
