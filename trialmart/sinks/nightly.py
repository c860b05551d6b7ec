"""The nightly run: all marts in dependency order, several at a time, resumable."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Iterable
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialmart.plans import (build_accruals, build_calendar, build_enrollments, build_patient,
                             build_statuses, build_study, build_study_current, build_study_team)
from trialmart.plans.contracts import MART_SCHEMAS
from trialmart.plans.worklist import (build_worklist, current_calendar_names, emr_activity,
                                      industrial_patients, register_new_codes)
from trialmart.quality import Watch
from trialmart.sinks.clustered import Clustering, close_buckets, measured
from trialmart.sinks.parts import Parts
from trialmart.sinks.versions import manifest, publish, read_version, switch, versions
from trialmart.sources import SourceSet

RUN_ID_FORMAT = "%Y%m%d%H%M%S"

#: Names under which consumers read the marts (fixed values).
TABLES = {
    "study": "dm_study", "study_current": "dm_study_current", "patient": "dm_patient",
    "calendar": "dm_calendar", "study_team": "dm_study_team", "accruals": "dm_accruals",
    "enrollments": "dm_patient_enrollments", "statuses": "dm_patient_statuses",
    "lab_refs": "ref_labs_cpts", "worklist": "dm_PharmaPats_YDA", "worklist_history": "dm_PharmaPats_H",
}
#: Marts that a mart reads.
PARENTS = {
    "study": [], "patient": [], "calendar": [], "study_team": [], "lab_refs": [],
    "study_current": ["study"], "accruals": ["study_current", "patient"], "enrollments": ["study_current", "patient"],
    "statuses": ["study_current", "patient"], "worklist": ["study_current", "patient", "calendar", "lab_refs"],
}
#: Columns whose nulls the quality report counts.
KEYS = {
    "study": ["pkStudy_st", "pkStudyStat_stst"], "study_current": ["pkStudy_st", "pkStudyStat_stst"],
    "patient": ["pkPatProt_pp", "pkStudy_st", "pkPerson_p"], "calendar": ["pkEventID_ea", "pkEventID_se1", "pkPerson_p"],
    "study_team": ["pkStudyTeam_sttm", "pkStudy_st"], "accruals": ["pkStudy_st"], "enrollments": ["pkStudy_st"],
    "statuses": ["pkStudy_st", "pkPatProt_pp"], "lab_refs": ["lc_idx", "labdesc"], "worklist": ["MRN_mq"],
}

#: The column with the time of the run, one value throughout a mart.
STAMP = "xDMrunDt"


class NightlyError(RuntimeError):
    """Some marts failed; ``failed`` has their errors, ``skipped`` the marts that depend on them."""

    def __init__(self, failed: dict[str, BaseException], skipped: list[str], paths: dict[str, str]):
        super().__init__(f"failed: {', '.join(f'{m} ({e})' for m, e in failed.items())}; not built: {', '.join(skipped) or 'none'}")
        self.failed, self.skipped, self.paths = failed, skipped, paths


def run_id_of(run_ts: _dt.datetime | str) -> str:
    if isinstance(run_ts, str):
        run_ts = _dt.datetime.fromisoformat(run_ts)
    return run_ts.strftime(RUN_ID_FORMAT)


def archive_snapshot(spark: SparkSession, snapshot: str | DataFrame, history_path: str, run_id: str,
                     table: str | None = None) -> None:
    """Put all rows of the snapshot (its folder, or its rows) into partition ``run_id`` of the history, replacing that
    partition only."""
    rows = spark.read.parquet(snapshot) if isinstance(snapshot, str) else snapshot
    (rows.drop("run_id").withColumn("run_id", F.lit(run_id))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(history_path))
    if table:
        if not spark.catalog.tableExists(table):
            spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{history_path}'")
        spark.sql(f"MSCK REPAIR TABLE {table}")
        spark.catalog.refreshTable(table)


def _in_order(names: list[str], work: Callable[[str], None], parallel: int) -> tuple[dict[str, BaseException], list[str]]:
    """Run ``work`` for every name once its parents are done, ``parallel`` at a time: (errors, names left out)."""
    waiting, done, failed = list(names), set(), {}
    running: dict[Future, str] = {}
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        while True:
            ready = [n for n in waiting if set(PARENTS[n]) <= done]
            for name in ready[: parallel - len(running)]:
                waiting.remove(name)
                running[pool.submit(work, name)] = name
            if not running:
                return failed, waiting
            for future in wait(running, return_when=FIRST_COMPLETED).done:
                name = running.pop(future)
                if error := future.exception():
                    failed[name] = error
                else:
                    done.add(name)


def run_nightly(spark: SparkSession, src: SourceSet, base: str, run_ts: _dt.datetime | str | None = None,
                tables: bool = False, lab_code_mode: str = "anti", timer=None, parallel: int = 4,
                resume: bool = False, collation: str | None = None, changed_only: bool = False) -> dict[str, str]:
    """Build and publish all marts under ``base``; returns ``{mart: path}``.

    ``lab_code_mode`` is M10's rule: ``anti`` adds each unknown lab name once;
    ``faithful`` re-adds names whose mapping has no status, every night.
    ``collation`` is how M9 and M10 compare text (``operators.ACCENTLESS`` for a
    source system that ignores case, accents and trailing blanks).
    ``timer(name, fn)`` may wrap each step (the bench uses it).

    Up to ``parallel`` marts that don't depend on each other are written at the
    same time, each in its own scheduler pool.  A mart that fails stops only what
    depends on it; the others are published before ``NightlyError`` is raised.
    With ``resume``, marts that this run already published from the same inputs
    are taken as they are; the sources must not have changed since.

    With ``changed_only``, all marts but the patient mart (which lies in buckets)
    are stored in parts by their first key, and a night writes only parts whose
    rows differ from the version before, run stamps apart.  Read such marts by
    ``read_current`` or their view, not by the path.
    """
    if run_ts is None:
        run_ts = _dt.datetime.now().replace(microsecond=0)
    rid = run_id_of(run_ts)
    run_time = _dt.datetime.fromisoformat(str(run_ts)).isoformat(" ")
    timer = timer or (lambda name, fn: fn())
    paths: dict[str, str] = {}

    buckets: dict[str, Clustering] = {}

    def published(name: str) -> DataFrame:
        return read_version(spark, manifest(spark, base, name, rid), clustered=True)

    def earlier(name: str) -> dict | None:
        """The last version before this run's."""
        known = [v for v in versions(spark, base, name) if v < rid]
        return manifest(spark, base, name, known[-1]) if known else None

    def lab_refs() -> DataFrame:
        before = earlier("lab_refs")
        known = read_version(spark, before) if before else src["ref_labs_cpts"]
        return register_new_codes(src["mq_labs_90days"], known, run_ts, lab_code_mode, collation)

    def worklist() -> DataFrame:
        patients = industrial_patients(published("study_current"), published("patient"), collation)
        activity = emr_activity(src["mq_appointments"], src["mq_chemos"], src["mq_labs"], patients, collation)
        names = current_calendar_names(published("calendar"), collation)
        return build_worklist(activity, patients, published("lab_refs"), names, run_ts, collation)

    build: dict[str, Callable[[], DataFrame]] = {
        "study": lambda: build_study(src, run_ts),
        "patient": lambda: build_patient(src, run_ts),
        "calendar": lambda: build_calendar(src, run_ts),
        "study_team": lambda: build_study_team(src, run_ts),
        "lab_refs": lab_refs,
        "study_current": lambda: build_study_current(published("study"), src, run_ts),
        "accruals": lambda: build_accruals(published("study_current"), published("patient"), run_ts, buckets.get("patient")),
        "enrollments": lambda: build_enrollments(published("study_current"), published("patient"), run_ts, buckets.get("patient")),
        "statuses": lambda: build_statuses(published("study_current"), published("patient"), run_ts, buckets.get("patient")),
        "worklist": worklist,
    }

    def write(name: str, inputs: dict[str, str]) -> str:
        if name == "patient":  # read by study in M6-M8
            buckets[name] = measured(src["er_patprot"], "fk_study", "pkStudy_st", "pkPatStudyStat_pps")
        parts = None
        if changed_only and name not in buckets:
            stamped = {STAMP: f"TIMESTAMP_NTZ '{run_time}'"} if STAMP in MART_SCHEMAS[name].names else {}
            parts = Parts(KEYS[name][0], stamped)
        with Watch() as watch:
            return publish(build[name](), base, name, rid, TABLES[name] if tables else None, MART_SCHEMAS[name], inputs,
                           KEYS[name], watch, buckets.get(name), parts)

    def step(name: str) -> None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        inputs = {parent: paths[parent] for parent in PARENTS[name]}
        if name == "lab_refs":
            inputs = {"mode": lab_code_mode, "collation": collation or "", "before": (earlier("lab_refs") or {}).get("path", "")}
        done = manifest(spark, base, name, rid) if resume else None
        if done and done["inputs"] == inputs:
            switch(spark, base, name, done, TABLES[name] if tables else None)
            paths[name] = done["path"]
            if done.get("clustering"):
                buckets[name] = Clustering(**done["clustering"])
                published(name)  # the catalog entry, before several marts want it
            return
        if name == "worklist" and (previous := earlier("worklist")):
            # archive the previous snapshot before the new one replaces it
            archive_snapshot(spark, read_version(spark, previous), f"{base}/worklist_history", previous["run_id"],
                             TABLES["worklist_history"] if tables else None)
        paths[name] = timer(name, lambda: write(name, inputs))

    src.check_keys()
    try:
        failed, skipped = _in_order(list(build), step, parallel)
    finally:
        for name in buckets:
            if name in paths:
                close_buckets(spark, paths[name])
    if failed:
        raise NightlyError(failed, skipped, paths)
    return paths


def quality_report(spark: SparkSession, base: str, run_id: str, marts: Iterable[str] = tuple(PARENTS)) -> DataFrame:
    """One row per published mart of a run: rows, rows of its driving relation, fan-out, null keys, rows of the run before.

    Read from the manifests; nothing is counted again.  ``fan_out_milli`` is 1000 x rows / driving rows.
    """
    rows = []
    for mart in marts:
        version = manifest(spark, base, mart, run_id)
        if version is None:
            continue
        before = [v for v in versions(spark, base, mart) if v < run_id]
        driving = version["metrics"].get("driving", {}).get("rows")
        nulls = {k.removeprefix("null_"): n for k, n in version["metrics"]["written"].items() if k.startswith("null_")}
        rows.append((mart, run_id, version["rows"], driving, 1000 * version["rows"] // driving if driving else None, nulls,
                     manifest(spark, base, mart, before[-1])["rows"] if before else None))
    return spark.createDataFrame(rows, "mart string, run_id string, rows bigint, driving_rows bigint, fan_out_milli bigint, "
                                       "null_keys map<string, bigint>, rows_before bigint")
