"""Full and incremental loads (FLOW-02, FLOW-03, FLT-05).

One call of ``run_load`` is one run of the job:

1. read the newest active control row (one row reaches the driver);
2. gate it: skip, no-op, full load or incremental load from the stored mark;
   take the lease of the row, so that a second run of it stops here;
3. scan the fetches that no run has loaded yet, explode them with the delta filter
   applied to the array, and write the flat set to the lake (SNK-03);
4. profile the lake's id column in one job: row count, whether ids are
   unique, and the new mark (numeric max id of this run); stop if the run
   selected nothing (the control table stays as it is);
5. join invoices and items from the lake (without a shuffle when ids are
   unique), write rows that break the NOT NULL contract to the violations
   folder and all others to the target;
6. publish the next control snapshot with the close and the open together.
   Only now readers see the run (``read_published``): a full load takes the
   place of all earlier runs at this moment, a failed one changes nothing.

All of a run's folders carry the id of its attempt, and the published row names it.  Two
runs that start from one row (a lease that ran out, say) write side by side;
one of them is published, and its rows are complete whatever the other does
before or after.  ``remove_orphans`` deletes the folders of the others.

Invoices whose id is no integer, or NULL, can't be compared with a mark; a delta writes
them to the rejects of the lake, so target, rejects and violations together
hold everything the run selected.  A reject is stored once, by id and content: rejects of
earlier runs and what a full load has taken are left out.

A report folder that holds a folder per fetch is read by fetch: every closed row lists the
fetches its run has read, and a delta opens the others only, so its work follows the new data
and not the history.  A report folder with the page files themselves is one cumulative
report, read as a whole each time.

The report is parsed once; everything after step 3 reads columnar Parquet,
so the id profile scans one nested column and the join the rest.
"""

from __future__ import annotations

import logging
import uuid
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerline import schemas
from ledgerline.functions import numeric_id, parse_watermark
from ledgerline.functions.dates import DEFAULT_TZ
from ledgerline.operators.checks import split_valid, violates
from ledgerline.operators.flatten import explode_invoices, explode_invoices_since, reject_non_numeric
from ledgerline.operators.join import id_profile, join_flat
from ledgerline.plans.control import (
    ACTION_DELTA, ACTION_FULL, ACTION_NOOP, ACTION_SKIP, ETL_NAME, FETCH_COLUMN, RunHistory, closed_runs, with_action,
)
from ledgerline.session import child_folders, delete_folder, list_children, path_exists
from ledgerline.sinks.jdbc import append_new_rows, write_jdbc
from ledgerline.sinks.parquet import (
    ATTEMPT_COLUMN, RUN_COLUMN, attempt_folder, check_columns, conform, conform_to, define_table, read_attempt, read_attempts,
    table_definition, with_run_column, write_attempt,
)
from ledgerline.sources.report import read_report

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class LoadSettings:
    report_path: str
    target_path: str
    control_path: str
    lake_path: str
    etl_name: str = ETL_NAME
    tz: str | None = DEFAULT_TZ
    null_safe: bool = False
    join_strategy: str = "auto"
    multiline: bool = False
    # A report whose invoice id repeats: "fail" stops the run before any
    # write; "join" keeps the relational join, which pairs every copy of the
    # invoice with the items of every copy (rows multiply per duplicate).
    on_duplicate_ids: str = "fail"
    # Target store: "parquet" (a folder per attempt) or "jdbc" (truncating
    # overwrite, key-checked append).
    target_format: str = "parquet"
    jdbc_url: str | None = None
    jdbc_table: str = "invoice_data"
    jdbc_driver: str | None = None
    # Whether the report path holds a folder per fetch, with names that sort in the
    # order in which the fetches land, each finished by a _SUCCESS file; None: as the
    # folder looks.  A run takes no fetch that comes after an unfinished one.  True
    # also names the newest fetch in the second filter of the next control row.
    by_fetch: bool | None = None
    # The last fetch that a run may take (to load a backlog piece by piece); None: all.
    up_to_fetch: str | None = None
    # The invoice field that a delta compares with its mark.
    filter_field: str = "id"
    # How long a run owns its control row after each of its steps, in seconds.
    lease_seconds: float = 3600.0


class DuplicateInvoiceIds(ValueError):
    """The report breaks its primary key: an invoice id occurs in several records."""


@dataclass(frozen=True)
class RunOutcome:
    action: str
    run_id: int | None
    status: str            # skipped | noop | empty | written
    mark: int | None = None
    # Invoices whose id is no integer, or NULL: a delta leaves them out, a full
    # load writes them, and they never count in the mark.  NULL when the run
    # did not read the report.
    non_numeric_ids: int | None = None
    # Joined rows that break the NOT NULL contract (see read_violations).
    violations: int | None = None
    # The attempt whose folders hold the rows, and the fetches that it read.
    attempt: str | None = None
    fetches: tuple[str, ...] | None = None


def _non_numeric_count(pages: DataFrame, field: str = "id"):
    """Invoices across all pages whose id is no integer, or NULL."""
    bad = F.filter(F.col("list"), lambda x: numeric_id(x["invoice"][field]).isNull())
    return F.coalesce(F.sum(F.size(bad)), F.lit(0))


def lake_frame(pages: DataFrame, previous, field: str = "id"):
    """The flat set a run writes to the lake, and an observation of its report.

    Invoices newer than ``previous`` are exploded with the filter applied to
    the array.  The count of non-numeric ids is collected while this frame is
    written (``observation.get["n"]`` afterwards), so it costs no extra pass.
    """
    observed = Observation()
    pages = pages.observe(observed, _non_numeric_count(pages, field).alias("n"))
    flat = explode_invoices_since(pages, previous, field=field)
    return flat.select(*[f.name for f in schemas.FLAT.fields]), observed


# --------------------------------------------------------------------- readers

def published_runs(spark: SparkSession, control_path: str, etl_name: str = ETL_NAME) -> list[tuple[int, str | None]]:
    """(run id, attempt) of the runs that are part of the table, one row per run."""
    runs = closed_runs(RunHistory(spark, control_path).table(), etl_name)
    return [(r["id"], r["attempt"]) for r in runs.select("id", "attempt").orderBy("id").collect()]


def read_target(spark: SparkSession, target_path: str) -> DataFrame:
    """The target table (DDL columns plus ``run_id``).

    The table's definition names its control table, so only published attempts are
    read; a folder without a definition is read as it is."""
    definition = table_definition(spark, target_path)
    if definition and "control_path" in definition.properties:
        runs = published_runs(spark, definition.properties["control_path"], definition.properties["etl_name"])
        return read_attempts(spark, target_path, schemas.INVOICE_DATA_DDL, runs)
    return spark.read.schema(with_run_column(schemas.INVOICE_DATA_DDL)).parquet(target_path)


def read_published(spark: SparkSession, s: LoadSettings) -> DataFrame:
    """The target as the control table publishes it: the newest closed full load
    and the closed runs after it, each from the folder of its published attempt.  Attempts
    in progress, failed, overtaken or replaced by a later full load are never listed."""
    return read_attempts(spark, s.target_path, schemas.INVOICE_DATA_DDL,
                         published_runs(spark, s.control_path, s.etl_name))


def _beside(spark: SparkSession, s: LoadSettings, path: str, schema) -> DataFrame:
    """Published rows of a table that only some runs write to."""
    there = set(child_folders(spark, path))
    runs = [(r, a) for r, a in published_runs(spark, s.control_path, s.etl_name)
            if f"{RUN_COLUMN}={r}" in there and (a is None or path_exists(spark, attempt_folder(path, r, a)))]
    return read_attempts(spark, path, schema, runs)


def read_rejects(spark: SparkSession, s: LoadSettings) -> DataFrame:
    """Invoices that delta runs could not compare with their mark, each once, with the
    run that met it first."""
    rows = _beside(spark, s, rejects_path(s), schemas.REJECTS).where("NOT coalesce(loaded, false)")
    return rows.select(*[f.name for f in schemas.FLAT.fields], RUN_COLUMN)


def read_violations(spark: SparkSession, s: LoadSettings) -> DataFrame:
    """Joined rows that break the NOT NULL contract of the target, by run."""
    return _beside(spark, s, violations_path(s), schemas.INVOICE_DATA_DDL)


def violations_path(s: LoadSettings) -> str:
    return f"{s.lake_path.rstrip('/')}_violations"


def rejects_path(s: LoadSettings) -> str:
    return f"{s.lake_path.rstrip('/')}_rejects"


# --------------------------------------------------------------------- fetches

def fetch_folders(spark: SparkSession, root: str) -> list[str]:
    """Names of the folders under a report path that may be fetches, in landing order."""
    return [n for n in child_folders(spark, root) if not n.startswith(("_", ".")) and "=" not in n]


def is_by_fetch(spark: SparkSession, s: LoadSettings) -> bool:
    """As set, or whether the report path holds folders and no finished report of its own."""
    if s.by_fetch is not None:
        return s.by_fetch
    return not path_exists(spark, f"{s.report_path.rstrip('/')}/_SUCCESS") and bool(fetch_folders(spark, s.report_path))


def pending_fetches(spark: SparkSession, root: str, loaded, up_to: str | None = None) -> list[str]:
    """The finished fetches that are not loaded yet, up to the first unfinished one (or to ``up_to``)."""
    root, loaded, found = root.rstrip("/"), set(loaded), []
    for name in fetch_folders(spark, root):
        if name in loaded:
            continue
        if up_to is not None and name > up_to:
            break
        if not path_exists(spark, f"{root}/{name}/_SUCCESS"):
            break
        found.append(name)
    return found


def loaded_fetches(history: DataFrame, etl_name: str = ETL_NAME) -> list[str]:
    """The fetches that the runs of the table have read, as their rows record them."""
    names = closed_runs(history, etl_name).select(F.explode("fetches").alias("name")).distinct()
    return sorted(r["name"] for r in names.collect())


def new_pages(spark: SparkSession, s: LoadSettings, action: str, version: int | None = None):
    """(the report pages of a run, names of their fetches; None for a whole report)."""
    if not is_by_fetch(spark, s):
        return read_report(spark, s.report_path, multiline=s.multiline), None
    loaded = loaded_fetches(RunHistory(spark, s.control_path).table(version), s.etl_name) if action == ACTION_DELTA else []
    names = pending_fetches(spark, s.report_path, loaded, s.up_to_fetch)
    if not names:
        return spark.createDataFrame([], schemas.PAGE), []
    return read_report(spark, [f"{s.report_path.rstrip('/')}/{n}" for n in names], multiline=s.multiline), names


# --------------------------------------------------------------------- rejects

def with_digest(flat: DataFrame) -> DataFrame:
    """``flat`` with the digest of each invoice's id and content."""
    return flat.withColumn("digest", F.sha2(F.to_json("flat_invoice"), 256))


def _write_rejects(spark: SparkSession, s: LoadSettings, pages: DataFrame, lake: DataFrame, run_id: int,
                   attempt: str, delta: bool) -> None:
    """What a mark can't be compared with: the digests a load has taken, or, in a delta,
    the invoices that no published run has met."""
    columns = [f.name for f in schemas.REJECTS.fields]
    if not delta:
        taken = with_digest(reject_non_numeric(lake, s.filter_field)).select("digest").distinct()
        empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.FLAT.fields]
        rows = taken.select(*empty, "digest", F.lit(True).alias("loaded"))
    else:
        known = _beside(spark, s, rejects_path(s), schemas.REJECTS).select("digest")
        fresh = with_digest(reject_non_numeric(explode_invoices(pages), s.filter_field)).dropDuplicates(["digest"])
        rows = fresh.join(known, "digest", "left_anti").withColumn("loaded", F.lit(False))
    write_attempt(rows.select(*columns), rejects_path(s), run_id, attempt)


# ------------------------------------------------------------------------- run

def run_load(spark: SparkSession, s: LoadSettings, run_ts: int | None = None) -> RunOutcome:
    """Run the job once.  Raises RunInProgress when another run owns the control row."""
    history = RunHistory(spark, s.control_path)
    version = history.current_version()
    rows = with_action(history.active_run(s.etl_name, version)).collect()
    if not rows:                      # no active row: the documented fallback is to skip
        return RunOutcome(ACTION_SKIP, None, "skipped")
    row = rows[0]
    action, run_id = row["action"], row["id"]
    if action in (ACTION_SKIP, ACTION_NOOP):
        return RunOutcome(action, run_id, "skipped" if action == ACTION_SKIP else "noop")
    previous = parse_watermark(row["filter_col1_value"]) if action == ACTION_DELTA else None

    attempt = uuid.uuid4().hex
    lease = history.lease(run_id, attempt, s.lease_seconds, s.etl_name)
    lease.take()
    try:
        outcome = _load(spark, s, history, version, row, previous, attempt, lease, run_ts)
    finally:
        lease.release()
    return replace(outcome, attempt=attempt)


def _load(spark, s: LoadSettings, history: RunHistory, version, row, previous, attempt: str, lease, run_ts) -> RunOutcome:
    action, run_id = row["action"], row["id"]
    pages, fetches = new_pages(spark, s, action, version)
    read = None if fetches is None else tuple(fetches)
    flat, observed = lake_frame(pages, previous, s.filter_field)
    write_attempt(flat, s.lake_path, run_id, attempt)
    n_bad = int(observed.get["n"])
    lake = read_attempt(spark, s.lake_path, schemas.FLAT, run_id, attempt)

    # One pass over the lake's id column: emptiness, id uniqueness, new mark.
    n_rows, unique, mark = id_profile(lake, s.filter_field)
    if n_bad:
        log.warning("run %s: %d invoices have a non-numeric id", run_id, n_bad)
        _write_rejects(spark, s, pages, lake, run_id, attempt, delta=bool(previous and previous > 0))
    if n_rows == 0:                   # FLT-05: nothing new, history untouched
        if action == ACTION_FULL and s.target_format == "parquet":
            # SNK-05: the target exists after a full load even when it wrote nothing.
            _define_target(spark, s)
        return RunOutcome(action, run_id, "empty", previous, n_bad, fetches=read)

    if not unique and s.on_duplicate_ids == "fail":
        raise DuplicateInvoiceIds(
            f"run {run_id}: invoice ids repeat across report records; "
            "see operators.join.duplicate_ids, or set on_duplicate_ids='join'")
    strategy = s.join_strategy
    if strategy == "auto":
        strategy = "nested" if unique else "shuffle"
    everything = conform(join_flat(lake, s.tz, s.null_safe, strategy), schemas.INVOICE_DATA_DDL)
    broken = Observation()
    joined, _ = split_valid(everything.observe(broken, F.coalesce(F.sum(F.when(
        violates(schemas.INVOICE_DATA_NOT_NULL), 1)), F.lit(0)).alias("n")), schemas.INVOICE_DATA_NOT_NULL)
    lease.renew()
    if s.target_format == "jdbc":
        # The JDBC target carries run_id too, so a retried run checks only
        # its own earlier rows (``run_id = N`` is pushed to the database).
        out = joined.withColumn(RUN_COLUMN, F.lit(run_id).cast("bigint"))
        if action == ACTION_FULL:
            write_jdbc(out, s.jdbc_url, s.jdbc_table, "overwrite", s.jdbc_driver)
        else:
            append_new_rows(spark, out, s.jdbc_url, s.jdbc_table, s.jdbc_driver,
                            scope=F.col(RUN_COLUMN) == F.lit(run_id))
    else:
        _define_target(spark, s)
        write_attempt(conform_to(joined, schemas.INVOICE_DATA_TABLE, s.target_path), s.target_path, run_id, attempt)
    n_broken = int(broken.get["n"])
    if n_broken:
        log.warning("run %s: %d rows break the NOT NULL contract", run_id, n_broken)
        _, invalid = split_valid(everything, schemas.INVOICE_DATA_NOT_NULL)
        write_attempt(invalid, violations_path(s), run_id, attempt)
    if mark is None:                  # no numeric id in this run: keep the old mark
        mark = previous if previous else None
    lease.renew()
    history.close_and_open(run_id, mark, s.etl_name, run_ts, based_on=version, attempt=attempt, fetches=fetches,
                           fetch=_newest_fetch(row, fetches) if s.by_fetch else None)
    log.info("run %s (%s) written, mark %s", run_id, action, mark)
    return RunOutcome(action, run_id, "written", mark, n_bad, n_broken, fetches=read)


def _newest_fetch(row, fetches: list[str]) -> str | None:
    seen = [row["filter_col2_value"]] if row["filter_col2_name"] == FETCH_COLUMN and row["filter_col2_value"] else []
    return max([*seen, *fetches], default=None)


def _define_target(spark: SparkSession, s: LoadSettings) -> None:
    schema = StructType([*with_run_column(schemas.INVOICE_DATA_TABLE).fields, StructField(ATTEMPT_COLUMN, StringType())])
    define_table(spark, s.target_path, schema, [RUN_COLUMN, ATTEMPT_COLUMN],
                 {"control_path": s.control_path, "etl_name": s.etl_name})
    # A table of another shape is refused before anything is written to it.
    check_columns(schema, table_definition(spark, s.target_path).schema, s.target_path)


def remove_orphans(spark: SparkSession, s: LoadSettings, superseded: bool = False) -> list[str]:
    """Delete the folders of attempts that were not published and never can be, as their run is
    closed; with ``superseded`` also those of runs before the newest full load (a reader that
    started before that load was published may still need them).  Returns the folders."""
    table = RunHistory(spark, s.control_path).table().where(F.col("etl_name") == s.etl_name)
    closed = {r["id"]: r["attempt"] for r in table.where("is_active <> 'Y'").select("id", "attempt").collect()}
    current = {r for r, _ in published_runs(spark, s.control_path, s.etl_name)}
    gone = []
    for root in (s.target_path, s.lake_path, rejects_path(s), violations_path(s)):
        for run_id, attempt in closed.items():
            run = f"{root.rstrip('/')}/{RUN_COLUMN}={run_id}"
            for name in list_children(spark, run):
                own = name == f"{ATTEMPT_COLUMN}={attempt}"
                if name.startswith(f"{ATTEMPT_COLUMN}=") and (not own or (superseded and run_id not in current)):
                    delete_folder(spark, f"{run}/{name}")
                    gone.append(f"{run}/{name}")
    return gone
