"""Registered queries: every operator over the whole test tables.

Unless a query is about the look-back or the cap, it takes all days and has no
cap. Arrays and timestamps are shown as
text so that results compare across engines.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import derived
from faultsift.functions.fingerprint import normalized_error, stack_functions
from faultsift.functions.issue import choice_label, choice_short, issue_body, issue_title
from faultsift.functions.pointers import storage_uri
from faultsift.functions.text import upper_text
from faultsift.operators import endpoints, ledger
from faultsift.operators.filters import actionable, first_message, lookback, positive_days
from faultsift.operators.payloads import (
    join_payloads,
    rejects,
    with_context,
    with_fingerprint,
    with_outcome,
)
from faultsift.operators.ranking import dedup_key, newest_per_key
from faultsift.plans import triage
from faultsift.plans.report import run_summary
from faultsift.plans.run import run_triage
from faultsift.schemas import CANDIDATES, CHOICES, INCIDENT_COLUMNS, LEDGER_COLUMNS
from faultsift.session import configure, work_folder
from faultsift.sources.drafts import DRAFTS, issue_drafts
from faultsift.sources.endpoints import read_endpoint_states, start_endpoint_states
from faultsift.sources.investigations import decode_lines, read_investigation_stream
from faultsift.sources.ledger import (
    append_ledger,
    init_ledger,
    read_ledger,
    read_ledger_log,
    record_posted,
)
from faultsift.sources.newest import read_candidates, start_newest
from faultsift.sources.objects import write_objects
from faultsift.sources.payloads import (
    land_payloads,
    open_payload_table,
    pack_payloads,
    read_payload_objects,
)
from faultsift.sources.runs import read_runs
from faultsift.streaming.intake import start_first_arrivals, start_triage

# The look-back of the queries about it, and all of the test data.
DAYS, ALL_DAYS = 20, 31

# The newest candidates of the queries about the cap.
CAP = 500

# Buckets of a landed payload table; thousands on a cluster.
BUCKETS = 16


class Inputs:
    """The triage inputs of one data directory, and the steps over them."""

    def __init__(self, spark: SparkSession, sf_dir: str, days: int, cap: int | None = None):
        self.spark = configure(spark)
        self.sf_dir = sf_dir
        self.days = days
        self.cap = cap

    @cached_property
    def events(self) -> DataFrame:
        return derived.read_events(self.spark, self.sf_dir)

    @cached_property
    def investigations(self) -> DataFrame:
        return derived.investigations(self.events)

    @cached_property
    def payloads(self) -> DataFrame:
        return derived.payloads(self.events)

    @cached_property
    def versions(self) -> DataFrame:
        return derived.endpoint_versions(self.events)

    @cached_property
    def as_of(self) -> Column:
        return derived.as_of(self.events)

    @cached_property
    def recent(self) -> DataFrame:
        return actionable(lookback(self.investigations, self.days, self.as_of))

    @cached_property
    def candidates(self) -> DataFrame:
        return triage.candidates(self.investigations, self.days, self.as_of, self.cap)

    @cached_property
    def joined(self) -> DataFrame:
        return join_payloads(self.candidates, self.payloads)

    @cached_property
    def outcomes(self) -> DataFrame:
        return triage.outcomes(self.candidates, self.payloads)

    @cached_property
    def incidents(self) -> DataFrame:
        return triage.incidents(self.candidates, self.payloads)

    @cached_property
    def unique(self) -> DataFrame:
        """Written once: ledger, approvals and endpoints derive from it too."""
        rows = triage.distinct_incidents(self.candidates, self.payloads)
        path = work_folder(self.spark, "unique")
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    @cached_property
    def enriched(self) -> DataFrame:
        return triage.with_endpoints(self.unique, self.versions)

    @cached_property
    def ledger(self) -> DataFrame:
        return derived.ledger(self.unique)

    @cached_property
    def fresh(self) -> DataFrame:
        return triage.with_endpoints(ledger.unsolved(self.unique, self.ledger), self.versions)

    @cached_property
    def approvals(self) -> DataFrame:
        return derived.approvals(self.unique)


def time_text(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def joined_text(column: str) -> Column:
    return F.array_join(column, ",").alias(column)


def show_incidents(rows: DataFrame) -> DataFrame:
    shown = {"timestamp": time_text("timestamp").alias("ts")}
    shown["throwing_functions"] = joined_text("throwing_functions")
    columns = [shown.get(name, F.col(name)) for name in INCIDENT_COLUMNS]
    if "endpoint_path" in rows.columns:
        columns += [F.col("endpoint_path"), joined_text("endpoint_methods")]
    return rows.select(*columns)


def show_investigations(rows: DataFrame) -> DataFrame:
    scalars = [
        "account_id", "stable_runtime_scope_id", "session_id", "environment_id",
        "environment_name", "service_id", "service_name", "endpoint_id", "endpoint_uuid",
        "flow_type", "version", "s3_pointer",
    ]
    first_functions = F.get(F.col("exceptions_data.functions"), F.lit(0))
    total = F.aggregate(
        F.map_values("function_ids"), F.lit(0).cast("bigint"), lambda acc, x: acc + x
    )
    first_ids = F.get(F.col("exceptions_data_enriched.ids"), F.lit(0))
    return rows.select(
        *scalars,
        time_text("timestamp").alias("ts"),
        first_message().alias("first_message"),
        F.array_join(first_functions, ",").alias("first_functions"),
        F.array_join(F.map_keys("function_ids"), ",").alias("function_names"),
        total.alias("function_id_sum"),
        F.coalesce(F.get(first_ids, F.lit(0)), F.lit(-1)).alias("first_id"),
    )


def show_ledger(rows: DataFrame) -> DataFrame:
    return rows.withColumn("created_at", time_text("created_at")).select(*LEDGER_COLUMNS)


def show_drafts(rows: DataFrame) -> DataFrame:
    return rows.withColumn("labels", joined_text("labels"))


def show_endpoints(info: DataFrame) -> DataFrame:
    return info.withColumn("endpoint_methods", joined_text("endpoint_methods"))


def lookback_filter(t: Inputs) -> DataFrame:
    recent = lookback(t.investigations, 3, t.as_of)
    return recent.select("session_id", "service_name", time_text("timestamp").alias("ts"))


def days_argument(t: Inputs) -> DataFrame:
    recent = lookback(t.investigations, positive_days(" 7 "), t.as_of)
    return recent.select("session_id", "service_name", time_text("timestamp").alias("ts"))


def noise_filter(t: Inputs) -> DataFrame:
    return actionable(t.investigations).select(
        "session_id", "s3_pointer", first_message().alias("first_message")
    )


def dedup_keys(t: Inputs) -> DataFrame:
    return t.investigations.select("session_id", dedup_key().alias("dedup_key"))


def latest_per_key(t: Inputs) -> DataFrame:
    return newest_per_key(t.recent).select(
        "session_id", dedup_key().alias("dedup_key"), time_text("timestamp").alias("ts")
    )


def latest_per_key_stored(t: Inputs) -> DataFrame:
    """The same for a look-back, from newest rows by day that three batches added."""
    folder = work_folder(t.spark, "newest")
    for part in range(3):
        rows = derived.investigations(t.events.where(f"{derived.PART} = {part}"))
        rows.write.mode("append").parquet(f"{folder}/rows")
        start_newest(
            read_investigation_stream(t.spark, f"{folder}/rows"), f"{folder}/days", every=2
        ).awaitTermination()
    found = read_candidates(t.spark, f"{folder}/days", t.days, t.as_of)
    return found.select(
        "session_id", dedup_key(F.col("first_message")).alias("dedup_key"),
        time_text("timestamp").alias("ts"),
    )


def recent_candidates(t: Inputs) -> DataFrame:
    return show_investigations(
        triage.recent_investigations(t.investigations, t.days, t.as_of, t.cap)
    )


def pointer_to_uri(t: Inputs) -> DataFrame:
    return t.investigations.select(
        "session_id", "s3_pointer", storage_uri(F.col("s3_pointer")).alias("obj_uri")
    )


def jsonrow_decode(t: Inputs) -> DataFrame:
    """Investigations written as JSON text with unnamed tuples, then decoded."""

    def quoted(column: str) -> Column:
        return F.col(column).cast("string").alias(column)

    flat = t.investigations.select(
        F.to_json(
            F.struct(
                "account_id", "stable_runtime_scope_id", "session_id",
                quoted("environment_id"), "environment_name", "service_id", "service_name",
                quoted("endpoint_id"), "endpoint_uuid", "flow_type", "version", "s3_pointer",
                time_text("timestamp").alias("timestamp"), "function_ids",
            )
        ).alias("scalars"),
        _tuples_json("exceptions_data", "functions").alias("exceptions"),
        _tuples_json("exceptions_data_enriched", "ids").alias("enriched"),
    )
    line = F.concat(
        F.expr("substring(scalars, 1, length(scalars) - 1)"),
        F.lit(',"exceptions_data":'), "exceptions",
        F.lit(',"exceptions_data_enriched":'), "enriched", F.lit("}"),
    )
    return show_investigations(decode_lines(flat.select(line.alias("line")), "line"))


def payload_join(t: Inputs) -> DataFrame:
    return t.joined.select("session_id", "obj_uri", "body")


def payload_fields(t: Inputs) -> DataFrame:
    return t.incidents.select(F.col("id").alias("session_id"), "error_message", "stack_trace")


def payload_context(t: Inputs) -> DataFrame:
    return with_context(t.joined).select("session_id", F.to_json("context").alias("context"))


def payload_rejects(t: Inputs) -> DataFrame:
    return rejects(t.outcomes)


def stack_function_lists(t: Inputs) -> DataFrame:
    frames = stack_functions(F.col("payload_stack"))
    rows = with_outcome(t.joined).withColumn("stack_functions", frames)
    return rows.where((F.col("outcome") == "ok") & (F.size("stack_functions") > 0)).select(
        "session_id", joined_text("stack_functions")
    )


def throwing_function_lists(t: Inputs) -> DataFrame:
    return t.incidents.select(F.col("id").alias("session_id"), joined_text("throwing_functions"))


def normalized_errors(t: Inputs) -> DataFrame:
    return t.incidents.select(
        F.col("id").alias("session_id"),
        normalized_error(F.col("error_message")).alias("normalized_error"),
    )


def root_cause_hashes(t: Inputs) -> DataFrame:
    return t.incidents.select("id", "root_cause_hash")


def endpoint_latest(t: Inputs) -> DataFrame:
    return show_endpoints(endpoints.endpoint_info(endpoints.endpoint_states(t.versions)))


def endpoint_state_merge(t: Inputs) -> DataFrame:
    """States of older and of newer versions, kept apart and merged afterwards."""
    older = endpoints.endpoint_states(t.versions.where("ver < 2"))
    newer = endpoints.endpoint_states(t.versions.where("ver >= 2"))
    return show_endpoints(endpoints.endpoint_info(endpoints.merge_states(older, newer)))


def endpoint_states_stored(t: Inputs) -> DataFrame:
    """States kept from run to run: three increments of versions, of which two were merged again."""
    folder = work_folder(t.spark, "states")
    for part in range(3):
        t.versions.where(f"ver % 3 = {part}").write.mode("append").parquet(f"{folder}/versions")
        start_endpoint_states(t.spark, f"{folder}/versions", f"{folder}/states", every=2).awaitTermination()
    stored = read_endpoint_states(t.spark, f"{folder}/states")
    return show_endpoints(endpoints.endpoint_info(endpoints.merge_states(stored)))


def endpoint_wanted(t: Inputs) -> DataFrame:
    wanted = endpoints.wanted_versions(t.versions, t.unique)
    return wanted.withColumn("methods", joined_text("methods"))


def endpoints_by_id(t: Inputs) -> DataFrame:
    found = endpoints.endpoints_by_id(t.versions, "acct-1", "prod", [1, 3, 7, 8, 9, 11])
    return found.withColumn("methods", joined_text("methods"))


def ledger_lookup(t: Inputs) -> DataFrame:
    """Rows of given fingerprints, those of one message thrown by one function."""
    texts = [f"division by zero|fn{n}.run" for n in range(40)]
    hashes = [hashlib.sha256(text.encode()).hexdigest() for text in texts]
    return show_ledger(ledger.lookup(t.ledger, hashes))


def ledger_upsert(t: Inputs) -> DataFrame:
    """Two ledger runs, written and read back."""
    path = f"{work_folder(t.spark, 'ledger')}/ledger"
    init_ledger(t.spark, path)
    append_ledger(t.ledger, path, run=1)
    solved = read_ledger_log(t.spark, path)
    posted = ledger.solved_rows(derived.posted_issues(t.unique), solved, t.as_of)
    append_ledger(posted, path, run=2)
    return show_ledger(read_ledger(t.spark, path))


def approved_drafts(t: Inputs) -> DataFrame:
    return show_drafts(issue_drafts(ledger.approved(t.fresh, t.approvals)))


def landed_payload_join(t: Inputs) -> DataFrame:
    """Candidates looked up in a payload table landed in two parts, of which one is packed."""
    path = f"{work_folder(t.spark, 'payloads')}/landed"
    land_payloads(t.payloads.where("hash(obj_uri) % 2 = 0"), path, BUCKETS)
    pack_payloads(t.spark, path)
    land_payloads(t.payloads.where("hash(obj_uri) % 2 <> 0"), path)
    joined = join_payloads(t.candidates, open_payload_table(t.spark, path))
    return joined.select("session_id", "obj_uri", "body")


def payload_objects_join(t: Inputs) -> DataFrame:
    """Payloads written as one file each, landed in one listing and joined to pointers at the files."""
    folder = work_folder(t.spark, "objects")
    path = f"{work_folder(t.spark, 'payloads')}/landed"
    write_objects(t.joined.select("session_id", "body"), folder, "session_id")
    land_payloads(read_payload_objects(t.spark, folder, "s3a://copy/flows"), path, BUCKETS)
    objects = open_payload_table(t.spark, path)
    owner = F.regexp_extract("obj_uri", "session_id=([^/]+)/", 1)
    pointers = objects.rows.select(
        owner.alias("session_id"), F.replace("obj_uri", F.lit("s3a:"), F.lit("s3:")).alias("ptr")
    )
    found = t.candidates.join(pointers, "session_id").withColumn("s3_pointer", F.col("ptr"))
    return join_payloads(found.drop("ptr"), objects).select("session_id", "body")


def _run(t: Inputs, found: DataFrame, out: str, writer: str = "batch", **more) -> DataFrame:
    return run_triage(
        found, t.payloads, t.versions, out, f"{out}/ledger", writer, **more
    )


def triage_run(t: Inputs) -> DataFrame:
    """Drafts of one whole batch run with a ledger and approvals."""
    out = work_folder(t.spark, "run")
    init_ledger(t.spark, f"{out}/ledger")
    append_ledger(t.ledger, f"{out}/ledger", run=0)
    _run(t, t.candidates, out, approvals=t.approvals)
    return show_drafts(read_runs(t.spark, DRAFTS, f"{out}/drafts").drop("run"))


def choices(t: Inputs) -> DataFrame:
    """What a run offers for approval."""
    out = work_folder(t.spark, "choices")
    init_ledger(t.spark, f"{out}/ledger")
    append_ledger(t.ledger, f"{out}/ledger", run=0)
    _run(t, t.candidates, out, approvals=t.approvals.limit(0))
    return read_runs(t.spark, CHOICES, f"{out}/choices").drop("run")


def posted_ledger(t: Inputs) -> DataFrame:
    """A run's drafts, of which some are posted, in the ledger."""
    out = work_folder(t.spark, "posted")
    _run(t, t.candidates, out)
    drafts = read_runs(t.spark, DRAFTS, f"{out}/drafts")
    record_posted(t.spark, derived.posted_issues(drafts), f"{out}/ledger", "poster")
    return read_ledger(t.spark, f"{out}/ledger").select(
        "root_cause_hash", "github_issue_number", "error_pattern"
    )


def empty_run(t: Inputs) -> DataFrame:
    """The summary of a run that found nothing, after one of the same name that did."""
    out = work_folder(t.spark, "empty")
    _run(t, t.candidates, out)
    return _run(t, t.candidates.where("timestamp < '1970-01-01'"), out)


def _stream(t: Inputs, events: str, out: str, name: str, files_a_batch: int = 1000) -> None:
    start_triage(
        derived.investigations(derived.stream_events(t.spark, events, files_a_batch)),
        lambda: t.payloads, lambda: t.versions, out, f"{out}/ledger", f"{out}/{name}",
    ).awaitTermination()


def _drafts_a_cause(t: Inputs, out: str) -> DataFrame:
    drafts = read_runs(t.spark, DRAFTS, f"{out}/drafts")
    return drafts.groupBy("root_cause_hash").agg(F.count("*").alias("drafts"))


def ledger_mixed_runs(t: Inputs) -> DataFrame:
    """A batch run, a stream, and the stream again from a new checkpoint, on one ledger."""
    out = work_folder(t.spark, "mixed")
    found = triage.candidates(t.investigations, ALL_DAYS, t.as_of)
    _run(t, found.where("service_name < 'svc-4'"), out)
    t.events.coalesce(1).write.parquet(f"{out}/events")
    for name in ("first", "second"):
        _stream(t, f"{out}/events", out, name)
    return _drafts_a_cause(t, out)


def summary(t: Inputs) -> DataFrame:
    return run_summary(with_fingerprint(t.outcomes), t.ledger, t.approvals)


def upper_texts(t: Inputs) -> DataFrame:
    path = f"{t.sf_dir}/conversations.parquet"
    rows = t.spark.read.schema(derived.CONVERSATIONS).parquet(path)
    return rows.select("conv_id", "turn", upper_text(F.col("text")).alias("text"))


def stream_new_incidents(t: Inputs) -> DataFrame:
    """Drafts of a stream of three batches, against a ledger from an earlier run."""
    out = work_folder(t.spark, "stream")
    derived.parted_events(t.events, f"{out}/events")
    found = t.spark.createDataFrame([], CANDIDATES)
    for part in range(3):
        rows = actionable(derived.investigations(t.events.where(f"{derived.PART} = {part}")))
        found = found.unionByName(newest_per_key(triage.slim(rows), F.col("first_message")))
    causes = triage.distinct_incidents(found, t.payloads)
    init_ledger(t.spark, f"{out}/ledger")
    append_ledger(derived.ledger(causes), f"{out}/ledger", run=0)
    _stream(t, f"{out}/events", out, "checkpoint", files_a_batch=1)
    return _drafts_a_cause(t, out)


def stream_dedup(t: Inputs) -> DataFrame:
    """First incidents of a stream whose payloads land in two parts, one after the events."""
    out = work_folder(t.spark, "dedup")
    t.events.coalesce(1).write.parquet(f"{out}/events")
    objects = derived.landed(t.events)
    for part, buckets in ((0, BUCKETS), (1, None)):
        land_payloads(objects.where(f"abs(hash(obj_uri)) % 2 = {part}"), f"{out}/landed", buckets)
        start_first_arrivals(
            derived.investigations(derived.stream_events(t.spark, f"{out}/events")),
            f"{out}/landed", ALL_DAYS,
            f"{out}/causes", f"{out}/checkpoint",
        ).awaitTermination()
    return t.spark.read.schema("root_cause_hash STRING").parquet(f"{out}/causes")


def _tuples_json(column: str, second: str) -> Column:
    """JSON text of unnamed ``[message, [..]]`` tuples."""
    pair = lambda x: F.concat(
        F.regexp_replace(F.to_json(F.array(x["message"])), r"\]$", ","),
        F.to_json(x[second]), F.lit("]"),
    )
    return F.concat(F.lit("["), F.array_join(F.transform(column, pair), ","), F.lit("]"))


QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {
    "lookback_filter": lookback_filter,
    "noise_filter": noise_filter,
    "dedup_key": dedup_keys,
    "latest_per_key": latest_per_key,
    "latest_per_key_stored": latest_per_key_stored,
    "days_argument": days_argument,
    "recent_candidates_all": recent_candidates,
    "pointer_to_uri": pointer_to_uri,
    "jsonrow_decode": jsonrow_decode,
    "payload_join": payload_join,
    "payload_fields": payload_fields,
    "payload_context": payload_context,
    "payload_rejects": payload_rejects,
    "stack_functions": stack_function_lists,
    "throwing_functions": throwing_function_lists,
    "normalized_error": normalized_errors,
    "root_cause_hash": root_cause_hashes,
    "incidents": lambda t: show_incidents(t.incidents),
    "incident_dedup": lambda t: show_incidents(t.unique),
    "endpoint_latest": endpoint_latest,
    "endpoint_state_merge": endpoint_state_merge,
    "endpoint_states_stored": endpoint_states_stored,
    "endpoint_wanted": endpoint_wanted,
    "incidents_by_account_env": lambda t: endpoints.incidents_by_account_env(t.unique),
    "enriched_incidents": lambda t: show_incidents(t.enriched),
    "new_incidents": lambda t: show_incidents(t.fresh),
    "skipped_incidents": lambda t: show_incidents(ledger.already_solved(t.unique, t.ledger)),
    "ledger_upsert": ledger_upsert,
    "ledger_lookup": ledger_lookup,
    "endpoints_by_id": endpoints_by_id,
    "landed_payload_join": landed_payload_join,
    "payload_objects_join": payload_objects_join,
    "triage_run": triage_run,
    "choices": choices,
    "posted_ledger": posted_ledger,
    "empty_run": empty_run,
    "ledger_mixed_runs": ledger_mixed_runs,
    "ledger_recent": lambda t: show_ledger(ledger.newest_ledger_rows_first(t.ledger)),
    "issue_titles": lambda t: t.enriched.select("root_cause_hash", issue_title().alias("title")),
    "issue_bodies": lambda t: t.enriched.select("root_cause_hash", issue_body().alias("body")),
    "choice_labels": lambda t: t.enriched.select(
        "root_cause_hash", choice_label().alias("label"), choice_short().alias("short")
    ),
    "approved_drafts": approved_drafts,
    "run_summary": summary,
    "upper_text": upper_texts,
    "stream_new_incidents": stream_new_incidents,
    "stream_dedup": stream_dedup,
}


# Queries about the cap of newest candidates, a top-k.
CAPPED: dict[str, Callable[[Inputs], DataFrame]] = {
    "recent_candidates": recent_candidates,
    "new_incidents_capped": QUERIES["new_incidents"],
    "triage_run_capped": triage_run,
}


# Queries about the look-back.
LOOKBACK = {"recent_candidates_all", "new_incidents", "triage_run", "latest_per_key_stored"}


def _bound(build: Callable[[Inputs], DataFrame], days: int, cap: int | None = None):
    return lambda spark, sf_dir: build(Inputs(spark, sf_dir, days, cap))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    whole = {
        name: _bound(build, DAYS if name in LOOKBACK else ALL_DAYS)
        for name, build in QUERIES.items()
    }
    return {**whole, **{name: _bound(build, DAYS, CAP) for name, build in CAPPED.items()}}
