"""Issue titles, bodies and selection labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts and lengths of the rendered issues.
TITLE_MARK = "🚨 "
TIME_MARK = "⏰ "
NO_METHODS = "ANY"
NO_ENDPOINT = "Unknown endpoint"
TITLE_MESSAGE = 50
LABEL_MESSAGE = 60
SEVERITY = "High"
ISSUE_LABELS = ("bug", "production", "auto-created")

DETECTED_BY = "Incident triage"


def shorten(text: Column, size: int) -> Column:
    """The text, cut and marked with an ellipsis when longer than ``size``."""
    return F.when(F.length(text) > size, lead(text, size)).otherwise(text)


def lead(text: Column, size: int) -> Column:
    """The first ``size`` characters and an ellipsis, whatever the length."""
    return F.concat(F.substring(text, 1, size), F.lit("..."))


def method_list(methods: Column, separator: str) -> Column:
    """Joined methods; ANY for an empty or absent list."""
    listed = F.coalesce(F.size(methods) > 0, F.lit(False))
    return F.when(listed, F.array_join(methods, separator)).otherwise(NO_METHODS)


def iso_utc(ts: Column) -> Column:
    """ISO-8601 text in UTC with milliseconds (the session zone must be UTC)."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def _has_endpoint() -> Column:
    return (F.col("endpoint_path") != "") & F.col("endpoint_methods").isNotNull()


def issue_title() -> Column:
    methods = method_list(F.col("endpoint_methods"), ",")
    service = F.col("service_name")
    location = F.when(
        _has_endpoint(), F.concat_ws(" ", service, methods, F.col("endpoint_path"))
    ).otherwise(service)
    message = shorten(F.col("error_message"), TITLE_MESSAGE)
    return F.concat(F.lit(TITLE_MARK), location, F.lit(": "), message)


def issue_body(detected_by: str = DETECTED_BY, preamble: str = "") -> Column:
    """The factual sections of an issue; ``preamble`` goes before the description."""
    methods = method_list(F.col("endpoint_methods"), ", ")
    endpoint = F.when(
        _has_endpoint(), F.concat_ws(" ", methods, F.col("endpoint_path"))
    ).otherwise(NO_ENDPOINT)

    def fact(name: str, value: Column, bullet: str = "") -> Column:
        return F.concat(F.lit(f"{bullet}**{name}:** "), value)

    # Headings and field names of an issue body, in order.
    lines = [
        F.lit("## Bug Report"),
        fact("Detected by", F.lit(detected_by)),
        fact("Timestamp", iso_utc(F.col("timestamp"))),
        fact("Severity", F.lit(SEVERITY)),
        F.lit(""),
        *([F.lit(preamble), F.lit("")] if preamble else []),
        F.lit("## Description"),
        F.lit(""),
        fact("Service", F.col("service_name")),
        fact("Endpoint", endpoint),
        fact("Environment", F.col("environment_name")),
        fact("Error", F.col("error_message")),
        F.lit(""),
        F.lit("## Additional Context"),
        fact("Account ID", F.col("account_id"), "- "),
        fact("Incident ID", F.col("id"), "- "),
        fact("Root Cause Hash", F.col("root_cause_hash"), "- "),
        fact("S3 Pointer", F.col("s3_pointer"), "- "),
    ]
    return F.concat_ws("\n", *lines)


def choice_label(time_format: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Three-line text by which a person recognises an incident."""
    methods = method_list(F.col("endpoint_methods"), ",")
    endpoint = F.when(
        F.col("endpoint_path") != "", F.concat_ws(" ", methods, F.col("endpoint_path"))
    ).otherwise(F.col("endpoint_uuid"))
    return F.concat(
        F.lit("["), F.col("service_name"), F.lit("] ["), F.col("environment_name"),
        F.lit("] "), endpoint,
        F.lit("\n    " + TITLE_MARK), shorten(F.col("error_message"), LABEL_MESSAGE),
        F.lit("\n    " + TIME_MARK), F.date_format("timestamp", time_format),
    )


def choice_short() -> Column:
    """One-line form of a selected incident."""
    return F.concat(
        F.col("service_name"), F.lit(": "), lead(F.col("error_message"), TITLE_MESSAGE)
    )


def progress_text() -> Column:
    """What a run reports while it drafts an incident."""
    return F.concat(
        F.lit("Drafting "), F.col("service_name"), F.lit(" - "),
        lead(F.col("error_message"), LABEL_MESSAGE),
    )
