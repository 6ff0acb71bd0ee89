"""Request logs -> HTTP events."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.constants import HEALTH_PATHS
from tracewell.functions.ip import forwarded_ip
from tracewell.functions.jsonwalk import Walk, rewrite
from tracewell.functions.variants import as_object
from tracewell.operators.filters import (
    in_sample,
    is_json_type,
    is_llm_path,
    path_wanted,
    response_body_eligible,
    withhold_ai_bodies,
)
from tracewell.operators.privacy import address_pseudonym, head_tail_body
from tracewell.operators.requests import captured_headers, query_params, scrub_params, split_path
from tracewell.operators.rules import Rule, check_rules
from tracewell.session import prepare_session

REQUEST_SCHEMA = (
    "event_id STRING, ts TIMESTAMP, method STRING, scheme STRING, path STRING,"
    " headers ARRAY<STRUCT<name: STRING, value: STRING>>, body STRING, source_address STRING,"
    " response_body STRING, response_type STRING, response_encoding STRING, metrics STRING"
)
#: Read as well; tables without these fields are taken too.
RESPONSE_FIELDS = "response_status INT, duration_ms DOUBLE"


@dataclass(frozen=True)
class RequestOptions:
    """What is kept of a request and how it is scrubbed."""

    secret: str | None = None
    capture_paths: Sequence[str] = ()
    exclude_paths: Sequence[str] = ()
    rate: float = 1.0
    sample_key: str | None = None
    capture_headers: Sequence[str] = ()
    client_ip_header: str = "x-forwarded-for"
    user_id_header: str | None = None
    capture_body: bool = True
    capture_ai_content: bool = True
    capture_response_body: bool = False
    extra_keys: Sequence[str] = ()
    rules: Sequence[Rule] = ()


def read_requests(spark: SparkSession, path: str, fmt: str = "json", *, stream: bool = False) -> DataFrame:
    """A raw request log with ``REQUEST_SCHEMA`` and ``RESPONSE_FIELDS``."""
    prepare_session(spark)
    reader = spark.readStream if stream else spark.read
    return reader.format(fmt).schema(f"{REQUEST_SCHEMA}, {RESPONSE_FIELDS}").load(path)


def read_http_log(spark: SparkSession, path: str, options: RequestOptions = RequestOptions(),
                  fmt: str = "json") -> DataFrame:
    return http_events(read_requests(spark, path, fmt), options)


def header(name: str) -> Column:
    """First value of a request header, by case-insensitive name."""
    hits = F.filter("headers", lambda h: F.lower(h["name"]) == name.lower())
    return F.get(hits, F.lit(0))["value"]


def request_fates(requests: DataFrame, options: RequestOptions = RequestOptions()) -> DataFrame:
    """Adds ``endpoint``, ``_query`` and ``outcome``: ``http`` for requests that become events, else
    the first reason why not (``health``, ``path`` or ``unsampled``)."""
    endpoint, query = split_path(F.col("path"))
    rows = requests.withColumns({"endpoint": endpoint, "_query": query})
    fate = (
        F.when(F.col("endpoint").isin(*HEALTH_PATHS), "health")
        .when(~path_wanted(F.col("endpoint"), options.capture_paths, options.exclude_paths), "path")
        .when(~in_sample(options.rate, options.sample_key), "unsampled")
        .when(F.col("endpoint").isNotNull(), "http").otherwise("path")
    )
    return rows.withColumn("outcome", fate)


#: What is read of a request only when it becomes an event.
_CONTENT = ("headers", "body", "source_address", "response_body", "metrics", "_query", "response_status", "duration_ms")


def http_events(requests: DataFrame, options: RequestOptions = RequestOptions(), *, dropped: bool = False) -> DataFrame:
    """Raw requests -> scrubbed events; narrow, and cheap tests come first.

    Health checks, unwanted paths and unsampled requests are gone before any
    header, query or body is looked at. With ``dropped`` they stay as rows without content
    whose ``outcome`` is the reason, to be counted in the pass that stores the events.
    ``status`` is ``error`` for response codes from 400 on, null where the log has none.
    """
    check_rules(requests.sparkSession, options.rules)
    rows = requests.withColumns({c: F.lit(None).cast(t) for c, t in (("response_status", "int"), ("duration_ms", "double"))
                                 if c not in requests.columns})
    rows = request_fates(rows, options)
    kept = F.col("outcome") == "http"
    rows = rows.withColumns({c: F.when(kept, F.col(c)) for c in _CONTENT if c in rows.columns}) if dropped else rows.filter(kept)

    method = F.upper("method")
    client = forwarded_ip(header(options.client_ip_header), F.col("source_address"))
    user = header(options.user_id_header) if options.user_id_header else F.lit(None).cast("string")
    wanted = method.isin("POST", "PUT", "PATCH") & is_json_type(header("content-type"))
    if not options.capture_body:
        wanted = F.lit(False)
    # Text that cannot be an object or array is never parsed.
    rows = rows.withColumn("_sent", F.when(wanted & F.col("body").rlike(r"^\s*[\[{]"), F.col("body")))
    if not options.capture_ai_content:
        rows = rows.withColumn("body", F.when(~is_llm_path(F.col("endpoint")), F.try_parse_json("_sent")))
        rows = withhold_ai_bodies(rows)
        rows = rows.withColumn("_sent", F.when(F.col("body").isNotNull(), F.col("_sent")))
    walk = Walk(extra_keys=tuple(options.extra_keys), rules=tuple(options.rules), secret=options.secret)
    if options.capture_response_body:
        rows = response_body_eligible(rows)
        rows = head_tail_body(rows, "response_body")
    else:
        rows = rows.withColumn("response_body", F.lit(None).cast("variant"))
    metrics = F.try_parse_json("metrics")
    params = scrub_params(query_params(F.col("_query")), extra_keys=options.extra_keys, rules=options.rules,
                          secret=options.secret)
    return rows.select(
        "event_id",
        F.lit("http").alias("kind"),
        "outcome",
        "ts",
        address_pseudonym(client, options.secret, empty=None, limit=None).alias("remote_addr"),
        "endpoint",
        F.when(F.lower("scheme") == "https", "https").otherwise("http").alias("scheme"),
        method.alias("method"),
        captured_headers(F.col("headers"), options.secret, options.capture_headers).alias("headers"),
        params.alias("query_params"),
        rewrite(F.col("_sent"), walk).alias("body"),
        "response_body",
        header("user-agent").alias("user_agent"),
        user.alias("user_id"),
        F.when(F.col("response_status") >= 400, "error").when(F.col("response_status").isNotNull(), "ok").alias("status"),
        "duration_ms",
        F.when(as_object(metrics).isNotNull(), rewrite(F.col("metrics"), Walk())).alias("custom_data"),
    )


def split_metrics(df: DataFrame, response: str = "response_body", key: str = "_metrics",
                  out: str = "custom_data") -> DataFrame:
    """Take the metrics object an application put into its response out of it:
    ``out`` gets it redacted, ``response`` loses the key. No object -> ``{}``."""
    found = F.try_variant_get(response, f"$.{key}", "variant")
    metrics = F.when(as_object(found).isNotNull(), rewrite(F.to_json(found), Walk()))
    members = as_object(F.col(response))
    return df.withColumns({
        out: F.coalesce(metrics, F.parse_json(F.lit("{}"))),
        response: F.when(members.isNotNull(), F.to_variant_object(F.map_filter(members, lambda k, v: k != key)))
        .otherwise(F.col(response)),
    })
