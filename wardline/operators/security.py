"""Warehouse self-audit: suspicious queries, risky grants, sensitive columns.

All rule lists come from ``functions.rules``. Each operator is one narrow
projection plus filter, except the role audit (one aggregate and one join)
and the summary (four global counts).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.columns import day_boundaries, date_lit, keyword_class, like_any, ts_ntz


# ------------------------------------------------------------------ queries (Q)

def query_flag(c_bytes: Column, c_start: Column, c_text: Column | str, c_rows: Column) -> Column:
    lo, hi = R.WORK_HOURS
    return (F.when(c_bytes > R.LARGE_SCAN_BYTES, "large_scan_over_5gb")
            .when(~F.hour(c_start).between(lo, hi), "off_hours_access")
            .when(like_any(c_text, R.SENSITIVE_QUERY_PATTERNS),
                  "sensitive_column_access")
            .when(c_rows > R.LARGE_EXPORT_ROWS, "large_export"))


def anomalous_queries(log: DataFrame, as_of: _dt.datetime, ordered: bool = False,
                      day_col: str | None = None) -> DataFrame:
    """Queries of the last 7 days with their first matching risk flag.

    When the log is stored partitioned by day, pass ``day_col``: the same
    window is then also stated on the partition column, so only the last
    days' partitions are listed and read.
    """
    since = ts_ntz(as_of) - F.expr(f"INTERVAL {R.QUERY_LOOKBACK_DAYS} DAYS")
    if day_col is not None:
        log = log.where(F.col(day_col) >= F.to_date(since))
    out = (log.where(F.col("start_time") >= since)
           .select("query_id", "user_name", "role_name", "query_text", "bytes_scanned",
                   "rows_produced", "start_time", "execution_status")
           .withColumn("flag_reason", query_flag(F.col("bytes_scanned"), F.col("start_time"),
                                                 "query_text", F.col("rows_produced")))
           .where(F.col("flag_reason").isNotNull()))
    if ordered:
        out = out.orderBy(F.col("start_time").desc(), F.col("query_id"))
    return out


# ------------------------------------------------------------------ roles (R)

def last_successful_login(logins: DataFrame) -> DataFrame:
    """Latest successful login per user: a map-side-combined max per key."""
    return (logins.where(F.col("is_success") == "YES")
            .groupBy("user_name").agg(F.max("event_timestamp").alias("last_login")))


def role_flag(role: Column, days: Column) -> Column:
    return (F.when(role.isin(*R.ADMIN_ROLES) & (days > R.ADMIN_UNUSED_DAYS), "admin_role_unused_30_days")
            .when(days > R.USER_INACTIVE_DAYS, "user_inactive_90_days")
            .when(role == R.REVIEW_ROLE, "accountadmin_flag_review"))


def role_audit(grants: DataFrame, logins: DataFrame, as_of: _dt.date) -> DataFrame:
    """Grants joined to each user's last successful login; keep risky ones.

    The login log is pre-aggregated to one row per user before the join, so a
    user with a huge login history never meets the grants as many rows.
    """
    last = last_successful_login(logins)
    g = grants.select(F.col("grantee_name").alias("user_name"), F.col("role").alias("granted_role"))
    j = g.join(last, "user_name", "left")
    days = day_boundaries(F.col("last_login"), date_lit(as_of))
    return (j.select("user_name", "granted_role", "last_login",
                     days.alias("days_since_login"))
            .withColumn("risk_flag", role_flag(F.col("granted_role"), F.col("days_since_login")))
            .where(F.col("risk_flag").isNotNull()))


# ------------------------------------------------------------------ columns (P)

def pii_class(name: Column | str) -> Column:
    return keyword_class(name, R.SENSITIVE_COLUMN_RULES, R.NOT_SENSITIVE)


def pii_exposure(columns: DataFrame, as_of: _dt.datetime, ordered: bool = False) -> DataFrame:
    """Sensitive-looking columns and whether their name marks them as protected."""
    cls = pii_class("column_name")
    status = (F.when(F.col("pii_classification") == R.NOT_SENSITIVE, F.lit(None).cast("string"))
              .when(like_any("column_name", R.PROTECTED_COLUMN_PATTERNS), R.PROTECTED)
              .otherwise(R.EXPOSED))
    out = (columns.where(F.col("table_schema") != R.EXCLUDED_SCHEMA)
           .select(F.col("table_catalog").alias("database_name"),
                   F.col("table_schema").alias("schema_name"),
                   "table_name", "column_name", "data_type")
           .withColumn("pii_classification", cls)
           .withColumn("exposure_status", status)
           .withColumn("checked_at", ts_ntz(as_of))
           .where(F.col("pii_classification") != R.NOT_SENSITIVE))
    if ordered:
        out = out.orderBy(F.col("exposure_status").desc(), "table_name", "column_name")
    return out


def masked_view(customers: DataFrame, role: str,
                masked_email_roles: tuple[str, ...] = ("REPORTER",),
                admin_roles: tuple[str, ...] = tuple(R.ADMIN_ROLES)) -> DataFrame:
    """The customer table as a given role sees it under the declared policies.

    Email is masked for the listed roles; phone keeps its last four digits;
    SSN and address are redacted for every non-admin role.
    """
    email = F.lit("***MASKED***") if role in masked_email_roles else F.col("email")
    phone = F.concat(F.expr("repeat('X', greatest(length(phone) - 4, 0))"), F.expr("right(phone, 4)"))
    admin = role in admin_roles
    redacted = F.lit("[REDACTED]")
    return customers.select(
        "customer_id", "full_name",
        email.alias("email"),
        phone.alias("phone"),
        (F.col("ssn") if admin else redacted).alias("ssn"),
        (F.col("address") if admin else redacted).alias("address"))


# ------------------------------------------------------------------ summary (X)

def security_summary(anomalies: DataFrame, role_risks: DataFrame, exposure: DataFrame,
                     as_of: _dt.datetime) -> DataFrame:
    """Four global counts in one row and a traffic-light status.

    The three inputs are tagged, unioned (one narrow column each) and counted
    by one global aggregate, combined map-side; no join is involved and the
    exposure statuses are counted in the same pass.
    """
    u = (anomalies.select(F.lit("q").alias("_src"), F.lit(None).cast("string").alias("_status"))
         .unionByName(role_risks.select(F.lit("r").alias("_src"), F.lit(None).cast("string").alias("_status")))
         .unionByName(exposure.select(F.lit("p").alias("_src"), F.col("exposure_status").alias("_status"))))
    src, st = F.col("_src"), F.col("_status")
    row = u.agg(F.count(F.when(src == "q", 1)).alias("total_anomalies"),
                F.count(F.when(src == "r", 1)).alias("total_role_risks"),
                F.count(F.when((src == "p") & (st == R.EXPOSED), 1)).alias("total_exposed_columns"),
                F.count(F.when((src == "p") & (st == R.PROTECTED), 1)).alias("total_protected_columns"))
    status = (F.when((F.col("total_anomalies") == 0) & (F.col("total_role_risks") == 0)
                     & (F.col("total_exposed_columns") == 0), R.HEALTH_GREEN)
              .when((F.col("total_exposed_columns") > 0) | (F.col("total_role_risks") > 0), R.HEALTH_AMBER)
              .otherwise(R.HEALTH_RED))
    return row.select(ts_ntz(as_of).alias("report_generated_at"), "total_anomalies", "total_role_risks",
                      "total_exposed_columns", "total_protected_columns",
                      status.alias("security_health_status"))
