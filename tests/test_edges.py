"""Hand-written edge rows per operator (the expected values follow the rules)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.functions import rules as R
from wardline.functions.columns import hour_boundaries, ts_ntz
from wardline.operators import drift as D
from wardline.operators import ingest as I
from wardline.operators import marts as M
from wardline.operators import outliers as Z
from wardline.operators import quality as K
from wardline.operators import security as SEC
from wardline.operators import staging as ST
from wardline.operators import upsert as U

AS_OF = dt.date(2001, 8, 15)


def _raw(spark, rows):
    schema = ("ghsa_id string, cve_id string, summary string, description string, severity string, "
              "cvss_score double, published_at timestamp_ntz, updated_at timestamp_ntz, "
              "withdrawn_at timestamp_ntz, ingested_at timestamp_ntz")
    return spark.createDataFrame(rows, schema)


def _adv(i, summary="x", cvss=5.0, days=400, severity="HIGH", withdrawn=False):
    pub = dt.datetime.combine(AS_OF, dt.time()) - dt.timedelta(days=days) if days is not None else None
    return (f"A{i}", None, summary, None, severity, cvss, pub, pub, pub if withdrawn else None, pub)


def test_age_buckets_and_multipliers(spark):
    days = [None, -3, 30, 31, 90, 91, 365, 366]
    want = ["chronic", "new", "new", "recent", "recent", "aging", "aging", "chronic"]
    raw = _raw(spark, [_adv(i, days=d) for i, d in enumerate(days)])
    out = {r.advisory_id: r for r in ST.enrich_vulnerabilities(ST.stage_advisories(raw, AS_OF)).collect()}
    got = [out[f"A{i}"].age_bucket for i in range(len(days))]
    assert got == want
    assert out["A1"].age_risk_multiplier == 1.0 and out["A3"].age_risk_multiplier == 1.2
    assert out["A5"].age_risk_multiplier == 1.5 and out["A7"].age_risk_multiplier == 2.0


def test_critical_flag_and_score(spark):
    raw = _raw(spark, [_adv(0, cvss=None), _adv(1, cvss=9.0, days=10), _adv(2, cvss=8.9, days=10),
                       _adv(3, cvss=4.5, days=1000), _adv(4, withdrawn=True)])
    e = {r.advisory_id: r for r in ST.enrich_vulnerabilities(ST.stage_advisories(raw, AS_OF)).collect()}
    assert "A4" not in e
    assert e["A0"].is_critical is False and e["A0"].composite_risk_score == 0.0
    assert e["A1"].is_critical is True and e["A2"].is_critical is False
    assert e["A3"].composite_risk_score == 9.0
    crit = {r.advisory_id for r in M.mart_critical(ST.enrich_vulnerabilities(ST.stage_advisories(raw, AS_OF))).collect()}
    assert crit == {"A1", "A3"}


def test_keyword_categories(spark):
    texts = ["Resource use", "XPath", None, "privilege leak", "auth bypass path", "Remote Code run"]
    want = ["code_execution", "path_traversal", "other", "privilege_escalation", "auth_bypass", "code_execution"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r.c for r in df.select(ST.vulnerability_category(F.col("s")).alias("c")).collect()]
    assert got == want


def test_summary_all_null_cvss_group(spark):
    raw = _raw(spark, [_adv(0, cvss=None), _adv(1, cvss=None)])
    s = M.mart_summary(ST.enrich_vulnerabilities(ST.stage_advisories(raw, AS_OF))).collect()
    assert len(s) == 1
    assert s[0].avg_cvss_score is None and s[0].avg_composite_risk_score == 0.0 and s[0].total_count == 2


def test_summary_rounds_half_up_exactly(spark):
    # scores 1.00 and 1.01 average to 1.005 → 1.01 (half up on exact hundredths)
    raw = _raw(spark, [_adv(0, cvss=1.0, days=5), _adv(1, cvss=1.01, days=5)])
    s = M.mart_summary(ST.enrich_vulnerabilities(ST.stage_advisories(raw, AS_OF))).collect()
    assert s[0].avg_composite_risk_score == 1.01


def test_explode_packages_edges(spark):
    rows = [("A1", "[]"), ("A2", "null"), ("A3", None),
            ("A4", '[{"package":{"ecosystem":"","name":"p"}}]'),
            ("A5", '[{"package":{"ecosystem":null,"name":"p"}}]'),
            ("A6", '[{"package":{"ecosystem":"pip","name":"a"}},{"package":{"ecosystem":"pip","name":"b"}}]')]
    raw = spark.createDataFrame(rows, "ghsa_id string, affected_packages string")
    pk = M.explode_packages(raw)
    assert {r.ghsa_id for r in pk.collect()} == {"A4", "A5", "A6"}
    enr = spark.createDataFrame([(f"A{i}", "critical", 5.0) for i in range(1, 7)],
                                "advisory_id string, severity string, composite_risk_score double")
    eco = M.mart_ecosystem_risk(enr, pk).collect()
    assert len(eco) == 1
    r = eco[0]
    assert (r.ecosystem_name, r.total_vulnerabilities, r.critical_count) == ("pip", 1, 2)


def test_pipeline_health_empty_and_hour_boundary(spark):
    empty = spark.createDataFrame([], "ingested_at timestamp_ntz")
    h = M.pipeline_health(empty, "t", "ingested_at", dt.datetime(2024, 1, 31)).collect()[0]
    assert h.hours_since_last_load is None and h.is_fresh is False and h.is_row_count_normal is True
    assert h.pipeline_status == "stale" and h.last_ingested_at is None
    with pytest.raises(K.ContractError):
        K.enforce_contract(M.pipeline_health(empty, "t", "ingested_at", dt.datetime(2024, 1, 31)),
                           K.HEALTH_CONTRACT, "health")
    one = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10, 59),)], "t timestamp_ntz")
    v = one.select(hour_boundaries(F.col("t"), ts_ntz(dt.datetime(2024, 1, 1, 11, 1))).alias("h")).first().h
    assert v == 1


def test_zscore_guards_and_bound(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("b", 3.0), ("c", 1.0), ("c", 2.0), ("c", 3.0),
                                ("c", 4.0), ("c", 100.0)], "g string, v double")
    z = {(r.g, r.v): r for r in Z.zscore(df, "g", "v").collect()}
    assert z[("a", 1.0)].stddev is None and z[("a", 1.0)].z_score == 0.0
    assert z[("b", 3.0)].stddev == 0.0 and z[("b", 3.0)].z_score == 0.0
    # five rows: |z| never exceeds (n-1)/sqrt(n) ≈ 1.79
    assert max(abs(r.z_score) for k, r in z.items() if k[0] == "c") < 1.8


def test_query_flags(spark):
    rows = [(1, "u", "r", "select 1", 5368709120, 0, dt.datetime(2024, 1, 30, 12), "S"),
            (2, "u", "r", "select 1", 0, 0, dt.datetime(2024, 1, 30, 22, 59), "S"),
            (3, "u", "r", "select 1", 0, 0, dt.datetime(2024, 1, 30, 23, 0), "S"),
            (4, "u", "r", "select SSN", None, 0, dt.datetime(2024, 1, 30, 12), "S"),
            (5, "u", "r", "select 1", 0, 2000000, dt.datetime(2024, 1, 30, 12), "S"),
            (6, "u", "r", "select 1", 0, 0, dt.datetime(2024, 1, 1, 12), "S")]
    log = spark.createDataFrame(rows, "query_id int, user_name string, role_name string, query_text string, "
                                      "bytes_scanned long, rows_produced long, start_time timestamp_ntz, "
                                      "execution_status string")
    got = {r.query_id: r.flag_reason for r in SEC.anomalous_queries(log, dt.datetime(2024, 1, 31)).collect()}
    assert got == {3: "off_hours_access", 4: "sensitive_column_access", 5: "large_export"}


def test_role_flags(spark):
    grants = spark.createDataFrame([("n1", "ACCOUNTADMIN"), ("n2", "SYSADMIN"), ("n3", "ANALYST"),
                                    ("a30", "ACCOUNTADMIN"), ("a31", "SYSADMIN")], "grantee_name string, role string")
    logins = spark.createDataFrame([("a30", dt.datetime(2001, 7, 16), "YES"), ("a31", dt.datetime(2001, 7, 15), "YES"),
                                    ("a31", dt.datetime(2001, 8, 14), "NO")],
                                   "user_name string, event_timestamp timestamp_ntz, is_success string")
    got = {r.user_name: r.risk_flag for r in SEC.role_audit(grants, logins, AS_OF).collect()}
    assert got == {"n1": "accountadmin_flag_review", "a30": "accountadmin_flag_review",
                   "a31": "admin_role_unused_30_days"}


def test_pii_classes(spark):
    names = ["creditXcard", "email_password", "home_address_secret", "birth_dob", "plain"]
    cols = spark.createDataFrame([("db", "MARTS", "t", n, "VARCHAR") for n in names],
                                 "table_catalog string, table_schema string, table_name string, "
                                 "column_name string, data_type string")
    got = {r.column_name: (r.pii_classification, r.exposure_status)
           for r in SEC.pii_exposure(cols, dt.datetime(2024, 1, 31)).collect()}
    assert got == {"creditXcard": ("PII_PAYMENT", R.EXPOSED), "email_password": ("PII_EMAIL", R.PROTECTED),
                   "home_address_secret": ("CREDENTIAL", R.PROTECTED), "birth_dob": ("PII_DOB", R.EXPOSED)}


@pytest.mark.parametrize("counts,status", [((0, 0, 0), R.HEALTH_GREEN), ((5, 0, 0), R.HEALTH_RED),
                                           ((5, 1, 0), R.HEALTH_AMBER), ((0, 0, 1), R.HEALTH_AMBER)])
def test_summary_status(spark, counts, status):
    a, r, p = counts
    anomalies = spark.range(a)
    roles = spark.range(r)
    expo = spark.createDataFrame([(R.EXPOSED,)] * p, "exposure_status string")
    row = SEC.security_summary(anomalies, roles, expo, dt.datetime(2024, 1, 31)).first()
    assert row.security_health_status == status


def test_plan_parsing(spark):
    texts = [(1, 0, "No changes."), (2, 2, '  # a.b["k"] will be destroyed\n  # c.d must be replaced'),
             (3, 2, "  # x.y will be created\n  ~ x.y will be updated\n  + z.w will be created\n"
                    "Plan: 2 to add, 1 to change, 0 to destroy."),
             (4, 1, "Error")]
    plans = spark.createDataFrame([(i, e, t, dt.datetime(2024, 1, i)) for i, e, t in texts],
                                  "run_id int, exit_code int, stdout string, checked_at timestamp_ntz")
    out = {r.run_id: r for r in D.drift_records(plans).collect()}
    assert set(out) == {1, 2, 3}
    assert (out[1].resources_to_add, out[1].resources_to_change, out[1].resources_to_destroy) == (0, 0, 0)
    assert out[1].drift_detected is False and out[3].drift_detected is True
    assert out[2].drift_details == '{"changed_resources":[]}'
    assert out[3].drift_details == '{"changed_resources":["x.y","z.w"]}'
    assert (out[3].resources_to_add, out[3].resources_to_change) == (2, 1)


def test_expectations(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), (None, "y"), (None, "zz")], "k string, v string")
    assert K.expect_unique(df, "k").first().failures == 1
    assert K.expect_in(df, "v", ["x", "y"]).first().failures == 1
    assert K.expect_not_null(df, ["k", "v"]).collect()[0].failures == 2
    ts = spark.createDataFrame([(dt.datetime(2024, 1, 30),)], "t timestamp_ntz")
    for hours, secs, status in [(24, 0, "pass"), (24, 1, "warn"), (48, 1, "error")]:
        as_of = dt.datetime(2024, 1, 30) + dt.timedelta(hours=hours, seconds=secs)
        assert K.freshness(ts, "s", "t", as_of).first().status == status


def test_upsert_idempotent_and_empty(spark):
    target = spark.createDataFrame([("A", 1.0), ("B", 2.0)], "id string, v double")
    source = spark.createDataFrame([("B", 3.0), ("C", 4.0)], "id string, v double")
    once = U.upsert(target, source, "id")
    twice = U.upsert(once, source, "id")
    assert sorted(once.collect()) == sorted(twice.collect())
    assert {r.id: r.v for r in once.collect()} == {"A": 1.0, "B": 3.0, "C": 4.0}
    empty = spark.createDataFrame([], "id string, v double")
    assert sorted(U.upsert(target, empty, "id").collect()) == sorted(target.collect())


def test_upsert_partial_update_and_dedupe(spark):
    target = spark.createDataFrame([("A", 1.0, "t")], "id string, v double, note string")
    source = spark.createDataFrame([("A", 5.0, "s"), ("A", 7.0, "s2"), ("B", 2.0, "n")],
                                   "id string, v double, note string")
    out = {r.id: r for r in U.upsert(target, source, "id", update_cols=["v"], dedupe_order=["v"]).collect()}
    assert out["A"].v == 7.0 and out["A"].note == "t" and out["B"].note == "n"


def test_record_upsert_unknown_id(spark):
    target = spark.createDataFrame([], "cve_id string, record string, fetched_at timestamp_ntz, "
                                       "loaded_at timestamp_ntz")
    recs = spark.createDataFrame([('{"x": 1}', dt.datetime(2024, 1, 1))], "record string, fetched_at timestamp_ntz")
    out = U.upsert_records(target, recs, "cve_id", dt.datetime(2024, 1, 2)).collect()
    assert out[0].cve_id == "UNKNOWN" and out[0].loaded_at == dt.datetime(2024, 1, 2)


def test_first_seen_prefers_list_order(spark):
    lst = spark.createDataFrame([("npm", 1, "G1", "critical"), ("pip", 5, "G1", "high"),
                                 ("pip", 6, "G2", None)],
                                "ecosystem string, position int, ghsa_id string, severity string")
    out = I.fetch_advisories(lst, ["pip", "npm"], ["critical", "high"]).collect()
    assert [(r.ghsa_id, r.ecosystem) for r in out] == [("G1", "pip")]


def test_cap_per_group_counts(spark):
    df = spark.range(0, 1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("pos"))
    out = I.cap_per_group(df, "g", ["pos"], 10)
    counts = {r.g: r["count"] for r in out.groupBy("g").count().collect()}
    assert counts == {0: 10, 1: 10, 2: 10}
    assert out.where("pos >= 30").count() == 0


def test_type_raw_parses_or_nulls(spark):
    df = spark.createDataFrame([("2024-01-02T03:04:05Z", "2024-01-02T03:04:05.123+02:00", "bad", "[1]")],
                               "published_at string, updated_at string, withdrawn_at string, cwes string")
    from wardline.sources.landing import type_raw
    r = type_raw(df).first()
    assert r.published_at == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert r.updated_at == dt.datetime(2024, 1, 2, 1, 4, 5, 123000)
    assert r.withdrawn_at is None
    assert isinstance(type_raw(df).schema["cwes"].dataType, T.VariantType)


def test_unwrap_nodes_and_cves(spark):
    from wardline.sources.landing import unwrap_cves, unwrap_nodes
    pages = spark.createDataFrame(
        [('{"pageInfo":{"hasNextPage":true,"endCursor":"c1"},"nodes":[{"ghsaId":"G1"},{"ghsaId":"G2"}]}',
          dt.datetime(2024, 1, 1)),
         ('{"pageInfo":{"hasNextPage":false},"nodes":[]}', dt.datetime(2024, 1, 2))],
        "json string, fetched_at timestamp_ntz")
    assert [r.ghsa_id for r in unwrap_nodes(pages).collect()] == ["G1", "G2"]
    cves = spark.createDataFrame(
        [('{"totalResults":2,"vulnerabilities":[{"cve":{"id":"C1"}},{"id":"C2"}]}', dt.datetime(2024, 1, 1))],
        "json string, fetched_at timestamp_ntz")
    assert [r.cve_id for r in unwrap_cves(cves).collect()] == ["C1", "C2"]


def test_flatten_defaults(spark):
    from wardline.sources.landing import flatten_advisories
    docs = spark.createDataFrame([('{"ghsa_id":"G1","summary":null,"credits":[{"login":"a"}]}',)], "json string")
    r = flatten_advisories(docs, dt.datetime(2024, 1, 1)).first()
    assert r.summary == "" and r.cwes == "[]" and r.affected_packages == "[]" and r.credits_count == 1
    assert r.cvss_score is None and r.source_api == R.REST_SOURCE


def test_masked_view_roles(spark):
    c = spark.createDataFrame([(1, "n", "a@b.c", "5551234567", "123456789", "1 Main")],
                              "customer_id long, full_name string, email string, phone string, ssn string, address string")
    rep = SEC.masked_view(c, "REPORTER").first()
    assert rep.email == "***MASKED***" and rep.phone == "XXXXXX4567" and rep.ssn == "[REDACTED]"
    adm = SEC.masked_view(c, "ACCOUNTADMIN").first()
    assert adm.email == "a@b.c" and adm.ssn == "123456789" and adm.address == "1 Main"


def test_catalog_inventory_and_ensure_table(spark):
    from wardline.sources import tables as TB
    TB.ensure_schema(spark, "security")
    TB.ensure_table(spark, "security.inv_probe", T.StructType([T.StructField("user_email", T.StringType())]))
    TB.ensure_table(spark, "security.inv_probe", T.StructType([T.StructField("other", T.StringType())]))
    inv = TB.column_inventory(spark).where("table_name = 'inv_probe'")
    assert [(r.table_schema, r.column_name) for r in inv.collect()] == [("security", "user_email")]
    exp = SEC.pii_exposure(inv, dt.datetime(2024, 1, 1)).first()
    assert exp.pii_classification == "PII_EMAIL" and exp.exposure_status == R.PROTECTED


def test_contract_rejects_wrong_types(spark):
    df = spark.createDataFrame([("x",)], "advisory_id string")
    with pytest.raises(K.ContractError):
        K.enforce_contract(df, K.CRITICAL_CONTRACT, "m")


def test_explode_packages_from_variant(spark):
    raw = spark.createDataFrame([("A1", '[{"package":{"ecosystem":"npm","name":"x"}}]'), ("A2", "[]")],
                                "ghsa_id string, affected_packages string")
    v = raw.select("ghsa_id", F.parse_json("affected_packages").alias("affected_packages"))
    assert [(r.ghsa_id, r.ecosystem) for r in M.explode_packages(v).collect()] == [("A1", "npm")]


def test_type_raw_rejects_bad_json(spark):
    from wardline.sources.landing import type_raw_with_rejects
    df = spark.createDataFrame([("G1", "[1]", "2024-01-01T00:00:00Z"), ("G2", "{not json", "2024-01-01T00:00:00Z"),
                                ("G3", None, "bad")], "ghsa_id string, cwes string, published_at string")
    good, rejects = type_raw_with_rejects(df)
    assert sorted(r.ghsa_id for r in good.collect()) == ["G1", "G3"]
    assert [(r.ghsa_id, r.reject_reason) for r in rejects.collect()] == [("G2", "invalid JSON in cwes")]
    assert isinstance(good.schema["cwes"].dataType, T.VariantType)
    assert [r.published_at for r in good.orderBy("ghsa_id").collect()] == [dt.datetime(2024, 1, 1), None]
