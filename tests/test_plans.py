import datetime as dt

import pytest
from pyspark.sql import functions as F

from landstage.operators import with_surrogate_id
from landstage.plans import model as M
from landstage.plans.cleaning import clean_and_nest, flatten
from landstage.plans.spec import run_load, unmatched

CAPTURED_COLS = ["agent_code", "agent", "contact_number", "broker_code", "broker", "branch_name", "client",
                 "first_name", "last_name", "id_number", "gender", "date_of_birth",
                 *M.ADDRESS_COLS, *M.beneficiary_slot_columns(), "policy_number", "policy_description",
                 "cover", "member_type", "capture_date", "inception", "status"]


def captured(spark, rows):
    """Landing rows given as dicts; unspecified columns are null."""
    data = [tuple(r.get(c) for c in CAPTURED_COLS) for r in rows]
    return spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in CAPTURED_COLS))


BASE = dict(agent_code="A1", agent="Agent One", contact_number="0821234567", broker_code="B1",
            broker="Acme Brokers", branch_name="North", client="Big Co", first_name="Jane",
            last_name="Doe", id_number="800101", gender="F", date_of_birth="1980-01-01",
            policy_number="P1", policy_description="Funeral", cover="1000.50", member_type="MAIN",
            capture_date="01/05/2020", inception="02/01/2020", status="ACTIVE",
            postal_add_1="Box 1", res_address_1="1 Main",
            beneficiary_full_name_1="Ann", beneficiary_id_number_1="1", beneficiary_relation_1="SPOUSE",
            beneficiary_percentage_1="60", beneficiary_cell_1="071",
            beneficiary_full_name_2="Bob", beneficiary_id_number_2="2", beneficiary_relation_2="CHILD",
            beneficiary_percentage_2="40", beneficiary_cell_2="072")


def test_agent_load_dedupes_and_casts_phone(spark):
    land = captured(spark, [BASE, BASE, dict(BASE, contact_number="27821234567"),
                            dict(BASE, contact_number="n/a")])
    out = run_load(M.AGENT, {M.CAPTURED: land}, at="2024-01-01 13:05:07", stamp="clock12")
    got = sorted(out.collect(), key=lambda r: str(r.contact_number))
    assert len(got) == 3
    assert {r.contact_number for r in got} == {821234567, None}
    assert out.columns == ["agent_code", "agent_name", "contact_number", "hash_key", "hash_diff",
                           "source_table", "load_dts"]
    assert got[0].load_dts == dt.datetime(2024, 1, 1, 1, 5, 7)
    assert {r.source_table for r in got} == {"landing_member_captured_list"}
    # hash_key ignores the phone, hash_diff does not
    assert len({r.hash_key for r in got}) == 1 and len({r.hash_diff for r in got}) == 3


def test_member_load_upper_and_bad_dates(spark):
    land = captured(spark, [BASE, dict(BASE, id_number="2", date_of_birth="1980-13-01"),
                            dict(BASE, id_number="3", date_of_birth=None)])
    out = {r.id_number: r for r in run_load(M.MEMBER, {M.CAPTURED: land}, stamp=None).collect()}
    assert out["800101"].first_name == "JANE" and out["800101"].birth_date == dt.date(1980, 1, 1)
    assert out["2"].birth_date is None and out["2"].hash_diff is not None
    assert out["3"].hash_diff is None and out["3"].hash_key is not None
    assert out["800101"].title == ""


def test_member_list_null_title_nulls_hash_diff_and_keeps_duplicates(spark):
    land = spark.createDataFrame([("Jane", "Doe", "1", "F", "01/05/1980", None)] * 2,
                                 "first_name string, last_name string, id_number string, gender string,"
                                 " birth_date string, title string")
    out = run_load(M.MEMBER_FROM_LIST, {M.MEMBER_LIST: land}, stamp=None).collect()
    assert len(out) == 2
    assert out[0].hash_diff is None and out[0].hash_key is not None
    assert out[0].birth_date == dt.date(1980, 1, 5)


def _dims(spark, land, extract):
    inputs = {M.CAPTURED: land, M.PRODUCT_EXTRACT: extract}

    def load(spec, name):
        return with_surrogate_id(run_load(spec, inputs, stamp=None), name)

    inputs[M.STG_MEMBER] = load(M.MEMBER, "member_id")
    inputs[M.STG_BROKER] = load(M.BROKER_FROM_EXTRACT, "broker_id")
    inputs[M.STG_CLIENT] = load(M.CLIENT_FROM_EXTRACT, "client_id")
    inputs[M.STG_BROKER_CLIENT] = load(M.BROKER_CLIENT, "broker_client_id")
    inputs[M.STG_PRODUCT] = load(M.PRODUCT, "product_id")
    return inputs


@pytest.fixture
def extract(spark):
    cols = list(M.PRODUCT_COLS)
    row = dict(policy_code="PC1", policy_description="Funeral", relate_to="MAIN", age_from="18",
               age_to="65", premium="99.50", underwriter_premium="1.005", cover="1000",
               waiting_period="6", product_category="LIFE", product_type="STD", broker_code="B1",
               broker_name="ACME BROKERS", client="BIG CO", underwriter="UW1")
    rows = [row, row, dict(row, policy_code="PC2", underwriter_premium="123456.78", cover="2000")]
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in rows],
                                 ", ".join(f"{c} string" for c in cols))


def test_product_load_casts_and_constants(spark, extract):
    inputs = _dims(spark, captured(spark, [BASE]), extract)
    prod = {r.policy_code: r for r in inputs[M.STG_PRODUCT].collect()}
    assert set(prod) == {"PC1", "PC2"}
    assert str(prod["PC1"].underwriter_premium) == "1.01" and prod["PC2"].underwriter_premium is None
    assert prod["PC1"].cover == 1000 and prod["PC1"].number_of_dependents == 0
    assert prod["PC1"].grace_period == "" and prod["PC1"].retail_premium == "99.50"
    assert prod["PC1"].hash_key == prod["PC1"].hash_diff


def test_policy_fact_five_lookups(spark, extract):
    land = captured(spark, [BASE,
                            dict(BASE, policy_number="P2", capture_date="13/01/2020"),
                            dict(BASE, policy_number="P3", client="Unknown Co"),
                            dict(BASE, policy_number="P4", cover="2000")])
    inputs = _dims(spark, land, extract)
    out = {r.policy_number: r for r in run_load(M.POLICY, inputs, stamp=None).collect()}
    # P3: client not in staging -> dropped by the inner lookup
    assert set(out) == {"P1", "P2", "P4"}
    assert out["P1"].capture_date == dt.date(2020, 1, 5)
    assert out["P1"].inception_date == dt.date(2020, 2, 1)
    assert out["P2"].capture_date is None
    assert out["P1"].product_id != out["P4"].product_id
    member_id = inputs[M.STG_MEMBER].first().member_id
    assert out["P1"].member_id == member_id


def test_beneficiary_cross_and_positional(spark):
    # the beneficiary lookup compares names as written: landing names already upper-case
    up = dict(BASE, first_name="JANE", last_name="DOE")
    land = captured(spark, [up, dict(up, beneficiary_full_name_2="Bobby")])
    member = with_surrogate_id(run_load(M.MEMBER, {M.CAPTURED: land}, stamp=None), "member_id")
    inputs = {M.CAPTURED: land, M.STG_MEMBER: member}
    out = run_load(M.MEMBER_BENEFICIARY_CROSS, inputs, stamp=None)
    # names {Ann, Bob, Bobby, null}, ids {1,2,null}, relations {SPOUSE, CHILD, null},
    # percentages {60, 40, null}, cells {071, 072, null}: 4*3*3*3*3 rows
    assert out.count() == 4 * 3 ** 4
    assert out.select("member_id").distinct().first().member_id == "800101"
    assert out.where(F.col("beneficiary_full_name").isNull()).first().hash_diff is None
    pos = run_load(M.MEMBER_BENEFICIARY, inputs, stamp=None)
    assert sorted(r.beneficiary_full_name for r in pos.collect()) == ["Ann", "Bob", "Bobby"]


def test_address_load_uses_member_key(spark):
    land = captured(spark, [BASE, BASE, dict(BASE, res_address_1="2 Main")])
    member = run_load(M.MEMBER, {M.CAPTURED: land}, stamp=None)
    out = run_load(M.MEMBER_ADDRESS, {M.CAPTURED: land, M.STG_MEMBER: member}, stamp=None).collect()
    # landing names are mixed case, staged names are upper: the faithful lookup drops them
    assert out == []
    upper = land.withColumn("first_name", F.upper("first_name")).withColumn("last_name", F.upper("last_name"))
    out = run_load(M.MEMBER_ADDRESS, {M.CAPTURED: upper, M.STG_MEMBER: member}, stamp=None).collect()
    assert len(out) == 2 and {r.member_id for r in out} == {"800101"}


def test_link_requires_dims_from_same_case(spark, extract):
    inputs = _dims(spark, captured(spark, [BASE]), extract)
    link = inputs[M.STG_BROKER_CLIENT].collect()
    assert len(link) == 1 and link[0].hash_key == link[0].hash_diff


def test_clean_and_nest(spark):
    df = spark.createDataFrame(
        [("D1", "12", "Clinic", "Town", "ST", 1234, "RR", "$10.5", "$", None),
         ("D2", "x9", "Bad", "Town", "ST", 1, "RR", "$1", "$2", "$3")],
        "`drg definition` string, `provider id` string, `provider name` string, `provider city` string,"
        " `provider state` string, `provider zip code` long, `hospital referral region description` string,"
        " `average covered charges` string, `average total payments` string,"
        " `average medicare payments` string")
    out = clean_and_nest(df)
    assert out.columns == ["drg", "provider", "rr", "charges"]
    r = out.collect()
    assert len(r) == 1
    assert r[0].provider.id == 12 and r[0].provider.zip == 1234
    assert r[0].charges.covered == 10.5 and r[0].charges.total_pay is None
    assert r[0].charges.medicare_pay is None
    assert flatten(out).columns[1] == "provider_id"


def test_beneficiary_full_and_empty_slot_rows(spark):
    full = {f"beneficiary_{f}_{i}": f"{f[0]}{i}" for i in range(1, 6) for f in M.BENEFICIARY_FIELDS}
    full.update({f"beneficiary_percentage_{i}": "20" for i in range(1, 6)})
    up = dict(BASE, first_name="JANE", last_name="DOE")
    empty = {c: None for c in M.beneficiary_slot_columns()}
    land = captured(spark, [dict(up, **full), dict(up, id_number="2", **empty)])
    member = with_surrogate_id(run_load(M.MEMBER, {M.CAPTURED: land}, stamp=None), "member_id")
    slots = run_load(M.MEMBER_BENEFICIARY, {M.CAPTURED: land, M.STG_MEMBER: member}, stamp=None)
    assert sorted((r.member_id, r.beneficiary_full_name, r.beneficiary_cell) for r in slots.collect()) == [
        ("800101", f"f{i}", f"c{i}") for i in range(1, 6)]
    out = run_load(M.MEMBER_BENEFICIARY_CROSS, {M.CAPTURED: land, M.STG_MEMBER: member}, stamp=None)
    counts = {r.member_id: r.n for r in out.groupBy("member_id").count().withColumnRenamed("count", "n").collect()}
    # 5 names x 5 ids x 5 relations x 1 percentage x 5 cells; the empty member keeps one all-null row
    assert counts == {"800101": 5 ** 4, "2": 1}
    assert out.where("member_id = '2'").first().hash_diff is None


def test_building_a_load_starts_no_job(spark, extract):
    inputs = _dims(spark, captured(spark, [BASE]), extract)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-only", "building a plan")
    try:
        run_load(M.POLICY, inputs, stamp=None)
        assert not tracker.getJobIdsForGroup("plan-only")
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_address_keeps_the_jobs_own_keys(spark):
    up = dict(BASE, first_name="JANE", last_name="DOE")
    land = captured(spark, [dict(up, gender="F"), dict(up, gender="M")])
    member = run_load(M.MEMBER, {M.CAPTURED: land}, stamp=None)
    out = run_load(M.MEMBER_ADDRESS, {M.CAPTURED: land, M.STG_MEMBER: member}, stamp=None).collect()
    # one address, two member rows: each member row's own gender is hashed
    assert len(out) == 2 and len({r.hash_diff for r in out}) == 2 and len({r.hash_key for r in out}) == 1


def test_unmatched_rows_name_the_lookup_that_misses(spark, extract):
    land = captured(spark, [dict(BASE, policy_number="P1"), dict(BASE, policy_number="P2", broker_code="none")])
    inputs = _dims(spark, land, extract)
    hit = {r.policy_number for r in run_load(M.POLICY, inputs, stamp=None).collect()}
    lost = {r.policy_number: r.missing for r in unmatched(M.POLICY, inputs).collect()}
    assert lost["P2"] == M.STG_BROKER and not hit & set(lost)
