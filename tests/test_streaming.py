import pytest

from landstage.plans import model as M
from landstage.plans.spec import LoadSpec, Unpivot
from landstage.streaming import run_incremental


def test_incremental_load_only_processes_new_files(spark, tmp_path):
    cols = ["agent_code", "agent", "contact_number"]
    landing = str(tmp_path / "landing")
    first = spark.createDataFrame([("A1", "Ann", "0821"), ("A1", "Ann", "0821"), ("A2", "Bo", "x")],
                                  ", ".join(f"{c} string" for c in cols))
    first.write.parquet(landing, mode="append")
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    assert run_incremental(spark, M.AGENT, landing, out, ckpt, stamp=None) == 1
    assert spark.read.parquet(out).count() == 2
    # nothing new: no batch, nothing appended
    run_incremental(spark, M.AGENT, landing, out, ckpt, stamp=None)
    assert spark.read.parquet(out).count() == 2
    spark.createDataFrame([("A3", "Cy", "0721")], ", ".join(f"{c} string" for c in cols)) \
        .write.parquet(landing, mode="append")
    run_incremental(spark, M.AGENT, landing, out, ckpt, stamp=None)
    got = sorted(r.agent_code for r in spark.read.parquet(out).collect())
    assert got == ["A1", "A2", "A3"]
    assert sorted({r.batch_id for r in spark.read.parquet(out).collect()}) == [0, 1]


def test_rerun_of_a_batch_replaces_its_output(spark, tmp_path):
    """A batch replayed after a failure (same id) must not duplicate rows."""
    from landstage.plans.spec import run_load
    cols = ["agent_code", "agent", "contact_number"]
    land = spark.createDataFrame([("A1", "Ann", "0821")], ", ".join(f"{c} string" for c in cols))
    out = str(tmp_path / "out")
    for _ in range(2):  # the same batch id written twice
        run_load(M.AGENT, {M.CAPTURED: land}, stamp=None).write.mode("overwrite") \
            .parquet(f"{out}/batch_id=0")
    assert spark.read.parquet(out).count() == 1


def test_rows_do_not_depend_on_files_per_batch(spark, tmp_path):
    schema = "agent_code string, agent string, contact_number string"
    landing = str(tmp_path / "landing")
    for rows in ([("A1", "Ann", "1"), ("A2", None, "x")], [("A1", "Ann", "1")], [("A1", "Ann", "1"), ("A2", None, "x"), ("A3", "Cy", None)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(landing, mode="append")
    got = []
    for n in (None, 1, 2):
        out = str(tmp_path / f"out{n}")
        batches = run_incremental(spark, M.AGENT, landing, out, str(tmp_path / f"ckpt{n}"), stamp=None, max_files_per_batch=n)
        assert batches == {None: 1, 1: 3, 2: 2}[n]
        got.append(sorted((tuple(r) for r in spark.read.parquet(out).drop("batch_id").collect()), key=repr))
    assert got[0] == got[1] == got[2] and len(got[0]) == 3


@pytest.mark.parametrize("mode", ["positional", "cross"])
@pytest.mark.parametrize("dedupe", [None, ("id_number", "first_name", "last_name", "a_1", "a_2", "b_1", "b_2")])
def test_unpivoted_rows_do_not_depend_on_files_per_batch(spark, tmp_path, mode, dedupe):
    spec = LoadSpec(name="slots", source="landing", target="t", source_table="landing", dedupe=dedupe,
                    unpivot=Unpivot("id_number", (("a", ("a_1", "a_2")), ("b", ("b_1", "b_2"))), mode=mode),
                    select=(("id_number", "id_number"), ("a", "a"), ("upper(b)", "b")), hash_key=("id_number",), hash_diff=("id_number", "a", "b"))
    schema = ", ".join(f"{c} string" for c in ("id_number", "first_name", "last_name", "a_1", "a_2", "b_1", "b_2"))
    landing = str(tmp_path / "landing")
    same = ("1", "Ann", "X", "p", "q", "r", "s")
    for rows in ([same, ("2", "Bo", "Y", "p", None, None, "s")], [same], [("1", "Anna", "X", "p", "q", "r", "s"), ("2", "Bo", "Y", "u", None, "v", None), same]):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(landing, mode="append")
    got = []
    for n in (None, 1, 2):
        out = str(tmp_path / f"out{n}")
        batches = run_incremental(spark, spec, landing, out, str(tmp_path / f"ckpt{n}"), stamp=None, max_files_per_batch=n)
        assert batches == {None: 1, 1: 3, 2: 2}[n]
        got.append(sorted((tuple(r) for r in spark.read.parquet(out).drop("batch_id").collect()), key=repr))
    assert got[0] == got[1] == got[2] and len(got[0]) == len(set(got[0]))


def test_beneficiaries_do_not_depend_on_files_per_batch(spark, tmp_path):
    names = ["first_name", "last_name", "id_number", *(c for _, cols in M.MEMBER_BENEFICIARY.unpivot.groups for c in cols)]
    row = tuple("1" if c == "id_number" else c if not c.startswith("beneficiary") or c.endswith("_1") else None for c in names)
    landing = str(tmp_path / "landing")
    for _ in range(2):
        spark.createDataFrame([row], ", ".join(f"{c} string" for c in names)).coalesce(1).write.parquet(landing, mode="append")
    dims = {M.STG_MEMBER: spark.createDataFrame([("first_name", "last_name", "1")], "first_name string, last_name string, id_number string")}
    for n in (None, 1):
        out = str(tmp_path / f"out{n}")
        run_incremental(spark, M.MEMBER_BENEFICIARY, landing, out, str(tmp_path / f"ckpt{n}"), dims=dims, stamp=None, max_files_per_batch=n)
        assert spark.read.parquet(out).count() == 1
