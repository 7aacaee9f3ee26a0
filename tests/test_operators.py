import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from landstage.functions import hash_of
from landstage.operators import (apply_mapping, dedupe, explode_field, lookup, map_columns,
                                 map_records, relationalize, resolve_choice, row_id, combinations, unpivot_cross, unpivot_factored,
                                 unpivot_positional, with_surrogate_id)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_dedupe_null_keys_form_one_group(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("a", "x"), (None, None)], "k string, v string")
    assert len(dedupe(df, ["k", "v"]).collect()) == 3
    counted = {(r.k, r.v): r["count"] for r in dedupe(df, ["k", "v"], keep_count=True).collect()}
    assert counted[("a", None)] == 2


def test_dedupe_derived_keys(spark):
    df = spark.createDataFrame([("Acme",), ("ACME",), ("acme",)], "n string")
    assert dedupe(df, [F.upper("n").alias("n")]).count() == 1


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 3)), max_size=30),
       st.integers(1, 5))
def test_dedupe_idempotent_and_partition_independent(spark, data, parts):
    df = spark.createDataFrame(data, "k string, v int") if data else \
        spark.createDataFrame([], "k string, v int")
    once = dedupe(df.repartition(parts), ["k", "v"])
    twice = dedupe(once, ["k", "v"])
    assert rows(once, "k", "v") == rows(twice, "k", "v") == sorted(set(data), key=repr)
    h1 = rows(df.repartition(parts).select(hash_of("k", "v").alias("h")), "h")
    h2 = rows(df.coalesce(1).select(hash_of("k", "v").alias("h")), "h")
    assert h1 == h2


@pytest.fixture
def dims(spark):
    broker = spark.createDataFrame(
        [(1, "B1", "ACME", "x"), (2, "B2", "ZETA", "y"), (3, "B2", "ZETA", "z"), (4, None, "NUL", "w")],
        "broker_id long, broker_code string, broker_name string, hash_key string")
    landing = spark.createDataFrame(
        [("B1", "acme", 10), ("B2", "Zeta", 20), ("B9", "none", 30), (None, "nul", 40)],
        "broker_code string, broker string, amount int")
    return broker, landing


def test_lookup_inner_upper_key_fanout_and_nulls(dims):
    broker, landing = dims
    out = lookup(landing, broker, [("broker_code", "broker_code"), ("upper(broker)", "broker_name")],
                 {"broker_id": "broker_id"})
    assert out.columns == ["broker_code", "broker", "amount", "broker_id"]
    # B2 fans out to two dim rows, B9 is unmatched, null code never matches
    assert rows(out, "amount", "broker_id") == [(10, 1), (20, 2), (20, 3)]


def test_lookup_dim_unique_and_salt_and_broadcast_give_same_rows(dims):
    broker, landing = dims
    on = [("broker_code", "broker_code"), ("upper(broker)", "broker_name")]
    uniq = lookup(landing, broker, on, ["broker_id"], dim_unique=True)
    assert rows(uniq, "amount", "broker_id") == [(10, 1), (20, 2)]
    base = rows(lookup(landing, broker, on, ["broker_id"]), "amount", "broker_id")
    assert rows(lookup(landing, broker, on, ["broker_id"], salt=4), "amount", "broker_id") == base


def test_lookup_keeps_clashing_names_apart(spark):
    left = spark.createDataFrame([("k1", "left-hash")], "code string, hash_key string")
    dim = spark.createDataFrame([("k1", 5, "dim-hash")], "code string, id int, hash_key string")
    out = lookup(left, dim, ["code"], {"id": "dim_id"})
    assert out.columns == ["code", "hash_key", "dim_id"]
    assert out.first().hash_key == "left-hash"


def test_salted_lookup_spreads_identical_hot_rows(spark):
    left = spark.createDataFrame([("k", 1)] * 400 + [("j", 2)] * 4, "k string, v int").repartition(4)
    dim = spark.createDataFrame([("k", 10), ("j", 20)], "k string, w int")
    out = lookup(left, dim, ["k"], ["w"], salt=8)
    assert out.count() == 404 and out.agg(F.sum("w")).first()[0] == 400 * 10 + 4 * 20
    salts = left.select(F.pmod(F.xxhash64("k", "v", F.monotonically_increasing_id()), F.lit(8)).alias("s"))
    assert salts.where("s IS NOT NULL").select("s").distinct().count() > 1


def test_lookup_rejects_duplicate_output_names(dims):
    broker, landing = dims
    with pytest.raises(ValueError):
        lookup(landing, broker, [("broker_code", "broker_code")], {"broker_name": "broker"})


def test_cast_key_lookup(spark):
    left = spark.createDataFrame([("1000.50", "p"), ("abc", "q")], "cover string, d string")
    dim = spark.createDataFrame([(1000, 7)], "cover int, product_id int")
    out = lookup(left, dim, [("try_cast(try_cast(cover AS DECIMAL(38,18)) AS INT)", "cover")],
                 ["product_id"])
    assert rows(out, "d", "product_id") == [("p", 7)]


SLOTS = {"name": ["name_1", "name_2", "name_3"], "rel": ["rel_1", "rel_2", "rel_3"]}


@pytest.fixture
def slot_frame(spark):
    return spark.createDataFrame(
        [("m1", "Ann", "Bob", None, "SPOUSE", "CHILD", None),
         ("m1", "Ann", None, None, "SPOUSE", None, None),
         ("m2", None, None, None, None, None, None),
         (None, "X", None, None, "Y", None, None)],
        "m string, name_1 string, name_2 string, name_3 string, rel_1 string, rel_2 string, rel_3 string")


def test_unpivot_cross_is_product_of_distinct_values(slot_frame):
    out = unpivot_cross(slot_frame, "m", SLOTS)
    got = rows(out, "m", "name", "rel")
    # m1: names {Ann, Bob, null} x relations {SPOUSE, CHILD, null} = 9; m2: {null} x {null}
    assert len([r for r in got if r[0] == "m1"]) == 9
    assert [r for r in got if r[0] == "m2"] == [("m2", None, None)]
    assert all(r[0] is not None for r in got)


def test_unpivot_cross_is_the_same_for_any_bound(slot_frame):
    plain = rows(unpivot_cross(slot_frame, "m", SLOTS), "m", "name", "rel")
    for over in (1, 2, 1000):
        for spread in (1, 2, 5, 1000):
            assert rows(unpivot_cross(slot_frame, "m", SLOTS, over=over, spread=spread), "m", "name", "rel") == plain


def test_factored_row_has_a_set_per_group(slot_frame):
    got = {r["m"]: (set(r["name"]), set(r["rel"]), r["n"]) for r in unpivot_factored(slot_frame, "m", SLOTS).withColumn("n", combinations(list(SLOTS))).collect()}
    assert got == {"m1": ({"Ann", "Bob", None}, {"SPOUSE", "CHILD", None}, 9), "m2": ({None}, {None}, 1)}


def test_buckets_of_a_heavy_key_are_disjoint_and_complete(spark):
    """Two wide groups and a narrow one: a grid of buckets, none much wider than ``over``."""
    df = spark.range(3000).select((F.col("id") % 2).alias("m"), F.when(F.col("id") % 2 == 0, F.col("id") % 400).alias("a"), (F.col("id") % 90).alias("b"), (F.col("id") % 3).alias("c"))
    df = df.where("m = 0 or id < 50")
    sets = unpivot_factored(df, "m", {"a": ["a"], "b": ["b"], "c": ["c"]}, over=30)
    got = sets.where("m = 0").collect()
    assert len(got) > 10 and max(max(len(r["a"]), len(r["b"])) for r in got) < 60
    made = [(x, y, z) for r in got for x in r["a"] for y in r["b"] for z in r["c"]]
    assert len(made) == len(set(made)) == 200 * 45 * 3
    assert sets.where("m = 1").count() == 1                # 25 rows: not heavy, one row


def test_unpivot_keeps_arrays_and_structs(spark):
    df = spark.createDataFrame([("m", [1, 2], None, (1, "x"), (2, "y")), ("m", [1, 2], [3], (1, "x"), None)],
                               "m string, a1 array<int>, a2 array<int>, s1 struct<p:int,q:string>, s2 struct<p:int,q:string>")
    groups = {"a": ["a1", "a2"], "s": ["s1", "s2"]}
    want = {(a, s) for a in ((1, 2), (3,), None) for s in ((1, "x"), (2, "y"), None)}
    for over in (1, 100):
        out = unpivot_cross(df, "m", groups, over=over)
        assert out.schema["a"].dataType == df.schema["a1"].dataType and out.schema["s"].dataType == df.schema["s1"].dataType
        got = [(r["a"] and tuple(r["a"]), r["s"] and tuple(r["s"])) for r in out.collect()]
        assert set(got) == want and len(got) == 9


def test_unpivot_positional_keeps_slots_aligned(slot_frame):
    out = unpivot_positional(slot_frame, "m", SLOTS)
    assert rows(out, "m", "name", "rel") == sorted(
        [("m1", "Ann", "SPOUSE"), ("m1", "Bob", "CHILD"), (None, "X", "Y")], key=repr)
    with_pos = unpivot_positional(slot_frame, "m", SLOTS, keep_position=True, distinct=False)
    assert with_pos.where("m = 'm1'").count() == 3


def test_explode_field_drops_null_and_empty_arrays(spark):
    df = spark.createDataFrame(
        [(1, [{"a": "x", "b": 1}, None]), (2, []), (3, None)],
        "id int, arr array<struct<a:string,b:int>>")
    out = explode_field(df, "arr", "e", keep=["id"])
    assert out.count() == 2
    assert explode_field(df, "arr", "e", keep=["id"], outer=True).count() == 4
    got = out.select("id", F.col("e.a")).collect()
    assert sorted((r[0], r[1]) for r in got if r[1]) == [(1, "x")]


def test_apply_mapping_nests_casts_and_drops_unlisted(spark):
    df = spark.createDataFrame([("D1", "12", "Clinic", "99", "ignored")],
                               "`drg definition` string, `provider id` string, `provider name` string,"
                               " amount string, other string")
    out = apply_mapping(df, [("drg definition", "string", "drg", "string"),
                             ("provider id", "long", "provider.id", "long"),
                             ("provider name", "string", "provider.name", "string"),
                             ("amount", "string", "charges.covered", "double")])
    assert out.columns == ["drg", "provider", "charges"]
    r = out.first()
    assert r.provider.id == 12 and r.provider.name == "Clinic" and r.charges.covered == 99.0


def test_apply_mapping_flattens_dotted_sources(spark):
    df = spark.createDataFrame([({"id": "7", "name": "Clinic"}, "x")],
                               "provider struct<id:string,name:string>, `a.b` string")
    out = apply_mapping(df, [("provider.id", "string", "provider_id", "long"),
                             ("provider.name", "string", "info.name", "string"),
                             ("a.b", "string", "ab", "string")])
    r = out.first()
    assert out.columns == ["provider_id", "info", "ab"]
    assert r.provider_id == 7 and r.info.name == "Clinic" and r.ab == "x"


def test_resolve_choice_cast_nulls_bad_values(spark):
    df = spark.createDataFrame([("123",), ("abc",), ("1.5",)], "`provider id` string")
    got = [r[0] for r in resolve_choice(df, [("provider id", "cast:long")]).collect()]
    assert got == [123, None, 1]


def test_relationalize_root_children_and_nested_arrays(spark):
    df = spark.createDataFrame(
        [(1, {"value": "v1", "n": 2}, [{"t": "a", "xs": [1, 2]}, {"t": "b", "xs": []}]),
         (2, {"value": "v2", "n": 3}, None)],
        "test_id int, test_val struct<value:string,n:int>, rel_list array<struct<t:string,xs:array<int>>>")
    frames = relationalize(df, "root", key=["test_id"])
    assert set(frames) == {"root", "root_rel_list", "root_rel_list_rel_list_val_xs"}
    root = frames["root"]
    assert root.columns == ["test_id", "test_val.value", "test_val.n", "rel_list"]
    r1, r2 = sorted(root.collect(), key=lambda r: r.test_id)
    assert r2["rel_list"] is None and r1["rel_list"] is not None
    child = frames["root_rel_list"]
    assert child.columns[:2] == ["id", "index"]
    assert rows(child, "id", "index", "`rel_list.val.t`") == [
        (r1["rel_list"], 0, "a"), (r1["rel_list"], 1, "b")]
    grand = frames["root_rel_list_rel_list_val_xs"]
    assert sorted(r["rel_list.val.xs.val"] for r in grand.collect()) == [1, 2]
    # element ids link grandchild rows to child rows
    assert grand.select("id").distinct().count() == 1


def test_map_records_keeps_types_and_nulls(spark):
    df = spark.createDataFrame([(9007199254740993, 4, "maestro"), (None, None, "duo")], "id long, size int, name string")
    seen = "id long, size int, name string, kinds string"

    def note(rec):
        return {**rec, "id": None if rec["id"] is None else rec["id"] + 2, "kinds": f"{type(rec['id']).__name__} {type(rec['size']).__name__}"}

    expected = [(9007199254740995, 4, "maestro", "int int"), (None, None, "duo", "NoneType NoneType")]
    assert [tuple(r) for r in map_records(df, note, seen).collect()] == expected
    assert [tuple(r) for r in map_columns(df, {"size": "size + 1"}).collect()] == [(9007199254740993, 5, "maestro"), (None, None, "duo")]

    def whole(batch):
        import pyarrow as pa
        import pyarrow.compute as pc
        return pa.table({"name": batch.column("name"), "id": pc.add(batch.column("id"), 2)})

    vec = map_records(df, whole, "id long, name string", vectorized=True)
    assert [tuple(r) for r in vec.collect()] == [(9007199254740995, "maestro"), (None, "duo")]


def test_row_ids_tell_nulls_and_parts_apart(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("a", "b"), ("ab", ""), ("", "ab"), (None, None)], "x string, y string")
    assert df.select(row_id("x", "y").alias("i")).distinct().count() == 6
    twins = spark.createDataFrame([(1, ["p"]), (1, ["q"])], "k int, xs array<string>")
    frames = relationalize(twins)
    assert frames["root"].select("xs").distinct().count() == 2
    pairs = frames["root"].join(frames["root_xs"], F.col("xs") == F.col("id"))
    assert pairs.count() == 2


def test_names_with_spaces(spark):
    df = spark.createDataFrame([("1", "x"), ("1", "x")], "`provider id` string, provider string")
    assert dedupe(df, ["provider id"]).columns == ["provider id"]
    with pytest.raises(ValueError):
        dedupe(df, ["provider name"])


def test_surrogate_id_is_stable_and_from_hash(spark):
    df = spark.createDataFrame([("B1", "ACME")], "code string, name string") \
        .select("*", hash_of("code", "name").alias("hash_key"))
    a = with_surrogate_id(df, "broker_id").first().broker_id
    b = with_surrogate_id(df.repartition(3), "broker_id").first().broker_id
    import hashlib
    assert a == b == hashlib.sha1(b"B1ACME").hexdigest()


def test_relationalize_array_in_array(spark):
    df = spark.createDataFrame([(1, [[1, 2], [], None, [3]]), (2, [])], "id int, m array<array<int>>")
    frames = relationalize(df, "root", key=["id"])
    assert set(frames) == {"root", "root_m", "root_m_m_val"}
    child = frames["root_m"]
    # one child row per outer element (empty inner arrays and null elements included)
    assert child.count() == 4
    inner = sorted(r["m.val.val"] for r in frames["root_m_m_val"].collect())
    assert inner == [1, 2, 3]
    # every grandchild id is the id of a child row
    child_ids = {r["m.val"] for r in child.collect() if r["m.val"] is not None}
    assert {r.id for r in frames["root_m_m_val"].collect()} <= child_ids


def test_unmatched_rows_of_a_lookup(dims):
    """D9: the landing rows an inner lookup would drop, via a left-anti lookup."""
    broker, landing = dims
    on = [("broker_code", "broker_code"), ("upper(broker)", "broker_name")]
    missing = lookup(landing, broker, on, how="left_anti")
    assert missing.columns == landing.columns
    assert rows(missing, "amount") == [(30,), (40,)]
    kept = lookup(landing, broker, on, ["broker_id"]).select("amount").distinct().count()
    assert kept + missing.count() == landing.count()
