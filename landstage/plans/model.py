"""The staging model's loads as specs (landing -> staging).

Fixed values: the landing/staging table names, column names and
source_table literals below are the staging model's own and must stay as
they are for the loaded tables to line up with existing staging data.

Hashes always use the raw landing columns (before upper-casing or date
parsing).  Key expressions that differ in case handling between loads are
kept as the model defines them; a spec can be copied with
``dataclasses.replace`` to change a key expression.
"""

from __future__ import annotations

import dataclasses

from landstage.plans.spec import LoadSpec, Lookup, Unpivot, date_of, dec_of, int_of

# ---- fixed values: table names and source_table literals ----------------------------
CAPTURED = "landing_member_captured_list"
MEMBER_LIST = "landing_member_list"
PRODUCT_EXTRACT = "landing_product_extract_list"
STG_AGENT = "staging_agent"
STG_BROKER = "staging_broker"
STG_CLIENT = "staging_client"
STG_BROKER_CLIENT = "staging_broker_client"
STG_MEMBER = "staging_member"
STG_MEMBER_ADDRESS = "staging_member_address"
STG_MEMBER_BENEFICIARY = "staging_member_beneficiary"
STG_PRODUCT = "staging_product"
STG_POLICY = "staging_policy"

ADDRESS_COLS = ("postal_add_1", "postal_add_2", "postal_add_3", "postal_code",
                "res_address_1", "res_address_2", "res_address_3", "res_code")
BENEFICIARY_FIELDS = ("full_name", "id_number", "relation", "percentage", "cell")
BENEFICIARY_SLOTS = 5
PRODUCT_COLS = ("policy_code", "policy_description", "relate_to", "age_from", "age_to", "premium",
                "underwriter_premium", "cover", "waiting_period", "product_category",
                "product_type", "broker_code", "broker_name", "client", "underwriter")


def beneficiary_slot_columns() -> list[str]:
    """beneficiary_<field>_<i> for i = 1..5, slot by slot."""
    return [f"beneficiary_{f}_{i}" for i in range(1, BENEFICIARY_SLOTS + 1) for f in BENEFICIARY_FIELDS]


# L1 agent (captured list)
AGENT = LoadSpec(
    name="agent", source=CAPTURED, target=STG_AGENT, source_table=CAPTURED,
    dedupe=("agent_code", "agent", "contact_number"),
    select=(("agent_code", "agent_code"), ("agent", "agent_name"),
            (int_of("contact_number"), "contact_number")),
    hash_key=("agent_code", "agent"),
    hash_diff=("agent_code", "agent", "contact_number"),
)

# L2 broker (captured list): names kept as written
BROKER = LoadSpec(
    name="broker", source=CAPTURED, target=STG_BROKER, source_table=CAPTURED,
    dedupe=("broker_code", "broker", "branch_name"),
    select=(("broker_code", "broker_code"), ("broker", "broker_name"),
            ("branch_name", "broker_branch")),
    hash_key=("broker_code", "broker", "branch_name"),
    hash_diff=("broker_code", "broker", "branch_name"),
)

# L3 client (captured list)
CLIENT = LoadSpec(
    name="client", source=CAPTURED, target=STG_CLIENT, source_table=CAPTURED,
    dedupe=("client",),
    select=(("client", "client_name"),),
    hash_key=("client",), hash_diff=("client",),
)

# L4 member (captured list): upper-cased names, ISO birth date, empty title
MEMBER = LoadSpec(
    name="member", source=CAPTURED, target=STG_MEMBER, source_table=CAPTURED,
    dedupe=("first_name", "last_name", "id_number", "gender", "date_of_birth"),
    select=(("upper(first_name)", "first_name"), ("upper(last_name)", "last_name"),
            ("id_number", "id_number"), ("gender", "gender"),
            (date_of("date_of_birth", "yyyy-MM-dd"), "birth_date"), ("''", "title")),
    hash_key=("id_number", "first_name", "last_name"),
    hash_diff=("id_number", "first_name", "last_name", "gender", "date_of_birth"),
)

# L5 member address: deduplicated on names, id and address; the member is looked up on
# names + id as written and gives gender and birth date for the change hash (the
# birth date as the ISO text of the member dimension's date)
MEMBER_ADDRESS = LoadSpec(
    name="member_address", source=CAPTURED, target=STG_MEMBER_ADDRESS, source_table=CAPTURED,
    dedupe=("first_name", "last_name", "id_number") + ADDRESS_COLS,
    lookups=(Lookup(STG_MEMBER, (("first_name", "first_name"), ("last_name", "last_name"),
                                 ("id_number", "id_number")),
                    (("id_number", "member_id"), ("gender", "gender"), ("birth_date", "birth_date"))),),
    select=(("member_id", "member_id"),) + tuple((c, c) for c in ADDRESS_COLS),
    hash_key=("id_number", "first_name", "last_name"),
    hash_diff=("id_number", "first_name", "last_name", "gender", "birth_date"),
)

# L6 member beneficiary: five numbered slots, the fields of a slot stay together.  The
# distinct at the end covers the landing dedupe (an equal landing row gives equal
# slots), so the landing side is shuffled for the lookup and for the distinct only.
MEMBER_BENEFICIARY = LoadSpec(
    name="member_beneficiary", source=CAPTURED, target=STG_MEMBER_BENEFICIARY,
    source_table=MEMBER_LIST,
    lookups=(Lookup(STG_MEMBER, (("first_name", "first_name"), ("last_name", "last_name"),
                                 ("id_number", "id_number")),
                    (("id_number", "member_id"),)),),
    unpivot=Unpivot("member_id", tuple(
        (f"beneficiary_{f}", tuple(f"beneficiary_{f}_{i}" for i in range(1, BENEFICIARY_SLOTS + 1)))
        for f in BENEFICIARY_FIELDS), mode="positional"),
    select=(("member_id", "member_id"), ("beneficiary_full_name", "beneficiary_full_name"),
            ("beneficiary_id_number", "beneficiary_id_number"),
            ("beneficiary_relation", "beneficiary_relation"),
            (int_of("beneficiary_percentage"), "beneficiary_percentage"),
            ("beneficiary_cell", "beneficiary_cell")),
    hash_key=("member_id",),
    hash_diff=("member_id", "beneficiary_full_name", "beneficiary_id_number",
               "beneficiary_relation", "beneficiary_percentage", "beneficiary_cell"),
)

# L6 with the landing dedupe before the lookup, as the job has it: a member's landing rows are as
# many as their policies and 28 texts wide, and are made one where they lie before any is shuffled
MEMBER_BENEFICIARY_DISTINCT = dataclasses.replace(
    MEMBER_BENEFICIARY, dedupe=("first_name", "last_name", "id_number") + tuple(beneficiary_slot_columns()))

# L6 in the legacy layout: every combination of a member's distinct values, an explicit option
MEMBER_BENEFICIARY_CROSS = dataclasses.replace(
    MEMBER_BENEFICIARY_DISTINCT, name="member_beneficiary_cross",
    unpivot=dataclasses.replace(MEMBER_BENEFICIARY.unpivot, mode="cross"))

# L7 policy (fact): five lookups, later keys come from earlier lookups
POLICY = LoadSpec(
    name="policy", source=CAPTURED, target=STG_POLICY, source_table=CAPTURED,
    lookups=(
        Lookup(STG_MEMBER, (("upper(last_name)", "last_name"), ("upper(first_name)", "first_name"),
                            ("id_number", "id_number")), (("member_id", "member_id"),)),
        Lookup(STG_BROKER, (("broker_code", "broker_code"), ("upper(broker)", "broker_name")),
               (("broker_id", "broker_id"),)),
        Lookup(STG_CLIENT, (("upper(client)", "client_name"),), (("client_id", "client_id"),)),
        Lookup(STG_BROKER_CLIENT, (("broker_id", "broker_id"), ("client_id", "client_id")),
               (("broker_client_id", "broker_client_id"),)),
        Lookup(STG_PRODUCT, (("broker_client_id", "broker_client_id"),
                             ("policy_description", "policy_description"),
                             (int_of("cover"), "cover"), ("member_type", "relate_to")),
               (("product_id", "product_id"),)),
    ),
    select=(("policy_number", "policy_number"), ("member_id", "member_id"),
            ("product_id", "product_id"),
            (date_of("capture_date", "MM/dd/yyyy"), "capture_date"),
            (date_of("inception", "MM/dd/yyyy"), "inception_date"), ("status", "status")),
    hash_key=("policy_number", "member_id", "product_id", "capture_date", "inception", "status"),
    hash_diff=("policy_number", "member_id", "product_id", "capture_date", "inception", "status"),
)

# L8 member (member list): no dedupe, names as written, M/D/Y birth date, title kept
MEMBER_FROM_LIST = LoadSpec(
    name="member_from_list", source=MEMBER_LIST, target=STG_MEMBER, source_table=MEMBER_LIST,
    select=(("first_name", "first_name"), ("last_name", "last_name"), ("id_number", "id_number"),
            ("gender", "gender"), (date_of("birth_date", "MM/dd/yyyy"), "birth_date"),
            ("title", "title")),
    hash_key=("id_number", "first_name", "last_name"),
    hash_diff=("id_number", "first_name", "last_name", "gender", "birth_date", "title"),
)

# L9 broker (product extract): upper-cased name, empty branch
BROKER_FROM_EXTRACT = LoadSpec(
    name="broker_from_extract", source=PRODUCT_EXTRACT, target=STG_BROKER,
    source_table=PRODUCT_EXTRACT,
    dedupe=("broker_code", "broker_name"),
    select=(("broker_code", "broker_code"), ("upper(broker_name)", "broker_name"),
            ("''", "broker_branch")),
    hash_key=("broker_code", "broker_name"), hash_diff=("broker_code", "broker_name"),
)

# L10 broker_client link: distinct upper-cased keys, both ids looked up
BROKER_CLIENT = LoadSpec(
    name="broker_client", source=PRODUCT_EXTRACT, target=STG_BROKER_CLIENT,
    source_table=PRODUCT_EXTRACT,
    dedupe=("upper(broker_code)", "upper(broker_name)", "upper(client)"),
    dedupe_names=("broker_code", "broker_name", "client"),
    lookups=(
        Lookup(STG_BROKER, (("broker_code", "broker_code"), ("broker_name", "broker_name")),
               (("broker_id", "broker_id"),)),
        Lookup(STG_CLIENT, (("client", "client_name"),), (("client_id", "client_id"),)),
    ),
    select=(("broker_id", "broker_id"), ("client_id", "client_id")),
    hash_key=("broker_id", "client_id"), hash_diff=("broker_id", "client_id"),
)

# L11 client (product extract): upper-cased name
CLIENT_FROM_EXTRACT = LoadSpec(
    name="client_from_extract", source=PRODUCT_EXTRACT, target=STG_CLIENT,
    source_table=PRODUCT_EXTRACT,
    dedupe=("client",),
    select=(("upper(client)", "client_name"),),
    hash_key=("client",), hash_diff=("client",),
)

# L12 product: three lookups, casts, constants
PRODUCT = LoadSpec(
    name="product", source=PRODUCT_EXTRACT, target=STG_PRODUCT, source_table=PRODUCT_EXTRACT,
    dedupe=PRODUCT_COLS,
    lookups=(
        Lookup(STG_BROKER, (("broker_code", "broker_code"), ("broker_name", "broker_name")),
               (("broker_id", "broker_id"),)),
        Lookup(STG_CLIENT, (("client", "client_name"),), (("client_id", "client_id"),)),
        Lookup(STG_BROKER_CLIENT, (("broker_id", "broker_id"), ("client_id", "client_id")),
               (("broker_client_id", "broker_client_id"),)),
    ),
    select=(("policy_code", "policy_code"), ("policy_description", "policy_description"),
            ("broker_client_id", "broker_client_id"), ("relate_to", "relate_to"),
            ("premium", "retail_premium"), ("underwriter", "underwriter"),
            (int_of("age_to"), "age_to"), (int_of("age_from"), "age_from"),
            (dec_of("underwriter_premium", 7, 2), "underwriter_premium"),
            (int_of("cover"), "cover"), (int_of("waiting_period"), "waiting_period"),
            ("product_category", "product_category"), ("product_type", "product_type"),
            ("''", "grace_period"), ("0", "number_of_dependents")),
    hash_key=("policy_code", "policy_description", "broker_client_id", "relate_to", "age_from",
              "age_to"),
    hash_diff=("policy_code", "policy_description", "broker_client_id", "relate_to", "age_from",
               "age_to"),
)

LOADS = {s.name: s for s in (AGENT, BROKER, CLIENT, MEMBER, MEMBER_ADDRESS, MEMBER_BENEFICIARY, MEMBER_BENEFICIARY_CROSS,
                             POLICY, MEMBER_FROM_LIST, BROKER_FROM_EXTRACT, BROKER_CLIENT,
                             CLIENT_FROM_EXTRACT, PRODUCT)}


def lookup_keys(target: str) -> tuple[str, ...]:
    """The columns by which loads look up rows of a staging table (its bucket keys); none if no load does.

    Loads that name the same columns in another order count as one key.
    """
    found = {frozenset(c for _, c in lk.on): tuple(c for _, c in lk.on) for s in reversed(LOADS.values()) for lk in s.lookups if lk.dim == target}
    if len(found) > 1:
        raise ValueError(f"{target} is looked up by different keys: {sorted(found.values())}")
    return next(iter(found.values()), ())
