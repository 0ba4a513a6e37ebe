import pytest

from nestlift.plans import specs
from nestlift.spec import JobSpec, SpecError, select_tables

SPEC = {
    **specs.CUSTOMERS,
    "_comment_1": "connection settings omitted",
    "CLIENT_ID": "client-id-placeholder", "API_TOKEN": "do-not-keep", "REGION": "north",
    "START_DATE": "2024-01-01T00:00:00.000Z",
    "END_DATE": "2024-01-30T23:59:59.999Z",
    "RETRIEVAL_INTERVAL": 7,
    "PAGE_SIZE": 100,
    "pages": "totalHits",
    "bronze_schema": "bronze",
    "silver_schema": "silver",
}


def test_from_dict():
    sp = JobSpec.from_dict(SPEC)
    assert sp.main_key == ("c_custkey",)
    assert sp.data_key == "customers" and sp.page_size == 100 and sp.interval_days == 7
    m = sp.child("customer_order_lines")
    assert m.path == ("orders", "lines")
    assert m.merge_keys == ["c_custkey", "o_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    assert list(m.output_schema)[:4] == ["c_custkey", "o_orderkey", "l_linenumber", "l_partkey"]
    assert sp.qualified("customers_main") == "silver.customers_main"


def test_credentials_are_neither_kept_nor_printed():
    sp = JobSpec.from_dict(SPEC)
    assert dict(sp.extra) == {"REGION": "north"}
    assert "placeholder" not in repr(sp) and "do-not-keep" not in repr(sp)


def test_child_column_overrides_key_type_keeps_position():
    d = dict(SPEC)
    d["nested_tables"] = [dict(SPEC["nested_tables"][0], unnested_to_table_key=[],
                               data_schema={"o_orderstatus": "string", "c_custkey": "string"})]
    c = JobSpec.from_dict(d).children[0]
    assert list(c.output_schema.items()) == [("c_custkey", "string"), ("o_orderstatus", "string")]


@pytest.mark.parametrize("patch", [
    {"RETRIEVAL_INTERVAL": 0},
    {"PAGE_SIZE": -1},
    {"main_table_key": "nope"},
    {"data_schema": {"c_custkey": "string", "C_CustKey": "string"}},
    {"START_DATE": "2025-08-01T00:00:00Z"},
])
def test_validate_rejects(patch):
    with pytest.raises(SpecError):
        JobSpec.from_dict({**SPEC, **patch})


def test_validate_nested_shapes():
    bad_parent = dict(SPEC["nested_tables"][0], parent_key=["c_custkey"])
    with pytest.raises(SpecError, match="parent_key"):
        JobSpec.from_dict({**SPEC, "nested_tables": [bad_parent]})
    bad_path = dict(SPEC["nested_tables"][0], unnested_column="orders")
    with pytest.raises(SpecError, match="unnested_column"):
        JobSpec.from_dict({**SPEC, "nested_tables": [bad_path]})


def test_select_tables():
    sp = JobSpec.from_dict(SPEC)
    names = ["customers_main", "customer_orders", "customer_order_lines", "customer_order_line_prices"]
    assert select_tables(sp, None) == (names, [])
    assert select_tables(sp, "  ,, ") == (names, [])
    assert select_tables(sp, " customer_orders, ,nope,customers_main ") == (names[:2], ["nope"])


def test_cluster_conf_sizes_partitions():
    from nestlift.session import cluster_conf

    c = cluster_conf(100 * (1 << 40), cores=8000)        # 100 TB on 8000 cores: a third of it shuffled
    assert int(c["spark.sql.shuffle.partitions"]) == 30720
    assert c["spark.sql.files.maxPartitionBytes"] == "256m"
    assert int(cluster_conf(1 << 20, cores=8)["spark.sql.shuffle.partitions"]) == 16
