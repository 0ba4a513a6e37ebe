"""Job specs for the records built in ``nesting`` (same layout as a source's JSON spec)."""

from __future__ import annotations

from ..spec import JobSpec

LINE_SCHEMA = {
    "l_linenumber": "int",
    "l_partkey": "int",
    "l_suppkey": "int",
    "l_quantity": "double",
    "l_extendedprice": "double",
    "l_discount": "double",
    "l_tax": "double",
    "l_returnflag": "string",
    "l_linestatus": "string",
    "l_shipdate": "timestamp",
}

LINE_SHAPE = {
    "l_partkey": "BIGINT", "l_suppkey": "BIGINT", "l_linenumber": "INT", "l_quantity": "DOUBLE",
    "l_extendedprice": "DOUBLE", "l_discount": "DOUBLE", "l_tax": "DOUBLE",
    "l_returnflag": "STRING", "l_linestatus": "STRING", "l_shipdate": "TIMESTAMP",
}

ORDERS = {
    "main_table_name": "orders_main",
    "main_table_key": "o_orderkey",
    "data": "orders",
    "pages": "totalHits",
    "PAGE_SIZE": 100,
    "RETRIEVAL_INTERVAL": 7,
    "raw_table_name": "orders_raw",
    "data_schema": {
        "o_orderkey": "int",
        "o_custkey": "int",
        "o_orderstatus": "string",
        "o_totalprice": "double",
        "o_orderdate": "timestamp",
        "o_orderpriority": "string",
        "lines": "array",
        "partkeys": "array",
    },
    "nested_tables": [
        {
            "unnested_to_table": "order_lines",
            "parent_key": {"o_orderkey": "int"},
            "unnested_to_table_key": ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"],
            "unnested_column": ["lines"],
            "data_schema": LINE_SCHEMA,
        },
        {
            "unnested_to_table": "order_partkeys",
            "parent_key": {"o_orderkey": "int"},
            "unnested_to_table_key": ["partkeys_exploded"],
            "unnested_column": ["partkeys"],
            "data_schema": {"partkeys_exploded": "int"},
        },
    ],
    "full_schema": {
        "o_orderkey": "BIGINT", "o_custkey": "BIGINT", "o_orderstatus": "STRING",
        "o_totalprice": "DOUBLE", "o_orderdate": "TIMESTAMP", "o_orderpriority": "STRING",
        "lines": [LINE_SHAPE],
        "partkeys": "ARRAY<BIGINT>",
    },
}

PRICE_SCHEMA = {"step": "int", "flag": "string", "price": "double"}

CUSTOMERS = {
    "main_table_name": "customers_main",
    "main_table_key": "c_custkey",
    "data": "customers",
    "raw_table_name": "customers_raw",
    "data_schema": {
        "c_custkey": "int", "c_name": "string", "c_nationkey": "int", "c_acctbal": "currency",
        "c_mktsegment": "string", "orders": "array",
    },
    "nested_tables": [
        {
            "unnested_to_table": "customer_orders",
            "parent_key": {"c_custkey": "int"},
            "unnested_to_table_key": ["o_orderkey"],
            "unnested_column": ["orders"],
            "data_schema": {
                "o_orderkey": "int", "o_orderstatus": "string", "o_totalprice": "double",
                "o_orderdate": "timestamp", "o_orderpriority": "string", "lines": "array",
            },
        },
        {
            "unnested_to_table": "customer_order_lines",
            "parent_key": {"c_custkey": "int", "o_orderkey": "int"},
            "unnested_to_table_key": ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"],
            "unnested_column": ["orders", "lines"],
            "data_schema": LINE_SCHEMA,
        },
        {
            "unnested_to_table": "customer_order_line_prices",
            "parent_key": {"c_custkey": "int", "o_orderkey": "int", "l_linenumber": "int",
                           "l_partkey": "int", "l_suppkey": "int"},
            "unnested_to_table_key": ["step"],
            "unnested_column": ["orders", "lines", "prices"],
            "data_schema": PRICE_SCHEMA,
        },
    ],
    "full_schema": {
        "c_custkey": "BIGINT", "c_name": "STRING", "c_nationkey": "INT", "c_acctbal": "DOUBLE",
        "c_mktsegment": "STRING",
        "orders": [{
            "o_orderkey": "BIGINT", "o_orderstatus": "STRING", "o_totalprice": "DOUBLE",
            "o_orderdate": "TIMESTAMP", "o_orderpriority": "STRING",
            "lines": [dict(LINE_SHAPE, prices=[{"step": "INT", "flag": "STRING", "price": "DOUBLE"}])],
        }],
    },
}

CONVERSATIONS = {
    "main_table_name": "conversations_main",
    "main_table_key": "conv_id",
    "data": "conversations",
    "raw_table_name": "conversations_raw",
    "data_schema": {"conv_id": "int", "turns": "array"},
    "nested_tables": [
        {
            "unnested_to_table": "conversation_turns",
            "parent_key": {"conv_id": "int"},
            "unnested_to_table_key": ["turn"],
            "unnested_column": ["turns"],
            "data_schema": {"turn": "int", "role": "string", "text": "string"},
        },
    ],
    "full_schema": {"conv_id": "BIGINT",
                    "turns": [{"turn": "BIGINT", "role": "STRING", "text": "STRING"}]},
}

EVENTS = {
    "main_table_name": "events_main",
    "main_table_key": "event_id",
    "data": "events",
    "pages": "totalHits",
    "PAGE_SIZE": 100,
    "RETRIEVAL_INTERVAL": 7,
    "START_DATE": "2024-01-01T00:00:00.000Z",
    "END_DATE": "2024-01-30T23:59:59.999Z",
    "raw_table_name": "events_raw",
    "data_schema": {
        "event_id": "int", "ts": "timestamp", "user_id": "int", "event_type": "string",
        "value": "double", "props": "string",
    },
    "nested_tables": [
        {
            "unnested_to_table": "event_props",
            "parent_key": {"event_id": "int"},
            "unnested_to_table_key": [],
            "unnested_column": ["props"],
            "data_schema": {"k": "int"},
        },
    ],
}


def spec(d: dict) -> JobSpec:
    return JobSpec.from_dict(d)
