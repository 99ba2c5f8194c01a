import json
import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from keepsight.operators import cleaning, customers, events
from keepsight.plans.retention import MASTER_REPORTS, Inputs, run
from keepsight.sources import tables
from keepsight.sources.sample_tables import CUSTOMER_ALIASES, MEMBER_ALIASES, SampleTables
from tests.helpers import by_key, rows

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def docs(spark, tmp_path):
    lines = [
        {"customer_id": 1, "member_id": 5, "timestamp": "2024-01-01T10:00:00Z", "feature": "f"},
        {"customerId": "2", "userId": 6, "timestamp": {"$date": "2024-01-02T00:00:00Z"}},
        {"customerID": 3, "userID": "7", "timestamp": "01/02/2024", "event_type": "view"},
        {"customerId": 4, "customerID": 9, "memberId": 8, "feature": None},
        {"customer_id": None, "customerId": 5, "session_duration_sec": 12},
        {"customer_id": "x", "timestamp": {"$date": {"$numberLong": "1704067200500"}}},
    ]
    path = tmp_path / "events.json"
    path.write_text("\n".join([*map(json.dumps, lines), "not json"]))
    return tables.read_documents(spark, str(path))


def test_documents_with_names_that_differ_in_case(docs):
    got = rows(tables.activity_events(docs))
    assert [r[:2] for r in got] == [(1, 5), (2, 6), (3, 7), (4, 8), (5, None), (None, None)]
    assert [r[2] for r in got] == [
        datetime(2024, 1, 1, 10),
        datetime(2024, 1, 2),
        None,
        None,
        None,
        datetime(2024, 1, 1, 0, 0, 0, 500000),
    ]
    assert got[0][4] == "f" and got[2][3] == "view" and got[4][5] == 12.0


IDS = {
    "7": 7, "-7": -7, "7.5": 7, "7e0": 7, "-7.9": -7, '"7"': 7, '" 7 "': 7, '"7.5"': None, '"x"': None, '""': None,
    '{"$numberInt": "7"}': 7, '{"$numberLong": "9007199254740993"}': 9007199254740993,
    '{"$numberDouble": "7.0"}': 7, '{"$numberDouble": "7.9"}': 7, '{"$numberDouble": "NaN"}': None,
    '{"$numberDecimal": "7.0E0"}': 7, '{"other": "7"}': None, "[7]": None, "null": None, "1e300": None,
    "9007199254740993": 9007199254740993,
}


def test_ids_of_documents_by_value(table):
    lines = [(f'{{"customerID": {text}, "memberId": {text}, "timestamp": "2024-01-0{1 + i % 9}"}}',) for i, text in enumerate(IDS)]
    docs = tables.documents(table(lines, "value string"))
    got = rows(tables.activity_events(docs), "customer_id", "member_id")
    assert got == [(number, number) for number in IDS.values()]
    assert rows(tables.onboarding_events(docs), "member_id") == [(number,) for number in IDS.values()]


def test_first_id_that_is_there_decides(table):
    lines = [
        ('{"customer_id": "x", "customerId": 5}',),
        ('{"customer_id": null, "customerId": {"$numberInt": "5"}, "customerID": 6}',),
        ("{}",),
    ]
    docs = tables.documents(table(lines, "value string"))
    assert rows(tables.activity_events(docs), "customer_id") == [(None,), (5,), (None,)]


@pytest.fixture
def scanned(spark, tmp_path):
    path = tmp_path / "lines.json"
    path.write_text('{"a": 1}\nnot json\n\n[1,2]\n"text"\nnull\n{"a": 1, "a": 2}\n{"a":\n{"b": {"c": null}}\n  \n')
    return tables.scan_documents(spark, str(path))


def test_scan_keeps_rejected_lines(scanned):
    got = rows(scanned.select(F.to_json("doc"), "rejected"))
    assert [doc for doc, _ in got if doc] == ['{"a":1}', '{"b":{"c":null}}']
    assert [line for _, line in got if line] == ["not json", "[1,2]", '"text"', "null", '{"a": 1, "a": 2}', '{"a":']
    assert all((doc is None) != (line is None) for doc, line in got)
    assert rows(tables.scan_report(scanned)) == [("documents", 2), ("rejected lines", 6)]


def test_scan_of_an_empty_file(spark, tmp_path):
    (tmp_path / "none.json").write_text("")
    scanned = tables.scan_documents(spark, str(tmp_path / "none.json"))
    assert rows(tables.scan_report(scanned)) == [("documents", 0), ("rejected lines", 0)]
    assert tables.read_documents(spark, str(tmp_path / "none.json")).count() == 0


def test_find_one(docs):
    order = [F.try_variant_get("doc", "$.customerId", "int").desc()]
    found = events.find_one(docs, tables.has_field("customerId"), order)
    assert rows(tables.document_fields(found, {"id": "customerId int"})) == [(5,)]
    assert events.find_one(docs, tables.has_field("none"), order).count() == 0


def test_document_presence(docs):
    assert rows(tables.document_presence(docs)) == [
        ("customerID", 1),
        ("customerId", 1),
        ("customerId,customerID", 1),
        ("customer_id", 2),
        ("customer_id,customerId", 1),
    ]


def test_lines_that_are_no_json_are_counted(table):
    lines = table([('{"a": 1}',), ("not json",), (None,), ("null",)], "value string")
    assert rows(tables.document_report(lines)) == [("lines", 4), ("not JSON", 2)]
    assert rows(tables.document_report(lines.limit(0))) == [("lines", 0), ("not JSON", 0)]


def test_onboarding_documents(table):
    lines = table(
        [('{"userID": 3, "step": "signup", "completed": true, "duration_seconds": 4}',), ("{}",)],
        "value string",
    )
    got = rows(tables.onboarding_events(tables.documents(lines)))
    assert got == [(3, None, "signup", True, 4.0), (None, None, None, False, None)]


def test_document_fields(docs):
    got = tables.document_fields(docs, {"who": "customerID int", "kind": "event_type string"})
    assert rows(got)[2:4] == [(3, "view"), (9, None)]


def test_nan_is_read_as_null(spark, table, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(table([(1, math.nan), (2, 1.5), (3, None)], "i int, d double"), path)
    assert by_key(tables.read_parquet(spark, path), "i", "d") == {1: (None,), 2: (1.5,), 3: (None,)}


CSV_ROWS = [
    (1, 'a,b "quoted" \'single\'', 1.5, True, datetime(2024, 1, 2, 3, 4, 5, 678901)),
    (2, "two\nlines\r\nand\ttabs", None, None, None),
    (3, "", -0.1, False, datetime(1995, 1, 1)),
    (4, None, 1e-9, True, None),
    (5, "  blanks  ", 123456789.125, False, datetime(2024, 1, 1)),
    (6, "back\\slash", 0.0, None, None),
    (7, '"', 0.0, None, None),
]
CSV_SCHEMA = "i int, s string, d double, b boolean, t timestamp_ntz"


def test_csv_round_trip(spark, table, tmp_path):
    path = str(tmp_path / "c")
    df = table(CSV_ROWS, CSV_SCHEMA).repartition(3)
    tables.write_csv(df, path)
    assert sorted(rows(tables.read_csv(spark, path, CSV_SCHEMA))) == CSV_ROWS
    kept = tables.read_csv(spark, path, CSV_SCHEMA, rejected="bad")
    assert sorted(rows(kept)) == [(*r, None) for r in CSV_ROWS]


def test_csv_rows_that_do_not_fit(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text('i,s\n1,"a\nb"\nx,c\n3\n4,d,e\n')
    got = rows(tables.read_csv(spark, str(path), "i int, s string", rejected="bad"))
    assert got[0] == (1, "a\nb", None)
    assert [r[2] for r in got[1:]] == ["x,c", "3", "4,d,e"]
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        tables.read_csv(spark, str(path), "i int, s string").collect()


def test_csv_header_must_be_the_schemas(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text("s,i\na,1\n")
    with pytest.raises(Exception, match="header|schema"):
        tables.read_csv(spark, str(path), "i int, s string").collect()


@pytest.mark.parametrize("name", tables.SCHEMAS)
def test_sample_tables_fit_the_schemas(spark, name):
    have = dict(SampleTables(spark, SMALL)[name].dtypes)
    for field in tables.schema_of(name):
        kind = field.dataType.simpleString()
        assert have[field.name].split("(")[0] == kind.split("(")[0], field.name


def test_split_read_needs_bounds(spark):
    with pytest.raises(ValueError, match="bounds"):
        tables.read_query(spark, "jdbc:none", "SELECT 1", split_column="id")


def test_flow_writes_every_report(spark, tmp_path):
    sample = SampleTables(spark, SMALL)
    inputs = Inputs(
        customers=sample["customers"],
        subscriptions=sample["subscriptions"],
        plans=sample["plans"],
        tickets=sample["support_tickets"],
        events=events.normalize_events(
            sample["user_activity_logs"],
            CUSTOMER_ALIASES,
            MEMBER_ALIASES,
            "ts_native",
            "ts_text",
            feature_fallback=True,
        ),
        as_of="2001-08-01",
        customer_order=["company_name"],
        subscription_order=["start_date"],
        ticket_order=["row_ord"],
    )
    folder = str(tmp_path / "out")
    run(inputs, folder)
    master = tables.read_parquet(spark, f"{folder}/master")
    assert master.count() == sample["customers"].count()
    assert master.select("customer_id").distinct().count() == master.count()
    for name in [*MASTER_REPORTS, "cleaning_report", "column_profile"]:
        assert spark.read.parquet(f"{folder}/{name}").count() > 0, name
    exported = spark.read.option("header", True).csv(f"{folder}/dashboard_csv")
    assert exported.count() == master.count() and len(exported.columns) == 35
    sizes = customers.segment_sizes(master).agg(F.sum("n_customers")).first()[0]
    assert sizes == master.count()
    clean = cleaning.clean_tickets(sample["support_tickets"], ["row_ord"], drop=["row_ord"])
    assert "row_ord" not in clean.columns


def test_documents_are_parsed_once(table):
    lines = table([('{"a": 1, "feature": "x"}',), ("no",), ('{"a": 2}',)], "value string")
    docs = tables.documents(lines).withColumn("a", F.try_variant_get("doc", "$.a", "bigint"))
    found = docs.filter(tables.has_field("feature")).select("a")
    assert rows(found) == [(1,)]
    plan = found._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("parsejson") + plan.count("parse_json") == 1
