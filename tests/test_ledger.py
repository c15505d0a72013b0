"""What was sent: anti joins, marks, payload files, ledger, sync."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from reachmart.operators import lookups, sent_keys
from reachmart.plans import activation, daily, delivery, sync, warehouse
from reachmart.samples import answers
from reachmart.sources import outbox
from reachmart.sources.ledger import Ledger
from reachmart.sources.schemas import MANUAL_COLUMNS, MANUAL_SCHEMA
from reachmart.sources.tables import SeedTables

KEYS = "customer_id string, email string"


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


@pytest.mark.parametrize("unsent", [sent_keys.unsent])
def test_unsent_brute_force(spark, unsent):
    """A hot id with a third of the rows, repeated and missing keys on both sides."""
    draw = random.Random(4)

    def key(prefix):
        return draw.choice([None, f"{prefix}0", f"{prefix}0", f"{prefix}{draw.randrange(40)}"])

    entries = [(key("i"), key("e")) for _ in range(300)]
    sent = [(key("i"), key("e")) if draw.random() < 0.3 else (f"i{draw.randrange(20)}", None) for _ in range(60)]
    ids, emails = {s[0] for s in sent} - {None}, {s[1] for s in sent} - {None}
    left, right = spark.createDataFrame(entries, KEYS), spark.createDataFrame(sent, KEYS)
    by_id = unsent(left, right, "customer_id")
    assert rows_of(by_id) == sorted((e for e in entries if e[0] not in ids), key=repr)
    both = unsent(left, right, "customer_id", "email")
    expected = [e for e in entries if e[0] not in ids and e[1] not in emails]
    assert rows_of(both) == sorted(expected, key=repr)
    assert "NestedLoop" not in plan_of(both) and "Cartesian" not in plan_of(both)


def test_ids_match_as_text(spark):
    entries = spark.createDataFrame([(1, "a"), (2, "b")], "customer_id bigint, email string")
    sent = spark.createDataFrame([("1", None)], KEYS)
    assert rows_of(sent_keys.unsent(entries, sent, "customer_id")) == [(2, "b")]


@pytest.mark.parametrize("unsent", [sent_keys.unsent])
def test_ledger_without_a_key_column(spark, unsent):
    entries = spark.createDataFrame([("a", "1"), ("b", "2")], KEYS)
    ids = spark.createDataFrame([("a",)], "customer_id string")
    assert rows_of(unsent(entries, ids, "customer_id", "email")) == [("b", "2")]
    emails = spark.createDataFrame([("1",)], "email string")
    assert {r["salesforce_status"] for r in sent_keys.mark_sent(entries, emails).collect()} == {"Not sent"}
    assert rows_of(sent_keys.sent_keys(emails)) == [("email", "1")]


def test_run_ids_keep_their_name(spark, tmp_path):
    ledger = Ledger(spark, f"{tmp_path}/ledger")
    for run_id in ("2024", "a b/c:d=e", "manual_a@x"):
        ledger.record(spark.createDataFrame([("1", "a@x")], KEYS), run_id)
    assert {r["run_id"] for r in ledger.rows().collect()} == {"2024", "a b/c:d=e", "manual_a@x"}
    assert ledger.rows(except_run="2024").count() == 2


def test_marks_and_report(spark):
    entries = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "3"), (None, "4")], KEYS)
    sent = spark.createDataFrame([("a", None), ("a", None), ("z", None), (None, "4")], KEYS)
    marked = {tuple(row) for row in sent_keys.mark_sent(entries, sent).collect()}
    assert marked == {("a", "1", "Sent to Salesforce"), ("a", "2", "Sent to Salesforce"), ("b", "3", "Not sent"),
                      (None, "4", "Not sent")}
    assert tuple(sync.sync_report(entries, sent).collect()[0]) == (4, 2, 2)
    assert rows_of(sent_keys.sent_keys(sent)) == [("email", "4"), ("id", "a"), ("id", "z")]


def test_payload_files_with_different_headers(spark, tmp_path):
    """Other order, other columns, quotes, line ends in a value, empty and damaged files."""
    (tmp_path / "all_payload.csv").write_text('customer_id,email,score\n1,a@x,0.5\n2,"b,""q""@x",\n')
    (tmp_path / "late_payload.csv").write_text('email,note,customer_id\nc@x,"two\nlines",3\n')
    (tmp_path / "same again_payload.csv").write_text("customer_id,email,score\n4,d@x,1\n")
    (tmp_path / "empty_payload.csv").write_text("")
    (tmp_path / "header_payload.csv").write_text("customer_id,email,score\n")
    (tmp_path / "other.csv").write_text("customer_id\n9\n")
    frame = outbox.read_payloads(spark, f"{tmp_path}/*_payload.csv")
    got = rows_of(frame.select("customer_id", "email", "score", "note", "source"))
    assert got == [
        ("1", "a@x", "0.5", None, "all_payload.csv"),
        ("2", 'b,"q"@x', None, None, "all_payload.csv"),
        ("3", "c@x", None, "two\nlines", "late_payload.csv"),
        ("4", "d@x", "1", None, "same again_payload.csv"),
    ]
    assert outbox.read_payloads(spark, f"{tmp_path}/empty_payload.csv").count() == 0


def test_a_cut_file_gives_no_row(spark, tmp_path):
    """A file that cannot be decoded is left out whole and listed; the others are read."""
    whole = gzip.compress(("customer_id,email\n" + "".join(f"{i},x{i * 7919}@x\n" for i in range(30_000))).encode())
    (tmp_path / "cut_payload.csv.gz").write_bytes(whole[: len(whole) // 2])
    (tmp_path / "odd_payload.csv.gz").write_text("customer_id,email\n9,no@gzip\n")
    (tmp_path / "good_payload.csv.gz").write_bytes(gzip.compress(b"customer_id,email\n1,a@x\n"))
    (tmp_path / "plain_payload.csv").write_text("email,customer_id\nb@x,2\n")
    frame = outbox.read_payloads(spark, f"{tmp_path}/*_payload.csv*")
    assert rows_of(frame.select("customer_id", "email")) == [("1", "a@x"), ("2", "b@x")]
    listed = {row["path"].rsplit("/", 1)[1]: row["reason"] for row in outbox.undecodable(spark, f"{tmp_path}/*").collect()}
    assert set(listed) == {"cut_payload.csv.gz", "odd_payload.csv.gz"} and all(listed.values())
    (tmp_path / "alone").mkdir()
    (tmp_path / "alone" / "cut_payload.csv.gz").write_bytes(whole[:100])
    assert outbox.read_payloads(spark, f"{tmp_path}/alone/*").count() == 0


def test_values_come_back_as_they_were(spark, tmp_path):
    values = ["  Ann ", " a,b ", "t\t", "", None, "two\nlines", 'say "x"', " ", "\t", "é"]
    frame = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "customer_id string, email string")
    path = outbox.write_payload(frame, str(tmp_path), "all")
    assert rows_of(outbox.read_payload(spark, path, frame.schema)) == rows_of(frame)
    assert rows_of(outbox.read_payloads(spark, path).drop("source")) == rows_of(frame)
    outbox.append_manual(manual(spark, {"customer_id": " 1", "first_name": " Bo "}), f"{tmp_path}/m")
    row = outbox.read_manual(spark, f"{tmp_path}/m").collect()[0]
    assert (row["customer_id"], row["first_name"]) == (" 1", " Bo ")


def test_backup_is_a_true_copy(spark, tmp_path):
    (tmp_path / "m.csv").write_bytes(b"customer_id,email\r\n 1 ,\"a\"\r\n")
    assert outbox.back_up_once(spark, f"{tmp_path}/m.csv", f"{tmp_path}/m.bak")
    assert (tmp_path / "m.bak").read_bytes() == (tmp_path / "m.csv").read_bytes()
    (tmp_path / "m.csv").write_text("other")
    assert not outbox.back_up_once(spark, f"{tmp_path}/m.csv", f"{tmp_path}/m.bak")
    assert (tmp_path / "m.bak").read_bytes().startswith(b"customer_id")


def test_refused_records_stay_pending(spark, tmp_path):
    """Refused leads, refused tasks and records that get no lead are sent again, the rest not."""
    rows = manual(
        spark,
        *[{"customer_id": f"m{i}", "email": f"{i}@x", "segment": "churn_rescue_nps", "first_name": f"N{i}"} for i in range(6)],
        {"customer_id": "no lead", "email": "n@x", "segment": "unknown"},
    )

    def client(refused):
        class Client:
            def create(self, kind, fields):
                if (kind, fields.get("Email") or fields.get("WhoId")) in refused:
                    raise ValueError("refused")
                return f"{kind}:{fields.get('Email')}"

        return Client

    ledger = Ledger(spark, f"{tmp_path}/ledger")
    send = delivery.sender(client({("Lead", "1@x"), ("Task", "Lead:2@x")}), f"{tmp_path}/log")
    sync.sync(rows, ledger, f"{tmp_path}/outbox", "first", send)
    assert sorted(r["customer_id"] for r in ledger.rows().collect()) == ["m0", "m3", "m4", "m5"]
    log = spark.read.option("recursiveFileLookup", True).parquet(f"{tmp_path}/log")
    assert {(r["customer_id"], r["error"]) for r in log.filter("error is not null").collect()} == {
        ("m1", "Lead: refused"), ("m2", "Task: refused"),
    }
    left = sync.pending(rows, ledger.rows())
    assert sorted(r["customer_id"] for r in left.collect()) == ["m1", "m2", "no lead"]
    sync.sync(rows, ledger, f"{tmp_path}/outbox", "second", delivery.sender(client(set()), f"{tmp_path}/log"))
    assert sorted(r["customer_id"] for r in ledger.rows(except_run="first").collect()) == ["m1", "m2"]


def test_actions_of_the_sync_jobs(spark, tmp_path):
    """By id and e-mail an entry gets the action of its segment; by id it keeps its own."""
    rows = manual(spark, {"customer_id": "m1", "email": "a@x", "segment": "churn_rescue_nps",
                          "nba_action": '{"template": "promotional"}'})
    for job, template in ((sync.sync, "nps_followup_then_offer"), (sync.sync_by_id, "promotional")):
        seen = []
        job(rows, Ledger(spark, f"{tmp_path}/{template}"), f"{tmp_path}/o{template}", "run", seen.append)
        assert f'"template": "{template}"' in seen[0].collect()[0]["nba_action"]
    outbox.append_manual(rows, f"{tmp_path}/entries")
    ledger = Ledger(spark, f"{tmp_path}/file")
    path = sync.send_file(spark, f"{tmp_path}/entries", ledger, f"{tmp_path}/out", "A@x")
    assert path.endswith("/manual_A@x_payload.csv") and ledger.rows().count() == 0
    assert sync.send_file(spark, f"{tmp_path}/entries", ledger, f"{tmp_path}/out", "nobody") is None
    sync.send_file(spark, f"{tmp_path}/entries", ledger, f"{tmp_path}/out", dry_run=False)
    assert [r["run_id"] for r in ledger.rows().collect()] == ["manual"]


def test_daily_run_with_a_scorer(spark, seed_folder, tmp_path):
    store, ledger = warehouse.Folders(spark, f"{tmp_path}/marts"), Ledger(spark, f"{tmp_path}/ledger")
    result = daily.run(
        spark, SeedTables(spark, seed_folder), "2024-08-01", store, f"{tmp_path}/outbox", ledger,
        risk_scorer=answers.risk_answers(),
    )
    row = result.collect()[0]
    assert row["activated"] == 4 and 0 < row["avg_risk"] <= 1


def test_odd_headers(spark, tmp_path):
    (tmp_path / "odd_payload.csv").write_text("\ufeffcustomer_id, email,email,\n1,a@x,b@x,z\n", encoding="utf-8")
    row = outbox.read_payloads(spark, f"{tmp_path}/odd_payload.csv").collect()[0].asDict()
    assert row == {"customer_id": "1", "email": "a@x", "email.1": "b@x", "Unnamed: 3": "z", "source": "odd_payload.csv"}


def test_only_files_with_line_ends_in_values_are_read_whole(spark, tmp_path):
    """A large file without them is split, and every row is read once."""
    row = '{0},"c{0}, ""x""@x",0.5\n'
    (tmp_path / "big_payload.csv").write_text("customer_id,email,score\n" + "".join(map(row.format, range(20_000))))
    (tmp_path / "odd_payload.csv").write_text('customer_id,email,score\n-1,"a\nb",1\n')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        frame = outbox.read_payloads(spark, f"{tmp_path}/*_payload.csv")
        tasks = frame.select(F.spark_partition_id().alias("task"), "customer_id").distinct()
        assert tasks.select("task").distinct().count() > 8
        assert sorted(int(r["customer_id"]) for r in frame.collect()) == list(range(-1, 20_000))
        assert frame.filter("customer_id = '-1'").collect()[0]["email"] == "a\nb"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


RECORD = (
    "customer_id bigint, email string, segment string, score double, first_name string, nps_score int, "
    "events_30d bigint, orders_cnt bigint, lifetime_revenue double, created_at string, last_event_ts string, "
    "country string"
)


@pytest.fixture()
def records(spark):
    rows = [
        (i, f"c{i}@x", "churn_rescue_nps", i / 4, f'N "{i}", x', None if i == 2 else i, 1, 2, 9.5, "N/A", "N/A", "US")
        for i in range(5)
    ]
    return spark.createDataFrame(rows, RECORD)


def test_payload_file_and_ledger(spark, records, tmp_path):
    ledger, sent = Ledger(spark, f"{tmp_path}/ledger"), []
    payload = activation.payload(records)
    path = activation.deliver(payload, str(tmp_path), "all", ledger, dry_run=True, send=sent.append)
    assert path.endswith("/all_payload.csv") and not sent and ledger.rows().count() == 0
    back = outbox.read_payload(spark, path, outbox.json_columns(payload).schema)
    assert rows_of(back) == rows_of(outbox.json_columns(payload))
    found = outbox.read_payloads(spark, f"{tmp_path}/*_payload.csv")
    assert found.count() == 5 and {r["source"] for r in found.collect()} == {"all_payload.csv"}
    activation.deliver(payload, str(tmp_path), "all", ledger, dry_run=False, send=sent.append)
    assert [frame.count() for frame in sent] == [5]
    assert activation.lead_rows(sent[0]).count() == activation.task_rows(sent[0]).count() == 5
    assert [r["customer_id"] for r in ledger.rows().orderBy("customer_id").collect()] == list("01234")


def test_dry_runs_may_count_as_sent(spark, records, tmp_path):
    ledger, sent = Ledger(spark, f"{tmp_path}/ledger"), []
    payload = activation.payload(records)
    activation.deliver(payload, str(tmp_path), "all", ledger, send=sent.append, count_dry_runs=True)
    assert not sent and ledger.rows().count() == 5


def test_empty_payload(spark, records, tmp_path):
    """A run without records leaves an empty payload behind and sends nothing."""
    ledger, sent = Ledger(spark, f"{tmp_path}/ledger"), []
    for rows in (records, records.limit(0)):
        activation.deliver(activation.payload(rows), str(tmp_path), "all", ledger, dry_run=False, send=sent.append)
    assert [frame.count() for frame in sent[1:]] == [0] and ledger.rows().count() == 0
    assert daily.validate(spark, str(tmp_path)).collect()[0]["activated"] == 0


def test_failed_delivery_leaves_no_ledger_rows(spark, records, tmp_path):
    ledger = Ledger(spark, f"{tmp_path}/ledger")

    def broken(rows):
        raise ConnectionError("destination is down")

    with pytest.raises(ConnectionError):
        activation.deliver(activation.payload(records), str(tmp_path), "r", ledger, dry_run=False, send=broken)
    assert ledger.rows().count() == 0


def manual(spark, *rows):
    blank = dict.fromkeys(MANUAL_COLUMNS)
    full = [{**blank, **row} for row in rows]
    return spark.createDataFrame([tuple(row[name] for name in MANUAL_COLUMNS) for row in full], MANUAL_SCHEMA)


def test_sync_sends_each_entry_once(spark, tmp_path):
    ledger, seen = Ledger(spark, f"{tmp_path}/ledger"), []

    def send(rows):
        seen.append(sorted(row["customer_id"] for row in rows.collect()))

    segment = {"segment": "churn_rescue_nps"}
    first = manual(spark, {"customer_id": "m1", "email": "a@x", "first_name": "A", **segment},
                   {"customer_id": "m2", "email": "b@x", "first_name": "churn_rescue_nps", "segment": "B"})
    sync.sync(first, ledger, str(tmp_path), "run1", send)
    sync.sync(first, ledger, str(tmp_path), "run1", send)  # a repeated run
    assert ledger.rows().count() == 2
    more = first.unionByName(
        manual(spark, {"customer_id": "m3", "email": "c@x", "first_name": "C", **segment},
               {"customer_id": "m4", "email": "a@x", "first_name": "D", **segment})
    )
    sync.sync(more, ledger, str(tmp_path), "run2", send)
    assert seen == [["m1", "m2"], ["m1", "m2"], ["m3"]]
    assert tuple(sync.sync_report(more, ledger.rows()).collect()[0]) == (4, 3, 1)


def test_send_one_again(spark, tmp_path):
    ledger, seen = Ledger(spark, f"{tmp_path}/ledger"), []
    rows = manual(spark, {"customer_id": "m1", "email": "a@x", "segment": "churn_rescue_nps"},
                  {"customer_id": "m2", "email": "b@x", "segment": "churn_rescue_nps"})
    assert sync.send_one(rows, "B@x", ledger, str(tmp_path), "one", seen.append)
    assert sync.send_one(rows, "m2", ledger, str(tmp_path), "again", seen.append)
    assert not sync.send_one(rows, "m9", ledger, str(tmp_path), "none", seen.append)
    assert [r["customer_id"] for r in ledger.rows().collect()] == ["m2", "m2"] and len(seen) == 2


def test_delivery_log(spark, records, tmp_path):
    """Leads first, each task with the id of its lead; failures do not stop the others."""
    odd = records.withColumn("email", F.when(F.col("customer_id") == 3, "none").otherwise(F.col("email")))
    odd = odd.withColumn("segment", F.when(F.col("customer_id") < 2, "high_value").otherwise(F.col("segment")))
    odd = odd.unionByName(odd.filter("customer_id = 4"))  # two records of one customer
    send = delivery.sender(answers.destination(), f"{tmp_path}/log")
    send(activation.payload(odd))
    log = spark.read.parquet(f"{tmp_path}/log")
    assert {r["customer_id"] for r in log.filter("error is null").collect()} == {"0", "1"}
    assert rows_of(log.select("customer_id", "lead_id", "task_created")) == [
        ("0", "Lead:c0", True), ("1", "Lead:c1", True), ("2", "Lead:c2", False), ("3", "SF-3", False),
        ("4", "Lead:c4", False), ("4", "Lead:c4", False),
    ]


def test_submission_fills_required_fields(spark):
    entries = manual(spark, {"customer_id": "m1", "segment": "high_value", "nps_score": "3", "events_30d": "0",
                             "lifetime_revenue": "500", "nba_action": "{'template': 'x'}"})
    row = activation.submission(entries, "2024-03-05 10:11:12").collect()[0]
    assert (row["email"], row["first_name"], row["company"]) == ("customer@example.com", "Customer", "Customer Company")
    assert row["llm_risk_score"] == pytest.approx(0.8285714285714286)
    assert row["_sent_to_salesforce_at"] == "2024-03-05 10:11:12" and row["nba_action"] is None


def test_daily_run(spark, seed_folder, tmp_path):
    store, ledger = warehouse.Folders(spark, f"{tmp_path}/marts"), Ledger(spark, f"{tmp_path}/ledger")
    tables, seen = SeedTables(spark, seed_folder), []
    assert tuple(daily.validate(spark, f"{tmp_path}/outbox").collect()[0]) == (0, None)
    result = daily.run(
        spark, tables, "2024-08-01", store, f"{tmp_path}/outbox", ledger, dry_run=False, send=seen.append
    )
    assert tuple(result.collect()[0]) == (4, None)
    assert [frame.count() for frame in seen] == [4, 2]
    assert ledger.rows().count() == 6
    daily.run(spark, tables, "2024-08-02", store, f"{tmp_path}/outbox", ledger, dry_run=False)
    assert sorted({r["run_id"] for r in ledger.rows().collect()}) == [
        "all-20240801", "all-20240802", "high_value_lapse_risk-20240801", "high_value_lapse_risk-20240802",
    ]


def test_failed_data_test_stops_the_daily_run(spark, seed_folder, tmp_path):
    class Broken(SeedTables):
        def orders(self, since=None):
            rows = super().orders(since)
            return rows.unionByName(rows.withColumn("status", F.lit("void")))

    store, ledger = warehouse.Folders(spark, f"{tmp_path}/marts"), Ledger(spark, f"{tmp_path}/ledger")
    with pytest.raises(daily.DataTestsFailed, match="unique fct_orders.order_id: 7.*status: 1"):
        daily.run(spark, Broken(spark, seed_folder), "2024-08-01", store, f"{tmp_path}/outbox", ledger)
    assert daily.validate(spark, f"{tmp_path}/outbox").collect()[0]["activated"] == 0


def test_find(spark):
    entries = spark.createDataFrame([("1", "A@x"), ("1", "b@x"), ("2", "1"), ("3", "C@x"), (None, "d@x")], KEYS)
    assert rows_of(lookups.find_entries(entries, "1")) == [("1", "A@x"), ("1", "b@x")]  # the id comes first
    assert rows_of(lookups.find_entries(entries, "a@X")) == [("1", "A@x")]
    assert rows_of(lookups.find_entries(entries, "none")) == []
    assert "NestedLoop" not in plan_of(lookups.find_entries(entries, "1"))
    keys = spark.createDataFrame([("1",), ("a@X",), ("D@x",), ("none",), (None,), ("1",)], "lookup string")
    found = lookups.find_all(entries, keys).select("lookup", "found_by", "customer_id", "email")
    assert rows_of(found) == [
        ("1", "id", "1", "A@x"), ("1", "id", "1", "b@x"), ("D@x", "email", None, "d@x"), ("a@X", "email", "1", "A@x"),
    ]


def test_search_and_details(spark):
    rows = [("1", "a.b@x", "Ann", "s2"), ("1", "a.b@x", "Ann", "s1"), ("2", None, "BOB", "s1"), ("3", "axb@x", None, "s1")]
    frame = spark.createDataFrame(rows, "customer_id string, email string, first_name string, source string")
    assert {r["customer_id"] for r in lookups.search(frame, "A.B").collect()} == {"1"}
    assert {r["customer_id"] for r in lookups.search(frame, "a.b", regex=True).collect()} == {"1", "3"}
    assert {r["customer_id"] for r in lookups.search(frame, "bob").collect()} == {"2"}
    assert lookups.shown(frame).columns == ["customer_id", "email", "first_name", "source"]
    assert lookups.first_of(frame, "1", ["source"]).collect()[0]["source"] == "s1"
    firsts = lookups.first_per_id(frame, ["source"]).collect()
    assert sorted((r["customer_id"], r["source"]) for r in firsts) == [("1", "s1"), ("2", "s1"), ("3", "s1")]


def test_activate_one_manual_entry(spark):
    rows = manual(spark, {"customer_id": "m1", "email": "A@x", "segment": "high_value_lapse_risk", "nba_action": "{}"},
                  {"customer_id": "m2", "email": "b@x", "segment": "other"})
    row = activation.manual_payload(rows, "a@x", discount_cap=3).collect()[0]
    assert (row["customer_id"], row["nba_action"]["discount_pct"]) == ("m1", 3.0)
    assert activation.manual_payload(rows).filter(F.col("nba_action.template") == "holdout").count() == 1


def test_a_stray_quote_splits_no_record(spark, tmp_path):
    """Only a quoted value that goes on in the next line makes a file one piece."""
    (tmp_path / "a_payload.csv").write_text('customer_id,first_name,email\n1,O"Neil,a@x\n2,"say ""hi""",b@x\n3,"",c@x\n')
    (tmp_path / "b_payload.csv").write_text('customer_id,first_name,email\n4,"two, ""\n""lines",d@x\n5,Bo,e@x\n')
    found = {row["path"].rsplit("/", 1)[1]: row["whole"] for row in outbox.inspected(spark, f"{tmp_path}/*").collect()}
    assert found == {"a_payload.csv": False, "b_payload.csv": True}
    rows = outbox.read_payloads(spark, f"{tmp_path}/*").select("customer_id", "first_name", "email")
    assert rows_of(rows) == [
        ("1", 'O"Neil', "a@x"), ("2", 'say "hi"', "b@x"), ("3", "", "c@x"), ("4", 'two, "\n"lines', "d@x"), ("5", "Bo", "e@x"),
    ]
