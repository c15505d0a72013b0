"""The incremental job: restarts, repeated batches, later files."""

import pytest

from reachmart.sources import outbox
from reachmart.sources.ledger import Ledger
from reachmart.sources.schemas import MANUAL_COLUMNS
from reachmart.streaming import sync_stream
from test_ledger import manual

SEGMENT = {"segment": "churn_rescue_nps"}


def run(spark, folder, ledger, **options):
    query = sync_stream.start(spark, f"{folder}/inbox", ledger, f"{folder}/checkpoint", **options)
    query.awaitTermination()


def ids(ledger):
    return sorted(row["customer_id"] for row in ledger.rows(except_run="before").collect())


def test_files_are_worked_off_once(spark, tmp_path):
    ledger = Ledger(spark, f"{tmp_path}/ledger")
    ledger.record(manual(spark, {"email": "old@x"}), "before")
    first = manual(spark, {"customer_id": "m1", "email": "a@x", "score": "75", "first_name": "two\nlines", **SEGMENT},
                   {"customer_id": "m2", "email": "old@x", **SEGMENT})
    outbox.append_manual(first.coalesce(1), f"{tmp_path}/inbox")
    run(spark, tmp_path, ledger)
    run(spark, tmp_path, ledger)
    sent = ledger.rows(except_run="before").collect()
    assert [(r["customer_id"], r["score"], r["first_name"]) for r in sent] == [("m1", 0.75, "two\nlines")]
    later = manual(spark, {"customer_id": "m1", "email": "new@x", **SEGMENT},
                   {"customer_id": "m3", "email": "c@x", **SEGMENT})
    outbox.append_manual(later.coalesce(1), f"{tmp_path}/inbox")
    run(spark, tmp_path, ledger)
    assert ids(ledger) == ["m1", "m3"]


def test_later_batches_see_earlier_ones(spark, tmp_path):
    ledger = Ledger(spark, f"{tmp_path}/ledger")
    for number in range(3):
        rows = manual(spark, {"customer_id": "same", "email": f"{number}@x", **SEGMENT},
                      {"customer_id": f"m{number}", "email": f"m{number}@x", **SEGMENT})
        outbox.append_manual(rows.coalesce(1), f"{tmp_path}/inbox")
    run(spark, tmp_path, ledger, files_per_batch=1)
    assert ids(ledger) == ["m0", "m1", "m2", "same"]


def test_repeated_batch_leaves_one_copy(spark, tmp_path):
    """What a restart does after the ledger was written but the batch not yet committed."""
    ledger = Ledger(spark, f"{tmp_path}/ledger")
    batch = manual(spark, {"customer_id": "m1", "email": "a@x", **SEGMENT})
    sync_stream.sync_batch(batch, ledger, "manual_sync-0", f"{tmp_path}/outbox")
    sync_stream.sync_batch(batch, ledger, "manual_sync-0", f"{tmp_path}/outbox")
    assert ids(ledger) == ["m1"]
    sync_stream.sync_batch(batch, ledger, "manual_sync-1", f"{tmp_path}/outbox")
    assert ids(ledger) == ["m1"]


def test_odd_files_do_not_stop_the_stream(spark, tmp_path):
    """Other columns or order are read by name, what cannot be read is listed, also after a restart."""
    (tmp_path / "inbox").mkdir()
    names = [name for name in MANUAL_COLUMNS if name not in ("email", "customer_id", "segment")]
    header = ",".join(["email", "customer_id", "segment", *names, "extra"])
    (tmp_path / "inbox" / "a.csv").write_text(header + "\na@x,m1,churn_rescue_nps" + "," * 12 + "\n")
    (tmp_path / "inbox" / "b.csv").write_text("customer_id,segment\nm2,churn_rescue_nps\n")
    (tmp_path / "inbox" / "c.csv").write_text("note\nhello\n")
    (tmp_path / "inbox" / "d.csv").write_text("")
    (tmp_path / "inbox" / "e.csv.gz").write_text("customer_id,email\nm3,c@x\n")
    ledger = Ledger(spark, f"{tmp_path}/ledger")
    run(spark, tmp_path, ledger, files_per_batch=2)
    assert ids(ledger) == ["m1", "m2"]
    (tmp_path / "inbox" / "f.csv").write_text("email,customer_id,segment\nf@x,m4,churn_rescue_nps\na@x,m5,churn_rescue_nps\n")
    run(spark, tmp_path, ledger)
    assert ids(ledger) == ["m1", "m2", "m4"]
    listed = sync_stream.rejected_table(spark, f"{tmp_path}/checkpoint").collect()
    assert sorted(row["path"].rsplit("/", 1)[1] for row in listed) == ["c.csv", "e.csv.gz"]
    assert all(row["reason"] for row in listed)


def test_a_batch_that_fails_is_repeated(spark, tmp_path):
    ledger, calls = Ledger(spark, f"{tmp_path}/ledger"), []

    def send(rows):
        calls.append(sorted(row["customer_id"] for row in rows.collect()))
        if len(calls) == 1:
            raise RuntimeError("lost")

    (tmp_path / "inbox").mkdir()
    (tmp_path / "inbox" / "a.csv").write_text("customer_id,email\nm1,a@x\n")
    (tmp_path / "inbox" / "b.csv").write_text("note\nhello\n")
    with pytest.raises(Exception, match="lost"):
        run(spark, tmp_path, ledger, send=send)
    assert ids(ledger) == []
    run(spark, tmp_path, ledger, send=send)
    assert calls == [["m1"], ["m1"]] and ids(ledger) == ["m1"]
    assert sync_stream.rejected_table(spark, f"{tmp_path}/checkpoint").count() == 1
