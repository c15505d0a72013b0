"""Payload files of other tools in the ledger: once each, odd ones listed."""

import gzip
import os

import pytest

from reachmart.plans import sync
from reachmart.sources import outbox
from reachmart.sources.ledger import Ledger
from reachmart.sources.payload_files import PayloadFiles
from test_ledger import manual

SEGMENT = {"segment": "churn_rescue_nps"}


@pytest.fixture
def box(tmp_path):
    (tmp_path / "outbox").mkdir()
    return tmp_path / "outbox"


def put(box, name, text):
    (box / name).write_bytes(text if isinstance(text, bytes) else text.encode())


def sent(ledger):
    return sorted(((r["customer_id"], r["email"], r["source"]) for r in ledger.rows().collect()), key=str)


def states(files):
    return {row["path"].rsplit("/", 1)[1]: row["state"] for row in files.manifest().orderBy("batch").collect()}


@pytest.mark.parametrize("files_per_batch", [1, 100])
def test_every_file_enters_once(spark, tmp_path, box, files_per_batch):
    put(box, "a b+c%41_payload.csv", 'customer_id,email,score,note\n1,a@x,0.5,"two\nlines"\n')
    put(box, "late_payload.csv.gz", gzip.compress(b"email,customer_id\nb@x,2\n"))
    put(box, "mails[1]{a}_payload.csv", "email\nc@x\n")
    put(box, "cut_payload.csv.gz", gzip.compress(b"email,customer_id\n" + os.urandom(5000))[:900])
    put(box, "empty_payload.csv", "\n")
    put(box, "nothing_payload.csv", "")  # Spark lists no files without a byte
    put(box, "notes_payload.csv", "note\nhello\n")
    put(box, "other.csv", "customer_id,email\n9,z@x\n")
    ledger = Ledger(spark, f"{tmp_path}/ledger")
    files = PayloadFiles(ledger, str(box), files_per_batch)
    assert files.enter() == 6
    wanted = [("1", "a@x", "a b+c%41_payload.csv"), ("2", "b@x", "late_payload.csv.gz"), (None, "c@x", "mails[1]{a}_payload.csv")]
    assert sent(ledger) == sorted(wanted, key=str)
    assert states(files) == {
        "a b+c%41_payload.csv": "entered", "late_payload.csv.gz": "entered", "mails[1]{a}_payload.csv": "entered",
        "cut_payload.csv.gz": "unreadable", "empty_payload.csv": "empty", "notes_payload.csv": "no key",
    }
    listed = {r["path"].rsplit("/", 1)[1]: r["reason"] for r in files.rejected().collect()}
    assert set(listed) == {"cut_payload.csv.gz", "notes_payload.csv"} and all(listed.values())
    assert files.enter() == 0
    assert ledger.rows().filter("score = 0.5").count() == 1


def test_changed_and_copied_files(spark, tmp_path, box):
    """A file written anew adds its rows; a copy under another name adds none."""
    put(box, "all_payload.csv", "customer_id,email\n1,a@x\n")
    ledger = Ledger(spark, f"{tmp_path}/ledger")
    files = PayloadFiles(ledger, str(box))
    files.enter()
    put(box, "all_payload.csv", "customer_id,email\n2,b@x\n3,c@x\n")
    put(box, "copy_payload.csv", "customer_id,email\n1,a@x\n")
    assert files.enter() == 2
    assert [row[0] for row in sent(ledger)] == ["1", "2", "3"]
    assert states(files)["copy_payload.csv"] == "known"


def test_dies_before_the_manifest(spark, tmp_path, box, monkeypatch):
    put(box, "a_payload.csv", "customer_id,email\n1,a@x\n")
    ledger = Ledger(spark, f"{tmp_path}/ledger")
    files = PayloadFiles(ledger, str(box))
    record = Ledger.record
    with monkeypatch.context() as patch:

        def die(*args):
            record(*args)
            raise RuntimeError("lost")

        patch.setattr(Ledger, "record", die)
        with pytest.raises(RuntimeError):
            files.enter()
    assert len(sent(ledger)) == 1 and files.manifest().isEmpty()
    put(box, "b_payload.csv", "customer_id,email\n2,b@x\n")
    assert files.enter() == 2
    assert [row[0] for row in sent(ledger)] == ["1", "2"]


def test_sync_knows_what_old_files_sent(spark, tmp_path, box):
    put(box, "manual_sync_1_payload.csv", "email,customer_id\nold@x,m9\nx@x,m1\n")
    entries = manual(spark, {"customer_id": "m1", "email": "a@x", **SEGMENT}, {"customer_id": "m2", "email": "old@x", **SEGMENT},
                     {"customer_id": "m3", "email": "c@x", **SEGMENT})
    ledger, seen = Ledger(spark, f"{tmp_path}/ledger"), []
    sync.sync(entries, ledger, str(box), "first", lambda rows: seen.extend(r["customer_id"] for r in rows.collect()))
    assert seen == ["m3"]
    # Its own payload is no news, and that of a dry run counts for nothing.
    sync.send_one(entries, "m2", ledger, str(box), "dry", dry_run=True)
    assert PayloadFiles(ledger, str(box)).enter() == 0
    assert os.path.isdir(box / "first_payload.csv")


def test_folders_and_no_folder(spark, tmp_path, box):
    ledger = Ledger(spark, f"{tmp_path}/ledger")
    assert PayloadFiles(ledger, f"{tmp_path}/none").enter() == 0
    assert PayloadFiles(ledger, str(box)).enter() == 0
    outbox.write_csv(spark.range(4).selectExpr("cast(id as string) customer_id").repartition(2), f"{box}/x_payload.csv")
    assert PayloadFiles(ledger, str(box)).enter() == 2
    assert [row[0] for row in sent(ledger)] == ["0", "1", "2", "3"]
    assert {row[2] for row in sent(ledger)} == {"x_payload.csv"}
