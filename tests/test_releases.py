"""Releases with versions, and the document job, on small tables."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from catalogflow.operators import gates
from catalogflow.operators.aggregates import table_fingerprint
from catalogflow.plans import assets, release
from catalogflow.schemas import MASTER_COLUMNS
from catalogflow.sinks.files import Versions, write_documents


def rows(spark, *mpns, description="d"):
    return gates.project_master(spark.createDataFrame([(m, "Maker", description) for m in mpns], "mpn string, manufacturer string, description string"))


def mpns(versions):
    return sorted(r["mpn"] for r in versions.current().select("mpn").collect())


def test_release_works_out_its_rows_once(spark, tmp_path):
    """Rows that are different each time they are worked out are checked, written and compared as the same."""
    import uuid

    v = Versions(spark, str(tmp_path / "m"))
    once = F.udf(lambda: uuid.uuid4().hex).asNondeterministic()
    assert release.release_version(v, "r1", rows(spark, "A", "B").withColumn("description", once())).ok and v.current().count() == 2


def test_release_and_rollback(spark, tmp_path):
    v = Versions(spark, str(tmp_path / "m"))
    assert v.current() is None and v.number() == 0
    assert release.release_version(v, "r1", rows(spark, "A", "B")).ok
    before = table_fingerprint(v.current(), MASTER_COLUMNS).first()
    assert release.release_version(v, "r2", rows(spark, "C"), planned_fingerprint=before).ok
    assert mpns(v) == ["A", "B", "C"]
    # a second run of the same release adds nothing
    assert release.release_version(v, "r2", rows(spark, "C")).problems == ["already released"]
    assert mpns(v) == ["A", "B", "C"] and v.number() == 2
    # the plan was made from another table
    assert release.release_version(v, "r3", rows(spark, "D"), planned_fingerprint=before).problems == ["MASTER changed since the plan"]
    v.rollback("r2")
    assert mpns(v) == ["A", "B"] and table_fingerprint(v.current(), MASTER_COLUMNS).first() == before
    assert v.rollback("r2") == 3  # nothing to take back any more
    # and it can be released again
    assert release.release_version(v, "r2", rows(spark, "C")).ok and mpns(v) == ["A", "B", "C"]
    assert [(r["action"], r["release"], r["rows"]) for r in v.log().collect()] == [("apply", "r1", 2), ("apply", "r2", 3), ("rollback", "r2", 2), ("apply", "r2", 3)]
    with pytest.raises(ValueError):
        v.rollback("r1")


def test_bad_rows_change_nothing(spark, tmp_path):
    v = Versions(spark, str(tmp_path / "m"))
    release.release_version(v, "r1", rows(spark, "A"))
    assert release.release_version(v, "r2", rows(spark, "A")).problems == ["duplicate identity: 1"]
    assert release.release_version(v, "r3", rows(spark, "B", description=" ")).problems == ["new row lacks a required column: 1"]
    changed = rows(spark, "A", description="other")
    assert release.release_version(v, "r4", rows(spark, "B"), updated=changed).problems == ["pre-existing rows modified: 1"]
    assert mpns(v) == ["A"] and v.number() == 1
    allowed = spark.createDataFrame([("a",)], "mpn string")
    assert release.release_version(v, "r5", rows(spark, "B"), updated=changed, allow_updates=allowed).ok


def test_stop_between_write_and_commit(spark, tmp_path):
    v = Versions(spark, str(tmp_path / "m"))
    release.release_version(v, "r1", rows(spark, "A"))
    v.stage(rows(spark, "A", "B"))  # the job ends here
    again = Versions(spark, str(tmp_path / "m"))
    assert mpns(again) == ["A"] and not again.released("r2")
    assert release.release_version(again, "r2", rows(spark, "B")).ok and mpns(again) == ["A", "B"]


def test_two_releases_at_once(spark, tmp_path):
    one, two = (Versions(spark, str(tmp_path / "m")) for _ in range(2))
    release.release_version(one, "r1", rows(spark, "A"))
    number, other = two.number(), two.stage(rows(spark, "A", "X"))
    assert release.release_version(one, "r2", rows(spark, "B")).ok
    with pytest.raises(Exception, match="[Ee]xist"):
        two.commit("apply", "late", other, number)
    assert mpns(two) == ["A", "B"] and not two.released("late")


PDF = b"%PDF-1.7 " + b"x" * 1100 + b" %%EOF"


def test_documents_to_ledger(spark, tmp_path):
    folder = str(tmp_path / "docs")
    files = {"C1.pdf": PDF, "m2.pdf": PDF, "C3.pdf": b"<html>" + b" " * 1100, "C4.pdf": b"", "m4.pdf": PDF + b"4", "x__C5.pdf": PDF + b"5", "y__C5.pdf": PDF + b"6"}
    df = spark.createDataFrame([(k, bytearray(d)) for k, d in files.items()], "name string, content binary").repartition(3)
    for _ in range(2):  # a task that runs again replaces its files
        assert {r["name"]: r["size"] for r in write_documents(df, folder).collect()} == {k: len(d) for k, d in files.items()}
    assert sorted(os.listdir(folder)) == sorted(files)
    parts = spark.createDataFrame(
        [(1, "C1", "m1", "m1", "", "u1", 1), (2, "C2", "M2", "m2", "", "u2", 2), (3, "C3", "m3", "m3", "https://k/3", "u3", 3), (4, "C4", "m4", "m4", "", "u4", 4),
         (5, "C9", "m9", "m9", "", "u", 5), (6, "C8", "m8", "m8", "", " ", 6), (7, "C1", "m7", "m7", "", "u7", 7), (8, None, None, None, None, None, 8)],
        "part_id long, code string, mpn string, clean_mpn string, url string, source_url string, ord long")
    ledger = spark.createDataFrame([("m7", "old", "UPLOADED"), ("m1", "old", "FAILED")], "mpn string, source_url string, status string")
    run = assets.asset_pipeline(spark, folder, parts, "https://b", ledger)
    sha = hashlib.sha256(PDF).hexdigest()
    got = {r["part_id"]: (r["status"], r["error_code"], r["sha256"]) for r in run.ledger.collect()}
    assert got[1] == ("VERIFIED", None, sha) and got[2] == ("DUPLICATE", None, sha)
    assert got[3][:2] == ("FAILED", "NO_PDF_MARK") and got[4][:2] == ("VERIFIED", None)  # a sound document counts before a broken one
    assert got[5] == ("DISCOVERED", None, None) and got[6] == ("SKIPPED", "NO_URL", None) and got[7] == ("UPLOADED", None, None) and got[8] == ("SKIPPED", "NO_URL", None)
    assert {r["path"].split("/")[-1]: r["problem"] for r in run.problems.collect()} == {"C3.pdf": "NO_PDF_MARK", "x__C5.pdf": "KEY_COLLISION", "y__C5.pdf": "KEY_COLLISION"}
    t = run.totals.first()
    assert (t["new_objects"], t["already_exists"], t["failed"], t["total"], t["valid"]) == (2, 0, 3, 5, True)  # a file scan passes over the empty file
    urls = {r["part_id"]: (r["datasheet_url"], r["map_result"]) for r in run.master.collect()}
    assert urls[3] == ("https://k/3", "set") and urls[5] == ("", "empty") and urls[1][1] == "set"
    again = assets.asset_pipeline(spark, folder, parts, "https://b", ledger, run.uploads.where("outcome = 'NEW'").select("storage_key"))
    assert again.totals.first()["already_exists"] == 2


@pytest.mark.parametrize("name", ["../x.pdf", "a/b.pdf", "", None])
def test_names_stay_in_the_folder(spark, tmp_path, name):
    df = spark.createDataFrame([(name, bytearray(b"x"))], "name string, content binary")
    with pytest.raises(Exception, match="not a file name"):
        write_documents(df, str(tmp_path / "docs")).collect()


def test_no_documents(spark, tmp_path):
    (tmp_path / "none").mkdir()
    parts = spark.createDataFrame([], "part_id long, code string, mpn string, clean_mpn string, url string, source_url string, ord long")
    run = assets.asset_pipeline(spark, str(tmp_path / "none"), parts, "https://b")
    assert run.ledger.count() == 0 and run.totals.first()["total"] == 0 and run.totals.select(F.col("valid")).first()[0]


def test_release_joins_nothing(spark, tmp_path, monkeypatch):
    """An append is checked and compared by counts and sums; neither the table nor the new rows are joined with anything."""
    v = Versions(spark, str(tmp_path / "m"))
    assert release.release_version(v, "r1", rows(spark, "A", "B")).ok

    def joined(*_, **__):
        raise AssertionError("a join")

    with monkeypatch.context() as m:
        m.setattr(type(v.current()), "join", joined)
        assert release.release_version(v, "r2", rows(spark, "C")).ok
        assert release.release_version(v, "r3", rows(spark, "C", "D", "D")).problems == ["duplicate identity: 2"]
    assert mpns(v) == ["A", "B", "C"] and len(os.listdir(tmp_path / "m" / "data")) == 2  # new rows that were kept aside are gone


@pytest.mark.parametrize("change", [lambda d: d.where("mpn <> 'B'"), lambda d: d.withColumn("description", F.lit("e")), lambda d: d.unionByName(d.limit(1))])
def test_written_version_differs(spark, tmp_path, monkeypatch, change):
    v = Versions(spark, str(tmp_path / "m"))
    assert release.release_version(v, "r1", rows(spark, "A", "B")).ok
    stage = v.stage
    monkeypatch.setattr(v, "stage", lambda d: stage(change(d) if d.count() == 3 else d))
    assert release.release_version(v, "r2", rows(spark, "C")).problems == ["written table differs from the plan"] and mpns(v) == ["A", "B"]


def test_log_is_read_once_a_release(spark, tmp_path, monkeypatch):
    v = Versions(spark, str(tmp_path / "m"))
    read, reads = type(spark.read).json, []
    monkeypatch.setattr(type(spark.read), "json", lambda self, *a, **k: (reads.append(a), read(self, *a, **k))[1])
    for i, name in enumerate("ABC"):
        assert release.release_version(v, f"r{i}", rows(spark, name)).ok
    assert len(reads) == 2  # there is no log before the first
    assert release.release_version(v, "r2", rows(spark, "C")).rows == 3 and len(reads) == 3
    assert v.rollback("r2") == 4 and len(reads) == 5 and v.rollback("r2") == 4 and mpns(v) == ["A", "B"]
    assert [(r["commit"], r["action"], r["release"], r["rows"]) for r in v.log().collect()] == [
        (1, "apply", "r0", 1), (2, "apply", "r1", 2), (3, "apply", "r2", 3), (4, "rollback", "r2", 2)]
