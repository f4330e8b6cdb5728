"""The file-to-file jobs on small trees in a fresh temp folder."""

import os

from docforge.plans import jobs


def _write(root, rel, data):
    p = os.path.join(root, rel)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "wb") as f:
        f.write(data)


def test_dedup_job_writes_members_plan_and_report(spark, tmpdir_fresh):
    src = os.path.join(tmpdir_fresh, "src")
    for rel, b in {"a/x.txt": b"same", "b/x.txt": b"same", "c/y.txt": b"same", "d/z.txt": b"diff",
                   "e/empty1": b"", "f/empty2": b""}.items():
        _write(src, rel, b)
    out = os.path.join(tmpdir_fresh, "out")
    stats = jobs.dedup_job(spark, src, out, report_at="t")
    assert stats["total_files"] == 6
    # one filename group (x.txt) and one content group (the two empty files);
    # y.txt is never compared with the filename group's keeper (kept quirk)
    assert stats["duplicate_files"] == 2 and stats["groups"] == 2
    report = [r.value for r in spark.read.text(os.path.join(out, "report")).collect()]
    assert report[0] == "Duplicate File Report - t"
    assert any(line.startswith("Group 1: ") for line in report)


def test_clean_publish_consolidate_intake_jobs(spark, tmpdir_fresh):
    md = os.path.join(tmpdir_fresh, "md")
    _write(md, "a.md", b"# Title\n\n**bold** text\n| h |\n|---|\n|  c  | d |\n")
    _write(md, "b.md", b"caf\xe9\r\n- item\n")
    _write(md, "c.md", b"")
    txt = os.path.join(tmpdir_fresh, "txt")
    _write(txt, "c.txt", b"already")
    s = jobs.clean_job(spark, md, txt, os.path.join(tmpdir_fresh, "clean"))
    assert s["successful_files"] == 2
    got = {r.name: r.text for r in spark.read.parquet(os.path.join(tmpdir_fresh, "clean")).collect()}
    assert got == {"a.txt": "Title\n\nbold text\n| h |\nc | d", "b.txt": "café\n• item"}

    card = jobs.publish_job(spark, txt, os.path.join(tmpdir_fresh, "ds"), "t", created="2024-01-01")
    assert card["documents"] == 1 and card["total_bytes"] == 7

    src = os.path.join(tmpdir_fresh, "tree")
    for rel in ["p/a.txt", "q/a.txt", "r/a_1.txt", "s/b.txt"]:
        _write(src, rel, rel.encode())
    taken = spark.createDataFrame([("a.txt",)], "name string")
    st = jobs.consolidate_job(spark, src, taken, os.path.join(tmpdir_fresh, "cons"),
                              state=os.path.join(tmpdir_fresh, "state"))
    assert st["processed"] == 4 and st["skipped"] == 0
    rows = sorted((r.ord, r.target_name) for r in spark.read.parquet(os.path.join(tmpdir_fresh, "cons", "results")).collect())
    # scan order p/a.txt, q/a.txt, r/a_1.txt, s/b.txt with a.txt already in the target
    assert [t for _, t in rows] == ["a_1.txt", "a_2.txt", "a_1_1.txt", "b.txt"]
    # a second run over the same tree finds every file in the state
    st2 = jobs.consolidate_job(spark, src, taken, os.path.join(tmpdir_fresh, "cons2"),
                               state=os.path.join(tmpdir_fresh, "state"))
    assert st2["processed"] == 0 and st2["skipped"] == 4

    inbox = os.path.join(tmpdir_fresh, "inbox")
    for rel in ["x.pdf", "y.DOCX", "~$z.doc", "w.xlsx", "done.pdf"]:
        _write(inbox, rel, b"12345")
    outputs = os.path.join(tmpdir_fresh, "outputs")
    _write(outputs, "done.md", b"x")
    errors = os.path.join(tmpdir_fresh, "errors")
    _write(errors, "old.doc", b"x")
    assert jobs.intake_job(spark, inbox, outputs, errors, os.path.join(tmpdir_fresh, "plan")) == 3


def test_cli_runs_in_the_active_session(spark, tmpdir_fresh, capsys):
    import json
    from docforge.cli import main
    txt = os.path.join(tmpdir_fresh, "txt")
    _write(txt, "a.txt", b"hello")
    _write(txt, "b.txt", b"")
    assert main(["publish", txt, os.path.join(tmpdir_fresh, "ds"), "--title", "t"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["documents"] == 2 and out["total_bytes"] == 5


def test_end_of_batch_validate_and_repair_jobs(spark, tmpdir_fresh):
    from docforge.cli import main
    root = tmpdir_fresh
    spark.createDataFrame([(0, "a", "a.pdf", "pdf", "ok"), (1, "b", "b.PDF", "PDF", "failed"), (2, "c", "c.doc", "doc", "failed"),
                           (3, "~$d", "~$d.doc", "doc", "skipped")],
                          "ord long, name string, file_name string, ext string, status string").write.parquet(root + "/outcomes")
    _write(root, "log.txt", b"## 10:00:00 - b\nold\n## 11:00:00 - b\nlast line\nof two\n")
    _write(root, "processed/a.pdf", b"x")
    _write(root, "error/x.pdf", b"x")
    assert main(["finish", root + "/outcomes", root + "/log.txt", root + "/processed", root + "/error", root + "/end"]) == 0
    rows = {r.ord: r for r in spark.read.parquet(root + "/end/files").collect()}
    assert rows[0].folder == "processed/" and rows[0].dest_name.startswith("a_") and rows[0].message is None
    assert (rows[1].folder, rows[1].dest_name, rows[1].action, rows[1].message) == ("error/", "b.PDF", "copy", "last line\nof two")
    assert rows[2].message == "no information" and rows[3].folder is None
    assert {tuple(r) for r in spark.read.parquet(root + "/end/types").collect()} == {("pdf", 2), ("doc", 2)}
    _write(root, "out/a.txt", b"x")
    _write(root, "out/b.docx", b"x")
    assert jobs.validate_job(spark, root + "/out", root + "/v") == {"keep": 1, "move": 1}
    texts = spark.createDataFrame([("b.docx", " text ")], "name string, text string")
    assert jobs.repair_job(spark, root + "/out", texts, root + "/r") == {"fixed": 1}


def test_last_decision_of_a_group_holds(spark):
    from docforge.operators import dedup as D
    members = spark.createDataFrame([("content", "g", 1, "/a", 0, 0, "keep"), ("content", "g", 1, "/b", 1, 0, "delete")],
                                    "stage string, group_key string, size long, path string, ord long, mtime_us long, role string")
    said = spark.createDataFrame([("g", "d", None, 1), ("g", "k", None, 2)], "group_key string, choice string, keep_path string, ord int")
    assert sorted((r.path, r.action) for r in D.apply_decisions(members, said).collect()) == [("/a", "keep"), ("/b", "keep")]


def test_budget_of_a_very_long_document(spark):
    from pyspark.sql import functions as F
    from docforge.operators import pages as P
    pages = spark.range(200_000).select(F.lit(1).alias("doc_id"), F.col("id").alias("page_no"), F.lit(2).alias("cost")).unionByName(
        spark.createDataFrame([(None, 1, 5), (None, 2, None), (2, None, 1)], "doc_id int, page_no long, cost int"))
    got = P.budget_pages(pages, 9)
    assert got.where("doc_id = 1 and taken").count() == 4 and got.count() == 200_003
    assert {tuple(r) for r in got.where("doc_id is null or doc_id = 2").collect()} == {
        (None, 1, 5, True), (None, 2, None, False), (2, None, 1, True)}
