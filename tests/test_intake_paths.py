"""Files with equal base names stay different files; runs resume only as they
were started; the cascade scans its input once."""

import pytest
from pyspark.sql import functions as F

from docforge.operators import dedup as D
from docforge.operators import intake as I
from docforge.plans import jobs as J
from docforge.plans import pipelines as PL

FILES = "path string, name string, size long, ord long, page_count long"


def test_equal_names_in_inbox_and_quarantine(spark):
    inbox = spark.createDataFrame([("/i/x/a.pdf", "a.pdf", 10, 0, 3), ("/i/y/a.pdf", "a.pdf", 5, 1, 1),
                                   ("/i/b.doc", "b.doc", 7, 2, None)], FILES)
    quarantine = spark.createDataFrame([("/e/q.pdf", "q.pdf", 4, 0, 2), ("/e/z/q.pdf", "q.pdf", 1, 1, None),
                                        ("/e/error_log.txt", "error_log.txt", 9, 2, None)], FILES)
    none, done = spark.createDataFrame([], "stem string"), spark.createDataFrame([("a",), ("b",)], "stem string")
    got = PL.intake_batch(inbox, none, quarantine).orderBy("position").collect()
    assert [(r.name, r.pages, r.score, r.from_quarantine) for r in got] == [
        ("a.pdf", 1, 5.0, False), ("b.doc", 1, 7.0, False), ("a.pdf", 3, 30.0, False)]
    got = PL.intake_batch(inbox, done, quarantine).orderBy("position").collect()
    assert [(r.name, r.pages, r.score, r.from_quarantine) for r in got] == [
        ("q.pdf", 1, 1.0, True), ("q.pdf", 2, 8.0, True)]


def test_every_route_has_its_own_destination(spark):
    rows = [(0, "x.pdf", "ok"), (1, "x.pdf", "ok"), (2, "x.pdf", "failed"), (3, "y.doc", "ok"),
            (4, "x.pdf", "ok"), (5, "z.doc", "skipped"), (6, "y.doc", "failed")]
    o = spark.createDataFrame(rows, "ord long, file_name string, status string")
    taken = spark.createDataFrame([("y.doc", "processed/")], "name string, folder string")
    got = {r.ord: r.folder + r.dest_name for r in I.route_manifest(o, taken, 17).collect()}
    assert got == {0: "processed/x.pdf", 1: "processed/x_17.pdf", 2: "error/x.pdf", 3: "processed/y_17.doc",
                   4: "processed/x_17_2.pdf", 6: "error/y.doc"}
    anywhere = {r.ord: r.dest_name for r in I.route_manifest(o, taken.select("name"), 17).collect()}
    assert anywhere[6] == "y_17.doc"


def test_routes_keep_outcomes_without_name_or_position(spark):
    rows = [(0, "x.pdf", "ok"), (None, "x.pdf", "ok"), (70000, "x.pdf", "ok"), (3, None, "ok"), (None, None, "failed")]
    o = spark.createDataFrame(rows, "ord long, file_name string, status string")
    taken = spark.createDataFrame([("y.doc", "processed/"), (None, "error/")], "name string, folder string")
    got = {(r.ord, r.file_name): (r.folder, r.dest_name) for r in I.route_manifest(o, taken, 17).collect()}
    assert got == {(0, "x.pdf"): ("processed/", "x.pdf"), (70000, "x.pdf"): ("processed/", "x_17.pdf"),
                   (None, "x.pdf"): ("processed/", "x_17_2.pdf"), (3, None): ("processed/", None),
                   (None, None): ("error/", None)}


def test_a_run_resumes_only_as_it_was_started(spark, tmpdir_fresh):
    import os
    src, state = f"{tmpdir_fresh}/src", f"{tmpdir_fresh}/state"
    for k, name in enumerate(["p/a.txt", "q/a.txt", "q/b.txt"]):
        os.makedirs(os.path.dirname(f"{src}/{name}"), exist_ok=True)
        with open(f"{src}/{name}", "w") as f:
            f.write("same" if k < 2 else "else")
    first = J.dedup_job(spark, src, f"{tmpdir_fresh}/o1", state_dir=state)
    with open(f"{src}/q/c.txt", "w") as f:   # not seen by the resumed run
        f.write("else")
    assert J.dedup_job(spark, src, f"{tmpdir_fresh}/o2", state_dir=state) == first
    with pytest.raises(ValueError):
        J.dedup_job(spark, src, f"{tmpdir_fresh}/o3", state_dir=state, strategy="oldest")
    with pytest.raises(ValueError):
        J.dedup_job(spark, f"{src}/q", f"{tmpdir_fresh}/o4", state_dir=state)
    manifest = spark.createDataFrame([("/a", "a", ".txt", 0, 1, 5, 0, "t")],
                                     "path string, name string, ext string, depth long, size long, mtime_us long, "
                                     "ord long, text string")
    PL.dedup_corpus(manifest, strategy="newest", state_dir=state, run_id="c")
    with pytest.raises(ValueError):
        PL.dedup_corpus(manifest, strategy="oldest", state_dir=state, run_id="c")


def test_cascade_leaves_content_in_the_scan(spark):
    from conftest import SF_SMALL
    from docforge.fixtures import Fixtures
    members = D.all_dups(Fixtures(spark, SF_SMALL)["manifest"])
    plan = members._jdf.queryExecution().executedPlan().toString()
    assert "parquet" not in plan.lower() and "text#" not in plan


def test_report_numbers_a_large_group(spark):
    n = 3000
    m = spark.range(n).select(
        F.format_string("/d/%05d/a", "id").alias("path"), F.lit("a").alias("name"), F.lit("").alias("ext"),
        F.lit(1).cast("long").alias("depth"), F.lit(4).cast("long").alias("size"),
        (F.col("id") * 7919 % n).alias("mtime_us"), F.col("id").alias("ord"), F.lit("same").alias("text"))
    rows = D.dup_report(D.dup_members(m, with_order=True), m, "/d", "now").filter("group_no = 1")
    rows = rows.orderBy("line_no").collect()
    assert [r.line_no for r in rows] == list(range(n + 2))
    by_time = sorted(range(n), key=lambda i: i * 7919 % n)
    assert [r.line for r in rows[1:-1]] == [f"  Keep: /d/{by_time[-1]:05d}/a"] + [
        f"  Delete: /d/{i:05d}/a" for i in by_time[:-1]]
