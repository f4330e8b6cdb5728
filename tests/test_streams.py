"""Streaming forms against their batch forms, and restarts."""

import hashlib
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from docforge.functions import text as T
from docforge.operators import quota as Q
from docforge.plans import q_stream
from docforge.streaming import streams as S


def test_stream_clean_equals_batch_and_restart_adds_nothing(spark, tmpdir_fresh):
    from conftest import SF_SMALL
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    src = os.path.join(tmpdir_fresh, "in")
    docs.repartition(4).write.parquet(src)
    out, ck = os.path.join(tmpdir_fresh, "out"), os.path.join(tmpdir_fresh, "ck")
    for _ in range(2):
        q = S.stream_clean(S.table_stream(spark, src, docs.schema, max_files_per_trigger=1), out, ck)
        q.awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == docs.count()
    batch = docs.withColumn("text", T.clean_markdown(F.col("text")))
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0


def test_stream_dedup_same_keys_as_batch(spark, tmpdir_fresh):
    from conftest import SF_SMALL
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(
        F.octet_length("text").cast("long").alias("size"), F.md5("text").alias("md5"), "doc_id")
    src = os.path.join(tmpdir_fresh, "in")
    docs.repartition(3).write.parquet(src)
    out, ck = os.path.join(tmpdir_fresh, "out"), os.path.join(tmpdir_fresh, "ck")
    S.run_available(S.stream_dedup(S.table_stream(spark, src, docs.schema, max_files_per_trigger=1)), out, ck)
    got = spark.read.parquet(out)
    assert got.count() == docs.select("size", "md5").distinct().count()
    assert got.groupBy("size", "md5").count().filter("count > 1").count() == 0


def _document_folder(spark, folder, texts, files=3):
    """A ``documents`` table as a folder of files, as larger tables come."""
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    df.repartition(files, "doc_id").write.parquet(f"{folder}/documents.parquet")


def test_stream_clean_query_reads_a_folder_of_files(spark, tmpdir_fresh):
    texts = ["# A\n**x**", "> quote\n1. one", "", None, "plain", "# A\n**x**"]
    _document_folder(spark, tmpdir_fresh, texts)
    got = q_stream.q_stream_clean(spark, tmpdir_fresh)
    batch = spark.read.parquet(f"{tmpdir_fresh}/documents.parquet").withColumn("text", T.clean_markdown(F.col("text")))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect())) and got.count() == len(texts)


def test_stream_queries_read_a_single_file_beside_others(spark, tmpdir_fresh):
    import pyarrow as pa
    import pyarrow.parquet as pq
    for name, texts in (("documents", ["**a**", "b", "b"]), ("others", ["c"])):
        pq.write_table(pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": texts}),
                       f"{tmpdir_fresh}/{name}.parquet")
    assert sorted(r.text for r in q_stream.q_stream_clean(spark, tmpdir_fresh).collect()) == ["a", "b", "b"]
    assert sorted(r.size for r in q_stream.q_stream_dedup(spark, tmpdir_fresh).collect()) == [1, 5]


def test_stream_clean_query_of_no_rows(spark, tmpdir_fresh):
    _document_folder(spark, tmpdir_fresh, [])
    assert q_stream.q_stream_clean(spark, tmpdir_fresh).collect() == []


def test_stream_dedup_query_reads_a_folder_of_files(spark, tmpdir_fresh):
    texts = ["a", "b", "a", None, "", None, "é", "b", "a"]
    _document_folder(spark, tmpdir_fresh, texts)
    got = q_stream.q_stream_dedup(spark, tmpdir_fresh).collect()
    raw = [None if t is None else t.encode() for t in set(texts)]
    exp = {(None, None) if t is None else (len(t), hashlib.md5(t).hexdigest()) for t in raw}
    assert len(got) == len(exp) and set(map(tuple, got)) == exp


def test_stream_dedup_query_of_no_rows(spark, tmpdir_fresh):
    _document_folder(spark, tmpdir_fresh, [])
    assert q_stream.q_stream_dedup(spark, tmpdir_fresh).collect() == []


def test_stream_quota_exact_across_batches(spark, tmpdir_fresh):
    rows = []
    t = 0
    for i in range(400):
        t += (i * 7919) % 23 * 1_000_000
        rows.append((i, i % 2, t, (i * 31) % 1000))
    df = spark.createDataFrame(rows, "event_id long, api_key long, ts_us long, tokens long")
    src = os.path.join(tmpdir_fresh, "in")
    # files in time order, one per micro-batch
    for j in range(4):
        df.filter((F.col("event_id") >= j * 100) & (F.col("event_id") < (j + 1) * 100))\
            .coalesce(1).write.parquet(os.path.join(src, f"part{j}"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1)\
        .option("recursiveFileLookup", "true").parquet(src)
    out, ck = os.path.join(tmpdir_fresh, "out"), os.path.join(tmpdir_fresh, "ck")
    S.run_available(S.stream_quota_exact(stream), out, ck)
    got = {r.event_id: tuple(r)[3:] for r in spark.read.parquet(out).collect()}
    exp = {r.event_id: tuple(r)[3:] for r in Q.quota_fold(df).collect()}
    assert got == exp


_REQUESTS = "event_id long, api_key long, ts_us long, tokens long"


def _folded_one_by_one(batches, anchor=None):
    """The plain fold: every key of every batch in one go."""
    carry, exp = {}, {}
    for rows in batches:
        pdf = pd.DataFrame(rows, columns=["event_id", "api_key", "ts_us", "tokens"])
        for key, own in pdf.groupby("api_key"):
            start = carry.get(key) or Q.fresh_carry(int(own["ts_us"].min()) if anchor is None else anchor)
            out, carry[key] = Q.fold_batch(own, start)
            exp |= {r[0]: r[1:] for r in out.itertuples(index=False, name=None)}
    return exp


def _fold_batches(spark, batches, anchor=None):
    state, got = None, {}
    for rows in batches:
        folded = Q.quota_fold_after(spark.createDataFrame(rows, _REQUESTS), state, anchor).localCheckpoint()
        state = Q.carried(folded, state).localCheckpoint()
        got |= {r.event_id: tuple(r)[1:8] for r in folded.collect()}
    return got


def test_quota_fold_of_a_hot_key_is_in_ranges_of_bounded_rows(spark, monkeypatch):
    """Before, all rows of a key in a micro-batch were one pandas frame."""
    monkeypatch.setattr(Q, "RANGE_ROWS", 100)
    df = spark.range(3000).select(F.col("id").alias("event_id"), F.lit(1).cast("long").alias("api_key"),
                                  (F.col("id") * 700_000).alias("ts_us"), (F.col("id") % 90).alias("tokens"))
    folded = Q.quota_fold_after(df, None).localCheckpoint()
    assert max(r["count"] for r in folded.groupBy("_range").count().collect()) <= 300
    got = {r.event_id: tuple(r)[1:8] for r in folded.collect()}
    assert got == {r.event_id: tuple(r)[1:] for r in Q.quota_fold(df).collect()}


def test_quota_fold_goes_on_from_carried_counters(spark, monkeypatch):
    monkeypatch.setattr(Q, "RANGE_ROWS", 40)
    hour = 3_600_000_000
    batches = [[(b * 1000 + i, key, b * 20 * hour + i * i * 90_001 + i % 3 * 17, (i * 31) % 50)
                for i in range(240) for key in [(1 if i % 4 else 2 + (i * 7 + b) % 9)]] for b in range(3)]
    for anchor in (None, 5_000_000):
        assert _fold_batches(spark, batches, anchor) == _folded_one_by_one(batches, anchor)


def test_quota_fold_of_requests_before_the_carried_ones(spark, monkeypatch):
    monkeypatch.setattr(Q, "RANGE_ROWS", 20)
    late = [[(i, 1, 500_000_000 + i * 400_000, 1) for i in range(100)],
            [(1000 + i, 1, 100_000_000 + i * 9_000_000, 1) for i in range(100)]]
    assert _fold_batches(spark, late) == _folded_one_by_one(late)


def test_quota_fold_of_requests_without_a_time(spark, monkeypatch):
    """They come last, reset nothing and change nothing for the others."""
    monkeypatch.setattr(Q, "RANGE_ROWS", 10)
    dated = [(i, 1, i * 8_000_000, 5) for i in range(60)]
    undated = [(100 + i, 1, None, 2) for i in range(30)] + [(200, 2, None, 4), (201, 2, None, None)]
    got = _fold_batches(spark, [dated + undated])
    exp = _folded_one_by_one([dated])
    assert {k: v for k, v in got.items() if k < 100} == exp
    assert [got[100 + i][2:] for i in range(30)] == [
        (exp[59][2] + 2 * (i + 1), 61 + i, i - 29, False, False) for i in range(30)]
    assert [got[i][2:] for i in (200, 201)] == [(4, 1, -1, False, False), (4, 2, 0, False, False)]


def test_stream_quota_exact_goes_on_after_a_cut_and_restarts(spark, tmpdir_fresh, monkeypatch):
    rows = [(i, None if i % 5 == 0 else i % 2, i * 3_000_000, i) for i in range(300)]
    src, out, ck = (os.path.join(tmpdir_fresh, x) for x in ("in", "out", "ck"))

    def arrive(j):
        spark.createDataFrame(rows[j * 100:(j + 1) * 100], _REQUESTS).coalesce(1).write.mode("append").parquet(src)

    def run():
        S.run_available(S.stream_quota_exact(
            S.table_stream(spark, src, spark.read.parquet(src).schema, max_files_per_trigger=1)), out, ck)

    arrive(0)
    run()
    arrive(1)
    with monkeypatch.context() as m:       # the rows of the batch are written, its state is not
        m.setattr(S, "carried", lambda *a: 1 / 0)
        with pytest.raises(Exception, match="ZeroDivisionError|division by zero"):
            run()
    arrive(2)
    run()
    run()
    got = sorted(map(tuple, spark.read.parquet(out).collect()))
    assert got == sorted(map(tuple, Q.quota_fold(spark.createDataFrame(rows, _REQUESTS)).collect()))
    assert os.listdir(os.path.join(ck, "folded")) == []


def test_stream_quota_exact_query_reads_a_folder_in_any_order(spark, tmpdir_fresh):
    import datetime as dt
    base = dt.datetime(2024, 1, 1)
    events = spark.createDataFrame([(i, base + dt.timedelta(hours=i * 37 % 200), i % 5, i / 4) for i in range(200)],
                                   "event_id long, ts timestamp_ntz, user_id long, value double")
    events.repartition(4, "event_id").write.parquet(f"{tmpdir_fresh}/events.parquet")
    got = q_stream.q_stream_quota_exact(spark, tmpdir_fresh).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, Q.quota_fold(q_stream._requests(events)).collect()))


def test_markdown_folder_incremental_runs(spark, tmpdir_fresh):
    """Files arriving in a folder are cleaned once each across runs."""
    src = os.path.join(tmpdir_fresh, "md")
    os.makedirs(src)
    for n, b in [("a.md", b"# A\n**x**"), ("b.md", b"caf\xe9 - y")]:
        with open(os.path.join(src, n), "wb") as f:
            f.write(b)
    out, ck = os.path.join(tmpdir_fresh, "out"), os.path.join(tmpdir_fresh, "ck")
    S.stream_clean(S.markdown_stream(spark, src), out, ck).awaitTermination()
    assert spark.read.parquet(out).count() == 2
    with open(os.path.join(src, "c.md"), "wb") as f:
        f.write(b"> quote\n1. one")
    S.stream_clean(S.markdown_stream(spark, src), out, ck).awaitTermination()
    got = {os.path.basename(r.name): r.text for r in spark.read.parquet(out).collect()}
    assert got == {"a.md": "A\nx", "b.md": "café - y", "c.md": "quote\none"}


def test_stream_dedup_within_watermark(spark, tmpdir_fresh):
    import datetime as dt
    base = dt.datetime(2024, 1, 1)
    rows = [(1, "h1", base), (2, "h1", base + dt.timedelta(seconds=5)), (3, "h2", base),
            (4, "h2", base + dt.timedelta(seconds=1)), (5, "h3", base)]
    df = spark.createDataFrame(rows, "id long, md5 string, ts timestamp").withColumn("size", F.lit(1).cast("long"))
    src = os.path.join(tmpdir_fresh, "in")
    df.coalesce(1).write.parquet(src)
    out, ck = os.path.join(tmpdir_fresh, "out"), os.path.join(tmpdir_fresh, "ck")
    stream = S.table_stream(spark, src, df.schema)
    S.run_available(S.stream_dedup(stream, watermark=("ts", "1 hour")), out, ck)
    got = spark.read.parquet(out)
    assert sorted(r.md5 for r in got.collect()) == ["h1", "h2", "h3"]


def test_folder_increments_see_what_the_batch_job_sees(spark, tmpdir_fresh):
    import os

    from docforge.plans import jobs
    from docforge.streaming import streams as ST

    def write(name, data):
        os.makedirs(tmpdir_fresh + "/md", exist_ok=True)
        with open(f"{tmpdir_fresh}/md/{name}", "wb") as f:
            f.write(data)

    def step():
        return ST.clean_folder(spark, tmpdir_fresh + "/md", tmpdir_fresh + "/inc", tmpdir_fresh + "/state")

    write("a.md", b"# a")
    write("empty.md", b"")
    write("_hidden.md", b"**h**")
    write("skip.txt", b"x")
    batch = jobs.clean_job(spark, tmpdir_fresh + "/md", None, tmpdir_fresh + "/batch")
    assert step() == batch == {"successful_files": 3, "failed_files": 0, "total_chars": 2}
    assert step()["successful_files"] == 0
    write("b.md", b"new")
    write("a.md", b"# changed")
    assert step() == {"successful_files": 2, "failed_files": 0, "total_chars": 10}
    got = {r.name: r.text for r in ST.read_increments(spark, tmpdir_fresh + "/inc", tmpdir_fresh + "/state").collect()}
    assert got == {"a.md": "changed", "empty.md": "", "_hidden.md": "h", "b.md": "new"}
