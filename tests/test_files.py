"""File sources and sinks on real files written to a fresh temp folder."""

import hashlib
import os

from pyspark.sql import functions as F

from docforge.functions import text as T
from docforge.operators import dedup as D
from docforge.operators import pages as P
from docforge.sinks import writers as W
from docforge.sources import files as S

SAMPLES = {
    "valid.txt": b"caf\xc3\xa9",
    "latin.txt": b"caf\xe9",
    "truncated.txt": b"\xf0\x9f\x98",
    "surrogate.txt": b"\xed\xa0\x80z",
    "newlines.txt": b"a\r\nb\rc\n",
    "empty.txt": b"",
}


def _write(root, rel, data):
    p = os.path.join(root, rel)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "wb") as f:
        f.write(data)
    return p


def test_read_text_corpus_matches_text_mode(spark, tmpdir_fresh):
    for n, b in SAMPLES.items():
        _write(tmpdir_fresh, n, b)
    _write(tmpdir_fresh, "skip.md", b"not a txt")
    got = {r.file_name: (r.text, r.file_size) for r in S.read_text_corpus(spark, tmpdir_fresh).collect()}
    assert set(got) == set(SAMPLES)
    for n, b in SAMPLES.items():
        with open(os.path.join(tmpdir_fresh, n), encoding="utf-8", errors="replace") as f:
            assert got[n] == (f.read(), len(b)), n


def test_decode_with_fallback(spark, tmpdir_fresh):
    for n, b in SAMPLES.items():
        _write(tmpdir_fresh, n.replace(".txt", ".md"), b)
    got = {os.path.basename(r.name): r.text for r in S.read_markdown(spark, tmpdir_fresh).collect()}
    for n, b in SAMPLES.items():
        name = n.replace(".txt", ".md")
        try:
            exp = b.decode("utf-8")
        except UnicodeDecodeError:
            exp = b.decode("latin-1")
        exp = exp.replace("\r\n", "\n").replace("\r", "\n")
        assert got[name] == exp, name


def _tree(root):
    files = {
        "a.txt": b"one", "d1/a.txt": b"one", "d1/a_1.txt": b"two", "d2/a_1_1.txt": b"two",
        "d2/x/.bashrc": b"rc", "d2/x/noext": b"zz", "d3/x.tar.gz": b"gz",
        "e/zero1.bin": b"", "e/zero2.bin": b"", "f/zero1.bin": b"",
        "same/one/q.dat": b"AAAA", "same/two/q.dat": b"BBBB",
        "p/big1.bin": b"x" * 8192 + b"tail-1", "p/big2.bin": b"x" * 8192 + b"tail-2",
        "p/big3.bin": b"x" * 8192 + b"tail-1",
    }
    for rel, b in files.items():
        _write(root, rel, b)
    return files


def test_scan_manifest(spark, tmpdir_fresh):
    files = _tree(tmpdir_fresh)
    m = S.scan_manifest(spark, tmpdir_fresh)
    rows = {r.path.split(tmpdir_fresh.rstrip("/") + "/", 1)[1]: r for r in m.collect()}
    assert set(rows) == set(files)
    for rel, b in files.items():
        r = rows[rel]
        name = os.path.basename(rel)
        assert r.name == name and r.size == len(b)
        assert r.ext == os.path.splitext(name)[1].lower()
        assert r.stem == os.path.splitext(name)[0]
        assert r.depth == (0 if "/" not in rel else rel.count("/"))
    ords = [r.ord for r in sorted(rows.values(), key=lambda r: r.path)]
    assert ords == sorted(ords) and len(set(ords)) == len(ords)


def test_dedup_on_files_with_executor_hashing(spark, tmpdir_fresh):
    files = _tree(tmpdir_fresh)
    m = S.scan_manifest(spark, tmpdir_fresh)
    cands = D.exclude_name_dups(m)
    hashed = S.hash_files(cands)
    for r in hashed.collect():
        rel = r.path.split(tmpdir_fresh.rstrip("/") + "/", 1)[1]
        assert r.md5 == hashlib.md5(files[rel]).hexdigest()
    members = D.filename_dups(m).unionByName(D.content_dups(hashed, use_prefix=False))
    groups = {}
    for r in members.collect():
        groups.setdefault((r.stage, r.group_key), []).append(r)
    # equal size and name, other content: still a filename group (quirk kept)
    assert any(k[0] == "filename" and k[1].endswith(":q.dat") for k in groups)
    # files of the same size and name never reach the content stage
    content_paths = {r.path for rs in groups.values() for r in rs if r.stage == "content"}
    assert not any(p.endswith("/q.dat") or p.endswith("/zero1.bin") for p in content_paths)
    # big1 and big3 equal, big2 shares only the prefix
    big = [sorted(os.path.basename(r.path) for r in rs) for k, rs in groups.items()
           if k[0] == "content" and any("big" in r.path for r in rs)]
    assert big == [["big1.bin", "big3.bin"]]
    for rs in groups.values():
        assert sum(r.role == "keep" for r in rs) == 1


def test_prefix_stage_is_only_a_filter(spark):
    from conftest import SF_MID
    from docforge.fixtures import Fixtures
    m = Fixtures(spark, SF_MID)["manifest"]
    c = D.exclude_name_dups(m)
    for chunk in (1, 64, 8192):
        a = {tuple(r) for r in D.content_dups(c, use_prefix=True, chunk_size=chunk).collect()}
        b = {tuple(r) for r in D.content_dups(c, use_prefix=False).collect()}
        assert a == b


def test_sniff_legacy_doc(spark, tmpdir_fresh):
    magic = bytes.fromhex("D0CF11E0A1B11AE1")
    _write(tmpdir_fresh, "a.doc", magic + b"rest")
    _write(tmpdir_fresh, "b.doc", b"PK\x03\x04....")
    _write(tmpdir_fresh, "c.DOC", magic + b"rest")
    raw = spark.read.format("binaryFile").load(tmpdir_fresh)
    files = raw.select(F.regexp_extract("path", r"([^/]*)$", 1).alias("name"), "content")
    got = {r.name: r.legacy_doc for r in P.sniff_legacy_doc(files).collect()}
    assert got == {"a.doc": True, "b.doc": False, "c.DOC": False}


def test_writers_and_stage_resume(spark, tmpdir_fresh):
    df = spark.createDataFrame([("a", "x"), ("b", "y")], "name string, text string")
    W.write_corpus(df, tmpdir_fresh + "/corpus")
    assert sorted(tuple(r) for r in spark.read.parquet(tmpdir_fresh + "/corpus").collect()) == [("a", "x"), ("b", "y")]
    calls = []

    def build():
        calls.append(1)
        return df

    base = tmpdir_fresh + "/state"
    r1 = W.resume_stage(spark, base, "run1", "names", build)
    r2 = W.resume_stage(spark, base, "run1", "names", build)
    assert len(calls) == 1 and r1.count() == r2.count() == 2
    assert W.stage_done(spark, base, "run1", "names")
    assert not W.stage_done(spark, base, "run1", "other")
    empty = W.read_state(spark, tmpdir_fresh + "/missing", "file_id string")
    assert empty.count() == 0


def test_state_versions_are_claimed_by_one_run_each(spark, tmpdir_fresh):
    import warnings
    base = tmpdir_fresh + "/versions"
    a, b = (spark.createDataFrame([(x,)], "file_id string") for x in "ab")
    v1, v2 = W.claim_version(spark, base), W.claim_version(spark, base)   # two runs begin
    assert W.write_state_version(b, base, v2) == 2 and W.write_state_version(a, base, v1) == 1
    assert [r.file_id for r in W.read_state(spark, base, "file_id string").collect()] == ["b"]
    assert W.write_state_version(a.unionByName(b), base) == 3
    W.claim_version(spark, base)                                          # a run that never finished
    assert W.read_state(spark, base, "file_id string").count() == 2
    damaged = [f for f in os.listdir(base + "/v=3") if f.startswith("part-")]
    for f in damaged:
        for name in (f, f".{f}.crc"):
            if os.path.exists(f"{base}/v=3/{name}"):
                with open(f"{base}/v=3/{name}", "wb") as out:
                    out.write(b"no parquet file")
    with warnings.catch_warnings(record=True) as told:
        warnings.simplefilter("always")
        assert [r.file_id for r in W.read_state(spark, base, "file_id string").collect()] == ["b"]
    assert any("v=3" in str(w.message) for w in told)


def test_roots_have_one_spelling(spark, tmpdir_fresh):
    files = _tree(tmpdir_fresh)
    plain = {tuple(r) for r in S.scan_manifest(spark, tmpdir_fresh).drop("ord").collect()}
    assert len(plain) == len(files)
    for root in (f"file://{tmpdir_fresh}", f"file:{tmpdir_fresh}/", f"{tmpdir_fresh}/d1/../d2/./..//"):
        assert {tuple(r) for r in S.scan_manifest(spark, root).drop("ord").collect()} == plain
    depths = {r.name: r.depth for r in S.scan_manifest(spark, f"{tmpdir_fresh}/p/../d2/x/..", method="binaryFile").collect()}
    assert depths["noext"] == 1
    assert S.normal_root("s3://bucket/a/../b//c/") == "s3://bucket/b/c" and S.normal_root("hdfs://h:8020/") == "hdfs://h:8020"


def test_unreadable_entries_are_rows(spark, tmpdir_fresh):
    """Files that go between listing and reading, dangling links and missing folders."""
    from docforge.plans import jobs
    _write(tmpdir_fresh, "md/a.md", b"# a")
    _write(tmpdir_fresh, "md/b.md", b"b")
    os.symlink(tmpdir_fresh + "/nowhere", tmpdir_fresh + "/md/gone.md")
    found = {os.path.basename(r.path): r.error for r in S.walk_files(spark, tmpdir_fresh, errors=True).collect()}
    assert found == {"a.md": None, "b.md": None, "gone.md": "FileNotFoundError"}
    assert S.walk_files(spark, tmpdir_fresh + "/nowhere", errors=True).first().error == "FileNotFoundError"
    listing = S.walk_files(spark, tmpdir_fresh + "/md")
    os.unlink(tmpdir_fresh + "/md/b.md")
    read = {os.path.basename(r.path): (r.content, r.error) for r in S.read_contents(listing).collect()}
    assert read == {"a.md": (bytearray(b"# a"), None), "b.md": (None, "FileNotFoundError")}
    _write(tmpdir_fresh, "md/b.md", b"b")
    os.mkdir(tmpdir_fresh + "/md/c.md")                                   # a folder is no file
    stats = jobs.clean_job(spark, tmpdir_fresh + "/md", None, tmpdir_fresh + "/out")
    assert stats == {"successful_files": 2, "failed_files": 0, "total_chars": 2}


def test_unreadable_files_count_as_failed(spark):
    from docforge.plans.pipelines import clean_corpus
    md = spark.createDataFrame([("x.md", None), ("y.md", "y")], "name string, text string")
    cleaned, summary = clean_corpus(md)
    assert tuple(summary.first()) == (1, 1, 1) and [tuple(r) for r in cleaned.collect()] == [("y.md", "y")]


def test_listings_leave_a_task_in_batches():
    import tempfile

    import pyarrow as pa
    root = tempfile.mkdtemp()
    for i in range(50_000):
        os.mknod(f"{root}/{i}.txt")
    sizes = [b.num_rows for b in S._list_folders([pa.record_batch({"path": [root]})])]
    assert sum(sizes) == 50_000 and max(sizes) == S.LIST_ROWS


def test_corpora_are_read_once(spark, tmpdir_fresh):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(100).selectExpr("concat('d', id) AS name", "repeat('x', 7) AS text").mapInArrow(count, "name string, text string")
    assert W.write_corpus(df, tmpdir_fresh + "/c") == {"documents": 100, "total_bytes": 700, "total_chars": 700}
    assert seen.value == 100
    got = W.write_dataset(df.selectExpr("text", "name AS file_name", "7L AS file_size"), tmpdir_fresh + "/d", "t")
    assert got == {"documents": 100, "total_bytes": 700} and seen.value == 200


def test_write_dataset_with_card(spark, tmpdir_fresh):
    from docforge.operators.publish import dataset_card
    corpus = spark.createDataFrame([("hello", "a.txt", 5), ("wörld", "b.txt", 6)],
                                   "text string, file_name string, file_size long")
    card = dataset_card(corpus, "t", created="2024-01-01").first()
    assert W.write_dataset(corpus, tmpdir_fresh + "/ds", "t", created="2024-01-01") == {"documents": 2, "total_bytes": 11}
    back = spark.read.parquet(tmpdir_fresh + "/ds/data")
    assert back.schema.simpleString() == "struct<text:string,file_name:string,file_size:bigint>"
    text = "\n".join(r.value for r in spark.read.text(tmpdir_fresh + "/ds/_card").collect())
    assert text.rstrip() == card.card.rstrip() and "- Documents: 2" in text and "- Total size: 0.00 MB" in text


def test_newline_fold_and_strip_whitespace_set(spark):
    import sys
    ws = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace())
    df = spark.createDataFrame([(ws + "x" + ws,), ("a\r\nb\rc",)], "t string")
    got = [r.s for r in df.select(T.py_strip(F.col("t")).alias("s")).collect()]
    assert got[0] == "x"
    assert df.select(T.fold_newlines(F.col("t")).alias("f")).collect()[1].f == "a\nb\nc"


def test_dedup_pipeline_on_a_real_tree(spark, tmpdir_fresh):
    """scan -> filters -> size/name/content stages (executor hashing) ->
    keeper -> plan, compared with a plain-Python run of the cascade."""
    import collections
    from docforge.plans.pipelines import dedup_corpus
    files = _tree(tmpdir_fresh)
    m = S.scan_manifest(spark, tmpdir_fresh)
    res = dedup_corpus(m, strategy="first_found")
    members = res.members.collect()
    groups = collections.defaultdict(set)
    for r in members:
        groups[(r.stage, r.group_key)].add(os.path.relpath(r.path, tmpdir_fresh))
    # plain-Python cascade over the same files
    by_size = collections.defaultdict(list)
    for rel, b in sorted(files.items()):
        by_size[len(b)].append(rel)
    exp = set()
    for size, rels in by_size.items():
        if len(rels) < 2:
            continue
        by_name = collections.defaultdict(list)
        for r in rels:
            by_name[os.path.basename(r)].append(r)
        rest = []
        for n, rs in by_name.items():
            if len(rs) > 1:
                exp.add(("filename", frozenset(rs)))
            else:
                rest += rs
        by_hash = collections.defaultdict(list)
        for r in rest:
            by_hash[hashlib.md5(files[r]).hexdigest()].append(r)
        for rs in by_hash.values():
            if len(rs) > 1:
                exp.add(("content", frozenset(rs)))
    assert {(k[0], frozenset(v)) for k, v in groups.items()} == exp
    st = res.stats.collect()[0]
    assert st.total_files == len(files)
    assert st.duplicate_files == sum(len(v) - 1 for _, v in exp)
    assert res.plan.count() == st.duplicate_files


def test_glob_rules_and_hidden_names(spark, tmpdir_fresh):
    import glob as G
    for n in ["a.txt", ".hidden.txt", "_under.txt", "b.TXT", "c.md"]:
        _write(tmpdir_fresh, n, n.encode())
    got = {r.file_name: r.text for r in S.read_text_corpus(spark, tmpdir_fresh, "*.txt").collect()}
    exp = {os.path.basename(p): open(p).read() for p in G.glob(os.path.join(tmpdir_fresh, "*.txt"))}
    assert got == exp and "_under.txt" in got


def test_dedup_pipeline_resumes_finished_stages(spark, tmpdir_fresh):
    from docforge.plans.pipelines import dedup_corpus
    src = os.path.join(tmpdir_fresh, "src")
    _tree(src)
    m = S.scan_manifest(spark, src)
    state = os.path.join(tmpdir_fresh, "state")
    a = {tuple(r) for r in dedup_corpus(m, state_dir=state, run_id="r1").members.collect()}
    for stage in ("names", "filename_groups", "content_groups"):
        assert W.stage_done(spark, state, "r1", stage)
    b = {tuple(r) for r in dedup_corpus(m, state_dir=state, run_id="r1").members.collect()}
    assert a == b and len(a) > 0
