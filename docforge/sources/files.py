"""File-system sources: listings, text corpora and content hashes.

Folders are listed on the executors, one distributed job per tree level, by the
local file API or, for object stores, by Arrow's file systems; entries leave a
task in batches of ``LIST_ROWS``.  Files that cannot be listed or read are rows
with an ``error``, never silently missing.  Content is read only by the stages
that need it, in batches of about ``READ_BYTES``: ``read_text_corpus`` and
``read_markdown`` (decode) and ``hash_files`` (the duplicate cascade's prefix
and full hashes, streamed in chunks so a file never has to fit in one cell).
"""

from __future__ import annotations

import hashlib
import os
import posixpath
import re
import stat
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from ..functions import text as TX
from ..functions.names import base_name, parent_dir, split_ext, stem
from ..session import reliable_checkpoint

MANIFEST_SCHEMA = ("path string, name string, stem string, ext string, depth bigint, "
                   "size bigint, mtime_us bigint, ord bigint")
LIST_ROWS = 10_000         # entries of a folder that a task holds at a time
READ_BYTES = 32 << 20      # file bytes that a task holds at a time (one larger file is a batch of its own)
CELL_BYTES = (1 << 31) - 1 # what fits in one binary cell
# schemes that Arrow's file systems open; others are listed by Spark's binaryFile source
ARROW_SCHEMES = ("s3", "gs", "gcs", "hdfs", "abfs", "abfss")

_ENTRY = "path string, is_dir boolean, size bigint, mtime_us bigint, error string"
_ENTRY_ARROW = pa.schema([("path", pa.string()), ("is_dir", pa.bool_()), ("size", pa.int64()), ("mtime_us", pa.int64()),
                          ("error", pa.string())])


def normal_root(root: str) -> str:
    """The folder as one spelling: ``file:`` forms and relative paths become
    absolute local paths; ``.``, ``..`` and repeated or trailing slashes go."""
    scheme, colon, rest = root.partition(":")
    if not colon or "/" in scheme:
        return os.path.abspath(root)
    if scheme == "file":
        return os.path.abspath("/" + rest.lstrip("/"))
    host, _, path = rest.removeprefix("//").partition("/")
    return f"{scheme}://{host}{posixpath.normpath('/' + path)}".rstrip("/")


def _is_local(path: str) -> bool:
    return normal_root(path).startswith("/")


def _scheme(path: str) -> str:
    return "" if path.startswith("/") else path.partition(":")[0]


def _listing(spark: SparkSession, root: str, recursive: bool, glob: str | None) -> DataFrame:
    r = spark.read.format("binaryFile")
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(root)


def _entries(folder: str) -> Iterator[tuple]:
    """``(path, is_dir, size, mtime_us, error)`` of the entries of a folder;
    symbolic links to folders are not followed."""
    if _scheme(folder):
        system, path = pafs.FileSystem.from_uri(folder)
        base = folder[:len(folder) - len(path)] if folder.endswith(path) else f"{_scheme(folder)}://"
        for e in system.get_file_info(pafs.FileSelector(path)):
            yield base + e.path, e.type == pafs.FileType.Directory, e.size, (e.mtime_ns or 0) // 1000, None
        return
    with os.scandir(folder) as found:
        for e in found:
            try:
                if e.is_dir(follow_symlinks=False):
                    yield e.path, True, None, None, None
                elif stat.S_ISREG((st := e.stat()).st_mode):
                    yield e.path, False, st.st_size, st.st_mtime_ns // 1000, None
            except OSError as why:
                yield e.path, False, None, None, type(why).__name__


def _list_folders(batches) -> Iterator[pa.RecordBatch]:
    def made(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            zip(*rows, strict=True), _ENTRY_ARROW.types, strict=True)], schema=_ENTRY_ARROW)

    for batch in batches:
        rows = []
        for folder in batch.column(0).to_pylist():
            try:
                for entry in _entries(folder):
                    rows.append(entry)
                    if len(rows) >= LIST_ROWS:
                        yield made(rows)
                        rows = []
            except OSError as why:
                rows.append((folder, False, None, None, type(why).__name__))
        if rows:
            yield made(rows)


def walk_files(spark: SparkSession, root: str, recursive: bool = True, errors: bool = False) -> DataFrame:
    """``path, size, mtime_us`` of all regular files under ``root``, empty and
    hidden files included.  Breadth-first: one distributed listing job per tree
    level, each level frozen in the shared checkpoint folder.  With ``errors``
    also a column ``error``, and a row for every folder or entry that could not
    be listed (its size is null); without, those rows are left out."""
    level = spark.createDataFrame([(normal_root(root),)], "path string")
    files = None
    while True:
        entries = level.mapInArrow(_list_folders, _ENTRY).transform(reliable_checkpoint)
        f = entries.filter(~F.col("is_dir")).select("path", "size", "mtime_us", "error")
        files = f if files is None else files.unionByName(f)
        level = entries.filter(F.col("is_dir")).select("path")
        if not recursive or level.isEmpty():
            return files if errors else files.where("error is null").drop("error")
        # small folders share a task, and a flat folder's sub-folders spread
        level = level.repartition(spark.sparkContext.defaultParallelism * 4)


def _qualified(spark: SparkSession, root: str) -> str:
    """The folder as Spark's file sources spell it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.makeQualified(path).toString()


def scan_manifest(spark: SparkSession, root: str, recursive: bool = True, glob: str | None = None,
                  method: str | None = None, freeze: bool = True, with_content: bool = False) -> DataFrame:
    """One row per file under ``root`` (recursion is on by default).

    ``method="walk"`` (default for local, mounted and Arrow-readable paths)
    lists on the executors and keeps empty and hidden files;
    ``method="binaryFile"`` uses Spark's file source, which skips them.  Equal
    folders give equal rows however they are spelled.
    ``ord`` is the scan order: files sorted by path (range-partitioned, no
    single-task sort) and numbered with increasing ids; with ``freeze`` the
    numbered listing is checkpointed so every later use sees the same ``ord``.
    ``with_content`` (``binaryFile`` only) keeps the file bytes as ``content``
    for roots that executors cannot open as local paths (object stores).
    """
    root = normal_root(root)
    if method is None:
        method = "walk" if _scheme(root) in ("", *ARROW_SCHEMES) and not with_content else "binaryFile"
    if method == "walk":
        df = glob_filter(walk_files(spark, root, recursive), glob)
    else:
        cols = [F.col("path"), F.col("length").alias("size"),
                F.unix_micros(F.col("modificationTime")).alias("mtime_us")]
        df = _listing(spark, root, recursive, glob).select(*cols, *([F.col("content")] if with_content else []))
        root = _qualified(spark, root)
    rel = F.substr(F.col("path"), F.lit(len(root.rstrip("/")) + 2))
    name = base_name(F.col("path"))
    rel_dir = parent_dir(rel)
    depth = F.when(rel_dir == "", F.lit(0)).otherwise(F.size(F.split(rel_dir, "/"))).cast("bigint")
    df = df.select(
        "path", name.alias("name"), stem(name).alias("stem"), F.lower(split_ext(name)).alias("ext"),
        depth.alias("depth"), F.col("size").cast("bigint").alias("size"), F.col("mtime_us").cast("bigint"),
        *(["content"] if "content" in df.columns else []))
    df = (df.repartitionByRange("path").sortWithinPartitions("path")
          .withColumn("ord", F.monotonically_increasing_id()))
    if freeze:
        df = df.transform(reliable_checkpoint)
    return df


def _glob_regex(glob: str) -> str:
    """A file-name glob as an anchored Java regex (Python's translation;
    ``\\Z`` is Java's ``\\z``)."""
    import fnmatch
    return "^" + fnmatch.translate(glob).replace("\\Z", "\\z")


def glob_filter(df: DataFrame, glob: str | None) -> DataFrame:
    """Match base names like Python's ``glob``: ``*``/``?`` never match a
    leading dot."""
    if not glob:
        return df
    name = base_name(F.col("path"))
    cond = name.rlike(_glob_regex(glob))
    if not glob.startswith("."):
        cond = cond & ~name.startswith(".")
    return df.filter(cond)


def _bytes_of(path: str, size: int | None) -> bytes:
    if size is not None and size > CELL_BYTES:
        raise OSError(f"over {CELL_BYTES} bytes")
    if not _scheme(path):
        with open(path, "rb") as f:
            return f.read()
    system, inner = pafs.FileSystem.from_uri(path)
    with system.open_input_stream(inner) as f:
        return f.read()


def read_contents(listing: DataFrame) -> DataFrame:
    """Add the bytes of each listed file as ``content``, read on the executors
    in batches of about ``READ_BYTES``: exactly the listed files, including
    empty ones and names that Spark's own listing hides (``_x``, ``.x``).  A
    file that cannot be read has null content and says why in ``error``."""
    listing = listing.drop("content", "error")
    schema = T_.StructType([*listing.schema.fields, T_.StructField("content", T_.BinaryType()),
                            T_.StructField("error", T_.StringType())])
    names = [f.name for f in schema]
    at_path, at_size = names.index("path"), names.index("size") if "size" in names else None

    def read(batches):
        for batch in batches:
            paths = batch.column(at_path).to_pylist()
            sizes = batch.column(at_size).to_pylist() if at_size is not None else [None] * len(paths)
            start, data, errors, held = 0, [], [], 0
            for i, (path, size) in enumerate(zip(paths, sizes, strict=True), 1):
                try:
                    data.append(_bytes_of(normal_root(path), size))
                    errors.append(None)
                except (OSError, pa.ArrowException) as why:
                    data.append(None)
                    errors.append(type(why).__name__)
                held += len(data[-1] or b"")
                if held >= READ_BYTES or i == len(paths):
                    part = batch.slice(start, i - start)
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(data, pa.binary()), pa.array(errors, pa.string())],
                                                     names)
                    start, data, errors, held = i, [], [], 0

    return listing.mapInArrow(read, schema)


def _files_with_content(spark: SparkSession, folder: str, recursive: bool, glob: str | None) -> DataFrame:
    """``path, size, mtime_us, content, error`` for matching files: an executor
    listing and executor reads, Spark's ``binaryFile`` source for schemes that
    only it opens (which skips empty and hidden files)."""
    folder = normal_root(folder)
    if _scheme(folder) not in ("", *ARROW_SCHEMES):
        return _listing(spark, folder, recursive, glob).select(
            "path", F.col("length").cast("bigint").alias("size"),
            F.unix_micros("modificationTime").alias("mtime_us"), "content", F.lit(None).cast("string").alias("error"))
    listing = glob_filter(walk_files(spark, folder, recursive), glob)
    # files of very different sizes: spread them, so that a task reads about as many as the next
    return read_contents(listing.repartition(spark.sparkContext.defaultParallelism * 4))


def read_text_corpus(spark: SparkSession, path: str, pattern: str = "*.txt", failures: bool = False) -> DataFrame:
    """``(text, file_name, file_size)`` for files matching ``pattern`` in a
    folder (not recursive), or for one file.  UTF-8 with U+FFFD for bad bytes,
    newlines folded as text mode does; size in bytes.  Files that cannot be read
    are left out; with ``failures`` they are rows with a null text."""
    folder = normal_root(path)
    if not _scheme(folder) and os.path.isfile(folder):
        folder, name = os.path.split(folder)
        pattern = re.sub(r"([*?[])", r"[\1]", name)
    raw = _files_with_content(spark, folder, recursive=False, glob=pattern)
    raw = raw if failures else raw.where("content is not null")
    return raw.select(
        TX.fold_newlines(TX.decode_utf8_replace(F.col("content"))).alias("text"),
        base_name(F.col("path")).alias("file_name"),
        F.col("size").cast("bigint").alias("file_size"))


def corpus_from_table(documents: DataFrame) -> DataFrame:
    """The same decoding applied to a document table (bytes of ``text``)."""
    return documents.select(
        TX.fold_newlines(TX.decode_utf8_replace(F.col("text").cast("binary"))).alias("text"),
        F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("file_name"),
        F.octet_length("text").cast("bigint").alias("file_size"))


def read_markdown(spark: SparkSession, folder: str, fallback_latin1: bool = True) -> DataFrame:
    """Direct ``*.md`` children of a folder, decoded strictly as UTF-8 with a
    whole-file latin-1 fallback, newlines folded.  A file that cannot be read
    has a null text and an ``error``."""
    raw = _files_with_content(spark, folder, recursive=False, glob="*.md")
    dec = TX.decode_with_fallback(F.col("content")) if fallback_latin1 else TX.decode_utf8_replace(F.col("content"))
    name = base_name(F.col("path"))
    return raw.select("path", name.alias("name"), stem(name).alias("stem"),
                      F.col("size").cast("bigint").alias("size"),
                      TX.fold_newlines(dec).alias("text"), "error")


def list_markdown(spark: SparkSession, folder: str) -> DataFrame:
    """Direct ``*.md`` children of a folder (metadata only)."""
    folder = normal_root(folder)
    if _scheme(folder) in ("", *ARROW_SCHEMES):
        raw = glob_filter(walk_files(spark, folder, recursive=False), "*.md")
    else:
        raw = _listing(spark, folder, recursive=False, glob="*.md").select("path", F.col("length").alias("size"))
    name = base_name(F.col("path"))
    return raw.select("path", name.alias("name"), stem(name).alias("stem"),
                      F.col("size").cast("bigint").alias("size"))


# ---------------------------------------------------------------------------
# hashing files on the executors
# ---------------------------------------------------------------------------
def _hash_batches(chunk_size: int, first_chunk_only: bool, out: str):
    def digest(path: str) -> str | None:
        if not path.startswith(("/", "file:")):
            raise ValueError(f"cannot open {path!r} on executors; scan with with_content=True")
        h = hashlib.md5()
        try:
            with open(normal_root(path), "rb") as f:
                if first_chunk_only:
                    h.update(f.read(chunk_size))
                else:
                    while chunk := f.read(max(chunk_size, 1 << 20)):
                        h.update(chunk)
            return h.hexdigest()
        except OSError:
            return None            # unreadable: left out of groups

    def run(batches):
        for pdf in batches:
            yield pdf.assign(**{out: [digest(p) for p in pdf["path"]]})
    return run


def hash_files(files: DataFrame, chunk_size: int = 8192, first_chunk_only: bool = False,
               out: str | None = None) -> DataFrame:
    """Add the md5 of each file's bytes (or of its first ``chunk_size``
    bytes).  Reads only the listed files, in bounded memory, on executors.
    Paths must be visible to the executors as local paths (a local or
    mounted shared file system); a file that cannot be read hashes to null
    and stays out of groups, as in a walk.  Other schemes are refused: give
    the manifest a ``content`` column instead (``with_content=True``)."""
    out = out or ("prefix_md5" if first_chunk_only else "md5")
    schema = T_.StructType(files.schema.fields + [T_.StructField(out, T_.StringType())])
    return files.mapInPandas(_hash_batches(chunk_size, first_chunk_only, out), schema)
