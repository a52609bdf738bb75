"""Splittable reading of large event listings, with a per-file ordinal.

A listing is cut at its record separator while it is read, so one big file is
spread over many tasks. Files may be split anywhere; the start offset of the
split and the order inside it give each record its position in the file.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import sha256
from ..session import cut

SUCCESS_MARKER = "SUCCESS"
#: Rows of the split table that are broadcast: about 200 MB with long paths.
MOST_SPLITS = 1 << 20
#: Bytes of a file up to which one task reads it whole to hash it.
WHOLE_FILE = 64 << 20
#: Endings that Hadoop unpacks while reading text; such a file cannot be read in pieces.
PACKED = r"\.(gz|bz2|deflate|lz4|snappy|zst|passthrough)$"


def read_records(
    spark: SparkSession, paths: str | Sequence[str], separator: str
) -> DataFrame:
    """Rows (file, chunk, last_chunk, record): chunk counts the pieces of a file from 0.

    A light scan counts the pieces of each split; that table, a row a split,
    joins the text where it is read.
    """
    raw = (
        spark.read.option("lineSep", separator)
        .text(paths)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("_start"),
            F.monotonically_increasing_id().alias("_seq"),
            F.col("value").alias("record"),
        )
    )
    # ids run in order inside a split: the position is the distance from the split's first id
    splits = raw.groupBy("file", "_start").agg(F.count("*").alias("_n"), F.min("_seq").alias("_first"))
    whole = Window.partitionBy("file").orderBy("_start")
    placed = splits.select(
        "file", "_start", "_first",
        F.coalesce(F.sum("_n").over(whole.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        (F.sum("_n").over(Window.partitionBy("file")) - 1).alias("last_chunk"),
    )
    # a row a split: under a millionth of the text. Up to MOST_SPLITS rows, counted, it is sent to
    # where the text is read; Spark's own estimate of its size is that of the text
    placed = cut(placed)
    small = placed.count() <= MOST_SPLITS
    return raw.join(F.broadcast(placed) if small else placed, ["file", "_start"]).select(
        "file", (F.col("_before") + F.col("_seq") - F.col("_first")).alias("chunk"), "last_chunk", "record"
    )


def list_files(spark: SparkSession, pattern: str | Sequence[str]) -> DataFrame:
    """Recursive listing (path, directory, name, length); contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(pattern)
        .select(
            "path",
            F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("directory"),
            F.regexp_extract("path", r"([^/]*)$", 1).alias("name"),
            "length",
        )
    )


def completed_jobs(files: DataFrame, output_name: str) -> tuple[DataFrame, DataFrame]:
    """(usable job directories, findings) from a file listing.

    A job directory is usable if it holds the success marker and exactly one
    non-empty output. A table output is a directory of part files, so the job
    is the directory that holds the marker or the output.
    """
    per_dir = files.groupBy("directory").agg(
        F.expr(f"count_if(name = '{SUCCESS_MARKER}') > 0 as succeeded"),
        F.expr(f"count_if(name = '{output_name}') as outputs"),
        F.expr(f"min(if(name = '{output_name}', length, null)) as length"),
        F.expr(f"min(if(name = '{output_name}', path, null)) as path"),
    )
    fault = F.expr(
        "case when not succeeded then 'no success marker' "
        "when outputs <> 1 then 'needs exactly one output' "
        "when length = 0 then 'empty output' end"
    )
    judged = per_dir.withColumn("fault", fault)
    bad = judged.where("fault is not null").selectExpr(
        "'input.complete' as rule", "directory as subject", "fault as observed",
        "'one non-empty output and a success marker' as expected",
    )
    return judged.where("fault is null").select("directory", "path", "length"), bad


def require_inputs(usable: DataFrame, minimum: int = 2) -> None:
    """A merge needs at least two jobs."""
    if len(usable.select("directory").take(minimum)) < minimum:
        raise ValueError(f"at least {minimum} job-level inputs are required")


def content_fingerprints(spark: SparkSession, pattern: str | Sequence[str], *, whole: int = WHOLE_FILE) -> DataFrame:
    """SHA-256 per file (path, length, content_sha256), hashed where the file is read.

    Files of up to `whole` bytes are read by one task each. The digest of a
    longer one is taken piece by piece, see `chained_digests`. Packed files
    cannot be read in pieces; they are read by one task each (below 2 GB).
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(pattern)
    cut_up = (F.col("length") > whole) & ~F.col("path").rlike(PACKED)
    large = files.where(cut_up).select("path", "length").collect() if sha256.available() else []
    if not large:
        return files.select("path", "length", F.sha2("content", 256).alias("content_sha256"))
    # a bound on the length alone keeps the other files from being opened; packed ones are read by name
    packed = [_literal(r.path) for r in files.where(F.col("length") > whole).where(F.col("path").rlike(PACKED)).select("path").collect()]
    kept = files.where(F.col("length") <= whole)
    if packed:
        kept = kept.unionByName(spark.read.format("binaryFile").load(packed).select(*kept.columns))
    short = kept.select("path", "length", F.sha2("content", 256).alias("content_sha256"))
    digests = chained_digests(spark, {r.path: r.length for r in large})
    return short.unionByName(spark.createDataFrame([(r.path, r.length, digests[r.path]) for r in large], short.schema))


def chained_digests(spark: SparkSession, lengths: dict[str, int]) -> dict[str, str]:
    """SHA-256 of files (path -> length), each read split by split.

    A task hashes one split and hands on the running state, about a hundred
    bytes; a round takes the next split of every file. Splits are Spark's own
    (`spark.sql.files.maxPartitionBytes`), moved to line feeds: a run of bytes
    without any stays in one task. What the reader drops (line feeds, a byte
    order mark at the start) is put back, and the bytes are counted.
    """
    out: dict[str, str] = {}
    marked: set[str] = set()
    while todo := [p for p in lengths if p not in out]:
        text = {p: spark.read.option("lineSep", "\n").text(_literal(p)).select(F.col("value").cast("binary").alias("value")) for p in todo}
        splits = {p: df.rdd.getNumPartitions() for p, df in text.items()}
        heads = {p: b"\xef\xbb\xbf" if p in marked else b"" for p in todo}
        state = {p: (sha256.start(h), len(h), False) for p, h in heads.items()}
        for k in range(max(splits.values())):
            now = [p for p in todo if k < splits[p]]
            state.update(zip(now, _next_split(spark, [text[p].mapInArrow(_hasher(*state[p]), "state binary, size long, begun boolean") for p in now], k)))
        for p in todo:
            digest, size, _ = state[p]
            gap = lengths[p] - size
            if gap in (3, 4) and p not in marked:
                marked.add(p)
            elif gap in (0, 1):
                out[p] = sha256.finish(digest, b"\n" * gap)
            else:
                raise RuntimeError(f"{p}: {size} of {lengths[p]} bytes read")
    return out


def _literal(path: str) -> str:
    """A path whose characters stand for themselves."""
    return "".join(f"\\{c}" if c in "{}[]*?\\" else c for c in path)


def _hasher(state: bytes, size: int, begun: bool) -> Callable:
    """Takes the lines of one split into the state; every line but a file's first follows a line feed."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        now, n, on = state, size, begun
        for batch in batches:
            if batch.num_rows:
                chunk = b"\n".join(([b""] if on else []) + batch.column(0).to_pylist())
                now, n, on = sha256.update(now, [chunk]), n + len(chunk), True
        yield pa.RecordBatch.from_pydict({"state": pa.array([now], pa.binary()), "size": pa.array([n], pa.int64()), "begun": pa.array([on], pa.bool_())})

    return run


def _next_split(spark: SparkSession, hashed: list[DataFrame], k: int) -> list[tuple]:
    """The row of split k of each table, in order; no other split is read."""
    parts = [df.rdd for df in hashed]
    wanted, before = [], 0
    for part in parts:
        wanted.append(before + k)
        before += part.getNumPartitions()
    context = spark.sparkContext
    return [tuple(row) for row in context.runJob(context.union(parts), list, wanted)]


def changed_files(before: DataFrame, after: DataFrame) -> DataFrame:
    """Findings for inputs that appeared, vanished or changed between two readings."""
    a = before.select("path", F.col("content_sha256").alias("was"))
    b = after.select("path", F.col("content_sha256").alias("now"))
    return (
        a.join(b, "path", "full_outer")
        .where("not (was <=> now)")
        .selectExpr(
            "'input.unchanged' as rule", "path as subject",
            "coalesce(now, 'absent') as observed", "coalesce(was, 'absent') as expected",
        )
    )
