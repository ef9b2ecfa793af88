"""Size-bounded JSON-lines export.

Part rule (W2): inside a chunk, rows in key order; a row belongs to part
``k`` when the bytes of the lines before it fall in ``[k·limit, (k+1)·limit)``
— a new part starts once the running size reached the limit, so a part
exceeds the limit by at most one line.  Sizes are uncompressed line bytes
(newline included); compressed sizes are checked on the written files.

The running byte sum is computed without a global sort (§4.3 recipe):

1. bucket edges are sampled rows (bounded sample); every edge's key also
   gets its own *point* bucket, and that of a key with several edges is cut at
   the line hashes and places of these, so one key, or one line, that a third
   of all rows hold still spreads over many tasks.  A bucket holds few parts,
   however small the limit: each of its rows is compared with their starts;
2. equal lines of a key are counted for each input task before anything is
   sorted: a line that a third of all rows hold is one row a task;
3. an exclusive scan in two levels: bytes of each (chunk, bucket, sub-bucket)
   give its offset, a window over the counted lines inside each adds theirs;
4. only a run of equal lines in which a part begins is numbered row by row,
   and there is at most one such run a part.

Rows are ordered by ``(key, xxhash64(line), place in the input)`` — a total
order that is stable under retries.
"""

from __future__ import annotations

import json
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanload.operators.clean import computed_once
from spanload.operators.order_stats import array_rank, bucket_search, rank_tree, typed_lit
from spanload.session import stage

# Above this many edges the bucket search is a binary search over a literal array
# instead of a CASE tree, whose generated code would grow too large.
TREE_MAX_EDGES = 63
PARTS_PER_BUCKET = 8
TASK_BYTES = 32 << 20  # lines that a writing task gets at least, where parts are smaller
MAX_BUCKETS, SAMPLED_PER_BUCKET = 1 << 15, 8  # bound the keys that reach the driver
TASK_BITS = 33  # of a row's place, below its input task


def line_bytes(line: str | Column) -> Column:
    """UTF-8 bytes of a line plus its newline."""
    c = F.col(line) if isinstance(line, str) else line
    return (F.octet_length(c) + 1).cast("bigint")


def bucket_of(k: Column, edges: list, dtype, point: bool = True) -> Column:
    if not edges:
        return F.lit(0)
    if len(edges) <= TREE_MAX_EDGES:
        return rank_tree(k, [typed_lit(e, dtype) for e in edges], point=point)
    return bucket_search(k, edges, dtype, point)


def row_hash(line: str | Column) -> Column:
    """Tie-break of the part order: a 64-bit hash of the line, then the row's place, so that
    equal rows differ.  Only to be used where the result is written before it is read."""
    return F.struct(F.xxhash64(F.col(line) if isinstance(line, str) else line).alias("h"),
                    F.monotonically_increasing_id().alias("u"))


def _bucketed(rows: DataFrame, key: str, dtype, n_rows: int, total_bytes: int,
              bucket_bytes: int, limit_bytes: int, sample_rows: int, seed: int) -> DataFrame:
    """Add bucket ``_b`` and, where one key has several edges, sub-bucket ``_s``."""
    share = min(bucket_bytes, PARTS_PER_BUCKET * limit_bytes)
    n_buckets = max(1, min(MAX_BUCKETS, -(-total_bytes // share)))
    by_key: dict = {}  # the edges: places in the order of key, line hash and place
    if n_buckets > 1 and n_rows:
        # Enough sampled rows to place every edge, however large the table is (edges only steer
        # the work).  Drawn row by row, so no part of the table counts more than another.
        want = max(min(sample_rows, SAMPLED_PER_BUCKET * MAX_BUCKETS), SAMPLED_PER_BUCKET * n_buckets)
        sample = sorted(tuple(r) for r in rows.select(key, "_h.h", "_h.u").where(F.col(key).isNotNull())
                        .sample(False, min(1.0, want / n_rows), seed).collect())
        for i in sorted({(i * len(sample)) // n_buckets for i in range(1, n_buckets)} if sample else ()):
            by_key.setdefault(sample[i][0], []).append(sample[i][1:])
    # behind barriers: the join's checks for nulls would search again, for each step of a search
    out = computed_once(rows.withColumn("_b", bucket_of(F.col(key), list(by_key), dtype, point=True)), ["_b"])
    subs = [hu if len(hu) > 1 else [] for hu in by_key.values()]
    if not any(subs):
        return out.withColumn("_s", F.lit(0))
    # one literal array, made from text: some hundred thousand edges are no expression each
    edges = F.from_json(F.lit(json.dumps([[{"h": h, "u": u} for h, u in hu] for hu in subs])),
                        "array<array<struct<h:bigint,u:bigint>>>")
    own = F.get(edges, F.shiftright("_b", 1))
    sub = array_rank(F.struct(F.col("_h.h").alias("h"), F.col("_h.u").alias("u")), own, F.size(own), max(map(len, subs)))
    return computed_once(out.withColumn("_s", F.when(F.col("_b") % 2 == 1, sub).otherwise(0)), ["_s"])


def assign_parts(df: DataFrame, key: str, line: str, limit_bytes: int,
                 chunk: str = "chunk", bucket_bytes: int = 128 << 20,
                 sample_rows: int = 20000, seed: int = 5,
                 n_rows: int | None = None, total_bytes: int | None = None) -> DataFrame:
    """W2 — add ``bytes`` and ``part`` (int) to rows that carry a chunk column.

    The running sums are worked out on narrow columns only (chunk, key, line
    hash, bytes, bucket), and on one row for each input task's equal lines; the
    lines are never shuffled for it.  The result is one row per bucket — the
    bucket's byte offset inside its chunk and the (few) part starts that fall
    inside it.  The lines get their part from that row by an equi-join on the
    bucket; Spark broadcasts it where it is small and shuffles it where not.
    The only other shuffle of whole lines is the one that writes the files.

    The input is read more than once: unless it comes with a written ``line_hash``
    (see :func:`row_hash`) it is staged here.  ``bytes`` and known totals are reused.
    """
    if limit_bytes <= 0:
        raise ValueError("limit_bytes must be positive")
    dtype = df.schema[key].dataType
    rows = df if "bytes" in df.columns else df.withColumn("bytes", line_bytes(line))
    if "line_hash" not in df.columns:
        rows = stage(rows.withColumn("line_hash", row_hash(line)), "lines")
    rows = rows.withColumn("_h", F.col("line_hash"))
    if n_rows is None or total_bytes is None:
        st = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("b")).first()
        n_rows, total_bytes = st["n"], st["b"] or 0
    rows = _bucketed(rows, key, dtype, n_rows, total_bytes, bucket_bytes, limit_bytes, sample_rows, seed)
    grp, lim = [chunk, "_b", "_s"], F.lit(limit_bytes)
    # read several times below: a row's bucket is searched for once, and runs are counted once
    narrow = stage(rows.select(*grp, F.col(key).alias("_k"), F.col("_h.h").alias("_x"), F.col("_h.u").alias("_u"), "bytes",
                               F.shiftright(F.col("_h.u"), TASK_BITS).alias("_t")), "narrow")
    same = [*grp, "_k", "_x", "_t"]  # equal lines of one input task
    runs = stage(narrow.groupBy(*same).agg(F.count(F.lit(1)).alias("_n"), F.first("bytes").alias("_w"),
                                           F.min("_u").alias("_u")), "runs")
    size = F.col("_n") * F.col("_w")
    offsets = (runs.groupBy(*grp).agg(F.sum(size).alias("_gb"))
               .withColumn("_off", F.coalesce(F.sum("_gb").over(
                   Window.partitionBy(chunk).orderBy("_b", "_s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    inner = Window.partitionBy(*grp).orderBy("_k", "_x", "_t").rowsBetween(Window.unboundedPreceding, -1)
    placed = (runs.withColumn("_pre", F.coalesce(F.sum(size).over(inner), F.lit(0)))
              .join(offsets.select(*grp, "_off"), grp)
              .withColumn("_at", F.col("_off") + F.col("_pre"))
              .withColumn("_p", F.floor(F.col("_at") / lim))
              .withColumn("_q", F.floor((F.col("_at") + (F.col("_n") - 1) * F.col("_w")) / lim)))
    # The first row of every part: of the least run in it, the least row ...
    first = placed.select(*grp, "_k", "_x", "_u", F.col("_p").alias("part"))
    # ... but where a part begins inside a run of equal lines, it is the run's row of that number.
    inside = (placed.where("_q > _p").withColumn("part", F.explode(F.sequence(F.col("_p") + 1, F.col("_q"))))
              .withColumn("_i", F.ceil((F.col("part") * lim - F.col("_at")) / F.col("_w")))
              .where(F.floor((F.col("_at") + F.col("_i") * F.col("_w")) / lim) == F.col("part"))
              .select(*same, "part", "_i"))
    cut = inside.select(*same).distinct()
    numbered = (narrow.join(cut, same, "left_semi")
                .withColumn("_i", F.row_number().over(Window.partitionBy(*same).orderBy("_u")) - 1))
    within = inside.join(numbered, [*same, "_i"]).select(*grp, "_k", "_x", "_u", "part")
    starts = (first.unionByName(within).groupBy(chunk, "part")
              .agg(F.min(F.struct("_k", "_x", "_u", "_b", "_s")).alias("s"))
              .select(chunk, F.col("s._b").alias("_b"), F.col("s._s").alias("_s"),
                      F.struct(F.col("s._k").alias("k"), F.struct(F.col("s._x").alias("h"), F.col("s._u").alias("u")).alias("h"),
                               F.col("part").alias("p")).alias("st")))
    table = (offsets.join(starts.groupBy(*grp).agg(F.collect_list("st").alias("_st")), grp, "left")
             .select(*grp, F.floor(F.col("_off") / lim).alias("_p0"), "_st"))
    k, h = F.col(key), F.col("_h")
    later = F.filter(F.coalesce(F.col("_st"), F.array().cast("array<struct<k:%s,h:struct<h:bigint,u:bigint>,p:bigint>>"
                                                           % dtype.simpleString())),
                     lambda s: (s["k"] < k) | ((s["k"] == k) & (s["h"] <= h)))
    part = F.greatest(F.col("_p0"), F.coalesce(F.array_max(F.transform(later, lambda s: s["p"])),
                                               F.col("_p0")))
    out = rows.join(table, grp).withColumn("part", part.cast("int"))
    return out.drop("_b", "_s", "_h", "_p0", "_st", "line_hash")


def part_report(parted: DataFrame, key: str, chunk: str = "chunk") -> DataFrame:
    """A5 — rows and bytes per (chunk, part), with key bounds."""
    return (parted.groupBy(chunk, "part")
            .agg(F.count(F.lit(1)).alias("rows"), F.sum("bytes").alias("bytes"),
                 F.min(key).alias("min_key"), F.max(key).alias("max_key")))


def writing_tasks(df: DataFrame, total_bytes: int, limit_bytes: int, chunks: int) -> int:
    """Tasks that write this many bytes of lines: as many as there are parts or, where these are
    small, as keep every core busy with ``TASK_BYTES`` or less; a task writes its parts one by one."""
    parts = total_bytes // limit_bytes + chunks
    return min(parts, max(df.sparkSession.sparkContext.defaultParallelism, total_bytes // TASK_BYTES))


def write_parts(parted: DataFrame, path: str, key: str, line: str = "line",
                chunk: str = "chunk", compression: str = "gzip",
                tasks: int | None = None, chunk_parts: list[int] | None = None) -> str:
    """W1/W3 — one gzip JSON-lines file per (chunk, part), rows in key order.

    Hash-repartitioning by ``(chunk, part)`` sends each part to exactly one
    task; with ``tasks`` (see :func:`writing_tasks`) a task holds about one part or
    some ``TASK_BYTES`` of small ones, however large the table.  With ``chunk_parts``, how
    many parts each chunk may have, they are dealt to the tasks in turn instead of
    by hash, which would give a task several large ones and others none.  ``partitionBy`` lays files out
    as ``chunk=c/part=p/``; the output committer makes the write
    all-or-nothing under task retries.
    """
    cols = [F.col(chunk), F.col("part")]
    if tasks and chunk_parts:
        before = F.get(F.array(*[F.lit(n) for n in accumulate(chunk_parts, initial=0)]), F.col(chunk))
        shuffled = parted.repartitionById(tasks, (before + F.col("part")).cast("int"))
    else:
        shuffled = parted.repartition(tasks, *cols) if tasks else parted.repartition(*cols)
    (shuffled
     .sortWithinPartitions(chunk, "part", key, line)
     .select(chunk, "part", line)
     .write.mode("overwrite").option("compression", compression)
     .partitionBy(chunk, "part").text(path))
    return path


def read_lines(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """S5 — every JSON-lines file under a folder; with a schema, unknown fields ignored."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Compressed size of every written part file (metadata only, no content read)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.gz").load(path).select("path", "length"))
    return files.select(
        F.regexp_extract("path", r"chunk=(\d+)", 1).cast("int").alias("chunk"),
        F.regexp_extract("path", r"part=(\d+)", 1).cast("int").alias("part"),
        F.col("length").alias("file_bytes"))


def write_sorted(df: DataFrame, path: str, keys: list[str], partitions: int | None = None) -> DataFrame:
    """O1 — write rows in one total order; returns the files in that order.

    Rows are dealt by ranges of ``keys`` and then of a hash and the place of the row, so that rows
    of one key value, or equal rows, that are many go to several files.  Nulls come
    first.  The result, one row a file: ``file, rows, before`` (rows in the files before it)
    and ``first, last`` (structs of the keys).
    """
    order = [*keys, "_tie", "_place"]
    tied = stage(df.withColumn("_tie", F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)]))
                 .withColumn("_place", F.monotonically_increasing_id()), "unsorted")
    parts = tied.repartitionByRange(partitions, *order) if partitions else tied.repartitionByRange(*order)
    parts.sortWithinPartitions(*order).drop("_tie", "_place").write.parquet(path)
    bounds = F.struct(*[F.col(f"`{k}`") for k in keys])
    files = (df.sparkSession.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("file"))
             .agg(F.count(F.lit(1)).alias("rows"), F.min(bounds).alias("first"), F.max(bounds).alias("last")))
    # part-00000-..., part-00001-...: the writer numbers files by range
    upto = Window.partitionBy(F.lit(0)).orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # over the files alone
    return files.withColumn("before", F.coalesce(F.sum("rows").over(upto), F.lit(0)))
