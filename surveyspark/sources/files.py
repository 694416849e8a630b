"""CSV scans, path resolution and writers.

Paths may be local, HDFS, S3 or any Hadoop file system: existence checks and renames go
through the Hadoop ``FileSystem`` of the session, never through driver-local ``os`` calls.
"""

from __future__ import annotations

import uuid

from pyspark.errors import UnsupportedOperationException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyspark.session import broadcast_if_small, reliable_checkpoint, scratch_path


def read_csv(spark: SparkSession, path: str | list[str], *, header: bool = True,
             schema: T.StructType | str | None = None, infer_schema: bool | None = None,
             quote: str | None = None, escape: str | None = None,
             multiline: bool | None = None, sep: str | None = None,
             sampling_ratio: float | None = None, null_value: str | None = None) -> DataFrame:
    """Scan CSV files (S1 quoted, S2 unquoted single-line, S3 default quoting).

    Give ``schema`` whenever it is known: inference costs an extra pass over the files.
    ``sampling_ratio`` bounds that pass on huge extracts (types are inferred from a sample).
    """
    reader = spark.read.option("header", str(header).lower())
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", "true" if infer_schema in (None, True) else "false")
        if sampling_ratio is not None:
            reader = reader.option("samplingRatio", str(sampling_ratio))
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    if quote is not None:
        reader = reader.option("quote", quote)
    if escape is not None:
        reader = reader.option("escape", escape)
    if multiline is not None:
        reader = reader.option("multiLine", str(multiline).lower())
    if sep is not None:
        reader = reader.option("sep", sep)
    return reader.csv(path)


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs_and_path(spark, path)
    return bool(fs.exists(jpath))


def resolve_source(spark: SparkSession, candidates: list[str], default: str | None = None) -> str:
    """First existing candidate path (glob patterns allowed) else ``default`` / first candidate."""
    for cand in candidates:
        fs, jpath = _fs_and_path(spark, cand)
        if any(ch in cand for ch in "*?["):
            matches = fs.globStatus(jpath)
            if matches is not None and len(matches) > 0:
                return str(sorted(m.getPath().toString() for m in matches)[0])
        elif fs.exists(jpath):
            return cand
    return default if default is not None else candidates[0]


#: Types that a text column can turn out to have, from narrow to wide, and the bit that stands for each.
TYPE_BITS = (("int", 1), ("bigint", 2), ("double", 4), ("timestamp", 8), ("boolean", 16))
#: The types of a value, by the first that fits it: a number is tried as a number only.
FITS = (("int", 1 | 2 | 4), ("bigint", 2 | 4), ("double", 4), ("timestamp", 8), ("boolean", 16))


def with_common_types(texts: DataFrame) -> DataFrame:
    """The text columns of ``texts`` in the narrowest type that fits all their values, in ONE pass over the source.

    The pass stores the texts as Parquet in the shared folder (columns can be pruned there, a CSV is parsed whole each
    time) and observes, per column, which types every value has: a bit for each, combined by AND. Casts come afterwards,
    on the stored texts. Give it the union of several extracts, and they get one common type: integers in one and decimals
    in another are doubles. Values are never lost: a column that fits no type stays text, as does one without values."""
    spark = texts.sparkSession
    every = sum(bit for _, bit in TYPE_BITS)
    masks = []
    for c in texts.columns:
        v = F.col(f"`{c}`")
        fits = F.when(v.isNull(), F.lit(every))
        for name, bits in FITS:
            fits = fits.when(v.try_cast(name).isNotNull(), F.lit(bits))
        masks.append(F.bit_and(fits.otherwise(F.lit(0))))
    observed = Observation(f"types-{uuid.uuid4().hex[:8]}")
    path = scratch_path(spark, "texts")
    texts.observe(observed, *[m.alias(f"m{i}") for i, m in enumerate(masks)],
                  *[F.count(f"`{c}`").alias(f"n{i}") for i, c in enumerate(texts.columns)]).write.parquet(path)
    seen = observed.get
    columns = []
    for i, c in enumerate(texts.columns):
        kinds = [name for name, bit in TYPE_BITS if seen[f"n{i}"] and seen[f"m{i}"] & bit]
        columns.append(F.col(f"`{c}`").cast(kinds[0]).alias(c) if kinds else F.col(f"`{c}`"))
    return spark.read.schema(texts.schema).parquet(path).select(*columns)


def write_csv(df: DataFrame, path: str, *, single_file: bool = False, header: bool = True,
              mode: str = "overwrite", quote_all: bool = False, escape: str = '"') -> str:
    """Write a CSV table with header.

    Default is one file per partition. ``single_file=True`` gives the one-file hand-over: the partitions are written in
    parallel as parts without a header, and the parts are joined behind a header in their order. The file system joins
    them where it can (``concat``); elsewhere their bytes are streamed into the file, a buffer at a time. Rows never meet
    in one task. Embedded quotes are doubled (RFC 4180, ``escape='"'``), which is what the quoted-extract reader expects.
    """
    opts = {"escape": escape}
    if quote_all:
        opts["quoteAll"] = "true"
    if not single_file:
        df.write.mode(mode).options(header=str(header).lower(), **opts).csv(path)
        return path
    spark = df.sparkSession
    tmp = f"{path.rstrip('/')}._parts-{uuid.uuid4().hex[:8]}"
    df.write.options(header="false", **opts).csv(f"{tmp}/rows")
    names = spark.createDataFrame([], df.schema).coalesce(1)  # no rows: a file with the header alone
    names.write.options(header=str(header).lower(), **opts).csv(f"{tmp}/names")
    fs, tmp_path = _fs_and_path(spark, tmp)
    _, dst = _fs_and_path(spark, path)
    if fs.exists(dst):
        fs.delete(dst, True)
    if dst.getParent() is not None and not fs.exists(dst.getParent()):
        fs.mkdirs(dst.getParent())
    head, rows = _parts(spark, f"{tmp}/names"), _parts(spark, f"{tmp}/rows")
    _join_files(spark, [*head, *rows], path)
    fs.delete(tmp_path, True)
    return path


def read_csv_file(spark: SparkSession, path: str, schema: str, sep: str = ",") -> DataFrame:
    """One CSV file with a header and line breaks inside quoted values, read by many tasks (``multiLine`` reads it by one).

    Spark reads the lines of each split of the file. A line starts a record if the quotes before it in the file are even
    in number (``write_csv`` doubles quotes inside values); the quotes of earlier splits come from a table with a row for
    each split. The lines of a record, which may lie in two splits, are joined, and each record is parsed alone."""
    raw = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_block_start").alias("_split"), F.monotonically_increasing_id().alias("_line"))
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    inside = Window.partitionBy("_split").orderBy("_line")
    lines = raw.withColumn("_q", quotes).withColumn("_odd", (F.sum("_q").over(inside) - F.col("_q")) % 2)
    ends = [F.max(F.when(F.col("_odd") == i, F.col("_line"))).alias(f"_end{i}") for i in (0, 1)]
    splits = lines.groupBy("_split").agg((F.sum("_q") % 2).alias("_sum"), F.min("_line").alias("_first"), *ends)
    before = Window.orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)  # a row for each split
    splits = splits.withColumn("_shift", F.coalesce(F.sum("_sum").over(before), F.lit(0)) % 2)
    splits = splits.withColumn("_open", F.last(F.when(F.col("_shift") == 0, F.col("_end0")).otherwise(F.col("_end1")), ignorenulls=True).over(before))
    splits = reliable_checkpoint(splits.withColumn("_head", F.min(F.struct("_split", "_first")).over(before)["_first"]).select("_split", "_shift", "_open", "_head", "_first"))
    started = F.last(F.when(F.col("_odd") == F.col("_shift"), F.col("_line")), ignorenulls=True).over(inside)
    placed = lines.join(broadcast_if_small(splits), "_split").withColumn("_record", F.coalesce(started, "_open"))
    placed = placed.filter(F.col("_record") != F.coalesce("_head", "_first"))  # the header
    joined = placed.groupBy("_record").agg(F.array_sort(F.collect_list(F.struct("_split", "_line", "value"))).alias("_lines"))
    record = F.array_join(F.col("_lines")["value"], "\n")
    return joined.select(record.alias("_text")).filter(F.col("_text") != "").select(F.from_csv("_text", schema, {"escape": '"', "sep": sep}).alias("_row")).select("_row.*")


def _parts(spark: SparkSession, folder: str) -> list[str]:
    """The non-empty part files of a written table, in the order of its partitions."""
    fs, path = _fs_and_path(spark, folder)
    files = [s for s in fs.listStatus(path) if s.getPath().getName().startswith("part-") and s.getLen() > 0]
    return sorted(s.getPath().toString() for s in files)


def _join_files(spark: SparkSession, parts: list[str], path: str) -> None:
    """``parts`` one after the other as the file ``path``: by the file system's own ``concat``, else by a streamed copy."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs, dst = _fs_and_path(spark, path)
    if len(parts) > 1:
        sources = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(parts) - 1)
        for i, part in enumerate(parts[1:]):
            sources[i] = jvm.org.apache.hadoop.fs.Path(part)
        first = jvm.org.apache.hadoop.fs.Path(parts[0])
        try:
            fs.concat(first, sources)
        except UnsupportedOperationException:  # most stores cannot; HDFS can
            pass
        else:
            fs.rename(first, dst)
            return
    out = fs.create(dst, True)
    try:
        for part in parts:
            source = fs.open(jvm.org.apache.hadoop.fs.Path(part))
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, conf, False)
            finally:
                source.close()
    finally:
        out.close()


def write_report(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> str:
    """Persist a report table (null rates, cluster profile, metrics, audit).

    ``fmt`` is parquet, json, csv or text (text needs a single string column).
    """
    w = df.write.mode(mode)
    if fmt == "parquet":
        w.parquet(path)
    elif fmt == "json":
        w.json(path)
    elif fmt == "csv":
        w.option("header", "true").csv(path)
    elif fmt == "text":
        w.text(path)
    else:
        raise ValueError(f"unknown report format {fmt!r}")
    return path


def read_report(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    if fmt == "csv":
        return spark.read.option("header", "true").option("inferSchema", "true").csv(path)
    return spark.read.format(fmt).load(path)
