"""Reading and writing of source tables, id lists and pair tables."""

from __future__ import annotations

import tempfile
import uuid
import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from kinsift import schema


def missing_to_null(column: Column) -> Column:
    return F.when(column.isin(*schema.NA_VALUES), None).otherwise(column)


def has_line_breaks(spark: SparkSession, path: str) -> bool:
    """Whether a quoted field may go on in the next line: only then some line has an odd number of quotes."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    return not spark.read.text(path).filter(quotes % 2 == 1).isEmpty()


def read_source(spark: SparkSession, path: str, columns: list[str] | None = None, line_breaks: bool | None = None) -> DataFrame:
    """A tab-separated source table, all text; texts that count as missing are null. `columns` prunes the scan.

    A file is read in splits, or whole by one task if fields hold line breaks (None: looked up in a scan of lines).
    """
    if line_breaks is None:
        line_breaks = has_line_breaks(spark, path)
    rows = spark.read.schema(schema.SOURCE).csv(path, sep="\t", header=True, quote='"', escape='"', multiLine=line_breaks)
    return rows.select([missing_to_null(F.col(c)).alias(c) for c in columns or rows.columns])


def load_sources(spark: SparkSession, folder: str, prefix: str, kind: str = "parquet") -> list[DataFrame]:
    """The three normalized sources of a prefix."""
    paths = [f"{folder}/{prefix}_source{i}_norm" for i in (1, 2, 3)]
    return [spark.read.parquet(p) if kind == "parquet" else read_source(spark, p + ".tsv") for p in paths]


def union_pool(*sources: DataFrame) -> DataFrame:
    """Sources 2, 3, ... as one pool, tagged with where rows come from."""
    tagged = [s.withColumn("source", F.lit(f"S{i}")) for i, s in enumerate(sources, 2)]
    pool = tagged[0]
    for t in tagged[1:]:
        pool = pool.unionByName(t, allowMissingColumns=True)
    return pool


def sample(rows: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """Exactly n rows (all, if there are fewer), those whose seeded hash comes first."""
    return rows.orderBy(seeded(F.col(schema.ID), seed), schema.ID).limit(n)


def seeded(key: Column, seed: int) -> Column:
    """A hash of a key and a seed, in hexadecimal digits."""
    return F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")).cast("binary"))


def read_id_lists(spark: SparkSession, path: str) -> DataFrame:
    """(s1_id, ids array) of a two-column list file, or a folder of such files with a header each.

    Of lines with one id the last stands (files in order of name); items aren't trimmed.
    """
    rows = spark.read.schema("id string, list string").csv(path, sep="\t", header=True, quote='"', escape='"')
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("at")).alias("place")
    cells = rows.select(F.trim(F.coalesce("id", F.lit(""))).alias("s1_id"), F.trim(F.coalesce("list", F.lit(""))).alias("raw"), place)
    last = cells.groupBy("s1_id").agg(F.max_by("raw", "place").alias("raw"))
    return last.select("s1_id", F.when(F.col("raw") == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.split("raw", ","))).alias("ids"))


def pairs_of(lists: DataFrame) -> DataFrame:
    """(s1_id, cand_id): the long form of id lists; empty lists have no row."""
    return lists.select("s1_id", F.explode("ids").alias("cand_id"))


def lists_of(pairs: DataFrame, entities: DataFrame) -> DataFrame:
    """(s1_id, ids): for every entity the sorted ids of its pairs, empty if none."""
    grouped = pairs.groupBy("s1_id").agg(F.array_sort(F.collect_set("cand_id")).alias("ids"))
    return entities.select("s1_id").distinct().join(grouped, "s1_id", "left").withColumn("ids", F.coalesce("ids", F.array().cast("array<string>")))


def lines_of(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """(value): the lines of a file, or of each file of a folder, without empty ones and headers."""
    return spark.read.schema("value string").csv(path, sep="\x01", quote="", header=header).filter(F.col("value").isNotNull())


def read_ids(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """The distinct first tab-separated fields of the lines that aren't blank."""
    lines = lines_of(spark, path, header).filter("trim(value) <> ''")
    return lines.select(F.trim(F.get(F.split("value", "\t"), F.lit(0))).alias("id")).distinct()


def match_targets(spark: SparkSession, folder: str) -> DataFrame | None:
    """The ids of sources 2 and 3; with a file missing, a warning and None."""
    paths = [f"{folder}/test_source{i}.tsv" for i in (2, 3)]
    gone = [p for p in paths if not exists(spark, p)]
    if gone:
        warnings.warn(f"ids of matches can't be checked without {', '.join(gone)}", stacklevel=2)
        return None
    return read_ids(spark, paths[0]).union(read_ids(spark, paths[1])).distinct()


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def count_physical(spark: SparkSession, path: str) -> int:
    """Lines without the header; a quoted field with line breaks counts as several."""
    return spark.read.text(path).count() - 1


def scan_patterns(rows: DataFrame, column: str, patterns: dict[str, str]) -> DataFrame:
    """(pattern, n, pct, total): how many rows each regular expression is found in; one pass."""
    counts = [F.count_if(F.col(column).rlike(p)).alias(k) for k, p in patterns.items()]
    one = rows.agg(F.count("*").alias("total"), *counts)
    stacked = F.explode(F.array(*[F.struct(F.lit(k).alias("pattern"), F.col(k).alias("n")) for k in patterns]))
    return one.select("total", stacked.alias("s")).select("s.pattern", "s.n", F.round(F.when(F.col("total") > 0, 100 * F.col("s.n") / F.col("total")), 4).alias("pct"), "total")


def quoted(c: Column) -> Column:
    """A field of a tab-separated line, in quotes where it must be."""
    return F.when(c.rlike('[\t"\r\n]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)


def id_list_lines(lists: DataFrame, header: tuple[str, str] | None = None) -> DataFrame:
    """One column, the lines of a list file in order of id; the header, if asked for, is the first."""
    rows = lists.select("s1_id", F.array_join(F.array_sort("ids"), ",").alias("joined"))
    lines = rows.select(F.lit(1).alias("_part"), "s1_id", F.concat_ws("\t", quoted(F.col("s1_id")), quoted(F.col("joined"))).alias("value"))
    if header:
        head = lists.sparkSession.createDataFrame([(0, "", "\t".join(header))], "_part int, s1_id string, value string")
        lines = lines.unionByName(head)
    return lines.orderBy("_part", "s1_id").select("value")


def write_id_lists(lists: DataFrame, path: str, header: tuple[str, str] = schema.TRUTH_HEADER, ends: str = "\r\n") -> None:
    """Writes one list file in order of id, with a header; lines end in CR LF unless told otherwise."""
    write_lines(id_list_lines(lists), path, "\t".join(header), ends)


def write_lines(lines: DataFrame, path: str, header: str | None = None, ends: str = "\n", last: bool = True) -> None:
    """Writes the one column of a sorted table to a single file; last: whether the last line is ended too.

    Part files are written by all tasks and then joined by the file system's streams, so the driver holds none of them.
    """
    spark = lines.sparkSession
    parts = f"{path}.{uuid.uuid4().hex}"
    lines.write.option("lineSep", ends).text(parts)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(conf)
    files = sorted((f.getPath().getName(), f.getLen()) for f in system.listStatus(jvm.org.apache.hadoop.fs.Path(parts)) if f.getPath().getName().startswith("part-") and f.getLen())
    out = system.create(place, True)
    try:
        if header is not None:
            out.write(bytearray((header + (ends if last or files else "")).encode()))
        for i, (name, size) in enumerate(files):
            stream = system.open(jvm.org.apache.hadoop.fs.Path(f"{parts}/{name}"))
            cut = len(ends) if i == len(files) - 1 and not last else 0
            limited = jvm.org.apache.commons.io.input.BoundedInputStream(stream, size - cut)
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(limited, out, 1 << 16, False)
            stream.close()
    finally:
        out.close()
        system.delete(jvm.org.apache.hadoop.fs.Path(parts), True)


def write_normalized(rows: DataFrame, path: str, tsv: bool = False) -> None:
    """Parquet by country, or a tab-separated export with True/False and empty cells for null."""
    if tsv:
        flat = [F.initcap(F.col(c).cast("string")).alias(c) if t == "boolean" else F.col(c) for c, t in rows.dtypes]
        exact = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        rows.select(flat).write.mode("overwrite").csv(path, sep="\t", header=True, nullValue="", emptyValue="", **exact)
    else:
        rows.write.mode("overwrite").partitionBy(schema.COUNTRY).parquet(path)


def shared_folder(spark: SparkSession) -> str:
    """A new folder for files of this session, below the folder that all executors share (spark.checkpoint.dir).

    Only a local session may go without that setting.  The folder goes when the driver's JVM ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = f"file://{tempfile.gettempdir()}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/kinsift-files-{uuid.uuid4().hex}")
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(path)
    system.deleteOnExit(path)
    return path.toString()


def require(spark: SparkSession, *paths: str) -> None:
    """Raises if an input is missing."""
    gone = [p for p in paths if not exists(spark, p)]
    if gone:
        raise AnalysisException(f"missing input: {', '.join(gone)}")


def markdown(rows: DataFrame) -> str:
    """A small report as a Markdown table."""
    lines = ["| " + " | ".join(rows.columns) + " |", "|" + "---|" * len(rows.columns)]
    return "\n".join(lines + ["| " + " | ".join(str(v) for v in r) + " |" for r in rows.toLocalIterator()])


def text_report(rows: DataFrame, title: str = "") -> str:
    """A small table as lines of aligned columns, numbers with separators."""
    show = lambda v: f"{v:,}" if isinstance(v, int) and not isinstance(v, bool) else f"{v:.4f}" if isinstance(v, float) else str(v)
    cells = [list(rows.columns), *([show(v) for v in r] for r in rows.toLocalIterator())]
    widths = [max(len(r[i]) for r in cells) for i in range(len(rows.columns))]
    lines = ["  ".join(c.ljust(w) for c, w in zip(r, widths, strict=True)).rstrip() for r in cells]
    return "\n".join([*([title] if title else []), *lines])


def write_features(features: DataFrame, folder: str, part: str) -> None:
    """Stores a feature matrix (part: train or val) as compressed Parquet, with 32-bit numbers."""
    columns = [F.col(c).cast("float").alias(c) if t in ("double", "float") or t.startswith("decimal") else F.col(c) for c, t in features.dtypes]
    features.select(columns).write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/{part}_features.parquet")


def read_features(spark: SparkSession, folder: str, part: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{part}_features.parquet")
