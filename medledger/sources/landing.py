"""CSV landing files to raw text tables, with an audit and a reconciliation."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from medledger.sources.lake import KIND, LOADED, Lake
from medledger.sources.records import TOO_LONG, WHOLE, cut_blocks, lines_of, look_at_blocks, stitched
from medledger.sources.schemas import RAW_COLUMNS, RAW_TABLES, raw_schema

#: What the last load of a lake's raw tables counted, stored beside them.
AUDIT = "_ingest_audit"

#: Partitions beside the loaded rows of a landed table: rows that cannot be read, and pieces of records that cross from
#: block to block of a file.
REFUSED, PIECE = "refused", "piece"


def read_text_csv(spark: SparkSession, path: str, table: str, multi_line: bool = False) -> DataFrame:
    """Every column as text. Spark reads an unquoted empty field as NULL, so it is put back to ''.

    A row with more or fewer fields than the header stops the load. Without ``multi_line`` files are split
    among tasks, and a quoted line break is such a row; with it fields may hold line breaks, and a file is
    read by one task.
    """
    return (
        spark.read.schema(raw_schema(table))
        .option("header", True)
        .option("enforceSchema", False)  # the header row must name the expected columns
        .option("escape", '"')  # a doubled quote is one quote
        .option("multiLine", multi_line)
        .option("mode", "FAILFAST")
        .csv(path)
        .na.fill("")
    )


def write_text_csv(df: DataFrame, path: str, packed_by: str = "none") -> None:
    """A folder of landing files, one per task; ``packed_by`` gzip they take a fifth of the disk, and each is read by one task."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .option("emptyValue", "").option("compression", packed_by).csv(path))


class MalformedRows(RuntimeError):
    """Rows of a landing file that cannot be read, when the load was told to stop on them."""


class WrongHeader(ValueError):
    """A landing file does not begin with the expected column names."""


def _parsed(records: DataFrame, table: str) -> DataFrame:
    """The columns of each record as text; ``refused`` holds the record and ``reason`` says why if it has more or fewer
    fields, or a reason already. Parsing is Spark's own, in generated code."""
    fields = f"{raw_schema(table).simpleString()[7:-1]},refused:string".replace(":", " ")
    text = F.when(F.col("record").endswith("\r"), F.expr("left(record, length(record) - 1)")).otherwise(F.col("record"))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "refused", "escape": '"', "multiLine": "true"}
    read = records.select("reason", text.alias("record")).filter(F.trim("record") != "")
    read = read.select("reason", "record", F.from_csv("record", F.lit(fields), options).alias("x"))
    reason = F.coalesce("reason", F.when(F.col("x.refused").isNotNull(), F.lit("number of fields")))
    bad = F.col("why").isNotNull()
    return read.withColumn("why", reason).select(
        *[F.when(~bad, F.coalesce(F.col(f"x.{c}"), F.lit(""))).alias(c) for c in RAW_COLUMNS[table]],
        F.when(bad, F.col("record")).alias("refused"), F.col("why").alias("reason"),
        F.when(bad, F.lit(REFUSED)).otherwise(F.lit(LOADED)).alias(KIND))


def _land(lake: Lake, rows: DataFrame, table: str, path: str, mode: str) -> dict[str, int]:
    """Write rows by kind, without the header rows, and count them on the way."""
    header = F.lit(True)
    for c in RAW_COLUMNS[table]:
        header = header & (F.col(c) == c)
    header = F.coalesce(header, F.lit(False))
    seen = Observation()
    counted = rows.withColumn("_header", header).observe(
        seen, F.count_if("_header").alias("headers"),
        F.count_if((F.col(KIND) == LOADED) & ~F.col("_header")).alias("loaded"),
        F.count_if(F.col(KIND) == REFUSED).alias("refused"), F.count_if(F.col(KIND) == PIECE).alias("pieces"))
    with lake.writing():
        (counted.filter("NOT _header").drop("_header").write.mode(mode).option("partitionOverwriteMode", "static")
                .partitionBy(KIND).parquet(path))
    return {k: seen.get[k] for k in ("headers", "loaded", "refused", "pieces")}


def ingest_table(lake: Lake, landing_dir: str, table: str, on_malformed: str = "stop",
                 longest: int = 16 << 20) -> dict[str, int]:
    """Load one table's file or folder of files, replacing the stored one; returns what was counted in the same pass.

    Fields may hold line breaks, and files are split among tasks all the same (``records``). A record with more or fewer
    fields than columns, with a quote that nothing closes, or of over ``longest`` bytes is refused: it is stored beside
    the table (``refused_rows``), and then ``on_malformed`` says whether the load stops ("stop") or goes on ("keep").
    Blank lines are no rows. A quote inside a field must be doubled and the field quoted; a file that does otherwise has
    no certain record borders. A header that names other columns stops the load.
    """
    if on_malformed not in ("stop", "keep"):
        raise ValueError(f"on_malformed is 'stop' or 'keep', not {on_malformed!r}")
    spark, path, target = lake.spark, f"{landing_dir}/{table}.csv", lake.path("raw", table)
    try:
        lines = lines_of(spark, path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no landing file for {table}: {path}") from e
    blocks = look_at_blocks(lines)
    parts = cut_blocks(lines, blocks, longest)
    reason = F.when((F.col("part") == TOO_LONG) | (F.octet_length("record") > longest), F.lit("too long"))
    rows = _parsed(parts.filter(F.col("part").isin(WHOLE, TOO_LONG)).select("record", reason.alias("reason")), table)
    if blocks.broken:  # pieces of records go with the same write, into a partition of their own
        pieces = parts.filter(~F.col("part").isin(WHOLE, TOO_LONG)).select(
            F.to_json(F.struct("file", "block", "part", "cut", "record")).alias("refused"), F.lit(PIECE).alias(KIND))
        rows = rows.unionByName(pieces, allowMissingColumns=True)
    counts = _land(lake, rows, table, target, "overwrite")
    if counts["pieces"]:
        stored = spark.read.parquet(target).filter(F.col(KIND) == PIECE)
        piece = F.from_json("refused", "file string, block long, part int, cut boolean, record string").alias("p")
        again = _land(lake, _parsed(stitched(stored.select(piece).select("p.*"), longest), table), table, target, "append")
        counts = {k: counts[k] + again[k] for k in ("headers", "loaded", "refused")}
    counts = {"files": blocks.files, **{k: counts[k] for k in ("headers", "loaded", "refused")}}
    if counts["headers"] != counts["files"]:
        raise WrongHeader(f"{path}: {counts['headers']} headers with the columns of {table} in {counts['files']} files")
    if not counts["loaded"]:  # a table without rows still has columns
        spark.createDataFrame([], raw_schema(table)).write.mode("append").parquet(f"{target}/{KIND}={LOADED}")
    if counts["refused"] and on_malformed == "stop":
        raise MalformedRows(f"{counts['refused']} rows of {path} cannot be read")
    return counts


def refused_rows(lake: Lake, table: str) -> DataFrame:
    """(table_name, record, reason): the rows of the last load that could not be read."""
    stored = lake.spark.read.schema(f"refused string, reason string, {KIND} string").parquet(lake.path("raw", table))
    return stored.filter(F.col(KIND) == REFUSED).select(
        F.lit(table).alias("table_name"), F.col("refused").alias("record"), "reason")


def ingest_all(lake: Lake, landing_dir: str, on_malformed: str = "stop", longest: int = 16 << 20) -> DataFrame:
    """Load all eight tables and return the audit: one row per table, its counts from the pass that wrote it."""
    counts = [(t, *ingest_table(lake, landing_dir, t, on_malformed, longest).values()) for t in RAW_TABLES]
    audit = lake.spark.createDataFrame(
        [(t, loaded + refused, loaded, refused) for t, _, _, loaded, refused in counts],
        "table_name string, rows_read long, row_count long, rows_refused long")
    return lake.replace("raw", AUDIT, audit.withColumn("loaded_at", F.current_timestamp()))


def count_rows(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")


def union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def ingest_audit(lake: Lake) -> DataFrame:
    """Counts of the stored tables; Parquet answers them from footers, without reading data."""
    rows = union_all([count_rows(lake.read("raw", t), t) for t in RAW_TABLES])
    return rows.withColumn("loaded_at", F.current_timestamp())


def reconcile(source: dict[str, DataFrame], stored: dict[str, DataFrame]) -> DataFrame:
    """Rows at the source against rows stored, per table."""
    a = union_all([count_rows(df, t) for t, df in source.items()])
    b = union_all([count_rows(df, t) for t, df in stored.items()])
    s, t = F.col("source_rows"), F.col("stored_rows")
    return (
        a.withColumnRenamed("row_count", "source_rows")
        .join(b.withColumnRenamed("row_count", "stored_rows"), "table_name", "full")
        .withColumn("matches", F.coalesce(s == t, F.lit(False)))
    )
