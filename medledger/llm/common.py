"""What the operators share: tables, the shared folder, held-out rows, words, components of links."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words end at these characters: space and the control characters 9 to 13.
ASCII_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the one the cluster names in spark.checkpoint.dir.

    Only a local master, where one machine is the whole cluster, gets a temporary folder instead.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = _own.setdefault(context.applicationId, "") or "file://" + tempfile.mkdtemp(prefix="medledger-llm-")
        _own[context.applicationId] = folder
    return folder.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: computed once, and read again if an executor is lost."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold_of(id_col: Column | str, folds: int) -> Column:
    """crc32 of the id as text, modulo folds; a null id counts as the empty text."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % folds


def words_of(text: str | None) -> list[bytes]:
    """UTF-8 words of a text with A-Z in lower case; other letters keep their case."""
    return (text or "").encode().translate(ASCII_LOWER).split()


def word_slices(data: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words between spaces, from about `size` bytes at a time, so that a very long text is no long list."""
    at = 0
    while len(data) - at > size:
        cut = data.find(b" ", at + size)
        if cut < 0:
            break
        yield data[at:cut].split()
        at = cut
    yield data[at:].split() if at else data.split()


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(id, component_id) for each id of nodes: component_id is the smallest id reachable by links (a, b).

    Large-star and small-star rounds (Kiveris et al., 2014) on (high, low) pairs until nothing changes: a logarithmic
    number of rounds even for long chains, no neighbour list is ever collected, and a node with many links is only a
    key of an aggregation with map-side combine and of a join that adaptive execution can split. Each round is a
    written table. Null ids and links that name ids outside nodes are ignored.
    """
    spark = links.sparkSession
    pairs = written(_ordered(links.select(F.col("a").alias("u"), F.col("b").alias("v"))), "links")
    mark = None
    while True:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        larger = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = _ordered(larger)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        smaller = large.join(least, "u")
        small = _ordered(
            smaller.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        )
        pairs = written(small, "links")
        hashes = (F.bit_xor(F.xxhash64(*c)) for c in (("u", "v"), ("v", "u")))
        now = tuple(pairs.agg(F.count("*"), *hashes).first())
        if now == mark:
            break
        mark = now
    roots = pairs.groupBy("u").agg(F.min("v").alias("component_id")).withColumnRenamed("u", "id")
    return (
        nodes.filter("id is not null")
        .join(roots, "id", "left")
        .select("id", F.coalesce("component_id", "id").alias("component_id"))
    )


def _ordered(pairs: DataFrame) -> DataFrame:
    """Distinct pairs with u > v."""
    return (
        pairs.filter("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
