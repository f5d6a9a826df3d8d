"""Readers and writers of the pipeline's inputs and outputs."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RAW = "id string, url string, digest string, raw_content string, content string, type array<string>, xml_namespaces array<string>, date string, tstamp string, segment string, boost double, _version_ bigint"


def read_responses(spark: SparkSession, path: str, schema: str = RAW) -> DataFrame:
    """One JSON object per file, with a fixed schema: nothing is inferred."""
    return spark.read.schema(schema).json(path, multiLine=True).withColumn("source_file", F.col("_metadata.file_path"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole XML or RDF files (file, raw_content), undecodable bytes replaced."""
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), F.regexp_replace(F.make_valid_utf8(F.col("content").cast("string")), r"\\n", " ").alias("raw_content"))


def read_piped(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Pipe-separated text with a header; quotes are taken off."""
    r = spark.read.option("sep", "|").option("header", True).option("quote", '"')
    return (r.schema(schema) if schema else r).csv(path)


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    """One word a line; blank lines are dropped."""
    return spark.read.text(path).select(F.trim("value").alias("word")).where("word <> ''")


def lookup_by_digest(wanted: DataFrame, documents: DataFrame, digest: str = "digest") -> DataFrame:
    """The documents of a list of digests; what is not there is left out."""
    return wanted.join(documents, digest)


def read_table(spark: SparkSession, url: str, table: str, key: str | None = None, bounds: tuple[int, int] | None = None, partitions: int = 8, **options: str) -> DataFrame:
    """A relational table; with a numeric key it is read in parallel ranges."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if key and bounds:
        r = r.option("partitionColumn", key).option("lowerBound", str(bounds[0])).option("upperBound", str(bounds[1])).option("numPartitions", str(partitions))
    return r.load()


def write_table(df: DataFrame, url: str, table: str, mode: str = "append", **options: str) -> None:
    df.write.format("jdbc").option("url", url).option("dbtable", table).options(**options).mode(mode).save()


def upsert(current: DataFrame, changes: DataFrame, key: str, newest: str) -> DataFrame:
    """current with changes merged in: of each key the row that is newest."""
    both = current.unionByName(changes)
    best = both.groupBy(key).agg(F.max_by(F.struct(*both.columns), newest).alias("r"))
    return best.select("r.*")


def project_sample(df: DataFrame, fields: list[str], terms: dict[str, list[str]] | None = None, order: list[str] | None = None, start: int = 0, size: int | None = None) -> DataFrame:
    """A field list, any-of-these-terms conditions and a slice, as a sampling spec names them."""
    for c, words in (terms or {}).items():
        cond: Column = F.lit(False)
        for w in words:
            cond = cond | F.contains(F.col(c), F.lit(w))
        df = df.where(cond)
    out = df.orderBy(*(order or fields)) if size is not None else df
    out = out.select(*fields)
    if size is not None:
        out = out.offset(start).limit(size)
    return out


def write_lines(df: DataFrame, path: str, mode: str = "append") -> None:
    """JSON lines, appended."""
    df.write.mode(mode).json(path)


def write_n_triples(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    lines.select("value").write.mode(mode).text(path)


def write_scores(pairs: DataFrame, path: str, by: str, mode: str = "append", buckets: int | None = None) -> None:
    """score,id lines in a folder per document; with ``buckets`` document,score,id lines in so many folders, for any number of documents."""
    score = [F.round("score", 6).cast("string"), F.col("b").cast("string")]
    if buckets is None:
        pairs.select(by, F.concat_ws(",", *score).alias("value")).write.partitionBy(by).mode(mode).text(path)
    else:
        own = F.col(by).cast("string")
        pairs.select(F.pmod(F.xxhash64(own), F.lit(buckets)).alias("bucket"), F.concat_ws(",", own, *score).alias("value")).repartition(buckets, "bucket").write.partitionBy("bucket").mode(mode).text(path)


def not_done(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What has no result yet: for resuming."""
    return todo.join(done.select(key).distinct(), key, "left_anti")


def stage(spark: SparkSession, path: str, make: Callable[[], DataFrame]) -> DataFrame:
    """A task's output table: made if it is not there, read if it is."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def read_rules(*paths: str):
    """Identification rules from YAML files, in the order of the files."""
    from ..functions.rules import load_rules

    return load_rules(*[Path(p).read_text() for p in paths])


def metrics(df: DataFrame, name: str) -> DataFrame:
    """A log line for a stage: its name, rows and time."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("stage"), "n_rows", F.current_timestamp().alias("at"))
