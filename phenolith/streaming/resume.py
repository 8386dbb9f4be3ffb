"""Resumable mining: new article files are mined once, results are appended."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.mining import Options, mine


def config_hash(o: Options) -> str:
    """Names a run's options, so that results of other options are not replayed."""
    return hashlib.sha256(json.dumps(asdict(o), sort_keys=True, default=str).encode()).hexdigest()[:16]


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def import_cache(spark: SparkSession, path: str) -> DataFrame:
    """A cache file of finished articles, one JSON object {pmid: [evidence row, ...]} -> (pmid, rows): rows is empty for an article without a result. A file that does not parse is an empty cache."""
    lists = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,array<map<string,string>>>").alias("m")).where("m is not null")
    return lists.select(F.explode("m").alias("pmid", "rows"))


def mine_new_files(spark: SparkSession, folder: str, schema: str, o: Options, out: str, checkpoint: str, files_per_batch: int = 1000) -> None:
    """Mine the Parquet article files that are new since the last call with these options.

    Each micro-batch overwrites its own folder of the output, so one that runs again after a failure
    leaves the same rows; the checkpoint remembers which files are done, articles without a result included.
    An article counts once: of a batch its smallest row, and none that an earlier batch has mined. All
    articles of the years asked for are mined, whatever max_articles says.
    """
    own = config_hash(o)
    done = f"{checkpoint}/{own}-pmids"
    articles = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)

    def write(batch: DataFrame, number: int) -> None:
        first = batch.groupBy("pmid").agg(F.min(F.struct(*(c for c in batch.columns if c != "pmid"))).alias("row")).select("pmid", "row.*").select(*batch.columns)
        if _exists(spark, done):  # a folder of pmids for each batch
            earlier = spark.read.schema("pmid string, batch int").parquet(done).where(F.col("batch") < number)
            first = first.join(earlier, "pmid", "left_anti")
        rows = mine(first, replace(o, max_articles=None)).withColumn("config_hash", F.lit(own))
        rows.write.mode("overwrite").parquet(f"{out}/config={own}/batch={number}")
        first.select(F.col("pmid").cast("string")).write.mode("overwrite").parquet(f"{done}/batch={number}")

    query = articles.writeStream.foreachBatch(write).option("checkpointLocation", f"{checkpoint}/{own}").trigger(availableNow=True).start()
    query.awaitTermination()
