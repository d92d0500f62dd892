"""JSON documents as rows: total reads, canonical writes, manifests, integrity, pruning."""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Config:
    """Where to read and write, and a fixed time if there is one; reads and writes may differ."""

    read_dir: str
    write_dir: str | None = None
    now: str | None = None

    @property
    def out(self) -> str:
        return self.write_dir or self.read_dir

    def timestamp(self) -> str:
        """ISO time of the run; the same text in every row, never the time of a task."""
        return self.now or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop))


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """(file, id, status, text, sha256) of the .json files of a folder, or of one file.

    ``status`` is ``ok`` or ``invalid_json``; a path that is not there gives one row
    ``missing_input``. The id is the file's name without its ending. Files whose
    name begins with an underscore are about the folder and are left out of one.
    """
    if not _exists(spark, path):
        return spark.createDataFrame([(path, None, "missing_input", None, None)], "file string, id string, status string, text string, sha256 string")
    read = spark.read.option("wholetext", True)
    if not path.endswith(".json"):
        read = read.option("pathGlobFilter", "[!_]*.json")
    files = read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))
    status = F.when(F.try_parse_json("text").isNull(), "invalid_json").otherwise("ok")
    name = F.regexp_extract("file", r"([^/]+)\.json$", 1)
    return files.select("file", name.alias("id"), status.alias("status"), "text", F.sha2("text", 256).alias("sha256"))


def require(documents: DataFrame) -> DataFrame:
    """The documents, or an error that names what is missing or unreadable."""
    bad = documents.where("status <> 'ok'").select("file", "status").limit(20).collect()  # for the message only
    if bad:
        raise ValueError("; ".join(f"{r['file']}: {r['status']}" for r in bad))
    return documents


def canonical(text: Column) -> Column:
    """JSON text with sorted keys at all depths and no spaces; null if it is no JSON."""
    return F.to_json(F.try_parse_json(text))


def write_documents(documents: DataFrame, path: str, *, id: str = "id", text: str = "text", stamp: str | None = None) -> None:
    """One folder of canonical JSON lines per id, with the scope stamp beside it."""
    rows = documents.select(F.col(id).alias("id"), canonical(F.col(text)).alias("value"))
    if stamp is not None:
        rows = rows.withColumn("tier_scope", F.lit(stamp))
    rows.write.mode("overwrite").partitionBy("id").json(path)


def manifest(documents: DataFrame, *, version: str, at: str) -> DataFrame:
    """One row about an output: version, time, number of documents, hash over their hashes.

    The hash is of the sum of the leading 60 bits of the documents' own SHA-256 hashes (with their ids) and of their number: sums
    merge, so no task holds all of them, and their order does not matter.
    """
    part = F.conv(F.substring(F.sha2(F.concat_ws(":", "id", F.sha2(canonical(F.col("text")), 256)), 256), 1, 15), 16, 10).cast("decimal(38,0)")
    return documents.agg(
        F.lit(version).alias("ccxt_version"), F.lit(at).alias("extracted_at"), F.count("*").alias("count"),
        F.sha2(F.concat_ws(":", F.count("*").cast("string"), F.coalesce(F.sum(part), F.lit(0)).cast("string")), 256).alias("content_hash"),
    )


def manifest_ids(documents: DataFrame) -> DataFrame:
    """The ids of an output, a row each."""
    return documents.select("id").distinct()


def check_version(recorded: str | None, actual: str) -> str:
    """``skip`` without a baseline, ``ok`` if they agree, ``drift`` if not; a malformed baseline raises."""
    if recorded is None:
        return "skip"
    if not recorded or any(c not in "0123456789abcdef" for c in recorded.lower()):
        raise ValueError(f"malformed baseline {recorded!r}")
    return "ok" if recorded.lower() == actual.lower() else "drift"


@dataclass
class Pruned:
    removed: list[str] = field(default_factory=list)
    kept: list[str] = field(default_factory=list)


def prune(folder: str, scope: Sequence[str], *, preserve: Sequence[str] = (), dry_run: bool = True) -> Pruned:
    """Remove .json files whose id is not in scope; names with an underscore, preserved ones and other endings stay.

    A clean-up of a local output folder by the user, not a step of a query.
    """
    out, keep = Pruned(), {*scope, *preserve}
    for name in sorted(os.listdir(folder)):
        stem, ending = os.path.splitext(name)
        if ending != ".json" or name.startswith("_") or stem in keep:
            out.kept.append(name)
            continue
        out.removed.append(name)
        if not dry_run:
            os.remove(os.path.join(folder, name))
    return out


def load_datasets(spark: SparkSession, root: str, names: Sequence[str], universe: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """Datasets as documents by name, and integrity rows (dataset, id, status).

    ``missing`` for ids of the universe without a document, ``orphan`` for documents
    outside it (which are loaded all the same), ``corrupt`` for unreadable ones.
    """
    sets, rows = {}, None
    for n in names:
        docs = read_json(spark, f"{root}/{n}")
        sets[n] = docs.where("status = 'ok'")
        known = docs.where("id is not null").select("id", "status")
        j = universe.select("id", F.lit(True).alias("u")).join(known, "id", "full")
        status = F.when(F.col("status").isNull(), "missing").when(F.col("status") != "ok", "corrupt").when(F.col("u").isNull(), "orphan").otherwise("ok")
        part = j.select(F.lit(n).alias("dataset"), "id", status.alias("status"))
        rows = part if rows is None else rows.unionByName(part)
    return sets, rows
