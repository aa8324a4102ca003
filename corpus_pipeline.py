"""From raw documents to packed training sequences in five stages, each written and read again.

Quality, toxicity, exact copies and near copies take documents away; the last stage packs what is left. Each
function takes (spark, docs, sf_dir); all but the last return the columns of documents. SQL can't express the
classifiers, so ORACLE_SQL is None; the tests hold the two stages of copies against brute force, packing against the
library's ids and the bound, and the classifiers against plain Python and labels.

Odd rows: a null text counts as empty in every stage and is packed as the end token alone; rows with null ids are documents
like others, told apart by their texts; of repeated rows and of each group of equal or near texts one stays; other columns pass
through all stages but the last, whatever their names; empty tables give empty ones.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from recordwatch.llm import exact_dedup, packing, quality, simhash_dedup, toxicity
from recordwatch.llm.common import complete, shared_folder, table
from recordwatch.llm.queries import tokenizer_path


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.drop_poor(docs, table(spark, sf_dir, "labels"))


def civil_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def different_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def dissimilar_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_dedup.drop_near_copies(docs)


def packed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_documents),
    ("toxicity", civil_documents),
    ("exact_dedup", different_documents),
    ("near_dedup", dissimilar_documents),
    ("packing", packed_documents),
]

ORACLE_SQL = None


def _made_of(spark: SparkSession, sf_dir: str) -> str:
    """A hash of what a run depends on: the files of its tables by name, size and time, the tokenizer and the thresholds."""
    parts = [tokenizer_path(), repr((quality.KEEP_FROM, toxicity.THRESHOLD, packing.CAPACITY, packing.END_ID)), *(name for name, _ in STAGES)]
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    for name in ("documents", "labels"):
        for file in sorted(table(spark, sf_dir, name).inputFiles()):
            path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(file))
            status = path.getFileSystem(conf).getFileStatus(path)
            parts.append(f"{file} {status.getLen()} {status.getModificationTime()}")
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()


def run(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result is a table in ``folder``, by default a new one in the shared folder.

    Stages whose tables are complete there are not done again, so a run that was broken off goes on from where it was. They are
    kept by what they were made of: with other tables, another tokenizer or other thresholds the stages are done anew.
    """
    base = folder or f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    folder = f"{base}/{_made_of(spark, sf_dir)[:16]}" if folder else base
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        if not complete(spark, f"{folder}/{name}"):
            stage(spark, docs, sf_dir).write.mode("overwrite").parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
