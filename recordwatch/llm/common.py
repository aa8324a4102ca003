"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables; ``sf_dir`` may be any path that Spark can read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many more underscores as no column of ``df`` has."""
    while name.lower() in (c.lower() for c in df.columns):
        name = f"_{name}"
    return name


def text_or_empty(name: str = "text") -> Column:
    """A text column with null read as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body or a function within it refers to it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


#: A key is hot if it has more rows than this and than a ``MOST_HOT``-th of all: so at most ``MOST_HOT`` keys are.
HOT_ROWS, MOST_HOT = 1_000, 100_000


def by_hot_key(rows: DataFrame, groups: DataFrame, key: str, n: str, spread: Column, how: str = "inner") -> DataFrame:
    """``rows`` joined by ``key`` with ``groups``, which has one row a key and the number ``n`` of its rows.

    The rows of a hot key are dealt out by ``spread`` over as many tasks as they need, each with a copy of its group. The
    hot keys are broadcast; there are at most ``MOST_HOT``.
    """
    least = max(HOT_ROWS, (groups.agg(F.sum(n)).first()[0] or 0) // MOST_HOT)
    hot = groups.filter(F.col(n) > least).select(F.col(key).alias("__hot"), F.ceil(F.col(n) / least).cast("int").alias("__salts"))
    if hot.isEmpty():
        return rows.join(groups, key, how)
    hot = F.broadcast(hot)
    salt = F.when(F.col("__salts").isNull(), 0).otherwise(F.pmod(F.xxhash64(spread), F.col("__salts"))).cast("int")
    dealt = rows.join(hot, rows[key] == hot["__hot"], "left").withColumn("__salt", salt).drop("__hot", "__salts")
    copies = groups.join(hot, groups[key] == hot["__hot"], "left")
    copies = copies.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1))).drop("__hot", "__salts")
    return dealt.join(copies, [key, "__salt"], how).drop("__salt")


def without_repeats(rows: DataFrame, keys: list[Column], repeated: DataFrame) -> DataFrame:
    """``rows`` with one row only for each of the ``repeated`` values of ``keys`` (its columns, in that order); rows with other values are left alone."""
    if repeated.isEmpty():
        return rows
    names = [free_name(rows, f"__key{k}") for k in range(len(keys))]
    keyed = rows.select("*", *[c.alias(name) for c, name in zip(keys, names)])
    same = F.lit(True)
    for name, c in zip(names, repeated.columns):
        same = same & keyed[name].eqNullSafe(repeated[c])
    once = keyed.join(repeated, same, "left_semi").dropDuplicates(names)
    return keyed.join(repeated, same, "left_anti").unionByName(once).drop(*names)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Leave ``spark.checkpoint.dir`` as the cluster names it; make one only for a local master without it."""
    sc = spark.sparkContext
    if spark.conf.get("spark.checkpoint.dir", None) or sc._jsc.sc().getCheckpointDir().isDefined():
        return
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir is not set; name a folder that driver and executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoints-"))


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files that nothing refers to any more, so that an operator of several steps needs the disk of its largest step, not of all."""
    gc.collect()
    spark._jvm.System.gc()


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder, go on from there and release what led to it."""
    ensure_checkpoint_dir(df.sparkSession)
    out = df.checkpoint()
    del df
    release(out.sparkSession)
    return out


def kept(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder, in compressed columns, which take less room than a checkpoint's rows."""
    path = f"{shared_folder(df.sparkSession)}/kept-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Remove tables that :func:`kept` wrote and that nothing reads any more."""
    for df in tables:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsparkSession.sessionState().newHadoopConf()
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if folder.rsplit("/", 1)[-1].startswith("kept-"):
                path = jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(conf).delete(path, True)


def complete(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to its end there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(place)


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share."""
    ensure_checkpoint_dir(spark)
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named or spark.sparkContext._jsc.sc().getCheckpointDir().get()
