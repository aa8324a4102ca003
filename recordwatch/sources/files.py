"""Scans: JSON lines with either policy for bad lines, keyed JSON documents, source catalogs, Markdown records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of the lines that are objects; other lines are skipped."""
    return json_lines_marked(spark, path, schema).filter("__bad is null").drop("__bad")


def json_lines_marked(spark: SparkSession, path: str, schema: str) -> DataFrame:
    kind = StructType([*StructType.fromDDL(schema).fields, StructField("__bad", StringType())])
    rows = spark.read.schema(kind).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "__bad").json(path)
    return rows.filter("__bad is not null or " + " or ".join(f"`{f.name}` is not null" for f in kind.fields[:-1]))


def json_lines_strict(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The same, but one bad line empties the table."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    parsed = lines.select(F.from_json("value", StructType.fromDDL(schema)).alias("r"), F.col("value").alias("raw"))
    bad = F.try_parse_json("raw").isNull() | ~F.trim("raw").startswith("{")
    gate = parsed.agg(F.coalesce(F.max(bad), F.lit(False)).alias("__any_bad"))
    return parsed.join(F.broadcast(gate)).filter(~F.col("__any_bad")).select("r.*")


def keyed_document(spark: SparkSession, path: str, container: str, value: str, key: str = "key") -> DataFrame:
    """Rows of a JSON document ``{container: {key: {...}}}``; a missing or broken document gives none."""
    kind = f"struct<{container}: map<string, struct<{value}>>>"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], f"{key} string, {value}")
    texts = spark.read.text(path, wholetext=True)
    return texts.select(F.from_json("value", kind).alias("d")).select(F.explode(f"d.{container}").alias(key, "v")).select(key, "v.*")


def catalog(spark: SparkSession, text: str, only: str | None = None) -> DataFrame:
    """Enabled sources of a YAML catalog (its text), all values as text; ``only`` picks one by id."""
    import yaml

    found = (yaml.safe_load(text) or {}).get("sources")
    if not isinstance(found, list):
        raise ValueError("sources must be a list")
    rows = [s for s in found if isinstance(s, dict) and s.get("enabled") is True and (only is None or s.get("id") == only)]
    names = ["id", "name", "url", "category"]
    return spark.createDataFrame([tuple(None if s.get(n) is None else str(s[n]) for n in names) for s in rows], ", ".join(f"{n} string" for n in names))


def fixture(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """Made-up items for replays: at least two, all under hosts that can't exist."""
    if len(rows) < 2 or any(".invalid" not in r.get("canonical_url", "") for r in rows):
        raise ValueError("a fixture needs two items or more under .invalid hosts")
    return spark.createDataFrame([tuple(r.get(f.name) for f in StructType.fromDDL(schema).fields) for r in rows], schema)


def markdown_records(lines: DataFrame, doc: str = "doc", pos: str = "pos", line: str = "line") -> DataFrame:
    """``doc, record, key, value`` from lines ``- key: value`` below headings ``### name``; a full-width colon counts too."""
    from pyspark.sql import Window

    over = Window.partitionBy(doc).orderBy(pos).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = lines.withColumn("record", F.sum(F.col(line).startswith("### ").cast("long")).over(over))
    shape = r"^[-*]\s+([^:：]+)[:：]\s*(.*)$"
    return numbered.filter((F.col("record") > 0) & F.col(line).rlike(shape)).select(
        doc, "record", F.trim(F.regexp_extract(line, shape, 1)).alias("key"), F.trim(F.regexp_extract(line, shape, 2)).alias("value")
    )
