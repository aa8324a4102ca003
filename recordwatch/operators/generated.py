"""Checks of generated summaries: their shape, what they refer to, and whether their words are borne out by the records.

A summary is JSON of unknown shape, parsed once as a VARIANT: anything that isn't as it should be is told, with the path of its
place, instead of failing. References are joined to the summary's own records by id, address and both; a summary's texts are
matched within its row. One row for each broken rule; a summary without rows is good.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordwatch.functions.text import URL_SHAPE
from recordwatch.functions.urls import normalize

BROKEN = "output_id, path, rule"
VERSION = "llm_reference_aligned_v2"
FIELDS, POINT_FIELDS, FORBIDDEN = ("llm_summary_version", "overall_summary", "key_points"), ("point", "source_record_ids", "source_urls", "caveat"), ("source_based_notes",)


@dataclass(frozen=True)
class Phrases:
    """Words that need something to bear them out."""

    # Phrases of the language that summaries are written in.
    this_week: tuple[str, ...] = ("本周发布", "本周推出", "本周上线", "本周新增", "本周宣布", "新近上线")
    first_this_week: tuple[str, ...] = ("本周首次发布",)
    nothing_new: str = "本周未检测到新增或内容变化条目"
    expanded: tuple[str, ...] = ("发射成功", "计划发射", "任务完成", "载荷数量", "覆盖范围扩大", "服务开通", "技术升级", "网络容量提升", "速率提升", "用户增长", "终端升级", "直连手机已部署")
    updated: tuple[str, ...] = ("官方内容更新", "内容发生更新")
    removed: tuple[str, ...] = ("官方删除", "已经删除", "已经下线")
    outage: tuple[str, ...] = ("官方故障", "服务故障")
    restored: tuple[str, ...] = ("服务已恢复", "官方服务恢复")
    republished: tuple[str, ...] = ("重新发布",)
    confirmed: tuple[str, ...] = ("本轮重新确认", "本轮确认")


@dataclass(frozen=True)
class Shape:
    """The version and fields that a summary has."""

    version: str = VERSION
    fields: tuple[str, ...] = FIELDS
    point_fields: tuple[str, ...] = POINT_FIELDS
    forbidden: tuple[str, ...] = FORBIDDEN
    phrases: Phrases = field(default_factory=Phrases)


def _says(text: Column, phrases: tuple[str, ...]) -> Column:
    return reduce(lambda a, p: a | F.contains(text, F.lit(p)), phrases, F.lit(False))


def _is(kind: str, value: str) -> Column:
    return F.coalesce(F.expr(f"schema_of_variant({value})").startswith(kind), F.lit(False))


def _text(value: str, key: str) -> Column:
    return F.coalesce(F.try_variant_get(F.col(value), f"$.{key}", "string"), F.lit(""))


def _listed(value: str, key: str) -> Column:
    return F.filter(F.coalesce(F.try_variant_get(F.col(value), f"$.{key}", "array<string>"), F.array().cast("array<string>")), lambda x: F.coalesce(x, F.lit("")) != "")


def _other_keys(value: str, known: tuple[str, ...]) -> Column:
    return F.size(F.array_except(F.map_keys(F.col(value).cast("map<string,variant>")), F.array(*map(F.lit, known)))) > 0


def _told(rows: DataFrame, path: Column, rules: dict[str, Column]) -> DataFrame:
    broken = F.array_compact(F.array(*[F.when(F.coalesce(on, F.lit(False)), F.lit(rule)) for rule, on in rules.items()]))
    return rows.select("output_id", path.alias("path"), F.explode(broken).alias("rule"))


def _inputs(records: DataFrame, normal: Callable[[Column], Column]) -> DataFrame:
    """Records by the columns that are asked for, those that are missing as nulls."""
    kinds = {"id": "string", "canonical_url": "string", "change_status": "string", "published_at": "string", "extracted_level": "string", "source_quality": "string", "extraction_change_status": "string", "lifecycle_state": "string", "lifecycle_events": "array<string>", "current_run_data_reused": "boolean"}
    held = records.select("output_id", *[(F.col(k) if k in records.columns else F.lit(None)).cast(t).alias(k) for k, t in kinds.items()])
    return held.withColumns({"url": F.nullif(normal(F.trim("canonical_url")), F.lit("")), "id": F.nullif(F.trim("id"), F.lit("")), "change_status": F.lower(F.coalesce("change_status", F.lit("")))})


def broken_rules(outputs: DataFrame, records: DataFrame, shape: Shape = Shape(), normal: Callable[[Column], Column] = normalize) -> DataFrame:
    """``output_id, path, rule`` for each rule that a summary breaks.

    ``outputs``: ``output_id, raw``; ``records``: the rows each summary was made from, by ``output_id``, with ``id, canonical_url`` and
    whichever of ``change_status, published_at, extracted_level, source_quality, extraction_change_status, lifecycle_state,
    lifecycle_events, current_run_data_reused`` there are.
    """
    words, given = shape.phrases, _inputs(records, normal)
    event = lambda name: F.max(F.coalesce(F.array_contains("lifecycle_events", name), F.lit(False)))
    undated = (F.col("change_status") == "new") & (F.coalesce("published_at", F.lit("")) == "")
    about = given.groupBy("output_id").agg(
        F.count(F.lit(1)).alias("n_inputs"), F.max(F.col("change_status").isin("new", "changed")).alias("any_change"), F.max(undated).alias("any_undated"),
        F.min((F.coalesce("extracted_level", F.lit("")) == "page_level") & (F.coalesce("source_quality", F.lit("")) == "low")).alias("all_low"),
        F.max((F.lower(F.coalesce("extraction_change_status", F.lit(""))) == "improved") & (F.col("change_status") != "changed")).alias("any_improved"),
        F.max(F.coalesce("lifecycle_state", F.lit("")).isin("temporarily_missing", "long_absent")).alias("any_absent"), event("detail_fetch_failed").alias("any_failed"), event("detail_fetch_recovered").alias("any_recovered"),
        event("reappeared").alias("any_returned"), F.max(F.coalesce("current_run_data_reused", F.lit(False))).alias("any_reused"),
    )
    parsed = outputs.select("output_id", F.try_parse_json("raw").alias("v")).withColumn("is_object", _is("OBJECT", "v"))
    no_json = parsed.select("output_id", F.lit("").alias("path"), F.when(F.col("v").isNull(), "not_json").otherwise("not_object").alias("rule"), "is_object").filter(~F.col("is_object")).drop("is_object")
    good = parsed.filter("is_object").join(about, "output_id", "left").na.fill({"n_inputs": 0})
    has = lambda key: F.array_contains(F.map_keys(F.col("v").cast("map<string,variant>")), key)
    points = F.coalesce(F.try_variant_get(F.col("v"), "$.key_points", "array<variant>"), F.array().cast("array<variant>"))
    texts = F.concat_ws("\n", _text("v", "overall_summary"), F.array_join(F.transform(points, lambda p: F.concat_ws("\n", F.coalesce(F.try_variant_get(p, "$.point", "string"), F.lit("")), F.coalesce(F.try_variant_get(p, "$.caveat", "string"), F.lit("")))), "\n"))
    good = good.withColumn("points", points).withColumn("said", texts)
    listed = F.coalesce(F.expr("schema_of_variant(try_variant_get(v, '$.key_points', 'variant'))").startswith("ARRAY"), F.lit(False))
    change = F.coalesce("any_change", F.lit(False))
    asked = F.col("n_inputs") > 0
    whole = _told(good, F.lit(""), {
        "wrong_version": _text("v", shape.fields[0]) != shape.version, **{f"missing_{k}": ~has(k) for k in shape.fields[1:]}, "unknown_field": _other_keys("v", shape.fields), **{f"forbidden_{k}": has(k) for k in shape.forbidden},
        "key_points_not_a_list": has("key_points") & ~listed, "no_key_points": asked & (F.size("points") == 0), "silent_about_no_change": asked & ~change & ~F.contains("said", F.lit(words.nothing_new)),
        "page_expanded_to_facts": F.col("all_low") & _says(F.col("said"), words.expanded), "undated_told_as_new": F.col("any_undated") & _says(F.col("said"), (*words.this_week, *words.first_this_week)),
        "time_told_without_change": asked & ~change & _says(F.col("said"), words.this_week), "improvement_told_as_update": F.col("any_improved") & _says(F.col("said"), words.updated),
        "absence_told_as_removal": F.col("any_absent") & _says(F.col("said"), words.removed), "failure_told_as_outage": F.col("any_failed") & _says(F.col("said"), words.outage),
        "recovery_told_as_restored": F.col("any_recovered") & _says(F.col("said"), words.restored), "return_told_as_republished": F.col("any_returned") & _says(F.col("said"), words.republished), "reuse_told_as_confirmed": F.col("any_reused") & _says(F.col("said"), words.confirmed),
    })

    # Addresses anywhere in a summary that none of its records has.
    urls = given.filter("url is not null").select("output_id", "url").distinct()
    anywhere = good.select("output_id", F.explode(F.array_distinct(F.transform(F.regexp_extract_all(F.to_json("v"), F.lit(URL_SHAPE), F.lit(0)), normal))).alias("url"))
    foreign = anywhere.join(urls, ["output_id", "url"], "left_anti").select("output_id", F.lit("").alias("path"), F.lit("foreign_url").alias("rule")).distinct()

    each = good.select("output_id", F.posexplode("points").alias("pos", "p")).withColumn("path", F.concat(F.lit("key_points["), F.col("pos") + 1, F.lit("]")))
    odd = _told(each.filter(~_is("OBJECT", "p")), F.col("path"), {"point_not_an_object": F.lit(True)})
    own = each.filter(_is("OBJECT", "p")).withColumns({"ids": _listed("p", "source_record_ids"), "urls": F.transform(_listed("p", "source_urls"), normal), "text": _text("p", "point")})
    refs = own.select("output_id", "pos", F.posexplode(F.arrays_zip(F.col("ids").alias("id"), F.col("urls").alias("url"))).alias("place", "ref")).select("output_id", "pos", "ref.id", "ref.url")
    by_id = given.filter("id is not null").groupBy("output_id", "id").agg(F.max_by(F.struct("change_status", undated.alias("undated")), F.coalesce("url", F.lit(""))).alias("record"), F.lit(True).alias("id_known"))
    pairs = given.filter("id is not null and url is not null").select("output_id", "id", "url", F.lit(True).alias("pair_known")).distinct()
    known = refs.join(by_id, ["output_id", "id"], "left").join(urls.withColumn("url_known", F.lit(True)), ["output_id", "url"], "left").join(pairs, ["output_id", "id", "url"], "left")
    unknown = lambda what, flag: F.max(F.col(what).isNotNull() & F.col(flag).isNull())
    sums = known.groupBy("output_id", "pos").agg(
        unknown("id", "id_known").alias("unknown_id"), unknown("url", "url_known").alias("unknown_url"), F.max(F.col("pair_known").isNull()).alias("unpaired"), F.min("record.change_status").alias("low"), F.max("record.change_status").alias("high"), F.max("record.undated").alias("undated"),
    )
    timed = _says(F.col("text"), words.this_week)
    told = own.join(sums, ["output_id", "pos"], "left")
    only = lambda status: (F.col("low") == status) & (F.col("high") == status) & timed
    of_points = _told(told, F.col("path"), {
        "unknown_point_field": _other_keys("p", shape.point_fields), "point_without_text": F.trim("text") == "", "point_without_reference": (F.size("ids") == 0) | (F.size("urls") == 0), "unknown_record": F.col("unknown_id"), "unknown_url": F.col("unknown_url"),
        "repeated_record": F.size(F.array_distinct("ids")) < F.size("ids"), "repeated_url": F.size(F.array_distinct("urls")) < F.size("urls"), "unequal_references": F.size("ids") != F.size("urls"), "unpaired_reference": (F.size("ids") == F.size("urls")) & F.col("unpaired"),
        "unchanged_told_as_new": only("unchanged"), "change_told_as_publication": only("changed"), "undated_point_told_as_new": F.col("undated") & timed,
    })
    return no_json.unionByName(whole).unionByName(foreign).unionByName(odd).unionByName(of_points)
