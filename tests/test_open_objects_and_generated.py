"""Open objects against plain recursion, and checks of generated summaries rule by rule."""

import json
import random

import pytest
from pyspark.sql import functions as F

from recordwatch.functions import open_objects as O
from recordwatch.operators import generated as G


def plain(value, path=""):
    if isinstance(value, dict):
        out = {}
        for k in sorted(value):
            out |= plain(value[k], f"{path}.{k}" if path else k)
        return out if value or not path else {path: {}}
    return {path: value}


def random_value(rng, depth):
    kind = rng.choice("osnlbz" if depth else "o")
    if kind == "o":
        return {rng.choice(["a", "b", "Z", "é", "long name"]) + str(rng.randint(0, 2)): random_value(rng, depth + 1) for _ in range(rng.randint(0, 4))} if depth < 5 else {}
    return {"s": rng.choice(["", "text", "’q"]), "n": rng.choice([0, 7, -2, 1.5]), "l": [1, {"x": None}], "b": True, "z": None}[kind]


def test_leaves_and_canonical_text_of_random_objects(spark):
    rng = random.Random(3)
    values = [random_value(rng, 0) for _ in range(60)] + [{"a": {"b": {"c": {"d": {"e": {"f": {"g": 1}}}}}}}, [1, 2], "text", 5, {}]
    rows = [(k, json.dumps(v)) for k, v in enumerate(values)] + [(900, "not json"), (901, None)]
    df = spark.createDataFrame(rows, "id long, raw string").withColumn("v", F.try_parse_json("raw"))
    got = {}
    for r in O.leaves(df, "v", ["id"]).collect():
        assert r.path not in got.setdefault(r.id, {})
        got[r.id][r.path] = r.text
    text = lambda v: v if isinstance(v, str) or v is None else json.loads(json.dumps(v))
    for k, v in enumerate(values):
        own = {p: t if isinstance(plain(v)[p], str) or t is None else json.loads(t) for p, t in got.get(k, {}).items()}
        assert own == {p: text(x) for p, x in plain(v).items()}, v
    assert not {900, 901} & set(got)
    canonical = {r.id: r.c for r in df.select("id", O.canonical_json(F.col("raw")).alias("c")).collect()}
    assert canonical == {k: json.dumps(v, ensure_ascii=False, sort_keys=True, separators=(",", ":")) for k, v in enumerate(values)} | {900: None, 901: None}
    deep = {r.path: r.text for r in O.leaves(df.filter("id = 60"), "v", ["id"], levels=2).collect()}
    assert deep == {"a.b": '{"c":{"d":{"e":{"f":{"g":1}}}}}'}
    maps = {r.id: r.facts for r in O.facts(df, "v", ["id"]).collect()}
    assert maps == got


GOOD = {"llm_summary_version": G.VERSION, "overall_summary": "s", "key_points": [{"point": "p", "source_record_ids": ["r1"], "source_urls": ["https://a.invalid/1?utm_source=x"], "caveat": "c"}]}
RECORDS = {"id": "string", "canonical_url": "string", "change_status": "string", "published_at": "string", "extracted_level": "string", "source_quality": "string", "extraction_change_status": "string", "lifecycle_state": "string", "lifecycle_events": "array<string>", "current_run_data_reused": "boolean"}
R1 = {"id": "r1", "canonical_url": "https://a.invalid/1", "change_status": "changed", "published_at": "2026-01-01"}
R2 = {"id": "r2", "canonical_url": "https://a.invalid/2", "change_status": "new", "published_at": None}


def point(**change):
    return {**GOOD, "key_points": [{**GOOD["key_points"][0], **change}]}


WEEK = "本周发布"
CASES = {
    "good": (GOOD, [R1], set()),
    "text": ("{", [R1], {("", "not_json")}),
    "list": ([1], [R1], {("", "not_object")}),
    "shape": ({"llm_summary_version": "x", "key_points": 3, "source_based_notes": 1}, [R1], {("", r) for r in ("wrong_version", "missing_overall_summary", "unknown_field", "forbidden_source_based_notes", "key_points_not_a_list", "no_key_points")}),
    "no points, no records": ({**GOOD, "key_points": []}, [], set()),
    "odd points": ({**GOOD, "key_points": [1, {"point": " ", "x": 1}, *GOOD["key_points"]]}, [R1], {("key_points[1]", "point_not_an_object"), *(("key_points[2]", r) for r in ("unknown_point_field", "point_without_text", "point_without_reference"))}),
    "unknown": (point(source_record_ids=["r9"], source_urls=["https://a.invalid/9"]), [R1], {("", "foreign_url"), *(("key_points[1]", r) for r in ("unknown_record", "unknown_url", "unpaired_reference"))}),
    "crossed": (point(source_record_ids=["r1", "r2"], source_urls=["https://a.invalid/2", "https://a.invalid/1"]), [R1, R2], {("key_points[1]", "unpaired_reference")}),
    "repeated": (point(source_record_ids=["r1", "r1"], source_urls=["https://a.invalid/1", "https://a.invalid/1#top"]), [R1], {("key_points[1]", "repeated_record"), ("key_points[1]", "repeated_url")}),
    "unequal": (point(source_record_ids=["r1", "r2"]), [R1, R2], {("key_points[1]", "unequal_references")}),
    "change": (point(point=WEEK), [R1], {("key_points[1]", "change_told_as_publication")}),
    "undated": (point(point=WEEK, source_record_ids=["r2"], source_urls=["https://a.invalid/2"]), [R2], {("", "undated_told_as_new"), ("key_points[1]", "undated_point_told_as_new")}),
    "unchanged": (point(point=WEEK), [{**R1, "change_status": "unchanged"}], {("", "silent_about_no_change"), ("", "time_told_without_change"), ("key_points[1]", "unchanged_told_as_new")}),
    "said so": ({**GOOD, "overall_summary": G.Phrases().nothing_new}, [{**R1, "change_status": "unchanged"}], set()),
    "low page": (point(caveat="任务完成"), [{**R1, "extracted_level": "page_level", "source_quality": "low"}], {("", "page_expanded_to_facts")}),
    "states": (
        {**GOOD, "overall_summary": "官方内容更新 已经下线 服务故障 官方服务恢复 重新发布 本轮确认"},
        [R1, {**R2, "published_at": "2026", "extraction_change_status": "improved", "lifecycle_state": "long_absent", "lifecycle_events": ["detail_fetch_failed", "detail_fetch_recovered", "reappeared"], "current_run_data_reused": True}],
        {("", r) for r in ("improvement_told_as_update", "absence_told_as_removal", "failure_told_as_outage", "recovery_told_as_restored", "return_told_as_republished", "reuse_told_as_confirmed")},
    ),
    "words alone": ({**GOOD, "overall_summary": "官方内容更新 已经下线 服务故障 官方服务恢复 重新发布 本轮确认 任务完成"}, [R1], set()),
    "address in a text": ({**GOOD, "overall_summary": "see https://b.invalid/x"}, [R1], {("", "foreign_url")}),
}


def test_broken_rules_of_summaries(spark):
    outputs = spark.createDataFrame([(k, v if isinstance(v, str) else json.dumps(v)) for k, (v, _, _) in CASES.items()] + [("null", None)], "output_id string, raw string")
    rows = [(k, *(r.get(c) for c in RECORDS)) for k, (_, records, _) in CASES.items() for r in records]
    records = spark.createDataFrame(rows, "output_id string, " + ", ".join(f"{c} {t}" for c, t in RECORDS.items()))
    found = G.broken_rules(outputs, records).collect()
    got = {k: set() for k in [*CASES, "null"]}
    for r in found:
        assert (r.path, r.rule) not in got[r.output_id]
        got[r.output_id].add((r.path, r.rule))
    assert got == {k: e for k, (_, _, e) in CASES.items()} | {"null": {("", "not_json")}}


@pytest.mark.parametrize("columns", [["output_id", "id", "canonical_url"]])
def test_records_may_lack_columns(spark, columns):
    outputs = spark.createDataFrame([("x", json.dumps({**GOOD, "overall_summary": G.Phrases().nothing_new}))], "output_id string, raw string")
    records = spark.createDataFrame([("x", "r1", "https://a.invalid/1")], "output_id string, id string, canonical_url string")
    assert G.broken_rules(outputs, records.select(*columns)).collect() == []


def test_rows_are_read_once_for_four_levels_and_deeper_objects_again(spark, monkeypatch):
    from recordwatch.functions import open_objects as OO

    passes, read = [], spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        read.add(1)
        return text

    monkeypatch.setattr(OO, "settled", lambda df, whole=OO.settled: passes.append(1) or whole(df))
    deep = '{"a": {"b": {"c": {"d": {"e": {"f": 1, "g": {}}}}}}, "h": null, "i": [1, {"z": {}}]}'
    rows = [(1, deep), (2, '{"a": {"b": "x"}}'), (3, "{}"), (4, "7"), (5, None)]
    df = spark.createDataFrame(rows, "id long, raw string").withColumn("v", F.try_parse_json(counted.asNondeterministic()("raw")))
    told = {(r.id, r.path, r.text) for r in OO.leaves(df, "v", ["id"]).collect()}
    assert told == {(1, "a.b.c.d.e.f", "1"), (1, "a.b.c.d.e.g", "{}"), (1, "h", None), (1, "i", '[1,{"z":{}}]'), (2, "a.b", "x"), (4, "", "7")}
    assert len(passes) == 2 and read.value <= 2 * len(rows)
    cut = {(r.path, r.text) for r in OO.leaves(spark.createDataFrame(rows[:1], "id long, raw string").withColumn("v", F.try_parse_json("raw")), "v", ["id"], 5).collect()}
    assert ("a.b.c.d.e", '{"f":1,"g":{}}') in cut and len(cut) == 3
