"""The lifecycle a run at a time: lives and the observations of one run give what happened and the lives to go on from.

The rules are those of the batch form over whole readings; one full join by record takes the place of its windows, so a run costs
its records and not their history.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordwatch.functions.times import days_between
from recordwatch.operators import record_versions as RV
from recordwatch.operators.lifecycle import Policy, named_events

MAP = "map<string,string>"
LIVES = (
    f"record_id string, source_id string, state string, kind string, streak long, since timestamp, facts {MAP}, evidence {MAP}, quality string, confidence double, semantic_hash string, extraction_hash string, "
    "semantic_version long, extraction_revision long, attention boolean, last_at timestamp, last_run_id string"
)
OBSERVED = f"seq long, run_id string, started_at timestamp, record_id string, source_id string, seen boolean, complete boolean, failed boolean, facts {MAP}, evidence {MAP}, quality string, confidence double"
READ = ("facts", "evidence", "quality", "confidence", "semantic_hash", "extraction_hash")


class Step(NamedTuple):
    """The run's timeline (see ``record_versions.timeline``) and the lives after it (:data:`LIVES`)."""

    timed: DataFrame
    lives: DataFrame


def step(lives: DataFrame, observed: DataFrame, policy: Policy = Policy()) -> Step:
    """``observed`` (:data:`OBSERVED`, a row for each record) after ``lives``; observations that aren't later than a record's last are ignored."""
    names = [c.split()[0] for c in LIVES.split(", ")]
    was = lives.select(F.col("record_id").alias("__was"), F.struct(*names).alias("was"))
    now = RV.with_hashes(observed)
    now = now.select(F.col("record_id").alias("__now"), F.struct(*now.columns).alias("now"))
    both = was.join(now, F.col("__was") == F.col("__now"), "full_outer")
    known, seen, failed = F.col("was").isNotNull(), F.coalesce("now.seen", F.lit(False)), F.coalesce("now.failed", F.lit(False))
    kind = F.when(~known & seen, "ok").when(known & seen & ~failed, "ok").when(known & seen, "fail").when(known & F.coalesce("now.complete", F.lit(False)), "missing")
    counts = F.col("now").isNotNull() & (~known | (F.col("now.started_at") > F.col("was.last_at")))
    rows = both.withColumn("kind", F.when(counts, kind)).withColumns({c: F.col(f"now.{c}") for c in READ})
    same = F.coalesce(F.col("was.kind") == F.col("kind"), F.lit(False))
    rows = rows.withColumns({"streak": F.when(same, F.col("was.streak") + 1).otherwise(1).cast("long"), "since": F.when(same, F.col("was.since")).otherwise(F.col("now.started_at")), "previous_state": F.col("was.state")})
    absent = (F.col("streak") >= policy.absent_observations) & (days_between(F.col("since"), F.col("now.started_at")) >= policy.absent_days)
    rows = rows.withColumn("state", F.when(F.col("kind") == "ok", "active").when(F.col("kind") == "fail", "fetch_failed").when(absent, "long_absent").otherwise("temporarily_missing"))
    told = RV.compare(F.col("was"))
    compared = known & (F.col("kind") == "ok")
    marks = {k: F.coalesce(compared & told.pop(k), F.lit(False)) for k in ("changed", "improved", "degraded")}
    rows = rows.withColumns(marks | {k: F.when(compared, c) for k, c in told.items()} | {"previous_semantic_hash": F.when(compared, F.col("was.semantic_hash"))})
    more = lambda number, mark: (F.coalesce(F.col(f"was.{number}"), F.lit(1)) + F.when(F.col(mark), 1).otherwise(0)).cast("long")
    rows = rows.withColumns({"semantic_version": more("semantic_version", "changed"), "extraction_revision": more("extraction_revision", "improved"), "attention": F.coalesce((F.col("kind") == "fail") & (F.col("streak") >= policy.failures_for_attention), F.lit(False)), "events": named_events()})
    good = F.col("kind") == "ok"
    timed = rows.filter("kind is not null").select(
        "now.seq", "now.run_id", "now.started_at", "now.record_id", "now.source_id", "kind", "state", "previous_state", "streak", "since", "changed", "improved", "semantic_version", "extraction_revision", "attention", "events", *told,
        "previous_semantic_hash", *[F.when(good, F.col(c)).alias(c) for c in ("semantic_hash", "extraction_hash")],
    )
    moved = {"record_id": F.col("now.record_id"), "source_id": F.coalesce("now.source_id", "was.source_id"), "last_at": F.col("now.started_at"), "last_run_id": F.col("now.run_id")}
    moved |= {c: F.when(good, F.col(c)).otherwise(F.col(f"was.{c}")) for c in READ}
    kept = rows.filter("kind is not null or was is not null")
    after = kept.select(*[F.when(F.col("kind").isNotNull(), moved.get(c, F.col(c))).otherwise(F.col(f"was.{c}")).alias(c) for c in names])
    return Step(timed, after)
