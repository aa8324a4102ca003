"""Where fetches ended: responses that lead on are followed to the last one, by joins on their addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordwatch.functions.urls import candidate_url, path

#: Redirects that are followed; browsers and clients give up after about as many.
MOST_HOPS = 10


def _target(url: Column, location: Column) -> Column:
    """Absolute address of a ``Location``: as it is, with the scheme of ``url``, below its site or beside it."""
    site = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*:)//[^/?#]*", 0)
    beside = F.regexp_extract(url, r"^[^?#]*/", 0)
    return (
        F.when(location.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), location)
        .when(location.startswith("//"), F.concat(F.regexp_extract(url, r"^[^:]*:", 0), location))
        .when(location.startswith("/"), F.concat(site, location))
        .otherwise(F.concat(F.when(F.length(beside) > F.length(site), beside).otherwise(F.concat(site, F.lit("/"))), location))
    )


def followed(asked: DataFrame, responses: DataFrame, hops: int = MOST_HOPS) -> DataFrame:
    """``asked`` (with ``url``) and ``final_url, n_redirects`` and the last response's ``http_status, content_type, html``; nulls where nothing was fetched.

    ``responses``: ``url, status, location, content_type, html``, one for each address. Only rows that lead on take part in a
    further join; a chain that is longer than ``hops``, or a circle, ends at the response it has reached.
    """
    known = responses.select("url", "status", "location").withColumn("__next", F.when(F.col("status").between(300, 399) & F.col("location").isNotNull(), _target(F.col("url"), F.col("location"))))
    leads = known.filter("__next is not null").select(F.col("url").alias("__at"), "__next")
    at = asked.select("url").distinct().withColumns({"final_url": F.col("url"), "n_redirects": F.lit(0)})
    for _ in range(hops):
        step = at.join(leads, at["final_url"] == leads["__at"], "left")
        at = step.select("url", F.coalesce("__next", "final_url").alias("final_url"), (F.col("n_redirects") + F.col("__next").isNotNull().cast("int")).alias("n_redirects"))
        if at.filter(F.col("n_redirects") > _).isEmpty():
            break
    last = responses.select(F.col("url").alias("__last"), F.col("status").alias("http_status"), "content_type", "html")
    ended = at.withColumnRenamed("url", "__asked").join(last, F.col("final_url") == F.col("__last"), "left").drop("__last")
    return asked.join(ended, asked["url"] == ended["__asked"], "left").drop("__asked")


def landed(final_url: Column, index: str, root: str, prefix: str, canonical_host: str) -> Column:
    """``inside`` where a fetch ended at what may be a candidate, ``index`` at the index page's path, else ``outside``."""
    place = F.lower(F.regexp_replace(path(final_url), r"/+$", ""))
    own = F.lower(F.regexp_replace(path(F.lit(index)), r"/+$", ""))
    return F.when(candidate_url(final_url, index, root, prefix, canonical_host).isNotNull(), "inside").when(place == own, "index").otherwise("outside")
