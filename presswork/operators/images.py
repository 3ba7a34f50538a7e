"""Image outcomes: what fetching each record's image gave, without losing a record."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.functions.columns import is_filled, strip
from presswork.operators.dedup import keep_first, keep_first_in_place

# --- Fixed values: file extensions by media type, and those accepted from an address ----------
MEDIA_EXTENSIONS = {
    "image/jpeg": ".jpg",
    "image/jpg": ".jpg",
    "image/png": ".png",
    "image/webp": ".webp",
    "image/gif": ".gif",
}
URL_EXTENSIONS = (".jpg", ".jpeg", ".png", ".webp", ".gif")
DEFAULT_EXTENSION = ".jpg"
# ----------------------------------------------------------------------------------------------

Fetcher = Callable[[str], tuple[bytes, str] | None]
RESPONSE = "url string, content_type string, body binary"


def media_type(content_type: Column) -> Column:
    """Media type without parameters, trimmed and lower-cased; empty for NULL."""
    return F.lower(strip(F.split_part(F.coalesce(content_type, F.lit("")), F.lit(";"), F.lit(1))))


def is_image(content_type: Column, body_length: Column) -> Column:
    return F.coalesce(body_length > 0, F.lit(False)) & media_type(content_type).startswith("image/")


def image_extension(content_type: Column, url: Column) -> Column:
    """Extension by media type, else by the path of the address, else the default."""
    by_type = [F.lit(v) for pair in MEDIA_EXTENSIONS.items() for v in pair]
    path = F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    path = F.regexp_replace(path, r";[^/]*$", "")  # parameters of the last segment
    # The suffix of the last path segment; a leading dot does not start one.
    suffix = F.lower(F.regexp_extract(path, r"[^/.][^/]*(\.[^/.]+)/*$", 1))
    return F.coalesce(
        F.try_element_at(F.create_map(*by_type), media_type(content_type)),
        F.when(suffix.isin(*URL_EXTENSIONS), suffix),
        F.lit(DEFAULT_EXTENSION),
    )


def response_facts(responses: DataFrame) -> DataFrame:
    """One slim row per address: the media type and whether the body is an image.

    A good response wins over failed ones, so a retry that succeeds counts.
    Bodies are reduced to their length by the projection on the scan and are never shuffled.
    """
    size = F.col("body_length") if "body_length" in responses.columns else F.length("body")
    ok = F.coalesce(is_image(F.col("content_type"), size), F.lit(False))
    facts = responses.select(
        F.col("url").alias("image_url"),
        F.struct((~ok).alias("bad"), "content_type").alias("fact"),
    )
    best = keep_first(facts, "image_url", "fact")
    return best.select("image_url", (~F.col("fact.bad")).alias("ok"), "fact.content_type")


def image_outcomes(records: DataFrame, responses: DataFrame) -> DataFrame:
    """Add ``outcome`` and ``image_path`` and correct ``metadata.has_image``.

    Records without an address are skipped and keep their flag; they get a private join key, so
    that they spread over all tasks instead of meeting on NULL. One address on many records is a
    skewed key of the left side, which adaptive execution splits.
    """
    wanted = is_filled(F.col("image_url"))
    key = F.when(wanted, F.concat(F.lit("u"), "image_url")).otherwise(F.concat(F.lit("n"), "id"))
    facts = response_facts(responses).select(
        F.concat(F.lit("u"), "image_url").alias("_key"), "ok", "content_type"
    )
    joined = records.withColumn("_key", key).join(facts, "_key", "left")
    ok = F.coalesce(F.col("ok"), F.lit(False))
    outcome = F.when(~wanted, "skipped").when(ok, "downloaded").otherwise("failed")
    flag = F.when(wanted, ok).otherwise(F.col("metadata.has_image"))
    path = F.when(
        wanted & ok,
        F.concat("id", image_extension(F.col("content_type"), F.col("image_url"))),
    )
    return joined.select(
        *[c for c in records.columns if c != "metadata"],
        F.col("metadata").withField("has_image", flag).alias("metadata"),
        outcome.alias("outcome"),
        path.alias("image_path"),
    ).select(*records.columns, "outcome", "image_path")


def image_bodies(outcomes: DataFrame, responses: DataFrame) -> DataFrame:
    """(name, body) of the downloaded images, for :func:`presswork.sources.bodies.write_bodies`.

    Which response of an address counts is settled on slim rows (:func:`response_facts`); bodies
    move once, to meet their records. A record has one file, also where several share an address.
    """
    wanted = outcomes.where("outcome = 'downloaded'").select(
        F.col("image_path").alias("name"), F.col("image_url").alias("url")
    )
    good = responses.where(is_image(F.col("content_type"), F.length("body")))
    order = F.struct("content_type", F.md5("body").alias("digest"))
    first = keep_first_in_place(good.select("url", "body", order.alias("_order")), "url", "_order")
    return wanted.join(first.select("url", "body"), "url").select("name", "body")


def image_summary(outcomes: DataFrame) -> DataFrame:
    """Downloaded, failed, skipped and all records per split, and over all splits."""
    counts = [
        F.count_if(F.col("outcome") == name).alias(name)
        for name in ("downloaded", "failed", "skipped")
    ]
    return outcomes.rollup("split").agg(
        *counts, F.count("*").alias("total"), (F.grouping("split") == 1).alias("all_splits")
    )


#: Seconds between two requests to one host, and bytes of bodies that a task holds at a time.
HOST_PAUSE, HELD_BYTES = 1.0, 32 << 20


class Pacer:
    """Waits before a request until the host's last one is long enough ago."""

    def __init__(self, pause: float, clock: Callable[[], float], sleep: Callable[[float], None]):
        self.pause, self.clock, self.sleep = pause, clock, sleep
        self.free: dict[str, float] = {}

    def wait(self, host: str) -> None:
        early = self.free.get(host, 0.0) - self.clock()
        if early > 0:
            self.sleep(early)
        self.free[host] = self.clock() + self.pause


def host_of(url: Column) -> Column:
    """Host of an address in lower case; empty where it has none."""
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def fetch_responses(
    records: DataFrame, fetch: Fetcher, pause: float = HOST_PAUSE, held_bytes: int = HELD_BYTES,
    clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep,
) -> DataFrame:
    """Fetch each distinct address once and return the responses table.

    ``fetch`` maps an address to ``(body, content type)``, or to None when it fails; failures give
    no row. Addresses are dealt by host, so that one task asks a host and can keep the pause between
    its requests; the hosts of a task take turns as their addresses come, and bodies leave it as
    soon as they reach ``held_bytes``. Write the result before using it: recomputing it would fetch
    again.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pacer, held, size = Pacer(pause, clock, sleep), [], 0
        for batch in batches:
            for url, host in zip(batch["image_url"], batch["host"], strict=True):
                pacer.wait(host)
                hit = fetch(url)
                if hit is None:
                    continue
                held.append((url, hit[1], hit[0]))
                size += len(hit[0])
                if size >= held_bytes:
                    yield pd.DataFrame(held, columns=["url", "content_type", "body"])
                    held, size = [], 0
        if held:
            yield pd.DataFrame(held, columns=["url", "content_type", "body"])

    addresses = records.where(is_filled(F.col("image_url"))).select("image_url").distinct()
    # In pseudo-random order, the addresses of a task's hosts are mixed.
    dealt = (
        addresses.withColumn("host", host_of(F.col("image_url")))
        .repartition("host")
        .sortWithinPartitions(F.xxhash64("image_url"))
    )
    return dealt.mapInPandas(run, RESPONSE)
