"""Audits and quality tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def percent(part: Column, whole: Column) -> Column:
    return F.round(F.lit(100.0) * part / whole, 2)


def end_audit(ends: DataFrame, routed: DataFrame) -> DataFrame:
    """Counts of the universes of each sample, their percentages, and whether they add up."""
    first = ends.groupBy("sample_id").agg(
        F.sum(F.col("unclipped") + F.col("clipped")).alias("c0"), F.sum("unclipped").alias("c1"), F.sum("clipped").alias("c1s")
    )
    n = lambda c: F.coalesce(F.sum(F.when(c, F.col("count"))), F.lit(0)).cast("long")
    second = routed.groupBy("sample_id").agg(
        n(F.col("universe") == "C2").alias("c2"), n(F.col("universe") == "C2R").alias("c2r"), n(F.col("masked") & F.col("rescued")).alias("rescued")
    )
    return first.join(second, "sample_id").select(
        "sample_id", "c0", "c1", "c1s", "c2", "c2r", "rescued",
        percent(F.col("c1"), F.col("c0")).alias("c1_pct"),
        percent(F.col("c2"), F.col("c0")).alias("c2_pct"),
        ((F.col("c0") == F.col("c1") + F.col("c1s")) & (F.col("c1") == F.col("c2") + F.col("c2r"))).alias("reconciled"),
    )


def orientation(counts: DataFrame, least: int = 1000, share: float = 0.75) -> DataFrame:
    """Whether reverse counts (forward, reverse) prevail; too few informative reads pass."""
    n = F.col("forward") + F.col("reverse")
    fraction = F.when(n > 0, F.col("reverse") / n)
    return counts.select("sample_id", n.alias("informative"), fraction.alias("reverse_fraction"), ((n < least) | (fraction >= share)).alias("passed"))


def gene_body(profiles: DataFrame) -> DataFrame:
    """(sample_id, first20, last20, ratio, profile) of 100 percentile values, scaled to the largest."""
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    top = F.array_max("values")
    rows = profiles.filter(F.size("values") == 100).withColumn("first20", total(F.slice("values", 1, 20))).withColumn("last20", total(F.slice("values", 81, 20)))
    return rows.select(
        "sample_id", "first20", "last20", F.when(F.col("last20") > 0, F.col("first20") / F.col("last20")).alias("ratio"),
        F.when(top > 0, F.transform("values", lambda x: x / top)).alias("profile"),
    )


def collapse_samples(lanes: DataFrame) -> DataFrame:
    """Lanes to samples: the first lane's metadata, numbers of technical replicates and lanes, and
    whether lanes disagree on what must not vary."""
    fixed = ["genome", "condition", "subject"]
    return lanes.groupBy("sample_id").agg(
        *[F.min_by(c, "lane_id").alias(c) for c in fixed],
        F.count_distinct("technical_replicate_id").alias("technical_replicates"),
        F.count(F.lit(1)).alias("lanes"),
        (F.count_distinct(F.struct(*fixed)) > 1).alias("inconsistent"),
    )


def duplicated_lanes(lanes: DataFrame) -> DataFrame:
    key = ["sample_id", "technical_replicate_id", "lane_id"]
    return lanes.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def resource_plan(jobs: DataFrame, threads: int, memory: int) -> DataFrame:
    """Concurrent jobs and their peak by stage (stage, jobs, threads, memory_gb), under the ceilings."""
    at_once = F.greatest(F.lit(1), F.least("jobs", F.floor(F.lit(threads) / F.col("threads")), F.floor(F.lit(memory) / F.col("memory_gb"))))
    return jobs.select(
        "stage", at_once.cast("long").alias("concurrent"), (at_once * F.col("threads")).cast("long").alias("peak_threads"), (at_once * F.col("memory_gb")).cast("long").alias("peak_memory_gb"),
        ((at_once * F.col("threads") <= threads) & (at_once * F.col("memory_gb") <= memory)).alias("within"),
    )


def latest_status(events: DataFrame) -> DataFrame:
    """The last event of each module (module, at, status, ordinal), and how many there were."""
    return events.groupBy("module").agg(F.max_by("status", F.struct("at", "ordinal")).alias("status"), F.max("at").alias("at"), F.count(F.lit(1)).alias("events"))


def track_lines(tracks: DataFrame) -> DataFrame:
    """Browser descriptors, one line each (name, url, strand, color, priority), and whether they are well-formed."""
    bad = F.col("url").rlike(r"\s") | F.col("name").rlike('["\']')
    line = F.format_string(
        'track type=bigWig name="%s" description="%s" bigDataUrl=%s color=%s visibility=full autoScale=on negateValues=%s priority=%d',
        "name", "name", "url", "color", F.when(F.col("strand") == "-", "on").otherwise("off"), "priority",
    )
    return tracks.select("name", line.alias("line"), (~bad).alias("valid"))


def clock(seconds: Column) -> Column:
    """Seconds as H:MM:SS, days and more in hours; null for null, 0:00:00 below zero."""
    whole = F.greatest(F.floor(seconds), F.lit(0)).cast("long")
    return F.format_string("%d:%02d:%02d", F.floor(whole / 3600), F.floor(whole / 60) % 60, whole % 60)


def progress(events: DataFrame, total: int) -> DataFrame:
    """(step, started_at, ended_at, elapsed, done, eta) of events (step, state, at): UTC in ISO form, and
    what the steps left of ``total`` may take at the pace of those that are done."""
    iso = lambda c: F.date_format(F.to_utc_timestamp(c, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    per = events.groupBy("step").agg(F.min(F.when(F.col("state") == "started", F.col("at"))).alias("s"), F.max(F.when(F.col("state") == "done", F.col("at"))).alias("e"))
    took = (F.unix_timestamp("e") - F.unix_timestamp("s")).cast("double")
    pace = per.agg(F.count("e").alias("done"), F.avg(took).alias("mean"))
    left = F.greatest(F.lit(total) - F.col("done"), F.lit(0)) * F.col("mean")
    return per.join(F.broadcast(pace)).select("step", iso("s").alias("started_at"), iso("e").alias("ended_at"), clock(took).alias("elapsed"), "done", clock(left).alias("eta"))


def lane_reads(reads: DataFrame, lanes: DataFrame) -> DataFrame:
    """Reads (file, ...) of all lanes as their samples': adds sample_id, technical_replicate_id and lane_id.
    ``lanes`` is a sample sheet's table; reads of files that it does not name are left out."""
    named = lanes.select("file", "sample_id", "technical_replicate_id", "lane_id").distinct()
    return reads.join(F.broadcast(named), "file")


def track_inventory(tracks: DataFrame) -> DataFrame:
    """(collection, family, tracks, minus) of tracks (path, strand): a collection is a path's folder, its
    family the first part of it."""
    folder = F.regexp_replace("path", "/[^/]*$", "")
    per = tracks.groupBy(folder.alias("collection")).agg(F.count(F.lit(1)).alias("tracks"), F.count_if(F.col("strand") == "-").alias("minus"))
    return per.withColumn("family", F.substring_index("collection", "/", 1))


def module_overlap(modules: DataFrame, at_once: int, threads: int, memory: int) -> DataFrame:
    """One row: the peak of ``at_once`` modules (module, threads, memory_gb) that run side by side, the
    largest by either, and whether it stays below the ceilings. Modules are a plan's few steps."""
    largest = lambda c: F.aggregate(F.slice(F.sort_array(F.collect_list(F.col(c).cast("long")), asc=False), 1, at_once), F.lit(0).cast("long"), lambda a, x: a + x)
    per = modules.agg(F.count(F.lit(1)).alias("modules"), largest("threads").alias("peak_threads"), largest("memory_gb").alias("peak_memory_gb"))
    within = (F.col("peak_threads") <= threads) & (F.col("peak_memory_gb") <= memory)
    return per.withColumn("concurrent", F.least(F.col("modules"), F.lit(at_once).cast("long"))).withColumn("within", within)
