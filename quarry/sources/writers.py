"""Distributed writers: each task writes its own part files (no driver-side file)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.sources.lines import csv_cell, write_group_lines


def write_ratings(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with header ``user,movie,rating``, sorted by user then item."""
    (df.select("user", F.col("item").alias("movie"), "rating").orderBy("user", "movie")
     .write.mode(mode).option("header", True).csv(path))


def write_clusters(clusters: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Text lines ``key:val(n),val(n)`` (members by count descending), a cluster of any size streamed into its line."""
    write_group_lines(clusters, path, F.col("fingerprint"), [-F.col("count"), F.col("value")],
                      F.format_string("%s(%d)", F.col("value"), F.col("count")), F.concat(F.col("fingerprint"), F.lit(":")), mode=mode)


def write_group_rows(groups: DataFrame, path: str, group: str = "group_name", member: str = "member", mode: str = "overwrite") -> None:
    """CSV rows of unequal length, one per match group: its members in order, streamed."""
    write_group_lines(groups, path, F.col(group), [F.col(member)], csv_cell(F.col(member).cast("string")), mode=mode)


def write_score_lines(scores: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Two lines, the hub scores of all nodes in string order and then their authority scores, one space between scores."""
    sides = scores.select(F.col("node").cast("string").alias("node"), F.explode(F.array(
        F.struct(F.lit(0).alias("line"), F.col("hub").alias("score")), F.struct(F.lit(1).alias("line"), F.col("authority").alias("score")))).alias("s"))
    write_group_lines(sides, path, F.col("s.line"), [F.col("node")], F.col("s.score").cast("string"), sep=" ", mode=mode)


def write_scores(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet") -> None:
    df.write.mode(mode).format(fmt).save(path)


def write_rules(rules: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Text lines ``a,b -> c confidence`` per rule."""
    line = F.format_string("%s -> %s %s", F.array_join(F.transform("antecedent", lambda x: x.cast("string")), ","),
                           F.col("consequent").cast("string"), F.col("confidence").cast("string"))
    rules.select(line.alias("value")).write.mode(mode).text(path)


def write_hits(scores: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Text lines ``node<TAB>hub<TAB>authority``, sorted by node."""
    line = F.concat_ws("\t", F.col("node").cast("string"), F.col("hub").cast("string"), F.col("authority").cast("string"))
    scores.orderBy("node").select(line.alias("value")).write.mode(mode).text(path)


def write_itemsets(itemsets: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Text lines ``a,b: support``, sorted by size, then items."""
    line = F.format_string("%s: %s", F.array_join(F.transform("items", lambda x: x.cast("string")), ","),
                           F.col("support").cast("string"))
    itemsets.orderBy("size", "items").select(line.alias("value")).write.mode(mode).text(path)


def write_groups(groups: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Long-form match groups as parquet (one row per member)."""
    groups.write.mode(mode).parquet(path)
