"""Grouped aggregates: gaps, rank scores, argmax choices, masks, histograms, coverage, votes, centroids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def missing_ranges(pages: DataFrame, doc: str, page: str) -> DataFrame:
    """doc, first_missing, last_missing, n_missing, label (``a-b`` or ``a``) for each hole in a document's page numbers.

    A hole lies between a page and the next larger one, so nothing is enumerated and no task holds a document's range.
    """
    after = F.lead(page).over(Window.partitionBy(doc).orderBy(page))
    holes = pages.select(doc, page).where(F.col(page).isNotNull()).distinct().withColumn("after", after).where(F.col("after") > F.col(page) + 1)
    first, last = F.col(page) + 1, F.col("after") - 1
    label = F.when(first == last, first.cast("string")).otherwise(F.concat_ws("-", first.cast("string"), last.cast("string")))
    return holes.select(doc, first.alias("first_missing"), last.alias("last_missing"), (last - first + 1).alias("n_missing"), label.alias("label"))


def missing_pages(pages: DataFrame, doc: str, page: str) -> DataFrame:
    """doc, missing: one row for each missing page number."""
    return missing_ranges(pages, doc, page).select(doc, F.explode(F.sequence("first_missing", "last_missing")).alias("missing"))


def documents_with_gaps(pages: DataFrame, doc: str, page: str) -> DataFrame:
    """doc, first_page, last_page, n_rows, n_gap where the range of pages exceeds the number of rows."""
    found = pages.groupBy(doc).agg(F.min(page).alias("first_page"), F.max(page).alias("last_page"), F.count("*").alias("n_rows"))
    gap = F.col("last_page") - F.col("first_page") + 1 - F.col("n_rows")
    return found.withColumn("n_gap", gap).where("n_gap > 0")


def rank_score(occurrences: DataFrame, key: str, rank: str, k: float = 60.0) -> DataFrame:
    """key, score (sum of 1 / (k + rank) over rows with a rank), n_occurrences."""
    return occurrences.groupBy(key).agg(F.sum(1 / (F.lit(k) + F.col(rank))).alias("score"), F.count("*").alias("n_occurrences"))


def group_mass(scores: DataFrame, members: DataFrame, key: str, group: str) -> DataFrame:
    """group, mass: the sum of the scores of the group's members."""
    return scores.join(members.select(key, group), key).groupBy(group).agg(F.sum("score").alias("mass"))


def distinct_pages(occurrences: DataFrame, members: DataFrame, key: str, group: str, page: str) -> DataFrame:
    """group, n_pages: pages on which any member occurs; two members on one page count once."""
    return occurrences.join(members.select(key, group), key).groupBy(group).agg(F.countDistinct(page).alias("n_pages"))


def top_members(counts: DataFrame, group: str, key: str, n: str, k: int, min_count: int) -> DataFrame:
    """group, group_total, members: the k largest keys with at least ``min_count``, in order; total over all keys that reach it."""
    kept = counts.where(F.col(n) >= min_count)
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.desc(n), key))
    total = F.sum(n).over(Window.partitionBy(group))
    top = kept.select(group, key, n, rank.alias("rank"), total.alias("group_total")).where(F.col("rank") <= k)
    names = F.transform(F.array_sort(F.collect_list(F.struct("rank", F.col(key).cast("string").alias("name")))), lambda x: x["name"])
    return top.groupBy(group, "group_total").agg(F.array_join(names, ",").alias("members"))


def argmax(rows: DataFrame, group: str, order: list[Column], value: dict[str, Column]) -> DataFrame:
    """group and the value columns of its row that is largest by ``order`` (compared in turn)."""
    best = F.max_by(F.struct(*[c.alias(n) for n, c in value.items()]), F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)]))
    return rows.groupBy(group).agg(best.alias("best")).select(group, "best.*")


def label_score(pages: Column, probability: Column, label: Column) -> Column:
    """How good a label stands for its cluster: ln(1 + pages) + 1.5 probability - 0.12 words - 0.01 characters."""
    return F.log1p(pages) + 1.5 * probability - 0.12 * F.size(F.split(label, " ")) - 0.01 * F.length(label)


def origin_masks(mentions: DataFrame, keys: list[str], bit: Column) -> DataFrame:
    """keys, mask (bits of all mentions joined by or), n_mentions."""
    return mentions.withColumn("bit", bit).groupBy(*keys).agg(F.bit_or("bit").alias("mask"), F.count("*").alias("n_mentions"))


def frequencies(terms: DataFrame, doc: str, array: str) -> DataFrame:
    """term, df: in how many documents a term of the array column stands."""
    return terms.select(doc, F.explode(F.array_distinct(array)).alias("term")).groupBy("term").agg(F.count("*").alias("df"))


def profile(rows: DataFrame, dimensions: list[str]) -> DataFrame:
    """dimension, value, n: the histograms of several columns in one pass (grouping sets)."""
    id_of = F.grouping_id(*dimensions)
    sets = rows.groupingSets([[d] for d in dimensions], *dimensions).agg(F.count("*").alias("n"), id_of.alias("gid"))
    m = len(dimensions)
    full = (1 << m) - 1
    name = F.coalesce(*[F.when(F.col("gid") == full - (1 << (m - 1 - i)), F.lit(d)) for i, d in enumerate(dimensions)])
    value = F.coalesce(*[F.when(F.col("gid") == full - (1 << (m - 1 - i)), F.col(d).cast("string")) for i, d in enumerate(dimensions)])
    return sets.select(name.alias("dimension"), value.alias("value"), "n")


def duplicate_surplus(rows: DataFrame, by: str, columns: list[str]) -> DataFrame:
    """by, surplus: how many rows exceed the first of each group of equal rows. Texts are compared by digest."""
    groups = rows.groupBy(by, *columns).agg(F.count("*").alias("n")).where("n > 1")
    return groups.groupBy(by).agg(F.sum(F.col("n") - 1).alias("surplus"))


def partial_sets(rows: DataFrame, key: str, member: str, size: int) -> DataFrame:
    """key, n_members where some but not all of ``size`` members are there."""
    return rows.groupBy(key).agg(F.countDistinct(member).alias("n_members")).where(F.col("n_members").between(1, size - 1))


def coverage(rows: DataFrame, by: str, covered: Column) -> DataFrame:
    """by, total, n_covered, ratio (4 places; 0 for none)."""
    found = rows.groupBy(by).agg(F.count("*").alias("total"), F.sum(F.when(covered, 1).otherwise(0)).alias("n_covered"))
    return found.withColumn("ratio", F.when(F.col("total") == 0, 0.0).otherwise(F.round(F.col("n_covered") / F.col("total"), 4)))


def single_links(rows: DataFrame, key: str, target: str) -> DataFrame:
    """key, target where a key has exactly one row, so the link is beyond doubt."""
    return rows.groupBy(key).agg(F.min(target).alias("target"), F.count("*").alias("n")).where("n = 1").select(key, "target")


def running_lines(pages: DataFrame, doc: str, page: str, line: Column, min_pages: int = 3, min_ratio: float = 0.05, max_chars: int = 240) -> DataFrame:
    """doc, line, n_pages: lines on max(min_pages, ceil(pages * min_ratio)) pages of a document or more, once a page."""
    total = pages.groupBy(doc).agg(F.countDistinct(page).alias("pages"))
    lines = pages.select(doc, page, line.alias("line")).where(F.length("line").between(1, max_chars)).distinct()
    found = lines.groupBy(doc, "line").agg(F.count("*").alias("n_pages")).join(total, doc)
    return found.where(F.col("n_pages") >= F.greatest(F.lit(min_pages), F.ceil(F.col("pages") * min_ratio))).select(doc, "line", "n_pages")


def weighted_vote(votes: DataFrame, item: str, text: str, weight: Column, score: str) -> DataFrame:
    """item, winner, agreement (its share of the weight), best_score, n_texts; order: weight, agreement, best score, text."""
    sums = votes.groupBy(item, text).agg(F.sum(weight).alias("w"), F.max(score).alias("best"))
    ranked = sums.groupBy(item).agg(F.max_by(F.struct(F.col(text).alias("winner"), "w", "best"), F.struct("w", "best", text)).alias("top"), F.sum("w").alias("total"), F.count("*").alias("n_texts"))
    return ranked.select(item, "top.winner", (F.col("top.w") / F.col("total")).alias("agreement"), F.col("top.best").alias("best_score"), "n_texts")


def unit(vector: Column) -> Column:
    """The vector over its length; null for a zero vector."""
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x * x))
    return F.when(norm > 0, F.transform(vector, lambda x: x / norm))


def centroids(rows: DataFrame, keys: list[str], vector: str) -> DataFrame:
    """keys, centroid, n: the normalised mean of unit vectors; zero vectors do not count.

    Sums are made by coordinate before the shuffle, so a key of any size costs a task one partial sum for each coordinate.
    """
    flat = rows.select(*keys, unit(F.transform(vector, lambda x: x.cast("double"))).alias("u")).where("u is not null").select(*keys, F.posexplode("u"))
    sums = flat.groupBy(*keys, "pos").agg(F.avg("col").alias("mean"), F.count("*").alias("n"))
    joined = sums.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "mean"))), lambda x: x["mean"]).alias("mean"), F.max("n").alias("n"))
    return joined.select(*keys, unit(F.col("mean")).alias("centroid"), "n")


def ordered_concat(rows: DataFrame, key: str, text: Column, order: list[str], separator: str = "; ") -> DataFrame:
    """key, joined: the trimmed, non-empty texts in order."""
    part = rows.withColumn("part", F.nullif(F.trim(text), F.lit(""))).where("part is not null")
    return part.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, "part"))), lambda x: x["part"]), separator).alias("joined"))
