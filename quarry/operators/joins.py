"""Joins: theta and interval joins, latest-row lookups, facsimiles, overlaps, cross references, snapshot differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import iou


def seed_links(seeds: DataFrame, occurrences: DataFrame, pages: DataFrame, volume: str, page: str) -> DataFrame:
    """seed_id, occurrence_id, score: book and chapter agree, and the verse does or the seed has none; 0.99 if the occurrence's page is
    among the seed's pages, else 0.82 (J01).

    ``seeds``: seed_id, book, chapter, verse; ``occurrences``: occurrence_id, book, chapter, verse, volume, page; ``pages``: seed_id,
    volume, page.
    """
    o = occurrences.withColumnRenamed("verse", "_verse")
    linked = seeds.join(o, ["book", "chapter"]).where(F.col("verse").isNull() | (F.col("verse") == F.col("_verse")))
    known = pages.select("seed_id", volume, page).distinct().withColumn("_known", F.lit(True))
    score = F.when(F.col("_known"), 0.99).otherwise(0.82)
    return linked.join(known, ["seed_id", volume, page], "left").select("seed_id", "occurrence_id", score.alias("score"))


def seed_link_counts(seeds: DataFrame, occurrences: DataFrame, pages: DataFrame, group: str, volume: str, page: str) -> DataFrame:
    """seed_id, score, n: how many links of ``seed_links`` each seed has by score, without a row for each link.

    ``seeds``: seed_id, book, chapter, verse and a group whose seeds have the same pages; ``occurrences``: book, chapter, verse, volume,
    page; ``pages``: group, volume, page. Occurrences are counted by place, those on a group's pages once more by place and group; a
    seed without a verse takes its chapter's counts.
    """
    def counted(rows: DataFrame, *more: str) -> DataFrame:
        verses = rows.groupBy("book", "chapter", "verse", *more).agg(F.count("*").alias("n"))
        chapters = verses.groupBy("book", "chapter", *more).agg(F.sum("n").alias("n")).withColumn("verse", F.lit(None).cast(verses.schema["verse"].dataType))
        both = chapters.unionByName(verses.where("verse is not null")).withColumnRenamed("verse", "_verse")
        return seeds.join(both, ["book", "chapter", *more]).where(F.col("verse").eqNullSafe(F.col("_verse")))

    known = counted(occurrences.join(pages.select(group, volume, page).distinct(), [volume, page]), group)
    at = lambda score, known: [F.lit(score).alias("score"), (F.col("n") * known).alias("n")]
    links = counted(occurrences).select("seed_id", *at(0.82, 1)).unionByName(known.select("seed_id", *at(0.82, -1))).unionByName(known.select("seed_id", *at(0.99, 1)))
    return links.groupBy("seed_id", "score").agg(F.sum("n").alias("n")).where("n > 0")


def left_counts(left: DataFrame, right: DataFrame, key: str, id_col: str) -> DataFrame:
    """``left`` with n: its rows on the right, 0 for none. The right side is counted before the join."""
    counts = right.groupBy(key).agg(F.count(id_col).alias("n"))
    return left.join(counts, key, "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))


def current_or(left: DataFrame, versions: DataFrame, key: str, current: Column, value: str, fallback: str) -> DataFrame:
    """key, value: that of the current version if it is not empty, else the row's own (J06: the condition is asked before the join)."""
    now = versions.where(current).groupBy(key).agg(F.max(value).alias("_now"))
    return left.join(now, key, "left").select(key, F.coalesce(F.nullif("_now", F.lit("")), F.col(fallback)).alias(value))


def work_intervals(works: DataFrame, volume: str, start: str, end: str, confidence: str, last_page: DataFrame) -> DataFrame:
    """The works with ``last`` and ``sure``: their end, else the next distinct start less 1 (confidence at most 0.65), else the volume's
    last page (at most 0.50); never before the start (J07). ``last_page``: volume, last_page."""
    starts = works.select(volume, start).distinct()
    starts = starts.withColumn("_next", F.lead(start).over(Window.partitionBy(volume).orderBy(start)))
    joined = works.join(starts, [volume, start]).join(last_page, volume)
    ends = F.when(F.col(end).isNotNull(), F.col(end)).when(F.col("_next").isNotNull(), F.col("_next") - 1).otherwise(F.col("last_page"))
    most = F.when(F.col(end).isNotNull(), F.lit(1.0)).when(F.col("_next").isNotNull(), 0.65).otherwise(0.50)
    return joined.withColumn("last", F.greatest(ends, F.col(start))).withColumn("sure", F.least(F.col(confidence), most)).drop("_next", "last_page")


def innermost(points: DataFrame, intervals: DataFrame, key: str, at: str, start: str, end: str, value: str, bucket: int = 256) -> DataFrame:
    """key, at, value: of the interval with the largest start that holds the point; ties to the larger value.

    A range join by buckets: an interval goes to each bucket of ``bucket`` places that it touches, a point to its own, so the join has
    an equality and long intervals cost one row for each bucket.
    """
    spread = F.explode(F.sequence(F.floor(F.col(start) / bucket), F.floor(F.col(end) / bucket)))
    placed = intervals.where(F.col(start) <= F.col(end)).select(key, F.col(start).alias("_s"), F.col(end).alias("_e"), F.col(value).alias("_v"), spread.alias("_b"))
    asked = points.select(key, at).distinct().withColumn("_b", F.floor(F.col(at) / bucket))
    hits = asked.join(placed, [key, "_b"]).where(F.col(at).between(F.col("_s"), F.col("_e")))
    return hits.groupBy(key, at).agg(F.max_by("_v", F.struct("_s", "_v")).alias(value))


def facsimiles(pages: DataFrame, volume: str, page: str, digest: str) -> DataFrame:
    """left_volume, right_volume, n_pairs: equal page images of two volumes, matched one to one in page order."""
    numbered = pages.select(volume, page, digest, F.row_number().over(Window.partitionBy(volume, digest).orderBy(page)).alias("_n"))
    side = lambda name: numbered.select(F.col(volume).alias(f"{name}_volume"), digest, "_n")
    pairs = side("left").join(side("right"), [digest, "_n"]).where("left_volume < right_volume")
    return pairs.groupBy("left_volume", "right_volume").agg(F.count("*").alias("n_pairs"))


def shared_hashes(pages: DataFrame, volume: str, hashes: dict[str, str]) -> DataFrame:
    """left_volume, right_volume, kinds: which kinds of hash two volumes share, joined by ``+``.

    Each volume sends a hash once, so a hash that many pages share is one row for each volume.
    """
    each = None
    for kind, column in hashes.items():
        part = pages.where(F.col(column).isNotNull()).select(F.col(volume).alias("v"), F.lit(kind).alias("kind"), F.col(column).alias("h")).distinct()
        each = part if each is None else each.unionByName(part)
    left, right = each.withColumnRenamed("v", "left_volume"), each.withColumnRenamed("v", "right_volume")
    pairs = left.join(right, ["kind", "h"]).where("left_volume < right_volume").select("left_volume", "right_volume", "kind").distinct()
    return pairs.groupBy("left_volume", "right_volume").agg(F.array_join(F.array_sort(F.collect_set("kind")), "+").alias("kinds"))


def box_conflicts(boxes: DataFrame, page: str, id_col: str, box: tuple[str, str, str, str], least: float = 0.80, cell: float = 250.0) -> DataFrame:
    """a, b, overlap: pairs of boxes of one page with intersection over union of at least ``least``.

    Boxes that overlap so much share a corner region: each is sent to the grid cells of its centre and the eight around it only on
    one side, so the join is an equality on page and cell.
    """
    x1, y1, x2, y2 = box
    centre = boxes.where((F.col(x2) > F.col(x1)) & (F.col(y2) > F.col(y1))).select(
        page, F.col(id_col).alias("id"), *[F.col(c).cast("double").alias(n) for c, n in zip(box, ("x1", "y1", "x2", "y2"))]
    )
    spread = lambda a, b: F.sequence(F.floor(F.col(a) / cell), F.floor(F.col(b) / cell))
    cells = centre.withColumn("cx", F.explode(spread("x1", "x2"))).withColumn("cy", F.explode(spread("y1", "y2")))
    left = cells.select(page, "cx", "cy", *[F.col(c).alias(f"l_{c}") for c in ("id", "x1", "y1", "x2", "y2")])
    right = cells.select(page, "cx", "cy", *[F.col(c).alias(f"r_{c}") for c in ("id", "x1", "y1", "x2", "y2")])
    pairs = left.join(right, [page, "cx", "cy"]).where("l_id < r_id")
    # A pair counts in the cell of its intersection's first corner, so it is seen once.
    first = lambda c, n: F.floor(F.greatest(f"l_{n}", f"r_{n}") / cell) == F.col(c)
    sides = lambda s: tuple(F.col(f"{s}_{n}") for n in ("x1", "y1", "x2", "y2"))
    overlap = iou(sides("l"), sides("r"))
    return pairs.where(first("cx", "x1") & first("cy", "y1")).withColumn("overlap", overlap).where(F.col("overlap") >= least).select(page, F.col("l_id").alias("a"), F.col("r_id").alias("b"), "overlap")


def cross_references(asks: DataFrame, targets: DataFrame, volume: str, key: str, name: str) -> DataFrame:
    """volume, key, name, target, how: the target of the same volume with the same name, else the one that contains the name as a
    beginning or a word, nearest in length, then by name (J15).

    The second step joins on words of the target's name, not on all pairs of a volume.
    """
    goal = targets.select(volume, F.col(name).alias("target")).distinct()
    exact = asks.join(goal, (asks[volume] == goal[volume]) & (asks[name] == goal["target"])).select(asks[volume], key, name, "target", F.lit("exact").alias("how"))
    rest = asks.join(exact.select(volume, key), [volume, key], "left_anti")
    first = F.split(F.col(name), " ")[0]
    by_word = goal.select(volume, "target", F.explode(F.array_distinct(F.split("target", " "))).alias("_w"))
    near = rest.withColumn("_w", first).join(by_word, [volume, "_w"]).where(F.contains(F.concat(F.lit(" "), "target", F.lit(" ")), F.concat(F.lit(" "), F.col(name), F.lit(" "))))
    order = Window.partitionBy(volume, key).orderBy(F.abs(F.length("target") - F.length(name)), "target")
    found = near.withColumn("_r", F.row_number().over(order)).where("_r = 1").select(volume, key, name, "target", F.lit("contains").alias("how"))
    return exact.unionByName(found)


def snapshot_changes(before: DataFrame, after: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """key, change: added, removed, or changed in one of the columns."""
    b, a = before.select(key, *columns), after.select(key, *columns)
    added = a.join(b, key, "left_anti").select(key, F.lit("added").alias("change"))
    removed = b.join(a, key, "left_anti").select(key, F.lit("removed").alias("change"))
    differs = F.lit(False)
    for c in columns:
        differs = differs | ~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    changed = a.alias("a").join(b.alias("b"), key).where(differs).select(key, F.lit("changed").alias("change"))
    return added.unionByName(removed).unionByName(changed)


def latest_ties(rows: DataFrame, key: str, ts: str, quality: Column) -> DataFrame:
    """The rows of each key's largest time, all of them, of which ``quality`` holds."""
    return rows.join(rows.groupBy(key).agg(F.max(ts).alias(ts)), [key, ts], "left_semi").where(quality)


def with_several(rows: DataFrame, key: str, member: str, least: int = 2) -> DataFrame:
    """The rows of keys that have ``least`` distinct members."""
    keys = rows.groupBy(key).agg(F.countDistinct(member).alias("n")).where(F.col("n") >= least).select(key)
    return rows.join(keys, key, "left_semi")


def latest_lookup(left: DataFrame, events: DataFrame, key: str, at: str, ts: str, value: str, default: str) -> DataFrame:
    """``left`` with the value of the last event at or before its time; ``default`` where there is none (K02: an as-of join).

    Both sides go through one window ordered by time; nothing is paired.
    """
    columns = left.columns
    asks = left.select("*", F.col(at).alias("_t"), F.lit(1).alias("_side"), F.lit(None).cast(events.schema[value].dataType).alias("_v"))
    told = events.select(F.col(key), F.col(ts).alias("_t"), F.lit(0).alias("_side"), F.col(value).alias("_v"))
    both = asks.unionByName(told, allowMissingColumns=True)
    seen = F.last("_v", ignorenulls=True).over(Window.partitionBy(key).orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0))
    return both.withColumn(value, F.coalesce(seen, F.lit(default))).where("_side = 1").select(*columns, value)
