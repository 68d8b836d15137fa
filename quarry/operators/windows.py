"""Window operators: breaks, consensus, latest rows, page groups, run lengths, forward fill, neighbour votes, line sessions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType


def time_breaks(pages: DataFrame, doc: str, page: str, ts: str) -> DataFrame:
    """doc, break_page: the first page whose time is below the largest time of any page before it; an equal time is no break."""
    before = Window.partitionBy(doc).orderBy(page).rowsBetween(Window.unboundedPreceding, -1)
    return pages.withColumn("high", F.max(ts).over(before)).where(F.col(ts) < F.col("high")).groupBy(doc).agg(F.min(page).alias("break_page"))


def consensus(versions: DataFrame, line: str, text: str, engine: Column, score: str) -> DataFrame:
    """line, text, n_engines, total_engines, ratio, score, n_ties, label: the reading with most distinct engines.

    Ties go by best score (null as -1), the longer text, the text. ``total_engines`` is the sum over the readings, so an engine
    with two readings counts twice. Label: conflict for a tie, else by ``consensus_label``.
    """
    read = versions.select(F.col(line), F.trim(text).alias("text"), engine.alias("engine"), F.col(score).alias("s")).where(F.length("text") > 0)
    groups = read.groupBy(line, "text").agg(F.countDistinct("engine").alias("n_engines"), F.coalesce(F.max("s"), F.lit(-1.0)).alias("best"))
    per = Window.partitionBy(line)
    order = per.orderBy(F.desc("n_engines"), F.desc("best"), F.desc(F.length("text")), "text")
    ranked = groups.select("*", F.sum("n_engines").over(per).alias("total_engines"), F.count("*").over(Window.partitionBy(line, "n_engines")).alias("n_ties"), F.row_number().over(order).alias("rank")).where("rank = 1")
    n, total = F.col("n_engines"), F.col("total_engines")
    return ranked.select(line, "text", "n_engines", "total_engines", (n / total).alias("ratio"), (n * n / total).alias("score"), "n_ties", consensus_label(n, total, F.col("n_ties")).alias("label"))


def consensus_label(engines: Column, total: Column, ties: Column) -> Column:
    """conflict for a tie, high if all agree, medium from max(2, ceil(0.6 total)) on, else low."""
    return F.when(ties > 1, "conflict").when((engines == total) & (total > 1), "high").when(engines >= F.greatest(F.lit(2), F.ceil(total * 0.6)), "medium").otherwise("low")


def latest(rows: DataFrame, keys: list[str], order: list[Column], since: Column | None = None) -> DataFrame:
    """The last row of each key and n_versions. ``since`` is asked of the last row only, so an older one never takes its place."""
    per = Window.partitionBy(*keys)
    ranked = rows.select("*", F.count("*").over(per).alias("n_versions"), F.row_number().over(per.orderBy(*order)).alias("_place")).where("_place = 1").drop("_place")
    return ranked if since is None else ranked.where(since)


def preferred(rows: DataFrame, key: str, id_col: str, current: Column) -> DataFrame:
    """key, chosen: the largest id among current rows, or among all where none is current."""
    return rows.groupBy(key).agg(F.coalesce(F.max(F.when(current, F.col(id_col))), F.max(id_col)).alias("chosen"))


def page_groups(pages: DataFrame, volume: str, page: str, size: int) -> DataFrame:
    """The pages with ``group_no``: groups of ``size`` consecutive rows of a volume, from 0."""
    place = F.row_number().over(Window.partitionBy(volume).orderBy(page))
    return pages.withColumn("group_no", F.floor((place - 1) / size))


def fill_identity(groups: DataFrame, volume: str, order: str, series: str, tome: str, part: str) -> DataFrame:
    """Series, tome and part carried forward; a new tome resets the part.

    Series and part count only where a tome is declared with them.
    """
    declared = F.col(tome).isNotNull()
    ordered = Window.partitionBy(volume).orderBy(order)
    carried = groups.withColumn("full_series", F.last(F.when(declared, F.col(series)), ignorenulls=True).over(ordered)).withColumn("full_tome", F.last(tome, ignorenulls=True).over(ordered))
    changed = F.coalesce(F.col("full_tome") != F.lag("full_tome").over(ordered), F.col("full_tome").isNotNull())
    runs = carried.withColumn("_run", F.sum(changed.cast("int")).over(ordered))
    return runs.withColumn("full_part", F.last(F.when(declared, F.col(part)), ignorenulls=True).over(Window.partitionBy(volume, "_run").orderBy(order))).drop("_run")


def segments(rows: DataFrame, doc: str, order: str, value: str) -> DataFrame:
    """doc, segment, value, first, last, n: runs of equal values (nulls are equal) in order."""
    ordered = Window.partitionBy(doc).orderBy(order)
    begins = (~F.col(value).eqNullSafe(F.lag(value).over(ordered))) | (F.row_number().over(ordered) == 1)
    runs = rows.select(doc, order, value, begins.cast("int").alias("begins")).withColumn("segment", F.sum("begins").over(ordered))
    return runs.groupBy(doc, "segment").agg(F.first(value).alias(value), F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("n"))


def inherit(rows: DataFrame, doc: str, order: list[str], file: str, section: str, target: str, is_ibid: Column, max_gap: int = 2) -> DataFrame:
    """The rows with ``inherited``: an ibid row takes the last target before it.

    The chain ends where the file number jumps by over ``max_gap`` or the section changes (both known); an ibid row hands on what it
    got (W08).
    """
    ordered = Window.partitionBy(doc).orderBy(*order)
    far = F.col(file) - F.lag(file).over(ordered) > max_gap
    other = F.col(section) != F.lag(section).over(ordered)
    broken = F.coalesce(far, F.lit(False)) | F.coalesce(other, F.lit(False))
    runs = rows.withColumn("_run", F.sum(broken.cast("int")).over(ordered))
    carried = F.last(F.when(~is_ibid, F.col(target)), ignorenulls=True).over(Window.partitionBy(doc, "_run").orderBy(*order))
    return runs.withColumn("inherited", F.when(is_ibid, carried)).drop("_run")


def neighbour_votes(pages: DataFrame, doc: str, index: str, value: str, reach: int, step: int = 1, weight: float = 1.5) -> DataFrame:
    """doc, index, candidate, votes: what the pages up to ``reach`` away say of a page's number, by weight over distance.

    Each page sends its own votes, 2 * reach rows, so no self-join is needed. One pass over the given values: votes do not change
    what later ones say.
    """
    shift = F.explode(F.array(*[F.lit(d) for d in range(-reach, reach + 1) if d])).alias("d")
    sent = pages.where(F.col(value).isNotNull()).select(doc, F.col(index).alias("_i"), F.col(value).alias("_v"), shift)
    votes = sent.select(doc, (F.col("_i") + F.col("d")).alias(index), (F.col("_v") + step * F.col("d")).alias("candidate"), (weight / F.abs("d")).alias("w"))
    found = votes.groupBy(doc, index, "candidate").agg(F.sum("w").alias("votes"))
    return found.join(pages.select(doc, index).distinct(), [doc, index], "left_semi")


def number_votes(pages: DataFrame, doc: str, page: str, header: str = "header", footer: str = "footer", body: str = "body", reach: int = 4) -> DataFrame:
    """doc, page, candidate, votes: the votes for each page's printed number.

    ``header``, ``footer`` and ``body`` are arrays of the numbers that stand there; the first four of each count 4, 3 and 1. A page's
    candidates (the first four of header and footer, without these of the body) vote for the pages up to ``reach`` places away, 1.5
    over the distance; where pages at the same distance on both sides differ by as much as their page numbers do, they add 2.5 over it.
    Numbers under 1 and over 9,999 do not count. Neighbours come from one window a document, so there is no self-join.
    """
    order = Window.partitionBy(doc).orderBy(page)
    own = F.when(F.size(header) + F.size(footer) > 0, F.concat(header, footer)).otherwise(F.slice(body, 1, 4))
    rows = pages.select(doc, page, header, footer, body, F.slice(F.filter(own, lambda x: (x > 0) & (x < 10000)), 1, 4).alias("_c"))
    near = {f"_{k}{d}": f("_c" if k in "ba" else page, d).over(order) for d in range(1, reach + 1) for k, f in (("b", F.lag), ("a", F.lead), ("p", F.lag), ("n", F.lead))}
    rows = rows.select("*", *[column.alias(name) for name, column in near.items()])

    def vote(shift, weight):
        return lambda x: F.struct((x + shift).alias("candidate"), F.lit(weight).cast("double").alias("w"))

    parts = [F.transform(F.slice(c, 1, 4), vote(0, w)) for c, w in ((header, 4.0), (footer, 3.0), (body, 1.0))]
    for d in range(1, reach + 1):
        before, after, gap = F.col(f"_b{d}"), F.col(f"_a{d}"), F.col(f"_n{d}") - F.col(f"_p{d}")
        agreed = F.filter(F.zip_with(before, after, lambda x, y: F.when(y - x == gap, x)), lambda x: x.isNotNull())
        parts += [F.transform(before, vote(d, 1.5 / d)), F.transform(after, vote(-d, 1.5 / d)), F.transform(agreed, vote(d, 2.5 / d))]
    none = F.array().cast("array<struct<candidate:bigint,w:double>>")
    votes = rows.select(doc, page, F.explode(F.concat(*[F.coalesce(p, none) for p in parts])).alias("v")).where("v.candidate between 1 and 9999")
    return votes.groupBy(doc, page, F.col("v.candidate").alias("candidate")).agg(F.round(F.sum("v.w"), 9).alias("votes"))


def inferred_numbers(votes: DataFrame, keys: list[str]) -> DataFrame:
    """keys, candidate, votes, confidence: 0.15 + 0.55 of its share + a sixth of its margin (0.3 at most), 1 at most.

    Ties go to the smaller candidate.
    """
    order, whole = Window.partitionBy(*keys).orderBy(F.desc("votes"), "candidate"), Window.partitionBy(*keys)
    ranked = votes.select("*", F.sum("votes").over(whole).alias("total"), F.lead("votes").over(order).alias("second"), F.row_number().over(order).alias("rank")).where("rank = 1")
    margin = F.col("votes") - F.coalesce("second", F.lit(0.0))
    confidence = F.least(F.lit(1.0), 0.15 + 0.55 * F.col("votes") / F.col("total") + F.least(F.lit(0.3), margin / 6))
    return ranked.select(*keys, "candidate", "votes", confidence.alias("confidence"))


def best_candidate(votes: DataFrame, keys: list[str]) -> DataFrame:
    """keys, candidate, votes, margin (to the second; its own votes if there is none), ties to the smaller candidate."""
    order = Window.partitionBy(*keys).orderBy(F.desc("votes"), "candidate")
    ranked = votes.select("*", F.lead("votes").over(order).alias("second"), F.row_number().over(order).alias("rank")).where("rank = 1")
    return ranked.select(*keys, "candidate", "votes", (F.col("votes") - F.coalesce("second", F.lit(0.0))).alias("margin"))


def bracketed_offsets(pages: DataFrame, doc: str, index: str, value: str, reach: int = 16, step: int = 2, least: int = 3) -> DataFrame:
    """doc, index, offset, n, weight: an offset (value - step * index) that pages on both sides, ``least`` in all, share within reach."""
    known = pages.where(F.col(value).isNotNull()).select(doc, F.col(index).alias("_i"), (F.col(value) - step * F.col(index)).alias("offset"))
    shift = F.explode(F.sequence(F.lit(-reach), F.lit(reach))).alias("d")
    near = known.select("*", shift).select(doc, (F.col("_i") + F.col("d")).alias(index), "offset", "d").where("d <> 0")
    found = near.groupBy(doc, index, "offset").agg(F.count("*").alias("n"), F.max((F.col("d") < 0).cast("int")).alias("after"), F.max((F.col("d") > 0).cast("int")).alias("before"))
    kept = found.where((F.col("n") >= least) & (F.col("after") == 1) & (F.col("before") == 1)).join(pages.select(doc, index).distinct(), [doc, index], "left_semi")
    return kept.select(doc, index, "offset", "n", (8 + F.least(F.lit(2.0), 0.25 * F.col("n"))).alias("weight"))


def validated(pages: DataFrame, doc: str, index: str, value: str, reach: int = 8, anchors: int = 2, step: int = 2) -> DataFrame:
    """The rows with ``valid``: within ``reach`` at least ``anchors`` pages on each side have the same offset and none has another that
    as many support (W11)."""
    known = pages.where(F.col(value).isNotNull()).select(doc, F.col(index).alias("_i"), (F.col(value) - step * F.col(index)).alias("offset"))
    shift = F.explode(F.sequence(F.lit(-reach), F.lit(reach))).alias("d")
    near = known.select("*", shift).select(doc, (F.col("_i") + F.col("d")).alias(index), "offset", "d").where("d <> 0")
    sides = near.groupBy(doc, index, "offset").agg(F.sum((F.col("d") < 0).cast("int")).alias("after"), F.sum((F.col("d") > 0).cast("int")).alias("before"))
    strong = sides.where((F.col("after") >= anchors) & (F.col("before") >= anchors)).groupBy(doc, index).agg(F.count("*").alias("n_strong"), F.max("offset").alias("strong"))
    joined = pages.join(strong, [doc, index], "left")
    return joined.withColumn("valid", F.coalesce((F.col("n_strong") == 1) & (F.col("strong") == F.col(value) - step * F.col(index)), F.lit(False))).drop("n_strong", "strong")


def widest_gap(words: DataFrame, keys: list[str], left: str, width: str, centre: Column, reach: float, least: float) -> DataFrame:
    """keys, split_at, gap: the widest gap of at least ``least`` between neighbouring words whose middle is near the centre."""
    after = F.lead(left).over(Window.partitionBy(*keys).orderBy(left, width))
    end = F.col(left) + F.col(width)
    gaps = words.select(*keys, end.alias("_end"), (after - end).alias("gap"), centre.alias("_centre"))
    middle = F.col("_end") + F.col("gap") / 2
    return gaps.where((F.col("gap") >= least) & (F.abs(middle - F.col("_centre")) <= reach)).groupBy(*keys).agg(F.max_by(F.struct(middle.alias("split_at"), F.col("gap")), F.struct("gap", -middle)).alias("b")).select(*keys, "b.*")


def line_sessions(words: DataFrame, keys: list[str], top: str, left: str, tolerance: float) -> DataFrame:
    """The words with ``line_no``: a word opens a line if it stands over ``tolerance`` below the word that opened the last one.

    The distance is to the line's first word, so the rule needs a page's words in order: they are sorted within partitions and read as
    a stream, of which only the open line is held.
    """
    schema = StructType([*words.schema.fields, StructField("line_no", IntegerType())])

    def assign(batches):
        page, anchor, line = None, 0.0, -1
        for batch in batches:
            numbers = []
            for *now, y in zip(*(batch[k] for k in keys), batch[top]):
                if now != page:
                    page, anchor, line = now, y, 0
                elif y - anchor > tolerance:
                    anchor, line = y, line + 1
                numbers.append(line)
            yield batch.assign(line_no=pd.Series(numbers, dtype="int32", index=batch.index))

    return words.repartition(*keys).sortWithinPartitions(*keys, top, left).mapInPandas(assign, schema)


def version_diffs(versions: DataFrame, keys: list[str], order: list[str], text: str) -> DataFrame:
    """keys, order, insertions, deletions, unified: the line diff against the version before; equal versions have no row.

    A moved line counts as deleted and inserted. The pairs come from one window a document; the diff itself is no SQL.
    """
    import difflib

    per = Window.partitionBy(*keys).orderBy(*order)
    pairs = versions.select(*keys, *order, F.col(text).alias("_now"), F.lag(text).over(per).alias("_was")).where("_was is not null and _was <> _now")

    @F.pandas_udf("insertions int, deletions int, unified string")
    def diff(was: pd.Series, now: pd.Series) -> pd.DataFrame:
        out = []
        for a, b in zip(was, now):
            lines = list(difflib.unified_diff(a.splitlines(keepends=True), b.splitlines(keepends=True), "before", "after"))
            out.append((sum(x.startswith("+") for x in lines[2:]), sum(x.startswith("-") for x in lines[2:]), "".join(lines)))
        return pd.DataFrame(out, columns=["insertions", "deletions", "unified"])

    return pairs.select(*keys, *order, diff("_was", "_now").alias("d")).select(*keys, *order, "d.*")


def next_trusted(starts: DataFrame, doc: str, page: str, confidence: str, least: float = 0.70) -> DataFrame:
    """doc, page, next_start: the first later page with exactly one start candidate, of enough confidence."""
    pages = starts.groupBy(doc, page).agg(F.count("*").alias("n"), F.max(confidence).alias("c"))
    trusted = F.when((F.col("n") == 1) & (F.col("c") >= least), F.col(page))
    later = Window.partitionBy(doc).orderBy(page).rowsBetween(1, Window.unboundedFollowing)
    return pages.select(doc, page, F.min(trusted).over(later).alias("next_start"))
