"""Search and evaluation: inverted index, BM25, boolean queries, rank fusion, vector neighbours, selection, metrics, sampling."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import cosine, draw
from ..functions.text import letters

# --- text search


def index(docs: DataFrame, id_col: str, text: Column, least: int = 1) -> DataFrame:
    """doc, term, tf, length: the postings of folded words."""
    terms = docs.select(F.col(id_col).alias("doc"), letters(text, least).alias("t")).select("doc", F.size("t").alias("length"), F.explode("t").alias("term"))
    return terms.groupBy("doc", "term", "length").agg(F.count("*").alias("tf"))


def mean_length(docs: DataFrame, text: Column, least: int = 1) -> tuple[int, float]:
    """The number of documents and the mean number of their words, without an index."""
    row = docs.agg(F.count("*").alias("n"), F.avg(F.size(letters(F.coalesce(text, F.lit("")), least))).alias("mean")).first()
    return row["n"], row["mean"] or 1.0


def bm25(postings: DataFrame, query: list[str], n_docs: int, mean_length: float, k1: float = 1.2, b: float = 0.75, every: bool = False) -> DataFrame:
    """doc, score, n_terms of documents with a query term, or with every one.

    The query's postings are filtered at the scan; only they are grouped.
    """
    terms = sorted(set(query))
    asked = postings.where(F.col("term").isin(*terms))
    df = asked.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log(1 + (n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("length") / F.lit(mean_length)))
    found = asked.join(F.broadcast(df), "term").groupBy("doc").agg(F.sum(weight).alias("score"), F.count("*").alias("n_terms"))
    return found.where(F.col("n_terms") == len(terms)) if every else found


def top(scored: DataFrame, k: int, *ties: str, score: str = "score") -> DataFrame:
    """The k best rows by score, then the tie columns."""
    return scored.orderBy(F.desc(score), *ties).limit(k)


def importance(postings: DataFrame, n_docs: int, least: float = 2.01, keep: tuple[str, ...] = ()) -> DataFrame:
    """term, df, importance = n_docs / df: terms that reach ``least``, and those to keep."""
    df = postings.groupBy("term").agg(F.count("*").alias("df")).withColumn("importance", F.lit(float(n_docs)) / F.col("df"))
    kept = F.col("term").isin(*keep) if keep else F.lit(False)
    return df.where((F.col("importance") >= least) | kept)


def prefix_terms(vocabulary: DataFrame, prefix: str, most: int = 32, least: int = 3) -> DataFrame:
    """The most frequent terms with the prefix, which needs ``least`` characters."""
    if len(prefix) < least:
        return vocabulary.limit(0)
    return vocabulary.where(F.col("term").startswith(prefix)).orderBy(F.desc("df"), "term").limit(most)


def phrase(docs: DataFrame, id_col: str, words: Column, wanted: list[str]) -> DataFrame:
    """doc, n: how often the words stand in a row (R14), overlapping places too; words are looked at in the joined text, nothing is joined."""
    first, *rest = map(re.escape, wanted)
    after = "".join(f" {w}" for w in rest)
    pattern = f"(?<=^| ){first}(?={after}( |$))"
    return docs.select(F.col(id_col).alias("doc"), F.regexp_count(F.array_join(words, " "), F.lit(pattern)).alias("n")).where("n > 0")


def fuzzy_terms(vocabulary: DataFrame, word: str, most: int = 2) -> DataFrame:
    """term, distance: terms within so many edits, after their length and first letters' filter."""
    near = vocabulary.where(F.abs(F.length("term") - len(word)) <= most)
    return near.withColumn("distance", F.levenshtein("term", F.lit(word), most)).where("distance >= 0").select("term", "distance")


def rrf(lists: DataFrame, key: str, rank: str, k: int = 60) -> DataFrame:
    """key, score (sum of 1 / (k + rank)), n_lists, best_rank; ordered by score, lists, best rank, key."""
    fused = lists.groupBy(key).agg(F.sum(1.0 / (k + F.col(rank))).alias("score"), F.count("*").alias("n_lists"), F.min(rank).alias("best_rank"))
    return fused.orderBy(F.desc("score"), F.desc("n_lists"), "best_rank", key)


def query_set(queries: list[str], most: int = 4, one: int = 200, total: int = 600) -> list[str]:
    """Distinct non-empty queries (case aside), cut to ``one`` characters each and ``total`` in all."""
    out, seen, held = [], set(), 0
    for q in queries:
        q = re.sub(r"\s+", " ", q).strip()[:one]
        if not q or q.lower() in seen or len(out) == most or held + len(q) > total:
            continue
        seen.add(q.lower())
        out.append(q)
        held += len(q)
    return out


# --- boolean queries over references


@dataclass(frozen=True)
class Node:
    """A reference, or ``and`` / ``or`` of nodes."""

    kind: str
    reference: str = ""
    parts: tuple = ()

    def references(self) -> list[str]:
        return [self.reference] if self.kind == "ref" else [r for p in self.parts for r in p.references()]


def parse_boolean(text: str, most: int = 4, length: int = 400) -> Node:
    """``&&`` binds tighter than ``||``; parentheses; at most ``most`` references (P19). ValueError for what is no query."""
    if len(text) > length:
        raise ValueError("the query is too long")
    tokens = [t.strip() for t in re.split(r"(&&|\|\||[()])", text) if t.strip()]
    at = 0

    def chain(operator: str, kind: str, below):
        nonlocal at
        parts = [below()]
        while at < len(tokens) and tokens[at] == operator:
            at += 1
            parts.append(below())
        return parts[0] if len(parts) == 1 else Node(kind, parts=tuple(parts))

    def atom():
        nonlocal at
        if at == len(tokens) or tokens[at] in ("&&", "||", ")"):
            raise ValueError("a reference is missing")
        token = tokens[at]
        at += 1
        if token != "(":
            return Node("ref", token)
        inner = either()
        if at == len(tokens) or tokens[at] != ")":
            raise ValueError("a parenthesis is open")
        at += 1
        return inner

    def either():
        return chain("||", "or", lambda: chain("&&", "and", atom))

    tree = either()
    if at < len(tokens):
        raise ValueError("something follows the query")
    if len(tree.references()) > most:
        raise ValueError("too many references")
    return tree


def evaluate_boolean(tree: Node, postings: DataFrame, keys: list[str]) -> DataFrame:
    """keys, mask (bits of the matched references' postings joined), references (sorted): pages that the query accepts.

    ``postings``: reference, keys, mask. One grouping for the whole query, whatever its shape.
    """
    names = sorted(set(tree.references()))
    has = {r: F.max((F.col("reference") == r).cast("int")) for r in names}

    def test(node: Node) -> Column:
        if node.kind == "ref":
            return F.col(f"_r{names.index(node.reference)}") == 1
        first, *rest = map(test, node.parts)
        for other in rest:
            first = first & other if node.kind == "and" else first | other
        return first

    pages = postings.where(F.col("reference").isin(*names)).groupBy(*keys).agg(F.bit_or("mask").alias("mask"), F.array_sort(F.collect_set("reference")).alias("references"), *[c.alias(f"_r{i}") for i, c in enumerate(has.values())])
    return pages.where(test(tree)).select(*keys, "mask", "references")


def interval_relation(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """0 exact, 1 a contains b, 2 a is contained, 3 overlap, 99 none."""
    return F.when((a_start == b_start) & (a_end == b_end), 0).when((a_start <= b_start) & (a_end >= b_end), 1).when((a_start >= b_start) & (a_end <= b_end), 2).when((a_start <= b_end) & (b_start <= a_end), 3).otherwise(99)


def verse_position(chapter: Column, verse: Column, end: bool = False) -> Column:
    """chapter * 10000 + verse; a missing verse is 0 as a start and 9999 as an end."""
    return chapter * 10000 + F.coalesce(verse, F.lit(9999 if end else 0))


def page_of(rows: DataFrame, order: list, page: int, size: int) -> DataFrame:
    """One page of an ordered result, from 1."""
    return rows.orderBy(*order).offset((page - 1) * size).limit(size)


def keyset_page(rows: DataFrame, created: str, key: str, after: tuple | None, size: int) -> DataFrame:
    """Newest first, then by key; ``after`` is the last (created, key) of the page before."""
    if after is not None:
        rows = rows.where((F.col(created) < F.lit(after[0])) | ((F.col(created) == F.lit(after[0])) & (F.col(key) > F.lit(after[1]))))
    return rows.orderBy(F.desc(created), key).limit(size)


# --- vectors


def nearest_to(vectors: DataFrame, id_col: str, vector: str, query: list[float], k: int) -> DataFrame:
    """id, score: the k most similar to one vector; zero vectors are passed over, another dimension is an error."""
    asked = F.array(*[F.lit(float(x)) for x in query])
    same = F.when(F.size(vector) == len(query), F.col(vector)).otherwise(F.raise_error(F.lit("another dimension")))
    scored = vectors.select(id_col, same.alias("_v")).where(F.exists("_v", lambda x: x != 0))
    return top(scored.select(id_col, cosine(F.col("_v"), asked).alias("score")), k, id_col)


def neighbours(vectors: DataFrame, queries: DataFrame, id_col: str, vector: str, group: str, k: int, inner: int = 30, least: float = 0.01, block: int = 4096) -> DataFrame:
    """id, neighbour, distance, rank: of the ``inner`` + 1 nearest by Euclidean distance, itself, those nearer than ``least`` and of the
    same group are dropped, then k kept; so fewer than k may stay (T03, T04).

    ``queries`` are cut into blocks; each block is sent whole to every task (``block`` rows at once), which keeps its own best; the
    bests of all tasks are then ranked. So no pair of rows is shuffled but those that are among a task's best.
    """
    n = queries.count()
    blocks = max(1, -(-n // block))
    vectors = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), F.col(group).cast("string").alias("g"))
    asked = queries.select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), F.col(group).cast("string").alias("g"))
    out = None
    for i in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == i) if blocks > 1 else asked
        rows = own.collect()  # bounded by the block
        shared = vectors.sparkSession.sparkContext.broadcast(([r["id"] for r in rows], np.array([r["v"] for r in rows]), [r["g"] for r in rows]))
        part = vectors.mapInPandas(_nearest(shared, inner + 1), "id long, g string, neighbour long, other string, distance double")
        out = part if out is None else out.unionByName(part)
    rank = Window.partitionBy("id").orderBy("distance", "neighbour")
    first = out.withColumn("_r", F.row_number().over(rank)).where(F.col("_r") <= inner + 1)
    kept = first.where((F.col("id") != F.col("neighbour")) & (F.col("distance") >= least) & ~F.col("g").eqNullSafe(F.col("other")))
    return kept.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k).select("id", "neighbour", F.round("distance", 4).alias("distance"), "rank")


def _nearest(shared, k: int):
    def run(batches):
        import pandas as pd

        ids, q, groups = shared.value
        for batch in batches:
            if not len(batch) or not len(ids):
                continue
            v = np.stack(batch["v"].to_numpy())
            distance = np.sqrt(np.maximum((q * q).sum(1)[:, None] + (v * v).sum(1)[None] - 2 * q @ v.T, 0))
            most = min(k, len(v))
            best = np.argpartition(distance, most - 1, axis=1)[:, :most]
            rows = np.repeat(np.arange(len(ids)), most)
            flat = best.ravel()
            # The distance by differences is exact for near vectors, where the product form loses digits.
            exact = np.sqrt(((q[rows] - v[flat]) ** 2).sum(1))
            yield pd.DataFrame({"id": np.array(ids)[rows], "g": np.array(groups, object)[rows], "neighbour": batch["id"].to_numpy()[flat], "other": batch["g"].to_numpy()[flat], "distance": exact})

    return run


# --- ranking and metrics


def ranking_metrics(ranked: DataFrame, gold: DataFrame, query: str, item: str, rank: str, at: tuple[int, ...] = (1, 5, 10, 20, 30)) -> DataFrame:
    """query, mrr, and for each k: recall, hit, all_gold."""
    total = gold.groupBy(query).agg(F.count("*").alias("_n"))
    found = ranked.join(gold, [query, item]).groupBy(query).agg(F.min(rank).alias("_first"), *[F.sum((F.col(rank) <= k).cast("int")).alias(f"_in{k}") for k in at])
    joined = total.join(found, query, "left")
    inside = lambda k: F.coalesce(f"_in{k}", F.lit(0))
    columns = [F.coalesce(1.0 / F.col("_first"), F.lit(0.0)).alias("mrr")]
    for k in at:
        columns += [(inside(k) / F.col("_n")).alias(f"recall_{k}"), (inside(k) > 0).cast("int").alias(f"hit_{k}"), (inside(k) == F.col("_n")).cast("int").alias(f"all_gold_{k}")]
    return joined.select(query, *columns)


def judged_precision(ranked: DataFrame, judged: DataFrame, query: str, item: str, rank: str, good: str, k: int) -> DataFrame:
    """query, precision (null unless every one of the first k is judged), judged share."""
    first = ranked.where(F.col(rank) <= k).join(judged, [query, item], "left")
    n, known = F.count("*"), F.count(good)
    return first.groupBy(query).agg(F.when(n == known, F.sum(F.col(good).cast("int")) / n).alias("precision"), (known / n).alias("judged"))


def best_unit(scores: DataFrame, page: str, unit: str, score: str) -> DataFrame:
    """page, unit, score, rank: a page's score is that of its best unit."""
    best = scores.groupBy(page).agg(F.max_by(F.struct(unit, score), F.struct(score, F.col(unit))).alias("b")).select(page, "b.*")
    return best


def pareto(candidates: DataFrame, item: str, key: str, dimensions: list[str]) -> DataFrame:
    """item, winner: the one candidate that is at least as good (smaller) in all dimensions as every other, and better in one; items
    without such a candidate are left to review (null) (R20).

    Such a candidate has the smallest value in every dimension, and no other has all of them; so two aggregates decide, without
    pairing candidates.
    """
    lows = candidates.groupBy(item).agg(*[F.min(d).alias(f"_{d}") for d in dimensions])
    best = F.lit(True)
    for d in dimensions:
        best = best & (F.col(d) == F.col(f"_{d}"))
    winners = candidates.join(lows, item).where(best).groupBy(item).agg(F.count("*").alias("n"), F.min(key).alias("k"))
    return candidates.select(item).distinct().join(winners, item, "left").select(item, F.when(F.col("n") == 1, F.col("k")).alias("winner"))


def status_profile(tokens: DataFrame, item: str, status: str, confidence: str, least: float = 60) -> DataFrame:
    """item, n_reliable, n_missing, n_uncertain, n_unmatched, literal_share of tokens of enough confidence."""
    sure = F.col(confidence) >= least
    n = F.sum(sure.cast("int"))
    of = lambda s: F.sum((sure & (F.col(status) == s)).cast("int"))
    return tokens.groupBy(item).agg(n.alias("n_reliable"), of("missing").alias("n_missing"), of("uncertain").alias("n_uncertain"), of("unmatched").alias("n_unmatched"), F.when(n > 0, of("literal") / n).otherwise(0.0).alias("literal_share"))


# --- samples and quotas


def bottom_k(rows: DataFrame, stratum: str, key: str, seed: str, k: int) -> DataFrame:
    """Of each stratum the k rows with the smallest digest of seed and key."""
    order = Window.partitionBy(stratum).orderBy(draw(seed, F.col(key)), key)
    return rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def round_robin(rows: DataFrame, stratum: str, place: str, seed: str) -> DataFrame:
    """Rows in turns: all first ones, by the digest of their stratum, then all second ones."""
    return rows.orderBy(place, draw(seed, F.col(stratum)), stratum)


def largest_remainder(total: int, shares: dict[str, int]) -> dict[str, int]:
    """The total dealt by shares; what is left goes to the largest remainders, ties to the first."""
    whole = sum(shares.values())
    out = {k: total * s // whole for k, s in shares.items()}
    order = sorted(shares, key=lambda k: (-(total * shares[k] % whole), list(shares).index(k)))
    for k in order[: total - sum(out.values())]:
        out[k] += 1
    return out


def allocate(total: int, shares: dict[str, int], available: dict[str, int]) -> dict[str, int]:
    """The dealt total, capped by what there is; the rest goes to the others in the order of the shares."""
    out = {k: min(n, available.get(k, 0)) for k, n in largest_remainder(total, shares).items()}
    for k in shares:
        out[k] += min(available.get(k, 0) - out[k], total - sum(out.values()))
    return out


def quota_sample(rows: DataFrame, volume: str, stratum: str, key: str, total: int, shares: dict[str, int], seed: str) -> DataFrame:
    """Of each volume ``total`` rows, dealt over strata by shares and capped by what there is.

    The rule of ``allocate`` in columns: quotas, caps, then the rest in the order of the shares.
    """
    counts = rows.groupBy(volume).agg(*[F.sum((F.col(stratum) == s).cast("int")).alias(f"n_{i}") for i, s in enumerate(shares)])
    dealt = largest_remainder(total, shares)
    taken = [F.least(F.lit(dealt[s]), F.col(f"n_{i}")) for i, s in enumerate(shares)]
    left = F.lit(total)
    for x in taken:
        left = left - x
    quotas = counts.withColumn("_left", left)
    for i, _ in enumerate(shares):
        more = F.least(F.col(f"n_{i}") - taken[i], F.col("_left"))
        quotas = quotas.withColumn(f"q_{i}", taken[i] + more).withColumn("_left", F.col("_left") - more)
    quota = F.coalesce(*[F.when(F.col(stratum) == s, F.col(f"q_{i}")) for i, s in enumerate(shares)])
    place = F.row_number().over(Window.partitionBy(volume, stratum).orderBy(draw(seed, F.col(key)), key))
    return rows.join(quotas, volume).withColumn("place", place).where(F.col("place") <= quota).select(*rows.columns, "place")


def candidate_score(numeric: Column, exact: Column, normal: Column, fuzzy: Column, uncertain: Column) -> Column:
    """40 for the number of the page, 10 for a near one; 60 for the exact, 55 for the normalised, 40 for a fuzzy text; half of it if the
    candidate is uncertain (T14)."""
    text = F.when(exact, 60.0).when(normal, 55.0).when(fuzzy, 40.0).otherwise(0.0)
    number = F.when(numeric == 0, 40.0).when(numeric == 1, 10.0).otherwise(0.0)
    return (text + number) * F.when(uncertain, 0.5).otherwise(1.0)


# --- whole tables against blocks of queries


def most_similar(vectors: DataFrame, queries: DataFrame, id_col: str, vector: str, group: str, k: int, apart: int = -1, other_group: bool = False, last_first: bool = False, block: int = 1024) -> DataFrame:
    """id, neighbour, score, rank: for each query the k rows of the highest cosine (5 digits), ties by id, or the largest id first.

    Only rows more than ``apart`` ids away count, and with ``other_group`` only those of another group; null groups are never another.
    Vectors of zeros score 0. ``queries`` are cut into blocks as in ``neighbours``; each task sends its own best.
    """
    columns = [F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), F.col(group).cast("string").alias("g")]
    vectors, queries = vectors.select(*columns).where("v is not null"), queries.select(*columns).where("v is not null")
    blocks = max(1, -(-queries.count() // block))
    out = None
    for i in range(blocks):
        rows = queries.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == i).collect()  # about a block
        shared = vectors.sparkSession.sparkContext.broadcast(([r["id"] for r in rows], [r["v"] for r in rows], [r["g"] for r in rows]))
        part = vectors.mapInPandas(_most_similar(shared, k, apart, other_group, last_first), "id long, neighbour long, score double")
        out = part if out is None else out.unionByName(part)
    place = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("score"), F.desc("neighbour") if last_first else F.asc("neighbour")))
    return out.withColumn("rank", place).where(F.col("rank") <= k)


def _unit(rows) -> np.ndarray:
    v = np.stack([np.asarray(x, float) for x in rows])
    norm = np.sqrt((v * v).sum(1, keepdims=True))
    return np.divide(v, norm, out=np.zeros_like(v), where=norm > 0)


def _most_similar(shared, k, apart, other_group, last_first):
    def run(batches):
        import pandas as pd

        ids, q, groups = shared.value
        q = _unit(q) if ids else None
        for batch in batches:
            if not len(batch) or not ids:
                continue
            scores = np.round(q @ _unit(batch["v"]).T, 5)
            own, other = batch["id"].to_numpy(), batch["g"].to_numpy()
            for i, (key, group) in enumerate(zip(ids, groups)):
                may = np.abs(own - key) > apart
                if other_group:
                    may &= np.array([group is not None and g is not None and g != group for g in other])
                at = np.flatnonzero(may)
                at = at[np.lexsort((-own[at] if last_first else own[at], -scores[i, at]))[:k]]
                yield pd.DataFrame({"id": key, "neighbour": own[at], "score": scores[i, at] + 0.0})

    return run


def hybrid(items: DataFrame, docs: DataFrame, k: int = 5, lexical: float = 0.6, block: int = 512) -> DataFrame:
    """item_id, doc_id, score, confirmed: of each item the k best of all documents, by the shared part of its words and the cosine.

    ``items``: item_id, words (distinct, one at least), v; ``docs``: doc_id, words (distinct), v. Where a vector is null the cosine is 0.
    Items are sent in blocks, and each task sends its own best.
    """
    blocks = max(1, -(-items.count() // block))
    out = None
    for i in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == i).select("item_id", "words", "v").collect()  # about a block
        shared = docs.sparkSession.sparkContext.broadcast([tuple(r) for r in rows])
        part = docs.select("doc_id", "words", "v").mapInPandas(_hybrid(shared, k, lexical), "item_id long, doc_id long, score double, confirmed boolean")
        out = part if out is None else out.unionByName(part)
    place = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id"))
    return out.withColumn("_r", place).where(F.col("_r") <= k).drop("_r")


def _hybrid(shared, k, lexical):
    def run(batches):
        import pandas as pd

        items = shared.value
        having: dict[str, list[int]] = {}
        for i, (_, words, _) in enumerate(items):
            for w in words:
                having.setdefault(w, []).append(i)
        with_v = [i for i, (_, _, v) in enumerate(items) if v is not None]
        q = _unit([items[i][2] for i in with_v]) if with_v else None
        size = np.array([len(words) for _, words, _ in items], float)[:, None]
        for batch in batches:
            if not len(batch) or not items:
                continue
            hits = np.zeros((len(items), len(batch)))
            for j, words in enumerate(batch["words"]):
                for w in words:
                    if w in having:
                        hits[having[w], j] += 1
            part = hits / size
            whole = lexical * part
            known = np.flatnonzero(batch["v"].notna())
            if with_v and len(known):
                whole[np.ix_(with_v, known)] += (1 - lexical) * (q @ _unit(batch["v"].iloc[known]).T)
            score, ids = np.round(whole, 5), batch["doc_id"].to_numpy()
            for i, (key, _, _) in enumerate(items):
                at = np.lexsort((ids, -score[i]))[:k]
                yield pd.DataFrame({"item_id": key, "doc_id": ids[at], "score": score[i, at] + 0.0, "confirmed": (whole[i, at] >= 0.75) | (part[i, at] >= 0.8)})

    return run
