"""N-gram Jaccard join with adaptive multi-match prefixes: documents whose sets of word n-grams are similar, as components.

Words are runs of other than ASCII white space, A-Z in lower case; a document's set holds its distinct shingles of ``width``
words (all words as one if fewer; none without words). Two documents are linked when
100 * |A and B| >= SIMILAR * |A or B|. Shingles are 64-bit hashes; all tests are on whole sets, and none is by chance.

Of a set of n, T = ceil(SIMILAR n / 100) is the least that a similar set shares with it. In any one order of all shingles, the first
n - T + l of each of two similar sets have at least l in common (the l-prefix). Where two documents took l and m, min(l, m)
common ones are asked for.

1. Documents of equal sets (their size and two digests) are one class.
2. The screen: in the order of hashes, each class sends an l-prefix with l a tenth of its size. Classes too many of whose
   prefix shingles are held by no other class have no partner; the rest, few in running text, go on with full sets.
3. In the order of frequency, rarest first, each class takes the l of least estimated cost: postings that it meets with partners of its
   size, plus ``CHECK`` per shingle of each candidate, of whom there are at most (postings / l). So where prefixes hold common shingles they are lengthened, and candidates need
   as many more in common.
4. Each class meets the smallest class that holds some of its prefix shingles, if enough are in common; both full sets are intersected. Then
   what stands outside a shingle's largest component meets one of its members, another each turn, as long as such turns link many.
   This links all but a few members of a large group, with a comparison a turn.
5. What is left are prefix shingles held by several components: pairs of classes of different components are counted by those shingles that stand
   early enough for their two sizes, kept if enough are in common and the places of the last one allow the similarity, and compared on full
   sets. Within a component no pair is made.
6. A shingle with more than ``PAIRS`` such pairs gives some of its classes a round, twice as many each round, which meet all its others; linked
   components are contracted before the next round. Those pairs are compared without asking for more shingles.
7. Components: smallest-neighbour hooking and pointer jumping on tables.

Edge cases: null and empty texts, and texts of white space, have an empty set and are linked with nothing; a null doc_id is its own
row, with a null component; rows that repeat a doc_id share its component; very long texts are shingled whole; extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .neardup import SETS, SIMILAR, _chunks, _jumped, _lists, _sets, _sums, _verified, components, shingles
from .shared import arrow_batch, staged

SHARE = 10  # the screen's l is the size divided by this
LEVELS = tuple(1 << i for i in range(12))
CHECK = 0.01  # cost of a candidate for each of its shingles, in postings; low, as most of those bounded by postings share too few
PAIRS, LEADERS = 1 << 21, 16
FEW = 16  # turns end when fewer than one comparison in so many links
SIZES, PREFIXES = "doc_id long, n long, d1 long, d2 long", "d1 long, d2 long, n long, codes array<long>"


def least_shared(n, similar: int):
    """What a set of n shares with a similar one, at least; for numbers and arrays."""
    return (similar * n + 99) // 100


def screen_level(n, similar: int) -> tuple:
    """(l, the least l of a partner) for sets of n."""
    return np.maximum(n // SHARE, 1), np.maximum(least_shared(n, similar) // SHARE, 1)


def _sizes(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].to_pylist()
            for a, b in _chunks(texts):
                codes, counts = shingles(texts[a:b], width)
                yield arrow_batch(SIZES, batch["doc_id"].slice(a, b - a), counts.astype(np.int64), _sums(codes * np.uint64(0xD6E8FEB86659FD93), counts), _sums(codes ^ np.uint64(0x9E3779B97F4A7C15), counts))

    return run


def _prefixes(width: int, similar: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].to_pylist()
            for a, b in _chunks(texts):
                codes, counts = shingles(texts[a:b], width)
                counts = counts.astype(np.int64)
                first, second = _sums(codes * np.uint64(0xD6E8FEB86659FD93), counts), _sums(codes ^ np.uint64(0x9E3779B97F4A7C15), counts)
                # Smaller sets can only be similar if they are equal.
                take = np.where(counts * (100 - similar) >= similar, counts - least_shared(counts, similar) + screen_level(counts, similar)[0], 0)
                seat = np.arange(len(codes)) - np.repeat(np.cumsum(counts) - counts, counts)
                yield arrow_batch(PREFIXES, first, second, counts, _lists(codes[seat < np.repeat(take, counts)], take))

    return run


def _live(own: DataFrame, classes: DataFrame, width: int, similar: int) -> DataFrame:
    """(id) of the classes that the screen leaves."""
    postings = own.mapInArrow(_prefixes(width, similar), PREFIXES).where("size(codes) > 0").select("d1", F.explode("codes").alias("token"))
    alone = postings.groupBy("token").agg(F.min("d1").alias("d1"), F.max("d1").alias("last")).where("d1 = last").groupBy("d1").agg(F.count(F.lit(1)).alias("alone"))
    level, least = f"greatest(n div {SHARE}, 1)", f"greatest((({similar} * n + 99) div 100) div {SHARE}, 1)"
    met = classes.where(f"n * {100 - similar} >= {similar}").join(alone, "d1", "left")
    return met.where(f"n - ({similar} * n + 99) div 100 + {level} - coalesce(alone, 0) >= {least}").select("id")


def prefixes(sets: DataFrame, similar: int) -> DataFrame:
    """(token, id, d1, n, level, seat) of ``sets``: each one's prefix in the order of frequency, of the level that costs least; shingles of one set left out."""
    codes = sets.select("id", "d1", F.size("codes").cast("long").alias("n"), F.explode("codes").alias("token"))
    often = codes.groupBy("token").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    held = codes.join(often, "token").groupBy("id", "d1", "n").agg(F.array_sort(F.collect_list(F.struct("often", "token"))).alias("held"))
    # Shingles that no other set has come first in the order; those of them in a prefix have no postings.
    first = held.withColumn("least", F.expr(f"({similar} * n + 99) div 100")).withColumn("alone", F.expr("n - size(held)")).where("n - least + 1 > alone")
    take = "cast(least(n - least + l - alone, size(held)) as int)"
    # The cost is that of partners of the same size, who must share more than a smaller one.
    even = f"cast(least(greatest(n - {2 * similar} * n div {100 + similar} + l - alone, 0), size(held)) as int)"
    postings = f"aggregate(slice(held, 1, {even}), 0D, (s, x) -> s + x.often - 1)"
    levels = "filter(array(" + ", ".join(f"{x}L" for x in LEVELS) + "), l -> l <= least)"
    cost = f"array_min(transform({levels}, l -> struct({postings} * (1 + {CHECK} * n / l) as cost, l as level)))"
    chosen = first.withColumn("l", F.expr(f"{cost}.level")).withColumn("taken", F.expr(f"slice(held, 1, {take})"))
    return chosen.select("id", "d1", "n", F.col("l").alias("level"), "alone", F.posexplode("taken")).select(F.col("col.token").alias("token"), "id", "d1", "n", "level", (F.col("alone") + F.col("pos")).alias("seat"))


def _placed(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with the component of each id."""
    return rows.join(labels, "id", "left").withColumn("c", F.coalesce("c", "id"))


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The components of ``labels`` with the links (a, b)."""
    return components(staged(labels.select(F.col("id").alias("a"), F.col("c").alias("b")).unionByName(links), "links"), "labels")


def _turn(tokens: DataFrame, labels: DataFrame, turn: int) -> DataFrame:
    """(a, b): each class outside the largest component of its prefix shingles with the one member of it, of those that this turn offers, with which most are in common."""
    now = _placed(tokens, labels)
    held = now.groupBy("token", "c").agg(F.count(F.lit(1)).alias("k"), F.min_by(F.struct("id", "level"), F.struct(F.xxhash64("id", F.lit(turn)), "id")).alias("member"))
    mains = held.groupBy("token").agg(F.sum("k").alias("all"), F.max(F.struct("k", "c", "member")).alias("top")).where("top.k < all")
    met = now.join(mains.select("token", F.col("top.c").alias("main"), F.col("top.member.id").alias("leader"), F.col("top.member.level").alias("leader_level")), "token").where("c <> main")
    voted = met.groupBy("id", "d1", "leader").agg(F.count(F.lit(1)).alias("votes"), F.min(F.least("level", "leader_level")).alias("asked"))
    best = voted.where("votes >= asked").groupBy("id").agg(F.expr("min_by(leader, struct(-votes, leader))").alias("b"))
    return best.select(F.greatest("id", "b").alias("a"), F.least("id", "b").alias("b")).distinct()


def _linked(sets: DataFrame, similar: int) -> DataFrame:
    """(id, c) of the ids that aren't the smallest of their component, from exact comparisons."""
    tokens = staged(prefixes(sets, similar), "prefixes")
    shared = tokens.groupBy("token").agg(F.min("id").alias("leader"), F.min_by("level", "id").alias("leader_level"), F.max("id").alias("last")).where("leader < last").drop("last")
    voted = tokens.join(shared, "token").where("id <> leader").groupBy("id", "d1", "leader").agg(F.count(F.lit(1)).alias("votes"), F.min(F.least("level", "leader_level")).alias("asked"))
    best = voted.where("votes >= asked").groupBy("id").agg(F.expr("min_by(leader, struct(-votes, leader))").alias("b")).select(F.col("id").alias("a"), "b")
    # A forest of links to smaller ids.
    labels = _jumped(staged(_verified(best, sets, similar).select(F.col("a").alias("id"), F.col("b").alias("c")), "first"), "labels")
    turn = 1
    while (compared := staged(_turn(tokens, labels, turn), "turn")).count():
        found = staged(_verified(compared, sets, similar), "found")
        if not found.isEmpty():
            labels = _merged(labels, found)
        if found.count() * FEW < compared.count():
            break
        turn += 1
    # Common shingles up to and with this one are at most the lesser of both seats + 1; those after it, what the shorter rest holds.
    sizes = f"100 * least(m.n, o.n) >= {similar} * greatest(m.n, o.n)"
    may = f"(least(m.seat, o.seat) + least(m.n - m.seat, o.n - o.seat)) * {100 + similar} >= {similar} * (m.n + o.n)"
    # The l first common shingles of a similar pair stand where both rests, with those before, still hold what the pair must share.
    early = f"(least(m.n - m.seat, o.n - o.seat) + least(m.level, o.level) - 1) * {100 + similar} >= {similar} * (m.n + o.n)"
    leaders, whole = LEADERS, True
    while True:
        now = _placed(tokens, labels)
        counts = now.groupBy("token", "c").agg(F.count(F.lit(1)).alias("k")).groupBy("token").agg(F.sum("k").alias("all"), F.max(F.struct("k", "c")).alias("top")).where("top.k < all")
        mains = staged(counts.select("token", F.col("top.c").alias("main"), ((F.col("all") - F.col("top.k")) * F.col("all") > PAIRS).alias("heavy")), "mains")
        some, heavy = mains.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("heavy").cast("int")), F.lit(0))).first()
        if not some:
            return labels
        minor = now.join(mains, "token").where("c <> main")
        # A pair of two minor ones is made once, by the smaller id.
        once = "m.token = o.token and m.c <> o.c and (o.c = m.main or m.id < o.id)"
        met = minor.where("not heavy").alias("m").join(now.alias("o"), F.expr(f"{once} and {sizes} and {early if whole else may}"))
        ends = [F.expr("greatest(m.id, o.id)").alias("a"), F.expr("least(m.id, o.id)").alias("b")]
        if whole:
            rest = F.expr("least(m.n - m.seat, o.n - o.seat)")
            counted = met.groupBy(*ends, F.expr("m.d1 ^ o.d1").alias("sets"), F.expr("m.n + o.n").alias("total")).agg(F.count(F.lit(1)).alias("k"), F.min(F.expr("least(m.level, o.level)")).alias("asked"), F.min(rest).alias("rest"))
            pairs = counted.where(f"k >= asked and (k + rest - 1) * {100 + similar} >= {similar} * total").select("a", "b")
        else:  # shingles that were light are gone, so nothing can be counted
            pairs = met.select(*ends)
        if heavy:
            bins = minor.where("heavy").groupBy("token", F.expr(f"pmod(xxhash64(id), {leaders})").alias("bin"))
            chosen = staged(bins.agg(F.min_by(F.struct("id", "d1", "n", "seat", "c"), F.struct("id", "d1")).alias("x")).select("token", "x.*"), "chosen")
            asked = chosen.alias("m").join(now.alias("o"), F.expr(f"m.token = o.token and m.c <> o.c and {sizes} and {may}"))
            pairs = pairs.unionByName(asked.select(*ends))
        found = staged(_verified(pairs.distinct(), sets, similar), "found")
        if not found.isEmpty():
            labels = _merged(labels, found)
        if not heavy:
            return labels
        left = tokens.join(mains.where("heavy").select("token"), "token", "left_semi")
        tokens = staged(left.join(chosen.select("token", "id", "d1"), ["token", "id", "d1"], "left_anti"), "tokens")
        leaders, whole = 2 * leaders, False


def similar_components(docs: DataFrame, width: int = 5, similar: int = SIMILAR) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row of ``docs`` (doc_id, text)."""
    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    sizes = staged(own.mapInArrow(_sizes(width), SIZES), "sizes")
    filled = sizes.where("n > 0 and doc_id is not null")
    digest = ["n", "d1", "d2"]
    classes = staged(filled.groupBy(*digest).agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("copies")), "classes")
    live = staged(_live(own, classes, width, similar), "live")
    if live.isEmpty():
        labels = live.select("id", F.col("id").alias("c"))
    else:
        # Of rows that repeat a doc_id, only those whose set is a class's own serve.
        texts = own.join(live, own["doc_id"] == live["id"], "left_semi").select(F.col("doc_id").alias("id"), "text")
        sets = texts.mapInArrow(_sets(width), SETS)
        labels = _linked(staged(sets.dropDuplicates(["id", "d1"]), "sets"), similar)
    if not filled.groupBy("doc_id").count().where("count > 1").isEmpty():
        # Rows that repeat a doc_id with other texts: their classes are one group.
        seats = filled.join(classes, digest).select("doc_id", "id").distinct()
        doubled = seats.groupBy("doc_id").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi")
        members = seats.join(doubled, "doc_id").where("id > lo").select(F.col("id").alias("a"), F.col("lo").alias("b"))
        labels = _merged(labels, members)
    named = classes.join(labels, "id", "left").where("copies > 1 or c is not null").select(*digest, F.coalesce("c", "id").alias("c"))
    whole = sizes.join(named, digest, "left")
    return whole.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("c", "doc_id")).alias("component_id"))


def op13_adaptive_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_components(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


QUERIES = {"op13_adaptive_jaccard": op13_adaptive_jaccard}
