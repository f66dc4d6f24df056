"""Near-duplicate documents: SuperMinHash signatures, banding, verification on full sets, union-find.

Words are runs of other than ASCII white space, A-Z in lower case; a document's set holds its
distinct shingles of ``width`` words (all words as one if fewer; none without words). Two
documents are linked when 100 * |A and B| >= SIMILAR * |A or B|. Components of linked documents are
the groups, named by their smallest doc_id.

1. One pass takes each document's set size, a 128-bit digest of its set, and a SuperMinHash signature of
   ``SLOTS`` slots folded into ``BANDS`` band keys. Each element draws a random permutation of
   the slots and ranks them j + u; elements are drawn in step, one rank at a time, and a document's drawing stops early once
   each slot holds a value below the next rank.
2. Documents of equal sets form a class; only one of a class goes on, so copies cost nothing more.
3. Each document meets the bucket leader with which it shares most bands; both full sets are intersected. This
   links all but a few members of a group of copies, with one comparison a document.
4. What is left are buckets that hold several components. Two sets can only be linked if they share one of their rarest
   shingles: of a set of n in an order by frequency, the first n - ceil(0.8 n) + 1; and where the first shared one stands tells
   the most that they can share. Documents of different components that pass both tests are compared on full sets. Shingles
   that only one component holds are of no use and go, so a large group costs nothing once it is linked. Both tests are exact.
5. A shingle whose list would take more than ``PAIRS`` looks gives ``LEADERS`` of its documents a round, which meet all
   others; linked components are contracted before the next round.
6. Components: smallest-neighbour hooking and pointer jumping on tables, written each round.

A link is lost only if neither document shares a band with any other, or none with each other where all their buckets
are linked otherwise; the first happens at similarity 0.8 with odds of (1 - 0.8**5)**32, 3 in a million.

Edge cases: null and empty texts, and texts of white space, have an empty set, are linked with nothing and
are kept; a null doc_id is its own row, with a null component, kept; rows that repeat a doc_id share its component,
the smallest of their classes'; very long texts are shingled whole; extra columns are
ignored by ``groups`` and kept by ``one_of_each``, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import arrow_batch, staged, unused

SIMILAR = 80
SLOTS, BANDS, ROWS = 160, 32, 5
PAIRS, LEADERS = 1 << 22, 16
CHUNK = 1 << 18  # shingles worked on at a time

_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, on a copy."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * _GOLD)
_ODD = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def shingles(texts: list[str | None], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of all texts in a row, and how many are each one's."""
    raws = [(x or "").encode() for x in texts]
    sizes = np.array([len(x) + 1 for x in raws])
    data = np.frombuffer(b" ".join(raws) + b" ", np.uint8)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    data = np.where((data >= 65) & (data <= 90), data + 32, data)
    edge = np.diff(np.concatenate([[True], space]).astype(np.int8))
    first, last = np.flatnonzero(edge == -1), np.flatnonzero(np.concatenate([edge[1:] == 1, [False]])) + 1
    powers, undo = _powers(_ODD, len(data)), _powers(_INVERSE, len(data))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * powers, dtype=np.uint64)])
    words = _mix((sums[last] - sums[first]) * undo[first] + (last - first).astype(np.uint64) * _GOLD)
    owner = np.searchsorted(np.cumsum(sizes), first, side="right")
    n_words = np.bincount(owner, minlength=len(texts))
    taken = np.minimum(n_words, width)
    n = np.where(n_words > 0, n_words - taken + 1, 0)
    starts = np.cumsum(n_words) - n_words
    at = np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(n.sum())
    code = np.zeros(len(at), np.uint64)
    for i in range(width):
        more = np.repeat(taken, n) > i
        step = code * _ODD + words[np.minimum(at + i, len(words) - 1)] if len(words) else code
        code = np.where(more, _mix(step + np.uint64(i)), code)
    whose = np.repeat(np.arange(len(texts)), n)
    order = np.lexsort((code, whose))
    code, whose = code[order], whose[order]
    fresh = np.ones(len(code), bool)
    fresh[1:] = (code[1:] != code[:-1]) | (whose[1:] != whose[:-1])
    code, whose = code[fresh], whose[fresh]
    return code, np.bincount(whose, minlength=len(texts))


def signatures(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """SuperMinHash slots of each set as float32 (rows: sets; infinite where a set is empty)."""
    out = np.full((len(counts), SLOTS), np.inf, np.float32)
    owner = np.repeat(np.arange(len(counts)), counts)
    open_sets = counts > 0
    state = codes.copy()
    deck: np.ndarray | None = None
    for rank in range(SLOTS):
        live = open_sets[owner]
        if not live.all():
            owner, state = owner[live], state[live]
            deck = deck[live] if deck is not None else None
        if not len(owner):
            break
        state += _GOLD
        drawn = _mix(state)
        pick = rank + ((drawn >> np.uint64(32)) % np.uint64(SLOTS - rank)).astype(np.int64)
        value = np.float32(rank) + (drawn & np.uint64(0xFFFFFF)).astype(np.float32) / np.float32(1 << 24)
        if deck is None and rank == 0:
            slot, first_pick = pick, pick
        else:
            if deck is None:
                # The first draw swapped place 0 with the picked one.
                deck = np.tile(np.arange(SLOTS, dtype=np.uint8), (len(owner), 1))
                mine = first_pick[live] if len(first_pick) != len(owner) else first_pick
                deck[np.arange(len(owner)), mine] = 0
                deck[:, 0] = mine
            lines = np.arange(len(owner))
            slot = deck[lines, pick].astype(np.int64)
            deck[lines, pick] = deck[:, rank]
            deck[:, rank] = slot
        np.minimum.at(out, (owner, slot), value)
        open_sets = (counts > 0) & (out.max(axis=1, initial=0) >= rank + 1)
    return out


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, x in enumerate(texts):
        size += len(x or "") // 4 + 1
        if size >= CHUNK:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


SKETCH = "doc_id long, n long, d1 long, d2 long, bands array<long>"
SETS = "id long, d1 long, codes array<long>"


def _sums(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of each set's hashes, as a digest."""
    ends = np.cumsum(counts)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(codes), dtype=np.uint64)])
    return (sums[ends] - sums[ends - counts]).view(np.int64)


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(values.view(np.int64)))


def _sketch(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].to_pylist()
            for a, b in _chunks(texts):
                codes, counts = shingles(texts[a:b], width)
                slots = signatures(codes, counts).view(np.uint32).astype(np.uint64).reshape(-1, BANDS, ROWS)
                keys = np.zeros(slots.shape[:2], np.uint64)
                for i in range(ROWS):
                    keys = _mix(keys * _ODD + slots[:, :, i] + np.uint64(i))
                yield arrow_batch(SKETCH, batch["doc_id"].slice(a, b - a), counts.astype(np.int64), _sums(codes * _ODD, counts), _sums(codes + _GOLD, counts), _lists(keys.ravel(), np.full(b - a, BANDS)))

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].to_pylist()
            for a, b in _chunks(texts):
                codes, counts = shingles(texts[a:b], width)
                yield arrow_batch(SETS, batch["id"].slice(a, b - a), _sums(codes * _ODD, counts), _lists(codes, counts))

    return run


def _jumped(parents: DataFrame, name: str) -> DataFrame:
    """(id, c) of a forest (id, c), c < id: every id's root, by pointer jumping."""
    while True:
        up = parents.select(F.col("id").alias("c"), F.col("c").alias("root"))
        step = staged(parents.join(up, "c", "left").select("id", F.coalesce("root", "c").alias("c"), F.col("root").isNotNull().alias("moved")), name)
        parents = step.select("id", "c")
        if step.where("moved").isEmpty():
            return parents


def components(links: DataFrame, name: str) -> DataFrame:
    """(id, c) of the ids in ``links`` (a, b) that aren't the smallest of their component: c is that smallest id.

    Each round every component hooks onto the smallest one next to it and pointers jump to the
    roots; then links are between roots, and those within a component are gone.
    """
    found = None
    while True:
        ends = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b")
        hooks = staged(ends.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("c")), name)
        if hooks.isEmpty():
            return found if found is not None else hooks
        roots = _jumped(hooks, name)
        if found is None:
            found = roots
        else:
            moved = found.join(roots.select(F.col("id").alias("c"), F.col("c").alias("to")), "c", "left").select("id", F.coalesce("to", "c").alias("c"))
            found = staged(moved.unionByName(roots), name)
        to = lambda side: roots.select(F.col("id").alias(side), F.col("c").alias(f"_{side}"))
        links = staged(ends.join(to("a"), "a", "left").join(to("b"), "b", "left").select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b")).where("a <> b").distinct(), name)
        if links.isEmpty():
            return found


def _verified(pairs: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full sets are similar."""
    left, right = sets.select(F.col("id").alias("a"), F.col("codes").alias("ca")), sets.select(F.col("id").alias("b"), F.col("codes").alias("cb"))
    met = pairs.join(left, "a").join(right, "b")
    counted = met.select("a", "b", (F.size("ca") + F.size("cb")).cast("long").alias("total"), F.size(F.array_intersect("ca", "cb")).cast("long").alias("shared"))
    return counted.where(100 * F.col("shared") >= similar * (F.col("total") - F.col("shared"))).select("a", "b").distinct()


def groups(docs: DataFrame, width: int = 4, similar: int = SIMILAR) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row of ``docs`` (doc_id, text)."""
    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    sketch = staged(own.mapInArrow(_sketch(width), SKETCH), "sketch")
    filled = sketch.where("n > 0 and doc_id is not null")
    digest = ["n", "d1", "d2"]
    classes = staged(filled.groupBy(*digest).agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("copies")), "classes")

    # Band rows of one document a class; buckets of one are of no use.
    firsts = filled.join(classes.where("copies > 1").select(*digest, "id"), digest, "left").where("id is null or doc_id = id").drop("id")
    rows = firsts.select(F.col("doc_id").alias("id"), F.posexplode("bands").alias("band", "code")).select("id", F.xxhash64("band", "code").alias("key"))
    shared = rows.groupBy("key").agg(F.min("id").alias("leader"), F.max("id").alias("last")).where("leader < last").drop("last")
    hits = staged(rows.join(shared, "key"), "hits")
    wanted = staged(hits.select("id").distinct(), "wanted")
    if wanted.isEmpty():
        labels = classes.select("id", F.col("id").alias("c")).limit(0)
    else:
        # Full sets of the documents that share a bucket; a class's sets are equal, so any row of it serves.
        texts = own.join(wanted, own["doc_id"] == wanted["id"], "left_semi").select(F.col("doc_id").alias("id"), "text")
        sets = staged(texts.mapInArrow(_sets(width), SETS), "sets")
        labels = _linked(hits, sets, similar)
    if not filled.groupBy("doc_id").count().where("count > 1").isEmpty():
        # Rows that repeat a doc_id with other texts: their classes are one group.
        seats = filled.join(classes, digest).select("doc_id", "id").distinct()
        doubled = seats.groupBy("doc_id").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi")
        members = seats.join(doubled, "doc_id").where("id > lo").select(F.col("id").alias("a"), F.col("lo").alias("b"))
        labels = components(staged(labels.select(F.col("id").alias("a"), F.col("c").alias("b")).unionByName(members), "links"), "labels")
    named = classes.join(labels, "id", "left").where("copies > 1 or c is not null").select(*digest, F.coalesce("c", "id").alias("c"))
    whole = sketch.select("doc_id", *digest).join(named, digest, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("c", "doc_id"))
    return whole.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _rarest(sets: DataFrame, similar: int) -> DataFrame:
    """(token, id, n, rest) of ``sets``: those of a set's rarest shingles that a similar set must share one of, and how many stand from there on."""
    codes = sets.select("id", "d1", F.size("codes").cast("long").alias("n"), F.explode("codes").alias("token"))
    often = codes.groupBy("token").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    held = codes.join(often, "token").groupBy("id", "d1", "n").agg(F.array_sort(F.collect_list(F.struct("often", "token"))).alias("held"))
    # Shingles that no other set has come first in the order.
    alone = held.withColumn("alone", F.col("n") - F.size("held")).withColumn("take", F.expr(f"n - ({similar} * n + 99) div 100 + 1 - alone"))
    return alone.where("take > 0").select("id", "n", "alone", F.posexplode(F.expr("slice(held, 1, cast(take as int))"))).select(F.col("col.token").alias("token"), "id", "n", (F.col("n") - F.col("alone") - F.col("pos")).alias("rest"))


def _linked(hits: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """(id, c) of the ids that aren't the smallest of their component, from exact comparisons."""
    voted = hits.where("id <> leader").groupBy("id", "leader").agg(F.count(F.lit(1)).alias("votes"))
    best = voted.groupBy("id").agg(F.expr("min_by(leader, struct(-votes, leader))").alias("b")).select(F.col("id").alias("a"), "b")
    # A forest of links to smaller ids.
    labels = _jumped(staged(_verified(best, sets, similar).select(F.col("a").alias("id"), F.col("b").alias("c")), "first"), "labels")

    def placed(rows: DataFrame) -> DataFrame:
        return rows.join(labels, "id", "left").withColumn("c", F.coalesce("c", "id"))

    seats = placed(hits.select("key", "id"))
    mixed = seats.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("key")
    loose = staged(seats.join(mixed, "key", "left_semi").select("id").distinct(), "loose")
    if loose.isEmpty():
        return labels
    tokens = staged(_rarest(sets.join(loose, "id", "left_semi"), similar), "tokens")
    may = f"least(m.rest, o.rest) * {100 + similar} >= {similar} * (m.n + o.n) and 100 * least(m.n, o.n) >= {similar} * greatest(m.n, o.n)"
    while True:
        now = placed(tokens)
        counts = now.groupBy("token", "c").agg(F.count(F.lit(1)).alias("k")).groupBy("token").agg(F.sum("k").alias("all"), F.max(F.struct("k", "c")).alias("top")).where("top.k < all")
        mains = staged(counts.select("token", F.col("top.c").alias("main"), ((F.col("all") - F.col("top.k")) * F.col("all") > PAIRS).alias("heavy")), "mains")
        some, heavy = mains.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("heavy").cast("int")), F.lit(0))).first()
        if not some:
            return labels
        minor = now.join(mains, "token").where("c <> main")
        asked = minor.where("not heavy")
        if heavy:
            names = [x for x in minor.columns if x != "token"]
            chosen = minor.where("heavy").groupBy("token", F.expr(f"pmod(xxhash64(id), {LEADERS})").alias("bin")).agg(F.min_by(F.struct(*names), F.struct("id", "n", "rest")).alias("x"))
            chosen = staged(chosen.select("token", "x.*"), "chosen")
            asked = asked.unionByName(chosen)
        met = asked.alias("m").join(now.alias("o"), F.expr(f"m.token = o.token and m.c <> o.c and (m.heavy or o.c = m.main or m.id < o.id) and {may}"))
        pairs = met.select(F.expr("greatest(m.id, o.id)").alias("a"), F.expr("least(m.id, o.id)").alias("b")).distinct()
        found = staged(_verified(pairs, sets, similar), "found")
        if not found.isEmpty():
            labels = components(staged(labels.select(F.col("id").alias("a"), F.col("c").alias("b")).unionByName(found), "links"), "labels")
        if not heavy:
            return labels
        left = tokens.join(mains.where("heavy").select("token"), "token", "left_semi")
        tokens = staged(left.join(chosen.select("token", "id", "n", "rest"), ["token", "id", "n", "rest"], "left_anti"), "tokens")


def one_of_each(docs: DataFrame, width: int = 5, similar: int = SIMILAR) -> DataFrame:
    """The rows of ``docs`` of which no smaller doc_id is in their group, all columns kept; of rows equal in doc_id and text, one."""
    mark = unused(docs, "gone")
    gone = staged(groups(docs, width, similar).where("not kept").select(F.col("doc_id").alias(mark)).distinct(), "gone")
    kept = docs.join(gone, F.col("doc_id").cast("long") == F.col(mark), "left_anti")
    twice = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1")
    return kept if twice.isEmpty() else kept.where("doc_id is not null").dropDuplicates(["doc_id", "text"]).unionByName(kept.where("doc_id is null"))


def op9_superminhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), width=4)


QUERIES = {"op9_superminhash_groups": op9_superminhash_groups}
