"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact check.

A document is contaminated by an item if one of its windows of as many words as the item has a
weighted similarity of ``SIMILAR`` or more with it (a shorter document is one window): words are runs of other than ASCII white space in lower case,
both sides are bags of shingles of ``SHINGLE`` words (of all words where an item has fewer), and
the similarity is the sum of least over the sum of greatest counts.

1. Which windows: such a window shares at least ``SIMILAR`` of its shingles with the benchmark.
   Each document's shingles are looked up in a bitmap of the benchmark's, in its own row; documents with too
   few hits are done. The hits of the others are joined with the benchmark's shingles for the lengths of
   the items that have them, and windows of those lengths with enough hits are kept.
2. Fingerprints: SimHash of 64 bits over a window's words, counts kept in 16-bit lanes of longs.
3. Candidates: fingerprints are cut into ``BLOCKS`` blocks of 16 bits. Two that differ in at most ``RADIUS`` bits have a
   block that differs in at most ``NEAR``, so the items' blocks are written out with all changes of up to ``NEAR`` bits
   and joined by value with the blocks of the windows' distinct fingerprints: every pair within ``RADIUS`` is
   found, at its first such block. Windows at ``SIMILAR`` with a rewritten end can lie further away than blocks
   can serve; they hold one of the item's rarest shingles (as many as can't all be missing), and
   pairs that share one and lie beyond ``RADIUS`` are candidates too. So no leak is lost at any distance.
4. Every candidate's bags are compared exactly.

Everything is DataFrame and SQL functions. The benchmark's bitmap has ``BITS`` bits, whatever the
benchmark's size; beyond ``BITS / 16`` shingles it would let too much through, and step 1 is
a shuffled join instead. Items, their blocks and their rarest shingles are broadcast up to ``BROADCAST_ROWS`` rows each, and
joined by shuffle beyond. Equal texts of several items are compared once.

Edge cases: null or empty texts are clean, null or empty items contaminate nothing, items without an id contaminate under a null id; rows are told
apart by doc_id and text's digest, so repeated or null doc_ids are judged each by its own text; very long texts are
looked up whole; an item of more than ``LANE`` words has fingerprint 0, as all windows of its length, and is compared exactly; extra columns are
kept by ``without_leaks``; empty tables give empty results or clean documents.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import staged, unused

SHINGLE, SIMILAR = 5, 80
BLOCKS, NEAR = 4, 2
RADIUS = BLOCKS * (NEAR + 1) - 1
BITS = 1 << 20
BROADCAST_ROWS = 500_000
LANE = (1 << 14) - 1

_ONES = 0x0001000100010001


def words_sql(text: str) -> str:
    """SQL for the hashed words of a text; none for a null or empty one."""
    clean = rf"trim(translate(lower(coalesce({text}, '')), '\t\n\r\u000c\u000b', '     '))"
    return f"if({clean} = '', cast(array() as array<bigint>), transform(split({clean}, ' +'), w -> xxhash64(w)))"


def shingles_sql(words: str, width: int | str) -> str:
    """SQL for the hashed shingles of hashed words in order."""
    if isinstance(width, int):
        code = f"xxhash64({', '.join(f'{words}[i + {j}]' for j in range(width))})"
        return f"if(size({words}) < {width}, cast(array() as array<bigint>), transform(sequence(0, greatest(size({words}) - {width}, 0)), i -> {code}))"
    cases = " ".join(f"when {k} then {shingles_sql(words, k)}" for k in range(1, SHINGLE + 1))
    return f"case {width} {cases} end"


def simhash_sql(words: str) -> str:
    """SQL for the fingerprint of a window's hashed words; 0 for windows over ``LANE`` words."""
    parts = []
    for g in range(16):
        sums = f"aggregate({words}, 0L, (n, w) -> n + (shiftrightunsigned(w, {g}) & {_ONES}L))"
        # A lane's bit 14 is set when more than half of the words have the bit.
        parts.append(f"shiftleft(shiftrightunsigned(({sums} + (16384L - (size({words}) div 2 + 1)) * {_ONES}L) & {_ONES << 14}L, 14), {g})")
    return f"if(size({words}) > {LANE}, 0L, {' | '.join(parts)})"


def bag_sql(shingles: str) -> str:
    """SQL for a bag as a set: the k-th copy of a shingle becomes an element of its own."""
    return f"transform(array(array_sort({shingles})), s -> transform(s, (x, i) -> xxhash64(x, i - array_position(s, x))))[0]"


def _hits(docs: DataFrame, table: DataFrame, widths: list[int], least: dict[int, int]) -> DataFrame:
    """(key, words, len, at) of documents: places of the shingles of items, by item length."""
    spark = docs.sparkSession
    worded = docs.select(F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.md5(F.col("text").cast("binary")).alias("digest")).alias("key"), F.expr(words_sql("text")).alias("words"))
    n = table.count()
    found = None
    for width in widths:
        codes = F.expr(shingles_sql("words", width))
        own = table.where(F.col("width") == width)
        if n <= BITS // 16:
            bits = own.select(F.expr(f"cast(code & {BITS - 1} as int)").alias("bit")).distinct().groupBy(F.expr("bit div 64").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(bit % 64 as int)))").alias("v"))
            marks = np.zeros(BITS // 64, np.int64)
            for row in bits.collect():  # BITS / 64 rows at most
                marks[row["word"]] = row["v"]
            lookup = f"(shiftrightunsigned(bitmap[cast(shiftrightunsigned(h.code, 6) & {BITS // 64 - 1} as int)], cast(h.code & 63 as int)) & 1L) = 1L"
            held = f"filter(transform(codes, (c, i) -> struct(i as at, c as code)), h -> {lookup})"
            # Of a window's hits, some run of ``least`` keeps within twice its share of the window. An
            # exploded array of none or one, since a filter would be pushed down and work all this out again.
            q = least[width]
            close = f"exists(sequence(0, size(r.held) - {q}), i -> r.held[i + {q - 1}].at - r.held[i].at <= {2 * 100 * q // SIMILAR + 1})"
            some = worded.select("key", "words", codes.alias("codes"), F.lit(marks).alias("bitmap"))
            some = some.select("key", F.expr(f"inline(filter(array(struct(words, {held} as held)), r -> if(size(r.held) < {q}, false, {close})))"))
            some = staged(some, "hits")
            rows = some.select("key", F.inline("held"))
            words = some.select("key", "words")
        else:
            rows, words = worded.select("key", F.posexplode(codes).alias("at", "code")), None
        lengths = own.select("code", "len").distinct()
        lengths = F.broadcast(lengths) if n <= BROADCAST_ROWS else lengths
        placed = rows.join(lengths, "code").groupBy("key", "len").agg(F.array_sort(F.collect_set("at")).alias("at"))
        placed = placed.where(F.expr(f"size(at) >= ceil({SIMILAR} * (len - {width} + 1) / 100)")).withColumn("width", F.lit(width))
        if words is None:
            placed = staged(placed, "hits")
            words = worded.join(placed.select("key").distinct(), "key", "left_semi")
        one = placed.join(words.dropDuplicates(["key"]), "key")
        found = one if found is None else found.unionByName(one)
    return found if found is not None else spark.createDataFrame([], "key struct<doc_id: bigint, digest: string>, len int, at array<int>, width int, words array<bigint>")


def _blocks(marked: DataFrame, items: DataFrame) -> DataFrame:
    """(len, fp, item) of all fingerprints of windows and items of one length within ``RADIUS`` bits, each once."""
    changes = F.lit([x for x in range(1 << 16) if x.bit_count() <= NEAR])
    block = lambda fp, b: f"cast(shiftrightunsigned({fp}, {16 * b}) & 65535 as int)"
    cut = F.posexplode(F.array(*[F.expr(block("fp", b)) for b in range(BLOCKS)])).alias("block", "value")
    sides = items.select("item", "len", F.col("fp").alias("item_fp"), cut)
    probes = sides.withColumn("change", F.explode(changes)).withColumn("value", F.expr("value ^ change")).drop("change")
    probes = F.broadcast(probes) if items.count() * BLOCKS * 137 <= BROADCAST_ROWS else probes
    both = marked.select("len", "fp").distinct().select("len", "fp", cut).join(probes, ["len", "block", "value"])
    first = " and ".join(f"(block <= {b} or bit_count({block('fp ^ item_fp', b)}) > {NEAR})" for b in range(BLOCKS - 1))
    return both.where(f"bit_count(fp ^ item_fp) <= {RADIUS} and {first}").select("len", "fp", "item")


def _beyond(marked: DataFrame, items: DataFrame) -> DataFrame:
    """(key, len, start, item) of windows and items that share one of the item's rarest shingles and lie over ``RADIUS`` bits apart."""
    codes = items.select("item", "len", F.size("codes").alias("n"), F.explode("codes").alias("code"))
    seldom = codes.join(codes.groupBy("code").agg(F.count(F.lit(1)).alias("held")), "code")
    seldom = seldom.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy("held", "code"))).where(f"rank <= n - ceil({SIMILAR} * n / 100) + 1")
    rare = staged(seldom.select("item", "len", "code").distinct().join(items.select("item", F.col("fp").alias("item_fp")), "item"), "rare")
    rare = F.broadcast(rare) if rare.count() <= BROADCAST_ROWS else rare
    held = marked.select("key", "len", "start", "fp", F.explode(F.array_distinct(F.expr(shingles_sql("window", "width")))).alias("code"))
    return held.join(rare, ["len", "code"]).where(f"bit_count(fp ^ item_fp) > {RADIUS}").select("key", "len", "start", "item").distinct()


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(key, item_id, similarity) of each document row and item: the best window's weighted similarity."""
    named = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string").alias("text")).withColumn("item", F.md5(F.col("text").cast("binary")))
    items = named.dropDuplicates(["item"]).select("item", F.expr(words_sql("text")).alias("words"))
    items = items.where(F.size("words") > 0).withColumn("len", F.size("words")).withColumn("width", F.least(F.lit(SHINGLE), "len"))
    items = staged(items.withColumn("codes", F.expr(shingles_sql("words", "width"))).withColumn("fp", F.expr(simhash_sql("words"))).drop("words"), "items")
    table = items.select("len", "width", F.explode("codes").alias("code")).distinct()
    stats = items.groupBy("width").agg(F.min("len").alias("least")).collect()  # SHINGLE rows at most
    least = {r["width"]: -(-SIMILAR * (r["least"] - r["width"] + 1) // 100) for r in stats}
    own = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    hits = _hits(own, table, sorted(least), least)
    # From the first hit of a window on: it begins after the hit before, and late enough to reach the last one needed.
    need = f"cast(ceil({SIMILAR} * (len - width + 1) / 100) as int)"
    low = f"greatest(0, at[i + {need} - 1] - (len - width), if(i = 0, 0, at[greatest(i, 1) - 1] + 1))"
    high = "least(at[i], size(words) - len)"
    starts = f"flatten(transform(sequence(0, size(at) - {need}), i -> if({low} <= {high}, sequence({low}, {high}), cast(array() as array<int>))))"
    windows = f"if(size(words) < len, array(struct(0 as start, words as window)), transform({starts}, s -> struct(s as start, slice(words, s + 1, len) as window)))"
    windows = hits.select("key", "len", "width", F.expr(f"inline({windows})"))
    windows = windows.groupBy("key", "len", "width", "window").agg(F.min("start").alias("start"))
    marked = staged(windows.withColumn("fp", F.expr(f"if(len > {LANE}, 0L, {simhash_sql('window')})")), "windows")
    sides = ["key", "window", "width", "item"]
    near = marked.join(_blocks(marked, items), ["len", "fp"]).select(*sides)
    far = marked.join(_beyond(marked, items), ["key", "len", "start"]).select(*sides)
    bags = items.select("item", F.expr(bag_sql("codes")).alias("item_bag"))
    bags = F.broadcast(bags) if items.count() <= BROADCAST_ROWS else bags
    both = near.unionByName(far).withColumn("bag", F.expr(bag_sql(f"({shingles_sql('window', 'width')})"))).join(bags, "item")
    shared = both.withColumn("shared", F.size(F.array_intersect("bag", "item_bag")))
    judged = shared.withColumn("similarity", F.expr("shared / (size(bag) + size(item_bag) - shared)"))
    judged = judged.where(F.expr(f"100 * shared >= {SIMILAR} * (size(bag) + size(item_bag) - shared)")).groupBy("key", "item").agg(F.max("similarity").alias("similarity"))
    return judged.join(named.select("item", "item_id").distinct(), "item").select("key", "item_id", "similarity")


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns."""
    doc, mark = unused(docs, "leak_doc"), unused(docs, "leak_digest")
    found = staged(leaks(docs, benchmark).select("key.doc_id", "key.digest").distinct(), "leaks").select(F.col("doc_id").alias(doc), F.col("digest").alias(mark))
    digest = F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))
    return docs.join(found, (digest == F.col(mark)) & F.col("doc_id").cast("long").eqNullSafe(F.col(doc)), "left_anti")


def op3_simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))
    each = found.groupBy("key").agg(F.count(F.lit(1)).alias("n_items"), F.array_join(F.array_sort(F.collect_set("item_id")), ",").alias("items"), F.max("similarity").alias("similarity"))
    each = each.select(F.col("key.doc_id").alias("k_doc"), F.col("key.digest").alias("k_digest"), "n_items", "items", "similarity")
    rows = docs.select(F.col("doc_id").cast("long"), F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")).alias("digest"))
    whole = rows.join(each, F.col("doc_id").eqNullSafe(F.col("k_doc")) & (F.col("digest") == F.col("k_digest")), "left")
    return whole.select(
        "doc_id", F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.lit("")).alias("items"), F.round(F.coalesce("similarity", F.lit(0.0)), 6).alias("similarity"),
    )


QUERIES = {"op3_simhash_decontamination": op3_simhash_decontamination}
