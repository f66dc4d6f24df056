"""Cases as cited: parsed citations, the parties that emphasis names, and items that texts hold."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A neutral citation (year, court, number) and a reported one (year, volume, series, page).
NEUTRAL = r"\[(1[89][0-9]{2}|20[0-9]{2})\] ([A-Z][A-Za-z]{1,9}) ([0-9]+)"
REPORTED = r"\((1[89][0-9]{2}|20[0-9]{2})\) ([0-9]+) ([A-Z]{2,6}) ([0-9]+)"


def parsed_citations(found: DataFrame) -> DataFrame:
    """Adds year, court or series, volume and number; ``known`` is false for a shape that is neither."""
    neutral = F.regexp_extract("citation", NEUTRAL, 1) != ""
    return found.select(
        "*",
        F.when(neutral, F.regexp_extract("citation", NEUTRAL, 1)).otherwise(F.regexp_extract("citation", REPORTED, 1)).alias("year"),
        F.when(neutral, F.regexp_extract("citation", NEUTRAL, 2)).otherwise(F.regexp_extract("citation", REPORTED, 3)).alias("series"),
        F.when(neutral, F.lit("")).otherwise(F.regexp_extract("citation", REPORTED, 2)).alias("volume"),
        F.when(neutral, F.regexp_extract("citation", NEUTRAL, 3)).otherwise(F.regexp_extract("citation", REPORTED, 4)).alias("number"),
        (neutral | (F.regexp_extract("citation", REPORTED, 1) != "")).alias("known"),
    )


def emphasis_evidence(found: DataFrame, emphasis: DataFrame, docs: DataFrame, key: str, text: str, reach: int = 3) -> DataFrame:
    """Adds ``parties``: the longest emphasised stretch that ends at most ``reach`` characters before a citation, with only punctuation between."""
    spans = emphasis.select(F.col(key).alias("_k"), F.col("words").alias("_words"), F.col("start").alias("_s"), F.col("stop").alias("_e"))
    met = found.join(docs.select(key, text), key).join(spans, (F.col(key) == F.col("_k")) & (F.col("_e") <= F.col("start")) & (F.col("_e") >= F.col("start") - reach))
    met = met.where(F.expr(f"substring(`{text}`, _e + 1, start - _e) rlike '^[\\\\s,;:(]*$'"))
    best = met.groupBy(key, "id").agg(F.min_by("_words", F.struct(-F.length("_words"), "_s")).alias("parties"))
    return found.join(best, [key, "id"], "left")


GRAMS = ((8, None), (4, 7), (1, 3))  # of short items, by their length in characters: from, to


def contained(docs: DataFrame, items: DataFrame, text: str, item: str, key: str = "doc_id") -> DataFrame:
    """Pairs where the text holds the item, found by hash joins on keys and then tested.

    A text that holds an item of five words or more holds three inner words, whole, at the same distance. Shorter items needn't hold a whole word of
    the text; they are keyed by their first 8, 4 or 1 characters, which stand somewhere in the text. An empty item is in every text that isn't null.
    """
    words = lambda c: F.split(c, r"[ \n]")
    triples = lambda c, a, n: F.transform(F.sequence(F.lit(a), F.greatest(n, F.lit(a))), lambda i: F.xxhash64(F.get(c, i), F.get(c, i + 1), F.get(c, i + 2)))
    own = items.withColumn("_w", words(F.col(item)))
    marked = docs.withColumn("_w", words(F.col(text)))
    probes = marked.where(F.size("_w") >= 3).select(key, F.explode(F.array_distinct(triples(F.col("_w"), 0, F.size("_w") - 3))).alias("_key"))
    keyed = [(probes, own.where(F.size("_w") >= 5).withColumn("_key", triples(F.col("_w"), 1, F.lit(1))[0]).drop("_w"))]
    short, size = own.where(F.size("_w") < 5).drop("_w"), F.length(item)
    for least, most in GRAMS:
        grams = F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{least}}}))"), F.lit(1)))
        some = short.where((size >= least) if most is None else size.between(least, most)).withColumn("_key", F.xxhash64(F.substring(item, 1, least)))
        keyed.append((docs.select(key, F.explode(grams).alias("_gram")).select(key, F.xxhash64("_gram").alias("_key")), some))
    # Only keys of documents are dealt out; the text joins the few that meet an item.
    met = reduce(DataFrame.unionByName, [p.join(i, "_key").drop("_key") for p, i in keyed]).distinct()
    hits = docs.join(met, key).where(F.contains(F.col(text), F.col(item)))
    everywhere = docs.where(F.col(text).isNotNull()).join(short.where(size == 0))
    return hits.unionByName(everywhere.select(*hits.columns)).distinct()
