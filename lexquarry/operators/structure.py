"""Rules on the units of a provision and on decisions printed side by side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import SPACES, slug

#: A decision as printed: by its court, by its report, or by its report without a year (second place only).
NEUTRAL, REPORTED, SHORT = r"\[\d{4}\]\s+[A-Za-z]+\s+\d+", r"\(\d{4}\)\s+\d+\s+[A-Za-z]+\s+\d+", r"\d+\s+[A-Za-z]+\s+\d+"
PAIR = rf"({NEUTRAL}|{REPORTED})\s*[;,]\s*({NEUTRAL}|{REPORTED}|{SHORT})"


def transparent(units: DataFrame, base: str) -> DataFrame:
    """(base, ordinal) of the units without a label that hand their address space to their parent.

    ``units`` has (base, ordinal, parent, number, term). Siblings without label and term are transparent together unless
    two of them hold a child of one label, for then both children would claim one address. Whatever the order of rows.
    """
    bare = units.where("number is null and term is null").select(base, F.coalesce("parent", F.lit(0)).alias("_above"), F.col("ordinal").alias("_bare")).distinct()
    labels = units.where("number is not null and parent is not null").select(base, F.col("parent").alias("_bare"), "number").distinct()
    clashes = labels.join(bare, [base, "_bare"]).groupBy(base, "_above", "number").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(base, "_above").distinct()
    return bare.join(clashes, [base, "_above"], "left_anti").select(base, F.col("_bare").alias("ordinal"))


def defined_term(kind: Column, spans: Column) -> Column:
    """The term that a definition defines: its first emphasised run, if that is bold and italic and begins the text; else null."""
    first = F.get(spans, F.lit(0))
    return F.when((kind == "definition") & (first["start"] == 0) & (first["weight"] == "bold-italic"), F.nullif(slug(first["text"]), F.lit("")))


def rebased(text: Column, spans: Column) -> Column:
    """Spans (text, start, end, weight) of a raw text, with their places in the text whose white space is collapsed.

    A span shrinks to its words; one of white space alone goes. An offset that doesn't land on its own words raises.
    """
    squeezed = lambda c: F.regexp_replace(c, SPACES, " ")
    clean = F.trim(squeezed(text))
    before = lambda stop: F.ltrim(squeezed(F.substring(text, 1, stop)))

    def moved(s: Column) -> Column:
        words = F.substring(text, s["start"] + 1, s["end"] - s["start"])
        inner = F.trim(squeezed(words))
        # Up to the last of its words a text's length is the same with and without the white space behind them.
        stop = F.length(F.rtrim(before(s["end"])))
        start = stop - F.length(inner)
        told = F.trim(squeezed(s["text"]))
        checked = F.when(F.substring(clean, start + 1, stop - start) == told, told).otherwise(F.raise_error(F.concat(F.lit("emphasis isn't where it says: "), told)).cast("string"))
        return F.when(inner != "", F.struct(checked.alias("text"), start.cast("int").alias("start"), stop.cast("int").alias("end"), s["weight"].alias("weight")))

    return F.array_compact(F.transform(spans, moved))


def parallel_citations(docs: DataFrame, cases: DataFrame, key: str, text: str) -> DataFrame:
    """(key, citation, parallel, parallel_id): the decision printed beside each cited one, of several the first, and its id where it is cited here too.

    ``cases`` has (key, citation, id). Pairs don't overlap and are read from the left, so of three in a row the first two pair.
    """
    pairs = docs.select(key, F.posexplode(F.regexp_extract_all(text, F.lit(PAIR), F.lit(0))).alias("_at", "_pair"))
    pairs = pairs.select(key, "_at", F.regexp_extract("_pair", PAIR, 1).alias("_1"), F.regexp_extract("_pair", PAIR, 2).alias("_2"))
    sides = pairs.select(key, "_at", F.inline(F.array(F.struct(F.col("_1").alias("citation"), F.col("_2").alias("parallel")), F.struct(F.col("_2").alias("citation"), F.col("_1").alias("parallel")))))
    first = sides.groupBy(key, "citation").agg(F.min_by("parallel", F.struct("_at", "parallel")).alias("parallel"))
    cited = cases.groupBy(key, "citation").agg(F.min("id").alias("id"))
    ids = cited.select(key, F.col("citation").alias("parallel"), F.col("id").alias("parallel_id"))
    return cited.join(first, [key, "citation"]).join(ids, [key, "parallel"], "left").select(key, "citation", "parallel", "parallel_id")
