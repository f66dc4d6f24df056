"""Structure of compiled instruments: styled paragraphs to containers, provisions and endnotes, by running counts over window functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CONTAINERS = {"ActHead1": 1, "ActHead2": 2, "ActHead3": 3, "ActHead4": 4}
PROVISION, ITEM = ("ActHead5",), ("ItemHead",)
ENDNOTES = ("ENotesHeading1", "ENotesHeading2")


def segmented(paragraphs: DataFrame, instrument: str = "instrument") -> DataFrame:
    """Styled paragraphs (instrument, pos, style, text) with their provision's heading and containers.

    A container opens at its heading and closes at the next of its level or above.
    """
    w = Window.partitionBy(instrument).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    out = paragraphs
    for style, level in CONTAINERS.items():
        above = [s for s, n in CONTAINERS.items() if n < level]
        opened = F.when(F.col("style") == style, F.struct("pos", "text")).when(F.col("style").isin(above), F.struct(F.lit(None).cast("int").alias("pos"), F.lit(None).cast("string").alias("text")))
        out = out.withColumn(f"c{level}", F.last(opened, ignorenulls=True).over(w)["text"])
    heading = F.last(F.when(F.col("style").isin(*PROVISION, *ITEM), F.col("text")), ignorenulls=True).over(w)
    seat = F.sum(F.col("style").isin(*PROVISION, *ITEM).cast("int")).over(w)
    notes = F.max(F.col("style").isin(*ENDNOTES)).over(w)
    return out.withColumns({"provision": heading, "provision_pos": seat, "in_endnotes": notes, "containers": F.filter(F.array("c1", "c2", "c3", "c4"), lambda c: c.isNotNull())}).drop("c1", "c2", "c3", "c4")


def contents(paragraphs: DataFrame, instrument: str = "instrument") -> DataFrame:
    """(instrument, ordinal, number, title, containers) of each provision in document order; raises nothing, see ``repeated``."""
    rows = segmented(paragraphs, instrument).where(F.col("style").isin(*PROVISION, *ITEM) & ~F.col("in_endnotes"))
    number = F.regexp_extract("text", r"^\s*(?:Item\s+)?([0-9]+[A-Z]*(?:\.[0-9]+[A-Z]*)*)", 1)
    return rows.select(instrument, F.row_number().over(Window.partitionBy(instrument).orderBy("pos")).alias("ordinal"), number.alias("number"), F.trim(F.regexp_replace("text", r"^\s*(?:Item\s+)?[0-9.A-Z]+\s+", "")).alias("title"), "containers")


def endnotes(paragraphs: DataFrame, instrument: str = "instrument") -> DataFrame:
    """(instrument, number, title, paragraphs) of each endnote section."""
    w = Window.partitionBy(instrument).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    head = F.col("style").isin(*ENDNOTES)
    rows = paragraphs.withColumn("_n", F.sum(head.cast("int")).over(w)).where("_n > 0")
    return rows.groupBy(instrument, "_n").agg(F.min_by("text", "pos").alias("title"), F.transform(F.array_sort(F.collect_list(F.when(~head, F.struct("pos", "text")))), lambda x: x["text"]).alias("paragraphs")).select(instrument, F.regexp_extract("title", r"(?i)^endnote\s+([0-9]+)", 1).try_cast("int").alias("number"), "title", "paragraphs")
