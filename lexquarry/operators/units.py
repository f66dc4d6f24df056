"""Units of a provision: styled paragraphs placed below each other, and each given an address of its own.

1. What a paragraph says of itself is read in SQL: kind and depth by its style, its label, the term that it defines, its words with the
   emphasis re-based onto them.
2. Its parent depends on the paragraphs before it, so that step streams each provision in order and holds the open units only.
3. Which units without a label hand their address space to their parent depends on units after them; that is a join (``structure.transparent``).
4. Addresses depend on seats taken before, so they are streamed in order again. Below one address ``x``, both units without a label and
   later units of the label take ``x~n``, the first from 1 on, the second from 2 on, each the first free one. So what is taken is always 2..m, with or
   without 1, and a flag and a number hold it. Seats below an address go once nothing can claim them any more.
5. All units of a label that siblings share are flagged, the first too: a join on the wanted address.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import SPACES
from . import structure

#: Style of a paragraph to kind and depth of its unit; notes to their depth below the note that they belong to.
STYLES = {
    "subsection": ("subsection", 0), "subsection2": ("text", 0), "Definition": ("definition", 0), "SubsectionHead": ("heading", 0), "Penalty": ("penalty", 0), "Item": ("text", 0), "Specials": ("special", 0),
    "Tabletext": ("text", 0), "Tablea": ("text", 0), "Tablei": ("text", 0), "TableHeading": ("text", 0), "MadeunderText": ("text", 0), "ItemHead": ("heading", 0), "paragraph": ("paragraph", 1),
    "paragraphsub": ("paragraph", 2), "paragraphsub-sub": ("paragraph", 3), "<table>": ("table", 0), None: ("text", 0),
}
NOTES = {"notetext": 0, "noteToPara": 0, "notemargin": 0, "notepara": 1}
LABEL = r"^\(([0-9a-zA-Z]{1,4})\)$"
SPANS = "array<struct<text:string,start:int,end:int,weight:string>>"


class UnitError(ValueError):
    """A paragraph whose place below its provision isn't known: its style is in no table."""


def number(kind: Column, text: Column) -> Column:
    """The label that stands alone before the first tab, brackets kept; notes, headings and tables have none."""
    strip = lambda x: F.regexp_replace(x, rf"^{SPACES}|{SPACES}$", "")
    first = strip(F.get(F.filter(F.split(text, "\t"), lambda x: strip(x) != ""), F.lit(0)))
    return F.when(~kind.isin("note", "heading", "table") & first.rlike(LABEL), first)


def placed(rows: Iterable[tuple], base: str) -> Iterator[tuple[str, int, int | None]]:
    """(kind, depth, parent's ordinal) of one provision's styles in order.

    The parent is the nearest shallower open unit, headings aside. A note stands below the unit that it follows, a note's own
    paragraph below that note.
    """
    opened: dict[int, tuple[int, str]] = {}
    unit = note = None  # (ordinal, depth) of the last that is no note, and of the last note since that begins one
    for ordinal, style in enumerate(rows, 1):
        if style in NOTES:
            anchor = (note or unit) if NOTES[style] else unit
            kind, depth, parent = "note", anchor[1] + 1 if anchor else 0, anchor and anchor[0]
        elif style in STYLES:
            kind, depth = STYLES[style]
            parent = next((opened[d][0] for d in sorted(opened, reverse=True) if d < depth and opened[d][1] != "heading"), None)
        else:
            raise UnitError(f"{base}: no unit has the style {style!r}")
        opened = {d: x for d, x in opened.items() if d < depth} | {depth: (ordinal, kind)}
        if kind != "note":
            unit, note = (ordinal, depth), None
        elif not NOTES[style]:
            note = (ordinal, depth)
        yield kind, depth, parent


class Seats:
    """What is taken of x~1, x~2, ...: 2 to ``last``, and 1 if ``first``."""

    __slots__ = ("first", "last")

    def __init__(self):
        self.first, self.last = False, 1

    def take(self, bare: bool) -> int:
        """The first free seat of a unit without a label, or of a later one of a label."""
        if bare and not self.first:
            self.first = True
            return 1
        self.last += 1
        return self.last


def addressed(rows: Iterable[tuple], base: str) -> Iterator[tuple[str, str | None, str | None, bool]]:
    """(ref, parent_ref, wanted address if labelled, whether it was taken) of one provision's units (ordinal, parent, label, transparent) in order.

    Held are the ancestors of the last unit, and the seats below addresses that can still be claimed.
    """
    stack: list[tuple[int | None, str, str]] = [(None, base, base)]  # ordinal, own address, address that children build on
    seats: dict[str, Seats] = {base: Seats()}
    owned: dict[str, list[str]] = {}  # labelled addresses by the address that they are built on
    owners: set[str] = set()  # labelled addresses that a later unit may want again
    for ordinal, parent, label, transparent in rows:
        while stack[-1][0] != parent:
            _, closed, space = stack.pop()
            if space == closed:
                for x in owned.pop(closed, ()):
                    seats.pop(x, None)
                    owners.discard(x)
            if closed not in owners:
                seats.pop(closed, None)
        _, above, space = stack[-1]
        wanted, again = None, False
        if label is None:
            ref = f"{above}~{seats.setdefault(above, Seats()).take(True)}"
        else:
            wanted = ref = space + label
            again = wanted in owners
            if again:
                ref = f"{wanted}~{seats.setdefault(wanted, Seats()).take(False)}"
            else:
                owners.add(wanted)
                owned.setdefault(space, []).append(wanted)
        stack.append((ordinal, ref, space if transparent else ref))
        yield ref, None if parent is None else above, wanted, again


def _streamed(rows: DataFrame, base: str, ordinal: str, given: list[str], made, schema: str) -> DataFrame:
    """``made(values, base)`` of each provision's rows in the order of ``ordinal``, joined to their (base, ordinal)."""
    kinds = {"string": pa.string(), "int": pa.int32(), "boolean": pa.bool_()}
    fields = [x.rsplit(" ", 1) for x in schema.split(", ")]
    arrow = pa.schema([(n, kinds[k]) for n, k in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = (x for batch in batches for x in zip(*[batch[c].to_pylist() for c in (base, ordinal, *given)], strict=True))
        out = ((key, x[1], *y) for key, some in groupby(each, lambda x: x[0]) for x, y in _beside(some, lambda xs, key=key: made((v[1:] for v in xs), key)))
        while held := list(islice(out, 5_000)):
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*held), arrow, strict=True)], schema=arrow)

    return rows.select(base, ordinal, *given).repartition(base).sortWithinPartitions(base, ordinal).mapInArrow(run, schema)


def _beside(rows: Iterable[tuple], made) -> Iterator[tuple[tuple, tuple]]:
    """Each row with what ``made`` gives for it, one by one."""
    last: list[tuple] = []

    def watched():
        for row in rows:
            last.append(row)
            yield row

    for result in made(watched()):
        yield last.pop(), result


def units(paragraphs: DataFrame, base: str = "provision_ref") -> DataFrame:
    """Addressed units of paragraphs (base, pos, style, text, and spans where they are known): (base, ref, parent_ref, ordinal, depth, kind, style, number, term, text, emphasis, number_collision).

    Paragraphs of one provision are ordered by ``pos``, then by style and text where that is equal; a null text has no words. A paragraph without style is text,
    one of an unknown style raises ``UnitError``. ``spans`` are stretches (text, start, end, weight) of the raw text.
    """
    spans = F.col("spans").cast(SPANS) if "spans" in paragraphs.columns else F.lit(None).cast(SPANS)
    seat = F.row_number().over(Window.partitionBy(base).orderBy("pos", "style", "text"))
    rows = paragraphs.select(base, "style", F.col("text").alias("_raw"), spans.alias("_spans"), seat.alias("ordinal"))
    tree = _streamed(rows, base, "ordinal", ["style"], lambda xs, key: placed((style for _, style in xs), key), f"{base} string, ordinal int, kind string, depth int, parent int")
    same = lambda right: F.col(f"l.{base}").eqNullSafe(F.col(f"r.{base}")) & (F.col("l.ordinal") == F.col(f"r.{right}"))
    own = rows.alias("l").join(tree.alias("r"), same("ordinal")).select("l.*", "kind", "depth", "parent")
    own = own.withColumns({"text": F.regexp_replace(F.regexp_replace("_raw", SPACES, " "), "^ | $", ""), "emphasis": structure.rebased(F.col("_raw"), F.col("_spans")), "number": number(F.col("kind"), F.col("_raw"))})
    own = own.withColumn("term", F.when(F.col("number").isNull(), structure.defined_term(F.col("kind"), F.col("emphasis")))).drop("_raw", "_spans")
    clear = structure.transparent(own, base).withColumn("_clear", F.lit(True))
    label = F.coalesce("number", F.concat(F.lit("/"), "term"))
    told = own.alias("l").join(clear.alias("r"), same("ordinal"), "left").select("l.*", F.coalesce("_clear", F.lit(False)).alias("_clear"), label.alias("_label"))
    schema = f"{base} string, ordinal int, ref string, parent_ref string, wanted string, again boolean"
    refs = _streamed(told, base, "ordinal", ["parent", "_label", "_clear"], addressed, schema)
    out = own.alias("l").join(refs.alias("r"), same("ordinal")).select("l.*", "ref", "parent_ref", "wanted", "again")
    twice = refs.where("again").select(F.col(base).alias("_base"), F.col("wanted").alias("_wanted")).distinct()
    # The own address of a unit without a label spreads the join and meets no wanted one.
    out = out.join(twice, F.col(base).eqNullSafe(F.col("_base")) & (F.coalesce("wanted", "ref") == F.col("_wanted")), "left")
    flagged = (F.col("_wanted").isNotNull() & F.col("wanted").isNotNull()).alias("number_collision")
    return out.select(base, "ref", "parent_ref", "ordinal", "depth", "kind", "style", "number", "term", "text", "emphasis", flagged)
