"""Relations that a viewer of the corpus reads: spans in blocks, reading orders, rollups, counters, states of pages.

All are joins, groups and windows whose keys spread; windows are over one page or passage at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.spans import match_spans
from ..functions.text import natural_key, part_order
from .relations import strongest

STRETCH = 4096  # code points of a text that are dealt together


def spans_in_blocks(spans: DataFrame, blocks: DataFrame, key: str) -> DataFrame:
    """Spans (key, start, stop) with the block (key, pos, b_start, b_stop) that holds each whole, offsets within it.

    Both are dealt by stretches of the text, so a long text spreads; a block lies in each stretch that it touches.
    """
    dealt = blocks.select("*", F.explode(F.sequence(F.floor(F.col("b_start") / STRETCH), F.floor(F.col("b_stop") / STRETCH))).alias("_at"))
    met = spans.withColumn("_at", F.floor(F.col("start") / STRETCH)).join(dealt, [key, "_at"]).where("b_start <= start and stop <= b_stop")
    return met.select(key, "pos", (F.col("start") - F.col("b_start")).cast("long").alias("start"), (F.col("stop") - F.col("b_start")).cast("long").alias("stop"))


def as_of(anchors: DataFrame, marks: DataFrame, group: str, at: str, ts: str, seconds: int, first: list[Column], kept: list[str]) -> DataFrame:
    """As-of join with tolerance: of a group's marks up to ``seconds`` before an anchor, the least by ``first``.

    Time is dealt in buckets of the tolerance, so an anchor meets two buckets of its group and not all of it.
    """
    micros = lambda c: F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz '1970-01-01', `{c}`)")
    bucket = lambda c: F.floor(micros(c) / (seconds * 1_000_000))
    near = anchors.withColumn("_bucket", F.explode(F.array(bucket(at), bucket(at) - 1)))
    met = near.join(marks.withColumn("_bucket", bucket(ts)), [group, "_bucket"])
    met = met.where((micros(at) - micros(ts)).between(0, seconds * 1_000_000))
    best = met.groupBy(*anchors.columns).agg(F.min_by(F.struct(*kept), F.struct(*first)).alias("_best"))
    return best.select(*anchors.columns, *[F.col("_best")[x].alias(x) for x in kept])


def parents(chunks: DataFrame, ref: str, headings: str) -> DataFrame:
    """(ref, parent): the last of a chunk's heading addresses that is another chunk's."""
    wanted = chunks.select(F.col(ref).alias("ref"), F.posexplode(headings).alias("_far", "parent")).where("parent <> ref")
    known = chunks.select(F.col(ref).alias("parent")).distinct()
    found = wanted.join(known, "parent").groupBy("ref").agg(F.max_by("parent", "_far").alias("parent"))
    return chunks.select(F.col(ref).alias("ref")).join(found, "ref", "left")


def first_edges(edges: DataFrame, owner: str, unit: str) -> DataFrame:
    """Edges of an owner's units, one for each id, extraction and certainty: the first unit's."""
    keyed = edges.withColumn("certainty", F.coalesce("certainty", F.lit("")))
    return strongest(keyed, [owner, "id", "extraction", "certainty"], F.lit(0), [unit])


def citing_manual(edges: DataFrame, owner: str, unit: str, chunk: str) -> tuple[DataFrame, DataFrame]:
    """(owner, n_chunks, n_units) that passages cite, and (owner, unit, n_chunks) of the units cited by themselves."""
    whole = edges.groupBy(owner).agg(F.countDistinct(chunk).alias("n_chunks"), F.countDistinct(F.when(F.col(unit) != F.col(owner), F.col(unit))).alias("n_units"))
    return whole, edges.where(F.col(unit) != F.col(owner)).groupBy(owner, unit).agg(F.countDistinct(chunk).alias("n_chunks"))


def sized(owners: DataFrame, key: str, group: str, items: DataFrame, marked: Column) -> DataFrame:
    """(group, n_owners, n_items, n_marked): items of each group's owners, with those that are marked; owners without items count."""
    each = items.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.count_if(marked).alias("_m"))
    return owners.select(group, key).join(each, key, "left").groupBy(group).agg(
        F.count(F.lit(1)).alias("n_owners"), F.coalesce(F.sum("_n"), F.lit(0)).alias("n_items"), F.coalesce(F.sum("_m"), F.lit(0)).alias("n_marked")
    )


def stored_size(files: DataFrame, size: Column) -> DataFrame:
    """One row: files, bytes, and the mean rounded half to even."""
    return files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes"), F.bround(F.avg(size), 0).cast("long").alias("mean_bytes"))


def first_seen(items: DataFrame, key: str, value: str, order: list[str]) -> DataFrame:
    """(key, first value in order, n); of values that come first together, the least."""
    return items.groupBy(key).agg(F.min_by(value, F.struct(*order, value)).alias(value), F.count(F.lit(1)).alias("n"))


def counters(rows: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """One row: how many rows pass each test."""
    return rows.agg(*[F.count_if(F.coalesce(test, F.lit(False))).alias(name) for name, test in tests.items()])


def cell_starts(cells: DataFrame, group: list[str], order: list[str], text: str) -> DataFrame:
    """Adds ``start``: the offset of each cell's text in its table's, cells joined by one space, empty ones adding nothing."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    size = F.when(F.length(text) > 0, F.length(text) + 1).otherwise(0)
    return cells.withColumn("start", F.coalesce(F.sum(size).over(w), F.lit(0)).cast("long"))


def fresh_headings(chunks: DataFrame, group: str, order: str, path: str) -> DataFrame:
    """Adds ``shown``: the headings of a path that the chunk before doesn't have at that depth, null where it has them."""
    before = F.lag(path).over(Window.partitionBy(group).orderBy(order))
    shown = F.transform(path, lambda h, i: F.when(~F.slice(path, 1, i + 1).eqNullSafe(F.slice("_before", 1, i + 1)), h))
    return chunks.withColumn("_before", F.coalesce(before, F.array().cast("array<string>"))).withColumn("shown", shown).drop("_before")


def reading_order(part: str, ordinal: str, ref: str) -> list[Column]:
    """Part by number, place in the nav, address."""
    return [part_order(F.col(part)), F.col(ordinal).asc_nulls_last(), F.col(ref)]


def viewer_order(part: str) -> list[Column]:
    """Parts by their digits, then by id."""
    return [part_order(F.col(part)), F.col(part)]


def export_order(year: str, citation: str, ref: str) -> list[Column]:
    """Year by value, citation, address; a year that is no number comes first."""
    return [F.coalesce(F.col(year).try_cast("int"), F.lit(0)), F.col(citation), F.col(ref)]


def traversal_order(kind: str, label: str, first: str = "part") -> list[Column]:
    """One kind of node before all others, then labels with numbers by value."""
    return [F.when(F.col(kind) == first, 0).otherwise(1), natural_key(F.lower(label)), F.col(label)]


def scoped(pages: DataFrame, part: str | None, limit: int | None, part_id: str, order: list[Column]) -> DataFrame:
    """The pages of a run: those of one part, then the first ``limit`` in reading order; a part that no page has raises."""
    if part is not None:
        pages = pages.where(F.col(part_id) == part)
        if pages.isEmpty():
            raise ValueError(f"no page has the part {part}")
    return pages if limit is None else pages.orderBy(*order).limit(limit)


def required(left: DataFrame, key: str, right: DataFrame, right_key: str, what: str) -> DataFrame:
    """Left join that raises where ``right`` hasn't the key."""
    held = right.withColumn("_held", F.lit(True)).withColumnRenamed(right_key, "_key")
    met = left.join(held, F.col(key) == F.col("_key"), "left")
    checked = F.when(F.col("_held"), F.col(key)).otherwise(F.raise_error(F.concat(F.lit(f"no {what} "), F.col(key).cast("string"))).cast(left.schema[key].dataType))
    return met.withColumn(key, checked).drop("_held", "_key")


def carried_unreachable(previous: DataFrame, fresh: DataFrame, nav: DataFrame, checked: DataFrame, key: str) -> DataFrame:
    """Pages that couldn't be reached: this run's, and earlier ones that are still in the nav and weren't checked since."""
    keys = lambda df: df.select(key).distinct()
    earlier = previous.join(keys(nav), key, "left_semi").join(keys(checked), key, "left_anti").join(keys(fresh), key, "left_anti")
    return fresh.unionByName(earlier.select(*fresh.columns))


def crawl_state(nav: DataFrame, pages: DataFrame, chunks: DataFrame, key: str) -> DataFrame:
    """(key, state) of every page of the nav: never crawled, crawled and empty, or held."""
    had = lambda df, name: df.select(key).distinct().withColumn(name, F.lit(True))
    joined = nav.select(key).join(had(pages, "_page"), key, "left").join(had(chunks, "_chunk"), key, "left")
    return joined.select(key, F.when(F.col("_chunk"), "held").when(F.col("_page"), "empty").otherwise("never").alias("state"))


def stable_list(items: DataFrame, key: str, fields: list[str], name: str) -> DataFrame:
    """(key, name): each key's items as an array in one order, whatever order they came in; missing fields sort as empty."""
    one = F.struct(*[F.coalesce(F.col(x).cast("string"), F.lit("")).alias(x) for x in fields])
    return items.groupBy(key).agg(F.array_sort(F.collect_list(one)).alias(name))


def highlights(docs: DataFrame, key: str, text: str, needle: str) -> DataFrame:
    """(key, start, stop) of every occurrence of a word or phrase, in any case of letters, none overlapping."""
    quoted = "".join(f"\\{c}" if not c.isalnum() and c.isascii() else c for c in needle.lower())
    found = docs.select(key, F.inline(F.expr(match_spans(f"lower(`{text}`)", quoted))))
    return found.select(key, F.col("start").cast("long").alias("start"), F.col("stop").cast("long").alias("stop"))


def haystack(*columns: str) -> Column:
    """What a substring search looks through: addresses, headings and text in lower case."""
    return F.lower(F.concat_ws(" ", *columns))


def reassembled(chunks: DataFrame, page: str, order: str, text: str) -> DataFrame:
    """(page, text): a page's chunks put together again in order."""
    held = F.array_sort(F.collect_list(F.struct(order, text)))
    return chunks.groupBy(page).agg(F.array_join(F.transform(held, lambda x: x[text]), "\n\n").alias("text"))


def hidden_by(edges: DataFrame, kinds: list[str], least: int, allowed: DataFrame | None = None) -> DataFrame:
    """Edges with ``hidden_by``: exactly the filters that hide each, so that those and no others can be relaxed."""
    out, ends = edges, F.lit(None).cast("string")
    if allowed is not None:
        for end in ("source", "target"):
            out = out.join(allowed.select(F.col("id").alias(end)).distinct().withColumn(f"_{end}", F.lit(True)), end, "left")
        ends = F.when(F.col("_source").isNull() | F.col("_target").isNull(), "group")
    filters = F.array(F.when(~F.col("kind").isin(kinds), "kind"), F.when(F.col("weight") < least, "weight"), ends)
    return out.withColumn("hidden_by", F.array_join(F.array_compact(filters), ",")).drop("_source", "_target")


def neighbour_groups(neighbours: DataFrame, groups: DataFrame) -> DataFrame:
    """Neighbours (id, direction, weight) by the group of each (id, label): number, weight, and the heading's place."""
    each = neighbours.join(groups, "id").groupBy("direction", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("weight"))
    return each.withColumn("place", F.row_number().over(Window.partitionBy("direction").orderBy(F.desc("n"), "label")).cast("long"))


def nearest_to_centre(placed: DataFrame, group: str) -> DataFrame:
    """(group, id): of each group's nodes (id, x, y), that nearest to the middle of their bounding box."""
    box = placed.groupBy(group).agg(((F.min("x") + F.max("x")) / 2).alias("_x"), ((F.min("y") + F.max("y")) / 2).alias("_y"))
    far = (F.col("x") - F.col("_x")) * (F.col("x") - F.col("_x")) + (F.col("y") - F.col("_y")) * (F.col("y") - F.col("_y"))
    return placed.join(box, group).groupBy(group).agg(F.min_by("id", F.struct(far, "id")).alias("id"))


def part_diff(before: DataFrame, after: DataFrame, part: str) -> DataFrame:
    """(part, status) of parts (part, title, n): added, removed, renamed, resized, both or unchanged."""
    b, a = before.select(part, F.col("title").alias("_b"), F.col("n").alias("_bn")), after.select(part, F.col("title").alias("_a"), F.col("n").alias("_an"))
    changes = F.array_join(F.array_compact(F.array(F.when(~F.col("_b").eqNullSafe(F.col("_a")), "renamed"), F.when(F.col("_bn") != F.col("_an"), "resized"))), ",")
    status = F.when(F.col("_bn").isNull(), "added").when(F.col("_an").isNull(), "removed").when(changes == "", "unchanged").otherwise(changes)
    return b.join(a, part, "full_outer").select(part, status.alias("status"))


def bumped(changes: DataFrame, version: str) -> DataFrame:
    """Rows of ``changes.compared`` with ``bump_only``: nothing moved but the version that made the page."""
    return changes.withColumn("bump_only", (F.col("status") == "reworded") & (F.col("moved") == version))


def silent_amendments(before: DataFrame, after: DataFrame, key: str, body: str, log: str) -> DataFrame:
    """(key) of the pages whose body moved although their amendment log didn't."""
    b = before.select(key, F.col(body).alias("_body"), F.col(log).alias("_log"))
    return after.join(b, key).where(~F.col(body).eqNullSafe(F.col("_body")) & F.col(log).eqNullSafe(F.col("_log"))).select(key)


def readdressed(before: DataFrame, after: DataFrame, key: str, url: str) -> DataFrame:
    """(key, was, now) of the pages whose url moved."""
    return after.join(before.select(key, F.col(url).alias("was")), key).where(~F.col(url).eqNullSafe(F.col("was"))).select(key, "was", F.col(url).alias("now"))


def first_wins(spans: DataFrame, group: list[str], start: str, stop: str, order: list[str]) -> DataFrame:
    """The spans that stand when those of a group are laid down by start: one that begins before the end of the last laid one goes, and so do empty ones.

    Spans that start together come by ``order``. One fold a group, which is one passage's spans; all columns stay.
    """
    rest = [c for c in spans.columns if c not in group]
    sort = [start, *order, *[c for c in rest if c not in (start, *order)]]
    laid = spans.where((F.col(start) >= 0) & (F.col(stop) > F.col(start))).groupBy(*group).agg(F.array_sort(F.collect_list(F.struct(*sort))).alias("_spans"))
    kind = laid.schema["_spans"].dataType
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(kind).alias("kept"))

    def lay(acc: Column, s: Column) -> Column:
        stands = s[start] >= acc["at"]
        return F.struct(F.when(stands, s[stop].cast("long")).otherwise(acc["at"]).alias("at"), F.when(stands, F.array_append(acc["kept"], s)).otherwise(acc["kept"]).alias("kept"))

    return laid.select(*group, F.inline(F.aggregate("_spans", begin, lay, lambda acc: acc["kept"]))).select(*spans.columns)


CELL = "struct<row:int,seat:int,column:int,colspan:int,rowspan:int,text:string>"


def occupied(cells: str) -> Column:
    """The cells of a grid (SQL for an array of rows of (text, colspan, rowspan)) with the row and column where each begins, as an array of ``CELL``.

    A cell begins at the first column, after the cell before it, that no cell of a row above reaches into. A missing span, or one under 1, is 1.
    """
    span = lambda x: f"greatest(coalesce(c.{x}, 1), 1)"
    # ``busy`` holds for each column the first row where it is free again.
    column = "filter(sequence(a.at, greatest(a.at, size(a.busy))), k -> coalesce(get(a.busy, k), 0) <= t.row)[0]"
    reach = f"transform(sequence(0, greatest(size(a.busy), p.k + {span('colspan')}) - 1), k -> if(k between p.k and p.k + {span('colspan')} - 1, greatest(t.row + {span('rowspan')}, coalesce(get(a.busy, k), 0)), coalesce(get(a.busy, k), 0)))"
    one = f"array(named_struct('row', t.row, 'seat', a.seat, 'column', p.k, 'colspan', {span('colspan')}, 'rowspan', {span('rowspan')}, 'text', c.text))"
    cell = f"(a, c) -> transform(array(named_struct('k', {column})), p -> named_struct('at', p.k + {span('colspan')}, 'seat', a.seat + 1, 'busy', {reach}, 'out', concat(a.out, {one})))[0]"
    row = f"aggregate(coalesce(r, array()), named_struct('at', 0, 'seat', 0, 'busy', t.busy, 'out', t.out), {cell})"
    step = f"(t, r) -> transform(array({row}), x -> named_struct('row', t.row + 1, 'busy', x.busy, 'out', x.out))[0]"
    return F.expr(f"aggregate({cells}, named_struct('row', 0, 'busy', cast(array() as array<int>), 'out', cast(array() as array<{CELL}>)), {step}, t -> t.out)")


def table_cells(chunks: DataFrame, key: str = "chunk_ref") -> DataFrame:
    """(key, table, block, row, seat, column, colspan, rowspan, text, heading) of all cells of chunks' tables (key, blocks, tables).

    The k-th block of kind table is the k-th table; ``block`` is its place among all blocks, null if there are fewer such blocks than tables. ``heading`` marks
    the cells of the declared header row.
    """
    places = F.filter(F.transform("blocks", lambda b, i: F.when(b["kind"] == "table", i)), lambda i: i.isNotNull())
    rows = chunks.select(key, places.alias("_places"), F.posexplode("tables").alias("_k", "_table"))
    cells = rows.select(key, (F.col("_k") + 1).alias("table"), F.get("_places", F.col("_k")).alias("block"), F.col("_table.header_row").alias("_head"), F.inline(occupied("_table.cells")))
    return cells.withColumn("heading", F.coalesce(F.col("row") == F.col("_head"), F.lit(False))).drop("_head")
