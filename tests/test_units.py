"""Units of provisions: places, labels, terms, transparent units, seats and collisions."""

import random

import pytest

from lexquarry.operators import units

KIND = f"provision_ref string, pos int, style string, text string, spans {units.SPANS}"


def made(spark, rows):
    return units.units(spark.createDataFrame(rows, KIND).repartition(3)).orderBy("provision_ref", "ordinal").collect()


def refs(spark, lines):
    return [(r["ref"], r["parent_ref"], r["number_collision"]) for r in made(spark, [("P", i, s, t, None) for i, (s, t) in enumerate(lines)])]


def test_places_labels_and_collisions(spark):
    lines = [("subsection", "\t(1)\ta"), ("paragraph", "\t(a)\tb"), ("notetext", "Note:\tx"), ("notepara", "(a)\tof the note"), ("notepara", "(b)\tof the note"), ("paragraph", "\t(a)\tc"), ("subsection", "(2) plain"), ("SubsectionHead", "(3)\tHead"), ("paragraph", "\t(a)\td"), (None, " \xa0 two \t words ")]
    got = made(spark, [("P", i, s, t, None) for i, (s, t) in enumerate(lines)])
    assert [(r["ref"], r["parent_ref"], r["depth"], r["number_collision"]) for r in got] == [
        ("P(1)", None, 0, False), ("P(1)(a)", "P(1)", 1, True), ("P(1)(a)~1", "P(1)(a)", 2, False), ("P(1)(a)~1~1", "P(1)(a)~1", 3, False), ("P(1)(a)~1~2", "P(1)(a)~1", 3, False),
        ("P(1)(a)~2", "P(1)", 1, True), ("P~1", None, 0, False), ("P~2", None, 0, False), ("P(a)", None, 1, False), ("P~3", None, 0, False)]
    assert got[0]["number"] == "(1)" and got[6]["number"] is None and got[9]["text"] == "two words"


def test_a_seat_is_never_taken_twice(spark):
    """Notes below the first (a) hold the addresses that later (a)s would get."""
    lines = [("paragraph", "(a)\tx"), ("notetext", "n"), ("notetext", "n"), ("paragraph", "(a)\tx"), ("paragraph", "(a)\tx"), ("paragraph", "(b)\tx"), ("paragraph", "(a)\tx"), ("notetext", "n")]
    assert [r[0] for r in refs(spark, lines)] == ["P(a)", "P(a)~1", "P(a)~2", "P(a)~3", "P(a)~4", "P(b)", "P(a)~5", "P(a)~5~1"]


def test_transparent_units(spark):
    """One series of labels over two openings is addressed from the parent; openings that restart it aren't."""
    one = [("subsection2", "first"), ("paragraph", "(a)\tx"), ("paragraph", "(b)\tx"), ("subsection2", "then"), ("paragraph", "(c)\tx")]
    assert [r[0] for r in refs(spark, one)] == ["P~1", "P(a)", "P(b)", "P~2", "P(c)"]
    assert [r[0] for r in refs(spark, [*one, ("subsection2", "more"), ("paragraph", "(a)\tx")])] == ["P~1", "P~1(a)", "P~1(b)", "P~2", "P~2(c)", "P~3", "P~3(a)"]


def test_terms_and_emphasis(spark):
    span = [("Big  Word", 1, 10, "bold-italic"), ("means", 11, 16, "bold")]
    rows = [("P", 0, "Definition", "\tBig  Word means:", span), ("P", 1, "paragraph", "(a)\tx", None), ("P", 2, "Definition", "other", [("other", 0, 5, "bold")]), ("P", 3, "Definition", "Big word", [("Big word", 0, 8, "bold-italic")]), ("Q", 0, "subsection", None, None)]
    got = made(spark, rows)
    assert [(r["ref"], r["term"], r["number_collision"]) for r in got] == [("P/big-word", "big-word", True), ("P/big-word(a)", None, False), ("P~1", None, False), ("P/big-word~2", "big-word", True), ("Q~1", None, False)]
    assert [tuple(x) for x in got[0]["emphasis"]] == [("Big Word", 0, 8, "bold-italic"), ("means", 9, 14, "bold")]


def test_unknown_styles_raise(spark):
    with pytest.raises(units.UnitError, match="style 'Unheard'"):
        list(units.placed(["subsection", "Unheard"], "B"))
    with pytest.raises(Exception, match="B: no unit has the style 'Unheard'"):
        made(spark, [("B", 0, "Unheard", "a", None)])
    assert spark.createDataFrame([], KIND).transform(units.units).count() == 0


def plain(rows, base):
    """All addresses in one set, seats sought one by one."""
    claimed, ref, space, out = {base}, {None: base}, {None: base}, []
    for ordinal, parent, label, clear in rows:
        want = None if label is None else space[parent] + label
        if label is None:
            mine = next(x for n in range(1, 10**6) if (x := f"{ref[parent]}~{n}") not in claimed)
        elif want in claimed:
            mine = next(x for n in range(2, 10**6) if (x := f"{want}~{n}") not in claimed)
        else:
            mine = want
        out.append((mine, None if parent is None else ref[parent], want, label is not None and want in claimed))
        claimed.add(mine)
        ref[ordinal], space[ordinal] = mine, space[parent] if clear else mine
    return out


def test_addresses_against_one_set_of_all_claimed():
    r = random.Random(1)
    for _ in range(300):
        styles = [r.choice(["subsection", "paragraph", "paragraphsub", "notetext", "notepara", "SubsectionHead", None]) for _ in range(r.randrange(1, 60))]
        rows = []
        for i, (kind, _, parent) in enumerate(units.placed(styles, "B"), 1):
            label = None if kind in ("note", "heading") or r.random() < 0.4 else r.choice(["(a)", "(b)", "/t"])
            rows.append((i, parent, label, label is None and r.random() < 0.5))
        assert list(units.addressed(rows, "B")) == plain(rows, "B")


def test_units_are_streamed():
    styles = (x for _ in range(15_000) for x in ("notetext", "paragraph"))
    rows = ((i, parent, "(a)" if kind == "paragraph" else None, False) for i, (kind, _, parent) in enumerate(units.placed(styles, "B"), 1))
    out = units.addressed(rows, "B")
    assert next(out)[0] == "B~1" and next(out)[0] == "B~1(a)" and sum(1 for _ in out) == 29_998


def test_hierarchies_of_any_depth_and_cycles(spark):
    from lexquarry.operators import relations
    from lexquarry.sources.publish import stage

    chain = [(i, i + 1) for i in range(37)] + [(5, 20), (None, 3), (3, None)]
    frame = lambda rows: spark.createDataFrame(rows, "p int, c int")
    got = {(r["ancestor"], r["node"]): r["depth"] for r in relations.descendants(frame(chain), "p", "c", stage).collect()}
    assert len(got) == 37 * 38 // 2 and got[0, 37] == 5 + 1 + 17 and got[6, 37] == 31
    ring = {tuple(r) for r in relations.descendants(frame([(0, 1), (1, 2), (2, 0), (2, 3)]), "p", "c", stage).collect()}
    assert ring == {(a, b, (b - a) % 3 or 3) for a in range(3) for b in range(3)} | {(0, 3, 3), (1, 3, 2), (2, 3, 1)}
    pairs = relations.descendants(frame([(0, 1), (0, 2), (1, 3), (2, 3)]), "p", "c", stage)
    items = spark.createDataFrame([(3, "x"), (1, "x"), (2, "y")], "node int, item string")
    assert {tuple(r) for r in relations.counted_above(pairs, items, "node", "item").collect()} == {(0, 2), (1, 1), (2, 2), (3, 1)}
    assert relations.descendants(frame([]), "p", "c", stage).count() == 0


def test_spans_laid_down(spark):
    from lexquarry.operators import views

    rows = [("a", 0, 4, "x"), ("a", 3, 9, "y"), ("a", 4, 6, "z"), ("a", 4, 5, "w"), ("a", 7, 7, "empty"), ("a", -1, 3, "out"), ("b", 2, 3, None), (None, 0, 1, "n")]
    got = {tuple(r) for r in views.first_wins(spark.createDataFrame(rows, "k string, start int, stop int, kind string"), ["k"], "start", "stop", ["kind"]).collect()}
    assert got == {("a", 0, 4, "x"), ("a", 4, 5, "w"), ("b", 2, 3, None), (None, 0, 1, "n")}
