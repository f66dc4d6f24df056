"""Cells of tables against a grid that is filled slot by slot."""

import random

from lexquarry.operators import views

KIND = "chunk_ref string, blocks array<struct<kind:string,text:string>>, tables array<struct<ordinal:int,header_row:int,cells:array<array<struct<text:string,colspan:int,rowspan:int>>>>>"


def filled(rows):
    taken, out = set(), []
    for r, row in enumerate(rows):
        column = 0
        for seat, (text, across, down) in enumerate(row):
            across, down = max(across or 1, 1), max(down or 1, 1)
            while (r, column) in taken:
                column += 1
            out.append((r, seat, column, across, down, text))
            taken |= {(r + i, column + j) for i in range(down) for j in range(across)}
            column += across
    return out


def test_cells_against_a_grid(spark):
    r = random.Random(3)
    grids = [[[(f"{i}", r.choice([None, 0, 1, 1, 2, 3]), r.choice([None, 1, 1, 2, 4])) for i in range(r.randrange(0, 5))] for _ in range(r.randrange(0, 6))] for _ in range(60)]
    rows = [(str(i), [], [(1, None, g)]) for i, g in enumerate(grids)]
    got = views.table_cells(spark.createDataFrame(rows, KIND)).collect()
    want = [(str(i), 1, None, *c, False) for i, g in enumerate(grids) for c in filled(g)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_tables_are_bound_to_their_blocks(spark):
    one = [[("a", 2, None)], [("b", None, None), ("c", None, None)]]
    rows = [("x", [("paragraph", "p"), ("table", "a b c"), ("table", "d")], [(1, 0, one), (2, None, [[("d", None, None)]]), (3, None, [[("e", None, None)]])]), ("y", None, None), ("z", [("table", "t")], [])]
    got = {(r["table"], r["block"], r["row"], r["column"], r["text"], r["heading"]) for r in views.table_cells(spark.createDataFrame(rows, KIND)).collect()}
    assert got == {(1, 1, 0, 0, "a", True), (1, 1, 1, 0, "b", False), (1, 1, 1, 1, "c", False), (2, 2, 0, 0, "d", False), (3, None, 0, 0, "e", False)}
