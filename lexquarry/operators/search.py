"""Faceted and substring search over passages and provisions: one question, two corpora."""

from __future__ import annotations

from dataclasses import dataclass, fields
from functools import reduce
from operator import and_
from urllib.parse import parse_qs, urlencode

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.snapshot import Corpus


@dataclass(frozen=True)
class Question:
    """Predicates that all must hold; within one, any of its values. The cheap ones are tested first."""

    corpus: tuple[str, ...] = ()
    parts: tuple[str, ...] = ()
    kinds: tuple[str, ...] = ()
    heading_source: tuple[str, ...] = ()
    instruments: tuple[str, ...] = ()
    provision: str = ""
    extraction: tuple[str, ...] = ()
    certainty: tuple[str, ...] = ()
    case: str = ""
    refs: str = ""
    fragment: str = ""
    cited: str = ""
    years: tuple[str, ...] = ()
    text: str = ""

    @property
    def active(self) -> bool:
        return any(getattr(self, f.name) for f in fields(self))

    def to_params(self) -> str:
        return urlencode([(f.name, ",".join(v) if isinstance(v, tuple) else v) for f in fields(self) if (v := getattr(self, f.name))])

    @classmethod
    def from_params(cls, params: str) -> Question:
        given = {k: v[0] for k, v in parse_qs(params.lstrip("#?")).items()}
        return cls(**{f.name: tuple(given[f.name].split(",")) if isinstance(f.default, tuple) else given[f.name] for f in fields(cls) if f.name in given})


#: What only passages have; a question that asks for it leaves provisions out.
PASSAGES_ONLY = ("parts", "heading_source", "case", "refs", "fragment", "years")


def _any(array: str, test: str) -> Column:
    return F.coalesce(F.expr(f"exists({array}, x -> {test})"), F.lit(False))


def _in(values: tuple[str, ...]) -> str:
    return "(" + ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values) + ")"


def _has(expression: str, needle: str) -> str:
    return f"contains(lower({expression}), " + _in((needle.lower(),))[1:-1] + ")"


def _edge_tests(q: Question, own_ref: str | None = None) -> list[Column]:
    """Tests of the citation edges; each asks for some edge of its own."""
    tests = []
    if q.instruments:
        tests.append(_any("provisions", f"substring_index(x.id, '/', 1) in {_in(q.instruments)}"))
    if q.provision:
        found = _any("provisions", _has("x.id", q.provision))
        tests.append(found | F.expr(_has(own_ref, q.provision)) if own_ref else found)
    if q.extraction:
        tests.append(_any("provisions", f"x.extraction in {_in(q.extraction)}"))
    if q.certainty:
        tests.append(_any("provisions", f"coalesce(x.certainty, 'none') in {_in(q.certainty)}"))
    return tests


def passages(q: Question, chunks: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """The chunks that answer a question."""
    if q.corpus and "manual" not in q.corpus:
        return chunks.where(F.lit(False))
    tests = []
    if q.parts:
        tests.append(F.col("part_id").isin(*q.parts))
    if q.kinds:
        tests.append(F.coalesce("kind", F.lit("body")).isin(*q.kinds))
    if q.heading_source:
        tests.append(F.coalesce("heading_source", F.lit("none")).isin(*q.heading_source))
    tests += _edge_tests(q)
    if q.case:
        tests.append(_any("cases", f"{_has('x.id', q.case)} or {_has('x.citation', q.case)}"))
    if q.refs:
        tests.append(_any("internal_refs", _has("x.ref", q.refs)))
    if q.fragment:
        tests.append(F.col("fragment").isNotNull() if q.fragment == "yes" else F.col("fragment").isNull())
    if q.years and pages is not None:
        dated = pages.where(F.substring("last_amended", 1, 4).isin(*q.years)).select("page_ref")
        chunks = chunks.join(dated, "page_ref", "left_semi")
    if q.cited:
        cited = chunks.select(F.explode("internal_refs.ref").alias("_ref")).distinct()
        chunks = chunks.join(cited, F.col("chunk_ref") == F.col("_ref"), "left_semi" if q.cited == "yes" else "left_anti")
    if q.text:
        tests.append(F.expr(_has("concat_ws(' ', chunk_ref, array_join(heading_path, ' '), text)", q.text)))
    return chunks.where(reduce(and_, tests)) if tests else chunks


def provisions(q: Question, found: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """The provisions (with ``provisions``, their edges) that answer the same question."""
    if any(getattr(q, name) for name in PASSAGES_ONLY) or (q.corpus and "legislation" not in q.corpus):
        return found.where(F.lit(False))
    tests = [F.col("kind").isin(*q.kinds)] if q.kinds else []
    tests += _edge_tests(q, "ref")
    if q.cited and edges is not None:
        found = found.join(edges.select(F.col("id").alias("_ref")).distinct(), F.col("ref") == F.col("_ref"), "left_semi" if q.cited == "yes" else "left_anti")
    if q.text:
        tests.append(F.expr(_has("concat_ws(' ', ref, title, text)", q.text)))
    return found.where(reduce(and_, tests)) if tests else found


def with_edges(corpus: Corpus) -> DataFrame:
    """Provisions with the distinct edges of their units, of those equal in id, extraction and certainty the first unit's."""
    flat = F.flatten(F.transform("units", lambda u: F.coalesce(u["provisions"], F.array().cast(corpus.units.schema["provisions"].dataType))))
    seen = lambda e: F.struct(e["id"], e["extraction"], F.coalesce(e["certainty"], F.lit("")))
    rows = corpus.provisions.withColumn("_flat", flat).withColumn("_keys", F.transform("_flat", seen))
    return rows.withColumn("provisions", F.filter("_flat", lambda e, i: F.array_position("_keys", seen(e)) == i + 1)).drop("_flat", "_keys")


def search(corpus: Corpus, q: Question) -> dict[str, DataFrame]:
    return {"manual": passages(q, corpus.chunks, corpus.pages), "legislation": provisions(q, with_edges(corpus), corpus.edges)}


def grouped(found: DataFrame, group: str, ref: str, cap: int = 200) -> DataFrame:
    """Results by group: how many, and the first ``cap`` addresses."""
    sizes = found.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    first = found.select(group, ref).withColumn("_at", F.row_number().over(Window.partitionBy(group).orderBy(ref))).where(F.col("_at") <= cap)
    listed = first.groupBy(F.col(group).alias("_group")).agg(F.array_sort(F.collect_list(ref)).alias("refs"))
    return sizes.join(listed, F.col(group).eqNullSafe(F.col("_group")), "left").select(group, "n", "refs")
