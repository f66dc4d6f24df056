"""What a passage cites: provisions by hyperlink and in prose, decisions, and pages by their printed number.

A hyperlink is the author's statement (``href``); a match in prose is an inference (``regex``) with a certainty:
explicit where an instrument of the right kind is named just after, ambiguous where the passage names several of
that kind, else default. All of it is SQL functions: texts are cut into stretches once, so that the words after a
match cost the same anywhere in a long text, and only matches are shuffled, never texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.spans import BLOCK, match_spans
from ..functions.text import SPACES
from ..sources.publish import stage
from .inventory import link_candidates
from .relations import strongest

# Names of instruments, address vocabularies and patterns of the corpus. A look at the first letter comes before the slow tests: those for a word's edge and, beyond ``(?iU)``, for any case.
TITLES = {
    "acts interpretation act 1901": "AIA1901",
    "trade mark regulations 1995": "TMR1995",
    "trade marks act 1905": "TMA1905",
    "trade marks act 1955": "TMA1955",
    "trade marks act 1995": "TMA1995",
    "trade marks regulations 1995": "TMR1995",
}
ACTS_BY_YEAR = {"1905": "TMA1905", "1955": "TMA1955", "1995": "TMA1995"}
DEFAULTS = {"s": "TMA1995", "r": "TMR1995"}
DOTTED = {"TMA1995": False, "TMR1995": True}  # whether the instrument's numbers have dots; others aren't known
DATABASES = {"aia1901230": "AIA1901", "tma1995121": "TMA1995", "tmr1995230": "TMR1995", "tmr1995264": "TMR1995"}
QUERY_DATABASES = {"tmact": "TMA1995", "tmreg": "TMR1995"}
PREFIXES = {"r": "", "s": "", "sch": "sch"}
DATABASE = r"^([a-z]{2,8})((?:1[6-9]|20)[0-9]{2})[0-9]*$"
PATH_LINK = r"(?i)/legis/cth/consol_(act|reg)/([a-z0-9]+)/([a-z]+)([0-9][0-9a-z.]*)\.html"
QUERY_LINK = r"(?i)timebase\.com\.au/IPAust/index\.cfm\?id=([a-z]+):((?:sch)?[0-9][0-9a-z.]*)"
ADDRESS = r"[0-9]{1,4}[A-Z]?(?:\.[0-9]+[A-Z]?)*(?:\([0-9a-zA-Z]{1,3}\))*"
WORD = r"(?:subsections?|subparagraphs?|subregulations?|sections?|paragraphs?|regulations?|regs?\.?|ss?\.?)"
REFERENCE = rf"(?=[SsRrPp\x{{17f}}])(?iU)\b{WORD}\s*{ADDRESS}(?:\s*(?:,|;|and|or|to|&)\s*{ADDRESS})*"
IN_WORDS = r"(?U)(?=[0-9])\b[0-9]{1,4}[A-Za-z]?(?:\.[0-9]+[A-Za-z]?)*(?:\([0-9a-zA-Z]{1,3}\))+"
INSTRUMENT = r"(?U)(?=[A-Z])\b[A-Z][A-Za-z()’'\-]*(?:\s+[A-Za-z()’'\-]+){0,7}\s+(?:Act|Regulations?)\s+[0-9]{4}\b"
SHORT_ACT = r"(?U)(?=t)\bthe\s+([0-9]{4})\s+Act\b"
NEUTRAL = r"(?U)\[((?:18|19|20)[0-9]{2})\]\s+([A-Z]{2,10})\s+([0-9]{1,4})\b"
REPORTED = r"(?U)\(((?:18|19|20)[0-9]{2})\)\s+([0-9]{1,3})\s+([A-Z]{2,10})\s+([0-9]{1,4})\b"
PAGE_NUMBER = r"(?=[Pp])(?iU)\bparts?\s+([0-9]{1,3}[A-Z]?)((?:\.[0-9]+)+)"
OF_THIS = r"(?=[OoIiAa\x{130}\x{131}])(?iU)\b(?:of|in|at)\s+th(?:is|e\s+(?:present|current))\s+(?:\w+\s+){0,2}(?:chapter|part|section)\b"
AHEAD, AHEAD_OF_PAGE = 60, 48

STRETCH = 4096


def _looked_up(values: dict, key: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), key)


def kind_of(instrument: Column) -> Column:
    """'r' for regulations, 's' for acts: known codes first, then the end of a title."""
    known = {c: "r" if "regulation" in t else "s" for t, c in TITLES.items()}
    return F.coalesce(_looked_up(known, instrument), F.when(instrument.rlike(r"\bregulations?\s+[0-9]{4}$"), "r").otherwise("s"))


def canonical(address: Column) -> Column:
    """Upper case up to the first parenthesis."""
    number = F.substring_index(address, "(", 1)
    return F.concat(F.upper(number), F.substring(address, F.length(number) + F.lit(1), F.length(address)))


def held(instrument: Column, symbol: Column, address: Column) -> Column:
    """Whether the instrument can hold the address: kinds agree, and so do dots where its numbering is known."""
    kinds = F.when(instrument.isin(sorted({*TITLES.values(), *ACTS_BY_YEAR.values()})), kind_of(instrument) == symbol).otherwise(True)
    dots = _looked_up(DOTTED, instrument)
    # One condition, not two: a part without the address would be worked out again below, before addresses are listed.
    return F.when(dots.isNull() | (F.contains(F.substring_index(address, "(", 1), F.lit(".")) == dots), kinds).otherwise(False)


def linked(links: DataFrame, key: str, strict: bool = True) -> DataFrame:
    """(key, id, extraction, certainty, mention, seq) of links (key, href, words, seq) to provisions.

    The link names the provision, its words may name parts of it. A link whose instrument or kind of page can't be
    read raises; with ``strict`` off it is left out, and ``unreadable`` lists it.
    """
    rows = _read_links(links)
    if strict:
        rows = rows.withColumn("_code", F.when(F.col("_problem").isNotNull(), F.raise_error(F.concat(F.col("_problem"), F.lit(" in "), "href")).cast("string")).otherwise(F.col("_code")))
    else:
        rows = rows.where("_problem is null")
    number = canonical(F.col("_node"))
    parts = F.filter(F.transform(F.regexp_extract_all("words", F.lit(IN_WORDS), F.lit(0)), canonical), lambda a: F.substring_index(a, "(", 1) == number)
    schedule = F.col("_node").rlike("^sch[0-9]")
    tails = F.when(schedule, F.array("_node")).otherwise(F.transform(F.when(F.size(parts) > 0, parts).otherwise(F.array(number)), lambda a: F.concat("_symbol", a)))
    return rows.select(
        key, F.posexplode(tails).alias("_n", "_tail"), "_code", F.lit("href").alias("extraction"), F.lit(None).cast("string").alias("certainty"), F.col("words").alias("mention"), F.col("seq").cast("long").alias("_seq")
    ).select(key, F.concat_ws("/", "_code", "_tail").alias("id"), "extraction", "certainty", "mention", F.struct(F.col("_seq").alias("at"), F.col("_n").alias("nth")).alias("seq"))


def unreadable(links: DataFrame, key: str) -> DataFrame:
    """(key, href, problem) of links to provisions of an unknown instrument or kind of page."""
    return _read_links(links).where("_problem is not null").select(key, "href", F.col("_problem").alias("problem"))


def _read_links(links: DataFrame) -> DataFrame:
    part = lambda pattern, n: F.regexp_extract("href", pattern, n)
    by_path, by_query = F.col("href").rlike(PATH_LINK), F.col("href").rlike(QUERY_LINK)
    database = F.lower(part(PATH_LINK, 2))
    derived = F.when(database.rlike(DATABASE), F.concat(F.upper(F.regexp_extract(database, DATABASE, 1)), F.regexp_extract(database, DATABASE, 2)))
    segment = _looked_up(PREFIXES, F.lower(part(PATH_LINK, 3)))
    code = F.when(by_path, F.coalesce(_looked_up(DATABASES, database), derived)).otherwise(_looked_up(QUERY_DATABASES, F.lower(part(QUERY_LINK, 1))))
    node = F.when(by_path, F.concat(segment, F.lower(part(PATH_LINK, 4)))).otherwise(F.lower(part(QUERY_LINK, 2)))
    symbol = F.when(by_path, F.when(F.lower(part(PATH_LINK, 1)) == "act", "s").otherwise("r")).otherwise(kind_of(code))
    problem = F.when(code.isNull(), "unknown instrument").when(node.isNull(), "unknown kind of page")
    return links.where(by_path | by_query).withColumns({"_code": code, "_node": node, "_symbol": symbol, "_problem": problem})


def _cut(text: str) -> Column:
    """A text in stretches, for ``_ahead``."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{STRETCH}}}"), F.lit(0))


def _ahead(size: int | str) -> str:
    """SQL for the ``size`` characters after the match ``m`` of a text in stretches ``_cut``."""
    at = f"int(m.stop div {STRETCH})"
    return f"substring(concat(coalesce(get(_cut, {at}), ''), coalesce(get(_cut, {at} + 1), '')), m.stop % {STRETCH} + 1, {size})"


def _with_ahead(docs: DataFrame, key: str, text: str, pattern: str, size: int, kept: list[str] = []) -> DataFrame:  # noqa: B006
    """(key, kept, start, stop, words, ahead) of every match, ``ahead`` being the ``size`` characters after it."""
    cut = docs.select(key, *kept, F.expr(match_spans(f"`{text}`", pattern)).alias("_m"), _cut(text).alias("_cut"))
    return cut.select(key, *kept, F.inline(F.expr(f"transform(_m, m -> named_struct('start', m.start, 'stop', m.stop, 'words', m.words, 'ahead', {_ahead(size)}))")))


def _named_ahead(window: Column, low: Column, symbol: Column) -> Column:
    """The first instrument that a window (as it is, and in lower case) names and that can hold the symbol: struct of its place, end and code, or null."""
    place = lambda at, size, code: F.struct(at.alias("at"), (at + size - F.lit(1)).alias("end"), code.alias("code"))
    titles = {kind: F.least(*[F.when(F.contains(low, F.lit(t)), place(F.instr(low, t), F.lit(len(t)), F.lit(c))) for t, c in TITLES.items() if ("regulation" in t) == (kind == "r")]) for kind in "sr"}
    code = _looked_up(ACTS_BY_YEAR, F.regexp_extract(window, SHORT_ACT, 1))
    short = F.when(code.isNotNull(), place(F.regexp_instr(window, F.lit(SHORT_ACT)), F.length(F.regexp_extract(window, SHORT_ACT, 0)), code))
    acts = F.when(F.contains(low, F.lit("act")) & (symbol.isNull() | (symbol == "s")), F.least(titles["s"], short))
    return F.least(acts, F.when(F.contains(low, F.lit("regulations")) & (symbol.isNull() | (symbol == "r")), titles["r"]))


def in_prose(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, id, extraction, certainty, mention, seq) of every provision named in prose, each address of a list by itself.

    Texts without a key count, null texts don't; repeated rows count once, and different texts of one key are read apart.
    """
    return _in_prose(docs, key, text).dropDuplicates([key, "_t", "id", "seq"]).drop("_t")


def _in_prose(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``in_prose`` with a digest ``_t`` of the text, repeated rows each for itself: worked out within the passage's row, nothing is shuffled."""
    named = F.contains(text, F.lit("Act")) | F.contains(text, F.lit("Regulation"))  # else there is no title
    titles = F.when(named, F.expr(match_spans(f"`{text}`", INSTRUMENT))).otherwise(F.expr("cast(array() as array<struct<start: int, stop: int, words: string>>)"))
    years = F.when(named, F.regexp_extract_all(text, F.lit(SHORT_ACT), F.lit(1))).otherwise(F.expr("cast(array() as array<string>)"))
    found = docs.where(F.col(text).isNotNull()).select(key, F.xxhash64(text).alias("_t"), F.expr(match_spans(f"`{text}`", REFERENCE)).alias("_m"), titles.alias("_titles"), years.alias("_years"), _cut(text).alias("_cut"))

    def code_of(title: Column) -> Column:
        own = F.lower(F.trim(F.regexp_replace(title["words"], SPACES, " ")))
        return F.coalesce(_looked_up(TITLES, own), own)

    codes = F.concat(F.transform("_titles", code_of), F.transform("_years", lambda y: F.coalesce(_looked_up(ACTS_BY_YEAR, y), F.concat(F.lit("the "), y, F.lit(" act")))))
    kinds = F.transform(F.array_distinct(codes), kind_of)
    # A match within a title ("... Regulations 1995") is part of the title; a block of matches meets only the titles that reach into it.
    blocks = f"transform(sequence(0, (size(_m) - 1) div {BLOCK}), k -> slice(_m, k * {BLOCK} + 1, {BLOCK}))"
    beside = f"transform({blocks}, b -> named_struct('b', b, 't', filter(_titles, t -> t.stop >= b[0].stop and t.start <= element_at(b, -1).start)))"
    real = f"if(size(_titles) = 0, _m, flatten(transform({beside}, x -> filter(x.b, m -> not exists(x.t, t -> t.start <= m.start and t.stop >= m.stop)))))"
    found = found.select(key, "_t", "_cut", F.expr(real).alias("_m"), kinds.alias("_kinds"))
    found = found.select(key, "_t", "_cut", "_m", *[F.expr(f"size(filter(_kinds, x -> x = '{kind}'))").alias(f"_{kind}") for kind in "sr"])

    # The words after a match end where the next match begins.
    ahead = _ahead(f"least({AHEAD}, coalesce(get(_m, i + 1).start - m.stop, {AHEAD}))")
    real = found.select(key, "_t", "_s", "_r", F.inline(F.expr(f"transform(_m, (m, i) -> named_struct('start', m.start, 'words', m.words, '_window', substring_index({ahead}, '.', 1)))")))
    size = F.length(F.regexp_extract("words", rf"(?i)^{WORD}", 0))
    symbol = F.when(F.col("words").rlike("(?i)^(?:sub)?reg"), "r").otherwise("s")
    low = F.when(F.contains("_window", F.lit("19")), F.lower("_window"))  # all titles and years have it, and lower case is dear
    rows = real.withColumns({"_symbol": symbol, "_neutral": F.col("words").rlike("(?i)^(?:sub)?paragraph"), "_list": F.substring(F.col("words"), size + F.lit(1), F.length("words")), "_low": low})
    rows = rows.withColumn("_named", _named_ahead(F.col("_window"), F.col("_low"), F.when(~F.col("_neutral"), F.col("_symbol"))))
    explicit = F.col("_named").isNotNull()
    rows = rows.select(
        key, "_t", "start", F.coalesce("_named.code", _looked_up(DEFAULTS, F.col("_symbol"))).alias("_code"),
        F.when(explicit & F.col("_neutral"), kind_of(F.col("_named.code"))).otherwise(F.col("_symbol")).alias("_symbol"),
        F.when(explicit, "explicit").when(F.when(F.col("_symbol") == "s", F.col("_s")).otherwise(F.col("_r")) > 1, "ambiguous").otherwise("default").alias("certainty"),
        F.trim(F.regexp_replace(F.concat("words", F.coalesce(F.substring(F.col("_window"), F.lit(1), F.col("_named.end")), F.lit(""))), SPACES, " ")).alias("mention"),
        F.posexplode(F.regexp_extract_all("_list", F.lit(f"(?i){ADDRESS}"), F.lit(0))).alias("_n", "_address"),
    )
    rows = rows.withColumn("_address", canonical(F.col("_address"))).where(held(F.col("_code"), F.col("_symbol"), F.col("_address")))
    ident = F.concat("_code", F.lit("/"), "_symbol", "_address")
    return rows.select(key, "_t", ident.alias("id"), F.lit("regex").alias("extraction"), "certainty", "mention", F.struct(F.col("start").cast("long").alias("at"), F.col("_n").alias("nth")).alias("seq"))


def _rank() -> Column:
    """Hyperlink, explicit, default, ambiguous."""
    return F.when(F.col("extraction") == "href", 0).when(F.col("certainty") == "explicit", 1).when(F.col("certainty") == "default", 2).otherwise(3)


def cited_provisions(docs: DataFrame, links: DataFrame, key: str, text: str, strict: bool = True) -> DataFrame:
    """(key, id, extraction, certainty, mention): one edge for each provision of a passage, by the strongest evidence, the first on ties."""
    both = linked(links, key, strict).unionByName(_in_prose(docs, key, text).drop("_t"))
    return strongest(both, [key, "id"], _rank(), ["seq"]).select(key, "id", "extraction", "certainty", "mention")


def edge_order() -> list[Column]:
    """The one order in which a passage's edges are written."""
    return [F.col("id"), F.col("extraction"), F.coalesce("certainty", F.lit("")), F.coalesce("mention", F.lit(""))]


def decisions(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, id, citation) of each decision that a passage cites, neutral or reported, spaced in one way."""
    listed = lambda pattern: F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = lambda pattern, n: F.regexp_extract("_words", pattern, n)
    words = docs.select(key, F.explode(F.array_distinct(F.concat(listed(NEUTRAL), listed(REPORTED)))).alias("_words"))
    neutral = F.startswith("_words", F.lit("["))
    ident = F.when(neutral, F.concat_ws("/", F.lit("CASE"), part(NEUTRAL, 1), part(NEUTRAL, 2), part(NEUTRAL, 3)))
    ident = ident.otherwise(F.concat_ws("/", F.lit("CASE"), part(REPORTED, 1), part(REPORTED, 3), part(REPORTED, 2), part(REPORTED, 4)))
    return words.select(key, ident.alias("id"), F.regexp_replace("_words", SPACES, " ").alias("citation")).distinct()


def numbered_pages(docs: DataFrame, pages: DataFrame, key: str, text: str, page_ref: str, prefix: str) -> DataFrame:
    """(key, ref, extraction, certainty, mention, seq) of pages named by number ("part 22.15.7") in passages (key, page_ref, text).

    A number is read as an address of the whole (part 22, then 15, 7) and, if the passage's own part is another one,
    as an address within it. Each reading gives the deepest page above it, never a part. "of this chapter" just
    after chooses the second (explicit); else the first stays, ambiguous if both lead to a page, default if one does.
    """
    found = _with_ahead(docs.where(F.col(text).isNotNull()), key, text, PAGE_NUMBER, AHEAD_OF_PAGE, [page_ref])
    found = found.withColumns({"_part": F.regexp_extract("words", PAGE_NUMBER, 1), "_rest": F.replace(F.regexp_extract("words", PAGE_NUMBER, 2), F.lit("."), F.lit("/"))})
    part, rest = F.col("_part"), F.col("_rest")
    home = F.get(F.split(page_ref, "/"), F.lit(1))
    own = F.when(F.startswith(home, F.lit("Part")), F.substring(home, F.lit(5), F.length(home)))
    whole = F.concat(F.lit(f"{prefix}/Part"), F.upper(part), rest)
    within = F.when(F.upper(own) != F.upper(part), F.concat(F.lit(f"{prefix}/Part"), F.upper(own), F.lit("/"), part, rest))
    local = F.regexp_extract("ahead", r"^(?s:(.*?))(?:\.(?:\s|$)|\z)", 1).rlike(OF_THIS)
    # Written once: what is read from the texts is used for the paths and for the rows.
    rows = stage(found.select(key, "start", "words", whole.alias("_whole"), within.alias("_within"), local.alias("_local")))
    wanted = rows.select(F.explode(F.array("_whole", "_within")).alias("_path")).where("_path is not null").distinct()
    depth = F.size(F.split("_path", "/"))
    up = wanted.select("_path", F.posexplode(F.transform(F.sequence(F.lit(0), depth - 3), lambda n: F.array_join(F.slice(F.split("_path", "/"), 1, depth - n), "/"))).alias("_far", "page"))
    known = pages.select(F.col("page_ref").alias("page")).distinct()
    deepest = up.join(known, "page").groupBy("_path").agg(F.min_by("page", "_far").alias("page"))
    a, b = deepest.select(F.col("_path").alias("_whole"), F.col("page").alias("_a")), deepest.select(F.col("_path").alias("_within"), F.col("page").alias("_b"))
    rows = rows.join(a, "_whole", "left").join(b, "_within", "left").where("_a is not null or _b is not null")
    chosen = F.when(F.col("_b").isNotNull() & F.col("_local"), F.struct(F.col("_b").alias("ref"), F.lit("explicit").alias("certainty")))
    chosen = chosen.when(F.col("_a").isNotNull() & F.col("_b").isNotNull(), F.struct(F.col("_a").alias("ref"), F.lit("ambiguous").alias("certainty")))
    chosen = chosen.otherwise(F.struct(F.coalesce("_a", "_b").alias("ref"), F.lit("default").alias("certainty")))
    rows = rows.withColumn("_chosen", chosen)
    return rows.select(key, F.col("_chosen.ref").alias("ref"), F.lit("regex").alias("extraction"), F.col("_chosen.certainty").alias("certainty"), F.trim(F.regexp_replace("words", SPACES, " ")).alias("mention"), F.col("start").cast("long").alias("seq"))


def internal_references(docs: DataFrame, links: DataFrame, pages: DataFrame, key: str, text: str, page_ref: str, prefix: str, base: str = "") -> DataFrame:
    """(key, ref, extraction, certainty, mention, seq): links to pages and pages named by number, one for each target, by the strongest evidence."""
    by_link = link_candidates(links, pages, key, base).withColumn("certainty", F.lit(None).cast("string")).withColumn("seq", F.col("seq").cast("long"))
    both = by_link.unionByName(numbered_pages(docs, pages, key, text, page_ref, prefix))
    return strongest(both, [key, "ref"], _rank(), [F.coalesce("certainty", F.lit("")), F.coalesce("mention", F.lit("")), "seq"])
