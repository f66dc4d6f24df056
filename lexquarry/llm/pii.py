"""Personal data: overlapping candidate spans, boosted trees, calibrated thresholds; all in SQL functions.

Base spans (e-mail, IP, card, phone) follow fixed patterns and always stay. High-recall generators
propose further spans, which may overlap each other and the base ones: spelled-out addresses,
phone numbers without a plus, cards with other separators, account and identity numbers. Boosted
trees score each candidate by its format and its context; a kind's threshold is calibrated on
labelled candidates that the trees haven't seen, so that none of the negatives passes; of
candidates that overlap, the best stays, and none that touches a base span.

The trees are fitted once a session on ``TRAIN_ROWS`` labelled candidates, made by rule and so the
same for every corpus, then compiled to SQL. All work is row by row: no shuffle, no Python on
executors, and a hot source or repeated rows change nothing.

Edge cases: a null text counts as empty and has no spans; very long texts are scanned whole, with
patterns that never step back over what they took; repeated rows give repeated results; extra
columns stay untouched; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .native import features_sql, forest_sql, literal, matches
from .shared import unused

TRAIN_ROWS = 3000
TREES, DEPTH = 10, 3
KINDS = ("email", "ip", "card", "phone", "id")

#: The base patterns, with possessive repeats and starts only where a run starts.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IP_PARTS = r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2}|(?<=0))\.){3}0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2}|(?<=0))$"
DIGITS = "regexp_replace({}, '[^0-9]', '')"
BASE = {
    "email": (EMAIL, "true"),
    "ip": (IP, f"c.t rlike {literal(IP_PARTS)}"),
    "card": (CARD, f"length({DIGITS.format('c.t')}) between 13 and 19 and luhn_check({DIGITS.format('c.t')})"),
    "phone": (PHONE, f"length({DIGITS.format('c.t')}) between 9 and 15"),
}
#: What a text must have for a pattern to match at all; texts without aren't scanned for it.
NEEDS = {EMAIL: "contains({}, '@')", PHONE: "contains({}, '+')"}
DIGIT = "{} rlike '[0-9]'"
#: Further candidates: kind and pattern. All are bounded in length.
GENERATORS = (
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\s{0,2}[\[({]\s?(?:at|AT|@)\s?[\])}]\s{0,2}[A-Za-z0-9-]{1,63}+(?:\s{0,2}[\[({]\s?(?:dot|DOT|\.)\s?[\])}]\s{0,2}[A-Za-z0-9-]{1,63}+|\.[A-Za-z0-9-]{1,63}+){1,4}"),
    ("phone", r"(?<![0-9A-Za-z.+-])(?:00[1-9][0-9]?[\x20.-]?)?(?:\([0-9]{2,4}\)\x20?|[0-9]{2,4}[\x20.-])[0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9A-Za-z-])"),
    ("card", r"(?<![0-9A-Za-z.])[0-9]{4}([._/]|\x20-\x20|\x20\x20)[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}(?![0-9A-Za-z])"),
    ("id", r"(?<![0-9A-Za-z-])(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?)(?![0-9A-Za-z-])"),
)
#: Features of a candidate: kind number {k}, text {t}, text before {b} and after {a}.
FEATURES = [
    "{k}",
    "length({t})",
    "length(regexp_replace({t}, '[^0-9]', ''))",
    "length(regexp_replace({t}, '[^A-Za-z]', ''))",
    "size(array_distinct(regexp_extract_all({t}, '[0-9]', 0)))",
    "size(array_distinct(regexp_extract_all({t}, '[^0-9A-Za-z]', 0)))",
    "int(length(regexp_replace({t}, '[^0-9]', '')) > 0 and luhn_check(regexp_replace({t}, '[^0-9]', '')))",
    r"int(lower({b}) rlike '(?:phone|tel|call|mobile|cell|fax|dial|whatsapp|sms)[a-z]*[\\s:.=#-]*(?:me |us |at |is |on |no )*[\\s:.=#-]*$')",
    r"int(lower({b}) rlike '(?:mail|contact|write|reach|reply|send)[a-z-]*[\\s:.=#-]*(?:me |us |at |to |is )*[\\s:.=#-]*$')",
    r"int(lower({b}) rlike '(?:card|visa|mastercard|amex|credit|debit|payment|pan)[a-z]*[\\s:.=#-]*(?:no |number |is )*[\\s:.=#-]*$')",
    r"int(lower({b}) rlike '(?:ssn|social security|iban|account|acct|passport|tax id|identity)[a-z]*[\\s:.=#-]*(?:no |number |is )*[\\s:.=#-]*$')",
    r"int({b} rlike '[0-9A-Za-z_/=-]$')",
    r"int({a} rlike '^[0-9A-Za-z_/=]')",
    r"int(lower({b}) rlike '\\b(?:isbn|version|section|order|invoice|part|page|serial|item|ref|sku|date|clause|act)[a-z]*[\\s:.=#-]*(?:no |number )?[\\s:.=#-]*$')",
    r"int({t} rlike '(?i)(?:com|org|net|edu|gov|io|de|fr|es|uk|au)$')",
    r"int({t} rlike '^[(]|^00|^[0-9]{{3}}[. -][0-9]{{3}}[. -][0-9]{{4}}$')",
]

_fitted: dict[str, tuple[str, dict[int, float]]] = {}


def labelled(spark: SparkSession, rows: int = TRAIN_ROWS) -> DataFrame:
    """Labelled candidates made by rule: (k, t, b, a, label, held)."""
    digit = lambda i, n: f"lpad(cast(conv(substr(h, {i}, 8), 16, 10) % {10**n} as string), {n}, '0')"
    word = "element_at(array('the','of','and','then','la','de','with','und','pour','report'), 1 + id % 10)"
    good = {
        0: f"concat('user', {digit(1, 2)}, ' [at] mail', {digit(9, 1)}, ' [dot] ', element_at(array('com','org','net','de'), 1 + id % 4))",
        3: f"if(id div 2 % 2 = 0, concat('(', {digit(1, 3)}, ') ', {digit(9, 3)}, '-', {digit(17, 4)}), concat({digit(1, 3)}, '-', {digit(9, 3)}, '-', {digit(17, 4)}))",
        2: f"concat('4', {digit(1, 3)}, '.', {digit(9, 4)}, '.', {digit(17, 4)}, '.', {digit(25, 4)})",
        4: f"if(id div 2 % 2 = 0, concat({digit(1, 3)}, '-', {digit(9, 2)}, '-', {digit(17, 4)}), concat('DE', {digit(1, 2)}, {digit(9, 4)}, {digit(17, 4)}, {digit(25, 4)}, {digit(33, 4)}, '00'))",
    }
    hint = {0: "array('mail: ', 'contact ', 'write to ')", 3: "array('phone: ', 'call me at ', 'tel. ')", 2: "array('card no ', 'visa: ', 'payment card ')", 4: "array('ssn: ', 'iban ', 'account number ')"}
    bad_hint = "array('isbn ', 'order ', 'serial no ', 'section ', 'version ', 'ref: ')"
    case = lambda x: "case k " + " ".join(f"when {k} then {v}" for k, v in x.items()) + " end"
    base = spark.sql(f"select cast(id as int) id, sha2(concat('pii', id), 256) h, cast(element_at(array(0, 2, 3, 4), cast(1 + id div 7 % 4 as int)) as int) k, cast(id % 2 as int) label from range(0, {rows}, 1, 4)")
    return base.selectExpr(
        "k", "label", "id div 28 % 3 = 0 held",
        f"case when label = 1 then {case(good)} when id % 6 = 2 then {case(good)} when k = 0 then 'x [at] y [dot] zz' else concat(substr(translate(h, 'abcdef', '123456'), 1, 3), '.', substr(translate(h, 'abcdef', '123456'), 4, 3), '.', substr(translate(h, 'abcdef', '123456'), 7, 4)) end t",
        f"concat({word}, ' ', if(label = 1, element_at({case(hint)}, cast(1 + id div 2 % 3 as int)), if(id div 2 % 3 = 0, concat({word}, ' '), element_at({bad_hint}, cast(1 + id div 2 % 6 as int))))) b",
        f"concat(' ', {word}) a",
    )


def fitted(spark: SparkSession) -> tuple[str, dict[int, float]]:
    """(SQL of the score of a features array named f, least score of each kind number)."""
    key = spark.sparkContext.applicationId
    if key not in _fitted:
        from pyspark.ml.classification import GBTClassifier
        from pyspark.ml.functions import array_to_vector

        rows = labelled(spark).withColumn("f", F.expr(features_sql(FEATURES, k="k", t="t", b="b", a="a")))
        train = rows.where("not held").select(array_to_vector("f").alias("features"), F.col("label").cast("double").alias("label"))
        train = train.repartition(2).cache()
        model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=1).fit(train)
        train.unpersist()
        score = forest_sql(model, "{f}")
        held = rows.where("held").withColumn("score", F.expr(score.replace("{f}", "f")))
        least = held.groupBy("k").agg(F.max(F.when(F.col("label") == 0, F.col("score"))).alias("top"), F.min(F.when(F.col("label") == 1, F.col("score"))).alias("low")).collect()
        # Above every unseen negative; half way to the lowest positive where there is room.
        limits = {r["k"]: max(0.0, r["top"] + max(1e-6, (r["low"] - r["top"]) / 2)) for r in least if r["top"] is not None and r["low"] is not None}
        _fitted.clear()
        _fitted[key] = score, limits
    return _fitted[key]


def base_spans(text: str) -> str:
    """SQL for the base spans as array<struct<k, s, e>>, by kind and start."""
    kinds = []
    for k, (pattern, keep) in enumerate(BASE.values()):
        kinds.append(f"transform(filter({matches(text, pattern, NEEDS.get(pattern, DIGIT).format(text))}, c -> {keep}), c -> named_struct('k', {k}, 's', c.s, 'e', c.e))")
    return f"concat({', '.join(kinds)})"


def added_spans(text: str, base: str, score: str, limits: dict[int, float]) -> str:
    """SQL for further spans: scored candidates over their kind's threshold that touch no base span, best first."""
    found = []
    for kind, pattern in GENERATORS:
        k = KINDS.index(kind)
        needs = f"{text} rlike '[\\\\[({{]'" if kind == "email" else DIGIT.format(text)
        made = f"transform({matches(text, pattern, needs)}, c -> named_struct('k', {k}, 's', c.s, 'e', c.e, 'f', {features_sql(FEATURES, k=str(k), t='c.t', b='c.b', a='c.a')}))"
        scored = f"transform({made}, c -> named_struct('v', {score.replace('{f}', 'c.f')}, 'k', c.k, 's', c.s, 'e', c.e))"
        found.append(f"filter({scored}, c -> c.v > {limits.get(k, 1e9)}D and not exists({base}, o -> o.s < c.e and c.s < o.e))")
    ranked = f"array_sort(concat({', '.join(found)}), (p, q) -> case when p.v > q.v then -1 when p.v < q.v then 1 when p.s < q.s then -1 when p.s > q.s then 1 else p.k - q.k end)"
    empty = "cast(array() as array<struct<k: int, s: bigint, e: bigint>>)"
    return f"aggregate({ranked}, {empty}, (kept, c) -> if(exists(kept, o -> o.s < c.e and c.s < o.e), kept, concat(kept, array(named_struct('k', c.k, 's', c.s, 'e', c.e)))))"


def with_spans(docs: DataFrame, base: str, spans: str, text: str = "text") -> DataFrame:
    """``docs`` with columns of the base spans and of all spans, by kind and start."""
    score, limits = fitted(docs.sparkSession)
    whole = f"coalesce(cast(`{text}` as string), '')"
    out = docs.withColumn(base, F.expr(base_spans(whole)))
    return out.withColumn(spans, F.expr(f"array_sort(concat(`{base}`, {added_spans(whole, f'`{base}`', score, limits)}))"))


def joined(spans: str) -> Column:
    names = ", ".join(literal(k) for k in KINDS)
    return F.expr(f"array_join(transform(`{spans}`, c -> concat(array({names})[c.k], ':', c.s, ':', c.e)), ',')")


def redacted(text: str, spans: str) -> Column:
    """The text with each span, or run of overlapping ones, as its kind in brackets."""
    names = ", ".join(literal(k.upper()) for k in KINDS)
    ordered = f"array_sort(`{spans}`, (p, q) -> case when p.s <> q.s then int(sign(p.s - q.s)) when p.e <> q.e then int(sign(q.e - p.e)) else p.k - q.k end)"
    step = (
        f"(acc, c) -> if(c.s < acc.at, named_struct('at', greatest(acc.at, c.e), 'out', acc.out), named_struct('at', c.e, 'out', "
        f"concat(acc.out, array(substring(`{text}`, cast(acc.at + 1 as int), cast(c.s - acc.at as int)), concat('[', array({names})[c.k], ']')))))"
    )
    done = f"aggregate({ordered}, named_struct('at', 0L, 'out', cast(array() as array<string>)), {step}, acc -> concat(acc.out, array(substring(`{text}`, cast(acc.at + 1 as int)))))"
    return F.expr(f"if(size(`{spans}`) = 0, `{text}`, array_join({done}, ''))")


def redact(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns kept, personal data in ``text`` replaced by its kind."""
    names, base, spans = docs.columns, unused(docs, "pii_base"), unused(docs, "pii_spans")
    marked = with_spans(docs, base, spans)
    return marked.withColumn("text", redacted("text", spans)).select(*[F.col(f"`{x}`") for x in names])


def op10_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    marked = with_spans(docs, "base", "found")
    counts = [F.expr(f"cast(size(filter(base, c -> c.k = {i})) as bigint)").alias(f"n_{k}") for i, k in enumerate(BASE)]
    return marked.select("doc_id", *counts, F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"), joined("found").alias("spans"))


QUERIES = {"op10_pii_spans": op10_pii_spans}
