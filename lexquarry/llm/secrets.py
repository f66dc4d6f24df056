"""Secret scan: candidates by pattern, a random forest removes false positives; all in SQL functions.

Candidates are values assigned to a telling name and runs of token characters with a digit. The
forest reads their length, character classes and transitions, dictionary coverage, the path (the
document's source) and the neighbouring words. It is fitted once a session on ``TRAIN_ROWS``
labelled findings, made by rule or given, and compiled to SQL; a candidate is a finding when at
least half of the trees say so.

All work is row by row: no shuffle, no Python on executors; hot sources and repeated rows change
nothing. Edge cases: a null text counts as empty, a null path too; very long texts are scanned
whole with patterns that never step back over a run; repeated rows give repeated results; columns
of other names stay untouched; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .native import features_sql, forest_sql, literal, matches

TRAIN_ROWS = 4000
TREES, DEPTH, SHARE = 16, 6, 0.5
NAMES = "password|passwd|pwd|secret|token|api[_-]?key|apikey|access[_-]?key|private[_-]?key|auth|credential|bearer"
#: A name, a sign and a value; or a run of token characters that has a digit.
CANDIDATE = (
    rf"(?i)(?<![A-Za-z])(?:{NAMES})[A-Za-z0-9_-]{{0,16}}[\"']?\s{{0,3}}[=:]\s{{0,3}}[\"']?[A-Za-z0-9+/_.~-]{{6,}}+={{0,2}}"
    r"|(?:\G|(?<![A-Za-z0-9+/_-]))(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{12,}+={0,2}"
)
LEAD = rf"^(?i)(?:{NAMES})[A-Za-z0-9_-]{{0,16}}[\"']?\s{{0,3}}[=:]\s{{0,3}}[\"']?"
#: Common words, and syllables that make up words, for dictionary coverage.
WORDS = (
    "password|secret|token|example|sample|test|dummy|change|value|your|here|none|null|true|false|user|name|admin|default|config|string|number|"
    "version|release|build|file|path|http|https|www|index|page|image|data|info|time|date|the|and|for|with|that|this|from|have|will|not|are|was|"
    "tion|ment|ing|able|ness|ence|ance|ious|ally|ter|ver|con|pre|pro|com|per|est|ent|ate|ion|der|die|und|ich|sch|ein|les|des|que|pour|dans|los|las|del|por"
)
FEATURES = [
    "length({v})",
    "length(regexp_replace({v}, '[^0-9]', '')) / greatest(length({v}), 1)",
    "length(regexp_replace({v}, '[^A-Z]', '')) / greatest(length({v}), 1)",
    "length(regexp_replace({v}, '[^a-z]', '')) / greatest(length({v}), 1)",
    "size(regexp_extract_all({v}, '[a-z](?=[A-Z0-9])|[A-Z](?=[a-z0-9])|[0-9](?=[A-Za-z])', 0)) / greatest(length({v}), 1)",
    "size(regexp_extract_all(lower({v}), '[aeiou](?=[b-df-hj-np-tv-z])|[b-df-hj-np-tv-z](?=[aeiou])', 0)) / greatest(length({v}), 1)",
    "1 - length(regexp_replace(lower({v}), '" + WORDS + "', '')) / greatest(length({v}), 1)",
    "size(array_distinct(regexp_extract_all({v}, '.', 0)))",
    "int({v} rlike '^[0-9a-fA-F]+$')",
    "int({v} rlike '^(?:AKIA|ASIA|ghp_|gho_|github_pat_|xox[abps]-|sk_live_|sk-|AIza|eyJ|glpat-)')",
    "int({v} rlike '^[0-9a-f]{{8}}-[0-9a-f]{{4}}-|^[0-9]+$|^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')",
    "int({n})",
    "int(lower({b}) rlike '(?:key|token|secret|password|passwd|auth|bearer|credential)[a-z_-]*[ =:\"]*$')",
    r"int(lower(concat({b}, ' ', {v})) rlike 'example|sample|dummy|placeholder|changeme|your[_-]|xxxx|<|\\$\\{{|todo|fake')",
    r"int(lower({b}) rlike '(?:commit|sha1|sha256|md5|hash|digest|checksum|etag|uuid|guid|id|revision|isbn|phone|tel)[a-z_-]*[ =:\"#]*$')",
    "int(lower({p}) rlike 'test|example|fixture|mock|sample|docs?/|readme|vendor|node_modules|lock')",
    "int({v} rlike '[/].*[/]')",
]

_fitted: dict[str, str] = {}


def labelled(spark: SparkSession, rows: int = TRAIN_ROWS) -> DataFrame:
    """Labelled findings made by rule: (v, b, a, p, n, label); n tells a value assigned to a telling name."""
    h = "sha2(concat('secret', id), 256)"
    mixed = f"translate(base64(unhex({h})), '+/=', 'xyz')"
    upper = f"upper(translate({mixed}, '01', 'AB'))"
    word = "element_at(array('the','report','config','release','pour','einen','value','number','version','example'), cast(1 + id div 3 % 10 as int))"
    good = [
        f"substr({h}, 1, 40)", f"concat('AKIA', substr({upper}, 1, 16))", f"substr({mixed}, 1, 12)", f"substr({mixed}, 1, 32)",
        f"concat('ghp_', substr({mixed}, 1, 36))", f"lower(substr({mixed}, 1, 14))", f"substr({h}, 1, 12)", f"concat('sk_live_', substr({mixed}, 1, 24))",
    ]
    bad = [
        f"translate(substr({h}, 1, 16), 'abcdef', '135790')", f"concat({word}, '-', {word}, '-', id % 100)", f"substr({h}, 1, 40)",
        f"concat(substr({h}, 1, 8), '-', substr({h}, 9, 4), '-', substr({h}, 13, 4), '-', substr({h}, 17, 4), '-', substr({h}, 21, 12))",
        "concat('your_password_', id % 10)", f"concat('/', {word}, '/', {word}, '/', id % 1000, '/index')", f"concat({word}, {word}, {word}, id % 100)",
        f"concat('20', 10 + id % 15, '-0', 1 + id % 9, '-1', id % 10, 'T', id % 10)",
    ]
    pick = lambda x: "case id div 2 % 8 " + " ".join(f"when {i} then {v}" for i, v in enumerate(x)) + " end"
    key = "element_at(array('password', 'token = ', 'secret', 'api_key'), cast(1 + id div 16 % 4 as int))"
    near = "element_at(array('commit ', 'sha256: ', 'order ', 'uuid '), cast(1 + id div 16 % 4 as int))"
    base = spark.sql(f"select cast(id as int) id, cast(id % 2 as int) label from range(0, {rows}, 1, 4)")
    return base.selectExpr(
        "label",
        f"case when label = 1 then {pick(good)} else {pick(bad)} end v",
        f"case when label = 0 and id div 2 % 8 = 2 then {near} when label = 0 and id % 3 > 0 then concat({word}, ' ') when label = 0 then 'password' when id div 2 % 8 in (1, 4, 7) and id % 3 > 0 then concat({word}, ' ') else {key} end b",
        "' ' a",
        "case when id % 5 = 0 then 'src/tests/fixture' else concat('src', id % 20) end p",
        "case when label = 0 then id div 2 % 8 in (4, 6) and id % 3 = 0 else not (id div 2 % 8 in (1, 4, 7) and id % 3 > 0) end n",
    )


def fitted(spark: SparkSession, findings: DataFrame | None = None) -> str:
    """SQL of the share of trees that call a features array named f a secret."""
    key = spark.sparkContext.applicationId
    if findings is not None or key not in _fitted:
        from pyspark.ml.classification import RandomForestClassifier
        from pyspark.ml.functions import array_to_vector

        rows = (labelled(spark) if findings is None else findings.orderBy(F.xxhash64("v", "b", "p"), "v", "b", "a", "p", "n", "label").limit(TRAIN_ROWS)).withColumn("f", F.expr(features_sql(FEATURES, v="v", b="b", a="a", p="p", n="n")))
        train = rows.select(array_to_vector("f").alias("features"), F.col("label").cast("double").alias("label"))
        model = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=1, featureSubsetStrategy="onethird").fit(train.repartition(2))
        score = f"{forest_sql(model, '{f}')} / {TREES}D"
        if findings is not None:
            return score
        _fitted.clear()
        _fitted[key] = score
    return _fitted[key]


def with_findings(docs: DataFrame, out: str, score: str, text: str = "text", path: str = "source") -> DataFrame:
    """``docs`` with a column of (n, found): number of candidates, and findings as array<struct<s, e, score>>."""
    whole, place = f"coalesce(cast(`{text}` as string), '')", f"coalesce(cast(`{path}` as string), '')"
    cut = f"transform({matches(whole, CANDIDATE)}, c -> named_struct('v', regexp_replace(c.t, {literal(LEAD)}, ''), 'e', c.e, 'b', concat(c.b, regexp_extract(c.t, {literal(LEAD)}, 0)), 'a', c.a, 'n', c.t rlike {literal(LEAD)}))"
    with_f = f"transform({cut}, c -> named_struct('s', c.e - length(c.v), 'e', c.e, 'f', {features_sql(FEATURES, v='c.v', b='c.b', a='c.a', p=place, n='c.n')}))"
    scored = f"transform({with_f}, c -> named_struct('s', c.s, 'e', c.e, 'score', {score.replace('{f}', 'c.f')}))"
    return docs.withColumn(out, F.expr(f"transform(array({scored}), x -> named_struct('n', size(x), 'found', filter(x, c -> c.score >= {SHARE})))[0]"))


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("source").cast("string"))
    found = with_findings(docs, "scan", fitted(spark))
    return found.select(
        "doc_id",
        F.expr("cast(scan.n as bigint)").alias("n_candidates"),
        F.expr("cast(size(scan.found) as bigint)").alias("n_secrets"),
        F.expr("array_join(transform(scan.found, c -> concat(c.s, ':', c.e)), ',')").alias("spans"),
        F.expr("round(coalesce(array_max(transform(scan.found, c -> c.score)), 0D), 4)").alias("top_score"),
    )


QUERIES = {"op1_secret_scan": op1_secret_scan}
