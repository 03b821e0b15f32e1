"""Secret scan with a random forest for false-positive removal, in DataFrame functions only.

Candidates are all long runs of key-like characters that hold a digit or mixed
case, wherever in a word they stand (compact JSON, query strings, CSV), all
shorter values assigned to a credential's name, in its word or the word after,
and passwords of connection strings.  Each is described by
its length, its character transitions, how much of it dictionary words cover,
whether it looks like a path, and the words next to it; a random forest
(Spark ML), trained from labelled findings, tells secrets from identifiers,
checksums, numbers and long words.

The dictionary is counted over all documents: the words of letters that occur
often enough, joined to the letter runs inside the candidates.  Words combine
in the map tasks before the shuffle, and candidates are few against the text.

Training takes at most ``TRAINING_ROWS`` labelled findings (value, before,
after, secret).  Where a caller has none of their own, ``labelled_findings``
makes them from rules: tokens of providers' formats in assignments, against
checksums, identifiers, paths, numbers and compound words.

A finding is a place: the word's number and the value's position in it, so that
masking changes the value there and nothing else of the text, in one pass over
the text's words.

Defined results: null or empty text: no candidate; repeated rows: a finding
each; null doc_id: kept; a text or table without candidates: no rows; long
words: every value in them (time grows with the square of the values in a
single word only); values that overlap: findings each, masked as one;
columns of the input named like a finding's are ignored, and kept by masking.
"""

from __future__ import annotations

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import joined, stored

MIN_LENGTH = 16
MIN_ASSIGNED = 6
TRAINING_ROWS = 4000
TREES, DEPTH, SEED = 24, 7, 11
THRESHOLD = 0.5
#: Words of letters that come so often per document, all documents together, count as dictionary words.
DICTIONARY_SHARE = 1e-4
#: Characters before a value that its features look at.
CONTEXT = 180
#: Names of credentials (fixed values).
NAMES = "token|secret|passwd|password|pwd|api[_-]?key|apikey|access[_-]?key|auth|credential|private[_-]?key|client[_-]?secret|bearer"

_WORDS = "split(t, '[\\\\x20\\\\x09-\\\\x0D]+')"
_CORE = "[A-Za-z0-9+/_=.~-]"
_QUOTE = "[\"\\'`]"
#: Key characters that a value holds, and that it ends with; '=' only pads it.
_IN, _END = "[A-Za-z0-9+/_.~-]", "[A-Za-z0-9+/_~-](?:={1,2}(?![A-Za-z0-9+/_.~=-]))?"
#: Values of a word: long runs; those after name= and quotes, and a login's password; the one that the word starts with.
_RUN = f"{_IN}{{{MIN_LENGTH - 1},}}{_END}"
_ASSIGNED = (
    f"(?<=(?i:{NAMES}){_QUOTE}{{0,2}}[=:]{_QUOTE}{{0,3}}){_IN}{{{MIN_ASSIGNED - 1},}}{_END}"
    f"|(?<=://[A-Za-z0-9._-]{{0,64}}:){_IN}{{{MIN_ASSIGNED - 1},}}{_END}(?=[^/]*@)"
)
_OPEN = "^[\"\\'`(\\\\[{<]*"
_FIRST = f"{_OPEN}({_IN}{{{MIN_ASSIGNED - 1},}}{_END})"
_TELLING = "(v rlike '[0-9]' or v rlike '[a-z][A-Z]')"

FEATURES = (
    "length", "runs", "transitions", "digits", "uppers", "symbols", "distinct", "hex", "numeric", "covered",
    "path", "dots", "named", "assigned", "named_inside", "quoted", "checksum_near", "known_prefix",
)


def candidates(docs: DataFrame) -> DataFrame:
    """row, doc_id, place (word number), start (in the word), value, before (two words), inside (text before it in its word), after."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("doc_id", "text").alias("row"),
        F.coalesce("text", F.lit("")).alias("t"),
    )
    rows = rows.withColumn("w", F.expr(_WORDS))
    long = f"length(w[i]) >= {MIN_LENGTH} and w[i] rlike '{_CORE}{{{MIN_LENGTH},}}' and (w[i] rlike '[0-9]' or w[i] rlike '[a-z][A-Z]')"
    named = (
        f"length(w[i]) >= {MIN_ASSIGNED} and i >= 1 and ((get(w, i - 1) in ('=', ':', ':=', '=>', 'is')"
        f" and coalesce(get(w, i - 2) rlike '(?i)({NAMES})', false)) or get(w, i - 1) rlike '(?i)({NAMES}){_QUOTE}?[=:]$')"
    )
    inside = f"length(w[i]) >= {MIN_ASSIGNED + 4} and w[i] rlike '(?i)({NAMES})[\"'']?[=:]'"
    login = "w[i] rlike '://[^/:@]*:[^/@]+@'"
    places = f"filter(sequence(0, size(w) - 1), i -> ({long}) or ({named}) or ({inside}) or ({login}))"
    found = rows.select("doc_id", "row", "w", F.explode(F.expr(places)).alias("place")).select(
        "doc_id",
        "row",
        "place",
        F.expr("w[place]").alias("word"),
        F.expr("concat_ws(' ', get(w, place - 2), get(w, place - 1))").alias("before"),
        F.expr("coalesce(get(w, place + 1), '')").alias("after"),
        F.expr(named.replace("w[i]", "w[place]").replace("i - ", "place - ").replace("i >= 1", "place >= 1")).alias("named"),
    )
    # Where a pattern's matches stand follows from the texts between them.
    spans = (
        "transform(regexp_extract_all(word, '{0}', 0), (v, i) -> named_struct('start',"
        " aggregate(slice(split(word, '{0}', -1), 1, i + 1), 0, (a, x) -> a + length(x))"
        " + aggregate(slice(regexp_extract_all(word, '{0}', 0), 1, i), 0, (a, x) -> a + length(x)), 'value', v))"
    )
    first = f"named_struct('start', length(regexp_extract(word, '{_OPEN}', 0)), 'value', regexp_extract(word, '{_FIRST}', 1))"
    values = (
        f"array_distinct(concat(filter({spans.format(_RUN)}, s -> {_TELLING.replace('v rlike', 's.value rlike')}),"
        f" {spans.format(_ASSIGNED)}, if(named, filter(array({first}), s -> s.value <> ''), array())))"
    )
    return (
        found.select("*", F.expr(f"inline({values})"))
        .withColumn("inside", F.expr(f"substring(word, greatest(1, start + 1 - {CONTEXT}), least(start, {CONTEXT}))"))
        .drop("word", "named")
    )


def described(found: DataFrame, words: DataFrame) -> DataFrame:
    """Adds FEATURES to rows with value, before, inside and after; ``words`` is the dictionary (word)."""
    found = found.withColumn("id", F.xxhash64("value"))
    pieces = (
        found.select("id", "value").distinct()
        .select("id", F.explode(F.expr("array_distinct(regexp_extract_all(lower(value), '[a-z]{3,}', 0))")).alias("word"))
    )
    covered = (
        pieces.join(words, "word").groupBy("id").agg(F.sum(F.length("word")).alias("known"))
    )
    share = "length(regexp_replace(value, '{}', '')) / length(value)"
    context = "lower(concat(before, ' ', inside))"
    # The password of a login in a connection string has the place of a name.
    login = "inside rlike '://[^/:@]*:$'"
    return (
        found.join(covered, "id", "left")
        .withColumn("length", F.expr("double(least(length(value), 200))"))
        .withColumn("runs", F.expr("double(length(regexp_replace(value, '[a-z]+|[A-Z]+|[0-9]+|[^a-zA-Z0-9]+', 'x')))"))
        .withColumn("transitions", F.expr("runs / length(value)"))
        .withColumn("digits", F.expr(share.format("[^0-9]")))
        .withColumn("uppers", F.expr(share.format("[^A-Z]")))
        .withColumn("symbols", F.expr(share.format("[a-zA-Z0-9]")))
        .withColumn("distinct", F.expr("size(array_distinct(split(value, ''))) / least(length(value), 64)"))
        .withColumn("hex", F.expr("double(value rlike '^[0-9a-fA-F]+$')"))
        .withColumn("numeric", F.expr("double(value rlike '^[0-9+.,/:-]+$')"))
        .withColumn("covered", F.expr("least(1D, coalesce(known, 0) / length(value))"))
        .withColumn("path", F.expr(f"double(length(regexp_replace(value, '[^/]', '')) >= 2 or (inside rlike '://' and not {login}))"))
        .withColumn("dots", F.expr("double(length(regexp_replace(value, '[^.@]', '')))"))
        .withColumn("named", F.expr(f"double({context} rlike '({NAMES})' or {login})"))
        .withColumn("assigned", F.expr(f"double({context} rlike '[=:][\"'' ]*$' or {context} rlike ' (=|:|:=|=>|is) *[\"'']?$')"))
        .withColumn("named_inside", F.expr(f"double(lower(inside) rlike '({NAMES})[\"'']?[=:]' or {login})"))
        .withColumn("quoted", F.expr("double(inside rlike '[\"''`]$')"))
        .withColumn("checksum_near", F.expr(f"double({context} rlike '(sha1|sha256|sha-|md5|commit|checksum|digest|uuid|guid|rev|hash|etag|build|order|isbn|phone|tel)')"))
        .withColumn("known_prefix", F.expr("double(value rlike '^(AKIA|ASIA|ghp_|gho_|ghs_|xox[bp]-|sk-|sk_live_|AIza|eyJ|glpat-)')"))
        .drop("id", "known")
    )


def dictionary(docs: DataFrame, share: float = DICTIONARY_SHARE) -> DataFrame:
    """Words of letters that all documents together hold ``share`` times a document, twice at least."""
    at_least = max(2, math.ceil(share * docs.count()))
    words = docs.select(F.explode(F.expr("split(lower(coalesce(text, '')), '[^a-z]+')")).alias("word"))
    return words.where("length(word) between 3 and 24").groupBy("word").count().where(F.col("count") >= at_least).select("word")


def labelled_findings(spark: SparkSession, rows: int = TRAINING_ROWS) -> DataFrame:
    """(value, before, inside, after, secret, kind), nearly half of them secrets, by rule from row numbers; kind is the rule's number."""
    h = "sha2(concat('{}', id), 256)"
    b64 = "base64(unhex(substring({}, 1, {})))"
    a, b = h.format("a"), h.format("b")
    word = "element_at(array('service','window','handler','report','status','update','module','index','default','factory','manager','session'), int(1 + id * {} % 12))"
    values = [
        # secrets
        (f"substring({a}, 1, 40)", 1), (f"upper(substring({a}, 1, 40))", 1), (f"substring({a}, 1, 32)", 1), (f"{b64.format(a, 48)}", 1), (f"concat('AKIA', upper(substring({a}, 1, 16)))", 1),
        (f"concat('ghp_', regexp_replace({b64.format(a, 54)}, '[^A-Za-z0-9]', 'x'))", 1), (f"concat('sk-', regexp_replace({b64.format(b, 48)}, '[^A-Za-z0-9]', 'Q'))", 1),
        (f"concat('eyJ', {b64.format(a, 30)}, '.', {b64.format(b, 40)})", 1), (f"concat(substring({a}, 1, 4), upper(substring({b}, 3, 5)), '-', substring({a}, 9, 6))", 1),
        (f"concat({word.format(3)}, string(10 + id * 37 % 9000), substring({b}, 1, int(id % 3)))", 1),
        (f"concat(initcap({word.format(7)}), '_', substring({a}, 1, 5), string(id % 97))", 1),
        # others
        (f"substring({b}, 1, 40)", 0), (f"{b}", 0), ("string(1000000000000000 + id * 7919317931)", 0),
        (f"concat_ws('-', substring({a}, 1, 8), substring({a}, 9, 4), substring({a}, 13, 4), substring({a}, 17, 4), substring({a}, 21, 12))", 0),
        (f"concat('/usr/lib/', {word.format(1)}, '/', {word.format(5)}, string(id % 9), '.so')", 0),
        (f"concat({word.format(1)}, {word.format(5)}, {word.format(7)}, string(id % 100))", 0), (f"concat({word.format(5)}, initcap({word.format(7)}), initcap({word.format(11)}))", 0),
        (f"concat({word.format(7)}, string(id % 97), '@mail', string(id % 9), '.example.com')", 0), (f"concat('2024-0', string(1 + id % 9), '-1', string(id % 9), 'T10:00:0', string(id % 9), 'Z')", 0),
        # ordinary words after a credential's name ("the secret: people ...")
        (f"{word.format(1)}", 2), (f"concat({word.format(5)}, 's')", 2), (f"concat({word.format(7)}, '-', {word.format(11)})", 2),
        (f"initcap({word.format(11)})", 2), (f"translate(substring({a}, 1, int(6 + id % 7)), '0123456789', 'oiaeuslrnt')", 2),
        (f"translate(substring({b}, 1, int(6 + id % 9)), '0123456789', 'ghklmnoprs')", 2),
    ]
    secret_before = "element_at(array('token =','api_key:','set password =','my secret is','x auth =','Bearer','aws access_key =','the token ='), int(1 + id * 3 % 8))"
    secret_inside = "element_at(array('\"','','\"','''','token=','password=\"','api_key:','\"'), int(1 + id * 5 % 8))"
    plain_before = "element_at(array('the commit','in this','sha256 checksum','order number','see file','of the','uuid is','and then','card no','mail to'), int(1 + id * 3 % 10))"
    plain_inside = "element_at(array('','','(','sha1:','\"','','',''), int(1 + id * 5 % 8))"
    pick = "case kind " + " ".join(f"when {k} then {v}" for k, (v, _) in enumerate(values)) + " end"
    secrets, named = (", ".join(str(k) for k, (_, s) in enumerate(values) if s in kinds) for kinds in ((1,), (1, 2)))
    return (
        spark.range(0, rows, 1, 1)
        .withColumn("kind", F.expr(f"int(id % {len(values)})"))
        .withColumn("secret", F.expr(f"double(kind in ({secrets}))"))
        .select(
            F.expr(pick).alias("value"),
            F.expr(f"if(kind in ({named}), {secret_before}, {plain_before})").alias("before"),
            F.expr(f"if(kind in ({named}), {secret_inside}, {plain_inside})").alias("inside"),
            F.lit("the").alias("after"),
            "secret",
            "kind",
        )
    )


def train(findings: DataFrame, words: DataFrame, rows: int = TRAINING_ROWS) -> PipelineModel:
    """The forest from at most ``rows`` labelled findings (those of the smallest hashes, if there are more)."""
    some = findings.orderBy(F.xxhash64("value", "before", "inside"), "value").limit(rows)
    sample = stored(described(some, words).select(*FEATURES, "secret"), "secret-training")
    # Grown from one partition: the trees don't depend on how the sample is dealt.
    sample = sample.coalesce(1).sortWithinPartitions(*FEATURES, "secret")
    forest = RandomForestClassifier(
        labelCol="secret", featuresCol="x", numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt"
    )
    return Pipeline(stages=[VectorAssembler(inputCols=list(FEATURES), outputCol="x"), forest]).fit(sample)


def scan(docs: DataFrame, findings: DataFrame | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """All candidates with their score and verdict: row, doc_id, place, start, value, score, is_secret."""
    docs = docs.select("doc_id", "text")
    words = stored(dictionary(docs), "secret-dictionary")
    model = train(findings if findings is not None else labelled_findings(docs.sparkSession), words)
    found = stored(candidates(docs), "secret-candidates")
    scored = model.transform(described(found, words)).withColumn("score", F.round(vector_to_array("probability")[1], 6))
    return scored.select("row", "doc_id", "place", "start", "value", "score", (F.col("score") >= threshold).alias("is_secret"))


_SPACE = "[\\\\x20\\\\x09-\\\\x0D]"
#: A text cut before the white space in front of each word.
_PIECES = f"split(text, '(?<=[^\\\\x20\\\\x09-\\\\x0D])(?={_SPACE})')"


def redacted(docs: DataFrame, found: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The documents with every value found secret replaced by ``mark`` where it was found, and nothing else changed.

    All columns are kept; n_chars, if there, counts the changed text.
    """
    words = found.where("is_secret").groupBy("row", "place").agg(
        F.sort_array(F.collect_set(F.struct("start", F.length("value").alias("size")))).alias("cuts")
    )
    edits = words.groupBy(F.col("row").alias("_row")).agg(F.sort_array(F.collect_list(F.struct("place", "cuts"))).alias("_edits"))
    rows = docs.withColumn("_row", F.xxhash64(F.col("doc_id").cast("long"), "text"))
    rows = joined(rows, edits, ["_row"], "left")
    # The words are numbered from 1 where white space comes first.
    number = f"(get(_edits, i).place - if(text rlike '^{_SPACE}', 1, 0))"
    before = f"if(i = 0, 0, {number.replace('get(_edits, i)', 'get(_edits, i - 1)')} + 1)"
    kept = f"array_join(slice(_pieces, {before} + 1, if(i < size(_edits), {number}, size(_pieces)) - {before}), '')"
    piece = f"get(_pieces, {number})"
    lead = f"length(regexp_extract({piece}, '^{_SPACE}*', 0))"
    # Over a word's values in order: text up to the value and a mark, or a longer end where two overlap.
    edited = (
        f"aggregate(get(_edits, i).cuts, named_struct('at', 0, 'out', ''), (a, c) -> named_struct("
        f"'at', greatest(a.at, {lead} + c.start + c.size), 'out', if({lead} + c.start < a.at, a.out,"
        f" concat(a.out, substring({piece}, a.at + 1, {lead} + c.start - a.at), '{mark}'))),"
        f" a -> concat(a.out, substring({piece}, a.at + 1)))"
    )
    whole = f"array_join(transform(sequence(0, size(_edits)), i -> concat({kept}, if(i < size(_edits), {edited}, ''))), '')"
    changed = F.col("_edits").isNotNull()
    rows = rows.withColumn("_pieces", F.when(changed, F.expr(_PIECES))).withColumn("text", F.when(changed, F.expr(whole)).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return rows.select(*docs.columns)


def masked(docs: DataFrame) -> DataFrame:
    """The documents with the secrets found in them replaced."""
    return redacted(docs, scan(docs))


def report(docs: DataFrame) -> DataFrame:
    """The findings with the value's digest in place of the value."""
    return scan(docs).select(
        "doc_id", "place", F.sha2("value", 256).alias("value_sha256"), F.length("value").alias("length"), "score", "is_secret"
    )
