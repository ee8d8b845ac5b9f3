"""Secret scans (1): candidates from whole texts, false positives removed by a random forest.

A candidate is a run of 16 or more of [A-Za-z0-9+/_=-] with a digit, a capital after a small letter or the prefix of a known
kind of key, or a run of 6 or more characters that a key word names (password = ...).  The forest sees its length, its
character transitions, how much of it dictionary words cover, whether it looks like a path, and the words around it; it is
trained from labelled findings (`LABELLED` columns), of which at most TRAIN_ROWS, the least by hash, are used.  The dictionary
is counted over all documents: words that occur LEAST_COUNT times or more.  Only DataFrame functions and JVM-side DataFrame
learners are used.

Null and empty texts have no candidates.  Every occurrence is a row of its own, in equal rows too; several candidates in one
word count one by one.  Columns besides doc_id and text are left out.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .exchange import salted, settled
from .quality import words_of

_RUN = r"A-Za-z0-9+/_=\-"
CANDIDATE = rf"(?<![{_RUN}])(?=[A-Za-z+/_=\-]*[0-9]|[{_RUN}]*[a-z][A-Z]|AKIA)[{_RUN}]{{16,}}"
LABELLED = ("value", "word", "before1", "before2", "after1", "label")
TRAIN_ROWS = 5000
LEAST_COUNT = 10
TREES, DEPTH, SEED = 24, 6, 11
#: Words that keys are named by, words that name harmless digests, and words for made findings where the corpus has none.
KEY_WORDS = "token|secret|passw|apikey|api_key|api-key|auth|credential|private|access|bearer|key"
HARMLESS_WORDS = "commit|sha1|sha256|md5|checksum|digest|hash|uuid|version|build|revision|card|isbn|order|example|sample|dummy|test|placeholder"
COMMON_WORDS = "the|and|that|with|from|this|have|page|data|file|name|user|test|value|index|table|class|public|config|version|number|document|example|service|module|content|image|static|report|update|default"
#: What a key word names: in one word with it, or after a word that ends in = or :
_SHORT = r"[A-Za-z0-9+/_\-!@#$%^&*~]{6,}"
_NAMED = rf"(?i)(?:{KEY_WORDS})[\w\-]{{0,20}}[\"']?[=:][\"']?{_SHORT}"
#: What a text has where a key word names anything; a plainer condition than the rule, and one that the rule implies.
_NAMES = rf"(?i){KEY_WORDS}"
FEATURES = ("length", "digits", "uppers", "lowers", "transitions", "distinct", "coverage", "hexadecimal", "path", "assigned", "key_near", "key_before", "harmless_near")


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, word_pos (from 0), value, word and the words before1, before2, after1 around it ('' beyond the ends).  Whether a word
    holds one depends on it and the two words before it alone."""
    some = docs.where(F.col("text").rlike(CANDIDATE) | (F.col("text").rlike("[=:]") & F.col("text").rlike(_NAMES))).select("doc_id", words_of(F.col("text")).alias("w"))
    n = F.size("w")
    blank = F.array(F.lit(""))
    around = F.arrays_zip(
        F.col("w").alias("word"),
        F.concat(blank, F.col("w")).alias("before1"),
        F.concat(blank, blank, F.col("w")).alias("before2"),
        F.concat(F.slice("w", F.lit(2), n), blank).alias("after1"),
        F.sequence(F.lit(0), n - 1).alias("word_pos"),
    )
    named = lambda x: x["word"].rlike(_NAMED) | (x["before1"].rlike("[=:]$") & F.concat_ws(" ", x["before2"], x["before1"]).rlike(rf"(?i){KEY_WORDS}") & x["word"].rlike(_SHORT))
    near = some.select("doc_id", F.explode(F.filter(around, lambda x: F.coalesce(x["word"].rlike(CANDIDATE) | named(x), F.lit(False)))).alias("x"))
    found = near.select("doc_id", "x.word_pos", "x.word", "x.before1", "x.before2", "x.after1")
    short = F.filter(F.array(F.regexp_extract("word", rf"(?:^|[=:\"'])({_SHORT})[\"',;.)]*$", 1)), lambda v: v != "")
    values = F.when(F.col("word").rlike(CANDIDATE), F.regexp_extract_all("word", F.lit(CANDIDATE), 0)).otherwise(short)
    return found.select("doc_id", "word_pos", F.explode(values).alias("value"), "word", "before1", "before2", "after1")


def dictionary(docs: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """part, n: runs of 3 to 20 letters a-z (A-Z count as small), of those that occur `least` times or more in all texts."""
    parts = docs.select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("part")).where("length(part) between 3 and 20")
    return parts.groupBy("part").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def with_coverage(rows: DataFrame, words: DataFrame) -> DataFrame:
    """rows with `covered`: how many characters of value lie in parts that are dictionary words (parts end at other characters
    than letters and before a capital that follows a small letter)."""
    parts = F.split(F.lower(F.regexp_replace("value", "([a-z])([A-Z])", "$1 $2")), "[^a-z]+")
    each = rows.select("value").distinct().select("value", F.explode(parts).alias("part")).where("length(part) between 3 and 20")
    each, words = salted(each, words.select("part"), "part", F.xxhash64("value"))
    known = each.join(words, ["part", "salt"]).groupBy("value").agg(F.sum(F.length("part")).alias("covered"))
    left, right = salted(rows, known, "value", F.xxhash64("word", "before1", "before2", "after1", F.rand(SEED)))
    return left.join(right, ["value", "salt"], "left").drop("salt").withColumn("covered", F.coalesce("covered", F.lit(0)))


def with_features(rows: DataFrame) -> DataFrame:
    """rows of LABELLED's first five columns and `covered`, and the columns of FEATURES."""
    v, n = F.col("value"), F.length("value").cast("double")
    share = lambda pattern: (n - F.length(F.regexp_replace(v, pattern, ""))) / n
    runs = v
    for pattern, mark in (("[a-z]+", "a"), ("[A-Z]+", "A"), ("[0-9]+", "0"), (r"[+/_=\-]+", "-")):
        runs = F.regexp_replace(runs, pattern, mark)
    before, near = F.lower(F.concat_ws(" ", "before2", "before1")), F.lower(F.concat_ws(" ", "before2", "before1", "word", "after1"))
    named = F.lower(F.element_at(F.split("word", CANDIDATE), 1))
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    return rows.select(
        "*",
        n.alias("length"),
        share("[0-9]").alias("digits"),
        share("[A-Z]").alias("uppers"),
        share("[a-z]").alias("lowers"),
        ((F.length(runs) - 1) / n).alias("transitions"),
        (F.size(F.array_distinct(F.split(v, ""))) / n).alias("distinct"),
        (F.col("covered") / n).alias("coverage"),
        flag(v.rlike("^[0-9a-f]+$|^[0-9A-F]+$")).alias("hexadecimal"),
        flag(v.rlike("/[A-Za-z_]{2,}/|^/[a-z]{2,}") | F.col("word").rlike(r"\.[a-z]{2,4}$|^https?:")).alias("path"),
        flag(F.col("word").rlike("[=:]") | F.col("before1").rlike("[=:]$")).alias("assigned"),
        flag(near.rlike(KEY_WORDS)).alias("key_near"),
        flag(before.rlike(KEY_WORDS) | named.rlike(KEY_WORDS)).alias("key_before"),
        flag(near.rlike(HARMLESS_WORDS)).alias("harmless_near"),
    )


def train(labelled: DataFrame, words: DataFrame):
    """A forest from labelled findings: LABELLED columns, label 1 for a secret and 0 for a false positive; rows with a null
    value or label are left out, an empty table raises ValueError.  words: the dictionary."""
    rows = labelled.where("length(value) > 0 and label in (0, 1)").select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in LABELLED[:5]), F.col("label").cast("double").alias("label"))
    bounded = settled(rows.orderBy(F.xxhash64(*LABELLED[:5]), *LABELLED).limit(TRAIN_ROWS).coalesce(1))
    if bounded.isEmpty():
        raise ValueError("no labelled findings")
    ready = settled(with_features(with_coverage(bounded, words)).coalesce(1).sortWithinPartitions(*LABELLED))
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    return forest.fit(VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(ready))


def scan(docs: DataFrame, model, words: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, word_pos, value, probability (6 places), is_secret: one row for each candidate.  words: the dictionary."""
    rows = with_features(with_coverage(settled(candidates(docs)), words))
    scored = model.transform(VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)).withColumn("probability", F.round(vector_to_array("probability")[1], 6))
    return scored.select("doc_id", "word_pos", "value", "probability", (F.col("probability") >= threshold).alias("is_secret"))


def learn_and_scan(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """scan with a forest trained from labelled findings, or from generated ones where there are none."""
    words = settled(dictionary(docs))
    return scan(docs, train(generated_findings(docs.sparkSession, words) if labelled is None else labelled, words), words)


def generated_findings(spark: SparkSession, words: DataFrame | None = None, n: int = 5000) -> DataFrame:
    """Labelled findings made by rule, for use where nobody has labelled any: seventeen kinds, seven of them secrets.  Harmless
    identifiers are put together from the 200 most frequent words of the dictionary."""
    common = [r.part for r in words.where("length(part) > 3").orderBy(F.desc("n"), "part").limit(200).collect()] if words is not None else []
    common = common or COMMON_WORDS.split("|")
    i = F.col("id").cast("string")
    digest = lambda tag, bits=256: F.sha2(F.concat(F.lit(tag), i), bits)
    chosen = lambda tag, options: F.element_at(F.array(*map(F.lit, options)), (F.pmod(F.xxhash64(F.lit(tag), i), F.lit(len(options))) + 1).cast("int"))
    pick = lambda *options: chosen("pick", options)
    word = lambda tag: chosen(tag, common)
    base64 = F.regexp_replace(F.base64(F.unhex(digest("b"))), r"\s", "")
    letters = F.translate(F.regexp_replace(base64, "[+/=]", "x"), "0123456789", "aQwErTyUiO")
    card = F.substring(F.translate(digest("c"), "abcdef", "394857"), 1, 16)
    name = pick("token", "secret", "api_key", "password", "access_key", "auth")
    size = (16 + F.pmod(F.xxhash64(F.lit("size"), i), F.lit(32))).cast("int")
    empty, colon, equals = F.lit(""), F.concat(name, F.lit(":")), F.lit("=")
    dashed = F.concat_ws("-", word("1"), word("2"), word("3"), F.substring(i, -4, 4))
    camel = F.concat(word("1"), F.initcap(word("2")), F.initcap(word("3")), F.initcap(word("4")))
    kinds = [
        (F.substring(digest("h"), F.lit(1), size), name, equals, empty, 1),
        (F.substring(base64, F.lit(1), size), empty, colon, empty, 1),
        (F.upper(F.concat(F.lit("AKIA"), F.substring(digest("a"), 1, 16))), F.lit("access"), F.lit("key"), empty, 1),
        (F.concat(pick("ghp_", "sk_", "tok_", ""), F.substring(F.regexp_replace(base64, "[+/=]", "x"), 1, 36)), empty, pick("bearer", "token", "use"), empty, 1),
        (F.substring(letters, F.lit(1), size), name, pick("=", ":", "is"), empty, 1),
        (F.concat(F.substring(base64, 1, 5), pick("!", "#", "7", "42", "_")), pick("the", "my", "root"), pick("password:", "passwd=", "secret:", "password="), empty, 1),
        (F.concat(F.initcap(word("1")), F.substring(i, -3, 3), pick("!", "$", "#")), pick("the", "my", "root"), pick("password:", "passwd=", "password="), empty, 1),
        (card, F.lit("card"), empty, empty, 0),
        (card, empty, pick("of", "und", "le", "de"), empty, 0),
        (F.substring(digest("g"), 1, 40), pick("in", "see", "at"), pick("commit", "sha1", "checksum", "revision"), empty, 0),
        (F.concat_ws("/", empty, word("1"), word("2"), F.concat(word("3"), i), dashed), word("5"), word("6"), empty, 0),
        (dashed, word("5"), word("6"), empty, 0),
        (F.concat_ws("-", *(F.substring(digest("u"), a, k) for a, k in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))), F.lit("the"), pick("uuid", "id", "session"), empty, 0),
        (camel, word("5"), pick(*common[:20], "token", "key:", "the"), empty, 0),
        (F.concat_ws("_", word("1"), word("2")), pick("the", "my", "a"), pick("password:", "secret:", "token=", "key:"), empty, 0),
        (F.concat(word("1"), F.lit("="), word("2"), F.lit("-"), i, F.lit("-"), word("3")), word("5"), word("6"), empty, 0),
        (F.concat(F.initcap(word("1")), F.initcap(word("2")), F.initcap(name), F.initcap(word("4"))), word("5"), word("6"), empty, 0),
    ]
    ids = spark.range(n)
    out = None
    for k, (value, before2, before1, after1, label) in enumerate(kinds):
        quoted = F.pmod(F.col("id"), F.lit(2)) == 0
        part = ids.where(f"id % {len(kinds)} = {k}").select(value.alias("value"), F.when(quoted, F.concat(F.lit('"'), value, F.lit('"'))).otherwise(value).alias("word"), before1.alias("before1"), before2.alias("before2"), after1.alias("after1"), F.lit(k).alias("kind"), F.lit(label).alias("label"))
        out = part if out is None else out.unionByName(part)
    return out
