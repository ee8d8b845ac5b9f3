"""Quality rules (7): adaptive thresholds from mergeable quantile sketches per language and source.

Every rule's value is a whole number (a share in thousandths).  A sketch is a histogram with bins of exact width up to 2^5
and 32 bins to each doubling beyond, so a quantile is off by at most 1/32; sketches merge by adding counts, which makes them
independent of partitions and their order.  A (language, source) group's sketch is mixed with those of its language and of all
documents, each with the weight of PRIOR documents: small groups lean on them, large ones hardly notice, and no size decides.
Both fences of a rule are quantiles of that mixture: the quartile plus REACH interquartile ranges, or the rule's own high quantile where
that is further out (as where most values are 0).  A joined filter applies them; a value in the bin of a fence's quantile
lies within it.  Only DataFrame functions are used.

Words are [^\\x20\\x09-\\x0D]+.  Null and empty texts have no words and fail the base rules.  Null languages and sources are
groups of their own.  Equal rows are treated alike.  Other columns are carried along unchanged, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .exchange import settled

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"
#: Weight, in documents, of the language's and of all documents' sketch in a group's.
PRIOR = 50
#: Interquartile ranges beyond the quartile.
REACH = 4
#: Rule -> thousandths of a sketch that a fence keeps at least; fewer where texts that break the rule are more common.
RULES = {"symbols": 900, "dup_lines": 990, "repeats": 990, "word_length": 990}
#: Rules with a lower fence too.
BOTH_SIDES = ("word_length",)
#: Counts of mixed sketches are whole multiples of one document's SCALE-th part.
SCALE = 65536
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def _repeat_words(windows: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more: windows are sorted by hash and compared with neighbours."""
    placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    pairs = F.arrays_zip(placed.alias("a"), F.slice(placed, F.lit(2), F.size(windows)).alias("b"))
    # where a window equals the next one, both are repeated
    both = F.transform(pairs, lambda p: F.when(p["a"]["h"] == p["b"]["h"], F.array(p["a"]["i"], p["b"]["i"])))
    places = F.array_sort(F.array_distinct(F.flatten(F.filter(both, lambda x: x.isNotNull()))))
    gaps = F.zip_with(places, F.slice(places, F.lit(2), F.size(windows)), lambda a, b: F.least(F.coalesce(b - a, F.lit(5)), F.lit(5)))
    return F.aggregate(gaps, F.lit(0), lambda s, x: s + x)


def with_features(docs: DataFrame, text: str) -> DataFrame:
    """docs, the columns of FEATURES and n_lines (long); `docs` must not have any of them.  Settle the result before filtering
    on it: a filter that the optimiser moves below would split each text anew for every word."""
    source = F.coalesce(F.col(text), F.lit(""))
    with_words = docs.select("*", words_of(F.col(text)).alias("_words"))
    words, n = F.col("_words"), F.size("_words")
    window = F.when(n >= 5, F.transform(F.sequence(F.lit(0), n - 5), lambda i: F.xxhash64(*(words[i + j] for j in range(5))))).otherwise(F.array().cast("array<bigint>"))
    lines = F.filter(F.split(source, "\n"), lambda x: x.rlike(WORD))
    measured = with_words.select(
        *docs.columns,
        n.cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.regexp_count(source, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        lines.alias("_lines"),
        window.alias("_windows"),
    )
    windows, lines = F.col("_windows"), F.col("_lines")
    return measured.select(
        *docs.columns,
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.size(lines).cast("long").alias("n_lines"),
        F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(_repeat_words(windows)).cast("long").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _values() -> dict[str, Column]:
    per_mille = lambda x, of="n_words": F.expr(f"1000 * {x} div greatest({of}, 1)")
    return {"symbols": per_mille("n_symbols"), "dup_lines": per_mille("n_dup_lines", "n_lines"), "repeats": per_mille("n_repeat_words"), "word_length": per_mille("word_chars")}


def bin_of(value: Column) -> Column:
    """Bin of a whole number of 0 or more."""
    doubling = F.length(F.bin(value)) - 6
    return F.when(value < 32, value).otherwise(32 * (doubling + 1) + F.floor(value / F.pow(F.lit(2), doubling)) - 32).cast("long")


def bin_floor(b: Column) -> Column:
    """The least value of a bin."""
    doubling = F.floor(b / 32) - 1
    return F.when(b < 32, b).otherwise((b - 32 * (doubling + 1) + 32) * F.pow(F.lit(2), doubling)).cast("long")


def sketches(features: DataFrame, by: list[str]) -> DataFrame:
    """by, rule, bin, n: the sketches of every group's documents that pass the base rules."""
    values = [F.struct(F.lit(rule).alias("rule"), bin_of(v).alias("bin")) for rule, v in _values().items()]
    rows = features.where(~base_failed()).select(*by, F.explode(F.array(*values)).alias("x"))
    return rows.groupBy(*by, "x.rule", "x.bin").agg(F.count(F.lit(1)).alias("n"))


def merged(sketch: DataFrame, by: list[str]) -> DataFrame:
    return sketch.groupBy(*by, "rule", "bin").agg(F.sum("n").alias("n"))


def mixed(sketch: DataFrame) -> DataFrame:
    """lang, source, rule, bin, weight: every group's sketch mixed with its language's and that of all documents."""
    groups = sketch.select("lang", "source", "rule").distinct()
    share = lambda n, size: F.expr(f"({PRIOR * SCALE}L * {n}) div {size}")
    wide = merged(sketch, ["lang"]).groupBy("lang", "rule").agg(F.collect_list(F.struct("bin", "n")).alias("bins"), F.sum("n").alias("size"))
    # one row for each rule, of some thousand bins at most
    everything = merged(sketch, []).groupBy("rule").agg(F.collect_list(F.struct("bin", "n")).alias("bins"), F.sum("n").alias("size"))
    wide = wide.select(F.col("lang").alias("l"), F.col("rule").alias("r"), "bins", "size")
    of_lang = groups.join(wide, F.col("lang").eqNullSafe(F.col("l")) & (F.col("rule") == F.col("r")))
    of_all = groups.join(F.broadcast(everything), "rule")
    parts = sketch.select("lang", "source", "rule", "bin", (F.col("n") * SCALE).alias("weight"))
    for part in (of_lang, of_all):
        rows = part.select("lang", "source", "rule", "size", F.explode("bins").alias("b")).select("lang", "source", "rule", "size", "b.bin", "b.n")
        parts = parts.unionByName(rows.select("lang", "source", "rule", "bin", share("n", "size").alias("weight")))
    return parts.groupBy("lang", "source", "rule", "bin").agg(F.sum("weight").alias("weight"))


def fences(mixture: DataFrame) -> DataFrame:
    """lang, source, rule, low (null: none), high."""
    group = Window.partitionBy("lang", "source", "rule")
    upto = mixture.withColumn("upto", F.sum("weight").over(group.orderBy("bin"))).withColumn("size", F.sum("weight").over(group))
    # the share that lies below is compared in thousandths of the size, rounded down, so that no product overflows
    at = lambda q: F.min(F.when(F.col("upto") >= F.expr(f"size div 1000 * {q} + size % 1000 * {q} div 1000"), F.col("bin")))
    tails = F.create_map(*(F.lit(x) for rule, kept in RULES.items() for x in (rule, kept)))
    upto = upto.withColumn("tail", tails[F.col("rule")])
    found = upto.groupBy("lang", "source", "rule").agg(at("(1000 - tail)").alias("b0"), at(250).alias("b1"), at(750).alias("b3"), at("tail").alias("b9"))
    q1, q3 = bin_floor(F.col("b1")), bin_floor(F.col("b3"))
    top = lambda b: bin_floor(F.col(b) + 1) - 1
    low, high = F.least(q1 - REACH * (q3 - q1), bin_floor(F.col("b0"))), F.greatest(top("b3") + REACH * (q3 - q1), top("b9"))
    return found.select("lang", "source", "rule", F.when(F.col("rule").isin(*BOTH_SIDES), low).alias("low"), high.alias("high"))


def thresholds(sketch: DataFrame) -> DataFrame:
    """lang, source and an array of (rule, f: low, high)."""
    return fences(mixed(sketch)).groupBy("lang", "source").agg(F.collect_list(F.struct("rule", F.struct("low", "high").alias("f"))).alias("fences"))


def verdicts(features: DataFrame, limits: DataFrame) -> DataFrame:
    """features with base_failed and kept."""
    lang, source = F.col("l.lang"), F.col("l.source")
    joined = features.alias("d").join(limits.alias("l"), F.col("d.lang").eqNullSafe(lang) & F.col("d.source").eqNullSafe(source), "left")
    outside = F.lit(False)
    for rule, v in _values().items():
        f = F.map_from_entries("l.fences")[rule]
        outside = outside | F.coalesce((v > f["high"]) | (v < f["low"]), v > f["high"], F.lit(False))
    return joined.select("d.*", base_failed().alias("base_failed"), (~base_failed() & ~outside).alias("kept"))


def assess(docs: DataFrame) -> DataFrame:
    """doc_id, the features, base_failed and kept of every row."""
    features = settled(with_features(docs.select("doc_id", "lang", "source", "text"), "text").drop("text"))
    return verdicts(features, thresholds(sketches(features, ["lang", "source"]))).select("doc_id", *FEATURES, "base_failed", "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of docs that every rule keeps, with the columns of docs."""
    packed = docs.select("lang", "source", "text", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    # measured once: rows go to the checkpoint folder with their features, and both the sketches and the filter read them there
    features = settled(with_features(packed, "text").drop("text"))
    return verdicts(features, thresholds(sketches(features, ["lang", "source"]))).where("kept").select("row.*")
