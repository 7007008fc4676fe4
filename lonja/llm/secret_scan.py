"""Secret scan: broad patterns propose findings, a random forest removes the false ones.

DataFrame functions and Spark's own random forest only. A finding is a value given to a name such as password
or token, a key with a provider's prefix, a private key header, or any long run of key characters. Its
features are length, character shares and transitions, the share of its letters that are words of the corpus,
path separators, and the words beside it.
"""

from __future__ import annotations

import math

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lonja.session import materialized

NAMES = "password|passwd|pwd|passphrase|secret|token|api[_-]?key|access[_-]?key|auth[_-]?key|credential"
_KEY = r"A-Za-z0-9+/_\-"
#: Anything that may be a secret: a named value, a private key header, or a long run of key characters.
CANDIDATE = (
    rf"""(?i:{NAMES})["']?\x20?[:=]\x20?["']?[^\x20\x09-\x0D"']{{6,}}+"""
    r"""|-----BEGIN[A-Z ]{0,24}PRIVATE KEY-----"""
    rf"""|(?<![{_KEY}])[{_KEY}]{{16,}}+={{0,2}}"""
)
_NAMED = rf"""^(?i:{NAMES})["']?\x20?[:=]\x20?["']?(.+)$"""
PREFIXED = r"^(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abpr]-[A-Za-z0-9-]{10,}|sk-[A-Za-z0-9-]{20,}|AIza[A-Za-z0-9_-]{35})$"
#: Words that a harmless long value often stands beside.
HARMLESS = "example|sample|dummy|placeholder|test|sha1|sha256|md5|checksum|digest|commit|revision|uuid|guid|isbn|version"
#: A word counts as known if it is this share of the corpus's words.
KNOWN = 2e-6
#: Most findings of each label that the forest is trained on.
SAMPLE = 20_000
TREES, DEPTH, SEED = 24, 6, 11

FEATURES = [
    "length", "digits", "capitals", "small", "signs", "distinct", "to_digit", "to_letter", "case_changes", "vowel_changes",
    "longest_letters", "hexadecimal", "coverage", "slashes", "dots", "named", "prefixed", "quoted", "name_near", "harmless_near",
    "words_before", "words_after",
]


def findings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``uid, number, doc_id, start, value, matched, before, after``: all candidates of all texts.

    ``start`` counts characters from 0 and is the place of ``value``; ``before`` and ``after`` are the text of up
    to 80 characters on either side.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where(F.col("text").rlike(CANDIDATE))
    found = rows.select(
        "doc_id", F.monotonically_increasing_id().alias("uid"), F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("matches"),
        F.split("text", CANDIDATE, -1).alias("between"),
    )
    # Only the ends of the parts between are kept; their lengths give the places.
    parts = F.transform("between", lambda x: F.struct(
        F.char_length(x).alias("n"), F.substring(x, 1, 80).alias("head"), F.right(x, F.lit(80)).alias("tail")))
    found = found.select("doc_id", "uid", "matches", parts.alias("between"))
    each = found.select("doc_id", "uid", "between", F.posexplode("matches").alias("number", "matched"))
    each = each.select(
        "doc_id", "uid", "number", "matched", F.element_at("between", F.col("number") + 1).alias("left"),
        F.element_at("between", F.col("number") + 2)["head"].alias("after"),
    )
    each = each.withColumn("step", F.col("left")["n"] + F.char_length("matched"))
    along = Window.partitionBy("uid").orderBy("number")
    end = F.sum("step").over(along)
    named = F.regexp_extract("matched", _NAMED, 1)
    value = F.when(named != "", named).otherwise(F.col("matched"))
    return each.select(
        "uid", "number", "doc_id", (end - F.char_length(value)).cast("long").alias("start"), value.alias("value"), "matched",
        F.col("left")["tail"].alias("before"), "after", (named != "").alias("is_named"),
    )


def known_words(docs: DataFrame, text: str = "text", share: float = KNOWN) -> DataFrame:
    """``word``: the words of three to sixteen ASCII letters that make at least ``share`` of such words, and two.

    Null and empty texts have none, rows that repeat count each time, and an empty table gives no word.
    """
    # Letters between digits, as in hexadecimal text, are no words.
    words = docs.select(F.explode(F.split(F.lower(F.col(text)), r"[^a-z0-9]++")).alias("word"))
    words = words.where(F.col("word").rlike("^[a-z]{3,16}$"))
    counts = materialized(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    return counts.where(F.col("n") >= max(2, math.ceil(share * total))).select("word")


def with_coverage(found: DataFrame, words: DataFrame) -> DataFrame:
    """Add ``coverage``: the share of the value's letters that stand in known words."""
    keys = found.select("value").distinct()
    chunks = keys.select("value", F.explode(F.split(F.lower("value"), r"[^a-z]++")).alias("word")).where("length(word) > 2")
    hits = chunks.join(words.withColumn("known", F.lit(1)), "word", "left")
    share = hits.groupBy("value").agg((F.sum(F.length("word") * F.coalesce("known", F.lit(0)))).alias("known_letters"))
    letters = F.greatest(F.regexp_count("value", F.lit("[A-Za-z]")), F.lit(1))
    return found.join(share, "value", "left").withColumn(
        "coverage", F.coalesce(F.col("known_letters") / letters, F.lit(0.0))).drop("known_letters")


def _share(pattern: str) -> Column:
    return F.regexp_count("value", F.lit(pattern)) / F.col("n")


def with_features(found: DataFrame) -> DataFrame:
    """Add the columns of ``FEATURES`` to findings with ``coverage``."""
    runs = F.transform(F.split("value", "[^A-Za-z]++"), lambda x: F.length(x))
    near = F.concat_ws(" ", F.regexp_extract("before", r"(?:[^ ]* ){0,2}[^ ]*$", 0), F.regexp_extract("after", r"^[^ ]*(?: [^ ]*){0,2}", 0))
    found = found.withColumns({"n": F.greatest(F.length("value"), F.lit(1)), "near": F.lower(near)})
    columns = {
        "length": F.col("n"), "digits": _share("[0-9]"), "capitals": _share("[A-Z]"), "small": _share("[a-z]"),
        "signs": _share("[^A-Za-z0-9]"), "distinct": F.size(F.array_distinct(F.split("value", ""))) / F.col("n"),
        "to_digit": _share("[A-Za-z](?=[0-9])"), "to_letter": _share("[0-9](?=[A-Za-z])"),
        "case_changes": _share("[a-z](?=[A-Z])|[A-Z](?=[a-z])"), "vowel_changes": _share("(?i)[aeiou](?=[bcdfghj-np-tv-z])"),
        "longest_letters": F.array_max(runs) / F.col("n"), "hexadecimal": F.col("value").rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"),
        "slashes": F.regexp_count("value", F.lit(r"[/\\]")), "dots": F.regexp_count("value", F.lit(r"[._-]")),
        "named": F.col("is_named"), "prefixed": F.col("value").rlike(PREFIXED),
        "quoted": F.col("after").rlike("""^["']"""), "name_near": F.col("near").rlike(NAMES),
        "harmless_near": F.col("near").rlike(HARMLESS), "words_before": F.regexp_count("before", F.lit("[^ ]+ ")),
        "words_after": F.regexp_count("after", F.lit(" [^ ]+")),
    }
    return found.withColumns({name: column.cast("double") for name, column in columns.items()}).drop("n", "near")


def label_findings(found: DataFrame) -> DataFrame:
    """Add ``label``: 1 and 0 for findings that their form settles, null for the others.

    Secrets: a provider's prefix with its exact form, a private key header, or a named value of twelve or more
    characters that mixes letters and digits, is no known word and has no harmless word beside it. Not secrets:
    values without a digit or without a letter, dates, addresses and paths of known words.
    """
    value, mixed = F.col("value"), F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Za-z]")
    header = value.startswith("-----BEGIN")
    secret = (F.col("prefixed") == 1) | header | (
        (F.col("named") == 1) & mixed & (F.length("value") >= 12) & (F.col("coverage") < 0.5) & (F.col("harmless_near") == 0))
    harmless = (~mixed & ~header) | ((F.col("slashes") > 1) & (F.col("coverage") >= 0.5)) | value.rlike(
        r"^[0-9]{4}-[0-9]{2}-[0-9]{2}") | ((F.col("harmless_near") == 1) & (F.col("named") == 0))
    return found.withColumn("label", F.when(secret, 1.0).when(harmless, 0.0))


def train(labelled: DataFrame, sample: int = SAMPLE) -> PipelineModel | None:
    """Random forest from findings with features and ``label`` (0 or 1; others are left out).

    At most ``sample`` findings of each label are used: those with the smallest hash. None without both labels.
    """
    rows = labelled.where("label IN (0, 1)").withColumn("turn", F.xxhash64("value", "before", "after"))
    chosen = [rows.where(F.col("label") == c).orderBy("turn", "value").limit(sample) for c in (0.0, 1.0)]
    data = materialized(chosen[0].union(chosen[1]).select("label", "turn", *FEATURES), "training")
    sizes = {row.label: row["count"] for row in data.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return None
    # Both labels have the same total weight.
    weight = F.when(F.col("label") == 1, F.lit(1 / sizes[1.0])).otherwise(F.lit(1 / sizes[0.0])) * F.lit(float(sum(sizes.values())) / 2)
    data = data.withColumn("weight", weight).coalesce(1).sortWithinPartitions("label", "turn")
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep")
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="label", weightCol="weight", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    return PipelineModel([assembler, forest.fit(assembler.transform(data))])


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model: PipelineModel | None = None) -> DataFrame:
    """One row per finding: ``doc_id, start, stop, rule, value_sha256, score, is_secret``.

    ``start`` (in) and ``stop`` (out) count characters of the text. Without a model, one is trained on the
    findings whose form settles their label; if these do not show both labels, the score is that label (0.5 for
    the others). Null and empty texts have no finding, an empty table gives an empty result; repeated rows have a
    finding each, null ids are kept. Other columns are not read.
    """
    found = materialized(findings(docs, doc_id, text), "findings")
    found = materialized(label_findings(with_features(with_coverage(found, known_words(docs, text)))), "features")
    model = model or train(found)
    if model is None:
        scored = found.withColumn("score", F.coalesce("label", F.lit(0.5)))
    else:
        scored = model.transform(found).withColumn("score", vector_to_array("probability")[1])
    rule = F.when(F.col("value").startswith("-----BEGIN"), "private key").when(F.col("named") == 1, "named value").when(
        F.col("prefixed") == 1, "provider key").otherwise("long run")
    return scored.select(
        "doc_id", "start", (F.col("start") + F.char_length("value")).alias("stop"), rule.alias("rule"),
        F.sha2("value", 256).alias("value_sha256"), "score", (F.col("score") >= 0.5).alias("is_secret"))
