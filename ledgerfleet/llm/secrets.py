"""Secret scan with false-positive removal by a random forest.

Everything runs in DataFrame functions and Spark's own random forest; no
Python touches a row.

A *candidate* is, anywhere in a whole text,

* a run of 16 or more letters, digits and ``+ / _ -``, with base64 padding (an
  ``=`` that more of a value follows is an assignment, not padding), or
* the value behind the name of a credential and ``=`` or ``:``, of VALUE_LEAST
  characters or more: between quotes up to the closing one on the same line,
  else up to white space, a quote, ``<``, ``>``, the next parameter of a URL
  query (``&name=``) or punctuation that ends it.

Its features:

* length, shares of digits and of capitals, different characters;
* character transitions: how often the kind of character changes, and the mean
  log likelihood of its letter pairs under the pairs of the corpus' words;
* dictionary coverage: the share of it that lies in words of the corpus;
* path: slashes, a separator before it, a file ending behind it;
* neighbouring words: cues of credentials and of harmless digests among the
  last words before it and the first behind it, an assignment, quotes.

The forest is trained from labelled findings (columns token, before, after,
label).  ``labelled_findings`` derives a bounded sample of them from the corpus:
prose words and plain numbers it holds (harmless, short words behind the name
of a credential too), and digests of such tokens and short passwords put behind
the name of a credential (secret), digests behind the name of a checksum or
inside a path (harmless), or replaced by placeholders (harmless).

Dictionary and letter pairs are counted over all documents.  Null texts count
as empty.  Repeated documents are scanned one by one; a token that occurs twice
is two findings.  Offsets are code points, end exclusive.
"""

from __future__ import annotations

import json

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

VALUE_LEAST = 6                 # characters of a value behind the name of a credential
_NAME = "token|secret|password|passwd|passphrase|pass|pwd|apikey|key|auth|bearer|credential"
# A name, alone or as the last part but one of a longer name, and its assignment.
_ASSIGNED = (f"(?:(?<![A-Za-z])(?i:{_NAME})|(?<=[a-z0-9])(?:Token|Secret|Password|Passwd|Pass|Pwd|Key|Auth|Credential))"
             "s?(?:[_-][A-Za-z0-9]{1,12})?[\"'`]?[ \\t]{0,2}[:=]{1,2}>?[ \\t]{0,2}")
_CORE = r"[^\s\"'`&<>.,;:)\]}]"
_PLAIN = rf"(?:{_CORE}|[.,;:)\]}}&]++(?={_CORE})(?!(?<=&)(?:amp;|[A-Za-z0-9_.-]{{1,40}}=)))"
# Cheap looks behind come first; the names are looked up behind an assignment only.
VALUE = "|".join([rf"(?<={q})(?<=[:=>][ \t]{{0,2}}{q})(?<={_ASSIGNED}{q})[^\r\n{q}]{{{VALUE_LEAST},}}+(?={q})"
                  for q in "\"'`"]
                 + [rf"(?<=[:=> \t\"'`])(?<=[:=>][ \t]{{0,2}}[\"'`]?)(?=[^\s=:>])(?<={_ASSIGNED}[\"'`]?)"
                    rf"(?={_PLAIN}{{{VALUE_LEAST}}}){_PLAIN}++"])
TOKEN = rf"{VALUE}|(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{16,}}+(?:={{1,2}}(?![A-Za-z0-9+/_=-]))?"
BEFORE, AFTER = 96, 48          # characters of context a finding carries
DICTIONARY_COUNT = 5            # occurrences that make a word a dictionary word
TRAIN_TOKENS = 2000             # corpus tokens the labelled sample starts from
TREES, DEPTH = 24, 7
THRESHOLD = 0.5

SECRET_CUES = ("token", "secret", "password", "passwd", "passphrase", "pass", "pwd", "apikey", "api_key", "key", "auth",
               "bearer", "credential", "access_key", "private_key", "client_secret")
HARMLESS_CUES = ("commit", "sha", "md5", "checksum", "digest", "hash", "uuid", "etag", "revision", "blob", "isbn",
                 "page", "version", "card", "phone", "example", "test", "dummy")
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789"
FEATURES = ("length", "digits", "capitals", "different", "changes", "likelihood", "coverage", "slashes", "path_before",
            "ending", "secret_cue", "harmless_cue", "assigned", "quoted")


def findings(docs: DataFrame) -> DataFrame:
    """doc_id, start, end, token, before, after: every candidate of ``docs``
    (doc_id, text) with the text around it."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
           .where(F.col("text").rlike(TOKEN))
           .select("doc_id", F.monotonically_increasing_id().alias("row"), F.split("text", TOKEN, -1).alias("gaps"),
                   F.regexp_extract_all("text", F.lit(TOKEN), F.lit(0)).alias("tokens")))

    def last(name: str, i: Column) -> Column:
        return F.when(i >= 0, F.right(F.get(F.col(name), i), F.lit(BEFORE))).otherwise(F.lit(""))

    # a long name is a candidate itself, and is context of its value all the same
    each = F.transform("tokens", lambda token, i: F.struct(
        token.alias("token"), F.length(F.col("gaps")[i]).alias("skip"),
        F.right(F.concat(last("gaps", i - 1), last("tokens", i - 1), last("gaps", i)), F.lit(BEFORE)).alias("before"),
        F.left(F.col("gaps")[i + 1], F.lit(AFTER)).alias("after")))
    found = own.select("doc_id", "row", F.posexplode(each).alias("pos", "f")).select("doc_id", "row", "pos", "f.*")
    order = Window.partitionBy("row").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("skip") + F.length("token")).over(order)
    return found.select("doc_id", "row", "pos", (end - F.length("token")).alias("start"), end.alias("end"),
                        "token", "before", "after")


def dictionary(docs: DataFrame) -> DataFrame:
    """word, n: the words of three or more letters of all documents that occur
    DICTIONARY_COUNT times or more."""
    words = docs.select(F.explode(F.split(F.lower(F.col("text").cast("string")), r"[^\p{L}]+")).alias("word"))
    return (words.where(F.length("word") >= 3).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= DICTIONARY_COUNT))


def letter_pairs(words: DataFrame) -> list[float]:
    """Log likelihood of a character after another in ``words`` (word, n), as
    a table of (len(ALPHABET) + 1) squared entries; other characters are 0."""
    chars = F.split("word", "")
    pairs = F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.struct(
        F.instr(F.lit(ALPHABET), F.element_at(chars, i)).alias("a"),
        F.instr(F.lit(ALPHABET), F.element_at(chars, i + 1)).alias("b")))
    size = len(ALPHABET) + 1
    counted = {(r["a"], r["b"]): r["n"] for r in                     # at most size * size rows
               words.where(F.length("word") > 1).select(F.explode(pairs).alias("p"), "n")
               .groupBy("p.a", "p.b").agg(F.sum("n").alias("n")).collect()}
    from math import log
    out = []
    for a in range(size):
        total = sum(counted.get((a, b), 0) for b in range(size)) + size
        out += [log((counted.get((a, b), 0) + 1) / total) for b in range(size)]
    return out


def _instr(char: Column) -> Column:
    return F.instr(F.lit(ALPHABET), char)


def featured(found: DataFrame, words: DataFrame, pairs: list[float]) -> DataFrame:
    """``found`` (with a unique column ``finding``) with the FEATURES."""
    n = F.length("token")
    chars = F.split(F.lower(F.col("token")), "")
    table = F.from_json(F.lit(json.dumps(pairs)), "array<double>")
    size = len(ALPHABET) + 1
    likelihood = F.aggregate(
        F.sequence(F.lit(1), n - 1), F.lit(0.0),
        lambda total, i: total + F.element_at(
            table, _instr(F.element_at(chars, i)) * size + _instr(F.element_at(chars, i + 1)) + 1)) / (n - 1)
    lower = F.lower(F.regexp_replace("before", "(?<=[a-z0-9])(?=[A-Z])", "_"))
    near = F.slice(F.reverse(F.regexp_extract_all(lower, F.lit("[a-z0-9_]+"), F.lit(0))), 1, 3)
    near = F.concat(near, F.flatten(F.transform(near, lambda w: F.split(w, "_"))))
    behind = F.slice(F.regexp_extract_all(F.lower("after"), F.lit("[a-z0-9_]+"), F.lit(0)), 1, 2)

    def cue(cues: tuple[str, ...]) -> Column:
        own = F.array(*map(F.lit, cues))
        return F.arrays_overlap(near, own).cast("int") * 2 + F.arrays_overlap(behind, own).cast("int")

    shaped = found.select(
        "*", n.cast("double").alias("length"),
        (F.regexp_count("token", F.lit("[0-9]")) / n).alias("digits"),
        (F.regexp_count("token", F.lit("[A-Z]")) / n).alias("capitals"),
        (F.size(F.array_distinct(chars)) / n).alias("different"),
        (F.regexp_count("token", F.lit("(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])")) / n)
        .alias("changes"),
        likelihood.alias("likelihood"),
        F.regexp_count("token", F.lit("/")).cast("double").alias("slashes"),
        F.col("before").rlike(r"[/\\.]$").cast("double").alias("path_before"),
        F.col("after").rlike(r"^\.[A-Za-z]{1,5}\b").cast("double").alias("ending"),
        cue(SECRET_CUES).cast("double").alias("secret_cue"),
        cue(HARMLESS_CUES).cast("double").alias("harmless_cue"),
        F.col("before").rlike(r"[=:]\s*[\"'`]?$").cast("double").alias("assigned"),
        (F.col("before").rlike("[\"'`]$") & F.col("after").rlike("^[\"'`]")).cast("double").alias("quoted"))
    shaped = materialize(shaped, "secret-shapes")
    runs = shaped.select("finding", F.explode(F.regexp_extract_all(F.lower("token"), F.lit("[a-z]{3,}"), F.lit(0)))
                         .alias("word"))
    covered = materialize(runs.join(words.select("word"), "word").groupBy("finding")
                          .agg(F.sum(F.length("word")).alias("covered")), "secret-cover")
    return (shaped.join(covered, "finding", "left")
            .withColumn("coverage", F.coalesce(F.col("covered"), F.lit(0)) / F.col("length")).drop("covered"))


def labelled_findings(found: DataFrame, most: int = TRAIN_TOKENS) -> DataFrame:
    """token, before, after, label: a bounded sample derived from candidates."""
    spark = found.sparkSession
    few = (found.select("token", "before", "after").where(F.length("token") <= 200)
           .orderBy(F.xxhash64("token", "before"), "token", "before", "after").limit(most))
    seeds = spark.range(64).select(F.concat(F.lit("example_seed_"), F.lpad(F.col("id").cast("string"), 4, "0"))
                                   .alias("token"), F.lit("the ").alias("before"), F.lit(" and").alias("after"))
    few = few.unionByName(seeds)
    pick = F.pmod(F.xxhash64("token", F.lit(1)), F.lit(1 << 20))
    digest = (F.when(pick % 4 == 0, F.sha1("token")).when(pick % 4 == 1, F.md5("token"))
              .when(pick % 4 == 2, F.regexp_replace(F.base64(F.unhex(F.sha1("token"))), "=+$", ""))
              .otherwise(F.concat(F.lit("AKIA"), F.upper(F.left(F.sha2("token", 256), F.lit(24))))))

    def one_of(options: list[str], salt: int) -> Column:
        k = F.pmod(F.xxhash64("token", F.lit(salt)), F.lit(len(options)))
        return F.element_at(F.array(*map(F.lit, options)), (k + 1).cast("int"))

    names = [f"{c}{s}" for c in SECRET_CUES for s in (' = "', ': "', "=", ": ")]
    harmless = [f"{c} " for c in ("commit", "sha", "md5", "checksum:", "digest", "hash", "etag", "revision", "blob")]
    paths = ["/objects/ab/", "https://example.org/static/", "src/main/assets/", "C:\\cache\\"]
    dull = ["xxxxxxxxxxxxxxxxxxxx", "your_api_key_goes_here", "0000000000000000000000", "changeme_changeme_changeme",
            "example_token_value_here", "test_password_placeholder"]
    opened = one_of(names, 2)
    closed = F.when(opened.endswith('"'), F.lit('"')).otherwise(F.lit(" "))
    tail = F.left(F.col("before"), F.lit(40))

    word = F.lower(F.regexp_extract("before", r"([A-Za-z]{6,14})[^A-Za-z]*$", 1))
    word = F.when(F.length(word) > 0, word).otherwise(one_of(["weather", "required", "example", "understanding"], 6))
    code = F.translate(F.base64(F.unhex(F.sha1("token"))), "+/=", "xyz")
    sign = one_of(list("!@#$.~%*"), 7)
    number = F.pmod(F.xxhash64("token", F.lit(8)), F.lit(9000)).cast("string")
    short = (F.when(pick % 6 == 0, F.concat(F.left(code, F.lit(3)), sign, F.substring(code, 4, 4)))
             .when(pick % 6 == 1, F.concat(F.initcap(F.left(word, F.lit(7))), number, sign))
             .when(pick % 6 == 2, F.concat(F.left(word, F.lit(7)), number))
             .when(pick % 6 == 3, F.left(code, F.lit(9)))
             .when(pick % 6 == 4, F.concat(F.left(code, F.lit(2)), sign, F.lpad(number, 5, "7")))
             .otherwise(F.concat(F.left(code, F.lit(5)), sign, F.substring(code, 6, 6), sign)))

    def row(token, before, after, label: int) -> Column:
        return F.struct(token.alias("token"), before.alias("before"), after.alias("after"), F.lit(label).alias("label"))

    natural = F.col("token").rlike("^[A-Za-z]+$") | F.col("token").rlike("^[0-9]+$")
    rows = F.array_compact(F.array(
        F.when(natural, row(F.col("token"), F.col("before"), F.col("after"), 0)),
        row(digest, F.concat(tail, F.lit(" "), opened), F.concat(closed, F.col("after")), 1),
        row(short, F.concat(tail, F.lit(" "), opened), F.concat(closed, F.col("after")), 1),
        row(word, F.concat(tail, F.lit(" "), opened), F.concat(closed, F.col("after")), 0),
        row(digest, F.concat(tail, F.lit(" "), one_of(harmless, 3)), F.col("after"), 0),
        row(digest, F.concat(tail, F.lit(" "), one_of(paths, 4)), F.lit(".html "), 0),
        row(one_of(dull, 5), F.concat(tail, F.lit(" "), opened), F.concat(closed, F.col("after")), 0)))
    return few.select(F.explode(rows).alias("r")).select("r.*")


def train(labelled: DataFrame, words: DataFrame, pairs: list[float], trees: int = TREES, depth: int = DEPTH,
          seed: int = 17) -> PipelineModel:
    """A forest from labelled findings (token, before, after, label)."""
    own = materialize(labelled, "secret-labels").withColumn("finding", F.monotonically_increasing_id())
    rows = materialize(featured(materialize(own, "secret-labelled"), words, pairs), "secret-training")
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed)
    return Pipeline(stages=[VectorAssembler(inputCols=list(FEATURES), outputCol="features"), forest]).fit(rows)


def scan(docs: DataFrame, labelled: DataFrame | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, start, end, token, probability, is_secret of every candidate of
    ``docs`` (doc_id, text); ``labelled``: findings to train from, by default
    those of ``labelled_findings``."""
    found = materialize(findings(docs), "secret-findings")
    words = materialize(dictionary(docs), "secret-words")
    pairs = letter_pairs(words)
    model = train(labelled if labelled is not None else labelled_findings(found), words, pairs)
    own = found.withColumn("finding", F.struct("row", "pos"))
    scored = model.transform(featured(own, words, pairs))
    probability = vector_to_array("probability")[1]
    return (scored.withColumn("probability", probability)
            .select("doc_id", "start", "end", "token", "probability", (F.col("probability") >= threshold)
                    .alias("is_secret")))
