"""Secret scans: candidates by shape, false positives removed by a random forest.

Words are cut into pieces between key characters, so every run of a word counts
(compact JSON, CSV, URL parameters).  A candidate is a piece with a run of at
least ``SHORTEST`` key characters, or a piece of any length whose own key or the
piece before it names a secret.  Its features are the length, changes of
character class, runs of consonants, shares of digits, capitals and different
characters, coverage by dictionary words, whether it looks like a path, host or
number, and whether the word and its neighbours name a secret or something
harmless.  A random forest (Spark ML) trained from labelled findings gives each
candidate a probability.

``labelled_findings`` varies the values of a small labelled table, ``FINDINGS``.
A team's own triaged findings, as (text, secret) rows, replace it; the longest
candidate of each row carries the label.

All steps are DataFrame and Spark ML functions; candidates never meet in one
task, so a hot document or repeated key spreads over the scan.

Defined results: null and empty texts have no candidates; null ids and repeated
rows are kept, their candidates reported for each row; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHORTEST = 12
KEY = r"[A-Za-z0-9_+/=.@:-]"
RUN = rf"[A-Za-z0-9_+/=.@:-]{{{SHORTEST},}}"
# Words that name a secret, words that name something harmless, and a small dictionary.
SECRET_WORDS = "token|secret|password|passwd|pwd|apikey|api_key|api-key|access_key|auth|bearer|credential|private"
HARMLESS_WORDS = "commit|sha1|sha256|md5|checksum|digest|uuid|guid|version|isbn|order|invoice|phone|card|call|image|file|path|url|href|example|sample|test|build|revision|etag"
DICTIONARY = ("access admin api apple application auth backup base build change client cloud code commit config content count customer data date default demo device doc document download dummy "
              "email enable example field file filter first format form function get group hash header hello here home host http https image index info input insert item key lang library license link list local "
              "login mail main master message method model module month name network number object option order output package page param pass password path phone place placeholder post prefix private project public "
              "query read release remote report request response result sample schema script search secret section server service session set simple site source start state static status store string style submit "
              "system table tag target template test text time title token type update upload url user username value version view web window world www xxxx year your").split()
# The labelled table: 1 (secret) or 0 and a line.  Written by hand for this module after the usual shapes
# of configuration files, logs and source code; {..} stands for a value that training varies by rule.
FINDINGS = """
1 {word} token = "{hex40}" {other}
1 {word} password={hex18} {other}
1 {word} AKIA{CAPS16} {other}
1 api_key: {base40} {word}
1 export SECRET={hex32}
1 Authorization: Bearer {base40}
1 ghp_{mix36} {word}
1 auth_token='{hex28}'
1 TOKEN = "{HEX40}"!! {WORD}
1 {word}%%% password={hex18}%%% {other}
1 {word}### token = "{hex40}"*** {other}
1 client_secret: {hex28}
1 {word} password: {pass9} {other}
1 {word} password={pass9} {other}
1 secret: {letters14} {word}
1 {"id":"{word}","token":"{hex40}"}
1 https://{word}.net/{other}?token={hex40}&lang=en
1 pwd={mix20};
1 "private_key": "{base40}"
1 access_key = {mix20} # {word}
1 passwd: {letters14} {word}
1 password = "{pass9}"
0 commit {hex40} {word}
0 sha256 {hex64}
0 md5: {hex32} {word}
0 uuid {uuid}
0 {word} {num16} {other}
0 {word} {hex12}.png {other}
0 {word} password=changeme12345 {other}
0 token = "YOUR_API_TOKEN_HERE_1" {word}
0 {word} http://example.com/img/{hex12}.png
0 {word}.{num2}@mail4.example.com {other}
0 {word} 192.168.{num2}.1{num2} {other}
0 /usr/lib/python3.11/site-packages/{word}
0 getUserName{num2}Value4Index {word}
0 2024-01-{num2}T10:22:33 {word}
0 order 000-{num12}
0 api_key: example-sample-key-{num2} {word}
0 {word} +1-555-{num7} {other}
0 the password {word}
0 a secret {word} {other}
0 private {word}
0 password: changeme {word}
0 user={word}.{other}.{third}1
0 {"user":"{word}.{other}@host{num2}"}
0 https://{word}.example.org/{other}/{third}
0 https://www.{word}.com/{other}-{third}.html
0 {word}.{other}@{third}.org
0 {word}-{other}-{third}
0 {word}_{other}_{third}
0 {word}/{other}/{third}
0 {word} internationalization {other}
0 {word} responsibilities {other}
0 {word} Wahrscheinlichkeit {other}
0 {word} Geschwindigkeit {other}
0 {word} constitutionnel {other}
0 {word} responsabilidad {other}
0 {word} acknowledgement, {other}
0 {word} telecommunications. {other}
0 the author {word}
0 authority of {word}
0 the bearer of {word}
0 ================ {word}
0 ---------------- {word}
0 {word}................{other}
"""
FEATURES = ["n", "changes", "digits", "capitals", "different", "covered", "clusters", "hexadecimal", "numeric", "path", "host", "quoted", "assigned", "secret_near", "harmless_near", "provider"]


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), "[ \t\n\x0b\x0c\r]+", -1), "")


def names_secret(word: Column) -> Column:
    """Whether a piece ends as the name of a secret, before its value."""
    return F.lower(word).rlike(rf"(?:{SECRET_WORDS})[a-z_-]*[\"']?[=:]*[\"']?$")


def cut_up(word: Column) -> Column:
    """The pieces of a word between key characters, or the word itself."""
    pieces = F.regexp_extract_all(word, F.lit(rf"([\"']?{KEY}+[\"']?)"), F.lit(1))
    return F.when(word.rlike(rf"{KEY}[^A-Za-z0-9_+/=.@:-]+{KEY}"), pieces).otherwise(F.array(F.coalesce(word, F.lit(""))))


def all_candidates(rows: DataFrame) -> DataFrame:
    """Rows (.., w) as one row per candidate: ``at`` (word number), ``word``
    (its piece), ``before`` (two pieces) and ``after``.

    A word is cut up only if it has a long run or stands at most two words after
    the name of a secret, which every candidate does.  Each step carries the few
    words or pieces that it needs, so a text is not copied with each find."""
    rows = rows.withColumn("named", F.transform("w", lambda x: F.lower(x).rlike(SECRET_WORDS)))
    near = lambda i: F.get("named", i) | F.get("named", i - 1) | F.get("named", i - 2)
    spots = F.filter(F.sequence(F.lit(0), F.size("w") - 1), lambda i: ((F.length(F.get("w", i)) >= SHORTEST) & F.get("w", i).rlike(RUN)) | near(i))
    around = F.transform(spots, lambda i: F.struct(i.alias("i"), F.get("w", i - 2).alias("w2"), F.get("w", i - 1).alias("w1"), F.get("w", i).alias("w0"), F.get("w", i + 1).alias("wn")))
    rows = rows.withColumn("s", F.explode_outer(around)).drop("w", "named").filter("s is not null")      # outer: else the search runs twice, once as a filter
    rows = rows.withColumn("left", F.concat(cut_up(F.col("s.w2")), cut_up(F.col("s.w1")))).withColumn("own", cut_up(F.col("s.w0"))).withColumn("right", cut_up(F.col("s.wn")))
    rows = rows.withColumn("p", F.concat("left", "own", "right")).withColumn("at", F.col("s.i"))
    piece = lambda k: F.coalesce(F.get("p", k), F.lit(""))

    def wanted(k: Column) -> Column:
        x = piece(k)
        shaped = (F.length(x) >= SHORTEST) & x.rlike(RUN)
        own = F.lower(x).rlike(rf"^[\"']?[a-z_.-]*(?:{SECRET_WORDS})[a-z_.-]*[=:]+[\"']?[^\"']")
        beside = names_secret(piece(k - 1)) | (piece(k - 1).rlike("^[\"'=:>-]+$") & names_secret(piece(k - 2)))
        return shaped | (x.rlike("[A-Za-z0-9]") & (F.lower(x) != "bearer") & (own | beside))     # the scheme is a name, its token follows

    ks = F.filter(F.sequence(F.size("left"), F.size("left") + F.size("own") - 1), wanted)
    finds = F.transform(ks, lambda k: F.struct(piece(k).alias("word"), F.concat_ws(" ", piece(k - 2), piece(k - 1)).alias("before"), piece(k + 1).alias("after")))
    rows = rows.withColumn("f", F.explode_outer(finds)).drop("s", "left", "own", "right", "p").filter("f is not null")
    return rows.withColumn("word", F.col("f.word")).withColumn("before", F.col("f.before")).withColumn("after", F.col("f.after")).drop("f")


def with_features(found: DataFrame) -> DataFrame:
    """``found`` with the value of each candidate and its features."""
    run = F.coalesce(F.nullif(F.regexp_extract("word", RUN, 0), F.lit("")), F.regexp_extract("word", rf"{KEY}*[A-Za-z0-9]{KEY}*", 0))
    f = found.withColumn("value", F.regexp_replace(run, r"^[A-Za-z_.-]+[=:]+(?=.{8,})", ""))
    f = f.withColumn("value", F.regexp_replace("value", rf"^(?i)[a-z_.-]*(?:{SECRET_WORDS})[a-z_.-]*[=:]+(?=.)", ""))
    f = f.withColumn("value", F.regexp_replace("value", r"[.:]+$", ""))
    n = F.greatest(F.length("value"), F.lit(1))
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace("value", "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "9")
    runs = F.length(F.regexp_replace(kinds, r"(.)\1*", "$1"))
    dictionary = F.split(F.lit(" ".join(DICTIONARY)), " ")
    parts = F.regexp_extract_all(F.regexp_replace("value", "([a-z])([A-Z])", "$1 $2"), F.lit("([A-Za-z]{3,})"), F.lit(1))
    covered = F.aggregate(F.filter(F.transform(parts, F.lower), lambda p: F.array_contains(dictionary, p)), F.lit(0), lambda t, p: t + F.length(p))
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    near = F.lower(F.concat_ws(" ", "before", "word", "after"))
    own = F.lower(F.concat_ws(" ", "before", F.regexp_extract("word", r"^[\"']?([A-Za-z_.-]+)[=:]", 1)))
    return (f.withColumn("n", F.length("value").cast("double")).withColumn("changes", (runs - 1) / n)
            .withColumn("digits", F.length(F.regexp_replace("value", "[^0-9]", "")) / n).withColumn("capitals", F.length(F.regexp_replace("value", "[^A-Z]", "")) / n)
            .withColumn("different", F.size(F.array_distinct(F.split("value", ""))) / n).withColumn("covered", covered / n)
            .withColumn("clusters", F.length(F.array_join(F.regexp_extract_all(F.lower("value"), F.lit("([bcdfghjklmnpqrstvwxz]{4,})"), F.lit(1)), "")) / n)
            .withColumn("hexadecimal", flag(F.col("value").rlike("^[0-9a-f]+$|^[0-9A-F]+$"))).withColumn("numeric", flag(F.col("value").rlike("^[0-9.:+-]+$")))
            .withColumn("path", flag(F.col("word").rlike(r"://|^[./~]|/[a-z]+/|\.(?:[a-z]{2,4})[^a-z0-9]*$"))).withColumn("host", flag(F.col("word").rlike(r"@|\.(?:com|org|net|io)\b")))
            .withColumn("quoted", flag(F.col("word").rlike("[\"']"))).withColumn("assigned", flag(F.col("before").rlike("[=:][\"']?$") | F.col("word").rlike("^[\"']?[A-Za-z_.-]+[=:]")))
            .withColumn("secret_near", flag(own.rlike(rf"(?:{SECRET_WORDS})"))).withColumn("harmless_near", flag(near.rlike(rf"(?:{HARMLESS_WORDS})")))
            .withColumn("provider", flag(F.col("value").rlike("^(?:AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[A-Za-z0-9]{20,}$|^xox[abprs]-|^sk_live_|^AIza"))))


def labelled_findings(spark: SparkSession, n: int = 6000) -> DataFrame:
    """(text, secret): the lines of ``FINDINGS`` in turn, ``n`` in all, their
    values and words varied by row number."""
    r = spark.range(n).withColumn("h", F.sha2(F.col("id").cast("string"), 256)).withColumn("g", F.sha2(F.concat(F.lit("x"), F.col("id").cast("string")), 256))
    words_of = F.split(F.lit(" ".join(DICTIONARY)), " ")
    word = lambda k: F.element_at(words_of, (F.pmod(F.xxhash64("id", F.lit(k)), F.lit(len(DICTIONARY))) + 1).cast("int"))
    base64 = F.regexp_replace(F.base64(F.unhex("h")), "=", "")
    alnum = F.regexp_replace(F.concat(base64, F.base64(F.unhex("g"))), "[+/=]", "")
    digits, letters = F.translate("h", "abcdef", "012345"), F.translate("g", "0123456789", "ghkmnprtuw")
    values = {
        "hex18": F.substring("h", 1, 18), "hex28": F.substring("h", 1, 28), "hex32": F.substring("h", 1, 32), "hex40": F.substring("h", 1, 40), "hex64": F.col("h"), "HEX40": F.upper(F.substring("h", 1, 40)), "hex12": F.substring("g", 1, 12),
        "base40": F.substring(base64, 1, 40), "mix20": F.substring(alnum, 1, 20), "mix36": F.substring(alnum, 1, 36), "CAPS16": F.upper(F.substring(alnum, 1, 16)), "letters14": F.substring(letters, 1, 14),
        "pass9": F.concat(F.substring(letters, 1, 7), F.substring(digits, 1, 2)), "num7": F.substring(digits, 1, 7), "num12": F.substring(digits, 1, 12), "num16": F.substring(digits, 1, 16), "num2": F.substring(digits, 1, 2),
        "uuid": F.regexp_replace(F.substring("g", 1, 32), "(.{8})(.{4})(.{4})(.{4})(.{12})", "$1-$2-$3-$4-$5"), "word": word(1), "other": word(2), "third": word(3), "WORD": F.upper(word(1)),
    }
    lines = [(label, text) for label, _, text in (line.partition(" ") for line in FINDINGS.strip().splitlines())]
    at = (F.pmod("id", F.lit(len(lines))) + 1).cast("int")
    text = F.element_at(F.array(*(F.lit(t) for _, t in lines)), at)
    for name, value in values.items():
        text = F.replace(text, F.lit("{" + name + "}"), value)
    return r.select(text.alias("text"), F.element_at(F.array(*(F.lit(float(label)) for label, _ in lines)), at).alias("secret"))


def assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep")


def train(findings: DataFrame, *, trees: int = 24, depth: int = 7, seed: int = 5) -> RandomForestClassificationModel:
    """A forest from labelled findings (text, secret), the longest candidate of each."""
    found = all_candidates(findings.select("text", "secret", words(F.col("text")).alias("w")))
    longest = found.groupBy("text", "secret").agg(F.max(F.struct(F.length("word").alias("n"), "at", "word", "before", "after")).alias("f"))
    rows = with_features(longest.select("secret", "f.word", "f.before", "f.after"))
    forest = RandomForestClassifier(featuresCol="features", labelCol="secret", numTrees=trees, maxDepth=depth, seed=seed)
    return forest.fit(assembler().transform(rows.coalesce(1)).select("features", "secret"))


def scan(docs: DataFrame, model: RandomForestClassificationModel, *, id_col: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """Per candidate: doc_id, word_at, value_sha256, n_chars, probability and is_secret."""
    found = with_features(all_candidates(docs.select(F.col(id_col).alias("doc_id"), words(F.col(text)).alias("w"))))
    scored = model.transform(assembler().transform(found.select("doc_id", "at", "value", *FEATURES)))
    p = F.round(F.get(vector_to_array("probability"), F.lit(1)), 9)
    return scored.select("doc_id", F.col("at").cast("long").alias("word_at"), F.sha2("value", 256).alias("value_sha256"), F.length("value").cast("long").alias("n_chars"), p.alias("probability"), (p >= threshold).alias("is_secret"))
