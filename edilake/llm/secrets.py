"""Secret scans: candidates by pattern, false positives removed by a random forest.

A candidate is a run of 16 or more key characters with a digit, or a private key block. Its features are its length, how
often the class of character changes, the share of it that dictionary words cover, whether it stands in a path or an
address, and the words and marks beside it. The forest is trained from labelled findings. The scan is column expressions
only: two pattern passes over each whole text, then one row for each candidate.

``weak_labels`` labels the findings that are plain either way (a credential word assigns a random value; a number, a
path, a word), so that a forest can be trained where nobody has labelled any.

Defined results: null and empty texts have no findings. Without labelled findings of both kinds, a finding is a secret
if its weak label says so, with score 1 or 0. Repeated rows have the same findings each. Values are never stored, only
their digests.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edilake.functions.arrays import running_state
from edilake.llm.io import keep

# fixed values: words that announce a credential
CREDENTIAL_WORDS = ["token", "secret", "password", "passwd", "pwd", "apikey", "api_key", "api-key", "access_key", "auth",
                    "bearer", "credential", "private_key", "client_secret", "key"]
# fixed values: prefixes that issuers put before their keys
ISSUER_PREFIXES = ["AKIA", "ASIA", "ghp_", "gho_", "ghs_", "glpat-", "xoxb-", "xoxp-", "sk_live_", "sk-", "eyJ", "AIza"]

CANDIDATE = (r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----[A-Za-z0-9+/=\s]*+(?:-----END [A-Z ]{0,20}PRIVATE KEY-----)?"
             r"|(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{16,}+={0,2}")
NEAR = 48
FEATURES = ("length", "runs", "covered", "distinct", "digits", "slashes", "is_path", "credential_word", "credential_near", "assigned",
            "quoted", "issuer", "hex", "block")
UPPER, LOWER, DIGIT = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"


def dictionary(docs: DataFrame, most_words: int = 400) -> list[str]:
    """The words that most texts have, each different text counted once: part of the classifier, not of the scan."""
    texts = docs.where(F.col("text").isNotNull()).groupBy(F.md5("text").alias("text_key")).agg(F.first(distinct_words()).alias("words"))
    rows = texts.select(F.explode("words").alias("w")).groupBy("w").count().orderBy(F.desc("count"), "w").limit(most_words).collect()
    return sorted((r["w"] for r in rows), key=lambda w: (-len(w), w))


def distinct_words() -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[a-z]{3,}"), 0))


def findings(docs: DataFrame, words: list[str]) -> DataFrame:
    """doc_id, text_key (digest of the text), start (0-based character), value_sha256, and the features of each candidate."""
    rows = docs.select("doc_id", "text").where(F.col("text").rlike(CANDIDATE))
    cut = rows.select("doc_id", F.md5("text").alias("text_key"), F.regexp_extract_all("text", F.lit(CANDIDATE), 0).alias("v"),
                      F.split("text", CANDIDATE, -1).alias("gap"))
    # where each candidate starts: the lengths of all before it, summed up once per text
    steps = F.arrays_zip(F.transform("gap", F.length).alias("g"), F.transform("v", F.length).alias("n"))
    ends = running_state(steps, F.lit(0), lambda a, x: a + x["g"] + F.coalesce(x["n"], F.lit(0)), "int")
    beside = F.transform("gap", lambda g: F.struct(
        F.lower(g.substr(F.greatest(F.length(g) - NEAR + 1, F.lit(1)), F.lit(NEAR))).alias("before"), g.substr(1, NEAR).alias("after")))
    one = cut.select("doc_id", "text_key", "v", ends.alias("ends"), beside.alias("beside")).select(
        "doc_id", "text_key", F.inline(F.arrays_zip(
            F.col("v").alias("value"), F.slice("ends", F.lit(1), F.size("v")).alias("end"), F.slice("beside", F.lit(1), F.size("v")).alias("left"),
            F.slice("beside", F.lit(2), F.size("v")).alias("right"))))
    placed = one.select("doc_id", "text_key", (F.col("end") - F.length("value")).alias("start"), "value", F.col("left.before").alias("before"),
                        F.col("right.after").alias("after"))
    n = F.length("value")
    kinds = F.translate("value", UPPER + LOWER + DIGIT, "A" * 26 + "a" * 26 + "0" * 10)
    flag = lambda c: c.cast("double")
    named = "(" + "|".join(CREDENTIAL_WORDS) + ")"
    covered = n - F.length(F.regexp_replace(F.lower("value"), "|".join(words), "")) if words else F.lit(0)
    return placed.select(
        "doc_id", "text_key", "start", F.sha2("value", 256).alias("value_sha256"),
        n.cast("double").alias("length"), (F.length(F.regexp_replace(kinds, r"(.)\1*", "x")) / n).alias("runs"), (covered / n).alias("covered"),
        (F.size(F.array_distinct(F.split("value", ""))) / F.least(n, F.lit(62))).alias("distinct"),
        (F.lit(1.0) - F.length(F.translate("value", DIGIT, "")) / n).alias("digits"),
        (n - F.length(F.translate("value", "/", ""))).cast("double").alias("slashes"),
        flag(F.col("before").rlike(r"(://\S*|[/\\.@])$") | F.col("after").rlike(r"^(\.[a-z]{2,4}\b|[@?])")).alias("is_path"),
        flag(F.col("before").rlike(named + r"\W{0,12}$")).alias("credential_word"), flag(F.col("before").rlike(named)).alias("credential_near"),
        flag(F.col("before").rlike(r"[:=]\W{0,6}$")).alias("assigned"), flag(F.col("before").rlike("[\"'`]$") & F.col("after").rlike("^[\"'`]")).alias("quoted"),
        flag(F.col("value").rlike("^(" + "|".join(ISSUER_PREFIXES) + ")")).alias("issuer"), flag(F.col("value").rlike("^[0-9a-fA-F]+$")).alias("hex"),
        flag(F.col("value").startswith("-----BEGIN")).alias("block"))


def weak_labels() -> Column:
    """1 for plain secrets, 0 for plain false positives, null for what only a classifier can tell."""
    secret = (F.col("block") == 1) | ((F.col("runs") >= 0.25) & (F.col("covered") < 0.5) & (F.col("digits") < 1) & (F.col("is_path") == 0)
                                      & ((F.col("issuer") == 1) | ((F.col("credential_word") == 1) & (F.col("assigned") == 1))))
    not_secret = ((F.col("digits") == 1) | (F.col("is_path") == 1) | (F.col("covered") >= 0.6) | (F.col("distinct") < 0.15)
                  | ((F.col("runs") < 0.2) & (F.col("credential_near") == 0)))
    return F.when(secret, 1.0).when(not_secret, 0.0)


def train(labelled: DataFrame, label: str = "label", per_class: int = 10_000, trees: int = 20, depth: int = 6,
          seed: int = 7) -> RandomForestClassificationModel | None:
    """A forest from at most about ``per_class`` findings of each label, chosen by hash. None without both labels."""
    known = labelled.where(F.col(label).isin(0.0, 1.0))
    sizes = {r[label]: r["count"] for r in known.groupBy(label).count().collect()}
    if len(sizes) < 2:
        return None
    chance = F.pmod(F.xxhash64("value_sha256", "start"), F.lit(1_000_000))
    share = F.when(F.col(label) == 1.0, min(1.0, per_class / sizes[1.0])).otherwise(min(1.0, per_class / sizes[0.0])) * 1_000_000
    rows = known.where(chance < share).select(*FEATURES, F.col(label).alias("label"), "value_sha256").repartition(4, "value_sha256").sortWithinPartitions(*FEATURES)
    assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt").fit(assembled)


def judge(found: DataFrame, model: RandomForestClassificationModel | None, threshold: float = 0.5) -> DataFrame:
    """``found`` with score and is_secret."""
    if model is None:
        score = F.coalesce(weak_labels(), F.lit(0.0))
        return found.withColumns({"score": score, "is_secret": score >= threshold})
    scored = model.transform(VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(found))
    score = vector_to_array("probability").getItem(1)
    return scored.select(*found.columns, score.alias("score"), (score >= threshold).alias("is_secret"))


def scan(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """All candidates with features, score and is_secret. ``labelled`` holds value_sha256 and label (0 or 1) of findings;
    without it the forest learns from weak labels."""
    found = keep(findings(docs, dictionary(docs)), "findings")
    if labelled is None:
        known = found.withColumn("label", weak_labels())
    else:
        known = found.join(labelled.select("value_sha256", F.col("label").cast("double").alias("label")).dropDuplicates(["value_sha256"]), "value_sha256")
    return judge(found, train(known))


def report(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """doc_id, start, length, score, is_secret, value_sha256: a row for each candidate."""
    return scan(docs, labelled).select("doc_id", F.col("start").cast("bigint").alias("start"), F.col("length").cast("bigint").alias("length"),
                                       "score", "is_secret", "value_sha256")


def redact(docs: DataFrame, mark: str = "<SECRET>") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``mark`` and n_chars, if there is one, counted anew. Texts meet
    their findings by digest, so copies share one row of spans."""
    key, spans = "__text_key", "__secret_spans"
    found_in = (scan(docs).where("is_secret").select(F.col("text_key").alias(key), F.struct("start", F.col("length").cast("int").alias("n")).alias("span"))
                .groupBy(key).agg(F.array_sort(F.collect_set("span")).alias(spans)))
    end = lambda s: s["start"] + s["n"]
    text, found = F.col("text"), F.col(spans)
    pieces = F.transform(found, lambda s, i: F.concat(text.substr(
        F.when(i > 0, end(F.get(found, i - 1))).otherwise(0) + 1, s["start"] - F.when(i > 0, end(F.get(found, i - 1))).otherwise(0)), F.lit(mark)))
    last = F.element_at(found, -1)
    clean = F.concat(F.array_join(pieces, ""), text.substr(end(last) + 1, F.length(text)))
    joined = docs.withColumn(key, F.md5("text")).join(found_in, key, "left").withColumn("text", F.when(found.isNotNull(), clean).otherwise(text))
    if "n_chars" in docs.columns:
        joined = joined.withColumn("n_chars", F.when(found.isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return joined.select(*(F.col(f"`{c}`") for c in docs.columns))
