"""Secret scans: candidates by pattern, false positives removed by a random forest. DataFrame and SQL functions only.

Candidates: runs of 16 or more key characters with a digit among them, quoted values of an assignment, and private key headers. They are marked
in the text by one linear pass and split off, which gives each candidate its neighbouring text and its offset. Nothing is shuffled: the tasks that read the texts
make the findings.

Features: length; character transitions (changes of class, frequent letter pairs, repeats); coverage by dictionary words; whether it looks like or stands in a
path or address; neighbouring words that speak for a secret or against; shares of character classes; how it is assigned and quoted.

The forest is trained on labelled findings (before, candidate, after, label), at most `max_findings` of them by a hash: a stated bound. `labelled_findings`
makes a seeded set: keys in several alphabets and settings, and digests, identifiers, numbers, words, paths and placeholders that are none.

Null and empty texts have no candidates; repeated rows repeat their findings; overlapping candidates do not occur. Offsets count characters from 0. A null doc_id
stays null. An empty table gives no findings. Ties do not occur: each candidate is judged alone. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import hash31, sample_below

_KEY = r"[A-Za-z0-9+/_=\-]"
CANDIDATE = rf"""(?<!{_KEY})(?=[A-Za-z+/_=\-]*+[0-9]){_KEY}{{16,}}+|(?<=[=:]\s?["'])[^\s"'\x01\x02]{{8,}}+(?=["'])|-----BEGIN [A-Z ]{{0,30}}PRIVATE KEY-----"""
CONTEXT = 48
# Words that tell about a candidate, and a small dictionary.
FOR = "key token secret passw pwd api auth bearer credential private access login sign session cookie"
AGAINST = "example sample test dummy placeholder changeme your checksum sha md5 commit hash digest etag uuid guid revision build isbn phone card order invoice serial version doi id fixme lorem"
DICTIONARY = (
    "the and for that with this from have was are not you all can had her one our out day get has him his how man new now old see two way who boy did its let put say she too use "
    "about after again below could every first found great house large learn never other place plant point right small sound spell still study their there these thing think three water where which world would write "
    "user name file path data list item page text test time type code view main home index value table image style script config server client default local node path class string number object length start end "
    "key token secret pass word example sample your here change"
)
PAIRS = "th he in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le ve co me de hi ri ro ic ne ea ra ce li ch ll be ma si om ur"
FEATURES = (
    "length", "changes", "distinct", "digits", "uppers", "lowers", "symbols", "is_hex", "only_digits", "covered", "pairs", "repeats",
    "slashes", "in_path", "speaks_for", "speaks_against", "inner_against", "assigned", "quoted", "known_prefix",
)


def running_sums(df: DataFrame, name: str) -> DataFrame:
    """Turns the array column `name` of longs into its running sums, inside the row: after each round an element holds the sum of eight times as many up to itself."""
    for reach in [8**k for k in range(10)]:  # arrays of up to 2^30
        more = F.transform(name, lambda x, i: reduce(Column.__add__, [F.coalesce(F.get(name, i - j * reach), F.lit(0)) for j in range(1, 8)], x))  # noqa: B023
        df = df.withColumn(name, F.when(F.size(name) > reach, more).otherwise(F.col(name)))
    return df


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, start, stop, finding, before, after: a row for each candidate, made by the task that reads its text."""
    raw = F.col(text)
    clean = F.when(raw.contains("\x01") | raw.contains("\x02"), F.translate(raw, "\x01\x02", "  ")).otherwise(raw)  # translate makes an object of each character
    parts = docs.where(clean.rlike(CANDIDATE)).select("doc_id", F.split(F.regexp_replace(clean, f"({CANDIDATE})", "\x01$1\x02"), "\x01", -1).alias("p"))
    # Each part but the first is a candidate, an end mark and what follows; its start is the length of all before.
    more = F.size("p") - 1
    lengths = F.transform(F.slice("p", 1, more), lambda x, i: (F.length(x) - F.when(i > 0, 1).otherwise(0)).cast("bigint"))

    def cut(here: Column, i: Column) -> Column:
        finding, prior = F.substring_index(here, "\x02", 1), F.replace(F.get("p", i), F.lit("\x02"), F.lit(""))
        return F.struct(
            F.get("start", i).alias("start"),
            finding.alias("finding"),
            F.substring(prior, -CONTEXT, CONTEXT).alias("before"),
            F.substring(here, F.length(finding) + 2, F.lit(CONTEXT)).alias("after"),
        )

    placed = running_sums(parts.withColumn("start", lengths), "start")
    each = placed.select("doc_id", F.explode(F.transform(F.slice("p", 2, more), cut)).alias("x"))
    return each.select("doc_id", "x.start", (F.col("x.start") + F.length("x.finding")).alias("stop"), "x.finding", "x.before", "x.after")


def with_features(found: DataFrame) -> DataFrame:
    """Findings with before and after -> the same with FEATURES, all doubles and never null."""
    s, n = F.col("finding"), F.greatest(F.length("finding"), F.lit(1))
    low, before, after = F.lower(s), F.lower("before"), F.lower("after")
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(s, "[a-z]+", "a"), "[A-Z]+", "A"), "[0-9]+", "0"), "[^aA0]+", "-")

    def share(pattern: str, of: Column = s) -> Column:
        return F.regexp_count(of, F.lit(pattern)) / n

    def words(text: str) -> str:
        return "|".join(sorted(set(text.split()), key=lambda w: (-len(w), w)))

    made = {
        "length": F.log2(n),
        "changes": F.length(classes) / n,
        "distinct": F.size(F.array_distinct(F.split(s, ""))) / F.least(n, F.lit(64)),
        "digits": share("[0-9]"),
        "uppers": share("[A-Z]"),
        "lowers": share("[a-z]"),
        "symbols": share("[^A-Za-z0-9]"),
        "is_hex": s.rlike("^([0-9a-f]+|[0-9A-F]+)$"),
        "only_digits": s.rlike("^[0-9 .+\\-/]+$"),
        "covered": (n - F.length(F.regexp_replace(low, f"({words(DICTIONARY)})", ""))) / n,
        "pairs": share(f"({words(PAIRS)})", low) * 2,
        "repeats": (n - F.length(F.regexp_replace(s, r"(.)\1{3,}", "$1"))) / n,
        "slashes": share("/") * 10,
        "in_path": before.rlike(r"(://|www\.|[/\\])\S*$") | after.rlike(r"^(\.[a-z]{2,4}\b|/)"),
        "speaks_for": before.rlike(f"({words(FOR)})"),
        "speaks_against": before.rlike(rf"\b({words(AGAINST)})") | after.rlike(rf"^\W*({words(AGAINST)})"),
        "inner_against": low.rlike("(example|sample|placeholder|changeme|your|dummy|xxxx|1234567|abcdef|0000000)"),
        "assigned": before.rlike(r"([=:]|=>|bearer)\s*[\"']?$"),
        "quoted": before.rlike("[\"']$") & after.rlike("^[\"']"),
        "known_prefix": s.rlike("^(AKIA|ASIA|ghp_|gho_|ghs_|github_pat_|glpat-|sk_live_|rk_live_|sk-|xox[abpr]-|AIza|eyJ|SG\\.|npm_|-----BEGIN)"),
    }
    return found.withColumns({k: F.coalesce(made[k].cast("double"), F.lit(0.0)) for k in FEATURES})


def labelled_findings(spark: SparkSession, n: int = 6000, seed: int = 5) -> DataFrame:
    """Seeded labelled findings: before, finding, after, label (1: a secret)."""
    rows = spark.range(n).withColumn("h", F.sha2(F.concat_ws(":", F.lit(seed), "id").cast("binary"), 256)).withColumn("g", F.sha2(F.concat_ws("/", F.lit(seed), "id").cast("binary"), 256))
    pick = lambda col, at, of: F.conv(F.substring(col, at, 4), 16, 10).cast("int") % of
    one = lambda options, at: F.element_at(F.array(*[F.lit(x) if isinstance(x, str) else x for x in options]), 1 + pick("g", at, len(options)))
    h, b64 = F.col("h"), F.regexp_replace(F.base64(F.unhex("h")), "=+$", "")
    digits = F.translate("h", "abcdef", "305816")
    word = F.concat(*[one(("the", "ing", "tion", "user", "path", "data", "er", "on", "list", "and", "for", "main", "test", "st", "view"), 1 + 4 * k) for k in range(8)])
    key = one((F.substring(h, 1, 32), F.substring(h, 1, 40), h, F.upper(F.substring(h, 1, 40)), b64, F.substring(b64, 1, 20), F.substring(b64, 1, 32), F.upper(F.substring(h, 1, 32))), 1)
    known = F.concat(one(("AKIA", "ghp_", "sk_live_", "xoxb-", "AIza", "glpat-", "SG."), 5), F.substring(b64, 1, 24))
    spoken = one(('token = "', 'api_key = "', "password: ", 'secret="', "Authorization: Bearer ", 'TOKEN = "', "access_key=", "auth_token: '", 'client secret = "', 'private key: "'), 9)
    prose = one(("where the value is ", "and then ", "we saw ", "from the list ", "see ", "of "), 13)
    digest = one(("commit ", "sha256 checksum: ", "md5sum ", "git hash = ", 'etag: "', "revision ", "digest "), 17)
    uuid = F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12))
    closing = F.when(F.col("before").endswith('"'), F.lit('" ')).when(F.col("before").endswith("'"), F.lit("' ")).otherwise(F.lit(" "))
    tail = one(("and so on", "with the rest.", "\nthe next line", "export it", ""), 21)
    kinds = [  # before, finding, label
        (spoken, key, 1), (spoken, known, 1), (prose, known, 1), (spoken, key, 1),
        (F.lit(""), F.lit("-----BEGIN RSA PRIVATE KEY-----"), 1),
        (digest, key, 0), (one(("id: ", "uuid=", 'guid "'), 9), uuid, 0),
        (one(("card ", "call ", "order ", "on ", "", "token of ", "phone: "), 9), F.substring(digits, 1, 16), 0),
        (prose, F.concat(word, F.lit("_"), F.substring(digits, 1, 3)), 0),
        (one(("https://www.site.org/", "/usr/share/", "src/main/", "see http://a.net/api/"), 9), F.concat(word, F.lit("/"), word, F.substring(digits, 1, 2)), 0),
        (spoken, one(("your_api_key_here_123", "xxxxxxxxxxxxxxxx0", "EXAMPLEKEY1234567890", "changeme-changeme-1", "0000000000000000", "placeholder_token_1", "abcdef1234567890abcdef"), 25), 0),
        (one(('name = "', "title: '", 'class="', 'path = "'), 9), word, 0),
        (prose, word, 0),
    ]
    k = pick("g", 61, len(kinds))
    cases = lambda at: F.coalesce(*[F.when(k == i, x[at] if isinstance(x[at], Column) else F.lit(x[at])) for i, x in enumerate(kinds)])
    out = rows.select(F.concat(prose, F.lit("it "), cases(0)).alias("before"), cases(1).alias("finding"), cases(2).cast("double").alias("label"), tail.alias("tail"))
    return out.select("before", "finding", F.concat(closing, "tail").alias("after"), "label")


def fit(findings: DataFrame, trees: int = 40, depth: int = 8, max_findings: int = 20_000, seed: int = 5) -> PipelineModel:
    """A forest on at most about `max_findings` labelled findings; both labels must occur."""
    below = sample_below(findings.count(), max_findings)
    rows = with_features(findings.where(hash31(F.lit(seed), "before", "finding", "after") < below)).select("label", *FEATURES)
    rows = rows.coalesce(1).sortWithinPartitions("label", *FEATURES)  # bounded; in one order, the seed gives one forest
    forest = RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed, rawPredictionCol="_raw", probabilityCol="_prob", predictionCol="_label")
    return Pipeline(stages=[VectorAssembler(inputCols=list(FEATURES), outputCol="x"), forest]).fit(rows)


def scan(docs: DataFrame, model: PipelineModel, threshold: float = 0.5) -> DataFrame:
    """doc_id, start, stop, finding, score of the candidates that the forest takes for secrets."""
    scored = model.transform(with_features(candidates(docs)))
    return scored.select("doc_id", "start", "stop", "finding", vector_to_array("_prob")[1].alias("score")).where(F.col("score") >= threshold)
