"""Secret scans: candidates by pattern, false positives removed by a random forest.  DataFrame operations only.

Candidates are found anywhere in a text, several in one piece without blanks
too: values assigned to a name (``name = value``, ``"name": "value"``,
``name=value&``) that is like "password" or "token", keys with a known prefix,
and long runs of mixed characters with a digit.  Each is described by its
length and classes of characters, transitions between classes, coverage by a
small dictionary, path-like marks, the name it is assigned to and the words
before and after it.  A random forest, fitted on labelled findings, gives the
probability that it is a secret.

Findings for training are a parameter: lines of text with the label of the
candidates in them.  Without them ``labelled_findings`` makes lines by rule:
keys, tokens and passwords against digests, identifiers, paths, links, numbers
and placeholders.

Places are running sums over a text's candidates, made by a window over rows of
candidates: time and memory grow with their number, not its square.

Defined cases: null or empty text has no candidate; texts are scanned whole;
repeated rows are reported each; an empty table gives no findings; start and
end are code points of the bare value (end exclusive); word counts a text's
matches from 0; extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

CUE = r"(?i)(pass(word|wd|phrase)?|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credential|auth|bearer|pwd)"
NOT_CUE = r"(?i)(commit|sha\d*|md5|checksum|digest|hash|etag|uuid|guid|revision|build|isbn|order|invoice|version|file|path|image|integrity)"
PREFIX = r"(?<![A-Za-z0-9])(?:AKIA|ASIA|ghp_|gho_|github_pat_|glpat-|xox[bapr]-|sk_live_|sk-|rk_live_|AIza|eyJ|SG\.)[A-Za-z0-9_.-]{10,}"
#: What stands before an assigned value; possessive, so that a name is read once.
NAME = r"(?<![\w.-])[\w.-]++[\"']?\s{0,3}[:=]{1,2}\s{0,3}[\"']?(?:(?i:bearer|basic|token)\s{1,3})?"
VALUE = r"[^\s\"'<>&,;:?={}\[\]()|]{6,}={0,2}"
_RUN = "[A-Za-z0-9+/_=.~-]"
#: A run of 16 characters or more with a digit in it.
MIXED = rf"(?={_RUN}*[0-9]){_RUN}{{16,}}"
CANDIDATE = rf"{PREFIX}|{NAME}(?!//){VALUE}|(?:(?<!{_RUN})(?!//)|(?<=://)){MIXED}"
TAIL = r"[.,;!~-]+$"
DICTIONARY = r"(the|and|for|with|your|here|example|sample|test|dummy|change|replace|insert|key|token|secret|password|name|user|admin|data|file|image|index|home|path|http|www|com|org|html|json|config|version|value|string|number|null|none|true|false|abc|qwerty|1234|0000|xxxx|\*\*\*\*)"
BLANKS = "\t\n\v\f\r"
TREES, DEPTH, SEED = 40, 8, 17
FEATURES = ("n", "digits", "uppers", "lowers", "hexes", "signs", "changes", "repeats", "distinct", "vowels", "known", "slashes", "dots", "link", "only_digits", "only_hex", "uuid", "prefix", "name_cue", "cue", "not_cue", "assign", "quoted", "after_assign")


def _share(value: Column, pattern: str, n: Column) -> Column:
    return (F.length(value) - F.length(F.regexp_replace(value, pattern, ""))) / n


def described(found: DataFrame) -> DataFrame:
    """found (name, bare, before, after) with the feature columns."""
    v, n = F.col("bare"), F.greatest(F.length("bare"), F.lit(1)).cast("double")
    near = F.concat_ws(" ", F.col("before"), F.col("name"))
    yes = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    return found.withColumns({
        "n": n,
        "digits": _share(v, "[0-9]", n), "uppers": _share(v, "[A-Z]", n), "lowers": _share(v, "[a-z]", n), "hexes": _share(v, "[0-9a-f]", n), "signs": _share(v, "[^A-Za-z0-9]", n),
        "changes": F.regexp_count(v, F.lit(r"(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])|(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])")) / n,
        "repeats": F.regexp_count(v, F.lit(r"(.)\1")) / n,
        "distinct": F.size(F.array_distinct(F.split(v, ""))) / n,
        "vowels": _share(F.lower(v), "[aeiou]", n),
        "known": _share(F.lower(v), DICTIONARY, n),
        "slashes": F.regexp_count(v, F.lit(r"[/\\]")).cast("double"), "dots": F.regexp_count(v, F.lit(r"\.")).cast("double"), "link": yes(v.startswith("//") | v.rlike(r"(?i)^www\.|@[a-z0-9-]+\.|\.(com|org|net)\b") | F.col("before").rlike("@$")),
        "only_digits": yes(v.rlike("^[0-9 -]+$")), "only_hex": yes(v.rlike("^[0-9a-f]+$")), "uuid": yes(v.rlike("^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$")), "prefix": yes(v.rlike(PREFIX)),
        "name_cue": yes(F.col("name").rlike(CUE)), "cue": yes(near.rlike(CUE)), "not_cue": yes(near.rlike(NOT_CUE) | v.rlike(r"(?i)^(sha\d*|md5)[-_]")),
        "assign": yes(F.col("name") != ""), "quoted": yes(F.col("name").rlike("[\"']$") | F.col("after").rlike("^[\"'`]")), "after_assign": yes(F.col("after").rlike("^[\"']?[=:]")),
    })


def labelled_findings(spark: SparkSession, rows: int = 6000) -> DataFrame:
    """(text, label): lines made by rule from row numbers; the same at every size of the data."""
    i = F.col("id")
    pick = lambda salt, n: F.pmod(F.xxhash64(F.lit(salt), i), F.lit(n)).cast("int")
    one_of = lambda salt, words: F.element_at(F.array(*[F.lit(w) for w in words]), pick(salt, len(words)) + 1)
    text = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])
    hexes = F.sha2(F.concat(F.lit("h"), i.cast("string")), 256)
    mixed = F.regexp_replace(F.base64(F.unhex(hexes)), "=+$", "")
    word = F.concat_ws("", *[one_of(f"w{k}", ["ing", "the", "tion", "er", "and", "ou", "re", "ed", "men", "lich", "ado", "aux", "que", "ly", "ent", "sch"]) for k in range(7)])
    number = F.regexp_replace(F.concat(F.xxhash64(i, F.lit("n")).cast("string"), F.xxhash64(i, F.lit("m")).cast("string")), "-", "")
    uuid = F.concat_ws("-", F.substring(hexes, 1, 8), F.substring(hexes, 9, 4), F.substring(hexes, 13, 4), F.substring(hexes, 17, 4), F.substring(hexes, 21, 12))
    length = F.element_at(F.array(F.lit(32), F.lit(40), F.lit(64)), pick("l", 3) + 1)
    size = pick("s", 24) + 20
    key = one_of("c", ["token", "api_key", "secret", "password", "auth_token", "access_key", "SECRET_KEY", "client_secret", "DB_PASSWORD", "my.api-key"])
    plain = one_of("p", ["of", "the", "and", "de", "la", "der", "und", "que", "from", "is", "see", "at"])
    other = one_of("o", ["commit", "sha256", "md5", "checksum", "etag", "revision", "uuid", "hash", "build", "digest"])
    to = one_of("a", [" = ", ": ", "=", ":", " := "])
    digest_, some = hexes.substr(F.lit(1), length), mixed.substr(F.lit(1), size)
    short = mixed.substr(F.lit(1), pick("q", 8) + 8)
    kinds = [
        # (line, secret?)
        (text(plain, " ", key, to, '"', digest_, '" ', plain), 1),
        (text(plain, " ", key, to, '"', some, '" ', plain), 1),
        (text(plain, " ", key, "=", some, " ", plain), 1),
        (text(plain, " ", plain, " ", one_of("x", ["AKIA", "ghp_", "sk_live_", "AIza", "glpat-"]), mixed.substr(F.lit(1), F.lit(30)), " ", plain), 1),
        (text(plain, " ", key, to, short, " ", plain), 1),
        (text('{"id":', pick("j", 90).cast("string"), ',"', key, '":"', some, '","kind":"', plain, '"}'), 1),
        (text("GET /", word, "?page=2&", key, "=", some, "&", plain, "=1"), 1),
        (text(plain, " Authorization: Bearer ", some, " ", plain), 1),
        (text(plain, " ", other, one_of("b", [" = ", ": ", " is ", " "]), digest_, " ", plain), 0),
        (text(plain, " ", other, to, '"', digest_, '" ', plain), 0),
        (text(plain, " ", one_of("r", ["sha256-", "sha512-", "sha1-", "md5-"]), mixed, " ", plain), 0),
        (text('{"', other, '":"', digest_, '","name":"', word, '"}'), 0),
        (text(plain, " ", one_of("u", ["id", "uuid", "request", "of"]), one_of("b", [" ", ": ", "="]), uuid, " ", plain), 0),
        (text(plain, " ", plain, " ", word, pick("d", 100).cast("string"), " ", plain), 0),
        (text(plain, " ", plain, " ", number.substr(F.lit(1), pick("k", 16) + 13), " ", plain), 0),
        (text(plain, " ", one_of("n", ["phone", "order", "account", "total", "no"]), ": ", number.substr(F.lit(1), pick("k", 16) + 13), " ", plain), 0),
        (text(plain, " https://www.example.com/", word, "/", hexes.substr(F.lit(1), F.lit(12)), ".html ", plain), 0),
        (text(plain, " ", one_of("g", ["path", "file", "in"]), one_of("b", [" ", ": ", "="]), "/home/", word, "/file", pick("f", 1000).cast("string"), ".json ", plain), 0),
        (text(plain, " ", key, to, '"', one_of("y", ["your_api_key_here_0000", "xxxxxxxxxxxxxxxxxxxx1", "example-token-value-1234", "changeme_password_123", "abc1234abc1234abc1234", "test_secret_key_000000", "<password>", "********", "password", "changeme", "your-token-here"]), '" ', plain), 0),
        (text(plain, " ", key, to, one_of("z", ["required", "missing", "invalid", "expired", "string", "optional", "getenv", "default", "disabled", "process.env.TOKEN", "self.password"]), " ", plain), 0),
        (text(plain, " user.", pick("e", 100).cast("string"), "@mail", pick("e2", 10).cast("string"), ".example.com ", plain), 0),
        (text(plain, " version-", pick("v", 20).cast("string"), ".", pick("v2", 20).cast("string"), ".0-", word, " ", plain), 0),
    ]
    kind = pick("kind", len(kinds))
    choose = lambda at: F.coalesce(*[F.when(kind == k, x[0] if at == 0 else F.lit(float(x[1]))) for k, x in enumerate(kinds)])
    return spark.range(rows, numPartitions=1).select(choose(0).alias("text"), choose(1).alias("label"))


def fit(findings: DataFrame, trees: int = TREES, depth: int = DEPTH) -> PipelineModel:
    """A random forest over the candidates of labelled lines (text, label), a table of bounded size."""
    found = described(candidates(findings, ["label"])).repartition(1).sortWithinPartitions("label", "before", "name", "bare", "after", "start")
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(found)
    return RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=trees, maxDepth=depth, seed=SEED).fit(rows.select("features", "label"))


def _last_words(text: Column) -> Column:
    return F.substring_index(F.rtrim(F.translate(text, BLANKS, " " * len(BLANKS))), " ", -2)


def _first_word(text: Column) -> Column:
    return F.substring_index(F.ltrim(F.translate(text, BLANKS, " " * len(BLANKS))), " ", 1)


def candidates(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """(kept columns, word, start, end, name, bare, before, after) of every candidate; doc_id is kept unless others are given.

    bare is the value, without the name it is assigned to (name, with all that
    stands between) and without stops at its end.
    """
    keep = ["doc_id"] if keep is None else keep

    def found(x: Column) -> Column:
        matches, gaps = x["m"], x["g"]
        before = lambda i: _last_words(F.concat(F.coalesce(F.get(matches, i - 1), F.lit("")), F.get(gaps, i)))
        return F.transform(matches, lambda m, i: F.struct(i.cast("long").alias("word"), F.length(F.get(gaps, i)).alias("gap"), m.alias("match"), before(i).alias("before"), _first_word(F.get(gaps, i + 1)).alias("after")))

    text = F.coalesce(F.col("text"), F.lit(""))
    both = F.struct(F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)).alias("m"), F.split(text, CANDIDATE, -1).alias("g"))
    read = docs.select(F.struct(*[F.col(c) for c in keep]).alias("own"), F.monotonically_increasing_id().alias("row"), F.transform(F.array(both), found)[0].alias("found"))
    each = read.select("own", "row", F.explode("found").alias("f")).select("own", "row", "f.*")
    so_far = Window.partitionBy("row").orderBy("word")
    placed = each.withColumn("end", F.sum((F.col("gap") + F.length("match")).cast("long")).over(so_far))
    assigned = f"^({NAME})({VALUE})$"
    value = F.when(F.col("match").rlike(f"^(?:{PREFIX})$"), F.col("match")).when(F.col("match").rlike(assigned), F.regexp_extract("match", assigned, 2)).otherwise(F.col("match"))
    named = placed.withColumn("value", value).withColumn("name", F.left("match", F.length("match") - F.length("value")))
    named = named.withColumns({"start": F.col("end") - F.length("value"), "bare": F.regexp_replace("value", TAIL, "")})
    wanted = F.col("name").rlike(CUE) | F.col("value").rlike(MIXED) | F.col("value").rlike(PREFIX)
    out = named.where(wanted & (F.length("bare") >= 6))
    return out.select("own.*", "word", "start", (F.col("start") + F.length("bare")).alias("end"), "name", "bare", "before", "after")


def scan(docs: DataFrame, findings: DataFrame | None = None, least: float = 0.5) -> DataFrame:
    """(doc_id, word, start, end, value_sha256, score) of candidates that the forest takes for secrets."""
    model = fit(findings if findings is not None else labelled_findings(docs.sparkSession))
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(described(candidates(narrow)))
    scored = model.transform(rows).withColumn("score", F.round(vector_to_array("probability")[1], 6))
    return scored.where(F.col("score") >= least).select("doc_id", "word", "start", "end", F.sha2("bare", 256).alias("value_sha256"), "score")
