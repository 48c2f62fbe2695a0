"""Secret scan: credential-shaped strings, with false positives removed by a random forest. DataFrame operations only.

Candidates are runs of at least ``SHORTEST`` letters, digits and ``_+/-`` with a digit in them. Features: length, shares of
digits and capitals, changes between kinds of characters, distinct characters, the share covered by dictionary words
(of a public vocabulary), path marks, a known issuer's prefix, and what stands next to the candidate.

The forest is trained on labelled findings: ``GENERATED`` generated ones (random keys after credential words or with
an issuer's prefix are secrets; checksums, commit and record ids, paths, names, numbers are not), and at most ``FOUND``
candidates of the corpus that an explicit assignment to a credential word, or being a plain number, labels.

Null, empty and candidate-free texts have no findings. Repeated rows have findings each. ``start`` counts code points. Other
columns are kept by ``redacted`` and ignored by ``scan``. An empty table gives no rows.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.llm.common import saved, table

SHORTEST = 12
GENERATED = 4_000
FOUND = 2_000
TREES = 20
DEPTH = 7
THRESHOLD = 0.5
MASK = "[SECRET]"
AROUND = 32  # characters beside a candidate that count as neighbours

_RUN = r"A-Za-z0-9_+/\-"
CANDIDATE = rf"(?<![{_RUN}])(?=[A-Za-z_+/\-]*[0-9])[{_RUN}]{{{SHORTEST},}}={{0,2}}"
# Words that name a credential, words that name a harmless identifier, prefixes that issuers put on keys.
CREDENTIAL = r"(?:token|secret|passw(?:or)?d|passwd|pwd|api[_-]?key|apikey|access[_-]?key|private[_-]?key|auth|bearer|credential)"
HARMLESS = r"(?:commit|sha|md5|checksum|etag|digest|uuid|guid|revision|build|version|isbn|order|invoice|ticket|http|www|src|path|file|image)"
PREFIX = r"^(?:AKIA|ASIA|ghp_|gho_|ghs_|github_pat_|glpat-|xox[abp]-|sk_live_|rk_live_|AIza|SG\.|npm_)"

FEATURES = (
    "size", "digits", "capitals", "changes", "distinct", "covered", "slashes", "dashes", "hex", "prefix",
    "assigned", "credential", "harmless", "quoted", "in_path",
)


def candidates(documents: DataFrame) -> DataFrame:
    """doc_id, text_hash, nth, start, candidate, and the text before and after."""
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where(F.col("text").rlike(CANDIDATE))
    # Cutting the text at its candidates gives what stands between them: the two lists line up.
    cut = rows.select(
        "doc_id", F.md5("text").alias("text_hash"), F.monotonically_increasing_id().alias("row"),
        F.split("text", CANDIDATE, -1).alias("gaps"),
        F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("found"),
    )
    steps = F.transform("found", lambda x, i: F.struct(
        i.alias("nth"), x.alias("candidate"),
        F.right(F.element_at("gaps", i + 1), F.lit(AROUND)).alias("before"),
        F.left(F.element_at("gaps", i + 2), F.lit(AROUND)).alias("after"),
        F.length(F.element_at("gaps", i + 1)).alias("gap"),
    ))
    listed = cut.select("doc_id", "text_hash", "row", F.explode(steps).alias("s"))
    listed = listed.select("doc_id", "text_hash", "row", "s.*")
    so_far = Window.partitionBy("row").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("candidate")).over(so_far)
    return listed.withColumn("start", end - F.length("candidate")).drop("row", "gap")


def features(findings: DataFrame, words: DataFrame) -> DataFrame:
    """Findings with their features; ``findings`` needs candidate, before and after."""
    c, before, after = F.col("candidate"), F.col("before"), F.col("after")
    size = F.length(c)
    changes = r"[a-z](?=[A-Z0-9])|[A-Z](?=[a-z0-9])|[0-9](?=[A-Za-z])"
    near = F.lower(F.concat(before, F.lit(" ")))
    flags = {
        "size": size, "digits": F.regexp_count(c, F.lit("[0-9]")) / size, "capitals": F.regexp_count(c, F.lit("[A-Z]")) / size,
        "changes": F.regexp_count(c, F.lit(changes)) / size, "distinct": F.size(F.array_distinct(F.split(c, ""))) / size,
        "slashes": F.regexp_count(c, F.lit("/")), "dashes": F.regexp_count(c, F.lit("[-_]")),
        "hex": c.rlike("^[0-9a-f]+$"), "prefix": c.rlike(PREFIX),
        "assigned": near.rlike(rf"{CREDENTIAL}[\"']?\s*(?:[=:]|=>|is)\s*[\"']?\s*$"),
        "credential": near.rlike(CREDENTIAL), "harmless": near.rlike(HARMLESS),
        "quoted": before.rlike("[\"'`]$") & after.rlike("^[\"'`]"),
        "in_path": before.rlike(r"[/.@]$") | after.rlike(r"^[.@/][A-Za-z]"),
    }
    flagged = findings.withColumns({k: v.cast("double") for k, v in flags.items()})
    # Letter runs of distinct candidates, looked up in the dictionary.
    distinct = flagged.select("candidate").distinct()
    runs = distinct.select("candidate", F.explode(F.regexp_extract_all(F.lower("candidate"), F.lit("[a-z]{3,}"), F.lit(0))).alias("word"))
    covered = runs.join(words, "word").groupBy("candidate").agg(F.sum(F.length("word")).alias("letters"))
    joined = flagged.join(covered, "candidate", "left")
    return joined.withColumn("covered", F.coalesce(F.col("letters"), F.lit(0)) / F.length("candidate")).drop("letters")


def dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Whole words of a public vocabulary: a fixed list of less than 50,000 words."""
    with open(path, encoding="utf-8") as file:
        names = json.load(file)["model"]["vocab"]
    words = sorted({n.removesuffix("</w>") for n in names if n.endswith("</w>") and n.removesuffix("</w>").isalpha()})
    rows = [(w,) for w in words if w.isascii() and len(w) >= 3]
    return spark.createDataFrame(rows, "word string")


def _generated(spark: SparkSession, n: int) -> DataFrame:
    """Labelled findings made of hashes of their numbers."""
    i = F.col("id")

    def digest(salt: str) -> Column:
        return F.sha2(F.concat(F.lit(salt), i.cast("string")), 256)

    def pick(values: tuple[str, ...], salt: str) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), F.pmod(F.xxhash64(F.lit(salt), i), F.lit(len(values))).cast("int") + 1)

    # Base64 of the digest has small and capital letters and digits.
    dense = F.regexp_replace(F.base64(F.unhex(digest("d"))), "[+/=]", "")
    loud = F.translate(F.upper(dense), "0189", "QWZX")
    size = (F.pmod(F.xxhash64(F.lit("n"), i), F.lit(25)) + 16).cast("int")
    prose = pick(("and then we saw ", "the next one was ", "le texte de ", "in the file, ", "der die das ", "see also: "), "p")
    names = ("token", "password", "secret", "api_key", "apikey", "access_key", "auth_token", "passwd", "client_secret")
    assign = F.concat(prose, pick(names, "k"), pick(("=", " = \"", ": ", ": \"", "='"), "a"))
    quote = F.when(assign.endswith('"'), '" and').when(assign.endswith("'"), "' and").otherwise(" and")
    harmless = F.concat(prose, pick(("commit ", "sha1 ", "md5: ", "checksum=", "etag: \"", "revision ", "build ", "uuid "), "h"))
    number = F.lpad(F.abs(F.xxhash64(F.lit("u"), i)).cast("string"), 16, "4")
    word = pick(("report", "holiday", "meeting", "version", "picture", "chapter", "release", "library"), "w")
    other = pick(("final", "summer", "draft", "family", "index", "backup", "notes", "public"), "o")
    year = (F.pmod(i, F.lit(40)) + 1985).cast("string")
    uuid = F.regexp_replace(F.left(digest("g"), F.lit(32)), "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-")
    kinds = (
        (1, assign, F.substr(digest("x"), F.lit(1), size), quote),
        (1, assign, F.substr(F.concat(dense, digest("y")), F.lit(1), size), quote),
        (1, prose, F.concat(F.lit("AKIA"), F.left(F.concat(loud, F.upper(digest("z"))), F.lit(16))), F.lit(" and")),
        (1, prose, F.concat(F.lit("ghp_"), F.left(dense, F.lit(36))), F.lit(" and")),
        (1, prose, F.concat(F.lit("sk_live_"), F.left(dense, F.lit(24))), F.lit(" and")),
        (0, harmless, F.substr(digest("c"), F.lit(1), F.lit(40)), F.lit(" and")),
        (0, harmless, F.substr(digest("m"), F.lit(1), F.lit(32)), F.lit(" and")),
        (0, prose, uuid, F.lit(" and")),
        (0, prose, number, F.lit(" and")),
        (0, prose, F.concat(word, F.lit("-"), other, F.lit("-"), year), F.lit(".pdf and")),
        (0, F.concat(prose, F.lit("https://example.com/")), F.concat(word, F.lit("/"), other, F.lit("/"), number), F.lit(".html")),
        (0, prose, F.concat(F.initcap(word), F.initcap(other), year), F.lit(" and")),
        (0, F.concat(prose, F.lit("order ")), F.concat(F.lit("ORD-"), number), F.lit(" and")),
    )
    # One range for all kinds: a union would repeat every later step, its expressions and its generated code, per kind.
    each = -(-n // len(kinds))
    rows = spark.range(0, each * len(kinds), 1, spark.sparkContext.defaultParallelism * len(kinds))
    rows = rows.select((F.col("id") / each).cast("int").alias("kind"), (F.col("id") % each).alias("id"))

    def of_kind(values: list[Column]) -> Column:
        return reduce(lambda chain, kv: chain.when(F.col("kind") == kv[0], kv[1]), enumerate(values), F)

    labels, before, candidate, after = zip(*((F.lit(float(label)), b, value, a) for label, b, value, a in kinds), strict=True)
    return rows.select(
        of_kind(labels).alias("label"), of_kind(candidate).alias("candidate"),
        F.right(of_kind(before), F.lit(AROUND)).alias("before"), of_kind(after).alias("after"),
    )


def _weakly_labelled(findings: DataFrame, limit: int) -> DataFrame:
    """Candidates of the corpus that their form and neighbours label."""
    near = F.lower(F.col("before"))
    given = near.rlike(rf"{CREDENTIAL}\s*[=:]\s*[\"']?$") & F.col("candidate").rlike("[a-z]")
    plain = F.col("candidate").rlike("^[0-9]+$") & ~near.rlike(CREDENTIAL)
    rows = findings.withColumn("label", F.when(given, 1.0).when(plain, 0.0)).where("label IS NOT NULL")
    rows = rows.select("label", "candidate", "before", "after").distinct()
    return rows.orderBy(F.xxhash64("candidate", "before"), "candidate", "before", "after").limit(limit)


def _vectors(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)


def fit(findings: DataFrame, words: DataFrame) -> RandomForestClassificationModel:
    spark = findings.sparkSession
    examples = _generated(spark, GENERATED).unionByName(_weakly_labelled(findings, FOUND))
    ready = saved(features(examples, words).select("label", *FEATURES), "examples")
    # The fitted model's training summary refers to the session, which tasks cannot take along once anything in the
    # session has used an ``Observation``; a copy has the trees alone.
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=7).fit(_vectors(ready)).copy()


def scan(documents: DataFrame, words: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Every candidate of every row, with the probability that it is a secret."""
    findings = saved(candidates(documents), "findings")
    model = fit(findings, words)
    scored = model.transform(_vectors(features(findings, words)))
    probability = vector_to_array("probability")[1]
    return scored.select(
        "doc_id", "text_hash", "nth", "start", F.length("candidate").alias("length"),
        probability.alias("probability"), (probability >= threshold).alias("is_secret"), "candidate",
    )


def redacted(documents: DataFrame, words: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The same rows and columns, with every secret in ``text`` replaced by ``MASK``."""
    found = scan(documents, words, threshold).groupBy("doc_id", "text_hash", "nth").agg(F.max("is_secret").alias("is_secret"))
    # One list per text that has a secret, as long as the text has candidates. Names of its own, whatever the rows have.
    flags = found.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_list(F.struct("nth", "is_secret"))).alias("__flags"))
    flags = flags.where(F.exists("__flags", lambda f: f["is_secret"])).select(
        F.col("doc_id").alias("__own_id"), F.col("text_hash").alias("__text_hash"), "__flags"
    )
    suspect = F.coalesce(F.col("text").rlike(CANDIDATE), F.lit(False))
    listed = documents.where(suspect)
    same = listed["doc_id"].cast("long").eqNullSafe(F.col("__own_id")) & (F.md5(listed["text"]) == F.col("__text_hash"))
    joined = listed.join(flags, same, "left")
    found_here = F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0))
    masked = F.zip_with(found_here, F.col("__flags"), lambda c, f: F.when(f["is_secret"], F.lit(MASK)).otherwise(c))
    pieces = F.zip_with(F.split("text", CANDIDATE, -1), masked, lambda gap, c: F.concat(gap, F.coalesce(c, F.lit(""))))
    text = F.when(F.col("__flags").isNotNull(), F.array_join(pieces, "")).otherwise(F.col("text"))
    columns = [text.alias("text") if c == "text" else F.col(f"`{c}`") for c in documents.columns]
    return documents.where(~suspect).unionByName(joined.select(*columns))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    words = dictionary(spark, public_tokenizers.path("word_bpe_49k.json"))
    found = scan(table(spark, sf_dir, "documents"), words)
    return found.select("doc_id", "nth", "start", "length", "probability", "is_secret")
