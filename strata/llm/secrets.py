"""Secret scanning with a random forest that removes false positives.

A pattern finds strings that could be secrets. A random forest judges each by its
length, its characters and their transitions, how much of it a dictionary covers,
the path it stands under and the words around it. The forest is trained on labelled
findings. Everything runs as DataFrame functions; no Python runs in tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.sources import layer_path, scratch_dir, write_layer

_CHARS = "[A-Za-z0-9+/_-]"
# Words that name a secret.
NAMING = "secret|token|key|passw|pwd|auth|credential|bearer"
#: A secret's name and the sign that gives it a value.
NAMED = rf"(?i:{NAMING})[A-Za-z0-9_-]{{0,20}}[\"'`]?\s{{0,3}}[=:]\s{{0,3}}[\"'`]?"
_VALUE = r"[^\s\"'`,;<>(){}\[\]]{8,200}"
_PADDING = r"(?:={1,2}(?=[\"'`]?(?:[\s,;)\]}]|\z)))?+"
#: Values of 8 characters and more behind a secret's name; elsewhere strings of 16 characters
#: with a digit and a letter, or of 20 of any kind, that are not names of something themselves.
CANDIDATE = (
    rf"{NAMED}{_VALUE}|(?<!{_CHARS})(?:"
    rf"(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z]){_CHARS}{{16,}}+{_PADDING}(?![\"'`]?\s{{0,3}}=\s{{0,3}}\S)"
    rf"|{_CHARS}{{20,}}+{_PADDING}(?![\"'`]?\s{{0,3}}[=:]\s{{0,3}}\S))"
)
_CHANGE = (
    "(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])|(?<=[^A-Za-z0-9])(?=[A-Za-z0-9])"
)
# Words that name other long strings, words of code and prose that a dictionary
# covers, parts of paths where findings are seldom real, and texts that hold a secret's place.
OTHER_NAMES = "commit|sha|md5|hash|uuid|guid|checksum|digest|revision|etag|build"
DICTIONARY = (
    "about|after|again|also|before|build|change|check|class|client|close|code|config|content|count|data|date"
    "|default|display|document|example|false|field|file|first|format|from|function|group|handler|have|header"
    "|image|import|index|info|input|item|label|language|length|line|link|list|local|message|method|model|name"
    "|number|object|option|order|other|output|page|param|path|place|print|process|public|query|read|report"
    "|request|result|return|sample|search|select|server|service|session|source|start|state|string|style|system"
    "|table|test|text|that|this|time|title|true|type|update|user|value|version|view|with|word|write|your"
)
UNLIKELY_PATHS = "test|example|sample|mock|fixture|doc"
PLACEHOLDERS = "your|changeme|example|placeholder|dummy|insert|xxx|\\\\*\\\\*|\\\\.\\\\.\\\\.|\\\\$|%|todo|none|null|undefined"

CONTEXT = 40  # characters looked at before and after a finding


@dataclass(frozen=True)
class SecretRule:
    """Trees of the forest, the verdict's threshold, and the bound of its training sample.

    ``labelled`` findings of either label at most are used, those of least hash.
    """

    trees: int = 40
    depth: int = 6
    threshold: float = 0.5
    labelled: int = 2_000
    seed: int = 7


def find_candidates(docs: DataFrame, path: str = "source") -> DataFrame:
    """(doc_id, path, start, candidate, before, after) of every candidate, in code points.

    A name that gives a candidate its value is no part of it but of ``before``. The text between candidates is cut up once, and places are running sums of the
    pieces' lengths, so that long texts with many candidates cost no more than
    their length. Null and empty texts have no candidates; repeated rows have
    theirs each. A null path is empty. Other columns are ignored.
    """
    text = F.col("text").cast("string")
    held = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"),
        text.alias("text"),
    ).where(F.col("text").rlike(CANDIDATE))
    found = F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0))
    between = F.split("text", CANDIDATE, -1)
    name = rf"\A{NAMED}"

    def split(match: Column, piece: Column) -> Column:
        """A match without the name before it, which belongs to the text before."""
        candidate = F.regexp_replace(match, name, "")
        ahead = F.concat(piece, F.left(match, F.length(match) - F.length(candidate)))
        return F.struct(
            candidate.alias("candidate"),
            F.length(ahead).alias("gap"),
            F.right(ahead, F.lit(CONTEXT)).alias("before"),
        )

    pieces = F.zip_with(found, between, split)
    afters = F.transform(between, lambda piece: F.left(piece, F.lit(CONTEXT)))
    rows = (
        held.withColumns({"pieces": pieces, "afters": afters, "row": F.monotonically_increasing_id()})
        .select("doc_id", "path", "row", "afters", F.posexplode("pieces").alias("place", "piece"))
        .where("piece.candidate is not null")
        .select("doc_id", "path", "row", "place", "piece.*", F.get("afters", F.col("place") + 1).alias("after"))
    )
    so_far = Window.partitionBy("row").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    stop = F.sum(F.length("candidate") + F.col("gap")).over(so_far)
    return rows.select(
        "doc_id",
        "path",
        (stop - F.length("candidate")).alias("start"),
        "candidate",
        "before",
        F.coalesce("after", F.lit("")).alias("after"),
    )


def features() -> dict[str, Column]:
    """Numbers that the forest sees, from the columns of ``find_candidates``."""
    candidate = F.col("candidate")
    size = F.length(candidate).cast("double")

    def share(kept: str) -> Column:
        return F.length(F.regexp_replace(candidate, f"[^{kept}]", "")) / size

    chars = F.split(candidate, "")
    counts = F.transform(F.array_distinct(chars), lambda c: size - F.length(F.replace(candidate, c)))
    entropy = F.aggregate(
        counts, F.lit(0.0), lambda total, n: total - F.when(n > 0, n / size * F.log2(n / size)).otherwise(0.0)
    )
    runs = F.transform(F.regexp_extract_all(candidate, F.lit("[A-Za-z]+"), F.lit(0)), F.length)
    covered = F.length(F.regexp_replace(F.lower(candidate), DICTIONARY, ""))

    def says(column: str, pattern: str) -> Column:
        return F.col(column).rlike(pattern).cast("double")

    return {
        "length": size,
        "digits": share("0-9"),
        "upper": share("A-Z"),
        "lower": share("a-z"),
        "hex": share("0-9a-fA-F"),
        "distinct": F.size(F.array_distinct(chars)) / size,
        "changes": F.regexp_count(candidate, F.lit(_CHANGE)) / size,
        "entropy": entropy,
        "longest_word": F.coalesce(F.array_max(runs), F.lit(0)).cast("double"),
        "dictionary": (size - covered) / size,
        "unlikely_path": says("path", f"(?i){UNLIKELY_PATHS}"),
        "named": says("before", f"(?i)(?:{NAMING})\\w*\\W{{0,6}}$"),
        "named_near": says("before", f"(?i){NAMING}"),
        "other_name": says("before", f"(?i)(?:{OTHER_NAMES})\\w*\\W{{0,6}}$"),
        "assigned": says("before", "[=:]\\s*[\"'`]?$"),
        "symbols": share("^A-Za-z0-9"),
        "placeholder": candidate.rlike(f"(?i){PLACEHOLDERS}").cast("double"),
        "quoted": (F.col("before").rlike("[\"'`]$") & F.col("after").rlike("^[\"'`]")).cast("double"),
    }


def train(
    labelled: DataFrame, rule: SecretRule = SecretRule(), folder: str | None = None
) -> PipelineModel | float:
    """A forest from ``find_candidates`` rows with a ``label`` (1 secret, 0 not, null unknown).

    The model is saved below ``folder`` and loaded from there; a model fresh from
    training drags its training table along into every task. With labels of one
    kind only there is nothing to tell apart: the result is then the score that
    every finding gets; without any labels it is 1.
    """
    folder = folder or scratch_dir(labelled.sparkSession)
    kinds = labelled.where("label is not null").dropDuplicates(["candidate", "label"])
    hashed = F.xxhash64("candidate"), F.col("candidate")
    parts = [kinds.where(F.col("label") == k).orderBy(*hashed).limit(rule.labelled) for k in (0, 1)]
    sample = parts[0].union(parts[1]).withColumns(features()).coalesce(1).cache()
    try:
        present = {row["label"] for row in sample.select("label").distinct().collect()}
        if len(present) < 2:
            return float(max(present, default=1))
        gather = VectorAssembler(inputCols=list(features()), outputCol="features")
        forest = RandomForestClassifier(
            numTrees=rule.trees, maxDepth=rule.depth, seed=rule.seed, labelCol="label", featuresCol="features"
        )
        table = gather.transform(sample.withColumn("label", F.col("label").cast("double")))
        path = layer_path(folder, "secrets", "model")
        PipelineModel([gather, forest.fit(table)]).write().overwrite().save(path)
        return PipelineModel.load(path)
    finally:
        sample.unpersist()


def judge(candidates: DataFrame, model: PipelineModel | float, rule: SecretRule = SecretRule()) -> DataFrame:
    """``candidates`` with a score and ``is_secret``."""
    if isinstance(model, float):
        scored = candidates.withColumn("score", F.lit(model))
    else:
        judged = model.transform(candidates.withColumns(features()))
        score = F.get(vector_to_array("probability"), F.lit(1))
        scored = judged.select(*candidates.columns, score.alias("score"))
    return scored.withColumn("is_secret", F.col("score") >= rule.threshold)


def planted_findings(spark: SparkSession, n: int = 8_000, seed: int = 1) -> DataFrame:
    """Labelled candidates from texts in which secrets and look-alikes have been planted.

    What is planted decides the label, not where it stands: secrets are random strings
    of several alphabets and lengths, tokens with a prefix and passwords with signs;
    look-alikes are checksums, UUIDs, identifiers, placeholders, paths and numbers. Most
    secrets follow a name, many do not; look-alikes follow the same names at times.
    """

    def pick(salt: int, choices: list[Column]) -> Column:
        at = F.pmod(F.xxhash64("id", F.lit(salt), F.lit(seed)), F.lit(len(choices)))
        return F.element_at(F.array(*choices), (at + 1).cast("int"))

    def words(*texts: str) -> list[Column]:
        return [F.lit(text) for text in texts]

    def below(salt: int, n: int) -> Column:
        return F.pmod(F.xxhash64("id", F.lit(salt), F.lit(seed)), F.lit(n)).cast("int")

    digest = [F.sha2(F.concat_ws(":", F.lit(f"{seed}.{k}"), "id"), 256) for k in range(3)]
    solid = F.regexp_replace(F.base64(F.unhex(F.concat(digest[0], digest[1]))), "[+/=]", "")
    signs = F.translate(F.substring(solid, 1, 24), "abcdeABCDE012", "!@#$%^&*!?@~.")
    uuid = F.concat_ws("-", *[F.substring(digest[0], a, k) for a, k in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    listed = DICTIONARY.split("|")
    parts = [pick(20 + k, words(*listed)) for k in range(5)]
    secrets = [
        F.substring(digest[0], F.lit(1), pick(2, [F.lit(32), F.lit(40), F.lit(64)])),
        F.substring(solid, F.lit(1), below(3, 30) + 20),
        F.concat(pick(4, words("ghp_", "sk_live_", "xoxb-", "pat-")), F.substring(solid, 1, 36)),
        F.concat(F.lit("AK"), F.upper(F.substring(solid, 1, 18))),
        F.substring(signs, F.lit(1), below(5, 8) + 8),
        F.base64(F.unhex(F.substring(digest[1], F.lit(1), (below(6, 12) + 12) * 2))),
    ]
    look_alikes = [
        F.substring(digest[0], F.lit(1), pick(7, [F.lit(32), F.lit(40), F.lit(64)])),
        uuid,
        F.concat(parts[0], *[F.initcap(p) for p in parts[1:4]], F.when(below(8, 3) == 0, "2").otherwise("")),
        F.concat_ws("_", *parts),
        pick(9, words("your_api_key_here", "changeme123", "${SECRET_TOKEN}", "xxxxxxxxxxxxxxxx", "<insert-password>", "example-password", "%(password)s", "************")),
        F.concat(F.lit("/usr/"), F.concat_ws("/", *parts[:4])),
        F.concat(F.lit("20"), F.conv(F.substring(digest[2], 1, 14), 16, 10)),
    ]
    named = pick(10, words('api_key = "', "password: ", "export AUTH_TOKEN=", 'secret="', "pwd='", "access_token: \"", "client_secret="))
    other = pick(11, words("commit ", "sha256:", "md5 = ", "uuid: ", "build ", "see ", "revision ", "checksum="))
    bare = pick(12, words("", "curl -H ", "use ", "with ", 'x = "', "id: ", "is "))
    is_secret = below(1, 2) == 1
    kind = F.when(is_secret, below(13, len(secrets))).otherwise(below(13, len(look_alikes)))
    value = F.when(is_secret, F.element_at(F.array(*secrets), kind + 1)).otherwise(
        F.element_at(F.array(*look_alikes), F.least(kind, F.lit(len(look_alikes) - 1)) + 1)
    )
    chance = below(14, 100)
    ahead = (
        F.when(is_secret, F.when((chance < 70) | (kind == 4), named).otherwise(bare))
        .when(kind == 4, named)
        .when(kind <= 1, F.when(chance < 75, other).otherwise(bare))
        .otherwise(F.when(chance < 30, named).when(chance < 50, other).otherwise(bare))
    )
    behind = F.when(F.substring(ahead, -1, 1).isin('"', "'"), F.substring(ahead, -1, 1)).otherwise("")
    prose = [F.concat_ws(" ", *[pick(30 + 10 * k + j, words(*listed)) for j in range(5)]) for k in (0, 1)]
    path = F.when(below(15, 100) < F.when(is_secret, 10).otherwise(30), pick(16, words("tests/a", "docs/b"))).otherwise("src/c")
    planted = spark.range(n, numPartitions=1).select(
        F.col("id").alias("doc_id"),
        F.concat(prose[0], F.lit(" "), ahead, value, behind, F.lit(" "), prose[1]).alias("text"),
        path.alias("path"),
        is_secret.cast("int").alias("label"),
    )
    labels = planted.select("doc_id", "label")
    return find_candidates(planted, "path").join(labels, "doc_id")


def scan_secrets(
    docs: DataFrame,
    labelled: DataFrame | None = None,
    rule: SecretRule = SecretRule(),
    path: str = "source",
    folder: str | None = None,
) -> DataFrame:
    """Every candidate of every text with the forest's score and verdict.

    Without labelled findings, those of ``planted_findings`` are used.
    The candidates are stored, so that texts are searched once.
    """
    folder = folder or scratch_dir(docs.sparkSession)
    candidates = write_layer(find_candidates(docs, path), layer_path(folder, "secrets", "candidates")).frame
    model = train(planted_findings(docs.sparkSession) if labelled is None else labelled, rule, folder)
    return judge(candidates, model, rule)
