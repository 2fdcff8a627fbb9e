"""Secret scans: candidates judged by a random forest, in DataFrame functions only.

A candidate is a long run of key characters with a figure in it, or a shorter one that is assigned
to a name that announces a secret; a word of minified JSON or a query string may hold several. What
a scan of shapes alone reports is mostly not a secret: numbers, addresses, file names, hashes in
prose. A forest trained
on labelled findings sorts them out by length, transitions between kinds of characters, how much
of the candidate is made of dictionary words, its path, and the words beside it. The dictionary
is the corpus' own: words of letters in at least ``MIN_DOCS`` documents.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relocate.llm.common import sample_class, whole, words
from relocate.session import settle

MIN_LENGTH = 16
#: Least length of a value that an announcing name is given.
MIN_ASSIGNED = 8
#: Labelled findings of each class that training reads, by the hash of their text and place.
SAMPLE_FINDINGS = 10_000
TREES, DEPTH, SEED = 40, 8, 42
THRESHOLD = 0.5
#: A run of letters is a dictionary word when so many documents have it.
MIN_DOCS = 3
WORD_LETTERS = (3, 16)

#: Words that announce a secret, and words that take one back.
ANNOUNCES = r"(?i)(pass(word|wd|phrase)?|pwd|token|secret|api[_-]?key|access[_-]?key|auth|bearer|credential)"
TAKES_BACK = r"(?i)(example|sample|dummy|test|fake|placeholder|changeme|xxxx)"
EDGES = " \t\n\x0b\x0c\r.,;:!?()[]{}<>"
CANDIDATE = f"(?=[A-Za-z0-9+/_.-]*[0-9])[A-Za-z0-9+/_.-]{{{MIN_LENGTH},}}"
#: What stands between names and values inside a word.
BETWEEN = r"[\"'=:?;,{}()<>\[\]|]+|&(?=[A-Za-z0-9_-]+=)"
NAMED = ANNOUNCES + "[A-Za-z0-9_-]*"
#: Formats that public services give their keys.
KEY_FORMATS = r"^(AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[0-9A-Za-z]{36}$|^xox[abprs]-[0-9A-Za-z-]{10,}$|^sk_live_[0-9A-Za-z]{16,}$"
PLACE = ["doc_id", "row", "position", "part"]
FEATURES = [
    "length", "figures", "upper", "lower", "hex_only", "figures_only", "upper_only", "transitions", "letter_runs",
    "dots", "slashes", "equals", "quotes", "distinct", "dictionary", "announced_in", "announced_before",
    "announced_after", "assigned", "taken_back", "path_depth", "path_test", "before_length", "after_length",
]


def _given(before_2: Column, before: Column) -> Column:
    """Whether the words before give a value: a name and ``=`` or ``:``, or the word bearer."""
    said = F.concat_ws(" ", before_2, before)
    return said.rlike(NAMED + "[\"']? ?(=>|:=|[=:])[\"']?$") | before.rlike("(?i)^bearer$")


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """``doc_id, row, position, part, finding, name, before_2, before, after, path``: one row per candidate.

    ``position`` counts words from 0, ``part`` the pieces of a word between quotes, ``=``, ``:`` and
    the like; ``name`` is the piece before. Texts are read whole; null texts have none.
    """
    body = F.col(text)
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        F.xxhash64(whole(text)).alias("row"),
        whole(path).alias("path"),
        words(body).alias("_words"),
    )

    def looks(w: Column, i: Column) -> Column:
        long = (F.length(w) >= MIN_LENGTH) & w.rlike(CANDIDATE)
        sign = w.rlike("[=:]") & w.rlike(NAMED + "[\"']?[=:]")
        after = F.get("_words", i - 1).rlike("(?i)([=:][\"']?|^bearer)$")
        short = (F.length(w) >= MIN_ASSIGNED) & w.rlike("[0-9]") & (sign | F.coalesce(after, F.lit(False)))
        return long | short

    found = F.filter(
        F.transform("_words", lambda w, i: F.when(looks(w, i), i)), lambda i: i.isNotNull()
    )
    # Of texts without a candidate no word goes on.
    placed = rows.withColumn("_found", found).filter(F.size("_found") > 0)
    beside = lambda step: F.coalesce(F.get("_words", F.col("position") + step), F.lit(""))
    cut = placed.select("doc_id", "row", "path", "_words", F.explode("_found").alias("position")).select(
        "doc_id",
        "row",
        "position",
        F.split(F.get("_words", "position"), BETWEEN).alias("_parts"),
        beside(-1).alias("before"),
        beside(-2).alias("before_2"),
        beside(1).alias("after"),
        "path",
    )
    pieces = cut.select("*", F.posexplode("_parts").alias("part", "_piece"))
    named = F.when(F.col("part") > 0, F.get("_parts", F.col("part") - 1)).otherwise("")
    pieces = pieces.withColumns({"name": named, "finding": F.btrim("_piece", F.lit(EDGES))})
    first = F.size(F.filter(F.slice("_parts", F.lit(1), F.col("part")), lambda x: x != "")) == 0
    given = F.col("name").rlike(NAMED + "$") | (first & _given(F.col("before_2"), F.col("before")))
    pieces = pieces.withColumn("given", given)
    long = (F.length("finding") >= MIN_LENGTH) & F.col("finding").rlike(CANDIDATE)
    short = (F.length("finding") >= MIN_ASSIGNED) & F.col("finding").rlike("[0-9]") & F.col("given")
    return pieces.filter(long | short).drop("_parts", "_piece")


def _letter_runs(finding: Column) -> Column:
    low, high = WORD_LETTERS
    return F.array_distinct(F.regexp_extract_all(F.lower(finding), F.lit(f"([a-z]{{{low},{high}}})"), F.lit(1)))


def dictionary(docs: DataFrame, wanted: DataFrame, text: str = "text") -> DataFrame:
    """``run``: which of the wanted runs of letters are words of at least ``MIN_DOCS`` documents.

    Words are folded in each task before they meet, and only distinct words travel.
    """
    low, high = WORD_LETTERS
    plain = F.transform(words(F.lower(F.col(text))), lambda w: F.btrim(w, F.lit(EDGES)))
    is_word = lambda w: F.length(w).between(low, high) & w.rlike("^[a-z]+$")
    counted = (
        docs.select(F.explode(F.array_distinct(F.filter(plain, is_word))).alias("run"))
        .groupBy("run")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= MIN_DOCS)
    )
    return counted.join(wanted, "run", "left_semi").select("run")


def _share(text: Column, characters: str) -> Column:
    return F.regexp_count(text, F.lit(f"[{characters}]")) / F.greatest(F.length(text), F.lit(1))


def featured(docs: DataFrame, found: DataFrame, text: str = "text") -> DataFrame:
    """Candidates with the numbers the forest reads."""
    runs = found.select(F.explode(_letter_runs(F.col("finding"))).alias("run")).distinct()
    known = dictionary(docs, runs, text)
    covered = (
        found.distinct()
        .select(*PLACE, F.explode(_letter_runs(F.col("finding"))).alias("run"))
        .join(known, "run")
        .groupBy(*[F.col(c).alias(f"_{c}") for c in PLACE])
        .agg(F.sum(F.length("run")).alias("_covered"))
    )
    same = F.lit(True)
    for c in PLACE:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    rows = found.distinct().join(covered, same, "left").drop(*[f"_{c}" for c in PLACE])
    f, length = F.col("finding"), F.greatest(F.length("finding"), F.lit(1)).cast("double")
    beside = F.concat_ws(" ", "before_2", "before")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(f, "[0-9]+", "9"), "[A-Z]+", "A"), "[a-z]+", "a")
    numbers = {
        "length": length,
        "figures": _share(f, "0-9"),
        "upper": _share(f, "A-Z"),
        "lower": _share(f, "a-z"),
        "hex_only": f.rlike("^[\"']?[0-9a-f]+[\"']?$"),
        "figures_only": f.rlike("^[0-9.+-]+$"),
        "upper_only": f.rlike("^[0-9A-Z]+$"),
        "transitions": F.length(kinds) / length,
        "letter_runs": F.size(_letter_runs(f)),
        "dots": F.regexp_count(f, F.lit("[.]")),
        "slashes": F.regexp_count(f, F.lit("/")),
        "equals": F.regexp_count(f, F.lit("=")),
        "quotes": F.regexp_count(f, F.lit("[\"']")),
        "distinct": F.size(F.array_distinct(F.split(f, ""))) / length,
        "dictionary": F.coalesce("_covered", F.lit(0)) / length,
        "announced_in": F.concat_ws(" ", "name", f).rlike(ANNOUNCES),
        "announced_before": beside.rlike(ANNOUNCES),
        "announced_after": F.col("after").rlike(ANNOUNCES),
        "assigned": F.col("given"),
        "taken_back": F.concat_ws(" ", beside, "name", f, "after").rlike(TAKES_BACK),
        "path_depth": F.size(F.split("path", "/")),
        "path_test": F.col("path").rlike(TAKES_BACK),
        "before_length": F.length("before"),
        "after_length": F.length("after"),
    }
    return rows.select("*", *[c.cast("double").alias(n) for n, c in numbers.items()]).drop("_covered")


def train(labelled: DataFrame, label: str = "label") -> RandomForestClassificationModel | None:
    """A forest from findings with their features and a 0/1 label; None without both classes."""
    order = [F.xxhash64("finding"), *PLACE]
    halves = [labelled.filter(F.col(label) == v).orderBy(*order).limit(SAMPLE_FINDINGS) for v in (0, 1)]
    both = halves[0].unionByName(halves[1])
    sample = settle(both.select(*FEATURES, F.col(label).cast("double").alias("label")), "findings")
    if sample.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(
        featuresCol="features",
        labelCol="label",
        numTrees=TREES,
        maxDepth=DEPTH,
        seed=SEED,
        featureSubsetStrategy="sqrt",
    )
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample)
    return forest.fit(vectors.select("features", "label"))


def judge(found: DataFrame, model: RandomForestClassificationModel | None, threshold: float = THRESHOLD) -> DataFrame:
    """Findings with ``score`` and ``secret``; without a model every candidate stays a finding."""
    if model is None:
        return found.withColumns({"score": F.lit(1.0), "secret": F.lit(True)})
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found)
    scored = model.transform(vectors).withColumn("score", vector_to_array("probability")[1])
    scored = scored.withColumn("secret", F.col("score") >= threshold)
    return scored.drop("features", "rawPrediction", "probability", "prediction")


def format_label() -> Column:
    """Labels for findings without a reviewer, null where nothing is proof.

    1 for the key formats of public services and for values given to a name that announces a
    secret; 0 where a word takes it back, and where no word beside it announces a secret.
    """
    proof = F.col("finding").rlike(KEY_FORMATS) | F.col("given")
    told = F.concat_ws(" ", "before_2", "before", "name", "finding", "after")
    return F.when(told.rlike(TAKES_BACK), 0).when(proof, 1).when(~told.rlike(ANNOUNCES), 0)


def scan(
    docs: DataFrame,
    labelled: DataFrame | None = None,
    key: str = "doc_id",
    text: str = "text",
    path: str = "source",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Every candidate of every document with its features, ``score`` and ``secret``.

    ``labelled`` has ``doc_id, position, label``; a label holds for all pieces of its word. Without it, candidates of documents outside
    fold 1 (crc32 of the id as text, modulo 3) are labelled by :func:`format_label`. Documents
    without candidates have no row. Rows that repeat id and text are one document.
    """
    docs = docs.select(*dict.fromkeys([key, text, path]))
    found = settle(candidates(docs, key, text, path), "candidates")
    found = settle(featured(docs, found, text), "features")
    if labelled is None:
        known = found.withColumn("label", format_label()).filter(sample_class(F.col("doc_id")) != 1)
        known = known.filter(F.col("label").isNotNull())
    else:
        reviewed = labelled.groupBy("doc_id", "position").agg(F.max("label").alias("label"))
        known = found.join(reviewed, ["doc_id", "position"])
    return judge(found, train(known), threshold)
