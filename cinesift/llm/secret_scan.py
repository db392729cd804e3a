"""Secret scan: candidate strings, and a random forest that removes false positives.

Candidates are runs of key characters that look like no plain word, and whatever is assigned to a
name of a credential, of any length and characters. Each is described by its
length, the transitions between its characters, how far a dictionary of the corpus covers it,
its path and its neighbouring words; a random forest (Spark ML) trained from labelled findings
scores it. Only DataFrame functions and Spark ML's JVM code run on the executors.

The dictionary is taken from the corpus itself: letter triples of words that a share of
``DICTIONARY_SHARE`` of all documents hold, and how often a letter follows another there.

Where no findings were labelled by hand, :func:`labelled_by_rule` labels those that a strict
rule settles (issued key formats, credentials assigned by name; on the other side numbers, plain
words, UUIDs, named checksums and paths). A forest that sees what the rule goes by would
only repeat the rule, so every such finding is learnt twice, once with that ``EVIDENCE`` hidden: from
the hidden copies the forest learns what a secret looks like by length, characters, dictionary, path
and neighbours, which is all it has for findings that no rule settles.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinesift.llm.common import written

LEAST_LENGTH = 12
PLAIN_LENGTH = 20
DICTIONARY_SHARE = 0.001
TRAINING_FINDINGS = 20_000
THRESHOLD = 0.5
_RUN = f"([A-Za-z0-9+/_-]{{{LEAST_LENGTH},}}={{0,2}})"
_CREDENTIAL = r"(?i)(pass(word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credential|private[_-]?key)"
_VALUE = (r"(?is)^.*?(?:pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|auth(?!or)|credential|"
          r"private[_-]?key)[\w.-]*[\"'`\])]*\s*[:=]{1,3}+>?+\s*([^\s:=>]\S*)$")
_HARMLESS = r"(?i)\b(example|sample|dummy|placeholder|test|fake|checksum|sha1|sha256|md5|commit|uuid|digest)\b"
_ISSUED = r"^(AKIA[0-9A-Z]{16}|ASIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36,}|xox[abprs]-[0-9A-Za-z-]{10,}|sk_live_[0-9A-Za-z]{16,}|AIza[0-9A-Za-z_-]{35})$"

FEATURES = (
    "length", "distinct_share", "class_changes", "digit_share", "upper_share", "symbol_share", "odd_pairs",
    "pair_surprise", "dictionary_cover", "issued_format", "path_depth", "path_harmless", "path_config",
    "named_credential", "assigned", "quoted", "harmless_word", "plain_before", "plain_after",
)
# What labelled_by_rule goes by.
EVIDENCE = ("issued_format", "named_credential", "assigned", "quoted", "harmless_word")


def _flagged(run: Column) -> Column:
    return run.rlike("[0-9]|.[A-Z]") | (F.length(run) >= PLAIN_LENGTH)


def _slim(docs: DataFrame, path: str) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(path).cast("string").alias("path"),
        F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), r"\s+").alias("words"))


def _assigned(docs: DataFrame, path: str) -> DataFrame:
    """As :func:`candidates`, the values assigned to a credential's name that are no such run.

    A value ends with its quote, however far that is, or else at white space."""
    words = F.col("words")

    def quoted_from(value: Column, i: Column) -> Column:
        """What stands between the quote that opens ``value`` and the next one of its kind."""
        rest = F.concat_ws(" ", F.substring(value, 2, 2**31 - 1), F.slice(words, i + 2, F.greatest(F.size(words), F.lit(1))))
        mark = F.substring(value, 1, 1)
        end = F.position(mark, rest)
        return F.when(value.rlike("^[\"'`]"), F.when(end > 0, F.substring(rest, F.lit(1), end - 1)))

    before = lambda i: F.concat_ws(" ", F.get(words, i - 2), F.get(words, i - 1))
    near = F.filter(
        F.transform(words, lambda w, i: F.struct(i.alias("i"), w.alias("w"))),
        lambda x: x["w"].rlike("[:=]") | F.get(words, x["i"] - 1).rlike("[:=]>?$"))
    near = F.transform(near, lambda x: F.struct(
        x["i"].alias("i"), x["w"].alias("w"), before(x["i"]).alias("before"),
        F.regexp_extract(F.concat_ws(" ", before(x["i"]), x["w"]), _VALUE, 1).alias("value"),
        F.coalesce(F.get(words, x["i"] + 1), F.lit("")).alias("after")))
    slim = _slim(docs.where(F.col("text").cast("string").rlike(_CREDENTIAL)), path)
    # of the rest of the text only the quoted part is kept
    values = F.transform(F.filter(near, lambda x: x["value"] != ""), lambda x: x.withField("quoted", quoted_from(x["value"], x["i"])))
    found = slim.select("doc_id", "path", F.explode(values).alias("t")).select("doc_id", "path", "t.*")
    bare = F.regexp_replace("value", r"^[\"'`]|[,;]+$", "")
    lead = F.concat(F.expr("left(w, length(w) - length(value))"), F.regexp_extract("value", "^[\"'`]?", 0))
    # a run that is the whole value is a candidate already
    is_run = F.col("candidate").rlike(f"^{_RUN}$") & _flagged(F.col("candidate"))
    return found.withColumn("candidate", F.coalesce("quoted", bare)).where((F.col("candidate") != "") & ~is_run).select(
        "doc_id", "path", F.col("i").cast("long").alias("word"), F.lit(-1).cast("long").alias("run"), "candidate",
        "before", "after", lead.alias("lead"))


def candidates(docs: DataFrame, path: str = "source") -> DataFrame:
    """``(doc_id, path, word, run, candidate, before, after, lead)``: every candidate of every row.

    ``word`` is the place of its word in the text and ``run`` its place in the word; ``lead`` is
    what stands before it in the word. A run is a candidate if it holds a digit or a capital
    behind its first letter, or is too long for a word. So is the whole value assigned to a
    credential's name, whatever it holds; ``run`` is -1 for those that are no run.
    """
    words = F.col("words")
    token = F.filter(
        F.transform(words, lambda w, i: F.struct(i.alias("i"), w.alias("w"))),
        lambda x: (F.length(x["w"]) >= LEAST_LENGTH) & x["w"].rlike(_RUN))
    near = F.transform(token, lambda x: F.struct(
        x["i"].alias("i"), x["w"].alias("w"),
        F.concat_ws(" ", F.get(words, x["i"] - 2), F.get(words, x["i"] - 1)).alias("before"),
        F.coalesce(F.get(words, x["i"] + 1), F.lit("")).alias("after")))
    tokens = _slim(docs, path).select("doc_id", "path", F.explode(near).alias("t"))
    runs = tokens.select("doc_id", "path", "t", F.posexplode(F.regexp_extract_all("t.w", F.lit(_RUN), 1)).alias("run", "candidate"))
    return runs.where(_flagged(F.col("candidate"))).select(
        "doc_id", "path", F.col("t.i").cast("long").alias("word"), F.col("run").cast("long").alias("run"), "candidate",
        F.col("t.before").alias("before"), F.col("t.after").alias("after"),
        F.expr("substring_index(t.w, candidate, 1)").alias("lead")).unionByName(_assigned(docs, path))


def _codes(text: Column) -> Column:
    """The letters a to z of a text as 0 to 25, other characters as -1."""
    return F.transform(F.split(text, ""), lambda c: F.when(c.between("a", "z") & (F.length(c) == 1), F.ascii(c) - 97).otherwise(-1))


def _numbers(codes: Column, n: int) -> Column:
    """The numbers of the ``n``-letter grams at all places of a text's codes; -1 where one is no letter."""
    def number(code: Column, i: Column) -> Column:
        out, letters = code, code >= 0
        for k in range(1, n):
            out, letters = out * 26 + F.get(codes, i + k), letters & (F.get(codes, i + k) >= 0)
        return F.when(letters, out).otherwise(-1)

    return F.slice(F.transform(codes, number), 1, F.greatest(F.size(codes) - (n - 1), F.lit(0)))


def dictionary(docs: DataFrame, share: float = DICTIONARY_SHARE) -> DataFrame:
    """``(n, number, weight)``: letter pairs (``n`` 2) and triples (3) of the corpus's common words by number,
    with the number of documents of the words that hold them. At most 26**2 + 26**3 rows."""
    total = docs.count()
    words = docs.select(F.explode(F.array_distinct(
        F.regexp_extract_all(F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))), F.lit(r"\b([a-z]{2,12})\b"), 1))).alias("word"))
    common = words.groupBy("word").agg(F.count(F.lit(1)).alias("weight")).where(F.col("weight") >= max(1.0, share * total))
    codes = common.select("weight", _codes(F.col("word")).alias("codes"))
    return codes.select("weight", F.explode(F.array(*(
        F.struct(F.lit(n).alias("n"), _numbers(F.col("codes"), n).alias("numbers")) for n in (2, 3)))).alias("g")).select(
        "weight", "g.n", F.explode("g.numbers").alias("number")).groupBy("n", "number").agg(F.sum("weight").alias("weight"))


def _weights(grams: DataFrame, n: int) -> Column:
    """The weights of all ``26**n`` grams by number, as a scalar."""
    all_numbers = grams.sparkSession.range(26**n).select(F.col("id").cast("int").alias("number"))
    known = all_numbers.join(grams.where(F.col("n") == n), "number", "left").select("number", F.coalesce("weight", F.lit(0)).alias("weight"))
    pairs = F.array_sort(F.collect_list(F.struct("number", "weight")))
    return known.agg(F.transform(pairs, lambda x: x["weight"]).alias("weights")).scalar()


def described(found: DataFrame, grams: DataFrame) -> DataFrame:
    """``found`` with the columns of ``FEATURES``."""
    text = F.col("candidate")
    size = F.length(text).cast("double")

    def share(pattern: str) -> Column:
        return F.length(F.regexp_replace(text, f"[^{pattern}]", "")) / size

    # two arrays of fixed length, looked up by gram number
    with_table = found.withColumns({"__2": _weights(grams, 2), "__3": _weights(grams, 3), "__codes": _codes(F.lower(text))})
    with_table = with_table.withColumns({
        "__pairs": _numbers(F.col("__codes"), 2), "__triples": _numbers(F.col("__codes"), 3),
        "__all": F.aggregate("__2", F.lit(0).cast("long"), lambda s, w: s + w)})

    def weight(n: int, number: Column) -> Column:
        return F.when(number >= 0, F.get(F.col(f"__{n}"), number)).otherwise(0)

    surprise = F.aggregate("__pairs", F.lit(0.0), lambda s, g: s - F.log((weight(2, g) + 1.0) / (F.col("__all") + 676.0)))
    cover = F.size(F.filter("__triples", lambda g: weight(3, g) > 0)) / F.greatest(F.size("__triples"), F.lit(1))
    kinds = F.translate(F.regexp_replace(F.regexp_replace(F.regexp_replace(text, "[a-z]", "l"), "[A-Z]", "u"), "[0-9]", "d"), "+/_-=", "sssss")
    changes = F.regexp_count(kinds, F.lit(r"(.)(?!\1|$)"))
    context = F.concat_ws(" ", "before", "lead")
    path = F.coalesce(F.col("path"), F.lit(""))
    word = r"(?i)^[\p{L}]+[.,;:]?$"
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    return with_table.select(
        *found.columns,
        size.alias("length"),
        (F.size(F.array_distinct(F.split(text, ""))) / size).alias("distinct_share"),
        (changes / size).alias("class_changes"),
        share("0-9").alias("digit_share"), share("A-Z").alias("upper_share"), share("+/_=-").alias("symbol_share"),
        (F.size(F.filter("__pairs", lambda g: g < 0)) / size).alias("odd_pairs"),
        (surprise / size).alias("pair_surprise"),
        cover.cast("double").alias("dictionary_cover"),
        flag(text.rlike(_ISSUED)).alias("issued_format"),
        (F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))).cast("double").alias("path_depth"),
        flag(path.rlike(r"(?i)(test|example|sample|doc|fixture|mock)s?[/._-]")).alias("path_harmless"),
        flag(path.rlike(r"(?i)\.(env|ya?ml|json|ini|conf|cfg|properties|pem|key|tf)$")).alias("path_config"),
        flag(context.rlike(_CREDENTIAL)).alias("named_credential"),
        flag(context.rlike(r"[=:]>?\s*[\"'`]?$")).alias("assigned"),
        flag(F.col("lead").rlike(r"[\"'`]$")).alias("quoted"),
        flag(F.concat_ws(" ", context, "after").rlike(_HARMLESS)).alias("harmless_word"),
        flag(F.substring_index("before", " ", -1).rlike(word)).alias("plain_before"),
        flag(F.col("after").rlike(word)).alias("plain_after"),
    )


def labelled_by_rule(findings: DataFrame) -> DataFrame:
    """``findings`` that a rule settles, with ``label``: 1 for issued key formats, and for values with
    letters and digits assigned to a named credential; 0 for numbers, runs of letters, UUIDs,
    hexadecimal digests named as such and parts of URLs and file paths that are not so assigned.
    Others are left out."""
    named = (F.col("named_credential") == 1) & (F.col("assigned") == 1)
    mixed = F.col("candidate").rlike("[0-9]") & F.col("candidate").rlike("[A-Za-z]")
    yes = ((F.col("issued_format") == 1) | (named & mixed)) & (F.col("harmless_word") == 0)
    uuid = F.col("candidate").rlike("(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")
    digest = F.col("candidate").rlike("(?i)^([0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64}|[0-9a-f]{128})$") & (F.col("harmless_word") == 1)
    in_path = F.coalesce(F.col("lead").rlike("(?i)(https?|ftp|s3)://[^?#]*$"), F.lit(False)) | F.col("candidate").rlike("^/?([a-z0-9_-]+/){2,}[a-z0-9_-]+$")
    no = (F.col("issued_format") == 0) & ~named & (~mixed | uuid | digest | in_path)
    return findings.withColumn("label", F.when(yes, 1.0).when(no, 0.0)).where("label is not null")


def train(labelled: DataFrame, max_rows: int = TRAINING_FINDINGS, trees: int = 30, depth: int = 8, seed: int = 5,
          hidden: tuple[str, ...] = ()):
    """A fitted forest from ``labelled`` (the columns of ``FEATURES`` and ``label``), of which at most
    ``max_rows`` of each label are taken, by hash; None if one of the labels is missing. With
    ``hidden`` features every finding is learnt twice, once with those set to 0."""
    parts = [
        written(labelled.where(F.col("label") == y).select(*FEATURES, "label").orderBy(
            F.xxhash64(*FEATURES), *FEATURES).limit(max_rows), "labelled")
        for y in (0.0, 1.0)
    ]
    if any(p.isEmpty() for p in parts):
        return None
    rows = parts[0].unionByName(parts[1])
    if hidden:
        rows = rows.unionByName(rows.withColumns({c: F.lit(0.0) for c in hidden}))
    forest = RandomForestClassifier(featuresCol="__features", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed)
    return Pipeline(stages=[VectorAssembler(inputCols=list(FEATURES), outputCol="__features"), forest]).fit(rows)


def scan(docs: DataFrame, path: str = "source", labelled: DataFrame | None = None,
         threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, word, run, candidate, score, is_secret)`` for every candidate of every row of ``docs``.

    ``labelled`` are findings labelled by hand (see :func:`train`), else those that rules settle.
    Without findings of both labels nothing can be learnt: the score is then 1 for issued
    formats and else 0. Null and empty texts have no candidates; a null path has no features.
    Repeated rows give repeated findings, a null doc_id stays null; an empty table gives an
    empty result and further columns are not read.
    """
    grams = written(dictionary(docs), "dictionary")
    findings = written(described(candidates(docs, path), grams), "findings")
    model = train(labelled_by_rule(findings), hidden=EVIDENCE) if labelled is None else train(labelled)
    if model is None:
        scored = findings.withColumn("score", F.col("issued_format"))
    else:
        scored = model.transform(findings).withColumn("score", vector_to_array("probability")[1])
    return scored.select("doc_id", "word", "run", "candidate", "score",
                         (F.col("score") >= threshold).cast("int").alias("is_secret"))
