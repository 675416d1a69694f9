"""Secret scans with a random forest for false positives.

Candidates are cut out of the texts by one pattern. Their length,
character transitions, coverage by dictionary words, path and
neighbouring words become numbers by built-in functions, and a random
forest that is trained from labelled findings tells secrets from hashes,
identifiers, paths and placeholders. No Python runs on the executors.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

THRESHOLD = 0.5
MASK = "[SECRET]"

# What a candidate looks like.
_KEY_BLOCK = r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END [A-Z ]{0,40}PRIVATE KEY-----)?"
# possessive: the segments of a run may be many, and a group that can give back nests once for each
# '=' belongs to a run as padding at its end only: KEY=value is a name and, after '=', a value
_RUN = (r"(?<![A-Za-z0-9+/_\-])(?=[A-Za-z0-9+/_\-]{16})(?=[A-Za-z+/_\-]*[0-9])[A-Za-z0-9+/_\-]{16,}"
        r"(?:\.[A-Za-z0-9_\-]{16,}+)*+(?:={1,2}(?![\"']?[A-Za-z0-9+/_=\-]))?")
_VALUE = (r"(?<=[=:\"']|[=:] )(?<=(?i:password|passwd|pwd|secret|passphrase)[\"']?\s{0,2}[:=]\s{0,2}[\"']?)"
          r"[^\s\"'<>]{8,}")
CANDIDATE = f"{_KEY_BLOCK}|{_VALUE}|{_RUN}"     # beside a password word the whole value, not a run inside it
_NO_VALUE = f"{_KEY_BLOCK}|{_RUN}"         # the same for a text without one of these words
_VALUE_WORDS = ("passw", "pwd", "secret", "passphrase")

# Words inside and beside candidates.
_DICTIONARY = ("access account admin alpha api app area auth base beta block build cache case change client cloud code "
               "com common config core data date default demo dev docs document domain down element error event "
               "example false field file final first folder form frame function group guide handler header home html "
               "http image index info input item json key label language last layout level library line link list "
               "local login main manager master message method model module name network node null number object "
               "option order output package page param part password path photo please point post private process "
               "product profile project public query record release report request resource response result return "
               "root sample save schema script search section select server service session set settings simple site "
               "source spark src stage start state static status step store stream string style sub system table "
               "target task team template test text theme time title token tool total tree true type update upload "
               "url user util value var version view web window word work world xml").split()
_PAIRS = ("th he in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le ve co me de hi ri "
          "ro ic ne ea ra ce li ch ll be ma si om ur").split()
_SECRET_WORD = r"(?i)(token|secret|passw|pwd|passphrase|api.?key|apikey|access.?key|auth|bearer|credential|private|signing)[^\n]{0,20}$"
_PLAIN_WORD = r"(?i)(commit|sha\d*|rev|revision|hash|checksum|digest|md5|uuid|guid|etag|version|build|serial|order|invoice|isbn|id)[^\n]{0,12}$"
_ISSUED = r"^(AKIA|ASIA|gh[pousr]_|xox[abprs]-|sk-|sk_live|pk_live|eyJ|AIza|glpat-|npm_|-----BEGIN)"
_FILLER = r"(?i)(example|sample|dummy|your|changeme|placeholder|xxxx|todo|redacted|0000000|12345678|abcdef01)"

FEATURES = ("size", "digits", "uppers", "lowers", "signs", "hex", "turns", "pairs", "distinct", "covered", "slashes",
            "path", "secret_word", "plain_word", "assigned", "quoted", "issued", "filler", "groups")


def measured(found: DataFrame) -> DataFrame:
    """Numbers of each candidate from its ``value``, ``before`` and
    ``after`` (the text beside it)."""
    v, low, b = F.col("value"), F.lower("value"), F.col("before")
    size = F.length(v).cast("double")

    def share(pattern: str, of: Column = v) -> Column:
        return F.regexp_count(of, F.lit(pattern)) / size

    def is_(pattern: str, of: Column = v) -> Column:
        return of.rlike(pattern).cast("double")

    plain = F.regexp_replace(low, "|".join(sorted(_DICTIONARY, key=len, reverse=True)), "")
    cols = {
        "size": F.least(size, F.lit(400.0)), "digits": share("[0-9]"), "uppers": share("[A-Z]"), "lowers": share("[a-z]"),
        "signs": share("[^A-Za-z0-9]"), "hex": is_("^[0-9a-fA-F]+$"),
        "turns": share("(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])"),
        "pairs": share(f"(?=(?:{'|'.join(_PAIRS)}))", low),
        "distinct": F.size(F.array_distinct(F.split(v, ""))) / F.least(size, F.lit(64.0)),
        "covered": 1.0 - F.length(plain) / size,
        "slashes": share("/"), "path": is_(r"(?:://|[/\\.~])[^\s\"']*$", b),
        "secret_word": is_(_SECRET_WORD, b), "plain_word": is_(r"(?<![A-Za-z])" + _PLAIN_WORD, b),
        "assigned": is_(r"[:=]\s*[\"']?$", b), "quoted": (b.rlike("[\"'`]$") & F.col("after").rlike("^[\"'`]")).cast("double"),
        "issued": is_(_ISSUED), "filler": is_(_FILLER),
        "groups": is_("^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"),
    }
    return found.withColumns(cols)


def labelled_findings(spark: SparkSession, rows: int = 6_000) -> DataFrame:
    """Findings (value, before, after, label) made by rule: issued keys,
    random tokens beside secret words and key blocks are secrets; commits,
    checksums, identifiers, paths, names, numbers and placeholders are
    not. A caller with reviewed findings passes those instead."""
    n = F.col("id")

    def hexes(tag: str, size: int) -> Column:
        return F.substring(F.concat(F.sha2(F.concat(n.cast("string"), F.lit(tag)).cast("binary"), 256),
                                    F.sha2(F.concat(F.lit(tag), n.cast("string")).cast("binary"), 256)), 1, size)

    def b64(tag: str, size: int | Column) -> Column:
        return F.regexp_replace(F.base64(F.unhex(hexes(tag, 128))), "[\r\n]", "").substr(F.lit(1), F.lit(size) if isinstance(size, int) else size)

    def one(*options: str, tag: str = "o") -> Column:
        return F.element_at(F.array(*map(F.lit, options)),
                            (F.pmod(F.xxhash64("id", F.lit(tag)), F.lit(len(options))) + 1).cast("int"))

    mark = one("token", "secret", "api_key", "apikey", "access_key", "auth_token", "SECRET", "Token", "password", "TOKEN", tag="m")
    glue = one(' = "', ": ", "=", ' := "', "='", ' "', tag="g")
    close = one('"', "", "\n", "'", tag="c")
    prose = one("the result of ", "and then in ", "see also ", "for all of them ", "die und der ", "", tag="p")
    plain = one("commit ", "sha256:", "rev ", "checksum ", "digest=", "md5 ", "id: ", "etag ", "uuid ", "version ", tag="q")
    word = one(*_DICTIONARY, tag="w1")
    sep = one("_", "-", ".", "/", "", tag="s")
    name = F.concat(word, sep, one(*_DICTIONARY, tag="w2"), sep, one(*_DICTIONARY, tag="w3"), sep,
                    F.pmod(n, F.lit(97)).cast("string"))
    folder = one("https://example.org/", "/usr/share/", "src/main/", "C:\\data\\", "http://www.site.com/a/", tag="f")
    beside = F.concat(prose, mark, glue)
    size = (F.pmod(F.xxhash64("id", F.lit("z")), F.lit(4)) * 8 + 20).cast("int")
    phrase = F.concat(one("password", "PASSWORD", "db_passwd", "pwd", "secret", tag="pw"), one("=", ": ", ' = "', '="', tag="pg"))
    typed = F.translate(b64("pv", (F.pmod(F.xxhash64("id", F.lit("pz")), F.lit(5)) * 12 + 10).cast("int")), "+/aeQ7", "!&#$%@")
    kinds = [  # (label, value, before, after)
        (1, hexes("a", 40), beside, close), (1, F.upper(hexes("b", 40)), F.upper(beside), close),
        (1, b64("c", size), beside, close),
        (1, F.concat(F.lit("AKIA"), F.upper(hexes("d", 16))), prose, close),
        (1, F.concat(one("ghp_", "sk-", "xoxb-", "glpat-", tag="i"), F.regexp_replace(b64("e", 36), "[+/]", "x")), prose, close),
        (1, F.concat(F.lit("eyJ"), b64("f", 30), F.lit("."), b64("g", 40), F.lit("."), b64("h", 30)), one("Bearer ", "auth: ", "", tag="j"), close),
        (1, F.concat(F.lit("-----BEGIN RSA PRIVATE KEY-----\n"), b64("k", 80)), prose, F.lit("\n")),
        (1, hexes("l", 32), beside, close), (1, typed, F.concat(prose, phrase), close),
        (0, hexes("m", 40), F.concat(prose, plain), one(" ", "\n", ")", tag="c")), (0, hexes("n", 32), F.concat(prose, plain), F.lit(" ")),
        (0, hexes("r", 64), F.concat(prose, plain), F.lit(" ")),
        (0, F.concat_ws("-", hexes("s", 8), hexes("t", 4), hexes("u", 4), hexes("v", 4), hexes("x", 12)), F.concat(prose, plain), F.lit(" ")),
        (0, name, prose, F.lit(" ")), (0, name, folder, F.lit(" ")), (0, F.concat(F.lit("a/"), name, F.lit("/"), word), folder, F.lit(".html")),
        (0, F.concat(one("YOUR_", "example-", "xxxxxxxx", "changeme", "sample_", tag="h"), word, F.lit("_1234567890")), beside, close),
        (0, F.concat(F.lit("2024-0"), F.pmod(n, F.lit(9)).cast("string"), F.lit("-11T10-15-00")), prose, F.lit(" ")),
        (0, F.conv(hexes("y", 14), 16, 10), F.concat(prose, plain), F.lit(" ")),
        (0, name, beside, close), (0, F.upper(F.concat(F.translate(name, "-./", "___"), F.lit("_KEY"))), prose, F.lit("=")), (0, F.repeat(F.substring(hexes("z", 2), 1, 2), 12), prose, F.lit(" ")),
    ]
    pick = F.element_at(F.array(*(F.struct(F.lit(k).cast("double").alias("label"), v.alias("value"), b.alias("before"),
                                           a.alias("after")) for k, v, b, a in kinds)),
                        (n % len(kinds) + 1).cast("int"))
    return spark.range(0, rows, numPartitions=2).select(pick.alias("f")).select("f.*")


def recut(labelled: DataFrame) -> DataFrame:
    """Labelled findings as a scan would find them: the candidates of
    before + value + after that meet the value, with its label."""
    def given(c: str) -> Column:
        return F.coalesce(labelled[c], F.lit(""))
    whole = labelled.select("label", F.concat(given("before"), given("value"), given("after")).alias("text"),
                            F.length(given("before")).alias("first"),
                            (F.length(given("before")) + F.length(given("value"))).alias("last"))
    found = spans(candidates(whole, "text", [whole["label"], whole["first"], whole["last"]]))
    return found.where("start < last and stop > first").select("value", "before", "after", "label")


def fit(spark: SparkSession, labelled: DataFrame | None = None, trees: int = 20,
        depth: int = 8) -> RandomForestClassificationModel:
    """A forest from labelled findings (value, before, after, label)."""
    given = (labelled if labelled is not None else labelled_findings(spark)).persist()   # else made again for each of its uses
    known = measured(recut(given))
    known = VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(known).select("x", "label").persist()
    try:
        return RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=trees, maxDepth=depth,
                                      featureSubsetStrategy="sqrt", seed=11).fit(known)
    finally:
        known.unpersist()
        given.unpersist()


def pattern(text: Column) -> Column:
    """The candidate pattern that a text needs: null without a digit, a
    key block and a password word, as nothing can match then."""
    low = F.lower(text)
    word = F.lit(False)
    for w in _VALUE_WORDS:
        word = word | F.contains(low, F.lit(w))
    return (F.when(word, F.lit(CANDIDATE))
            .when(text.rlike("[0-9]") | F.contains(text, F.lit("-----BEGIN")), F.lit(_NO_VALUE)))


def matched(text: Column) -> Column:
    """True for texts that have candidates, else false (null too)."""
    return F.coalesce(F.rlike(text, pattern(text)), F.lit(False))


def candidates(docs: DataFrame, text_col: str, keep: list[Column]) -> DataFrame:
    """One row per candidate of the rows that have any: ``keep``, rid
    (number of the row), pos, gap (the text before it, from the last
    candidate on), value, before (with the last candidate), after."""
    text = docs[text_col]
    cut = (docs.where(matched(text))
           .select(*keep, F.monotonically_increasing_id().alias("rid"),
                   F.regexp_extract_all(text, pattern(text), F.lit(0)).alias("values"),
                   F.split(text, pattern(text), -1).alias("gaps")))
    held = [c for c in cut.columns if c not in ("values", "gaps")]
    rows = cut.select(*held, F.posexplode(F.arrays_zip(
        "gaps", "values", F.slice("gaps", 2, F.size("gaps")).alias("next"), F.concat(F.array(F.lit("")), "values").alias("last_value"))).alias("pos", "z"))
    return rows.select(*held, "pos", F.col("z.gaps").alias("gap"), F.col("z.values").alias("value"),
                       F.substring(F.concat("z.last_value", "z.gaps"), -64, 64).alias("before"),
                       F.substring(F.coalesce("z.next", F.lit("")), 1, 24).alias("after"))


def spans(found: DataFrame) -> DataFrame:
    """Candidates with their start and stop (code points, stop excluded)."""
    found = found.where("value is not null")
    stop = F.sum(F.length("gap") + F.length("value")).over(W.partitionBy("rid").orderBy("pos"))
    return found.withColumn("stop", stop).withColumn("start", F.col("stop") - F.length("value"))


def judged(found: DataFrame, model: RandomForestClassificationModel, threshold: float = THRESHOLD) -> DataFrame:
    """Candidates with score and the decision ``secret``."""
    x = VectorAssembler(inputCols=list(FEATURES), outputCol="x", handleInvalid="keep").transform(measured(found))
    out = model.transform(x).withColumn("score", vector_to_array("probability")[1])
    return out.select(*found.columns, "score", (F.col("score") >= threshold).alias("secret"))


def kind(value: Column) -> Column:
    """A name for the shape of a value."""
    return (F.when(value.startswith("-----BEGIN"), "private key").when(value.rlike("^A[KS]IA"), "cloud key")
            .when(value.rlike("^eyJ.*[.]"), "signed token").when(value.rlike(_ISSUED), "issued token")
            .when(value.rlike("^[0-9a-fA-F]+$"), "hex token").otherwise("token"))


def scan(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         labelled: DataFrame | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Every candidate of every whole text: doc_id, start and stop (code
    points, stop excluded), kind, value, score and secret.

    Null and empty texts have none. Rows with equal or null ids are
    scanned one by one and give their own findings. Other columns are
    not read.
    """
    found = spans(candidates(docs, text_col, [docs[id_col].cast("long").alias("doc_id")]))
    return judged(found, fit(spark, labelled), threshold).select(
        "doc_id", "start", "stop", kind(F.col("value")).alias("kind"), "value", "score", "secret")


def redact(spark: SparkSession, docs: DataFrame, text_col: str = "text", labelled: DataFrame | None = None,
           threshold: float = THRESHOLD, mask: str = MASK, length_col: str | None = None) -> DataFrame:
    """``docs`` with each secret replaced by ``mask``; every row and all
    other columns stay as they are, but for ``length_col`` (code points
    of the text), which is counted again where a text had candidates."""
    names = docs.columns
    found = candidates(docs, text_col, [F.struct(*(docs[c] for c in names if c != text_col)).alias("own")]
                       if len(names) > 1 else [])
    ended = found.withColumn("value", F.coalesce("value", F.lit("")))
    marked = judged(ended.where("value <> ''"), fit(spark, labelled), threshold).unionByName(
        ended.where("value = ''").withColumns({"score": F.lit(0.0), "secret": F.lit(False)}))
    held = ["own"] if len(names) > 1 else []
    new = (marked.groupBy("rid").agg(
        *(F.any_value(c).alias(c) for c in held),
        F.array_sort(F.collect_list(F.struct("pos", F.concat("gap", F.when(F.col("secret"), F.lit(mask)).otherwise(
            F.col("value"))).alias("text")))).alias("bits"))
        .select(*held, F.array_join(F.col("bits.text"), "").alias("new_text")))
    new = new.select(*(F.col("new_text").alias(c) if c == text_col else
                       F.length("new_text").cast(docs.schema[c].dataType).alias(c) if c == length_col else
                       F.col(f"own.`{c}`").alias(c) for c in names))
    return docs.where(~matched(docs[text_col])).unionByName(new)
