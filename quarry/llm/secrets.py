"""Secret scans: candidates filtered by a random forest, all in Spark columns.

Candidates are runs of token characters in the words of a text: long runs
anywhere, and shorter ones after a name such as ``password`` and a separator,
in the same word (every one, not only the last) or the words before.
A forest trained from labelled findings decides on length, character classes
and transitions, dictionary coverage, path and neighbouring words; its trees
are compiled to column expressions, so scanning is one projection over one
scan: no user function, no shuffle.

``labelled_findings`` makes the default training rows from templates of known
kinds of secrets and of look-alikes (hashes, identifiers, placeholders, card
numbers, addresses, words); own labelled rows with its columns can be given.

Defined results: a null or empty text has no candidates; null ids, null paths
and repeated rows are scanned row by row; an empty table gives an empty
result; input columns ``candidates`` and ``secrets`` are replaced, others are
carried along.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import bind
from quarry.llm.forest import read_tree, value_of
from quarry.llm.textstats import words
from quarry.session import store

# Names that secrets are assigned to, words that stand beside
# look-alikes, dictionary words inside identifiers, frequent letter pairs.
SECRET_NAMES = ("token", "secret", "password", "passwd", "pwd", "api_key", "apikey", "api-key", "auth", "bearer",
                "credential", "private_key", "access_key", "client_secret")
OTHER_NAMES = ("commit", "sha", "sha1", "sha256", "md5", "hash", "checksum", "digest", "uuid", "guid", "revision", "version",
               "example", "sample", "test", "dummy", "placeholder", "id", "isbn", "phone", "card", "mail", "url", "path", "image")
TEST_PATHS = ("test", "example", "sample", "mock", "fixture", "doc", "demo")
DICTIONARY = ("your", "here", "example", "token", "secret", "password", "key", "test", "user", "name", "change", "this", "that",
              "with", "from", "api", "access", "placeholder", "sample", "dummy", "http", "https", "www", "com", "org", "net",
              "index", "html", "image", "file", "path", "version", "value", "string", "the", "and", "for", "tion", "ing", "ment",
              "heit", "keit", "lich", "ation", "ción", "ent", "able", "mail")
PAIRS = ("th", "he", "in", "er", "an", "re", "on", "at", "en", "nd", "ti", "es", "or", "te", "of", "ed", "is", "it", "al", "ar",
         "st", "to", "nt", "ng", "se", "ha", "as", "ou", "io", "le", "ve", "co", "me", "de", "hi", "ri", "ro", "ic", "ne", "ea",
         "ch", "ie", "ei", "un", "qu", "ai", "la", "el", "os", "ci")

LONG = r"[A-Za-z0-9+/_=\-.]{16,}"
# beside a name, ``=`` is part of a run as padding at its end only, and the next parameter of a query string ends it
PADDING = r"(?:={1,2}(?![A-Za-z0-9+/_=\-.]))?"
LONG_PART = r"[A-Za-z0-9+/_\-.]{16,}" + PADDING
SHORT = r"(?:(?!&[\w.%\-]+=)[^\s\"'`,;:=<>()\[\]{}]){6,}+" + PADDING
PADDED = r"^(?:[A-Za-z0-9+/_\-]{4})*[A-Za-z0-9+/_\-]{2,3}={1,2}$"
NAMED = rf"(?i)(?:{'|'.join(SECRET_NAMES)})"
ASSIGNED = NAMED + r"[\"']?(?:=>|:=|[:=])"
# a body may hold hyphens (headers of encrypted keys); no block reaches over the start or end of another
PRIVATE_KEY = r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:(?!-----(?:BEGIN|END) )[\s\S])*+-----END [A-Z ]*PRIVATE KEY-----"
THRESHOLD = 0.5
FEATURES = ("length", "digits", "uppers", "lowers", "others", "runs", "pairs", "vowels", "distinct", "is_hex", "coverage",
            "slashes", "dots", "at_sign", "test_path", "secret_near", "other_near", "assigned", "quoted")


def _share(value: Column, pattern: str) -> Column:
    return (F.length(value) - F.length(F.regexp_replace(value, pattern, ""))) / F.length(value)


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("double")


def features(value: Column, word: Column, before: Column, after: Column, path: Column) -> Column:
    """struct of FEATURES (double) of a candidate: its value, the word it is
    in, the words before and after it, and the path of its text."""
    low = F.lower(value)
    columns = {
        "length": F.length(value).cast("double"),
        "digits": _share(value, "[0-9]+"), "uppers": _share(value, "[A-Z]+"), "lowers": _share(value, "[a-z]+"),
        "others": _share(value, "[^0-9A-Za-z]+"),
        "runs": (F.size(F.regexp_extract_all(value, F.lit("[a-z]+|[A-Z]+|[0-9]+|[^0-9A-Za-z]+"), F.lit(0))) - 1) / F.length(value),
        "pairs": F.size(F.regexp_extract_all(low, F.lit("(?:" + "|".join(PAIRS) + ")"), F.lit(0))) / F.length(value),
        "vowels": _share(low, "[aeiou]+"),
        "distinct": F.size(F.array_distinct(F.split(value, ""))) / F.length(value),
        "is_hex": _flag(low.rlike("^[0-9a-f]+$")),
        "coverage": _share(low, "(?:" + "|".join(sorted(DICTIONARY, key=lambda x: (-len(x), x))) + ")"),
        "slashes": _share(value, "/+"), "dots": _share(value, "[.]+"), "at_sign": _flag(word.contains("@")),
        "test_path": _flag(path.rlike("(?i)(?:" + "|".join(TEST_PATHS) + ")")),
        "secret_near": _flag(before.rlike(rf"(?i)(?<![a-z])(?:{'|'.join(SECRET_NAMES)})")),
        "other_near": _flag(F.concat_ws(" ", before, after).rlike(rf"(?i)(?<![a-z])(?:{'|'.join(OTHER_NAMES)})(?![a-z])")),
        "assigned": _flag(before.rlike(r"(?:=>|:=|[:=])[\s\"'`]*$")),
        "quoted": _flag(word.rlike("[\"'`]")),
    }
    return F.struct(*[columns[n].alias(n) for n in FEATURES])


def labelled_findings(spark: SparkSession, per_kind: int = 150) -> DataFrame:
    """Training rows (value, word, before, after, path, label): ``per_kind``
    of each template; the random parts are hashes of the row number."""
    hx, b64 = "sha2(concat('{k}', id), 256)", "translate(base64(unhex(sha2(concat('{k}', id), 256))), '+/=', 'aB3')"
    name = "element_at(array('token', 'api_key', 'secret', 'password', 'access_key', 'auth_token', 'apikey', 'client_secret'), int(id % 8) + 1)"
    prose = "element_at(array('the report of', 'seen in the', 'and with a', 'on the other', 'für den', 'dans le', 'por la'), int(id % 7) + 1)"
    other = "element_at(array('commit', 'sha256', 'md5', 'checksum', 'hash', 'revision', 'digest', 'uuid', 'id'), int(id % 9) + 1)"
    sep = "element_at(array(' = ', ': ', ' := ', '=', ' => '), int(id % 5) + 1)"
    glue = "array_join(transform(sequence(1, 4 + int(id % 5)), i -> element_at(array('th','er','ion','ent','re','an','ing','tion','le','que','heit','ed','os','ment','sch','pf','ge','be','unger','keit','ach','ver','zu','tz','ñe','ou','wh','sh'), int(pmod(xxhash64(id, i), 28)) + 1)), '')"
    title = f"concat(upper(left({glue}, 1)), substr({glue}, 2))"
    kinds = [  # value, before, label
        (f"substr({hx}, 1, 40)", f"concat({prose}, ' ', {name}, {sep})", 1),
        (f"substr({hx}, 1, 40)", f"concat({other}, ' ', {name}, {sep})", 1),
        (f"substr({hx}, 1, 32)", f"concat({name}, {sep})", 1),
        (f"substr({b64}, 1, 40)", f"concat({name}, {sep})", 1),
        (f"concat('AKIA', upper(substr({hx}, 1, 16)))", f"concat({prose}, ' key ')", 1),
        (f"concat('ghp_', substr({b64}, 1, 36))", prose, 1),
        (f"concat('sk-', substr({b64}, 1, 40))", prose, 1),
        (f"concat('eyJ', substr({b64}, 1, 30), '.', substr({b64}, 3, 36))", f"concat('bearer', {sep})", 1),
        (f"concat(substr({b64}, 1, 8), '!', int(id % 97))", f"concat('password', {sep})", 1),
        (f"substr({hx}, 1, 40)", f"concat({prose}, ' ', {other}, {sep})", 0),
        (f"{hx}", f"concat({other}, ' ')", 0),
        (f"substr({hx}, 1, 40)", f"concat({prose}, ' ', {other}, ' ')", 0),
        (f"concat_ws('-', substr({hx}, 1, 8), substr({hx}, 9, 4), substr({hx}, 13, 4), substr({hx}, 17, 4), substr({hx}, 21, 12))", f"concat({other}, {sep})", 0),
        ("concat('YOUR_', upper(element_at(array('api_key','token','secret','password'), int(id % 4) + 1)), '_HERE')", f"concat({name}, {sep})", 0),
        ("repeat(element_at(array('x','*','0','a'), int(id % 4) + 1), 16 + int(id % 20))", f"concat({name}, {sep})", 0),
        ("lpad(string(pmod(xxhash64(id), 10000000000000000)), 16, '4')", f"concat({prose}, ' ')", 0),
        (f"concat({glue}, '.', int(id % 100), '@mail', int(id % 10), '.example.com')", f"concat({prose}, ' ')", 0),
        (glue, f"concat({prose}, ' ')", 0),
        (title, f"concat({prose}, ' ')", 0),
        (title, f"concat({name}, ' ')", 0),
        (title, f"concat({prose}, '. ')", 0),
        (f"concat({glue}, '-', {glue})", f"concat({prose}, ' ')", 0),
        (f"concat({glue}, '.', {glue}, '.', {glue})", f"concat({prose}, ' ')", 0),
        (f"concat('https://www.example.org/', {glue}, '/', {glue}, '.html')", f"concat({prose}, ' url ')", 0),
        (f"concat('/usr/lib/', {glue}, '/', {glue})", f"concat('path', {sep})", 0),
        (f"concat({glue}, '_', {glue})", f"concat({name}, {sep})", 0),
        (f"concat('v', int(id % 9), '.', int(id % 11), '.', int(id % 100), '-release-', int(id % 1000))", "'version '", 0),
    ]
    def pick(column):
        cases = " ".join(f"WHEN {k} THEN {row[column]}" for k, row in enumerate(kinds))
        return f"CASE kind {cases} END".replace("{k}", "k")
    rows = spark.range(0, per_kind * len(kinds), 1, 2).selectExpr(f"id % {len(kinds)} AS kind", f"id DIV {len(kinds)} AS id")
    rows = rows.selectExpr("id", f"{pick(0)} AS value", f"{pick(1)} AS before", f"{pick(2)} AS label")
    quote = "element_at(array('\"', '', \"'\"), int(id % 3) + 1)"
    return rows.selectExpr("value", f"concat({quote}, value, {quote}) AS word", "before", f"{prose} AS after",
                           "element_at(array('src/app', 'conf', 'src0', 'lib/main'), int(id % 4) + 1) AS path", "label")


def train(labelled: DataFrame, trees: int = 24, depth: int = 7, seed: int = 11) -> list:
    """Trees of a random forest fitted to labelled findings."""
    rows = labelled.select(features(*[F.col(c) for c in ("value", "word", "before", "after", "path")]).alias("f"), "label").select("f.*", "label")
    ready = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(store(rows, "labelled-findings"))
    model = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt").fit(ready)
    return [read_tree(t.toDebugString) for t in model.trees]


def score(forest: list, found: Column) -> Column:
    """Share of the trees that take a candidate (struct of FEATURES) for a secret."""
    votes = [value_of(t, lambda i: found[FEATURES[i]]) for t in forest]
    total = votes[0]
    for v in votes[1:]:
        total = total + v
    return total / len(votes)


def _candidates(w: Column) -> Column:
    """array<array<struct<at, value, word, before, after>>> of the words of a text."""
    def context(i):
        return F.array_join(F.slice(w, F.greatest(i - 2, F.lit(1)), F.least(i, F.lit(3))), " ")

    def led(i):
        return F.concat_ws(" ", F.get(w, i - 2), F.get(w, i - 1)).rlike(NAMED + r"[\"']?\s*(?:=>|:=|[:=])$")

    def all_of(x, pattern):
        return F.regexp_extract_all(x, F.lit(pattern), F.lit(0))

    def runs(x, i):
        tail = F.when(led(i), x).otherwise(F.regexp_extract(x, f"(?s){ASSIGNED}(.*)$", 1))
        head = F.substring(x, F.lit(1), F.length(x) - F.length(tail))
        values = bind(all_of(tail, SHORT), lambda v: F.concat(v, F.filter(all_of(tail, LONG_PART), lambda y: ~F.array_contains(v, y))))
        return F.when(led(i) | x.rlike(ASSIGNED), F.concat(all_of(head, LONG_PART), values)).otherwise(all_of(x, LONG))

    def before(x, i, v):
        # a word with a name of its own may hold several pairs: what went before the pair's own delimiter is not its context
        start = F.call_function("substring_index", x, v, F.lit(1))
        own = ~led(i) & x.rlike(ASSIGNED) & start.rlike("[,;&?{}]")
        return F.when(own, F.regexp_replace(start, "(?s)^.*[,;&?{}]", "")).otherwise(F.concat(context(i), F.lit(" "), start))

    def of_word(i):
        x = F.get(w, i)
        found = F.transform(runs(x, i), lambda v: F.struct(
            F.instr(x, v).alias("at"),
            F.when(v.rlike(PADDED) & (F.length(v) % 4 == 0), v).otherwise(F.regexp_replace(v, r"[.=#*$%&|<>]+$", "")).alias("value"),
            x.alias("word"),
            before(x, i, v).alias("before"),
            F.coalesce(F.get(w, i + 1), F.lit("")).alias("after")))
        return F.array_sort(F.filter(found, lambda c: F.length(c["value"]) >= 6))

    places = F.transform(w, lambda x, i: F.when(x.rlike(LONG) | (x.rlike("[:=]") & x.rlike(NAMED)) | (
        (i > 0) & F.get(w, i - 1).rlike("[:=>]$") & led(i)), i))
    return F.transform(F.filter(places, lambda i: i.isNotNull()), of_word)


def scan(df: DataFrame, forest: list, text_col: str = "text", path_col: str | None = "source", threshold: float = THRESHOLD) -> DataFrame:
    """``df`` with ``candidates`` (long) and ``secrets``, an array of
    struct<value, score> in text order."""
    path = F.col(f"`{path_col}`").cast("string") if path_col else F.lit("")

    def scored(c):
        return F.struct(c["value"].alias("value"), bind(
            features(c["value"], c["word"], c["before"], c["after"], path), lambda f: score(forest, f)).alias("score"))

    def outermost(found):
        # a run inside a longer secret of its word is no second secret
        def within(a, b):
            return (F.length(a["value"]) < F.length(b["value"])) & b["value"].contains(a["value"])
        return bind(F.filter(found, lambda s: s["score"] >= threshold), lambda kept: F.filter(
            kept, lambda s: ~F.exists(kept, lambda o: within(s, o))))
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    blocks = F.transform(F.regexp_extract_all(text, F.lit(PRIVATE_KEY), F.lit(0)), lambda b: F.struct(b.alias("value"), F.lit(1.0).alias("score")))
    found = df.drop("candidates", "secrets").withColumn("__found", bind(words(text), _candidates))
    found = found.withColumn("__blocks", blocks).withColumn("__scored", F.transform("__found", lambda x: F.transform(x, scored)))
    return (found.withColumn("candidates", (F.size("__blocks") + F.size(F.flatten("__scored"))).cast("long"))
            .withColumn("secrets", F.concat(F.filter("__blocks", lambda s: s["score"] >= threshold), F.flatten(F.transform("__scored", outermost))))
            .drop("__found", "__blocks", "__scored"))


def redact(df: DataFrame, forest: list, text_col: str = "text", path_col: str | None = "source",
           threshold: float = THRESHOLD, mark: str = "[SECRET]") -> DataFrame:
    """``df`` with every secret in its text replaced by ``mark``; the columns
    stay, and ``n_chars``, if there, is counted again."""
    names = df.columns
    row = F.struct(*[F.col(f"`{c}`") for c in names]).alias("__row")
    path = F.col(f"`{path_col}`").cast("string") if path_col else F.lit("")
    found = scan(df.select(row, F.col(f"`{text_col}`").alias("__text"), path.alias("__path")), forest, "__text", "__path", threshold)
    # longest first, so a secret that is part of another one does not hide it
    values = F.transform(F.reverse(F.array_sort(F.transform("secrets", lambda s: F.struct(
        F.length(s["value"]).alias("n"), s["value"].alias("value"))))), lambda s: s["value"])
    clean = F.aggregate(values, F.col("__text"), lambda t, v: F.replace(t, v, F.lit(mark)))
    out = found.withColumn("__clean", F.when(F.size("secrets") > 0, clean).otherwise(F.col("__text")))
    fields = {text_col: F.col("__clean"), "n_chars": F.length("__clean").cast("long")}
    return out.select(*[fields.get(c, F.col("__row")[c]).alias(c) for c in names])
