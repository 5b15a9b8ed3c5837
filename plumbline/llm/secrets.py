"""Secret scan with a random forest that removes false positives, in DataFrame operations only.

Candidates are found in the whole text: what is assigned to a word such as ``password`` (six characters and
more, whatever they are), and maximal runs without blanks, quotes or brackets that hold a digit or change from
small to capital letters. The forest judges their length, character classes and transitions, the share that
dictionary words cover, path-like shape and the neighbouring words. Dictionary and transitions are learned from
the words of the corpus (``learn``). The forest is trained from labelled findings; ``labelled_findings`` makes a
table of them from stated formats, and any table of the same columns can take its place.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.common import cut

#: Words before a candidate that speak for a secret, and such that speak against one.
FOR = "password|passwd|passphrase|(?<![A-Za-z])pass(?![A-Za-z])|pwd|secret|token|api[_ -]?key|access[_ -]?key|private[_ -]?key|credential|auth|bearer"
AGAINST = "commit|sha|md5|checksum|digest|uuid|guid|version|build|order|invoice|isbn|phone|tel|call|mail|contact|http|www|example|ref|id|iban|date"

_WIDE = r"\p{Cs}\x{10000}-\x{10FFFF}"  # end a candidate; so all of its characters have one width, and matching needs no stack
_RUN = rf"""[^\s"'`()\[\]{{}}<>,;|=:{_WIDE}]"""
#: A value after a word of FOR and = or :, quoted or not. A quoted one goes to its closing quote, whatever signs it holds; one with
#: a blank in it, or without a closing quote, is read like one without quotes.
ASSIGNED = (
    rf"""(?<=[:=]["' \t]{{0,4}})(?<=(?i:{FOR})[A-Za-z0-9_-]{{0,20}}["']?[ \t]{{0,3}}[:=]{{1,2}}[ \t]{{0,3}}["']?)"""
    rf"""(?:(?<=")[^\s"{_WIDE}]{{6,}}+(?=")|(?<=')[^\s'{_WIDE}]{{6,}}+(?=')|"""
    rf"""[^\s"'`=:{_WIDE}][^\s"'`{_WIDE}]{{4,}}[^\s"'`.,;:)\]}}>{_WIDE}])"""
)
#: A maximal run of eight and more with a digit or a change of case in it; a stop at its end isn't part of it.
RUN = (
    rf"""(?<!{_RUN})(?:(?=[^\s"'`()\[\]{{}}<>,;|=:{_WIDE}0-9]*+[0-9])|(?={_RUN}*?[a-z][A-Z])){_RUN}{{7,}}[^\s"'`()\[\]{{}}<>,;|=:.!?{_WIDE}]={{0,2}}"""
)
CANDIDATE = f"{ASSIGNED}|{RUN}"
AROUND = 40  # characters of either side that are kept

FEATURES = [
    "length", "digits", "upper", "lower", "signs", "distinct", "runs", "changes", "transitions", "hex", "covered", "slashes", "dots", "at",
    "dashes", "near_for", "near_against", "assigned", "quoted", "known_prefix", "extension", "scheme",
]


class Knowledge(NamedTuple):
    """What the words of a corpus say: the dictionary (word), and log probabilities of letter pairs, 27 x 27 with 0 for no letter."""

    words: DataFrame
    pairs: list[float]


def learn(docs: DataFrame, min_count: int = 5) -> Knowledge:
    """The dictionary of ``docs``: words of 3 to 40 letters that stand in its texts at least ``min_count`` times, and how
    their letters a to z follow one another. All texts are counted; words are added up before they are shuffled."""
    words = docs.where("text is not null").select(F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word"))
    words = words.where(F.length("word").between(3, 40)).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    words = cut(words.where(F.col("n") >= min_count))
    code = lambda at: F.ascii(F.substring("word", at, 1)) - 96
    plain = words.where(F.col("word").rlike("^[a-z]+$")).select("word", "n", F.explode(F.sequence(F.lit(1), F.length("word") - 1)).alias("k"))
    counted = plain.groupBy(code(F.col("k")).alias("a"), code(F.col("k") + 1).alias("b")).agg(F.sum("n").alias("n")).collect()  # 26 x 26 rows at most
    counts = {(r["a"], r["b"]): r["n"] for r in counted}
    sums = {a: sum(n for (x, _), n in counts.items() if x == a) for a in range(27)}
    pairs = [math.log((counts.get((a, b), 0) + 0.5) / (sums[a] + 13.5)) if a and b else 0.0 for a in range(27) for b in range(27)]
    return Knowledge(words.select("word"), pairs)


def features(found: Column, before: Column, after: Column, covered: Column, pairs: Sequence[float]) -> dict[str, Column]:
    """The forest's inputs, by name. covered: the characters of ``found`` in dictionary words."""
    n = F.length(found).cast("double")
    low, near = F.lower(found), F.lower(before)
    signs = F.split(low, "")
    letters = F.transform(signs, lambda c: F.when((c >= "a") & (c <= "z") & (F.length(c) == 1), F.ascii(c) - 96).otherwise(0))
    table = F.array(*[F.lit(x) for x in pairs])
    start = F.struct(F.lit(0).alias("last"), F.lit(0.0).alias("sum"), F.lit(0).alias("n"))

    def follow(s: Column, c: Column) -> Column:
        both = ((s["last"] > 0) & (c > 0)).cast("int")
        return F.struct(c.alias("last"), (s["sum"] + F.get(table, s["last"] * 27 + c)).alias("sum"), (s["n"] + both).alias("n"))

    def count(pattern: str, of: Column = found) -> Column:
        return F.regexp_count(of, F.lit(pattern)).cast("double")

    def yes(pattern: str, of: Column) -> Column:
        return of.rlike(pattern).cast("double")

    return {
        "length": n,
        "digits": count("[0-9]") / n,
        "upper": count("[A-Z]") / n,
        "lower": count("[a-z]") / n,
        "signs": count("[^A-Za-z0-9]") / n,
        "distinct": F.size(F.array_distinct(signs)) / n,
        "runs": count(r"(.)\1") / n,
        "changes": count("(?<=[0-9])[A-Za-z]|(?<=[A-Za-z])[0-9]|(?<=[a-z])[A-Z]|(?<=[A-Z])[a-z]") / n,
        # the mean log probability of its letter pairs; one without pairs counts as unlike any word
        "transitions": F.aggregate(letters, start, follow, lambda s: F.when(s["n"] > 0, s["sum"] / s["n"]).otherwise(F.lit(-6.0))),
        "hex": yes("^[0-9a-f]+$", low),
        "covered": covered / n,
        "slashes": count(r"[/\\]"),
        "dots": count("[.]"),
        "at": count("@"),
        "dashes": count("[-_]"),
        "near_for": yes(f"({FOR})[^a-z]*$", near),
        "near_against": yes(f"\\b({AGAINST})[^a-z]*$", near),
        "assigned": yes(r"""[=:]\s*["']?$""", before),
        "quoted": yes(r"""["']$""", before) * yes(r"""^["']""", after),
        "known_prefix": yes("^(AKIA|ASIA|gh[pousr]_|xox[abp]-|sk_live_|sk-|eyJ|AIza|glpat-)", found),
        "extension": yes("[.][a-z]{2,4}$", low),
        "scheme": yes("^//", found),
    }


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, start, found, before, after) of every candidate in the whole text; start counts characters from 0.

    Splitting at the pattern gives the text between the candidates, so context costs nothing more. Starts are
    running sums over a text's candidates.
    """
    rows = docs.select(F.col("doc_id").cast("long"), "text").where(F.col("text").rlike(CANDIDATE))
    hits = F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0))
    gaps = F.split("text", CANDIDATE)
    parts = F.transform(
        F.col("h"),
        lambda h, k: F.struct(
            h.alias("found"), F.length(F.get("g", k)).alias("gap"),
            F.substring(F.concat(F.coalesce(F.get("h", k - 1), F.lit("")), F.get("g", k)), -AROUND, AROUND).alias("before"),
            F.substring(F.get("g", k + 1), 1, AROUND).alias("after"),
        ),
    )
    rows = rows.withColumn("_row", F.monotonically_increasing_id()).withColumn("h", hits).withColumn("g", gaps)
    listed = rows.select("doc_id", "_row", F.posexplode(parts).alias("nth", "c")).select("doc_id", "_row", "nth", "c.*")
    upto = Window.partitionBy("_row").orderBy("nth")
    start = F.sum(F.col("gap") + F.length("found")).over(upto) - F.length("found")
    return listed.select("doc_id", start.cast("long").alias("start"), "found", "before", "after")


#: The formats of ``labelled_findings`` that are kept for judging a forest on kinds it has not seen.
HELD_OUT = ("base64 in assignment", "service key", "uuid", "path", "number")


def labelled_findings(spark: SparkSession, knowledge: Knowledge | None = None, rows: int = 6000, seed: str = "findings") -> DataFrame:
    """(found, before, after, label, format): findings of stated formats, made from hashes. label 1: a secret.
    Words in them are taken from a bounded list of the dictionary's, made-up ones without it.

    Half are keys, tokens, passwords and hex or base64 secrets in assignments; half are identifiers, digests after
    words that say so, addresses, paths, dates, numbers, versions, placeholders and long words with a digit.
    """
    ids = spark.range(rows).select(F.col("id"), F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")), 512).alias("x"))
    hex_, b64 = F.col("x"), F.translate(F.base64(F.unhex(F.substring("x", 1, 96))), "+/=", "xY9")
    upper = F.upper(F.translate(b64, "ghijklmn", "GHIJKLMN"))
    d = F.translate(F.substring("x", 20, 40), "abcdef", "012345")
    w = F.translate(F.substring("x", 70, 30), "0123456789", "aeioutrsnl")
    pick = lambda n, *options: F.element_at(F.array(*[F.lit(o) for o in options]), (F.pmod(F.xxhash64("x", F.lit(n)), F.lit(len(options))) + 1).cast("int"))
    size = lambda n, low, high: (F.pmod(F.xxhash64("x", F.lit(n)), F.lit(high - low + 1)) + low).cast("int")
    known = [r["word"] for r in knowledge.words.where(F.length("word").between(4, 9)).orderBy(F.xxhash64("word")).limit(400).collect()] if knowledge else []
    choice = lambda n: F.get(F.array(*[F.lit(k) for k in known]), F.pmod(F.xxhash64("x", F.lit(n)), F.lit(len(known))).cast("int")) if known else F.substring(w, 1 + n % 5, 9)
    ids = cut(ids.withColumns({f"w{n}": choice(n) for n in (22, *range(31, 46))}))
    some = lambda n, short: F.col(f"w{n}") if known else F.substring(F.col(f"w{n}"), 1, short)
    word = F.concat(some(31, 5), F.lit(" "))
    intro = pick(1, "password=", "password: ", "passwd = '", 'token = "', "token: ", "secret=", 'api_key = "', "access key ", "auth token ", "bearer ", "pwd:")
    plain = pick(2, "the ", "of ", "and ", "in ", "it is ", "see ", "on ", "from ")
    camel = F.concat(some(32, 6), F.initcap(some(33, 5)), F.initcap(some(34, 6)))
    kinds = [
        (1, "access key", F.concat(pick(3, "AKIA", "ASIA", "AIza"), F.substring(upper, 1, 16)), word),
        (1, "hex in assignment", F.substring(hex_, F.lit(1), size(4, 16, 64)), F.concat(word, intro)),
        (1, "upper hex in assignment", F.upper(F.substring(hex_, F.lit(1), size(24, 16, 64))), F.upper(F.concat(word, intro))),
        (1, "base64 in assignment", F.substring(b64, F.lit(1), size(5, 14, 64)), F.concat(word, intro)),
        (1, "prefixed token", F.concat(pick(6, "ghp_", "xoxb-", "glpat-"), F.substring(b64, 1, 36)), plain),
        (1, "password of word and signs", F.concat(F.initcap(some(35, 6)), pick(23, "$", "#", "!", "_", "&", "%"), F.substring(b64, F.lit(1), size(7, 4, 12))), F.concat(word, intro)),
        (1, "letters in assignment", F.translate(F.substring(b64, F.lit(1), size(25, 10, 24)), "0123456789", "qXzKvWpJbD"), F.concat(word, intro)),
        (1, "service key", F.concat(pick(8, "sk_live_", "sk-"), F.substring(b64, 1, 24)), plain),
        (0, "digest", F.substring(hex_, 1, 40), pick(9, "commit ", "sha1 ", "checksum ", "digest: ", "ref ", "sha256: ", "md5 ")),
        (0, "uuid", F.concat_ws("-", F.substring("x", 1, 8), F.substring("x", 9, 4), F.substring("x", 13, 4), F.substring("x", 17, 4), F.substring("x", 21, 12)), pick(10, "uuid ", "id ", "the ", "order ")),
        (0, "address", F.concat(some(36, 6), F.lit("."), some(37, 5), F.substring(d, 1, 2), F.lit("@"), some(38, 6), pick(11, ".com", ".org", ".example", ".net")), pick(12, "mail ", "contact ", "the ", "of ", "to ")),
        (0, "link", F.concat(F.lit("//"), some(39, 7), pick(14, ".com/", ".org/", ".net/docs/"), some(40, 5), F.lit("/"), F.substring(d, 1, 4)), F.concat(plain, pick(13, "https:", "http:"))),
        (0, "path", F.concat(pick(15, "/usr/lib/", "src/main/", "/home/user/", "data/"), some(41, 6), F.lit("/"), some(42, 5), F.substring(d, 1, 1), pick(16, ".json", ".html", ".py", ".zip")), plain),
        (0, "phone", F.concat_ws("-", F.substring(d, 1, 3), F.substring(d, 4, 3), F.substring(d, 7, 4)), pick(17, "phone ", "call ", "tel ", "the ", "of ", "+")),
        (0, "number", F.substring(d, F.lit(1), size(18, 12, 19)), pick(19, "isbn ", "order ", "iban ", "the ", "and ", "id ", "number ")),
        (0, "account number", F.concat(F.substring(d, F.lit(1), size(28, 8, 18)), pick(29, "", "", "$$$", "%%%", "###")), F.concat(word, pick(30, "", "card ", "account "))),
        (0, "dotted number", F.concat_ws(".", F.substring(d, 1, 3), F.substring(d, 4, 2), F.substring(d, 6, 3), F.substring(d, 9, 2)), F.concat(word, pick(43, "", "host ", "from "))),
        (0, "time", F.concat(F.lit("20"), F.substring(d, 1, 2), F.lit("-0"), F.substring(d, 3, 1), F.lit("-1"), F.substring(d, 4, 1), F.lit("T1"), F.substring(d, 5, 1)), pick(20, "date ", "on ", "the ")),
        (0, "placeholder", F.concat(pick(21, "example-password-", "your_api_key_", "test-token-", "placeholder_secret_", "changeme-password-", "dummy_token_"), F.substring(d, 1, 3)), F.concat(word, intro)),
        (0, "word in assignment", some(44, 9), F.concat(word, intro)),
        (0, "word with a digit", F.concat(some(22, 9), some(45, 9), F.substring(d, 1, 1)), plain),
        (0, "name in mixed case", camel, plain),
        (0, "version", F.concat_ws(".", F.lit("version"), F.substring(d, 1, 2), F.substring(d, 3, 2), F.substring(d, 5, 4)), plain),
    ]
    good, bad = [k for k in kinds if k[0]], [k for k in kinds if not k[0]]
    place = F.pmod(F.xxhash64("x", F.lit(99)), F.lit(1 << 20))

    def chosen(part: int) -> Column:
        def of(group: list) -> Column:
            return F.element_at(F.array(*[F.lit(k[part]) if part == 1 else k[part] for k in group]), (place % len(group) + 1).cast("int"))

        return F.when(F.col("id") % 2 == 1, of(good)).otherwise(of(bad))

    after = F.when(chosen(3).contains('"'), F.lit('" ')).when(chosen(3).contains("'"), F.lit("' ")).otherwise(F.lit(" "))
    return ids.select(
        chosen(2).alias("found"), F.concat(word, chosen(3)).alias("before"), F.concat(after, word).alias("after"), (F.col("id") % 2).cast("double").alias("label"), chosen(1).alias("format")
    )


def _assembled(found: DataFrame, knowledge: Knowledge) -> DataFrame:
    """Candidates with the forest's inputs. How much dictionary words cover is worked out once for equal candidates."""
    pieces = F.split(F.lower(F.regexp_replace("found", r"(?<=\p{Ll})(?=\p{Lu})", " ")), r"[^\p{L}]+")
    words = found.select("found").distinct().select("found", F.explode(pieces).alias("word"))
    covered = words.join(knowledge.words, "word").groupBy(F.col("found").alias("_found")).agg(F.sum(F.length("word")).alias("_known"))
    full = found.join(covered, F.col("found") == F.col("_found"), "left").drop("_found")
    made = features(F.col("found"), F.coalesce("before", F.lit("")), F.coalesce("after", F.lit("")), F.coalesce("_known", F.lit(0)), knowledge.pairs)
    return VectorAssembler(inputCols=[f"_f_{k}" for k in FEATURES], outputCol="_x").transform(full.withColumns({f"_f_{k}": made[k] for k in FEATURES}))


def fit(findings: DataFrame, knowledge: Knowledge, trees: int = 30, depth: int = 8, seed: int = 7) -> RandomForestClassificationModel:
    """A forest from labelled findings (found, before, after, label); rows with a null or empty found or a null label teach
    nothing. Rows are put in order first, so that the forest doesn't depend on their partitions."""
    good = findings.where("found is not null and label is not null and found <> ''")
    rows = cut(_assembled(good, knowledge).select("_x", F.col("label").cast("double").alias("_y"), F.xxhash64("found", "before", "after").alias("_at")).repartition(4, "_at").sortWithinPartitions("_at"))
    return RandomForestClassifier(featuresCol="_x", labelCol="_y", numTrees=trees, maxDepth=depth, seed=seed, probabilityCol="_p", rawPredictionCol="_raw", predictionCol="_c").fit(rows)


def scan(docs: DataFrame, model: RandomForestClassificationModel, knowledge: Knowledge, threshold: float = 0.5) -> DataFrame:
    """Every candidate of the whole texts: doc_id, start, length, sha256 of the candidate, score (0 to 1), is_secret.

    The candidate itself isn't given on. Null and empty texts have none. Repeated rows, and rows without
    doc_id, give their findings each. Other columns are not read. Empty table: empty result.
    """
    judged = model.transform(_assembled(cut(candidates(docs)), knowledge))
    score = F.element_at(vector_to_array("_p"), 2)
    return judged.select(
        "doc_id", "start", F.length("found").alias("length"), F.sha2("found", 256).alias("sha256"), score.alias("score"), (score >= threshold).alias("is_secret")
    )
