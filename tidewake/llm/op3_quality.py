"""Quality rules: one table of thresholds, compiled into one Spark projection.

Every feature is an integer, every rule a comparison of two integers, and the whole is built
from Spark's own functions; no user function runs.  The lists of words and windows live
in one row of one document, and all steps over them are linear or a sort.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space that parts words.
SPACE = " \t\n\x0b\x0c\r"

SYMBOLS = "#*$%&|<>"

#: Frequent function words of the four languages of the corpus.
STOP_WORDS = {
    "en": "the of and to a in is that it for was on with as be by are this at from or an have not he which but his they you",
    "de": "der die und in den von zu das sich mit des auf für ist im nicht dem ein eine als auch es an werden aus er hat dass sie nach",
    "fr": "de la le et les en des un du une que est pour par dans avec qui pas sur au il ne se ce plus sont ou son cette mais",
    "es": "de la que el en y los las se del un por con no una su para es al lo como más o pero sus le ha este sí porque",
}


@dataclass(frozen=True)
class Rule:
    """``low * over <= 1000 * feature <= high * over``, each side left out where it is None."""

    name: str
    feature: str
    over: str
    low: int | None = None
    high: int | None = None

    def text(self) -> str:
        """The rule as SQL that both Spark and other engines read."""
        sides = []
        if self.low is not None:
            sides.append(f"1000 * {self.feature} >= {self.low} * {self.over}")
        if self.high is not None:
            sides.append(f"1000 * {self.feature} <= {self.high} * {self.over}")
        return "(" + " AND ".join(sides) + ")"


#: Thresholds in thousandths of the feature named in ``over``.
RULES = (
    Rule("word length", "word_chars", "n_words", low=2_500, high=12_000),
    Rule("symbols to words", "n_symbols", "n_words", high=100),
    Rule("stop words to words", "n_stop_words", "n_words", low=20),
    Rule("repeated lines to lines", "n_dup_lines", "n_lines", high=500),
    Rule("bullet lines to lines", "n_bullet_lines", "n_lines", high=900),
    Rule("cut lines to lines", "n_ellipsis_lines", "n_lines", high=300),
)

#: The contract's own bounds.
MIN_WORDS, MAX_REPEATED = 50, 50


def _covered(words: Column, n: Column) -> Column:
    """Words in three-word windows that occur twice or more."""
    windows = F.slice(F.arrays_zip(words.alias("a"), F.slice(words, F.lit(2), n).alias("b"), F.slice(words, F.lit(3), n).alias("c"), F.sequence(F.lit(0), n - 1).alias("p")), F.lit(1), n - 2)
    return F.when(n >= 3, F.sort_array(windows))


def features(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns of ``keep`` and the integer features of ``text``; null text has no words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    visible = lambda c: F.length(F.translate(c, SPACE, "")) > 0
    all_stop = sorted({w for v in STOP_WORDS.values() for w in v.split()})
    d = docs.select(*keep, text.alias("_text"))
    d = d.select(
        *keep,
        "_text",
        F.array_remove(F.split(F.translate("_text", SPACE, " " * len(SPACE)), " "), "").alias("_words"),
        F.filter(F.split("_text", "\n"), visible).alias("_lines"),
    )
    d = d.select(
        *keep,
        F.length(F.translate("_text", SPACE, "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("_lines", lambda x: F.ltrim(x).substr(1, 1).isin("-", "*", "•"))).cast("long").alias("n_bullet_lines"),
        F.size(F.filter("_lines", lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…"))).cast("long").alias("n_ellipsis_lines"),
        F.size(F.filter("_words", lambda w: F.lower(w).isin(all_stop))).cast("long").alias("n_stop_words"),
        F.size("_words").cast("long").alias("n_words"),
        _covered(F.col("_words"), F.size("_words")).alias("_sorted"),
    )
    # Equal windows stand side by side after the sort; the first of them has the lowest place.
    same = F.zip_with(
        F.slice("_sorted", F.lit(1), F.size("_sorted") - 1),
        F.slice("_sorted", F.lit(2), F.size("_sorted")),
        lambda x, y: (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"]),
    )
    rest = [c for c in d.columns if c != "_sorted"]
    d = d.select(*rest, "_sorted", F.when(F.size("_sorted") >= 2, same).alias("_same"))
    found = F.filter("_sorted", lambda x, i: F.coalesce(F.get("_same", i), F.lit(False)) | F.coalesce(F.get("_same", i - 1), F.lit(False)))
    places = F.when(F.array_contains("_same", True), F.sort_array(F.transform(found, lambda x: x["p"])))
    d = d.select(*rest, places.alias("_places"))
    gaps = F.zip_with(F.slice("_places", F.lit(2), F.size("_places")), F.slice("_places", F.lit(1), F.size("_places") - 1), lambda x, y: F.least(x - y, F.lit(3)))
    covered = F.when(F.size("_places") >= 2, F.aggregate(gaps, F.lit(3), lambda a, x: a + x))
    d = d.select(*rest, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))
    # One struct in an array, taken out again: a filter on a feature stops here.  Pushed further
    # down it would take all steps above with it, each once for every time that it is named.
    return d.select(F.explode_outer(F.array(F.struct("*"))).alias("_f")).select("_f.*")


def judge(docs: DataFrame, keep: list[str] = ["doc_id"], rules: tuple[Rule, ...] = RULES) -> DataFrame:  # noqa: B006
    """``keep``, the features, base_failed and kept for every row of ``docs``.

    A null or empty text has no words and fails the base; repeated rows are judged each for
    itself; other columns are not read unless named in ``keep`` (none of them may be called
    like a feature).  One projection: nothing is shuffled.
    """
    base = F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words")
    verdict = F.expr(" AND ".join(r.text() for r in rules))
    d = features(docs, keep)
    return d.withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & verdict)


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns only."""
    held = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    judged = judge(docs.select(held, "text"), ["_row"])
    return judged.filter("kept").select("_row.*")


#: The contract's columns in DuckDB's SQL.
SQL = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
win AS (SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
dup AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM win) WHERE n > 1),
cov AS (SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM dup, (SELECT unnest([0, 1, 2]) AS k) GROUP BY rid),
f AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
             CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
             CAST(len(list_filter(lines, lambda x: ltrim(x)[1] IN ('-', '*', '•'))) AS BIGINT) AS n_bullet_lines,
             CAST(len(list_filter(lines, lambda x: rtrim(x, ' ') LIKE '%...' OR rtrim(x, ' ') LIKE '%…')) AS BIGINT) AS n_ellipsis_lines,
             CAST(len(list_filter(words, lambda x: list_contains([{stop}], lower(x)))) AS BIGINT) AS n_stop_words,
             CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN cov USING (rid)),
b AS (SELECT *, (n_words < {min_words} OR 100 * n_repeat_words > {max_repeated} * n_words) AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, (NOT base_failed AND {verdict}) AS kept FROM b
""".format(
    stop=", ".join("'" + w + "'" for w in sorted({w for v in STOP_WORDS.values() for w in v.split()})),
    min_words=MIN_WORDS,
    max_repeated=MAX_REPEATED,
    verdict=" AND ".join(r.text() for r in RULES),
)
