"""Operator 9: quality rules. A table of thresholds compiled into one projection of built-in functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colonnade.llm.common import bind, documents, lines, strip, words

#: Languages that STOP_WORDS has words of; texts known to be of another are not judged by them.
LISTED = ("en", "de", "fr", "es")
#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is it that for on was with as be at by this are from or an not "
    "der die das und zu den von mit ist im des auf für ein sich dem nicht eine als "
    "le la les de et un une du est dans que pour par sur des au en avec ce "
    "el los las y del que por con una se su al para es lo más"
).split()  # fixed values


@dataclass(frozen=True)
class Rule:
    """A document breaks the rule if ``measure`` per ``per`` is outside ``least`` .. ``most`` (percent of ``per``)."""

    name: str
    measure: str
    per: str
    least: int | None = None
    most: int | None = None
    listed_only: bool = False  # left out for texts of a language without stop words here

    def broken(self, measures: Column) -> Column:
        share, whole = measures[self.measure] * 100, measures[self.per]
        tests = []
        if self.least is not None:
            tests.append(share < whole * self.least)
        if self.most is not None:
            tests.append(share > whole * self.most)
        return tests[0] if len(tests) == 1 else tests[0] | tests[1]


#: Percentages: a word has 2 to 12 characters on average, one symbol at most comes on ten words, and so on.
RULES = (
    Rule("word_length", "word_chars", "n_words", least=200, most=1200),
    Rule("symbols", "n_symbols", "n_words", most=10),
    Rule("exclamations", "n_exclamations", "n_words", most=30),
    Rule("stop_words", "n_stop_words", "n_words", least=4, listed_only=True),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", most=50),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", most=30),
)
BASE = (
    Rule("few_words", "n_words", "one", least=5000),
    Rule("repeated_words", "n_repeat_words", "n_words", most=50),
)
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(found: Column) -> Column:
    """How many words stand in a window of three words that the same text holds twice or more.

    Windows are sorted by a 64-bit hash; neighbours of one hash are equal windows. The places they start at, in
    order, then cover three words each, less what the place before has covered.
    """
    starts = F.sequence(F.lit(0), F.size(found) - 3)
    keyed = F.transform(
        starts, lambda i: F.struct(F.xxhash64(found[i], found[i + 1], found[i + 2]).alias("h"), i.alias("i"))
    )

    def places(ordered: Column) -> Column:
        return F.filter(
            F.transform(
                ordered,
                lambda row, k: F.when(
                    (F.get(ordered, k - 1)["h"].eqNullSafe(row["h"])) | (F.get(ordered, k + 1)["h"].eqNullSafe(row["h"])),
                    row["i"],
                ),
            ),
            lambda place: place.isNotNull(),
        )

    def covered(place: Column) -> Column:
        begin = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-3).alias("last"))
        step = lambda state, p: F.struct(
            (state["n"] + F.least(F.lit(3), p - state["last"])).alias("n"), p.alias("last")
        )
        return F.aggregate(place, begin, step, lambda state: state["n"])

    repeated = bind(F.sort_array(keyed), lambda ordered: covered(F.sort_array(places(ordered))))
    return F.when(F.size(found) < 4, F.lit(0).cast("bigint")).otherwise(repeated)


def measure(text: Column) -> Column:
    """All measures of one text as a struct. Null reads as an empty text, which has one line and no word."""
    whole = F.coalesce(text, F.lit(""))

    def counted(found: Column) -> Column:
        filled = F.filter(lines(text), lambda line: strip(line) != "")
        ends = F.filter(lines(text), lambda line: F.rtrim(line).endswith("...") | F.rtrim(line).endswith("…"))
        without = lambda marks: F.length(whole) - F.length(F.regexp_replace(whole, marks, ""))
        fields = {
            "one": F.lit(1),
            "n_words": F.size(found),
            "word_chars": F.length(F.array_join(found, "")),
            "n_symbols": without(r"[#*$%&|<>]"),
            "n_exclamations": without(r"[!?]"),
            "n_stop_words": F.size(F.filter(found, lambda word: word.isin(*STOP_WORDS))),
            "n_lines": F.size(filled),
            "n_dup_lines": bind(filled, lambda kept: F.size(kept) - F.size(F.array_distinct(kept))),
            "n_ellipsis_lines": F.size(ends),
            "n_repeat_words": repeated_words(found),
        }
        return F.struct(*(column.cast("bigint").alias(name) for name, column in fields.items()))

    return bind(words(text), counted)


def apply_rules(docs: DataFrame, text: str = "text", into: str = "quality_rules", lang: str | None = None) -> DataFrame:
    """The documents with a struct column ``into``: the measures, ``base_failed``, ``broken`` (names) and ``kept``.

    One projection, no shuffle. Null and empty texts count as no words and fail the base rules; very long texts
    take time in proportion to n log n; repeated rows are judged alike; a column that is called ``into`` already
    is replaced; an empty table stays empty. ``lang`` names a column of language codes: where it has a language that
    there are no stop words of, that rule is left out; null, and no such column, leave it in.
    """
    listed = F.coalesce(F.col(lang).cast("string").isin(*LISTED), F.lit(True)) if lang else F.lit(True)
    verdict = bind(measure(F.col(text)), lambda measures: _verdict(measures, listed))
    return docs.withColumn(into, verdict)


def _verdict(measures: Column, listed: Column) -> Column:
    def fails(rule: Rule) -> Column:
        return rule.broken(measures) & listed if rule.listed_only else rule.broken(measures)

    base = BASE[0].broken(measures) | BASE[1].broken(measures)
    broken = F.filter(
        F.array(*(F.when(fails(rule), F.lit(rule.name)) for rule in (*BASE, *RULES))),
        lambda name: name.isNotNull(),
    )
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_lines")
    return F.struct(
        *(measures[name].alias(name) for name in names),
        base.alias("base_failed"),
        broken.alias("broken"),
        (F.size(broken) == 0).alias("kept"),
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = apply_rules(documents(spark, sf_dir).select("doc_id", "text", "lang"), lang="lang")
    fields = (*MEASURES, "base_failed", "kept")
    return judged.select("doc_id", *(F.col(f"quality_rules.{name}").alias(name) for name in fields))


ORACLE = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         coalesce(lang IN {LISTED}, true) AS listed FROM documents
), w AS (
  SELECT r, doc_id, text, listed, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '(\\.\\.\\.|…) *$')) AS es
  FROM d
), g AS (
  SELECT r, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)
), rep AS (
  SELECT r, i FROM g JOIN (SELECT r, a, b, c FROM g GROUP BY ALL HAVING count(*) >= 2) USING (r, a, b, c)
), cov AS (
  SELECT r, count(DISTINCT p) AS n_repeat_words FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY r
), m AS (
  SELECT doc_id, listed, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words,
         length(text) - length(regexp_replace(text, '[!?]', '', 'g')) AS n_exclamations,
         len(list_filter(ws, lambda x: list_contains({STOP_WORDS!r}, x))) AS n_stop_words,
         len(ls) AS n_lines, len(es) AS n_ellipsis_lines
  FROM w LEFT JOIN cov USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words
            OR 100 * word_chars < 200 * n_words OR 100 * word_chars > 1200 * n_words
            OR 100 * n_symbols > 10 * n_words OR 100 * n_exclamations > 30 * n_words
            OR listed AND 100 * n_stop_words < 4 * n_words
            OR 100 * n_dup_lines > 50 * n_lines OR 100 * n_ellipsis_lines > 30 * n_lines) AS kept
FROM m
"""
