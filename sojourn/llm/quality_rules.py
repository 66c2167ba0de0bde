"""Operator 6: quality rules by distribution divergence, in DataFrame functions only.

A document's histogram of character classes and of its language's common words is held against
the language's reference, which is the sum over all documents of that language long enough to
count, by Jensen-Shannon distance (base 2, from 0 to 1). Short texts are guarded: a distance is
only judged from a minimum length on, and by a limit that is wider for shorter texts, which chance
alone moves farther. The filter and the query op6 judge alike.

Cases: a null text counts as empty; an empty text has no words and fails the base rule; a null or
unlisted language is a language of its own without common words, so only characters are compared;
repeated rows are judged alike; extra columns are kept; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, stage, table, text_or_empty

# Frequent function words by language.
COMMON_WORDS: dict[str, tuple[str, ...]] = {
    "de": ("als", "auf", "das", "dem", "den", "der", "des", "die", "ein", "eine", "für", "ist", "mit", "nicht", "sich", "und", "von", "zu"),
    "en": ("a", "and", "are", "as", "at", "be", "for", "from", "in", "is", "it", "of", "on", "or", "that", "the", "this", "to", "was", "with"),
    "es": ("a", "con", "de", "del", "el", "en", "es", "la", "las", "los", "no", "para", "por", "que", "se", "su", "un", "una", "y"),
    "fr": ("avec", "dans", "de", "des", "du", "elle", "en", "est", "et", "il", "la", "le", "les", "par", "pas", "pour", "que", "qui", "un", "une"),
}
SYMBOLS = "#*$%&|<>"
#: Classes taken off in this order; what is left over is the last class.
CLASSES = (
    ("lower", "[a-z]+"),
    ("space", "[ \\t\\n\\x0B\\f\\r]+"),
    ("upper", "[A-Z]+"),
    ("digit", "[0-9]+"),
    ("symbol", "[#*$%&|<>]+"),
    ("punct", "[!-/:-@\\[-`{-~]+"),
)
N_CLASSES = len(CLASSES) + 1


@dataclass(frozen=True)
class DivergenceRules:
    """Limits of the verdict; lengths are code points and words."""

    max_char_distance: float = 0.30
    #: Limits of the word distance, each from a number of words on, the longest first.
    word_limits: tuple[tuple[int, float], ...] = ((100, 0.26), (50, 0.30))
    min_chars: int = 300
    min_reference_words: int = 50
    common_words: dict = field(default_factory=lambda: dict(COMMON_WORDS))


def _words_of(name: str) -> Column:
    trimmed = F.btrim(F.col(name), F.lit(WHITE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \\t\\n\\x0B\\f\\r]+"))


def base_counts(docs: DataFrame, rules: DivergenceRules = DivergenceRules(), text: str = "text", lang: str = "lang") -> DataFrame:
    """docs with the working columns of every count the rules read (prefix _x_)."""
    df = docs.withColumn("_x_text", text_or_empty(text)).withColumn("_x_words", _words_of("_x_text"))
    left, lengths = "_x_text", [F.length("_x_text")]
    for i, (_, pattern) in enumerate(CLASSES):
        df = df.withColumn(f"_x_left{i}", F.regexp_replace(left, pattern, ""))
        left = f"_x_left{i}"
        lengths.append(F.length(left))
    taken = [before - after for before, after in zip(lengths, lengths[1:], strict=False)] + [lengths[-1]]
    df = df.withColumn("_x_chars", F.array(*[c.cast("long") for c in taken]))
    df = df.withColumn("_x_n_words", F.size("_x_words").cast("long"))

    # words in 3-word windows found twice or more
    triple = F.transform(
        F.sequence(F.lit(0), F.col("_x_n_words").cast("int") - 3),
        lambda i: F.struct(F.xxhash64(F.get("_x_words", i), F.get("_x_words", i + 1), F.get("_x_words", i + 2)).alias("h"), i.alias("p")),
    )
    df = df.withColumn("_x_triples", F.when(F.col("_x_n_words") >= 3, F.sort_array(triple)))
    hash_at = lambda j: F.get("_x_triples", j)["h"]
    twice = F.filter("_x_triples", lambda t, j: t["h"].eqNullSafe(hash_at(j - 1)) | t["h"].eqNullSafe(hash_at(j + 1)))
    df = df.withColumn("_x_twice", twice)
    covered = F.size(F.array_distinct(F.flatten(F.transform("_x_twice", lambda t: F.array(t["p"], t["p"] + 1, t["p"] + 2)))))
    df = df.withColumn("_x_n_repeat_words", F.when(F.col("_x_n_words") >= 3, covered).otherwise(0).cast("long"))

    df = df.withColumn("_x_lines", F.filter(F.split("_x_text", "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != ""))
    df = df.withColumn("_x_n_dup_lines", (F.size("_x_lines") - F.size(F.array_distinct("_x_lines"))).cast("long"))
    symbols = F.col("_x_chars")[4]
    df = df.withColumn("_x_n_symbols", symbols).withColumn("_x_word_chars", (F.length("_x_text") - F.col("_x_chars")[1]).cast("long"))
    df = df.withColumn("_x_base_failed", (F.col("_x_n_words") < 50) | (100 * F.col("_x_n_repeat_words") > 50 * F.col("_x_n_words")))

    # the language's common words, and all others
    df = df.withColumn("_x_lang", F.coalesce(F.col(lang).cast("string"), F.lit("")))
    all_common = sorted({w for ws in rules.common_words.values() for w in ws})
    df = df.withColumn("_x_found", F.filter("_x_words", lambda w: w.isin(all_common)))
    listed = F.lit(None).cast("array<string>")
    for name, ws in rules.common_words.items():
        listed = F.when(F.col("_x_lang") == name, F.array(*[F.lit(w) for w in ws])).otherwise(listed)
    df = df.withColumn("_x_listed", listed)
    df = df.withColumn("_x_common", F.transform("_x_listed", lambda c: F.size(F.filter("_x_found", lambda w: w == c)).cast("long")))
    spent = F.aggregate("_x_common", F.lit(0).cast("long"), lambda a, x: a + x)
    df = df.withColumn("_x_common", F.concat("_x_common", F.array(F.col("_x_n_words") - spent)))
    return df.drop("_x_text", "_x_words", "_x_lines", "_x_triples", "_x_twice", "_x_found", "_x_listed", *[f"_x_left{i}" for i in range(len(CLASSES))])


def references(counted: DataFrame, rules: DivergenceRules = DivergenceRules()) -> DataFrame:
    """One row per language: summed histograms of all its documents with min_reference_words words or more."""
    most = max(map(len, rules.common_words.values()), default=0) + 1
    long = counted.where(F.col("_x_n_words") >= rules.min_reference_words)
    sums = [F.sum(F.get("_x_chars", F.lit(i))).alias(f"c{i}") for i in range(N_CLASSES)] + [F.sum(F.get("_x_common", F.lit(i))).alias(f"w{i}") for i in range(most)]
    summed = long.groupBy("_x_lang").agg(*sums)
    chars = F.array(*[f"c{i}" for i in range(N_CLASSES)])
    common = F.filter(F.array(*[f"w{i}" for i in range(most)]), lambda x: x.isNotNull())
    return summed.select(F.col("_x_lang").alias("_x_ref_lang"), chars.alias("_x_ref_chars"), common.alias("_x_ref_common"))


def js_distance(a: Column, b: Column) -> Column:
    """Jensen-Shannon distance of two histograms of one length; null where either holds nothing."""
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda s, x: s + x)
    term = lambda p, m: F.when(p > 0, p * F.log2(p / m)).otherwise(0.0)
    part = lambda x, y: (term(x, (x + y) / 2) + term(y, (x + y) / 2)) / 2
    sum_a, sum_b = total(a), total(b)
    divergence = total(F.zip_with(F.transform(a, lambda x: x / sum_a), F.transform(b, lambda y: y / sum_b), part))
    return F.when((sum_a > 0) & (sum_b > 0), F.sqrt(F.greatest(F.lit(0.0), divergence)))


def judged(counted: DataFrame, reference: DataFrame, rules: DivergenceRules = DivergenceRules()) -> DataFrame:
    """counted with _x_char_distance, _x_word_distance and the verdict _x_kept."""
    df = counted.join(reference, F.col("_x_lang") == F.col("_x_ref_lang"), "left").drop("_x_ref_lang")
    df = df.withColumn("_x_n_chars", F.aggregate("_x_chars", F.lit(0).cast("long"), lambda a, x: a + x))
    long_enough = F.col("_x_n_words") >= rules.min_reference_words
    df = df.withColumn("_x_char_distance", F.when(long_enough & (F.col("_x_n_chars") >= rules.min_chars), js_distance(F.col("_x_chars"), F.col("_x_ref_chars"))))
    word_limit = F.lit(None).cast("double")
    for least, limit in reversed(rules.word_limits):
        word_limit = F.when(F.col("_x_n_words") >= least, F.lit(limit)).otherwise(word_limit)
    df = df.withColumn("_x_word_distance", F.when(long_enough & word_limit.isNotNull(), js_distance(F.col("_x_common"), F.col("_x_ref_common"))))
    bad = F.coalesce(F.col("_x_char_distance") > rules.max_char_distance, F.lit(False)) | F.coalesce(F.col("_x_word_distance") > word_limit, F.lit(False))
    # one expression over both sides of the join: a part of the left alone would be pushed down, its steps inlined and repeated
    return df.withColumn("_x_kept", F.when(F.col("_x_base_failed"), False).otherwise(~bad))


def apply_quality_rules(docs: DataFrame, rules: DivergenceRules = DivergenceRules()) -> DataFrame:
    """The documents kept, all their columns, nothing shuffled but the references.

    Texts are counted once and written with their counts, from which the references and the verdicts are read. The
    references are one small row per language; the join to them is left to Spark's size check.
    """
    counted = stage(base_counts(docs, rules), "quality-counted")
    reference = stage(references(counted, rules), "references")  # written, so that its size is known before texts would be moved
    return judged(counted, reference, rules).where("_x_kept").select(*docs.columns)


def op6_divergence_rules(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    counted = stage(base_counts(docs).drop("text"), "quality-counts")
    out = judged(counted, references(counted))
    millionths = lambda c: F.round(F.col(c) * 1_000_000).cast("long")
    return out.select(
        "doc_id",
        F.col("_x_n_words").alias("n_words"),
        F.col("_x_word_chars").alias("word_chars"),
        F.col("_x_n_symbols").alias("n_symbols"),
        F.col("_x_n_dup_lines").alias("n_dup_lines"),
        F.col("_x_n_repeat_words").alias("n_repeat_words"),
        F.col("_x_base_failed").alias("base_failed"),
        F.col("_x_kept").alias("kept"),
        millionths("_x_char_distance").alias("char_distance_millionths"),
        millionths("_x_word_distance").alias("word_distance_millionths"),
    )


def _list(words: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def oracle(rules: DivergenceRules = DivergenceRules()) -> str:
    """The same result as DuckDB SQL."""
    lengths = ["length(t)"] + [f"length(t{i})" for i in range(len(CLASSES))]
    nested = "t"
    lines = []
    for i, (_, pattern) in enumerate(CLASSES):
        lines.append(f"s{i} AS (SELECT *, regexp_replace({nested}, '{pattern.replace('x0B', 'x0b')}', '', 'g') AS t{i} FROM {'s' + str(i - 1) if i else 'docs'})")
        nested = f"t{i}"
    chars = "[" + ", ".join([f"{a} - {b}" for a, b in zip(lengths, lengths[1:], strict=False)] + [lengths[-1]]) + "]"
    listed = " ".join(f"WHEN '{k}' THEN {_list(v)}" for k, v in rules.common_words.items())
    word_limit = " ".join(f"WHEN n_words >= {least} THEN {limit}::DOUBLE" for least, limit in rules.word_limits)
    distance = lambda a, b: (
        f"(SELECT CASE WHEN sum(x) > 0 AND sum(y) > 0 THEN sqrt(greatest(0.0, sum((CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2))) END"
        f" FROM (SELECT x, y, x / sum(x) OVER () AS p, y / sum(y) OVER () AS q FROM (SELECT unnest({a})::DOUBLE AS x, unnest({b})::DOUBLE AS y)))"
    )
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS t FROM documents),
{", ".join(lines)},
words AS (
  SELECT r, doc_id, lang, t, {chars} AS chars, regexp_extract_all(t, '[^ \\t\\n\\x0b\\f\\r]+') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \\t\\n\\x0b\\f\\r]')) AS ls
  FROM s{len(CLASSES) - 1}),
windows AS (
  SELECT r, p, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM (
    SELECT r, unnest(range(1, len(w) - 1)) AS p, unnest(w[:-3]) AS a, unnest(w[2:-2]) AS b, unnest(w[3:]) AS c FROM words WHERE len(w) >= 3)),
covered AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest([p, p + 1, p + 2]) AS q FROM windows WHERE n > 1) GROUP BY r),
counted AS (
  SELECT words.*, len(w) AS n_words, length(t) - chars[2] AS word_chars, chars[5] AS n_symbols,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
         CASE lang {listed} END AS listed
  FROM words LEFT JOIN covered USING (r)),
hist AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         list_transform(listed, lambda c: len(list_filter(w, lambda x: x = c))) AS found FROM counted),
full_hist AS (SELECT *, CASE WHEN listed IS NOT NULL THEN list_append(found, n_words - list_sum(found)) END AS common FROM hist),
ref_chars AS (
  SELECT lang, list(s ORDER BY i) AS ref_chars FROM (
    SELECT lang, i, sum(v) AS s FROM (SELECT lang, unnest(chars) AS v, unnest(range(len(chars))) AS i FROM full_hist WHERE n_words >= {rules.min_reference_words}) GROUP BY lang, i) GROUP BY lang),
ref_common AS (
  SELECT lang, list(s ORDER BY i) AS ref_common FROM (
    SELECT lang, i, sum(v) AS s FROM (SELECT lang, unnest(common) AS v, unnest(range(len(common))) AS i FROM full_hist WHERE n_words >= {rules.min_reference_words}) GROUP BY lang, i) GROUP BY lang),
judged AS (
  SELECT f.*,
         CASE WHEN n_words >= {rules.min_reference_words} AND length(t) >= {rules.min_chars} THEN {distance("chars", "ref_chars")} END AS dc,
         CASE WHEN n_words >= {rules.min_reference_words} AND word_limit IS NOT NULL THEN {distance("common", "ref_common")} END AS dw
  FROM (SELECT *, CASE {word_limit} END AS word_limit FROM full_hist) f LEFT JOIN ref_chars USING (lang) LEFT JOIN ref_common USING (lang))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND coalesce(dc <= {rules.max_char_distance}, true) AND coalesce(dw <= word_limit, true) AS kept,
       round(dc * 1000000)::BIGINT AS char_distance_millionths, round(dw * 1000000)::BIGINT AS word_distance_millionths
FROM judged
"""
