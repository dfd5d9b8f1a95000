"""Quality rules by distribution divergence, in DataFrame functions only.

A document's histograms of character classes and of common words are compared with those of its language
by the Jensen-Shannon distance. The reference of a language sums the histograms of all its documents that
are long enough. Short texts, whose histograms say little, are not judged by divergence, and neither are
documents of a language without reference.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradepanel.llm.common import with_fields

# Frequent function words, by language.
COMMON_WORDS: dict[str, list[str]] = {
    "en": "the of and to in is that it was for on as with by are this".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par".split(),
    "es": "de la que el en y a los se del las un por con una su".split(),
}
LEAST_WORDS = 50  # below, the base rule fails and no text adds to a reference
LEAST_CHARS = 200  # below, character classes are not judged
LEAST_JUDGED_WORDS = 80  # below, common words are not judged
MOST_CLASS_DISTANCE = 0.30
MOST_WORD_DISTANCE = 0.28
CLASSES = ("upper", "digit", "space", "stop", "symbol", "rest")


def _counted(docs: DataFrame, common: Mapping[str, Sequence[str]]) -> DataFrame:
    """Adds the words and the two histograms of every row, under names that start with an underscore."""
    words = F.create_map(*[x for k, v in common.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    out = docs.withColumns({"_text": text, "_lang": F.col("lang").cast("string")})
    out = out.withColumns({"_words": F.expr(r"filter(split(_text, r'[\x20\x09-\x0D]+'), w -> w <> '')"), "_list": words[F.col("_lang")]})
    out = out.withColumns(
        {
            "_n": F.size("_words").cast("long"),
            "_word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "_length": F.length("_text").cast("long"),
            "_upper": F.expr(r"cast(regexp_count(_text, r'\p{Lu}') as long)"),
            "_digit": F.expr("cast(regexp_count(_text, '[0-9]') as long)"),
            "_stop": F.expr("cast(regexp_count(_text, '[.,;:!?]') as long)"),
            "_symbol": F.expr("cast(regexp_count(_text, '[#*$%&|<>]') as long)"),
            "_found": F.expr("filter(_words, w -> array_contains(_list, w))"),
        }
    )
    out = out.withColumn("_space", F.col("_length") - F.col("_word_chars"))
    rest = F.col("_length") - sum((F.col(f"_{c}") for c in CLASSES[:-1]), F.lit(0))
    each = F.expr("transform(_list, c -> cast(size(filter(_found, w -> w = c)) as long))")
    return out.withColumns(
        {
            "_classes": F.array(*[F.col(f"_{c}") for c in CLASSES[:-1]], rest),
            "_common": F.concat(each, F.array(F.col("_n") - F.size("_found"))),
        }
    )


def references(docs: DataFrame, common: Mapping[str, Sequence[str]] = COMMON_WORDS) -> DataFrame:
    """Summed histograms of each language of ``common``: one row per language at most."""
    counted = _counted(docs.select("lang", "text"), common).where(F.col("_list").isNotNull() & (F.col("_n") >= LEAST_WORDS))
    longest = max(map(len, common.values())) + 1
    sums = [F.sum(F.col("_classes")[i]).alias(f"c{i}") for i in range(len(CLASSES))]
    sums += [F.sum(F.get(F.col("_common"), F.lit(i))).alias(f"w{i}") for i in range(longest)]
    summed = counted.groupBy("_lang").agg(*sums)
    return summed.select(
        "_lang",
        F.array(*[F.col(f"c{i}") for i in range(len(CLASSES))]).alias("_ref_classes"),
        F.expr("filter(array(" + ", ".join(f"w{i}" for i in range(longest)) + "), x -> x is not null)").alias("_ref_common"),
    )


def distance(a: str, b: str) -> Column:
    """Jensen-Shannon distance, in [0, 1], of two array columns of counts; null if one has no counts."""
    total = "aggregate({0}, 0L, (s, x) -> s + x)"
    share = f"zip_with({a}, {b}, (x, y) -> struct(x / {total.format(a)} as p, y / {total.format(b)} as q))"
    one = "case when {0} > 0 then {0} * ln(2 * {0} / (z.p + z.q)) else 0D end"
    divergence = f"aggregate(transform({share}, z -> {one.format('z.p')} + {one.format('z.q')}), 0D, (s, x) -> s + x) / (2 * ln(2D))"
    return F.expr(f"case when {total.format(a)} > 0 and {total.format(b)} > 0 then sqrt(greatest(0D, {divergence})) end")


def quality_rules(
    docs: DataFrame, common: Mapping[str, Sequence[str]] = COMMON_WORDS,
    most_class_distance: float = MOST_CLASS_DISTANCE, most_word_distance: float = MOST_WORD_DISTANCE,
) -> DataFrame:
    """``docs`` with ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed``,
    ``class_distance``, ``word_distance`` and ``kept``; columns of these names give way, all others stay.

    ``base_failed``: fewer than 50 words, or over half of them in three-word windows that occur twice or
    more. ``kept``: the base holds and neither distance is too large. A distance is null, and not
    judged, for short texts and for languages without reference (null among them). A null text counts
    as empty: no words, base failed. Repeated rows and ties are judged alike; they add to the reference
    each. An empty table gives an empty one.

    Two scans: one sums the references (a row per language, broadcast), one judges each row by itself. Windows
    are found by sorting a document's window hashes, so work is n log n in its words.
    """
    name = "_doc"
    kept_columns = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    inner = docs.select(kept_columns.alias(name), F.col("text"), F.col("lang"))
    out = _counted(inner, common).withColumns(
        {
            "_lines": F.expr(r"filter(split(_text, '\n'), l -> l rlike r'[^\x20\x09-\x0D]')"),
            "_windows": F.expr(
                "case when _n >= 3 then sort_array(transform(sequence(0, cast(_n as int) - 3),"
                " i -> struct(xxhash64(_words[i], _words[i + 1], _words[i + 2]) as h, i as i))) else array() end"
            ),
        }
    )
    out = out.withColumns(
        {
            "_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_places": F.expr(
                "sort_array(transform(filter(_windows, (x, k) -> x.h = get(_windows, k - 1).h or x.h = get(_windows, k + 1).h), x -> x.i))"
            ),
        }
    )
    # Places of windows in order: each covers three words, less what the next one covers too.
    covered = F.expr(
        "case when size(_places) = 0 then 0L else 3L + aggregate(zip_with(slice(_places, 2, greatest(size(_places) - 1, 0)),"
        " slice(_places, 1, size(_places) - 1), (b, a) -> cast(least(3, b - a) as long)), 0L, (s, x) -> s + x) end"
    )
    out = out.withColumn("_repeat", covered).join(F.broadcast(references(docs, common)), "_lang", "left")
    failed = (F.col("_n") < LEAST_WORDS) | (F.lit(100) * F.col("_repeat") > F.lit(50) * F.col("_n"))
    out = out.withColumns(
        {
            "_failed": failed,
            "_class_distance": F.when(F.col("_length") >= LEAST_CHARS, distance("_classes", "_ref_classes")),
            "_word_distance": F.when(F.col("_n") >= LEAST_JUDGED_WORDS, distance("_common", "_ref_common")),
        }
    )
    near = (F.coalesce("_class_distance", F.lit(0.0)) <= most_class_distance) & (F.coalesce("_word_distance", F.lit(0.0)) <= most_word_distance)
    new = {
        "n_words": F.col("_n"), "word_chars": F.col("_word_chars"), "n_symbols": F.col("_symbol"), "n_dup_lines": F.col("_dup_lines"),
        "n_repeat_words": F.col("_repeat"), "base_failed": F.col("_failed"), "class_distance": F.col("_class_distance"),
        "word_distance": F.col("_word_distance"), "kept": ~F.col("_failed") & near,
    }
    taken = {n.lower() for n in new}
    old = [F.col(name)[c].alias(c) for c in docs.columns if c.lower() not in taken]
    # One row made of one row: a caller's filter on a result must not be pushed down into the steps above, where
    # every element of an array would then compute the whole array again.
    out = out.select(name, F.explode(F.array(F.struct(*[c.alias(n) for n, c in new.items()]))).alias("_new"))
    return out.select(*old, *[F.col("_new")[n].alias(n) for n in new])


def _sql() -> str:
    lists = " UNION ALL ".join("SELECT '{}' AS lang, [{}] AS list".format(k, ", ".join(f"'{w}'" for w in v)) for k, v in COMMON_WORDS.items())
    names = ["c_upper", "c_digit", "c_space", "c_stop", "c_symbol", "c_rest"]
    count = lambda c: f"(length(t) - length(regexp_replace(t, '{c}', '', 'g')))"

    def js(p: str, q: str) -> str:
        term = f"CASE WHEN {{0}} > 0 THEN {{0}} * ln(2 * {{0}} / ({p}[i] / list_sum({p}) + {q}[i] / list_sum({q}))) ELSE 0 END"
        u, v = f"({p}[i] / list_sum({p}))", f"({q}[i] / list_sum({q}))"
        return f"sqrt(greatest(0, list_sum([{term.format(u)} + {term.format(v)} for i in range(1, len({p}) + 1)]) / (2 * ln(2))))"

    return rf"""
WITH lists AS ({lists}),
d AS (SELECT row_number() OVER () AS r, doc_id, documents.lang, coalesce(text, '') AS t, list,
      [x for x in regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') if x <> ''] AS w,
      [x for x in string_split(coalesce(text, ''), chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] AS l
      FROM documents LEFT JOIN lists ON documents.lang = lists.lang),
win AS (SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS c
        FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
rep AS (SELECT r, count(DISTINCT i + k) AS n_repeat FROM win, (SELECT unnest([0, 1, 2]) AS k) WHERE c >= 2 GROUP BY r),
h AS (SELECT d.*, len(w)::BIGINT AS n, length(array_to_string(w, ''))::BIGINT AS word_chars,
      coalesce(n_repeat, 0)::BIGINT AS n_repeat, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup,
      {count('[#*$%&|<>]')}::BIGINT AS c_symbol, {count('[0-9]')}::BIGINT AS c_digit, {count('[.,;:!?]')}::BIGINT AS c_stop,
      {count(chr(92) + 'p{Lu}')}::BIGINT AS c_upper, length(t) - length(array_to_string(w, '')) AS c_space,
      [len([y for y in w if y = x]) for x in list] AS found
      FROM d LEFT JOIN rep USING (r)),
g AS (SELECT *, [c_upper, c_digit, c_space, c_stop, c_symbol, length(t) - c_upper - c_digit - c_space - c_stop - c_symbol] AS classes,
      list_concat(found, [n - list_sum(found)]) AS common FROM h),
ref AS (SELECT lang AS ref_lang, [{', '.join(f'sum(classes[{i}])' for i in range(1, 7))}] AS ref_classes,
        [{', '.join(f'sum(common[{i}])' for i in range(1, 18))}] AS ref_common FROM g WHERE list IS NOT NULL AND n >= {LEAST_WORDS} GROUP BY lang),
j AS (SELECT *, n < {LEAST_WORDS} OR 100 * n_repeat > 50 * n AS failed,
      CASE WHEN length(t) >= {LEAST_CHARS} AND ref_lang IS NOT NULL THEN {js('classes', 'ref_classes')} END AS dc,
      CASE WHEN n >= {LEAST_JUDGED_WORDS} AND ref_lang IS NOT NULL THEN {js('common', 'ref_common')} END AS dw
      FROM g LEFT JOIN ref ON g.lang = ref.ref_lang)
SELECT doc_id, n AS n_words, word_chars, c_symbol AS n_symbols, n_dup AS n_dup_lines, n_repeat AS n_repeat_words, failed AS base_failed,
       NOT failed AND coalesce(dc, 0) <= {MOST_CLASS_DISTANCE} AND coalesce(dw, 0) <= {MOST_WORD_DISTANCE} AS kept
FROM j
"""


SQL = _sql()
