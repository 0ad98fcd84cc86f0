"""Quality rules by distribution divergence, in DataFrame expressions only.

Each document's histogram over character classes and over common words is
compared with the references of the languages by the Jensen-Shannon distance
(base 2, the square root of the divergence; 0 to 1). A document goes if even
the nearest language is too far away. References are the pooled histograms of
all documents of a language that pass the base rules, so they follow the
corpus; histograms of few characters or words are noisy and are not judged.

Languages with a list of common words are held against all of these. Another
language has a reference of its own if the corpus has enough of it, and is
held against that or the listed ones, by character classes only; without one
only the base rules decide.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import spare_prefix, staged

#: Frequent function words by language.
COMMON_WORDS = {
    "de": "der die und in den von zu das mit sich des auf ist im dem nicht".split(),
    "en": "the of and to in a is that for it was on be with as by".split(),
    "es": "de la que el en y a los se del las un por con no una".split(),
    "fr": "de la le et les des en un du une que est pour qui dans pas".split(),
}
WORDS = sorted({w for ws in COMMON_WORDS.values() for w in ws})
#: Character classes, counted in this order by removing one after the other.
CLASSES = (("lower", "[a-z]+"), ("space", r"[\x20\x09-\x0D]+"), ("upper", "[A-Z]+"), ("digit", "[0-9]+"), ("symbol", "[#*$%&|<>]+"), ("ascii", r"[\x00-\x7F]+"))
#: Largest class distance that stays; largest word distance for n words (its
#: noise falls with n): WORD_BASE + WORD_NOISE / n; least characters and words
#: that are judged.
MAX_CLASS_DISTANCE, WORD_BASE, WORD_NOISE, MIN_CHARS, MIN_WORDS = 0.3, 0.22, 8.0, 200, 80
#: Least characters of a reference of a language without common words.
REFERENCE_CHARS = 20_000

_SPACE = " \t\n\x0b\x0c\r"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeated(hashes: Column) -> Column:
    """Words covered by 3-word windows whose hash occurs twice or more."""

    def covered(s: Column) -> Column:
        same = lambda k, o: F.coalesce(F.get(s, k)["h"] == F.get(s, k + o)["h"], F.lit(False))
        twice = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda k: same(k, 1) | same(k, -1))
        spots = F.transform(twice, lambda k: F.get(s, k)["i"])
        return F.size(F.array_distinct(F.flatten(F.transform(spots, lambda p: F.array(p, p + 1, p + 2)))))

    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(_let(ordered, covered))


def _word_features(words: Column) -> Column:
    n = F.size(words)
    at = lambda i: F.get(words, i)
    hashes = F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(at(i), at(i + 1), at(i + 2)))).otherwise(F.array().cast("array<bigint>"))
    # common words as one letter each, so that a word's count is a difference of lengths
    marks = F.transform(F.filter(words, lambda w: w.isin(WORDS)), lambda w: F.char(F.array_position(F.lit(WORDS), w) + 64))
    return F.struct(n.cast("long").alias("n_words"), _let(hashes, _repeated).cast("long").alias("n_repeat_words"), F.concat_ws("", marks).alias("marks"))


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang", carried: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, lang, the ``carried`` columns, the base counts, ``classes`` and ``common`` (counts of
    character classes and of common words, the rest last). Null text is empty."""
    lang = F.col(lang_col).cast("string") if lang_col else F.lit(None).cast("string")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    out = docs.select(F.col(id_col).cast("long").alias("doc_id"), lang.alias("lang"), text.alias("text"), *carried)
    bare = F.btrim("text", F.lit(_SPACE))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, CLASSES[1][1]))
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(_SPACE)) != "")
    left, sizes = F.col("text"), [F.char_length("text")]
    steps = []
    for k, (_, pattern) in enumerate(CLASSES):
        out = out.withColumn(f"left{k}", F.regexp_replace(left, pattern, ""))
        left = F.col(f"left{k}")
        steps.append(F.char_length(left))
    sizes += steps
    counts = [a - b for a, b in zip(sizes, steps)] + [steps[-1]]
    out = out.withColumns({
        "w": _let(words, _word_features),
        "n_dup_lines": _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "classes": F.array(*[c.cast("long") for c in counts]),
    })
    marks = F.col("w.marks")
    common = F.transform(F.lit([chr(65 + k) for k in range(len(WORDS))]), lambda m: (F.char_length(marks) - F.char_length(F.replace(marks, m))).cast("long"))
    out = out.select("doc_id", "lang", *carried, "w.n_words", (F.char_length("text") - F.col("classes")[1]).cast("long").alias("word_chars"),
                     F.col("classes")[4].alias("n_symbols"), "n_dup_lines", "w.n_repeat_words", "classes", common.alias("common"))
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rest = F.col("n_words") - F.aggregate("common", F.lit(0).cast("long"), lambda a, x: a + x)
    return out.withColumns({"common": F.concat("common", F.array(rest)), "base_failed": base})


def references(feats: DataFrame) -> dict[str, dict[str, list[int]]]:
    """By language the pooled counts of its documents that pass the base rules.

    The driver gets one row for each language of COMMON_WORDS and for each
    other that has REFERENCE_CHARS characters in them."""
    names = {"classes": len(CLASSES) + 1, "common": len(WORDS) + 1}
    sums = [F.sum(F.col(c)[k]).alias(f"{c}{k}") for c, n in names.items() for k in range(n)]
    enough = F.col("lang").isin(sorted(COMMON_WORDS)) | (sum((F.col(f"classes{k}") for k in range(1, len(CLASSES) + 1)), F.col("classes0")) >= REFERENCE_CHARS)
    rows = feats.where(~F.col("base_failed") & F.col("lang").isNotNull()).groupBy("lang").agg(*sums).where(enough).collect()
    return {r["lang"]: {c: [r[f"{c}{k}"] for k in range(n)] for c, n in names.items()} for r in sorted(rows, key=lambda r: r["lang"])}


def _shares(reference: list[int]) -> Column:
    total = sum(reference)
    return F.array(*[F.lit(x / total) for x in reference])


def distance(counts: Column, reference: list[int] | Column) -> Column:
    """Jensen-Shannon distance of a histogram column from a reference (counts,
    or a column of shares)."""
    q = reference if isinstance(reference, Column) else _shares(reference)
    log2 = lambda x: F.log(x) / F.lit(0.6931471805599453)

    def term(p: Column, q: Column) -> Column:
        part = lambda x: F.when(x > 0, x * log2(2 * x / (p + q))).otherwise(0.0)
        return (part(p) + part(q)) / 2

    size = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    shares = _let(size, lambda n: F.transform(counts, lambda x: x / n))
    return F.sqrt(F.greatest(F.aggregate(F.zip_with(shares, q, term), F.lit(0.0), lambda a, x: a + x), F.lit(0.0)))


def verdicts(feats: DataFrame, refs: dict[str, dict[str, list[int]]]) -> DataFrame:
    """Adds class_distance, word_distance (null where not judged) and kept."""
    listed, others = ({k: r for k, r in refs.items() if (k in COMMON_WORDS) == own} for own in (True, False))
    none = F.lit(None).cast("double")
    nearest = lambda c: F.array_min(F.array(*[distance(F.col(c), r[c]) for r in listed.values()])) if listed else none
    chars = F.aggregate("classes", F.lit(0).cast("long"), lambda a, x: a + x)
    other = F.coalesce(~F.col("lang").isin(sorted(COMMON_WORDS)), F.lit(False))  # a language without common words
    own = none  # distance from the own reference of such a language; without a language, from the nearest of them
    if others:
        names, shares = F.array(*map(F.lit, others)), F.array(*[_shares(r["classes"]) for r in others.values()])
        mine = F.get(shares, F.array_position(names, F.col("lang")).cast("int") - 1)
        own = F.when(other & F.array_contains(names, F.col("lang")), distance(F.col("classes"), mine))
        own = own.when(F.col("lang").isNull(), F.array_min(F.transform(shares, lambda q: distance(F.col("classes"), q))))
    out = feats.withColumns({"own": F.when(chars > 0, own), "near": F.when(chars >= MIN_CHARS, nearest("classes"))})
    out = out.withColumns({
        "class_distance": F.when((chars >= MIN_CHARS) & (~other | F.col("own").isNotNull()), F.least("near", "own") if others else F.col("near")),
        "word_distance": F.when((F.col("n_words") >= MIN_WORDS) & ~other & ~F.coalesce(F.col("own") < F.col("near"), F.lit(False)), nearest("common")),
    }).drop("own", "near")
    far = (F.coalesce("class_distance", F.lit(0.0)) > MAX_CLASS_DISTANCE) | (F.coalesce("word_distance", F.lit(0.0)) > F.lit(WORD_BASE) + F.lit(WORD_NOISE) / F.col("n_words"))
    return out.withColumn("kept", ~F.col("base_failed") & ~far)


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang") -> DataFrame:
    """One row per row: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, class_distance, word_distance.

    Null and empty texts have no words and fail the base rules. Documents of
    a null language count in no reference but are held against all (against
    common words unless a language without them is nearest); documents of a
    language without common words are held against its own reference and the
    listed ones; without a reference only the base rules decide. Repeated rows and
    null ids are kept as rows; an empty table gives no rows; other columns
    are ignored."""
    feats = staged(features(docs, id_col, text_col, lang_col), "quality-features")
    return verdicts(feats, references(feats)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "class_distance", "word_distance")


def kept_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang") -> DataFrame:
    """The rows of ``docs``, unchanged, that the rules keep.

    A verdict follows from text and language, so rejects are told by id and a
    hash of both: rows of one id and text in two languages are judged apart.
    Null and empty texts are rejects, very long ones are judged whole;
    repeated rows stay or go together; null ids are ids like others; an empty
    table gives no rows; columns of any name are kept as they are."""
    p = spare_prefix(docs, "id", "hash")
    lang = F.col(lang_col).cast("string") if lang_col else F.lit(None).cast("string")
    told = F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")), lang.isNull(), F.coalesce(lang, F.lit("")))
    keyed = docs.withColumns({p + "id": F.coalesce(F.col(id_col).cast("long"), F.lit(-1)), p + "hash": told})
    feats = staged(features(keyed, id_col, text_col, lang_col, (p + "id", p + "hash")), "quality-features")
    rejects = verdicts(feats, references(feats)).where(~F.col("kept")).select(p + "id", p + "hash").distinct()
    return keyed.join(rejects, [p + "id", p + "hash"], "left_anti").select(*[F.col(c) for c in docs.columns])
