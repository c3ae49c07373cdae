"""Quality rules: base counts, and a hashed n-gram log-likelihood ratio (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import columns, let, materialise, prefix

#: Buckets of the two multinomials.
BUCKETS = 1 << 17
#: Trusted documents that the target multinomial is fitted on, those with the smallest id hashes.
TRUSTED = 4096
#: Lengths of the n-grams, in words.
SIZES = (1,)
#: Mean log-likelihood ratio per n-gram from which a document is kept: a quarter of what n-grams that the target never shows have.
THRESHOLD = -0.173

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\f\r"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _spaced(text: Column) -> Column:
    """``text`` with every white-space character as a space."""
    for c in SPACES[1:]:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return text


def words_of(text: Column) -> Column:
    """The words of a text (runs of characters other than ASCII white space); none for null."""
    return F.coalesce(F.array_remove(F.split(_spaced(text), " ", -1), ""), F.array().cast("array<string>"))


def count_of(text: Column, characters: str) -> Column:
    """How many characters of a text are one of ``characters``."""
    rest = text
    for c in characters:
        rest = F.replace(rest, F.lit(c), F.lit(""))
    return F.coalesce(F.length(text) - F.length(rest), F.lit(0)).cast("long")


def _windows(words: Column, n: int) -> Column:
    """Hashes of the ``n``-word windows of ``words`` (a lambda variable or column)."""
    if n == 1:
        return F.transform(words, lambda w: F.xxhash64(w))
    places = F.when(F.size(words) >= n, F.sequence(F.lit(0), F.size(words) - n)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.xxhash64(*[words[i + k] for k in range(n)]))


def repeat_words(words: Column, n: int = 3) -> Column:
    """Words inside ``n``-word windows that ``words`` holds twice or more, first included.

    The sorted hashes tell which windows repeat. Where they are few, the places
    are looked up in them; otherwise hashes are sorted with their places and
    equal neighbours marked, n log n in the length of the text.
    """
    none = F.array().cast("array<int>")

    def paired(h: Column) -> Column:
        return let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), lambda s: F.sort_array(F.transform(
            F.filter(s, lambda x, k: (F.get(s, k - 1)["h"].eqNullSafe(x["h"])) | (F.get(s, k + 1)["h"].eqNullSafe(x["h"]))), lambda x: x["i"])))

    def marked(h: Column) -> Column:
        twice = let(F.sort_array(h), lambda s: F.array_distinct(F.filter(s, lambda x, k: F.get(s, k + 1).eqNullSafe(x))))
        places = F.sequence(F.lit(0), F.size(h) - 1)
        return let(twice, lambda d: F.when(F.size(d) > 32, paired(h)).otherwise(F.filter(places, lambda i: F.array_contains(d, h[i]))))

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda x, k: F.least(F.lit(n), F.coalesce(F.get(at, k + 1) - x, F.lit(n))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda acc, x: acc + x)

    return let(_windows(words, n), lambda h: let(F.when(F.size(F.array_distinct(h)) < F.size(h), marked(h)).otherwise(none), covered))


def base_columns(text: Column, words: Column) -> dict[str, Column]:
    """The base counts of a text, all long, named as in ``BASE``."""
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.coalesce(F.length(text) - count_of(text, SPACES), F.lit(0)).cast("long"),
        "n_symbols": count_of(text, SYMBOLS),
        "n_dup_lines": F.coalesce(let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))), F.lit(0)).cast("long"),
        "n_repeat_words": repeat_words(words),
    }


def grams(words: Column, sizes: tuple[int, ...], buckets: int) -> Column:
    """Buckets (from 1) of the n-grams of a document, of each n in ``sizes``."""
    hashes = F.concat(*[_windows(words, n) for n in sizes]) if len(sizes) > 1 else _windows(words, sizes[0])
    return F.transform(hashes, lambda h: F.pmod(h, F.lit(buckets)).cast("int") + 1)


def trusted_ids(labels: DataFrame, id_col: str = "doc_id", most: int = TRUSTED) -> DataFrame:
    """(id) of at most ``most`` documents labelled of good quality and not toxic, those with the smallest hashes."""
    good = labels.filter((F.col("quality") == 1) & (F.col("toxic") == 0)).select(F.col(id_col).alias("id")).dropna().distinct()
    return good.orderBy(F.xxhash64("id"), "id").limit(most)


def log_ratios(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", sizes: tuple[int, ...] = SIZES,
               buckets: int = BUCKETS) -> DataFrame:
    """One row, one column ``ratios``: ln(target share / raw share) of each bucket.

    The raw multinomial counts the n-grams of every document. The target one
    counts those of the documents in ``trusted`` (a bounded table) and, as its
    prior, as many n-grams again in raw shares: a bucket that the target never
    shows has ln(1/2). Counts are summed in each task before they meet, and
    ``buckets`` bounds everything after that.
    """
    ids = F.broadcast(trusted.select(F.col("id").alias("_id"), F.lit(1).alias("_t")).distinct())
    seen = docs.select(F.col(id_col).alias("_d"), F.col(text_col).alias("_text")).join(ids, F.col("_d") == F.col("_id"), "left")
    gram = seen.select("_t", F.explode(let(words_of(F.col("_text")), lambda w: grams(w, sizes, buckets))).alias("b"))
    counted = gram.groupBy("b").agg(F.count("*").alias("raw"), F.count("_t").alias("target"))
    every = docs.sparkSession.range(1, buckets + 1, 1, 1).select(F.col("id").cast("int").alias("b"))
    full = every.join(counted, "b", "left").na.fill(0, ["raw", "target"])
    listed = full.groupBy().agg(F.sort_array(F.collect_list(F.struct("b", "raw", "target"))).alias("l"), F.sum("raw").alias("r"), F.sum("target").alias("t"))

    def ratio(x: Column) -> Column:
        raw = x["raw"] / F.col("r")
        return F.when((F.col("t") > 0) & (x["raw"] > 0), F.log((x["target"] / F.col("t") + raw) / 2) - F.log(raw)).otherwise(0.0)

    return listed.select(F.transform("l", ratio).alias("ratios"))


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sizes: tuple[int, ...] = SIZES,
                  buckets: int = BUCKETS, trusted: int = TRUSTED, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, llr and kept added.

    base_failed: fewer than 50 words, or more than half of them in repeated
    3-word windows. llr is the log-likelihood ratio of the document's
    n-grams between the trusted-target and the raw-corpus multinomials,
    divided by their number (0 without any). kept: not base_failed, and llr is
    at least ``threshold``. A null text has no words. Rows are judged one by
    one, so repeated rows get equal verdicts; an empty table gives an empty
    one. Without trusted documents the ratio is flat. The added columns must
    not be in ``docs``; :func:`keep_good` has no such bound.
    """
    ratios = materialise(log_ratios(docs, trusted_ids(labels, id_col, trusted), id_col, text_col, sizes, buckets), "log_ratios")
    p = prefix(docs)
    text, table = F.col(text_col), F.col(p + "ratios")
    llr = lambda g: F.when(F.size(g) > 0, F.aggregate(g, F.lit(0.0), lambda acc, b: acc + F.element_at(table, b)) / F.size(g)).otherwise(0.0)
    counts = let(words_of(text), lambda w: F.struct(*[c.alias(k) for k, c in base_columns(text, w).items()],
                                                    let(grams(w, sizes, buckets), llr).alias("llr")))
    failed = lambda q: (q["n_words"] < 50) | (100 * q["n_repeat_words"] > 50 * q["n_words"])
    verdict = let(counts, lambda q: F.struct(*[q[c].alias(c) for c in (*BASE, "llr")], failed(q).alias("base_failed"),
                                             (~failed(q) & (q["llr"] >= threshold)).alias("kept")))
    seen = docs.select(*columns(docs), ratios.scalar().alias(p + "ratios"))
    return seen.select(*[f"`{c}`" for c in docs.columns], verdict.alias(p + "q")).select(*[f"`{c}`" for c in docs.columns], p + "q.*")


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """The rows of ``docs`` that :func:`quality_rules` keeps, in their own columns."""
    p = prefix(docs)
    own = docs.select(F.struct(*columns(docs)).alias(p + "row"), docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    judged = quality_rules(own, labels, "doc_id", "text", **params)
    return judged.filter("kept").select(p + "row.*")
