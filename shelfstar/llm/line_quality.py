"""Quality rules: base counts of a text, and line frequency across documents. DataFrame operations only.

Lines are normalised (letters A-Z lowered, white space as one blank, ends trimmed) and hashed together with the
document's host. A line that more than ``max_documents`` different texts of one host hold is boilerplate
there and is removed; exact copies of a text count once, as a document isn't boilerplate for having been
fetched often. A document that keeps less than ``least_left`` of its words is depleted and is rejected.
With a ``share`` the limit of a host is that share of its different texts, and ``max_documents`` the least limit.
The registered query has none, as its SQL has the number alone: no line of a host of 200 texts or fewer goes there.
``judge_quality`` counts what goes, ``without_frequent_lines`` returns the texts without it; both ask ``frequent_lines``.

A document sends each of its different lines once, and tasks add up before anything is shuffled. A line is a
64-bit key; two lines of one key would be counted together, which only matters at the limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import checkpointed, fresh, lower_ascii, whole

MAX_DOCUMENTS = 200
LEAST_LEFT = 0.2
_SPACE = r"[\x20\x09-\x0D]+"
_SYMBOLS = "#*$%&|<>"


def filled(line: Column) -> Column:
    return F.length(F.translate(line, " \t\r\x0b\x0c", "")) > 0


def plain(line: Column) -> Column:
    return F.trim(lower_ascii(F.regexp_replace(line, _SPACE, " ")))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, _SPACE), "")


def repeated_window_words(words: str) -> Column:
    """Words in windows of three that occur twice or more.

    Windows are sorted by hash with their places; equal neighbours are the repeated ones. Their places in
    order then say how many words each adds to those before.
    """
    window = lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    count = F.size(words) - 2
    hashes = F.transform(F.sequence(F.lit(0), count - 1), window)
    return F.when(count > 1, hashes).otherwise(F.array().cast("array<long>"))


def _covered(hashes: str) -> Column:
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeats(p: Column) -> Column:
        near = lambda x, k: (F.get(p, k - 1)["h"] == x["h"]) | (F.get(p, k + 1)["h"] == x["h"])
        return F.sort_array(F.transform(F.filter(p, lambda x, k: F.coalesce(near(x, k), F.lit(False))), lambda x: x["i"]))

    def words(places: Column) -> Column:
        adds = F.transform(places, lambda i, k: F.least(F.coalesce(F.get(places, k + 1) - i, F.lit(3)), F.lit(3)))
        return F.aggregate(adds, F.lit(0).cast("long"), lambda a, x: a + x)

    # each step is bound once by a one-element array, as a lambda's argument
    bound = lambda value, f: F.element_at(F.transform(F.array(value), f), 1)
    counted = bound(pairs, lambda p: bound(repeats(p), words))
    alone = F.size(F.array_distinct(hashes)) == F.size(hashes)
    return F.when(alone, F.lit(0).cast("long")).otherwise(counted)


def measured(docs: DataFrame, key: str, text: str, host: str) -> DataFrame:
    """Base counts of each row, and its different lines as keys with their words."""
    body = whole(text)
    lines = F.filter(F.split(body, "\n"), filled)
    first = docs.select(F.col(key).alias("key"), F.xxhash64(F.col(host)).alias("host"), body.alias("text"), words_of(body).alias("words"), lines.alias("lines"))
    known = F.transform("lines", lambda x: F.named_struct(F.lit("line"), plain(x)))
    second = first.select(
        "key", "host", "text", "words", "lines", repeated_window_words("words").alias("hashes"),
        F.transform(known, lambda x: F.struct(F.xxhash64(F.col("host"), x["line"]).alias("line"), F.size(F.split(x["line"], " ")).cast("long").alias("n"))).alias("keyed"),
    )
    return second.select(
        "key", "host", F.xxhash64("text").alias("body"), F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", _SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _covered("hashes").alias("n_repeat_words"), "keyed",
    )


def frequent_lines(lines: DataFrame, max_documents: int, share: float | None = None) -> DataFrame:
    """Each ``line`` that more different ``body`` of ``lines`` hold than the limit. A key has its ``host`` in it."""
    if share is None:
        return lines.groupBy("line", "body").agg(F.lit(1).alias("one")).groupBy("line").agg(F.count(F.lit(1)).alias("documents")).filter(F.col("documents") > max_documents).select("line")
    once = lines.groupBy("line", "body").agg(F.first("host").alias("host"))
    held = once.groupBy("line").agg(F.first("host").alias("host"), F.count(F.lit(1)).alias("documents")).filter(F.col("documents") > max_documents)
    texts = lines.groupBy("host", "body").agg(F.lit(1).alias("one")).groupBy("host").agg(F.count(F.lit(1)).alias("texts"))
    return held.join(texts, "host").filter(F.col("documents") > share * F.col("texts")).select("line")


def without_frequent_lines(docs: DataFrame, text: str = "text", host: str = "source",
                           max_documents: int = MAX_DOCUMENTS, share: float | None = None) -> DataFrame:
    """``docs`` with every frequent line taken out of ``text``; other lines, rows and columns stay as they are.

    Lines to go are found once for all copies of a text in a host, and reach the rows by host and SHA-256 of the text.
    """
    named, gone = fresh(docs, "named"), fresh(docs, "gone")
    lines = F.split(F.col(text), "\n")
    marked = docs.withColumn(named, F.sha2(F.concat_ws("|", F.xxhash64(F.col(host)).cast("string"), F.col(text)), 256))
    first = marked.select(F.col(named).alias("named"), F.xxhash64(F.col(host)).alias("host"), F.xxhash64(F.col(text)).alias("body"), lines.alias("lines"))
    known = F.transform("lines", lambda x: F.named_struct(F.lit("line"), plain(x), F.lit("filled"), filled(x)))
    keyed = F.transform(known, lambda x: F.when(x["filled"], F.xxhash64(F.col("host"), x["line"])))
    placed = first.select("named", "host", "body", F.posexplode(keyed).alias("place", "line")).filter("line is not null")
    removed = placed.join(frequent_lines(placed, max_documents, share), "line", "left_semi").groupBy("named").agg(F.collect_set("place").alias(gone))
    told = marked.join(removed.withColumnRenamed("named", named), named, "left")
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    # split once: the array is an argument of the lambda
    rebuilt = F.element_at(F.transform(F.array(lines), lambda own: F.array_join(F.transform(left, lambda i: F.get(own, i)), "\n")), 1)
    return told.withColumn(text, F.when(F.col(gone).isNull(), F.col(text)).otherwise(rebuilt)).select(*docs.columns)


def judge_quality(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source",
                  max_documents: int = MAX_DOCUMENTS, least_left: float = LEAST_LEFT, share: float | None = None) -> DataFrame:
    """``key``, ``n_words``, the base counts, ``base_failed``, ``n_removed_words``, ``kept`` for each row of ``docs``.

    A null text counts as empty: no word, so ``base_failed``. A null host is a host of its own. Repeated rows are
    judged alike and count once, as copies do. Other columns are not carried.
    """
    rows = checkpointed(measured(docs, key, text, host).withColumn("row", F.monotonically_increasing_id()))
    lines = rows.select("row", "host", "body", F.explode("keyed").alias("x")).select("row", "host", "body", F.col("x.line").alias("line"), F.col("x.n").alias("n"))
    removed = lines.join(frequent_lines(lines, max_documents, share), "line", "left_semi").groupBy("row").agg(F.sum("n").alias("removed"))
    told = rows.drop("keyed", "host", "body").join(removed, "row", "left").withColumn("n_removed_words", F.coalesce("removed", F.lit(0)))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    depleted = F.col("n_words") - F.col("n_removed_words") < least_left * F.col("n_words")
    return told.select(F.col("key").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), "n_removed_words", (~failed & ~depleted).alias("kept"))
