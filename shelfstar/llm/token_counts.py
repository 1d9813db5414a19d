"""Token counts of whole texts under a sentencepiece BPE model, without token ids.

No piece of such a model holds a blank mark after another character, so merges never cross the place where
blanks begin: a text is a sequence of pre-tokens (blanks and the word after them) whose counts add up.

The pre-tokens of all texts are added up in each task and then grouped, and the pieces of each distinct one are
counted once. Documents are then turned into pre-token frequencies and joined to those counts. The most
frequent pre-tokens, as many as a table of ``TABLE_BYTES`` holds, are broadcast and joined where the document is;
each of the others is a very small share of all occurrences, so few rows are left to the shuffle join.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, functions as F

from .common import checkpointed, whole

MARK = "▁"
_UNITS = re.compile(f"{MARK}+[^{MARK}]*")
#: Bytes of the table that is broadcast, an entry weighing its text and ``ENTRY``; the longest text in it; pre-tokens
#: that a task adds up before it sends them on, and their characters (a blob without blanks is one pre-token).
TABLE_BYTES, ENTRY, LONGEST, HELD, HELD_CHARACTERS = 32 << 20, 64, 1024, 400_000, 32 << 20


def splits_at_blanks(model: sentencepiece.SentencePieceProcessor) -> bool:
    """Whether no piece has a blank mark after another character, on which the pre-tokens rest."""
    return not any(re.search(f"[^{MARK}]{MARK}", model.id_to_piece(i)) for i in range(model.get_piece_size()))


class Pieces:
    """Counts the pieces of a pre-token."""

    def __init__(self, path: str):
        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        if not splits_at_blanks(self._model):
            raise ValueError("pieces of this model cross blanks")
        # what a blank alone adds after a word
        self._lone = len(self._model.encode("a ")) - len(self._model.encode("a"))

    def count(self, unit: str) -> int:
        # the model puts a blank before what it encodes
        return len(self._model.encode(unit[1:].replace(MARK, " "))) if len(unit) > 1 else self._lone


def pre_tokens(text: str | None) -> Counter[str]:
    """Frequencies of the pre-tokens, each with its leading blank marks; a text that isn't empty gets one in front."""
    if not text:
        return Counter()
    marked = MARK + text.replace(" ", MARK)
    words = marked.split(MARK)[1:]
    return Counter(_UNITS.findall(marked)) if "" in words else Counter([MARK + w for w in words])


def frequencies(docs: DataFrame, text: str = "text", most: int = HELD, most_characters: int = HELD_CHARACTERS) -> DataFrame:
    """``unit``, ``n``: each distinct pre-token of all texts, and how often it occurs."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["unit", "n"])
            held.clear()
            return rows

        characters = 0
        for batch in batches:
            for value in batch.column(0):
                units = pre_tokens(value.as_py())
                held.update(units)
                characters += sum(map(len, units))
                if len(held) > most or characters > most_characters:
                    yield flush()
                    characters = 0
        yield flush()

    texts = docs.select(F.col(text).alias("text")).filter(F.col("text") != "")
    return texts.mapInArrow(add_up, "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n"))


def counted_pieces(units: DataFrame, model_path: str) -> DataFrame:
    """``unit``, ``n``, ``pieces``: the pieces of every distinct pre-token."""

    @F.pandas_udf("int")
    def pieces(column: pd.Series) -> pd.Series:
        count = _pieces(model_path).count
        return pd.Series([count(u) for u in column], dtype="int32")

    return units.select("unit", "n", pieces("unit").alias("pieces"))


def most_frequent(pieces: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """``unit``, ``pieces`` of the most frequent pre-tokens that together weigh ``table_bytes`` at most.

    Frequencies fall into classes, eight for each power of two; the weights of some hundred classes come to the
    driver, and the classes from a certain one upwards are taken whole.
    """
    ranked = pieces.filter(F.octet_length("unit") <= LONGEST).withColumn("class", F.floor(F.log2("n") * 8))
    weights = ranked.groupBy("class").agg(F.sum(F.octet_length("unit") + ENTRY).alias("weight")).orderBy(F.col("class").desc())
    least, left = None, table_bytes
    for row in weights.collect():
        left -= row["weight"]
        if left < 0:
            break
        least = row["class"]
    return ranked.filter(F.col("class") >= (least if least is not None else 1 << 30)).select("unit", "pieces")


def joined_where_they_are(text: Column, frequent: DataFrame) -> Column:
    """Struct of ``known``, the pieces of the text's frequent pre-tokens, and ``rest``, the others with how often they occur."""
    table = frequent.sparkSession.sparkContext.broadcast({r["unit"]: r["pieces"] for r in frequent.toLocalIterator()})

    @F.arrow_udf("struct<known:bigint,rest:array<struct<unit:string,times:bigint>>>")
    def of(texts: pa.Array) -> pa.Array:
        pieces_of = table.value.get
        known, units, times, ends = [], [], [], [0]
        for text in texts:
            total = 0
            for unit, n in pre_tokens(text.as_py()).items():
                pieces = pieces_of(unit)
                if pieces is None:
                    units.append(unit)
                    times.append(n)
                else:
                    total += n * pieces
            known.append(total)
            ends.append(len(units))
        pairs = pa.StructArray.from_arrays([pa.array(units, pa.string()), pa.array(times, pa.int64())], ["unit", "times"])
        return pa.StructArray.from_arrays([pa.array(known, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)], ["known", "rest"])

    return of(text)


def count_tokens(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """``key``, ``n_bytes``, ``n_tokens`` (longs) for each row of ``docs``; a null or empty text has none.

    Repeated rows and null keys are rows like any other. Other columns of ``docs`` are not carried. ``table_bytes``
    changes how the join is done and not its result.
    """
    pieces = checkpointed(counted_pieces(frequencies(docs, text), model_path))
    first = most_frequent(pieces, table_bytes)
    known = docs.select(F.col(key).alias("key"), F.octet_length(whole(text)).cast("long").alias("n_bytes"), joined_where_they_are(F.col(text), first).alias("x"))
    known = checkpointed(known.select(F.monotonically_increasing_id().alias("row"), "key", "n_bytes", "x.known", "x.rest"))
    others = known.select("row", F.explode("rest").alias("y")).select("row", "y.unit", "y.times").join(pieces.select("unit", "pieces"), "unit")
    sums = others.groupBy("row").agg(F.sum(F.col("times") * F.col("pieces")).alias("others"))
    told = known.select("row", "key", "n_bytes", "known").join(sums, "row", "left")
    return told.select(F.col("key").alias(key), "n_bytes", (F.col("known") + F.coalesce("others", F.lit(0))).alias("n_tokens"))


_MODELS: dict[str, Pieces] = {}


def _pieces(path: str) -> Pieces:
    """One model per worker process."""
    if path not in _MODELS:
        _MODELS[path] = Pieces(path)
    return _MODELS[path]
