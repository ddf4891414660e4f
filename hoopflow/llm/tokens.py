"""Encoding of a corpus with a public byte-level BPE through a table of distinct words.

Spark splits the texts into the tokenizer's own words once and writes them, with a number per row, to the shared folder; each distinct
word is encoded once. Frequent words (each at least 1/HEAD of all occurrences, so at most HEAD of them) are looked up where the text
lies, in Arrow batches: the row keeps a string with a character per token and a mark for every other word. Only those other words move: they
meet the table in a shuffled join and come back by position. Frequent words too long for the broadcast are spread over SPREAD
copies of their row, so no word is hot in that join.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hoopflow.session import cut, work_dir

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
HEAD, HEAD_CHARS, SPREAD = 1 << 16, 64, 32
#: A token's id is written as the character FIRST + id, below the surrogates; GAP marks a word that is filled in later; a place has PLACES digits to the base 36.
FIRST, LAST, GAP, PLACES = 0x100, 0xD7FF, "\x01", 6
#: The tokenizer's split into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def read_ranks(raw: bytes) -> dict[bytes, int]:
    return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, raw.splitlines()) if piece}


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?U){WORDS}"), F.lit(0))


def split_words(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """_r, keep..., w: a number per row, so equal rows stay apart, and its words. Written once, so every reader has the same numbers."""
    at = work_dir(docs.sparkSession, "words")
    docs.select(F.monotonically_increasing_id().alias("_r"), *keep, words_of(F.col("text")).alias("w")).write.parquet(at)
    return docs.sparkSession.read.parquet(at)


def encode_words(words: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Adds the code of their ids to distinct words. The vocabulary file is read on the driver and broadcast (under 1 MB, fixed)."""
    raw = words.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken

        ranks = read_ranks(raw.value)
        if max(ranks.values()) > LAST - FIRST:
            raise ValueError(f"ids above {LAST - FIRST} can't be written as characters")
        coder = tiktoken.Encoding("public", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        for b in batches:
            yield b.assign(code=["".join(chr(FIRST + i) for i in coder.encode_ordinary(w)) for w in b["word"]])

    return words.mapInPandas(run, "word string, n long, code string")


class Encoded:
    """The words of a corpus and their table, and ``rows``: _r, keep..., code (of the frequent words, with gaps), rare (the words of the gaps)."""

    def __init__(self, docs: DataFrame, vocabulary: str = VOCABULARY, keep: tuple[str, ...] = ("doc_id",)) -> None:
        words = split_words(docs, keep)
        distinct = words.select(F.explode("w").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
        self.table = cut(encode_words(distinct, vocabulary))
        total = self.table.agg(F.sum("n")).first()[0] or 0
        often, short = F.col("n") * HEAD >= F.lit(total), F.length("word") <= HEAD_CHARS
        self.head, self.tail, self.heavy = self.table.where(often & short), self.table.where(~(often & short)), self.table.where(often & ~short)
        self.rows = self._looked_up(words, keep)

    def _looked_up(self, words: DataFrame, keep: tuple[str, ...]) -> DataFrame:
        spark = words.sparkSession
        # At most HEAD words of HEAD_CHARS letters: a few MB, whatever the corpus.
        known = spark.sparkContext.broadcast({r["word"]: r["code"] for r in self.head.select("word", "code").collect()})

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            find = known.value.get
            for b in batches:
                code, rare = [], []
                for w in b.pop("w"):
                    found = [(x, find(x, GAP)) for x in w] if w is not None else []
                    code.append("".join(c for _, c in found))
                    rare.append([x for x, c in found if c == GAP])
                yield b.assign(code=code, rare=rare)

        shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in words.drop("w").schema) + ", code string, rare array<string>"
        at = work_dir(spark, "codes")
        words.mapInPandas(run, shape).write.parquet(at)
        return spark.read.parquet(at)

    def gaps(self) -> DataFrame:
        """_r, pos, code of each word in a gap."""
        rare, tail, on = self.rows.select("_r", F.posexplode("rare").alias("pos", "word")), self.tail.select("word", "code"), ["word"]
        if not self.heavy.isEmpty():
            # Marked by a hash of bounded size on both sides, so words that only share it are spread alike.
            mark = F.broadcast(self.heavy.select(F.xxhash64("word").alias("_h")).distinct())
            rare = rare.join(mark, F.xxhash64("word") == F.col("_h"), "left").withColumn("_s", F.when(F.col("_h").isNotNull(), F.pmod("_r", F.lit(SPREAD))).otherwise(0)).drop("_h")
            copies = F.when(F.col("_h").isNotNull(), F.sequence(F.lit(0), F.lit(SPREAD - 1))).otherwise(F.array(F.lit(0)))
            tail = tail.join(mark, F.xxhash64("word") == F.col("_h"), "left").withColumn("_s", F.explode(copies)).drop("_h")
            on = ["word", "_s"]
        return rare.join(tail, on).select("_r", "pos", "code")


def encode(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, ids. Null, empty and only null texts have an empty list; blank texts have the ids of their blanks.

    Special tokens are never produced: their strings in a text are ordinary text. Every input row has one output row, repeated
    rows and null doc_ids included. The rare words of one text meet in one row, which is what the result asks for.
    """
    e = Encoded(docs, vocabulary)
    placed = F.concat(F.lpad(F.conv(F.col("pos").cast("string"), 10, 36), PLACES, "0"), F.col("code"))
    filled = e.gaps().groupBy("_r").agg(F.sort_array(F.collect_list(placed)).alias("t"))
    parts = F.zip_with(F.split("code", GAP), F.coalesce("t", F.array().cast("array<string>")), lambda x, t: F.concat(x, F.coalesce(F.substring(t, PLACES + 1, 1 << 30), F.lit(""))))
    both = e.rows.select("_r", "doc_id", "code").join(filled, "_r", "left").select("doc_id", F.array_join(parts, "").alias("text"))
    ids = F.transform(F.split("text", ""), lambda c: F.ascii(c) - FIRST)
    return both.select("doc_id", F.when(F.col("text") != "", ids).otherwise(F.array().cast("array<int>")).alias("ids"))


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep..., n_tokens of each row; 0 for null and empty texts."""
    e = Encoded(docs, vocabulary, keep)
    more = e.gaps().groupBy("_r").agg(F.sum(F.length("code") - 1).alias("more"))
    return e.rows.select("_r", *keep, "code").join(more, "_r", "left").select(*keep, (F.length("code") + F.coalesce("more", F.lit(0))).cast("long").alias("n_tokens"))


def decode(encoded: DataFrame, spark: SparkSession, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, text from doc_id, ids, through a join with the pieces of the ids (50 thousand rows, fixed). Empty lists give ''."""
    pieces = spark.createDataFrame([(i, p.hex()) for p, i in read_ranks(Path(vocabulary).read_bytes()).items()], "id int, piece string")
    rows = encoded.select(F.monotonically_increasing_id().alias("_r"), "doc_id", "ids").select("_r", "doc_id", F.posexplode_outer("ids").alias("pos", "id"))
    at = rows.join(F.broadcast(pieces), "id", "left").groupBy("_r", "doc_id").agg(F.sort_array(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "piece")))).alias("w"))
    text = F.decode(F.unhex(F.array_join(F.transform("w", lambda x: x["piece"]), "")), "UTF-8")
    return at.select("doc_id", F.when(F.size("w") > 0, text).otherwise("").alias("text"))
