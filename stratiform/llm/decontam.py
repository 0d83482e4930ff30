"""Benchmark decontamination by spaced-seed hashing, in built-in functions only.

A spaced seed is a fixed mask over consecutive words: positions marked 1 are hashed,
positions marked 0 are ignored, so a seed still matches when an ignored word was
replaced.  The seeds of all benchmark items are joined with the seeds of all training
texts.  A hit fixes how the item lies over the text; all its words are then compared
word by word on that diagonal, tolerating substitutions.  A text is contaminated by an
item when at least ``percent`` of the item's words agree, or ``run_hits`` of some
``run`` consecutive ones do (a part of the item, or an item with words put in or left out).

While the seed and item tables measure under a fixed bound they are broadcast and a
text's words never move; beyond it, seeds are joined by shuffle and only texts with
hits are compared.

Words are runs of letters and digits of the lower-cased text.  Defined results: NULL
and empty texts hold nothing; items of fewer words than the shortest mask are not
searched; rows with a NULL id are not searched; texts that share an id are reported
once per item with their best agreement; other columns are not read; empty tables give
no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.operators.joins import BROADCAST_MAX_BYTES, measured_bytes

# The masks.  Five words count in each; any two replaced words leave one of them in most places.
MASKS = ("11111", "1101011", "11001011", "101100011")


def _words(text):
    """Hashes of the words of a text."""
    words = F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _looked(mask: str) -> list[int]:
    return [i for i, bit in enumerate(mask) if bit == "1"]


def _leads(masks: tuple[str, ...]):
    """Whether a hit has no hit of the same mask one word before it on its diagonal; others would repeat its comparison."""
    def before(mask: str):
        same = [F.coalesce(F.get("words", F.col("at") + F.lit(i - 1)) == F.get("iw", F.col("item_at") + F.lit(i - 1)), F.lit(False))
                for i in _looked(mask)]
        return reduce(lambda a, b: a & b, same)

    return ~reduce(lambda a, b: a | b, [(F.col("mask") == i) & before(m) for i, m in enumerate(masks)])


def _places(rows: DataFrame, masks: tuple[str, ...]) -> DataFrame:
    """One row per word place ``at`` and mask, with the hash of the words that the mask looks at.

    The places come from an outer explode: for an inner one the optimizer adds a filter
    that splits and hashes every text a second time.
    """
    def seed(mask: str):
        looked = [F.get("words", F.col("at") + F.lit(i)) for i in _looked(mask)]
        return F.when(looked[-1].isNotNull(), F.xxhash64(F.lit(mask), *looked))

    return (rows.select("*", F.posexplode_outer("words").alias("at", "word"))
            .select("*", F.posexplode(F.array(*[seed(m) for m in masks])).alias("mask", "seed")).drop("word")
            .where("seed IS NOT NULL"))


def _agreement(run: int):
    """Of the item's words ``iw`` laid over ``words`` from ``diagonal`` on: how many agree, and the best run."""
    bits = F.lit((1 << run) - 1).cast("bigint")

    def step(acc, j):
        same = F.coalesce((F.get("words", F.col("diagonal") + j) == F.get("iw", j)).cast("bigint"), F.lit(0).cast("bigint"))
        last = F.shiftleft(acc["last"], 1).bitwiseOR(same).bitwiseAND(bits)
        return F.struct((acc["matches"] + same).alias("matches"), last.alias("last"),
                        F.greatest(acc["best"], F.bit_count(last).cast("bigint")).alias("best"))

    zero = F.lit(0).cast("bigint")
    return F.aggregate(F.sequence(F.lit(0), F.col("n_words") - F.lit(1)),
                       F.struct(zero.alias("matches"), zero.alias("last"), zero.alias("best")), step)


def contaminated(docs: DataFrame, items: DataFrame, percent: int = 80, run: int = 13, run_hits: int = 11,
                 masks: tuple[str, ...] = MASKS, max_broadcast: int = BROADCAST_MAX_BYTES,
                 id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text") -> DataFrame:
    """Per contaminated (doc_id, item_id): matching words, the item's words and the best run."""
    shortest = min(len(m) for m in masks)
    known = (items.where(F.col(item_col).isNotNull())
             .select(F.col(item_col).alias("item_id"), _words(F.col(item_text_col)).alias("words"))
             .withColumn("n_words", F.size("words")).where(F.col("n_words") >= shortest).dropDuplicates(["item_id", "words"]))
    lean = _places(known, masks).select("seed", "item_id", "mask", F.col("at").alias("item_at")).distinct()
    known = known.withColumnRenamed("words", "iw")

    texts = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), _words(F.col(text_col)).alias("words"))
    places = _places(texts, masks)
    if measured_bytes(lean) <= max_broadcast and measured_bytes(known) <= max_broadcast:
        laid = (places.drop("mask").join(F.broadcast(lean), "seed").join(F.broadcast(known), "item_id").where(_leads(masks))
                .withColumn("diagonal", F.col("at") - F.col("item_at")))
    else:
        hits = (places.select("doc_id", "at", "seed").join(lean, "seed")
                .select("doc_id", "item_id", (F.col("at") - F.col("item_at")).alias("diagonal")).distinct())
        laid = hits.join(texts, "doc_id").join(known, "item_id")
    found = _agreement(run)
    verified = (laid.select("doc_id", "item_id", "n_words", F.explode(F.array(found)).alias("found"))  # computed once
                .select("doc_id", "item_id", F.col("n_words").cast("bigint").alias("n_words"),
                        F.col("found.matches").alias("matches"), F.col("found.best").alias("best_run"))
                .where((F.col("matches") * 100 >= F.col("n_words") * percent) | (F.col("best_run") >= run_hits)))
    return (verified.groupBy("doc_id", "item_id")
            .agg(F.max("matches").alias("matches"), F.max("n_words").alias("n_words"), F.max("best_run").alias("best_run")))
