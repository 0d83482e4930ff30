"""Text quality by an interpolated modified Kneser-Ney model of character 4-grams.

The model is counted on trusted text.  Its counts, and the continuation counts of all
lower orders, are tables sharded by n-gram; the probabilities of all n-grams that occur
in the corpus come from joins of those shards, order by order.  A document's perplexity
is the sum over its own n-gram counts, and it is rejected above a quantile of the
perplexities of trusted documents of its language that were not counted, times a margin.
A short text's perplexity is unsteady, so it is judged together with a fixed number of
characters of average trusted text.

The probability table is broadcast only while it measures under a fixed bound;
beyond it the documents' n-grams are joined by shuffle.

Characters beyond the basic plane count as one class.  Defined results: documents
without text have no perplexity and are rejected; a language (NULL included) without
trusted documents takes the quantile of all languages; without any trusted text
nothing is rejected; rows that share an id are judged together; rows with a NULL id
are left out; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.llm.common import fold, freed, spread_join, staged
from stratiform.operators.joins import fits_broadcast, sized_join

ORDER = 4
QUANTILE = 0.995
MARGIN = 1.2  # a document is rejected above the quantile times this
PRIOR_CHARS = 64  # characters of average trusted text that a short text is weighed with
# characters of text taken at once: a dozen arrays of 8 bytes each stand beside those of a document's grams, fewer beside a corpus'
_CORPUS_CHUNK, _CHUNK = 1 << 19, 1 << 17


def _grams(text: str) -> np.ndarray:
    """The 4-grams of a text after three start marks, 16 bits a character."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    c = np.empty(len(points) + ORDER - 1, dtype=np.uint64)
    c[:ORDER - 1] = 1
    c[ORDER - 1:] = np.minimum(points, 0xFFFF)
    return ((c[:-3] << np.uint64(48)) | (c[1:-2] << np.uint64(32)) | (c[2:-1] << np.uint64(16)) | c[3:]).view(np.int64)


def _chunked(column, limit: int) -> Iterator[list[str]]:
    some, size = [], 0
    for v in column:
        some.append(v.as_py() or "")
        size += len(some[-1])
        if size >= limit:
            yield some
            some, size = [], 0
    if some:
        yield some


def corpus_grams(texts: DataFrame) -> DataFrame:
    """(g, c): the corpus count of every 4-gram of the ``text`` column."""

    def counts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in _chunked(batch.column(0), _CORPUS_CHUNK):
                g, c = np.unique(np.concatenate([_grams(t) for t in some]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(c.astype(np.int64))], ["g", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return freed(counts_of(batches))

    return texts.select("text").mapInArrow(run, "g bigint, c bigint").groupBy("g").agg(F.sum("c").alias("c"))


def document_grams(docs: DataFrame) -> DataFrame:
    """(doc_id, g, c): the 4-gram counts of every document."""

    def counts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for some in _chunked(batch.column(1), _CHUNK):
                ids = batch.column(0).slice(done, len(some))
                done += len(some)
                counted = [np.unique(_grams(t), return_counts=True) for t in some]
                at = np.repeat(np.arange(len(some)), [len(g) for g, _ in counted])
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(at)), pa.array(np.concatenate([g for g, _ in counted])),
                     pa.array(np.concatenate([c for _, c in counted]).astype(np.int64))], ["doc_id", "g", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return freed(counts_of(batches))

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, g bigint, c bigint")


def _suffix(order: int):
    """The last ``order`` characters of an n-gram one longer."""
    return F.col("g").bitwiseAND(F.lit((1 << (16 * order)) - 1))


def gram_probabilities(trained: DataFrame, asked: DataFrame) -> DataFrame:
    """(g, logp) of every asked 4-gram under the model of the trained counts (g, c)."""
    counts = {ORDER: trained}
    wanted = {ORDER: asked.select("g").distinct()}
    for k in range(ORDER - 1, 0, -1):  # lower orders count in how many longer n-grams they continue
        counts[k] = staged(counts[k + 1].groupBy(_suffix(k).alias("g")).agg(F.count(F.lit(1)).alias("c")), f"counts-{k}")
        wanted[k] = staged(wanted[k + 1].select(_suffix(k).alias("g")).distinct(), f"wanted-{k}")
    lower = None
    for k in range(1, ORDER + 1):
        row = counts[k].agg(*[F.count(F.when(F.col("c") == i, 1)).alias(f"n{i}") for i in (1, 2, 3, 4)],
                            F.count(F.lit(1)).alias("kinds")).first()
        n = [0, *(row[f"n{i}"] for i in (1, 2, 3, 4))]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
        cut = [min(max(i - (i + 1) * y * n[i + 1] / n[i], 0.1), i - 0.05) if n[i] else 0.5 * i for i in (1, 2, 3)]
        less = F.when(F.col("c") == 1, cut[0]).when(F.col("c") == 2, cut[1]).otherwise(cut[2])
        context = F.shiftrightunsigned("g", 16).alias("h")
        contexts = (counts[k].groupBy(context)
                    .agg(F.sum("c").alias("total"), F.sum(less).alias("spare")))
        seen = counts[k].select("g", "c", (F.col("c") - less).alias("held")).drop("c")
        asked_k = wanted[k].select("g", context).join(seen, "g", "left").join(contexts, "h", "left")
        if k == 1:
            asked_k = asked_k.withColumn("below", F.lit(1.0 / (row["kinds"] + 1)))
        else:
            asked_k = (asked_k.withColumn("tail", _suffix(k - 1))
                       .join(lower.select(F.col("g").alias("tail"), F.col("p").alias("below")), "tail"))
        p = F.when(F.col("total").isNull(), F.col("below")).otherwise(
            F.coalesce(F.col("held") / F.col("total"), F.lit(0.0)) + F.col("spare") / F.col("total") * F.col("below"))
        lower = staged(asked_k.select("g", p.alias("p")), f"probabilities-{k}")
    return lower.select("g", F.log("p").alias("logp"))


def with_probabilities(grams: DataFrame, logp: DataFrame, asked: DataFrame) -> DataFrame:
    """``grams`` with their probabilities.  Beyond the broadcast bound a gram of very many documents is dealt over
    tasks: it stands in no more rows than ``asked`` counts occurrences of it."""
    if fits_broadcast(logp):
        return grams.join(F.broadcast(logp), "g")
    counts = asked.select("g", F.col("c").alias("__rows"))
    return spread_join(grams, logp, ["g"], "__rows", counts=counts)


def score_quality(docs: DataFrame, trusted: DataFrame, quantile: float = QUANTILE, margin: float = MARGIN, id_col: str = "doc_id",
                  text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per doc_id: lang, n_chars, perplexity, the same weighed for short texts, the threshold of its language and kept.

    ``trusted`` holds the ids of trusted documents in ``doc_id``.  Half of them, by the
    crc32 of the id, is counted; the other half sets the thresholds.
    """
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                       F.col(lang_col).cast("string").alias("lang")).where("doc_id IS NOT NULL")
    ids = staged(trusted.select("doc_id").where("doc_id IS NOT NULL").distinct(), "trusted")
    counted = ids.where(fold(folds=2) == 0)
    trained = staged(corpus_grams(sized_join(docs, counted, "doc_id", "left_semi")), "trained")
    asked = staged(corpus_grams(docs), "asked")
    logp = gram_probabilities(trained, asked)
    scored = (with_probabilities(document_grams(docs), logp, asked).groupBy("doc_id")
              .agg(F.sum("c").alias("n_chars"), F.sum(F.col("c") * F.col("logp")).alias("logp")))
    named = docs.select("doc_id", "lang").groupBy("doc_id").agg(F.min("lang").alias("lang"))
    scored = staged(named.join(scored, "doc_id", "left").select(
        "doc_id", "lang", F.coalesce("n_chars", F.lit(0)).alias("n_chars"), "logp",
        F.exp(-F.col("logp") / F.col("n_chars")).alias("perplexity")), "perplexity")
    held = scored.join(ids.where(fold(folds=2) == 1), "doc_id", "left_semi").where("perplexity IS NOT NULL")
    usual = held.agg((F.sum("logp") / F.sum("n_chars")).alias("usual")).first()["usual"] or 0.0
    weighed = F.exp(-(F.col("logp") + F.lit(PRIOR_CHARS * usual)) / (F.col("n_chars") + F.lit(PRIOR_CHARS)))
    scored, held = scored.withColumn("weighed", weighed), held.withColumn("weighed", weighed)
    bound = F.percentile_approx("weighed", quantile, 100_000) * F.lit(margin)
    by_lang = held.groupBy("lang").agg(bound.alias("own"))
    overall = held.agg(bound.alias("overall")).first()["overall"]
    every = F.lit(overall).cast("double")
    return (sized_join(scored, by_lang.where("lang IS NOT NULL"), "lang", "left")
            .select("doc_id", "lang", "n_chars", "perplexity", "weighed", F.coalesce("own", every).alias("threshold"))
            .withColumn("kept", F.col("perplexity").isNotNull()
                        & F.coalesce(F.col("weighed") <= F.col("threshold"), F.lit(True))))
