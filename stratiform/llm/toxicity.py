"""Toxicity by a subsequence string-kernel support vector machine with Nystrom landmarks.

The units of a sentence are its words; runs of single characters count as one unit, so
spelled-out words stay together.  Two units are compared by the gap-weighted kernel of
common character subsequences of length 3: a subsequence counts with ``decay`` to the
power of the stretch it spans in both, so inserted characters weaken a match but do not
break it.  Landmarks turn the kernel into a short feature vector (Nystrom), and a
squared-hinge support vector machine separates insulting from other units.

Training uses the labelled sentences of a bounded sample (``sample_docs`` distinct texts
a class, so copies of one text never crowd out others).  Which unit makes them toxic is
not labelled: witnesses are the units that stand in different surroundings in toxic
texts significantly more often than in others (near copies repeat their surroundings, so
they count once).  Significant units too short for a subsequence get a positive margin
as they are.  Where no unit is significant, all units that lean to the toxic texts
are trained on.  A text's margin is the largest of its units, a logistic curve fitted on
the sample's texts turns it into a score.

Defined results: NULL and empty texts, and texts without words, score the curve's lower
end; labels are used in training alone; rows with a NULL id are scored and never
trained on; without labels of both classes every score is 0; every row gives one row.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.llm.common import fold, freed, staged
from stratiform.operators.joins import sized_join

SAMPLE_DOCS = 2000  # labelled documents of each class
CANDIDATES = 600  # units looked at as witnesses
WITNESS_LEAST = 3  # surroundings that a witness has at least
FALSE_SHARE = 0.05  # of the witnesses, expected to lean to the toxic texts by chance
LANDMARKS = 64
HARD_ROUNDS, HARD_UNITS = 2, 1000  # rounds of adding the hardest other units of the sample
NEGATIVES = 3000  # other units trained on
DECAY = 0.7
SPAN = 8  # longest stretch of a subsequence
LONGEST = 24  # characters of a unit compared at once; longer ones in overlapping windows
CACHE_UNITS = 100_000  # a worker keeps them from task to task
CHUNK = 1 << 17  # characters of text whose units a task holds at once
_EDGES = re.compile(r"(?<!\S)[\W_]+|[\W_]+(?!\S)")  # what is not a letter or digit at a word's ends
_INSIDE = re.compile(r"[\W_]+")
_SPELLED = re.compile(r"(?<!\S)\S(?:[ \t]\S){2,}(?!\S)")
_scorers: dict[str, "Scorer"] = {}


def units(text: str) -> dict[str, str]:
    """The distinct units of a text and the words around their first place.

    Lower-cased, without punctuation at the ends; a word with punctuation inside also
    counts without it, and spelled-out words count joined.
    """
    text = text.lower()
    words = _EDGES.sub(" ", text).split()
    out: dict[str, str] = {}
    for i, w in enumerate(words):
        if w not in out:
            out[w] = f"{words[i - 1] if i else ''} {words[i + 1] if i + 1 < len(words) else ''}"
            if not w.isalnum():
                out.setdefault(_INSIDE.sub("", w), out[w])
    for m in _SPELLED.finditer(text):
        out.setdefault("".join(m.group().split()), "")
    return out


def _windows(unit: str) -> list[str]:
    if len(unit) <= LONGEST:
        return [unit]
    return [unit[i:i + LONGEST] for i in range(0, len(unit) - LONGEST // 2, LONGEST // 2)]


def _norm(size: np.ndarray, decay: float) -> np.ndarray:
    """Length of the vector of all subsequences of a unit of ``size`` characters, each counted once."""
    total = np.zeros(len(size))
    for span in range(3, SPAN + 1):
        total += (span - 2) * np.maximum(size - span + 1, 0) * decay ** (2 * span)
    return np.sqrt(total)


def _codes(words: list[str], size: int) -> np.ndarray:
    return np.frombuffer("".join(w.ljust(size, "\0") for w in words).encode("utf-32-le", "surrogatepass"),
                         dtype=np.uint32).reshape(len(words), size)


class Kernel:
    """The gap-weighted kernel with a set of landmarks.

    A subsequence of three characters counts ``decay`` to the power of the stretch it
    spans, up to SPAN characters; values are divided by the lengths of both vectors.
    The subsequences of all landmarks are looked up at once, so a unit's cost does not
    depend on how many landmarks there are unless it shares something with them.
    """

    def __init__(self, landmarks: list[str], decay: float):
        self.decay, self.size = decay, len(landmarks)
        self.letters = {ch: i + 1 for i, ch in enumerate(sorted({ch for z in landmarks for ch in z}))}
        self.base = len(self.letters) + 1
        rows: dict[int, np.ndarray] = {}
        for m, z in enumerate(landmarks):
            c = [self.letters[ch] for ch in z]
            for i in range(len(c)):
                for j in range(i + 1, min(len(c), i + SPAN - 1)):
                    for k in range(j + 1, min(len(c), i + SPAN)):
                        row = rows.setdefault((c[i] * self.base + c[j]) * self.base + c[k], np.zeros(self.size))
                        row[m] += decay ** (k - i + 1)
        self.keys = np.array(sorted(rows), dtype=np.int64)
        norm = _norm(np.array([len(z) for z in landmarks]), decay)
        self.rows = np.array([rows[k] for k in self.keys.tolist()]).reshape(-1, self.size) / np.where(norm > 0, norm, 1)
        self.points = np.array(sorted(map(ord, self.letters)), dtype=np.uint32)

    def __call__(self, words: list[str]) -> np.ndarray:
        return self._sums(words, self.rows)

    def weighted(self, words: list[str], weights: np.ndarray) -> np.ndarray:
        """The kernel values times ``weights``, added up subsequence by subsequence."""
        return self._sums(words, (self.rows @ weights)[:, None])[:, 0]

    def _sums(self, words: list[str], rows: np.ndarray) -> np.ndarray:
        out = np.zeros((len(words), rows.shape[1]))
        sizes = np.array([len(w) for w in words])
        if not len(self.keys):
            return out
        for low, high in ((2, 6), (6, 9), (9, 14), (14, LONGEST)):
            at = np.flatnonzero((sizes > low) & (sizes <= high))
            if not len(at):
                continue
            points = _codes([words[i] for i in at], high)
            near = np.minimum(np.searchsorted(self.points, points), len(self.points) - 1)
            c = np.where(self.points[near] == points, near + 1, 0).astype(np.int64)
            for span in range(3, min(SPAN, high) + 1):
                ends = c[:, :high - span + 1] * self.base * self.base + c[:, span - 1:]
                open_ = (c[:, :high - span + 1] > 0) & (c[:, span - 1:] > 0)
                for mid in range(1, span - 1):
                    between = c[:, mid:high - span + 1 + mid]
                    r, q = np.nonzero(open_ & (between > 0))
                    key = ends[r, q] + between[r, q] * self.base
                    k = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                    hit = self.keys[k] == key
                    if rows.shape[1] == 1:
                        out[:, 0] += np.bincount(at[r[hit]], rows[k[hit], 0] * self.decay ** span, len(words))
                    else:
                        np.add.at(out, at[r[hit]], rows[k[hit]] * self.decay ** span)
        norm = _norm(sizes, self.decay)
        return out / np.where(norm > 0, norm, 1)[:, None]


class Scorer:
    """Margins of units under a trained model."""

    def __init__(self, model: dict):
        self.kernel = Kernel(model["landmarks"], model["decay"])
        self.weights, self.bias = np.array(model["weights"]), model["bias"]
        self.slope, self.shift = model["slope"], model["shift"]
        self.short = set(model["short"])
        self.cache: dict[str, float] = {}

    def margins(self, texts: list[str]) -> np.ndarray:
        """The largest unit margin of every text; without units the bias alone."""
        found = [units(t) for t in texts]
        if len(self.cache) > CACHE_UNITS:
            self.cache.clear()
        new = list({u for us in found for u in us if u not in self.cache})
        self.cache.update(zip(new, self.of(new)))
        get = self.cache.__getitem__
        return np.array([max(map(get, us), default=self.bias) for us in found])

    def of(self, new: list[str]) -> list[float]:
        """The margins of units, a long one's that of its best window."""
        out: list[float] = []
        for k in range(0, len(new), 20_000):
            some = new[k:k + 20_000]
            parts = [_windows(u) for u in some]
            value = self.kernel.weighted([w for p in parts for w in p], self.weights) + self.bias
            begin = np.r_[0, np.cumsum([len(p) for p in parts])[:-1]]
            top = np.maximum.reduceat(value, begin).tolist()
            out += [max(m, 1.0) if u in self.short else m for u, m in zip(some, top)]
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(texts) + self.shift, -50, 50)))


def _spread(words: list[str], decay: float, most: int) -> list[str]:
    """Up to ``most`` of the words, each time the one least like those already taken."""
    if not words:
        return []
    alike = Kernel(words, decay)(words)
    taken = [0]
    near = alike[:, 0].copy()
    while len(taken) < min(most, len(words)):
        i = int(np.argmin(near))
        if near[i] > 0.95:
            break
        taken.append(i)
        near = np.maximum(near, alike[:, i])
    return [words[i] for i in taken]


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = 10.0) -> tuple[np.ndarray, float]:
    """Squared-hinge linear support vector machine, by Newton steps on the active rows."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-4
    for _ in range(50):
        active = y * (x @ w) < 1
        a, cw = x[active], c * weight[active]
        new = np.linalg.solve(ridge + (a * cw[:, None]).T @ a, (a * cw[:, None]).T @ y[active])
        if np.allclose(new, w, atol=1e-8):
            break
        w = new
    return w[:-1], float(w[-1])


def _curve(margin: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve from margins to labels (Platt)."""
    n1, n0 = toxic.sum(), (1 - toxic).sum()
    target = np.where(toxic == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x, w = np.c_[margin, np.ones(len(margin))], np.zeros(2)
    weight = np.where(toxic == 1, 0.5 / n1, 0.5 / n0) * len(margin)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        w = w - np.linalg.solve(h, x.T @ (weight * (p - target)) + 1e-3 * w)
    return float(w[0]), float(w[1])


def _chance(k1: int, k0: int, share: float) -> float:
    """Probability that ``k1`` or more of ``k1 + k0`` places are toxic by chance, at the sample's ``share`` of toxic texts."""
    n = k1 + k0
    log = lambda k: (math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
                     + k * math.log(share) + (n - k) * math.log1p(-share))
    return min(1.0, sum(math.exp(log(k)) for k in range(k1, n + 1)))


def _significant(pairs: list[tuple[int, int, int]], tested: int, share: float) -> set[tuple[int, int]]:
    """The (k1, k0) that pass at FALSE_SHARE among ``tested`` units (Benjamini-Hochberg), of (k1, k0, units with them)."""
    ranked = sorted((_chance(k1, k0, share), k1, k0, n) for k1, k0, n in pairs)
    rank, passed = 0, 0
    for i, (p, _, _, n) in enumerate(ranked):
        rank += n
        if p <= FALSE_SHARE * rank / tested:
            passed = i + 1
    return {(k1, k0) for _, k1, k0, _ in ranked[:passed]}


def _chunked(column: pa.Array) -> Iterator[list[str]]:
    """Consecutive texts of a column, about CHUNK characters at a time; NULL counts as empty."""
    some, size = [], 0
    for value in column:
        some.append(value.as_py() or "")
        size += len(some[-1])
        if size >= CHUNK:
            yield some
            some, size = [], 0
    if some:
        yield some


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The units of every text (doc_id, text, toxic), those of some texts at a time."""

    def units_of() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for some in _chunked(batch.column(1)):
                found = [units(t) for t in some]
                at = pa.array(done + np.repeat(np.arange(len(found)), [len(f) for f in found]))
                done += len(some)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(2).take(at),
                     pa.array([u for f in found for u in f], pa.string()),
                     pa.array([c for f in found for c in f.values()], pa.string())], ["doc_id", "toxic", "unit", "around"])

    return freed(units_of())


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, decay: float = DECAY) -> dict | None:
    """The model learnt from labelled rows (doc_id, toxic) of ``labels`` and the texts of ``docs``."""
    known = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # one document for every distinct text of a class
    prints = docs.select("doc_id", F.xxhash64(F.lower(F.coalesce("text", F.lit("")))).alias("print"))
    distinct = staged(sized_join(prints, known, "doc_id", "inner").groupBy("toxic", "print")
                      .agg(F.min("doc_id").alias("doc_id")).select("doc_id", "toxic").distinct(), "distinct-texts")
    picked = None
    for value in (1, 0):
        some = distinct.where(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
        picked = some if picked is None else picked.union(some)
    picked = staged(picked, "sample")

    sampled = staged(sized_join(docs.select("doc_id", "text"), picked, "doc_id", "inner")
                     .select("doc_id", "text", F.col("toxic").cast("int").alias("toxic")).dropDuplicates(["doc_id"])
                     .mapInArrow(_split, "doc_id bigint, toxic int, unit string, around string"), "units")
    size = {r["toxic"]: r["n"] for r in sampled.groupBy("toxic").agg(F.count_distinct("doc_id").alias("n")).collect()}
    if not size.get(0) or not size.get(1):
        return None
    # copies of a document repeat their surroundings, insults stand in many different ones
    counts = staged(sampled.groupBy("unit").agg(
        F.count_distinct(F.when(F.col("toxic") == 1, F.col("around"))).alias("in_toxic"),
        F.count(F.when(F.col("toxic") == 0, 1)).alias("in_other")), "unit-counts")
    leaning = F.col("in_toxic") / F.lit(size[1]) - 20 * F.col("in_other") / F.lit(size[0])
    leans = counts.where(leaning > 0)
    often = F.col("in_toxic") >= WITNESS_LEAST
    tested = counts.where(often).count()
    pairs = [tuple(r) for r in leans.where(often).groupBy("in_toxic", "in_other").count().collect()]
    passed = _significant(pairs, tested, size[1] / (size[0] + size[1]))
    if passed:
        bar = counts.sparkSession.createDataFrame(sorted(passed), "in_toxic bigint, in_other bigint")
        leans = leans.join(F.broadcast(bar), ["in_toxic", "in_other"], "left_semi")
    ranked, brief = leans.orderBy(leaning.desc(), "unit"), F.length("unit") < 3
    witnesses = [r["unit"] for r in ranked.where(~brief).limit(CANDIDATES).select("unit").collect()]
    short = sorted(r["unit"] for r in ranked.where(brief).limit(CANDIDATES).select("unit").collect()) if passed else []
    if not witnesses and not short:
        return None
    other = counts.where((F.col("in_other") > 0) & ~F.col("unit").isin([*witnesses, *short]))
    frequent = other.orderBy(F.col("in_other").desc(), "unit").limit(NEGATIVES // 2)
    chance = other.orderBy(F.xxhash64("unit"), "unit").limit(NEGATIVES // 2)
    negatives = sorted({r["unit"] for r in frequent.union(chance).collect()})
    negatives = [w for u in negatives for w in _windows(u)]
    positives = [w for u in witnesses for w in _windows(u)]
    landmarks = _spread([w for w in positives if len(w) >= 3], decay, LANDMARKS)
    landmarks += [w for w in negatives[::max(1, len(negatives) // 6)] if len(w) >= 3 and w not in landmarks][:6]
    compare = Kernel(landmarks, decay)
    value, vector = np.linalg.eigh(compare(landmarks))
    strong = value > 1e-6
    root = vector[:, strong] / np.sqrt(value[strong])  # landmarks to the space of the kernel

    def fitted(negatives: list[str]) -> dict:
        if not positives:  # short witnesses alone
            return {"landmarks": landmarks, "decay": decay, "weights": [0.0] * len(landmarks), "bias": -1.0, "slope": 1.0,
                    "shift": 0.0, "short": short}
        words = positives + negatives
        y = np.r_[np.ones(len(positives)), -np.ones(len(negatives))]
        weight = np.where(y > 0, 0.5 / len(positives), 0.5 / len(negatives)) * len(y)
        w, bias = _svm(compare(words) @ root, y, weight)
        return {"landmarks": landmarks, "decay": decay, "weights": (root @ w).tolist(), "bias": bias, "slope": 1.0, "shift": 0.0,
                "short": short}

    model = fitted(negatives)
    for _ in range(HARD_ROUNDS):  # the sample's other units that the model takes for insults
        hard = (other.select("unit").mapInArrow(_unit_margins(model), "unit string, margin double")
                .orderBy(F.col("margin").desc(), "unit").limit(HARD_UNITS).collect())
        negatives = sorted({*negatives, *(w for r in hard for w in _windows(r["unit"]))})
        model = fitted(negatives)
    # the curve, from the largest margin of every sampled document
    top = sampled.select("doc_id", "toxic", "unit").mapInArrow(_margins_of(model), "doc_id bigint, toxic int, margin double")
    rows = top.groupBy("doc_id", "toxic").agg(F.max("margin").alias("margin")).collect()
    model["slope"], model["shift"] = _curve(np.array([r["margin"] for r in rows]), np.array([r["toxic"] for r in rows]))
    return model


def _scorer(model: dict) -> Scorer:
    key = repr(sorted(model.items()))
    if key not in _scorers:
        _scorers.clear()
        _scorers[key] = Scorer(model)
    return _scorers[key]


def _unit_margins(model: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(model)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scorer.of(batch.column(0).to_pylist()), pa.float64())],
                                             ["unit", "margin"])

    return run


def _margins_of(model: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(model)
        for batch in batches:
            margin = scorer.of(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(margin, pa.float64())],
                                             ["doc_id", "toxic", "margin"])

    return run


def score_toxicity(docs: DataFrame, labels: DataFrame, bound: float = 0.7, sample_docs: int = SAMPLE_DOCS,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, score and predicted (score >= ``bound``).

    Labels (doc_id, toxic) are learnt only where crc32 of the id modulo 3 is not 1.
    """
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    seen = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "toxic").where(fold() != 1)
    model = train(docs, seen, sample_docs)

    def scores_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(model) if model else None
        for batch in batches:
            scores = []
            for some in _chunked(batch.column(1)):
                scores += (scorer.scores(some) if scorer else np.zeros(len(some))).tolist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return freed(scores_of(batches))

    scored = docs.mapInArrow(run, "doc_id bigint, score double")
    return scored.select("doc_id", (fold() == 1).alias("held_out"), "score",
                         (F.col("score") >= bound).cast("int").alias("predicted"))
