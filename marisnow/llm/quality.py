"""Quality classifier: random-indexing word vectors pooled per document, and a
two-layer network with a calibrated temperature.

Plan
----
1. Every token (word, number, run of marks) falls into one of BUCKETS by a
   hash; each bucket has a sparse ternary index vector.  One pass over all
   documents adds to a bucket's context vector the index vectors of the tokens
   around its own; a task sends one row per bucket, sums are whole numbers.
2. A document is the mean of its tokens' vectors, beside the sum over its
   different buckets per token, which falls when a text repeats itself.
3. The network (tanh layer, logistic output) is fitted in numpy on the pooled
   vectors of a bounded sample of labelled rows; one part of the sample is set
   aside, and there the temperature that divides the network's output is the
   one of least log loss.
4. Every document is pooled and scored in one pass.

The word table and the network have fixed sizes, whatever the corpus."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marisnow.llm.common import as_text, with_kernel

#: buckets of words (any case but capitals only), of words in capitals, of numbers, of runs of marks
WORDS, CAPITALS, NUMBERS, MARKS = 6144, 1024, 256, 768
BUCKETS = WORDS + CAPITALS + NUMBERS + MARKS
DIMS, NONZERO = 32, 4
#: tokens on either side that are a token's context
REACH = 2
#: labelled rows of each class that the fit sees, in the order of a hash of the id
MAX_ROWS = 4000
HIDDEN, STEPS, RATE, DECAY = 24, 400, 0.02, 2e-3
#: one in so many rows of the sample sets the temperature
CALIBRATE = 5
THRESHOLD = 0.3
#: code points whose tokens are listed at once, tokens whose vectors are summed at once
PIECE, RUN = 500_000, 200_000
KNOWN = 300_000

TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
SPACE = re.compile(r"\s")


class _Buckets(dict):
    """token -> bucket, remembered up to KNOWN tokens."""

    def __missing__(self, token):
        c = token[0]
        if c.isalpha():
            capitals = len(token) > 1 and token.isupper()
            low, size, name = (WORDS, CAPITALS, token) if capitals else (0, WORDS, token.lower())
        elif c.isdigit():
            low, size, name = WORDS + CAPITALS, NUMBERS, str(len(token))
        else:
            low, size, name = WORDS + CAPITALS + NUMBERS, MARKS, token[:8]
        got = low + zlib.crc32(name.encode("utf-8", "surrogatepass")) % size
        if len(self) >= KNOWN:
            self.clear()
        self[token] = got
        return got


def buckets_of(text: str, known: _Buckets) -> np.ndarray:
    """Buckets of all tokens of the text; a long text is taken in pieces that
    end at white space."""
    out, at = [], 0
    while at < len(text):
        end = at + PIECE
        if end < len(text):
            gap = SPACE.search(text, end)
            end = gap.start() if gap else len(text)
        out.append(np.array([known[t] for t in TOKEN.findall(text[at:end])], dtype=np.int32))
        at = end
    return np.concatenate(out) if out else np.zeros(0, dtype=np.int32)


def index_vectors(seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of each bucket's index vector."""
    rng = np.random.default_rng(seed)
    return rng.random((BUCKETS, DIMS)).argsort(1)[:, :NONZERO], rng.integers(0, 2, (BUCKETS, NONZERO)) * 2 - 1


def _runs(parts):
    """Lists of (number, buckets) that hold about RUN tokens."""
    held, total = [], 0
    for i, ids in parts:
        held.append((i, ids))
        total += len(ids)
        if total >= RUN:
            yield held
            held, total = [], 0
    if held:
        yield held


def add_contexts(total: np.ndarray, count: np.ndarray, held, place: np.ndarray, sign: np.ndarray) -> None:
    """Adds the contexts of a run of texts to the sums (flat, buckets x dims)
    and counts."""
    ids = np.concatenate([p[1] for p in held]).astype(np.int64)
    text = np.repeat(np.arange(len(held)), [len(p[1]) for p in held])
    count += np.bincount(ids, minlength=BUCKETS)
    for off in range(1, REACH + 1):
        near = text[off:] == text[:-off]
        left, right = ids[:-off][near], ids[off:][near]
        for word, context in ((left, right), (right, left)):
            for k in range(NONZERO):
                total += np.bincount(word * DIMS + place[context, k], sign[context, k], BUCKETS * DIMS).astype(np.int64)


def count_contexts(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Context sums (buckets x dims) and token counts over all documents."""
    names = [f"c{j}" for j in range(DIMS)]

    def run(batches):
        place, sign = index_vectors()
        total, count, known = np.zeros(BUCKETS * DIMS, dtype=np.int64), np.zeros(BUCKETS, dtype=np.int64), _Buckets()
        for b in batches:
            texts = (t.as_py().decode("utf-8", "replace") for t in b.column(0))
            for held in _runs((i, buckets_of(t, known)) for i, t in enumerate(texts)):
                add_contexts(total, count, held, place, sign)
        total = total.reshape(BUCKETS, DIMS)
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(count[at]), *(pa.array(total[at, j]) for j in range(DIMS))],
                                         ["bucket", "n", *names])

    ddl = "bucket int, n long, " + ", ".join(f"{c} long" for c in names)
    sums = (docs.filter(F.col(text_col).isNotNull()).select(as_text(F.col(text_col)).alias("t")).mapInArrow(run, ddl)
            .groupBy("bucket").agg(F.sum("n").alias("n"), *(F.sum(c).alias(c) for c in names)).toPandas())
    total, count = np.zeros((BUCKETS, DIMS)), np.zeros(BUCKETS)
    total[sums["bucket"]], count[sums["bucket"]] = sums[names], sums["n"]
    return total, count


def word_table(total: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Unit vectors of all buckets: the mean context less what all tokens
    share, beside the bucket's own index vector, and a constant 1."""
    place, sign = index_vectors()
    own = np.zeros((BUCKETS, DIMS))
    own[np.arange(BUCKETS)[:, None], place] = sign / NONZERO ** 0.5
    mean = total / np.maximum(count, 1)[:, None]
    mean = np.where(count[:, None] > 0, mean - total.sum(0) / max(count.sum(), 1), 0.0)
    mean /= np.maximum(np.linalg.norm(mean, axis=1, keepdims=True), 1e-12)
    return np.hstack([mean + own, np.ones((BUCKETS, 1))]).astype(np.float32)


def pooled(held, table: np.ndarray) -> np.ndarray:
    """Per text of a run the mean of its tokens' vectors, and the sum over
    its different buckets divided by the number of tokens."""
    size = np.array([len(p[1]) for p in held])
    out = np.zeros((len(held), 2 * table.shape[1]), dtype=np.float32)
    if size.sum():
        ids = np.concatenate([p[1] for p in held]).astype(np.int64)
        key, n = np.unique(np.repeat(np.arange(len(held)), size) * BUCKETS + ids, return_counts=True)
        text, vec = key // BUCKETS, table[key % BUCKETS].astype(float)
        heads = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
        has = text[heads]
        both = np.hstack([vec * n[:, None], vec])
        out[has] = np.add.reduceat(both, heads, axis=0) / size[has][:, None]
    return out


@dataclass
class QualityModel:
    table: np.ndarray = field(default_factory=lambda: np.zeros((BUCKETS, DIMS + 1), dtype=np.float32))
    middle: np.ndarray = field(default_factory=lambda: np.zeros(2 * DIMS + 2))
    spread: np.ndarray = field(default_factory=lambda: np.ones(2 * DIMS + 2))
    layers: list = field(default_factory=list)
    bias: float = 0.0
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        if not self.layers:
            return np.full(len(x), self.bias)
        w1, b1, w2, b2 = self.layers
        return np.tanh((x - self.middle) / self.spread @ w1 + b1) @ w2 + b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def train(x: np.ndarray, y: np.ndarray, hidden: int = HIDDEN, steps: int = STEPS, seed: int = 0) -> list:
    """Two layers by Adam on the log loss with weight decay."""
    rng = np.random.default_rng(seed)
    rate = np.clip(y.mean(), 0.01, 0.99)
    theta = [rng.standard_normal((x.shape[1], hidden)) / x.shape[1] ** 0.5, np.zeros(hidden),
             rng.standard_normal(hidden) / hidden ** 0.5, np.array(np.log(rate / (1 - rate)))]
    first, second = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
    for k in range(1, steps + 1):
        w1, b1, w2, b2 = theta
        h = np.tanh(x @ w1 + b1)
        e = (1.0 / (1.0 + np.exp(-np.clip(h @ w2 + b2, -30, 30))) - y) / len(y)
        back = e[:, None] * w2 * (1 - h * h)
        grads = [x.T @ back + DECAY * w1, back.sum(0), h.T @ e + DECAY * w2, e.sum()]
        for i, g in enumerate(grads):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            theta[i] = theta[i] - RATE * (first[i] / (1 - 0.9 ** k)) / (np.sqrt(second[i] / (1 - 0.999 ** k)) + 1e-8)
    return theta


def best_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss; 1 without both labels."""
    if not len(y) or y.min() == y.max():
        return 1.0
    signed = np.where(y > 0, logits, -logits)
    grid = np.exp(np.linspace(np.log(0.25), np.log(8.0), 200))
    loss = [np.logaddexp(0.0, -signed / t).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def fit_pooled(x: np.ndarray, y: np.ndarray, aside: np.ndarray, table: np.ndarray) -> QualityModel:
    """Model from pooled vectors and labels; rows of ``aside`` only set the
    temperature.  Without both labels every score is the share of label 1
    (one half without rows)."""
    if not len(y) or y[~aside].size == 0 or y[~aside].min() == y[~aside].max():
        rate = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
        return QualityModel(table=table, bias=float(np.log(rate / (1 - rate))))
    use = x[~aside]
    middle, spread = use.mean(0), np.maximum(use.std(0), 1e-6)
    model = QualityModel(table, middle, spread, train((use - middle) / spread, y[~aside]))
    model.temperature = best_temperature(model.logits(x[aside]), y[aside])
    return model


def _pool_kernel(table: np.ndarray, finish):
    """Kernel over a batch's texts; ``finish`` turns pooled rows into arrays."""
    known = _Buckets()

    def kernel(texts):
        x = np.zeros((len(texts), 2 * table.shape[1]), dtype=np.float32)
        for held in _runs((i, buckets_of(t, known)) for i, t in enumerate(texts)):
            x[[p[0] for p in held]] = pooled(held, table)
        return finish(x)

    return kernel


def held_out(doc_id: Column) -> Column:
    """Rows whose labels the fit must not see."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def sample(labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """``(doc_id, quality, place)``: at most ``max_rows`` ids of each label
    outside the held-out fold, in the order of a hash.  Null ids and labels
    other than 0 and 1 are passed over, and ids labelled both ways."""
    known = (labels.filter(~held_out(F.col("doc_id")) & F.col("quality").isin(0, 1))
             .groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"), F.max("quality").cast("int").alias("_high"))
             .filter("quality = _high").drop("_high").withColumn("place", F.xxhash64("doc_id")))
    take = lambda q: known.filter(F.col("quality") == q).orderBy("place", "doc_id").limit(max_rows)
    return take(0).unionByName(take(1))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> QualityModel:
    """Word table from all documents, network from the bounded sample of
    labelled rows.  Of several texts under one id the sample takes the one of
    the smallest hash."""
    table = word_table(*count_contexts(docs))
    arrays = lambda x: [pa.array(list(x.astype(float)), pa.list_(pa.float64()))]
    rows = (docs.select("doc_id", "text").filter("text is not null").join(F.broadcast(sample(labels, max_rows)), "doc_id")
            .withColumn("_h", F.xxhash64("text")))
    got = (with_kernel(rows, "text", _pool_kernel(table, arrays), "x array<double>").groupBy("doc_id")
           .agg(F.min(F.struct("_h", "place", "quality", "x")).alias("r")).select("r.*", "doc_id").orderBy("place", "doc_id").toPandas())
    x = np.array(got["x"].tolist()).reshape(len(got), -1) if len(got) else np.zeros((0, 2 * DIMS + 2))
    aside = (got["place"].to_numpy(np.int64) >> 8) % CALIBRATE == 0 if len(got) else np.zeros(0, dtype=bool)
    return fit_pooled(x, got["quality"].to_numpy(float) if len(got) else np.zeros(0), aside, table)


def score(docs: DataFrame, model: QualityModel, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` plus ``score`` (0 to 1) and ``predicted`` (1 from
    ``threshold`` up).

    Whole texts are read, whatever their length.  Null and empty texts, and
    those without any token, are the zero vector and get its score.  Rows are
    judged one by one, so repeated rows, null ids and an empty table need no
    rule; columns named score or predicted are replaced, others pass through."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size
    opened: list = []

    def finish(x):
        p = sent.value.probability(x)
        return [pa.array(p), pa.array((p >= threshold).astype(np.int32))]

    def kernel(texts):
        if not opened:
            opened.append(_pool_kernel(sent.value.table, finish))
        return opened[0](texts)

    return with_kernel(docs, text_col, kernel, "score double, predicted int")
