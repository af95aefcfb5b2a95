"""Language identification by a linear-chain conditional random field.

Every word of a text is labelled with a language.  Word potentials are
log-linear in affixes, character n-grams and the word itself (the lexicon),
transition potentials are learned, and forward-backward gives each word's
marginals - so passages in another language get their own labels.  A text's
language is that with the largest sum of marginals.

Only texts' languages are known in training, not words'.  The word labels
start as the text's language; rounds of forward-backward over the sample,
drawn to that language, give expected labels and transitions, from which both
kinds of potentials are fitted again."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marisnow.llm.common import discard, with_kernel, written

#: rows of each language that the fit sees, in the order of a hash of the id,
#: and code points in all; a row that would go beyond is passed over
MAX_ROWS, MAX_CHARS = 400, 3_000_000
#: parts that the rows of a language are dealt into for that
SALTS = 16
ROUNDS, STEPS = 2, 30
#: how strongly the sample's words are drawn to their text's language (log odds)
DRAW = 2.0
UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")
#: words x texts that forward-backward takes at once
CELLS = 200_000
KNOWN_WORDS = 200_000


def _mix(h: np.ndarray, code: np.ndarray) -> np.ndarray:
    h = (h ^ code) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``(key, word number)`` of all words' features, by word: affixes of one
    to four letters and n-grams of two and three with the word's ends.  Keys
    are 64-bit hashes of the kind and the code points."""
    ends = "".join(f"<{w}>" for w in words)
    codes = np.frombuffer(ends.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    size = np.array([len(w) for w in words], dtype=np.int64)
    first = np.cumsum(size + 2) - size - 1  # of the word's own letters
    number = np.arange(len(words))
    keys, owner = [], []
    with np.errstate(over="ignore"):
        for kind, step in ((1, 1), (2, -1)):
            h = np.full(len(words), kind, dtype=np.uint64)
            for k in range(4):
                on = np.flatnonzero(size > k)
                at = first[on] + k if step > 0 else first[on] + size[on] - 1 - k
                h[on] = _mix(h[on], codes[at])
                keys.append(h[on])
                owner.append(on)
        all_of = np.repeat(number, size + 2)
        start = _mix(np.full(len(codes), 3, dtype=np.uint64), codes)
        two = _mix(start[:-1], codes[1:])
        inside = np.flatnonzero(all_of[:-1] == all_of[1:])
        keys.append(two[inside])
        owner.append(all_of[inside])
        inside = inside[:-1][all_of[inside[:-1]] == all_of[np.minimum(inside[:-1] + 2, len(codes) - 1)]] if len(inside) else inside
        keys.append(_mix(two[inside] ^ np.uint64(4), codes[inside + 2]))
        owner.append(all_of[inside])
    key, owner = np.concatenate(keys), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return key[order], owner[order]


def _words(text: str) -> list[str]:
    """Lower-case runs that hold a letter (a lone \u00bd or \u2167 is none)."""
    return [w for w in WORD.findall(text.lower()) if w.isalpha() or any(c.isalpha() for c in w)]


def marginals(words: list[np.ndarray], emission: np.ndarray, step: np.ndarray, draw=None):
    """Per text the (words x labels) marginals of forward-backward; ``words``
    are row numbers of ``emission`` (log), ``step`` the transition matrix
    (log), ``draw`` an extra potential per text.  Texts of like length run
    side by side.  Yields (text number, marginals, expected transitions)."""
    move = np.exp(step - step.max())
    order = np.argsort([len(w) for w in words], kind="stable")[::-1]
    at = 0
    while at < len(order) and len(words[order[at]]):
        longest = len(words[order[at]])
        group = order[at:at + max(1, CELLS // longest)]
        group = group[[len(words[i]) > 0 for i in group]]
        at += len(group)
        size = np.array([len(words[i]) for i in group])
        index = np.zeros((longest, len(group)), dtype=np.int64)
        for c, i in enumerate(group):
            index[:size[c], c] = words[i]
        score = emission[index]
        if draw is not None:
            score = score + draw[group][None]
        pot = np.exp(score - score.max(axis=2, keepdims=True))
        live = np.searchsorted(-size, -np.arange(longest), side="left")  # texts longer than t
        fwd = np.zeros_like(pot)
        now = pot[0] / pot[0].sum(1, keepdims=True)
        fwd[0] = now
        for t in range(1, longest):
            n = live[t]
            now = (now[:n] @ move) * pot[t, :n]
            now /= now.sum(1, keepdims=True)
            fwd[t, :n] = now
        back = np.ones(pot.shape[1:])
        expect = np.zeros_like(step)
        for t in range(longest - 1, -1, -1):
            n = live[t]
            if t + 1 < longest:
                m = live[t + 1]
                ahead = back[:m] * pot[t + 1, :m]
                if draw is not None:
                    joint = fwd[t, :m, :, None] * move * ahead[:, None, :]
                    expect += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
                ahead = ahead @ move.T
                back[:m] = ahead / ahead.sum(1, keepdims=True)
            fwd[t, :n] *= back[:n]
        fwd /= np.maximum(fwd.sum(2, keepdims=True), 1e-300)
        for c, i in enumerate(group):
            yield int(i), fwd[:size[c], c], None
        if draw is not None:
            yield -1, None, expect


@dataclass
class LanguageModel:
    """``keys`` (sorted) and ``lexicon`` give the row of ``weights`` of a
    feature or of a word as a whole."""

    labels: list[str] = field(default_factory=list)
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.uint64))
    lexicon: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    step: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))

    def rows(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Known features of the words: (row of the weights, word number), by
        word."""
        if not words:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        key, owner = features(words)
        at = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
        hit = self.keys[at] == key if len(self.keys) else np.zeros(len(key), dtype=bool)
        whole = np.array([self.lexicon.get(w, -1) for w in words], dtype=np.int64)
        known = np.flatnonzero(whole >= 0)
        row, owner = np.r_[at[hit], whole[known]], np.r_[owner[hit], known]
        order = np.argsort(owner, kind="stable")
        return row[order], owner[order]

    def emission(self, words: list[str]) -> np.ndarray:
        """(words x labels) potentials: the sums of the known features'
        weights."""
        return _sums(*self.rows(words), len(words), self.weights)


def _sums(row: np.ndarray, owner: np.ndarray, n: int, weights: np.ndarray) -> np.ndarray:
    out = np.zeros((n, weights.shape[1]))
    if len(row):
        heads = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        out[owner[heads]] = np.add.reduceat(weights[row], heads, axis=0)
    return out


def _fit_words(row: np.ndarray, owner: np.ndarray, target: np.ndarray, weights: np.ndarray, steps: int) -> np.ndarray:
    """Gradient steps (Adam) for the log-linear word potentials against the
    expected label counts of each word."""
    has, owner = np.unique(owner, return_inverse=True)
    heads = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    target = target[has]
    mass = target.sum(1, keepdims=True)
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    total = mass.sum()
    for k in range(1, steps + 1):
        z = np.add.reduceat(weights[row], heads, axis=0)
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        spread = ((p * mass - target) / total)[owner]
        grad = np.stack([np.bincount(row, spread[:, c], len(weights)) for c in range(weights.shape[1])], axis=1) + 1e-7 * weights
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad * grad
        weights = weights - 0.1 * (first / (1 - 0.9 ** k)) / (np.sqrt(second / (1 - 0.99 ** k)) + 1e-8)
    return weights


def fit_texts(texts: list[str], langs: list[str], rounds: int = ROUNDS, steps: int = STEPS) -> LanguageModel:
    """Model from texts and their languages; without texts a model that knows
    no language."""
    labels = sorted(set(langs))
    if not labels:
        return LanguageModel()
    known: dict[str, int] = {}
    docs = [np.array([known.setdefault(w, len(known)) for w in _words(t)], dtype=np.int64) for t in texts]
    names = list(known)
    uses = np.bincount(np.concatenate(docs), minlength=len(names)) if names else np.zeros(0)
    keys, count = np.unique(features(names)[0], return_counts=True) if names else (np.zeros(0, dtype=np.uint64), np.zeros(0))
    keys = keys[count >= 3]
    lexicon = {w: len(keys) + i for i, w in enumerate(w for w, n in zip(names, uses) if n >= 3)}
    y = np.array([labels.index(x) for x in langs])
    weights = np.zeros((len(keys) + len(lexicon), len(labels)))
    move = np.full((len(labels), len(labels)), 1.0) + 50 * np.eye(len(labels))
    step = np.log(move / move.sum(1, keepdims=True))
    model = LanguageModel(labels, keys, lexicon, weights, step)
    row, owner = model.rows(names)
    target = np.zeros((len(names), len(labels)))
    for d, label in zip(docs, y):
        target[:, label] += np.bincount(d, minlength=len(names)) if len(d) else 0
    for turn in range(rounds + 1):
        if len(row):
            model.weights = _fit_words(row, owner, target, model.weights, steps)
        if turn == rounds:
            break
        draw = np.zeros((len(docs), len(labels)))
        draw[np.arange(len(docs)), y] = DRAW
        target = np.zeros_like(target)
        seen = np.ones_like(step)
        for i, gamma, expect in marginals(docs, _sums(row, owner, len(names), model.weights), model.step, draw):
            if i < 0:
                seen += expect
            else:
                for c in range(len(labels)):
                    target[:, c] += np.bincount(docs[i], gamma[:, c], len(names))
        model.step = np.log(seen / seen.sum(1, keepdims=True))
    return model


def held_out(doc_id: Column) -> Column:
    """Rows that the fit must not see."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def fit(docs: DataFrame, max_rows: int = MAX_ROWS, max_chars: int = MAX_CHARS) -> LanguageModel:
    """Fit on a bounded sample of rows outside the held-out fold: at most
    ``max_rows`` of each language in the order of a hash of the id, whole
    texts up to ``max_chars`` code points in all.  Null texts, languages and
    ids are passed over."""
    rows = docs.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull())
    ids = rows.select("doc_id", "lang").withColumn("place", F.xxhash64("doc_id")).withColumn("salt", F.pmod("place", F.lit(SALTS)))
    nth = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy("place", "doc_id"))
    # the first ones of each salt, then of these the first: no language meets in one task
    few = ids.withColumn("nth", nth("lang", "salt")).filter(F.col("nth") <= max_rows)
    chosen = few.withColumn("nth", nth("lang")).filter(F.col("nth") <= max_rows).select("doc_id", "place").distinct()
    # of several texts under one id that of the smallest hash
    got = written(rows.filter("text is not null").select("doc_id", "text", "lang").join(F.broadcast(chosen), "doc_id")
                  .groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text", "lang", "place")).alias("r"))
                  .select("doc_id", "r.text", "r.lang", "r.place"), "langid-sample")
    total, taken = 0, []
    for r in got.select("doc_id", F.length("text").alias("n")).orderBy("place", "doc_id").collect():
        if total + r["n"] <= max_chars:
            total += r["n"]
            taken.append((r["doc_id"],))
    picked = got.join(F.broadcast(got.sparkSession.createDataFrame(taken, StructType([got.schema["doc_id"]]))), "doc_id")
    pdf = picked.orderBy("place", "doc_id").select("text", "lang").toPandas()
    discard(got)
    return fit_texts(pdf["text"].tolist(), pdf["lang"].tolist())


class Reader:
    """A task's labeller: word potentials are kept from batch to batch, up
    to KNOWN_WORDS words."""

    def __init__(self, model: LanguageModel):
        self.model, self.known = model, {}
        self.table = np.zeros((0, len(model.labels)))

    def __call__(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not self.model.labels:
            return names, scores
        if len(self.known) > KNOWN_WORDS:
            self.known, self.table = {}, self.table[:0]
        put = self.known.setdefault
        docs = [np.array([put(w, len(self.known)) for w in _words(t)], dtype=np.int64) for t in texts]
        new = list(self.known)[len(self.table):]
        self.table = np.concatenate([self.table, self.model.emission(new)])
        for i, gamma, _ in marginals(docs, self.table, self.model.step):
            share = gamma.sum(0) / len(gamma)
            best = int(share.argmax())
            names[i], scores[i] = self.model.labels[best], min(float(share[best]), 1.0)
        return names, scores


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``lang_pred`` and ``score``, the predicted language's
    mean marginal over the text's words.

    Whole texts are read.  Null texts and texts without a letter, and all
    texts if nothing was learned, are ``und`` with score 0; equal texts get
    equal results; an empty table gives no rows.  Columns named like new ones
    are replaced, others pass through."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the fit's sample
    opened: list[Reader] = []

    def kernel(texts):
        if not opened:
            opened.append(Reader(sent.value))
        names, scores = [], []
        lo = 0
        while lo < len(texts):
            hi, total = lo, 0
            while hi < len(texts) and (hi == lo or total + len(texts[hi]) < 2_000_000):
                total += len(texts[hi])
                hi += 1
            a, b = opened[0](texts[lo:hi])
            names += a
            scores.append(b)
            lo = hi
        return [pa.array(names, pa.string()), pa.array(np.concatenate(scores) if scores else np.zeros(0))]

    return with_kernel(docs, text_col, kernel, "lang_pred string, score double")
