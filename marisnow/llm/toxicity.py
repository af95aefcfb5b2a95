"""Toxicity by a weighted finite-state pattern grammar.

Words become symbols (insult, threat, target, negation, reported speech,
other).  Small transducers - negation with a scope of a few words, reported
speech up to the clause's end, target with a scope - are composed into one
machine by the product construction.  It runs over each clause and puts the
weight of every insult or threat it matches under the tag of the context it
stands in; a document's score is a logistic function of these clause sums.

The insult lexemes with their weights and the logistic weights are learned
from labelled rows; nothing but the text is an input of a score.  A lexeme is
a word, or a family: a word beginning of which a text holds several different
derived words.  One derived word alone is no insult, as the beginning occurs
in harmless texts too."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marisnow.llm.common import with_kernel, written

#: rows of each class that the fit sees, in the order of a hash of the id
MAX_POSITIVE, MAX_NEGATIVE = 2000, 4000
#: code points of text that the fit sees in all; a row that would go beyond is passed over
MAX_CHARS = 40_000_000
MIN_DF, MIN_LOG_ODDS, MAX_WEIGHT = 3, 3.0, 6.0
#: how far (in log probability) a lexeme's evidence has to lie beyond what the best of all tried would show by chance
MARGIN = 3.0
#: lengths of a family's common beginning, and how many derived words make one of it
PREFIXES = (4, 5, 6, 7, 8)
FAMILY = 3

# Fixed word lists of the grammar (English, German, French, Spanish).
THREATS = "kill hurt destroy beat burn shoot stab töten umbringen verletzen tuer frapper détruire matar golpear destruir"
TARGETS = "you your yours he she they them du dich euch sie ihr tu toi vous ils elles tú usted ustedes ellos"
NEGATIONS = "not no never nobody without nicht kein keine nie ne pas jamais sans nunca sin"
REPORTS = "said says say called calls wrote quoted claimed sagte schrieb nannte dit écrit appelé dijo llamó escribió"

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
NEGATED, REPORTED, TARGETED = 1, 2, 4
WORD = re.compile(r"[^\W\d_]+")
PART = re.compile(r"[^\W\d_]+|[.!?;:\n]")


@dataclass
class Transducer:
    """Deterministic machine: ``move(state, symbol) -> (state, tag bits)``."""

    move: callable
    start: int = 0


def _scope(opener: int, words: int, tag: int) -> Transducer:
    """Tags insults and threats up to ``words`` words after ``opener``."""

    def move(state, symbol):
        if symbol == opener:
            return words, 0
        return max(0, state - 1), tag if state and symbol in (INSULT, THREAT) else 0

    return Transducer(move)


def _until_end(opener: int, tag: int) -> Transducer:
    def move(state, symbol):
        return int(state or symbol == opener), tag if state and symbol in (INSULT, THREAT) else 0

    return Transducer(move)


def compose(*parts: Transducer) -> tuple[np.ndarray, np.ndarray]:
    """Product machine over the reachable states: tables ``next`` and ``tag``
    by state and symbol; state 0 is the start."""
    states = {tuple(p.start for p in parts): 0}
    nxt, tag, todo = [], [], list(states)
    while todo:
        here = todo.pop(0)
        row, bits = [], []
        for symbol in range(6):
            moves = [p.move(s, symbol) for p, s in zip(parts, here)]
            there = tuple(m[0] for m in moves)
            if there not in states:
                states[there] = len(states)
                todo.append(there)
            row.append(states[there])
            bits.append(sum(m[1] for m in moves))
        nxt.append(row)
        tag.append(bits)
    return np.array(nxt), np.array(tag)


GRAMMAR = (_scope(NEGATION, 3, NEGATED), _until_end(REPORT, REPORTED), _scope(TARGET, 4, TARGETED))
FIXED = {w: s for s, ws in ((THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS))
         for w in ws.split()}
#: per-document sums: insults plain, negated, reported, with a target; threats with a target; matched clauses
N_FEATURES = 6
#: where the logistic weights are drawn to when data say little
PRIOR = np.array([1.0, 0.3, 0.3, 0.5, 0.5, 0.2])


class _Lexicon(dict):
    """word -> (symbol, weight, families it belongs to), found once per word
    and task."""

    def __init__(self, lexemes: dict[str, float]):
        super().__init__()
        self.lexemes = lexemes

    def __missing__(self, word):
        got = self.lexemes.get(word, 0.0)
        stems = tuple(s for s in _stems(word) if s in self.lexemes)
        value = (INSULT if got else FIXED.get(word, OTHER), got, stems)
        if len(self) > 300_000:
            self.clear()
        self[word] = value
        return value


@dataclass
class ToxicityModel:
    lexemes: dict[str, float] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(N_FEATURES))
    bias: float = -50.0

    def opened(self):
        return _Lexicon(self.lexemes), *(t.tolist() for t in compose(*GRAMMAR))

    def features(self, text: str, opened) -> list[float]:
        lexicon, nxt, tag = opened
        low = text.lower()
        found = [0.0] * N_FEATURES
        words = set(WORD.findall(low))
        derived = Counter(stem for w in words for stem in lexicon[w][2])
        families = {stem: lexicon.lexemes[stem] for stem, n in derived.items() if n >= FAMILY}
        if not families and not any(lexicon[w][0] in (INSULT, THREAT) for w in words):
            return found
        state, matched = 0, False
        for part in PART.findall(low):
            if part in ".!?;:\n":
                found[5] += matched
                state, matched = 0, False
                continue
            symbol, weight, stems = lexicon[part]
            for stem in stems:
                if stem in families:
                    symbol, weight = INSULT, max(weight, families[stem])
            bits = tag[state][symbol]
            state = nxt[state][symbol]
            if symbol == INSULT:
                found[1 if bits & NEGATED else 2 if bits & REPORTED else 3 if bits & TARGETED else 0] += weight
                matched = True
            elif symbol == THREAT and bits == TARGETED:
                found[4] += MAX_WEIGHT / 2
                matched = True
        found[5] += matched
        return found

    def probability(self, rows) -> np.ndarray:
        x = np.log1p(np.array(rows, dtype=float).reshape(-1, N_FEATURES))
        return 1 / (1 + np.exp(-np.clip(x @ self.weights + self.bias, -30, 30)))


def _stems(word: str) -> list[str]:
    return [word[:k] + "*" for k in PREFIXES if len(word) > k]


def _lexeme_names(words: set[str]) -> list[str]:
    """Lexemes that a text with these words may hold."""
    stems = Counter(s for w in words for s in _stems(w))
    return [*(w for w in words if len(w) >= 3), *(s for s, n in stems.items() if n >= FAMILY)]


def fit_texts(texts: list[str], toxic: list[int]) -> ToxicityModel:
    """Model from labelled texts.  Without both labels every score is the
    share of label 1 (0 without rows)."""
    y = np.array(toxic, dtype=float)
    if not len(y) or y.min() == y.max():
        rate = float(y.mean()) if len(y) else 0.0
        return ToxicityModel(bias=30.0 if rate >= 0.5 else -30.0)
    words = [WORD.findall(t.lower()) for t in texts]

    def key_of(name):  # odd for families
        return hash(name) & -2 | name.endswith("*")

    def names_of(ws):
        return np.unique(np.fromiter((key_of(n) for n in _lexeme_names(set(ws))), dtype=np.int64))

    seen = {0: [], 1: []}
    for ws, label in zip(words, toxic):
        seen[label].append(names_of(ws))
    key, df = np.unique(np.concatenate(seen[1]), return_counts=True)
    tried = len(key) - int((key & 1).sum()), int((key & 1).sum())  # words, families
    key, df = key[df >= MIN_DF], df[df >= MIN_DF]
    other, count = np.unique(np.concatenate(seen[0]), return_counts=True)
    at = np.minimum(np.searchsorted(other, key), max(len(other) - 1, 0))
    neg = np.where(other[at] == key, count[at], 0) if len(other) else np.zeros(len(key))
    odds = np.log((df + 0.5) / (len(seen[1]) + 1)) - np.log((neg + 0.5) / (len(seen[0]) + 1))
    strong = {int(k): (float(min(o, MAX_WEIGHT)), int(d), int(n))
              for k, o, d, n in zip(key, odds, df, neg) if o >= MIN_LOG_ODDS}
    places: dict[str, set] = {}
    for ws, label in zip(words, toxic):
        if label:
            good = {n for n in _lexeme_names(set(ws)) if key_of(n) in strong}
            derived: dict[str, set] = {}
            for i, w in enumerate(ws):
                if w in good:
                    places.setdefault(w, set()).add((ws[i - 1] if i else "", w, ws[i + 1] if i + 1 < len(ws) else ""))
                for stem in _stems(w):
                    if stem in good:
                        derived.setdefault(stem, set()).add(w)
            for stem, family in derived.items():
                places.setdefault(stem, set()).add(frozenset(family))
    # places, not documents, are the evidence: copies of one text count once
    lexemes = {}
    for n, p in places.items():
        weight, pos, neg = strong[key_of(n)]
        if _evidence(min(len(p), pos), neg, y.mean()) >= np.log(max(tried[n.endswith("*")], 1)) + MARGIN:
            lexemes[n] = weight
    # of nested families the longer one stays if it is as strong
    for n in [n for n in lexemes if n.endswith("*")]:
        if any(m != n and m.endswith("*") and m.startswith(n[:-1]) and lexemes[m] >= lexemes[n] for m in lexemes):
            del lexemes[n]
    model = ToxicityModel(lexemes)
    opened = model.opened()
    x = np.log1p(np.array([model.features(t, opened) for t in texts], dtype=float))
    model.weights, model.bias = _logistic(x, y)
    return model


def _evidence(pos: int, neg: int, share: float) -> float:
    """Minus the log probability (Chernoff bound) of ``pos`` toxic among
    ``pos + neg`` documents by chance."""
    n = pos + neg
    q = pos / n
    if q <= share:
        return 0.0
    return n * (q * np.log(q / share) + ((1 - q) * np.log((1 - q) / (1 - share)) if q < 1 else 0.0))


def _logistic(x: np.ndarray, y: np.ndarray, pull: float = 1.0) -> tuple[np.ndarray, float]:
    """Newton steps for logistic weights drawn towards PRIOR, none negative."""
    w, b = PRIOR.copy(), -1.0
    one = np.hstack([x, np.ones((len(x), 1))])
    want = np.r_[PRIOR, 0.0]
    hold = np.r_[np.full(len(w), pull), 1e-3]
    theta = np.r_[w, b]
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(one @ theta, -30, 30)))
        grad = one.T @ (p - y) + hold * (theta - want)
        hess = (one * (p * (1 - p))[:, None]).T @ one + np.diag(hold)
        step = np.linalg.solve(hess, grad)
        theta = theta - step
        theta[:-1] = np.maximum(theta[:-1], 0)
        if np.abs(step).max() < 1e-8:
            break
    return theta[:-1], float(theta[-1])


def held_out(doc_id: Column) -> Column:
    """Rows whose labels the fit must not see."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE, max_negative: int = MAX_NEGATIVE,
        max_chars: int = MAX_CHARS) -> ToxicityModel:
    """Fit on a bounded sample of labelled rows outside the held-out fold.

    The sample takes at most ``max_positive`` / ``max_negative`` ids in the
    order of a hash, and whole texts up to ``max_chars`` code points in all.
    A doc_id labelled more than once counts as toxic if any row says so; null
    labels and ids are ignored."""
    known = (labels.filter(~held_out(F.col("doc_id")) & F.col("toxic").isin(0, 1))
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
             .withColumn("place", F.xxhash64("doc_id")))
    chosen = (known.filter("toxic = 1").orderBy("place", "doc_id").limit(max_positive)
              .unionByName(known.filter("toxic = 0").orderBy("place", "doc_id").limit(max_negative)))
    rows = written(docs.select("doc_id", "text").filter("text is not null")
                   .join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]), "toxicity-sample")
    total, taken = 0, []
    for r in rows.select("doc_id", "place", F.length("text").alias("n")).orderBy("place", "doc_id").collect():
        if total + r["n"] <= max_chars:
            total += r["n"]
            taken.append(r["doc_id"])
    picked = rows.join(F.broadcast(rows.sparkSession.createDataFrame([(i,) for i in taken], "doc_id long")), "doc_id")
    got = picked.orderBy("place", "doc_id").select("text", "toxic").toPandas()
    return fit_texts(got["text"].tolist(), got["toxic"].astype(int).tolist())


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``score`` (0 to 1) and ``predicted`` (1 from 0.5 up).

    Whole texts are read, whatever their length; null and empty texts match
    no clause and get the score of such.  Rows are judged one by one, so
    repeated rows, null ids and an empty table need no rule; columns named
    score or predicted are replaced, others pass through."""
    opened: list = []

    def kernel(texts):
        if not opened:
            opened.append(model.opened())
        p = model.probability([model.features(t, opened[0]) for t in texts])
        return [pa.array(p), pa.array((p >= 0.5).astype(np.int32))]

    return with_kernel(docs, text_col, kernel, "score double, predicted int")
