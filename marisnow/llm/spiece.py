"""Sampled SentencePiece segmentation by forward filtering and backward
sampling over the piece lattice, and lossless decoding.

The vocabulary's pieces never cross a blank that follows text, so a text's
lattice falls apart into chunks (blanks and the word after them).  A worker
keeps the filtered lattices of the chunks it has met, up to a fixed number of
positions, and builds those of a run's new chunks together: the trie of the
pieces is walked from every position at once, and forward sums are filtered
column by column (position within the chunk).  Then every occurrence of every
chunk draws its pieces backwards, all occurrences in step; the random number
for a piece is a hash of the row key and of the piece's end in the text, so a
row's segmentation depends on nothing but its key and text.  A long text is
cut into runs at chunk borders, which changes nothing.

The model file holds merge ranks, not probabilities; a piece of rank r gets
the Zipf weight 1 / (r + 2), and ``alpha`` tempers it (1: as it is, 0: all
segmentations alike, large: the likeliest one).  A character without a piece
becomes its UTF-8 byte pieces."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marisnow.llm.common import as_text, free_name

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
ALPHA = 0.5
SEED = 0
BLANK = "▁"
#: code points that a task takes at once, and positions whose lattices a worker keeps
RUN_CHARS, KEPT = 200_000, 2_000_000
CHUNK = re.compile(r" +[^ ]*|[^ ]+")
#: stands for a literal U+2581, which no piece may match
NO_PIECE = "￿"


def read_vocabulary(path: str = MODEL) -> list[tuple[str, float, bytes]]:
    """Per id: the piece to match ('' if none), its log weight, and the bytes
    that it decodes to.  Read on the driver and sent with the tasks (its size
    is the model's, some hundred kilobytes)."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    size = sp.get_piece_size()
    out = []
    for i in range(size):
        piece, rank = sp.id_to_piece(i), min(-sp.get_score(i), float(size))
        if sp.is_byte(i):
            out.append(("", -np.log(size + 2.0), bytes([int(piece[1:-1], 16)])))
        elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            out.append(("", 0.0, b""))
        elif BLANK in piece.lstrip(BLANK):
            raise ValueError(f"piece {piece!r} crosses a blank; chunks would not be independent")
        else:
            out.append((piece, -np.log(rank + 2.0), piece.replace(BLANK, " ").encode()))
    return out


def _hash(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


class _Trie:
    """Pieces as transitions ``(node, code) -> node``: a dense table from the
    root, open addressing below it."""

    def __init__(self, pieces: list[tuple[int, str]]):
        nodes, end = {}, [-1]
        for i, piece in pieces:
            at = 0
            for c in piece:
                key = at << 21 | ord(c)
                if key not in nodes:
                    nodes[key] = len(end)
                    end.append(-1)
                at = nodes[key]
            end[at] = i
        self.end = np.array(end, dtype=np.int32)
        self.longest = max((len(p) for _, p in pieces), default=1)
        self.root = np.zeros(0x110000, dtype=np.int32)
        deep = []
        for key, to in nodes.items():
            if key < 1 << 21:
                self.root[key] = to
            else:
                deep.append((key, to))
        bits = max(4, (len(deep) * 4).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.key, self.to = np.zeros(1 << bits, dtype=np.int64), np.zeros(1 << bits, dtype=np.int32)
        keys = np.array([d[0] for d in deep], dtype=np.int64)
        to = np.array([d[1] for d in deep], dtype=np.int32)
        slot = self._slot(keys)
        while len(keys):  # keys without a slot try the next one
            _, first = np.unique(slot, return_index=True)
            put = first[self.key[slot[first]] == 0]
            self.key[slot[put]], self.to[slot[put]] = keys[put], to[put]
            rest = np.ones(len(keys), dtype=bool)
            rest[put] = False
            keys, to, slot = keys[rest], to[rest], (slot[rest] + 1) & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def step(self, node: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Next nodes; 0 where there is none."""
        key = node.astype(np.int64) << 21 | code
        slot = self._slot(key)
        seen = self.key[slot]
        out = np.where(seen == key, self.to[slot], 0)
        on = np.flatnonzero((seen != key) & (seen != 0))
        while len(on):
            slot = (slot[on] if len(slot) != len(on) else slot) + 1 & self.mask
            seen, want = self.key[slot], key[on]
            out[on] = np.where(seen == want, self.to[slot], 0)
            more = (seen != want) & (seen != 0)
            on, slot = on[more], slot[more]
        return out


class Lattice:
    """Vocabulary as a trie, and the filtered lattices of the chunks met.

    Chunks are filtered together, longest first, and their positions are
    numbered by column, then chunk.  Per position (an end of pieces) ``head``
    is its first edge; its edges follow with their cumulative choice
    probability, piece, length and the position that they lead back to (-1:
    the chunk's beginning)."""

    def __init__(self, vocabulary, alpha: float = ALPHA, kept: int = KEPT):
        self.out = [v[2] for v in vocabulary]
        self.weight = np.array([alpha * v[1] for v in vocabulary])
        self.byte = np.full(256, -1, dtype=np.int64)
        for i, (piece, _, raw) in enumerate(vocabulary):
            if not piece and raw:
                self.byte[raw[0]] = i
        if (self.byte < 0).any():
            raise ValueError("the vocabulary has no byte pieces to fall back to")
        self.trie = _Trie([(i, v[0]) for i, v in enumerate(vocabulary) if v[0]])
        self.kept = kept
        self._forget()

    def _forget(self):
        self.known: dict[str, int] = {}
        self.positions = self.edge_count = self.chunks = 0
        self.last = np.zeros(0, dtype=np.int32)
        self.size = np.zeros(0, dtype=np.int32)
        self.head = np.zeros(0, dtype=np.int32)
        self.cum, self.prev = np.zeros(0), np.zeros(0, dtype=np.int32)
        self.piece, self.span = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int8)

    def _store(self, name: str, at: int, values: np.ndarray) -> None:
        have = getattr(self, name)
        if at + len(values) > len(have):
            more = np.zeros(max(at + len(values), len(have) * 3 // 2), dtype=have.dtype)
            more[:at] = have[:at]
            setattr(self, name, more)
            have = more
        have[at:at + len(values)] = values

    def edges(self, codes: np.ndarray, column: np.ndarray, live: np.ndarray):
        """(end position, length, piece) of all matches, by end, then the
        longest first.  ``column[t]`` is where column t begins and ``live[t]``
        how many chunks reach it.  Piece -1 is the byte fallback of a
        character that is no piece."""
        n = len(codes)
        t = np.repeat(np.arange(len(live)), live)
        chunk = np.arange(n) - column[t]
        node = self.trie.root[codes]
        single = np.where(node > 0, self.trie.end[node], -1)
        ends, lengths, pieces = [np.arange(n, dtype=np.int64)], [np.ones(n, dtype=np.int8)], [single]
        on = np.flatnonzero(node)
        t, chunk, node, length = t[on], chunk[on], node[on], 1
        live = np.r_[live, 0]
        while len(t):
            length += 1
            t = t + 1
            on = chunk < live[t]
            t, chunk, node = t[on], chunk[on], node[on]
            at = column[t] + chunk
            node = self.trie.step(node, codes[at].astype(np.int64))
            on = np.flatnonzero(node)
            t, chunk, node, at = t[on], chunk[on], node[on], at[on]
            hit = np.flatnonzero(self.trie.end[node] >= 0)
            ends.append(at[hit])
            lengths.append(np.full(len(hit), length, dtype=np.int8))
            pieces.append(self.trie.end[node[hit]])
        end, length, piece = np.concatenate(ends), np.concatenate(lengths), np.concatenate(pieces)
        order = np.argsort(end * (self.trie.longest + 1) - length)  # all different, so the order is one
        return end[order], length[order], piece[order]

    def add(self, chunks: list[str]) -> None:
        """Filters the lattices of chunks that are not known yet."""
        chunks = sorted(chunks, key=len, reverse=True)
        size = np.array([len(c) for c in chunks], dtype=np.int64)
        live = np.searchsorted(-size, -np.arange(size[0]), side="left")  # chunks longer than t
        column = np.cumsum(live) - live
        flat = _codes("".join(chunks).replace(BLANK, NO_PIECE).replace(" ", BLANK))
        t = np.repeat(np.arange(len(live)), live)
        chunk = np.arange(len(flat)) - column[t]
        codes = flat[(np.cumsum(size) - size)[chunk] + t]
        end, length, piece = self.edges(codes, column, live)
        weight = np.where(piece >= 0, self.weight[piece], self.weight[self.byte[0]] * 2)
        begin = t[end] - length  # column of the position before the edge
        prev = np.where(begin >= 0, column[begin] + chunk[end], -1)
        log = np.full(len(codes) + 1, -np.inf)
        log[-1] = 0.0  # where prev is -1
        chance = np.empty(len(end))
        heads = np.flatnonzero(np.r_[True, end[1:] != end[:-1]])  # every position has an edge
        width = np.diff(np.r_[heads, len(end)])
        for c in range(len(live)):
            first, past = column[c], column[c] + live[c]
            lo, hi = heads[first], heads[past] if past < len(heads) else len(end)
            v = weight[lo:hi] + log[prev[lo:hi]]
            own = heads[first:past] - lo
            high = np.maximum.reduceat(v, own)
            part = np.exp(v - np.repeat(high, width[first:past]))
            total = np.add.reduceat(part, own)
            log[first:past] = high + np.log(total)
            chance[lo:hi] = part / np.repeat(total, width[first:past])
        run = np.cumsum(chance)
        cum = run - np.repeat(run[heads] - chance[heads], width)
        cum[np.r_[heads[1:], len(end)] - 1] = 2.0  # the last edge takes what rounding leaves
        self._store("head", self.positions, (heads + self.edge_count).astype(np.int32))
        self._store("cum", self.edge_count, cum)
        self._store("prev", self.edge_count, np.where(prev >= 0, prev + self.positions, -1).astype(np.int32))
        self._store("piece", self.edge_count, piece.astype(np.int32))
        self._store("span", self.edge_count, length)
        self._store("last", self.chunks, (column[size - 1] + np.arange(len(chunks)) + self.positions).astype(np.int32))
        self._store("size", self.chunks, size.astype(np.int32))
        self.known.update(zip(chunks, range(self.chunks, self.chunks + len(chunks))))
        self.positions += len(codes)
        self.edge_count += len(end)
        self.chunks += len(chunks)

    def segment(self, texts: list[str], keys: np.ndarray, seed: int = SEED, offsets: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all texts one after the other, and per text where
        they end.  An empty text has no pieces.  With ``offsets`` the texts
        are parts of texts: text with its leading blank, cut at chunk borders,
        beginning at that place."""
        if offsets is None:
            texts = [" " + t if t else "" for t in texts]
            offsets = np.zeros(len(texts), dtype=np.int64)
        chunks, owned = [], []
        for t in texts:
            part = CHUNK.findall(t)
            chunks += part
            owned.append(len(part))
        if not chunks:
            return np.zeros(0, dtype=np.int64), np.zeros(len(texts), dtype=np.int64)
        which = np.array([self.known.get(c, -1) for c in chunks], dtype=np.int64)
        missing = np.flatnonzero(which < 0)
        if len(missing):
            new = {chunks[i] for i in missing.tolist()}
            if self.positions + sum(map(len, new)) > self.kept:
                self._forget()
                new, missing = set(chunks), np.arange(len(chunks))
            self.add(sorted(new))
            which[missing] = [self.known[chunks[i]] for i in missing.tolist()]
        doc = np.repeat(np.arange(len(texts)), owned)
        length = np.array([len(t) for t in texts], dtype=np.int64)
        base = np.cumsum(length) - length
        pos = np.cumsum(self.size[which].astype(np.int64))  # ends of the occurrences in the run of texts
        found = np.full(int(length.sum()), -2, dtype=np.int32)
        key = _hash(keys.view(np.uint64) + np.uint64(seed))[doc]
        shift = (offsets - base)[doc]
        state = self.last[which]
        while len(state):
            draw = _hash(key ^ _hash((pos + shift).astype(np.uint64)))
            u = (draw >> np.uint64(11)).astype(np.float64) * 2.0 ** -53
            e = self.head[state]
            on = np.flatnonzero(u >= self.cum[e])
            while len(on):
                e[on] += 1
                on = on[u[on] >= self.cum[e[on]]]
            pos = pos - self.span[e]
            found[pos] = self.piece[e]
            state = self.prev[e]
            more = np.flatnonzero(state >= 0)
            state, pos, key, shift = state[more], pos[more], key[more], shift[more]
        at = np.flatnonzero(found > -2)
        ids = found[at].astype(np.int64)
        lone = np.flatnonzero(ids < 0)
        ends = np.searchsorted(at, base + length)
        if len(lone):
            whole = "".join(texts)
            raw = [whole[i].encode("utf-8", "surrogatepass") for i in at[lone].tolist()]
            count = np.ones(len(ids), dtype=np.int64)
            count[lone] = [len(r) for r in raw]
            run = np.cumsum(count)
            ids = np.repeat(ids, count)
            ids[ids < 0] = self.byte[np.frombuffer(b"".join(raw), dtype=np.uint8)]
            ends = np.r_[0, run][ends]
        return ids, ends

    def text_of(self, ids) -> str:
        """Inverse of :meth:`segment` for one text."""
        return b"".join(map(self.out.__getitem__, ids))[1:].decode("utf-8", "replace")


def _parts(text: str):
    """``(place, part)`` of a text with its leading blank: about RUN_CHARS code
    points each, cut where a chunk begins (a longer chunk stays whole)."""
    whole = " " + text if text else ""
    lo = 0
    while len(whole) - lo > RUN_CHARS:
        cut = whole.find(" ", lo + RUN_CHARS)
        while cut > 0 and whole[cut - 1] == " ":
            cut = whole.find(" ", cut + 1)
        if cut < 0:
            break
        yield lo, whole[lo:cut]
        lo = cut
    yield lo, whole[lo:]


def _segmented(lattice: Lattice, texts, keys: np.ndarray, seed: int):
    """Piece ids of each text, in order; ``texts`` is read as it is needed."""
    held, total = [], 0

    def out():
        ids, ends = lattice.segment([h[2] for h in held], np.array([h[3] for h in held], dtype=np.int64), seed,
                                    np.array([h[1] for h in held], dtype=np.int64))
        return [(h[0], p) for h, p in zip(held, np.split(ids.astype(np.int32), ends[:-1]))]

    whole: list[np.ndarray] = []
    number = 0

    def done(got):
        nonlocal whole, number
        for i, p in got:
            if i != number:
                yield np.concatenate(whole)
                whole, number = [], i
            whole.append(p)

    count = 0
    for i, text in enumerate(texts):
        count += 1
        for place, part in _parts(text):
            held.append((i, place, part, keys[i]))
            total += len(part)
            if total >= RUN_CHARS:
                yield from done(out())
                held, total = [], 0
    if held:
        yield from done(out())
    if count:
        yield np.concatenate(whole)


_OPEN: dict = {}


def _opened(name, vocabulary, alpha: float) -> Lattice:
    """The worker's lattices, kept from task to task."""
    if name not in _OPEN:
        _OPEN.clear()
        _OPEN[name] = Lattice(vocabulary.value, alpha)
    return _OPEN[name]


def encode(df: DataFrame, key: Column, text_col: str = "text", model: str = MODEL, alpha: float = ALPHA,
           seed: int = SEED, check: str | None = None) -> DataFrame:
    """``df`` plus ``ids`` (array of int), a sampled segmentation of the whole
    text, reproducible from ``key``, ``seed`` and the text.  With ``check`` a
    boolean column of that name follows: whether the ids, decoded, give the
    very text (null for a null text).

    A null text gives null ids, an empty one no pieces; equal rows give equal
    ids; a null key is a key like others.  A text's first piece carries the
    usual added blank.  An empty table gives no rows; columns named like new
    ones are replaced, other columns pass through, whatever their names."""
    vocabulary = df.sparkSession.sparkContext.broadcast(read_vocabulary(model))
    add = StructType.fromDDL("ids array<int>" + (f", `{check}` boolean" if check else ""))
    taken = {f.name.lower() for f in add}
    names = [c for c in df.columns if c.lower() not in taken]
    n = len(names)
    # names of its own for the three columns added here, whatever the table's are called
    own = lambda c: free_name(c, names)
    src = df.select(*names, F.xxhash64(key).alias(own("key")), F.col(text_col).isNotNull().alias(own("has")),
                    as_text(F.col(text_col)).alias(own("utf8")))
    ddl = StructType([*(src.schema.fields[i] for i in range(n)), *add.fields])
    opened = (model, alpha)

    def run(batches):
        lattice = _opened(opened, vocabulary, alpha)
        table = lattice.out.__getitem__

        def batch(b, lo, hi, lists, same):
            has = b.column(n + 1).slice(lo, hi - lo)
            ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
            made = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(lists) if lists else np.zeros(0, np.int32)),
                                             mask=pa.array(~has.to_numpy(zero_copy_only=False)))]
            if check:
                made.append(pa.array([s if h else None for s, h in zip(same, has.to_pylist())], pa.bool_()))
            return pa.RecordBatch.from_arrays([*(b.column(i).slice(lo, hi - lo) for i in range(n)), *made],
                                              [f.name for f in ddl.fields])

        for b in batches:
            raw = b.column(n + 2)
            texts = (t.as_py().decode("utf-8", "replace") for t in raw)
            lists, same, lo, total = [], [], 0, 0
            for i, ids in enumerate(_segmented(lattice, texts, b.column(n).to_numpy(), seed)):
                lists.append(ids)
                total += len(ids)
                if check:
                    same.append(b"".join(map(table, ids.tolist()))[1:] == raw[i].as_py())
                if total >= RUN_CHARS:
                    yield batch(b, lo, i + 1, lists, same)
                    lists, same, lo, total = [], [], i + 1, 0
            if lists:
                yield batch(b, lo, b.num_rows, lists, same)

    return src.mapInArrow(run, ddl)


def decode(df: DataFrame, ids_col: str = "ids", model: str = MODEL) -> DataFrame:
    """``df`` plus ``decoded``, the very text that the ids were made from;
    null ids give null."""
    vocabulary = df.sparkSession.sparkContext.broadcast(read_vocabulary(model))
    names = [c for c in df.columns if c.lower() != "decoded"]
    ddl = StructType([*(df.schema[c] for c in names), *StructType.fromDDL("decoded string").fields])
    at = names.index(ids_col)

    def run(batches):
        table = [v[2] for v in vocabulary.value].__getitem__
        for b in batches:
            ids = b.column(at)
            flat = ids.flatten().to_numpy()
            size = np.array([0 if s is None else s for s in ids.value_lengths().to_pylist()], dtype=np.int64)
            ends = np.cumsum(size)
            texts = [b"".join(map(table, flat[e - s:e].tolist()))[1:].decode("utf-8", "replace") if ok else None
                     for s, e, ok in zip(size, ends, ids.is_valid().to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], [*names, "decoded"])

    return df.select(*names).mapInArrow(run, ddl)
