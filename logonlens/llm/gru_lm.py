"""LM scoring with a gated recurrent network.

Tokens are the lower-cased (A-Z) words of a text (runs of other bytes than space and
\\x09-\\x0D), then one end token.

**Counts.** Every training text is counted (map-side sums, then a shuffle of distinct words).
They give the base score, the class layout and the distribution of rare words. The ``KNOWN``
most frequent words are broadcast (a bounded table); the counts of all others are joined by a
shuffle of the rare words alone.

**Model.** The most frequent words, the head, lie in classes by frequency; all other words, seen
or not, form one more class. The number of classes and that of words in a class both grow with
the fourth root of the vocabulary, so the head grows with its square root (``layout``). A word's
probability is that of its class times that within its class, both from the state of a gated
recurrent unit (the last class: by counts). The network starts out as the unigram model.

**Training** is truncated backpropagation in numpy over every token of every training text:
gradients go back over windows of ``STEPS`` tokens, the state is carried from window to window.
``TRAIN_TEXTS`` texts run side by side, and one that ends gives its place to the next. Texts are
dealt by hash to ``ROUNDS`` rounds, so all rounds together are one pass. In a round each partition
trains its own copy of the weights, and copies are averaged by their numbers of tokens in a tree.
So the training work and what is gathered grow with the corpus.

**Scoring** runs over whole texts in windows with the state carried across them. Texts are
scored side by side, longest first, so the set of running ones only shrinks.

Nulls: a NULL text is the empty text (the end token alone); a NULL doc_id counts as the id "".
Repeated rows each give a row. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logonlens.llm.common import cut, document_rows

FOLDS, HELD_OUT = 5, 1
KNOWN = 100_000               # words of the broadcast table
CLASSES, CLASS_WORDS = 32, 64   # up to a vocabulary of ``CLASSED`` words
CLASSED = 80_000
HIDDEN = 24
FLAT = 1 << 19                # tokens of running and ended texts kept before the ended ones go
STEPS = 16                    # tokens that a gradient goes back
TRAIN_TEXTS = 512             # texts trained side by side
UPDATE_TOKENS = 2048          # least tokens of an update, but for a partition's last one
ROUNDS = 3                    # averagings of the partitions' weights; a text is in one of them
RATE = 0.02
SCORE_TEXTS = 4096            # texts scored side by side, at most
SCORE_BYTES = 16 << 20        # and their bytes
SCORE_TOKENS = 16_384         # least tokens of a window in scoring, but for the last one
COUNTED = 4_000_000           # words a task holds before it counts them and sends the counts on
TOKENIZED_TEXTS, TOKENIZED_BYTES = 1024, 4 << 20     # texts split into words at once, at most
END = ""                      # the end token's name; no word is empty
HEAD = CLASSES * CLASS_WORDS


def portions(batches: Iterable[pa.RecordBatch], column: int, rows: int, size: int) -> Iterator[pa.Table]:
    """All rows in order, so many at once, or fewer once the texts (in ``column``) have ``size`` bytes."""
    held, n, full = [], 0, 0
    for batch in batches:
        start = 0
        for k, length in enumerate(pc.binary_length(batch.column(column)).to_pylist(), 1):
            n, full = n + 1, full + length
            if n >= rows or full >= size:
                yield pa.Table.from_batches([*held, batch.slice(start, k - start)]).combine_chunks()
                held, n, full, start = [], 0, 0, k
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def words_of(texts: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """The words of ``texts`` (binary, none null) one after another, and how many each text has."""
    texts = texts.chunk(0)
    text = texts.view(pa.large_string() if pa.types.is_large_binary(texts.type) else pa.string())
    lists = pc.ascii_split_whitespace(pc.ascii_lower(text))
    words, ends = lists.flatten(), lists.offsets.to_numpy()
    real = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0       # white space at an end leaves an empty string
    if not real.all():
        words, ends = words.filter(pa.array(real)), np.r_[0, np.cumsum(real)][ends]
    return words.cast(pa.string()), np.diff(ends).astype(np.int64)


def places(words: pa.Array, known: pa.Array, other: int) -> np.ndarray:
    """The place of each word among the ``known`` ones, ``other`` for the rest."""
    return pc.index_in(words, value_set=known).fill_null(other).to_numpy(zero_copy_only=False)


def with_ends(ids: np.ndarray, lengths: np.ndarray, end: int) -> list[np.ndarray]:
    """Each text's ids, an end token after them."""
    stops = np.cumsum(lengths)
    return np.split(np.insert(ids, stops, end), (stops + np.arange(1, len(stops) + 1))[:-1])


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == HELD_OUT


# ---------------------------------------------------------------- counts

def word_counts(texts: DataFrame) -> DataFrame:
    """``word, c`` over all rows of ``texts`` (text: binary); the end token is ``END``."""
    def work(batches):
        held, size = [], 0

        def sent():
            counts = pa.chunked_array(held).value_counts()
            return pa.RecordBatch.from_arrays([counts.field(0), counts.field(1)], ["word", "c"])

        for part in portions(batches, 0, TOKENIZED_TEXTS, TOKENIZED_BYTES):
            words, _ = words_of(part.column(0))
            held += [words, pa.array([END]).take(pa.array(np.zeros(part.num_rows, np.int32)))]
            size += len(words)
            if size > COUNTED:
                yield sent()
                held, size = [], 0
        if held:
            yield sent()

    return texts.mapInArrow(work, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def layout(distinct: int) -> tuple[int, int]:
    """Classes and words in a class for a vocabulary of so many words."""
    side = max(1.0, distinct / CLASSED) ** 0.25
    return round(CLASSES * side), round(CLASS_WORDS * side)


class Vocabulary:
    """The known words by falling count. The first ``head`` of them have classes of their own."""

    def __init__(self, words: list[str], counts: list[int], total: int, distinct: int):
        self.words = pa.array(words, pa.string())
        self.counts = np.array(counts, dtype=np.float64)
        self.total, self.distinct = total, distinct
        self.classes, self.class_words = layout(distinct)
        self.head = self.classes * self.class_words
        self.end = min(self.head, words.index(END)) if END in words else self.head
        # what all words outside the head have, with half a count for each and for a new word
        self.rest = total - self.counts[:self.head].sum() + 0.5 * (max(0, distinct - self.head) + 1)
        self.denominator = total + 0.5 * (distinct + 1)

    def base_log10(self, counts):
        return np.log10((counts + 0.5) / self.denominator)

    def rest_log10(self, counts):
        return np.log10((counts + 0.5) / self.rest)


# ---------------------------------------------------------------- network

def shapes(classes: int, class_words: int) -> dict[str, tuple[int, ...]]:
    return {"x": (classes * class_words + 1, 3 * HIDDEN), "u": (HIDDEN, 3 * HIDDEN), "wc": (HIDDEN, classes + 1),
            "bc": (classes + 1,), "ww": (classes, HIDDEN, class_words), "bw": (classes, class_words)}


SHAPES = shapes(CLASSES, CLASS_WORDS)
ABSENT = -30.0                # logit of an empty place
LARGEST = 60.0                # logits up to here, of either sign, need no shift before ``exp``


def initial(vocabulary: Vocabulary) -> dict[str, np.ndarray]:
    """Weights that give the unigram model whatever the state is."""
    rng = np.random.default_rng(7)
    shape = shapes(vocabulary.classes, vocabulary.class_words)
    head = np.zeros(vocabulary.head)
    own = vocabulary.counts[:vocabulary.head]
    head[:len(own)] = own + 0.5
    head = head.reshape(vocabulary.classes, vocabulary.class_words)
    with np.errstate(divide="ignore"):
        of_class = np.log(np.r_[head.sum(1), vocabulary.rest] / (head.sum() + vocabulary.rest))
        within = np.log(head / np.maximum(head.sum(1, keepdims=True), 1e-300))
    w = {"x": rng.normal(0, 0.3, shape["x"]), "u": rng.normal(0, HIDDEN ** -0.5, shape["u"]),
         "wc": np.zeros(shape["wc"]), "bc": np.maximum(of_class, ABSENT),
         "ww": np.zeros(shape["ww"]), "bw": np.maximum(within, ABSENT)}
    return {k: v.astype(np.float32) for k, v in w.items()}


def _planes(weights):
    """The parts for the update gate, the reset gate and the candidate, each on its own."""
    return np.ascontiguousarray(weights.reshape(len(weights), 3, HIDDEN).transpose(1, 0, 2))


def _unroll(x, u, words, h, running):
    """The unit over a window: ``words`` step after step, ``running`` texts in each, the first ones
    of the step before. ``x`` and ``u`` are planes. Gives gates, candidates, states before and after
    each step and what the reset gate lets through of those before."""
    gates, c = x[:2].take(words, axis=1), x[2].take(words, axis=0)
    np.negative(gates, out=gates)
    ug, uc = -u[:2], u[2]
    before, reset, states = (np.empty_like(c) for _ in range(3))
    start = 0
    for n in running:
        at = slice(start, start + n)
        start += n
        old, gate, candidate, new = before[at], gates[:, at], c[at], states[at]
        old[:] = h[:n]
        gate += old @ ug
        np.exp(gate, out=gate)
        gate += 1
        np.reciprocal(gate, out=gate)
        candidate += np.multiply(gate[1], old, out=reset[at]) @ uc
        np.tanh(candidate, out=candidate)
        np.subtract(candidate, old, out=new)
        new *= gate[0]
        new += old
        h = new
    return gates, c, before, reset, states


def _alike(keys, size):
    """An order that brings equal ``keys`` (below ``size``) together, and the keys that are there
    equally often next to each other; those keys; and for each number of times the slice of them, the
    slice of the order and that number."""
    counts = np.bincount(keys, minlength=size)
    there = np.flatnonzero(counts)
    there = there[np.argsort(counts[there], kind="stable")]
    place = np.empty(size, np.int16 if size < 1 << 15 else np.int32)      # the narrow type sorts fast
    place[there] = np.arange(len(there))
    often = counts[there]
    cuts = [0, *(np.flatnonzero(often[1:] != often[:-1]) + 1).tolist(), len(there)]
    ends = np.r_[0, np.cumsum(often)].tolist()
    often = often.tolist()
    groups = [(slice(i, j), slice(ends[i], ends[j]), often[i]) for i, j in zip(cuts[:-1], cuts[1:], strict=True) if i < j]
    return np.argsort(place[keys], kind="stable"), there, groups


def _small(w) -> bool:
    """Whether no logit can leave what ``exp`` takes, since no component of a state is beyond 1."""
    return all(float((np.abs(w[k]).sum(axis=-2) + np.abs(w[b])).max()) < LARGEST for k, b in (("wc", "bc"), ("ww", "bw")))


def _softmax(logits, picked, small):
    """The log probability of the ``picked`` place of each row, and the sums of the exponentials,
    which take the place of the logits."""
    if not small:
        logits -= logits.max(axis=1, keepdims=True)
    log_p = logits[np.arange(len(picked)), picked]
    np.exp(logits, out=logits)
    total = logits @ np.ones(logits.shape[1], logits.dtype)
    return log_p - np.log(total), total


def _to_gradient(e, total, picked):
    """Exponentials and their sums become the gradient of the loss by the logits."""
    e *= (1 / total)[:, None]
    e[np.arange(len(picked)), picked] -= 1


def output(w, h, y, grads=None, small=None):
    """Log probability (natural) of the head words or classes ``y`` under states ``h``; with
    ``grads`` also adds up the gradients of the loss and returns that of ``h``. ``small``: what
    ``_small`` says of the weights, if known."""
    classes, _, class_words = w["ww"].shape
    of_class = y // class_words
    small = _small(w) if small is None else small
    e = h @ w["wc"]
    e += w["bc"]
    log_p, total = _softmax(e, of_class, small)
    out = log_p.astype(np.float64)
    back = None
    if grads is not None:
        _to_gradient(e, total, of_class)
        grads["wc"] += h.T @ e
        grads["bc"] += np.ones(len(e), e.dtype) @ e
        back = e @ w["wc"].T
    inside = np.flatnonzero(of_class < classes)     # the others are of the last class
    if len(inside):
        order, there, groups = _alike(of_class[inside], classes)
        inside = inside[order]
        k = y[inside] % class_words
        ww = np.concatenate([w["ww"][there], w["bw"][there, None]], axis=1)
        one = np.ones((len(inside), HIDDEN + 1), np.result_type(h, ww))         # the states, and a one for the bias
        one[:, :HIDDEN] = h[inside]
        e = np.empty((len(inside), class_words), one.dtype)
        groups = [(c, one[part].reshape(-1, n, HIDDEN + 1), e[part].reshape(-1, n, class_words)) for c, part, n in groups]
        for c, state, own in groups:                # classes with equally many rows go together
            np.matmul(state, ww[c], out=own)
        log_p, total = _softmax(e, k, small)
        out[inside] += log_p
        if grads is not None:
            _to_gradient(e, total, k)
            more, by_ww = np.empty_like(one), np.empty_like(ww)
            start = 0
            for c, state, own in groups:
                np.matmul(state.transpose(0, 2, 1), own, out=by_ww[c])
                part = more[start:start + state.shape[0] * state.shape[1]]
                np.matmul(own, ww[c].transpose(0, 2, 1), out=part.reshape(state.shape))
                start += len(part)
            grads["ww"][there] += by_ww[:, :HIDDEN]
            grads["bw"][there] += by_ww[:, HIDDEN]
            back[inside] += more[:, :HIDDEN]
    return out, back


class Trainer:
    """Adam over steps of truncated backpropagation."""

    def __init__(self, w):
        self.w = {k: v.copy() for k, v in w.items()}
        self.m = {k: np.zeros_like(v) for k, v in w.items()}
        self.v = {k: np.zeros_like(v) for k, v in w.items()}
        self.grads = {k: np.zeros_like(v) for k, v in w.items()}
        self.rows = np.zeros(0, np.int64)       # of ``x`` that have a gradient
        self.windows = []               # since the last update: words, running texts, _unroll's first four, gradient of the states
        self.t = self.tokens = self.waiting = 0
        self.x, self.u, self.small = _planes(w["x"]), _planes(w["u"]), _small(w)

    def texts(self, docs: Iterable[np.ndarray], end: int) -> None:
        """``docs``: the head words (``head``: any other) of whole training texts, read as places
        become free."""
        docs, flat = iter(docs), np.zeros(0, np.int32)      # the running texts, each after an end token
        at = stop = np.zeros(0, np.int64)                   # where each one is in ``flat``, and its last token
        h = np.zeros((0, HIDDEN), self.x.dtype)
        while True:
            new = list(islice(docs, TRAIN_TEXTS - len(at)))
            if not len(at) + len(new):
                break
            if new:
                left = [flat[x:y + 1] for x, y in zip(at.tolist(), stop.tolist(), strict=True)] if len(flat) > FLAT else [flat]
                sizes = np.array([len(d) + 1 for d in new])
                if len(flat) > FLAT:
                    stop = np.cumsum([len(d) for d in left], dtype=np.int64) - 1
                    at = np.r_[0, stop[:-1] + 1] if len(stop) else stop
                ends = sum(map(len, left)) + np.cumsum(sizes)
                flat = np.concatenate([*left, *(part for d in new for part in ((end,), d))])
                at, stop = np.r_[at, ends - sizes], np.r_[stop, ends - 1]
                h = np.vstack([h, np.zeros((len(new), HIDDEN), h.dtype)])
            lengths = np.minimum(STEPS, stop - at)
            order = np.argsort(-lengths, kind="stable")
            at, stop, lengths, h = at[order], stop[order], lengths[order], h[order]
            step = np.arange(lengths[0])[:, None]
            place = (at + step)[step < lengths]
            h = self._window(flat[place], flat[place + 1], h, np.searchsorted(-lengths, -step[:, 0], "left").tolist())
            at = at + lengths
            on = np.flatnonzero(at < stop)                  # all of them in the last step
            at, stop, h = at[on], stop[on], h[on]
        if self.waiting:
            self._learn()

    def _window(self, words, targets, h, running):
        *kept, states = _unroll(self.x, self.u, words, h, running)
        _, back = output(self.w, states, targets, self.grads, self.small)
        self.windows.append((words, running, *kept, back))
        self.waiting += len(targets)
        if self.waiting >= UPDATE_TOKENS:
            self._learn()
        return states[len(states) - running[-1]:]

    def _together(self):
        """The windows since the last update side by side, as one."""
        if len(self.windows) == 1:
            return self.windows[0]
        words, running, gates, *rows = zip(*self.windows, strict=True)
        lengths = [(np.array(n)[:, None] > np.arange(n[0])).sum(0) for n in running]
        first = np.cumsum([0, *map(len, lengths)])
        texts = np.concatenate([f + np.concatenate([np.arange(k) for k in n]) for f, n in zip(first, running, strict=False)])
        steps = np.concatenate([np.repeat(np.arange(len(n)), n) for n in running])
        place = np.empty(first[-1], np.int64)       # the longest first, so a step's texts are the first of the step before
        place[np.argsort(-np.concatenate(lengths), kind="stable")] = np.arange(first[-1])
        order = np.argsort(steps * first[-1] + place[texts])
        return (np.concatenate(words)[order], np.bincount(steps).tolist(), np.concatenate(gates, axis=1)[:, order],
                *(np.concatenate(part)[order] for part in rows))

    def _learn(self):
        """Back through the windows since the last update, and an update."""
        grads, (words, running, gates, c, before, reset, back) = self.grads, self._together()
        z, r = gates
        keep = 1 - z
        of_c, of_z, of_r = z * (1 - c * c), (c - before) * z * keep, reset * (1 - r)
        uz, ur, uc = (part.T.copy() for part in self.u)
        dg = np.empty((3, len(words), HIDDEN), c.dtype)
        dz, dr, dc = dg
        carried, end = np.zeros((0, HIDDEN), c.dtype), len(words)
        for n in reversed(running):
            at = slice(end - n, end)
            end -= n
            dh = back[at]
            dh[:len(carried)] += carried
            drh = np.multiply(dh, of_c[at], out=dc[at]) @ uc
            np.multiply(dh, of_z[at], out=dz[at])
            np.multiply(drh, of_r[at], out=dr[at])
            drh *= r[at]
            dh *= keep[at]
            drh += dh
            drh += dz[at] @ uz
            drh += dr[at] @ ur
            carried = drh
        for k, of in enumerate((before, before, reset)):
            grads["u"][:, k * HIDDEN:(k + 1) * HIDDEN] += of.T @ dg[k]
        order, rows, groups = _alike(words, len(self.w["x"]))
        dg, dx = dg.take(order, axis=1), np.empty((3, len(rows), HIDDEN), c.dtype)
        for of, part, n in groups:
            np.sum(dg[:, part].reshape(3, -1, n, HIDDEN), axis=2, out=dx[:, of])
        grads["x"][rows] = dx.transpose(1, 0, 2).reshape(-1, 3 * HIDDEN)
        self.rows, self.windows = rows, []
        self._update(grads, self.waiting)
        self.x[:, rows] = self.w["x"][rows].reshape(-1, 3, HIDDEN).transpose(1, 0, 2)
        self.u, self.small = _planes(self.w["u"]), _small(self.w)

    def _update(self, grads, n):
        self.t += 1
        self.tokens += n
        rows = self.rows
        of = {k: rows if k == "x" else slice(None) for k in grads}     # other rows of x keep their moments
        own = {k: g[of[k]] for k, g in grads.items()}
        size = float(np.sqrt(sum(float(np.vdot(g, g)) for g in own.values()))) / n
        scale = 1 / n / max(1.0, size / 1.0)         # Python's floats leave arrays in single precision
        rate = RATE * (1 - 0.999 ** self.t) ** 0.5 / (1 - 0.9 ** self.t)
        for k, g in own.items():
            m, v = self.m[k][of[k]], self.v[k][of[k]]       # copies for rows, the arrays themselves elsewhere
            g *= 0.1 * scale
            m *= 0.9
            m += g
            g *= g
            g *= 0.1                                        # 0.001 of the square
            v *= 0.999
            v += g
            move = np.sqrt(v)
            move += 1e-8
            np.divide(m, move, out=move)
            move *= rate
            self.w[k][of[k]] -= move
            if k == "x":
                self.m[k][rows], self.v[k][rows] = m, v
            grads[k][of[k]] = 0
        self.waiting = 0


def _pack(w: dict[str, np.ndarray]) -> bytes:
    return np.concatenate([w[k].ravel() for k in SHAPES]).astype(np.float32).tobytes()


def _unpack(data: bytes, classes: int, class_words: int) -> dict[str, np.ndarray]:
    flat, out = np.frombuffer(data, np.float32), {}
    for k, shape in shapes(classes, class_words).items():
        out[k], flat = flat[:np.prod(shape)].reshape(shape), flat[np.prod(shape):]
    return out


def train(texts: DataFrame, vocabulary, weights: dict[str, np.ndarray], rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """Local training in every partition of ``texts`` (text: binary, h: a hash), averaged in a
    tree; ``vocabulary`` is a broadcast. Each text is in one of the rounds, with all its tokens."""
    spark = texts.sparkSession
    classes, class_words = vocabulary.value.classes, vocabulary.value.class_words
    for n_round in range(rounds):
        shared = spark.sparkContext.broadcast(_pack(weights))

        def work(batches, shared=shared):
            known = vocabulary.value
            head, end = known.head, known.end
            words = known.words.slice(0, head)       # by falling count

            def ids_of():
                for part in portions(batches, 0, TOKENIZED_TEXTS, TOKENIZED_BYTES):
                    found, lengths = words_of(part.column(0))
                    yield from with_ends(places(found, words, head), lengths, end)

            docs = ids_of()
            first = next(docs, None)
            if first is not None:
                trainer = Trainer(_unpack(shared.value, classes, class_words))
                trainer.texts(chain([first], docs), end)
                yield pa.RecordBatch.from_pylist([{"n": trainer.tokens, "w": _pack(trainer.w)}])

        def merge(a, b):
            n = a[0] + b[0]
            both = [np.frombuffer(x, np.float32).astype(np.float64) for x in (a[1], b[1])]
            return n, ((both[0] * a[0] + both[1] * b[0]) / n).astype(np.float32).tobytes()

        part = texts.where(F.col("h") % rounds == n_round).select("text")
        copies = part.mapInArrow(work, "n long, w binary").rdd.map(lambda r: (r["n"], bytes(r["w"])))
        parts = copies.getNumPartitions()
        none = (0, b"")
        got = copies.treeAggregate(none, lambda a, b: b if not a[0] else merge(a, b),
                                   lambda a, b: a if not b[0] else b if not a[0] else merge(a, b),
                                   max(2, int(np.ceil(np.log(max(2, parts)) / np.log(8)))))
        if got[0]:
            weights = _unpack(got[1], classes, class_words)
    return weights


def score_texts(w, y_of: list[np.ndarray], end: int) -> np.ndarray:
    """Log10 probability of each text's head words and classes, the state carried through it."""
    order = sorted(range(len(y_of)), key=lambda k: -len(y_of[k]))
    lengths = np.array([len(y_of[k]) for k in order])
    flat = np.concatenate([part for k in order for part in ((end,), y_of[k])])     # each after an end token
    begin = np.cumsum(lengths + 1) - lengths - 1
    scores = np.zeros(len(order))
    x, u, small = _planes(w["x"]), _planes(w["u"]), _small(w)
    running, every = np.searchsorted(-lengths, -np.arange(lengths[0]), "left").tolist(), np.arange(len(order))
    t, h = 0, np.zeros((len(order), HIDDEN), np.float32)
    while t < len(running):
        upto, size = t, 0
        while upto < len(running) and size < SCORE_TOKENS:
            size += running[upto]
            upto += 1
        owners = np.concatenate([every[:n] for n in running[t:upto]])
        place = begin[owners] + np.repeat(np.arange(t, upto), running[t:upto])
        states = _unroll(x, u, flat[place], h, running[t:upto])[-1]
        log_p, _ = output(w, states, flat[place + 1], small=small)
        scores += np.bincount(owners, log_p, len(order))
        h, t = states[size - running[upto - 1]:], upto
    out = np.empty(len(order))
    out[order] = scores / np.log(10)
    return out


@lru_cache(maxsize=1)
def _weights_of(data: bytes, classes: int, class_words: int):
    return _unpack(data, classes, class_words)


def lm_scores(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: int = KNOWN,
              rounds: int = ROUNDS) -> DataFrame:
    """One row for each row of ``df``: ``doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score``, learning from the rows that are not held out."""
    spark = df.sparkSession
    docs = document_rows(df, id_col, text_col).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("binary").alias("text"))
    learn = docs.where(~F.col("held_out"))
    counts = cut(word_counts(learn.select("text")), "word-counts")
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    top = counts.orderBy(F.desc("c"), "word").limit(known).collect()      # bounded by ``known``
    vocabulary = Vocabulary([r["word"] for r in top], [r["c"] for r in top], total, distinct)
    shared = spark.sparkContext.broadcast(vocabulary)
    seeds = learn.select("text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 31)).alias("h"))
    weights = spark.sparkContext.broadcast(_pack(train(seeds, shared, initial(vocabulary), rounds)))

    def work(batches):
        voc = shared.value
        w, head = _weights_of(weights.value, voc.classes, voc.class_words), voc.head
        base_of, rest_of = (np.r_[of(voc.counts), of(0.0)] for of in (voc.base_log10, voc.rest_log10))
        rest_of[:head] = 0
        last = len(voc.words)                   # the place of other words; only an end nobody learned from counts here
        end = voc.words.index(END).as_py()
        end = last if end < 0 else end
        for part in portions(batches, 2, SCORE_TEXTS, SCORE_BYTES):
            words, lengths = words_of(part.column(2))
            ids = places(words, voc.words, last)
            rare = ids == last
            texts = np.arange(len(lengths))
            owners, before = np.repeat(texts, lengths), np.r_[0, np.cumsum(lengths)]
            rares = np.r_[0, np.cumsum(rare)][before]
            known, of = ids[~rare], owners[~rare]
            base = np.bincount(of, base_of[known], len(texts)) + base_of[end]
            rest = np.bincount(of, rest_of[known], len(texts)) + rest_of[end]
            scores = score_texts(w, with_ends(np.minimum(ids, head), lengths, voc.end), voc.end) + rest
            yield pa.RecordBatch.from_arrays(
                [*(part.column(k).combine_chunks() for k in range(2)), pa.array(lengths + 1),
                 pa.array(lengths - np.diff(rares) + (end < last)), pa.array(base), pa.array(scores),
                 pa.ListArray.from_arrays(pa.array(rares, pa.int32()), words.filter(pa.array(rare)))],
                ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "rare"])

    first = docs.mapInArrow(work, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, "
                                  "score double, rare array<string>")
    first = cut(first.withColumn("row", F.monotonically_increasing_id()), "lm-scores")
    c = F.coalesce(F.col("c"), F.lit(0))
    rare = first.select("row", F.explode("rare").alias("word")).join(counts.hint("shuffle_hash"), "word", "left").groupBy("row").agg(
        F.sum((c > 0).cast("long")).alias("more_known"),
        F.sum(F.log10((c + 0.5) / F.lit(float(vocabulary.denominator)))).alias("more_base"),
        F.sum(F.log10((c + 0.5) / F.lit(float(vocabulary.rest)))).alias("more_score"))
    zero = F.lit(0.0)
    return first.drop("rare").join(rare, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("more_base", zero)).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", zero)).alias("score"))
