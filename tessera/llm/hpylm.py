"""Language-model scores from a hierarchical Pitman-Yor model.

Words are dishes. Each context has a restaurant whose new tables order their
dish from one shared parent restaurant (the unigrams), which orders from the
uniform distribution. A context is the whole previous token, told apart by a
63-bit hash, or the start of the text, so restaurants grow with the corpus.
Everything that concerns a word - its customers in all restaurants and its
tables in the parent - lies in one partition of the words, and seating is
sampled there. What a restaurant's customers and tables come to over all words
lies in one partition of the contexts: each partition of the words adds up its
own first and sends one number for each of its contexts, so that a frequent
context is as many numbers as there are partitions; it gets the totals back.
Scores average the predictive probabilities of the sweeps after the first.

A sweep draws the tables of every dish from their exact distribution, given
the totals of the sweep before (generalised Stirling numbers with the
discount). Sweeps are seeded by partition and number; the tables of dishes
with several customers are carried from sweep to sweep. Words are told apart by
64-bit hashes. Texts are read once: a chunk of documents keeps its words and,
for each token, the number of its word; it sends its (word, context) pairs to
the partitions of the words and gets a probability back for each.

Chunks, and what a partition of the words holds of the counts, are written in
hash buckets and stay there: only what one partition tells others is exchanged.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bucketed, column_of, drop_shuffles, id_text_crc, staged, words_of

#: Contexts are numbers below this one; 0 is the start of a text.
CONTEXTS = 1 << 63
#: Strengths of the context restaurants and of the parent; sweeps, of which
#: so many settle and are not averaged.
CONTEXT_STRENGTH, PARENT_STRENGTH, SWEEPS, SETTLING = 1.0, 1.0, 7, 2
#: Up to so many customers, a dish's tables are drawn from tabled Stirling numbers.
TABLED = 512
#: Text bytes in a chunk of documents.
CHUNK_BYTES = 16 << 20
#: Packed bytes of contexts in a partition of the contexts, if there are many; and
#: so many partitions before they get larger. Each hears from each partition of the
#: words in every sweep, so they are not as many as shuffle partitions.
CONTEXT_BYTES, CONTEXT_PARTS = 16 << 20, 16
#: Stands for the end of a text; no word holds a space.
END = b" "

_NAMES = ["chunk", "part", "kind", *"abcdefg"]
_BLOBS = "chunk long, part long, kind int, " + ", ".join(f"{c} binary" for c in "abcdefg")
_DOCS, _PAIRS, _COUNTS, _ANSWER, _SENT, _BACK, _MEMBERS, _CORE, _STATE = range(9)
#: A row of sweep k has a chunk number of k times this and more.
_SWEEP = 1 << 32


def pack(a: np.ndarray) -> bytes:
    """An array as compressed byte planes: low bytes first, high bytes last."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(planes)


def unpack(cell: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(cell), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _row(chunk: int, part: int, kind: int, *data: np.ndarray) -> pa.RecordBatch:
    cells = [pack(d) for d in data] + [None] * (7 - len(data))
    return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([part], pa.int64()), pa.array([kind], pa.int32()), *(pa.array([c], pa.binary()) for c in cells)], _NAMES)


def _arrays(row: tuple, *kinds: type) -> list[np.ndarray]:
    return [unpack(c, k) for c, k in zip(row[3:], kinds) if c is not None]


def contexts_of(hashes: np.ndarray) -> np.ndarray:
    """The restaurants of the tokens that follow words, from the words' hashes."""
    return (hashes % np.uint64(CONTEXTS - 1)).astype(np.int64) + 1


def context_of(word: bytes) -> int:
    """The restaurant of the token that follows ``word``."""
    return int(contexts_of(np.array([xxhash.xxh64_intdigest(word)], np.uint64))[0])


def part_of(words: np.ndarray, parts: int) -> np.ndarray:
    """The partition of a word hash: equal ranges, so sorted words stay sorted."""
    return ((words >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def _chunk(ids: pa.Array, held: np.ndarray, texts: pa.Array, chunk: int) -> pa.RecordBatch:
    """The row of one chunk: its documents, their tokens and the words' hashes."""
    flat, n = words_of(texts)
    coded = flat.dictionary_encode()
    del flat
    spelled = [w.encode() for w in coded.dictionary.to_pylist()] + [END]
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in spelled], dtype=np.uint64)
    end = len(spelled) - 1
    del spelled
    sizes = n + 1  # with the end
    token = np.full(int(sizes.sum()), end, np.int32)
    inner = np.ones(len(token), bool)
    inner[np.cumsum(sizes) - 1] = False
    token[inner] = coded.indices.to_numpy()
    del coded, inner
    # words are numbered by frequency, so that most numbers are small
    often = np.argsort(-np.bincount(token, minlength=len(hashes)), kind="stable")
    number = np.empty(len(often), np.uint32)
    number[often] = np.arange(len(often), dtype=np.uint32)
    null = ids.is_null().to_numpy(zero_copy_only=False)
    values = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return _row(chunk, -1, _DOCS, values, null, held, sizes.astype(np.uint32), number[token], hashes[often])


def chunks(docs: DataFrame) -> DataFrame:
    """A row for each chunk, from (doc_id, held, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for b in batches:
            ids, text, held = column_of(b, "doc_id"), column_of(b, "text"), column_of(b, "held").to_numpy(zero_copy_only=False)
            size = np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False))
            at = 0
            while at < b.num_rows:
                stop = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + CHUNK_BYTES, "right")))
                yield _chunk(ids[at:stop], held[at:stop], text[at:stop], number)
                number, at = number + 1, stop

    return docs.mapInArrow(run, _BLOBS)


class Tokens:
    """A chunk's row: its documents, and the (word, context) pair of each token."""

    def __init__(self, row: tuple):
        self.ids, self.null, self.held, sizes, token, words = _arrays(row, np.int64, bool, bool, np.uint32, np.uint32, np.uint64)
        self.sizes = sizes.astype(np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        order = np.argsort(words)
        self.words = words[order]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.contexts, follow = np.unique(np.r_[0, contexts_of(words)], return_inverse=True)
        key = (rank * len(self.contexts))[token]
        first = key[self.starts]
        key[1:] += follow[1:][token[:-1]]
        key[self.starts] = first
        del token
        self.pair, self.index = np.unique(key, return_inverse=True)

    def asked(self, chunk: int, parts: int) -> Iterator[pa.RecordBatch]:
        """The chunk's pairs by partition of the words."""
        words, contexts, pair = self.words, self.contexts, self.pair
        learned = np.bincount(self.index, np.repeat(~self.held, self.sizes), len(pair)).astype(np.uint32)
        word_of, its_context = pair // len(contexts), pair % len(contexts)
        many = np.bincount(word_of, minlength=len(words)).astype(np.uint32)
        where = part_of(words, parts)
        begin = np.r_[0, np.cumsum(many)]
        cuts = np.r_[np.flatnonzero(np.r_[True, where[1:] != where[:-1]]), len(words)]
        for lo, hi in zip(cuts, cuts[1:]):
            a, b = begin[lo], begin[hi]
            here, at = np.unique(its_context[a:b], return_inverse=True)
            yield _row(chunk, int(where[lo]), _PAIRS, words[lo:hi], many[lo:hi], np.diff(contexts[here], prepend=0), at.astype(np.uint32), learned[a:b])


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns))


def _steps(at: np.ndarray) -> np.ndarray:
    """Ascending positions as the steps between them."""
    return np.diff(at, prepend=0).astype(np.uint32)


def _add_up(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for a partition of the words: all words, their contexts and
    training customers, and at which of them each chunk has its own."""
    read = [(r[0], *_arrays(r, np.uint64, np.uint32, np.int64, np.uint32, np.uint32)) for r in _cells(batches)]
    words, at = np.unique(np.concatenate([r[1] for r in read]), return_inverse=True)
    at, word_cuts = at.astype(np.int64), np.cumsum([len(r[1]) for r in read])
    contexts, place = np.unique(np.concatenate([np.cumsum(r[3]) for r in read]), return_inverse=True)
    first = np.cumsum([0, *(len(r[3]) for r in read)])
    its_context = np.concatenate([place[f + r[4].astype(np.int64)] for f, r in zip(first, read)])
    pair_keys = np.repeat(at, np.concatenate([r[2] for r in read])) * len(contexts) + its_context
    pair, index = np.unique(pair_keys, return_inverse=True)
    total = np.bincount(index, np.concatenate([r[5] for r in read]), len(pair)).astype(np.int64)
    many = np.bincount(pair // len(contexts), minlength=len(words)).astype(np.uint32)
    sizes = np.array([[r[0], len(r[1]), len(r[4])] for r in read], dtype=np.int64).ravel()
    pair_cuts = np.cumsum([len(r[4]) for r in read])
    steps = [_steps(x) for x in [*np.split(at, word_cuts[:-1]), *np.split(index, pair_cuts[:-1])]]
    yield _row(-1, key[0].as_py(), _COUNTS, words, many, np.diff(contexts, prepend=0), (pair % len(contexts)).astype(np.uint32), total, sizes, np.concatenate(steps))


class Counts:
    """A partition's row: all pairs, and those with training customers."""

    def __init__(self, row: tuple):
        self.words, self.many, steps, self.at, self.n = _arrays(row, np.uint64, np.uint32, np.int64, np.uint32, np.int64)
        self.row = row
        self.contexts = np.cumsum(steps)
        self.many, self.at = self.many.astype(np.int64), self.at.astype(np.int64)
        self.word_of = np.repeat(np.arange(len(self.words)), self.many)

    def learned(self) -> tuple[np.ndarray, ...]:
        """Words, their pairs, contexts (as positions) and customers."""
        has = self.n > 0
        known, at = np.unique(self.word_of[has], return_inverse=True)
        return self.words[known], np.bincount(at, minlength=len(known)), self.at[has], self.n[has]

    def core(self) -> tuple[np.ndarray, ...]:
        """What sweeps need: by word its dishes of several customers and of one, the contexts
        and customers of the former, and by context the dishes of one customer."""
        words, many, at, n = self.learned()
        word_of, one = np.repeat(np.arange(len(words)), many), n == 1
        count = lambda x, size: np.bincount(x, minlength=size)
        return count(word_of[~one], len(words)), count(word_of[one], len(words)), at[~one], n[~one], count(at[one], len(self.contexts))

    def members(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(chunk, its words, its pairs) as positions here."""
        sizes, steps = (unpack(c, k) for c, k in zip(self.row[8:], (np.int64, np.uint32)))
        sizes = sizes.reshape(-1, 3)
        cuts = np.split(steps.astype(np.int64), np.cumsum(np.r_[sizes[:, 1], sizes[:, 2]])[:-1])
        for k, (chunk, _, _) in enumerate(sizes.tolist()):
            yield chunk, np.cumsum(cuts[k]), np.cumsum(cuts[k + len(sizes)])


def block_draw(customers: np.ndarray, strength: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """(dish, size) of tables: each dish's customers by breaking sticks, without
    a discount. Sweeps do not use it."""
    dish, left = np.arange(len(customers)), customers.copy()
    dishes, sizes = [], []
    while len(dish):
        join = rng.binomial(left - 1, rng.beta(1.0, np.maximum(strength[dish], 1e-12)))
        dishes.append(dish)
        sizes.append(1 + join)
        left = left - 1 - join
        dish, left = dish[left > 0], left[left > 0]
    return np.concatenate(dishes or [dish]), np.concatenate(sizes or [left])


def reseat(tables: np.ndarray, strength: np.ndarray, discount: float, moves: int, rng: np.random.Generator) -> None:
    """Gibbs moves on rows of table sizes (zeros are free): a random customer
    leaves and joins a table in proportion to size - discount, or a new one in
    proportion to ``strength``. Each row needs ``moves`` free places. Sweeps do not
    use them; tests do, as a second way to the distribution of tables."""
    rows, customers = np.arange(len(tables)), tables.sum(axis=1)
    for _ in range(moves):
        out = (tables.cumsum(axis=1) <= (rng.random(len(rows)) * customers)[:, None]).sum(axis=1)
        tables[rows, out] -= 1
        weight = np.where(tables > 0, tables - discount, 0.0)
        weight[rows, (tables == 0).argmax(axis=1)] = strength
        upto = weight.cumsum(axis=1)
        seat = (upto <= (rng.random(len(rows)) * upto[:, -1])[:, None]).sum(axis=1)
        tables[rows, np.minimum(seat, tables.shape[1] - 1)] += 1


@functools.lru_cache(8)
def _log_stirling(most: int, discount: float) -> np.ndarray:
    """log S(n, t) for n, t up to ``most``: the summed weights of the seatings
    of n customers at t tables, a table of m weighing (1 - discount) ... (m - 1 - discount)."""
    out = np.full((most + 1, most + 1), -np.inf)
    out[0, 0] = 0.0
    for n in range(most):
        t = np.arange(1, n + 2)
        with np.errstate(divide="ignore"):
            stay = np.log(np.maximum(n - discount * t, 0.0)) + out[n, 1 : n + 2]
        out[n + 1, 1 : n + 2] = np.logaddexp(stay, out[n, : n + 1])
    return out


def _table_weights(customers: int, strength: float, discount: float) -> tuple[np.ndarray, np.ndarray]:
    """(t, log weight) of a dish's possible tables, for many customers.

    S(n, t) is n!/(t! d^t) times the coefficient of x^n in (1 - (1 - x)^d)^t, an
    integral over p = -log(x) that the trapezoid rule gives to about ten digits
    on a path through the saddle point."""
    mean = strength / discount  # of the tables before the customers are known
    low, high = -700.0, 7.0  # log of the saddle point
    for _ in range(60):
        middle = (low + high) / 2
        p = math.exp(middle)
        if math.log(strength / customers) + (discount - 1) * math.log(-math.expm1(-p)) - p > 0:
            low = middle
        else:
            high = middle
    p, z = np.exp(low), -np.expm1(-np.exp(low))
    near = mean * -np.expm1(discount * np.log(z))
    t = np.arange(max(1, int(near - 10 * np.sqrt(near) - 15)), min(customers, int(near + 10 * np.sqrt(near) + 25)) + 1)
    if p > 0.5:  # a circle in x: few tables have more than one customer
        spread = max(customers + strength * (1 - discount) * z ** (discount - 2) * np.exp(-2 * p) - customers**2 / near, 1.0)
        points = max(128, int(10 * np.sqrt(spread)))
        angle = (np.arange(points) + 0.5) * np.pi / points
        path = p + 1j * angle[angle < max(12 / np.sqrt(spread), np.pi / 16)]
        step = np.full(len(path), 1j)
    else:  # a parabola around the cut
        p = max(p, 4.0 / customers)
        far = np.sqrt(45 / (customers * p * min(1.0, 2 * (1 - discount))))
        h = min(far / 40, 0.12)
        v = (np.arange(int(far / h) + 1) + 0.5) * h
        path, step = p * (1 + 1j * v) ** 2, 1 + 1j * v
        step = 2j * p * step
    logs = np.log1p(-((-np.expm1(-path)) ** discount))
    top = logs[0].real
    value = (np.exp(customers * (path - p) + t[:, None] * (logs - top)) * step).imag.sum(axis=1)
    factorial = np.cumsum(np.log(np.arange(1, t[-1] + 1)))[t - 1]
    return t, t * (np.log(mean) + top) - factorial + np.log(np.maximum(value, 1e-300))


def _drawn(logs: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """A column for each row, in proportion to exp(logs)."""
    upto = np.exp(logs - logs.max(axis=1, keepdims=True)).cumsum(axis=1)
    return np.minimum((upto <= (rng.random(len(logs)) * upto[:, -1])[:, None]).sum(axis=1), logs.shape[1] - 1)


def sampled_tables(customers: np.ndarray, strength: np.ndarray, discount: float, moves: int, rng: np.random.Generator) -> np.ndarray:
    """Tables of every dish, drawn from their distribution in the restaurant:
    strength^t S(n, t). That is where moves of all customers would lead, so
    ``moves`` has no effect."""
    out = np.minimum(customers, 1)
    strength = np.maximum(strength, 1e-12)
    several = customers[(customers > 1) & (customers <= TABLED)]
    most = int(several.max(initial=1))
    stirling = _log_stirling(min(TABLED, 1 << most.bit_length()), discount)  # few sizes: the partitions of a task share them
    order = np.argsort(customers, kind="stable")
    sizes = customers[order]
    begin = int(np.searchsorted(sizes, 1, "right"))
    end = int(np.searchsorted(sizes, TABLED, "right"))
    cuts = [begin, *(begin + 1 + np.flatnonzero(np.diff(sizes[begin:end]))), end] if end > begin else []
    for lo, hi in zip(cuts, cuts[1:]):  # dishes of the same number of customers
        n = int(sizes[lo])
        step = max(1, (1 << 21) // n)
        for at in range(lo, hi, step):  # bounded matrices
            own = order[at : min(hi, at + step)]
            out[own] = 1 + _drawn(stirling[n, 1 : n + 1] + np.log(strength[own])[:, None] * np.arange(1, n + 1), rng)
    for k in order[end:]:
        t, logs = _table_weights(int(customers[k]), float(strength[k]), discount)
        out[k] = t[_drawn(logs[None], rng)[0]]
    return out


class Totals:
    """What the partitions need to know of each other after a sweep: numbers
    of the whole model, and customers and tables of context restaurants."""

    def __init__(self, values: dict):
        self.words, self.tokens, self.parent_tables, self.served, once, twice, parent_once, parent_twice = (float(x) for x in values.get(0, np.zeros(8)))
        self.contexts, self.customers, self.tables = (values.get(k, np.zeros(0, np.int64)) for k in (1, 2, 3))
        share = lambda a, b: min(0.95, max(0.05, a / (a + 2 * b))) if a + b else 0.5
        self.discount, self.parent_discount = share(once, twice), share(parent_once, parent_twice)

    def of(self, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(customers, tables) of each context."""
        if contexts is self.contexts:
            return self.customers, self.tables
        if not len(self.contexts):
            return np.zeros(len(contexts), np.int64), np.zeros(len(contexts), np.int64)
        at = np.minimum(np.searchsorted(self.contexts, contexts), len(self.contexts) - 1)
        has = self.contexts[at] == contexts
        return np.where(has, self.customers[at], 0), np.where(has, self.tables[at], 0)


class Sampler:
    """The seating of one partition's words, sweep by sweep.

    ``counts`` has words, pairs by word, contexts and customers; contexts are
    positions in ``contexts`` if that is given. ``ones`` has dishes of one
    customer beside them, by word and by context: they have one table."""

    def __init__(self, part: int, counts: tuple[np.ndarray, ...], seed: int = 0, contexts: np.ndarray | None = None, ones: tuple[np.ndarray, np.ndarray] | None = None):
        self.part, self.seed = part, seed
        self.words, many, context, self.n = counts
        self.contexts, self.at = np.unique(context, return_inverse=True) if contexts is None else (contexts, context)
        self.size = len(many)
        self.word_of = np.repeat(np.arange(self.size), many)
        self.ones = ones or (np.zeros(self.size, np.int64), np.zeros(len(self.contexts), np.int64))
        self.tables = np.ones(len(self.n), np.int64)
        self.parent = np.ones(self.size, np.int64)

    def served(self) -> np.ndarray:
        """Customers of each word in the parent: its tables in the contexts."""
        return np.bincount(self.word_of, self.tables, self.size).astype(np.int64) + self.ones[0]

    def totals(self) -> list[np.ndarray]:
        """Numbers of the whole model, contexts, their customers and tables: this partition's share."""
        served, ones = self.served(), self.ones[0].sum()
        model = [self.size, self.n.sum() + ones, self.parent.sum(), served.sum(), (self.n == 1).sum() + ones, (self.n == 2).sum(), (served == 1).sum(), (served == 2).sum()]
        by_context = lambda x: np.bincount(self.at, x, len(self.contexts)).astype(np.int64) + self.ones[1]
        return [np.array(model, float), self.contexts, by_context(self.n), by_context(self.tables)]

    def parent_probability(self, t: Totals) -> tuple[np.ndarray, float]:
        """P(word) in the parent, and that of a word never seen."""
        new = (PARENT_STRENGTH + t.parent_discount * t.parent_tables) / (t.words + 1)
        every = PARENT_STRENGTH + t.served
        return (self.served() - t.parent_discount * self.parent + new) / every, new / every

    def sweep(self, number: int, t: Totals) -> None:
        """Seat all customers anew, given the totals of the sweep before."""
        rng = np.random.default_rng([self.seed, self.part, number])
        known, _ = self.parent_probability(t)
        strength = (CONTEXT_STRENGTH + t.discount * t.of(self.contexts)[1])[self.at] * known[self.word_of]
        self.tables = sampled_tables(self.n, strength, t.discount, 0, rng)
        new = (PARENT_STRENGTH + t.parent_discount * t.parent_tables) / (t.words + 1)
        self.parent = sampled_tables(self.served(), np.full(self.size, new), t.parent_discount, 0, rng)

    def sample(self, t: Totals) -> tuple:
        """What the seating and the totals after it say of probabilities."""
        return t, self.tables, *self.parent_probability(t)

    def averaged(self, history: list[Totals], words: np.ndarray, many: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log10 predictive probability of each pair, training count of each
        word); history[k] holds the totals after k sweeps."""
        samples = []
        for k, t in enumerate(history):
            if k:
                self.sweep(k, history[k - 1])
            samples.append(self.sample(t))
        return self.predicted(samples[1 + SETTLING :] or samples[-1:], words, many, *np.unique(context, return_inverse=True))

    def predicted(self, samples: list[tuple], words: np.ndarray, many: np.ndarray, contexts: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same from samples; the pairs' contexts are ``contexts[asked]``."""
        place = np.searchsorted(contexts, self.contexts)  # own contexts that nobody asks for match no pair
        own_asked = place < len(contexts)
        own_asked[own_asked] = contexts[place[own_asked]] == self.contexts[own_asked]
        mine = np.flatnonzero(own_asked[self.at])
        keys = self.word_of[mine] * len(contexts) + place[self.at[mine]]
        at = np.searchsorted(self.words, words)
        known = at < self.size
        known[known] = self.words[at[known]] == words[known]
        count = np.zeros(len(words), np.int64)
        count[known] = np.bincount(self.word_of, self.n, self.size).astype(np.int64)[at[known]]
        word_at, word_known = np.repeat(at, many), np.repeat(known, many)
        pair = word_at * len(contexts) + asked
        dish = np.searchsorted(keys, pair)
        has = word_known & (dish < len(keys))
        has[has] = keys[dish[has]] == pair[has]
        dish = mine[dish[has]]
        p = np.zeros(len(asked))
        for t, tables, parent, unseen in samples:
            from_parent = np.full(len(asked), unseen)
            from_parent[word_known] = parent[word_at[word_known]]
            own = np.zeros(len(asked))
            own[has] = self.n[dish] - t.discount * tables[dish]
            customers, all_tables = (x[asked] for x in t.of(contexts))
            here = (own + (CONTEXT_STRENGTH + t.discount * all_tables) * from_parent) / (CONTEXT_STRENGTH + customers)
            p += np.where(customers > 0, here, from_parent)
        return np.log10(p / len(samples)), count


def _cuts(contexts: np.ndarray, parts: int) -> np.ndarray:
    """Where the partitions of the contexts begin and end in sorted contexts."""
    return np.searchsorted(part_of(contexts.astype(np.uint64) << np.uint64(1), parts), np.arange(parts + 1))


def _first(batches: Iterator[pa.RecordBatch], seed: int, parts: int) -> Iterator[pa.RecordBatch]:
    """From the partitions of the words to those of the contexts: contexts,
    customers and tables, one table a dish."""
    for r in _cells(batches):
        counts = Counts(r)
        s = Sampler(r[1], counts.learned(), seed, counts.contexts)
        model, _, customers, tables = s.totals()
        cuts = _cuts(counts.contexts, parts)
        for c, (a, b) in enumerate(zip(cuts, cuts[1:])):
            yield _row(r[1], c, _SENT, model, tables[a:b], customers[a:b], np.diff(counts.contexts[a:b], prepend=0))


def _cores(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """What sweeps need of each partition of the words."""
    for r in _cells(batches):
        counts = Counts(r)
        yield _row(r[0], r[1], _CORE, *(x.astype(np.int64) for x in counts.core()), _cuts(counts.contexts, parts))


def _merge(key: tuple, batches: Iterator[pa.RecordBatch], number: int) -> Iterator[pa.RecordBatch]:
    """Totals of a partition of the contexts, sent back to those of the words."""
    sent, members = {}, None
    for r in _cells(batches):
        if r[2] == _SENT:
            sent[r[0]] = r
        elif r[2] == _MEMBERS:
            members = r
        else:  # passes by
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((number * _SWEEP, r[0], *r[2:]), (pa.int64(), pa.int64(), pa.int32(), *[pa.binary()] * 7))], _NAMES)
    if not sent:
        return
    c = key[0].as_py()
    order = sorted(sent)
    model = sum(_arrays(sent[w], float)[0] for w in order)
    own = [_arrays(sent[w], float, np.int64, np.int64) for w in order]
    cuts = np.cumsum([len(x[1]) for x in own])[:-1]
    if members is None:
        _, at = np.unique(np.concatenate([np.cumsum(_arrays(sent[w], float, np.int64, np.int64, np.int64)[3]) for w in order]), return_inverse=True)
        yield _row(c, c, _MEMBERS, np.concatenate([_steps(x) for x in np.split(at, cuts)]))
    else:
        at = np.concatenate([np.cumsum(x) for x in np.split(_arrays(members, np.uint32)[0].astype(np.int64), cuts)])
    summed = [np.split(np.bincount(at, np.concatenate([x[k] for x in own])).astype(np.int64)[at], cuts) for k in range(1, len(own[0]))]
    for w, *mine in zip(order, *summed):
        yield _row(number * _SWEEP + c, w, _BACK, model, *mine)


def _sweep(key: tuple, batches: Iterator[pa.RecordBatch], number: int, seed: int, parts: int) -> Iterator[pa.RecordBatch]:
    """The next sweep of a partition of the words, and what it sends."""
    core, state, back = None, None, {}
    for r in _cells(batches):
        if r[2] == _BACK:
            back[r[0]] = r
        elif r[2] == _STATE:
            state = r
        else:
            core = r
    part = key[0].as_py()
    many, ones, at, n, context_ones, cuts = _arrays(core, *[np.int64] * 6)
    contexts = np.arange(len(context_ones))  # stand for the contexts
    s = Sampler(part, (None, many, at, n), seed, contexts, (ones, context_ones))
    if state:
        s.tables, s.parent = _arrays(state, np.int64, np.int64)
    s.sweep(number, _returned(back, contexts))
    model, _, _, tables = s.totals()
    for c, (a, b) in enumerate(zip(cuts, cuts[1:])):
        yield _row(part, c, _SENT, model, tables[a:b])
    yield _row(part, part % parts, _STATE, s.tables, s.parent)


def _returned(back: dict[int, tuple], contexts: np.ndarray, customers: np.ndarray | None = None) -> Totals:
    """Totals of a sweep from the rows of the partitions of the contexts."""
    rows = [_arrays(back[k], float, np.int64, np.int64) for k in sorted(back)]
    column = lambda k: np.concatenate([r[k] for r in rows])
    return Totals({0: rows[0][0], 1: contexts, 2: column(2) if len(rows[0]) > 2 else customers, 3: column(1)})


def _answer(key: tuple, batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[pa.RecordBatch]:
    """What each chunk asked of a partition of the words."""
    counts, states, back = None, {}, {}
    for r in _cells(batches):
        if r[2] == _COUNTS:
            counts = r
        elif r[2] == _STATE:
            states[r[0] // _SWEEP] = r
        else:
            back.setdefault(r[0] // _SWEEP, {})[r[0]] = r
    part, every = key[0].as_py(), Counts(counts)
    s = Sampler(part, every.learned(), seed, every.contexts)
    start = _returned(back[0], every.contexts)
    samples = []
    for k in sorted(states):
        tables, s.parent = _arrays(states[k], np.int64, np.int64)
        s.tables = np.ones(len(s.n), np.int64)
        s.tables[s.n > 1] = tables
        samples.append(s.sample(_returned(back[k], every.contexts, start.customers)))
    logs, count = s.predicted(samples, every.words, every.many, every.contexts, every.at)
    logs = logs.astype(np.float32)
    size = np.array([start.tokens, start.words])
    for chunk, its_words, its_pairs in every.members():
        many = np.bincount(np.searchsorted(its_words, every.word_of[its_pairs]), minlength=len(its_words))
        yield _row(chunk, part, _ANSWER, logs[its_pairs], count[its_words], many.astype(np.uint32), size)


def _by_part(rows: DataFrame, run: Callable, *more: int) -> DataFrame:
    def each(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(key, batches, *more)

    return rows.groupBy("part").applyInArrow(each, _BLOBS)


def _at(own: DataFrame, key: str, rows: DataFrame, run: Callable, schema: str, *more: int) -> DataFrame:
    """``run`` over the groups of bucketed rows and others; only the others are exchanged."""

    def each(key: tuple, own: pa.Table, rows: pa.Table) -> pa.Table:
        return pa.Table.from_batches(run(key, [*own.to_batches(), *rows.to_batches()], *more))

    return own.groupBy(key).cogroup(rows.groupBy(key)).applyInArrow(each, schema)


def _add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The scores of a chunk's documents."""
    found, own = {}, None
    for r in _cells(batches):
        if r[2] == _DOCS:
            own = r
        else:
            found[r[1]] = r  # by partition: the order of the words
    answers = [_arrays(found[k], np.float32, np.int64, np.uint32, float) for k in sorted(found)]
    tokens, words = answers[0][3]
    logs = np.concatenate([a[0] for a in answers]).astype(np.float64)
    count = np.concatenate([np.repeat(a[1], a[2]) for a in answers])
    t = Tokens(own)
    base = np.log10((count + 0.5) / (tokens + 0.5 * (words + 1)))
    per_doc = lambda x: np.add.reduceat(x[t.index], t.starts)
    yield pa.RecordBatch.from_arrays([
        pa.array(t.ids, pa.int64(), mask=t.null), pa.array(t.held), pa.array(t.sizes), pa.array(per_doc((count > 0).astype(np.int64))),
        pa.array(np.full(len(t.ids), int(tokens), np.int64)), pa.array(per_doc(base)), pa.array(per_doc(logs)),
    ], ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fold: int = 1, folds: int = 5, seed: int = 0) -> DataFrame:
    """One row per row: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score and score (log10 probability of the text and its end).

    The model learns from rows whose crc32(doc_id as text) mod ``folds`` is
    not ``fold``. Null and empty texts are an end alone; repeated rows are
    learned as often as they come; null ids are kept (the text of their id is
    empty); an empty table gives no rows; other columns are ignored. The
    driver gets one number."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.pmod(id_text_crc(id_col), F.lit(folds)) == fold).alias("held"), F.col(text_col).cast("string").alias("text"))
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = 4 * buckets
    kinds = lambda df, *k: df.where(F.col("kind").isin(*k))

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _cells(batches):
            yield from Tokens(r).asked(r[0], parts)

    rows = bucketed(chunks(src), "lm-chunks", "chunk", buckets)
    counts = bucketed(_by_part(rows.mapInArrow(asked, _BLOBS), _add_up), "lm-counts", "part", buckets)
    drop_shuffles(spark)
    size = counts.agg(F.sum(F.length("c"))).first()[0] or 0  # of contexts
    context_parts = min(buckets, max(CONTEXT_PARTS, size // CONTEXT_BYTES))
    core = bucketed(counts.mapInArrow(lambda b: _cores(b, context_parts), _BLOBS), "lm-core", "part", buckets)

    def merged(sent: DataFrame, number: int) -> DataFrame:
        out = staged(_by_part(sent, _merge, number), f"lm-totals-{number}")
        drop_shuffles(spark)
        return out

    history = [merged(counts.mapInArrow(lambda b: _first(b, seed, context_parts), _BLOBS), 0)]
    for k in range(1, SWEEPS + 1):
        sent = _at(core, "part", kinds(history[-1], _BACK, _STATE), _sweep, _BLOBS, k, seed, context_parts)
        history.append(merged(sent.unionByName(kinds(history[0], _MEMBERS)), k))
    told = kinds(history[0], _BACK)
    for h in history[1 + SETTLING :]:
        told = told.unionByName(kinds(h, _BACK, _STATE))
    answers = _at(counts, "part", told, _answer, _BLOBS, seed)
    return _at(rows, "chunk", answers, _add, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def perplexity(scored: DataFrame) -> DataFrame:
    """(held_out, perplexity, base_perplexity) over all tokens of each fold."""
    per = lambda c: F.pow(F.lit(10.0), -F.sum(c) / F.sum("n_tokens"))
    return scored.groupBy("held_out").agg(per("score").alias("perplexity"), per("base_score").alias("base_perplexity"))
