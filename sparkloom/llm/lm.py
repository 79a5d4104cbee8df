"""Texts scored by a hashed maximum-entropy model of words in classes."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Aside, few, land, scratch, short_batches, table, tidy, whole

#: Words that workers know by number: the most frequent of at most LONGEST bytes, at most so many. The others' counts come by a join.
HEAD, LONGEST = 1 << 18, 64
#: Classes, and branches of a class or of a group of words within one.
CLASSES = 32
#: Groups of last words that the choice within a class may tell apart, at most; a power of two.
GROUPS = 256
#: Rows of parameters grow with the square root of the training tokens, up to these bounds, which bound what is broadcast.
MOST_OWN, MOST_DEEP = 1 << 14, 1 << 17
#: Pairs of a word and the next whose features the trees know, at most: all pairs, or else the most frequent.
MOST_PAIRS = 1 << 21
ROUNDS, RATE, PRIOR = 2, 0.6, 4.0
#: Pairs that the driver weighs at a time.
PART = 1 << 17
#: What a pair's count loses to the words that were not seen after its first word.
DISCOUNT = 0.6
ALPHA = 0.1
#: Tokens that a worker takes at a time, which bounds its memory, and that a training task takes in all.
BLOCK, TASK = 160_000, 1 << 26
#: Blocks whose pairs a worker counts at a time, and tokens whose contexts it takes together when it sums what the model expects.
TOGETHER, CONTEXTS = 4, 1 << 20
#: Rows of features that are multiplied at a time, so that they stay in a core's cache, and summed at a time.
NEAR, SUMMED = 4096, 512
#: Where a sum of products of exponentials is below this it is taken anew from logarithms.
TINY = 1e-20
CHUNK = 64
LOG10 = math.log(10)


class Words(NamedTuple):
    """What is known of words: by number, 0 for the end of a text and then the head in falling order of counts."""

    head: list[bytes]
    counts: np.ndarray
    total: int
    distinct: int


class Layout(NamedTuple):
    """Where words stand, and which rows of parameters their contexts have.

    cls by number; size and mass of each class, of which the last holds all other words; start, the classes'
    logarithms by counts. own and shapes: context words with a row of their own, and rows that all others
    share by their last three bytes; context, the row by number. A class of several words is a tree: path and
    branch, by level and number, are the node that a word passes (-1: none) and its branch there; prior, by
    node and branch, the logarithm by counts. Node k has rows first[k] and on, one for each of its groups of
    last words, group[context row] >> shift[k]. node_of: the node by row; part: its share of all tokens, by node.
    """

    cls: np.ndarray
    size: np.ndarray
    mass: np.ndarray
    start: np.ndarray
    own: int
    shapes: int
    context: np.ndarray
    path: np.ndarray
    branch: np.ndarray
    prior: np.ndarray
    group: np.ndarray
    first: np.ndarray
    shift: np.ndarray
    node_of: np.ndarray
    part: np.ndarray

    @property
    def before(self) -> int:
        """The context row of what stands before a text."""
        return self.own + self.shapes

    @property
    def tables(self) -> tuple[int, int, int]:
        """Rows of the classes' parameters, one table after another: last word, the word before (a skip), both hashed."""
        return self.before + 1, self.before + 1, 2 * self.own


class Pairs(NamedTuple):
    """What the trees know of words and those that followed them.

    The pairs of first word k are those from pair_of[k] on: word, the second one, and logs, the logarithm of
    its probability within its class. Its nodes, which one of its pairs passes, are from node_of[k] on: node,
    and left, the logarithm of the probability to come there and to take none of the branches seen after k.
    Such branches share it as their group's row says.
    """

    pair_of: np.ndarray
    word: np.ndarray
    logs: np.ndarray
    node_of: np.ndarray
    node: np.ndarray
    left: np.ndarray


def _shape(word: bytes) -> int:
    return zlib.crc32(word[-3:])


def count_words(docs: DataFrame) -> DataFrame:
    """word and c over all rows' _t; the row with a null word counts the texts. Each task counts in a dictionary that it sends off when large."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(words, counts):
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts, pa.int64())], names=["word", "n"])

        seen: Counter[bytes] = Counter()
        texts = 0
        for b in few(batches):
            for t in b.column(0).to_pylist():
                seen.update(t.encode().lower().split())
                texts += 1
                if len(seen) > 250_000:
                    yield out([w.decode() for w in seen], list(seen.values()))
                    seen.clear()
        yield out([w.decode() for w in seen] + [None], [*seen.values(), texts])

    return docs.select("_t").mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("c")).where("c > 0")


def known_words(counts: DataFrame, head: int = HEAD) -> tuple[Words, DataFrame]:
    """The head, at most `head` words of the highest counts, and the other words' counts, which stay in Spark.

    Words of more than LONGEST bytes are never in the head, so that it is bounded in bytes.
    """
    short = F.col("word").isNull() | (F.octet_length("word") <= LONGEST)
    step = F.when(short, F.floor(F.log2("c") * 16)).otherwise(-1)
    level: dict[int, tuple[int, int]] = {}
    ends = 0
    for r in counts.groupBy(F.col("word").isNull().alias("end"), step.alias("step")).agg(F.count(F.lit(1)).alias("k"), F.sum("c").alias("n")).collect():
        if r.end:
            ends = r.n
        else:
            level[r.step] = (r.k, r.n)
    least = _least({s: k for s, (k, _) in level.items() if s >= 0}, head)  # at most 16 * 64 levels
    inside = (step >= least) & F.col("word").isNotNull()
    got = counts.where(inside).orderBy(F.desc("c"), "word").toPandas()
    words = Words([w.encode() for w in got["word"]], np.concatenate([[ends], got["c"].to_numpy()]).astype(np.float64), ends + sum(n for _, n in level.values()), (ends > 0) + sum(k for k, _ in level.values()))
    return words, counts.where(~inside & F.col("word").isNotNull())


def lay_out(words: Words) -> Layout:
    """Classes by counts: words in falling order, each class about as much of the corpus as the next. Classes' trees likewise."""
    c = words.counts
    n = len(c)
    order = np.argsort(-c, kind="stable")
    share = np.cumsum(c[order]) - c[order] / 2
    raw = np.minimum((share / max(c.sum(), 1) * (CLASSES - 1)).astype(np.int64), CLASSES - 2)
    cls = np.zeros(n, np.int64)
    cls[order] = raw
    size = np.bincount(cls, minlength=CLASSES).astype(np.float64)
    mass = np.bincount(cls, weights=c, minlength=CLASSES)
    mass[-1], size[-1] = words.total - c.sum(), words.distinct - (c > 0).sum() + 1
    start = np.log(np.maximum((mass + ALPHA * size) / (mass + ALPHA * size).sum(), 1e-30))
    root = math.sqrt(max(words.total, 1))
    own = min(max(1 << round(math.log2(8 * root)), 256), MOST_OWN)
    shapes = own // 2
    context = np.array([0] + [k + 1 if k + 1 < own else own + _shape(w) % shapes for k, w in enumerate(words.head)])
    # Groups of last words: by counts, so that frequent words are groups of their own; then all others, then the beginning.
    group = np.full(own + shapes + 1, GROUPS - 2)
    told = np.minimum((share / max(c.sum(), 1) * (GROUPS - 2)).astype(np.int64), GROUPS - 3)
    inside = order < own
    group[order[inside]] = told[inside]
    group[-1] = GROUPS - 1

    total = np.concatenate([[0], np.cumsum(c[order] + ALPHA)])
    path, branch, prior, masses = [], [], [], []
    edges = np.flatnonzero(np.diff(raw)) + 1
    open_ = [(int(x), int(y), 0) for x, y in zip([0, *edges], [*edges, n], strict=True)]
    while open_:
        lo, hi, level = open_.pop()
        if hi - lo < 2:
            continue
        if level == len(path):
            path.append(np.full(n, -1, np.int32))
            branch.append(np.zeros(n, np.int8))
        if hi - lo <= CLASSES:
            cuts = np.arange(lo, hi + 1)
        elif level:
            cuts = np.linspace(lo, hi, min(CLASSES, -(-(hi - lo) // CLASSES)) + 1).astype(np.int64)
        else:  # by counts, each branch one word at least
            want = np.searchsorted(total, total[lo] + (total[hi] - total[lo]) * np.arange(1, CLASSES) / CLASSES)
            cuts = np.unique(np.clip(np.concatenate([[lo], want, [hi]]), lo, hi))
        here = order[lo:hi]
        path[level][here] = len(prior)
        branch[level][here] = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
        shares = np.full(CLASSES, -np.inf, np.float32)
        shares[: len(cuts) - 1] = np.log((total[cuts[1:]] - total[cuts[:-1]]) / (total[hi] - total[lo]))
        prior.append(shares)
        masses.append(total[hi] - total[lo])
        if hi - lo > CLASSES:
            open_ += [(int(x), int(y), level + 1) for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
    # Rows for a node in proportion to how often it is passed, two at least: about 32 times the root of the tokens in all.
    rows = np.array(masses) / max(root / 16, 1.0)
    rows *= min(1.0, MOST_DEEP / 2 / max(rows.sum(), 1.0))
    bits = np.clip(np.floor(np.log2(np.maximum(rows, 2.0))), 1, math.log2(GROUPS)).astype(np.int64)
    held = np.left_shift(1, bits)
    shift = int(math.log2(GROUPS)) - bits
    levels = len(path)
    return Layout(
        cls, size, mass, start, own, shapes, context,
        np.array(path).reshape(levels, n), np.array(branch).reshape(levels, n), np.array(prior, np.float32).reshape(-1, CLASSES),
        group, np.cumsum(held) - held, shift, np.repeat(np.arange(len(held)), held), np.array(masses) / max(words.total, 1),
    )


def _pair(a: np.ndarray, b: np.ndarray, rows: int, mix: int) -> np.ndarray:
    return (((a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ b.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) * np.uint64(2 * mix + 1)) >> np.uint64(40)).astype(np.int64) % rows


def _softmax(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logarithms of the sums of the exponentials by row, and the shares."""
    top = x.max(1, keepdims=True)
    e = np.exp(x - top)
    total = e.sum(1, keepdims=True)
    return (top + np.log(total))[:, 0], e / total


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where in keys, which are in order, each of wanted stands; -1 where it does not. Wanted ones had better be nearly in order, so that the search walks through keys."""
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return np.where(keys[at] == wanted, at, -1) if len(keys) else np.full(len(wanted), -1)


def before(ids: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The id before each token; 0, the end's, at the beginning of a text."""
    last = np.zeros(len(ids), np.int64)
    last[1:] = ids[:-1]
    last[np.cumsum(lens) - lens] = 0
    return last


class Model:
    """Log-linear classes given three rows of features; in the tree of a class, branches given the last word's group and, where pairs are given, that word. All words beyond the head by counts."""

    def __init__(self, lay: Layout, known: int, weights: np.ndarray | None = None, deep: np.ndarray | None = None, pairs: Pairs | None = None):
        """Weights that are not given are zero."""
        self.lay, self.known, self.pairs = lay, known, pairs
        if pairs:  # numbers of both, in order
            words, nodes = (np.repeat(np.arange(known), np.diff(x)) for x in (pairs.pair_of, pairs.node_of))
            self.pair, self.node = words * known + pairs.word, nodes * len(lay.prior) + pairs.node
        weights = np.zeros((sum(lay.tables), CLASSES), np.float32) if weights is None else weights
        # Of each table the logarithms, less a row's highest, and their exponentials: a row's own factor is in all classes alike.
        self.rows = np.split(weights, np.cumsum(lay.tables)[:-1])
        self.rows[0] = self.rows[0] + lay.start.astype(np.float32)
        self.rows = [x - x.max(1, keepdims=True) for x in self.rows]
        self.exp = [np.exp(x) for x in self.rows]
        x = lay.prior[lay.node_of] + (0 if deep is None else deep)
        self.logs = x - _softmax(x)[0][:, None]
        self.floor = math.log(lay.mass[-1] + ALPHA * lay.size[-1])

    def _placed(self, ids: np.ndarray, lens: np.ndarray, skip: int = 0) -> tuple[np.ndarray, ...]:
        """Of each token but the first `skip`: whether it is in the head, its number there, its class, the context rows of the two before it, and the number of the one before it."""
        lay, n = self.lay, len(ids)
        head = ids < self.known
        at = np.minimum(ids, self.known - 1)
        cls = np.where(head, lay.cls[at], CLASSES - 1)
        ctx = np.where(head, lay.context[at], lay.own + (ids - self.known) % lay.shapes)
        starts = np.cumsum(lens) - lens
        one, two = np.full(n, lay.before), np.full(n, lay.before)
        one[1:], two[2:] = ctx[:-1], ctx[:-2]
        one[starts] = two[starts] = lay.before
        two[starts[lens > 1] + 1] = lay.before
        return tuple(x[skip:] for x in (head, at, cls, one, two, before(ids, lens)))

    def _branches(self, head: np.ndarray, at: np.ndarray, one: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Level by level, the tokens whose class goes that deep, their rows there and the branches that they take."""
        lay, group = self.lay, self.lay.group[one]
        for path, branch in zip(lay.path, lay.branch, strict=True):
            node = path[at]
            here = np.flatnonzero(head & (node >= 0))
            node = node[here]
            yield here, lay.first[node] + (group[here] >> lay.shift[node]), branch[at[here]].astype(np.int64)

    def count(self, ids: np.ndarray, lens: np.ndarray, found: np.ndarray, deep: np.ndarray, skip: int = 0) -> None:
        """Adds up how often each feature occurs: of the classes' tables in found, of the trees' rows in deep. The first `skip` tokens are context alone."""
        head, at, cls, one, two, _ = self._placed(ids, lens, skip)
        tables = self.lay.tables
        edge = np.cumsum((0,) + tables)
        for k, rows in enumerate((one, two, _pair(one, two, tables[2], 1))):
            np.add.at(found.reshape(-1), (edge[k] + rows) * CLASSES + cls, np.float32(1))
        for _, row, to in self._branches(head, at, one):
            np.add.at(deep.reshape(-1), row * CLASSES + to, np.float32(1))

    def block(self, ids: np.ndarray, lens: np.ndarray, expected: np.ndarray | None = None, skip: int = 0) -> np.ndarray | None:
        """Natural logarithms of the tokens' probabilities; of words beyond the head, without their counts. The first `skip` tokens are context alone.

        ids beyond the head are its length and a shape. Into expected, where it is given, goes how often the
        model expects the features of the classes' tables instead, and nothing else is made.
        """
        if expected is not None:
            return self.expect(self.contexts(ids, lens, skip), expected)
        head, at, cls, one, two, last = self._placed(ids, lens, skip)
        three = one, two, _pair(one, two, self.lay.tables[2], 1)
        out = sum(x.ravel()[rows * CLASSES + cls].astype(np.float64) for x, rows in zip(self.rows, three, strict=True)) - self._logz(*three)
        out[~head] -= self.floor
        told = np.flatnonzero(head)
        keys, inverse = np.unique(last[told] * self.known + at[told], return_inverse=True)
        out[told] += self._trees(*np.divmod(keys, self.known))[inverse]
        return out

    def _logz(self, *three: np.ndarray) -> np.ndarray:
        """The logarithms of the sums of the classes' exponentials, by rows of the three tables, as self.rows has them."""
        n = len(three[0])
        z = np.empty(n, np.float32)
        held = np.empty((3, NEAR, CLASSES), np.float32)
        for k in range(0, n, NEAR):
            x, y, e = (np.take(e, rows[k : k + NEAR], 0, out=h[: min(NEAR, n - k)], mode="clip") for e, rows, h in zip(self.exp, three, held, strict=True))
            np.einsum("ij,ij->i", np.multiply(x, y, out=x), e, out=z[k : k + NEAR])
        low = np.flatnonzero(z < TINY)
        z[low] = 1
        out = np.log(z, dtype=np.float64)
        out[low] = _softmax(self._logs(low, three))[0]
        return out

    def _logs(self, of: np.ndarray, three: tuple[np.ndarray, ...]) -> np.ndarray:
        """The classes' logarithms, not yet made to sum to 1."""
        return sum(x[rows[of]].astype(np.float64) for x, rows in zip(self.rows, three, strict=True))

    def _trees(self, last: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The logarithms of words within their classes, by the word before (0: the beginning) and number, both in order."""
        lay = self.lay
        out = np.zeros(len(at))
        rest, open_ = np.arange(len(at)), np.zeros(len(at), bool)
        if self.pairs:
            pair = _find(self.pair, np.where(last < self.known, last * self.known + at, -1))
            out = self.pairs.logs[pair].astype(np.float64) if len(self.pairs.logs) else out
            rest = np.flatnonzero(pair < 0)
            last, at = last[rest], at[rest]
            open_ = last < self.known
        one = np.where(last < self.known, lay.context[np.minimum(last, self.known - 1)], lay.own + (last - self.known) % lay.shapes)
        one[last == 0] = lay.before
        tree = np.zeros(len(at))
        for here, row, to in self._branches(np.full(len(at), True), at, one):
            go = here[open_[here]]
            if len(go):  # the deepest node that the last word is known at counts, whatever led there
                node = _find(self.node, last[go] * len(lay.prior) + lay.node_of[row[open_[here]]])
                tree[go[node >= 0]] = self.pairs.left[node[node >= 0]]
                open_[go[node < 0]] = False
            tree[here] += self.logs[row, to]
        out[rest] = tree
        return out

    def contexts(self, ids: np.ndarray, lens: np.ndarray, skip: int = 0) -> np.ndarray:
        """Of each token but the first `skip`, one number for the context rows of the two before it."""
        _, _, _, one, two, _ = self._placed(ids, lens, skip)
        return (one * self.lay.tables[0] + two).astype(np.uint32)

    def expect(self, contexts: np.ndarray, expected: np.ndarray) -> None:
        """Adds to expected how often the model expects the features of the classes' tables in these contexts.

        A context's share of a class is the product of three tables' exponentials over their sum. So for each
        row of a table what the two others make of its contexts is summed, by a product of matrices, and its
        own exponential comes in at the end.
        """
        keys, n = np.unique(contexts, return_counts=True)
        one, two = (x.astype(np.int64) for x in np.divmod(keys, self.lay.tables[0]))
        three = one, two, _pair(one, two, self.lay.tables[2], 1)
        logz = self._logz(*three)
        far = logz < math.log(TINY)
        weight = np.where(far, 0, n * np.exp(-np.where(far, 0, logz))).astype(np.float32)
        far = np.flatnonzero(far)
        share = _softmax(self._logs(far, three))[1] * n[far, None]
        edge = np.cumsum((0,) + self.lay.tables)
        for k, rows in enumerate(three):
            order = np.argsort(rows.astype(np.uint16), kind="stable")  # tables have fewer rows than that
            row, w = rows[order], weight[order]
            new = np.append(True, row[1:] != row[:-1])
            (e, a), (f, b) = ((self.exp[j], three[j][order]) for j in range(3) if j != k)
            sums = np.zeros((self.lay.tables[k], CLASSES))
            for lo in range(0, len(order), SUMMED):
                of = slice(lo, lo + SUMMED)
                x, y = (np.take(t, r[of], 0, mode="clip") for t, r in ((e, a), (f, b)))
                x *= y
                place = np.cumsum(new[of])
                place -= place[0]
                take = np.zeros((place[-1] + 1, len(place)), np.float32)
                take[place, np.arange(len(place))] = w[of]
                first = new[of].copy()
                first[0] = True
                sums[row[of][first]] += take @ x
            sums *= self.exp[k]
            np.add.at(sums, rows[far], share)
            expected[edge[k] : edge[k + 1]] += sums


def _blocks(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[tuple[pa.RecordBatch, int, int, np.ndarray, np.ndarray, int]]:
    """Rows of a batch by blocks of about BLOCK tokens: batch, first and end row, ids, lengths, skip.

    A longer text is several blocks of its own, each with the two tokens before it, which skip counts.
    """
    for batch in few(batches):
        each = [np.frombuffer(x, "<i4") for x in batch.column(at).to_pylist()]
        first, held = 0, 0
        for k, x in enumerate(each):
            long = len(x) > BLOCK
            if first < k and (long or held + len(x) > BLOCK):
                part = each[first:k]
                yield batch, first, k, np.concatenate(part).astype(np.int64), np.array([len(y) for y in part]), 0
                first, held = k, 0
            if long:
                for lo in range(0, len(x), BLOCK):
                    skip = min(lo, 2)
                    piece = x[lo - skip : lo + BLOCK].astype(np.int64)
                    yield batch, k, k + 1, piece, np.array([len(piece)]), skip
                first = k + 1
            else:
                held += len(x)
        if first < len(each):
            part = each[first:]
            yield batch, first, len(each), np.concatenate(part).astype(np.int64), np.array([len(y) for y in part]), 0


def encode(docs: DataFrame, words: Words) -> DataFrame:
    """_row (a number for each row), _id, _held, ids (int32, end last) and tail, the words beyond the head."""
    shared = docs.sparkSession.sparkContext.broadcast(words.head)
    kind = docs.schema["_id"].dataType.simpleString()
    given = docs.select(F.monotonically_increasing_id().alias("_row"), "_id", "_held", "_t")
    schema = f"_row bigint, _id {kind}, _held boolean, ids binary, tail array<string>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {w: k + 1 for k, w in enumerate(shared.value)}
        beyond = len(number) + 1
        for b in few(batches):
            ids, tails = [], []
            for t in b.column(3).to_pylist():
                tokens = t.encode().lower().split()
                x = np.fromiter(map(number.get, tokens, repeat(-1)), np.int32, len(tokens))
                other = [tokens[k] for k in np.flatnonzero(x < 0).tolist()]
                x[x < 0] = [beyond + _shape(w) % MOST_OWN for w in other]
                ids.append(x.tobytes() + b"\0\0\0\0")
                tails.append([w.decode() for w in other])
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(ids, pa.binary()), pa.array(tails, pa.list_(pa.string()))], names=["_row", "_id", "_held", "ids", "tail"])

    return given.mapInArrow(run, schema)


def _step(found: np.ndarray, expected: np.ndarray) -> np.ndarray:
    """The step of each coordinate, in its gradient's direction: a damped step of iterative scaling, by the ratio of what was found to what was expected; rare features move little."""
    return (RATE * np.log((found + PRIOR) / (expected + PRIOR))).astype(np.float32)


def _least(levels: dict[int, int], most: int) -> int:
    """The lowest level such that it and all above hold at most `most`; beyond all levels if the highest holds more."""
    least, held = 1 << 30, 0
    for s in sorted(levels, reverse=True):
        held += levels[s]
        if held > most:
            break
        least = s
    return least


def count_pairs(encoded: DataFrame, known: int, most: int = MOST_PAIRS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two words of the head in a row (the first 0 at the beginning of a text), and how often, over all training texts: all pairs, or those of the highest counts if there are more than `most`.

    TOGETHER blocks are counted at a time in their tasks and Spark sums, so a frequent pair is few rows. The
    table of sums is gone when the pairs are here.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            pair, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], names=["pair", "n"])

        held: list[np.ndarray] = [np.zeros(0, np.int64)]
        for _, _, _, ids, lens, skip in _blocks(batches, 0):
            last, ids = before(ids, lens)[skip:], ids[skip:]
            both = (last < known) & (ids < known)
            held.append(last[both] * known + ids[both])
            if len(held) > TOGETHER:
                yield out()
                held = held[:1]
        yield out()

    with scratch(encoded.sparkSession):
        counted = land(encoded.where("NOT _held").select("ids").mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("c")))
        step = F.floor(F.log2("c") * 16)
        levels = {r.step: r.k for r in counted.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("k")).collect()}  # at most 16 * 64
        got = counted.where(step >= _least(levels, most)).toArrow()
    last, word = np.divmod(got["pair"].to_numpy().astype(np.int64), known)
    return last, word, got["c"].to_numpy().astype(np.float64)


def weigh_pairs(lay: Layout, counts: np.ndarray, deep: np.ndarray, last: np.ndarray, word: np.ndarray, c: np.ndarray) -> Pairs:
    """The trees' features of pairs, upon the rows of groups.

    A choice knows one pair feature and one group row, so the weights at which the gradient is zero can be
    stated: those of what was found less DISCOUNT, with what is taken away, and a node's share of what came
    after the word in no known pair, left to the group's row.
    """
    known = len(counts)
    other = np.maximum(counts - np.bincount(last, weights=c, minlength=known), 0)
    order = np.lexsort((word, last))
    if len(lay.path):
        order = order[lay.path[0][word[order]] >= 0]  # other classes are one word
    else:
        order = order[:0]
    last, word, c = last[order].astype(np.int32), word[order].astype(np.int32), c[order].astype(np.float32)
    x = lay.prior[lay.node_of] + deep
    logs = x - _softmax(x)[0][:, None]
    ends = np.unique(np.searchsorted(last, last[np.minimum(np.arange(PART, len(last) + PART, PART), len(last) - 1)], "right")) if len(last) else []
    parts = [_weigh(lay, other, logs, last[lo:hi].astype(np.int64), word[lo:hi], c[lo:hi]) for lo, hi in zip([0, *ends], ends, strict=False)]
    logs, first, node, left = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else [np.zeros(0)] * 4

    def starts(words: np.ndarray) -> np.ndarray:
        return np.searchsorted(words, np.arange(known + 1)).astype(np.int32)

    return Pairs(starts(last), word, logs.astype(np.float32), starts(first), node.astype(np.int32), left.astype(np.float32))


def _weigh(lay: Layout, other: np.ndarray, logs: np.ndarray, last: np.ndarray, word: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, ...]:
    """logs, first words, node and left of Pairs for all pairs of some first words; other is how often what is in no pair came after a word."""
    nodes = len(lay.prior)
    passed = [np.flatnonzero(p[word] >= 0) for p in lay.path]
    every = [(last[k] * nodes + p[word[k]]) * CLASSES + b[word[k]] for k, p, b in zip(passed, lay.path, lay.branch, strict=True)]
    none = [np.zeros(0, np.int64)]
    keys, inverse = np.unique(np.concatenate(every + none), return_inverse=True)
    n = np.bincount(inverse, weights=c[np.concatenate(passed + none)], minlength=len(keys))
    contexts, of = np.unique(keys // CLASSES, return_inverse=True)
    first, node = np.divmod(contexts, nodes)
    back = DISCOUNT * np.bincount(of, minlength=len(contexts)) + other[first] * lay.part[node]
    total = np.bincount(of, weights=n - DISCOUNT, minlength=len(contexts)) + back
    context = np.where(first > 0, lay.context[first], lay.before)
    row = lay.first[node] + (lay.group[context] >> lay.shift[node])
    taken = np.log((n - DISCOUNT + back[of] * np.exp(logs[row[of], keys % CLASSES])) / total[of])
    so_far, come = np.zeros(len(word)), np.zeros(len(contexts))
    for k, to in zip(passed, np.split(inverse, np.cumsum([len(k) for k in passed])), strict=False):
        come[of[to]] = so_far[k]
        so_far[k] += taken[to]
    return so_far.astype(np.float32), first.astype(np.int32), node.astype(np.int32), (come + np.log(back / total)).astype(np.float32)


def train(encoded: DataFrame, words: Words, lay: Layout, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, Pairs]:
    """Weights of the classes, one table after another, and of the trees' rows, and the trees' features of pairs. Each round learns from all training texts.

    Its tasks sum, for each row they meet, how often its features occur and how often the model expects them;
    Spark sums these by chunks of rows, and the driver takes the step. How often features occur is counted
    once. What the model expects follows from that as long as no context counts, as in the first round, and
    always in the trees, whose choices know one row alone; the other rounds sum it over the texts. A task
    sends the tables once; it takes TASK tokens at most, or its share of the cores if that is less.
    """
    spark = encoded.sparkSession
    rows, deep_rows = sum(lay.tables), len(lay.node_of)
    weights, deep = np.zeros((rows, CLASSES), np.float32), np.zeros((deep_rows, CLASSES), np.float32)
    tasks = max(spark.sparkContext.defaultParallelism, int(words.total // TASK))
    part = encoded.where("NOT _held").select("ids").coalesce(tasks)

    def summed(work, height: int, *given: np.ndarray) -> np.ndarray:
        """The sum over tasks of the table that work(model, blocks, table) fills, with a model of the given weights. Of blocks there are ids, lens and skip."""
        shared = spark.sparkContext.broadcast((lay, len(words.counts), *given))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model, table = Model(*shared.value), np.zeros((height, CLASSES), np.float32)
            work(model, (x[3:] for x in _blocks(batches, 0)), table)
            for k in range(0, height, CHUNK):
                if table[k : k + CHUNK].any():
                    yield pa.RecordBatch.from_arrays([pa.array([k // CHUNK], pa.int32()), pa.array([table[k : k + CHUNK].ravel()], pa.list_(pa.float32()))], names=["chunk", "v"])

        sums = part.mapInArrow(run, "chunk int, v array<float>").groupBy("chunk").agg(Summarizer.sum(array_to_vector("v")).alias("s"))
        out = np.zeros((height, CLASSES))
        for chunk, s in sums.select("chunk", vector_to_array("s", "float32").alias("s")).toPandas().itertuples(index=False):
            got = np.asarray(s, np.float64).reshape(-1, CLASSES)
            out[chunk * CHUNK : chunk * CHUNK + len(got)] = got
        shared.destroy()
        return out

    def count(model: Model, blocks: Iterator[tuple], table: np.ndarray) -> None:
        for ids, lens, skip in blocks:
            model.count(ids, lens, table[:rows], table[rows:], skip)

    def expect(model: Model, blocks: Iterator[tuple], table: np.ndarray) -> None:
        """Contexts of many blocks at a time, since the more there are the more are alike."""
        held, size = [], 0
        for block in blocks:
            held.append(model.contexts(*block))
            size += len(held[-1])
            if size >= CONTEXTS:
                model.expect(np.concatenate(held), table)
                held, size = [], 0
        if held:
            model.expect(np.concatenate(held), table)

    counted = summed(count, rows + deep_rows)
    found, below = counted[:rows], counted[rows:]
    for turn in range(rounds):
        if turn:
            expected = summed(expect, rows, weights)
        else:
            expected = found.sum(1, keepdims=True) * _softmax(lay.start[None].astype(np.float32))[1]
        weights += _step(found, expected)
        deep += _step(below, below.sum(1, keepdims=True) * _softmax(lay.prior[lay.node_of] + deep)[1])
        tidy(spark)
    return weights, deep, weigh_pairs(lay, words.counts, deep, *count_pairs(encoded, len(words.counts)))


def score_texts(df: DataFrame, *, text: str = "text", doc_id: str = "doc_id", held_out=None, rounds: int = ROUNDS, head: int = HEAD) -> DataFrame:
    """_id, held_out, n_tokens, n_known, train_tokens, base_score and score for each row of df.

    The model learns from the rows whose held_out (a Column, or none) is false. Null and empty texts are an
    end alone; a long text is scored BLOCK tokens at a time, and what a worker holds of all of it is the text and
    eight bytes a token. Null ids, ties and
    repeated rows are rows like any other; other columns are not read, so their names cannot clash. Without
    training rows every score is 0 or below and base_score is 0; an empty table gives an empty result. Counts
    are exact: of the head, at most `head` words, by a broadcast table; of all other words by a join. The
    probabilities of all words and of one unknown word sum to 1 in any context.
    """
    held = F.coalesce(held_out, F.lit(False)) if held_out is not None else F.lit(False)
    short_batches(df.sparkSession)
    given = Aside(df.select("*", held.alias("_held")))
    docs = given.df.select(given.of(doc_id).alias("_id"), F.col(given.own[-1]).alias("_held"), whole(given.of(text)).alias("_t"))
    counts = land(count_words(docs.where(~F.col("_held"))))
    words, others = known_words(counts, head)
    lay = lay_out(words)
    tidy(df.sparkSession)
    encoded = land(encode(docs, words))
    weights = train(encoded, words, lay, rounds)
    spark = df.sparkSession
    tidy(spark)
    shared = spark.sparkContext.broadcast((lay, words.counts, *weights))
    kind = docs.schema["_id"].dataType.simpleString()
    divisor = math.log10(words.total + ALPHA * (words.distinct + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lay, known, *made = shared.value
        model = Model(lay, len(known), *made)
        logs = np.append(np.log10(known + ALPHA), 0.0)
        for batch, first, end, ids, lens, skip in _blocks(batches, 3):
            scored = model.block(ids, lens, skip=skip)
            ids, lens = ids[skip:], lens - (np.arange(len(lens)) == 0) * skip
            starts = np.cumsum(lens) - lens
            at = np.minimum(ids, len(known))
            base = np.add.reduceat(logs[at], starts) - lens * divisor
            seen = np.add.reduceat(np.append(known > 0, False)[at].astype(np.int64), starts)
            sums = [lens, seen, base, np.add.reduceat(scored, starts) / LOG10]
            if skip:  # further on in a long text
                sums = [x + y for x, y in zip(sums, open_, strict=True)]
            open_ = sums
            if ids[-1] == 0:  # the end of a text, a long one's too
                yield pa.RecordBatch.from_arrays([*[batch.column(k).slice(first, end - first) for k in range(3)], *map(pa.array, sums)], names=["_row", "_id", "held_out", "n_tokens", "_seen", "_base", "_made"])

    heads = encoded.select("_row", "_id", "_held", "ids").mapInArrow(run, f"_row bigint, _id {kind}, held_out boolean, n_tokens bigint, _seen bigint, _base double, _made double")
    tails = encoded.select("_row", F.explode("tail").alias("word")).join(others, "word", "left")
    tails = tails.groupBy(F.col("_row").alias("_row2")).agg(F.sum(F.log10(F.coalesce("c", F.lit(0)) + F.lit(ALPHA))).alias("_log"), F.count("c").alias("_more"))
    more = F.coalesce("_log", F.lit(0.0))
    return heads.join(tails, F.col("_row") == F.col("_row2"), "left").select(
        "_id", "held_out", "n_tokens", (F.col("_seen") + F.coalesce("_more", F.lit(0))).alias("n_known"), F.lit(int(words.total)).cast("long").alias("train_tokens"), (F.col("_base") + more).alias("base_score"), (F.col("_made") + more).alias("score"),
    )


def op1_lm_scoring(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0, F.lit(False))
    return score_texts(docs, held_out=held).withColumnRenamed("_id", "doc_id")
