"""Language-model scores by logistic context mixing, and a smoothed word unigram as the base.

A text is predicted bit by bit.  For the last 2, 3 and 4 bytes, and for the present word's last bytes (6 at most, with the
space before it), each together with the bits of the present byte, hashed tables hold how often a 1 came next in the
training texts.  Each such predictor gives the logit of its estimate; a gate (place of the bit, and how much the three longest
contexts have been seen) picks the weights with which logits are added up.  The weights are fitted to all training texts, each
under tables that do not hold it.  Three mixers, of 2, 3 and 4 predictors, are weighed against each other within each text, from
its own blocks so far.

One more predictor knows only the text itself: where the last 8 bytes stood in it before, the byte that followed is expected
again, with a trust that depends on how many such expectations in a row have just come true.
"""

from __future__ import annotations

import dataclasses
import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import dropped, written
from tidemark.llm.words import SPACE, Words, mix, text_parts

ORDERS = 4
SIZES = (1 << 20, 1 << 21, 1 << 21, 1 << 22)
BASES = (0, 1 << 20, 3 << 20, 5 << 20)
SLOTS = sum(SIZES)
SCALE = 15.0
MIXERS = (4, 3, 2)  # predictors used
END = 255  # never a byte of UTF-8
CHUNK = 1 << 16
# Steps of the fit of the mixers, how far a weight moves in one at most, and the number of bits the first weights count as.
STEPS = 4
FURTHEST = 0.5
PRIOR = 4.0
# Repeats are counted by the model's own probability, in so many bins for each power of e.
BINS, DEEPEST = 8, 128
TAG = 56  # bits of a gram
TOGETHER = 1 << 18
MET = 1 << 20  # grams whose log probabilities a task keeps
BLOCK = 128
FORGET = 0.9
COMMON = 1 << 21
GATES = 8 * 4 * 4 * 4
REPEAT = 8
RUNS = 7
LN10 = math.log(10)


# What stays of a gram if its word holds both the fifth and the sixth byte before, the fifth alone, or none.
WITHIN = ~np.array([0, 0xFF00, 0xFFFF00], dtype=np.uint64)


def windows(raw: bytes, n: int, order: str) -> np.ndarray:
    """The eight bytes from each of the first ``n`` places on, as one number."""
    return np.ndarray(n, order, raw, strides=(1,)).astype(np.uint64)


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Per byte to predict (the end included): the six bytes before, the last one first, and the byte; and where texts start.
    The fifth and sixth byte are kept only if they belong to the same word."""
    raw = b"".join(b"\0\0\0\0\0 " + t + bytes([END]) for t in texts)
    data = np.frombuffer(raw, dtype=np.uint8)
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    n, space = len(data) - 6, SPACE[data]
    key = windows(raw + bytes(2), n, "<u8")
    key <<= np.uint64(16)
    key >>= np.uint64(8)
    key &= ~np.uint64(255)
    key |= data[6:]
    near = space[5:5 + n] | space[4:4 + n] | space[3:3 + n] | space[2:2 + n]
    key &= WITHIN[near.view(np.uint8) + (near | space[1:1 + n]).view(np.uint8)]
    keep = np.ones(n, dtype=bool)
    ends = np.cumsum(sizes + 6)[:-1]
    for i in range(6):
        keep[ends - 6 + i] = False
    return key[keep], np.concatenate([[0], np.cumsum(sizes)])


def word_part(keys: np.ndarray) -> np.ndarray:
    """The contexts of the keys without what comes before the present word and its space."""
    context, inside = np.zeros(len(keys), np.uint64), np.ones(len(keys), dtype=bool)
    for back in range(1, 7):
        shift = np.uint64(56 - 8 * back)
        byte = (keys >> shift) & np.uint64(255)
        context |= np.where(inside, byte << shift, np.uint64(0))
        inside &= ~SPACE[byte.astype(np.uint8)]
    return context >> np.uint64(8)


def contexts(keys: np.ndarray) -> list[np.ndarray]:
    """Number of each predictor's context.  Neighbours with the same bytes before them share the work."""
    first, run = runs(keys >> np.uint64(8))
    keys = keys[first]
    parts = [keys >> np.uint64(40), keys >> np.uint64(32), keys >> np.uint64(24), word_part(keys)]
    return [mix(part + np.uint64((i + 1) << 60))[run] for i, part in enumerate(parts)]


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values begin, and which run each value is in."""
    new = np.ones(len(values), dtype=bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    return np.flatnonzero(new), np.cumsum(new) - 1


def slots(parts: list[np.ndarray], keys: np.ndarray, bit: int) -> np.ndarray:
    """The slot of each predictor for this bit of the bytes, one row for each predictor."""
    node = np.uint64(1 << bit) | ((keys & np.uint64(255)) >> np.uint64(8 - bit))
    out = np.empty((ORDERS, len(keys)), dtype=np.int64)
    for i, part in enumerate(parts):
        spread = (part ^ (node * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)
        out[i] = ((spread >> np.uint64(40)) & np.uint64(SIZES[i] - 1)).astype(np.int64) + BASES[i]
    return out


def bits(keys: np.ndarray, bit: int) -> np.ndarray:
    return ((keys >> np.uint64(7 - bit)) & np.uint64(1)).astype(np.int8)


@dataclasses.dataclass
class Model:
    logit: np.ndarray  # int8 for each slot, times SCALE
    sure: np.ndarray  # 0 to 3 for each slot
    weights: np.ndarray  # mixer, gate, order
    trust: np.ndarray = dataclasses.field(default_factory=lambda: np.zeros(RUNS))  # that a repeat goes on, by ``repeats``

    @functools.cached_property
    def table(self) -> np.ndarray:
        """Logits and how much is seen in one number, so that a slot is looked up once."""
        return self.logit.astype(np.int16) << 2 | self.sure

    def inputs(self, parts: list[np.ndarray], keys: np.ndarray, bit: int) -> tuple[np.ndarray, np.ndarray]:
        """Logits (order, byte) and gates of this bit of the bytes."""
        both = self.table[slots(parts, keys, bit)]
        sure = both[1:] & 3
        return (both >> 2).astype(np.float32) / np.float32(SCALE), (sure[2] * 16 + sure[1] * 4 + sure[0]).astype(np.int64) + bit * 64

    def log_probabilities(self, keys: np.ndarray, mixers: tuple[int, ...] = MIXERS) -> np.ndarray:
        """Natural log probability of every byte under every mixer (or the first ones).  Faster if the keys are in order."""
        weights = np.ascontiguousarray(self.weights.transpose(0, 2, 1), dtype=np.float32)
        parts = [self._log_probabilities(keys[at:at + CHUNK], weights, mixers) for at in range(0, len(keys), CHUNK)]
        return np.concatenate([np.zeros((len(mixers), 0), np.float32), *parts], axis=1)

    def _log_probabilities(self, keys: np.ndarray, weights: np.ndarray, mixers: tuple[int, ...]) -> np.ndarray:
        # Neighbours share what is before a bit: each bit is predicted once for a run of keys that agree so far.
        parts = contexts(keys)
        first, run = runs(keys >> np.uint64(8))
        # The product over the eight bits stays below e^640, which a double holds.
        against = np.ones((len(mixers), len(first)))
        for bit in range(8):
            x, gate = self.inputs([part[first] for part in parts], keys[first], bit)
            z = [weighed(weights[m], orders, x, gate) for m, orders in enumerate(mixers)]
            before = run
            first, run = runs(keys >> np.uint64(7 - bit))
            before = before[first]
            sign = np.float32(1) - 2 * bits(keys[first], bit).astype(np.float32)
            against = against[:, before]
            for m in range(len(mixers)):
                own = z[m][before]
                own *= sign
                against[m] *= 1 + np.exp(np.minimum(own, np.float32(80), out=own), out=own)
        return -np.log(against).astype(np.float32)[:, run]

    def scores(self, texts: list[bytes], met: Met | None = None) -> list[float]:
        """log10 probability of each text."""
        met = met or Met()
        parts = [(some, *grams(some)) for some in pieces(texts)]
        blocks, counts = [], []
        for (some, _, starts), each in zip(parts, met.looked_up([keys for _, keys, _ in parts], self.log_probabilities), strict=True):
            n, at = block_starts(starts)
            blocks.append(np.add.reduceat(self._repeated(each, *_repeats(some)), at, axis=1, dtype=np.float64))
            counts.append(n)
        return (adaptive(np.concatenate(blocks, axis=1).T, np.concatenate(counts)) / LN10).tolist()

    def with_repeats(self, each: np.ndarray, raw: bytes) -> np.ndarray:
        """The log probabilities ``each`` of a text's bytes (mixer, byte), mixed in place with what its repeats let expect."""
        return self._repeated(each, *repeats(raw))

    def _repeated(self, each: np.ndarray, at: np.ndarray, run: np.ndarray, true: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore"):
            on, off = np.log(self.trust), np.log1p(-self.trust)
        other = each[:, at] + off[run]
        other[:, true] = np.logaddexp(other[:, true], on[run[true]])
        each[:, at] = other
        return each


class Met:
    """Log probabilities of grams that came before.  Each gram has one place, by its hash, and takes it from the one there."""

    def __init__(self):
        self.keys = np.full(MET, -1, np.int64).view(np.uint64)  # never a gram
        self.each = np.zeros((MET, 4), np.float32)  # rows of 16 bytes, which numpy copies at once

    def _places(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(65 - MET.bit_length())).astype(np.int64)

    def looked_up(self, parts: list[np.ndarray], of) -> Iterator[np.ndarray]:
        """``of`` the keys of each part, which is asked once, for those that are not here."""
        places = [self._places(keys) for keys in parts]
        new = [np.flatnonzero(self.keys[place] != keys) for place, keys in zip(places, parts, strict=True)]
        distinct, which = np.unique(np.concatenate([keys[at] for keys, at in zip(parts, new, strict=True)]), return_inverse=True)
        found, begin = of(distinct), 0
        for place, at in zip(places, new, strict=True):
            out = np.ascontiguousarray(np.take(self.each, place, axis=0, mode="clip").T[:len(found)])
            out[:, at] = found[:, which[begin:begin + len(at)]]
            begin += len(at)
            yield out
        place = self._places(distinct)
        self.keys[place] = distinct
        stays = self.keys[place] == distinct
        self.each[place[stays], :len(found)] = found[:, stays].T


def weighed(weights: np.ndarray, orders: int, x: np.ndarray, gate: np.ndarray) -> np.ndarray:
    """The logits ``x`` (order, byte) added up with the gates' weights (order, gate)."""
    z = weights[0][gate] * x[0]
    for order in range(1, orders):
        z += weights[order][gate] * x[order]
    return z


def repeats(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of a text (its end is one) at which an earlier one had the same ``REPEAT`` bytes before it, the kind of run they
    are in, and whether the byte is the one that followed then.

    The kind is the bit length, up to ``RUNS`` - 1, of the number of places just before that came true without a gap.
    """
    return repeats_of([raw])


def pieces(texts: list[bytes]):
    """The texts, as many at once as make about ``TOGETHER`` bytes, whose arrays stay in the processor's cache."""
    some, size = [], 0
    for raw in texts:
        some.append(raw)
        size += len(raw) + 1
        if size >= TOGETHER:
            yield some
            some, size = [], 0
    if some:
        yield some


def repeats_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``repeats`` of each text, with the places of all texts counted on."""
    found, begin = [], 0
    for some in pieces(texts):
        at, run, true = _repeats(some)
        found.append((at + begin, run, true))
        begin += sum(map(len, some)) + len(some)
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _repeats(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = b"".join(t + bytes([END]) for t in texts) + bytes(REPEAT)
    data = np.frombuffer(raw, dtype=np.uint8)
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    size = int(sizes.sum())
    starts = np.cumsum(sizes) - sizes
    counts = np.where(sizes >= REPEAT + 2, sizes - REPEAT, 0)
    context = windows(raw, size, ">u8")
    # Sorting (hash, place) in one number finds the latest earlier place of the same hash.
    places, first = np.arange(size), np.repeat(starts, sizes)
    low = np.repeat(np.array([n.bit_length() for n in counts.tolist()], np.uint64), sizes)
    own = places - first
    both = mix(context) >> low << low | own.astype(np.uint64)
    for a, b in zip(starts.tolist(), (starts + counts).tolist(), strict=True):
        both[a:b].sort()
    high = both >> low
    inside = own < np.repeat(counts, sizes)
    same = np.flatnonzero((high[1:] == high[:-1]) & inside[1:] & (own[1:] > 0))
    place = first + (both & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
    at, before = place[same + 1], place[same]
    true, met = np.zeros(size, dtype=bool), np.zeros(size, dtype=bool)
    true[at] = data[at + REPEAT] == data[before + REPEAT]
    met[at] = True
    wrong = np.maximum.accumulate(np.where(true, -1, places))
    at = np.flatnonzero(met)
    run = at - 1 - np.maximum(np.concatenate([[-1], wrong])[at], first[at] - 1)
    return at + REPEAT, np.minimum(np.frexp(run.astype(np.float64))[1], RUNS - 1), true[at]


def block_starts(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many blocks each text has, and where they begin."""
    n = -(-np.diff(starts) // BLOCK)
    first = np.cumsum(n) - n
    return n, np.repeat(starts[:-1], n) + BLOCK * (np.arange(n.sum()) - np.repeat(first, n))


def adaptive(blocks: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Log probability of texts of ``n`` blocks each, of which every mixer gives its own (block, mixer): block by block, mixers are
    weighed by how well they did in the blocks before, the latest most.  All texts take a step at a time."""
    first = np.cumsum(n) - n
    order = np.argsort(-n, kind="stable")
    first, left = first[order], np.searchsorted(-n[order], -np.arange(n.max(initial=0)), "left")
    total, past = np.zeros(len(n)), np.zeros((len(n), blocks.shape[1]))
    for step, live in enumerate(left.tolist()):
        block, prior = blocks[first[:live] + step], np.exp(past[:live])
        top = block.max(axis=1)
        total[:live] += top + np.log((prior * np.exp(block - top[:, None])).sum(axis=1) / prior.sum(axis=1))
        past = FORGET * past[:live] + block
        past -= past.max(axis=1)[:, None]
    out = np.empty(len(n))
    out[order] = total
    return out


def _distinct_counts(values: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    value, count = np.concatenate(values), np.concatenate(counts)
    order = np.argsort(value, kind="stable")
    value, count = value[order], count[order]
    first = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]])) if len(value) else np.zeros(0, np.int64)
    return value[first], np.add.reduceat(count, first) if len(first) else count


FIRST = 1 << 32


def _grams_by_half(first: list[bool], texts: list[bytes]):
    """Grams of the texts; those of the first half count once more in the upper half of the number.  Grams at repeats come once
    more with their kind of run, and whether the repeat went on, above the gram."""
    for half, each in ((False, 1), (True, 1 + FIRST)):
        some = [t for f, t in zip(first, texts, strict=True) if f is half]
        if some:
            keys = grams(some)[0]
            at, run, true = repeats_of(some)
            tag = (1 + 2 * run + true).astype(np.uint64) << np.uint64(TAG)
            yield np.concatenate([keys, keys[at] | tag]), each


def _counted(of):
    """Count what ``of`` finds in the texts, adding up within the task up to a bounded number of distinct values."""
    def counted(batches):
        values, counts, held = [], [], 0
        for batch in batches:
            for keys, texts in text_parts(batch.column(0), batch.column(1)):
                for found, each in of(keys, texts):
                    value, count = np.unique(found, return_counts=True)
                    values.append(value)
                    counts.append(count * each)
                    held += len(value)
                if held > 1 << 22:
                    value, count = _distinct_counts(values, counts)
                    values, counts, held = [value], [count], len(value)
                    if held > 1 << 21:
                        yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(count)], ["value", "n"])
                        values, counts, held = [], [], 0
        if values:
            value, count = _distinct_counts(values, counts)
            yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(count)], ["value", "n"])
    return counted


SUMS = ("zero", "one", "first_zero", "first_one")


def _bit_counts(keys: np.ndarray, counts: list[np.ndarray], bit: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Where grams that agree in all before this bit begin, and for each of the counts how often a 0 and a 1 came there.
    Sorted grams agree with their neighbours."""
    before = keys >> np.uint64(8 - bit)
    first = np.flatnonzero(np.concatenate([[True], before[1:] != before[:-1]]))
    y = bits(keys, bit)
    return first, [np.add.reduceat(n * v, first) for n in counts for v in (1 - y, y)]


def _slot_counts(batches):
    """How often a 0 and a 1 came at every slot, in all texts and in those of the first half."""
    for batch in batches:
        keys = batch.column("value").to_numpy().view(np.uint64)
        if not len(keys):
            continue
        counts = [batch.column(c).to_numpy() for c in ("n", "first")]
        at, sums = [], [[] for _ in SUMS]
        parts = contexts(keys)
        for bit in range(8):
            first, each = _bit_counts(keys, counts, bit)
            for row in slots([part[first] for part in parts], keys[first], bit):
                at.append(row)
                for column, n in zip(sums, each, strict=True):
                    column.append(n)
        at = np.concatenate(at)
        order = np.argsort(at, kind="stable")
        at = at[order]
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(at[first]), *[pa.array(np.add.reduceat(np.concatenate(column)[order], first)) for column in sums]], ["slot", *SUMS])


PLACES = [(m, i, j) for m, orders in enumerate(MIXERS) for i in range(orders) for j in range(i, orders)]


def _apart(batch, models):
    """The grams of a batch with how often each half of the texts has them, and the model that does not hold that half."""
    keys = batch.column("value").to_numpy().view(np.uint64)
    n, first = batch.column("n").to_numpy(), batch.column("first").to_numpy()
    for model, times in zip(models, (n - first, first), strict=True):
        some = times > 0
        if some.any():
            yield model, keys[some], times[some]


def _sums(values: dict[int, np.ndarray]):
    """Sums by number, as rows."""
    for at, value in values.items():
        yield pa.RecordBatch.from_arrays([pa.array(at + np.arange(value.size)), pa.array(value.ravel())], ["at", "value"])


def _slopes(models, weights: np.ndarray):
    """Cost of the grams' bits under the mixers, its slope in each weight and its curvature, for each gate."""
    def slopes(batches):
        own = weights.transpose(0, 2, 1).copy()
        cost = np.zeros((len(MIXERS), GATES))
        slope, curve = np.zeros((len(MIXERS), ORDERS, GATES)), np.zeros((len(PLACES), GATES))
        for batch in batches:
            for model, keys, times in _apart(batch, models.value):
                parts = contexts(keys)
                for bit in range(8):
                    first, (zero, one) = _bit_counts(keys, [times], bit)
                    x, gate = model.inputs([part[first] for part in parts], keys[first], bit)
                    x, both = x.astype(np.float64), zero + one
                    at, local, bent = slice(bit * 64, bit * 64 + 64), gate - bit * 64, []
                    for m, orders in enumerate(MIXERS):
                        z = np.minimum(weighed(own[m], orders, x, gate), 500.0)
                        odds = np.exp(z)
                        cost[m, at] += np.bincount(local, both * np.log(1 + odds) - one * z, 64)
                        likely = both * (odds / (1 + odds))
                        bent.append(likely / (1 + odds))
                        push = likely - one
                        for order in range(orders):
                            slope[m, order, at] += np.bincount(local, push * x[order], 64)
                    for i in range(ORDERS):
                        for j in range(i, ORDERS):
                            pair = x[i] * x[j]
                            for m, orders in enumerate(MIXERS):
                                if j < orders:
                                    curve[PLACES.index((m, i, j)), at] += np.bincount(local, bent[m] * pair, 64)
        yield from _sums({0: cost, cost.size: slope, cost.size + slope.size: curve})
    return slopes


def _repeat_counts(models):
    """How often repeats of each kind went on and did not, by the model's own probability of the byte."""
    def counted(batches):
        counts = np.zeros((RUNS, 2, DEEPEST))
        for batch in batches:
            for model, tagged, times in _apart(batch, models.value):
                kind = (tagged >> np.uint64(TAG)).astype(np.int64) - 1
                own = model.log_probabilities(tagged & np.uint64((1 << TAG) - 1), MIXERS[:1])[0]
                deep = np.minimum(-own * BINS, DEEPEST - 1).astype(np.int64)
                counts += np.bincount(kind * DEEPEST + deep, times, counts.size).reshape(counts.shape)
        yield from _sums({0: counts})
    return counted


def _added(keys: DataFrame, of, size: int) -> np.ndarray:
    """The sums that ``of`` makes over the grams: as many numbers whatever the input, added up by Spark."""
    rows = keys.mapInArrow(of, "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(size)
    out[rows["at"].to_numpy()] = rows["value"].to_numpy()
    return out


def fitted(keys: DataFrame, models, start: np.ndarray) -> np.ndarray:
    """Weights (mixer, gate, order) of least cost over all grams, by Newton's method: each step is one job over the grams.

    ``PRIOR`` pulls towards the first weights, so a gate without bits keeps them.  A step that raised the cost of a gate is halved.
    """
    best, least, step, weights = start, np.full(start.shape[:2], np.inf), np.zeros_like(start), start
    shapes = [(len(MIXERS), GATES), (len(MIXERS), ORDERS, GATES), (len(PLACES), GATES)]
    sizes = [math.prod(shape) for shape in shapes]
    for _ in range(STEPS):
        sums = np.split(_added(keys, _slopes(models, weights), sum(sizes)), np.cumsum(sizes)[:-1])
        cost, slope, curve = (part.reshape(shape) for part, shape in zip(sums, shapes, strict=True))
        away = weights - start
        cost = cost + PRIOR / 2 * (away ** 2).sum(axis=2)
        slope = slope.transpose(0, 2, 1) + PRIOR * away
        bend = np.tile(PRIOR * np.eye(ORDERS), (*start.shape[:2], 1, 1))
        for own, (m, i, j) in zip(curve, PLACES, strict=True):
            bend[m, :, i, j] += own
            if i != j:
                bend[m, :, j, i] += own
        down = np.linalg.solve(bend, -slope[..., None])[..., 0]
        down *= np.minimum(1, FURTHEST / np.maximum(np.abs(down).max(axis=2, keepdims=True), 1e-300))
        better = (cost <= least)[..., None]
        best, least = np.where(better, weights, best), np.minimum(cost, least)
        step = np.where(better, down, step / 2)
        weights = best + step
    return best


def trusted(counts: np.ndarray) -> np.ndarray:
    """Trust in each kind of repeat, by expectation maximisation over counts (kind, went on, bin of the model's own probability)."""
    own = np.exp(-(np.arange(DEEPEST) + 0.5) / BINS)
    asked, trust = 2 + counts.sum(axis=(1, 2)), np.full(RUNS, 0.5)
    for _ in range(100):
        share = trust[:, None] / (trust[:, None] + (1 - trust[:, None]) * own)
        trust = (1 + (counts[:, 1] * share).sum(axis=1)) / asked
    return trust


def train(texts: DataFrame) -> Model:
    """Learn the model from rows (doc_id, text, fold) of folds 1 to 9, from all of them.

    The tables are counts over all texts.  They have ``SLOTS`` (9,437,184) slots whatever the input, and so
    many rows come to the driver at most.  Weights, and the trust in repeats, are fitted to all texts too: those of odd folds
    under tables of the even ones, and the other way round.  The fit goes over distinct grams with their counts, in the tasks
    that hold them; the sums it needs have one size whatever the input.
    """
    spark = texts.sparkSession
    marked = texts.where("fold BETWEEN 1 AND 9").select((F.col("fold") % 2 == 1).alias("first"), "text")
    keys = marked.mapInArrow(_counted(_grams_by_half), "value long, n long")
    # By context and in order, so that neighbours share what is before a bit and are added up before they travel.
    keys = keys.withColumn("context", F.shiftright(F.col("value").bitwiseAND(F.lit((1 << TAG) - 1)), 8)).repartition("context")
    keys = keys.groupBy("context", "value").agg(F.sum(F.col("n").bitwiseAND(F.lit(FIRST - 1))).alias("n"), F.sum(F.shiftright("n", 32)).alias("first"))
    keys = written(keys.drop("context").sortWithinPartitions("value"), "grams")
    plain = F.shiftright("value", TAG) == 0
    sums = keys.where(plain).mapInArrow(_slot_counts, ", ".join(f"{c} long" for c in ("slot", *SUMS)))
    sums = written(sums.groupBy("slot").agg(*[F.sum(c).alias(c) for c in SUMS]), "slots")

    logit = F.round(F.lit(SCALE) * F.least(F.greatest(F.log((F.col("one") + 0.1) / (F.col("zero") + 0.1)), F.lit(-8.0)), F.lit(8.0)))
    seen = F.col("zero") + F.col("one")
    sure = F.when(seen >= 16, 3).when(seen >= 3, 2).otherwise(1)
    start = np.zeros((len(MIXERS), GATES, ORDERS))
    for m, orders in enumerate(MIXERS):
        start[m, :, :orders] = 1.2 / orders

    def filled(sums: DataFrame) -> Model:
        table = sums.where(seen > 0).select(F.col("slot").cast("int").alias("slot"), logit.cast("tinyint").alias("logit"),
                            sure.cast("tinyint").alias("sure")).toArrow()
        at = table["slot"].to_numpy()
        model = Model(np.zeros(SLOTS, np.int8), np.zeros(SLOTS, np.int8), start)
        model.logit[at], model.sure[at] = table["logit"].to_numpy(), table["sure"].to_numpy()
        return model

    second = sums.select("slot", (F.col("zero") - F.col("first_zero")).alias("zero"), (F.col("one") - F.col("first_one")).alias("one"))
    first = sums.select("slot", F.col("first_zero").alias("zero"), F.col("first_one").alias("one"))
    halves = (filled(first), filled(second))
    shared = spark.sparkContext.broadcast(halves)
    weights = fitted(keys.where(plain), shared, start)
    shared.destroy()
    for half in halves:
        half.weights = weights
    shared = spark.sparkContext.broadcast(halves)
    trust = trusted(_added(keys.where(~plain), _repeat_counts(shared), RUNS * 2 * DEEPEST).reshape(RUNS, 2, DEEPEST))
    shared.destroy()
    dropped(keys)
    model = filled(sums)
    model.weights, model.trust = weights, trust
    dropped(sums)
    return model


SCORE_SCHEMA = "doc_id long, held_out boolean, n_tokens long, known long, base double, score double, rare array<long>"


def _scored(model, common):
    """Score whole texts; words that are not among the common ones are passed on by number."""
    def scored(batches):
        numbers, logs = common.value
        own, met = model.value, Met()
        for batch in batches:
            held, at = batch.column("held_out").to_pylist(), 0
            for ids, texts in text_parts(batch.column("doc_id"), batch.column("text")):
                words = Words(texts)
                distinct, which = np.unique(words.numbers, return_inverse=True)
                found, value = np.zeros(len(distinct), bool), np.zeros(len(distinct))
                if len(numbers):
                    inside = np.minimum(np.searchsorted(numbers, distinct), len(numbers) - 1)
                    found = numbers[inside] == distinct
                    value = np.where(found, logs[inside], 0.0)
                found, value = found[which], value[which]
                total = np.concatenate([[0.0], np.cumsum(value)])
                known = np.concatenate([[0], np.cumsum(found)])
                first = words.first
                rare = np.flatnonzero(~found)
                cuts = np.searchsorted(rare, first).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.int64()), pa.array(held[at:at + len(ids)], pa.bool_()), pa.array(np.diff(first) + 1),
                    pa.array(known[first[1:]] - known[first[:-1]]),
                    pa.array([float(value[a:b].sum()) for a, b in zip(first[:-1], first[1:], strict=True)], pa.float64()),
                    pa.array(own.scores(texts, met), pa.float64()),
                    pa.ListArray.from_arrays(pa.array(cuts), pa.array(words.numbers[rare].view(np.int64))),
                ], [part.split()[0] for part in SCORE_SCHEMA.split(", ")])
                at += len(ids)
    return scored


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Rows whose crc32(id as text) modulo 10 is 0 are held out; a row without an id is neither held out nor learned from.  The
    base is the smoothed unigram over words and the end.  Word counts are added up over all training texts.  Words with
    at least one in 2^21 of all training tokens, of which there are at most 2^21, are sent to the tasks; the others are
    looked up by a join, in which no word has more than that share.  Words are 64-bit numbers (``words``).

    ``score`` is log10 of the model's probability of the text's UTF-8 bytes and its end; see ``train``.  It depends on the
    text and the model alone.  Null counts as the empty text, which has one token, its end.  Rows of a repeated id each
    give a row; with no training row everything is unknown and the base is that of an empty model.
    """
    spark = docs.sparkSession
    key = F.col(id_col).cast("long")
    fold = F.crc32(key.cast("string")) % 10
    texts = docs.select(key.alias("doc_id"), F.col(text_col).alias("text"), fold.alias("fold"))
    training = texts.where("fold <> 0")
    counts = training.select("doc_id", "text").mapInArrow(_counted(lambda _, t: [(Words(t).numbers, 1)]), "value long, n long")
    counts = written(counts.groupBy("value").agg(F.sum("n").alias("n")), "words")
    ends = training.count()
    n_words, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    total, vocabulary = n_words + ends, distinct + (ends > 0)
    below = math.log10(total + 0.1 * (vocabulary + 1))
    often = F.col("n") * COMMON >= total
    common = counts.where(often).toArrow()
    numbers = common["value"].to_numpy().view(np.uint64)
    order = np.argsort(numbers)
    logs = np.log10(common["n"].to_numpy() + 0.1) - below
    shared = spark.sparkContext.broadcast((numbers[order], logs[order]))
    model = spark.sparkContext.broadcast(train(texts))

    rows = texts.select("doc_id", F.coalesce(F.col("fold") == 0, F.lit(False)).alias("held_out"), "text")
    scored = written(rows.mapInArrow(_scored(model, shared), SCORE_SCHEMA), "scores")
    scored = scored.withColumn("row", F.monotonically_increasing_id())
    rare = scored.select(F.col("row").alias("rare_row"), F.explode("rare").alias("number"))
    names = counts.where(~often).select("value", "n")
    looked = rare.join(names, F.col("number") == F.col("value"), "left")
    added = looked.groupBy("rare_row").agg(
        F.count("n").alias("rare_known"),
        F.sum(F.log10(F.coalesce(F.col("n"), F.lit(0)) + 0.1) - below).alias("rare_base"))
    end = math.log10(ends + 0.1) - below
    out = scored.drop("rare").join(added, F.col("row") == F.col("rare_row"), "left")
    return out.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0)) + int(ends > 0)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0)) + end).alias("base_score"), "score")


def op4_lm_scoring(spark, sf_dir: str) -> DataFrame:
    return lm_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))
